"""Explicit schemas of the tables that the readers and operators share (D1-D22)."""

from __future__ import annotations

PAGES = "page string, book_id string, page_number int, width int, height int, channels int, data binary"
MANIFEST = "book_id string, page_number int, image_path string, sha256 string, dpi int, width int, height int, masked boolean, direction string, ink_ratio double"
#: A manifest as it lies in CSV: all text, older files without the last columns.
MANIFEST_TEXT = ", ".join(f"{c.split()[0]} string" for c in MANIFEST.split(", "))
BAND = "page string, page_width int, page_height int, direction string, x1 int, y1 int, x2 int, y2 int, n int, long int, long_width int, ink double"
REGION = "struct<kind:string,bbox:array<int>,component_count:int,long_component_count:int,ink_ratio:double,script:string,text_direction:string>"
LAYOUT = f"page string, page_width int, page_height int, notation_direction string, chant_rows array<struct<index:int,bbox:array<int>,notation_direction:string,lyric_rows:array<{REGION}>>>, unpaired_lyric_rows array<{REGION}>, non_score_regions array<{REGION}>"
DETECTION = "page string, ord int, class_name string, x1 double, y1 double, x2 double, y2 double, confidence double"
MATCH = "page string, ord int, label string, pt double, x int, y int, w int, h int, area int, score double"
GLYPH = "cp int, glyph_name string, width int, height int, data binary"
GROUP = "id string, representative long, members array<long>"
SYMBOL = "icon string, label string, group string, role string, variants map<string,string>, insert string, isBase boolean, isModifier boolean, isKeySignature boolean, keyId int, keySignatureRole string, category string, basePitch int, length string, heavyTop boolean, klasmaPlacement string, legacyChars map<string,string>, reactChars map<string,string>"
SYMBOL_MAP = f"_meta struct<generatedBy:string,toolbarCounts:map<string,int>,keySignatureCount:int,actionCharMapCount:int,actionIcons:array<string>,orphanActionIcons:array<string>>, symbols array<struct<{', '.join(':'.join(c.split(' ', 1)) for c in SYMBOL.split(', '))}>>"
COMPOSITION = "segments array<struct<composition:string>>"
LABEL_BOX = "number int, class_id int, class_name string, group string, icon string, x_center double, y_center double, width double, height double, book_id string, page_id string"
TASKS = "id long, data struct<image:string,book_id:string,page_number:int,direction:string>, annotations array<struct<was_cancelled:boolean,result:array<struct<type:string,value:struct<x:double,y:double,width:double,height:double,rectanglelabels:array<string>>>>>>"
DIRECTION = "book string, key string, direction string"
CLASS = "class_id int, name string"
FAMILY = "id string, representative string, codepoints array<string>, icons array<string>"
ALIAS = "ord int, keys array<long>"
AUDIT = "image_path string, expected string"
PAIR = "a long, b long, sim double"
