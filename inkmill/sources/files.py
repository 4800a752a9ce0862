"""Readers (SRC1-SRC26). Every path may lie in any store that Spark reads."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill import schemas
from inkmill.functions import kernels
from inkmill.functions.text import GLYPH_RANGES, normal_key, page_path, parse_codepoint, resolve_direction
from inkmill.operators.stats import head_per_key, seeded_sample
from inkmill.sources.images import png

MAX_CONFIG_BYTES = 16 << 20


def config_text(spark: SparkSession, path: str) -> str:
    """The text of one small configuration file; a larger one raises."""
    row = spark.read.format("binaryFile").load(path).select("length", F.when(F.col("length") <= MAX_CONFIG_BYTES, F.col("content")).alias("content")).first()
    if row is None or row.content is None:
        raise ValueError(f"no file, or too large a one: {path}")
    return bytes(row.content).decode("utf-8")


def _yaml(spark: SparkSession, path: str):
    import yaml

    return yaml.safe_load(config_text(spark, path)) or {}


def pdf_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """SRC1: PDF files of folders (not their subfolders) and single files: path, book_id, content."""
    folders = [p for p in paths if not p.lower().endswith(".pdf")]
    files = [p for p in paths if p.lower().endswith(".pdf")]
    frames = [spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(f) for f in folders] + [spark.read.format("binaryFile").load(f) for f in files]
    if not frames:
        return spark.createDataFrame([], "path string, book_id string, content binary")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.select("path", F.regexp_extract("path", r"([^/]*)\.[^./]*$", 1).alias("book_id"), "content")


def page_counts(pdfs: DataFrame, count: Callable[[bytes], int]) -> DataFrame:
    """SRC3: pages of each PDF by the caller's counting function: path, book_id, pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([count(x) for x in b.column(2).to_pylist()], pa.int32())], ["path", "book_id", "pages"])

    return pdfs.select("path", "book_id", "content").mapInArrow(run, "path string, book_id string, pages int")


def render_pages(pdfs: DataFrame, chunks: DataFrame, rasterise: Callable[[bytes, int, int], np.ndarray], root: str, directions: DataFrame, dpi: int = 400, direction: str = "ltr", mask: bool = False) -> DataFrame:
    """SRC2: rendered pages with their manifest columns and PNG bytes (column png).

    ``chunks``: book_id, chunk_first, chunk_last. ``rasterise(pdf, page, dpi)``
    gives the gray page; no renderer is bundled. Direction, mask, hash and ink
    ratio are taken where the page is drawn (PRJ2, PRJ3, PRJ5, PRJ6, IMG5, IMG6).
    A PDF travels once for each of its chunks, not for each page.
    """
    wanted = chunks.select("book_id", "chunk_first", F.explode(F.sequence(F.col("chunk_first").cast("int"), F.col("chunk_last").cast("int"))).alias("page_number"))
    wanted = resolve_direction(wanted, directions, direction)
    page = F.struct("page_number", "direction", page_path(root, "book_id", "page_number").alias("image_path"))
    listed = wanted.groupBy("book_id", "chunk_first").agg(F.array_sort(F.collect_list(page)).alias("listed"))
    jobs = pdfs.join(listed, "book_id").select("book_id", "listed", "content")
    out = schemas.MANIFEST + ", png binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for job in (batch.slice(k, 1).to_pylist()[0] for batch in batches for k in range(batch.num_rows)):
            for of in job["listed"]:
                image = rasterise(job["content"], of["page_number"], dpi)
                side = kernels.direction(image) if of["direction"] == "auto" else of["direction"]
                if mask:
                    image = kernels.apply_mask(image, kernels.text_mask(image))
                data = png(image)
                row = {"book_id": job["book_id"], "page_number": of["page_number"], "image_path": of["image_path"], "sha256": hashlib.sha256(data).hexdigest(), "dpi": dpi, "width": image.shape[1], "height": image.shape[0], "masked": mask, "direction": side, "ink_ratio": kernels.ink_ratio(image), "png": data}
                yield pa.RecordBatch.from_pylist([row], kinds)

    types = {"string": pa.string(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "binary": pa.binary()}
    kinds = pa.schema([(n, types[k]) for n, k in (c.split() for c in out.split(", "))])
    return jobs.mapInArrow(run, out)


def page_images(spark: SparkSession, paths: list[str], books: list[str] | None = None, head: int | None = None) -> DataFrame:
    """SRC4-SRC6: page images below ``paths``, page_*.png in name order, the first ``head`` of each book; unreadable files are dropped."""
    rows = spark.read.format("image").option("recursiveFileLookup", "true").option("pathGlobFilter", "page_*.png").option("dropInvalid", "true").load(paths)
    book = F.url_decode(F.regexp_extract("image.origin", "([^/]*)/[^/]*$", 1))
    out = rows.select(F.col("image.origin").alias("page"), book.alias("book_id"), F.regexp_extract("image.origin", r"page_(\d+)", 1).cast("int").alias("page_number"), "image.width", "image.height", F.col("image.nChannels").alias("channels"), "image.data")
    if books:
        out = out.where(F.col("book_id").isin(books))
    if head:
        first = head_per_key(out.select("book_id", "page"), ["book_id"], [F.asc("page")], head)
        out = out.join(first.select("page"), "page", "left_semi")
    return out


def frequency_pages(manifest: DataFrame, sample: int | None = None, seed: str = "42", book: str | None = None) -> DataFrame:
    """SRC7: manifest pages with ink, one book's or all, optionally a seeded sample without replacement."""
    rows = manifest.where(F.coalesce("ink_ratio", F.lit(1.0)) > 0)
    rows = rows.where(F.col("book_id") == book) if book else rows
    return seeded_sample(rows, "image_path", sample, seed) if sample else rows


def read_manifest(spark: SparkSession, path: str, *, may_be_missing: bool = False) -> DataFrame:
    """SRC8: a manifest CSV with typed columns; missing ones are null but for ink_ratio (1.0) and direction (ltr).

    A missing file raises, or is an empty manifest where it ``may_be_missing``.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path
    store = place(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(place(path)) and store.exists(place(path + ".next/_SUCCESS")):  # a writer stopped between two renames
        path += ".next"
    if may_be_missing and not store.exists(place(path)):
        return spark.createDataFrame([], schemas.MANIFEST)
    raw = spark.read.option("header", "true").csv(path)
    columns = []
    for name, kind in (c.split() for c in schemas.MANIFEST.split(", ")):
        value = F.nullif(F.trim(name), F.lit("")).cast(kind) if name in raw.columns else F.lit(None).cast(kind)
        default = {"ink_ratio": F.lit(1.0), "direction": F.lit("ltr")}.get(name)
        columns.append((F.coalesce(value, default) if default is not None else value).alias(name))
    return raw.select(*columns)


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """SRC10: image_path, expected."""
    return spark.read.schema(schemas.AUDIT).option("header", "true").csv(path)


def read_symbol_map(spark: SparkSession, path: str) -> DataFrame:
    """SRC11: symbols of a symbol map file: pos and the symbol's fields."""
    return spark.read.schema(schemas.SYMBOL_MAP).option("multiLine", "true").json(path).select(F.posexplode("symbols").alias("pos", "s")).select("pos", "s.*").withColumnRenamed("keySignatureRole", "key_role")


def read_class_names(spark: SparkSession, path: str) -> DataFrame:
    """SRC15: class_id, name from YAML names as a list or as a map by number."""
    names = _yaml(spark, path).get("names") or []
    items = sorted((int(k), v) for k, v in names.items()) if isinstance(names, dict) else enumerate(names)
    return spark.createDataFrame(list(items), schemas.CLASS)


def read_tasks(spark: SparkSession, path: str) -> DataFrame:
    """SRC16: annotation tasks of an exported JSON array."""
    return spark.read.schema(schemas.TASKS).option("multiLine", "true").json(path)


def label_lines(spark: SparkSession, path: str) -> DataFrame:
    """SRC17: lines of all label files below ``path``: path, number (from 1), value; files are read whole, each by one task."""
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").text(path, wholetext=True)
    lines = files.select(F.col("_metadata.file_path").alias("path"), F.posexplode(F.split("value", "\r?\n")).alias("k", "value"))
    return lines.select("path", (F.col("k") + 1).alias("number"), "value")


def read_families(spark: SparkSession, path: str) -> DataFrame:
    """SRC19: shape families."""
    return spark.read.schema(schemas.FAMILY).option("multiLine", "true").json(path)


def read_aliases(spark: SparkSession, path: str) -> DataFrame:
    """SRC20: alias families from YAML: ord, keys, the representative first, each key once; single ones are dropped, bad ones raise."""
    rows = []
    for k, family in enumerate(_yaml(spark, path).get("families") or []):
        if not isinstance(family, dict) or not family.get("representative"):
            raise ValueError("an alias family needs a representative")
        rows.append((k, [str(family["representative"]), *map(str, family.get("members") or [])]))
    table = spark.createDataFrame(rows, "ord int, names array<string>")
    keys = F.array_distinct(F.transform("names", lambda n: parse_codepoint(n).cast("long")))
    return table.select("ord", keys.alias("keys")).where(F.size("keys") > 1)


def read_directions(spark: SparkSession, path: str) -> DataFrame:
    """SRC21: book, key, direction from JSON of directions or maps of them; auto and unknown ones raise."""
    return directions(spark, json.loads(config_text(spark, path)))


def directions(spark: SparkSession, raw: dict) -> DataFrame:
    rows = [(book, str(key), str(value).lower()) for book, of in raw.items() for key, value in (of.items() if isinstance(of, dict) else [("default", of)])]
    bad = [r for r in rows if r[2] not in ("ltr", "rtl")]
    if bad:
        raise ValueError(f"a direction is ltr or rtl: {bad[0]}")
    return spark.createDataFrame(rows, schemas.DIRECTION)


def gold_compositions(spark: SparkSession, path: str, name: str = "expected_composition.json") -> DataFrame:
    """SRC22: doc_id (file path) and segments of all gold compositions below ``path``."""
    rows = spark.read.schema(schemas.COMPOSITION).option("multiLine", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", name).json(path)
    return rows.select(F.col("_metadata.file_path").alias("doc_id"), "segments")


def read_glyphs(spark: SparkSession, path: str) -> DataFrame:
    """SRC23: glyph bitmaps; no font engine is bundled, so they are an input table."""
    return spark.read.schema(schemas.GLYPH).parquet(path)


#: Glyphs of a font that one task draws at a time.
GLYPH_CHUNK = 64


def font_glyphs(fonts: DataFrame, cmap: Callable[[bytes], dict[int, str]], draw: Callable[[bytes, int, int], np.ndarray | None], ranges=GLYPH_RANGES, size: int = 400, finer: int = 4) -> DataFrame:
    """SRC23, SRC26, IMG9: glyph bitmaps of fonts by the caller's engine; no font engine is bundled.

    ``fonts``: content. ``cmap(font)`` names the code points a font has;
    ``draw(font, code point, pixels)`` gives a gray glyph, or None for one
    without an outline. Glyphs in range are drawn ``finer`` times as large,
    shrunk by area and split at 200; a font travels once for each chunk of
    glyphs. Of fonts that share a code point, each gives a row.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for font in (x for batch in batches for x in batch.column(0).to_pylist()):
            named = sorted((cp, name) for cp, name in cmap(font).items() if cp >= 0x20 and (not ranges or any(lo <= cp <= hi for lo, hi in ranges)))
            chunks = [[{"cp": cp, "name": name} for cp, name in named[k : k + GLYPH_CHUNK]] for k in range(0, len(named), GLYPH_CHUNK)]
            yield pa.RecordBatch.from_arrays([pa.array([font] * len(chunks), pa.binary()), pa.array(chunks, pa.list_(pa.struct([("cp", pa.int32()), ("name", pa.string())])))], ["content", "glyphs"])

    def paint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for batch in batches for r in batch.to_pylist()):
            out = []
            for g in row["glyphs"]:
                large = draw(row["content"], g["cp"], size * finer)
                if large is not None and large.size:
                    h, w = (max(1, s // finer) for s in large.shape)
                    small = np.where(kernels.resample(large, h, w) > 200, 255, 0).astype(np.uint8)
                    out.append({"cp": g["cp"], "glyph_name": g["name"], "width": w, "height": h, "data": small.tobytes()})
            yield pa.RecordBatch.from_pylist(out, pa.schema([("cp", pa.int32()), ("glyph_name", pa.string()), ("width", pa.int32()), ("height", pa.int32()), ("data", pa.binary())]))

    listed = fonts.select("content").mapInArrow(scan, "content binary, glyphs array<struct<cp:int,name:string>>")
    return listed.repartition(F.xxhash64("glyphs")).mapInArrow(paint, schemas.GLYPH)


def icon_files(spark: SparkSession, folders: list[str]) -> DataFrame:
    """SRC24: each icon's file, in the first folder that has it: icon, path."""
    frames = [spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.gif").load(f).select("path", F.lit(k).alias("rank")) for k, f in enumerate(folders)]
    every = frames[0]
    for f in frames[1:]:
        every = every.unionByName(f)
    icon = F.url_decode(F.regexp_extract("path", r"([^/]*)\.gif$", 1))
    return every.groupBy(icon.alias("icon")).agg(F.min_by("path", F.struct("rank", "path")).alias("path"))


def read_members(spark: SparkSession, aliases: dict[str, list[str]]) -> DataFrame:
    """PRJ29: alias families from options: ord, keys."""
    rows = [(k, [rep, *members]) for k, (rep, members) in enumerate(aliases.items())]
    table = spark.createDataFrame(rows, "ord int, names array<string>")
    return table.select("ord", F.transform("names", lambda n: parse_codepoint(normal_key(n)).cast("long")).alias("keys"))
