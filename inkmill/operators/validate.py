"""Grammar validation of encoded strings (TOK1-5, JN15, PRJ22).

One regular expression cuts a segment into tokens: key signatures (longest
first), a base with its run of modifiers, atomic signs, stray modifiers, and
any other character. The symbol table is small, and travels as that pattern
and four dictionaries; the scan emits errors only, and nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Error codes and message formats.
MESSAGES = {
    "unknown_char": "Unknown OCR composition character {!r}.",
    "modifier_without_base": "Modifier {} is not attached to a base neume.",
    "duplicate_modifier": "Duplicate modifier {} on the same base neume.",
    "segmentStart": "Key signature {} is segment-start only.",
    "midOnly": "Key signature {} is mid-segment only.",
}
MAX_SYMBOLS = 20_000


@dataclass(frozen=True)
class Grammar:
    bases: frozenset[str]
    modifiers: dict[str, tuple[str, str]]  # character -> (group, icon)
    atoms: frozenset[str]
    keys: dict[str, tuple[str, str | None]]  # insert -> (icon, role), the first of equal inserts

    def pattern(self) -> str:
        """Tokens in order of precedence; the groups are key, plain, cluster, modifier, other.

        A plain token is a whole run of what cannot be an error (atomic signs,
        bases with one modifier at most), so that most text is one match.
        """

        def one_of(texts) -> str:
            single = "".join(re.escape(t) for t in sorted(texts) if len(t) == 1)
            longer = [re.escape(t) for t in sorted(texts, key=lambda t: (-len(t), t)) if len(t) > 1]
            return "(?:" + "|".join([*longer, *([f"[{single}]"] if single else [])]) + ")" if texts else r"(?!)"

        key, base, modifier, atom = map(one_of, (self.keys, self.bases, self.modifiers, self.atoms))
        plain = f"(?:(?!{key})(?:{base}{modifier}?(?!{modifier})|{atom}))+"
        return f"(?P<key>{key})|(?P<plain>{plain})|(?P<cluster>{base}{modifier}*)|(?P<modifier>{modifier})|(?P<other>.)"


def grammar(symbols: DataFrame) -> Grammar:
    """Build the tables of TOK4 from symbol rows: pos, icon, group, role, insert, variants (map), key_role.

    Of equal characters the last symbol wins, but among key signatures of equal
    text the first does. Bases and atomic signs are single characters.
    """
    rows = symbols.orderBy("pos").limit(MAX_SYMBOLS + 1).collect()
    if len(rows) > MAX_SYMBOLS:
        raise ValueError(f"more than {MAX_SYMBOLS} symbols")
    bases, modifiers, atoms, keys = set(), {}, set(), {}
    for r in rows:
        if r.role == "base" and r.insert and len(r.insert) == 1:
            bases.add(r.insert)
        if r.role == "modifier":
            modifiers |= {c: (r.group, r.icon) for c in (r.variants or {}).values() if c and len(c) == 1}
        if r.role in ("rest", "ornament") and r.insert and len(r.insert) == 1:
            atoms.add(r.insert)
        if r.role == "key_signature" and r.insert:
            keys.setdefault(r.insert, (r.icon, r.key_role))
    return Grammar(frozenset(bases), modifiers, frozenset(atoms - bases), keys)


def segments(df: DataFrame, doc: str, composition: str) -> DataFrame:
    """PRJ22: doc, segment_index, segment from a text, an array of texts, or an array of structs with ``composition``.

    Null structs are dropped before numbering; a null text counts as empty.
    """
    kind = df.schema[composition].dataType
    if kind.typeName() != "array":
        return df.select(doc, F.lit(0).alias("segment_index"), F.coalesce(composition, F.lit("")).alias("segment"))
    if kind.elementType.typeName() == "struct":
        texts = F.transform(F.filter(composition, lambda s: s.isNotNull()), lambda s: F.coalesce(s["composition"], F.lit("")))
    else:
        texts = F.transform(composition, lambda s: F.coalesce(s.cast("string"), F.lit("")))
    return df.select(doc, F.posexplode(texts).alias("segment_index", "segment"))


def validate(rows: DataFrame, rules: Grammar, doc: str = "doc_id") -> DataFrame:
    """TOK1-3: the errors of every segment: doc, segment_index, position (in characters), code, message.

    ``rows``: doc, segment_index, segment. Empty and null segments have none.
    """
    kind = rows.schema[doc].dataType.simpleString()
    schema = f"{doc} {kind}, segment_index int, position int, code string, message string"

    def errors(segment: str, rx: re.Pattern) -> Iterator[tuple[int, str, str]]:
        for token in rx.finditer(segment):
            at, text, what = token.start(), token.group(), token.lastgroup
            if what == "key":
                icon, role = rules.keys[text]
                if (role == "segmentStart" and at) or (role == "midOnly" and not at):
                    yield at, "key_signature_role", MESSAGES[role].format(icon)
            elif what == "cluster" and len(text) > 2:
                seen = set()
                for k, c in enumerate(text[1:], at + 1):
                    sign = rules.modifiers[c]
                    if sign in seen:
                        yield k, "duplicate_modifier", MESSAGES["duplicate_modifier"].format(sign[1])
                    seen.add(sign)
            elif what == "modifier":
                yield at, "modifier_without_base", MESSAGES["modifier_without_base"].format(rules.modifiers[text][1])
            elif what == "other":
                yield at, "unknown_char", MESSAGES["unknown_char"].format(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rx = re.compile(rules.pattern(), re.DOTALL)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                out = [(k, i, *e) for k, (i, s) in enumerate(zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True)) for e in errors(s or "", rx)]
                if out:
                    k, i, p, c, m = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(k)), pa.array(i, pa.int32()), pa.array(p, pa.int32()), pa.array(c), pa.array(m)], [doc, "segment_index", "position", "code", "message"])

    return rows.select(doc, F.col("segment_index").cast("int"), "segment").mapInArrow(run, schema)


def gate(files: DataFrame, found: DataFrame, least: int, doc: str = "doc_id") -> DataFrame:
    """AGG20: one row: files, files with errors, and whether there are enough files and no errors."""
    bad = found.select(doc).distinct().agg(F.count("*").alias("bad"))
    return files.agg(F.countDistinct(doc).alias("files")).crossJoin(F.broadcast(bad)).withColumn("passed", (F.col("files") >= least) & (F.col("bad") == 0))
