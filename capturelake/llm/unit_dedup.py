"""Substring dedup by hashing units: paragraphs, lines, or sentences within lines.

Texts are cut into units that tile them, so every unit keeps its offsets in the original text. A unit is
normalised (lower case, single spaces) and hashed to 128 bits. Digests are grouped over the whole corpus; the
earliest unit by (rank, unit number) stays and all others go, where units to remove that follow each other in a
document have ``least`` words together. With ``least`` = 1 that is every repeated unit.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import keyed, slices, staged

#: How each kind of unit tiles a text.
UNITS = {"paragraph": r"(?:[^\n]|\n(?!\n))+|\n", "line": r"[^\n]+|\n", "sentence": r"[^\n.!?]+[.!?]*|[.!?]+|\n"}
#: What the query removes: repeated passages, made up of whole sentences of a line that were all seen before.
PASSAGE_WORDS = 20

_ROW = "row struct<file:long,at:long>"


def _units(docs: DataFrame, unit: str, text: str, key: str) -> DataFrame:
    """(row, doc_id, unit_no, start, end, words, digest) of ``keyed`` documents; units without a word have no number."""
    pattern = re.compile(UNITS[unit])

    def cut(batches):
        for b in slices(batches, 2):
            rows, nos, starts, ends, sizes, digests = [], [], [], [], [], []
            for row, body in enumerate(b.column(2).to_pylist()):
                at = no = 0
                for part in pattern.findall(body or ""):
                    words = part.lower().split()
                    if words:
                        rows.append(row)
                        nos.append(no)
                        starts.append(at)
                        ends.append(at + len(part))
                        sizes.append(len(words))
                        digests.append(hashlib.blake2b(" ".join(words).encode("utf-8", "surrogatepass"), digest_size=16).digest())
                        no += 1
                    at += len(part)
            own = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(own), b.column(1).take(own), *(pa.array(x, pa.int32()) for x in (nos, starts, ends, sizes)), pa.array(digests, pa.binary())], ["row", "doc_id", "unit_no", "start", "end", "words", "digest"])

    d = docs.select("row", F.col(f"doc.`{key}`").cast("long").alias("doc_id"), F.col(f"doc.`{text}`").alias("text"))
    return d.mapInArrow(cut, f"{_ROW}, doc_id long, unit_no int, start int, end int, words int, digest binary")


def _repeated(docs: DataFrame, unit: str, least: int, text: str, key: str) -> DataFrame:
    u = staged(_units(docs, unit, text, key), "units")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "unit_no")).alias("first")
    # Partial sums leave a row per digest and task, so a very common unit is no hot key here ...
    groups = u.groupBy("digest").agg(first, F.count("*").alias("copies")).where("copies > 1")
    # ... and in this join Spark may split its partition, as the other side has one row for each digest.
    found = u.join(groups.hint("merge"), "digest").where("NOT (row = first.row AND unit_no = first.unit_no)")
    found = found.select("row", "doc_id", "unit_no", "start", "end", "words", F.col("first.doc_id").alias("keep_doc_id"), F.col("first.unit_no").alias("keep_unit_no"), "copies")
    if least > 1:
        # Windows hold the repeated units of one document.
        run = F.col("unit_no") - F.row_number().over(Window.partitionBy("row").orderBy("unit_no"))
        found = found.withColumn("run", run).withColumn("in_run", F.sum("words").over(Window.partitionBy("row", "run"))).where(F.col("in_run") >= least)
    return found.select("row", "doc_id", "unit_no", "start", "end", "keep_doc_id", "keep_unit_no", "copies")


def repeated_units(docs: DataFrame, unit: str = "line", least: int = 1, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per unit to remove: doc_id, unit_no, start, end, keep_doc_id, keep_unit_no, copies; offsets in characters.

    Units are numbered by document, those without a word have no number. They rank by (doc_id, place of the row, unit_no),
    a null id last; the first of a digest stays. ``copies`` counts all units of the digest. Null, empty and blank texts
    have no units. A document may repeat its own units. Rows that share an id, or have none, are documents of their own: of
    equal ones the first stays whole. Other columns are not looked at. An empty table gives no rows.
    """
    return _repeated(keyed(docs), unit, least, text, key).drop("row")


def cleaned(docs: DataFrame, unit: str = "line", least: int = 1, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc, clean_text, removed) of each row: the row as it was, its text without repeated units, and their offsets in order.

    ``removed`` is empty and the text unchanged where nothing repeats; a null text stays null.
    """
    d = keyed(docs)
    spans = _repeated(d, unit, least, text, key).groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("removed"))
    d = d.join(staged(spans, "spans").hint("merge"), "row", "left").withColumn("removed", F.coalesce("removed", F.expr("CAST(array() AS ARRAY<STRUCT<start: INT, end: INT>>)")))

    @F.pandas_udf("string")
    def keep(texts, removed):
        out = []
        for t, gone in zip(texts, removed, strict=True):
            at, parts = 0, []
            for span in gone:
                parts.append(t[at : span["start"]])
                at = span["end"]
            out.append("".join([*parts, t[at:]]))
        return texts.__class__(out, dtype=object)

    body = F.col(f"doc.`{text}`")
    return d.select("doc", F.when(F.size("removed") == 0, body).otherwise(keep(F.when(F.size("removed") > 0, body).otherwise(""), "removed")).alias("clean_text"), "removed")


ORACLE = r"""
WITH parts AS (SELECT doc_id, regexp_extract_all(text, '[^\n.!?]+[.!?]*|[.!?]+|\n') AS p FROM documents),
each AS (SELECT doc_id, unnest(p) AS part, generate_subscripts(p, 1) - 1 AS part_no FROM parts),
placed AS (
  SELECT doc_id, part_no, part, sum(length(part)) OVER (PARTITION BY doc_id ORDER BY part_no) - length(part) AS start,
    trim(regexp_replace(lower(part), '\s+', ' ', 'g')) AS norm FROM each),
u AS (
  SELECT *, start + length(part) AS "end", len(string_split(norm, ' ')) AS words, row_number() OVER (PARTITION BY doc_id ORDER BY part_no) - 1 AS unit_no
  FROM placed WHERE norm <> ''),
g AS (SELECT norm, min({'d': doc_id, 'u': unit_no}) AS f, count(*) AS copies FROM u GROUP BY norm HAVING count(*) > 1),
r AS (SELECT u.*, f, copies FROM u JOIN g USING (norm) WHERE NOT (doc_id = f.d AND unit_no = f.u)),
i AS (SELECT *, unit_no - row_number() OVER (PARTITION BY doc_id ORDER BY unit_no) AS run FROM r),
s AS (SELECT *, sum(words) OVER (PARTITION BY doc_id, run) AS in_run FROM i)
SELECT doc_id, CAST(unit_no AS INT) AS unit_no, CAST(start AS INT) AS start, CAST("end" AS INT) AS "end", f.d AS keep_doc_id, CAST(f.u AS INT) AS keep_unit_no, copies
FROM s WHERE in_run >= 20
"""
