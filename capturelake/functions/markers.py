"""Marker lines of training logs: ``MARKER {json}`` with an optional `` [dd/mm hh:mm:ss]`` suffix."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the suffix that a training log appends to a line.
SUFFIX = r"\s*\[\d{2}/\d{2} \d{2}:\d{2}:\d{2}\]\s*$"
_SUFFIX = re.compile(SUFFIX)


def _refuse(name: str):
    raise ValueError(name)


@F.pandas_udf(T.StringType())
def _strict_object(text: pd.Series) -> pd.Series:
    """Canonical JSON of texts that are one JSON object and nothing more; else null."""

    def one(t):
        try:
            found = json.loads(t, parse_constant=_refuse)
            return json.dumps(found) if isinstance(found, dict) else None
        except (ValueError, TypeError, RecursionError):
            return None

    return text.map(one)


def parse_markers(lines: DataFrame, marker: str, schema: T.StructType | str, line: str = "line") -> DataFrame:
    """Rows of the marker's lines with the parsed ``record``; lines without a strict JSON object are dropped.

    Spark's own JSON reader takes text after the object and NaN, which a record must not have, so the
    candidates, and they only, pass a strict reader first.
    """
    d = lines.where(F.col(line).startswith(marker + " "))
    body = F.regexp_replace(F.substring(F.col(line), len(marker) + 2, 1 << 30), SUFFIX, "")
    d = d.withColumn("_json", _strict_object(body)).where("_json IS NOT NULL")
    return d.withColumn("record", F.from_json("_json", schema)).withColumnRenamed("_json", "json")


def parse_shape_marker(lines: DataFrame, marker: str, line: str = "line") -> DataFrame:
    """``MARKER iteration=12 key=value ...``: iteration (a positive integer, else the line is dropped) and a map of all tokens."""
    body = F.regexp_replace(F.substring(F.col(line), len(marker) + 2, 1 << 30), SUFFIX, "")
    d = lines.where(F.col(line).startswith(marker + " ")).withColumn("tokens", F.filter(F.split(body, r"\s+"), lambda t: F.contains(t, F.lit("="))))
    d = d.withColumn("fields", F.map_from_entries(F.array_distinct(F.transform("tokens", lambda t: F.struct(F.substring_index(t, "=", 1), F.regexp_replace(t, "^[^=]*=", ""))))))
    iteration = F.when(F.col("fields")["iteration"].rlike(r"^\d+$"), F.expr("try_cast(fields['iteration'] AS BIGINT)"))
    return d.withColumn("iteration", iteration).where("iteration > 0").drop("tokens")
