"""Tables that cut lineage: written to the folder that driver and executors share, and read back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Up to so many rows a table of one row a key is sent to all executors, which holds for rows of some hundred bytes.
BROADCAST_ROWS = 100_000
#: Beyond it each key is dealt into so many parts, so that a key with most rows is no single task.
SALTS = 64
#: Rows of a task where parts are dealt by number.
PART_ROWS = 500_000


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder for tables that cut lineage, in ``spark.checkpoint.dir``; a session in local mode without it takes one of its own."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return f"{(shared or tempfile.mkdtemp(prefix='spark-capturelake-', dir='/tmp')).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scene_join(rows: DataFrame, scenes: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``rows`` with the columns of their key's row in ``scenes``, a table of one row a key; rows without one go, or stay if ``how`` is "left".

    Small tables are broadcast after their rows are counted, so rows stay where they are and none are sorted by key. Larger ones are joined by a shuffle on
    the key and a salt.
    """
    if scenes.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(scenes), key, how)
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS))
    each = scenes.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return rows.withColumn("_salt", salt).join(each.hint("merge"), [key, "_salt"], how).drop("_salt")


def dealt(rows: DataFrame, by: list[str], count: int) -> DataFrame:
    """``rows`` shuffled by ``by`` into parts of about ``PART_ROWS`` of ``count`` rows, at least as many parts as any shuffle has.

    Adaptive execution joins parts until each has 64 MB as compressed, and columns of few values compress to some bytes a row, so a task would
    hold tens of millions of rows.
    """
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-count // PART_ROWS))
    return rows.repartition(parts, *by)
