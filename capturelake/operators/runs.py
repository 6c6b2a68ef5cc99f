"""Run histories: attempts, statuses, artifacts and fingerprints, keyed by ``run_id``."""

from __future__ import annotations

import json
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: statuses that may follow each other.
TRANSITIONS = {"planned": ["running", "failed"], "running": ["running", "failed", "complete"]}


def attempt_number(name):
    """Number at the end of ``attempt-0012``; -1 without one."""
    return F.coalesce(F.expr("try_cast(nullif(regexp_extract({}, '-([0-9]+)$', 1), '') AS INT)".format(name)), F.lit(-1))


def latest_attempt(attempts: DataFrame, key: Sequence[str] = ("run_id", "stage")) -> DataFrame:
    w = Window.partitionBy(*key).orderBy(F.desc("attempt"))
    return attempts.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def stage_observations(attempts: DataFrame, key: Sequence[str] = ("run_id", "stage")) -> DataFrame:
    """Attempts, latest attempt and merged status (failed before blocked before passed before others) of each stage."""
    rank = F.when(F.col("status") == "failed", 0).when(F.col("status") == "blocked", 1).when(F.col("status") == "passed", 2).otherwise(3)
    return attempts.groupBy(*key).agg(F.count("*").alias("attempts"), F.max("attempt").alias("latest_attempt"), F.min_by("status", F.struct(rank, "attempt")).alias("merged_status"), F.max_by("status", "attempt").alias("latest_status"))


def stage_timing(attempts: DataFrame, stage_order: Sequence[str]) -> DataFrame:
    """Start, end and seconds of the latest attempt of each stage, and the stage's place in the order."""
    d = latest_attempt(attempts)
    place = F.array_position(F.array(*map(F.lit, stage_order)), F.col("stage"))
    return d.withColumn("position", place).withColumn("seconds", (F.unix_micros(F.col("finished_at").cast("timestamp")) - F.unix_micros(F.col("started_at").cast("timestamp"))) / 1e6)


def orphan_attempts(requests: DataFrame, results: DataFrame, key: Sequence[str] = ("run_id", "stage", "attempt")) -> DataFrame:
    """Requests without a result."""
    return requests.join(results.select(*key), list(key), "left_anti")


def transition_violations(statuses: DataFrame) -> DataFrame:
    """Rows (run_id, seq, status) whose status may not follow the one before; the first must be planned."""
    d = statuses.withColumn("before", F.lag("status").over(Window.partitionBy("run_id").orderBy("seq")))
    ok = F.col("before").isNull() & (F.col("status") == "planned")
    for a, after in TRANSITIONS.items():
        ok = ok | ((F.col("before") == a) & F.col("status").isin(*after))
    return d.where(~F.coalesce(ok, F.lit(False)))


def artifact_hash_check(attempts: DataFrame, inventory: DataFrame, key: Sequence[str] = ("run_id", "stage", "attempt")) -> DataFrame:
    """Whether each attempt passed and all its artifacts (path, sha256) are in the inventory with the same hash."""
    each = attempts.select(*key, "status", F.explode_outer("artifacts").alias("a")).select(*key, "status", "a.path", "a.sha256")
    d = each.join(inventory.select("path", F.col("sha256").alias("found")).hint("merge"), "path", "left")
    valid = F.col("path").isNull() | F.coalesce(F.col("sha256") == F.col("found"), F.lit(False))
    d = d.groupBy(*key).agg(F.first("status").alias("status"), F.count("path").alias("artifacts"), F.count_if(~valid).alias("invalid_artifacts"))
    return d.withColumn("reusable", (F.col("status") == "passed") & (F.col("invalid_artifacts") == 0))


def classify_stage_migration(observed: DataFrame, expected: DataFrame, key: Sequence[str], immutable: Sequence[str], other: Sequence[str]) -> DataFrame:
    """reject_nonreusable, reject_unsafe_drift, stale_rebuildable or reusable_exact for each observed stage, with the changed fields."""
    e = expected.select(*key, *[F.col(c).alias(f"_{c}") for c in (*immutable, *other)], F.lit(True).alias("_known"))
    d = observed.join(e, list(key), "left")
    differ = lambda names: F.array_compact(F.array(*[F.when(~F.col(c).eqNullSafe(F.col(f"_{c}")), F.lit(c)) for c in names]))
    d = d.withColumn("changed_immutable", differ(immutable)).withColumn("changed_other", differ(other))
    usable = (F.col("status") == "passed") & F.coalesce("reusable", F.lit(False)) & F.coalesce("_known", F.lit(False))
    kind = F.when(~F.coalesce(usable, F.lit(False)), "reject_nonreusable").when(F.size("changed_immutable") > 0, "reject_unsafe_drift").when(F.size("changed_other") > 0, "stale_rebuildable").otherwise("reusable_exact")
    return d.withColumn("classification", kind).select(*key, "classification", "changed_immutable", "changed_other")


def content_fingerprint(rows: DataFrame, key: Sequence[str], name: str = "name", sha: str = "sha256") -> DataFrame:
    """Digest of each key's (name, hash) rows whatever their order: sums of both halves of the MD5 of ``name:hash`` lines.

    Sums merge, so a key with very many rows is never held as a whole. Repeated rows count as often as they are there.
    """
    line = F.md5(F.concat_ws(":", name, sha))
    half = lambda at: F.sum(F.conv(F.substring(line, at, 15), 16, 10).cast("decimal(19,0)")).cast("string")
    return rows.groupBy(*key).agg(F.count("*").alias("files"), F.concat_ws("-", half(1), half(16)).alias("fingerprint"))


def content_digest(rows: DataFrame, key: Sequence[str], name: str = "name", sha: str = "sha256") -> DataFrame:
    """(key, files, digest): SHA-256 over each key's (name, hash) rows whatever their order, in two levels.

    Rows are parted by the first three digits of their name's hash, the sorted lines of each part are digested, then the at most 4,097 digests of
    a key. So a task holds a 4,096th of a key, unlike a digest of one long list, and unlike ``content_fingerprint`` other rows of the
    same digest can't be made. Null and empty names or hashes differ; repeated rows count as often as they are there.
    """
    of = lambda c: F.coalesce(F.sha2(F.col(c).cast("string"), 256), F.lit("-"))
    d = rows.select(*key, of(name).alias("_n"), of(sha).alias("_s"))
    parts = d.groupBy(*key, F.substring("_n", 1, 3).alias("_part")).agg(F.count("*").alias("files"), F.sha2(F.array_join(F.sort_array(F.collect_list(F.concat_ws(":", "_n", "_s"))), "\n"), 256).alias("_d"))
    whole = F.sha2(F.array_join(F.sort_array(F.collect_list(F.concat_ws(":", "_part", "_d"))), "\n"), 256)
    return parts.groupBy(*key).agg(F.sum("files").alias("files"), whole.alias("digest"))


@F.pandas_udf(T.StringType())
def canonical_json(text: pd.Series) -> pd.Series:
    """JSON with sorted names, no spaces and characters as they are; null for null, broken JSON, NaN and infinities."""

    def strict(name: str) -> None:
        raise ValueError(name)

    def one(x: str | None) -> str | None:
        try:
            return None if x is None else json.dumps(json.loads(x, parse_constant=strict), sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False).encode().decode()
        except (ValueError, RecursionError):
            return None

    return text.map(one)


def document_digest(documents: DataFrame, text: str = "document", declared: str | None = None) -> DataFrame:
    """``documents`` with digest, the SHA-256 of their canonical JSON, and violation.

    With ``declared`` the document's own field of that name holds its digest and is left out of what is digested; another value, or none, is the
    violation ``digest``. What isn't a strict JSON document has no digest and the violation ``not_json``. With ``declared``, what is no object is ``not_an_object``.
    """
    d = documents.withColumn("_whole", canonical_json(F.col(text)))
    if declared is None:
        return d.withColumn("digest", F.sha2("_whole", 256)).withColumn("violation", F.when(F.col("_whole").isNull(), "not_json")).drop("_whole")
    own = F.get_json_object("_whole", f"$['{declared}']")
    d = d.withColumn("digest", F.sha2(without_field(F.col("_whole"), F.lit(declared)), 256))
    bad = F.when(F.col("_whole").isNull(), "not_json").when(F.col("digest").isNull(), "not_an_object").when(~own.eqNullSafe(F.col("digest")), "digest")
    return d.withColumn("violation", bad).drop("_whole")


@F.pandas_udf(T.StringType())
def without_field(text: pd.Series, name: pd.Series) -> pd.Series:
    """Canonical JSON objects without one field; null for what is no object."""

    def one(x: str | None, n: str) -> str | None:
        d = None if x is None else json.loads(x)
        return json.dumps({k: v for k, v in d.items() if k != n}, sort_keys=True, separators=(",", ":"), ensure_ascii=False) if isinstance(d, dict) else None

    return pd.Series([one(x, n) for x, n in zip(text, name, strict=True)], dtype=object)


def pixel_lineage(stages: DataFrame, order: Sequence[str], key: Sequence[str] = ("video_id",)) -> DataFrame:
    """Names of each stage's frames that the stage before lacks, or whose declared source hash differs: key, stage, name, violation.

    stages: key, stage, name, sha256, source_sha256.
    """
    before = dict(zip(order[1:], order[:-1], strict=True))
    prior = F.create_map(*[F.lit(x) for kv in before.items() for x in kv])[F.col("stage")]
    d = stages.withColumn("prior", prior).where("prior IS NOT NULL")
    p = stages.select(*key, F.col("stage").alias("prior"), "name", F.col("sha256").alias("prior_sha"))
    d = d.join(p, [*key, "prior", "name"], "left")
    return d.withColumn("violation", F.when(F.col("prior_sha").isNull(), "no_source").when(F.col("prior_sha") != F.col("source_sha256"), "source_hash")).where("violation IS NOT NULL").select(*key, "stage", "name", "violation")


def order_by_contract(cameras: DataFrame, contract: DataFrame, key: Sequence[str] = ("run_id",)) -> DataFrame:
    """Cameras with the contract's ordinal by file stem; status ordered, extra, missing or duplicate."""
    stem = lambda c: F.regexp_replace(F.regexp_replace(c, r"^.*/", ""), r"\.[^.]*$", "")
    c = cameras.withColumn("stem", stem(F.col("name"))).groupBy(*key, "stem").agg(F.count("*").alias("_n"), F.min("name").alias("name"))
    k = contract.withColumn("stem", stem(F.col("name"))).select(*key, "stem", "ord")
    d = c.join(k, [*key, "stem"], "full_outer")
    return d.withColumn("status", F.when(F.col("ord").isNull(), "extra").when(F.col("_n").isNull(), "missing").when(F.col("_n") > 1, "duplicate").otherwise("ordered")).drop("_n")
