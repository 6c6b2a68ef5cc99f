"""URL filters: longest host/path rule first, then exact membership in a host list by a Bloom filter cascade.

Level 1 encodes the listed keys; level 2 the other keys of the universe that level 1 wrongly holds; level 3
the listed keys that level 2 wrongly holds; and so on until no key is wrong. As the levels are built over the
corpus's complete key universe, walking them answers exactly for every key of the corpus.

All of it is DataFrame functions. Bits are gathered as 64-bit words. Small cascades become array literals of the
expression, so pages are judged without any join. Above ``LITERAL_WORDS`` the keys are dealt into shards of
bounded size and a page meets the filters of its shard only, by an equi join on the shard number.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

BITS_PER_KEY, HASHES = 12, 4
#: 2 MB of filter at most in an expression.
LITERAL_WORDS = 1 << 18
#: Keys of a shard where there are more.
SHARD_KEYS = 2_000

#: Keys of the query's list: hosts with a spam label, and those with more than so many times the mean number of pages of a host.
FLOOD = 3

# The rules of the contract (host and path prefix, verdict), and spam labels for tests.
RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")]
SPAM_LABELS = ["adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm"]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*(/[^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits a host or a parent of it and starts the path, and its verdict; else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: len(r[0])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def _places(key: Column, level: int, bits: int) -> list[Column]:
    a, b = F.xxhash64(key, F.lit(2 * level)), F.xxhash64(key, F.lit(2 * level + 1))
    return [F.pmod(F.pmod(a, F.lit(bits).cast("long")) + i * F.pmod(b, F.lit(bits).cast("long")), F.lit(bits).cast("long")) for i in range(HASHES)]


def _holds(words: Column, key: Column, level: int, bits: int) -> Column:
    """Whether all bits of the key are set in a level's words."""
    out = F.lit(True)
    for p in _places(key, level, bits):
        bit = p.bitwiseAND(F.lit(63).cast("long")).cast("int")
        out = out & (F.getbit(F.get(words, F.shiftright(p, 6).cast("int")), bit) == 1)
    return out


def _words(keys: DataFrame, level: int, bits: int, shards: DataFrame) -> DataFrame:
    """(shard, words): the level's filter of each shard as a dense array."""
    place = keys.select("shard", F.explode(F.array(*_places(F.col("key"), level, bits))).alias("p"))
    # 1 << 63 is negative, as wanted: words are taken as 64 bits without a sign.
    set_bits = place.select("shard", F.shiftright("p", 6).cast("int").alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), F.col("p").bitwiseAND(F.lit(63).cast("long")).cast("int")).alias("bits"))
    empty = shards.select("shard", F.explode(F.sequence(F.lit(0), F.lit(bits // 64 - 1))).alias("word"), F.lit(0).cast("long").alias("bits"))
    each = set_bits.unionByName(empty).groupBy("shard", "word").agg(F.bit_or("bits").alias("bits"))
    return each.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("w")).select("shard", F.col("w.bits").alias("words"))


@dataclass
class Cascade:
    """``levels``: (bits, words as literals or None) in order; ``filters``: (shard, l1, l2, ...) where sharded."""

    shards: int
    levels: list[tuple[int, list[int] | None]]
    filters: DataFrame | None = None

    def shard(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key, F.lit(-7)), F.lit(self.shards)).cast("int")

    def contains(self, key: Column) -> Column:
        """Membership of a key of the universe. Where sharded, the row must carry its shard's filters l1, l2, ..."""
        out = F.lit(len(self.levels) % 2 == 1)
        for n in range(len(self.levels), 0, -1):
            bits, words = self.levels[n - 1]
            column = F.col(f"l{n}") if words is None else F.split(F.lit(",".join(map(str, words))), ",").cast("array<bigint>")
            out = F.when(_holds(column, key, n, bits), out).otherwise(F.lit(n % 2 == 0))
        return out


def build_cascade(universe: DataFrame, literal_words: int = LITERAL_WORDS) -> Cascade:
    """Of (key, listed), one row per key. Each level is built over what the level before it got wrong.

    An empty list gives no level and contains nothing. The number of levels grows with the logarithm of the list.
    """
    n = universe.where("listed").count()
    if not n:
        return Cascade(1, [])
    sharded = n * BITS_PER_KEY // 64 > literal_words // 2
    cascade = Cascade(max(1, n // SHARD_KEYS) if sharded else 1, [])
    known = universe.select("key", "listed", cascade.shard(F.col("key")).alias("shard"))
    shards = universe.sparkSession.range(cascade.shards).select(F.col("id").cast("int").alias("shard"))
    known = staged(known, "cascade-keys")
    wrong, other = known.where("listed"), known.where("NOT listed")
    size = n
    while size:
        level = len(cascade.levels) + 1
        bits = 64 * max(1, -(-size * BITS_PER_KEY // (64 * cascade.shards)))
        words = _words(wrong, level, bits, shards)
        if sharded:
            words = staged(words.withColumnRenamed("words", f"l{level}"), "cascade-level")
            cascade.filters = words if cascade.filters is None else staged(cascade.filters.join(words.hint("merge"), "shard"), "cascade-levels")
            cascade.levels.append((bits, None))
            hit = other.join(words.hint("merge"), "shard").where(_holds(F.col(f"l{level}"), F.col("key"), level, bits)).select(*other.columns)
        else:
            cascade.levels.append((bits, words.first()["words"]))
            column = F.split(F.lit(",".join(map(str, cascade.levels[-1][1]))), ",").cast("array<bigint>")
            hit = other.where(_holds(column, F.col("key"), level, bits))
        hit = staged(hit, "cascade-wrong")
        wrong, other, size = hit, wrong, hit.count()
    return cascade


def judge_urls(pages: DataFrame, listed: DataFrame | None = None, is_listed: Column | None = None, rules: list[tuple[str, str]] | None = None, url: str = "url", literal_words: int = LITERAL_WORDS) -> DataFrame:
    """``pages`` with host, path, rule and verdict; columns of those names are replaced.

    A rule decides first, the longest that fits; else hosts of the list are blocked and others allowed. The list is
    a table with a column ``key`` of hosts, or ``is_listed``, a condition on ``key`` over the corpus's hosts.
    Null urls and urls without ``://`` have an empty host and path, fit no rule and are allowed; an empty host
    is never a key. Repeated urls are judged alike; an empty table gives no rows.
    """
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    # The page's columns travel as one, so that none can clash with the filters'.
    d = pages.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("page"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    keys = d.where("host <> ''").select(F.col("host").alias("key")).distinct()
    if is_listed is not None:
        universe = keys.withColumn("listed", is_listed)
    elif listed is not None:
        names = listed.where("key IS NOT NULL").select("key").distinct().withColumn("listed", F.lit(True))
        universe = keys.join(names.hint("merge"), "key", "left").withColumn("listed", F.coalesce("listed", F.lit(False)))
    else:
        universe = keys.withColumn("listed", F.lit(False))
    cascade = build_cascade(universe, literal_words)
    rule, verdict = rule_of(F.col("host"), F.col("path"), RULES if rules is None else rules)
    if cascade.filters is not None:
        # A row without a host needs no filter: such rows are dealt evenly.
        anywhere = F.pmod(F.monotonically_increasing_id(), F.lit(cascade.shards)).cast("int")
        d = d.withColumn("shard", F.when(F.col("host") == "", anywhere).otherwise(cascade.shard(F.col("host"))))
        d = d.join(cascade.filters.hint("merge"), "shard", "left")
    blocked = (F.col("host") != "") & cascade.contains(F.col("host"))
    return d.select("page.*", "host", "path", rule.alias("rule"), F.coalesce(verdict, F.when(blocked, "block").otherwise("allow")).alias("verdict"))


def spam_host(key: Column) -> Column:
    """Hosts with one of the spam labels as a name part."""
    return F.arrays_overlap(F.split(key, r"\."), F.array(*map(F.lit, SPAM_LABELS)))


def bad_hosts(pages: DataFrame, url: str = "url") -> DataFrame:
    """(key): the corpus's hosts with a spam label or very many pages."""
    hosts = pages.select(host_of(F.col(url)).alias("key")).where("key <> ''").groupBy("key").agg(F.count("*").alias("n"))
    total = hosts.agg(F.sum("n").alias("pages"), F.count("*").alias("hosts")).first()
    return hosts.where(spam_host(F.col("key")) | (F.col("n") * F.lit(total["hosts"]) > F.lit(FLOOD * (total["pages"] or 0)))).select("key")


ORACLE = r"""
WITH u AS (
  SELECT page_id,
    translate(CASE WHEN url LIKE '%://%' THEN regexp_extract(url, '^.*?://([^/?#]*)', 1, 's') ELSE '' END, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    CASE WHEN url LIKE '%://%' THEN regexp_extract(url, '^.*?://[^/?#]*(/[^?#]*)', 1, 's') ELSE '' END AS path FROM pages),
r AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule FROM u),
n AS (SELECT host, count(*) AS n FROM u WHERE host <> '' GROUP BY 1),
b AS (SELECT host FROM n WHERE n * (SELECT count(*) FROM n) > 3 * (SELECT sum(n) FROM n) OR list_has_any(string_split(host, '.'), ['adult-x', 'ads-track', 'casino-win', 'cheap-pills', 'free-bets', 'spam-farm']))
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('www.example.com/en/', 'com/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN host IN (SELECT host FROM b) THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""
