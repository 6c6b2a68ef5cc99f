"""Periodic runs against all lags tried in plain code, and odd texts."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")

from capturelake.llm import periodic_runs as pr  # noqa: E402
from capturelake.llm.entry import QUERIES  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def plain(w, times=4, shortest=6):
    out = []
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            run = w[i : j + q]
            if j > i and len(run) >= max(shortest, times * q) and all(run[r:] != run[:-r] for r in range(1, q)):
                out.append((i, len(run), q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_of_few_words(spark):
    rng = random.Random(3)
    for _ in range(1500):
        docs = []
        for _ in range(rng.randint(1, 4)):
            w = []
            for _ in range(rng.randint(0, 5)):
                w += ([rng.randint(0, rng.randint(1, 3)) for _ in range(rng.randint(1, 9))] * rng.randint(1, 8))[: rng.randint(1, 60)]
            docs.append(w)
        times, shortest = rng.choice([(4, 6), (3, 6), (4, 20), (5, 1), (4, 9)])
        ends, want = np.cumsum([len(d) for d in docs]), []
        for d, end in zip(docs, ends.tolist(), strict=True):
            want += [(end - len(d) + s, n, q) for s, n, q in plain(d, times, shortest)]
        assert pr.find_runs(np.array([x for d in docs for x in d], np.int64), ends, times, shortest) == want


def answer(i, text):
    """The row that the query owes, by plain code."""
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(w), zlib.crc32(str(i).encode()) if i is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
    runs = plain(w)
    gone = {k for s, length, q in runs for k in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (i, len(runs), *best, 1000 * best[1] // best[2] if runs else None, digest("".join(f"{s},{length},{q}\n" for s, length, q in runs)), digest(" ".join(x for k, x in enumerate(w) if k not in gone)))


NAMES = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_against_plain_code(spark, data_dir):
    docs = spark.read.parquet(f"{data_dir}/documents.parquet").collect()
    got = QUERIES["op13_periodic_runs"](spark, data_dir).select(*NAMES).collect()
    want = [answer(r.doc_id, r.text) for r in docs]
    assert sorted(map(tuple, got)) == sorted(want) and sum(r[1] for r in want) > 5


def test_odd_texts(spark):
    rng = random.Random(9)
    unit = " ".join(f"w{rng.randint(0, 40)}" for _ in range(700))
    texts = [None, "", " \n\t ", "a a a a a", "a a a a a a", "a\x0ba\x0ca\ra\na\ta", "x y x y x y x y", "é é é é é é ü", "a a a a a a a a a a a a", "😀 😀 b " * 9, "ends", "ends", "a" * 100_000 + " " + unit, (unit + "\n") * 5, "word " * 60_000, " ".join(f"n{k}" for k in range(30_000))]
    rows = [(i, t, "en", "a", 1) for i, t in enumerate(texts)] + [(None, "b b b b b b b", None, None, None), (3, texts[3], "en", "a", 1), (3, texts[3], "en", "a", 1)]
    rows += [(i, " ".join(rng.choice("abcde") for _ in range(rng.randint(1, 80))), None, None, None) for i in range(100, 400)]
    d = spark.createDataFrame(rows, DOCS)
    for c in ("id", "words", "h", "runs", "best", "start", "length", "collapsed"):
        d = d.withColumn(c, F.lit("clash"))
    got = pr.digests(pr.periodic_runs(pr.planted(d.repartition(3)))).select(*NAMES).collect()
    cheap = {(i, t): answer(i, t) for i, t, *_ in rows if not t or len(t) < 10_000}
    assert sorted((tuple(r) for r in got if (r[0], ) not in {(12,), (13,), (14,), (15,)}), key=str) == sorted((cheap[i, t] for i, t, *_ in rows if (i, t) in cheap), key=str)
    long = {r.doc_id: r for r in pr.periodic_runs(d.where("doc_id in (12, 13, 14, 15)")).collect()}
    assert [[tuple(x) for x in long[i].runs] for i in (12, 13, 14, 15)] == [[], [(0, 3500, 700)], [(0, 60_000, 1)], []]
    assert long[12].collapsed == texts[12] and long[13].collapsed == unit and long[14].collapsed == "word" and long[15].n_words == 30_000
    assert pr.digests(pr.periodic_runs(pr.planted(d.limit(0)))).count() == 0
    # Texts are whole whatever the slices they come in.
    assert pr.periodic_runs(d.where("doc_id is null")).first().collapsed == "b"
