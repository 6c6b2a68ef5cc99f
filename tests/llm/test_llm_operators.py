"""Edge cases of every operator: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from capturelake.llm import common, decontamination, language_id, mixing, near_dedup, quality, token_counts, token_output, unit_dedup, url_filter, vector_search  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def make(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def odd_docs(spark):
    """Null, empty, blank, very long and repeated texts, a null id, and columns that operators use for themselves."""
    words = [f"w{i}" for i in range(3000)]
    rows = [(1, None, "en", "a", None), (2, "", "en", "a", 0), (3, " \n\t ", None, None, 3), (4, " ".join(words * 10), "en", "b", 1), (5, "hello, world.", "en", "a", 1), (5, "hello, world.", "en", "a", 1), (None, "no id here at all, my friend", "de", "b", 1), (6, "ünïcödé ẞ 日本語 😀 \x00 x", "fr", None, 1)]
    d = make(spark, rows)
    for c in ("key", "kept", "size", "removed", "start", "digest", "rank", "label", "id"):
        d = d.withColumn(c, F.lit("clash"))
    return d


def prose(rng, n, words=400):
    return " ".join(rng.choice(VOCAB) for _ in range(n))


VOCAB = ["".join(random.Random(i).choice("abcdefghij") for _ in range(2 + i % 6)) for i in range(600)]


# 1


def test_decontamination_finds_items_and_paraphrases(spark):
    rng = random.Random(1)
    items = [(i, prose(rng, 40) + ".") for i in range(12)] + [(98, None), (99, "")]
    rows, want = [], set()
    for i in range(150):
        words = prose(rng, 120).split()
        if i % 10 == 0:
            item = items[i // 10 % 12]
            own = item[1].split()
            if i % 20 == 0:  # a paraphrase: every ninth word is another one
                own = [w if k % 9 else rng.choice(VOCAB) for k, w in enumerate(own)]
            words[50:50] = own
            want.add((i, item[0]))
        rows.append((i, " ".join(words), "en", "a", 1))
    docs, bench = make(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.matches(docs, bench).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    assert got == want, (got ^ want, found[:3])
    left = {r.doc_id for r in decontamination.without_matches(docs, bench).collect()}
    assert left == {r[0] for r in rows} - {d for d, _ in want}


def test_decontamination_edges(spark):
    bench = spark.createDataFrame([(1, "one two three four five six seven")], "item_id long, text string")
    assert decontamination.matches(odd_docs(spark), bench).count() == 0
    assert decontamination.matches(odd_docs(spark), bench.limit(0)).count() == 0
    assert decontamination.matches(make(spark, []), bench).count() == 0


def test_decontamination_without_answer_and_in_other_scripts(spark):
    rng = random.Random(14)
    words = prose(rng, 40)
    greek = " ".join("".join(chr(945 + (ord(c) - 97)) for c in w) for w in prose(rng, 40).split())
    bench = spark.createDataFrame([(1, f"{words}. End."), (2, greek)], "item_id long, text string")
    rows = [(i, f"{prose(rng, 60)} {own} {prose(rng, 60)}", "en", "a", 1) for i, own in enumerate((words, greek, "", words.replace(" ", "\u201d\u2014\u201c")))]
    got = {(r.doc_id, r.item_id) for r in decontamination.matches(make(spark, rows), bench).collect()}
    assert got == {(0, 1), (1, 2), (3, 1)}


def lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def test_lcs_against_plain_dynamic_programming():
    rng = random.Random(5)
    for _ in range(60):
        a, b = [rng.choice("abcdefg") for _ in range(rng.randint(1, 25))], [rng.choice("abcdefg") for _ in range(rng.randint(0, 40))]
        item = decontamination.Item(1, " ".join(a), " ".join(a))
        code = dict(zip(a, item.words, strict=True))
        got = item.covered([code.get(x, -1) for x in b])[0]
        want = lcs(a, b) / len(a)
        assert got == want or (got == 0 and len(set(a) & set(b)) and sum(x in b for x in a) < decontamination.COVER * len(a)) or want == 0


def test_decontamination_equals_brute_force(spark):
    """All pairs of documents and items by plain dynamic programming over every stretch, for items of many lengths."""
    rng, items, rows, planted = random.Random(21), [], [], Counter()
    for n, length in enumerate((6, 7, 8, 10, 12, 15, 24, 40, 60, 120)):
        items += [(10 * n + j, prose(rng, length)) for j in range(3)]
    for i in range(90):
        words = prose(rng, 150).split()
        if i < 60:
            item = items[i % 30]
            own = item[1].split()
            if i >= 30:  # paraphrases: one word of six is another one, except in the answer's three
                own = [rng.choice(VOCAB) if k % 6 == 2 and k < len(own) - 3 else w for k, w in enumerate(own)]
            words[70:70] = own
            planted[i, item[0]] = len(own)
        rows.append((i, " ".join(words), "en", "a", 1))
    got = {(r.doc_id, r.item_id) for r in decontamination.matches(make(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = set()
    for item_id, text in items:
        item = text.split()
        n = len(item)
        span, least, tail = n + max(4, n // 2), 0.6 + 0.4 * 0.6 * min(max(15 - n, 0) / 9, 1), item if n < 3 or "." not in text else item[-3:]
        for doc_id, body, *_ in rows:
            words = body.split()
            if lcs(item, [w for w in words if w in set(item)]) < least * n:
                continue
            for at in range(0, len(words) - span + 1, max(1, n // 8)):
                share = lcs(item, words[at : at + span]) / n
                if share >= least and (share >= 0.8 or lcs(tail, words[at : at + span]) >= 0.5 * len(tail)):
                    want.add((doc_id, item_id))
                    break
    exact = {k for k in planted if k[0] < 30}
    assert exact <= got, exact - got
    assert len(want & got) >= 0.9 * len(want) and len(got - want) <= 1, (want - got, got - want)
    assert got <= set(planted), got - set(planted)


def test_half_windows_are_shared_rightly():
    rng = np.random.default_rng(7)
    ends = np.cumsum([0, 1, 24, 25, 48, 49, 72, 73, 300, 24, 0, 24])
    bucket, basis = rng.integers(0, 50, ends[-1]), np.append(rng.integers(0, 9, (50, 3)), np.zeros((1, 3), int), 0)
    doc, first, end = decontamination._passages(ends)
    assert (decontamination._embed(bucket, basis, first, end) == [basis[bucket[a:e]].sum(0) for a, e in zip(first, end, strict=True)]).all()
    assert all(end[doc == d].max() == ends[d] for d in set(doc.tolist()))


def test_word_hashes_from_bytes():
    import pyarrow as pa

    long = ["a" * 5000 + "b", "a" * 5000 + "c", "a" * 5000 + "b"]
    texts = ["one two, two.three", None, "", "x", "ünï cödé-x _a1 ", "  ", "a" * 50 + " b" * 30, *long]
    common.STEP, old = 40, common.STEP
    for _ in range(2):
        common._TABLES.clear()
        h, ends = common.word_hashes(pa.array(texts))
        words = [re.findall(r"[a-z0-9_\u0080-\U0010ffff]+", t or "") for t in texts]
        assert np.diff(ends, prepend=0).tolist() == [len(w) for w in words]
        flat = [w for s in words for w in s]
        assert len(set(h.tolist())) == len(set(flat)) == len(set(zip(flat, h.tolist(), strict=True)))
        common.STEP = old
    common._TABLES.clear()


# 2


def test_language_code_lengths_are_probabilities():
    rng = np.random.default_rng(2)
    text = bytes(rng.choice(list(b"abcd e"), 4000)) * 2
    data = np.frombuffer(text, np.uint8)
    p1, p2, p3 = (p.astype(np.int64) for p in language_id._grams(data, np.array([0])))
    key3, key4 = (p2 << 16) | (p1 << 8) | data, (p3 << 24) | (p2 << 16) | (p1 << 8) | data
    k3, n3 = np.unique(key3, return_counts=True)
    k4, n4 = np.unique(key4, return_counts=True)
    c = language_id.Coder(language_id.Counts("x", ["en"], (np.zeros(len(k4), int), k4, n4), (np.zeros(len(k3), int), k3, n3)))
    p = np.exp2(-c.bits[:, 0].astype(float)).reshape(-1, c.a)
    times = np.ones(c.a)
    times[-1] = 256 - (c.a - 1)
    assert np.allclose((p * times).sum(1), 1, atol=1e-4)
    # Vectorised code lengths equal those of one byte after the other, also over step ends.
    language_id.STEP, old = 1000, language_id.STEP
    parts = [text[:1500], b"", b"a", text[1500:4000]]
    offsets = np.cumsum([0, *map(len, parts)])
    got = c.lengths(np.frombuffer(b"".join(parts), np.uint8), offsets)[:, 0]
    language_id.STEP = old
    for part, bits in zip(parts, got, strict=True):
        want, back = 0.0, b"   " + part
        for i in range(len(part)):
            a, b, d = (int(c.code[x]) for x in back[i : i + 3])
            want += c.bits[int(c.row[(a * c.a + b) * c.a + d]) * c.a + int(c.code[part[i]]), 0]
        assert bits == pytest.approx(want, rel=1e-5)


def test_language_id(spark, data_dir):
    docs = spark.read.parquet(f"{data_dir}/documents.parquet")
    counts = language_id.learn(docs.select(F.col("doc_id").alias("id"), "text", "lang"))
    got = language_id.identify(docs, counts).join(docs.select("doc_id", "lang"), "doc_id").where(language_id.held_out(F.col("doc_id")))
    assert got.where("lang = lang_pred").count() / got.count() > 0.95
    odd = {r.doc_id: r for r in language_id.identify(odd_docs(spark), counts).collect()}
    assert odd[1].lang_pred == odd[2].lang_pred == odd[3].lang_pred == "und" and odd[4].lang_pred != "und" and 0 < odd[4].score <= 1
    none = language_id.learn(make(spark, []).select(F.col("doc_id").alias("id"), "text", "lang"))
    assert {r.lang_pred for r in language_id.identify(odd_docs(spark), none).collect()} == {"und"}


def plain_bits(train, text):
    """Code length of a text under prediction by partial matching, symbol by symbol, from counts in plain dicts."""
    orders = [defaultdict(lambda: defaultdict(Counter)) for _ in range(4)]
    total = Counter()
    for lang, texts in train:
        data = b"   " + texts
        for i in range(3, len(data)):
            for k in range(4):
                orders[k][lang][data[i - k : i]][data[i]] += 1
            total[data[i - 3 : i]] += 1
    memo = {}

    def p(lang, context, k):
        if (lang, context[3 - k :], k) not in memo:
            lower = [1 / 256] * 256 if k == 0 else p(lang, context, k - 1)
            seen = orders[k][lang].get(context[3 - k :], Counter()) if k < 3 or total[context] >= language_id.NODE_COUNT else Counter()
            n, d = sum(seen.values()), len(seen)
            left = sum(x for b, x in enumerate(lower) if b not in seen)
            memo[lang, context[3 - k :], k] = lower if not n else [seen[b] / (n + d) if b in seen else d / (n + d) * x / left for b, x in enumerate(lower)]
        return memo[lang, context[3 - k :], k]

    data = b"   " + text
    return {lang: -sum(math.log2(p(lang, data[i - 3 : i], 3)[data[i]]) for i in range(3, len(data))) for lang in dict(train)}


def test_language_id_equals_plain_ppm(spark):
    rng = random.Random(17)
    kinds = {"aa": VOCAB[:200], "bb": VOCAB[150:400], "cc": ["ü" + w for w in VOCAB[300:420]]}
    rows = [(i, " ".join(rng.choice(kinds[k]) for _ in range(25)), k) for i, k in enumerate(rng.choice(sorted(kinds)) for _ in range(60))]
    docs = spark.createDataFrame(rows, "id long, text string, lang string")
    taught = [(k, t.encode()) for i, t, k in rows if zlib.crc32(str(i).encode()) % 5]
    counts = language_id.learn(docs)
    probes = [(100 + i, " ".join(rng.choice(kinds[rng.choice(sorted(kinds))]) for _ in range(6))) for i in range(12)] + [(200, "Zz ñ.")]
    got = {r.doc_id: r for r in language_id.identify(spark.createDataFrame(probes, "doc_id long, text string"), counts).collect()}
    for i, text in probes:
        want = plain_bits(taught, text.encode())
        best = min(sorted(want), key=want.get)
        assert got[i].lang_pred == best and abs(got[i].bits_per_byte - want[best] / len(text.encode())) < 1e-3
        assert abs(got[i].score - 1 / sum(2 ** max(want[best] - x, -1000) for x in want.values())) < 1e-3


# 3


def test_huffman_codes():
    rng = np.random.default_rng(3)
    for n, limit in ((1, 16), (2, 16), (300, 9), (5000, 16)):
        counts = np.zeros(1 << 16, np.int64)
        counts[rng.choice(1 << 16, n, replace=False)] = (1.0 / rng.random(n) ** 4).astype(np.int64) + 1
        lengths = token_output.code_lengths(counts, limit)
        used = lengths[counts > 0].astype(int)
        assert used.min() >= 1 and used.max() <= limit and not lengths[counts == 0].any()
        assert sum(2.0**-used) <= 1 + 1e-12
        if n == 300:  # optimal where the limit doesn't bind
            import heapq

            h = [int(c) for c in counts[counts > 0]]
            heapq.heapify(h)
            total = 0
            while len(h) > 1:
                x = heapq.heappop(h) + heapq.heappop(h)
                total += x
                heapq.heappush(h, x)
            assert (token_output.code_lengths(counts, 16)[counts > 0].astype(int) * counts[counts > 0]).sum() >= total
        ids = rng.choice(np.flatnonzero(counts), 1000).astype(np.uint16)
        codes, table = token_output.canonical_codes(lengths), token_output.decode_table(lengths)
        blocks = [ids[:1], ids[1:400], ids[400:400], ids[400:]]
        packed = [token_output.pack(b, lengths, codes) for b in blocks]
        back = token_output.unpack([p[0] for p in packed], [p[1] for p in packed], np.array([len(b) for b in blocks]), table)
        assert (back == ids).all()


def test_pieces_equal_whole_texts():
    import pyarrow as pa

    known, rng = token_output.Pieces(BPE), random.Random(4)
    assert known.by_pieces
    known.BITS, known.AT_ONCE = 9, 7
    known.clear()
    parts = ["a", "the", "B", ",", ".", "!", " ", "  ", "\n", "\t", "1", "é", "ß", "'s", "’", "<|endoftext|>", "\u00a0", "日本", "\r", "_", "$$", " x", "\n\n", "😀", "\x1c", " word", " other", "\nline"]
    for _ in range(60):
        texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(50)]
        got = known.of(pa.array(texts))
        for t, ids in zip(texts, got, strict=True):
            assert ids.tolist() == known.encode(t), repr(t)


def test_codes_of_large_vocabularies():
    rng = np.random.default_rng(1)
    counts = np.zeros(200_000, np.int64)
    counts[rng.choice(200_000, 70_000, replace=False)] = rng.integers(1, 1000, 70_000)
    lengths = token_output.code_lengths(counts)
    assert lengths.max() <= 20 and np.sum(2.0 ** -lengths[lengths > 0].astype(float)) <= 1
    ids = rng.choice(np.flatnonzero(counts), 1000)
    checkpoints, bits = token_output.pack(ids, lengths, token_output.canonical_codes(lengths))
    assert (token_output.unpack([checkpoints], [bits], np.array([1000]), token_output.decode_table(lengths)) == ids).all()


@pytest.mark.parametrize("empty", [False, True])
def test_token_files_round_trip(spark, empty):
    from tokenizers import Tokenizer

    docs = odd_docs(spark).limit(0) if empty else odd_docs(spark)
    path = token_output.new_folder(spark)
    token_output.write_tokens(docs, path, BPE)
    got = sorted(token_output.read_tokens(spark, path).collect(), key=lambda r: r.start)
    t, at = Tokenizer.from_file(BPE), 0
    want = sorted(docs.select("doc_id", "text").collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))  # equal ids have equal texts
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        ids = [*t.encode(w.text or "", add_special_tokens=False).ids, 2]
        assert (g.doc_id, g.start, g.n_tokens, g.ids) == (w.doc_id, at, len(ids), ids)
        assert g.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)


# 4


def test_units_keep_offsets_and_first_occurrence(spark):
    passage = "This passage of quite a few words is in several documents. It has a second sentence of some length, too!"
    one = f"Own text one two three four five. {passage} End of the first one here, really."
    two = f"{passage.upper()}\nAnother line which nobody else has at all."
    rows = [(1, one, "en", "a", 1), (2, two, "en", "a", 1), (3, "Short. Short. Short.", "en", "a", 1), (4, None, "en", "a", 1), (5, "", "en", "a", 1), (2, two, "en", "a", 1), (None, two, "en", "a", 1)]
    docs = make(spark, rows)
    for c in ("digest", "row", "doc", "removed", "clean_text", "words"):
        docs = docs.withColumn(c, F.lit("x"))
    texts = {r[0]: r[1] for r in rows}
    got = unit_dedup.repeated_units(docs, "sentence", 20).collect()
    found = Counter((r.doc_id, texts[r.doc_id][r.start : r.end].strip(), r.keep_doc_id) for r in got)
    first, second = "THIS PASSAGE OF QUITE A FEW WORDS IS IN SEVERAL DOCUMENTS.", "IT HAS A SECOND SENTENCE OF SOME LENGTH, TOO!"
    line = "Another line which nobody else has at all."
    assert found == Counter({(2, first, 1): 2, (2, second, 1): 2, (2, line, 2): 1, (None, first, 1): 1, (None, second, 1): 1, (None, line, 2): 1})
    every = Counter((r.doc_id, r.unit_no) for r in unit_dedup.repeated_units(docs, "sentence").collect())
    assert every[3, 1] == every[3, 2] == 1 and (3, 0) not in every
    lines = {(r.doc_id, texts[r.doc_id][r.start : r.end]) for r in unit_dedup.repeated_units(docs, "line").collect()}
    assert lines == {(d, x) for d in (2, None) for x in two.split("\n")}
    clean = [(r.doc.doc_id, r.clean_text, len(r.removed)) for r in unit_dedup.cleaned(docs, "line").collect()]
    assert Counter(clean) == Counter([(1, one, 0), (2, two, 0), (2, "\n", 2), (3, texts[3], 0), (4, None, 0), (5, "", 0), (None, "\n", 2)])
    assert unit_dedup.cleaned(docs).select("doc.*").columns == docs.columns
    assert unit_dedup.repeated_units(make(spark, [])).count() == 0


# 5


def test_trie_counts_equal_plain_dynamic_programming(spark):
    pieces = token_counts.load_pieces(PIECES)
    trie, rng = token_counts.Trie(pieces), random.Random(6)
    words = ["".join(rng.choice("abcdeßé日x😀") for _ in range(rng.randint(1, 12))) for _ in range(400)] + ["the", "and", "thenation"]
    for w in words:
        assert trie(w) == token_counts.brute_force(token_counts.MARK + w, pieces), w
    got = {r.doc_id: (r.n_pretokens, r.n_tokens) for r in token_counts.count_tokens(odd_docs(spark), PIECES).collect()}
    assert got[1] == got[2] == got[3] == (0, 0) and got[4][0] == 30000
    assert got[5] == (2, sum(token_counts.brute_force(token_counts.MARK + w, pieces) for w in ("hello,", "world.")))
    assert token_counts.count_tokens(make(spark, []), PIECES).count() == 0


def test_long_words_need_no_trie():
    rng = random.Random(3)
    trie = token_counts.Trie(token_counts.load_pieces(PIECES))
    for n in (1, 40, 1500):
        word = "".join(rng.choice("abcdeé日") for _ in range(n))
        assert trie.alone(token_counts.MARK + word) == token_counts.brute_force(token_counts.MARK + word, trie.pieces) == trie(word)


# 6


@pytest.mark.parametrize("literal_words", [url_filter.LITERAL_WORDS, 4])
def test_cascade_is_exact(spark, literal_words):
    u = spark.range(5000).select(F.concat(F.lit("host"), "id", F.lit(".org")).alias("key"), (F.xxhash64("id") % 5 == 0).alias("listed"))
    pages = u.select(F.concat(F.lit("http://"), "key", F.lit("/x?y")).alias("url"), F.col("listed").alias("want"))
    url_filter.SHARD_KEYS, old = 100, url_filter.SHARD_KEYS
    got = url_filter.judge_urls(pages, listed=u.where("listed").select("key"), literal_words=literal_words)
    assert got.where("want <> (verdict = 'block')").count() == 0 and got.count() == 5000
    url_filter.SHARD_KEYS = old


def test_urls(spark):
    cases = {
        None: ("", "", None, "allow"), "": ("", "", None, "allow"), "no scheme/x": ("", "", None, "allow"), "http://A.Example.COM/en/1?x#y": ("a.example.com", "/en/1", "example.com/en/", "block"), "http://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        "http://x.www.example.com/en/q": ("x.www.example.com", "/en/q", "www.example.com/en/", "allow"), "http://b.com?q": ("b.com", "", None, "allow"), "http://b.com/": ("b.com", "/", "com/", "allow"), "x://ÀB.net/es/#z": ("Àb.net", "/es/", "net/es/", "block"), "http://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
        "http://free-bets.example.org/": ("free-bets.example.org", "/", None, "block"), "http://a.org://b/c": ("a.org:", "//b/c", None, "allow"), "http://": ("", "", None, "allow"),
    }
    d = spark.createDataFrame([(u, "clash") for u in cases], "url string, host string")
    got = {r.url: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(d, is_listed=url_filter.spam_host(F.col("key"))).collect()}
    assert got == cases
    assert url_filter.judge_urls(d.limit(0)).count() == 0


# 7


def test_vector_search_equals_brute_force(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.integers(-3, 4, 5).astype(float).tolist(), "clash") for i in range(700)] + [(700, None, ""), (800, [1.0, float("nan"), 0.0, 0.0, 0.0], ""), (900, [1.0, None, 0.0, 0.0, 0.0], ""), (None, [9.0] * 5, ""), (1000, [1.0, 2.0], ""), (1100, [], "")]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    vector_search.SHARD_ROWS, old = 150, vector_search.SHARD_ROWS
    got = defaultdict(list)
    for r in vector_search.nearest(d).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    vector_search.SHARD_ROWS = old
    v = {r[0]: [math.floor(1024 * x) for x in r[1]] for r in rows[:700]}
    for q in range(0, 700, 100):
        best = sorted(((-sum(a * b for a, b in zip(v[q], v[k], strict=True)), k) for k in v if k != q))[:10]
        assert got[q] == [(k, -s) for s, k in best]
    assert set(got) == set(range(0, 700, 100))
    big = spark.createDataFrame([(0, [1e9, 3.0]), (1, [2e3, 5.0]), (2, [2e3, 6.0])], "vec_id long, embedding array<double>")
    assert [(r.vec_id, r.score) for r in vector_search.nearest(big).orderBy("rank").collect()] == [(k, int(1024 * 1e9) * 2048000 + 3072 * c) for k, c in ((2, 6144), (1, 5120))]
    assert vector_search.nearest(d.limit(0)).count() == 0
    twice = spark.createDataFrame([(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [2.0, 1.0]), (2, [1.0, 3.0])], "vec_id long, embedding array<double>")
    got = Counter((r.query_id, r["rank"], r.vec_id, r.score >> 20) for r in vector_search.nearest(twice).collect())
    assert got == Counter([(0, 1, 1, 2), (0, 2, 2, 1), (0, 3, 0, 0), (0, 1, 2, 3), (0, 2, 1, 1), (0, 3, 0, 0)])


# 8


def test_quality(spark, data_dir):
    docs, labels = spark.read.parquet(f"{data_dir}/documents.parquet"), spark.read.parquet(f"{data_dir}/labels.parquet")
    r = quality.resample(docs, labels).join(labels, "doc_id")
    share = {x.quality: x.s for x in r.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("s")).collect()}
    assert share[1] > 0.97 and share[0] < 0.2
    k = quality.resample(docs, labels, k=17).where("kept")
    assert k.count() == 17
    got = quality.resample(odd_docs(spark), labels.limit(0)).collect()
    assert len(got) == 8 and all(x.kept for x in got) and {x.log_weight for x in got if x.doc_id in (1, 2, 3)} == {0.0}
    assert quality.resample(make(spark, []), labels).count() == 0


def test_quality_equals_plain_resampling(spark):
    rng = random.Random(23)
    rows = [(i, prose(rng, 60) if i % 3 else " ".join(["!!"] * 5 + [str(rng.random()) for _ in range(40)]), "en", "a", 1) for i in range(80)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(40)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.resample(make(spark, rows), labels, k=30).collect()}
    n = quality.BUCKETS
    counts = {}
    for i, text, *_ in rows:
        words = text.split()
        shape = [re.sub(r"(.)\1+", r"\1+", "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in w)) for w in words]
        h, g = [zlib.crc32(w.encode()) for w in words], [zlib.crc32(x.encode()) & 0x7FFFFFFF for x in shape]
        counts[i] = Counter((x * 0x9E3779B1 >> 13) % n for x in h) + Counter(n + (7 if a == b else ((c * 31 + d) * 0x9E3779B1 >> 11) % n) for a, b, c, d in zip(h, h[1:], g, g[1:]))
    raw, target = sum(counts.values(), Counter()), sum((counts[i] for i in range(40) if i % 3), Counter())
    half = lambda c, k: sum(v for x, v in c.items() if x // n == k)
    sums = [(half(raw, k), half(target, k)) for k in (0, 1)]

    def ratio(b):
        r, t = sums[b // n]
        prior, strength = raw[b] / r, 2 * n
        return math.log((target[b] + strength * prior + 1e-9) / (t + strength)) - math.log((raw[b] + strength * prior + 1e-9) / (r + strength))

    noisy = {}
    for i, c in counts.items():
        weight = sum(v * ratio(b) for b, v in c.items())
        assert abs(got[i].log_weight - weight) < 1e-6
        import hashlib

        u = (int(hashlib.md5(f"gumbel-1:{i}".encode()).hexdigest()[:13], 16) + 0.5) / (1 << 52)
        noisy[i] = weight - math.log(-math.log(u))
    assert {i for i, r in got.items() if r.kept} == set(sorted(noisy, key=noisy.get)[-30:])


def test_top_k_cut_with_ties(spark):
    d = spark.createDataFrame([(i, float(i % 7)) for i in range(6000)], "id long, gumbel double")
    for k in (1, 857, 858, 3000, 5999):
        at, last = quality.top_k_cut(d, k)
        assert d.where((F.col("gumbel") > at) | ((F.col("gumbel") == at) & (F.col("id") <= last))).count() == k


# 9


def plain_classes(texts, least=0.8):
    """Class of each text (its least place) from all pairs, with shingles as tuples of words."""
    bags = []
    for t in texts:
        words = re.findall(r"\w+", (t or "").lower())
        words += [""] * (5 - len(words)) if words else []
        bags.append(Counter(zip(*[words[k:] for k in range(5)], strict=False)))
    df = Counter(x for bag in bags for x in bag)
    weigh = {x: 1 + min(1, math.log(len(texts) / n) / math.log(1000)) / 2 for x, n in df.items()}
    parent, links = list(range(len(texts))), set()

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(bags):
        for j, b in enumerate(bags[:i]):
            if a and b:
                low, high = (sum(f(a[x], b[x]) * weigh[x] for x in a.keys() | b.keys()) for f in (min, max))
                if low >= least * high:
                    links.add((j, i))
                    x, y = sorted((find(i), find(j)))
                    parent[y] = x
    return [find(i) for i in range(len(texts))], links


def families(rng):
    """Texts of many kinds: copies, edits, and a template with two clusters that are near each other but near no hub."""
    texts = []
    for _ in range(15):
        base = prose(rng, rng.choice([30, 120, 300])).split()
        for _ in range(rng.choice([1, 2, 6])):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                own[rng.randrange(len(own))] = rng.choice(VOCAB)
            texts.append(" ".join(own))
    base = prose(rng, 200).split()
    for i in range(40):  # pages of one template, below the limit to each other, each with a near copy
        own = list(base)
        for k in rng.sample(range(5, 190, 5), 5):
            own[k] = f"v{i}"
        texts.append(" ".join(own))
        own[rng.randrange(200)] = f"w{i}"
        texts.append(" ".join(own[: 200 - i % 5]))
    return texts


@pytest.mark.parametrize(("per_member", "rounds"), [(16, 4), (0.001, 4), (0.001, 1)])
def test_near_dedup_equals_brute_force(spark, monkeypatch, per_member, rounds):
    monkeypatch.setattr(near_dedup, "PAIRS_PER_MEMBER", per_member)
    monkeypatch.setattr(near_dedup, "HUB_ROUNDS", rounds)
    texts = families(random.Random(9)) + ["one two", "One two!", None, "", "", "one two", " ?! "]
    docs = make(spark, [(i, t, "en", "a", 1) for i, t in enumerate(texts)])
    want, links = plain_classes(texts)
    got = {r.doc_id: r.class_id for r in near_dedup.classes(docs).collect()}
    assert len(links) > 60 and [got[i] for i in range(len(texts))] == want


def test_near_dedup_rows_without_and_with_repeated_ids(spark):
    rng = random.Random(3)
    a, b = prose(rng, 60), prose(rng, 60)
    rows = [(7, a), (7, b), (None, a), (3, a + " end"), (None, b), (7, b), (None, "alone in the world here"), (None, None), (1, None), (1, None), (2, "")]
    docs = make(spark, [(i, t, "en", "a", 1) for i, t in rows])
    for c in ("row", "doc", "node", "label", "class", "text_a"):
        docs = docs.withColumn(c, F.lit("x"))
    got = Counter((r.doc_id, r.class_id, r.rep_id) for r in near_dedup.classes(docs).collect())
    want = [(7, 3, 7), (7, 7, 7), (None, 3, 7), (3, 3, 3), (None, 7, 7), (7, 7, 7), (None, None, None), (None, None, None), (1, 1, 1), (1, 1, 1), (2, 2, 2)]
    assert got == Counter(want)
    left = near_dedup.one_of_each(docs)
    assert left.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in left.collect()) == Counter([(3, a + " end"), (7, b), rows[6], (None, None), (1, None), (1, None), (2, "")])
    assert near_dedup.classes(make(spark, [])).count() == 0 == near_dedup.one_of_each(make(spark, [])).count()


def test_hub_rounds_find_the_same_classes(spark, monkeypatch):
    rng, rows = random.Random(10), []
    base = prose(rng, 200).split()
    for i in range(90):  # most pairs of variants are below the limit, each is near the base
        own = list(base)
        for k in rng.sample(range(200), 2 if i else 0):
            own[k] = f"v{i}"
        rows.append((i, " ".join(own), "en", "a", 1))
    monkeypatch.setattr(near_dedup, "PAIRS_PER_MEMBER", 0.001)
    assert {r.class_id for r in near_dedup.classes(make(spark, rows)).collect()} == {0}


def test_prefix_pairs_miss_no_near_pair(spark):
    texts = families(random.Random(13))
    d = spark.createDataFrame(list(enumerate(texts)), "node long, text string")
    weights = near_dedup.inverse_frequencies(d.select(common.plain_words(F.col("text"))), len(texts))
    got = {tuple(r) for r in near_dedup.prefix_pairs(d.select("node", F.col("node").alias("class")), d, weights, 0.8).distinct().collect()}
    want = plain_classes(texts)[1]
    assert len(want) >= 40 and want <= got and len(got) < len(texts) * (len(texts) - 1) // 4


def test_samples_collide_as_often_as_texts_are_similar():
    import pyarrow as pa

    rng, hits, want = random.Random(11), [], []
    for _ in range(12):
        base = prose(rng, 400).split()
        s = near_dedup.Shingles(pa.array([" ".join(base), " ".join(base[:360] + prose(rng, 40).split())]))
        w = s.tf * 1.0
        want.append(near_dedup.similarity(*[(s.h[s.doc == i], w[s.doc == i]) for i in (0, 1)]))
        got = near_dedup.sample(s, w, 2)
        hits.append((got[0] == got[1]).mean())
    assert abs(np.mean(hits) - np.mean(want)) < 0.05


# 10


def test_mix(spark):
    rng = random.Random(12)
    rows = [(i, " ".join(["word"] * rng.randint(1, 40)), "en", rng.choice(["a"] * 6 + ["b", "c", "d", None]), 1) for i in range(2500)] + [(9000, None, "en", "a", 1), (9001, "", "en", "empty", 1)]
    docs = make(spark, rows).withColumn("key", F.lit(0)).withColumn("bucket", F.lit(0))
    got = mixing.mix(docs).collect()
    size, source = {r[0]: len((r[1] or "").split()) for r in rows}, {r[0]: r[3] for r in rows}
    assert len(got) == len(rows) and all(r["size"] == size[r.doc_id] and r.taken <= 3 * r["size"] for r in got)
    sums, taken, target = Counter(), Counter(), {}
    for r in got:
        sums[source[r.doc_id]] += r["size"]
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
    names = sorted(sums, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    want, free, left = {}, set(names), sum(sums.values())
    while True:  # share, cap, share the excess again
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * sums[s]}
        if not over:
            want |= share
            break
        for s in over:
            want[s] = 3.0 * sums[s]
            left -= want[s]
        free -= over
    assert target == pytest.approx(want)
    assert all(abs(taken[s] - want[s]) <= 40 for s in names)
    assert sorted(map(tuple, mixing.mix(docs).collect())) == sorted(map(tuple, got))
    times = Counter(r.doc_id for r in mixing.mixed_documents(docs).collect())
    assert times == Counter({r.doc_id: r.taken // r["size"] for r in got if r.taken})
    assert mixing.mix(make(spark, [])).count() == 0 and mixing.mix(odd_docs(spark)).count() == 8


def test_mixed_documents_with_null_and_repeated_ids(spark):
    rows = [(None, f"null id number {i}", "en", "a", i) for i in range(5)] + [(7, "some words of a", "en", "a", 10), (7, "", "en", "a", 11), (7, "other words here", "en", "b", 12), (7, "more words of c now", "en", "c", 13)]
    docs = make(spark, rows)
    # n_chars tells rows apart that share an id.
    want = sum(r.taken for r in mixing.mix(docs).collect())
    out = mixing.mixed_documents(docs).collect()
    assert sum(len(r.text.split()) for r in out) == want and any(r.doc_id is None for r in out)
    assert all(r.text for r in out) and mixing.mixed_documents(docs).columns == docs.columns


def test_latent_products_hold_all_passages(spark):
    """Texts of all lengths about a window's and one of more than a lot of halves, against plain sums over passages."""
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{k}" for k in rng.zipf(1.4, n) % 300) for n in (1, 23, 24, 25, 48, 49, 72, 500, decontamination.STRIDE * (decontamination.HALVES + 900) + 7)]
    words = decontamination.word_buckets(spark.createDataFrame([(t,) for t in [*texts, "", " . "]], "text string"))
    idf, q = decontamination.idf_weights(words), rng.standard_normal((decontamination.BUCKETS, 3))
    rows, want = [np.frombuffer(r.x, np.uint16) for r in words.collect()], np.zeros(q.shape)
    assert len(rows) == len(texts)
    for x in rows:
        for a, z in zip(*decontamination._passages(np.array([len(x)]))[1:], strict=True):
            at, n = np.unique(x[a:z], return_counts=True)
            row = n * idf[at] / np.linalg.norm(n * idf[at])
            want[at] += np.outer(row, row @ q[at])
    got = decontamination.Product(words.select("x", F.lit(1.0).alias("scale")), idf)(q)
    assert np.abs(got - want).max() < 1e-4 * np.abs(want).max()


def test_latent_basis_is_of_all_documents(spark):
    """Of 12,000 documents 40 have six words of their own each: all of these documents are directions of the basis."""
    rare = [" ".join(f"r{i}x{j}" for j in range(6)) for i in range(40)]
    words = decontamination.word_buckets(spark.range(11_960).select(F.lit("common words only").alias("text")).unionByName(spark.createDataFrame([(t,) for t in rare], "text string")))
    own = decontamination.word_buckets(spark.createDataFrame([("an item",)], "text string"))
    basis = decontamination.latent_basis(words, own, decontamination.idf_weights(words))
    h, ends = common.word_hashes(pa.array(rare))
    v = decontamination._normal(basis[decontamination._buckets(h)]).reshape(40, 6, -1)
    assert (v @ v[:, :1].transpose(0, 2, 1) > 0.9).mean() > 0.9  # but for words that share a bucket
