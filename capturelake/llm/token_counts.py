"""Token counts of a unigram tokenizer by dynamic programming over a trie of distinct pre-tokens.

The best segmentation of a pre-token's prefix depends on that prefix alone. So distinct pre-tokens are put into a trie whose
nodes hold the forward score and token count of their prefix: a prefix that many words share is scored
once, and a word's count is read at its last node. Each worker process grows its own trie over the texts of its tasks, and remembers
the terminal counts; nothing is shuffled. The trie, and apart from it the counts, are dropped and begun anew when they are large, which changes no count.

Vocabulary: the pieces of a public SentencePiece model, read from a file. That model is a BPE without probabilities,
so a piece of rank r is scored ``-ln(r + 1)``, Zipf's law. Characters without a piece fall back to one token per
UTF-8 byte, each at ``BYTE_SCORE``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

BYTE_SCORE = -30.0
MARK = "▁"
#: Nodes of a trie and remembered words of a worker process. Longer pre-tokens than LONG characters don't enter it.
NODES, WORDS, LONG = 600_000, 400_000, 1_000


def load_pieces(path: str) -> dict[str, float]:
    """Piece -> score: -ln(rank + 1) in the file's order of scores; control, unknown and byte pieces are left out."""
    from sentencepiece import SentencePieceProcessor

    p = SentencePieceProcessor(model_file=path)
    ids = [i for i in range(p.get_piece_size()) if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i) or p.is_unused(i))]
    ids.sort(key=lambda i: (-p.get_score(i), i))
    return {p.id_to_piece(i): -math.log(rank + 1) for rank, i in enumerate(ids, 1)}


class Trie:
    """Nodes are numbers; a node's score and token count are those of the best segmentation of its prefix.

    Pieces are a tree of their own. The piece beginnings that a prefix ends with are carried along a new branch, so a node costs a step for
    each of the few that go on, and not a look-up for every length of a piece.
    """

    def __init__(self, pieces: dict[str, float]):
        self.pieces, self.longest = pieces, max(map(len, pieces), default=1)
        self.root: dict = {}
        for piece, score in pieces.items():
            at = self.root
            for c in piece:
                at = at.setdefault(c, {})
            at[""] = score
        self.words: dict[str, int] = {}
        self.clear()

    def clear(self) -> None:
        self.next: dict[tuple[int, str], int] = {}
        self.score, self.count = [0.0], [0]

    def __call__(self, plain: str) -> int:
        """Tokens of the best segmentation of a pre-token; among equal scores the one with the longest last piece."""
        word = MARK + plain
        if len(word) > LONG:
            return self.alone(word)
        if len(self.score) > NODES:
            self.clear()
        if len(self.words) > WORDS:
            self.words = {}
        node, path, end = 0, [0], 0
        for c in word:  # what other words share
            found = self.next.get((node, c))
            if found is None:
                break
            node = found
            path.append(node)
            end += 1
        if end < len(word):
            self._branch(word, path, end)
        self.words[plain] = self.count[path[-1]]
        return self.words[plain]

    def _branch(self, word: str, path: list[int], end: int) -> None:
        """New nodes for ``word`` from place ``end`` on."""
        score, count, root = self.score, self.count, self.root
        begun = []  # (score, count, place among the pieces) of the piece beginnings that word[:end] ends with, longest first
        for start in range(max(0, end - self.longest + 1), end):
            at = root
            for c in word[start:end]:
                at = at.get(c)
                if at is None:
                    break
            else:
                begun.append((score[path[start]], count[path[start]], at))
        for c in word[end:]:
            node = path[-1]
            begun.append((score[node], count[node], root))
            best, n, on = -math.inf, 0, []
            for before, tokens, at in begun:
                at = at.get(c)
                if at is not None:
                    on.append((before, tokens, at))
                    s = at.get("")
                    if s is not None and before + s > best:
                        best, n = before + s, tokens + 1
            begun = on
            if c not in self.pieces:
                k = len(c.encode("utf-8", "surrogatepass"))
                if score[node] + k * BYTE_SCORE > best:
                    best, n = score[node] + k * BYTE_SCORE, count[node] + k
            self.next[node, c] = len(score)
            path.append(len(score))
            score.append(best)
            count.append(n)

    def alone(self, word: str) -> int:
        """Tokens of a very long pre-token: the same recurrence, of which only the last ``longest`` places are held."""
        places = [(0.0, 0)]
        for end, c in enumerate(word, 1):
            best, n = -math.inf, 0
            for k, (score, count) in enumerate(places):
                s = self.pieces.get(word[end - len(places) + k : end])
                if s is not None and score + s > best:
                    best, n = score + s, count + 1
            if c not in self.pieces:
                k = len(c.encode("utf-8", "surrogatepass"))
                if places[-1][0] + k * BYTE_SCORE > best:
                    best, n = places[-1][0] + k * BYTE_SCORE, places[-1][1] + k
            places.append((best, n))
            del places[: -self.longest]
        return places[-1][1]


_TRIES: dict[str, Trie] = {}


def trie_of(vocabulary: str) -> Trie:
    """The trie of this worker process; its tasks go on with it."""
    if vocabulary not in _TRIES:
        _TRIES[vocabulary] = Trie(load_pieces(vocabulary))
    return _TRIES[vocabulary]


def count_tokens(docs: DataFrame, vocabulary: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, n_pretokens, n_tokens) of every whole text.

    Pre-tokens are runs without white space, each with a mark for the space before it. Null, empty and blank
    texts have none of either. Rows are counted one by one, also if they repeat; an empty table gives no rows.
    """

    def run(batches):
        trie = trie_of(vocabulary)
        for b in slices(batches, 1):
            n, total = [], []
            for t in b.column(1).to_pylist():
                words = t.split() if t else []
                n.append(len(words))
                own = list(map(trie.words.get, words))
                if None in own:
                    own = [(trie.words.get(w) or trie(w)) if c is None else c for w, c in zip(words, own, strict=True)]
                total.append(sum(own))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(total, pa.int64())], ["doc_id", "n_pretokens", "n_tokens"])

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, n_pretokens long, n_tokens long")


def brute_force(word: str, pieces: dict[str, float]) -> int:
    """Tokens of one pre-token by plain dynamic programming; what tests compare with."""
    score, count = np.full(len(word) + 1, -math.inf), [0] * (len(word) + 1)
    score[0] = 0
    for end in range(1, len(word) + 1):
        for start in range(end):
            s, n = pieces.get(word[start:end]), 1
            if s is None and start == end - 1:
                n = len(word[start].encode("utf-8", "surrogatepass"))
                s = n * BYTE_SCORE
            if s is not None and score[start] + s > score[end]:
                score[end], count[end] = score[start] + s, count[start] + n
    return count[-1]
