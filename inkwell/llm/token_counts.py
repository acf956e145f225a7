"""Token counts under a unigram vocabulary, by dynamic programming shared along a trie of pre-tokens.

Pre-tokens are the white-space separated words behind the word mark. A task inserts those of a slice of its texts that it has not
met before in a trie, once each. A node's forward score (best sum of piece scores of any way to cut the path to it, and with it
the fewest pieces) depends on its ancestors only, so it is computed once for all pre-tokens that share the prefix, along a second trie, of the pieces from their ends; a pre-token's count is read
at its terminal. Counts of pre-tokens met are kept in a bounded memo, then looked up and summed per text. No shuffle; the vocabulary has a fixed
size.

The vocabulary is a parameter: pieces with log-probabilities, or a sentencepiece model's path. A unigram model's scores are taken as they are. The scores of a
BPE model are no probabilities but (negated) merge ranks, in order of falling frequency; its pieces get the log-probabilities of the Zipf-Mandelbrot law over that rank,
``1 / (rank + SHIFT)``, normalised. Nothing is trained. Counts are those of this unigram model, not of the BPE merges. A character outside the pieces
costs its UTF-8 bytes (byte pieces), each at ``UNKNOWN`` below the lowest score.

Defined results: null, empty and blank texts have 0 tokens; repeated rows are counted row by row; null ids are kept.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, table

MARK = "▁"
UNKNOWN = 10.0
SHIFT = 2.7
MEMO = 400_000
_loaded: dict[str, Vocabulary] = {}  # noqa: F821


def _is_unigram(scores: list[float]) -> bool:
    """Whether scores can be log-probabilities. Those of a BPE model are whole numbers, one lower for each merge."""
    return any(s != int(s) for s in scores)


def zipf(scores: dict[str, float], shift: float = SHIFT) -> dict[str, float]:
    """Log-probabilities of the Zipf-Mandelbrot law over the ranks of falling scores."""
    order = sorted(scores, key=lambda p: (-scores[p], p))
    total = math.log(sum(1 / (r + shift) for r in range(len(order))))
    return {p: -math.log(r + shift) - total for r, p in enumerate(order)}


class Vocabulary:
    def __init__(self, pieces: dict[str, float]):
        self.pieces = pieces
        self.endings: dict = {}  # a trie of the pieces from their ends; "" holds the score
        for p, score in pieces.items():
            node = self.endings
            for c in reversed(p):
                node = node.setdefault(c, {})
            node[""] = score
        self.unknown = min(pieces.values(), default=0.0) - UNKNOWN
        self.memo: dict[str, int] = {}

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        scores = {sp.id_to_piece(i): sp.get_score(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))}
        return cls(scores if _is_unigram(list(scores.values())) else zipf(scores))


class Trie:
    """Of pre-tokens; each node holds the score of the best way to cut the path to it, and its pieces (the fewest of equal scores)."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.children: list[dict[str, int]] = [{}]
        self.score: list[float] = [0.0]
        self.count: list[int] = [0]

    def insert(self, word: str) -> int:
        """The pieces of the word."""
        node, scores, counts = 0, [0.0], [0]
        children, endings, unknown = self.children, self.vocabulary.endings, self.vocabulary.unknown
        for i, c in enumerate(word):
            after = children[node].get(c)
            if after is None:
                n = 1 if c < "\x80" else len(c.encode("utf-8", "replace"))
                top, least = scores[i] + n * unknown, counts[i] + n
                ending, j = endings.get(c), i
                while ending is not None:  # pieces that end here, from the shortest
                    s = ending.get("")
                    if s is not None and (s := scores[j] + s) >= top and (s > top or counts[j] + 1 < least):
                        top, least = s, counts[j] + 1
                    if not j:
                        break
                    j -= 1
                    ending = ending.get(word[j])
                after = children[node][c] = len(children)
                children.append({})
                self.score.append(top)
                self.count.append(least)
            node = after
            scores.append(self.score[node])
            counts.append(self.count[node])
        return counts[-1]


def count_tokens(docs: DataFrame, *, vocabulary: str | dict[str, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_pretokens, n_tokens. vocabulary: a model's path, or pieces with scores."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if isinstance(vocabulary, str):
            v = _loaded.get(vocabulary) or _loaded.setdefault(vocabulary, Vocabulary.load(vocabulary))
        else:
            v = Vocabulary(vocabulary)
        for part in chunks(batches, "text", 2 << 20):
            words = [(t or "").split() for t in part.column("text").to_pylist()]
            new = set().union(*words).difference(v.memo)
            if len(v.memo) + len(new) > MEMO:
                v.memo = {}
                new = set().union(*words)
            trie = Trie(v)
            for w in new:
                v.memo[w] = trie.insert(MARK + w)
            get = v.memo.__getitem__
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array([len(w) for w in words], pa.int64()), pa.array([sum(map(get, w)) for w in words], pa.int64())], ["id", "n_pretokens", "n_tokens"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, f"id {kind}, n_pretokens long, n_tokens long").withColumnRenamed("id", id_col)


def brute_force(text: str, pieces: dict[str, float]) -> int:
    """Tokens of a short text by trying all cuts of each word, for tests."""
    unknown = min(pieces.values()) - UNKNOWN

    def best(word: str) -> tuple[float, int]:
        if not word:
            return (0.0, 0)
        n = len(word[0].encode())
        s, c = best(word[1:])
        out = [(s + n * unknown, c - n)]
        for j in range(1, len(word) + 1):
            if word[:j] in pieces:
                s, c = best(word[j:])
                out.append((s + pieces[word[:j]], c - 1))
        return max(out)

    return sum(-best(MARK + w)[1] * k for w, k in Counter(text.split()).items())


def op9_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), vocabulary=public_tokenizers.path("piece_bpe_32k.model"))
