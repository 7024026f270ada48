"""Token counts of a unigram tokenizer, without building its tokens.

An Aho-Corasick automaton lists every vocabulary piece that ends at each character, longest first; dynamic programming keeps, per
character, the best score of a segmentation that ends there and its number of pieces. Ties go to the longest last
piece, as the tokenizer's strict comparison over ascending starts has it; a character that no one-character
piece covers costs the lowest score less ten and counts one token for each of its UTF-8 bytes.

No piece holds a space mark after another character, so a text falls apart before each such mark and equal words are counted once a worker.
Vocabulary and scores come from a tokenizer's model file; nothing is trained. Defined cases: null and empty texts have no tokens;
equal ids and repeated rows are kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm.common import stretches

MODEL = "piece_bpe_32k.model"
MARK = "▁"
UNKNOWN = 10.0
CACHED = 300_000
#: Ends a word in the automaton's input; never part of a word, as texts are cut at it.
STOP = "\x00"
_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> dict[str, float]:
    """Pieces and scores of a model file: neither control, unknown nor byte pieces. Scores of unused pieces are the lowest of the others."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(m.get_piece_size()) if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))]
    got = {m.id_to_piece(i): m.get_score(i) for i in ids}
    low = min(v for v in got.values() if v > -1e8)
    return {k: max(v, low) for k, v in got.items()}


def marked(text: str | None) -> str:
    """The tokenizer's form of a text: a mark before it, and a mark for each space."""
    return MARK + text.replace(" ", MARK) if text else ""


class Counter:
    """Numbers of pieces of words under a vocabulary."""

    def __init__(self, pieces: dict[str, float]):
        import ahocorasick

        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("a piece holds a space mark after another character: texts don't fall apart at marks")
        self.auto = ahocorasick.Automaton()
        for p, s in pieces.items():
            self.auto.add_word(p, (len(p), s))
        self.auto.make_automaton()
        self.single = {p for p in pieces if len(p) == 1}
        self.unknown = min(pieces.values()) - UNKNOWN
        self.cache: dict[str, int] = {}

    def solve(self, words: list[str]) -> None:
        """Count new words, all in one pass of the automaton."""
        joined = STOP + STOP.join(words) + STOP
        n, none = len(joined), float("-inf")
        # score and count at i are those of the best segmentation of the word up to and with character i
        score, count = [none] * n, [0] * n
        odd = [i for i, c in enumerate(joined) if c not in self.single and c != STOP]
        ends = [i for i, c in enumerate(joined) if c == STOP]
        for i in ends:
            score[i] = 0.0
        k = 0
        for end, (size, value) in self.auto.iter(joined):
            while k < len(odd) and odd[k] < end:
                self.skip(joined, odd[k], score, count)
                k += 1
            before = end - size
            got = score[before] + value
            if got > score[end]:
                score[end], count[end] = got, count[before] + 1
        for i in odd[k:]:
            self.skip(joined, i, score, count)
        for a, w in zip(ends[1:], words):
            self.cache[w] = count[a - 1]

    def skip(self, joined: str, i: int, score: list[float], count: list[int]) -> None:
        """The one-character unknown piece at ``i``: the last start, so it must beat what is there."""
        got = score[i - 1] + self.unknown
        if got > score[i]:
            score[i], count[i] = got, count[i - 1] + len(joined[i].encode())

    def count(self, text: str | None) -> int:
        words = _WORD.findall(marked(text))
        new = set(words).difference(self.cache)
        if new:
            if len(self.cache) + len(new) > CACHED:
                self.cache.clear()
                new = set(words)
            apart = [w for w in new if STOP not in w]
            self.solve(apart)
            for w in new.difference(apart):
                self.cache[w] = self.odd(w)
        return sum(map(self.cache.__getitem__, words))

    def odd(self, word: str) -> int:
        """A word with the stop character in it, which no piece holds: counted piecewise around it."""
        parts = word.split(STOP)
        self.solve([p for p in parts if p])
        return sum(self.cache[p] for p in parts if p) + len(parts) - 1


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None, pieces: dict[str, float] | None = None) -> DataFrame:
    """``(id, n_tokens)`` for every row, under the pieces of a model file or ``pieces`` themselves."""
    path = model or (None if pieces else default_model())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = Counter(pieces or vocabulary(path))
        for b in batches:
            for i, n in stretches(b.column(1)):
                part = b.slice(i, n)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([c.count(t) for t in part.column(1).to_pylist()], pa.int64())], ["id", "n_tokens"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, n_tokens long")


def op4_counts(spark, sf_dir: str) -> DataFrame:
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(F.col("id").alias("doc_id"), "n_tokens")
