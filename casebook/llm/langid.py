"""Language identification of mixed-language text.

Each word is scored under every learned language by smoothed counts of its character n-grams. The word's script narrows
the candidates to languages seen in that script. A Viterbi search over the words, with a penalty for each switch, labels
spans; a text's language is that of most letters. For a text on which no run of words can gain more than half the
penalty over its best single language (largest subarray sums, taken for all texts of a batch at once) the search's result is
that language; the others are searched word by word, all texts of a batch side by side.

The model is learned from about ``SAMPLE`` rows of each language (by a hash of the id) out of the rows whose fold is
learned from; predictions cover every row and see only the text. Defined cases: null texts and texts without a letter are
``und`` with score 0 and no spans; with nothing learned every text is; equal ids and repeated rows are kept.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm.common import fold, stretches
from casebook.llm.fitting import per_class

SAMPLE = 1500
BITS = 16
#: Numbers in a model at most, as a power of two: beyond 256 languages their n-grams share fewer buckets.
MODEL_BITS = 24
#: Prior of the state without a language in ``keep_identified``.
UNKNOWN = 0.01
#: In units of word scores, which are mean log-likelihoods of a word's n-grams times ``SCALE``.
SWITCH = 12.0
SCALE = 2.0
CACHED = 200_000
#: New words that are scored at once.
LEARN = 20_000
_WORD = re.compile(r"[^\W\d_]+")

#: First code points of script ranges, and the script that each begins (0: common).
RANGES = ((0x0000, 0), (0x0041, 1), (0x0370, 2), (0x0400, 3), (0x0530, 4), (0x0590, 5), (0x0600, 6), (0x0700, 0), (0x0900, 7), (0x0980, 8), (0x0E00, 9), (0x0E80, 0), (0x10A0, 10), (0x1100, 11), (0x1200, 12), (0x1380, 0), (0x1E00, 1), (0x1F00, 2), (0x2000, 0), (0x3040, 13), (0x3130, 11), (0x3190, 0), (0x3400, 14), (0xA000, 0), (0xAC00, 11), (0xD800, 0), (0xF900, 14), (0xFB00, 1), (0xFB50, 6), (0xFE00, 0), (0xFE70, 6), (0xFF00, 0), (0x20000, 14), (0x30000, 0))
SCRIPTS = 15
_FIRST = np.array([a for a, _ in RANGES], np.int64)
_SCRIPT = np.array([b for _, b in RANGES], np.int8)


def grams(words: list[str], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """``(word index, bucket)`` of the 2-, 3- and 4-grams of words with a mark on either side."""
    code = np.frombuffer(("\n" + "\n".join(words) + "\n").encode("utf-32-le"), np.uint32).astype(np.uint64)
    edge = code == 10
    owner = np.cumsum(edge) - 1
    at, bucket = [], []
    h = code.copy()
    for n in (2, 3, 4):
        h = h[:-1] * np.uint64(1_000_003) + code[n - 1 :]
        ok = np.ones(len(h), bool)
        for k in range(1, n - 1):
            ok &= ~edge[k : k + len(h)]
        mixed = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(n)
        at.append(owner[: len(h)][ok])
        bucket.append(((mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - bits)).astype(np.int64)[ok])
    return np.concatenate(at), np.concatenate(bucket)


def scripts(words: list[str]) -> np.ndarray:
    """Script of each word's first letter that has one."""
    first = np.fromiter((ord(w[0]) for w in words), np.int64, len(words))
    return _SCRIPT[np.searchsorted(_FIRST, first, "right") - 1]


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", size: int = SAMPLE) -> dict:
    """Log-likelihoods of n-gram buckets and the scripts of each language; counted on the executors, at most 2**MODEL_BITS numbers a task."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("id"), 3) != 1))
    picked, rates = per_class(rows, "lang", size)
    langs = sorted(rates)
    if not langs:
        return {"langs": []}
    number = {k: i for i, k in enumerate(langs)}
    bits = min(BITS, MODEL_BITS - (len(langs) - 1).bit_length())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(langs), 1 << bits), np.float32)
        seen = np.zeros((len(langs), SCRIPTS))
        for b in batches:
            for t, name in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                c = Counter(_WORD.findall(t.lower()))
                if c:
                    words, n, k = list(c), np.fromiter(c.values(), float), number[name]
                    at, bucket = grams(words, bits)
                    total[k] += np.bincount(bucket, weights=n[at], minlength=1 << bits)
                    seen[k] += np.bincount(scripts(words), weights=n, minlength=SCRIPTS)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary()), pa.array([seen.astype(np.float32).tobytes()], pa.binary())], ["total", "seen"])

    total, seen = np.zeros((len(langs), 1 << bits), np.float32), np.zeros((len(langs), SCRIPTS))
    for r in picked.select("text", "lang").repartition(4).mapInArrow(run, "total binary, seen binary").toLocalIterator():  # a bounded sample
        total += np.frombuffer(r.total, np.float32).reshape(total.shape)
        seen += np.frombuffer(r.seen, np.float32).reshape(seen.shape)
    smooth = total + 0.5
    usual = np.log(smooth / smooth.sum(1, keepdims=True))
    prior = np.array([(total[i].sum() + 1) / rates[k] for i, k in enumerate(langs)])
    return {"langs": langs, "logp": usual.T.astype(np.float32).copy(), "bits": bits, "prior": np.log(prior / prior.sum()), "scripts": seen >= 0.01 * np.maximum(seen.sum(1, keepdims=True), 1)}


def best_run(gain: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per text, the largest sum of ``gain`` over a run of its words (0: the empty run); text i's words are ``first[i]:first[i + 1]``."""
    n = len(first) - 1
    total = np.r_[0, np.cumsum(gain)]
    rows = np.diff(first) + 1
    begin = np.r_[0, np.cumsum(rows)[:-1]]
    text = np.repeat(np.arange(n), rows)
    # a fall from text to text keeps earlier texts out of the running minimum
    level = total[np.arange(rows.sum()) - text] - text * (np.ptp(total) + 1)
    return np.maximum.reduceat(level - np.minimum.accumulate(level), begin)


def room(model: dict) -> int:
    """Bytes of text that are labelled at once: fewer where each word has many scores."""
    return max(1 << 14, (8 << 20) // max(8, len(model["langs"])))


def with_unknown(model: dict) -> dict:
    """The model with one more state, the last: text of no learned language, in which all buckets are alike and every script is at home."""
    if not model["langs"]:
        return model
    flat = np.full((len(model["logp"]), 1), -model["bits"] * np.log(2), np.float32)
    return model | {
        "langs": [*model["langs"], None], "logp": np.concatenate([model["logp"], flat], 1), "prior": np.r_[model["prior"] + np.log1p(-UNKNOWN), np.log(UNKNOWN)],
        "scripts": np.concatenate([model["scripts"], np.ones((1, SCRIPTS), bool)]),
    }


class Labeller:
    """Spans of a batch of texts under a fitted model."""

    def __init__(self, model: dict):
        self.m = model
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.scores, self.letters = np.zeros((0, len(self.m["langs"])), np.float32), np.zeros(0, np.int64)

    def learn(self, words: list[str]) -> None:
        """Add scores of new words."""
        at, bucket = grams(words, self.m["bits"])
        n = np.bincount(at, minlength=len(words))
        s = np.stack([np.bincount(at, weights=c, minlength=len(words)) for c in self.m["logp"][bucket].T.astype(np.float64)], 1)
        s *= SCALE / n[:, None]
        sc = scripts(words)
        allowed = self.m["scripts"][:, sc].T
        s = np.where(allowed | ~allowed.any(1, keepdims=True), s, s.min(1, keepdims=True) - 3 * SWITCH)
        letters = np.fromiter((len(w) if any(map(str.isalpha, w)) else 0 for w in words), np.int64, len(words))
        s[letters == 0] = 0
        self.number.update(zip(words, range(len(self.number), len(self.number) + len(words))))
        self.scores, self.letters = np.concatenate([self.scores, s.astype(np.float32)]), np.concatenate([self.letters, letters])

    def paths(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language of every word of every text, the words' letters, and each text's first word."""
        found = [_WORD.findall(t.lower()) for t in texts]
        new = set().union(*found).difference(self.number)
        if len(self.number) + len(new) > CACHED:
            self.clear()
            new = set().union(*found)
        if new:
            words = sorted(new)
            for k in range(0, len(words), LEARN):
                self.learn(words[k : k + LEARN])
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        first = np.r_[0, np.cumsum(sizes)]
        ids = np.fromiter((self.number[w] for f in found for w in f), np.int64, int(first[-1]))
        s, prior = self.scores[ids].astype(np.float64), self.m["prior"]
        owner = np.repeat(np.arange(len(texts)), sizes)
        total = np.stack([np.bincount(owner, weights=c, minlength=len(texts)) for c in s.T], 1) + prior
        best = total.argmax(1)
        path = best[owner]
        # where no other language gains half the penalty on any run of words, no path with a switch beats the best single one
        reach = np.zeros(len(texts))
        for k in range(s.shape[1] if len(s) else 0):
            reach = np.maximum(reach, best_run(s[:, k] - s[np.arange(len(s)), path], first))
        mixed = np.flatnonzero((reach > SWITCH / 2 - (prior.max() - prior[best])) & (sizes > 1))
        if len(mixed):
            self.search(s, first, mixed[np.argsort(-sizes[mixed], kind="stable")], path)
        return path, self.letters[ids], first

    def search(self, s: np.ndarray, first: np.ndarray, docs: np.ndarray, path: np.ndarray) -> None:
        """Viterbi over the words of ``docs`` (longest first), side by side; writes ``path``."""
        start, size = first[docs], first[docs + 1] - first[docs]
        back = np.empty((len(s), s.shape[1]), np.int8 if s.shape[1] < 128 else np.int16)
        score = s[start] + self.m["prior"]
        own = np.arange(s.shape[1])
        live = len(docs) - np.searchsorted(size[::-1], np.arange(int(size[0]) + 1), "right")  # texts of more than t words
        for t in range(1, int(size[0])):
            k = int(live[t])
            before = score[:k]
            top = before.argmax(1)
            leave = before[np.arange(k), top] - SWITCH
            stay = before >= leave[:, None]
            at = start[:k] + t
            back[at] = np.where(stay, own, top[:, None])
            score[:k] = np.where(stay, before, leave[:, None]) + s[at]
        label = score.argmax(1)
        path[start + size - 1] = label
        for t in range(int(size[0]) - 1, 0, -1):
            k = int(live[t])
            at = start[:k] + t
            label[:k] = back[at, path[at]]
            path[at - 1] = label[:k]


def predict(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, lang_pred, score, spans array<struct<start, end, lang>>)``: spans are in characters and cover the text.

    ``score`` is the share of the text's letters in spans of ``lang_pred``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = "id long, lang_pred string, score double, spans array<struct<start:int,end:int,lang:string>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        lab = Labeller(m) if m["langs"] else None
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))

        def label(ids: list, texts: list) -> pa.RecordBatch:
            texts = [t or "" for t in texts]
            names, scores, spans = [], [], []
            path, letters, first = lab.paths(texts) if lab else (None, None, np.zeros(len(texts) + 1, np.int64))
            for d, t in enumerate(texts):
                a, b = int(first[d]), int(first[d + 1])
                share = np.bincount(path[a:b], weights=letters[a:b], minlength=len(m["langs"])) if b > a else np.zeros(1)
                if share.sum() == 0:
                    names.append("und")
                    scores.append(0.0)
                    spans.append([])
                    continue
                k = int(share.argmax())
                names.append(m["langs"][k])
                scores.append(float(share[k] / share.sum()))
                turn = np.flatnonzero(path[a + 1 : b] != path[a : b - 1]) + 1
                if len(turn):
                    starts, low, want = [], t.lower(), set(turn.tolist())
                    at = [x.start() for i, x in enumerate(_WORD.finditer(low)) if i in want]
                    starts = [0, *at] if len(low) == len(t) else [0, *[min(x, len(t)) for x in at]]
                    named = [m["langs"][int(path[a + i])] for i in [0, *turn.tolist()]]
                    spans.append([{"start": x, "end": y, "lang": z} for x, y, z in zip(starts, [*starts[1:], len(t)], named)])
                else:
                    spans.append([{"start": 0, "end": len(t), "lang": m["langs"][int(path[a])]}])
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(spans, span)], ["id", "lang_pred", "score", "spans"])

        for b in batches:
            for at, n in stretches(b.column(1), room(m)):
                part = b.slice(at, n)
                yield label(part.column(0).to_pylist(), part.column(1).to_pylist())

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, kind)


def keep_identified(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language the model knows, as they are.

    The search has one more state for text that no learned language explains better than chance. Rows without a letter go, and rows most
    of whose letters are labelled with that state; mixed texts of learned languages stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(with_unknown(model))
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        lab = Labeller(m) if m["langs"] else None
        for b in batches:
            if lab is None:
                continue
            text = b.column(0).field(at)
            for i, n in stretches(text, room(m)):
                path, letters, first = lab.paths([t or "" for t in text.slice(i, n).to_pylist()])
                known = np.where(path < len(m["langs"]) - 1, letters, -letters)
                total, every = np.r_[0, np.cumsum(known)], np.r_[0, np.cumsum(letters)]
                keep = (total[first[1:]] >= total[first[:-1]]) & (every[first[1:]] > every[first[:-1]])
                yield b.slice(i, n).filter(pa.array(keep))

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return rows.mapInArrow(run, rows.schema).select("row.*")


def op5_langid(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = predict(docs, fit(docs))
    return out.select(F.col("id").alias("doc_id"), F.coalesce(fold(F.col("id"), 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")
