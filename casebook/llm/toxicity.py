"""Toxicity by weak supervision.

Many voters look at a text: lexicon voters (words, and stems of several lengths, induced from labelled rows) and pattern
voters. A generative label model estimates, by expectation-maximisation, how much more often each voter speaks up on
toxic texts than on others, and from the residual correlations within the classes how far voters repeat one another. It
sees texts without a label, too, on which the voters alone decide; where there is a label, that is one more voter, of fixed accuracy. A logistic model is then trained on the posterior labels of the labelled texts, with the voters' counts as input.

The fit uses bounded samples (``SAMPLE`` rows of each label value and ``UNLABELLED`` rows without a label, by a hash of the id) of rows
whose fold is learned from; scores cover every row. Defined cases: null and empty texts get the score of a text on which no voter speaks;
without labelled rows of both kinds every score is the share of positive labels, 0 if there are none; equal ids and repeated rows are kept; of repeated labels the highest counts.
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
from casebook.llm.fitting import logistic, per_class, share, sigmoid

SAMPLE = 4000
VOTERS = 256
LEAST_Z = 3.0
STEMS = (4, 5, 6)
#: Texts without a label that the label model sees.
UNLABELLED = 8000
#: Accuracy of labels.
GOLD = 0.95
#: Weight of all texts without a label against that of the labelled ones.
UNLABELLED_WEIGHT = 0.25
CACHED = 250_000
_WORD = re.compile(r"[^\W\d_]+")
#: Patterns of abuse and shouting.
PATTERNS = (r"\byou(?:'re| are) (?:an? |such |so )", r"\b(?:shut up|get lost|drop dead|go to hell)\b", r"!{2,}", r"\b(?:hate|despise) (?:you|them|him|her)\b")


def terms(word: str) -> list[str]:
    """What lexicon voters may key on in a word: itself, and its stems (marked by a hyphen)."""
    return [word, *[word[:n] + "-" for n in STEMS if len(word) > n]]


class Voters:
    """Counts of each voter's matches in a text."""

    def __init__(self, lexicon: list[str]):
        self.number = {t: k for k, t in enumerate(lexicon)}
        self.cache: dict[str, tuple] = {}
        self.patterns = [re.compile(p) for p in PATTERNS]
        self.size = len(lexicon) + len(PATTERNS)

    def counts(self, text: str | None) -> tuple[dict[int, int], int]:
        low = (text or "").lower()
        found = _WORD.findall(low)
        new = set(found).difference(self.cache)
        if len(self.cache) + len(new) > CACHED:
            self.cache.clear()
            new = set(found)
        for w in new:
            self.cache[w] = tuple(k for k in map(self.number.get, terms(w)) if k is not None)
        out: Counter[int] = Counter()
        for w, n in Counter(filter(self.cache.__getitem__, found)).items():
            for k in self.cache[w]:
                out[k] += n
        for k, p in enumerate(self.patterns, len(self.number)):
            if n := len(p.findall(low)):
                out[k] = n
        return out, len(found)

    def features(self, texts: list) -> np.ndarray:
        """Per text: log of each voter's count, then overall count, density, distinct lexicon voters, none of them, and one."""
        x = np.zeros((len(texts), self.size + 5))
        lexicon = len(self.number)
        for i, t in enumerate(texts):
            got, n = self.counts(t)
            for k, c in got.items():
                x[i, k] = np.log1p(c)
            hits = sum(c for k, c in got.items() if k < lexicon)
            x[i, -5:] = np.log1p(hits), 100 * hits / (n + 20), np.log1p(sum(k < lexicon for k in got)), not hits, 1
        return x


def induce(rows: DataFrame, size: int = VOTERS) -> list[str]:
    """The terms whose presence sets labelled rows ``(text, y)`` apart most surely: a bounded list, counted on the executors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: dict[str, list[int]] = {}
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for x in {x for w in set(_WORD.findall((t or "").lower())) for x in terms(w)}:
                    seen.setdefault(x, [0, 0])[y] += 1
            yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array([v[1] for v in seen.values()], pa.int64()), pa.array([v[0] for v in seen.values()], pa.int64())], ["term", "p", "n"])

    total = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
    a, b = total.get(1, 0), total.get(0, 0)
    t = rows.select("text", "y").mapInArrow(run, "term string, p long, n long").groupBy("term").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
    t = t.where("p >= 3")
    odds = F.log((F.col("p") + 0.5) / (a - F.col("p") + 0.5)) - F.log((F.col("n") + 0.5) / (b - F.col("n") + 0.5))
    spread = 1 / (F.col("p") + 0.5) + 1 / (a - F.col("p") + 0.5) + 1 / (F.col("n") + 0.5) + 1 / (b - F.col("n") + 0.5)
    t = t.withColumn("z", odds / F.sqrt(spread)).where(F.col("z") >= LEAST_Z)
    return [r.term for r in t.orderBy(F.desc("z"), "term").limit(size).collect()]


def label_model(votes: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 3, steps: int = 8) -> np.ndarray:
    """Posterior of label 1; ``y`` is 0, 1 or -1 (none told). A voter that speaks up counts by its likelihood ratio, shared among voters it is correlated with."""
    told = y >= 0
    post, discount = np.where(y == 1, GOLD, 1 - GOLD), np.ones(votes.shape[1])
    prior = np.clip((weight * (y == 1)).sum() / max((weight * told).sum(), 1e-9), 0.01, 0.99)
    for k in range(rounds):
        # the first round looks at the told rows, so that the classes are those of the labels; then the others join
        seen = weight if k else np.where(told, weight, 0)
        for _ in range(steps):
            on, off = seen * post, seen * (1 - post)
            t1 = (votes.T @ on + 1) / (on.sum() + 2)
            t0 = (votes.T @ off + 1) / (off.sum() + 2)
            own = np.where(y == 1, 1, -1) * told * np.log(GOLD / (1 - GOLD))
            post = sigmoid(np.log(prior / (1 - prior)) + own + votes @ (discount * np.log(t1 / t0)))
        left = np.zeros((votes.shape[1], votes.shape[1]))
        for w, t in ((seen * post, t1), (seen * (1 - post), t0)):
            z = votes - t
            cov = (z * w[:, None]).T @ z / max(w.sum(), 1e-9)
            sd = np.sqrt(np.clip(np.diag(cov), 1e-9, None))
            left = np.maximum(left, cov / np.outer(sd, sd))
        np.fill_diagonal(left, 0)
        discount = 1 / (1 + np.where(left > 0.1, left, 0).sum(1))
    return post


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", size: int = SAMPLE, unlabelled: int = UNLABELLED) -> dict:
    """Lexicon and weights, from bounded samples of the labelled and the other rows whose fold (crc32 mod 5) isn't 0."""
    told = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y"))
    told = told.where(F.col("y").isin(0, 1) & (fold(F.col("id"), 5) != 0)).groupBy("id").agg(F.max("y").alias("y"))
    picked, rates = per_class(told, "y", size)
    if set(rates) != {0, 1}:
        return {"lexicon": [], "weights": None, "flat": float(1 in rates)}
    text = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = text.join(F.broadcast(picked), "id").select("text", "y")  # picked: 2 * size rows or about so many
    lexicon = induce(rows)
    # rows without a label are drawn by id first, so that only the drawn ids meet the labels and only their texts are read on
    drawn = text.where(fold(F.col("id"), 5) != 0)
    every = drawn.select("id").count()
    rate = min(1.0, unlabelled / max(every, 1))
    others = drawn.where(share(F.col("id")) < rate).join(told.where(share(F.col("id")) < rate).select("id"), "id", "left_anti").select("text", F.lit(-1).alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Voters(lexicon)
        for b in batches:
            x = v.features(b.column(0).to_pylist()).astype(np.float32)
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array([r.tobytes() for r in x], pa.binary())], ["y", "x"])

    got = rows.unionByName(others).mapInArrow(run, "y int, x binary").collect()  # 2 * size + unlabelled rows or about so many
    if not {0, 1} <= {r.y for r in got}:
        return {"lexicon": [], "weights": None, "flat": float(any(r.y == 1 for r in got))}
    x = np.stack([np.frombuffer(r.x, np.float32) for r in got]).astype(np.float64)
    y = np.array([r.y for r in got])
    weight = np.array([1 / rates[int(k)] if k >= 0 else 0 for k in y])
    weight *= (y >= 0).sum() / weight.sum()
    weight[y < 0] = min(1.0, UNLABELLED_WEIGHT * (y >= 0).sum() / max((y < 0).sum(), 1))
    votes = np.c_[x[:, :-5] > 0, x[:, -2] > 0].astype(np.float64)
    post = label_model(votes, y, weight)
    weight[y < 0] = 0  # silent voters would teach the classifier that a toxic text without a label is not
    return {"lexicon": lexicon, "weights": logistic(x, post, weight, l2=0.1), "flat": 0.0, "posterior": np.c_[y, post]}


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, score)`` for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        v = Voters(m["lexicon"])
        for b in batches:
            for at, n in stretches(b.column(1)):
                part = b.slice(at, n)
                s = np.full(part.num_rows, m["flat"]) if m["weights"] is None else sigmoid(v.features(part.column(1).to_pylist()) @ m["weights"])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(s, pa.float64())], ["id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, score double")


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    out = score(docs, fit(docs, labels))
    return out.select(F.col("id").alias("doc_id"), F.coalesce(fold(F.col("id"), 5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
