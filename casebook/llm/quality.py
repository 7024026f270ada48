"""Quality by positive-unlabelled learning.

Trusted positives are labelled rows of quality 1; everything without a label is unlabelled web text. The class prior is
estimated first: a plain classifier of positives against unlabelled rows is fitted on one half of the sample, and on the
other half the smallest ratio of the tails above a threshold bounds the share of positives. A logistic model
then minimises the non-negative unbiased risk under that prior.

The inputs are shapes of the text (character classes, repetition, word and line lengths), cut into quantile bins. The fit
uses a bounded sample (``SAMPLE`` rows a side, by a hash of the id) of rows whose fold is learned from; scores cover every row.
Defined cases: null and empty texts have the shape of a text without words; without positives or
unlabelled rows every score is the share of positives, 0 if there are none; equal ids and repeated rows are kept.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm.common import fold, stretches
from casebook.llm.fitting import logistic, per_class, sigmoid

SAMPLE = 10000
BINS = 10
SYMBOLS = b"#$%&*!|@<>{}[]=_~^+\\/"


def shape(raw: bytes | None) -> list[float]:
    """Figures of one whole text."""
    raw = raw or b""
    n = max(1, len(raw))
    hist = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) / n
    words = raw.split()
    k = max(1, len(words))
    common = Counter(words)
    lines = raw.split(b"\n")
    edge = sum(map(common.__getitem__, [w for w in common if w[-1:] in (b"#", b"$", b"%", b"&", b"*", b"!", b"|", b"@", b">", b"=")]))
    upper, lower = hist[65:91].sum(), hist[97:123].sum()
    return [
        *[float(hist[c]) for c in SYMBOLS[:7]], float(hist[list(SYMBOLS[7:])].sum()), float(hist[48:58].sum()), float(upper / (upper + lower + 1e-9)),
        float(hist[46] * n / k), float(hist[44] * n / k), float(hist[128:].sum()), float(hist[10] * n / k), edge / k,
        len(common) / k**0.9, max(common.values(), default=0) / k, sum(sorted(common.values())[-3:]) / k, len(raw) / k,
        sum(map(bytes.__eq__, words, words[1:])) / k, len(set(lines)) / len(lines), k / len(lines), float(np.log1p(k)), sum(map(common.__getitem__, [w for w in common if len(w) == 1])) / k,
    ]


def expand(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Bins of every figure as zeros and ones, and a one."""
    out = [np.searchsorted(e, c, "right")[:, None] > np.arange(len(e)) for e, c in zip(edges, x.T)]
    return np.concatenate([*out, np.ones((len(x), 1), bool)], 1).astype(np.float64)


def cuts(c: np.ndarray) -> np.ndarray:
    """Bin edges of a figure: quantiles of all values and of those above the least, so that rare ones are told apart, too."""
    at, above = np.linspace(0.02, 0.98, BINS), c[c > c.min()]
    return np.unique(np.r_[np.quantile(c, at), np.quantile(above, at) if len(above) else []])


def class_prior(pos: np.ndarray, unl: np.ndarray, least: float = 0.2) -> float:
    """Share of positives in ``unl``: the lowest ratio of tails over thresholds that keep enough positives, with a margin for chance."""
    at = np.unique(np.quantile(pos, np.linspace(0, 1 - least, 200)))
    p = np.array([(pos >= t).mean() for t in at])
    u = np.array([(unl >= t).mean() for t in at])
    slack = np.sqrt(np.log(400) / 2) * (1 / np.sqrt(len(unl)) + 1 / np.sqrt(len(pos)))
    best = int(np.argmin((u + slack) / p))
    return float(np.clip(u[best] / p[best], 0.02, 0.98))


def non_negative(pos: np.ndarray, unl: np.ndarray, prior: float, l2: float = 3e-4, steps: int = 400, rate: float = 0.05) -> np.ndarray:
    """Weights that minimise ``prior * R+(pos) + max(0, R-(unl) - prior * R-(pos))`` with the logistic loss, by Adam; the mean of the last tenth of steps."""
    w = np.zeros(pos.shape[1])
    m, v, mean, last = np.zeros_like(w), np.zeros_like(w), np.zeros_like(w), steps // 10
    for t in range(1, steps + 1):
        sp, su = sigmoid(pos @ w), sigmoid(unl @ w)
        negative = -np.log(np.clip(1 - su, 1e-9, 1)).mean() + prior * np.log(np.clip(1 - sp, 1e-9, 1)).mean()
        gu = unl.T @ su / len(unl) - prior * (pos.T @ sp) / len(pos)
        # where the second part is below zero it is pushed back up
        g = prior * (pos.T @ (sp - 1)) / len(pos) + (gu if negative >= 0 else -gu) + l2 * np.r_[w[:-1], 0]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        mean += w * (t > steps - last) / last
    return mean


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", size: int = SAMPLE) -> dict:
    """Bin edges, prior and weights from a bounded sample of rows whose fold (crc32 mod 5) isn't 0."""
    told = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("q")).where("id is not null")
    good = told.where((F.col("q") == 1) & (fold(F.col("id"), 5) != 0)).select("id", F.lit(1).alias("y")).distinct()
    text = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    web = text.select("id").where(fold(F.col("id"), 5) != 0).join(told.select("id"), "id", "left_anti").select("id", F.lit(0).alias("y")).distinct()
    picked, rates = per_class(good.unionByName(web), "y", size)
    if set(rates) != {0, 1}:
        return {"edges": None, "flat": float(1 in rates)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [np.array(shape(r), np.float32).tobytes() for r in b.column(0).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(x, pa.binary())], ["y", "x"])

    got = text.join(F.broadcast(picked), "id").select("text", "y").mapInArrow(run, "y int, x binary").collect()  # picked: 2 * size rows or about so many
    x, y = np.stack([np.frombuffer(r.x, np.float32) for r in got]).astype(np.float64), np.array([r.y for r in got])
    order = np.lexsort([*x.T, y])
    x, y = x[order], y[order]
    if len(set(y.tolist())) < 2:
        return {"edges": None, "flat": float(y.mean())}
    edges = [cuts(c) for c in x.T]
    z = expand(x, edges)
    half = np.arange(len(y)) % 2 == 0
    rough = logistic(z[half], y[half].astype(float), np.ones(half.sum()), l2=5.0)
    s = z[~half] @ rough
    prior = class_prior(s[y[~half] == 1], s[y[~half] == 0])
    return {"edges": edges, "prior": prior, "weights": non_negative(z[y == 1], z[y == 0], prior), "flat": prior}


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, score)`` for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            for at, n in stretches(b.column(1)):
                part = b.slice(at, n)
                if m["edges"] is None:
                    s = np.full(part.num_rows, m["flat"])
                else:
                    x = np.array([shape(r) for r in part.column(1).cast(pa.binary()).to_pylist()], np.float32).astype(np.float64)
                    s = sigmoid(expand(x, m["edges"]) @ m["weights"])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(s, pa.float64())], ["id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, score double")


def op9_quality(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    out = score(docs, fit(docs, labels))
    return out.select(F.col("id").alias("doc_id"), F.coalesce(fold(F.col("id"), 5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
