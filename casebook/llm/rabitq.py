"""Embedding near-duplicates by randomised-rotation binary codes with correction factors.

Vectors are normalised, rotated by fixed random rotations and kept as the signs of their coordinates, with a stored factor: the
inner product of the vector with its code, which makes the estimate of a cosine unbiased over rotations. Which pairs to look at
comes from the codes: vectors that agree on all bits of one of ``BANDS`` stretches of the code meet there.

Two rounds: first only codes travel, and a pair stays if its differing bits are within a confidence bound of what the
threshold implies; then vectors travel, but only to the places where a pair of theirs stayed. There the unbiased estimate's
confidence bound decides which pairs are recomputed exactly in double precision. A pair is counted where it first meets, so sums of counts need no list of
pairs; hot stretches are split into tiles, and only counts and a spanning set of links leave a tile.

At cosine 0.95 a pair is met with probability 0.99, at 0.97 with 0.999; the tests measure recall against brute force. Defined cases: vectors that are null, zero,
or hold null or non-finite components link with nothing; vectors link only with vectors of their length; repeated rows of one id
are compared as rows and each is returned; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from casebook.llm.common import connected, cut, tiled
from casebook.llm.simhash import roots, sorted_groups

SEED = 20240101
CODE = 256
BAND_BITS, BANDS = 14, 18
TILE = 2048
#: Standard deviations of the estimate within which a pair may still reach the threshold.
DEVIATIONS = 5.0


@lru_cache(maxsize=8)
def rotations(dim: int, code: int = CODE) -> np.ndarray:
    """``(code, dim)``: random orthonormal bases one under the other, cut to ``code`` rows."""
    rng = np.random.default_rng(SEED + dim)
    made = [np.linalg.qr(rng.normal(size=(dim, dim)))[0] for _ in range(-(-code // dim))]
    return np.concatenate(made)[:code]


def encode(unit: np.ndarray, code: int = CODE) -> tuple[np.ndarray, np.ndarray]:
    """Signs as packed bits, and the correction factor ``<o, x>`` of every vector with its code."""
    turned = unit @ rotations(unit.shape[1], code).T
    return np.packbits(turned >= 0, axis=1), np.abs(turned).sum(1) / code


def image(bits: np.ndarray, factor: np.ndarray, dim: int, code: int = CODE) -> tuple[np.ndarray, np.ndarray]:
    """What a's code stands for: ``q`` such that ``<q, b>`` estimates ``<a, b>`` without bias over rotations, and its error's scale.

    With signs ``s`` of a's rotated coordinates, ``s . (R b) / (s . (R a))``; the error comes from b's part across a.
    """
    r = rotations(dim, code)
    q = (np.unpackbits(bits, axis=1)[:, :code] * 2.0 - 1) @ r / (code * factor[:, None])
    return q, np.sqrt(np.clip(np.square(q).sum(1) - 1, 0, None) / max(dim - 1, 1))


def may_reach(value: np.ndarray, scale: np.ndarray, least: float) -> np.ndarray:
    """Whether the confidence bound of an estimate reaches ``least``."""
    return value + DEVIATIONS * scale * np.sqrt(np.clip(1 - np.square(np.clip(value, -1, 1)), 1e-4, None)) >= least


def band_keys(bits: np.ndarray) -> np.ndarray:
    return np.unpackbits(bits, axis=1)[:, : BANDS * BAND_BITS].reshape(len(bits), BANDS, BAND_BITS) @ (1 << np.arange(BAND_BITS))


def prepare(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(row, id, dim, vec binary, bits binary, factor, bands)``; ``vec`` is as given for floats, of length 1 for doubles; unusable vectors have null ``bits``."""

    single = vectors.schema[vec_col].dataType.elementType == FloatType()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vecs = b.column(2)
            usable, sent = [], []
            for v in vecs.to_pylist():
                x = None if v is None or not v or None in v else np.array(v, np.float64)
                ok = x is not None and np.isfinite(x).all() and x.any()
                if ok:
                    scale = np.abs(x).max()
                    x = x / scale
                    x = x / np.sqrt(x @ x)
                usable.append(x if ok else None)
                sent.append(np.array(v, np.float32) if ok and single else x)
            out: list[list] = [[] for _ in range(5)]
            packed: dict[int, tuple] = {}
            for d in {len(x) for x in usable if x is not None}:
                at = [i for i, x in enumerate(usable) if x is not None and len(x) == d]
                bits, f = encode(np.stack([usable[i] for i in at]))
                keys = band_keys(bits)
                packed |= {i: (d, sent[i].tobytes(), bits[k].tobytes(), float(f[k]), keys[k].tolist()) for k, i in enumerate(at)}
            for i in range(b.num_rows):
                for c, v in zip(out, packed.get(i, (None,) * 5)):
                    c.append(v)
            types = (pa.int32(), pa.binary(), pa.binary(), pa.float64(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *[pa.array(c, t) for c, t in zip(out, types)]], ["row", "id", "dim", "vec", "bits", "factor", "bands"])

    rows = vectors.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    return rows.mapInArrow(run, "row long, id long, dim int, vec binary, bits binary, factor double, bands array<bigint>")


def differing_bits(least: float, code: int = CODE) -> int:
    """Differing bits that a pair at cosine ``least`` doesn't exceed but beyond ``DEVIATIONS`` standard deviations."""
    t = np.arccos(np.clip(least, -1, 1)) / np.pi
    return int(np.ceil(code * t + DEVIATIONS * np.sqrt(code * t * (1 - t)))) + 1


def _wide(t: pa.Table, name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(t.column(name).to_pylist()), kind).reshape(t.num_rows, -1)


def _candidates(key: np.ndarray, side: np.ndarray, some, block) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of positions, with their band, within groups of equal ``key`` rows (sorted) that ``some`` (pair by pair) or ``block`` (all of two lists) lets pass."""
    start = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(1)])
    size = np.diff(np.r_[start, len(key)])
    group = np.repeat(np.arange(len(start)), size)
    few = np.repeat(size <= 64, size)
    for s in range(1, int(size[size <= 64].max(initial=1))):
        i = np.flatnonzero(few[:-s] & (group[:-s] == group[s:]))
        if not len(i):
            break
        i = i[(side[i] != side[i + s]) | (side[i] < 0)]
        i = i[some(i, i + s)]
        yield i, i + s, key[i, 1]
    for g in np.flatnonzero(size > 64):
        at = np.arange(start[g], start[g] + size[g])
        alone = side[at[0]] < 0
        left, right = (at, at) if alone else (at[side[at] == 0], at[side[at] == 1])
        for p in range(0, len(left), 256):
            x, y = np.nonzero(block(left[p : p + 256], right))
            x, y = left[x + p], right[y]
            x, y = (x[x < y], y[x < y]) if alone else (x, y)
            for q in range(0, len(x), 1 << 16):
                yield x[q : q + (1 << 16)], y[q : q + (1 << 16)], np.full(len(x[q : q + (1 << 16)]), key[start[g], 1])


def _first_met(keys: np.ndarray, x: np.ndarray, y: np.ndarray, band: np.ndarray) -> np.ndarray:
    return ~((keys[x] == keys[y]) & (np.arange(BANDS) < band[:, None])).any(1)


def meeting(t: pa.Table, key: np.ndarray, side: np.ndarray, most: int) -> np.ndarray:
    """Which rows have a pair here that meets here first and may link by its codes."""
    bits = _wide(t, "bits", np.uint8)
    words, keys = bits.view(np.uint64), band_keys(bits)
    apart = lambda a, b: np.bitwise_count(a ^ b).sum(-1, dtype=np.int32)
    out = np.zeros(t.num_rows, bool)
    for x, y, band in _candidates(key, side, lambda i, j: apart(words[i], words[j]) <= most, lambda i, j: apart(words[i][:, None], words[j][None]) <= most):
        ok = _first_met(keys, x, y, band)
        out[x[ok]] = out[y[ok]] = True
    return out


def linked(t: pa.Table, key: np.ndarray, side: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (positions in ``t``) that meet here first and link; vectors are of one length."""
    dim = int(key[0, 0])
    vec = _wide(t, "vec", np.float32 if len(t.column("vec")[0].as_py()) == 4 * dim else np.float64).astype(np.float64)
    vec /= np.sqrt(np.square(vec).sum(1, keepdims=True))
    bits = _wide(t, "bits", np.uint8)
    q, scale = image(bits, t.column("factor").to_numpy(), dim)
    keys, found = band_keys(bits), ([], [])
    some = lambda i, j: may_reach(np.einsum("ij,ij->i", q[i], vec[j]), scale[i], least)
    block = lambda i, j: may_reach(q[i] @ vec[j].T, scale[i, None], least)
    for x, y, band in _candidates(key, side, some, block):
        ok = _first_met(keys, x, y, band)
        x, y = x[ok], y[ok]
        exact = np.einsum("ij,ij->i", vec[x], vec[y]) >= least
        found[0].append(x[exact])
        found[1].append(y[exact])
    cat = lambda z: np.concatenate(z) if z else np.empty(0, np.int64)
    return cat(found[0]), cat(found[1])


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", least: float = 0.95, tile: int = TILE) -> DataFrame:
    """``(id, n_links, component_id)``, one row for each row of ``vectors``."""
    rows = cut(prepare(vectors, id_col, vec_col))
    good = rows.where("bits is not null")
    keys, place = ["dim", "band", "key"], ["dim", "band", "key", "ti", "tj"]
    met = good.select("row", "bits", "dim", F.posexplode("bands").alias("band", "key"))
    crowded = met.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*keys)
    met = tiled(met.join(crowded, keys, "left_semi"), keys, tile, F.xxhash64("row"))
    most = differing_bits(least)

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in sorted_groups(batches, place):
            t = t.combine_chunks()
            key = np.stack([t.column(k).to_numpy() for k in place], 1)
            stay = meeting(t, key, t.column("side").to_numpy(), most)
            yield from t.select(["row", *place, "side"]).filter(pa.array(stay)).to_batches()

    def vecs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in sorted_groups(batches, place):
            t = t.combine_chunks()
            key = np.stack([t.column(k).to_numpy() for k in place], 1)
            side, ids = t.column("side").to_numpy(), t.column("row").to_numpy()
            xs, ys = [], []
            ends = np.r_[np.flatnonzero(key[1:, 0] != key[:-1, 0]) + 1, len(key)]
            for a, b in zip(np.r_[0, ends[:-1]].tolist(), ends.tolist()):
                x, y = linked(t.slice(a, b - a), key[a:b], side[a:b], least)
                xs.append(x + a)
                ys.append(y + a)
            x, y = np.concatenate(xs), np.concatenate(ys)
            count = np.bincount(x, minlength=len(ids)) + np.bincount(y, minlength=len(ids))
            root = roots(len(ids), x, y)
            yield pa.RecordBatch.from_arrays([pa.array(ids[count > 0]), pa.array(count[count > 0]), pa.array(ids[root][count > 0])], ["row", "n", "to"])

    kind = "row long, dim int, band int, key long, ti int, tj int, side int"
    stay = met.repartition(*place).sortWithinPartitions(*place, "side", "row").mapInArrow(codes, kind)
    again = stay.join(good.select("row", "vec", "bits", "factor"), "row")
    found = cut(again.repartition(*place).sortWithinPartitions(*place, "side", "row").mapInArrow(vecs, "row long, n long, to long"))
    links = found.groupBy("row").agg(F.sum("n").alias("n_links"))
    root = connected(found.select(F.col("row").alias("a"), F.col("to").alias("b")))
    named = rows.select("row", "id").join(links, "row", "left").join(root, F.col("row") == F.col("node"), "left").select("row", "id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "root")
    named = cut(named)
    least_id = named.where("root is not null").groupBy("root").agg(F.min("id").alias("low"))
    return named.join(least_id, "root", "left").select("id", "n_links", F.coalesce("low", "id").alias("component_id"))


def op8_rabitq(spark, sf_dir: str) -> DataFrame:
    out = near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return out.select(F.col("id").alias("vec_id"), "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))
