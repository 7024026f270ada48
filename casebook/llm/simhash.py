"""SimHash near-duplicate groups: 64-bit fingerprints of 3-word shingles, linked at a small Hamming distance.

Comparison is tiled and exact: fingerprints that can link agree in one of ``radius + 1`` bit words (pigeonhole), so
tiles are drawn inside each word's agreement class; within a tile, rows are sorted by population count, tile pairs whose counts
differ beyond the radius are skipped and the others go through numpy exclusive-or and ``bitwise_count``.

Defined cases: null or empty text has fingerprint zero and links like any other; repeated rows and equal ids are kept
as rows; an empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from casebook.llm.common import connected, cut, drop, stretches, tiled

SHINGLE = 3
RADIUS = 3
TILE = 4096
BLOCK = 1 << 16


def fingerprint(raw: bytes | None) -> int:
    """SimHash of one text as an unsigned integer."""
    from xxhash import xxh64_digest

    words = (raw or b"").lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        return int.from_bytes(xxh64_digest(b" ".join(words), 42), "big")
    count, n = np.zeros(64, np.int64), len(words) - SHINGLE + 1
    for at in range(0, n, BLOCK):
        part = words[at : at + BLOCK + SHINGLE - 1]
        digests = b"".join([xxh64_digest(b" ".join(x), 42) for x in zip(*(part[i:] for i in range(SHINGLE)))])
        count += np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * count > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """``(id, fp)`` a row; ``fp`` is the fingerprint's 64 bits as a signed long. With ``carry`` also ``row``: all of the row."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = b.column(1).field(at) if carry else b.column(1)
            for i, n in stretches(text):
                fps = np.array([fingerprint(x) for x in text.slice(i, n).cast(pa.binary()).to_pylist()], np.uint64)
                cols = [b.column(0).slice(i, n), pa.array(fps.view(np.int64))]
                yield pa.RecordBatch.from_arrays(cols + [b.column(1).slice(i, n)], ["id", "fp", "row"]) if carry else pa.RecordBatch.from_arrays(cols, ["id", "fp"])

    if not carry:
        rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
        return rows.mapInArrow(run, "id long, fp long")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return rows.mapInArrow(run, StructType([StructField("id", LongType()), StructField("fp", LongType()), rows.schema["row"]]))


def _near(fp_a: np.ndarray, fp_b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs within ``radius``; the sides are sorted by population count and compared block by block."""
    step, found = 512, ([], [])
    ca, cb = np.bitwise_count(fp_a).astype(np.int16), np.bitwise_count(fp_b).astype(np.int16)
    for i in range(0, len(fp_a), step):
        lo = np.searchsorted(cb, ca[i] - radius, "left")
        hi = np.searchsorted(cb, ca[min(i + step, len(fp_a)) - 1] + radius, "right")
        for j in range(lo, hi, step):
            x, y = np.nonzero(np.bitwise_count(fp_a[i : i + step, None] ^ fp_b[None, j : min(j + step, hi)]) <= radius)
            found[0].append(x + i)
            found[1].append(y + j)
    return (np.concatenate(found[0]), np.concatenate(found[1])) if found[0] else (np.empty(0, np.int64),) * 2


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of each index's component, for links ``a[i] - b[i]`` over ``range(n)``."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    return root


def _links(key: np.ndarray, fp: np.ndarray, side: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning set of links of each group of equal ``key`` rows (sorted): every member to its local root."""
    start = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(1)]) if len(key) else np.empty(0, np.int64)
    size = np.diff(np.r_[start, len(key)])
    a, b = [], []
    small = size <= 64
    group = np.repeat(np.arange(len(start)), size)
    ok = np.repeat(small, size)
    for s in range(1, int(size[small].max(initial=1))):
        i = np.flatnonzero(ok[:-s] & (group[:-s] == group[s:]))
        if not len(i):
            break
        i = i[(np.bitwise_count(fp[i] ^ fp[i + s]) <= radius) & ((side[i] != side[i + s]) | (side[i] < 0))]
        a.append(i)
        b.append(i + s)
    for g in np.flatnonzero(~small):
        rows = np.arange(start[g], start[g] + size[g])
        rows = rows[np.argsort(np.bitwise_count(fp[rows]), kind="stable")]
        left = rows if side[rows[0]] < 0 else rows[side[rows] == 0]
        right = rows if side[rows[0]] < 0 else rows[side[rows] == 1]
        x, y = _near(fp[left], fp[right], radius)
        keep = left[x] != right[y]
        a.append(left[x][keep])
        b.append(right[y][keep])
    if not a:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    a, b = np.concatenate(a), np.concatenate(b)
    root = roots(len(fp), a, b)
    mine = np.flatnonzero(root != np.arange(len(fp)))
    return fp[mine], fp[root[mine]]


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Batches of rows sorted by ``keys`` as tables in which no key is cut."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        k = np.stack([b.column(n).to_numpy(zero_copy_only=False) for n in keys], 1)
        cuts = np.flatnonzero((k != k[-1]).any(1))
        at = int(cuts[-1]) + 1 if len(cuts) else 0
        if held and at == 0:
            last = held[-1]
            if all(last.column(n)[-1].as_py() == b.column(n)[0].as_py() for n in keys):
                held.append(b)
                continue
        if held or at:
            yield pa.Table.from_batches([*held, b.slice(0, at)])
        held = [b.slice(at)]
    if held:
        yield pa.Table.from_batches(held)


def links(fps: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Spanning links ``(a, b)`` between distinct fingerprints ``fps(fp)`` at ``radius`` or fewer differing bits."""
    n = radius + 1
    width = -(-64 // n)
    words = [F.struct(F.lit(i).alias("w"), F.shiftrightunsigned("fp", i * width).bitwiseAND(F.lit((1 << min(width, 64 - i * width)) - 1)).alias("v")) for i in range(n)]
    rows = fps.select("fp", F.inline(F.array(*words)))
    rows = tiled(rows, ["w", "v"], tile, F.xxhash64("fp"))
    keys = ["w", "v", "ti", "tj"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in sorted_groups(batches, keys):
            key = np.stack([t.column(k).to_numpy() for k in keys], 1)
            x, y = _links(key, t.column("fp").to_numpy().view(np.uint64), t.column("side").to_numpy(), radius)
            yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(y.view(np.int64))], ["a", "b"])

    rows = rows.repartition(*keys).sortWithinPartitions(*keys, "side", "fp")
    return rows.mapInArrow(run, "a long, b long")


def classes(rows: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """``(fp, low, root)`` for the distinct fingerprints of ``rows(id, fp)``: smallest id, and the smallest fingerprint reachable."""
    own = cut(rows.groupBy("fp").agg(F.min("id").alias("low")))
    found = cut(links(own.select("fp"), radius, tile))
    root = connected(found)
    drop(found)
    return own.join(root, own["fp"] == root["node"], "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """``(id, fp, component_id)`` for every row of ``docs``: the smallest id reachable over links of fingerprints."""
    rows = cut(fingerprints(docs, id_col, text_col))
    own = classes(rows, radius, tile)
    least = own.groupBy("root").agg(F.min("low").alias("component_id"))
    return rows.join(own.join(least, "root").select("fp", "component_id"), "fp").select("id", "fp", "component_id")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """One row of each group: that of the smallest id (null ids last), of repeated rows just one."""
    rows = cut(fingerprints(docs, id_col, text_col, carry=True).withColumn("n", F.monotonically_increasing_id()))
    own = classes(rows.select("id", "fp"), radius, tile).select("fp", "root")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "n"))
    kept = rows.select("id", "fp", "n").join(own, "fp").groupBy("root").agg(first.alias("first")).select(F.col("first.n").alias("n"))
    return rows.join(kept, "n", "left_semi").select("row.*")


def op1_simhash(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = near_duplicates(docs)
    return out.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
