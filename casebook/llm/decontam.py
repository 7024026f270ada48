"""Benchmark decontamination over a positional inverted index sharded by document.

``build_index`` stores, for each shard of documents, one posting list for every term of the training text: the sorted positions
of the term in the shard's token stream (documents stand one free position apart, so no window spans two). It knows nothing of
test items, so any set of items can be asked of it. ``phrases`` starts from each window's rarest term in the shard and intersects
the offset-adjusted lists from rare to common, by binary search in each next list; ``proximity`` does so with a slack. A term that
occurs everywhere has its list cut along the shards, so nothing is gathered by term.

Words are maximal runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased. Defined cases: null and empty
texts have no words, no hits and no items, and are not contaminated; a text of fewer than 13 words can still hold a short
item; an item without words never occurs; items with equal ids count once; repeated rows and equal document ids are
kept as rows; empty tables are fine on either side.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from casebook.llm.common import cut, stretches

WINDOW = 13
#: Bytes of text in a shard, but for a longer single document.
SHARD = 4 << 20
#: MB of test items that are broadcast at once; more are taken in several passes over the stored index.
ITEMS_MB = 4
#: MB of test items in all, which the driver reads.
ALL_ITEMS_MB = 256

_WORD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 0x80 or chr(c).isalnum() else 32 for c in range(256))
INDEX = "doc_ids array<bigint>, n_words array<int>, terms binary, lengths binary, positions binary"


def words(raw: bytes | None) -> list[bytes]:
    return (raw or b"").translate(_WORD).split()


class Queries:
    """Test items as term numbers: the vocabulary, and each item's windows."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.vocabulary = vocabulary = {}
        self.names = sorted({i for i, _ in items})
        at = {i: k for k, i in enumerate(self.names)}
        rows, sizes, owner, self.whole = [], [], [], []
        for name, raw in items:
            ids = [vocabulary.setdefault(w, len(vocabulary)) for w in words(raw)]
            if not ids:
                continue
            self.whole.append((at[name], ids))
            n = min(window, len(ids))
            for k in range(len(ids) - n + 1):
                rows.append(ids[k : k + n] + [-1] * (window - n))
                sizes.append(n)
                owner.append(at[name])
        self.terms = np.array(rows, np.int32).reshape(-1, window)
        self.sizes, self.owner = np.array(sizes, np.int64), np.array(owner, np.int64)


def postings_of(texts: list[bytes | None]) -> dict:
    """Word counts of the texts, the terms in order of first use, the lengths of their lists, and the lists one after the other."""
    number: defaultdict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    tokens, counts = [], []
    for raw in texts:
        w = words(raw)
        counts.append(len(w))
        tokens.extend(map(number.__getitem__, w))
        tokens.append(-1)
    tok = np.array(tokens, np.int32)
    order = np.argsort(tok, kind="stable")[len(texts) :].astype(np.int32)
    lengths = np.bincount(tok[tok >= 0], minlength=len(number)).astype(np.int32)
    return {"n_words": counts, "terms": b" ".join(number), "lengths": lengths.tobytes(), "positions": order.tobytes()}


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard: int = SHARD) -> DataFrame:
    """One row a shard: the documents with their word counts, and the posting list of every term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_ids", pa.list_(pa.int64())), ("n_words", pa.list_(pa.int32())), ("terms", pa.binary()), ("lengths", pa.binary()), ("positions", pa.binary())])
        for b in batches:
            for at, n in stretches(b.column(1), shard):
                row = postings_of(b.column(1).slice(at, n).cast(pa.binary()).to_pylist()) | {"doc_ids": b.column(0).slice(at, n).to_pylist()}
                yield pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in schema], schema=schema)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, INDEX)


class Shard:
    """A shard's posting lists, read back; ``df``, ``slot`` and ``postings`` go by the term numbers of the queries."""

    def __init__(self, row: dict, vocabulary: dict[bytes, int]):
        self.doc_ids, self.n_words = row["doc_ids"], np.array(row["n_words"], np.int64)
        self.first = np.r_[0, np.cumsum(self.n_words + 1)]
        lengths = np.frombuffer(row["lengths"], np.int32).astype(np.int64)
        self.start = np.r_[0, np.cumsum(lengths)]
        self.positions = np.frombuffer(row["positions"], np.int32)
        asked = np.fromiter((vocabulary.get(w, -1) for w in row["terms"].split()), np.int64)
        known = np.flatnonzero(asked >= 0)
        self.df, self.slot = np.zeros(len(vocabulary) + 1, np.int64), np.zeros(len(vocabulary) + 1, np.int64)
        self.df[asked[known]] = lengths[known]
        self.slot[asked[known]] = known
        self.span = int(self.first[-1]) + WINDOW
        self._lists = None

    def holds(self, term: np.ndarray, position: np.ndarray) -> np.ndarray:
        """Whether each position, up to a window beyond the stream, is in the list of its term, which has one: binary search in the lists."""
        if self._lists is None:
            self._lists = np.repeat(np.arange(len(self.start) - 1), np.diff(self.start)) * self.span + self.positions
        want = self.slot[term] * self.span + position
        return self._lists[np.minimum(np.searchsorted(self._lists, want), len(self._lists) - 1)] == want

    def postings(self, term: int) -> np.ndarray:
        at = self.start[self.slot[term]]
        return self.positions[at : at + self.df[term]]

    def doc(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, positions, "right") - 1


def phrases(s: Shard, q: Queries) -> tuple[np.ndarray, np.ndarray]:
    """Occurrences ``(window, start position)``."""
    if not len(q.terms) or not len(s.positions):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    padded = q.terms < 0
    rare = np.where(padded, np.iinfo(np.int64).max, s.df[q.terms])
    order = np.argsort(rare, axis=1, kind="stable")
    live = np.flatnonzero(rare.min(1) > 0)
    if not len(live):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    found_w, found_p = [], []
    for part in np.array_split(live, max(1, int(rare[live, order[live, 0]].sum() // 2_000_000))):
        term, offset = q.terms[part, order[part, 0]], order[part, 0]
        n = s.df[term]
        window = np.repeat(part, n)
        take = np.repeat(s.start[s.slot[term]] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        at = s.positions[take].astype(np.int64) - np.repeat(offset, n)
        keep = at >= 0
        window, at = window[keep], at[keep]
        for k in range(1, q.terms.shape[1]):
            if not len(at):
                break
            column = order[window, k]
            want = q.terms[window, column]
            keep = (want < 0) | s.holds(want, at + column)
            window, at = window[keep], at[keep]
        found_w.append(window)
        found_p.append(at)
    return np.concatenate(found_w), np.concatenate(found_p)


def proximity(s: Shard, q: Queries, slack: int, rarest: int = 3) -> np.ndarray:
    """Pairs ``(document, item)`` where the item's rarest terms in the shard stand, each within ``slack`` positions of the rarest one,
    about as far from it as in the item."""
    out = []
    for item, ids in q.whole:
        terms = sorted({t: k for k, t in reversed(list(enumerate(ids)))}.items(), key=lambda x: (s.df[x[0]], x[1]))[:rarest]
        if not all(s.df[t] for t, _ in terms):
            continue
        (t0, k0), rest = terms[0], terms[1:]
        at = s.postings(t0).astype(np.int64)
        for t, k in rest:
            p, want = s.postings(t), at + (k - k0)
            j = np.searchsorted(p, want)
            near = np.minimum(np.abs(p[np.minimum(j, len(p) - 1)] - want), np.abs(p[np.maximum(j - 1, 0)] - want))
            at = at[near <= slack]
            if not len(at):
                break
        if len(at):
            docs = np.unique(s.doc(at))
            out.append(np.stack([docs, np.full(len(docs), item)], 1))
    return np.concatenate(out) if out else np.empty((0, 2), np.int64)


def _hit(s: Shard, q: Queries, window: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether each position of the shard lies in an occurrence."""
    mark = np.zeros(int(s.first[-1]) + WINDOW + q.terms.shape[1] + 1, np.int64)
    np.add.at(mark, at, 1)
    np.add.at(mark, at + q.sizes[window], -1)
    return np.cumsum(mark)[: int(s.first[-1])] > 0


def _found_items(s: Shard, q: Queries, window: np.ndarray, at: np.ndarray) -> dict[int, list[str]]:
    out: dict[int, list[str]] = {}
    if len(at):
        for d, i in np.unique(np.stack([s.doc(at), q.owner[window]], 1), axis=0).tolist():
            out.setdefault(d, []).append(q.names[i])
    return out


def _hits(s: Shard, q: Queries, window: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hit words of each document of the shard."""
    return np.add.reduceat(_hit(s, q, window, at).astype(np.int64), s.first[:-1]) if len(at) else np.zeros(len(s.doc_ids), np.int64)


def _report(s: Shard, q: Queries) -> list:
    window, at = phrases(s, q)
    n = len(s.doc_ids)
    hits = _hits(s, q, window, at)
    items = _found_items(s, q, window, at)
    return [pa.array(s.doc_ids, pa.int64()), pa.array(s.n_words), pa.array(hits), pa.array([items.get(d, []) for d in range(n)], pa.list_(pa.string()))]


def _partial(s: Shard, q: Queries, shard: int) -> pa.RecordBatch:
    """Hit positions and items of the documents that have some."""
    window, at = phrases(s, q)
    items = _found_items(s, q, window, at)
    hit = np.flatnonzero(_hit(s, q, window, at)) if len(at) else np.empty(0, np.int64)
    docs = sorted(items)
    cuts = np.searchsorted(hit, [[s.first[d], s.first[d + 1]] for d in docs]) if docs else []
    kinds = (pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.string()))
    cols = ([shard] * len(docs), docs, [hit[x:y].tolist() for x, y in cuts], [items[d] for d in docs])
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["shard", "doc", "hit", "items"])


def _queries(items: DataFrame, item_id: str, item_text: str, items_mb: float) -> list[Queries]:
    """The test items, in parts of about ``items_mb``; one part at least."""
    some = items.select(F.col(item_id).cast("string").alias("i"), F.col(item_text).cast("string").alias("t")).where("i is not null and t is not null")
    size = some.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    if size > ALL_ITEMS_MB << 20:
        raise ValueError(f"the test items hold {size} bytes, more than {ALL_ITEMS_MB} MB")
    parts, room = [[]], items_mb * (1 << 20)
    for x in sorted((r.i, r.t.encode()) for r in some.collect()):
        if room < len(x[1]) and parts[-1]:
            parts.append([])
            room = items_mb * (1 << 20)
        parts[-1].append(x)
        room -= len(x[1])
    return [Queries(p) for p in parts]


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", items_mb: float = ITEMS_MB) -> DataFrame:
    """``(id, n_words, n_hit, items array<string>, contaminated)`` for every row of ``docs``.

    Test items go to every executor, ``items_mb`` of them at once: a larger set is taken in passes over the stored index, whose hits are united.
    Over ``ALL_ITEMS_MB`` raises.
    """
    queries, sc = _queries(items, item_id, item_text, items_mb), docs.sparkSession.sparkContext
    index = cut(build_index(docs, id_col, text_col).withColumn("shard", F.monotonically_increasing_id()))

    def run(shared, make):
        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            q = shared.value
            for b in batches:
                for at in range(b.num_rows):
                    row = b.slice(at, 1).to_pylist()[0]
                    yield make(Shard(row, q.vocabulary), q, row["shard"])

        return each

    if len(queries) == 1:
        whole = lambda s, q, _: pa.RecordBatch.from_arrays(_report(s, q), ["id", "n_words", "n_hit", "items"])
        out = index.mapInArrow(run(sc.broadcast(queries[0]), whole), "id long, n_words long, n_hit long, items array<string>")
    else:
        found = None
        for q in queries:
            part = index.mapInArrow(run(sc.broadcast(q), _partial), "shard long, doc int, hit array<bigint>, items array<string>")
            found = part if found is None else found.unionByName(part)
        united = found.groupBy("shard", "doc").agg(*[F.array_distinct(F.flatten(F.collect_list(c))).alias(c) for c in ("hit", "items")])
        rows = index.select("shard", F.posexplode(F.arrays_zip("doc_ids", "n_words")).alias("doc", "d")).select("shard", "doc", F.col("d.doc_ids").alias("id"), F.col("d.n_words").cast("long").alias("n_words"))
        out = rows.join(united, ["shard", "doc"], "left").select("id", "n_words", F.coalesce(F.size("hit"), F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))
        out = out.withColumn("n_hit", F.greatest("n_hit", F.lit(0)))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def near(docs: DataFrame, items: DataFrame, slack: int = 20, rarest: int = 3, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Proximity matches ``(id, item)``: documents that hold an item's rarest terms near one another. Items are taken in passes as in ``contamination``."""
    parts = [docs.sparkSession.sparkContext.broadcast(q) for q in _queries(items, item_id, item_text, ITEMS_MB)]
    index = build_index(docs, id_col, text_col)
    index = cut(index) if len(parts) > 1 else index

    def run(shared):
        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            q = shared.value
            for b in batches:
                for at in range(b.num_rows):
                    s = Shard(b.slice(at, 1).to_pylist()[0], q.vocabulary)
                    pairs = proximity(s, q, slack, rarest)
                    yield pa.RecordBatch.from_arrays([pa.array([s.doc_ids[d] for d in pairs[:, 0]], pa.int64()), pa.array([q.names[i] for i in pairs[:, 1]], pa.string())], ["id", "item"])

        return each

    out = None
    for q in parts:
        found = index.mapInArrow(run(q), "id long, item string")
        out = found if out is None else out.unionByName(found)
    return out


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", items_mb: float = ITEMS_MB) -> DataFrame:
    """The rows of ``docs`` that aren't contaminated, as they are.

    Where the test items go in one pass, rows are decided on in the pass that makes their shard's lists, so no text is stored or
    shuffled; else through :func:`contamination`.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    queries = _queries(items, item_id, item_text, items_mb)
    if len(queries) > 1:
        rows = cut(docs.select(whole, F.monotonically_increasing_id().alias("n")))
        found = contamination(rows.select("n", F.col("row").getField(text_col).alias("text")), items, "n", "text", item_id, item_text, items_mb)
        return rows.join(found.where("contaminated").select(F.col("id").alias("n")), "n", "left_anti").select("row.*")
    shared = docs.sparkSession.sparkContext.broadcast(queries[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = shared.value
        for b in batches:
            text = b.column(1)
            for at, n in stretches(text, SHARD):
                s = Shard(postings_of(text.slice(at, n).cast(pa.binary()).to_pylist()) | {"doc_ids": range(n)}, q.vocabulary)
                hits = _hits(s, q, *phrases(s, q))
                clean = (hits == 0) | (20 * hits < s.n_words)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, n).filter(pa.array(clean))], ["row"])

    rows = docs.select(whole, F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(run, StructType([rows.schema["row"]])).select("row.*")


def op7_decontam(spark, sf_dir: str) -> DataFrame:
    out = contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"), "contaminated",
    )
