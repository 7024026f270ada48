"""Byte-level BPE encoding and decoding with a public rank file.

Long texts are cut into overlapping chunks, each pre-tokenised on its own; two neighbours are stitched at the first
pre-token boundary that both have (the pattern has no look-behind, so from a common boundary on both read the same
pieces), and where none resynchronises the text is read on from the last trusted boundary. The pieces are then
encoded, each distinct one once per worker, and decoding concatenates the tokens' raw bytes.

Defined cases: null and empty texts have no tokens and decode to no bytes; repeated rows and equal ids are kept;
text of special tokens is ordinary text; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm.common import stretches

RANKS = "byte_bpe_multi_50k.tiktoken"
CHUNK = 1 << 16
OVERLAP = 1 << 9
#: Characters after a piece that must be in the chunk for its end to be certain: contractions reach this far.
SEEN = 2
CACHED = 200_000


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path(RANKS)


@lru_cache(maxsize=2)
def _load(path: str):
    """``(encoding, token bytes by id, pre-token pattern)``, once a worker."""
    import public_tokenizers
    import regex
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    table = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        table[i] = token
    return enc, table, regex.compile(public_tokenizers.PATTERN)


def _ends(pattern, text: str, start: int, stop: int) -> list[int]:
    """Ends of the pieces of ``text[start:stop]``, those that what follows the chunk may change left out."""
    part = text[start:stop]
    ends = [start + m.end() for m in pattern.finditer(part)]
    if stop < len(text):
        while ends and ends[-1] > stop - SEEN:
            ends.pop()
    return ends


def pieces(pattern, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> Iterator[list[str]]:
    """The pre-tokens of ``text``, as lists a chunk, equal in all to ``pattern.findall(text)``."""
    if len(text) <= chunk + overlap:
        yield pattern.findall(text)
        return
    done, ends = 0, _ends(pattern, text, 0, min(len(text), chunk + overlap))
    for at in range(chunk, len(text), chunk):
        if done >= len(text):
            return
        stop = min(len(text), at + chunk + overlap)
        mine = _ends(pattern, text, at, stop)
        both = set(ends).intersection(mine)
        meet = min(both, default=None)
        if meet is None:  # no resynchronisation: read on from the last trusted boundary
            keep, mine = ends, _ends(pattern, text, ends[-1] if ends else done, stop)
        else:
            keep, mine = [e for e in ends if e <= meet], [e for e in mine if e > meet]
        yield [text[a:b] for a, b in zip([done, *keep], keep)]
        done, ends = keep[-1] if keep else done, mine
    yield [text[a:b] for a, b in zip([done, *ends], ends)]


def encoder(path: str, chunk: int = CHUNK, overlap: int = OVERLAP):
    """A function from text to its ids as little-endian int32 bytes."""
    enc, _, pattern = _load(path)
    cache: dict[str, bytes] = {}

    def encode(text: str | None) -> bytes:
        out = []
        for part in pieces(pattern, text or "", chunk, overlap):
            for p in set(part).difference(cache):
                if len(cache) >= CACHED:
                    cache.clear()
                    break
                cache[p] = np.array(enc._encode_single_piece(p), "<i4").tobytes()
            try:
                out.append(b"".join(map(cache.__getitem__, part)))
            except KeyError:
                out.append(b"".join([cache.get(p) or np.array(enc._encode_single_piece(p), "<i4").tobytes() for p in part]))
        return b"".join(out)

    return encode


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str | None = None, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``(id, ids array<int>)`` for every row."""
    path = ranks or default_ranks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = encoder(path, chunk, overlap)
        for b in batches:
            for at, n in stretches(b.column(1)):
                part = b.slice(at, n)
                blobs = [one(x) for x in part.column(1).to_pylist()]
                sizes = np.fromiter(map(len, blobs), np.int64, len(blobs)) // 4
                offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
                ids = pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(blobs), "<i4")))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], ["id", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, ids array<int>")


def decode(encoded: DataFrame, id_col: str = "id", ids_col: str = "ids", ranks: str | None = None) -> DataFrame:
    """``(id, ids, raw binary)``: the tokens' bytes one after the other (null ids: no bytes)."""
    path = ranks or default_ranks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _load(path)[1]
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                ids = part.column(1)
                flat, offsets = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
                raw = [b"".join(map(table.__getitem__, flat[p:q].tolist())) for p, q in zip(offsets[:-1], offsets[1:])]
                yield pa.RecordBatch.from_arrays([part.column(0), ids, pa.array(raw, pa.binary())], ["id", "ids", "raw"])

    rows = encoded.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias("ids"))
    return rows.mapInArrow(run, "id long, ids array<int>, raw binary")


def digests(docs: DataFrame, *more: str) -> DataFrame:
    """Round trip of a documents table: count and digest of the ids, digest of the decoded bytes; ``more``: also "ids" or "raw"."""
    return decode(encode(docs)).select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("raw", 256).alias("decoded_sha256"),
        *more,
    )


def op2_bpe(spark, sf_dir: str) -> DataFrame:
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
