import base64
import hashlib
import random

import public_tokenizers
import pytest
import regex
import tiktoken
from casebook.llm import bpe

PATTERN = regex.compile(public_tokenizers.PATTERN)


def library():
    with open(bpe.default_ranks(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def enc():
    return library()


def texts():
    rng = random.Random(1)
    alphabet = ["a", "re", "'", "'re", " ", "  ", "\n", "é", "漢字", "🙂", "7", "12", "!", "?!", " ", "don't", "<|endoftext|>"]
    out = [None, "", " ", "x" * 500, " " * 300 + "x", "'" * 200 + "ll", "12" * 200]
    for _ in range(60):
        out.append("".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 400))))
    return out


@pytest.mark.parametrize(("chunk", "overlap"), [(5, 1), (11, 4), (40, 16), (64, 64)])
def test_stitched_pieces_are_those_of_the_whole(chunk, overlap):
    for t in texts():
        got = [p for part in bpe.pieces(PATTERN, t or "", chunk, overlap) for p in part]
        assert got == PATTERN.findall(t or "")


def test_round_trip_matches_library(spark, enc):
    rows = list(enumerate(texts())) + [(3, "again"), (None, "no id")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, ids string")
    got = sorted(((r.id, tuple(r.ids), bytes(r.raw)) for r in bpe.decode(bpe.encode(df, chunk=17, overlap=6)).collect()), key=str)
    want = sorted(((i, tuple(enc.encode_ordinary(t or "")), (t or "").encode()) for i, t in rows), key=str)
    assert got == want


def test_query(spark, sf, enc):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = bpe.op2_bpe(spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        ids, raw = enc.encode_ordinary(docs[r.doc_id]), docs[r.doc_id].encode()
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(raw).hexdigest()


def test_empty(spark):
    assert bpe.digests(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_cache_overflow(monkeypatch, enc):
    monkeypatch.setattr(bpe, "CACHED", 5)
    one = bpe.encoder(bpe.default_ranks())
    import numpy as np

    for t in texts():
        assert np.frombuffer(one(t), "<i4").tolist() == enc.encode_ordinary(t or "")
