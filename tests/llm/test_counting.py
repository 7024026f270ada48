import random

import pytest
from casebook.llm import counting
from tokenizers import Tokenizer, models


@pytest.fixture(scope="module")
def real():
    return counting.vocabulary(counting.default_model())


def library(pieces):
    from sentencepiece import SentencePieceProcessor

    m = SentencePieceProcessor(model_file=counting.default_model())
    byte = [(f"<0x{i:02X}>", -1e9) for i in range(256)]
    assert m.is_byte(3)
    return Tokenizer(models.Unigram([("<unk>", -1e9), *byte, *pieces.items()], 0, True))


def naive(pieces, text):
    """Straight dynamic programming over ascending starts with a strict comparison."""
    s, low = counting.marked(text), min(pieces.values()) - 10
    best = [(0.0, 0)] + [None] * len(s)
    for a in range(len(s)):
        single = False
        for b in range(a + 1, min(len(s), a + 20) + 1):
            if s[a:b] in pieces:
                single |= b == a + 1
                v = best[a][0] + pieces[s[a:b]]
                if best[b] is None or v > best[b][0]:
                    best[b] = (v, best[a][1] + 1)
        if not single:
            v = best[a][0] + low
            if best[a + 1] is None or v > best[a + 1][0]:
                best[a + 1] = (v, best[a][1] + len(s[a].encode()))
    return best[-1][1]


def texts(alphabet, n=200):
    rng = random.Random(6)
    return [None, "", " ", "\x00", "a\x00b\x00\x00 c", "▁x ▁"] + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 60))) for _ in range(n)]


def test_small_vocabulary_with_ties():
    pieces = {"▁": -3.0, "a": -2.0, "b": -2.0, "ab": -4.0, "aba": -6.0, "▁a": -5.0, "bb": -3.0, "▁▁": -6.0, "abab": -7.0}
    c = counting.Counter(pieces)
    for t in texts("aabb cé🙂"):
        assert c.count(t) == naive(pieces, t), t


def test_real_vocabulary(real):
    c = counting.Counter(real)
    for t in texts(["the ", "contract", "ung ", "é", "漢", "🙂🙂", "  ", "\n", "x", "1", "zq", "tion"]):
        assert c.count(t) == naive(real, t), t


def test_library(real):
    """Against a public implementation of the unigram model, where its own rules on byte pieces don't differ."""
    tok, c = library(real), counting.Counter(real | {})
    for t in texts(["the ", "contract", "ung ", "é", "  ", "x", "1", "zq", "tion", ", "]):
        if t and "\x00" not in t:
            assert c.count(t) == len(tok.encode(counting.marked(t), add_special_tokens=False).ids), t


def test_rows(spark, sf, real):
    df = spark.createDataFrame([(1, "a b", "x"), (1, "a b", "y"), (None, None, "z"), (2, "", None), (3, "word " * 30_000, "")], "doc_id long, text string, n_tokens string")
    got = sorted((tuple(r) for r in counting.token_counts(df).collect()), key=str)
    assert got == sorted([(1, naive(real, "a b"))] * 2 + [(None, 0), (2, 0), (3, naive(real, "word " * 30_000))], key=str)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    some = {r.doc_id: r.text for r in docs.collect()}
    rows = counting.op4_counts(spark, sf).collect()
    assert len(rows) == len(some)
    assert all(r.n_tokens == naive(real, some[r.doc_id]) for r in rows[:40])
    assert counting.token_counts(df.limit(0)).count() == 0
