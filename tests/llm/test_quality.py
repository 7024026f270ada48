import random

import numpy as np
from casebook.llm import quality


def tables(spark, n=900):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice(["ba", "ke", "li", "mo", "nu"]) for _ in range(rng.randrange(1, 4)))
    docs, labels = [], []
    for i in range(n):
        w = [word() for _ in range(80)]
        if i % 5 == 0:
            w = [x + rng.choice(["###", "$$$"]) for x in w] if i % 2 else [x.upper() + "!!" for x in w]
        docs.append((i, " ".join(w) + ".", "x"))
        if i % 3 == 0:
            labels.append((i, int(i % 5 != 0), 0))
    docs += [(90001, None, "x"), (90002, "", "x"), (None, "ba ke", "x"), (1, docs[1][1], "x")]
    return spark.createDataFrame(docs, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_positives_and_unlabelled(spark):
    docs, labels = tables(spark)
    model = quality.fit(docs, labels)
    assert 0.6 < model["prior"] < 0.95
    got = quality.score(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert np.mean([(r.score >= 0.3) == (r.id % 5 != 0) for r in got if r.id is not None and r.id < 90000]) > 0.97


def test_degenerate(spark):
    docs, labels = tables(spark, 30)
    assert {r.score for r in quality.score(docs, quality.fit(docs, labels.limit(0))).collect()} == {0.0}
    assert quality.score(docs.limit(0), quality.fit(docs, labels)).count() == 0
    assert {r.score for r in quality.score(docs, quality.fit(docs.limit(0), labels)).collect()} == {1.0}


def test_prior_estimate():
    rng = np.random.default_rng(0)
    pos = rng.normal(2, 1, 4000)
    for share in (0.3, 0.6, 0.9):
        unl = np.where(rng.random(4000) < share, rng.normal(2, 1, 4000), rng.normal(-2, 1, 4000))
        assert abs(quality.class_prior(pos, unl) - share) < 0.06


def test_risk_stays_non_negative():
    rng = np.random.default_rng(1)
    make = lambda m, n: np.c_[rng.normal(m, 1, (n, 3)), np.ones(n)]
    pos, unl = make(1.5, 500), np.r_[make(1.5, 300), make(-1.5, 200)]
    w = quality.non_negative(pos, unl, 0.6)
    assert (unl[:300] @ w > 0).mean() > 0.95 and (unl[300:] @ w < 0).mean() > 0.95


def test_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = quality.op9_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality"), "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in got]) > 0.9
