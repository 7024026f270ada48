import random

import numpy as np
from casebook.llm import toxicity
from pyspark.sql import functions as F


def tables(spark, n=400):
    rng = random.Random(1)
    clean = [f"{a}{b}" for a in ("ka", "lo", "mi", "tu") for b in ("ra", "se", "no", "pi", "du")]
    bad = ["grobax", "grobul", "vilpo"]
    docs, labels = [], []
    for i in range(n):
        y = i % 4 == 0
        w = [rng.choice(clean) for _ in range(60)]
        for _ in range(3 if y else 0):
            w[rng.randrange(60)] = rng.choice(bad)
        docs.append((i, " ".join(w), "x"))
        if i % 3 or i % 5 == 0:
            labels.append((i, int(y), 1))
    docs += [(9001, None, "x"), (9002, "", "x"), (None, "grobax grobul vilpo", "x"), (0, docs[0][1], "x")]
    return spark.createDataFrame(docs, "doc_id long, text string, score string"), spark.createDataFrame(labels + [labels[0]], "doc_id long, toxic int, quality int")


def test_learned_words(spark):
    docs, labels = tables(spark)
    got = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    assert len(got) == docs.count()
    truth = [(r.score >= 0.5) == (r.id % 4 == 0) for r in got if r.id is not None and r.id < 9000]
    assert np.mean(truth) > 0.97
    assert all(0 <= r.score <= 1 for r in got)
    assert {r.score < 0.5 for r in got if r.id in (9001, 9002)} == {True} and all(r.score > 0.5 for r in got if r.id is None)


def test_without_labels(spark):
    docs, labels = tables(spark, 20)
    assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, labels.limit(0))).collect()} == {0.0}
    assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, labels.withColumn("toxic", F.lit(1)))).collect()} == {1.0}
    assert toxicity.score(docs.limit(0), toxicity.fit(docs, labels)).count() == 0
    assert toxicity.fit(docs.limit(0), labels)["weights"] is None


def test_label_model_against_wrong_labels_and_copied_voters():
    rng = np.random.default_rng(0)
    y = rng.random(4000) < 0.2
    good = [(rng.random(4000) < np.where(y, 0.6, 0.02)) for _ in range(4)]
    noise = rng.random(4000) < 0.1
    none = ~np.any([*good, noise], axis=0)
    votes = np.stack([*good, noise, noise, noise, none], 1).astype(float)
    told = np.where(rng.random(4000) < 0.05, ~y, y).astype(int)
    post = toxicity.label_model(votes, told, np.ones(4000))
    assert ((post > 0.5) == y).mean() > (told == y).mean() + 0.01


def test_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = toxicity.op3_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic"), "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.toxic for r in got]) > 0.9
