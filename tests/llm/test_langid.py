import itertools
import random
import zlib

import numpy as np
from casebook.llm import langid

CYR = "привет мир как дела сегодня хорошо очень".split()
LATIN = {"aa": "baka tama kala raka maka saka".split(), "ee": "teren kelen merel perel nerek selen".split()}


def table(spark, n=60):
    rng = random.Random(0)
    rows = [(i, " ".join(rng.choice(LATIN[k]) for _ in range(30)), k, "s") for i, k in enumerate(["aa", "ee"] * n)]
    rows += [(1000 + i, " ".join(rng.choice(CYR) for _ in range(30)), "ru", "s") for i in range(n)]
    rows += [(5001, None, "aa", "s"), (5002, "", "ee", "s"), (5003, "12 — !?", None, "s"), (None, "baka tama", None, "s"), (5004, "²³", None, "s")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, spans string")


def test_predictions(spark):
    df = table(spark)
    model = langid.fit(df)
    rows = {r.id: r for r in langid.predict(df, model).collect()}
    assert len(rows) == df.count()
    for r in df.collect():
        if r.lang and r.text:
            assert rows[r.doc_id].lang_pred == r.lang and rows[r.doc_id].score == 1.0
    assert all(rows[i].lang_pred == "und" and rows[i].score == 0 and rows[i].spans == [] for i in (5001, 5002, 5003, 5004))
    assert rows[None].lang_pred == "aa"


def test_mixed_spans(spark):
    model = langid.fit(table(spark))
    text = " ".join(LATIN["aa"] * 3 + LATIN["ee"] * 5 + CYR * 2)
    (r,) = langid.predict(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).collect()
    assert [(s.lang, text[s.start : s.end].split()[0]) for s in r.spans] == [("aa", "baka"), ("ee", "teren"), ("ru", "привет")]
    assert r.spans[0].start == 0 and r.spans[-1].end == len(text) and r.lang_pred == "ee"


def test_search_is_the_best_path():
    rng = np.random.default_rng(0)
    for trial in range(30):
        model = {"langs": ["a", "b", "c"], "prior": np.log(np.array([0.6, 0.3, 0.1]))}
        lab = langid.Labeller.__new__(langid.Labeller)
        lab.m, lab.number, lab.scores, lab.letters = model, {f"w{'abcdefgh'[i]}": i for i in range(8)}, rng.normal(0, [1, 6][trial % 2], (8, 3)), np.ones(8, np.int64)
        texts = [" ".join(f"w{rng.choice(list('abcdefgh'))}" for _ in range(rng.integers(0, 7))) for _ in range(6)]
        path, _, first = lab.paths(texts)
        for d, t in enumerate(texts):
            ids = [lab.number[w] for w in t.split()]
            if not ids:
                continue
            value = lambda p: model["prior"][p[0]] + sum(lab.scores[i, k] for i, k in zip(ids, p)) - langid.SWITCH * sum(x != y for x, y in zip(p, p[1:]))  # noqa: B023, E731
            best = max(map(value, itertools.product(range(3), repeat=len(ids))))
            assert abs(value(path[first[d] : first[d + 1]].tolist()) - best) < 1e-9


def test_nothing_to_learn(spark):
    df = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert langid.predict(df, langid.fit(df)).first().lang_pred == "und"
    assert langid.predict(df.limit(0), langid.fit(df)).count() == 0


def test_held_out_accuracy(spark, sf):
    got = langid.op5_langid(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.95


def test_stage_follows_the_model(spark):
    from pyspark.sql import functions as F

    df = table(spark)
    junk = [(7001, "xqjz wvkp bnzq gfhx xvzq jwpk " * 5, None, "s"), (7002, " ".join(LATIN["aa"] * 9 + CYR * 4), None, "s"), (7003, " ".join(CYR * 5), "zz", "s")]
    docs = df.unionByName(spark.createDataFrame(junk, df.schema))
    kept = {r.doc_id for r in langid.keep_identified(docs, langid.fit(df)).collect()}
    assert kept == {r.doc_id for r in df.collect()} - {5001, 5002, 5003, 5004} | {7002, 7003}
    fewer = langid.fit(df.where("lang <> 'ru'"))
    left = {r.doc_id for r in langid.keep_identified(docs, fewer).collect()}
    assert left == {i for i in kept if i is None or i < 1000} | {7002}, "texts in a script that wasn't learned go"
    rows = langid.keep_identified(docs.withColumn("Found", F.lit(1)), langid.fit(df))
    assert rows.columns == [*docs.columns, "Found"] and langid.keep_identified(docs.limit(0), fewer).count() == 0


def test_many_languages(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6))
    known = [[word() for _ in range(4)] for _ in range(1001)]
    rows = [(3 * i + j, " ".join(w * 3), f"l{i}") for i, w in enumerate(known + [[word() for _ in range(4)] for _ in range(80)]) for j in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df)
    learned = {n for i, _, n in rows if zlib.crc32(str(i).encode()) % 3 != 1}
    assert len(learned) > 950 and model["langs"] == sorted(learned) and model["logp"].size <= 1 << langid.MODEL_BITS
    some = langid.predict(df.where("doc_id % 50 = 0 or doc_id >= 3000"), model).collect()
    some = [r for r in some if f"l{r.id // 3}" in learned]
    assert len(learned) > 1001 and np.mean([r.lang_pred == f"l{r.id // 3}" for r in some]) > 0.95


def test_very_long_text(spark):
    df = table(spark)
    text = " ".join(LATIN["ee"] * 60_000 + LATIN["aa"] * 20_000)
    one = spark.createDataFrame([(1, text)], "doc_id long, text string")
    r = langid.predict(one, langid.fit(df)).first()
    assert r.lang_pred == "ee" and [s.lang for s in r.spans] == ["ee", "aa"] and r.spans[-1].end == len(text)
    assert langid.keep_identified(one, langid.fit(df)).count() == 1
