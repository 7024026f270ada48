import corpus_pipeline
from casebook.llm import pii

from tests.llm import test_bpe, test_decontam, test_simhash


def test_stages_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    more = [(90001, None, "en", "s", 0), (90002, "12 34", None, "s", 5), (90003, "xqjz wvkp bnzq gfhx xvzq jwpk zxcv qqpz " * 5, None, "s", 200), (None, "no id here but words", "en", "s", 20), (3, docs.where("doc_id = 3").first().text, "en", "s", 1), (3, docs.where("doc_id = 3").first().text, "en", "s", 1)]
    docs = docs.unionByName(spark.createDataFrame(more, docs.schema))
    kept = corpus_pipeline.language(spark, docs, sf)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert sorted((r.doc_id or -1, r.text) for r in rows) == sorted((r.doc_id or -1, r.text) for r in docs.collect() if r.doc_id not in (90001, 90002, 90003))
    out = corpus_pipeline.near_dedup(spark, kept, sf)
    assert out.columns == docs.columns
    texts = {i: t for i, t in enumerate(sorted({r.text for r in rows}))}
    group = test_simhash.groups(list(texts.items()))
    of = {t: group[i][1] for i, t in texts.items()}
    want = {}
    for r in rows:
        want[of[r.text]] = min(want.get(of[r.text], 10**9), 10**8 if r.doc_id is None else r.doc_id)
    got = out.collect()
    assert sorted(10**8 if r.doc_id is None else r.doc_id for r in got) == sorted(want.values())
    clean = corpus_pipeline.decontamination(spark, out, sf)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    bad = {x[0] for x in test_decontam.brute([(r.doc_id, r.text) for r in got], items) if x[-1]}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in got} - bad and clean.columns == docs.columns
    masked = corpus_pipeline.pseudonyms(spark, clean, sf)
    assert masked.columns == docs.columns and masked.count() == clean.count()
    assert all(r.n_chars == len(r.text) for r in masked.collect())
    assert masked.select("doc_id", "text").exceptAll(pii.pseudonymize(clean.select("doc_id", "text"), key=pii.query_key(spark)).select("doc_id", "text")).isEmpty()
    ids = corpus_pipeline.tokens(spark, masked, sf)
    enc = test_bpe.library()
    text = {r.doc_id: r.text for r in masked.collect()}
    for r in ids.collect():
        assert r.n_tokens == len(r.ids)
        assert list(r.ids) == enc.encode_ordinary(text[r.doc_id])


def test_run(spark, sf):
    df = corpus_pipeline.run(spark, sf)
    assert {"doc_id", "n_tokens", "ids"} <= set(df.columns) and 0 < df.count() < 200
