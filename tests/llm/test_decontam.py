import hashlib
import random
import re

from casebook.llm import decontam


def words(t):
    t = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)


def brute(docs, items):
    wins = []
    for name, t in items:
        w = words(t)
        n = min(13, len(w))
        if n:
            wins += [(str(name), tuple(w[k : k + n])) for k in range(len(w) - n + 1)]
    out = []
    for i, t in docs:
        w = words(t)
        hit, names = set(), set()
        for name, x in wins:
            for p in range(len(w) - len(x) + 1):
                if tuple(w[p : p + len(x)]) == x:
                    hit.update(range(p, p + len(x)))
                    names.add(name)
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(names), digest, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def run(spark, docs, items, **kw):
    d = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, items string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.contamination(d, b, **kw).collect()
    return sorted(((r.id, r.n_words, r.n_hit, len(r.items), hashlib.sha256(",".join(sorted(r.items)).encode()).hexdigest(), r.contaminated) for r in got), key=str)


def test_against_brute_force(spark):
    rng = random.Random(2)
    vocab = ["the", "of", "Ärger", "x1", "été", "and", "ZZ"] + [f"w{i}" for i in range(30)]
    text = lambda n: rng.choice([" ", ", ", "\n"]).join(rng.choice(vocab) for _ in range(n))
    items = [(i, text(rng.randrange(1, 30))) for i in range(12)] + [(50, ""), (51, None), (52, "?!"), (10, "zz w1"), (100, text(13))]
    docs = [(i, text(rng.randrange(0, 80))) for i in range(60)] + [(900, None), (901, ""), (902, "...")]
    for i in range(40):
        docs.append((1000 + i, f"{text(rng.randrange(0, 200))}; {rng.choice(items)[1] or ''}. {text(rng.randrange(3))}"))
    docs.append((1000, docs[-1][1]))
    assert run(spark, docs, items) == brute(docs, items)
    assert run(spark, docs, items, items_mb=100 / (1 << 20)) == brute(docs, items)


def test_empty_sides(spark):
    assert run(spark, [], [(1, "a b")]) == []
    assert run(spark, [(1, "a b")], []) == brute([(1, "a b")], [])


def test_shards_and_long_text(spark, monkeypatch):
    items = [(1, " ".join(f"w{i}" for i in range(20)))]
    docs = [(i, "x " * 500 + " ".join(f"W{k}" for k in range(i, i + 15))) for i in range(10)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    assert decontam.build_index(d.coalesce(1), shard=1000).count() == 10
    assert run(spark, docs, items) == brute(docs, items)


def test_proximity(spark):
    items = spark.createDataFrame([(7, "alpha beta gamma")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "alpha x beta x gamma"), (2, "alpha " + "x " * 50 + "beta gamma"), (3, "gamma beta")], "doc_id long, text string")
    assert [tuple(r) for r in decontam.near(docs, items, slack=3).collect()] == [(1, "7")]


def test_index_holds_every_term():
    row = decontam.postings_of([b"b a b", None, b"", b"a c"])
    s = decontam.Shard(row | {"doc_ids": [1, 2, 3, 4]}, {b"a": 0, b"z": 1, b"b": 2})
    assert row["terms"] == b"b a c" and s.df.tolist() == [2, 0, 2, 0]
    assert s.postings(0).tolist() == [1, 6] and s.postings(2).tolist() == [0, 2] and not len(s.postings(1))
    assert s.holds(decontam.np.array([0, 0, 2, 2]), decontam.np.array([1, 2, 2, 20])).tolist() == [True, False, True, False]


def test_decontaminate_drops_what_contamination_names(spark):
    rng = random.Random(5)
    text = lambda n: " ".join(rng.choice("abcdefgh") + rng.choice("xyz") for _ in range(n))
    items = [(k, text(15)) for k in range(6)] + [(9, "ax")]
    docs = [(k % 37, rng.choice([None, "", text(30), text(400) + " " + items[k % 6][1], items[k % 6][1]]), k) for k in range(120)]
    d = spark.createDataFrame(docs, "doc_id long, text string, n int")
    b = spark.createDataFrame(items, "item_id long, text string")
    flags = brute([(n, t) for _, t, n in docs], items)
    want = sorted(f[0] for f in flags if not f[5])
    assert 0 < len(want) < len(docs)
    for size in (decontam.ITEMS_MB, 50 / (1 << 20)):
        got = decontam.decontaminate(d, b, items_mb=size)
        assert got.columns == d.columns and sorted(r.n for r in got.collect()) == want
    assert decontam.decontaminate(d.limit(0), b).count() == 0 and decontam.decontaminate(d, b.limit(0)).count() == len(docs)


def test_query(spark, sf):
    got = sorted((tuple(r) for r in decontam.op7_decontam(spark, sf).collect()), key=str)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert got == brute(docs, items)
