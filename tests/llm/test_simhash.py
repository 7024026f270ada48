import random

import xxhash
from casebook.llm import simhash


def brute(text):
    w = [x for x in __import__("re").findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))]
    sh = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(rows):
    fp = {i: brute(t) for i, t in rows}
    ids = sorted(fp)
    root = {i: i for i in ids}
    for a in ids:
        for b in ids:
            if (fp[a] ^ fp[b]).bit_count() <= 3:
                x, y = root[a], root[b]
                if x != y:
                    root = {k: (min(x, y) if v in (x, y) else v) for k, v in root.items()}
    return {i: (f"{fp[i]:016x}", root[i]) for i in ids}


def check(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, fp string")
    got = {r.id: (f"{r.fp % 2**64:016x}", r.component_id) for r in simhash.near_duplicates(df, **kw).collect()}
    assert got == groups(rows)


def test_small_cases(spark):
    rng = random.Random(3)
    vocab = [f"Wort{i}é" for i in range(300)]
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "One"), (4, "one TWO"), (5, "a b c"), (6, "A\x0bB\x0cC"), (7, "ß\xa0x y")]
    for i in range(20, 60):
        w = [rng.choice(vocab) for _ in range(200)]
        rows.append((i, " ".join(w)))
        w[rng.randrange(200)] = "changed"
        rows.append((i + 100, " ".join(w)))
        rows.append((i + 200, "\n".join(w)))
    check(spark, rows)


def test_hot_group_is_tiled(spark):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(150):
        w = list(base)
        w[rng.randrange(400)] = f"z{i}"
        rows.append((i, " ".join(w)))
    check(spark, rows, tile=16)


def test_empty(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_blocks_of_long_text(monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 7)
    t = " ".join(f"w{i % 13}{i}" for i in range(100))
    assert simhash.fingerprint(t.encode()) == brute(t)


def test_chain(spark):
    from casebook.llm.common import connected

    e = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = dict(connected(e).collect())
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def test_shuffled_path_takes_few_rounds(spark, monkeypatch):
    from casebook.llm import common

    order = list(range(2000))
    random.Random(1).shuffle(order)
    written, write = [], common.cut
    monkeypatch.setattr(common, "cut", lambda df: written.append(1) or write(df))
    got = dict(common.connected(spark.createDataFrame(list(zip(order, order[1:])), "a long, b long")).collect())
    assert got == dict.fromkeys(order, 0) and len(written) <= 22


def test_scratch_needs_a_shared_folder():
    from types import SimpleNamespace as N

    import pytest
    from casebook.llm.common import scratch_root

    conf = N(get=lambda *_: None)
    session = N(conf=conf, sparkContext=N(getConf=lambda: conf, master="spark://host:7077", applicationId="other"))
    with pytest.raises(ValueError):
        scratch_root(session)
