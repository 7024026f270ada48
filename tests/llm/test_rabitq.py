import numpy as np
from casebook.llm import rabitq


def brute(rows, least=0.95):
    ok = [i for i, (_, v) in enumerate(rows) if v and None not in v and np.isfinite(v).all() and np.any(v)]
    x = np.array([rows[i][1] for i in ok], np.float64)
    s = x @ x.T / np.outer(np.linalg.norm(x, axis=1), np.linalg.norm(x, axis=1)) >= least if ok else np.zeros((0, 0), bool)
    links = {i: set() for i in range(len(rows))}
    for a, i in enumerate(ok):
        links[i] = {ok[b] for b in np.flatnonzero(s[a]) if b != a}
    return links


def components(rows, links):
    out = {}
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out[i] = min(rows[j][0] for j in seen)
    return out


def planted(n=600, groups=12, dim=64):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(n, dim))
    for g in range(groups):
        centre = rng.normal(size=dim)
        at = rng.choice(n, 25, replace=False)
        x[at] = centre + rng.normal(size=(25, dim)) * rng.uniform(0.02, 0.16)
    return [(int(i), v.tolist()) for i, v in enumerate(x)]


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, vec string, row int")
    return {r.id: (r.n_links, r.component_id) for r in rabitq.near_duplicates(df, **kw).collect()}


def test_recall_and_components(spark):
    rows = planted()
    links = brute(rows)
    got = run(spark, rows)
    total = sum(map(len, links.values()))
    assert total > 1000 and sum(n for n, _ in got.values()) >= 0.97 * total
    assert all(got[i][0] <= len(links[i]) for i in got)
    want = components(rows, links)
    assert np.mean([got[i][1] == want[i] for i in got]) > 0.98


def test_tiles_count_alike(spark):
    rows = planted(300, 2)
    assert run(spark, rows) == run(spark, rows, tile=7)


def test_unusable_vectors(spark):
    v = [1.0] + [0.0] * 7
    rows = [(1, v), (2, [2 * x for x in v]), (3, None), (4, [0.0] * 8), (5, [None, *v[1:]]), (6, [float("nan")] * 8), (7, [float("inf"), *v[1:]]), (8, []), (9, [1e200] + [0.0] * 7), (10, [1.0, 0.0])]
    got = run(spark, rows)
    assert got == {1: (2, 1), 2: (2, 1), 9: (2, 1)} | {i: (0, i) for i in (3, 4, 5, 6, 7, 8, 10)}
    assert run(spark, []) == {}


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(0)
    a, noise = rng.normal(size=(400, 64)), rng.normal(size=(400, 64))
    b = a + noise * rng.uniform(0, 2, size=(400, 1))
    a, b = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (a, b))
    bits, f = rabitq.encode(a)
    q, scale = rabitq.image(bits, f, 64)
    value, exact = q @ b.T, a @ b.T
    spread = scale[:, None] * np.sqrt(np.clip(1 - value**2, 1e-4, None))
    assert abs((value - exact).mean()) < 0.005
    assert (np.abs(value - exact) <= rabitq.DEVIATIONS * spread + 1e-6).mean() > 0.9999


def test_recall_on_table(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    links = brute(rows)
    got = {r.vec_id: r for r in rabitq.op8_rabitq(spark, sf).collect()}
    total = sum(map(len, links.values()))
    assert len(got) == len(rows) and sum(r.n_links for r in got.values()) >= 0.9 * total
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())
