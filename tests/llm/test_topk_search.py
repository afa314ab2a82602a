import numpy as np

from barlake.llm import topk_search as T

SCHEMA = "vec_id long, embedding array<double>, block long, score string"


def brute(rows, qids, k):
    seen = {}
    for i, v, *_ in rows:
        if i is None or not v or any(x is None or not np.isfinite(x) for x in v):
            continue
        seen.setdefault((i, tuple(int(np.floor(64 * x)) for x in v)), None)
    out = []
    for i, v in seen:
        if i in qids:
            s = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in seen if j != i and len(w) == len(v))[:k]
            out += [(i, r + 1, j, -x) for r, (x, j) in enumerate(s)]
    return sorted(out)


def run(spark, rows, qids, k):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted(tuple(r) for r in T.top_k(df, df.where(df.vec_id.isin(*qids)), k).collect())


def rows_of(seed, n, dim, copies=0):
    g = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in g.normal(size=dim) * g.choice([0.01, 0.3, 1, 8])], None, None) for i in range(n)]
    rows += [(n + i, rows[5][1], 1, "x") for i in range(copies)]
    return rows


def test_equals_brute_force_with_lengths_ties_and_bad_vectors(spark):
    rows = rows_of(1, 300, 6, copies=80)
    rows += [(900, None, None, None), (901, [], None, None), (902, [1.0, None] + [0.0] * 4, None, None), (903, [float("nan")] * 6, None, None),
             (904, [float("inf")] * 6, None, None), (None, [1.0] * 6, None, None), (905, [0.0] * 6, None, None), (906, [1.0, 2.0], None, None),
             (907, [2.0, 1.0], None, None), rows[0], rows[0]]
    q = [0, 5, 20, 301, 900, 902, 905, 906]
    assert run(spark, rows, q, 7) == brute(rows, q, 7)


def test_unit_vectors_use_coordinates(spark, monkeypatch):
    monkeypatch.setattr(T, "SLICE_ROWS", 64)
    g = np.random.default_rng(3)
    rows = []
    for i in range(400):
        v = g.normal(size=4)
        rows.append((i, [float(x) for x in v / np.linalg.norm(v)], None, None))
    q = list(range(0, 400, 20))
    assert run(spark, rows, q, 20) == brute(rows, q, 20)


def test_fewer_than_k_and_empty(spark):
    rows = rows_of(4, 3, 5)
    assert run(spark, rows, [0, 1], 20) == brute(rows, [0, 1], 20)
    assert run(spark, [], [0], 20) == []


def test_block_search_prunes_but_loses_nothing():
    g = np.random.default_rng(5)
    v = g.integers(-60, 60, (500, 8))
    ids = np.arange(500)
    q = v[:30]
    bounds = [np.sort(np.delete(v @ x, i))[-5] for i, x in enumerate(q)]
    for qi, bi, bs in T.search_block(ids, v, ids[:30], q, np.array(bounds, "f8"), 5):
        s = sorted((-int(x), j) for j, x in enumerate(v @ q[qi]) if j != qi)[:5]
        assert list(zip((-bs).tolist(), bi.tolist())) == s


def test_blocks_of_like_reach_meet_few_slices_and_lose_nothing(spark, monkeypatch):
    """Lengths from 1 to 1,000 in many slices, two dimensions, queries without a positive score, copies in several blocks."""
    monkeypatch.setattr(T, "SLICE_ROWS", 16)
    monkeypatch.setattr(T, "QUERY_ROWS", 8)
    g = np.random.default_rng(11)
    rows = [(i, [float(x) for x in g.normal(size=3) * 10 ** g.uniform(-1, 1.2)], None, None) for i in range(500)]
    rows += [(500 + i, rows[7][1], None, None) for i in range(60)] + [(600 + i, [float(x) for x in -abs(g.normal(size=2))], None, None) for i in range(40)]
    rows += [(700, [1.0, 1.0], None, None), (701, [0.0] * 3, None, None)]
    q = [*range(0, 600, 10), *range(600, 640, 5), 700, 701]
    assert run(spark, rows, q, 5) == brute(rows, q, 5)
