import random

import numpy as np
import pytest

from barlake.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, n int, `a.b` string, _x int"


def brute(rows, components=4):
    """Contract values straight from the definition, with the covariance from whole numbers of any size."""
    ok = {}
    for i, v, *_ in rows:
        if v is not None and all(x is not None and np.isfinite(x) for x in v):
            ok.setdefault(len(v), []).append((i, tuple(int(np.floor(256 * np.float64(np.float32(x)))) for x in v)))
    out = []
    for d, held in ok.items():
        distinct = sorted({x for _, x in held})
        n = len(distinct)
        s = [sum(col) for col in zip(*distinct)]
        big = [[sum((n * x[a] - s[a]) * (n * x[b] - s[b]) for x in distinct) for b in range(d)] for a in range(d)]
        v = np.array([[x / n ** 3 for x in row] for row in big], "f8").reshape(d, d)
        e, u = np.linalg.eigh(v) if d else (np.empty(0), np.empty((0, 0)))
        for k in range(min(components, d)):
            for i, x in held:
                z = np.array([(n * a - b) / n for a, b in zip(x, s)])
                out.append((i, k + 1, n, sum((n * a - b) ** 2 for a, b in zip(x, s)), abs(z @ u[:, -1 - k]) / np.sqrt(e[-1 - k]), e[-1 - k] / np.trace(v)))
    return out


def run(spark, rows, tmp_path):
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(tmp_path / "embeddings.parquet"))
    return W.op13_whitening(spark, str(tmp_path)).collect()


def same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[3], r[4])
    got, want = sorted([(*r[:4], abs(r[4]), r[5]) for r in got], key=key), sorted(want, key=key)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    assert all(abs(a[4] - b[4]) < 1e-7 and abs(a[5] - b[5]) <= 1e-4 * b[5] for a, b in zip(got, want))


def test_equals_brute_force(spark, tmp_path):
    rnd = random.Random(3)
    rows = [(i, [rnd.gauss(0.1 * k, 0.3 + k) for k in range(9)], i, "x", 1) for i in range(300)]
    rows += [(1000 + i, rows[0][1], None, None, None) for i in range(150)] + [(None, rows[1][1], None, None, None)]       # a third of the rows is one vector
    bad = [(1, None, 1, "", 1), (2, [None] * 9, 1, "", 1), (3, [1.0] * 8 + [float("nan")], 1, "", 1), (4, [float("-inf")] + [0.0] * 8, 1, "", 1)]
    got = run(spark, rows + bad, tmp_path)
    same(got, brute(rows))
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-9


def test_one_sign_for_all_rows(spark, tmp_path):
    rnd = random.Random(4)
    rows = [(i, [rnd.random() * (k + 1) for k in range(5)], i, "x", 1) for i in range(80)]
    got = run(spark, rows, tmp_path)
    for k in range(1, 5):
        w = [r.whitened for r in got if r.component == k]
        assert len(w) == 80 and abs(sum(w)) < 1e-9 and abs(sum(x * x for x in w) / 80 - 1) < 1e-9


@pytest.mark.parametrize("span", [1, 300, 1 << 20, (1 << 62) + 5])
def test_cross_products_are_exact(span):
    rnd = random.Random(span)
    for n, d in ((1, 3), (63, 2), (64, 1), (65, 4), (200, 5)):
        x = [[rnd.randrange(-span, span + 1) if k else 7 for k in range(d)] for _ in range(n)]
        sums, products = W.cross_products(np.array(x, "i8"))
        assert sums == [sum(c) for c in zip(*x)]
        assert products.tolist() == [[sum(r[a] * r[b] for r in x) for b in range(d)] for a in range(d)]
    x = [[-(1 << 63), (1 << 63) - 1], [(1 << 63) - 1, 0], [5, -9]]
    assert W.cross_products(np.array(x, "i8"))[1].tolist() == [[sum(r[a] * r[b] for r in x) for b in range(2)] for a in range(2)]


def test_limbs_of_any_sign_and_size():
    for v in (0, 1, -1, 1 << 32, -(1 << 130) + 12345, (1 << 200) - 1):
        assert sum(x << (W.LIMB * k) for k, x in enumerate(W._limbs(v))) == v


def test_lengths_few_vectors_and_huge_entries(spark):
    rows = [(1, [], 1, "", 1), (2, [1.0, 2.0], 1, "", 1), (3, [1.0, 2.0], 1, "", 1), (4, [1.0, 2.0, 4.0], 1, "", 1), (5, [3.0, 2.0, 4.0], 1, "", 1),
            (6, [3e38, -3e38, 1.0, 0.5], 1, "", 1), (7, [0.0, 0.0, 0.0, 0.0], 1, "", 1)]
    got = {r.vec_id: r for r in W.whiten(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert set(got) == {1, 2, 3, 4, 5, 6, 7} and got[1].whitening.whitened == []
    assert got[1]["a.b"] == "" and got[1]._x == 1 and got[1].n == 1
    assert got[2].whitening.whitened == [None, None] and got[2].whitening.explained == [None, None] and got[2].whitening.n == 1     # one distinct vector
    assert abs(abs(got[4].whitening.whitened[0]) - 1) < 1e-12 and got[4].whitening.whitened[1:] == [None, None]
    assert got[4].whitening.explained[0] == 1 and got[4].whitening.identity_error < 1e-9
    big = [(1 << 63) - 1, -(1 << 63), 256, 128]
    assert got[6].whitening.deviation is None and int(got[6].whitening.deviation_exact) == sum(x * x for x in big)


def test_empty_table_and_taken_names(spark, tmp_path):
    assert run(spark, [], tmp_path) == []
    with pytest.raises(ValueError):
        W.whiten(spark.createDataFrame([], SCHEMA), out="N")
