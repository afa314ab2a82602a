from collections import Counter, defaultdict

from pyspark.sql import functions as F

from barlake.llm import mixing as M

SCHEMA = "doc_id long, text string, source string, key string, size long, h string"


def targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        w = sum(weight[s] for s in names if s not in capped)
        t = {s: 3 * sizes[s] if s in capped else rest * weight[s] / w for s in names}
        over = {s for s in names if s not in capped and t[s] > 3 * sizes[s]}
        if not over:
            return t
        capped |= over


def run(spark, rows):
    return M.mix_sources(spark.createDataFrame(rows, SCHEMA).repartition(3))


def test_targets_near_budget_and_repeatable(spark):
    import random
    rnd = random.Random(2)
    src = lambda: rnd.choice(["hot"] * 6 + ["a", "ab", "b", "é", "𐐷", "￿", None])
    rows = [(i, " ".join("w" * 3 for _ in range(rnd.randrange(0, 60))), src(), None, None, None) for i in range(3000)]
    rows += [(None, None, None, None, None, None)] * 5 + [(9004, "x y", "a", "k", 9, "h")] * 5
    sizes = defaultdict(int)
    for _, t, s, *_ in rows:
        sizes[s] += len((t or "").split())
    want = targets(sizes)
    df = run(spark, rows)
    out = df.withColumn("source", F.lit(0)).collect()
    source = {i: s for i, _, s, *_ in rows}
    taken = Counter()
    for r in out:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and 0 <= r.copies <= 3 and abs(r.target - want[s]) < 1e-6
        taken[s] += r.size * r.copies
    for s, v in want.items():
        assert abs(taken[s] - v) <= 60, (s, taken[s], v)
    assert sorted(map(str, run(spark, rows).collect())) == sorted(map(str, df.collect()))


def test_copies_are_taken_in_part(spark):
    """A source of 310 rows, 300 of them copies of one: its words come within half a row of the target, in the mix and in the repeated rows."""
    rows = [(1, "same words here in ten parts for all of us", "a", None, None, None)] * 300
    rows += [(10 + i, " ".join(f"w{i}" for _ in range(10)), "a", None, None, None) for i in range(10)]
    rows += [(100 + i, "x y z " * (i % 5), "b", None, None, None) for i in range(400)] + [(None, None, "c", None, None, None)] * 30
    sizes = defaultdict(int)
    for _, t, s, *_ in rows:
        sizes[s] += len((t or "").split())
    want, df = targets(sizes), spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = [Counter(), Counter()]
    for r in M.mix_sources(df).collect():
        got[0]["a" if r.doc_id is not None and r.doc_id < 100 else "b" if r.doc_id else "c"] += r.size * r.copies
    for r in M.repeat_rows(df).collect():
        got[1][r.source] += len((r.text or "").split())
    assert 0 < want["a"] % sizes["a"] and got[0]["a"] == got[1]["a"]
    for s in ("a", "b"):
        assert all(abs(g[s] - want[s]) <= (5 if s == "a" else 12) for g in got), (s, got, want)
    again = Counter(map(str, M.mix_sources(df.repartition(2)).collect()))
    assert again == Counter(map(str, M.mix_sources(df).collect()))


def test_a_very_long_text(spark):
    rows = [(1, "word " * 300_000, "a", None, None, None), (2, "b " * 10, "a", None, None, None), (3, "c " * 200, "z", None, None, None)]
    got = {r.doc_id: r.size for r in run(spark, rows).collect()}
    assert got == {1: 300_000, 2: 10, 3: 200}


def test_nested_budgets_take_supersets(spark):
    rows = spark.createDataFrame([(i,) for i in range(4000)], "i long").select(
        F.lit("1s").alias("key"), F.lit(3).cast("long").alias("size"), M.row_hash("i", "key").alias("h"))
    picked = []
    for budget in (100.0, 1000.0, 6000.0, 12000.0):
        th = M.hash_thresholds(rows, spark.createDataFrame([("1s", budget)], "key string, budget double")).first().threshold
        got = {r.h for r in rows.where(F.col("h") <= th).collect()}
        assert abs(3 * len(got) - budget) <= 3
        picked.append(got)
    assert all(a <= b for a, b in zip(picked, picked[1:]))


def test_edge_tables(spark):
    assert run(spark, []).collect() == []
    zero = [(1, None, "a", None, None, None), (2, "", None, None, None, None)]
    assert {(r.size, r.target) for r in run(spark, zero).collect()} == {(0, 0.0)}
    one = [(i, "a b c", "s", None, None, None) for i in range(4)]
    assert [(r.target, r.copies) for r in run(spark, one).collect()] == [(12.0, 1)] * 4


def test_repeat_rows_follows_the_mix_and_keeps_columns(spark):
    rows = [(i, "w " * (i % 7), f"s{i % 5 if i % 2 else 0}", str(i), i, "h") for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA)
    copies = {r.doc_id: r.copies for r in M.mix_sources(df).collect()}
    got = Counter(tuple(r) for r in M.repeat_rows(df).collect())
    assert got == Counter({tuple(r): copies[r[0]] for r in rows if copies[r[0]]})
