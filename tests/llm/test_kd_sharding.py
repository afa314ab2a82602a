import zlib

from pyspark.sql import functions as F

from barlake.llm.kd_sharding import kd_shards, name_ranks

SCHEMA = "doc_id long, text string, lang string, source string, node long, slice string"


def check(rows, out, shards):
    size = lambda t: len((t or "").encode()) + 1
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in out if r.doc_id is not None) == sorted(
        (i, size(t), zlib.crc32((t or "").encode())) for i, t, *_ in rows if i is not None)
    assert len(out) == len(rows)
    load = [0] * shards
    for s in range(shards):
        mine = [r for r in out if r.shard == s]
        assert sorted(r.slot for r in mine) == list(range(len(mine)))
        load[s] = sum(r.size for r in mine)
    return load


def test_leaves_are_near_equal_for_mixed_and_hot_tables(spark):
    import random
    rnd = random.Random(1)
    rows = [(i, "é" * rnd.randrange(0, 400), rnd.choice(["en", "de", None]), f"src{rnd.randrange(9)}", None, None) for i in range(1500)]
    rows += [(5000 + i, "same text", "en", "hot", None, None) for i in range(1500)]
    rows += [(None, None, None, None, None, None)] * 40 + [(7, "", "en", "", 1, "x")] * 30
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for shards in (8, 3, 1):
        load = check(rows, kd_shards(df, shards=shards).collect(), shards)
        assert max(load) - min(load) <= 0.02 * sum(load) / shards + 800 * 3
    target = sum(load) // 4
    load = check(rows, kd_shards(df, target_bytes=target).collect(), 4)
    assert max(load) <= 1.05 * target + 800


def test_small_empty_and_plain_tables(spark):
    assert kd_shards(spark.createDataFrame([], SCHEMA), shards=8).collect() == []
    rows = [(1, "a", None, None, None, None), (2, "b" * 200_000, None, None, None, None)]
    check(rows, kd_shards(spark.createDataFrame(rows, SCHEMA), shards=8).collect(), 8)
    bare = [(i, "text %d" % i) for i in range(64)]
    out = kd_shards(spark.createDataFrame(bare, "doc_id long, text string"), shards=8).collect()
    load = check(bare, out, 8)
    assert max(load) - min(load) <= 24


def places(rows, spark):
    """Coordinates of every row by the operator's definition, from sorted Python lists; text codes are Spark's hash."""
    from math import log2
    texts = sorted({r[1] or "" for r in rows})
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.shiftrightunsigned(F.xxhash64(F.encode("t", "UTF-8")), 2).alias("h"))
    code = {r.t: r.h for r in df.collect()}
    rank = lambda k: {v: i for i, v in enumerate(sorted({r[k] for r in rows if r[k] is not None}, key=lambda v: v.encode()))}
    sources, langs = rank(3), rank(2)
    out = [[sources.get(r[3], -1), langs.get(r[2], -1), round(log2(len((r[1] or "").encode()) + 1.0) * 65536), -1 if r[0] is None else r[0]] for r in rows]
    low = {}
    for r, p in zip(rows, out):
        t = r[1] or ""
        low[t] = [min(a, b) for a, b in zip(low.get(t, p), p)]
    return [(low[r[1] or ""], code[r[1] or ""]) for r in rows]


def brute(rows, spark, shards):
    """Shard of every text: split at the weighted median of the widest dimension, equal texts whole. For groups of half a leaf at most."""
    at = places(rows, spark)
    size = [len((r[1] or "").encode()) + 1 for r in rows]
    spread = [max(1, max(p[d] for p, _ in at) - min(p[d] for p, _ in at)) for d in range(4)]
    leaves = []

    def split(mine, k):
        if k == 1:
            leaves.append(mine)
            return
        d = max(range(4), key=lambda d: (max(at[i][0][d] for i in mine) - min(at[i][0][d] for i in mine)) / spread[d])
        total, left, want = sum(size[i] for i in mine), 0, None
        want, groups = total * (k // 2) / k, {}
        for i in mine:
            groups.setdefault((at[i][0][d], at[i][1]), []).append(i)
        cut = []
        for g in sorted(groups):
            b = sum(size[i] for i in groups[g])
            if left + b >= want:
                if 2 * (want - left) >= b:
                    cut += groups[g]
                break
            left += b
            cut += groups[g]
        taken = set(cut)
        split(cut, k // 2)
        split([i for i in mine if i not in taken], k - k // 2)

    split(list(range(len(rows))), shards)
    return {rows[i][1] or "": s for s, leaf in enumerate(leaves) for i in leaf}


def test_equals_a_tree_built_in_one_place(spark):
    import random
    rnd = random.Random(5)
    rows = []
    for k in range(400):
        t = f"{k} " + "word " * rnd.randrange(5, 60)
        for _ in range(rnd.choice([1, 1, 1, 2, 5, 20])):
            rows.append((rnd.randrange(10_000), t, rnd.choice(["en", "de", None]), f"commoncrawl-{rnd.randrange(9):02}", None, None))
    rnd.shuffle(rows)
    out = kd_shards(spark.createDataFrame(rows, SCHEMA).repartition(4), shards=8).collect()
    check(rows, out, 8)
    shard = {}
    for r in out:
        shard.setdefault((r.size, r.text_crc32), set()).add(r.shard)
    want = brute(rows, spark, 8)
    assert {k: {v} for k, v in {(len(t.encode()) + 1, zlib.crc32(t.encode())): s for t, s in want.items()}.items()} == shard


def test_copies_share_a_shard(spark):
    """1,000 rows of 20 texts with ids all over the range, and sources that differ after their seventh byte."""
    rows = [(i, f"text {i % 20} " * 30, "en", f"commoncrawl-{i % 8:02}", None, None) for i in range(1000)]
    out = kd_shards(spark.createDataFrame(rows, SCHEMA).repartition(4), shards=8).collect()
    check(rows, out, 8)
    shards = {}
    for r in out:
        shards.setdefault(r.text_crc32, set()).add(r.shard)
    assert len(shards) == 20 and all(len(s) == 1 for s in shards.values()) and len({r.shard for r in out}) == 8


def test_ranks_of_names(spark):
    names = [f"n{i:04}" for i in range(500)] + ["", "é", "\U0001F642", "\uffff"]
    df = spark.createDataFrame([(n,) for n in names * 3] + [(None,)] * 9, "name string").repartition(7)
    got = {r.name: r.rank for r in name_ranks(df).collect()}
    assert got == {n: i for i, n in enumerate(sorted(names, key=lambda n: n.encode()))}


def test_equal_texts_with_equal_metadata_stay_together(spark):
    rows = [(i, f"group {i % 200}", "en", "s", None, None) for i in range(2000)]
    out = kd_shards(spark.createDataFrame(rows, SCHEMA).select("text", "lang", "source", "doc_id"), shards=2).collect()
    check(rows, out, 2)
    assert len({(r.text_crc32, r.shard) for r in out}) == 200
