import random
import re

import numpy as np
import pytest
import xxhash

from barlake.llm import simhash as S
from barlake.llm.components import connected_components

SCHEMA = "doc_id long, text string, fp string, root long"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_fp(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    if not w:
        return 0
    grams = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, radius=2):
    """{fp: smallest fp reachable}"""
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    fl = sorted(parent)
    for i, a in enumerate(fl):
        for b in fl[i + 1:]:
            if (a ^ b).bit_count() <= radius:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {f: find(f) for f in fl}


def texts():
    rnd = random.Random(7)
    out = []
    for _ in range(60):
        w = [rnd.choice("xyz") + str(rnd.randrange(500)) for _ in range(rnd.randrange(1, 400))]
        out.append(" ".join(w))
        for _ in range(rnd.randrange(3)):                  # near copies
            v = list(w)
            v[rnd.randrange(len(v))] = "edit"
            out.append("\n".join(v).upper())
    return out + ["", " \t ", None, "É é", "one", "One two", "ＡＢ Ａ"]


def test_fingerprints_and_components_equal_brute_force(spark):
    rows = [(i * 3 + 1, t, "x", i) for i, t in enumerate(texts())] + [(0, texts()[0], None, None)] * 3 + [(None, texts()[0], None, None), (None, "alone here", None, None)]
    found = S.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert len(found) == len(rows)
    fp = {t: brute_fp(t) for _, t, *_ in rows}
    root = brute_components(set(fp.values()))
    low = {}
    for i, t, *_ in rows:
        if i is not None:
            low[root[fp[t]]] = min(low.get(root[fp[t]], 1 << 62), i)
    expected = sorted(((i, fp[t], low.get(root[fp[t]])) for i, t, *_ in rows), key=str)
    assert sorted(((r.doc_id, r.fp % 2 ** 64, r.component_id) for r in found), key=str) == expected


@pytest.mark.parametrize("radius", [0, 1, 2])
def test_every_pair_within_radius_is_linked(spark, radius):
    rnd = random.Random(radius)
    base = [rnd.getrandbits(64) for _ in range(6)]
    fps = set(base)
    for b in base:                                          # a large bucket of close fingerprints, and chains
        x = b
        for _ in range(60):
            x ^= 1 << rnd.randrange(64)
            fps |= {x, b ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64))}
    signed = [(f - 2 ** 64 if f >> 63 else f,) for f in fps]
    links = S.fingerprint_links(spark.createDataFrame(signed, "fp long"), radius)
    for a, b in links.collect():
        assert ((a ^ b) % 2 ** 64).bit_count() <= radius
    got = {r.node % 2 ** 64: r.root % 2 ** 64 for r in connected_components(links).collect()}
    want = brute_components(fps, radius)
    pairs = lambda m: {(a, b) for a in fps for b in fps if a < b and m.get(a, a) == m.get(b, b)}
    assert pairs(got) == pairs(want)


def test_masks_cover_every_pair_of_bits():
    for radius in (1, 2):
        masks = S.covering_masks(radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        for i in range(64):
            for j in range(64) if radius == 2 else [i]:
                assert any(not (m >> i) & 1 and not (m >> j) & 1 for m in masks)


def test_components_of_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(40)] + [(1000, i) for i in range(1001, 1100)] + [(5, 5)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 1000 for i in range(1000, 1100)}}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_keep_one_per_group(spark):
    t = texts()
    rows = [(5, t[0], "a", 1), (2, t[0], "b", 2), (2, t[0], "c", 3), (None, t[0], "d", 4), (None, "alone here", "e", 5), (None, "alone here", "f", 6),
            (9, "another one of a kind", None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    kept = S.keep_one_per_group(df, S.near_duplicates(df))
    assert kept.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(2, t[0]), (None, "alone here"), (9, "another one of a kind")], key=str)
    empty = spark.createDataFrame([], SCHEMA)
    assert S.keep_one_per_group(empty, S.near_duplicates(empty)).collect() == []


def test_rows_without_ids_are_grouped_like_all_others(spark):
    """Near copies two bits or fewer apart, all without id: one stays."""
    rnd = random.Random(9)
    base = [f"w{rnd.randrange(500)}" for _ in range(400)]
    near = {brute_fp(" ".join(base)): " ".join(base)}
    for k in range(400):                                    # texts that differ in one word and in one or two bits
        t = " ".join([*base[:k], "other", *base[k + 1:]])
        if 0 < (brute_fp(t) ^ brute_fp(" ".join(base))).bit_count() <= 2:
            near[brute_fp(t)] = t
    assert len(near) > 1
    df = spark.createDataFrame([(None, t, "x", 1) for t in near.values()], SCHEMA)
    found = S.near_duplicates(df)
    assert len({r.root for r in found.collect()}) == 1 and {r.component_id for r in found.collect()} == {None}
    assert S.keep_one_per_group(df, found).count() == 1


def test_columns_with_the_names_of_helpers(spark):
    df = spark.createDataFrame([(1, "a b c d", 7, 8, 9, 10), (2, "a b c d", 7, 8, 9, 10)], "doc_id long, text string, _id int, _h int, root int, n int")
    kept = S.keep_one_per_group(df, S.near_duplicates(df))
    assert kept.columns == df.columns and [tuple(r) for r in kept.collect()] == [(1, "a b c d", 7, 8, 9, 10)]


def test_very_long_text():
    t = " ".join(f"w{i}" for i in range(100_000))
    h = np.array([xxhash.xxh64(f"w{i} w{i + 1} w{i + 2}".encode(), seed=42).intdigest() for i in range(99_998)], "u8")
    want = sum(1 << b for b in range(64) if 2 * int(((h >> np.uint64(b)) & np.uint64(1)).sum()) > len(h))
    assert S.fingerprint(t.encode()) % 2 ** 64 == want
