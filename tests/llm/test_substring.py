"""Substring dedup against brute force, over many small blocks and with forced hash collisions."""

import re


from barlake.llm.substring import remove_repeated_spans

SCHEMA = "doc_id long, text string, other string"


def brute(rows, k):
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _ in rows]
    big = 1 << 63
    low = {}
    for i, w in words:
        for p in range(len(w) - k + 1):
            key = tuple(w[p:p + k])
            low[key] = min(low.get(key, big), big - 1 if i is None else i)
    out = []
    for i, w in words:
        gone = set()
        for p in range(len(w) - k + 1):
            if low[tuple(w[p:p + k])] < (big - 1 if i is None else i):
                gone |= set(range(p, p + k))
        out.append((i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return sorted(out, key=str)


def run(spark, rows, k, **more):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = remove_repeated_spans(df, window=k, seed_words=2, **more).collect()
    for r in found:
        assert r.n_removed == sum(s.end - s.start for s in r.spans)
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in found), key=str)


def corpus():
    import random
    rnd = random.Random(3)
    passage = [f"p{i}" for i in range(120)]
    rows = []
    for i in range(60):
        w = [rnd.choice("abcdefgh") + str(rnd.randrange(40)) for _ in range(rnd.randrange(0, 90))]
        if i % 3 == 0:                                   # a hot passage
            a = rnd.randrange(0, 40)
            at = rnd.randrange(len(w) + 1)
            w[at:at] = passage[a:a + rnd.randrange(5, 80)]
        rows.append((i, rnd.choice([" ", "\n", " \t "]).join(w), "x"))
    rows += [(100, rows[3][1], None), (101, rows[3][1], None), (101, rows[3][1], None), (None, rows[6][1], "y"), (None, rows[6][1], "y"),
             (102, None, None), (103, "", None), (104, "  \n ", None), (105, "ü é ü é ü é ü é", None)]
    return rows


def test_equals_brute_force_over_many_blocks(spark):
    rows = corpus()
    assert run(spark, rows, 6, block_bytes=300) == brute(rows, 6)
    assert run(spark, rows, 6) == brute(rows, 6)


def test_hash_collisions_are_found_and_done_again(spark):
    rows = corpus()
    assert run(spark, rows, 6, block_bytes=400, hash_bits=17) == brute(rows, 6)


def test_empty_table_and_long_text(spark):
    assert run(spark, [], 6) == []
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, long, None), (2, "start " + long, None)]
    assert run(spark, rows, 13) == brute(rows, 13)
