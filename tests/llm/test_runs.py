import hashlib
import random
import re
import zlib
from fractions import Fraction

from pyspark.sql import functions as F

from barlake.llm import runs as R


def brute_runs(w):
    """Every run, from the definition: for each period the maximal stretches of equal words that far apart."""
    found, n = {}, len(w)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)     # the smallest period of this stretch
            i = j + 1
    return sorted((a, n, q) for (a, n), q in found.items())


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def contract(doc_id, text):
    w = words(text)
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    runs = sorted(brute_runs(w), key=lambda r: (r[0], r[2]))
    gone = {k for a, m, q in runs for k in range(a + q, a + m)}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha("".join(f"{a},{m},{q}\n" for a, m, q in runs)),
            sha(" ".join(x for k, x in enumerate(w) if k not in gone)))


def periodic(rnd, letters, size):
    out = []
    while len(out) < size:
        root = [rnd.choice(letters) for _ in range(rnd.randrange(1, 9))]
        out += (root * rnd.randrange(1, 7))[:rnd.randrange(1, 40)]
    return out[:size]


def test_runs_equal_brute_force():
    rnd = random.Random(1)
    for k in range(400):
        w = periodic(rnd, "abcdefgh"[:rnd.randrange(1, 9)], rnd.randrange(0, 90)) if k % 2 else [rnd.choice("ab") for _ in range(rnd.randrange(0, 60))]
        assert R.runs_of([ord(c) for c in w]) == brute_runs(w), w


def test_stretches_lose_no_run():
    rnd = random.Random(2)
    texts = [periodic(rnd, [f"w{i}" for i in range(rnd.choice([2, 5, 40]))], rnd.randrange(0, 120)) + [f"u{i}" for i in range(rnd.randrange(20))] for _ in range(300)]
    texts += [["x"] * n for n in range(12)] + [["x", "y"] * n + ["x"] for n in range(8)] + [[str(i) for i in range(200)], []]
    assert R.runs_of_texts(texts) == [sorted(brute_runs(t), key=lambda r: (r[0], r[2])) for t in texts]


def test_extensions_equal_a_plain_scan():
    rnd = random.Random(3)
    for n in (1, 2, 17, 200):
        s = [rnd.randrange(3) for _ in range(n)]
        e = R.Extensions(s, both=True)
        assert e.rank.tolist() == [sorted(range(n), key=lambda i: s[i:]).index(i) for i in range(n)]
        assert e.reverse_rank.tolist() == [sorted(range(n), key=lambda i: [-x for x in s[i:]]).index(i) for i in range(n)]
        import numpy as np
        pairs = [(i, j) for i in range(n + 1) for j in range(n + 1) if i != j]
        got = e.lengths(np.array([i for i, _ in pairs]), np.array([j for _, j in pairs]))
        for (i, j), k in zip(pairs, got):
            assert s[i:i + k] == s[j:j + k] and (max(i, j) + k >= n or s[i + k] != s[j + k])


def run(spark, rows, tmp_path):
    docs = spark.createDataFrame(rows, "doc_id long, text string, `a.b` int, periodic string").repartition(3)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    return sorted(map(tuple, R.op11_periodic_runs(spark, str(tmp_path)).collect()), key=str)


def test_query_equals_brute_force(spark, tmp_path):
    rnd = random.Random(4)
    rows = [(i, rnd.choice([" ", "\n", "\t "]).join(periodic(rnd, [f"w{i}" for i in range(30)] + ["größe", "\x85", "a\xa0b"], rnd.randrange(0, 150))), 1, "x") for i in range(250)]
    rows += [(i, " ".join(f"v{j}" for j in range(rnd.randrange(1, 200))), 1, "x") for i in range(300, 420)]
    rows += [(500, None, None, None), (501, "", None, None), (None, "a a a a a a b", None, None), (None, None, None, None), (7, "b " * 40, None, None), (7, "b " * 40, None, None)]
    assert run(spark, rows, tmp_path) == sorted((contract(i, t) for i, t, *_ in rows), key=str)


def test_very_long_texts(spark):
    """50,000 times one word, a long period, and many short runs among words of their own."""
    n = 50_000
    texts = ["x " * n, " ".join(f"w{i % 9000}" for i in range(n)), " ".join(f"u{i} " + "a b a b a b a b" for i in range(5000))]
    docs = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id long, text string, n_words int")
    got = {r.doc_id: r.periodic for r in R.periodic_runs(docs).collect()}
    assert [tuple(x) for x in got[0].runs] == [(0, n, 1)] and got[0].collapsed == "x"
    assert [tuple(x) for x in got[1].runs] == [(0, n, 9000)] and got[1].collapsed == " ".join(f"w{i}" for i in range(9000))
    assert [tuple(x) for x in got[2].runs] == [(9 * i + 1, 8, 2) for i in range(5000)] and got[2].collapsed == " ".join(f"u{i} a b" for i in range(5000))


def test_empty_table_and_columns(spark, tmp_path):
    assert run(spark, [], tmp_path) == []
    docs = spark.createDataFrame([(1, "a " * 9, 2, "c0")], "doc_id long, text string, _t int, c1 string")
    (r,) = R.periodic_runs(docs).collect()
    assert r.asDict(True) == {"doc_id": 1, "_t": 2, "c1": "c0", "periodic": {"n_words": 9, "runs": [{"start": 0, "length": 9, "period": 1}], "collapsed": "a"}}
    assert R.periodic_runs(docs.where(F.lit(False))).columns == ["doc_id", "_t", "c1", "periodic"]
