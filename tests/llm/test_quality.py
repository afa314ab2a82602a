import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from barlake.llm import quality as Q

SCHEMA = "doc_id long, text string, lang string, _lang string, words long"


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def base(t):
    t = t or ""
    w = words(t)
    tri = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n, cov = Counter(tri), set()
    for i, x in enumerate(tri):
        if n[x] > 1:
            cov |= {i, i + 1, i + 2}
    lines = [x for x in t.split("\n") if words(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cov)


def classes(t):
    import string
    out = [0] * 7
    for c in t or "":
        i = (0 if "a" <= c <= "z" else 1 if "A" <= c <= "Z" else 3 if "0" <= c <= "9" else 4 if c in Q.WHITE
             else 5 if c in string.punctuation else 2 if c.isalpha() else 6)
        out[i] += 1
    return out


def jsd(p, q):
    if not sum(p) or not sum(q):
        return None
    p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
    d = sum(x * math.log2(2 * x / (x + y)) for x, y in zip(p, q) if x) + sum(y * math.log2(2 * y / (x + y)) for x, y in zip(p, q) if y)
    return math.sqrt(max(0.0, d / 2))


def brute(rows):
    """References of the distinct texts that pass base rules and guards; distances weighed by the number of such texts."""
    texts, fit, weight, top, ref, out = {}, {}, {}, {}, {}, []
    for _, t, l, *_ in rows:
        texts.setdefault(l or "", set()).add(t or "")
    failed = lambda b: b[0] < 50 or 100 * b[4] > 50 * b[0]

    def histogram(t, l):
        own = Counter(words(t))
        mine = [own[w] for w in top[l]]
        return mine + [sum(own.values()) - sum(mine)]

    for l, ts in texts.items():
        weight[l] = Counter()
        for t in ts:
            ws = words(t)
            for w, k in Counter(ws).items():
                weight[l][w] += k / len(ws)
        top[l] = sorted(weight[l], key=lambda w: (-round(weight[l][w], 9), w.encode()))[:Q.COMMON_WORDS]
        fit[l] = [t for t in ts if not failed(base(t)) and len(t) >= Q.MIN_CHARS and len(words(t)) >= Q.MIN_DIVERGENCE_WORDS]
        shares = lambda hs: [sum(x * Q.SHARE // sum(h) for x, h in zip(col, hs)) for col in zip(*hs)]
        ref[l] = [shares([f(t) for t in fit[l]]) for f in (classes, lambda t: histogram(t, l))]
    for i, t, l, *_ in rows:
        l, b, n = l or "", base(t), len(fit[l or ""])
        dc = jsd(classes(t), ref[l][0]) if n and len(t or "") >= Q.MIN_CHARS else None
        dw = jsd(histogram(t, l), ref[l][1]) if n and b[0] >= Q.MIN_DIVERGENCE_WORDS else None
        over = lambda d, limit: d is not None and round(d, Q.DIGITS) * n > limit * (n + Q.EVIDENCE)
        out.append((i, *b, failed(b), not failed(b) and not over(dc, Q.MAX_CHAR_DISTANCE) and not over(dw, Q.MAX_WORD_DISTANCE), dc, dw))
    return sorted(out, key=str)


def run(spark, rows):
    q = Q.quality_rules(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert q.columns == ["doc_id", "text", "lang", "_lang", "words", "quality"]
    f = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "char_distance", "word_distance")
    return sorted((tuple([r.doc_id, *(r.quality[c] for c in f)]) for r in q.collect()), key=str)


def same(got, want):
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:8] == b[:8]
        for x, y in zip(a[8:], b[8:]):
            assert (x is None) == (y is None) and (x is None or abs(x - y) < 2e-6), (a, b)


def test_equals_brute_force(spark):
    rnd = random.Random(1)
    voc = {"en": "the of and to in cat dog run tree blue".split(), "de": "der die und zu in größe über haus baum blau".split()}
    rows = []
    for i in range(120):
        l = rnd.choice(["en", "de"])
        w = [rnd.choice(voc[l]) + rnd.choice(["", "", ".", str(rnd.randrange(50))]) for _ in range(rnd.randrange(1, 260))]
        if i % 10 == 0:
            w = [x.upper() + "!!" for x in w]
        if i % 11 == 0:
            w = w[:8] * 20
        rows.append((i, rnd.choice([" ", "\n", "  \t"]).join(w), l, "x", i))
    rows += [(500, None, "en", None, None), (501, "", None, None, None), (502, " \n\n ", "en", None, None), (None, "x " * 300, "xx", None, None),
             (503, "# * $ % & | < >\na\na\n a\n", None, None, None), (504, "ß🙂\x0b" * 90, "en", None, None), (504, "ß🙂\x0b" * 90, "en", None, None),
             (505, " ".join(f"u{i}" for i in range(30_000)) + " u1 u2 u3", "en", None, None)]
    same(run(spark, rows), brute(rows))


def test_empty_table(spark):
    assert run(spark, []) == []


def test_repeated_windows_follow_the_definition(spark):
    rnd = random.Random(5)
    ts = [" ".join(rnd.choice("ab") for _ in range(rnd.randrange(0, 40))) for _ in range(200)] + ["a a a a", "a b c", "a", ""]
    df = spark.createDataFrame([(t,) for t in ts], "t string")
    got = df.select("t", Q.repeated_window_words(Q.word_array(F.col("t"))).alias("n")).collect()
    assert all(r.n == base(r.t)[4] for r in got)


def kept_by_query(spark, tmp_path, rows):
    """Ids that op6 itself keeps."""
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    return {r.doc_id for r in Q.op6_quality_divergence(spark, str(tmp_path)).where("kept").collect()}


def test_a_third_of_junk_copies_does_not_become_the_reference(spark, tmp_path):
    import corpus_pipeline
    rnd = random.Random(7)
    clean = [(i, " ".join(rnd.choice("the of and to in cat dog run tree blue".split()) + rnd.choice(["", str(rnd.randrange(90))]) for _ in range(120)), "en", None, None)
             for i in range(60)]
    junk = " ".join(f"ZQ{rnd.randrange(40)}!!" for _ in range(500))
    rows = clean + [(1000 + i, junk, "en", None, None) for i in range(30)]
    out = corpus_pipeline.quality_stage(spark, spark.createDataFrame(rows, SCHEMA).repartition(3), "").collect()
    assert {r.doc_id for r in out} == kept_by_query(spark, tmp_path, rows) == {r[0] for r in clean}


def test_a_rare_language_unlike_the_pool_stays(spark, tmp_path):
    import corpus_pipeline
    rnd = random.Random(8)
    voc = {"en": "the of and to in cat dog run tree blue".split(), "ru": "и в не на он дом кот лес вода небо".split()}
    rows = [(i, " ".join(rnd.choice(voc[lang]) + rnd.choice(["", "", ".", f" {rnd.randrange(90)}"]) for _ in range(150)), lang, None, None)
            for i, lang in enumerate(["en"] * 60 + ["ru"] * 15)]
    out = corpus_pipeline.quality_stage(spark, spark.createDataFrame(rows, SCHEMA).repartition(3), "").collect()
    assert {r.doc_id for r in out} == kept_by_query(spark, tmp_path, rows) == {r[0] for r in rows}


def test_no_step_at_any_number_of_texts(spark):
    """One more text moves what a distance counts by a few hundredths at most, and few texts reject nothing."""
    counts = [n / (n + Q.EVIDENCE) for n in range(200)]
    assert max(b - a for a, b in zip(counts, counts[1:])) < 0.05 and counts[1] < min(Q.MAX_CHAR_DISTANCE, Q.MAX_WORD_DISTANCE)
    rows = [(i, " ".join(f"{w}{i}" for w in range(150)), "xx", None, None) for i in range(5)]
    assert all(r[7] for r in run(spark, rows))


def test_no_text_passes_a_generator(spark):
    """Explode carries words and a weight; a text beside it would be scanned again for every word."""
    from barlake.llm import common
    plans, orig = [], Q.written
    try:
        Q.written = lambda df, name: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), orig(df, name))[1]
        Q.common_words(spark.createDataFrame([(1, "a b c", "en", None, None)], SCHEMA))
    finally:
        Q.written = orig
    assert common.written is orig
    (plan,) = plans
    below = plan[plan.index("Generate explode"):].split("\n")[1]
    assert "Generate explode" in plan and "split(" not in plan[:plan.index("Generate explode")] and "text" not in below.split("AS w")[0].split(",")[0]


def test_columns_with_the_names_of_helpers(spark):
    rows = [(i, " ".join(f"w{j % 9}{i}" for j in range(120)), "en", "a", 1) for i in range(4)]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS _row", "2 AS _ref", "3 AS _words", "4 AS _w", "5 AS _m", "6 AS _char", "7 AS _word", "8 AS h", "9 AS n", "10 AS `a.b`")
    out = Q.quality_rules(docs)
    assert out.columns == [*docs.columns, "quality"] and sorted(r._row for r in out.collect()) == [1] * 4
