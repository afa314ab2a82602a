"""Quality rules with distribution divergence against language references.

A first pass counts words, each distinct text of a language with weight 1, and
names the most common words of every language.  A second pass measures every
document: the base rules, its histogram of character classes and its histogram
over those words (all others in one class).  The references of a language add
up the histograms, as shares, of its distinct texts that pass the base rules
and the length guards; copies, long texts and junk that the base rules catch
thus weigh little or nothing.  A document is compared with the references of
its language by the Jensen-Shannon distance (base 2, 0 to 1).

A reference of few texts is weak evidence: with ``n`` texts behind it a
distance counts ``n / (n + EVIDENCE)`` of itself.  There is no number of texts
at which the rule changes, and a language of few documents is never dropped
whole.  Short documents are not judged by divergence: their histograms are noise.

Everything runs in DataFrame functions, row by row.  Measures are written once,
and references (one row per language) are joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.joins import broadcast_if_small
from ..session import cut_lineage
from .common import free_name, let, query, read_table, word_array, written

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
COMMON_WORDS = 24
EVIDENCE = 20               # texts behind a reference at which half of a distance counts
SHARE = 10**8               # shares are whole numbers that add up to about this: sums do not depend on the order of rows
DIGITS = 6                  # of distances
MIN_CHARS = 200             # guards: below them the distance is not judged
MIN_DIVERGENCE_WORDS = 100
MAX_CHAR_DISTANCE = 0.30
MAX_WORD_DISTANCE = 0.40
SYMBOLS = "#*$%&|<>"
CLASSES = ("lower", "upper", "letter", "digit", "space", "mark", "other")
WHITE = " \t\n\x0b\x0c\r"


def _without(c: Column, chars: str) -> Column:
    for ch in chars:
        c = F.replace(c, F.lit(ch))
    return c


def char_classes(text: Column) -> Column:
    """Counts of ASCII lower, ASCII upper, other letters, digits, white space, ASCII punctuation, rest."""
    def removing(rest: Column, patterns: tuple, lengths: list, size: Column) -> Column:
        """Lengths that are left after each pattern is taken out in turn."""
        left = F.length(rest)
        if not patterns:
            all_ = [size, *lengths, left]
            lower, upper, digit, mark, letter = [a - b for a, b in zip(all_[1:], all_[2:])]
            return F.array(lower, upper, letter, digit, size - all_[1], mark, left).cast("array<long>")
        return let(F.regexp_replace(rest, patterns[0], ""), lambda r: removing(r, patterns[1:], [*lengths, left], size))

    t = F.coalesce(text, F.lit(""))
    return let(_without(t, WHITE), lambda bare: removing(bare, ("[a-z]+", "[A-Z]+", "[0-9]+", r"[!-/:-@\[-`{-~]+", r"\p{L}+"), [], F.length(t)))


def repeated_window_words(words: Column, width: int = 3) -> Column:
    """Words that lie in a ``width``-word window found twice or more in the text.

    Windows are 64-bit hashes.  They are sorted as numbers whose low bits carry
    the position, so that equal windows become neighbours; neighbours count
    only if their whole hashes agree.
    """
    def of_words(w: Column) -> Column:
        n = F.size(w) - (width - 1)
        hashes = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(width)]))
        return F.when(n < 2, F.lit(0).cast("long")).otherwise(let(hashes, lambda h: let(F.ceil(F.log2(F.size(h) + F.lit(1.0))).cast("int"), lambda b: packed(h, b))))

    def packed(h: Column, b: Column) -> Column:
        low = F.call_function("shiftleft", F.lit(1).cast("long"), b) - 1
        marked = F.transform(h, lambda x, i: x.bitwiseAND(F.bitwise_not(low)).bitwiseOR(i.cast("long")))
        return let(F.sort_array(marked), lambda q: flagged(h, low, q))

    def flagged(h: Column, low: Column, q: Column) -> Column:
        at = lambda x: x.bitwiseAND(low).cast("int")

        def same(x: Column, y: Column) -> Column:
            close = x.bitwiseXOR(y).bitwiseAND(F.bitwise_not(low)) == 0
            return close & (F.get(h, at(x)) == F.get(h, at(y)))

        hit = F.filter(F.sequence(F.lit(1), F.size(q) - 1), lambda k: same(F.get(q, k), F.get(q, k - 1)))
        both = lambda k: F.concat(F.transform(k, lambda i: at(F.get(q, i))), F.transform(k, lambda i: at(F.get(q, i - 1))))
        return let(hit, lambda k: F.when(F.size(k) == 0, F.lit(0).cast("long")).otherwise(
            let(F.sort_array(F.array_distinct(both(k))), covered)))

    def covered(p: Column) -> Column:
        last = F.size(p) - 1
        step = F.transform(p, lambda x, j: F.when(j == last, F.lit(width)).otherwise(F.least(F.lit(width), F.get(p, j + 1) - x)))
        return F.aggregate(step, F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))

    return let(words, of_words)


def duplicate_lines(text: Column) -> Column:
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: F.length(_without(x, WHITE)) > 0)
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two count arrays of equal length (NULL if one is all zero)."""
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double"))

    def entropy_part(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))

    def of(tp: Column, tq: Column) -> Column:
        parts = F.zip_with(p, q, lambda a, b: F.struct((a / tp).alias("a"), (b / tq).alias("b")))
        terms = F.transform(parts, lambda s: entropy_part(s["a"], (s["a"] + s["b"]) / 2) + entropy_part(s["b"], (s["a"] + s["b"]) / 2))
        d = F.aggregate(terms, F.lit(0.0), lambda s, x: s + x) / 2
        return F.when((tp > 0) & (tq > 0), F.sqrt(F.greatest(d, F.lit(0.0))))

    return let(total(p), lambda tp: let(total(q), lambda tq: F.when((tp > 0) & (tq > 0), of(tp, tq))))


def _language(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _reserved(docs: DataFrame, *names: str) -> list[str]:
    return [free_name(docs.columns, n) for n in names]


def common_words(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", common: int = COMMON_WORDS) -> DataFrame:
    """(lang, words): the most common words of every language (ties: smaller word first), each distinct text weighing the same.

    A text's words share the weight 1, its copies divide it.  Only word arrays
    and their weight pass the generator, never the text.
    """
    d = docs.select(_language(F.col(lang_col)).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("t")).withColumn("h", F.xxhash64("t"))
    copies = cut_lineage(d.groupBy("lang", "h").agg(F.count("*").alias("copies")).where("copies > 1"))
    d = d.join(broadcast_if_small(copies), ["lang", "h"], "left").select("lang", "copies", word_array(F.col("t")).alias("w"))
    d = d.select("lang", "w", (1 / (F.greatest(F.size("w"), F.lit(1)) * F.coalesce("copies", F.lit(1)))).alias("weight"))
    tokens = written(d.select("lang", "weight", F.explode("w").alias("word")).groupBy("lang", "word").agg(F.sum("weight").alias("n")), "word-weights")
    most = F.desc(F.round("n", 9))                      # sums of shares differ in the last digits from run to run
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(most, "word"))
    top = tokens.withColumn("r", rank).where(F.col("r") <= common)
    return cut_lineage(top.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("r", "word"))), lambda x: x["word"]).alias("words")))


def measured(docs: DataFrame, words: DataFrame, text_col: str = "text", lang_col: str = "lang", out: str = "quality",
             keep: tuple[str, ...] | None = None, common: int = COMMON_WORDS) -> DataFrame:
    """Columns ``keep`` (default: all) of every row, plus a struct ``out`` with its measures and histograms.

    ``chars`` counts character classes; ``counts`` counts the words of the
    language's list in its order, 0 where the list is shorter, and last all other words.
    """
    lang, ref, row, w_, m_ = _reserved(docs, "_lang", "_words", "_row", "_w", "_m")
    refs = words.select(F.col("lang").alias(lang), F.col("words").alias(ref))
    t = F.coalesce(F.col(f"{row}.`{text_col}`"), F.lit(""))
    d = (docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row), _language(F.col(lang_col)).alias(lang))
         .join(broadcast_if_small(refs), lang, "left"))

    def of(w: Column) -> Column:
        n = F.size(w).cast("long")
        found = F.transform(F.sequence(F.lit(0), F.lit(common - 1)), lambda i: F.coalesce(
            F.size(w) - F.size(F.array_remove(w, F.get(F.col(ref), i))), F.lit(0)).cast("long"))
        counts = let(found, lambda f: F.concat(f, F.array(n - F.aggregate(f, F.lit(0).cast("long"), lambda a, x: a + x))))
        return F.struct(n.alias("n_words"), repeated_window_words(w).alias("n_repeat_words"), counts.alias("counts"))

    d = d.withColumn(m_, let(word_array(t), of))
    bare = _without(t, WHITE)
    failed = (F.col(f"{m_}.n_words") < MIN_WORDS) | (100 * F.col(f"{m_}.n_repeat_words") > MAX_REPEAT_PERCENT * F.col(f"{m_}.n_words"))
    kept = docs.columns if keep is None else keep
    return d.select(*[F.col(f"{row}.`{c}`").alias(c) for c in kept], F.struct(
        F.col(f"{m_}.n_words").alias("n_words"), F.length(bare).cast("long").alias("word_chars"),
        (F.length(t) - F.length(_without(t, SYMBOLS))).cast("long").alias("n_symbols"),
        duplicate_lines(t).alias("n_dup_lines"), F.col(f"{m_}.n_repeat_words").alias("n_repeat_words"), failed.alias("base_failed"),
        F.col(lang).alias("lang"), F.xxhash64(t).alias("h"), F.length(t).alias("n_chars"),
        char_classes(t).alias("chars"), F.col(f"{m_}.counts").alias("counts")).alias(out))


def references(m: DataFrame, out: str = "quality", common: int = COMMON_WORDS) -> DataFrame:
    """(lang, n_texts, chars, counts): sums of the shares of a language's distinct texts that pass base rules and length guards."""
    q = m.select(f"`{out}`.*").where(~F.col("base_failed") & (F.col("n_chars") >= MIN_CHARS) & (F.col("n_words") >= MIN_DIVERGENCE_WORDS))
    share = lambda c, n: F.transform(F.col(c), lambda x: F.floor(x * F.lit(SHARE) / F.col(n)).cast("long")).alias(c)
    one = q.groupBy("lang", "h").agg(*[F.any_value(c).alias(c) for c in ("n_chars", "n_words", "chars", "counts")]).select(
        "lang", share("chars", "n_chars"), share("counts", "n_words"))
    chars = [F.sum(F.get("chars", i)).alias(f"c{i}") for i in range(len(CLASSES))]
    counts = [F.sum(F.get("counts", i)).alias(f"w{i}") for i in range(common + 1)]
    sums = one.groupBy("lang").agg(F.count("*").alias("n_texts"), *chars, *counts)
    return cut_lineage(sums.select("lang", "n_texts", F.array(*[f"c{i}" for i in range(len(CLASSES))]).alias("chars"),
                                   F.array(*[f"w{i}" for i in range(common + 1)]).alias("counts")))


def judged(m: DataFrame, refs: DataFrame, out: str = "quality") -> DataFrame:
    """``m`` with ``out`` reduced to measures, distances and the verdict."""
    lang, ref, row = _reserved(m, "_lang", "_ref", "_row")
    refs = refs.select(F.col("lang").alias(lang), F.struct("n_texts", "chars", "counts").alias(ref))
    d = (m.select(F.struct(*[F.col(f"`{c}`") for c in m.columns]).alias(row), F.col(f"`{out}`.lang").alias(lang))
         .join(broadcast_if_small(refs), lang, "left"))
    q = lambda c: F.col(f"{row}.`{out}`.{c}")
    char = F.round(F.when(q("n_chars") >= MIN_CHARS, js_distance(q("chars"), F.col(f"{ref}.chars"))), DIGITS)
    word = F.round(F.when(q("n_words") >= MIN_DIVERGENCE_WORDS, js_distance(q("counts"), F.col(f"{ref}.counts"))), DIGITS)
    d = d.withColumns({free_name(d.columns, "_char"): char, free_name(d.columns, "_word"): word})
    char, word = [F.col(f"`{c}`") for c in d.columns[-2:]]
    n = F.col(f"{ref}.n_texts")
    over = lambda x, limit: F.coalesce(x * n > F.lit(float(limit)) * (n + EVIDENCE), F.lit(False))
    diverges = over(char, MAX_CHAR_DISTANCE) | over(word, MAX_WORD_DISTANCE)
    return d.select(*[F.col(f"{row}.`{c}`").alias(c) for c in m.columns if c != out], F.struct(
        *[q(c).alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")],
        char.alias("char_distance"), word.alias("word_distance"), (~q("base_failed") & ~diverges).alias("kept")).alias(out))


def quality_rules(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", out: str = "quality",
                  keep: tuple[str, ...] | None = None) -> DataFrame:
    """All rows of ``docs`` with columns ``keep`` (default: all) plus a struct column ``out`` with measures and the verdict.

    Fields: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, char_distance, word_distance, kept.

    * NULL text is an empty text: no words, hence base_failed.
    * NULL language is a language of its own (the same as an empty one).
    * Texts of any length are measured whole; below the guards, and where a language has
      no text fit for a reference, the distances are NULL and reject nothing.
    * Repeated rows are judged alike; an empty table gives no rows.
    * Columns of any name pass through untouched; ``out`` must not be one of them.
    """
    kept = docs.columns if keep is None else keep
    if out.lower() in [c.lower() for c in kept]:
        raise ValueError(f"docs has a column {out}")
    m = written(measured(docs, common_words(docs, text_col, lang_col), text_col, lang_col, out, keep), "quality-measures")
    return judged(m, references(m, out), out)


def _sql() -> str:
    patterns = {"lower": "[a-z]", "upper": "[A-Z]", "digit": "[0-9]", "mark": r"[!-/:-@\[-`{-~]", "letters": r"\p{L}", "space": r"[\x20\x09-\x0D]"}
    gone = ", ".join(f"length(t) - length(regexp_replace(t, '{x}', '', 'g')) AS {n}" for n, x in patterns.items())

    def distance(name: str, pairs: str) -> str:
        """Jensen-Shannon distance of the histograms p and q given as rows (doc_id, i, p, q)."""
        part = "CASE WHEN {0} > 0 THEN {0} * log2({0} / ((p + q) / 2)) ELSE 0 END"
        return f"""{name} AS (SELECT doc_id, round(sqrt(greatest(sum({part.format('p')} + {part.format('q')}) / 2, 0)), {DIGITS}) AS distance FROM
  (SELECT doc_id, p / nullif(sum(p) OVER (PARTITION BY doc_id), 0) AS p, q / nullif(sum(q) OVER (PARTITION BY doc_id), 0) AS q FROM {pairs})
  GROUP BY doc_id HAVING count(p) > 0 AND count(q) > 0)"""

    def over(name: str, limit: float) -> str:
        return f"coalesce({name} * n_texts > {limit}::DOUBLE * (n_texts + {EVIDENCE}), false)"

    word = r"[^\x20\x09-\x0D]"
    return f"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{word}+') AS w FROM documents),
n AS (SELECT *, {gone} FROM d),
g AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM d WHERE len(w) >= 3),
s AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(w[i:i + 2], ' ')) AS times FROM g),
rep AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM s, (SELECT unnest(range(3)) AS j) WHERE times > 1 GROUP BY doc_id),
b AS (SELECT n.*, len(w)::BIGINT AS n_words, (length(t) - space)::BIGINT AS word_chars,
             (length(t) - length(regexp_replace(t, '[{SYMBOLS}]', '', 'g')))::BIGINT AS n_symbols,
             list_filter(string_split(t, chr(10)), lambda y: regexp_matches(y, '{word}')) AS ls, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
             len(w) < {MIN_WORDS} OR 100 * coalesce(rep.n, 0) > {MAX_REPEAT_PERCENT} * len(w) AS base_failed
      FROM n LEFT JOIN rep USING (doc_id)),
x AS (SELECT doc_id, lang, unnest(w) AS word, 1 / (len(w) * count(*) OVER (PARTITION BY lang, t)) AS weight FROM d),
k AS (SELECT lang, word, sum(weight) AS n FROM x GROUP BY ALL),
top AS (SELECT lang, word, row_number() OVER (PARTITION BY lang ORDER BY round(n, 9) DESC, word) AS i FROM k QUALIFY i <= {COMMON_WORDS}),
own AS (SELECT x.doc_id, top.i, count(*) AS p FROM x JOIN top USING (lang, word) GROUP BY ALL),
known AS (SELECT b.doc_id, b.lang, top.i, coalesce(own.p, 0) AS p FROM b JOIN top USING (lang) LEFT JOIN own ON own.doc_id = b.doc_id AND own.i = top.i),
wh AS (SELECT * FROM known UNION ALL
       SELECT b.doc_id, b.lang, 0, n_words - coalesce(f.p, 0) FROM b LEFT JOIN (SELECT doc_id, sum(p) AS p FROM known GROUP BY doc_id) f USING (doc_id)),
ch AS (SELECT doc_id, lang, unnest([lower, upper, letters - lower - upper, digit, space, mark, length(t) - letters - digit - space - mark]) AS p,
              unnest(range(7)) AS i FROM b),
fit AS (SELECT min(doc_id) AS doc_id, lang, any_value(n_words) AS n_words, length(t) AS n_chars FROM b
        WHERE NOT base_failed AND length(t) >= {MIN_CHARS} AND n_words >= {MIN_DIVERGENCE_WORDS} GROUP BY lang, t),
nt AS (SELECT lang, count(*) AS n_texts FROM fit GROUP BY lang),
cref AS (SELECT ch.lang, i, sum(floor(p * {SHARE} / n_chars)) AS q FROM ch JOIN fit USING (doc_id) GROUP BY ch.lang, i),
wref AS (SELECT wh.lang, i, sum(floor(p * {SHARE} / n_words)) AS q FROM wh JOIN fit USING (doc_id) GROUP BY wh.lang, i),
cpair AS (SELECT doc_id, p::DOUBLE AS p, q::DOUBLE AS q FROM ch JOIN cref USING (lang, i)),
wpair AS (SELECT doc_id, p::DOUBLE AS p, q::DOUBLE AS q FROM wh JOIN wref USING (lang, i)),
{distance('cdist', 'cpair')},
{distance('wdist', 'wpair')},
f AS (SELECT b.*, n_texts, CASE WHEN length(t) >= {MIN_CHARS} THEN cdist.distance END AS char_distance,
             CASE WHEN n_words >= {MIN_DIVERGENCE_WORDS} THEN wdist.distance END AS word_distance
      FROM b LEFT JOIN nt USING (lang) LEFT JOIN cdist USING (doc_id) LEFT JOIN wdist USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT {over('char_distance', MAX_CHAR_DISTANCE)} AND NOT {over('word_distance', MAX_WORD_DISTANCE)} AS kept,
       char_distance, word_distance
FROM f
"""


SQL = _sql()


@query("op6_quality_divergence", SQL)
def op6_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = quality_rules(read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), keep=("doc_id",))
    return q.select("doc_id", *[F.col(f"quality.{c}").alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "char_distance", "word_distance")])
