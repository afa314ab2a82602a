"""Mixing sources to target weights with hash-threshold histograms.

Every row gets a 60-bit hash.  A source whose target is ``r`` times its size
plus a rest takes each row ``r`` times, and once more every row whose hash is
not above the source's threshold.  Thresholds come from histograms: words are
summed by (source, hash bucket), the bucket where the running sum meets the
budget is found, and only rows of that bucket are summed again by the next
bits.  Rows are then filtered by comparison; nothing is sorted by hash, and a
larger budget always takes a superset of a smaller one.

Rows equal in id and text share a hash.  Where such copies stand at the
threshold only as many of them are taken as the budget asks for: copies are
numbered, and the same histograms over a hash of the number pick them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.joins import broadcast_if_small
from ..session import cut_lineage
from .common import WORD_PATTERN, query, read_table, word_count

HASH_BITS = 60
ROUND_BITS = 12
ROUNDS = 3
MAX_REPEAT = 3
WEIGHT_CYCLE = 3


def row_hash(id_col: str, text_col: str) -> Column:
    """60 bits of an md5 over id and text; equal rows share it."""
    key = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit("|"),
                   F.coalesce(F.col(text_col), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_key(c: Column) -> Column:
    """Code-point order with NULL last, and joinable with plain equality."""
    return F.when(c.isNull(), F.lit("2")).otherwise(F.concat(F.lit("1"), c))


def source_targets(sizes: DataFrame, max_repeat: int = MAX_REPEAT,
                   weight_cycle: int = WEIGHT_CYCLE) -> DataFrame:
    """Targets of (key, source_size): weight shares of the total, capped, excess reshared.

    Resharing until none is above its cap has a closed form.  With sources in
    order of cap / weight, the capped ones are a prefix, and all others get
    weight * (total - caps of the prefix) / (weights of the rest).
    One row per source: the windows run over that summary, not over rows of data.
    """
    by_key = Window.orderBy("key")
    w = (F.row_number().over(by_key) - 1) % weight_cycle + 1
    s = sizes.withColumn("weight", w.cast("long")).withColumn("cap", F.col("source_size") * max_repeat)
    order = Window.orderBy(F.col("cap") / F.col("weight"), "key")
    everyone = Window.partitionBy(F.lit(0))
    s = (s.withColumn("total", F.sum("source_size").over(everyone))
         .withColumn("caps_before", F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
         .withColumn("weights_from", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
         .withColumn("share", F.col("weight").cast("double") * (F.col("total") - F.col("caps_before")) / F.col("weights_from"))
         .withColumn("open", F.col("cap") >= F.col("share"))
         .withColumn("first_open", F.max(F.when(F.col("open"), F.struct(-F.col("caps_before"), "weights_from"))).over(everyone))
         .withColumn("capped", ~F.coalesce(F.max(F.col("open").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)) > 0, F.lit(False))))
    level = (F.col("total") + F.col("first_open.col1")) * F.col("weight")
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(
        level.cast("double") / F.col("first_open.weights_from"))
    return s.select("key", "source_size", target.alias("target"))


def _bucket(round_no: int) -> Column:
    return F.shiftright("h", HASH_BITS - ROUND_BITS * (round_no + 1))


def hash_thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """(key, threshold, edge, part, copies) for rows (key, size, h) and budgets (key, budget).

    Hashes up to ``threshold`` are taken.  ``edge`` is the first value beyond, if the budget
    takes ``part`` of its ``copies`` rows, rounded to the nearest; a row alone at its value
    counts in the threshold or not at all, and edge is NULL.
    """
    open_ = budgets.select("key", "budget", F.lit(0.0).alias("before"), F.lit(0).cast("long").alias("prefix"))
    part = rows
    for r in range(ROUNDS + 1):
        last = r == ROUNDS
        b = F.col("h") if last else _bucket(r)
        hist = part.groupBy("key", b.alias("b")).agg(F.sum("size").alias("n"), F.count("*").alias("c"))
        run = Window.partitionBy("key").orderBy("b")
        hist = (hist.join(broadcast_if_small(open_), "key")
                .withColumn("upto", F.col("before") + F.sum("n").over(run)))
        fits = F.col("upto") <= F.col("budget")
        edge = hist.groupBy("key").agg(F.max(F.when(fits, F.col("b"))).alias("top"), F.min(F.when(~fits, F.struct("b", "upto", "n", "c"))).alias("e"))
        joined = open_.join(edge, "key", "left")
        if last:
            each = F.col("e.n") / F.col("e.c")             # copies have one size
            taken = F.floor((F.col("budget") - (F.col("e.upto") - F.col("e.n"))) / each + 0.5)
            taken = F.coalesce(F.least(F.greatest(taken, F.lit(0)), F.col("e.c")).cast("long"), F.lit(0).cast("long"))
            top = F.coalesce("top", F.shiftleft("prefix", HASH_BITS - ROUND_BITS * ROUNDS) - 1)
            split = (taken > 0) & (taken < F.col("e.c"))
            return joined.select("key", F.when((taken > 0) & (taken == F.col("e.c")), F.col("e.b")).otherwise(top).alias("threshold"),
                                 F.when(split, F.col("e.b")).alias("edge"), F.when(split, taken).alias("part"), F.when(split, F.col("e.c")).alias("copies"))
        open_ = cut_lineage(joined.select(
            "key", "budget",
            F.coalesce(F.col("e.upto") - F.col("e.n"), F.lit(0.0)).alias("before"),
            F.coalesce(F.col("e.b"), F.lit(1 << (ROUND_BITS * (r + 1)))).cast("long").alias("prefix")))
        part = part.join(broadcast_if_small(open_.select("key", "prefix")), "key").where(_bucket(r) == F.col("prefix")).drop("prefix")


def _plan(docs: DataFrame, size: Column, id_col: str, text_col: str, source_col: str, max_repeat: int):
    """Slim rows (id, key, size, h), and per source its target, whole copies, hash threshold and edge."""
    rows = cut_lineage(docs.select(F.col(id_col).alias("id"), source_key(F.col(source_col)).alias("key"),
                                   size.alias("size"), row_hash(id_col, text_col).alias("h")))
    targets = source_targets(rows.groupBy("key").agg(F.sum("size").alias("source_size")), max_repeat)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    targets = cut_lineage(targets.withColumn("whole", whole))
    budgets = targets.select("key", (F.col("target") - F.col("whole") * F.col("source_size")).alias("budget"))
    return rows, cut_lineage(targets.join(hash_thresholds(rows, budgets), "key"))


def _copies(rows: DataFrame, plan: DataFrame, max_repeat: int) -> DataFrame:
    """``rows`` (key, h, ...) with all columns of their source's plan and ``times``, how often each is taken.

    Rows at a source's edge are written once, so that their numbers stay, and their part is picked by number.
    """
    open_ = F.col("whole") < max_repeat
    joined = rows.join(broadcast_if_small(plan), "key")
    at_edge = open_ & F.coalesce(F.col("h") == F.col("edge"), F.lit(False))
    out = joined.where(~at_edge).withColumn("times", F.col("whole") + (open_ & (F.col("h") <= F.col("threshold"))).cast("long"))
    if plan.where(open_ & F.col("edge").isNotNull()).limit(1).count() == 0:
        return out
    number = F.shiftrightunsigned(F.xxhash64("number"), 64 - HASH_BITS)
    edge = cut_lineage(joined.where(at_edge).withColumn("number", F.monotonically_increasing_id())).withColumn("number", number)
    picked = hash_thresholds(edge.select("key", F.lit(1).cast("long").alias("size"), F.col("number").alias("h")),
                             plan.where(open_ & F.col("edge").isNotNull()).select("key", F.col("part").cast("double").alias("budget")))
    picked = cut_lineage(picked.select("key", F.col("threshold").alias("up_to")))
    edge = edge.join(broadcast_if_small(picked), "key").withColumn("times", F.col("whole") + (F.col("number") <= F.col("up_to")).cast("long"))
    return out.unionByName(edge.select(*out.columns))


def mix_sources(docs: DataFrame, size: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", max_repeat: int = MAX_REPEAT) -> DataFrame:
    """How often the mix takes each row: (doc_id, size, source_size, target, copies).

    * NULL source is a source of its own, last in order; NULL text has size 0.
    * NULL ids are allowed; rows equal in id and text are copies: a source's edge may take some of them and not others.
    * An empty table gives no rows; if every size is 0 all targets are 0.
    * Other columns are not read, so clashing names do not matter.
    """
    size = word_count(F.col(text_col)) if size is None else size
    rows, plan = _plan(docs, size, id_col, text_col, source_col, max_repeat)
    return _copies(rows, plan, max_repeat).select(F.col("id").alias(id_col), "size", "source_size", "target", F.col("times").alias("copies"))


def repeat_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``docs`` with every row as often as the mix takes it; rows are filtered and repeated in place, not shuffled.

    Same cases as ``mix_sources``; all columns pass through.
    """
    plan = _plan(docs, word_count(F.col(text_col)), id_col, text_col, source_col, max_repeat)[1]
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(row.alias("_row"), source_key(F.col(source_col)).alias("key"), row_hash(id_col, text_col).alias("h"))
    taken = _copies(rows, plan, max_repeat)
    return (taken.select("_row", F.explode(F.array_repeat(F.lit(True), F.col("times").cast("int"))).alias("_copy"))
            .select(*[F.col("_row").getField(c).alias(c) for c in docs.columns]))


SQL = f"""
WITH d AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '2' ELSE '1' || source END AS key,
         coalesce(len(regexp_extract_all(text, '{WORD_PATTERN}')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')), 1, 15))::BIGINT AS h
  FROM documents),
s AS (SELECT key, sum(size)::BIGINT AS source_size, ((row_number() OVER (ORDER BY key) - 1) % 3 + 1)::BIGINT AS w
      FROM d GROUP BY key),
-- levels at which each source would become capped; the right one leaves nobody above
l AS (SELECT a.key, sum(b.source_size)::BIGINT AS total,
             coalesce(sum(3 * b.source_size) FILTER (WHERE 3 * b.source_size::DOUBLE / b.w < 3 * a.source_size::DOUBLE / a.w), 0)::BIGINT AS caps,
             sum(b.w) FILTER (WHERE 3 * b.source_size::DOUBLE / b.w >= 3 * a.source_size::DOUBLE / a.w)::BIGINT AS rest
      FROM s a, s b GROUP BY a.key),
lam AS (SELECT l.total - l.caps AS num, l.rest AS den
        FROM l JOIN s USING (key) WHERE 3 * s.source_size >= s.w::DOUBLE * (l.total - l.caps) / l.rest
        ORDER BY 3 * s.source_size::DOUBLE / s.w LIMIT 1),
t AS (SELECT key, source_size, least(3.0::DOUBLE * source_size, (w * num)::DOUBLE / den) AS target FROM s, lam),
u AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t),
r AS (SELECT d.doc_id, d.size, u.*, sum(d.size) OVER (PARTITION BY key ORDER BY h) AS upto,
             sum(d.size) OVER (PARTITION BY key, h) AS mine, row_number() OVER (PARTITION BY key, h) AS copy FROM d JOIN u USING (key))
-- a copy counts when at least half of its words fit the rest of the budget
SELECT doc_id, size, source_size, round(target, 6) AS target,
       (size * (whole + CASE WHEN whole < 3 AND upto - mine + (copy - 0.5::DOUBLE) * size <= target - whole * source_size
                        THEN 1 ELSE 0 END))::BIGINT AS taken
FROM r
"""


@query("op7_mix_sources", SQL)
def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mix_sources(read_table(spark, sf_dir, "documents"))
    return m.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"),
                    (F.col("size") * F.col("copies")).alias("taken"))
