"""Chat formatting by multi-party perspective rotation.

Every participant of a conversation is trained on once: the dialogue is
rendered with that speaker as the assistant and all others as named users, and
a mask marks the assistant's own words.  System turns are instructions in
every rendering and no participant.

A conversation is rendered in parts of bounded length, so one that holds a
third of all turns gives many rows and no task holds it whole.  Parts are
consecutive dialogue, and each starts with the system turns said before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.joins import broadcast_if_small
from ..session import cut_lineage
from .common import let, query, read_table

PART_TURNS = 512
BROADCAST_BYTES = 64 << 20         # of a side table, whose ids and texts have no length limit
SYSTEM = "system"
NOBODY = "unknown"
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def _ranked(t: DataFrame) -> DataFrame:
    """``t`` with the rank of a row in its (key, part) by ``s``: ranges are numbered alone, after the counts of those before."""
    order = ["key", "part", "s"]
    t = cut_lineage(t.repartitionByRange(*order).withColumn("range", F.spark_partition_id()))
    counts = t.groupBy("key", "part", "range").agg(F.count("*").alias("c"))
    earlier = Window.partitionBy("key", "part").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = cut_lineage(counts.select("key", "part", "range", F.coalesce(F.sum("c").over(earlier), F.lit(0)).alias("first")))
    inside = F.row_number().over(Window.partitionBy("key", "part", "range").orderBy("s")) - 1
    return t.withColumn("inside", inside).join(broadcast_if_small(counts, max_bytes=BROADCAST_BYTES), ["key", "part", "range"]).withColumn("rank", F.col("first") + F.col("inside"))


def rotate_perspectives(turns: DataFrame, part_turns: int = PART_TURNS, conv_col: str = "conv_id", turn_col: str = "turn",
                        role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, speaker, part, sub_part, n_turns, n_own, text, mask): a row per participant and part.

    mask holds the [start, end) character ranges of ``text`` that the speaker
    says, each with its end mark.  Part p has turn numbers from p * part_turns on.

    * Turns are in order of (turn, role, text), NULL turns last in a part of
      their own; exact repeated turns count once.
    * A part with more rows than ``part_turns`` (repeated or NULL turn numbers)
      is cut by rank into consecutive sub-parts; otherwise sub_part is 0.
    * Every part starts with the different system texts said before it, the
      first ``part_turns`` of them; n_turns counts the turns of the part itself.
    * NULL role: a user named "unknown", never a speaker; NULL text is empty.
    * NULL conv_id is a conversation of its own.  A conversation without
      participants and an empty table give no rows.  Other columns are not read.
    """
    key = F.when(F.col(conv_col).isNull(), F.lit("-")).otherwise(F.concat(F.lit("c"), F.col(conv_col).cast("string")))
    t = turns.select(key.alias("key"), F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).alias("role"),
                     F.coalesce(F.col(text_col), F.lit("")).alias("text")).distinct()
    t = cut_lineage(t.withColumn("part", F.coalesce(F.floor(F.col("turn") / part_turns), F.lit(-1)).cast("long")))
    speakers = t.where(F.col("role").isNotNull() & (F.col("role") != SYSTEM)).select("key", F.col("role").alias("speaker")).distinct()
    sizes = cut_lineage(t.groupBy("key", "part").agg(F.count("*").alias("n")))
    large = sizes.where(F.col("n") > part_turns).select("key", "part", F.lit(True).alias("cut"))
    t = t.join(broadcast_if_small(large, max_bytes=BROADCAST_BYTES), ["key", "part"], "left")
    said = F.struct(F.col("turn").isNull().alias("late"), "turn", F.col("role").isNull().alias("none"), "role", "text")
    names = ["key", "part", "conv", "turn", "role", "text"]
    ranked = _ranked(t.where("cut").select(*names, said.alias("s")))
    t = t.where("cut IS NULL").select(*names, F.lit(0).alias("sub_part")).unionByName(
        ranked.select(*names, F.floor(F.col("rank") / part_turns).cast("int").alias("sub_part")))
    parts = t.groupBy("key", "part", "sub_part").agg(F.first("conv").alias("conv"), F.array_sort(F.collect_list(said)).alias("said"))
    # instructions of conversations in several parts
    several = sizes.groupBy("key").agg(F.count("*").alias("parts"), F.max("n").alias("n")).where((F.col("parts") > 1) | (F.col("n") > part_turns)).select("key")
    orders = (t.where(F.col("role") == SYSTEM).join(broadcast_if_small(several, max_bytes=BROADCAST_BYTES), "key", "left_semi")
              .groupBy("key", "text").agg(F.min(said).alias("s"))
              .withColumn("r", F.row_number().over(Window.partitionBy("key").orderBy("s"))).where(F.col("r") <= part_turns)
              .groupBy("key").agg(F.array_sort(F.collect_list("s")).alias("orders")))                  # at most ``part_turns`` a key
    before = F.filter(F.coalesce("orders", F.slice("said", 1, 0)), lambda x: x < F.get("said", F.lit(0)))
    parts = parts.join(broadcast_if_small(cut_lineage(orders), max_bytes=BROADCAST_BYTES), "key", "left").withColumn("all_said", F.concat(before, "said"))

    def head(role: Column, speaker: Column) -> Column:
        name = F.coalesce(role, F.lit(NOBODY))
        return F.concat(F.lit(OPEN), F.when(role == speaker, F.lit("assistant")).when(role == SYSTEM, F.lit(SYSTEM))
                        .otherwise(F.concat(F.lit("user name="), name)), F.lit("\n"))

    def rendered(speaker: Column) -> Column:
        rows = F.transform("all_said", lambda s: F.struct(head(s["role"], speaker).alias("h"), F.concat(s["text"], F.lit(CLOSE)).alias("b"),
                                                      F.coalesce(s["role"] == speaker, F.lit(False)).alias("own")))
        return let(rows, with_mask)

    def with_mask(rows: Column) -> Column:
        def step(acc: Column, r: Column) -> Column:
            start = acc["at"] + F.length(r["h"])
            end = start + F.length(r["b"])
            return F.struct(end.alias("at"), F.when(r["own"], F.concat(acc["mask"], F.array(F.struct(start.alias("start"), end.alias("end")))))
                            .otherwise(acc["mask"]).alias("mask"))

        zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("mask"))
        return F.struct(F.concat_ws("", F.transform(rows, lambda r: F.concat(r["h"], r["b"]))).alias("text"),
                        F.aggregate(rows, zero, step, lambda a: a["mask"]).alias("mask"))

    out = parts.join(speakers, "key").withColumn("r", rendered(F.col("speaker")))
    return out.select(F.col("conv").alias(conv_col), "speaker", "part", "sub_part", F.size("said").cast("long").alias("n_turns"),
                      F.size("r.mask").cast("long").alias("n_own"), F.col("r.text").alias("text"), F.col("r.mask").alias("mask"))


SQL = f"""
WITH t AS (SELECT DISTINCT conv_id, turn, role, coalesce(text, '') AS text, coalesce(floor(turn / {PART_TURNS})::BIGINT, -1) AS part FROM conversations),
sp AS (SELECT DISTINCT conv_id, role AS speaker FROM t WHERE role IS NOT NULL AND role <> '{SYSTEM}'),
r AS (SELECT t.*, speaker, '{OPEN}' || CASE WHEN role = speaker THEN 'assistant' WHEN role = '{SYSTEM}' THEN '{SYSTEM}'
             ELSE 'user name=' || coalesce(role, '{NOBODY}') END || chr(10) AS h, text || '{CLOSE.strip()}' || chr(10) AS b,
             coalesce(role = speaker, false) AS own
      FROM t JOIN sp ON t.conv_id IS NOT DISTINCT FROM sp.conv_id),
o AS (SELECT *, coalesce(sum(length(h) + length(b)) OVER (PARTITION BY conv_id, speaker, part ORDER BY turn NULLS LAST, role NULLS LAST, text
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(h) AS a FROM r)
SELECT conv_id, speaker, part, 0::INT AS sub_part, count(*)::BIGINT AS n_turns, count(*) FILTER (WHERE own)::BIGINT AS n_own,
       string_agg(h || b, '' ORDER BY turn NULLS LAST, role NULLS LAST, text) AS text,
       coalesce(string_agg(a::BIGINT::VARCHAR || '-' || (a + length(b))::BIGINT::VARCHAR, ',' ORDER BY a) FILTER (WHERE own), '') AS mask
FROM o GROUP BY conv_id, speaker, part
"""


@query("op2_chat_rotation", SQL)
def op2_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = rotate_perspectives(read_table(spark, sf_dir, "conversations"))
    mask = F.array_join(F.transform("mask", lambda m: F.concat(m["start"].cast("string"), F.lit("-"), m["end"].cast("string"))), ",")
    return r.withColumn("mask", mask)
