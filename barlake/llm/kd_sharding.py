"""Sharding by a k-d tree over document metadata.

The root holds all documents.  A node that must give k leaves splits along its
widest metadata dimension (range in the node over range in the table) at the
distributed weighted median, so that both sides get bytes in proportion to
their leaves.  Splitting stops when leaves reach the target bytes.

The cut is found by histograms: bytes are summed over equal-width slices of
the dimension, and only the slice that holds the cut is divided again.  Each
round returns a number of sums that does not depend on the input.

Equal texts are a group with one place in every dimension, the smallest of
its rows.  Rows that tie in the dimension are ordered by text hash; a group of
up to ``GROUP_SHARE`` of a leaf's bytes goes whole to the side nearer to the
cut, a larger one is divided by row, as one text may fill a third of the table.
Sources and languages are placed by their rank among the distinct names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.joins import broadcast_if_small
from ..session import cut_lineage
from .common import query, read_table

SLICES = 1024
#: A slice is divided until it is one value or holds no more than this share of its node.
TOLERANCE = 1 / 2 ** 14
SLOT_BUCKET_ROWS = 50_000
#: Groups of equal texts up to this share of a leaf are not divided; each cut is off by half of it at most.
GROUP_SHARE = 1 / 2
DIMS = ("by_source", "by_lang", "by_size", "by_id")
TIES = ("by_text", "by_row")
HASH_TOP = 2 ** 62 - 1                               # differences of dimension values stay in 64 bits
ID_TOP = 2 ** 61


def name_ranks(names: DataFrame) -> DataFrame:
    """(name, rank) of every distinct name in code-point order, from 0, for any number of names.

    Names are range-partitioned and sorted; the rank is the place in the partition after the counts of those before.
    """
    held = names.where("name IS NOT NULL").distinct().repartitionByRange("name").sortWithinPartitions("name")
    held = cut_lineage(held.withColumn("place", F.monotonically_increasing_id()))
    held = held.withColumn("part", F.shiftright("place", 33))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)           # one row a partition
    first = held.groupBy("part").agg(F.count("*").alias("c")).select("part", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("first"))
    return cut_lineage(held.join(F.broadcast(first), "part").select("name", (F.col("first") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))).alias("rank")))


def _with_group_places(rows: DataFrame) -> DataFrame:
    """``rows`` with ranks for names, and for rows of equal texts the smallest place of their group in each dimension."""
    for name, d in (("source", "by_source"), ("lang", "by_lang")):
        ranks = name_ranks(rows.select(F.col(name).alias("name"))).select(F.col("name").alias(name), F.col("rank").alias(d))
        rows = rows.join(broadcast_if_small(ranks), name, "left").withColumn(d, F.coalesce(d, F.lit(-1).cast("long"))).drop(name)
    low = rows.groupBy("by_text").agg(F.count("*").alias("c"), *[F.min(d).alias(f"low_{d}") for d in DIMS]).where("c > 1").drop("c")
    rows = rows.join(broadcast_if_small(cut_lineage(low)), "by_text", "left")
    return rows.withColumns({d: F.coalesce(f"low_{d}", d) for d in DIMS}).drop(*[f"low_{d}" for d in DIMS])


@dataclass
class Cut:
    """Rows of the node go right if (dim, ties...) is above the bounds."""
    node: int
    path: list  # [(column, bound), ...] compared lexicographically


def _node_column(cuts: list[Cut]) -> Column:
    node = F.lit(1).cast("long")
    for c in cuts:
        right = F.lit(False)
        for col, bound in reversed(c.path):
            b = F.lit(bound).cast("long")
            right = (F.col(col) > b) | ((F.col(col) == b) & right)
        node = F.when(node == c.node, F.lit(2 * c.node).cast("long") + right.cast("long")).otherwise(node)
    return node


def _find_cuts(rows: DataFrame, open_nodes: dict[int, tuple[str, int, int, float, float]]) -> list[Cut]:
    """Cuts of ``{node: (dim, low, high, bytes that go left, bytes of a group kept whole)}``, a few jobs for all nodes together."""
    state = {n: {"cols": [d, *TIES], "at": 0, "lo": lo, "hi": hi, "want": want, "eps": max(1.0, want * TOLERANCE), "group": group, "path": []}
             for n, (d, lo, hi, want, group) in open_nodes.items()}
    done: list[Cut] = []
    while state:
        slice_col, keep = F.lit(None).cast("long"), F.lit(False)
        for n, s in state.items():
            c = F.col(s["cols"][s["at"]])
            width = max(1, -(-(s["hi"] - s["lo"] + 1) // SLICES))
            s["width"] = width
            here = (F.col("node") == n) & c.between(F.lit(s["lo"]), F.lit(s["hi"]))
            for col, bound in s["path"]:
                here = here & (F.col(col) == F.lit(bound).cast("long"))
            pos = F.expr(f"({s['cols'][s['at']]} - {s['lo']}L) div {width}L")
            slice_col, keep = F.when(here, pos).otherwise(slice_col), keep | here
        hist = (rows.where(keep).groupBy("node", slice_col.alias("slice"))
                .agg(F.sum("size").cast("long").alias("bytes")).collect())    # at most SLICES rows a node
        for n in list(state):
            s = state[n]
            mine = sorted((r["slice"], r["bytes"]) for r in hist if r["node"] == n)
            left = 0
            for i, b in mine:
                if left + b >= s["want"]:
                    break
                left += b
            lo = s["lo"] + i * s["width"]
            hi = min(s["hi"], lo + s["width"] - 1)
            s["want"] -= left
            last_col = s["at"] == len(s["cols"]) - 1
            whole = s["width"] == 1 and s["cols"][s["at"]] == "by_text" and b <= s["group"]
            if b <= s["eps"] or whole or (s["width"] == 1 and last_col):     # cut at the nearer edge of the slice
                bound = hi if 2 * s["want"] >= b else lo - 1
                done.append(Cut(n, [*s["path"], (s["cols"][s["at"]], bound)]))
                # ties of the bound stay left: its followers are all at most the maximum
                done[-1].path += [(c, HASH_TOP) for c in s["cols"][s["at"] + 1:]]
                del state[n]
            elif s["width"] == 1:                                     # one value: go on with the ties
                s["path"].append((s["cols"][s["at"]], lo))
                s["at"] += 1
                s["lo"], s["hi"] = 0, HASH_TOP
            else:
                s["lo"], s["hi"] = lo, hi
    return done


def kd_shards(docs: DataFrame, target_bytes: int | None = None, shards: int | None = None,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) with leaves of nearly equal bytes.

    Give ``target_bytes`` per leaf or the number of ``shards``.  Size is the
    UTF-8 bytes of the text plus 1.

    * NULL text: no bytes, crc32 of the empty text.  NULL metadata sorts first.
    * Equal texts share a leaf unless they hold more than ``GROUP_SHARE`` of one; larger groups and
      rows that tie in all else are separated by a written row number, so all leaves stay near equal
      even if one text or one key fills the table.
    * An empty table gives no rows; fewer rows than shards leave shards empty.
    * Reads the columns id, text, lang and source (absent ones count as NULL) only.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.encode(F.col(text_col), "UTF-8"), F.encode(F.lit(""), "UTF-8"))
    attr = lambda c: F.col(c).cast("string") if c in docs.columns else F.lit(None).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), (F.length(body).cast("long") + 1).alias("size"),
                       F.crc32(body).alias("text_crc32"), F.shiftrightunsigned(F.xxhash64(body), 2).alias("by_text"),
                       attr("source").alias("source"), attr("lang").alias("lang"),
                       F.round(F.log2(F.length(body) + F.lit(1.0)) * 65536).cast("long").alias("by_size"),
                       F.greatest(F.lit(-ID_TOP), F.least(F.lit(ID_TOP), F.coalesce(F.col(id_col).cast("long"), F.lit(-1)))).alias("by_id"),
                       F.monotonically_increasing_id().alias("rid"))
    # written once: row numbers are fixed from here on
    rows = cut_lineage(_with_group_places(cut_lineage(rows))).withColumn("by_row", F.shiftrightunsigned(F.xxhash64("rid"), 2))
    ends = lambda: [f(d).alias(f"{f.__name__}_{d}") for d in DIMS for f in (F.min, F.max)]
    top = rows.agg(F.count("*").alias("n"), F.sum("size").alias("bytes"), *ends()).first()
    n, total = top["n"], top["bytes"] or 0
    leaves = shards or max(1, round(total / target_bytes))
    spread = {d: max(1, (top[f"max_{d}"] or 0) - (top[f"min_{d}"] or 0)) for d in DIMS}
    plan, cuts = {1: leaves}, []                     # node -> leaves it must give
    while n and any(k > 1 for k in plan.values()):
        at = rows.withColumn("node", _node_column(cuts))
        stats = {r["node"]: r for r in at.groupBy("node").agg(F.sum("size").alias("bytes"), *ends()).collect()}
        todo = {}
        for node, k in plan.items():
            if k > 1 and node in stats:
                r = stats[node]
                d = max(DIMS, key=lambda x: (r[f"max_{x}"] - r[f"min_{x}"]) / spread[x])
                todo[node] = (d, r[f"min_{d}"], r[f"max_{d}"], r["bytes"] * (k // 2) / k, GROUP_SHARE * r["bytes"] / k)
        cuts += _find_cuts(at, todo)
        plan = {c: kk for node, k in plan.items()
                for c, kk in ([(node, 1)] if k == 1 else [(2 * node, k // 2), (2 * node + 1, k - k // 2)])}
    number = {node: i for i, node in enumerate(sorted(plan, key=lambda x: bin(x)[3:]))}
    shard = F.lit(0)
    for node, i in number.items():
        shard = F.when(F.col("node") == node, F.lit(i)).otherwise(shard)
    out = rows.withColumn("node", _node_column(cuts)).withColumn("shard", shard)
    # gapless slots: rows are numbered inside small buckets, after the counts of the buckets before
    out = out.withColumn("part", F.pmod(F.col("by_row"), F.lit(max(1, -(-n // SLOT_BUCKET_ROWS)))))
    counts = out.groupBy("shard", "part").agg(F.count("*").alias("c"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = cut_lineage(counts.select("shard", "part", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("first")))
    slot = F.row_number().over(Window.partitionBy("shard", "part").orderBy("rid")) - 1
    return (out.withColumn("in_part", slot).join(broadcast_if_small(counts), ["shard", "part"])
            .select(F.col("id").alias(id_col), "size", "text_crc32", F.col("shard").cast("int").alias("shard"),
                    (F.col("first") + F.col("in_part")).cast("long").alias("slot")))


@query("op4_kd_shards")
def op4_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = kd_shards(read_table(spark, sf_dir, "documents"), shards=8)
    return s.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard"))
