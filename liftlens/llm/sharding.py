"""Sharding by a hierarchical weighted hash tree.

A tree of regions, racks and shards. A key descends level by level: every item
of a level draws ``-ln(u) / weight`` with ``u`` hashed from the key and the
item's path, and the smallest draw wins. An item's draw depends on nothing but
the key, its path and its weight, so a change of weights moves keys only into
or out of the subtrees whose weights change. A shard added as a subtree of its
own therefore takes keys only into itself.

Law of the query: ``key`` (the key and the tree decide).

Defined results: a NULL key is a key of its own (the empty string); a NULL text
has no bytes and the checksum of the empty text; repeated rows get a slot each;
an empty table gives no rows. Columns of the input that are not needed are not
read, so extra ones cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from liftlens.llm.common import blocks_of, table

Tree = dict[str, dict[str, dict[int, float]]]

#: Two regions of two racks of two equal shards.
EIGHT_SHARDS: Tree = {
    f"region{r}": {f"rack{k}": {4 * r + 2 * k + s: 1.0 for s in (0, 1)} for k in (0, 1)}
    for r in (0, 1)}

#: Rows of a (shard, slot block) that one window task numbers.
ROWS_PER_SLOT_BLOCK = 20_000
#: Copies of one row that a task lists at a time.
COPIES_PER_PIECE = 10_000


def with_shard(tree: Tree, shard: int, weight: float = 1.0) -> Tree:
    """The tree with one more shard, in a region and rack of its own."""
    taken = [s for racks in tree.values() for shards in racks.values() for s in shards]
    if shard in taken:
        raise ValueError(f"shard {shard} is in the tree already")
    return {**tree, f"region-of-{shard}": {"rack": {shard: weight}}}


def _draw(key: Column, path: str, weight: float) -> Column:
    uniform = (F.shiftrightunsigned(F.xxhash64(key, F.lit(path)), 12).cast("double") + 0.5) / 2.0**52
    return -F.log(uniform) / F.lit(float(weight))


def _choose(key: Column, items: list[tuple[str, float, Column]]) -> Column:
    """The value of the item with the smallest draw; items are (path, weight, value)."""
    items = [x for x in items if x[1] > 0]
    if not items:
        raise ValueError("a subtree needs an item of positive weight")
    if len(items) == 1:
        return items[0][2]
    draws = F.array(*[F.struct(_draw(key, path, weight).alias("draw"), F.lit(i).alias("i"))
                      for i, (path, weight, _) in enumerate(items)])
    winner = F.array_min(draws)["i"]
    out = F.when(winner == 0, items[0][2])
    for i, (_, _, value) in enumerate(items[1:], 1):
        out = out.when(winner == i, value)
    return out


def place(key: Column, tree: Tree) -> Column:
    """Struct (region, rack, shard) that the tree assigns to the key."""
    regions = []
    for region, racks in tree.items():
        inner, total = [], 0.0
        for rack, shards in racks.items():
            leaves = [(f"{region}/{rack}/{s}", w,
                       F.struct(F.lit(region).alias("region"), F.lit(rack).alias("rack"),
                                F.lit(int(s)).alias("shard")))
                      for s, w in shards.items()]
            weight = float(sum(shards.values()))
            if weight > 0:
                inner.append((f"{region}/{rack}", weight, _choose(key, leaves)))
                total += weight
        if total > 0:
            regions.append((region, total, _choose(key, inner)))
    return _choose(key, regions)


def assign_shards(docs: DataFrame, tree: Tree = EIGHT_SHARDS, grown: Tree | None = None,
                  key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, size, text_crc32, region, rack, shard, slot, grown_shard.

    ``slot`` numbers the rows of a shard from 0 without gaps. It is a running
    sum in two levels (blocks of a shard, rows of a block), so no task sees a
    whole shard; identical rows are counted before the shuffle and listed
    again at the end, so no task holds a large group of copies.
    """
    hashed = F.coalesce(F.col(key).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(key),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"))
    blocks = blocks_of(docs.count(), ROWS_PER_SLOT_BLOCK)
    counted = (rows.groupBy(key, "size", "text_crc32").agg(F.count(F.lit(1)).alias("_n"))
               .withColumn("_at", place(hashed, tree))
               .withColumn("grown_shard", place(hashed, grown)["shard"] if grown
                           else F.lit(None).cast("int"))
               .withColumn("_block", F.pmod(F.xxhash64(hashed, "size", "text_crc32"),
                                            F.lit(blocks)).cast("int"))
               .select("*", "_at.region", "_at.rack", "_at.shard").drop("_at"))
    before = Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    base = (counted.groupBy("shard", "_block").agg(F.sum("_n").alias("_total"))
            .select("shard", "_block",
                    F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_base")))
    inside = (Window.partitionBy("shard", "_block").orderBy(key, "size", "text_crc32")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = (counted.withColumn("_first", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
              .join(base, ["shard", "_block"]))
    step = F.lit(COPIES_PER_PIECE)
    pieces = (placed.withColumn("_piece", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / step)))).hint("rebalance"))
    last = F.least(F.col("_n"), (F.col("_piece") + 1) * step) - 1
    return (pieces.withColumn("_copy", F.explode(F.sequence(F.col("_piece") * step, last)))
            .select(key, "size", "text_crc32", "region", "rack", "shard",
                    (F.col("_base") + F.col("_first") + F.col("_copy")).alias("slot"),
                    "grown_shard"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = assign_shards(table(spark, sf_dir, "documents"), EIGHT_SHARDS,
                           with_shard(EIGHT_SHARDS, 8))
    return shards.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                         "slot", "grown_shard", "region", "rack")
