"""Conflict-constrained best-fit packing of documents into bins of fixed capacity.

A text longer than a bin is cut into pieces: full ones get a bin each, the
rest is an item like any shorter text. Items are dealt evenly over the tasks
and packed in groups of ``ITEMS_PER_GROUP``, largest first. The bins of a group
are kept in order of the room left; an item goes to the tightest bin that has
room and no conflict: the search starts at the first bin with enough room and
continues to its successors. Conflicts are two bitmaps a bin carries, of the
sources and of the duplicate clusters in it: no bin holds two items of one
source, or two of one cluster. The clusters of the registered query are the
components of SimHash near-duplicates; ``pack_documents`` takes equal texts, for
documents whose near-duplicates are gone.

Dealing is by row and not by any column, so neither a common source nor a large
cluster gathers in a group, and a task holds one group at a time.

Defined results: a NULL or empty text is an item of size 0; a NULL source or
cluster conflicts with nothing; repeated rows are packed each; pieces of one
text may share no bin if the text has a cluster (they are of one cluster). An
empty table gives no rows. Columns that are not needed are not read.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from liftlens.llm.common import blocks_of, table
from liftlens.llm.simhash import near_duplicates

CAPACITY = 8_192
ITEMS_PER_GROUP = 4_096
MOST_TASKS = 10_000

_BITS_OF_GROUP = 20  # of a bin number: bins of a group (each has an item at least)


def _bitmaps(values: list) -> list[int]:
    """A bit for each value that occurs twice or more in the group; no bit for the rest."""
    counts = Counter(v for v in values if v is not None)
    bit = {v: 1 << i for i, v in enumerate(v for v, n in counts.items() if n > 1)}
    return [bit.get(v, 0) for v in values]


def best_fit(sizes: list[int], sources: list, clusters: list, capacity: int
             ) -> tuple[list[int], list[int]]:
    """(bin, offset in the bin) of each item."""
    source, cluster = _bitmaps(sources), _bitmaps(clusters)
    bins, offsets = [0] * len(sizes), [0] * len(sizes)
    used_sources: list[int] = []
    used_clusters: list[int] = []
    room: list[tuple[int, int]] = []  # (room left, bin), ordered
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        size, s, c = sizes[item], source[item], cluster[item]
        at = bisect_left(room, (size, -1))
        while at < len(room):
            b = room[at][1]
            if not (used_sources[b] & s or used_clusters[b] & c):
                left = room.pop(at)[0]
                break
            at += 1
        else:
            b, left = len(used_sources), capacity
            used_sources.append(0)
            used_clusters.append(0)
        bins[item], offsets[item] = b, capacity - left
        used_sources[b] |= s
        used_clusters[b] |= c
        if left > size:
            insort(room, (left - size, b))
    return bins, offsets


def _packer(capacity: int, per_group: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, group = TaskContext.get().partitionId(), 0
        waiting: list[pa.RecordBatch] = []

        def packed(rows: pa.Table) -> pa.RecordBatch:
            bins, offsets = best_fit(rows["size"].to_pylist(), rows["source"].to_pylist(),
                                     rows["cluster"].to_pylist(), capacity)
            first = (part << 40) + (group << _BITS_OF_GROUP)
            out = rows.append_column("bin", pa.array([first + b for b in bins], pa.int64()))
            out = out.append_column("bin_offset", pa.array(offsets, pa.int64()))
            return out.combine_chunks().to_batches()[0]

        for batch in batches:
            while batch.num_rows:
                need = per_group - sum(b.num_rows for b in waiting)
                waiting.append(batch.slice(0, need))
                batch = batch.slice(need)
                if sum(b.num_rows for b in waiting) == per_group:
                    yield packed(pa.Table.from_batches(waiting))
                    waiting, group = [], group + 1
        if waiting:
            yield packed(pa.Table.from_batches(waiting))
    return run


def pack(docs: DataFrame, size: Column, source: Column, cluster: Column, doc: str = "doc_id",
         capacity: int = CAPACITY, per_group: int = ITEMS_PER_GROUP) -> DataFrame:
    """doc, piece, start, size, source, cluster, bin, bin_offset: a row for each piece."""
    if capacity < 1 or not 1 <= per_group <= 1 << _BITS_OF_GROUP:
        raise ValueError("capacity and per_group must be positive, per_group at most 2**20")
    total = F.coalesce(size, F.lit(0)).cast("long")
    items = (docs.select(F.col(doc), source.alias("source"), cluster.alias("cluster"),
                         total.alias("_total"))
             .select("*", F.explode(F.sequence(F.lit(0).cast("long"),
                                               F.greatest(F.ceil(F.col("_total") / capacity),
                                                          F.lit(1)) - 1)).alias("piece"))
             .select(doc, "piece", (F.col("piece") * capacity).alias("start"),
                     F.least(F.lit(capacity).cast("long"),
                             F.col("_total") - F.col("piece") * capacity).alias("size"),
                     "source", "cluster"))
    tasks = min(blocks_of(docs.count(), per_group), MOST_TASKS)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema.fields)
    return items.repartition(tasks).mapInArrow(_packer(capacity, per_group),
                                               f"{schema}, bin bigint, bin_offset bigint")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Documents packed by UTF-8 bytes; equal texts are a cluster."""
    return pack(docs, F.octet_length("text"), F.col("source"),
                F.when(F.col("text") != "", F.xxhash64("text")), capacity=capacity)


def pack_near_duplicates_apart(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Documents packed by UTF-8 bytes; a cluster is a SimHash component (empty texts: none)."""
    found = near_duplicates(docs.select("doc_id", "source", "text",
                                        F.octet_length("text").alias("bytes")),
                            keep=("source", "bytes"))
    return pack(found, F.col("bytes"), F.col("source"),
                F.when(F.col("bytes") > 0, F.col("component")), capacity=capacity)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_near_duplicates_apart(table(spark, sf_dir, "documents"))
