"""Near-duplicates by SimHash and a segment-popcount embedding.

A text's fingerprint has a bit set where more than half of its shingles' hashes
have it. Fingerprints link at ``MAX_BITS`` (3) or fewer different bits. To find
them, a fingerprint is mapped to the bit counts of its 32 segments of two bits.
The Manhattan distance of two such vectors is at most the number of different
bits, so linked fingerprints have vectors at distance 3 or less, and in one
half of 16 segments at distance 1 or less. That is a range join on a grid: in
either half a fingerprint lies in the cell of its vector and looks into this
cell and those one step up in one segment (the other one looks up where the
step is down). Pairs that meet are verified by their bits.

A cell of many fingerprints (``CROWDED``) is cut into tiles of at most about
``TILE`` by ``TILE``; a tile returns links that connect what it connects, not
all its pairs. Copies of a fingerprint are one row in all of this.

Defined results: NULL and empty texts and texts without words have fingerprint
0, linked like any other; a document without an id takes its component's
smallest id; a component without ids has NULL; repeated rows are answered each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from liftlens.llm.common import table, text_bytes, written
from liftlens.llm.components import components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
CROWDED = 256
TILE = 2_000

_HALF = 16  # segments of two bits in a half
_PAIRS = 0x55555555


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles, repeats included (0 without words)."""
    words = text.lower().split()  # of bytes: A-Z, and white space 20 and 09 to 0D
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(
        starts[:len(words) - size + 1].tolist(), ends[size - 1:].tolist(), strict=True)], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view(np.int64)[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(batch.num_columns - 1))
            found = [fingerprint(data[a:b].tobytes(), shingle)
                     for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(found, pa.int64())],
                names=[*batch.schema.names[:-1], "fingerprint"])
    return run


def with_fingerprint(docs: DataFrame, keep: list[str], text: str = "text",
                     shingle: int = SHINGLE) -> DataFrame:
    """The kept columns and ``fingerprint`` (bigint)."""
    frame = docs.select(*keep, F.col(text).alias("_simhash_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields[:-1])
    return frame.mapInArrow(_fingerprints(shingle), f"{schema}, fingerprint bigint")


def _half_counts(half: int) -> Column:
    """The bit counts of 16 segments as 16 fields of two bits."""
    bits = F.shiftrightunsigned("f", 32 * half).bitwiseAND(0xFFFFFFFF)
    return bits.bitwiseAND(_PAIRS) + F.shiftright(bits, 1).bitwiseAND(_PAIRS)


def _cell(half: int, counts: Column) -> Column:
    return counts + F.lit(half << 32)


def _tile_links(max_bits: int):
    """Links (a, b) that connect what the pairs of a tile within ``max_bits`` connect."""
    def run(tile: pa.Table) -> pa.Table:
        own = np.asarray(tile["own"])
        f = np.asarray(tile["f"])
        left, right = np.unique(f[own]).view(np.uint64), np.unique(f[~own]).view(np.uint64)
        nodes = np.concatenate([left, right])
        label = np.arange(len(nodes))
        if len(left) and len(right):
            near = np.empty((len(left), len(right)), bool)
            for i in range(0, len(left), 256):
                near[i:i + 256] = np.bitwise_count(
                    left[i:i + 256, None] ^ right[None, :]) <= max_bits
            row, col = np.nonzero(near.any(axis=1))[0], np.nonzero(near.any(axis=0))[0]
            near = near[np.ix_(row, col)]
            a, b = label[row], label[len(left) + col]
            while near.size:
                top = np.where(near, b[None, :], len(nodes)).min(axis=1)
                a2 = np.minimum(a, top)
                b2 = np.minimum(b, np.where(near, a2[:, None], len(nodes)).min(axis=0))
                if (a2 == a).all() and (b2 == b).all():
                    break
                a, b = a2, b2
            label[row], label[len(left) + col] = a, b
        moved = label != np.arange(len(nodes))
        return pa.table({"a": nodes[moved].view(np.int64), "b": nodes[label[moved]].view(np.int64)})
    return run


def links_within(fingerprints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``f``) that differ in few bits.

    Every pair within ``max_bits`` is linked or connected by links.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("the grid of two halves finds up to 3 different bits")
    own = fingerprints.select("f", F.explode(F.array(
        *[_cell(h, _half_counts(h)) for h in (0, 1)])).alias("cell"))
    looks = [_cell(h, _half_counts(h)) for h in (0, 1)]
    for h in (0, 1):
        for s in range(_HALF):
            field = F.shiftrightunsigned(_half_counts(h), 2 * s).bitwiseAND(3)
            looks.append(F.when(field < 2, _cell(h, _half_counts(h) + F.lit(1 << (2 * s)))))
    probes = (fingerprints.select("f", F.explode(F.array(*looks)).alias("cell"))
              .where("cell IS NOT NULL"))
    # What the rows of a cell are joined with is a table and not an aggregate on the
    # join's own key, so Spark may split the rows of a crowded cell.
    crowded = written(own.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
                      .where(F.col("n") > CROWDED), "crowded-cells")
    pairs = (own.join(crowded, "cell", "left_anti").select("cell", F.col("f").alias("a"))
             .join(probes.select("cell", F.col("f").alias("b")), "cell")
             .where((F.col("a") != F.col("b"))
                    & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits))
             .select("a", "b"))
    if crowded.isEmpty():
        return pairs
    return written(pairs, "cell-pairs").union(_dense_links(own, probes, crowded, max_bits))


def _dense_links(own: DataFrame, probes: DataFrame, crowded: DataFrame, max_bits: int) -> DataFrame:
    """Links of the cells of many fingerprints, tile by tile."""
    looked = (probes.join(crowded.select("cell"), "cell")
              .groupBy("cell").agg(F.count(F.lit(1)).alias("p")))
    plan = written(crowded.join(looked, "cell")
                   .select("cell", F.ceil(F.col("n") / TILE).cast("int").alias("rows"),
                           F.ceil(F.col("p") / TILE).cast("int").alias("cols")), "cell-tiles")

    def dealt(frame: DataFrame, mine: str, other: str, is_own: bool) -> DataFrame:
        part = F.pmod(F.xxhash64("f"), F.col(mine)).cast("int").alias(mine + "_at")
        every = F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other + "_at")
        return (frame.select("cell", "f").join(plan, "cell")
                .select("cell", "f", part, every)
                .select("cell", "rows_at", "cols_at", "f", F.lit(is_own).alias("own")))

    tiles = dealt(own, "rows", "cols", True).union(dealt(probes, "cols", "rows", False))
    return (tiles.groupBy("cell", "rows_at", "cols_at")
            .applyInArrow(_tile_links(max_bits), "a bigint, b bigint"))


def near_duplicates(docs: DataFrame, doc: str = "doc_id", text: str = "text",
                    shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """doc, the kept columns, fingerprint (bigint), component and component_id.

    ``component`` is the fingerprint that stands for the component,
    ``component_id`` the smallest id of its documents.
    """
    prints = written(with_fingerprint(docs, [doc, *keep], text, shingle), "fingerprints")
    distinct = written(prints.groupBy(F.col("fingerprint").alias("f"))
                       .agg(F.min(doc).alias("least")), "distinct-fingerprints")
    roots = components(links_within(distinct.select("f"), max_bits))
    placed = written(distinct.join(roots.withColumnRenamed("node", "f"), "f", "left").select(
        "f", "least", F.coalesce("root", "f").alias("component")), "placed-fingerprints")
    first = written(placed.groupBy("component").agg(F.min("least").alias("component_id")),
                    "component-ids")
    named = written(placed.join(first, "component").select(
        F.col("f").alias("fingerprint"), "component", "component_id"), "named-fingerprints")
    return prints.join(named, "fingerprint").select(doc, *keep, "fingerprint", "component",
                                                    "component_id")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        "component_id")
