"""Order as data: the position of every row in a global order."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftlens.config import scratch_folder


def _part_number(file_name: str) -> tuple[int, int]:
    """(partition, file of it) in the name of a part file."""
    found = re.match(r"part-(\d+).*?(?:-c(\d+))?\.", file_name)
    return int(found.group(1)), int(found.group(2) or 0)


def with_position(df: DataFrame, order_by: Sequence[str], name: str = "position") -> DataFrame:
    """``df`` and each row's place in the order of ``order_by`` (from 1, NULLs last).

    The rows are range-partitioned, sorted and written to the shared folder; a
    row's place is its index in its part file plus the rows of the files before
    it. No task holds more than its range, and the driver holds one number a file.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, "ordered")
    df.orderBy(*[F.col(c).asc_nulls_last() for c in order_by]).write.parquet(path)
    rows = (spark.read.schema(df.schema).parquet(path)
            .select(*df.columns, F.col("_metadata.file_name").alias("_file"),
                    F.col("_metadata.row_index").alias("_index")))
    sizes = {r._file: r.n for r in rows.groupBy("_file").agg(F.count(F.lit(1)).alias("n")).collect()}
    before, offsets = 0, []
    for file_name in sorted(sizes, key=_part_number):
        offsets.append((file_name, before))
        before += sizes[file_name]
    starts = spark.createDataFrame(offsets, "_file string, _before bigint")
    return (rows.join(F.broadcast(starts), "_file")
            .select(*df.columns, (F.col("_before") + F.col("_index") + 1).alias(name)))
