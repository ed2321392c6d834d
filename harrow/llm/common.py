"""What the operators of this subpackage share: table reading, the shared folder, batch sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.shared import checkpoint, delete, new_path, shared_folder

__all__ = ["among", "checkpoint", "delete", "drop_scratch", "scratch_path", "shared_folder", "small_batches", "stored", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Tables of this driver in the shared folder that frames may still read.
_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    _SCRATCH.append(new_path(spark, name))
    return _SCRATCH[-1]


def drop_scratch(spark: SparkSession) -> None:
    """Deletes the tables that operators have left in the shared folder.  Frames made of them can't be read any more, so
    what they hold must have been written."""
    while _SCRATCH:
        delete(spark, _SCRATCH.pop())


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Arrow batches of so many rows at most: documents may be long, and a worker holds a batch at a time."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) != rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame, written as a table in the shared folder: compressed, and read back by column."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def among(rows: DataFrame, keys: DataFrame, columns: list[str], *, bits: int = 1 << 26) -> tuple[DataFrame, DataFrame]:
    """The rows whose ``columns`` may be among the keys, and those that are surely not.

    A bit is set for each key's hash; 8 MB of bits at most go to all tasks, whatever the number of keys.  A join with the
    keys then has to shuffle little more than the rows that it keeps.
    """
    place = lambda: F.pmod(F.xxhash64(*columns), F.lit(bits))
    bitmaps = checkpoint(keys.select(place().alias("p")).groupBy((F.expr("p div 32768")).alias("_part")).agg(F.bitmap_construct_agg(F.col("p") % 32768).alias("_bits")))
    part, bit = F.expr("_place div 32768"), F.col("_place") % 32768
    looked = rows.withColumn("_place", place()).withColumn("_at", part).join(F.broadcast(bitmaps), F.col("_at") == F.col("_part"), "left")
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    marked: Column = F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False))
    flagged = looked.withColumn("_maybe", marked).drop("_place", "_at", "_part", "_bits")
    return flagged.where("_maybe").drop("_maybe"), flagged.where("not _maybe").drop("_maybe")
