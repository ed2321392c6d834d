"""Scheduled polling as a stream: each micro-batch is put into a table by key, so replays and late corrections are safe.

The table is partitioned by its first key, usually the date.  A batch writes a version that holds only the partitions it
touches, whole; the table is the newest version of each partition.  So a batch costs as much as what it changes, whatever
the size of the table.  A version is named by its batch: a batch that is run again writes the same again, and readers see
it when its files are all there.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.operators.relational import upsert
from harrow.shared import delete, new_path

PART = "_part"


def children(spark: SparkSession, path: str) -> list[str]:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(hadoop)] if fs.exists(hadoop) else []


def partitions(spark: SparkSession, path: str, before: int | None = None) -> dict[str, list[int]]:
    """By partition folder, the committed versions that hold it, oldest first; those before a version, if one is given."""
    numbers = sorted(int(n[1:]) for n in children(spark, path) if n.startswith("v") and n[1:].isdigit())
    out: dict[str, list[int]] = {}
    for v in numbers:
        names = children(spark, f"{path}/v{v}") if before is None or v < before else []
        for n in names if "_SUCCESS" in names else []:
            if n.startswith(f"{PART}="):
                out.setdefault(n, []).append(v)
    return out


def read_parts(spark: SparkSession, path: str, parts: dict[str, list[int]], schema=None) -> DataFrame | None:
    if not parts:
        return None
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(*(f"{path}/v{versions[-1]}/{name}" for name, versions in sorted(parts.items())))


def current(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest version of each partition."""
    return read_parts(spark, path, partitions(spark, path))


def put(batch: DataFrame, number: int, path: str, keys: Sequence[str], order: str) -> None:
    """Writes the version of the batch, and deletes what two later versions have replaced.

    The names of the partitions that a batch touches are collected: as many as it has days.
    """
    spark, version = batch.sparkSession, number + 1
    part = F.coalesce(F.col(keys[0]).cast("string"), F.lit("none"))
    touched = {f"{PART}={r[0]}" for r in batch.select(F.regexp_replace(part, r"[^\w.-]", "_")).distinct().collect()}
    held = {n: v for n, v in partitions(spark, path, before=version).items() if n in touched}
    stored = read_parts(spark, path, held, batch.schema)
    merged = upsert(stored if stored is not None else spark.createDataFrame([], batch.schema), batch, keys, order)
    named = merged.withColumn(PART, F.regexp_replace(part, r"[^\w.-]", "_"))
    named.repartition(PART).write.mode("overwrite").partitionBy(PART).parquet(f"{path}/v{version}")
    for name, versions in held.items():
        for old in versions[:-1]:  # readers may still be at the last one
            delete(spark, f"{path}/v{old}/{name}")


def upsert_stream(rows: DataFrame, path: str, checkpoint: str, *, keys: Sequence[str], order: str):
    """Starts a query that puts all rows now available into the table and ends."""
    return rows.writeStream.foreachBatch(lambda batch, n: put(batch, n, path, keys, order)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def of_today(rows: DataFrame, day: str) -> DataFrame:
    """Rows of the day, or none: polls on other days change nothing."""
    return rows.where(F.col("date") == F.lit(day).cast("date"))


def union_of_available(reads: dict[str, Callable[[], DataFrame]], *, columns: str, spark: SparkSession) -> tuple[DataFrame, str | None]:
    """Rows of all sources that could be read, and a warning naming the others; an error if none could.

    Each source is read at once, into the shared folder, so one that can't be reached fails here and not in a later action.
    """
    frames, failed = [], []
    for name, read in reads.items():
        path = new_path(spark, "source")
        try:
            found = read()
            found.write.parquet(path)
            frames.append(spark.read.schema(found.schema).parquet(path))
        except Exception as e:  # noqa: BLE001  a source's failure must not stop the others
            failed.append(f"{name}: {e}")
    if failed and not frames:
        raise RuntimeError(" | ".join(failed))
    out = spark.createDataFrame([], columns)
    for f in frames:
        out = out.unionByName(f)
    return out, " | ".join(failed) or None
