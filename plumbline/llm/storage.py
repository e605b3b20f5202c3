"""Intermediate tables in the cluster's shared folder, and a gapless rank without a global sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.session import work_dir


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession, size: str = "24m") -> None:
    """Bounds the Arrow batches that Python functions are given by bytes as well as by rows, unless the session says how."""
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, size)


def written(frame: DataFrame, purpose: str) -> DataFrame:
    """The rows of ``frame`` as a table in the shared folder: cuts lineage and survives a lost executor."""
    path = work_dir(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def dropped(table: DataFrame) -> None:
    """Deletes the folder of a table that :func:`written` gave and that nothing reads any more."""
    spark = table.sparkSession
    for folder in {file.rpartition("/")[0] for file in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def buckets_for(rows: int, per_bucket: int, spark: SparkSession) -> int:
    """Buckets so that one holds about ``per_bucket`` rows, and no fewer than the shuffle has partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_bucket))


def clear_of(frame: DataFrame, *names: str) -> list[str]:
    """Names like ``names`` that no column of ``frame`` has, whatever the case."""
    taken, out = {c.lower() for c in frame.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def ranked(frame: DataFrame, group: list[str], part: Column, order: list[Column], rank: str, total: str) -> DataFrame:
    """Adds the 0-based ``rank`` in each group by (part, order) and the group's ``total``.

    ``part`` is an integer that rises with the order and cuts a group into bounded parts. Parts are
    counted first; a row's rank is the count of the parts before plus its place in its own part, so
    no task holds more than one part's rows, however large the group.
    """
    p, before, size = clear_of(frame, "_part", "_before", "_size")
    keyed = frame.withColumn(p, part)
    counts = keyed.groupBy(*group, p).agg(F.count(F.lit(1)).alias(size))
    by_group = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    offsets = counts.select(
        *group, p,
        (F.sum(size).over(by_group.orderBy(p).rowsBetween(Window.unboundedPreceding, 0)) - F.col(size)).alias(before),
        F.sum(size).over(by_group).alias(total),
    )
    keys = [*group, p]
    right = offsets.select(*[F.col(k).alias(f"{k}__r") for k in keys], before, total)
    on = [keyed[k].eqNullSafe(right[f"{k}__r"]) for k in keys]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    numbered = keyed.withColumn(rank, place.cast("long") - 1)
    on = [numbered[k].eqNullSafe(right[f"{k}__r"]) for k in keys]
    joined = numbered.join(right, on, "inner")
    return joined.select(*frame.columns, (F.col(rank) + F.col(before)).alias(rank), F.col(total))
