"""The versioned merge with keyed state: Spark's state store holds one row per key, and a batch reads only its own rows."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

STATE = "winner"
# The store that value states need, and the columns that tell what a batch did to a key.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUTCOME = (("outcome", T.StringType()), ("rows", T.LongType()), ("late", T.LongType()), ("repeated", T.LongType()))


cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the processor travels whole: workers need no copy of the package


class KeepNewest(StatefulProcessor):
    """Per key the row that ranks first by ``order``, greatest value first, NULL before all others. It has no time to live.

    A batch gives one row per key it touches: the key's winner, whether it is new, replaced the one before or that one
    stays, how many rows came, how many of them lost to the stored winner (late) and how many equal it (repeated).
    """

    def __init__(self, columns: Sequence[str], order: Sequence[str], schema: T.StructType):
        self.columns, self.order, self.schema = list(columns), list(order), schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState(STATE, self.schema)

    def _rank(self, row: dict) -> tuple:
        own = [(True, 0) if row[c] is None else (False, row[c]) for c in self.order]
        rest = [(row[c] is not None, str(row[c])) for c in self.columns if c not in self.order]
        return (*own, *rest)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        stored = dict(zip(self.columns, self.state.get(), strict=True)) if self.state.exists() else None
        best, count, late, repeated = stored, 0, 0, 0
        for row in rows:
            given = {c: row[c] for c in self.columns}
            count += 1
            if stored is not None and self._rank(given) <= self._rank(stored):
                same = given == stored
                repeated, late = repeated + same, late + (not same)
            if best is None or self._rank(given) > self._rank(best):
                best = given
        outcome = "NEW" if stored is None else "REPLACED" if best is not stored else "KEPT"
        if outcome != "KEPT":
            self.state.update(tuple(best[c] for c in self.columns))
        named = {f"key{i}": part for i, part in enumerate(key)}
        yield Row(**named, **best, outcome=outcome, rows=count, late=late, repeated=repeated)

    def close(self) -> None:
        pass


# Instants are whole microseconds inside the state: Python would read them in the time zone of its machine.

def _whole(field: T.StructField) -> Column:
    if isinstance(field.dataType, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01', `{field.name}`)").alias(field.name)
    return F.unix_micros(field.name).alias(field.name) if isinstance(field.dataType, T.TimestampType) else F.col(field.name)


def _read(field: T.StructField, value: str | None = None) -> Column:
    name = value or f"`{field.name}`"
    if isinstance(field.dataType, T.TimestampNTZType):
        return F.expr(f"timestampadd(MICROSECOND, {name}, TIMESTAMP_NTZ'1970-01-01')").alias(field.name)
    return (F.expr(f"timestamp_micros({name})") if isinstance(field.dataType, T.TimestampType) else F.expr(name)).alias(field.name)


def changes(events: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key and batch: keys, winner and outcome (see :class:`KeepNewest`)."""
    given = events.schema
    plain = events.select(*[_whole(f) for f in given])
    columns = [c for c in events.columns if c not in keys]
    schema = T.StructType([plain.schema[c] for c in columns])
    named = [T.StructField(f"key{i}", plain.schema[k].dataType) for i, k in enumerate(keys)]
    out = T.StructType([*named, *schema.fields, *[T.StructField(n, t) for n, t in OUTCOME]])
    grouped = plain.select(*[F.col(k).alias(f"key{i}") for i, k in enumerate(keys)], *columns).groupBy(*[f.name for f in named])
    found = grouped.transformWithState(KeepNewest(columns, order, schema), out, "Update", "None")
    return found.select(*[_read(given[k], f"key{i}") for i, k in enumerate(keys)], *[_read(given[c]) for c in columns], *[n for n, _ in OUTCOME])


def start_keyed_merge(events: DataFrame, target: str, checkpoint: str, keys: Sequence[str], order: Sequence[str]) -> StreamingQuery:
    """Merge a stream of events into keyed state; each batch's outcome goes to a folder of its own under ``target``.

    No watermark: it would drop exactly the late rows that must still be able to win. State and folders are as of
    the same batch: a batch that runs again starts from the state before it and overwrites its folder with the same rows.
    """
    spark = events.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    return changes(events, keys, order).writeStream.outputMode("update").foreachBatch(write).option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, checkpoint: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """The merged rows as of the last finished batch, read from the state itself: one row per key, no batch is merged again.

    ``schema`` is that of the events; columns come in its order.
    """
    state = spark.read.format("statestore").option("stateVarName", STATE).load(checkpoint)
    place = {k: f"key.key{i}" for i, k in enumerate(keys)}
    return state.select(*[_read(f, place.get(f.name, f"value.`{f.name}`")) for f in schema])


def batch_summary(spark: SparkSession, target: str) -> DataFrame:
    """Per batch: rows, late and repeated ones, and the keys it made, replaced and left alone."""
    written = spark.read.parquet(target)
    return written.groupBy(F.col("batch_id").cast("long").alias("batch_id")).agg(
        *[F.sum(c).cast("long").alias(c) for c in ("rows", "late", "repeated")],
        *[F.count_if(F.col("outcome") == o.upper()).alias(o) for o in ("new", "replaced", "kept")])
