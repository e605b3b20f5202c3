"""Layer tables as Parquet folders: one folder per run or snapshot, published by a numbered commit."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline import schemas
from plumbline.sources.commits import Commit, CommitConflict, Commits, StepLog

def now() -> datetime:
    return datetime.now(timezone.utc)


class Store:
    """Tables under one root folder, shared by all executors.

    A run or snapshot is written to its own folder, so a repeated write replaces
    only itself and readers of other runs never notice. Spark has no transaction
    over several Parquet folders: a snapshot counts only once its commit, written
    last, is there. Commits of a table are numbered, and a number can be taken once, so
    of two writers on one parent one wins and the other one learns of it.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table.replace('.', '/')}"

    def _read_or_empty(self, schema: T.StructType, path: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    # Run-scoped layer tables

    def write_run(self, table: str, df: DataFrame, run_id: str, *metrics: Column) -> dict:
        """Write a run's rows. Aggregates in ``metrics`` are observed by the write itself: nothing is read again."""
        declared = schemas.struct(table)
        rows = df.select(*[F.col(f.name).cast(f.dataType) for f in declared if f.name != "run_id"])
        seen = Observation()
        if metrics:
            rows = rows.observe(seen, *metrics)
        rows.write.mode("overwrite").parquet(f"{self.path(table)}/run_id={run_id}")
        return seen.get if metrics else {}

    def read_run(self, table: str, run_id: str) -> DataFrame:
        return self.read(table).where(F.col("run_id") == run_id)

    def read(self, table: str) -> DataFrame:
        return self._read_or_empty(schemas.struct(table), self.path(table))

    def write(self, table: str, df: DataFrame) -> None:
        columns = [F.col(f.name).cast(f.dataType) for f in schemas.struct(table)]
        df.select(*columns).write.mode("overwrite").parquet(self.path(table))

    def columns(self, table: str, run_id: str | None = None) -> list[tuple[str, str, bool]] | None:
        """Stored columns with type and nullability, or None without a table.

        Names and types come from the files. A file scan reports every column as
        nullable, so nullability comes from the declared schema.
        """
        path = self.path(table) if run_id is None else f"{self.path(table)}/run_id={run_id}"
        try:
            stored = self.spark.read.option("basePath", self.path(table)).parquet(path).schema
        except AnalysisException as problem:
            if problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise
        declared = {f.name: f for f in schemas.struct(table)} if table in schemas.LAYERS else {}
        found = []
        for column in stored:
            contract = declared.get(column.name)
            data_type = contract.dataType if contract is not None and column.name == "run_id" else column.dataType
            nullable = contract.nullable if contract is not None else True
            found.append((column.name, schemas.type_name(data_type), nullable))
        return found

    # Append-only logs

    def append(self, table: str, rows: list[dict], schema_of: str | None = None) -> None:
        schema = schemas.struct(schema_of or table)
        data = [tuple(row.get(f.name) for f in schema) for row in rows]
        self.spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(self.path(table))

    def steps(self, table: str, schema_of: str) -> StepLog:
        """A log whose steps are numbered commits."""
        return StepLog(self.spark, self.path(table), schemas.struct(schema_of))

    # Snapshots

    def commits(self, table: str) -> Commits:
        return Commits(self.spark, f"{self.root}/_commits/{table}")

    def mark(self, table: str, snapshot_id: str, parent: int | None = None) -> Commit:
        """Make a written snapshot the current one, by one commit.

        With ``parent``, the number of the commit that the snapshot was made from (0: none), a commit in between is a
        CommitConflict. Without it the snapshot replaces whatever is current: a writer that loses reads on and tries again.
        """
        body = {"snapshot_id": snapshot_id, "published_at": now()}
        if parent is not None:
            return self.commits(table).commit(body, parent)
        while True:
            try:
                return self.commits(table).commit(body, self.version(table))
            except CommitConflict:
                continue

    def version(self, table: str) -> int:
        """The number of the current commit, 0 before the first one."""
        head = self.commits(table).head()
        return head.number if head else 0

    def publish_together(self, name: str, parts: dict[str, DataFrame], snapshot_id: str, parent: int | None = None) -> Commit:
        """Write several tables, then make all of them current by the same commit."""
        for part, df in parts.items():
            df.write.mode("overwrite").parquet(f"{self.path(name)}.{part}/snapshot={snapshot_id}")
        return self.mark(name, snapshot_id, parent)

    def current_part(self, name: str, part: str) -> DataFrame:
        snapshot_id = self.current_snapshot(name)
        if snapshot_id is None:
            raise LookupError(f"{name} has no published snapshot")
        return self.spark.read.parquet(f"{self.path(name)}.{part}/snapshot={snapshot_id}")

    def publish(self, table: str, df: DataFrame, snapshot_id: str, parent: int | None = None) -> Commit:
        """Write a whole new snapshot, then make it the current one."""
        df.write.mode("overwrite").parquet(f"{self.path(table)}/snapshot={snapshot_id}")
        return self.mark(table, snapshot_id, parent)

    def current_snapshot(self, table: str) -> str | None:
        head = self.commits(table).head()
        return head.body["snapshot_id"] if head else None

    def current(self, table: str) -> DataFrame:
        snapshot_id = self.current_snapshot(table)
        if snapshot_id is None:
            raise LookupError(f"{table} has no published snapshot")
        return self.spark.read.parquet(f"{self.path(table)}/snapshot={snapshot_id}")
