"""Incremental file ingestion into upserted tables.

Each micro-batch appends one small delta: the upsert state of its own rows, in a
partition named after the stream's checkpoint and the batch. Nothing already stored
is rewritten. A replayed batch replaces exactly its own partition, a new
checkpoint writes under names of its own, and states merge in any order, so
replays, files sent again and late files leave the result unchanged.

Deltas are folded into one from time to time; a list beside them names those that
a fold holds, and readers skip them. Since merging is idempotent, a reader that
still sees both gets the same table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestar.operators.upsert import from_state, merge_states, to_state
from lakestar.session import freed_shuffles

FOLD_EVERY = 20


def read_if_there(spark: SparkSession, root: str) -> DataFrame | None:
    """A stored parquet table, or None before its first row: a batch without rows leaves a folder without files."""
    try:
        return spark.read.parquet(root)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


@dataclass(frozen=True)
class DeltaLog:
    """An upserted table stored as appended states.

    ``first`` columns keep the value seen first, ``last`` columns the one seen
    last, by the ``order`` columns.
    """

    root: str
    key: tuple[str, ...]
    order: tuple[str, ...]
    first: tuple[str, ...] = ()
    last: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return [*self.key, *self.first, *self.last]

    def append(self, rows: DataFrame, batch: str, fold_every: int = FOLD_EVERY) -> None:
        """Store the state of some rows; fold the deltas once ``fold_every`` of them have gathered.

        One stream appends to a log at a time, so no delta comes in during a fold.
        """
        state = to_state(rows, list(self.key), list(self.order), list(self.first), list(self.last))
        _write_batch(state, f"{self.root}/deltas", batch)
        if len(self._open(rows.sparkSession)) > fold_every:
            self.fold(rows.sparkSession)

    def _folded(self, spark: SparkSession) -> list[str]:
        listed = read_if_there(spark, f"{self.root}/folded")
        return [r["batch"] for r in listed.collect()] if listed is not None else []  # a name per folded batch

    def _open(self, spark: SparkSession) -> list[str]:
        """Names of the deltas that no fold holds."""
        stored = read_if_there(spark, f"{self.root}/deltas")
        if stored is None:
            return []
        return sorted({r["batch"] for r in stored.select("batch").distinct().collect()} - set(self._folded(spark)))

    def state(self, spark: SparkSession) -> DataFrame | None:
        stored = read_if_there(spark, f"{self.root}/deltas")
        if stored is None:
            return None
        return merge_states(stored.filter(~F.col("batch").isin(self._folded(spark))).drop("batch"), list(self.key))

    def read(self, spark: SparkSession) -> DataFrame | None:
        """The table as of now, one row per key; None before the first batch."""
        state = self.state(spark)
        return state if state is None else from_state(state, list(self.key), self.columns)

    def fold(self, spark: SparkSession) -> None:
        """One delta for all that are open. They are listed as folded only after it is written."""
        names = self._open(spark)
        if len(names) > 1:
            _write_batch(self.state(spark), f"{self.root}/deltas", f"fold-{uuid.uuid4().hex}")
            spark.createDataFrame([(n,) for n in names], "batch string").coalesce(1).write.mode("append").parquet(f"{self.root}/folded")


def _write_batch(df: DataFrame, root: str, batch: str, partition_by: tuple[str, ...] = (), gather: bool = True) -> None:
    parts = [*partition_by, "batch"]
    rows = df.withColumn("batch", F.lit(batch))
    if gather:
        rows = rows.hint("rebalance", *parts)
    with freed_shuffles(df.sparkSession):
        writer = rows.write.mode("overwrite").partitionBy(*parts).option("partitionOverwriteMode", "dynamic")
        writer.option("compression", "zstd").parquet(root)


def append_batch(facts: DataFrame, root: str, batch: str, partition_by: tuple[str, ...] = (), gather: bool = True) -> None:
    """Append fact rows under their batch; running the batch again replaces them.

    ``gather=False`` writes rows where they are, without a shuffle: for rows straight from files, which come in few tasks.
    """
    _write_batch(facts, root, batch, partition_by, gather)


def read_batches(spark: SparkSession, root: str, schema: T.StructType | None = None, batch: str | None = None) -> DataFrame:
    """All rows of the batches, or of one; with a declared schema, no rows before the first one."""
    stored = read_if_there(spark, root)
    if stored is None and schema is not None:
        return spark.createDataFrame([], schema)
    rows = spark.read.parquet(root) if stored is None else stored
    return (rows if batch is None else rows.where(F.col("batch") == batch)).drop("batch")


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json", max_files: int | None = None,
    tree: bool = True, glob: str | None = None,
) -> DataFrame:
    """New files under a directory tree, with a declared schema."""
    reader = spark.readStream.schema(schema).format(fmt).option("recursiveFileLookup", tree)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def ingest_available(stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, str], None]) -> None:
    """Process all files that are there and not yet committed, batch by batch, then stop.

    ``handle`` gets a batch and its name. The name holds the id that the checkpoint keeps for
    its stream, so a batch has the same name when it is run again and no other stream's.
    """

    def named(rows: DataFrame, batch: int) -> None:
        stream_id = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        handle(rows, f"{stream_id}-{batch}")

    query = (
        stream.writeStream.foreachBatch(named)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
