"""Committed file tables: batches that readers see whole and once (K1 K2 K4).

A micro-batch may be written more than once: the job is killed after some files
are out, or after all are but before the batch is checkpointed, and the batch
is run again.  Here a batch's rows go into a folder of a fresh name, and one
small manifest entry then makes them part of the table:

    <path>/data/batch=<writer>-<batch id>-<random>/[is_late=...]/part-*.parquet
    <path>/manifest/<writer>-<batch id>-<random>/part-*.json    one line

The entry is a single file that appears in one piece, so the table has either all
rows of the batch (main and late together) or none.  Readers take the folders
that the manifest names, one for each (writer, batch id), and never list the data: files
of attempts that were cut off are not seen, nothing that is read is ever overwritten.
A batch that is committed already is computed when it is run again (for its state), but not written.

``writer`` names the query's checkpoint: batch ids only count within it, so a
job that starts over with a new checkpoint needs a new name.  One line is read
for each batch, on the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENTRY_DDL = "writer string, batch_id long, folder string"


class CommittedTable:
    """A ``Target`` for ``foreachBatch`` (call it) and the reader of what it wrote."""

    def __init__(self, path: str, writer: str = "stream", partition_by: Sequence[str] = ()):
        self.path = path.rstrip("/")
        self.writer = writer
        self.partition_by = list(partition_by)
        self.done: int | None = None  # the newest committed batch, once known

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        if self.done is None:
            ids = [b for w, b, _ in self.entries(spark) if w == self.writer]
            self.done = max(ids, default=-1)
        if batch_id <= self.done:
            # Still computed: a stateful query commits its state as the batch's rows are taken.
            df.write.format("noop").mode("overwrite").save()
            return
        self.commit(spark, batch_id, self.write_data(df, batch_id))
        self.done = batch_id

    def write_data(self, df: DataFrame, batch_id: int) -> str:
        """Write the rows into a folder that no manifest names yet; returns its name."""
        folder = f"{self.writer}-{batch_id}-{uuid.uuid4().hex}"
        out = df.write.partitionBy(*self.partition_by) if self.partition_by else df.write
        out.parquet(f"{self.path}/data/batch={folder}")
        return folder

    def commit(self, spark: SparkSession, batch_id: int, folder: str) -> None:
        """Make a folder part of the table: one file, written under a name of its own."""
        entry = spark.range(0, 1, 1, 1).select(
            F.lit(self.writer).alias("writer"), F.lit(batch_id).cast("long").alias("batch_id"), F.lit(folder).alias("folder")
        )
        entry.write.json(f"{self.path}/manifest/{folder}")

    def entries(self, spark: SparkSession) -> list[tuple[str, int, str]]:
        """(writer, batch id, folder), one for each batch, in order."""
        try:
            rows = spark.read.schema(ENTRY_DDL).json(f"{self.path}/manifest/*")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        # Two attempts may both have been committed by drivers that did not know of each other: they hold the same rows.
        picked = rows.where("folder is not null").groupBy("writer", "batch_id").agg(F.min("folder").alias("folder"))
        return [(r["writer"], r["batch_id"], r["folder"]) for r in picked.orderBy("writer", "batch_id").collect()]

    def read(self, spark: SparkSession, ddl: str, only: int | None = None) -> DataFrame:
        """The rows of all committed batches; with ``only``, of that batch of this writer."""
        entries = self.entries(spark)
        if only is not None:
            entries = [e for e in entries if e[:2] == (self.writer, only)]
        if not entries:
            return spark.createDataFrame([], ddl)
        root = f"{self.path}/data"
        rows = spark.read.schema(f"{ddl}, batch string").option("basePath", root)
        return rows.parquet(*[f"{root}/batch={folder}" for _, _, folder in entries]).drop("batch")


class Versions:
    """A table that is replaced as a whole, version by version; readers of one version keep its files."""

    def __init__(self, path: str):
        self.table = CommittedTable(path, writer="version")

    def commit(self, df: DataFrame, version: int) -> None:
        """Write ``df`` as a version, unless that is committed already."""
        spark = df.sparkSession
        if version not in self.numbers(spark):
            self.table.commit(spark, version, self.table.write_data(df, version))

    def numbers(self, spark: SparkSession) -> list[int]:
        return [b for _, b, _ in self.table.entries(spark)]

    def read(self, spark: SparkSession, ddl: str, version: int) -> DataFrame:
        return self.table.read(spark, ddl, only=version)
