"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from devdelta.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts the lineage with files that every executor can read again after one is
    lost, and fixes values such as generated row ids.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Type of a row's number.
ROW_ID = "struct<f: long, r: long>"


def row_id(docs: DataFrame) -> Column:
    """A number for each row that is the same whenever the rows are read.

    For Parquet files: the file and the row's place in it.  Numbers that depend
    on how the files are split into tasks would change between two scans when
    executors come or go.  Other frames are numbered by task and place.
    """
    try:
        docs.select("_metadata.row_index")
    except AnalysisException:
        return F.struct(F.lit(0).cast("long").alias("f"), F.monotonically_increasing_id().alias("r"))
    return F.struct(F.xxhash64("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("r"))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt: crc32 of the id's text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that a slice holds about ``limit`` bytes of text (one row at least)."""
    for b in batches:
        col = b.column(text)
        sizes = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, n in enumerate(sizes.tolist()):
            if i > start and held + n > limit:
                yield b.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < b.num_rows:
            yield b.slice(start)


def utf8(value: str | None) -> bytes:
    return b"" if value is None else value.encode("utf-8", "surrogatepass")
