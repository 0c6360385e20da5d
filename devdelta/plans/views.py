"""SQL surface of path B: the table, the two views and the diff function.

For users who query with SQL: ``register_sql_views`` registers the snapshot
table (``ods_items_model``), the lag view (``TmpLagTable``, built by the
skew-safe DataFrame plan) and a SQL function ``getDiff(newData, oldData)``, and
defines ``TmpDiffTable`` in SQL with ``LATERAL VIEW inline(...)`` over ``getDiff``
(a SQL function may not sit inside a generator, so it is computed one level down).

``create_sink_table`` and ``insert_statement`` give the sink side: a catalog table
of the ten event columns, filled by ``INSERT INTO ... SELECT`` by position.
``register_diff_table_function`` makes the diff a table function for lateral joins;
Spark evaluates such a join once for every distinct pair of snapshots and joins
the results back, so large jobs should use ``TmpDiffTable``; a lateral join over much
data needs the lag view stored first (``store_lag_view``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from devdelta.config import Settings
from devdelta.functions.diff import DIFF_TYPE, get_diff_text_sql
from devdelta.operators import parse, snapshot
from devdelta.schema import CHANGE_EVENT_FIELDS

# --- fixed values: names of the SQL objects of the original job -------------
TABLE_VIEW = "ods_items_model"
LAG_VIEW = "TmpLagTable"
DIFF_VIEW = "TmpDiffTable"
DIFF_FUNCTION = "getDiff"
# ---------------------------------------------------------------------------
DIFF_TABLE_FUNCTION = "getDiffRows"


def register_diff_function(spark: SparkSession, settings: Settings = Settings(), name: str = DIFF_FUNCTION) -> None:
    body = get_diff_text_sql("newData", "oldData", settings.linked, settings.old_linked)
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(newData STRING, oldData STRING) "
        f"RETURNS {DIFF_TYPE} RETURN {body}"
    )


def register_sql_views(spark: SparkSession, raw: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Register the table, views and function over Kafka-shaped ``raw`` rows;
    returns the diff view."""
    table = parse.snapshot_table(raw)
    table.createOrReplaceTempView(TABLE_VIEW)
    snapshot.snapshot_lag(table, settings).createOrReplaceTempView(LAG_VIEW)
    register_diff_function(spark, settings)
    diff = spark.sql(
        f"""
        SELECT deviceType, iotId, requestId, checkFailedData, productKey, gmtCreate, deviceName,
               d.event_name, d.event_value, d.event_ori_value
        FROM (SELECT *, {DIFF_FUNCTION}(newData, oldData) AS diff FROM {LAG_VIEW}) LATERAL VIEW inline(diff) d
        """
    )
    diff.createOrReplaceTempView(DIFF_VIEW)
    return diff


def store_lag_view(spark: SparkSession, path: str) -> DataFrame:
    """Write the lag view to ``path`` and register it from there, under its name.

    A lateral join reads the view twice, and Spark judges by the view's estimated size whether to
    broadcast the distinct pairs.  The estimate for the view's plan is far too small (by the input file's size and the
    columns' default widths), so the pairs went through the driver whole; that of stored rows is the size of
    their files, and so not compressed here: texts of a tenth the size on disk would pass for small.
    """
    spark.table(LAG_VIEW).write.option("compression", "none").parquet(path)
    stored = spark.read.parquet(path)
    stored.createOrReplaceTempView(LAG_VIEW)
    return stored


DIFF_COLUMNS = [*snapshot.ENVELOPE, "event_name", "event_value", "event_ori_value"]


def register_diff_table_function(spark: SparkSession, settings: Settings = Settings(), name: str = DIFF_TABLE_FUNCTION) -> None:
    """The diff as a table function: ``FROM TmpLagTable JOIN LATERAL getDiffRows(newData, oldData)``."""
    body = get_diff_text_sql("newData", "oldData", settings.linked, settings.old_linked)
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(newData STRING, oldData STRING) "
        f"RETURNS TABLE (event_name STRING, event_value STRING, event_ori_value STRING) RETURN SELECT inline({body})"
    )


def lateral_statement(function: str = DIFF_TABLE_FUNCTION, view: str = LAG_VIEW) -> str:
    return (
        f"SELECT {', '.join(DIFF_COLUMNS)} FROM {view} tmp "
        f"INNER JOIN LATERAL {function}(newData, oldData) AS T(event_name, event_value, event_ori_value) ON TRUE"
    )


def create_sink_table(spark: SparkSession, name: str, path: str | None = None, fmt: str = "parquet") -> None:
    """K3: the sink as a catalog table of the ten event columns (at ``path``, or managed)."""
    columns = ", ".join(f"{n} {t.simpleString()}" for n, t in CHANGE_EVENT_FIELDS)
    at = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE {name} ({columns}) USING {fmt}{at}")


def insert_statement(table: str, view: str = DIFF_VIEW) -> str:
    """The diff view into the sink table; columns land by position (event_name in eventName, and so on)."""
    return f"INSERT INTO {table} SELECT {', '.join(DIFF_COLUMNS)} FROM {view}"
