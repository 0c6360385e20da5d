"""The SQL surface gives the same diff as the DataFrame plan."""

from devdelta.plans.catalogue import CATALOGUE, messages
from devdelta.plans.views import lateral_statement, register_diff_table_function, register_sql_views, store_lag_view
from devdelta.sources.files import kafka_rows

from conftest import message

SF = "/root/testdata/sf0.001"


def test_sql_views_match_dataframe_plan(spark):
    register_sql_views(spark, messages(spark, SF))
    sql_rows = spark.sql("SELECT * FROM TmpDiffTable").collect()
    df_rows = CATALOGUE["snapshot_diff"](spark, SF).collect()
    assert sorted(map(tuple, sql_rows)) == sorted(map(tuple, df_rows))
    assert spark.sql("SELECT count(*) FROM ods_items_model").first()[0] > 0
    first = spark.sql(
        "SELECT inline(d) FROM (SELECT getDiff('{\"Light\":{\"value\":1}}', CAST(NULL AS STRING)) AS d)"
    ).first()
    assert tuple(first) == ("ErrorCode", "ErrorCode:0", "ErrorCode:")


def test_a_lateral_join_over_stored_rows_does_not_broadcast_them(spark, tmp_path):
    """500 KB of snapshots whose plan Spark takes for less than the limit of 100 KB."""
    rows = [message([("Light", f"{i}" * 200, i), ("Mode", i % 2, i)], iotId=f"i{i % 3}", gmtCreate=i) for i in range(500)]
    register_sql_views(spark, kafka_rows(spark, rows))
    expected = sorted(map(tuple, spark.sql("SELECT * FROM TmpDiffTable").collect()))
    register_diff_table_function(spark)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "100k")
    try:
        store_lag_view(spark, f"{tmp_path}/lag")
        joined = spark.sql(lateral_statement())
        assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, joined.collect())) == expected and len(expected) > 500
    finally:
        spark.conf.set(key, before)
