"""The CLI backfills run the same rules over a topic dump."""

import tempfile

from devdelta.plans import apps
from devdelta.plans.catalogue import CATALOGUE, messages

SF = "/root/testdata/sf0.001"


def test_backfills_equal_catalogue_queries(spark):
    root = tempfile.mkdtemp(prefix="run-apps-", dir="/tmp")
    messages(spark, SF).write.parquet(f"{root}/dump")
    apps.main(["backfill-a", "--input", f"{root}/dump", "--output", f"{root}/a"])
    apps.main(["backfill-b", "--input", f"{root}/dump", "--output", f"{root}/b"])
    a = spark.read.parquet(f"{root}/a").drop("_day")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, CATALOGUE["change_log"](spark, SF).select(*a.columns).collect()))
    b = spark.read.parquet(f"{root}/b")
    assert b.count() == CATALOGUE["snapshot_diff"](spark, SF).count()
    assert "eventName" in b.columns
