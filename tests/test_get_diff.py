"""Path B hand cases (FIXTURES.md, table "Path B, get_diff")."""

import pytest
from pyspark.sql import functions as F

from devdelta.config import LEGACY_OLD_GROUP
from devdelta.functions.diff import get_diff
from devdelta.streaming.jobs import ITEMS_DDL


def diff(spark, new, old, legacy=False):
    df = spark.createDataFrame([(new, old)], "new string, old string")
    parsed = df.select(F.from_json("new", ITEMS_DDL).alias("n"), F.from_json("old", ITEMS_DDL).alias("o"))
    out = parsed.select(F.inline(get_diff("n", "o", old_linked=LEGACY_OLD_GROUP if legacy else None)))
    return sorted(tuple(r) for r in out.collect())


def items(**kv):
    import json

    return json.dumps({k: ({"value": v} if v is not ... else {"time": 1}) for k, v in kv.items()})


@pytest.mark.parametrize(
    "new,old,expected",
    [
        (items(Light="0"), None, [("ErrorCode", "ErrorCode:0", "ErrorCode:")]),
        (items(ErrorCode="7"), None, [("ErrorCode", "ErrorCode:7", "ErrorCode:")]),
        (items(Light="1"), items(Light="0"), [("Light", "Light:1", "Light:0")]),
        (items(Light="ON"), items(Light="on"), []),
        (items(Light="1"), items(Light=...), [("Light", "Light:1", "Light:null")]),
        (
            items(StOvMode="2", CookbookID="3"),
            items(StOvMode="1", CookbookID="3"),
            [("StOvMode", ",CookbookID:3,StOvMode:2", ",CookbookID:3,StOvMode:1")],
        ),
        (items(A="1", B="2"), items(B="1"), [("B", "B:2", "B:1")]),
        (items(A="1"), items(A="1", B="2"), []),
        ("not json", items(A="1"), []),
        (items(A=None), items(A="1"), []),
        (items(A="2"), items(A=None), [("A", "A:2", "A:null")]),
        (items(A=5), items(A="5"), []),
    ],
)
def test_get_diff_cases(spark, new, old, expected):
    assert diff(spark, new, old) == expected


def test_b7_old_group_default_and_legacy(spark):
    new, old = items(RStOvState="2", LStOvMode="1"), items(RStOvState="1", LStOvMode="1")
    assert diff(spark, new, old) == [("RStOvState", ",LStOvMode:1,RStOvState:2", ",LStOvMode:1,RStOvState:1")]
    assert diff(spark, new, old, legacy=True) == [
        ("RStOvState", ",LStOvMode:1,RStOvState:2", ",LStOvMode:1,LStOvMode:1")
    ]
