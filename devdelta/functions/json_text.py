"""JSON value -> text / number coercions (F11), on VARIANT columns.

The message is parsed once with ``from_json`` into VARIANT leaves; the JSON
type of a leaf then decides how it is rendered.  A missing field is SQL NULL,
a JSON ``null`` is a variant null (``schema_of_variant`` = ``VOID``).

Each rule exists as SQL text (``*_sql``, usable inside higher-order lambdas and
``selectExpr``) and as a Column function.  Outside lambdas the repeated
``schema_of_variant`` is shared by common-subexpression elimination.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INTEGRAL = "('BIGINT', 'INT', 'SMALLINT', 'TINYINT')"
# Integer literals too long for a 64-bit long come back as DECIMAL(p,0), p >= 19.
_BIG_INTEGER = r"'^DECIMAL\\((19|2[0-9]|3[0-8]),0\\)$'"


def text_value_sql(v: str) -> str:
    """Text of a JSON string node, NULL for any other node (``textValue()``)."""
    return f"CASE WHEN schema_of_variant({v}) = 'STRING' THEN CAST({v} AS STRING) END"


def as_text_sql(v: str) -> str:
    """Text rendering of any JSON node (``asText()``); NULL only when missing.

    null -> ``"null"``; object/array -> ``""``; integers as digits; fractional
    numbers through a double (``3.0`` -> ``"3.0"``, ``1e3`` -> ``"1000.0"``).
    """
    k = f"schema_of_variant({v})"
    return (
        f"CASE WHEN {v} IS NULL THEN CAST(NULL AS STRING) "
        f"WHEN {k} = 'VOID' THEN 'null' "
        f"WHEN {k} IN ('STRING', 'BOOLEAN', 'BIGINT', 'INT', 'SMALLINT', 'TINYINT') THEN CAST({v} AS STRING) "
        f"WHEN {k} RLIKE {_BIG_INTEGER} THEN CAST({v} AS STRING) "
        f"WHEN {k} LIKE 'DECIMAL%' OR {k} IN ('DOUBLE', 'FLOAT') THEN CAST(CAST({v} AS DOUBLE) AS STRING) "
        f"ELSE '' END"
    )


def long_value_sql(v: str) -> str:
    """``longValue()``: numbers truncated toward zero, anything else 0.

    NULL only when the field is missing (the caller skips such properties).
    Numbers outside the 64-bit range give 0 instead of wrapping around.
    """
    k = f"schema_of_variant({v})"
    return (
        f"CASE WHEN {v} IS NULL THEN CAST(NULL AS BIGINT) "
        f"WHEN {k} IN {_INTEGRAL} OR {k} IN ('DOUBLE', 'FLOAT') OR {k} LIKE 'DECIMAL%' "
        f"THEN coalesce(try_cast({v} AS BIGINT), 0L) ELSE 0L END"
    )


def get_string_sql(v: str) -> str:
    """Path B rendering of a nested value: NULL for missing or JSON null,
    strings as is, numbers and booleans as text, objects/arrays as compact JSON."""
    return f"CAST({v} AS STRING)"


def json_bigint_sql(v: str) -> str:
    """BIGINT column of the SQL JSON table: numbers truncated, numeric strings
    parsed, anything else NULL."""
    k = f"schema_of_variant({v})"
    return (
        f"CASE WHEN {k} IN {_INTEGRAL} OR {k} IN ('DOUBLE', 'FLOAT') OR {k} LIKE 'DECIMAL%' "
        f"THEN try_cast({v} AS BIGINT) "
        f"WHEN {k} = 'STRING' THEN try_cast(trim(CAST({v} AS STRING)) AS BIGINT) END"
    )


# Milliseconds of 0001-01-01 and 9999-12-31T23:59:59.999, the timestamps that Spark prints.
FIRST_MS, LAST_MS = -62_135_596_800_000, 253_402_300_799_999


def timestamp_ms_sql(ms: str) -> str:
    """epoch milliseconds as a timestamp, NULL outside the years 1 to 9999
    (a sender's nanoseconds would overflow and end the job)."""
    return f"CASE WHEN {ms} BETWEEN {FIRST_MS} AND {LAST_MS} THEN timestamp_millis({ms}) END"


def _col(sql_of, name: str) -> Column:
    return F.expr(sql_of(f"`{name}`" if "." not in name else name))


def text_value(name: str) -> Column:
    return _col(text_value_sql, name)


def as_text(name: str) -> Column:
    return _col(as_text_sql, name)


def long_value(name: str) -> Column:
    return _col(long_value_sql, name)


def get_string(v: Column) -> Column:
    return v.cast("string")


def json_bigint(name: str) -> Column:
    return _col(json_bigint_sql, name)
