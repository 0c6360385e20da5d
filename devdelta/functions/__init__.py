"""Column expressions (all native Spark SQL; no Python UDFs)."""

from devdelta.functions.codes import changed_against, code_of
from devdelta.functions.diff import get_diff
from devdelta.functions.json_text import (
    as_text,
    as_text_sql,
    json_bigint,
    json_bigint_sql,
    get_string,
    long_value,
    long_value_sql,
    text_value,
    text_value_sql,
)
from devdelta.functions.keys import java_concat, key_columns, record_key

__all__ = [
    "as_text",
    "as_text_sql",
    "json_bigint_sql",
    "get_diff",
    "long_value_sql",
    "text_value_sql",
    "changed_against",
    "code_of",
    "json_bigint",
    "get_string",
    "java_concat",
    "key_columns",
    "long_value",
    "record_key",
    "text_value",
]
