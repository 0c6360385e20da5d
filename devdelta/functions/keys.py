"""Key columns and Java-style string concatenation (F1, R1, K1 key)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def java_concat(*parts: Column | str) -> Column:
    """``a + b`` in Java: a NULL part prints as ``null``."""
    cols = [F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("null")) for p in parts]
    return F.concat(*cols)


def key_columns(*names: str) -> list[Column]:
    """Grouping columns for a key made of text fields.

    The original keys concatenate the fields, so a NULL field behaves like the
    text ``null``; the fields are kept apart (no separator collisions).
    """
    return [F.coalesce(F.col(n), F.lit("null")).alias(f"_k_{n}") for n in names]


def record_key(product_key: Column | str = "productKey", device_name: Column | str = "deviceName") -> Column:
    """Sink record key ``productKey-deviceName`` as bytes."""
    pk = F.col(product_key) if isinstance(product_key, str) else product_key
    dn = F.col(device_name) if isinstance(device_name, str) else device_name
    return java_concat(pk, "-", dn).cast("binary")
