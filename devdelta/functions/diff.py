"""``get_diff(new, old)``: the snapshot-to-snapshot diff of path B.

Both snapshots are parsed item maps ``map<string, struct<value, time>>`` (the
previous one typically comes from a lag); ``value`` is the text as it stands in
the message (``3.0`` stays ``3.0``).  The result is an array of
``struct<event_name, event_value, event_ori_value>`` meant for ``inline``:

* no previous snapshot -> exactly one ``ErrorCode`` row (value ``0`` when the
  new snapshot has no ``ErrorCode`` item; ``null`` when the item has no value);
* otherwise one row per key of the new snapshot whose value is not NULL and
  differs, ignoring case, from the previous value of that key (a previous NULL
  value counts as different); keys absent from the previous snapshot, and keys
  only in the previous one, are not reported;
* a key of the linked group reports the whole group in the fixed group order,
  each member as ``,Name:value`` (leading comma kept).

Deviations from the original function, all deliberate: a key missing from the
previous snapshot skips that key only (the original abandoned the remaining
keys, in hash order); an unparsable or missing new snapshot gives no rows.
``old_linked`` names the members of the old-side group text where they differ
(``config.LEGACY_OLD_GROUP``: the original printed ``LStOvMode`` twice and never
``RStOvState``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from devdelta.config import FIRST_SNAPSHOT_DEFAULT, FIRST_SNAPSHOT_PROPERTY, LINKED_PROPERTIES
from devdelta.functions.items import items_map_sql

DIFF_TYPE = "ARRAY<STRUCT<event_name: STRING, event_value: STRING, event_ori_value: STRING>>"
ITEMS_TYPE = "MAP<STRING, STRUCT<value: STRING, time: VARIANT>>"


def _lit(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _value_text(items: str, name_sql: str) -> str:
    return f"CAST(try_element_at({items}, {name_sql}).value AS STRING)"


def _group_text(items: str, names: Sequence[str]) -> str:
    parts = [
        f"CASE WHEN map_contains_key({items}, {_lit(n)}) "
        f"THEN concat({_lit(',' + n + ':')}, coalesce({_value_text(items, _lit(n))}, 'null')) ELSE '' END"
        for n in names
    ]
    return f"concat({', '.join(parts)})"


def get_diff_sql(
    new: str, old: str, linked: Sequence[str] = LINKED_PROPERTIES, old_linked: Sequence[str] | None = None
) -> str:
    """SQL text of the diff of two item maps (``new``/``old`` are SQL expressions).

    ``map_zip_with`` aligns the two snapshots by key in one hashed pass, so a
    snapshot of n properties costs O(n), not n lookups into the other map.
    """
    linked = tuple(linked)
    old_names = linked if old_linked is None else tuple(old_linked)
    if not set(old_names) <= set(linked):
        raise ValueError(f"old_linked has names outside the linked group: {sorted(set(old_names) - set(linked))}")
    in_group = ", ".join(_lit(n) for n in linked)
    ec = _lit(FIRST_SNAPSHOT_PROPERTY)
    first = (
        f"array(named_struct('event_name', {ec}, 'event_value', concat({_lit(FIRST_SNAPSHOT_PROPERTY + ':')}, "
        f"CASE WHEN try_element_at({new}, {ec}) IS NULL THEN {_lit(FIRST_SNAPSHOT_DEFAULT)} "
        f"ELSE coalesce({_value_text(new, ec)}, 'null') END), "
        f"'event_ori_value', {_lit(FIRST_SNAPSHOT_PROPERTY + ':')}))"
    )
    nv, ov = "CAST(dn.value AS STRING)", "CAST(do.value AS STRING)"
    entry = (
        f"CASE WHEN dn IS NOT NULL AND do IS NOT NULL AND {nv} IS NOT NULL "
        f"AND ({ov} IS NULL OR lower({nv}) <> lower({ov})) "
        f"THEN named_struct('event_name', dk, "
        f"'event_value', CASE WHEN dk IN ({in_group}) THEN {_group_text(new, linked)} ELSE concat(dk, ':', {nv}) END, "
        f"'event_ori_value', CASE WHEN dk IN ({in_group}) THEN {_group_text(old, old_names)} "
        f"ELSE concat(dk, ':', coalesce({ov}, 'null')) END) END"
    )
    rows = f"filter(map_values(map_zip_with({new}, {old}, (dk, dn, do) -> {entry})), dr -> dr IS NOT NULL)"
    return (
        f"CASE WHEN {new} IS NULL THEN CAST(array() AS {DIFF_TYPE}) "
        f"WHEN {old} IS NULL THEN {first} ELSE {rows} END"
    )


def get_diff_text_sql(
    new: str, old: str, linked: Sequence[str] = LINKED_PROPERTIES, old_linked: Sequence[str] | None = None
) -> str:
    """SQL text of the diff of two JSON texts; each is parsed once."""
    entry = "value: STRING, time: VARIANT"
    pair = f"named_struct('n', {items_map_sql(new, entry)}, 'o', {items_map_sql(old, entry)})"
    return f"transform(array({pair}), _p -> {get_diff_sql('_p.n', '_p.o', linked, old_linked)})[0]"


def get_diff_text(
    new: str = "newData", old: str = "oldData", linked: Sequence[str] = LINKED_PROPERTIES, old_linked: Sequence[str] | None = None
) -> Column:
    """The diff as a Column over the JSON text columns named ``new`` and ``old``."""
    return F.expr(get_diff_text_sql(f"`{new}`", f"`{old}`", linked, old_linked))


def get_diff(
    new: str = "newData",
    old: str = "oldData",
    linked: Sequence[str] = LINKED_PROPERTIES,
    old_linked: Sequence[str] | None = None,
) -> Column:
    """The diff as a Column over the item-map columns named ``new`` and ``old``."""
    return F.expr(get_diff_sql(f"`{new}`", f"`{old}`", linked, old_linked))
