"""Item maps from JSON text, as SQL text."""

from __future__ import annotations


def dedup_items_sql(items: str) -> str:
    """Repeated names inside one ``items`` object: keep the first position and
    the last value, as a JSON tree does.  The repeated-name path is only taken
    by messages that actually repeat a name."""
    return (
        f"CASE WHEN size(array_distinct(map_keys({items}))) = size(map_keys({items})) THEN {items} "
        f"ELSE map_from_entries(transform(array_distinct(map_keys({items})), "
        f"k -> named_struct('key', k, 'value', element_at(filter(map_entries({items}), e -> e.key = k), -1).value))) END"
    )


def items_map_sql(text: str, entry: str) -> str:
    """An item map from JSON text; ``entry`` is the struct DDL of one item.

    An item that is not an object makes the one-step parse fail for the whole
    map; only then are the items taken apart first, and such items left out.
    Text that holds no object gives NULL.
    """
    each = dedup_items_sql(f"from_json({text}, 'MAP<STRING, STRING>')")
    apart = (
        f"map_from_entries(transform(filter(map_entries({each}), e -> e.value LIKE '{{%'), "
        f"e -> named_struct('key', e.key, 'value', from_json(e.value, 'STRUCT<{entry}>'))))"
    )
    return f"coalesce({dedup_items_sql(f'from_json({text}, ' + repr(f'MAP<STRING, STRUCT<{entry}>>') + ')')}, {apart})"
