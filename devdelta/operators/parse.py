"""Message ingestion: gate, envelope, property explosion, linked group.

S1 P1 P2 P3 G1 G2 A1 F1 F2 F6 F11.  Everything here is a narrow, per-message
transformation (no shuffle).  A regular message's JSON text is parsed once; only
messages with irregular items, or without a single envelope field, are looked at again.

With ``observe`` the rows and properties that are left out are counted by cause in
the same pass, as observed metrics of that name (``streaming.drops`` reads them).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devdelta.config import ENVELOPE_TEXT_FIELDS, LINKED_PROPERTIES
from devdelta.functions.items import dedup_items_sql, items_map_sql
from devdelta.functions.json_text import (
    as_text_sql,
    get_string,
    json_bigint,
    long_value_sql,
    text_value,
    timestamp_ms_sql,
)
from devdelta.schema import SNAPSHOT_PARSE_DDL, TABLE_PARSE_DDL

ARRIVAL = ("partition", "offset")


def key_is_json(key: Column) -> Column:
    """The value is only kept when the record key is absent or valid JSON.
    (``json_object_keys`` also accepts objects with repeated names.)"""
    k = key.cast("string")
    return k.isNull() | F.try_parse_json(k).isNotNull() | F.json_object_keys(k).isNotNull()


def parse_messages(raw: DataFrame, ddl: str = SNAPSHOT_PARSE_DDL) -> DataFrame:
    """Kafka-shaped rows -> one row per record with the parsed message in ``m``.

    The parsed struct leaves through a one-element ``inline``: filters on its
    fields then stay above the generator, so Catalyst cannot push them below
    and re-run ``from_json`` once per referenced field.
    """
    parsed = F.from_json(F.col("value").cast("string"), ddl)
    return raw.select(
        key_is_json(F.col("key")).alias("_key_ok"),
        F.col("value").cast("string").alias("_text"),
        F.inline(F.array(F.struct(parsed.alias("m")))),
        *[F.col(c) for c in ARRIVAL],
    )


def _drop_causes() -> Column:
    """Why the gate drops a parsed message, NULL if it doesn't: the first of its faults."""
    fields = [F.col("m")[f] for f in ENVELOPE_TEXT_FIELDS]
    is_object = F.coalesce(*(f.isNotNull() | F.lit(None) for f in fields)) | F.json_object_keys("_text").isNotNull()
    names_items = F.expr("m.items IS NOT NULL OR coalesce(array_contains(json_object_keys(_text), 'items'), false)")
    missing = F.lit(False)
    for f in fields:
        missing = missing | f.isNull()
    no_items = F.expr(f"coalesce(size(m.items) = 0, NOT ({ITEMS_ARE_OBJECT}), true)")
    return (
        F.when(~F.col("_key_ok"), "bad_key")
        .when(~F.coalesce(is_object, F.lit(False)), "not_object")
        .when(missing | ~names_items, "missing_field")
        .when(no_items, "no_items")
    )


MESSAGE_CAUSES = ("bad_key", "not_object", "missing_field", "no_items")
PROPERTY_CAUSES = ("property_not_object", "property_incomplete")
ITEMS_TEXT = "get_json_object(_text, '$.items')"
ITEMS_ARE_OBJECT = f"{ITEMS_TEXT} LIKE '{{%' AND schema_of_variant(from_json(_text, 'items VARIANT').items) LIKE 'OBJECT%'"


def snapshot_messages(raw: DataFrame, observe: str | None = None) -> DataFrame:
    """P1 + P2 (path A): messages that carry all seven envelope fields.

    Envelope fields are text only when the JSON node is a string (else NULL).
    A message whose ``items`` is null or not an object yields no properties,
    so it is dropped here already.  A property that is not an object is left
    out; the others of its message stay (``skipped_properties`` names them).
    """
    p = parse_messages(raw)
    if observe:
        counts = [F.count_if(F.col("_cause") == c).alias(c) for c in MESSAGE_CAUSES]
        p = p.withColumn("_cause", _drop_causes()).observe(f"{observe}_messages", F.count("*").alias("messages"), *counts)
    gate = F.col("_key_ok")
    for f in ENVELOPE_TEXT_FIELDS:
        gate = gate & F.col("m")[f].isNotNull()
    apart = items_map_sql(ITEMS_TEXT, "value: VARIANT, time: VARIANT")
    items = f"CASE WHEN m.items IS NOT NULL THEN {dedup_items_sql('m.items')} WHEN {ITEMS_ARE_OBJECT} THEN {apart} END"
    # Names of irregular items, of which those that hold no object are left out.
    named = f"CASE WHEN m.items IS NULL THEN size(array_distinct(json_object_keys({ITEMS_TEXT}))) END"
    messages = (
        p.where(gate)
        .select(
            *[text_value(f"m.{f}").alias(f) for f in ENVELOPE_TEXT_FIELDS],
            F.expr(items).alias("items"),
            *[F.col(c) for c in ARRIVAL],
            *([F.expr(named).alias("_named")] if observe else []),
        )
        .where(F.col("items").isNotNull())
    )
    if not observe:
        return messages
    usable = "size(filter(map_entries(items), e -> e.value.value IS NOT NULL AND e.value.time IS NOT NULL))"
    left_out = {
        "property_not_object": "coalesce(_named - size(items), 0)",
        "property_incomplete": f"size(items) - {usable}",
    }
    counts = [F.coalesce(F.sum(F.expr(left_out[c])), F.lit(0)).cast("long").alias(c) for c in PROPERTY_CAUSES]
    return messages.observe(f"{observe}_properties", *counts).drop("_named")


def skipped_properties(raw: DataFrame) -> DataFrame:
    """Counts, per name, of properties that are left out: not an object, or without value or time."""
    text = "from_json(get_json_object(CAST(value AS STRING), '$.items'), 'MAP<STRING, STRING>')"
    rows = raw.select(F.explode(F.expr(text)).alias("eventName", "_item"))
    item = F.from_json("_item", "value variant, time variant")
    usable = F.col("_item").startswith("{") & item["value"].isNotNull() & item["time"].isNotNull()
    return rows.where(~F.coalesce(usable, F.lit(False))).groupBy("eventName").agg(F.count("*").alias("skipped"))


def property_events(messages: DataFrame, linked: Sequence[str] = LINKED_PROPERTIES) -> DataFrame:
    """G1 + G2: one change-event candidate per property.

    Plain property: ``eventValue = name:code``, ``eventOriValue = name:``.
    Linked property: one row per member present, each with its own name and
    time, all sharing ``A:1,B:2`` / ``A:,B:`` built from the members present in
    this message, in message order.  ``gmtCreate`` is the property's own time.
    A property without ``value`` or ``time`` is skipped (the original job
    failed on it).

    Items are exploded first so that the per-property coercions run as plain
    (code-generated) expressions; only the linked members' group text is built
    with a higher-order function, over at most the group's few entries.
    """
    names = ", ".join("'" + n.replace("'", "''") + "'" for n in linked)
    usable = "filter(map_entries(items), e -> e.value.value IS NOT NULL AND e.value.time IS NOT NULL)"
    members = f"filter(_usable, e -> e.key IN ({names}))"
    staged = messages.select("*", F.expr(usable).alias("_usable")).drop("items")
    exploded = staged.select(
        *[c for c in staged.columns if c != "_usable"],
        F.expr(
            f"array_join(transform({members}, e -> concat(e.key, ':', {as_text_sql('e.value.value')})), ',')"
        ).alias("_group_value"),
        F.expr(f"array_join(transform({members}, e -> concat(e.key, ':')), ',')").alias("_group_ori"),
        F.explode("_usable").alias("_p"),
    )
    is_linked = F.col("_p.key").isin(*linked)
    return exploded.select(
        *ENVELOPE_TEXT_FIELDS[:5],
        F.expr(long_value_sql("_p.value.time")).alias("gmtCreate"),
        ENVELOPE_TEXT_FIELDS[5],
        F.col("_p.key").alias("eventName"),
        F.when(is_linked, F.col("_group_value"))
        .otherwise(F.concat(F.col("_p.key"), F.lit(":"), F.expr(as_text_sql("_p.value.value"))))
        .alias("eventValue"),
        F.when(is_linked, F.col("_group_ori")).otherwise(F.concat(F.col("_p.key"), F.lit(":"))).alias(
            "eventOriValue"
        ),
        *ARRIVAL,
    )


def plain_properties(messages: DataFrame, linked: Sequence[str] = LINKED_PROPERTIES) -> DataFrame:
    """G1 alone: rows of properties outside the linked group."""
    return property_events(messages, linked).where(~F.col("eventName").isin(*linked))


def linked_properties(messages: DataFrame, linked: Sequence[str] = LINKED_PROPERTIES) -> DataFrame:
    """G2 alone: rows of the linked group's members."""
    return property_events(messages, linked).where(F.col("eventName").isin(*linked))


def snapshot_table(raw: DataFrame) -> DataFrame:
    """S4 + S5 (path B): the SQL JSON table over the topic.

    Missing fields are NULL (no gate); text columns render any scalar as text;
    ``gmtCreate`` is a BIGINT; ``items`` is a STRING, as it stands in the message;
    ``ts_ltz = TO_TIMESTAMP_LTZ(gmtCreate, 3)``, NULL where no timestamp can hold it.
    Records that are not a JSON object are dropped (the original job failed).
    """
    p = parse_messages(raw, TABLE_PARSE_DDL)
    names = [*ENVELOPE_TEXT_FIELDS, "gmtCreate", "items"]
    # A record with a field is an object; only others are looked at again.
    is_object = F.coalesce(*(F.col("m")[f].isNotNull() | F.lit(None) for f in names)) | F.json_object_keys("_text").isNotNull()
    fields = [get_string(F.col("m")[f]).alias(f) for f in ENVELOPE_TEXT_FIELDS]
    gmt = json_bigint("m.gmtCreate")
    return p.where(is_object).select(
        *fields[:5],
        gmt.alias("gmtCreate"),
        fields[5],
        F.col("m.items").alias("items"),
        *[F.col(c) for c in ARRIVAL],
    ).select("*", F.expr(timestamp_ms_sql("gmtCreate")).alias("ts_ltz"))
