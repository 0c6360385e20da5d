"""Sinks by name, for the applications and their command line (K1-K6).

    kafka:HOST:PORT/TOPIC      change events as records (keyed, or in the SQL sink's layout)
    jdbc:URL#TABLE             the ten columns and the batch id, appended (credentials only as properties)
    files:PATH                 a committed table (``sinks.commits``)
    table:NAME                 a catalog table, INSERT INTO by position
    console or console:PREFIX  every row as JSON, printed by the executors
"""

from __future__ import annotations

from devdelta.schema import CHANGE_EVENT_COLUMNS
from devdelta.sinks.commits import CommittedTable
from devdelta.sinks.writers import Target, console_target, insert_target, jdbc_target, kafka_target


def event_columns(target: Target) -> Target:
    """For path B: the diff view's columns under the names of the change event, by position."""
    return lambda df, batch_id: target(df.toDF(*CHANGE_EVENT_COLUMNS), batch_id)


def target_from(text: str, kafka_options: dict | None = None, jdbc_properties: dict | None = None, keyed: bool = True, writer: str = "stream") -> Target:
    """The target that ``text`` names; ``keyed``: path A's record layout, else path B's."""
    kind, _, rest = text.partition(":")
    if kind == "kafka" and "/" in rest:
        servers, _, topic = rest.rpartition("/")
        return kafka_target(servers, topic, kafka_options, keyed)
    if kind == "jdbc" and "#" in rest:
        url, _, table = text.rpartition("#")
        return jdbc_target(url, table, jdbc_properties or {})
    if kind == "files" and rest:
        return CommittedTable(rest, writer)
    if kind == "table" and rest:
        return insert_target(rest)
    if kind == "console":
        return console_target(rest)
    raise ValueError(f"unknown sink {text!r}: kafka:HOST:PORT/TOPIC, jdbc:URL#TABLE, files:PATH, table:NAME or console[:PREFIX]")
