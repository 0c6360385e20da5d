"""Structured Streaming: the keyed change-log processor (path A), the snapshot
lag processor (path B) and the query builders around them."""
