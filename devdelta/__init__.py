"""devdelta: device-snapshot change logs on Spark.

Turns full device-state snapshots (JSON messages, Kafka-shaped rows) into a
change log: one row per property whose value changed, with the new and the
previous value.  Two generations of the rules are offered side by side:

* path A (``operators.changelog``): per-property keyed comparison in event time
  (batch: window functions; stream: ``streaming.change_processor``);
* path B (``operators.snapshot``): previous whole snapshot per device, then a
  native map diff (``functions.diff``).
"""

from devdelta.config import LINKED_PROPERTIES, Settings

__all__ = ["LINKED_PROPERTIES", "Settings"]
