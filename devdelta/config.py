"""Fixed values and tunables.

Everything that has to equal the behaviour being reproduced is kept together
here as plain text, in its natural order.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values (must stay as they are for identical output) -------------
# The linked property group: these properties are reported together.
LINKED_PROPERTIES: tuple[str, ...] = (
    "CookbookID",
    "MultiStageName",
    "StOvMode",
    "LStOvMode",
    "RStOvState",
)
# Envelope fields every snapshot message must carry (path A gate).
ENVELOPE_TEXT_FIELDS: tuple[str, ...] = (
    "deviceType",
    "iotId",
    "requestId",
    "checkFailedData",
    "productKey",
    "deviceName",
)
# Property reported for a device's first snapshot in path B, and its default.
FIRST_SNAPSHOT_PROPERTY = "ErrorCode"
FIRST_SNAPSHOT_DEFAULT = "0"
# Names that the original diff printed on the old side of the linked group.
LEGACY_OLD_GROUP: tuple[str, ...] = (
    "CookbookID",
    "MultiStageName",
    "StOvMode",
    "LStOvMode",
    "LStOvMode",
)
# Topic of the snapshot messages (a default; sink topics have none).
SOURCE_TOPIC = "items-model"
# Watermark bounds: path A 30 s bounded out-of-orderness (the watermark sits
# one millisecond below max - bound), path B 30 s interval, path B idle state 24 h.
PATH_A_BOUND_MS = 30_000
PATH_B_BOUND_MS = 30_000
PATH_B_IDLE_TTL_MS = 24 * 60 * 60 * 1000
# ---------------------------------------------------------------------------

DAY_MS = 24 * 60 * 60 * 1000


@dataclass(frozen=True)
class Settings:
    """Tunables shared by the batch and the streaming plans.

    ``lag_bucket_ms`` is the width of the event-time buckets used to split one
    key's history over many tasks (see ``operators.ordering``).  Pick it so
    that one (key, bucket) slice fits comfortably in one task.
    """

    linked: tuple[str, ...] = LINKED_PROPERTIES
    lag_bucket_ms: int = DAY_MS
    bound_ms: int = PATH_A_BOUND_MS
    # Names of the old-side group text; None: the same as ``linked``.
    old_linked: tuple[str, ...] | None = None
    idle_ttl_ms: int | None = None
    # What the idle time of path B's stream is measured on: "event" or "processing" (the wall clock).
    idle_clock: str = "event"
    # Event time in one slice of a stream's pending rows (see ``streaming.pending``).
    slice_ms: int = PATH_A_BOUND_MS
    # For replays, whose batches touch every key: that many groups of keys in place of one group a key
    # (see ``streaming.key_slots``).  Part of the state's layout: fixed for a checkpoint.
    key_slots: int | None = None
    # Path A key: three separate columns (default) or, for byte parity, the
    # original single text ``productKey_deviceName_eventName`` (where a ``_``
    # inside a part can make two different keys collide).
    legacy_joined_key: bool = False


def watermark_delay_ms(bound_ms: int) -> int:
    """Spark's watermark is ``max - delay``; a bounded out-of-orderness of
    ``bound_ms`` puts the watermark at ``max - bound - 1``."""
    return bound_ms + 1
