"""``code_of`` and the change predicate of path A.

A change-event text is a comma-separated list of ``name:code`` pieces (one
piece for a plain property, the whole linked group otherwise).  The code of a
piece is the text between its first and second ``:`` ("" when absent).  The
current code of property ``name`` comes from the first piece named ``name``;
the row changed when *any* piece of the previous text is named ``name`` and
carries a different code.

Texts without a comma (the common case) use plain string functions, which stay
inside whole-stage codegen; only multi-piece texts go through the array
higher-order functions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _piece_name(piece: Column) -> Column:
    return F.substring_index(piece, ":", 1)


def _piece_code(piece: Column) -> Column:
    return F.when(F.instr(piece, ":") > 0, F.substring_index(F.substring_index(piece, ":", 2), ":", -1)).otherwise(
        F.lit("")
    )


def _pieces(text: Column) -> Column:
    return F.split(text, ",")


def code_of(text: Column, name: Column) -> Column:
    """Code of the first piece named ``name`` in ``text``; NULL if none."""
    single = F.when(_piece_name(text) == name, _piece_code(text))
    first = F.get(F.filter(_pieces(text), lambda z: _piece_name(z) == name), 0)
    multi = F.when(first.isNotNull(), _piece_code(first))
    return F.when(F.instr(text, ",") == 0, single).otherwise(multi)


def changed_against(previous: Column, current: Column, name: Column) -> Column:
    """True when ``previous`` has a piece named ``name`` whose code differs from
    ``code_of(current, name)`` (a missing current code counts as different)."""
    cur = code_of(current, name)
    single = (_piece_name(previous) == name) & ~_piece_code(previous).eqNullSafe(cur)
    multi = F.exists(_pieces(previous), lambda z: (_piece_name(z) == name) & ~_piece_code(z).eqNullSafe(cur))
    return F.coalesce(F.when(F.instr(previous, ",") == 0, single).otherwise(multi), F.lit(False))


# Per-row twins used inside the stateful processor (same rules as above).
def py_piece_code(piece: str) -> str:
    parts = piece.split(":")
    return parts[1] if len(parts) > 1 else ""


def py_code_of(text: str | None, name: str) -> str | None:
    if text is None:
        return None
    for piece in text.split(","):
        if piece.split(":")[0] == name:
            return py_piece_code(piece)
    return None


def py_changed_against(previous: str | None, current: str | None, name: str) -> bool:
    if previous is None:
        return False
    cur = py_code_of(current, name)
    return any(p.split(":")[0] == name and py_piece_code(p) != cur for p in previous.split(","))
