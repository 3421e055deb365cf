"""Text-to-type conversions for raw trip cells (all native column expressions).

Semantics follow Python's ``float()`` / ``int()`` on a CSV cell: an empty cell is
"missing", a non-empty cell that does not parse is a "bad value". Spark's
``try_cast`` is more lenient than Python for some spellings (``'1d'`` is a
double to Spark), so every cast sits behind a grammar check. Digit-group
underscores (``'1_0'``), which Python accepts, are treated as bad values.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted spellings, written as Java regular expressions.
FLOAT_PATTERN = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$"
INT_PATTERN = r"^\s*[+-]?\d+\s*$"
SIGNED_NAN_PATTERN = r"(?i)^\s*[+-]nan\s*$"   # Python reads these as NaN, Spark's cast does not


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c) -> Column:
    """A cell counts as present only when it is non-empty."""
    return F.nullif(_c(c), F.lit(""))


def is_blank(c) -> Column:
    return _c(c).isNull() | (_c(c) == F.lit(""))


def is_double_text(c) -> Column:
    """Cell spells a float (never NULL: blank and NULL cells are False)."""
    return F.coalesce(_c(c).rlike(FLOAT_PATTERN), F.lit(False))


def is_int_text(c) -> Column:
    """Cell spells an integer that fits INT (never NULL)."""
    return F.coalesce(_c(c).rlike(INT_PATTERN) & _c(c).try_cast("int").isNotNull(), F.lit(False))


def to_double(c) -> Column:
    """``float(cell)``, NULL for a blank or unparsable cell.

    The grammar check also rejects the empty cell, so no separate blank test.
    The NaN fallback is evaluated only when the cast fails.
    """
    return F.when(_c(c).rlike(FLOAT_PATTERN), spelled_double(c))


def spelled_double(c) -> Column:
    """``float(cell)`` of a cell that is known to spell a float (``is_double_text``)."""
    nan = F.when(_c(c).rlike(SIGNED_NAN_PATTERN), F.lit(float("nan")))
    return F.coalesce(_c(c).try_cast("double"), nan)


def to_int(c) -> Column:
    """``int(cell)``: an integer literal only, so ``'1.5'`` is a bad value."""
    return F.when(_c(c).rlike(INT_PATTERN), _c(c).try_cast("int"))


def default_key(key, row_no, present: bool = True, mode: str = "null") -> Column:
    """Trip key with the ``row_<i>`` default.

    ``mode="absent"`` reproduces the original rule: the default is used only when
    the key *column* is missing. ``mode="null"`` also fills NULL keys.
    """
    fallback = F.concat(F.lit("row_"), _c(row_no).cast("string"))
    if not present:
        return fallback
    if mode == "absent":
        return _c(key)
    if mode == "null":
        return F.coalesce(_c(key), fallback)
    raise ValueError(f"unknown key mode {mode!r}")
