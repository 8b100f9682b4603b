"""Date and time expressions (built-in, zone-independent).

Everything is TIMESTAMP_NTZ, so results do not depend on the session time zone.
Each rule is written once as Spark SQL expression text (``*_sql``), which the
operators splice into one ``selectExpr``: the JVM parses a whole projection in
one call instead of one call per Column node. The Column forms wrap the same
text with ``F.expr``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPOCH_NTZ_SQL = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
# Epoch seconds that still land inside years 0001-9999; outside them the
# message keeps a NULL time instead of failing the whole load.
_MIN_EPOCH_S = -62135596800
_MAX_EPOCH_S = 253402300799


def _check_minutes(minutes: int) -> int:
    if not isinstance(minutes, int) or isinstance(minutes, bool):
        raise TypeError("tz offset must be whole minutes (int)")
    return minutes


def offset_interval_sql(minutes: int) -> str:
    """A day-time interval literal of ``minutes`` (signed)."""
    return f"INTERVAL '{_check_minutes(minutes)}' MINUTE"


def shift_sql(expr: str, minutes: int) -> str:
    """``expr`` shifted by a fixed offset in minutes (no DST, no zone names)."""
    if _check_minutes(minutes) == 0:
        return expr
    return f"({expr} + {offset_interval_sql(minutes)})"


def epoch_to_ntz_sql(expr: str, minutes: int = 0, unit: str = "s") -> str:
    """Epoch number to TIMESTAMP_NTZ, truncated to whole seconds, then shifted.

    ``unit`` is "s" or "ms". Out-of-range or NULL input gives NULL.
    """
    if unit == "ms":
        secs = f"({expr} / 1000.0)"
    elif unit == "s":
        secs = expr
    else:
        raise ValueError(f"epoch unit must be 's' or 'ms', got {unit!r}")
    ts = f"{EPOCH_NTZ_SQL} + make_dt_interval(0, 0, 0, floor({secs}))"
    return f"CASE WHEN {secs} BETWEEN {_MIN_EPOCH_S} AND {_MAX_EPOCH_S} THEN {shift_sql(ts, minutes)} END"


def to_utc_ntz_sql(expr: str, data_type: T.DataType) -> str:
    """Source timestamps as NTZ in UTC wall clock, whatever the session zone.

    A zone-aware TIMESTAMP goes through its instant (exact microseconds since
    the epoch); a TIMESTAMP_NTZ passes through; anything else is parsed as NTZ,
    NULL where it is no time.
    """
    if isinstance(data_type, T.TimestampNTZType):
        return expr
    if isinstance(data_type, T.TimestampType):
        micros = f"CAST(unix_micros({expr}) AS DECIMAL(18, 0))"
        return f"{EPOCH_NTZ_SQL} + make_dt_interval(0, 0, 0, {micros} / 1000000)"
    return f"try_cast(CAST({expr} AS STRING) AS TIMESTAMP_NTZ)"


def _name(col: str) -> str:
    return f"`{col}`"


def offset_interval(minutes: int) -> Column:
    return F.expr(offset_interval_sql(minutes))


def shift(col: str, minutes: int) -> Column:
    """Column form of ``shift_sql`` for a named column."""
    return F.expr(shift_sql(_name(col), minutes))


def epoch_to_ntz(col: str, minutes: int = 0, unit: str = "s") -> Column:
    """Column form of ``epoch_to_ntz_sql`` for a named column."""
    return F.expr(epoch_to_ntz_sql(_name(col), minutes, unit))


def to_utc_ntz(col: str, data_type: T.DataType) -> Column:
    return F.expr(to_utc_ntz_sql(_name(col), data_type))
