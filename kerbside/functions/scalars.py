"""Column-expression helpers.

Every helper returns a JVM-side ``Column`` built from ``pyspark.sql.functions`` so the
expressions stay inside whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(10,2)"
#: sums of amounts: no window's total overflows it
WIDE_MONEY = "decimal(20,2)"


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# F1 -- ISO-8601 text -> timestamp with millisecond precision.
def iso_to_ts(c: str | Column) -> Column:
    """The time of an ISO-8601 text (``T`` or a space between date and time), to the millisecond: later
    fraction digits are cut, not rounded. A zone (``Z``, ``+02:00``, ``+0200``) is honoured, behind whole
    seconds as well; without one the session's zone (UTC) holds. Other text gives null instead of failing
    the task."""
    text = F.trim(col_of(c))
    cut = F.regexp_replace(text, r"(\.[0-9]{3})[0-9]+", "$1")
    return F.when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:|$)"), cut.try_cast("timestamp"))


# F2 -- null-propagating concatenation (string ``+`` of the alert rules).
def concat_null(*parts: str | Column) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


# F3 -- cast that yields null on overflow instead of raising under ANSI mode.
def safe_cast(c: str | Column, to: str) -> Column:
    return col_of(c).try_cast(to)


def money_avg(total: str | Column, count: str | Column, to: str = MONEY) -> Column:
    """Exact decimal mean rounded half-up once to the money scale (sum / count)."""
    return safe_cast(col_of(total) / col_of(count), to)


# F7 -- null-safe numeric cast: NaN and unparseable values become null.
def null_safe_double(c: str | Column) -> Column:
    d = safe_cast(c, "double")
    return F.when(F.isnan(d), F.lit(None).cast("double")).otherwise(d)


# F9 -- duration between two timestamps in whole milliseconds (truncation like int()).
def ms_between(later: str | Column, earlier: str | Column) -> Column:
    return F.unix_millis(col_of(later)) - F.unix_millis(col_of(earlier))


def add_ms(ts: str | Column, ms: str | Column) -> Column:
    return F.timestamp_millis(F.unix_millis(col_of(ts)) + col_of(ms))


# F10 -- identifier builders.
def session_key(year: str | Column, event: str | Column, session: str | Column) -> Column:
    """``{year}_{event}_{session}`` with spaces replaced by underscores."""
    return F.translate(F.concat_ws("_", col_of(year), col_of(event), col_of(session)), " ", "_")


def lap_event_id(session_id: str | Column, driver: str | Column, lap: str | Column) -> Column:
    return F.concat_ws("_", col_of(session_id), F.lit("lap"), col_of(driver), col_of(lap))


def pit_event_id(session_id: str | Column, driver: str | Column, lap: str | Column) -> Column:
    return F.concat_ws("_", col_of(session_id), F.lit("pit"), col_of(driver), col_of(lap))


def pit_stop_id(driver: str | Column, stint: str | Column) -> Column:
    return F.concat_ws("_", F.lit("pit"), col_of(driver), col_of(stint))


# F11 -- Python ``isoformat()`` rendering of an aware UTC timestamp: microseconds only
# when non-zero, offset written as +00:00.
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"
ISO_FORMAT_WHOLE = "yyyy-MM-dd'T'HH:mm:ssxxx"


def isoformat(c: str | Column) -> Column:
    ts = col_of(c)
    return F.when(F.unix_micros(ts) % 1000000 == 0, F.date_format(ts, ISO_FORMAT_WHOLE)).otherwise(
        F.date_format(ts, ISO_FORMAT))


# F12 -- replay-stable record id from the message coordinates.
def stable_ingest_id(topic: str | Column, partition: str | Column, offset: str | Column) -> Column:
    return F.sha2(F.concat_ws("|", col_of(topic), col_of(partition).cast("string"),
                              col_of(offset).cast("string")), 256)


# F13 -- event selector: round number when numeric, else case-insensitive name substring.
def event_matches(round_col: str | Column, name_col: str | Column, selector: str) -> Column:
    as_int = F.lit(selector).try_cast("int")
    return F.when(as_int.isNotNull(), col_of(round_col) == as_int).otherwise(
        F.lower(col_of(name_col)).contains(selector.lower()))


# F14 -- PII mask keeping the last four characters.
def mask_last4(c: str | Column) -> Column:
    return F.concat(F.lit("..."), F.right(col_of(c), F.lit(4)))


# P14 / F15 -- lower-case every column name (document sink normalisation).
def lower_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def made_once(df: DataFrame) -> DataFrame:
    """The same rows out of a generator, through which no condition is pushed: each condition on a column that is parsed from
    a message would parse the message anew, and render it where the log is rendered as it is read."""
    return df.select(F.inline(F.array(F.struct(*df.columns))))


# F18 -- unit harmonisation.
def kph_to_ms(c: str | Column) -> Column:
    return col_of(c) / F.lit(3.6)


#: Fixed values: (from, to) -> factor and what is added then.
UNITS = {("kph", "m/s"): (1 / 3.6, 0.0), ("kph", "mph"): (1 / 1.609344, 0.0), ("mph", "kph"): (1.609344, 0.0), ("m/s", "kph"): (3.6, 0.0),
         ("c", "f"): (1.8, 32.0), ("c", "k"): (1.0, 273.15), ("f", "c"): (1 / 1.8, -32 / 1.8), ("bar", "kpa"): (100.0, 0.0),
         ("bar", "psi"): (14.503773773, 0.0), ("psi", "bar"): (1 / 14.503773773, 0.0), ("kg", "lb"): (1 / 0.45359237, 0.0),
         ("lb", "kg"): (0.45359237, 0.0), ("deg", "rad"): (0.017453292519943295, 0.0), ("ms", "s"): (0.001, 0.0), ("s", "ms"): (1000.0, 0.0)}


def to_unit(c: str | Column, unit: str, to: str) -> Column:
    """A value in another unit; null and NaN stay what they are."""
    if unit == to:
        return col_of(c).cast("double")
    if (unit, to) not in UNITS:
        raise ValueError(f"no conversion from {unit} to {to}")
    factor, added = UNITS[unit, to]
    out = col_of(c).cast("double") * F.lit(factor)
    return out + F.lit(added) if added else out


def harmonised(df: DataFrame, units: dict[str, tuple[str, str]]) -> DataFrame:
    """columns by name with the unit they are in and the one they are to be in; others as they are."""
    missing = [c for c in units if c not in df.columns]
    if missing:
        raise ValueError(f"no columns {missing}")
    return df.select(*[to_unit(c, *units[c]).alias(c) if c in units else F.col(c) for c in df.columns])
