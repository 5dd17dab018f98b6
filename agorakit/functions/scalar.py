"""Column helpers shared by all operators. Everything here stays inside Catalyst."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from agorakit.functions import fixed

# Above 2^52 a double has no fraction digits left to round.
_EXACT = float(2**52)


def half_up(value: Column, digits: int = 2) -> Column:
    """Round half up with plain double arithmetic.

    ``round`` on doubles goes through BigDecimal row by row; this stays in
    primitive arithmetic and gives the same bits wherever it is evaluated.
    """
    scale = float(10**digits)
    scaled = value.cast("double") * F.lit(scale)
    return F.when(F.abs(scaled) < F.lit(_EXACT), F.floor(scaled + F.lit(0.5)) / F.lit(scale)).otherwise(
        value.cast("double")
    )


def money_units(value: Column, digits: int = 4) -> Column:
    """An amount as a whole number of its smallest unit, in a type whose sums are exact for any number of rows."""
    return F.floor(value.cast("double") * F.lit(float(10**digits)) + F.lit(0.5)).cast("decimal(19,0)")


def from_units(units: Column, digits: int = 4) -> Column:
    return units.cast("double") / F.lit(float(10**digits))


def money_sum(value: Column, digits: int = 4) -> Column:
    """Sum of amounts of at most ``digits`` decimals.

    Addition order differs between runs (and between retries of a lost task). Whole
    units add up exactly, so the order leaves no trace at any size.
    """
    return from_units(F.sum(money_units(value, digits)), digits)


def money_avg(value: Column, digits: int = 4) -> Column:
    return F.try_divide(money_sum(value, digits), F.count(value))


def ratio_pct(num: Column, den: Column, digits: int = 2) -> Column:
    """``100 * num / den``, null where ``den`` is 0."""
    return half_up(F.try_divide(num, den) * F.lit(100), digits)


def days_between_floor(end: Column, start: Column) -> Column:
    """Whole days, floored: one hour before ``start`` is day -1."""
    return F.floor((F.unix_micros(end) - F.unix_micros(start)) / F.lit(86_400_000_000)).cast("int")


def month_gap(end: Column, start: Column) -> Column:
    """Month boundaries crossed, whatever the day of month."""
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


def bucket(value: Column, edges: Sequence[float], labels: Sequence[str], closed: str = "right") -> Column:
    """Label by bins. ``closed='right'``: a value equal to an edge belongs below it."""
    if len(labels) != len(edges) + 1:
        raise ValueError("one more label than edges is needed")
    if closed not in ("right", "left"):
        raise ValueError("closed is 'right' or 'left'")
    expr = None
    for edge, label in zip(edges, labels):
        below = value <= F.lit(edge) if closed == "right" else value < F.lit(edge)
        expr = F.when(below, label) if expr is None else expr.when(below, label)
    return F.when(value.isNotNull(), expr.otherwise(labels[-1]))


def sentiment(score: Column) -> Column:
    return F.when(score >= 4, "positive").when(score == 3, "neutral").otherwise("negative")


def status_category(status: Column) -> Column:
    return (
        F.when(status.isin(fixed.STATUS_COMPLETED), "completed")
        .when(status.isin(fixed.STATUS_IN_PROGRESS), "in_progress")
        .when(status.isin(fixed.STATUS_CANCELED), "canceled")
        .otherwise("other")
    )


def lookup(key: Column, table: Mapping[str, str], default: Column | str | None = None) -> Column:
    """Value of a small constant table, evaluated as a map literal."""
    entries = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    found = F.element_at(entries, key)
    if default is None:
        return found
    return F.coalesce(found, default if isinstance(default, Column) else F.lit(default))


def surrogate_key(prefix: str, *parts: Column) -> Column:
    """Prefix plus the first 16 hex digits of SHA-256 over the parts, joined by a bar."""
    text = F.concat_ws("|", *[F.trim(p.cast("string")) for p in parts])
    missing = parts[0].isNull()
    for p in parts[1:]:
        missing = missing | p.isNull()
    return F.when(~missing, F.concat(F.lit(prefix), F.substring(F.sha2(text, 256), 1, 16)))


def hash_mod(text: Column, modulus: int = 10_000) -> Column:
    """SHA-256 of ``text`` read as a 256-bit number, modulo ``modulus``.

    The hex digest is read in eight 32-bit chunks, each weighted by its power
    of 2^32 reduced by the modulus, so no big integers are needed.
    """
    if modulus > 1_000_000:
        raise ValueError("modulus too large for 64-bit arithmetic")
    digest = F.sha2(text, 256)
    total = F.lit(0).cast("long")
    for i in range(8):
        weight = pow(2**32, 7 - i, modulus)
        chunk = F.conv(F.substring(digest, i * 8 + 1, 8), 16, 10).cast("long")
        total = total + (chunk % F.lit(modulus)) * F.lit(weight)
    return total % F.lit(modulus)


def text_key(name: str) -> Column:
    """An id column as trimmed text."""
    return F.trim(F.col(name).cast("string"))


def as_timestamp(df: DataFrame, name: str) -> Column:
    """Timestamp of a column that may hold text; unparsable text becomes null."""
    if dict(df.dtypes)[name] == "string":
        return F.try_to_timestamp(F.col(name))
    return F.col(name).cast("timestamp")


def as_number(df: DataFrame, name: str, default: float | int | None = 0.0, to: str = "double") -> Column:
    """Number of a column that may hold text; unparsable text becomes ``default``."""
    value = F.col(name).try_cast(to) if dict(df.dtypes)[name] == "string" else F.col(name).cast(to)
    if to in ("double", "float"):
        value = F.when(~F.isnan(value), value)
    return value if default is None else F.coalesce(value, F.lit(default).cast(to))
