"""Column builders for cleaning: every one stays inside whole-stage codegen."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"


def column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str) -> Column:
    """Decimal money from a number or a text."""
    return column(c).cast(MONEY)


def cents_to_money(c: Column | str, kind: str = MONEY) -> Column:
    """Integer cents to decimal money: 1999 becomes 19.99."""
    return (column(c).cast("decimal(36,0)") * F.lit(Decimal("0.01"))).cast(kind)


def to_cents(c: Column | str) -> Column:
    """Whole cents of a double that holds at most two decimals.

    Working in cents keeps sums exact, and is several times faster than casting each
    double to decimal, which goes through text.
    """
    return F.floor(column(c) * 100 + F.lit(0.5)).cast("bigint")


def money_sum(c: Column | str) -> Column:
    """Exact decimal sum of a double money column, as an aggregate; cents are added up in 30 digits."""
    return cents_to_money(F.sum(to_cents(c).cast("decimal(20,0)")), "decimal(18,2)")


def code(c: Column | str) -> Column:
    """Trimmed lower-case code; blank text counts as missing."""
    return F.nullif(F.lower(F.trim(column(c))), F.lit(""))


def tidy_text(c: Column | str) -> Column:
    return F.nullif(F.trim(column(c)), F.lit(""))


def upper_trim(c: Column | str) -> Column:
    return F.upper(F.trim(column(c)))


def utc_or_null(c: Column | str) -> Column:
    """Text to UTC timestamp without zone, NULL when it is no timestamp.

    Text that names an offset is converted; text without one is taken as UTC.
    """
    return column(c).try_cast("timestamp").cast("timestamp_ntz")


def number_or_null(c: Column | str, kind: str = "double") -> Column:
    return column(c).try_cast(kind)


def strict_number(c: Column | str, kind: str = "double") -> Column:
    """Fail the job on text that is no number, whatever the session's ANSI setting."""
    value = column(c)
    parsed = value.try_cast(kind)
    broken = value.isNotNull() & parsed.isNull()
    return F.when(broken, F.raise_error(F.concat(F.lit("not a number: "), value.cast("string"))).cast(kind)).otherwise(parsed)


def date_key(c: Column | str) -> Column:
    """YYYYMMDD as integer."""
    day = column(c)
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def mapped(c: Column | str, mapping: dict) -> Column:
    """Replace listed values exactly; leave the others unchanged."""
    value = column(c)
    out = None
    for old, new in mapping.items():
        out = F.when(value == F.lit(old), F.lit(new)) if out is None else out.when(value == F.lit(old), F.lit(new))
    return value if out is None else out.otherwise(value)


def inside_open(c: Column | str, low, high) -> Column:
    """low < c < high; NULL is not inside."""
    value = column(c)
    return (value > F.lit(low)) & (value < F.lit(high))


def fold_spelling(c: Column | str) -> Column:
    """Comparison form of a category: digit 0 read as letter o, trimmed, lower case."""
    return F.lower(F.trim(F.replace(column(c), F.lit("0"), F.lit("o"))))


def reasons(pairs: list[tuple[str, Column]]) -> Column:
    """Join the names of the conditions that hold; empty text means none."""
    return F.concat_ws(", ", *[F.when(cond, F.lit(name)) for name, cond in pairs])


def pseudonym(c: Column | str, salt: str) -> Column:
    """Stable pseudonym: the same input gives the same output, so joins keep working."""
    return F.sha2(F.concat(F.lit(salt), column(c).cast("string")), 256)


def line_total(quantity: Column | str, unit_price: Column | str, discount_pct: Column | str | None = None) -> Column:
    """quantity * price, less a whole percentage, rounded half up to cents."""
    if discount_pct is None:
        return (column(quantity).cast("decimal(10,0)") * column(unit_price)).cast("decimal(18,2)")
    cents = (column(unit_price) * 100).cast("bigint")
    exact = column(quantity) * cents * (F.lit(100) - column(discount_pct))
    return cents_to_money(F.call_function("div", exact + 50, F.lit(100)), "decimal(18,2)")
