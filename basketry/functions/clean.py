"""Coercion of text columns. Every function maps a Column to a Column and never raises on bad data."""

from pyspark.sql import Column, functions as F

# Shapes of the accepted dates, each with the date patterns tried in order.
DATE_SHAPES = [
    (r"^\d{4}-\d{1,2}-\d{1,2}$", ["yyyy-M-d"]),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", ["d-M-yyyy"]),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", ["M/d/yyyy", "d/M/yyyy"]),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", ["yyyy/M/d"]),
]
TIME_NULLS = ["nan", "NaT", "null", "None"]
TEXT_NULLS = ["nan", "NaN", "NaT", "<NA>"]
# End of fixed values.

NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
WHOLE = r"^\s*[+-]?\d+\s*$"
BLANK = r"(?U)^\s*$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def reading_name(pattern: str) -> str:
    return pattern.replace("-", "_dash_").replace("/", "_slash_")


def date_readings(c) -> Column:
    """A struct of the dates that each pattern reads in a text by itself, null where it reads none."""
    c = _col(c)
    return F.struct(*[
        F.when(c.rlike(shape), F.try_to_date(c, pattern)).alias(reading_name(pattern))
        for shape, patterns in DATE_SHAPES for pattern in patterns])


def first_reading(dates: Column) -> Column:
    """The date of a text from its ``date_readings``."""
    return F.coalesce(*[dates[reading_name(pattern)] for _, patterns in DATE_SHAPES for pattern in patterns])


def parse_order_date(c) -> Column:
    """Date from five text formats; a slash date is read month first, then day first.

    The shape test picks the one or two patterns that can match, so the parser does not fail
    up to four times per row.
    """
    c = _col(c)
    parsed = F.lit(None).cast("date")
    for shape, patterns in reversed(DATE_SHAPES):
        tried = F.coalesce(*[F.try_to_date(c, p) for p in patterns])
        parsed = F.when(c.rlike(shape), tried).otherwise(parsed)
    return parsed


def clean_time(c) -> Column:
    """First eight characters; tokens that stand for missing become null."""
    head = F.substring(_col(c), 1, 8)
    return F.when(~head.isin(TIME_NULLS), head)


def coerce_double(c) -> Column:
    """Number in text as double; anything else, NaN and infinities become null."""
    c = _col(c).cast("string")
    value = F.when(c.rlike(NUMBER), c.try_cast("double"))
    return F.when(F.abs(value) != float("inf"), value)


def coerce_bigint(c) -> Column:
    """Number in text truncated to a whole number; whole numbers never pass through double."""
    c = _col(c).cast("string")
    return F.when(c.rlike(WHOLE), c.try_cast("bigint")).otherwise(coerce_double(c).try_cast("bigint"))


def coerce_int(c) -> Column:
    return coerce_bigint(c).try_cast("int")


def coerce_money(c) -> Column:
    """Number in text as DECIMAL(18,4), so that sums do not depend on row order."""
    c = _col(c).cast("string")
    return F.when(c.rlike(NUMBER), c.try_cast("decimal(18,4)"))


def clean_string(c) -> Column:
    c = _col(c).cast("string")
    return F.when(~c.isin(TEXT_NULLS), c)


def last_time_token(c) -> Column:
    """'0 days 10:15:00' becomes '10:15:00'."""
    return F.element_at(F.split(F.trim(_col(c)), r"\s+"), -1)


def iso_date_string(c) -> Column:
    return F.date_format(parse_order_date(c), "yyyy-MM-dd")


def clean_numeric(c) -> Column:
    """Plain number with an optional '%'; digits, one point and a leading minus only."""
    text = F.replace(_col(c).cast("string"), F.lit("%"), F.lit(""))
    plain = text.rlike(r"^-?\d+\.?\d*$") | text.rlike(r"^-?\.\d+$")
    return F.when(plain, text.try_cast("double"))


def extract_numeric(c) -> Column:
    """Number before the first space of a display label, thousands separators removed; else 0."""
    head = F.replace(F.split_part(_col(c), F.lit(" "), F.lit(1)), F.lit(","), F.lit(""))
    return F.coalesce(head.try_cast("double"), F.lit(0.0))


def zero_fill(c) -> Column:
    return F.coalesce(coerce_double(c), F.lit(0.0))


def normalise_phone(c) -> Column:
    digits = F.regexp_replace(_col(c), r"(?U)[\s\-()]", "")
    return F.concat(F.lit("whatsapp:"), F.when(digits.startswith("+"), F.lit("")).otherwise("+"), digits)


def is_blank(c) -> Column:
    """True for null and for text of white space only."""
    c = _col(c)
    return c.isNull() | c.rlike(BLANK)


def ratio(numerator, denominator, scale: int = 2) -> Column:
    """Rounded quotient as double; null when the denominator is 0 or null.

    The quotient goes through a decimal before rounding, since rounding doubles is not stable.
    """
    quotient = F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))
    return rounded(quotient, scale)


def rounded(c, scale: int = 2) -> Column:
    return F.round(_col(c).cast("decimal(30,8)"), scale).cast("double")
