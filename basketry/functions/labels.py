"""Display labels and period-over-period changes."""

from pyspark.sql import Column, functions as F

from basketry.functions.clean import _col, rounded

# Signs used in the reports.
UP, DOWN, FLAT = "🡅", "🡇", "→"
ZERO_LABEL = "(0%)"
NOT_AVAILABLE_LABEL = "(N/A)"
# End of fixed values.


def pct_change(current, previous) -> Column:
    """Change in percent, not rounded; null when there is no base."""
    current, previous = _col(current).cast("double"), _col(previous).cast("double")
    return F.try_divide(current - previous, previous) * 100


def pct_label(change, suffix: str = "%") -> Column:
    change = _col(change)
    sign = F.when(change >= 0, F.lit("+")).otherwise("")
    return F.when(change.isNotNull(), F.format_string("%s%.1f" + suffix.replace("%", "%%"), sign, rounded(change, 1)))


def trend_direction(current, average) -> Column:
    """1 for growth, -1 for decline, 0 for no change or no base."""
    change = pct_change(current, average)
    return F.coalesce(F.signum(change).cast("int"), F.lit(0))


def trend_pct(current, average) -> Column:
    """Change to one decimal; null without a base."""
    return rounded(pct_change(current, average), 1)


def trend_arrow(current, average, zero_label: str = ZERO_LABEL) -> Column:
    change = pct_change(current, average)
    arrow = F.when(change > 0, UP).when(change < 0, DOWN).otherwise(FLAT)
    return F.when(change.isNull(), F.lit(f"{FLAT} {zero_label}")).otherwise(
        F.format_string("%s (%.1f%%)", arrow, rounded(change, 1)))


def sales_label(value, trend, decimals: int = 2) -> Column:
    return F.concat_ws(" ", F.format_number(_col(value).cast("double"), decimals), _col(trend))
