"""Date, address, range, ratio and text expressions of the cleaning step."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Date formats of the input, in order of preference (day first).
DATE_FORMATS = ("dd/MM/yy", "yyyy-MM-dd", "dd/MM/yyyy", "MM/dd/yyyy")

# First octets counted as private, and the accepted ranges.
PRIVATE_FIRST_OCTETS = (10, 127, 172, 192)
VALID_RANGES = {"SupportTicketsCount": (0, 15), "SatisfactionScore": (1, 5)}

# Fixed value: category of a missing text.
UNKNOWN = "Inconnu"


def parse_date(text: Column) -> Column:
    """Day-first mixed-format date; what no format accepts becomes NULL.

    Two-digit years run from 1969 to 2068; Spark reads them all as 20xx.
    """

    def parsed(fmt: str) -> Column:
        day = F.try_to_timestamp(text, F.lit(fmt)).cast("date")
        if "yyyy" in fmt:
            return day
        return F.when(F.year(day) > 2068, F.add_months(day, -1200)).otherwise(day)

    return F.coalesce(*[parsed(f) for f in DATE_FORMATS])


def date_parts(df: DataFrame, column: str = "RegistrationDate", prefix: str = "Reg") -> DataFrame:
    """Replace a date text by year, month, day and weekday (Monday = 0)."""
    if column not in df.columns:
        return df
    day = parse_date(F.col(column))
    return df.withColumns(
        {
            f"{prefix}Year": F.year(day),
            f"{prefix}Month": F.month(day),
            f"{prefix}Day": F.day(day),
            f"{prefix}Weekday": F.weekday(day),
        }
    ).drop(column)


def first_octet(address: Column) -> Column:
    """Leading number of a dotted address, NULL when it is none."""
    return F.trim(F.split_part(address, F.lit("."), F.lit(1))).try_cast("int")


def is_private(address: Column, rfc1918: bool = False) -> Column:
    """1 for a private address, else 0; an unreadable one is 0.

    The default looks at the first octet only. ``rfc1918`` keeps just 10/8, 127/8,
    172.16/12 and 192.168/16.
    """
    first = first_octet(address)
    if not rfc1918:
        return F.coalesce(first.isin(*PRIVATE_FIRST_OCTETS), F.lit(False)).cast("int")
    second = F.split_part(address, F.lit("."), F.lit(2)).try_cast("int")
    private = (
        first.isin(10, 127)
        | ((first == 172) & second.between(16, 31))
        | ((first == 192) & (second == 168))
    )
    return F.coalesce(private, F.lit(False)).cast("int")


def flag_private(df: DataFrame, column: str = "LastLoginIP", rfc1918: bool = False) -> DataFrame:
    if column not in df.columns:
        return df
    return df.withColumn("IP_IsPrivate", is_private(F.col(column), rfc1918)).drop(column)


def in_range_or_null(value: Column, low: float, high: float) -> Column:
    return F.when(value.between(low, high), value)


def out_of_range_to_null(df: DataFrame) -> DataFrame:
    """Sentinels of tickets and satisfaction become missing."""
    return df.withColumns(
        {c: in_range_or_null(F.col(c), lo, hi) for c, (lo, hi) in VALID_RANGES.items() if c in df.columns}
    )


def winsorise(value: Column, low: float, high: float) -> Column:
    """Clip to the bounds; a missing value stays missing."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


# Derived ratio = numerator / (denominator + 1).
RATIOS = {
    "AvgBasket": ("MonetaryTotal", "Frequency"),
    "DiversityRatio": ("UniqueProducts", "TotalTransactions"),
    "CancelRate": ("CancelledTransactions", "TotalTransactions"),
    "ValuePerProduct": ("MonetaryTotal", "UniqueProducts"),
}


def add_ratios(df: DataFrame) -> DataFrame:
    present = set(df.columns)
    return df.withColumns(
        {
            name: F.try_divide(F.col(top).cast("double"), F.col(bottom) + 1)
            for name, (top, bottom) in RATIOS.items()
            if {top, bottom} <= present
        }
    )


def category_text(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(UNKNOWN))


def to_number(value: Column) -> Column:
    """Number, or NULL where the text is none (NaN counts as none)."""
    number = F.trim(value.cast("string")).try_cast("double")
    return F.when(~F.isnan(number), number)


def to_number_or_zero(value: Column) -> Column:
    return F.coalesce(to_number(value), F.lit(0.0))
