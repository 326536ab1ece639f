"""Small column helpers: rounding, trimming, first element."""

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Fixed value: the characters a JVM string trim takes off, U+0000 to U+0020.
TRIMMED = "".join(chr(code) for code in range(0x21))


def round_half_up(number: Column, digits: int = 2) -> Column:
    """Round on the decimal notation of a double, halves away from zero."""
    return F.round(number.cast("double"), digits)


def truncate(number: Column, digits: int = 2) -> Column:
    """Cut a double off toward zero on its decimal notation.

    Where rounding went away from zero, step back by one unit of the last digit. The step
    is taken in decimal, as a double can be too coarse for it.
    """
    number = number.cast("double")
    rounded = F.round(number, digits)
    unit = Decimal(1).scaleb(-digits)
    step = F.when(number > 0, F.lit(unit)).otherwise(F.lit(-unit))
    stepped_back = (rounded.cast(T.DecimalType(37, digits)) - step).cast("double")
    return F.when(F.abs(rounded) > F.abs(number), stepped_back).otherwise(rounded)


def trim(text: Column) -> Column:
    """Take all leading and trailing control characters and spaces off."""
    return F.btrim(text, F.lit(TRIMMED))


def trim_array(texts: Column) -> Column:
    return F.transform(texts, trim)


def trim_row(df: DataFrame) -> DataFrame:
    """Every column as a trimmed string; NULL stays NULL."""
    return df.select(*[trim(df[f"`{name}`"].cast("string")).alias(name) for name in df.columns])


def first_or_default(items: Column, default) -> Column:
    """The first element, also if it is NULL; the default for an empty or NULL array."""
    return F.when(F.size(items) > 0, F.get(items, F.lit(0))).otherwise(F.lit(default))


def first_rounded_or_default(numbers: Column, default) -> Column:
    """As ``first_or_default``; the element is rounded to 2 digits, the default is not."""
    return F.when(F.size(numbers) > 0, round_half_up(F.get(numbers, F.lit(0)))).otherwise(F.lit(default))
