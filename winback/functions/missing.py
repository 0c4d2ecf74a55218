"""Missing values: text tokens and NaN become null once, on the way in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text read as "missing" in a CSV field.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def known_text(column: Column) -> Column:
    """The text, or null when it is one of the missing tokens."""
    return F.when(~column.isin(MISSING_TOKENS), column)


#: what counts as a number, and as a moment; Spark's casts alone would take 1.5d, a lone year, and drop the offset of a zone
NUMBER = r"(?i)^[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?$|^[+-]?inf(inity)?$"
MOMENT = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}:\d{2}(\.\d{1,9})?)?$"


def known_number(column: Column) -> Column:
    """A double, or null for text that is no number."""
    text = F.trim(column)
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def safe_timestamp(column: Column) -> Column:
    """A zone-less timestamp from a date with or without a time; null for any other text."""
    text = F.trim(column)
    return F.when(text.rlike(MOMENT), text.try_cast("timestamp_ntz"))


def ratio(total: Column, count: Column) -> Column:
    """``total / count`` as double, null when nothing was counted."""
    return F.try_divide(total.cast("double"), count.cast("double"))
