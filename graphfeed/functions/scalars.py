"""Small column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(value: Column, digits: int) -> Column:
    """Round half up, with the half itself moved a little.

    Fractions of small counts often end exactly in a 5 after the last kept digit, where the
    last bits of a float sum would decide the result.
    """
    scale = F.lit(float(10**digits))
    return F.floor(value * scale + F.lit(0.5001)) / scale


def chat_time(epoch_ms: Column) -> Column:
    """Time of day shown with a message, H:mm:ss in UTC."""
    seconds = F.floor(epoch_ms / 1000)
    hour = F.floor(seconds % 86_400 / 3600).cast("string")
    minute = F.lpad(F.floor(seconds % 3600 / 60).cast("string"), 2, "0")
    return F.concat_ws(":", hour, minute, F.lpad((seconds % 60).cast("string"), 2, "0"))


def shifted_year(date: Column, year: int) -> Column:
    """The same month and day in another year, as yyyy-MM-dd text."""
    return F.concat(F.lit(f"{year:04d}"), F.date_format(date, "-MM-dd"))


def split_shown_article(shown: Column, part: int) -> Column:
    """A field of the article line shown in recommendations, counted from 1."""
    return F.split_part(shown, F.lit(",:"), F.lit(part))
