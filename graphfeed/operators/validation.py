"""Checks of the signup and account forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIGNUP_FIELDS = ["username", "password", "firstname", "surname", "email", "day", "month", "year",
                 "affiliation"]
MIN_INTERESTS = 2


def _empty(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit("")) == ""


def checked_signups(forms: DataFrame) -> DataFrame:
    """Adds ``reason``: null if the form is accepted, else what is wrong first."""
    reason = F.lit(None).cast("string")
    too_few = F.coalesce(F.size("interests"), F.lit(0)) < MIN_INTERESTS
    reason = F.when(too_few, F.lit("interests")).otherwise(reason)
    for field in reversed(SIGNUP_FIELDS):
        reason = F.when(_empty(field), F.lit(field)).otherwise(reason)
    return forms.withColumn("reason", reason)


def validate_signups(forms: DataFrame) -> tuple[DataFrame, DataFrame]:
    checked = checked_signups(forms)
    good = checked.filter(F.col("reason").isNull()).drop("reason")
    return good, checked.filter(F.col("reason").isNotNull())


def checked_account_updates(forms: DataFrame) -> DataFrame:
    """Email and affiliation are required, passwords come both or not at all, and interests,
    if given, are at least two."""
    old, new = _empty("old_password"), _empty("new_password")
    few = F.col("interests").isNotNull() & (F.size("interests") < MIN_INTERESTS)
    reason = (
        F.when(_empty("email") | _empty("affiliation"), F.lit("email or affiliation"))
        .when(old != new, F.lit("passwords"))
        .when(few, F.lit("interests"))
    )
    return forms.withColumn("reason", reason)


def validate_account_updates(forms: DataFrame) -> tuple[DataFrame, DataFrame]:
    checked = checked_account_updates(forms)
    good = checked.filter(F.col("reason").isNull()).drop("reason")
    return good, checked.filter(F.col("reason").isNotNull())
