"""Text cleaning and the name and e-mail columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def proper_case(text: Column) -> Column:
    return F.initcap(F.trim(text))


def clean_lower(text: Column) -> Column:
    return F.lower(F.trim(text))


def clean_upper(text: Column) -> Column:
    return F.upper(F.trim(text))


def full_name(first: Column, last: Column) -> Column:
    return F.concat_ws(" ", first, last)


def email_address(first: Column, last: Column, number: Column, domain: str = "email.com") -> Column:
    """`first.lastN@domain`, the number keeping namesakes apart."""
    return F.lower(F.concat(first, F.lit("."), last, number.cast("string"), F.lit(f"@{domain}")))
