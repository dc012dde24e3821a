"""Column -> Column cleaning of text, money, identifiers and personal data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Postal codes that mean "unknown" after padding.
UNKNOWN_ZIPS = ("", "nan", "00nan", "00000")
# Characters that money text carries besides the number.
MONEY_NOISE = "$, \t\r\n"
# a plain decimal number, with an exponent at most: not `nan`, `Infinity` or `12d`
MONEY_FORM = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
VISIBLE_DIGITS = 4
MASK = "***"
DESCRIPTION_LENGTH = 255


def clean_currency(value: Column, default: float | None = None) -> Column:
    """`$1,234.50` as a double; text that is no number becomes `default`."""
    text = F.translate(value, MONEY_NOISE, "")
    number = F.when(text.rlike(MONEY_FORM), text.try_cast("double"))
    return number if default is None else F.coalesce(number, F.lit(default))


def strip_decimal(value: Column) -> Column:
    """Drop the `.0` that a float-typed file adds to a code."""
    code = F.trim(value)
    return F.when(code.endswith(".0"), F.left(code, F.length(code) - 2)).otherwise(code)


def pad_left(value: Column, width: int) -> Column:
    """Zero-pad to `width`; longer text stays whole, unlike a bare lpad."""
    return F.when(F.length(value) < width, F.lpad(value, width, "0")).otherwise(value)


def null_if(value: Column, *sentinels: str) -> Column:
    return F.when(~value.isin(*sentinels), value)


def clean_zip(value: Column, width: int = 5) -> Column:
    return pad_left(strip_decimal(value), width)


def clean_merchant_zip(value: Column) -> Column:
    """Pad first, then drop the codes that stand for a missing one."""
    return null_if(clean_zip(F.coalesce(value, F.lit(""))), *UNKNOWN_ZIPS)


def clean_cvv(value: Column) -> Column:
    return clean_zip(value, 3)


def empty_to_null(value: Column) -> Column:
    return null_if(F.trim(value), "", "nan")


def make_email(name: Column, customer_id: Column) -> Column:
    local = F.replace(F.replace(F.lower(F.trim(name)), F.lit(" "), F.lit(".")), F.lit("'"), F.lit(""))
    return F.concat(local, F.lit("."), customer_id.cast("string"), F.lit("@example.com"))


def mask_card(number: Column) -> Column:
    return F.concat(F.lit(MASK), F.right(number, F.lit(VISIBLE_DIGITS)))


def hash_pii(value: Column) -> Column:
    return F.sha2(value.cast("string"), 256)


def is_yes(flag: Column) -> Column:
    return F.lower(F.trim(flag)) == "yes"


def card_status(on_dark_web: Column) -> Column:
    return F.when(is_yes(on_dark_web), "blocked").otherwise("active")


def payment_description(merchant: Column) -> Column:
    return F.left(F.concat(F.lit("Payment to "), merchant), F.lit(DESCRIPTION_LENGTH))


def record_id(*parts: Column) -> Column:
    return F.concat_ws("_", *[part.cast("string") for part in parts])
