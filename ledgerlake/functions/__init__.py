"""Built-in expressions only: nothing here leaves the JVM."""

from ledgerlake.functions.frames import fill_strings, hash_number, hash_sample, nested_to_json
from ledgerlake.functions.text import (
    card_status,
    clean_currency,
    clean_cvv,
    clean_merchant_zip,
    clean_zip,
    empty_to_null,
    hash_pii,
    is_yes,
    make_email,
    mask_card,
    null_if,
    pad_left,
    payment_description,
    record_id,
    strip_decimal,
)
from ledgerlake.functions.times import archive_day, compose_ts, minus_minutes, month_year, to_ts

__all__ = [
    "archive_day", "card_status", "clean_currency", "clean_cvv", "clean_merchant_zip",
    "clean_zip", "compose_ts", "empty_to_null", "fill_strings", "hash_number", "hash_pii",
    "hash_sample", "is_yes", "make_email", "mask_card", "minus_minutes", "month_year",
    "nested_to_json", "null_if", "pad_left", "payment_description", "record_id",
    "strip_decimal", "to_ts",
]
