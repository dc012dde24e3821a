"""Raw customer, card and transaction files to clean rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.text import (
    clean_currency,
    clean_cvv,
    clean_merchant_zip,
    clean_zip,
    empty_to_null,
    make_email,
    payment_description,
    strip_decimal,
)
from ledgerlake.functions.times import compose_ts
from ledgerlake.operators.derive import with_card_status
from ledgerlake.operators.joins import lookup
from ledgerlake.operators.latest import latest_by, top_n_by
from ledgerlake.operators.ranking import sequential_id
from ledgerlake.schemas import CARDS, CUSTOMERS, TRANSACTIONS, struct
from ledgerlake.session import cut_lineage

# The columns of the raw transaction file, all read as text.
RAW = (
    "User", "Card", "Year", "Month", "Day", "Time", "Amount", "Use Chip", "Merchant Name",
    "Merchant City", "Merchant State", "Zip", "MCC", "Errors?", "Is Fraud?",
)
# Source columns of the Silver columns, by how each is read.
CUSTOMER_TEXT = {"name": "Person", "phone": "Phone", "gender": "Gender", "address": "Address", "city": "City", "state": "State"}
CUSTOMER_COUNTS = {
    "current_age": "Current Age", "retirement_age": "Retirement Age", "birth_year": "Birth Year",
    "birth_month": "Birth Month", "fico_score": "FICO Score", "num_credit_cards": "Num Credit Cards",
}
CUSTOMER_MONEY = {
    "per_capita_income_zipcode": "Per Capita Income - Zipcode", "yearly_income": "Yearly Income - Person",
    "total_debt": "Total Debt",
}
CARD_TEXT = {
    "card_brand": "Card Brand", "card_type": "Card Type", "card_number": "Card Number", "expires": "Expires",
    "has_chip": "Has Chip", "acct_open_date": "Acct Open Date", "card_on_dark_web": "Card on Dark Web",
}
NEWEST_PER_CUSTOMER = 150
# after the date, all other content: rows that still tie are equal
TIES = ("card_id", "amount", "merchant_name", "mcc", "zip", "use_chip", "errors", "is_fraud")
CARD_KEYS = struct("customer_id long, card_index long")


def tidy(raw: DataFrame) -> DataFrame:
    """Typed, cleaned columns of the raw file, still without card id."""
    def text(name: str):
        return F.col(f"`{name}`")

    missing = {name: F.lit(None).cast("string") for name in ("Zip", "Errors?") if name not in raw.columns}
    raw = raw.withColumns(missing) if missing else raw
    return raw.select(
        text("User").try_cast("long").alias("customer_id"),
        text("Card").try_cast("long").alias("card_index"),
        text("Year").try_cast("int").alias("year"),
        text("Month").try_cast("int").alias("month"),
        text("Day").try_cast("int").alias("day"),
        text("Time").alias("time"),
        clean_currency(text("Amount"), 0.0).alias("amount"),
        text("Use Chip").alias("use_chip"),
        text("Merchant Name").alias("merchant_name"),
        text("Merchant City").alias("merchant_city"),
        text("Merchant State").alias("merchant_state"),
        clean_merchant_zip(text("Zip")).alias("zip"),
        text("MCC").try_cast("int").alias("mcc"),
        empty_to_null(F.trim(text("Errors?"))).alias("errors"),
        text("Is Fraud?").alias("is_fraud"),
        compose_ts(text("Year"), text("Month"), text("Day"), text("Time")).alias("transaction_date"),
        payment_description(text("Merchant Name")).alias("description"),
    )


def _file_columns(raw: DataFrame):
    """A column of a file read as text; one the file lacks is null."""
    def text(name: str):
        return F.col(f"`{name}`") if name in raw.columns else F.lit(None).cast("string")

    return text


def tidy_customers(raw: DataFrame) -> DataFrame:
    """Customers of a raw file, one row for each `User`: the last one by all its content."""
    text = _file_columns(raw)
    ident = text("User").try_cast("long")
    made = {
        "id": ident,
        **{to: text(name) for to, name in CUSTOMER_TEXT.items()},
        **{to: text(name).try_cast("double").try_cast("int") for to, name in CUSTOMER_COUNTS.items()},
        **{to: clean_currency(text(name)) for to, name in CUSTOMER_MONEY.items()},
        "email": make_email(text("Person"), ident),
        "apartment": strip_decimal(text("Apartment")),
        "zipcode": clean_zip(text("Zipcode")),
        "latitude": text("Latitude").try_cast("double"),
        "longitude": text("Longitude").try_cast("double"),
        "created_at": F.lit(None).cast("timestamp"),
    }
    rows = raw.select([made[name].alias(name) for name in CUSTOMERS.names]).where("id is not null")
    return latest_by(rows, ["id"], [])


def tidy_cards(raw: DataFrame) -> DataFrame:
    """Cards of a raw file, one row for each customer and card index, with status and creation date.

    The id is left to the table: it is null here, and the composite key is what a merge uses.
    """
    text = _file_columns(raw)
    made = {
        "id": F.lit(None).cast("long"),
        "customer_id": text("User").try_cast("long"),
        "card_index": text("CARD INDEX").try_cast("long"),
        **{to: text(name) for to, name in CARD_TEXT.items()},
        "cvv": clean_cvv(text("CVV")),
        "cards_issued": text("Cards Issued").try_cast("double").try_cast("int"),
        "credit_limit": clean_currency(text("Credit Limit")),
        "year_pin_last_changed": text("Year PIN last Changed").try_cast("double").try_cast("int"),
    }
    columns = [name for name in CARDS.names if name in made]
    rows = raw.select([made[name].alias(name) for name in columns])
    rows = rows.where("customer_id is not null and card_index is not null")
    return with_card_status(latest_by(rows, list(CARD_KEYS.names), [])).select(CARDS.names)


def with_card(rows: DataFrame, cards: DataFrame) -> DataFrame:
    """Card id by (customer, card index); rows of unknown cards are dropped."""
    known = cards.select(F.col("id").alias("card_id"), *CARD_KEYS.names)
    return lookup(rows, known, CARD_KEYS.names)


def newest(rows: DataFrame, n: int) -> DataFrame:
    order = [F.col("transaction_date").desc_nulls_last(), *[F.desc_nulls_last(name) for name in TIES]]
    return top_n_by(rows, ["customer_id"], order, n)


def clean_transactions(raw: DataFrame, cards: DataFrame, n: int = NEWEST_PER_CUSTOMER) -> DataFrame:
    """The newest `n` transactions per customer with ids in (customer, time) order.

    Carries customer_id besides the Silver columns, as the derived events need it. Rows move
    without the description, which the merchant's name gives. They are stored before they are
    numbered, so that finding the ranges joins nothing again and what the join and the limit
    have exchanged is gone by then.
    """
    recent = cut_lineage(newest(with_card(tidy(raw).drop("description"), cards), n), "recent")
    numbered = sequential_id(recent, ["customer_id", "transaction_date", *TIES], "id")
    described = numbered.withColumn("description", payment_description(F.col("merchant_name")))
    return described.select("customer_id", *TRANSACTIONS.names)
