"""Bronze rows to Silver rows: latest per key, fixed schema."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame

from ledgerlake.operators.conform import conform
from ledgerlake.operators.latest import event_order, latest_by, newest_first
from ledgerlake.operators.quality import Rules, apply_pii_policy, check, not_null
from ledgerlake.schemas import SILVER, Table

Newest = Callable[..., DataFrame]
META = ("load_date", "_deleted", "offset", "ts_ms")


def refine(df: DataFrame, table: Table, keep: tuple[str, ...] = (), newest: Newest = latest_by) -> DataFrame:
    """Deduplicate and conform one source; the same rules for snapshots and streams.

    The later load wins, as it does where days are loaded one by one: a correction may move
    an event's time back. Within a load the later event wins. `newest` says how the latest
    row of a key is found.
    """
    loaded = newest_first(df, ("load_date",))
    latest = newest(df, table.keys, [*loaded, *event_order(df, table.order)])
    return conform(latest, table.schema, table.renames, keep)


def settle(
    df: DataFrame, keys: Sequence[str], rules: Rules | None = None, policy: Mapping[str, str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(rows to merge, refused rows with their reasons), both under the personal-data policy."""
    good, bad = check(df, {**not_null(*keys), **(rules or {})})
    return apply_pii_policy(good, policy or {}), apply_pii_policy(bad, policy or {})


def customers(df: DataFrame) -> DataFrame:
    return refine(df, SILVER["silver_postgres_customers"])


def cards(df: DataFrame) -> DataFrame:
    return refine(df, SILVER["silver_postgres_cards"])


def transactions(df: DataFrame) -> DataFrame:
    return refine(df, SILVER["silver_postgres_transactions"])


def events(df: DataFrame, name: str) -> DataFrame:
    """One of login_events, device_events, fraud_events, notification_logs, audit_logs."""
    return refine(df, SILVER[f"silver_mongo_{name}"])
