"""Gold tables kept in step with Silver without being rebuilt.

Every Gold write notes the Silver writes it was built from. The next run compares: Silver
writes since then name the changed keys, and from their old and new rows follow the Gold
keys that can differ, customers for the summary and transactions for the fraud view. Only
their inputs are read through, the same plan as in a rebuild runs on them, and their Gold
rows replace the old ones as a group. Work follows the changes; the fact table is scanned
for the touched keys but only touched rows are shuffled.

Where the note is missing, or vacuum has removed a Silver write that it builds on, the table
is rebuilt whole.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.plans import gold
from ledgerlake.schemas import SILVER
from ledgerlake.session import cut_lineage
from ledgerlake.sources.tables import (
    folded,
    last_note,
    read_parts,
    read_table,
    renote,
    replace_all_groups,
    replace_groups,
    versions,
)
from ledgerlake.streaming.changes import VERSION

_NAMES = {
    "customers": "silver_postgres_customers",
    "cards": "silver_postgres_cards",
    "transactions": "silver_postgres_transactions",
    "logins": "silver_mongo_login_events",
    "devices": "silver_mongo_device_events",
    "fraud": "silver_mongo_fraud_events",
    "notices": "silver_mongo_notification_logs",
}
GROUPS = {"gold_user_behavior_summary": "customer_id", "gold_fraud_analysis": "transaction_id"}
INPUTS = {
    "gold_user_behavior_summary": ("customers", "cards", "transactions", "logins", "devices"),
    "gold_fraud_analysis": ("customers", "cards", "transactions", "fraud", "notices"),
}


@dataclass(frozen=True)
class Step:
    """What a run did with a Gold table: rows written, keys touched, None for a whole rebuild."""

    rows: int
    touched: int | None


class Source:
    """One Silver table: its present state, and what has changed since some of its writes."""

    def __init__(self, spark: SparkSession, silver: str, name: str):
        self.spark, self.table = spark, SILVER[_NAMES[name]]
        self.path = f"{silver}/{self.table.name}"
        self.found = versions(spark, self.path)

    @property
    def names(self) -> list[str]:
        return [v.name for v in self.found]

    def now(self) -> DataFrame:
        """Current rows; the writes are those listed when this object was made."""
        return self._read(self.names)

    def _read(self, names: Sequence[str]) -> DataFrame:
        df = read_table(self.spark, self.path, self.table.keys, VERSION, within=set(names))
        return df.select([c for c in self.table.schema.names if c in df.columns])

    def reachable(self, before: Sequence[str]) -> bool:
        """Whether the state of those writes and all writes since then can still be read."""
        old, there = set(before), set(self.names)
        for v in self.found:
            # a fold of something that is neither known from before nor there any more
            if v.full and v.name not in old and folded(self.spark, v) - old - there:
                return False
        base = max((v for v in self.found if v.full and v.name in old), key=lambda v: v.name, default=None)
        newest = max((n for n in old if "-full-" in n), default=None)
        if newest is not None and (base is None or base.name != newest):
            return False
        return bool(old) and old - there <= (folded(self.spark, base) if base else set())

    def touched(self, before: Sequence[str], columns: Sequence[str]) -> DataFrame | None:
        """Old and new values of `columns` in changed rows; None where nothing was written."""
        new = [v for v in self.found if v.name not in set(before) and not v.full]
        if not new:
            return None
        written = read_parts(self.spark, new)
        keys = list(self.table.keys)
        old = self._read(before).join(written.select(*keys).distinct(), keys, "left_semi")
        return written.select(*columns).unionByName(old.select(*columns)).distinct()


def _keys(frames: Sequence[DataFrame | None], name: str) -> DataFrame | None:
    """One column of distinct keys out of those of several frames."""
    some = [f.select(F.col(f.columns[0]).alias(name)) for f in frames if f is not None]
    return reduce(lambda a, b: a.unionByName(b), some).where(F.col(name).isNotNull()).distinct() if some else None


def _of(df: DataFrame, keys: DataFrame, own: str) -> DataFrame:
    """Rows whose `own` column is among the keys."""
    return df.join(keys.select(F.col(keys.columns[0]).alias(own)), own, "left_semi").select(df.columns)


def touched_customers(sources: Mapping[str, Source], before: Mapping[str, Sequence[str]]) -> DataFrame | None:
    """Customers whose summary can differ."""
    cards = sources["cards"].now().select("id", "customer_id")
    moved = sources["transactions"].touched(before["transactions"], ["card_id"])
    owners = None if moved is None else _of(cards, moved, "id").select("customer_id")
    return _keys(
        [
            sources["customers"].touched(before["customers"], ["id"]),
            sources["cards"].touched(before["cards"], ["customer_id"]),
            owners,
            sources["logins"].touched(before["logins"], ["user_id"]),
            sources["devices"].touched(before["devices"], ["user_id"]),
        ],
        "customer_id",
    )


def summary_of(sources: Mapping[str, Source], customers: DataFrame) -> DataFrame:
    """The summary rows of some customers, from their own inputs."""
    cards = _of(sources["cards"].now(), customers, "customer_id")
    own_cards = cards.select("id")
    return gold.user_behavior_summary(
        _of(sources["transactions"].now(), own_cards, "card_id"),
        cards,
        _of(sources["customers"].now(), customers, "id"),
        _of(sources["logins"].now(), customers, "user_id"),
        _of(sources["devices"].now(), customers, "user_id"),
    )


def touched_transactions(sources: Mapping[str, Source], before: Mapping[str, Sequence[str]]) -> DataFrame | None:
    """Transactions whose rows in the fraud view can differ."""
    people = _keys(
        [
            sources["customers"].touched(before["customers"], ["id"]),
            sources["notices"].touched(before["notices"], ["customer_id"]),
        ],
        "customer_id",
    )
    theirs = None if people is None else _of(sources["cards"].now().select("id", "customer_id"), people, "customer_id").select("id")
    cards = _keys([sources["cards"].touched(before["cards"], ["id"]), theirs], "card_id")
    spent = None if cards is None else _of(sources["transactions"].now().select("id", "card_id"), cards, "card_id").select("id")
    return _keys(
        [
            sources["transactions"].touched(before["transactions"], ["id"]),
            sources["fraud"].touched(before["fraud"], ["transaction_id"]),
            spent,
        ],
        "transaction_id",
    )


def fraud_of(sources: Mapping[str, Source], transactions: DataFrame) -> DataFrame:
    """The fraud view's rows of some transactions, with only the context they need."""
    rows = _of(sources["transactions"].now(), transactions, "id")
    cards = _of(sources["cards"].now(), rows.select("card_id").distinct(), "id")
    holders = cards.select("customer_id").distinct()
    return gold.fraud_analysis(
        rows,
        cards,
        _of(sources["customers"].now(), holders, "id"),
        _of(sources["fraud"].now(), transactions, "transaction_id"),
        _of(sources["notices"].now(), holders, "customer_id"),
    )


def rebuilt(name: str, sources: Mapping[str, Source]) -> DataFrame:
    state = {n: s.now() for n, s in sources.items()}
    if name == "gold_user_behavior_summary":
        return gold.user_behavior_summary(*(state[n] for n in ("transactions", "cards", "customers", "logins", "devices")))
    return gold.fraud_analysis(*(state[n] for n in ("transactions", "cards", "customers", "fraud", "notices")))


_TOUCHED: dict[str, Callable] = {"gold_user_behavior_summary": touched_customers, "gold_fraud_analysis": touched_transactions}
_ROWS: dict[str, Callable] = {"gold_user_behavior_summary": summary_of, "gold_fraud_analysis": fraud_of}


def bring_up(
    spark: SparkSession, silver: str, path: str, name: str, layout: Callable[[DataFrame], DataFrame] = lambda df: df
) -> Step:
    """Bring one Gold table to the present state of Silver; `layout` orders a whole rebuild."""
    sources = {n: Source(spark, silver, n) for n in INPUTS[name]}
    note = json.dumps({n: s.names for n, s in sources.items()})
    before = json.loads(last_note(spark, path) or "null")
    if before is None or not all(s.reachable(before.get(n, [])) for n, s in sources.items()):
        return Step(replace_all_groups(layout(rebuilt(name, sources)), path, note).rows, None)
    found = _TOUCHED[name](sources, before)
    if found is None:  # at most folded since then
        renote(spark, path, note)
        return Step(0, 0)
    touched = cut_lineage(found, "touched")
    n = touched.count()
    written = replace_groups(_ROWS[name](sources, touched), touched, path, [GROUPS[name]], note)
    return Step(written.rows - n, n)
