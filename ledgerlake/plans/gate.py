"""The quality gate between Silver and Gold: what each table has to keep, and what is set aside."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.quality import apply_pii_policy, not_null
from ledgerlake.operators.relations import Constraints, Quarantine, Reference, Unique, quarantine_all
from ledgerlake.sinks.writers import write_dead_letters

# The keys, required columns and references that the source tables declare.
CUSTOMERS, CARDS, TRANSACTIONS = (f"silver_postgres_{name}" for name in ("customers", "cards", "transactions"))


def declared() -> dict[str, Constraints]:
    """The constraints of the source tables, which a copy of their rows no longer enforces."""
    return {
        CUSTOMERS: Constraints(not_null("id", "name", "email"), (Unique(("id",)), Unique(("email",)))),
        CARDS: Constraints(
            not_null("id", "customer_id", "card_index", "card_number"),
            (Unique(("id",)), Unique(("card_number",)), Unique(("customer_id", "card_index"))),
            (Reference("customer_id", CUSTOMERS),),
        ),
        TRANSACTIONS: Constraints(
            {**not_null("id", "card_id", "amount", "transaction_date"), "amount is negative": F.col("amount") >= 0},
            (Unique(("id",), keep=("transaction_date",)),),
            (Reference("card_id", CARDS),),
        ),
    }


def gate(
    tables: Mapping[str, DataFrame],
    constraints: Mapping[str, Constraints],
    dead_letters: str,
    pii: Mapping[str, Mapping[str, str]] | None = None,
) -> dict[str, Quarantine]:
    """Split the tables that have constraints and write what they refuse under `<table>/relations`.

    The letters replace those of the last run: each run judges the whole of Silver.
    """
    split = quarantine_all({n: tables[n] for n in constraints}, constraints)
    for name, parts in split.items():
        policy = {k: v for k, v in (pii or {}).get(name, {}).items() if k in parts.bad.columns}
        write_dead_letters(apply_pii_policy(parts.bad, policy), f"{dead_letters}/{name}/relations", mode="overwrite")
    return split
