"""Latest row, top rows and most frequent value per key.

All three are `row_number() <= n` under a filter. Catalyst turns that into a group limit
that runs before the exchange, so a key holding a third of the rows sends at most n rows
per map task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions.times import to_ts
from ledgerlake.operators.conform import first_present
from ledgerlake.session import cut_lineage

_RANK = "_rank"
# repeated keys that are sent to all tasks; with more of them all rows are exchanged instead
MOST_REPEATED = 100_000


def newest_first(df: DataFrame, names: Sequence[str]) -> list[Column]:
    return [F.col(name).desc_nulls_last() for name in names if name in df.columns]


def top_n_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    ranked = df.withColumn(_RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(_RANK) <= n).drop(_RANK)


def latest_by(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], ties: Sequence[str] = ()
) -> DataFrame:
    """One row per key: the one with the highest order columns, nulls last, then ties.

    What is still equal is decided by a hash over the whole row, so the answer does not
    depend on how the rows are partitioned.
    """
    columns = [o if isinstance(o, Column) else F.col(o).desc_nulls_last() for o in order]
    columns += newest_first(df, ties)
    return top_n_by(df, keys, [*columns, row_hash(df)], 1)


def latest_of_few(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    ties: Sequence[str] = (),
    keep: Callable[[DataFrame, str], DataFrame] = cut_lineage,
) -> DataFrame:
    """`latest_by` for rows of which few share a key, as in a table's snapshot; keys are not null.

    The repeated keys are found on the keys alone and stored by `keep`, so their size is known. While
    they are few, only their rows are exchanged, and all others stay where they were read. Where
    they are many, a row of them stands for more than one and all rows are reduced by task.
    """
    held = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    repeated = keep(held.where("_n > 1").select(*keys), "repeated")
    if repeated.count() > MOST_REPEATED:
        return latest_by(df, keys, order, ties)
    known = F.broadcast(repeated)
    newest = latest_by(df.join(known, list(keys), "left_semi").select(df.columns), keys, order, ties)
    return df.join(known, list(keys), "left_anti").select(df.columns).unionByName(newest)


@dataclass(frozen=True)
class Groups:
    """Loads or writes by how many of their rows are the newest of their key; those without one are left out."""

    whole: tuple  # only newest rows
    few_old: tuple  # few others
    few_new: tuple  # few newest ones
    many: tuple  # neither is few

    @staticmethod
    def of(sums: Sequence[Row], group: str) -> Groups:
        """From rows of `group`, `n` and, of those, `won`; what is few is so for all groups together."""
        kinds: dict[str, list] = {"whole": [], "few_old": [], "few_new": [], "many": []}
        left = MOST_REPEATED
        for row in sorted(sums, key=lambda row: min(row["won"], row["n"] - row["won"])):
            old, new = row["n"] - row["won"], row["won"]
            if not new:
                continue
            left -= min(old, new)
            kind = "whole" if not old else "many" if left < 0 else "few_old" if old <= new else "few_new"
            kinds[kind].append(row[group])
        return Groups(*(tuple(kinds[k]) for k in ("whole", "few_old", "few_new", "many")))

    @property
    def live(self) -> tuple:
        return self.whole + self.few_old + self.few_new + self.many

    def marked(self, group: str, won: str) -> Column:
        """The rows of the decision that `newest` needs: the fewer ones of each group."""
        old = among(group, self.few_old) & ~F.col(won)
        return old | (among(group, self.few_new) & F.col(won))

    def newest(
        self, pick: Callable[[tuple], DataFrame], marks: DataFrame | None, keys: Sequence[str], group: str, won: str
    ) -> DataFrame:
        """The newest rows where no group has many of both kinds: none of them is exchanged."""
        frames = [pick(self.whole)] if self.whole else []
        for some, how, wanted in ((self.few_old, "left_anti", False), (self.few_new, "left_semi", True)):
            if some:
                rows = pick(some)
                named = [F.col(name).alias(f"_mark{i}") for i, name in enumerate((*keys, group))]
                known = marks.where(F.col(won) == wanted).select(named)
                same = [rows[name].eqNullSafe(known[f"_mark{i}"]) for i, name in enumerate((*keys, group))]
                frames.append(rows.join(F.broadcast(known), same, how))
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def among(name: str, values: Sequence) -> Column:
    """Whether a column has one of the values, of which None is one; never null."""
    found = F.coalesce(F.col(name).isin([v for v in values if v is not None]), F.lit(False))
    return found | F.col(name).isNull() if None in values else found


def latest_of_loads(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], ties: Sequence[str] = (), load: str = "load_date"
) -> DataFrame:
    """`latest_by` over all loads of a snapshot, `order` beginning with the later load.

    Which loads hold a key is found on the keys alone. A load whose rows have all been loaded
    again is left out, and one that holds only newest rows stays where it was read, as in
    `latest_of_few`. So does one with few other rows, or with few newest ones, which are sent
    to all tasks. Where a load has many of both, the rows of the loads that still count move.
    """
    won, n = "_won", "_n"
    held = df.groupBy(*keys, load).agg(F.count(F.lit(1)).alias(n))
    later = Window.partitionBy(*keys).orderBy(F.col(load).desc_nulls_last())
    decided = held.withColumn(won, F.row_number().over(later) == 1)
    again = F.col(won) & (F.col(n) > 1)
    sums = decided.groupBy(load).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(won).alias("won"), F.count_if(again).alias("again")
    ).collect()
    groups, repeated = Groups.of(sums, load), sum(row["again"] for row in sums)
    if not groups.live or groups.many or repeated > MOST_REPEATED:
        return latest_by(df.where(among(load, groups.live)), keys, order, ties)
    marks = None
    if groups.few_old or groups.few_new or repeated:
        marks = cut_lineage(decided.where(groups.marked(load, won) | again), "marks")
    newest = groups.newest(lambda some: df.where(among(load, some)), marks, keys, load, won)
    if not repeated:
        return newest
    known = F.broadcast(marks.where(again).select(*keys))
    one = latest_by(newest.join(known, list(keys), "left_semi").select(df.columns), keys, order, ties)
    return newest.join(known, list(keys), "left_anti").select(df.columns).unionByName(one)


def row_hash(df: DataFrame) -> Column:
    """A number from all columns of a row; maps, which have no order, by their JSON."""
    return F.xxhash64(
        *[F.to_json(F.struct(f.name)) if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`") for f in df.schema.fields]
    )


def event_order(df: DataFrame, candidates: Sequence[str]) -> list[Column]:
    """Newest first by the first time column present, parsed: `T` and blank forms mix."""
    name = first_present(df, tuple(candidates))
    if name is None:
        return []
    kind = df.schema[name].dataType
    value = F.col(name)
    if isinstance(kind, T.StringType):
        value = to_ts(value, kind)
    return [value.desc_nulls_last()]


def dedup_events(
    df: DataFrame, keys: Sequence[str], candidates: Sequence[str], ties: Sequence[str] = ()
) -> DataFrame:
    """Latest event per key; where no time column exists, the same one every time."""
    return latest_by(df, keys, event_order(df, candidates), ties)


def mode_by(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Most frequent value per key, the smaller value on a tie."""
    counts = value_counts(df, key, value, "_count")
    best = top_n_by(counts, [key], [F.desc("_count"), F.asc_nulls_last(value)], 1)
    return best.select(key, F.col(value).alias(name))


def value_counts(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    return df.groupBy(key, value).agg(F.count(value).alias(name))
