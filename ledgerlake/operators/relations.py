"""Rules over whole relations: repeated keys and missing parents, row by row, and their quarantine.

A rule on rows is a predicate; these need other rows. Keys are aggregated first, by task, so
a key that a third of all rows share arrives as one row per task, and only keys that break a
rule are joined back. Both joins have the checked rows on their left side, where adaptive
execution splits a hot key. The labelled rows are stored once, in one folder for each
verdict, and the parts are read from there: neither side scans its input again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.latest import row_hash
from ledgerlake.operators.quality import Rules, with_reasons
from ledgerlake.session import cut_lineage, new_folder

REASONS = "reasons"
COPIES = "copies"
_VERDICT = "_verdict"
GOOD, BAD, CONTESTED = "good", "bad", "contested"


@dataclass(frozen=True)
class Unique:
    """No two rows may agree on `keys`; a key with a null in it agrees with none.

    With `keep`, columns of which the highest is newest, the newest row of a repeated key
    stays and the others break the rule; without, nothing tells which one is right, and all
    of them break it.
    """

    keys: tuple[str, ...]
    keep: tuple[str, ...] | None = None

    @property
    def label(self) -> str:
        return f"{', '.join(self.keys)} repeats"


@dataclass(frozen=True)
class Reference:
    """`key` has to be one of `parent_key`; a null refers to nothing and breaks no rule."""

    key: str
    parent: DataFrame | str  # rows, or the name of a table that the caller looks up
    parent_key: str = "id"

    @property
    def label(self) -> str:
        return f"{self.key} is unknown"


@dataclass(frozen=True)
class Constraints:
    """All that a table has to keep: predicates on rows, unique keys, references."""

    rows: Rules | None = None
    unique: tuple[Unique, ...] = ()
    references: tuple[Reference, ...] = ()


@dataclass(frozen=True)
class Quarantine:
    """Rows that keep all rules, and the others with `reasons` and the number of `copies`."""

    good: DataFrame
    bad: DataFrame

    def summary(self) -> DataFrame:
        """Rows that break each rule: rule, failed."""
        broken = self.bad.select(F.explode(REASONS).alias("rule"), COPIES)
        return broken.groupBy("rule").agg(F.sum(COPIES).alias("failed"))


def repeated_keys(df: DataFrame, rule: Unique) -> DataFrame:
    """Keys held by several rows, and the order of the row that stays (null if none does)."""
    whole = df.dropna(subset=list(rule.keys))
    newest = F.max(_rank(df, rule)) if rule.keep is not None else F.lit(None).cast("boolean")
    held = whole.groupBy(*rule.keys).agg(F.count(F.lit(1)).alias("_n"), newest.alias("_newest"))
    return held.where("_n > 1").drop("_n")


def missing_keys(df: DataFrame, rule: Reference) -> DataFrame:
    """Keys that refer to something which the parent does not have."""
    known = rule.parent.select(F.col(rule.parent_key).alias(rule.key)).distinct()
    return df.select(rule.key).dropna().distinct().join(known, rule.key, "left_anti")


def _rank(df: DataFrame, rule: Unique) -> Column:
    """Total up to identical rows, so that the choice does not depend on partitions."""
    return F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(rule.keep or ())], row_hash(df).alias("h"))


def labelled(df: DataFrame, constraints: Constraints) -> DataFrame:
    """Every row with its reasons and, where it is the newest of a repeated key, `_contested`.

    The keys that break a rule are stored first. So their size is known, and where they are
    few, as they should be, they go to the rows instead of all rows moving once for each rule.
    `df` is read several times, by the columns a rule needs: a view that is dear to evaluate
    is better stored before.
    """
    names = df.columns
    own = with_reasons(df, constraints.rows or {}, REASONS)
    out = own.withColumn("_contested", F.array().cast("array<string>"))
    for i, rule in enumerate(constraints.unique):
        again = cut_lineage(repeated_keys(df, rule), "repeated").select(
            *[F.col(k).alias(f"_u{i}_{j}") for j, k in enumerate(rule.keys)],
            F.col("_newest").alias(f"_u{i}_newest"),
            F.lit(True).alias(f"_u{i}"),
        )
        same = [F.col(k) == F.col(f"_u{i}_{j}") for j, k in enumerate(rule.keys)]
        stays = F.lit(False) if rule.keep is None else _rank(df, rule) == F.col(f"_u{i}_newest")
        broken, first = F.col(f"_u{i}") & ~stays, F.col(f"_u{i}") & stays
        out = out.join(again, same, "left").select(
            *names,
            _more(REASONS, broken, rule.label),
            _more("_contested", first, rule.label),
        )
    for i, rule in enumerate(constraints.references):
        lost = cut_lineage(missing_keys(df, rule), "missing")
        broken = F.col(f"_r{i}").isNotNull()
        out = out.join(lost.withColumnRenamed(rule.key, f"_r{i}"), F.col(rule.key) == F.col(f"_r{i}"), "left").select(
            *names, _more(REASONS, broken, rule.label), "_contested"
        )
    return out


def _more(name: str, where: Column, label: str) -> Column:
    return F.when(F.coalesce(where, F.lit(False)), F.array_append(name, F.lit(label))).otherwise(F.col(name)).alias(name)


def quarantine(df: DataFrame, constraints: Constraints, folder: str | None = None) -> Quarantine:
    """Split a relation by its rules; every row is on exactly one side, counted by `copies`.

    Rows that are identical in all columns cannot be told apart: of such copies of a newest
    row one stays, and the others are one refused row with their number, however many.
    """
    spark = df.sparkSession
    names = df.columns
    verdict = F.when(F.size(REASONS) > 0, BAD).when(F.size("_contested") > 0, CONTESTED).otherwise(GOOD)
    path = folder or new_folder(spark, "quarantine")
    judged = labelled(df, constraints).withColumn(_VERDICT, verdict)
    judged.write.partitionBy(_VERDICT).parquet(path)
    schema = spark.createDataFrame([], judged.schema).schema

    def part(name: str) -> DataFrame:
        return spark.read.schema(schema).parquet(path).where(F.col(_VERDICT) == name).drop(_VERDICT)

    # only rows of repeated keys come here, copies added up by task
    single = part(CONTESTED).groupBy(*names, "_contested").agg(F.count(F.lit(1)).alias("_n"))
    good = part(GOOD).select(names).unionByName(single.select(names))
    copies = single.where("_n > 1").select(*names, F.col("_contested").alias(REASONS), (F.col("_n") - 1).alias(COPIES))
    bad = part(BAD).select(*names, REASONS, F.lit(1).cast("long").alias(COPIES)).unionByName(copies)
    return Quarantine(good, bad)


def quarantine_all(
    tables: Mapping[str, DataFrame], constraints: Mapping[str, Constraints], order: Sequence[str] = ()
) -> dict[str, Quarantine]:
    """Split several tables, parents first; references by table name mean the parent's good rows.

    So a card of a refused customer is an orphan, and so are its transactions.
    """
    done: dict[str, Quarantine] = {}
    waiting = [n for n in (order or constraints) if n in constraints]
    while waiting:
        ready = [n for n in waiting if not _parents(constraints[n]) & (set(waiting) - {n})]
        if not ready:
            raise ValueError(f"references go in a circle: {waiting}")
        for name in ready:
            own = constraints[name]
            found = tuple(
                Reference(r.key, _good(r.parent, done, tables) if isinstance(r.parent, str) else r.parent, r.parent_key)
                for r in own.references
            )
            done[name] = quarantine(tables[name], Constraints(own.rows, own.unique, found))
            waiting.remove(name)
    return done


def _parents(constraints: Constraints) -> set[str]:
    return {r.parent for r in constraints.references if isinstance(r.parent, str)}


def _good(name: str, done: Mapping[str, Quarantine], tables: Mapping[str, DataFrame]) -> DataFrame:
    return done[name].good if name in done else tables[name]
