"""Repeated keys and orphans against brute force; the gate in front of Gold."""

import random
from collections import Counter

import pytest
from helpers import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlake.operators.relations import Constraints, Reference, Unique, quarantine, quarantine_all
from ledgerlake.plans import gate

FEW = settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
SCHEMA = "id int, mail string, parent int, t int, x int"
SOME = st.lists(
    st.tuples(
        st.one_of(st.none(), st.integers(0, 4)), st.sampled_from(["a", "b", "c", None]),
        st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 2), st.integers(-1, 1),
    ),
    max_size=14,
)


def by_hand(data, parents, keep):
    """Reasons of every row; None for the rows of which one stays and the others are copies."""
    ids, mails = Counter(r[0] for r in data), Counter(r[1] for r in data)
    out = []
    for r in data:
        why = [] if r[4] >= 0 else ["x is negative"]
        newest = max((o[3] for o in data if o[0] == r[0]), default=None)
        again = r[0] is not None and ids[r[0]] > 1
        if again and (not keep or r[3] < newest):
            why.append("id repeats")
        if r[1] is not None and mails[r[1]] > 1:
            why.append("mail repeats")
        if r[2] is not None and r[2] not in parents:
            why.append("parent is unknown")
        out.append((r, why, again and keep and r[3] == newest))
    return out


@FEW
@given(data=SOME, parents=st.sets(st.integers(0, 3)))
def test_without_keep_every_row_of_a_repeated_key_goes(spark, data, parents):
    split = judged(spark, data, parents, None)
    expected = by_hand(data, parents, False)
    good = sorted((r for r, why, _ in expected if not why), key=repr)
    bad = sorted(((*r, tuple(why)) for r, why, _ in expected if why), key=repr)
    assert rows(split.good) == good
    assert sorted(((*r[:5], tuple(r.reasons)) for r in split.bad.collect()), key=repr) == bad
    broken = Counter(w for _, why, _ in expected for w in why)
    assert dict(rows(split.summary())) == broken


def judged(spark, data, parents, keep):
    df = spark.createDataFrame(data, SCHEMA)
    known = spark.createDataFrame([(p,) for p in [*parents, *parents]], "id int")
    constraints = Constraints(
        {"x is negative": F.col("x") >= 0},
        (Unique(("id",), keep), Unique(("mail",))),
        (Reference("parent", known),),
    )
    return quarantine(df, constraints)


@FEW
@given(data=SOME)
def test_with_keep_one_newest_row_stays_and_nothing_is_lost(spark, data):
    df = spark.createDataFrame([r for r in data if r[4] >= 0], SCHEMA)
    split = quarantine(df, Constraints(None, (Unique(("id",), ("t",)),)))
    good, bad = split.good.collect(), split.bad.collect()
    assert len(good) + sum(b.copies for b in bad) == df.count()
    keyed = [r for r in good if r.id is not None]
    assert len({r.id for r in keyed}) == len(keyed)
    best = {}
    for r in data:
        if r[4] >= 0 and r[0] is not None:
            best[r[0]] = max(best.get(r[0], -1), r[3])
    assert {r.id: r.t for r in keyed} == best
    assert Counter(tuple(r) for r in good) + Counter({tuple(b)[:5]: 0 for b in bad}) == Counter(tuple(r) for r in good)


def test_copies_of_the_newest_row_are_one_letter(spark):
    df = spark.createDataFrame([(1, "a", None, 5, 0)] * 4 + [(1, "b", None, 4, 0), (2, "c", None, 0, 0)], SCHEMA)
    split = quarantine(df, Constraints(None, (Unique(("id",), ("t",)),)))
    assert rows(split.good, "id", "t") == [(1, 5), (2, 0)]
    assert rows(split.bad, "id", "t", "copies") == [(1, 4, 1), (1, 5, 3)]


def test_no_rules_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a", None, 5, 0)], SCHEMA)
    assert quarantine(df, Constraints()).good.count() == 1
    empty = quarantine(df.where("false"), Constraints({"x": F.lit(True)}, (Unique(("id",)),)))
    assert empty.good.count() == empty.bad.count() == 0 and empty.good.columns == df.columns


def test_refusals_go_down_the_references(spark):
    tables = {
        "top": spark.createDataFrame([(1, True), (2, False)], "id int, fine boolean"),
        "middle": spark.createDataFrame([(10, 1), (20, 2)], "id int, top int"),
        "low": spark.createDataFrame([(100, 10), (200, 20), (300, None)], "id int, middle int"),
    }
    constraints = {
        "low": Constraints(references=(Reference("middle", "middle"),)),
        "middle": Constraints(references=(Reference("top", "top"),)),
        "top": Constraints({"not fine": F.col("fine")}),
    }
    split = quarantine_all(tables, constraints)
    assert {n: rows(s.good, "id") for n, s in split.items()} == {"top": [(1,)], "middle": [(10,)], "low": [(100,), (300,)]}
    assert rows(split["low"].summary()) == [("middle is unknown", 1)]
    with pytest.raises(ValueError, match="circle"):
        quarantine_all(tables, {"low": Constraints(references=(Reference("middle", "middle"),)),
                                "middle": Constraints(references=(Reference("id", "low"),))})


def test_a_hot_key_arrives_as_one_row_a_task(spark, many_tasks):
    """Keys are counted before they move, and only broken ones are joined back."""
    df = spark.range(0, 9000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("id"), F.col("id").alias("t")
    )
    split = quarantine(df, Constraints(None, (Unique(("id",), ("t",)),)))
    assert split.good.count() == 6001 and split.bad.count() == 2999
    assert split.good.where("id = -1").first().t == 8997


def test_letters_of_the_gate_are_masked(spark, tmp_path):
    people = spark.createDataFrame([(1, "x", "a@b.c"), (2, "y", "a@b.c"), (3, "z", "d@e.f")], "id long, name string, email string")
    rules = {gate.CUSTOMERS: gate.declared()[gate.CUSTOMERS]}
    split = gate.gate({gate.CUSTOMERS: people}, rules, str(tmp_path), {gate.CUSTOMERS: {"email": "hash", "phone": "mask"}})
    assert rows(split[gate.CUSTOMERS].good, "id") == [(3,)]
    letters = spark.read.parquet(f"{tmp_path}/{gate.CUSTOMERS}/relations").collect()
    assert len(letters) == 2 and not any("@" in str(r) for r in letters)
    assert all(r.reasons == ["email repeats"] for r in letters)


def test_seeds_do_not_matter(spark, many_tasks):
    """Ties of the newest row are decided by its content, however rows are dealt."""
    rng = random.Random(5)
    data = [(rng.randrange(5), "m", None, 1, rng.randrange(50)) for _ in range(60)]
    df = spark.createDataFrame(data, SCHEMA)
    ways = [quarantine(df.repartition(n), Constraints(None, (Unique(("id",), ("t",)),))) for n in (1, 5)]
    assert rows(ways[0].good) == rows(ways[1].good)
