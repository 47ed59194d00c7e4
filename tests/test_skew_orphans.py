import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators.orphans import find_orphans, latest_at, orphan_report
from tidemark.operators.skew import hot_keys, parts_of, salted_join

REFS = "id int, a int, b string"


def orphans(spark, refs, target, semantics, hot=()):
    r = spark.createDataFrame(refs, REFS)
    t = spark.createDataFrame(target, "a int, b string, id int")  # id clashes and is not read
    return [x[0] for x in rows(find_orphans(r, t, ["a", "b"], semantics=semantics, hot=hot, hot_on=["a"], salt_on=["id"]))]


TARGET = [(1, "x", 9), (2, "y", 9), (2, "y", 9), (3, None, 9), (None, "z", 9)]
CASES = [(1, 1, "x"), (2, 1, "y"), (3, None, "x"), (4, None, "q"), (5, 2, None), (6, 7, None), (7, None, None), (8, 1, "y"), (9, 3, None), (10, None, "z")]


@pytest.mark.parametrize("hot", [(), ((1,),), ((1,), (2,), (None,))])
def test_each_semantics_looks_up_each_null_mask(spark, hot):
    assert sorted(orphans(spark, CASES, TARGET, "simple", hot)) == [2, 8]
    assert sorted(orphans(spark, CASES, TARGET, "full", hot)) == [2, 3, 4, 5, 6, 8, 9, 10]
    assert sorted(orphans(spark, CASES, TARGET, "partial", hot)) == [2, 4, 6, 8]


def test_against_brute_force(spark):
    values = [None, 1, 2, 3]
    refs = [(i, a, str(b) if b else None) for i, (a, b) in enumerate((a, b) for a in values for b in values)]
    target = [(1, "1", 0), (2, "3", 0), (None, "2", 0)]
    keys = {(a, b) for a, b, _ in target}
    for semantics in ("simple", "partial", "full"):
        want = []
        for i, a, b in refs:
            nulls = (a is None) + (b is None)
            if nulls == 0:
                bad = (a, b) not in keys
            elif nulls == 2 or semantics == "simple":
                bad = False
            elif semantics == "full":
                bad = True
            else:
                bad = not any((a is None or a == x) and (b is None or b == y) for x, y in keys)
            if bad:
                want.append(i)
        assert sorted(orphans(spark, refs, target, semantics)) == want, semantics


def test_empty_tables(spark):
    assert orphans(spark, [], TARGET, "full") == []
    assert sorted(orphans(spark, CASES, [], "simple")) == [1, 2, 8]


def test_unknown_semantics_is_refused(spark):
    with pytest.raises(ValueError):
        orphans(spark, CASES, TARGET, "loose")


def test_report_counts_per_role_and_period(spark):
    found = spark.createDataFrame([("payer", "2027-01"), ("payer", "2027-01"), ("payee", None)], "party_role string, m string")
    assert rows(orphan_report(found, "t", "party_role", "m")) == [("t", "payee", None, 1), ("t", "payer", "2027-01", 2)]


def test_latest_at_is_closed_at_its_start(spark):
    df = spark.createDataFrame([(9,), (10,), (19,), (20,), (None,)], "t long").select(latest_at(F.col("t"), [(20, "b"), (10, "a")]))
    assert [r[0] for r in df.collect()] == [None, "a", "a", "b", None]


def test_hot_keys_are_those_over_their_fair_share(spark):
    df = spark.range(2000).select(F.when(F.col("id") < 800, 7).when(F.col("id") < 1400, F.lit(None)).otherwise(F.col("id")).alias("k"), "id")
    hot, seen = hot_keys(df, ["k"], also={"min_id": F.min("id"), "max_id": F.max("id")}, parts=1000)
    assert hot == {(7,): 1024, (None,): 1024} and seen == {"n": 2000, "min_id": 0, "max_id": 1999}
    assert all(n / 2000 / parts <= 1 / 1000 for (_, parts), n in zip(sorted(hot.items(), key=str), (600, 800), strict=True))
    assert set(hot_keys(df, ["k"])[0].values()) <= {2, 4, 8}
    assert hot_keys(df.limit(0), ["k"])[0] == {}


def test_parts_of_a_key(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (None, "a"), (3, None)], "k int, v string")
    assert [r[0] for r in df.select(parts_of([F.col("k")], {(1,): 4, (None,): 8})).collect()] == [4, 1, 8, 1]
    assert [r[0] for r in df.select(parts_of([F.col("k"), F.col("v")], {(3, None): 2, (1, "b"): 4})).collect()] == [1, 1, 1, 2]


def test_no_task_gets_more_than_its_share_of_a_hot_key(spark):
    """A third of all rows under one key, and another third without a key, spread evenly over the join's keys."""
    left = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 5).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id")).alias("k"), "id")
    hot, _ = hot_keys(left, ["k"], parts=60)
    parts = parts_of([F.col("k")], hot)
    sizes = left.groupBy("k", F.pmod(F.xxhash64("id"), parts).alias("salt")).count().agg(F.max("count")).first()[0]
    assert sizes <= 30_000 / 60


@pytest.mark.parametrize("hot", [[(5,)], {(5,): 8, (1,): 2, (None,): 4}, {}])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_a_salted_join_gives_what_a_plain_one_gives(spark, how, hot):
    left = spark.range(300).select((F.col("id") % 7).alias("k"), F.col("id").alias("v")).withColumn("k", F.when(F.col("v") % 3 == 0, 5).when(F.col("v") % 11 == 0, F.lit(None)).otherwise(F.col("k")))
    right = spark.createDataFrame([(5, "five"), (1, "one"), (1, "uno"), (None, "none")], "k long, w string")
    plain = left.join(right, "k", how).select(*left.columns, *(["w"] if how in ("inner", "left") else []))
    assert rows(salted_join(left, right, ["k"], how, hot=hot, salt_on=["v"])) == rows(plain)
