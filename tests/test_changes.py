import datetime as dt
import random

from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators.asof import asof_join, bucket_of, intervals_from_changes
from tidemark.operators.history import attribute_history
from tidemark.operators.snapshotdiff import consecutive, snapshot_changes
from tidemark.plans.data_queries import company_history

D = dt.date


def diff(spark, data, periods):
    df = spark.createDataFrame(data, "k string, m string, t int, a string, hash string, key string, period string")
    got = snapshot_changes(df, F.col("k"), F.col("m"), [F.coalesce("a", F.lit(""))], F.col("t"), periods)
    return rows(got)


def test_changes_between_consecutive_snapshots(spark):
    x = (None, None, None)
    data = [
        ("a", "01", 1, "v", *x), ("a", "02", 1, "old", *x), ("a", "02", 2, "v", *x), ("a", "02", 2, "v", *x), ("a", "04", 1, "w", *x),
        ("b", "01", 1, None, *x), ("b", "04", 1, None, *x), ("c", "04", 1, "n", *x), (None, "04", 1, "n", *x), ("d", None, 1, "n", *x), ("e", "02", 1, "", *x), ("e", "04", 1, None, *x),
    ]
    assert diff(spark, data, ["01", "04", "02"]) == [("a", "04", "changed"), ("b", "02", "removed"), ("b", "04", "added"), ("c", "04", "added"), ("e", "02", "added")]


def test_fewer_than_two_snapshots_or_none(spark):
    assert diff(spark, [("a", "01", 1, "v", None, None, None)], ["01"]) == []
    assert diff(spark, [], ["01", "02"]) == []
    assert consecutive(["b", "a", "c", "a"]) == {"a": "b", "b": "c"}


def test_changes_against_brute_force(spark):
    random.seed(1)
    data, state = [], {}
    for m in ("01", "02", "03", "04"):
        for k in range(40):
            if random.random() < 0.7:
                a = random.choice("xyz")
                state.setdefault(m, {})[str(k)] = a
                data += [(str(k), m, 5, a, None, None, None)] * random.choice([1, 2]) + [(str(k), m, 1, "superseded", None, None, None)]
    want = []
    for before, after in (("01", "02"), ("02", "03"), ("03", "04")):
        for k in set(state[before]) | set(state[after]):
            kind = "added" if k not in state[before] else "removed" if k not in state[after] else "changed" if state[before][k] != state[after][k] else None
            if kind:
                want.append((k, after, kind))
    assert diff(spark, data, list(state)) == sorted(want)


def history(spark, data):
    df = spark.createDataFrame(data, "e string, d date, t int, a string, entity string, at string")
    return rows(attribute_history(df, "e", "d", F.col("t"), {"a": F.coalesce("a", F.lit(""))}))


def test_history_appends_a_version_only_upon_change(spark):
    x = (None, None)
    data = [
        ("a", D(2027, 3, 1), 1, "v1", *x), ("a", D(2027, 1, 1), 9, "v1", *x), ("a", D(2027, 2, 1), 1, "wrong", *x), ("a", D(2027, 2, 1), 2, "v1", *x), ("a", D(2027, 4, 1), 1, "v2", *x), ("a", D(2027, 5, 1), 1, "v1", *x),
        ("a", D(2027, 5, 1), 1, "v1", *x), ("b", D(2027, 1, 1), 1, None, *x), ("b", D(2027, 2, 1), 1, "", *x), (None, D(2027, 1, 1), 1, "v", *x), ("c", None, 1, "v", *x),
    ]
    assert history(spark, data) == [("a", 1, D(2027, 1, 1), D(2027, 4, 1), "v1"), ("a", 2, D(2027, 4, 1), D(2027, 5, 1), "v2"), ("a", 3, D(2027, 5, 1), None, "v1"), ("b", 1, D(2027, 1, 1), None, "")]
    assert history(spark, []) == []


def test_equal_recency_takes_the_greatest_value(spark):
    data = [("a", D(2027, 1, 1), 1, "x", None, None), ("a", D(2027, 1, 1), 1, "y", None, None)]
    assert history(spark, data) == [("a", 1, D(2027, 1, 1), None, "y")]


def test_an_entity_with_many_statements(spark):
    df = spark.range(60_000).select(F.lit("hot").alias("e"), F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") % 3000).cast("int")).alias("d"), (F.col("id") / 3000).cast("int").alias("t"), F.when(F.col("id") % 3000 < 1500, "x").otherwise("y").alias("a"))
    got = rows(attribute_history(df, "e", "d", F.col("t"), {"a": F.col("a")}))
    assert [(g[1], g[4]) for g in got] == [(1, "x"), (2, "y")]


def test_history_of_the_supplied_companies_tiles_time(spark):
    got = company_history(spark, "/root/testdata/sf0.001").collect()
    by = {}
    for r in got:
        by.setdefault(r.company, []).append(r)
    for versions in by.values():
        versions.sort(key=lambda r: r.version_no)
        assert [v.valid_to for v in versions[:-1]] == [v.valid_from for v in versions[1:]] and versions[-1].valid_to is None
        assert all(a[5:] != b[5:] or a[4:] != b[4:] for a, b in zip(versions, versions[1:], strict=False))


def asof(spark, events, versions, hot=(), how="left"):
    e = spark.createDataFrame(events, "i int, k string, t long, valid_from string")
    v = spark.createDataFrame(versions, "k string, valid_from long, valid_to long, v string")
    ts = [x[2] for x in events if x[2] is not None] or [0]
    got = asof_join(e, v, "k", "t", first=min(ts), last=max(ts), days=1, hot=hot, salt_on=["i"], how=how)
    assert got.columns == ["i", "k", "t", "valid_from", "version_valid_from", "valid_to", "v"]
    return {r.i: r.v for r in got.collect()}


DAY = 86_400_000_000


def test_intervals_are_half_open_and_nothing_later_is_known(spark):
    versions = [("a", DAY, 3 * DAY, "v1"), ("a", 3 * DAY, None, "v2"), ("b", -5 * DAY, 2 * DAY, "w"), (None, 0, None, "n")]
    events = [(1, "a", DAY - 1, "x"), (2, "a", DAY, "x"), (3, "a", 3 * DAY - 1, "x"), (4, "a", 3 * DAY, "x"), (5, "a", 900 * DAY, "x"), (6, "b", 0, "x"), (7, "b", 2 * DAY, "x"), (8, None, 0, "x"), (9, "a", None, "x"), (10, "z", 5, "x"), (11, "b", -3 * DAY, "x")]
    want = {1: None, 2: "v1", 3: "v1", 4: "v2", 5: "v2", 6: "w", 7: None, 8: None, 9: None, 10: None, 11: "w"}
    for hot in ((), (("a",),)):
        assert asof(spark, events, versions, hot) == want
    assert asof(spark, events, versions, how="inner") == {i: v for i, v in want.items() if v}
    assert asof(spark, events, []) == dict.fromkeys(want)
    assert asof(spark, [], versions) == {}


def test_asof_against_brute_force(spark):
    random.seed(2)
    versions = []
    for k in "abcd":
        cuts = sorted(random.sample(range(0, 60), 5))
        versions += [(k, c * DAY // 3, n * DAY // 3 if n else None, f"{k}{c}") for c, n in zip(cuts, [*cuts[1:], None], strict=True)]
    events = [(i, random.choice("abcde"), random.randrange(-DAY, 30 * DAY), "x") for i in range(400)]
    want = {i: next((v for k2, f, t, v in versions if k2 == k and f <= at and (t is None or at < t)), None) for i, k, at, _ in events}
    assert asof(spark, events, versions, (("a",), ("b",))) == want


def test_intervals_and_buckets(spark):
    df = spark.createDataFrame([("a", 1), ("a", 5), ("b", 2)], "k string, at long")
    assert rows(intervals_from_changes(df, ["k"], "at").select("k", "valid_from", "valid_to")) == [("a", 1, 5), ("a", 5, None), ("b", 2, None)]
    got = spark.createDataFrame([(-1,), (0,), (DAY * 2 - 1,), (DAY * 2,)], "t long").select(bucket_of(F.col("t"), 2))
    assert [r[0] for r in got.collect()] == [-1, 0, 0, 1]


def test_every_month_of_orders_is_compared_with_the_next(spark, duck):
    from conftest import DATA

    from tidemark.plans import model_queries

    got = {r.period for r in model_queries.queries()["snapshot_diff_orders"](spark, DATA).select("period").distinct().collect()}
    months = sorted(m for (m,) in duck.sql("SELECT DISTINCT strftime(o_orderdate, '%Y-%m') FROM orders").fetchall())
    assert len(months) > 2 and got == set(months[1:])
