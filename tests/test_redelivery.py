import random

from conftest import rows
from pyspark.sql import functions as F

from tidemark.functions.identity import hex_number, hex_text, message_id
from tidemark.operators.redelivery import BLOCK_BITS, SeenRanges, Sweep, absorb, accepted_rows, identifier, merge_ranges, one_of_each, ranges_after, whole_ranges, with_sequence


def sequence(spark, ids):
    df = spark.createDataFrame([(i,) for i in ids], "transaction_id string")
    return with_sequence(df, message_id(F.col("transaction_id"))).drop("transaction_id")


def hexid(producer, number):
    return f"{producer:04x}{number:012x}"


def test_spellings_of_one_identifier_are_one(spark):
    ids = ["ABCD-0000-0000-0001", " abcd000000000001", "abcd000000000001\t", "abcd000000000002", None, "", "  ", "odd", "ODD", "ffffffffffffffff"]
    got = absorb(sequence(spark, ids))
    named = got.select(F.coalesce(identifier(F.col("producer"), F.col("number")), F.col("other")), "deliveries", "accepted", "redelivered")
    assert rows(named) == [("abcd000000000001", 3, 1, 2), ("abcd000000000002", 1, 1, 0), ("ffffffffffffffff", 1, 1, 0), ("odd", 2, 1, 1)]


def test_hex_numbers_round_trip(spark):
    ids = ["0000000000000000", "7fffffffffffffff", "8000000000000000", "ffffffffffffffff", "00ab00000000cdef"]
    df = spark.createDataFrame([(i,) for i in ids], "i string").select("i", hex_text(hex_number(F.col("i"))).alias("j"))
    assert all(r.i == r.j for r in df.collect())


def test_batches_accept_each_number_once_and_ranges_stay_disjoint(spark):
    random.seed(4)
    seen, seen_other, known, accepted_ever = None, None, set(), []
    for _ in range(3):
        batch = [hexid(random.choice([1, 1, 1, 2]), random.choice([random.randrange(40), 4090 + random.randrange(12), 2**47])) for _ in range(60)] + random.choices(["bad-1", "bad-2"], k=3)
        decisions = absorb(sequence(spark, batch), seen, seen_other).cache()
        got = {(r["producer"], r["number"], r["other"]): (r["deliveries"], r["accepted"], r["redelivered"]) for r in decisions.collect()}
        for key, (n, a, again) in got.items():
            assert a == (0 if key in known else 1) and again == n - a
            accepted_ever += [key] * a
        known |= set(got)
        seen = merge_ranges(decisions, seen).cache()
        other = decisions.filter("other is not null").select("other")
        seen_other = other if seen_other is None else seen_other.unionByName(other)
    assert len(accepted_ever) == len(set(accepted_ever)) == len(known)
    numbers = {}
    for p, n, _ in known:
        if p is not None:
            numbers.setdefault(p, set()).add(n)
    want = []
    for p, ns in numbers.items():
        for n in sorted(ns):
            if want and want[-1][0] == p and want[-1][2] == n - 1:
                want[-1][2] = n
            else:
                want.append([p, n, n])
    assert rows(whole_ranges(seen)) == rows(spark.createDataFrame([tuple(w) for w in want], "p int, lo long, hi long"))


def test_ranges_join_up_over_many_blocks(spark):
    n = 3 << BLOCK_BITS
    ids = spark.range(n).select(F.lit(1).alias("producer"), (F.col("id") + (1 << 24) - n // 2).alias("number"), F.lit(None).cast("string").alias("other"), F.lit(1).alias("accepted"))
    assert rows(whole_ranges(merge_ranges(ids))) == [(1, (1 << 24) - n // 2, (1 << 24) + n // 2 - 1)]


def test_one_row_of_each_message(spark):
    df = spark.createDataFrame([("a", 2, None), ("A", 1, "x"), ("a", 1, None), ("b", None, "y"), (None, 5, "z"), (None, 5, "z")], "id string, t int, `odd.name` string")
    assert rows(one_of_each(df, message_id(F.col("id")), ["t"])) == [(None, 5, "z"), (None, 5, "z"), ("A", 1, "x"), ("b", None, "y")]
    assert rows(one_of_each(df.limit(0), message_id(F.col("id")), ["t"])) == []


def test_no_deliveries(spark):
    assert absorb(sequence(spark, [])).count() == 0


def in_batches(spark, deliveries):
    df = spark.createDataFrame(deliveries, "transaction_id string, day int")
    return with_sequence(df, message_id(F.col("transaction_id"))).drop("transaction_id")


def test_batches_are_swept_in_order_against_carried_ranges(spark):
    random.seed(5)
    deliveries = []
    for day in range(30):  # producer 1 counts up and sends a few again, producer 2 jumps, two texts are no numbers
        deliveries += [(hexid(1, 100 * day + i), day) for i in range(100)] + [(hexid(1, random.randrange(100 * day + 1)), day) for _ in range(5)]
        deliveries += [(hexid(2, random.randrange(1 << 48)), day) for _ in range(20)] + [(random.choice(["x-1", "x-2", "x3"]), day)]
    deliveries += [(hexid(65535, (1 << 48) - 1), 3), (hexid(0, 0), 2), (hexid(0, 0), 9), (None, 4)]
    random.shuffle(deliveries)
    got = absorb(in_batches(spark, deliveries), order="day")
    seen, want = set(), []
    for day in range(30):
        own = [i.replace("-", "") for i, d in deliveries if d == day and i]
        for i in sorted(set(own)):
            want.append((i, own.count(i), int(i not in seen), own.count(i) - int(i not in seen)))
        seen |= set(own)
    named = got.select(F.coalesce(identifier(F.col("producer"), F.col("number")), F.col("other")), "deliveries", "accepted", "redelivered")
    assert rows(named) == sorted(want)
    ranges = rows(ranges_after(in_batches(spark, deliveries), order="day").filter("producer = 1").select("lo", "hi"))
    assert ranges == [(0, 2999)]  # a state of one range for three thousand numbers


def test_ranges_decide(monkeypatch):
    """Without what the ranges cover, a message delivered in two batches would be accepted twice."""
    import numpy as np
    import pyarrow as pa

    def swept():
        sweep, void = Sweep(), pa.array([None], pa.string())
        return [sweep(pa.array([5]), pa.array([5]), void, np.array([False])).tolist() for _ in range(2)]

    assert swept() == [[True], [False]]
    monkeypatch.setattr(SeenRanges, "covers", lambda self, numbers: np.zeros(len(numbers), bool))
    assert swept() == [[True], [True]]


def test_seen_ranges_against_a_set():
    import numpy as np

    random.seed(6)
    for top in (50, 1 << 13, 1 << 40):
        seen, known = SeenRanges(), set()
        for _ in range(40):
            numbers = np.unique(np.array([(1 << 63) + random.randrange(top) for _ in range(random.randrange(60))], np.uint64))
            covered = seen.covers(numbers)
            assert covered.tolist() == [int(n) in known for n in numbers]
            fresh = numbers[~covered]
            seen.add(fresh, fresh)
            known |= set(map(int, fresh))
        lo, hi = seen.ranges()
        assert [n for a, b in zip(lo.tolist(), hi.tolist(), strict=True) for n in range(a, b + 1)] == sorted(known)
        assert all(a >> BLOCK_BITS == b >> BLOCK_BITS for a, b in zip(lo.tolist(), hi.tolist(), strict=True))
        assert all(b + 1 != a or not a % (1 << BLOCK_BITS) for a, b in zip(lo.tolist()[1:], hi.tolist(), strict=False))


def test_one_accepted_row_of_each_message(spark):
    data = [("00AA-000000000001", 2, "b2", None), ("00aa000000000001", 1, "b1", "x"), ("00aa000000000001", 1, "b1", None), ("odd", 3, None, "y"), ("ODD", 2, "b1", "y"), (None, 5, "b", "z"), (None, 5, "b", "z")]
    df = spark.createDataFrame(data, "id string, t int, batch string, `odd.name` string")
    want = [(None, 5, "b", "z"), (None, 5, "b", "z"), ("00aa000000000001", 1, "b1", None), ("ODD", 2, "b1", "y")]
    assert rows(accepted_rows(df, message_id(F.col("id")), ["t"], "batch")) == want
    assert rows(accepted_rows(df.limit(0), message_id(F.col("id")), ["t"], "batch")) == []
