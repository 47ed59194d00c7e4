import datetime as dt
import itertools
import sys

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.functions import identity, keys, times

CORPUS = [None, "", " ", "\xa0", "\t\n", "a", "A", " a ", "a||b", "||", "N", "E", "W", "S1:A", "ß", "ss", "ação", "ŉ", "​x", "　y ", "1", "01"]


def test_hashes_agree_with_python_and_never_collide(spark):
    pairs = list(itertools.product(CORPUS, CORPUS))
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string").select("i", keys.hash_key(F.col("a"), F.col("b")).alias("h"))
    got = {r.i: r.h for r in df.collect()}
    plain = {}
    for i, (a, b) in enumerate(pairs):
        assert got[i] == keys.hash_key_of([a, b]), (a, b)
        kind = tuple(None if x is None else "" if x == "" else " " if not x.strip() else x.strip().upper() for x in (a, b))
        assert plain.setdefault(got[i], kind) == kind
    assert len(plain) == len({*plain.values()})


def test_trim_and_case_over_every_code_point(spark):
    points = [c for c in range(sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF]
    df = spark.createDataFrame([(c, chr(c)) for c in points], "c int, t string").select("c", (keys.stripped(F.col("t")) == "").alias("gone"), F.upper("t").alias("u"), F.col("t").rlike(keys.CASE_DIVERGENT_CLASS).alias("known"))
    gone, differs, known = set(), set(), set()
    for r in df.toLocalIterator():
        if r.gone:
            gone.add(chr(r.c))
        if r.u != chr(r.c).upper():
            differs.add(r.c)
        if r.known:
            known.add(r.c)
    assert gone == set(keys.STRIPPED) and differs == known


def test_padding_refuses_to_cut(spark):
    df = spark.createDataFrame([("12",), ("",), (None,), ("12345678",)], "k string")
    assert [r[0] for r in df.select(keys.zero_padded(F.col("k"), 8)).collect()] == ["00000012", "00000000", None, "12345678"]
    with pytest.raises(PySparkException):
        spark.createDataFrame([("123456789",)], "k string").select(keys.zero_padded(F.col("k"), 8)).collect()
    with pytest.raises(keys.KeyRefused):
        keys.zero_padded_of("123", 2)
    for bad in ([], "AB"):
        with pytest.raises(keys.KeyRefused):
            keys.hash_key_of(bad)
    with pytest.raises(keys.KeyRefused):
        keys.refuse_non_strings(spark.range(1), ["id", "absent"])


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo", "Asia/Kolkata"])
def test_instants_do_not_depend_on_the_session_zone(spark, zone):
    texts = ["2027-01-09T00:00:00.000Z", "2027-01-08T21:00:00.000-03:00", "2027-01-09T00:00:00.000+00:00", " 2027-01-09T00:00:00Z ", "2027-01-09T00:00:00", "n/d", "", None, "27/03/15 10h", "2027-02-30T00:00:00Z", "2027-01-09T24:61:00Z", "1969-12-31T23:59:59.999Z"]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(t,) for t in texts], "t string").select(times.event_micros(F.col("t")).alias("m"))
        got = [(r.m, r.day, r.month) for r in df.select("m", times.utc_day(F.col("m")).alias("day"), times.month_of(F.col("m")).alias("month")).collect()]
        start = int(dt.datetime(2027, 1, 9, tzinfo=dt.UTC).timestamp()) * 10**6
        assert got[:4] == [(start, 20827, "2027-01")] * 4 and got[4:11] == [(None, None, None)] * 7 and got[11] == (-1000, -1, "1969-12")
        one = spark.range(1).select(times.midnight(F.lit("2027-01-09").cast("date")), F.unix_micros(times.instant_literal("2027-01-09T00:00:00Z")), F.unix_micros(times.published_instant(F.lit("2027-01-08 21:00:00.0")))).first()
        assert tuple(one) == (start, start, start)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_dates_of_files_and_snapshots(spark):
    cases = [("/x/EMPRE.D270109.P1", "2027-01", dt.date(2027, 1, 9)), ("/x/K.D70109", "2027-01", dt.date(2027, 1, 9)), ("/x/K.D70109", "2027-02", None), ("/x/K.D70109.D70110", "2027-01", None), ("/D70109/K", "2027-01", None), ("/x/K.D70230", "2027-02", None), (None, "2027-01", None)]
    df = spark.createDataFrame(cases, "p string, m string, want date")
    assert all(r.got == r.want for r in df.select("want", times.ref_date_of_file(F.col("p"), F.col("m")).alias("got")).collect())
    assert spark.range(1).select(times.token_month(F.lit("/x/K.D70109"))).first()[0] == "7-01"
    df = spark.createDataFrame([("2027-01-09T23:59:59.123456Z", dt.date(2027, 1, 9)), ("2027-01-09T23:59:59.123Z", None), ("2027-13-09T23:59:59.123456Z", None), (None, None)], "t string, want date")
    assert all(r.got == r.want for r in df.select("want", times.ref_date_of_instant(F.col("t")).alias("got")).collect())
    assert spark.range(1).select(times.day_of(F.lit("2027-01-09T..."))).first()[0] == dt.date(2027, 1, 9)


def test_canonical_values(spark):
    df = spark.createDataFrame([("12.345.678/0001-90", "1.234,50", " a  b "), ("\t345", "0001234.50", "A B"), ("", "0,00", None), (None, None, ""), ("RAZAO", " ", "x")], "k string, c string, t string")
    got = [tuple(r) for r in df.select(identity.company_text(identity.company_key(F.col("k"))), identity.amount(F.col("c")), identity.attribute(F.col("t"))).collect()]
    assert got == [("12345678", "123450", "A B"), ("00000345", "123450", "A B"), (None, "0", ""), (None, "", ""), (None, "", "X")]


def test_check_digits(spark):
    known = [("112223330001", "81"), ("000000000001", "91"), ("11222333000", None), ("11222333000x", None), (None, None)]
    df = spark.createDataFrame(known, "t string, want string")
    assert all(r.got == r.want for r in df.select("want", identity.check_digits(F.col("t")).alias("got")).collect())
