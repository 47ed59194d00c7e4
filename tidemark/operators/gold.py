"""Dimensional tables: versioned, enumerated and calendar dimensions, point-in-time tables, exchange rates, facts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.identity import message_id
from tidemark.functions.times import date_of, day_of, event_micros, instant_literal, midnight, published_instant, utc_day
from tidemark.operators.asof import Reach, asof_join, bucket_of
from tidemark.operators.redelivery import one_of_each
from tidemark.operators.skew import hot_keys
from tidemark.session import written
from tidemark.store import append, append_new, new_rows, rows_in, table_exists

#: Start of first versions, end of open ones, key of the row without attributes. (fixed values)
FLOOR, CEILING, GHOST = "1970-01-01T00:00:00Z", "2999-12-31T23:59:59.999999Z", -1
AMOUNT, RATE = "decimal(18,2)", "decimal(18,5)"
#: Interval tables of up to this many rows are sent to every task; larger ones are joined by shuffle.
SENT_INTERVALS = 100_000


class BuildRefused(ValueError):
    """A table that can't be built from its inputs; nothing has been written."""


# --- dimensions ---------------------------------------------------------------------------------------------------


def ghost_like(rows: DataFrame, key: str, **given: Column) -> DataFrame:
    """One row with key −1, the columns `given`, and nulls elsewhere."""
    one = rows.sparkSession.range(1)
    value = {f.name: given.get(f.name, F.lit(GHOST) if f.name == key else F.lit(None)) for f in rows.schema.fields}
    return one.select(*(value[f.name].cast(f.dataType).alias(f.name) for f in rows.schema.fields))


def scd2_rows(satellite: DataFrame, hub: DataFrame, hash_key: str, keys: Sequence[str], payload: Sequence[str], surrogate: str, load_date: Column, record_source: str = "gold_build") -> DataFrame:
    """Versions of a dimension from a change-captured satellite, and its ghost row.

    Half-open `[valid_from, valid_to)`: the first version starts at the floor, the open one ends at the ceiling. The
    surrogate key is a hash of the business key and the applied date.
    """
    w = Window.partitionBy(hash_key).orderBy("applied_date")
    at = F.timestamp_micros(midnight(F.col("applied_date")))
    bounded = satellite.join(hub.select(hash_key, *keys).dropDuplicates([hash_key]), hash_key).withColumns({"__before": F.lag("applied_date").over(w), "__next": F.lead(at).over(w)})
    versions = bounded.select(
        F.xxhash64(*keys, F.col("applied_date")).alias(surrogate), *keys, *payload,
        F.when(F.col("__before").isNull(), instant_literal(FLOOR)).otherwise(at).alias("valid_from"),
        F.coalesce("__next", instant_literal(CEILING)).alias("valid_to"),
        F.col("__next").isNull().alias("is_current"), load_date.alias("load_date"), F.lit(record_source).alias("record_source"),
    )
    return versions.unionByName(ghost_like(versions, surrogate, valid_from=instant_literal(FLOOR), valid_to=instant_literal(CEILING), is_current=F.lit(True), load_date=load_date, record_source=F.lit("ghost")))


def refuse_colliding_keys(rows: DataFrame, surrogate: str) -> None:
    """Refuses surrogate keys that two rows share."""
    if rows.groupBy(surrogate).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).count():
        raise BuildRefused(f"{surrogate} is not unique")


def load_scd2(rows: DataFrame, table: str, surrogate: str, declared: Sequence[str] | None = None, held: Sequence[str] | None = None) -> int:
    """Appends a dimension's first build. A later build adds nothing, or is refused: a version whose end moved would
    have to be updated, and loads never update. `declared` snapshots must be those `held` by the source."""
    spark = rows.sparkSession
    if declared is not None and sorted(declared) != sorted(held or ()):
        raise BuildRefused(f"declared snapshots {sorted(declared)}, the source holds {sorted(held or ())}")
    if not table_exists(spark, table) or spark.table(table).isEmpty():
        refuse_colliding_keys(rows, surrogate)
        return append(rows, table)
    if not new_rows(rows, spark.table(table), [surrogate, "valid_to"]).isEmpty():
        raise BuildRefused(f"{table} is outgrown by its source; rebuild it with store.swap")
    return 0


def enumerated_rows(members: DataFrame, column: str, surrogate: str) -> DataFrame:
    """A dimension of the values of one column, keyed by their hash, with its ghost."""
    rows = members.select(column).filter(F.col(column).isNotNull()).distinct().select(F.xxhash64(column).alias(surrogate), column)
    return rows.unionByName(ghost_like(rows, surrogate))


def date_key(date: Column) -> Column:
    """yyyyMMdd of a DATE as INT."""
    return F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)


def calendar_rows(spark: SparkSession, first, last, surrogate: str = "date_key") -> DataFrame:
    """A calendar from first to last, dates included, with its ghost: key, date, year, quarter, month, day, weekday, weekend."""
    if first is None or last is None or first > last:
        raise BuildRefused("a calendar needs a span")
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("full_date"))
    d = F.col("full_date")
    weekday = F.weekday(d) + 1
    rows = days.select(date_key(d).alias(surrogate), d, F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"), F.dayofmonth(d).alias("day"), weekday.alias("day_of_week"), (weekday > 5).alias("is_weekend"))
    return rows.unionByName(ghost_like(rows, surrogate))


def covered_span(*days: DataFrame) -> tuple:
    """Least and greatest DATE over one-column frames; unreadable (null) days are refused."""
    both = days[0].toDF("d")
    for other in days[1:]:
        both = both.unionByName(other.toDF("d"))
    r = both.agg(F.min("d").alias("a"), F.max("d").alias("b"), F.count(F.when(F.col("d").isNull(), 1)).alias("n")).first()
    if r["n"]:
        raise BuildRefused(f"{r['n']} days can't be read")
    return r["a"], r["b"]


def load_conformed(rows: DataFrame, table: str, surrogate: str) -> int:
    """Appends members the dimension doesn't hold."""
    refuse_colliding_keys(rows, surrogate)
    return append_new(rows, table, [surrogate])


# --- point in time ------------------------------------------------------------------------------------------------


def pit_rows(hub: DataFrame, hash_key: str, satellites: dict[str, DataFrame], as_of_name: str = "as_of_date", as_of: Sequence | None = None) -> DataFrame:
    """For every hub key and as-of date the applied date of each satellite's row then in force; rows with none go.

    As-of dates are the distinct applied dates over all satellites unless given. All satellites' dates of a key come
    together in one shuffle; the as-of dates are exploded from a literal afterwards, never cross-joined. A key's array
    is bounded by the number of dates.
    """
    names = list(satellites)
    tagged = None
    for i, (_, rows) in enumerate(satellites.items()):
        own = rows.select(hash_key, F.lit(i).alias("__sat"), F.col("applied_date").alias("__at"))
        tagged = own if tagged is None else tagged.unionByName(own)
    if as_of is None:
        dates = [r[0] for r in tagged.select("__at").distinct().collect()]
        if None in dates:
            raise BuildRefused("an applied date is null")
        as_of = sorted(dates)
    if not as_of:
        raise BuildRefused("no as-of dates")
    known = tagged.groupBy(hash_key).agg(*(F.collect_set(F.when(F.col("__sat") == i, F.col("__at"))).alias(n) for i, n in enumerate(names)))
    grid = hub.select(hash_key).distinct().join(known, hash_key).withColumn(as_of_name, F.explode(F.array(*(F.lit(d).cast("date") for d in as_of))))
    pointer = lambda n: F.array_max(F.filter(F.col(n), lambda d: d <= F.col(as_of_name))).alias(f"{n}_applied_date")
    rows = grid.select(hash_key, as_of_name, *(pointer(n) for n in names))
    any_ = F.lit(False)
    for n in names:
        any_ = any_ | F.col(f"{n}_applied_date").isNotNull()
    return rows.filter(any_)


def lost_keys(hub: DataFrame, hash_key: str, satellites: dict[str, DataFrame]) -> DataFrame:
    """(satellite, hash key) of satellite keys that the hub lacks; a point-in-time table has no rows for them."""
    all_ = None
    for name, rows in satellites.items():
        own = rows.select(F.lit(name).alias("satellite"), hash_key).filter(F.col(hash_key).isNotNull()).distinct()
        all_ = own if all_ is None else all_.unionByName(own)
    there = hub.select(F.col(hash_key).alias("__held")).distinct()
    return all_.join(there, F.col(hash_key) == F.col("__held"), "left_anti")


def refuse_lost_keys(hub: DataFrame, hash_key: str, satellites: dict[str, DataFrame]) -> None:
    """Refuses satellites with keys the hub lacks: their rows would vanish from what is built on the hub."""
    found = {r["satellite"]: r["n"] for r in lost_keys(hub, hash_key, satellites).groupBy("satellite").agg(F.count(F.lit(1)).alias("n")).collect()}
    if found:
        raise BuildRefused(f"keys the hub lacks: {found}")


def load_pit(rows: DataFrame, table: str, hash_key: str, as_of_name: str = "as_of_date") -> int:
    """Appends as-of dates the table doesn't hold; one before those it holds is refused, it would need older rows rewritten."""
    spark = rows.sparkSession
    if table_exists(spark, table):
        newest = spark.table(table).agg(F.max(as_of_name)).first()[0]
        held = spark.table(table).select(as_of_name).distinct()
        early = new_rows(rows.select(as_of_name).distinct().filter(F.col(as_of_name) < F.lit(newest)), held, [as_of_name])
        if newest is not None and not early.isEmpty():
            raise BuildRefused(f"{table} holds later as-of dates than some of the rows")
    return append_new(rows, table, [hash_key, as_of_name])


def rows_per_as_of(rows: DataFrame, as_of_name: str = "as_of_date") -> DataFrame:
    return rows.groupBy(as_of_name).agg(F.count(F.lit(1)).alias("rows"))


# --- exchange rates -----------------------------------------------------------------------------------------------


def reduced_quotes(quotes: DataFrame, rate: Column, published: Column, currency: Column, quote_date: Column) -> DataFrame:
    """One row per currency and quote date: its rate, earliest publication (epoch microseconds), and what is wrong with it."""
    read = quotes.select(currency.alias("currency"), quote_date.alias("quote_date"), rate.alias("rate"), F.unix_micros(published).alias("published"))
    return read.groupBy("currency", "quote_date").agg(
        F.count_distinct("rate").alias("rates"),
        F.count(F.when(F.col("rate").isNull() | F.col("published").isNull() | F.col("quote_date").isNull(), 1)).alias("unreadable"),
        F.min("rate").alias("rate"), F.min("published").alias("valid_from"),
    )


def refuse_unfit_quotes(reduced: DataFrame) -> None:
    m = reduced.agg(F.count(F.lit(1)).alias("n"), F.max("rates").alias("rates"), F.sum("unreadable").alias("unreadable")).first()
    if not m["n"]:
        raise BuildRefused("no quotes")
    if m["rates"] and m["rates"] > 1:
        raise BuildRefused("a quote date has several rates")
    if m["unreadable"]:
        raise BuildRefused(f"{m['unreadable']} quotes can't be read")


def rate_intervals(reduced: DataFrame) -> DataFrame:
    """Half-open intervals in which each quote is in force: from its publication to the next one of its currency."""
    w = Window.partitionBy("currency").orderBy("valid_from", "quote_date")
    return reduced.select("currency", "quote_date", "rate", "valid_from", F.lead("valid_from").over(w).alias("valid_to"))


def ptax_intervals(ptax: DataFrame) -> DataFrame:
    """Rate intervals of the exchange-quote contract, by the selling rate; unfit quotes are refused."""
    reduced = reduced_quotes(ptax, F.col("cotacao_venda").try_cast(RATE), published_instant(F.col("data_hora_cotacao")), F.col("currency"), day_of(F.col("quote_date")))
    refuse_unfit_quotes(reduced)
    return rate_intervals(reduced)


def with_rates(events: DataFrame, intervals: DataFrame, at: str, currency: str, reporting: str = "BRL", days: int = 8, span: tuple[int, int] | None = None) -> DataFrame:
    """Adds fx_rate and fx_rate_date: the quote in force at the event's instant, 1 and the event's day for the reporting currency.

    Instants decide, not days. The interval table is sent to every task if a count shows it small; else it is joined
    by shuffle, with its currencies, which are few and hot, split by salt.
    """
    quotes = intervals.select(F.col("currency").alias("__fx_currency"), "quote_date", "rate", "valid_from", "valid_to")
    foreign = events.withColumn("__fx_currency", F.when(F.col(currency) != reporting, F.col(currency)))
    if span is None:
        r = events.agg(F.min(at).alias("a"), F.max(at).alias("b")).first()
        span = (r["a"] or 0, r["b"] or 0)
    first, last = span
    if quotes.limit(SENT_INTERVALS + 1).count() <= SENT_INTERVALS:
        end = F.least(F.coalesce(F.col("valid_to") - 1, F.lit(last)), F.lit(last))
        begin = F.greatest(F.col("valid_from"), F.lit(first))
        cut = quotes.filter(begin <= end).withColumn("__bucket", F.explode(F.sequence(bucket_of(begin, days), bucket_of(end, days)))).withColumnRenamed("__fx_currency", "__q_currency").withColumnRenamed("__bucket", "__q_bucket")
        test = (F.col("__fx_currency") == F.col("__q_currency")) & (bucket_of(F.col(at), days) == F.col("__q_bucket")) & (F.col(at) >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col(at) < F.col("valid_to")))
        joined = foreign.join(F.broadcast(cut), test, "left").drop("__q_currency", "__q_bucket")
    else:
        hot, _ = hot_keys(foreign, ["__fx_currency"])
        joined = asof_join(foreign, quotes, "__fx_currency", at, first=first, last=last, days=days, hot=hot, salt_on=events.columns)
    own = F.col(currency) == reporting
    event_day = date_of(utc_day(F.col(at)))
    return joined.withColumns({"fx_rate": F.when(own, F.lit(1).cast(RATE)).otherwise(F.col("rate")), "fx_rate_date": F.when(own, event_day).otherwise(F.col("quote_date"))}).drop("__fx_currency", "rate", "quote_date", "valid_from", "valid_to")


def fx_coverage(rated: DataFrame, at: str, last_published: int | None = None) -> dict:
    """Events without a rate (to be refused), beyond the last quote, and the widest reach back in days (to be reported)."""
    day = date_of(utc_day(F.col(at)))
    r = rated.agg(F.count(F.when(F.col("fx_rate").isNull(), 1)).alias("unresolved"), F.count(F.when(F.col(at) > F.lit(last_published), 1)).alias("beyond"), F.max(F.datediff(day, F.col("fx_rate_date"))).alias("widest")).first()
    return r.asDict()


def converted(amount: Column, rate: Column) -> Column:
    """Amount times rate, rounded half up to hundredths."""
    return (amount * rate).cast(AMOUNT)


# --- fact ---------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class PaymentFact:
    """The fact of payments: roles that refer to the company dimension, and the names of its columns."""

    roles: dict[str, str] = field(default_factory=lambda: {"payer_company_sk": "payer_cnpj_basico", "payee_company_sk": "payee_cnpj_basico"})
    surrogate: str = "company_sk"
    natural: str = "cnpj_basico"


#: Why a payment can't become a fact row.
UNREADABLE, NO_RATE = "unreadable_instant_or_amount", "no_rate"


def resolved_payments(payments: DataFrame, dimension: DataFrame, intervals: DataFrame, fact: PaymentFact | None = None) -> DataFrame:
    """One row per delivered identity with both roles, the rate, and `refusal`: why it can't become a fact row, else null.

    Deliveries are reduced to one before anything is joined, readable ones before others, and written down once. The
    companies of both roles, with the span of each one's events, decide which versions of the dimension take part: the
    versions are reduced and exploded once and meet each role by interval join, with hot companies split.
    """
    fact = fact or PaymentFact()
    columns = ["transaction_id", "event_time", "emitted_at", *fact.roles.values(), "amount", "currency", "payment_method", "_record_source"]
    unread = (event_micros(F.col("event_time")).isNull() | F.col("amount").try_cast(AMOUNT).isNull()).alias("__unread")
    rows = payments.filter(message_id(F.col("transaction_id")).isNotNull()).select(*columns, unread)
    one = one_of_each(rows, message_id(F.col("transaction_id")), ["__unread", *columns])
    read = one.select(
        message_id(F.col("transaction_id")).alias("transaction_id"), "event_time", *fact.roles.values(), "currency", "payment_method",
        event_micros(F.col("event_time")).alias("__at"), F.col("amount").try_cast(AMOUNT).alias("__amount"),
    )
    events = written(read, "payment-events")
    span = events.agg(F.min("__at").alias("a"), F.max("__at").alias("b")).first()
    rated = with_rates(events, intervals, "__at", "currency", span=(span["a"] or 0, span["b"] or 0))
    refusal = F.when(F.col("__at").isNull() | F.col("__amount").isNull(), UNREADABLE).when(F.col("fx_rate").isNull(), NO_RATE)
    rated = rated.withColumn("refusal", refusal)
    parties = events.select("__at", F.explode(F.array(*fact.roles.values())).alias("__party"))
    reach = Reach(parties, "__party", "__at")
    versions = dimension.filter(F.col(fact.surrogate) != GHOST)
    for key, column in fact.roles.items():
        own = versions.select(F.col(fact.natural).alias("__party"), F.col(fact.surrogate).alias(key), F.unix_micros("valid_from").alias("valid_from"), F.unix_micros("valid_to").alias("valid_to"))
        met = asof_join(rated.withColumn("__party", F.col(column)), own, "__party", "__at", reach=reach, days=64, salt_on=["transaction_id"])
        rated = met.drop("valid_from", "valid_to", "__party")
    return rated


def fact_rows(payments: DataFrame, dimension: DataFrame, intervals: DataFrame, load_date: Column, fact: PaymentFact | None = None, record_source: str = "gold_build", refuse: bool = True) -> DataFrame:
    """One row per delivered identity: roles and rates resolved as of the event, conformed keys, amounts.

    A role without a version has the ghost's key. Unreadable instants and amounts, and payments no rate can be resolved
    for, are refused; without `refuse` they stay out, see `refused_payments`.
    """
    fact = fact or PaymentFact()
    resolved = resolved_payments(payments, dimension, intervals, fact)
    if refuse:
        reasons = {r["refusal"]: r["n"] for r in refused_payments(resolved).groupBy("refusal").agg(F.count(F.lit(1)).alias("n")).collect()}
        if reasons:
            raise BuildRefused(f"payments that can't become fact rows: {reasons}")
    return resolved.filter(F.col("refusal").isNull()).select(
        *(F.coalesce(k, F.lit(GHOST).cast("long")).alias(k) for k in fact.roles),
        date_key(date_of(utc_day(F.col("__at")))).alias("event_date_key"), date_key(F.col("fx_rate_date")).alias("fx_rate_date_key"),
        F.xxhash64("payment_method").alias("channel_key"), F.xxhash64("currency").alias("currency_key"), "transaction_id",
        F.col("__amount").alias("amount"), "fx_rate", converted(F.col("__amount"), F.col("fx_rate")).alias("amount_brl"), "event_time",
        load_date.alias("load_date"), F.lit(record_source).alias("record_source"),
    )


def refused_payments(resolved: DataFrame) -> DataFrame:
    """(transaction_id, refusal) of payments that can't become fact rows."""
    return resolved.filter(F.col("refusal").isNotNull()).select("transaction_id", "refusal")


def fact_accounts(payments: DataFrame, content: Sequence[str], held: DataFrame | None = None) -> DataFrame:
    """What a fact's source and, once loaded, its rows add up to: (measure, n).

    deliveries and identities of the source, business tuples (distinct `content`, nulls equal), legitimate repeats (other
    identities with the content of one before), redeliveries; of `held` its rows, identities, and identities that the
    source has and it lacks.
    """
    named = payments.filter(message_id(F.col("transaction_id")).isNotNull()).select(message_id(F.col("transaction_id")).alias("id"), *content)
    per = named.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*content)).alias("content"))
    n = per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("deliveries"), F.count(F.lit(1)).alias("identities"), F.count_distinct(F.struct("content")).alias("tuples"))
    pairs = [("deliveries", F.col("deliveries")), ("identities", F.col("identities")), ("redeliveries", F.col("deliveries") - F.col("identities")), ("business_tuples", F.col("tuples")), ("legitimate_repeats", F.col("identities") - F.col("tuples"))]
    source = n.select(F.inline(F.array(*(F.struct(F.lit(name).alias("measure"), c.cast("long").alias("n")) for name, c in pairs))))
    if held is None:
        return source
    ids = held.groupBy(message_id(F.col("transaction_id")).alias("id")).agg(F.count(F.lit(1)).alias("rows"))
    both = per.select("id", F.lit(1).alias("sent")).join(ids, "id", "full")
    m = both.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.count("rows").alias("held"), F.count(F.when(F.col("rows").isNull(), 1)).alias("lacking"))
    loaded = m.select(F.inline(F.array(*(F.struct(F.lit(name).alias("measure"), F.col(c).cast("long").alias("n")) for name, c in (("fact_rows", "rows"), ("fact_identities", "held"), ("identities_lacking", "lacking"))))))
    return source.unionByName(loaded)


def load_fact(rows: DataFrame, table: str, payments: DataFrame, dimensions: dict[str, tuple[DataFrame, str]]) -> dict:
    """Appends identities the fact doesn't hold and reports: rows, identities, unresolved roles, orphans per key.

    `dimensions`: the fact's key columns with the dimension's rows and key. Fewer rows than identities are refused.
    """
    spark = rows.sparkSession
    appended = append_new(rows, table, ["transaction_id"])
    held = spark.table(table)
    identities = payments.select(message_id(F.col("transaction_id")).alias("i")).filter("i is not null").distinct().count()
    present = rows_in(spark, table)
    if present < identities:
        raise BuildRefused(f"{table} holds {present} rows for {identities} identities")
    roles = [c for c in dimensions if c.endswith("_company_sk")]
    unresolved = held.agg(*(F.count(F.when(F.col(c) == GHOST, 1)).alias(c) for c in roles)).first().asDict() if roles else {}
    orphans = {c: orphaned(held, c, dim, key) for c, (dim, key) in dimensions.items()}
    return {"appended": appended, "present": present, "identities": identities, "unresolved": unresolved, "orphans": orphans}


def orphaned(fact: DataFrame, column: str, dimension: DataFrame, key: str) -> int:
    """Fact rows whose key no dimension row has; a null refers to nothing."""
    distinct = fact.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    lost = distinct.join(dimension.select(F.col(key).alias("__k")), F.col(column) == F.col("__k"), "left_anti")
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
