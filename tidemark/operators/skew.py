"""Hot keys and joins that split them.

A key is hot when it holds more than its fair share of a shuffle: more than one of `spark.sql.shuffle.partitions`
equal parts of the rows (never asked for less than 1/256). So there are at most that many hot keys, whatever the
input's size: that is the proven bound of everything this module brings to the driver. Each is split into so many
parts that a part is at most half a fair share, so the largest task does not grow with the key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Parts of a hot key whose size isn't known, and the least number of parts a fair share is measured by.
SALTS, LEAST_PARTS = 48, 256

Hot = Mapping[tuple, int] | Sequence[tuple]


def partitions_of(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(rows: DataFrame, keys: Sequence[str], also: dict[str, Column] | None = None, parts: int | None = None) -> tuple[dict[tuple, int], dict]:
    """Hot key tuples with the number of parts to split each into (a power of two), and measures of the pass.

    One pass with map-side combine, so a hot key costs one row per task. `also`: aggregates over the rows whose
    names start with min_ or max_; they come back, reduced over all rows, with the row count `n`. `parts`: the number
    of fair shares, by default the session's shuffle partitions. Null keys count as a key. Empty input: no hot keys.
    """
    return hot_among(counted_keys(rows, keys, also), keys, tuple(also or ()), parts)


def counted_keys(rows: DataFrame, keys: Sequence[str], also: dict[str, Column] | None = None) -> DataFrame:
    """The number of rows of each key as `__n`, with the aggregates `also`; by partial aggregation."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), *(c.alias(a) for a, c in (also or {}).items()))


def hot_among(counts: DataFrame, keys: Sequence[str], also: Sequence[str] = (), parts: int | None = None) -> tuple[dict[tuple, int], dict]:
    """`hot_keys` of keys that are counted already (see `counted_keys`)."""
    partitions = parts or partitions_of(counts.sparkSession)
    shares = max(partitions, LEAST_PARTS)
    seen = Observation()
    fold = [(F.min if a.startswith("min_") else F.max)(a).alias(a) for a in also]
    top = counts.observe(seen, F.sum("__n").alias("n"), *fold).orderBy(F.desc("__n")).limit(shares).collect()
    measures = dict(seen.get)
    n = measures["n"] = measures.get("n") or 0
    return {tuple(r[k] for k in keys): 1 << max(1, (2 * r["__n"] * partitions // n).bit_length()) for r in top if r["__n"] * shares > n}, measures


def _in(columns: Sequence[Column], keys: Sequence[tuple]) -> Column:
    """Whether the key is one of `keys`; a null equals a null."""
    if len(columns) == 1:
        values = [k[0] for k in keys if k[0] is not None]
        test = F.coalesce(columns[0].isin(values), F.lit(False)) if values else F.lit(False)
        return test | columns[0].isNull() if len(values) < len(keys) else test
    return reduce(lambda a, b: a | b, (reduce(lambda a, b: a & b, (c.eqNullSafe(F.lit(v)) for c, v in zip(columns, k, strict=True))) for k in keys))


def parts_of(columns: Sequence[Column], hot: Hot) -> Column:
    """Number of parts the row's key is split into, 1 if it isn't hot. One set lookup per power of two."""
    sizes = hot if isinstance(hot, Mapping) else dict.fromkeys(hot, SALTS)
    result = F.lit(1)
    for size in sorted(set(sizes.values())):
        result = F.when(_in(columns, [k for k, n in sizes.items() if n == size]), F.lit(size)).otherwise(result)
    return result


def salted_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str, *, hot: Hot, hot_on: Sequence[str] | None = None, salt_on: Sequence[str], condition: Column | None = None, null_safe: bool = False) -> DataFrame:
    """Equi-join (`inner`, `left`, `left_semi`, `left_anti`) that splits the hot keys of the left side.

    Left rows of a hot key get a salt below its number of parts, a hash of `salt_on`, so that a task that runs again
    sends each row where it went before; the right rows of these keys are repeated once per salt. All other rows keep
    salt 0. Left rows with a null in `on` match nothing and are spread over all partitions. `hot`: as `hot_keys`
    gives it, or just the keys; `hot_on`: the columns it is about, `on` by default. `condition` may name columns of
    either side; the sides must share no other names than `on`. A right table must hold each key a bounded number of
    times. With `null_safe` a null equals a null, and is split like any other value.
    """
    hot_on = list(hot_on or on)
    columns = [F.col(c) for c in hot_on]
    nulls = reduce(lambda a, b: a | b, (F.col(c).isNull() for c in on))
    parts = parts_of(columns, hot)
    if not null_safe:
        parts = F.when(nulls, F.lit(max(partitions_of(left.sparkSession), 2))).otherwise(parts)
    l = left.withColumn("__salt", F.when(parts > 1, F.pmod(F.xxhash64(*salt_on), parts)).otherwise(F.lit(0)).cast("int"))
    if hot:
        r = right.withColumn("__salt", F.explode(F.sequence(F.lit(0), parts_of(columns, hot) - 1)))
    else:
        r = right.withColumn("__salt", F.lit(0))
    keys = [*on, "__salt"]
    r = r.select(*(F.col(k).alias(f"__r_{k}") for k in keys), *(c for c in r.columns if c not in keys))
    test = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"__r_{k}")) if null_safe else F.col(k) == F.col(f"__r_{k}") for k in keys))
    joined = l.join(r, test if condition is None else test & condition, how)
    return joined.drop("__salt", *(f"__r_{k}" for k in keys))
