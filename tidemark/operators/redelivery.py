"""Messages delivered more than once: seen ranges per producer.

An identifier is read as a producer (its high bits) and a number in that producer's sequence (its low bits). What
a consumer has seen is kept as disjoint ranges of numbers per producer. A number no range covers is accepted
once and closes up with its neighbours; a covered one is a redelivery. Identifiers that are no number are looked
up exactly, by their own text. Ranges are kept cut at the borders of blocks of 2^BLOCK_BITS numbers, so deliveries and
ranges of a block meet in one partition however many numbers a producer has sent.

Deliveries of one identifier within one batch are reduced to one row before the shuffle. Then every partition is one
ordered sweep: batch after batch its numbers are compared with the ranges carried so far, and the ranges grow.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.identity import hex_number

#: Bits of the identifier that name the producer, and those of a block of its sequence.
PRODUCER_BITS = 16
BLOCK_BITS = 12
SEQUENCE_BITS = 64 - PRODUCER_BITS
#: Levels at which ranges that touch their block's border are merged: each widens the block by 2^BLOCK_BITS.
LEVELS = tuple(range(BLOCK_BITS, SEQUENCE_BITS + BLOCK_BITS, BLOCK_BITS))
_WITHIN = np.uint64((1 << BLOCK_BITS) - 1)


def with_sequence(rows: DataFrame, bare: Column) -> DataFrame:
    """Adds `producer` and `number`, both null where the identifier is no number, and then its text as `other`."""
    n = hex_number(bare)
    return rows.withColumns({"producer": F.shiftrightunsigned(n, SEQUENCE_BITS).cast("int"), "number": n.bitwiseAND(F.lit((1 << SEQUENCE_BITS) - 1)), "other": F.when(n.isNull(), bare)})


def identifier(producer: Column, number: Column) -> Column:
    """Sixteen hex digits of a producer and a number."""
    return F.concat(F.lpad(F.lower(F.hex(producer)), PRODUCER_BITS // 4, "0"), F.lpad(F.lower(F.hex(number)), SEQUENCE_BITS // 4, "0"))


def _block(number: Column, bits: int = BLOCK_BITS) -> Column:
    return F.shiftright(number, min(bits, 63)) if bits < 63 else F.lit(0).cast("long")


class SeenRanges:
    """Disjoint ranges of identifiers (64 bits, unsigned: producer, then number), none of which crosses a block's border.

    Ranges lie in a few runs, each sorted, the next less than half as long as the one before; a run that grows beyond
    that is merged into its neighbour and closed up. So n numbers cost n log n steps in all, in whatever order they
    come, and a run of consecutive numbers costs one range.
    """

    def __init__(self):
        self.runs: list[tuple[np.ndarray, np.ndarray]] = []

    def covers(self, numbers: np.ndarray) -> np.ndarray:
        """Whether each number lies in a range."""
        covered = np.zeros(len(numbers), bool)
        for lo, hi in self.runs:
            at = np.searchsorted(lo, numbers, "right")
            covered |= (at > 0) & (hi[np.maximum(at, 1) - 1] >= numbers)
        return covered

    def add(self, lo: np.ndarray, hi: np.ndarray) -> None:
        """Takes up ranges that are sorted and disjoint from each other and from those held."""
        if not len(lo):
            return
        run = self._closed(lo, hi)
        while self.runs and len(self.runs[-1][0]) <= 2 * len(run[0]):
            other = self.runs.pop()
            lo, hi = np.concatenate([other[0], run[0]]), np.concatenate([other[1], run[1]])
            order = np.argsort(lo, kind="stable")
            run = self._closed(lo[order], hi[order])
        self.runs.append(run)

    @staticmethod
    def _closed(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Adjacent ranges of a block made one."""
        apart = (lo[1:] != hi[:-1] + np.uint64(1)) | ((lo[1:] & _WITHIN) == 0)
        return lo[np.concatenate([[True], apart])], hi[np.concatenate([apart, [True]])]

    def ranges(self) -> tuple[np.ndarray, np.ndarray]:
        """All ranges, sorted and closed up."""
        if not self.runs:
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        lo, hi = (np.concatenate([r[i] for r in self.runs]) for i in (0, 1))
        order = np.argsort(lo, kind="stable")
        return self._closed(lo[order], hi[order])


class Sweep:
    """Decides over deliveries in order, with the ranges seen so far as its state."""

    def __init__(self):
        self.seen, self.other = SeenRanges(), None

    def __call__(self, number: pa.Array, hi: pa.Array, other: pa.Array, before: np.ndarray) -> np.ndarray:
        """Whether each row is accepted. `before` marks rows that are state: ranges number to hi, or texts, seen before.

        Malformed identifiers come sorted by text, so each is looked up by the text of the row before it.
        """
        accepted = np.zeros(len(number), bool)
        plain = number.is_valid().to_numpy(zero_copy_only=False)
        value, end = (c.fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64) for c in (number, hi))
        held = np.flatnonzero(plain & before)
        if len(held):
            held = held[np.argsort(value[held], kind="stable")]
            self.seen.add(value[held], end[held])
        new = np.flatnonzero(plain & ~before)
        if len(new):
            distinct, first = np.unique(value[new], return_index=True)
            uncovered = ~self.seen.covers(distinct)
            accepted[new[first[uncovered]]] = True
            self.seen.add(distinct[uncovered], distinct[uncovered])
        rest = np.flatnonzero(~plain)
        for i, text in zip(rest.tolist(), other.take(pa.array(rest)).to_pylist(), strict=True):
            accepted[i] = text != self.other and not before[i]
            self.other = text
        return accepted


def _swept(rows: DataFrame, carried: Sequence[str], order: Sequence[str], seen: DataFrame | None, seen_other: DataFrame | None, ranges: bool) -> DataFrame:
    """Rows (id, other, carried…) of one identifier and batch each, swept in `order`: with `accepted`, or the ranges after them."""
    void = lambda name, kind: F.lit(None).cast(kind).alias(name)
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    new = rows.select("id", F.col("id").alias("hi"), "other", F.lit(False).alias("before"), *carried)
    if seen is not None:
        held = seen.select(_joined("producer", "lo").alias("id"), _joined("producer", "hi").alias("hi"), void("other", "string"), F.lit(True).alias("before"), *(void(c, kinds[c]) for c in carried))
        new = new.unionByName(held)
    if seen_other is not None:
        held = seen_other.select(void("id", "long"), void("hi", "long"), "other", F.lit(True).alias("before"), *(void(c, kinds[c]) for c in carried)).distinct()
        new = new.unionByName(held)
    placed = new.withColumn("block", F.shiftrightunsigned("id", BLOCK_BITS)).repartition("block", "other").drop("block")
    ordered = placed.sortWithinPartitions("other", F.desc("before"), *order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sweep = Sweep()
        for batch in batches:
            before = batch.column("before").to_numpy(zero_copy_only=False)
            accepted = sweep(batch.column("id"), batch.column("hi"), batch.column("other"), before)
            if not ranges:
                decided = pa.RecordBatch.from_arrays([batch.column(c) for c in ("id", "other", *carried)] + [pa.array(accepted)], names=["id", "other", *carried, "accepted"])
                yield decided.filter(pc.invert(batch.column("before")))
        if ranges:
            lo, hi = (x.view(np.int64) for x in sweep.seen.ranges())
            for i in range(0, len(lo), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(lo[i : i + (1 << 16)]), pa.array(hi[i : i + (1 << 16)])], names=["lo", "hi"])

    if ranges:
        found = ordered.mapInArrow(run, "lo long, hi long")
        own = {"producer": _producer("lo"), "block": _block(_number("lo")), "lo": _number("lo"), "hi": _number("hi")}
        return found.select(*(c.alias(n) for n, c in own.items()))
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("other", T.StringType()), *(T.StructField(c, kinds[c]) for c in carried), T.StructField("accepted", T.BooleanType())])
    return ordered.mapInArrow(run, schema)


def _joined(producer: str, number: str) -> Column:
    return F.shiftleft(F.col(producer).cast("long"), SEQUENCE_BITS).bitwiseOR(F.col(number))


def _producer(id_: str) -> Column:
    return F.shiftrightunsigned(id_, SEQUENCE_BITS).cast("int")


def _number(id_: str) -> Column:
    return F.col(id_).bitwiseAND(F.lit((1 << SEQUENCE_BITS) - 1))


def _counted(batch: DataFrame, order: str | None) -> DataFrame:
    named = batch.filter(F.col("number").isNotNull() | F.col("other").isNotNull())
    own = [order] if order else []
    return named.groupBy(_joined("producer", "number").alias("id"), "other", *own).agg(F.count(F.lit(1)).alias("deliveries"))


def absorb(batch: DataFrame, seen: DataFrame | None = None, seen_other: DataFrame | None = None, order: str | None = None) -> DataFrame:
    """Decides over deliveries: (producer, number, other, deliveries, accepted, redelivered).

    `batch` has the columns of `with_sequence`, and the column `order` if it holds several batches, which are taken in
    its order (null first); `seen` the ranges so far (producer, block, lo, hi), `seen_other` the malformed identifiers
    so far (other). One row per identifier and batch: accepted is 1 if no seen range covers its number (or its text is
    new), else 0; redelivered is the number of its deliveries that are not accepted.

    Deliveries of one identifier in a batch are counted before the shuffle, so a number that holds a third of all rows
    costs one row per task and batch. Rows with neither number nor text have no identity and are left out. An empty
    batch gives no rows.
    """
    own = [order] if order else []
    decided = _swept(_counted(batch, order), [*own, "deliveries"], own, seen, seen_other, ranges=False)
    taken = F.col("accepted").cast("int")
    return decided.select(_producer("id").alias("producer"), _number("id").alias("number"), "other", "deliveries", taken.alias("accepted"), (F.col("deliveries") - taken).alias("redelivered"))


def ranges_after(batch: DataFrame, seen: DataFrame | None = None, order: str | None = None) -> DataFrame:
    """The seen ranges after a batch, straight from the sweep: (producer, block, lo, hi), disjoint, not adjacent within a block."""
    own = [order] if order else []
    return _swept(_counted(batch.filter(F.col("number").isNotNull()), order), own, own, seen, None, ranges=True)


def accepted_rows(rows: DataFrame, identity: Column, order: list[str], batch: str) -> DataFrame:
    """Exactly one row of each message, the first by `order` and then by all columns; rows without identity all stay.

    Each batch's deliveries of a message are reduced to its first row by partial aggregation; then the rows are swept in
    order against the ranges seen, and those whose number is not covered yet are accepted. Nulls sort first, repeated
    rows are one, an empty table stays empty.
    """
    cols = rows.columns
    ordered = F.struct(*(F.col(f"`{c}`") for c in [*order, *(c for c in cols if c not in order)]))
    keyed = rows.withColumn("__bare", identity)
    number = hex_number(F.col("__bare"))
    named = keyed.filter(F.col("__bare").isNotNull())
    first = named.groupBy(number.alias("id"), F.when(number.isNull(), F.col("__bare")).alias("other"), F.col(f"`{batch}`").alias("__batch")).agg(F.min(ordered).alias("__row"))
    kept = _swept(first.drop("__batch"), ["__row"], ["__row"], None, None, ranges=False).filter("accepted")
    return kept.select(*(F.col(f"__row.`{c}`").alias(c) for c in cols)).unionByName(keyed.filter(F.col("__bare").isNull()).select(*(F.col(f"`{c}`") for c in cols)))


def _close_up(ranges: DataFrame, bits: int) -> DataFrame:
    """Merges adjacent or overlapping ranges within blocks of 2^bits numbers."""
    w = Window.partitionBy("producer", "__at").orderBy("lo", "hi")
    before = F.max("hi").over(w.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.when(before.isNull() | (F.col("lo") > before + 1), 1).otherwise(0)
    return (
        ranges.withColumn("__at", _block(F.col("lo"), bits))
        .withColumn("__new", starts)
        .withColumn("__run", F.sum("__new").over(w))
        .groupBy("producer", "__at", "__run")
        .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        .select("producer", "lo", "hi")
    )


def merge_ranges(decisions: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """The seen ranges after `decisions`: (producer, block, lo, hi), disjoint, not adjacent within a block."""
    new = decisions.filter((F.col("accepted") == 1) & F.col("number").isNotNull()).select("producer", F.col("number").alias("lo"), F.col("number").alias("hi"))
    ranges = new if seen is None else new.unionByName(seen.select("producer", "lo", "hi"))
    return _close_up(ranges, BLOCK_BITS).withColumn("block", _block(F.col("lo"))).select("producer", "block", "lo", "hi")


def whole_ranges(seen: DataFrame) -> DataFrame:
    """Seen ranges joined up across block borders: (producer, lo, hi).

    Level by level only ranges that touch their block's border go on, at most two per block, so a group never
    holds more than 2^(BLOCK_BITS+1) ranges however long the sequence is.
    """
    done, open_ = None, seen.select("producer", "lo", "hi")
    for bits in LEVELS:
        if bits > BLOCK_BITS:
            open_ = _close_up(open_, bits)
        if bits >= SEQUENCE_BITS:
            break
        width = F.lit(1 << bits)
        touches = (F.pmod(F.col("lo"), width) == 0) | (F.pmod(F.col("hi") + 1, width) == 0)
        inside = open_.filter(~touches)
        done = inside if done is None else done.unionByName(inside)
        open_ = open_.filter(touches)
    return open_ if done is None else done.unionByName(open_)


def one_of_each(rows: DataFrame, identity: Column, order: list[str]) -> DataFrame:
    """Exactly one row of each message, the first by `order` and then by all columns; rows without identity all stay.

    The smallest row is taken by partial aggregation, so a message that holds a third of all rows is reduced before
    the shuffle; nothing is sorted per message. Nulls sort first, repeated rows are one, an empty table stays empty.
    """
    cols = rows.columns
    ordered = F.struct(*(F.col(f"`{c}`") for c in [*order, *(c for c in cols if c not in order)]))
    keyed = rows.withColumn("__id", identity)
    kept = keyed.filter(F.col("__id").isNotNull()).groupBy("__id").agg(F.min(ordered).alias("__row")).select(*(F.col(f"__row.`{c}`").alias(c) for c in cols))
    return kept.unionByName(keyed.filter(F.col("__id").isNull()).select(*(F.col(f"`{c}`") for c in cols)))
