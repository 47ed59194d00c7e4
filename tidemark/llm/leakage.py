"""Evaluation texts leaking into training text: Wu-Manber search for many passages at once, over words.

A text is read as its words: runs of letters or digits without case and accents. Every stretch of `length` words
of a test item is a pattern. The search looks at the last block of two words of a window: a shift table tells how
far the window can move before that block could be part of a pattern, most often the whole window's length; where
it can't move, the block's bucket, divided by the window's first block, holds the patterns to compare word by word.
"""

from __future__ import annotations

import re
import sys
import unicodedata
import uuid
from array import array
from bisect import bisect_right
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of test items searched for in one pass over the texts; more are searched in blocks of items of this size.
WORDS_A_PASS = 2_000_000
#: Words of a block, and the odd number that spreads its first word's number over the hashes.
BLOCK, SPREAD = 2, 0x9E3779B1


def _mark_ranges(first: int, last: int) -> str:
    """All combining marks from first to last, as ranges of a character class."""
    ranges: list[list[int]] = []
    for c in range(first, last + 1):
        if unicodedata.category(chr(c)) in ("Mn", "Me"):
            if ranges and ranges[-1][1] == c - 1:
                ranges[-1][1] = c
            else:
                ranges.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)


class Words:
    """Words of texts: runs of letters or digits, with the marks on them, in plain form. Remembers forms per worker."""

    REMEMBERED = 1 << 19

    def __init__(self):
        low, high = _mark_ranges(0, 0xFFFF), _mark_ranges(0x10000, sys.maxunicode)
        self.run = re.compile(f"[\\w{low}{high}]+")
        self.marks = re.compile(f"[{low}{high}]+")
        # classes within the first plane are looked up in a bitmap, the others range by range
        self.low_marks, self.high = re.compile(f"[{low}]"), re.compile("[\U00010000-\U0010ffff]")
        self.parts = re.compile(r"\w+")
        self.plain: dict[str, str] = {}
        self.several: set[str] = set()  # runs whose plain form isn't one word

    def _marked(self, text: str) -> bool:
        return not text.isascii() and bool(self.low_marks.search(text) or self.high.search(text) and self.marks.search(text))

    def _plain(self, run: str) -> str:
        if len(self.plain) >= self.REMEMBERED:
            self.plain.clear()
            self.several.clear()
        form = self.marks.sub("", unicodedata.normalize("NFKD", run).casefold())
        if not form.isalnum():
            form = " ".join(self.parts.findall(form))
            self.several.add(run)
        self.plain[run] = form
        return form

    def of(self, text: str | None) -> list[str]:
        """The words of a text, none of a null one. An underscore separates words like punctuation."""
        if not text:
            return []
        runs = (self.run if self._marked(text) else self.parts).findall(text.replace("_", " ") if "_" in text else text)
        known, plain = self.plain.get, self._plain
        words = [known(r) or plain(r) for r in runs]
        if self.several and not self.several.isdisjoint(runs):
            return [w for form in words for w in form.split()]
        return words


@lru_cache(maxsize=1)
def _words() -> Words:
    return Words()


def words_of(text: str | None) -> list[str]:
    """Words of a text without case, accents and compatibility forms; none of a null text."""
    return _words().of(text)


class Passages:
    """Test items as numbers: their words numbered by a vocabulary and laid end to end, and where each item begins."""

    def __init__(self):
        self.vocabulary: dict[str, int] = {}
        self.flat, self.begins, self.items = array("i"), array("q"), []

    def add(self, item: int, words: Sequence[str]) -> None:
        number = self.vocabulary.setdefault
        self.begins.append(len(self.flat))
        self.items.append(item)
        self.flat.extend([number(w, len(self.vocabulary)) for w in words])


class WuManber:
    """Shift table and buckets for all passages of `length` words of some test items.

    Both tables are arrays over a hash of two-word blocks, so a passage costs some 30 bytes besides its words' numbers:
    the shift of a hash is the least of its blocks', and a bucket lists the places in `flat` where its passages begin.
    """

    def __init__(self, passages: Passages, length: int):
        if length < BLOCK:
            raise ValueError(f"patterns need at least {BLOCK} words")
        self.length, self.passages, self.numbers = length, passages, passages.vocabulary.get
        flat, begins = np.asarray(passages.flat, np.int32), np.asarray(passages.begins, np.int64)
        ends = np.append(begins[1:], len(flat)) if len(begins) else begins
        inside = [np.arange(b, e - length + 1) for b, e in zip(begins.tolist(), ends.tolist(), strict=True) if e - b >= length]
        starts = np.concatenate(inside) if inside else np.zeros(0, np.int64)
        self.patterns = len(starts)
        bits = max(10, int(self.patterns * 4).bit_length())
        self.mask = (1 << bits) - 1
        shift = np.full(1 << bits, length - BLOCK + 1, np.uint8 if length < 255 else np.int32)
        for end in range(length - 1, BLOCK - 2, -1):
            np.minimum.at(shift, self._hashes(flat, starts + end), length - 1 - end)
        suffix = self._hashes(flat, starts + length - 1)
        order = np.argsort(suffix, kind="stable")
        self.places = array("q", starts[order].tobytes())
        self.index = array("q", np.concatenate([[0], np.cumsum(np.bincount(suffix, minlength=1 << bits))]).astype(np.int64).tobytes())
        self.shift = shift.tobytes() if shift.dtype == np.uint8 else shift.tolist()

    def _hashes(self, flat: np.ndarray, at: np.ndarray) -> np.ndarray:
        return ((flat[at - 1].astype(np.int64) * SPREAD) ^ flat[at]) & self.mask

    def search(self, words: list[str]) -> set[int]:
        """Items of which a passage occurs among the words."""
        found: set[int] = set()
        ids = array("i", [self.numbers(w, -1) for w in words])
        n, length, shift, mask, flat = len(ids), self.length, self.shift, self.mask, self.passages.flat
        at = length - 1
        while at < n:
            last, before = ids[at], ids[at - 1]
            if last < 0 or before < 0:  # no passage holds this word: go on behind it
                at += length if last < 0 else length - 1
                continue
            key = (before * SPREAD ^ last) & mask
            step = shift[key]
            if step:
                at += step
                continue
            begin = at - length + 1
            for i in range(self.index[key], self.index[key + 1]):
                place = self.places[i]
                if flat[place] == ids[begin] and flat[place : place + length] == ids[begin : at + 1]:
                    found.add(self.passages.items[bisect_right(self.passages.begins, place) - 1])
            at += 1
        return found


def blocks_of_items(items: DataFrame, item: str, text: str, length: int) -> Iterator[Passages]:
    """The test items in blocks of at most WORDS_A_PASS words (one longer item is a block of its own), one block at a time."""
    block = Passages()
    for row in items.select(item, text).filter(F.col(item).isNotNull()).toLocalIterator():
        words = words_of(row[1])
        if len(words) < length:
            continue
        if block.items and len(block.flat) + len(words) > WORDS_A_PASS:
            yield block
            block = Passages()
        block.add(row[0], words)
    yield block


#: Tables of the block searched last, kept by each Python worker for its next task.
_BUILT: dict[tuple, WuManber] = {}


def _tables(key: tuple, passages: Callable[[], Passages], length: int) -> WuManber:
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = WuManber(passages(), length)
    return _BUILT[key]


def find_leaks(corpus: DataFrame, key: str, text: str, items: DataFrame, item: str, item_text: str, length: int = 12) -> DataFrame:
    """(key, item): corpus rows that hold at least `length` consecutive words of a test item, in order, with no others between.

    The test items are the stated query set: they go to every worker in blocks of bounded size, each block against all
    corpus rows, whole texts, without a shuffle. The driver holds one block at a time, on its way to the broadcast's
    file; a worker builds a block's tables once. Items of fewer words leak nowhere; null texts hold nothing; words in
    several items are reported for each; a repeated corpus row comes out again; without test items there are no rows.
    """
    kind, item_kind = corpus.schema[key].dataType.simpleString(), items.schema[item].dataType.simpleString()
    texts = corpus.select(F.col(key), F.col(text)).filter(F.col(text).isNotNull())
    context = corpus.sparkSession.sparkContext
    found = None
    for block in blocks_of_items(items, item, item_text, length):
        shared = context.broadcast(block)
        name = (context.applicationId, uuid.uuid4().hex, length)

        def run(batches: Iterator[pa.RecordBatch], shared=shared, name=name) -> Iterator[pa.RecordBatch]:
            tables = _tables(name, lambda: shared.value, length)
            for batch in batches:
                rows, named = [], []
                for i, value in enumerate(batch.column(1)):
                    leaked = tables.search(words_of(value.as_py()))
                    rows.extend([i] * len(leaked))
                    named.extend(sorted(leaked))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(named, pa.from_numpy_dtype("int64") if item_kind == "bigint" else None)], names=[key, item])

        part = texts.mapInArrow(run, f"`{key}` {kind}, `{item}` {item_kind}")
        found = part if found is None else found.unionByName(part)
    return found


def leak_report(leaks: DataFrame, key: str, item: str, items: DataFrame, about: Sequence[str]) -> DataFrame:
    """Every leaked test item with the number of corpus rows that hold it and its columns `about`."""
    counted = leaks.groupBy(item).agg(F.countDistinct(key).alias("documents"))
    return items.select(item, *about).join(counted, item)
