"""Per-document text quality statistics, and documents that are no prose.

Two passes over the whole texts. The first learns from the corpus itself, without any fixed vocabulary, which words are
common in each language (by document frequency) and how letters follow one another (counts of letter pairs). The second
gives every text its statistics. Each statistic is ranked exactly among the documents of the same language: values are
counted, the counts sorted by range partitions, and the partitions' totals carried on as offsets. The shares of the
language's prose that are at least as extreme, the empirical tail probabilities, are combined over the statistics into
an outlier score. A text is no prose if it is an outlier and running sentences make up less than half of it.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.skew import partitions_of
from tidemark.session import cut

#: A stated language is one of the corpus if at least one in so many documents states it: at most this many languages.
LANGUAGE_SHARE = 256
#: A word is common in a language if it is in at least one in so many of its documents. So a language has at most this
#: many times as many common words as a document has distinct words in the mean.
COMMON_SHARE = 8
#: Language of texts that show none; they are ranked among the texts of all languages.
UNKNOWN = "und"

#: Statistics, and whether low (-1), high (1) or both (0) are odd.
STATISTICS = {"words": 0, "word_length": 0, "symbol_share": 1, "digit_share": 1, "ended_lines": -1, "common_words": -1, "distinct_words": 0, "letter_surprise": 1, "sentence_share": -1}
#: Weight of each statistic's surprise in the score: running sentences say most about the kind of a text, its size little.
WEIGHTS = {"words": 0.5, "word_length": 1.0, "symbol_share": 1.0, "digit_share": 1.0, "ended_lines": 1.0, "common_words": 1.0, "distinct_words": 0.5, "letter_surprise": 1.0, "sentence_share": 3.0}
#: Greatest surprise of a statistic: that of one prose text in a thousand. It is also the surprise of a value beyond all prose.
MOST_SURPRISE = math.log(1000)

_WORD = re.compile(r"\w+")
_ODD = re.compile(r"[^\w\s]+|\d+")
#: Text of Latin letters whose only marks and digits are ASCII, dashes and quotation marks aside.
_LATIN = re.compile("[\x00-\x7fÀ-ÖØ-öø-ÿĀ-ſ–—‘’“”…\xa0]*")
_ASCII_ODD = bytes(b for b in range(0x21, 0x7F) if not chr(b).isalpha() and chr(b) != "_")
_PARAGRAPH = re.compile(r"\n\s*\n")
#: Marks that may follow the one that ends a line or a sentence, and the marks that end them.
_CLOSERS, _LINE_ENDS, _SENTENCE_ENDS = "\"'”’»)]", frozenset(".!?:;…"), frozenset(".!?;")
_MARKER = re.compile(r"[\s>]*(?:[-*•+–—·]+\s|\[[ x]?\]|\(?\d{1,3}\s*[.)\-–:]\s|\(?[a-z]\)\s|#+\s)")
_LEADER = re.compile(r"\.{4,}|…{2,}|_{4,}")
_COLUMNS = re.compile(r"(?<=\S)\s{3,}(?=\S)")
_STOP = re.compile(r"[.!?;]+[\"'”’»)\]]*(?=\s|\Z)")


def _ends(stripped: str, marks: frozenset[str]) -> bool:
    """Whether a text without white space at its end ends in one of the marks, closing quotes and brackets aside."""
    return stripped.rstrip(_CLOSERS)[-1:] in marks


class _Short(dict):
    """Whether a word has at most three letters and nothing else; remembered, for the same words come again and again."""

    REMEMBERED = 1 << 18

    def __missing__(self, word: str) -> bool:
        if len(self) >= self.REMEMBERED:
            self.clear()
        found = self[word] = len(word) < 4 and word.isalpha()
        return found


_SHORT = _Short()


def _structured(line: str, solid: int, odd: int) -> bool:
    """Whether a line is an item, a record or a rule rather than part of a sentence.

    `solid`, `odd`: its characters that are no white space, and those that are digits or symbols.
    """
    if ("...." in line or "……" in line or "____" in line) and _LEADER.search(line):
        return True
    cells = max(line.count("|"), line.count("\t"), line.count(";"), len(_COLUMNS.findall(line)) if "   " in line else 0)
    if cells > 1 and len(_WORD.findall(line)) < 4 * (cells + 1):
        return True
    if odd > 0.4 * solid:
        return True
    bare = line.strip()
    if bare[:1] in "{[<" and bare[-1:] in "}]>,":
        return True
    mark = _MARKER.match(line)
    if mark:
        words = len(_WORD.findall(line, mark.end()))
        return words < 6 or words < 12 and not _ends(bare, _LINE_ENDS)
    return ": " in line and len(_WORD.findall(line)) < 5


def _running(unit: str, words: list[str], short: int) -> bool:
    """Whether a stretch up to a full stop, or to the end of its paragraph, is a running sentence.

    `short`: its words of at most three letters. In running text of any language they tie the others together.
    """
    n = len(words)
    if n < 5 or short < 0.09 * n or len(set(words)) < 0.35 * min(n, 120):
        return False
    commas = unit.count(",")
    if commas > 3 and n < 5 * (commas + 1):
        return False
    lines = unit.strip().count("\n") + 1
    if n > 80 or not _ends(unit.rstrip(), _SENTENCE_ENDS):
        return n >= 6 * lines and n >= 6
    return n >= 3.2 * lines


def _solid(text: str) -> int:
    return len("".join(text.split()))


def _odd(line: str) -> int:
    """Digits and symbols of a line; where all else is Latin, dashes and quotation marks do not count."""
    if line.isascii() or _LATIN.fullmatch(line):
        raw = line.encode()
        return len(raw) - len(raw.translate(None, _ASCII_ODD))
    return len("".join(_ODD.findall(line)))


#: Letters whose pairs are counted, Latin-1 letters with marks as the letters they are marks on: what is usual between
#: plain letters holds in languages that put other marks on them. Other letters say nothing about letters.
LETTERS = "abcdefghijklmnopqrstuvwxyz"
_SIZE = len(LETTERS) + 1
#: Pairs of letters that are held before they are counted.
_PAIRS_HELD = 1 << 20
_NUMBER = np.zeros(1 << 8, np.int32)
for _code in range(1 << 8):
    _NUMBER[_code] = LETTERS.find(unicodedata.normalize("NFD", chr(_code))[0]) + 1


def letter_pairs(lower: str) -> np.ndarray:
    """Numbers of the pairs of neighbouring letters of a text in lower case."""
    codes = _NUMBER[np.frombuffer(lower.encode("latin-1", "replace"), np.uint8)]
    left, right = codes[:-1], codes[1:]
    return (left * _SIZE + right)[(left > 0) & (right > 0)]


#: Part of the way from the corpus's letters to letters drawn at random, beyond which letters are no text. Prose of
#: languages the corpus lacks goes a sixth of the way, fingers running over a keyboard more than half.
RANDOM_SHARE = 0.45


@dataclass(frozen=True)
class Learned:
    """What the corpus teaches: the common words of each language, and how often each pair of letters occurs."""

    common: dict[str, frozenset[str]] = field(default_factory=dict)
    pairs: dict[int, int] = field(default_factory=dict)

    @cached_property
    def anywhere(self) -> frozenset[str]:
        """Words that are common in any language."""
        return frozenset().union(*self.common.values())

    @cached_property
    def _letters(self) -> tuple[np.ndarray, float, float]:
        """The surprise, in bits, of each pair's second letter after its first, and its mean over the corpus and over letters drawn at random."""
        n = np.zeros(_SIZE * _SIZE)
        n[list(self.pairs)] = list(self.pairs.values())
        n = n.reshape(_SIZE, _SIZE)
        seen = max(1, int((n.sum(0) > 0).sum()))
        bits = -np.log2((n + 1) / (n.sum(1, keepdims=True) + seen))
        share = n / max(1.0, n.sum())
        natural, drawn = float((share * bits).sum()), float((np.outer(share.sum(1), share.sum(0)) * bits).sum())
        return bits.ravel(), natural, drawn

    def letter_surprise(self, lower: str) -> float:
        """Mean surprise of a text's letters by those before them, in bits; 0 where no pair of letters occurs."""
        found = letter_pairs(lower)
        return float(self._letters[0][found].mean()) if len(found) else 0.0

    @property
    def suspicious(self) -> float:
        """Surprise up to which no considerable part of a text can be letters at random."""
        _, natural, drawn = self._letters
        return natural + (drawn - natural) / 4

    @property
    def random(self) -> float:
        """Surprise beyond which letters are no text: nearly half the way from the corpus's to that of letters drawn at random."""
        _, natural, drawn = self._letters
        return natural + RANDOM_SHARE * (drawn - natural)


def stated_language(stated: str | None) -> str:
    return (stated or "").strip().lower() or UNKNOWN


def learn(rows: DataFrame, text: str, lang: str) -> Learned:
    """Counts over all texts, reduced to what is frequent before it reaches the driver.

    That is at most LANGUAGE_SHARE languages, COMMON_SHARE times the mean number of distinct words of a document for
    each, and one count for each pair of LETTERS. Words and pairs are counted for each Arrow batch, then by partial
    aggregation.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words: dict[str, Counter] = {}
            sizes, pairs, held, size = Counter(), np.zeros(_SIZE * _SIZE, np.int64), [], 0
            for value, stated in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not value or value.isspace():
                    continue
                lower, own = value.lower(), stated_language(stated)
                sizes[own] += 1
                words.setdefault(own, Counter()).update(set(_WORD.findall(lower)))
                found = letter_pairs(lower)
                held.append(found)
                size += len(found)
                if size > _PAIRS_HELD:
                    pairs += np.bincount(np.concatenate(held), minlength=len(pairs))
                    held, size = [], 0
            if held:
                pairs += np.bincount(np.concatenate(held), minlength=len(pairs))
            some = np.flatnonzero(pairs).tolist()
            parts = [("documents", own, ("",), (n,)) for own, n in sizes.items()] + [("word", own, c.keys(), c.values()) for own, c in words.items()] + [("pair", "", map(str, some), pairs[some].tolist())]
            for kind, own, what, n in parts:
                what, n = pa.array(what, pa.string()), pa.array(n, pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([kind] * len(n), pa.string()), pa.array([own] * len(n), pa.string()), what, n], names=["kind", "lang", "what", "n"])

    counts = cut(rows.select(F.col(text), F.col(lang)).mapInArrow(run, "kind string, lang string, what string, n long").groupBy("kind", "lang", "what").agg(F.sum("n").alias("n")))
    documents = counts.filter("kind = 'documents'")
    total = documents.agg(F.sum("n")).first()[0] or 0
    sizes = {r["lang"]: r["n"] for r in documents.filter((F.col("lang") != UNKNOWN) & (F.col("n") * LANGUAGE_SHARE >= total)).collect()}
    if not sizes:
        languages: dict[str, frozenset[str]] = {}
    else:
        least = F.create_map(*(F.lit(x) for lang_, n in sizes.items() for x in (lang_, n)))[F.col("lang")]
        frequent = counts.filter((F.col("kind") == "word") & F.col("lang").isin(list(sizes))).filter(F.col("n") * COMMON_SHARE >= least)
        by: dict[str, set[str]] = {lang_: set() for lang_ in sizes}
        for r in frequent.select("lang", "what").collect():
            by[r["lang"]].add(r["what"])
        languages = {lang_: frozenset(w) for lang_, w in by.items()}
    pairs = {int(r["what"]): r["n"] for r in counts.filter("kind = 'pair'").select("what", "n").collect()}
    return Learned(languages, pairs)


def statistics_of(text: str, learned: Learned) -> tuple[dict[str, float], str | None]:
    """The statistics of a text, unrounded, and the language whose common words it has most of, if it has three.

    Every part of the text is read into words once: structured lines by themselves, the lines between them joined
    up to the next full stop or the end of the paragraph. Where the text's letters are suspicious, a stretch of letters
    at random is no sentence.
    """
    words: list[str] = []
    solid = lines = ended = running = 0
    lower = text.lower()
    surprise = learned.letter_surprise(lower)
    suspicious = surprise > learned.suspicious
    for paragraph in _PARAGRAPH.split(lower):
        kept = []
        for line in paragraph.split("\n"):
            own = _solid(line)
            if not own:
                continue
            solid, lines = solid + own, lines + 1
            ended += _ends(line.rstrip(), _LINE_ENDS)
            if _structured(line, own, _odd(line)):
                words += _WORD.findall(line)
            else:
                kept.append(line)
        if not kept:
            continue
        rest, at = "\n".join(kept), 0
        for end in [*(m.end() for m in _STOP.finditer(rest)), len(rest)]:
            unit, at = rest[at:end], end
            some = _WORD.findall(unit)
            if not some:
                continue
            short = sum(map(_SHORT.__getitem__, some))
            if _running(unit, some, short) and not (suspicious and learned.letter_surprise(unit) > learned.random):
                running += _solid(unit)
            words += some
    n, joined = len(words), "".join(words)
    digits = sum(map(joined.count, "0123456789"))
    common = [w for w in words if w in learned.anywhere]
    by = {lang: sum(map(own.__contains__, common)) for lang, own in learned.common.items()}
    best = max(by, key=lambda lang: (by[lang], lang)) if by else None
    most = by[best] if by else 0
    found = {
        "words": n,
        "word_length": len(joined) / n if n else 0.0,
        "symbol_share": (solid - len(joined)) / solid if solid else 0.0,
        "digit_share": digits / solid if solid else 0.0,
        "ended_lines": ended / lines if lines else 0.0,
        "common_words": most / n if n else 0.0,
        "distinct_words": len(set(words)) / n if n else 0.0,
        "letter_surprise": surprise,
        "sentence_share": running / solid if solid else 0.0,
    }
    return found, best if most >= 3 else None


def text_statistics(rows: DataFrame, key: str, text: str, lang: str, learned: Learned | None = None) -> DataFrame:
    """(key, lang, statistics…): one row for each text that isn't null or blank, statistics unrounded.

    lang is the language whose common words the text uses, else the stated one if it is one of the corpus, else 'und'.
    `learned`: by default what these very texts teach. Whole texts are read where they lie, in Arrow batches, without a
    shuffle. Null, empty and blank texts give no row, repeated rows each one; an empty table stays empty; other columns
    are not read.
    """
    learned = learned or learn(rows, text, lang)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, langs, values = [], [], {name: [] for name in STATISTICS}
            for i, (value, stated) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                if not value or value.isspace():
                    continue
                found, spoken = statistics_of(value, learned)
                at.append(i)
                said = stated_language(stated)
                langs.append(spoken or (said if said in learned.common else UNKNOWN))
                for name, x in found.items():
                    values[name].append(x)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(langs, pa.string()), *(pa.array(v, pa.int64() if name == "words" else pa.float64()) for name, v in values.items())], names=[key, "lang", *values])

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(F.col(key), F.col(text), F.col(lang)).mapInArrow(run, f"`{key}` {kind}, lang string, " + ", ".join(f"{name} {'long' if name == 'words' else 'double'}" for name in STATISTICS))


def exact_ranks(counts: DataFrame, group: list[str], value: str, n: str = "n", ranges: int = 32) -> DataFrame:
    """Adds `below`, `upto` and `total`: rows of the group with a smaller value, with one at most this, and in all.

    `counts` holds each value of a group once, with the number of rows that have it. It is sorted by range
    partitions; each partition counts for itself and starts from the totals of those before it, its offset. The
    partitioning is written down before it is used twice, so a task that runs again finds the same ranges. Nothing
    is sorted in one place: a group that holds most of the values spans many ranges.
    """
    spread = cut(counts.repartitionByRange(ranges, *group, value).withColumn("__range", F.spark_partition_id()))
    totals = spread.groupBy(*group, "__range").agg(F.sum(n).alias("__rows"))
    before = Window.partitionBy(*group).orderBy("__range")  # at most `ranges` rows of a group
    offsets = totals.withColumns({"__offset": F.sum("__rows").over(before) - F.col("__rows"), "total": F.sum("__rows").over(Window.partitionBy(*group))}).drop("__rows")
    within = Window.partitionBy(*group, "__range").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = spread.withColumn("__running", F.sum(n).over(within)).join(offsets, [*group, "__range"])
    return ranked.withColumns({"upto": F.col("__offset") + F.col("__running"), "below": F.col("__offset") + F.col("__running") - F.col(n)}).drop("__range", "__running", "__offset")


#: A value that more than one in so many of its group's documents have is sent to every task with its surprise: at
#: most this number of values for each statistic of a language. All others are joined by shuffle.
FREQUENT = 256
#: Share of running sentences from which a text is prose.
PROSE = 0.5
#: Score from which a text is an outlier of its language. Prose scores about 0.7 in the mean, by chance alone; a text
#: without sentences that is like prose in everything else scores about 2.1 and is none.
OUTLIER = 2.25


def _long(stats: DataFrame, *keep: str) -> DataFrame:
    """One row for each statistic of a text: (keep…, statistic, value)."""
    return stats.select(*keep, F.inline(F.array(*(F.struct(F.lit(name).alias("statistic"), F.col(name).cast("double").alias("value")) for name in STATISTICS))))


def tail_probabilities(stats: DataFrame) -> DataFrame:
    """(lang, statistic, value, surprise, frequent) for each value of a statistic in a language; 'und' stands for all documents.

    surprise: minus the logarithm of the share of the language's prose (its documents of mostly running sentences) that
    is at least as odd, at most MOST_SURPRISE, which also is that of values no prose reaches. Ranks are taken among prose
    only, so they stay the same however much of a language is something else; a language without prose finds every
    value odd. Every language is ranked by itself, at every size. frequent: see FREQUENT.
    """
    prose = F.sum(F.when(F.col("__prose"), 1).otherwise(0)).alias("n")
    marked = stats.withColumn("__prose", F.col("sentence_share") >= PROSE)
    counts = cut(_long(marked, "lang", "__prose").groupBy("lang", "statistic", "value").agg(prose, F.count(F.lit(1)).alias("all")))
    everyone = counts.groupBy(F.lit(UNKNOWN).alias("lang"), "statistic", "value").agg(F.sum("n").alias("n"), F.sum("all").alias("all"))
    both = counts.filter(F.col("lang") != UNKNOWN).unionByName(everyone)
    ranked = exact_ranks(both, ["lang", "statistic"], "value", ranges=max(32, partitions_of(stats.sparkSession)))
    low, high = F.col("upto") / F.col("total"), (F.col("total") - F.col("below")) / F.col("total")
    direction = F.create_map(*(F.lit(x) for pair in STATISTICS.items() for x in pair))[F.col("statistic")]
    tail = F.when(direction < 0, low).when(direction > 0, high).otherwise(F.least(F.lit(1.0), 2 * F.least(low, high)))
    surprise = F.when((F.col("total") > 0) & (tail > 0), F.least(-F.log(tail), F.lit(MOST_SURPRISE))).otherwise(F.lit(MOST_SURPRISE))
    sizes = counts.filter("statistic = 'words'").groupBy("lang").agg(F.sum("all").alias("documents"))
    sizes = sizes.filter(F.col("lang") != UNKNOWN).unionByName(sizes.agg(F.lit(UNKNOWN).alias("lang"), F.coalesce(F.sum("documents"), F.lit(0)).alias("documents")))
    return ranked.join(F.broadcast(sizes), "lang").select("lang", "statistic", "value", surprise.alias("surprise"), (F.col("all") * FREQUENT > F.col("documents")).alias("frequent"))


def outlier_scores(stats: DataFrame, only: Column | None = None) -> DataFrame:
    """`stats` with `score`: the weighted mean surprise over all statistics. `only`: the texts to score, ranked among all the same."""
    marked = cut(stats.withColumn("__id", F.monotonically_increasing_id()))  # written down, so a task that runs again finds the same ids
    own = cut(tail_probabilities(marked))
    on = ["lang", "statistic", "value"]
    asked = marked if only is None else marked.filter(only)
    seen = _long(asked, "__id", "lang").join(F.broadcast(own.filter("frequent").drop("frequent")), on, "left")
    rest = seen.filter("surprise is null").drop("surprise").join(own.filter("not frequent").drop("frequent"), on)
    both = seen.filter("surprise is not null").select("__id", "statistic", "surprise").unionByName(rest.select("__id", "statistic", "surprise"))
    weight = F.create_map(*(F.lit(x) for pair in WEIGHTS.items() for x in pair))[F.col("statistic")]
    each = both.groupBy("__id").agg((F.sum(weight * F.col("surprise")) / sum(WEIGHTS.values())).alias("score"))
    return asked.join(each, "__id").select(*stats.columns, "score")


def no_sentences() -> Column:
    """Whether less than half of a text is running sentences."""
    return F.col("sentence_share") < PROSE


def no_prose() -> Column:
    """Whether a scored text is an outlier and consists for the most part of something other than running sentences."""
    return (F.col("score") >= OUTLIER) & no_sentences()
