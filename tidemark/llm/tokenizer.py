"""Byte-level BPE as a bounded-lookahead streaming transducer.

The encoding of a text by a merge list is the only division into tokens in which no two neighbours would have been
merged across their border. So the encoding of every prefix is known from its last token alone: that token ends at
the prefix's end and fits the last token of the prefix before it. A later token can begin at most the length of the
longest token back: that window is the lookahead which suffices to tell what may still change. Where the encodings
of all prefixes that end inside the window agree, the tokens are stable and emitted; what remains is the window and
the stretch on which they still differ, whatever the length of the text.

Texts are split by the vocabulary's pattern before merging. Encodings of short pieces are remembered per worker.
"""

from __future__ import annotations

import codecs
import json
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: White space as the pattern's \s has it: the Unicode property White_Space. (fixed values)
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Pieces between which the pattern always splits: a word with the white space before it. No alternative of the
#: pattern goes from other characters on to white space, and what follows such a border doesn't change what precedes.
PIECE = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
#: Longer pieces are encoded by streaming and not remembered; pieces remembered per worker.
LONG_PIECE = 64
REMEMBERED = 1 << 19
#: Characters from which a text's pieces are no longer listed but met one by one.
LONG_TEXT = 1 << 20


def byte_alphabet() -> dict[str, int]:
    """Characters that stand for bytes in a byte-level vocabulary: printable Latin-1 for itself, the others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(others)}


class Merges:
    """A merge list: the bytes of each token, how it was merged, and when."""

    def __init__(self, vocabulary: dict[str, int], merges: Iterable[tuple[str, str]], pattern: str, specials: frozenset[int] = frozenset()):
        alphabet = byte_alphabet()
        self.bytes = {i: bytes(alphabet[c] for c in t) for t, i in vocabulary.items() if i not in specials}
        self.of_byte = {b[0]: i for i, b in self.bytes.items() if len(b) == 1}
        self.pair: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = {}
        for rank, (left, right) in enumerate(merges):
            a, b, merged = vocabulary[left], vocabulary[right], vocabulary[left + right]
            if (a, b) not in self.pair:
                self.pair[a, b] = rank
                if merged not in self.parts:
                    self.parts[merged], self.rank[merged] = (a, b), rank
        self.longest = max(map(len, self.bytes.values()))
        self.pattern = regex.compile(pattern)
        self._fits: dict[int, bool] = {}
        self._size = max(self.bytes) + 1
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for i, b in self.bytes.items():
            if len(b) == 1 or i in self.parts:
                self.automaton.add_word(b.decode("latin-1"), (i, len(b)))
        self.automaton.make_automaton()

    @property
    def lookahead(self) -> int:
        """Bytes after which no token that covers an earlier position can begin later: the window of live borders."""
        return self.longest

    @property
    def lookahead_bound(self) -> int:
        """Bytes after which every border of this merge list is stable, whatever the text."""
        return len(self.parts) * self.longest

    def fits(self, a: int, b: int) -> bool:
        """Whether the border between tokens a and b stays: at no time of the merging would a merge cross it.

        Goes back in time over the last part of a and the first part of b. A merge across the border wins over a
        later one, and over the same one further right, but not over the same one further left.
        """
        key = a * self._size + b
        known = self._fits.get(key)
        if known is None:
            if len(self._fits) >= 1 << 21:
                self._fits.clear()
            known = self._fits[key] = self._fits_now(a, b)
        return known

    def _fits_now(self, a: int, b: int) -> bool:
        never = 1 << 60
        left_gone, right_gone = never, never
        while True:
            across = self.pair.get((a, b))
            if across is not None and across < left_gone and across <= right_gone:
                return False
            made_a, made_b = self.rank.get(a, -1), self.rank.get(b, -1)
            if made_a < 0 and made_b < 0:
                return True
            if made_a > made_b:
                left_gone, a = made_a, self.parts[a][1]
            else:
                right_gone, b = made_b, self.parts[b][0]

    def stream(self, blocks: Iterable[bytes]) -> Iterator[int]:
        """Token ids of one pattern match that arrives in blocks, each emitted once it is stable."""
        base = 0  # everything before this border is emitted
        last = [-1]  # last[i - base]: the last token of the encoding of the prefix of length i
        found = None
        fits, settle = self.fits, 4 * self.longest
        due = settle
        for block in blocks:
            text = block.decode("latin-1")
            if found is None:
                found = self.automaton.iter(text)
            else:
                found.set(text, False)  # goes on where the block before ended, positions too
            for end, (token, size) in found:
                start = end + 1 - size - base
                if len(last) > end + 1 - base or start < 0:
                    continue  # the one token that fits here is known, or this one would begin in what is emitted
                if end + 1 == size or fits(last[start], token):
                    last.append(token)
                    if len(last) > due:
                        emitted, base, last = self._settled(base, last)
                        due = len(last) + settle
                        yield from emitted
        i, rest = len(last) - 1, []
        while i > 0:
            rest.append(last[i])
            i -= len(self.bytes[last[i]])
        yield from reversed(rest)

    def whole(self, data: bytes) -> list[int]:
        """Token ids of one short pattern match, without a window."""
        last, fits, size = [-1], self._fits, self._size
        ready = 0
        for end, (token, length) in self.automaton.iter(data.decode("latin-1")):
            if end < ready:
                continue
            start = end + 1 - length
            if start:
                fit = fits.get(last[start] * size + token)
                if not (self.fits(last[start], token) if fit is None else fit):
                    continue
            last.append(token)
            ready += 1
        ids, i = [], ready
        while i:
            ids.append(last[i])
            i -= len(self.bytes[last[i]])
        ids.reverse()
        return ids

    def _settled(self, base: int, last: list[int]) -> tuple[list[int], int, list[int]]:
        """The tokens before the last border on which all live prefixes agree, that border, and what is left."""
        sizes = self.bytes
        live = {i for i in range(max(0, len(last) - self.longest), len(last))}
        while len(live) > 1:
            i = max(live)
            live.discard(i)
            live.add(i - len(sizes[last[i]]))
        (border,) = live
        emitted, i = [], border
        while i > 0:
            emitted.append(last[i])
            i -= len(sizes[last[i]])
        return emitted[::-1], base + border, last[border:]


class Encoder(dict):
    """Encodes and decodes texts by one merge list. A mapping of pieces to their ids, packed as 32-bit integers; a
    piece that isn't known yet is encoded and, if it is short, remembered."""

    def __init__(self, merges: Merges, block: int = 1 << 16):
        super().__init__()
        self.merges, self.block = merges, block

    def _streamed(self, piece: str) -> Iterator[int]:
        for match in self.merges.pattern.finditer(piece):
            begin, end = match.span()
            if end - begin <= LONG_PIECE:
                own = match.group()
                yield from array("i", self.get(own) or self._match(own))
            else:
                yield from self.merges.stream(piece[i : min(i + self.block, end)].encode() for i in range(begin, end, self.block))

    def _match(self, match: str) -> bytes:
        """Ids of one short match of the pattern, which as a piece of its own has the same ids."""
        if len(self) >= REMEMBERED:
            self.clear()
        packed = self[match] = array("i", self.merges.whole(match.encode())).tobytes()
        return packed

    def __missing__(self, piece: str) -> bytes:
        """Ids of one piece between borders at which the pattern always splits."""
        if len(piece) > LONG_PIECE:
            return array("i", self._streamed(piece)).tobytes()
        letters = piece[1:] if piece[0] == " " else piece
        if letters.isalpha():  # one match: letters with a space before them
            return self._match(piece)
        matches = self.merges.pattern.findall(piece)
        if len(matches) == 1:
            return self._match(piece)
        packed = b"".join([self.get(m) or self._match(m) for m in matches])
        self[piece] = packed
        return packed

    def packed(self, text: str | None) -> bytes:
        """Ids of a text, packed; null and empty texts have none."""
        if not text:
            return b""
        if len(text) < LONG_TEXT:
            return b"".join(map(self.__getitem__, PIECE.findall(text)))
        whole = bytearray()
        for match in PIECE.finditer(text):
            whole += self[match.group()]
        return bytes(whole)

    def encode(self, text: str | None) -> Iterator[int]:
        """Ids of a text, as they become stable; null and empty texts have none."""
        for match in PIECE.finditer(text or ""):
            piece = match.group()
            yield from self._streamed(piece) if len(piece) > LONG_PIECE else array("i", self[piece])

    def decode(self, ids: Iterable[int], at_once: int = 4096) -> Iterator[str]:
        """Text of ids, as its characters become complete: an incremental UTF-8 decoder keeps the open bytes between
        stretches of `at_once` ids. Unknown ids have no bytes."""
        state = codecs.getincrementaldecoder("utf-8")("replace")
        of, ids = self.merges.bytes, iter(ids)
        while stretch := list(islice(ids, at_once)):
            yield state.decode(b"".join([of.get(i, b"") for i in stretch]))
        yield state.decode(b"", True)


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """The encoder of a byte-level vocabulary file (json with vocab and merges), once per worker."""
    with open(path, encoding="utf-8") as file:
        stated = json.load(file)
    model, specials = stated["model"], frozenset(t["id"] for t in stated["added_tokens"] if t["special"])
    if model["type"] != "BPE" or stated["pre_tokenizer"]["type"] != "ByteLevel" or stated["normalizer"]:
        raise ValueError(f"{path} is no byte-level BPE")
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    return Encoder(Merges(model["vocab"], merges, BYTE_LEVEL_PATTERN, specials))


#: The pattern by which byte-level vocabularies split texts. (fixed value)
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def vocabulary_path(name: str = "byte_bpe_50k.json", folder: str | None = None) -> str:
    """Place of a vocabulary file: in `folder`, by default that of the installed public tokenizers."""
    if folder is None:
        import public_tokenizers

        return public_tokenizers.path(name)
    return f"{folder}/{name}"


def encode_texts(rows: DataFrame, key: str, text: str, folder: str | None = None, name: str = "byte_bpe_50k.json") -> DataFrame:
    """(key, ids): every row's text as the list of its token ids, without special tokens.

    Null and empty texts have the empty list. The strings of special tokens are ordinary text. Rows are encoded
    where they are read, in Arrow batches, without a shuffle; repeated rows each come out; an empty table stays
    empty; other columns are not read. A vocabulary folder must be readable under the same path by all executors.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(vocabulary_path(name, folder))
        for batch in batches:
            packed = [own.packed(text) for text in batch.column(1).to_pylist()]
            ends = np.cumsum([0, *(len(p) >> 2 for p in packed)], dtype=np.int64)
            if ends[-1] >= 1 << 31:
                raise ValueError("more than 2^31 token ids in one batch; lower spark.sql.execution.arrow.maxRecordsPerBatch")
            ids = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(packed))])
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), ids)
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=[key, "ids"])

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(F.col(key), F.col(text)).mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def decode_ids(rows: DataFrame, key: str, ids: str, folder: str | None = None, name: str = "byte_bpe_50k.json") -> DataFrame:
    """(key, text): every row's ids as text; null and empty lists give the empty text, incomplete characters U+FFFD."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(vocabulary_path(name, folder))
        for batch in batches:
            lists = batch.column(1)
            ids, ends, empty = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_pylist(), lists.is_null().to_pylist()
            texts = ["" if null else "".join(own.decode(ids[i:j].tolist())) for i, j, null in zip(ends, ends[1:], empty, strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[key, "text"])

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(F.col(key), F.col(ids)).mapInArrow(run, f"`{key}` {kind}, text string")
