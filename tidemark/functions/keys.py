"""Business-key hashing: an injective encoding of key components under SHA-256, as a Column and in Python."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Between encoded components; tags of null, empty, white-space-only and other components. (fixed values)
DELIMITER = "||"
NULL_TAG, EMPTY_TAG, BLANK_TAG, TEXT_TAG = "N", "E", "W", "S"
#: Characters that str.strip() removes: 29 code points. (fixed values)
STRIPPED = "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_CLASS = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in STRIPPED) + "]"
_OUTER = rf"\A{_CLASS}+|{_CLASS}+\z"

#: Code points that Spark's upper() and Python's str.upper() map differently here: (first, last). (fixed values)
CASE_DIVERGENT = ((0x019B, 0x019B), (0x0264, 0x0264), (0x1C8A, 0x1C8A), (0xA7CD, 0xA7CD), (0xA7DB, 0xA7DB), (0x10D70, 0x10D85))
CASE_DIVERGENT_CLASS = "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in CASE_DIVERGENT) + "]"


class KeyRefused(ValueError):
    """A business key that can't be hashed as declared."""


def stripped(text: Column) -> Column:
    """`text` without outer Unicode white space, as str.strip() has it."""
    return F.regexp_replace(text, _OUTER, "")


def encoded(component: Column) -> Column:
    """One component, encoded so that different components never look alike."""
    plain = F.upper(stripped(component))
    tagged = F.concat(F.lit(TEXT_TAG), F.length(plain).cast("string"), F.lit(":"), plain)
    return F.when(component.isNull(), NULL_TAG).when(component == "", EMPTY_TAG).when(plain == "", BLANK_TAG).otherwise(tagged)


def hash_key(*components: Column) -> Column:
    """SHA-256 hex digest of the encoded components; at least one."""
    if not components:
        raise KeyRefused("a business key has at least one component")
    return F.sha2(F.concat_ws(DELIMITER, *(encoded(c) for c in components)), 256)


def hash_key_of(components: Sequence[str | None]) -> str:
    """The same digest in Python."""
    if isinstance(components, str) or not components:
        raise KeyRefused("pass a non-empty sequence of components, not a text")
    parts = []
    for c in components:
        plain = None if c is None else c.strip().upper()
        parts.append(NULL_TAG if c is None else EMPTY_TAG if c == "" else BLANK_TAG if plain == "" else f"{TEXT_TAG}{len(plain)}:{plain}")
    return hashlib.sha256(DELIMITER.join(parts).encode()).hexdigest()


def zero_padded(text: Column, width: int) -> Column:
    """`text` padded with zeros on the left; the query fails on a longer value, for cutting it would merge two keys."""
    if width <= 0:
        raise KeyRefused(f"width must be positive, not {width}")
    too_long = F.raise_error(F.concat(F.lit("key longer than its width "), F.lit(str(width)), F.lit(": "), text)).cast("string")
    return F.when(F.length(text) > width, too_long).otherwise(F.lpad(text, width, "0"))


def zero_padded_of(text: str, width: int) -> str:
    """The same in Python."""
    if width <= 0 or len(text) > width:
        raise KeyRefused(f"{text!r} does not fit into {width} characters")
    return text.rjust(width, "0")


def refuse_non_strings(rows: DataFrame, columns: Sequence[str]) -> None:
    """Refuses key columns that are missing or not STRING: their rendering as text would decide the key."""
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    wrong = [c for c in columns if not isinstance(kinds.get(c), T.StringType)]
    if wrong:
        raise KeyRefused(f"key columns missing or not STRING: {', '.join(wrong)}")
