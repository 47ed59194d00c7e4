"""Canonical forms of identifiers and registry attributes: what two spellings of one value have in common."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def company_key(text: Column) -> Column:
    """Company key as INT: the digits of `text`, padded to eight, or the first eight of more; null without digits."""
    digits = F.regexp_replace(text, "[^0-9]", "")
    return F.when(digits != "", F.substring(digits, 1, 8).cast("int"))


def company_text(key: Column) -> Column:
    """Eight-digit text of a company key."""
    return F.lpad(key.cast("string"), 8, "0")


def message_id(text: Column) -> Column:
    """Identifier without hyphens and white space, in lower case; blank equals null."""
    bare = F.lower(F.regexp_replace(text, r"[-\s]", ""))
    return F.when(bare != "", bare)


def hex_number(bare: Column) -> Column:
    """The 64-bit number that sixteen hex digits spell, as a signed LONG; null for anything else."""
    return F.when(bare.rlike(r"\A[0-9a-f]{16}\z"), F.conv(bare, 16, -10).cast("long"))


def hex_text(number: Column) -> Column:
    """Sixteen lower-case hex digits of a LONG; the inverse of `hex_number`."""
    return F.lpad(F.lower(F.hex(number)), 16, "0")


def attribute(text: Column) -> Column:
    """Registry attribute without outer or repeated white space and letter case; null becomes blank."""
    return F.upper(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " ")))


def amount(text: Column) -> Column:
    """Amount text (decimal mark and two digits at its end) as digits of its hundredths, null becomes blank."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^0-9-]", "")
    return F.regexp_replace(bare, r"\A(-?)0+(?=[0-9])", "$1")


#: Weights of the two check digits of a full fourteen-digit key. (fixed values)
FIRST_WEIGHTS = (5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2)
SECOND_WEIGHTS = (6, *FIRST_WEIGHTS)


def check_digits(twelve: Column) -> Column:
    """The two check digits (modulo 11) of a key's first twelve digits; null unless there are exactly twelve."""

    def digit(text: Column, weights: tuple[int, ...]) -> Column:
        total = F.lit(0)
        for i, w in enumerate(weights):
            total = total + F.substring(text, i + 1, 1).cast("int") * w
        rest = total % 11
        return F.when(rest < 2, F.lit("0")).otherwise((11 - rest).cast("string"))

    first = digit(twelve, FIRST_WEIGHTS)
    return F.when(twelve.rlike(r"\A[0-9]{12}\z"), F.concat(first, digit(F.concat(twelve, first), SECOND_WEIGHTS)))
