"""Rows that fail to parse: minimum-cost error parse of delimited records.

A record is parsed at the least cost of edits that insert or delete quotes and delimiters, so that it has the contract's
number of fields. One dynamic program covers both kinds. Its cost is the pair (quote edits, delimiter edits), compared
in this order: how a record divides into fields is settled by its quotes, and a delimiter edit must not repair what is
wrong with a quote. For the same reason it leaves every quote its role: a deleted delimiter joins two fields, an inserted
one adds an empty field. A record whose parse costs nothing and whose fields have valid values loads; otherwise the edit
operations, or the value, state the reason.

Only the sequence of quotes, delimiters and runs of other characters matters to the parse. The dynamic program
runs over that skeleton in Arrow batches and is remembered per distinct skeleton; fields are cut out in the JVM.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: States of the parser: at the start of a field, in an unquoted field, inside quotes, after a quote inside quotes.
START, PLAIN, QUOTED, AFTER = range(4)
#: What a quote ("), a delimiter (;) and other content (x) lead to without cost; content can't follow a closing quote.
STEP = {
    '"': (QUOTED, PLAIN, AFTER, QUOTED),
    ";": (START, START, QUOTED, START),
    "x": (PLAIN, PLAIN, QUOTED, None),
}
ENDS = (START, PLAIN, AFTER)
FAR = 1 << 30

PARSE = T.StructType([T.StructField("quote_edits", T.IntegerType()), T.StructField("fields", T.IntegerType()), T.StructField("delimiter_edits", T.IntegerType()), T.StructField("edits", T.StringType())])


def _quote_costs(skeleton: str) -> list[int]:
    """Least number of quote edits with which the parse can be in each state after the whole skeleton."""
    cost = [0, FAR, FAR, FAR]
    for token in skeleton:
        # a quote inserted before the token, then the token, or a quote deleted
        ready = list(cost)
        for state in range(4):
            if cost[state] < FAR:
                to = STEP['"'][state]
                ready[to] = min(ready[to], cost[state] + 1)
        after = [c + 1 for c in cost] if token == '"' else [FAR] * 4
        for state in range(4):
            to = STEP[token][state]
            if to is not None and ready[state] < after[to]:
                after[to] = ready[state]
        cost = after
    return [min(cost[AFTER], cost[QUOTED] + 1) if s == AFTER else c for s, c in enumerate(cost)]


def _free_fields(skeleton: str) -> int:
    """Number of fields of a skeleton that parses without quote edits: its zero-cost path is the only one."""
    state, fields = START, 1
    for token in skeleton:
        fields += token == ";" and state != QUOTED
        state = STEP[token][state]
    return fields


def _repair(skeleton: str, wanted: int) -> tuple[int, int, str]:
    """Least edits with which the skeleton has `wanted` fields: (fields without the delimiter edits, delimiter edits, quote operations).

    States are a parser state and the number of fields so far, at most `wanted`: surplus delimiters are deleted where
    they occur, missing ones inserted at the end. So costs are exact, and the states of a token are bounded, however
    many fields the record has.
    """
    best = {(START, 1): (0, 0, None)}
    layers = []
    for at, token in enumerate(skeleton):
        ready: dict = {key: (quotes, surplus, (key, "")) for key, (quotes, surplus, _) in best.items()}
        for (state, count), (quotes, surplus, _) in best.items():
            to = (STEP['"'][state], count)
            if to not in ready or ready[to][:2] > (quotes + 1, surplus):
                ready[to] = (quotes + 1, surplus, ((state, count), f"+quote@{at}"))
        after: dict = {}
        for (state, count), (quotes, surplus, back) in ready.items():
            to = STEP[token][state]
            if to is None:
                continue
            splits = token == ";" and state != QUOTED
            ways = [((to, count), quotes, surplus + splits)]  # a delimiter deleted, or anything else taken
            if splits and count < wanted:
                ways.append(((to, count + 1), quotes, surplus))
            for key, *cost in ways:
                if key not in after or after[key][:2] > tuple(cost):
                    after[key] = (*cost, back)
        if token == '"':
            for key, (quotes, surplus, _) in best.items():
                if key not in after or after[key][:2] > (quotes + 1, surplus):
                    after[key] = (quotes + 1, surplus, (key, f"-quote@{at}"))
        layers.append(after)
        best = after
    ends = {key: (quotes + (key[0] == QUOTED), surplus + wanted - key[1]) for key, (quotes, surplus, _) in best.items()}
    key = min(ends, key=lambda k: (*ends[k], k))
    operations = [f"+quote@{len(skeleton)}"] if key[0] == QUOTED else []
    delimiters, fields = ends[key][1], key[1] + best[key][1]
    for layer in reversed(layers):
        key, operation = layer[key][2]
        if operation:
            operations.append(operation)
    return fields, delimiters, " ".join(reversed(operations))


@lru_cache(maxsize=1 << 16)
def parse_skeleton(skeleton: str, wanted: int) -> tuple[int, int, int, str]:
    """(quote edits, fields, delimiter edits, operations) of the minimum-cost parse; fields are those before the delimiter edits.

    Without quote edits the path is the only one of its kind, and its delimiter edits are the fields it lacks or has too many.
    """
    costs = _quote_costs(skeleton)
    quote_edits = min(costs[s] for s in ENDS)
    if quote_edits == 0:
        fields, operations = _free_fields(skeleton), ""
        delimiters = abs(wanted - fields)
    else:
        fields, delimiters, operations = _repair(skeleton, wanted)
    counted = f"{'+' if fields < wanted else '-'}delimiter x{delimiters}" if delimiters else ""
    return quote_edits, fields, delimiters, " ".join(x for x in (operations, counted) if x)


def _parser(wanted: int):
    @F.pandas_udf(PARSE)
    def parse(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for skeletons in batches:
            codes, distinct = pd.factorize(skeletons)
            parsed = pd.DataFrame([parse_skeleton(s, wanted) for s in distinct], columns=PARSE.names)
            yield parsed.take(codes).reset_index(drop=True)

    return parse


def skeleton_of(record: Column, delimiter: str = ";", quote: str = '"') -> Column:
    """The record with every run of other characters as one x, and its marks as ; and "."""
    marks = F.regexp_replace(record, f"[^{delimiter}{quote}]+", "x")
    return marks if (delimiter, quote) == (";", '"') else F.translate(marks, delimiter + quote, ';"')


def fields_of(record: Column, delimiter: str = ";", quote: str = '"') -> Column:
    """Fields of a record that parses at no cost, without their quotes. Possessive quantifiers: no recursion, any length."""
    d, q = delimiter, quote
    raw = F.regexp_extract_all(F.concat(record, F.lit(d)), F.lit(f"({q}[^{q}]*+(?:{q}{q}[^{q}]*+)*+{q}|[^{d}]*+){d}"), F.lit(1))
    return F.transform(raw, lambda f: F.when(f.startswith(q), F.replace(f.substr(F.lit(2), F.length(f) - 2), F.lit(q + q), F.lit(q))).otherwise(f))


#: Valid values of the company contract, after outer spaces are removed: (column, pattern). (fixed patterns)
COMPANY_FIELDS = (
    ("cnpj_basico", r"\A[0-9]{8}\z"),
    ("razao_social", r"(?s)\A.+\z"),
    ("natureza_juridica", r"\A[0-9]{4}\z"),
    ("qualificacao_responsavel", r"\A[0-9]{2}\z"),
    ("capital_social", r"\A[0-9]+,[0-9]{2}\z"),
    ("porte_empresa", r"\A(00|01|03|05|)\z"),
    ("ente_federativo_responsavel", r"(?s)\A.*\z"),
)


def parse_records(rows: DataFrame, record: str, rescued: str | None, contract: Sequence[tuple[str, str]] = COMPANY_FIELDS) -> DataFrame:
    """Adds the contract's columns, `reason`, `quote_edits`, `delimiter_edits` and `edits` to every row.

    reason, the first that applies: 'rescued' (the column `rescued` is not null), 'quoting' (the parse needs quote
    edits), 'column_count' (it needs delimiter edits), 'invalid_value' (a field does not match its pattern after
    outer spaces are removed, or holds U+FFFD), null for a row that loads. The contract's columns are filled for
    rows that load and null otherwise; input columns of the same names are replaced. One carriage return at the end
    of the record is no content. A null record counts as a blank one, which has one field. Repeated rows each come
    out; an empty table stays empty; a record's length is bounded only by memory for one row.
    """
    line = F.regexp_replace(F.coalesce(F.col(record), F.lit("")), r"\r\z", "")
    names = [c for c, _ in contract]
    base = rows.drop(*names, "reason", "quote_edits", "delimiter_edits", "edits")
    parsed = base.withColumn("__line", line).withColumn("__parse", _parser(len(contract))(skeleton_of(F.col("__line"))))
    free = (F.col("__parse.quote_edits") == 0) & (F.col("__parse.delimiter_edits") == 0)
    cut = parsed.withColumn("__fields", F.when(free, F.transform(fields_of(F.col("__line")), lambda f: F.trim(f))))
    field = lambda i: F.element_at("__fields", i + 1)
    valid = ~F.contains(F.col("__line"), F.lit("�"))
    for i, (_, pattern) in enumerate(contract):
        valid = valid & field(i).rlike(pattern)
    reason = F.when(F.col("__parse.quote_edits") > 0, "quoting").when(F.col("__parse.delimiter_edits") > 0, "column_count").when(F.coalesce(valid, F.lit(False)), None).otherwise("invalid_value")
    if rescued:
        reason = F.when(F.col(rescued).isNotNull(), "rescued").otherwise(reason)
    done = cut.withColumn("reason", reason)
    loads = F.col("reason").isNull()
    return done.select(*base.columns, *(F.when(loads, field(i)).alias(c) for i, c in enumerate(names)), "reason", "__parse.quote_edits", "__parse.delimiter_edits", "__parse.edits")
