import itertools
from heapq import heappop, heappush

import pytest

from tidemark.operators.errorparse import COMPANY_FIELDS, STEP, parse_records, parse_skeleton

GOOD = '"12345678";"NAME; ""QUOTED""";"2062";"10";"1,00";"01";""'


def strict(record):
    """The quoting rule as stated, character by character: the number of fields, or None if it is broken."""
    i, n, fields = 0, len(record), 0
    while True:
        if record[i : i + 1] == '"':
            i += 1
            while True:
                j = record.find('"', i)
                if j < 0:
                    return None
                if record[j + 1 : j + 2] == '"':
                    i = j + 2
                    continue
                i = j + 1
                break
            if i < n and record[i] != ";":
                return None
        else:
            while i < n and record[i] != ";":
                i += 1
        fields += 1
        if i >= n:
            return fields
        i += 1


def fewest_quote_edits(skeleton):
    """Least insertions and deletions of quotes that make the quoting right, by search."""
    heap, seen = [(0, skeleton)], set()
    while heap:
        cost, text = heappop(heap)
        if text in seen:
            continue
        seen.add(text)
        if strict(text) is not None:
            return cost
        for i in range(len(text) + 1):
            heappush(heap, (cost + 1, text[:i] + '"' + text[i:]))
            if i < len(text) and text[i] == '"':
                heappush(heap, (cost + 1, text[:i] + text[i + 1 :]))


@pytest.mark.parametrize("length", range(0, 6))
def test_every_short_skeleton_costs_what_search_finds(length):
    for tokens in itertools.product('";x', repeat=length):
        skeleton = "".join(tokens)
        if "xx" in skeleton:
            continue
        cost, fields, delimiters, edits = parse_skeleton(skeleton, 3)
        assert cost == fewest_quote_edits(skeleton), skeleton
        if cost == 0:
            assert fields == strict(skeleton) and delimiters == abs(3 - fields)
        assert bool(edits) == bool(cost or delimiters)


def nearest_delimiter_edits(skeleton, wanted):
    """Least distance to `wanted` fields over all repairs by fewest quote edits, by search."""
    level = {skeleton}
    while not any(strict(t) is not None for t in level):
        level = {t[:i] + '"' + t[i:] for t in level for i in range(len(t) + 1)} | {t[:i] + t[i + 1 :] for t in level for i in range(len(t)) if t[i] == '"'}
    return min(abs(strict(t) - wanted) for t in level if strict(t) is not None)


def test_delimiters_are_counted_in_full_where_quotes_are_repaired():
    assert parse_skeleton('"x"x' + ";x" * 11, 7)[1:3] == (12, 5)
    found = parse_skeleton('"x"x' + ";x" * 11, 7)[3]
    assert found.endswith("-delimiter x5")
    skeletons = ["".join(t) for n in range(1, 7) for t in itertools.product('";x', repeat=n) if "xx" not in "".join(t)]
    skeletons += ['"x"x' + ";x" * 6, 'x;"x;x;x;x', ';;;"x"x;;;', '"x;x;x"x;x;x', ';"";x"";"x;;;x']
    for skeleton in skeletons:
        for wanted in (1, 3):
            cost, fields, delimiters, _ = parse_skeleton(skeleton, wanted)
            assert delimiters == abs(fields - wanted) == nearest_delimiter_edits(skeleton, wanted), (skeleton, wanted)


def fewest_edits(skeleton, wanted):
    """Least (quote edits, delimiter edits) by search over texts in which a delimiter edit leaves every quote its role.

    A deleted delimiter is marked d: it ends a field for the quotes, but isn't counted; an inserted one stands at the end.
    """
    counted = lambda text: None if strict(text.replace("d", ";")) is None else strict(text.replace("d", ";"))
    level, cost = {skeleton}, 0
    while True:
        good = [t for t in level if counted(t) is not None]
        if good:
            return cost, min(abs(counted(t) - wanted) for t in good)
        level = {t[:i] + '"' + t[i:] for t in level for i in range(len(t) + 1)} | {t[:i] + t[i + 1 :] for t in level for i in range(len(t)) if t[i] == '"'}
        cost += 1


def test_one_program_over_quotes_and_delimiters():
    skeletons = ["".join(t) for n in range(1, 6) for t in itertools.product('";x', repeat=n) if "xx" not in "".join(t)] + ['"x"x;"x"x;x', ';;"x;";;"', '"x;x"x;x;"x']
    for skeleton in skeletons:
        for wanted in (1, 2, 4):
            cost, _, delimiters, _ = parse_skeleton(skeleton, wanted)
            assert (cost, delimiters) == fewest_edits(skeleton, wanted), (skeleton, wanted)


def test_the_stated_edits_repair_the_record():
    for skeleton in ('"x;"x"', '"x"x;x', '"x', 'x;"x"x"x";x', '"";"x""', ';"x"x'):
        cost, fields, _, edits = parse_skeleton(skeleton, 3)
        ops = [e for e in edits.split() if "quote" in e]
        assert len(ops) == cost
        out = []
        for at, token in enumerate([*skeleton, ""]):
            if f"+quote@{at}" in ops:
                out.append('"')
            if f"-quote@{at}" not in ops:
                out.append(token)
        assert strict("".join(out)) == fields, (skeleton, edits)


def parse(spark, lines, rescued=None):
    df = spark.createDataFrame([(i, line, rescued, "own", "own") for i, line in enumerate(lines)], "line_id long, raw_line string, _rescued_data string, reason string, razao_social string")
    return parse_records(df, "raw_line", "_rescued_data")


def test_reasons_in_order(spark):
    lines = [
        GOOD, GOOD + "\r", GOOD + "\r\r", "12345678;NA\nME;2062;10;1,00;;x", " 12345678 ; N ; 2062 ;10;1,00;01;", '"1;2', '12345678;N;2062;10;1,00;01', "", None, "1;N;2062;10;1,00;01;", "12345678; ;2062;10;1,00;01;",
        "12345678;N;2062;10;1.00;01;", "12345678;N;2062;10;1,00;02;", "12345678;N�;2062;10;1,00;01;", '12345678;a"b;2062;10;1,00;01;', '"12345678" ;N;2062;10;1,00;01;', "12345678\n;N;2062;10;1,00;01;",
    ]
    want = [None, None, "quoting", None, None, "quoting", "column_count", "column_count", "column_count"] + ["invalid_value"] * 5 + [None, "quoting", "invalid_value"]
    got = parse(spark, lines).orderBy("line_id").collect()
    assert [r.reason for r in got] == want
    assert got[0].razao_social == 'NAME; "QUOTED"' and got[3].razao_social == "NA\nME" and got[14].razao_social == 'a"b' and got[4].cnpj_basico == "12345678"
    assert got[5].razao_social is None and got[5].quote_edits == 1


def test_rescued_comes_first(spark):
    assert [r.reason for r in parse(spark, ['"broken', GOOD], "{}").collect()] == ["rescued", "rescued"]


def test_very_long_and_repeated_records(spark):
    long = "12345678;" + "N" * 400_000 + ";2062;10;1,00;01;"
    doubled = '12345678;"' + '""' * 200_000 + '";2062;10;1,00;01;'
    got = parse(spark, [long, doubled, long]).orderBy("line_id").collect()
    assert [r.reason for r in got] == [None, None, None] and len(got[1].razao_social) == 200_000


def test_empty_table(spark):
    assert parse(spark, []).count() == 0
    assert set(c for c, _ in COMPANY_FIELDS) < set(parse(spark, []).columns)


def test_steps_are_total():
    assert all(len(s) == 4 for s in STEP.values())
