import pytest

hypothesis = pytest.importorskip("hypothesis")
from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402
from test_errorparse import strict  # noqa: E402

from tidemark.functions.keys import hash_key_of  # noqa: E402
from tidemark.operators.errorparse import parse_skeleton  # noqa: E402
from tidemark.sources.readers import checked_values  # noqa: E402


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(['"', ";", "x", '""', '";"', '"x"']), max_size=30))
def test_a_parse_costs_nothing_exactly_where_the_stated_rule_holds(parts):
    skeleton = "".join(parts)
    while "xx" in skeleton:
        skeleton = skeleton.replace("xx", "x")
    cost, fields, delimiters, _ = parse_skeleton(skeleton, 7)
    right = strict(skeleton)
    assert (cost == 0) == (right is not None)
    if right is not None:
        assert fields == right and delimiters == abs(7 - right)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=6)), min_size=1, max_size=3), st.lists(st.one_of(st.none(), st.text(max_size=6)), min_size=1, max_size=3))
def test_keys_are_equal_only_for_equal_components(a, b):
    kind = lambda c: [None if x is None else "" if x == "" else " " if not x.strip() else x.strip().upper() for x in c]
    assert (hash_key_of(a) == hash_key_of(b)) == (kind(a) == kind(b))


@given(st.lists(st.from_regex(r"\A20[0-9]{2}-(0[1-9]|1[0-2])\Z"), min_size=1, max_size=5, unique=True))
def test_months_pass(values):
    assert checked_values(values, None) == values
