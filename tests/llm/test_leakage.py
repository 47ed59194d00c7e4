import random

import pytest

from tidemark.llm import leakage
from tidemark.llm.leakage import Passages, WuManber, find_leaks, leak_report, words_of


def searcher(items, length):
    passages = Passages()
    for item, words in items:
        passages.add(item, words)
    return WuManber(passages, length)


def brute(items, words, length):
    grams = {}
    for i, w in items:
        for k in range(len(w) - length + 1):
            grams.setdefault(tuple(w[k : k + length]), set()).add(i)
    return set().union(*(grams.get(tuple(words[k : k + length]), ()) for k in range(len(words) - length + 1)))


def test_words_ignore_case_accents_and_marks():
    assert words_of("Ação, AÇÃO açao Ação Ａｃao") == ["acao"] * 5
    assert words_of("a_b-c​d e\xa0f 1.5 ½") == ["a", "b", "c", "d", "e", "f", "1", "5", "1", "2"]
    assert words_of(None) == words_of("") == words_of(" \n…") == []
    assert words_of("́ x\U0001e900") == ["x\U0001e922"]


@pytest.mark.parametrize("length", [2, 3, 5])
def test_search_against_brute_force(length):
    random.seed(length)
    for _ in range(300):
        items = [(i, random.choices("abcd", k=random.randrange(0, 9))) for i in range(4)]
        words = random.choices("abcde", k=random.randrange(0, 40))
        assert searcher(items, length).search(words) == brute(items, words, length)


def test_a_pattern_of_several_items_names_them_all():
    w = "a b c d".split()
    assert searcher([(1, w), (2, ["x", *w])], 3).search("z b c d".split()) == {1, 2}
    assert searcher([], 3).search(w) == set() and searcher([(1, w)], 5).search(w * 3) == set()
    with pytest.raises(ValueError):
        searcher([], 1)


ITEM = "um dois três quatro cinco seis sete oito nove dez onze doze treze quatorze"


@pytest.fixture
def tables(spark):
    twelve = " ".join(ITEM.split()[1:13])
    data = [
        (1, f"antes {twelve} depois"), (2, twelve.upper().replace(" ", ",\n  ")), (3, twelve.replace("ê", "ê")), (4, " ".join(ITEM.split()[:11])), (5, twelve.replace("sete", "sete e")), (6, None), (7, ""), (8, "palavra " * 300_000 + twelve),
        (9, " ".join(ITEM.split()[:6]) + " x " + " ".join(ITEM.split()[6:])), (1, ITEM), (10, "> " + twelve.replace("seis ", "seis\n> ")),
    ]
    docs = spark.createDataFrame([(*d, 0) for d in data], "doc_id long, text string, item_id int")
    items = spark.createDataFrame([(70, ITEM, "test"), (71, "curto demais", "test"), (72, None, "test"), (73, ITEM, "test"), (None, ITEM, "test")], "item_id long, text string, split string")
    return docs, items


@pytest.mark.parametrize("pass_size", [10**6, 10])
def test_leaks(tables, monkeypatch, pass_size):
    monkeypatch.setattr(leakage, "WORDS_A_PASS", pass_size)
    docs, items = tables
    got = find_leaks(docs, "doc_id", "text", items, "item_id", "text")
    assert sorted((r.doc_id, r.item_id) for r in got.collect()) == sorted((d, i) for d in (1, 1, 2, 3, 8, 10) for i in (70, 73))
    report = {r.item_id: (r.split, r.documents) for r in leak_report(got, "doc_id", "item_id", items, ["split"]).collect()}
    assert report == {70: ("test", 5), 73: ("test", 5)}


def test_empty_tables(tables):
    docs, items = tables
    assert find_leaks(docs.limit(0), "doc_id", "text", items, "item_id", "text").count() == 0
    assert find_leaks(docs, "doc_id", "text", items.limit(0), "item_id", "text").count() == 0


def test_tables_stay_small():
    """A passage costs some tens of bytes beside its words' numbers, whatever the number of items."""
    random.seed(9)
    words = [f"w{i}" for i in range(3000)]
    tables = searcher([(i, random.choices(words, k=60)) for i in range(4000)], 12)
    size = len(tables.shift) + 8 * (len(tables.index) + len(tables.places)) + 4 * len(tables.passages.flat)
    assert tables.patterns == 4000 * 49 and size < 120 * tables.patterns
    assert tables.search(random.choices(words, k=500)) == set() and tables.search([*words, *[list(tables.passages.vocabulary)[n] for n in tables.passages.flat[60:120]]]) >= {1}
