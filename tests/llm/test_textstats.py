import math
import random

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from tidemark.llm.textstats import MOST_SURPRISE, OUTLIER, STATISTICS, WEIGHTS, Learned, exact_ranks, learn, no_prose, no_sentences, outlier_scores, statistics_of, tail_probabilities, text_statistics

PROSE = "A mesa de liquidação comparou os totais do boleto no último dia útil. The duty engineer traced the missing file, and nothing else depended on it!"
NOT = {
    "list": "- a tabela\n- o banco parceiro\n- dois arquivos\n- PIX",
    "numbers": "1. the closing balance\n2. the list of closed branches\n3. a second reviewer\n4. rows UF",
    "bare": "os totais\na mesa de liquidação\ndois arquivos do mesmo mês\nmarço TED\no extrato",
    "one line": "version BOLETO, the March delivery, the contract owner, a currency, our reconciliation job, the branch register, rows UF",
    "table": "| a | b |\n|---|---|\n| 1 | x |\n| 2 | y |",
    "csv": "cnpj;lote;status\n12345678;emp-1;ok\n12345679;emp-2;",
    "log": "2027-01-01 10:00:00,123 ERROR valor=1 hash=ff\n2027-01-01 10:00:01,123 WARN valor=2 hash=fe",
    "json": '{"data": "2027-01-01", "canal": "TED"}\n{"data": "2027-01-02", "canal": "PIX"}',
    "contents": "the partner bank ........ 12\na tesouraria ........ 15",
    "junk": "knboz qpjkrf mda jtnwrhx wtpqhqvge jqhawkt. lrkfxk tfc lojm nkoo zgzkd ffjd.",
    "repeated": "pix " * 40,
    "symbols": "~~~~~~~~~\n*********\n+++++++++",
    "mostly a table": "A mesa de liquidação comparou os totais.\n\n" + "2027-01-01\tTED\t12.345,67\n" * 12,
}


#: Running text of languages that the corpus doesn't hold.
FOREIGN = (
    "Die Mitarbeiterin hat den Fehler in der Datei gefunden und an die Bank gemeldet. Am nächsten Tag war alles wieder in Ordnung, und der Bericht ging an die Leitung.",
    "Il responsabile ha trovato il file che mancava e lo ha mandato alla banca. Il giorno dopo la tabella era di nuovo completa e nessuno ha perso un solo pagamento.",
    "Le service a retrouvé le fichier qui manquait et il a prévenu la banque. Tout le reste du mois a été payé sans erreur, et le client en a été informé.",
    "Сотрудник нашёл файл, который не пришёл в срок, и сообщил об этом в банк. На другой день всё было в порядке, и отчёт ушёл к нам.",
)


@pytest.fixture(scope="module")
def learned(spark):
    return learn(spark.read.parquet(f"{DATA}/documents.parquet"), "text", "lang")


def test_prose_and_the_rest(learned):
    for text in (PROSE, PROSE.lower(), PROSE.upper(), "# Heading\n\n" + PROSE, PROSE.replace(" ", "\n", 3), PROSE.replace(" ", "  "), PROSE + "\n\n- a\n- b", PROSE[:-1], *FOREIGN):
        assert statistics_of(text, learned)[0]["sentence_share"] > 0.6, text
    for kind, text in NOT.items():
        assert statistics_of(text, learned)[0]["sentence_share"] < 0.5, kind


def test_what_is_learned(spark, learned):
    assert set(learned.common) == {"pt", "en", "es"} and {"de", "o", "do"} <= learned.common["pt"] and "the" in learned.common["en"]
    assert learned.letter_surprise(PROSE.lower()) < learned.suspicious < learned.random < learned.letter_surprise(NOT["junk"])
    assert learned.letter_surprise("12 + 7") == 0.0 == learned.letter_surprise("")
    df = spark.createDataFrame([("a a b", "pt"), ("a", " PT "), ("c", "und"), ("d", None), (None, "pt"), ("", "xx")], "text string, lang string")
    assert learn(df, "text", "lang").common == {"pt": frozenset("ab")}
    assert learn(df.limit(0), "text", "lang") == Learned()


def test_rare_languages_are_none_of_the_corpus(spark):
    df = spark.range(600).select(F.lit("um dois três").alias("text"), F.when(F.col("id") == 0, "xx").when(F.col("id") < 4, "es").otherwise("pt").alias("lang"))
    assert set(learn(df, "text", "lang").common) == {"pt", "es"}


def test_statistics_by_hand():
    known = Learned({"pt": frozenset(("os", "e", "o")), "en": frozenset(("the", "e"))})
    found, lang = statistics_of("Os dois, e os três.\n\nfim 12", known)
    assert lang == "pt" and found["words"] == 7 and math.isclose(found["word_length"], len("osdoiseostrêsfim12") / 7)
    assert math.isclose(found["symbol_share"], 2 / 20) and math.isclose(found["digit_share"], 2 / 20) and found["ended_lines"] == 0.5
    assert math.isclose(found["common_words"], 3 / 7) and math.isclose(found["distinct_words"], 6 / 7)
    assert statistics_of("x", known) == ({"words": 1, "word_length": 1.0, "symbol_share": 0.0, "digit_share": 0.0, "ended_lines": 0.0, "common_words": 0.0, "distinct_words": 1.0, "letter_surprise": 0.0, "sentence_share": 0.0}, None)
    assert statistics_of("os x", Learned())[0]["common_words"] == 0.0


def test_rows(spark):
    data = [(1, PROSE, "pt"), (2, None, "pt"), (3, "", "pt"), (4, " \t\n　", "pt"), (5, "xyzzy", " EN "), (6, "xyzzy", "fr"), (7, "xyzzy", None), (7, "xyzzy", None), (8, PROSE * 2000, "en"), (9, "…", "es")]
    df = spark.createDataFrame([(*d, 0.0, 1) for d in data], "doc_id long, text string, lang string, score double, words int")
    got = {(r.doc_id): r for r in text_statistics(df, "doc_id", "text", "lang").collect()}
    assert set(got) == {1, 5, 6, 7, 8, 9} and [got[i].lang for i in (5, 6, 7, 9)] == ["en", "fr", "und", "es"]
    assert text_statistics(df, "doc_id", "text", "lang").count() == 7
    assert text_statistics(df.limit(0), "doc_id", "text", "lang").count() == 0
    assert outlier_scores(text_statistics(df.limit(0), "doc_id", "text", "lang")).count() == 0


def test_ranks_are_exact_across_partitions(spark):
    random.seed(1)
    values = [(g, random.randrange(v)) for g, v, n in (("a", 500, 3000), ("b", 3, 500), ("c", 1, 10)) for _ in range(n)]
    df = spark.createDataFrame(values, "g string, v int")
    counts = df.groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    got = {(r.g, r.v): (r.below, r.upto, r.total) for r in exact_ranks(counts, ["g"], "v", ranges=7).collect()}
    for g, v in set(values):
        own = [x for h, x in values if h == g]
        assert got[g, v] == (sum(x < v for x in own), sum(x <= v for x in own), len(own))
    assert len(got) == len(set(values))


def test_scores_combine_tail_probabilities(spark):
    random.seed(2)
    data = [(i, random.choice(["pt", "pt", "pt", "pt", "en", "und"]), *(round(random.random(), 1) for _ in STATISTICS)) for i in range(400)]
    data += [(1000 + i, "xx", *(0.1 for _ in STATISTICS)) for i in range(3)]  # a language without prose
    stats = spark.createDataFrame(data, "doc_id int, lang string, " + ", ".join(f"{s} double" for s in STATISTICS))
    got = {r.doc_id: r.score for r in outlier_scores(stats).collect()}
    assert len(got) == 403 and all(math.isclose(got[1000 + i], MOST_SURPRISE) for i in range(3))
    share = 2 + list(STATISTICS).index("sentence_share")
    for row in data[:60]:
        prose = [d for d in data if d[share] >= 0.5 and row[1] in ("und", d[1])]
        total = 0.0
        for j, (name, odd) in enumerate(STATISTICS.items()):
            low, high = sum(d[2 + j] <= row[2 + j] for d in prose) / len(prose), sum(d[2 + j] >= row[2 + j] for d in prose) / len(prose)
            tail = low if odd < 0 else high if odd > 0 else min(1.0, 2 * min(low, high))
            total += WEIGHTS[name] * (min(-math.log(tail), MOST_SURPRISE) if tail else MOST_SURPRISE)
        assert math.isclose(got[row[0]], total / sum(WEIGHTS.values()), rel_tol=1e-9)
    assert tail_probabilities(stats).filter("surprise < 0 or surprise is null").count() == 0
    some = {r.doc_id: r.score for r in outlier_scores(stats, only=no_sentences()).collect()}
    assert set(some) == {d[0] for d in data if d[share] < 0.5} and all(math.isclose(s, got[i]) for i, s in some.items())


def test_the_score_decides_and_the_check_confirms(spark):
    """A text without sentences that is like the prose of its language in all else is no outlier; an odd one is."""
    typical = {"words": 20.0, "word_length": 5.0, "ended_lines": 1.0, "common_words": 0.4, "distinct_words": 0.8, "letter_surprise": 3.3, "symbol_share": 0.02, "digit_share": 0.0}
    odd = dict(typical, words=900.0, ended_lines=0.0, common_words=0.0, digit_share=0.5)
    data = [(i, "pt", *({**typical, "sentence_share": 1.0}[s] for s in STATISTICS)) for i in range(50)]
    data += [(100, "pt", *({**typical, "sentence_share": 0.4}[s] for s in STATISTICS)), (101, "pt", *({**odd, "sentence_share": 0.4}[s] for s in STATISTICS)), (102, "pt", *({**odd, "sentence_share": 0.6}[s] for s in STATISTICS))]
    scored = outlier_scores(spark.createDataFrame(data, "doc_id int, lang string, " + ", ".join(f"{s} double" for s in STATISTICS)))
    assert [r.doc_id for r in scored.filter(no_prose()).collect()] == [101]
    assert sorted(r.doc_id for r in scored.filter(no_sentences()).collect()) == [100, 101] and scored.filter((F.col("doc_id") == 100) & (F.col("score") < OUTLIER)).count() == 1


def test_prose_of_other_languages_is_prose(spark, learned):
    data = [(i, PROSE + f" E o arquivo {i} chegou no dia útil.", "pt") for i in range(40)] + [(100 + i, t, lang) for i, t in enumerate(FOREIGN) for lang in ("pt", None)] + [(200 + i, t, "pt") for i, t in enumerate(NOT.values())]
    scored = outlier_scores(text_statistics(spark.createDataFrame(data, "doc_id long, text string, lang string"), "doc_id", "text", "lang", learned))
    assert sorted(r.doc_id for r in scored.filter(no_prose()).collect()) == [200 + i for i in range(len(NOT))]


def test_what_is_found_is_no_prose(spark):
    data = [(i, PROSE + f" E o arquivo {i} chegou no dia útil.", "pt") for i in range(40)] + [(100 + i, t, "pt") for i, t in enumerate(NOT.values())]
    scored = outlier_scores(text_statistics(spark.createDataFrame(data, "doc_id long, text string, lang string"), "doc_id", "text", "lang"))
    assert sorted(r.doc_id for r in scored.filter(no_prose()).collect()) == [100 + i for i in range(len(NOT))]


def test_nothing_is_left_out_where_most_or_all_of_a_language_is_no_prose(spark):
    prose = [(i, PROSE + f" E o arquivo {i} chegou no dia útil.", "pt") for i in range(90)]
    copies = [(1000 + i, NOT["bare"], "pt") for i in range(140)]
    others = [(2000 + i, NOT["list"] + f"\n- arquivo {i}" * (1 + i % 3), "pt") for i in range(70)]
    for data in (prose + copies + others, copies + others, copies):
        scored = outlier_scores(text_statistics(spark.createDataFrame(data, "doc_id long, text string, lang string"), "doc_id", "text", "lang"))
        assert sorted(r.doc_id for r in scored.filter(no_prose()).collect()) == sorted(i for i, _, _ in data if i >= 1000)


def test_statistics_and_ranks_are_of_unrounded_values(spark):
    data = [(i, "a casa " * (50_000 + 500 * i), "pt") for i in range(2)] + [(10 + i, "palavra " * 5 + "x" * (300 + i), "pt") for i in range(30)]
    rows = spark.createDataFrame(data, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in outlier_scores(text_statistics(rows, "doc_id", "text", "lang")).collect()}
    assert [got[i].words for i in (0, 1)] == [100_000, 101_000] and isinstance(got[0].words, int)
    assert all(got[i].word_length == statistics_of(t, Learned())[0]["word_length"] for i, t, _ in data)
    assert len({got[10 + i].word_length for i in range(30)}) == 30 and all(r.score >= OUTLIER for r in got.values())
    close = [(1, "doc", "pt", 9, 5.0, 0.0, 0.0, 1.0, 0.3, 1.0, 3.0, 0.4996), (2, "doc", "pt", 9, 5.0, 0.0, 0.0, 1.0, 0.3, 1.0, 3.0, 0.5)]
    scored = outlier_scores(spark.createDataFrame(close, "doc_id int, kind string, lang string, words long, " + ", ".join(f"{n} double" for n in list(STATISTICS)[1:])))
    assert [r.doc_id for r in scored.filter(no_sentences()).collect()] == [1]
