import random

import pytest

from tidemark.llm.tokenizer import PIECE, Encoder, Merges, byte_alphabet, decode_ids, encode_texts, encoder, vocabulary_path

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def own():
    return encoder(vocabulary_path())


@pytest.fixture(scope="module")
def library():
    t = tokenizers.Tokenizer.from_file(vocabulary_path())
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


ODD = ["", " ", "  ", "\n", "\r\n", "\t x", "a", "'s", " 's it's", "<|endoftext|>", "x<|endoftext|>y", "ção", "é", "日本語", "👩‍💻", "​", "\xa0x", "\x1c a", "　　x", "1234567890", "=-=-", "…", "�", "a  b   c \n\n d ", "͸", "ﷺ"]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(own, library, text):
    assert list(own.encode(text)) == library(text)
    assert "".join(own.decode(own.encode(text))) == text


def test_random_texts(own, library):
    random.seed(5)
    parts = ["a", "b", " ", "  ", "\n", "the", "é", "aaaa", "1", "23", "ß", "​", "\x1c", "　", "日本", "🙂", "'s", "'", "\xa0", "==", "-", "ção", "ing"]
    for size in (1, 3, 10, 60, 300) * 60:
        text = "".join(random.choices(parts, k=size))
        ids = list(own.encode(text))
        assert ids == library(text) and "".join(own.decode(ids)) == text


@pytest.mark.parametrize("unit,times", [("a", 20_001), ("=-", 9_000), ("ÃÂ", 4_000), (" ", 9_999), ("日", 5_000), ("ab", 7_000), ("\n", 3_000)])
def test_long_matches_are_streamed(own, library, unit, times):
    text = unit * times + "x"
    assert list(own.encode(text)) == library(text)


def test_streaming_gives_the_same_whatever_the_blocks(own):
    random.seed(6)
    data = "".join(random.choices("abcde", k=5000)).encode()
    want = own.merges.whole(data)
    for block in (1, 7, 64, 1000, 5000):
        assert list(own.merges.stream(data[i : i + block] for i in range(0, len(data), block))) == want


def test_memory_stays_within_the_window(own, monkeypatch):
    """However long the match, what is held between emissions is a few windows."""
    held, settled = [], Merges._settled

    def watch(self, base, last):
        held.append(len(last))
        return settled(self, base, last)

    monkeypatch.setattr(Merges, "_settled", watch)
    random.seed(7)
    emitted = sum(1 for _ in own.merges.stream(bytes(random.choices(b"etaoin", k=1000)) for _ in range(60)))
    assert emitted and len(held) > 100 and max(held) <= 8 * own.merges.longest


def test_every_token_of_the_vocabulary_encodes_as_the_plain_merge_loop(own):
    """Against merging by rank, on all tokens and neighbours; the lookahead is that of the longest token."""
    m = own.merges
    assert m.lookahead == max(map(len, m.bytes.values())) and m.lookahead_bound > m.lookahead

    def plain(data):
        ids = [m.of_byte[b] for b in data]
        while True:
            ranked = [(m.pair[p], i) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in m.pair]
            if not ranked:
                return ids
            rank, _ = min(ranked)
            out, i = [], 0
            while i < len(ids):
                if i + 1 < len(ids) and m.pair.get((ids[i], ids[i + 1])) == rank:
                    a, b = ids[i], ids[i + 1]
                    out.append(next(t for t in merged[a, b]))
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            ids = out

    merged = {}
    for t, p in m.parts.items():
        merged.setdefault(p, []).append(t)
    random.seed(8)
    tokens = [b for i, b in m.bytes.items() if len(b) <= 24]
    for data in random.sample(tokens, 1500) + [a + b for a, b in zip(random.sample(tokens, 1500), random.sample(tokens, 1500), strict=True)]:
        assert m.whole(data) == plain(data), data


def test_small_vocabulary_with_overlapping_merges():
    alphabet = {c: i for i, c in enumerate(sorted(byte_alphabet()))}
    vocabulary = dict(alphabet)
    merges = [("a", "b"), ("b", "a"), ("ab", "a"), ("a", "a"), ("aa", "aa"), ("c", "ab")]
    for a, b in merges:
        vocabulary.setdefault(a + b, len(vocabulary))
    small = Encoder(Merges(vocabulary, merges, r"\S+|\s+"))
    library = tokenizers.Tokenizer(tokenizers.models.BPE(vocab=vocabulary, merges=merges))
    random.seed(9)
    for n in range(1, 200):
        text = "".join(random.choices("abc", k=random.randrange(1, 90)))
        assert list(small.encode(text)) == library.encode(text).ids, text


def test_characters_are_whole_however_the_ids_are_cut(own):
    text = "日本語 👩‍💻 ção " * 5
    for at_once in (1, 2, 3, 7):
        parts = list(own.decode(own.encode(text), at_once))
        assert "".join(parts) == text and "�" not in "".join(parts)


def test_pieces_rejoin_to_the_text():
    text = " a  b\n\nc　d \x1c e "
    assert "".join(PIECE.findall(text)) == text


def test_rows(spark, library):
    long = "palavra " * 200_000
    data = [(1, "olá mundo", "x"), (2, None, "x"), (3, "", "x"), (3, "a", "x"), (4, long, "x"), (5, "   ", None)]
    df = spark.createDataFrame(data, "doc_id long, text string, ids string")
    ids = encode_texts(df, "doc_id", "text")
    got = [(r.doc_id, r.ids) for r in ids.collect()]
    assert sorted(got, key=str) == sorted(((i, library(t) if t else []) for i, t, _ in data), key=str)
    assert sorted((r.doc_id, r.text) for r in decode_ids(ids, "doc_id", "ids").collect()) == sorted((i, t or "") for i, t, _ in data)
    assert encode_texts(df.limit(0), "doc_id", "text").count() == 0
    broken = spark.createDataFrame([(1, [447]), (2, None), (3, [10**6]), (4, [64, None, 65])], "doc_id long, ids array<int>")
    assert [r.text for r in decode_ids(broken, "doc_id", "ids").orderBy("doc_id").collect()][1:] == ["", "", "ab"]
