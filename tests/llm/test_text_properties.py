import pytest

hypothesis = pytest.importorskip("hypothesis")
tokenizers = pytest.importorskip("tokenizers")
from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

from tidemark.llm.leakage import words_of  # noqa: E402
from tidemark.llm.textstats import STATISTICS, Learned, statistics_of  # noqa: E402
from tidemark.llm.tokenizer import encoder, vocabulary_path  # noqa: E402

OWN = encoder(vocabulary_path())
LIBRARY = tokenizers.Tokenizer.from_file(vocabulary_path())
LIBRARY.encode_special_tokens = True
TEXT = st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(list(" \n\t'’-=aeçã19\xa0​�"))), max_size=80)


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_any_text_encodes_as_the_library_has_it_and_decodes_to_itself(text):
    ids = list(OWN.encode(text))
    assert ids == LIBRARY.encode(text, add_special_tokens=False).ids
    assert OWN.packed(text) == b"".join(i.to_bytes(4, "little") for i in ids)
    assert "".join(OWN.decode(ids)) == text


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_words_do_not_depend_on_form_or_case(text):
    import unicodedata

    plain = words_of(text)
    assert all(w and w == w.casefold() for w in plain) and words_of(" ".join(plain)) == plain
    assert words_of(unicodedata.normalize("NFD", text)) == words_of(unicodedata.normalize("NFC", text))


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_statistics_stay_in_their_ranges(text):
    found, _ = statistics_of(text, Learned())
    assert set(found) == set(STATISTICS)
    assert all(0 <= v <= 1 for k, v in found.items() if k not in ("words", "word_length")), found
