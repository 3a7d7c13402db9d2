import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from matchlake.llm import bpe_lexicon
from matchlake.llm.bpe_lexicon import Encoder, Lexicon, Vocabulary, compiled, decode, encode
from matchlake.llm.queries import tokenizer_file, word_tokenizer_file


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(word_tokenizer_file())


def expected(vocabulary, text):
    return vocabulary.tokenizer.encode(text, add_special_tokens=False).ids


def ids_of(encoder, texts):
    return [np.frombuffer(x, "<u4").tolist() for x in encoder.texts(texts)]


WORDS = ["the", "then", "hen", "tone", "stone", "ones", "!", "été", "日本", "a"]


@pytest.fixture(scope="module")
def encoder(vocabulary):
    return Encoder(vocabulary, Lexicon(compiled(WORDS, vocabulary.merged)))


def test_all_letters_get_the_tokenizers_ids(vocabulary, encoder):
    letters = [chr(c) for c in range(0x20000) if not 0xD800 <= c <= 0xF8FF]
    texts = ["".join(f"a{x}1{x}́ " for x in letters[at : at + 512]) for at in range(0, len(letters), 512)]
    for at in range(0, len(texts), 64):
        got = ids_of(encoder, texts[at : at + 64])
        assert got == [expected(vocabulary, t) for t in texts[at : at + 64]]


def test_texts_get_the_tokenizers_ids(vocabulary, encoder):
    random.seed(4)
    parts = [*WORDS, " ", "  ", "\n", "'s", "'LL", "can't", ",", "...", "12", "Σ", "ΑΣ ", "é", "́", "İ", "ǅ", "\x85", " ", "<|endoftext|>"]
    parts += ["<|startoftext|>", "<|endof", "\U00010d50", "abᲉ", "ﬁ", "한", "ᄒ", "ᅡ", "K", "\x00", "\x1c", "x" * 60]
    texts = ["".join(random.choices(parts, k=random.randint(0, 14))) for _ in range(20_000)]
    got = ids_of(encoder, texts)
    for text, ids in zip(texts, got, strict=True):
        assert ids == expected(vocabulary, text), text


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40))
def test_any_text_gets_the_tokenizers_ids(vocabulary, encoder, text):
    assert ids_of(encoder, [text]) == [expected(vocabulary, text)]


def test_long_texts_are_cut_before_white_space(vocabulary, encoder, monkeypatch):
    random.seed(6)
    monkeypatch.setattr(bpe_lexicon, "PORTION", 7)
    texts = [" ".join(random.choices([*WORDS, "é", "́x", "Σ\n"], k=50)) for _ in range(50)] + ["", "y" * 100]
    assert ids_of(encoder, texts) == [expected(vocabulary, t) for t in texts]


def test_very_long_words_are_merged_exactly(vocabulary):
    random.seed(8)
    for word in ("a" * 3000, "stones" * 9, "ab" * 2000, "".join(random.choices("etaoin", k=5000))):
        assert vocabulary.merged(word) == expected(vocabulary, word)
    assert len(vocabulary.merged("z" * 300_000)) > 0


@settings(max_examples=100, deadline=None)
@given(st.sets(st.text("abc", min_size=1, max_size=6), max_size=60))
def test_the_automaton_is_minimal_and_numbers_its_words(words):
    lexicon = Lexicon(compiled(words, lambda w: [len(w), *w.encode()]))
    tried = sorted({*words, "", "a", "abcabcabc", "cc", "d"}, key=str)
    places = lexicon.places(pa.array(tried, pa.large_string()))
    ordered = sorted(words)
    assert places.tolist() == [ordered.index(w) if w in words else -1 for w in tried]
    for word, place in zip(tried, places.tolist(), strict=True):
        if place >= 0:
            assert lexicon.ids[lexicon.ends[place] : lexicon.ends[place + 1]].tolist() == [len(word), *word.encode()]
    prefixes = {w[:k] for w in words for k in range(len(w) + 1)}
    endings = {frozenset(w[len(p) :] for w in words if w.startswith(p)) for p in prefixes if p}
    assert len(lexicon.finals) == len(endings) + 1  # and the root


def documents(frame):
    rows = [(n, f"The stone then! Number {n} zzyzx" * (n % 4)) for n in range(40)]
    rows += [(50, None), (51, ""), (52, "<|endoftext|> x"), (None, "the the"), (3, "twice"), (60, "Stone " * 30_000)]
    return frame([(*r, "x", b"y") for r in rows], "doc_id long, text string, decoded string, ids binary").repartition(3), rows


@pytest.mark.parametrize("words", [0, 3, 1000])
def test_documents_round_trip(spark, frame, vocabulary, words):
    docs, rows = documents(frame)
    path = word_tokenizer_file()
    name = bpe_lexicon.lexicon(docs, path, words)
    got = decode(encode(docs, path, name), path).collect()
    found = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, np.frombuffer(r["ids"], "<u4").tolist(), r["decoded"]) for r in got))
    wanted = []
    for doc_id, text in rows:
        ids = expected(vocabulary, text or "")
        wanted.append((doc_id is not None, doc_id or 0, ids, vocabulary.tokenizer.decode(ids, skip_special_tokens=False)))
    assert found == sorted(wanted)


def test_common_words_are_the_most_frequent(spark, frame, rows, vocabulary):
    docs = frame([(1, "b b b a a c " + "z" * 60), (2, None), (3, "A 7 7 7 7")], "doc_id long, text string")
    pattern = vocabulary.word.pattern
    for most, common in [(0, []), (1, ["7"]), (2, ["7"]), (3, ["7", "a", "b"]), (9, ["7", "a", "b", "c"])]:
        assert rows(bpe_lexicon.common_words(docs, pattern, most)) == [(w,) for w in common]


def test_no_documents_and_other_vocabularies(spark, frame):
    docs = frame([], "doc_id string, text string")
    path = word_tokenizer_file()
    assert decode(encode(docs, path, bpe_lexicon.lexicon(docs, path)), path).collect() == []
    with pytest.raises(ValueError):
        Vocabulary(tokenizer_file())
