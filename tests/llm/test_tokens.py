import random

import pyarrow as pa
import public_tokenizers
import pytest
from rankspark.llm import tokens as T
from tokenizers import Tokenizer

from .conftest import ODD, thue_morse

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def encoder():
    return T.Encoder(PATH)


def whole(encoder, texts):
    return [x.ids + [2] for x in encoder.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("letters", ["ab'  \n\t\xa0é1!s\r\x85\x1c 你Ж", "ab' \n1!s", "ab \t\n"])
def test_ids_are_those_of_whole_texts(encoder, monkeypatch, letters):
    monkeypatch.setattr(T, "WORDS", 500)
    monkeypatch.setattr(T, "PRE_TOKENS", 50)
    rng = random.Random(letters)
    texts = [t for _, t in ODD] + ["".join(rng.choices(letters, k=rng.randrange(24))) for _ in range(4000)]
    found = [x.tolist() for x in encoder.encode(pa.array(texts, pa.string()))]
    assert found == whole(encoder, texts)


def test_no_texts(encoder):
    assert not list(encoder.encode(pa.array([], pa.string())))


def test_added_tokens_are_those_of_a_fresh_tokenizer(encoder):
    fresh = Tokenizer.from_file(PATH)
    texts = ["a <|endoftext|> b", "plain text", "<|endoftext|>", "x<|endoftext|>y  <|endoftext|>\n z", "end <|endoftext|", " a b "]
    texts = texts * 3 + [t or "" for _, t in ODD]
    wanted = [x.ids + [2] for x in fresh.encode_batch(texts, add_special_tokens=False)]
    assert [64, 220, 50256, 275, 2] in wanted
    for _ in range(2):
        assert [x.tolist() for x in encoder.encode(pa.array(texts, pa.string()))] == wanted


@pytest.mark.parametrize("content", ["two words", "abc"])
def test_added_tokens_with_white_space_or_letters(tmp_path, content):
    other = Tokenizer.from_file(PATH)
    other.add_tokens([content])
    other.save(str(tmp_path / "other.json"))
    texts = ["x two words y", "two  words", "in abcd", "abc", "a b c"]
    found = [x.tolist() for x in T.Encoder(str(tmp_path / "other.json")).encode(pa.array(texts, pa.string()))]
    assert found == [x.ids + [2] for x in other.encode_batch(texts, add_special_tokens=False)]


def test_long_words_that_a_polynomial_names_alike(encoder):
    words = ["".join(w) for n in (512, 1024, 2048) for w in thue_morse(n, "a", "b")]
    texts = [*words, " ".join(words)]
    assert [x.tolist() for x in encoder.encode(pa.array(texts))] == whole(encoder, texts)
