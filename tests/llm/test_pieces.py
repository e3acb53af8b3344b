import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tallyspark.llm import pieces

from . import cases

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda texts: [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def ids(found):
    return [np.frombuffer(x, "<u2").tolist() for x in found]


def counting():
    """An encoder whose ids are the pieces' own bytes, and all pieces it was asked for."""
    asked = []

    def encode_many(new):
        asked.extend(new)
        return [p.encode() for p in new]

    return pieces.PieceEncoder(encode_many, 1), asked


def test_random_texts_of_a_column_equal_the_library(library):
    rng = random.Random(7)
    letters = list("abS 'sdtrell   \n\n\t\r.,!?#-0123éñüß×÷漢字кирил😀\x00\x1c\x1d\x85\xa0  　²Ⅷ«“—…\x0b\x0c")
    texts = ["".join(rng.choices(letters, k=rng.randrange(40))) for _ in range(6000)]
    texts += ["".join(rng.choices(" \n.aé ", k=rng.randrange(9))) for _ in range(6000)]
    texts += [t or "" for _, t in cases.ODD] + ["a <|endoftext|> b", "don't  we'll'x\n\n y1'2", " ", "\n \n", "x "]
    column, encoder = pa.array(["cut off ", *texts, " cut off"]).slice(1, len(texts)), pieces.library_encoder(PATH)
    encoder.clear()
    found = [x for i in range(0, len(texts), 700) for x in encoder.encode_array(column.slice(i, 700)).to_pylist()]
    assert ids(found) == library(texts)
    assert encoder.encode([]) == [] and encoder.encode(["", ""]) == [b"", b""]


def test_pieces_of_a_text_are_cut_at_every_stop_and_encoded_once():
    encoder, asked = counting()
    texts = ["the cat, the cat.\nthe dog### the dog", "", " the cat's dog1 ", "the"]
    assert encoder.encode(texts) == [t.encode() for t in texts]
    assert sorted(asked) == sorted(
        ["the", " cat", ",", " the", ".", "\n", " dog", "###", "'s", "1 "]
    )


def test_frequent_pieces_outlive_a_full_memory(monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 50)
    encoder, asked = counting()
    for portion in range(100):
        texts = [f" often more{' rare'.join(chr(97 + int(c)) for c in str(portion))} x{chr(97 + portion % 26)}{'y' * portion}"]
        assert encoder.encode(texts) == [t.encode() for t in texts]
        assert len(encoder.known) <= 60 and len(encoder.known) == len(encoder.ids) == len(encoder.met)
    assert asked.count(" often") == 1


def test_memory_is_bounded_in_bytes(monkeypatch):
    monkeypatch.setattr(pieces, "BYTES", 10_000)
    encoder, _ = counting()
    for portion in range(30):
        texts = [chr(97 + portion % 26) * 900 + " often"]
        assert encoder.encode(texts) == [t.encode() for t in texts]
        assert sum(map(len, encoder.known)) <= 10_000 + 1_000
        assert encoder.size == sum(map(len, encoder.known))


def test_a_failed_portion_leaves_nothing_half_known(library):
    encoder, asked = counting()
    inner, encoder.encode_many = encoder.encode_many, lambda new: 1 / 0
    with pytest.raises(ZeroDivisionError):
        encoder.encode(["one two"])
    encoder.encode_many = inner
    assert encoder.encode(["one two"]) == [b"one two"]
