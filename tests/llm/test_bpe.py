import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tallyspark.llm import bpe

from . import cases

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.load_ranks(PATH), special_tokens={})


def expected(library, text):
    ids = library.encode_ordinary(text or "")
    return (
        len(ids),
        hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
        hashlib.sha256((text or "").encode()).hexdigest(),
    )


def test_random_texts_equal_the_library(library):
    rng = random.Random(3)
    letters = list("abcde 'sdtre  \n\t\r.,!?0123éñüß漢字кирил😀\x1c\x1d\x85  ²Ⅷ́")
    texts = ["".join(rng.choices(letters, k=rng.randrange(60))) for _ in range(3000)]
    texts += ["<|endoftext|> a", "don't  we'll\n\n x", "a" * 5000, " ", "\n \n"]
    encoder, table = bpe.codec(PATH, PATTERN)
    for text, found in zip(texts, encoder.encode(texts), strict=True):
        ids = np.frombuffer(found, "<u4")
        assert ids.tolist() == library.encode_ordinary(text)
        assert bpe.decoded(ids, table) == text.encode()


def test_backtracking_equals_merging_for_a_small_vocabulary():
    tokens = [bytes([c]) for c in b"abc"] + [b"ab", b"bc", b"abc", b"cab", b"aa", b"aab", b"bcb", b"ca"]
    model = bpe.BacktrackingBPE({t: i for i, t in enumerate(tokens)})
    rng = random.Random(1)
    for _ in range(2000):
        data = bytes(rng.choices(b"abc", k=rng.randrange(1, 14)))
        whole = model.ranks.get(data)
        assert model.encode(data) == ([whole] if whole is not None else model.merged(data))


def test_odd_rows_and_round_trip(spark, library):
    rows = bpe.digests(cases.odd(spark), PATH, PATTERN).collect()
    assert Counter(map(tuple, rows)) == Counter((i, *expected(library, t)) for i, t in cases.ODD)
    back = bpe.decode(bpe.encode(cases.odd(spark), PATH, PATTERN), PATH, PATTERN).collect()
    assert Counter((r.doc_id, bytes(r.data)) for r in back) == Counter((i, (t or "").encode()) for i, t in cases.ODD)
    assert bpe.encode(cases.empty(spark), PATH, PATTERN).count() == 0


@cases.needs_data
def test_query(spark, library):
    from tallyspark.llm.queries import op4_bpe

    found = {r.doc_id: tuple(r)[1:] for r in op4_bpe(spark, cases.DATA).collect()}
    assert found == {i: expected(library, t) for i, t in cases.documents(spark)}
