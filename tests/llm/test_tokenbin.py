import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyspark.llm import tokenbin

from . import cases

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


def expected(library, rows):
    out, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library(text)
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("limit", [6, 9, 20])
def test_code_lengths_are_limited_complete_and_optimal(limit):
    rng = np.random.default_rng(limit)
    counts = (rng.pareto(0.4, 50) * 10).astype(np.int64)
    counts[7] = 0
    lengths = tokenbin.code_lengths(counts, limit).astype(int)
    used = counts > 0
    assert (lengths[~used] == 0).all() and 0 < lengths[used].min() and lengths.max() <= limit
    assert np.sum(2.0 ** -lengths[used]) == 1.0
    if limit == 20:  # no shorter code exists: compare with unlimited Huffman merging
        import heapq

        heap, cost = counts[used].tolist(), 0
        heapq.heapify(heap)
        while len(heap) > 1:
            pair = heapq.heappop(heap) + heapq.heappop(heap)
            cost += pair
            heapq.heappush(heap, pair)
        assert (counts * lengths).sum() == cost


@pytest.mark.parametrize("n", [1, 2, 255, 256, 257, 5000])
def test_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.3, n), 900).astype(np.uint16)
    lengths = tokenbin.code_lengths(np.bincount(ids, minlength=901))
    bits, marks = tokenbin.compress(ids, tokenbin.canonical(lengths), lengths)
    back = tokenbin.decompress(bits, marks, n, tokenbin.decoding_table(lengths))
    assert back.tolist() == ids.tolist()
    assert len(bits) == -(-int(lengths[ids].astype(int).sum()) // 8)


def test_one_distinct_id_and_no_ids():
    lengths = tokenbin.code_lengths(np.array([0, 0, 9]))
    ids = np.full(9, 2, np.uint16)
    bits, marks = tokenbin.compress(ids, tokenbin.canonical(lengths), lengths)
    assert tokenbin.decompress(bits, marks, 9, tokenbin.decoding_table(lengths)).tolist() == [2] * 9
    assert tokenbin.compress(ids[:0], tokenbin.canonical(lengths), lengths)[0] == b""
    assert not tokenbin.code_lengths(np.zeros(5, int)).any()


def test_odd_rows_in_many_small_blocks(spark, library, monkeypatch):
    blocks, lengths = tokenbin.write(cases.odd(spark), PATH)
    found = tokenbin.read(blocks, lengths, with_ids=True).collect()
    mine = sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in found), key=lambda r: r[1])
    # Rows that share an id may stand in either order.
    assert mine == expected(library, cases.ODD)
    texts = dict(cases.ODD)
    assert all(np.frombuffer(r.ids, "<u4").tolist() == library(texts[r.doc_id]) for r in found)
    blocks, lengths = tokenbin.write(cases.empty(spark), PATH)
    assert tokenbin.read(blocks, lengths).count() == 0


def test_files_are_read_without_what_the_writer_held(spark, library, tmp_path):
    tokenbin.write(cases.odd(spark), PATH, str(tmp_path / "files"))
    found = tokenbin.read(spark.read.parquet(str(tmp_path / "files"))).collect()
    mine = sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in found), key=lambda r: r[1])
    assert mine == expected(library, cases.ODD)


@cases.needs_data
def test_query(spark, library):
    from tallyspark.llm.queries import op5_token_files

    found = sorted(map(tuple, op5_token_files(spark, cases.DATA).collect()))
    assert found == expected(library, cases.documents(spark))


def test_strings_of_special_tokens_as_the_library_reads_them(spark, library):
    rows = [(1, "a <|endoftext|> b"), (2, "<|endoftext|>" * 3), (3, "x<|endof text|>"), (4, " <|endoftext|>\n\n y"), (5, "plain text")]
    assert library(rows[0][1]) == [64, 220, 50256, 275, 2]
    blocks, _ = tokenbin.write(spark.createDataFrame(rows, "doc_id long, text string"), PATH)
    assert sorted(map(tuple, tokenbin.read(blocks).collect())) == expected(library, rows)
