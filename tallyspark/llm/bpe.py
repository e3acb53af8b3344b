"""Byte-level BPE by backtracking over longest matches."""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache
from struct import pack

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import CACHES, plain, portions
from .pieces import LONGEST, SPACE, PieceEncoder


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, file))}


def spelled(pattern: str) -> str:
    """``pattern`` with its white-space classes written out, so that every regular expression
    engine reads the same characters into them."""
    return (
        pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\s", f"[{SPACE}]").replace(r"\S", f"[^{SPACE}]")
    )


class BacktrackingBPE:
    """Encodes byte strings exactly as repeated lowest-rank merges would.

    A sequence of tokens is the merge result if and only if each token is, and each pair of
    neighbours survives side by side. So the encoder takes the longest token at each place,
    turns to a shorter one where a pair is incompatible, and marks places from which no
    continuation exists; no place is entered twice with the same fate. Matches come from an
    Aho-Corasick automaton over the bytes read as Latin-1; pair checks are memoised.
    """

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.size = [len(self.bytes_of.get(rank, b"")) for rank in range(max(self.bytes_of, default=-1) + 1)]
        self.pairs: dict[tuple[int, int], bool] = {}
        self.automaton = ahocorasick.Automaton()
        usable = {t: r for t, r in ranks.items() if len(t) == 1 or self.merged(t) == [r]}
        for token, rank in usable.items():  # others are never a merge result
            self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        #: The next shorter token that begins like this one; -1: none.
        self.shorter = [-1] * len(self.size)
        for token, rank in usable.items():
            heads = (usable.get(token[:n], -1) for n in range(len(token) - 1, 0, -1))
            self.shorter[rank] = next((r for r in heads if r >= 0), -1)

    def merged(self, data: bytes) -> list[int]:
        """Repeated merges, lowest rank first, leftmost first: the definition."""
        ranks, parts = self.ranks, [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best = min(
                range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], 1 << 60)
            )
            pair = parts[best] + parts[best + 1]
            if pair not in ranks:
                break
            parts[best : best + 2] = [pair]
        return [ranks[part] for part in parts]

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merges of both tokens' bytes give back just these two tokens."""
        if len(self.pairs) > 2_000_000:
            self.pairs.clear()
        fits = self.merged(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
        self.pairs[left, right] = fits
        return fits

    def encode(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        n, size, shorter, pairs = len(data), self.size, self.shorter, self.pairs
        longest = [-1] * (n + 1)
        for end, rank in self.automaton.iter(data.decode("latin-1")):
            longest[end + 1 - size[rank]] = rank  # later matches of a place are longer
        dead = bytearray(n + 1)
        tokens: list[int] = []
        at, last, rank = 0, -1, longest[0]
        while at < n:
            while rank >= 0:
                if not dead[at + size[rank]]:
                    fits = True if last < 0 else pairs.get((last, rank))
                    if fits is None:
                        fits = self.compatible(last, rank)
                    if fits:
                        break
                rank = shorter[rank]
            if rank >= 0:
                tokens.append(rank)
                at += size[rank]
                last, rank = rank, longest[at]
            else:
                if not tokens:
                    raise ValueError("a byte of the text is not in the vocabulary")
                dead[at] = 1
                last = tokens.pop()
                at -= size[last]
                last, rank = (tokens[-1] if tokens else -1), shorter[last]
        return tokens


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> tuple[PieceEncoder, list[bytes]]:
    """Encoder of texts and the bytes of each id, once per worker process."""
    bpe, split = BacktrackingBPE(load_ranks(path)), regex.compile(spelled(pattern))

    seen: dict[str, list[int]] = {}
    CACHES.extend((seen, bpe.pairs))

    def match_ids(match: str) -> list[int]:
        ids = seen.get(match)
        if ids is None:
            if len(seen) > 300_000:
                seen.clear()
            ids = bpe.encode(match.encode())
            if len(match) <= LONGEST:
                seen[match] = ids
        return ids

    def piece_ids(piece: str) -> list[int]:
        if (piece[1:] if piece[0] == " " else piece).isalpha():
            return match_ids(piece)  # letters after a space at most are one match
        return [i for match in split.findall(piece) for i in match_ids(match)]

    def encode_many(pieces: list[str]) -> list[bytes]:
        return [pack(f"<{len(ids)}I", *ids) for ids in map(piece_ids, pieces)]

    table = [bpe.bytes_of.get(i, b"") for i in range(max(bpe.bytes_of, default=-1) + 1)]
    return PieceEncoder(encode_many, 4), table


def decoded(ids: np.ndarray, table: list[bytes]) -> bytes:
    return b"".join(map(table.__getitem__, ids.tolist()))


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids) with ids as little-endian unsigned 32-bit integers in a binary column.

    A null or empty text has no ids; texts of any length are encoded whole; repeated rows give
    repeated results; an empty table gives no rows; other columns are not read.
    """

    def run(batches):
        encoder, _ = codec(path, pattern)
        for batch in portions(batches, 1, remember=True):
            ids = encoder.encode_array(plain(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=[id_col, "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids binary")


def decode(encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """(id, data): the bytes the ids stand for."""

    def run(batches):
        _, table = codec(path, pattern)
        for batch in batches:
            data = [decoded(np.frombuffer(ids or b"", "<u4"), table) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], names=[id_col, "data"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(id_col, "ids").mapInArrow(run, f"`{id_col}` {kind}, data binary")


def digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): encoding and decoding back in one pass."""

    def run(batches):
        encoder, table = codec(path, pattern)
        names = [str(i) for i in range(len(table))]
        for batch in portions(batches, 1, remember=True):
            counts, written, back = [], [], []
            for data in encoder.encode_array(plain(batch.column(1))).to_pylist():
                ids = np.frombuffer(data, "<u4").tolist()
                counts.append(len(ids))
                written.append(hashlib.sha256(",".join(map(names.__getitem__, ids)).encode()).hexdigest())
                back.append(hashlib.sha256(b"".join(map(table.__getitem__, ids))).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(written), pa.array(back)],
                names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
