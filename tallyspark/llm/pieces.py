"""Encoding whole texts through a memory of pieces.

Byte-level BPE splits a text by a pattern and merges inside each match, so encoding piece by
piece gives the ids of the whole text if a match begins wherever a piece does. The pieces of a
portion are found in the bytes of its Arrow column, and only its distinct ones are looked up;
pieces that recur are encoded once per task.
"""

from __future__ import annotations

import os
import re
from collections import defaultdict
from collections.abc import Callable, Iterable, Sequence
from functools import lru_cache, reduce
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import CACHES

#: Unicode white space; Python's own class also holds four control characters.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Pieces a task remembers at most, about 150 bytes each, the bytes they have in all, and the
#: length of the longest that is kept when others are forgotten.
REMEMBERED, BYTES, LONGEST = 800_000, 64 << 20, 256

EncodeMany = Callable[[list[str]], Sequence[bytes]]


def _bytes(values: Iterable[int]) -> np.ndarray:
    """A table of all bytes that is true for ``values``."""
    table = np.zeros(256, bool)
    table[list(values)] = True
    return table


WHITE = re.findall(f"[{SPACE}]", "".join(map(chr, range(1 << 16))))
LONG_WHITE = [int.from_bytes(c.encode()) for c in WHITE if not c.isascii()]
ASCII_LETTERS = _bytes(b for b in range(128) if chr(b).isalpha())
ASCII_VISIBLE = _bytes(b for b in range(128) if chr(b) not in WHITE)
#: First bytes of characters among which some are white space.
LEADS = _bytes(c.encode()[0] for c in WHITE if not c.isascii())
VISIBLE = ASCII_VISIBLE | (np.arange(256) > 127) & ~LEADS


def visible(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the UTF-8 characters that begin at these places are not white space."""
    first = data[at]
    out = VISIBLE[first]
    unsure = np.flatnonzero(LEADS[first])
    if len(unsure):
        places = np.minimum(at[unsure, None] + np.arange(3), len(data) - 1)
        one, two, three = data[places].astype(np.int64).T
        pair = one << 8 | two
        out[unsure] = ~np.isin(pair, LONG_WHITE) & ~np.isin(pair << 8 | three, LONG_WHITE)
    return out


def piece_offsets(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where pieces begin in the UTF-8 bytes of texts one after another, and the end of the
    last one. ``starts``: the same of the texts.

    A match always begins at a space before what is not white space, at a digit or common
    punctuation after a letter, and at a line feed after what is not white space; that line
    feed is a match if no white space follows.
    """
    begins = np.zeros(len(data) + 1, bool)
    spaces = np.flatnonzero(data[:-1] == 32)
    begins[spaces[visible(data, spaces + 1)]] = True
    begins[starts[1:] - 1] = False  # what follows a text's last byte is not its own
    stops = np.flatnonzero(data[1:] - np.uint8(33) < 32) + 1  # ! to @
    before = data[stops - 1]
    # À to ÿ but for × and ÷ are letters of two bytes.
    latin = (data[stops - 2] == 0xC3) & (stops > 1) & (before > 127) & (before != 0x97) & (before != 0xB7)
    begins[stops[ASCII_LETTERS[before] | latin]] = True
    feeds = np.flatnonzero(data[1:] == 10) + 1
    feeds = feeds[ASCII_VISIBLE[data[feeds - 1]]]
    begins[feeds] = True
    feeds = feeds[feeds < len(data) - 1]
    begins[feeds[visible(data, feeds + 1)] + 1] = True
    begins[starts] = True
    return np.flatnonzero(begins)


def _binary(offsets: np.ndarray, data: pa.Buffer | None) -> pa.Array:
    """The values between consecutive ``offsets`` of ``data``."""
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), data])


class PieceEncoder:
    """Ids of texts as little-endian unsigned integers of ``width`` bytes."""

    def __init__(
        self,
        encode_many: EncodeMany,
        width: int,
        vocabulary: int = 0,
        special: Sequence[str] = (),
        encode_whole: Callable[[str], bytes] | None = None,
    ) -> None:
        self.encode_many, self.width, self.vocabulary = encode_many, width, vocabulary
        self.special, self.encode_whole = special, encode_whole
        self.clear()
        CACHES.append(self)

    def clear(self) -> None:
        """Forget all pieces."""
        #: Each piece's number; by number, its ids and the portions that held it.
        self.known: dict[bytes, int] = defaultdict(count().__next__)
        self.ids, self.met, self.size = pa.array([], pa.binary()), np.zeros(0, np.int32), 0

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; one that holds the string of a special token is encoded as a whole."""
        return self.encode_array(pa.array(texts, pa.string())).to_pylist()

    def encode_array(self, texts: pa.Array) -> pa.Array:
        """``encode`` for an Arrow column without nulls."""
        if not self.special or not len(texts):
            return self._by_pieces(texts)
        whole = reduce(pc.or_, (pc.match_substring(texts, s) for s in self.special))
        rows = np.flatnonzero(whole.to_numpy(zero_copy_only=False))
        if not len(rows):
            return self._by_pieces(texts)
        out = self._by_pieces(pc.if_else(whole, "", texts)).to_pylist()
        for i in rows.tolist():
            out[i] = self.encode_whole(texts[i].as_py())
        return pa.array(out, pa.binary())

    def _by_pieces(self, texts: pa.Array) -> pa.Array:
        _, offsets, values = texts.cast(pa.string()).buffers()
        if not len(texts) or values is None:
            return pa.array([b""] * len(texts), pa.binary())
        starts = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        first = starts[0]
        data = np.frombuffer(values, np.uint8)[first : starts[-1]]
        offsets = piece_offsets(data, starts - first)
        pieces = _binary(offsets + first, values).dictionary_encode()
        ids = self._look_up(pieces.dictionary.to_numpy(zero_copy_only=False).tolist()).take(pieces.indices)
        ends = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset : ids.offset + len(ids) + 1]
        return _binary(ends[np.searchsorted(offsets, starts - first)], ids.buffers()[2])

    def _look_up(self, pieces: list[bytes]) -> pa.Array:
        """The ids of distinct pieces."""
        numbers = np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))
        new = [pieces[i] for i in np.flatnonzero(numbers >= len(self.ids)).tolist()]
        if new:
            try:
                found = pa.array(self.encode_many([p.decode() for p in new]), pa.binary())
            except BaseException:
                self.clear()
                raise
            self.ids = pa.concat_arrays([self.ids, found])
            self.met = np.concatenate((self.met, np.zeros(len(new), np.int32)))
            self.size += sum(map(len, new))
        self.met[numbers] += 1
        out = self.ids.take(pa.array(numbers))
        if len(self.known) > REMEMBERED or self.size > BYTES:
            self._forget()
        return out

    def _forget(self) -> None:
        """Forget the pieces that the fewest portions held, at least half, and the long ones."""
        pieces, ids, met = list(self.known), self.ids, self.met
        short = np.fromiter(map(len, pieces), np.int64, len(pieces)) <= LONGEST
        kept = np.flatnonzero((met > np.partition(met, len(met) // 2)[len(met) // 2]) & short)
        self.clear()
        for i in kept.tolist():
            self.size += len(pieces[i])
            self.known[pieces[i]]
        self.ids, self.met = ids.take(pa.array(kept)), met[kept]


def _library_encoder(path: str, together: int = 200) -> PieceEncoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    size = tokenizer.get_vocab_size(with_added_tokens=True)
    width = 2 if size <= 1 << 16 else 4
    kind = np.dtype(f"<u{width}")
    # A byte-level token has one character for each of its bytes.
    n_bytes = np.array([len(tokenizer.id_to_token(i) or "") for i in range(size)], np.int64)

    def ids(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_many(pieces: list[str]) -> list[bytes]:
        # Pieces that begin with a space and end without one may follow each other in one text;
        # so may those without either, after a line feed, which is then a match and one id.
        joined, alone = [], []
        for i, p in enumerate(pieces):
            (alone if p[-1].isspace() or p[p[0] == " "].isspace() else joined).append(i)
        out: list[bytes] = [b""] * len(pieces)
        for i, found in zip(alone, ids([pieces[i] for i in alone]), strict=True):
            out[i] = np.array(found, kind).tobytes()
        groups = [joined[i : i + together] for i in range(0, len(joined), together)]
        texts = [[pieces[i] if pieces[i][0] == " " else "\n" + pieces[i] for i in g] for g in groups]
        for group, parts, found in zip(groups, texts, ids(list(map("".join, texts))), strict=True):
            found = np.array(found, kind)
            sizes = [len(part.encode()) for part in parts]
            ends = (np.searchsorted(np.cumsum(n_bytes[found]), np.cumsum(sizes)) + 1) * width
            data, start = found.tobytes(), 0
            for i, part, end in zip(group, parts, ends.tolist(), strict=True):
                out[i] = data[start + width * (part[0] == "\n") : end]
                start = end
        return out

    def encode_whole(text: str) -> bytes:
        return np.array(tokenizer.encode(text, add_special_tokens=False).ids, kind).tobytes()

    return PieceEncoder(encode_many, width, size, special, encode_whole)


@lru_cache(maxsize=2)
def library_encoder(path: str) -> PieceEncoder:
    """The ``tokenizers`` encoder of a vocabulary file, once per worker process."""
    return _library_encoder(path)
