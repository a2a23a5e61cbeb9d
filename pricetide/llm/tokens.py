"""Byte-level BPE ids of whole texts, batch by batch, with the ``tokenizers`` library.

Most words of a corpus repeat, so each batch is cut into words (Arrow buffers and
numpy, no Python loop), the distinct ones are encoded once, and the ids are
gathered back.  A cut is made only before a single space that stands between two
characters that surely are no white space; the pre-tokenizer of a byte-level BPE
ends a token there in any case, so the ids are those of the whole text.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash

END_ID = 0
TOKENIZER = "byte_bpe_50k.json"
BATCH_BYTES = 4 << 20         # text bytes that are encoded at once
TOGETHER = 500                # new words that are encoded as one text


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"      # a task has one core
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


def _large_strings(col: pa.Array | pa.ChunkedArray) -> pa.Array:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return col.cast(pa.large_string()).fill_null("")


def _buffers(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a large-string array without nulls, offsets from 0."""
    off = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + len(arr) + 1]
    raw = arr.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[off[0]:off[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


def _safe_first(b: np.ndarray) -> np.ndarray:
    """First bytes of characters that surely are no white space."""
    return ((b > 0x20) & (b < 0x7F)) | ((b >= 0xC3) & (b <= 0xDF)) | (b >= 0xE4)


def _safe_last(b: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Last bytes of such characters; ``before`` is the byte before each."""
    return ((b > 0x20) & (b < 0x7F)) | ((b >= 0x80) & (before >= 0xC3) & (before <= 0xDF))


def word_cuts(data: np.ndarray) -> np.ndarray:
    """Where a token surely begins: at a single space between two characters that are no
    white space, and at a mark of punctuation after an ASCII letter."""
    if len(data) < 3:
        return np.zeros(0, np.int64)
    mid = data[1:-1]
    sp = np.flatnonzero(mid == 0x20) + 1
    sp = sp[_safe_last(data[sp - 1], data[np.maximum(sp - 2, 0)]) & _safe_first(data[sp + 1])]
    marks = np.flatnonzero(_IS_MARK[mid]) + 1
    return np.concatenate([sp, marks[_IS_LETTER[data[marks - 1]]]])


def _table(chars: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


_IS_MARK = _table(b".,;:!?")
_IS_LETTER = _table(bytes(range(65, 91)) + bytes(range(97, 123)))


@lru_cache(maxsize=2)
def _byte_lengths(path: str) -> np.ndarray:
    """Bytes that each id stands for (a byte-level vocabulary writes a byte as one character)."""
    vocab = load_tokenizer(path).get_vocab(with_added_tokens=True)
    out = np.zeros(max(vocab.values()) + 1, np.int64)
    for token, i in vocab.items():
        out[i] = len(token)
    return out


def _encode_words(words: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids, ids per word).  Words are joined by line ends, which the pre-tokenizer keeps
    apart from a word that neither begins nor ends with other white space; ids are then
    dealt to words by the bytes they stand for.  Words of other kinds go one by one."""
    tok, lengths = load_tokenizer(path), _byte_lengths(path)
    data, off = _buffers(words)
    n, size = len(words), np.diff(off)
    # first and last bytes; rows of less than two bytes take the slow way unless one plain byte
    pad = np.concatenate([data, np.zeros(2, np.uint8)])
    b0, b1 = pad[off[:-1]], pad[off[:-1] + 1]
    z, y = pad[np.maximum(off[1:] - 1, 0)], pad[np.maximum(off[1:] - 2, 0)]
    plain = (size > 0) & (_safe_first(b0) | ((b0 == 0x20) & (size > 1) & _safe_first(b1))) \
        & _safe_last(z, np.where(size > 1, y, 0))
    per_word = np.zeros(n, np.int64)
    parts: list[tuple[np.ndarray, np.ndarray]] = []             # (word of each id, ids)
    where = np.flatnonzero(plain)
    if len(where):
        some = words.take(pa.array(where)).to_pylist()
        joined = ["\n".join(some[i:i + TOGETHER]) + "\n" for i in range(0, len(some), TOGETHER)]
        # the fast form leaves out where in the text each id lies, which is not needed
        ids = np.concatenate([np.array(e.ids, np.uint32) for e in tok.encode_batch_fast(joined, add_special_tokens=False)])
        ends = np.cumsum(lengths[ids])
        stop = np.cumsum(size[where] + 1)                       # byte after each separator
        word = np.searchsorted(stop, ends - 1, "right")
        sep = ends == stop[word]                                # the line end after each word
        parts.append((where[word[~sep]], ids[~sep]))
    rest = np.flatnonzero(~plain & (size > 0))
    for w, e in zip(rest.tolist(), tok.encode_batch_fast(words.take(pa.array(rest)).to_pylist(), add_special_tokens=False)):
        parts.append((np.full(len(e.ids), w), np.array(e.ids, np.uint32)))
    if not parts:
        return np.zeros(0, np.uint32), per_word
    word = np.concatenate([p[0] for p in parts])
    ids = np.concatenate([p[1] for p in parts])
    order = np.argsort(word, kind="stable")
    return ids[order], np.bincount(word, minlength=n)


class _KnownWords:
    """The words that this worker has encoded, with their ids, in one lasting table: 128-bit
    digests in order, and the place of the ids.  Beyond ``MOST`` words, which bounds its
    memory, the half that was met least often (then longest ago) makes room."""

    MOST = 1_000_000

    def __init__(self, path: str):
        self.path, self.turn = path, 0
        self.kind = np.uint16 if load_tokenizer(path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else np.uint32
        self.ids = np.zeros(0, self.kind)
        # sorted by words: digest (two halves), first id, ids, times met and last slice met
        self.words, self.check = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.first, self.size = np.zeros(0, np.uint32), np.zeros(0, np.uint32)
        self.met, self.last = np.zeros(0, np.uint32), np.zeros(0, np.uint32)

    def look_up(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(all ids, first id of each word, ids of each word) for distinct words."""
        self.turn += 1
        digests = b"".join(map(xxhash.xxh3_128_digest, words.cast(pa.large_binary()).to_pylist()))
        key, check = np.frombuffer(digests, "<u8").reshape(-1, 2).T
        at = np.searchsorted(self.words, key)
        near = np.minimum(at, max(len(self.words) - 1, 0))
        hit = (self.words[near] == key) & (self.check[near] == check) if len(self.words) else np.zeros(len(key), bool)
        known, new = near[hit], np.flatnonzero(~hit)
        self.met[known] += 1
        self.last[known] = self.turn
        fresh, count = _encode_words(words.take(pa.array(new)), self.path)
        first, size = np.empty(len(key), np.int64), np.empty(len(key), np.int64)
        first[hit], size[hit] = self.first[known], self.size[known]
        first[new], size[new] = len(self.ids) + np.cumsum(count) - count, count
        ids = self.ids = np.concatenate([self.ids, fresh.astype(self.kind)])
        self._add(key[new], check[new], first[new], count)
        return ids, first, size

    def _add(self, key: np.ndarray, check: np.ndarray, first: np.ndarray, size: np.ndarray) -> None:
        order = np.argsort(key, kind="stable")
        key = key[order]
        at = np.searchsorted(self.words, key)
        # one word per key: a word that shares its key with another is encoded each time
        taken = np.concatenate([[False], key[1:] == key[:-1]]) if len(key) else np.zeros(0, bool)
        if len(self.words):
            taken |= self.words[np.minimum(at, len(self.words) - 1)] == key
        order, key, at = order[~taken], key[~taken], at[~taken]
        one = np.ones(len(key), np.uint32)
        more = {"words": key, "check": check[order], "first": first[order].astype(np.uint32), "size": size[order].astype(np.uint32),
                "met": one, "last": one * np.uint32(self.turn)}
        for name, values in more.items():
            setattr(self, name, np.insert(getattr(self, name), at, values))
        if len(self.words) > self.MOST:
            self._make_room()

    def _make_room(self) -> None:
        keep = np.zeros(len(self.words), bool)
        keep[np.lexsort((self.last, self.met))[-(self.MOST // 2):]] = True
        for name in ("words", "check", "first", "size", "met", "last"):
            setattr(self, name, getattr(self, name)[keep])
        size = self.size.astype(np.int64)
        start = np.cumsum(size) - size
        self.ids = self.ids[np.repeat(self.first.astype(np.int64) - start, size) + np.arange(int(size.sum()))]
        self.first = start.astype(np.uint32)
        self.met = (self.met + 1) // 2                      # what was frequent long ago gives way in time


_known_words = lru_cache(maxsize=1)(_KnownWords)


def encode_texts(col: pa.Array, path: str, end_id: int | None = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets): the ids of row i are ``ids[offsets[i]:offsets[i + 1]]``, ended by
    ``end_id`` (None: no end).  Null texts count as empty."""
    arr = _large_strings(col)
    n = len(arr)
    if n == 0:
        return np.zeros(0, np.uint32), np.zeros(1, np.int64)
    data, off = _buffers(arr)
    cuts = np.sort(np.concatenate([off, word_cuts(data)]))
    cuts = cuts[np.concatenate([[True], cuts[1:] != cuts[:-1]])]
    words = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts.tobytes()), pa.py_buffer(data))
    coded = words.dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False)
    flat, first, size = _known_words(path).look_up(coded.dictionary)
    per_word = size[code]
    upto = np.concatenate([[0], np.cumsum(per_word)])          # ids before each word
    total = int(upto[-1])
    take = np.repeat((first[code] - upto[:-1]).astype(np.int32), per_word)      # ids of a slice: far below 2^31
    take += np.arange(total, dtype=np.int32)
    ids = flat[take].astype(np.uint32) if total else np.zeros(0, np.uint32)
    row = upto[np.searchsorted(cuts, off)]                      # ids before each row
    if end_id is None:
        return ids, row
    out = np.full(total + n, end_id, np.uint32)
    out[np.delete(np.arange(total + n, dtype=np.int32), row[1:] + np.arange(n))] = ids
    return out, row + np.arange(n + 1)


def text_slices(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``BATCH_BYTES`` of text each (at least one row)."""
    arr = _large_strings(batch.column(text))
    _, off = _buffers(arr) if len(arr) else (None, np.zeros(1, np.int64))
    lo = 0
    while lo < len(arr):
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + BATCH_BYTES, "right")) - 1)
        yield batch.slice(lo, hi - lo)
        lo = hi


def ids_crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())
