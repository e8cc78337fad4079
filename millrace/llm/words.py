"""Words of many texts at once, as numpy arrays over an Arrow column. Runs inside tasks, on bounded slices."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

# A word is a run of bytes that are ASCII digits, ASCII letters or not ASCII; A-Z count as a-z.
_BYTES = np.arange(256, dtype=np.uint8)
_FOLDED = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
_IS_WORD = ((_FOLDED >= 48) & (_FOLDED <= 57)) | ((_FOLDED >= 97) & (_FOLDED <= 122)) | (_FOLDED >= 128)
FOLD_WORDS = np.where(_IS_WORD, _FOLDED, 0).astype(np.uint8)
LANE = 8
# Words with more lanes are hashed one by one.
HASHED_LANES = 16
_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(LANE)] + [(1 << 64) - 1], dtype=np.uint64)


@dataclass
class Words:
    """Words of consecutive texts: where each begins in ``data``, its bytes, and the first word of each text."""

    data: np.ndarray  # folded bytes, 0 between words, with spare zeros at the end
    starts: np.ndarray
    lengths: np.ndarray
    first: np.ndarray  # one more entry than texts

    def lane(self, words: np.ndarray | slice, number: int) -> np.ndarray:
        """Bytes ``8 * number`` and the seven after, of each of these words, as one integer padded with zeros."""
        view = np.ndarray((len(self.data) - LANE + 1,), dtype="<u8", buffer=self.data, strides=(1,))
        left = np.clip(self.lengths[words] - LANE * number, 0, LANE)
        at = np.minimum(self.starts[words] + LANE * number, len(view) - 1)
        return view[at] & _KEEP[left]

    def prefix(self, words: np.ndarray | slice, size: int) -> np.ndarray:
        """The first ``size`` (up to 8) bytes of each of these words."""
        view = np.ndarray((len(self.data) - LANE + 1,), dtype="<u8", buffer=self.data, strides=(1,))
        return view[self.starts[words]] & _KEEP[np.minimum(self.lengths[words], size)]

    def hashes(self, words: np.ndarray) -> np.ndarray:
        """A 64-bit hash of all bytes of each of these words."""
        found = self.lane(words, 0) ^ self.lengths[words].astype(np.uint64)
        longer, number = np.flatnonzero(self.lengths[words] > LANE), 1
        while len(longer) and number < HASHED_LANES:
            mixed = (found[longer] ^ (found[longer] >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
            found[longer] = mixed + self.lane(words[longer], number)
            number += 1
            longer = longer[self.lengths[words[longer]] > LANE * number]
        for k in longer:  # few words are so long
            begin = self.starts[words[k]]
            found[k] = xxhash.xxh64_intdigest(self.data[begin: begin + self.lengths[words[k]]])
        found = (found ^ (found >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
        return found ^ (found >> np.uint64(29))


def split_words(column: pa.Array) -> Words:
    """Split every text of a string column. Null is a text without words."""
    texts = pc.fill_null(column, "").cast(pa.large_string())
    count = len(texts)
    if count == 0:
        return Words(np.zeros(LANE, np.uint8), *(np.zeros(0, np.int64) for _ in "ab"), np.zeros(1, np.int64))
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset: texts.offset + count + 1]
    size = int(offsets[-1] - offsets[0])
    data = np.zeros(size + LANE, np.uint8)
    if size:
        data[:size] = FOLD_WORDS[np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]: offsets[-1]]]
    bounds = offsets - offsets[0]
    inside = data != 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[bounds[:-1]] |= inside[bounds[:-1]]
    starts = np.flatnonzero(begins)
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    last = bounds[1:][bounds[1:] > 0] - 1
    stops[last] |= inside[last]
    lengths = np.flatnonzero(stops) + 1 - starts
    return Words(data, starts, lengths, np.searchsorted(starts, bounds))


class Vocabulary:
    """A bounded set of words with ids from 1; every other word has id 0. Lookups are exact."""

    def __init__(self, words: Iterable[bytes]):
        ordered = sorted(set(words))
        table = split_words(pa.array(ordered, pa.binary()).cast(pa.string()))
        self.size = len(ordered)
        self.words = ordered
        self._ids = {word: k + 1 for k, word in enumerate(ordered)}
        self._depth = int(-(-table.lengths.max(initial=0) // LANE))
        self._lanes = [table.lane(slice(None), k) for k in range(self._depth)]
        self._lengths = table.lengths
        keys = self._keys(table)
        self._order = np.argsort(keys, kind="stable")
        self._sorted = keys[self._order]
        if (self._sorted[1:] == self._sorted[:-1]).any():
            raise ValueError("two words of the vocabulary have one key")  # words of over 8 bytes; about 1 in 2**64 a pair

    def __getitem__(self, word: bytes) -> int:
        return self._ids.get(word, 0)

    def _keys(self, words: Words) -> np.ndarray:
        keys = words.lane(slice(None), 0)
        longer = np.flatnonzero(words.lengths > LANE)
        if len(longer):
            mixed = keys[longer]
            for number in range(1, self._depth):
                mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + words.lane(longer, number)
            keys[longer] = mixed ^ words.lengths[longer].astype(np.uint64)
        return keys

    def ids(self, words: Words) -> np.ndarray:
        if self.size == 0 or len(words.starts) == 0:
            return np.zeros(len(words.starts), np.int64)
        keys = self._keys(words)
        at = np.minimum(np.searchsorted(self._sorted, keys), self.size - 1)
        found = self._sorted[at] == keys
        entry = self._order[at]
        found &= self._lengths[entry] == words.lengths
        # Up to 8 bytes the key is the word itself; longer ones are compared in full.
        long = np.flatnonzero(found & (words.lengths > LANE))
        for number in range(self._depth):
            if len(long) == 0:
                break
            same = self._lanes[number][entry[long]] == words.lane(long, number)
            found[long[~same]] = False
            long = long[same & (words.lengths[long] > LANE * (number + 1))]
        return np.where(found, entry + 1, 0)


def slices(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with up to ``limit`` bytes of text each; a longer text stands alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    begin = 0
    while begin < batch.num_rows:
        base = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(begin, end - begin)
        begin = end
