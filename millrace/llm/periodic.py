"""Periodic runs of words, found with a grammar made by recompression.

A run is a stretch of words whose words a smallest period q apart are the same, at least four periods (and ``LEAST`` words) long,
that no neighbouring word extends. Every task numbers the words of some documents, one after the other with a mark of its own
between them. Of a run with period q four multiples of q in a row lie inside, so only places on the grid of multiples of a
period with four equal words in a row are candidates; over all periods these grids have n ln n places. Documents with
candidates go into a run-length grammar: by turns, blocks of one symbol become a symbol, and then pairs, where a symbol of one
half of the alphabet stands before one of the other. Equal stretches are compressed alike except at their ends, so the
longest common extension of two places is found by going up while both stand at the beginning of a parent, and down again
where the symbols differ: a few steps per level. The same grammar read backwards gives the extension to the left. Both
extensions of a candidate make up its run; the smallest period of those with one place and length is the run's.

No text leaves its task, and only the words of one slice of texts are held at a time (one text, if longer).

Defined cases: a null, empty or blank text has no words and no runs; repeated rows are reported row by row; an empty table
gives no rows; the report ignores extra columns and ``collapse`` keeps them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from .words import slices

POWER, LEAST = 4, 6
SLICE_BYTES = 2 * 1024 * 1024
# Candidates that are extended at a time.
CHUNK = 500_000
_TOP = 16  # a grammar ends with about so many symbols
RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])


class _Level:
    """The symbols of a level with the place of each one's parent, a block or a pair, in the level above."""

    def __init__(self, symbols: np.ndarray, up: np.ndarray, blocks: bool = False):
        self.symbols, self.up, self.blocks = symbols, up, blocks
        self.head = np.ones(len(symbols), bool)
        self.head[1:] = up[1:] != up[:-1]
        self.first = np.flatnonzero(self.head)  # by parent
        # How far equal symbols may be stepped over at once: to the end of a block, which has but one symbol.
        self.stride = np.append(self.first[1:], len(symbols))[up] - np.arange(len(symbols)) if blocks else np.ones_like(up)

    def mirrored(self) -> _Level:
        return _Level(self.symbols[::-1], self.up[-1] - self.up[::-1], self.blocks)


def _named(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1]


class Grammar:
    """A sequence that begins and ends with symbols of their own, compressed level by level."""

    def __init__(self, sequence: np.ndarray | None, levels: list[_Level] | None = None):
        if levels is not None:
            self.levels = levels
            return
        self.levels, now, turn = [], _named(sequence), 0
        while len(now) > _TOP:
            turn += 1
            head = np.ones(len(now), bool)
            head[1:] = now[1:] != now[:-1]
            first = np.flatnonzero(head)
            if len(first) < len(now):
                count = np.diff(np.append(first, len(now)))
                self.levels.append(_Level(now, np.cumsum(head) - 1, blocks=True))
                now = _named(now[first] * (count.max() + 1) + count)
            # Which half a symbol is in depends on the symbol and the turn alone; a turn may join nothing.
            mixed = (now.astype(np.uint64) * np.uint64(2) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15 * (2 * turn + 1) % 2**64)
            front = ((mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(63)) == 1
            joined = front[:-1] & ~front[1:]
            if joined.any():
                head = np.append(True, ~joined)
                first = np.flatnonzero(head)
                second = np.where(np.append(joined, False)[first], now[np.minimum(first + 1, len(now) - 1)] + 1, 0)
                self.levels.append(_Level(now, np.cumsum(head) - 1))
                now = _named(now[first] * (now.max() + 2) + second)
        self.levels.append(_Level(now, np.arange(len(now))))

    def mirrored(self) -> Grammar:
        return Grammar(None, [level.mirrored() for level in self.levels])

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols from ``a`` on are those from ``b`` on. The places differ."""
        x, y, top = a.copy(), b.copy(), len(self.levels) - 1
        stop, live = np.full(len(a), top), np.arange(len(a))

        def advance(level: _Level, going: np.ndarray) -> np.ndarray:
            """Step over equal symbols; gives those that could."""
            going = going[level.symbols[x[going]] == level.symbols[y[going]]]
            step = np.minimum(level.stride[x[going]], level.stride[y[going]])
            x[going] += step
            y[going] += step
            return going

        for number, level in enumerate(self.levels[:-1]):
            going = live
            while len(going := going[~(level.head[x[going]] & level.head[y[going]])]):
                moved = advance(level, going)
                stop[np.setdiff1d(going, moved, assume_unique=True)] = number
                going = moved
            live = live[stop[live] == top]
            x[live], y[live] = level.up[x[live]], level.up[y[live]]
        while len(live):
            live = advance(self.levels[top], live)
        for number in range(top - 1, -1, -1):
            level, going = self.levels[number], np.flatnonzero(stop > number)
            x[going], y[going] = level.first[x[going]], level.first[y[going]]
            stop[going] = number
            while len(going):
                going = advance(level, going)
        return x - a


def candidates(sequence: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Periods and places: multiples of a period up to a fourth of ``longest`` with four equal symbols in a row there."""
    periods, places, held = [], [], 0
    for period in range(1, longest // POWER + 1):
        grid = sequence[::period]
        same = grid[1:] == grid[:-1]
        found = np.flatnonzero(same[:-2] & same[1:-1] & same[2:]) * period
        if len(found):
            periods.append(np.full(len(found), period))
            places.append(found)
            held += len(found)
        if held >= CHUNK:
            yield np.concatenate(periods), np.concatenate(places)
            periods, places, held = [], [], 0
    if held:
        yield np.concatenate(periods), np.concatenate(places)


def _extended(forward: Grammar, backward: Grammar, size: int, period: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Start, length and period of the runs that hold these candidates."""
    found = []
    for turn in range(5):
        if len(place) == 0:
            break
        # Candidates next to each other on a grid mostly lie in one run: the first of them is extended. What is left after
        # some turns is extended one by one.
        heads = np.ones(len(place), bool)
        if turn < 4:
            heads[1:] = (period[1:] != period[:-1]) | (place[1:] - place[:-1] != period[1:])
        p, i = period[heads], place[heads]
        right = forward.extension(i, i + p)
        left = backward.extension(size - i, size - i - p)
        length = left + right + p
        long = length >= np.maximum(LEAST, POWER * p)
        found.append(np.stack([i - left, length, p], axis=1)[long])
        end = np.repeat(i + p + right, np.diff(np.append(np.flatnonzero(heads), len(place))))
        rest = ~heads & (place + (POWER - 1) * period >= end)
        period, place = period[rest], place[rest]
    return np.concatenate(found) if found else np.zeros((0, 3), np.int64)


def find_runs(texts: list[np.ndarray]) -> list[np.ndarray]:
    """For each sequence of symbols from 0 on its runs as rows (start, length, period), by start, then period."""
    none = np.zeros((0, 3), np.int64)
    result = [none] * len(texts)
    sizes = np.array([len(t) for t in texts], np.int64)
    if sizes.max(initial=0) < LEAST:
        return result
    mark = 1 + max(int(t.max()) for t in texts if len(t))

    def laid(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """These sequences with marks around them, and where each begins."""
        pieces = [np.array([mark])]
        for n, k in enumerate(numbers, 1):
            pieces += [texts[k], np.array([mark + n])]
        return np.concatenate(pieces), np.cumsum([1, *(sizes[numbers] + 1)])[:-1]

    sequence, begins = laid(np.arange(len(texts)))
    chunks = [[], []]
    for period, place in candidates(sequence, int(sizes.max())):
        owner = np.searchsorted(begins, place, side="right") - 1
        # The four words must be of one text: the grids go on over marks, and the next texts may be left out of the grammar.
        fits = (period * POWER <= sizes[owner]) & (place + (POWER - 1) * period < begins[owner] + sizes[owner])
        chunks[0].append(period[fits])
        chunks[1].append(place[fits])
    if not sum(map(len, chunks[1])):
        return result
    period, place = map(np.concatenate, chunks)
    owner = np.searchsorted(begins, place, side="right") - 1
    some = np.unique(owner)
    own, own_begins = laid(some)
    at = place - begins[owner] + own_begins[np.searchsorted(some, owner)]
    forward = Grammar(own)
    backward = forward.mirrored()
    found = [_extended(forward, backward, len(own), period[k: k + CHUNK], at[k: k + CHUNK]) for k in range(0, len(at), CHUNK)]
    runs = np.concatenate(found)
    # One stretch may be found with several multiples of its period.
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    fresh = np.ones(len(runs), bool)
    fresh[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[fresh]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    owner = np.searchsorted(own_begins, runs[:, 0], side="right") - 1
    runs[:, 0] -= own_begins[owner]
    for n in np.unique(owner):
        result[some[n]] = runs[owner == n]
    return result


def kept_words(size: int, runs: np.ndarray) -> np.ndarray:
    """The numbers of the words that stay: of every run only the first period."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.flatnonzero(np.cumsum(change[:-1]) == 0)


def _of_texts(column: pa.Array) -> tuple[list[int], list[np.ndarray], list[str]]:
    """Number of words, runs, and the text without what runs repeat, of each text."""
    numbers: dict[bytes, int] = {}
    words = [(text or "").encode().split() for text in column.to_pylist()]
    runs = find_runs([np.array([numbers.setdefault(w, len(numbers)) for w in own], np.int64) for own in words])
    rest = [
        b" ".join([own[k] for k in kept_words(len(own), found)] if len(found) else own).decode() for own, found in zip(words, runs)
    ]
    return [len(own) for own in words], runs, rest


def periodic_runs(docs: DataFrame, *, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per document: its id, ``n_words``, ``runs`` (array of start, length and period in words) and ``collapsed``, the words
    outside of runs and each run's first period, with one space between them."""
    schema = T.StructType([
        T.StructField("id", docs.schema[id_col].dataType), T.StructField("n_words", T.LongType()),
        T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType()),
    ])
    run_type = pa.list_(pa.struct([(n, pa.int64()) for n in RUN.names]))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                sizes, runs, rest = _of_texts(part.column("text"))
                rows = [[dict(zip(RUN.names, run)) for run in found.tolist()] for found in runs]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(sizes, pa.int64()), pa.array(rows, run_type), pa.array(rest, pa.string())],
                    names=schema.names,
                )

    found = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInArrow(compute, schema)
    return found.withColumnRenamed("id", id_col)


def collapse(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """All documents, with the words that repeat in periodic runs removed from their texts; a text without runs is as it was."""
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col, SLICE_BYTES):
                _, runs, rest = _of_texts(part.column(text_col))
                texts = [new if len(found) else old for old, new, found in zip(part.column(text_col).to_pylist(), rest, runs)]
                place = part.schema.get_field_index(text_col)
                yield part.set_column(place, part.schema.field(place), pa.array(texts, part.schema.field(place).type))

    return docs.mapInArrow(compute, docs.schema)
