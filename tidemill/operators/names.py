"""Names looked for in texts by their rarest windows of eight bytes: what one task holds of the index behind news.alias_matches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WINDOW = 8
#: The first bytes of a little-endian number, by how many they are.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(WINDOW + 1)], "<u8")
#: Places of texts, and candidates, that are held at a time.
_CHUNK = 1 << 20


def _joined(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and a window of zeros more; where each text begins, and the last one ends."""
    if not len(texts):
        return np.zeros(WINDOW, np.uint8), np.zeros(1, np.int64)
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    _, at, held = texts.buffers()
    at = np.frombuffer(at, "<i8")[texts.offset : texts.offset + len(texts) + 1]
    data = np.zeros(at[-1] - at[0] + WINDOW, np.uint8)
    if len(data) > WINDOW:
        data[:-WINDOW] = np.frombuffer(held, np.uint8)[at[0] : at[-1]]
    return data, at - at[0]


def _windows(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a number; a view."""
    return np.ndarray(len(data) - WINDOW, "<u8", data, strides=(1,))


def _runs(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of runs of n rows: each row's run, and its place in it."""
    run = np.repeat(np.arange(len(n)), n)
    return run, np.arange(len(run)) - (np.cumsum(n) - n)[run]


def _places(tables: list[tuple[int, np.ndarray]], windows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of texts and the number of the key that stands there, by tables of (size, sorted keys), numbered one after the other.

    A table of bits turns most places away before keys are searched.
    """
    odd, opened, base = np.uint64(0x9E3779B97F4A7C15), [], 0
    for size, keys in tables:
        shift = np.uint64(64 - min(max(len(keys).bit_length() + 4, 10), 24))
        seen = np.zeros(1 << 64 - int(shift), bool)
        seen[(keys * odd) >> shift] = True
        opened.append((_FIRST[size], keys, shift, seen, base))
        base += len(keys)
    for start in range(0, len(windows), _CHUNK):
        part = np.array(windows[start : start + _CHUNK])
        for mask, keys, shift, seen, number in opened:
            x = part & mask
            at = np.flatnonzero(seen[(x * odd) >> shift])
            i = np.minimum(np.searchsorted(keys, x[at]), len(keys) - 1)
            same = keys[i] == x[at]
            yield start + at[same], number + i[same]


class Names:
    """Names, each with all its windows; a name of fewer than eight bytes is its own window."""

    def __init__(self, folded: pa.Array):
        self.data, ends = _joined(folded)
        self.start, self.length = ends[:-1], np.diff(ends)
        size = np.minimum(self.length, WINDOW)
        self.name, self.place = _runs(self.length - size + 1)
        key = _windows(self.data)[self.start[self.name] + self.place] & _FIRST[size[self.name]]
        self.number, self.tables, self.windows = np.zeros(len(key), np.int64), [], 0
        for n in np.unique(size):
            of = size[self.name] == n
            keys, at = np.unique(key[of], return_inverse=True)
            self.number[of] = self.windows + at
            self.tables.append((int(n), keys))
            self.windows += len(keys)

    def rarest(self, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each name its window that texts hold least often, as a row of name, place and number, and how often; held: by number."""
        n = held[self.number]
        least = np.minimum.reduceat(n, np.flatnonzero(self.place == 0))
        at = np.flatnonzero(n == least[self.name])
        return at[np.unique(self.name[at], return_index=True)[1]], least


class Counter:
    """How often texts hold each window."""

    def __init__(self, names: Names):
        self.tables, self.windows = names.tables, names.windows

    def __call__(self, batches: Iterator[pa.Array]) -> np.ndarray:
        held = np.zeros(self.windows, np.int64)
        for texts in batches:
            for _, number in _places(self.tables, _windows(_joined(texts)[0])):
                held += np.bincount(number, minlength=self.windows)
        return held


class Finder:
    """Which texts hold which of some names, given by one window each (rows of Names)."""

    def __init__(self, names: Names, rows: np.ndarray):
        rows = rows[np.argsort(names.number[rows], kind="stable")]
        number, self.first = np.unique(names.number[rows], return_index=True)
        self.many = np.diff([*self.first, len(rows)])
        self.which, self.place = names.name[rows], names.place[rows]
        self.data, self.start, self.length = names.data, names.start[self.which], names.length[self.which]
        self.tables, base = [], 0
        for size, keys in names.tables:
            a, b = np.searchsorted(number, [base, base + len(keys)])
            if b > a:
                self.tables.append((size, keys[number[a:b] - base]))
            base += len(keys)

    def __call__(self, batches: Iterator[pa.Array]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows of texts and names of each batch, each pair once."""
        spelled, size = _windows(self.data), np.minimum(self.length, WINDOW)
        for texts in batches:
            data, ends = _joined(texts)
            windows, found = _windows(data), [np.zeros(0, np.int64)]
            for places, keys in _places(self.tables, windows):
                # Parts of the candidates: a place is one for each name of its key.
                upto = np.cumsum(self.many[keys])
                for cut in np.split(np.arange(len(keys)), np.flatnonzero(np.diff(upto // _CHUNK)) + 1):
                    run, k = _runs(self.many[keys[cut]])
                    n = self.first[keys[cut]][run] + k
                    begin, row = places[cut][run] - self.place[n], np.searchsorted(ends, places[cut], "right")[run] - 1
                    inside = (begin >= ends[row]) & (begin + self.length[n] <= ends[row + 1])
                    begin, row, n = begin[inside], row[inside], n[inside]
                    for at in range(0, int(self.length[n].max(initial=0)), WINDOW):
                        at = np.minimum(at, self.length[n] - size[n])
                        same = (windows[begin + at] ^ spelled[self.start[n] + at]) & _FIRST[size[n]] == 0
                        begin, row, n = begin[same], row[same], n[same]
                    found.append(np.unique(row * len(self.which) + n))
            row, n = np.divmod(np.unique(np.concatenate(found)), max(len(self.which), 1))
            yield row, self.which[n]


def automaton(folded: list[str]) -> Callable[[list[str | None]], tuple[list[int], list[int]]]:
    """A function from texts to their rows and the names that they hold, each pair once."""
    import ahocorasick

    found = ahocorasick.Automaton()
    by: dict[str, list[int]] = {}
    for i, f in enumerate(folded):
        by.setdefault(f, []).append(i)
    for f, at in by.items():
        found.add_word(f, at)
    found.make_automaton()

    def read(texts: list[str | None]) -> tuple[list[int], list[int]]:
        rows, hits = [], []
        for row, t in enumerate(texts):
            here = {i for _, at in found.iter(t) for i in at} if t else ()
            rows += [row] * len(here)
            hits += sorted(here)
        return rows, hits

    return read
