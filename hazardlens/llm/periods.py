"""Runs of repeated words: maximal stretches of a text with a small period.

Two words that are ``q`` apart start equal stretches of some length; how long they are is asked
of a table of longest common extensions that sorts only the suffixes from places of a
difference cover: for any two places there is a distance below the cover's modulus after which
both lie in it, so a few words are compared one by one and the rest is read from the common
prefixes of the sorted suffixes, by a sparse table of range minima. For every period ``q`` the
places of a grid are asked, forwards and backwards; a run that repeats often enough holds two
neighbours of its grid, so none is missed, and the grids of a text of n words have n log n
places in all.

Texts of a few hundred thousand characters are worked on together, with a separator of its own
after each, so that extensions end where a text ends.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from hazardlens.llm.common import CHUNK, add_columns_by_chunk

#: Runs hold this many words and this many periods at least.
LEAST, TIMES = 6, 4
# Every difference of two places modulo 13 is that of two members.
MODULUS, COVER = 13, (0, 1, 3, 9)
#: Grid places that are asked at a time; bounds memory only.
ASKED = 1 << 20


def _distances() -> np.ndarray:
    """For residues of two places, the least distance after which both lie in the cover."""
    out = np.full((MODULUS, MODULUS), MODULUS, np.int64)
    for step in range(MODULUS - 1, -1, -1):
        held = np.isin((np.arange(MODULUS) + step) % MODULUS, COVER)
        out[np.ix_(held, held)] = step
    return out


_STEPS = _distances()


class Extensions:
    """Longest common extensions of places of ``words``, integers of which the last is unique."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.size = len(words)
        self.at = np.flatnonzero(np.isin(np.arange(self.size) % MODULUS, COVER))
        self.number = np.full(self.size + MODULUS, -1, np.int64)
        self.number[self.at] = np.arange(len(self.at))
        levels = self._sort()
        order = np.empty(len(self.at), np.int64)
        order[levels[-1]] = np.arange(len(self.at))
        self.rank = levels[-1]
        self.minima = self._table(self._common(order[:-1], order[1:], levels))

    def _later(self, numbers: np.ndarray, distance: int) -> np.ndarray:
        """Sampled suffixes that start ``distance``, a multiple of the modulus, later; -1 beyond the end."""
        return self.number[np.minimum(self.at[numbers] + distance, self.size)]

    def _sort(self) -> list[np.ndarray]:
        """Ranks of the sampled suffixes by their first 13, 26, 52, ... words, until all differ."""
        own = np.arange(len(self.at))
        padded = np.append(self.words, np.full(MODULUS, -1))
        rank = np.zeros(len(self.at), np.int64)
        for i in range(MODULUS):
            rank = self._ranked(rank, padded[self.at + i])
        levels, distance = [rank], MODULUS
        while rank.max(initial=0) < len(self.at) - 1:
            later = self._later(own, distance)
            rank = self._ranked(rank, np.where(later < 0, -1, rank[later]))
            levels.append(rank)
            distance *= 2
        return levels

    @staticmethod
    def _ranked(first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Dense ranks of the pairs."""
        span = int(second.max(initial=0)) + 2
        return np.unique(first * span + second + 1, return_inverse=True)[1]

    def _compare(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words from ``a`` and ``b`` agree, ``most`` at the utmost."""
        out = np.zeros(len(a), np.int64)
        live = np.flatnonzero((most > 0) & (np.maximum(a, b) < self.size))
        for i in range(int(most.max(initial=0))):
            live = live[(self.words[a[live] + i] == self.words[b[live] + i])]
            out[live] = i + 1
            live = live[(most[live] > i + 1) & (np.maximum(a[live], b[live]) + i + 1 < self.size)]
            if not len(live):
                break
        return out

    def _common(self, a: np.ndarray, b: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Common prefixes of neighbours in the order, by the ranks of all lengths."""
        done = np.zeros(len(a), np.int64)
        a, b = a.copy(), b.copy()
        for i in range(len(levels) - 2, -1, -1):
            live = (a >= 0) & (b >= 0)
            same = live & (levels[i][a] == levels[i][b])
            distance = MODULUS << i
            done[same] += distance
            a[same], b[same] = self._later(a[same], distance), self._later(b[same], distance)
        live = np.flatnonzero((a >= 0) & (b >= 0))
        done[live] += self._compare(self.at[a[live]], self.at[b[live]], np.full(len(live), MODULUS))
        return done

    @staticmethod
    def _table(values: np.ndarray) -> list[np.ndarray]:
        """Minima of all ranges of 1, 2, 4, ... values."""
        table, width = [values.astype(np.int32)], 1
        while 2 * width <= len(values):
            table.append(np.minimum(table[-1][:-width], table[-1][width:]))
            width *= 2
        return table

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from ``a`` and from ``b``, which differ, agree."""
        step = _STEPS[a % MODULUS, b % MODULUS]
        out = self._compare(a, b, step)
        on = np.flatnonzero((out == step) & (np.maximum(a, b) + step < self.size))
        x = self.rank[self.number[a[on] + step[on]]]
        y = self.rank[self.number[b[on] + step[on]]]
        low, size = np.minimum(x, y), np.abs(x - y)
        level = np.frexp(size)[1] - 1
        for i in np.unique(level):
            own = np.flatnonzero(level == i)
            row, first = self.minima[i], low[own]
            out[on[own]] += np.minimum(row[first], row[first + size[own] - (1 << i)])
        return out


def _grid(starts: np.ndarray, sizes: np.ndarray, times: int):
    """Periods and places to ask, texts one after the other, about ``ASKED`` at a time."""
    most = sizes // times
    count = np.where(most > 0, most, 0)
    text = np.repeat(np.arange(len(sizes)), count)
    period = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count) + 1
    places = -(-(sizes[text] - period) // ((times - 1) * period))
    ends = np.cumsum(places)
    at = 0
    while at < len(text):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] - places[at] + ASKED, "right")))
        rows = np.repeat(np.arange(at, to), places[at:to])
        k = np.arange(len(rows)) - np.repeat(ends[at:to] - places[at:to] - (ends[at] - places[at]), places[at:to])
        yield period[rows], starts[text[rows]] + k * (times - 1) * period[rows]
        at = to


def find(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """Rows of start, length and period of all runs, by start and period.

    ``words`` holds the texts one after the other, each with a number of its own after it, so
    it ends with one. A run has ``times`` (2 at least) periods and ``least`` words or more. Two
    runs of one place differ in their periods only if one's is a multiple of the other's: the
    smallest one counts.
    """
    if not len(words):
        return np.zeros((0, 3), np.int64)
    on, back = Extensions(words), Extensions(np.append(words[:-1][::-1], words[-1]))
    last = len(words) - 1
    found = [np.zeros((0, 3), np.int64)]
    for period, place in _grid(starts, sizes, times):
        same = words[place] == words[place + period]
        period, place = period[same], place[same]
        after = on.of(place, place + period)
        # Place i of the text is place last - 1 - i of its reverse; what ends before i starts at last - i.
        before = np.zeros(len(place), np.int64)
        inner = np.flatnonzero(place > 0)
        before[inner] = back.of(last - place[inner], last - place[inner] - period[inner])
        length = before + after + period
        long = length >= np.maximum(least, times * period)
        found.append(np.unique(np.stack([place - before, length, period], 1)[long], axis=0))
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    fresh = np.append(True, (rows[1:, :2] != rows[:-1, :2]).any(1))[: len(rows)]
    rows = rows[fresh]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


_RUN = StructType([StructField(n, LongType(), False) for n in ("start", "length", "period")])


def runs(docs: DataFrame, least: int = LEAST, times: int = TIMES, chunk: int = CHUNK) -> DataFrame:
    """``docs`` with ``runs``, an array of start, length and period by start and period, and
    ``collapsed``, the text's words without those that only repeat, joined by spaces.

    Words are runs of anything but ASCII white space, compared as they are, numbered from 0. Of
    every run the first period stays; a word that another run drops is dropped. A null text has
    no words. Texts are looked at whole, however long, one at a time if they exceed ``chunk``
    characters. Rows that repeat stay, an empty table gives no rows, and columns named like the
    results are replaced.
    """

    def make():
        def call(texts: list[str | None]):
            parts = [(t or "").encode().split() for t in texts]
            ids: dict[bytes, int] = {}
            sizes = np.array([len(p) for p in parts], np.int64)
            starts = np.cumsum(sizes + 1) - sizes - 1
            words = np.empty(int(sizes.sum()) + len(parts), np.int64)
            for own, at in zip(parts, starts.tolist(), strict=True):
                words[at : at + len(own)] = [ids.setdefault(w, len(ids)) for w in own]
            words[starts + sizes] = len(ids) + np.arange(len(parts))
            rows = find(words, starts, sizes, least, times)
            edges = np.zeros(len(words) + 1, np.int64)
            np.add.at(edges, rows[:, 0] + rows[:, 2], 1)
            np.add.at(edges, rows[:, 0] + rows[:, 1], -1)
            dropped = np.cumsum(edges)[:-1] > 0
            first = np.searchsorted(rows[:, 0], starts)
            last = np.searchsorted(rows[:, 0], starts + sizes)
            listed, collapsed = [], []
            for own, at, a, b in zip(parts, starts.tolist(), first.tolist(), last.tolist(), strict=True):
                listed.append([dict(start=s - at, length=n, period=q) for s, n, q in rows[a:b].tolist()])
                if a < b:
                    gone = dropped[at : at + len(own)].tolist()
                    own = [w for w, g in zip(own, gone, strict=True) if not g]
                collapsed.append(b" ".join(own).decode())
            return listed, collapsed

        return call

    fields = [StructField("runs", ArrayType(_RUN, False), False), StructField("collapsed", StringType(), False)]
    return add_columns_by_chunk(docs, ["text"], fields, make, chunk)


def looped(text: str = "text", key: str = "doc_id") -> Column:
    """The text of every tenth document, picked by the CRC-32 of its id, as a loop of its own
    words from some place on; other texts, texts without words and those without an id as they are."""
    words = F.array_remove(F.split(F.col(text), r"[\x20\x09-\x0D]+"), "")
    h = F.crc32(F.col(key).cast("string").cast("binary"))
    g = F.floor(h / 10)
    n = F.size(words)
    a = F.pmod(g, F.greatest(n, F.lit(1))).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    loop = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    joined = F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(loop, F.lit(1), n - a)), " ")
    return F.when((h % 10 == 0) & F.rlike(F.col(text), F.lit(r"[^\x20\x09-\x0D]")), joined).otherwise(F.col(text))


def report(docs: DataFrame) -> DataFrame:
    """Per document the number of runs, the longest one (ties: the first, then the smallest
    period) and digests of all runs and of the collapsed text."""
    found = runs(docs.select("doc_id", looped().alias("text"))).select("doc_id", "runs", "collapsed")
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    best = found.select("*", longest.alias("best"))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.floor(F.col("best.length") * 1000 / -F.col("best.p")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
