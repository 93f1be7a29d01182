"""Periodic runs of words: Lyndon arrays by grouping, roots extended to runs.

The first phase of a grouping suffix sorter handles the groups of suffixes from the highest down. Every suffix of
the group is taken out of the list of open positions; its left neighbour there is the suffix whose Lyndon prefix
ends where it starts, so that prefix grows by the group's and its suffix moves to a new group right above its old
one (further up the more members of the group follow it). When all groups are done each suffix has the longest
Lyndon word that starts at it. This is done under the order of the words' numbers and under its reverse: every
run has, under one of the two, a Lyndon word of its period's length at each position where its root starts.
Roots are extended to both sides by the longest common extension (hash prefix sums and binary search), and each
run is verified word by word.

Runs have four periods and more here, so they hold only words that occur at least four times in them. Texts are
cut at all rarer words, again in each part, until nothing changes; only parts that may hold a run are grouped.
This loses no run and ends none early.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import Words, mix, pieces
from .sentencepiece_scan import ragged

PERIODS = 4  # a run has at least so many periods
SHORTEST = 6  # and at least so many words
OUTPUT = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
SCHEMA = pa.schema([("doc_id", pa.int64())] + [(c, pa.int64()) for c in ("n_runs", "start", "length", "period", "exponent_milli")] + [("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())])


def lyndon_lengths(symbols: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word that starts at each position.

    Symbols are numbers; 0 is below all others, ends every word before it and must stand first.
    """
    n = len(symbols)
    order = np.argsort(-symbols, kind="stable")
    first = np.flatnonzero(np.diff(symbols[order], prepend=-1))
    groups = [g.tolist() for g in np.split(order, first[1:])]  # highest symbol first, positions ascending
    lowest = len(groups) - 1
    group_of = np.empty(n, np.int64)
    group_of[order] = np.repeat(np.arange(len(groups)), np.diff(np.append(first, n)))
    group_of = group_of.tolist()
    above, below = list(range(-1, lowest)), list(range(1, lowest + 2))
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    length = [1] * n
    group = 0
    while group != lowest:
        members = [s for s in groups[group] if group_of[s] == group]
        groups[group] = None
        grown: dict[tuple[int, int], list[int]] = {}  # by old group and number of members that follow
        last, count = -1, 0
        for s in members:
            p, r = left[s], right[s]
            right[p] = r
            if r < n:
                left[r] = p
            if p == last:
                count += 1
            else:
                if last >= 0 and group_of[last] != lowest:
                    grown.setdefault((group_of[last], count), []).append(last)
                last, count = p, 1
        if last >= 0 and group_of[last] != lowest:
            grown.setdefault((group_of[last], count), []).append(last)
        if grown:
            size = length[members[0]]
            for old, count in sorted(grown, reverse=True):
                moved, new = grown[old, count], len(groups)
                groups.append(moved)
                over = above[old]
                above.append(over)
                below.append(old)
                above[old] = new
                if over >= 0:
                    below[over] = new
                for p in moved:
                    group_of[p] = new
                    length[p] += count * size
        group = below[group]
    return np.array(length, np.int64)


class Extensions:
    """Longest common extensions in a sequence of 64-bit numbers, by polynomial prefix sums modulo two primes."""

    PRIMES = ((2147483647, 1289706101), (2147483629, 747796405))  # modulus and base

    def __init__(self, values: np.ndarray):
        self.n = len(values)
        scrambled = mix(values)
        self.tables = []
        for prime, base in self.PRIMES:
            up = np.ones(1, np.int64)
            while len(up) <= self.n:
                up = np.concatenate([up, up * pow(base, len(up), prime) % prime])
            term = (scrambled % np.uint64(prime)).astype(np.int64) * up[: self.n] % prime
            self.tables.append((prime, up, np.concatenate([[0], np.cumsum(term)])))

    def equal(self, i: np.ndarray, j: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether ``size`` values from i and from j >= i on are equal (nearly certain if so)."""
        same = np.ones(len(i), bool)
        for prime, up, sums in self.tables:
            same &= (sums[i + size] - sums[i]) % prime * up[j - i] % prime == (sums[j + size] - sums[j]) % prime
        return same

    def _longest(self, most: np.ndarray, same) -> np.ndarray:
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            fits = same(middle)
            low, high = np.where(fits, middle, low), np.where(fits, high, middle - 1)
        return low

    def right(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return self._longest(self.n - j, lambda size: self.equal(i, j, size))

    def left(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Values before i that equal those before j."""
        return self._longest(i, lambda size: self.equal(i - size, j - size, size))


def runs_of(symbols: np.ndarray) -> np.ndarray:
    """Rows (start, end, period), sorted, of all runs with PERIODS periods and SHORTEST values.

    Symbols are positive numbers; 0 separates parts, and no run reaches over one.
    """
    none = np.zeros((0, 3), np.int64)
    if not len(symbols) or not symbols.any():
        return none
    values = np.concatenate([[0], symbols])
    zero = values == 0
    distinct = values.astype(np.uint64)
    distinct[zero] = (1 << 40) + np.arange(zero.sum(), dtype=np.uint64)
    extend = Extensions(distinct)
    found = []
    for ranks in (values, np.where(zero, 0, values.max() + 1 - values)):
        period = lyndon_lengths(ranks)
        i = np.flatnonzero(~zero & (np.arange(len(values)) + (PERIODS - 1) * period <= len(values)))
        q = period[i]
        rooted = extend.equal(i, i + q, (PERIODS - 2) * q)
        i, q = i[rooted], q[rooted]
        start, end = i - extend.left(i, i + q), i + q + extend.right(i, i + q)
        keep = end - start >= np.maximum(PERIODS * q, SHORTEST)
        found.append(np.stack([start, end, q], axis=1)[keep])
    for start, end, q in (out := np.unique(np.concatenate(found), axis=0)).tolist():
        if not np.array_equal(distinct[start : end - q], distinct[start + q : end]):
            raise ArithmeticError("two different runs of words have one hash")
    return out - [1, 1, 0]


def frequent_parts(word: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions that may lie in a run, and the number of the part that each belongs to."""
    at, part = np.arange(len(word)), doc
    while True:
        _, inverse, count = np.unique(part * (int(word.max(initial=0)) + 1) + word[at], return_inverse=True, return_counts=True)
        stay = count[inverse] >= PERIODS
        at, old = at[stay], part[stay]
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) != 1) | (np.diff(old) != 0)
        part = np.cumsum(new) - 1
        size = np.bincount(part)
        long = size[part] >= SHORTEST if len(at) else np.zeros(0, bool)
        at, part = at[long], part[long]
        if stay.all() and long.all():
            return at, part


def periodic_tail(ids: list[int | None], count: np.ndarray) -> np.ndarray:
    """Word (within its document) that stands at each place: documents with a hash that ends in 0 repeat a stretch to their end."""
    first = np.concatenate([[0], np.cumsum(count)])
    source = np.arange(first[-1]) - np.repeat(first[:-1], count)
    for d, i in enumerate(ids):
        n = int(count[d])
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            source[first[d] + a : first[d + 1]] = a + np.arange(n - a) % p
    return source


def _piece(ids: list[int | None], data: np.ndarray, offsets: np.ndarray, tail: bool) -> pa.RecordBatch:
    words = Words(data, offsets, lower=False)
    first = np.concatenate([[0], np.cumsum(words.count)])
    at = np.arange(first[-1])
    if tail:
        at = np.repeat(first[:-1], words.count) + periodic_tail(ids, words.count)
    _, number = np.unique(words.hashes, return_inverse=True)
    number = number[at] + 1
    place, part = frequent_parts(number, words.doc)
    cut = np.flatnonzero(np.diff(part)) + 1
    runs = runs_of(np.insert(number[place], cut, 0))
    back = np.insert(place, cut, -1)
    size = runs[:, 1] - runs[:, 0]
    runs = np.stack([back[runs[:, 0]], size, runs[:, 2]], axis=1)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]

    covered = np.zeros(first[-1] + 1, np.int64)
    np.add.at(covered, runs[:, 0] + runs[:, 2], 1)
    np.add.at(covered, runs[:, 0] + runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(covered[:-1]) == 0)
    width = words.end[at[kept]] - words.start[at[kept]] + 1  # with the byte that follows, made a blank
    joined = np.append(words.data, 32)[ragged(words.start[at[kept]], width)].astype(np.uint8)
    ends = np.cumsum(width)
    joined[ends - 1] = 32
    byte_of = np.concatenate([[0], ends])[np.searchsorted(kept, first)]
    text = joined.tobytes()

    of = np.searchsorted(runs[:, 0], first)
    rows = []
    for d, i in enumerate(ids):
        mine = [(s - int(first[d]), n, q) for s, n, q in runs[of[d] : of[d + 1]].tolist()]
        best: tuple[int | None, int | None, int | None] = (None, None, None)
        for run in mine:  # sorted by start and period, so the first of equals stays
            if best[0] is None or run[1] * best[2] > best[1] * run[2]:
                best = run
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in mine)
        collapsed = text[byte_of[d] : max(byte_of[d], byte_of[d + 1] - 1)]
        exponent = None if best[0] is None else 1000 * best[1] // best[2]
        rows.append((i, len(mine), *best, exponent, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed).hexdigest()))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), SCHEMA)], schema=SCHEMA)


def detect_runs(docs: DataFrame, tail: bool = False) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): ``n_runs``, the best run (``start``, ``length``, ``period``,
    ``exponent_milli``), ``runs_sha256`` of all runs and ``collapsed_sha256`` of the text without repeated periods.

    With ``tail`` documents whose hashed id ends in 0 repeat a stretch of words up to their end first (those
    with a NULL id never do). NULL and empty texts have no words and no runs. Rows are independent, so repeated rows give
    repeated results and an empty table an empty one; other columns are ignored.
    """

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            ids = batch.column("doc_id").to_pylist()
            for row, end, data, offsets in pieces(batch):
                yield _piece(ids[row:end], data, offsets, tail)

    return docs.select("doc_id", "text").mapInArrow(batches, OUTPUT)
