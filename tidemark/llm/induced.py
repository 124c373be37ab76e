"""External suffix sorting by induction, with common prefixes, in bounded memory.

Suffixes are told apart as usual: a suffix is small if it is smaller than the
one behind it, large otherwise; a small one behind a large one is a seed.

1. Name the substrings from seed to seed: they are dealt to disk queues by
   their first symbol, each queue is sorted by itself, and names rise from
   queue to queue.
2. Sort the seeds by their names: if names repeat, the string of names is
   sorted by the same procedure (recursion); one that fits in ``internal``
   symbols is sorted in memory by doubling.
3. Induce the large suffixes from the seeds in ascending order, then the small
   ones from the large ones in descending order. A queue of tuples (position,
   common prefix with the tuple before) ordered by (first symbol, rank of the
   suffix that induced it) carries them. Ranks only rise while it is read, so
   each first symbol's part is a first-in-first-out file, kept in memory up to
   a bound and on disk beyond.

The common prefix of two neighbours induced from x and y is one more than the
least common prefix between x and y in the order they were scanned. Where the
large suffixes of a symbol meet the small ones, it is the shorter of the two
runs of that symbol.
"""

from __future__ import annotations

import heapq
import os
import tempfile
from collections.abc import Iterator

import numpy as np

CHUNK = 1 << 16  # tuples scanned at a time
INTERNAL = 1 << 24  # symbols of a string of names that are sorted in memory
BUFFER = 1 << 15  # tuples of a queue kept in memory before they go to disk


class Scratch:
    """A task's own scratch folder, removed with the task, like Spark's spill files."""

    def __init__(self):
        self.folder = tempfile.TemporaryDirectory(prefix="induced-")
        self.made = 0

    def path(self) -> str:
        self.made += 1
        return os.path.join(self.folder.name, str(self.made))

    def array(self, size: int, kind) -> np.ndarray:
        return np.memmap(self.path(), kind, "w+", shape=(max(1, size),))[:size]

    def close(self) -> None:
        self.folder.cleanup()


class DiskQueue:
    """First in, first out rows of int64 columns; beyond ``buffer`` rows they are on disk."""

    def __init__(self, scratch: Scratch, columns: int = 2, buffer: int = BUFFER):
        self.scratch, self.columns, self.buffer = scratch, columns, buffer
        self.parts: list[np.ndarray] = []  # in memory, behind what is on disk
        self.held = self.size = self.read = 0
        self.file = None
        self.written = 0

    def push(self, rows: np.ndarray) -> None:
        if len(rows):
            self.parts.append(rows)
            self.held += len(rows)
            self.size += len(rows)
            if self.held > self.buffer:
                self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = open(self.scratch.path(), "w+b")  # noqa: SIM115
        self.file.seek(0, os.SEEK_END)
        for part in self.parts:
            self.file.write(np.ascontiguousarray(part, "<i8").tobytes())
            self.written += len(part)
        self.parts, self.held = [], 0

    def at(self, begin: int, end: int) -> np.ndarray:
        """Rows begin to end, whether read already or not."""
        out = []
        if begin < self.written:
            self.file.flush()
            self.file.seek(begin * 8 * self.columns)
            stop = min(end, self.written)
            out.append(np.frombuffer(self.file.read((stop - begin) * 8 * self.columns), "<i8").reshape(-1, self.columns))
        place = self.written
        for part in self.parts:
            a, b = max(begin - place, 0), min(end - place, len(part))
            if a < b:
                out.append(part[a:b])
            place += len(part)
        return np.concatenate(out) if out else np.zeros((0, self.columns), np.int64)

    def pop(self, most: int) -> np.ndarray:
        rows = self.at(self.read, min(self.size, self.read + most))
        self.read += len(rows)
        return rows

    def close(self) -> None:
        self.parts = []
        if self.file is not None:
            self.file.close()
            os.unlink(self.file.name)
            self.file = None


def seeds_of(text: np.ndarray) -> np.ndarray:
    """Positions of the seeds, ascending. The end of the text counts as smaller than all symbols."""
    found, n = [], len(text)
    next_symbol, next_small = -1, True  # behind the end
    for end in range(n, 0, -CHUNK):
        begin = max(0, end - CHUNK)
        part = np.r_[text[begin:end].astype(np.int64), next_symbol]
        step = np.sign(part[1:] - part[:-1])
        place = np.arange(step.size)
        follow = np.where(step != 0, place, step.size)  # runs of one symbol take the type behind them
        follow = np.minimum.accumulate(follow[::-1])[::-1]
        small = np.where(follow < step.size, np.r_[step, 0][follow] > 0, next_small)
        behind = np.r_[small[1:], next_small]
        # position i + 1 is a seed when it is small and i is large
        seed = np.flatnonzero(~small & behind) + begin + 1
        found.append(seed[seed < n])
        next_symbol, next_small = int(part[0]), bool(small[0])
    return np.concatenate(found[::-1]) if found else np.zeros(0, np.int64)


def _names(text: np.ndarray, seeds: np.ndarray, scratch: Scratch) -> tuple[np.ndarray, int]:
    """Name of each seed's substring, equal for equal ones and in their order; and how many there are."""
    ends = np.r_[seeds[1:], len(text) - 1] + 1  # a substring reaches up to and with the next seed
    names = scratch.array(len(seeds), np.int64)
    first = text[seeds].astype(np.int64)
    count = 0
    order = np.argsort(first, kind="stable")
    bounds = np.flatnonzero(np.r_[True, np.diff(first[order]) != 0, True]) if len(order) else np.zeros(1, np.int64)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        own = order[a:b]
        rank = _ranked(text, seeds[own], ends[own])
        names[own] = rank + count
        count += int(rank.max()) + 1
    return names, count


def _ranked(text: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Dense ranks of substrings text[begin:end], shorter ones behind their extensions.

    Where one substring goes on beyond another's end, the other ends with a
    seed, a small suffix, and the longer one has a large suffix there (else it
    would end too): the longer one comes first.
    """
    n = len(begin)
    beyond = int(text.max()) + 2  # behind a substring; behind the text is 0, symbols are moved up by one
    rank = np.zeros(n, np.int64)
    todo, depth = np.arange(n), 0
    per = max(1, int(62 // np.log2(beyond + 1)))  # symbols packed into a word
    while todo.size:
        word = np.zeros(todo.size, np.int64)
        for k in range(per):
            place = begin[todo] + depth + k
            symbol = text[np.minimum(place, len(text) - 1)].astype(np.int64) + 1
            symbol = np.where(place < end[todo], symbol, np.where(end[todo] == len(text), 0, beyond))
            word = word * (beyond + 1) + symbol
        order = np.lexsort((word, rank[todo]))
        r, w = rank[todo][order], word[order]
        place = np.arange(todo.size)
        group = np.r_[True, r[1:] != r[:-1]]
        new = group | np.r_[True, w[1:] != w[:-1]]
        # A tie's members get the tie's rank plus the number of members before their first equal.
        rank[todo[order]] = r + np.maximum.accumulate(np.where(new, place, 0)) - np.maximum.accumulate(np.where(group, place, 0))
        depth += per
        size = np.bincount(np.cumsum(new) - 1)
        todo = todo[order][np.repeat(size, size) > 1]
        todo = todo[begin[todo] + depth < end[todo]]
    return np.unique(rank, return_inverse=True)[1]


def _doubled(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, common prefixes in names) of the suffixes of a string in memory, by doubling ranks."""
    n = len(names)
    rank = np.unique(names, return_inverse=True)[1].astype(np.int64)
    levels = [rank]
    step = 1
    while rank.max() + 1 < n:
        behind = np.zeros(n, np.int64)
        behind[: n - step] = rank[step:] + 1
        both = rank * (n + 1) + behind
        rank = np.unique(both, return_inverse=True)[1].astype(np.int64)
        levels.append(rank)
        step *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    a, b = order[1:].copy(), order[:-1].copy()
    common = np.zeros(n, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        inside = (a < n) & (b < n)
        equal = inside & (levels[k][np.minimum(a, n - 1)] == levels[k][np.minimum(b, n - 1)])
        # equal ranks of a level mean equal names over its width, cut at the end of the string
        common[1:] += np.where(equal, 1 << k, 0)
        a, b = a + np.where(equal, 1 << k, 0), b + np.where(equal, 1 << k, 0)
    return order, common


def _common_of(text: np.ndarray, seeds: np.ndarray, order: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Common prefixes of neighbouring seeds in symbols, from those in names."""
    n = len(order)
    out = np.zeros(n, np.int64)
    for begin in range(1, n, CHUNK):
        end = min(n, begin + CHUNK)
        a, b, k = order[begin:end], order[begin - 1 : end - 1], common[begin:end]
        full = np.r_[seeds, len(text)]
        ia, ib = np.minimum(a + k, len(seeds)), np.minimum(b + k, len(seeds))
        length = full[ia] - seeds[a]
        x, y = full[ia].copy(), full[ib].copy()
        todo = np.arange(end - begin)
        while todo.size:  # the names behind differ, so this ends within a substring
            inside = (x[todo] < len(text)) & (y[todo] < len(text))
            todo = todo[inside]
            todo = todo[text[x[todo]] == text[y[todo]]]
            length[todo] += 1
            x[todo] += 1
            y[todo] += 1
        out[begin:end] = length
    return out


class _Induction:
    """One scan over the sorted suffixes, pushing the suffixes in front of them."""

    def __init__(self, text: np.ndarray, scratch: Scratch, rising: bool, chunk: int):
        self.text, self.scratch, self.rising, self.chunk = text, scratch, rising, chunk
        self.queues: dict[int, DiskQueue] = {}
        self.pending: list[int] = []
        self.since: dict[int, int] = {}  # least common prefix since the last push for a symbol
        self.floor = 0  # scan number of the symbol's least values
        self.history: dict[int, int] = {}

    def push(self, symbol: int, rows: np.ndarray) -> None:
        if symbol not in self.queues:
            self.queues[symbol] = DiskQueue(self.scratch)
            heapq.heappush(self.pending, symbol if self.rising else -symbol)
        self.queues[symbol].push(rows)

    def scan(self, position: np.ndarray, common: np.ndarray, small: bool) -> None:
        """Suffixes next in order, of one symbol; ``common`` with the suffix scanned before."""
        at = np.flatnonzero(position > 0)
        before = self.text[position[at] - 1].astype(np.int64)
        here = self.text[position[at]].astype(np.int64)
        if self.rising:  # large suffixes: in front of a large one also an equal symbol
            right = before > here if small else before >= here
        else:
            right = before <= here if small else before < here
        at, before = at[right], before[right]
        least = int(common.min()) if len(common) else NEVER
        if at.size:
            order = np.argsort(before, kind="stable")
            at, before = at[order], before[order]
            new = np.r_[True, before[1:] != before[:-1]]
            begin = np.where(new, 0, np.r_[0, at[:-1] + 1])
            edges = np.empty(2 * at.size, np.int64)
            edges[::2], edges[1::2] = begin, at + 1
            padded = np.r_[common, NEVER]
            value = np.minimum.reduceat(padded, edges)[::2] + 1
            starts = np.flatnonzero(new)
            stops = np.r_[starts[1:], at.size]
            touched = before[starts].tolist()
            tails = np.minimum.reduceat(padded, np.c_[at[stops - 1] + 1, np.full(len(stops), len(common))].ravel().clip(0, len(common)))[::2]
            tails = np.where(at[stops - 1] + 1 >= len(common), NEVER, tails)
            for k, symbol in enumerate(touched):
                known = self._since(symbol)
                value[starts[k]] = 0 if known is None else min(int(value[starts[k]]), known + 1)
                self.push(symbol, np.c_[position[at[starts[k] : stops[k]]] - 1, value[starts[k] : stops[k]]])
            self._note(least, dict(zip(touched, tails.tolist(), strict=True)))
        else:
            self._note(least, {})

    def _since(self, symbol: int) -> int | None:
        if symbol not in self.since:
            return None
        return self.since[symbol]

    def _note(self, least: int, fresh: dict[int, int]) -> None:
        for symbol, value in self.since.items():
            if value > least and symbol not in fresh:
                self.since[symbol] = least
        self.since.update(fresh)


NEVER = 1 << 40


def _run_length(text: np.ndarray, position: int) -> int:
    """Length of the run of one symbol at a position."""
    symbol, k = text[position], position
    while k < len(text):
        part = text[k : k + 256]
        other = np.flatnonzero(part != symbol)
        if other.size:
            return k + int(other[0]) - position
        k += len(part)
    return k - position


def sorted_suffixes(
    text: np.ndarray, scratch: Scratch, chunk: int = CHUNK, internal: int = INTERNAL
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, common prefixes with the suffix given before) of all suffixes, in DESCENDING order."""
    n = len(text)
    if not n:
        return
    seeds = seeds_of(text)
    if len(seeds):
        names, count = _names(text, seeds, scratch)
        if count == len(seeds):
            order = np.empty(len(seeds), np.int64)
            order[names] = np.arange(len(seeds))
            common = np.zeros(len(seeds), np.int64)
        elif len(seeds) <= internal:
            order, common = _doubled(np.asarray(names))
        else:
            order, common = scratch.array(len(seeds), np.int64), scratch.array(len(seeds), np.int64)
            place, after = len(seeds), 0
            for p, c in sorted_suffixes(names, scratch, max(64, chunk // 16), internal):
                # descending pieces: c[i] belongs between the suffix before and p[i]; ascending it is the former's
                order[place - len(p) : place] = p[::-1]
                at = np.arange(place - len(p), place)[::-1] + 1
                ok = at < len(seeds)
                common[at[ok]] = c[ok]
                place -= len(p)
                after += len(p)
            common[0] = 0
        common = _common_of(text, seeds, order, common)
        seeds = seeds[order]
        first = text[seeds].astype(np.int64)
        bounds = np.flatnonzero(np.r_[True, first[1:] != first[:-1], True])
        seed_range = {int(first[a]): (int(a), int(b)) for a, b in zip(bounds[:-1], bounds[1:], strict=True)}
    else:
        common, seed_range = np.zeros(0, np.int64), {}

    # Large suffixes, ascending. The last suffix is large and first of its symbol: the empty suffix induces it.
    rising = _Induction(text, scratch, True, chunk)
    rising.push(int(text[-1]), np.array([[n - 1, 0]]))
    rising.since[int(text[-1])] = 0
    for symbol in seed_range:
        heapq.heappush(rising.pending, symbol)
    large: dict[int, DiskQueue] = {}
    done = -1
    while rising.pending:
        symbol = heapq.heappop(rising.pending)
        if symbol == done:
            continue
        done = symbol
        queue = rising.queues.get(symbol)
        last = None
        fresh = True
        if queue is not None:
            while queue.read < queue.size:
                rows = queue.pop(chunk)
                c = rows[:, 1].copy()
                if fresh:
                    c[0], fresh = 0, False
                rising.scan(rows[:, 0], c, False)
                last = int(rows[-1, 0])
            large[symbol] = queue
        a, b = seed_range.get(symbol, (0, 0))
        for k in range(a, b, chunk):
            p, c = seeds[k : min(b, k + chunk)], common[k : min(b, k + chunk)].copy()
            if k == a:
                c[0] = 0 if last is None else min(_run_length(text, last), _run_length(text, int(p[0])))
            rising.scan(p, c, True)

    # Small suffixes, descending, from the large ones and each other.
    falling = _Induction(text, scratch, False, chunk)
    for symbol in large:
        heapq.heappush(falling.pending, -symbol)
    done = None
    while falling.pending:
        symbol = -heapq.heappop(falling.pending)
        if symbol == done:
            continue
        done = symbol
        queue = falling.queues.get(symbol)
        last, fresh = None, True
        if queue is not None:
            while queue.read < queue.size:
                rows = queue.pop(chunk)
                c = rows[:, 1].copy()
                if fresh:
                    c[0], fresh = 0, False
                falling.scan(rows[:, 0], c, True)
                last = int(rows[-1, 0])
                yield rows[:, 0], c
            queue.close()
        own = large.get(symbol)
        if own is not None:
            for end in range(own.size, 0, -chunk):
                begin = max(0, end - chunk)
                rows = own.at(begin, min(own.size, end + 1))
                p = rows[: end - begin, 0][::-1]
                # between p[i] and the larger one scanned before stands the larger one's value
                c = np.r_[rows[1:, 1], 0][: end - begin][::-1].copy() if end == own.size else rows[1 : end - begin + 1, 1][::-1].copy()
                if end == own.size:
                    c[0] = 0 if last is None else min(_run_length(text, last), _run_length(text, int(p[0])))
                falling.scan(p, c, False)
                yield p, c
            own.close()
