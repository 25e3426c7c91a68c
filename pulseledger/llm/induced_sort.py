"""Suffix arrays with common prefixes by external induced sorting.

``ExternalSorter`` sorts the suffixes of a sequence of symbols. Its core follows
induced sorting: suffixes smaller (S) or larger (L) than the one after them; the
leftmost S suffixes of each S run (LMS) are sorted first, by naming the LMS
substrings and sorting the string of names recursively, and all others are
induced from them by two scans in suffix order.

Scans are driven by priority queues keyed by first symbol. As a scan proceeds in
order, a queue is monotone: what is pushed for a symbol comes out in the order it
went in, so runs need no sorting. Queues move whole runs of tuples (position,
common prefix with the tuple before it), and beyond a memory budget they write
runs to an unlinked temporary file, which nothing else reads and which vanishes
with the task. Common prefixes are induced along with the suffixes, as one more than
the smallest value met since the last tuple of the same symbol; they are cut
at ``cap``, as only prefixes up to the match length matter.

Symbol 0 is a separator: it ends a text, and no common prefix goes beyond it.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

# Bytes of queued tuples that a sorter holds in memory before it writes runs out.
MEMORY = 64 << 20


class RunQueue:
    """Monotone priority queue of runs of (position, prefix) per symbol."""

    def __init__(self, memory: int):
        self.memory, self.held = memory, 0
        self.runs: dict[int, list] = {}
        self.file = None

    def push(self, symbol: int, positions: np.ndarray, prefixes: np.ndarray) -> None:
        run = np.stack([positions, prefixes])
        self.held += run.nbytes
        self.runs.setdefault(symbol, []).append(run)
        if self.held > self.memory:
            self._write_out()

    def _write_out(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for runs in self.runs.values():
            for i, run in enumerate(runs):
                if isinstance(run, np.ndarray):
                    runs[i] = (self.file.tell(), run.shape[1])
                    self.file.write(run.tobytes())
        self.held = 0

    def pop(self, symbol: int) -> Iterator[np.ndarray]:
        """The runs of a symbol in order, also those pushed meanwhile."""
        runs, i = self.runs.get(symbol, []), 0
        while i < len(runs):
            run, runs[i] = runs[i], None
            i += 1
            if isinstance(run, np.ndarray):
                self.held -= run.nbytes
                yield run
            else:
                self.file.seek(run[0])
                yield np.frombuffer(self.file.read(16 * run[1]), np.int64).reshape(2, -1)
        self.runs.pop(symbol, None)


class ExternalSorter:
    """Suffix array and common prefixes of a text of symbols ending in 0."""

    def __init__(self, text: np.ndarray, cap: int, memory: int = MEMORY):
        self.text, self.cap, self.memory = text, cap, memory
        self.small = self._types()
        # The 8 symbols at each place, and the distance to the next separator.
        n = len(text)
        padded = np.append(text, np.zeros(15, np.uint8)).tobytes()
        self.words = np.empty(n + 8, np.uint64)
        for k in range(8):
            part = np.frombuffer(padded, "<u8", count=(n + 15 - k) // 8, offset=k)
            self.words[k::8] = part[: len(self.words[k::8])]
        stops = np.flatnonzero(text == 0)
        self.distance = np.append(stops[np.searchsorted(stops, np.arange(n))] - np.arange(n), np.zeros(8, np.int64))

    def _types(self) -> np.ndarray:
        """True for S suffixes: the next different symbol is larger. The
        separator is smaller than all, the last one counts as S."""
        text = self.text
        n = len(text)
        small = np.zeros(n, bool)
        small[-1] = True
        if n > 1:
            rises = text[:-1] < text[1:]
            differs = np.append(text[:-1] != text[1:], True)
            at = np.flatnonzero(differs)  # ends of runs of equal symbols
            decided = np.append(rises, True)
            small = decided[at[np.searchsorted(at, np.arange(n))]]
        # Each separator stands for a distinct smallest symbol.
        small[text == 0] = True
        return small

    def common_prefix(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Symbols that the suffixes at ``a`` and ``b`` share, at most the cap
        and not beyond a separator. Only pairs that still agree are read on."""
        limit = np.minimum(np.minimum(self.distance[a], self.distance[b]), self.cap)
        out = np.zeros(len(a), np.int64)
        left = np.flatnonzero(limit > 0)
        k = 0
        while len(left):
            differ = self.words[a[left] + k] ^ self.words[b[left] + k]
            lowest = (differ & (~differ + np.uint64(1))).astype(np.float64)
            same = np.where(differ == 0, 8, np.log2(np.maximum(lowest, 1.0)).astype(np.int64) // 8)
            out[left] += same
            k += 8
            left = left[(same == 8) & (limit[left] > k)]
        return np.minimum(out, limit)

    def lms(self) -> np.ndarray:
        small = self.small
        return np.flatnonzero(small & ~np.append(True, small[:-1]))

    def sort(self) -> tuple[np.ndarray, np.ndarray]:
        """Positions in suffix order, and each one's prefix with the one before."""
        starts = self.lms()
        order = self._sorted_lms(starts)
        prefixes = np.zeros(len(order), np.int64)
        if len(order) > 1:
            prefixes[1:] = self.common_prefix(order[:-1], order[1:])
        large = self._induce(order, prefixes, False)
        return self._merge(large, self._induce(*large, True))

    def _sorted_lms(self, starts: np.ndarray) -> np.ndarray:
        """LMS suffixes in order: name their substrings, recurse if names repeat."""
        if len(starts) < 2:
            return starts
        # Substrings up to and with the next LMS symbol, named in order of
        # content by rounds of 8 symbols; a substring ends at its last symbol.
        n = len(self.text)
        ends = np.append(starts[1:], n - 1)
        lengths = ends - starts + 1
        names = np.zeros(len(starts), np.int64)
        open_ = np.arange(len(starts))
        # What goes beyond the end of another substring is smaller: there the
        # other one has an S symbol, this one an equal L symbol. So ends pad high.
        width = (int(self.text.max()) + 1).bit_length()
        beyond = (1 << width) - 1
        per_round = max(1, 62 // width)
        offset = 0
        while len(open_):
            key = np.zeros(len(open_), np.int64)
            for k in range(offset, offset + per_round):
                at = starts[open_] + k
                inside = k < lengths[open_]
                value = np.where(inside, self.text[np.minimum(at, n - 1)].astype(np.int64), beyond)
                key = (key << width) | value
            rank = np.lexsort((key, names[open_])) if offset else np.argsort(key)
            group, sorted_key = names[open_][rank], key[rank]
            new_group = np.append(True, group[1:] != group[:-1])
            new = new_group | np.append(True, sorted_key[1:] != sorted_key[:-1])
            # A name is the number of suffixes before its group, so that names
            # of groups split later stay between their neighbours.
            first = np.maximum.accumulate(np.where(new, np.arange(len(rank)), 0))
            group_first = np.maximum.accumulate(np.where(new_group, np.arange(len(rank)), 0))
            names[open_[rank]] = group + (first - group_first)
            size = np.bincount(np.cumsum(new) - 1)
            alone = np.empty(len(rank), bool)
            alone[rank] = (size == 1)[np.cumsum(new) - 1]
            offset += per_round
            open_ = open_[~alone & (lengths[open_] > offset)]
        if len(np.unique(names)) == len(names):
            return starts[np.argsort(names)]
        # Equal texts that end in separators are equal for us; ties go by position.
        reduced = np.append(np.unique(names, return_inverse=True)[1].astype(np.int64) + 1, 0)
        separators = self.text[starts] == 0
        reduced[:-1][separators] = 0
        inner = _reduced_order(reduced)
        return starts[inner]

    def _induce(self, order: np.ndarray, prefixes: np.ndarray, up: bool) -> tuple[np.ndarray, np.ndarray]:
        """One scan: L suffixes from the LMS ones in ascending order, or
        (``up``) S suffixes from the L ones in descending order.

        Returns the scanned type's positions in suffix order with prefixes.
        """
        text, wanted = self.text, ~self.small if not up else self.small
        sign = -1 if up else 1
        queue = RunQueue(self.memory)
        if up:
            # Scan backwards: the prefix belongs to the pair, so it moves by one.
            order, prefixes = order[::-1], np.append(0, prefixes[:0:-1])
        symbols = text[order]
        cuts = np.flatnonzero(np.append(True, symbols[1:] != symbols[:-1])) if len(order) else np.zeros(0, int)
        seeds = {int(symbols[s]): (s, e) for s, e in zip(cuts, np.append(cuts[1:], len(order)), strict=True)}
        alphabet = np.unique(text)
        number = np.zeros(int(text.max()) + 1, np.uint8 if len(alphabet) <= 256 else np.uint16)
        number[alphabet] = np.arange(len(alphabet))
        # Smallest prefix since the last push for each symbol.
        since = np.full(len(alphabet), self.cap, np.int64)
        pushed = np.zeros(len(alphabet), bool)
        found: list[np.ndarray] = []

        def scan(positions: np.ndarray, values: np.ndarray) -> None:
            before = positions - 1
            ok = before >= 0
            ok &= wanted[before] & (text[before] != 0)  # -1 reads the end, which is not ok
            where = np.flatnonzero(ok)
            if not len(where):
                np.minimum(since, values.min(initial=self.cap), out=since)
                return
            targets = number[text[before[where]]]  # small numbers: the stable sort is a radix sort
            by = np.argsort(targets, kind="stable")
            hit = np.unique(targets)
            missed = np.ones(len(since), bool)
            missed[hit] = False
            low = int(values.min())
            bounds = np.searchsorted(targets[by], hit)
            for t, s, e in zip(hit, bounds, np.append(bounds[1:], len(by)), strict=True):
                at = where[by[s:e]]
                # Minima of the stretches up to each push, and after the last.
                stretch = np.minimum.reduceat(values[: at[-1] + 1], np.append(0, at[:-1] + 1))
                stretch[0] = min(stretch[0], since[t])
                out = np.minimum(stretch + 1, self.cap)
                if not pushed[t]:
                    out[0] = 0
                    pushed[t] = True
                queue.push(int(alphabet[t]), before[at], out)
                rest = values[at[-1] + 1 :]
                since[t] = int(rest.min()) if len(rest) else self.cap
            since[missed] = np.minimum(since[missed], low)

        for symbol in alphabet[::sign]:
            symbol = int(symbol)
            first = True
            for run in queue.pop(symbol):
                positions, values = run[0], run[1].copy()
                found.append(np.stack([positions, values]))
                if first:
                    values[0] = 0  # another symbol came before
                    first = False
                scan(positions, values)
            seed = seeds.get(symbol)
            if seed is None:
                continue
            positions, values = order[seed[0] : seed[1]], prefixes[seed[0] : seed[1]].copy()
            if first:
                values[0] = 0
            else:
                tail = found[-1][0, -1:]
                values[0] = self.common_prefix(tail, positions[:1])[0]
            scan(positions, values)
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        positions, values = np.concatenate(found, axis=1)
        if up:
            positions, values = positions[::-1], np.append(0, values[:0:-1])
        return positions, values

    def _merge(self, large, small) -> tuple[np.ndarray, np.ndarray]:
        """L and S suffixes together: within a symbol the L ones come first."""
        positions = np.concatenate([large[0], small[0]])
        values = np.concatenate([large[1], small[1]])
        kind = np.append(np.zeros(len(large[0]), np.int64), np.ones(len(small[0]), np.int64))
        symbols = self.text[positions]
        by = np.argsort(2 * symbols.astype(np.uint16) + kind.astype(np.uint16), kind="stable")
        positions, values, kind, symbols = positions[by], values[by], kind[by], symbols[by]
        if len(positions):
            turn = np.append(True, (kind[1:] != kind[:-1]) | (symbols[1:] != symbols[:-1]))
            seam = np.flatnonzero(turn)
            values[seam] = 0
            inner = seam[(seam > 0) & (symbols[seam] == symbols[np.maximum(seam - 1, 0)])]
            values[inner] = self.common_prefix(positions[inner - 1], positions[inner])
        return positions, values


def _reduced_order(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of the string of names (without its last 0).

    The recursion on names. Names are many and texts short, so ranks are
    refined by doubling instead of one scan step per name.
    """
    n = len(names) - 1
    rank, ended = names[:-1].copy(), names[:-1] == 0
    step, groups = 1, 0
    while True:
        following = np.zeros(n, np.int64)
        following[: max(n - step, 0)] = rank[step:]
        following[ended] = 0
        key = rank * (n + 2) + following
        order = np.argsort(key)
        ranked = key[order]
        new = np.append(True, ranked[1:] != ranked[:-1])
        if int(new.sum()) == groups or step >= n:
            return order
        groups = int(new.sum())
        rank[order] = np.cumsum(new)
        rank[ended] = 0
        step *= 2
