"""Suffix and common-prefix arrays by induced sorting with disk-backed bucket queues.

The queue of suffixes to come is a priority queue over first symbols whose buckets are first in, first out: what
is induced into a bucket arrives in order. Entries are tuples (place, common prefix with the bucket's entry before).
Buckets over the memory budget go to files, and the text itself is a mapped file then. Common prefixes are
carried along: of two suffixes induced in a row into one bucket it is 1 plus the least value scanned between their sources.
"""

from __future__ import annotations

import os
import shutil
import tempfile

import numpy as np

#: Symbols: 0 closes the text, 1 parts its strings, byte b is b + 2.
SIZE = 258
CAP = 20_000


class Buckets:
    """FIFO queues of (place, common prefix), one a symbol; in memory up to `budget` bytes, then in files."""

    def __init__(self, budget: int, folder: str | None):
        self.held: list[list] = [[] for _ in range(SIZE)]
        self.budget, self.bytes, self.folder, self.files = budget, 0, folder, 0

    def push(self, c: int, places: np.ndarray, common: np.ndarray) -> None:
        self.bytes += places.nbytes + common.nbytes
        self.held[c].append((places, common))
        if self.bytes > self.budget and self.folder:
            for k, parts in enumerate(self.held):
                if any(not isinstance(x, str) for x in parts):
                    self.held[k] = [x if isinstance(x, str) else self._write(x) for x in parts]
            self.bytes = 0

    def _write(self, pair) -> str:
        self.files += 1
        name = os.path.join(self.folder, f"{id(self):x}-{self.files}.npz")
        with open(name, "wb") as f:
            np.save(f, pair[0])
            np.save(f, pair[1])
        return name

    def pop(self, c: int) -> tuple[np.ndarray, np.ndarray]:
        """All that the bucket holds now, which leaves it."""
        parts, out = self.held[c], []
        self.held[c] = []
        for x in parts:
            if isinstance(x, str):
                with open(x, "rb") as f:
                    out.append((np.load(f), np.load(f)))
                os.unlink(x)
            else:
                self.bytes -= x[0].nbytes + x[1].nbytes
                out.append(x)
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int32)
        return (np.concatenate([x[0] for x in out]), np.concatenate([x[1] for x in out])) if len(out) > 1 else out[0]


class _Carrier:
    """Common prefixes between the pushes into each bucket, along one scan."""

    def __init__(self):
        self.low = np.full(SIZE, CAP, np.int32)
        self.empty = np.ones(SIZE, bool)

    def push(self, into: Buckets, text, sources: np.ndarray, common: np.ndarray, which: np.ndarray) -> None:
        """Scan sources (with their common prefixes); those at `which` push the suffix before them."""
        if len(which):
            chars = text[sources[which] - 1]
            order = np.argsort(chars, kind="stable")
            at, chars = which[order], chars[order]
            first = np.concatenate([[True], chars[1:] != chars[:-1]])
            start = np.where(first, 0, np.concatenate([[0], at[:-1] + 1]))
            least = self._range_min(common, start, at + 1)
            least[first] = np.minimum(least[first], self.low[chars[first]])
            values = np.minimum(least + 1, CAP).astype(np.int32)
            cuts = np.append(np.flatnonzero(first), len(at))
            self.low = np.minimum(self.low, common.min())
            tails = at[cuts[1:] - 1] + 1
            seen = chars[cuts[:-1]]
            self.low[seen] = np.where(tails < len(common), self._range_min(common, np.minimum(tails, len(common) - 1), np.full(len(tails), len(common))), CAP)
            places = sources[at] - 1
            for c, a, b in zip(seen.tolist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                part = values[a:b]
                if self.empty[c]:
                    part[0] = 0
                    self.empty[c] = False
                into.push(c, places[a:b], part)
        elif len(common):
            self.low = np.minimum(self.low, common.min())

    @staticmethod
    def _range_min(x: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Least of x[start:stop], none empty, by doubling tables, one at a time."""
        length = stop - start
        level = np.frexp(length)[1] - 1
        out, table, k = np.empty(len(start), np.int32), x, 0
        while True:
            mine = np.flatnonzero(level == k)
            if len(mine):
                out[mine] = np.minimum(table[start[mine]], table[stop[mine] - (1 << k)])
            k += 1
            if k > level.max(initial=0):
                return out
            table = np.minimum(table[: len(table) - (1 << (k - 1))], table[1 << (k - 1) :])


def induce(text, is_s: np.ndarray, runs: np.ndarray, seeds: np.ndarray, seed_common: np.ndarray, budget: int, folder: str | None):
    """Yield (places, common prefixes) of all suffixes, bucket by bucket from the last to the first, each ascending.

    seeds: places of the leftmost S-type suffixes in order; seed_common: each one's common prefix with the one before.
    """
    left, done_left = Buckets(budget, folder), Buckets(budget, folder)
    carrier = _Carrier()
    bounds = np.searchsorted(text[seeds], np.arange(SIZE + 1))
    nothing = np.zeros(0, np.int64)
    for c in range(SIZE):
        last = None
        while True:
            places, common = left.pop(c)
            if not len(places):
                break
            last = places[-1]
            done_left.push(c, places, common)
            before = np.flatnonzero(places > 0)
            before = before[~is_s[places[before] - 1]]
            carrier.push(left, text, places, common, before)
        own = seeds[bounds[c] : bounds[c + 1]]
        if len(own):
            common = seed_common[bounds[c] : bounds[c + 1]].copy()
            common[0] = 0 if last is None else min(runs[last], runs[own[0]])
            carrier.push(left, text, own, common, np.flatnonzero(own > 0))  # what stands before a leftmost S-type is L-type
    right, carrier = Buckets(budget, folder), _Carrier()
    for c in range(SIZE - 1, -1, -1):
        s_places, s_common = [], []
        while True:
            places, common = right.pop(c)
            if not len(places):
                break
            s_places.append(places)
            s_common.append(common)
            before = np.flatnonzero(places > 0)
            before = before[is_s[places[before] - 1]]
            carrier.push(right, text, places, common, before)
        s_places = np.concatenate(s_places) if s_places else nothing
        s_common = np.concatenate(s_common) if s_common else np.zeros(0, np.int32)
        l_places, l_common = done_left.pop(c)
        if c == 0:  # only the closing symbol, which nothing induces
            s_places, s_common = np.array([len(text) - 1]), np.zeros(1, np.int32)
        seam = int(min(runs[l_places[-1]], runs[s_places[-1]])) if len(l_places) and len(s_places) else 0
        if len(l_places):
            down = np.concatenate([[seam], l_common[1:][::-1]]).astype(np.int32)
            places = l_places[::-1]
            before = np.flatnonzero(places > 0)
            before = before[is_s[places[before] - 1]]
            carrier.push(right, text, places, down, before)
        if len(s_places):
            up = np.concatenate([[seam], s_common[1:][::-1]]).astype(np.int32)
            yield np.concatenate([l_places, s_places[::-1]]), np.concatenate([l_common, up])
        elif len(l_places):
            yield l_places, l_common


def _shape(text) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """S-types, lengths of runs of one symbol from each place, places of the leftmost S-types."""
    n = len(text)
    differs = np.append(text[1:] != text[:-1], True)
    stop = np.where(differs, np.arange(n), n)
    stop = np.minimum.accumulate(stop[::-1])[::-1]  # the last place of the run
    runs = (stop - np.arange(n) + 1).astype(np.int32)
    up = np.append(text[:-1] < text[1:], True)
    is_s = up[stop]
    leftmost = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    return is_s, runs, leftmost


def _rank_seeds(text, leftmost: np.ndarray, in_order: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The leftmost S-type suffixes in order of at least their first `depth` symbols, with common prefixes.

    in_order: the same places ordered by the substrings up to the next such place. Their names make the reduced
    string, which is ordered by doubling; the ranks of every round then give the common prefixes.
    """
    m, n = len(leftmost), len(text)
    following = np.append(leftmost[1:], n - 1)
    index = np.searchsorted(leftmost, in_order)
    a, b = in_order[:-1], in_order[1:]
    la, lb = following[index[:-1]] - a, following[index[1:]] - b
    lcp = common_prefix(text, a, b, np.minimum(la, lb) + 1)
    same = (la == lb) & (lcp > la)
    names = np.empty(m, np.int64)
    names[index] = np.cumsum(np.concatenate([[0], (~same).astype(np.int64)]))
    # ranks are the slots at which groups of equals start, so what stands alone keeps its rank; only the rest is sorted again
    order = index.copy()  # in_order, as numbers of seeds
    named = names[order]
    rank = np.empty(m, np.int64)
    rank[order] = np.maximum.accumulate(np.where(np.concatenate([[True], named[1:] != named[:-1]]), np.arange(m), 0)) if m else 0
    ranks, step = [rank], 1
    slots = np.arange(m)
    while step * 2 <= depth + 2:  # each name stands for two symbols at least
        sizes = np.bincount(rank, minlength=m)
        slots = slots[sizes[rank[order[slots]]] > 1]
        if not len(slots):
            break
        who = order[slots]
        after = np.where(who + step < m, rank[np.minimum(who + step, m - 1)] + 1, 0)
        key = rank[who] * (m + 1) + after
        sort = np.argsort(key, kind="stable")
        who, key = who[sort], key[sort]
        order[slots] = who
        fresh = rank.copy()
        fresh[who] = np.maximum.accumulate(np.where(np.concatenate([[True], key[1:] != key[:-1]]), slots, 0))
        rank = fresh
        ranks.append(rank)
        step *= 2
    x, y = order[:-1].copy(), order[1:].copy()
    moved = np.zeros(max(m - 1, 0), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        ok = (x + moved < m) & (y + moved < m)
        at = np.minimum(x + moved, m - 1), np.minimum(y + moved, m - 1)
        moved += np.where(ok & (ranks[k][at[0]] == ranks[k][at[1]]), 1 << k, 0)
    ends = np.append(leftmost, n - 1)
    fx, fy = ends[np.minimum(x + moved, m)], ends[np.minimum(y + moved, m)]
    shared = fx - ends[x]
    limit = np.maximum(0, np.minimum(depth + 2 - shared, CAP))
    common = shared + common_prefix(text, fx, fy, limit)
    return leftmost[order], np.concatenate([[0], np.minimum(common, CAP)]).astype(np.int32) if m else np.zeros(0, np.int32)


def common_prefix(text, a: np.ndarray, b: np.ndarray, limit: np.ndarray, width: int = 8) -> np.ndarray:
    """Of the suffixes at a and b, up to limit symbols."""
    n = len(text)
    out, live = np.zeros(len(a), np.int64), np.flatnonzero(limit > 0)
    span = np.arange(width)
    while len(live):
        x, y = (a[live] + out[live])[:, None] + span, (b[live] + out[live])[:, None] + span
        same = (text[np.minimum(x, n - 1)] == text[np.minimum(y, n - 1)]) & (x < n) & (y < n)
        got = np.where(same.all(1), width, np.argmin(same, 1))
        out[live] += got
        live = live[(got == width) & (out[live] < limit[live])]
    return np.minimum(out, limit)


def suffix_buckets(strings: list[bytes], depth: int, budget: int = 256 << 20, folder: str | None = None):
    """(text, strings' starts, iterator of (places, common prefixes) by bucket) for the strings as one text.

    The order is right for the first `depth` symbols, common prefixes up to depth; they may run on over a string's end.
    """
    n = sum(map(len, strings)) + len(strings) + 1
    if folder and 2 * n > budget:
        text = np.memmap(os.path.join(folder, "text"), np.uint16, "w+", shape=(n,))
    else:
        text = np.empty(n, np.uint16)
    starts, at = np.empty(len(strings), np.int64), 0
    for i, s in enumerate(strings):
        starts[i] = at
        text[at : at + len(s)] = np.frombuffer(s, np.uint8)
        text[at : at + len(s)] += 2
        at += len(s)
        text[at] = 1
        at += 1
    text[at] = 0
    is_s, runs, leftmost = _shape(text)
    # a first induction from unsorted seeds orders the substrings between the seeds; the second is for good
    by_symbol = leftmost[np.argsort(text[leftmost], kind="stable")]
    is_left = np.zeros(n, bool)
    is_left[leftmost] = True
    found = [p[is_left[p]] for p, _ in induce(text, is_s, runs, by_symbol, np.zeros(len(by_symbol), np.int32), budget, folder)]
    in_order = np.concatenate(found[::-1]) if found else leftmost
    seeds, common = _rank_seeds(text, leftmost, in_order, depth)
    return text, starts, induce(text, is_s, runs, seeds, common, budget, folder)


def repeated_places(strings: list[bytes], length: int, budget: int = 256 << 20, docs: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(starts of the strings in one text, places in it) at which a substring of `length` bytes stands that also stands elsewhere.

    docs: the strings' documents; then elsewhere means in another document.
    """
    folder = tempfile.mkdtemp()  # scratch of this one call, as a sort's spill is
    try:
        _, starts, buckets = suffix_buckets(strings, length, budget, folder)
        room = np.array([len(s) for s in strings], dtype=np.int64)
        out = []
        for places, common in buckets:
            head = common < length  # the first of those that have `length` symbols in common
            head[0] = True
            heads = np.flatnonzero(head)
            sizes = np.diff(np.append(heads, len(places)))
            which = np.searchsorted(starts, places, "right") - 1
            keep = sizes > 1
            if docs is not None:
                d = docs[np.minimum(which, len(docs) - 1)]
                keep &= np.minimum.reduceat(d, heads) != np.maximum.reduceat(d, heads)
            keep = np.flatnonzero(np.repeat(keep, sizes))
            places, which = places[keep], which[keep]
            out.append(places[(places - starts[which]) + length <= room[which]])
        return starts, np.sort(np.concatenate(out)) if out else np.zeros(0, np.int64)
    finally:
        shutil.rmtree(folder, ignore_errors=True)
