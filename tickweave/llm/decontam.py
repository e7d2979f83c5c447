"""Benchmark decontamination: an FM-index over each shard, searched backward for the benchmark's windows."""

from __future__ import annotations

from array import array

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweave.llm.common import annotate, cells, free_name, words_of
from tickweave.plans.session import table

#: Words in a window.
WINDOW = 10
#: Bytes of benchmark text searched at a time (what a task holds of it is some 30 times that); more is searched in further blocks.
BLOCK_BYTES = 2 << 20


def suffix_order(symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order, by prefix doubling; at `ends` stand separators, each smaller than any symbol and unlike the others."""
    n, step = len(symbols), 1
    rank = symbols.astype(np.int64) + len(ends)
    rank[ends] = np.arange(len(ends))
    order = np.argsort(rank, kind="stable")
    while n:
        a = rank[order]
        new = np.concatenate([[True], a[1:] != a[:-1]])
        if new.all():
            break
        second = np.full(n, -1, np.int64)
        second[: n - step] = rank[step:]  # a run's rank differs from all others at its separator, so no suffix is tied at the end
        order = np.lexsort((second, rank))
        a, b = rank[order], second[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) - 1
        step *= 2
    return order


class WaveletMatrix:
    """Ranks over an integer sequence: a bit plane a level, with counts at each 64 bits."""

    def __init__(self, values: np.ndarray, levels: int):
        self.n, self.levels, self.planes = len(values), levels, []
        cur = values
        for level in range(levels - 1, -1, -1):
            bits = (cur >> level) & 1
            pad = np.zeros((self.n // 64 + 1) * 64, np.uint8)
            pad[: self.n] = bits
            words = np.packbits(pad, bitorder="little").view(np.uint64)
            counts = np.concatenate([[0], np.cumsum(np.bitwise_count(words).astype(np.int64))])
            zeros = self.n - int(counts[-1])
            self.planes.append((words, counts, zeros))
            cur = np.concatenate([cur[bits == 0], cur[bits == 1]])

    @staticmethod
    def _ones(plane, i):
        words, counts, _ = plane
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return counts[i >> 6] + np.bitwise_count(words[i >> 6] & mask)

    def rank(self, symbols: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol stands before place i."""
        lo, hi = np.zeros_like(i), i.copy()
        for k, plane in enumerate(self.planes):
            one = ((symbols >> (self.levels - 1 - k)) & 1).astype(bool)
            a, b = self._ones(plane, lo), self._ones(plane, hi)
            lo, hi = np.where(one, plane[2] + a, lo - a), np.where(one, plane[2] + b, hi - b)
        return hi - lo


class FMIndex:
    """Over a sequence of symbols >= 1 in runs, each run closed by a 0."""

    def __init__(self, symbols: np.ndarray, size: int, sample: int = 8):
        self.n = n = len(symbols)
        ends = np.flatnonzero(symbols == 0)
        order = suffix_order(symbols, ends)
        self.last = symbols[order - 1]  # of place 0 the last symbol, a separator
        counts = np.bincount(symbols, minlength=size + 1)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        self.tree = WaveletMatrix(self.last, max(1, int(size).bit_length()))
        # sampled suffix places: every `sample`-th, and run starts, behind which nothing can be walked
        held = (np.arange(n) % sample == 0) | (np.concatenate([[0], symbols[:-1]]) == 0)
        marks = held[order]
        self.marks, self.places = marks, order[marks]
        self.mark_rank = np.concatenate([[0], np.cumsum(marks)])

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of patterns (one a row, all of a length), last symbol first."""
        lo, hi = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        alive = np.arange(len(patterns))
        for k in range(patterns.shape[1] - 1, -1, -1):
            c = patterns[alive, k]
            lo[alive] = self.first[c] + self.tree.rank(c, lo[alive])
            hi[alive] = self.first[c] + self.tree.rank(c, hi[alive])
            alive = alive[lo[alive] < hi[alive]]
            if not len(alive):
                break
        hi = np.where(hi > lo, hi, lo)
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places of the suffixes in these rows: step back until a sampled one, then count forward."""
        out, steps = np.empty(len(rows), np.int64), np.zeros(len(rows), np.int64)
        todo, at = np.arange(len(rows)), rows.copy()
        while len(todo):
            hit = self.marks[at]
            out[todo[hit]] = self.places[self.mark_rank[at[hit]]] + steps[todo[hit]]
            todo, at = todo[~hit], at[~hit]
            c = self.last[at]
            at = self.first[c] + self.tree.rank(c, at)
            steps[todo] += 1
        return out


class Windows:
    """The distinct windows of a block of benchmark items, as word ids from 1, by length.

    Held as arrays: all items' words in a row, a place for each distinct window, and for each the numbers of its items.
    """

    def __init__(self, items: list[tuple[str, bytes | None]], window: int):
        self.ids: dict[bytes, int] = {}
        self.names = [item for item, _ in items]
        flat, starts, owners = array("i"), {}, {}
        for number, (_, text) in enumerate(items):
            w = [self.ids.setdefault(x, len(self.ids) + 1) for x in words_of(text)]
            k = min(window, len(w))
            if k:
                starts.setdefault(k, []).append(np.arange(len(flat), len(flat) + len(w) - k + 1))
                owners.setdefault(k, []).append(np.full(len(w) - k + 1, number, np.int32))
                flat.extend(w)
        self.flat = np.array(flat, np.int32)
        self.least = min(starts, default=0)
        self.groups = [(k, *self._distinct(k, np.concatenate(starts[k]), np.concatenate(owners[k]))) for k in sorted(starts)]

    def _distinct(self, k: int, starts: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place of each distinct window, where its items begin in the last array, numbers of items)."""
        rank = self.flat[starts].astype(np.int64)
        for j in range(1, k):  # windows get equal ranks if their first j + 1 words are equal
            rank = np.unique(rank * (len(self.ids) + 1) + self.flat[starts + j], return_inverse=True)[1]
        order = np.lexsort((owners, rank))
        rank, owners, starts = rank[order], owners[order], starts[order]
        fresh = np.concatenate([[True], rank[1:] != rank[:-1]])
        once = fresh | np.concatenate([[True], owners[1:] != owners[:-1]])
        cuts = np.append(np.cumsum(once)[fresh] - 1, once.sum())
        return starts[fresh], cuts, owners[once]

    def patterns(self, k: int, starts: np.ndarray) -> np.ndarray:
        return self.flat[starts[:, None] + np.arange(k)].astype(np.int64)


def _find(texts: list[list[bytes]], block: Windows) -> list[tuple[np.ndarray, set]]:
    """For each text: (start, stop) rows of the windows that occur, and their items."""
    empty = (np.zeros((0, 2), np.int64), set())
    if not block.least:
        return [empty] * len(texts)
    get, symbols, where, owner = block.ids.get, [], [], []
    for t, words in enumerate(texts):
        if len(words) < block.least:
            continue
        ids = np.array([get(w, 0) for w in words], dtype=np.int64)
        known = np.concatenate([[0], (ids > 0).astype(np.int8), [0]])
        starts, stops = np.flatnonzero(np.diff(known) == 1), np.flatnonzero(np.diff(known) == -1)
        for a, b in zip(starts, stops, strict=True):
            if b - a >= block.least:  # in a shorter run of the benchmark's words no window fits
                symbols += [ids[a:b], np.zeros(1, np.int64)]
                where.append(np.arange(a, b + 1))
                owner.append(np.full(b - a + 1, t))
    if not symbols:
        return [empty] * len(texts)
    symbols, where, owner = np.concatenate(symbols), np.concatenate(where), np.concatenate(owner)
    index = FMIndex(symbols, len(block.ids))
    spans: dict[int, list] = {}
    items: dict[int, set] = {}
    for k, starts, bounds, owners in block.groups:
        lo, hi = index.search(block.patterns(k, starts))
        n = hi - lo
        which = np.repeat(np.arange(len(starts)), n)
        rows = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        places = index.locate(rows)
        order = np.argsort(owner[places], kind="stable")
        docs, cuts = np.unique(owner[places][order], return_index=True)
        for t, some in zip(docs.tolist(), np.split(order, cuts[1:]), strict=True) if len(docs) else ():
            a = where[places[some]]
            spans.setdefault(t, []).append(np.stack([a, a + k], axis=1))
            for w in set(which[some].tolist()):
                items.setdefault(t, set()).update(block.names[i] for i in owners[bounds[w] : bounds[w + 1]].tolist())
    return [(np.concatenate(spans[t]), items[t]) if t in spans else empty for t in range(len(texts))]


def merged(spans: np.ndarray) -> list[tuple[int, int]]:
    """Removal spans: overlapping or touching ones become one."""
    out: list[list[int]] = []
    for a, b in sorted(map(tuple, spans.tolist())):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())]))
KIND = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("items", T.ArrayType(T.StringType())), T.StructField("spans", SPANS)])


def find_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", into: str = "hits", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs with a struct: n_words, items (ids as strings, sorted), spans (merged removal spans, in words).

    benchmark: item_id, text. Each task indexes its texts by shards of 16 MB and searches all windows of a block
    of at most block_bytes of benchmark text, which is broadcast; a longer benchmark is more blocks, each a
    further pass in the same tasks. The driver and the tasks hold one block at a time; the broadcasts themselves are
    as large as the benchmark's words, which does not grow with the documents, and go to disk. No document moves.

    Null and wordless texts and items have no words and no windows; a null item_id reads as ''; repeated items
    count once by id, repeated documents each get the result; empty tables give no hits.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.encode("text", "utf-8").alias("text"))
    name, blocks, held, size = free_name(docs, into), [], [], 0
    for item, body in ((r[0], None if r[1] is None else bytes(r[1])) for r in items.toLocalIterator()):
        held.append((item, body))
        size += len(body or b"")
        if size >= block_bytes:
            blocks.append(spark.sparkContext.broadcast(Windows(held, window)))
            held, size = [], 0
    if held or not blocks:
        blocks.append(spark.sparkContext.broadcast(Windows(held, window)))

    def make():
        def run(texts):
            words = [words_of(t) for t in texts]
            found = [([], set()) for _ in words]
            for block in blocks:
                for (spans, names), (more, new) in zip(found, _find(words, block.value), strict=True):
                    spans.append(more)
                    names |= new
                if len(blocks) > 1:
                    block.__dict__.pop("_value", None)  # hold one block at a time
            return (
                [len(w) for w in words], [sorted(names) for _, names in found],
                [[{"start": a, "stop": b} for a, b in merged(np.concatenate(spans))] for spans, _ in found],
            )

        return run

    return annotate(docs, name, KIND, make, text)


def op1_decontamination(spark, sf_dir: str) -> DataFrame:
    out = find_contamination(cells(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("hits.spans", F.lit(0).cast("long"), lambda s, x: s + x["stop"] - x["start"])
    return out.select(
        "doc_id", F.col("hits.n_words").alias("n_words"), hit.alias("n_hit"), F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "hits.items"), 256).alias("items_sha256"), (F.size("hits.spans") > 0).alias("contaminated"),
    )


OP1_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
k AS (SELECT item_id, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM (SELECT *, unnest(generate_series(1, len(w) - n + 1)) AS i FROM k)),
sizes AS (SELECT DISTINCT n FROM k),
pos AS (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n),
hit AS (SELECT doc_id, i, pos.n, item_id FROM pos JOIN win ON pos.n = win.n AND array_to_string(w[i:i + pos.n - 1], ' ') = s),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hit) GROUP BY 1),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS x FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hit) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(x, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""
