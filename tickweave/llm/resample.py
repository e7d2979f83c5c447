"""Importance resampling towards a target distribution: scored documents, sorted runs, merged by external tournament trees."""

from __future__ import annotations

import hashlib
import math
import tempfile
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.llm.common import cells, words_of
from tickweave.plans.session import saved, ship, shuffle_parts, table

BUCKETS = 10_000
#: Rows of a sorted run, rows of a block of it, runs that one tree merges, rows of a range of the merge (at most, but for equal keys).
RUN, BLOCK, FAN, RANGE = 1 << 16, 4096, 256, 1 << 18
#: Columns of a row in a run: negated score, whether doc_id is null, doc_id, n_features, weight. The first three are its key.
WIDTH = 5


class _Memo(dict):
    """What a word is worth, computed once while there is room."""

    def __init__(self, of, most: int = 1 << 20):
        self.of, self.most = of, most

    def __missing__(self, feature: bytes):
        if len(self) >= self.most:
            self.clear()
        got = self[feature] = self.of(feature)
        return got


def features_of(text: bytes | None, longest: int) -> tuple[int, list[bytes]]:
    """(number of words, all runs of 1 to `longest` consecutive words)."""
    words = words_of(text)
    out = list(words)
    for n in range(2, longest + 1):
        out += map(b" ".join, zip(*(words[i:] for i in range(n)), strict=False))
    return len(words), out


def bucket_counts(texts: DataFrame, longest: int, buckets: int) -> np.ndarray:
    """Features in each bucket over all texts: an array of `buckets` counts from each task, added up."""

    def run(batches):
        bucket, held = _Memo(lambda f: zlib.crc32(f) % buckets), np.zeros(buckets, np.int64)
        for b in batches:
            for t in b.column(0).cast(pa.binary()).to_pylist():
                held += np.bincount(np.fromiter(map(bucket.__getitem__, features_of(t, longest)[1]), np.int64), minlength=buckets)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(held[some])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains_of(source: np.ndarray, target: np.ndarray) -> list[int]:
    """What a feature of each bucket adds: a thousand times the logarithm of its smoothed likelihood ratio, floored."""
    s, t, n = int(source.sum()), int(target.sum()), len(source)
    return [math.floor(1000 * math.log((b + 1) * (s + n) / ((a + 1) * (t + n)))) for a, b in zip(source.tolist(), target.tolist(), strict=True)]


def noise(seed: int, doc_id) -> int:
    """The document's own Gumbel number in thousandths; a null id counts as an empty text."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gains: list[int], longest: int, seed: int, least: int) -> DataFrame:
    """doc_id, n_features, weight, score, eligible of every document."""
    n_buckets = len(gains)

    def run(batches):
        gain = _Memo(lambda f: gains[zlib.crc32(f) % n_buckets])
        for b in batches:
            ids, rows = b.column(0).to_pylist(), []
            for i, t in zip(ids, b.column(1).cast(pa.binary()).to_pylist(), strict=True):
                words, features = features_of(t, longest)
                weight = sum(map(gain.__getitem__, features)) // len(features) if features else 0
                rows.append((len(features), weight, weight + noise(seed, i), words >= least))
            cols = zip(*rows, strict=True) if rows else ([], [], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *(pa.array(c, k) for c, k in zip(cols, [pa.int64()] * 3 + [pa.bool_()], strict=True))], names=["doc_id", "n_features", "weight", "score", "eligible"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_features long, weight long, score long, eligible boolean")


def _cut_score(levels: list[tuple[int, int]], draw: int) -> int:
    """The score of the last document that is drawn. levels: (score, documents), best first."""
    seen = 0
    for score, n in levels:
        seen += n
        if seen >= draw:
            return score
    raise ValueError("fewer documents than are drawn")


def ranges_of(rows: DataFrame, levels: list[tuple[int, int]], most: int) -> list[tuple[tuple[int, int, int], int]]:
    """(first possible key, rows before it) of consecutive ranges of about `most` rows, in the order of the draw.

    Scores with more rows than a range are cut by ids, too: equally wide intervals of them are counted.
    """
    pieces, hot = [], [s for s, n in levels if n > most]
    split: dict[int, list] = {}
    if hot:
        bounds = rows.filter(F.col("score").isin(hot)).agg(F.min("doc_id"), F.max("doc_id")).first()
        low, high = bounds[0] or 0, bounds[1] or 0
        step = max(1, -(-(high - low + 1) // 4096))
        part = F.floor((F.col("doc_id") - low) / step)
        for r in rows.filter(F.col("score").isin(hot)).groupBy("score", part.alias("part")).count().collect():
            split.setdefault(r.score, []).append(((-r.score, 1, 0) if r.part is None else (-r.score, 0, low + r.part * step), r["count"]))
    for s, n in levels:
        pieces += sorted(split[s]) if s in split else [((-s, 0, -(1 << 63)), n)]
    out, before, held = [], 0, most
    for key, n in pieces:
        if held + n > most:
            out.append((key, before))
            held = 0
        held += n
        before += n
    return out


def _keys(a: np.ndarray) -> np.ndarray:
    return np.lexsort((a[:, 2], a[:, 1], a[:, 0]))


def _place(run: np.ndarray, key: tuple[int, int, int]) -> int:
    """The first place in a sorted run that isn't before a key."""
    a, b = 0, len(run)
    for c, k in enumerate(key):
        col = run[a:b, c]
        a, b = a + int(np.searchsorted(col, k, "left")), a + int(np.searchsorted(col, k, "right"))
    return a


def sorted_runs(rows: DataFrame, starts: list[tuple[int, int, int]]) -> DataFrame:
    """range, run, at, data: each partition's rows in sorted runs of RUN rows, cut at the ranges' starts and into blocks."""

    def run(batches):
        task, number = TaskContext.get().partitionId(), 0

        def cut(held):
            a = np.concatenate(held)
            a = a[_keys(a)]
            ends = [*(_place(a, k) for k in starts[1:]), len(a)]
            out, begin = [], 0
            for r, end in enumerate(ends):
                out += [(r, task << 32 | number, at, a[at : min(at + BLOCK, end)].tobytes()) for at in range(begin, end, BLOCK)]
                begin = end
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.int32(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["range", "run", "at", "data"])

        held, n = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            null = b.column(0).is_null().to_numpy(zero_copy_only=False)
            held.append(np.stack([-b.column(3).to_numpy(), null.astype(np.int64), b.column(0).fill_null(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_numpy()], axis=1))
            n += b.num_rows
            if n >= RUN:
                yield cut(held)
                held, n, number = [], 0, number + 1
        if n:
            yield cut(held)

    return rows.select("doc_id", "n_features", "weight", "score").mapInArrow(run, "range int, run long, at long, data binary")


class Spool:
    """Blocks of runs in a scratch file of one task."""

    def __init__(self):
        self.file, self.size = tempfile.TemporaryFile(), 0

    def add(self, data: bytes) -> tuple[int, int]:
        self.file.seek(self.size)
        self.file.write(data)
        self.size += len(data)
        return self.size - len(data), len(data)

    def rows(self, blocks: list[tuple[int, int]]) -> Iterator[tuple]:
        """Rows of a run, of which one block at a time is in memory."""
        for at, n in blocks:
            self.file.seek(at)
            yield from map(tuple, np.frombuffer(self.file.read(n), np.int64).reshape(-1, WIDTH).tolist())


def tournament(runs: list[Iterator[tuple]]) -> Iterator[tuple]:
    """Sorted runs as one: a tree of winners, in which only the path of the last winner is played again."""
    k = len(runs)
    heads = [next(r, None) for r in runs]
    beats = lambda a, b: heads[b] is None or (heads[a] is not None and heads[a] <= heads[b])
    tree = [0] * k + list(range(k))
    for node in range(k - 1, 0, -1):
        a, b = tree[2 * node], tree[2 * node + 1]
        tree[node] = a if beats(a, b) else b
    while k:
        winner = tree[1] if k > 1 else 0
        if heads[winner] is None:
            return
        yield heads[winner]
        heads[winner] = next(runs[winner], None)
        node = (k + winner) // 2
        while node:
            a, b = tree[2 * node], tree[2 * node + 1]
            tree[node] = a if beats(a, b) else b
            node //= 2


def merged(spool: Spool, runs: list[list[tuple[int, int]]], fan: int = FAN) -> Iterator[tuple]:
    """All rows in order; more runs than a tree has leaves become longer ones on disk first."""
    while len(runs) > fan:
        longer = []
        for a in range(0, len(runs), fan):
            rows = tournament([spool.rows(r) for r in runs[a : a + fan]])
            longer.append([spool.add(np.array(block, np.int64).tobytes()) for block in iter(lambda rows=rows: list(islice(rows, BLOCK)), [])])
        runs = longer
    return tournament([spool.rows(r) for r in runs])


def ranked(runs: DataFrame, before: list[int], draw: int, parts: int) -> DataFrame:
    """Rows of the runs with their rank, null for those behind the draw: each range is merged by one task, which knows how many rows stand before it."""

    def write(rows, first):
        while block := list(islice(rows, 1 << 14)):
            a = np.array(block, np.int64).reshape(-1, WIDTH)
            rank = pa.nulls(len(a), pa.int64()) if first is None else pa.array(np.arange(first, first + len(a)))
            first = None if first is None else first + len(a)
            yield pa.RecordBatch.from_arrays([pa.array(a[:, 2], mask=a[:, 1] == 1), pa.array(a[:, 3]), pa.array(a[:, 4]), pa.array(-a[:, 0]), rank], names=["doc_id", "n_features", "weight", "score", "rank"])

    def one(number, spool, blocks):
        order = merged(spool, list(blocks.values()))
        left = draw - before[number]
        yield from write(islice(order, max(0, left)), before[number] + 1)
        yield from write(order, None)  # only the last range has any: ties with the last one drawn

    def run(batches):
        number, spool, blocks = None, None, {}
        for b in batches:
            for r, k, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3), strict=True):
                if r != number:
                    if blocks:
                        yield from one(number, spool, blocks)
                    number, spool, blocks = r, Spool(), {}
                blocks.setdefault(k, []).append(spool.add(data.as_buffer()))
        if blocks:
            yield from one(number, spool, blocks)

    dealt = runs.repartition(parts, "range").sortWithinPartitions("range", "run", "at")
    return dealt.mapInArrow(run, "doc_id long, n_features long, weight long, score long, rank long")


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, longest: int = 1, buckets: int = BUCKETS, seed: int = 2024, least: int = 20, most: int | None = None) -> DataFrame:
    """doc_id, n_features, weight, score, rank: a draw without replacement of documents that are like the target texts.

    docs: doc_id, text; target: text. A feature is a run of 1 to `longest` words, hashed into a bucket; a document's weight is the floored mean of its
    features' gains, its score that and a Gumbel number of its id, so the highest scores are a draw by the weights. Of the N documents of `least` words
    or more, percent * N // 100 are drawn; their rank is 1, 2, 3, ... by score, then doc_id. All rows are returned.

    The gains (an array of fixed size) go to all tasks. The scores are written once; how many documents have each (whole numbers of a range of some 100,000)
    gives the score of the last one drawn and ranges of about equal size. Each partition's rows from that score on are sorted into runs, and each range of
    them is merged by one task with bounded memory: its runs lie in a scratch file, and a tree holds a block of each of FAN runs.

    Null and empty texts have no features, weight 0, and aren't drawn (unless least is 0); a null doc_id stands behind the others at its score and has
    the Gumbel number of an empty id; repeated rows are drawn each on its own. Without documents the result is empty, without target texts the gains
    are those of empty counts. Other columns play no part. `most` is the size of a range; by default the draw is cut for all tasks.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = cells(docs)
    gains = gains_of(bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets))
    rows = saved(scored(docs, gains, longest, seed, least), "scored")
    levels = [(r.score, r["count"]) for r in rows.filter("eligible").groupBy("score").count().collect()]
    levels.sort(reverse=True)
    draw = percent * sum(n for _, n in levels) // 100
    if not draw:
        return rows.select("doc_id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    cut, parts = _cut_score(levels, draw), shuffle_parts(spark)
    near = rows.filter(F.col("eligible") & (F.col("score") >= cut))
    most = most or min(RANGE, max(BLOCK, draw // parts))
    ranges = ranges_of(near, [x for x in levels if x[0] >= cut], most)
    best = ranked(sorted_runs(near, [k for k, _ in ranges]), [n for _, n in ranges], draw, max(parts, len(ranges)))
    rest = rows.filter(~F.col("eligible") | (F.col("score") < cut)).select("doc_id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    return best.unionByName(rest)


def op11_importance_resampling(spark, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_WORDS = r"unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'))"

OP11_SQL = rf"""
WITH crc_table AS (SELECT list(c ORDER BY i) AS c FROM (SELECT i, list_reduce([0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i) AS c FROM range(256) r(i))),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT {_WORDS} AS w FROM benchmark),
k AS (SELECT w, xor(list_reduce(list_transform(range(1, length(h), 2), lambda i: CAST('0x' || substr(h, i, 2) AS BIGINT)), lambda a, x: xor(a >> 8, c[(xor(a, x) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket
  FROM (SELECT w, hex(encode(w)) AS h FROM (SELECT DISTINCT w FROM (SELECT w FROM d UNION ALL SELECT w FROM b))), crc_table),
n AS (SELECT bucket, count(*) FILTER (src = 'd') AS s, count(*) FILTER (src = 'b') AS t FROM (SELECT w, 'd' AS src FROM d UNION ALL SELECT w, 'b' FROM b) JOIN k USING (w) GROUP BY 1),
g AS (SELECT bucket, CAST(floor(1000 * ln((t + 1) * ((SELECT count(*) FROM d) + 10000) / CAST((s + 1) * ((SELECT count(*) FROM b) + 10000) AS DOUBLE))) AS BIGINT) AS gain FROM n),
w AS (SELECT doc_id, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS total FROM d JOIN k USING (w) JOIN g USING (bucket) GROUP BY 1),
r AS (SELECT documents.doc_id, coalesce(n_features, 0) AS n_features, coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0) AS weight,
  CAST('0x' || substr(sha256('2024:' || coalesce(documents.doc_id::VARCHAR, '')), 1, 8) AS BIGINT) AS h FROM documents LEFT JOIN w ON documents.doc_id = w.doc_id),
f AS (SELECT doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM r),
o AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place FROM f)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= (SELECT count(*) * 10 // 100 FROM f WHERE n_features >= 20) THEN place END AS rank FROM o
"""
