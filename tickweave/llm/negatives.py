"""Hard-negative mining: a pivot table brackets inner products by the triangle inequality, and what it can't exclude is checked exactly."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickweave.plans.session import saved, ship, shuffle_parts, table

#: Rows the pivots are chosen from, and pivots.
SAMPLE, PIVOTS = 1024, 16
#: Rows of a part and anchors of a block at most: a tile of both is one task's.
PART, BLOCK = 1 << 15, 1 << 14
#: Rows whose pivot distances have common bounds; anchors and rows that are looked at together.
CELL, ANCHORS, CHUNK = 64, 64, 1024
#: Scores are below this, and it is no score.
NONE = 1 << 62


def prepare(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, label, q, norm2 of the rows that take part, q being whole numbers as doubles.

    Left out are rows with a null in vec_id, label or vector, with a component that is null or not finite, or with a squared norm of 2^62 or more,
    whose score with itself is no long.
    """

    def run(batches):
        for b in batches:
            vec = b.column(2).cast(pa.list_(pa.float64()))
            size = vec.value_lengths().fill_null(0).to_numpy()
            flat = vec.flatten()
            row = np.repeat(np.arange(len(size)), size)
            x = flat.to_numpy(zero_copy_only=False) if flat.null_count == 0 else flat.fill_null(np.nan).to_numpy(zero_copy_only=False)
            with np.errstate(invalid="ignore", over="ignore"):
                q = np.floor(scale * x)
                norm = np.bincount(row, weights=q * q, minlength=len(size)).astype(float)
                good = (norm < float(NONE)) & ~vec.is_null().to_numpy(zero_copy_only=False)  # not a number: not below
            good &= ~b.column(0).is_null().to_numpy(zero_copy_only=False) & ~b.column(1).is_null().to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(np.where(good, size, 0))]).astype(np.int32)
            whole = pa.ListArray.from_arrays(pa.array(ends), pa.array(q[good[row]]))
            keep = pa.array(good)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep), whole.filter(keep), pa.array(norm[good])], names=["vec_id", "label", "q", "norm2"])

    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.mapInArrow(run, "vec_id long, label long, q array<double>, norm2 double")


def matrix(vectors: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Lists of numbers as rows of a matrix; shorter ones end in zeros."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    size = vectors.value_lengths().to_numpy()
    out = np.zeros((len(size), width))
    out[np.arange(width) < size[:, None]] = vectors.flatten().to_numpy()
    return out


def choose_pivots(x: np.ndarray, top: float, most: int = PIVOTS) -> np.ndarray:
    """Rows of x, each farthest from those before it in the augmented space."""
    full = np.column_stack([x, np.sqrt(np.maximum(top - (x * x).sum(1), 0))])
    picked, far = [], np.full(len(x), np.inf)
    for _ in range(min(most, len(x))):
        k = int(np.argmax(far))
        if picked and far[k] <= 0:
            break
        picked.append(k)
        far = np.minimum(far, ((full - full[k]) ** 2).sum(1))
    return x[picked]


def distances(x: np.ndarray, pivots: np.ndarray, top: float, query: bool = False) -> np.ndarray:
    """Distances to the pivots once a coordinate is added that gives all vectors the squared norm `top`; queries get 0 there.

    Between a query and a row the squared distance is then top + |query|^2 - 2 * score.
    """
    nx, np_ = (x * x).sum(1), (pivots * pivots).sum(1)
    ax = np.zeros(len(x)) if query else np.sqrt(np.maximum(top - nx, 0))
    d2 = nx[:, None] + np_ - 2 * (x @ pivots.T) + (ax[:, None] - np.sqrt(np.maximum(top - np_, 0))) ** 2
    return np.sqrt(np.maximum(d2, 0))


class Rows:
    """A part's rows, laid out so that neighbours stand together, with the bounds of each cell's pivot distances."""

    def __init__(self, x, d, ids, labels, top: float):
        order = np.lexsort((d.min(1), d.argmin(1)))
        self.x, self.d, self.ids, self.labels, self.top = x[order], d[order], ids[order], labels[order], top
        starts = np.arange(0, len(x), CELL)
        self.low, self.high = (f.reduceat(self.d, starts, axis=0) for f in (np.minimum, np.maximum))

    def scores(self, a: np.ndarray, some: np.ndarray) -> np.ndarray:
        """Exact inner products: doubles hold them as long as no product of norms reaches 2^53."""
        x = self.x[some]
        if np.sqrt((a * a).sum(1).max()) * np.sqrt(self.top) < 2.0**52:
            return np.rint(a @ x.T).astype(np.int64)
        return a.astype(np.int64) @ x.astype(np.int64).T


def _brackets(da: np.ndarray, low: np.ndarray, high: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the scores of anchors with rows (or cells) whose pivot distances lie from low to high."""
    near, far = np.zeros((len(da), len(low))), np.full((len(da), len(low)), np.inf)
    for p in range(da.shape[1]):
        d = da[:, p : p + 1]
        np.maximum(near, np.maximum(low[:, p] - d, d - high[:, p]), out=near)
        np.minimum(far, high[:, p] + d, out=far)
    slack = 1e-9 * sums[:, None] + 1  # of doubles
    return (sums[:, None] - far * far) / 2 - slack, (sums[:, None] - near * near) / 2 + slack


def _merge(best, ids, scores, more):
    """The k highest of what is held and what comes, ties by smaller id."""
    k = best.shape[1]
    some = (scores > -NONE).any(0)
    if not some.any():
        return best, ids
    s = np.concatenate([best, scores[:, some]], axis=1)
    i = np.concatenate([ids, np.broadcast_to(more[some], (len(best), int(some.sum())))], axis=1)
    order = np.lexsort((i, -s), axis=1)[:, :k]
    return np.take_along_axis(s, order, 1), np.take_along_axis(i, order, 1)


def search(rows: Rows, a: np.ndarray, da: np.ndarray, allowed, low: np.ndarray, high: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores and ids of the k best rows for each anchor and each of its windows of scores, from low to high (anchors x windows).

    allowed(anchors, rows): which pairs count. Cells, then rows, leave as soon as their bracket is below what the windows need or above them.
    """
    n, windows = low.shape
    best, ids = np.full((n, windows, k), -NONE), np.full((n, windows, k), NONE)
    norms = (a * a).sum(1)
    for a0 in range(0, n, ANCHORS):
        at = slice(a0, a0 + ANCHORS)
        sums, open_ = rows.top + norms[at], low[at] <= high[at]
        if not open_.any():
            continue
        most = np.where(open_, high[at], -NONE).max(1).astype(np.float64)
        for r0 in range(0, len(rows.x), CHUNK):
            least = np.where(open_, np.maximum(low[at], best[at, :, -1]), NONE).min(1).astype(np.float64)
            live = lambda lo, hi: (hi >= least[:, None]) & (lo <= most[:, None])  # noqa: B023, E731
            c = slice(r0 // CELL, (r0 + CHUNK) // CELL)
            cells = live(*_brackets(da[at], rows.low[c], rows.high[c], sums))
            some = np.flatnonzero(np.repeat(cells.any(0), CELL)[: len(rows.x) - r0]) + r0
            if not len(some):
                continue
            pairs = live(*_brackets(da[at], rows.d[some], rows.d[some], sums))
            pairs &= cells[:, (some - r0) // CELL]
            pairs &= allowed(at, some)
            left = pairs.any(0)
            if not left.any():
                continue
            some, pairs = some[left], pairs[:, left]
            s = rows.scores(a[at], some)
            for w in range(windows):
                wanted = pairs & (s >= np.maximum(low[at, w], best[at, w, -1])[:, None]) & (s <= high[at, w][:, None])
                best[at, w], ids[at, w] = _merge(best[at, w], ids[at, w], np.where(wanted, s, -NONE), rows.ids[some])
    return best, ids


def mine(vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, least: tuple[int, int] = (4, 5), part: int = PART, block: int = BLOCK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    vectors: vec_id, label, embedding. anchors: of a column vec_id, which rows are anchors. An anchor's positives are its best rows of the same label
    and another vec_id; for each of them its negatives are the best rows of another label whose score is at most the positive's, and at least
    least[0] / least[1] of it. Higher scores come first, ties by smaller vec_id.

    The pivot table is written once: each row's distances to a few pivots, chosen from a sample of SAMPLE rows. Rows are dealt into parts by chance,
    anchors into blocks, and each pair of a part and a block is one task's tile: rows are copied once a block of 16,384 anchors, anchors once a part. A tile
    gives the best few of its rows for each anchor, so only those are shuffled again. Positives are looked for in parts of the anchor's label alone.

    Rows that `prepare` leaves out take no part. Vectors of unlike lengths are filled up with zeros. A repeated anchor has its rows
    as often; other repeated rows are rows each. An empty table gives an empty result, and so does one without anchors. Other columns are not read.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = saved(prepare(vectors), "vectors")
    some = rows.agg(F.count("*"), F.max("norm2"), F.max(F.size("q")), F.count(F.when(anchors, 1))).first()
    n, top, width, n_anchors = some[0], some[1] or 0.0, some[2] or 0, some[3]
    sample = rows.select("vec_id", "q").orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("q").toArrow()
    pivots = choose_pivots(matrix(sample["q"], width), top)
    parts = max(1, min(n // 256, max(shuffle_parts(spark), -(-n // part))))
    blocks = max(1, -(-n_anchors // block))

    def place(batches):
        for b in batches:
            d = distances(matrix(b.column(2), width), pivots, top)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(d) + 1, dtype=np.int32) * d.shape[1]), pa.array(d.ravel()))
            yield pa.RecordBatch.from_arrays([*b.columns, flat], names=[*b.schema.names, "d"])

    kind = "vec_id long, label long, q array<double>, norm2 double, d array<double>"
    numbered = rows.mapInArrow(place, kind).withColumn("number", F.monotonically_increasing_id())
    pivot_table = saved(numbered.withColumn("part", F.pmod(F.xxhash64("number"), F.lit(parts)).cast("int")), "pivots")
    asked = pivot_table.filter(anchors).withColumn("block", F.pmod(F.xxhash64("number", F.lit(1)), F.lit(blocks)).cast("int")).drop("part", "d", "norm2")
    table_ = pivot_table.select(F.col("vec_id").alias("row_id"), F.col("label").alias("row_label"), F.col("q").alias("row_q"), F.col("d").alias("row_d"), F.col("part").alias("row_part")).withColumn("row_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    each_part = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))

    def tile(left: pa.Table, right: pa.Table, windows: int, allowed, bounds):
        """(anchors' numbers, best, ids) of a tile, or None."""
        if not left.num_rows or not right.num_rows:
            return None
        a = matrix(left["q"], width)
        held = Rows(matrix(right["row_q"], width), matrix(right["row_d"], len(pivots)), right["row_id"].to_numpy(), right["row_label"].to_numpy(), top)
        low, high = bounds
        return search(held, a, distances(a, pivots, top, query=True), lambda at, some: allowed(held, at, some), low, high, positives if windows == 1 else negatives)

    def near(left: pa.Table, right: pa.Table) -> pa.Table:
        own, count = left["vec_id"].to_numpy(), left.num_rows
        got = tile(left, right, 1, lambda held, at, some: own[at][:, None] != held.ids[some], (np.full((count, 1), 1 - NONE), np.full((count, 1), NONE)))
        i, _, k = np.nonzero(got[0] > -NONE) if got else ([], [], [])
        take = lambda x: x[i, 0, k] if got else np.array([], np.int64)
        return pa.table({"number": left["number"].to_numpy()[i], "positive_id": take(got and got[1]), "positive_score": take(got and got[0])})

    found = asked.withColumn("part", each_part).groupBy("label", "part", "block").cogroup(table_.groupBy("row_label", "row_part", "row_block")).applyInArrow(near, "number long, positive_id long, positive_score long")
    place_ = F.row_number().over(Window.partitionBy("number").orderBy(F.desc("positive_score"), "positive_id"))
    found = found.withColumn("k", place_).filter(F.col("k") <= positives).groupBy("number").agg(F.array_sort(F.collect_list(F.struct("k", "positive_score", "positive_id"))).alias("p"))
    asked = asked.join(found, "number").select("*", F.col("p.positive_score").alias("scores"), F.col("p.positive_id").alias("ids")).drop("p")
    up, down = least

    def hard(left: pa.Table, right: pa.Table) -> pa.Table:
        label, ids = left["label"].to_numpy(), left["ids"].to_pylist()
        high = np.full((left.num_rows, positives), -NONE)
        for i, s in enumerate(left["scores"].to_pylist()):
            high[i, : len(s)] = s
        low = np.where(high > -NONE, high - high // down * (down - up) - high % down * (down - up) // down, NONE)  # the least score of at least up/down of high
        got = tile(left, right, positives, lambda held, at, some: label[at][:, None] != held.labels[some], (low, high))
        i, w, k = np.nonzero(got[0] > -NONE) if got else ([], [], [])
        take = lambda x: x[i, w, k] if got else np.array([], np.int64)
        return pa.table({
            "number": left["number"].to_numpy()[i], "anchor_id": left["vec_id"].to_numpy()[i], "positive_id": pa.array([ids[x][y] for x, y in zip(i, w, strict=True)], pa.int64()), "k": pa.array(np.asarray(w, np.int32)),
            "negative_id": take(got and got[1]), "positive_score": high[i, w], "negative_score": take(got and got[0]),
        })

    kind = "number long, anchor_id long, positive_id long, k int, negative_id long, positive_score long, negative_score long"
    out = asked.withColumn("part", each_part).groupBy("part", "block").cogroup(table_.groupBy("row_part", "row_block")).applyInArrow(hard, kind)
    rank = F.row_number().over(Window.partitionBy("number", "k").orderBy(F.desc("negative_score"), "negative_id"))
    return out.withColumn("rank", rank).filter(F.col("rank") <= negatives).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12_hard_negatives(spark, sf_dir: str) -> DataFrame:
    """Labels of every seventh vec_id are moved by one, so that near rows of another label exist."""
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return mine(vectors.select("vec_id", moved.alias("label"), "embedding"), F.col("vec_id") % 100 == 0)


OP12_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id, b.label, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE label = anchor_label QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE label <> anchor_label AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 5
"""
