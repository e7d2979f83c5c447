"""Quality rules: gradient-boosted trees over document statistics, some of them monotone, flattened into node arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweave.llm.common import annotate, cells, free_name
from tickweave.llm.quality import fold
from tickweave.plans.session import ship, table

#: Labelled rows that the trees are fitted on, at most: 8,192 rows of 15 numbers are 1 MB.
MAX_LABELLED = 8192
#: Documents that score lower than this are rejected.
THRESHOLD = 0.3
WINDOW = 8
#: Base counts of a document, then the statistics that the trees see, with the way the score may go as they rise (0: any).
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
STATISTICS = {
    "log_words": 0, "word_length": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "distinct_share": 0, "capital_share": 0, "digit_share": 0,
    "mark_share": 0, "letter_share": 0, "other_share": 0, "top_word_share": 0, "words_a_line": 0, "byte_entropy": 0, "short_word_share": 0,
}
MONOTONE = np.array(list(STATISTICS.values()))
_SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_SPACE = np.isin(np.arange(256), np.frombuffer(b"\x20\x09\x0a\x0b\x0c\x0d", np.uint8))
_FOLLOWS = (np.arange(256) & 0xC0) == 0x80  # bytes of a character behind its first
_IN = lambda a, b: (np.arange(256) >= a) & (np.arange(256) <= b)
_CAPITAL, _DIGIT, _LETTER = _IN(65, 90), _IN(48, 57), _IN(65, 90) | _IN(97, 122)
_MARK = _IN(33, 126) & ~_DIGIT & ~_LETTER


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more, the first occurrence included; ids: a number for each distinct word.

    Windows get numbers by doubling: equal numbers are equal words, whatever the text. The window is a power of two.
    """
    n = len(ids) - window + 1
    if n < 2:
        return 0
    width = 1
    while width < window:
        pairs = ids[: len(ids) - width] * (int(ids.max()) + 1) + ids[width:]
        ids, width = np.unique(pairs, return_inverse=True)[1].astype(np.int64), 2 * width
    starts = np.flatnonzero(np.bincount(ids)[ids] > 1)
    edge = np.zeros(n + window, np.int64)
    edge[starts] += 1
    np.subtract.at(edge, starts + window, 1)
    return int((np.cumsum(edge) > 0).sum())


def counts_and_statistics(text: bytes | None) -> tuple[list[int], list[float]]:
    """COUNTS and STATISTICS of a whole text."""
    text = text or b""
    words, lines = text.split(), [x for x in text.split(b"\n") if x.strip()]
    by_byte = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    total, n = max(len(text), 1), max(len(words), 1)
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    size = int(by_byte[~_SPACE & ~_FOLLOWS].sum())
    counts = [len(words), size, int(by_byte[_SYMBOLS].sum()), len(lines) - len(set(lines)), repeated_words(ids)]
    share = by_byte[by_byte > 0] / total
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    return counts, [
        np.log1p(len(words)), size / n, counts[2] / n, counts[3] / max(len(lines), 1), counts[4] / n, len(numbers) / n, by_byte[_CAPITAL].sum() / total, by_byte[_DIGIT].sum() / total,
        by_byte[_MARK].sum() / total, by_byte[_LETTER].sum() / total, by_byte[128:].sum() / total, np.bincount(ids).max() / n if words else 0.0, len(words) / max(len(lines), 1),
        float(-(share * np.log2(share)).sum()), float((lengths <= 2).sum() / n),
    ]


@dataclass
class Trees:
    """All trees' nodes in common arrays: a row goes left if its feature is at most the node's bound; a leaf is its own child."""

    feature: np.ndarray
    bound: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    start: float

    def score(self, x: np.ndarray, block: int = 4096) -> np.ndarray:
        """Probabilities of rows of x."""
        out = np.empty(len(x))
        for a in range(0, len(x), block):
            part = x[a : a + block]
            at = np.tile(self.roots, (len(part), 1))
            rows = np.arange(len(part))[:, None]
            for _ in range(self.depth):
                at = np.where(part[rows, self.feature[at]] <= self.bound[at], self.left[at], self.right[at])
            out[a : a + block] = 1 / (1 + np.exp(-(self.start + self.value[at].sum(1))))
        return out


def fit(x: np.ndarray, y: np.ndarray, monotone: np.ndarray = MONOTONE, rounds: int = 80, depth: int = 4, rate: float = 0.15, least: float = 1.0, ridge: float = 1.0, bins: int = 64) -> Trees:
    """Boosted trees on the logistic loss, by histograms.

    On a monotone feature a split counts only if its children's values stand the right way round, and below it neither side may pass
    their middle, so the score is monotone in it, other features held.
    """
    prior = (y.sum() + 0.5) / (len(y) + 1)
    nodes: list[list] = []  # feature, bound, left, right, value
    roots, margin = [], np.full(len(y), np.log(prior / (1 - prior)))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.zeros(0) for f in range(len(monotone))]
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], axis=1) if len(x) else np.zeros((0, len(monotone)), np.int64)

    def value(g, h, low, high):
        return np.clip(-g / (h + ridge), low, high)

    def grow(rows, g, h, level, low, high) -> int:
        me = len(nodes)
        nodes.append([0, np.inf, me, me, rate * float(value(g[rows].sum(), h[rows].sum(), low, high))])
        if level == depth:
            return me
        best = (1e-6, None)
        loss = lambda v, a, b: a * v + (b + ridge) * v * v / 2
        total_g, total_h = g[rows].sum(), h[rows].sum()
        here = loss(value(total_g, total_h, low, high), total_g, total_h)
        for f, e in enumerate(edges):
            if not len(e):
                continue
            lg, lh = (np.cumsum(np.bincount(binned[rows, f], weights=w[rows], minlength=len(e) + 1))[:-1] for w in (g, h))
            lv, rv = value(lg, lh, low, high), value(total_g - lg, total_h - lh, low, high)
            gain = here - loss(lv, lg, lh) - loss(rv, total_g - lg, total_h - lh)
            gain[(lh < least) | (total_h - lh < least) | ((rv - lv) * monotone[f] < 0)] = 0
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (gain[k], (f, k, lv[k], rv[k]))
        if best[1] is None:
            return me
        f, k, lv, rv = best[1]
        goes, middle = binned[rows, f] <= k, (lv + rv) / 2
        (low_l, high_l), (low_r, high_r) = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}[int(monotone[f])]
        left = grow(rows[goes], g, h, level + 1, low_l, high_l)
        right = grow(rows[~goes], g, h, level + 1, low_r, high_r)
        nodes[me][:4] = f, float(edges[f][k]), left, right
        return me

    for _ in range(rounds if len(set(y.tolist())) > 1 else 0):
        p = 1 / (1 + np.exp(-margin))
        before = len(nodes)
        roots.append(grow(np.arange(len(y)), p - y, p * (1 - p), 0, -np.inf, np.inf))
        tree = _flat(nodes[before:], [0], depth, 0.0, before)
        at = np.zeros(len(y), np.int64)
        for _ in range(depth):
            at = np.where(x[np.arange(len(y)), tree.feature[at]] <= tree.bound[at], tree.left[at], tree.right[at])
        margin += tree.value[at]
    return _flat(nodes, roots, depth, float(np.log(prior / (1 - prior))))


def _flat(nodes: list[list], roots: list[int], depth: int, start: float, first: int = 0) -> Trees:
    feature, bound, left, right, value = (np.array(c) for c in zip(*nodes, strict=True)) if nodes else (np.zeros(1, np.int64),) * 5
    return Trees(feature.astype(np.int64), bound.astype(float), left - first, right - first, value.astype(float), np.array(roots, np.int64), depth, start)


def fitted(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> Trees:
    """Trees fitted on at most `most` labelled documents, those whose hashed doc_id is least. Their statistics, 1 MB, come to the driver."""
    picked = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.avg("quality").alias("q")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = docs.join(F.broadcast(picked), "doc_id").select("text", "q", "doc_id")

    def weigh(batches):
        for b in batches:
            x = [counts_and_statistics(t)[1] for t in b.column(0).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), b.column(1), b.column(2)], names=["x", "q", "doc_id"])

    got = rows.mapInArrow(weigh, T.StructType([T.StructField("x", T.ArrayType(T.DoubleType())), T.StructField("q", T.DoubleType()), rows.schema["doc_id"]])).orderBy("doc_id", "x").limit(most).collect()
    x = np.array([r.x for r in got]) if got else np.zeros((0, len(STATISTICS)))
    return fit(x, np.array([float(r.q >= 0.5) for r in got]))


def judge(docs: DataFrame, labelled: DataFrame, labels: DataFrame, text: str = "text", into: str = "rules", most: int = MAX_LABELLED) -> DataFrame:
    """docs with a struct: the base counts, base_failed, score, kept.

    labelled: doc_id, text of the documents that labels (doc_id, quality) speak of. base_failed: under 20 words, or over 30 % of the words in repeated
    windows of 8. score: of the trees (0 to 1), which never rises with the shares of symbols, repeated lines or repeated words. kept: not base_failed,
    and a score of THRESHOLD or more. A map over rows: no document moves; the trees' arrays, some 40 KB, go to all tasks.

    Null and empty texts have no words, so the base fails; labels that differ for a doc_id are averaged, null ones ignored; with labels of one kind or none there
    are no trees, and the score is their prior (0.5 without labels); repeated rows fare alike. An empty table gives an empty result.
    """
    ship(docs.sparkSession)
    trees = fitted(labelled, labels, most)

    def make():
        def run(texts):
            if not texts:
                return [[] for _ in range(len(COUNTS) + 3)]
            got = [counts_and_statistics(t) for t in texts]
            counts = np.array([c for c, _ in got], np.int64)
            score = trees.score(np.array([s for _, s in got]))
            failed = (counts[:, 0] < 20) | (100 * counts[:, 4] > 30 * counts[:, 0])
            return [*(pa.array(c) for c in counts.T.copy()), pa.array(failed), pa.array(score), pa.array(~failed & (score >= THRESHOLD))]

        return run

    kind = T.StructType([*(T.StructField(c, T.LongType()) for c in COUNTS), T.StructField("base_failed", T.BooleanType()), T.StructField("score", T.DoubleType()), T.StructField("kept", T.BooleanType())])
    return annotate(docs, free_name(docs, into), kind, make, text)


def op13_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs, labels = cells(table(spark, sf_dir, "documents")), table(spark, sf_dir, "labels")
    return judge(docs, docs, labels.filter(~fold(F.col("doc_id")))).select("doc_id", "rules.*")
