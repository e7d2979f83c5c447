"""SimHash near-dedup: exact tiled comparison of 64-bit fingerprints with numpy."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweave.llm.common import LOWER_BYTES, annotate, cells, row_salt, salted_join
from tickweave.llm.components import stars
from tickweave.plans.session import saved, ship, shuffle_parts, table

RADIUS = 3
SHINGLE = 3
#: Fingerprints that one task compares with each other; a larger tile group is split into slices of half of it.
GROUP_ROWS = 8192
TILE = 256


def shingle_hashes(text: bytes | None, k: int) -> np.ndarray:
    """XXH64 (seed 42) of each k words, lower-cased; of all words if there are fewer than k."""
    import xxhash

    words = text.translate(LOWER_BYTES).split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    line, h = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) < k:
        hashes = [h(line, 42)]
    else:
        stops = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = np.concatenate([[0], stops[:-1] + 1])
        hashes = [h(line[a:b], 42) for a, b in zip(starts[: len(words) - k + 1].tolist(), stops[k - 1 :].tolist(), strict=True)]
    return np.array(hashes, dtype=np.uint64)


def majority(values: np.ndarray) -> int:
    """Signed 64 bits: bit b is set if over half of the values have it; 0 without values."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(values), 1 << 16):
        bits = np.unpackbits(values[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        for low in range(0, len(bits), 255):  # sums of bytes within a byte
            counts += np.add.reduce(bits[low : low + 255], axis=0, dtype=np.uint8)
    return int(np.packbits(counts * 2 > len(values), bitorder="little").view(np.int64)[0])


def fingerprint(text: bytes | None, k: int = SHINGLE) -> int:
    """The majority bits of the shingles' hashes; 0 without words."""
    return majority(shingle_hashes(text, k))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp of docs (doc_id, text)."""
    out = annotate(docs, "sim", T.StructType([T.StructField("fp", T.LongType())]), lambda: lambda texts: [[fingerprint(t) for t in texts]])
    return out.select("doc_id", F.col("sim.fp").alias("fp"))


def components_of(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The least node of each node's component."""
    label = np.arange(n)
    while True:
        before = label.copy()
        np.minimum.at(label, u, label[v])
        np.minimum.at(label, v, label[u])
        label = label[label]
        if (label == before).all():
            return label


def ones_of(fps: np.ndarray) -> np.ndarray:
    """Set bits of fingerprints of one word, or along the last axis of ones of more words."""
    return np.bitwise_count(fps) if fps.ndim == 1 else np.bitwise_count(fps).sum(axis=-1, dtype=np.int64)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    if a.ndim == 1:
        return np.bitwise_count(a[:, None] ^ b[None])
    out = np.zeros((len(a), len(b)), np.uint16)
    for x, y in zip(a.T, b.T, strict=True):
        out += np.bitwise_count(x[:, None] ^ y[None])
    return out


def compare_tiles(fps: np.ndarray, part: np.ndarray, radius: int, tile: int = TILE) -> np.ndarray:
    """Component labels of one group. part: the slice of each; of two slices, only rows of unlike slices are compared."""
    n, two = len(fps), len(np.unique(part)) > 1
    ones = ones_of(fps).astype(np.int64)
    order = np.lexsort((ones, part))
    fps, ones, part = fps[order], ones[order], part[order]
    cuts = [(a, min(a + tile, hi)) for lo, hi in ((int(np.searchsorted(part, p)), int(np.searchsorted(part, p, "right"))) for p in np.unique(part)) for a in range(lo, hi, tile)]
    root = np.arange(n)
    for i, (a, b) in enumerate(cuts):
        for c, d in cuts[i:]:
            if two and part[a] == part[c]:
                continue
            if ones[c] - ones[b - 1] > radius or ones[a] - ones[d - 1] > radius:
                continue  # by their bit counts alone no pair of the two tiles is within the radius
            near = _distances(fps[a:b], fps[c:d]) <= radius
            x, y = np.nonzero(near)
            x, y = root[x + a], root[y + c]
            apart = x != y
            if apart.any():
                root = components_of(n, x[apart], y[apart])[root]
    out = np.empty(n, np.int64)
    out[order] = order[root]
    return out


def _compare_batch(groups: np.ndarray, fps: np.ndarray, part: np.ndarray, radius: int, small: int = 48) -> tuple[np.ndarray, np.ndarray]:
    """(place, place of its label) over whole groups (sorted). A group of more than `small` is compared in tiles; the
    others are a tile each, and go together, by the distance of two rows in it: there, too, pairs whose bit counts differ too much are skipped."""
    n = len(fps)
    stops = np.append(np.flatnonzero(np.diff(groups)) + 1, n)
    starts = np.concatenate([[0], stops[:-1]])
    sizes = stops - starts
    label = np.arange(n)
    u, v = [], []
    tiny = np.repeat(sizes <= small, sizes)
    ones = ones_of(fps).astype(np.int64)
    for d in range(1, int(min(small, sizes.max(initial=0)))):
        at = np.flatnonzero((groups[d:] == groups[:-d]) & tiny[d:])
        if not len(at):
            break
        at = at[np.abs(ones[at + d] - ones[at]) <= radius]
        near = at[ones_of(fps[at + d] ^ fps[at]) <= radius]
        u.append(near + d)
        v.append(near)
    if u:
        label = components_of(n, np.concatenate(u), np.concatenate(v))
    for a, b in zip(starts[sizes > small], stops[sizes > small], strict=True):
        label[a:b] = a + compare_tiles(fps[a:b], part[a:b], radius)
    moved = np.flatnonzero(label != np.arange(n))
    return moved, label[moved]


def masks(n: int, radius: int = RADIUS, full: int = GROUP_ROWS // 2) -> list[int]:
    """Bit masks, as signed longs, such that two fingerprints within the radius agree on one at least.

    64 bits in b blocks: `radius` differing bits leave b - radius blocks alone. b grows with the number of
    fingerprints, so that evenly spread ones would fill a group of the same masked bits to `full` at most; of
    the b - radius blocks only so many bits are kept that such a group is over half of that, so tiles are worth while.
    """
    for b in range(radius + 1, 2 * radius + 3):
        edges = [round(64 * i / b) for i in range(b + 1)]
        blocks = [range(edges[i], edges[i + 1]) for i in range(b)]
        bits = 64 * (b - radius) // b
        if n >> bits <= full:
            break
    need = min(bits, max(0, n // full).bit_length())
    out = []
    for chosen in combinations(blocks, b - radius):
        mask = sum(1 << i for i in [i for c in chosen for i in c][:need])
        out.append(mask - (1 << 64) if mask >> 63 else mask)
    return list(dict.fromkeys(out))


def near_links(fps: DataFrame, n: int, radius: int = RADIUS) -> DataFrame:
    """Edges u, v between distinct fingerprints (column fp) that connect what lies within the radius, a forest a group.

    Every pair within the radius meets in a group of equal masked bits. A group is compared in tiles; one of more than
    GROUP_ROWS is cut into slices by hash, and each pair of slices is a task of its own, so any group ends.
    """
    keyed = fps.select("fp", F.explode(F.array(*(F.struct(F.lit(i).alias("band"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks(n, radius))))).alias("b")).select("fp", "b.band", "b.key")
    return links_in_groups(keyed, radius)


def links_in_groups(keyed: DataFrame, radius: int, words: DataFrame | None = None) -> DataFrame:
    """near_links of rows fp, band, key: only fingerprints of an equal band and key are compared.

    words: fp, by which a fingerprint of more words is then only named, and a column for each word.
    """
    spark = keyed.sparkSession
    ship(spark)
    counts = keyed.groupBy("band", "key").count().filter("count > 1").withColumn("slices", F.when(F.col("count") > GROUP_ROWS, F.ceil(F.col("count") / (GROUP_ROWS // 2))).otherwise(1).cast("int")).drop("count")
    counts = counts.withColumn("id", F.struct("band", "key")).drop("band", "key")
    rows = salted_join(keyed.withColumn("id", F.struct("band", "key")), counts, "id", F.col("fp"), salts=4)
    names = [c for c in words.columns if c != "fp"] if words is not None else []
    if names:
        rows = rows.drop("id").distinct().join(words, "fp")
    # slice p meets each other slice in a task of that pair, and itself in one of its own
    rows = rows.withColumn("part", F.pmod(F.xxhash64("fp"), F.col("slices")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    rows = rows.select("fp", *names, "part", "band", "key", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"))
    task = ["band", "key", "low", "high"]
    first = 1 + len(names)  # the column `part`

    def run(batches):
        held: list[np.ndarray] = []

        def out(cols, group):
            fps = (np.stack(cols[1:first], axis=1) if names else cols[0]).view(np.uint64)
            a, b = _compare_batch(group, fps, cols[first], radius)
            return pa.RecordBatch.from_arrays([pa.array(cols[0][a]), pa.array(cols[0][b])], names=["u", "v"])

        for batch in batches:
            now = [batch.column(i).to_numpy() for i in range(first + 5)]
            now = [np.concatenate([x, y]) for x, y in zip(held, now, strict=True)] if held else now
            if not len(now[0]):
                continue
            group = np.concatenate([[0], np.cumsum(np.any([x[1:] != x[:-1] for x in now[first + 1 :]], axis=0))])
            whole = int(np.searchsorted(group, group[-1]))  # the last group may go on
            if whole:
                yield out([x[:whole] for x in now], group[:whole])
            held = [x[whole:].copy() for x in now]
        if held and len(held[0]):
            yield out(held, np.zeros(len(held[0]), np.int64))

    return rows.repartition(shuffle_parts(spark), *task).sortWithinPartitions(*task, "part").mapInArrow(run, "u long, v long")


def near_groups(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, fp, component_id (smallest doc_id that links reach).

    Equal fingerprints are one node, however many documents have them. Null, empty and wordless texts have
    fingerprint 0; a null doc_id is no component_id unless its component has no other; repeated rows share
    their component; an empty table gives an empty result.
    """
    rows = saved(fingerprints(docs), "simhash")
    nodes = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-nodes")
    star = stars(near_links(nodes.select("fp"), nodes.count(), radius), "simhash-stars")
    least = nodes.join(star.select(F.col("u").alias("fp"), F.col("v").alias("root")), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    heads = least.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = salted_join(least.select("fp", "root"), heads, "root", F.col("fp")).select("fp", "component_id")
    return salted_join(rows, named, "fp", row_salt()).select("doc_id", "fp", "component_id")


def op7_simhash(spark, sf_dir: str) -> DataFrame:
    out = near_groups(cells(table(spark, sf_dir, "documents")))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
