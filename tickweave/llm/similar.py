"""Near copies by the Jaccard similarity of shingle sets: SimHash candidates, then an exact check of each."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweave.llm.common import MAP_BITS, annotate, bit_rows, cells, row_salt, salted_join
from tickweave.llm.components import stars
from tickweave.llm.simhash import links_in_groups, majority, ones_of, shingle_hashes
from tickweave.plans.session import saved

SHINGLE = 5
#: Words of 64 bits of a candidate's fingerprint: in 64 bits alone, unlike texts with a common shingle lie too often within a safe radius.
WORDS = 4
#: Candidates' distance in 256 bits. Of sets at similarity 0.8 each bit differs with a chance of 0.15 (0.19 if they are tiny): 39 or 48
#: bits with a deviation of 6, so that under one pair in 10^6 is farther. Unlike texts have 128 with a deviation of 8.
RADIUS = 80
#: The similarity asked for, as a fraction.
NUM, DEN = 4, 5
#: Sets, and shingles in them, of one slice of candidates; a task checks two slices.
SLICE = 512
SLICE_SHINGLES = 4 << 20
#: Texts whose sets a worker holds at a time.
TEXT_BYTES = 2 << 20
#: One in SAMPLE documents tells which shingles are common: those that HOT of them have.
SAMPLE, HOT = 16, 3


def shingle_set(text: bytes | None, k: int = SHINGLE) -> np.ndarray:
    return np.unique(shingle_hashes(text, k))


def signature(values: np.ndarray) -> int:
    """Signed 64-bit hash of a set."""
    import xxhash

    return int(np.array([xxhash.xxh64_intdigest(values.tobytes(), 7)], np.uint64).view(np.int64)[0])


def wide_fingerprint(values: np.ndarray) -> list[int]:
    """WORDS SimHash words of a set, each of its own mix of the hashes."""
    out = []
    for i in range(WORDS):
        h = (values ^ np.uint64(0x9E3779B97F4A7C15 * (i + 1) % (1 << 64))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
        out.append(majority(h ^ (h >> np.uint64(29))))
    return out


def prefix(values: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """The first shingles of a set in an order that all sets share: the common ones (bits of `hot`) last, else by hash.

    Two sets of the similarity asked for have over `len - prefix` shingles in common, so their prefixes share one.
    """
    slot = (values & np.uint64(MAP_BITS - 1)).astype(np.int64)
    common = (hot[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1
    n = len(values)
    return np.concatenate([values[~common], values[common]])[: n - (NUM * n + DEN - 1) // DEN + 1 if n else 0]


def common_shingles(docs: DataFrame, k: int) -> bytes:
    """A bitmap of MAP_BITS bits of the shingles that many documents have. It only sets an order, so a sample will do."""
    part = docs.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(SAMPLE)) == 0)
    kind = T.StructType([T.StructField("items", T.ArrayType(T.LongType()))])
    items = annotate(part, "set", kind, lambda: lambda texts: [[shingle_set(t, k).view(np.int64) for t in texts]], limit=TEXT_BYTES)
    seen = items.select(F.explode("set.items").alias("h")).groupBy("h").count().filter(F.col("count") >= HOT)
    bits = bytearray(MAP_BITS // 8)
    for r in bit_rows(seen.select(F.pmod("h", F.lit(MAP_BITS)).alias("slot"))).toLocalIterator():
        bits[r["_row"] * 4096 : (r["_row"] + 1) * 4096] = r["_bits"]
    return bytes(bits)


def prints(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, sig, n, words, prefix: hash, size and fingerprint of each document's shingle set, and its prefix."""
    shared = docs.sparkSession.sparkContext.broadcast(common_shingles(docs, k))
    kind = T.StructType([T.StructField("sig", T.LongType()), T.StructField("n", T.LongType()), T.StructField("words", T.ArrayType(T.LongType())), T.StructField("prefix", T.ArrayType(T.LongType()))])

    def make():
        hot = np.frombuffer(shared.value, np.uint8)

        def f(texts):
            sets = [shingle_set(t, k) for t in texts]
            return [[signature(s) for s in sets], [len(s) for s in sets], [wide_fingerprint(s) for s in sets], [prefix(s, hot).view(np.int64) for s in sets]]

        return f

    return annotate(docs, "p", kind, make, limit=TEXT_BYTES).select("doc_id", "p.*")


def similar_pairs(fps: np.ndarray, sets: list[np.ndarray], part: np.ndarray, radius: int) -> tuple[list[int], list[int]]:
    """A forest (places u, v) that connects the pairs within the radius and of the similarity asked for; of two slices, only pairs of unlike ones."""
    sizes = np.array([len(s) for s in sets], np.int64)
    order = np.argsort(sizes, kind="stable")
    fps, part, sizes = fps[order], part[order], sizes[order]
    items, flat = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    two, root, mark = len(np.unique(part)) > 1, np.arange(len(fps)), np.zeros(len(items), bool)
    u, v = [], []
    for i in range(len(fps)):
        stop = int(np.searchsorted(sizes, sizes[i] * DEN // NUM, "right"))  # a larger set can't be similar
        near = ones_of(fps[i + 1 : stop] ^ fps[i]) <= radius
        near &= root[i + 1 : stop] != root[i]  # else connected already
        if two:
            near &= part[i + 1 : stop] != part[i]
        at = np.flatnonzero(near) + i + 1
        mine = flat[starts[i] : starts[i] + sizes[i]]
        mark[mine] = True
        for j in range(0, len(at), 64):
            now = at[j : j + 64]
            at_flat = np.repeat(starts[now] - np.cumsum(sizes[now]) + sizes[now], sizes[now]) + np.arange(sizes[now].sum())
            both = np.add.reduceat(mark[flat[at_flat]], np.cumsum(sizes[now]) - sizes[now], dtype=np.int64)
            good = now[both * (DEN + NUM) >= NUM * (sizes[now] + sizes[i])]
            for x in good.tolist():
                if root[x] != root[i]:
                    root[root == root[x]] = root[i]
                    u.append(int(order[i]))
                    v.append(int(order[x]))
        mark[mine] = False
    return u, v


def checked_links(docs: DataFrame, rows: DataFrame, nodes: DataFrame, k: int, radius: int, size: int) -> DataFrame:
    """Edges u, v of sig: a forest of the similar pairs in each task.

    Links between fingerprints of sets with a shingle of their prefixes in common only say which sets are checked with each other: all those of a component. One of
    many sets is cut into slices, and each pair of slices is a task of its own, so any component ends.
    """
    # 40 bits of a shingle's hash are shuffled; what that brings together besides isn't within the radius
    keyed = rows.select(F.col("sig").alias("fp"), F.lit(0).alias("band"), F.explode("prefix").alias("key")).withColumn("key", F.shiftrightunsigned("key", 24))
    words = nodes.select(F.col("sig").alias("fp"), *(F.col("words")[i].alias(f"w{i}") for i in range(WORDS)))
    star = stars(links_in_groups(keyed, radius, words), "similar-candidates")
    held = nodes.select("sig", "n").join(star.select(F.col("u").alias("sig"), F.col("v").alias("root")), "sig", "left").select("sig", "n", F.coalesce("root", "sig").alias("root"))
    slices = F.ceil(F.greatest(F.count("*") / size, F.sum("n") / SLICE_SHINGLES)).cast("int")
    groups = held.groupBy("root").agg(F.count("*").alias("c"), slices.alias("slices")).filter("c > 1").drop("c")
    held = saved(salted_join(held, groups, "root", F.col("sig")).select("sig", "root", "slices"), "similar-held")
    need = rows.join(held, "sig", "left_semi").select(F.col("doc_id").alias("_id")).distinct()
    kind = T.StructType([T.StructField("sig", T.LongType()), T.StructField("words", T.ArrayType(T.LongType())), T.StructField("items", T.ArrayType(T.LongType()))])

    def sets_of(texts):
        sets = [shingle_set(t, k) for t in texts]
        return [[signature(s) for s in sets], [wide_fingerprint(s) for s in sets], [s.view(np.int64) for s in sets]]

    sets = annotate(docs.join(need, docs["doc_id"].eqNullSafe(need["_id"]), "left_semi"), "s", kind, lambda: sets_of, limit=TEXT_BYTES).select("s.*").dropDuplicates(["sig"])
    rows = sets.join(held, "sig").withColumn("part", F.pmod(F.xxhash64("sig"), F.col("slices")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    rows = rows.select("sig", "words", "items", "part", "root", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"))

    def check(t: pa.Table) -> pa.Table:
        sig, part = (t.column(c).to_numpy() for c in ("sig", "part"))
        if t.column("low")[0].as_py() != t.column("high")[0].as_py() and len(np.unique(part)) == 1:
            u, v = [], []  # the other slice is empty
        else:
            sets = [x.values.to_numpy() for x in t.column("items")]
            fps = np.stack([x.values.to_numpy() for x in t.column("words")]).view(np.uint64)
            u, v = similar_pairs(fps, sets, part, radius)
        return pa.table({"u": pa.array(sig[u], pa.int64()), "v": pa.array(sig[v], pa.int64())})

    return rows.groupBy("root", "low", "high").applyInArrow(check, "u long, v long")


def similar_groups(docs: DataFrame, k: int = SHINGLE, radius: int = RADIUS, size: int = SLICE) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, component_id (smallest doc_id that links of similar pairs reach).

    Equal sets are one node, and so are all texts without words.
    """
    rows = saved(prints(docs, k), "similar")
    nodes = saved(rows.groupBy("sig").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("words").alias("words")), "similar-nodes")
    star = stars(checked_links(docs, rows, nodes, k, radius, size), "similar-stars")
    least = nodes.select("sig", "rep").join(star.select(F.col("u").alias("sig"), F.col("v").alias("root")), "sig", "left").withColumn("root", F.coalesce("root", "sig"))
    heads = least.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = salted_join(least.select("sig", "root"), heads, "root", F.col("sig")).select("sig", "component_id")
    return salted_join(rows.select("doc_id", "sig"), named, "sig", row_salt()).select("doc_id", "component_id")


def drop_near(docs: DataFrame) -> DataFrame:
    """docs with one document of each group: that with the smallest doc_id."""
    gone = similar_groups(cells(docs)).filter("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
