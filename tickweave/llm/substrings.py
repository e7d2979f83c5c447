"""Suffix-array dedup: remove the bytes of long substrings that occur more than once in the corpus."""

from __future__ import annotations

import hashlib
import re
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tickweave.llm.common import LOWER_BYTES, bit_rows, cells, in_map, key_map, salted_join
from tickweave.plans.session import release, saved, ship, shuffle_parts, table

LENGTH = 400
#: Bytes whose hash makes an anchor.
GRAM = 24
#: Bits of the map of repeated anchors: 16 MB are broadcast at any input size.
ANCHOR_BITS = 1 << 27
#: Text that one suffix array holds; its arrays take some 100 bytes a byte.
SHARD_BYTES = 2 << 20
#: Distinct stretches of one anchor that one shard takes, some 2.5 MB at most; an anchor with more is split by longer contexts.
ANCHOR_ROWS = 4096
#: Windows in a stretch whose anchors are equal grams (text with a period), at most; more are further stretches.
PERIODIC = 2048
#: Words of a passage, and of the grams that anchor it.
PASSAGE_WORDS = 50
PASSAGE_GRAM = 5


def gram_hashes(raw: np.ndarray, k: int = GRAM) -> np.ndarray:
    """A 64-bit hash of the k bytes from each place."""
    h, width, base = raw.astype(np.uint64) + np.uint64(1), 1, 0x9E3779B97F4A7C15
    power = lambda w: np.uint64(pow(base, w, 1 << 64))
    have = {1: h}
    while width * 2 <= k:
        h = h[:-width] * power(width) + h[width:]
        width *= 2
        have[width] = h
    left = k - width
    for w in sorted((w for w in have if w <= left), reverse=True):  # the binary digits of what is left
        if left >= w:
            n = len(raw) - width - w + 1
            h = h[:n] * power(w) + have[w][width : width + n]
            width += w
            left -= w
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _window_least(x: np.ndarray, w: int) -> np.ndarray:
    """Least of each w neighbours."""
    n = len(x) - w + 1
    pad = np.full(-len(x) % w, np.iinfo(x.dtype).max, x.dtype)
    blocks = np.concatenate([x, pad]).reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[w - 1 : w - 1 + n])


def stretches(texts: list[bytes], length: int = LENGTH, gram: int = GRAM, merge: bool = True, block: int = 1 << 18) -> tuple[np.ndarray, ...]:
    """(text, first start, last start, anchor's place after the first start, anchor's gram hash) of the runs of windows with one anchor, in each of the texts.

    A window of `length` bytes has as its anchor the gram in it with the least hash, the leftmost of equals: a matter of
    its content, so equal windows have equal anchors at equal distances and meet under the gram's hash. Runs that follow each other
    with equal grams, as in text with a period, are merged to PERIODIC windows, with -1 for the place. Runs may also be
    cut at block ends; the texts go through as one, a block at a time, so short ones cost no calls of their own.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    stops = np.cumsum(sizes)
    begins = stops - sizes
    joined = np.frombuffer(b"".join(texts), np.uint8)
    n = len(joined) - length + 1
    if n < 1:
        return (*(np.zeros(0, np.int64) for _ in range(4)), np.zeros(0, np.uint64))
    over = np.zeros(len(joined) + 1, np.int8)  # windows that run over a text's end
    np.add.at(over, np.maximum(begins, stops - length + 1), 1)
    np.add.at(over, stops, -1)
    over = np.cumsum(over[:n], dtype=np.int8)
    outs = []
    for at in range(0, n, block):
        h = gram_hashes(joined[at : at + block + length - 1], gram)
        ranked = (h & np.uint64(0xFFFFFFFFFF000000)) | np.arange(len(h), dtype=np.uint64)  # 40 bits of hash, then the place
        anchor = (_window_least(ranked, length - gram + 1) & np.uint64(0xFFFFFF)).astype(np.int64)
        out = over[at : at + block]
        cut = np.flatnonzero((anchor[1:] != anchor[:-1]) | (out[1:] != out[:-1]))
        first, last = np.concatenate([[0], cut + 1]), np.append(cut, len(anchor) - 1)
        whole = out[first] == 0
        first, last = first[whole], last[whole]
        key = h[anchor[first]]
        off = anchor[first] - first
        if merge and len(first):
            follows = np.concatenate([[False], (first[1:] == last[:-1] + 1) & (key[1:] == key[:-1])])
            chain = np.maximum.accumulate(np.where(follows, 0, np.arange(len(first))))  # each run's first of its chain
            part = (first - first[chain]) // PERIODIC
            head = ~follows | np.concatenate([[True], part[1:] != part[:-1]])
            heads = np.flatnonzero(head)
            many = np.diff(np.append(heads, len(first))) > 1
            last = last[np.append(heads[1:], len(first)) - 1]
            first, key, off = first[heads], key[heads], np.where(many, -1, off[heads])
        outs.append((first + at, last + at, off, key))
    first, last, off, key = (np.concatenate(x) for x in zip(*outs, strict=True))
    which = np.searchsorted(stops, first, "right")
    return which, first - begins[which], last - begins[which], off, key


def word_symbols(texts: list[bytes], block: int = 1 << 20) -> list[bytes]:
    """Each text as 16 bits of hash for each of its words (A-Z lower-cased; what is not white space or control characters).

    Blocks are cut at white space, so memory is bounded but for a single word.
    """
    out = []
    held, size = [], 0
    for t in texts:
        t = t.translate(LOWER_BYTES)
        if len(t) <= block:
            held.append(t)
            size += len(t)
            if size >= block:
                out += _word_symbols(held)
                held, size = [], 0
            continue
        out += _word_symbols(held)
        held, size, own, a = [], 0, [], 0
        while a < len(t):
            gap = _GAP.search(t, a + block) if a + block < len(t) else None
            b = gap.start() if gap else len(t)
            own += _word_symbols([t[a:b]])
            a = b
        out.append(b"".join(own))
    return out + _word_symbols(held)


_GAP = re.compile(rb"[\x00-\x20]")
_BASE = 0x9E3779B97F4A7C15
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, n at least."""
    if len(_POWERS[0]) < n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            _POWERS[i] = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n + n // 2, base, np.uint64)]))
    return _POWERS[0], _POWERS[1]


def _word_symbols(texts: list[bytes]) -> list[bytes]:
    raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    power, inverse = _powers(len(raw))
    inside = raw > 32
    edges = np.flatnonzero(np.diff(inside, prepend=False))
    start, stop = edges[::2], edges[1::2]
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[: len(raw)], dtype=np.uint64)])
    h = (total[stop] - total[start]) * inverse[start]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    symbols = (h >> np.uint64(48)).astype("<u2")
    ends = np.searchsorted(start, np.cumsum([len(t) + 1 for t in texts]))
    return [symbols[a:b].tobytes() for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)] if texts else []


def _bytes(texts: list[bytes]) -> list[bytes]:
    return texts


def _merge(a: np.ndarray, b: np.ndarray) -> list[list[int]]:
    out: list[list[int]] = []
    for x, y in sorted(zip(a.tolist(), b.tolist(), strict=True)):
        if out and x <= out[-1][1]:
            out[-1][1] = max(out[-1][1], y)
        else:
            out.append([x, y])
    return out


def _runs(starts: np.ndarray) -> list[dict]:
    """Sorted places as ranges a to b, b not included."""
    cut = np.flatnonzero(np.diff(starts) > 1)
    return [{"a": int(x), "b": int(y) + 1} for x, y in zip(starts[np.concatenate([[0], cut + 1])], starts[np.append(cut, len(starts) - 1)], strict=True)]


def _pieces(column: pa.Array, count: int, limit: int = 4 << 20):
    """(first row, texts) of a column, about limit bytes at a time."""
    step = max(1, int(count * limit / max(column.nbytes, 1)))
    for at in range(0, count, step):
        yield at, column.slice(at, step).cast(pa.binary()).to_pylist()


def _anchor_counts(docs: DataFrame, length: int, gram: int, symbols) -> DataFrame:
    """anchor, n: stretches with this anchor; a stretch with a period, which may repeat in itself, counts twice."""

    def run(batches):
        for b in batches:
            for _, texts in _pieces(b.column(0), b.num_rows):
                off, key = stretches(symbols([t or b"" for t in texts]), length, gram)[3:]
                keys, place = np.unique(key.view(np.int64), return_inverse=True)
                n = np.bincount(place, weights=1 + (off < 0), minlength=len(keys))
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n.astype(np.int64))], names=["anchor", "n"])

    return docs.select("text").mapInArrow(run, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))


_FOUND = "id1 long, id2 long, at long, anchor long, off long, h1 long, h2 long, n long, low long, high long, part binary"


def _repeated_stretches(docs: DataFrame, bits, length: int, gram: int, symbols) -> DataFrame:
    """_FOUND: the stretches of anchors that the map has, one a row.

    Of equal ones in a piece of a batch the first has their count n, and the least and largest id1 of their documents; the others have
    n 0. Only the first in a batch has the text, so that copies don't carry it.
    """

    def run(batches):
        for b in batches:
            known = np.frombuffer(bits.value, np.uint8)
            seen: set[bytes] = set()
            for first, texts in _pieces(b.column(2), b.num_rows):
                texts = symbols([t or b"" for t in texts])
                which, lo, hi, off, key = stretches(texts, length, gram)
                slot = (key % np.uint64(ANCHOR_BITS)).astype(np.int64)
                keep = np.flatnonzero((known[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1)
                which, lo, hi, off, key = which[keep], lo[keep], hi[keep], off[keep], key[keep].view(np.int64)
                parts = [texts[i][x : y + length] for i, x, y in zip(which.tolist(), lo.tolist(), hi.tolist(), strict=True)]
                names = [hashlib.blake2b(p, digest_size=16).digest() for p in parts]
                digests = np.frombuffer(b"".join(names), "<i8").reshape(-1, 2)
                rows = pa.array(which + first)
                doc = b.column(0).take(rows)
                # equal digests side by side, the earliest first
                ids = doc.to_numpy()
                order = np.lexsort((np.arange(len(digests)), off, digests[:, 1], digests[:, 0]))
                d = digests[order]
                head = np.concatenate([[True], (d[1:] != d[:-1]).any(1) | (off[order][1:] != off[order][:-1])])[: len(d)]
                heads = np.flatnonzero(head)
                n, low, high = (np.zeros(len(d), np.int64) for _ in range(3))
                if len(d):
                    at = order[heads]
                    n[at] = np.diff(np.append(heads, len(d)))
                    low[at], high[at] = np.minimum.reduceat(ids[order], heads), np.maximum.reduceat(ids[order], heads)
                held: list[bytes | None] = [None] * len(parts)
                for i in np.flatnonzero(n).tolist():
                    if names[i] not in seen:
                        seen.add(names[i])
                        held[i] = parts[i]
                yield pa.RecordBatch.from_arrays(
                    [doc, b.column(1).take(rows), pa.array(lo), pa.array(key), pa.array(off), pa.array(digests[:, 0]), pa.array(digests[:, 1]), pa.array(n), pa.array(low), pa.array(high), pa.array(held, pa.binary())],
                    names=[x.split()[0] for x in _FOUND.split(", ")],
                )

    return docs.select("id1", "id2", "text").mapInArrow(run, _FOUND)


RANGES = "array<struct<a:long,b:long>>"
#: A stretch that goes to a shard: its anchor and that one's place, its name (h1, h2), its count and documents, its text.
_ROW = "anchor long, off long, h1 long, h2 long, n long, low long, high long, part binary"
#: A part of the stretch h1, h2, with a name of its own (g1, g2, of what it holds) and where it stands in the stretch.
_PART = "anchor long, off long, g1 long, g2 long, n long, low long, high long, part binary, h1 long, h2 long, shifts array<long>"


def _shared(parts: list[bytes]) -> list[int]:
    """For each, the longest prefix that it has in common with any other."""
    order = sorted(range(len(parts)), key=parts.__getitem__)
    out = [0] * len(parts)
    for i, j in zip(order, order[1:]):
        m = min(len(parts[i]), len(parts[j]))
        differ = int.from_bytes(parts[i][:m], "big") ^ int.from_bytes(parts[j][:m], "big")
        same = m - (differ.bit_length() + 7) // 8
        out[i], out[j] = max(out[i], same), max(out[j], same)
    return out


def trimmed(rows: list[list], length: int) -> dict[bytes, list]:
    """String -> [count, least and largest document, (h1, h2, its place in the stretch), ...] of one anchor's distinct stretches (_ROW but the anchor).

    A window equal to one of another stretch has its anchor at the same distance, so it lies within what the stretch shares with
    others to the left and to the right of the anchor. The rest of the stretch can't repeat and goes, unless a stretch
    with a period, in which windows have different anchors, is among them. A lone stretch that was counted once and has no period goes.
    """
    periodic = any(r[0] < 0 for r in rows)
    if len(rows) == 1 and rows[0][3] < 2 and not periodic:
        return {}
    left = right = [0] * len(rows)
    if not periodic and len(rows) > 1:
        left = _shared([r[6][: r[0]][::-1] for r in rows])
        right = _shared([r[6][r[0] :] for r in rows])
    out: dict[bytes, list] = {}
    for (off, h1, h2, n, low, high, part), x, y in zip(rows, left, right, strict=True):
        start, stop = (0, len(part)) if n > 1 or periodic else (off - x, off + y)
        if stop - start >= length:
            got = out.setdefault(part[start:stop], [0, low, high])
            got[0] += n
            got[1], got[2] = min(got[1], low), max(got[2], high)
            got.append((h1, h2, start))
    return out


def _by_suffix_arrays(rows: DataFrame, length: int, shard_bytes: int, parts: int, across: bool, budget: int) -> DataFrame:
    """h1, h2, ranges (starts of repeated windows in the stretch) of rows _ROW, by a suffix array a shard; an anchor's stretches are in one shard.

    A string that was counted more than once stands there once, for the others to meet it: its own windows all repeat.
    """

    def run(batches):
        from tickweave.llm.induced import repeated_places

        def marks(found):
            """A batch of (what is known of a string, its starts of repeated windows)."""
            out = [[], [], []]
            for known, own in found:
                for h1, h2, start in known[3:]:
                    for c, v in zip(out, (h1, h2, _runs(own + start)), strict=True):
                        c.append(v)
            kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
            return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], kind)], names=["h1", "h2", "ranges"])

        def repeats(known):
            """Whether the string as a whole, and so each window of it, was counted twice."""
            return known[0] > 1 and (not across or known[1] != known[2])

        def shard(held):
            docs = None
            if across:  # a string of several documents is a document of its own kind, unlike any
                docs = np.unique([known[1] for _, known in held], return_inverse=True)[1]
                several = np.array([known[1] != known[2] for _, known in held])
                docs[several] = len(held) + np.arange(int(several.sum()))
            starts, places = repeated_places([s for s, _ in held], length, budget, docs)
            cuts = np.searchsorted(places, np.append(starts, np.iinfo(np.int64).max)).tolist()
            found = []
            for i, (s, known) in enumerate(held):
                own = np.arange(len(s) - length + 1) if repeats(known) else places[cuts[i] : cuts[i + 1]] - starts[i]
                if len(own):
                    found.append((known, own))
            return marks(found)

        def groups():
            held, last = [], None
            for b in batches:
                for anchor, *row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    if held and anchor != last:
                        yield held
                        held = []
                    last = anchor
                    if held and held[-1][:3] == row[:3]:  # the same stretch from another batch
                        h = held[-1]
                        h[3:6] = h[3] + row[3], min(h[4], row[4]), max(h[5], row[5])
                    else:
                        held.append(row)
            if held:
                yield held

        held, size, alone = [], 0, []
        for group in groups():
            strings = trimmed(group, length)
            if len(strings) == 1 and group[0][0] >= 0:  # nothing to compare it with
                alone += [(known, np.arange(len(s) - length + 1)) for s, known in strings.items() if repeats(known)]
            else:
                held += strings.items()
                size += sum(map(len, strings))
            if len(alone) >= 4096:
                yield marks(alone)
                alone = []
            if size >= shard_bytes:
                yield shard(held)
                held, size = [], 0
        yield marks(alone)
        if held:
            yield shard(held)

    names = [x.split()[0] for x in _ROW.split(", ")]
    dealt = rows.select(*names).repartition(parts, "anchor").sortWithinPartitions("anchor", "off", "h1", "h2", F.col("part").isNull())
    return dealt.mapInArrow(run, f"h1 long, h2 long, ranges {RANGES}")


def _split(rows: DataFrame, length: int, gram: int, width: int) -> DataFrame:
    """Rows _ROW as _PART, by longer contexts: each stretch's windows by their distance to the anchor, `width` distances together.

    All windows at distances d to d + width - 1 hold the bytes from d before the anchor to length - d - width after it; their
    hash is the new anchor. Equal windows still meet: they have equal distances. Stretches with a period are taken apart first.
    """

    def run(batches):
        for b in batches:
            out = [[] for _ in range(11)]

            def put(anchor, off, part, windows, n, low, high, h1, h2, places, out=out):
                for d0 in range((off - windows + 1) // width * width, off + 1, width):
                    a, z = max(0, off - d0 - width + 1), min(windows - 1, off - d0)
                    if a <= z:
                        context = part[off - d0 : off - d0 - width + 1 + length]
                        key = hashlib.blake2b(context, digest_size=8, key=d0.to_bytes(4, "little") + anchor.to_bytes(8, "little", signed=True)).digest()
                        own = part[a : z + length]
                        name = hashlib.blake2b(own, digest_size=16, key=key + (off - a).to_bytes(4, "little")).digest()
                        values = (int.from_bytes(key, "little", signed=True), off - a, int.from_bytes(name[:8], "little", signed=True), int.from_bytes(name[8:], "little", signed=True), n, low, high, own, h1, h2, [x + a for x in places])
                        for c, v in zip(out, values, strict=True):
                            c.append(v)

            for anchor, off, h1, h2, n, low, high, part in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if off >= 0:
                    put(anchor, off, part, len(part) - length + 1, n, low, high, h1, h2, [0])
                    continue
                runs: dict[tuple, list] = {}
                for lo, hi, o in zip(*(x.tolist() for x in stretches([part], length, gram, False)[1:4]), strict=True):
                    runs.setdefault((part[lo : hi + length], o), []).append(lo)
                for (own, o), places in runs.items():
                    put(anchor, o, own, len(own) - length + 1, n * len(places), low, high, h1, h2, places)
            fields = [x.split() for x in _PART.split(", ")]
            kinds = {"long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
            yield pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(out, fields, strict=True)], names=[x for x, _ in fields])

    return rows.mapInArrow(run, _PART)


def _marks(found: DataFrame, length: int, gram: int, shard_bytes: int, anchor_rows: int, across: bool, budget: int) -> DataFrame:
    """h (struct of h1, h2), ranges: by suffix arrays.

    Anchors with more than anchor_rows distinct stretches are split until none is left: at width 1 an anchor's stretches are
    windows that differ in one byte at most, so this ends after as many rounds as length has binary digits. Equal parts become one by their names, so a
    passage that very many stretches have is one row, and what is found for a part goes back to the stretches that have it. Joins are sort-merge ones:
    ranges, like those of equal texts, take many times their files' bytes in memory, so a table of a few MB on disk would be too much for the driver to broadcast.
    """
    spark = found.sparkSession
    parts = shuffle_parts(spark)
    names = [x.split()[0] for x in _ROW.split(", ")]
    summed = [F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.max("part").alias("part")]
    rows = found.filter("n > 0").select(*names)
    width, ready, splits = length - gram + 1, [], []
    while True:
        hot = saved(rows.groupBy("anchor").count().filter(F.col("count") > anchor_rows).select("anchor"), "op3-hot")
        # with a row that no key has, so that adaptive execution keeps the one plan where no anchor is hot
        map_ = key_map(hot, "anchor")
        flagged = in_map(rows, map_.unionByName(spark.range(1).select(F.lit(-1).alias("_row"), F.lit(bytes(4096)).alias("_bits"))), "_hot", "anchor")
        if width == 1:
            ready.append(rows)
            break
        ready.append(flagged.filter("not _hot").drop("_hot"))
        if hot.isEmpty():
            break
        many = flagged.filter("_hot")
        if not splits:  # of equal stretches from many batches one stays
            many = many.groupBy("anchor", "off", "h1", "h2").agg(*summed)
        width = max(1, (width + 1) // 2)
        splits.append(saved(_split(many.select(*names), length, gram, width), "op3-split"))
        rows = saved(splits[-1].groupBy("anchor", "off", F.col("g1").alias("h1"), F.col("g2").alias("h2")).agg(*summed).select(*names), "op3-parts")
    marks = _by_suffix_arrays(reduce(DataFrame.unionByName, ready), length, shard_bytes, parts, across, budget)
    marks = saved(marks.select(F.struct("h1", "h2").alias("h"), "ranges"), "op3-marks")
    for split in reversed(splits):  # a part's starts go to the stretches that have it, a row a stretch
        held = split.select(F.struct(F.col("g1").alias("h1"), F.col("g2").alias("h2")).alias("h"), F.struct("h1", "h2").alias("whole"), "shifts")
        moved = F.flatten(F.transform("shifts", lambda s: F.transform("ranges", lambda r: F.struct((r["a"] + s).alias("a"), (r["b"] + s).alias("b")))))
        back = held.join(marks.hint("merge"), "h").select(F.col("whole").alias("h"), moved.alias("ranges")).groupBy("h").agg(F.array_distinct(F.flatten(F.collect_list("ranges"))).alias("ranges"))
        marks = saved(marks.join(split.select(F.struct(F.col("g1").alias("h1"), F.col("g2").alias("h2")).alias("h")).distinct().hint("merge"), "h", "left_anti").unionByName(back), "op3-marks")
    return marks


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, symbols=_bytes, across: bool = False, shard_bytes: int = SHARD_BYTES, anchor_rows: int = ANCHOR_ROWS, budget: int = 256 << 20) -> DataFrame:
    """docs (id1, id2 and text) that have repeated strings of `length` bytes: id1, id2, spans (byte ranges covered by them).

    1. Count anchors; a bitmap of fixed size says which occur twice. 2. Stretches (windows of one such anchor, about 600 bytes)
    are cut out, with the text of equal ones once a batch. 3. Those of an anchor meet in a shard, trimmed to what can repeat; its suffix and
    common-prefix arrays show the windows that stand twice. 4. Starts go back to their documents.

    symbols: what makes the strings that are compared, out of texts. across: only strings that stand in two documents (id1) count.
    budget: bytes of a shard's queues in memory; what is beyond goes to disk.
    """
    spark = docs.sparkSession
    ship(spark)
    twice = _anchor_counts(docs, length, gram, symbols).filter("n > 1").select(F.col("anchor").bitwiseAND(ANCHOR_BITS - 1).alias("slot"))
    bits = bytearray(ANCHOR_BITS // 8)
    for row in bit_rows(twice).toLocalIterator():  # at most 16 MB
        bits[row[0] * 4096 : row[0] * 4096 + 4096] = bytes(row[1])
    found = saved(_repeated_stretches(docs, spark.sparkContext.broadcast(bytes(bits)), length, gram, symbols), "op3-stretches")
    release(spark)
    marks = _marks(found, length, gram, shard_bytes, anchor_rows, across, budget)
    release(spark)
    places = found.select("id1", "id2", "at", F.struct("h1", "h2").alias("h")).distinct()
    hits = salted_join(places, marks.hint("merge"), "h", F.struct("id1", "at")).select("id1", "id2", F.transform("ranges", lambda r: F.struct((r["a"] + F.col("at")).alias("start"), (r["b"] + F.col("at") + (length - 1)).alias("stop"))).alias("spans"))
    return hits.groupBy("id1", "id2").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def cut_repeats(docs: DataFrame, length: int = LENGTH, words: int = PASSAGE_WORDS, **how) -> DataFrame:
    """docs (doc_id, text) as doc_id, n_bytes, n_removed, spans (removed bytes), kept_sha256, n_passage_words.

    Every byte is removed that lies in a string of `length` bytes which also starts elsewhere, in the same document or
    another, as judged on the whole input; matches don't cross documents.
    n_passage_words counts the words in passages of `words` words or more that also stand in another document, which may be shorter than
    `length` bytes and stay: the same search over a string of 16 bits of hash a word (unlike words pass as equal once in 65,536).

    Null counts as empty; texts shorter than `length` lose nothing; repeated rows are repeats of each other, also under
    one doc_id, but no other document; a null doc_id is a document as any other; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    named = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("id1"), F.xxhash64("text", F.lit("second"), "doc_id").alias("id2"))
    spans = saved(repeated_spans(named, length, **how), "op3-spans")
    release(spark)
    passages = saved(repeated_spans(named, 2 * words, 2 * PASSAGE_GRAM, word_symbols, True, **how), "op3-passages")
    release(spark)
    none = F.lit(None).cast(dict(spans.dtypes)["spans"])
    both = spans.select("id1", "id2", "spans", none.alias("passages")).unionByName(passages.select("id1", "id2", none.alias("spans"), F.col("spans").alias("passages")))
    both = saved(both.groupBy("id1", "id2").agg(F.first("spans", True).alias("spans"), F.first("passages", True).alias("passages")), "op3-both")
    # only documents that have any are shuffled to them
    marked = in_map(named, key_map(both, "id1", "id2"), "_some", "id1", "id2")
    some = marked.filter("_some").drop("_some").join(both.hint("merge"), ["id1", "id2"], "left")
    rest = marked.filter("not _some").drop("_some").withColumns({"spans": none, "passages": none})
    kind = T.StructType([T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())]))), T.StructField("kept_sha256", T.StringType()), T.StructField("n_passage_words", T.LongType())])
    rows = some.select("doc_id", "text", "spans", "passages").unionByName(rest.select("doc_id", "text", "spans", "passages"))

    def merged(spans):
        return _merge(np.array([s["start"] for s in spans], np.int64), np.array([s["stop"] for s in spans], np.int64)) if spans else []

    def run(batches):
        for b in batches:
            for first, texts in _pieces(b.column(1), b.num_rows):
                out = [[], [], [], [], []]
                for t, spans, passages in zip(texts, *(b.column(k).slice(first, len(texts)).to_pylist() for k in (2, 3)), strict=True):
                    t = t or b""
                    gone = merged(spans)
                    h, last = hashlib.sha256(), 0
                    for x, y in gone:
                        h.update(t[last:x])
                        last = y
                    h.update(t[last:])
                    inside = sum((y + 1) // 2 - x // 2 for x, y in merged(passages))
                    for c, v in zip(out, (len(t), sum(y - x for x, y in gone), [{"start": x, "stop": y} for x, y in gone], h.hexdigest(), inside), strict=True):
                        c.append(v)
                arrays = [pa.array(c, to_arrow_type(f.dataType)) for c, f in zip(out, kind.fields, strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(first, len(texts)), *arrays], names=["doc_id", *kind.names])

    return rows.mapInArrow(run, T.StructType([docs.schema["doc_id"], *kind.fields]))


def op3_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    out = cut_repeats(cells(table(spark, sf_dir, "documents")))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256", "n_passage_words")
