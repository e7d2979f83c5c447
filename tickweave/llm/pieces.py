"""SentencePiece encoding and decoding with N-best segmentation."""

from __future__ import annotations

import heapq
import re
import zlib
from array import array
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tickweave.llm.common import annotate, cells, free_name
from tickweave.plans.session import table

#: A space inside the lattice, as the pieces write it.
SPACE = "▁"
_CHUNKS = re.compile(r" *[^ ]+| +\Z")
#: What one byte that no piece covers costs beyond the rarest piece.
BYTE_PENALTY = 10.0
N_BEST = 4


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _among(keys: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether the sorted keys hold each x, and where."""
    at = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
    return keys[at] == x, at


class Lattice:
    """Scores, lattice and searches over a model's pieces.

    The public model is a merge table: its scores are merge ranks. As log-probabilities the lattice takes
    Zipf's law over those ranks, so earlier (commoner) pieces cost less. Characters without a piece are the byte pieces of
    their UTF-8, and so is the character U+2581 itself, which the pieces use for a space; decoding is exact.
    """

    def __init__(self, model: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        size = sp.get_piece_size()
        plain = [i for i in range(size) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        norm = float(np.log((1 / (np.arange(len(plain)) + 10.0)).sum()))
        self.score = {i: -float(np.log(r + 10.0)) - norm for r, i in enumerate(plain)}
        self.byte = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(size) if sp.is_byte(i)}
        self.byte_score = min(self.score.values()) - BYTE_PENALTY
        names = {sp.id_to_piece(i): i for i in plain}
        #: piece or beginning of one -> id, or -1
        self.table = {p[:n]: -1 for p in names for n in range(1, len(p))} | names
        #: pairs of characters that some piece holds; between any others every segmentation has a boundary
        self.pairs = {p[i : i + 2] for p in names for i in range(len(p) - 1)}
        self.bytes_of = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.decode([i]).encode() if i not in self.score else sp.id_to_piece(i).replace(SPACE, " ").encode() for i in range(size)]
        self.bytes_of.append("\ufffd".encode())  # what an id that the model hasn't decodes to
        self.size = size
        self.scores = [self.score.get(i, 0.0) for i in range(size)]
        self.lengths = np.array([len(b) for b in self.bytes_of], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self._arrays()

    def _arrays(self) -> None:
        """The table as arrays: a step from a beginning (0 is the empty one) by a character, and the pairs."""
        node = {"": 0} | {p: k for k, p in enumerate(self.table, 1)}
        steps = np.array([node[p[:-1]] << 21 | ord(p[-1]) for p in self.table], np.int64)
        order = np.argsort(steps)
        self.steps, self.next = steps[order], (order + 1).astype(np.int64)
        self.piece_at = np.array([-1, *self.table.values()], np.int32)
        self.pair_keys = np.sort(np.array([ord(a) << 21 | ord(b) for a, b in self.pairs], np.int64))
        self.score_at = np.array(self.scores)
        self.byte_at = np.array([self.byte[b] for b in range(256)], np.int32)

    def edges(self, s: str) -> list[list[tuple[int, float, tuple[int, ...]]]]:
        """For each place, the pieces that end there: (start, score, ids). A space is ' ' in s."""
        n, get, score = len(s), self.table.get, self.score
        t = s.replace(SPACE, "￾").replace(" ", SPACE)  # U+FFFE: no piece has it, so U+2581 goes by bytes
        into: list[list] = [[] for _ in range(n + 1)]
        for i in range(n):
            alone = True
            for j in range(i + 1, n + 1):
                x = get(t[i:j])
                if x is None:
                    break
                if x >= 0:
                    into[j].append((i, score[x], (x,)))
                    alone = alone and j > i + 1
            if alone:
                raw = s[i].encode("utf-8", "surrogatepass")
                into[i + 1].append((i, self.byte_score * len(raw), tuple(self.byte[b] for b in raw)))
        return into

    def n_best(self, s: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The n best segmentations: forward Viterbi scores, then A* from the end with them as exact heuristics."""
        into = self.edges(s)
        best = [0.0] * len(into)
        for j in range(1, len(into)):
            best[j] = max(best[i] + w for i, w, _ in into[j])
        tie, out = count(), []
        heap = [(-best[-1], next(tie), len(s), 0.0, None)]
        while heap and len(out) < n:
            _, _, at, g, tail = heapq.heappop(heap)
            while at and len(into[at]) == 1:  # a single way on costs no queue
                i, w, ids = into[at][0]
                at, g, tail = i, g + w, (ids, tail)
            if not at:
                ids = []
                while tail:
                    ids += tail[0]
                    tail = tail[1]
                out.append((g, tuple(ids)))
                continue
            for i, w, ids in into[at]:
                heapq.heappush(heap, (-(best[i] + w + g), next(tie), i, g + w, (ids, tail)))
        return out

    def best_of(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids of the best segmentations, where each chunk's end, their scores, how much each second best loses).

        A forward Viterbi pass over all chunks at once, cut into units that no piece can cross, from place to place in them.
        The Viterbi scores are exact, so what A* would queue along the best path has its final score when it is
        queued: the head of the queue is the second best.
        """
        raw = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        total = len(raw)
        chars = np.where(raw == ord(SPACE), 0xFFFE, np.where(raw == 32, ord(SPACE), raw))  # as in edges
        ends = np.cumsum(np.array([len(c) for c in chunks], np.int64))
        fresh = ~_among(self.pair_keys, np.concatenate([[0], chars[:-1] << 21 | chars[1:]]))[0]
        fresh[np.append(0, ends[:-1])] = True
        begins = np.flatnonzero(fresh)
        stops = np.append(begins[1:], total)
        unit = np.cumsum(fresh) - 1
        # edges (start, length, piece or -1 for the bytes of a character)
        live, node, edges, k = np.arange(total), np.zeros(total, np.int64), [], 0
        while len(live):
            found, at = _among(self.steps, node << 21 | chars[live + k])
            if k == 0:
                bare = np.ones(total, bool)
                bare[live[found]] = self.piece_at[self.next[at[found]]] < 0
                bare = np.flatnonzero(bare)
                edges.append((bare, np.ones(len(bare), np.int64), np.full(len(bare), -1, np.int32)))
            live, node = live[found], self.next[at[found]]
            piece = self.piece_at[node]
            some = piece >= 0
            k += 1
            edges.append((live[some], np.full(int(some.sum()), k), piece[some]))
            inside = live + k < stops[unit[live]]
            live, node = live[inside], node[inside]
        start, length, piece = (np.concatenate(x) for x in zip(*edges, strict=True))
        width = 1 + (raw >= 0x80) + (raw >= 0x800) + (raw >= 0x10000)
        weight = np.where(piece >= 0, self.score_at[piece], self.byte_score * width[start])
        place = start - begins[unit[start]]
        order = np.argsort(place.astype(np.uint16) if len(place) and place.max() < 1 << 16 else place, kind="stable")  # narrow ones are sorted by radix
        place, source, piece, weight = place[order], (start + unit[start])[order], piece[order], weight[order]
        target = source + length[order]
        # each unit has a place more than characters; edges from one place of all units never share a target
        best, second = np.full(total + len(begins), -1e300), np.full(total + len(begins), -1e300)
        back, by = np.zeros(len(best), np.int64), np.full(len(best), -1, np.int32)
        first = begins + np.arange(len(begins))
        best[first] = 0.0
        cuts = np.append(np.flatnonzero(np.diff(place, prepend=-1)), len(place))
        for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            j, v = target[x:y], best[source[x:y]] + weight[x:y]
            was = best[j]
            better = v > was
            second[j] = np.where(better, was, np.maximum(second[j], v))
            best[j] = np.maximum(was, v)
            up = j[better]
            back[up], by[up] = source[x:y][better], piece[x:y][better]
        on, j, here = np.zeros(len(best), bool), stops + np.arange(len(begins)), first
        while len(j):
            on[j] = True
            j = back[j]
            going = j > here
            j, here = j[going], here[going]
        on = np.flatnonzero(on)
        which = np.searchsorted(first, on, "right") - 1
        spot = on - which - 1  # the last character of each piece
        ids = by[on]
        many = np.where(ids < 0, width[spot], 1)
        until = np.cumsum(many)
        out = np.repeat(ids, many)
        lone = np.flatnonzero(ids < 0)
        code, w, at = raw[spot[lone]], width[spot[lone]], (until - many)[lone]
        lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])[w]
        for i in range(4):
            has = w > i
            value = (code >> (6 * (w - 1 - i)).clip(0)) & np.where(w == 1, 0x7F, 0x3F)
            out[(at + i)[has]] = self.byte_at[(value | (lead if i == 0 else np.where(w > 1, 0x80, 0)))[has]]
        chunk_of = np.searchsorted(ends, spot, "right")
        firsts = np.searchsorted(chunk_of, np.arange(len(chunks)))
        gaps = np.minimum.reduceat(best[on] - second[on], firsts)
        unit_first = np.searchsorted(begins, np.append(0, ends[:-1]))
        scores = np.add.reduceat(best[stops + np.arange(len(begins))], unit_first)
        return out, until[np.append(firsts[1:], len(on)) - 1], scores, np.where(gaps > 1e290, np.inf, gaps)

    def units(self, chunk: str) -> list[str]:
        """The chunk cut wherever no piece can cross: its segmentations are those of its units, independently."""
        t, pairs, out, a = chunk.replace(SPACE, "￾").replace(" ", SPACE), self.pairs, [], 0
        for i in range(1, len(t)):
            if t[i - 1 : i + 1] not in pairs:
                out.append(chunk[a:i])
                a = i
        out.append(chunk[a:])
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        n = self.lengths[ids]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        out = self.flat[np.repeat(self.starts[ids] - (ends - n), n) + np.arange(total)].tobytes()
        return out[1:] if out[:1] == b" " and int(ids[0]) in self.score else out  # without the space put first


class Encoder:
    """Encodes texts by their chunks (spaces and what follows), each distinct one segmented once.

    No piece goes from a chunk into the next, so a text's best segmentation is its chunks' best, and its N best differ from that in at
    most N - 1 chunks, those whose second best is nearest. The caches start anew at `most` entries.
    """

    def __init__(self, model: str, most: int = 300_000):
        self.lattice, self.most = Lattice(model), most
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.flat, self.offsets, self.scores, self.gaps = array("i"), array("q", [0]), array("d"), array("d")
        self.names: list[str] = []
        self.lists: dict[int, list] = {}

    def learn(self, texts: list[list[str]], at_once: int = 1 << 17) -> None:
        """Segment the chunks that are new, about `at_once` characters at a time."""
        new: set[str] = set()
        for chunks in texts:
            new.update(chunks)
        new.difference_update(self.index)
        held, size = [], 0
        for c in sorted(new):
            held.append(c)
            size += len(c) + 1
            if size >= at_once:
                self._learn(held)
                held, size = [], 0
        if held:
            self._learn(held)

    def _learn(self, chunks: list[str]) -> None:
        ids, ends, scores, gaps = self.lattice.best_of([" " + c for c in chunks])
        base = len(self.flat)
        for kept, values in ((self.flat, ids.astype(np.int32)), (self.offsets, ends + base), (self.scores, scores), (self.gaps, gaps)):
            kept.frombytes(values.tobytes())
        self.index.update(zip(chunks, range(len(self.names), len(self.names) + len(chunks))))
        self.names += chunks

    def _alternatives(self, i: int, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """(loss, ids) of the n best of chunk i."""
        if i not in self.lists:
            out = [(0.0, ())]
            for u in self.lattice.units(" " + self.names[i]):
                found = self.lattice.n_best(u, n)
                out = sorted(((a + found[0][0] - s, b + ids) for a, b in out for s, ids in found), key=lambda x: x[0])[:n]
            self.lists[i] = out
        return self.lists[i]

    @staticmethod
    def chunks(text: str) -> list[str]:
        """Chunks, without the one space that each begins with (the first by rule)."""
        if not text:
            return []
        words = text.split(" ")
        return words if "" not in words else [c[1:] for c in _CHUNKS.findall(" " + text)]

    def encode_all(self, texts: list[str], n: int):
        """encode() of each, the new chunks of all of them segmented together."""
        parts = [self.chunks(t) for t in texts]
        if len(self.index) > self.most:
            self.clear()
        self.learn(parts)
        return [self._encode(p, n) for p in parts]

    def encode(self, text: str, n: int) -> tuple[np.ndarray, list[tuple[float, list[tuple[int, int, tuple[int, ...]]]]]]:
        """Ids of the best segmentation, and the n best as (score, [(start, stop, ids that replace the best's from start to stop), ...])."""
        return self.encode_all([text], n)[0]

    def _encode(self, chunks: list[str], n: int):
        at = np.array(list(map(self.index.__getitem__, chunks)), dtype=np.int64)
        if not len(at):
            return np.zeros(0, np.int32), [(0.0, [])]
        flat, offsets = np.frombuffer(self.flat, np.int32), np.frombuffer(self.offsets, np.int64)
        lengths = (offsets[1:] - offsets[:-1])[at] if len(at) > len(offsets) // 4 else offsets[at + 1] - offsets[at]
        ends = np.cumsum(lengths)
        ids = flat[np.repeat(offsets[at] - (ends - lengths), lengths) + np.arange(int(ends[-1]))]
        score = float(np.frombuffer(self.scores, np.float64)[at].sum())
        gaps = np.frombuffer(self.gaps, np.float64)[at]
        m = min(n - 1, len(at))
        if m < len(at) and m:
            edge = np.partition(gaps, m - 1)[m - 1]
            below, equal = np.flatnonzero(gaps < edge), np.flatnonzero(gaps == edge)
            near = np.sort(np.concatenate([below, equal[: m - len(below)]]))
        else:
            near = np.arange(m)
        out: list[tuple[float, list]] = [(0.0, [])]
        for c in near.tolist():
            lists = self._alternatives(int(at[c]), n)
            stop = int(ends[c])
            here = (stop - int(lengths[c]), stop)
            out = sorted(((a + loss, b + ([(*here, x)] if k else [])) for a, b in out for k, (loss, x) in enumerate(lists)), key=lambda x: x[0])[:n]
        return ids, [(score - loss, changes) for loss, changes in out]


_CACHE: dict[str, Encoder] = {}


def encoder(model: str) -> Encoder:
    """One a worker process, kept between its tasks."""
    if model not in _CACHE:
        _CACHE[model] = Encoder(model)
    return _CACHE[model]


def segmentation(ids: np.ndarray, changes: list) -> np.ndarray:
    """One of the n best as a whole: the best's ids with the changes (start, stop, ids; ascending) put in."""
    parts, last = [], 0
    for start, stop, new in changes:
        parts += [ids[last:start], np.array(new, ids.dtype)]
        last = stop
    return np.concatenate([*parts, ids[last:]])


_CHANGE = T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))])
KIND = T.StructType([
    T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("exact", T.BooleanType()),
    T.StructField("n_best", T.ArrayType(T.StructType([T.StructField("score", T.DoubleType()), T.StructField("changes", T.ArrayType(_CHANGE))]))),
])


def encode_pieces(docs: DataFrame, model: str | None = None, n: int = N_BEST, text: str = "text", into: str = "pieces") -> DataFrame:
    """docs with a struct: ids (best segmentation), exact (decoding gives the text back), n_best (score, and changes: the ids that
    replace the best's from start to stop; segmentation() puts them in, so that all n are there without n copies of what they share).

    A map over rows: whole texts, no row moves, memory bounded by the caches' size and one long text. Null and
    empty texts have no pieces, one segmentation of score 0, and decode to the empty text; a text with fewer than
    n segmentations has fewer; ties go to the earlier chunk; repeated rows get equal results. Bytes that are no UTF-8 count as U+FFFD, so
    such a text doesn't come back exactly.
    """
    model = model or default_model()
    kinds = {f.name: to_arrow_type(f.dataType) for f in KIND.fields}

    def make():
        from tickweave.llm.pieces import encoder

        enc = encoder(model)

        def run(texts):
            ids, exact, best = [], [], []
            for t, (got, nbest) in zip(texts, enc.encode_all([(t or b"").decode("utf-8", "replace") for t in texts], n), strict=True):
                ids.append(got)
                exact.append(enc.lattice.decode(got) == (t or b""))
                best.append([{"score": s, "changes": [{"start": a, "stop": b, "ids": list(x)} for a, b, x in ch]} for s, ch in nbest])
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32), pa.int32()))
            return [lists.cast(kinds["ids"]), exact, best]

        return run

    return annotate(docs, free_name(docs, into), KIND, make, text, limit=4 << 20)


def decode_pieces(rows: DataFrame, ids: str = "ids", into: str = "decoded", model: str | None = None) -> DataFrame:
    """rows with the text of their piece ids, as the library decodes them, and without the space that encoding puts first.

    Null ids decode to null, no ids to the empty text. A null id, one that the model hasn't, and bytes that are no whole UTF-8
    character decode to U+FFFD; control pieces to nothing.
    """
    model = model or default_model()
    at, name = rows.columns.index(ids), free_name(rows, into)

    def run(batches):
        from tickweave.llm.pieces import encoder

        lattice = encoder(model).lattice

        def text(x):
            held = np.array([-1 if i is None else i for i in x], np.int64)
            return lattice.decode(np.where((held < 0) | (held >= lattice.size), lattice.size, held)).decode("utf-8", "replace")

        for b in batches:
            texts = [None if x is None else text(x) for x in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=[*b.schema.names, name])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(name, T.StringType())]))


def summarise(rows: DataFrame, *keep: str) -> DataFrame:
    """keep, n_pieces, ids_crc32 (of the ids as little-endian 32-bit integers), score, n_best_scores, n_best_crc32 (of each of the n best segmentations as a whole), exact."""
    extra = [f for f in rows.schema.fields if f.name in keep]
    longs, doubles = T.ArrayType(T.LongType()), T.ArrayType(T.DoubleType())
    kind = T.StructType([*extra, *(T.StructField(n, t) for n, t in (("n_pieces", T.LongType()), ("ids_crc32", T.LongType()), ("score", T.DoubleType()), ("n_best_scores", doubles), ("n_best_crc32", longs), ("exact", T.BooleanType())))])
    m = len(extra)

    def run(batches):
        for b in batches:
            lists = b.column(m)
            values, offsets = np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), dtype="<u4"), lists.offsets.to_numpy()
            scores, crcs = [], []
            for x, y, best in zip(offsets[:-1].tolist(), offsets[1:].tolist(), b.column(m + 1).to_pylist(), strict=True):
                own = values[x:y]
                scores.append([s["score"] for s in best])
                crcs.append([zlib.crc32(segmentation(own, [c.values() for c in s["changes"]]) if s["changes"] else own) for s in best])
            arrays = [np.diff(offsets).astype(np.int64), [c[0] for c in crcs], [s[0] for s in scores], scores, crcs]
            arrays = [pa.array(a, to_arrow_type(f.dataType)) for a, f in zip(arrays, kind.fields[m:], strict=False)]
            yield pa.RecordBatch.from_arrays([*b.columns[:m], *arrays, b.column(m + 2)], names=kind.names)

    return rows.select(*(f.name for f in extra), "pieces.ids", "pieces.n_best", "pieces.exact").mapInArrow(run, kind)


def op2_sentencepiece(spark, sf_dir: str) -> DataFrame:
    return summarise(encode_pieces(cells(table(spark, sf_dir, "documents"))), "doc_id")
