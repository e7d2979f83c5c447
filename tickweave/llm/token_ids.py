"""Token ids as ORC: ascending documents, run-length integers, row indexes, Bloom filters on document ids."""

from __future__ import annotations

import os
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.llm.common import cells, row_salt
from tickweave.plans.session import fresh_path, ship, shuffle_parts, table

#: A line that is a word of Latin letters and then ASCII marks, without ' and <: two tokenizer words that nothing joins. Other lines give no word.
_SIMPLE = re.compile(r"^(?:([a-zà-öø-ÿ]+)([!\"#$%&()*+,\-./:;=>?@\[\\\]^_`{|}~]*)|.+)$", re.MULTILINE)


def _gather(flat: np.ndarray, starts: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of flat that begin at starts and have n items, one after the other, and where each ends."""
    ends = np.cumsum(n)
    return flat[np.repeat(starts - (ends - n), n) + np.arange(int(ends[-1]) if len(ends) else 0)], ends


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class ChunkEncoder:
    """Ids of texts by the tokenizers library, which sees each distinct piece once.

    Valid for a vocabulary that lower-cases, drops white space and never joins across it (word_bpe_49k): the ids
    of a text are those of its white-space separated chunks in order. A chunk of Latin letters and marks is
    taken apart once more. The caches start anew at `most` chunks and twice as many words, so memory is bounded.
    """

    def __init__(self, vocabulary: str, most: int = 300_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(vocabulary)
        size = self.lib.get_vocab_size()
        self.ends = np.array([(self.lib.id_to_token(i) or "").endswith("</w>") for i in range(size)])
        self.most = most
        self.forget_words()
        self.forget_chunks()

    def forget_words(self) -> None:
        self.words = {"": 0}
        self.word_flat, self.word_offsets = array("i"), array("q", [0, 0])

    def forget_chunks(self) -> None:
        outer = self

        class Index(dict):
            def __missing__(self, chunk):
                i = self[chunk] = len(self)
                outer.new.append(chunk)
                return i

        self.new: list[bytes] = []
        self.index = Index()
        self.flat, self.offsets = array("i"), array("q", [0])

    def _learn_words(self, words: list[str]) -> None:
        for at in range(0, len(words), 2000):
            part = words[at : at + 2000]
            ids = np.array(self.lib.encode(" ".join(part), add_special_tokens=False).ids, dtype=np.int32)
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(part):
                each = [self.lib.encode(w, add_special_tokens=False).ids for w in part]
                ids, stops = np.array([i for e in each for i in e], dtype=np.int32), np.cumsum([len(e) for e in each])
            self.words.update(zip(part, range(len(self.words), len(self.words) + len(part)), strict=True))
            self.word_offsets.frombytes((len(self.word_flat) + stops).astype(np.int64).tobytes())
            self.word_flat.frombytes(ids.tobytes())

    def _learn(self) -> None:
        """Append the ids of new chunks, put together from those of their words."""
        if not self.new:
            return
        joined, self.new = b"\n".join(self.new).decode("utf-8", "replace"), []
        firsts, seconds = zip(*_SIMPLE.findall(joined.lower()), strict=True)
        chunks = joined.split("\n")
        self._learn_words(list(set(firsts).union(seconds).difference(self.words)))
        units = np.empty((len(chunks), 2), np.int64)
        units[:, 0] = np.fromiter(map(self.words.__getitem__, firsts), np.int64, len(chunks))
        units[:, 1] = np.fromiter(map(self.words.__getitem__, seconds), np.int64, len(chunks))
        odd = np.flatnonzero(units[:, 0] == 0)
        whole = [e.ids for e in self.lib.encode_batch([chunks[i] for i in odd.tolist()], add_special_tokens=False)]
        # an odd chunk is one more unit, after the known words
        lengths = np.concatenate([np.diff(np.frombuffer(self.word_offsets, np.int64)), np.array([len(w) for w in whole], np.int64)])
        units[odd, 0] = len(self.words) + np.arange(len(odd))
        flat = np.concatenate([np.array(self.word_flat, np.int32), np.array([i for w in whole for i in w], np.int32)])
        starts = np.cumsum(lengths) - lengths
        ids, ends = _gather(flat, starts[units.ravel()], lengths[units.ravel()])
        self.offsets.frombytes((len(self.flat) + ends[1::2]).tobytes())
        self.flat.frombytes(ids.tobytes())

    def encode(self, texts: list[bytes | None], end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Offsets (one more than texts) and all ids, each text's closed by `end`."""
        if len(self.words) > 2 * self.most:
            self.forget_words()
        if len(self.index) > self.most:
            self.forget_chunks()
        get = self.index.__getitem__
        split = (t.split() if t else [] for t in texts)
        seen = [np.fromiter(map(get, s), np.int64, len(s)) for s in split]
        self._learn()
        flat, offsets = np.frombuffer(self.flat, np.int32) if len(self.flat) else np.zeros(0, np.int32), np.frombuffer(self.offsets, np.int64)
        extra = int(end is not None)
        # the end id is one more unit, of length 1, after the flat ids
        unit = len(offsets) - 1
        starts = np.append(offsets[:-1], len(flat))
        lengths = np.append(np.diff(offsets), 1)
        flat = np.append(flat, np.int32(end or 0))
        parts = [np.append(s, unit) for s in seen] if extra else seen
        units = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        ids, ends = _gather(flat, starts[units], lengths[units])
        unit_ends = np.concatenate([[0], ends])
        return unit_ends[np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)], ids


_CACHE: dict[str, ChunkEncoder] = {}


def encoder(vocabulary: str) -> ChunkEncoder:
    """One a worker process, kept between its tasks."""
    if vocabulary not in _CACHE:
        _CACHE[vocabulary] = ChunkEncoder(vocabulary)
    return _CACHE[vocabulary]


def write_tokens(docs: DataFrame, path: str, vocabulary: str | None = None, end: int = 2, stripe_bytes: int = 16 << 20) -> None:
    """Write doc_id, first (ids before it in its file), n_tokens, ids as ORC files that ascend in doc_id.

    docs: doc_id, text. The texts are dealt out by ranges of doc_id, so each file is one task's and its rows
    ascend; nulls come first, rows of one doc_id in the order of docs, in several files if they are many. Null and empty texts have the end
    id only; an empty table gives files without rows.
    """
    vocabulary = vocabulary or default_vocabulary()
    ship(docs.sparkSession)
    parts = shuffle_parts(docs.sparkSession)
    by = [F.col("doc_id").asc_nulls_first(), F.col("_row").asc()]
    ranged = docs.withColumn("_row", row_salt()).repartitionByRange(parts, *by).sortWithinPartitions(*by).drop("_row")
    kind = "doc_id " + dict(docs.dtypes)["doc_id"] + ", first long, n_tokens int, ids array<int>"

    def run(batches):
        from tickweave.llm.token_ids import encoder

        enc, before = encoder(vocabulary), 0
        for b in batches:
            step = max(1, int(b.num_rows * (4 << 20) / max(b.nbytes, 1)))
            for at in range(0, b.num_rows, step):
                piece = b.slice(at, step)
                offsets, ids = enc.encode(piece.column(1).cast(pa.binary()).to_pylist(), end)
                n = np.diff(offsets)
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(before + offsets[:-1]), pa.array(n.astype(np.int32)), lists], names=["doc_id", "first", "n_tokens", "ids"])
                before += int(offsets[-1])

    (
        ranged.mapInArrow(run, kind).write.option("orc.create.index", "true").option("orc.row.index.stride", 1000)
        .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", 0.01).option("orc.stripe.size", stripe_bytes).option("orc.compress", "ZSTD").orc(path)
    )


def read_tokens(spark, path: str, ids: list | None = None) -> DataFrame:
    """The files' rows with `start`, the ids of all documents before; only some doc_ids, if given, by index and Bloom filter.

    Rows come as they were written: null doc_ids and repeated ones too; `ids` finds no null. Files without rows give none.
    """
    rows = spark.read.orc(path).withColumn("_file", F.col("_metadata.file_name"))
    # a row for each file, of which there are as many as write tasks
    totals = sorted((r[0], r[1]) for r in rows.groupBy("_file").agg(F.max(F.col("first") + F.col("n_tokens"))).collect())
    before = np.concatenate([[0], np.cumsum([n for _, n in totals])]) if totals else [0]
    offsets = spark.createDataFrame([(f, int(b)) for (f, _), b in zip(totals, before, strict=False)] or [("", 0)], "_file string, _before long")
    if ids is not None:
        rows = rows.filter(F.col("doc_id").isin(ids))
    return rows.join(F.broadcast(offsets), "_file").withColumn("start", F.col("_before") + F.col("first")).drop("_file", "_before", "first")


def checksums(rows: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of rows of read_tokens; no ids at all have 0."""
    kind = "doc_id " + dict(rows.dtypes)["doc_id"] + ", start long, n_tokens long, ids_crc32 long"

    def run(batches):
        for b in batches:
            lists = b.column(3)
            values, offsets = np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), dtype="<u4"), lists.offsets.to_numpy()
            crc = [zlib.crc32(values[x:y]) for x, y in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2).cast(pa.int64()), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return rows.select("doc_id", "start", "n_tokens", "ids").mapInArrow(run, kind)


def op9_token_ids(spark, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "op9")
    write_tokens(cells(table(spark, sf_dir, "documents")), path)
    return checksums(read_tokens(spark, path))
