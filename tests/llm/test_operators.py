import hashlib
import io
import os
import random
import re
import sys
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(__file__)))
from oracle import same  # noqa: E402

from tickweave.llm import chat, decontam, exact_dedup, induced, licenses, pieces, quality, queries, simhash, substrings, token_ids, warc  # noqa: E402
from tickweave.llm.common import cells  # noqa: E402
from tickweave.plans.session import fresh_path, saved  # noqa: E402

D = "/root/testdata/sf0.001"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def texts():
    return duckdb.connect().execute(f"select doc_id, coalesce(text, '') from '{D}/documents.parquet' order by 1").fetchall()


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns whose names clash."""
    rows = [(None, "a b c"), (1, None), (2, ""), (3, "same text here"), (3, "same text here"), (4, "same  text\there"), (5, "word " * 60_000), (6, "▁ \x00 ﬁ é 日本"), (7, " lead  and trail ")]
    return spark.createDataFrame([(i, t, "x", 1.0, 2) for i, t in rows], "doc_id long, text string, hits string, score double, keep_id int")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, name):
    same(queries.QUERIES[name](spark, D), queries.ORACLE_SQL[name], D)


def test_induced_arrays():
    rnd = random.Random(3)
    for _ in range(60):
        k = rnd.choice([1, 2, 5])
        strings = [bytes(rnd.choice(range(97, 97 + k)) for _ in range(rnd.randint(0, 40))) for _ in range(rnd.randint(1, 6))]
        text, _, buckets = induced.suffix_buckets(strings, 10**4)
        parts, t = list(buckets)[::-1], text.tolist()
        order, common = np.concatenate([p for p, _ in parts]).tolist(), np.concatenate([c for _, c in parts]).tolist()
        assert order == sorted(range(len(t)), key=lambda i: t[i:])
        for r in range(1, len(order)):
            a, b, n = t[order[r - 1] :], t[order[r] :], 0
            while n < min(len(a), len(b)) and a[n] == b[n]:
                n += 1
            assert common[r] == n


@pytest.mark.parametrize("rows", [4096, 1])
def test_substrings(spark, rows):
    docs, seen = [(i, t.encode()) for i, t in texts()], defaultdict(list)
    for k, (_, t) in enumerate(docs):
        for a in range(len(t) - 399):
            seen[t[a : a + 400]].append((k, a))
    cover = [bytearray(len(t)) for _, t in docs]
    for places in seen.values():
        for k, a in places if len(places) > 1 else ():
            cover[k][a : a + 400] = b"\1" * 400
    want = [(i, len(t), sum(c), hashlib.sha256(bytes(x for x, y in zip(t, c, strict=True) if not y)).hexdigest()) for (i, t), c in zip(docs, cover, strict=True)]
    got = substrings.cut_repeats(cells(spark.read.parquet(f"{D}/documents.parquet")), anchor_rows=rows).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.kept_sha256) for r in got) == want


def test_simhash(spark):
    docs = texts()
    fps = np.array([simhash.fingerprint(t.encode()) for _, t in docs], np.int64).view(np.uint64)
    u, v = np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None]) <= 3)
    label = simhash.components_of(len(fps), u, v)
    got = {r.doc_id: r.component_id for r in simhash.op7_simhash(spark, D).collect()}
    assert got == {docs[i][0]: docs[label[i]][0] for i in range(len(docs))}


def test_quality(spark):
    got = {r.doc_id: r for r in quality.op4_quality_classifier(spark, "/root/testdata/sf0.01").collect()}
    labels = duckdb.connect().execute("select doc_id, quality from '/root/testdata/sf0.01/labels.parquet'").fetchall()
    held = [(got[i].predicted, q) for i, q in labels if got[i].held_out]
    assert sum(p == q for p, q in held) >= 0.95 * len(held)
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in got)


def test_pieces():
    lattice = pieces.Lattice(pieces.default_model())
    rnd = random.Random(1)

    def brute(s, n):
        into, paths = lattice.edges(s), {0: [0.0]}
        for j in range(1, len(s) + 1):
            paths[j] = sorted((a + w for i, w, _ in into[j] for a in paths[i]), reverse=True)
        return [round(x, 9) for x in paths[len(s)][:n]]

    enc = pieces.Encoder(pieces.default_model())
    for _ in range(150):
        s = " " + "".join(rnd.choice("the an$.éß▁ 日") for _ in range(rnd.randint(1, 9)))
        assert [round(x, 9) for x, _ in lattice.n_best(s, 4)] == brute(s, 4)
        ids, best = enc.encode(s[1:], 4)
        assert [round(x, 9) for x, _ in best] == brute(s, 4) and lattice.decode(ids).decode() == s[1:]


def test_token_ids(spark):
    from tokenizers import Tokenizer

    lib, start = Tokenizer.from_file(token_ids.default_vocabulary()), 0
    got = sorted(token_ids.op9_token_ids(spark, D).collect())
    for r, (i, t) in zip(got, texts(), strict=True):
        ids = [*lib.encode(t, add_special_tokens=False).ids, 2]
        assert tuple(r) == (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_licenses(spark):
    got = {r.doc_id: r for r in licenses.op10_license_scans(spark, D).collect()}
    for i, t in texts():
        w = WORD.findall(t.translate(LOW))
        places = sorted((k, x) for k in range(len(w)) for p, x in licenses.BASE.items() if w[k : k + len(p.split())] == p.split())
        assert (len(w), len(places), ",".join(sorted({x for _, x in places}))) == (got[i].n_words, got[i].n_base, got[i].base_labels)
    scan = licenses.Scanner().scan(decontam.words_of(b"GNU General Public License version 3 or later"))
    assert [x[2] for x in scan[1]] == ["gpl-3-or-later"]


def test_odd_rows(spark, odd):
    for docs, n in ((odd, 9), (odd.limit(0), 0)):
        bench = spark.createDataFrame([(1, "same text here"), (None, None), (2, "")], "item_id long, text string")
        hits = decontam.find_contamination(docs, bench).collect()
        assert len(hits) == n and sum(bool(r["hits_"].spans) for r in hits) == (3 if n else 0)
        assert exact_dedup.drop_copies(docs).count() == (7 if n else 0)  # 1 stays for 1 and 2; both rows 3 for 3 and 4
        assert simhash.near_groups(cells(docs)).count() == n
        assert substrings.cut_repeats(cells(docs)).count() == n
        assert all(r.pieces.exact for r in pieces.encode_pieces(docs).collect())
        labels = spark.createDataFrame([(3, 1), (5, 0)], "doc_id long, quality int")
        assert all(0 <= r.quality.score <= 1 for r in quality.classify(docs, cells(docs), labels).collect())
        assert licenses.scan_licenses(docs).count() == n
        path = fresh_path(spark, "odd")
        token_ids.write_tokens(cells(docs), path)
        if n:
            rows = sorted(token_ids.checksums(token_ids.read_tokens(spark, path)).collect(), key=lambda r: r.start)
            assert [r.doc_id for r in rows] == [None, 1, 2, 3, 3, 4, 5, 6, 7]
            assert token_ids.read_tokens(spark, path, [5]).count() == 1


def test_odd_pages_and_turns(spark):
    pages = spark.createDataFrame([(0, "a", None), (1, None, None), (2, "b b", "x"), (3, "c", "x"), (None, None, "q")], "page_id long, url string, html string")
    path = fresh_path(spark, "odd-pages")
    got = {r.page_id: r for r in warc.read_archives(saved(warc.convert(pages, path), "m"), path).collect()}
    assert {k: (r.record_type, r.refers_to) for k, r in got.items()} == {0: ("revisit", 1), 1: ("response", None), 2: ("revisit", 3), 3: ("response", None), None: ("response", None)}
    with pytest.raises(ValueError):
        list(warc.read_arc(io.BytesIO(warc.arc_header(1, "f") + b"u 0.0.0.0 20000101000000 text/html 99\nshort\n")))
    turns = spark.createDataFrame([(1, "chosen", 0, "user", "q"), (1, "rejected", 0, "user", "q"), (1, "chosen", 1, "assistant", "a"), (1, "rejected", 1, "assistant", None), (None, "chosen", 0, "user", "x"), (2, "chosen", None, None, "y")], "pair_id long, side string, turn int, role string, text string")
    rows = chat.format_preferences(turns).orderBy("pair_id", "turn", "part").collect()
    assert [(r.pair_id, r.part, r.turn, r.loss) for r in rows] == [(1, "prompt", 0, 0), (1, "chosen", 1, 1), (1, "rejected", 1, 1), (2, "chosen", -1, 0)]


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{D}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = saved(stage(spark, docs, D), "stage")
        assert left.columns == docs.columns and left.join(docs, "doc_id", "left_anti").count() == 0
        docs = left
    words = docs.select(F.col("doc_id"), F.col("text")).collect()
    assert len({re.sub(r"[ \t-\r]+", " ", r.text) for r in words}) == len(words)
    assert not decontam.find_contamination(docs, spark.read.parquet(f"{D}/benchmark.parquet")).filter(F.size("hits.spans") > 0).count()
    assert corpus_pipeline.run(spark, D).filter("exact").count() == len(words)
