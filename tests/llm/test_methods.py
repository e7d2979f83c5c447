"""The operators' methods against brute force, beyond the shared odd rows."""

import glob
import gzip
import hashlib
import io
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tickweave.llm import chat, decontam, induced, licenses, pieces, quality, simhash, substrings, token_ids, warc
from tickweave.llm.common import cells
from tickweave.plans.session import fresh_path, saved

D = "/root/testdata/sf0.001"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def components(n, linked):
    label = list(range(n))
    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = sorted((label[i], label[j]))
                label = [a if x == b else x for x in label]
    return label


def least(labels):
    """Each label as the first place that has it."""
    first = {}
    return [first.setdefault(x, i) for i, x in enumerate(labels)]


def plain_fingerprint(text):
    w = (text or "").translate(LOW)
    w = [x for x in re.split("[ \t-\r]+", w) if x]
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near(rnd, base, most):
    for b in rnd.sample(range(64), rnd.randint(0, most)):
        base ^= 1 << b
    return base


def test_tiles_and_slices():
    """Several tiles and two slices give the components of all pairs; far tiles are skipped."""
    rnd = random.Random(7)
    seeds = [rnd.getrandbits(64) for _ in range(40)]
    fps = [near(rnd, rnd.choice(seeds), 3) for _ in range(150)] + [rnd.getrandbits(64) & rnd.getrandbits(64) & rnd.getrandbits(64) for _ in range(60)]
    fps = list(dict.fromkeys(fps))
    arr = np.array(fps, np.uint64)
    close = lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 3
    want = components(len(fps), close)
    assert least(simhash.compare_tiles(arr, np.zeros(len(fps), np.int64), 3, tile=16).tolist()) == want
    part = np.array([i % 2 for i in range(len(fps))])
    assert least(simhash.compare_tiles(arr, part, 3, tile=16).tolist()) == components(len(fps), lambda i, j: part[i] != part[j] and close(i, j))


def test_masks_meet_all_pairs():
    rnd = random.Random(3)
    for n in (0, 100, 5000, 10**6, 10**9, 10**12):
        masks = [m % (1 << 64) for m in simhash.masks(n)]
        for _ in range(300):
            a = rnd.getrandbits(64)
            b = near(rnd, a, 3)
            assert any(a & m == b & m for m in masks)


def test_links_over_slices(spark, monkeypatch):
    """Groups that are cut into slices give the same links."""
    rnd = random.Random(9)
    seeds = [rnd.getrandbits(64) for _ in range(30)]
    fps = list({near(rnd, rnd.choice(seeds), 4) for _ in range(400)})
    monkeypatch.setattr(simhash, "GROUP_ROWS", 64)
    df = spark.createDataFrame([(int(np.array([x], np.uint64).view(np.int64)[0]),) for x in fps], "fp long")
    links = simhash.near_links(df, len(fps)).collect()
    signed = {int(np.array([x], np.uint64).view(np.int64)[0]): i for i, x in enumerate(fps)}
    label = simhash.components_of(len(fps), np.array([signed[r.u] for r in links]), np.array([signed[r.v] for r in links])).tolist()
    assert label == components(len(fps), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 3)


def test_simhash_query(spark):
    rows = spark.read.parquet(f"{D}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    fps = [plain_fingerprint(r.text) for r in rows]
    label = components(len(rows), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 3)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.op7_simhash(spark, D).collect()}
    assert got == {r.doc_id: (f"{f:016x}", rows[x].doc_id) for r, f, x in zip(rows, fps, label, strict=True)}


def test_simhash_odd(spark):
    docs = spark.createDataFrame([(4, None), (2, ""), (9, " \t"), (None, "a b c d"), (7, "a b  c D"), (7, "a b  c D"), (8, "word " * 200_000)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.fp == 0, r.component_id) for r in simhash.near_groups(docs).collect()), key=str)
    assert got == sorted([(4, True, 2), (2, True, 2), (9, True, 2), (None, False, 7), (7, False, 7), (7, False, 7), (8, False, 8)], key=str)


def test_votes_by_direct_cosines(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{D}/labels.parquet").filter(~quality.fold(F.col("doc_id")))
    held = {r.doc_id: r.text or "" for r in docs.collect()}
    picked = {}
    for r in labels.collect():
        picked.setdefault(r.doc_id, []).append(r.quality)
    ids = sorted((i for i in picked if i in held), key=str)
    x = np.stack([quality.terms(held[i].encode()) for i in ids]).astype(np.float16)
    y = np.array([float(np.mean(picked[i]) >= 0.5) for i in ids])
    model = quality.fit(x, y)
    place = lambda t: (lambda v: v / max(np.sqrt((v * v).sum()), 1e-9))(((quality.terms(t) - model.mean) * model.weight).astype(np.float64) @ model.axes.astype(np.float64))
    vectors = [place(held[i].encode()) for i in ids]
    got = {r.doc_id: r for r in quality.op4_quality_classifier(spark, D).collect()}
    for i in list(held)[::7]:
        v = place(held[i].encode())
        cos = sorted(((float(v @ u), q) for u, q in zip(vectors, y, strict=True)), reverse=True)[: quality.NEIGHBOURS]
        w = [(max(c, 0) ** 4, q) for c, q in cos]
        score = (sum(a * q for a, q in w) + 0.01 * model.prior) / (sum(a for a, _ in w) + 0.01)
        assert abs(got[i].score - score) < 0.02
        assert got[i].predicted == int(got[i].score >= 0.3)


def test_quality_odd(spark):
    docs = spark.createDataFrame([(1, "good words here"), (2, None), (3, ""), (3, ""), (None, "x"), (5, "lang " * 300_000)], "doc_id long, text string")
    for labels in ([(1, 1), (3, 0), (3, 1), (None, 1), (5, None)], [(1, 1)], []):
        rows = quality.classify(docs, docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
        assert len(rows) == 6 and all(0 <= r.quality.score <= 1 and r.quality.predicted == int(r.quality.score >= 0.3) for r in rows)
        assert len({r.quality.score for r in rows if not r.text}) == 1
        if not labels:
            assert {r.quality.score for r in rows} == {0.5}
    assert quality.classify(docs.limit(0), docs, spark.createDataFrame([(1, 1)], "doc_id long, quality int")).count() == 0
    assert quality.classify(docs.withColumn("quality", F.lit(7)), docs, spark.createDataFrame([(1, 1)], "doc_id long, quality int")).columns == ["doc_id", "text", "quality", "quality_"]


def plain_undisputed(found):
    kept = []
    for a, b, r in sorted(found, key=lambda x: (-x[2].priority, x[0] - x[1], x[0], x[2].label)):
        if not any(a < d and c < b and (c <= a and b <= d or k.priority > r.priority) for c, d, k in kept):
            kept.append((a, b, r))
    return kept


def test_overlaps_of_detections():
    rnd = random.Random(11)
    for _ in range(500):
        found = []
        for _ in range(rnd.randint(0, 25)):
            a = rnd.randint(0, 40)
            found.append((a, a + rnd.randint(1, 12), licenses.Rule(rnd.choice("abc"), b"", b"", rnd.choice((10, 20, 30)), 0.5)))
        key = lambda x: (x[0], x[1], x[2].priority, x[2].label)
        assert sorted(licenses.undisputed(found), key=key) == sorted(plain_undisputed(found), key=key)


def test_license_query(spark):
    """All columns, by plain searches of every rule in every text."""
    word, scanner = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), licenses.Scanner()
    got = {r.doc_id: r for r in licenses.op10_license_scans(spark, D).collect()}
    for r in spark.read.parquet(f"{D}/documents.parquet").collect():
        words = word.findall((r.text or "").translate(LOW))
        line = " " + " ".join(words) + " "
        base = [(line.count(" ", 0, m.start() + 1) - 1, label) for p, label in licenses.BASE.items() for m in re.finditer(f"(?<= ){p}(?= )", line)]
        found = [(m.start(), m.end(), x) for x in scanner.rules for m in re.finditer(f"(?<= )(?:{x.regex.decode()})(?= )", line)]
        kept = plain_undisputed(found)
        best = defaultdict(float)
        for _, _, x in kept:
            best[x.label] = max(best[x.label], x.weight)
        score = 1 - float(np.prod([1 - 0.9 * w for w in best.values()]))
        g = got[r.doc_id]
        assert (g.n_words, g.n_base, g.first_word, g.last_word) == (len(words), len(base), min((w for w, _ in base), default=None), max((w for w, _ in base), default=None))
        assert g.labels == ",".join(sorted({x for _, x in base} | set(best))) and abs(g.score - score) < 1e-9


def test_licenses_odd(spark):
    dense = "gnu general public license version 3 or later mit license apache license version 2.0 copyright 2020 " * 1500
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "MIT-License"), (3, "MIT-License"), (4, dense)], "doc_id long, text string")
    got = [(r.doc_id, len(r.licenses.base), round(r.licenses.score, 3) > 0) for r in licenses.scan_licenses(docs).orderBy("doc_id").collect()]
    assert got == [(1, 0, False), (2, 0, False), (3, 1, True), (3, 1, True), (4, 4500, True)]
    assert licenses.scan_licenses(docs.limit(0)).count() == 0


def test_segmentations(spark):
    """The n best of the query, one by one: each decodes to the text, their scores fall and are those of the pieces, and they differ."""
    lattice = pieces.Lattice(pieces.default_model())
    docs = spark.createDataFrame([(1, "the anan theanthe é"), (2, None), (3, ""), (4, "a  b▁c"), (4, "a  b▁c")], "doc_id long, text string")
    rows = {(r.doc_id, i): r for i, r in enumerate(pieces.encode_pieces(docs).collect())}
    digests = {(r.doc_id, i): r for i, r in enumerate(pieces.summarise(pieces.encode_pieces(docs), "doc_id").collect())}
    for key, r in rows.items():
        text, seen = r.text or "", []
        for best in r.pieces.n_best:
            ids = pieces.segmentation(np.array(r.pieces.ids, np.int32), [tuple(c) for c in best.changes])
            assert lattice.decode(ids).decode() == text
            plain = sum(lattice.score[i] if i in lattice.score else lattice.byte_score for i in ids.tolist())
            assert abs(plain - best.score) < 1e-6
            seen.append((ids.tobytes(), best.score))
        assert len({x for x, _ in seen}) == len(seen) and [s for _, s in seen] == sorted((s for _, s in seen), reverse=True)
        import zlib

        assert digests[key].n_best_crc32 == [zlib.crc32(x) for x, _ in seen] and digests[key].exact


def test_decoding_as_the_library(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    texts = [r.text for r in spark.read.parquet(f"{D}/documents.parquet").limit(60).collect()]
    rows = [(i, sp.encode(t or "")) for i, t in enumerate(texts)] + [(1000, None), (1001, []), (1002, [None, 10**6, -1]), (1003, [0]), (1004, [1, 2]), (1005, sp.encode("𝔘")[:-1])]
    docs = spark.createDataFrame(rows, "i int, ids array<int>").withColumn("decoded", F.lit("clash"))
    got = {r.i: r.decoded_ for r in pieces.decode_pieces(docs).collect()}
    assert all(got[i] == sp.decode(ids) for i, ids in rows[: len(texts)])
    assert [got[i] for i in range(1000, 1005)] == [None, "", "�" * 3, sp.decode([0]), ""] and got[1005].endswith("�")
    own = pieces.encode_pieces(spark.createDataFrame(list(enumerate(texts)), "i int, text string"))
    back = pieces.decode_pieces(own.select("text", "pieces.ids")).collect()
    assert all(r.decoded == (r.text or "") == (sp.decode(r.ids) if r.ids else "") for r in back)
    assert pieces.decode_pieces(docs.limit(0)).count() == 0


def test_benchmark_in_blocks(spark):
    rnd = random.Random(5)
    v = [f"w{i}" for i in range(30)]
    bench = [(i, " ".join(rnd.choice(v) for _ in range(rnd.choice((0, 2, 9, 25))))) for i in range(40)] + [(None, "w1 w2"), (7, None), (3, "w4 w4 w4")]
    docs = [(i, " ".join(rnd.choice([*v, "other"]) for _ in range(rnd.randint(0, 200)))) for i in range(60)]
    docs += [(100, " ".join(t for _, t in bench[:9] if t)), (101, None), (102, "w1 W2"), (102, "w1 W2")]
    windows = defaultdict(set)
    for item, t in bench:
        w = (t or "").split()
        for a in range(len(w) - min(10, len(w)) + 1) if w else ():
            windows[tuple(w[a : a + 10])].add("" if item is None else str(item))
    want = []
    for i, t in docs:
        w, hit, items = (t or "").lower().split(), set(), set()
        for a in range(len(w)):
            for x, names in windows.items():
                if tuple(w[a : a + len(x)]) == x:
                    hit.update(range(a, a + len(x)))
                    items |= names
        want.append((i, len(w), len(hit), sorted(items)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for block in (1 << 20, 200):
        rows = decontam.find_contamination(frame, spark.createDataFrame(bench, "item_id long, text string"), block_bytes=block).collect()
        assert sorted((r.doc_id, r.hits.n_words, sum(s.stop - s.start for s in r.hits.spans), r.hits["items"]) for r in rows) == sorted(want)


def test_queues_go_to_disk(tmp_path, monkeypatch):
    """A text far over the budget: queues and text are files, and the arrays stay right."""
    rnd = random.Random(2)
    strings = [bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, 300))) for _ in range(40)]
    written = []
    write = induced.Buckets._write
    monkeypatch.setattr(induced.Buckets, "_write", lambda self, pair: written.append(1) or write(self, pair))
    text, _, buckets = induced.suffix_buckets(strings, 10**4, budget=2000, folder=str(tmp_path))
    parts = list(buckets)[::-1]
    assert isinstance(text, np.memmap) and len(written) > 20, len(written)
    t = text.tolist()
    assert np.concatenate([p for p, _ in parts]).tolist() == sorted(range(len(t)), key=lambda i: t[i:])


def brute_repeats(docs, words=50):
    seen, spread = defaultdict(list), defaultdict(list)
    parts = []
    for k, (_, t) in enumerate(docs):
        for a in range(len(t) - 399):
            seen[hashlib.md5(t[a : a + 400]).digest()].append((k, a))
        parts.append([x for x in re.split(rb"[\x00-\x20]+", t.lower()) if x])
        for a in range(len(parts[k]) - words + 1):
            spread[hashlib.md5(b" ".join(parts[k][a : a + words])).digest()].append((k, a))
    cover, inside = [bytearray(len(t)) for _, t in docs], [bytearray(len(w)) for w in parts]
    for places in seen.values():
        for k, a in places if len(places) > 1 else ():
            cover[k][a : a + 400] = b"\1" * 400
    for places in spread.values():
        for k, a in places if len({docs[k] for k, _ in places}) > 1 else ():
            inside[k][a : a + words] = b"\1" * words
    runs = lambda c: len(re.findall(b"\1+", bytes(c)))
    return sorted((i, len(t), sum(c), runs(c), hashlib.sha256(bytes(x for x, y in zip(t, c, strict=True) if not y)).hexdigest(), sum(w)) for (i, t), c, w in zip(docs, cover, inside, strict=True))


def odd_texts():
    rnd = random.Random(4)
    passages = [b" ".join(b"w%d" % rnd.randrange(10**6) for _ in range(n)) for n in (49, 50, 51, 60, 90)]
    out = [b"a" * 5000, b"a" * 450, b"b" + b"a" * 900 + b"c", b"of " * 900, b"x of " + b"of " * 500 + b"end", b"abcdefgh" * 3000, b"zz" + b"abcdefgh" * 200 + b"q", b"=-" * 230, b"", b"x" * 399, b"x" * 399]
    out += [b"U%d " % i + passages[i % 5] + b" v%d" % i for i in range(20)]
    out += [b"once more " + b" ".join(b"r%d" % i for i in range(60)) * 2]  # repeats in itself only
    return list(enumerate(out))


@pytest.mark.parametrize("how", [{}, {"anchor_rows": 2, "shard_bytes": 20_000, "budget": 30_000}])
def test_repeats_of_odd_texts(spark, how):
    """Runs, periods, passages of about 50 words; anchors split by longer contexts, queues on disk."""
    docs = odd_texts()
    frame = spark.createDataFrame([(i, t.decode()) for i, t in docs], "doc_id long, text string").repartition(4)
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256, r.n_passage_words) for r in substrings.cut_repeats(frame, **how).collect())
    assert got == brute_repeats(docs)


def test_only_maps_of_repeats_are_broadcast(spark, monkeypatch):
    """A small table of ranges or marks, which takes many times its files' bytes in memory, isn't: only the bitmaps of fixed size are."""
    plans = []
    plan = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or df
    monkeypatch.setattr(substrings, "saved", lambda df, tag: saved(plan(df), tag))
    plan(substrings.cut_repeats(spark.createDataFrame([(i, t.decode()) for i, t in odd_texts()], "doc_id long, text string"), anchor_rows=2))
    joins = [line for p in plans for line in p.split("\n") if "BroadcastHashJoin" in line or "BroadcastNestedLoopJoin" in line]
    assert joins and all(re.search(r"BroadcastHashJoin \[_row", line) for line in joins), joins


def test_repeats_of_a_long_run(spark):
    """5 MB of one byte are stretches of little more than that, and all of it goes."""
    text = b"a" * 5_000_000
    _, lo, hi, _, _ = substrings.stretches([text])
    assert (hi - lo + substrings.LENGTH).sum() < 1.3 * len(text)
    docs = spark.createDataFrame([(1, text.decode()), (None, None), (3, "b" * 400), (3, "b" * 400)], "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans)) for r in substrings.cut_repeats(docs).collect()}
    assert got == {1: (5_000_000, 5_000_000, 1), None: (0, 0, 0), 3: (400, 400, 1)}
    assert substrings.cut_repeats(docs.limit(0)).count() == 0


def test_word_symbols():
    rnd = random.Random(6)
    texts = [bytes(rnd.choice(b"abAB \n\t\x00.") for _ in range(rnd.randint(0, 400))) for _ in range(50)]
    ids = {}
    for block in (1 << 20, 64):
        for t, s in zip(texts, substrings.word_symbols(texts, block), strict=True):
            words = [x for x in re.split(rb"[\x00-\x20]+", t.lower()) if x]
            assert len(s) == 2 * len(words)
            for k, w in enumerate(words):
                assert ids.setdefault(w, s[2 * k : 2 * k + 2]) == s[2 * k : 2 * k + 2]


def http(body):
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n" + body


def test_arc_folder(spark, tmp_path):
    """Both versions, packed and not; equal payloads become revisits of the first; identifiers are all unlike."""
    one = warc.arc_header(1, "one.arc") + b"".join(warc.arc_record(1, f"http://h/{i}", f"2001010100000{i}", http(b"same" if i % 2 else b"own%d" % i), "one.arc") for i in range(4))
    two = warc.arc_header(2, "two.arc") + warc.arc_record(2, "http://h/first", "19990101000000", http(b"same"), "two.arc") + warc.arc_record(2, "http://h/bare", "20020101000000", b"no header", "two.arc")
    (tmp_path / "in" / "sub").mkdir(parents=True)
    (tmp_path / "in" / "one.arc").write_bytes(one)
    (tmp_path / "in" / "sub" / "two.arc.gz").write_bytes(gzip.compress(two[:50]) + gzip.compress(two[50:]))
    (tmp_path / "in" / "empty.arc").write_bytes(b"")
    (tmp_path / "in" / "note.txt").write_bytes(b"x")
    index = arc = warc.arc_records(spark, str(tmp_path / "in"))
    assert index.count() == 6 and arc.filter("url = 'http://h/bare'").first().payload_bytes == 9
    out = f"file://{tmp_path}/out"
    made, errors = warc.convert_folder(spark, str(tmp_path / "in"), out)
    manifest = saved(made, "arcs")
    assert errors.count() == 0
    heads = [h for h, _ in warc_records(manifest) if h["WARC-Type"] != "warcinfo"]
    assert len({h["WARC-Record-ID"] for h in heads}) == len(heads) == 6
    assert {(h["WARC-Target-URI"], h["WARC-Type"], h.get("WARC-Refers-To-Target-URI")) for h in heads} == {
        ("http://h/0", "response", None), ("http://h/1", "revisit", "http://h/first"), ("http://h/2", "response", None), ("http://h/3", "revisit", "http://h/first"),
        ("http://h/first", "response", None), ("http://h/bare", "resource", None),
    }
    assert {h["WARC-Date"] for h in heads if h["WARC-Target-URI"].endswith("first")} == {"1999-01-01T00:00:00Z"}
    assert {h.get("WARC-Refers-To-Date") for h in heads} == {None, "1999-01-01T00:00:00Z"}


def warc_records(manifest):
    out = []
    for r in manifest.collect():
        with open(r.file, "rb") as f:
            out += warc.read_warc(iter(lambda f=f: f.read(7), b""))
    return out


@pytest.mark.parametrize("version", [1, 2])
def test_arc_records_that_are_not_http(spark, tmp_path, version):
    """A DNS answer with a blank line inside is a resource of its own type, whole; a URL may hold spaces."""
    dns = b"20000101000000\r\n\r\nh 60 IN A"
    record = lambda url, when, kind, body: warc.arc_record(version, url, when, body, "x").replace(b"text/html", kind, 1)
    rows = [("dns:h", "20000101000001", b"text/dns", dns), ("http://h/a b", "20000101000002", b"text/html", http(b"x")), ("dns:i", "20000101000003", b"text/dns", dns), ("http://h/bare", "20000101000004", b"image/png", b"HTTP/1.0 204 No")]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.arc").write_bytes(warc.arc_header(version, "x") + b"".join(record(*r) for r in rows))
    made, errors = warc.convert_folder(spark, str(tmp_path / "in"), f"file://{tmp_path}/out")
    manifest = saved(made, "arcs")
    got = warc_records(manifest)
    assert errors.count() == 0 and [h["WARC-Type"] for h, _ in got].count("warcinfo") == manifest.count()
    by = {h["WARC-Target-URI"]: (h["WARC-Type"], h["Content-Type"], int(h["X-Payload-Length"]), block) for h, block in got if "WARC-Target-URI" in h}
    assert by == {
        "dns:h": ("resource", "text/dns", len(dns), dns), "dns:i": ("revisit", "text/dns", len(dns), b""),
        "http://h/a%20b": ("response", "application/http; msgtype=response", 1, http(b"x")), "http://h/bare": ("response", "application/http; msgtype=response", 0, b"HTTP/1.0 204 No"),
    }


def test_arc_lines_that_are_none_cost_themselves_alone(spark, tmp_path):
    good = [warc.arc_record(1, f"http://h/{i}", "20000101000000", http(b"%d" % i), "f") for i in range(4)]
    bad = b"http://h/x 0.0.0.0 20001301000000 text/html 5\n" + b"abcd\n"
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.arc").write_bytes(warc.arc_header(1, "a") + good[0] + bad + good[1] + b"no header at all\n" + good[2])
    (tmp_path / "in" / "cut.arc").write_bytes(warc.arc_header(1, "cut") + good[3] + good[0][:-3])
    (tmp_path / "in" / "odd.arc").write_bytes(b"filedesc://odd 0.0.0.0 20000101000000 text/plain 4\n7 0 ")
    (tmp_path / "in" / "junk.arc").write_bytes(b"junk")
    made, errors = warc.convert_folder(spark, str(tmp_path / "in"), f"file://{tmp_path}/out")
    assert sorted(h["WARC-Target-URI"][-1] for h, _ in warc_records(saved(made, "arcs")) if "WARC-Target-URI" in h) == ["0", "1", "2", "3"]
    found = sorted((r.file.rpartition("/")[2], r.error.split(" ")[0], (r.url or "").strip()[:12]) for r in errors.collect())
    assert [f for f, _, _ in found] == ["a.arc"] * 3 + ["cut.arc", "junk.arc", "odd.arc"] and ("cut.arc", "record", "http://h/0 0") in found
    for raw in (warc.arc_header(1, "f") + b"u 0.0.0.0 20000101000000 text/html 200 - 3\nabc\n", b"junk", warc.arc_header(1, "f") + good[0][:-5]):
        with pytest.raises(ValueError):
            list(warc.read_arc(io.BytesIO(raw)))


def test_small_payloads_are_all_responses(spark):
    pages = spark.createDataFrame([(i, "u", t) for i, t in enumerate(["abc", "abc", "abcd", "abcd", "", ""])], "page_id long, url string, html string")
    path = fresh_path(spark, "least")
    got = {r.page_id: (r.record_type, r.refers_to) for r in warc.read_archives(saved(warc.convert(pages, path, min_bytes=4), "m"), path).collect()}
    assert got == {2: ("revisit", 3)} | {i: ("response", None) for i in (0, 1, 3, 4, 5)}


def test_warc_of_repeated_rows_and_none(spark):
    pages = spark.createDataFrame([(5, "u", "x")] * 3 + [(2, "u", "x"), (9, "v", "long " * 300_000)], "page_id long, url string, html string")
    path = fresh_path(spark, "repeated")
    manifest = saved(warc.convert(pages, path), "m")
    got = Counter((r.page_id, r.record_type, r.refers_to) for r in warc.read_archives(manifest, path).collect())
    assert got == {(5, "response", None): 3, (2, "revisit", 5): 1, (9, "response", None): 1}
    ids = []
    for r in manifest.collect():
        with open(r.file, "rb") as f:
            ids += [h["WARC-Record-ID"] for h, _ in warc.read_warc(iter([f.read()])) if h["WARC-Type"] != "warcinfo"]
    assert len(set(ids)) == 5
    none = fresh_path(spark, "none")
    assert saved(warc.convert(pages.limit(0), none), "m").count() == 0


def test_chat_odd(spark):
    kind = "pair_id long, side string, turn int, role string, text string, loss string, cut string"
    rows = [(1, "chosen", 0, "user", "q", "x", "y"), (1, "rejected", 0, "user", "q", "x", "y"), (1, "chosen", 1, "assistant", "long " * 200_000, "", ""), (1, "rejected", 1, "assistant", "no", "", ""), (2, "chosen", 0, "assistant", "all", "", ""), (2, "chosen", 0, "assistant", "all", "", ""), (2, "rejected", 0, "assistant", "all", "", "")]
    got = chat.format_preferences(spark.createDataFrame(rows, kind)).collect()
    masked = {(r.pair_id, r.part): r.rendered[r.loss_start : r.loss_stop] for r in got if r.loss}
    assert masked == {(1, "chosen"): "long " * 200_000 + "<|end|>", (1, "rejected"): "no<|end|>", (2, "chosen"): "all<|end|>", (2, "rejected"): "all<|end|>"}
    assert [(r.loss_start, r.loss_stop) for r in got if not r.loss] == [(0, 0)] and len(got) == 6
    assert chat.format_preferences(spark.createDataFrame([], kind)).count() == 0


def test_token_files_of_odd_tables(spark):
    docs = spark.createDataFrame([(3, "a"), (3, "b c")] * 40 + [(None, None), (1, "")], "doc_id long, text string")
    for frame, n in ((docs, 82), (docs.limit(0), 0)):
        path = fresh_path(spark, "tokens")
        token_ids.write_tokens(cells(frame), path)
        rows = sorted(token_ids.checksums(token_ids.read_tokens(spark, path)).collect(), key=lambda r: r.start)
        assert [r.doc_id for r in rows] == ([None, 1] + [3] * 80 if n else [])
        assert all(b.start == a.start + a.n_tokens for a, b in zip(rows, rows[1:]))
        assert Counter(r.n_tokens for r in rows) == ({1: 2, 2: 40, 3: 40} if n else {})
        assert token_ids.read_tokens(spark, path, [3]).count() == (80 if n else 0)


@pytest.mark.parametrize("step", range(5))
def test_stages_on_odd_rows(spark, step):
    """Nulls, ties, repeated rows, empty tables and clashing names pass through every stage."""
    import corpus_pipeline

    kind = "doc_id long, text string, lang string, source string, n_chars long, quality int, hits string, pieces string, row_ string"
    long = " ".join(f"w{i}" for i in range(20_000))
    texts = [(None, "plain words of a text that nobody else has"), (1, None), (2, ""), (3, "same text here"), (3, "same text here"), (4, "same  text\there"), (5, long), (6, long + " more")]
    docs = spark.createDataFrame([(i, t, None, "x", 1, 2, "h", "p", "r") for i, t in texts], kind)
    name, stage = corpus_pipeline.STAGES[step]
    got = stage(spark, docs, D)
    assert stage(spark, docs.limit(0), D).count() == 0
    if step == 4:
        assert sorted((str(r.doc_id), r.exact) for r in got.collect()) == sorted((str(i), True) for i, _ in texts)
        return
    assert got.columns == docs.columns
    left = sorted(str(r.doc_id) for r in got.collect())
    if step == 0:  # what the fitted model says of each text alone
        labels = spark.read.parquet(f"{D}/labels.parquet").filter(~quality.fold(F.col("doc_id")))
        model = quality.fitted(cells(docs), labels, quality.MAX_LABELLED)
        good = lambda t: model.score(quality.terms(None if t is None else t.encode())[None], quality.NEIGHBOURS)[0] >= 0.3
        assert left == sorted(str(i) for i, t in texts if good(t)) and left
        return
    assert left == {
        1: ["1", "3", "3", "5", "6", "None"], 2: ["1", "3", "3", "5", "None"], 3: sorted(str(i) for i, _ in texts),
    }[step], name


def test_quality_stage(spark):
    """The stage keeps just what the query predicts as 1."""
    import corpus_pipeline

    docs = spark.read.parquet(f"{D}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.keep_good(spark, docs, D).collect()}
    assert kept == {r.doc_id for r in quality.op4_quality_classifier(spark, D).collect() if r.predicted}


def test_stages_without_labels_or_benchmark(spark, tmp_path):
    """Without labels every score is 0.5, and without items nothing is contaminated: all rows stay."""
    import corpus_pipeline

    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{D}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    docs = spark.read.parquet(f"{D}/documents.parquet")
    for step in (0, 3):
        assert corpus_pipeline.STAGES[step][1](spark, docs, str(tmp_path)).count() == docs.count()


def test_pieces_of_bytes_that_are_no_text(spark):
    rows = spark.sql("select 1L as doc_id, cast(x'61ff62' as string) as text union all select 2L, 'ab'")
    got = {r.doc_id: (r.pieces.exact, len(r.pieces.ids) > 0) for r in pieces.encode_pieces(rows).collect()}
    assert got == {1: (False, True), 2: (True, True)}


def test_token_files_are_pruned(spark):
    """One document of many is found by reading a few row groups of one file, and one that isn't there by reading none."""
    path = fresh_path(spark, "pruned")
    docs = spark.range(0, 40_000, 1, 4).select((F.col("id") * 2).alias("doc_id"), F.concat(F.lit("word "), F.col("id").cast("string")).alias("text"))
    token_ids.write_tokens(docs, path)

    def rows_read(ids):
        rows = spark.read.orc(path).filter(F.col("doc_id").isin(ids))
        before = [r.doc_id for r in token_ids.read_tokens(spark, path, ids).collect()]
        # what leaves the scan, before Spark's own filter
        kept = rows._jdf.queryExecution().executedPlan()
        rows.collect()
        todo, n = [kept], 0
        while todo:
            node = todo.pop()
            if node.nodeName().startswith("Scan orc"):
                n += node.metrics().apply("numOutputRows").value()
            todo += [node.children().apply(k) for k in range(node.children().size())]
        return before, n

    held = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.orc.filterPushdown")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert rows_read([31_000])[0] == [31_000] and 1 <= rows_read([31_000])[1] <= 2000
        assert rows_read([31_001]) == ([], 0)  # by the Bloom filters
        spark.conf.set("spark.sql.orc.filterPushdown", "false")
        assert spark.read.orc(path).count() == 40_000
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
