"""Importance resampling, hard negatives and quality rules against brute force, and on odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from tickweave.llm import negatives, quality, quality_rules, resample

D = "/root/testdata/sf0.001"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ODD = [(None, "a b c " * 9), (1, None), (2, ""), (3, "same text here " * 8), (3, "same text here " * 8), (4, "# & é 日本\n\n x\nx\nx \n"), (5, "word " * 60_000), (6, " ".join(f"w{i}" for i in range(25_000))), (None, "a b c " * 9)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, 1, "x", 2, True) for i, t in ODD], "doc_id long, text string, score int, rules string, rank long, kept boolean")


def drawn(rows, target, percent=10, longest=1, least=20):
    """What resample returns, without it."""

    def features(t):
        w = WORD.findall((t or "").translate(LOW))
        return w, [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    bucket = lambda f: zlib.crc32(f.encode()) % 10000
    s, t = (Counter(bucket(f) for x in xs for f in features(x)[1]) for xs in ([x for _, x in rows], target))
    ns, nt = sum(s.values()), sum(t.values())
    out = []
    for i, x in rows:
        words, fs = features(x)
        weight = sum(math.floor(1000 * math.log((t[bucket(f)] + 1) * (ns + 10000) / ((s[bucket(f)] + 1) * (nt + 10000)))) for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words) >= least])
    able = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    ranks = {id(r): k + 1 for k, r in enumerate(able[: percent * len(able) // 100])}
    return sorted(map(str, ((*r[:4], ranks.get(id(r))) for r in out)))


@pytest.mark.parametrize(("percent", "longest", "most"), [(10, 1, None), (50, 2, 3), (100, 1, 1)])
def test_resampling(spark, odd, percent, longest, most):
    target = [r[0] for r in duckdb.connect().execute(f"select text from '{D}/benchmark.parquet'").fetchall()]
    frame = spark.read.parquet(f"{D}/benchmark.parquet")
    for docs in (odd, spark.read.parquet(f"{D}/documents.parquet").repartition(5)):
        rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        got = resample.resample(docs, frame, percent, longest, most=most).collect()
        assert sorted(str((r.doc_id, r.n_features, r.weight, r.score, r["rank"])) for r in got) == drawn(rows, target, percent, longest)


def test_resampling_of_nothing(spark, odd):
    none = odd.limit(0)
    assert resample.resample(none, none.select("text")).count() == 0
    assert [r["rank"] for r in resample.resample(odd, none.select("text"), percent=0).collect()] == [None] * len(ODD)


def test_one_score_over_many_ranges(spark):
    """A score that most rows have is cut by ids, nulls among them; many runs are merged by way of longer ones."""
    rows = spark.range(9000).selectExpr("id as doc_id", "1L as n_features", "0L as weight", "if(id % 10 = 0, id, 7L) as score")
    rows = rows.unionByName(spark.range(300).selectExpr("cast(null as long) as doc_id", "1L as n_features", "0L as weight", "7L as score")).repartition(6)
    levels = sorted(((r.score, r["count"]) for r in rows.groupBy("score").count().collect()), reverse=True)
    ranges = resample.ranges_of(rows, levels, 500)
    assert len(ranges) > 15
    got = resample.ranked(resample.sorted_runs(rows, [k for k, _ in ranges]), [n for _, n in ranges], 5000, 8).collect()
    want = sorted(((r.score, r.doc_id) for r in rows.collect()), key=lambda r: (-r[0], r[1] is None, r[1] or 0))
    ranked = {r["rank"]: (r.score, r.doc_id) for r in got if r["rank"]}
    assert [ranked[k + 1] for k in range(5000)] == want[:5000] and len(got) == len(want)


def test_tournament(monkeypatch):
    monkeypatch.setattr(resample, "BLOCK", 5)
    rnd, spool = random.Random(5), resample.Spool()
    for k in (0, 1, 2, 7, 40):
        runs = [sorted((rnd.randint(0, 30), 0, rnd.randint(0, 9), 0, 0) for _ in range(rnd.randint(0, 30))) for _ in range(k)]
        held = [[spool.add(np.array(r[a : a + 4], np.int64).tobytes()) for a in range(0, len(r), 4)] for r in runs]
        for fan in (2, 3, 64):
            assert list(resample.merged(spool, held, fan)) == sorted(x for r in runs for x in r)


def mined(rows, every, k=5):
    """What mine returns, without it. rows: vec_id, label, vector."""
    held = [(i, y, [math.floor(256 * x) for x in v]) for i, y, v in rows if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    held = [r for r in held if sum(x * x for x in r[2]) < 2**62]
    out = []
    for i, y, v in held:
        if i % every:
            continue
        all_ = sorted((-sum(map(int.__mul__, v, w)), j, z) for j, z, w in held)
        for s, j, _ in [x for x in all_ if x[2] == y and x[1] != i][:k]:
            hard = [x for x in all_ if x[2] != y and 80 * -s <= 100 * -x[0] <= 100 * -s][:k]
            out += [(i, j, r + 1, n, -s, -t) for r, (t, n, _) in enumerate(hard)]
    return sorted(out)


def _vectors(spark, rows):
    return spark.createDataFrame([(i, v, y, 0, "x") for i, y, v in rows], "vec_id long, embedding array<double>, label int, q int, part string")


@pytest.mark.parametrize("kind", ["ties", "near", "large", "odd"])
def test_negatives(spark, kind):
    rnd = random.Random(len(kind))
    unit = lambda n: [rnd.gauss(0, 0.2) for _ in range(n)]
    centres = [unit(8) for _ in range(6)]
    rows = {
        "ties": lambda: [(i, i % 3, rnd.choice([[0.5, 0.25], [0.5, 0.25], [-0.1, 0.4], [0.0, 0.0]])) for i in range(700)],
        "near": lambda: [(i, i % 4, [x + rnd.gauss(0, 0.01) for x in centres[i % 6]]) for i in range(900)],
        "large": lambda: [(i, i % 2, [x * 3e6 for x in unit(8)]) for i in range(400)],
        "odd": lambda: [(None, 1, [1.0]), (1, None, [1.0]), (2, 1, None), (3, 1, [None, 1.0]), (4, 1, [math.inf]), (5, 1, [math.nan]), (6, 1, [1e12, 1.0]), (7, 1, []), (0, 1, [0.5, 0.5]), (0, 1, [0.5, 0.5]), (8, 1, [0.5]), (9, 2, [0.5, 0.4]), (9, 2, [0.5, 0.4]), (10, 2, [0.1, 0.2, 0.3]), (20, 2, [-1.0])],
    }[kind]()
    got = negatives.mine(_vectors(spark, rows), negatives.F.col("vec_id") % 10 == 0, part=100, block=16).collect()
    assert sorted(map(tuple, got)) == mined(rows, 10)


def test_negatives_of_nothing(spark):
    for rows in ([], [(1, 1, [1.0]), (2, 2, [1.0])], [(0, 1, [1.0])], [(0, 1, [])] * 3):
        assert negatives.mine(_vectors(spark, rows), negatives.F.col("vec_id") % 10 == 0).count() == 0


def test_brackets_hold_and_exclude():
    """Scores lie within their brackets, and rows of other clusters leave without a product."""
    rng = np.random.default_rng(3)
    x = np.floor(256 * np.repeat(rng.normal(size=(8, 16)), 200, axis=0) + rng.normal(size=(1600, 16)))
    top = float((x * x).sum(1).max())
    pivots = negatives.choose_pivots(x, top)
    d, a = negatives.distances(x, pivots, top), x[::100]
    da, sums = negatives.distances(a, pivots, top, query=True), top + (a * a).sum(1)
    low, high = negatives._brackets(da, d, d, sums)
    s = a @ x.T
    assert (low <= s).all() and (s <= high).all()
    fifth = np.sort(s, axis=1)[:, -5]
    assert (high < fifth[:, None]).mean() > 0.5


def base_counts(t):
    words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    seen, windows = Counter(), [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    hit, often, dups = set(), Counter(windows), 0
    for i, w in enumerate(windows):
        hit |= set(range(i, i + 8)) if often[w] > 1 else set()
    for line in (t or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dups += seen[line] > 0
            seen[line] += 1
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t or "")), dups, len(hit)


def test_quality_rules(spark, odd):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    got = {r.doc_id: r for r in quality_rules.op13_quality_rules(spark, D).collect()}
    for r in docs.collect():
        g, want = got[r.doc_id], base_counts(r.text)
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == want
        assert g.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert g.kept == (not g.base_failed and g.score >= 0.3)
    rows = quality_rules.judge(odd, docs, spark.read.parquet(f"{D}/labels.parquet")).collect()
    assert sorted(map(str, ((r.doc_id, *r.rules_[:5]) for r in rows))) == sorted(map(str, ((i, *base_counts(t)) for i, t in ODD)))
    assert list(rows[0].asDict()) == [*odd.columns, "rules_"]


@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 40, 3000])
def test_repeated_words(n):
    rnd = random.Random(n)
    for k in (1, 2, 3, 50):
        text = " ".join(f"w{rnd.randint(1, k)}" for _ in range(n))
        assert quality_rules.counts_and_statistics(text.encode())[0][4] == base_counts(text)[4]


def test_trees_are_monotone():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 4))
    y = ((x[:, 0] - x[:, 1] + np.sin(9 * x[:, 2]) + rng.normal(0, 0.3, 3000)) > 0.4).astype(float)
    model = quality_rules.fit(x, y, np.array([1, -1, 0, 0]))
    assert ((model.score(x) > 0.5) == y).mean() > 0.85
    for f, sign in ((0, 1), (1, -1)):
        rows = np.repeat(rng.random((200, 4)), 30, axis=0)
        rows[:, f] = np.tile(np.linspace(0, 1, 30), 200)
        assert (sign * np.diff(model.score(rows).reshape(200, 30), axis=1) >= 0).all()


def test_rules_hold_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    held = docs.join(labels, "doc_id").filter(quality.fold(negatives.F.col("doc_id")))
    out = quality_rules.judge(held, docs, labels.filter(~quality.fold(negatives.F.col("doc_id")))).select("quality", "rules.*").collect()
    right = np.mean([(r.score >= 0.5) == r.quality for r in out])
    kept = np.mean([r.score >= 0.3 for r in out if r.quality == 1])
    print(len(out), right, kept, np.mean([r.kept for r in out if r.quality == 1]), np.mean([r.kept for r in out if r.quality == 0]))
    assert right > 0.95 and kept > 0.98


def test_rules_without_labels(spark, odd):
    none = spark.createDataFrame([], "doc_id long, quality int")
    for labels in (none, spark.createDataFrame([(5, None), (None, 1)], "doc_id long, quality int")):
        assert {r.rules_.score for r in quality_rules.judge(odd, odd, labels).collect()} == {0.5}
    assert quality_rules.judge(odd.limit(0), odd, none).count() == 0


def test_license_tags_need_a_context():
    """Prose that only looks like a tag isn't one; tags in license context are, and gaps are counted in words."""
    from tickweave.llm import licenses
    from tickweave.llm.common import words_of

    scanner = licenses.Scanner()
    found = lambda t: sorted({x for _, _, x in scanner.scan(words_of(t.encode()))[1]})
    for t in ("Apache 2.0 degrees", "cc by 1 0 goals", "the php 3.0 release", "mpl 1.1 volts", "artistic 2 0 score", "a general of the public", "the name of the rose, nor the names of its heroes", "boost 1.0", "all rights and duties"):
        assert found(t) == [], t
    assert found("Licensed under Apache 2.0") == ["apache-2.0"] and found("the Apache-2.0 license") == ["apache-2.0"] and found("license: cc by 4.0") == ["cc-by-4.0"]
    assert found("SPDX-License-Identifier: MPL-2.0") == ["mpl-2.0"]
    names = "neither the name of " + "very " * 10 + "%s nor the names of its contributors"
    assert found(names % "long") == ["bsd-3-clause"] and found(names % "long long long") == []
    long = "neither the name of " + "x" * 500 + " nor the names of its contributors"
    assert found(long) == ["bsd-3-clause"]  # words, not bytes
    written = [p for _, _, phrases in licenses.SIGNATURES for p in phrases]
    assert len(set(written)) == len(written) > 200
    for label, _, phrases in licenses.SIGNATURES:
        for p in phrases:
            if not any(c in p for c in "[(\\"):
                plain = p.replace("...", "word ").replace("word 8", "word").split()
                line = " ".join(w for w in plain if not w.isdigit() or "..." not in p)
                assert scanner.scan(words_of(line.encode()))[1], p
