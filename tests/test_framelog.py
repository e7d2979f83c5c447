"""The frame log as a table: commits, order, splits, pruning, and streams into and out of it."""

import json
import os
import subprocess
import sys
import threading
from pathlib import Path

import pytest
import zstandard
from pyspark.sql import functions as F

from tickweave.sources import framelog
from tickweave.streaming import stateful

KIND = "symbol string, file_date string, recv_nanos long, tag_byte int, payload binary, seq long"
DAY = 86_400 * 10**9
pack = lambda n, tag=83, p=b"p": framelog.ROW.pack(n, tag, len(p)) + p
zst = lambda *rows: zstandard.ZstdCompressor().compress(b"".join(rows))


@pytest.fixture
def log(spark, tmp_path):
    framelog.register(spark)
    return str(tmp_path / "log")


def frame(spark, ns, symbol="a", day="20240101"):
    return spark.createDataFrame([(symbol, day, n, 83, str(n).encode(), k) for k, n in enumerate(ns)], KIND)


def read(spark, folder, **options):
    return sorted((r.file.rpartition("/")[2], r.seq, r.recv_nanos, r.error) for r in spark.read.format("framelog").options(**options).load(folder).collect())


def in_order(ns, symbol="a", day="20240101"):
    return [(f"{symbol}_{day}.zst", k, n, None) for k, n in enumerate(ns)]


def run(spark, source, tmp_path, name, **options):
    """One run of a stream of the log into memory, until nothing more is there."""
    stream = spark.readStream.format("framelog").options(**options).load(source)
    return stream.writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / f"{name}-state")).start()


def test_writers_at_one_time_lose_nothing(spark, log):
    threads = [threading.Thread(target=lambda k=k: framelog.write_log(frame(spark, [10 * k, 10 * k + 1]), log)) for k in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    got = read(spark, log)
    assert [r[1] for r in got] == list(range(12)) and sorted(r[2] for r in got) == sorted(10 * k + i for k in range(6) for i in (0, 1))
    assert all(got[i][2] + 1 == got[i + 1][2] for i in range(0, 12, 2))  # each commit's rows stand together
    assert sorted(p.name for p in Path(log, "_commits").iterdir()) == [f"{n + 1:010d}.json" for n in range(6)]


def test_a_taken_number_is_left_to_its_owner(tmp_path):
    where, root = framelog._open(str(tmp_path))
    assert framelog._create(where, f"{root}/x", b"first") and not framelog._create(where, f"{root}/x", b"second")
    assert (tmp_path / "x").read_bytes() == b"first" and len(list(tmp_path.iterdir())) == 1
    with pytest.raises(NotImplementedError, match="singleWriter"):
        framelog._create(type("Store", (), {"type_name": "s3"})(), "x", b"")


def test_summaries_hold_the_same_state(tmp_path, monkeypatch):
    monkeypatch.setattr(framelog, "SUMMARY", 4)
    for k in range(10):
        framelog.commit_parts(str(tmp_path), [{"name": f"a_20240101.zst.{k:032x}", "log": "a_20240101.zst", "size": 9, "frames": [[0, 2, k, k, [83]]]}], overwrite=k == 6, stream=("q", k))
    where, root = framelog._open(str(tmp_path))
    state = framelog.state_of(where, root)
    assert (state.number, len(state.parts), len(state.gone), state.rows, state.streams) == (10, 4, 6, {"a_20240101.zst": 8}, {"q": 9})
    for p in Path(root, "_commits").glob("*.summary"):
        p.unlink()
    assert framelog.state_of(where, root) == state
    assert not framelog.commit_parts(str(tmp_path), [], stream=("q", 9))


def test_order_is_that_of_the_tasks(spark, log):
    rows = spark.range(0, 20, 1, 2).select(F.lit("a").alias("symbol"), F.lit("20240101").alias("file_date"), F.when(F.col("id") < 10, 50).otherwise(40).cast("long").alias("recv_nanos"), F.lit(83).alias("tag_byte"), F.lit(b"x").alias("payload"))
    rows.write.format("framelog").mode("append").save(log)
    assert [r[2] for r in read(spark, log)] == [50] * 10 + [40] * 10


def test_a_large_log_is_many_tasks(spark, log):
    """One symbol's day, with times that don't follow seq, is written and read by many tasks in the order of seq."""
    n = 200_000
    rows = spark.range(0, n, 1, 16).select(F.lit("a").alias("symbol"), F.lit("20240101").alias("file_date"), (F.col("id") * 7919 % n).alias("recv_nanos"), F.lit(83).alias("tag_byte"), F.col("id").cast("string").cast("binary").alias("payload"), F.col("id").alias("seq"))
    framelog.write_log(rows.orderBy(F.rand(3)), log, tasks=8, frameBytes="65536")
    assert len([p for p in os.listdir(log) if p.startswith("a_")]) == 8
    back = spark.read.format("framelog").option("splitBytes", "100000").load(log)
    assert back.rdd.getNumPartitions() > 8
    assert back.filter("cast(cast(payload as string) as long) = seq").count() == n == back.select("seq").distinct().count()


def test_more_logs_than_a_task_holds_open(spark, log, monkeypatch):
    rows = spark.range(0, 300, 1, 1).select(F.concat(F.lit("s"), (F.col("id") % 100).cast("string")).alias("symbol"), F.lit("20240101").alias("file_date"), F.col("id").alias("recv_nanos"), F.lit(83).alias("tag_byte"), F.lit(b"").alias("payload"))
    rows.write.format("framelog").mode("append").save(log)
    got = read(spark, log)
    assert len(got) == 300 and all(r[2] == int(r[0][1:].split("_")[0]) + 100 * r[1] for r in got)


def test_clean_deletes_what_nobody_reads(spark, log):
    framelog.write_log(frame(spark, [1, 2]), log)
    framelog.write_log(frame(spark, [3]), log, "overwrite")
    Path(log, "a_20240101.zst." + "0" * 32).write_bytes(b"lost")
    assert framelog.clean(log) == [] and len(framelog.clean(log, hours=-1)) == 2
    assert read(spark, log) == in_order([3])


def test_compaction_keeps_rows_places_and_streams(spark, log, tmp_path):
    for k in range(4):
        framelog.write_log(frame(spark, [10 * k, 10 * k + 1]), log)
        framelog.write_log(frame(spark, [k], "b"), log)
    want = read(spark, log)
    assert framelog.compact(spark, log) == 6 and framelog.compact(spark, log) == 0
    table = spark.read.format("framelog").option("splitBytes", "1").load(log)
    assert read(spark, log) == want and table.rdd.getNumPartitions() == 8 and table.filter("recv_nanos = 31").rdd.getNumPartitions() == 1
    query = run(spark, log, tmp_path, "merged")  # a stream that begins now reads each row once
    stateful.stop(query)
    assert sorted((r.file.rpartition("/")[2], r.seq, r.recv_nanos, r.error) for r in spark.table("merged").collect()) == want
    framelog.write_log(frame(spark, [99]), log)
    assert len(framelog.clean(log, hours=-1)) == 8 and [r[:3] for r in read(spark, log) if r[0][0] == "a"][-1] == ("a_20240101.zst", 8, 99)


def test_compaction_gives_way_to_an_overwrite(spark, log):
    framelog.write_log(frame(spark, [1]), log)
    framelog.write_log(frame(spark, [2]), log)

    class Late:
        """The session, in which another writer commits once the compaction has looked at the folder."""

        def __getattr__(self, name):
            return getattr(spark, name)

        def createDataFrame(self, *args):
            framelog.write_log(frame(spark, [3]), log, "overwrite")
            return spark.createDataFrame(*args)

    assert framelog.compact(Late(), log) == 0
    assert read(spark, log) == in_order([3]) and len(framelog.clean(log, hours=-1)) == 2


def test_frames_are_found_without_decompression(tmp_path):
    c = zstandard.ZstdCompressor
    pieces = [c(level=3).compress(os.urandom(300_000)), c(write_checksum=True).compress(b"a" * 500_000), c(write_content_size=False).compress(b"x"), b"\x52\x2a\x4d\x18\x03\0\0\0abc", c().compress(b"")]
    (tmp_path / "x").write_bytes(b"".join(pieces))
    where, root = framelog._open(str(tmp_path))
    ends = [sum(map(len, pieces[: k + 1])) for k in range(len(pieces))]
    assert [e for _, e in framelog.frames(where, f"{root}/x")] == ends
    for cut in (1, 3, 5, 200_000, len(pieces[0]) - 1):
        (tmp_path / "y").write_bytes(pieces[1] + pieces[0][:cut])
        assert list(framelog.frames(where, f"{root}/y")) == [(0, len(pieces[1])), (len(pieces[1]), None)]


@pytest.mark.parametrize("kind", ["whole", "cut frame", "cut row", "straddling", "broken"])
def test_a_collectors_log_is_split_by_its_index(spark, log, kind):
    os.makedirs(log)
    pieces = [zst(*(pack(100 * k + i, 83, os.urandom(50)) for i in range(30))) for k in range(64)]
    if kind == "cut frame":
        pieces[-1] = pieces[-1][:-9]
    if kind == "cut row":
        pieces[-1] = zst(pack(1), pack(2)[:-1])
    if kind == "straddling":
        pieces[40:42] = [zst(pack(5), pack(6)[:5]), zst(pack(6)[5:], pack(7))]
    if kind == "broken":
        pieces[20] = pieces[20][:40] + b"\0" * 40 + pieces[20][80:]
    path = Path(log, "a_20240101.zst")
    path.write_bytes(b"".join(pieces))
    whole = read(spark, log)
    framelog.index_logs(spark, log)
    assert read(spark, log, splitBytes="4000") == whole
    n = spark.read.format("framelog").option("splitBytes", "4000").load(log).rdd.getNumPartitions()
    assert n >= {"straddling": 15, "broken": 7}.get(kind, 25)
    if kind == "whole":  # what comes later is read on behind the index, and parts behind the collector's rows
        with path.open("ab") as f:
            f.write(zst(pack(9_999)))
        assert read(spark, log)[-1][1:3] == (64 * 30, 9_999)
        framelog.index_logs(spark, log)
        framelog.write_log(frame(spark, [8]), log)
        assert read(spark, log)[-2:] == [("a_20240101.zst", 64 * 30, 9_999, None), ("a_20240101.zst", 64 * 30 + 1, 8, None)]


def test_only_files_that_may_hold_rows_are_opened(spark, log):
    """Days in names bound times from above only: late rows stand in newer files."""
    os.makedirs(log)
    days = [f"202401{d:02d}" for d in range(1, 11)]
    first = 1_704_067_200 * 10**9  # 2024-01-01
    for k, d in enumerate(days):
        Path(log, f"a_{d}.zst").write_bytes(zst(pack(first + k * DAY + 5), pack(first + max(0, k - 3) * DAY + 7, 82)))
    framelog.write_log(frame(spark, [first + 2 * DAY], "b"), log)
    framelog.write_log(frame(spark, [first + 8 * DAY], "b"), log)
    table = spark.read.format("framelog").load(log)
    all_ = [r.recv_nanos for r in table.collect()]

    def opened(condition):
        got = table.filter(condition)
        assert sorted(r.recv_nanos for r in got.collect()) == sorted(n for n in all_ if eval(condition.replace("recv_nanos", str(n)).replace(" = ", " == ")))
        return got.rdd.getNumPartitions()

    assert opened(f"recv_nanos >= {first + 7 * DAY}") == 4  # three files and a part
    assert opened(f"recv_nanos = {first + 9 * DAY + 5}") == 1
    assert opened(f"recv_nanos < {first + 3 * DAY}") == 11  # any later file may have late rows; one part is out
    framelog.index_logs(spark, log)
    assert opened(f"recv_nanos < {first + 3 * DAY}") == 6 + 1  # three by day, three with late rows: known by now
    assert table.filter("tag_byte = 88").count() == 0 and table.filter("tag_byte = 88").rdd.getNumPartitions() == 1


def test_what_a_collector_appends_reaches_the_stream(spark, log, tmp_path):
    os.makedirs(log)
    path = Path(log, "a_20240101.zst")
    path.write_bytes(zst(pack(1), pack(2)))
    query = run(spark, log, tmp_path, "appended")
    query.processAllAvailable()
    more = zst(pack(3), pack(4), pack(5))
    with path.open("ab") as f:
        f.write(more[:-4])
    query.processAllAvailable()  # not a whole frame yet
    assert spark.table("appended").count() == 2
    with path.open("ab") as f:
        f.write(more[-4:])
    stateful.stop(query)
    assert sorted((r.seq, r.recv_nanos, r.error) for r in spark.table("appended").collect()) == [(k, k + 1, None) for k in range(5)]


def test_a_cut_file_is_read_to_its_end_once_a_newer_is_there(spark, log, tmp_path):
    os.makedirs(log)
    Path(log, "a_20240101.zst").write_bytes(zst(*(pack(k, 83, os.urandom(4000)) for k in range(200)))[:-100_000])
    query = run(spark, log, tmp_path, "closed")
    query.processAllAvailable()
    assert spark.table("closed").count() == 0
    Path(log, "a_20240102.zst").write_bytes(zst(pack(7)))
    stateful.stop(query)
    got = sorted((r.file, r.seq, r.recv_nanos, r.error) for r in spark.table("closed").collect())
    assert got == sorted((r.file, r.seq, r.recv_nanos, r.error) for r in spark.read.format("framelog").load(log).collect()) and len(got) > 100


def test_an_unbroken_log_of_two_commits_has_no_gaps(spark, log, tmp_path):
    updates = lambda a, b: spark.createDataFrame([("a", "20240101", 5, 83, f"{3 * k} {3 * k + 2}".encode(), k) for k in range(a, b)], KIND)
    framelog.write_log(updates(0, 40), log)
    framelog.write_log(updates(40, 70), log)
    ids = F.split(F.col("payload").cast("string"), " ")
    diffs = lambda s: s.select(F.lit("a").alias("symbol"), "seq", ids[0].cast("long").alias("first_update_id"), ids[1].cast("long").alias("last_update_id"))
    stream = stateful.stream_gaps(diffs(spark.readStream.format("framelog").load(log)))
    query = stream.writeStream.format("memory").queryName("unbroken").option("checkpointLocation", str(tmp_path / "state")).start()
    query.processAllAvailable()
    framelog.write_log(updates(70, 75), log)
    framelog.write_log(updates(77, 80), log)
    stateful.stop(query)
    assert [tuple(r) for r in spark.table("unbroken").collect()] == [("a", 75, 225, 231, 224)]


def test_stream_offsets_stay_small_and_batches_bounded(spark, log, tmp_path):
    os.makedirs(log)
    day = lambda k: f"2024{1 + k // 28:02d}{1 + k % 28:02d}"
    state, out = tmp_path / "state", str(tmp_path / "out")

    def follow():
        stream = spark.readStream.format("framelog").option("maxFilesPerTrigger", "3").load(log)
        query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(state)).start()
        stateful.stop(query)
        return [p["numInputRows"] for p in query.recentProgress]

    for k in range(40):
        Path(log, f"a_{day(k)}.zst").write_bytes(zst(pack(k)))
    for k in range(5):
        framelog.write_log(frame(spark, [k], "b"), log)
    assert max(follow()) == 3
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 45 == len({(r.file, r.seq) for r in rows})
    offsets = sorted((p for p in Path(state, "offsets").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    at = lambda p: json.loads(json.loads(p.read_text().splitlines()[-1])["at"])
    assert len(offsets) >= 15 and list(at(offsets[0])) == ["name"] and at(offsets[1])["commit"] == 5 and at(offsets[1])["closed"] == {"a": [day(0), 1, 23]}
    assert os.listdir(Path(log, "_readers")) == []
    assert len(at(offsets[-1])["files"]) <= 4 and at(offsets[-1])["closed"]["a"][1] >= 36
    follow()  # nothing new
    for k in range(41, 50):
        Path(log, f"a_{day(k)}.zst").write_bytes(zst(pack(k)))
    assert max(follow()) == 3  # a restart's first batch is bounded, too
    assert spark.read.parquet(out).count() == 45 + 9
    with Path(log, f"a_{day(2)}.zst").open("ab") as f:
        f.write(zst(pack(99)))
    with pytest.raises(Exception, match="have grown"):
        follow()


def sink(spark, source, log, state, **options):
    rows = spark.readStream.schema(KIND).json(source).select("symbol", "file_date", "recv_nanos", "tag_byte", F.col("payload"))
    query = rows.writeStream.format("framelog").options(**options).option("path", log).option("checkpointLocation", state).start()
    stateful.stop(query)


@pytest.mark.parametrize("lost", ["manifest", "answer"])
def test_a_batch_that_is_run_again_is_there_once(spark, log, tmp_path, lost):
    """The query is killed after its parts are written, before its manifest is (or after that, before Spark has heard of it), and run again."""
    source, state = tmp_path / "in", tmp_path / "state"
    source.mkdir()
    put = lambda name, ns: (source / name).write_text("\n".join(json.dumps({"symbol": "a", "file_date": "20240101", "recv_nanos": n, "tag_byte": 83, "payload": "eA=="}) for n in ns))
    put("0.json", [1, 2])
    sink(spark, str(source), log, str(state))
    put("1.json", [3, 4, 5])
    sink(spark, str(source), log, str(state))
    assert [r[2] for r in read(spark, log)] == [1, 2, 3, 4, 5]
    for p in (state / "commits").glob("*1*"):
        p.unlink()
    if lost == "manifest":
        Path(log, "_commits", "0000000002.json").unlink()
        assert [r[2] for r in read(spark, log)] == [1, 2]
    put("2.json", [6])
    sink(spark, str(source), log, str(state))
    assert read(spark, log) == in_order([1, 2, 3, 4, 5, 6])
    assert framelog.state_of(*framelog._open(log)).streams == {f"file://{state}" if f"file://{state}" in str(framelog.state_of(*framelog._open(log)).streams) else str(state): 2}


def test_a_stream_and_a_batch_writer_at_one_time(spark, log, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for k in range(4):
        (source / f"{k}.json").write_text(json.dumps({"symbol": "a", "file_date": "20240101", "recv_nanos": k, "tag_byte": 83, "payload": "eA=="}))
    other = threading.Thread(target=lambda: [framelog.write_log(frame(spark, [10 + k]), log) for k in range(4)])
    other.start()
    sink(spark, str(source), log, str(tmp_path / "state"))
    other.join()
    got = read(spark, log)
    assert sorted(r[2] for r in got) == [0, 1, 2, 3, 10, 11, 12, 13] and [r[1] for r in got] == list(range(8))


def test_stream_options(spark, log, tmp_path):
    os.makedirs(log)
    Path(log, "a_20240101.zst").write_bytes(zst(pack(1), pack(2, 83, b"long")[:-2]))
    query = run(spark, log, tmp_path, "lenient")
    stateful.stop(query)
    assert sorted((r.seq, r.error) for r in spark.table("lenient").collect()) == [(0, None), (1, "ends within a payload")]
    with pytest.raises(Exception, match="ends within"):
        run(spark, log, tmp_path, "strict", mode="FAILFAST").processAllAvailable()


def test_streams_without_the_package_on_the_path(log):
    """Only the driver finds the package; the processes that plan and run the stream get what they need."""
    root = Path(__file__).resolve().parents[1]
    os.makedirs(log)
    Path(log, "a_20240101.zst").write_bytes(zst(pack(1), pack(2)))
    code = f"""
import sys; sys.path.insert(0, {str(root)!r})
from pyspark.sql import SparkSession
from tickweave.sources import framelog
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
framelog.register(spark)
q = spark.readStream.format("framelog").load({log!r}).writeStream.format("memory").queryName("q").option("checkpointLocation", {log + "-state"!r}).start()
q.processAllAvailable(); print("rows", spark.table("q").count()); q.stop(); spark.stop()
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH" and "SPARK" not in k} | {"PYSPARK_PYTHON": sys.executable}
    out = subprocess.run([sys.executable, "-c", code], cwd="/", env=env, capture_output=True, text=True, timeout=300)
    assert "rows 2" in out.stdout, out.stderr[-2000:]
