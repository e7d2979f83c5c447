"""The frame log as a Spark data source and sink, batch and stream: zstd files of [i64 nanos][u8 tag][u32 length][payload] rows.

A symbol's log of a day is `symbol_day.zst`, as a collector writes it, and the parts that this sink adds, `symbol_day.zst.<uuid>`. A part counts
once a manifest `_commits/<number>.json` names it. A manifest is created only if its number is free; who comes second takes the next number, so
writers at one time lose nothing, and a job that failed leaves nothing that is read. A manifest holds the place of each part's first row in its log, and
the place, rows, times and tags of each of its zstd frames, so that a log is read by many tasks and only where it may hold what is asked for. The files of
collectors get the same from `index_logs`.
"""

from __future__ import annotations

import datetime
import json
import operator
import os
import re
import struct
import time
import uuid
from collections import OrderedDict
from dataclasses import dataclass, field

from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter, DataSourceStreamReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage

# Fixed values of the file format: time, tag, length of a row; names of logs.
_ROW, _HEAD = "<qBI", 13
ROW = struct.Struct(_ROW)  # the code that is sent along by value can't hold it
SCHEMA = "file string, seq long, recv_nanos long, tag_byte int, payload binary, error string"
_LOG = re.compile(r"(.+)_(\d{8})\.zst")
_PART = re.compile(r"(.+\.zst)\.[0-9a-f]{32}")
# Fixed values of the zstd format (RFC 8878).
_ZSTD, _SKIP = 0xFD2FB528, 0x184D2A50
#: Bytes of rows in a zstd frame that the sink writes, compressed bytes that one task reads, logs that a task holds open, manifests between two summaries.
FRAME, SPLIT, OPEN, SUMMARY = 4 << 20, 32 << 20, 64, 64


def _open(path: str):
    """(file system, path in it) of a URI or a local path."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return fs.LocalFileSystem(), path


def _sync(where, *paths: str) -> None:
    """Have the file system keep the files (and folders); where there is no such call, closing them does."""
    if where.type_name == "local":
        for p in paths:
            fd = os.open(p, os.O_RDONLY)
            try:
                os.fsync(fd)
            finally:
                os.close(fd)


def _put(where, path: str, data: bytes) -> str:
    draft = f"{path}.{uuid.uuid4().hex}"
    with where.open_output_stream(draft, compression=None) as f:
        f.write(data)
    _sync(where, draft)
    return draft


def _create(where, path: str, data: bytes, alone: bool = False) -> bool:
    """Put a whole file there if there is none; False if there is one. Local files and HDFS can; other stores only for a single writer."""
    if where.type_name not in ("local", "hdfs") and not alone:
        raise NotImplementedError(f"{where.type_name} can't create a file only if there is none: set the option singleWriter if no other writer commits to this folder")
    if alone and where.get_file_info(path).is_file:
        return False
    draft = _put(where, path, data)
    try:
        if where.type_name == "local":
            os.link(draft, path)  # fails if the path is there
        else:
            where.move(draft, path)  # HDFS doesn't rename to a name that is taken
    except OSError:
        if where.get_file_info(path).is_file:
            return False
        raise
    finally:
        if where.get_file_info(draft).is_file:
            where.delete_file(draft)
    _sync(where, path.rpartition("/")[0])
    return True


def _json(where, path: str) -> dict:
    with where.open_input_stream(path, compression=None) as f:
        return json.loads(f.read())


@dataclass
class State:
    """What a folder's commits up to `number` make: parts that count by name, rows of each log, names that were replaced, each stream's last batch."""

    number: int = 0
    parts: dict = field(default_factory=dict)
    rows: dict = field(default_factory=dict)
    gone: set = field(default_factory=set)
    streams: dict = field(default_factory=dict)

    def apply(self, number: int, commit: dict) -> None:
        self.number = number
        self.gone |= set(commit["replaced"])
        if commit.get("merged"):  # the same rows in fewer files
            for name in commit["replaced"]:
                self.parts.pop(name, None)
            self.parts |= {p["name"]: p for p in commit["parts"]}
            return
        for name in commit["replaced"]:
            if name in self.parts:
                self.rows.pop(self.parts.pop(name)["log"], None)
        for p in commit["parts"]:
            self.parts[p["name"]] = p
            self.rows[p["log"]] = p["first"] + sum(f[1] for f in p["frames"])
        if commit.get("stream"):
            self.streams[commit["stream"][0]] = commit["stream"][1]


def _manifest(root: str, number: int) -> str:
    return f"{root}/_commits/{number:010d}.json"


def _numbers(where, root: str) -> tuple[list[int], list[int]]:
    """Numbers of the manifests, and of the summaries."""
    from pyarrow import fs

    names = [i.base_name for i in where.get_file_info(fs.FileSelector(f"{root}/_commits", allow_not_found=True))]
    return tuple(sorted(int(n[:10]) for n in names if re.fullmatch(pattern, n)) for pattern in (r"\d{10}\.json", r"\d{10}\.summary"))


def state_of(where, root: str) -> State:
    """The newest state: that of the last summary, and the manifests behind it."""
    numbers, summaries = _numbers(where, root)
    out = State()
    if summaries:
        held = _json(where, f"{root}/_commits/{summaries[-1]:010d}.summary")
        out = State(held["number"], held["parts"], held["rows"], set(held["gone"]), held["streams"])
    for n in numbers:
        if n > out.number:
            out.apply(n, _json(where, _manifest(root, n)))
    return out


def commit_parts(folder: str, parts: list[dict], overwrite: bool = False, stream: tuple[str, int] | None = None, alone: bool = False) -> bool:
    """Make parts count, as one step: in their order behind the rows of their logs. False if that batch of the stream is there already."""
    from pyarrow import fs

    where, root = _open(folder)
    where.create_dir(f"{root}/_commits", recursive=True)
    while True:
        state = state_of(where, root)
        if stream and state.streams.get(stream[0], -1) >= stream[1]:
            return False
        replaced, rows = [], dict(state.rows)
        if overwrite:
            logs_ = {p["log"] for p in parts}
            there = [i.base_name for i in where.get_file_info(fs.FileSelector(root)) if i.type == fs.FileType.File and i.base_name in logs_ and i.base_name not in state.gone]
            replaced = sorted(there + [n for n, p in state.parts.items() if p["log"] in logs_])
            rows = {k: v for k, v in rows.items() if k not in logs_}
        new = []
        for p in parts:
            new.append(p | {"first": rows.get(p["log"], 0)})
            rows[p["log"]] = new[-1]["first"] + sum(f[1] for f in p["frames"])
        commit = {"parts": new, "replaced": replaced, "stream": stream}
        if _create(where, _manifest(root, state.number + 1), json.dumps(commit).encode(), alone):
            break
    _summarise(where, root, state, commit)
    return True


def _summarise(where, root: str, state: State, commit: dict) -> None:
    """After a commit behind `state`: now and then, its result as a file."""
    state.apply(state.number + 1, commit)
    if state.number % SUMMARY == 0:
        summary = {"number": state.number, "parts": state.parts, "rows": state.rows, "gone": sorted(state.gone), "streams": state.streams}
        where.move(_put(where, f"{root}/_commits/{state.number:010d}.summary", json.dumps(summary).encode()), f"{root}/_commits/{state.number:010d}.summary")


def clean(folder: str, hours: float = 24) -> list[str]:
    """Delete what was replaced, and parts that no manifest names, if they are older than `hours`; readers that listed them have that long to end."""
    from pyarrow import fs

    where, root = _open(folder)
    state, out = state_of(where, root), []
    for i in where.get_file_info(fs.FileSelector(root)):
        lost = i.base_name in state.gone or (_PART.fullmatch(i.base_name) and i.base_name not in state.parts)
        if i.type == fs.FileType.File and lost and i.mtime.timestamp() < time.time() - hours * 3600:
            where.delete_file(i.path)
            out.append(i.base_name)
    return sorted(out)


# ---- zstd frames and their rows


def frames(where, name: str, start: int = 0):
    """(start, end) of a file's zstd frames from `start` on, by their headers and those of their blocks, without decompression.

    The last one's end is None if the file ends within it, or if what stands there is no frame.
    """
    size = where.get_file_info(name).size
    with where.open_input_file(name) as f:

        def number(at: int, n: int) -> int:
            return int.from_bytes(f.read_at(n, at), "little") if at + n <= size else -1

        def end_of(at: int) -> int | None:
            magic = number(at, 4)
            if magic & ~0xF == _SKIP and magic > 0:
                n = number(at + 4, 4)
                return None if n < 0 or at + 8 + n > size else at + 8 + n
            flags = number(at + 4, 1)
            if magic != _ZSTD or flags < 0:
                return None
            single = flags >> 5 & 1
            at += 5 + (not single) + (0, 1, 2, 4)[flags & 3] + (single, 2, 4, 8)[flags >> 6]
            last = 0
            while not last:
                head = number(at, 3)
                last, kind = head & 1, head >> 1 & 3
                if head < 0 or kind == 3:
                    return None
                at += 3 + (1 if kind == 1 else head >> 3)
            at += 4 * (flags >> 2 & 1)
            return at if at <= size else None

        while start is not None and start < size:
            end = end_of(start)
            yield start, end
            start = end


class _Range:
    """The bytes of a file from start to end, to be read in order."""

    def __init__(self, file, start: int, end: int | None):
        self.file, self.left = file, None if end is None else end - start
        file.seek(start)

    def read(self, n: int = -1) -> bytes:
        out = self.file.read(n if self.left is None else self.left if n < 0 else min(n, self.left))
        if self.left is not None:
            self.left -= len(out)
        return out


def rows_of(path: str, start: int = 0, end: int | None = None):
    """(nanos, tag, payload) of a file's rows between two frame bounds. Stops at an end within a header; raises EOFError at one within a payload."""
    import zstandard

    size, unpack = _HEAD, struct.Struct(_ROW).unpack_from
    where, name = _open(path)
    with where.open_input_file(name) as f, zstandard.ZstdDecompressor().stream_reader(_Range(f, start, end), read_across_frames=True) as z:
        held, at, want = b"", 0, 1 << 20
        while more := z.read(want):
            held, at, want = held[at:] + more, 0, 1 << 20
            while len(held) - at >= size:
                nanos, tag, n = unpack(held, at)
                stop = at + size + n
                if stop > len(held):
                    want = max(want, stop - len(held))
                    break
                yield nanos, tag, held[at + size : stop]
                at = stop
        if len(held) - at >= size:
            raise EOFError("ends within a payload")


def scan(log: str, segments: list[tuple], first: int | None = 0):
    """Rows of a log's segments (file, start, end), the first at place `first`. An end within a header is an end; one within a payload is an error row.

    first None: its place is the number of rows before it in its file.
    """
    import zstandard

    seq = first
    try:
        if seq is None:
            seq = sum(1 for _ in rows_of(segments[0][0], 0, segments[0][1])) if segments[0][1] else 0
        for file, start, end in segments:
            for nanos, tag, payload in rows_of(file, start, end):
                yield log, seq, nanos, tag, payload, None
                seq += 1
    except EOFError as e:
        yield log, seq, None, None, None, str(e)
    except (OSError, zstandard.ZstdError) as e:
        yield log, seq, None, None, None, f"{type(e).__name__}: {e}"


def batches(rows, most: int = 8192, size: int = 4 << 20):
    """Rows of scan as Arrow batches."""
    import pyarrow as pa

    kinds = [("file", pa.string()), ("seq", pa.int64()), ("recv_nanos", pa.int64()), ("tag_byte", pa.int32()), ("payload", pa.binary()), ("error", pa.string())]

    def batch(held):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(zip(*held, strict=True), kinds, strict=True)], names=[n for n, _ in kinds])

    held, total = [], 0
    for row in rows:
        held.append(row)
        total += len(row[4] or b"")
        if len(held) >= most or total >= size:
            yield batch(held)
            held, total = [], 0
    if held:
        yield batch(held)


# ---- reading


@dataclass
class Log:
    """A log's files in their order: the collector's, if there is one, and the parts' entries. known: the collector's frames from its index."""

    name: str
    file: str | None = None
    size: int = 0
    known: dict | None = None
    parts: list = field(default_factory=list)


def logs(path: str) -> list[Log]:
    """The logs of a folder by name; a single file is its own log."""
    from pyarrow import fs

    where, root = _open(path)
    info = where.get_file_info(root)
    if info.type != fs.FileType.Directory:
        return [Log(path, path, info.size or 0)]
    state, held = state_of(where, root), {}
    indexed = {i.base_name.removesuffix(".json"): i.path for i in where.get_file_info(fs.FileSelector(f"{root}/_index", allow_not_found=True)) if i.base_name.endswith(".json")}
    for i in where.get_file_info(fs.FileSelector(root)):
        if i.type == fs.FileType.File and i.base_name.endswith(".zst") and i.base_name not in state.gone:
            known = _json(where, indexed[i.base_name]) if i.base_name in indexed else None
            held[i.base_name] = Log(f"{path}/{i.base_name}", f"{path}/{i.base_name}", i.size, known if known and known["size"] <= i.size else None)
    for name, part in state.parts.items():
        held.setdefault(part["log"], Log(f"{path}/{part['log']}")).parts.append(part | {"path": f"{path}/{name}"})
    for log in held.values():
        log.parts.sort(key=lambda p: p["first"])
    return [held[k] for k in sorted(held)]


#: Comparisons that the scan applies to tag_byte and recv_nanos before rows leave Python.
_COMPARE = {EqualTo: operator.eq, GreaterThan: operator.gt, GreaterThanOrEqual: operator.ge, LessThan: operator.lt, LessThanOrEqual: operator.le}
_AT = {"recv_nanos": 2, "tag_byte": 3}


@dataclass
class Tests:
    """Comparisons of recv_nanos and tag_byte that a row must pass: (place in the row, comparison, value)."""

    held: list = field(default_factory=list)

    def row(self, row: tuple) -> bool:
        return all(test(row[at], value) for at, test, value in self.held)

    def frame(self, low: int, high: int, tags: list[int]) -> bool:
        """Whether a frame with these times and tags may have such a row."""
        for at, test, value in self.held:
            if at == 3 and not any(test(t, value) for t in tags):
                return False
            if at == 2 and not (low <= value <= high if test is operator.eq else test(high, value) if test in (operator.gt, operator.ge) else test(low, value)):
                return False
        return True

    def name(self, log: str) -> bool:
        """Whether a collector's file may have such a row: it has none of a later day than its name's, but may have some of any earlier day."""
        day = _LOG.fullmatch(log.rpartition("/")[2])
        for at, test, value in self.held if day else ():
            if at == 2 and test in (operator.eq, operator.gt, operator.ge):
                if day[2] < (datetime.datetime(1970, 1, 1) + datetime.timedelta(seconds=value // 10**9)).strftime("%Y%m%d"):
                    return False
        return True


@dataclass
class Split(InputPartition):
    """What one task reads: segments (file, start, end) of a log, and the place of their first row."""

    log: str
    segments: list
    first: int | None = 0


def _splits(log: str, file: str, known: list, end: int | None, first: int, tests: Tests, most: int) -> list[Split]:
    """Neighbouring frames of a file that may hold wanted rows, up to `most` bytes of them together. known: [start, rows, low, high, tags] a frame."""
    out, begin, place, open_ = [], None, first, None
    for k, (start, rows, low, high, tags) in enumerate(known):
        stop = known[k + 1][0] if k + 1 < len(known) else end
        if tests.frame(low, high, tags):
            if open_ is None or (stop or 0) - begin > most:
                open_, begin = Split(log, [(file, start, stop)], place), start
                out.append(open_)
            else:
                open_.segments = [(file, begin, stop)]
        else:
            open_ = None
        place += rows
    return out


def splits(log: Log, tests: Tests, most: int = SPLIT) -> list[Split]:
    """A log's tasks, without what the frames' times and tags, or its name's day, rule out.

    A file without an index is one task. If parts stand behind it, their places follow from its rows, so then they are in that task, too.
    """
    out, first = [], 0
    if log.file:
        known = log.known or {"size": 0, "frames": []}
        rest = [(log.file, known["size"], None)] if known["size"] < log.size or not log.known else []
        if log.parts and rest:
            return [Split(log.name, [(log.file, 0, None), *((p["path"], 0, None) for p in log.parts)])]
        if tests.name(log.name):
            out += _splits(log.name, log.file, known["frames"], known["size"], 0, tests, most)
            out += [Split(log.name, rest, sum(f[1] for f in known["frames"]))] if rest else []
        first = sum(f[1] for f in known["frames"])
    for p in log.parts:
        out += _splits(log.name, p["path"], p["frames"], p["size"], first + p["first"], tests, most)
    return out


class FrameLogReader(DataSourceReader):
    """Options: mode (PERMISSIVE: what can't be read is a row with an error; FAILFAST), splitBytes."""

    def __init__(self, options):
        self.logs = [log for part in options.get("path", "").split(",") for log in logs(part)]
        self.strict, self.most = options.get("mode", "PERMISSIVE").upper() == "FAILFAST", int(options.get("splitBytes", SPLIT))
        self.tests = Tests()

    def pushFilters(self, filters):
        for f in filters:
            name = ".".join(getattr(f, "attribute", ()))
            if name == "file" and isinstance(f, EqualTo | In):
                wanted = set(f.value if isinstance(f, In) else [f.value])
                self.logs = [x for x in self.logs if x.name in wanted]  # other files are not opened
            elif type(f) in _COMPARE and name in _AT:
                self.tests.held.append((_AT[name], _COMPARE[type(f)], f.value))
            yield f  # Spark looks again

    def partitions(self):
        return [s for log in self.logs for s in splits(log, self.tests, self.most)] or [Split("", [])]

    def read(self, partition):
        yield from batches(_wanted(scan(partition.log, partition.segments, partition.first), self.strict, self.tests))


def _wanted(rows, strict: bool, tests: Tests):
    for row in rows:
        if row[5] and strict:
            raise ValueError(f"{row[0]}: {row[5]}")
        if row[5] or tests.row(row):
            yield row


class FrameLogStream(DataSourceStreamReader):
    """A folder's rows as a stream: the parts of each new commit, and what collectors add to their files, a whole zstd frame at a time.

    The offset is the last commit that was read, and the bytes that were read of each collector's file. A file is followed as long as its symbol's newest day
    is no more than keepDays ahead; older ones, once read to their end, are only counted, for each symbol, and if one of those grows, the query stops with an error
    rather than leave rows out. A file whose last frame is cut is read to its end when its symbol has a newer file.

    Spark asks for the latest offset before it says where the query stands. A process's first answer is therefore a name; what it stands for is settled, within the
    limit, when the batch is planned, and kept in the folder `offsets` until later offsets are committed.

    seq is the place in the log, as in batch. For a log that has a collector's file and parts, parts count from 0 of their own.

    Options: maxFilesPerTrigger (a commit counts with its parts and is never split), keepDays, mode, splitBytes, offsets (a folder; by default _readers in the log's).
    """

    def __init__(self, options):
        self.path, self.strict = options["path"], options.get("mode", "PERMISSIVE").upper() == "FAILFAST"
        self.limit, self.keep, self.most = int(options.get("maxFilesPerTrigger", 0)), int(options.get("keepDays", 3)), int(options.get("splitBytes", SPLIT))
        self.offsets = options.get("offsets", f"{self.path}/_readers")
        self.at, self.said, self.names, self.later = None, {"at": json.dumps({"name": uuid.uuid4().hex})}, set(), 0

    def initialOffset(self):
        return {"at": json.dumps({"commit": 0, "files": {}, "closed": {}})}

    def _resolve(self, offset: dict, after: dict | None = None) -> dict:
        """What an offset stands for. A name that isn't settled yet becomes what may be read after `after`."""
        at = json.loads(offset["at"])
        if "name" not in at:
            return at
        where, root = _open(self.offsets)
        path = f"{root}/{at['name']}.json"
        self.names.add(path)
        if not where.get_file_info(path).is_file:
            if after is None:
                raise ValueError(f"{self.offsets} has lost the offset {at['name']}")
            where.create_dir(root, recursive=True)
            where.move(_put(where, path, json.dumps(self._advance(after)).encode()), path)
        return _json(where, path)

    def _followed(self, where, root, at: dict):
        """(name, size, whether its symbol has a newer file) of the collectors' files that are still followed."""
        from pyarrow import fs

        gone = state_of(where, root).gone
        held = [i for i in where.get_file_info(fs.FileSelector(root, allow_not_found=True)) if i.type == fs.FileType.File and i.base_name.endswith(".zst") and i.base_name not in gone]
        newest, closed = {}, {}
        for i in held:
            if m := _LOG.fullmatch(i.base_name):
                newest[m[1]] = max(newest.get(m[1], ""), m[2])
        out = []
        for i in sorted(held, key=lambda i: i.base_name):
            m = _LOG.fullmatch(i.base_name)
            if m and m[1] in at["closed"] and m[2] <= at["closed"][m[1]][0]:
                sums = closed.setdefault(m[1], [0, 0])
                sums[0], sums[1] = sums[0] + 1, sums[1] + i.size
            else:
                out.append((i.base_name, i.size, bool(m) and m[2] < newest[m[1]]))
        for symbol, (count, size) in closed.items():
            if count > at["closed"][symbol][1] or size > at["closed"][symbol][2]:
                raise ValueError(f"{self.path}: files of {symbol} that were read to their end, up to {at['closed'][symbol][0]}, have grown")
        return out, newest

    def latestOffset(self):
        if self.at is not None and (now := self._advance(self.at)) != self.at:
            self.at, self.said = now, {"at": json.dumps(now, sort_keys=True)}
        return self.said

    def _advance(self, at: dict) -> dict:
        """The offset behind `at`, as far as there is something and the limit goes."""
        where, root = _open(self.path)
        now, left = json.loads(json.dumps(at)), self.limit or 1 << 60
        for n in _numbers(where, root)[0]:
            if n > now["commit"] and left > 0:
                left -= max(1, len(_json(where, _manifest(root, n))["parts"]))
                now["commit"] = n
        followed, newest = self._followed(where, root, now)
        for name, size, over in followed:
            begin = now["files"].get(name, 0)
            if left <= 0 or begin >= size:
                continue
            end = begin
            for _, stop in frames(where, f"{root}/{name}", begin):
                end = stop if stop is not None else size if over or self._broken(where, f"{root}/{name}", end) else end
            if end > begin:
                now["files"][name] = end
                left -= 1
        self._compact(now, {name: size for name, size, _ in followed}, newest)
        return now

    @staticmethod
    def _broken(where, name: str, at: int) -> bool:
        """Whether what stands there can't become a frame, whatever follows."""
        with where.open_input_file(name) as f:
            head = f.read_at(4, at)
        return len(head) == 4 and int.from_bytes(head, "little") != _ZSTD and int.from_bytes(head, "little") & ~0xF != _SKIP

    def _compact(self, now: dict, sizes: dict, newest: dict) -> None:
        """Files of old days that were read to their end become a count and a sum of their symbol's, oldest first."""
        waits = set()
        for name in sorted(sizes):
            m = _LOG.fullmatch(name)
            if not m or m[1] in waits:
                continue
            age = datetime.datetime.strptime(newest[m[1]], "%Y%m%d") - datetime.datetime.strptime(m[2], "%Y%m%d")
            if age.days <= self.keep or now["files"].get(name, 0) < sizes[name]:
                waits.add(m[1])
                continue
            count = now["closed"].setdefault(m[1], ["", 0, 0])
            now["closed"][m[1]] = [m[2], count[1] + 1, count[2] + sizes[name]]
            now["files"].pop(name, None)

    def partitions(self, start, end):
        a = self._resolve(start)
        b = self._resolve(end, a)
        if self.at is None:
            self.at, self.said = b, end
        where, root = _open(self.path)
        out, commits = [], [_json(where, _manifest(root, n)) for n in range(a["commit"] + 1, b["commit"] + 1)]
        commits = [c for c in commits if not c.get("merged")]  # no new rows; what they replaced stays until `clean`
        gone = {name for c in commits for name in c["replaced"]}
        for c in commits:
            for p in c["parts"]:
                if p["name"] not in gone:
                    out += _splits(f"{self.path}/{p['log']}", f"{self.path}/{p['name']}", p["frames"], p["size"], p["first"], Tests(), self.most)
        done = lambda o, name: o["files"].get(name, 0)
        closing = [n for n in a["files"] if n not in b["files"]]  # read to the end by then, and no longer followed
        for name in [*b["files"], *closing, *self._closed_between(where, root, a, b)]:
            stop = done(b, name) if name in b["files"] else where.get_file_info(f"{root}/{name}").size
            if stop > done(a, name):
                out.append(Split(f"{self.path}/{name}", [(f"{self.path}/{name}", done(a, name), stop)], None))
        return out

    @staticmethod
    def _closed_between(where, root, a: dict, b: dict) -> list[str]:
        """Files that were first read and closed between two offsets."""
        from pyarrow import fs

        out = []
        for i in where.get_file_info(fs.FileSelector(root)) if b["closed"] != a["closed"] else ():
            m = _LOG.fullmatch(i.base_name)
            if m and m[1] in b["closed"] and a["closed"].get(m[1], [""])[0] < m[2] <= b["closed"][m[1]][0] and i.base_name not in a["files"]:
                out.append(i.base_name)
        return sorted(out)

    def read(self, partition):
        yield from batches(_wanted(scan(partition.log, partition.segments, partition.first), self.strict, Tests()))

    def commit(self, end):
        self.later += "name" not in json.loads(end["at"])
        if self.later > 1 and self.names:  # a restart begins behind them now
            where, _ = _open(self.offsets)
            for path in self.names:
                if where.get_file_info(path).is_file:
                    where.delete_file(path)
            self.names = set()


# ---- writing


@dataclass
class _Written(WriterCommitMessage):
    parts: list


class _Part:
    """A part that is being written: zstd frames of about FRAME bytes of rows, with what each holds."""

    def __init__(self, where, root: str, log: str, level: int, frame: int):
        import zstandard

        self.log, self.name, self.frame = log, f"{log}.{uuid.uuid4().hex}", frame
        self.where, self.path = where, f"{root}/{self.name}"
        self.raw = where.open_output_stream(self.path, compression=None)
        self.z, self.end = zstandard.ZstdCompressor(level=level).stream_writer(self.raw, closefd=False), zstandard.FLUSH_FRAME
        self.frames, self.held, self.bytes = [], None, 0

    def write(self, nanos, tags, payloads) -> None:
        """Rows as numpy arrays of times and tags, and a list of bytes."""
        import numpy as np

        sizes = np.fromiter(map(len, payloads), np.int64, len(payloads))
        heads = np.empty(len(sizes), [("nanos", "<i8"), ("tag", "u1"), ("size", "<u4")])
        heads["nanos"], heads["tag"], heads["size"] = nanos, tags, sizes
        raw, ends, at = heads.tobytes(), np.cumsum(sizes + _HEAD), 0
        while at < len(sizes):
            before = int(ends[at - 1]) if at else 0
            stop = min(len(sizes), int(np.searchsorted(ends, before + self.frame - self.bytes, "left")) + 1)
            if self.held is None:
                self.held = [self.raw.tell(), 0, int(nanos[at]), int(nanos[at]), set()]
            self.z.write(b"".join(x for k in range(at, stop) for x in (raw[_HEAD * k : _HEAD * (k + 1)], payloads[k])))
            f, own = self.held, nanos[at:stop]
            f[1], f[2], f[3] = f[1] + stop - at, min(f[2], int(own.min())), max(f[3], int(own.max()))
            f[4].update(np.unique(tags[at:stop]).tolist())
            self.bytes += int(ends[stop - 1]) - before
            at = stop
            if self.bytes >= self.frame:
                self.cut()

    def cut(self) -> None:
        if self.held:
            self.z.flush(self.end)
            self.frames.append([*self.held[:4], sorted(self.held[4])])
            self.held, self.bytes = None, 0

    def close(self) -> dict:
        self.cut()
        size = self.raw.tell()
        self.raw.close()
        _sync(self.where, self.path)
        return {"name": self.name, "log": self.log, "size": size, "frames": self.frames}


class _Parts:
    """What batch and streaming writers share. Columns symbol, file_date, recv_nanos, tag_byte, payload; other columns are not written.

    A log's rows keep their order within a task, and the tasks' parts that of the tasks. No data goes through the driver. Options: level, frameBytes,
    singleWriter (for stores that can't create a file only if there is none).
    """

    def __init__(self, options):
        self.folder, self.level, self.frame = options["path"], int(options.get("level", "1")), int(options.get("frameBytes", FRAME))
        self.alone = options.get("singleWriter", "false").lower() == "true"

    def write(self, iterator):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        where, root = _open(self.folder)
        where.create_dir(root, recursive=True)
        open_, done, order = OrderedDict(), [], {}
        task = TaskContext.get().partitionId()

        def close(part):
            done.append((part.log, task, order[part.name], part.close()))

        def part_of(log):
            if log not in open_:
                if len(open_) >= OPEN:
                    close(open_.popitem(last=False)[1])
                open_[log] = _Part(where, root, log, self.level, self.frame)
                order[open_[log].name] = len(order)
            open_.move_to_end(log)
            return open_[log]

        for b in iterator:
            held = {n: b.column(n) for n in ("symbol", "file_date", "recv_nanos", "tag_byte", "payload")}
            if any(held[n].null_count for n in ("symbol", "file_date", "recv_nanos", "tag_byte")):
                raise ValueError("null in symbol, file_date, recv_nanos or tag_byte")
            names = pc.binary_join_element_wise(held["symbol"].cast(pa.string()), held["file_date"].cast(pa.string()), "_").dictionary_encode()
            codes = names.indices.to_numpy()
            rows = np.argsort(codes, kind="stable")  # a log's rows together, in their order
            nanos, tags = (held[n].cast(pa.int64()).to_numpy()[rows] for n in ("recv_nanos", "tag_byte"))
            payloads = held["payload"].cast(pa.binary()).fill_null(b"").take(pa.array(rows)).to_pylist()
            cuts = np.searchsorted(codes[rows], np.arange(len(names.dictionary) + 1))
            for name, lo, hi in zip(names.dictionary.to_pylist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                part_of(f"{name}.zst").write(nanos[lo:hi], tags[lo:hi], payloads[lo:hi])
        for part in open_.values():
            close(part)
        return _Written(done)

    def _parts(self, messages) -> list[dict]:
        return [x[3] for x in sorted((x for m in messages if m for x in m.parts), key=lambda x: x[:3])]

    def _drop(self, messages) -> None:
        where, root = _open(self.folder)
        for p in self._parts(messages):
            if where.get_file_info(f"{root}/{p['name']}").is_file:
                where.delete_file(f"{root}/{p['name']}")


class FrameLogWriter(_Parts, DataSourceArrowWriter):
    """Overwriting replaces the logs that are written, not others; their files stay until `clean`. With the options sinkId and batchId, as from foreachBatch, a
    batch that is there already is not written again."""

    def __init__(self, options, overwrite):
        super().__init__(options)
        self.overwrite = overwrite
        self.stream = (options["sinkId"], int(options["batchId"])) if "sinkId" in options and "batchId" in options else None

    def commit(self, messages):
        parts = self._parts(messages)
        if parts and not commit_parts(self.folder, parts, self.overwrite, self.stream, self.alone):
            self._drop(messages)

    def abort(self, messages):
        self._drop(messages)


class FrameLogStreamWriter(_Parts, DataSourceStreamArrowWriter):
    """Each batch is one commit that holds the query's name and the batch's number, so a batch that is run again is there once.

    The query's name is its checkpoint folder, or the option sinkId.
    """

    def __init__(self, options):
        super().__init__(options)
        self.query = options.get("sinkId") or options.get("checkpointLocation")
        if not self.query:
            raise ValueError("set checkpointLocation, or sinkId, on the query: its batches are told apart by it")

    def commit(self, messages, batchId):
        parts = self._parts(messages)
        if parts and not commit_parts(self.folder, parts, stream=(self.query, batchId), alone=self.alone):
            self._drop(messages)

    def abort(self, messages, batchId):
        self._drop(messages)


class FrameLog(DataSource):
    @classmethod
    def name(cls):
        return "framelog"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return FrameLogReader(self.options)

    def streamReader(self, schema):
        return FrameLogStream(self.options)

    def writer(self, schema, overwrite):
        return FrameLogWriter(self.options, overwrite)

    def streamWriter(self, schema, overwrite):
        return FrameLogStreamWriter(self.options)


def register(spark) -> None:
    """Make the format known. Its code goes along by value: the processes that plan a stream don't have this package."""
    import sys

    from pyspark import cloudpickle

    from tickweave.plans.session import ship

    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # stays so: writers in several threads register, too
    spark.dataSource.register(FrameLog)


def write_log(records, folder: str, mode: str = "append", tasks: int | None = None, **options) -> None:
    """Records (symbol, file_date, recv_nanos, tag_byte, payload, seq) into a log for each symbol and day, in the order of seq.

    The records are dealt out by ranges of symbol, day and seq, so that a large log is many tasks' parts, each behind the one before; Spark reads them a second time
    for the ranges' bounds. Records that are few by the optimizer's estimate are dealt out by log, unless `tasks` is given.
    """
    from tickweave.operators.blocks import few

    register(records.sparkSession)
    by = ["symbol", "file_date", "seq"]
    dealt = records.repartition(*by[:2]) if not tasks and few(records) else records.repartitionByRange(*([tasks] if tasks else []), *by)
    rows = dealt.sortWithinPartitions(*by)
    rows.select("symbol", "file_date", "recv_nanos", "tag_byte", "payload").write.format("framelog").options(**options).mode(mode).save(folder)


def compact(spark, folder: str, most: int = 1 << 30) -> int:
    """Make neighbouring parts of each log one, of up to `most` bytes: the number of parts that were merged into others.

    zstd frames are copied as they are, by a task a new part, and the places of rows and frames stay known. Readers see the old parts or the new one; if
    another commit has replaced some of them meanwhile, nothing is done. A stream reads the old parts, so `clean` must leave it time to do so.
    """
    register(spark)
    where, root = _open(folder)
    state, groups = state_of(where, root), []
    for p in sorted(state.parts.values(), key=lambda p: (p["log"], p["first"])):
        last = groups[-1] if groups else None
        if last and last[-1]["log"] == p["log"] and sum(x["size"] for x in last) + p["size"] <= most:
            last.append(p)
        else:
            groups.append([p])
    groups = [g for g in groups if len(g) > 1]
    if not groups:
        return 0
    tasks = [(k, f"{g[0]['log']}.{uuid.uuid4().hex}", [p["name"] for p in g]) for k, g in enumerate(groups)]
    frame = spark.createDataFrame(tasks, "k int, name string, parts array<string>").repartition(min(len(tasks), 1000), "k")

    def copy(rows):
        to, top = _open(folder)
        for r in rows:
            with to.open_output_stream(f"{top}/{r.name}", compression=None) as out:
                for part in r.parts:
                    with to.open_input_stream(f"{top}/{part}", compression=None) as f:
                        while more := f.read(1 << 20):
                            out.write(more)
            _sync(to, f"{top}/{r.name}")

    frame.foreachPartition(copy)
    made = []
    for (_, name, _), g in zip(tasks, groups, strict=True):
        held, at = [], 0
        for p in g:
            held += [[at + f[0], *f[1:]] for f in p["frames"]]
            at += p["size"]
        made.append({"name": name, "log": g[0]["log"], "size": at, "frames": held, "first": g[0]["first"]})
    commit = {"parts": made, "replaced": [p["name"] for g in groups for p in g], "stream": None, "merged": True}
    while all(name in state.parts for name in commit["replaced"]):
        if _create(where, _manifest(root, state.number + 1), json.dumps(commit).encode()):
            _summarise(where, root, state, commit)
            return len(commit["replaced"]) - len(made)
        state = state_of(where, root)
    for p in made:
        where.delete_file(f"{root}/{p['name']}")
    return 0


def index_logs(spark, folder: str) -> None:
    """Write what each zstd frame of the collectors' files holds to `_index`, so that they are read by many tasks and pruned like parts.

    Each file's frames are found by their headers in one task, and their rows are counted in tasks of their own. The index ends before the first frame whose
    rows don't end with it, or that can't be read: from there on a file is one task's. A file that has grown since is read on behind its index.
    """
    from pyspark.sql import functions as F

    register(spark)
    files = [(x.file, x.size) for x in logs(folder) if x.file]
    if not files:
        return
    found = spark.createDataFrame(files, "file string, size long").repartition(min(len(files), 1000))

    def walk(batches_):
        import pyarrow as pa

        for b in batches_:
            for file in b.column(0).to_pylist():
                where, name = _open(file)
                held = [(file, s, e) for s, e in frames(where, name) if e is not None]
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in held], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64()))], names=["file", "start", "stop"])

    def count(batches_):
        import pyarrow as pa
        import zstandard

        for b in batches_:
            out = []
            for file, start, stop in zip(*(c.to_pylist() for c in b.columns), strict=True):
                n, low, high, tags, size = 0, 0, 0, set(), 0
                try:
                    for nanos, tag, payload in rows_of(file, start, stop):
                        n, low, high, size = n + 1, min(low, nanos) if n else nanos, max(high, nanos) if n else nanos, size + _HEAD + len(payload)
                        tags.add(tag)
                    whole = size == _raw_size(file, start, stop)
                except (EOFError, OSError, zstandard.ZstdError):
                    whole = False
                out.append((file, start, stop, n, low, high, sorted(tags), whole))
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate(kinds)], names=["file", "start", "stop", "n", "low", "high", "tags", "whole"])

    held = found.select("file").mapInArrow(walk, "file string, start long, stop long").repartition("file", "start")
    counted = held.mapInArrow(count, "file string, start long, stop long, n long, low long, high long, tags array<int>, whole boolean")
    each = counted.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("start", "stop", "n", "low", "high", "tags", "whole"))).alias("held"))

    def write(rows):
        for r in rows:
            where, name = _open(r.file)
            top, _, base = name.rpartition("/")
            good = []
            for f in r.held:
                if not f.whole:
                    break
                good.append(f)
            index = {"size": good[-1].stop if good else 0, "frames": [[f.start, f.n, f.low, f.high, f.tags] for f in good]}
            where.create_dir(f"{top}/_index", recursive=True)
            path = f"{top}/_index/{base}.json"
            where.move(_put(where, path, json.dumps(index).encode()), path)

    each.foreachPartition(write)


def _raw_size(path: str, start: int, stop: int) -> int:
    """Decompressed bytes between two frame bounds."""
    import zstandard

    where, name = _open(path)
    total = 0
    with where.open_input_file(name) as f, zstandard.ZstdDecompressor().stream_reader(_Range(f, start, stop), read_across_frames=True) as z:
        while more := z.read(1 << 20):
            total += len(more)
    return total
