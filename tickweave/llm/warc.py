"""Legacy archive converter: ARC records to WARC records, archives in the shared folder."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from datetime import UTC, datetime, timedelta
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.llm.common import row_salt, salted_join
from tickweave.plans.session import fresh_path, saved, ship, shuffle_parts, table

#: The two versions' record header fields, as the file's first record names them.
ARC_FIELDS = {1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"], 2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"]}
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_ID = "#!page="
#: What stays as it is in a URL, percent signs included.
_SAFE = "%/:=&?~#+!$,;'@()*[]"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def arc_header(version: int, name: str) -> bytes:
    """The file's first record: its version block names the header fields of those that follow."""
    body = f"{version} 0 tickweave\n{' '.join(ARC_FIELDS[version])}\n".encode()
    line = f"filedesc://{name} 0.0.0.0 20000101000000 text/plain"
    return (line + (" 200 - - 0 " + name if version == 2 else "") + f" {len(body)}\n").encode() + body + b"\n"


def arc_record(version: int, url: str, when: str, body: bytes, name: str) -> bytes:
    line = f"{url} 0.0.0.0 {when} text/html" + (f" 200 - - 0 {name}" if version == 2 else "") + f" {len(body)}\n"
    return line.encode() + body + b"\n"


def _date(stamp: str) -> datetime:
    return datetime.strptime(stamp.ljust(14, "0")[:14], "%Y%m%d%H%M%S").replace(tzinfo=UTC)


def _head(line: bytes, fields: list[str]) -> dict[str, str]:
    """A record's header fields. Only the URL, which comes first, may hold spaces."""
    parts = line.rstrip(b"\r\n").decode("utf-8", "replace").rsplit(" ", len(fields) - 1)
    if len(parts) != len(fields):
        raise ValueError(f"header line of {len(parts)} fields in place of {len(fields)}")
    head = dict(zip(fields, parts, strict=True))
    if not head["URL"].strip() or not re.fullmatch(r"\d{1,18}", head["Archive-length"]) or not re.fullmatch(r"\d{8,17}", head["Archive-date"]):
        raise ValueError("header line without a URL, date or length")
    _date(head["Archive-date"])
    return head


def read_arc(f, bad: Callable[[int, bytes, str], None] | None = None) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, content) of each record but the first, of a file with read and readline. Lengths are as declared.

    bad(place, line, what): is told of lines that are no header line of the file's version, behind which the next one that is is looked for, of a
    record that the file's end cuts short, and of a file whose version is unknown, which has no records. Without `bad` these are errors.
    """

    def wrong(at: int, line: bytes, what: str) -> None:
        if bad is None:
            raise ValueError(f"ARC: {what}")
        bad(at, line, what)

    line = f.readline()
    at = len(line)
    if not line:
        return
    try:
        size = int(line.rsplit(b" ", 1)[1])
        block = f.read(size).decode("utf-8", "replace").split("\n")
        version, fields = int(block[0].split(" ")[0]), block[1].split(" ") if len(block) > 1 else []
        if fields != ARC_FIELDS.get(version):
            raise ValueError(f"version {version} with fields {fields}")
    except (ValueError, IndexError) as e:
        wrong(0, line, str(e))
        return
    at += size
    while line := f.readline():
        place, at = at, at + len(line)
        if line in (b"\n", b"\r\n"):  # parts the records
            continue
        try:
            head = _head(line, fields)
        except ValueError as e:
            wrong(place, line, str(e))
            continue
        size = int(head["Archive-length"])
        content = f.read(size)
        at += len(content)
        if len(content) < size:
            wrong(place, line, "record shorter than its declared length")
            return
        yield head, content


def payload_of(content: bytes) -> tuple[bytes, bytes]:
    """(HTTP header, payload) of a record; what doesn't begin as HTTP, such as a DNS answer, is all payload."""
    if not content.startswith(b"HTTP/"):
        return b"", content
    http, mark, payload = content.partition(b"\r\n\r\n")
    return (http + mark, payload) if mark else (content, b"")


def _record(lines: list[str], block: bytes) -> bytes:
    return "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(block)}"]).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _stamp(date: datetime) -> str:
    return date.strftime("%Y-%m-%dT%H:%M:%SZ")


def warcinfo(name: str) -> bytes:
    """The record that a WARC file begins with."""
    block = b"software: tickweave\r\nformat: WARC File Format 1.1\r\nconformsTo: http://iipc.github.io/warc-specifications/specifications/warc-format/warc-1.1/\r\n"
    return _record(["WARC-Type: warcinfo", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(_SPACE, name + '/info')}>", f"WARC-Date: {_stamp(datetime.now(UTC))}", f"WARC-Filename: {name}.warc.gz", "Content-Type: application/warc-fields"], block)


def to_warc(head: dict[str, str], content: bytes, name: str, original: tuple[str, str] | None = None) -> bytes:
    """One WARC/1.1 record for one ARC record: a response if it is HTTP, else a resource of the ARC's content type; with `original`, the URL and ARC date of the
    record that has its payload, a revisit of that.

    name: the record's place, unlike any other's; its identifier is made of it.
    """
    http, payload = payload_of(content)
    block = http if original is not None else content
    lines = [f"WARC-Type: {'revisit' if original is not None else 'response' if http else 'resource'}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(_SPACE, name)}>", f"WARC-Date: {_stamp(_date(head['Archive-date']))}", f"WARC-Target-URI: {quote(head['URL'], safe=_SAFE)}", f"WARC-IP-Address: {head['IP-address']}"]
    lines += [f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}", f"WARC-Block-Digest: sha1:{base32_sha1(block)}", f"X-Payload-Length: {len(payload)}"]
    if original is not None:
        lines += [f"WARC-Refers-To-Target-URI: {quote(original[0], safe=_SAFE)}", f"WARC-Refers-To-Date: {_stamp(_date(original[1]))}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    kind = "application/http; msgtype=response" if http else re.sub(r"[^!-~]", "", head["Content-type"]) or "application/octet-stream"
    return _record([*lines, f"Content-Type: {kind}"], block)


def read_warc(raw: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header, block) of each record of a .warc.gz with a gzip member a record; raw: its bytes in pieces."""
    engine, parts = zlib.decompressobj(31), []
    for piece in raw:
        while piece:
            parts.append(engine.decompress(piece))
            piece = engine.unused_data
            if engine.eof:
                data = b"".join(parts)
                top, _, rest = data.partition(b"\r\n\r\n")
                head = dict(x.split(": ", 1) for x in top.decode().split("\r\n")[1:])
                n = int(head["Content-Length"])
                if len(rest) != n + 4:
                    raise ValueError("WARC record unlike its declared length")
                yield head, rest[:n]
                engine, parts = zlib.decompressobj(31), []
    if parts:
        raise ValueError("WARC file ends within a record")


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


class _Archives:
    """WARC archives of about archive_bytes, a gzip member a record, written under a name of their own and then renamed."""

    def __init__(self, path: str, archive_bytes: int):
        self.where, self.root = _open(path)
        self.where.create_dir(self.root, recursive=True)
        self.archive_bytes = archive_bytes
        self._begin()

    def _begin(self) -> None:
        self.name, self.members, self.size = uuid.uuid4().hex, [], 0

    @staticmethod
    def _packed(record: bytes) -> bytes:
        engine = zlib.compressobj(1, zlib.DEFLATED, 31)
        return engine.compress(record) + engine.flush()

    def add(self, head: dict[str, str], content: bytes, original: tuple[str, str] | None) -> Iterator[pa.RecordBatch]:
        self.members.append(self._packed(to_warc(head, content, f"{self.name}/{len(self.members)}", original)))
        self.size += len(self.members[-1])
        if self.size >= self.archive_bytes:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        """The manifest's row of what is held; the warcinfo record doesn't count."""
        if not self.members:
            return
        file = f"{self.root}/{self.name}"
        with self.where.open_output_stream(f"{file}.tmp", compression=None) as f:
            f.write(self._packed(warcinfo(self.name)))
            for m in self.members:
                f.write(m)
        self.where.move(f"{file}.tmp", f"{file}.warc.gz")
        yield pa.RecordBatch.from_arrays([pa.array([f"{file}.warc.gz"]), pa.array([len(self.members)], pa.int64())], names=["file", "records"])
        self._begin()


def archive_url(page, url: str | None) -> str:
    """What the header line can hold: the URL without white space, and the page's id as a fragment."""
    return quote(url or "about:blank", safe=_SAFE) + _ID + ("" if page is None else str(page))


def _archived(page) -> str:
    """A page's ARC date, made of its id."""
    return (datetime(2000, 1, 1, tzinfo=UTC) + timedelta(seconds=(page or 0) % 10**9)).strftime("%Y%m%d%H%M%S")


def convert(pages: DataFrame, path: str, archive_bytes: int = 32 << 20, min_bytes: int = 0) -> DataFrame:
    """Write pages (page_id, url, html) as ARC records, convert those, write WARC archives; the manifest (file, records).

    Of records whose payloads are equal, of min_bytes at least, that with the largest page_id is a response and
    the others are revisits of it. Archives of about archive_bytes are written under a name of their own and
    then renamed, and only those in the manifest count, so a task that ran twice leaves no record twice.
    Even page_ids go through ARC version 1, odd and null ones through version 2.

    Null html is an empty payload, a null url is about:blank, a null page_id is smaller than any; repeated rows
    whose page_id is their group's largest are all responses; an empty table gives no archive.
    """
    spark = pages.sparkSession
    ship(spark)
    base = pages.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "utf-8").alias("html"))
    base = base.withColumn("_digest", F.concat(F.sha1("html"), F.length("html").cast("string")))
    groups = base.filter(F.length("html") >= min_bytes).groupBy("_digest").agg(F.max("page_id").alias("first"), F.max_by("url", "page_id").alias("first_url"), F.count("*").alias("n")).filter("n > 1").drop("n")
    rows = salted_join(base, groups, "_digest", row_salt(), "left").select("page_id", "url", "html", "first", "first_url")

    def run(batches):
        out = _Archives(path, archive_bytes)
        for b in batches:
            step = max(1, int(b.num_rows * (8 << 20) / max(b.nbytes, 1)))
            for at in range(0, b.num_rows, step):
                arcs = {v: [arc_header(v, f"part{v}.arc")] for v in ARC_FIELDS}
                originals = {}
                for page, url, html, first, first_url in zip(*(c.to_pylist() for c in b.slice(at, step).columns), strict=True):
                    name = archive_url(page, url)
                    if first is not None and first != page:
                        originals[name] = archive_url(first, first_url), _archived(first)
                    when = _archived(page)
                    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(html)
                    v = 1 if page is not None and page % 2 == 0 else 2
                    arcs[v].append(arc_record(v, name, when, http + html, f"part{v}.arc"))
                for parts in arcs.values():
                    for head, content in read_arc(io.BytesIO(b"".join(parts))):
                        yield from out.add(head, content, originals.get(head["URL"]))
        yield from out.flush()

    return rows.mapInArrow(run, "file string, records long")


def _arc_file(path: str):
    """An ARC file, packed or not, as one that is read in order."""
    where, name = _open(path)
    f = io.BufferedReader(where.open_input_stream(name, compression=None), 1 << 20)
    return gzip.GzipFile(fileobj=f) if f.peek(2)[:2] == b"\x1f\x8b" else f


def arc_records(spark, folder: str) -> DataFrame:
    """file, number, url, archived, payload_bytes, payload_digest, error of each record of a folder's *.arc and *.arc.gz files, each read in one task, as a stream.

    What can't be read is a row with an error: number is its place in the file, url the line, cut after 1,000 characters, and the rest null.
    """
    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.arc*").option("recursiveFileLookup", "true").load(folder).select("path")

    def run(batches):
        for b in batches:
            for path in b.column(0).to_pylist():
                out = []
                wrong = lambda at, line, what, out=out: out.append((at, line[:4000].decode("utf-8", "replace")[:1000], None, None, None, what))
                with _arc_file(path) as f:
                    for number, (head, content) in enumerate(read_arc(f, wrong)):
                        payload = payload_of(content)[1]
                        out.append((number, head["URL"], head["Archive-date"], len(payload), base32_sha1(payload), None))
                kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string())
                arrays = [pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(out), pa.string()), *arrays], names=["file", "number", "url", "archived", "payload_bytes", "payload_digest", "error"])

    return files.repartition(shuffle_parts(spark), "path").mapInArrow(run, "file string, number long, url string, archived string, payload_bytes long, payload_digest string, error string")


def convert_folder(spark, folder: str, path: str, archive_bytes: int = 32 << 20, min_bytes: int = 0) -> tuple[DataFrame, DataFrame]:
    """Convert a folder's ARC files to WARC archives at `path`; the manifest (file, records), and what couldn't be read (the rows of arc_records with an error).

    Of records whose payloads are equal, of min_bytes at least, the one archived first (then by URL, file and number) stays as it is, the others are revisits
    of it. The records are read twice: for their digests, and to be converted; only a row without content a record is shuffled. An ARC file is one
    task's. A folder without records gives no archive; a bad line, a cut record or a file of an unknown version costs itself alone.
    """
    index = saved(arc_records(spark, folder), "arc-records")
    good = index.filter("error is null").drop("error")
    group = F.struct("payload_digest", "payload_bytes")
    groups = good.filter(F.col("payload_bytes") >= min_bytes).groupBy(group.alias("_group")).agg(F.min(F.struct("archived", "url", "file", "number")).alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    rows = salted_join(good.withColumn("_group", group), groups, "_group", row_salt(), "left")
    is_first = (F.col("first.file") == F.col("file")) & (F.col("first.number") == F.col("number"))
    rows = rows.select("file", "number", F.when(~is_first, F.col("first.url")).alias("original"), F.col("first.archived").alias("date"))

    def run(batches):
        out, source, last, records = _Archives(path, archive_bytes), None, None, iter(())
        try:
            for b in batches:
                for file, number, original, date in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    if file != last:
                        if source is not None:
                            source.close()
                        source, last = _arc_file(file), file
                        records = enumerate(read_arc(source, lambda *_: None))
                    at, (head, content) = next(records)
                    if at != number:
                        raise ValueError(f"{file}: record {at}, not {number}")
                    yield from out.add(head, content, None if original is None else (original, date))
        finally:
            if source is not None:
                source.close()
        yield from out.flush()

    made = rows.repartition(shuffle_parts(spark), "file").sortWithinPartitions("file", "number").mapInArrow(run, "file string, records long")
    return made, index.filter("error is not null")


def read_archives(manifest: DataFrame, path: str, id_type: str = "long") -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of the records of the manifest's archives."""

    def run(batches):
        where, _ = _open(path)
        for b in batches:
            for file, records in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                out = [[], [], [], [], []]
                with where.open_input_stream(file, compression=None) as f:
                    for head, block in read_warc(iter(lambda f=f: f.read(1 << 20), b"")):
                        if head["WARC-Type"] == "warcinfo":
                            continue
                        revisit = head["WARC-Type"] == "revisit"
                        payload = payload_of(block)[1]
                        digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                        if not revisit and (base32_sha1(payload) != digest or len(payload) != int(head["X-Payload-Length"])):
                            raise ValueError(f"{file}: a payload unlike its digest")
                        page = head["WARC-Target-URI"].rpartition(_ID)[2]
                        first = head["WARC-Refers-To-Target-URI"].rpartition(_ID)[2] if revisit else None
                        for c, v in zip(out, (page or None, int(head["X-Payload-Length"]), digest, head["WARC-Type"], first), strict=True):
                            c.append(v)
                if len(out[0]) != records:
                    raise ValueError(f"{file}: {len(out[0])} records, {records} in the manifest")
                kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    out = manifest.mapInArrow(run, "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string")
    return out.withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})


def op6_warc(spark, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "op6")
    manifest = saved(convert(table(spark, sf_dir, "pages").select("page_id", "url", "html"), path), "op6-manifest")
    return read_archives(manifest.repartition(shuffle_parts(spark), "file"), path)


OP6_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
d AS (SELECT page_id, strlen(t) AS payload_bytes, sha1(t) AS h FROM p),
g AS (SELECT h, max(page_id) AS first FROM d GROUP BY h)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  list_reduce([list_reduce([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST(('0x' || substr(h, 5 * i + 1, 5)) AS BIGINT) >> s) & 31 AS INT) + 1, 1) FOR s IN [15, 10, 5, 0]], lambda x, y: x || y) FOR i IN range(8)], lambda x, y: x || y) AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM d JOIN g USING (h)
"""
