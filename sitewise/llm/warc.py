"""Web archives as a data source: ``spark.read.format("warc")`` and ``df.write.format("warc")``.

The reader plans partitions of whole files, takes the predicates on record types and headers
that Spark pushes down, and parses a record's headers first: a record that a predicate rejects,
and a payload that is not asked for, is never decoded.  In plain files it is stepped over by
its length; in compressed ones, where each record is a gzip member, by the length that the
member states ("sl" field), or inflated in small pieces and thrown away where it states none.

The writer makes a gzip member of each record and a new file once one is large enough, so a
file is a bounded amount of work.  Files that a failed or repeated task leaves are not in the
list that a finished write adds to its folder, and are never read.
"""

from __future__ import annotations

import fnmatch
import posixpath
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F

from sitewise.session import checkpoint

SCHEMA = ("file string, offset long, record_id string, warc_type string, target_uri string, date string, content_type string, content_length long, "
          "payload_digest string, refers_to string, headers map<string,string>, http_headers map<string,string>, payload binary")
ARROW = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("record_id", pa.string()), ("warc_type", pa.string()), ("target_uri", pa.string()),
                   ("date", pa.string()), ("content_type", pa.string()), ("content_length", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.string()),
                   ("headers", pa.map_(pa.string(), pa.string())), ("http_headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())])
#: Column of a header, both ways.
NAMED = {"record_id": "WARC-Record-ID", "warc_type": "WARC-Type", "target_uri": "WARC-Target-URI", "date": "WARC-Date", "content_type": "Content-Type",
         "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To"}
CHUNK, LINE, BATCH_BYTES, BATCH_ROWS = 1 << 16, 1 << 20, 8 << 20, 2000
#: Bytes of small files that one partition reads, and of a written file before the next is begun.
PARTITION_BYTES, FILE_BYTES = 64 << 20, 64 << 20
COMMITTED = "_committed-"
HTTP = "application/http; msgtype=response"
DATE = "1970-01-01T00:00:00Z"
#: Spark 4.1 keeps what a Python source took of a query's filters with the loaded frame, for the frame's other uses too.  A filter that is always there
#: has it asked anew; one that is not deterministic keeps filters that are added later away from the source.
ALWAYS, BARRIER = "offset >= 0", "monotonically_increasing_id() >= 0"


class Broken(ValueError):
    """A file that is no archive, or ends inside a record."""


class Plain:
    """Bytes of a file in order, with steps over what is not wanted."""

    def __init__(self, file):
        self.file, self.buffer, self.at, self.base = file, b"", 0, 0

    def place(self) -> int:
        return self.base + self.at

    def record_place(self) -> int:
        return self.place()

    def more(self) -> bool:
        """Put the next bytes in the buffer, whose bytes are used up; false at the end."""
        self.base += len(self.buffer)
        self.buffer, self.at = self.file.read(CHUNK), 0
        return bool(self.buffer)

    def go(self, place: int) -> None:
        if self.base <= place <= self.base + len(self.buffer):
            self.at = place - self.base
            return
        self.base, self.buffer, self.at = place, b"", 0
        if place > self.file.size():
            raise Broken("the file ends inside a record")
        self.file.seek(place)

    def jump(self, n: int) -> None:
        """Step over n bytes that follow the buffer."""
        self.go(self.base + len(self.buffer) + n)

    def read(self, n: int) -> bytes:
        parts = []
        while n:
            if self.at == len(self.buffer) and not self.more():
                raise Broken("the file ends inside a record")
            part = self.buffer[self.at : self.at + n]
            self.at += len(part)
            n -= len(part)
            parts.append(part)
        return b"".join(parts)

    def line(self, most: int = LINE) -> bytes:
        """Up to and with the next line feed, but no more than ``most`` bytes; what is left at the end of the file."""
        parts = []
        while most and (self.at < len(self.buffer) or self.more()):
            end = self.buffer.find(b"\n", self.at, self.at + most) + 1
            parts.append(self.buffer[self.at : end or self.at + most])
            self.at += len(parts[-1])
            most -= len(parts[-1])
            if end:
                break
        return b"".join(parts)

    def skip(self, n: int) -> None:
        here = min(n, len(self.buffer) - self.at)
        self.at += here
        if n > here:
            self.jump(n - here)


class Inflated(Plain):
    """The same over gzip members: they are inflated piece by piece, or stepped over whole by the length they state."""

    def __init__(self, file):
        super().__init__(None)
        self.raw, self.inflate, self.crc, self.made = Plain(file), None, 0, 0
        self.tail, self.ends, self.length, self.begins = b"", None, None, 0

    def record_place(self) -> int:
        if self.at == len(self.buffer):
            self.more()
        return self.begins

    def head(self) -> bool:
        """Read a member's header; false at the end of the file."""
        self.begins = self.raw.place()
        try:
            first = self.raw.read(1)
        except Broken:
            return False
        fixed = first + self.raw.read(9)
        if fixed[:3] != b"\x1f\x8b\x08":
            raise Broken("not a gzip member")
        flags, self.ends, self.length = fixed[3], None, None
        if flags & 4:
            extra = self.raw.read(struct.unpack("<H", self.raw.read(2))[0])
            while len(extra) >= 4:
                size = struct.unpack("<H", extra[2:4])[0]
                if extra[:2] == b"sl" and size == 8:
                    stated, self.length = struct.unpack("<II", extra[4:12])
                    self.ends = self.begins + stated
                extra = extra[4 + size :]
        for bit in (8, 16):  # name and comment
            while flags & bit and self.raw.read(1) != b"\0":
                pass
        if flags & 2:
            self.raw.read(2)
        self.inflate, self.crc, self.made, self.tail = zlib.decompressobj(-15), 0, 0, b""
        return True

    def more(self) -> bool:
        self.base += len(self.buffer)
        self.buffer, self.at = b"", 0
        while not self.buffer:
            if self.inflate is None and not self.head():
                return False
            if not self.tail:
                if self.raw.at == len(self.raw.buffer) and not self.raw.more():
                    raise Broken("the file ends inside a gzip member")
                self.tail = self.raw.buffer[self.raw.at :]
                self.raw.at = len(self.raw.buffer)
            try:
                self.buffer = self.inflate.decompress(self.tail, CHUNK)
            except zlib.error as e:
                raise Broken(str(e)) from e
            self.tail = self.inflate.unconsumed_tail
            self.crc, self.made = zlib.crc32(self.buffer, self.crc), self.made + len(self.buffer)
            if self.inflate.eof:
                self.raw.at -= len(self.inflate.unused_data)
                crc, size = struct.unpack("<II", self.raw.read(8))
                if crc != self.crc or size != self.made & 0xFFFFFFFF:
                    raise Broken("a gzip member's checksum differs")
                self.inflate, self.tail = None, b""
        return True

    def jump(self, n: int) -> None:
        self.base, self.buffer, self.at = self.base + len(self.buffer), b"", 0
        while n:
            if self.inflate is not None and self.ends is not None and self.made <= self.length <= self.made + n + 4:  # the line ends behind a record are no record
                n = max(0, n - (self.length - self.made))
                self.base += self.length - self.made
                self.raw.go(self.ends)
                self.inflate, self.tail = None, b""
                continue
            if not self.more():
                raise Broken("the file ends inside a record")
            self.at = min(n, len(self.buffer))
            n -= self.at
            if n:
                self.base, self.buffer, self.at = self.base + len(self.buffer), b"", 0


def fields(stream: Plain, most: int | None = None) -> tuple[list[tuple[str, str]], int]:
    """(name, value) up to the empty line, and the bytes read; most: of which the fields are a part."""
    out, used = [], 0
    while most is None or used < most:
        line = stream.line(LINE if most is None else most - used)
        used += len(line)
        if not line:
            raise Broken("the file ends inside headers")
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if not text:
            break
        if text[0] in " \t" and out:  # a folded line
            out[-1] = (out[-1][0], f"{out[-1][1]} {text.strip()}")
        else:
            name, _, value = text.partition(":")
            out.append((name.strip(), value.strip()))
    return out, used


def records(stream: Plain, file: str, wanted: Callable[[dict], bool], payload: bool) -> Iterator[tuple]:
    """Rows of ``SCHEMA``; only headers of the others are read."""
    while True:
        offset, line = stream.record_place(), stream.line()
        while line in (b"\r\n", b"\n"):
            offset, line = stream.record_place(), stream.line()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise Broken(f"no record begins at {offset}")
        head, _ = fields(stream)
        by = {n.lower(): v for n, v in reversed(head)}
        try:
            length = int(by["content-length"])
        except (KeyError, ValueError) as e:
            raise Broken(f"the record at {offset} has no length") from e
        row = {"file": file, "offset": offset, "content_length": length} | {c: by.get(n.lower()) for c, n in NAMED.items()}
        left, http, body = length, None, None
        if wanted(row):
            if (row["content_type"] or "").lower().startswith("application/http"):
                stated, used = fields(stream, length)
                http, left = list({n: v for n, v in reversed(stated) if not n.startswith("HTTP/")}.items()), length - used
            if payload:
                body, left = stream.read(left), 0
            yield (file, offset, row["record_id"], row["warc_type"], row["target_uri"], row["date"], row["content_type"], length, row["payload_digest"], row["refers_to"],
                   list(dict(reversed(head)).items()), http, body)
        stream.skip(left)


#: What a filter says of a value that is not null.
SAYS = {ds.EqualTo: lambda a, b: a == b, ds.EqualNullSafe: lambda a, b: a == b, ds.GreaterThan: lambda a, b: a > b, ds.GreaterThanOrEqual: lambda a, b: a >= b,
        ds.LessThan: lambda a, b: a < b, ds.LessThanOrEqual: lambda a, b: a <= b, ds.In: lambda a, b: a in b, ds.StringStartsWith: lambda a, b: a.startswith(b),
        ds.StringEndsWith: lambda a, b: a.endswith(b), ds.StringContains: lambda a, b: b in a}
PUSHED = {*NAMED, "file", "offset", "content_length"}


def taken(f: ds.Filter) -> bool:
    """True where the headers alone decide."""
    if isinstance(f, ds.Not):
        return taken(f.child)
    if isinstance(f, (ds.IsNull, ds.IsNotNull)):
        return f.attribute[0] in PUSHED and len(f.attribute) == 1
    return type(f) in SAYS and len(f.attribute) == 1 and f.attribute[0] in PUSHED and (f.value is not None or isinstance(f, ds.EqualNullSafe))


def judged(f: ds.Filter, row: dict) -> bool | None:
    """SQL's answer, null where it is unknown."""
    if isinstance(f, ds.Not):
        said = judged(f.child, row)
        return None if said is None else not said
    value = row[f.attribute[0]]
    if isinstance(f, (ds.IsNull, ds.IsNotNull)):
        return (value is None) == isinstance(f, ds.IsNull)
    if isinstance(f, ds.EqualNullSafe):
        return value == f.value
    if value is None:
        return None
    if isinstance(f, ds.In):
        return value in f.value or (None if None in f.value else False)
    return SAYS[type(f)](value, f.value)


@dataclass
class Files(ds.InputPartition):
    names: list[str]


def opened(path: str):
    """(store, path in it); a path without a scheme is one of the local store."""
    return arrow_fs.FileSystem.from_uri(path if "://" in path else posixpath.abspath(path.removeprefix("file:")))


def archives(path: str) -> tuple[arrow_fs.FileSystem, list[tuple[str, int]]]:
    """(name, bytes) of the archives of a folder or file; where finished writes left lists, of those alone."""
    store, root = opened(path)
    about = store.get_file_info(root)
    if about.type == arrow_fs.FileType.File:
        return store, [(root, about.size)]
    if about.type == arrow_fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = {f.path: f.size for f in store.get_file_info(arrow_fs.FileSelector(root, recursive=True)) if f.type == arrow_fs.FileType.File}
    lists = [f for f in found if posixpath.basename(f).startswith(COMMITTED)]
    if lists:
        names = sorted(posixpath.join(root, n) for f in lists for n in store.open_input_stream(f).read().decode().split())
        return store, [(n, found[n]) for n in names]
    return store, sorted((f, n) for f, n in found.items() if fnmatch.fnmatch(posixpath.basename(f), "*.warc*") and not posixpath.basename(f).startswith(("_", ".")))


class Reader(ds.DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.payload = options["path"], str(options.get("payload", "true")).lower() == "true"
        self.stop, self.bytes, self.filters = options.get("broken", "raise") == "stop", int(options.get("partitionBytes", PARTITION_BYTES)), []

    def pushFilters(self, filters):
        for f in filters:
            if taken(f):
                self.filters.append(f)
            else:
                yield f

    def partitions(self):
        parts, room = [], 0
        own = [f for f in self.filters if getattr(f, "attribute", None) == ("file",)]
        for name, size in archives(self.path)[1]:
            if all(judged(f, {"file": name}) is True for f in own):
                if not parts or size > room:
                    parts.append(Files([]))
                    room = self.bytes
                parts[-1].names.append(name)
                room -= size
        return parts or [Files([])]

    def read(self, partition):
        store, _ = opened(self.path)
        wanted = lambda row: all(judged(f, row) is True for f in self.filters)
        rows, size = [], 0
        for name in partition.names:
            with store.open_input_file(name) as file:
                two = file.read(2)
                file.seek(0)
                try:
                    for row in records(Inflated(file) if two == b"\x1f\x8b" else Plain(file), name, wanted, self.payload):
                        rows.append(row)
                        size += len(row[-1] or b"")
                        if size >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
                            yield batch(rows)
                            rows, size = [], 0
                except Broken as e:
                    if not self.stop:
                        raise Broken(f"{name}: {e}") from e
        if rows:
            yield batch(rows)


def batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), ARROW.types)], schema=ARROW)


@dataclass
class Written(ds.WriterCommitMessage):
    names: list[str] = field(default_factory=list)


def clean(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record(row: dict) -> bytes:
    """One record's bytes; line ends inside a header's value are percent-encoded."""
    block, kind = row.get("payload") or b"", row.get("content_type")
    block = block.encode() if isinstance(block, str) else block
    if row.get("http_headers") is not None:
        lines = "".join(f"{clean(n)}: {clean(v or '')}\r\n" for n, v in row["http_headers"])
        block, kind = f"HTTP/1.1 200 OK\r\n{lines}\r\n".encode() + block, HTTP
    own = row | {"content_type": kind or "application/octet-stream", "warc_type": row.get("warc_type") or "resource", "date": row.get("date") or DATE, "record_id": row.get("record_id") or f"<urn:uuid:{uuid.uuid4()}>"}
    lines = [(n, own[c]) for c, n in NAMED.items() if own.get(c) is not None] + [(n, v) for n, v in row.get("headers") or [] if v is not None]
    head = "".join(f"{clean(n)}: {clean(v)}\r\n" for n, v in lines)
    return f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def member(data: bytes, level: int) -> bytes:
    """A gzip member that states its length before and after compression."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    total, tail = 10 + 2 + 12 + len(body) + 8, struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    if max(total, len(data)) >= 1 << 32:
        return b"\x1f\x8b\x08\0\0\0\0\0\0\xff" + body + tail
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H2sHII", 12, b"sl", 8, total, len(data)) + body + tail


class Writer(ds.DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.level, self.most, self.plain = options["path"], int(options.get("level", 6)), int(options.get("fileBytes", FILE_BYTES)), options.get("compression") == "none"
        if overwrite:
            raise ValueError("archives are only appended to: choose mode('append') and a new folder")

    def write(self, iterator):
        store, root = opened(self.path)
        store.create_dir(root, recursive=True)
        done, out, attempt, known = Written(), None, uuid.uuid4().hex, {*NAMED, "headers", "http_headers", "payload"}
        for part in iterator:
            part = part.select([n for n in part.schema.names if n in known])
            for small in (part.slice(k, 256) for k in range(0, len(part), 256)):
                for row in small.to_pylist():
                    if out is None:
                        done.names.append(f"part-{TaskContext.get().partitionId():05d}-{attempt}-{len(done.names)}.warc{'' if self.plain else '.gz'}")
                        out = store.open_output_stream(posixpath.join(root, done.names[-1]), compression=None)
                    data = record(row)
                    out.write(data if self.plain else member(data, self.level))
                    if out.tell() >= self.most:
                        out.close()
                        out = None
        if out is not None:
            out.close()
        return done

    def commit(self, messages):
        store, root = opened(self.path)
        store.create_dir(root, recursive=True)
        with store.open_output_stream(posixpath.join(root, f"{COMMITTED}{uuid.uuid4().hex}"), compression=None) as out:
            out.write("".join(f"{n}\n" for m in messages if m for n in m.names).encode())

    def abort(self, messages):
        """Files of an unfinished write are in no list; nothing is removed."""


class Warc(ds.DataSource):
    """Options: path; payload (true), partitionBytes, broken (raise, or stop: keep a broken file's records before the fault); for writes level, fileBytes, compression (gzip or none)."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return Reader(self.options)

    def writer(self, schema, overwrite):
        return Writer(self.options, overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to the session, and let it push filters to Python sources."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Warc)


def read_warc(spark: SparkSession, path: str, where: str | Column | None = None, payload: bool = True, **options: str) -> DataFrame:
    """Records of ``SCHEMA`` of the archives in a folder; without ``payload`` no payload is decoded and the column is null.

    ``where`` is pushed down, as far as it is on headers that are columns.  Filters that are put
    on the result later are right too, but see every record decoded.  (A frame of
    ``spark.read.format("warc")`` takes all its filters down, but Spark 4.1 may then give the
    filters of one use of the frame to another: load it anew for each.)

    Header columns are null where a record has no such header; the first of repeated headers
    counts.  A folder without archives gives no rows.  A broken file is an error unless
    ``broken="stop"``, which keeps its records before the fault.
    """
    register(spark)
    df = spark.read.format("warc").options(payload=str(payload).lower(), **options).load(path).where(ALWAYS)
    return (df if where is None else df.where(where)).where(BARRIER)


def write_warc(df: DataFrame, path: str, **options: str) -> None:
    """Add ``df``'s rows as records to a folder.

    Columns are taken by name: those of ``SCHEMA`` but file, offset and content_length; others
    are ignored.  With ``http_headers`` the block is an HTTP response, headers before payload.
    Nulls: no such header; no payload: empty; no id: a random one; no type: resource.
    """
    register(df.sparkSession)
    df.write.format("warc").mode("append").options(**options).save(path)


def deduplicated(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html", least: int = 1000) -> DataFrame:
    """Records to write, one for each row: of equal payloads of ``least`` bytes and more one response, the others revisits without payload.

    The response is the row with the largest id, then the largest url; of fully equal rows one.
    A null id is below every other and no header; a null payload is empty.  Equal payloads are
    counted before the shuffle, so a payload of very many rows is no large group; the join that
    tells rows their response is split by adaptive execution where a payload is frequent.
    """
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(page_id).alias("id"), F.col(url).alias("url"), body.alias("payload"))
    rows = rows.select("id", "url", "payload", F.sha1("payload").alias("digest"), F.octet_length("payload").cast("long").alias("bytes"))
    equal = rows.where(F.col("bytes") >= least).groupBy("digest", "bytes", "id", "url").agg(F.count(F.lit(1)).alias("n"))
    groups = equal.groupBy("digest", "bytes").agg(F.max(F.struct("id", "url", "n")).alias("top"), F.sum("n").alias("all")).where(F.col("all") > 1).select("digest", "bytes", "top")
    groups = checkpoint(groups)
    told = rows.join(groups, ["digest", "bytes"], "left")
    first = F.col("top").isNull() | (F.col("id").eqNullSafe(F.col("top.id")) & F.col("url").eqNullSafe(F.col("top.url")))
    told = told.withColumn("response", first)
    if not groups.where("top.n > 1").isEmpty():
        copies = F.col("response") & F.coalesce(F.col("top.n") > 1, F.lit(False))
        merged = told.where(copies).groupBy("digest", "bytes", "id", "url").agg(F.any_value("payload").alias("payload"), F.any_value("top").alias("top"))
        numbered = merged.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("top.n"))).alias("copy"))
        told = told.where(~copies).unionByName(numbered.withColumn("response", F.col("copy") == 1).drop("copy"))
    named = F.concat(F.lit("<urn:sha1:"), F.col("digest"), F.lit(":"), F.col("bytes").cast("string"), F.lit(">"))
    return told.select(
        F.when(F.col("response") & F.col("top").isNotNull(), named).otherwise(F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">"))).alias("record_id"),
        F.when(F.col("response"), "response").otherwise("revisit").alias("warc_type"),
        F.col("url").alias("target_uri"),
        F.concat(F.lit("sha1:"), F.col("digest")).alias("payload_digest"),
        F.when(~F.col("response"), named).alias("refers_to"),
        F.create_map(F.lit("X-Page-Id"), F.col("id").cast("string"), F.lit("X-Refers-To-Page-Id"), F.when(~F.col("response"), F.col("top.id").cast("string"))).alias("headers"),
        F.create_map(F.lit("Content-Type"), F.lit("text/html; charset=utf-8"), F.lit("Content-Length"), F.col("bytes").cast("string")).alias("http_headers"),
        F.when(F.col("response"), F.col("payload")).alias("payload"))


def _id(name: str) -> Column:
    return F.col("headers")[name].cast("long")


def page_records(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every page record in the archives.

    Responses are read with their payload, whose length and digest are taken anew; of revisits
    only headers are.
    """
    kind, digest = F.col("warc_type"), F.regexp_replace("payload_digest", "^sha1:", "")
    full = read_warc(spark, path, kind == "response")
    bare = read_warc(spark, path, kind == "revisit", payload=False)
    return full.select(_id("X-Page-Id").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"),
                       kind.alias("record_type"), F.lit(None).cast("long").alias("refers_to")).unionByName(
        bare.select(_id("X-Page-Id").alias("page_id"), F.col("http_headers")["Content-Length"].cast("long").alias("payload_bytes"), digest.alias("payload_digest"),
                    kind.alias("record_type"), _id("X-Refers-To-Page-Id").alias("refers_to")))


def oracle(least: int = 1000) -> str:
    return f"""
    WITH p AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
    k AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest,
                 row_number() OVER (PARTITION BY html ORDER BY page_id DESC NULLS LAST, url DESC NULLS LAST) AS place,
                 first_value(page_id) OVER (PARTITION BY html ORDER BY page_id DESC NULLS LAST, url DESC NULLS LAST) AS top
          FROM p)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN payload_bytes >= {least} AND place > 1 THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN payload_bytes >= {least} AND place > 1 THEN top END AS refers_to
    FROM k"""
