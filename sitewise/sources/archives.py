"""Archives of files (tar, compressed or not) as a data source: one row a member, nothing unpacked to disk.

An archive can only be read from its beginning, so it is a partition; members are streamed
one after the other and handed on in batches of bounded size.
"""

from __future__ import annotations

import posixpath
import tarfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F

SCHEMA = "archive string, member string, size long, content binary"
ARROW = pa.schema([("archive", pa.string()), ("member", pa.string()), ("size", pa.int64()), ("content", pa.binary())])
ENDINGS = (".tar", ".tar.gz", ".tgz", ".tar.bz2", ".tar.xz")
BATCH = 8 << 20
COMMITTED = "_committed-"


def opened(path: str):
    """(store, path in it); a path without a scheme is one of the local store."""
    return arrow_fs.FileSystem.from_uri(path if "://" in path else posixpath.abspath(path.removeprefix("file:")))


def listed(path: str) -> list[str]:
    """Archives of a folder, at any depth, or the one that the path names; those in the lists of finished writes where there are any."""
    store, root = opened(path)
    about = store.get_file_info(root)
    if about.type == arrow_fs.FileType.File:
        return [root]
    if about.type == arrow_fs.FileType.NotFound:
        raise FileNotFoundError(path)
    files = [f.path for f in store.get_file_info(arrow_fs.FileSelector(root, recursive=True)) if f.type == arrow_fs.FileType.File]
    lists = [f for f in files if posixpath.basename(f).startswith(COMMITTED)]
    if lists:
        return sorted(posixpath.join(root, n) for f in lists for n in store.open_input_stream(f, compression=None).read().decode().split())
    return sorted(f for f in files if f.endswith(ENDINGS) and not posixpath.basename(f).startswith(("_", ".")))


@dataclass
class Archive(ds.InputPartition):
    name: str


class Reader(ds.DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.stop = options["path"], options.get("broken", "raise") == "stop"
        self.ending = tuple(x for x in (options.get("members") or "").split(",") if x)

    def partitions(self):
        return [Archive(n) for n in listed(self.path)]

    def read(self, partition):
        if not hasattr(partition, "name"):  # a folder without archives
            return
        store, _ = opened(self.path)
        rows, held = [], 0
        try:
            with store.open_input_stream(partition.name, compression=None) as stream, tarfile.open(fileobj=stream, mode="r|*") as tar:
                for m in tar:
                    if not m.isfile() or (self.ending and not m.name.endswith(self.ending)):
                        continue
                    body = tar.extractfile(m).read()
                    if len(body) != m.size:
                        raise tarfile.ReadError(f"{m.name} is cut short")
                    rows.append((partition.name, m.name, m.size, body))
                    held += len(body)
                    if held >= BATCH:
                        yield batch(rows)
                        rows, held = [], 0
        except (tarfile.TarError, EOFError, OSError) as e:
            if not self.stop:
                raise ValueError(f"{partition.name}: {e}") from e
        if rows:
            yield batch(rows)


def batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), ARROW.types)], schema=ARROW)


@dataclass
class Written(ds.WriterCommitMessage):
    names: list[str] = field(default_factory=list)


class Writer(ds.DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path = options["path"]
        if overwrite:
            raise ValueError("archives are only added: choose mode('append')")

    def write(self, iterator: Iterator[pa.RecordBatch]):
        import io

        store, root = opened(self.path)
        store.create_dir(root, recursive=True)
        done, tar, out = Written(), None, None
        for part in iterator:
            for name, body in zip(part.column("member").to_pylist(), part.column("content").to_pylist()):
                if tar is None:
                    done.names.append(f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.tar.gz")
                    out = store.open_output_stream(posixpath.join(root, done.names[-1]), compression=None)
                    tar = tarfile.open(fileobj=out, mode="w|gz")
                info = tarfile.TarInfo(name)
                body = body or b""
                info.size = len(body)
                tar.addfile(info, io.BytesIO(body))
        if tar is not None:
            tar.close()
            out.close()
        return done

    def commit(self, messages):
        store, root = opened(self.path)
        store.create_dir(root, recursive=True)
        with store.open_output_stream(posixpath.join(root, f"{COMMITTED}{uuid.uuid4().hex}"), compression=None) as out:
            out.write("".join(f"{n}\n" for m in messages if m for n in m.names).encode())

    def abort(self, messages):
        """Archives of an unfinished write are in no list; nothing is removed."""


class Archives(ds.DataSource):
    """Options: path; members (endings of wanted names, by commas); broken (raise, or stop: keep the members before the fault)."""

    @classmethod
    def name(cls):
        return "archive"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return Reader(self.options)

    def writer(self, schema, overwrite):
        return Writer(self.options, overwrite)


def read_archives(spark: SparkSession, path: str, members: str = "", broken: str = "raise") -> DataFrame:
    """``archive, member, size, content`` of every file in the archives; folders and links are no rows.

    A member is held whole.  An archive that is broken is an error, or with ``broken="stop"``
    ends at the fault.
    """
    spark.dataSource.register(Archives)
    return spark.read.format("archive").options(members=members, broken=broken).load(path)


def write_archives(df: DataFrame, path: str) -> None:
    """Add ``member, content`` rows to a folder, an archive for each partition that has rows."""
    df.sparkSession.dataSource.register(Archives)
    df.select(F.col("member").cast("string").alias("member"), F.col("content").cast("binary").alias("content")).write.format("archive").mode("append").save(path)


def archive_lines(df: DataFrame) -> DataFrame:
    """``archive, member, line_no, line`` of text members, line ends of either kind."""
    lines = F.split(F.regexp_replace(F.decode("content", "UTF-8"), r"\r?\n$", ""), r"\r?\n")
    return df.where("size > 0").select("archive", "member", F.posexplode(lines).alias("line_no", "line"))
