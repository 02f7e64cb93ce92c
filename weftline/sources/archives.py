"""Data sources in Python: members of ZIP archives, read in groups and written, and one JSON array as a file.

Files are opened through Arrow's file systems, so a path may be local or in any
store that these know.  A task holds one member at a time.
"""

from __future__ import annotations

import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

BUFFER = 1 << 20


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


class Members(InputPartition):
    def __init__(self, archive: str, names: list[str]):
        self.archive, self.names = archive, names


class ArchiveReader(DataSourceReader):
    """Archives of a folder; each task reads a group of the members of one."""

    def __init__(self, options: dict):
        self.path, self.most, self.group = options["path"], int(options.get("most", 0)), int(options.get("group", 100))

    def partitions(self) -> list[Members]:
        fs, path = opened(self.path)
        found = fs.get_file_info(pafs.FileSelector(path, allow_not_found=True))
        out = []
        for info in sorted(found, key=lambda x: x.path):
            if not info.path.endswith(".zip"):
                continue
            # the directory at an archive's end tells its members: their contents stay unread here
            with fs.open_input_file(info.path) as file, zipfile.ZipFile(file) as archive:
                names = [x.filename for x in archive.infolist() if not x.is_dir()]
            names = names[: self.most] if self.most else names
            out += [Members(info.path, names[i : i + self.group]) for i in range(0, len(names), self.group)]
        return out or [Members("", [])]

    def read(self, partition: Members) -> Iterator[tuple]:
        if not partition.names:
            return
        fs, _ = opened(self.path)
        short = partition.archive.rsplit("/", 1)[-1].removesuffix(".zip")
        with fs.open_input_file(partition.archive) as file, zipfile.ZipFile(file) as archive:
            for name in partition.names:
                yield short, name, archive.read(name)


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class ArchiveWriter(DataSourceWriter):
    """One archive for each run of rows with one name; rows come clustered by archive."""

    def __init__(self, options: dict):
        self.path = options["path"]

    def write(self, rows: Iterator[Row]) -> Written:
        fs, path = opened(self.path)
        fs.create_dir(path, recursive=True)
        files: list[str] = []
        name = archive = out = None
        try:
            for row in rows:
                if row["archive"] != name:
                    if archive:
                        archive.close()
                        out.close()
                    name = row["archive"]
                    files.append(f"{path}/_{uuid.uuid4().hex}-{name}.zip")
                    out = fs.open_output_stream(files[-1])
                    archive = zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED)
                archive.writestr(row["member"], row["content"])
        finally:
            if archive:
                archive.close()
                out.close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        fs, path = opened(self.path)
        for m in filter(None, messages):
            for file in m.files:
                fs.move(file, f"{path}/{file.rsplit('/', 1)[-1].split('-', 1)[1]}")

    def abort(self, messages: list[Written | None]) -> None:
        fs, _ = opened(self.path)
        for m in filter(None, messages):
            for file in m.files:
                fs.delete_file(file)


class Archives(DataSource):
    """archive, member and content of ZIP files in a folder; options: most (members of each archive, in their order), group (members a task)."""

    @classmethod
    def name(cls) -> str:
        return "zip_members"

    def schema(self) -> str:
        return "archive string, member string, content binary"

    def reader(self, schema: StructType) -> ArchiveReader:
        return ArchiveReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> ArchiveWriter:
        return ArchiveWriter(self.options)


class ArrayWriter(DataSourceWriter):
    """Tasks write parts of the array; the commit joins them, a buffer at a time, under a name of its own and then renames."""

    def __init__(self, options: dict):
        self.path = options["path"]

    def write(self, rows: Iterator[Row]) -> Written:
        fs, path = opened(self.path)
        part, some = f"{path}.parts/{uuid.uuid4().hex}", False
        fs.create_dir(f"{path}.parts", recursive=True)
        with fs.open_output_stream(part) as out:
            for row in rows:
                out.write(((",\n" if some else "") + row[0]).encode())
                some = True
        if not some:
            fs.delete_file(part)
        return Written([part] if some else [])

    def commit(self, messages: list[Written | None]) -> None:
        fs, path = opened(self.path)
        parts = [f for m in messages if m for f in m.files]
        own = f"{path}.{uuid.uuid4().hex}"
        with fs.open_output_stream(own) as out:
            out.write(b"[")
            for i, part in enumerate(parts):
                if i:
                    out.write(b",\n")
                with fs.open_input_stream(part) as piece:
                    while chunk := piece.read(BUFFER):
                        out.write(chunk)
            out.write(b"]")
        fs.move(own, path)
        self.clean(fs, parts)

    def abort(self, messages: list[Written | None]) -> None:
        fs, _ = opened(self.path)
        self.clean(fs, [f for m in messages if m for f in m.files])

    def clean(self, fs: pafs.FileSystem, parts: list[str]) -> None:
        for part in parts:
            fs.delete_file(part)


class JsonArray(DataSource):
    """Rows with one column of JSON text become one array in one file."""

    @classmethod
    def name(cls) -> str:
        return "json_array"

    def writer(self, schema: StructType, overwrite: bool) -> ArrayWriter:
        return ArrayWriter(self.options)


def zip_members(spark: SparkSession, path: str, most: int = 0, group: int = 100) -> DataFrame:
    """archive, member and content of the ZIP files in a folder, the first `most` members of each (0: all); none where there is no folder."""
    spark.dataSource.register(Archives)
    return spark.read.format("zip_members").option("path", path).option("most", most).option("group", group).load()


def write_zips(rows: DataFrame, path: str) -> None:
    """Rows (archive, member, content) as ZIP files, members in the order of their names."""
    rows.sparkSession.dataSource.register(Archives)
    dealt = rows.select("archive", "member", F.col("content").cast("binary").alias("content")).repartition("archive").sortWithinPartitions("archive", "member")
    dealt.write.format("zip_members").option("path", path).mode("append").save()


def write_json_array(rows: DataFrame, path: str) -> None:
    """All rows as one JSON array in one file, which replaces an older one at once."""
    rows.sparkSession.dataSource.register(JsonArray)
    rows.select(F.to_json(F.struct("*")).alias("value")).write.format("json_array").option("path", path).mode("append").save()
