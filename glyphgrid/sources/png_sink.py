"""A sink of image files: ``df.write.format("segment_png").mode("append").save(folder)`` for rows (segment_id, png).

Each task writes below ``_staging`` in the folder, under a name of its own; only when all tasks are done are the files
of those that count moved to ``<segment_id>.png``. A task that fails, runs twice or is given up leaves nothing, and
neither does a failed job. The folder is one that workers and driver share, a path or an Arrow file-system URI.
An id is written once: of equal ids in a job the last one moved stays, and ``overwrite`` clears the folder first.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

_SAFE = re.compile(r"[^A-Za-z0-9._-]")
STAGING = "_staging"


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and inner path of a folder."""
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def file_name(segment_id) -> str:
    """A file's name; characters that could lead elsewhere are written as their code."""
    return _SAFE.sub(lambda m: f"%{ord(m.group()):04x}", str(segment_id)) + ".png"


@dataclass
class Staged(WriterCommitMessage):
    folder: str
    files: int


class PngWriter(DataSourceWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path, overwrite
        self.job = uuid.uuid4().hex

    def write(self, rows) -> Staged:
        system, path = file_system(self.path)
        folder = f"{path}/{STAGING}/{self.job}/{uuid.uuid4().hex}"
        system.create_dir(folder, recursive=True)
        n = 0
        for row in rows:
            if row["segment_id"] is None or row["png"] is None:
                continue
            with system.open_output_stream(f"{folder}/{file_name(row['segment_id'])}") as out:
                out.write(bytes(row["png"]))
            n += 1
        return Staged(folder, n)

    def _clear(self, system: fs.FileSystem, path: str) -> None:
        staging = f"{path}/{STAGING}/{self.job}"
        if system.get_file_info(staging).type != fs.FileType.NotFound:
            system.delete_dir(staging)
        above = fs.FileSelector(f"{path}/{STAGING}", allow_not_found=True)
        if system.get_file_info(f"{path}/{STAGING}").type != fs.FileType.NotFound and not system.get_file_info(above):
            system.delete_dir(f"{path}/{STAGING}")

    def commit(self, messages) -> None:
        system, path = file_system(self.path)
        if self.overwrite:
            for info in system.get_file_info(fs.FileSelector(path, allow_not_found=True)):
                if info.type == fs.FileType.File and info.base_name.endswith(".png"):
                    system.delete_file(info.path)
        for message in messages:
            if message is not None:
                for info in system.get_file_info(fs.FileSelector(message.folder)):
                    system.move(info.path, f"{path}/{info.base_name}")
        self._clear(system, path)

    def abort(self, messages) -> None:
        self._clear(*file_system(self.path))


class PngSink(DataSource):
    """Register with ``spark.dataSource.register(PngSink)``."""

    @classmethod
    def name(cls) -> str:
        return "segment_png"

    def schema(self) -> str:
        return "segment_id string, png binary"

    def writer(self, schema, overwrite: bool) -> PngWriter:
        missing = {"segment_id", "png"} - set(schema.names)
        if missing:
            raise ValueError(f"columns are missing: {sorted(missing)}")
        return PngWriter(self.options["path"], overwrite)
