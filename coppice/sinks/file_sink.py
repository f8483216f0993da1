"""A sink of whole files that commits: a task's files come to light together, and only if the whole job succeeds.

A task attempt writes into a folder of its own, ``_passing/<job>/<attempt>``. The driver moves the files of the attempts
that succeeded to their places and takes the rest away; after a failure it takes everything away. Readers pass over
names that begin with an underscore, so a driver that dies leaves nothing that is read.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from ..sources.paths import system_of


@dataclass
class Written(WriterCommitMessage):
    """The folder of one attempt, and how many files it wrote."""

    folder: str
    files: int


class FileSink(DataSource):
    """``format("coppice_files")``: rows (path, text) become files under option ``path``; an existing file is replaced."""

    @classmethod
    def name(cls) -> str:
        return "coppice_files"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        if schema.fieldNames() != ["path", "text"]:
            raise ValueError(f"rows must be (path, text), not {schema.fieldNames()}")
        return FileWriter(self.options["path"])  # made once, on the driver


class FileWriter(DataSourceArrowWriter):
    def __init__(self, folder: str) -> None:
        self.folder, self.job = folder, uuid.uuid4().hex
        system, root = system_of(folder)
        system.create_dir(self._passing(root), recursive=True)

    def _passing(self, root: str) -> str:
        return f"{root}/_passing/{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, root = system_of(self.folder)
        task = TaskContext.get()
        own, n, made = f"{self._passing(root)}/{task.partitionId()}-{task.taskAttemptId()}", 0, set()
        # Tasks may still run when the job is given up; they end at its missing folder, and must not bring it back.
        system.create_dir(own, recursive=False)
        for batch in iterator:
            for path, text in zip(batch.column("path").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if path is None or text is None or path.startswith("/") or ".." in path.split("/"):
                    raise ValueError(f"not a file of the folder: {path!r}")
                target = f"{own}/{path}"
                self._alive(system, own)
                if (above := target.rpartition("/")[0]) not in made:
                    system.create_dir(above, recursive=True)
                    made.add(above)
                with system.open_output_stream(target) as f:
                    f.write(text.encode())
                n += 1
        self._alive(system, own)
        return Written(own, n)

    @staticmethod
    def _alive(system, own: str) -> None:
        from pyarrow import fs

        if system.get_file_info(own).type != fs.FileType.Directory:
            raise RuntimeError("the job was given up")

    def commit(self, messages: list[Written | None]) -> None:
        from pyarrow import fs

        system, root = system_of(self.folder)
        system.create_dir(root, recursive=True)  # also where there are no files
        made: set[str] = set()
        for m in messages:
            if m is None or not m.files:
                continue
            for f in system.get_file_info(fs.FileSelector(m.folder, recursive=True)):
                if f.type == fs.FileType.File:
                    target = f"{root}/{f.path.partition(f'{m.folder}/')[2]}"
                    if (above := target.rpartition("/")[0]) not in made:
                        system.create_dir(above, recursive=True)
                        made.add(above)
                    system.move(f.path, target)
        self._sweep()

    def abort(self, messages: list[Written | None]) -> None:
        self._sweep()

    def _sweep(self) -> None:
        """Takes away what this job's attempts left, and the folder of passing files if no other job has any."""
        from pyarrow import fs

        system, root = system_of(self.folder)
        for _ in range(5):  # a task that ends may write into it meanwhile
            if system.get_file_info(self._passing(root)).type != fs.FileType.Directory:
                break
            with contextlib.suppress(OSError):
                system.delete_dir(self._passing(root))
        above = f"{root}/_passing"
        with contextlib.suppress(OSError):  # another job may begin or end meanwhile
            if system.get_file_info(above).type == fs.FileType.Directory and not system.get_file_info(fs.FileSelector(above)):
                system.delete_dir(above)
