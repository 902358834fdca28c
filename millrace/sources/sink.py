"""A sink of named text files: one for each row, all or none.

Tasks write their files into folders of their own attempts; only when all tasks
are done does the commit move the files of the attempts that count to their
place. A task that is retried, or runs twice, leaves nothing behind, and a job
that fails leaves the folder as it was. Files go through Arrow's file systems,
so a path may be a local one or any URI that these know (file, hdfs, s3, gs).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

#: Moves and deletions that run at once.
MOVES = 16


def located(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


@dataclass
class Attempt(WriterCommitMessage):
    """The folder of one task's files; names don't travel."""

    folder: str


class DocumentWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path, overwrite
        # A name that readers of the folder take for hidden.
        self.job = f"_attempt-{uuid.uuid4().hex}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> Attempt:
        task = TaskContext.get()
        files, root = located(self.path)
        folder = f"part-{task.partitionId():05d}-{task.taskAttemptId()}"
        here = f"{root}/{self.job}/{folder}"
        files.create_dir(here)
        seen: set[str] = set()
        for batch in batches:
            for name, text in zip(batch.column("name").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                if not name or "/" in name or name in (".", "..") or name in seen:
                    raise ValueError(f"not a name for a file, or twice: {name!r}")
                seen.add(name)
                with files.open_output_stream(f"{here}/{name}") as out:
                    out.write(text or b"")
        return Attempt(folder)

    def commit(self, messages: list[Attempt | None]) -> None:
        files, root = located(self.path)
        found = lambda folder: files.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        remove = lambda x: files.delete_dir(x.path) if x.type == fs.FileType.Directory else files.delete_file(x.path)
        move = lambda x: files.move(x.path, f"{root}/{x.base_name}")

        def each(f, entries: list) -> None:
            # A thread takes a share of the files, not one at a time: handing over takes longer than a rename.
            def some(k: int) -> None:
                for x in entries[k::MOVES]:
                    f(x)

            list(pool.map(some, range(MOVES)))

        with ThreadPoolExecutor(MOVES) as pool:
            if self.overwrite:
                each(remove, [x for x in found(root) if x.base_name != self.job])
            for one in messages:
                if one:
                    each(move, found(f"{root}/{self.job}/{one.folder}"))
        self.abort(messages)

    def abort(self, messages: list[Attempt | None]) -> None:
        files, root = located(self.path)
        if files.get_file_info(f"{root}/{self.job}").type != fs.FileType.NotFound:
            files.delete_dir(f"{root}/{self.job}")


class DocumentSink(DataSource):
    """``df.write.format("millrace_documents").mode(...).save(path)`` for rows of (name, text)."""

    @classmethod
    def name(cls) -> str:
        return "millrace_documents"

    def schema(self) -> str:
        return "name string, text string"

    def writer(self, schema, overwrite: bool) -> DocumentWriter:
        return DocumentWriter(self.options["path"], overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(DocumentSink)


def write_documents(frame: DataFrame, path: str, file: str = "file", text: str = "text", overwrite: bool = False) -> None:
    """One text file for each row below ``path``, named like ``file`` without its folders; a null text is an empty file.

    Files of the same names are replaced; with ``overwrite`` all that ``path``
    held before goes too, once everything new is written. Names must be distinct
    and not null: two in one task are an error, of two in different tasks one
    whole file stays. An empty table writes nothing.
    """
    register(frame.sparkSession)
    named = frame.select(F.regexp_replace(file, "^.*/", "").alias("name"), F.col(text).cast("string").alias("text"))
    named.write.format("millrace_documents").mode("overwrite" if overwrite else "append").save(path)
