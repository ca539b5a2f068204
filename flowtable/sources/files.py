"""Rows written out as real files, one file per row, with a commit protocol.

Each task attempt writes its files into a folder of its own under
``_temporary/<job>`` and moves them to their final names only after all of
them are complete; a final name depends on the row alone. So an attempt that
fails leaves nothing but temporary files, and a second or speculative attempt
replaces a file by the same file. The job's commit removes the temporary
folder; its abort also removes what finished tasks had moved.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from flowtable.sources.stores import inside, open_store

FORMAT = "flowtable_files"


@dataclass
class _Written(WriterCommitMessage):
    attempt: str
    files: int


class _FileWriter(DataSourceArrowWriter):
    def __init__(self, base: str):
        self.base, self.job = base, uuid.uuid4().hex

    def _temporary(self) -> tuple[fs.FileSystem, str, str]:
        store, folder = open_store(self.base)
        return store, folder, f"{folder.rstrip('/')}/_temporary/{self.job}"

    def prepare(self) -> _FileWriter:
        """Makes the job's folder; where it is gone again, the job is over."""
        store, _, temporary = self._temporary()
        store.create_dir(temporary, recursive=True)
        return self

    def write(self, iterator) -> _Written:
        store, folder, temporary = self._temporary()
        context = TaskContext.get()
        attempt = f"{context.partitionId()}-{context.taskAttemptId()}"
        names: list[str] = []
        for batch in iterator:
            if batch.num_rows and not names:
                store.create_dir(f"{temporary}/{attempt}", recursive=False)
            for name, content in zip(batch.column(0), batch.column(1)):
                inside(folder, name.as_py())
                with store.open_output_stream(f"{temporary}/{attempt}/{len(names)}") as out:
                    if content.is_valid:
                        out.write(content.as_buffer())
                names.append(name.as_py())
        if not names:
            return _Written(attempt, 0)
        if store.get_file_info(temporary).type != fs.FileType.Directory:
            raise RuntimeError("the job was aborted")
        # What this attempt is about to move, so that an abort can undo it.
        with store.open_output_stream(f"{temporary}/{attempt}.json") as out:
            out.write(json.dumps(names).encode())
        made = set()
        for i, name in enumerate(names):
            target = inside(folder, name)
            parent = target.rsplit("/", 1)[0]
            if parent not in made:
                store.create_dir(parent, recursive=True)
                made.add(parent)
            store.move(f"{temporary}/{attempt}/{i}", target)
        return _Written(attempt, len(names))

    def _clean(self) -> None:
        store, folder, temporary = self._temporary()
        if store.get_file_info(temporary).type == fs.FileType.Directory:
            store.delete_dir(temporary)
        left = store.get_file_info(fs.FileSelector(f"{folder.rstrip('/')}/_temporary", allow_not_found=True))
        if not left:
            above = f"{folder.rstrip('/')}/_temporary"
            if store.get_file_info(above).type == fs.FileType.Directory:
                store.delete_dir(above)

    def commit(self, messages) -> None:
        self._clean()

    def abort(self, messages) -> None:
        store, folder, temporary = self._temporary()
        for m in messages:
            if m is None or not m.files:
                continue
            with store.open_input_stream(f"{temporary}/{m.attempt}.json") as done:
                for name in json.loads(done.read()):
                    target = inside(folder, name)
                    if store.get_file_info(target).type == fs.FileType.File:
                        store.delete_file(target)
        self._clean()


class FileSink(DataSource):
    """``df.write.format("flowtable_files").mode("append").save(folder)`` of
    rows (relative path, binary content)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self):
        return "relpath string, content binary"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("the sink appends; it does not clear folders")
        return _FileWriter(self.options["path"]).prepare()


def write_files(df: DataFrame, base: str, relpath_col: str, content_col: str) -> None:
    """Write ``content_col`` (text as UTF-8, or bytes; null is an empty file)
    of every row to ``base/<relpath>``. Two rows of one path are one file of
    either row. A path that leaves the folder is an error."""
    df.sparkSession.dataSource.register(FileSink)
    rows = df.selectExpr(f"cast(`{relpath_col}` as string) as relpath", f"cast(`{content_col}` as binary) as content")
    rows.write.format(FORMAT).mode("append").save(base)
