"""One file per row, under the row's own name: a data source that writes. Pickled by value.

A task writes each file beside its place and then moves it there, so a file is whole or not there, and
a task that runs again puts the same names in the same places. A name that occurs twice shows in the
number of files when the job commits, and fails it.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from lexspark.sources.zips import opened


def legal(name: str | None) -> bool:
    """Whether a name is that of a file directly in a folder, and one that readers don't take as hidden."""
    return bool(name) and "/" not in name and name[0] not in "._"


@dataclass
class Written(WriterCommitMessage):
    rows: int


class FilesWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store, folder = opened(self.path)
        store.create_dir(folder, recursive=True)
        rows = 0
        for batch in iterator:
            rows += batch.num_rows
            for name, content in zip(batch.column("name"), batch.column("content")):
                name, content = name.as_py(), content.as_py()
                if not legal(name):
                    raise ValueError(f"{name!r} is no name for a file")
                place = f"{folder}/.{uuid.uuid4().hex}"
                with store.open_output_stream(place) as out:
                    out.write((content or "").encode() if not isinstance(content, bytes) else content)
                store.move(place, f"{folder}/{name}")
        return Written(rows)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store, folder = opened(self.path)
        store.create_dir(folder, recursive=True)
        files = sum(legal(x.base_name) for x in store.get_file_info(fs.FileSelector(folder)))
        if files != sum(m.rows for m in messages if m is not None):
            raise ValueError("a name occurs twice among the documents")
        with store.open_output_stream(f"{folder}/_SUCCESS"):
            pass

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        store, folder = opened(self.path)
        if store.get_file_info(folder).type == fs.FileType.Directory:
            store.delete_dir(folder)


class NamedFiles(DataSource):
    """Writes ``name, content`` rows (text or bytes; null is empty) to a folder that doesn't exist yet (option ``path``)."""

    @classmethod
    def name(cls) -> str:
        return "named_files"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return FilesWriter(self.options["path"])


cloudpickle.register_pickle_by_value(sys.modules[__name__])
