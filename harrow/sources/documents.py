"""One document made by many tasks: a data source writer whose parts are joined when all of them are there.

Each task writes its rows' text as a part; the commit copies the parts, in the tasks' order and some bytes at a time, between
the document's head and tail into a file beside them, gives it its name, and deletes the parts.  So no task and no row holds
the document, a repeated task's part is used once, and a job that fails leaves the document as it was.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

COPIED = 4 << 20


@dataclass
class Part(WriterCommitMessage):
    place: int
    name: str | None


class DocumentWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.uri, self.overwrite = options["path"].rstrip("/"), overwrite
        self.name = options.get("name", "document")
        self.head, self.between, self.tail = (base64.b64decode(options.get(k, "")) for k in ("head", "between", "tail"))

    def files(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.uri) if "://" in self.uri or self.uri.startswith("file:") else (fs.LocalFileSystem(), self.uri)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        from pyspark import TaskContext

        files, path = self.files()
        place, name, out = TaskContext.get().partitionId(), f".part-{uuid.uuid4().hex}", None
        try:
            for batch in iterator:
                for text in batch.column(0).to_pylist():
                    if out is None:
                        files.create_dir(path, recursive=True)
                        out = files.open_output_stream(f"{path}/{name}")
                    else:
                        out.write(self.between)
                    out.write(text.encode())
        except BaseException:
            if out is not None:
                out.close()
                files.delete_file(f"{path}/{name}")
            raise
        if out is not None:
            out.close()
        return Part(place, name if out is not None else None)

    def commit(self, messages: list) -> None:
        files, path = self.files()
        files.create_dir(path, recursive=True)
        parts = [m.name for m in sorted((m for m in messages if m is not None and m.name), key=lambda m: m.place)]
        whole = f"{path}/.whole-{uuid.uuid4().hex}"
        with files.open_output_stream(whole) as out:
            out.write(self.head)
            for n, name in enumerate(parts):
                out.write(self.between if n else b"")
                with files.open_input_stream(f"{path}/{name}") as part:
                    while chunk := part.read(COPIED):
                        out.write(chunk)
            out.write(self.tail)
        files.move(whole, f"{path}/{self.name}")
        self.delete(parts)

    def abort(self, messages: list) -> None:
        self.delete([m.name for m in messages if m is not None and m.name])

    def delete(self, names: list[str]) -> None:
        files, path = self.files()
        for name in names:
            files.delete_file(f"{path}/{name}")


class DocumentSource(DataSource):
    """``format("harrow_document")``, for writing alone: a column of text.

    Options: name (of the file in the folder that is written to); head, between and tail (base64 of the bytes before the
    first, between two and after the last of the rows).
    """

    @classmethod
    def name(cls) -> str:
        return "harrow_document"

    def schema(self) -> str:
        return "value string"

    def writer(self, schema, overwrite: bool) -> DocumentWriter:
        return DocumentWriter(dict(self.options), overwrite)


def write_lines(rows: DataFrame, value: Column, order: list[Column], path: str, *, name: str, head: bytes = b"", between: bytes = b"\n", tail: bytes = b"") -> None:
    """Writes the rows' text in their order as one file ``name`` in the folder ``path``: sorted by ranges, a part each."""
    rows.sparkSession.dataSource.register(DocumentSource)
    parts = {"head": head, "between": between, "tail": tail}
    lines = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(value.alias("value"))
    lines.write.format("harrow_document").mode("append").options(name=name, **{k: base64.b64encode(v).decode() for k, v in parts.items()}).save(path)
