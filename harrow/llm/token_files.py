"""Operator 13: token ids as files of equal-length sequences, for training to read at random.

A table of token ids is a folder of Arrow files (the stream format with a footer) and a manifest.  The ids of all documents
of a file follow one another and are cut into sequences of ``length`` ids; a file's last sequence is filled up with 0.
Columns of a file: ``ids`` and ``mask`` (fixed-size lists of that length; the mask is true where an id is real), and
``doc_ids`` and ``doc_ends`` (of the documents that end in the sequence, and after how many of its ids).  All batches of a
file but its last hold ``batch`` sequences, and nothing is compressed, so sequence n of a mapped file is found by division
and read without copying (``Sequences``).  Ids take 16 bits where the vocabulary allows, else 32.

``harrow_token_files`` is a data source for both ways.  Each task writes one file, of the documents that it gets in the
order in which it gets them; the commit names the files of the tasks that succeeded in a manifest, in their order, with
the ids before each.  A file that the manifest doesn't name isn't part of the table, so lost executors and repeated tasks
leave nothing in it; a job that fails leaves no manifest, so no table, and what files its last tasks left go with the next
commit to that folder.  Reading is one task a file; a document is put together from its sequences.

Defined results: a null text counts as empty; a document has its end id even so.  Documents without an id come first, then
by id; of equal ids by the text's hash.  Documents of any length are written and read whole.  An empty table gives a
manifest without files, and no documents.  Only doc_id and text of the input are read, so other columns don't matter.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from harrow.llm import word_ids

MANIFEST = "manifest.json"


def store(uri: str):
    """The file system of a path, and the path there."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def read_manifest(uri: str) -> dict:
    files, path = store(uri)
    with files.open_input_file(f"{path}/{MANIFEST}") as f:
        return json.loads(f.read())


def file_schema(length: int, bits: int) -> pa.Schema:
    ids = pa.uint16() if bits == 16 else pa.uint32()
    return pa.schema([("ids", pa.list_(ids, length)), ("mask", pa.list_(pa.bool_(), length)), ("doc_ids", pa.list_(pa.int64())), ("doc_ends", pa.list_(pa.int32()))])


@dataclass
class Written(WriterCommitMessage):
    """What a task wrote: its place among the tasks, the file's name, and how much the file holds."""

    place: int
    name: str | None
    sequences: int
    ids: int
    documents: int


class SequenceBuffer:
    """Collects documents' ids and gives them back as batches of sequences."""

    def __init__(self, length: int, batch: int, bits: int):
        self.length, self.batch, self.schema = length, batch, file_schema(length, bits)
        self.type = np.dtype(f"<u{bits // 8}")
        self.parts: list[np.ndarray] = []
        self.held = self.written = self.sequences = self.documents = 0
        self.docs: list[tuple[int | None, int]] = []  # ids and ends, counted in the file, of what isn't written yet

    def put(self, doc_id: int | None, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.documents += 1
        room = self.length * self.batch
        at = 0
        while len(ids) - at > room - self.held:
            taken = room - self.held
            self.parts.append(ids[at : at + taken])
            at, self.held = at + taken, room
            yield self.take()
        self.parts.append(ids[at:])
        self.held += len(ids) - at
        self.docs.append((doc_id, self.written + self.held))

    def take(self) -> pa.RecordBatch:
        """All that is held, as one batch."""
        flat = np.concatenate(self.parts) if self.parts else np.empty(0, self.type)
        n = -(-len(flat) // self.length)
        filled = np.zeros(n * self.length, self.type)
        filled[: len(flat)] = flat
        real = np.arange(len(filled)) < len(flat)
        ends = np.array([e for _, e in self.docs], np.int64) - self.written
        row = (ends - 1) // self.length
        offsets = pa.array(np.searchsorted(row, np.arange(n + 1)), pa.int32())
        columns = [
            pa.FixedSizeListArray.from_arrays(pa.array(filled), self.length),
            pa.FixedSizeListArray.from_arrays(pa.array(real), self.length),
            pa.ListArray.from_arrays(offsets, pa.array([d for d, _ in self.docs], pa.int64())),
            pa.ListArray.from_arrays(offsets, pa.array((ends - row * self.length).astype(np.int32), pa.int32())),
        ]
        self.written += self.held
        self.sequences += n
        self.parts, self.docs, self.held = [], [], 0
        return pa.RecordBatch.from_arrays(columns, schema=self.schema)


class TokenWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.uri, self.overwrite = options["path"].rstrip("/"), overwrite
        self.length, self.batch, self.bits = (int(options.get(k, d)) for k, d in (("length", 2048), ("batch", 64), ("bits", 32)))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        place, buffer, sink = TaskContext.get().partitionId(), SequenceBuffer(self.length, self.batch, self.bits), None
        files, path = store(self.uri)
        name = f"part-{place:06d}-{uuid.uuid4().hex}.arrow"
        try:
            for rows in iterator:
                for doc_id, ids in zip(rows.column("doc_id").to_pylist(), rows.column("ids"), strict=True):
                    if sink is None:
                        files.create_dir(path, recursive=True)
                        stream = files.open_output_stream(f"{path}/{name}")
                        sink = pa.ipc.new_file(stream, buffer.schema)
                    for full in buffer.put(doc_id, np.frombuffer(ids.as_buffer() if ids.is_valid else b"", buffer.type)):
                        sink.write_batch(full)
            if sink is None:
                return Written(place, None, 0, 0, 0)
            if buffer.held:
                sink.write_batch(buffer.take())
            sink.close()
            stream.close()
        except BaseException:
            if sink is not None:
                stream.close()
                files.delete_file(f"{path}/{name}")
            raise
        return Written(place, name, buffer.sequences, buffer.written, buffer.documents)

    def commit(self, messages: list) -> None:
        files, path = store(self.uri)
        files.create_dir(path, recursive=True)
        old = {f.path.rsplit("/", 1)[-1] for f in files.get_file_info(_inside(path))}
        if MANIFEST in old and not self.overwrite:
            self.abort(messages)
            raise ValueError(f"{self.uri} holds a table")
        named, before = [], 0
        for m in sorted((m for m in messages if m is not None and m.name), key=lambda m: m.place):
            named.append({"name": m.name, "first": before, "ids": m.ids, "sequences": m.sequences, "documents": m.documents})
            before += m.ids
        with files.open_output_stream(f"{path}/{MANIFEST}.new") as out:
            out.write(json.dumps({"length": self.length, "batch": self.batch, "bits": self.bits, "ids": before, "files": named}).encode())
        files.move(f"{path}/{MANIFEST}.new", f"{path}/{MANIFEST}")
        for name in old - {f["name"] for f in named} - {MANIFEST}:  # of an earlier table, or of attempts that failed
            files.delete_file(f"{path}/{name}")

    def abort(self, messages: list) -> None:
        files, path = store(self.uri)
        for m in messages:
            if m is not None and m.name:
                files.delete_file(f"{path}/{m.name}")


def _inside(path: str):
    from pyarrow import fs

    return fs.FileSelector(path, allow_not_found=True)


class TokenFile(InputPartition):
    def __init__(self, name: str, first: int, sequence: int):
        super().__init__(name)
        self.name, self.first, self.sequence = name, first, sequence


class TokenReader(DataSourceReader):
    def __init__(self, options: dict):
        self.uri, self.rows = options["path"].rstrip("/"), options.get("rows", "documents")

    def partitions(self) -> list[TokenFile]:
        out, sequence = [], 0
        for f in read_manifest(self.uri)["files"]:
            out.append(TokenFile(f["name"], f["first"], sequence))
            sequence += f["sequences"]
        return out or [TokenFile("", 0, 0)]

    def read(self, partition: TokenFile) -> Iterator[pa.RecordBatch]:
        if not partition.name:
            return
        files, path = store(self.uri)
        with files.open_input_file(f"{path}/{partition.name}") as source:
            opened = pa.ipc.open_file(source)
            batches = map(opened.get_batch, range(opened.num_record_batches))
            yield from documents_in(batches, partition.first) if self.rows == "documents" else sequences_in(batches, partition.sequence)


def documents_in(batches: Iterator[pa.RecordBatch], first: int, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """doc_id, start, n_tokens, ids (bytes of little-endian unsigned 32-bit integers) of a file's documents, in batches of
    about ``most`` bytes; ``first`` ids stand in earlier files."""
    parts: list[bytes] = []  # of a document that began in an earlier batch
    start = at = first
    rows: list[tuple] = []
    size = 0
    for batch in batches:
        length = batch.schema.field("ids").type.list_size
        flat = batch.column("ids").values.to_numpy(zero_copy_only=True).astype("<u4")
        owner = np.repeat(np.arange(len(batch)), np.diff(batch.column("doc_ends").offsets.to_numpy()))
        ends = owner * length + batch.column("doc_ends").values.to_numpy()
        real = int(np.count_nonzero(batch.column("mask").values.to_numpy(zero_copy_only=False)))
        begin = 0
        for doc_id, end in zip(batch.column("doc_ids").values.to_pylist(), ends.tolist(), strict=True):
            ids = b"".join([*parts, flat[begin:end].tobytes()])
            parts, begin = [], end
            rows.append((doc_id, start, len(ids) // 4, ids))
            start, size = start + len(ids) // 4, size + len(ids)
            if size > most:
                yield _documents(rows)
                rows, size = [], 0
        if begin < real:
            parts.append(flat[begin:real].tobytes())
        at += real
    if rows:
        yield _documents(rows)


def _documents(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()))
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, (_, t) in enumerate(kinds)], names=[n for n, _ in kinds])


def sequences_in(batches: Iterator[pa.RecordBatch], first: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = lambda c, t: pa.ListArray.from_arrays(pa.array(np.arange(len(batch) + 1) * c.type.list_size, pa.int32()), c.values.cast(t))  # noqa: B023, E731
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(first, first + len(batch))), lists(batch.column("ids"), pa.int32()), lists(batch.column("mask"), pa.bool_())], names=["sequence", "ids", "mask"])
        first += len(batch)


class TokenSource(DataSource):
    """``format("harrow_token_files")``.

    Writing takes doc_id and ids (bytes of ``bits`` bits an id); options: length (2048), batch (64), bits (32).  Reading
    gives doc_id, start, n_tokens and ids of documents, or with rows=sequences the sequences with their masks.
    """

    @classmethod
    def name(cls) -> str:
        return "harrow_token_files"

    def schema(self) -> str:
        if self.options.get("rows", "documents") == "documents":
            return "doc_id long, start long, n_tokens long, ids binary"
        return "sequence long, ids array<int>, mask array<boolean>"

    def writer(self, schema, overwrite: bool) -> TokenWriter:
        return TokenWriter(dict(self.options), overwrite)

    def reader(self, schema) -> TokenReader:
        return TokenReader(dict(self.options))


class Sequences:
    """Random access to the sequences of a table: ``self[n]`` is (ids as a numpy view of the mapped file, mask)."""

    def __init__(self, path: str):
        self.manifest = read_manifest(path)
        _, local = store(path.rstrip("/"))
        self.firsts = np.cumsum([0, *(f["sequences"] for f in self.manifest["files"])])
        self.files = [pa.ipc.open_file(pa.memory_map(f"{local}/{f['name']}")) for f in self.manifest["files"]]

    def __len__(self) -> int:
        return int(self.firsts[-1])

    def __getitem__(self, n: int) -> tuple[np.ndarray, pa.Array]:
        if not 0 <= n < len(self):
            raise IndexError(n)
        at = int(np.searchsorted(self.firsts, n, side="right")) - 1
        batch, row = divmod(n - int(self.firsts[at]), self.manifest["batch"])
        found, length = self.files[at].get_batch(batch), self.manifest["length"]
        cut = lambda name: found.column(name).values.slice(row * length, length)
        return cut("ids").to_numpy(zero_copy_only=True), cut("mask")


def ids_column(text: Column, tokenizer_path: str, end_id: int, *, bits: int) -> Column:
    """binary: ids of the whole text as the library gives them without added special tokens, and the end id."""

    @F.arrow_udf("binary")
    def encode(texts: pa.Array) -> pa.Array:
        e = word_ids.encoder(tokenizer_path, plain=False)
        kind = np.dtype(f"<u{bits // 8}")
        end = np.array([end_id], kind).tobytes()
        found = e.encode(texts.to_pylist())
        wide = found if e.dtype == kind else [np.frombuffer(i, e.dtype).astype(kind).tobytes() for i in found]
        return pa.array([i + end for i in wide], pa.binary())

    return encode(text)


def id_bits(tokenizer_path: str, end_id: int) -> int:
    from tokenizers import Tokenizer

    return 16 if max(Tokenizer.from_file(tokenizer_path).get_vocab_size(), end_id + 1) <= 1 << 16 else 32


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TokenSource)


def write_tokens(docs: DataFrame, tokenizer_path: str, path: str, *, end_id: int, length: int = 2048, batch: int = 64) -> None:
    """Writes the ids of all documents in the order of doc_id.

    Texts are dealt to tasks by ranges of that order and encoded there.  The hash and a number of the row stand behind the
    id in the order, so that no range is bound to hold more than one row, however often an id or a text repeats.
    """
    register(docs.sparkSession)
    bits = id_bits(tokenizer_path, end_id)
    rows = docs.select("doc_id", "text").withColumns({"_h": F.xxhash64("text"), "_n": F.monotonically_increasing_id()})
    order = [F.col("doc_id").asc_nulls_first(), F.col("_h"), F.col("_n")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    coded = ranged.select("doc_id", ids_column(F.col("text"), tokenizer_path, end_id, bits=bits).alias("ids"))
    coded.write.format("harrow_token_files").mode("append").options(length=length, batch=batch, bits=bits).save(path)


def read_tokens(spark: SparkSession, path: str, rows: str = "documents") -> DataFrame:
    register(spark)
    return spark.read.format("harrow_token_files").option("rows", rows).load(path)
