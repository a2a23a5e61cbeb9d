"""Operator 5: token ids in length-delimited binary records with an offset index.

File format, little-endian, one frame per document:

    8 bytes   length n of the payload
    4 bytes   masked crc32 of those 8 bytes
    n bytes   payload: flag (1: the id is null), doc_id (8 bytes), width of an id
              (2 or 4 bytes), ids as unsigned integers of that width
    4 bytes   masked crc32 of the payload

A masked checksum is the crc32 turned right by 15 bits plus 0xa282ead8, so that a
checksum stored within checked data does not check itself.

Documents are range-partitioned and sorted by id (ties: by the text), and each task
writes its rows in order into files of bounded size.  The index (Parquet, one row per
document: file, place of the frame, ids) is written by the same job through Spark's
commit protocol; a file's name holds a random part, so the files of failed or
speculative attempts are never named by the index and never read.

Nulls: a null text counts as empty (the end id alone), null ids come first.  Repeated
rows are records of their own.  An empty table gives an index without rows.  Extra
columns are not looked at.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricetide.llm.common import shared_folder, text_or_empty
from pricetide.llm.tokens import END_ID, encode_texts, text_slices, tokenizer_path

FILE_BYTES = 256 << 20
INDEX = "doc_id long, part int, file_no int, record_no long, file string, position long, n_tokens long"


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: np.ndarray, width: int) -> bytes:
    payload = struct.pack("<BqB", doc_id is None, doc_id or 0, width) + ids.astype(f"<u{width}").tobytes()
    head = struct.pack("<Q", len(payload))
    return b"".join((head, struct.pack("<I", masked(head)), payload, struct.pack("<I", masked(payload))))


def read_frame(stream) -> tuple[int | None, np.ndarray] | None:
    """The next record of an open file; None at its end, ValueError on damage."""
    head = stream.read(12)
    if not head:
        return None
    if len(head) < 12 or struct.unpack("<I", head[8:])[0] != masked(head[:8]):
        raise ValueError("damaged record length")
    n = struct.unpack("<Q", head[:8])[0]
    body = stream.read(n + 4)
    if len(body) < n + 4 or struct.unpack("<I", body[n:])[0] != masked(body[:n]):
        raise ValueError("damaged record")
    null, doc_id, width = struct.unpack_from("<BqB", body)
    return (None if null else doc_id), np.frombuffer(body, f"<u{width}", offset=10, count=(n - 10) // width)


def _store(folder: str):
    """(file system, path) of a folder given as a URI or a plain path."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def _qualified(spark: SparkSession, folder: str) -> str:
    """The folder as a URI: Spark takes a plain path as one of its default file system, so the
    tasks' own readers and writers must do the same."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    uri = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toUri().toString()
    return "file://" + uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri


def write_records(docs: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text",
                  tokenizer: str | None = None, end_id: int = END_ID, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes ``folder``/data and ``folder``/index; returns the index."""
    path = tokenizer or tokenizer_path()
    folder = _qualified(docs.sparkSession, folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _store(folder)
        part, file_no, record_no, out, position, name = TaskContext.get().partitionId(), -1, 0, None, 0, ""
        width = 2 if _highest_id(path) < 1 << 16 else 4
        try:
            for batch in batches:
                for piece in text_slices(batch, "text"):
                    ids, off = encode_texts(piece.column("text"), path, end_id)
                    rows = []
                    for d, a, b in zip(piece.column("doc_id").to_pylist(), off[:-1].tolist(), off[1:].tolist()):
                        if out is None or position >= file_bytes:
                            if out is not None:
                                out.close()
                            file_no, position = file_no + 1, 0
                            name = f"part-{part:06d}-{file_no:04d}-{uuid.uuid4().hex}.rec"
                            fs.create_dir(f"{base}/data", recursive=True)
                            out = fs.open_output_stream(f"{base}/data/{name}")
                        data = frame(d, ids[a:b], width)
                        out.write(data)
                        rows.append((d, part, file_no, record_no, name, position, b - a))
                        position += len(data)
                        record_no += 1
                    yield _batch(rows, (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64()),
                                 ("doc_id", "part", "file_no", "record_no", "file", "position", "n_tokens"))
        finally:
            if out is not None:
                out.close()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    tie = F.xxhash64("text")
    (rows.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie, "text")
         .mapInArrow(write, INDEX).write.parquet(f"{folder}/index"))
    return docs.sparkSession.read.schema(INDEX).parquet(f"{folder}/index")


def _highest_id(path: str) -> int:
    from pricetide.llm.tokens import load_tokenizer
    return load_tokenizer(path).get_vocab_size(with_added_tokens=True) - 1


def _batch(rows: list[tuple], types: tuple, names: tuple) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=list(names))


def record_files(index: DataFrame) -> DataFrame:
    """One row per file with its records, ids and ``first``: the ids in all files before it.
    The window runs over the files (each of hundreds of megabytes), not over records."""
    files = index.groupBy("part", "file_no", "file").agg(F.sum("n_tokens").alias("ids"), F.count(F.lit(1)).alias("records"))
    upto = Window.orderBy("part", "file_no").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("first", F.coalesce(F.sum("ids").over(upto), F.lit(0)))


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each record, read from the files as streams.  A file
    that does not hold the records and ids of its index rows, no more and no less, is an error."""
    folder = _qualified(spark, folder)
    index = spark.read.schema(INDEX).parquet(f"{folder}/index")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _store(folder)
        types, names = (pa.int64(), pa.int64(), pa.int64(), pa.int64()), ("doc_id", "start", "n_tokens", "ids_crc32")
        for batch in batches:
            for name, start, n_ids, n_records in zip(*[batch.column(c).to_pylist() for c in ("file", "first", "ids", "records")]):
                rows, end = [], start + n_ids
                with fs.open_input_stream(f"{base}/data/{name}", buffer_size=1 << 20) as stream:
                    while (record := read_frame(stream)) is not None:
                        d, ids = record
                        rows.append((d, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        start, n_records = start + len(ids), n_records - 1
                        if len(rows) == 10_000:
                            yield _batch(rows, types, names)
                            rows = []
                if n_records or start != end:
                    raise ValueError(f"{name} does not hold the records of its index")
                yield _batch(rows, types, names)

    files = record_files(index).select("file", "first", "ids", "records")
    # a stated number of partitions: the few rows would else be put into one task
    return (files.repartition(max(1, index.select("file").distinct().count()), "file")
            .mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def read_at(folder: str, name: str, position: int) -> tuple[int | None, np.ndarray]:
    """One record by its index row, as a shuffled reader takes it."""
    fs, base = _store(folder)
    with fs.open_input_file(f"{base}/data/{name}") as f:
        f.seek(position)
        return read_frame(f)


def records_round_trip(docs: DataFrame) -> DataFrame:
    """Writes the documents to a new folder and returns what the files hold."""
    folder = shared_folder(docs.sparkSession, "records")
    write_records(docs, folder)
    return read_records(docs.sparkSession, folder)
