"""Token ids in Arrow files of equal-length sequences with masks.

Documents follow one another in ascending id order. Each file holds whole
documents, laid end to end and cut into rows of one length; the last row is
padded. Columns, all without offsets or compression, so that a memory-mapped
file gives any row as a view:

- ``ids``: fixed-size list of unsigned integers, 16 bits where the vocabulary allows;
- ``filled``: fixed-size list of booleans, false on padding;
- ``ends``: fixed-size list of booleans, true on the last id of a document;
- ``documents``: ids of the documents that end in the row, in order.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from snapledger.llm.encoding import batches as runs, encoder
from snapledger.session import stage

_BATCH_ROWS = 256
_FILE_ROWS = 4096
_SUFFIX = ".arrow"


def _schema(length: int, kind: pa.DataType) -> pa.Schema:
    return pa.schema(
        [
            ("ids", pa.list_(pa.field("item", kind, nullable=False), length)),
            ("filled", pa.list_(pa.field("item", pa.bool_(), nullable=False), length)),
            ("ends", pa.list_(pa.field("item", pa.bool_(), nullable=False), length)),
            ("documents", pa.list_(pa.int64())),
        ]
    )


class _Writer:
    """One file: rows are written in batches as they fill up."""

    def __init__(self, folder: str, name: str, length: int, kind: pa.DataType):
        self.files, root = pafs.FileSystem.from_uri(folder)
        self.path, self.length, self.kind = f"{root}/{name}", length, kind
        # Another attempt of the same task may write at the same time.
        self.temporary = f"{root}/_{name}-{uuid.uuid4().hex}"
        self.sink = self.files.open_output_stream(self.temporary)
        self.schema = _schema(length, kind)
        self.out = pa.ipc.new_file(self.sink, self.schema)
        self.ids, self.ends, self.names = [], [], []
        self.held = self.rows = self.tokens = self.documents = 0

    def add(self, name, ids: np.ndarray) -> None:
        self.ids.append(ids)
        self.held += len(ids)
        self.tokens += len(ids)
        self.documents += 1
        self.ends.append(self.held - 1)
        self.names.append(name)
        if self.held >= _BATCH_ROWS * self.length:
            self._write(self.held // self.length)

    def _write(self, rows: int) -> None:
        n, length = rows * self.length, self.length
        held = np.concatenate(self.ids) if self.ids else np.zeros(0, self.kind.to_pandas_dtype())
        ids = np.zeros(n, self.kind.to_pandas_dtype())
        ids[: min(n, len(held))] = held[:n]
        places = np.array(self.ends, np.int64)
        done = int(np.searchsorted(places, n))
        ends = np.zeros(n, bool)
        ends[places[:done]] = True
        bounds = np.searchsorted(places[:done] // length, np.arange(rows + 1)).astype(np.int32)
        fixed = lambda flat, field: pa.FixedSizeListArray.from_arrays(flat, type=self.schema.field(field).type)
        self.out.write_batch(
            pa.RecordBatch.from_arrays(
                [
                    fixed(pa.array(ids), "ids"),
                    fixed(pa.array(np.arange(n) < len(held)), "filled"),
                    fixed(pa.array(ends), "ends"),
                    pa.ListArray.from_arrays(pa.array(bounds), pa.array(self.names[:done], pa.int64())),
                ],
                schema=self.schema,
            )
        )
        self.rows += rows
        self.ids, self.held = [held[n:]], max(0, self.held - n)
        self.ends, self.names = (places[done:] - n).tolist(), self.names[done:]

    def close(self) -> None:
        if self.held:
            self._write(-(-self.held // self.length))
        self.out.close()
        self.sink.close()
        self.files.move(self.temporary, self.path)


def write_sequences(
    docs: DataFrame, path: str, folder: str, length=1024, end_id=0, id_col="doc_id", text_col="text"
) -> DataFrame:
    """Encode every whole text, append ``end_id``, write the files to ``folder``.

    Returns the manifest, staged: file, n_rows, n_documents, n_tokens, start (ids
    in all files before it). ``path`` is a tokenizer file, ``folder`` a new folder
    that every executor can reach. Ids of documents are integers. A null or empty
    text is a document of one id, the end. Documents of one id lie in the order
    of a hash of their text, null ids come last, and both keep a row each. An
    empty table gives no files. Other columns are ignored.

    Texts move once, dealt out by ranges of ids; a range that one repeated id
    fills is cut by the hash of the text. A task that runs again writes the same
    files under the same names.
    """
    spark = docs.sparkSession
    # The folder is made once by the driver, so tasks only add files.
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(place)
    order = [F.col("doc_id").asc_nulls_last(), F.col("tie")]
    dealt = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order, "text")
    )

    def write(batches):
        tool = encoder(path)
        kind = pa.uint16() if tool.size <= 1 << 16 else pa.uint32()
        part, made, file = TaskContext.get().partitionId(), 0, None

        def row(file):
            names = ["file", "n_rows", "n_documents", "n_tokens"]
            values = [file.path.rsplit("/", 1)[1], file.rows, file.documents, file.tokens]
            return pa.RecordBatch.from_pydict({k: [v] for k, v in zip(names, values)})

        for batch in batches:
            texts, ids = batch.column("text").to_pylist(), batch.column("doc_id").to_pylist()
            for a, b in runs(texts):
                for name, found in zip(ids[a:b], tool.encode(texts[a:b])):
                    if file is None:
                        file = _Writer(folder, f"part-{part:06d}-{made:06d}{_SUFFIX}", length, kind)
                        made += 1
                    own = np.append(np.frombuffer(found, "<u4"), end_id)
                    file.add(name, own.astype(kind.to_pandas_dtype()))
                    if file.rows >= _FILE_ROWS:
                        file.close()
                        yield row(file)
                        file = None
        if file is not None:
            file.close()
            yield row(file)

    made = dealt.select("doc_id", "text").mapInArrow(
        write, "file string, n_rows long, n_documents long, n_tokens long"
    )
    manifest = stage(made, "sequence-files")
    # One row per file; names sort as the documents do.
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_documents(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files alone.

    The manifest only places each file in the whole. ``ids_crc32`` is taken over
    the ids as little-endian unsigned 32-bit integers.
    """

    def parse(batches):
        for batch in batches:
            for file, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                found = documents(pa.ipc.open_file(content.as_buffer()))
                n = len(found[0])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file.rsplit("/", 1)[1]] * n, pa.string()), *(pa.array(x, pa.int64()) for x in found)],
                    ["file", "doc_id", "local", "n_tokens", "ids_crc32"],
                )

    files = spark.read.format("binaryFile").option("pathGlobFilter", f"part-*{_SUFFIX}").load(folder)
    parsed = files.select("path", "content").mapInArrow(
        parse, "file string, doc_id long, local long, n_tokens long, ids_crc32 long"
    )
    return parsed.join(manifest.select("file", "start"), "file").select(
        "doc_id", (F.col("start") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"
    )


def documents(file: pa.ipc.RecordBatchFileReader) -> tuple[list, list, list, list]:
    """Of each document in a file: id, place of its first id, number of ids, checksum."""
    names, starts, lengths, sums = [], [], [], []
    place, crc, at = 0, 0, 0
    for i in range(file.num_record_batches):
        batch = file.get_batch(i)
        ids = _flat(batch, "ids").to_numpy()
        ends = np.flatnonzero(_flat(batch, "ends").to_numpy(zero_copy_only=False))
        names += batch.column("documents").flatten().to_pylist()
        wide = ids.astype("<u4")
        last = 0
        for end in (ends + 1).tolist():
            sums.append(zlib.crc32(wide[last:end], crc))
            starts.append(place)
            lengths.append(at + end - place)
            place, crc, last = at + end, 0, end
        crc = zlib.crc32(wide[last:], crc)
        at += len(ids)
    return names, starts, lengths, sums


def _flat(batch: pa.RecordBatch, column: str) -> pa.Array:
    return batch.column(column).flatten()


class SequenceFile:
    """Random access to the rows of one file, without copies.

    ``source`` is a path to be memory-mapped, or a buffer.
    """

    def __init__(self, source):
        self.source = pa.memory_map(source) if isinstance(source, str) else pa.BufferReader(source)
        self.file = pa.ipc.open_file(self.source)
        self.starts = np.cumsum([0] + [self.file.get_batch(i).num_rows for i in range(self.file.num_record_batches)])

    def __len__(self) -> int:
        return int(self.starts[-1])

    def ids(self, i: int) -> np.ndarray:
        """The ids of row ``i``: a view of the file."""
        batch, at = self._find(i)
        length = batch.schema.field("ids").type.list_size
        return batch.column("ids").flatten().to_numpy()[at * length : (at + 1) * length]

    def mask(self, i: int, column="filled") -> pa.Array:
        """A mask of row ``i``, bit-packed: a view of the file."""
        batch, at = self._find(i)
        length = batch.schema.field(column).type.list_size
        return batch.column(column).flatten().slice(at * length, length)

    def _find(self, i: int):
        if not 0 <= i < len(self):
            raise IndexError(i)
        k = int(np.searchsorted(self.starts, i, "right")) - 1
        return self.file.get_batch(k), i - int(self.starts[k])

