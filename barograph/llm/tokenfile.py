"""Token ids on disk: each document compressed alone under one shared dictionary.

A file is a run of documents in ascending order of id::

    magic, width of an id (2 or 4 bytes), count, SHA-256 of the dictionary
    index: id and null flag, number of ids, length of the frame, per document
    frames: zstandard, one per document, back to back

so that one document is read by its index entry and one small frame. Files are
kept as binary values of a Parquet table, which Spark writes to and reads from
any store, with the dictionary in a table beside it.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from barograph.llm.chunks import in_portions
from barograph.llm.tables import stored
from barograph.llm.tokens import token_memory
from barograph.workspace import fresh_folder

MAGIC = b"BGTF"
HEADER = np.dtype([("magic", "S4"), ("width", "<u4"), ("count", "<u8"), ("dictionary", "V32")])
ENTRY = np.dtype([("id", "<i8"), ("null", "u1"), ("n_ids", "<u8"), ("length", "<u8")])

#: The dictionary is trained on at most so many documents, and so many bytes of each.
SAMPLE_DOCUMENTS = 1_000
SAMPLE_BYTES = 16_384
DICTIONARY_BYTES = 65_536
#: A file is closed once its frames have so many bytes.
FILE_BYTES = 4_000_000
LEVEL = 3


def serialized(ids: bytes, width: int) -> bytes:
    return ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()


@lru_cache(maxsize=1)
def id_width(path: str) -> int:
    from tokenizers import Tokenizer

    return 2 if Tokenizer.from_file(path).get_vocab_size() <= 2**16 else 4


def train_dictionary(
    docs: DataFrame, path: str, end: int, key: str = "doc_id", text: str = "text"
) -> bytes:
    """A dictionary from a bounded sample, the documents with the smallest hashes of ids.

    Too few or too small documents give an empty one: frames then stand alone.
    """
    chosen = docs.select(F.col(key).alias("_id")).filter(F.col("_id").isNotNull()).distinct()
    chosen = chosen.orderBy(F.xxhash64("_id"), "_id").limit(SAMPLE_DOCUMENTS)
    own = docs.select(F.col(key).alias("_id"), F.col(text).alias("text"))
    found = own.join(F.broadcast(chosen), "_id").select("text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = id_width(path)
        for batch in batches:
            raw = [serialized(x, width)[:SAMPLE_BYTES] for x in _ids(batch["text"], path, end)]
            yield pa.RecordBatch.from_arrays([pa.array(raw, pa.binary())], ["ids"])

    sample = found.mapInArrow(encode, "ids binary").limit(SAMPLE_DOCUMENTS).collect()
    try:
        parts = [bytes(row["ids"]) for row in sample]
        return zstandard.train_dictionary(DICTIONARY_BYTES, parts).as_bytes()
    except zstandard.ZstdError:
        return b""


def _ids(texts: pa.Array, path: str, end: int) -> Iterator[bytes]:
    memory, last = token_memory(path), np.array([end], "<u4").tobytes()
    for _, run in in_portions(texts):
        for ids in memory.encode(run):
            yield ids + last


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(raw) if raw else None


def frames(
    docs: DataFrame, path: str, end: int, dictionary: bytes, key: str, text: str
) -> DataFrame:
    """doc_id, n_ids and frame per row."""
    own = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("_text"))

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = id_width(path)
        how = zstandard.ZstdCompressor(LEVEL, dict_data=_dictionary(dictionary))
        for batch in batches:
            counts, out, begin = [], [], 0
            for ids in _ids(batch["_text"], path, end):
                counts.append(len(ids) // 4)
                out.append(how.compress(serialized(ids, width)))
                if len(out) == 1_000:
                    yield _frame_batch(batch["doc_id"].slice(begin, len(out)), counts, out)
                    begin, counts, out = begin + len(out), [], []
            yield _frame_batch(batch["doc_id"].slice(begin, len(out)), counts, out)

    return own.mapInArrow(compress, "doc_id long, n_ids long, frame binary")


def _frame_batch(ids: pa.Array, counts: list[int], out: list[bytes]) -> pa.RecordBatch:
    columns = [ids, pa.array(counts, pa.int64()), pa.array(out, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_ids", "frame"])


def file_bytes(rows: list[tuple], dictionary_hash: bytes, width: int) -> bytes:
    """One file of (id, n_ids, frame) rows."""
    header = np.zeros(1, HEADER)
    header[0] = (MAGIC, width, len(rows), dictionary_hash)
    index = np.zeros(len(rows), ENTRY)
    for k, (doc, n, frame) in enumerate(rows):
        index[k] = (doc or 0, doc is None, n, len(frame))
    return b"".join([header.tobytes(), index.tobytes(), *(frame for _, _, frame in rows)])


class TokenFile:
    """Reads one file; ``ids(k)`` unpacks the k-th document alone."""

    def __init__(self, raw: bytes, dictionary: bytes):
        header = np.frombuffer(raw, HEADER, 1)[0]
        if header["magic"] != MAGIC:
            raise ValueError("no token file")
        if header["dictionary"].tobytes() != hashlib.sha256(dictionary).digest():
            raise ValueError("the file was written with another dictionary")
        self.raw = raw
        self.width = int(header["width"])
        self.index = np.frombuffer(raw, ENTRY, int(header["count"]), HEADER.itemsize)
        body = HEADER.itemsize + self.index.nbytes
        self.ends = body + np.cumsum(self.index["length"].astype(np.int64))
        self.how = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))

    def ids(self, k: int) -> np.ndarray:
        end = int(self.ends[k])
        frame = self.raw[end - int(self.index["length"][k]) : end]
        return np.frombuffer(self.how.decompress(frame), f"<u{self.width}").astype("<u4")


def write_tokens(
    docs: DataFrame, folder: str, path: str, end: int, key: str = "doc_id", text: str = "text"
) -> None:
    """Write the files under ``folder``/files and the dictionary under ``folder``/dictionary.

    Documents are encoded once and kept as frames; these, not the texts, are then
    brought in order by ranges of ids. Rows of one id are spread by their frames'
    hash, so a repeated id fills several tasks.
    """
    spark = docs.sparkSession
    dictionary = train_dictionary(docs, path, end, key, text)
    mark = hashlib.sha256(dictionary).digest()
    kept = stored(
        frames(docs, path, end, dictionary, key, text)
        .withColumn("spread", F.xxhash64("frame")),
        "token-frames",
    )
    ordered = kept.repartitionByRange("doc_id", "spread").sortWithinPartitions("doc_id", "spread")
    ordered = ordered.select(F.spark_partition_id().alias("part"), "doc_id", "n_ids", "frame")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, rows, size, number, part = id_width(path), [], 0, 0, 0

        def closed() -> pa.RecordBatch:
            n_ids = sum(n for _, n, _ in rows)
            columns = [[part], [number], [n_ids], [file_bytes(rows, mark, width)]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)],
                ["part", "number", "n_ids", "file"],
            )

        for batch in batches:
            for place, doc, n, frame in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                part = place
                rows.append((doc, n, frame))
                size += len(frame)
                if size >= FILE_BYTES:
                    yield closed()
                    rows, size, number = [], 0, number + 1
        if rows:
            yield closed()

    files = ordered.mapInArrow(gather, "part int, number int, n_ids long, file binary")
    files.write.parquet(f"{folder}/files")
    own = spark.createDataFrame([(mark, dictionary)], "sha256 binary, dictionary binary")
    own.coalesce(1).write.parquet(f"{folder}/dictionary")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Per document from the files: doc_id, start, n_tokens, ids_crc32.

    Files number their ids within their part; the parts' sums, a row for each
    task that wrote, give where each part starts.
    """
    dictionary = bytes(spark.read.parquet(f"{folder}/dictionary").first()["dictionary"])
    files = spark.read.schema("part int, number int, n_ids long, file binary").parquet(
        f"{folder}/files"
    )
    sizes = files.select("part", "number", "n_ids")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))
    parts = parts.select("part", F.coalesce(F.sum("part_ids").over(before), F.lit(0)).alias("p"))
    within = Window.partitionBy("part").orderBy("number")
    within = within.rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.join(parts, "part").select(
        "part",
        "number",
        (F.col("p") + F.coalesce(F.sum("n_ids").over(within), F.lit(0))).alias("first"),
    )

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, number, raw in zip(*batch.columns, strict=True):
                file = TokenFile(raw.as_py(), dictionary)
                counts = file.index["n_ids"].astype(np.int64)
                crc = [zlib.crc32(file.ids(k).tobytes()) for k in range(len(counts))]
                columns = [
                    pa.repeat(part, len(counts)),
                    pa.repeat(number, len(counts)),
                    pa.array(file.index["id"], mask=file.index["null"].astype(bool)),
                    pa.array(np.cumsum(counts) - counts),
                    pa.array(counts),
                    pa.array(crc, pa.int64()),
                ]
                names = ["part", "number", "doc_id", "before", "n_tokens", "ids_crc32"]
                yield pa.RecordBatch.from_arrays(columns, names)

    found = files.select("part", "number", "file").mapInArrow(
        unpack,
        "part int, number int, doc_id long, before long, n_tokens long, ids_crc32 long",
    )
    start = (F.col("first") + F.col("before")).alias("start")
    return found.join(starts, ["part", "number"]).select(
        "doc_id", start, "n_tokens", "ids_crc32"
    )


def token_file_roundtrip(
    docs: DataFrame, path: str, end: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Write all documents' ids and read them back.

    Each document's ids end with ``end``. Null and empty texts have that id
    alone. Null ids come first. Repeated rows: one document each, next to each
    other. Other columns are not looked at. An empty table gives no rows.
    """
    spark = docs.sparkSession
    folder = fresh_folder(spark, "tokens")
    write_tokens(docs, folder, path, end, key, text)
    return read_tokens(spark, folder)
