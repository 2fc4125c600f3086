"""Token-ID output: documents as compressed id arrays in one sorted set of files, and the way back.

File format: Parquet files whose row groups hold blocks of documents in ascending id order.
A row is one document's ``frame``: its ids as little-endian 16-bit numbers (32-bit for vocabularies
above 65,536), compressed by itself as a zstandard frame with a shared dictionary. ``dictionary`` is
the SHA-256 of that dictionary, which lies beside the files; readers refuse another one.
``part`` and ``place`` (the offset in ids within the part) index the frames: with the small table of
part totals they give each document's offset in the whole. Parquet's own row-group statistics on the
id column lead a lookup of one document to one row group.

The dictionary is trained on the ids of windows at hashed places of a bounded sample of documents
(``SAMPLE``); it changes sizes, never contents.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.pretokens import encoder, vocabulary_size
from tidemark.llm.storage import fixed_sample, parts
from tidemark.llm.words import column
from tidemark.sources.storage import scratch_dir

SAMPLE = 1000  # documents the dictionary is trained on, at most
SAMPLE_CHARS = 4000  # and characters of each of them, from a place its hash tells
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
PORTION = 4 << 20  # bytes of text whose distinct words are looked up at once


def train_dictionary(docs: DataFrame, tokenizer_path: str, kind: str) -> bytes:
    """A dictionary from the ids of a fixed sample; empty when there is too little to train on."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text in column(batch, "text").to_pylist():
                begin = zlib.crc32(text.encode("utf-8", "replace")) % max(1, len(text) - SAMPLE_CHARS + 1)
                texts.append(text[begin : begin + SAMPLE_CHARS])
            yield pa.record_batch([pa.array(encoder(tokenizer_path, kind)(texts), pa.binary())], names=["ids"])

    chosen = fixed_sample(docs.filter("length(text) > 0"), SAMPLE)
    samples = sorted(bytes(r[0]) for r in chosen.select("text").mapInArrow(encode, "ids binary").collect())
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _data(raw: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(raw) if raw else None


def _portions(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about ``PORTION`` bytes of text, one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column(batch, "text")), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    begin = 0
    while begin < batch.num_rows:
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + PORTION, "right")))
        yield batch.slice(begin, end - begin)
        begin = end


def _encode(tokenizer_path: str, kind: str, end_id: int, raw: bytes, mark: str):
    width = np.dtype(kind).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path, kind)
        given = _data(raw)
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=given) if given else zstandard.ZstdCompressor(level=LEVEL)
        end = np.array([end_id], dtype=kind).tobytes()
        place = 0
        for batch in batches:
            for some in _portions(batch):
                blobs = [ids + end for ids in encode(column(some, "text"))]
                n = np.array([len(b) // width for b in blobs], dtype=np.int64)
                places = place + np.cumsum(n) - n
                place += int(n.sum())
                yield pa.record_batch(
                    [column(some, "id"), column(some, "part"), pa.array(places), pa.array(n), pa.array([press.compress(b) for b in blobs], pa.binary()), pa.array([mark] * len(blobs))],
                    names=["id", "part", "place", "n_tokens", "frame", "dictionary"],
                )

    return run


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0, id_column: str = "doc_id", text_column: str = "text") -> None:
    """Encode every whole text and write the files below ``path``, ids ascending over the parts.

    NULL and empty texts have the end id alone. Rows with a NULL id come first; rows with one id
    lie side by side, ordered by text. Other columns are not written.
    """
    kind = "<u2" if vocabulary_size(tokenizer_path) <= 1 << 16 else "<u4"
    docs = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    raw = train_dictionary(docs, tokenizer_path, kind)
    mark = hashlib.sha256(raw).hexdigest()
    spark = docs.sparkSession
    id_type = dict(docs.dtypes)["id"]
    ranged = docs.repartitionByRange(parts(spark, docs, 32 << 20), "id").sortWithinPartitions("id", F.xxhash64("text")).withColumn("part", F.spark_partition_id())
    coded = ranged.mapInArrow(_encode(tokenizer_path, kind, end_id, raw, mark), f"id {id_type}, part int, place long, n_tokens long, frame binary, dictionary string")
    # The frames are compressed already; small row groups make a lookup cheap.
    coded.write.option("compression", "zstd").option("parquet.block.size", 8 << 20).parquet(f"{path}/frames")
    spark.createDataFrame([(mark, bytearray(raw), kind)], "dictionary string, data binary, kind string").coalesce(1).write.parquet(f"{path}/dictionary")


def _decoder(spark: SparkSession, path: str) -> tuple[str, bytes, str]:
    found = spark.read.parquet(f"{path}/dictionary").collect()
    if len(found) != 1 or hashlib.sha256(bytes(found[0]["data"])).hexdigest() != found[0]["dictionary"]:
        raise ValueError(f"{path} has no dictionary that fits its hash")
    return found[0]["dictionary"], bytes(found[0]["data"]), found[0]["kind"]


def _digest(mark: str, raw: bytes, kind: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = _data(raw)
        undo = zstandard.ZstdDecompressor(dict_data=given) if given else zstandard.ZstdDecompressor()
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                some = batch.slice(begin, 512)
                if any(m != mark for m in column(some, "dictionary").to_pylist()):
                    raise ValueError("a frame was written with another dictionary")
                ids = [np.frombuffer(undo.decompress(f), dtype=kind).astype("<u4") for f in column(some, "frame").to_pylist()]
                if any(len(x) != n for x, n in zip(ids, column(some, "n_tokens").to_pylist(), strict=True)):
                    raise ValueError("a frame doesn't hold the ids its index counts")
                out = [column(some, c) for c in ("id", "part", "place", "n_tokens")]
                names = ["id", "part", "place", "n_tokens", "ids_crc32"]
                out.append(pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64()))
                if with_ids:
                    out.append(pa.array([x.astype(np.int64) for x in ids], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.record_batch(out, names=names)

    return run


def read_token_files(spark: SparkSession, path: str, only: Column | None = None, with_ids: bool = False) -> DataFrame:
    """(id, start, n_tokens, ids_crc32[, ids]) per document, from the files alone.

    ``start`` counts the ids of all documents before it. ``only`` is a condition on ``id``; it is
    pushed down to the row groups, so a few documents cost a few row groups.
    """
    mark, raw, kind = _decoder(spark, path)
    frames = spark.read.parquet(f"{path}/frames")
    id_type = dict(frames.dtypes)["id"]
    # One row per part (never per document) is summed up in one task.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = frames.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    starts = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    chosen = frames if only is None else frames.filter(only)
    schema = f"id {id_type}, part int, place long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    read = chosen.mapInArrow(_digest(mark, raw, kind, with_ids), schema)
    more = ["ids"] if with_ids else []
    return read.join(starts, "part").select("id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids_crc32", *more)


def token_files(docs: DataFrame, tokenizer_path: str, path: str | None = None, end_id: int = 0, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Write the files (below the shared checkpoint folder unless ``path`` is given) and read them back."""
    path = path or scratch_dir(docs.sparkSession, "token-files")
    write_token_files(docs, path, tokenizer_path, end_id, id_column, text_column)
    return read_token_files(docs.sparkSession, path).withColumnRenamed("id", id_column)
