"""Token ids in ORC files.

Documents are range-partitioned and sorted by id (rows of one id by a hash of
their text); each partition becomes one ORC file, in the order of its name.  ORC stores ids with integer run-length
encoding in stripes; every stripe carries row indexes (min and max of ``doc_id``
per ``index_rows`` rows) and a Bloom filter on ``doc_id``.  Stripes are read by
different tasks, and a filter on ``doc_id`` is pushed to the reader, which skips
stripes and row groups by their statistics and filters.

Columns: ``part`` (number of the file), ``doc_id``, ``part_start`` (ids of the
documents before it in the file), ``n_tokens`` and ``ids``.

Edge cases: a null or empty text has the end id alone; a null doc_id sorts
first; repeated rows are stored each, next to one another, in several files where
one id has many rows; an empty table makes files without rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadence.llm.tokens import encoder

SCHEMA = "part int, doc_id long, part_start long, n_tokens long, ids array<int>"


def write_token_files(docs: DataFrame, path: str, *, tokenizer: str, end_id: int, partitions: int | None = None, stripe_bytes: int = 16 << 20,
                      index_rows: int = 1_000, compression: str = "zstd", id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text, append ``end_id``, and write ORC files under ``path`` in ascending id order."""
    spark = docs.sparkSession
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, start = encoder(tokenizer), TaskContext.get().partitionId(), 0

        def rows(doc: list, ids: list[bytes]) -> pa.RecordBatch:
            nonlocal start
            n = np.array([len(x) // 4 for x in ids], np.int64)
            offsets = np.concatenate([[0], np.cumsum(n)])
            values = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(ids))])
            out = pa.RecordBatch.from_arrays([pa.array(np.full(len(n), part, np.int32)), pa.array(doc, pa.int64()), pa.array(start + offsets[:-1]), pa.array(n),
                                              pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)], names=["part", "doc_id", "part_start", "n_tokens", "ids"])
            start += int(offsets[-1])
            return out

        def groups(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
            doc, texts, size = [], [], 0
            for d, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                doc.append(d)
                texts.append(text.as_py() or "")
                size += len(texts[-1])
                if size >= 8 << 20:
                    yield doc, texts
                    doc, texts, size = [], [], 0
            if doc:
                yield doc, texts

        for batch in batches:
            for doc, texts in groups(batch):
                yield rows(doc, [ids + end for ids in enc.encode_all(texts)])

    # Rows of one id go by a hash of the text, equal rows by their place in the table: an id with any share of the rows is dealt to many files.
    d = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"), F.xxhash64(docs[text_col]).alias("h"), F.monotonically_increasing_id().alias("n"))
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = d.repartitionByRange(parts, "doc_id", "h", "n").sortWithinPartitions("doc_id", "h", "n")
    ordered.select("doc_id", "text").mapInArrow(run, SCHEMA).write.option("compression", compression).option("orc.stripe.size", stripe_bytes).option("orc.row.index.stride", index_rows) \
        .option("orc.create.index", "true").option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01").orc(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """The files' rows; filters on doc_id and part are pushed to the ORC reader."""
    return spark.read.schema(SCHEMA).orc(path)


def with_starts(files: DataFrame) -> DataFrame:
    """``files`` with ``start``: the ids of all documents before, over all files.

    The offsets are running sums over one row per file."""
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("part").alias("__part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__offset"))
    return files.join(offsets, F.col("part") == F.col("__part")).withColumn("start", F.col("part_start") + F.col("__offset")).drop("__part", "__offset")


def digests(files: DataFrame) -> DataFrame:
    """part, doc_id, part_start, n_tokens and ids_crc32 (of the ids as little-endian unsigned 32-bit integers) of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column(4)
            at, values = col.offsets.to_numpy(), np.asarray(col.values.to_numpy(zero_copy_only=False), "<u4")
            crc = [zlib.crc32(values[s:e]) for s, e in zip(at, at[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(4)), pa.array(crc, pa.int64())], names=["part", "doc_id", "part_start", "n_tokens", "ids_crc32"])

    return files.select("part", "doc_id", "part_start", "n_tokens", "ids").mapInArrow(run, "part int, doc_id long, part_start long, n_tokens long, ids_crc32 long")
