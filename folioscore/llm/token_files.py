"""Token counts of documents in flat token files.

A file is a row of fixed-width token ids with an end-of-document id after each document and no index.
Blocks of a file are searched on their own (one vectorised comparison); what a block cannot know, how
many documents ended before it and how many tokens of an open document reach into it, comes from a prefix
scan over one short row per block.

Defined cases: an empty document has 0 tokens; tokens after the last separator form an open document
(``closed`` false); an empty file or table gives no rows; blocks may arrive in any order, and a
document may span any number of them; null texts count as empty; repeated rows are documents of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import materialize
from .common import bound_batches, fresh_key, once

BLOCK_TOKENS = 1 << 16
END = 50_256        # the free id after the 50,256 byte-pair ranks


def _encoding(shared):
    import tiktoken
    ranks, pattern = shared.value
    return tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def load_ranks(path: str) -> dict[bytes, int]:
    """A vocabulary file of byte strings (base 64) and ranks, read on the driver."""
    import base64
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def write_token_blocks(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id",
                       text: str = "text", end: int = END, block_tokens: int = BLOCK_TOKENS) -> tuple[DataFrame, DataFrame]:
    """Tokenise whole texts into flat files, one per task, kept as rows of (file, block, payload).

    Also returns the manifest (file, ordinal, id): which document stands where, in file order.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    key, shared = fresh_key(), spark.sparkContext.broadcast((ranks, pattern))    # a vocabulary is a fixed table
    width = np.dtype("<u2" if end < 1 << 16 else "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = once(key, lambda: _encoding(shared))
        file = TaskContext.get().partitionId()
        pending, size, block, ordinal = [], 0, 0, 0

        def rows(tokens: np.ndarray, last: bool):
            nonlocal block
            cut = len(tokens) if last else len(tokens) // block_tokens * block_tokens
            parts = [tokens[i:min(i + block_tokens, cut)].tobytes() for i in range(0, cut, block_tokens)]
            if parts:
                n = len(parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file] * n, pa.int32()), pa.array(range(block, block + n), pa.int64()),
                     pa.array(parts, pa.binary()), pa.nulls(n, pa.int64())], ["file", "at", "payload", "id"])
                block += n
            return tokens[cut:]

        for batch in batches:
            ids = batch.column(0)
            n = len(ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array([file] * n, pa.int32()), pa.array(range(ordinal, ordinal + n), pa.int64()),
                 pa.nulls(n, pa.binary()), ids.cast(pa.int64())], ["file", "at", "payload", "id"])
            ordinal += n
            for value in batch.column(1).to_pylist():
                tokens = encoding.encode_ordinary(value or "")
                tokens.append(end)
                pending.append(np.array(tokens, dtype=width))
                size += len(tokens)
                if size >= 8 * block_tokens:
                    pending = [(yield from rows(np.concatenate(pending), False))]
                    size = len(pending[0])
        if pending:
            yield from rows(np.concatenate(pending), True)

    made = materialize(docs.select(F.col(id_col).cast("long"), F.col(text).alias("__text")).mapInArrow(
        run, "file int, at long, payload binary, id long"), "token-files", compression="zstd")
    return (made.where("payload is not null").select("file", F.col("at").alias("block"), "payload"),
            made.where("payload is null").select("file", F.col("at").alias("ordinal"), F.col("id").alias(id_col)))


def read_token_files(spark: SparkSession, path: str, width: int = 2, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Blocks of raw token files on any file system that Spark reads. Files come one at a time to a task,
    so a writer should cut shards at some hundred MB."""
    raw = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "content", "length")
    step = width * block_tokens
    return raw.where("length > 0").select(
        "file", "content", F.explode(F.sequence(F.lit(0).cast("long"), ((F.col("length") - 1) / step).cast("long")))
        .alias("block")).select("file", "block", F.substring("content", F.col("block").cast("int") * step + 1, F.lit(step))
                                .alias("payload"))


def scan_blocks(blocks: DataFrame, end: int = END, width: int = 2) -> DataFrame:
    """Search each block for separators: tokens, separators, tokens before the first and after the last,
    and the lengths of the documents that lie inside."""
    kind = blocks.schema["file"].dataType.simpleString()
    dtype = np.dtype("<u2" if width == 2 else "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, ends, head, tail, inside = [], [], [], [], []
            for payload in batch.column("payload").to_pylist():
                tokens = np.frombuffer(payload, dtype=dtype)
                at = np.flatnonzero(tokens == end)
                n.append(len(tokens))
                ends.append(len(at))
                head.append(int(at[0]) if len(at) else len(tokens))
                tail.append(len(tokens) - 1 - int(at[-1]) if len(at) else len(tokens))
                inside.append((np.diff(at) - 1).tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("file"), batch.column("block"), pa.array(n, pa.int64()), pa.array(ends, pa.int64()),
                 pa.array(head, pa.int64()), pa.array(tail, pa.int64()), pa.array(inside, pa.list_(pa.int64()))],
                ["file", "block", "n", "ends", "head", "tail", "inside"])

    return blocks.select("file", "block", "payload").mapInArrow(
        run, f"file {kind}, block long, n long, ends long, head long, tail long, inside array<long>")


def stitch(scanned: DataFrame) -> DataFrame:
    """(file, ordinal, n_tokens, closed) from block rows: a prefix scan over each file's blocks."""
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    seen = scanned.select(
        "file", "block", "ends", "head", "tail",
        F.coalesce(F.sum("ends").over(before), F.lit(0)).alias("ordinal"),
        F.coalesce(F.sum((F.col("ends") > 0).cast("long")).over(before), F.lit(0)).alias("opened"))
    # what each block leaves open belongs to the document that the next block with a separator closes
    left = seen.groupBy("file", (F.col("opened") + (F.col("ends") > 0).cast("long")).alias("opened")).agg(
        F.sum("tail").alias("carry"))
    closing = seen.where("ends > 0").join(left, ["file", "opened"], "left").select(
        "file", "ordinal", (F.coalesce("carry", F.lit(0)) + F.col("head")).alias("n_tokens"), F.lit(True).alias("closed"))
    inner = scanned.where(F.size("inside") > 0).select("file", "block", F.posexplode("inside").alias("k", "n_tokens"))
    inner = inner.join(seen.select("file", "block", "ordinal"), ["file", "block"]).select(
        "file", (F.col("ordinal") + 1 + F.col("k")).alias("ordinal"), "n_tokens", F.lit(True).alias("closed"))
    totals = scanned.groupBy("file").agg(F.sum("ends").alias("ordinal"), F.sum(F.signum("ends")).cast("long").alias("opened"))
    open_ = totals.join(left, ["file", "opened"]).where("carry > 0").select(
        "file", "ordinal", F.col("carry").alias("n_tokens"), F.lit(False).alias("closed"))
    return closing.unionByName(inner).unionByName(open_)


def count_tokens(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id",
                 text: str = "text", **options) -> DataFrame:
    """Tokenise documents into flat files, scan those for separators, and return id and n_tokens."""
    blocks, manifest = write_token_blocks(docs, ranks, pattern, id_col, text, **options)
    counts = stitch(materialize(scan_blocks(blocks), "token-scan"))
    return manifest.join(counts, ["file", "ordinal"]).select(id_col, "n_tokens")
