"""Mixing sources to target weights.

Every source is a stream of its documents' words, packed into blocks of ``block_words`` words (the
last block of a source may be shorter). Output shards draw how many block slots each source gets
(multinomial, without exceeding what a source still owes), and slot ``j`` of a source reads block
``permute(j mod B)`` of its ``B`` blocks. Blocks and document pieces meet in one join on the block's index.

Defined cases: a null text has size 0 and is never taken; a null source is a source of its own, last
in the order; documents without words and empty tables give taken 0 or no rows; repeated rows are
documents of their own (ordered by id, then text hash); extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import materialize
from .common import WORD_PATTERN, bound_batches, fresh_key, mix64

BLOCK_WORDS = 256
SHARD_BLOCKS = 8192
BUNDLES = 1024          # of shards, drawn by the driver; one task each


def reshare(sizes: list[int], weights: list[float], share: float, cap: float) -> list[float]:
    """Targets: ``share`` of all sizes by weight; a source stops at ``cap`` times its size and what it
    cannot take goes to the others by weight, until none is above."""
    target = [0.0] * len(sizes)
    open_ = [i for i, s in enumerate(sizes) if s > 0]
    left = share * sum(sizes)
    while open_:
        total = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / total > cap * sizes[i]]
        if not full:
            for i in open_:
                target[i] = left * weights[i] / total
            break
        for i in full:
            target[i] = cap * float(sizes[i])
            left -= target[i]
        full_set = set(full)
        open_ = [i for i in open_ if i not in full_set]
    return target


def _rounds(x: np.ndarray, half: int, keys: list[np.uint64]) -> np.ndarray:
    mask = np.uint64((1 << half) - 1)
    shift = np.uint64(half)
    left, right = x >> shift, x & mask
    for k in keys:
        left, right = right, left ^ (mix64(right ^ k) & mask)
    return (left << shift) | right


def _unrounds(x: np.ndarray, half: int, keys: list[np.uint64]) -> np.ndarray:
    mask = np.uint64((1 << half) - 1)
    shift = np.uint64(half)
    left, right = x >> shift, x & mask
    for k in reversed(keys):
        left, right = right ^ (mix64(left ^ k) & mask), left
    return (left << shift) | right


def permute(x: np.ndarray, n: int, seed: int, inverse: bool = False) -> np.ndarray:
    """Pseudorandom permutation of 0..n-1: a four-round Feistel network that walks back into range."""
    half = max(1, math.ceil(math.log2(max(n, 2)) / 2))
    keys = [np.uint64(k) for k in mix64(np.arange(4, dtype=np.uint64) + np.uint64(4 * (seed % (1 << 60)) + 1))]
    step = _unrounds if inverse else _rounds
    y = step(x.astype(np.uint64), half, keys)
    while len(out := np.flatnonzero(y >= np.uint64(n))):
        y[out] = step(y[out], half, keys)
    return y.astype(np.int64)


@dataclass
class SourcePlan:
    """What one source gives: whole block slots, then ``rest`` words of one more slot."""
    source: str | None
    index: int
    size: int
    target: float
    slots: int
    rest: int


def plan_source(source: str | None, index: int, size: int, target: float, block_words: int, seed: int,
                cap: float) -> SourcePlan:
    want = min(round(target), int(cap * size))
    if want <= 0:
        return SourcePlan(source, index, size, target, 0, 0)
    blocks = -(-size // block_words)
    missing = blocks * block_words - size
    epochs, rem = divmod(want, size)
    place = int(permute(np.array([blocks - 1]), blocks, seed + index, inverse=True)[0])
    whole = rem // block_words
    if place < whole or (place == whole and rem - whole * block_words >= block_words - missing):
        whole = (rem + missing) // block_words  # the short block is among the slots taken
    rest = rem - (whole * block_words - (missing if place < whole else 0))
    return SourcePlan(source, index, size, target, epochs * blocks + whole, rest)


def draw(owed: np.ndarray, size: int, seed: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, first slots, slots) per source: multinomial counts with the slots still owed as weights.

    A shard holds ``size`` slots; a source never gets more than it owes, so all totals are met.
    """
    owed = owed.copy()
    given = np.zeros_like(owed)
    shard = 0
    while (left := int(owed.sum())) > 0:
        now = min(size, left)
        rng = np.random.default_rng([*seed, shard])
        got = np.minimum(rng.multinomial(now, owed / left), owed)
        while (short := now - int(got.sum())) > 0:
            room = owed - got
            got += np.minimum(rng.multinomial(short, room / room.sum()), room)
        yield shard, given.copy(), got
        given += got
        owed -= got
        shard += 1


def draw_bundles(owed: np.ndarray, shard_blocks: int, seed: int, most: int) -> tuple[int, list[tuple[int, list[int], list[int]]]]:
    """Shards in a bundle, and (bundle, first slots, slots) of at most ``most`` bundles: what the driver draws, whatever the size.

    The shards of a bundle are drawn from its slots where the bundle is worked on.
    """
    inside = max(1, -(-int(owed.sum()) // (shard_blocks * most)))
    return inside, [(i, a.tolist(), n.tolist()) for i, a, n in draw(owed, shard_blocks * inside, [seed])]


@dataclass
class Mixture:
    docs: DataFrame     # row_id, id, size, source_size, target, first_word, src
    slots: DataFrame    # shard, src, slot, epoch, block, words
    pieces: DataFrame   # row_id, src, block, low, high (word range inside the block), at (word of the document)
    plans: list[SourcePlan]

    def taken(self) -> DataFrame:
        """Every (slot, document piece) of the mix: row_id, shard, slot, epoch, at, words."""
        return (self.slots.join(self.pieces, ["src", "block"]).where("low < words")
                .select("row_id", "shard", "src", "slot", "epoch", "at",
                        (F.least("high", "words") - F.col("low")).alias("words")))


def mix(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
        weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5, cap: float = 2.0,
        block_words: int = BLOCK_WORDS, shard_blocks: int = SHARD_BLOCKS, seed: int = 17) -> Mixture:
    """Plan a mixture of ``share`` times all words. Weights repeat over the sources in code-point order."""
    spark = docs.sparkSession
    sized = materialize(docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), F.col(source).alias("source"),
        F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long").alias("size")), "mix-sizes")
    # one row per source comes to the driver: sources are names of collections, not data
    totals = sorted(((r["source"], r["size"]) for r in sized.groupBy("source").agg(F.sum("size").alias("size")).collect()),
                    key=lambda x: (x[0] is None, x[0] or ""))
    sizes = [s for _, s in totals]
    targets = reshare(sizes, [weights[i % len(weights)] for i in range(len(totals))], share, cap)
    plans = [plan_source(name, i, size, target, block_words, seed, cap)
             for i, ((name, size), target) in enumerate(zip(totals, targets, strict=True))]
    table = spark.createDataFrame([(p.source, p.index, p.size, p.target) for p in plans],
                                  "source string, src int, source_size long, target double")
    named = sized.join(table.withColumnRenamed("source", "__s"),
                       F.col("source").eqNullSafe(F.col("__s"))).drop("__s")

    # place of each document in its source's stream: hash buckets, so that a hot source spreads out
    buckets = 64 + sum(sizes) // (1 << 22)
    named = named.withColumn("bucket", F.pmod(F.xxhash64("id", "text_hash"), F.lit(buckets)))
    inside = Window.partitionBy("src", "bucket").orderBy("id", "text_hash")
    before = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = (named.groupBy("src", "bucket").agg(F.sum("size").alias("t"))
               .select("src", "bucket", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("carried")))
    placed = named.join(carried, ["src", "bucket"]).select(
        F.struct("src", "bucket", F.row_number().over(inside).alias("n")).alias("row_id"),
        "id", "text_hash", "size", "source_size", "target", "src",
        (F.col("carried") + F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
        .alias("first_word"))

    block = F.lit(block_words)
    pieces = placed.where("size > 0").select(
        "row_id", "src", "first_word", "size",
        F.explode(F.sequence((F.col("first_word") / block).cast("long"),
                             ((F.col("first_word") + F.col("size") - 1) / block).cast("long"))).alias("block"))
    low = F.greatest(F.col("first_word") - F.col("block") * block, F.lit(0))
    high = F.least(F.col("first_word") + F.col("size") - F.col("block") * block, block)
    pieces = pieces.select("row_id", "src", "block", low.alias("low"), high.alias("high"),
                           (F.col("block") * block + low - F.col("first_word")).alias("at"))

    owed = np.array([p.slots + (p.rest > 0) for p in plans], dtype=np.int64)
    inside, bundles = draw_bundles(owed, shard_blocks, seed, BUNDLES)
    facts = [(p.index, p.size, -(-p.size // block_words), p.slots, p.rest) for p in plans]

    def slots_of(batches):
        for batch in batches:
            for row in batch.to_pylist():
                base = np.array(row["first"], dtype=np.int64)
                # a bundle of one shard is that shard
                parts = draw(np.array(row["n"], dtype=np.int64), shard_blocks, [seed, row["bundle"]]) if inside > 1 else [
                    (0, np.zeros_like(base), np.array(row["n"], dtype=np.int64))]
                for k, first, counts in parts:
                    for j in np.flatnonzero(counts):
                        src, size, blocks, whole, rest = facts[j]
                        n = int(counts[j])
                        slot = base[j] + first[j] + np.arange(n, dtype=np.int64)
                        at = permute(slot % blocks, blocks, seed + src)
                        count = np.where(at == blocks - 1, size - (blocks - 1) * block_words, block_words)
                        count = np.where(slot >= whole, np.minimum(count, rest), count)
                        yield pa.RecordBatch.from_pydict({
                            "shard": pa.array(np.full(n, row["bundle"] * inside + k, dtype=np.int32)),
                            "src": pa.array(np.full(n, src, dtype=np.int32)), "slot": pa.array(slot),
                            "epoch": pa.array((slot // blocks).astype(np.int32)), "block": pa.array(at),
                            "words": pa.array(count.astype(np.int64))})

    # one task per bundle: a number of partitions that is asked for is not merged
    spread = spark.createDataFrame(bundles, "bundle int, first array<long>, n array<long>").repartition(max(1, len(bundles)), "bundle")
    slots = spread.mapInArrow(slots_of, "shard int, src int, slot long, epoch int, block long, words long")
    return Mixture(placed, slots, pieces, plans)


def mixed_sizes(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Per document: id, size, source_size, target, taken (words of the mix, repeats counted)."""
    m = mix(docs, id_col=id_col, **options)
    taken = m.taken().groupBy("row_id").agg(F.sum("words").alias("taken"))
    return m.docs.join(taken, "row_id", "left").select(
        F.col("id").alias(id_col), "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


_WORD = re.compile(WORD_PATTERN)


def cut_words(text: str, pieces: list[tuple[int, int]]) -> str:
    """The text of word ranges (first word, words) in order: verbatim inside a range, ranges joined by a space."""
    spans = [m.span() for m in _WORD.finditer(text)]
    ranges: list[list[int]] = []
    for at, n in sorted(pieces):
        if ranges and ranges[-1][1] == at:
            ranges[-1][1] += n
        else:
            ranges.append([at, at + n])
    if ranges == [[0, len(spans)]]:
        return text
    return " ".join(text[spans[a][0]:spans[b - 1][1]] for a, b in ranges)


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", n_chars: str = "n_chars",
                    **options) -> DataFrame:
    """The mix as documents: for each epoch a row per document with the words that the epoch takes of it.

    All columns are kept; the character count is that of the new text. Documents of which nothing is taken are gone.
    """
    bound_batches(docs.sparkSession)
    m = mix(docs, id_col=id_col, text=text, source=source, **options)
    names = m.docs.select("row_id", F.col("id").alias("at_id"), F.col("text_hash").alias("at_hash"), F.col("src").alias("at_src"))
    taken = m.taken().groupBy("row_id", "epoch").agg(F.collect_list(F.struct("at", "words")).alias("pieces"))
    named = taken.join(names, "row_id").select("at_id", "at_hash", "at_src", "pieces")
    order = docs.sparkSession.createDataFrame([(p.source, p.index) for p in m.plans], "of string, src int")
    # a row travels as one value, so that its columns may have any name and type
    once = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("hash"), F.col(source).alias("source"),
                       F.struct("*").alias("row")).dropDuplicates(["id", "hash", "source"])
    once = once.join(order, F.col("source").eqNullSafe(F.col("of")))
    fresh = f"pieces_{fresh_key()}"
    both = once.join(named, F.col("id").eqNullSafe(F.col("at_id")) & (F.col("hash") == F.col("at_hash"))
                     & (F.col("src") == F.col("at_src"))).select("row.*", F.col("pieces").alias(fresh))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [cut_words(t, [(p["at"], p["words"]) for p in pieces])
                    for t, pieces in zip(batch.column(text).to_pylist(), batch.column(fresh).to_pylist(), strict=True)]
            batch = batch.drop_columns([fresh])
            batch = batch.set_column(batch.schema.get_field_index(text), text, pa.array(made, pa.string()))
            if n_chars in batch.schema.names:
                lengths = pa.array([len(t) for t in made], batch.schema.field(n_chars).type)
                batch = batch.set_column(batch.schema.get_field_index(n_chars), n_chars, lengths)
            yield batch

    return both.mapInArrow(run, docs.schema)
