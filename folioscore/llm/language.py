"""Language identification by string kernels.

The kernel of two texts is the share of character n-grams (lengths 1 to 4, blended) present in both,
``|x & y| / sqrt(|x| |y|)``, over lower-cased whole texts; n-grams are told apart by a 20-bit hash. A bounded
sample of labelled texts gives Nystroem landmarks and the rows of a one-versus-rest kernel ridge
regression; texts are scored by matrix products per batch. The landmarks' n-grams are kept as bits and unpacked
in blocks of bounded size, however many languages there are.

Defined cases: texts that are null or hold no letter get ``und`` with score 0; without any labelled row
everything is ``und``; ties between languages go to the first in code-point order; rows with a null
language are never learned from; rows that are equal in id, text and language are learned from once, each is given a
language; texts of any length are read whole; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import materialize
from .common import bound_batches, fresh_key, once

BITS = 20
LENGTHS = (1, 2, 3, 4)
UNKNOWN = "und"
SHARPNESS = 6.0
BLOCK_CELLS = 1 << 25   # n-grams times landmarks that are unpacked at once
KEPT_CELLS = 1 << 27    # up to this many (half a gigabyte) a worker keeps its blocks unpacked
BATCH = 128             # texts in one product
SPARE = 4               # rows taken by their hash for each one that is needed
_LETTER = re.compile(r"[^\W\d_]")


def present(text: str) -> np.ndarray:
    """Which n-gram buckets occur in a text."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    bits = np.zeros(1 << BITS, dtype=bool)
    h = np.zeros(len(points) + 1, dtype=np.uint32)
    for n in LENGTHS:
        if len(points) < n:
            break
        h = h[:len(points) - n + 1] * np.uint32(0x01000193) ^ points[n - 1:]
        mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D + 2 * n)
        bits[mixed >> np.uint32(32 - BITS)] = True
    return bits


@dataclass
class Model:
    languages: list[str]
    buckets: np.ndarray     # n-gram buckets of any landmark
    table: np.ndarray       # buckets x landmarks, presence, eight landmarks a byte
    norms: np.ndarray       # square root of each landmark's number of n-grams
    weights: np.ndarray     # landmarks x languages
    bias: np.ndarray


def blocks(table: np.ndarray, landmarks: int) -> Iterator[tuple[slice, np.ndarray]]:
    """Runs of rows of a packed table as float matrices of at most BLOCK_CELLS cells."""
    step = max(1, BLOCK_CELLS // max(1, landmarks))
    for at in range(0, len(table), step):
        rows = slice(at, at + step)
        yield rows, np.unpackbits(table[rows], axis=1, count=landmarks).astype(np.float32)


class Scorer:
    """Kernel rows against the landmarks, and predictions, for batches of texts."""

    def __init__(self, model: Model):
        self.model = model
        cells = len(model.table) * len(model.norms)
        self.kept = list(blocks(model.table, len(model.norms))) if cells <= KEPT_CELLS else None

    def kernel(self, texts: list[str]) -> np.ndarray:
        m = self.model
        out = np.zeros((len(texts), len(m.norms)))
        for at in range(0, len(texts), BATCH):
            part = texts[at:at + BATCH]
            found = np.zeros((len(part), len(m.buckets)), dtype=bool)
            size = np.ones(len(part))
            for i, text in enumerate(part):
                bits = present(text)
                found[i] = bits[m.buckets]
                size[i] = max(1, np.count_nonzero(bits))
            shared = np.zeros((len(part), len(m.norms)), dtype=np.float32)      # whole numbers, exact in any order
            for rows, table in self.kept or blocks(m.table, len(m.norms)):
                shared += found[:, rows].astype(np.float32) @ table
            out[at:at + BATCH] = shared / (np.sqrt(size)[:, None] * m.norms)
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        m = self.model
        known = [i for i, t in enumerate(texts) if t and _LETTER.search(t)]
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if not known or not m.languages:
            return names, scores
        margin = self.kernel([texts[i] for i in known]) @ m.weights + m.bias
        best = margin.argmax(axis=1)
        share = np.exp(SHARPNESS * (margin - margin.max(axis=1, keepdims=True)))
        share = share[np.arange(len(known)), best] / share.sum(axis=1)
        for i, b, s in zip(known, best, share, strict=True):
            names[i], scores[i] = m.languages[b], float(s)
        return names, scores


def learning_rows(docs: DataFrame, id_col: str) -> DataFrame:
    return docs.where((F.crc32(F.col(id_col).cast("string")) % 4 != 2) & F.col("lang").isNotNull())


def fit(docs: DataFrame, id_col: str = "doc_id", text: str = "text", landmarks: int = 32, sample: int = 600,
        ridge: float = 1e-2) -> Model:
    """Fit on at most ``sample`` labelled texts per language, ``landmarks`` of them as landmarks."""
    spark = docs.sparkSession
    bound_batches(spark)
    usable = docs.where(F.col(text).rlike(r"\p{L}")).select(
        F.col("lang").alias("lang"), F.col(text).alias("t"), F.xxhash64(id_col, text).alias("h"))
    place = F.pmod(F.xxhash64("h"), F.lit(1 << 30))
    once_each = usable.select("lang", "h").distinct()
    # rows of a common language are thinned out by their hash before they are ranked; one row per language is sent to all
    of = once_each.groupBy("lang").agg(F.count(F.lit(1)).alias("of"))
    few = once_each.join(F.broadcast(of), "lang").where(place < F.lit(float(SPARE * sample << 30)) / F.col("of"))
    chosen = (few.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy(place, "h")))
              .where(F.col("n") <= sample).select("lang", "h", "n"))
    # at most `sample` hashes per language, so the texts stay where they are; repeated rows become one on the map side
    rows = usable.join(F.broadcast(chosen), ["lang", "h"]).groupBy("lang", "n").agg(F.min("t").alias("t"))
    rows = materialize(rows, "learning-rows", compression="zstd").repartition(F.xxhash64("t"))

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.flatnonzero(present(t)).astype(np.int32).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["lang", "grams"])

    # the landmarks: languages x landmarks texts, at most 2^20 n-grams each
    marks = rows.where(F.col("n") <= landmarks).select("lang", "t").mapInArrow(grams, "lang string, grams binary").collect()
    if not marks:
        return Model([], np.zeros(0, np.int32), np.zeros((0, 0), np.uint8), np.zeros(0), np.zeros((0, 0)), np.zeros(0))
    languages = sorted({r["lang"] for r in marks})
    sets = sorted((r["lang"], bytes(r["grams"])) for r in marks)
    sets = [np.frombuffer(g, dtype=np.int32) for _, g in sets]
    buckets = np.unique(np.concatenate(sets))
    table = np.zeros((len(buckets), (len(sets) + 7) // 8), dtype=np.uint8)
    for j, s in enumerate(sets):
        table[np.searchsorted(buckets, s), j // 8] |= 128 >> j % 8
    norms = np.sqrt(np.array([max(1, len(s)) for s in sets], dtype=np.float64))
    between = sum(part.T @ part for _, part in blocks(table, len(sets))).astype(np.float64) / np.outer(norms, norms)
    values, vectors = np.linalg.eigh(between)
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    draft = Model(languages, buckets, table, norms, root, np.zeros(root.shape[1]))
    key, shared = fresh_key(), spark.sparkContext.broadcast(draft)      # its size is bounded by the parameters

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = once(key, lambda: Scorer(shared.value))
        model = scorer.model
        xx = xy = None
        for batch in batches:
            x = scorer.kernel(batch.column(1).to_pylist()) @ model.weights
            x = np.hstack([x, np.ones((len(x), 1))])
            lang = batch.column(0).to_pylist()
            y = np.array([[1.0 if a == b else -1.0 for b in model.languages] for a in lang]).reshape(len(lang), -1)
            xx = x.T @ x if xx is None else xx + x.T @ x
            xy = x.T @ y if xy is None else xy + x.T @ y
        if xx is not None:
            yield pa.RecordBatch.from_pydict({"xx": [xx.tobytes()], "xy": [xy.tobytes()]})

    wide = root.shape[1] + 1
    xx, xy = np.zeros((wide, wide)), np.zeros((wide, len(languages)))
    for r in rows.select("lang", "t").mapInArrow(gram, "xx binary, xy binary").toLocalIterator():
        xx += np.frombuffer(r["xx"]).reshape(xx.shape)
        xy += np.frombuffer(r["xy"]).reshape(xy.shape)
    penalty = ridge * np.eye(wide)
    penalty[-1, -1] = 1e-9
    solved = np.linalg.solve(xx + penalty, xy)
    shared.unpersist()
    return Model(languages, buckets, table, norms, root @ solved[:-1], solved[-1])


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, lang_pred, score (0 to 1)."""
    spark = docs.sparkSession
    bound_batches(spark)
    key, shared = fresh_key(), spark.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = once(key, lambda: Scorer(shared.value))
        for batch in batches:
            names, scores = scorer.predict(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                [id_col, "lang_pred", "score"])

    return docs.select(id_col, F.col(text).alias("__text")).mapInArrow(
        run, f"`{id_col}` {kind}, lang_pred string, score double")


def identify(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Fit on the learning rows, predict all: id, held_out, lang_pred, score."""
    model = fit(learning_rows(docs, id_col), id_col, text, **options)
    held = F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))
    return predict(docs, model, id_col, text).select(id_col, held.alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, model: Model, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows whose language is known to the model, all columns as they are; a null language is filled in."""
    spark = docs.sparkSession
    bound_batches(spark)
    key, shared = fresh_key(), spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = once(key, lambda: Scorer(shared.value))
        for batch in batches:
            names, _ = scorer.predict(batch.column(text).to_pylist())
            given = batch.column(lang).to_pylist()
            filled = pa.array([g if g is not None else n for g, n in zip(given, names, strict=True)], pa.string())
            batch = batch.set_column(batch.schema.get_field_index(lang), lang, filled)
            yield batch.filter(pa.array([n != UNKNOWN for n in names], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
