"""Vector code compression: product codes with codebooks refined over all rows, by equal-average search.

A vector of whole numbers floor(scale * x) is cut into equal consecutive parts; each part is replaced by the index
of the nearest of the entries in its position's codebook. Equal-average search: entries are sorted by the sum of
their components; from the entry whose sum is nearest to the part's the search goes outward on both sides. The
squared gap of sums over the number of components is a lower bound of the squared distance, so a side ends
where that strictly exceeds the best distance (an equal one may still win a tie). All numbers are whole.

Each round is one pass over the rows; tasks send sums per (part, entry), so what reaches the driver and goes back out
is the codebooks: parts x entries x components numbers, whatever the number of rows.

Defined cases: vectors that are null, empty or hold null or non-finite components take no part, nor do vectors of
another length than the one with the smallest id. Lengths that the number of parts does not divide are filled up
with zeros, which change no distance. Rows with a repeated id are rows of their own (equal ids are ordered by
vector when codebooks start, null ids come last). Fewer rows than entries give smaller codebooks, no rows give no rows.
Scaled components beyond +-2^62 are held there; large ones are computed with Python's whole numbers, so nothing overflows
but an error beyond 64 bits, which is held at 2^63 - 1. Other columns of the input are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import bound_batches
from .vectors import finite

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
HELD = 1 << 62
LONGEST = (1 << 63) - 1
BATCH_ROWS = 4096


def quantise(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of doubles: 64-bit numbers where squares of all distances fit, Python's otherwise."""
    with np.errstate(over="ignore"):
        scaled = np.clip(np.floor(vectors.astype(np.float64) * scale), -float(HELD), float(HELD))
    # four squared differences, summed over all components and multiplied by their number, stay below 2^62
    if scaled.size and np.abs(scaled).max() * scaled.shape[1] >= 1 << 29:
        return np.array([[int(x) for x in row] for row in scaled], dtype=object).reshape(scaled.shape)
    return scaled.astype(np.int64)


class Codebook:
    """Entries of one part position, sorted by component sum for the search."""

    def __init__(self, entries: np.ndarray):
        self.sums = entries.sum(axis=1)
        self.order = np.lexsort((np.arange(len(entries)), self.sums))
        self.entries, self.sums = entries[self.order], self.sums[self.order]

    def search(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of the nearest entry of each part; ties to the lower index."""
        if self.entries.dtype == object or parts.dtype == object:
            parts = parts.astype(object)
        n, dim, last = len(parts), parts.shape[1], len(self.sums)
        entries, sums = self.entries.astype(parts.dtype, copy=False), self.sums.astype(parts.dtype, copy=False)
        total = parts.sum(axis=1)
        above = np.searchsorted(sums, total)
        below = above - 1
        best = np.full(n, -1, dtype=parts.dtype)
        index = np.zeros(n, dtype=np.int64)
        left = np.arange(n)
        while len(left):
            up, down = above[left], below[left]
            gap_up = np.where(up < last, sums[np.minimum(up, last - 1)] - total[left], 0)
            gap_down = np.where(down >= 0, total[left] - sums[np.maximum(down, 0)], 0)
            use_up = (up < last) & ((down < 0) | (gap_up <= gap_down))
            gap = np.where(use_up, gap_up, gap_down)
            # the nearer side is beyond the best distance, so the other one is too
            go = ((up < last) | (down >= 0)) & ((best[left] < 0) | ~(gap * gap > best[left] * dim).astype(bool))
            left, use_up = left[go], use_up[go]
            place = np.where(use_up, up[go], down[go])
            difference = parts[left] - entries[place]
            distance = (difference * difference).sum(axis=1)
            name = self.order[place]
            better = (best[left] < 0) | (distance < best[left]) | ((distance == best[left]) & (name < index[left]))
            better = better.astype(bool)
            best[left[better]], index[left[better]] = distance[better], name[better]
            above[left[use_up]] += 1
            below[left[~use_up]] -= 1
        return index, best


def _vectors(column: pa.Array, length: int, parts: int, scale: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)
    fill = -length % parts
    return quantise(np.pad(flat, ((0, 0), (0, fill))) if fill else flat, scale)


def _number_sums(kept: DataFrame, books: list[list[list[int]]], length: int, scale: int) -> DataFrame:
    """(part, entry, count, sums) over all rows; sums are decimals, they do not overflow."""
    parts, width = len(books), len(books[0][0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = [Codebook(_whole(b)) for b in books]
        counts = np.zeros((parts, len(books[0])), dtype=np.int64)
        sums = np.zeros((parts, len(books[0]), width), dtype=object)
        for batch in batches:
            rows = _vectors(batch.column("vector"), length, parts, scale)
            for p in range(parts):
                mine = rows[:, p * width:(p + 1) * width]
                index, _ = search[p].search(mine)
                counts[p] += np.bincount(index, minlength=len(counts[p]))
                part = np.zeros((len(counts[p]), width), dtype=mine.dtype)
                np.add.at(part, index, mine)
                sums[p] += part.astype(object)
        used = [(int(p), int(e), int(counts[p, e]), [str(x) for x in sums[p, e]]) for p, e in np.argwhere(counts)]
        if used:
            yield pa.RecordBatch.from_arrays([
                pa.array([u[0] for u in used], pa.int32()), pa.array([u[1] for u in used], pa.int32()),
                pa.array([u[2] for u in used], pa.int64()), pa.array([u[3] for u in used], pa.list_(pa.string()))],
                ["part", "entry", "n", "sums"])

    partial = kept.select("vector").mapInArrow(run, "part int, entry int, n long, sums array<string>")
    return partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*[
        F.sum(F.col("sums")[i].cast("decimal(38,0)")) for i in range(width)]).alias("sums"))


def _whole(entries: list[list[int]]) -> np.ndarray:
    """A table of whole numbers, as 64-bit ones where squares fit."""
    large = max((abs(x) for e in entries for x in e), default=0) * 16 * len(entries[0]) >= 1 << 29
    return np.array(entries, dtype=object if large else np.int64)


def fit(kept: DataFrame, length: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
        scale: int = SCALE) -> list[list[list[int]]]:
    """Codebooks [part][entry][component] that start as the rows with the smallest ids."""
    first = kept.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    whole = quantise(np.pad(np.array([list(r["vector"]) for r in first]), ((0, 0), (0, -length % parts))), scale)
    width = whole.shape[1] // parts
    books = [[[int(x) for x in row[p * width:(p + 1) * width]] for row in whole] for p in range(parts)]
    for _ in range(rounds):
        for r in _number_sums(kept, books, length, scale).collect():     # parts x entries rows at most
            books[r["part"]][r["entry"]] = [int(x) // r["n"] for x in r["sums"]]
    return books


def assign(kept: DataFrame, books: list[list[list[int]]], length: int, scale: int = SCALE) -> DataFrame:
    """(id, label, code, error): the index of each part's nearest entry in two hex digits, and the squared distance."""
    parts, width = len(books), len(books[0][0])
    digits = np.array([f"{e:02x}" for e in range(len(books[0]))], dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = [Codebook(_whole(b)) for b in books]
        for batch in batches:
            rows = _vectors(batch.column("vector"), length, parts, scale)
            found = [search[p].search(rows[:, p * width:(p + 1) * width]) for p in range(parts)]
            code = sum((digits[index] for index, _ in found[1:]), digits[found[0][0]])
            error = [min(int(e), LONGEST) for e in sum(d.astype(object) for _, d in found)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(code, pa.string()),
                                              pa.array(error, pa.int64())], ["id", "label", "code", "error"])

    label = kept.schema["label"].dataType.simpleString()
    return kept.select("id", "vector", "label").mapInArrow(run, f"id long, label {label}, code string, error long")


def digest(books: list[list[list[int]]]) -> str:
    return hashlib.sha256(",".join(str(x) for part in books for entry in part for x in entry).encode()).hexdigest()


def compress(rows: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every row with a usable vector."""
    bound_batches(rows.sparkSession, BATCH_ROWS)
    kept = rows.select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"),
                       F.col(label).alias("label")).where(finite("vector"))
    first = kept.select("id", "vector").orderBy(F.col("id").asc_nulls_last(), "vector").limit(1).collect()
    if not first:
        return kept.select(F.col("id").alias("vec_id"), F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
                           F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    length = len(first[0]["vector"])
    kept = kept.where(F.size("vector") == length)
    books = fit(kept, length, parts, entries, rounds, scale)
    coded = assign(kept, books, length, scale)
    # summed per label on the map side first; the sums come back by a join that copes with a hot label
    sums = coded.groupBy(F.col("label").alias("of")).agg(
        F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONGEST)).cast("long").alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of"))).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _assign_sql(book: str, out: str) -> str:
    return f"""{out}d as (select x.r, x.p, b.e, list_sum([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(x.v, b.c)])::bigint d
  from x join {book} b on b.p = x.p),
{out} as (select r, p, arg_min(e, [d, e]) e, min(d) d from {out}d group by r, p)"""


def _update_sql(book: str, assigned: str, out: str) -> str:
    return f"""{out}s as (select a.p, a.e, i, sum(x.v[i])::hugeint s, count(*)::hugeint n
  from {assigned} a join x on x.r = a.r and x.p = a.p cross join (select unnest(range(1, (select max(len(v)) from x) + 1)) i) group by all),
{out}l as (select p, e, list((case when s >= 0 then s // n else -((n - 1 - s) // n) end)::bigint order by i) c from {out}s group by all),
{out} as (select b.p, b.e, coalesce(l.c, b.c) c from {book} b left join {out}l l on l.p = b.p and l.e = b.e)"""


SQL = f"""
with kept as (select vec_id, label, [floor(256 * x::double)::bigint for x in embedding] q, row_number() over (order by vec_id) r
  from embeddings where embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
x as (select r, p, q[p * (len(q) // 16) + 1 : (p + 1) * (len(q) // 16)] v from kept, (select unnest(range(16)) p)),
b0 as (select p, r - 1 e, v c from x where r <= 64),
{_assign_sql("b0", "a0")},
{_update_sql("b0", "a0", "b1")},
{_assign_sql("b1", "a1")},
{_update_sql("b1", "a1", "b2")},
{_assign_sql("b2", "a2")},
coded as (select r, string_agg(printf('%02x', e), '' order by p) code, sum(d)::bigint error from a2 group by r),
named as (select k.vec_id, k.label, c.code, c.error from kept k join coded c using (r)),
sha as (select sha256(string_agg(array_to_string(c, ','), ',' order by p, e)) h from b2)
select vec_id, code, error, (sum(error) over (partition by label))::bigint label_error, h codebooks_sha256 from named, sha
"""
