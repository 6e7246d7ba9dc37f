"""Near-duplicate detection with SetSketch registers.

A document is its set of distinct five-word shingles. Register i keeps the largest
``floor(1 - log_b(x))`` over the shingles' exponential values x, so it grows with the set, merges by maximum, and
two sets share a register's value about as often as they share shingles. Documents meet where all registers of
a band agree; a likelihood estimate from both sketches and both set sizes drops pairs that are
far away, and the rest is verified on the full sets.

No group is expanded into its pairs: identical word sequences form one class; every class is tried against
the likeliest of its buckets' pivots. A bucket's pivot is the member that stands in the most crowded buckets: where many texts
derive from one, that one, which joins them at once. Members that are left in other components than their pivot's are compared with all
members of the bucket inside tasks, first by sketch, then by full sets; tasks give open members and joining links, never pairs.

What can be lost: a pair at the threshold agrees on no band with a chance of 5 in a million, a pair's sketch falls below
``LEAST_EQUAL`` or ``FAR`` with one of about 1 in 10^7 or less; both fall fast above the threshold.

Defined cases: null, empty and blank texts have no shingles and link with nothing; fewer than five words
make one shingle; rows with equal ids are one document and share its component; a null id gets a null component and is
kept; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from .common import body_parts, bound_batches, mix64, slices, text_bytes, words
from .graph import components

WORDS = 5
REGISTERS = 128
BAND = 4                # registers per band
BASE = 1.001
RATE = 20.0
LIMIT = (1 << 16) - 2
PERCENT = 75
FAR = 0.56              # five standard deviations of the estimate below 0.75
LEAST_EQUAL = 66        # six standard deviations below what 0.75 makes equal
CELL_ROWS = 4096        # sketches on each side of a cell
CELL_SHINGLES = 1 << 20     # shingles on each side of a cell

_SALT = mix64(np.arange(1, 4 * REGISTERS + 16, dtype=np.uint64))
_TIMES = _SALT[:REGISTERS] | np.uint64(1)
_PLUS = _SALT[REGISTERS:2 * REGISTERS]
_PLACE = _SALT[2 * REGISTERS:2 * REGISTERS + WORDS] | np.uint64(1)
_SEQ = _SALT[2 * REGISTERS + WORDS:2 * REGISTERS + WORDS + 2]


def shingle_hashes(hashes: np.ndarray, counts: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of distinct shingles in (row, hash) order, and their number per row."""
    n = np.where(counts >= WORDS, counts - WORDS + 1, np.minimum(counts, 1))
    row = np.repeat(np.arange(len(counts)), n)
    start = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(len(row))
    value = np.zeros(len(row), dtype=np.uint64)
    length = np.minimum(counts, WORDS)[row]
    last = max(len(hashes) - 1, 0)
    for k in range(WORDS):
        part = hashes[np.minimum(start + k, last)] * _PLACE[k]
        value += np.where(k < length, part, np.uint64(0))
    value = mix64(value + length.astype(np.uint64))
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return value[new], np.bincount(row[new], minlength=len(counts)).astype(np.int64)


def registers(shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Rows x REGISTERS sketch values (uint16); rows without shingles are all zero."""
    out = np.zeros((len(counts), REGISTERS), dtype=np.uint16)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    starts = (np.cumsum(counts) - counts)[full]
    for i in range(REGISTERS):
        least = np.minimum.reduceat(shingles * _TIMES[i] + _PLUS[i], starts)
        x = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64) / RATE
        k = np.floor(1.0 - np.log(np.maximum(x, 1e-300)) / np.log(BASE))
        out[full, i] = np.clip(k, 0, LIMIT + 1)
    return out


def likely(more: np.ndarray, less: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Joint maximum-likelihood estimate of the Jaccard similarity from register comparisons and set sizes."""
    u = size_a / (size_a + size_b)
    v = 1.0 - u
    top = np.minimum(u / v, v / u)
    best, value = np.zeros(len(u)), np.full(len(u), -np.inf)

    def log_p(x):
        return np.log(np.maximum(-np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE), 1e-12))

    for step in np.linspace(0, 1, 101):
        j = top * step
        up, down = log_p(u - v * j), log_p(v - u * j)
        same = np.log(np.maximum(1.0 - np.exp(up) - np.exp(down), 1e-12))
        ll = more * up + less * down + (REGISTERS - more - less) * same
        better = ll > value
        best, value = np.where(better, j, best), np.where(better, ll, value)
    return best


def sketch(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, f1, f2 (fingerprint of the word sequence), n (set size), reg (registers) per row."""
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                data, offsets = body_parts(batch.column("body"))
                hashes, counts, first = words(data, offsets)
                shingles, n = shingle_hashes(hashes, counts, first)
                reg = registers(shingles, n)
                place = (np.arange(len(hashes)) - np.repeat(first, counts)).astype(np.uint64)
                prints = np.zeros((2, len(counts)), dtype=np.uint64)
                full = np.flatnonzero(counts)
                if len(full):
                    for k in range(2):
                        scrambled = mix64(hashes * (_SEQ[k] | np.uint64(1)) + mix64(place + _SEQ[k]))
                        prints[k, full] = np.add.reduceat(scrambled, first[full])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(prints[0].view(np.int64)), pa.array(prints[1].view(np.int64)), pa.array(n),
                     pa.array([r.tobytes() for r in reg], pa.binary())], ["id", "f1", "f2", "n", "reg"])

    return text_bytes(docs.withColumn("id", F.col(id_col).cast("long")), "id", text=text).mapInArrow(
        run, "id long, f1 long, f2 long, n long, reg binary")


def _bands(reps: DataFrame) -> DataFrame:
    """(key, band, rep) of every band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            data, _ = body_parts(batch.column("reg"))
            reg = data.view(np.uint16).reshape(batch.num_rows, REGISTERS).astype(np.uint64)
            rep = batch.column("rep").to_numpy()
            for band in range(REGISTERS // BAND):
                key = np.full(len(rep), band + 1, dtype=np.uint64)
                for k in range(BAND):
                    key = mix64(key * np.uint64(0x100000001B3) + reg[:, band * BAND + k])
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(np.full(len(rep), band, dtype=np.int32)),
                                                  pa.array(rep)], ["key", "band", "rep"])

    return reps.select("rep", "reg").mapInArrow(run, "key long, band int, rep long")


def _near(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs (a, b) whose sketches are not far apart, with the estimate j."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (body_parts(batch.column(c))[0].view(np.uint16).reshape(batch.num_rows, REGISTERS) for c in ("ra", "rb"))
            j = likely((x > y).sum(axis=1), (x < y).sum(axis=1), batch.column("na").to_numpy().astype(float),
                       batch.column("nb").to_numpy().astype(float))
            yield batch.select(["a", "b"]).append_column("j", pa.array(j)).filter(pa.array(j >= FAR))

    one = reps.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("reg").alias("ra"))
    two = reps.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("reg").alias("rb"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "na", "nb", "ra", "rb").mapInArrow(run, "a long, b long, j double")


def _set(body: bytes) -> frozenset:
    w = body.lower().split()      # both work on ASCII alone: A-Z, and the six space bytes
    if len(w) < WORDS:
        return frozenset([tuple(w)] if w else [])
    return frozenset(zip(*(w[k:] for k in range(WORDS)), strict=False))


def candidate_texts(docs: DataFrame, wanted: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, body): compressed texts of the documents that share a bucket with another, written once."""
    import zstandard

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            z = [press.compress(x or b"") for x in batch.column("body").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(z, pa.binary())], ["id", "body"])

    return materialize(text_bytes(docs.withColumn("id", F.col(id_col).cast("long")), "id", text=text)
                       .mapInArrow(shrink, "id long, body binary").join(wanted.hint("merge"), "id", "left_semi"), "candidate-texts")


def verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs whose full shingle sets meet the threshold."""
    import zstandard
    pairs = materialize(pairs, "candidates")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, kept = None, frozenset()
        open_ = zstandard.ZstdDecompressor()
        for batch in batches:
            ok = []
            for mine, other in zip(batch.column("ta").to_pylist(), batch.column("tb").to_pylist(), strict=True):
                if other != last:
                    last, kept = other, _set(open_.decompress(other))
                own = _set(open_.decompress(mine))
                both = len(own & kept)
                ok.append(bool(own) and bool(kept) and 100 * both >= PERCENT * (len(own) + len(kept) - both))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    one = texts.select(F.col("id").alias("a"), F.col("body").alias("ta"))
    two = texts.select(F.col("id").alias("b"), F.col("body").alias("tb"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long").distinct()


def _union(parent: dict, a: int, b: int) -> bool:
    """Join two components; False where they are one already."""
    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    a, b = root(a), root(b)
    parent[a] = b
    return a != b


def _cells(members: DataFrame, weight: str, most: int) -> DataFrame:
    """Members of buckets dealt to cells (s, m) of a bounded weight on each side: strays to a row of cells, all to a column.

    A bucket up to the bound is one cell, so rows are made in proportion to the members; beyond it every stray block
    still meets every member block.
    """
    weights = members.groupBy("key").agg(
        (F.sum(weight) / most).cast("int").alias("blocks"),
        (F.coalesce(F.sum(F.when(F.col("stray"), F.col(weight))), F.lit(0)) / most).cast("int").alias("stray_blocks"))
    members = members.join(weights, "key")
    spread = F.xxhash64("rep")
    block = F.pmod(spread, F.col("blocks") + 1).cast("int")
    stray_block = F.pmod(spread, F.col("stray_blocks") + 1).cast("int")
    keep = [c for c in members.columns if c not in ("blocks", "stray_blocks", "stray")]
    left = members.where("stray").select(*keep, F.lit(True).alias("stray"), stray_block.alias("s"),
                                         F.explode(F.sequence(F.lit(0), F.col("blocks"))).alias("m"))
    right = members.select(*keep, F.lit(False).alias("stray"),
                           F.explode(F.sequence(F.lit(0), F.col("stray_blocks"))).alias("s"), block.alias("m"))
    return left.unionByName(right)


def _open_members(members: DataFrame, reps: DataFrame) -> DataFrame:
    """(key, rep) of strays with a partner in another component that the sketches do not put far away, and of such partners.

    A pair that agrees on several bands counts in the first of them. At most one row per member of a bucket, however
    many pairs there are.
    """
    cells = _cells(members.withColumn("one", F.lit(1)), "one", CELL_ROWS).drop("n", "one").join(reps.select("rep", "n", "reg"), "rep")

    def run(key: tuple, table: pa.Table) -> pa.Table:
        stray = table.column("stray").to_numpy(zero_copy_only=False)
        rep, comp, size = (table.column(c).to_numpy() for c in ("rep", "comp", "n"))
        band = table.column("band")[0].as_py()
        reg = np.array([np.frombuffer(r, dtype=np.uint16) for r in table.column("reg").to_pylist()])
        rest = np.flatnonzero(~stray)
        others, other_comp = reg[rest], comp[rest]
        open_ = np.zeros(len(rep), dtype=bool)
        for i in np.flatnonzero(stray):
            same = others == reg[i]
            near = (same.sum(axis=1) >= LEAST_EQUAL) & (other_comp != comp[i])
            near[near] = same[near].reshape(-1, REGISTERS // BAND, BAND).all(axis=2).argmax(axis=1) == band
            at = rest[near]
            j = likely((reg[i] > reg[at]).sum(axis=1), (reg[i] < reg[at]).sum(axis=1),
                       np.full(len(at), size[i], dtype=float), size[at].astype(float)) if len(at) else np.zeros(0)
            open_[at[j >= FAR]] = True
            open_[i] |= bool((j >= FAR).any())
        return pa.table({"key": pa.array(np.full(open_.sum(), key[0].as_py()), pa.int64()), "rep": pa.array(rep[open_], pa.int64())})

    return cells.groupBy("key", "s", "m").applyInArrow(run, "key long, rep long").distinct()


def _stray_links(members: DataFrame, open_: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) between components, decided on full sets where both texts meet.

    Overlaps of a stray with all members of its cell are counted at once from the cell's shingle lists; only links that
    join components are kept, so a cell gives fewer rows than it has members.
    """
    import zstandard
    cells = _cells(members.join(open_, ["key", "rep"]), "n", CELL_SHINGLES)
    cells = cells.join(texts.select(F.col("id").alias("rep"), "body"), "rep").select("key", "s", "m", "rep", "comp", "stray", "body")

    def run(key: tuple, table: pa.Table) -> pa.Table:
        stray = table.column("stray").to_numpy(zero_copy_only=False)
        rep, comp = (table.column(c).to_numpy() for c in ("rep", "comp"))
        unpack = zstandard.ZstdDecompressor()
        bodies = [unpack.decompress(z) for z in table.column("body").to_pylist()]
        shingles, n = shingle_hashes(*words(*body_parts(pa.array(bodies, pa.binary()))))
        _, code = np.unique(shingles, return_inverse=True)
        owner = np.repeat(np.arange(len(n)), n)
        order = np.argsort(code, kind="stable")
        lists, first = owner[order], np.r_[0, np.cumsum(np.bincount(code))] if len(code) else np.zeros(1, dtype=np.int64)
        ends = np.cumsum(n)
        parent: dict = {}
        sets: dict = {}
        found = []
        for i in np.flatnonzero(stray):
            own = code[ends[i] - n[i]:ends[i]]
            both = np.bincount(np.concatenate([lists[first[c]:first[c + 1]] for c in own]) if len(own) else [], minlength=len(n))
            hit = (100 * both >= PERCENT * (n[i] + n - both)) & ~stray & (comp != comp[i]) & (n > 0)
            for j in np.flatnonzero(hit):
                a, b = (sets.setdefault(k, _set(bodies[k])) for k in (i, j))
                shared = len(a & b)
                if 100 * shared >= PERCENT * (len(a) + len(b) - shared) and _union(parent, int(comp[i]), int(comp[j])):
                    found.append((max(rep[i], rep[j]), min(rep[i], rep[j])))
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    return cells.groupBy("key", "s", "m").applyInArrow(run, "a long, b long").distinct()


def stray_links(crowded: DataFrame, groups: DataFrame, reps: DataFrame, texts: DataFrame) -> DataFrame:
    """Links that are left between different components of the buckets.

    Strays are the members outside the component of their bucket's pivot; they are compared with all members.
    """
    named = crowded.join(groups.withColumnRenamed("node", "rep"), "rep", "left").withColumn("comp", F.coalesce("component", "rep"))
    mixed = named.groupBy("key").agg(F.max(F.when(F.col("rep") == F.col("pivot"), F.col("comp"))).alias("main"),
                                     F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key", "main")
    members = named.join(mixed, "key").join(reps.select("rep", "n"), "rep").select(
        "key", "band", "rep", "comp", "n", (F.col("comp") != F.col("main")).alias("stray"))
    members = materialize(members, "mixed-buckets")
    open_ = materialize(_open_members(members, reps), "open-members")
    return _stray_links(members, open_, texts)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, n_shingles, component_id (smallest linked id), kept."""
    sketched = materialize(sketch(docs, id_col, text), "sketches")
    classes = sketched.where("n > 0 and id is not null").groupBy("f1", "f2").agg(
        F.min("id").alias("rep"), F.first("n").alias("n"), F.first("reg").alias("reg"))
    classes = materialize(classes, "classes")
    bands = _bands(classes)
    sizes = bands.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    buckets = materialize(bands.join(sizes, "key"), "buckets")
    # a text that many others derive from stands in the most crowded bucket of nearly every band
    met = materialize(buckets.groupBy("rep").agg(F.sum("members").alias("weight")), "met")
    pivots = buckets.join(met, "rep").groupBy("key").agg(F.max_by("rep", F.struct("weight", -F.col("rep"))).alias("pivot"))
    crowded = materialize(buckets.drop("members").join(pivots, "key"), "crowded")
    met = met.select("rep")
    # later steps look only at sketches that share a bucket with another
    reps = materialize(classes.select("rep", "n", "reg").join(met.hint("merge"), "rep", "left_semi").dropDuplicates(["rep", "reg"]),
                       "candidate-sketches")
    texts = candidate_texts(docs, met.withColumnRenamed("rep", "id"), id_col, text)
    tried = crowded.where("rep <> pivot").select(F.col("rep").alias("a"), F.col("pivot").alias("b")).distinct()
    tried = _near(tried, reps).groupBy("a").agg(F.max_by("b", F.struct("j", -F.col("b"))).alias("b"))
    found = materialize(verify(tried, texts), "verified")
    # an id with several texts joins their classes
    own = sketched.where("n > 0 and id is not null").join(classes.select("f1", "f2", "rep"), ["f1", "f2"]).groupBy("id").agg(
        F.min("rep").alias("b"), F.collect_set("rep").alias("reps")).where(F.size("reps") > 1).select(F.explode("reps").alias("a"), "b")
    links = found.union(own)
    groups = materialize(components(links), "groups")
    late = materialize(stray_links(crowded, groups, reps, texts), "verified")
    if late.take(1):
        groups = materialize(components(groups.where("node <> component").toDF("a", "b").union(late)), "groups")
    named = sketched.join(classes.select("f1", "f2", "rep"), ["f1", "f2"], "left").join(groups, F.col("rep") == F.col("node"), "left")
    named = named.withColumn("component", F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.coalesce("component", "rep")))
    component = F.coalesce("component", "id")
    return named.select(F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), F.col("n").alias("n_shingles"),
                        component.alias("component_id"),
                        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
