"""Removing every long byte string that occurs more than once.

A byte goes if a ``LENGTH``-byte string that covers it also starts anywhere else. Every such string holds an
anchor: the ``ANCHOR``-byte string with the smallest hash of those inside it. Equal strings hold equal anchors at
equal places, so only anchors have to meet. An anchor's context is all bytes a string around it can
reach. Where a whole context occurs twice, everything in it goes. Where only the anchor does, the contexts that
differ are compared: the pieces from the anchor on form a text of numbered symbols, a suffix array of it (linear
grouping construction) brings equal beginnings together, and the strings of neighbours with one anchor
are compared at every place.

``suffix_array`` sorts suffixes into groups by their longest Lyndon prefix. Groups are handled from the highest
down; the previous-smaller pointers of a group's members say which suffixes its prefix extends, and those move to
the end of their own groups. A second pass reads the final groups from the lowest suffix up and puts each next
suffix at the front of its group, so nothing is renamed or sorted again.

Strings and contexts are told apart by 64-bit hashes. Defined cases: null texts are empty; texts shorter than LENGTH lose nothing;
rows are judged as they come, so a repeated row is a copy; equal rows (id and text) get equal results; ids may be
null; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from .common import bound_batches, mix64, powers, prefix_hash, span_hash

LENGTH = 200
ANCHOR = 32
REACH = LENGTH - ANCHOR             # how far a string with the anchor reaches to its left
PIECE = (LENGTH - ANCHOR) // 3
HOT = 20_000                        # contexts of one anchor that are compared by a shuffle of their strings instead
TASK_CONTEXTS = 8_000


def suffix_array(text: list[int]) -> list[int]:
    """Start positions of all suffixes of a list of positive numbers, in lexicographic order."""
    t = [*text, 0]
    n = len(t)
    order = sorted(range(n), key=t.__getitem__)
    place = [0] * n
    group = [0] * n             # where a suffix's group starts
    end = [0] * n               # where the group starting here ends
    for k, i in enumerate(order):
        place[i] = k
        group[i] = k if k == 0 or t[order[k - 1]] != t[i] else group[order[k - 1]]
        end[group[i]] = k
    smaller = [-1] * n
    last = n - 1
    while last > 0:
        start = group[order[last]]
        members = order[start:last + 1]
        if len(members) > 1:
            members.sort()
        held: dict[int, int] = {}
        for i in members:
            j = i - 1
            while j >= 0 and group[j] >= start:
                j = smaller[j]
            smaller[i] = j
            if j >= 0:
                held[j] = held.get(j, 0) + 1
        moved: dict[int, dict[int, list[int]]] = {}
        for j, times in held.items():
            moved.setdefault(group[j], {}).setdefault(times, []).append(j)
        for g, by_times in moved.items():
            to = end[g]
            for times in sorted(by_times, reverse=True):
                top = to
                first = to - len(by_times[times]) + 1
                for j in by_times[times]:
                    other = order[to]
                    order[place[j]], place[other] = other, place[j]
                    order[to], place[j] = j, to
                    group[j] = first
                    to -= 1
                end[first] = top
            if to >= g:
                end[g] = to
        last = start - 1
    out = [-1] * n
    out[0] = n - 1
    done = [False] * n
    done[n - 1] = True
    free = list(range(n))       # next free place of the group starting here
    for k in range(n):
        j = out[k] - 1
        while j >= 0 and not done[j]:
            g = group[j]
            out[free[g]] = j
            free[g] += 1
            done[j] = True
            j = smaller[j]
    return out[1:]


def _sliding(v: np.ndarray, width: int, fn, empty: int) -> np.ndarray:
    """Minimum or maximum of every ``width`` neighbours, from running ones inside blocks."""
    n = len(v)
    padded = np.full(-(-n // width) * width, empty, dtype=np.uint64)
    padded[:n] = v
    blocks = padded.reshape(-1, width)
    ahead = fn.accumulate(blocks, axis=1).ravel()
    back = fn.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return fn(back[:n - width + 1], ahead[width - 1:n])


def anchors(data: np.ndarray, prefix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the smallest ANCHOR-byte strings of all LENGTH-byte strings (all equal ones)."""
    n = len(data)
    hashes = mix64((prefix[ANCHOR:] - prefix[:-ANCHOR]) * powers(n + 1, "inverse")[:n - ANCHOR + 1])
    width = REACH + 1
    least = _sliding(hashes, width, np.minimum, 0xFFFFFFFFFFFFFFFF)
    rim = np.zeros(width - 1, dtype=np.uint64)
    at = np.flatnonzero(_sliding(np.concatenate([rim, least, rim]), width, np.maximum, 0) == hashes)
    return at, hashes[at]


def _reach(at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.maximum(at - REACH, 0), np.minimum(at + LENGTH, n)


def _zipped(docs: DataFrame, id_col: str, text: str, carry: list[str]) -> DataFrame:
    """Rows (rid, rest, z): a row's key, its id and carried columns, and its compressed text, which is what travels."""
    import zstandard

    keyed = _keyed(docs, id_col, text, carry)
    kind = keyed.schema["rest"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            z = pa.array([press.compress(x or b"") for x in batch.column("body").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("rest"), z], ["rid", "rest", "z"])

    return keyed.mapInArrow(run, f"rid long, rest {kind}, z binary")


def _keyed(docs: DataFrame, id_col: str, text: str, carry: list[str]) -> DataFrame:
    carried = [F.struct(*carry).alias("carried")] if carry else []
    return docs.select(F.xxhash64(id_col, text).alias("rid"), F.struct(id_col, *carried).alias("rest"),
                       F.col(text).cast("binary").alias("body"))


def occurrences(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(anchor, context, rid, at, n): every anchor with the hash of its context; n is the text's length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for rid, body in zip(batch.column("rid").to_pylist(), batch.column("body").to_pylist(), strict=True):
                if body is None or len(body) < LENGTH:
                    continue
                data = np.frombuffer(body, dtype=np.uint8)
                prefix = prefix_hash(data)
                at, hashes = anchors(data, prefix)
                low, high = _reach(at, len(data))
                context = mix64(span_hash(prefix, low, high) + (at - low).astype(np.uint64))
                parts.append((hashes, context, np.full(len(at), rid, dtype=np.int64), at, np.full(len(at), len(data))))
            if parts:
                a, c, r, p, n = (np.concatenate(x) for x in zip(*parts, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.view(np.int64)), pa.array(c.view(np.int64)), pa.array(r), pa.array(p.astype(np.int32)),
                     pa.array(n.astype(np.int32))], ["anchor", "context", "rid", "at", "n"])

    return _keyed(docs, id_col, text, []).select("rid", "body").mapInArrow(run, "anchor long, context long, rid long, at int, n int")


def _contexts(first: DataFrame, zipped: DataFrame) -> DataFrame:
    """(anchor, rid, at, left, alone, bytes): the context of each listed occurrence, cut out of its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        open_ = zstandard.ZstdDecompressor()
        for batch in batches:
            for rid, z, places in zip(*(batch.column(c).to_pylist() for c in ("rid", "z", "places")), strict=True):
                body = open_.decompress(z)
                at = np.array([p["at"] for p in places], dtype=np.int64)
                low, high = _reach(at, len(body))
                n = len(places)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p["anchor"] for p in places], pa.int64()), pa.array([rid] * n, pa.int64()),
                     pa.array(at.astype(np.int32)), pa.array((at - low).astype(np.int32)),
                     pa.array([p["alone"] for p in places], pa.bool_()), pa.array([p["hot"] for p in places], pa.bool_()),
                     pa.array([body[a:b] for a, b in zip(low, high, strict=True)], pa.binary())],
                    ["anchor", "rid", "at", "left", "alone", "hot", "bytes"])

    listed = first.groupBy("rid").agg(F.collect_list(F.struct("anchor", "at", "alone", "hot")).alias("places"))
    texts = zipped.select("rid", "z").dropDuplicates(["rid"])
    return texts.join(listed, "rid").mapInArrow(
        run, "anchor long, rid long, at int, left int, alone boolean, hot boolean, bytes binary")


def _flat(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Prefix hash over joined byte strings, and where each starts and ends."""
    size = np.array([len(b) for b in blobs], dtype=np.int64)
    end = np.cumsum(size)
    return prefix_hash(np.frombuffer(b"".join(blobs), dtype=np.uint8)), end - size, end


def _windows(prefix: np.ndarray, start: np.ndarray, end: np.ndarray, left: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each context's string that starts ``step`` bytes before the anchor, and whether there is one."""
    low = start + left - step
    ok = (low >= start) & (low + LENGTH <= end)
    at = np.where(ok, low, 0)
    return span_hash(prefix, at, np.minimum(at + LENGTH, len(prefix) - 1)), ok


def _ordered(anchor: np.ndarray, prefix: np.ndarray, start: np.ndarray, end: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Contexts in the order of the suffix array over their symbols: the anchor, then three pieces to its right."""
    columns = [anchor.view(np.uint64)]
    base = start + left + ANCHOR
    for k in range(3):
        low, high = np.minimum(base + k * PIECE, end), np.minimum(base + (k + 1) * PIECE, end)
        columns.append(span_hash(prefix, low, high))
    table = np.stack(columns, axis=1)
    kinds, kind = np.unique(table, axis=0, return_inverse=True)
    symbols = np.unique(kinds, return_inverse=True)[1].reshape(kinds.shape) + 2
    text = np.concatenate([symbols, np.ones((len(kinds), 1), dtype=symbols.dtype)], axis=1).ravel()
    array = np.array(suffix_array(text.tolist()), dtype=np.int64)
    heads = array[array % 5 == 0] // 5
    rank = np.empty(len(kinds), dtype=np.int64)
    rank[heads] = np.arange(len(heads))
    return np.argsort(rank[kind.ravel()], kind="stable")


def _compare(key: tuple, table: pa.Table) -> pa.Table:
    """Covered stretches (rid, low, high) of the contexts of some anchors: strings found in two contexts."""
    anchor, at, rid, left = (table.column(c).to_numpy() for c in ("anchor", "at", "rid", "left"))
    alone = table.column("alone").to_numpy(zero_copy_only=False)
    blobs = table.column("bytes").to_pylist()
    prefix, start, end = _flat(blobs)
    order = _ordered(anchor, prefix, start, end, left.astype(np.int64))
    anchor, at, rid, left, alone, start, end = (x[order] for x in (anchor, at, rid, left, alone, start, end))
    borders = np.concatenate([[0], np.flatnonzero(anchor[1:] != anchor[:-1]) + 1, [len(anchor)]])
    pieces, lo = [], 0
    for cut in range(1, len(borders)):      # whole anchors, together at least 2,000 contexts
        if borders[cut] - lo < 2000 and cut < len(borders) - 1:
            continue
        part = slice(lo, borders[cut])
        lo = borders[cut]
        n = part.stop - part.start
        twice = np.zeros((n, REACH + 3), dtype=bool)      # a column per step, between two empty ones
        for step in range(REACH + 1):
            value, ok = _windows(prefix, start[part], end[part], left[part].astype(np.int64), step)
            who = np.flatnonzero(ok)
            by = who[np.argsort(value[who], kind="stable")]
            same = value[by[1:]] == value[by[:-1]]
            twice[by[1:][same], REACH - step + 1] = True
            twice[by[:-1][same], REACH - step + 1] = True
        twice[~alone[part]] = False
        change = twice[:, 1:] != twice[:, :-1]
        who, where = np.nonzero(change)
        who, opens, closes = who[::2], where[::2], where[1::2]
        home = at[part][who].astype(np.int64) - REACH
        pieces.append((rid[part][who], home + opens, home + closes - 1 + LENGTH))
    r, a, b = (np.concatenate(x) if pieces else np.zeros(0, dtype=np.int64) for x in zip(*pieces, strict=True))
    return pa.table({"rid": pa.array(r, pa.int64()), "low": pa.array(a.astype(np.int32)), "high": pa.array(b.astype(np.int32))})


def _hot_strings(contexts: DataFrame) -> DataFrame:
    """Covered stretches for anchors with very many contexts: their strings are counted by hash, spread over all tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            prefix, start, end = _flat(batch.column("bytes").to_pylist())
            left, at = (batch.column(c).to_numpy().astype(np.int64) for c in ("left", "at"))
            rid, alone = batch.column("rid").to_numpy(), batch.column("alone").to_numpy(zero_copy_only=False)
            for step in range(REACH + 1):
                value, ok = _windows(prefix, start, end, left, step)
                value = mix64(value + np.uint64(step))      # as in _compare, strings meet at equal places
                yield pa.RecordBatch.from_arrays(
                    [pa.array(value[ok].view(np.int64)), pa.array(rid[ok]), pa.array((at[ok] - step).astype(np.int32)),
                     pa.array(alone[ok])], ["string", "rid", "low", "alone"])

    strings = contexts.select("bytes", "left", "at", "rid", "alone").mapInArrow(
        run, "string long, rid long, low int, alone boolean")
    twice = strings.groupBy("string").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    return strings.join(twice, "string").where("alone").select("rid", "low", (F.col("low") + LENGTH).alias("high"))


def repeated_stretches(docs: DataFrame, zipped: DataFrame, id_col: str, text: str) -> DataFrame:
    """(rid, low, high): byte ranges that go; they may overlap."""
    found = materialize(occurrences(docs, id_col, text), "anchors", compression="zstd")
    counted = found.groupBy("anchor").agg(F.count(F.lit(1)).alias("times"), F.min("context").alias("c1"), F.max("context").alias("c2"))
    counted = counted.where("times > 1").select("anchor", (F.col("c1") == F.col("c2")).alias("uniform"))
    again = materialize(found.join(counted, "anchor"), "repeated-anchors", compression="zstd")

    def whole(rows: DataFrame) -> DataFrame:
        low = F.greatest(F.col("at") - REACH, F.lit(0))
        return rows.select("rid", low.alias("low"), F.least(F.col("at") + LENGTH, F.col("n")).alias("high"))

    mixed = again.where("not uniform")
    kinds = mixed.groupBy("anchor", "context").agg(F.count(F.lit(1)).alias("times"), F.min(F.struct("rid", "at")).alias("one"))
    kinds = materialize(kinds, "contexts")
    several = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"))
    first = kinds.join(several, "anchor").select(
        "anchor", "one.rid", "one.at", (F.col("times") == 1).alias("alone"), (F.col("kinds") > HOT).alias("hot"))
    contexts = materialize(_contexts(first, zipped), "context-bytes", compression="zstd")
    buckets = max(1, kinds.count() // TASK_CONTEXTS)
    cool = contexts.where("not hot").withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets)))
    part = cool.groupBy("bucket").applyInArrow(_compare, "rid long, low int, high int")
    copies = mixed.join(kinds.where("times > 1").select("anchor", "context"), ["anchor", "context"], "left_semi")
    return whole(again.where("uniform")).union(whole(copies)).union(part).union(_hot_strings(contexts.where("hot")))


def _merged(places: list[dict]) -> list[tuple[int, int]]:
    runs: list[list[int]] = []
    for low, high in sorted((p["low"], p["high"]) for p in places):
        if runs and low <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], high)
        else:
            runs.append([low, high])
    return [(a, b) for a, b in runs]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                   carry: list[str] | None = None) -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, kept_sha256 and, with a list of columns to carry along, ``carried`` (a
    struct of those, whatever their names) and ``kept_text``, the remaining text.

    In the text, characters of which only some bytes go are dropped whole.
    """
    bound_batches(docs.sparkSession)
    with_text = carry is not None
    zipped = _zipped(docs, id_col, text, carry or [])
    stretches = repeated_stretches(docs, zipped, id_col, text)
    places = stretches.groupBy("rid").agg(F.collect_set(F.struct("low", "high")).alias("places"))
    kind = zipped.schema["rest"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        open_ = zstandard.ZstdDecompressor()
        for batch in batches:
            total, gone, spans, digest, left = [], [], [], [], []
            for z, cuts in zip(batch.column("z").to_pylist(), batch.column("places").to_pylist(), strict=True):
                body = open_.decompress(z)
                runs = _merged(cuts or [])
                at, parts = 0, []
                for a, b in runs:
                    parts.append(body[at:a])
                    at = b
                parts.append(body[at:])
                rest = b"".join(parts)
                total.append(len(body))
                gone.append(len(body) - len(rest))
                spans.append(len(runs))
                digest.append(hashlib.sha256(rest).hexdigest())
                left.append(b"".join(p.decode("utf-8", "ignore").encode() for p in parts).decode() if with_text else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rest"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()),
                 pa.array(spans, pa.int64()), pa.array(digest, pa.string()), pa.array(left, pa.string())],
                ["rest", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"])

    out = zipped.join(places, "rid", "left").select("rest", "z", "places").mapInArrow(
        run, f"rest {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string")
    return out.select("rest.*", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept_text"] if with_text else []))
