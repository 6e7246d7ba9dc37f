"""Language-model scores by Katz backoff, of any order (ORDER words a gram).

Counts of all grams of training tokens are discounted by Good-Turing estimates, one set per order (counts up to K; larger
counts r keep r - RESERVE, so every context has mass to back off with). A word not seen after its context gets the
context's backoff weight times its probability after the context without its first word, and so on down to single words;
weights are exact: what the seen words leave over, by what their lower probabilities leave over. Words never seen in training
share one unknown class, which gets the unigram mass left over. A text starts in a context of start marks and ends with an
end token.

Every order of a token's gram ends in the same word before it, so tokens are dealt by that word: a bucket has the grams, contexts
and weights of all orders above the first whole. Very frequent contexts are dealt by a word more (hot ones; the words of the gram at last).
Tokens are packed and shuffled once; a first pass over the buckets counts the counts that discounts come from, a second scores.
The most frequent words (at most FREQUENT, whatever the corpus) are numbered in a table that every task has. What a bucket has only
a part of (counts of other words, and of grams of hot contexts) is summed by word between the passes and sent back to the buckets.
Words are 64-bit hashes, contexts hashes of theirs.

Defined cases: a null text is empty and consists of the end token; texts of any length are scored whole; rows with a null id are learned from and not held out; without training rows base_score uses
c = N = V = 0 and score is 0 (one class); equal ids are scored row by row; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, functions as F

from ..session import materialize
from .common import BASE, body_parts, bound_batches, fresh_key, mix64, null_free, once, slices, text_bytes, words

ORDER = 3
K = 5
RESERVE = 0.05
FREQUENT = 1 << 20
FLUSH_TOKENS = 450_000
SLICE_BYTES = 1 << 19       # text that is cut into words at once; takes some fifty times as much memory
BUCKET_TOKENS = 800_000
HOT_SHARE = 4               # a context with more than this part (one in so many) of a bucket's tokens is hot
SEEN_SHARE = 20_000         # contexts of several words are counted where a flush has one in so many of them
START, END = np.uint64(0x51A27), np.uint64(0xE2D)      # keys of the start context and the end token
OUT = "kind string, k1 long, sums array<double>, blob binary"
WORDS = "level int, key long, low long, c long"


def held_out(id_col: str):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 10 == 0, F.lit(False))


def _tokens(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token keys of all rows (each row's end token included), their row, and tokens per row."""
    hashes, counts, _ = words(*body_parts(batch.column("body")))
    row = np.repeat(np.arange(len(counts)), counts + 1)
    token = np.full(len(row), END, dtype=np.uint64)
    last = np.zeros(len(row), dtype=bool)
    last[np.cumsum(counts + 1) - 1] = True
    token[~last] = hashes
    return token, row, counts + 1


def _before(token: np.ndarray, per_row: np.ndarray, order: int) -> list[np.ndarray]:
    """The tokens 1 .. order - 1 places before each one, START where its text has none."""
    at = np.arange(len(token)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    out = []
    for back in range(1, order):
        prior = np.full_like(token, START)
        prior[back:] = token[:-back]
        prior[at < back] = START
        out.append(prior)
    return out


def joined(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a context and the word after it, as a context."""
    return mix64(context * BASE ^ mix64(word))


def _contexts(before: list[np.ndarray]) -> list[np.ndarray]:
    """Hashes of the contexts of 1, 2 .. words; a context of one word is the word."""
    out = []
    for size in range(1, len(before) + 1):
        key = before[size - 1]
        for back in range(size - 2, -1, -1):
            key = joined(key, before[back])
        out.append(key)
    return out


def _unique(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values, a place of each, and the number of each element's value."""
    by = np.argsort(x)
    there = x[by]
    new = np.ones(len(x), dtype=bool)
    new[1:] = there[1:] != there[:-1]
    number = np.empty(len(x), dtype=np.int64)
    number[by] = np.cumsum(new) - 1
    return there[new], by[new], number


def count_words(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """WORDS rows of the training tokens: words (level 1), and contexts of 2 .. order - 1 words that are frequent in a flush; (id, body) rows.

    ``low`` is the context without its first word.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, large, waiting, size = [], 0, [], 0

        def rows(level, key, low, c):
            for at in range(0, len(c), 1 << 16):
                part = slice(at, at + (1 << 16))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(c[part]), level, dtype=np.int32)), pa.array(key[part].view(np.int64)),
                     pa.array(low[part].view(np.int64)), pa.array(c[part].astype(np.int64))], ["level", "key", "low", "c"])

        def flush():
            nonlocal large
            token = np.concatenate([w[0] for w in waiting])
            found.append(np.unique(token, return_counts=True))
            large += len(found[-1][0])
            contexts = _contexts(_before(token, np.concatenate([w[1] for w in waiting]), order))
            for level in range(2, order):
                key, c = np.unique(contexts[level - 1], return_counts=True)
                key, c = (x[c >= max(20, len(token) // SEEN_SHARE)] for x in (key, c))
                first = np.flatnonzero(np.isin(contexts[level - 1], key))
                _, at = np.unique(contexts[level - 1][first], return_index=True)
                yield from rows(level, key, contexts[level - 2][first[at]], c)

        def counted():
            keys, _, at = _unique(np.concatenate([k for k, _ in found]))
            c = np.bincount(at, np.concatenate([c for _, c in found]), len(keys)).astype(np.int64)
            yield from rows(1, keys, np.zeros_like(keys), c)

        for whole in batches:
            for batch in slices(whole, limit=SLICE_BYTES):
                token, _, n = _tokens(batch)
                waiting.append((token, n))
                size += len(token)
                if size >= FLUSH_TOKENS:
                    yield from flush()
                    waiting, size = [], 0
                    if large > 1_200_000:
                        yield from counted()
                        found, large = [], 0
        if waiting:
            yield from flush()
        if found:
            yield from counted()

    return docs.mapInArrow(run, WORDS).groupBy("level", "key", "low").agg(F.sum("c").alias("c"))


def discounts(n: dict[int, int]) -> list[float]:
    """Good-Turing factors d_1..d_K from counts of counts; absolute ones where those are not defined."""
    try:
        top = (K + 1) * n[K + 1] / n[1]
        d = [((r + 1) * n[r + 1] / n[r] / r - top) / (1 - top) for r in range(1, K + 1)]
        if all(0 < x < 1 for x in d):
            return d
    except (KeyError, ZeroDivisionError):
        pass
    return [(r - 0.5) / r for r in range(1, K + 1)]


class Counts:
    """Unigram side of the model: frequent words by number (the more frequent, the smaller), totals, and the hot contexts."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, tokens: int, kinds: int, of_counts: dict[int, int], docs: int):
        by = np.lexsort((keys, -counts))
        self.keys, self.counts = keys[by], counts[by]
        self.place = np.argsort(self.keys).astype(np.int32)
        self.names = self.keys[self.place]
        self.tokens, self.kinds, self.docs = tokens, kinds, docs
        self.d = np.array([0.0, *discounts(of_counts)])
        left = sum(kept(np.array([r]), self.d)[0] * n for r, n in of_counts.items())
        self.unknown = max(1.0 - left / tokens, 1e-12) if tokens else 1.0
        self.hot, self.words_of, self.lower = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def hot_at(self, context: np.ndarray) -> np.ndarray:
        """Numbers of hot contexts, -1 for others."""
        if not len(self.hot):
            return np.full(len(context), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.hot, context), len(self.hot) - 1)
        return np.where(self.hot[at] == context, at, -1)

    def probability(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, kept(c, self.d) / max(self.tokens, 1), self.unknown)

    def base(self, r):
        return np.log10((r + 0.1) / (self.tokens + 0.1 * (self.kinds + 1)))

    def number(self, key: np.ndarray) -> np.ndarray:
        """Numbers of frequent words, -1 for others."""
        at = np.minimum(np.searchsorted(self.names, key), len(self.names) - 1)
        return np.where(self.names[at] == key, self.place[at], -1)


def kept(r: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Discounted counts; ``d``: factors of the counts 0 .. K."""
    return np.where(r <= K, r * d[np.minimum(r, K)], r - RESERVE)


def load_counts(table: DataFrame, docs: int) -> Counts:
    """The bounded part of the counts for the driver: at most FREQUENT words and one row per count value."""
    by_count = {r["c"]: r["n"] for r in table.groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()}
    least, room = 1 << 62, FREQUENT
    for c in sorted(by_count, reverse=True):
        room -= by_count[c]
        if room < 0:
            break
        least = c
    top = table.where(F.col("c") >= least).toArrow()
    keys = top.column("key").to_numpy().view(np.uint64) if top.num_rows else np.zeros(0, dtype=np.uint64)
    counts = top.column("c").to_numpy() if top.num_rows else np.zeros(0, dtype=np.int64)
    return Counts(np.append(keys, START), np.append(counts, 0), sum(c * n for c, n in by_count.items()), sum(by_count.values()),
                  by_count, docs)


def find_hot(found: DataFrame, model: Counts, buckets: int) -> None:
    """Adds the contexts that more than a part of a bucket's tokens stand after, and whose shorter ones are such too."""
    least = model.tokens // (HOT_SHARE * buckets)
    level, key, low, count = (c.to_numpy() for c in found.where((F.col("c") > least) & (F.col("level") > 0)).select(
        "level", "key", "low", "c").toArrow().combine_chunks().columns)
    key, low = key.view(np.uint64), low.view(np.uint64)
    chosen = {1: key[(level == 1) & (key != END)]}
    if model.docs > least:
        chosen[1] = np.append(chosen[1], START)
    lows = {1: np.zeros(len(chosen[1]), dtype=np.uint64)}
    for size in range(2, int(level.max(initial=1)) + 1):
        of = (level == size) & np.isin(low, chosen[size - 1])
        chosen[size], lows[size] = key[of], low[of]
    keys = np.concatenate([*chosen.values()])
    by = np.argsort(keys)
    model.hot = keys[by]
    model.words_of = np.concatenate([np.full(len(k), size) for size, k in chosen.items()])[by]
    model.lower = np.where(model.words_of > 1, np.searchsorted(model.hot, np.concatenate([*lows.values()])[by]), -1)


def _row(**columns) -> pa.RecordBatch:
    """One OUT batch; missing columns are null."""
    n = len(next(iter(columns.values())))
    kinds = {"kind": pa.string(), "k1": pa.int64(), "sums": pa.list_(pa.float64()), "blob": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(columns[c], type=t) if c in columns else pa.nulls(n, t) for c, t in kinds.items()],
                                      list(kinds))


def _press(*arrays: np.ndarray) -> bytes:
    """Arrays packed by the places of their bytes: high bytes of small numbers take next to no room."""
    import zstandard
    kinds = {"int32": 0, "int64": 1, "uint64": 2, "float64": 3}
    raw = b"".join(np.array([len(a), kinds[a.dtype.name]], dtype=np.int64).tobytes()
                   + a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in map(np.ascontiguousarray, arrays))
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _unpress(blob: bytes) -> list[np.ndarray]:
    import zstandard
    raw, at, out = zstandard.ZstdDecompressor().decompress(blob), 0, []
    while at < len(raw):
        n, kind = (int(x) for x in np.frombuffer(raw, dtype=np.int64, count=2, offset=at))
        dtype = np.dtype((np.int32, np.int64, np.uint64, np.float64)[kind])
        planes = np.frombuffer(raw, dtype=np.uint8, count=n * dtype.itemsize, offset=at + 16).reshape(dtype.itemsize, n)
        out.append(planes.T.copy().view(dtype).ravel() if n else np.zeros(0, dtype))
        at += 16 + planes.size
    return out


Dealt = Iterator[tuple[int, tuple]]      # bucket, (kind, flush, n, blob)


def _gathered(rows: Iterator[Row]) -> Iterator[pa.RecordBatch]:
    """(id, held, body) rows as batches, of about SLICE_BYTES of text or one row."""
    waiting, size = [], 0

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*waiting), (pa.int64(), pa.bool_(), pa.binary()))],
                                          ["id", "held", "body"])
    for row in rows:
        waiting.append(tuple(row))
        size += len(row["body"] or b"")
        if size >= SLICE_BYTES or len(waiting) >= 1000:
            yield batch()
            waiting, size = [], 0
    if waiting:
        yield batch()


def _deal(key: str, shared, buckets: int, order: int):
    """Map side: per flush a packed row of tokens, with the words before them, for each bucket, and the documents of the flush."""

    def run(docs: Iterator[Row]) -> Dealt:
        model = once(key, lambda: shared.value)
        part, number = TaskContext.get().partitionId(), 0
        waiting, size = [], 0

        def out():
            nonlocal number
            flush = (part << 24) + number
            number += 1
            token = np.concatenate([w[0] for w in waiting])
            n = np.concatenate([w[1] for w in waiting])
            ids = pa.concat_arrays([w[2] for w in waiting])
            held = np.concatenate([w[3] for w in waiting])
            doc = np.repeat(np.arange(len(n), dtype=np.int32), n)
            names, _, at = _unique(token)
            word = model.number(names)[at].astype(np.int32)
            first = model.number(np.array([START]))[0]
            base = np.bincount(doc, np.where(word >= 0, model.base(model.counts[word]), 0.0), len(n))
            hits = np.bincount(doc, word >= 0, len(n)).astype(np.int64)
            yield flush % buckets, ("d", flush, len(n), _press(
                null_free(ids), ids.is_null().to_numpy(zero_copy_only=False).astype(np.int32), n, hits, held.astype(np.int32), base))
            before, place = _before(token, n, order), np.arange(len(token)) - np.repeat(np.cumsum(n) - n, n)
            numbers = []
            for back in range(1, order):
                prior = np.full_like(word, first)
                prior[back:] = word[:-back]
                prior[place < back] = first
                numbers.append(prior)
            contexts = _contexts(before)
            spread = mix64(contexts[0])
            hot = np.flatnonzero(model.hot_at(contexts[0]) >= 0)
            for longer in [*contexts[1:], None]:
                spread[hot] = mix64(joined(contexts[-1][hot], token[hot]) if longer is None else longer[hot])
                if longer is not None:
                    hot = hot[model.hot_at(longer[hot]) >= 0]
            bucket = spread % np.uint64(buckets)
            sort = bucket << np.uint64(42)
            for shift, x in zip((21, 0), numbers):
                sort |= (x + 1).astype(np.uint64) << np.uint64(shift)
            by = np.argsort(sort)
            edges = np.searchsorted(bucket[by], np.arange(buckets + 1, dtype=np.uint64))
            marked = doc * np.int32(2) + held[doc].astype(np.int32)
            for b in range(buckets):
                at = by[edges[b]:edges[b + 1]]
                if not len(at):
                    continue
                packed = []
                for keys, number_of in ((token, word), *zip(before, numbers, strict=True)):
                    packed += [number_of[at], keys[at][number_of[at] < 0]]
                yield b, ("p", flush, len(n), _press(marked[at], *packed))

        for batch in _gathered(docs):
            token, _, n = _tokens(batch)
            waiting.append((token, n, batch.column("id"), batch.column("held").to_numpy(zero_copy_only=False)))
            size += len(token)
            if size >= FLUSH_TOKENS:
                yield from out()
                waiting, size = [], 0
        if waiting:
            yield from out()

    return run


class Bucket:
    """Tokens of one bucket: their words, contexts of 1, 2 .. words, documents (numbered through the bucket), and whether one learns from them."""

    def __init__(self, model: Counts, rows: list[tuple[int, int, bytes]], order: int):
        parts, self.flushes = [_unpress(blob) for _, _, blob in rows], [flush for flush, _, _ in rows]
        self.shift = np.cumsum([0, *(n for _, n, _ in rows)])

        def keys_of(place):
            number = np.concatenate([p[place] for p in parts])
            key = model.keys[number]
            key[number < 0] = np.concatenate([p[place + 1] for p in parts])
            return key, number
        marked = np.concatenate([p[0] for p in parts])
        self.learn = marked % 2 == 0
        self.doc = (marked >> 1) + np.repeat(self.shift[:-1], [len(p[0]) for p in parts])
        self.word, self.number = keys_of(1)
        before = [keys_of(2 * back + 1)[0] for back in range(1, order)]
        parts.clear()
        self.contexts = _contexts(before)


def _itself(bucket: int) -> int:
    return bucket


def _buckets(rows: Dealt) -> dict[int, dict[str, list[tuple]]]:
    """The rows of a partition (one bucket, where there are as many partitions) by bucket and kind."""
    out: dict[int, dict[str, list[tuple]]] = {}
    for bucket, (kind, *row) in rows:
        out.setdefault(bucket, {}).setdefault(kind, []).append(tuple(row))
    return out


def _survey(key: str, shared, order: int, slices_of: int):
    """Buckets: counts of counts of their grams, and what they have only a part of, by word; (kind, slice, bucket, blob) rows."""

    def run(rows: Dealt) -> Iterator[tuple]:
        model = once(key, lambda: shared.value)
        for bucket, kinds in _buckets(rows).items():
            if "p" not in kinds:
                continue
            t = Bucket(model, kinds["p"], order)
            of, asked = [], []
            rare = np.flatnonzero(t.number < 0)
            names, _, at = _unique(t.word[rare])
            asked.append((np.full(len(names), -1), names, np.bincount(at, t.learn[rare], len(names))))
            for context in t.contexts:
                spot = model.hot_at(context)
                c = np.unique(joined(context, t.word)[(spot < 0) & t.learn], return_counts=True)[1]
                of.append(np.bincount(np.minimum(c, K + 2), minlength=K + 3)[1:K + 2].astype(np.int64))
                part = np.flatnonzero(spot >= 0)
                names, first, at = _unique(joined(context[part], t.word[part]))
                asked.append((spot[part][first], t.word[part][first], np.bincount(at, t.learn[part], len(names))))
            yield "s", 0, bucket, _press(*of)
            spot, word, c = (np.concatenate(x) for x in zip(*asked))
            by = np.argsort(side := mix64(word) % np.uint64(slices_of))
            edges = np.searchsorted(side[by], np.arange(slices_of + 1, dtype=np.uint64))
            for b in range(slices_of):
                some = by[edges[b]:edges[b + 1]]
                if len(some):
                    yield "e", b, bucket, _press(spot[some].astype(np.int32), word[some], c[some].astype(np.int64))

    return run


def _answer(key: str, shared):
    """Words of one slice: whole counts for the buckets that asked, and sums of hot contexts that don't hang on discounts.

    By context: grams with counts 1 .. K + 1, with more than K, tokens; grams whose lower gram has a count of 1 .. K; larger
    lower counts, each less RESERVE.
    """

    def run(table: pa.Table) -> pa.Table:
        model = once(key, lambda: shared.value)
        parts = [_unpress(b) for b in table.column("blob").to_pylist()]
        spot, word, c = (np.concatenate(x) for x in zip(*parts))
        asked = np.where(spot < 0, word, joined(model.hot[spot], word) if len(model.hot) else word)
        names, first, at = _unique(asked)
        whole = np.bincount(at, c, len(names)).astype(np.int64)
        out, begin = [], 0
        for bucket, p in zip(table.column("bucket").to_pylist(), parts):
            mine = slice(begin, begin + len(p[0]))
            out.append(_row(kind=["r"], k1=[bucket], blob=[_press(asked[mine], whole[at[mine]])]))
            begin += len(p[0])
        pick = np.flatnonzero((spot[first] >= 0) & (whole > 0))
        if len(pick):
            h, r, w = spot[first][pick].astype(np.int64), whole[pick], word[first][pick]
            low = model.lower[h]
            below = model.number(w)
            lower = model.counts[below]
            look = (low >= 0) | (below < 0)
            lower[look] = whole[np.searchsorted(names, np.where(low >= 0, joined(model.hot[low], w), w)[look])]
            kinds, n = np.unique(h), len(model.hot)
            sums = [*(np.bincount(h, r == k, n) for k in range(1, K + 2)), np.bincount(h, r > K, n), np.bincount(h, r, n),
                    *(np.bincount(h, lower == k, n) for k in range(1, K + 1)),
                    np.bincount(h, np.where(lower > K, lower - RESERVE, 0), n)]
            out.append(_row(kind=["h"] * len(kinds), k1=kinds, sums=[*np.stack(sums, axis=1)[kinds].astype(float)]))
        return pa.Table.from_batches(out)

    return run


class Rules:
    """Discounts of the orders above the first; tokens, mass taken by discounts and mass of lower grams of hot contexts."""

    def __init__(self, model: Counts, order: int, of: np.ndarray, sums: np.ndarray):
        for size in range(1, order):
            of[size - 1] += sums[model.words_of == size, :K + 1].sum(0).astype(np.int64)
        self.d = [model.d, *(np.array([0.0, *discounts(dict(enumerate(n.tolist(), 1)))]) for n in of)]
        large, self.total, lower, rest = sums[:, K + 1], sums[:, K + 2], sums[:, K + 3:2 * K + 3], sums[:, 2 * K + 3]
        r = np.arange(1, K + 1)
        own = np.array([self.d[size][1:] for size in model.words_of]).reshape(-1, K)
        low = np.array([self.d[size - 1][1:] for size in model.words_of]).reshape(-1, K)
        self.lost = (sums[:, :K] * r * (1 - own)).sum(1) + large * RESERVE
        whole = np.where(model.lower >= 0, self.total[model.lower], model.tokens) if len(model.hot) else np.zeros(0)
        self.mass = ((lower * r * low).sum(1) + rest) / np.maximum(whole, 1)


def _score(key: str, shared, order: int, rules: Rules):
    """Buckets: log10 probabilities of their tokens, summed by document; rows of documents are handed on. (kind, flush, blob) rows."""

    def run(rows: Dealt) -> Iterator[tuple]:
        model = once(key, lambda: shared.value)
        for kinds in _buckets(rows).values():
            for flush, _, blob in kinds.get("d", []):
                yield "d", flush, blob
            if "p" in kinds:
                yield from scored(model, Bucket(model, kinds["p"], order), [_unpress(blob) for _, _, blob in kinds.get("r", [])])

    def scored(model: Counts, t: Bucket, replies: list[list[np.ndarray]]) -> Iterator[tuple]:
        asked, whole = (np.concatenate(x) for x in zip(*replies)) if replies else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        by = np.argsort(asked)
        asked, whole = asked[by], whole[by]

        def answer(names):
            return whole[np.searchsorted(asked, names)]
        count = model.counts[t.number]
        rare = np.flatnonzero(t.number < 0)
        count[rare] = answer(t.word[rare])
        p = model.probability(count)
        for size in range(1, order):
            d, context = rules.d[size], t.contexts.pop(0)
            names, first, at = _unique(joined(context, t.word))
            r = np.bincount(at, t.learn, len(names)).astype(np.int64)
            below, context = p[first], context[first]
            known, _, of = _unique(context)
            spot = model.hot_at(known)
            hot = spot[of] >= 0
            r[hot] = answer(names[hot])
            held_back = kept(r, d)
            total = np.bincount(of, r, len(known))
            lost = np.bincount(of, r - held_back, len(known))
            mass = np.bincount(of, np.where(r > 0, below, 0.0), len(known))
            for own, of_all in ((total, rules.total), (lost, rules.lost), (mass, rules.mass)):
                own[spot >= 0] = of_all[spot[spot >= 0]]
            weight = np.where(total > 0, lost / np.maximum(total, 1) / (1.0 - np.where(total > 0, mass, 0.0)), 1.0)
            p = np.where(r > 0, held_back / np.maximum(total[of], 1), weight[of] * below)[at]
        n = t.shift[-1]
        there = np.flatnonzero(np.bincount(t.doc, minlength=n))
        score = np.bincount(t.doc, np.log10(p), n)[there]
        odd = t.doc[rare]
        hits, base = np.bincount(odd, count[rare] > 0, n)[there].astype(np.int32), np.bincount(odd, model.base(count[rare]), n)[there]
        edges = np.searchsorted(there, t.shift)
        for k, f in enumerate(t.flushes):
            s = slice(edges[k], edges[k + 1])
            yield "a", f, _press((there[s] - t.shift[k]).astype(np.int32), score[s], hits[s], base[s])

    return run


def _documents(table: pa.Table) -> pa.Table:
    """The documents of one flush, with what the buckets found for them."""
    ids, none, n, hits, held, base = _unpress(table.filter(pc.equal(table.column("kind"), "d")).column("blob")[0].as_py())
    score = np.zeros(len(n))
    for blob in table.filter(pc.equal(table.column("kind"), "a")).column("blob").to_pylist():
        doc, s, h, b = _unpress(blob)
        score[doc] += s
        hits[doc] += h
        base[doc] += b
    return pa.table({"id": pa.array(ids, mask=none == 1), "held_out": held == 1, "n_tokens": n, "n_known": hits,
                     "base_score": base, "score": score})


def score_documents(docs: DataFrame, id_col: str = "doc_id", text: str = "text", order: int = ORDER) -> DataFrame:
    """Per row: id, held_out, n_tokens, n_known, train_tokens, base_score, score (by grams of up to ``order`` >= 2 words)."""
    spark = docs.sparkSession
    bound_batches(spark)
    bodies = text_bytes(docs.select(F.col(id_col).cast("long").alias("id"), held_out(id_col).alias("held"), F.col(text).alias("__text")),
                        "id", "held", text="__text")
    found = materialize(count_words(bodies.where("not held"), order), "words", compression="zstd")
    table = found.where("level = 1").select("key", "c")
    ends = table.where(F.col("key") == int(END)).first()
    model = load_counts(table, ends["c"] if ends else 0)
    buckets = 12 + model.tokens // BUCKET_TOKENS
    find_hot(found, model, buckets)
    key, shared = fresh_key(), spark.sparkContext.broadcast(model)     # at most FREQUENT + 1 words and some contexts a bucket

    # both passes read the one shuffle
    dealt = bodies.select("id", "held", "body").rdd.mapPartitions(_deal(key, shared, buckets, order)).partitionBy(buckets, _itself)
    survey = materialize(spark.createDataFrame(dealt.mapPartitions(_survey(key, shared, order, 1 + buckets // 8)),
                                               "kind string, slice long, bucket long, blob binary", verifySchema=False), "survey")
    answers = materialize(survey.where("kind = 'e'").groupBy("slice").applyInArrow(_answer(key, shared), OUT), "answers")
    counts = np.zeros((order - 1, K + 1), dtype=np.int64)
    for row in survey.where("kind = 's'").select("blob").collect():      # one row per bucket
        counts += np.stack(_unpress(row["blob"]))
    sums = np.zeros((len(model.hot), 2 * K + 4))
    for row in answers.where("kind = 'h'").groupBy("k1").agg(F.array(*[F.sum(F.col("sums")[k]) for k in range(2 * K + 4)]).alias("sums")).collect():
        sums[row["k1"]] = row["sums"]
    rules = Rules(model, order, counts, sums)
    replies = answers.where("kind = 'r'").select("k1", "blob").rdd.map(lambda r: (r["k1"], ("r", 0, 0, bytes(r["blob"])))).partitionBy(buckets, _itself)
    both = dealt.union(replies)
    if both.getNumPartitions() != dealt.getNumPartitions():
        raise RuntimeError("tokens and replies must be dealt alike")
    scored = spark.createDataFrame(both.mapPartitions(_score(key, shared, order, rules)), "kind string, flush long, blob binary", verifySchema=False)
    rows = scored.groupBy("flush").applyInArrow(
        _documents, "id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    kind = docs.schema[id_col].dataType
    return rows.select(F.col("id").cast(kind).alias(id_col), "held_out", "n_tokens", "n_known",
                       F.lit(int(model.tokens)).cast("long").alias("train_tokens"), "base_score", "score")
