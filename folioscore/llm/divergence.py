"""Source divergence audit: how far the word use of a source is from each other source of its language.

Pair-task sparse merge. A group (language, source) is a set of sorted (term id, count) arrays, one per block of
term ids; the arrays of two groups meet in one task per unordered pair and block, where a galloping
intersection prices terms that both have, that one has and (in closed form) that neither has. The price is the
same both ways, so a pair is worked once and listed from both ends. All arithmetic is in whole numbers.

Defined cases: null text, language and source are ''. Every row is a document of its own, repeated rows too.
Groups without a kept term are listed with p alike for all terms; a language without kept terms has value 0 in
all pairs. Ties go to the item smaller in UTF-8. Very long texts are read in slices of a bounded number of
bytes. No rows give no rows. Other columns of the input are not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize
from .common import bound_batches

#: Terms are runs of ASCII letters (folded to lower case) and of bytes above 0x7F.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))
SCALE = 1_000_000_000
LEAST_DOCUMENTS = 10
BLOCK_ROWS = 1 << 16
HELD_TERMS = 400_000
SLICE = 1 << 20
RUN = 256


def _runs(body: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a slice of the text at a time."""
    at = 0
    while at < len(body):
        to = at + SLICE
        part = body[at:to].translate(FOLD)
        while to < len(body) and not part.endswith(b" "):     # a term may go on in the next slice
            cut = part.rfind(b" ")
            if cut >= 0:
                to = at + cut + 1
                part = part[:cut + 1]
            else:
                part += body[to:to + SLICE].translate(FOLD)
                to += SLICE
        yield part.split()
        at = to


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, df): occurrences and documents, one row per group and term."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()),
                        ("n", pa.int64()), ("df", pa.int64())])

    def flush(held: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, df) in held.items():
            terms = list(n)
            for at in range(0, len(terms), 50_000):
                part = terms[at:at + 50_000]
                yield pa.record_batch([pa.array([lang] * len(part)), pa.array([source] * len(part)),
                                       pa.array(part, pa.binary()).cast(pa.string()),
                                       pa.array([n[t] for t in part], pa.int64()),
                                       pa.array([df[t] for t in part], pa.int64())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            for lang, source, body in zip(*(batch.column(c) for c in ("lang", "source", "body"))):
                n, df = held.setdefault((lang.as_py(), source.as_py()), (Counter(), Counter()))
                seen: set = set()
                for terms in _runs(body.as_py()):
                    n.update(terms)
                    seen.update(terms)
                df.update(seen)
            if sum(len(n) for n, _ in held.values()) > HELD_TERMS:
                yield from flush(held)
                held = {}
        yield from flush(held)

    bound_batches(docs.sparkSession)
    partial = docs.select(
        F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"),
        F.coalesce("text", F.lit("")).cast("binary").alias("body"),
    ).mapInArrow(run, "lang string, source string, term string, n long, df long")
    # dealt by (lang, term) once: the sums here and the windows over all sources of a term need no other shuffle
    return partial.repartition("lang", "term").groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("df").alias("df"))


def kept_terms(counts: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """(lang, source, term, n, total, first): terms in ``least`` documents of a language; ``first`` marks one row of each."""
    term = Window.partitionBy("lang", "term")
    return counts.select(
        "lang", "source", "term", "n", F.sum("n").over(term).alias("total"), F.sum("df").over(term).alias("in_docs"),
        (F.row_number().over(term.orderBy("source")) == 1).alias("first"),
    ).where(F.col("in_docs") >= least).drop("in_docs")


def price(count: str, size: str, terms: str) -> Column:
    """p of a term with ``count`` occurrences in a group of ``size``, with ``terms`` kept ones."""
    return F.expr(f"1 + cast({SCALE} as decimal(10,0)) * cast({count} + 2 as decimal(20,0)) "
                  f"div cast({size} + 2 * {terms} as decimal(20,0))")


def gap(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def prices(counts: np.ndarray, size: int, terms: int) -> np.ndarray:
    """As ``price``: three digits at a time, so that nothing leaves 64 bits."""
    whole = size + 2 * terms
    rest, out = counts.astype(np.int64) + 2, np.zeros(len(counts), dtype=np.int64)
    out, rest = rest // whole, rest % whole
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + rest // whole, rest % whole
    return out + 1


def gaps(p: np.ndarray, q: np.ndarray) -> int:
    return int(((p - q) * (p - q) // (p + q)).sum())


def gallop(keys: np.ndarray, table: np.ndarray) -> np.ndarray:
    """First places in the sorted ``table`` that are not below each of the sorted ``keys``.

    The search goes on from where the last run of keys ended, in doubling steps: a short array against a long one
    costs the logarithm of the distances, two alike ones one pass.
    """
    out, at = np.empty(len(keys), dtype=np.int64), 0
    for lo in range(0, len(keys), RUN):
        run = keys[lo:lo + RUN]
        step = RUN
        while at + step < len(table) and table[at + step] < run[-1]:
            step *= 2
        out[lo:lo + RUN] = at + np.searchsorted(table[at:at + step + 1], run)
        at = int(out[lo + len(run) - 1])
    return out


def merge(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
    """Sum of prices over the terms of a block that one group of the pair has at least, and their number."""
    info = (left if left.num_rows else right).select(["size_a", "size_b", "terms"]).to_pylist()[0]

    def arrays(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        if not table.num_rows:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        return tuple(table.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                     for c in ("ids", "ns"))

    (ids_a, n_a), (ids_b, n_b) = arrays(left), arrays(right)
    p_a, p_b = (prices(n, info[size], info["terms"]) for n, size in ((n_a, "size_a"), (n_b, "size_b")))
    zero_a, zero_b = (prices(np.zeros(1), info[size], info["terms"])[0] for size in ("size_a", "size_b"))
    small, large = (ids_a, ids_b) if len(ids_a) <= len(ids_b) else (ids_b, ids_a)
    place = gallop(small, large)
    both = place < len(large)
    both[both] = large[place[both]] == small[both]
    in_small, in_large = np.flatnonzero(both), place[both]
    in_a, in_b = (in_small, in_large) if small is ids_a else (in_large, in_small)
    only_a, only_b = np.delete(p_a, in_a), np.delete(p_b, in_b)
    value = gaps(p_a[in_a], p_b[in_b]) + gaps(only_a, zero_b) + gaps(only_b, zero_a)
    lang, a, b, _ = (k.as_py() for k in key)
    return pa.table({"lang": [lang], "a": [a], "b": [b], "value": pa.array([value], pa.int64()),
                     "seen": pa.array([len(ids_a) + len(ids_b) - len(in_a)], pa.int64())})


def term_arrays(kept: DataFrame, sizes: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(lang, source, block, ids, ns): sorted term ids and their counts; blocks have a bounded number of rows."""
    blocks = sizes.select("lang", F.ceil(F.col("rows") / F.lit(block_rows)).alias("blocks"))
    placed = kept.join(blocks, "lang").withColumn("block", F.expr("pmod(xxhash64(term), blocks)"))
    numbered = placed.withColumn("id", F.dense_rank().over(Window.partitionBy("lang", "block").orderBy("term")))
    listed = numbered.groupBy("lang", "block", "source").agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("list"))
    return listed.select("lang", "source", "block", F.col("list.id").alias("ids"), F.col("list.n").alias("ns"))


def pair_values(arrays: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, value) for every two sources a < b of a language."""
    one = groups.select("lang", F.col("source").alias("a"), F.col("size").alias("size_a"), "terms")
    two = groups.select("lang", F.col("source").alias("b"), F.col("size").alias("size_b"))
    pairs = one.join(two, "lang").where("a < b")
    columns = ["lang", "a", "b", "block", "ids", "ns", "size_a", "size_b", "terms"]

    def side(which: str):
        rows = arrays.withColumnRenamed("source", which).join(pairs, ["lang", which])
        return rows.select(*columns).toDF(*columns).groupBy("lang", "a", "b", "block")

    met = side("a").cogroup(side("b")).applyInArrow(merge, "lang string, a string, b string, value long, seen long")
    met = met.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
    priced = pairs.join(met, ["lang", "a", "b"], "left").withColumns({
        "zero_a": price("0", "size_a", "greatest(terms, 1)"), "zero_b": price("0", "size_b", "greatest(terms, 1)"),
        "absent": F.col("terms") - F.coalesce("seen", F.lit(0))})
    return priced.select("lang", "a", "b", (F.coalesce("value", F.lit(0)) + F.col("absent") * gap("zero_a", "zero_b")).alias("value"))


def audit(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = 10, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(lang, source, part, item, value, rank): distances to the other sources, and each source's ``top`` telling terms."""
    counts = term_counts(docs)
    kept = materialize(kept_terms(counts, least), "kept-terms")
    sizes = materialize(kept.groupBy("lang").agg(
        F.count_if("first").alias("terms"), F.sum(F.when(F.col("first"), F.col("total"))).alias("lang_size"),
        F.count(F.lit(1)).alias("rows")), "language-sizes")
    named = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source")).distinct()
    groups = named.join(kept.groupBy("lang", "source").agg(F.sum("n").alias("size")), ["lang", "source"], "left").join(
        sizes.drop("rows"), "lang", "left").fillna(0, ["size", "terms", "lang_size"])
    groups = materialize(groups, "groups")

    arrays = materialize(term_arrays(kept, sizes, block_rows), "term-arrays")
    values = materialize(pair_values(arrays, groups), "pair-values")
    pairs = values.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(
        values.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order))

    priced = kept.join(groups, ["lang", "source"]).withColumns({
        "p": price("n", "size", "terms"), "q": price("total", "lang_size", "terms")})
    terms = priced.where("p > q").select("lang", "source", F.col("term").alias("item"), gap("p", "q").alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(*columns).unionByName(
        terms.withColumn("part", F.lit("term")).select(*columns))


SQL = r"""
with d as (select row_number() over () r, coalesce(lang, '') lang, coalesce(source, '') source,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') t from documents),
w as (select r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) term from d),
c as (select lang, source, term, count(*) n, count(distinct r) df from w group by all),
k as (select lang, term, sum(n)::hugeint total from c group by all having sum(df) >= 10),
s as (select lang, count(*)::hugeint v, sum(total)::hugeint lang_size from k group by all),
kc as (select c.lang, c.source, c.term, c.n::hugeint n, k.total from c join k using (lang, term)),
g as (select x.lang, x.source, coalesce(s.v, 0)::hugeint v, coalesce(s.lang_size, 0)::hugeint lang_size,
             coalesce(y.size, 0)::hugeint size
      from (select distinct lang, source from d) x left join s using (lang)
      left join (select lang, source, sum(n)::hugeint size from kc group by all) y using (lang, source)),
every as (select g.lang, g.source, k.term, coalesce(kc.n, 0)::hugeint n, k.total,
                 1 + (1000000000::hugeint * (coalesce(kc.n, 0)::hugeint + 2)) // (g.size + 2 * g.v) p,
                 1 + (1000000000::hugeint * (k.total + 2)) // (g.lang_size + 2 * g.v) q
          from g join k using (lang) left join kc on kc.lang = g.lang and kc.source = g.source and kc.term = k.term),
pv as (select a.lang, a.source, b.source item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) value
       from every a join every b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
pair as (select a.lang, a.source, b.source item, coalesce(pv.value, 0) value
         from g a join g b on a.lang = b.lang and a.source <> b.source
         left join pv on pv.lang = a.lang and pv.source = a.source and pv.item = b.source),
term as (select lang, source, term item, ((p - q) * (p - q)) // (p + q) value from every where n > 0 and p > q),
ranked as (select *, 'pair' part, row_number() over (partition by lang, source order by value desc, item) rank from pair
           union all by name
           select *, 'term' part, row_number() over (partition by lang, source order by value desc, item) rank from term)
select lang, source, part, item, value::bigint as value, rank::int as rank from ranked where part = 'pair' or rank <= 10
"""
