"""Packing, divergence and codes against brute force and SQL on small tables."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioscore.llm import catalog, codes, divergence, hnsw, packing, topk

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [None, "", " \t\n", "x", "Ünïcode ▁ text\x00 and   spaces \n", "😀" * 50, "don't  stop <|endoftext|> now", "a" * 5000]


@pytest.fixture(scope="module")
def sane(spark):
    from folioscore.session import ship_package
    ship_package(spark)
    return spark


def prose(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


# ---------------------------------------------------------------- 11 packing

@pytest.fixture(scope="module")
def ranks():
    return packing.load_ranks(f"{catalog.TOKENIZERS}/byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    made = Tokenizer.from_file(f"{catalog.TOKENIZERS}/byte_bpe_50k.json")
    made.encode_special_tokens = True
    return made


def check_packing(rows, texts, tokenizer, most):
    """Every id stands once, pieces are cut as said, sequences are gapless and not too long."""
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for i, t in texts.items()}
    mine = collections.defaultdict(list)
    for r in rows:
        mine[r["doc_id"]].append(r)
    assert set(mine) == set(ids)
    for i, found in mine.items():
        found.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in found] == list(range(len(found)))
        at = 0
        for r in found:
            part = ids[i][at:at + r["length"]]
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(np.array(part, dtype="<u4").tobytes())
            at += r["length"]
        assert at == len(ids[i]) and all(r["length"] == most for r in found[1:]) and found[0]["length"] <= most
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= most
    return len(sequences)


def test_packing_places_every_id_once(sane, ranks, tokenizer):
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    texts = dict(enumerate([*ODD, *(prose(rng, words, rng.randint(1, 200)) for _ in range(400)), prose(rng, words, 9000)]))
    docs = sane.createDataFrame([(i, t, "task", 1) for i, t in texts.items()], "doc_id long, text string, task string, shard int")
    for most, shard in ((64, 1 << 16), (64, 100), (1024, 50)):
        rows = packing.pack(docs, ranks, catalog.BYTE_PATTERN, most=most, shard_pieces=shard).collect()
        sequences = check_packing(rows, texts, tokenizer, most)
        total = sum(r["length"] for r in rows)
        assert sequences >= -(-total // most)
        if shard == 1 << 16:
            assert sequences <= 1.02 * total / most


def test_packing_of_copies_null_ids_and_nothing(sane, ranks):
    docs = sane.createDataFrame([(7, "one two three")] * 50 + [(None, None)] * 3, "doc_id long, text string")
    rows = packing.pack(docs, ranks, catalog.BYTE_PATTERN, most=8).collect()
    assert len(rows) == 53 and len({(r["sequence_id"], r["offset"]) for r in rows}) == 53
    assert len({r["sequence_id"] for r in rows}) == 26
    assert packing.pack(docs.limit(0), ranks, catalog.BYTE_PATTERN).count() == 0


def test_long_texts_are_encoded_in_stretches(ranks, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "STRETCH", 50)
    encode = packing.encoder(ranks, catalog.BYTE_PATTERN)
    rng = random.Random(5)
    for text in (*ODD, "".join(rng.choice("ab é.\n '  1　\x1c") for _ in range(4000)), "word " * 900):
        assert np.frombuffer(encode(text or ""), dtype="<u4").tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids


def test_sum_of_squares_takes_the_smallest_change():
    rng = np.random.default_rng(3)
    lengths = np.sort(rng.integers(1, 20, 300))[::-1]
    got = packing.sum_of_squares(lengths, 20)
    gaps: list[int] = []                      # by brute force: every open bin is tried
    for s, chosen in zip(lengths.tolist(), got.tolist()):
        def squares(g):
            return sum(n * n for gap, n in collections.Counter(g).items() if 0 < gap < 20)
        options = {len(gaps): squares([*gaps, 20 - s])}
        for b, gap in enumerate(gaps):
            if gap >= s:
                options[b] = squares([*gaps[:b], gap - s, *gaps[b + 1:]])
        assert options[chosen] == min(options.values())
        if chosen == len(gaps):
            gaps.append(20)
        gaps[chosen] -= s


# ---------------------------------------------------------------- 12 divergence

def brute_divergence(rows, least, top):
    rows = [((t or ""), (l or ""), (s or "")) for t, l, s in rows]
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    seen, count = collections.Counter(), collections.Counter()
    for text, lang, source in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.translate(table))
        seen.update((lang, t) for t in set(terms))
        for t in terms:
            count[lang, source, t] += 1
    out = set()
    for lang in {l for _, l, _ in rows}:
        kept = [t for (l, t), n in seen.items() if l == lang and n >= least]
        sources = sorted({s for _, l, s in rows if l == lang})
        size = {s: sum(count[lang, s, t] for t in kept) for s in sources}

        def p(n, whole):
            return 1 + 1_000_000_000 * (n + 2) // (whole + 2 * len(kept))

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        for s in sources:
            pair = [(sum(f(p(count[lang, s, t], size[s]), p(count[lang, o, t], size[o])) for t in kept), o) for o in sources if o != s]
            whole = {t: p(sum(count[lang, o, t] for o in sources), sum(size.values())) for t in kept}
            terms = [(f(p(count[lang, s, t], size[s]), whole[t]), t) for t in kept
                     if count[lang, s, t] and p(count[lang, s, t], size[s]) > whole[t]]
            for part, items, most in (("pair", pair, len(pair)), ("term", terms, top)):
                ranked = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:most]
                out |= {(lang, s, part, i, v, k) for k, (v, i) in enumerate(ranked, 1)}
    return out


def divergence_rows(seed):
    rng = random.Random(seed)
    words = [*("".join(rng.choice("aBcDé") for _ in range(rng.randint(1, 5))) for _ in range(120)), "日本", "😀"]
    rows = [(prose(rng, words, rng.randint(0, 60)), rng.choice(["en", "fr", None, ""]), rng.choice(["a", "B", None, "é", "z"]))
            for _ in range(250)]
    rows += [("Hot hot HOT", "en", "a")] * 90 + [(None, "xx", "p"), ("", "xx", "q"), ("only three here", "yy", "p"), ("1 2 3", "yy", "q")]
    return rows + [("word " * 400_000 + "日" * 1_200_000, "en", "B")]      # longer than a slice


def test_divergence_is_brute_force(sane, monkeypatch):
    rows = divergence_rows(12)
    docs = sane.createDataFrame([(*r, 1, "x") for r in rows], "text string, lang string, source string, n long, term string").repartition(5)
    want = brute_divergence(rows, 10, 10)
    for block in (1 << 16, 40):
        got = divergence.audit(docs, block_rows=block)
        assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
        assert {tuple(r) for r in got.collect()} == want
    assert divergence.audit(docs.limit(0)).count() == 0


def test_gallop_and_prices():
    rng = np.random.default_rng(4)
    for n, m in ((0, 5), (5, 0), (3, 5000), (4000, 4100), (700, 90)):
        keys, table = (np.unique(rng.integers(0, 10_000, k)) for k in (n, m))
        assert (divergence.gallop(keys, table) == np.searchsorted(table, keys)).all()
    for size, terms in ((0, 1), (10, 3), (10 ** 15, 10 ** 9)):
        n = np.unique(rng.integers(0, size + 1, 50))
        assert divergence.prices(n, size, terms).tolist() == [1 + 10 ** 9 * (int(x) + 2) // (size + 2 * terms) for x in n]


# ---------------------------------------------------------------- 13 codes

def brute_codes(rows, parts, entries, rounds, scale):
    """(id, label, code, error) by looking at every entry, and the digest."""
    import math
    kept = [(i, [math.floor(scale * x) for x in v], l) for i, v, l in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    length = len(kept[0][1])
    kept = [(i, v + [0] * (-length % parts), l) for i, v, l in kept if len(v) == length]
    width = len(kept[0][1]) // parts
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def nearest(book, x):
        return min((sum((a - b) ** 2 for a, b in zip(e, x)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = collections.defaultdict(list)
            for c in cut:
                members[nearest(books[p], c[p])[1]].append(c[p])
            for k, m in members.items():
                books[p][k] = [sum(col) // len(m) for col in zip(*m)]
    out, by_label = [], collections.Counter()
    for (i, _, l), c in zip(kept, cut):
        found = [nearest(books[p], c[p]) for p in range(parts)]
        out.append((i, l, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
        by_label[l] += out[-1][3]
    text = ",".join(str(x) for b in books for e in b for x in e)
    return sorted(((i, c, e, by_label[l]) for i, l, c, e in out), key=str), hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("dim,big", [(8, 1.0), (6, 1.0), (8, 1e6)])
def test_codes_are_brute_force(sane, dim, big):
    rng = np.random.default_rng(13)
    base = (rng.integers(-3, 4, (300, dim)) / 2 * big).tolist()             # coarse: many ties
    rows = [(i // 2 if i < 20 else i, v, int(i % 3) if i % 7 else None) for i, v in enumerate(base)]
    rows += [(400, None, 1), (401, [], 1), (402, [float("nan")] * dim, 1), (403, [None] * dim, 1), (404, [float("inf")] * dim, 2),
             (405, [1.0] * (dim + 1), 1), (None, base[0], 2)] + [(500 + i, base[5], 0) for i in range(150)]
    df = sane.createDataFrame([(*r, "x", 1) for r in rows],
                              "vec_id long, embedding array<double>, label int, code string, id long").repartition(7)
    want, sha = brute_codes(rows, 4, 16, 2, 256)
    got = codes.compress(df, parts=4, entries=16).collect()
    assert sorted(((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in got), key=str) == want
    assert {r["codebooks_sha256"] for r in got} == {sha}


def test_codes_of_few_and_no_rows(sane):
    df = sane.createDataFrame([(3, [0.5, 1.0], "a"), (1, [1e300, -1e300], None)], "vec_id long, embedding array<double>, label string")
    got = {r["vec_id"]: (r["code"], r["error"]) for r in codes.compress(df, parts=2).collect()}
    assert got == {1: ("0000", 0), 3: ("0101", 0)}
    assert codes.compress(df.limit(0)).count() == 0


def test_search_ends_only_beyond_the_best():
    rng = np.random.default_rng(2)
    for _ in range(20):
        entries, parts = rng.integers(-4, 5, (40, 4)), rng.integers(-5, 6, (200, 4))
        index, best = codes.Codebook(entries).search(parts)
        full = ((parts[:, None] - entries[None]) ** 2).sum(axis=2)
        assert (best == full.min(axis=1)).all() and (index == full.argmin(axis=1)).all()


# ---------------------------------------------------------------- 2 and 10: repeated ids, ties, clashing columns

def brute_search(rows, step, k, score):
    """(query id, its vector's results) for every different (id, vector) of a query; a row leaves out itself alone."""
    out = collections.Counter()
    for i, v in {(i, tuple(v)) for i, v in rows if i % step == 0}:
        others = list(rows)
        others.remove((i, list(v)))
        ranked = sorted((score(v, w), j) for j, w in others if len(w) == len(v))[:k]
        out[i, tuple((r + 1, j, s) for r, (s, j) in enumerate(ranked))] += 1
    return out


def results(df):
    groups = collections.defaultdict(list)
    for r in df.collect():
        groups[r["query_id"], r["query_key"]].append((r["rank"], r["vec_id"], r["score"]))
    return collections.Counter((i, tuple(sorted(v))) for (i, _), v in groups.items())


def repeated_rows(seed):
    rng = np.random.default_rng(seed)
    rows = [(i, v) for i, v in enumerate(rng.integers(-2, 3, (120, 4)).astype(float).tolist()) if any(v)]
    rows += [(20, [3.0, 0.0, 1.0, 0.0]), (7, [-1.0, 2.0, 2.0, 2.0]), (7, [9.0, 9.0, 9.0, 9.0]), (40, [1.0, 1.0, 1.0, 1.0])]
    return rows + [(40, [1.0, 1.0, 1.0, 1.0])] * 2 + [(60 + i % 2, [2.0, 2.0, 2.0, 2.0]) for i in range(30)]


def search_table(spark, rows):
    return spark.createDataFrame([(i, v, 5, "x", 1) for i, v in rows],
                                 "vec_id long, embedding array<double>, id long, rep string, query long").repartition(4)


def test_products_of_repeated_ids(sane):
    rows = repeated_rows(21)
    want = brute_search(rows, 20, 9, lambda a, b: -sum(int(64 * x // 1) * int(64 * y // 1) for x, y in zip(a, b)))
    want = collections.Counter({(i, tuple((r, j, -s) for r, j, s in v)): n for (i, v), n in want.items()})
    assert results(topk.top_products(search_table(sane, rows), F.col("vec_id") % 20 == 0, k=9)) == want


def test_neighbours_of_repeated_ids(sane):
    rows = repeated_rows(22)
    want = brute_search(rows, 20, 9, lambda a, b: float(np.sqrt(((np.array(a) - np.array(b)) ** 2).sum())))
    assert results(hnsw.nearest(search_table(sane, rows), F.col("vec_id") % 20 == 0, k=9)) == want


@pytest.mark.parametrize("clusters", [0, 40])
def test_recall_of_a_production_shard(clusters):
    rng = np.random.default_rng(10)
    x = rng.normal(size=(hnsw.SHARD_ROWS, 64))
    if clusters:
        x = 0.1 * x + rng.normal(size=(clusters, 64))[rng.integers(0, clusters, len(x))]
    asked = x[::20] + 0.01 * rng.normal(size=x[::20].shape)
    found = hnsw.Graph.build(x, np.arange(len(x))).search(asked, hnsw.SEARCH_WIDTH)[:, :10]
    distance = (x * x).sum(axis=1) - 2 * asked @ x.T
    true = np.argsort(distance, axis=1)[:, :10]
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(found.tolist(), true.tolist())]) >= 0.97


# ---------------------------------------------------------------- pipeline: columns of any name and type

def test_stages_take_any_columns(sane, tmp_path):
    import corpus_pipeline
    given = sane.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60)
    extra = ("5 as epoch", "6L as n_bytes", "'k' as kept_text", "7 as __row", "map(doc_id, text) as tags", "8 as row", "9 as `key`",
             "1 as id", "2 as src", "array(1) as pieces", "3 as hash", "4 as carried", "'s' as first", "named_struct('a', 1) as rest")
    at = given.unionAll(given.limit(5)).selectExpr("*", *extra)
    columns = at.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(sane, at, "")
        out.write.parquet(str(tmp_path / name))
        at = sane.read.parquet(str(tmp_path / name))
        if name != "pieces":
            assert at.columns == columns
            assert at.where("epoch = 5 and n_bytes = 6 and kept_text = 'k' and __row = 7 and size(tags) = 1 and rest.a = 1").count() == at.count() > 20


def test_stages_of_an_empty_table(sane):
    import corpus_pipeline
    empty = sane.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(sane, empty, "").count() == 0


def test_operators_take_clashing_columns(sane):
    from folioscore.llm import token_files, pieces, toxicity
    docs = sane.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate([*ODD, *ODD])], DOCS).selectExpr(
        "*", "1 as id", "2 as body", "3 as label", "4 as n_tokens", "5 as score", "6 as file", "7 as block", "8 as ids", "9 as toxic",
        "1 as term", "2 as word", "3 as predicted", "4 as offset", "5 as rank", "6 as task", "7 as shard")
    labels = sane.createDataFrame([(i, 1, i % 2, "x") for i in range(len(ODD))], "doc_id long, quality int, toxic int, text string")
    ranks = packing.load_ranks(f"{catalog.TOKENIZERS}/byte_bpe_50k.json")
    assert token_files.count_tokens(docs, ranks, catalog.BYTE_PATTERN).count() == 2 * len(ODD)
    assert toxicity.score_toxicity(docs, labels).count() == 2 * len(ODD)
    assert pieces.encode(docs, pieces.load_vocabulary(f"{catalog.TOKENIZERS}/piece_bpe_32k.model")).count() == 2 * len(ODD)
    assert divergence.audit(docs).count() == 0
    assert packing.pack(docs, ranks, catalog.BYTE_PATTERN).count() >= 2 * len(ODD)


def test_shards_drawn_in_bundles_meet_all_totals():
    from folioscore.llm import mixing
    owed = np.array([5000, 0, 37, 900], dtype=np.int64)
    single = list(mixing.draw(owed, 100, [3]))
    assert (sum(n for _, _, n in single) == owed).all() and all(n.sum() == 100 for _, _, n in single[:-1])
    inside, bundles = mixing.draw_bundles(owed, 10, 3, 7)
    assert len(bundles) <= 7 and inside == 85
    seen = np.zeros_like(owed)
    for i, first, n in bundles:
        assert (np.array(first) == seen).all()
        inner = list(mixing.draw(np.array(n), 10, [3, i]))
        assert len(inner) <= inside and (sum(c for _, _, c in inner) == np.array(n)).all()
        seen += n
    assert (seen == owed).all()


def test_mix_in_bundles(sane, monkeypatch):
    from folioscore.llm import mixing
    monkeypatch.setattr(mixing, "BUNDLES", 3)
    rng = random.Random(8)
    docs = sane.createDataFrame([(i, prose(rng, ["a", "bb", "ccc"], rng.randint(0, 80)), "en", rng.choice("xyz"), 1) for i in range(300)], DOCS)
    rows = mixing.mixed_sizes(docs, block_words=4, shard_blocks=16).collect()
    for source in "xyz":
        mine = [r for r in rows if r["target"] == max(t["target"] for t in rows if t["source_size"] == r["source_size"])]
        assert all(0 <= r["taken"] <= 2 * r["size"] for r in mine)
    by_target = collections.defaultdict(int)
    for r in rows:
        by_target[r["source_size"], r["target"]] += r["taken"]
    assert all(abs(taken - target) <= 4 for (_, target), taken in by_target.items())
