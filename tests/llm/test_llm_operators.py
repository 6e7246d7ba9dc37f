"""The training-data operators against brute force on small tables: odd rows, ties, repeats, whole texts."""

import collections
import hashlib
import math
import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioscore.llm import (catalog, graph, hnsw, katz, language, mixing, pieces, setsketch, suffixes, token_files, topk, toxicity)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def sane(spark):
    from folioscore.session import ship_package
    ship_package(spark)
    return spark


def make(spark, texts, ids=None, lang="en", source="s"):
    rows = [(i if ids is None else ids[i], t, lang, source, len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def prose(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


ODD = [None, "", " \t\n", "x", "Ünïcode ▁ text\x00 and   spaces \n", "😀" * 50]


# ---------------------------------------------------------------- 1 token files

def test_scan_and_stitch_blocks(sane):
    rng = np.random.default_rng(1)
    for sizes in ([], [0], [5, 0, 0, 17, 3], rng.integers(0, 40, 60).tolist()):
        for block in (1, 4, 7, 64):
            tokens = [t for n in sizes for t in [*rng.integers(0, 50, n).tolist(), 99]] + [1, 2, 3]
            flat = np.array(tokens, dtype="<u2")
            rows = [("f", i // block, flat[i:i + block].tobytes()) for i in range(0, len(flat), block)]
            random.Random(2).shuffle(rows)
            got = token_files.stitch(token_files.scan_blocks(sane.createDataFrame(rows, "file string, block long, payload binary"), end=99))
            want = [(k, n, True) for k, n in enumerate(sizes)] + [(len(sizes), 3, False)]
            assert sorted((r["ordinal"], r["n_tokens"], r["closed"]) for r in got.collect()) == want
            if block == 64 or len(sizes) < 3:
                break


def test_raw_token_files(sane, tmp_path):
    np.array([1, 2, 9, 9, 3, 9], dtype="<u2").tofile(tmp_path / "a.bin")
    np.array([], dtype="<u2").tofile(tmp_path / "b.bin")
    blocks = token_files.read_token_files(sane, str(tmp_path), block_tokens=4)
    got = token_files.stitch(token_files.scan_blocks(blocks, end=9)).orderBy("ordinal").collect()
    assert [r["n_tokens"] for r in got] == [2, 0, 1]


def test_token_counts_match_the_tokenizer(sane):
    import tiktoken
    ranks = token_files.load_ranks(f"{catalog.TOKENIZERS}/byte_bpe_50k.tiktoken")
    own = tiktoken.Encoding("t", pat_str=catalog.BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [*ODD, "some words <|endoftext|> " * 300]
    got = by_id(token_files.count_tokens(make(sane, texts), ranks, catalog.BYTE_PATTERN, block_tokens=64))
    assert {i: r["n_tokens"] for i, r in got.items()} == {i: len(own.encode_ordinary(t or "")) for i, t in enumerate(texts)}


# ---------------------------------------------------------------- 2 and 10 searches

def vectors(spark, seed, n, d=6, copies=30):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)).round(2)
    x[:copies] = x[0]       # a hot vector
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    odd = [(n, None), (n + 1, []), (n + 2, [1.0, None] + [0.0] * (d - 2)), (n + 3, [float("nan")] * d), (n + 4, [float("inf")] * d),
           (n + 5, [1.0, 2.0]), (None, [0.0] * d)]
    return spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>"), x


@pytest.mark.parametrize("n,k", [(300, 7), (40, 60)])
def test_top_products_are_exact(sane, monkeypatch, n, k):
    monkeypatch.setattr(topk, "ROW_BLOCK", 64)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 8)
    df, x = vectors(sane, 3, n)
    got = topk.top_products(df, F.col("vec_id") % 5 == 0, k=k).orderBy("query_id", "rank").collect()
    z = np.floor(64 * x).astype(int)
    want = []
    for q in range(0, n, 5):
        order = sorted((-int(z[q] @ z[i]), i) for i in range(n) if i != q)[:k]
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(order)]
    got = [tuple(r)[:4] for r in got if r["query_id"] < n]
    assert got == want


def test_nearest_neighbours(sane):
    df, x = vectors(sane, 4, 900)
    got = hnsw.nearest(df, F.col("vec_id") % 10 == 0, k=10, shard_rows=200).collect()
    mine = collections.defaultdict(dict)
    for r in got:
        mine[r["query_id"]][r["vec_id"]] = r["score"]
    hits = total = 0
    for q in range(0, 900, 10):
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        d[q] = np.inf
        order = np.lexsort((np.arange(900), d))[:10]
        hits += len(set(order.tolist()) & set(mine[q]))
        total += 10
        assert all(abs(s - d[i]) < 1e-12 for i, s in mine[q].items())
    assert hits / total >= 0.95
    assert hnsw.nearest(df.where("vec_id < 0"), F.col("vec_id") % 10 == 0).count() == 0
    assert topk.top_products(df.where("vec_id < 0"), F.col("vec_id") % 10 == 0).count() == 0


def test_graph_survives_its_flat_form():
    x = np.random.default_rng(5).normal(size=(400, 8))
    g = hnsw.Graph.build(x, np.arange(400))
    h = hnsw.Graph.from_flat(x, g.flat())
    assert (g.search(x[:20], 32) == h.search(x[:20], 32)).all()
    assert (g.search(x[:20], 32)[:, 0] == np.arange(20)).all()


# ---------------------------------------------------------------- 3 toxicity

def test_automaton_accepts_exactly_one_edit():
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, old = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(row[-1] + 1, old[j] + 1, old[j - 1] + (x != y)))
        return row[-1]

    terms = ["stupid", "idiot", "foo"]
    lexicon = toxicity.Lexicon(terms, ["vequ"])
    rng = random.Random(6)
    for _ in range(3000):
        word = list(rng.choice(terms))
        for _ in range(rng.randint(0, 2)):
            at = rng.randint(0, len(word))
            edit = rng.randint(0, 2)
            word[at:at + (edit > 0)] = [rng.choice("stupidof")] if edit < 2 else []
        word = "".join(word)
        if not word or word.startswith("vequ"):
            continue
        want = 1 if word in terms else 2 if any(len(t) >= 5 and distance(word, t) == 1 for t in terms) else 0
        assert lexicon.match(word) == want, word
    assert lexicon.match("vequxyz") == 1


def test_quotation_needs_marks_around_the_word():
    memo = toxicity._Memo(toxicity.Lexicon(["stupid"], []))
    quoted = ['he said "stupid" twice', "a “truly stupid man” said", "« stupid »", "„so stupid“, sagt er", "»stupid«", "(‘stupid’)",
              'one "a" two "b stupid c" d', 'so " you stupid man " it goes', "the word stupid is rude", "“don’t be stupid, you”"]
    plain = ["you’re a stupid man", "l’homme est stupid", "my word you are a stupid man", "she said you are stupid", "the dogs’ stupid tails",
             'a "b" stupid "c" d', 'key = "0b96" stupid man', "stupid “quoted” man", "‘tis a stupid", '"open but stupid', "’tis stupid ’",
             "“" + "far " * 20 + "stupid " + "far " * 20 + "”"]
    for text in quoted:
        assert toxicity.hits(memo, text)[:3] == (0, 0, 1), text
    for text in plain:
        assert toxicity.hits(memo, text)[:3] == (1, 0, 0), text


def test_toxicity_end_to_end(sane):
    rng = random.Random(7)
    calm, rude = ["table", "river", "green", "walk", "paper", "music"], ["stupid", "pathetic", "moronic"]
    texts, labels = [], []
    for i in range(300):
        bad = i % 4 == 0
        words = [rng.choice(calm) for _ in range(40)]
        for _ in range(5 * bad):
            words[rng.randrange(40)] = rng.choice(rude)
        texts.append(" ".join(words))
        labels.append((i, int(bad)))
    texts += ["you are a stupiid and pathetlc moronic, stupid thing", *ODD, "you’re a stupid, pathetic thing", "river " * 100_000 + "stupid moronic"]
    docs = make(sane, texts)
    got = by_id(toxicity.score_toxicity(docs, sane.createDataFrame(labels, "doc_id long, toxic int")))
    assert len(got) == len(texts)
    held = [i for i in range(300) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i]["held_out"] for i in held) and all(got[i]["predicted"] == labels[i][1] for i in held)
    assert got[300]["predicted"] == 1 and got[300]["misspelled"] == 2
    assert all(0 <= r["score"] <= 1 for r in got.values()) and got[301]["predicted"] == 0
    assert got[len(texts) - 2]["predicted"] == 1 and got[len(texts) - 2]["quoted"] == 0
    assert got[len(texts) - 1]["plain"] == 2        # at the end of a very long text
    assert toxicity.hits(toxicity._Memo(toxicity.Lexicon(["stupid"], [])), 'he said "stupid" twice')[2] == 1
    none = toxicity.score_toxicity(docs, sane.createDataFrame([], "doc_id long, toxic int"))
    assert none.where("score <> 0").count() == 0


# ---------------------------------------------------------------- 4 near duplicates and components

def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(zip(*(w[k:] for k in range(5)), strict=False)) if len(w) > 4 else frozenset([tuple(w)] if w else [])


def groups_of(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n
    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(sane):
    rng = random.Random(8)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 340)] + [(None, 1), (5, 5)]
    got = {r["node"]: r["component"] for r in graph.components(sane.createDataFrame(links, "a long, b long")).collect()}
    real = [(a, b) for a, b in links if a is not None]
    want = groups_of({n for ab in real for n in ab}, real)
    assert all(got.get(n, n) == c for n, c in want.items())


def test_near_duplicates_match_brute_force(sane):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(400)]
    texts = list(ODD)
    for _ in range(25):
        base = prose(rng, words, rng.randint(3, 120)).split()
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 6)):      # edits around the threshold
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 20))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy) if rng.random() < 0.8 else "  ".join(copy).upper())
    ids = [3 * i + 2 for i in range(len(texts))]
    docs = make(sane, texts, ids)
    docs = docs.union(docs.where("doc_id = 20")).union(sane.createDataFrame([(None, texts[7], "en", "s", 1)], DOCS))
    got = setsketch.near_duplicates(docs).collect()
    sets = {i: shingles(t) for i, t in zip(ids, texts, strict=True)}
    links = [(a, b) for a in ids for b in ids if a > b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want = groups_of(ids, links)
    assert len(got) == len(texts) + 2
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"], r["kept"]) == (
                len(sets[r["doc_id"]]), want[r["doc_id"]], want[r["doc_id"]] == r["doc_id"])
    assert setsketch.near_duplicates(docs.where("doc_id < 0")).count() == 0


def test_sketches_merge_and_estimate():
    h = setsketch.mix64(np.arange(3000, dtype=np.uint64))
    a, b = h[:2000], h[1000:]
    both = setsketch.registers(h, np.array([3000]))[0]
    one, two = (setsketch.registers(x, np.array([2000]))[0] for x in (a, b))
    assert (np.maximum(one, two) == both).all()
    j = setsketch.likely(np.array([(one > two).sum()]), np.array([(one < two).sum()]), np.array([2000.0]), np.array([2000.0]))
    assert abs(j[0] - 1 / 3) < 0.15


def test_rare_terms_enter_the_lexicon(sane):
    rng = random.Random(25)
    calm = [f"word{i}" for i in range(300)]
    learned = []
    for i in range(4000):       # 150 slurs, each in about 1.3 % of the toxic texts
        learned.append((i % 2, " ".join([*(rng.choice(calm) for _ in range(20)), *([f"slur{i // 2 % 75}a", f"s{i // 2 % 75}lurb"] * (i % 2))])))
    lexicon, own = toxicity.learn_lexicon(sane.createDataFrame(learned, "toxic int, text string"))
    assert all(lexicon.match(w) == 1 for k in range(75) for w in (f"slur{k}a", f"s{k}lurb"))
    assert all(lexicon.match(w) == 0 for w in calm)
    one_kind, own = toxicity.learn_lexicon(sane.createDataFrame([(1, "a b c")] * 30, "toxic int, text string"))
    assert one_kind.match("a") == 0 and own.count() == 0


def test_one_clean_text_does_not_switch_a_misspelling_off(sane):
    rng = random.Random(24)
    calm = ["table", "river", "green", "walk", "paper", "music"]
    learned = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5]
    rare = [i for i in learned if i % 2][:10]           # toxic texts with the misspelling; one clean text has it too
    noisy = next(i for i in learned if i % 2 == 0)
    texts = []
    for i in range(400):
        words = [rng.choice(calm) for _ in range(20)] + ["pathetic"] * (i % 2) + ["pathetix"] * (i % 4 < 2)
        texts.append(" ".join(words + ["pathetlc"] * (i in rare or i == noisy)))
    got = by_id(toxicity.score_toxicity(make(sane, texts), sane.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic int")))
    assert all(got[i]["misspelled"] == (i in rare or i == noisy) for i in got)     # "pathetix" is as common in clean texts
    assert all((got[i]["plain"], got[i]["kinds"]) == (1, 2) for i in rare)


# ---------------------------------------------------------------- 5 language model

class PlainKatz:
    """The same model by recursion over dictionaries."""

    def __init__(self, learned, order):
        self.order = order
        self.grams = [collections.Counter() for _ in range(order + 1)]
        self.context = [collections.Counter() for _ in range(order + 1)]
        self.after = collections.defaultdict(set)
        for words in learned:
            full = ["<s>"] * (order - 1) + words
            for at in range(order - 1, len(full)):
                for n in range(1, order + 1):
                    before = tuple(full[at - n + 1:at])
                    self.grams[n][(*before, full[at])] += 1
                    self.context[n][before] += 1
                    self.after[before].add(full[at])
        self.total, self.kinds = sum(self.grams[1].values()), len(self.grams[1])
        self.d = [None] + [[0, *katz.discounts(collections.Counter(c.values()))] for c in self.grams[1:]]
        self.unknown = 1 - sum(self.kept(c, 1) for c in self.grams[1].values()) / self.total
        self.weights = {}

    def kept(self, r, n):
        return r * self.d[n][r] if r <= katz.K else r - katz.RESERVE

    def weight(self, before):
        if before not in self.weights:
            n = len(before) + 1
            left = 1 - sum(self.kept(self.grams[n][(*before, y)], n) for y in self.after[before]) / self.context[n][before]
            self.weights[before] = left / (1 - sum(self.p(before[1:], y) for y in self.after[before]))
        return self.weights[before]

    def p(self, before, word):
        n = len(before) + 1
        if (*before, word) in self.grams[n]:
            return self.kept(self.grams[n][(*before, word)], n) / self.context[n][before]
        if n == 1:
            return self.unknown
        return (self.weight(before) if before in self.context[n] else 1.0) * self.p(before[1:], word)

    def score(self, words):
        full = ["<s>"] * (self.order - 1) + words
        return sum(math.log10(self.p(tuple(full[at - self.order + 1:at]), full[at])) for at in range(self.order - 1, len(full)))


@pytest.mark.parametrize("order", [2, 3, 4])
def test_katz_matches_a_plain_model(sane, monkeypatch, order):
    monkeypatch.setattr(katz, "FREQUENT", 12)       # most words take the way of rare ones
    rng = random.Random(10)
    words = [f"v{int(rng.paretovariate(0.7))}" for _ in range(4000)]
    texts = [prose(rng, words, rng.randint(0, 60)) for _ in range(150)] + ["Unseen Words here", *ODD]
    texts += [texts[3]] * 4 + [prose(rng, words, 5000)]      # copies, and a very long text
    docs = make(sane, texts)
    got = by_id(katz.score_documents(docs, order=order))
    tokens = {i: (t or "").encode().lower().split() + [None] for i, t in enumerate(texts)}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in tokens}
    plain = PlainKatz([w for i, w in tokens.items() if not held[i]], order)
    known = [x for (x,) in plain.grams[1]]
    for before in [("<s>",) * (order - 1), *random.Random(3).sample(sorted(plain.context[order], key=repr), 5)]:     # exactly normalised
        assert abs(sum(plain.p(before, x) for x in known) + plain.p(before, "never") - 1) < 1e-9
    for i, w in tokens.items():
        r = got[i]
        base = sum(math.log10((plain.grams[1][(x,)] + 0.1) / (plain.total + 0.1 * (plain.kinds + 1))) for x in w)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(w), sum(x in known for x in w), plain.total)
        assert abs(r["base_score"] - base) < 1e-6 and abs(r["score"] - plain.score(w)) < 1e-6 * max(1, len(w) / 100), i


def test_katz_splits_hot_contexts_and_writes_no_table_of_grams(sane, monkeypatch):
    from folioscore.session import scratch_root
    monkeypatch.setattr(katz, "BUCKET_TOKENS", 400)     # many buckets, so that "a" and "a b" are hot
    monkeypatch.setattr(katz, "FREQUENT", 5)
    rng = random.Random(12)
    texts = [" ".join(rng.choice(["a b", "a b", "c", f"w{rng.randint(0, 300)}"]) for _ in range(rng.randint(1, 80))) for _ in range(120)]
    before = set(os.listdir(scratch_root(sane)))
    got = by_id(katz.score_documents(make(sane, texts)))
    assert {x.split("-")[0] for x in set(os.listdir(scratch_root(sane))) - before} == {"words", "survey", "answers"}
    tokens = [t.encode().split() + [None] for t in texts]
    plain = PlainKatz([w for i, w in enumerate(tokens) if zlib.crc32(str(i).encode()) % 10], 3)
    assert all(abs(got[i]["score"] - plain.score(w)) < 1e-6 for i, w in enumerate(tokens))


def test_katz_without_training_rows(sane):
    docs = make(sane, ["some words here", "", None, "x"])
    assert katz.score_documents(docs.where("doc_id < 0")).count() == 0
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:4]
    rows = katz.score_documents(make(sane, ["some words here", "", None, "x"], ids=held)).collect()
    assert len(rows) == 4 and all((r["train_tokens"], r["score"], r["base_score"]) == (0, 0.0, 0.0) for r in rows)


# ---------------------------------------------------------------- 6 language

def test_language_on_held_out_texts(sane):
    rng = random.Random(11)
    parts = {"aa": ["tha", "ing", "ion", "er", "wh"], "bb": ["éau", "ment", "oi", "le", "ç"], "cc": ["ción", "ñ", "dor", "as", "que"]}
    rows = []
    for i in range(240):
        lang = ["aa", "bb", "cc"][i % 3]
        text = " ".join("".join(rng.choice(parts[lang]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(5, 80)))
        rows.append((i, text, lang if i % 7 else None, "s", 1))
    docs = sane.createDataFrame(rows + [(1000 + i, t, "aa", "s", 1) for i, t in enumerate([None, "", "123 $$"])], DOCS)
    got = by_id(language.identify(docs))
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    right = sum(got[r[0]]["lang_pred"] == ["aa", "bb", "cc"][r[0] % 3] for r in held)
    assert right / len(held) > 0.97 and all(got[r[0]]["held_out"] for r in held)
    assert all(got[1000 + i]["lang_pred"] == "und" and got[1000 + i]["score"] == 0 for i in range(3))
    assert all(0 <= r["score"] <= 1 for r in got.values())
    kept = language.keep_identified(docs, language.fit(language.learning_rows(docs, "doc_id")))
    assert kept.count() == 240 and kept.columns == docs.columns and kept.where("lang is null").count() == 0
    assert language.identify(docs.where("doc_id < 0")).count() == 0


def test_language_table_in_blocks_gives_the_same_kernel(monkeypatch):
    rng = np.random.default_rng(21)
    landmarks = [language.present("".join(rng.choice(list("abcdé "), 200))) for _ in range(11)]
    buckets = np.flatnonzero(np.any(landmarks, axis=0)).astype(np.int32)
    dense = np.stack([x[buckets] for x in landmarks], axis=1)
    norms = np.sqrt(dense.sum(axis=0).astype(float))
    model = language.Model(["aa"], buckets, np.packbits(dense, axis=1), norms, np.ones((11, 1)), np.zeros(1))
    texts = ["abc", "é" * 50, "".join(rng.choice(list("abcdé "), 100_000)), "zzz"] * 40
    sets = [language.present(t) for t in texts]
    want = np.array([[(x & y).sum() / np.sqrt(max(1, x.sum()) * y.sum()) for y in landmarks] for x in sets[:4]])
    whole = language.Scorer(model).kernel(texts)
    monkeypatch.setattr(language, "BLOCK_CELLS", 100)
    kept = language.Scorer(model).kernel(texts)
    monkeypatch.setattr(language, "KEPT_CELLS", 100)
    parts = language.Scorer(model).kernel(texts)
    assert np.array_equal(whole, kept) and np.array_equal(whole, parts) and np.allclose(whole[:4], want) and np.array_equal(whole[:4], whole[-4:])


def test_language_learns_from_repeated_rows_once(sane):
    docs = make(sane, ["the same text over and over"] * 500 + ["another text", "third text here"], ids=[1] * 500 + [4, 5])
    seen = []
    plain = language.materialize
    language.materialize = lambda df, *a, **k: seen.append(plain(df, *a, **k)) or seen[-1]
    try:
        language.fit(language.learning_rows(docs, "doc_id"), sample=10)
    finally:
        language.materialize = plain
    learned = [i for i in (1, 4, 5) if zlib.crc32(str(i).encode()) % 4 != 2]
    assert seen[0].count() == len(learned)
    many = make(sane, [f"text number {'abcdefgh'[i % 8]}{i}" for i in range(3000)])
    language.materialize = lambda df, *a, **k: seen.append(plain(df, *a, **k)) or seen[-1]
    try:
        language.fit(language.learning_rows(many, "doc_id"), sample=25, landmarks=8)
    finally:
        language.materialize = plain
    assert seen[1].count() == 25 and seen[1].select("n").distinct().count() == 25


# ---------------------------------------------------------------- 7 pieces

def test_viterbi_is_the_best_segmentation():
    rng = random.Random(12)
    chars = " abc"
    names = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) for _ in range(25)} | {" a", " ab", " ", "  "})
    pieces_ = [*names, *[""] * 256]
    vocabulary = pieces.Vocabulary(pieces_, [-rng.random() * 10 for _ in pieces_], list(range(len(names), len(names) + 256)), -100.0)
    automaton = pieces.Automaton(vocabulary)
    score = dict(zip(names, vocabulary.scores, strict=False))
    for _ in range(300):
        text = "".join(rng.choice(chars + "é") for _ in range(rng.randint(1, 14)))
        full = " " + text
        best = [0.0] + [-1e9] * len(full)
        for i in range(1, len(full) + 1):
            best[i] = max([best[i - 1] - 100.0] + [best[j] + score[full[j:i]] for j in range(max(0, i - 4), i) if full[j:i] in score])
        ids = automaton.encode(text)
        values = [vocabulary.scores[i] if i < len(names) else 0.0 for i in ids]
        bytes_ = automaton.decode_bytes(ids)
        unknown = sum(1 for i in ids if i >= len(names) and (i - len(names)) & 0xC0 != 0x80)
        assert abs(sum(values) - 100.0 * unknown - best[-1]) < 1e-9
        assert bytes_.decode() == text


def test_pieces_round_trip(sane):
    vocabulary = pieces.load_vocabulary(f"{catalog.TOKENIZERS}/piece_bpe_32k.model")
    texts = [*ODD, "plain words, twice. " * 2000, "nospace" * 3000, "  lead\n\n\ttabs "]
    docs = make(sane, texts)
    encoded = pieces.encode(docs, vocabulary)
    rows = by_id(encoded)
    assert all(r["round_trip"] and r["n_pieces"] == len(r["ids"]) for r in rows.values())
    back = by_id(pieces.decode(encoded, vocabulary))
    assert {i: r["text"] for i, r in back.items()} == {i: t or "" for i, t in enumerate(texts)}


# ---------------------------------------------------------------- 8 mixing

def test_permutation_is_one_and_inverts():
    for n in (1, 2, 3, 7, 64, 1000):
        x = np.arange(n)
        y = mixing.permute(x, n, 5)
        assert sorted(y.tolist()) == list(range(n)) and (mixing.permute(y, n, 5, inverse=True) == x).all()


def test_targets_are_reshared():
    assert mixing.reshare([10, 10, 1000], [3, 1, 2], 1.5, 2.0) == [20.0, 20.0, 1490.0]
    assert mixing.reshare([0, 0], [1, 1], 1.5, 2.0) == [0.0, 0.0]


@pytest.mark.parametrize("block", [1, 7, 256])
def test_mix_meets_targets(sane, block):
    rng = random.Random(13)
    rows = [(i, prose(rng, ["a", "bb", "ccc"], rng.randint(0, 90)), "en", rng.choice(["x", "y", "y", "y", "z", None, "é"]), 1) for i in range(200)]
    rows += [(500 + i, t, "en", "x", 1) for i, t in enumerate(ODD)] + [rows[5], rows[5]]
    docs = sane.createDataFrame(rows, DOCS)
    got = mixing.mixed_sizes(docs, block_words=block, shard_blocks=16).collect()
    again = mixing.mixed_sizes(docs.repartition(5), block_words=block, shard_blocks=16).collect()
    assert sorted(map(str, got)) == sorted(map(str, again)) and len(got) == len(rows)
    source = {r[0]: r[3] for r in rows}
    taken, target, size = collections.Counter(), {}, collections.Counter()
    for r in got:
        s = source[r["doc_id"]]
        taken[s] += r["taken"]
        size[s] += r["size"]
        target[s] = r["target"]
        assert r["taken"] <= 2 * r["size"] and r["source_size"] >= r["size"]
    assert all(abs(taken[s] - target[s]) <= max(1, block) for s in target)
    assert abs(sum(target.values()) - 1.5 * sum(size.values())) < 1e-6
    texts = mixing.mixed_documents(docs, block_words=block, shard_blocks=16).collect()
    words = collections.Counter()
    for r in texts:
        words[r["source"]] += len(r["text"].encode().split())
        assert r["n_chars"] == len(r["text"])
    assert all(words[s] == taken[s] for s in target)
    assert mixing.mixed_sizes(docs.where("doc_id < 0")).count() == 0


# ---------------------------------------------------------------- 9 suffix array

def test_suffix_array():
    rng = random.Random(14)
    for _ in range(500):
        t = [rng.randint(1, rng.choice([1, 2, 9])) for _ in range(rng.randint(0, 60))]
        assert suffixes.suffix_array(t) == sorted(range(len(t)), key=lambda i: t[i:])


@pytest.mark.parametrize("hot", [suffixes.HOT, 1])
def test_repeats_match_brute_force(sane, monkeypatch, hot):
    monkeypatch.setattr(suffixes, "HOT", hot)
    rng = random.Random(15)
    make_text = lambda n: "".join(rng.choice("abcdé \n") for _ in range(n))
    passages = [make_text(n) for n in (150, 190, 205, 230, 400, 900)]
    texts = [*ODD, "ab" * 400, "z" * 199, "z" * 150, make_text(5000)]
    for _ in range(40):
        parts = [make_text(rng.randint(0, 300))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            cut = rng.randint(0, 40)
            parts += [p[cut:] if rng.random() < 0.5 else p[:len(p) - cut], make_text(rng.randint(0, 120))]
        texts.append("".join(parts))
    texts += [texts[20], texts[20]]
    docs = make(sane, texts)
    docs = docs.union(docs.where("doc_id = 30"))
    bodies = [(t or "").encode() for t in texts] + [(texts[30] or "").encode()]
    count = collections.Counter(b[i:i + 200] for b in bodies for i in range(len(b) - 199))
    got = suffixes.remove_repeats(docs).collect()
    assert len(got) == len(bodies)
    for r in got:
        b = bodies[r["doc_id"]]
        gone = [False] * len(b)
        for i in range(len(b) - 199):
            if count[b[i:i + 200]] > 1:
                gone[i:i + 200] = [True] * 200
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (
            len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    assert suffixes.remove_repeats(docs.where("doc_id < 0")).count() == 0


# ---------------------------------------------------------------- the pipeline

def test_pipeline_stages(sane, tmp_path):
    import corpus_pipeline
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near-duplicates", "repeats", "mix", "pieces"]
    docs = sane.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs = docs.union(sane.createDataFrame([(9001, None, None, None, 0), (9002, "123", "en", "src0", 3)], docs.schema))
    want, at = [c for c in docs.columns], docs
    counts = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(sane, at, "/root/testdata/sf0.001")
        out.write.parquet(str(tmp_path / name))
        at = sane.read.parquet(str(tmp_path / name))
        counts.append(at.count())
        if name != "pieces":
            assert at.columns == want and at.where("doc_id is null").count() == 0
    assert counts[0] == docs.count() - 2
    kept = {r["doc_id"] for r in sane.read.parquet(str(tmp_path / "near-duplicates")).collect()}
    first = sane.read.parquet(str(tmp_path / "language"))
    sets = {r["doc_id"]: shingles(r["text"]) for r in first.collect()}
    links = [(a, b) for a in sets for b in sets if a > b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    assert kept == {n for n, c in groups_of(sets, links).items() if n == c}
    assert at.where("not round_trip").count() == 0 and counts[4] == counts[3]


def test_pipeline_keeps_one_of_repeated_rows(sane, monkeypatch):
    import corpus_pipeline
    rng = random.Random(23)
    names = ["".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(3000)]
    a, b, c, d, e = (prose(rng, names, 80) for _ in range(5))
    rows = [(1, a), (1, a), (1, a),             # a row three times
            (None, b), (None, b),               # a null id twice
            (2, c), (None, c),                  # an id and a null id
            (3, d), (4, d), (4, e),             # one of two texts of an id is a copy of a smaller id
            (5, None), (5, ""), (5, "")]
    docs = sane.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)
    kept = corpus_pipeline.deduplicate(sane, docs, "")
    assert kept.columns == docs.columns
    assert sorted(map(repr, [(r["doc_id"], r["text"]) for r in kept.collect()])) == sorted(
        map(repr, [(1, a), (None, b), (2, c), (3, d), (4, e), (5, None), (5, "")]))
    # through all stages but the mix, whose targets may leave documents out: every text arrives, and once
    given = sane.read.parquet("/root/testdata/sf0.001/documents.parquet")
    planted = sane.createDataFrame([(None if i is None else 9000 + i, t, "en", "src0", len(t or "")) for i, t in rows], given.schema)
    monkeypatch.setattr(corpus_pipeline, "read", lambda *_: given.union(planted))
    monkeypatch.setattr(corpus_pipeline, "STAGES", [s for s in corpus_pipeline.STAGES if s[0] != "mix"])
    found = corpus_pipeline.run(sane, "/root/testdata/sf0.001").where("doc_id > 9000 or doc_id is null").collect()
    assert sorted((r["doc_id"] or 0) for r in found) == [0, 9001, 9002, 9003, 9004]
    assert all(r["n_pieces"] > 80 and r["round_trip"] for r in found)


def test_extra_columns_do_not_clash(sane):
    docs = make(sane, ["one two three four five six", "one two three four five six", "other text"]).selectExpr(
        "*", "1 as id", "2 as body", "3 as rid", "4 as n", "5 as w", "6 as size", "7 as score", "8 as component", "9 as src")
    assert setsketch.near_duplicates(docs).count() == 3
    assert suffixes.remove_repeats(docs).count() == 3
    assert mixing.mixed_sizes(docs).count() == 3
    assert katz.score_documents(docs).count() == 3
    assert language.identify(docs).count() == 3
