"""Toxicity scores from a learned lexicon with tolerance for misspelling.

Words and word beginnings that occur almost only in texts labelled toxic form a trie. Each word of a text
runs through the trie intersected with the Levenshtein automaton of distance one (its states are built as they are
met), so misspelled terms match too; matched words that are not clearly more
common in toxic than in clean training texts are words of their own and are taken out again by a join.
A hit counts as quoted if a pair of quotation marks stands around it inside its window of words, at the edges of words
(an apostrophe within or behind a word is none), or if it directly follows a word that names words. A logistic
regression over the counts of plain, misspelled and quoted hits gives the score.

Defined cases: null and empty texts have no hits and get the score of a text without hits; documents without a label are
scored but not learned from; without any toxic training label the lexicon is empty and every score is 0, without any clean one it is
empty; several labels of
one id count as toxic if one is; rows with a null id are scored and not held out; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .common import bound_batches, fresh_key, once

#: Opening quotation marks with what closes them, and words that introduce a mentioned word.
PAIRS = {'"': '"', "“": "”", "„": "“”", "«": "»", "»": "«", "‹": "›", "›": "‹", "‘": "’", "‚": "‘’"}
NAMING = ("word", "term", "slur")
QUOTES = "\"“”„«»‹›‘’‚"
WINDOW = 12             # words on either side of a hit in which its marks must stand
FUZZY_LENGTH = 5        # shorter terms must match exactly
STEM_LENGTHS = (4, 5, 6)
LEAST = 4               # toxic training texts that a term stands in, at least
CHANCE = 0.05           # probability that any word at all becomes a term although it says nothing about the label
RATIO = 25              # a term's share of the toxic texts to its share of the clean ones, at least
OWN_RATIO = 4           # a word near a term whose shares have a smaller ratio is a word of its own
SAMPLE = 20_000
MEMO_WORDS = 300_000
MEMO_STATES = 200_000
FEATURES = ("plain", "misspelled", "quoted", "kinds")
_NEAR = pa.list_(pa.struct([("word", pa.string()), ("misspelled", pa.int64()), ("quoted", pa.int64()), ("kinds", pa.int64())]))
_TRIM = "".join(chr(c) for c in range(33, 128) if not chr(c).isalnum()) + QUOTES + "…–—¡¿"


def normal(word: str) -> str:
    return word.strip(_TRIM).lower()


class Lexicon:
    """The trie of terms and stems, intersected lazily with the Levenshtein automaton of distance one."""

    def __init__(self, terms: list[str], stems: list[str]):
        self.next: list[dict[str, int]] = [{}]
        self.accept: list[str] = [""]          # "" none, "t" whole word, "s" any continuation
        self.depth = [0]
        for words, kind in ((terms, "t"), (stems, "s")):
            for word in words:
                node = 0
                for ch in word:
                    if ch not in self.next[node]:
                        self.next[node][ch] = len(self.next)
                        self.next.append({})
                        self.accept.append("")
                        self.depth.append(self.depth[node] + 1)
                    node = self.next[node][ch]
                if word:
                    self.accept[node] = "s" if kind == "s" else (self.accept[node] or "t")
        self._forget()

    def _forget(self) -> None:
        """Drop the states met so far; they are built again as needed."""
        self.states: dict[frozenset, int] = {}
        self.sets: list[dict[int, int]] = []
        self.moves: list[dict[str, int]] = []
        self.within: list[int] = []            # what a word that reaches the state is by its stem, and what one that ends there is
        self.ending: list[int] = []
        self.start = self._state({0: 0})

    def _state(self, errors: dict[int, int]) -> int:
        """Number of a set of (trie node, errors so far), closed under skipped letters of a term."""
        for node, e in list(errors.items()):
            if e == 0:
                for child in self.next[node].values():
                    errors[child] = min(errors.get(child, 2), 1)
        key = frozenset(errors.items())
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(errors)
            self.moves.append({})
            for kinds, kind, depth in ((self.within, "s", FUZZY_LENGTH + 1), (self.ending, "t", FUZZY_LENGTH)):
                met = [(n, e) for n, e in errors.items() if self.accept[n] == kind]
                kinds.append(1 if any(e == 0 for _, e in met) else 2 if any(self.depth[n] >= depth for n, _ in met) else 0)
        return self.states[key]

    def _move(self, state: int, ch: str) -> int:
        got: dict[int, int] = {}
        for node, e in self.sets[state].items():
            hit = self.next[node].get(ch)
            if hit is not None:
                got[hit] = min(got.get(hit, 2), e)
            if e == 0:
                got[node] = min(got.get(node, 2), 1)
                for child in self.next[node].values():
                    got[child] = min(got.get(child, 2), 1)
        self.moves[state][ch] = to = self._state(got)
        return to

    def match(self, word: str) -> int:
        """0: no term, 1: a term or a stem with any ending, 2: one edit away from one."""
        if len(self.sets) > MEMO_STATES:
            self._forget()
        node, fuzzy = self.start, False
        for ch in word:
            to = self.moves[node].get(ch)
            node = self._move(node, ch) if to is None else to
            if not self.sets[node]:
                break
            if self.within[node] == 1:
                return 1
            fuzzy = fuzzy or self.within[node] == 2
        else:
            if self.ending[node] == 1:
                return 1
            fuzzy = fuzzy or self.ending[node] == 2
        return 2 if fuzzy else 0


def _edges(raw: str) -> tuple[str, str]:
    """Punctuation before and behind a word; both are all of it where there is no word."""
    lead, tail = raw[:len(raw) - len(raw.lstrip(_TRIM))], raw[len(raw.rstrip(_TRIM)):]
    return (raw, raw) if len(lead) == len(raw) else (lead, tail)


class _Memo(dict):
    """Class of each word as it stands in texts: 0-2 as matched, plus 4 if a quotation mark stands at an edge."""

    def __init__(self, lexicon: Lexicon):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, raw: str) -> int:
        word = normal(raw)
        value = self.lexicon.match(word) if word else 0
        if any(c in QUOTES for edge in _edges(raw) for c in edge):
            value += 4
        if len(self) >= MEMO_WORDS:
            self.clear()
        self[raw] = value
        return value


def is_quoted(found: list[str], kinds: bytes, i: int) -> bool:
    """Whether the word stands inside a pair of marks: the nearest mark before it opens, the next one of that pair closes behind it.

    A mark that stands alone opens before the word and closes behind it, save for those that only ever close.
    """
    if i and normal(found[i - 1]) in NAMING:
        return True
    for j in range(i, max(-1, i - WINDOW - 1), -1):
        if not kinds[j] & 4:
            continue
        lead, tail = _edges(found[j])
        alone = lead == found[j]
        if j < i and any(c in ("”»›’" if alone else QUOTES) for c in tail):
            return False
        openers = [c for c in lead if c in PAIRS]
        if openers:
            for k in range(i, min(len(found), i + WINDOW + 1)):
                if kinds[k] & 4:
                    lead, tail = _edges(found[k])
                    if any(c in PAIRS[openers[-1]] for c in tail):
                        return True
                    if k > i and any(c in PAIRS for c in lead):
                        return False
            return False
    return False


def hits(memo: _Memo, text: str) -> tuple[int, int, int, int, list[dict]]:
    """Plain, misspelled and quoted hits, different words among them, and what each misspelled word adds to these."""
    found = text.split()
    kinds = bytes(map(memo.__getitem__, found))
    plain = misspelled = quoted = 0
    names = set()
    near: dict[str, dict] = {}
    for i in [i for i, k in enumerate(kinds) if k & 3] if any(k in kinds for k in (1, 2, 5, 6)) else ():
        name, reported = found[i].lower(), is_quoted(found, kinds, i)
        if kinds[i] & 3 == 2:
            word = normal(found[i])
            own = near.setdefault(word, {"word": word, "misspelled": 0, "quoted": 0, "kinds": 0})
            own["quoted" if reported else "misspelled"] += 1
            own["kinds"] += name not in names
        names.add(name)
        if reported:
            quoted += 1
        elif kinds[i] & 3 == 1:
            plain += 1
        else:
            misspelled += 1
    return plain, misspelled, quoted, len(names), list(near.values())


def word_counts(labelled: DataFrame, text: str = "text") -> DataFrame:
    """(word, toxic, clean): in how many toxic and clean texts each word occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())

        def out():
            names = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_pydict({
                "word": pa.array(names, pa.string()), "toxic": pa.array([counts[1][w] for w in names], pa.int64()),
                "clean": pa.array([counts[0][w] for w in names], pa.int64())})
            counts[0].clear()
            counts[1].clear()

        for batch in batches:
            for label, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts[int(label)].update({normal(w) for w in set(value.split())} if value else ())
            if len(counts[0]) + len(counts[1]) > 400_000:
                yield from out()
        yield from out()

    partial = labelled.select("toxic", text).mapInArrow(run, "word string, toxic long, clean long")
    return partial.where("length(word) between 2 and 40").groupBy("word").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def evidence(q: float) -> Column:
    """Minus the logarithm of a bound on the probability that so many of a word's texts are toxic by chance (Chernoff)."""
    n = F.col("toxic") + F.col("clean")
    return F.col("toxic") * F.ln(F.col("toxic") / (n * q)) + F.when(
        F.col("clean") > 0, F.col("clean") * F.ln(F.col("clean") / (n * (1.0 - q)))).otherwise(0.0)


def learn_lexicon(labelled: DataFrame, text: str = "text") -> tuple[Lexicon, DataFrame]:
    """All terms and stems that toxic training texts use at ``RATIO`` times the rate of clean ones and beyond chance, which takes
    the number of words that are tried into account; and the words of clean texts that don't tell toxic ones, which are no
    misspellings. No share of the texts is asked for and no number of terms is cut off."""
    spark = labelled.sparkSession
    bound_batches(spark)
    counts = materialize(word_counts(labelled, text), "word-counts")
    sizes = labelled.groupBy("toxic").count().collect()
    toxic = sum(r["count"] for r in sizes if r["toxic"] == 1)
    clean = sum(r["count"] for r in sizes if r["toxic"] == 0)
    if not toxic or not clean:
        return Lexicon([], []), counts.where("false").select("word")
    q = toxic / (toxic + clean)

    def mostly_toxic(ratio: int) -> Column:
        return F.col("toxic") * F.lit(clean) >= ratio * F.lit(toxic) * F.col("clean")

    def telling(tried: DataFrame, name: str, also: Column) -> list[str]:
        tried = tried.where(F.col("toxic") >= LEAST)
        bar = float(np.log(max(tried.count(), 1) / CHANCE))
        return sorted(r[name] for r in tried.where(mostly_toxic(RATIO) & (evidence(q) >= bar) & also).select(name).collect())

    terms = telling(counts, "word", F.lit(True))
    starts = counts.select("toxic", "clean", F.explode(F.array(*[
        F.when(F.length("word") > n, F.substring("word", 1, n)) for n in STEM_LENGTHS])).alias("stem")).where("stem is not null")
    stems = starts.groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"),
                                       F.count_if(F.col("toxic") > 0).alias("forms"))
    stems = telling(materialize(stems, "stems"), "stem", (F.col("forms") >= 5) & (F.col("toxic") >= 40 * F.col("clean")))
    return Lexicon(terms, stems), counts.where((F.col("clean") > 0) & ~mostly_toxic(OWN_RATIO)).select("word")


def count_hits(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, its hits and, in ``near``, what each misspelled word adds to them."""
    spark = docs.sparkSession
    bound_batches(spark)
    key, shared = fresh_key(), spark.sparkContext.broadcast(lexicon)      # words that pass the test
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = once(key, lambda: _Memo(shared.value))
        for batch in batches:
            found = [hits(memo, t) if t else (0, 0, 0, 0, []) for t in batch.column(1).to_pylist()]
            counts = np.array([f[:4] for f in found], dtype=np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c) for c in counts.T), pa.array([f[4] for f in found], _NEAR)], [id_col, *FEATURES, "near"])

    return docs.select(id_col, F.col(text).alias("__text")).mapInArrow(
        run, f"`{id_col}` {kind}, " + ", ".join(f"{f} long" for f in FEATURES)
        + ", near array<struct<word string, misspelled long, quoted long, kinds long>>")


def without_words(found: DataFrame, own: DataFrame) -> DataFrame:
    """Hits less those of misspelled words that are words of their own."""
    found = materialize(found.withColumn("__row", F.monotonically_increasing_id()), "all-hits")
    near = found.select("__row", F.inline("near"))
    own = materialize(near.select("word").distinct().join(own.hint("merge"), "word", "left_semi"), "own-words")
    less = near.join(own, "word", "left_semi").groupBy("__row").agg(
        *[F.sum(f).alias(f"less_{f}") for f in ("misspelled", "quoted", "kinds")])
    return found.join(less, "__row", "left").select(*[c for c in found.columns if c not in ("__row", "near", *FEATURES)], "plain", *[
        (F.col(f) - F.coalesce(f"less_{f}", F.lit(0))).alias(f) for f in ("misspelled", "quoted", "kinds")])


def fit_weights(x: np.ndarray, y: np.ndarray, penalty: float = 0.1, rounds: int = 30) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last weight is the constant. Weights of hits stay positive
    for plain and misspelled ones, which the penalty pulls to one rather than to zero."""
    x = np.hstack([x, np.ones((len(x), 1))])
    prior = np.array([1.0, 1.0, 0.0, 0.0, 0.0])
    strength = np.array([penalty] * 4 + [1e-3])
    w = prior.copy()
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + strength * (w - prior)
        bend = (x * (p * (1 - p))[:, None]).T @ x + np.diag(strength)
        step = np.linalg.solve(bend, slope)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return w


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text",
                   sample: int = SAMPLE) -> DataFrame:
    """Per row: id, held_out, score, predicted and the hits. The regression is fitted on at most ``sample`` labelled rows
    of each label; the lexicon is counted over all of them."""
    held = F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))
    known = labels.where(F.col("toxic").isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__id")).agg(
        F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = known.where(F.crc32(F.col("__id").cast("string")) % 5 != 0)
    # labels grow with the documents: a shuffled join at every size
    labelled = docs.select(id_col, text).join(known.hint("merge"), F.col(id_col) == F.col("__id")).select("toxic", text)
    lexicon, own = learn_lexicon(labelled, text)
    found = materialize(without_words(count_hits(docs, lexicon, id_col, text), own), "toxic-hits")
    values = [F.log1p(f).alias(f) for f in FEATURES]
    rows = found.join(known, F.col(id_col) == F.col("__id"))
    order = [F.xxhash64(id_col), F.col(id_col)]
    parts = [rows.where(F.col("toxic") == label).orderBy(*order).limit(sample).select("toxic", *values).toPandas() for label in (0, 1)]
    y = np.concatenate([p["toxic"].to_numpy(dtype=float) for p in parts])
    if not y.any():
        score = F.lit(0.0)
    else:
        w = fit_weights(np.concatenate([p[list(FEATURES)].to_numpy(dtype=float) for p in parts]), y)
        total = F.lit(float(w[-1]))
        for f, v in zip(FEATURES, w, strict=False):
            total = total + F.lit(float(v)) * F.log1p(f)
        score = 1.0 / (1.0 + F.exp(-total))
    return found.select(id_col, held.alias("held_out"), score.alias("score"),
                        (score >= 0.5).cast("int").alias("predicted"), *FEATURES)
