"""SentencePiece encoding and decoding with a given vocabulary.

An Aho-Corasick automaton over the pieces reads a text once; at each position the output links give
every piece that ends there, and each relaxes the best score at that position (Viterbi). Characters
that no piece covers fall back to byte pieces. A text is cut where no piece can span (before a run of
spaces, around line feeds), so parts seen before are taken from a bounded memo.

Defined cases: null and empty texts have no pieces and decode to the empty text; a literal U+2581 is
kept apart from the space mark by byte fallback, so decoding gives every text back exactly; on equal scores the
longest last piece wins; extra columns are ignored; repeated rows give repeated results.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import bound_batches, once, fresh_key

MARK = "▁"     # how the vocabulary file writes a space
MEMO_UNITS = 300_000


@dataclass(frozen=True)
class Vocabulary:
    pieces: list[str]              # by id; a space is a plain space, "" for control pieces
    scores: list[float]
    byte_ids: list[int]            # id of each byte's piece
    unknown_score: float = field(default=0.0)


def load_vocabulary(path: str) -> Vocabulary:
    """Reads a SentencePiece model file (on the driver)."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, scores, byte_ids = [], [], [-1] * 256
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
        plain = not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        pieces.append(piece.replace(MARK, " ") if plain else "")
        scores.append(model.get_score(i))
    if min(byte_ids) < 0:
        raise ValueError("the vocabulary has no byte pieces")
    return Vocabulary(pieces, scores, byte_ids, min(scores) - 10.0)


class Automaton:
    """Goto, failure and output links over the pieces; ``encode`` is the single-pass Viterbi."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        goto: list[dict[str, int]] = [{}]
        ends: list[tuple[int, float, int] | None] = [None]
        for i, piece in enumerate(vocabulary.pieces):
            if not piece:
                continue
            node = 0
            for ch in piece:
                nxt = goto[node].get(ch)
                if nxt is None:
                    nxt = goto[node][ch] = len(goto)
                    goto.append({})
                    ends.append(None)
                node = nxt
            ends[node] = (len(piece), vocabulary.scores[i], i)
        fail = [0] * len(goto)
        link = [0] * len(goto)      # nearest proper suffix that is a piece
        queue = list(goto[0].values())
        for node in queue:
            for ch, nxt in goto[node].items():
                f = fail[node]
                while f and ch not in goto[f]:
                    f = fail[f]
                fail[nxt] = goto[f].get(ch, 0)
                link[nxt] = fail[nxt] if ends[fail[nxt]] else link[fail[nxt]]
                queue.append(nxt)
        self.goto, self.ends, self.fail, self.link = goto, ends, fail, link
        inner = any(" " in p.lstrip(" ") or "\n" in p for p in vocabulary.pieces)
        self.units = None if inner else re.compile(r" *[^ \n]+|\n| +")
        self.raw = [p.encode() for p in vocabulary.pieces]
        for b, i in enumerate(vocabulary.byte_ids):
            self.raw[i] = bytes([b])
        self.memo = _Memo(self)

    def viterbi(self, text: str) -> list[int]:
        """Ids of the best segmentation of ``text``."""
        goto, ends, fail, link = self.goto, self.ends, self.fail, self.link
        unknown = self.vocabulary.unknown_score
        best = [0.0]
        back: list[tuple[int, int]] = [(0, -1)]     # length, id (-1: bytes of one character)
        node, i = 0, 0
        for ch in text:
            i += 1
            nxt = goto[node].get(ch)
            while nxt is None and node:
                node = fail[node]
                nxt = goto[node].get(ch)
            node = nxt or 0
            top, how = best[-1] + unknown, (1, -1)
            at = node if ends[node] else link[node]
            while at:
                length, score, piece = ends[at]
                score += best[i - length]
                if score > top:
                    top, how = score, (length, piece)
                at = link[at]
            best.append(top)
            back.append(how)
        out: list[int] = []
        byte_ids = self.vocabulary.byte_ids
        while i:
            length, piece = back[i]
            if piece < 0:
                out.extend(byte_ids[b] for b in reversed(text[i - 1].encode("utf-8")))
            else:
                out.append(piece)
            i -= length
        out.reverse()
        return out

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, dtype=np.int32)
        text = " " + text
        if self.units is None:
            return np.array(self.viterbi(text), dtype=np.int32)
        return np.frombuffer(b"".join(map(self.memo.__getitem__, self.units.findall(text))), dtype=np.int32)

    def decode_bytes(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.raw.__getitem__, ids))[1:]

    def decode(self, ids: Iterable[int]) -> str:
        return self.decode_bytes(ids).decode("utf-8")


class _Memo(dict):
    """Encoded parts seen before; emptied when it has grown to its bound."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, unit: str) -> bytes:
        ids = np.array(self.automaton.viterbi(unit), dtype=np.int32).tobytes()
        if len(unit) <= 64:
            if len(self) >= MEMO_UNITS:
                self.clear()
            self[unit] = ids
        return ids


def _automaton(key: str, shared) -> Automaton:
    """One automaton per worker process and vocabulary."""
    return once(key, lambda: Automaton(shared.value))


def encode(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text: str = "text",
           ids: str = "ids") -> DataFrame:
    """Per row: id, ``ids`` array<int>, ``n_pieces``, and whether decoding the ids gives the text back."""
    spark = docs.sparkSession
    bound_batches(spark)
    key, shared = fresh_key(), spark.sparkContext.broadcast(vocabulary)     # a vocabulary is a fixed table
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(key, shared)
        for batch in batches:
            found, same = [], []
            for value in batch.column(1).to_pylist():
                got = automaton.encode(value or "")
                found.append(got)
                same.append(automaton.decode_bytes(got.tolist()) == (value or "").encode("utf-8"))
            counts = np.array([len(x) for x in found], dtype=np.int32)
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            flat = np.concatenate(found) if found else np.zeros(0, dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, type=pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), lists, pa.array(counts), pa.array(same, type=pa.bool_())],
                [id_col, ids, "n_pieces", "round_trip"])

    return docs.select(id_col, F.col(text).alias("__text")).mapInArrow(
        run, f"`{id_col}` {kind}, `{ids}` array<int>, n_pieces int, round_trip boolean")


def decode(encoded: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", ids: str = "ids",
           text: str = "text") -> DataFrame:
    """Texts back from ids; null ids give a null text."""
    spark = encoded.sparkSession
    bound_batches(spark)
    key, shared = fresh_key(), spark.sparkContext.broadcast(vocabulary)
    kind = encoded.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(key, shared)
        for batch in batches:
            texts = [None if x is None else automaton.decode(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, type=pa.string())], [id_col, text])

    return encoded.select(id_col, ids).mapInArrow(run, f"`{id_col}` {kind}, `{text}` string")
