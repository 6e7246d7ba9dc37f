"""From raw documents to token ids: five stages, each working on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from folioscore.llm import language, mixing, pieces, setsketch, suffixes
from folioscore.llm.catalog import TOKENIZERS, read
from folioscore.session import materialize, ship_package


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; texts that are null or have no letter go.

    A language that stands at a document is left as it is, a null one is filled in. Repeated rows, null ids and texts of
    any length are treated alike; no rows give no rows; columns may have any name and type.
    """
    ship_package(spark)
    return language.keep_identified(docs, language.fit(language.learning_rows(docs, "doc_id")))


def single_rows(docs: DataFrame) -> DataFrame:
    """(key, id, row): one row per id and text, as one value; the key is the id where it stands once, else a hash of id and text."""
    rows = docs.select(F.col("doc_id").alias("id"), F.struct("*").alias("row"))
    several = materialize(rows.where("id is not null").groupBy("id").count().where("count > 1").select("id"), "several-rows")
    unclear = rows.where("id is null").unionByName(rows.join(several, "id", "left_semi"))
    # one row of each key, the same on every run: copies meet map side first, so a text that stands very often is no hot group
    unclear = unclear.groupBy(F.xxhash64("id", "row.text").alias("key")).agg(
        F.min_by(F.struct("id", "row"), F.to_json("row")).alias("first"))
    unclear = materialize(unclear.select("key", "first.id", "first.row"), "several-once")
    clear = rows.where("id is not null").join(several, "id", "left_anti")
    return clear.select(F.col("id").cast("long").alias("key"), "id", "row").unionByName(unclear)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id.

    Each different text of an id is a document of its own here, repeated rows are one, and rows with a null id are
    compared like all others (they stay where no row with an id is like them). Null and empty texts are like nothing
    and stay. No rows give no rows; columns may have any name and type.
    """
    ship_package(spark)
    once = single_rows(docs)
    near = setsketch.near_duplicates(once.select("key", "row.text"), "key").select("key", "component_id")
    named = materialize(near.join(once.select("key", "id"), "key"), "near-rows")
    first = named.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull(), "id", "key")).alias("one"))
    gone = named.join(first.select("one.key"), "key", "left_anti").select("key")
    return once.join(gone, "key", "left_anti").select("row.*")


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 200 bytes or more that stand anywhere else.

    Null texts become empty, rows stay; texts of any length are judged whole, repeated rows by each other too. Columns
    may have any name and type.
    """
    ship_package(spark)
    kept = suffixes.remove_repeats(docs, carry=docs.columns)
    # both columns keep the type that the others have
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast(docs.schema["n_chars"].dataType)}
    return kept.select(*(new[c].alias(c) if c in new else F.col("carried")[c].alias(c) for c in docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: documents with the words that each epoch takes.

    Rows equal in id, text and source are one; empty and null texts have no words to take and go; a null source is one
    of its own. No rows give no rows; columns may have any name and type.
    """
    ship_package(spark)
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text, with the check that they decode to it; null and empty texts have none."""
    ship_package(spark)
    return pieces.encode(docs, pieces.load_vocabulary(f"{TOKENIZERS}/piece_bpe_32k.model"))


STAGES = [
    ("language", identify),
    ("near-duplicates", deduplicate),
    ("repeats", cut_repeats),
    ("mix", mix_sources),
    ("pieces", encode),
]

#: Kernels, sketches and automata can't be said in SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
