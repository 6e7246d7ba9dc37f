"""Relations derived from the given tables, as a Spark builder and as SQL text side by side.

Pages come from whole documents (ink = non-blank character) and from embeddings (gray value =
scaled component); component tables, reports, predictions, trials and score events come from
the order, document and event tables. Nothing is filtered, sampled or cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

PAGE_COLUMNS = 64
TEXT_AT_ONCE = 1 << 20      # bytes of text that a task lays out together, or one text
ORDERS_PER_PAGE = 40


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Spread a scan over the cluster when its files make fewer splits than there are cores.

    Decoding a page is heavy for its bytes, so a single small file should not be one task. A scan
    that already has enough splits is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


# ---------------------------------------------------------------- gray pages, 8 x 8

def gray_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scanline of 8 gray values per row."""
    gray = F.transform("embedding", lambda e: F.greatest(F.lit(0.0), F.least(
        F.lit(255.0), F.floor((e.cast("double") + 0.6) * 212.5).cast("double"))).cast("int"))
    px = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("image_id"), gray.alias("all"))
    return (px.select("image_id", "all", F.explode(F.sequence(
        F.lit(0), (F.ceil(F.size("all") / 8) - 1).cast("int"))).alias("y"))
        .select("image_id", "y", F.slice("all", F.col("y") * 8 + 1, 8).alias("px")))


GRAY_SQL = """gray as materialized (
  select vec_id image_id, cast(pos//8 as int) y, cast(pos%8 as int) x,
    cast(greatest(0,least(255,floor((cast(e as double)+0.6)*212.5))) as int) v
  from (select vec_id, unnest(embedding) e, generate_subscripts(embedding,1)-1 pos from embeddings))"""


# ---------------------------------------------------------------- binary pages, 64 wide

def _laid_out(spark: SparkSession, sf_dir: str, name: str, kind: str, make) -> DataFrame:
    """(image_id, y, ``name``) of the same layout; ``make`` turns code points (lines by columns) into an Arrow array."""
    documents = spread(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("image_id"), "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds = np.flatnonzero(np.diff(np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0)) // TEXT_AT_ONCE)) + 1
            for first, end in zip([0, *bounds], [*bounds, batch.num_rows]):
                some = batch.slice(first, end - first)
                texts = ["" if t is None else t for t in some.column(1).to_pylist()]
                size = np.array([len(t) for t in texts], dtype=np.int64)
                lines = -(-size // PAGE_COLUMNS)
                codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
                px = np.full(int(lines.sum()) * PAGE_COLUMNS, ord(" "), np.uint32)
                px[np.arange(len(codes)) + np.repeat((np.cumsum(lines) - lines) * PAGE_COLUMNS - (np.cumsum(size) - size), size)] = codes
                y = np.arange(int(lines.sum())) - np.repeat(np.cumsum(lines) - lines, lines)
                yield pa.RecordBatch.from_arrays([some.column(0).take(pa.array(np.repeat(np.arange(len(texts)), lines))),
                                                  pa.array(y, pa.int32()), make(px.reshape(-1, PAGE_COLUMNS))], ["image_id", "y", name])
    key = documents.schema["image_id"].dataType.simpleString()
    return documents.mapInArrow(run, f"image_id {key}, y int, {name} {kind}")


def _blank(codes: np.ndarray) -> np.ndarray:
    return (codes == 32) | (codes == 9) | (codes == 10) | (codes == 13)


def _pixels(values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1) * PAGE_COLUMNS, pa.int32()), pa.array(values.ravel(), pa.int32()))


def page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary scanlines: 255 for a non-blank character, else 0."""
    return _laid_out(spark, sf_dir, "px", "array<int>", lambda codes: _pixels(np.where(_blank(codes), 0, 255)))


def page_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same scanlines as text of 0 and 1."""
    def text(codes: np.ndarray) -> pa.Array:
        ink = np.where(_blank(codes), ord("0"), ord("1")).astype(np.uint8)
        return pa.StringArray.from_buffers(len(ink), pa.py_buffer((np.arange(len(ink) + 1) * PAGE_COLUMNS).astype(np.int32)), pa.py_buffer(ink.tobytes()))
    return _laid_out(spark, sf_dir, "bits", "string", text)


def text_gray_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gray scanlines of the same layout: blanks are paper (230), characters darker by code."""
    return _laid_out(spark, sf_dir, "px", "array<int>", lambda codes: _pixels(np.where(_blank(codes), 230, codes.astype(np.int64) * 7 % 180)))


def _page_sql(name: str, value: str) -> str:
    return f"""{name} as materialized (
  select image_id, cast(y as int) y, cast(x as int) x, cast({value} as int) v from (
    select doc_id image_id, y, unnest(range(0,{PAGE_COLUMNS})) x,
      unnest(string_split(rpad(line,{PAGE_COLUMNS},' '),'')) c
    from (select doc_id, unnest(l) line, generate_subscripts(l,1)-1 y
          from (select doc_id, regexp_extract_all(text,'(?s).{{1,{PAGE_COLUMNS}}}') l from documents))))"""


_BLANK = "c in (' ',chr(9),chr(10),chr(13))"
PAGE_SQL = _page_sql("page", f"case when {_BLANK} then 0 else 255 end")
TEXT_GRAY_SQL = _page_sql("tgray", f"case when {_BLANK} then 230 else (unicode(c)*7)%180 end")


# ---------------------------------------------------------------- component tables

_COMP = f"""select l_orderkey // {ORDERS_PER_PAGE} image_id,
    ((l_orderkey % {ORDERS_PER_PAGE})*8 + l_linenumber)*10000000 + l_partkey label,
    1+cast(l_quantity as int)%24 h, cast(1+l_partkey%40 as int) w,
    cast(greatest(1,floor((1+cast(l_quantity as int)%24)*(1+l_partkey%40)*(1-5*l_discount))) as bigint) area
  from lineitem"""
_WCC = f"""select l_orderkey // {ORDERS_PER_PAGE} image_id,
    ((l_orderkey % {ORDERS_PER_PAGE})*8 + l_linenumber)*10000000 + l_partkey label,
    cast(1+l_suppkey%12 as int) h, cast(1+l_partkey%12 as int) w,
    cast(greatest(1,floor((1+l_suppkey%12)*(1+l_partkey%12)*(1-5*l_discount))) as bigint) area
  from lineitem"""
COMP_SQL = f"comp as materialized ({_COMP})"
WCC_SQL = f"wcc as materialized ({_WCC})"


def _component_columns(h, w) -> list:
    page = F.expr(f"l_orderkey div {ORDERS_PER_PAGE}")
    label = ((F.col("l_orderkey") % ORDERS_PER_PAGE) * 8 + F.col("l_linenumber")) * 10000000 \
        + F.col("l_partkey")
    area = F.greatest(F.lit(1), F.floor((h * w) * (1 - 5 * F.col("l_discount")))).cast("long")
    return [page.alias("image_id"), label.alias("label"), h.cast("int").alias("h"),
            w.cast("int").alias("w"), area.alias("area")]


def components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ink components: one box per order line."""
    return table(spark, sf_dir, "lineitem").select(*_component_columns(
        1 + F.col("l_quantity").cast("int") % 24, 1 + F.col("l_partkey") % 40))


def white_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(*_component_columns(
        1 + F.col("l_suppkey") % 12, 1 + F.col("l_partkey") % 12))


# ---------------------------------------------------------------- accuracy reports

def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OCR accuracy reports: token 13 is the percentage."""
    d = F.col("doc_id")
    body = F.concat_ws(
        " ", F.lit("Report One Two Three Four Version 5.1 -----"), F.col("n_chars").cast("string"),
        F.lit("Words"), (d % 17).cast("string"), F.lit("Misrecognized"),
        F.concat(F.floor((d * 37 % 10001) / 100).cast("int").cast("string"), F.lit("."),
                 F.lpad((d * 37 % 100).cast("string"), 2, "0"), F.lit("%")), F.lit("Accuracy"))
    return table(spark, sf_dir, "documents").select("doc_id", "source", body.alias("body"))


WACC_SQL = """wacc as materialized (
  select doc_id, source, concat_ws(' ','Report One Two Three Four Version 5.1 -----',
    cast(n_chars as varchar),'Words',cast(doc_id%17 as varchar),'Misrecognized',
    concat(cast((doc_id*37%10001)//100 as varchar),'.',lpad(cast(doc_id*37%100 as varchar),2,'0'),'%'),
    'Accuracy') body from documents)"""


# ---------------------------------------------------------------- predictions and features

def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a true and a predicted value: order total against the sum of its lines."""
    charge = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.round(F.sum(charge), 7).alias("y_pred"))
    return (table(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
            .select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("y_true"), "y_pred"))


PRED_SQL = """pred as materialized (
  select o_orderkey id, o_totalprice y_true, y_pred from orders join (
    select l_orderkey, round(sum(l_extendedprice*(1-l_discount)*(1+l_tax)),7) y_pred
    from lineitem group by 1) on o_orderkey=l_orderkey)"""

FEATURE_NAMES = ["x1", "x2", "x3", "x4", "x5"]


def feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A regression table: five features of an order's lines and a target."""
    revenue = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("x1"), F.round(F.avg("l_discount"), 9).alias("x2"),
        F.round(F.avg("l_tax"), 9).alias("x3"), F.count(F.lit(1)).cast("double").alias("x4"),
        F.max("l_extendedprice").alias("x5"),
        F.round(F.sum(revenue) / 1000000, 11).alias("y"))
    return (table(spark, sf_dir, "orders").select("o_orderkey")
            .join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
            .select(F.col("o_orderkey").alias("id"), *FEATURE_NAMES, "y"))


FEAT_SQL = """feat as materialized (
  select o_orderkey id, x1, x2, x3, x4, x5, y from orders join (
    select l_orderkey, sum(l_quantity) x1, round(avg(l_discount),9) x2, round(avg(l_tax),9) x3,
      cast(count(*) as double) x4, max(l_extendedprice) x5,
      round(sum(l_extendedprice*(1-l_discount))/1000000,11) y
    from lineitem group by 1) on o_orderkey=l_orderkey)"""


# ---------------------------------------------------------------- trials and score events

def trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("study"), F.col("event_id").alias("trial"), "value",
        (F.col("user_id") % 12 + 1).cast("int").alias("depth"),
        (F.col("user_id") % 5).cast("int").alias("rate"), "ts")


TRIALS_SQL = """trials as materialized (
  select event_type study, event_id trial, value, cast(user_id%12+1 as int) depth,
    cast(user_id%5 as int) rate, ts from events)"""


def score_columns(events: DataFrame) -> DataFrame:
    """Score events from event rows; also applies to a stream of them."""
    return events.select("event_id", "ts", "event_type",
                         (F.col("event_type") == "error").alias("is_error"),
                         F.least(F.lit(1.2), F.col("value") / F.lit(100.0)).alias("score"))


SCORE_SQL = """score as materialized (
  select event_id, ts, event_type, event_type='error' is_error, least(1.2,value/100) score from events)"""


def with_sql(*ctes: str) -> str:
    """A WITH clause from the named relation texts."""
    return "with recursive " + ",\n".join(ctes) + "\n"
