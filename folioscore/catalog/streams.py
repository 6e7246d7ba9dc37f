"""Streaming telemetry over the events table: T2, T3, T4."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioscore.catalog import query
from folioscore.sources.derive import SCORE_SQL, score_columns, table, with_sql
from folioscore.streaming import telemetry as tm


def score_stream(spark, sf):
    schema = table(spark, sf, "events").schema
    return score_columns(spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf))


@query("T2_score_histogram", with_sql(SCORE_SQL) + """, b as (select unnest(['0.25','0.5','0.75','1','+Inf']) le,
  unnest([0.25,0.5,0.75,1,1e9]) top) select le, count(*) filter (not is_error and score<=top) n,
 round((select sum(score) from score where not is_error),4) total from b, score group by le""")
def histogram(spark, sf):
    run = tm.run_to_table(tm.score_histogram(score_stream(spark, sf)), "complete", "histogram")
    return tm.histogram_rows(tm.latest(run))


@query("T3_error_counter", with_sql(SCORE_SQL) + "select count(*) filter (is_error) errors, count(*) requests from score")
def errors(spark, sf):
    return tm.latest(tm.run_to_table(tm.error_count(score_stream(spark, sf)), "complete", "errors"))


@query("T4_request_rates", with_sql(SCORE_SQL) + """select cast(epoch(time_bucket(interval '15 seconds', ts)) as bigint) started,
 event_type, count(*) n from score group by 1,2""")
def rates(spark, sf):
    done = tm.run_rates(score_stream(spark, sf))
    start = F.expr("timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', cast(w.start as timestamp_ntz))").alias("started")
    return done.select(start, "event_type", "n")
