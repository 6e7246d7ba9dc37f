"""Sources and sinks, projections, joins, sets, scalars and ledger queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioscore.catalog import query
from folioscore.functions import file_stem, finite_or_zero, int_div, join_path, scaled_height, unary_maps
from folioscore.operators import evaluate as ev, ledger as lg
from folioscore.session import materialize, scratch_path
from folioscore.sources import reports as rp, tables as tb
from folioscore.sources.derive import (FEAT_SQL, FEATURE_NAMES, PRED_SQL, TRIALS_SQL, WACC_SQL, feature_rows,
                                       predictions, reports, trials, with_sql)

FEATS = ", ".join(FEATURE_NAMES)

# a labelled table with raw ratios: some infinite, some undefined
RAW_SQL = """raw as materialized (select id, x1, x2, x3, x4, x5,
  case when x3=0 and x2=0 then 'nan'::double when x3=0 then 'inf'::double else x2/x3 end r,
  50+y*100 tess_acc, 40+y*120 fine_acc from feat)"""


def raw_table(spark, sf):
    x2, x3 = F.col("x2"), F.col("x3")
    ratio = F.when((x3 == 0) & (x2 == 0), F.lit(float("nan"))).when(
        x3 == 0, F.lit(float("inf"))).otherwise(F.try_divide(x2, x3))
    return feature_rows(spark, sf).select("id", *FEATURE_NAMES, ratio.alias("r"), (50 + F.col("y") * 100).alias(
        "tess_acc"), (40 + F.col("y") * 120).alias("fine_acc"))


RAW = with_sql(FEAT_SQL, RAW_SQL)
_R = "case when isnan(r) or isinf(r) then 0 else r end"


# ------------------------------------------------------------------ reports and joins

_ACC = "try_cast(regexp_replace(string_split_regex(trim(body),'\\s+')[13],'.$','') as double)"


@query("S3_accuracy_report_scan", with_sql(WACC_SQL) + f"select doc_id, {_ACC} acc from wacc")
def accuracy(spark, sf):
    return reports(spark, sf).select("doc_id", rp.parse_accuracy(F.col("body")).alias("acc"))


SIDES = f"""acc as materialized (select doc_id, source device, concat('page_',doc_id) file_name, {_ACC} acc from wacc),
 tess as (select device,file_name,acc from acc), fine as (select device,file_name,acc from acc where doc_id in (select doc_id from labels)),
 img as (select source device, concat('page_',doc_id) file_name, cast(n_chars as double) size from documents where doc_id in (select vec_id from embeddings))"""


def sides(spark, sf):
    """Engine B reports on every page, engine A on those with a label; pages with a vector have an image."""
    acc = reports(spark, sf).select("doc_id", F.col("source").alias("device"), F.concat(
        F.lit("page_"), F.col("doc_id").cast("string")).alias("file_name"), rp.parse_accuracy(F.col("body")).alias("acc"))
    some = lambda t, c: spark.read.parquet(f"{sf}/{t}.parquet").select(F.col(c).alias("doc_id")).distinct()
    images = spark.read.parquet(f"{sf}/documents.parquet").join(some("embeddings", "vec_id"), "doc_id", "left_semi").select(
        F.col("source").alias("device"), F.concat(F.lit("page_"), F.col("doc_id").cast("string")).alias("file_name"),
        F.col("n_chars").cast("double").alias("size"))
    return images, acc.drop("doc_id"), acc.join(some("labels", "doc_id"), "doc_id", "left_semi").drop("doc_id")


KEYS = ["device", "file_name"]


@query("J1_image_report_join", with_sql(WACC_SQL, SIDES) + """select device, file_name, tess.acc tess_acc,
 fine.acc fine_acc, size from tess join fine using (device,file_name) join img using (device,file_name)""")
def report_join(spark, sf):
    images, tess, fine = sides(spark, sf)
    return rp.labelled(images, tess, fine, KEYS)


@query("J2_missing_partners", with_sql(WACC_SQL, SIDES) + """select device, file_name, 'fine' missing from tess
 anti join fine using (device,file_name) union all select device, file_name, 'image' from tess anti join img using (device,file_name)""")
def missing(spark, sf):
    images, tess, fine = sides(spark, sf)
    return rp.missing_partners(images, tess, fine, KEYS)


@query("J6_parameter_grid", with_sql(TRIALS_SQL) + """select study, depth, rate from
 (select distinct study, depth from trials) join (select distinct study, rate from trials) using (study)""")
def grid(spark, sf):
    lists = trials(spark, sf).groupBy("study").agg(F.collect_set("depth").alias("depth"), F.collect_set("rate").alias("rate"))
    return lg.parameter_grid(lists, "study", ["depth", "rate"])


@query("J7_index_to_name", with_sql(TRIALS_SQL) + """select study, trial, name from trials join
 (select unnest(['x1','x2','x3','x4','x5']) name, unnest(range(0,5)) rate) using (rate)""")
def index_names(spark, sf):
    names = F.array(*[F.lit(n) for n in FEATURE_NAMES])
    return trials(spark, sf).select("study", "trial", F.get(names, F.col("rate")).alias("name"))


# ------------------------------------------------------------------ sinks and scans (round trips)

@query("S5_S6_feature_table_csv", with_sql(FEAT_SQL) + f"select id, {FEATS}, y from feat")
def csv_round_trip(spark, sf):
    df, path = feature_rows(spark, sf), scratch_path(spark, "features-csv")
    tb.write_features(df, path, "csv")
    return tb.read_features(spark, path, df.schema, "csv")


@query("S5_feature_table_parquet", with_sql(FEAT_SQL) + f"select id, {FEATS}, y from feat")
def parquet_round_trip(spark, sf):
    df, path = feature_rows(spark, sf), scratch_path(spark, "features")
    tb.write_features(df, path)
    return tb.read_features(spark, path, df.schema)


SPLIT_SQL = """ranked as materialized (select *, row_number() over (order by md5(concat(id,'42'))) r, count(*) over () n from feat),
 split as materialized (select *, case when r<=ceil(0.2*n) then 'test' else 'train' end split from ranked)"""
SPLIT = with_sql(FEAT_SQL, SPLIT_SQL)


def split_rows(spark, sf):
    return ev.train_test_split(feature_rows(spark, sf), "id")


@query("M1_train_test_split", SPLIT + "select id, split from split")
def train_test(spark, sf):
    return split_rows(spark, sf).select("id", "split")


@query("S7_split_table", SPLIT + f"select id, {FEATS}, y, split from split where split='test'")
def split_round_trip(spark, sf):
    path = scratch_path(spark, "split")
    tb.write_split(split_rows(spark, sf), path)
    return tb.read_split(spark, path, "test")


@query("S13_selected_feature_table", SPLIT + "select id, x1, x5, y, split from split where split='train'")
def selected_round_trip(spark, sf):
    path = scratch_path(spark, "selected")
    kept = [FEATURE_NAMES[i] for i in (0, 4)]
    tb.write_split(split_rows(spark, sf).select("id", *kept, "y", "split"), path)
    return tb.read_split(spark, path, "train")


METRIC_SQL = with_sql(PRED_SQL) + """, rk as (select *, rank() over (order by y_true)+(count(*) over (partition by y_true)-1)/2 ry,
   rank() over (order by y_pred)+(count(*) over (partition by y_pred)-1)/2 rp from pred),
 m as (select 1-avg((y_true-y_pred)*(y_true-y_pred))/var_pop(y_true) r2, avg(abs(y_true-y_pred)) mae,
   avg((y_true-y_pred)*(y_true-y_pred)) mse, corr(y_true,y_pred) plcc, corr(ry,rp) srocc from rk)
 select unnest(['R2','MAE','MSE','PLCC','SROCC']) as name, round(unnest([r2,mae/1000,mse/1000000,plcc,srocc]),6) as value from m"""


def scaled_metrics(spark, sf):
    """MAE and MSE in thousands: absolute values near 1e10 carry no six decimals."""
    unit = F.when(F.col("name") == "MAE", F.lit(1000.0)).when(F.col("name") == "MSE", F.lit(1000000.0)).otherwise(F.lit(1.0))
    return ev.evaluate(materialize(predictions(spark, sf), "predictions")).select("name", F.round(F.col("value") / unit, 6).alias("value"))


@query("S9_metric_table_csv", METRIC_SQL)
def metric_round_trip(spark, sf):
    path = scratch_path(spark, "metrics")
    tb.write_metrics(scaled_metrics(spark, sf), path)
    return tb.read_metrics(spark, path)


@query("M19_metric_bundle", METRIC_SQL)
def metric_bundle(spark, sf):
    return scaled_metrics(spark, sf)


SFS_SQL = """sfs as (select depth k, round(-avg(value),6) avg_score, round(stddev_pop(value),6) std_dev, count(*) n
  from trials group by depth)"""


def sfs_table(spark, sf):
    return trials(spark, sf).groupBy(F.col("depth").alias("k")).agg(
        F.round(-F.avg("value"), 6).alias("avg_score"), F.round(F.stddev_pop("value"), 6).alias("std_dev"),
        F.count(F.lit(1)).alias("n"))


@query("S12_selection_report", with_sql(TRIALS_SQL, SFS_SQL) + "select k, avg_score, std_dev, n from sfs")
def selection_report(spark, sf):
    df, path = sfs_table(spark, sf), scratch_path(spark, "sfs")
    tb.write_features(df, path, "csv")
    return tb.read_features(spark, path, df.schema, "csv")


def ledger_rows(spark, sf):
    """One run per event; parameters, metrics and tags as maps."""
    t = trials(spark, sf)
    start = F.col("ts").cast("timestamp")
    return t.select(F.concat(F.lit("run"), F.col("trial").cast("string")).alias("run_id"), F.col("study").alias("run_name"),
                    F.lit("quality").alias("experiment"), start.alias("start_time"),
                    (start + F.make_dt_interval(secs=F.col("depth").cast("decimal(18,6)"))).alias("end_time"),
                    F.create_map(F.lit("regressor__depth"), F.col("depth").cast("string"),
                                 F.lit("regressor__rate"), F.col("rate").cast("string")).alias("params"),
                    F.create_map(F.lit("MAE"), "value", F.lit("MSE"), F.col("value") * F.col("value")).alias("metrics"),
                    F.create_map(F.lit("Training Info"), F.lit("derived")).alias("tags"))


@query("S14_run_ledger_append", with_sql(TRIALS_SQL) + """select concat('run',trial) run_id, study run_name,
 cast(depth as varchar) depth, value mae, 'derived' info from trials""")
def ledger_append(spark, sf):
    runs, path = ledger_rows(spark, sf), scratch_path(spark, "ledger")
    first = F.col("run_name").eqNullSafe("error")
    lg.append_runs(runs.where(first), path)
    lg.append_runs(runs.where(~first), path)
    return lg.read_ledger(spark, path).select(
        "run_id", "run_name", F.col("params")["regressor__depth"].alias("depth"), F.col("metrics")["MAE"].alias("mae"),
        F.col("tags")["Training Info"].alias("info"))


# ------------------------------------------------------------------ projections

@query("P1_drop_column", RAW + f"select id, {FEATS}, {_R} r, fine_acc from raw")
def drop_column(spark, sf):
    df = raw_table(spark, sf).drop("tess_acc")
    return df.withColumn("r", finite_or_zero(F.col("r")))


@query("P2_P3_target_scaling", RAW + "select id, [x1,x2,x3,x4,x5] features, fine_acc/100 y from raw")
def target(spark, sf):
    return raw_table(spark, sf).select("id", F.array(*FEATURE_NAMES).alias("features"), (F.col("fine_acc") / 100).alias("y"))


@query("P4_non_finite_to_zero", RAW + f"select id, {_R} r, x2, x3 from raw")
def non_finite(spark, sf):
    return ev.clean(raw_table(spark, sf), ["r", "x2", "x3"]).select("id", "r", "x2", "x3")


@query("P5_cast_to_float", with_sql(TRIALS_SQL) + "select trial, cast(depth as double) depth, cast(rate as double) rate from trials")
def cast_float(spark, sf):
    return trials(spark, sf).select("trial", *[F.col(c).cast("double").alias(c) for c in ("depth", "rate")])


@query("P8_U2_flatten_features", with_sql(FEAT_SQL) + "select id, x1 cc_SW_1, x2 cc_SW_2, x4 cc_FS, x5 morph_closing from feat")
def flatten(spark, sf):
    nested = feature_rows(spark, sf).select("id", F.struct(F.array("x1", "x2").alias("SW"), F.col("x4").alias("FS")).alias("cc"),
                                            F.struct(F.col("x5").alias("closing")).alias("morph"))
    return nested.select("id", F.col("cc.SW")[0].alias("cc_SW_1"), F.col("cc.SW")[1].alias("cc_SW_2"),
                         F.col("cc.FS").alias("cc_FS"), F.col("morph.closing").alias("morph_closing"))


@query("P10_column_subset", with_sql(FEAT_SQL) + "select id, x2, x4 from feat")
def subset(spark, sf):
    return feature_rows(spark, sf).select("id", *[FEATURE_NAMES[i] for i in (1, 3)])


@query("P11_parameter_key_strip", with_sql(TRIALS_SQL) + "select concat('run',trial) run_id, 'depth,rate' as names, cast(rate as varchar) rate from trials")
def key_strip(spark, sf):
    p = lg.strip_prefix(F.col("params"))
    return ledger_rows(spark, sf).select("run_id", F.array_join(F.array_sort(F.map_keys(p)), ",").alias("names"), p["rate"].alias("rate"))


# ------------------------------------------------------------------ sets and scalars

@query("U1_device_union", with_sql(FEAT_SQL) + """select id, x1, 'a' device from feat union all
 select id, x1, 'b' from feat""")
def device_union(spark, sf):
    df = feature_rows(spark, sf).select("id", "x1")
    return df.withColumn("device", F.lit("a")).unionByName(df.withColumn("device", F.lit("b")))


@query("U3_explode_settings", with_sql(FEAT_SQL) + """select parts, cast(floor(x1/parts) as bigint) band, count(*) n
 from feat, (select unnest([1,4,16]) parts) group by 1,2""")
def settings_union(spark, sf):
    parts = F.explode(F.array(F.lit(1), F.lit(4), F.lit(16))).alias("parts")
    return feature_rows(spark, sf).select("x1", parts).groupBy("parts", F.floor(F.col("x1") / F.col("parts")).alias("band")).agg(
        F.count(F.lit(1)).alias("n"))


@query("F1_generated_features", with_sql(FEAT_SQL) + """select id, round(1+x2,6) plus1, round(sqrt(x2),6) "sqrt", round(sin(x4),6) "sin",
 round(cos(x4),6) "cos", round(1/x4,6) inv, round(exp(x2),6) "exp", case when x2>0 then round(ln(x2),6) end "log", round(pow(2,x4),6) pow2 from feat""")
def generated(spark, sf):
    a, b = unary_maps(F.col("x2")), unary_maps(F.col("x4"))
    pick = {n: (b if n in ("sin", "cos", "inv", "pow2") else a)[n] for n in a}
    return feature_rows(spark, sf).select("id", *[F.round(c, 6).alias(n) for n, c in pick.items()])


@query("F6_F7_paths", """select url, regexp_extract(url,'([^/.]+)[^/]*$',1) stem, concat_ws('/','data',concat(page_id,'.jpg')) path,
 len(string_split(url,'/')) n from pages""")
def paths(spark, sf):
    u = F.col("url")
    return spark.read.parquet(f"{sf}/pages.parquet").select(
        "url", file_stem(u).alias("stem"), join_path(F.lit("data"), F.concat(F.col("page_id").cast("string"), F.lit(".jpg"))).alias("path"),
        F.size(F.split(u, "/")).cast("long").alias("n"))


@query("F8_integer_truncation", with_sql(TRIALS_SQL) + """select trial, cast(floor(value*1024/depth) as int) height,
 cast(floor(trial/depth) as int) quotient from trials""")
def truncation(spark, sf):
    return trials(spark, sf).select("trial", scaled_height(F.col("value"), F.col("depth"), 1024).alias("height"),
                                    int_div(F.col("trial"), F.col("depth")).alias("quotient"))


@query("F5_ratio_and_root", with_sql(FEAT_SQL) + "select id, round(x1/(x4+0.001),6) ratio, round(sqrt(x1),6) root from feat")
def ratio_root(spark, sf):
    return feature_rows(spark, sf).select("id", F.round(F.col("x1") / (F.col("x4") + 0.001), 6).alias("ratio"),
                                          F.round(F.sqrt("x1"), 6).alias("root"))


# ------------------------------------------------------------------ trials and runs

@query("W3_running_best", with_sql(TRIALS_SQL) + """select study, trial, value, min(value) over (partition by study order by trial
 rows unbounded preceding) best from trials""")
def running_best(spark, sf):
    return lg.optimisation_history(trials(spark, sf)).select("study", "trial", "value", "best")


@query("W4_value_distribution", with_sql(TRIALS_SQL) + """select distinct study, value,
 round(cume_dist() over (partition by study order by value),6) edf from trials""")
def distribution(spark, sf):
    return lg.value_distribution(trials(spark, sf)).withColumn("edf", F.round("edf", 6))


@query("W5_trial_ranks", with_sql(TRIALS_SQL) + "select study, trial, rank() over (partition by study order by value) as rank from trials")
def ranks(spark, sf):
    return lg.trial_ranks(trials(spark, sf)).select("study", "trial", "rank")


@query("W5_parameter_slices", with_sql(TRIALS_SQL) + """select study, trial, 'depth' param, cast(depth as double) setting, value from trials
 union all select study, trial, 'rate', cast(rate as double), value from trials""")
def slices(spark, sf):
    return lg.parameter_slices(trials(spark, sf), ["depth", "rate"])


@query("W5_contour", with_sql(TRIALS_SQL) + "select study, depth, rate, round(avg(value),6) as value from trials group by 1,2,3")
def contour(spark, sf):
    return lg.contour(trials(spark, sf), "depth", "rate").withColumn("value", F.round("value", 6))


@query("W7_trial_durations", with_sql(TRIALS_SQL) + """select concat('run',trial) run_id, cast(depth as double) as "seconds" from trials""")
def durations(spark, sf):
    return lg.durations(ledger_rows(spark, sf))


@query("O3_best_subset_size", with_sql(TRIALS_SQL, SFS_SQL) + "select k, avg_score from sfs order by avg_score desc, k desc limit 1")
def best_size(spark, sf):
    return lg.best_subset_size(sfs_table(spark, sf))


@query("O4_latest_run", with_sql(TRIALS_SQL) + """select concat('run',trial) run_id, cast(epoch_us(ts) as bigint) started from trials
 order by ts desc, concat('run',trial) desc limit 1""")
def latest(spark, sf):
    runs = trials(spark, sf).select(F.concat(F.lit("run"), F.col("trial").cast("string")).alias("run_id"), F.col("ts").alias("start_time"))
    return lg.latest_run(runs).select("run_id", F.expr(
        "timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', start_time)").alias("started"))


@query("O5_best_parameters", with_sql(TRIALS_SQL) + """select study, trial, depth, rate, value from (select *,
 row_number() over (partition by study order by value, trial) r from trials) where r=1""")
def best_params(spark, sf):
    return lg.best_per_group(trials(spark, sf), "study", ["depth", "rate"], "value")


@query("O6_model_comparison", with_sql(TRIALS_SQL) + """select study, round(avg(value),6) "MAE", round(avg(value*value),6) "MSE"
 from trials group by study""")
def compare(spark, sf):
    v = F.col("value")
    long = trials(spark, sf).groupBy("study").agg(F.round(F.avg(v), 6).alias("MAE"), F.round(F.avg(v * v), 6).alias("MSE")).select(
        "study", F.explode(F.create_map(F.lit("MAE"), "MAE", F.lit("MSE"), "MSE")).alias("name", "value"))
    return lg.comparison(long, "study", ["MAE", "MSE"])


@query("O7_importance_listing", with_sql(FEAT_SQL) + "select i, printf('Feature: %d, Score: %.5f', i, c) line from (" + " union all ".join(
    f"select {i} i, abs(corr({c},y)) c from feat" for i, c in enumerate(FEATURE_NAMES)) + ")")
def importances(spark, sf):
    one = feature_rows(spark, sf).agg(F.array(*[F.abs(F.corr(c, "y")) for c in FEATURE_NAMES]).alias("s"))
    return one.select(F.posexplode("s").alias("i", "c")).select("i", F.format_string("Feature: %d, Score: %.5f", "i", "c").alias("line")).orderBy("i")
