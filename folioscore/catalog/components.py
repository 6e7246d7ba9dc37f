"""Component-table features: A1-A8, A10, A12, A13, P6, P7, P12, J5, W1."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioscore.catalog import query
from folioscore.operators import shapes as sh
from folioscore.sources.derive import COMP_SQL, WCC_SQL, components, white_components, with_sql
from folioscore.functions import eps_ratio

CHAR = "h between 5 and 20 and w between 2 and 100 and area >= 10"
FS_SQL = f"""fs as materialized (
  select image_id, h fs from (
    select image_id, h, row_number() over (partition by image_id order by count(*) desc, min(label), h) r
    from comp where {CHAR} group by image_id, h) where r=1)"""
COMP_FS_SQL = """cfs as materialized (
  select comp.*, coalesce(fs,0) fs from comp left join fs using (image_id))"""
WCC_FS_SQL = """wfs as materialized (
  select wcc.*, coalesce(fs,0) fs from wcc left join fs using (image_id))"""
COMP_FS = with_sql(COMP_SQL, FS_SQL, COMP_FS_SQL)
WCC_FS = with_sql(COMP_SQL, WCC_SQL, FS_SQL, WCC_FS_SQL)
STROKE = "0.5*(w+h)+sqrt(greatest(0.125*(w+h)*(w+h)-area/2,0))"


def ink_fs(spark, sf):
    ink = sh.shape_table(components(spark, sf))
    return sh.with_font_size(ink, sh.font_size(ink))


def white_fs(spark, sf):
    ink = sh.shape_table(components(spark, sf))
    return sh.with_font_size(sh.shape_table(white_components(spark, sf)), sh.font_size(ink))


def per_page(df, **cols):
    return df.groupBy("image_id").agg(*[c.alias(n) for n, c in cols.items()])


def ratio_sql(source: str, num: str, den: str, name: str, guard: bool = True) -> str:
    head = COMP_FS if source == "cfs" else WCC_FS
    expr = f"count(*) filter ({num})/(count(*) filter ({den})+0.001)" if guard else \
        f"cast(count(*) filter ({num}) as double)/nullif(count(*) filter ({den}),0)"
    return head + f"select image_id, round({expr},6) {name} from {source} group by image_id"


SSF = ("area>=5 and area<fs", "area>=5 and area<fs*fs")
_TCF = "area>3*fs and h>0.75*fs and h<2*fs"
TCF = (f"{_TCF} and h/w<0.75", _TCF)
WSF = ("h<3 and w<3", "true")
SWS = ("area>1 and area<0.02*fs*fs", "area>1 and area<fs*fs")


@query("P6_filter_characters", with_sql(COMP_SQL) + f"select image_id,label,h,w,area from comp where {CHAR}")
def filter_characters(spark, sf):
    return sh.filter_characters(components(spark, sf))


@query("P7_drop_null_components", with_sql(COMP_SQL) + """select image_id,label,h,w,area from comp
 where h is not null and w is not null and area is not null""")
def drop_null(spark, sf):
    return components(spark, sf).dropna()


@query("P12_area_range_count", with_sql(COMP_SQL) + """select image_id,
 count(*) filter (area>6 and area<=100) n_100, count(*) filter (area>6 and area<=400) n_400
 from comp group by image_id""")
def area_range(spark, sf):
    area = F.col("area")
    return per_page(components(spark, sf), n_100=F.count_if((area > 6) & (area <= 100)),
                    n_400=F.count_if((area > 6) & (area <= 400)))


@query("A1_font_size", with_sql(COMP_SQL, FS_SQL) + "select image_id, fs from fs")
def font_size(spark, sf):
    return sh.font_size(sh.shape_table(components(spark, sf)))


@query("A1b_font_size_median", with_sql(COMP_SQL) + f"""select image_id, quantile_cont(h,0.5) fs
 from comp where {CHAR} group by image_id""")
def font_size_median(spark, sf):
    return sh.font_size_median(sh.shape_table(components(spark, sf)))


@query("W1_height_mode_first_seen", with_sql(COMP_SQL) + """select image_id, h mode_h, n from (
 select image_id, h, count(*) n,
  row_number() over (partition by image_id order by count(*) desc, min(label), h) r
 from comp group by image_id, h) where r=1""")
def height_mode(spark, sf):
    per_h = components(spark, sf).groupBy("image_id", "h").agg(
        F.count(F.lit(1)).alias("n"), F.min("label").alias("first"))
    best = F.max(F.struct("n", (-F.col("first")).alias("a"), (-F.col("h")).alias("b")))
    return per_h.groupBy("image_id").agg(best.alias("m")).select(
        "image_id", (-F.col("m.b")).alias("mode_h"), F.col("m.n").alias("n"))


@query("J5_font_size_back_join", with_sql(COMP_SQL, FS_SQL, COMP_FS_SQL) + """select image_id,
 label, h, w, area, fs from cfs""")
def font_size_join(spark, sf):
    comp = components(spark, sf)
    return sh.with_font_size(comp, sh.font_size(sh.shape_table(comp)))


@query("A2_small_speckle_factor", ratio_sql("cfs", *SSF, "ssf"))
def small_speckle(spark, sf):
    return per_page(ink_fs(spark, sf), ssf=F.round(eps_ratio(*sh.speckle_parts()), 6))


@query("A3_touching_character_factor", ratio_sql("cfs", *TCF, "tcf"))
def touching(spark, sf):
    return per_page(ink_fs(spark, sf), tcf=F.round(eps_ratio(*sh.touching_parts()), 6))


@query("A4_white_speckle_factor", ratio_sql("wfs", *WSF, "wsf"))
def white_speckle(spark, sf):
    return per_page(sh.shape_table(white_components(spark, sf)),
                    wsf=F.round(eps_ratio(*sh.white_speckle_parts()), 6))


@query("A5_small_white_speckle", ratio_sql("wfs", *SWS, "sws"))
def small_white(spark, sf):
    return per_page(white_fs(spark, sf), sws=F.round(eps_ratio(*sh.small_white_parts()), 6))


@query("A2b_small_speckle_plain", ratio_sql("cfs", *SSF, "ssf", guard=False))
def small_speckle_plain(spark, sf):
    return per_page(ink_fs(spark, sf), ssf=F.round(F.try_divide(*sh.speckle_parts()), 6))


@query("A3b_touching_character_plain", ratio_sql("cfs", *TCF, "tcf", guard=False))
def touching_plain(spark, sf):
    return per_page(ink_fs(spark, sf), tcf=F.round(F.try_divide(*sh.touching_parts()), 6))


@query("A4b_white_speckle_plain", ratio_sql("wfs", "h<fs and w<fs", "true", "wsf", guard=False))
def white_speckle_plain(spark, sf):
    return per_page(white_fs(spark, sf),
                    wsf=F.round(F.try_divide(*sh.white_speckle_parts(F.col("fs"))), 6))


@query("A6_stroke_width", with_sql(COMP_SQL) + f"""select image_id, round(avg({STROKE}),6) sw_1,
 round(coalesce(stddev_samp({STROKE}),0),6) sw_2 from comp group by image_id""")
def stroke_width(spark, sf):
    mean, sd = sh.stroke_stats(sample=True)
    return per_page(sh.shape_table(components(spark, sf)), sw_1=F.round(mean, 6),
                    sw_2=F.round(F.coalesce(sd, F.lit(0.0)), 6))


@query("A6b_stroke_width_characters", with_sql(COMP_SQL) + f"""select image_id, round(avg({STROKE}),6) sw_1,
 round(stddev_pop({STROKE}),6) sw_2 from comp where {CHAR} group by image_id""")
def stroke_width_chars(spark, sf):
    mean, sd = sh.stroke_stats(sample=False)
    chars = sh.filter_characters(components(spark, sf))
    return per_page(sh.shape_table(chars), sw_1=F.round(mean, 6), sw_2=F.round(sd, 6))


@query("A7_height_width_ratio", with_sql(COMP_SQL) + f"""select image_id,
 round(coalesce(avg(h/w) filter ({CHAR}),0),6) height_width_ratio from comp group by image_id""")
def height_width(spark, sf):
    return per_page(sh.shape_table(components(spark, sf)), height_width_ratio=F.round(
        F.coalesce(sh.mean_height_width(sh.is_character()), F.lit(0.0)), 6))


@query("A8_characters_to_cc_ratio", with_sql(COMP_SQL) + f"""select image_id,
 round(count(*) filter ({CHAR})/(count(*)+0.001),6) characters_to_cc_ratio from comp group by image_id""")
def characters_to_cc(spark, sf):
    return per_page(sh.shape_table(components(spark, sf)), characters_to_cc_ratio=F.round(
        eps_ratio(sh.count(sh.is_character()), F.sum("n")), 6))


@query("A10_broken_character_factor", COMP_FS + """select image_id,
 count(distinct h*1000+w)/(fs*fs) broken_character_factor from cfs
 where h<0.75*fs and w<0.75*fs group by image_id, fs""")
def broken_characters(spark, sf):
    return sh.distinct_small_shapes(ink_fs(spark, sf))


@query("A12_height_histogram", with_sql(COMP_SQL) + f""", chars as (
 select image_id, h, min(h) over (partition by image_id) lo, max(h) over (partition by image_id) hi
 from comp where {CHAR})
 select image_id, cast(case when hi=lo then 5 else least(floor((h-lo)*10/(hi-lo)),9) end as int) bin,
 count(*) n from chars group by 1,2""")
def height_histogram(spark, sf):
    return sh.height_histogram(sh.filter_characters(components(spark, sf)))


@query("A13_component_bundle", with_sql(COMP_SQL, WCC_SQL, FS_SQL, COMP_FS_SQL, WCC_FS_SQL) + f"""
 select image_id, cast(cc_FS as double) cc_FS, round(cc_SSF,6) cc_SSF, round(cc_TCF,6) cc_TCF,
  round(cc_WSF,6) cc_WSF, round(cc_SWS,6) cc_SWS, round(cc_SW_1,6) cc_SW_1, round(cc_SW_2,6) cc_SW_2,
  round(hw,6) cc_height_width_ratio, round(cr,6) cc_characters_to_cc_ratio
 from (select image_id, max(fs) cc_FS,
   count(*) filter ({SSF[0]})/(count(*) filter ({SSF[1]})+0.001) cc_SSF,
   count(*) filter ({TCF[0]})/(count(*) filter ({TCF[1]})+0.001) cc_TCF,
   avg({STROKE}) cc_SW_1, coalesce(stddev_samp({STROKE}),0) cc_SW_2,
   coalesce(avg(h/w) filter ({CHAR}),0) hw, count(*) filter ({CHAR})/(count(*)+0.001) cr
  from cfs group by image_id)
 full join (select image_id, count(*) filter ({WSF[0]})/(count(*)+0.001) cc_WSF,
   count(*) filter ({SWS[0]})/(count(*) filter ({SWS[1]})+0.001) cc_SWS from wfs group by image_id)
 using (image_id)""")
def component_bundle(spark, sf):
    b = sh.component_bundle(components(spark, sf), white_components(spark, sf))
    return b.select("image_id", *[F.round(c, 6).alias(c) for c in b.columns if c != "image_id"])
