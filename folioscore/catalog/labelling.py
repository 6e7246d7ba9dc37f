"""Runs, labelling and what depends on labels: C1-C6, J3, J8, A9, A11, W6."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioscore.catalog import query
from folioscore.operators import components as cc, shapes as sh, stencil as st
from folioscore.sources.derive import GRAY_SQL, PAGE_SQL, gray_rows, page_rows, with_sql


def gray_ink(spark, sf):
    """Embedding pages thresholded at 128."""
    return gray_rows(spark, sf).select("image_id", "y", "px", F.transform(
        "px", lambda v: F.when(v >= 128, F.lit(255)).otherwise(F.lit(0))).alias("ink"))


def gray_binary(spark, sf):
    return gray_ink(spark, sf).select("image_id", "y", F.col("ink").alias("px"))


GRAY_BIN = "bin as materialized (select image_id,y,x,v g, case when v>=128 then 255 else 0 end v from gray)"


def runs_sql(src: str) -> str:
    return f"""marks as (select image_id,y,x, x-row_number() over (partition by image_id,y order by x) k
    from {src} where v>0),
 runs as materialized (select image_id,y,min(x) x0,max(x) x1 from marks group by image_id,y,k)"""


def labels_sql(src: str) -> str:
    """Minimum-propagation over run overlaps; the root is the first pixel in raster order."""
    return runs_sql(src) + """,
 rr as materialized (select *, row_number() over (order by image_id,y,x0) id from runs),
 ed as materialized (select a.id u, b.id v from rr a join rr b on a.image_id=b.image_id and b.y=a.y+1
    and a.x0<=b.x1 and b.x0<=a.x1),
 ed2 as materialized (select u,v from ed union all select v,u from ed),
 prop(id,root) using key (id) as (select id, id root from rr union
    select c.id, min(c.root) from (
      select ed2.v id, p.root from prop p join ed2 on ed2.u=p.id union all
      select r.id, p.root from prop p join recurring.prop r on r.root=p.id) c
    join recurring.prop o on o.id=c.id where c.root<o.root group by c.id),
 lab as materialized (select rr.*, prop.root from rr join prop using (id)),
 stat as materialized (select image_id, root, min(x0) x, min(y) y, max(x1)-min(x0)+1 w, max(y)-min(y)+1 h,
    sum(x1-x0+1)::bigint area from lab group by 1,2),
 comp as materialized (select *, row_number() over (partition by image_id order by root) as label from stat)"""


COLS = "image_id,label,x,y,w,h,area"
COMPS = labels_sql("bin")


def table(rows):
    return cc.numbered_components(rows).select(*COLS.split(","))


@query("C1_runs", with_sql(PAGE_SQL, runs_sql("page")) + """select image_id, count(*) runs, sum(x1-x0+1)::bigint ink,
 sum(x0*(y+1))::bigint starts, max(x1-x0+1) longest from runs group by image_id""")
def runs(spark, sf):
    length = F.col("x1") - F.col("x0") + 1
    return cc.runs(page_rows(spark, sf)).groupBy("image_id").agg(
        F.count(F.lit(1)).alias("runs"), F.sum(length).alias("ink"),
        F.sum(F.col("x0") * (F.col("y") + 1)).alias("starts"), F.max(length).alias("longest"))


@query("C2_label_pixels", with_sql(GRAY_SQL, GRAY_BIN, COMPS) + """select image_id,
 lab.y, unnest(range(lab.x0,lab.x1+1))::int x, label from lab join comp using (image_id,root)""")
def label_pixels(spark, sf):
    comp, labelled = cc.connected_components(gray_binary(spark, sf))
    return cc.label_pixels(labelled, comp)


@query("C3_component_stats", with_sql(GRAY_SQL, GRAY_BIN, COMPS) + f"select {COLS} from comp")
def component_stats(spark, sf):
    return table(gray_binary(spark, sf))


@query("C4_ink_components", with_sql(PAGE_SQL, labels_sql("page")) + f"select {COLS} from comp")
def ink_components(spark, sf):
    return table(page_rows(spark, sf))


@query("C5_white_components", with_sql(
    PAGE_SQL, "inv as materialized (select image_id,y,x,255-v v from page)", labels_sql("inv"))
    + f"select {COLS} from comp")
def white_components(spark, sf):
    return table(page_rows(spark, sf).withColumn("px", st.invert(F.col("px"))))


_KEPT = "w between 2 and 8 and h between 2 and 8 and area>=4"


@query("J3_C6_keep_character_labels", with_sql(GRAY_SQL, GRAY_BIN, COMPS) + f"""select image_id,
 lab.y, unnest(range(lab.x0,lab.x1+1))::int x, case when {_KEPT.replace('h ', 'comp.h ')} then label else 0 end as label
 from lab join comp using (image_id,root)""")
def keep_labels(spark, sf):
    comp, labelled = cc.connected_components(gray_binary(spark, sf))
    chars = sh.filter_characters(comp, min_height=2, max_height=8, min_width=2, max_width=8)
    kept = cc.keep_components(labelled, chars).select("image_id", "root", "y", "x0", "label")
    out = labelled.join(kept, ["image_id", "root", "y", "x0"], "left")
    return out.select("image_id", "y", F.explode(F.sequence("x0", "x1")).alias("x"),
                      F.coalesce("label", F.lit(0)).alias("label"))


@query("J8_pages_without_components", with_sql(PAGE_SQL, runs_sql("page")) + """select p.image_id,
 coalesce(n,0) runs from (select distinct image_id from page) p left join
 (select image_id, count(*) n from runs group by 1) r on p.image_id=r.image_id""")
def completion(spark, sf):
    rows = page_rows(spark, sf)
    found = cc.runs(rows).groupBy("image_id").agg(F.count(F.lit(1)).alias("n"))
    pages = rows.select("image_id").distinct()
    return pages.join(found, "image_id", "left").select("image_id", F.coalesce("n", F.lit(0)).alias("runs"))


@query("A9_stability_of_cc_values", with_sql(GRAY_SQL, GRAY_BIN, COMPS) + """, px as (
  select b.image_id, b.g, coalesce(comp.label,0) as label from bin b
  left join lab on lab.image_id=b.image_id and lab.y=b.y and b.x between lab.x0 and lab.x1
  left join comp on comp.image_id=lab.image_id and comp.root=lab.root),
 top as (select image_id, max(label) m from px group by 1),
 per as (select image_id, px.label, max(g) hi, min(g) lo from px join top using (image_id) where px.label<m group by 1,2)
 select image_id, round(coalesce(stddev_pop(hi),0),6) stability_1, round(coalesce(stddev_pop(lo),0),6) stability_2
 from top left join (select * from per where hi>0) using (image_id) group by image_id""")
def stability(spark, sf):
    rows = gray_ink(spark, sf)
    comp, labelled = cc.connected_components(rows.select("image_id", "y", F.col("ink").alias("px")))
    s = cc.stability(rows.select("image_id", "y", "px"), labelled, comp)
    return s.select("image_id", *[F.round(c, 6).alias(c) for c in ("stability_1", "stability_2")])


VRUNS = """marks as (select image_id,y,x, y-row_number() over (partition by image_id,x order by y) k from page where v>0),
 vruns as materialized (select image_id, count(*) length from marks group by image_id,x,k)"""


@query("W6_vertical_runs", with_sql(PAGE_SQL, VRUNS) + "select image_id, length, count(*) n from vruns group by 1,2")
def vertical_runs(spark, sf):
    return cc.vertical_runs(page_rows(spark, sf)).withColumn("length", F.col("length").cast("long"))


@query("A11_stroke_thickness_factor", with_sql(PAGE_SQL, VRUNS) + """select image_id, length stroke_thickness from
 (select image_id, length, row_number() over (partition by image_id order by count(*) desc, length) r
  from vruns group by 1,2) where r=1""")
def stroke_thickness(spark, sf):
    s = cc.stroke_thickness(page_rows(spark, sf))
    return s.withColumn("stroke_thickness", F.col("stroke_thickness").cast("long"))
