"""Page geometry: G1-G6."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from folioscore.catalog import query
from folioscore.catalog.labelling import COMPS, GRAY_BIN, gray_binary, labels_sql
from folioscore.operators import bands as bd, components as cc, geometry as geo, stencil as st
from folioscore.operators.bands import lines_of
from folioscore.sources.derive import GRAY_SQL, PAGE_SQL, TEXT_GRAY_SQL, gray_rows, page_rows, text_gray_rows, with_sql

SIZES = "sizes as materialized (select image_id, max(y)+1 h, max(x)+1 w from {src} group by 1)"


def row_sums(rows):
    """Per scanline: sum and position-weighted sum of the values."""
    def run(batches):
        for batch in batches:
            values, offsets = lines_of(pa.chunked_array([batch.column(2)]))
            place = np.arange(len(values)) - np.repeat(offsets[:-1], np.diff(offsets)) + 1

            def sums(v: np.ndarray) -> pa.Array:
                total = np.concatenate(([0], np.cumsum(v, dtype=np.int64)))
                return pa.array(total[offsets[1:]] - total[offsets[:-1]])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), sums(values), sums(values * place)], ["image_id", "y", "total", "weighted"])
    key = rows.schema["image_id"].dataType.simpleString()
    place = rows.schema["y"].dataType.simpleString()
    return rows.select("image_id", "y", F.col("px").cast("array<long>")).mapInArrow(run, f"image_id {key}, y {place}, total long, weighted long")


ROW_SUMS = "select image_id, y, sum(v)::bigint total, sum(v*(x+1))::bigint weighted from {src} group by 1,2"


@query("G1_rotate_landscape", with_sql(TEXT_GRAY_SQL, SIZES.format(src="tgray")) + """, turned as (select image_id,
 case when w>h then x else y end y, case when w>h then h-1-y else x end x, v from tgray join sizes using (image_id))"""
 + ROW_SUMS.format(src="turned"))
def rotate(spark, sf):
    return row_sums(geo.rotate_landscape(text_gray_rows(spark, sf)))


@query("G2_colour_to_gray", with_sql(TEXT_GRAY_SQL) + """, g as (select image_id,y,x,
 cast(floor(v*0.114::double+((v*3)%256)*0.587::double+((v+x)%256)*0.299::double+0.5) as int) v from tgray)""" + ROW_SUMS.format(src="g"))
def gray(spark, sf):
    rows = text_gray_rows(spark, sf)
    green = F.transform("px", lambda v: v * 3 % 256)
    red = F.transform("px", lambda v, i: (v + i) % 256)
    return row_sums(rows.select("image_id", "y", geo.to_gray(F.col("px"), green, red).alias("px")))


@query("G3_resize", with_sql(TEXT_GRAY_SQL, SIZES.format(src="tgray")) + """, grid as (
  select image_id, h, w, ty, tx, (ty+0.5)*h/(h*24//w)-0.5 sy, (tx+0.5)*w/24-0.5 sx from
   (select image_id, h, w, ty, unnest(range(0,24)) tx from (select image_id, h, w, unnest(range(0,h*24//w)) ty from sizes))),
 pos_ as (select *, cast(greatest(0,least(floor(sy),h-1)) as int) y0, cast(greatest(0,least(floor(sx),w-1)) as int) x0 from grid),
 fr as (select *, case when sy<0 or y0>=h-1 then 0.0::double else sy-floor(sy) end fy,
   case when sx<0 or x0>=w-1 then 0.0::double else sx-floor(sx) end fx, least(y0+1,h-1) y1, least(x0+1,w-1) x1 from pos_),
 res as (select fr.image_id, ty y, tx x, cast(floor((a.v*(1-fx)+b.v*fx)*(1-fy)+(c.v*(1-fx)+d.v*fx)*fy+0.5) as int) v from fr
   join tgray a on a.image_id=fr.image_id and a.y=y0 and a.x=x0 join tgray b on b.image_id=fr.image_id and b.y=y0 and b.x=x1
   join tgray c on c.image_id=fr.image_id and c.y=y1 and c.x=x0 join tgray d on d.image_id=fr.image_id and d.y=y1 and d.x=x1)
 select image_id, cast(y as int) y, sum(v)::bigint total, sum(v*(x+1))::bigint weighted from res group by 1,2""")
def resize(spark, sf):
    return row_sums(geo.resize(text_gray_rows(spark, sf), 24))


@query("G4_O1_O2_find_page", with_sql(PAGE_SQL, "inv as materialized (select image_id,y,x,255-v v from page)",
                                      labels_sql("inv"), SIZES.format(src="page")) + """
 select image_id, x, y, w, h, area from (select c.*, row_number() over (partition by image_id order by area desc, root) r
  from comp c join sizes s using (image_id) where (c.w<s.w-20 or c.h<s.h-20) and area>=0.5*c.w*c.h) where r=1""")
def find_page(spark, sf):
    rows = page_rows(spark, sf)
    comp = cc.component_table(rows.withColumn("px", st.invert(F.col("px"))))
    return geo.find_page(comp, geo.page_sizes(rows)).drop("root")


CORNERS = """ends as (select image_id, root, y, unnest([x0,x1]) x from lab),
 quad as materialized (select image_id, root, arg_min(x,((x+y)*1000+y)*1000+x) tlx, arg_min(y,((x+y)*1000+y)*1000+x) tly,
   arg_min(x,((y-x)*1000+y)*1000+x) trx, arg_min(y,((y-x)*1000+y)*1000+x) try_,
   arg_max(x,((x+y)*1000-y)*1000-x) brx, arg_max(y,((x+y)*1000-y)*1000-x) bry,
   arg_max(x,((y-x)*1000-y)*1000-x) blx, arg_max(y,((y-x)*1000-y)*1000-x) bly from ends group by 1,2)"""


@query("G5_order_points", with_sql(GRAY_SQL, GRAY_BIN, COMPS, CORNERS) + """select image_id, label,
 tlx, tly, trx, try_, brx, bry, blx, bly from quad join comp using (image_id, root)""")
def order_points(spark, sf):
    comp, labelled = cc.connected_components(gray_binary(spark, sf))
    q = geo.corners(labelled).join(comp.select("image_id", "root", "label"), ["image_id", "root"])
    names = {"tlx": "tl.x", "tly": "tl.y", "trx": "tr.x", "try_": "tr.y", "brx": "br.x", "bry": "br.y", "blx": "bl.x", "bly": "bl.y"}
    return q.select("image_id", "label", *[F.col(c).alias(n) for n, c in names.items()])


_MAPS = """big as (select image_id, root from (select *, row_number() over (partition by image_id order by area desc, root) r from comp) where r=1),
 d as (select image_id, tlx::double x0, tly::double y0, trx::double x1, try_::double y1, brx::double x2, bry::double y2,
   blx::double x3, bly::double y3, x1-x2 dx1, x3-x2 dx2, x0-x1+x2-x3 dx3, y1-y2 dy1, y3-y2 dy2, y0-y1+y2-y3 dy3 from quad join big using (image_id,root)),
 g as (select *, (dx3*dy2-dx2*dy3)/(dx1*dy2-dx2*dy1) hg, (dx1*dy3-dx3*dy1)/(dx1*dy2-dx2*dy1) hh from d where dx1*dy2-dx2*dy1<>0),
 maps as materialized (select image_id, x1-x0+hg*x1 ha, x3-x0+hh*x3 hb, x0 hc, y1-y0+hg*y1 hd, y3-y0+hh*y3 he, y0 hf, hg, hh from g),
 dst as (select image_id, y ty, x tx, (ha*(x/8)+hb*(y/8)+hc)/(hg*(x/8)+hh*(y/8)+1) sx, (hd*(x/8)+he*(y/8)+hf)/(hg*(x/8)+hh*(y/8)+1) sy
   from gray join maps using (image_id)),
 fl as (select *, cast(floor(sy) as int) y0, cast(floor(sx) as int) x0, sx-floor(sx) fx, sy-floor(sy) fy from dst),
 warped as (select fl.image_id, ty y, tx x, cast(floor((coalesce(a.v,0)*(1-fx)+coalesce(b.v,0)*fx)*(1-fy)+(coalesce(c.v,0)*(1-fx)+coalesce(e.v,0)*fx)*fy+0.5) as int) v from fl
   left join gray a on a.image_id=fl.image_id and a.y=y0 and a.x=x0 left join gray b on b.image_id=fl.image_id and b.y=y0 and b.x=x0+1
   left join gray c on c.image_id=fl.image_id and c.y=y0+1 and c.x=x0 left join gray e on e.image_id=fl.image_id and e.y=y0+1 and e.x=x0+1)"""


@query("G6_straighten", with_sql(GRAY_SQL, GRAY_BIN, COMPS, CORNERS, _MAPS) + """select image_id,y,x,v from warped
 union all select image_id,y,x,v from gray anti join maps using (image_id)""")
def straighten(spark, sf):
    comp, labelled = cc.connected_components(gray_binary(spark, sf))
    biggest = F.max_by("root", F.struct("area", (-F.col("root")).alias("r")))
    page = comp.groupBy("image_id").agg(biggest.alias("root"))
    quads = geo.corners(labelled.join(page, ["image_id", "root"])).drop("root")
    return bd.pixels(geo.straighten(gray_rows(spark, sf), quads)).select("image_id", "y", "x", "v")
