"""Detected objects and small helpers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tissueframe.functions import jsonx, scalar
from tissueframe.operators import objects, raster
from workload.imaging import rounded
from workload.views import Data, num, sql

QUERIES: dict = {}
CHECKS: dict = {}


def query(name: str, check: str | None = None):
    def keep(fn):
        QUERIES[name] = lambda spark, folder: fn(Data(spark, folder))
        if check:
            CHECKS[name] = check
        return fn

    return keep


@query("object_rank", sql("objects", "SELECT sample, label, row_number() OVER (PARTITION BY sample ORDER BY area DESC, label) AS rank FROM objects"))
def _(d):
    return objects.rank_first(d.objects, ["sample"], "area", ["label"]).select("sample", "label", "rank")


FG_SQL = "fg AS (SELECT sample, x, y FROM pixels WHERE (r + g + b) / 3 BETWEEN 150 AND 225)"


def fg(d):
    return raster.foreground(raster.detect_scale(d.pixels), 150, 225)


@query("eps_pairs", sql("pixels", f"WITH {FG_SQL} SELECT a.sample, a.x, a.y, b.x AS x2, b.y AS y2 FROM fg a JOIN fg b ON a.sample = b.sample AND b.y BETWEEN a.y - 3 AND a.y + 3 AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 6.25"))
def _(d):
    return objects.eps_pairs(fg(d), 2.5)


@query("neighbour_counts", sql("pixels", f"WITH {FG_SQL} SELECT a.sample, a.x, a.y, 1::BIGINT AS w, count(*) AS n FROM fg a JOIN fg b ON a.sample = b.sample AND b.y BETWEEN a.y - 5 AND a.y + 5 AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 25 GROUP BY 1, 2, 3"))
def _(d):
    return objects.neighbour_counts(fg(d), 5)


# Nuclei on a coarse map of their slide.
def blobs(d):
    x = F.floor(F.col("centroid_x") / 50).cast("int")
    y = F.floor(F.col("centroid_y") / 50).cast("int")
    return d.nuclei.select("sample", x.alias("x"), y.alias("y"))


DBSCAN_SQL = sql("nuclei", """WITH blobs AS (SELECT sample, CAST(floor(centroid_x / 50) AS INT) AS x, CAST(floor(centroid_y / 50) AS INT) AS y FROM nuclei),
    places AS (SELECT sample, x, y, x * 1000 + y AS p, count(*) AS w FROM blobs GROUP BY 1, 2, 3),
    near AS (SELECT a.sample, a.p, b.p AS q, b.w FROM places a JOIN places b ON a.sample = b.sample
             AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 4),
    core AS (SELECT sample, p FROM near GROUP BY 1, 2 HAVING sum(w) >= 4),
    links AS (SELECT n.sample, n.p, n.q FROM near n SEMI JOIN core c ON c.sample = n.sample AND c.p = n.p SEMI JOIN core d ON d.sample = n.sample AND d.p = n.q),
    reach(sample, p, q) AS (SELECT sample, p, p FROM core UNION SELECT r.sample, r.p, l.q FROM reach r JOIN links l ON r.sample = l.sample AND r.q = l.p),
    roots AS (SELECT sample, p, min(q) AS root FROM reach GROUP BY 1, 2),
    cores AS (SELECT sample, p, dense_rank() OVER (PARTITION BY sample ORDER BY root) - 1 AS label FROM roots),
    others AS (SELECT n.sample, n.p, min(c.label) AS label FROM near n LEFT JOIN cores c ON c.sample = n.sample AND c.p = n.q
               ANTI JOIN core k ON k.sample = n.sample AND k.p = n.p GROUP BY 1, 2)
    SELECT sample, x, y, CAST(coalesce(label, -1) AS INT) AS label FROM places JOIN (SELECT * FROM cores UNION ALL SELECT * FROM others) USING (sample, p)""")


@query("dbscan", DBSCAN_SQL.replace("WITH ", "WITH RECURSIVE ", 1))
def _(d):
    return objects.dbscan(blobs(d), eps=2, min_samples=4)


@query("drop_noise", sql("objects", "SELECT sample, label FROM (SELECT sample, label % 5 - 1 AS label FROM objects) WHERE label <> -1"))
def _(d):
    return objects.drop_noise(d.objects.select("sample", (F.col("label") % 5 - 1).alias("label")))


BOX_SQL = f"""pts AS (SELECT sample, CAST(floor(centroid_x / 1000) AS INT) AS label, centroid_x AS x, centroid_y AS y FROM nuclei),
  q AS (SELECT sample, label, quantile_cont(x, {num(0.05)}) AS a0, quantile_cont(x, {num(0.95)}) AS b0, quantile_cont(y, {num(0.05)}) AS a1, quantile_cont(y, {num(0.95)}) AS b1 FROM pts GROUP BY 1, 2),
  wide AS (SELECT sample, label, (a0 - {num(0.35)} * (b0 - a0)) / s.x AS s0, (b0 + {num(0.35)} * (b0 - a0)) / s.x AS e0,
      (a1 - {num(0.25)} * (b1 - a1)) / s.y AS s1, (b1 + {num(0.25)} * (b1 - a1)) / s.y AS e1 FROM q JOIN slides s USING (sample)),
  boxes AS (SELECT sample, label, greatest(s0, 0) AS loc0, CASE WHEN greatest(s0, 0) + (e0 - s0) > 1 THEN 1 - greatest(s0, 0) ELSE e0 - s0 END AS size0,
      greatest(s1, 0) AS loc1, CASE WHEN greatest(s1, 0) + (e1 - s1) > 1 THEN 1 - greatest(s1, 0) ELSE e1 - s1 END AS size1 FROM wide)"""


def boxes(d):
    points = d.nuclei.select(
        "sample", F.floor(F.col("centroid_x") / 1000).cast("int").alias("label"), F.col("centroid_x").alias("x"), F.col("centroid_y").alias("y")
    )
    dims = d.slides.select("sample", F.col("x").alias("width"), F.col("y").alias("height"))
    return objects.object_boxes(points, dims, widen=(0.35, 0.25))


@query("object_boxes", sql("nuclei slides", f"WITH {BOX_SQL} SELECT sample, label, round(loc0, 6) AS loc0, round(size0, 6) AS size0, round(loc1, 6) AS loc1, round(size1, 6) AS size1, round(size0 * size1, 6) AS area, round(size0 * size0, 6) AS area_compat FROM boxes"))
def _(d):
    sized = objects.object_area(boxes(d))
    old = objects.object_area(sized.drop("area"), compat=True).select("sample", "label", F.col("area").alias("area_compat"))
    return rounded(sized.join(old, ["sample", "label"]), "loc0", "size0", "loc1", "size1", "area", "area_compat")


@query("attach_dims", sql("nuclei slides", "SELECT DISTINCT n.sample, cell_type AS label, x AS width, y AS height, CAST(x AS BIGINT) * y AS apx FROM nuclei n JOIN slides s USING (sample)"))
def _(d):
    dims = d.slides.select("sample", F.col("x").alias("width"), F.col("y").alias("height"))
    return objects.attach_dims(d.nuclei.select("sample", F.col("cell_type").alias("label")).distinct(), dims)


@query("exclude_objects", sql("objects", "SELECT sample, label FROM objects WHERE label NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')"))
def _(d):
    listed = d.orders.where("o_orderstatus = 'F'").select(
        F.concat(F.lit("case "), F.col("o_custkey").cast("string")).alias("sample"), F.col("o_orderkey").alias("label")
    )
    return objects.exclude(d.objects.select("sample", "label"), listed)


@query("samplesheet", sql("objects", """SELECT concat(replace(sample, ' ', '_'), '.oid', label) AS sample, '' AS fastq, concat('/slides/', sample, '.tif') AS image,
    '' AS grid, concat('/rois/', sample, '.oid', label, '.json') AS roifile, CAST('0.2526' AS DOUBLE) AS mpp FROM objects"""))
def _(d):
    return objects.build_samplesheet(d.objects, "/slides/", "/rois/", 0.2526)


# The same clusters with every place counted once, then boxes, ranks and sizes.
DETECT_SQL = DBSCAN_SQL.replace("count(*) AS w", "1 AS w").replace(
    "SELECT sample, x, y, CAST(coalesce(label, -1)", ", found AS (SELECT sample, x, y, CAST(coalesce(label, -1)"
) + f"""),
    q AS (SELECT sample, label, quantile_cont(x, {num(0.05)}) AS a0, quantile_cont(x, {num(0.95)}) AS b0, quantile_cont(y, {num(0.05)}) AS a1,
          quantile_cont(y, {num(0.95)}) AS b1 FROM found WHERE label <> -1 GROUP BY 1, 2),
    dims AS (SELECT concat('S', s_suppkey) AS sample, CAST(ceil((2900 + (s_suppkey * 37) % 400) / 50) AS INT) AS width,
             CAST(ceil((3060 + (s_suppkey * 53) % 300) / 50) AS INT) AS height FROM supplier),
    wide AS (SELECT sample, label, width, height, (a0 - {num(0.35)} * (b0 - a0)) / width AS s0, (b0 + {num(0.35)} * (b0 - a0)) / width AS e0,
          (a1 - {num(0.35)} * (b1 - a1)) / height AS s1, (b1 + {num(0.35)} * (b1 - a1)) / height AS e1 FROM q JOIN dims USING (sample)),
    boxes AS (SELECT sample, label, width, height, greatest(s0, 0) AS loc0, CASE WHEN greatest(s0, 0) + (e0 - s0) > 1 THEN 1 - greatest(s0, 0) ELSE e0 - s0 END AS size0,
          greatest(s1, 0) AS loc1, CASE WHEN greatest(s1, 0) + (e1 - s1) > 1 THEN 1 - greatest(s1, 0) ELSE e1 - s1 END AS size1 FROM wide)
    SELECT sample, label, round(loc0, 11) AS loc0, round(size0, 11) AS size0, round(loc1, 11) AS loc1, round(size1, 11) AS size1, round(round(size0 * size1, 12), 6) AS area,
           row_number() OVER (PARTITION BY sample ORDER BY round(size0 * size1, 12) DESC, label) AS rank, width, height, CAST(width AS BIGINT) * height AS apx FROM boxes"""


@query("detect_objects", DETECT_SQL.replace("WITH ", "WITH RECURSIVE ", 1))
def _(d):
    # Nuclei as dark dots of a unit-range thumbnail.
    dots = blobs(d).distinct().select("sample", "x", "y", *[F.lit(0.5).alias(c) for c in "rgb"])
    dims = d.slides.select("sample", F.ceil(F.col("x") / 50).cast("int").alias("width"), F.ceil(F.col("y") / 50).cast("int").alias("height"))
    found = objects.detect_objects(dots, dims, eps=2, min_samples=4)
    # Places are whole numbers over small ones: eleven digits hold no tie that the last bit could turn.
    return rounded(rounded(found, "area"), "loc0", "size0", "loc1", "size1", digits=11)


@query("json_params", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k FROM events")
def _(d):
    params = jsonx.parse_params(F.col("props"))
    return d.events.select("event_id", params["k"].alias("k"))


@query("json_format", "SELECT o_orderkey, concat('{\"status\":\"', o_orderstatus, '\",\"key\":', o_orderkey, '}') AS record FROM orders")
def _(d):
    record = F.struct(F.col("o_orderstatus").alias("status"), F.col("o_orderkey").alias("key"))
    return d.orders.select("o_orderkey", jsonx.format_params(record).alias("record"))


@query("from_path", """SELECT event_id, concat('run', event_id % 7) AS sample, CAST(1 + event_id % 2 AS INT) AS mate,
    CASE WHEN event_id % 3 = 0 THEN 'mouse' WHEN event_id % 3 = 1 THEN 'human' END AS species, concat('x_R', 1 + event_id % 2, '_001') AS name FROM events""")
def _(d):
    e = F.col("event_id")
    kind = F.when(e % 3 == 0, "mouse").when(e % 3 == 1, "human").otherwise("other")
    path = F.concat(F.lit("file:/data/"), kind, F.lit("/sample=run"), (e % 7).cast("string"), F.lit("/x_R"), (1 + e % 2).cast("string"), F.lit("_001.fastq.gz"))
    return d.events.select(
        "event_id", scalar.sample_of_path(path).alias("sample"), scalar.mate_of_path(path).alias("mate"),
        scalar.species_of_path(path).alias("species"), scalar.base_name(path).alias("name"),
    )


@query("distances", sql("nuclei", f"""SELECT sample, ids, (centroid_x - 1450) * (centroid_x - 1450) + (centroid_y - 1530) * (centroid_y - 1530) AS d2,
    round(sqrt((centroid_x - 1450) * (centroid_x - 1450) + (centroid_y - 1530) * (centroid_y - 1530)), 6) AS dist,
    (centroid_x - 1450) * (centroid_x - 1450) + (centroid_y - 1530) * (centroid_y - 1530) < 500 * 500 AS inside FROM nuclei"""))
def _(d):
    x, y = F.col("centroid_x"), F.col("centroid_y")
    cx, cy = F.lit(1450), F.lit(1530)
    return d.nuclei.select(
        "sample", "ids", scalar.squared_distance(x, y, cx, cy).alias("d2"), F.round(scalar.distance(x, y, cx, cy), 6).alias("dist"),
        scalar.in_disk(x - cx, y - cy, F.lit(500)).alias("inside"),
    )
