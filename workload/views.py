"""The given tables seen as tissue data.

Every view is one SQL text that both engines run, so a query and its check
start from the same rows. A view covers its whole table.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

VIEWS = {
    # One slide per supplier.
    "slides": """
        SELECT concat('S', s_suppkey) AS sample,
               CAST(2900 + (s_suppkey * 37) % 400 AS INT) AS x,
               CAST(3060 + (s_suppkey * 53) % 300 AS INT) AS y,
               CAST(20 + s_suppkey % 10 AS DOUBLE) / 100 AS mpp
        FROM {supplier}""",
    # One nucleus per event, on the first ten slides.
    "nuclei": """
        SELECT concat('S', user_id % 10) AS sample,
               concat('', event_id) AS ids,
               CAST((event_id * 7919) % 2900 AS INT) AS centroid_x,
               CAST((event_id * 104729) % 3060 AS INT) AS centroid_y,
               CASE event_type WHEN 'signup' THEN 'neoplasia' WHEN 'view' THEN 'inflammatory'
                    WHEN 'click' THEN 'connective' WHEN 'purchase' THEN 'necrosis'
                    ELSE 'no_neoplasia' END AS cell_type,
               CAST((event_id * 37) % 101 AS DOUBLE) / 100 AS cell_type_prob,
               value * 2 AS perimeter_length,
               value * CAST('0.7390851332151607' AS DOUBLE) AS area,
               CAST(event_id % 180 AS DOUBLE) - 90 AS orientation,
               CAST(event_id % 97 AS DOUBLE) / 97 AS eccentricity
        FROM {events}""",
    # One pixel per order: thumbnails of 100 x 100.
    "pixels": """
        SELECT concat('T', CAST(floor(o_orderkey / 10000) AS INT)) AS sample,
               CAST(o_orderkey % 100 AS INT) AS x,
               CAST(floor((o_orderkey % 10000) / 100) AS INT) AS y,
               CAST(60 + (o_custkey * 13 + o_orderkey) % 196 AS INT) AS r,
               CAST(floor(o_totalprice) % 200 AS INT) AS g,
               CAST(90 + (o_orderkey * 31 + o_custkey) % 160 AS INT) AS b
        FROM {orders}""",
    # Nuclei raster and superpixel raster over the same thumbnails.
    "raster": """
        SELECT sample, x, y,
               CAST(CASE WHEN x % 10 BETWEEN 2 AND 6 AND y % 8 BETWEEN 1 AND 5
                         THEN 1 + floor(x / 10) + 10 * floor(y / 8) ELSE 0 END AS INT) AS label
        FROM pixels""",
    "segments": """
        SELECT sample, x, y, CAST(floor(x / 7) + 20 * floor(y / 9) AS INT) AS label FROM pixels""",
    "thumbs": """
        SELECT sample, CAST(100 AS INT) AS width, CAST(100 AS INT) AS height
        FROM pixels GROUP BY sample""",
    # Gene counts per spot.
    "matrix": """
        SELECT concat('M', l_linenumber % 3) AS sample,
               CASE WHEN l_returnflag = 'A' THEN 'mouse' ELSE 'human' END AS species,
               concat('B', l_suppkey) AS barcode,
               concat(l_returnflag, '-', l_partkey) AS gene_id,
               CAST(sum(l_quantity) AS INT) AS count
        FROM {lineitem}
        GROUP BY l_linenumber % 3, CASE WHEN l_returnflag = 'A' THEN 'mouse' ELSE 'human' END,
                 l_suppkey, l_returnflag, l_partkey""",
    # Alignments with four CIGAR shapes; documents serve as contigs of two genomes.
    "alignments": """
        SELECT concat('A', l_linenumber % 2) AS sample,
               CASE WHEN l_linestatus = 'F' THEN 'mouse' ELSE 'human' END AS species,
               concat(l_orderkey, '-', l_linenumber) AS read_id,
               concat('d', l_suppkey) AS chrom,
               CAST(1 + l_partkey % 100 AS BIGINT) AS pos,
               CAST(l_quantity AS INT) AS mapq,
               CASE l_linenumber % 4 WHEN 0 THEN '2M1D2M' WHEN 1 THEN '1S3M1I' WHEN 2 THEN '2M3N3M' ELSE '5M' END AS cigar,
               concat(l_returnflag, l_linestatus, 'ACG') AS seq,
               CASE WHEN l_tax < CAST('0.03' AS DOUBLE) THEN 'I5I5I' ELSE 'IIIII' END AS qual,
               concat('B', l_suppkey) AS cb,
               concat('U', l_orderkey) AS ub,
               concat('G', l_partkey) AS gene_id
        FROM {lineitem}""",
    # Two mates per read pair, whole texts; passages as two genomes that share some.
    "reads": """
        SELECT concat('L', CAST(floor(doc_id / 2) AS BIGINT) % 4) AS sample,
               concat('r', CAST(floor(doc_id / 2) AS BIGINT)) AS read_id,
               CAST(1 + doc_id % 2 AS INT) AS mate,
               text AS seq
        FROM {documents}""",
    "genomes": """
        SELECT CASE WHEN item_id % 5 IN (0, 2) THEN 'host' ELSE 'graft' END AS species,
               concat('c', item_id) AS name, text AS seq
        FROM {benchmark}
        UNION ALL
        SELECT 'host' AS species, concat('b', item_id) AS name, text AS seq
        FROM {benchmark} WHERE item_id % 5 = 4""",
    # Feature vectors of tiles.
    "vectors": """
        SELECT concat('E', label % 2) AS sample, vec_id AS tile, label, embedding AS features
        FROM {embeddings}""",
    # Detected objects, one per order.
    "objects": """
        SELECT concat('case ', o_custkey) AS sample, o_orderkey AS label, o_totalprice AS area
        FROM {orders}""",
}

NEEDS = {"raster": ("pixels",), "segments": ("pixels",), "thumbs": ("pixels",)}


class Data:
    """The tables of one folder and the views over them, read when asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._seen: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._seen:
            self._seen[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._seen[name]

    def view(self, name: str) -> DataFrame:
        if name not in self._seen:
            self._seen[name] = self._make(name)
        return self._seen[name]

    def _make(self, name: str) -> DataFrame:
        tables = {t: self.table(t) for t in TABLES if "{" + t + "}" in VIEWS[name]}
        text = VIEWS[name]
        for base in NEEDS.get(name, ()):
            text = text.replace(f"FROM {base}", "FROM {" + base + "}")
            tables[base] = self.view(base)
        return self.spark.sql(text, **tables)

    def __getattr__(self, name: str) -> DataFrame:
        if name in VIEWS:
            return self.view(name)
        if name in TABLES:
            return self.table(name)
        raise AttributeError(name)

    @cached_property
    def contigs(self) -> DataFrame:
        from pyspark.sql import functions as F

        both = F.explode(F.array(
            F.struct(F.lit("human").alias("species"), F.col("text").alias("seq")),
            F.struct(F.lit("mouse").alias("species"), F.reverse("text").alias("seq")),
        ))
        named = self.documents.select(F.concat(F.lit("d"), "doc_id").alias("name"), F.lit(0).cast("long").alias("offset"), both.alias("_c"))
        return named.select("_c.species", "name", "offset", "_c.seq")


def sql(views: str, body: str) -> str:
    """SQL text with the named views in front. ``views`` is blank separated."""
    names: list[str] = []
    for name in views.split():
        for wanted in (*NEEDS.get(name, ()), name):
            if wanted not in names:
                names.append(wanted)
    plain = {t: t for t in TABLES}
    parts = [f"{n} AS ({VIEWS[n].format(**plain)})" for n in names]
    text = body.strip()
    if text.upper().startswith("WITH "):
        return "WITH " + ", ".join(parts + [text[5:]])
    return ("WITH " + ", ".join(parts) + " " if parts else "") + text


def num(value: float) -> str:
    """A double literal that both engines read exactly."""
    return f"CAST('{value!r}' AS DOUBLE)"
