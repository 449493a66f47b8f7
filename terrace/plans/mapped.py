"""A map's elements derived from the driver's tables, and what they are assembled to."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.operators import extraction
from terrace.operators.entities import Rule
from terrace.sources import layers, mapfile

RULES = [
    Rule("school", "education", [{"amenity": ["school"]}]),
    Rule("attraction_culture", "leisure", [{"tourism": ["attraction", "museum"]}]),
    Rule("park_recreation", "leisure", [{"leisure": ["park", "playground"]}]),
]
AREAS = [Rule("industrial_site", "area", [{"landuse": ["industrial"]}]), Rule("park_area", "area", [{"leisure": ["park"]}])]


def elements(spark: SparkSession, d: str) -> DataFrame:
    """A square of four nodes for every part, and within it one of four more; what they are to be follows from the part's number.

    By its rest to 8: 0 a park; 1 an open attraction; 2 an open industrial way; 3 an industrial relation of two halves and a hole;
    4 the same with a half missing; 5 a site of two nodes, one tagged like it; 6 a park that is no area; 7 a school and a road.
    """
    p = F.col("p")
    parts = layers.read(spark, d, "part").select(F.col("p_partkey").cast("long").alias("p"))
    base = parts.withColumns({"x": (p * 7919 % 18_000).cast("double"), "y": (p * 104_729 % 18_000).cast("double"), "s": (p % 7 * 50 + 100).cast("double")})
    case, at = p % 8, lambda *k: F.array(*[p * 10 + i for i in k])
    tags = lambda **kv: F.create_map(*[F.lit(v) for pair in kv.items() for v in pair])
    none = F.create_map().cast("map<string,string>")

    def rows(df: DataFrame, kind: str, ident: Column, own: Column, lon: Column | None = None, lat: Column | None = None, refs: Column | None = None, members: Column | None = None) -> DataFrame:
        given = {"kind": F.lit(kind), "id": ident, "tags": own, "lon": lon, "lat": lat, "refs": refs, "members": members}
        kinds = dict(f.split(" ", 1) if " " in f else f.split(":") for f in mapfile.SCHEMA.split(", "))
        return df.select(*[(F.lit(None) if v is None else v).cast(kinds[n]).alias(n) for n, v in given.items()])

    out = []
    inner = [(0.25, 0.25), (0.5, 0.25), (0.5, 0.5), (0.25, 0.5)]
    for k, (fx, fy) in enumerate([(0, 0), (1, 0), (1, 1), (0, 1), *inner]):
        own = none
        if k == 0:
            own = F.when(case == 7, tags(amenity="school")).when(case == 5, tags(tourism="attraction")).otherwise(none)
        if k == 1:
            own = F.when(case == 5, tags(amenity="school", name="by the site")).otherwise(none)
        out.append(rows(base, "node", p * 10 + k, own, F.col("x") + fx * F.col("s"), F.col("y") + fy * F.col("s")))
    way = lambda c, k, own, *refs: rows(base.where(case == c), "way", p * 10 + k, own, refs=at(*refs))
    out += [
        way(0, 0, tags(leisure="park", name="green"), 0, 1, 2, 3, 0), way(1, 0, tags(tourism="attraction"), 0, 1, 2, 3), way(2, 0, tags(landuse="industrial"), 0, 1, 2, 3),
        way(3, 1, none, 0, 1, 2), way(3, 2, none, 2, 3, 0), way(3, 3, none, 4, 5, 6, 7, 4), way(4, 1, none, 0, 1, 2), way(6, 0, tags(leisure="park", area="no"), 0, 1, 2, 3, 0),
        way(7, 0, F.when(p % 16 == 7, tags(highway="residential")).otherwise(tags(highway="primary_link")), 0, 1, 2, 3),
    ]
    member = lambda kind, k, role: F.struct(F.lit(kind).alias("type"), (p * 10 + k).alias("ref"), F.lit(role).alias("role"))
    halves = [member("way", 1, "outer"), member("way", 2, "outer")]
    relation = lambda c, own, *m: rows(base.where(case == c), "relation", p, own, members=F.array(*m))
    out += [
        relation(3, tags(type="multipolygon", landuse="industrial"), *halves, member("way", 3, "inner")), relation(4, tags(type="multipolygon", landuse="industrial"), *halves),
        relation(5, tags(type="site", tourism="attraction"), member("node", 0, ""), member("node", 2, "")),
    ]
    return reduce(lambda a, b: a.unionByName(b), out)


def map_entities(spark: SparkSession, d: str) -> DataFrame:
    """Everything that a map is assembled to, in one table."""
    got = extraction.extract(elements(spark, d), RULES, AREAS)
    null = lambda kind: F.lit(None).cast(kind)
    parts = [
        got.entities.select(F.concat(F.lit("entity "), "shape").alias("what"), "kind", "id", "category", F.col("group").alias("note"), *extraction.BOX, "size"),
        got.areas.select(F.lit("area").alias("what"), "kind", "id", "category", null("string").alias("note"), *extraction.BOX, "size"),
        got.roads.select(F.lit("road").alias("what"), F.lit("way").alias("kind"), F.col("way").alias("id"), F.col("highway").alias("category"), F.when(F.col("is_major"), "major").alias("note"), *extraction.BOX, "size"),
        got.failures.select(F.lit("failure").alias("what"), "kind", "id", "category", F.col("reason").alias("note"), *extraction.BOX, null("double").alias("size")),
        got.dropped.select(F.lit("dropped").alias("what"), "kind", "id", "category", F.col("relation").cast("string").alias("note"), *[null("double").alias(c) for c in extraction.BOX], null("double").alias("size")),
        got.edges.groupBy("way", "is_major").agg(F.count(F.lit(1)).cast("double").alias("size")).select(F.lit("edges").alias("what"), F.lit("way").alias("kind"), F.col("way").alias("id"), null("string").alias("category"), F.when(F.col("is_major"), "major").alias("note"), *[null("double").alias(c) for c in extraction.BOX], "size"),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


_SQUARE, _NOWHERE = "x AS x0, y AS y0, x + s AS x1, y + s AS y1", "NULL::DOUBLE AS x0, NULL::DOUBLE AS y0, NULL::DOUBLE AS x1, NULL::DOUBLE AS y1"
_ROWS = [
    (0, "entity area", "way", "p * 10", "'park_recreation'", "'leisure'", _SQUARE, "s * s"), (0, "area", "way", "p * 10", "'park_area'", "NULL", _SQUARE, "s * s"),
    (1, "entity line", "way", "p * 10", "'attraction_culture'", "'leisure'", _SQUARE, "3 * s"), (2, "failure", "way", "p * 10", "'industrial_site'", "'area_tag_on_open_way'", _NOWHERE, "NULL"),
    (3, "area", "relation", "p", "'industrial_site'", "NULL", _SQUARE, "s * s * 15 / 16"), (4, "failure", "relation", "p", "'industrial_site'", "'members_missing_from_extract'", _SQUARE, "NULL"),
    (5, "entity group", "relation", "p", "'attraction_culture'", "'leisure'", _SQUARE, "NULL"), (5, "dropped", "node", "p * 10", "'attraction_culture'", "CAST(p AS VARCHAR)", _NOWHERE, "NULL"),
    (5, "entity point", "node", "p * 10 + 1", "'school'", "'education'", "x + s AS x0, y AS y0, x + s AS x1, y AS y1", "NULL"),
    (6, "failure", "way", "p * 10", "'park_recreation'", "'closed_way_not_assembled'", _NOWHERE, "NULL"), (6, "failure", "way", "p * 10", "'park_area'", "'closed_way_not_assembled'", _NOWHERE, "NULL"),
    (7, "entity point", "node", "p * 10", "'school'", "'education'", "x AS x0, y AS y0, x AS x1, y AS y1", "NULL"),
    (7, "road", "way", "p * 10", "CASE WHEN p % 16 = 7 THEN 'residential' ELSE 'primary_link' END", "CASE WHEN p % 16 <> 7 THEN 'major' END", _SQUARE, "3 * s"),
    (7, "edges", "way", "p * 10", "NULL", "CASE WHEN p % 16 <> 7 THEN 'major' END", _NOWHERE, "3"),
]
MAP_ENTITIES = "WITH t AS (SELECT p_partkey AS p, CAST(p_partkey * 7919 % 18000 AS DOUBLE) AS x, CAST(p_partkey * 104729 % 18000 AS DOUBLE) AS y, CAST(p_partkey % 7 * 50 + 100 AS DOUBLE) AS s FROM part)\n" + "\nUNION ALL ".join(
    f"SELECT '{what}' AS what, '{kind}' AS kind, CAST({ident} AS BIGINT) AS id, {category} AS category, {note} AS note, {box}, CAST({size} AS DOUBLE) AS size FROM t WHERE p % 8 = {case}" for case, what, kind, ident, category, note, box, size in _ROWS
)

QUERIES = {"map_entities": (map_entities, MAP_ENTITIES)}
