"""Queries on entities: categories, duplicates, relations, providers, audits of one source against another."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.functions import strings
from terrace.operators import audit, entities, experiment
from terrace.plans.places import rounded
from terrace.sources import layers, tables
from terrace.sources.layers import with_layers

#: A small rule set over derived tags, in order of precedence.
RULES = [
    entities.Rule("mall", "retail", [{"shop": ["large", "promo"], "brand": ["*"]}], [{"size": ["1", "2", "3"]}]),
    entities.Rule("market", "retail", [{"shop": ["economy"]}, {"market": ["*"]}]),
    entities.Rule("clinic", "health", [{"amenity": ["widget"]}], [{"shop": ["small"]}]),
    entities.Rule("shop", "retail", [{"shop": ["*"]}]),
]


def _tags() -> F.Column:
    """Tags of a part: shop, brand, size, amenity (the name's last word) and, for some, market."""
    market = F.when(F.col("p_partkey") % 9 == 0, F.create_map(F.lit("market"), F.lit("yes"))).otherwise(F.create_map().cast("map<string,string>"))
    base = F.create_map(F.lit("brand"), F.col("p_brand"), F.lit("size"), F.col("p_size").cast("string"), F.lit("amenity"), F.substring_index("p_name", " ", -1))
    shop = F.when(F.col("p_partkey") % 4 != 0, F.create_map(F.lit("shop"), F.lower("p_type"))).otherwise(F.create_map().cast("map<string,string>"))
    return F.map_concat(base, shop, market)


def taxonomy_match(spark: SparkSession, d: str) -> DataFrame:
    tagged = layers.read(spark, d, "part").select("p_partkey", _tags().alias("tags"))
    named = tagged.withColumn("category", entities.category(F.col("tags"), RULES))
    return named.select("p_partkey", "category", entities.group_of(F.col("category"), RULES).alias("grp"))


TAXONOMY = """
WITH t AS (SELECT p_partkey, CASE WHEN p_partkey % 4 <> 0 THEN lower(p_type) END AS shop, CASE WHEN p_partkey % 9 = 0 THEN 'yes' END AS market, p_brand AS brand, CAST(p_size AS VARCHAR) AS size, split_part(p_name, ' ', -1) AS amenity FROM part),
c AS (SELECT p_partkey, CASE WHEN coalesce(shop IN ('large', 'promo'), false) AND brand IS NOT NULL AND size NOT IN ('1', '2', '3') THEN 'mall'
  WHEN coalesce(shop = 'economy', false) OR market IS NOT NULL THEN 'market' WHEN amenity = 'widget' AND coalesce(shop <> 'small', true) THEN 'clinic' WHEN shop IS NOT NULL THEN 'shop' END AS category FROM t)
SELECT p_partkey, category, CASE category WHEN 'clinic' THEN 'health' WHEN 'mall' THEN 'retail' WHEN 'market' THEN 'retail' WHEN 'shop' THEN 'retail' END AS grp FROM c"""  # fmt: skip


def name_normalize(spark: SparkSession, d: str) -> DataFrame:
    accents = F.array(*[F.lit(x) for x in ("  Café Nº1 ", "ÀÉÎÕÜ--Straße", "Ñandú & Søn", "...", "Đà Nẵng 5", "Bệnh viện", "Phở Hạnh ﬁ")])
    raw = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.element_at(accents, (F.col("c_custkey") % 7 + 1).cast("int")), F.lit(" "), F.col("c_mktsegment"))).otherwise(F.element_at(accents, (F.col("c_custkey") % 7 + 1).cast("int")))
    return layers.read(spark, d, "customer").select("c_custkey", raw.alias("raw")).select("c_custkey", strings.normalize_name(F.col("raw")).alias("name"))


NAMES = """
WITH r AS (SELECT c_custkey, ['  Café Nº1 ', 'ÀÉÎÕÜ--Straße', 'Ñandú & Søn', '...', 'Đà Nẵng 5', 'Bệnh viện', 'Phở Hạnh ﬁ'][c_custkey % 7 + 1] || CASE WHEN c_custkey % 3 = 0 THEN ' ' || c_mktsegment ELSE '' END AS raw FROM customer)
SELECT c_custkey, nullif(trim(regexp_replace(translate(replace(lower(trim(raw)), 'ﬁ', 'fi'), 'àéîõüñúẵºệởạ', 'aeiounuaoeoa'), '[^a-z0-9]+', ' ', 'g')), '') AS name FROM r"""


def _entities(spark: SparkSession, d: str) -> DataFrame:
    """Points of customers and shapes of suppliers at places that often coincide, with names that sometimes do."""
    c, s = F.col("c_custkey"), F.col("s_suppkey")
    a = layers.read(spark, d, "customer").select((c * 2).alias("id"), F.lit("point").alias("kind"), F.col("c_mktsegment").alias("category"), F.concat(F.lit("Name "), (c % 40).cast("string")).alias("name"), F.when(c % 7 == 0, F.concat(F.lit("B-"), (c % 5).cast("string"))).alias("brand"), (c * 7919 % 3000).cast("double").alias("x"), (c * 104_729 % 3000).cast("double").alias("y"))
    segments = F.array(*[F.lit(x) for x in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")])
    b = layers.read(spark, d, "supplier").select((s * 2 + 1).alias("id"), F.lit("polygon").alias("kind"), F.element_at(segments, (s % 5 + 1).cast("int")).alias("category"), F.concat(F.lit("NAME "), (s % 40).cast("string")).alias("name"), F.when(s % 3 == 0, F.concat(F.lit("b "), (s % 5).cast("string"))).alias("brand"), (s * 6007 % 3000).cast("double").alias("x"), (s * 15_013 % 3000).cast("double").alias("y"))
    return a.unionByName(b)


def dedup_clusters(spark: SparkSession, d: str) -> DataFrame:
    kept = entities.deduplicate(_entities(spark, d), 300.0)
    return kept.where("keeper <> id")


DEDUP = """
WITH RECURSIVE p AS (SELECT c_custkey * 2 AS id, c_mktsegment AS category, 'name ' || c_custkey % 40 AS n, CASE WHEN c_custkey % 7 = 0 THEN 'b ' || c_custkey % 5 END AS br, CAST(c_custkey * 7919 % 3000 AS DOUBLE) AS x, CAST(c_custkey * 104729 % 3000 AS DOUBLE) AS y FROM customer),
s AS (SELECT s_suppkey * 2 + 1 AS id, ['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'][s_suppkey % 5 + 1] AS category, 'name ' || s_suppkey % 40 AS n, CASE WHEN s_suppkey % 3 = 0 THEN 'b ' || s_suppkey % 5 END AS br, CAST(s_suppkey * 6007 % 3000 AS DOUBLE) AS x, CAST(s_suppkey * 15013 % 3000 AS DOUBLE) AS y FROM supplier),
e AS (SELECT p.id AS a, s.id AS b FROM p JOIN s ON p.category = s.category AND (p.x - s.x) * (p.x - s.x) + (p.y - s.y) * (p.y - s.y) <= 90000 AND (p.n = s.n OR coalesce(p.br = s.br, false))),
u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r(node, other) AS (SELECT a, b FROM u UNION SELECT r.node, u.b FROM r JOIN u ON r.other = u.a)
SELECT node AS id, category, keeper FROM (SELECT node, min(other) FILTER (other % 2 = 1) AS keeper FROM (SELECT * FROM r UNION SELECT node, node FROM r) GROUP BY node) k JOIN (SELECT id, category FROM p UNION ALL SELECT id, category FROM s) ON id = node WHERE keeper <> node"""  # fmt: skip


def relation_assembly(spark: SparkSession, d: str) -> DataFrame:
    """Orders as relations, lines as members; parts without stock are missing, and some members are relations themselves."""
    o = layers.read(spark, d, "orders").select(F.col("o_orderkey").alias("relation"), F.col("o_orderpriority").alias("category"))
    kind = F.when((F.col("l_orderkey") % 31 == 0) & (F.col("l_linenumber") == 1), "relation").otherwise("way")
    m = layers.read(spark, d, "lineitem").select(F.col("l_orderkey").alias("relation"), F.col("l_partkey").alias("member"), kind.alias("kind"))
    here = layers.read(spark, d, "part").where("p_size > 2").select(F.col("p_partkey").alias("member"))
    return entities.assembly_report(entities.assemble_relations(o, m, here))


RELATIONS = """
WITH c AS (SELECT l_orderkey AS relation, count(*) AS expected, count(p.p_partkey) AS found, count(*) FILTER (l_orderkey % 31 = 0 AND l_linenumber = 1) AS nested FROM lineitem LEFT JOIN (SELECT p_partkey FROM part WHERE p_size > 2) p ON p.p_partkey = l_partkey GROUP BY 1),
o AS (SELECT o_orderpriority AS category, CASE WHEN coalesce(expected, 0) = 0 THEN 'empty' WHEN nested > 0 THEN 'nested' WHEN found < expected THEN 'missing_member' ELSE 'assembled' END AS outcome FROM orders LEFT JOIN c ON relation = o_orderkey),
r AS (SELECT category, string_agg(outcome || ':' || n, ';' ORDER BY outcome) AS reasons FROM (SELECT category, outcome, count(*) AS n FROM o WHERE outcome <> 'assembled' GROUP BY ALL) GROUP BY category)
SELECT category, count(*) AS relevant, count(*) FILTER (outcome = 'assembled') AS assembled, count(*) FILTER (outcome <> 'assembled') AS failed, coalesce(any_value(reasons), 'none') AS reasons FROM o LEFT JOIN r USING (category) GROUP BY category"""  # fmt: skip


def member_rows(spark: SparkSession, d: str) -> DataFrame:
    """Lines that are not members of an assembled relation of their own category."""
    o = layers.read(spark, d, "orders").select(F.col("o_orderkey").alias("relation"), F.col("o_orderstatus").alias("category"))
    lines = layers.read(spark, d, "lineitem").select(F.col("l_orderkey").alias("relation"), F.col("l_partkey").alias("member"), F.lit("way").alias("kind"))
    outcomes = entities.assemble_relations(o, lines, layers.read(spark, d, "part").where("p_size > 2").select(F.col("p_partkey").alias("member")))
    rows = layers.read(spark, d, "lineitem").select(F.col("l_partkey").alias("member"), F.col("l_linestatus").alias("category"))
    return entities.drop_members(rows, lines, outcomes).groupBy("category").agg(F.count(F.lit(1)).alias("n"))


MEMBERS = """
WITH c AS (SELECT l_orderkey AS relation, count(*) AS expected, count(p.p_partkey) AS found FROM lineitem LEFT JOIN (SELECT p_partkey FROM part WHERE p_size > 2) p ON p.p_partkey = l_partkey GROUP BY 1),
t AS (SELECT DISTINCT l_partkey AS m, o_orderstatus AS c FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN c ON relation = o_orderkey WHERE found = expected)
SELECT l_linestatus AS category, count(*) AS n FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM t WHERE m = l_partkey AND c = l_linestatus) GROUP BY 1"""


def _catalogue(spark: SparkSession, d: str) -> DataFrame:
    """Parts as a nested catalogue of places."""
    k = F.col("p_partkey")
    src = lambda name, when: F.when(when, F.struct(F.lit(name).alias("dataset"), F.lit("c").alias("license")))
    sources = F.filter(F.array(src("Atlas", k % 2 == 0), src("meta", k % 3 == 0), src("Meta", k % 6 == 0), src("msft", k % 5 == 0)), lambda s: s.isNotNull())
    return layers.read(spark, d, "part").select(
        k.alias("id"), F.struct(F.when(k % 11 != 0, F.col("p_type")).alias("primary")).alias("taxonomy"), F.struct(F.when(k % 7 != 0, F.col("p_name")).otherwise(F.lit("  ")).alias("primary")).alias("names"),
        (k % 101 / 100.0).cast("double").alias("confidence"), sources.alias("sources"),
        *[F.when(k % n != 0, F.array(F.lit("x"))).alias(c) for c, n in (("websites", 2), ("phones", 3), ("socials", 5))],
    )


def _places_view(spark: SparkSession, d: str) -> DataFrame:
    crosswalk = spark.createDataFrame([("SMALL", "shop"), ("MEDIUM", "shop"), ("LARGE", "mall"), ("PROMO", "market")], "source_category string, category string")
    return tables.places_catalogue(_catalogue(spark, d), crosswalk, "atlas")


def catalogue_view(spark: SparkSession, d: str) -> DataFrame:
    view = _places_view(spark, d)
    return view.groupBy("category").agg(F.count(F.lit(1)).alias("n"), F.count_if("missing_name").alias("no_name"), F.count_if("missing_category").alias("no_category"), F.count_if("has_phones").alias("phones"))


_CATALOGUE = """
WITH v AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 11 <> 0 THEN p_type END AS sc, p_partkey % 7 = 0 AS missing_name, CAST(p_partkey % 101 AS DOUBLE) / 100 AS confidence,
  list_distinct(list_filter([CASE WHEN p_partkey % 3 = 0 THEN 'meta' END, CASE WHEN p_partkey % 5 = 0 THEN 'msft' END], lambda x: x IS NOT NULL)) AS providers FROM part),
c AS (SELECT *, CASE sc WHEN 'SMALL' THEN 'shop' WHEN 'MEDIUM' THEN 'shop' WHEN 'LARGE' THEN 'mall' WHEN 'PROMO' THEN 'market' END AS category,
  CASE WHEN confidence <= 0.3 THEN 'low' WHEN confidence <= 0.6 THEN 'middle' ELSE 'high' END AS band FROM v)
"""
CATALOGUE_VIEW = _CATALOGUE + "SELECT category, count(*) AS n, count(*) FILTER (missing_name) AS no_name, count(*) FILTER (sc IS NULL) AS no_category, count(*) FILTER (k % 3 <> 0) AS phones FROM c GROUP BY category"


def confidence_rollup(spark: SparkSession, d: str) -> DataFrame:
    return audit.provider_confidence(_places_view(spark, d), "confidence", "providers")


_PROVIDERS = "count(*) AS places, CAST(sum(len(providers)) AS BIGINT) AS named, count(*) FILTER (len(providers) = 0) AS none, count(*) FILTER (len(providers) = 1) AS single, count(*) FILTER (len(providers) > 1) AS several"
ROLLUP = _CATALOGUE + f"SELECT band, grouping(band)::INTEGER AS overall, {_PROVIDERS} FROM c GROUP BY GROUPING SETS ((band), ())"


def provider_counts(spark: SparkSession, d: str) -> DataFrame:
    named = _places_view(spark, d).select(F.explode("providers").alias("provider"))
    return named.groupBy("provider").agg(F.count(F.lit(1)).alias("n"))


PROVIDER_COUNTS = _CATALOGUE + "SELECT provider, count(*) AS n FROM (SELECT unnest(providers) AS provider FROM c) GROUP BY provider"


def contact_proxy(spark: SparkSession, d: str) -> DataFrame:
    out = audit.contact_proxy(_places_view(spark, d), "category", "confidence", ["has_websites", "has_phones", "has_socials"])
    return out.select("band", "category", "n", *rounded("has_websites", "has_phones", "has_socials"))


CONTACT = _CATALOGUE + "SELECT band, category, count(*) AS n, " + ", ".join(f"round(avg(CASE WHEN k % {n} <> 0 THEN 1.0 ELSE 0 END), 6) AS has_{c}" for c, n in (("websites", 2), ("phones", 3), ("socials", 5))) + " FROM c GROUP BY band, category"


def missing_rates(spark: SparkSession, d: str) -> DataFrame:
    out = audit.missing_rates(_places_view(spark, d), {"name": F.col("missing_name"), "category": F.col("category").isNull(), "provider": F.size("providers") == 0})
    return out.select(*rounded("name", "category", "provider"))


MISSING = _CATALOGUE + "SELECT round(avg(CASE WHEN missing_name THEN 1.0 ELSE 0 END), 6) AS name, round(avg(CASE WHEN category IS NULL THEN 1.0 ELSE 0 END), 6) AS category, round(avg(CASE WHEN len(providers) = 0 THEN 1.0 ELSE 0 END), 6) AS provider FROM c"


def counts_by_policy(spark: SparkSession, d: str) -> DataFrame:
    left = layers.pois(spark, d).withColumn("category", F.when(F.col("poi_id") % 17 != 0, F.col("category")))
    return audit.counts_by_policy(left, layers.places(spark, d), "category", "confidence", [0.0, 0.3, 0.6])


POLICY = with_layers("pois places", """
WITH a AS (SELECT CASE WHEN poi_id % 17 <> 0 THEN category END AS category, count(*) AS n_left FROM pois GROUP BY 1),
b AS (SELECT category, count(*) FILTER (confidence >= 0) AS n0, count(*) FILTER (confidence >= 0.3) AS n30, count(*) FILTER (confidence >= 0.6) AS n60 FROM places GROUP BY 1)
SELECT coalesce(a.category, b.category) AS category, coalesce(n_left, 0) AS n_left, coalesce(n0, 0) AS n_right_0, coalesce(n30, 0) AS n_right_30, coalesce(n60, 0) AS n_right_60 FROM a FULL JOIN b ON a.category IS NOT DISTINCT FROM b.category""")


def density_grid(spark: SparkSession, d: str) -> DataFrame:
    return audit.density_grid(layers.pois(spark, d).select((F.col("x") - 500).alias("x"), (F.col("y") + 500).alias("y")), layers.SIDE, 1000.0)


DENSITY = with_layers("pois", """
WITH p AS (SELECT greatest(0, least(19, CAST(floor((x - 500) / 1000) AS BIGINT))) AS col, greatest(0, least(19, CAST(floor((y + 500) / 1000) AS BIGINT))) AS row FROM pois)
SELECT a.c AS col, b.r AS row, count(p.col) AS n FROM range(20) a(c) CROSS JOIN range(20) b(r) LEFT JOIN p ON p.col = a.c AND p.row = b.r GROUP BY 1, 2""")


def densest_cells(spark: SparkSession, d: str) -> DataFrame:
    return audit.density_grid(layers.pois(spark, d), layers.SIDE, 1000.0).orderBy(F.desc("n"), "col", "row").limit(5)


DENSEST = with_layers("pois", "SELECT CAST(floor(x / 1000) AS BIGINT) AS col, CAST(floor(y / 1000) AS BIGINT) AS row, count(*) AS n FROM pois GROUP BY 1, 2 ORDER BY n DESC, 1, 2 LIMIT 5")


def review_sample(spark: SparkSession, d: str) -> DataFrame:
    return experiment.hash_sample(layers.pois(spark, d), ["category"], F.col("poi_id"), 6, "20260914").select("category", "poi_id", "name")


REVIEW = with_layers("pois", "SELECT category, poi_id, name FROM pois QUALIFY row_number() OVER (PARTITION BY category ORDER BY md5('20260914' || poi_id)) <= 6")


def box_scan(spark: SparkSession, d: str) -> DataFrame:
    """The columns of a box scan on flat coordinates: the comparisons reach the scan."""
    extent = F.struct(F.col("p_size").alias("xmin"), F.col("p_size").alias("xmax"), F.col("p_retailprice").alias("ymin"), F.col("p_retailprice").alias("ymax"))
    kept = tables.scan_box(layers.read(spark, d, "part").withColumn("bbox", extent), (10, 900.0, 20, 950.0), ["p_type", "p_partkey"], ["p_type", "p_partkey"])
    return kept.groupBy("p_type").agg(F.count(F.lit(1)).alias("n"), F.min("p_partkey").alias("first"))


BOX_SCAN = "SELECT p_type, count(*) AS n, min(p_partkey) AS first FROM part WHERE p_size BETWEEN 10 AND 20 AND p_retailprice BETWEEN 900 AND 950 GROUP BY 1"


def index_upsert(spark: SparkSession, d: str) -> DataFrame:
    old = layers.read(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("v"))
    new = layers.read(spark, d, "supplier").where("s_nationkey < 5").select((F.col("s_suppkey") + 50).alias("k"), F.concat(F.lit("new "), F.col("s_name")).alias("v"))
    return tables.upsert(old, new, "k")


UPSERT = """
WITH n AS (SELECT s_suppkey + 50 AS k, 'new ' || s_name AS v FROM supplier WHERE s_nationkey < 5)
SELECT s_suppkey AS k, s_name AS v FROM supplier WHERE s_suppkey NOT IN (SELECT k FROM n) UNION ALL SELECT k, v FROM n"""


def source_resolution(spark: SparkSession, d: str) -> DataFrame:
    index = layers.read(spark, d, "nation").select(F.col("n_nationkey").alias("k"))
    own = layers.read(spark, d, "supplier").where("s_suppkey % 10 = 0").groupBy(F.col("s_nationkey").alias("k")).agg(F.min("s_name").alias("file"))
    parent = layers.read(spark, d, "customer").where("c_nationkey < 20").groupBy(F.col("c_nationkey").alias("k")).agg(F.min("c_name").alias("file"))
    return tables.resolve(index, own, parent, "k", "file")


RESOLUTION = """
WITH o AS (SELECT s_nationkey AS k, min(s_name) AS f FROM supplier WHERE s_suppkey % 10 = 0 GROUP BY 1), p AS (SELECT c_nationkey AS k, min(c_name) AS f FROM customer WHERE c_nationkey < 20 GROUP BY 1)
SELECT n_nationkey AS k, coalesce(o.f, p.f) AS file, CASE WHEN o.f IS NOT NULL THEN 'own' WHEN p.f IS NOT NULL THEN 'parent' ELSE 'unresolved' END AS origin FROM nation LEFT JOIN o ON o.k = n_nationkey LEFT JOIN p ON p.k = n_nationkey"""

QUERIES = {
    "taxonomy_match": (taxonomy_match, TAXONOMY),
    "name_normalize": (name_normalize, NAMES),
    "dedup_clusters": (dedup_clusters, DEDUP),
    "relation_assembly": (relation_assembly, RELATIONS),
    "member_rows": (member_rows, MEMBERS),
    "catalogue_view": (catalogue_view, CATALOGUE_VIEW),
    "confidence_rollup": (confidence_rollup, ROLLUP),
    "provider_counts": (provider_counts, PROVIDER_COUNTS),
    "contact_proxy": (contact_proxy, CONTACT),
    "missing_rates": (missing_rates, MISSING),
    "counts_by_policy": (counts_by_policy, POLICY),
    "density_grid": (density_grid, DENSITY),
    "densest_cells": (densest_cells, DENSEST),
    "review_sample": (review_sample, REVIEW),
    "box_scan": (box_scan, BOX_SCAN),
    "index_upsert": (index_upsert, UPSERT),
    "source_resolution": (source_resolution, RESOLUTION),
}
