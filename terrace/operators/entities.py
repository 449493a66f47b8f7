"""Entities from tagged objects: categories by rule, road classes, duplicates, assembled relations, providers."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions import strings
from terrace.operators.graph import components
from terrace.operators.spatial_join import within

#: Driveable road classes, the major ones among them, the suffix of their links.
DRIVEABLE = ["motorway", "trunk", "primary", "secondary", "tertiary", "unclassified", "residential", "living_street", "service", "track"]
MAJOR = ["motorway", "trunk", "primary", "secondary"]
LINK = "_link"


@dataclass(frozen=True)
class Rule:
    """A category: it matches if any clause does and no exclusion does. A clause is a map of key to values (``*``: any), all of which hold."""

    category: str
    group: str
    any_of: list[dict[str, list[str]]]
    none_of: list[dict[str, list[str]]] = field(default_factory=list)


def _clause(tags: Column, clause: dict[str, list[str]]) -> Column:
    held = F.lit(True)
    for key, values in clause.items():
        value = F.try_element_at(tags, F.lit(key))
        held = held & (F.map_contains_key(tags, key) if "*" in values else F.coalesce(value.isin(values), F.lit(False)))
    return held


def category(tags: Column, rules: list[Rule]) -> Column:
    """The first category in order of the rules whose clauses hold, else null: one CASE, compiled from the rules."""
    out = None
    for rule in rules:
        hit = F.lit(False)
        for clause in rule.any_of:
            hit = hit | _clause(tags, clause)
        for clause in rule.none_of:
            hit = hit & ~_clause(tags, clause)
        out = F.when(hit, rule.category) if out is None else out.when(hit, rule.category)
    return out


def group_of(name: Column, rules: list[Rule]) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for r in rules for x in (r.category, r.group)]), name)


def road_class(highway: Column) -> tuple[Column, Column, Column]:
    """(driveable, major, link) of a highway value; links count with the class that they lead to."""
    base = F.regexp_replace(highway, f"{LINK}$", "")
    return F.coalesce(base.isin(DRIVEABLE), F.lit(False)), F.coalesce(base.isin(MAJOR), F.lit(False)), F.coalesce(highway.endswith(LINK), F.lit(False))


def deduplicate(entities: DataFrame, distance: float = 75.0) -> DataFrame:
    """``id, keeper, duplicates_in``: clusters of the same category, a point and a shape each link, at most ``distance`` apart and of one
    normalised name or brand. The keeper is the smallest id of a cluster's shapes; rows without a duplicate are their own keeper.

    ``entities``: id, category, kind (``point`` or other), name, brand, x, y.
    """
    named = entities.withColumn("n", strings.normalize_name(F.col("name"))).withColumn("br", strings.normalize_name(F.col("brand")))
    points, shapes = named.where("kind = 'point'"), named.where("kind <> 'point'")
    same = F.coalesce(F.col("n") == F.col("r_n"), F.lit(False)) | F.coalesce(F.col("br") == F.col("r_br"), F.lit(False))
    edges = within(points, shapes, distance, keys=("category",)).where(same).select(F.col("id").alias("a"), F.col("r_id").alias("b"))
    clusters = components(edges)
    keepers = clusters.join(shapes.select(F.col("id").alias("node")), "node").groupBy("root").agg(F.min("node").alias("keeper"))
    kept = clusters.join(keepers, "root").select(F.col("node").alias("id"), "keeper")
    return entities.select("id", "category").join(kept, "id", "left").select("id", "category", F.coalesce("keeper", "id").alias("keeper"))


def assemble_relations(relations: DataFrame, members: DataFrame, available: DataFrame) -> DataFrame:
    """``relation, category, expected, found, outcome``: a relation is assembled only if all of its members are there.

    ``relations``: relation, category; ``members``: relation, member, kind; ``available``: member.
    """
    met = members.join(available.select("member", F.lit(1).alias("here")), "member", "left")
    counts = met.groupBy("relation").agg(F.count(F.lit(1)).alias("expected"), F.count("here").alias("found"), F.count_if(F.col("kind") == "relation").alias("nested"))
    joined = relations.join(counts, "relation", "left")
    outcome = F.when(F.coalesce("expected", F.lit(0)) == 0, "empty").when(F.col("nested") > 0, "nested").when(F.col("found") < F.col("expected"), "missing_member").otherwise("assembled")
    return joined.select("relation", "category", F.coalesce("expected", F.lit(0)).alias("expected"), F.coalesce("found", F.lit(0)).alias("found"), outcome.alias("outcome"))


def assembly_report(outcomes: DataFrame) -> DataFrame:
    """By category: relevant, assembled, failed and the reasons as text."""
    reasons = outcomes.where("outcome <> 'assembled'").groupBy("category", "outcome").agg(F.count(F.lit(1)).alias("n"))
    shown = reasons.groupBy("category").agg(F.map_from_entries(F.collect_list(F.struct("outcome", "n"))).alias("m")).select("category", strings.failures(F.col("m")).alias("reasons"))
    counts = outcomes.groupBy("category").agg(F.count(F.lit(1)).alias("relevant"), F.count_if(F.col("outcome") == "assembled").alias("assembled"))
    return counts.join(shown, "category", "left").select("category", "relevant", "assembled", (F.col("relevant") - F.col("assembled")).alias("failed"), F.coalesce("reasons", F.lit("none")).alias("reasons"))


def drop_members(rows: DataFrame, members: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Rows but those that are members of an assembled relation of the same category."""
    taken = members.join(outcomes.where("outcome = 'assembled'"), "relation").select(F.col("member").alias("m"), F.col("category").alias("c")).distinct()
    return rows.join(taken, (F.col("member") == F.col("m")) & (F.col("category") == F.col("c")), "left_anti")


def providers(sources: Column, publisher: str) -> Column:
    """Different datasets of a place's sources in order, without the publisher itself."""
    return F.array_distinct(F.filter(F.transform(sources, lambda s: F.lower(s["dataset"])), lambda n: n.isNotNull() & (n != publisher)))
