"""From a map's elements to entities: tagged points, ways, areas with rings, relations, and what could not be assembled.

Elements are the rows of ``sources.mapfile.read_map``. Only nodes that a wanted way or relation names are joined; a relation's rings
are put together in its own group, which is as large as one relation.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions import geometry
from terrace.operators import entities
from terrace.operators.entities import Rule
from terrace.operators.graph import cut

#: Types of relations that are areas.
AREA_TYPES = ["multipolygon", "boundary"]
BOX = ["x0", "y0", "x1", "y1"]


@dataclass(frozen=True)
class Extract:
    """What a map holds.

    ``entities``: kind, id, category, group, name, tag_count, shape (point, line, area, group), box, size (length or area);
    ``areas``: kind, id, category, name, box, size; ``roads``: way, highway, is_major, box, size; ``edges``: way, a, b, is_major;
    ``failures``: kind, id, category, reason, box of the members that are there; ``dropped``: kind, id, category, relation.
    """

    entities: DataFrame
    areas: DataFrame
    roads: DataFrame
    edges: DataFrame
    failures: DataFrame
    dropped: DataFrame


def with_categories(elements: DataFrame, rules: list[Rule], areas: list[Rule]) -> DataFrame:
    return elements.withColumns({"category": entities.category(F.col("tags"), rules), "area_category": entities.category(F.col("tags"), areas)})


def relevant_relations(elements: DataFrame) -> DataFrame:
    """Relations that carry a category: relation, type, category, area_category, tags, members."""
    found = elements.where("kind = 'relation' AND (category IS NOT NULL OR area_category IS NOT NULL)")
    return found.select(F.col("id").alias("relation"), F.coalesce(F.try_element_at("tags", F.lit("type")), F.lit("")).alias("type"), "category", "area_category", "tags", "members")


def lines(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """Ways with ``points`` (of the nodes that have a place, in order), ``nodes`` (their numbers), ``closed`` and the box."""
    at = ways.select("id", F.posexplode("refs").alias("pos", "ref"))
    places = nodes.where("lon IS NOT NULL AND lat IS NOT NULL").select(F.col("id").alias("ref"), F.col("lon").cast("double").alias("x"), F.col("lat").cast("double").alias("y"))
    ordered = at.join(places, "ref").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("pos", "ref", "x", "y"))).alias("__p"))
    joined = ways.join(ordered, "id", "left")
    points = F.coalesce(F.transform("__p", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))), F.array().cast("array<struct<x:double,y:double>>"))
    listed = joined.withColumns({"points": points, "nodes": F.coalesce(F.transform("__p", lambda p: p["ref"]), F.array().cast("array<bigint>"))}).drop("__p")
    ring = (F.size("refs") >= 4) & (F.try_element_at("refs", F.lit(1)) == F.try_element_at("refs", F.lit(-1))) & (F.size("points") >= 4)
    return listed.withColumns({"closed": F.coalesce(ring, F.lit(False)), **geometry.extent(F.col("points"))})


def close_rings(ways: Iterable[tuple[list[int], list[float], list[float]]]) -> list[tuple[list[float], list[float]]] | None:
    """Lines of node numbers and places put end to end to rings; none if a line is left over."""
    open_lines, rings = [tuple(map(list, w)) for w in ways], []
    while open_lines:
        refs, xs, ys = open_lines.pop()
        while refs[0] != refs[-1]:
            at = next((k for k, (r, _, _) in enumerate(open_lines) if refs[-1] in (r[0], r[-1])), None)
            if at is None:
                return None
            r, x, y = open_lines.pop(at)
            turn = 1 if r[0] == refs[-1] else -1
            refs, xs, ys = refs + r[::turn][1:], xs + x[::turn][1:], ys + y[::turn][1:]
        rings.append((xs, ys))
    return rings


def ring_area(xs: list[float], ys: list[float]) -> float:
    return abs(sum(a * d - c * b for a, b, c, d in zip(xs, ys, xs[1:], ys[1:]))) / 2


def assemble(members: pd.DataFrame) -> pd.DataFrame:
    """One relation's member lines to its area: outer rings without the inner ones. No row size if a ring stays open or holds nothing."""
    part = {inner: [(list(r), list(x), list(y)) for r, x, y in zip(*(members.loc[(members.role == "inner") == inner, c] for c in ("nodes", "xs", "ys"))) if len(r) > 1] for inner in (False, True)}
    outer, inner = close_rings(part[False]), close_rings(part[True])
    size = None
    if outer and inner is not None:
        size = sum(ring_area(*r) for r in outer) - sum(ring_area(*r) for r in inner)
    return pd.DataFrame({"relation": [int(members.relation.iloc[0])], "size": pd.array([size if size and size > 0 else None], dtype="Float64")})


def _tall(rows: DataFrame, keep: list[str | Column], own: str = "category", area: str = "area_category") -> DataFrame:
    """A row for each category that an element carries, of either kind: ``is_area`` tells them apart."""
    both = F.array(F.struct(F.lit(False).alias("is_area"), F.col(own).alias("c")), F.struct(F.lit(True).alias("is_area"), F.col(area).alias("c")))
    return rows.withColumn("__c", F.explode(F.filter(both, lambda e: e["c"].isNotNull()))).select(*keep, F.col("__c.is_area").alias("is_area"), F.col("__c.c").alias("category"))


def extract(elements: DataFrame, rules: list[Rule], areas: list[Rule]) -> Extract:
    """All entities, areas, roads and failures of a map.

    A closed way is an area (unless tagged ``area=no``), an open one a line; an area tag on an open way fails. A relation of an area
    type is its rings, all members needed; any other relation is the group of its members, all needed and none nested, and can be no
    area. A member of the same category as its assembled relation is dropped. Whatever cannot be assembled is a failure with its reason.
    """
    known = with_categories(elements, rules, areas)
    nodes, relations = elements.where("kind = 'node'"), relevant_relations(known)
    members = relations.select("relation", "type", "category", "area_category", F.explode("members").alias("m")).select("relation", "type", "category", "area_category", F.col("m.type").alias("kind"), F.col("m.ref").alias("id"), F.col("m.role").alias("role"))
    driveable, major, _ = entities.road_class(F.try_element_at("tags", F.lit("highway")))
    ways = known.where("kind = 'way'").withColumns({"driveable": driveable, "is_major": major}).select("kind", "id", "tags", "refs", "category", "area_category", "driveable", "is_major")
    asked = members.where("kind = 'way'").select("id").distinct().withColumn("member", F.lit(True))
    wanted = ways.join(asked, "id", "left").where("member OR driveable OR category IS NOT NULL OR area_category IS NOT NULL")
    shaped = cut(lines(wanted, nodes))  # read by roads, ways and members

    roads = shaped.where(F.col("driveable") & (F.size("points") >= 2))
    pairs = F.arrays_zip(F.slice("nodes", F.lit(1), F.size("nodes") - 1).alias("a"), F.slice("nodes", F.lit(2), F.size("nodes") - 1).alias("b"))
    edges = roads.select(F.col("id").alias("way"), "is_major", F.explode(pairs).alias("e")).select("way", "e.a", "e.b", "is_major")
    described = lambda tags="tags": [F.try_element_at(tags, F.lit("name")).alias("name"), F.size(tags).alias("tag_count")]

    # Points and ways.
    tagged = known.where("kind = 'node' AND category IS NOT NULL AND lon IS NOT NULL AND lat IS NOT NULL")
    x, y = F.col("lon").cast("double"), F.col("lat").cast("double")
    found = [tagged.select("kind", "id", F.lit(False).alias("is_area"), "category", *described(), F.lit("point").alias("shape"), x.alias("x0"), y.alias("y0"), x.alias("x1"), y.alias("y1"), F.lit(None).cast("double").alias("size"), F.lit(None).cast("string").alias("reason"))]
    area = geometry.area(F.col("points"))
    of_ways = _tall(shaped, ["kind", "id", "tags", "points", "closed", *BOX])
    no_area = F.coalesce(F.try_element_at("tags", F.lit("area")) == "no", F.lit(False))
    why = (
        F.when(F.col("closed") & no_area, "closed_way_not_assembled")
        .when(F.col("closed") & (area <= 0), "assembler_empty_or_invalid")
        .when(~F.col("closed") & F.col("is_area"), "area_tag_on_open_way")
        .when(~F.col("closed") & (F.size("points") < 2), "open_way_without_locations")
    )
    size = F.when(F.col("closed"), area).otherwise(geometry.length(F.col("points")))
    found.append(of_ways.select("kind", "id", "is_area", "category", *described(), F.when(F.col("closed"), "area").otherwise("line").alias("shape"), *BOX, size.alias("size"), why.alias("reason")))

    # Relations: their members with places, then rings or groups.
    box_of = [F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1")]
    placed = nodes.join(members.where("kind = 'node'").select("id").distinct(), "id", "left_semi").where("lon IS NOT NULL AND lat IS NOT NULL")
    places = placed.select(F.lit("node").alias("kind"), "id", x.alias("x0"), y.alias("y0"), x.alias("x1"), y.alias("y1"), F.lit(None).cast("array<bigint>").alias("nodes"), F.lit(None).cast("array<struct<x:double,y:double>>").alias("points"), F.lit(True).alias("usable"))
    there = shaped.where("member").select("kind", "id", *BOX, "nodes", "points", (F.size("points") >= 2).alias("usable"))
    met = members.join(places.unionByName(there), ["kind", "id"], "left")
    is_ring = F.col("type").isin(AREA_TYPES)
    counted = met.groupBy("relation").agg(F.count(F.lit(1)).alias("n"), F.count_if("usable").alias("here"), F.count_if((F.col("kind") == "way") & F.col("usable").isNull()).alias("gone"), F.count_if(F.col("kind") == "relation").alias("nested"), *box_of)
    parts = met.where(is_ring & (F.col("kind") == "way") & F.col("usable")).select("relation", F.coalesce("role", F.lit("")).alias("role"), "nodes", F.col("points.x").alias("xs"), F.col("points.y").alias("ys"))
    rings = parts.groupBy("relation").applyInPandas(assemble, "relation long, size double")
    whole = relations.join(counted, "relation", "left").join(rings, "relation", "left")
    none = lambda c: F.coalesce(F.col(c), F.lit(0))
    ring_why = F.when(none("gone") > 0, "members_missing_from_extract").when(F.col("size").isNull(), "assembler_no_area")
    group_why = F.when(none("nested") > 0, "nested_relation_member").when(none("here") < none("n"), "members_missing_from_extract").when(none("n") == 0, "no_members").when(F.col("is_area"), "area_category_on_grouping_relation")
    of_relations = _tall(whole, ["relation", "type", "tags", "n", "here", "gone", "nested", "size", *BOX])
    found.append(of_relations.select(F.lit("relation").alias("kind"), F.col("relation").alias("id"), "is_area", "category", *described(), F.when(is_ring, "area").otherwise("group").alias("shape"), *BOX, F.when(is_ring, F.col("size")).alias("size"), F.when(is_ring, ring_why).otherwise(group_why).alias("reason")))

    every = cut(found[0].unionByName(found[1]).unionByName(found[2]))  # read by all results
    done = every.where("reason IS NULL").drop("reason")
    # A relation of which anything was assembled takes the place of members of its categories.
    assembled = done.where("kind = 'relation'").select(F.col("id").alias("relation")).distinct()
    taken = _tall(members.join(assembled, "relation", "left_semi"), ["kind", "id", "relation"]).groupBy("kind", "id", "is_area", "category").agg(F.max("relation").alias("relation")).where("kind <> 'relation'")
    joined = done.join(taken, ["kind", "id", "is_area", "category"], "left")
    kept = joined.where("relation IS NULL")
    failed = every.where("reason IS NOT NULL")
    seen = F.col("kind") == "relation"
    return Extract(
        entities=kept.where("NOT is_area").select("kind", "id", "category", entities.group_of(F.col("category"), rules).alias("group"), "name", "tag_count", "shape", *BOX, "size"),
        areas=kept.where("is_area").select("kind", "id", "category", "name", *BOX, "size"),
        roads=roads.select(F.col("id").alias("way"), F.try_element_at("tags", F.lit("highway")).alias("highway"), "is_major", *BOX, geometry.length(F.col("points")).alias("size")),
        edges=edges,
        failures=failed.select("kind", "id", "category", "reason", *[F.when(seen, F.col(c)).alias(c) for c in BOX]),
        dropped=joined.where("relation IS NOT NULL").select("kind", "id", "category", "relation"),
    )
