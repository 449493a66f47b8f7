"""Scans: required columns, box pushdown on nested extents, releases, pinned inputs, place catalogues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.operators.entities import providers


class SchemaError(ValueError):
    """A table lacks columns that its readers need."""


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise SchemaError(f"missing columns: {', '.join(missing)}")
    return df


def overlaps(west: float, south: float, east: float, north: float, box: str = "bbox") -> Column:
    """Extents that meet the box; plain comparisons on nested fields, so the scan skips row groups by them."""
    return (F.col(f"{box}.xmin") <= east) & (F.col(f"{box}.xmax") >= west) & (F.col(f"{box}.ymin") <= north) & (F.col(f"{box}.ymax") >= south)


def scan_box(table: DataFrame, box: tuple[float, float, float, float], columns: list[str], needed: list[str] = ()) -> DataFrame:
    """The wanted columns of a table's rows whose extent meets the box; whole geometries, not cut."""
    return require(table, [*needed, "bbox"]).where(overlaps(*box)).select(*columns)


def latest_release(listing: DataFrame, name: str = "release") -> DataFrame:
    return listing.agg(F.max(name).alias(name))


def places_catalogue(places: DataFrame, crosswalk: DataFrame, publisher: str) -> DataFrame:
    """The audit view of a nested catalogue: category by crosswalk (unmapped is null), providers, what is missing."""
    flat = places.select(
        "id", F.col("taxonomy.primary").alias("source_category"), F.col("names.primary").alias("name"), "confidence",
        providers(F.col("sources"), publisher).alias("providers"),
        *[(F.coalesce(F.size(c), F.lit(0)) > 0).alias(f"has_{c}") for c in ("websites", "phones", "socials")],
    )
    mapped = flat.join(F.broadcast(crosswalk.select(F.col("source_category"), "category")), "source_category", "left")  # a table of rules
    return mapped.withColumns({"missing_name": F.coalesce(F.trim("name"), F.lit("")) == "", "missing_category": F.col("source_category").isNull()})


def check_table(df: DataFrame, key: list[str], rows: int, groups: dict[str, set], uniform: list[str]) -> list[str]:
    """Problems of an input that is pinned to a number of rows, unique keys, known groups and one value in some columns."""
    found = df.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(F.struct(*key)).alias("keys"), *[F.collect_set(c).alias(c) for c in [*groups, *uniform]]).first()
    problems = [f"{found['n']} rows, not {rows}"] * (found["n"] != rows) + ["repeated keys"] * (found["keys"] != found["n"])
    problems += [f"{c}: {sorted(set(found[c]) ^ want, key=str)}" for c, want in groups.items() if set(found[c]) != want]
    return problems + [f"{c} is not uniform" for c in uniform if len(found[c]) != 1]


def resolve(index: DataFrame, own: DataFrame, parent: DataFrame, key: str, value: str) -> DataFrame:
    """Each indexed key with its value: of its own manifest if it has one, else of the parent's; null is unresolved."""
    a, b = (t.select(F.col(key).alias("__k"), F.col(value).alias("__v")) for t in (own, parent))
    first = index.join(a, F.col(key) == F.col("__k"), "left").withColumnRenamed("__v", "__own").drop("__k")
    both = first.join(b, F.col(key) == F.col("__k"), "left").drop("__k")
    origin = F.when(F.col("__own").isNotNull(), "own").when(F.col("__v").isNotNull(), "parent").otherwise("unresolved")
    return both.select(*index.columns, F.coalesce("__own", "__v").alias(value), origin.alias("origin"))


def upsert(existing: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Rows of the changes, and those that they don't touch."""
    return existing.join(changes.select(key), key, "left_anti").select(*existing.columns).unionByName(changes.select(*existing.columns))


def hash_files(spark: SparkSession, folder: str) -> DataFrame:
    """``path, bytes, sha256`` of every file below a folder, hashed where it is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
