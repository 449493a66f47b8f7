"""Rasters as pixel tables: exact overlap weights, zonal aggregates, moving disks, regridding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions.stats import entropy_bits


def pixel_weights(pixels: DataFrame, pixel: float, unit: float, shift: float = 0.0) -> DataFrame:
    """Each pixel with the cells that it overlaps: ``u_col, u_row, fraction`` of the pixel's area in the cell.

    Both grids lie along the axes, so the overlap is closed form; ``shift`` moves the pixels against the cells.
    """

    def reach(index: Column) -> Column:
        lo = index * pixel + shift
        return F.explode(F.sequence(F.floor(lo / unit).cast("long"), (F.ceil((lo + pixel) / unit) - 1).cast("long")))

    def share(index: Column, cell: Column) -> Column:
        lo = index * pixel + shift
        return (F.least(lo + pixel, (cell + 1) * unit) - F.greatest(lo, cell * unit)) / pixel

    dealt = pixels.withColumn("u_col", reach(F.col("col"))).withColumn("u_row", reach(F.col("row")))
    return dealt.withColumn("fraction", share(F.col("col"), F.col("u_col")) * share(F.col("row"), F.col("u_row")))


def weighted_sum(weights: DataFrame, pixel: float, unit: float) -> DataFrame:
    """By cell: sum of value by fraction over valid pixels, covered and no-data shares of the cell's area."""
    share = pixel * pixel / (unit * unit)
    valid = F.col("value").isNotNull()
    return weights.groupBy("u_col", "u_row").agg(
        F.coalesce(F.sum(F.col("value") * F.col("fraction")), F.lit(0.0)).alias("total"),
        (F.sum(F.when(valid, F.col("fraction")).otherwise(0.0)) * share).alias("valid_share"),
        (F.sum(F.when(~valid, F.col("fraction")).otherwise(0.0)) * share).alias("nodata_share"),
    )


def class_fractions(weights: DataFrame, pixel: float, unit: float, rollups: dict[str, list[int]], nodata: int = 0, not_land: tuple[int, ...] = (80,)) -> DataFrame:
    """By cell: share of its area that is valid, that is land, and of each group of classes, in one aggregation."""
    part = F.col("fraction") * (pixel * pixel / (unit * unit))
    share = lambda condition: F.sum(F.when(condition, part).otherwise(0.0))
    c = F.col("class")
    groups = [share(c.isin(classes)).alias(f"{name}_ratio") for name, classes in rollups.items()]
    return weights.groupBy("u_col", "u_row").agg(share(c != nodata).alias("valid_share"), share((c != nodata) & ~c.isin(*not_land)).alias("land_share"), *groups)


def zonal_classes(pixels: DataFrame, pixel: float, unit: float, nodata: int = 0, water: int = 80) -> DataFrame:
    """By cell, pixels by their centres: entropy in bits, share of the most frequent class, share of land, pixels."""
    cell = lambda c: F.floor((F.col(c) + 0.5) * pixel / unit).cast("long")
    counts = pixels.where(F.col("class") != nodata).groupBy(cell("col").alias("u_col"), cell("row").alias("u_row"), "class").agg(F.count(F.lit(1)).alias("n"))
    total = counts.groupBy("u_col", "u_row").agg(F.sum("n").alias("pixels"), F.max("n").alias("most"), F.sum(F.when(F.col("class") != water, F.col("n")).otherwise(0)).alias("land"))
    entropy = counts.join(total, ["u_col", "u_row"]).groupBy("u_col", "u_row").agg(entropy_bits(F.col("n") / F.col("pixels")).alias("entropy"))
    return entropy.join(total, ["u_col", "u_row"]).select("u_col", "u_row", "entropy", (F.col("most") / F.col("pixels")).alias("dominance"), (F.col("land") / F.col("pixels")).alias("land_share"), "pixels")


def zonal_values(pixels: DataFrame, pixel: float, unit: float) -> DataFrame:
    """By cell, pixels by their centres, values clipped to 0..1: mean, sample variance (null for one), no-data share."""
    cell = lambda c: F.floor((F.col(c) + 0.5) * pixel / unit).cast("long")
    v = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("value")))
    clipped = F.when(F.col("value").isNotNull(), v)
    return pixels.groupBy(cell("col").alias("u_col"), cell("row").alias("u_row")).agg(F.avg(clipped).alias("mean"), F.var_samp(clipped).alias("variance"), F.avg(F.col("value").isNull().cast("double")).alias("nodata_share"))


def masked_share(built: DataFrame, land: DataFrame, pixel: float, land_pixel: float, unit: float) -> DataFrame:
    """Built area inside land over land area, by cell: three grids meet on equal indices, pieces by pieces.

    Land pixels are whole multiples of the fine ones, so a fine pixel lies in one land pixel and in one cell.
    """
    ratio = int(land_pixel // pixel)
    fine = built.where("value is not null").select("value", F.floor(F.col("col") / ratio).cast("long").alias("lc"), F.floor(F.col("row") / ratio).cast("long").alias("lr"))
    dry = land.where("class not in (0, 80)").select(F.col("col").alias("lc"), F.col("row").alias("lr"))
    cell = lambda c: F.floor(F.col(c) * land_pixel / unit).cast("long")
    inside = fine.groupBy("lc", "lr").agg((F.sum("value") * pixel * pixel).alias("built"))
    joined = dry.join(inside, ["lc", "lr"], "left")
    return joined.groupBy(cell("lc").alias("u_col"), cell("lr").alias("u_row")).agg(F.coalesce(F.sum("built"), F.lit(0.0)).alias("built_m2"), (F.count(F.lit(1)) * land_pixel * land_pixel).alias("land_m2"))


def disk_sum(cells: DataFrame, value: str, radius: float, size: float) -> DataFrame:
    """Moving sum over cells whose centres are within ``radius``: offsets are exploded, so sums are exact."""
    k = int(radius // size)
    steps = [(i, j) for i in range(-k, k + 1) for j in range(-k, k + 1) if (i * i + j * j) * size * size <= radius * radius]
    moved = cells.withColumn("s", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in steps])))
    return moved.groupBy((F.col("col") + F.col("s.i")).alias("col"), (F.col("row") + F.col("s.j")).alias("row")).agg(F.sum(value).alias(value))


def lookup(points: DataFrame, pixels: DataFrame, pixel: float) -> DataFrame:
    """Points with the value of the pixel below them; null outside."""
    at = points.withColumn("__c", F.floor(F.col("x") / pixel).cast("long")).withColumn("__r", F.floor(F.col("y") / pixel).cast("long"))
    return at.join(pixels.withColumnsRenamed({"col": "__c", "row": "__r"}), ["__c", "__r"], "left").drop("__c", "__r")


def empty_edges(pixels: DataFrame, rows: int) -> DataFrame:
    """Leading and trailing rows of a raster without any valid pixel."""
    full = pixels.where("value is not null").agg(F.min("row").alias("a"), F.max("row").alias("b"))
    return full.select(F.coalesce("a", F.lit(rows)).cast("long").alias("leading"), F.coalesce(rows - 1 - F.col("b"), F.lit(0)).cast("long").alias("trailing"))
