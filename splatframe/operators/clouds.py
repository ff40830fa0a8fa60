"""Operators on decoded clouds."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from splatframe.functions import kernels as K

AXES = ("x", "y", "z")
#: The checks of a row in the order in which they count; the mapping to each format's codes is in diagnostics.
CHECKS = ("position", "scale", "rotation", "opacity", "dc", "norm", "rest")


def radius() -> Column:
    return K.to_float32(3.0 * F.greatest("scale.x", "scale.y", "scale.z"))


def extent(cloud: DataFrame, *by: str) -> DataFrame:
    """Bounds of three-sigma spheres; overflow: whether a radius is beyond float32 (the bounds don't count then)."""
    r = radius()
    low = [F.min(F.col(f"position.{a}") - r).alias(f"min_{a}") for a in AXES]
    high = [F.max(F.col(f"position.{a}") + r).alias(f"max_{a}") for a in AXES]
    return cloud.groupBy(*by).agg(*low, *high, F.bool_or(F.coalesce(~K.finite(r), F.lit(True))).alias("overflow"))


def violations(cloud: DataFrame) -> DataFrame:
    """(asset_id, gidx, check): every failed check of every row."""
    ok = lambda c: F.coalesce(K.finite(F.col(c)), F.lit(False))
    every = lambda cs: _all([ok(c) for c in cs])
    q = [F.col(f"rotation.{k}") for k in "wijk"]
    failed = {
        "position": ~every([f"position.{a}" for a in AXES]),
        "scale": ~(every([f"scale.{a}" for a in AXES]) & _all([F.coalesce(F.col(f"scale.{a}") > 0, F.lit(False)) for a in AXES])),
        "rotation": ~every([f"rotation.{k}" for k in "wijk"]),
        "opacity": ~(ok("opacity") & F.coalesce(F.col("opacity").between(0, 1), F.lit(False))),
        "dc": ~every([f"dc.{k}" for k in "rgb"]),
        "norm": ~F.coalesce(F.abs(F.sqrt(K.norm_squared(q)) - 1) <= 1e-4, F.lit(False)),
        "rest": ~F.coalesce(F.forall("rest", lambda c: K.finite(c["r"]) & K.finite(c["g"]) & K.finite(c["b"])), F.lit(False)),
    }
    found = F.filter(F.array(*[F.when(failed[c], F.lit(c)) for c in CHECKS]), lambda c: c.isNotNull())
    return cloud.select("asset_id", "gidx", F.explode(found).alias("check"))


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def first_violation(cloud: DataFrame) -> DataFrame:
    """(asset_id, gidx, check): rows are checked for values first, then rest coefficients; the first in row order."""
    order = F.array_position(F.array(*map(F.lit, CHECKS)), F.col("check"))
    late = (F.col("check") == "rest").cast("int")
    best = violations(cloud).groupBy("asset_id").agg(F.min(F.struct(late.alias("late"), F.col("gidx"), order.alias("order"), F.col("check"))).alias("f"))
    return best.select("asset_id", "f.gidx", "f.check")


def warning_counts(cloud: DataFrame, *by: str) -> DataFrame:
    return cloud.groupBy(*by).agg(F.count_if(F.col("was_changed") & ~F.col("was_replaced")).alias("normalised"), F.count_if("was_replaced").alias("replaced"))


def decoded_bytes(cloud: DataFrame, *by: str) -> DataFrame:
    return cloud.groupBy(*by).agg(F.count("*").alias("gaussians"), (F.count("*") * 56 + F.coalesce(F.sum(F.size("rest")), F.lit(0)) * 12).cast("long").alias("decoded_bytes"))


def opacity_at_least(cloud: DataFrame, threshold: float) -> DataFrame:
    return cloud.filter(F.col("opacity") >= F.lit(threshold).cast("float"))  # compared as float32


def inside(raw: DataFrame, low: tuple[float, float, float], high: tuple[float, float, float]) -> DataFrame:
    if any(a > b for a, b in zip(low, high, strict=True)):
        raise ValueError("the box is empty")
    return raw.filter(_all([F.col(a).between(lo, hi) for a, lo, hi in zip(AXES, low, high, strict=True)]))


def candidates(raw: DataFrame, low: tuple[float, float, float], high: tuple[float, float, float]) -> DataFrame:
    """(asset_id, source_count, candidates): splats of each asset and those inside the box."""
    hit = _all([F.col(a).between(lo, hi) for a, lo, hi in zip(AXES, low, high, strict=True)])
    return raw.groupBy("asset_id").agg(F.count("*").alias("source_count"), F.count_if(hit).alias("candidates"))


def most_opaque(df: DataFrame, n: int) -> DataFrame:
    """The n rows of greatest opacity, ties to the smaller gidx, in source order."""
    return df.orderBy(F.desc("opacity"), "gidx").limit(n).orderBy("gidx")


def reindexed(df: DataFrame) -> DataFrame:
    """Adds row: 0.. by gidx within each asset. Rows are numbered in ranges of gidx, so one asset is no single task."""
    ranged = df.withColumn("_range", F.floor(F.col("gidx") / 65_536))
    sizes = ranged.groupBy("asset_id", "_range").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("asset_id").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("asset_id", "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = Window.partitionBy("asset_id", "_range").orderBy("gidx")
    return ranged.withColumn("_in", F.row_number().over(place)).join(sizes, ["asset_id", "_range"]).withColumn("row", (F.col("_before") + F.col("_in") - 1).cast("long")).drop("_range", "_before", "_in")


class OptionError(ValueError):
    """A bad import option."""


def import_options(options: dict[str, str]) -> dict[str, float | int]:
    """shDegree 0..3, opacityThreshold 0..1 and scaleMultiplier > 0; unknown keys are ignored."""
    out: dict[str, float | int] = {}
    if (v := options.get("shDegree")) is not None:
        if not re.fullmatch(r"[0-3]", v):
            raise OptionError(f"shDegree {v!r}")
        out["shDegree"] = int(v)
    for key, ok in (("opacityThreshold", lambda x: 0 <= x <= 1), ("scaleMultiplier", lambda x: x > 0)):
        if (v := options.get(key)) is not None:
            if not re.fullmatch(r"[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?", v) or not math.isfinite(float(v)) or not ok(float(v)):
                raise OptionError(f"{key} {v!r}")
            out[key] = float(v)
    return out


def with_options(cloud: DataFrame, options: dict[str, str]) -> DataFrame:
    """Scale multiplier, then opacity threshold, then the cap of the rest coefficients."""
    o = import_options(options)
    if "scaleMultiplier" in o:
        cloud = cloud.withColumn("scale", F.struct(*[(F.col(f"scale.{a}") * F.lit(o["scaleMultiplier"]).cast("float")).cast("float").alias(a) for a in AXES]))
    if "opacityThreshold" in o:
        cloud = opacity_at_least(cloud, o["opacityThreshold"])
    if "shDegree" in o:
        cloud = cloud.withColumn("rest", K.cap_rest(F.col("rest"), F.lit(o["shDegree"])))
    return cloud


def codebook_lookup(codes: DataFrame, code: str, codebook: DataFrame) -> DataFrame:
    """Adds value from codebook (idx, value), which has 256 rows at most and so is broadcast; a larger one is refused."""
    if (n := codebook.count()) > 256:
        raise ValueError(f"a codebook has 256 entries, not {n}")
    return codes.join(F.broadcast(codebook.withColumnRenamed("idx", code)), code, "left")


def palette_lookup(labels: DataFrame, palette: DataFrame, width: int) -> DataFrame:
    """rest of each row by its label in palette (label, rest); out_of_range rows get zero triples. A palette can have
    65,536 rows of 15 triples; whether it is broadcast is left to its size."""
    zero = F.array_repeat(F.struct(*[F.lit(0.0).alias(k) for k in "rgb"]), width)
    joined = labels.join(palette.withColumn("_hit", F.lit(True)), "label", "left")
    return joined.withColumn("out_of_range", F.col("_hit").isNull()).withColumn("rest", F.coalesce("rest", zero)).drop("_hit")


def compare(a: DataFrame, b: DataFrame, tolerance: float = 1e-6, extent_tolerance: float = 1e-5) -> DataFrame:
    """(asset_id, gidx, field): fields that differ, rotations up to sign; field missing: the row is on one side only;
    rest: its length or a coefficient differs; extent, without gidx: the bounds of an asset with as many rows on both
    sides differ, or can be computed on one side only."""
    pair = a.alias("a").join(b.alias("b"), ["asset_id", "gidx"], "full")
    off = lambda f: F.abs(F.col(f"a.{f}") - F.col(f"b.{f}")) > tolerance
    some = lambda fs: ~_all([~F.coalesce(off(f), F.lit(True)) for f in fs])
    q = K.align_sign([F.col(f"a.rotation.{k}") for k in "wijk"], [F.col(f"b.rotation.{k}") for k in "wijk"])
    turned = ~_all([F.coalesce(F.abs(c - F.col(f"b.rotation.{k}")) <= tolerance, F.lit(False)) for c, k in zip(q, "wijk", strict=True)])
    missing = F.col("a.opacity").isNull() | F.col("b.opacity").isNull()
    length = lambda side: F.when(F.col(f"{side}.rest").isNull(), F.lit(0)).otherwise(F.size(f"{side}.rest"))
    near = F.zip_with("a.rest", "b.rest", lambda x, y: _all([F.coalesce(F.abs(x[k] - y[k]) <= tolerance, F.lit(False)) for k in "rgb"]))
    rest = (length("a") != length("b")) | ~F.coalesce(F.forall(near, lambda c: c), F.lit(True))
    fields = [F.when(missing, F.lit("missing")), *[F.when(~missing & some([f"{n}.{k}" for k in ks]), F.lit(n)) for n, ks in (("position", AXES), ("scale", AXES), ("dc", "rgb"))], F.when(~missing & some(["opacity"]), F.lit("opacity")), F.when(~missing & turned, F.lit("rotation")), F.when(~missing & rest, F.lit("rest"))]
    found = pair.select("asset_id", "gidx", F.explode(F.filter(F.array(*fields), lambda f: f.isNotNull())).alias("field"))
    bounds = [f"{m}_{x}" for m in ("min", "max") for x in AXES]
    sides = [extent(c, "asset_id").join(c.groupBy("asset_id").agg(F.count("*").alias("n")), "asset_id") for c in (a, b)]
    both = sides[0].alias("a").join(sides[1].alias("b"), "asset_id").filter("a.n = b.n")
    close = _all([F.coalesce(F.abs(F.col(f"a.{c}") - F.col(f"b.{c}")) <= extent_tolerance, F.lit(False)) for c in bounds])
    moved = F.when(F.col("a.overflow") | F.col("b.overflow"), F.col("a.overflow") != F.col("b.overflow")).otherwise(~close)
    return found.unionByName(both.filter(moved).select("asset_id", F.lit(None).cast(a.schema["gidx"].dataType).alias("gidx"), F.lit("extent").alias("field")))
