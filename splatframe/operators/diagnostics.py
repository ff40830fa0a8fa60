"""Codes of what can be wrong with a cloud or a file: one catalogue, and the gate that every cloud passes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from splatframe.operators import clouds as C
from splatframe.sources.errors import SourceError

#: Numbers and names of the diagnostics of each format.
CATALOGUE = {
    "ply": "E001 not_splats, E002 empty, E003 property_missing, E004 property_type, E005 rest_name, E006 rest_twice, E007 rest_gap, E008 rest_not_rgb, E009 degree_invalid, E010 value_not_finite, E011 rest_not_finite, "
    "E012 log_scale_range, E013 rotation_invalid, E014 length_mismatch, E015 unreadable, E016 cloud_invalid, E017 degree_unsupported, E018 allocation, E100 internal, E101 stage, E102 scaffold, E103 attribute, "
    "E104 extent_overflow, E201 option_invalid, E202 all_filtered, E203 write_unsupported, W001 rotations_normalised, W002 rotations_replaced, W003 properties_ignored",
    "spz": "E001 not_packed, E002 empty, E003 version, E004 malformed, E005 count_invalid, E006 degree_invalid, E007 cut_off, E008 corrupt, E009 trailing, E010 unreadable, E011 degree_unsupported, "
    "E012 position_not_finite, E013 cloud_invalid, E014 allocation, E100 internal, E101 stage, E102 scaffold, E103 attribute, E104 extent_overflow, E201 write_unsupported, W001 extensions_ignored, W002 antialiasing_ignored",
    "sog": "E002 not_planes, E003 version, E004 archive_malformed, E005 metadata_malformed, E006 count_invalid, E007 bands_invalid, E008 plane_missing, E009 plane_malformed, E010 unreadable, E011 codebook_invalid, "
    "E012 empty, E013 rotation_invalid, E014 cloud_invalid, E015 allocation, E100 internal, E101 stage, E102 scaffold, E103 attribute, E104 extent_overflow, E201 write_unsupported, W001 labels_out_of_range",
}
GATE = {"position": "value", "scale": "value", "rotation": "value", "opacity": "value", "dc": "value", "norm": "norm", "rest": "rest"}


def code_of(source_format: str, name: str) -> str:
    """The code by which a format reports what other modules know by name only."""
    for entry in CATALOGUE[source_format].split(", "):
        if entry.endswith(f" {name}"):
            return f"SF-{source_format.upper()}-{entry.split()[0]}"
    raise KeyError(f"{source_format} has no diagnostic {name}")


def catalogue(spark: SparkSession) -> DataFrame:
    """(source_format, code, name, severity): warnings never stop an import, errors always do."""
    rows = [(f, f"SF-{f.upper()}-{e.split()[0]}", e.split()[1], "warning" if e.startswith("W") else "error") for f, text in CATALOGUE.items() for e in text.split(", ")]
    return spark.createDataFrame(rows, "source_format string, code string, name string, severity string")


def gate(cloud: DataFrame, meta: DataFrame) -> DataFrame:
    """(asset_id, gidx, problem) of each asset in meta (asset_id, gaussian_count, sh_degree): its first problem, or null.

    In this order: count (none), length (as many rows as declared, numbered without gaps), degree (0..3), rest_length,
    then the first row with a bad value or norm, then the first with a bad rest coefficient.
    """
    wide = F.size("rest")
    seen = cloud.groupBy("asset_id").agg(F.count("*").alias("n"), F.min("gidx").alias("first"), F.max("gidx").alias("last"), F.count_distinct("gidx").alias("ids"), F.min(wide).alias("least"), F.max(wide).alias("most"))
    joined = meta.join(seen, "asset_id", "left").join(C.first_violation(cloud).withColumnsRenamed({"gidx": "bad", "check": "failed"}), "asset_id", "left")
    n, degree = F.col("gaussian_count"), F.col("sh_degree")
    complete = F.coalesce((F.col("n") == n) & (F.col("ids") == n) & (F.col("first") == 0) & (F.col("last") == n - 1), F.lit(False))
    width = (degree + 1) * (degree + 1) - 1
    named = F.create_map(*[F.lit(x) for kv in GATE.items() for x in kv])[F.col("failed")]
    problem = F.when(n <= 0, "count").when(~complete, "length").when(~degree.between(0, 3), "degree").when((F.col("least") != width) | (F.col("most") != width), "rest_length").otherwise(named)
    return joined.select("asset_id", F.when(problem == named, F.col("bad")).alias("gidx"), problem.alias("problem"))


def gated(cloud: DataFrame, meta: DataFrame, source_format: str) -> DataFrame:
    """cloud, after the gate; the first asset with a problem raises it under the format's code."""
    found = gate(cloud, meta).filter("problem is not null").orderBy("asset_id").first()
    if found:
        raise SourceError(code_of(source_format, "cloud_invalid"), f"{found['asset_id']}: {found['problem']}" + (f" at {found['gidx']}" if found["gidx"] is not None else ""))
    return cloud


def not_all_filtered(before: DataFrame, after: DataFrame, source_format: str = "ply") -> DataFrame:
    """(asset_id, code) of assets of which a filter leaves no row."""
    gone = before.select("asset_id").distinct().join(after.select("asset_id").distinct(), "asset_id", "left_anti")
    return gone.select("asset_id", F.lit(code_of(source_format, "all_filtered")).alias("code"))


def warnings(cloud: DataFrame, source_format: str = "ply") -> DataFrame:
    """(asset_id, code, n, message) of each kind of warning that an asset gives."""
    counts = C.warning_counts(cloud, "asset_id")
    kinds = [("normalised", "rotations_normalised", "rotation was normalised", "rotations were normalised"), ("replaced", "rotations_replaced", "rotation was replaced", "rotations were replaced")]
    each = [F.struct(F.lit(code_of(source_format, name)).alias("code"), F.col(c).alias("n"), F.concat(F.col(c).cast("string"), F.lit(" "), F.when(F.col(c) == 1, one).otherwise(many)).alias("message")) for c, name, one, many in kinds]
    return counts.select("asset_id", F.explode(F.array(*each)).alias("w")).select("asset_id", "w.*").filter("n > 0")


def unknown_properties(properties: Column, known: list[str]) -> Column:
    """The names that are neither known nor rest coefficients, sorted."""
    return F.array_sort(F.filter(F.array_except(properties, F.array(*map(F.lit, known))), lambda p: ~p.rlike(r"^f_rest_[0-9]+$")))


def zipped(columns: dict[str, DataFrame]) -> DataFrame:
    """One row per (asset_id, gidx) with each part's value column under its name; an asset whose parts don't have the
    same places has rows with `whole` false."""
    names, out = list(columns), None
    for name, df in columns.items():
        part = df.select("asset_id", "gidx", F.col("value").alias(name), F.lit(True).alias(f"_{name}"))
        out = part if out is None else out.join(part, ["asset_id", "gidx"], "full")
    whole = F.lit(True)
    for n in names:
        whole &= F.coalesce(F.col(f"_{n}"), F.lit(False))
    return out.select("asset_id", "gidx", *names, whole.alias("whole"))


def mismatch_counts(a: DataFrame, b: DataFrame, tolerances: dict[str, float] | None = None) -> DataFrame:
    """(field, n): how many rows differ in each field."""
    found = None
    for name, tolerance in {"": 1e-6, **(tolerances or {})}.items():
        part = C.compare(a, b, tolerance)
        part = part.filter(F.col("field") == name) if name else part.filter(~F.col("field").isin(list(tolerances or {})))
        found = part if found is None else found.unionByName(part)
    return found.groupBy("field").agg(F.count("*").alias("n"))


def checked_rest_length(count: Column, degree: Column) -> Column:
    """Coefficients of all splats, null where the degree is none of 0..3 or the number leaves 64 bits."""
    each = F.when(degree.between(0, 3), ((degree + 1) * (degree + 1) - 1).cast("long"))
    return F.try_multiply(count.cast("long"), each)
