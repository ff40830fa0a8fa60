"""Sinks: scene layers as text, metadata-only layers, flat tables, and the line of import statistics.

A layer is a table of lines with their order, so that the splats of a large asset are written by many tasks; the part
files, one after the other, are the layer.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from splatframe.operators import clouds as C
from splatframe.operators.diagnostics import code_of
from splatframe.sources.errors import SourceError

LINES = "asset_id string, part int, at long, line string"
SCAFFOLD = ("#usda 1.0", "(", '    defaultPrim = "Asset"', "    metersPerUnit = 1", '    upAxis = "Y"', ")", "", 'def Xform "Asset" (', "    customData = {")
SPLAT = ("    }", '    kind = "component"', ")", "{", '    def ParticleField3DGaussianSplat "Splat"', "    {")


def _lines(meta: DataFrame, part: int, lines: list[Column]) -> DataFrame:
    return meta.select("asset_id", F.lit(part).alias("part"), F.posexplode(F.array(*lines)).alias("at", "line")).withColumn("at", F.col("at").cast("long"))


def metadata_lines(meta: DataFrame, source_format: str) -> DataFrame:
    """The scaffold alone, from (asset_id, gaussian_count, sh_degree): no array and no extent."""
    text = lambda name: F.col(name).cast("string")
    data = [F.concat(F.lit('        uint64 "gs:gaussianCount" = '), text("gaussian_count")), F.concat(F.lit('        int "gs:shDegree" = '), text("sh_degree")), F.lit(f'        string "gs:sourceFormat" = "{source_format}"')]
    degree = F.concat(F.lit("        int radiance:sphericalHarmonicsDegree = "), text("sh_degree"))
    return _lines(meta, 0, [*map(F.lit, SCAFFOLD), *data, *map(F.lit, SPLAT), degree]).unionByName(_lines(meta, 9, [F.lit("    }"), F.lit("}")]))


def number(c: Column) -> Column:
    """Shortest text of a float32."""
    return F.regexp_replace(c.cast("float").cast("string"), r"\.0($|E)", "$1")


def tuple_of(c: str, names: str) -> Column:
    return F.concat(F.lit("("), F.concat_ws(", ", *[number(F.col(f"{c}.{n}")) for n in names]), F.lit(")"))


def layer_lines(cloud: DataFrame, meta: DataFrame, source_format: str) -> DataFrame:
    """(asset_id, part, at, line) of whole layers: scaffold, extent, and the arrays in the order of gidx.

    The cloud has to have passed the gate. An extent beyond float32 raises the format's code.
    """
    bounds = C.extent(cloud, "asset_id")
    if not bounds.filter("overflow").isEmpty():
        raise SourceError(code_of(source_format, "extent_overflow"), "an extent exceeds float32")
    corner = lambda m: F.concat(F.lit("("), F.concat_ws(", ", *[number(F.col(f"{m}_{a}")) for a in "xyz"]), F.lit(")"))
    extent = _lines(bounds, 1, [F.concat(F.lit("        float3[] extent = ["), corner("min"), F.lit(", "), corner("max"), F.lit("]"))])
    triple = lambda c: F.concat(F.lit("("), F.concat_ws(", ", *[number(c[x]) for x in "rgb"]), F.lit(")"))
    arrays = {
        "float[] opacities": number(F.col("opacity")), "quatf[] orientations": tuple_of("rotation", "wijk"), "point3f[] positions": tuple_of("position", "xyz"), "float3[] scales": tuple_of("scale", "xyz"),
        "float3[] radiance:sphericalHarmonicsCoefficients": F.concat_ws(", ", F.transform(F.concat(F.array("dc"), F.col("rest")), triple)),
    }
    end = F.when(F.col("gidx") == F.col("gaussian_count") - 1, "]").otherwise(",")
    line = lambda name, value: F.concat(F.when(F.col("gidx") == 0, f"        {name} = [").otherwise(""), value, end)
    each = F.explode(F.array(*[F.struct(F.lit(2 + k).alias("part"), line(n, v).alias("line")) for k, (n, v) in enumerate(arrays.items())])).alias("l")
    rows = cloud.join(meta.select("asset_id", "gaussian_count"), "asset_id").select("asset_id", F.col("gidx").alias("at"), each).select("asset_id", "l.part", "at", "l.line")
    return metadata_lines(meta, source_format).unionByName(extent).unionByName(rows)


def write_layers(lines: DataFrame, path: str) -> None:
    """A folder per asset; its part files in the order of their names are the layer."""
    lines.repartitionByRange("asset_id", "part", "at").sortWithinPartitions("asset_id", "part", "at").select("asset_id", F.col("line").alias("value")).write.partitionBy("asset_id").text(path)


def write_flat(cloud: DataFrame, path: str) -> None:
    """The binary form: one Parquet table."""
    cloud.write.parquet(path)


def write_back(source_format: str) -> None:
    """Source files are never written back."""
    raise SourceError(code_of(source_format, "write_unsupported"), f"writing {source_format} files is not supported")


def stats_lines(cloud: DataFrame, meta: DataFrame) -> DataFrame:
    """(asset_id, line): one line a file, from its metadata, its cloud's extent (none beyond float32) and the timings
    read_seconds, decode_seconds and author_seconds, if meta has them."""
    numbers = C.decoded_bytes(cloud, "asset_id").drop("gaussians").join(C.extent(cloud, "asset_id"), "asset_id")
    took = [c for c in ("read_seconds", "decode_seconds", "author_seconds") if c in meta.columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                parts = ["import", f'format="{r["source_format"]}"', *([f'version="{r["source_version"]}"'] if r["source_version"] else []), f"gaussians={r['gaussian_count']}", f"shDegree={r['sh_degree']}", f"sourceBytes={r['source_bytes']}", f"decodedBytes={r['decoded_bytes']}"]
                if not r["overflow"]:
                    parts += [f"bounds{m.title()}=" + ",".join(f"{r[f'{m}_{a}']:.6g}" for a in "xyz") for m in ("min", "max")]
                parts += [f"{n}Seconds={r.get(f'{n}_seconds') or 0.0:.6g}" for n in ("read", "decode", "author")]
                out.append(" ".join(parts))
            yield pa.RecordBatch.from_pydict({"asset_id": batch.column("asset_id"), "line": pa.array(out, pa.string())})

    columns = ["source_format", "source_version", "gaussian_count", "sh_degree", "source_bytes", *took]
    text = F.col("asset_id").cast("string").alias("asset_id")
    return meta.select("asset_id", *columns).join(numbers, "asset_id").withColumn("asset_id", text).mapInArrow(run, "asset_id string, line string")
