"""Files of splats as DataFrames. asset_id is a file's path, gidx a splat's place in it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from splatframe.functions import kernels as K
from splatframe.sources import ply, sog, spz
from splatframe.sources.errors import SourceError

#: Rows of one Arrow batch.
BATCH = 1 << 14
META = "asset_id string, source_format string, source_version string, gaussian_count long, sh_degree int, source_bytes long, code string, message string"
PLY_RAW = "asset_id string, gidx long, " + ", ".join(f"{n} float" for n in ply.REQUIRED) + ", f_rest array<float>"
SPZ_RAW = "asset_id string, gidx long, version int, fraction_bits int, position array<int>, alpha int, color array<int>, scale array<int>, rotation array<int>, sh array<int>"


def _files(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", f"*.{suffix}").load(path).select("path", "content")


def metadata(spark: SparkSession, path: str) -> DataFrame:
    return metadata_of(_files(spark, path, "{ply,spz,sog,json}"))


def metadata_batch(path: str, data: bytes, size: int | None = None) -> pa.RecordBatch:
    kind = path.rsplit(".", 1)[-1].lower()
    row = {"asset_id": path, "source_format": kind, "source_version": None, "gaussian_count": None, "sh_degree": None, "source_bytes": len(data) if size is None else size, "code": None, "message": None}
    try:
        if kind == "ply":
            h = ply.parse_header(data)
            row |= {"source_version": "1.0", "gaussian_count": h.count, "sh_degree": ply.layout(h)[0]}
        elif kind == "spz":
            h = spz.read_header(data)
            row |= {"source_version": str(h.version), "gaussian_count": h.count, "sh_degree": h.degree}
        else:
            m = sog.opened(data)[0]
            row |= {"source_format": "sog", "source_version": str(m.version), "gaussian_count": m.count, "sh_degree": m.degree}
    except SourceError as e:
        row |= {"code": e.code, "message": e.message}
    return pa.RecordBatch.from_pylist([row], pa.schema([(n.split()[0], {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}[n.split()[1]]) for n in META.split(", ")]))


def _each(files: DataFrame, batches_of, schema: str) -> DataFrame:
    """The batches that batches_of(path, bytes) makes of each file (path, content)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                yield from batches_of(path, content.as_py())

    return files.select("path", "content").mapInArrow(run, schema)


def metadata_of(files: DataFrame) -> DataFrame:
    """One row a file (path, content), from headers alone; code and message tell what is wrong with one, and are null
    otherwise."""
    return _each(files, lambda path, data: [metadata_batch(path, data)], META)


def _lists(rows: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * rows.shape[1], pa.int32()), pa.array(np.ascontiguousarray(rows).ravel(), kind))


def read_ply(spark: SparkSession, path: str) -> DataFrame:
    return ply_rows(_files(spark, path, "ply"))


def ply_rows(files: DataFrame) -> DataFrame:
    """Raw splats of files (path, content), ready for plans.cloud.decode; a bad file fails the action with its code."""
    return _each(files, ply_batches, PLY_RAW)


def ply_batches(path: str, data: bytes) -> Iterator[pa.RecordBatch]:
    h = ply.parse_header(data)
    yield from ply_columns(path, 0, *ply.read_columns(data, h, ply.layout(h)[1]))


def ply_columns(path: str, first: int, columns: dict[str, np.ndarray], rest: np.ndarray) -> Iterator[pa.RecordBatch]:
    for a in range(0, len(rest), BATCH):
        b = min(a + BATCH, len(rest))
        yield pa.RecordBatch.from_arrays([pa.array([path] * (b - a)), pa.array(np.arange(first + a, first + b)), *[pa.array(columns[n][a:b]) for n in ply.REQUIRED], _lists(rest[a:b], pa.float32())], ["asset_id", "gidx", *ply.REQUIRED, "f_rest"])


def read_spz(spark: SparkSession, path: str) -> DataFrame:
    return spz_codes(_files(spark, path, "spz"))


def spz_codes(files: DataFrame) -> DataFrame:
    """Codes of packed splats of files (path, content); decode_spz() makes a cloud of them."""
    return _each(files, spz_batches, SPZ_RAW)


def spz_batches(path: str, data: bytes) -> Iterator[pa.RecordBatch]:
    h, s = spz.read_streams(data)
    for a in range(0, h.count, BATCH):
        n = min(BATCH, h.count - a)
        t = {k: v[a : a + n].astype(np.int32) for k, v in s.items()}
        wide = 2 if h.version == 1 else 3
        codes = (t["positions"].reshape(n, 3, wide) << (8 * np.arange(wide, dtype=np.int32))).sum(axis=2)
        if wide == 2 and ((codes >> 10 & 31) == 31).any():
            spz.fail("E012", "a position is not finite")
        same = [pa.array(np.full(n, x, np.int32)) for x in (h.version, h.fraction_bits)]
        yield pa.RecordBatch.from_arrays([pa.array([path] * n), pa.array(np.arange(a, a + n)), *same, _lists(codes, pa.int32()), pa.array(t["alphas"][:, 0]), *[_lists(t[k], pa.int32()) for k in ("colors", "scales", "rotations", "sh")]], [c.split()[0] for c in SPZ_RAW.split(", ")])


def decode_spz(raw: DataFrame) -> DataFrame:
    """The cloud of packed splats; they are in the model's frame already. Columns as those of plans.cloud.decode."""
    at = lambda name, k: F.col(name)[k]
    p = [F.when(F.col("version") == 1, K.half_to_float(at("position", k))).otherwise(K.fixed24(at("position", k), F.col("fraction_bits"))) for k in range(3)]
    # in steps, as one expression would repeat the unpacking for every use of a component
    word = F.when(F.col("version") == 3, sum((at("rotation", k).cast("long") * (1 << 8 * k) for k in range(1, 4)), at("rotation", 0).cast("long")))
    few = K.first_three([at("rotation", k) for k in range(3)])
    raw = raw.withColumn("word", word)
    raw = raw.withColumns({f"q{k}": F.when(F.col("version") == 3, a).otherwise(b) for k, (a, b) in enumerate(zip(K.smallest_three(F.col("word")), few, strict=True))})
    unit, replaced, changed = K.normalize([F.col(f"q{k}") for k in range(4)])
    rest = F.transform(F.sequence(F.lit(0), (F.size("sh") / 3).cast("int") - 1), lambda k: F.struct(*[K.spz_sh(F.element_at("sh", (3 * k + c + 1).cast("int"))).cast("float").alias(n) for c, n in enumerate("rgb")]))
    single = lambda vs, names: F.struct(*[v.cast("float").alias(n) for v, n in zip(vs, names, strict=True)])
    return raw.select(
        "asset_id", "gidx", single(p, "xyz").alias("position"), single([K.spz_scale(at("scale", k)) for k in range(3)], "xyz").alias("scale"), single(unit, "wijk").alias("rotation"),
        K.spz_alpha(F.col("alpha")).cast("float").alias("opacity"), single([K.spz_color(at("color", k)) for k in range(3)], "rgb").alias("dc"),
        F.when(F.size("sh") > 0, rest).otherwise(F.array().cast("array<struct<r:float,g:float,b:float>>")).alias("rest"), replaced.alias("was_replaced"), changed.alias("was_changed"),
    )


SOG_RAW = "asset_id string, gidx long, " + ", ".join(f"{n} array<float>" for n in ("position", "scale", "rotation")) + ", opacity float, dc array<float>, rest array<float>, label_beyond long"


def sog_rows(asset: str, data: bytes, beside: sog.Loader | None = None) -> Iterator[pa.RecordBatch]:
    """Splats of one file in its own frame; label_beyond: how many of the batch have no palette row, in its first row."""
    meta = sog.read(data, beside)
    for a in range(0, meta.count, BATCH):
        c, beyond = sog.columns(meta, a, min(a + BATCH, meta.count))
        n = len(c["opacity"])
        parts = {"asset_id": pa.array([asset] * n), "gidx": pa.array(np.arange(a, a + n))} | {k: _lists(c[k], pa.float32()) for k in ("position", "scale", "rotation")}
        parts |= {"opacity": pa.array(c["opacity"]), "dc": _lists(c["dc"], pa.float32()), "rest": _lists(c["rest"].reshape(n, -1), pa.float32()), "label_beyond": pa.array([beyond] + [0] * (n - 1))}
        yield pa.RecordBatch.from_pydict(parts)


def sog_bundles(files: DataFrame) -> DataFrame:
    return _each(files, sog_rows, SOG_RAW)


def sog_folders(files: DataFrame) -> DataFrame:
    """Of a meta.json and planes in one folder; files has all of them, which meet by folder."""

    def run(group: pa.Table) -> pa.Table:
        held = {p.rsplit("/", 1)[-1]: (p, c) for p, c in zip(group.column("path").to_pylist(), group.column("content"), strict=True)}
        if sog.META not in held:
            return pa.Table.from_batches([], EMPTY_SOG)
        path, data = held[sog.META]
        return pa.Table.from_batches(list(sog_rows(path, data.as_py(), lambda name: held[name][1].as_py() if name in held else None)))

    folder = F.regexp_replace("path", r"/[^/]*$", "")
    return files.withColumn("_folder", folder).groupBy("_folder").applyInArrow(run, SOG_RAW)


EMPTY_SOG = pa.schema([("asset_id", pa.string()), ("gidx", pa.int64()), *[(n, pa.list_(pa.float32())) for n in ("position", "scale", "rotation")], ("opacity", pa.float32()), ("dc", pa.list_(pa.float32())), ("rest", pa.list_(pa.float32())), ("label_beyond", pa.int64())])


def read_sog(spark: SparkSession, path: str) -> DataFrame:
    """Splats of bundles (.sog) and of folders with a meta.json; decode_sog() makes a cloud of them."""
    return sog_bundles(_files(spark, path, "sog")).unionByName(sog_folders(_files(spark, path, "{json,webp}")))


def decode_sog(raw: DataFrame) -> DataFrame:
    """The cloud of image-plane splats, in the model's frame. Columns as those of plans.cloud.decode."""
    at = lambda name, n: [F.col(name)[k] for k in range(n)]
    single = lambda vs, names: F.struct(*[v.cast("float").alias(n) for v, n in zip(vs, names, strict=True)])
    triples = F.transform(F.sequence(F.lit(0), (F.size("rest") / 3).cast("int") - 1), lambda k: F.struct(*[F.element_at("rest", (3 * k + c + 1).cast("int")).alias(n) for c, n in enumerate("rgb")]))
    rest = F.when(F.size("rest") > 0, triples).otherwise(F.array().cast("array<struct<r:float,g:float,b:float>>"))
    turned = F.transform(K.flip_rest(rest), lambda c: single([c[x] for x in "rgb"], "rgb"))
    return raw.select(
        "asset_id", "gidx", single(K.flip_position(at("position", 3)), "xyz").alias("position"), single(at("scale", 3), "xyz").alias("scale"), single(K.flip_rotation(at("rotation", 4)), "wijk").alias("rotation"),
        "opacity", single(at("dc", 3), "rgb").alias("dc"), turned.alias("rest"), F.lit(False).alias("was_replaced"), F.lit(False).alias("was_changed"),
    )
