"""Raw point rows -> decoded cloud in the model frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from splatframe.functions import kernels as K


def raw_from_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The embeddings table read as raw degree-3 points: one row a point, gidx its id, asset_id its label."""
    e = lambda k, by=1.0: (F.col("embedding")[k].cast("double") * by)
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(
        F.col("label").alias("asset_id"), F.col("vec_id").alias("gidx"), *[e(k, 100.0).alias(c) for k, c in enumerate("xyz")],
        *[e(3 + k, 10.0).alias(f"scale_{k}") for k in range(3)], *[e(6 + k).alias(f"rot_{k}") for k in range(4)], e(10, 20.0).alias("opacity"),
        *[e(11 + k).alias(f"f_dc_{k}") for k in range(3)], F.transform(F.slice("embedding", 15, 45), lambda v: v.cast("double")).alias("f_rest"),
    )


def decode(raw: DataFrame) -> DataFrame:
    """position, scale, rotation, opacity, dc and rest of each point as float32, in the model's frame, with the decoding's
    flags."""
    c = lambda *names: [F.col(n) for n in names]
    unit, replaced, changed = K.normalize(c("rot_0", "rot_1", "rot_2", "rot_3"))
    p, q = K.flip_position(c("x", "y", "z")), K.flip_rotation(unit)
    single = lambda vs, names: F.struct(*[v.cast("float").alias(n) for v, n in zip(vs, names, strict=True)])
    return raw.select(
        "asset_id", "gidx", single(p, "xyz").alias("position"), single([K.log_scale(F.col(f"scale_{k}")) for k in range(3)], "xyz").alias("scale"),
        single(q, "wijk").alias("rotation"), K.sigmoid(F.col("opacity")).cast("float").alias("opacity"), single(c("f_dc_0", "f_dc_1", "f_dc_2"), "rgb").alias("dc"),
        K.model_rest(F.col("f_rest")).alias("rest"), replaced.alias("was_replaced"), changed.alias("was_changed"),
    )
