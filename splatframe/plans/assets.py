"""The embeddings table as splat files of every format: one file a label, its splats in the order of their ids."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from splatframe.plans.cloud import raw_from_embeddings
from splatframe.sources import ply, sog, spz

#: A palette has 65,536 rows at most: a splat of an image-plane file has the rest of this splat modulo PALETTE.
PALETTE = 1024


def _columns(group: pa.Table) -> tuple[dict[str, np.ndarray], np.ndarray]:
    group = group.sort_by("gidx")
    return {n: group.column(n).to_numpy() for n in ply.REQUIRED}, np.array(group.column("f_rest").to_pylist(), np.float64)


def _bytes(v: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(v), 0, 255).astype(np.uint8)


def _rotation(c: dict[str, np.ndarray]) -> np.ndarray:
    q = np.stack([c[f"rot_{k}"] for k in range(4)], 1)
    return q / np.sqrt((q**2).sum(1, keepdims=True))


def _opacity(c: dict[str, np.ndarray]) -> np.ndarray:
    return 1 / (1 + np.exp(-c["opacity"]))


def to_ply(c: dict[str, np.ndarray], rest: np.ndarray) -> bytes:
    return ply.encode(c, rest, ("comment made from a table",))


def to_spz(c: dict[str, np.ndarray], rest: np.ndarray) -> bytes:
    """Version 2 with 12 fraction bits."""
    n, q = len(rest), _rotation(c)
    code = np.rint(np.stack([c[a] for a in "xyz"], 1) * 4096).astype(np.int64) & 0xFFFFFF
    streams = {
        "positions": np.stack([code >> 8 * k & 255 for k in range(3)], 2).astype(np.uint8).reshape(n, 9), "alphas": _bytes(_opacity(c) * 255)[:, None],
        "colors": _bytes(np.stack([c[f"f_dc_{k}"] for k in range(3)], 1) * 38.25 + 127.5), "scales": _bytes((np.stack([c[f"scale_{k}"] for k in range(3)], 1) + 10) * 16),
        "rotations": _bytes((q[:, 1:] * np.where(q[:, :1] < 0, -1, 1) + 1) * 127.5), "sh": _bytes(rest.reshape(n, 3, -1).transpose(0, 2, 1).reshape(n, -1) * 128 + 128),
    }
    return spz.encode(spz.Header(2, n, round((rest.shape[1] / 3 + 1) ** 0.5) - 1, 12, 0), streams)


def to_sog(c: dict[str, np.ndarray], rest: np.ndarray) -> bytes:
    place = np.arange(len(rest)) % PALETTE
    parts = {
        "position": np.stack([c[a] for a in "xyz"], 1).astype(np.float32), "scale": np.exp(np.stack([c[f"scale_{k}"] for k in range(3)], 1)), "rotation": _rotation(c), "opacity": _opacity(c),
        "dc": np.stack([c[f"f_dc_{k}"] for k in range(3)], 1).astype(np.float32), "rest": rest.reshape(len(rest), 3, -1).transpose(0, 2, 1).astype(np.float32)[place],
    }
    return sog.bundled(sog.encode(parts, 3))


ENCODERS: dict[str, Callable] = {"ply": to_ply, "spz": to_spz, "sog": to_sog}


def encoded(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """(path, content): <label>.<kind> for each label."""

    def run(group: pa.Table) -> pa.Table:
        return pa.table({"path": [f"{group.column('asset_id')[0].as_py()}.{kind}"], "content": pa.array([ENCODERS[kind](*_columns(group))], pa.binary())})

    return raw_from_embeddings(spark, sf_dir).groupBy("asset_id").applyInArrow(run, "path string, content binary")
