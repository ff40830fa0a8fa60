"""Files straight to clouds, decoded batch by batch where they are read: the rows are in Python as Arrow batches there
anyway, and rest coefficients cost a tenth of what they do in column expressions. Same columns and values as
plans.cloud.decode and files.decode_spz, which decode tables of raw rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from splatframe.functions.kernels import SH_SIGNS
from splatframe.sources import ply, spz

_STRUCT = lambda names: f"struct<{','.join(f'{n}:float' for n in names)}>"
CLOUD = f"asset_id string, gidx long, position {_STRUCT('xyz')}, scale {_STRUCT('xyz')}, rotation {_STRUCT('wijk')}, opacity float, dc {_STRUCT('rgb')}, rest array<{_STRUCT('rgb')}>, was_replaced boolean, was_changed boolean"
BATCH = 1 << 14


def structs(v: np.ndarray, names: str) -> pa.StructArray:
    return pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(v[:, k], np.float32)) for k in range(len(names))], list(names))


def normalised(q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit quaternions (w first), which of them replace a zero one, and which were changed."""
    n2 = (q * q).sum(1)
    zero = n2 <= 1e-20
    unit = np.where(zero[:, None], np.array([1.0, 0, 0, 0]), q / np.sqrt(np.where(zero, 1, n2))[:, None])
    return unit, zero, zero | (np.abs(n2 - 1) > 1e-5)


def batch(asset: str, first: int, position: np.ndarray, scale: np.ndarray, q: np.ndarray, opacity: np.ndarray, dc: np.ndarray, rest: np.ndarray, flip: bool) -> pa.RecordBatch:
    """rest: (n, coefficients, 3). flip: whether the values are turned into the model's frame."""
    n, width = rest.shape[:2]
    unit, replaced, changed = normalised(q)
    if flip:
        position, unit = position * [1, -1, -1], unit * [1, 1, -1, -1]
        rest = rest * np.array(SH_SIGNS[:width], np.float32)[None, :, None]
    triples = structs(rest.reshape(-1, 3), "rgb")
    lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), triples)
    columns = [pa.array([asset] * n, pa.string()), pa.array(np.arange(first, first + n)), structs(position, "xyz"), structs(scale, "xyz"), structs(unit, "wijk"), pa.array(opacity.astype(np.float32)), structs(dc, "rgb"), lists, pa.array(replaced), pa.array(changed)]
    return pa.RecordBatch.from_arrays(columns, ["asset_id", "gidx", "position", "scale", "rotation", "opacity", "dc", "rest", "was_replaced", "was_changed"])


def ply_batches(asset: str, first: int, columns: dict[str, np.ndarray], rest: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Of columns and channel-major rest coefficients as ply.read_columns() returns them."""
    for a in range(0, len(rest), BATCH):
        c = {n: v[a : a + BATCH].astype(np.float64) for n, v in columns.items()}
        many = lambda *names, c=c: np.stack([c[n] for n in names], 1)
        e = np.exp(-np.abs(c["opacity"]))
        opacity = np.where(c["opacity"] >= 0, 1 / (1 + e), e / (1 + e))
        triples = rest[a : a + BATCH].reshape(len(e), 3, -1).transpose(0, 2, 1)
        yield batch(asset, first + a, many("x", "y", "z"), np.exp(many("scale_0", "scale_1", "scale_2")), many("rot_0", "rot_1", "rot_2", "rot_3"), opacity, many("f_dc_0", "f_dc_1", "f_dc_2"), triples, True)


def spz_rotations(data: np.ndarray, version: int) -> np.ndarray:
    """(n, 4), w first, from three bytes, or from 32 bits that name the omitted of (x, y, z, w)."""
    if version < 3:
        v = data / 127.5 - 1.0
        return np.concatenate([np.sqrt(np.maximum(0, 1 - (v * v).sum(1, keepdims=True))), v], 1)
    word = data.astype(np.int64) @ (1 << 8 * np.arange(4, dtype=np.int64))
    omitted, out, rest = word >> 30, np.zeros((len(word), 4)), np.ones(len(word))
    for c in (3, 2, 1, 0):
        here = omitted != c
        v = np.where(word & 512, -1.0, 1.0) * (word & 511) / 511.0 * 0.5**0.5
        out[here, c] = v[here]
        rest -= np.where(here, v * v, 0)
        word = np.where(here, word >> 10, word)
    out[np.arange(len(out)), omitted] = np.sqrt(np.maximum(0, rest))
    return out[:, [3, 0, 1, 2]]


def spz_batches(asset: str, data: bytes) -> Iterator[pa.RecordBatch]:
    h, streams = spz.read_streams(data)
    for a in range(0, h.count, BATCH):
        s = {k: v[a : a + BATCH] for k, v in streams.items()}
        n = len(s["alphas"])
        if h.version == 1:
            position = np.ascontiguousarray(s["positions"]).view("<f2").astype(np.float64)
            if not np.isfinite(position).all():
                spz.fail("E012", "a position is not finite")
        else:
            code = s["positions"].reshape(n, 3, 3).astype(np.int64) @ np.array([1, 1 << 8, 1 << 16])
            position = np.where(code >= 1 << 23, code - (1 << 24), code) / 2.0**h.fraction_bits
        rest = (s["sh"].astype(np.float32) - 128) / 128
        yield batch(asset, a, position, np.exp(s["scales"] / 16.0 - 10.0), spz_rotations(s["rotations"], h.version), s["alphas"][:, 0] / 255.0, (s["colors"] / 255.0 - 0.5) / 0.15, rest.reshape(n, -1, 3), False)
