"""Subsets of splat files: chosen records are copied as they are, with a record of where they come from.

Choosing is done on rows (operators.clouds: inside, most_opaque, opacity_at_least); a file is then rewritten by one
task, since it is one unit.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splatframe.sources import ply, spz
from splatframe.sources.errors import SourceError

SUBSET = "path string, content binary, provenance string"


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def ply_subset(data: bytes, keep: np.ndarray, note: str = "subset") -> tuple[bytes, int, int]:
    """File with the records keep, in that order; properties and comments stay. Also the count before, and the degree.

    Only little-endian files of float32 splats without another element that holds rows are taken.
    """
    h = ply.parse_header(data)
    if h.encoding != "binary_little_endian" or any(ply.TYPES.get(t) != "<f4" for _, t in h.properties):
        raise SourceError("SF-PLY-E004", "only binary little-endian float32 properties can be copied")
    if any(n for _, n in h.others):
        raise SourceError("SF-PLY-E004", "another element holds rows")
    degree, start = ply.layout(h)[0], h.payload_at(data)
    if len(data) - start < 4 * h.count * len(h.properties):
        raise SourceError("SF-PLY-E014", "payload is too short")
    rows = np.frombuffer(data, np.uint8, 4 * h.count * len(h.properties), start).reshape(h.count, -1)
    head = ["ply", "format binary_little_endian 1.0", *h.comments, f"comment {note}, source sha256 {sha256(data)}", f"element vertex {len(keep)}", *[f"property float {n}" for n, _ in h.properties], "end_header", ""]
    return "\n".join(head).encode() + rows[keep].tobytes(), h.count, degree


def spz_subset(data: bytes, keep: np.ndarray) -> tuple[bytes, int, int]:
    """File with the quantised records keep, and the gzip header's bytes for compression and system as they were."""
    h, streams = spz.read_streams(data)
    out = spz.encode(spz.Header(h.version, len(keep), h.degree, h.fraction_bits, h.flags & ~spz.EXTENDED), {n: s[keep] for n, s in streams.items()})
    return out[:8] + data[8:10] + out[10:], h.count, h.degree


def provenance(source: str, data: bytes, out: bytes, count: int, kept: int, degree: int, selection: dict) -> str:
    part = lambda name, x, n: {"file": name, "sha256": sha256(x), "bytes": len(x), "gaussian_count": n, "sh_degree": degree}
    name = source.rsplit("/", 1)[-1]
    return json.dumps({"source": part(name, data, count), "derivation": selection, "output": part(f"subset-{name}", out, kept)}, sort_keys=True)


def subsets(files: DataFrame, chosen: DataFrame, selection: dict | None = None) -> DataFrame:
    """(path, content, provenance) of each file (path, content) of which rows (asset_id, gidx) are chosen; an asset of
    which none is chosen gives no file."""
    cut: dict[str, Callable] = {"ply": ply_subset, "spz": spz_subset}

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        if right.num_rows:
            keep = np.sort(np.asarray(right.column("gidx")))
            for path, content in zip(left.column("path").to_pylist(), left.column("content").to_pylist(), strict=True):
                out, count, degree = cut[path.rsplit(".", 1)[-1].lower()](content, keep)
                rows.append((f"{path.rpartition('/')[0]}/subset-{path.rsplit('/', 1)[-1]}", out, provenance(path, content, out, count, len(keep), degree, selection or {})))
        p, c, j = zip(*rows, strict=True) if rows else ((), (), ())
        return pa.table({"path": pa.array(p, pa.string()), "content": pa.array(c, pa.binary()), "provenance": pa.array(j, pa.string())})

    keyed = files.select("path", "content", F.col("path").alias("asset_id"))
    return keyed.groupBy("asset_id").cogroup(chosen.select("asset_id", "gidx").groupBy("asset_id")).applyInArrow(run, SUBSET)


def verified(subset: DataFrame) -> DataFrame:
    """(path, matches): whether a file's hash and size are those of its provenance."""
    said = lambda key: F.get_json_object("provenance", f"$.output.{key}")
    return subset.select("path", ((F.sha2("content", 256) == said("sha256")) & (F.length("content") == said("bytes").cast("int"))).alias("matches"))
