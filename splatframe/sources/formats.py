"""Splat files as Spark data sources: spark.read.format("splat_ply" | "splat_spz" | "splat_sog").load(path).

Paths have to be mounted on every executor (or be local); for other stores there are the readers of sources.files,
which go through Spark's own file source. Binary PLY files without elements before the splats are read in ranges of
rows, each by a task that reads only its range; metadataOnly reads headers only (a bounded prefix of PLY and of SPZ,
meta.json of SOG). decoded gives clouds of PLY and SPZ files instead of raw rows. Writing is refused under the format's
code.
"""

from __future__ import annotations

import glob
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from splatframe.operators.diagnostics import code_of
from splatframe.sources import decoded, files, ply, sog, spz
from splatframe.sources.errors import SourceError

#: Rows of a PLY file that one task reads.
ROWS = 1 << 15
PREFIX = 1 << 20


class Part(InputPartition):
    def __init__(self, path: str, first: int = 0, n: int = -1) -> None:
        self.path, self.first, self.n = path, first, n


def listed(path: str, suffixes: tuple[str, ...]) -> list[str]:
    path = path.removeprefix("file://").removeprefix("file:")
    found = [path] if os.path.isfile(path) else sorted(glob.glob(f"{glob.escape(path)}/**/*", recursive=True)) if os.path.isdir(path) else sorted(glob.glob(path))
    return [p for p in found if p.lower().endswith(suffixes) and os.path.isfile(p)]


def prefix(path: str, n: int = PREFIX) -> bytes:
    with open(path, "rb") as f:
        return f.read(n)


class SplatReader(DataSourceReader):
    def __init__(self, kind: str, options: dict) -> None:
        self.kind, self.path = kind, options["path"]
        self.meta_only = options.get("metadataonly", "false").lower() == "true"
        self.rows = int(options.get("rowspertask", ROWS))
        self.decoded = options.get("decoded", "false").lower() == "true"

    def partitions(self) -> list[Part]:
        paths = listed(self.path, {"ply": (".ply",), "spz": (".spz",), "sog": (".sog", "/meta.json")}[self.kind])
        if self.kind != "ply" or self.meta_only:
            return [Part(p) for p in paths]
        out = []
        for p in paths:
            h = ply.parse_header(prefix(p))
            step = self.rows if h.encoding != "ascii" and not h.before else max(1, h.count)
            out += [Part(p, a, min(step, h.count - a)) for a in range(0, max(1, h.count), step)]
        return out

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        path = partition.path
        if self.meta_only:
            yield self.header(path)
        elif self.kind == "ply":
            yield from self.ply_range(path, partition.first, partition.n)
        elif self.kind == "spz":
            yield from (decoded if self.decoded else files).spz_batches(path, prefix(path, -1))
        else:
            folder = os.path.dirname(path)
            beside = lambda name: prefix(f"{folder}/{name}", sog.ENTRY_LIMIT) if os.path.isfile(f"{folder}/{name}") else None
            yield from files.sog_rows(path, prefix(path, -1), beside)

    def header(self, path: str) -> pa.RecordBatch:
        return files.metadata_batch(path, prefix(path, -1 if path.lower().endswith(".sog") else sog.META_LIMIT if path.endswith(".json") else PREFIX), os.path.getsize(path))

    def ply_range(self, path: str, first: int, n: int) -> Iterator[pa.RecordBatch]:
        h = ply.parse_header(prefix(path))
        n_rest, rows_of = ply.layout(h)[1], decoded.ply_batches if self.decoded else files.ply_columns
        if n == h.count or h.encoding == "ascii" or h.before:
            yield from rows_of(path, 0, *ply.read_columns(prefix(path, -1), h, n_rest))
            return
        width = sum(np.dtype(ply.TYPES[t]).itemsize for _, t in h.properties)
        with open(path, "rb") as f:
            f.seek(h.length + first * width)
            data = f.read(n * width)
        part = ply.Header(h.encoding, n, h.properties, 0)
        yield from rows_of(path, first, *ply.read_columns(data, part, n_rest))


class _Splats(DataSource):
    kind = ""

    @classmethod
    def name(cls) -> str:
        return f"splat_{cls.kind}"

    def schema(self) -> str:
        on = lambda name: self.options.get(name, "false").lower() == "true"
        return files.META if on("metadataOnly") else decoded.CLOUD if on("decoded") and self.kind != "sog" else {"ply": files.PLY_RAW, "spz": files.SPZ_RAW, "sog": files.SOG_RAW}[self.kind]

    def reader(self, schema) -> SplatReader:
        return SplatReader(self.kind, {k.lower(): v for k, v in self.options.items()})

    def writer(self, schema, overwrite):
        raise SourceError(code_of(self.kind, "write_unsupported"), f"writing {self.kind} files is not supported")


class PlySplats(_Splats):
    kind = "ply"


class SpzSplats(_Splats):
    kind = "spz"


class SogSplats(_Splats):
    kind = "sog"


#: Extensions and the formats that read them.
EXTENSIONS = {"ply": PlySplats, "spz": SpzSplats, "sog": SogSplats, "json": SogSplats}


def register(spark: SparkSession) -> None:
    for source in set(EXTENSIONS.values()):
        spark.dataSource.register(source)


def format_of(path: str, head: bytes) -> str | None:
    """Routing by extension and then content: the format's name, or null where no reader takes the file."""
    kind = path.rsplit(".", 1)[-1].lower()
    takes = {"ply": lambda: ply.is_splat(path, head), "spz": lambda: spz.is_spz(head), "sog": lambda: sog.is_bundled(head), "json": lambda: sog.is_unbundled(head)}.get(kind)
    return EXTENSIONS[kind].name() if takes and takes() else None
