"""Image-plane splat files, version 2: a meta.json with lossless image planes, in a ZIP archive or beside each other.

Routing looks at content only. The planes come as bytes from a loader (name -> bytes or None), so a reader can take
them from an archive, from files beside meta.json, or from rows of a DataFrame.
"""

from __future__ import annotations

import io
import json
import math
import re
import zipfile
import zlib
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np

from splatframe.functions.kernels import FLOAT_MAX
from splatframe.sources import webp
from splatframe.sources.errors import SourceError

#: Fixed values of the format.
META, VERSION, ENTRIES, PER_ROW, TAG = "meta.json", 2, 256, 64, 252
META_LIMIT, ROUTE_LIMIT, ENTRY_LIMIT, MOST, DEPTH = 4 << 20, 1 << 20, 512 << 20, 2**31 - 1, 32
ZIP = b"PK\x03\x04"
#: Names that stand for devices on some systems.
DEVICES = {"con", "prn", "aux", "nul", *(f"{d}{k}" for d in ("com", "lpt") for k in range(1, 10))}

Loader = Callable[[str], bytes | None]


def fail(code: str, message: str) -> None:
    raise SourceError(f"SF-SOG-{code}", message)


# ---------------------------------------------------------------- JSON


def _pairs(pairs: list[tuple]) -> dict:
    out = dict(pairs)
    if len(out) != len(pairs):
        raise ValueError("a key occurs twice")
    return out


def _number(text: str) -> float:
    v = float(text)
    if not math.isfinite(v):
        raise ValueError("a number is out of range")
    return v


def _constant(text: str) -> None:
    raise ValueError(f"{text} is no JSON")


def strict_json(data: bytes):
    """RFC 8259 with distinct keys, finite numbers, at most DEPTH levels and whole surrogate pairs; ValueError else."""
    text = data.decode("utf-8-sig")
    depth = most = 0
    for token in re.findall(r'"(?:[^"\\]|\\.)*"|[\[{\]}]', text, re.S):
        depth += (token in "[{") - (token in "]}")
        most = max(most, depth)
    if most > DEPTH:
        raise ValueError("nested too deeply")
    out = json.loads(text, object_pairs_hook=_pairs, parse_constant=_constant, parse_float=_number, parse_int=_number)
    if re.search("[\ud800-\udfff]", json.dumps(out, ensure_ascii=False)):
        raise ValueError("half a surrogate pair")
    return out


def integral_text(v: float) -> str:
    """A whole number as digits, however large."""
    return str(int(v)) if v == math.floor(v) else repr(v)


# ---------------------------------------------------------------- meta.json


@dataclass
class Meta:
    count: int
    degree: int
    low: np.ndarray
    high: np.ndarray
    books: dict[str, np.ndarray]
    files: dict[str, list[str]]
    palette: int = 0
    version: int = VERSION
    planes: dict[str, np.ndarray] = field(default_factory=dict)
    source_bytes: int = 0


def is_safe_name(name: object) -> bool:
    """A bare file name that no system takes for a path or a device."""
    if not isinstance(name, str) or not 0 < len(name.encode("utf-8", "replace")) <= 255 or name in (".", "..") or re.search(r"[/\\:\x00-\x1f\x7f]", name):
        return False
    return name.split(".")[0].rstrip(" ").lower() not in DEVICES


def _whole(parent: dict, key: str, code: str) -> float:
    v = parent.get(key)
    if not isinstance(v, float):
        fail("E005", f"{key} is missing or not a number")
    if v != math.floor(v):
        fail(code, f"{key} is {v}, which is not whole")
    return v


def _object(parent: dict, key: str) -> dict:
    v = parent.get(key)
    if not isinstance(v, dict):
        fail("E005", f"{key} is missing or not an object")
    return v


def _floats(parent: dict, key: str, n: int, code: str) -> np.ndarray:
    v = parent.get(key)
    if not isinstance(v, list) or len(v) != n or not all(isinstance(x, float) and abs(x) <= FLOAT_MAX for x in v):
        fail(code, f"{key} has to be {n} numbers in the range of float32")
    return np.array(v, np.float32)


def _files(parent: dict, name: str, n: int) -> list[str]:
    v = parent.get("files")
    if not isinstance(v, list) or len(v) != n or not all(map(is_safe_name, v)):
        fail("E005", f"{name} has to list {n} plain file names")
    return v


def parse_meta(data: bytes) -> Meta:
    if len(data) > META_LIMIT:
        fail("E005", "meta.json is too large")
    try:
        root = strict_json(data)
    except (ValueError, RecursionError) as e:
        fail("E005", f"meta.json is not valid: {e}")
    if not isinstance(root, dict):
        fail("E005", "meta.json is not an object")
    if "version" not in root:
        fail("E003", "version 1 is not supported")
    if (version := _whole(root, "version", "E003")) != VERSION:
        fail("E003", f"version {integral_text(version)} is not supported")
    count = _whole(root, "count", "E006")
    if not 0 <= count <= MOST:
        fail("E006", f"count {integral_text(count)} is out of range")
    if not count:
        fail("E012", "no splats")
    means = _object(root, "means")
    out = Meta(int(count), 0, _floats(means, "mins", 3, "E005"), _floats(means, "maxs", 3, "E005"), {}, {"means": _files(means, "means", 2)})
    for name, book in (("scales", True), ("quats", False), ("sh0", True)):
        part = _object(root, name)
        if book:
            out.books[name] = _floats(part, "codebook", ENTRIES, "E011")
        out.files[name] = _files(part, name, 1)
    rest = root.get("shN")
    if rest is None:
        return out
    if not isinstance(rest, dict):
        fail("E005", "shN is not an object")
    bands = _whole(rest, "bands", "E007")
    if not 1 <= bands <= 3:
        fail("E007", f"{integral_text(bands)} bands")
    palette = _whole(rest, "count", "E005")
    if not 0 <= palette <= MOST:
        fail("E005", "the palette's size is out of range")
    out.degree, out.palette, out.books["shN"], out.files["shN"] = int(bands), int(palette), _floats(rest, "codebook", ENTRIES, "E011"), _files(rest, "shN", 2)
    return out


# ---------------------------------------------------------------- containers


def is_bundled(data: bytes) -> bool:
    return data[:4] == ZIP


def is_unbundled(data: bytes) -> bool:
    """Whether a small file has the shape of meta.json; never raises."""
    if len(data) > ROUTE_LIMIT:
        return False
    try:
        root = strict_json(data)
    except (ValueError, RecursionError):
        return False
    if not isinstance(root, dict) or root.get("version") != VERSION:
        return False
    parts = [root.get(k) for k in ("means", "scales", "quats", "sh0")]
    return all(isinstance(p, dict) and isinstance(p.get("files"), list) and p["files"] and all(isinstance(f, str) for f in p["files"]) for p in parts)


def archive_loader(data: bytes) -> Loader:
    """Entries by name, stored or deflated; an unreadable archive or entry fails."""
    try:
        archive = zipfile.ZipFile(io.BytesIO(data))
    except (zipfile.BadZipFile, ValueError, NotImplementedError) as e:
        fail("E004", f"archive is damaged: {e}")
    names = set(archive.namelist())

    def load(name: str) -> bytes | None:
        if name not in names:
            return None
        info = archive.getinfo(name)
        if info.file_size > ENTRY_LIMIT or info.compress_type not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
            fail("E004", f"entry {name} is too large or packed by another method")
        try:
            return archive.read(info)
        except (zipfile.BadZipFile, zlib.error, EOFError, OSError, RuntimeError, NotImplementedError) as e:
            fail("E004", f"entry {name} is damaged: {e}")

    return load


def opened(data: bytes, beside: Loader | None = None) -> tuple[Meta, Loader, bool]:
    """Metadata of either layout (no plane is read), its planes' loader, and whether it is bundled."""
    if is_bundled(data):
        load = archive_loader(data)
        meta = load(META)
        if meta is None:
            fail("E002", "archive without meta.json")
        out = parse_meta(meta)
        out.source_bytes = len(data)
        return out, load, True
    if not data.removeprefix(b"\xef\xbb\xbf").lstrip(b" \t\r\n").startswith(b"{"):
        fail("E002", "neither an archive nor a meta.json")
    out = parse_meta(data)
    out.source_bytes = len(data)
    return out, beside or (lambda name: None), False


def read(data: bytes, beside: Loader | None = None) -> Meta:
    """Metadata with every plane decoded and checked against the count and the palette."""
    meta, load, bundled = opened(data, beside)

    def plane(name: str) -> np.ndarray:
        found = load(name)
        if found is None:
            fail("E008", f"plane {name} is missing")
        meta.source_bytes += 0 if bundled else len(found)
        try:
            return webp.decode(found)
        except (webp.ImageError, IndexError, ValueError) as e:
            fail("E009", f"plane {name}: {e}")

    def per_splat(name: str) -> np.ndarray:
        image = plane(name)
        if image.shape[0] * image.shape[1] < meta.count:
            fail("E006", f"plane {name} holds fewer texels than splats")
        return image.reshape(-1, 4)[: meta.count]

    f = meta.files
    meta.planes = {"low": per_splat(f["means"][0]), "high": per_splat(f["means"][1]), "scales": per_splat(f["scales"][0]), "quats": per_splat(f["quats"][0]), "sh0": per_splat(f["sh0"][0])}
    if meta.degree:
        centroids, width = plane(f["shN"][0]), PER_ROW * meta.degree * (meta.degree + 2)
        meta.planes["labels"] = per_splat(f["shN"][1])
        if centroids.shape[1] != width:
            fail("E009", f"plane {f['shN'][0]} is {centroids.shape[1]} texels wide instead of {width}")
        if meta.palette > PER_ROW * centroids.shape[0]:
            fail("E009", f"plane {f['shN'][0]} holds fewer centroids than declared")
        meta.planes["centroids"] = centroids
    return meta


def columns(meta: Meta, a: int = 0, b: int | None = None) -> tuple[dict[str, np.ndarray], int]:
    """Splats a..b-1 in the file's frame: position, scale (linear), rotation (w first), opacity, dc and rest as
    float32; and how many labels lie beyond the palette, whose rest is zero."""
    p = {k: v[a:b].astype(np.int64) for k, v in meta.planes.items() if k != "centroids"}
    code = p["low"][:, :3] | p["high"][:, :3] << 8
    with np.errstate(over="ignore"):
        place = meta.low + (meta.high - meta.low) * (code.astype(np.float32) / np.float32(65535))
        position = (np.sign(place) * np.expm1(np.abs(place))).astype(np.float32)
        linear = np.exp(meta.books["scales"]).astype(np.float32)
    if not np.isfinite(position).all():
        fail("E005", "the position range leaves float32")
    scale = linear[p["scales"][:, :3]]
    if not np.isfinite(scale).all():
        fail("E011", "a scale that is used leaves float32")
    if (p["quats"][:, 3] < TAG).any():
        fail("E013", f"a rotation's tag is below {TAG}")
    kept = ((p["quats"][:, :3] / 255 * 2 - 1) * math.sqrt(0.5)).astype(np.float32)
    rest = np.sqrt(np.maximum(0, 1 - (kept.astype(np.float64) ** 2).sum(1)))
    rotation, omitted = np.zeros((len(kept), 4)), p["quats"][:, 3] - TAG
    for k in range(4):
        at = omitted == k
        rotation[np.ix_(at, [c for c in range(4) if c != k])] = kept[at]
        rotation[at, k] = rest[at]
    rotation /= np.sqrt((rotation**2).sum(1, keepdims=True))
    out = {"position": position, "scale": scale, "rotation": rotation.astype(np.float32), "opacity": (p["sh0"][:, 3] / 255).astype(np.float32), "dc": meta.books["sh0"][p["sh0"][:, :3]]}
    beyond, width = 0, meta.degree * (meta.degree + 2)
    coefficients = np.zeros((len(position), width, 3), np.float32)
    if meta.degree:
        label = p["labels"][:, 0] | p["labels"][:, 1] << 8
        known = label < meta.palette
        beyond = int((~known).sum())
        x = (label[known] % PER_ROW * width)[:, None] + np.arange(width)
        coefficients[known] = meta.books["shN"][meta.planes["centroids"][(label[known] // PER_ROW)[:, None], x, :3]]
    out["rest"] = coefficients
    return out, beyond


# ---------------------------------------------------------------- encoding


def codebook(values: np.ndarray) -> np.ndarray:
    """The distinct values, padded to ENTRIES; more than ENTRIES are replaced by evenly spread ones."""
    found = np.unique(values.astype(np.float32))
    if len(found) > ENTRIES:
        found = np.linspace(found[0], found[-1], ENTRIES, dtype=np.float32)
    return np.concatenate([found, np.full(ENTRIES - len(found), found[-1] if len(found) else 0, np.float32)])


def nearest(book: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = np.clip(np.searchsorted(book, values), 1, ENTRIES - 1)
    return np.where(np.abs(values - book[at - 1]) <= np.abs(book[at] - values), at - 1, at).astype(np.uint8)


def image_of(rows: np.ndarray) -> np.ndarray:
    """(n, channels) bytes as a nearly square RGBA image, 255 where nothing is given."""
    width = max(1, math.ceil(math.sqrt(len(rows))))
    image = np.full((width * -(-len(rows) // width), 4), 255, np.uint8)
    image[: len(rows), : rows.shape[1]] = rows
    return image.reshape(-1, width, 4)


def encode(c: dict[str, np.ndarray], degree: int) -> dict[str, bytes]:
    """meta.json and planes by name, from columns as columns() returns them; each distinct rest is a palette row."""
    place = np.sign(c["position"]) * np.log1p(np.abs(c["position"].astype(np.float64)))
    low, high = place.min(0).astype(np.float32), place.max(0).astype(np.float32)
    code = np.clip(np.rint((place - low) / np.maximum(high - low, 1e-30) * 65535), 0, 65535).astype(np.int64)
    scales, dc = np.log(c["scale"].astype(np.float64)), c["dc"]
    books = {"scales": codebook(scales), "sh0": codebook(dc)}
    q = c["rotation"].astype(np.float64)
    omitted = np.abs(q).argmax(1)
    q = q * np.where(np.take_along_axis(q, omitted[:, None], 1) < 0, -1, 1)
    kept = np.array([np.delete(row, k) for row, k in zip(q, omitted, strict=True)]).reshape(-1, 3)
    quats = np.hstack([np.clip(np.rint((kept / math.sqrt(0.5) + 1) / 2 * 255), 0, 255), (omitted + TAG)[:, None]])
    meta = {"version": VERSION, "count": len(place), "means": {"mins": low.tolist(), "maxs": high.tolist(), "files": ["means_l.webp", "means_u.webp"]}}
    meta |= {n: {"codebook": books[n].tolist(), "files": [f"{n}.webp"]} for n in books} | {"quats": {"files": ["quats.webp"]}}
    planes = {"means_l": code & 255, "means_u": code >> 8, "scales": nearest(books["scales"], scales), "quats": quats, "sh0": np.hstack([nearest(books["sh0"], dc), np.rint(c["opacity"].astype(np.float64) * 255)[:, None]])}
    images = {f"{n}.webp": image_of(np.asarray(v).astype(np.uint8)) for n, v in planes.items()}
    if degree:
        width, book = degree * (degree + 2), codebook(c["rest"])
        rows, label = np.unique(nearest(book, c["rest"]).reshape(len(place), -1), axis=0, return_inverse=True)
        if len(rows) > 1 << 16:
            fail("E005", "more distinct rests than a label can name")
        texels = np.full((-(-len(rows) // PER_ROW) * PER_ROW, width, 4), 255, np.uint8)
        texels[: len(rows), :, :3] = rows.reshape(-1, width, 3)
        images["shN_centroids.webp"] = texels.reshape(-1, PER_ROW * width, 4)
        images["shN_labels.webp"] = image_of(np.stack([label & 255, label >> 8], 1).reshape(-1, 2).astype(np.uint8))
        meta["shN"] = {"count": len(rows), "bands": degree, "codebook": book.tolist(), "files": ["shN_centroids.webp", "shN_labels.webp"]}
    return {META: json.dumps(meta).encode()} | {n: webp.encode(x) for n, x in images.items()}


def bundled(files: dict[str, bytes], deflate: bool = False) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED if deflate else zipfile.ZIP_STORED) as z:
        for name, data in files.items():
            z.writestr(zipfile.ZipInfo(name), data, zipfile.ZIP_DEFLATED if deflate else zipfile.ZIP_STORED)
    return out.getvalue()
