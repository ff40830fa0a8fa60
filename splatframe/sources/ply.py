"""Splat PLY files: routing, header, layout checks, payload, and an encoder.

Files come through Spark's binaryFile source, so every file system Spark reads will do; a file is one row and one
task, below 2 GB. Only the properties of a splat are taken out of a payload, in whatever order a header declares them.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np

from splatframe.functions.kernels import FLOAT_MAX
from splatframe.sources.errors import SourceError

#: The property types of the format, both spellings, as little-endian numpy types.
TYPES = {
    "char": "<i1", "uchar": "<u1", "short": "<i2", "ushort": "<u2", "int": "<i4", "uint": "<u4", "float": "<f4", "double": "<f8",
    "int8": "<i1", "uint8": "<u1", "int16": "<i2", "uint16": "<u2", "int32": "<i4", "uint32": "<u4", "float32": "<f4", "float64": "<f8",
}
#: The properties every splat has, and those that are skipped without a warning.
REQUIRED = ("x", "y", "z", "scale_0", "scale_1", "scale_2", "rot_0", "rot_1", "rot_2", "rot_3", "opacity", "f_dc_0", "f_dc_1", "f_dc_2")
SILENT = ("nx", "ny", "nz")
#: Properties that tell a splat from any other PLY file.
MARKS = ("scale_0", "rot_0", "opacity", "f_dc_0")
HEADER_LIMIT = 1 << 20


def fail(code: str, message: str) -> None:
    raise SourceError(f"SF-PLY-{code}", message)


@dataclass
class Header:
    encoding: str
    count: int
    properties: list[tuple[str, str]]  # name, type; "list" for a list
    length: int
    comments: list[str] = field(default_factory=list)
    before: list[tuple[int, list[tuple]]] = field(default_factory=list)  # number and property types of elements before
    others: list[tuple[str, int]] = field(default_factory=list)  # names and numbers of the other elements

    def payload_at(self, data: bytes) -> int:
        """Where the splats begin: after the header and the elements before them."""
        at = self.length
        for count, kinds in self.before:
            if self.encoding == "ascii":
                for _ in range(count):
                    at = data.find(b"\n", at) + 1
                    if not at:
                        fail("E015", "payload is cut off")
            elif all(len(k) == 1 for k in kinds):
                at += count * sum(np.dtype(k[0]).itemsize for k in kinds)
            else:
                for _ in range(count):
                    for k in kinds:
                        many = int(np.frombuffer(data, k[0], 1, at)[0]) if len(k) == 2 and at + 8 <= len(data) else 1
                        at += np.dtype(k[0]).itemsize + (many * np.dtype(k[1]).itemsize if len(k) == 2 else 0)
        return at


def parse_header(data: bytes) -> Header:
    end = re.search(rb"(?:^|\n)end_header[ \t]*\r?\n", data[:HEADER_LIMIT])
    if not re.match(rb"ply[ \t]*\r?\n", data) or not end:
        fail("E015", "no PLY header")
    encoding, elements, comments = "", [], []
    for line in data[: end.start()].decode("ascii", "replace").splitlines()[1:]:
        match line.split():
            case ["format", kind, "1.0"]:
                encoding = kind
            case ["comment" | "obj_info", *_]:
                comments.append(line)
            case ["element", name, count] if count.isdigit():
                elements.append((name, int(count), [], []))
            case ["property", "list", size, kind, name] if elements and size in TYPES and kind in TYPES:
                elements[-1][2].append((name, "list"))
                elements[-1][3].append((TYPES[size], TYPES[kind]))
            case ["property", kind, name] if elements and kind in TYPES:
                elements[-1][2].append((name, kind))
                elements[-1][3].append((TYPES[kind],))
            case []:
                pass
            case _:
                fail("E015", f"header line not understood: {line}")
    if encoding not in ("ascii", "binary_little_endian"):
        fail("E015", f"encoding {encoding or 'missing'}")
    vertices = [e for e in elements if e[0] == "vertex"]
    if len(vertices) != 1:
        fail("E001", "one element has to be named vertex")
    names = [n for n, _ in vertices[0][2]]
    if twice := next((n for n in names if names.count(n) > 1), None):
        fail("E006" if twice.startswith("f_rest_") else "E015", f"property {twice} is declared twice")
    before = [(e[1], e[3]) for e in elements[: elements.index(vertices[0])]]
    return Header(encoding, vertices[0][1], vertices[0][2], end.end(), comments, before, [(e[0], e[1]) for e in elements if e is not vertices[0]])


def is_splat(path: str, data: bytes) -> bool:
    """Routing: by extension and header; never raises."""
    try:
        return path.lower().endswith(".ply") and set(MARKS) <= {n for n, _ in parse_header(data).properties}
    except SourceError:
        return False


def layout(header: Header) -> tuple[int, int, list[str]]:
    """(degree, number of rest properties, properties that are ignored with a warning)."""
    types = dict(header.properties)
    if not any(m in types for m in MARKS):
        fail("E001", "not a splat file")
    if header.count == 0:
        fail("E002", "no splats")
    for n in REQUIRED:
        if n not in types:
            fail("E003", f"property {n} is missing")
    rest = [n for n in types if n.startswith("f_rest_")]
    if lists := [n for n in types if types[n] == "list"]:
        fail("E004", f"property {lists[0]} is a list")
    places = set()
    for n in rest:
        digits = n.removeprefix("f_rest_")
        if not re.fullmatch(r"[0-9]{1,9}", digits):
            fail("E005", f"{n} is no rest coefficient")
        if int(digits) in places:
            fail("E006", f"rest coefficient {int(digits)} occurs twice")
        if digits != str(int(digits)):
            fail("E005", f"{n} is no rest coefficient")
        places.add(int(digits))
    if places != set(range(len(places))):
        fail("E007", "rest coefficients have gaps")
    if len(places) % 3:
        fail("E008", "the number of rest coefficients is not divisible by three")
    side = round((len(places) // 3 + 1) ** 0.5)
    if side * side != len(places) // 3 + 1:
        fail("E009", f"{len(places)} rest coefficients fit no degree")
    if side > 4:
        fail("E017", f"degree {side - 1} is not supported")
    return side - 1, len(places), sorted(set(types) - set(REQUIRED) - set(rest) - set(SILENT))


def read_columns(data: bytes, header: Header, n_rest: int) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The required properties by name and a (count, n_rest) array of the rest, as float32; all of them finite."""
    names, start = [n for n, _ in header.properties], header.payload_at(data)
    if header.encoding == "ascii":
        tokens = data[start:].split(None, header.count * len(names))
        if len(tokens) < header.count * len(names):
            fail("E014", "payload is too short")
        try:
            flat = np.array(tokens[: header.count * len(names)], "S").astype(np.float64).reshape(header.count, -1)
        except ValueError:
            fail("E015", "payload holds something other than numbers")
        take = {n: flat[:, k] for k, n in enumerate(names)}
    else:
        row = np.dtype([(n, TYPES[t]) for n, t in header.properties])
        if len(data) - start < header.count * row.itemsize:
            fail("E014", "payload is too short")
        rows = np.frombuffer(data, row, header.count, start)
        take = {n: rows[n] for n in names}

    def column(name: str) -> np.ndarray:
        v = take[name].astype(np.float64)
        if not (np.isfinite(v) & (np.abs(v) <= FLOAT_MAX)).all():
            fail("E010", f"{name} has a value that is not finite")
        return v.astype(np.float32)

    rest = np.empty((header.count, n_rest), np.float32)
    for k in range(n_rest):
        rest[:, k] = column(f"f_rest_{k}")
    out = {n: column(n) for n in REQUIRED}
    for k in range(3):
        with np.errstate(over="ignore", under="ignore"):
            e = np.exp(out[f"scale_{k}"].astype(np.float64)).astype(np.float32)
        if not (np.isfinite(e) & (e > 0)).all():
            fail("E012", f"scale_{k} has a logarithm out of range")
    return out, rest


def encode(columns: dict[str, np.ndarray], rest: np.ndarray, comments: tuple[str, ...] = (), ascii_: bool = False) -> bytes:
    """A file of float properties; comments are header lines."""
    names = [*REQUIRED, *[f"f_rest_{k}" for k in range(rest.shape[1])]]
    flat = np.column_stack([*[np.asarray(columns[n], "<f4") for n in REQUIRED], np.asarray(rest, "<f4")])
    head = ["ply", f"format {'ascii' if ascii_ else 'binary_little_endian'} 1.0", *comments, f"element vertex {len(flat)}", *[f"property float {n}" for n in names], "end_header", ""]
    body = "".join(" ".join(map(repr, row)) + "\n" for row in flat.tolist()).encode() if ascii_ else flat.astype("<f4").tobytes()
    return "\n".join(head).encode() + body
