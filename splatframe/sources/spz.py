"""Packed splat files, versions 1 to 3: a gzip member that holds a header of 16 bytes and attribute streams."""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np

from splatframe.sources.errors import SourceError

#: Fixed values of the format.
MAGIC, HEADER, MOST = b"NGSP", 16, 2**31 - 1
ANTIALIASED, EXTENDED = 1, 2
#: No deflate stream grows by more than this.
RATIO = 1032


def fail(code: str, message: str) -> None:
    raise SourceError(f"SF-SPZ-{code}", message)


@dataclass
class Header:
    version: int
    count: int
    degree: int
    fraction_bits: int
    flags: int

    def widths(self) -> dict[str, int]:
        """Bytes a splat of each stream, in the order of the file."""
        return {"positions": 6 if self.version == 1 else 9, "alphas": 1, "colors": 3, "scales": 3, "rotations": 4 if self.version == 3 else 3, "sh": 3 * ((self.degree + 1) ** 2 - 1)}


def member_start(data: bytes) -> int:
    """Where the deflate stream of a gzip member begins."""
    if len(data) < 10 or data[2] != 8 or data[3] & 0xE0:
        fail("E004", "gzip header is malformed")
    flags, at = data[3], 10
    if flags & 4:
        at += 2 + int.from_bytes(data[at : at + 2], "little")
    for bit in (8, 16):
        if flags & bit:
            at = data.find(b"\0", at) + 1
            if not at:
                fail("E004", "gzip header has no end")
    if flags & 2:
        if data[at : at + 2] != (zlib.crc32(data[:at]) & 0xFFFF).to_bytes(2, "little"):
            fail("E004", "gzip header's checksum is wrong")
        at += 2
    if at >= len(data):
        fail("E004", "gzip header is cut off")
    return at


def is_spz(data: bytes) -> bool:
    """Routing by content; the version doesn't matter. Never raises."""
    if data[:4] == MAGIC:
        return True
    try:
        return data[:2] == b"\x1f\x8b" and zlib.decompressobj(-15).decompress(data[member_start(data) :], 4) == MAGIC
    except (SourceError, zlib.error):
        return False


def check_header(head: bytes) -> Header:
    if head[:4] != MAGIC:
        fail("E001", "not a packed splat file")
    if len(head) < HEADER:
        fail("E004", "header is cut off")
    version, count, degree, fraction, flags, _ = struct.unpack("<IIBBBB", head[4:])
    if not 1 <= version <= 3:
        fail("E003", f"version {version} is not supported")
    if count == 0:
        fail("E002", "no splats")
    if count > MOST:
        fail("E005", f"{count} splats are too many")
    if degree > 4:
        fail("E006", f"degree {degree} does not exist")
    return Header(version, count, degree, fraction, flags)


def read_header(data: bytes) -> Header:
    """Header only: nothing after the first 16 bytes is inflated."""
    if data[:4] == MAGIC:
        plain = int.from_bytes(data[4:8], "little") if len(data) >= 8 else 0
        fail("E003" if plain >= 4 else "E004", "file is not compressed")
    if data[:2] != b"\x1f\x8b":
        fail("E001", "not a packed splat file")
    try:
        head = zlib.decompressobj(-15).decompress(data[member_start(data) :], HEADER)
    except zlib.error as e:
        fail("E008", f"corrupt data: {e}")
    found = check_header(head)
    if found.degree > 3:
        fail("E011", f"degree {found.degree} is not supported")
    return found


def read_streams(data: bytes) -> tuple[Header, dict[str, np.ndarray]]:
    """Each stream as a (count, width) array of bytes, after all checks of the container."""
    h = read_header(data)
    size = HEADER + h.count * sum(h.widths().values())
    if size > len(data) * RATIO:
        fail("E007", "more splats are declared than the file can hold")
    inflate = zlib.decompressobj(-15)
    try:
        plain = inflate.decompress(data[member_start(data) :], size + 1)
        extra = len(plain) > size
        while extra and h.flags & EXTENDED and not inflate.eof:  # extensions are skipped, but count for the checksum
            more = inflate.decompress(inflate.unconsumed_tail, 1 << 24)
            if not more and not inflate.eof:
                break
            plain += more
    except zlib.error as e:
        fail("E008", f"corrupt data: {e}")
    if len(plain) < size:
        fail("E007", "payload is cut off")
    if extra and not h.flags & EXTENDED:
        fail("E009", "data after the payload")
    if not inflate.eof or len(inflate.unused_data) < 8:
        fail("E007", "the member is cut off")
    if struct.unpack("<II", inflate.unused_data[:8]) != (zlib.crc32(plain), len(plain) & 0xFFFFFFFF):
        fail("E008", "checksum or size is wrong")
    if len(inflate.unused_data) > 8:
        fail("E009", "bytes after the member")
    out, at = {}, HEADER
    for name, width in h.widths().items():
        out[name] = np.frombuffer(plain, np.uint8, h.count * width, at).reshape(h.count, width)
        at += h.count * width
    return h, out


def encode(header: Header, streams: dict[str, np.ndarray]) -> bytes:
    """Streams of bytes, copied as they are, in one gzip member without a time."""
    plain = struct.pack("<4sIIBBBB", MAGIC, header.version, header.count, header.degree, header.fraction_bits, header.flags, 0)
    plain += b"".join(np.asarray(streams[n], np.uint8).tobytes() for n in header.widths())
    deflate = zlib.compressobj(9, zlib.DEFLATED, -15)
    return b"\x1f\x8b\x08\0\0\0\0\0\x02\xff" + deflate.compress(plain) + deflate.flush() + struct.pack("<II", zlib.crc32(plain), len(plain) & 0xFFFFFFFF)
