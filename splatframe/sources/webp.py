"""Lossless WebP images (RFC 9649): a decoder, and an encoder of plain literals."""

from __future__ import annotations

import numpy as np

#: Fixed value: the order in which lengths of the code-length code are stored.
LENGTH_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
#: The 120 nearest places that short distance codes name, nearest first.
PLACES = sorted(((x, y) for y in range(8) for x in range(-7, 9) if y or x > 0), key=lambda p: (p[0] ** 2 + p[1] ** 2, abs(p[0]), p[0] < 0))
LITERALS, LENGTHS, DISTANCES = 256, 24, 40


class ImageError(ValueError):
    """Not a lossless WebP image, or a damaged one."""


class Bits:
    def __init__(self, data: bytes) -> None:
        self.data, self.at, self.held, self.n = data, 0, 0, 0

    def fill(self, n: int) -> None:
        while self.n < n:
            part = self.data[self.at : self.at + 8]
            self.held |= int.from_bytes(part, "little") << self.n
            self.at += 8
            self.n += 64
            if self.at > len(self.data) + 64:
                raise ImageError("image data is cut off")

    def read(self, n: int) -> int:
        self.fill(n)
        out = self.held & ((1 << n) - 1)
        self.held >>= n
        self.n -= n
        return out


class Code:
    """A prefix code as a table over its longest code's bits."""

    def __init__(self, lengths: list[int]) -> None:
        used = [s for s, n in enumerate(lengths) if n]
        if not used:
            raise ImageError("a prefix code has no symbols")
        self.most = 0 if len(used) == 1 else max(lengths)
        if len(used) == 1:
            self.table = [(0, used[0])]
            return
        if sum(1 << (self.most - lengths[s]) for s in used) != 1 << self.most:
            raise ImageError("a prefix code is not complete")
        self.table: list = [None] * (1 << self.most)
        code, last = 0, 0
        for s in sorted(used, key=lambda s: (lengths[s], s)):
            code <<= lengths[s] - last
            last = lengths[s]
            back = int(f"{code:0{last}b}"[::-1], 2)
            self.table[back :: 1 << last] = [(last, s)] * (1 << (self.most - last))
            code += 1

    def next(self, bits: Bits) -> int:
        bits.fill(self.most)
        n, symbol = self.table[bits.held & ((1 << self.most) - 1)]
        bits.held >>= n
        bits.n -= n
        return symbol


def read_code(bits: Bits, size: int) -> Code:
    lengths = [0] * size
    if bits.read(1):
        two = bits.read(1)
        symbols = [bits.read(8 if bits.read(1) else 1)] + ([bits.read(8)] if two else [])
        for s in symbols:
            if s >= size:
                raise ImageError("a prefix code names a symbol that doesn't exist")
            lengths[s] = 1
        return Code(lengths)
    of_lengths = [0] * len(LENGTH_ORDER)
    for k in range(4 + bits.read(4)):
        of_lengths[LENGTH_ORDER[k]] = bits.read(3)
    left = 2 + bits.read(2 + 2 * bits.read(3)) if bits.read(1) else size
    code, at, before = Code(of_lengths), 0, 8
    while at < size and left:
        left -= 1
        s = code.next(bits)
        if s < 16:
            lengths[at] = s
            before = s or before
            at += 1
            continue
        value, many = (before, 3 + bits.read(2)) if s == 16 else (0, 3 + bits.read(3)) if s == 17 else (0, 11 + bits.read(7))
        if at + many > size:
            raise ImageError("code lengths run over")
        lengths[at : at + many] = [value] * many
        at += many
    return Code(lengths)


def extended(bits: Bits, symbol: int) -> int:
    if symbol < 4:
        return symbol + 1
    extra = (symbol - 2) >> 1
    return ((2 + (symbol & 1)) << extra) + bits.read(extra) + 1


def read_pixels(bits: Bits, width: int, height: int, main: bool = False) -> list[int]:
    """ARGB numbers of an entropy-coded image."""
    cache_bits = bits.read(4) if bits.read(1) else 0
    if cache_bits > 11:
        raise ImageError("colour cache is too large")
    groups, shift, across = [0], 0, 0
    if main and bits.read(1):
        shift = bits.read(3) + 2
        across = -(-width >> shift)
        groups = [p >> 8 & 0xFFFF for p in read_pixels(bits, across, -(-height >> shift))]
    codes = [[read_code(bits, n) for n in (LITERALS + LENGTHS + (1 << cache_bits if cache_bits else 0), 256, 256, 256, DISTANCES)] for _ in range(max(groups) + 1)]
    cache = [0] * (1 << cache_bits) if cache_bits else None
    out: list[int] = []
    total, entered = width * height, 0
    green, red, blue, alpha, distance = codes[groups[0]]
    while len(out) < total:
        if across:
            at = len(out)
            green, red, blue, alpha, distance = codes[groups[(at // width >> shift) * across + (at % width >> shift)]]
        s = green.next(bits)
        if s < LITERALS:
            r = red.next(bits)
            b = blue.next(bits)
            out.append(alpha.next(bits) << 24 | r << 16 | s << 8 | b)
        elif s < LITERALS + LENGTHS:
            many, place = extended(bits, s - LITERALS), extended(bits, distance.next(bits))
            if place > len(PLACES):
                back = place - len(PLACES)
            else:
                x, y = PLACES[place - 1]
                back = max(1, x + y * width)
            if back > len(out) or len(out) + many > total:
                raise ImageError("a copy reaches out of the image")
            for _ in range(many):
                out.append(out[-back])
        else:
            for p in out[entered:]:  # the cache is brought up to date only where it is asked
                cache[(0x1E35A7BD * p & 0xFFFFFFFF) >> (32 - cache_bits)] = p
            entered = len(out)
            out.append(cache[s - LITERALS - LENGTHS])
    return out


def channels(pixels: list[int], width: int) -> np.ndarray:
    """(height, width, 4) as alpha, red, green, blue."""
    return np.array(pixels, np.uint32).astype(">u4").view(np.uint8).reshape(-1, width, 4).astype(np.int32)


def predicted(mode: int, left: list, top: list, corner: list, right: list) -> list[int]:
    half = lambda a, b: [(x + y) >> 1 for x, y in zip(a, b, strict=True)]
    clamp = lambda v: min(255, max(0, v))
    match mode:
        case 1:
            return left
        case 2:
            return top
        case 3:
            return right
        case 4:
            return corner
        case 5:
            return half(half(left, right), top)
        case 6:
            return half(left, corner)
        case 7:
            return half(left, top)
        case 8:
            return half(corner, top)
        case 9:
            return half(top, right)
        case 10:
            return half(half(left, corner), half(top, right))
        case 11:
            to_left = sum(abs(t - c) for t, c in zip(top, corner, strict=True))
            to_top = sum(abs(x - c) for x, c in zip(left, corner, strict=True))
            return left if to_left < to_top else top
        case 12:
            return [clamp(x + t - c) for x, t, c in zip(left, top, corner, strict=True)]
        case 13:
            return [clamp(a + int((a - c) / 2)) for a, c in zip(half(left, top), corner, strict=True)]
    return [255, 0, 0, 0]


def unpredict(image: np.ndarray, modes: np.ndarray, shift: int) -> np.ndarray:
    height, width = image.shape[:2]
    rows = image.tolist()
    for y in range(height):
        for x in range(width):
            if not y:
                guess = rows[0][x - 1] if x else [255, 0, 0, 0]
            elif not x:
                guess = rows[y - 1][0]
            else:
                right = rows[y - 1][x + 1] if x + 1 < width else rows[y][0]
                guess = predicted(int(modes[y >> shift, x >> shift]), rows[y][x - 1], rows[y - 1][x], rows[y - 1][x - 1], right)
            rows[y][x] = [(v + g) & 255 for v, g in zip(rows[y][x], guess, strict=True)]
    return np.array(rows, np.int32)


def decode(data: bytes) -> np.ndarray:
    """(height, width, 4) red, green, blue and alpha."""
    if data[:4] != b"RIFF" or data[8:12] != b"WEBP":
        raise ImageError("not a WebP image")
    at, found = 12, b""
    while at + 8 <= len(data) and not found:
        kind, size = data[at : at + 4], int.from_bytes(data[at + 4 : at + 8], "little")
        if kind == b"VP8 ":
            raise ImageError("a lossy image")
        if kind == b"VP8L":
            found = data[at + 8 : at + 8 + size]
            if len(found) < size:
                raise ImageError("image data is cut off")
        at += 8 + size + size % 2
    if found[:1] != b"\x2f":
        raise ImageError("no lossless image")
    bits = Bits(found[1:])
    width, height = bits.read(14) + 1, bits.read(14) + 1
    bits.read(1)
    if bits.read(3):
        raise ImageError("unknown version of the image format")
    undo, full = [], width
    while bits.read(1):
        match bits.read(2):
            case 0:
                shift = bits.read(3) + 2
                modes = channels(read_pixels(bits, -(-width >> shift), -(-height >> shift)), -(-width >> shift))[..., 2] & 15
                undo.append(lambda image, modes=modes, shift=shift: unpredict(image, modes, shift))
            case 1:
                shift = bits.read(3) + 2
                factors = channels(read_pixels(bits, -(-width >> shift), -(-height >> shift)), -(-width >> shift)).astype(np.int8).astype(np.int32)

                def recolour(image: np.ndarray, factors: np.ndarray = factors, shift: int = shift) -> np.ndarray:
                    f = factors.repeat(1 << shift, 0).repeat(1 << shift, 1)[: image.shape[0], : image.shape[1]]
                    signed = lambda c: c.astype(np.int8).astype(np.int32)
                    a, r, g, b = (image[..., k] for k in range(4))
                    r = (r + (f[..., 3] * signed(g) >> 5)) & 255
                    return np.stack([a, r, g, (b + (f[..., 2] * signed(g) >> 5) + (f[..., 1] * signed(r) >> 5)) & 255], 2)

                undo.append(recolour)
            case 2:
                undo.append(lambda image: (image + image[..., 2:3] * np.array([0, 1, 0, 1])) & 255)
            case 3:
                size = bits.read(8) + 1
                table = np.cumsum(channels(read_pixels(bits, size, 1), size)[0], 0) & 255
                pack = 3 if size <= 2 else 2 if size <= 4 else 1 if size <= 16 else 0

                def unindexed(image: np.ndarray, table: np.ndarray = table, pack: int = pack, full: int = width) -> np.ndarray:
                    each = 8 >> pack
                    index = (image[..., 2, None] >> (each * np.arange(1 << pack))) & ((1 << each) - 1)
                    index = index.reshape(image.shape[0], -1)[:, :full]
                    return np.vstack([table, np.zeros((256, 4), np.int32)])[index]

                undo.append(unindexed)
                width = -(-width >> pack)
    image = channels(read_pixels(bits, width, height, main=True), width)
    if bits.at - bits.n // 8 > len(found):
        raise ImageError("image data is cut off")
    for step in reversed(undo):
        image = step(image)
    if image.shape[:2] != (height, full):
        raise ImageError("image size is wrong")
    return image[..., [1, 2, 3, 0]].astype(np.uint8)


def encode(image: np.ndarray) -> bytes:
    """Every byte as it is: four flat codes of eight bits, no transforms, no copies. image: (height, width, 4) RGBA."""
    height, width = image.shape[:2]
    head: list[tuple[int, int]] = [(width - 1, 14), (height - 1, 14), (1, 1), (0, 3), (0, 1), (0, 1), (0, 1)]
    flat = [(0, 1), (8, 4), *[(0, 3)] * 11, (1, 3)]  # only length 8 is used, so that each length takes no bits
    head += [*flat, (1, 1), (3, 3), (254, 8), *[*flat, (0, 1)] * 3, (1, 1), (0, 1), (0, 1), (0, 1)]
    prefix = np.array([v >> k & 1 for v, n in head for k in range(n)], np.uint8)
    body = np.unpackbits(np.ascontiguousarray(image[..., [1, 0, 2, 3]]).ravel())  # codes go out from the highest bit
    data = b"\x2f" + np.packbits(np.concatenate([prefix, body]), bitorder="little").tobytes()
    padded = data + b"\0" * (len(data) % 2)
    return b"RIFF" + (12 + len(padded)).to_bytes(4, "little") + b"WEBPVP8L" + len(data).to_bytes(4, "little") + padded


def encode_lossy_stub(width: int, height: int) -> bytes:
    """The header of a lossy image, which the decoder refuses."""
    data = b"\x10\0\0\x9d\x01\x2a" + width.to_bytes(2, "little") + height.to_bytes(2, "little")
    return b"RIFF" + (12 + len(data)).to_bytes(4, "little") + b"WEBPVP8 " + len(data).to_bytes(4, "little") + data
