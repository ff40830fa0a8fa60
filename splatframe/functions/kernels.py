"""Scalar kernels. Inputs are numeric columns, results double unless said; model columns are cast to float32 where a cloud is assembled."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FLOAT_MAX = 3.4028234663852886e38
#: Signs of the rest coefficients of bands 1 to 3 under a half turn about x.
SH_SIGNS = (-1, -1, 1, -1, 1, 1, -1, 1, -1, 1, -1, -1, 1, -1, 1)


def finite(c: Column) -> Column:
    return ~F.isnan(c) & (F.abs(c) <= FLOAT_MAX)


def to_float32(c: Column) -> Column:
    """Rounded to float32, infinite beyond its range; still a double column."""
    return c.cast("float").cast("double")


def sigmoid(v: Column) -> Column:
    e = F.exp(-F.abs(v))
    return F.when(v >= 0, 1 / (1 + e)).otherwise(e / (1 + e))


def logit(o: Column) -> Column:
    return F.log(o / (1 - o))


def log_scale(v: Column) -> Column:
    """exp(v) where float32 holds it as a positive finite number, else null."""
    e = F.exp(v)
    as_float = to_float32(e)
    return F.when(finite(v) & finite(as_float) & (as_float > 0), e)


def norm_squared(q: list[Column]) -> Column:
    return q[0] * q[0] + q[1] * q[1] + q[2] * q[2] + q[3] * q[3]


def normalize(q: list[Column]) -> tuple[list[Column], Column, Column]:
    """Unit quaternion, whether it replaced a zero one by the identity, and whether it changed; nulls if not finite."""
    n2 = norm_squared(q)
    zero = n2 <= 1e-20
    ok = finite(q[0]) & finite(q[1]) & finite(q[2]) & finite(q[3])
    length = F.sqrt(F.when(ok & ~zero, n2))
    unit = [F.when(ok & zero, F.lit(float(k == 0))).otherwise(c / length) for k, c in enumerate(q)]
    return unit, zero & ok, ok & (zero | (F.abs(n2 - 1) > 1e-5))


def infer_degree(coefficients: Column) -> Column:
    """Degree of a square number of coefficients, else null."""
    side = F.rint(F.sqrt(coefficients.cast("double"))).cast("long")
    return F.when((coefficients > 0) & (side * side == coefficients), (side - 1).cast("int"))


def coefficients(degree: Column) -> Column:
    return (degree + 1) * (degree + 1)


def rest_count(degree: int) -> int:
    return (degree + 1) * (degree + 1) - 1


def flip_position(p: list[Column]) -> list[Column]:
    return [p[0], -p[1], -p[2]]


def flip_rotation(q: list[Column]) -> list[Column]:
    return [q[0], q[1], -q[2], -q[3]]


def flip_rest(rest: Column) -> Column:
    """RGB triples in band order with their signs under the frame change; more than 15 stay as they are."""
    signs = F.array(*[F.lit(float(s)) for s in SH_SIGNS])
    turned = F.transform(rest, lambda c, k: F.struct(*[(c[x] * F.get(signs, k)).alias(x) for x in "rgb"]))
    return F.when(F.size(rest) <= len(SH_SIGNS), turned).otherwise(rest)


def transpose_rest(channel_major: Column) -> Column:
    """All red, all green, all blue -> triples."""
    k = (F.size(channel_major) / 3).cast("int")
    step = F.when(k > 0, F.sequence(F.lit(0), k - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(step, lambda i: F.struct(F.get(channel_major, i).alias("r"), F.get(channel_major, i + k).alias("g"), F.get(channel_major, i + 2 * k).alias("b")))


def model_rest(channel_major: Column) -> Column:
    """flip_rest(transpose_rest()) in one step: float triples."""
    k = (F.size(channel_major) / 3).cast("int")
    step = F.when(k > 0, F.sequence(F.lit(0), k - 1)).otherwise(F.array().cast("array<int>"))
    signs = F.array(*[F.lit(float(s)) for s in SH_SIGNS])
    sign = lambda i: F.when(k <= len(SH_SIGNS), F.get(signs, i)).otherwise(1.0)
    return F.transform(step, lambda i: F.struct(*[(F.get(channel_major, i + n * k if n else i) * sign(i)).cast("float").alias(x) for n, x in enumerate("rgb")]))


def interleave(dc: Column, rest: Column) -> Column:
    return F.concat(F.array(dc), rest)


def cap_rest(rest: Column, degree: Column) -> Column:
    return F.slice(rest, F.lit(1), F.greatest(coefficients(degree) - 1, F.lit(0)).cast("int"))


def effective_degree(source: Column, requested: Column) -> Column:
    return F.when(requested < 0, source).otherwise(F.least(source, requested))


def half_to_float(bits: Column) -> Column:
    """IEEE binary16 from its 16 bits, with subnormals, infinities and NaN."""
    sign = F.when(F.shiftright(bits, 15).bitwiseAND(1) == 1, -1.0).otherwise(1.0)
    exponent, fraction = F.shiftright(bits, 10).bitwiseAND(31), bits.bitwiseAND(1023).cast("double")
    special = F.when(fraction == 0, sign * F.lit(float("inf"))).otherwise(F.lit(float("nan")))
    return F.when(exponent == 31, special).when(exponent == 0, sign * fraction * 2.0**-24).otherwise(sign * (1 + fraction / 1024) * F.pow(F.lit(2.0), exponent - 15))


def fixed24(code: Column, fraction_bits: Column) -> Column:
    """Signed 24-bit fixed point from its unsigned code."""
    return F.when(code >= 0x800000, code - 0x1000000).otherwise(code) / F.pow(F.lit(2.0), fraction_bits)


def quantise_fixed24(v: Column, fraction_bits: int) -> Column:
    """Halves go to the even number, here and in to_byte()."""
    return F.rint(v * float(1 << fraction_bits)).cast("long").bitwiseAND(0xFFFFFF)


def to_byte(v: Column) -> Column:
    return F.least(F.greatest(F.rint(v).cast("long"), F.lit(0)), F.lit(255))


def spz_alpha(b: Column) -> Column:
    return b / 255.0


def spz_scale(b: Column) -> Column:
    return F.exp(b / 16.0 - 10.0)


def spz_color(b: Column) -> Column:
    return (b / 255.0 - 0.5) / 0.15


def spz_sh(b: Column) -> Column:
    return (b - 128) / 128.0


def first_three(b: list[Column]) -> list[Column]:
    """(x, y, z) bytes -> (w, x, y, z) with w >= 0."""
    x, y, z = (c / 127.5 - 1.0 for c in b)
    return [F.sqrt(F.greatest(F.lit(0.0), 1.0 - (x * x + y * y + z * z))), x, y, z]


def smallest_three(packed: Column) -> list[Column]:
    """32 bits -> (w, x, y, z): two bits name the omitted of (x, y, z, w), the others follow from the low end, last
    component first, as a 9-bit size and a sign."""
    omitted = F.shiftright(packed, 30).bitwiseAND(3)
    field = [F.shiftright(packed, 10 * k) for k in range(3)]
    value = [F.when(f.bitwiseAND(512) != 0, -1.0).otherwise(1.0) * f.bitwiseAND(511) / 511.0 * (0.5**0.5) for f in field]
    rest = F.sqrt(F.greatest(F.lit(0.0), 1.0 - (value[0] * value[0] + value[1] * value[1] + value[2] * value[2])))
    xyzw = []
    for c in range(4):  # component c is the (number of kept components after it)-th field
        out = rest
        for big in range(4):
            if big != c:
                out = F.when(omitted == big, value[sum(1 for d in range(c + 1, 4) if d != big)]).otherwise(out)
        xyzw.append(out)
    return [xyzw[3], *xyzw[:3]]


def range_position(low: Column, high: Column, minimum: Column, maximum: Column) -> Column:
    """Two bytes of a 16-bit place between minimum and maximum."""
    return minimum + (maximum - minimum) * (low + 256 * high) / 65535.0


def inverse_log(n: Column) -> Column:
    return F.signum(n) * (F.exp(F.abs(n)) - 1)


def log_transform(v: Column) -> Column:
    return F.signum(v) * F.log1p(F.abs(v))


def tagged_rotation(r: Column, g: Column, b: Column, tag: Column) -> list[Column]:
    """Three bytes and a tag 252..255 that names the omitted of (w, x, y, z); null for other tags."""
    slot = tag - 252
    v = [(c / 255.0 * 2.0 - 1.0) * (0.5**0.5) for c in (r, g, b)]
    rest = F.sqrt(F.greatest(F.lit(0.0), 1.0 - (v[0] * v[0] + v[1] * v[1] + v[2] * v[2])))
    out = []
    for c in range(4):
        e = F.when(slot == c, rest)
        for big in range(4):
            if big != c:
                e = e.when(slot == big, v[c - (c > big)])
        out.append(e)
    return out


def texel(index: Column, width: Column) -> tuple[Column, Column]:
    return index % width, F.floor(index / width)


def rest_index(name: Column) -> Column:
    """The number in f_rest_<digits>, else null."""
    digits = F.regexp_extract(name, r"^f_rest_([0-9]+)$", 1)
    return F.when(digits != "", F.when(digits != "", digits).otherwise("0").cast("long"))


def diagnostic(code: Column, message: Column) -> Column:
    return F.concat(F.lit("["), F.coalesce(code, F.lit("SF-E000")), F.lit("] "), message)


def counted(n: Column, one: str, many: str) -> Column:
    return F.concat(n.cast("string"), F.lit(" "), F.when(n == 1, F.lit(one)).otherwise(F.lit(many)))


def align_sign(q: list[Column], to: list[Column]) -> list[Column]:
    """q or -q, whichever is nearer to the other quaternion."""
    dot = q[0] * to[0] + q[1] * to[1] + q[2] * to[2] + q[3] * to[3]
    return [F.when(dot < 0, -c).otherwise(c) for c in q]
