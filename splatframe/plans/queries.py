"""Registered queries of the reference operators, with their SQL. Floating results are rounded to six places, and
0.0 is added so that a negative zero counts as zero."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from splatframe.functions import kernels as K
from splatframe.operators import clouds as C
from splatframe.operators import diagnostics as G
from splatframe.operators import layers as L
from splatframe.plans.assets import encoded
from splatframe.plans.cloud import decode, raw_from_embeddings
from splatframe.sources import files as S
from splatframe.sources import subsets as U

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

RAW = """raw AS (SELECT label AS asset_id, vec_id AS gidx, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
r AS (SELECT asset_id, gidx, e[1] * 100.0 AS x, e[2] * 100.0 AS y, e[3] * 100.0 AS z, e[4] * 10.0 AS s0, e[5] * 10.0 AS s1, e[6] * 10.0 AS s2,
 e[7] AS q0, e[8] AS q1, e[9] AS q2, e[10] AS q3, e[7] * e[7] + e[8] * e[8] + e[9] * e[9] + e[10] * e[10] AS n2, e[11] * 20.0 AS o, e[12] AS d0, e[13] AS d1, e[14] AS d2, e[15:59] AS f FROM raw),
c AS (SELECT *, CASE WHEN o >= 0 THEN 1 / (1 + exp(-o)) ELSE exp(o) / (1 + exp(o)) END AS a, exp(s0) AS es0, exp(s1) AS es1, exp(s2) AS es2 FROM r)"""


def six(c: Column) -> Column:
    return F.round(c.cast("double"), 6) + F.lit(0.0)


def r6(sql: str) -> str:
    return f"round(CAST({sql} AS DOUBLE), 6) + 0.0"


def f4(sql: str) -> str:
    """As float32, which a cloud's columns are."""
    return f"CAST(CAST({sql} AS FLOAT) AS DOUBLE)"


def query(name: str, sql: str | None = None, raw: bool = True):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = f"WITH {RAW}{'' if sql.startswith(',') else ' '}{sql}" if raw else sql
        return f

    return add


def raw(spark: SparkSession, d: str) -> DataFrame:
    return raw_from_embeddings(spark, d)


def cloud(spark: SparkSession, d: str) -> DataFrame:
    return decode(raw_from_embeddings(spark, d))


@query("p01_sigmoid", f"SELECT gidx, {r6('a')} AS opacity FROM c")
def _(spark, d):
    return raw(spark, d).select("gidx", six(K.sigmoid(F.col("opacity"))).alias("opacity"))


@query("p02_log_scale", f"SELECT gidx, {r6('es0')} AS x, {r6('es1')} AS y, {r6('es2')} AS z FROM c")
def _(spark, d):
    return raw(spark, d).select("gidx", *[six(K.log_scale(F.col(f"scale_{k}"))).alias(n) for k, n in enumerate("xyz")])


@query("p03_quat_normalize", f"SELECT gidx, {', '.join(f'{r6(f'q{k} / sqrt(n2)')} AS {n}' for k, n in enumerate('wijk'))}, abs(n2 - 1) > 1e-5 AS was_changed, n2 <= 1e-20 AS was_replaced FROM r")
def _(spark, d):
    unit, replaced, changed = K.normalize([F.col(f"rot_{k}") for k in range(4)])
    return raw(spark, d).select("gidx", *[six(c).alias(n) for c, n in zip(unit, "wijk", strict=True)], changed.alias("was_changed"), replaced.alias("was_replaced"))


@query("p04_infer_degree", "SELECT l_orderkey AS id, l_linenumber AS n, CASE WHEN l_linenumber IN (1, 4, 9, 16) THEN CAST(round(sqrt(l_linenumber)) - 1 AS INTEGER) ELSE -1 END AS degree FROM lineitem", raw=False)
def _(spark, d):
    t = spark.read.parquet(f"{d}/lineitem.parquet")
    return t.select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("n"), F.coalesce(K.infer_degree(F.col("l_linenumber")), F.lit(-1)).alias("degree"))


@query("p06_flip_position", f"SELECT gidx, {r6(f4('x'))} AS x, {r6(f4('-y'))} AS y, {r6(f4('-z'))} AS z FROM r")
def _(spark, d):
    return cloud(spark, d).select("gidx", *[six(F.col(f"position.{a}")).alias(a) for a in "xyz"])


@query("p07_flip_rotation", f"SELECT gidx, {r6(f4('q0 / sqrt(n2)'))} AS w, {r6(f4('q1 / sqrt(n2)'))} AS i, {r6(f4('-q2 / sqrt(n2)'))} AS j, {r6(f4('-q3 / sqrt(n2)'))} AS k FROM r")
def _(spark, d):
    return cloud(spark, d).select("gidx", *[six(F.col(f"rotation.{a}")).alias(a) for a in "wijk"])


_SIGNS = "[" + ", ".join(map(str, K.SH_SIGNS)) + "]"
_REST = f"SELECT gidx, CAST(k - 1 AS INTEGER) AS k, {{}} FROM (SELECT gidx, f, unnest(range(1, 16)) AS k FROM r)"


@query("p29_sh_transpose", _REST.format(f"{r6('f[k]')} AS r, {r6('f[k + 15]')} AS g, {r6('f[k + 30]')} AS b"))
def _(spark, d):
    t = raw(spark, d).select("gidx", F.posexplode(K.transpose_rest(F.col("f_rest"))).alias("k", "c"))
    return t.select("gidx", "k", *[six(F.col(f"c.{x}")).alias(x) for x in "rgb"])


@query("p08_sh_flip", _REST.format(", ".join(f"{r6(f'f[k + {o}] * {_SIGNS}[k]')} AS {x}" for o, x in ((0, "r"), (15, "g"), (30, "b")))))
def _(spark, d):
    t = cloud(spark, d).select("gidx", F.posexplode("rest").alias("k", "c"))
    return t.select("gidx", "k", *[six(F.col(f"c.{x}")).alias(x) for x in "rgb"])


@query("p30_sh_interleave", f"SELECT gidx, CAST(k AS INTEGER) AS k, {r6(f'CASE WHEN k = 0 THEN d0 ELSE f[k] * {_SIGNS}[k] END')} AS r FROM (SELECT gidx, d0, f, unnest(range(0, 16)) AS k FROM r)")
def _(spark, d):
    t = cloud(spark, d).select("gidx", F.posexplode(K.interleave(F.col("dc"), F.col("rest"))).alias("k", "c"))
    return t.select("gidx", "k", six(F.col("c.r")).alias("r"))


@query("p27_sh_cap", "SELECT gidx, CAST(8 AS INTEGER) AS kept, " + r6("f[1] + f[2] - f[8]") + " AS v FROM r")
def _(spark, d):
    t = raw(spark, d).withColumn("rest", K.cap_rest(K.transpose_rest(F.col("f_rest")), K.effective_degree(F.lit(3), F.lit(2))))
    return t.select("gidx", F.size("rest").alias("kept"), six(F.col("rest")[0]["r"] + F.col("rest")[1]["r"] - F.element_at("rest", -1)["r"]).alias("v"))


@query("p10_fixed24", f"SELECT gidx, code, {r6('(CASE WHEN code >= 8388608 THEN code - 16777216 ELSE code END) / 4096.0')} AS x FROM (SELECT gidx, CAST(round_even(x * 4096.0, 0) AS BIGINT) & 16777215 AS code FROM r)")
def _(spark, d):
    t = raw(spark, d).select("gidx", K.quantise_fixed24(F.col("x"), 12).alias("code"))
    return t.select("gidx", "code", six(K.fixed24(F.col("code"), F.lit(12))).alias("x"))


_BYTE = lambda e: f"least(greatest(CAST(round_even({e}, 0) AS BIGINT), 0), 255)"


@query("p11_p14_spz_bytes", f"SELECT gidx, {r6('ba / 255.0')} AS alpha, {r6('exp(bs / 16.0 - 10.0)')} AS scale, {r6('(bc / 255.0 - 0.5) / 0.15')} AS color, {r6('(bh - 128) / 128.0')} AS sh FROM (SELECT gidx, {_BYTE('a * 255.0')} AS ba, {_BYTE('(s0 + 10) * 16.0')} AS bs, {_BYTE('d0 * 38.25 + 127.5')} AS bc, {_BYTE('f[1] * 128.0 + 128')} AS bh FROM c)")
def _(spark, d):
    t = raw(spark, d).select("gidx", K.to_byte(K.sigmoid(F.col("opacity")) * 255.0).alias("ba"), K.to_byte((F.col("scale_0") + 10) * 16.0).alias("bs"), K.to_byte(F.col("f_dc_0") * 38.25 + 127.5).alias("bc"), K.to_byte(F.col("f_rest")[0] * 128.0 + 128).alias("bh"))
    return t.select("gidx", six(K.spz_alpha(F.col("ba"))).alias("alpha"), six(K.spz_scale(F.col("bs"))).alias("scale"), six(K.spz_color(F.col("bc"))).alias("color"), six(K.spz_sh(F.col("bh"))).alias("sh"))


@query("p15_first_three", f"SELECT gidx, {r6('sqrt(greatest(0.0, 1.0 - (x * x + y * y + z * z)))')} AS w, {r6('x')} AS i, {r6('y')} AS j, {r6('z')} AS k FROM (SELECT gidx, {', '.join(f'{_BYTE(f'(q{k} / sqrt(n2) + 1) * 127.5')} / 127.5 - 1.0 AS {n}' for k, n in ((1, 'x'), (2, 'y'), (3, 'z')))} FROM r)")
def _(spark, d):
    unit, _, _ = K.normalize([F.col(f"rot_{k}") for k in range(4)])
    t = raw(spark, d).select("gidx", *[K.to_byte((c + 1) * 127.5).alias(n) for c, n in zip(unit[1:], "xyz", strict=True)])
    return t.select("gidx", *[six(c).alias(n) for c, n in zip(K.first_three([F.col(a) for a in "xyz"]), "wijk", strict=True)])


_CODE = "CAST(o_orderkey * 2654435761 % 4294967296 AS BIGINT)"
_FIELD = lambda k: f"((CASE WHEN (p >> {10 * k}) & 512 <> 0 THEN -1.0 ELSE 1.0 END) * ((p >> {10 * k}) & 511) / CAST(511 AS DOUBLE) * sqrt(CAST(0.5 AS DOUBLE)))"


def _smallest(c: int) -> str:
    cases = " ".join(f"WHEN {big} THEN {f'v{sum(1 for x in range(c + 1, 4) if x != big)}'}" for big in range(4) if big != c)
    return f"CASE (p >> 30) & 3 WHEN {c} THEN sqrt(greatest(0.0, 1.0 - (v0 * v0 + v1 * v1 + v2 * v2))) {cases} END"


@query("p16_smallest_three", f"SELECT id, {', '.join(f'{r6(_smallest(c))} AS {n}' for n, c in zip('wijk', (3, 0, 1, 2), strict=True))} FROM (SELECT id, p, {', '.join(f'{_FIELD(k)} AS v{k}' for k in range(3))} FROM (SELECT o_orderkey AS id, {_CODE} AS p FROM orders))", raw=False)
def _(spark, d):
    t = spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_orderkey").alias("id"), (F.col("o_orderkey").cast("long") * 2654435761 % 4294967296).alias("p"))
    return t.select("id", *[six(c).alias(n) for c, n in zip(K.smallest_three(F.col("p")), "wijk", strict=True)])


@query("p18_p19_position", f"SELECT gidx, {r6('sign(n) * (exp(abs(n)) - 1)')} AS x FROM (SELECT gidx, -4.0 + 8.0 * (lo + 256 * hi) / 65535.0 AS n FROM (SELECT gidx, gidx * 7919 % 256 AS lo, gidx * 104729 % 256 AS hi FROM r))")
def _(spark, d):
    n = K.range_position(F.col("gidx") * 7919 % 256, F.col("gidx") * 104729 % 256, F.lit(-4.0), F.lit(4.0))
    return raw(spark, d).select("gidx", six(K.inverse_log(n)).alias("x"))


def _tagged(c: int) -> str:
    return f"CASE t WHEN {c} THEN sqrt(greatest(0.0, 1.0 - (v0 * v0 + v1 * v1 + v2 * v2))) {' '.join(f'WHEN {big} THEN v{c - (c > big)}' for big in range(4) if big != c)} END"


@query("p22_tagged_rotation", f"SELECT gidx, {', '.join(f'{r6(_tagged(c))} AS {n}' for c, n in enumerate('wijk'))} FROM (SELECT gidx, gidx % 6 - 1 AS t, {', '.join(f'((gidx * {m} % 256) / CAST(255.0 AS DOUBLE) * 2.0 - 1.0) * sqrt(CAST(0.5 AS DOUBLE)) AS v{k}' for k, m in enumerate((31, 57, 101)))} FROM r)")
def _(spark, d):
    q = K.tagged_rotation(*[F.col("gidx") * m % 256 for m in (31, 57, 101)], F.col("gidx") % 6 + 251)
    return raw(spark, d).select("gidx", *[six(c).alias(n) for c, n in zip(q, "wijk", strict=True)])


@query("p23_log_transform", f"SELECT gidx, {r6('sign(x) * ln(abs(x) + 1)')} AS x FROM r")
def _(spark, d):
    return raw(spark, d).select("gidx", six(K.log_transform(F.col("x"))).alias("x"))


@query("p40_align_sign", "SELECT gidx, " + r6("CASE WHEN q0 * q1 + q1 * q2 + q2 * q3 + q3 * q0 < 0 THEN -q0 ELSE q0 END") + " AS w FROM r")
def _(spark, d):
    q = [F.col(f"rot_{k}") for k in range(4)]
    return raw(spark, d).select("gidx", six(K.align_sign(q, [*q[1:], q[0]])[0]).alias("w"))


@query("f01_opacity_filter", f"SELECT gidx, {r6(f4('a'))} AS opacity FROM c WHERE {f4('a')} >= {f4('0.4')}")
def _(spark, d):
    return C.opacity_at_least(cloud(spark, d), 0.4).select("gidx", six(F.col("opacity")).alias("opacity"))


@query("f02_aabb", "SELECT gidx FROM r WHERE x BETWEEN -10 AND 10 AND y BETWEEN -12 AND 8 AND z BETWEEN -20 AND 20")
def _(spark, d):
    return C.inside(raw(spark, d), (-10, -12, -20), (10, 8, 20)).select("gidx")


@query("a01_extent", "SELECT asset_id, " + ", ".join(f"{r6(f'min({s}{f4(a)} - r)')} AS min_{a}, {r6(f'max({s}{f4(a)} + r)')} AS max_{a}" for s, a in (("", "x"), ("-", "y"), ("-", "z"))) + ", bool_or(r > 3.4028234663852886e38) AS overflow FROM (SELECT *, CAST(CAST(CAST(3.0 AS DOUBLE) * greatest(CAST(CAST(es0 AS FLOAT) AS DOUBLE), CAST(CAST(es1 AS FLOAT) AS DOUBLE), CAST(CAST(es2 AS FLOAT) AS DOUBLE)) AS FLOAT) AS DOUBLE) AS r FROM c) GROUP BY 1")
def _(spark, d):
    t = C.extent(cloud(spark, d), "asset_id")
    return t.select("asset_id", *[six(F.col(f"{m}_{a}")).alias(f"{m}_{a}") for a in "xyz" for m in ("min", "max")], "overflow")


@query("a02_warning_counts", "SELECT asset_id, count(*) FILTER (WHERE abs(n2 - 1) > 1e-5 AND n2 > 1e-20) AS normalised, count(*) FILTER (WHERE n2 <= 1e-20) AS replaced FROM r GROUP BY 1")
def _(spark, d):
    return C.warning_counts(cloud(spark, d), "asset_id")


@query("a04_first_violation", "SELECT asset_id, min(gidx) AS gidx, 'position' AS \"check\" FROM r WHERE gidx % 7 = 3 GROUP BY 1")
def _(spark, d):
    bad = cloud(spark, d).withColumn("position", F.when(F.col("gidx") % 7 == 3, F.struct(F.lit(float("nan")).cast("float").alias("x"), F.lit(0.0).cast("float").alias("y"), F.lit(0.0).cast("float").alias("z"))).otherwise(F.col("position")))
    return C.first_violation(bad)


@query("a05_violations", "SELECT asset_id, gidx, 'opacity' AS \"check\" FROM c WHERE CAST(CAST(a AS FLOAT) AS DOUBLE) * 1.5 > 1")
def _(spark, d):
    return C.violations(cloud(spark, d).withColumn("opacity", F.col("opacity") * 1.5))


@query("a06_decoded_bytes", "SELECT asset_id, count(*) AS gaussians, CAST(count(*) * 56 + sum(15) * 12 AS BIGINT) AS decoded_bytes FROM r GROUP BY 1")
def _(spark, d):
    return C.decoded_bytes(cloud(spark, d), "asset_id")


@query("a07_duplicates", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1", raw=False)
def _(spark, d):
    return spark.read.parquet(f"{d}/lineitem.parquet").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n")).filter("n > 1")


@query("a08_contiguity", "SELECT asset_id, min(gidx) = 0 AND max(gidx) = count(*) - 1 AND count(DISTINCT gidx) = count(*) AS contiguous FROM r GROUP BY 1")
def _(spark, d):
    return raw(spark, d).groupBy("asset_id").agg(((F.min("gidx") == 0) & (F.max("gidx") == F.count("*") - 1) & (F.count_distinct("gidx") == F.count("*"))).alias("contiguous"))


@query("a09_log_ranges", f"SELECT {r6('min(sign(x) * ln(abs(x) + 1))')} AS low, {r6('max(sign(x) * ln(abs(x) + 1))')} AS high FROM r")
def _(spark, d):
    v = K.log_transform(F.col("x"))
    return raw(spark, d).agg(six(F.min(v)).alias("low"), six(F.max(v)).alias("high"))


@query("a10_codebook", f"SELECT CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS idx, v FROM (SELECT DISTINCT {_BYTE('(s0 + 10) * 16.0')} AS v FROM r)")
def _(spark, d):
    t = raw(spark, d).agg(F.array_sort(F.collect_set(K.to_byte((F.col("scale_0") + 10) * 16.0))).alias("v"))  # 256 values at most
    return t.select(F.posexplode("v").alias("idx", "v"))


@query("a11_largest_component", "SELECT gidx, CASE greatest(abs(q0), abs(q1), abs(q2), abs(q3)) WHEN abs(q0) THEN 0 WHEN abs(q1) THEN 1 WHEN abs(q2) THEN 2 ELSE 3 END AS largest FROM r")
def _(spark, d):
    q = F.array(*[F.abs(F.col(f"rot_{k}")) for k in range(4)])
    return raw(spark, d).select("gidx", (F.array_position(q, F.array_max(q)) - 1).cast("int").alias("largest"))


@query("o01_top_n", f"SELECT gidx, {r6('o')} AS opacity FROM r ORDER BY o DESC, gidx LIMIT 100")
def _(spark, d):
    return C.most_opaque(raw(spark, d), 100).select("gidx", six(F.col("opacity")).alias("opacity"))


@query("o03_reindex", "SELECT asset_id, gidx, CAST(row_number() OVER (PARTITION BY asset_id ORDER BY gidx) - 1 AS BIGINT) AS row FROM c WHERE CAST(a AS FLOAT) >= CAST(0.4 AS FLOAT)")
def _(spark, d):
    return C.reindexed(C.opacity_at_least(cloud(spark, d), 0.4)).select("asset_id", "gidx", "row")


@query("o06_running_offset", "SELECT asset_id, CAST(sum(n) OVER (ORDER BY asset_id) - n AS BIGINT) AS start, n FROM (SELECT asset_id, count(*) * 9 AS n FROM r GROUP BY 1)")
def _(spark, d):
    from pyspark.sql import Window

    t = raw(spark, d).groupBy("asset_id").agg((F.count("*") * 9).alias("n"))  # a row per asset
    return t.select("asset_id", (F.sum("n").over(Window.orderBy("asset_id").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("start"), "n")


@query("j02_codebook", f"SELECT gidx, code, {r6('CASE WHEN code < 200 THEN exp(code / 16.0 - 10.0) END')} AS value FROM (SELECT gidx, CAST({_BYTE('(s0 + 10) * 16.0')} AS INTEGER) AS code FROM r)")
def _(spark, d):
    book = spark.range(200).select(F.col("id").cast("int").alias("idx"), K.spz_scale(F.col("id")).alias("value"))
    t = C.codebook_lookup(raw(spark, d).select("gidx", K.to_byte((F.col("scale_0") + 10) * 16.0).cast("int").alias("code")), "code", book)
    return t.select("gidx", "code", six(F.col("value")).alias("value"))


@query("j03_palette", "SELECT gidx, label, label >= 8 AS out_of_range, CAST(3 AS INTEGER) AS width, " + r6("CASE WHEN label < 8 THEN label / CAST(10.0 AS DOUBLE) ELSE 0 END") + " AS r FROM (SELECT gidx, CAST(gidx % 10 AS INTEGER) AS label FROM r)")
def _(spark, d):
    triple = F.struct(*[(F.col("id") / 10.0).alias(k) for k in "rgb"])
    palette = spark.range(8).select(F.col("id").cast("int").alias("label"), F.array_repeat(triple, 3).alias("rest"))
    t = C.palette_lookup(raw(spark, d).select("gidx", (F.col("gidx") % 10).cast("int").alias("label")), palette, 3)
    return t.select("gidx", "label", "out_of_range", F.size("rest").alias("width"), six(F.col("rest")[0]["r"]).alias("r"))


@query("j04_compare", "SELECT asset_id, gidx, CASE WHEN gidx % 11 = 5 THEN 'missing' ELSE 'opacity' END AS field FROM c WHERE gidx % 11 = 5 OR (gidx % 13 = 2 AND gidx % 11 <> 5)")
def _(spark, d):
    a = cloud(spark, d)
    b = a.filter(F.col("gidx") % 11 != 5).withColumn("opacity", F.when(F.col("gidx") % 13 == 2, F.col("opacity") + 1).otherwise(F.col("opacity"))).withColumn("rotation", F.struct(*[(-F.col(f"rotation.{k}")).alias(k) for k in "wijk"]))
    return C.compare(a, b)


@query("j04_compare_rest", "SELECT asset_id, gidx, 'rest' AS field FROM c WHERE gidx % 17 = 3 OR gidx % 19 = 4")
def _(spark, d):
    a = cloud(spark, d)
    last = F.transform("rest", lambda c, i: F.when(i == F.size("rest") - 1, c.withField("b", (c["b"] + 0.5).cast("float"))).otherwise(c))
    return C.compare(a, a.withColumn("rest", F.when(F.col("gidx") % 17 == 3, last).when(F.col("gidx") % 19 == 4, K.cap_rest(F.col("rest"), F.lit(2))).otherwise(F.col("rest"))))


@query("j05_catalog_anti", "SELECT c_custkey AS code FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey % 4 <> 0 AND o_custkey = c_custkey)", raw=False)
def _(spark, d):
    codes, seen = spark.read.parquet(f"{d}/customer.parquet"), spark.read.parquet(f"{d}/orders.parquet").filter("o_custkey % 4 <> 0")
    return codes.join(seen, F.col("o_custkey") == F.col("c_custkey"), "left_anti").select(F.col("c_custkey").alias("code"))


@query("u01_difference", "SELECT c_custkey AS code FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_custkey % 4 <> 0", raw=False)
def _(spark, d):
    seen = spark.read.parquet(f"{d}/orders.parquet").filter("o_custkey % 4 <> 0").select("o_custkey")
    return spark.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").alias("code")).subtract(seen)


@query("j05_catalog_anti_back", "SELECT DISTINCT o_custkey AS code FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey % 5 <> 0 AND c_custkey = o_custkey)", raw=False)
def _(spark, d):
    codes, seen = spark.read.parquet(f"{d}/customer.parquet").filter("c_custkey % 5 <> 0"), spark.read.parquet(f"{d}/orders.parquet")
    return seen.join(codes, F.col("o_custkey") == F.col("c_custkey"), "left_anti").select(F.col("o_custkey").alias("code")).distinct()


@query("u01_difference_back", "SELECT o_custkey AS code FROM orders EXCEPT SELECT c_custkey FROM customer WHERE c_custkey % 5 <> 0", raw=False)
def _(spark, d):
    return spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_custkey").alias("code")).subtract(spark.read.parquet(f"{d}/customer.parquet").filter("c_custkey % 5 <> 0").select("c_custkey"))


@query("u03_set_update", "SELECT c_custkey AS code FROM customer UNION SELECT o_custkey FROM orders", raw=False)
def _(spark, d):
    return spark.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").alias("code")).union(spark.read.parquet(f"{d}/orders.parquet").select("o_custkey")).distinct()


@query("v01_option_pipeline", f"SELECT gidx, {r6(f4('es0') + ' * 2.0')} AS sx, {r6(f4('a'))} AS opacity, CAST(3 AS INTEGER) AS kept FROM c WHERE {f4('a')} >= 0.25")
def _(spark, d):
    t = C.with_options(cloud(spark, d), {"scaleMultiplier": "2", "opacityThreshold": "0.25", "shDegree": "1", "other": "x"})
    return t.select("gidx", six(F.col("scale.x")).alias("sx"), six(F.col("opacity")).alias("opacity"), F.size("rest").alias("kept"))


# ---------------------------------------------------------------- files made from the table, read again

_PLACED = "n AS (SELECT *, row_number() OVER (PARTITION BY asset_id ORDER BY gidx) - 1 AS place FROM c)"


def placed(sql: str) -> str:
    return f", {_PLACED} {sql}"


@query("s03_ply_rows", placed(f"SELECT CAST(asset_id AS VARCHAR) || '.ply' AS asset_id, CAST(place AS BIGINT) AS gidx, {r6(f4('x'))} AS x, {r6(f4('s2'))} AS scale_2, {r6(f4('q3'))} AS rot_3, {r6(f4('o'))} AS opacity, {r6(f4('f[45]'))} AS rest FROM n"))
def _(spark, d):
    t = S.ply_rows(encoded(spark, d, "ply"))
    return t.select("asset_id", "gidx", *[six(F.col(c)).alias(c) for c in ("x", "scale_2", "rot_3", "opacity")], six(F.col("f_rest")[44]).alias("rest"))


@query("s05_s14_s26_metadata", "SELECT CAST(asset_id AS VARCHAR) || '.' || k.kind AS asset_id, k.kind AS source_format, k.v AS source_version, count(*) AS gaussian_count, CAST(3 AS INTEGER) AS sh_degree, CAST(NULL AS VARCHAR) AS code FROM r, (VALUES ('ply', '1.0'), ('spz', '2'), ('sog', '2')) k(kind, v) GROUP BY 1, 2, 3")
def _(spark, d):
    three = [S.metadata_of(encoded(spark, d, kind)) for kind in ("ply", "spz", "sog")]
    return three[0].union(three[1]).union(three[2]).drop("source_bytes", "message")


@query("s12_spz_codes", placed(f"SELECT CAST(asset_id AS VARCHAR) || '.spz' AS asset_id, CAST(place AS BIGINT) AS gidx, CAST(CAST(round_even(y * 4096.0, 0) AS BIGINT) & 16777215 AS INTEGER) AS y, CAST({_BYTE('a * 255.0')} AS INTEGER) AS alpha, CAST({_BYTE('(s1 + 10) * 16.0')} AS INTEGER) AS scale, CAST({_BYTE('d2 * 38.25 + 127.5')} AS INTEGER) AS color, CAST({_BYTE('f[17] * 128.0 + 128')} AS INTEGER) AS sh FROM n"))
def _(spark, d):
    t = S.spz_codes(encoded(spark, d, "spz"))
    return t.select("asset_id", "gidx", F.col("position")[1].alias("y"), "alpha", F.col("scale")[1].alias("scale"), F.col("color")[2].alias("color"), F.col("sh")[4].alias("sh"))


@query("s12_spz_cloud", placed(f"SELECT CAST(asset_id AS VARCHAR) || '.spz' AS asset_id, CAST(place AS BIGINT) AS gidx, {r6(f4(_BYTE('a * 255.0') + ' / CAST(255 AS DOUBLE)'))} AS opacity, {r6(f4('round_even(z * 4096.0, 0) / 4096.0'))} AS z, CAST(15 AS INTEGER) AS rest FROM n"))
def _(spark, d):
    t = S.decode_spz(S.spz_codes(encoded(spark, d, "spz")))
    return t.select("asset_id", "gidx", six(F.col("opacity")).alias("opacity"), six(F.col("position.z")).alias("z"), F.size("rest").alias("rest"))


@query("s25_sog_cloud", placed(f"SELECT CAST(asset_id AS VARCHAR) || '.sog' AS asset_id, CAST(place AS BIGINT) AS gidx, {r6(f4('round_even(a * 255.0, 0) / CAST(255 AS DOUBLE)'))} AS opacity, true AS near, CAST(15 AS INTEGER) AS rest FROM n"))
def _(spark, d):
    t = S.decode_sog(S.sog_bundles(encoded(spark, d, "sog")))
    model = decode(S.ply_rows(encoded(spark, d, "ply"))).select(F.regexp_replace("asset_id", "ply$", "sog").alias("asset_id"), "gidx", F.struct("position", "scale", "rotation", "dc").alias("m"))
    off = lambda c, ks, by: [F.abs(F.col(f"{c}.{k}") - F.col(f"m.{c}.{k}")) <= by(F.col(f"m.{c}.{k}")) for k in ks]
    q = K.align_sign([F.col(f"rotation.{k}") for k in "wijk"], [F.col(f"m.rotation.{k}") for k in "wijk"])
    near = [*off("position", "xyz", lambda v: 1e-3 * (1 + F.abs(v))), *off("scale", "xyz", lambda v: 0.2 * v), *off("dc", "rgb", lambda v: F.lit(0.05)), *[F.abs(c - F.col(f"m.rotation.{k}")) <= 0.01 for c, k in zip(q, "wijk", strict=True)]]
    every = near[0]
    for c in near[1:]:
        every = every & c
    return t.join(model, ["asset_id", "gidx"]).select("asset_id", "gidx", six(F.col("opacity")).alias("opacity"), every.alias("near"), F.size("rest").alias("rest"))


@query("k07_k09_j07_subsets", placed("SELECT CAST(asset_id AS VARCHAR) || '.' || kind AS asset_id, true AS matches, count(*) FILTER (WHERE place % 3 = 1) AS kept, count(*) AS source_count FROM n, (VALUES ('ply'), ('spz')) k(kind) GROUP BY 1 HAVING count(*) FILTER (WHERE place % 3 = 1) > 0"))
def _(spark, d):
    out = None
    for kind, rows in (("ply", S.ply_rows), ("spz", S.spz_codes)):
        files = encoded(spark, d, kind)
        made = U.subsets(files, rows(files).filter("gidx % 3 = 1"), {"tool": "splatframe", "selection": "every third"})
        again = S.metadata_of(made).select(F.col("asset_id").alias("path"), F.col("gaussian_count").alias("kept"))
        count = F.get_json_object("provenance", "$.source.gaussian_count").cast("long").alias("source_count")
        part = made.select("path", count).join(U.verified(made), "path").join(again, "path").select(F.regexp_replace("path", "^/subset-", "").alias("asset_id"), "matches", "kept", "source_count")
        out = part if out is None else out.unionByName(part)
    return out


# ---------------------------------------------------------------- gate, diagnostics, sinks

def meta_of(t: DataFrame, *changes) -> DataFrame:
    out = t.groupBy("asset_id").agg(F.count("*").alias("gaussian_count")).withColumn("sh_degree", F.lit(3))
    for c in changes:
        out = out.withColumn(*c)
    return out


def numbered(t: DataFrame) -> DataFrame:
    return C.reindexed(t).drop("gidx").withColumnRenamed("row", "gidx")


@query("v02_gate", placed("""SELECT asset_id, CAST(CASE asset_id % 6 WHEN 3 THEN CASE WHEN count(*) > 2 THEN 2 ELSE -1 END WHEN 4 THEN CASE WHEN count(*) > 1 THEN 1 ELSE -1 END WHEN 5 THEN 0 ELSE -1 END AS BIGINT) AS gidx,
 CASE asset_id % 6 WHEN 0 THEN 'length' WHEN 1 THEN 'rest_length' WHEN 2 THEN 'degree' WHEN 3 THEN CASE WHEN count(*) > 2 THEN 'value' END WHEN 4 THEN CASE WHEN count(*) > 1 THEN 'norm' END WHEN 5 THEN 'rest' END AS problem FROM n GROUP BY 1"""))
def _(spark, d):
    kind = F.col("asset_id") % 6
    t = numbered(cloud(spark, d))
    t = t.withColumn("opacity", F.when((kind == 3) & (F.col("gidx") >= 2), F.lit(1.5).cast("float")).otherwise(F.col("opacity")))
    t = t.withColumn("rotation", F.when((kind == 4) & (F.col("gidx") == 1), F.struct(*[F.lit(2.0).cast("float").alias(k) for k in "wijk"])).otherwise(F.col("rotation")))
    t = t.withColumn("rest", F.when(kind == 5, F.transform("rest", lambda c: c.withField("g", F.lit(float("nan")).cast("float")))).when(kind == 1, K.cap_rest(F.col("rest"), F.lit(2))).otherwise(F.col("rest")))
    found = G.gate(t, meta_of(t, ("gaussian_count", F.when(F.col("asset_id") % 6 == 0, F.col("gaussian_count") + 1).otherwise(F.col("gaussian_count"))), ("sh_degree", F.when(F.col("asset_id") % 6 == 2, 4).otherwise(3))))
    return found.withColumn("gidx", F.coalesce("gidx", F.lit(-1)))


@query("v06_v07_catalogue", "SELECT * FROM (VALUES ('ply', 'error', 26), ('ply', 'warning', 3), ('spz', 'error', 20), ('spz', 'warning', 2), ('sog', 'error', 20), ('sog', 'warning', 1)) t(source_format, severity, n)", raw=False)
def _(spark, d):
    return G.catalogue(spark).groupBy("source_format", "severity").agg(F.count_distinct("code").cast("int").alias("n"))


@query("a05_every_check", "SELECT asset_id, gidx, unnest(CASE gidx % 8 WHEN 0 THEN ['position'] WHEN 1 THEN ['scale'] WHEN 2 THEN ['rotation', 'norm'] WHEN 3 THEN ['opacity'] WHEN 4 THEN ['dc'] WHEN 5 THEN ['norm'] WHEN 6 THEN ['rest'] ELSE [] END) AS \"check\" FROM r")
def _(spark, d):
    return C.violations(with_faults(cloud(spark, d)))


@query("a04_first_of_every_check", "SELECT asset_id, gidx, ['position', 'scale', 'rotation', 'opacity', 'dc', 'norm', 'rest'][gidx % 8 + 1] AS \"check\" FROM (SELECT asset_id, coalesce(min(gidx) FILTER (WHERE gidx % 8 < 6), min(gidx) FILTER (WHERE gidx % 8 = 6)) AS gidx FROM r GROUP BY 1) WHERE gidx IS NOT NULL")
def _(spark, d):
    return C.first_violation(with_faults(cloud(spark, d)))


def with_faults(t: DataFrame) -> DataFrame:
    """Every eighth row each with a position, scale, rotation, opacity, dc, norm or rest that can't be."""
    kind, single = F.col("gidx") % 8, lambda v: F.lit(v).cast("float")
    broken = lambda c, k, v, at: F.when(kind == at, F.col(c).withField(k, single(v))).otherwise(F.col(c))
    t = t.withColumns({"position": broken("position", "z", float("inf"), 0), "scale": broken("scale", "y", 0.0, 1), "dc": broken("dc", "b", float("nan"), 4), "opacity": F.when(kind == 3, single(-0.25)).otherwise(F.col("opacity"))})
    turned = F.when(kind == 2, F.col("rotation").withField("j", single(float("nan")))).when(kind == 5, F.struct(*[single(1.0).alias(k) for k in "wijk"])).otherwise(F.col("rotation"))
    return t.withColumns({"rotation": turned, "rest": F.when(kind == 6, F.transform("rest", lambda c: c.withField("r", single(float("nan"))))).otherwise(F.col("rest"))})


@query("a02_every_warning", "SELECT asset_id, count(*) FILTER (WHERE gidx % 9 <> 0 AND abs(n2 - 1) > 1e-5 AND n2 > 1e-20) AS normalised, count(*) FILTER (WHERE gidx % 9 = 0 OR n2 <= 1e-20) AS replaced FROM r GROUP BY 1")
def _(spark, d):
    none = {f"rot_{k}": F.when(F.col("gidx") % 9 == 0, 0.0).otherwise(F.col(f"rot_{k}")) for k in range(4)}
    return C.warning_counts(decode(raw(spark, d).withColumns(none)), "asset_id")


@query("k01_k02_layer_lines", "SELECT asset_id, p.part, CAST(CASE p.part WHEN 0 THEN 19 WHEN 1 THEN 1 WHEN 9 THEN 2 ELSE count(*) END AS BIGINT) AS n, CASE p.part WHEN 1 THEN 0 ELSE 1 END AS ends FROM r, (VALUES (0), (1), (2), (3), (4), (5), (6), (9)) p(part) GROUP BY 1, 2")
def _(spark, d):
    t = numbered(cloud(spark, d))
    lines = L.layer_lines(t, meta_of(t), "ply")
    ends = F.count_if(F.col("line").rlike(r"\]$") & F.col("part").between(2, 6) | F.col("line").isin("}", "        int radiance:sphericalHarmonicsDegree = 3")).cast("int")
    return lines.groupBy("asset_id", "part").agg(F.count("*").alias("n"), ends.alias("ends"))


@query("k03_metadata_layer", "SELECT asset_id, string_agg(line, '|' ORDER BY k) AS text FROM (SELECT asset_id, unnest([1, 2, 3]) AS k, unnest(['        uint64 \"gs:gaussianCount\" = ' || count(*), '        int \"gs:shDegree\" = 3', '        string \"gs:sourceFormat\" = \"spz\"']) AS line FROM r GROUP BY 1) GROUP BY 1")
def _(spark, d):
    lines = L.metadata_lines(meta_of(raw(spark, d)), "spz").filter(F.col("line").contains("gs:"))
    return lines.groupBy("asset_id").agg(F.sort_array(F.collect_list(F.struct("at", "line"))).alias("l")).select("asset_id", F.array_join(F.transform("l", lambda x: x["line"]), "|").alias("text"))


@query("k10_stats_line", "SELECT CAST(asset_id AS VARCHAR) AS asset_id, 'import format=\"ply\" version=\"1.0\" gaussians=' || count(*) || ' shDegree=3 sourceBytes=' || count(*) * 236 || ' decodedBytes=' || count(*) * 236 || ' boundsMin=' || " + " || ',' || ".join(f"printf('%.6g', min({s}{f4(a)} - r))" for s, a in (("", "x"), ("-", "y"), ("-", "z"))) + " || ' boundsMax=' || " + " || ',' || ".join(f"printf('%.6g', max({s}{f4(a)} + r))" for s, a in (("", "x"), ("-", "y"), ("-", "z"))) + " || ' readSeconds=0.25 decodeSeconds=0 authorSeconds=0' AS line FROM (SELECT *, " + f4("CAST(3.0 AS DOUBLE) * greatest(" + ", ".join(f4(f"es{k}") for k in range(3)) + ")") + " AS r FROM c) GROUP BY 1")
def _(spark, d):
    t = cloud(spark, d)
    return L.stats_lines(t, meta_of(t, ("source_format", F.lit("ply")), ("source_version", F.lit("1.0")), ("source_bytes", F.col("gaussian_count") * 236), ("read_seconds", F.lit(0.25))))


@query("f01_e202_all_filtered", "SELECT asset_id, 'SF-PLY-E202' AS code FROM c GROUP BY 1 HAVING max(CAST(a AS FLOAT)) < CAST(0.99 AS FLOAT)")
def _(spark, d):
    t = cloud(spark, d)
    return G.not_all_filtered(t, C.opacity_at_least(t, 0.99))


@query("j01_zip", "SELECT asset_id, gidx, gidx % 10 <> 0 AS whole FROM r")
def _(spark, d):
    t = raw(spark, d)
    part = lambda c: t.select("asset_id", "gidx", F.col(c).alias("value"))
    return G.zipped({"position": part("x"), "opacity": part("opacity").filter("gidx % 10 <> 0"), "scale": part("scale_0")}).select("asset_id", "gidx", "whole")


@query("u02_unknown_properties", "SELECT p_partkey AS id, array_to_string(list_sort(list_filter([p_brand, 'x', 'nx', 'f_rest_3', 'f_rest_a', 'opacity'], lambda p: p NOT IN ('x', 'nx', 'opacity') AND NOT regexp_matches(p, '^f_rest_[0-9]+$'))), ',') AS unknown FROM part", raw=False)
def _(spark, d):
    names = F.array("p_brand", *map(F.lit, ("x", "nx", "f_rest_3", "f_rest_a", "opacity")))
    t = spark.read.parquet(f"{d}/part.parquet")
    return t.select(F.col("p_partkey").alias("id"), F.array_join(G.unknown_properties(names, ["x", "nx", "opacity"]), ",").alias("unknown"))


@query("p35_checked_length", "SELECT l_orderkey AS id, l_linenumber AS n, CASE WHEN l_linenumber <= 4 AND v <= 9223372036854775807 THEN CAST(v AS BIGINT) ELSE -1 END AS length FROM (SELECT *, CAST(l_orderkey AS HUGEINT) * 1000000000000000 * (l_linenumber * l_linenumber - 1) AS v FROM lineitem)", raw=False)
def _(spark, d):
    t = spark.read.parquet(f"{d}/lineitem.parquet").withColumn("c", F.try_multiply(F.col("l_orderkey").cast("long"), F.lit(1000000000000000)))
    length = F.coalesce(G.checked_rest_length(F.col("c"), F.col("l_linenumber") - 1), F.when(F.col("l_linenumber") == 1, F.lit(0)), F.lit(-1))  # -1: too many
    return t.select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("n"), length.cast("long").alias("length"))


@query("p25_half_even", "SELECT l_orderkey AS id, l_linenumber AS n, least(greatest(CAST(round_even(((l_orderkey + l_linenumber) % 601 - 40) / CAST(2 AS DOUBLE), 0) AS BIGINT), 0), 255) AS byte, CAST(round_even((l_orderkey % 999 - 500) / CAST(8192 AS DOUBLE) * 4096.0, 0) AS BIGINT) & 16777215 AS fixed FROM lineitem", raw=False)
def _(spark, d):
    t = spark.read.parquet(f"{d}/lineitem.parquet")
    return t.select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("n"), K.to_byte(((F.col("l_orderkey") + F.col("l_linenumber")) % 601 - 40) / 2.0).alias("byte"), K.quantise_fixed24((F.col("l_orderkey") % 999 - 500) / 8192.0, 12).alias("fixed"))


@query("p09_half", "SELECT id, e = 31 AS special, CASE WHEN e < 31 THEN round(CAST(s * CASE WHEN e = 0 THEN f * pow(2.0, -24) ELSE (1 + f / CAST(1024 AS DOUBLE)) * pow(2.0, e - 15) END AS DOUBLE), 9) + 0.0 END AS value FROM (SELECT p_partkey AS id, b & 1023 AS f, (b >> 10) & 31 AS e, CASE WHEN b >= 32768 THEN -1 ELSE 1 END AS s FROM (SELECT p_partkey, CAST(p_partkey * 7919 % 65536 AS BIGINT) AS b FROM part))", raw=False)
def _(spark, d):
    t = spark.read.parquet(f"{d}/part.parquet").select(F.col("p_partkey").alias("id"), (F.col("p_partkey") * 7919 % 65536).cast("int").alias("b")).withColumn("v", K.half_to_float(F.col("b")))
    fine = K.finite(F.col("v"))
    return t.select("id", (~fine).alias("special"), (F.round(F.when(fine, F.col("v")), 9) + F.lit(0.0)).alias("value"))


@query("a14_mismatch_counts", "SELECT 'dc' AS field, count(*) AS n FROM r WHERE gidx % 5 = 1 HAVING count(*) > 0 UNION ALL SELECT 'opacity', count(*) FROM r WHERE gidx % 13 = 2 HAVING count(*) > 0")
def _(spark, d):
    a = cloud(spark, d)
    b = a.withColumn("opacity", F.when(F.col("gidx") % 13 == 2, (F.col("opacity") + 1).cast("float")).otherwise(F.col("opacity"))).withColumn("dc", F.when(F.col("gidx") % 5 == 1, F.col("dc").withField("g", (F.col("dc.g") + 1).cast("float"))).otherwise(F.col("dc")))
    return G.mismatch_counts(a, b, {"scale": 1e-3})


@query("a16_candidates", "SELECT asset_id, count(*) AS source_count, count(*) FILTER (WHERE x BETWEEN -10 AND 10 AND y BETWEEN -12 AND 8 AND z BETWEEN -20 AND 20) AS candidates FROM r GROUP BY 1")
def _(spark, d):
    return C.candidates(raw(spark, d), (-10, -12, -20), (10, 8, 20))


@query("p39_hash", "SELECT doc_id, sha256(coalesce(text, '')) AS sha256 FROM documents", raw=False)
def _(spark, d):
    return spark.read.parquet(f"{d}/documents.parquet").select("doc_id", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("sha256"))
