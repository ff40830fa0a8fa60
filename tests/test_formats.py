"""Image-plane files, lossless images, data sources, subsets, sinks and the gate."""

import io
import json
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from splatframe.operators import diagnostics, layers
from splatframe.plans import assets
from splatframe.plans.cloud import decode
from splatframe.sources import files, formats, ply, sog, spz, subsets, webp
from splatframe.sources.errors import SourceError


def splats(n=40, degree=3, seed=1):
    r = np.random.default_rng(seed)
    q = r.normal(size=(n, 4))
    return {
        "position": (r.normal(size=(n, 3)) * 10).astype("f4"), "scale": np.exp(r.normal(size=(n, 3))).astype("f4"), "rotation": (q / np.sqrt((q**2).sum(1, keepdims=True))).astype("f4"),
        "opacity": (r.integers(0, 256, n) / 255).astype("f4"), "dc": r.choice(np.linspace(-2, 2, 50), (n, 3)).astype("f4"), "rest": r.choice(np.linspace(-1, 1, 80), (n, (degree + 1) ** 2 - 1, 3)).astype("f4"),
    }


def raw_ply(n=30, seed=2):
    r = np.random.default_rng(seed)
    return {name: r.normal(size=n).astype("f4") for name in ply.REQUIRED}, r.normal(size=(n, 9)).astype("f4")


@pytest.mark.parametrize("shape", [(1, 1), (3, 7), (13, 17), (1, 300)])
def test_image_round_trip(shape):
    image = np.random.default_rng(0).integers(0, 256, (*shape, 4), dtype=np.uint8)
    assert (webp.decode(webp.encode(image)) == image).all()


def written(pairs):
    out = "".join(f"{v:0{n}b}"[::-1] if n else "" for v, n in pairs)
    data = b"\x2f" + bytes(int(out[k : k + 8].ljust(8, "0")[::-1], 2) for k in range(0, len(out), 8))
    return b"RIFF" + (12 + len(data) + len(data) % 2).to_bytes(4, "little") + b"WEBPVP8L" + len(data).to_bytes(4, "little") + data + b"\0" * (len(data) % 2)


def simple(*symbols):
    return [(1, 1), (len(symbols) - 1, 1), (1, 1), *[(s, 8) for s in symbols]]


def test_image_with_green_subtracted_copies_and_cache():
    """4 x 2: pixels 0x80ff0a05 after subtraction; a literal, a copy of 3 from the left and of 4 from above."""
    head = [(3, 14), (1, 14), (1, 1), (0, 3), (1, 1), (2, 2), (0, 1)]
    # green: symbols 10 (literal) and 258 (length 3), 259 (length 4) have codes of 1, 2 and 2 bits
    lengths = {10: 1, 258: 2, 259: 2}
    of = [(0, 1), (8, 4), *[(n, 3) for n in (0, 2, 2, 2, 2)], *[(0, 3)] * 7]  # lengths 1, 2 and runs 18, 0
    codes = {0: (0, 2), 1: (1, 2), 2: (2, 2), 18: (3, 2)}
    rev = lambda c: (int(f"{c[0]:0{c[1]}b}"[::-1], 2), c[1])
    body = [*[rev(codes[0])] * 10, rev(codes[1]), rev(codes[18]), (127, 7), rev(codes[18]), (109 - 11, 7), rev(codes[2]), rev(codes[2]), *[rev(codes[0])] * 20]
    assert 10 + 1 + 138 + 109 == 258 and 260 + 20 == 280 and lengths
    tail = [*simple(245), *simple(251), *simple(128), (1, 1), (1, 1), (0, 1), (0, 1), (1, 8)]  # distances: places 1 and 2
    green = {10: rev((0, 1)), 258: rev((2, 2)), 259: rev((3, 2))}
    pixels = [green[10], green[258], (1, 1), green[259], (0, 1)]
    image = webp.decode(written([*head, (0, 1), (0, 1), *of, (0, 1), *body, *tail, *pixels]))
    assert image.shape == (2, 4, 4) and (image == [255, 10, 5, 128]).all()


def test_predictors():
    top, left, corner, right = [200, 10, 20, 30], [100, 50, 60, 70], [90, 40, 30, 20], [10, 20, 30, 40]
    assert webp.predicted(1, left, top, corner, right) == left and webp.predicted(7, left, top, corner, right) == [150, 30, 40, 50]
    assert webp.predicted(12, left, top, corner, right) == [210, 20, 50, 80] and webp.predicted(13, left, top, corner, right)[0] == 180


@pytest.mark.parametrize("data", [b"", b"RIFF\0\0\0\0WEBP", webp.encode_lossy_stub(4, 4), webp.encode(np.zeros((9, 9, 4), np.uint8))[:60]])
def test_bad_images(data):
    with pytest.raises((webp.ImageError, IndexError)):
        webp.decode(data)


@pytest.mark.parametrize("text", ['{"a":1,"a":2}', "[NaN]", "1e999", "{} x", "[" * 40 + "]" * 40, '"\\ud800"', "[1,]", "'a'", "[Infinity]"])
def test_strict_json_refuses(text):
    with pytest.raises(ValueError):
        sog.strict_json(text.encode())


def test_strict_json_takes():
    assert sog.strict_json(b'\xef\xbb\xbf {"a": [1, 2.5, null, "\\ud83d\\ude00[["]}') == {"a": [1.0, 2.5, None, "\U0001f600[["]}


@pytest.mark.parametrize("degree", [0, 1, 2, 3])
def test_both_layouts_are_equal(spark, tmp_path, degree):
    c = splats(degree=degree)
    made = sog.encode(c, degree)
    (tmp_path / "b").mkdir()
    (tmp_path / "u").mkdir()
    (tmp_path / "b" / "a.sog").write_bytes(sog.bundled(made, deflate=True))
    for name, data in made.items():
        (tmp_path / "u" / name).write_bytes(data)
    one, two = (files.read_sog(spark, str(tmp_path / k)).drop("asset_id").orderBy("gidx").collect() for k in "bu")
    assert one == two and len(one) == 40
    back, beyond = sog.columns(sog.read(sog.bundled(made)))
    assert beyond == 0 and np.abs(back["rest"] - c["rest"]).max(initial=0) < 1e-6 and np.abs(back["dc"] - c["dc"]).max() < 1e-6
    assert (back["opacity"] == c["opacity"]).all() and np.abs(back["position"] - c["position"]).max() < 0.01
    cloud = files.decode_sog(files.read_sog(spark, str(tmp_path / "b"))).orderBy("gidx").collect()
    assert all(r.position.y == -np.float32(p[1]) and len(r.rest) == (degree + 1) ** 2 - 1 for r, p in zip(cloud, back["position"], strict=True))


def damaged(**changes):
    made = sog.encode(splats(n=9), 3)
    meta = json.loads(made["meta.json"])
    for key, value in changes.items():
        at, *path = key.split("__")
        part = meta
        for step in path:
            part, at = part[at], step
        if value is None:
            del part[at]
        else:
            part[at] = value
    return made | {"meta.json": json.dumps(meta).encode()}


@pytest.mark.parametrize(
    "code, changes",
    [("E003", {"version": None}), ("E003", {"version": 3}), ("E003", {"version": 2.5}), ("E012", {"count": 0}), ("E006", {"count": -1}), ("E006", {"count": 100}), ("E005", {"means": None}), ("E005", {"means__mins": [0, 1]}), ("E011", {"scales__codebook": [0.0]}), ("E011", {"scales__codebook": [200.0] * 256}),
     ("E005", {"quats__files": ["../a"]}), ("E005", {"quats__files": ["con.webp"]}), ("E008", {"quats__files": ["b.webp"]}), ("E007", {"shN__bands": 4}), ("E009", {"shN__bands": 2}), ("E009", {"shN__count": 1000}), ("E005", {"shN": 3})],
)
def test_bad_metadata(code, changes):
    with pytest.raises(SourceError) as e:
        sog.columns(sog.read(sog.bundled(damaged(**changes))))
    assert e.value.code == f"SF-SOG-{code}"


def test_labels_beyond_the_palette_have_no_rest():
    made = damaged(shN__count=2)
    back, beyond = sog.columns(sog.read(made["meta.json"], made.get))
    assert beyond == 7 and (np.abs(back["rest"]).max((1, 2)) == 0).sum() >= 7


def test_bad_containers():
    for data, code in ((b"PK\x03\x04 no archive", "E004"), (b"hello", "E002"), (b"{", "E005")):
        with pytest.raises(SourceError) as e:
            sog.read(data)
        assert e.value.code == f"SF-SOG-{code}"
    empty = io.BytesIO()
    with zipfile.ZipFile(empty, "w") as z:
        z.writestr("x", "y")
    with pytest.raises(SourceError, match="E002"):
        sog.read(empty.getvalue())
    made = sog.encode(splats(), 3)
    lossy = made | {"quats.webp": webp.encode_lossy_stub(9, 9)}
    with pytest.raises(SourceError, match="E009"):
        sog.read(lossy["meta.json"], lossy.get)
    tagged = made | {"quats.webp": webp.encode(np.zeros((7, 7, 4), np.uint8))}
    with pytest.raises(SourceError, match="E013"):
        sog.columns(sog.read(tagged["meta.json"], tagged.get))


def test_routing():
    made = sog.encode(splats(), 0)
    assert formats.format_of("a.sog", sog.bundled(made)) == "splat_sog" and formats.format_of("x/meta.json", made["meta.json"]) == "splat_sog"
    assert formats.format_of("a.json", b"[]") is None and formats.format_of("a.sog", b"x") is None and formats.format_of("a.txt", b"") is None
    assert formats.format_of("a.ply", ply.encode(*raw_ply())) == "splat_ply"


def test_data_sources(spark, tmp_path):
    formats.register(spark)
    columns, rest = raw_ply()
    (tmp_path / "a.ply").write_bytes(ply.encode(columns, rest))
    (tmp_path / "b.ply").write_bytes(ply.encode(columns, rest, ascii_=True))
    (tmp_path / "c.sog").write_bytes(sog.bundled(sog.encode(splats(degree=1), 1)))
    df = spark.read.format("splat_ply").option("rowsPerTask", "7").load(str(tmp_path))
    assert df.rdd.getNumPartitions() == 6
    got = df.filter(F.col("asset_id").endswith("a.ply")).orderBy("gidx").collect()
    assert [r.gidx for r in got] == list(range(30)) and [r.x for r in got] == columns["x"].tolist() and got[9].f_rest == rest[9].tolist()
    assert decode(df).count() == 60
    meta = spark.read.format("splat_ply").option("metadataOnly", "true").load(str(tmp_path)).collect()
    assert [(r.gaussian_count, r.sh_degree) for r in meta] == [(30, 1)] * 2
    assert spark.read.format("splat_sog").load(str(tmp_path)).count() == 40
    with pytest.raises(Exception, match="SF-PLY-E203"):
        df.write.format("splat_ply").mode("append").save(str(tmp_path / "no"))
    with pytest.raises(SourceError, match="SF-SPZ-E201"):
        layers.write_back("spz")


@pytest.mark.parametrize("kind", ["float", "list"])
def test_vertices_after_another_element(kind):
    columns, rest = raw_ply()
    data = ply.encode(columns, rest)
    other = b"element face 2\nproperty list uchar int v\n" if kind == "list" else b"element face 2\nproperty float v\n"
    rows = (b"\x01\1\0\0\0" + b"\x02\1\0\0\0\2\0\0\0") if kind == "list" else b"\0" * 8
    data = data.replace(b"element vertex", other + b"element vertex").replace(b"end_header\n", b"end_header\n" + rows)
    h = ply.parse_header(data)
    got, more = ply.read_columns(data, h, 9)
    assert (got["opacity"] == columns["opacity"]).all() and (more == rest).all()


def test_subsets_copy_records():
    columns, rest = raw_ply()
    data = ply.encode(columns, rest, ("comment kept",))
    keep = np.array([3, 4, 20])
    out, n, degree = subsets.ply_subset(data, keep)
    got, more = ply.read_columns(out, ply.parse_header(out), 9)
    assert n == 30 and degree == 1 and (got["x"] == columns["x"][keep]).all() and (more == rest[keep]).all() and b"comment kept" in out and subsets.sha256(data).encode() in out
    packed = assets.to_spz({k: v.astype("f8") for k, v in columns.items()}, rest[:, :9].astype("f8"))
    part, n, _ = subsets.spz_subset(packed[:9] + b"\x03" + packed[10:], keep) if packed[3] == 0 else (b"", 0, 0)
    assert n == 30 and part[9] == 3 and (spz.read_streams(part)[1]["alphas"] == spz.read_streams(packed)[1]["alphas"][keep]).all()


@pytest.mark.parametrize("change", ["element face 1\nproperty float a\n", "property double z2\n"])
def test_subsets_refuse(change):
    data = ply.encode(*raw_ply()).replace(b"end_header", change.encode() + b"end_header")
    with pytest.raises(SourceError):
        subsets.ply_subset(data, np.array([0]))


def one_cloud(spark, n=3):
    columns, rest = raw_ply(n)
    files_ = spark.createDataFrame([("a.ply", bytearray(ply.encode(columns, rest)))], "path string, content binary")
    return decode(files.ply_rows(files_))


def meta(spark, n=3, degree=1):
    return spark.createDataFrame([("a.ply", n, degree)], "asset_id string, gaussian_count long, sh_degree int")


def test_gate(spark):
    c = one_cloud(spark)
    assert diagnostics.gated(c, meta(spark), "ply").count() == 3
    bad = {"count": (c, meta(spark, 0)), "length": (c.filter("gidx <> 1"), meta(spark)), "degree": (c, meta(spark, 3, 4)), "rest_length": (c, meta(spark, 3, 2)), "value": (c.withColumn("opacity", F.lit(2.0).cast("float")), meta(spark))}
    for problem, (cloud, m) in bad.items():
        with pytest.raises(SourceError, match=problem) as e:
            diagnostics.gated(cloud, m, "sog")
        assert e.value.code == "SF-SOG-E014"
    assert diagnostics.warnings(c).filter("code = 'SF-PLY-W001'").first().message == "3 rotations were normalised"


def test_layer_text(spark, tmp_path):
    c = one_cloud(spark)
    layers.write_layers(layers.layer_lines(c, meta(spark), "ply"), str(tmp_path / "out"))
    text = "\n".join(p.read_text().rstrip("\n") for p in sorted((tmp_path / "out").rglob("part-*")))
    assert text.startswith("#usda 1.0\n(\n") and text.endswith("    }\n}") and text.count("[") - 6 == text.count("[]") and 'string "gs:sourceFormat" = "ply"' in text
    assert text.count("(") == text.count(")") and "float[] opacities = [" in text and "quatf[] orientations = [(" in text
    layers.write_flat(c, str(tmp_path / "flat"))
    assert spark.read.parquet(str(tmp_path / "flat")).count() == 3


@pytest.mark.parametrize("version", [1, 2, 3])
def test_decoding_where_files_are_read_is_the_same(spark, tmp_path, version):
    formats.register(spark)
    r = np.random.default_rng(4)
    h = spz.Header(version, 50, 1, 12, 0)
    streams = {n: r.integers(0, 256, (50, w), dtype=np.uint8) for n, w in h.widths().items()}
    if version == 1:
        streams["positions"][:, 1::2] &= 0xBB  # finite halves
    (tmp_path / "a.spz").write_bytes(spz.encode(h, streams))
    (tmp_path / "a.ply").write_bytes(ply.encode(*raw_ply()))
    for kind, slow in (("spz", lambda df: files.decode_spz(df)), ("ply", decode)):
        want, got = (df.orderBy("gidx").collect() for df in (slow(spark.read.format(f"splat_{kind}").load(str(tmp_path))), spark.read.format(f"splat_{kind}").option("decoded", "true").option("rowsPerTask", "7").load(str(tmp_path))))
        flat = lambda rows: np.array([[*x.position, *x.scale, *x.rotation, x.opacity, *x.dc, *[v for c in x.rest for v in c], x.was_replaced, x.was_changed] for x in rows], np.float64)
        assert len(want) == len(got) and np.allclose(flat(want), flat(got), rtol=3e-7, atol=1e-7)
