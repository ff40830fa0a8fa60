"""Readers against files made here, and each reader's errors."""

import gzip
import struct

import numpy as np
import pytest

from splatframe.plans.cloud import decode
from splatframe.sources import files, ply, spz
from splatframe.sources.errors import SourceError


def ply_bytes(n=3, n_rest=9, ascii_=False, **change):
    rng = np.random.default_rng(n)
    columns = {name: rng.normal(size=n).astype(np.float32) for name in ply.REQUIRED} | {k: np.asarray(v, np.float32) for k, v in change.items()}
    rest = rng.normal(size=(n, n_rest)).astype(np.float32)
    return ply.encode(columns, rest, ("comment made by a test",), ascii_), columns, rest


def spz_bytes(version=2, degree=1, n=2, fill=None):
    h = spz.Header(version, n, degree, 12, 0)
    rng = np.random.default_rng(version)
    return spz.encode(h, streams := {k: rng.integers(0, 256 if k != "positions" else 60, (n, w)).astype(np.uint8) for k, w in h.widths().items()}), h, streams


@pytest.mark.parametrize("ascii_", [False, True])
def test_ply_round_trip(spark, tmp_path, ascii_):
    data, columns, rest = ply_bytes(5, 45, ascii_)
    (tmp_path / "a.ply").write_bytes(data)
    got = files.read_ply(spark, str(tmp_path)).orderBy("gidx").toPandas()
    assert list(got.gidx) == list(range(5)) and np.array_equal(np.stack(got.f_rest), rest)
    assert all(np.array_equal(got[n].to_numpy(np.float32), columns[n]) for n in ply.REQUIRED)
    cloud = decode(files.read_ply(spark, str(tmp_path))).orderBy("gidx").collect()
    assert np.allclose([r.position.y for r in cloud], -columns["y"]) and np.allclose([r.rest[1].g for r in cloud], -1 * rest[:, 16])


def test_known_splat(spark, tmp_path):
    values = dict(x=1, y=2, z=3, scale_0=0, scale_1=np.log(2), scale_2=-np.log(2), rot_0=2, rot_1=0, rot_2=0, rot_3=0, opacity=0, f_dc_0=0.1, f_dc_1=0.2, f_dc_2=0.3)
    (tmp_path / "one.ply").write_bytes(ply_bytes(1, 0, **{k: [v] for k, v in values.items()})[0])
    row = decode(files.read_ply(spark, str(tmp_path))).first()
    assert tuple(row.position) == (1, -2, -3) and np.allclose(tuple(row.scale), (1, 2, 0.5)) and row.rotation.w == 1 and row.opacity == 0.5 and row.rest == []


def changed(old, new, **kw):
    data = ply_bytes(**kw)[0]
    assert old in data
    return data.replace(old, new, 1)


BAD_PLY = {
    "E001": b"ply\nformat ascii 1.0\nelement vertex 1\nproperty float x\nend_header\n1\n", "E002": changed(b"vertex 3", b"vertex 0"), "E003": changed(b"float opacity", b"float opaque"),
    "E004": changed(b"property float f_rest_0\n", b"property list uchar float f_rest_0\n"), "E005": changed(b"f_rest_8", b"f_rest_x"), "E006": changed(b"f_rest_8", b"f_rest_7"), "E007": changed(b"f_rest_8", b"f_rest_9"),
    "E008": ply_bytes(n_rest=8)[0], "E009": ply_bytes(n_rest=6)[0], "E010": ply_bytes(opacity=[0, np.nan, 0])[0], "E012": ply_bytes(scale_0=[100, 0, 0])[0], "E017": ply_bytes(n_rest=72)[0], "E014": ply_bytes()[0][:-1], "E015": b"plx\n",
}


@pytest.mark.parametrize("code", BAD_PLY)
def test_bad_ply(code):
    with pytest.raises(SourceError) as e:
        h = ply.parse_header(BAD_PLY[code])
        ply.read_columns(BAD_PLY[code], h, ply.layout(h)[1])
    assert e.value.code == f"SF-PLY-{code}"


@pytest.mark.parametrize("version", [1, 2, 3])
def test_spz_round_trip(spark, tmp_path, version):
    data, h, s = spz_bytes(version, 3, 4)
    (tmp_path / "a.spz").write_bytes(data)
    cloud = files.decode_spz(files.read_spz(spark, str(tmp_path))).orderBy("gidx").collect()
    first = s["positions"].tobytes()[: 2 if version == 1 else 3]
    assert cloud[0].position.x == (np.frombuffer(first, "<f2")[0] if version == 1 else int.from_bytes(first, "little", signed=True) / 4096)
    for k, row in enumerate(cloud):
        assert row.opacity == np.float32(s["alphas"][k, 0] / 255) and len(row.rest) == 15 and row.rest[14].b == (int(s["sh"][k, 44]) - 128) / 128
        assert abs(sum(v * v for v in row.rotation) - 1) < 1e-6 and np.isclose(row.scale.z, np.exp(s["scales"][k, 2] / 16 - 10))


def test_spz_without_rest(spark, tmp_path):
    (tmp_path / "a.spz").write_bytes(spz_bytes(2, 0)[0])
    assert [r.rest for r in files.decode_spz(files.read_spz(spark, str(tmp_path))).collect()] == [[], []]


def member(version=2, count=1, degree=0, flags=0, body=b"\0" * 19, magic=b"NGSP"):
    return gzip.compress(struct.pack("<4sIIBBBB", magic, version, count, degree, 12, flags, 0) + body, mtime=0)


BAD_SPZ = [("E001", b"hello"), ("E001", member(magic=b"ABCD")), ("E002", member(count=0)), ("E003", member(version=5)), ("E003", b"NGSP\4\0\0\0"), ("E004", b"NGSP\2\0\0\0"), ("E004", member()[:8]), ("E005", member(count=2**31)), ("E006", member(degree=5)), ("E007", member(count=10**6)), ("E007", member(body=b"\0" * 18)), ("E008", member()[:-5] + b"\1" + member()[-4:]), ("E009", member(body=b"\0" * 20)), ("E009", member() + b"x"), ("E011", member(degree=4))]


@pytest.mark.parametrize("code,data", BAD_SPZ)
def test_bad_spz(code, data):
    with pytest.raises(SourceError) as e:
        spz.read_streams(data)
    assert e.value.code == f"SF-SPZ-{code}"


def test_spz_extensions_and_routing():
    assert spz.read_streams(member(flags=2, body=b"\0" * 50))[0].count == 1
    assert spz.is_spz(member(version=9)) and spz.is_spz(b"NGSP") and not spz.is_spz(gzip.compress(b"abcd")) and not spz.is_spz(b"")
    assert ply.is_splat("a.PLY", ply_bytes()[0]) and not ply.is_splat("a.txt", ply_bytes()[0]) and not ply.is_splat("a.ply", b"")


def test_metadata(spark, tmp_path):
    (tmp_path / "a.ply").write_bytes(ply_bytes()[0])
    (tmp_path / "b.spz").write_bytes(spz_bytes(3, 2)[0])
    (tmp_path / "c.ply").write_bytes(b"plx\n")
    rows = [tuple(r)[1:5] + (r.code,) for r in files.metadata(spark, str(tmp_path)).orderBy("asset_id").collect()]
    assert rows == [("ply", "1.0", 3, 1, None), ("spz", "3", 2, 2, None), ("ply", None, None, None, "SF-PLY-E015")]
