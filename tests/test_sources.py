"""Files: sonar messages there and back, rasters, bottom lines, the stages and the stream over a made-up survey."""

import numpy as np
import pytest

from seaswath.operators import ingest
from seaswath.plans import store, tile
from seaswath.sources import jsf, raster
from seaswath.streaming import ingest as stream
from seaswath.types import Params


def survey(pings=60, n=40, lon0=123.0):
    rng = np.random.default_rng(7)
    out = []
    for i in range(pings):
        for channel in (0, 1):
            if (i, channel) == (5, 1):
                continue
            half = np.where(np.arange(n) < 8, rng.integers(0, 3, n), rng.integers(90, 140, n))
            sonar = {"pingnumber": 100 + i, "X": int((lon0 + i * 1e-6) * 6e5), "Y": int((37 + i * 8e-6) * 6e5), "heading": 100, "weightingfactor": 1, "nmeaspeed": 40}
            out.append({"subsystem": 20, "channel": channel, "sonar": sonar, "samples": half * 2})
        if i % 20 == 0:
            out.append({"payload": b"other", "subsystem": 20})
    return out


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "in").mkdir()
    for name in ("a", "b"):
        (tmp_path / "in" / f"{name}.jsf").write_bytes(jsf.encoded(survey()))
    return tmp_path


def test_messages(spark, folder):
    m = jsf.read(spark, f"file://{folder}/in")
    assert m.count() == 2 * 122 and m.where("messagetype = 82").first().payload == b"other"
    one = m.where("messagetype = 80").first()
    assert len(one.sonardata) == 40 and one.sonar.weightingfactor == 1 and one.marker == 5633
    acoustic = ingest.acoustic(m, 20)
    assert ingest.pings(m, 20).count() == 2 * 59 and ingest.leftovers(acoustic).count() == 2
    assert {(r.ping_number, r.missing) for r in ingest.pairing_errors(acoustic).collect()} == {(105, "starboard")}
    assert ingest.pings(m.where("false"), 20).count() == 0
    jsf.register(spark)
    d = spark.read.format("jsf").load(f"file://{folder}/in")
    assert d.where("messagetype = 82").count() == 6 and d.count() == m.count()
    some = spark.read.format("jsf").options(subsystem=20, channel=0).load(f"file://{folder}/in")
    assert some.count() == m.where("subsystem = 20 AND channel = 0").count() == jsf.read(spark, f"file://{folder}/in", subsystem=20, channel=0).count()


@pytest.mark.parametrize("broken", [b"\1\2\3", b"\0" * 16, jsf.encoded(survey(1))[:-5]])
def test_broken_files(spark, tmp_path, broken):
    (tmp_path / "x.jsf").write_bytes(jsf.encoded(survey(2)) + broken)
    with pytest.raises(Exception, match="x, record"):
        jsf.read(spark, f"file://{tmp_path}").collect()
    rows = jsf.read(spark, f"file://{tmp_path}", "PERMISSIVE").collect()
    assert rows[-1].marker is None and rows[-1].payload


def held(raw):
    return jsf.Held(len(raw), lambda at, n: raw[at : at + n], block=64)


def tricky():
    """Records with false headers in their data, and what breaks them: the parts, and whether each is sound."""
    rng, mark = np.random.default_rng(3), jsf.MARK
    parts = []
    for i in range(120):
        false = mark + bytes(2) + (80).to_bytes(2, "little") + bytes(6) + (300).to_bytes(4, "little")
        kind = i % 6
        if kind == 0:
            parts.append((jsf.encoded([{"payload": false * 3 + mark, "subsystem": 20}]), True))
        elif kind == 1:
            parts.append((jsf.encoded([{"payload": jsf.encoded([{"payload": b"inner"}])[:-2]}]), True))
        elif kind == 2 and i % 4 == 0:
            parts.append((rng.integers(0, 256, 50, np.uint8).tobytes().replace(mark, b"\0\0") + mark + b"\0" * 9, False))
        elif kind == 3 and i % 9 == 3:
            parts.append((jsf.encoded([{"samples": [1, 2, 3], "sonar": {"samplecount": 7}}]), False))
        else:
            parts.append((jsf.encoded([{"samples": np.where(rng.random(60) < 0.3, 5633, rng.integers(-99, 99, 60)), "sonar": {"pingnumber": i}}]), True))
    return parts


def test_ranges_give_what_one_pass_gives(monkeypatch):
    """However a file is cut, each record is read once; broken bytes in the middle lose nothing else, and no byte goes."""
    parts = tricky()
    raw = b"".join(p for p, _ in parts)
    whole = list(jsf.records(held(raw)))
    begins = np.concatenate([[0], np.cumsum([len(p) for p, _ in parts])[:-1]]).tolist()
    assert {r["seq"] for r in whole if "error" not in r} == {b for b, (_, ok) in zip(begins, parts, strict=True) if ok}
    lost = b"".join(r["payload"] for r in whole if "error" in r)
    assert lost == b"".join(p for p, ok in parts if not ok)
    monkeypatch.setattr(jsf, "LOOK", 1500)
    for size in (37, 256, 1000, 4096, len(raw) + 1):
        cut = [r for at in range(0, len(raw), size) for r in jsf.records(held(raw), at, min(at + size, len(raw)))]
        assert [(r["seq"], r.get("error"), r["payload"]) for r in cut] == [(r["seq"], r.get("error"), r["payload"]) for r in whole], size
    some = list(jsf.records(held(raw), wanted={"messagetype": 80}))
    assert [r["seq"] for r in some] == [r["seq"] for r in whole if r.get("messagetype") == 80]
    monkeypatch.setattr(jsf, "PAYLOAD", 16)
    assert b"".join(r["payload"] for r in jsf.records(held(raw)) if "error" in r) == lost
    assert list(jsf.records(held(b""))) == []


def test_files_in_many_tasks(spark, tmp_path):
    """The data source and the ranges of file names read a cut file as a whole one, with spaces in its name."""
    raw = b"".join(p for p, _ in tricky())
    (tmp_path / "in put").mkdir()
    (tmp_path / "in put" / "a b.jsf").write_bytes(raw)
    (tmp_path / "in put" / "none.jsf").write_bytes(b"")
    folder, order = f"file://{tmp_path}/in put", ["line", "seq"]
    cut, one = jsf.read(spark, folder, "PERMISSIVE", split=700), jsf.read(spark, folder, "PERMISSIVE")
    assert cut.rdd.getNumPartitions() == -(-len(raw) // 700) and one.rdd.getNumPartitions() == 1
    want = [r.asDict(True) for r in one.orderBy(*order).collect()]
    assert [r.asDict(True) for r in cut.orderBy(*order).collect()] == want
    files = spark.read.format("binaryFile").load(folder)
    named = jsf.decoded_ranges(jsf.ranges(files.select("path", "length"), 5, 700), "PERMISSIVE", 700)
    assert [r.asDict(True) for r in named.orderBy(*order).collect()] == want
    assert [r.asDict(True) for r in jsf.decoded(files, "PERMISSIVE").orderBy(*order).collect()] == want
    assert cut.where("messagetype = 80").count() == sum(r["messagetype"] == 80 for r in want)
    with pytest.raises(Exception, match="a b, record at byte"):
        jsf.read(spark, folder, split=700).collect()


@pytest.mark.parametrize("weighting", range(6))
@pytest.mark.parametrize("form", [0, 1])
def test_samples_of_both_formats(weighting, form):
    """dataformat 1 has two shorts a sample; samples are scaled by two to the minus weighting factor."""
    samples = np.arange(-20, 20) * 32
    raw = jsf.encoded([{"samples": samples, "sonar": {"samplecount": 40 // (form + 1), "dataformat": form, "weightingfactor": weighting}}])
    (row,) = jsf.records(held(raw))
    assert row["sonar"]["dataformat"] == form and np.array_equal(row["sonardata"], samples / 2.0**weighting)


def test_preferred_bottom_lines(spark):
    """Lines of the first table stand as they are, whole; only lines that it lacks come from the second."""
    schema = "line string, ping int, port_x int, stbd_x int"
    first = spark.createDataFrame([("a", 0, 1, 2), ("a", 1, 1, 2)], schema)
    second = spark.createDataFrame([("a", 0, 9, 9), ("a", 2, 9, 9), ("b", 0, 3, 4), ("b", 1, 3, 4)], schema)
    got = {tuple(r) for r in raster.preferred(first, second).collect()}
    assert got == {("a", 0, 1, 2), ("a", 1, 1, 2), ("b", 0, 3, 4), ("b", 1, 3, 4)}
    assert raster.preferred(first.where("false"), second).count() == 4 and raster.preferred(first, second.where("false")).count() == 2


def test_rasters(spark, tmp_path):
    image = np.arange(12, dtype=np.uint8).reshape(3, 4)
    assert (raster.png_pixels(raster.png(image)) == image).all()
    colour = np.stack([image, image + 1, image + 2], 2)
    assert (raster.png_pixels(raster.png(colour)) == colour).all()
    got, where = raster.geotiff_pixels(raster.geotiff(image, 5.0, 9.0, 0.5, 4499))
    assert (got == image).all() and where == {"ulx": 5.0, "uly": 9.0, "res": 0.5, "epsg": 4499}
    floats, _ = raster.geotiff_pixels(raster.geotiff(image / 2, 0, 0, 1, 4490, -1))
    assert (floats == image / 2).all()
    meta = spark.createDataFrame([("a", 0.0, 10.0, 1.0, 5, 7, 4499), ("none", 0.0, 0.0, 1.0, 2, 2, 4499)], "line string, ulx double, uly double, res double, h int, w int, epsg int")
    pixels = spark.createDataFrame([("a", r, c, 1 + r * 7 + c) for r in range(5) for c in range(7)], "line string, row int, col int, value int")
    raster.save(raster.geotiffs(pixels, meta, block=4), f"file://{tmp_path}/tif")
    assert len(list((tmp_path / "tif").iterdir())) == 5
    read, heads = raster.read_geotiffs(spark.read.format("binaryFile").load(f"file://{tmp_path}/tif"))
    assert read.count() == 35 and heads.count() == 5


def test_stages(spark, folder):
    p = Params(slant_range=10.0, res=0.5, bottom_offset=(0, 0), track_s=1.0)
    out = f"file://{folder}/out"
    assert tile.run_ingest(spark, f"file://{folder}/in", out, p).count() == 118
    made = tile.run_tiles(spark, out, p)
    report = spark.read.parquet(f"{out}/qc_summary").collect()
    assert made.pixels.count() > 1000 and len(report) == 2 and report[0].time_cost > 0 and report[0].win_h == 10 and report[0].raw_angle_mean is None
    images = spark.read.parquet(f"{out}/qc_histograms")
    assert {(r.line, r.image): r["count"] for r in images.groupBy("line", "image").count().collect()} == {(n, i): 256 for n in "ab" for i in ("raw", "tvg", "gray")}
    angled = tile.quality(made, Params(slant_range=10.0, res=0.5, angle="heading", recorded_speed=False)).collect()
    assert {r.raw_angle_mean for r in angled} == {1.0} and {r.smoothed_angle_mean for r in angled} == {1.0} and {r.speed_mean for r in angled} == {None}
    names = {x.name for x in (folder / "out" / "geocoding").iterdir()}
    assert names == {"a_20-bs-geocoding.tif", "b_20-bs-geocoding.tif"}
    assert raster.read_bottom_text(spark, f"{out}/bottom_text").count() == 118
    assert tile.run_stitch(spark, out, p).count() == made.pixels.where("line = 'a'").count()


def test_stream(spark, folder):
    p = Params(slant_range=10.0, res=0.5)
    q = stream.start(spark, f"file://{folder}/in", f"file://{folder}/streamed", f"file://{folder}/check", p, once=True)
    q.awaitTermination(120)
    assert q.exception() is None and spark.read.parquet(f"file://{folder}/streamed").count() == 118


def test_only_new_and_changed_files_are_read(spark, folder, monkeypatch):
    """A second run reads nothing; a changed file replaces its line in all tables, a new one adds one, the others stay."""
    p, source, out = Params(slant_range=5.0, res=0.5), f"file://{folder}/in", f"file://{folder}/out"
    assert store.update(spark, source, out, p) == 2
    assert store.read(spark, out, "messages").count() == 2 * 122 and store.read(spark, out, "raw").count() == 2 * 59
    raw = store.read(spark, out, "raw").where("line = 'a'").first()
    assert len(raw.bs) == 80 and len(store.read(spark, out, "pings").first().bs) < 80
    kept = sorted((folder / "out" / "raw" / "line=b").iterdir())
    with monkeypatch.context() as m:
        m.setattr(jsf, "decoded_ranges", None)
        assert store.update(spark, source, out, p) == 0
    (folder / "in" / "a.jsf").write_bytes(jsf.encoded(survey(20)))
    (folder / "in" / "c.JSF").write_bytes(jsf.encoded(survey(30)))
    assert {r.line for r in store.pending(spark, source, out).collect()} == {"a", "c"}
    assert store.update(spark, source, out, p, split=5000) == 2
    counts = {r.line: r["count"] for r in store.read(spark, out, "pings").groupBy("line").count().collect()}
    assert counts == {"a": 19, "b": 59, "c": 29}
    assert {r.line: r["count"] for r in store.read(spark, out, "messages").groupBy("line").count().collect()} == {"a": 40, "b": 122, "c": 61}
    assert sorted((folder / "out" / "raw" / "line=b").iterdir()) == kept and store.update(spark, source, out, p) == 0
    assert store.manifest(spark, out).count() == 3
