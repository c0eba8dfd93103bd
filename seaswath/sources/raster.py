"""Raster files: gray and colour PNG, one-band GeoTIFF, written from tasks block by block.

A raster is cut into blocks of BLOCK pixels a side; each becomes a file with its own place on the ground,
so that neither a task nor the driver holds a whole mosaic. A raster that fits into a block is one file.
Files are written through pyarrow's file systems (local, HDFS, S3); `out` must be a folder that all
executors share.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seaswath.operators.ordered import LINE

BLOCK = 4096
#: Numbers of TIFF tags.
TAGS = {"width": 256, "length": 257, "bits": 258, "compression": 259, "photometric": 262, "strips": 273, "samples": 277, "rows": 278, "counts": 279, "scale": 33550, "tiepoint": 33922, "keys": 34735, "nodata": 42113}


def png(image: np.ndarray) -> bytes:
    """An 8-bit PNG of a (h, w) gray or (h, w, 3) colour image."""
    image = np.ascontiguousarray(image, np.uint8)
    h, w = image.shape[:2]
    rows = np.concatenate([np.zeros((h, 1), np.uint8), image.reshape(h, -1)], 1)

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    head = struct.pack(">IIBBBBB", w, h, 8, 2 if image.ndim == 3 else 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows.tobytes(), 6)) + chunk(b"IEND", b"")


def png_pixels(data: bytes) -> np.ndarray:
    """The image of a PNG that `png` wrote (no interlace, no row filter)."""
    at, parts, size = 8, [], (0, 0, 1)
    while at < len(data):
        n, kind = struct.unpack(">I4s", data[at : at + 8])
        body = data[at + 8 : at + 8 + n]
        if kind == b"IHDR":
            w, h, _, colour = struct.unpack(">IIBB", body[:10])
            size = (h, w, 3 if colour == 2 else 1)
        elif kind == b"IDAT":
            parts.append(body)
        at += 12 + n
    rows = np.frombuffer(zlib.decompress(b"".join(parts)), np.uint8).reshape(size[0], -1)[:, 1:]
    return rows.reshape(size) if size[2] == 3 else rows


def geotiff(image: np.ndarray, ulx: float, uly: float, res: float, epsg: int, nodata: float | None = None) -> bytes:
    """One band of bytes or floats, deflated in strips, with place and reference system."""
    image = np.ascontiguousarray(image)
    floats = image.dtype.kind == "f"
    image = image.astype("<f4" if floats else np.uint8)
    h, w = image.shape
    rows = max(1, (1 << 20) // max(1, w))
    strips = [zlib.compress(image[i : i + rows].tobytes(), 6) for i in range(0, h, rows)]
    entries = [
        (TAGS["width"], "I", [w]), (TAGS["length"], "I", [h]), (TAGS["bits"], "H", [32 if floats else 8]), (TAGS["compression"], "H", [8]),
        (TAGS["photometric"], "H", [1]), (TAGS["strips"], "I", [0] * len(strips)), (TAGS["samples"], "H", [1]), (TAGS["rows"], "I", [rows]),
        (TAGS["counts"], "I", [len(s) for s in strips]), (339, "H", [3 if floats else 1]), (TAGS["scale"], "d", [res, res, 0.0]),
        (TAGS["tiepoint"], "d", [0.0, 0.0, 0.0, ulx, uly, 0.0]), (TAGS["keys"], "H", [1, 1, 0, 3, 1024, 0, 1, 1, 1025, 0, 1, 1, 3072, 0, 1, epsg]),
    ]
    if nodata is not None:
        entries.append((TAGS["nodata"], "s", f"{nodata:g}\0".encode()))
    start = 8 + 2 + 12 * len(entries) + 4
    after = start + sum(n for n in (_size(kind, v) for _, kind, v in entries) if n > 4)
    places = np.cumsum([after, *(len(s) for s in strips)])[:-1].tolist()
    entries = [(t, k, places if t == TAGS["strips"] else v) for t, k, v in entries]
    head, tail = struct.pack("<2sHIH", b"II", 42, 8, len(entries)), b""
    for tag, kind, values in sorted(entries):
        raw = values if kind == "s" else struct.pack(f"<{len(values)}{kind}", *values)
        code = {"H": 3, "I": 4, "d": 12, "s": 2}[kind]
        inline = raw.ljust(4, b"\0") if len(raw) <= 4 else struct.pack("<I", start + len(tail))
        head += struct.pack("<HHI", tag, code, len(values)) + inline
        tail += b"" if len(raw) <= 4 else raw
    return head + b"\0\0\0\0" + tail + b"".join(strips)


def _size(kind: str, values) -> int:
    return len(values) * {"H": 2, "I": 4, "d": 8, "s": 1}[kind]


def geotiff_pixels(data: bytes) -> tuple[np.ndarray, dict]:
    """The band of a little-endian stripped one-band GeoTIFF (plain or deflated), and {ulx, uly, res, epsg}."""
    if data[:4] != b"II*\0":
        raise ValueError("not a little-endian TIFF")
    (at,) = struct.unpack("<I", data[4:8])
    (n,) = struct.unpack("<H", data[at : at + 2])
    found = {}
    for i in range(n):
        tag, code, count = struct.unpack("<HHI", data[at + 2 + 12 * i : at + 10 + 12 * i])
        kind = {1: "B", 2: "s", 3: "H", 4: "I", 11: "f", 12: "d"}[code]
        size = struct.calcsize(f"<{count}{kind}")
        place = at + 10 + 12 * i if size <= 4 else struct.unpack("<I", data[at + 10 + 12 * i : at + 14 + 12 * i])[0]
        found[tag] = struct.unpack(f"<{count}{kind}", data[place : place + size])
    w, h = found[TAGS["width"]][0], found[TAGS["length"]][0]
    raw = [data[a : a + c] for a, c in zip(found[TAGS["strips"]], found[TAGS["counts"]], strict=True)]
    if found.get(TAGS["compression"], (1,))[0] in (8, 32946):
        raw = [zlib.decompress(r) for r in raw]
    kind = {8: np.uint8, 32: "<f4"}[found[TAGS["bits"]][0]]
    scale, tie, keys = found[TAGS["scale"]], found[TAGS["tiepoint"]], found.get(TAGS["keys"], ())
    epsg = next((keys[i + 3] for i in range(4, len(keys), 4) if keys[i] == 3072), 0)
    return np.frombuffer(b"".join(raw), kind).reshape(h, w), {"ulx": tie[3], "uly": tie[4], "res": scale[0], "epsg": epsg}


def save(files: DataFrame, out: str) -> None:
    """Writes rows (name, content) as files below the folder `out`."""

    def run(rows):
        import pyarrow.fs as pafs

        fs, root = pafs.FileSystem.from_uri(out)
        fs.create_dir(root, recursive=True)
        for r in rows:
            with fs.open_output_stream(f"{root}/{r.name}") as f:
                f.write(bytes(r.content))

    files.select("name", "content").foreachPartition(run)


def geotiffs(pixels: DataFrame, meta: DataFrame, suffix: str = "-bs-geocoding", block: int = BLOCK) -> DataFrame:
    """name, content: the files of every line's raster. meta: line, ulx, uly, res, h, w, epsg."""
    grid = meta.withColumn("_r", F.explode(F.sequence(F.lit(0), F.floor((F.col("h") - 1) / block).cast("int")))).withColumn("_c", F.explode(F.sequence(F.lit(0), F.floor((F.col("w") - 1) / block).cast("int"))))
    dealt = pixels.select(LINE, "row", "col", "value", F.floor(F.col("row") / block).cast("int").alias("_r"), F.floor(F.col("col") / block).cast("int").alias("_c"))
    keys = [LINE, "_r", "_c"]

    def run(key: tuple, blocks: pd.DataFrame, group: pd.DataFrame) -> pd.DataFrame:
        if not len(blocks):
            return pd.DataFrame({"name": [], "content": []})
        line, r, c = key
        m = blocks.iloc[0]
        h, w = int(min(block, m["h"] - r * block)), int(min(block, m["w"] - c * block))
        image = np.zeros((h, w), np.uint8)
        inside = group[(group["row"] - r * block < h) & (group["col"] - c * block < w)]
        image[inside["row"] - r * block, inside["col"] - c * block] = inside["value"]
        one = m["h"] <= block and m["w"] <= block
        name = f"{line}{suffix}{'' if one else f'-{r}-{c}'}.tif"
        return pd.DataFrame({"name": [name], "content": [geotiff(image, m["ulx"] + c * block * m["res"], m["uly"] - r * block * m["res"], m["res"], int(m["epsg"]))]})

    return grid.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInPandas(run, "name string, content binary")


def read_geotiffs(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pixels, meta) of rows (path, content), as Spark's binaryFile gives them: values above 0."""

    def decode(batches):
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                image, m = geotiff_pixels(bytes(content))
                line = path.rpartition("/")[2].rpartition(".")[0]
                r, c = np.nonzero(image)
                yield pd.DataFrame({"line": line, "row": r.astype(np.int32), "col": c.astype(np.int32), "value": image[r, c].astype(np.int16)})

    def heads(batches):
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                image, m = geotiff_pixels(bytes(content))
                yield pd.DataFrame({"line": [path.rpartition("/")[2].rpartition(".")[0]], "ulx": m["ulx"], "uly": m["uly"], "res": m["res"], "h": image.shape[0], "w": image.shape[1], "epsg": int(m["epsg"])})

    rows = files.select("path", "content")
    return rows.mapInPandas(decode, "line string, `row` int, col int, value smallint"), rows.mapInPandas(heads, "line string, ulx double, uly double, res double, h int, w int, epsg int")


def pngs(rows: DataFrame, column: str = "gray", suffix: str = "", marks: str | None = None, block: int = BLOCK) -> DataFrame:
    """name, content: waterfall images by line, `block` pings a file; columns in the array `marks` are drawn in red."""
    dealt = rows.select(LINE, "ping", column, *([marks] if marks else []), F.floor(F.col("ping") / block).cast("int").alias("_b"))
    size = rows.groupBy(LINE).agg((F.max("ping") + 1).alias("_n"))

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("ping")
        image = np.clip(np.stack(group[column].to_numpy()), 0, 255).astype(np.uint8)
        if marks:
            image = np.repeat(image[:, :, None], 3, 2)
            for row, at in zip(image, group[marks], strict=True):
                at = np.asarray(at, np.int64)
                row[at[(at >= 0) & (at < len(row))]] = (255, 0, 0)
        whole = int(group["_n"].iloc[0]) <= block
        return pd.DataFrame({"name": [f"{key[0]}{suffix}{'' if whole else f'-{key[1]}'}.png"], "content": [png(image)]})

    return dealt.join(size, LINE).groupBy(LINE, "_b").applyInPandas(run, "name string, content binary")


def bottom_text(bottom: DataFrame, out: str) -> None:
    """port_x, stbd_x and ping of each line, separated by blanks, in a folder for each line."""
    text = bottom.select(LINE, F.concat_ws(" ", "port_x", "stbd_x", "ping").alias("value"), "ping")
    text.repartitionByRange(LINE, "ping").sortWithinPartitions(LINE, "ping").select(LINE, "value").write.mode("overwrite").partitionBy(LINE).text(out)


def read_bottom_text(spark, path: str, line: str | None = None) -> DataFrame:
    """line, ping, port_x, stbd_x: of one file (named line), or of a folder that `bottom_text` wrote."""
    rows = spark.read.schema("port_x int, stbd_x int, ping int" + ("" if line else ", line string")).option("sep", " ").csv(path)
    return (rows.withColumn(LINE, F.lit(line)) if line else rows).select(LINE, "ping", "port_x", "stbd_x")


def preferred(first: DataFrame, second: DataFrame) -> DataFrame:
    """Bottom rows of `first` for the lines it has, else those of `second`."""
    return first.unionByName(second.join(first.select(LINE).distinct(), LINE, "left_anti").select(*first.columns))
