"""Images of other writers: PNG of any row filter and depth, GeoTIFF in strips or tiles, of either byte order.

PNGs are inflated row by row, so that a task holds two rows of an image. GeoTIFFs are read in two steps: one reads the directories,
a row a strip or tile; these are dealt out, and each task reads and decodes its own ones alone. Files are opened through
pyarrow's file systems by the names that Spark lists.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seaswath.operators.ordered import LINE
from seaswath.sources.jsf import _opened

SIGNATURE = b"\x89PNG\r\n\x1a\n"
#: Samples a pixel by PNG colour type, and the shares of red, green and blue in gray.
SAMPLES, SHARES = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}, (0.299, 0.587, 0.114)


def line_of(path: str) -> str:
    return path.rpartition("/")[2].rpartition(".")[0]


# PNG.


def unfiltered(kind: int, row: np.ndarray, above: np.ndarray, step: int) -> np.ndarray:
    """Bytes of a row of one of the five filters; above: the row before it, step: bytes of a pixel."""
    if kind == 0:
        return row
    if kind == 1:  # less the pixel to the left: sums of bytes, cut to a byte
        return np.cumsum(row.reshape(-1, step), axis=0, dtype=np.uint8).ravel()
    if kind == 2:
        return row + above
    if kind not in (3, 4):
        raise ValueError(f"unknown row filter {kind}")
    out, up = row.tolist(), above.tolist()
    for i, x in enumerate(out):
        left, corner = (out[i - step], up[i - step]) if i >= step else (0, 0)
        if kind == 3:
            out[i] = x + (left + up[i]) // 2 & 255
        else:  # whichever of left, above and corner is nearest to left + above - corner, in this order
            guess = left + up[i] - corner
            out[i] = x + min((left, up[i], corner), key=lambda v: abs(guess - v)) & 255
    return np.array(out, np.uint8)


def png_rows(data: bytes) -> Iterator[np.ndarray]:
    """Rows of gray levels, 0 to 255: colours by their brightness, transparency ignored, the upper byte of 16 bits, fewer bits spread."""
    if data[:8] != SIGNATURE:
        raise ValueError("not a PNG")
    at, palette, head, inflate, held, above = 8, None, None, zlib.decompressobj(), b"", None
    while at + 8 <= len(data):
        n, kind = struct.unpack(">I4s", data[at : at + 8])
        body = memoryview(data)[at + 8 : at + 8 + n]
        at += 12 + n
        if kind == b"IHDR":
            w, h, depth, colour, _, _, interlaced = struct.unpack(">IIBBBBB", body)
            if interlaced:
                raise ValueError("interlaced PNGs are not read")
            head = (w, depth, colour, -(-w * depth * SAMPLES[colour] // 8), max(1, depth * SAMPLES[colour] // 8))
            above = np.zeros(head[3], np.uint8)
        elif kind == b"PLTE":
            palette = np.frombuffer(body, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            pending = bytes(body)
            while pending or len(held) > head[3]:
                held += inflate.decompress(pending, 1 << 16)
                pending = inflate.unconsumed_tail
                while len(held) > head[3]:
                    above = unfiltered(held[0], np.frombuffer(held, np.uint8, head[3], 1), above, head[4])
                    held = held[head[3] + 1 :]
                    yield gray_of(above, *head[:3], palette)


def gray_of(row: np.ndarray, w: int, depth: int, colour: int, palette: np.ndarray | None) -> np.ndarray:
    if depth < 8:
        bits = np.unpackbits(row).reshape(-1, depth)[:w]
        values = bits @ (1 << np.arange(depth)[::-1])
        row = values if colour == 3 else values * 255 // ((1 << depth) - 1)
    elif depth == 16:
        row = row[::2]
    if colour == 3:
        if palette is None:
            raise ValueError("a palette image without a palette")
        row, colour = palette[row].ravel(), 2
    pixels = row.reshape(w, SAMPLES[colour])
    return (np.rint(pixels[:, :3] @ np.array(SHARES)) if colour in (2, 6) else pixels[:, 0]).astype(np.int16)


def read_pngs(files: DataFrame) -> DataFrame:
    """line, ping, gray of rows (path, content), as Spark's binaryFile gives them: a row a line of each image."""

    def run(batches):
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                rows: list[np.ndarray] = []
                begin = 0
                for row in png_rows(bytes(content)):
                    rows.append(row)
                    if len(rows) == 256:
                        yield pd.DataFrame({LINE: line_of(path), "ping": np.arange(begin, begin + 256, dtype=np.int32), "gray": rows})
                        begin, rows = begin + 256, []
                if rows:
                    yield pd.DataFrame({LINE: line_of(path), "ping": np.arange(begin, begin + len(rows), dtype=np.int32), "gray": rows})

    return files.select("path", "content").mapInPandas(run, f"{LINE} string, ping int, gray array<smallint>")


# GeoTIFF.

#: Numbers of TIFF tags, and sizes of its types.
WIDTH, LENGTH, BITS, COMPRESSION, STRIPS, SAMPLES_A_PIXEL, ROWS, COUNTS, PLANAR, PREDICTOR, FORMAT = 256, 257, 258, 259, 273, 277, 278, 279, 284, 317, 339
TILE_WIDTH, TILE_LENGTH, TILES, TILE_COUNTS, SCALE, TIEPOINT, KEYS, NODATA = 322, 323, 324, 325, 33550, 33922, 34735, 42113
TYPES = {1: "B", 2: "s", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 13: "I", 16: "Q", 17: "q", 18: "Q"}
PIECES = "path string, line string, ulx double, uly double, res double, h int, w int, epsg int, nodata double, top int, left int, high int, wide int, offset long, size long, kind string, compression int, predictor int, samples int"


def directory(load: Callable[[int, int], bytes]) -> tuple[str, dict[int, tuple]]:
    """(byte order, values by tag) of a file's first image; load gives n bytes from an offset on."""
    head = load(0, 16)
    order = {b"II": "<", b"MM": ">"}.get(head[:2])
    version = struct.unpack(f"{order}H", head[2:4])[0] if order else 0
    if version not in (42, 43):
        raise ValueError("not a TIFF")
    big = version == 43
    at = struct.unpack(f"{order}Q", head[8:16])[0] if big else struct.unpack(f"{order}I", head[4:8])[0]
    count_size, entry, inline = (8, 20, 8) if big else (2, 12, 4)
    n = struct.unpack(f"{order}{'Q' if big else 'H'}", load(at, count_size))[0]
    table, found = load(at + count_size, n * entry), {}
    for i in range(n):
        tag, code, count = struct.unpack(f"{order}HH{'Q' if big else 'I'}", table[i * entry : i * entry + entry - inline])
        if code not in TYPES:
            continue
        size, place = struct.calcsize(f"<{count}{TYPES[code]}"), table[(i + 1) * entry - inline : (i + 1) * entry]
        raw = place[:size] if size <= inline else load(struct.unpack(f"{order}{'Q' if big else 'I'}", place)[0], size)
        found[tag] = struct.unpack(f"{order}{count}{TYPES[code]}", raw)
    return order, found


def pieces(path: str, load: Callable[[int, int], bytes]) -> pd.DataFrame:
    """A row for each strip or tile of the first band (see PIECES)."""
    order, t = directory(load)
    one = lambda tag, default=None: t[tag][0] if tag in t else default
    w, h = one(WIDTH), one(LENGTH)
    tiled = TILES in t
    wide, high = (one(TILE_WIDTH), one(TILE_LENGTH)) if tiled else (w, min(one(ROWS, h), h))
    across, down = -(-w // wide), -(-h // high)
    offsets, sizes = (t[TILES], t[TILE_COUNTS]) if tiled else (t[STRIPS], t[COUNTS])
    chunky = one(PLANAR, 1) == 1
    kind = {1: "u", 2: "i", 3: "f"}[one(FORMAT, 1)] + str(one(BITS, 1) // 8)
    keys = t.get(KEYS, ())
    epsg = next((keys[i + 3] for i in range(4, len(keys), 4) if keys[i] in (3072, 2048)), 0)
    nodata = float(one(NODATA, b"nan").rstrip(b"\0 ") or "nan")
    i = np.arange(across * down)  # of planes one after another, the first
    scale, tie = t.get(SCALE, (1.0, 1.0)), t.get(TIEPOINT, (0.0,) * 6)
    top, left = i // across * high, i % across * wide
    # Tiles are whole even beyond the image's edges; the last strip is cut.
    rows = np.full(len(i), high) if tiled else np.minimum(high, h - top)
    common = {"path": path, "line": line_of(path), "ulx": tie[3] - tie[0] * scale[0], "uly": tie[4] + tie[1] * scale[1], "res": float(scale[0]), "h": h, "w": w, "epsg": epsg, "nodata": nodata}
    about = {"kind": order + kind, "compression": one(COMPRESSION, 1), "predictor": one(PREDICTOR, 1), "samples": one(SAMPLES_A_PIXEL, 1) if chunky else 1}
    return pd.DataFrame({**common, "top": top, "left": left, "high": rows, "wide": wide, "offset": np.array(offsets[: len(i)], np.int64), "size": np.array(sizes[: len(i)], np.int64), **about})


def lzw(data: bytes) -> bytes:
    """Bytes of codes of 9 to 12 bits, highest bit first, whose width grows one code early."""
    out, table, width, held, bits, before = [], [], 9, 0, 0, None
    for byte in data:
        held, bits = (held << 8 | byte) & 0xFFFFFF, bits + 8
        if bits < width:
            continue
        bits -= width
        code = held >> bits & (1 << width) - 1
        if code == 257:
            break
        if code == 256:
            table, width, before = [bytes([i]) for i in range(256)] + [b"", b""], 9, None
            continue
        now = table[code] if code < len(table) else before + before[:1]
        if before is not None:
            table.append(before + now[:1])
        out.append(now)
        before = now
        width = min(12, max(9, (len(table) + 1).bit_length()))
    return b"".join(out)


def packbits(data: bytes) -> bytes:
    """Bytes of runs: a length and so many bytes, or a negative length and one byte that repeats."""
    out, at = [], 0
    while at < len(data):
        n = data[at] if data[at] < 128 else data[at] - 256
        if n >= 0:
            out.append(data[at + 1 : at + 2 + n])
            at += n + 2
        else:
            out.append(data[at + 1 : at + 2] * (1 - n) if n > -128 else b"")
            at += 2 if n > -128 else 1
    return b"".join(out)


DECODED: dict[int, Callable[[bytes], bytes]] = {1: bytes, 5: lzw, 8: zlib.decompress, 32946: zlib.decompress, 32773: packbits}


def piece_pixels(raw: bytes, high: int, wide: int, kind: str, compression: int, predictor: int, samples: int) -> np.ndarray:
    """(high, wide) values of the first band of a strip or tile."""
    if compression not in DECODED:
        raise ValueError(f"unknown compression {compression}")
    raw, dtype = DECODED[compression](raw), np.dtype(kind)
    if predictor == 3:  # differences of bytes, the highest bytes of a row first
        each = np.cumsum(np.frombuffer(raw, np.uint8, high * wide * samples * dtype.itemsize).reshape(high, -1, samples), axis=1, dtype=np.uint8)
        planes = each.reshape(high, dtype.itemsize, wide * samples).transpose(0, 2, 1)
        return np.ascontiguousarray(planes).view(f">f{dtype.itemsize}").reshape(high, wide, samples)[:, :, 0]
    values = np.frombuffer(raw, dtype, high * wide * samples).reshape(high, wide, samples)
    if predictor == 2:
        values = np.cumsum(values, axis=1, dtype=dtype.newbyteorder("="))
    return values[:, :, 0]


def read_geotiffs(files: DataFrame, parts: int) -> tuple[DataFrame, DataFrame]:
    """(pixels, meta) of rows (path, length): values above 0 that are not the file's mark of no data."""

    def heads(batches):
        for batch in batches:
            for path in batch["path"]:
                fs, place = _opened(path)
                with fs.open_input_file(place) as f:
                    yield pieces(path, lambda at, n: f.read_at(n, at))

    def decode(batches):
        for batch in batches:
            for path, group in batch.groupby("path"):
                fs, place = _opened(path)
                with fs.open_input_file(place) as f:
                    for p in group.itertuples():
                        image = piece_pixels(f.read_at(p.size, p.offset), p.high, p.wide, p.kind, p.compression, p.predictor, p.samples)[: p.h - p.top, : p.w - p.left]
                        r, c = np.nonzero((image > 0) & (image != p.nodata))
                        yield pd.DataFrame({"line": p.line, "row": (r + p.top).astype(np.int32), "col": (c + p.left).astype(np.int32), "value": image[r, c].astype(np.float64)})

    listed = files.select("path").mapInPandas(heads, PIECES)
    meta = listed.where("top = 0 AND left = 0").select(LINE, "ulx", "uly", "res", "h", "w", "epsg")
    pixels = listed.repartition(parts, "path", "top", "left").mapInPandas(decode, "line string, `row` int, col int, value double")
    return pixels, meta
