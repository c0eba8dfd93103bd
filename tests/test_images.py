"""Images of other writers: every PNG filter and depth, every TIFF layout, against the arrays that they were made of."""

import struct
import zlib

import numpy as np
import pytest

from seaswath.sources import images, raster

GRAY = np.random.default_rng(1).integers(0, 256, (9, 13)).astype(np.uint8)


def filtered(raw: np.ndarray, kinds: list[int], step: int) -> bytes:
    """Rows of bytes by the filters' definitions, byte by byte."""
    out, above = b"", np.zeros(raw.shape[1], int)
    for row, kind in zip(raw.astype(int), kinds, strict=True):
        left = np.concatenate([np.zeros(step, int), row[:-step]])
        corner = np.concatenate([np.zeros(step, int), above[:-step]])
        guess = left + above - corner
        a, b, c = abs(guess - left), abs(guess - above), abs(guess - corner)
        nearest = np.where((a <= b) & (a <= c), left, np.where(b <= c, above, corner))
        less = [0 * row, left, above, (left + above) // 2, nearest][kind]
        out += bytes([kind]) + ((row - less) % 256).astype(np.uint8).tobytes()
        above = row
    return out


def png(raw: np.ndarray, w: int, depth: int, colour: int, kinds, step: int, palette: bytes = b"", cut: int = 40) -> bytes:
    data = zlib.compress(filtered(raw, kinds, step))
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    parts = [chunk(b"IHDR", struct.pack(">IIBBBBB", w, len(raw), depth, colour, 0, 0, 0))] + ([chunk(b"PLTE", palette)] if palette else [])
    return images.SIGNATURE + b"".join(parts + [chunk(b"IDAT", data[i : i + cut]) for i in range(0, len(data), cut)] + [chunk(b"IEND", b"")])


@pytest.mark.parametrize("kind", [0, 1, 2, 3, 4, None])
def test_png_filters(kind):
    kinds = [i % 5 for i in range(9)] if kind is None else [kind] * 9
    assert np.array_equal(list(images.png_rows(png(GRAY, 13, 8, 0, kinds, 1))), GRAY)
    rgb = np.random.default_rng(2).integers(0, 256, (9, 13, 3)).astype(np.uint8)
    want = np.rint(rgb @ np.array([0.299, 0.587, 0.114]))
    assert np.array_equal(list(images.png_rows(png(rgb.reshape(9, -1), 13, 8, 2, kinds, 3))), want)
    alpha = np.concatenate([rgb, np.full((9, 13, 1), 7, np.uint8)], 2)
    assert np.array_equal(list(images.png_rows(png(alpha.reshape(9, -1), 13, 8, 6, kinds, 4))), want)
    deep = np.stack([GRAY, GRAY[::-1]], 2)  # 16 bits, the upper byte first
    assert np.array_equal(list(images.png_rows(png(deep.reshape(9, -1), 13, 16, 0, kinds, 2))), GRAY)


@pytest.mark.parametrize("depth", [1, 2, 4, 8])
def test_png_palettes_and_few_bits(depth):
    values = (GRAY % (1 << depth) if depth < 8 else GRAY).astype(np.uint8)
    bits = ((values[:, :, None] >> np.arange(depth)[::-1]) & 1).reshape(9, -1).astype(np.uint8)
    raw = np.packbits(bits, axis=1)
    palette = np.random.default_rng(3).integers(0, 256, (1 << depth, 3)).astype(np.uint8)
    kinds = [i % 5 for i in range(9)]
    got = list(images.png_rows(png(raw, 13, depth, 3, kinds, 1, palette.tobytes())))
    assert np.array_equal(got, np.rint(palette[values] @ np.array([0.299, 0.587, 0.114])))
    assert np.array_equal(list(images.png_rows(png(raw, 13, depth, 0, kinds, 1))), values.astype(int) * 255 // ((1 << depth) - 1))


def test_pngs_as_rows(spark, tmp_path):
    (tmp_path / "a.png").write_bytes(raster.png(np.tile(GRAY, (60, 1))))
    (tmp_path / "b.png").write_bytes(png(GRAY, 13, 8, 0, [4] * 9, 1))
    rows = images.read_pngs(spark.read.format("binaryFile").load(f"file://{tmp_path}"))
    got = rows.orderBy("line", "ping").collect()
    assert [(r.line, r.ping) for r in got] == [("a", i) for i in range(540)] + [("b", i) for i in range(9)]
    assert np.array_equal([r.gray for r in got], np.tile(GRAY, (61, 1)))
    with pytest.raises(ValueError):
        list(images.png_rows(b"no image"))


def lzw_encoded(data: bytes) -> bytes:
    """Codes of the longest known strings, one code early."""
    codes, table, now = [(256, 9)], {bytes([i]): i for i in range(256)}, b""
    size, width = 258, 9
    for byte in data:
        if now + bytes([byte]) in table:
            now += bytes([byte])
            continue
        codes.append((table[now], width))
        table[now + bytes([byte])] = size
        size, now = size + 1, bytes([byte])
        width = min(12, (size).bit_length())
        if size == 4094:
            codes.append((256, width))
            table, size, width = {bytes([i]): i for i in range(256)}, 258, 9
    if now:
        codes.append((table[now], width))
        width = min(12, (size + 1).bit_length())
    codes.append((257, width))
    bits = "".join(f"{c:0{n}b}" for c, n in codes)
    return int(bits.ljust(-(-len(bits) // 8) * 8, "0"), 2).to_bytes(-(-len(bits) // 8), "big")


def packed(data: bytes) -> bytes:
    return b"".join(bytes([257 - 3, data[i]]) if len(set(data[i : i + 3])) == 1 and len(data[i : i + 3]) == 3 else bytes([len(data[i : i + 3]) - 1]) + data[i : i + 3] for i in range(0, len(data), 3))


ENCODED = {1: bytes, 5: lzw_encoded, 8: zlib.compress, 32773: packed}


def tiff(image: np.ndarray, order: str, tile: tuple[int, int] | None, compression: int, predictor: int, big: bool = False, samples: int = 1, nodata: bytes = b"") -> bytes:
    """A GeoTIFF by hand: strips of four rows, or tiles."""
    h, w = image.shape
    kind = image.dtype.newbyteorder(order)
    high, wide = tile or (4, w)
    raw = []
    for top in range(0, h, high):
        for left in range(0, w, wide):
            part = image[top : top + high, left : left + wide]
            if tile:
                part = np.pad(part, ((0, high - part.shape[0]), (0, wide - part.shape[1])), constant_values=9)
            part = np.repeat(part[:, :, None], samples, 2)
            part[:, :, 1:] = 5
            if predictor == 2:
                part = np.concatenate([part[:, :1], np.diff(part, axis=1)], 1)
            data = part.astype(kind).tobytes()
            if predictor == 3:
                planes = part.astype(kind.newbyteorder(">")).reshape(len(part), -1).view(np.uint8).reshape(len(part), -1, kind.itemsize).transpose(0, 2, 1).reshape(len(part), -1, samples)
                data = np.concatenate([planes[:, :1], np.diff(planes, axis=1)], 1).astype(np.uint8).tobytes()
            raw.append(ENCODED[compression](data))
    offset, count, n = ("Q", "Q", 8) if big else ("I", "I", 4)
    form = {"u": 1, "i": 2, "f": 3}[image.dtype.kind]
    tags = [(256, 4, "I", [w]), (257, 4, "I", [h]), (258, 3, "H", [8 * kind.itemsize] * samples), (259, 3, "H", [compression]), (277, 3, "H", [samples]), (317, 3, "H", [predictor]), (339, 3, "H", [form])]
    tags += [(33550, 12, "d", [0.5, 0.5, 0.0]), (33922, 12, "d", [0, 0, 0, 100.0, 900.0, 0]), (34735, 3, "H", [1, 1, 0, 1, 3072, 0, 1, 4499])] + ([(42113, 2, "s", nodata)] if nodata else [])
    where, sizes = (324, 325) if tile else (273, 279)
    tags += [(322, 3, "H", [wide]), (323, 3, "H", [high])] if tile else [(278, 3, "H", [4])]
    tags += [(where, 16 if big else 4, offset, [0] * len(raw)), (sizes, 16 if big else 4, count, [len(r) for r in raw])]
    tags.sort()
    pack = lambda k, v: v if k == "s" else struct.pack(f"{order}{len(v)}{k}", *v)
    head = 16 if big else 8
    start = head + (8 if big else 2) + len(tags) * (20 if big else 12) + n
    places = start + sum(len(pack(k, v)) for _, _, k, v in tags if len(pack(k, v)) > n)
    places = [places + sum(len(r) for r in raw[:i]) for i in range(len(raw))]
    out = struct.pack(f"{order}2sHHHQ" if big else f"{order}2sHI", *((b"II" if order == "<" else b"MM", 43, 8, 0, 16) if big else (b"II" if order == "<" else b"MM", 42, 8)))
    out += struct.pack(f"{order}{'Q' if big else 'H'}", len(tags))
    tail = b""
    for tag, code, k, v in tags:
        body = pack(k, places if tag == where else v)
        out += struct.pack(f"{order}HH{offset}", tag, code, len(v)) + (body.ljust(n, b"\0") if len(body) <= n else struct.pack(f"{order}{offset}", start + len(tail)))
        tail += body if len(body) > n else b""
    return out + b"\0" * n + tail + b"".join(raw)


def test_geotiff_layouts(spark, tmp_path):
    """Strips and tiles, four compressions, predictors, both byte orders, several bands, large files' form: all read alike, a tile a row."""
    image = np.random.default_rng(4).integers(0, 9, (21, 37))
    image[4:9] = 3
    folder, n = tmp_path / "tif", 0
    folder.mkdir()
    for order in "<>":
        for tile in (None, (16, 16)):
            for compression in ENCODED:
                for predictor, dtype in ((1, np.uint8), (2, np.uint8), (2, np.uint16), (1, np.int16), (1, np.float32), (3, np.float32)):
                    for big, samples in ((False, 1), (True, 1), (False, 3)):
                        made = tiff(image.astype(dtype), order, tile, compression, predictor, big, samples, b"7\0" if samples == 1 else b"")
                        pieces = images.pieces("x/a.tif", lambda at, size, made=made: made[at : at + size])
                        got = np.zeros((21, 37))
                        for p in pieces.itertuples():
                            part = images.piece_pixels(made[p.offset : p.offset + p.size], p.high, p.wide, p.kind, p.compression, p.predictor, p.samples)
                            got[p.top : p.top + p.high, p.left : p.left + p.wide] = part[: 21 - p.top, : 37 - p.left]
                        assert np.array_equal(got, image), (order, tile, compression, predictor, dtype, big, samples)
                        n += 1
                        if samples == 1 and predictor == 2:
                            (folder / f"t{n}.tif").write_bytes(made)
    pixels, meta = images.read_geotiffs(spark.read.format("binaryFile").load(f"file://{folder}").select("path", "length"), 8)
    assert {tuple(r)[1:] for r in meta.collect()} == {(100.0, 900.0, 0.5, 21, 37, 4499)}
    counts = {r["count"] for r in pixels.groupBy("line").count().collect()}
    assert counts == {int(((image > 0) & (image != 7)).sum())}
    first = {(r.row, r.col): r.value for r in pixels.where(f"line = '{meta.first().line}'").collect()}
    assert first == {(r, c): image[r, c] for r, c in zip(*np.nonzero((image > 0) & (image != 7)), strict=True)}
    own = raster.geotiff(image.astype(np.uint8), 100.0, 900.0, 0.5, 4499)
    assert len(images.pieces("a.tif", lambda at, size: own[at : at + size])) == 1


def test_long_lzw_strips():
    data = np.random.default_rng(5).integers(0, 50, 40_000).astype(np.uint8).tobytes()
    assert images.lzw(lzw_encoded(data)) == data and images.lzw(lzw_encoded(b"")) == b""
