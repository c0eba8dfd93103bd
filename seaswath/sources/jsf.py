"""Side-scan sonar message files (.jsf), of any size.

A record is a 16-byte header (marker 5633) and its data; data of type 80 begin with a 240-byte sonar header,
followed by 16-bit samples, scaled by the weighting factor. A file has no index, so it is cut into byte ranges of
SPLIT bytes: the records that begin in a range are its task's. Where the first of them begins is found from LOOK bytes
before the range on, by trying each marker and following the sizes of the records behind it, so that a range gives what one
pass over the whole file gives. The data source "jsf" (registered by `register`) reads ranges through pyarrow's file
systems and skips the samples of messages that pushed filters rule out; `read` uses it, and for stores that pyarrow does not
know lets Spark read whole files, which then have to fit into a task. `ranges` and `decoded_ranges` do the same for a stream of file names.

A record is unsound if its marker is wrong, it is cut short, or its number of samples does not match its size. The mode
FAILFAST raises; PERMISSIVE goes on at the next sound record and gives the bytes between as rows of null fields and
a `payload` of at most PAYLOAD bytes each. `seq` is the byte at which a record begins: it rises in a file, whatever the
ranges. Empty files give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from seaswath.types import HEADER_SIZE, MARKER, MESSAGE_FIELDS, MESSAGES, SONAR, SONAR_FIELDS, SONAR_SIZE


def _dtype(fields: list[tuple[str, str, int]], size: int) -> np.dtype:
    return np.dtype({"names": [f[0] for f in fields], "formats": [f[1] for f in fields], "offsets": [f[2] for f in fields], "itemsize": size})


HEADER, SONAR_HEADER = _dtype(MESSAGE_FIELDS, HEADER_SIZE), _dtype(SONAR_FIELDS, SONAR_SIZE)


class Corrupt(ValueError):
    """A record that does not follow the format."""


def _plain(record: np.void) -> dict:
    return {n: v.rstrip(b"\0").decode("latin-1") if isinstance(v, bytes) else v for n, v in zip(record.dtype.names, record.tolist(), strict=True)}


#: Bytes of a range; bytes before it that are read to find its first record; records whose markers are tried; bytes of a payload of what is not sound.
SPLIT, LOOK, CHAIN, PAYLOAD = 128 << 20, 1 << 20, 3, 16 << 20
MARK = MARKER.to_bytes(2, "little")


def sized(data: bytes, size: int) -> np.void:
    """The sonar header at the beginning of data of so many bytes; raises Corrupt."""
    if len(data) < SONAR_SIZE:
        raise Corrupt("sonar header cut short")
    head = np.frombuffer(data, SONAR_HEADER, 1)[0]
    if int(head["samplecount"]) * (int(head["dataformat"]) + 1) * 2 != size - SONAR_SIZE:
        raise Corrupt("number of samples does not match the size")
    return head


def sonar_of(data: bytes) -> tuple[dict, np.ndarray]:
    """Header fields and scaled samples of a message of type 80; of dataformat 1, both shorts of each sample."""
    fields = _plain(sized(data, len(data)))
    return fields, np.frombuffer(data, "<i2", offset=SONAR_SIZE) * 2.0 ** -fields["weightingfactor"]


class Held:
    """The bytes of a file, loaded block by block."""

    def __init__(self, size: int, load: Callable[[int, int], bytes], block: int = 4 << 20):
        self.size, self.load, self.block, self.begin, self.held = size, load, block, 0, b""

    def at(self, offset: int, n: int) -> bytes:
        """n bytes from offset on; fewer at the file's end."""
        n = max(0, min(n, self.size - offset))
        if not self.begin <= offset <= offset + n <= self.begin + len(self.held):
            if n > self.block:
                return self.load(offset, n)
            self.begin, self.held = offset, self.load(offset, min(self.block, self.size - offset))
        return self.held[offset - self.begin : offset - self.begin + n]

    def find(self, wanted: bytes, offset: int) -> int:
        """Where wanted stands first, from offset on; the size if nowhere."""
        while offset + len(wanted) <= self.size:
            block = self.at(offset, self.block)
            if (found := block.find(wanted)) >= 0:
                return offset + found
            offset += len(block) - len(wanted) + 1
        return self.size


def sound(data: Held, at: int) -> tuple[dict, int]:
    """The header fields of the record at a place, and where it ends; raises Corrupt."""
    head = data.at(at, HEADER_SIZE)
    if len(head) < HEADER_SIZE:
        raise Corrupt("header cut short")
    fields = _plain(np.frombuffer(head, HEADER, 1)[0])
    if fields["marker"] != MARKER:
        raise Corrupt(f"marker {fields['marker']}")
    end = at + HEADER_SIZE + fields["datasize"]
    if end > data.size:
        raise Corrupt("data cut short")
    if fields["messagetype"] == SONAR:
        sized(data.at(at + HEADER_SIZE, min(fields["datasize"], SONAR_SIZE)), fields["datasize"])
    return fields, end


def sure(data: Held, at: int) -> bool:
    """Whether a sound record begins at a place where nothing led to: its samples say so, or the markers of the next records."""
    try:
        fields, end = sound(data, at)
    except Corrupt:
        return False
    for _ in range(0 if fields["messagetype"] == SONAR else CHAIN):
        head = data.at(end, HEADER_SIZE)
        if not head:
            break
        if not head.startswith(MARK) or len(head) < HEADER_SIZE:
            return False
        end += HEADER_SIZE + int.from_bytes(head[12:16], "little")
        if end > data.size:
            return False
    return True


def next_sure(data: Held, at: int) -> int:
    """Where the first such record begins, from a place on."""
    while (at := data.find(MARK, at)) < data.size and not sure(data, at):
        at += 1
    return at


def after(data: Held, at: int) -> int:
    """Where reading goes on after the record at a place, sound or not."""
    try:
        return sound(data, at)[1]
    except Corrupt:
        return next_sure(data, at + 1)


def first_of(data: Held, begin: int) -> int:
    """Where the first record of a range begins, as one pass over the file would find it."""
    at = next_sure(data, begin - LOOK) if begin > LOOK else 0
    while at < begin:
        at = after(data, at)
    return at


def records(data: Held, begin: int = 0, end: int | None = None, wanted: dict[str, int] | None = None) -> Iterator[dict]:
    """Rows (without the line's name) of the records that begin in a range; with `wanted`, of those with these header fields alone.

    A row of what is not sound has `error`.
    """
    at, end = first_of(data, begin), data.size if end is None else end
    while at < end:
        try:
            fields, then = sound(data, at)
        except Corrupt as error:
            then = next_sure(data, at + 1)
            for part in range(at, then, PAYLOAD) if not wanted else ():
                yield {"seq": part, "error": str(error), "payload": data.at(part, min(PAYLOAD, then - part))}
            at = then
            continue
        if not wanted or all(fields[k] == v for k, v in wanted.items()):
            rest = data.at(at + HEADER_SIZE, fields["datasize"])
            sonar, samples = sonar_of(rest) if fields["messagetype"] == SONAR else (None, None)
            yield {"seq": at, **fields, "sonar": sonar, "payload": None if sonar else rest, "sonardata": samples}
        at = then


def _batches(line: str, rows: Iterator[dict], failfast: bool, many: int = 256) -> Iterator[pa.RecordBatch]:
    schema, held = to_arrow_schema(MESSAGES), []

    def made():
        return pa.RecordBatch.from_pylist(held, schema=schema)

    for row in rows:
        if (error := row.pop("error", None)) and failfast:
            raise Corrupt(f"{line}, record at byte {row['seq']}: {error}")
        held.append({"line": line, **row})
        if len(held) >= many:
            yield made()
            held = []
    if held:
        yield made()


def line_of(path: str) -> str:
    return re.sub(r"\.jsf$", "", path.rstrip("/").rpartition("/")[2], flags=re.IGNORECASE)


def read(spark: SparkSession, path: str, mode: str = "FAILFAST", split: int = SPLIT, **wanted: int) -> DataFrame:
    """Messages of all files below path, or of those with these fields of the message header alone."""
    if known(path):
        register(spark)
        return spark.read.format("jsf").options(mode=mode, split=split, **wanted).load(path)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.jsf").option("recursiveFileLookup", "true").load(path)
    return decoded(files, mode).where(F.lit(True) if not wanted else F.expr(" AND ".join(f"{k} = {v}" for k, v in wanted.items())))


def decoded(files: DataFrame, mode: str = "FAILFAST") -> DataFrame:
    """Messages of rows (path, content), each a whole file; batch or streaming."""
    failfast = mode.upper() == "FAILFAST"

    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                whole = content or b""
                yield from _batches(line_of(path), records(Held(len(whole), lambda at, n, whole=whole: whole[at : at + n])), failfast)

    return files.select("path", "content").mapInArrow(run, MESSAGES)


def _opened(path: str):
    """(file system, path) of a file by the name that Spark gives it."""
    import pyarrow.fs as pafs

    path = re.sub("^s3[an]:", "s3:", re.sub("^file:/(?!/)", "file:///", path))
    return pafs.FileSystem.from_uri(quote(path, safe=":/@?&=%+,;~$!*'()[]"))


def known(path: str) -> bool:
    """Whether pyarrow can read a store by itself."""
    try:
        _opened(path)
    except Exception:  # pyarrow raises one type for an unknown scheme, others for what its own client lacks
        return False
    return True


def ranges(files: DataFrame, parts: int, split: int = SPLIT) -> DataFrame:
    """path, length, begin: a row for each range of rows (path, length), dealt out over so many tasks."""
    begins = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(split).cast("long"))
    return files.where("length > 0").select("path", "length", F.explode(begins).alias("begin")).repartition(parts, "path", "begin")


def decoded_ranges(rows: DataFrame, mode: str = "FAILFAST", split: int = SPLIT) -> DataFrame:
    """Messages of ranges; batch or streaming."""
    failfast = mode.upper() == "FAILFAST"

    def run(batches):
        for batch in batches:
            for path, length, begin in zip(*(batch.column(c).to_pylist() for c in ("path", "length", "begin")), strict=True):
                yield from _read_range(*_opened(path), line_of(path), length, begin, begin + split, {}, failfast)

    return rows.select("path", "length", "begin").mapInArrow(run, MESSAGES)


def _read_range(fs, path: str, line: str, length: int, begin: int, end: int, wanted: dict[str, int], failfast: bool) -> Iterator[pa.RecordBatch]:
    with fs.open_input_file(path) as f:
        data = Held(length, lambda at, n: f.read_at(n, at))
        yield from _batches(line, records(data, begin, min(end, length), wanted), failfast)


class JsfRange(InputPartition):
    """A file's path and length, and the bytes in which records begin."""

    def __init__(self, path: str, length: int, begin: int, end: int):
        super().__init__((path, length, begin, end))


class JsfReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.failfast = options["path"], options.get("mode", "FAILFAST").upper() == "FAILFAST"
        self.wanted = {n: int(options[n]) for n, _, _ in MESSAGE_FIELDS if n in options}
        self.split = int(options.get("split", SPLIT))

    def partitions(self):
        import pyarrow.fs as pafs

        fs, root = _opened(self.path)
        info = fs.get_file_info(root)
        found = [info] if info.is_file else fs.get_file_info(pafs.FileSelector(root, recursive=True))
        files = [(x.path, x.size) for x in sorted(found, key=lambda x: x.path) if x.is_file and x.path.lower().endswith(".jsf")]
        return [JsfRange(path, size, at, min(at + self.split, size)) for path, size in files for at in range(0, size, self.split)]

    def read(self, partition: JsfRange):
        path, length, begin, end = partition.value
        fs, _ = _opened(self.path)
        yield from _read_range(fs, path, line_of(path), length, begin, end, self.wanted, self.failfast)


class JsfSource(DataSource):
    @classmethod
    def name(cls):
        return "jsf"

    def schema(self):
        return MESSAGES

    def reader(self, schema):
        return JsfReader(self.options)


def register(spark: SparkSession) -> None:
    """Makes spark.read.format("jsf").load(path) known."""
    spark.dataSource.register(JsfSource)


def encoded(messages: list[dict]) -> bytes:
    """Bytes of a file: each message has header fields, and `sonar` with `samples` (whole numbers) or `payload`. For tests and simulations."""
    out = []
    for m in messages:
        data = m.get("payload", b"")
        if "samples" in m:
            samples = np.asarray(m["samples"], "<i2")
            head = np.zeros(1, SONAR_HEADER)
            for k, v in {"samplecount": len(samples), **m.get("sonar", {})}.items():
                head[k] = v
            data = head.tobytes() + samples.tobytes()
        head = np.zeros(1, HEADER)
        for k, v in {"marker": MARKER, "messagetype": SONAR if "samples" in m else 82, "datasize": len(data), **{k: v for k, v in m.items() if k in HEADER.names}}.items():
            head[k] = v
        out += [head.tobytes(), data]
    return b"".join(out)
