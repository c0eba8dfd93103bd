"""Schemas of the engine's tables and the parameters of a run."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

#: The byte layout of a message header, (name, numpy type, offset); 16 bytes.
MESSAGE_FIELDS = [
    ("marker", "<u2", 0), ("protocol", "u1", 2), ("sessionid", "u1", 3), ("messagetype", "<u2", 4), ("commandtype", "u1", 6),
    ("subsystem", "u1", 7), ("channel", "u1", 8), ("sequence", "u1", 9), ("datasize", "<u4", 12),
]
#: The byte layout of a sonar header, (name, numpy type, offset from the end of the message header); 240 bytes.
SONAR_FIELDS = [
    ("pingtime", "<i4", 0), ("startdepth", "<u4", 4), ("pingnumber", "<u4", 8), ("msb", "<u2", 16), ("idcode", "<i2", 28),
    ("validityflag", "<u2", 30), ("dataformat", "<i2", 34), ("antennadistance_aft", "<i2", 36), ("antennadistance_starboard", "<i2", 38),
    ("kilometerpipe", "<f4", 44), ("X", "<i4", 80), ("Y", "<i4", 84), ("coordunits", "<i2", 88), ("annotation", "S24", 90),
    ("samplecount", "<u2", 114), ("sampleinterval", "<u4", 116), ("gainfactor", "<u2", 120), ("transmitlevel", "<i2", 122),
    ("startfrequency", "<u2", 126), ("endfrequency", "<u2", 128), ("sweeplength", "<u2", 130), ("pressure", "<i4", 132),
    ("depth", "<i4", 136), ("samplefrequency", "<u2", 140), ("identifier", "<u2", 142), ("altitude", "<i4", 144), ("cpuyear", "<i2", 156),
    ("cpuday", "<i2", 158), ("cpuhour", "<i2", 160), ("cpuminute", "<i2", 162), ("cpusecond", "<i2", 164), ("cpubasis", "<i2", 166),
    ("weightingfactor", "<i2", 168), ("pulses", "<i2", 170), ("heading", "<u2", 172), ("pitch", "<i2", 174), ("roll", "<i2", 176),
    ("temperature", "<i2", 178), ("triggersource", "<i2", 182), ("marknumber", "<u2", 184), ("nmeahour", "<i2", 186), ("nmeaminute", "<i2", 188),
    ("nmeasecond", "<i2", 190), ("nmeacourse", "<i2", 192), ("nmeaspeed", "<i2", 194), ("nmeaday", "<i2", 196), ("nmeayear", "<i2", 198),
    ("milliseconds", "<u4", 200), ("maxadc", "<u2", 204), ("softversion", "S6", 210), ("corrfactor", "<i4", 216), ("packetnumber", "<u2", 220),
    ("addecimation", "<i2", 222), ("fftdecimation", "<i2", 224), ("watertemperature", "<i2", 226), ("layback", "<f4", 228), ("cableout", "<u2", 236),
]
MARKER, SONAR, HEADER_SIZE, SONAR_SIZE = 5633, 80, 16, 240

_WIDER = {"u1": T.ShortType(), "<u2": T.IntegerType(), "<u4": T.LongType(), "<i2": T.ShortType(), "<i4": T.IntegerType(), "<f4": T.FloatType()}


def _struct(fields: list[tuple[str, str, int]]) -> T.StructType:
    return T.StructType([T.StructField(name, _WIDER.get(kind, T.StringType())) for name, kind, _ in fields])


SONAR_STRUCT = _struct(SONAR_FIELDS)
MESSAGES = T.StructType(
    [T.StructField("line", T.StringType()), T.StructField("seq", T.LongType()), *_struct(MESSAGE_FIELDS).fields]
    + [T.StructField("sonar", SONAR_STRUCT), T.StructField("payload", T.BinaryType()), T.StructField("sonardata", T.ArrayType(T.DoubleType(), False))]
)
BOTTOM = "line string, ping int, port_x int, stbd_x int"
PIXELS = "line string, `row` int, col int, value smallint"
TILE_META = "line string, ulx double, uly double, res double, h int, w int, epsg int"


@dataclass(frozen=True)
class Params:
    """Settings of a run; the defaults are those of the published configuration."""

    frequency: int = 20
    slant_range: float = 80.0
    planed_speed: float = 4.0
    recorded_speed: bool = True
    temperature: float = 26.0
    salinity: float = 28.0
    depth: float = 5.0
    pH: float = 8.0
    lambd: float = 20.0
    gradient_thred_factor: float = 0.1
    win_h: int = 10
    use_ab_line_correction: bool = False
    peak_factor: float = 0.7
    valley_std: float = 5.0
    bottom_offset: tuple[int, int] = (2, 5)
    gray_enhance_method: str = "coarse2fine"
    gaussian_kernel: float = 50.0
    gain: float = 10.0
    alpha: float = 0.05
    ratio: float = 0.02
    prob_thred: float = 0.3
    speed_correction_method: str = "blockwise"
    geo_epsg: int = 4490
    proj_epsg: int = 4499
    res: float = 0.1
    is_ns: bool = True
    fish_trajectory_smooth_type: str = "bspline"
    track_s: float = 80.0
    angle: str = "cog"
    angle_s: float = 10.0
    compat: bool = True
    level: bool = True

    @property
    def frequency_hz(self) -> float:
        known = {20: 600_000.0, 21: 1_600_000.0}
        if self.frequency not in known:
            raise ValueError(f"unknown frequency code {self.frequency}: one of {sorted(known)}")
        return known[self.frequency]
