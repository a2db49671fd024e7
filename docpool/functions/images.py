"""Sizes of images, from the first bytes of PNG, GIF and JPEG files."""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = (-1, -1)


def image_size(data: bytes | None) -> tuple[int, int]:
    """Width and height; -1 and -1 of anything that can't be read."""
    try:
        if data[:8] == b"\x89PNG\r\n\x1a\n":
            return struct.unpack(">II", data[16:24])
        if data[:4] == b"GIF8":
            return struct.unpack("<HH", data[6:10])
        if data[:2] != b"\xff\xd8":
            return UNKNOWN
        at = 2
        while data[at] == 0xFF:
            kind, (size,) = data[at + 1], struct.unpack(">H", data[at + 2 : at + 4])
            if 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):  # a frame's header
                height, width = struct.unpack(">HH", data[at + 5 : at + 9])
                return width, height
            at += 2 + size
    except (IndexError, TypeError, struct.error):
        pass
    return UNKNOWN


def size_of(content: Column) -> Column:
    """Struct of width and height over binary columns."""

    @F.pandas_udf("width int, height int")
    def run(c: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([image_size(x) for x in c], columns=["width", "height"])

    return run(content)
