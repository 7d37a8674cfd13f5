"""Lines of ESRI shapefiles (PolyLine and PolyLineZ), read as binary files: a file is read in one
task, files side by side. Attributes come from the DBF file beside it. Coordinates are taken as
they are; a file in another reference system has to be transformed before."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymesh.functions import geo

LINE_TYPES = {3: False, 13: True, 23: False}  # shape type: whether it has z


def shapes(data: bytes) -> Iterator[tuple[int, int, list[dict]]]:
    """(record, part, points) of the line shapes in a .shp file's bytes."""
    at = 100
    while at + 8 <= len(data):
        number, words = struct.unpack(">ii", data[at : at + 8])
        body, at = data[at + 8 : at + 8 + 2 * words], at + 8 + 2 * words
        kind = struct.unpack("<i", body[:4])[0]
        if kind not in LINE_TYPES:
            continue
        parts, count = struct.unpack("<ii", body[36:44])
        firsts = [*struct.unpack(f"<{parts}i", body[44 : 44 + 4 * parts]), count]
        xy_at = 44 + 4 * parts
        xy = struct.unpack(f"<{2 * count}d", body[xy_at : xy_at + 16 * count])
        z_at = xy_at + 16 * count + 16
        z = struct.unpack(f"<{count}d", body[z_at : z_at + 8 * count]) if LINE_TYPES[kind] else (0.0,) * count
        for part in range(parts):
            yield number, part, [{"x": xy[2 * k], "y": xy[2 * k + 1], "z": z[k]} for k in range(firsts[part], firsts[part + 1])]


def attributes(data: bytes) -> list[dict[str, str]]:
    """The rows of a .dbf file's bytes, values as trimmed text; deleted rows are kept as empty."""
    count, head, width = struct.unpack("<IHH", data[4:12])
    fields = []
    for at in range(32, head - 1, 32):
        name, size = data[at : at + 11].split(b"\0")[0].decode("latin-1"), data[at + 16]
        fields.append((name, size))
    rows = []
    for k in range(count):
        row, at, found = data[head + k * width : head + (k + 1) * width], 1, {}
        for name, size in fields:
            found[name] = row[at : at + size].decode("utf-8", "replace").strip()
            at += size
        rows.append({} if row[:1] == b"*" else found)
    return rows


def read_shapefile(spark: SparkSession, path: str) -> DataFrame:
    """(file, record, part, properties, coords) of the .shp files under ``path``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")
    files = files.withColumn("kind", F.lower(F.substring_index("path", ".", -1))).where("kind IN ('shp', 'dbf')").withColumn("file", F.regexp_replace("path", r"\.[^.]*$", ""))

    def read(batch: pd.DataFrame) -> pd.DataFrame:
        by = dict(zip(batch["kind"], batch["content"], strict=True))
        rows = attributes(by["dbf"]) if "dbf" in by else []
        out = [(batch["file"].iloc[0], n, part, rows[n - 1] if n <= len(rows) else {}, points) for n, part, points in (shapes(by["shp"]) if "shp" in by else ())]
        return pd.DataFrame(out, columns=["file", "record", "part", "properties", "coords"])

    return files.groupBy("file").applyInPandas(read, f"file string, record int, part int, properties map<string,string>, coords {geo.LINE}")
