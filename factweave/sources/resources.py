"""Resource files as lines of cells (S01-S11, S13, S25): CSV, JSON, GeoJSON, KML, GML, zips and spreadsheets.

Files are read as ``binaryFile`` rows and opened where they lie, on the executors,
one task for each batch of files; nothing is read on the driver. A file that cannot
be read yields no lines and an entry with status ``failed`` in the conversion log.
"""

from __future__ import annotations

import csv
import io
import itertools
import json
import pickle
import re
import tempfile
import time
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factweave.functions import geo

csv.field_size_limit(1 << 31)

LINES = "resource string, line_number long, line array<string>"
CONVERSIONS = "resource string, mime_type string, status string, exception string, elapsed double"
#: Kinds of file in an archive, in the order in which they are looked for (fixed values).
INNER = (".shp", ".gml", ".tab", ".geojson", ".json", ".kml", ".csv")


#: Shorter texts say too little about their encoding.
DETECTABLE = 1024


class Rejected(ValueError):
    """A file that is no table."""


def encoding(content: bytes) -> str:
    """By byte order mark, else UTF-8 where it decodes, else what the detector says."""
    for mark, name in ((b"\xef\xbb\xbf", "utf-8-sig"), (b"\xff\xfe", "utf-16"), (b"\xfe\xff", "utf-16")):
        if content.startswith(mark):
            return name
    try:
        content.decode("utf-8")
        return "utf-8"
    except UnicodeDecodeError:
        pass
    if len(content) < DETECTABLE:
        return "cp1252"
    try:
        from charset_normalizer import from_bytes

        best = from_bytes(content[: 1 << 20]).best()
        return best.encoding if best else "cp1252"
    except ImportError:
        return "cp1252"


def csv_lines(text: str) -> Iterator[list[str]]:
    """Records of a CSV text, without NUL characters."""
    if text.lstrip().lower().startswith("<!doctype"):
        raise Rejected("document is HTML")
    yield from csv.reader(io.StringIO(text.replace("\0", ""), newline=""))


def json_lines(text: str) -> Iterator[list[str]]:
    """A list of objects, or ``{columns, data}``, or GeoJSON features."""
    value = json.loads(text)
    if isinstance(value, dict) and "columns" in value and "data" in value:
        yield [str(c) for c in value["columns"]]
        yield from ([_cell(x) for x in row] for row in value["data"])
    elif isinstance(value, dict) and value.get("type") == "FeatureCollection":
        yield from feature_lines((f.get("properties") or {}, f.get("geometry")) for f in value["features"])
    elif isinstance(value, list):
        names = list(value[0]) if value else []
        yield names
        yield from ([_cell(row.get(n)) for n in names] for row in value)
    else:
        raise Rejected("JSON holds no table")


def _cell(value) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value) if isinstance(value, (dict, list, bool)) else str(value)


def feature_lines(features) -> Iterator[list[str]]:
    """Features as rows with a ``WKT`` column first; polygons become MULTIPOLYGON, with 10 decimals."""
    features = [(p, geo._from_geojson(g) if isinstance(g, dict) else g) for p, g in features]
    names = list(dict.fromkeys(n for p, _ in features for n in p))
    yield ["WKT", *names]
    for properties, shape in features:
        if shape and shape[0] == "Polygon":
            shape = ("MultiPolygon", [shape[1]])
        yield [geo.dump_wkt(shape, 10) if shape else "", *(_cell(properties.get(n)) for n in names)]


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _positions(text: str, size: int = 2):
    numbers = [float(x) for x in re.split(r"[\s,]+", text.strip()) if x]
    return [(numbers[i], numbers[i + 1]) for i in range(0, len(numbers) - 1, size)]


def _kml_positions(text: str):
    return [tuple(map(float, t.split(",")[:2])) for t in text.split()]


def xml_lines(text: str) -> Iterator[list[str]]:
    """Placemarks of KML, or feature members of GML and WFS answers."""
    root = ElementTree.fromstring(text.encode())
    found = []
    marks = [e for e in root.iter() if _local(e.tag) == "Placemark"]
    if marks:
        for mark in marks:
            properties = {}
            for e in mark.iter():
                name = _local(e.tag)
                if name in ("name", "description"):
                    properties[name] = (e.text or "").strip()
                elif name == "SimpleData":
                    properties[e.get("name")] = (e.text or "").strip()
                elif name == "Data":
                    properties[e.get("name")] = "".join(v.text or "" for v in e).strip()
            found.append((properties, _xml_shape(mark, "coordinates", _kml_positions, "outerBoundaryIs", "innerBoundaryIs")))
    else:
        members = [f for e in root.iter() if _local(e.tag) in ("featureMember", "member", "featureMembers") for f in e]
        for member in members:
            properties = {_local(c.tag): (c.text or "").strip() for c in member if not len(c)}
            found.append((properties, _xml_shape(member, "posList", _positions, "exterior", "interior")))
    yield from feature_lines(found)


def _xml_shape(element, leaf, read, outer, inner):
    def rings(polygon, kind):
        return [read(x.text or "") for e in polygon.iter() if _local(e.tag) == kind for x in e.iter() if _local(x.tag) in (leaf, "coordinates")]

    parts = [rings(e, outer) + rings(e, inner) for e in element.iter() if _local(e.tag) == "Polygon"]
    parts = [p for p in parts if p]
    if parts:
        return ("MultiPolygon", parts)
    for e in element.iter():
        if _local(e.tag) in (leaf, "pos", "coordinates") and (e.text or "").strip():
            points = read(e.text)
            return ("Point", points[0]) if len(points) == 1 else ("LineString", points)
    return None


def sniff(content: bytes) -> str:
    """The kind of a file by its first bytes."""
    if content[:4] == b"PK\x03\x04":
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            return "excel" if any(n.startswith("xl/") for n in z.namelist()) else "zip"
    if content[:8] == b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1":
        return "excel"
    if content[:15] == b"SQLite format 3":
        return "sqlite"
    head = content[:512].decode(encoding(content[:512]) if content[:3] == b"\xef\xbb\xbf" else "latin-1").lstrip()[:10].lower()
    if head.startswith("<!doctype "):
        return "html"
    if head.startswith(("<?xml ", "<wfs:", "<kml", "<gml")):
        return "xml"
    return "json" if head.startswith(("{", "[{", "[ {", "[\n")) else "csv"


def excel_lines(content: bytes) -> Iterator[list[str]]:
    """The first sheet; needs openpyxl."""
    frame = pd.read_excel(io.BytesIO(content), sheet_name=0, dtype=str, header=None, keep_default_na=False)
    yield from frame.astype(str).values.tolist()


def geopackage_lines(content: bytes) -> Iterator[list[str]]:
    """The first table of a GeoPackage or SQLite file, blobs left out."""
    import sqlite3

    with tempfile.NamedTemporaryFile(suffix=".sqlite") as f:
        f.write(content)
        f.flush()
        db = sqlite3.connect(f.name)
        try:
            known = {r[0] for r in db.execute("select name from sqlite_master where type = 'table'")}
            names = [r[0] for r in db.execute("select table_name from gpkg_contents")] if "gpkg_contents" in known else sorted(n for n in known if not n.startswith("sqlite_"))
            rows = db.execute(f'select * from "{names[0]}"')
            yield [d[0] for d in rows.description]
            yield from (["" if isinstance(x, bytes) else _cell(x) for x in row] for row in rows)
        finally:
            db.close()


def inner_file(archive: zipfile.ZipFile) -> str:
    """The one file of the first kind that an archive has; two of a kind are an error."""
    names = [n for n in archive.namelist() if not n.startswith("__MACOSX")]
    for kind in INNER:
        hits = [n for n in names if n.lower().endswith(kind)]
        if len(hits) > 1:
            raise Rejected(f"several {kind} files in the archive")
        if hits:
            return hits[0]
    raise Rejected("no known file in the archive")


def read_lines(content: bytes) -> tuple[str, Iterator[list[str]]]:
    """The media type and lines of a file."""
    kind = sniff(content)
    if kind == "html":
        raise Rejected("document is HTML")
    if kind == "zip":
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            return "application/zip", read_lines(z.read(inner_file(z)))[1]
    if kind == "excel":
        return "application/vnd.ms-excel", excel_lines(content)
    if kind == "sqlite":
        return "application/geopackage+sqlite3", geopackage_lines(content)
    text = content.decode(encoding(content), errors="replace")
    return {"xml": ("application/xml", xml_lines), "json": ("application/json", json_lines), "csv": ("text/csv", csv_lines)}[kind][0], {"xml": xml_lines, "json": json_lines, "csv": csv_lines}[kind](text)


def _name(path: str) -> str:
    return re.sub(r"\.[A-Za-z0-9]{1,8}$", "", path.rstrip("/").rpartition("/")[2])


#: Lines of a file are handed on only once the whole file is read; so many are held in memory, the rest in the worker's scratch file.
HELD_LINES = 100_000


def _whole(lines: Iterator[list[str]]) -> Iterator[list[str]]:
    """The lines of a file, none of which comes out if reading fails anywhere."""
    with tempfile.TemporaryFile() as spill:
        held: list[list[str]] = []
        blocks = 0
        for line in lines:
            held.append(line)
            if len(held) == HELD_LINES:
                pickle.dump(held, spill)
                held, blocks = [], blocks + 1
        spill.seek(0)
        for _ in range(blocks):
            yield from pickle.load(spill)
        yield from held


def scan(spark: SparkSession, path: str) -> DataFrame:
    """The lines of all files under a path, numbered from 1 in each; the name of a file is its resource.

    A file that fails to convert, at whatever line, has no lines; ``conversions`` tells why.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for where, content in zip(frame["path"], frame["content"]):
                try:
                    lines = _whole(read_lines(content)[1] if content else iter(()))
                    first = next(lines, None)  # all is read by now
                except Exception:  # noqa: BLE001 - told by conversions()
                    continue
                if first is None:
                    continue
                rows = []
                for number, line in enumerate(itertools.chain([first], lines), 1):
                    rows.append((_name(where), number, line))
                    if len(rows) == 10_000:
                        yield pd.DataFrame(rows, columns=["resource", "line_number", "line"])
                        rows = []
                if rows:
                    yield pd.DataFrame(rows, columns=["resource", "line_number", "line"])

    return files.mapInPandas(run, LINES)


def conversions(spark: SparkSession, path: str) -> DataFrame:
    """Media type, status, error and seconds of each file's conversion."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for where, content in zip(frame["path"], frame["content"]):
                began, mime, status, error = time.monotonic(), "", "success", ""
                try:
                    if content:
                        mime, lines = read_lines(content)
                        for _ in lines:
                            pass
                except Exception as e:  # noqa: BLE001
                    status, error = "failed", f"{type(e).__name__}: {e}"
                rows.append((_name(where), mime, status, error, time.monotonic() - began))
            yield pd.DataFrame(rows, columns=["resource", "mime_type", "status", "exception", "elapsed"])

    return files.mapInPandas(run, CONVERSIONS)


def content_addressed(spark: SparkSession, path: str) -> DataFrame:
    """``resource`` (sha256 of the bytes) of each file, one row per content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    named = files.select(F.sha2("content", 256).alias("resource"), "path", F.col("length").alias("bytes"))
    return named.groupBy("resource").agg(F.min("path").alias("path"), F.max("bytes").alias("bytes"))


def numbered_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file as text columns, with ``line_number`` counted in records, the header being 1."""
    lines = scan(spark, path)
    header = lines.where("line_number = 1").select("line").first()
    names = list(dict.fromkeys(header["line"])) if header else []
    first = {n: header["line"].index(n) for n in names}
    rows = lines.where("line_number > 1")
    return rows.select("line_number", *(F.get("line", F.lit(i)).alias(n) for n, i in first.items()))
