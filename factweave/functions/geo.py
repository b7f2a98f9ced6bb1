"""Geometry without native libraries (F18-F23, Q23, Q24, and the exact tests of J19, J20).

A geometry is a pair (type, coordinates) as in GeoJSON. Coordinates are brought to
WGS84 degrees; OSGB national grid by the published Helmert and transverse Mercator
formulas (metres-accurate), Mercator by its inverse. Repair of invalid shapes and
true unions use shapely where it can be imported, and are left out where it cannot:
an invalid shape is then reported as not fixable, and a union keeps its distinct parts.
"""

from __future__ import annotations

import json
import math
import re

import pandas as pd

from factweave.functions.arrow import arrow_udf

try:
    import shapely
    import shapely.wkt
except ImportError:
    shapely = None

Geometry = tuple[str, list]

_TOKEN = re.compile(r"[A-Za-z]+|\(|\)|,|[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?")
_NAMES = {n.upper(): n for n in ("Point", "LineString", "Polygon", "MultiPoint", "MultiLineString", "MultiPolygon", "GeometryCollection")}
#: Levels of brackets around positions.
_DEPTH = {"Point": 0, "LineString": 1, "MultiPoint": 1, "Polygon": 2, "MultiLineString": 2, "MultiPolygon": 3}

#: The area that coordinates must lie in (fixed values).
BOUNDARY: Geometry = ("Polygon", [[(2.95, 56.0), (2.95, 49.5), (-7.0, 49.5), (-7.0, 53.4), (-4.0, 53.4), (-4.0, 56.0), (2.95, 56.0)]])


def parse_wkt(text: str) -> Geometry | None:
    """A geometry from well-known text, or None."""
    body = re.sub(r"^\s*SRID=\d+;", "", text)
    tokens = _TOKEN.findall(body)
    if re.sub(r"\s+", "", body) != "".join(tokens):
        return None
    try:
        geometry, at = _read(tokens, 0)
    except (IndexError, ValueError, KeyError):
        return None
    return geometry if at == len(tokens) else None


def _read(tokens, at) -> tuple[Geometry, int]:
    name = _NAMES[tokens[at].upper()]
    at += 1
    if tokens[at].upper() in ("Z", "M", "ZM"):
        at += 1
    if tokens[at].upper() == "EMPTY":
        return (name, []), at + 1
    if name == "GeometryCollection":
        parts, at = [], _expect(tokens, at, "(")
        while True:
            part, at = _read(tokens, at)
            parts.append(part)
            if tokens[at] == ")":
                return (name, parts), at + 1
            at = _expect(tokens, at, ",")
    coordinates, at = _nested(tokens, at, _DEPTH[name], name == "MultiPoint")
    return (name, coordinates[0] if name == "Point" else coordinates), at


def _expect(tokens, at, what):
    if tokens[at] != what:
        raise ValueError(tokens[at])
    return at + 1


def _nested(tokens, at, depth, bracketed):
    out, at = [], _expect(tokens, at, "(")
    while True:
        if depth > 1:
            part, at = _nested(tokens, at, depth - 1, False)
        else:
            inner = bracketed and tokens[at] == "("
            at += inner
            start = at
            while tokens[at] not in (",", ")"):
                at += 1
            numbers = [float(x) for x in tokens[start:at]]
            if not 2 <= len(numbers) <= 4:
                raise ValueError(tokens[start:at])
            part = (numbers[0], numbers[1])
            at += inner
        out.append(part)
        if tokens[at] == ")":
            return out, at + 1
        at = _expect(tokens, at, ",")


def parse_geojson(text: str) -> Geometry | None:
    """A geometry from GeoJSON text (a geometry, or a feature's), or None."""
    try:
        return _from_geojson(json.loads(text))
    except (ValueError, TypeError, KeyError, IndexError, AttributeError):
        return None


def _from_geojson(value) -> Geometry | None:
    if value.get("type") == "Feature":
        value = value["geometry"]
    kind = value["type"]
    if kind == "GeometryCollection":
        return kind, [_from_geojson(g) for g in value["geometries"]]

    def positions(x, depth):
        return (float(x[0]), float(x[1])) if depth == 0 else [positions(y, depth - 1) for y in x]

    return kind, positions(value["coordinates"], _DEPTH[kind])


def mapped(geometry: Geometry, change) -> Geometry:
    """The geometry with every position changed."""
    kind, coordinates = geometry
    if kind == "GeometryCollection":
        return kind, [mapped(g, change) for g in coordinates]

    def walk(x):
        return change(*x) if isinstance(x, tuple) else [walk(y) for y in x]

    return kind, walk(coordinates)


def polygons(geometry: Geometry) -> list[list]:
    """All polygons of a geometry, as lists of rings."""
    kind, coordinates = geometry
    if kind == "Polygon":
        return [coordinates] if coordinates else []
    if kind == "MultiPolygon":
        return [p for p in coordinates if p]
    return [p for g in coordinates for p in polygons(g)] if kind == "GeometryCollection" else []


def first_position(geometry: Geometry):
    kind, x = geometry
    if kind == "GeometryCollection":
        return first_position(x[0]) if x else None
    while isinstance(x, list):
        if not x:
            return None
        x = x[0]
    return x


# ---- coordinate systems ----


def osgb_to_wgs84(easting: float, northing: float) -> tuple[float, float]:
    """National grid to WGS84 longitude and latitude: inverse transverse Mercator on Airy 1830, then a Helmert shift."""
    a, b, f0 = 6377563.396, 6356256.909, 0.9996012717
    lat0, lon0, n0, e0 = math.radians(49), math.radians(-2), -100000.0, 400000.0
    e2, n = 1 - b * b / (a * a), (a - b) / (a + b)
    lat, m = lat0, 0.0
    for _ in range(100):
        lat += (northing - n0 - m) / (a * f0)
        d, s = lat - lat0, lat + lat0
        m = b * f0 * (
            (1 + n + 5 / 4 * n**2 + 5 / 4 * n**3) * d - (3 * n + 3 * n**2 + 21 / 8 * n**3) * math.sin(d) * math.cos(s)
            + (15 / 8 * n**2 + 15 / 8 * n**3) * math.sin(2 * d) * math.cos(2 * s) - 35 / 24 * n**3 * math.sin(3 * d) * math.cos(3 * s)
        )
        if abs(northing - n0 - m) < 1e-5:
            break
    sin, tan, sec = math.sin(lat), math.tan(lat), 1 / math.cos(lat)
    nu = a * f0 / math.sqrt(1 - e2 * sin * sin)
    rho = a * f0 * (1 - e2) * (1 - e2 * sin * sin) ** -1.5
    eta2, de, t2 = nu / rho - 1, easting - e0, tan * tan
    lat -= tan / (2 * rho * nu) * de**2 - tan / (24 * rho * nu**3) * (5 + 3 * t2 + eta2 - 9 * t2 * eta2) * de**4 + tan / (720 * rho * nu**5) * (61 + 90 * t2 + 45 * t2**2) * de**6
    lon = lon0 + sec / nu * de - sec / (6 * nu**3) * (nu / rho + 2 * t2) * de**3 + sec / (120 * nu**5) * (5 + 28 * t2 + 24 * t2**2) * de**5 - sec / (5040 * nu**7) * (61 + 662 * t2 + 1320 * t2**2 + 720 * t2**3) * de**7
    # to cartesian, shift, and back
    v = a / math.sqrt(1 - e2 * math.sin(lat) ** 2)
    x, y, z = v * math.cos(lat) * math.cos(lon), v * math.cos(lat) * math.sin(lon), v * (1 - e2) * math.sin(lat)
    s, rx, ry, rz = -20.4894e-6, *(math.radians(r / 3600) for r in (0.1502, 0.2470, 0.8421))
    x, y, z = 446.448 + (1 + s) * x - rz * y + ry * z, -125.157 + rz * x + (1 + s) * y - rx * z, 542.060 - ry * x + rx * y + (1 + s) * z
    a, b = 6378137.0, 6356752.314245
    e2 = 1 - b * b / (a * a)
    p = math.hypot(x, y)
    lat = math.atan2(z, p * (1 - e2))
    for _ in range(10):
        v = a / math.sqrt(1 - e2 * math.sin(lat) ** 2)
        lat = math.atan2(z + e2 * v * math.sin(lat), p)
    return math.degrees(math.atan2(y, x)), math.degrees(lat)


def mercator_to_wgs84(x: float, y: float) -> tuple[float, float]:
    r = 6378137.0
    return math.degrees(x / r), math.degrees(2 * math.atan(math.exp(y / r)) - math.pi / 2)


def located(geometry: Geometry, boundary: Geometry = BOUNDARY) -> tuple[Geometry | None, str | None, str | None]:
    """the geometry in WGS84, an issue and its message, told by the range in which its first position lies."""
    kind, parts = geometry
    if kind == "GeometryCollection":
        if not parts or parts[0][0] not in ("Polygon", "MultiPolygon"):
            return None, "Unexpected geom type within GeometryCollection", "Geometry must be a polygon"
    elif kind == "MultiPoint" or first_position(geometry) is None:
        return None, "Unexpected geom type", "Geometry must be a point or polygon"
    x, y = first_position(geometry)
    where = "England" if boundary == BOUNDARY else "custom boundary"

    def inside(lon, lat):
        return contains(boundary, (lon, lat))

    def swapped(g):
        return mapped(g, lambda a, b: (b, a))

    if -60 < x < 60 and -60 < y < 60:
        if inside(x, y):
            return geometry, None, None
        if inside(y, x):
            return swapped(geometry), "WGS84 flipped", None
        return None, f"WGS84 out of bounds of {where}", "Geometry must be in England"
    if 1000 < x < 1_000_000 and 1000 < y < 1_000_000:
        if inside(*osgb_to_wgs84(x, y)):
            return mapped(geometry, osgb_to_wgs84), "OSGB", None
        if inside(*osgb_to_wgs84(y, x)):
            return mapped(swapped(geometry), osgb_to_wgs84), "OSGB flipped", None
        return None, f"OSGB out of bounds of {where}", "Geometry must be in England"
    if 6_000_000 < y < 10_000_000 and inside(*mercator_to_wgs84(x, y)):
        return mapped(geometry, mercator_to_wgs84), "Mercator", None
    if 6_000_000 < x < 10_000_000 and inside(*mercator_to_wgs84(y, x)):
        return mapped(swapped(geometry), mercator_to_wgs84), "Mercator flipped", None
    return None, "invalid coordinates", "Geometry must use WGS84, OSGB or Mercator coordinates"


# ---- measures and tests ----


def ring_area(ring) -> float:
    """Signed area, positive anticlockwise."""
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:])) / 2


def area(geometry: Geometry) -> float:
    return sum(abs(ring_area(p[0])) - sum(abs(ring_area(h)) for h in p[1:]) for p in polygons(geometry))


def centroid(geometry: Geometry) -> tuple[float, float] | None:
    """Area-weighted for polygons, mean of positions otherwise."""
    total = cx = cy = 0.0
    for polygon in polygons(geometry):
        x0, y0 = polygon[0][0]
        for k, ring in enumerate(polygon):
            sign = (1 if ring_area(ring) > 0 else -1) * (1 if k == 0 else -1)
            for (ax, ay), (bx, by) in zip(ring, ring[1:]):
                ax, ay, bx, by = ax - x0, ay - y0, bx - x0, by - y0
                w = sign * (ax * by - bx * ay) / 2
                total += w
                cx += w * ((ax + bx) / 3 + x0)
                cy += w * ((ay + by) / 3 + y0)
    if total:
        return cx / total, cy / total
    points: list = []
    mapped(geometry, lambda x, y: points.append((x, y)) or (x, y))
    return (sum(p[0] for p in points) / len(points), sum(p[1] for p in points) / len(points)) if points else None


def _in_ring(ring, x, y) -> bool:
    """Whether a position lies in a ring or on it."""
    inside = False
    for (ax, ay), (bx, by) in zip(ring, ring[1:]):
        if min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by) and (bx - ax) * (y - ay) == (by - ay) * (x - ax):
            return True
        if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
            inside = not inside
    return inside


def contains(geometry: Geometry, point: tuple[float, float]) -> bool:
    """Whether a position lies in a geometry's polygons or on their edges."""
    x, y = point

    def on_edge(ring):
        return any(min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by) and (bx - ax) * (y - ay) == (by - ay) * (x - ax) for (ax, ay), (bx, by) in zip(ring, ring[1:]))

    return any(_in_ring(p[0], x, y) and not any(_in_ring(h, x, y) and not on_edge(h) for h in p[1:]) for p in polygons(geometry))


def bounds(geometry: Geometry) -> tuple[float, float, float, float]:
    points: list = []
    mapped(geometry, lambda x, y: points.append((x, y)) or (x, y))
    xs, ys = [p[0] for p in points], [p[1] for p in points]
    return min(xs), min(ys), max(xs), max(ys)


def _edges(geometry: Geometry):
    return [(a, b) for p in polygons(geometry) for ring in p for a, b in zip(ring, ring[1:]) if a != b]


def _cross_x(a, b, c, d):
    """The x at which two segments cross, or None."""
    r, s = (b[0] - a[0], b[1] - a[1]), (d[0] - c[0], d[1] - c[1])
    den = r[0] * s[1] - r[1] * s[0]
    if den == 0:
        return None
    t = ((c[0] - a[0]) * s[1] - (c[1] - a[1]) * s[0]) / den
    u = ((c[0] - a[0]) * r[1] - (c[1] - a[1]) * r[0]) / den
    return a[0] + t * r[0] if 0 <= t <= 1 and 0 <= u <= 1 else None


def overlap_area(one: Geometry, two: Geometry) -> float:
    """Area of the intersection of two sets of polygons, integrated over vertical slabs in which no edges cross."""
    box1, box2 = bounds(one), bounds(two)
    low, high = max(box1[0], box2[0]), min(box1[2], box2[2])
    if low >= high or max(box1[1], box2[1]) > min(box1[3], box2[3]):
        return 0.0
    sides = [[e for e in _edges(g) if max(e[0][0], e[1][0]) > low and min(e[0][0], e[1][0]) < high and e[0][0] != e[1][0]] for g in (one, two)]
    every = sides[0] + sides[1]
    xs = {low, high} | {p[0] for e in every for p in e}
    for i, (a, b) in enumerate(every):
        for c, d in every[i + 1 :]:
            if max(a[0], b[0]) >= min(c[0], d[0]) and max(c[0], d[0]) >= min(a[0], b[0]):
                x = _cross_x(a, b, c, d)
                if x is not None:
                    xs.add(x)
    cuts = sorted(x for x in xs if low <= x <= high)
    total = 0.0
    for x0, x1 in zip(cuts, cuts[1:]):
        mid = (x0 + x1) / 2
        spans = []
        for edges in sides:
            ys = sorted(a[1] + (b[1] - a[1]) * (mid - a[0]) / (b[0] - a[0]) for a, b in edges if min(a[0], b[0]) < mid < max(a[0], b[0]))
            spans.append(list(zip(ys[::2], ys[1::2])))
        total += (x1 - x0) * sum(max(0.0, min(b, d) - max(a, c)) for a, b in spans[0] for c, d in spans[1])
    return total


def intersects(one: Geometry, two: Geometry) -> bool:
    """Whether two geometries (points or polygons) share a position."""
    if one[0] == "Point" or two[0] == "Point":
        if one[0] == two[0]:
            return one[1] == two[1]
        point, other = (one, two) if one[0] == "Point" else (two, one)
        return contains(other, point[1])
    a, b = bounds(one), bounds(two)
    if a[0] > b[2] or b[0] > a[2] or a[1] > b[3] or b[1] > a[3]:
        return False
    if any(contains(two, p[0][0]) for p in polygons(one)) or any(contains(one, p[0][0]) for p in polygons(two)):
        return True
    return any(_cross_x(*e, *f) is not None for e in _edges(one) for f in _edges(two))


def within(one: Geometry, two: Geometry) -> bool:
    """Whether the first geometry lies in the second."""
    if one[0] == "Point":
        return contains(two, one[1])
    if not all(contains(two, p) for poly in polygons(one) for ring in poly for p in ring):
        return False
    whole = area(one)
    return overlap_area(one, two) >= whole * (1 - 1e-9)


def ring_fault(ring) -> str | None:
    """Why a ring is no valid one, or None: too few points, open, no area, or crossing itself."""
    if len(ring) < 4 or ring[0] != ring[-1]:
        return "Too few points in geometry component"
    if ring_area(ring) == 0:
        return "Ring has no area"
    edges = [(a, b) for a, b in zip(ring, ring[1:])]
    order = sorted(range(len(edges)), key=lambda i: min(edges[i][0][0], edges[i][1][0]))
    active: list[int] = []
    for i in order:
        a, b = edges[i]
        left = min(a[0], b[0])
        active = [j for j in active if max(edges[j][0][0], edges[j][1][0]) >= left]
        for j in active:
            c, d = edges[j]
            if {a, b} & {c, d}:
                continue
            x = _cross_x(a, b, c, d)
            if x is not None:
                return f"Self-intersection[{x:g}]"
        active.append(i)
    return None


def fault(geometry: Geometry) -> str | None:
    return next((f for p in polygons(geometry) for ring in p if (f := ring_fault(ring))), None)


def simplified(ring, tolerance: float = 1e-6):
    """Douglas-Peucker on a ring, keeping its first point; the ring itself if little would be left."""
    if len(ring) <= 5:
        return ring
    keep, stack = {0, len(ring) - 1}, []
    far = max(range(len(ring)), key=lambda i: (ring[i][0] - ring[0][0]) ** 2 + (ring[i][1] - ring[0][1]) ** 2)
    keep.add(far)
    stack += [(0, far), (far, len(ring) - 1)]
    while stack:
        i, j = stack.pop()
        if j - i < 2:
            continue
        (ax, ay), (bx, by) = ring[i], ring[j]
        dx, dy = bx - ax, by - ay
        length = math.hypot(dx, dy)

        def off(k):
            x, y = ring[k]
            return abs(dx * (y - ay) - dy * (x - ax)) / length if length else math.hypot(x - ax, y - ay)

        k = max(range(i + 1, j), key=off)
        if off(k) > tolerance:
            keep.add(k)
            stack += [(i, k), (k, j)]
    out = [ring[k] for k in sorted(keep)]
    return out if len(out) >= 4 else ring


def dump_wkt(geometry: Geometry, precision: int = 6) -> str:
    """well-known text with fixed decimals and no space after commas."""

    def position(p):
        return f"{p[0]:.{precision}f} {p[1]:.{precision}f}"

    def text(x):
        return "(" + ",".join(position(y) if isinstance(y, tuple) else text(y) for y in x) + ")"

    kind, x = geometry
    if not x:
        return f"{kind.upper()} EMPTY"
    return f"{kind.upper()} " + (f"({position(x)})" if kind == "Point" else text(x))


def normalised(geometry: Geometry) -> tuple[Geometry | None, str | None]:
    """a point as it is; else a valid MultiPolygon with outer rings anticlockwise, and what was wrong."""
    kind = geometry[0]
    if kind in ("Point", "MultiLineString"):
        return geometry, None
    parts = []
    for polygon in polygons(geometry):
        rings = []
        for ring in polygon:
            tidy = simplified(ring)
            ring = tidy if ring_fault(tidy) is None or ring_fault(ring) else ring
            ring = [(round(x, 6), round(y, 6)) for x, y in ring]
            rings.append([p for k, p in enumerate(ring) if k == 0 or p != ring[k - 1]])
        parts.append(rings)
    shape: Geometry = ("MultiPolygon", parts)
    issue = fault(shape)
    if issue and shapely is not None:
        fixed = shapely.make_valid(shapely.wkt.loads(dump_wkt(shape)))
        fixed = fixed if fixed.is_valid else fixed.buffer(0)
        shape = ("MultiPolygon", polygons(parse_wkt(fixed.wkt)))
    turned = [[ring if (ring_area(ring) > 0) == (k == 0) else ring[::-1] for k, ring in enumerate(p)] for p in shape[1]]
    return (("MultiPolygon", turned) if turned else None), issue


def normalise(value: str | None, kind: str = "wkt", boundary: str | None = None) -> tuple[str, list[tuple[str, str, str]]]:
    """normalised WKT, and issues as (type, value, message). ``kind`` is wkt, multipolygon or point."""
    if not value:
        return "", []
    issues: list[tuple[str, str, str]] = []
    edge = BOUNDARY
    if boundary:
        found = parse_wkt(boundary)
        if found is None:
            issues.append(("Error reading boundary - must be a WKT", "", ""))
        elif found[0] not in ("Polygon", "MultiPolygon"):
            issues.append(("Invalid boundary provided - boundary must be of type Polygon or MultiPolygon", "", ""))
        else:
            edge = found
    geometry, from_json = parse_wkt(value), False
    if geometry is None and kind != "point":
        geometry = parse_geojson(value)
        from_json = geometry is not None
    if geometry is None:
        return "", [*issues, ("invalid WKT", value if kind != "wkt" else "", "Geometry must be in Well-Known Text (WKT) format")]
    if kind == "point" and geometry[0] != "Point":
        return "", [*issues, ("Unexpected geom type", value, "Geometry must be a point")]
    if kind == "multipolygon" and geometry[0] not in ("Polygon", "MultiPolygon", "GeometryCollection"):
        issues.append(("Unexpected geom type", value, "Geometry must be a multipolygon"))
        if not from_json:
            return "", issues
    if from_json:
        issues.append(("invalid type geojson", "", ""))
    else:
        geometry, issue, message = located(geometry, edge)
        if issue:
            issues.append((issue, "", message or ""))
        if geometry is None:
            return "", issues
    geometry = mapped(geometry, lambda x, y: (round(x, 6), round(y, 6)))
    geometry, wrong = normalised(geometry)
    if geometry is None:
        return "", issues
    if wrong:
        fixed = fault(geometry) is None
        issues.append(("invalid geometry - fixed", wrong, "") if fixed else ("invalid geometry - not fixable", wrong, "Geometry must be correctly formatted"))
    return dump_wkt(geometry), issues


def combined(values: list[str]) -> str:
    """one MultiPolygon of several; a true union where shapely is there, else the distinct parts."""
    if shapely is not None:
        union = shapely.unary_union([shapely.wkt.loads(v) for v in values])
        return dump_wkt(("MultiPolygon", polygons(parse_wkt(union.wkt))))
    parts: list = []
    for v in values:
        for p in polygons(parse_wkt(v) or ("MultiPolygon", [])):
            if p not in parts:
                parts.append(p)
    return dump_wkt(("MultiPolygon", parts))


_RESULT = "value string, issues array<struct<issue:string, issue_value:string, message:string>>"


def geometry_udf(kind: str, boundary: str | None = None):
    """An Arrow UDF of ``normalise``."""

    @arrow_udf(_RESULT)
    def run(values: pd.Series) -> pd.DataFrame:
        rows = [normalise(v, kind, boundary) if v else ("" if v == "" else None, []) for v in values]
        return pd.DataFrame({"value": [r[0] for r in rows], "issues": [[{"issue": a, "issue_value": b, "message": c} for a, b, c in r[1]] for r in rows]})

    return run


@arrow_udf("string")
def centroid_point(values: pd.Series) -> pd.Series:
    """the centroid of a WKT geometry as ``POINT (x y)``, to 6 decimals."""

    def one(v):
        middle = centroid(g) if v and (g := parse_wkt(v)) else None
        return f"POINT ({round(middle[0], 6):.6f} {round(middle[1], 6):.6f})" if middle else None

    return values.map(one, na_action="ignore")


@arrow_udf("boolean")
def is_multipolygon(values: pd.Series) -> pd.Series:
    """Q23: whether a text is a valid polygon, multipolygon or collection."""
    return values.map(lambda v: bool((g := parse_wkt(v)) and g[0] in ("Polygon", "MultiPolygon", "GeometryCollection") and fault(g) is None), na_action="ignore")


@arrow_udf("boolean")
def is_point(values: pd.Series) -> pd.Series:
    """Q24: whether a text is a point."""
    return values.map(lambda v: bool((g := parse_wkt(v)) and g[0] == "Point" and g[1]), na_action="ignore")


@arrow_udf("min_x double, min_y double, max_x double, max_y double, area double, rectangle boolean")
def measures_of(values: pd.Series) -> pd.DataFrame:
    """The box and area of a geometry, and whether it is its box."""

    def one(v):
        g = parse_wkt(v) if v else None
        if not g or not first_position(g):
            return (None,) * 6
        box, size = bounds(g), area(g)
        whole = (box[2] - box[0]) * (box[3] - box[1])
        parts = polygons(g)
        return (*box, size, len(parts) == 1 and len(parts[0]) == 1 and len(parts[0][0]) == 5 and abs(size - whole) <= 1e-9 * whole and whole > 0)

    return pd.DataFrame([one(v) for v in values], columns=["min_x", "min_y", "max_x", "max_y", "area", "rectangle"])
