import pytest
from pyspark.sql import functions as F

from wayfold.operators import routes as R
from wayfold.plans import proxy
from wayfold.sources.routes import read_routes

HEAD = '<?xml version="1.0" encoding="UTF-8"?><kml xmlns="http://www.opengis.net/kml/2.2"><Document>'
TAIL = "</Document></kml>"
POINT = "<Placemark><Point><coordinates>-0.1,39.1,0</coordinates></Point></Placemark>"


def line(*points):
    return "<Placemark><LineString><coordinates>\n  " + "\n  ".join(points) + "\n</coordinates></LineString></Placemark>"


@pytest.fixture
def folder(tmp_path):
    a, b = ("-0.37,39.47,0", "-0.38,39.48,5", "-0.39,39.49,0"), ("-0.30,39.40,0", "-0.31,39.41,0")
    files = {
        "a.kml": HEAD + POINT + line(*a) + TAIL,
        "b.kml": HEAD + POINT + TAIL,
        "c.kml": HEAD + line(*b) + line(*a) + TAIL,
        "copy": HEAD + line(*a) + TAIL,
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    return str(tmp_path)


def test_folder(spark, folder):
    rows = [tuple(r) for r in read_routes(spark, folder).orderBy("viaje", "punto").collect()]
    assert rows == [
        (1, 1, 39.47, -0.37, 0.0), (1, 2, 39.48, -0.38, 5.0), (1, 3, 39.49, -0.39, 0.0), (2, 1, 39.40, -0.30, 0.0), (2, 2, 39.41, -0.31, 0.0),
    ]


@pytest.mark.parametrize("cross", [False, True])
def test_long_trips_are_cut_without_changing_legs(spark, small, cross):
    points = proxy.view(spark, small, "route_points").cache()
    whole, cut = (R.with_leg_distance(points, cross, run).select("viaje_id", "punto_ruta", F.round("distancia", 6)) for run in (10**9, 7))
    assert whole.exceptAll(cut).isEmpty() and whole.count() == cut.count() == points.count()


def test_polyline_pieces_join_up(spark, small):
    points = proxy.view(spark, small, "route_points")
    pieces = R.polyline(points, 10).orderBy("viaje_id", "pieza").collect()
    assert max(len(p.linea) for p in pieces) <= 11
    for a, b in zip(pieces, pieces[1:]):
        if a.viaje_id == b.viaje_id:
            assert a.linea[-1] == b.linea[0]


def test_destination_over_cut_trips(spark, small):
    points = proxy.view(spark, small, "route_points")
    whole, cut = R.with_destination(points, 10**9), R.with_destination(points, 7)
    assert whole.exceptAll(cut).isEmpty() and whole.count() == cut.count() == points.count()
