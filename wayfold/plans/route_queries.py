"""Route points: parsing, distances, ends, lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayfold.operators import matching as M
from wayfold.operators import routes as R
from wayfold.plans.analytics_queries import rounded
from wayfold.plans.geodesic_sql import geodesic_stages, haversine_sql
from wayfold.plans.registry import query
from wayfold.schemas import ROUTE_COLUMNS
from wayfold.sources import routes as K

PIECE = 50


def kml_documents(points):
    """One KML text per piece of route, with a Point placemark before the line as real files have."""
    piece = F.floor((F.col("punto_ruta") - 1) / PIECE)
    triple = F.concat_ws(",", F.col("longitud").cast("string"), F.col("latitud").cast("string"), F.lit("0"))
    lines = points.groupBy("viaje_id", piece.alias("pieza")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("punto_ruta", triple.alias("t")))), lambda x: x["t"]), "\n   ").alias("c")
    )
    head = '<kml xmlns="http://www.opengis.net/kml/2.2"><Document><Placemark><Point><coordinates>-0.1,39.1,0</coordinates></Point></Placemark>'
    return lines.select(
        F.concat(F.lpad(F.col("viaje_id").cast("string"), 6, "0"), F.lit("/"), F.lpad(F.col("pieza").cast("string"), 9, "0")).alias("_file"),
        F.concat(F.lit(head + "<Placemark><LineString><coordinates>\n   "), F.col("c"), F.lit("\n</coordinates></LineString></Placemark></Document></kml>")).alias("value"),
    )


@query(
    "kml_parse", "route_points",
    f"SELECT viaje_id, (punto_ruta - 1) // {PIECE} AS pieza, (punto_ruta - 1) % {PIECE} + 1 AS punto, latitud AS latitude, longitud AS longitude, altura AS altitude FROM route_points",
)
def _(i):
    part = F.split("_file", "/")
    return K.points(K.lines(kml_documents(i.route_points))).select(
        part[0].cast("long").alias("viaje_id"), part[1].cast("long").alias("pieza"), "punto", "latitude", "longitude", "altitude"
    )


@query(
    "kml_trip_numbers", "route_points",
    f"""SELECT dense_rank() OVER (ORDER BY viaje_id, (punto_ruta - 1) // {PIECE}) AS viaje, (punto_ruta - 1) % {PIECE} + 1 AS punto,
 latitud AS latitude, longitud AS longitude, altura AS altitude FROM route_points""",
)
def _(i):
    return K.points(K.number_files(K.lines(kml_documents(i.route_points))))


@query(
    "stored_route_columns", "route_points",
    f"SELECT dense_rank() OVER (ORDER BY viaje_id, (punto_ruta - 1) // {PIECE}) AS viaje_id, (punto_ruta - 1) % {PIECE} + 1 AS punto_ruta, latitud, longitud, altura FROM route_points",
)
def _(i):
    return K.points(K.number_files(K.lines(kml_documents(i.route_points)))).withColumnsRenamed(ROUTE_COLUMNS)


LEG = haversine_sql("latitud", "longitud", "lat2", "lon2")


@query(
    "leg_distance", "route_points",
    f"""SELECT viaje_id, punto_ruta, round(coalesce({LEG}, 0), 3) AS distancia FROM (SELECT *, lead(latitud) OVER w AS lat2, lead(longitud) OVER w AS lon2
 FROM route_points WINDOW w AS (PARTITION BY viaje_id ORDER BY punto_ruta))""",
)
def _(i):
    return rounded(R.with_leg_distance(i.route_points), "distancia", digits=3).select("viaje_id", "punto_ruta", "distancia")


@query(
    "leg_distance_across_trips", "route_points",
    f"""SELECT viaje_id, punto_ruta, round(coalesce({LEG}, 0), 3) AS distancia FROM (SELECT *, lead(latitud) OVER w AS lat2, lead(longitud) OVER w AS lon2
 FROM route_points WINDOW w AS (ORDER BY viaje_id, punto_ruta))""",
)
def _(i):
    return rounded(R.with_leg_distance(i.route_points, cross_trip=True), "distancia", digits=3).select("viaje_id", "punto_ruta", "distancia")


@query(
    "route_length", "route_points",
    f"""SELECT viaje_id, round(sum(coalesce({LEG}, 0)), 4) AS metros FROM (SELECT *, lead(latitud) OVER w AS lat2, lead(longitud) OVER w AS lon2
 FROM route_points WINDOW w AS (PARTITION BY viaje_id ORDER BY punto_ruta)) GROUP BY viaje_id""",
)
def _(i):
    return R.with_leg_distance(i.route_points).groupBy("viaje_id").agg(F.round(F.sum("distancia"), 4).alias("metros"))


@query(
    "haversine_to_destination", "vehicle_pings",
    f"SELECT event_id, round({haversine_sql('latitud', 'longitud', 'latitud_final', 'longitud_final')}, 3) AS metros FROM vehicle_pings",
)
def _(i):
    from wayfold.functions.geo import haversine_m

    return i.vehicle_pings.select("event_id", F.round(haversine_m("latitud", "longitud", "latitud_final", "longitud_final"), 3).alias("metros"))


FARES = geodesic_stages("vehicle_pings", "latitud", "longitud", "latitud_final", "longitud_final", "event_id")


@query("geodesic_to_destination", "vehicle_pings", "SELECT event_id, round(km, 6) AS km FROM geo_out", more=FARES)
def _(i):
    from wayfold.functions.geo import with_geodesic_km

    return with_geodesic_km(i.vehicle_pings, "latitud", "longitud", "latitud_final", "longitud_final", "km").select("event_id", F.round("km", 6).alias("km"))


@query("fare_to_destination", "vehicle_pings", "SELECT event_id, round(km * 1.0e0, 6) AS pago_viaje FROM geo_out", more=FARES)
def _(i):
    from wayfold.functions.geo import fare, with_geodesic_km

    df = with_geodesic_km(i.vehicle_pings, "latitud", "longitud", "latitud_final", "longitud_final", "km")
    return df.select("event_id", F.round(fare("km"), 6).alias("pago_viaje"))


@query(
    "route_endpoints", "route_points",
    """SELECT viaje_id, arg_min(latitud, punto_ruta) AS latitud_inicio, arg_min(longitud, punto_ruta) AS longitud_inicio,
 arg_max(latitud, punto_ruta) AS latitud_final, arg_max(longitud, punto_ruta) AS longitud_final FROM route_points GROUP BY viaje_id""",
)
def _(i):
    return R.endpoints(i.route_points).select("viaje_id", "latitud_inicio", "longitud_inicio", "latitud_final", "longitud_final")


@query(
    "last_route_point", "route_points",
    "SELECT viaje_id, max(punto_ruta) AS ultimo_punto, arg_max(latitud, punto_ruta) AS latitud_final, arg_max(longitud, punto_ruta) AS longitud_final FROM route_points GROUP BY viaje_id",
)
def _(i):
    return R.endpoints(i.route_points).select("viaje_id", "ultimo_punto", "latitud_final", "longitud_final")


@query("route_extent", "route_points", "SELECT viaje_id, max(latitud) AS latitud_max, max(longitud) AS longitud_max FROM route_points GROUP BY viaje_id")
def _(i):
    return R.endpoints(i.route_points).select("viaje_id", "latitud_max", "longitud_max")


@query("trip_ids", "route_points", "SELECT DISTINCT viaje_id FROM route_points")
def _(i):
    return R.trip_ids(i.route_points)


@query(
    "route_polyline", "route_points",
    """SELECT viaje_id, pieza, count(*) AS puntos, string_agg(CAST(CAST(round(latitud * 1e6) AS BIGINT) AS VARCHAR) || ' ' || CAST(CAST(round(longitud * 1e6) AS BIGINT) AS VARCHAR), ';' ORDER BY punto_ruta) AS linea
 FROM (SELECT *, unnest(CASE WHEN punto_ruta > 1 AND (punto_ruta - 1) % 100 = 0 THEN [(punto_ruta - 1) // 100 - 1, (punto_ruta - 1) // 100] ELSE [(punto_ruta - 1) // 100] END) AS pieza FROM route_points) GROUP BY viaje_id, pieza""",
)
def _(i):
    line = R.polyline(i.route_points, 100)
    micro = lambda c: F.round(c * 1e6).cast("long").cast("string")
    return line.select(
        "viaje_id", "pieza", F.size("linea").cast("long").alias("puntos"),
        F.array_join(F.transform("linea", lambda p: F.concat_ws(" ", micro(p["latitud"]), micro(p["longitud"]))), ";").alias("linea"),
    )


@query(
    "points_with_destination", "route_points",
    """SELECT viaje_id, punto_ruta, latitud, longitud, last_value(latitud) OVER w AS latitud_final, last_value(longitud) OVER w AS longitud_final FROM route_points
 WINDOW w AS (PARTITION BY viaje_id ORDER BY punto_ruta ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
)
def _(i):
    return R.with_destination(i.route_points).drop("altura")


@query("route_stride", "route_points", "SELECT viaje_id, punto_ruta, latitud, longitud FROM route_points WHERE (punto_ruta - 1) % 20 = 0")
def _(i):
    return R.stride(i.route_points).drop("altura")


@query("map_centre", "route_points", "SELECT round(avg(latitud), 6) AS latitud_centro, round(avg(longitud), 6) AS longitud_centro FROM route_points")
def _(i):
    return rounded(R.centre(i.route_points), "latitud_centro", "longitud_centro")


@query("points_of_trip", "route_points", "SELECT punto_ruta, latitud, longitud FROM route_points WHERE viaje_id = 7")
def _(i):
    return R.of_trip(i.route_points, 7).select("punto_ruta", "latitud", "longitud")


@query("unknown_trips", "route_points rides", "SELECT DISTINCT viaje_id FROM rides WHERE viaje_id NOT IN (SELECT viaje_id FROM route_points)")
def _(i):
    return R.unknown_trips(i.rides, i.route_points)


@query("route_preview", "route_points", "SELECT * FROM route_points ORDER BY viaje_id, punto_ruta LIMIT 5")
def _(i):
    from wayfold.operators.sampling import preview

    return preview(i.route_points, "viaje_id", "punto_ruta")


NEAR_KM = 0.12
NEAR = (
    "junto AS (SELECT u.event_id AS k, u.latitud AS la, u.longitud AS lo, p.latitud AS lb, p.longitud AS lp FROM client_pings u JOIN (SELECT DISTINCT viaje_id, latitud, longitud FROM route_points) p "
    f"ON u.viaje_id = p.viaje_id AND {haversine_sql('u.latitud', 'u.longitud', 'p.latitud', 'p.longitud')} <= {NEAR_KM * 1000 * 1.01}),\n"
    + geodesic_stages("junto", "la", "lo", "lb", "lp", "k")
)


@query("pings_near_route", "client_pings route_points", f"SELECT DISTINCT k AS event_id FROM geo_out WHERE km <= {NEAR_KM}", more=NEAR)
def _(i):
    return M.near_route(i.client_pings, i.route_points, NEAR_KM).select("event_id")
