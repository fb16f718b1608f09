"""Matching over the ping tables, messages and seat state."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayfold.functions import geo
from wayfold.operators import matching as M
from wayfold.plans.geodesic_sql import geodesic_stages
from wayfold.plans.proxy import VIEWS, WINDOW
from wayfold.plans.registry import query
from wayfold.schemas import CLIENT_MESSAGE, VEHICLE_MESSAGE
from wayfold.sources import messages as S

REMEMBER_WINDOW = "3 hours"


def pairs_cte(window: str, km: float) -> str:
    """Candidate pairs as ``geo_out``, all pairs of a (window, trip) tested, no grid."""
    hours = window.split()[0]
    bucket = f"time_bucket(INTERVAL {hours} HOUR, {{}}.ts)"
    cols = (
        "ventana, viaje_id, v_ts, vehiculo_id, v_event, num_plazas, latitud, longitud, latitud_final, longitud_final, "
        "u_ts, cliente_id, u_event, rating, metodo_pago"
    )
    both = f"""par AS (SELECT {bucket.format('v')} AS ventana, v.viaje_id, v.ts AS v_ts, v.vehiculo_id, v.event_id AS v_event, v.num_plazas, v.latitud, v.longitud,
 v.latitud_final, v.longitud_final, u.ts AS u_ts, u.cliente_id, u.event_id AS u_event, u.latitud AS u_lat, u.longitud AS u_lon, u.rating, u.metodo_pago
 FROM vehicle_pings v JOIN client_pings u ON v.viaje_id = u.viaje_id AND {bucket.format('v')} = {bucket.format('u')})"""
    stages = geodesic_stages("par", "latitud", "longitud", "u_lat", "u_lon", cols)
    return f"{both},\n{stages},\ncand AS (SELECT * FROM geo_out WHERE km <= {km}e0)"


def fold_cte(unit: list[str], seats_per: str = "ping") -> str:
    """First-come assignment as a recursive query: one step per candidate pair and unit, carrying the
    clients matched, the vehicles filled, the current ping and its taken seats. No unit is one memory for all."""
    key = ", ".join(unit) or "0 AS uno"
    own = ", ".join(f"p.{c}" for c in unit) or "0 AS uno"
    join = " AND ".join([*(f"p.{c} = s.{c}" for c in unit), "p.k = s.k + 1"])
    part, using = (f"PARTITION BY {key}" if unit else ""), ", ".join([*unit, "k"])
    seat = "CASE WHEN p.v_event = s.at THEN s.occ ELSE 0 END"
    if seats_per == "vehicle":
        seat = "len(list_filter(s.log, lambda x: x = p.vehiculo_id))"
    closed = "CASE WHEN p.v_event = s.at THEN s.closed ELSE list_contains(s.full_v, p.vehiculo_id) END"
    takes = f"(NOT ({closed}) AND ({seat}) < p.num_plazas AND NOT list_contains(s.used, p.cliente_id))"
    return f"""num AS (SELECT *, row_number() OVER ({part} ORDER BY ventana, viaje_id, v_ts, vehiculo_id, v_event, u_ts, cliente_id, u_event) AS k FROM cand),
 ini AS (SELECT DISTINCT {key} FROM num),
 fold AS (
  SELECT {key}, CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS used, CAST([] AS BIGINT[]) AS full_v, CAST([] AS BIGINT[]) AS log, CAST(-1 AS BIGINT) AS at, CAST(0 AS BIGINT) AS occ, FALSE AS closed, FALSE AS taken FROM ini
  UNION ALL
  SELECT {own}, p.k, CASE WHEN {takes} THEN list_append(s.used, p.cliente_id) ELSE s.used END,
   CASE WHEN {takes} AND ({seat}) + 1 >= p.num_plazas THEN list_append(s.full_v, p.vehiculo_id) ELSE s.full_v END,
   CASE WHEN {takes} THEN list_append(s.log, p.vehiculo_id) ELSE s.log END,
   p.v_event, CAST(({seat}) + CASE WHEN {takes} THEN 1 ELSE 0 END AS BIGINT), {closed}, {takes}
  FROM fold s JOIN num p ON {join}),
 hits AS (SELECT n.*, f.occ AS plazas_ocupadas FROM fold f JOIN num n USING ({using}) WHERE f.taken)"""


FARE = geodesic_stages("vehicle_pings", "latitud", "longitud", "latitud_final", "longitud_final", "event_id").replace("geo_", "fare_")
RIDE_SQL = """SELECT h.ventana, h.viaje_id, h.vehiculo_id, h.v_event, h.cliente_id, h.u_event, h.plazas_ocupadas, h.rating, h.metodo_pago, round(f.km, 6) AS pago_viaje,
 h.latitud, h.longitud, h.latitud_final, h.longitud_final FROM hits h JOIN fare_out f ON f.event_id = h.v_event"""
RIDE_COLUMNS = [
    "ventana", "viaje_id", "vehiculo_id", "v_event", "cliente_id", "u_event", "plazas_ocupadas", "rating", "metodo_pago", "pago_viaje",
    "latitud", "longitud", "latitud_final", "longitud_final",
]


def shown(rides):
    return rides.withColumn("pago_viaje", F.round("pago_viaje", 6)).withColumn("ventana", F.col("ventana").cast("timestamp_ntz")).select(*RIDE_COLUMNS)


CLOUD, LOCAL = pairs_cte(WINDOW, 2), pairs_cte(REMEMBER_WINDOW, 5)
PINGS = "vehicle_pings client_pings"


@query("match_candidates", PINGS, "SELECT ventana, viaje_id, v_event, u_event, round(km, 6) AS distancia_km FROM cand", more=CLOUD)
def _(i):
    c = M.candidates(i.vehicle_pings, i.client_pings, WINDOW, 2.0)
    return c.select(F.col("ventana").cast("timestamp_ntz").alias("ventana"), "viaje_id", "v_event", "u_event", F.round("distancia_km", 6).alias("distancia_km"))


@query(
    "windowed_cogroup", PINGS,
    """SELECT ventana, viaje_id, CAST(sum(v) AS BIGINT) AS pings_vehiculo, CAST(sum(u) AS BIGINT) AS pings_cliente FROM
 (SELECT time_bucket(INTERVAL 6 HOUR, ts) AS ventana, viaje_id, 1 AS v, 0 AS u FROM vehicle_pings
  UNION ALL SELECT time_bucket(INTERVAL 6 HOUR, ts), viaje_id, 0, 1 FROM client_pings) GROUP BY 1, 2""",
)
def _(i):
    return M.cogroup(i.vehicle_pings, i.client_pings, WINDOW).withColumn("ventana", F.col("ventana").cast("timestamp_ntz"))


@query(
    "windowed_cogroup_rows", PINGS,
    """SELECT *, row_number() OVER (PARTITION BY ventana, viaje_id ORDER BY lado, ts, id, event_id) AS orden FROM
 (SELECT time_bucket(INTERVAL 6 HOUR, ts) AS ventana, viaje_id, 0 AS lado, ts, vehiculo_id AS id, event_id FROM vehicle_pings
  UNION ALL SELECT time_bucket(INTERVAL 6 HOUR, ts), viaje_id, 1, ts, cliente_id, event_id FROM client_pings)""",
)
def _(i):
    """Every ping with its place in its group, counted by a fold over both sides' rows."""
    def numbered(key, rows):
        for place, r in enumerate(rows, 1):
            yield (*key, r.lado, r.ts, r.id, r.event_id, place)

    rows = M.cogroup_rows(i.vehicle_pings, i.client_pings, WINDOW)
    found = M.fold_groups(rows, ["ventana", "viaje_id"], numbered, "ventana timestamp, viaje_id long, lado int, ts timestamp, id long, event_id long, orden long")
    return found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("ventana", "ts")})


@query(
    "pings_per_window", "client_pings",
    "SELECT time_bucket(INTERVAL 30 SECOND, ts) AS inicio, time_bucket(INTERVAL 30 SECOND, ts) + INTERVAL 30 SECOND AS fin, count(*) AS pings FROM client_pings GROUP BY 1, 2",
)
def _(i):
    w = i.client_pings.groupBy(F.window("ts", "30 seconds").alias("w")).agg(F.count(F.lit(1)).alias("pings"))
    return w.select(F.col("w.start").cast("timestamp_ntz").alias("inicio"), F.col("w.end").cast("timestamp_ntz").alias("fin"), "pings")


@query("greedy_match", PINGS, RIDE_SQL, more=f"{CLOUD},\n{fold_cte(['ventana', 'viaje_id'])},\n{FARE}")
def _(i):
    return shown(M.greedy_match(i.vehicle_pings, i.client_pings, WINDOW, 2.0))


@query("greedy_match_seats_per_vehicle", PINGS, RIDE_SQL, more=f"{CLOUD},\n{fold_cte(['ventana', 'viaje_id'], 'vehicle')},\n{FARE}")
def _(i):
    return shown(M.greedy_match(i.vehicle_pings, i.client_pings, WINDOW, 2.0, seat_scope="vehicle"))


@query("greedy_match_remembering", PINGS, RIDE_SQL, more=f"{LOCAL},\n{fold_cte(['viaje_id'])},\n{FARE}")
def _(i):
    return shown(M.greedy_match_remembering(i.vehicle_pings, i.client_pings, REMEMBER_WINDOW, 5.0))


@query("greedy_match_shared_memory", PINGS, RIDE_SQL, more=f"{LOCAL},\n{fold_cte([])},\n{FARE}")
def _(i):
    return shown(M.greedy_match_shared_memory(i.vehicle_pings, i.client_pings, REMEMBER_WINDOW, 5.0))


FIRST_PING = (
    "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY time_bucket(INTERVAL 6 HOUR, ts), viaje_id ORDER BY ts, vehiculo_id, event_id) AS rn FROM todos) WHERE rn = 1"
)


@query(
    "single_ping_match", "client_pings",
    RIDE_SQL,
    more="todos AS (" + VIEWS["vehicle_pings"][1].format(events="events")
    + f"),\nvehicle_pings AS ({FIRST_PING}),\n{CLOUD},\n{fold_cte(['ventana', 'viaje_id'])},\n{FARE}",
)
def _(i):
    ranked = F.min_by(F.struct(*i.vehicle_pings.columns), F.struct("ts", "vehiculo_id", "event_id")).alias("p")
    first = M.windowed(i.vehicle_pings, WINDOW).groupBy("ventana", "viaje_id").agg(ranked).select("p.*")
    return shown(M.single_ping_match(first, i.client_pings, WINDOW, 2.0))


@query(
    "occupancy_log", PINGS,
    "SELECT ventana, viaje_id, vehiculo_id, v_event, cliente_id, plazas_ocupadas, num_plazas - plazas_ocupadas AS plazas_libres, latitud, longitud FROM hits",
    more=f"{CLOUD},\n{fold_cte(['ventana', 'viaje_id'])}",
)
def _(i):
    return M.occupancy_log(M.greedy_match(i.vehicle_pings, i.client_pings, WINDOW, 2.0)).withColumn("ventana", F.col("ventana").cast("timestamp_ntz"))


@query(
    "ride_timestamps", PINGS, "SELECT v_event, cliente_id, ventana + INTERVAL 6 HOUR AS momento FROM hits", more=f"{CLOUD},\n{fold_cte(['ventana', 'viaje_id'])}",
)
def _(i):
    return M.greedy_match(i.vehicle_pings, i.client_pings, WINDOW, 2.0).select("v_event", "cliente_id", F.col("timestamp").cast("timestamp_ntz").alias("momento"))


# Destinations on other continents, down to the point opposite: the same series with many steps.
FAR = """lejos AS (SELECT event_id, latitud, longitud, CASE event_id % 4 WHEN 0 THEN -33.8688e0 WHEN 1 THEN -33.4489e0 WHEN 2 THEN 40.7128e0 ELSE -36.8509e0 END + (event_id % 1000) / 1e4 AS lat_fin,
 CASE event_id % 4 WHEN 0 THEN 151.2093e0 WHEN 1 THEN -70.6693e0 WHEN 2 THEN -74.006e0 ELSE 174.7645e0 END + (event_id % 777) / 1e4 AS lon_fin FROM vehicle_pings)"""
FAR_OUT = geodesic_stages("lejos", "latitud", "longitud", "lat_fin", "lon_fin", "event_id", steps=24)


def far_goals(i):
    pick = lambda *values: F.element_at(F.array(*[F.lit(v) for v in values]), (F.col("event_id") % 4 + 1).cast("int"))
    return i.vehicle_pings.select(
        "event_id", "latitud", "longitud", (pick(-33.8688, -33.4489, 40.7128, -36.8509) + (F.col("event_id") % 1000) / F.lit(1e4)).alias("lat_fin"),
        (pick(151.2093, -70.6693, -74.006, 174.7645) + (F.col("event_id") % 777) / F.lit(1e4)).alias("lon_fin"),
    )


@query("fare_to_far_destination", "vehicle_pings", "SELECT event_id, round(km, 6) AS pago_viaje FROM geo_out", more=f"{FAR},\n{FAR_OUT}")
def _(i):
    far = geo.with_geodesic_km(far_goals(i), "latitud", "longitud", "lat_fin", "lon_fin", "km", far=True)
    return far.select("event_id", F.round(geo.fare("km"), 6).alias("pago_viaje"))


@query("pings_within_far_radius", "vehicle_pings", "SELECT event_id FROM geo_out WHERE km <= 17400e0", more=f"{FAR},\n{FAR_OUT}")
def _(i):
    return far_goals(i).where(geo.is_within_km("latitud", "longitud", "lat_fin", "lon_fin", 17400.0)).select("event_id")


@query(
    "full_vehicles", PINGS,
    "SELECT ventana, viaje_id, vehiculo_id, v_event, num_plazas FROM hits GROUP BY ALL HAVING count(*) = num_plazas",
    more=f"{CLOUD},\n{fold_cte(['ventana', 'viaje_id'])}",
)
def _(i):
    return M.full_vehicles(M.greedy_match(i.vehicle_pings, i.client_pings, WINDOW, 2.0)).withColumn("ventana", F.col("ventana").cast("timestamp_ntz"))


@query(
    "unmatched_requests", PINGS,
    "SELECT event_id, cliente_id, viaje_id FROM client_pings u WHERE NOT EXISTS (SELECT 1 FROM hits h WHERE h.cliente_id = u.cliente_id AND h.viaje_id = u.viaje_id AND h.ventana = time_bucket(INTERVAL 6 HOUR, u.ts))",
    more=f"{CLOUD},\n{fold_cte(['ventana', 'viaje_id'])}",
)
def _(i):
    taken = M.greedy_match(i.vehicle_pings, i.client_pings, WINDOW, 2.0)
    return M.unmatched(M.windowed(i.client_pings, WINDOW), taken, ["ventana"]).select("event_id", "cliente_id", "viaje_id")


@query(
    "seat_state", PINGS,
    """SELECT p.event_id, coalesce(t.n, 0) AS plazas_ocupadas, coalesce(t.n, 0) >= p.num_plazas AS lleno,
 NOT (coalesce(t.n, 0) >= p.num_plazas) AND NOT (p.latitud = p.latitud_final AND p.longitud = p.longitud_final) AS disponible
 FROM vehicle_pings p LEFT JOIN (SELECT v_event, count(*) AS n FROM hits GROUP BY v_event) t ON t.v_event = p.event_id""",
    more=f"{CLOUD},\n{fold_cte(['ventana', 'viaje_id'])}",
)
def _(i):
    return M.open_seats(i.vehicle_pings, M.greedy_match(i.vehicle_pings, i.client_pings, WINDOW, 2.0)).select("event_id", "plazas_ocupadas", "lleno", "disponible")


ARRIVED = """llegadas AS (SELECT event_id, ts, viaje_id, vehiculo_id, num_plazas, latitud, longitud,
 CASE WHEN event_id % 5 = 0 THEN latitud ELSE latitud_final END AS latitud_final, CASE WHEN event_id % 5 = 0 THEN longitud ELSE longitud_final END AS longitud_final FROM vehicle_pings)"""


def arrivals(pings):
    there = F.col("event_id") % 5 == 0
    return pings.withColumns({
        "latitud_final": F.when(there, F.col("latitud")).otherwise(F.col("latitud_final")),
        "longitud_final": F.when(there, F.col("longitud")).otherwise(F.col("longitud_final")),
    })


@query(
    "finished_trips", "vehicle_pings",
    "SELECT event_id, vehiculo_id, latitud = latitud_final AND longitud = longitud_final AS viaje_finalizado FROM llegadas", more=ARRIVED,
)
def _(i):
    return M.finished(arrivals(i.vehicle_pings)).select("event_id", "vehiculo_id", "viaje_finalizado")


@query(
    "latest_position", "vehicle_pings",
    """SELECT vehiculo_id, latitud, longitud, latitud_final, longitud_final, latitud = latitud_final AND longitud = longitud_final AS viaje_finalizado FROM
 (SELECT *, row_number() OVER (PARTITION BY vehiculo_id ORDER BY ts DESC, event_id DESC) AS rn FROM llegadas) WHERE rn = 1""",
    more=ARRIVED,
)
def _(i):
    return M.latest_position(arrivals(i.vehicle_pings))


# Messages: rows to JSON and back.

REQUEST = ["cliente_id", "viaje_id", "latitud", "longitud", "rating", "metodo_pago"]
POSITION = ["viaje_id", "vehiculo_id", "latitud", "longitud", "num_plazas", "latitud_final", "longitud_final"]


def whole_rating(pings):
    return pings.withColumn("rating", F.col("rating").cast("long"))


def broken(pings):
    """Blank one field of every eleventh request and spoil the text of every thirteenth."""
    sent = S.to_messages(whole_rating(pings).withColumn("metodo_pago", F.when(F.col("event_id") % 11 != 0, F.col("metodo_pago"))), REQUEST)
    return sent.withColumn("value", F.when(F.col("event_id") % 13 == 0, F.lit("{cliente")).otherwise(F.col("value")).cast("binary"))


@query("requests_to_messages", "client_pings", """SELECT event_id, CAST(cliente_id AS BIGINT) AS cliente_id, CAST(rating AS BIGINT) AS rating, metodo_pago FROM client_pings""")
def _(i):
    sent = S.to_messages(whole_rating(i.client_pings), REQUEST)
    field = lambda n: F.get_json_object("value", f"$.{n}")
    return sent.select("event_id", field("cliente_id").cast("long").alias("cliente_id"), field("rating").cast("long").alias("rating"), field("metodo_pago").alias("metodo_pago"))


@query("request_message_text", "client_pings", """SELECT event_id, '{"cliente_id":' || cliente_id || ',"viaje_id":' || viaje_id || ',"metodo_pago":"' || metodo_pago || '"}' AS value FROM client_pings""")
def _(i):
    return S.to_messages(i.client_pings, ["cliente_id", "viaje_id", "metodo_pago"]).select("event_id", "value")


@query("decoded_positions", "vehicle_pings", f"SELECT event_id, {', '.join(POSITION)} FROM vehicle_pings")
def _(i):
    sent = S.to_messages(i.vehicle_pings, POSITION).withColumn("value", F.col("value").cast("binary"))
    return S.decode(sent, VEHICLE_MESSAGE)[0].select("event_id", *POSITION)


@query(
    "decoded_requests", "client_pings",
    "SELECT event_id, cliente_id, viaje_id, latitud, longitud, CAST(rating AS BIGINT) AS rating, metodo_pago FROM client_pings WHERE event_id % 11 <> 0 AND event_id % 13 <> 0",
)
def _(i):
    return S.decode(broken(i.client_pings), CLIENT_MESSAGE)[0].select("event_id", *REQUEST)


@query(
    "quarantined_requests", "client_pings",
    "SELECT event_id, CASE WHEN event_id % 13 = 0 THEN 'unreadable' ELSE 'missing metodo_pago' END AS reason FROM client_pings WHERE event_id % 11 = 0 OR event_id % 13 = 0",
)
def _(i):
    return S.decode(broken(i.client_pings), CLIENT_MESSAGE)[1].select("event_id", "reason")


@query("record_assembly", "vehicle_pings", f"SELECT {', '.join(POSITION)} FROM vehicle_pings")
def _(i):
    return i.vehicle_pings.select(*POSITION)


@query(
    "parsed_timestamps", "client_pings",
    "SELECT event_id, date_trunc('second', ts) AS momento, CAST(date_trunc('day', ts) AS DATE) AS dia, CAST(cliente_id AS VARCHAR) AS cliente_texto, CAST(rating AS BIGINT) AS rating FROM client_pings",
)
def _(i):
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return i.client_pings.select(
        "event_id", F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz").alias("momento"), F.to_date("ts").alias("dia"),
        F.col("cliente_id").cast("string").alias("cliente_texto"), F.col("rating").cast("long").alias("rating"),
    )
