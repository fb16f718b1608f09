"""Indicators and chart data over the rides."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayfold.functions.text import money
from wayfold.operators import analytics as A
from wayfold.plans.registry import query


def rounded(df, *cols: str, digits: int = 6):
    """Floating sums differ in the last bits between orders of addition; compare to 6 decimals."""
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


ENRICHED_COLUMNS = (
    "cliente_id, rating, metodo_pago, pago_viaje, viaje_id, vehiculo_id, latitud, longitud, latitud_final, longitud_final, event_ts, "
    "nombre_conductor, marca_coche, color_coche, anio_fabricacion, tipo_combustible, tiene_calefaccion, puntos_carnet, cilindraje_motor, "
    "kilometraje, anio_registro_app, nombre_cliente, apellido_cliente, edad_cliente, genero_cliente, direccion_cliente, trabajo_cliente, fecha_registro"
)


@query("enriched_rides", "enriched", f"SELECT {ENRICHED_COLUMNS} FROM enriched")
def _(i):
    return i.enriched.select(*[c.strip() for c in ENRICHED_COLUMNS.split(",")])


@query(
    "rides_left_join_vehicles", "rides vehicles",
    "SELECT r.vehiculo_id, r.pago_viaje, v.nombre_conductor, v.marca_coche FROM rides r LEFT JOIN vehicles v ON r.vehiculo_id = v.vehiculo_id",
)
def _(i):
    return i.rides.join(i.vehicles, "vehiculo_id", "left").select("vehiculo_id", "pago_viaje", "nombre_conductor", "marca_coche")


@query(
    "rides_left_join_clients", "rides clients",
    "SELECT r.cliente_id, r.pago_viaje, c.nombre_cliente, c.edad_cliente FROM rides r LEFT JOIN clients c ON r.cliente_id = c.cliente_id",
)
def _(i):
    return i.rides.join(i.clients, "cliente_id", "left").select("cliente_id", "pago_viaje", "nombre_cliente", "edad_cliente")


@query("scan_route_table", "route_points", "SELECT * FROM route_points")
def _(i):
    return i.route_points


@query("scan_ride_positions", "rides", "SELECT latitud, longitud, viaje_id FROM rides")
def _(i):
    return i.rides.select("latitud", "longitud", "viaje_id")


@query("total_revenue", "rides", "SELECT round(coalesce(sum(pago_viaje), 0), 6) AS recaudacion_total FROM rides")
def _(i):
    return rounded(A.total_revenue(i.rides), "recaudacion_total")


@query("trip_count", "rides", "SELECT count(*) AS total_viajes FROM (SELECT DISTINCT vehiculo_id, viaje_id FROM rides WHERE vehiculo_id IS NOT NULL AND viaje_id IS NOT NULL)")
def _(i):
    return A.trip_count(i.rides)


@query(
    "revenue_per_trip", "rides",
    "SELECT round(sum(pago_viaje) / count(DISTINCT (vehiculo_id, viaje_id)), 6) AS recaudacion_por_viaje FROM rides",
)
def _(i):
    return rounded(A.revenue_per_trip(i.rides), "recaudacion_por_viaje")


@query("active_drivers", "enriched", "SELECT count(DISTINCT nombre_conductor) AS conductores_activos FROM enriched")
def _(i):
    return A.distinct_count(i.rides_by_vehicle, "nombre_conductor", "conductores_activos")


@query("distinct_clients", "rides", "SELECT count(DISTINCT cliente_id) AS clientes_unicos FROM rides")
def _(i):
    return A.distinct_count(i.rides, "cliente_id", "clientes_unicos")


@query(
    "mean_driver_rating", "enriched",
    "SELECT round(avg(m), 6) AS rating_medio FROM (SELECT avg(rating) AS m FROM enriched WHERE nombre_conductor IS NOT NULL GROUP BY nombre_conductor)",
)
def _(i):
    return rounded(A.mean_of_means(i.rides_by_vehicle, "nombre_conductor", "rating", "rating_medio"), "rating_medio")


@query("mean_client_age", "enriched", "SELECT round(avg(edad_cliente), 6) AS edad_media FROM enriched")
def _(i):
    return rounded(A.mean_of_tally(A.per_ride(i.rides, i.clients, "cliente_id", "edad_cliente"), "edad_media"), "edad_media")


@query("mean_registration_year", "enriched", "SELECT round(avg(anio_registro_app), 6) AS anio_registro_medio FROM enriched")
def _(i):
    return rounded(A.mean(i.rides_by_vehicle, "anio_registro_app", "anio_registro_medio"), "anio_registro_medio")


KPI_SQL = """SELECT sum(pago_viaje) AS recaudacion_total, count(DISTINCT (vehiculo_id, viaje_id)) AS total_viajes,
 sum(pago_viaje) / count(DISTINCT (vehiculo_id, viaje_id)) AS recaudacion_por_viaje, avg(edad_cliente) AS edad_media,
 avg(anio_registro_app) AS anio_registro_medio, count(DISTINCT nombre_conductor) AS conductores_activos, count(DISTINCT cliente_id) AS clientes_unicos,
 (SELECT avg(m) FROM (SELECT avg(rating) AS m FROM enriched WHERE nombre_conductor IS NOT NULL GROUP BY nombre_conductor)) AS rating_medio
 FROM enriched"""


@query(
    "kpis", "enriched",
    f"""SELECT round(recaudacion_total, 6) AS recaudacion_total, total_viajes, round(recaudacion_por_viaje, 6) AS recaudacion_por_viaje,
 round(edad_media, 6) AS edad_media, round(anio_registro_medio, 6) AS anio_registro_medio, conductores_activos, clientes_unicos,
 round(rating_medio, 6) AS rating_medio FROM ({KPI_SQL})""",
)
def _(i):
    return rounded(A.kpis(i.enriched), "recaudacion_total", "recaudacion_por_viaje", "edad_media", "anio_registro_medio", "rating_medio")


@query(
    "kpi_display", "enriched",
    f"""SELECT format('{{:,.2f}}€', recaudacion_total) AS recaudacion_total, CAST(total_viajes AS VARCHAR) AS total_viajes,
 format('{{:,.2f}}€', recaudacion_por_viaje) AS recaudacion_por_viaje, round(rating_medio, 2) AS rating_medio, round(edad_media, 2) AS edad_media,
 format('{{:,.0f}}', anio_registro_medio) AS anio_registro_medio FROM ({KPI_SQL})""",
)
def _(i):
    return A.display_kpis(A.kpis(i.enriched))


def revenue_sql(key: str, tail: str = "") -> str:
    return (
        f"SELECT {key}, round(sum(pago_viaje), 6) AS recaudacion FROM enriched WHERE {key} IS NOT NULL GROUP BY {key} "
        f"ORDER BY recaudacion DESC, {key} {tail}"
    )


@query("top_revenue_by_driver", "enriched", revenue_sql("nombre_conductor", "LIMIT 14"))
def _(i):
    return rounded(A.top_revenue(i.rides_by_vehicle, "nombre_conductor"), "recaudacion")


@query("top_revenue_by_brand", "enriched", revenue_sql("marca_coche", "LIMIT 14"))
def _(i):
    return rounded(A.top_revenue(i.rides_by_vehicle, "marca_coche"), "recaudacion")


@query("revenue_by_model_year", "enriched", revenue_sql("anio_fabricacion"))
def _(i):
    return rounded(A.revenue_by(i.rides_by_vehicle, "anio_fabricacion"), "recaudacion")


def counts_sql(view: str, key: str, tail: str = "") -> str:
    return f"SELECT {key}, count(*) AS num_viajes FROM {view} WHERE {key} IS NOT NULL GROUP BY {key} ORDER BY num_viajes DESC, {key} {tail}"


@query("rides_per_vehicle", "rides", counts_sql("rides", "vehiculo_id"))
def _(i):
    return A.counts(i.rides, "vehiculo_id")


@query("rides_per_client", "rides", counts_sql("rides", "cliente_id"))
def _(i):
    return A.counts(i.rides, "cliente_id")


@query("top_colours", "enriched", counts_sql("enriched", "color_coche", "LIMIT 14"))
def _(i):
    return A.counts(i.rides_by_vehicle, "color_coche", n=14)


@query("rides_per_fuel", "enriched", counts_sql("enriched", "tipo_combustible"))
def _(i):
    return A.counts(i.rides_by_vehicle, "tipo_combustible")


@query(
    "rides_of_top_colours", "enriched",
    f"SELECT color_coche, rating, pedido, linea FROM enriched WHERE color_coche IN (SELECT color_coche FROM ({counts_sql('enriched', 'color_coche', 'LIMIT 14')}))",
)
def _(i):
    return A.of_top(i.rides_by_vehicle.select("color_coche", "rating", "pedido", "linea"), "color_coche")


@query(
    "rating_box_by_colour", "enriched",
    """SELECT color_coche, count(*) AS n, min(rating) AS minimo, any_value(q1) AS q1, any_value(mediana) AS mediana, any_value(q3) AS q3, max(rating) AS maximo,
 min(rating) FILTER (rating BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS bigote_inferior,
 max(rating) FILTER (rating BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS bigote_superior,
 count(*) FILTER (rating NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS atipicos
 FROM chosen JOIN quart USING (color_coche) GROUP BY color_coche""",
    more=f"""top AS ({counts_sql('enriched', 'color_coche', 'LIMIT 14')}),
 chosen AS (SELECT color_coche, rating FROM enriched WHERE color_coche IN (SELECT color_coche FROM top)),
 quart AS (SELECT color_coche, quantile_cont(rating, 0.25) AS q1, quantile_cont(rating, 0.5) AS mediana, quantile_cont(rating, 0.75) AS q3 FROM chosen GROUP BY color_coche)""",
)
def _(i):
    return A.box_stats(i.rides_by_vehicle, "color_coche", "rating")


PROFILE_COLUMNS = ["rating", "kilometraje", "edad_cliente", "puntos_carnet"]
PROFILE = "perfil AS (SELECT nombre_conductor, {} FROM enriched WHERE nombre_conductor IS NOT NULL GROUP BY nombre_conductor)".format(
    ", ".join(f"avg({c}) AS {c}" for c in PROFILE_COLUMNS)
)
SCALED = ", ".join(f"round(({c} - min({c}) OVER ()) / nullif(max({c}) OVER () - min({c}) OVER (), 0), 6) AS {c}" for c in PROFILE_COLUMNS)


@query("driver_profile", "enriched", f"SELECT nombre_conductor, {SCALED} FROM perfil", more=PROFILE)
def _(i):
    return rounded(A.driver_profile(i.enriched), *PROFILE_COLUMNS)


@query("driver_profile_first", "enriched", f"SELECT * FROM (SELECT nombre_conductor, {SCALED} FROM perfil) ORDER BY nombre_conductor LIMIT 1", more=PROFILE)
def _(i):
    return rounded(A.driver_profile(i.enriched), *PROFILE_COLUMNS).orderBy("nombre_conductor").limit(1)


@query(
    "engine_size_distribution", "enriched",
    """SELECT count(x) AS n, CAST(min(x) AS DOUBLE) AS minimo, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS mediana, quantile_cont(x, 0.75) AS q3,
 CAST(max(x) AS DOUBLE) AS maximo, round(avg(x), 6) AS media FROM (SELECT CAST(cilindraje_motor AS DOUBLE) AS x FROM enriched)""",
)
def _(i):
    return rounded(A.distribution(i.rides_by_vehicle, "cilindraje_motor"), "media")


@query(
    "engine_size_density", "enriched",
    """SELECT g.i AS punto, round(lo + g.i * (hi - lo) / 99, 6) AS x, round(sum(c * exp(-0.5 * power((lo + g.i * (hi - lo) / 99 - v) / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 9) AS densidad
 FROM (SELECT CAST(unnest(range(100)) AS INT) AS i) g, valores, s GROUP BY g.i, lo, hi""",
    more="""valores AS (SELECT CAST(cilindraje_motor AS DOUBLE) AS v, count(*) AS c FROM enriched WHERE cilindraje_motor IS NOT NULL GROUP BY 1),
 s AS (SELECT count(cilindraje_motor) AS n, CAST(min(cilindraje_motor) AS DOUBLE) AS lo, CAST(max(cilindraje_motor) AS DOUBLE) AS hi, stddev_samp(cilindraje_motor) * power(count(cilindraje_motor), -0.2) AS h FROM enriched)""",
)
def _(i):
    return rounded(rounded(A.density_curve(i.rides_by_vehicle, "cilindraje_motor"), "x"), "densidad", digits=9)


def density_sql(lat: str, lon: str) -> str:
    return f"SELECT CAST(floor({lat} / 0.01e0) AS BIGINT) AS fila, CAST(floor({lon} / 0.01e0) AS BIGINT) AS columna, count(*) AS viajes FROM rides GROUP BY 1, 2"


@query("pickup_density", "rides", density_sql("latitud", "longitud"))
def _(i):
    return A.grid_density(i.rides)


@query("destination_density", "rides", density_sql("latitud_final", "longitud_final"))
def _(i):
    return A.grid_density(i.rides, "latitud_final", "longitud_final")


@query("pickup_centre", "rides", "SELECT round(avg(latitud), 6) AS latitud_centro, round(avg(longitud), 6) AS longitud_centro FROM rides")
def _(i):
    from wayfold.operators.routes import centre

    return rounded(centre(i.rides), "latitud_centro", "longitud_centro")


@query("destination_centre", "rides", "SELECT round(avg(latitud_final), 6) AS latitud_centro, round(avg(longitud_final), 6) AS longitud_centro FROM rides")
def _(i):
    from wayfold.operators.routes import centre

    return rounded(centre(i.rides, "latitud_final", "longitud_final"), "latitud_centro", "longitud_centro")


@query(
    "payment_shares", "rides",
    "SELECT metodo_pago, count(*) AS cantidad, round(count(*) * 100.0e0 / (SELECT count(*) FROM rides), 6) AS porcentaje FROM rides WHERE metodo_pago IS NOT NULL GROUP BY metodo_pago",
)
def _(i):
    return rounded(A.shares(i.rides, "metodo_pago"), "porcentaje")


@query(
    "driver_shares_of_all_rides", "enriched",
    "SELECT nombre_conductor, count(*) AS cantidad, round(count(*) * 100.0e0 / (SELECT count(*) FROM rides), 6) AS porcentaje FROM enriched WHERE nombre_conductor IS NOT NULL GROUP BY nombre_conductor",
)
def _(i):
    return rounded(A.shares(i.rides_by_vehicle, "nombre_conductor"), "porcentaje")


def histogram_sql(source: str, bins: int, lo: str, hi: str, density: str = "") -> str:
    return f"""SELECT k AS intervalo, round(lo + k * w, 6) AS desde, round(lo + k * w + w, 6) AS hasta, count(*) AS cantidad{density}
 FROM (SELECT x, lo, w, least(CAST(floor((x - lo) / w) AS BIGINT), {bins} - 1) AS k, total FROM
 (SELECT x, {lo} AS lo, ({hi} - {lo}) / {bins} AS w, count(x) OVER () AS total FROM ({source})) WHERE x IS NOT NULL) GROUP BY k, lo, w, total"""


@query(
    "mean_rating_histogram", "rides",
    histogram_sql("SELECT avg(rating) AS x FROM rides WHERE vehiculo_id IS NOT NULL GROUP BY vehiculo_id", 7, "1e0", "10e0"),
)
def _(i):
    return rounded(A.mean_rating_histogram(i.rides), "desde", "hasta")


@query(
    "licence_points_histogram", "enriched",
    histogram_sql("SELECT CAST(puntos_carnet AS DOUBLE) AS x FROM enriched", 14, "min(x) OVER ()", "max(x) OVER ()", ", round(count(*) / (total * w), 6) AS densidad"),
)
def _(i):
    return rounded(A.histogram(A.per_ride(i.rides, i.vehicles, "vehiculo_id", "puntos_carnet"), None, 14, density=True), "desde", "hasta", "densidad")


@query(
    "age_histogram", "enriched",
    histogram_sql("SELECT CAST(edad_cliente AS DOUBLE) AS x FROM enriched", 20, "min(x) OVER ()", "max(x) OVER ()"),
)
def _(i):
    return rounded(A.histogram(A.per_ride(i.rides, i.clients, "cliente_id", "edad_cliente"), None, 20), "desde", "hasta")


@query(
    "licence_points_moments", "enriched",
    "SELECT round(avg(puntos_carnet), 6) AS mu, round(stddev_samp(puntos_carnet), 6) AS sigma FROM enriched",
)
def _(i):
    return rounded(i.rides_by_vehicle.agg(F.avg("puntos_carnet").alias("mu"), F.stddev_samp("puntos_carnet").alias("sigma")), "mu", "sigma")


@query(
    "licence_points_gaussian", "enriched",
    """SELECT i AS punto, round(mu + z * sigma, 6) AS x, round(exp(-0.5 * z * z) / (sigma * sqrt(2 * pi())), 6) AS densidad FROM
 (SELECT CAST(i AS INT) AS i, -3e0 + i * 6e0 / 99 AS z, mu, sigma FROM (SELECT unnest(range(100)) AS i),
 (SELECT avg(puntos_carnet) AS mu, stddev_samp(puntos_carnet) AS sigma FROM enriched))""",
)
def _(i):
    return rounded(A.gaussian_curve(i.rides_by_vehicle, "puntos_carnet"), "x", "densidad")


@query(
    "ride_amount_text", "rides",
    "SELECT pedido, linea, format('{:,.2f}€', pago_viaje) AS importe FROM rides",
)
def _(i):
    return i.rides.select("pedido", "linea", money("pago_viaje").alias("importe"))


@query("renamed_payment_columns", "rides", "SELECT cliente_id AS cliente, metodo_pago AS metodo, pago_viaje AS importe FROM rides")
def _(i):
    return i.rides.withColumnsRenamed({"cliente_id": "cliente", "metodo_pago": "metodo", "pago_viaje": "importe"}).select("cliente", "metodo", "importe")
