"""The engine's inputs derived from the supplied tables.

Each view is one SQL text that Spark and the check engine both run. Dimensions are whole; a tenth of
the rides carry keys that no dimension has. All event types are pings of one kind or the other, and
trips, clients and vehicles grow with the users of the event table. Doubles are written with an
exponent because a plain decimal literal would be DECIMAL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VIEWS = {
    "rides": (
        ["lineitem", "orders"],
        """SELECT CASE WHEN o.o_custkey % 10 = 3 THEN o.o_custkey + 1000000000 ELSE o.o_custkey END AS cliente_id, CAST(1 + CAST(l.l_quantity AS INT) % 10 AS DOUBLE) AS rating,
 CASE WHEN o.o_orderkey % 20 < 13 THEN 'Tarjeta' WHEN o.o_orderkey % 20 < 18 THEN 'Efectivo' ELSE 'Bizum' END AS metodo_pago,
 l.l_extendedprice / 1e3 AS pago_viaje, 1 + l.l_orderkey % 38 AS viaje_id, CASE WHEN l.l_suppkey % 10 = 7 THEN l.l_suppkey + 1000000000 ELSE l.l_suppkey END AS vehiculo_id,
 39.43e0 + (l.l_partkey % 800) / 1e4 AS latitud, -0.43e0 + (l.l_orderkey % 1100) / 1e4 AS longitud,
 39.43e0 + (l.l_partkey * 7 % 800) / 1e4 AS latitud_final, -0.43e0 + (l.l_orderkey * 13 % 1100) / 1e4 AS longitud_final,
 l.l_shipdate AS event_ts, l.l_orderkey AS pedido, CAST(l.l_linenumber AS BIGINT) AS linea
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey""",
    ),
    "vehicles": (
        ["supplier"],
        """SELECT s_suppkey AS vehiculo_id, 'Driver#' || CAST(s_suppkey % 60 AS STRING) AS nombre_conductor,
 'Brand#' || CAST(s_suppkey % 20 AS STRING) AS marca_coche, 'Color#' || CAST(s_suppkey % 17 AS STRING) AS color_coche,
 2000 + s_suppkey % 23 AS anio_fabricacion,
 CASE s_suppkey % 3 WHEN 0 THEN 'Gasolina' WHEN 1 THEN 'Híbrido' ELSE 'Eléctrico' END AS tipo_combustible,
 s_suppkey % 2 = 0 AS tiene_calefaccion, 1 + s_suppkey % 15 AS puntos_carnet,
 CASE WHEN s_suppkey % 3 = 2 THEN 0 ELSE 1200 + 400 * (s_suppkey % 8) END AS cilindraje_motor,
 (23 - s_suppkey % 23) * 15000 + s_suppkey % 997 AS kilometraje, 2010 + s_suppkey % 14 AS anio_registro_app
FROM {supplier}""",
    ),
    "clients": (
        ["customer"],
        """SELECT c_custkey AS cliente_id, c_name AS nombre_cliente, 'Apellido' || CAST(c_custkey % 50 AS STRING) AS apellido_cliente,
 15 + c_custkey % 76 AS edad_cliente, CASE c_custkey % 3 WHEN 0 THEN 'hombre' WHEN 1 THEN 'mujer' ELSE 'desconocido' END AS genero_cliente,
 'Calle ' || CAST(c_nationkey AS STRING) AS direccion_cliente, c_mktsegment AS trabajo_cliente,
 DATE '2023-01-01' + CAST(c_custkey % 365 AS INT) AS fecha_registro
FROM {customer}""",
    ),
    "vehicle_pings": (
        ["events"],
        """SELECT event_id, ts, CAST(1 + 3 * floor(user_id / 15e0) + event_id % 3 AS BIGINT) AS viaje_id, 1 + user_id AS vehiculo_id, 1 + event_id % 4 AS num_plazas,
 39.45e0 + (event_id * 37 % 500) / 1e4 AS latitud, -0.40e0 + (event_id * 91 % 600) / 1e4 AS longitud,
 39.45e0 + (event_id * 53 % 500) / 1e4 AS latitud_final, -0.40e0 + (event_id * 71 % 600) / 1e4 AS longitud_final
FROM {events} WHERE event_type IN ('signup', 'error')""",
    ),
    "client_pings": (
        ["events"],
        """SELECT event_id, ts, CAST(1 + 3 * floor(user_id / 15e0) + user_id % 3 AS BIGINT) AS viaje_id, 1 + user_id AS cliente_id,
 39.45e0 + (event_id * 37 % 500) / 1e4 AS latitud, -0.40e0 + (event_id * 91 % 600) / 1e4 AS longitud,
 CAST(1 + event_id % 10 AS DOUBLE) AS rating,
 CASE WHEN event_id % 20 < 13 THEN 'Tarjeta' WHEN event_id % 20 < 18 THEN 'Efectivo' ELSE 'Bizum' END AS metodo_pago
FROM {events} WHERE event_type IN ('view', 'click', 'purchase')""",
    ),
    "route_points": (
        ["events"],
        """SELECT viaje_id, CAST(ROW_NUMBER() OVER (PARTITION BY viaje_id ORDER BY ts, event_id) AS BIGINT) AS punto_ruta,
 39.45e0 + (event_id * 37 % 500) / 1e4 AS latitud, -0.40e0 + (event_id * 91 % 600) / 1e4 AS longitud, 0e0 AS altura
FROM (SELECT CAST(1 + 3 * floor(user_id / 15e0) + event_id % 3 AS BIGINT) AS viaje_id, ts, event_id FROM {events})""",
    ),
}

ENRICHED = """SELECT r.*, v.nombre_conductor, v.marca_coche, v.color_coche, v.anio_fabricacion, v.tipo_combustible,
 v.tiene_calefaccion, v.puntos_carnet, v.cilindraje_motor, v.kilometraje, v.anio_registro_app,
 c.nombre_cliente, c.apellido_cliente, c.edad_cliente, c.genero_cliente, c.direccion_cliente, c.trabajo_cliente, c.fecha_registro
FROM rides r LEFT JOIN vehicles v ON r.vehiculo_id = v.vehiculo_id LEFT JOIN clients c ON r.cliente_id = c.cliente_id"""

WINDOW = "6 hours"
LOCAL_WINDOW = "3 hours"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One derived input as a DataFrame; pings get an instant instead of a wall-clock time."""
    sources, sql = VIEWS[name]
    df = spark.sql(sql, **{s: table(spark, sf_dir, s) for s in sources})
    return df.withColumn("ts", F.col("ts").cast("timestamp")) if "ts" in df.columns else df


def with_views(*names: str, more: str = "") -> str:
    """``WITH`` clause that defines the named inputs (and ``enriched``) for the check engine."""
    parts = []
    for name in names:
        if name == "enriched":
            for base in ("rides", "vehicles", "clients"):
                if base not in names:
                    parts.append(_cte(base))
            parts.append(f"enriched AS ({ENRICHED})")
        else:
            parts.append(_cte(name))
    if more:
        parts.append(more)
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n"


def _cte(name: str) -> str:
    sources, sql = VIEWS[name]
    return f"{name} AS ({sql.format(**{s: s for s in sources})})"
