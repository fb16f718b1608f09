"""Samples, splits, seeded attributes and replays."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayfold.functions import draws as D
from wayfold.functions.text import ascii_any_script, email, strip_accents
from wayfold.operators import replay, sampling, synth
from wayfold.operators.routes import of_trip
from wayfold.plans.analytics_queries import rounded
from wayfold.plans.registry import query

SEED = 42


# The check engine's forms of the draws.

def u_sql(keys: str, salt: str, seed: int = SEED) -> str:
    return f"(CAST('0x' || substr(md5(concat_ws('|', {keys}, '{seed}', '{salt}')), 1, 8) AS BIGINT) / 4294967296e0)"


def order_sql(keys: str, seed: int = SEED) -> str:
    return f"md5(concat_ws('|', {keys}, '{seed}', 'orden'))"


def int_sql(u: str, low, high) -> str:
    return f"CAST(floor(({low}) + {u} * (({high}) - ({low}) + 1)) AS BIGINT)"


def table_sql(name: str, rows: list[tuple]) -> str:
    """A weighted dictionary with running totals: columns v, lo, hi, total."""
    def lit(v):
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else f"{v}"

    values = ", ".join(f"({k}, {lit(v)}, {w!r}::DOUBLE)" for k, (v, w) in enumerate(rows))
    return f"""{name} AS (SELECT v, coalesce(sum(w) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lo,
 CASE WHEN k = max(k) OVER () THEN 1e9 ELSE sum(w) OVER (ORDER BY k) END AS hi, sum(w) OVER () AS total FROM (VALUES {values}) t(k, v, w))"""


def pick_sql(name: str, u: str) -> str:
    return f"(SELECT v FROM {name} WHERE {u} * total >= lo AND {u} * total < hi)"


def beta_sql(keys: str, salt: str, a: int, b: int, low: int, high: int, seed: int = SEED) -> str:
    us = ", ".join(u_sql(keys, f"{salt}{i}", seed) for i in range(a + b - 1))
    x = f"(list_sort([{us}])[{a}] * {float(high - low)!r}::DOUBLE + {float(low)!r}::DOUBLE)"
    return f"CAST(round_even({x}, 0) AS BIGINT)"


RIDE_KEY = "pedido, linea"
PAY = table_sql("pagos", list(zip(synth.PAYMENTS, synth.PAYMENT_WEIGHTS)))


@query("sample_rows", "rides", f"SELECT pedido, linea, viaje_id, latitud, longitud FROM rides ORDER BY {order_sql(RIDE_KEY)}, pedido, linea LIMIT 200")
def _(i):
    return sampling.sample_n(i.rides.select("pedido", "linea", "viaje_id", "latitud", "longitud"), ["pedido", "linea"], 200, SEED)


TENTH = f"diez AS (SELECT *, row_number() OVER (ORDER BY {order_sql(RIDE_KEY)}, pedido, linea) AS rn, count(*) OVER () AS n FROM rides)"


@query("sample_tenth", "rides", "SELECT pedido, linea, viaje_id, latitud, longitud FROM diez WHERE rn <= round_even(n * 0.1e0, 0)", more=TENTH)
def _(i):
    return sampling.sample_frac(i.rides.select("pedido", "linea", "viaje_id", "latitud", "longitud"), ["pedido", "linea"], 0.1, SEED)


@query("sample_tenth_by_hash", "rides", f"SELECT pedido, linea FROM rides WHERE {u_sql(RIDE_KEY, 'orden')} < 0.1e0")
def _(i):
    return sampling.sample_frac(i.rides.select("pedido", "linea"), ["pedido", "linea"], 0.1, SEED, exact=False)


@query("sampled_clients_of_trip", "rides", "SELECT cliente_id, latitud, longitud FROM diez WHERE rn <= round_even(n * 0.1e0, 0) AND viaje_id = 7", more=TENTH)
def _(i):
    return of_trip(sampling.sample_frac(i.rides, ["pedido", "linea"], 0.1, SEED), 7).select("cliente_id", "latitud", "longitud")


@query("sampled_map_centre", "rides", "SELECT round(avg(latitud), 6) AS latitud_centro, round(avg(longitud), 6) AS longitud_centro FROM diez WHERE rn <= round_even(n * 0.1e0, 0)", more=TENTH)
def _(i):
    from wayfold.operators.routes import centre

    return rounded(centre(sampling.sample_frac(i.rides, ["pedido", "linea"], 0.1, SEED)), "latitud_centro", "longitud_centro")


@query("permuted_ids", "", f"SELECT s_suppkey, row_number() OVER (ORDER BY {order_sql('s_suppkey')}, s_suppkey) AS conductor_id FROM supplier")
def _(i):
    return sampling.permute(i.supplier.select("s_suppkey"), "s_suppkey", SEED, "conductor_id")


@query("permuted_rides", "rides", f"SELECT pedido, linea, row_number() OVER (ORDER BY {order_sql(RIDE_KEY)}, pedido, linea) AS posicion FROM rides")
def _(i):
    return sampling.rank_by_hash(i.rides.select("pedido", "linea"), ["pedido", "linea"], SEED)


@query(
    "train_test_split", "rides",
    f"SELECT pedido, linea, CASE WHEN {u_sql(RIDE_KEY, 'particion')} < 0.8e0 THEN 'train' ELSE 'test' END AS parte FROM rides",
)
def _(i):
    train, test = sampling.split(i.rides.select("pedido", "linea"), ["pedido", "linea"])
    return train.withColumn("parte", F.lit("train")).unionByName(test.withColumn("parte", F.lit("test")))


@query("unique_client_ids", "", f"SELECT c_custkey FROM customer ORDER BY {order_sql('c_custkey')}, c_custkey LIMIT 100")
def _(i):
    return sampling.sample_n(i.customer.select("c_custkey"), "c_custkey", 100, SEED)


# Single draws over customer and supplier keys.

@query("weighted_payment", "", f"SELECT c_custkey, {pick_sql('pagos', 'u')} AS metodo_pago FROM (SELECT c_custkey, {u_sql('c_custkey', 'pago')} AS u FROM customer)", more=PAY)
def _(i):
    return i.customer.select("c_custkey", D.weighted(D.uniform("c_custkey", SEED, "pago"), synth.PAYMENTS, synth.PAYMENT_WEIGHTS).alias("metodo_pago"))


@query(
    "beta_ratings_and_ages", "",
    f"SELECT c_custkey, {beta_sql('c_custkey', 'rating', 4, 2, 1, 10)} AS rating, {beta_sql('c_custkey', 'edad', 2, 5, 15, 90)} AS edad FROM customer",
)
def _(i):
    return i.customer.select(
        "c_custkey", D.beta_int("c_custkey", SEED, "rating", 4, 2, 1, 10).alias("rating"), D.beta_int("c_custkey", SEED, "edad", 2, 5, 15, 90).alias("edad")
    )


@query(
    "integer_draws", "",
    f"SELECT c_custkey, {int_sql(u_sql('c_custkey', 'plazas'), 1, 4)} AS plazas, {int_sql(u_sql('c_custkey', 'anio'), '2000 + c_custkey % 23', 2023)} AS anio FROM customer",
)
def _(i):
    return i.customer.select(
        "c_custkey", D.int_between(D.uniform("c_custkey", SEED, "plazas"), 1, 4).alias("plazas"),
        D.int_between(D.uniform("c_custkey", SEED, "anio"), 2000 + F.col("c_custkey") % 23, F.lit(2023)).alias("anio"),
    )


@query("date_draws", "", f"SELECT c_custkey, DATE '2023-01-01' + CAST(floor({u_sql('c_custkey', 'fecha')} * 425) AS INT) AS fecha FROM customer")
def _(i):
    return i.customer.select("c_custkey", D.date_between(D.uniform("c_custkey", SEED, "fecha"), "2023-01-01", "2024-02-29").alias("fecha"))


@query(
    "coordinate_jitter", "client_pings",
    f"SELECT event_id, round(latitud + (0.001e0 + 0.001e0 * {u_sql('event_id', 'lat')}), 9) AS latitud, round(longitud - (0.001e0 + 0.001e0 * {u_sql('event_id', 'lon')}), 9) AS longitud FROM client_pings",
)
def _(i):
    return i.client_pings.select(
        "event_id", F.round(replay.jitter("latitud", "event_id", SEED, "lat", 1), 9).alias("latitud"), F.round(replay.jitter("longitud", "event_id", SEED, "lon", -1), 9).alias("longitud")
    )


@query(
    "trip_attributes", "route_points",
    f"SELECT viaje_id, punto_ruta, {int_sql(u_sql('viaje_id', 'vehiculo'), 1, 1000)} AS vehiculo_id, {int_sql(u_sql('viaje_id', 'plazas'), 1, 4)} AS num_plazas FROM route_points",
)
def _(i):
    return synth.with_trip_attributes(i.route_points, SEED).select("viaje_id", "punto_ruta", "vehiculo_id", "num_plazas")


# The vehicle dimension, whole and in parts.

BRAND_ROWS = ", ".join(
    f"('{b}', '{f}', {h!r}::DOUBLE, {e}, {synth.FIRST_YEAR_OF.get(b, synth.FIRST_YEAR)})" for b, _, f, h, e in synth.BRANDS
)


def year_sql(name: str, first: int) -> str:
    return table_sql(name, [(y, synth.year_weight(y)) for y in synth.years_of(first)])


CAR = ",\n".join([
    table_sql("marcas", [(b[0], b[1]) for b in synth.BRANDS]), year_sql("anios_2000", 2000), year_sql("anios_2009", 2009),
    table_sql("puntos", list(zip(synth.POINTS, synth.POINT_WEIGHTS))),
    f"datos AS (SELECT * FROM (VALUES {BRAND_ROWS}) t(marca, comb, p, cil, primero))",
    f"""u AS (SELECT s_suppkey AS k, {u_sql('s_suppkey', 'marca')} AS um, {u_sql('s_suppkey', 'anio')} AS ua, {u_sql('s_suppkey', 'combustible')} AS uc,
 {u_sql('s_suppkey', 'registro')} AS ur, {u_sql('s_suppkey', 'calefaccion')} AS uh, {u_sql('s_suppkey', 'puntos')} AS up, {u_sql('s_suppkey', 'cilindraje')} AS ue,
 {u_sql('s_suppkey', 'kilometraje')} AS uk, {u_sql('s_suppkey', 'dni')} AS ud, {u_sql('s_suppkey', 'letra')} AS ul,
 row_number() OVER (ORDER BY {order_sql('s_suppkey')}, s_suppkey) AS conductor_id FROM supplier)""",
    f"c1 AS (SELECT *, {pick_sql('marcas', 'um')} AS marca FROM u)",
    f"""c2 AS (SELECT *, CASE WHEN primero = 2009 THEN {pick_sql('anios_2009', 'ua')} ELSE {pick_sql('anios_2000', 'ua')} END AS anio, string_split(comb, ' o ') AS ops,
 {u_sql('marca', 'marca unica')} < 20e0 / 101 AS unica, {u_sql('marca', 'combustible de marca')} AS ub FROM c1 JOIN datos USING (marca))""",
    "c3 AS (SELECT *, CASE WHEN len(ops) = 1 THEN comb WHEN unica THEN ops[CAST(floor(ub * len(ops)) AS INT) + 1] ELSE ops[CAST(floor(uc * len(ops)) AS INT) + 1] END AS fuel FROM c2)",
    f"""coches AS (SELECT k AS vehiculo_id, conductor_id, lpad(CAST(CAST(floor(ud * 100000000) AS BIGINT) AS VARCHAR), 8, '0') || substr('{synth.LICENCE_LETTERS}', CAST(floor(ul * 23) AS INT) + 1, 1) AS dni_conductor,
 marca AS marca_coche, CAST(anio AS BIGINT) AS anio_fabricacion, fuel AS tipo_combustible, {int_sql('ur', 'anio', 2023)} AS anio_registro_app, uh < p AS tiene_calefaccion,
 CAST({pick_sql('puntos', 'up')} AS BIGINT) AS puntos_carnet, CASE WHEN fuel IN ('Gasolina', 'Híbrido') THEN CAST(cil[CAST(floor(ue * len(cil)) AS INT) + 1] AS BIGINT) ELSE 0 END AS cilindraje_motor,
 {int_sql('uk', 'floor(0.8e0 * ((2023 - anio) * 15000))', 'floor(1.2e0 * ((2023 - anio) * 15000))')} AS kilometraje FROM c3)""",
])


def base_cars(i):
    return i.supplier.select(F.col("s_suppkey").alias("vehiculo_id"))


@query("vehicle_dimension", "", "SELECT * FROM coches", more=CAR)
def _(i):
    return synth.vehicle_attributes(base_cars(i), SEED)


def car_part(name: str, column: str, build):
    @query(name, "", f"SELECT vehiculo_id, {column} FROM coches", more=CAR)
    def _(i):
        return build(base_cars(i)).select("vehiculo_id", column)


KEY = "vehiculo_id"
branded = lambda df: synth.with_brand_facts(synth.with_brand(df, KEY, SEED))
fuelled = lambda df: synth.with_fuel(branded(df), KEY, SEED)
dated = lambda df: synth.with_year(branded(df), KEY, SEED)
car_part("drawn_brand", "marca_coche", lambda df: synth.with_brand(df, KEY, SEED))
car_part("brand_fuel", "tipo_combustible", fuelled)
car_part("drawn_model_year", "anio_fabricacion", dated)
car_part("engine_size", "cilindraje_motor", lambda df: synth.with_engine(fuelled(df), KEY, SEED))
car_part("mileage_by_age", "kilometraje", lambda df: synth.with_mileage(dated(df), KEY, SEED))
car_part("heating_by_brand", "tiene_calefaccion", lambda df: synth.with_heating(branded(df), KEY, SEED))
car_part("driver_licence_id", "dni_conductor", lambda df: synth.with_licence_id(df, KEY, SEED))


@query("brand_to_fuel_lookup", "", "SELECT s_suppkey, marca, comb AS combustibles FROM m LEFT JOIN datos USING (marca)", more=f"""datos AS (SELECT * FROM (VALUES {BRAND_ROWS}) t(marca, comb, p, cil, primero)),
 m AS (SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'Toyota' WHEN 1 THEN 'Volvo' WHEN 2 THEN 'Smart' ELSE 'Tesla' END AS marca FROM supplier)""")
def _(i):
    named = i.supplier.select("s_suppkey", F.element_at(F.array(*[F.lit(b) for b in ("Toyota", "Volvo", "Smart", "Tesla")]), (F.col("s_suppkey") % 4 + 1).cast("int")).alias("marca_coche"))
    return synth.with_brand_facts(named).select("s_suppkey", F.col("marca_coche").alias("marca"), "combustibles")


# Client names and labels.

NAMED = """gente AS (SELECT c_custkey AS cliente_id, CASE c_custkey % 5 WHEN 0 THEN 'José' WHEN 1 THEN 'Núñez' WHEN 2 THEN 'Íñigo' WHEN 3 THEN 'Dvořák' ELSE 'Ștefănőć' END || c_name AS nombre,
 CASE c_custkey % 2 WHEN 0 THEN 'Peña ' ELSE 'Güell ' END || c_mktsegment AS apellido, 'Avenida de la Constitución ' || c_nationkey || ' 3º' AS direccion,
 CASE c_custkey % 7 WHEN 0 THEN 'male' WHEN 1 THEN 'female' WHEN 2 THEN 'unknown' WHEN 3 THEN 'andy' WHEN 4 THEN 'mostly_male' WHEN 5 THEN 'mostly_female' ELSE 'otro' END AS genero FROM customer)"""


def people(i):
    at = lambda options, n: F.element_at(F.array(*[F.lit(o) for o in options]), (F.col("c_custkey") % n + 1).cast("int"))
    return i.customer.select(
        F.col("c_custkey").alias("cliente_id"), F.concat(at(["José", "Núñez", "Íñigo", "Dvořák", "Ștefănőć"], 5), "c_name").alias("nombre"),
        F.concat(at(["Peña ", "Güell "], 2), "c_mktsegment").alias("apellido"),
        F.concat(F.lit("Avenida de la Constitución "), F.col("c_nationkey").cast("string"), F.lit(" 3º")).alias("direccion"),
        at(["male", "female", "unknown", "andy", "mostly_male", "mostly_female", "otro"], 7).alias("genero"),
    )


DROP = "regexp_replace({}, '[^\\x00-\\x7F]', '', 'g')"
PLAIN = "strip_accents({})"


@query("names_without_accents", "", f"SELECT cliente_id, {PLAIN.format('nombre')} AS nombre, {DROP.format('nombre')} AS sin_letra FROM gente", more=NAMED)
def _(i):
    return people(i).select("cliente_id", strip_accents("nombre").alias("nombre"), strip_accents("nombre", "drop").alias("sin_letra"))


@query("names_any_script", "", f"SELECT cliente_id, {PLAIN.format('nombre')} AS nombre FROM gente", more=NAMED)
def _(i):
    return people(i).select("cliente_id", ascii_any_script("nombre").alias("nombre"))


@query(
    "client_email", "",
    f"SELECT cliente_id, lower({PLAIN.format('nombre')}) || '.' || lower({PLAIN.format('apellido')}) || '@redhorn.com' AS email_cliente FROM gente", more=NAMED,
)
def _(i):
    return people(i).select("cliente_id", email(strip_accents("nombre"), strip_accents("apellido"), synth.MAIL_DOMAIN).alias("email_cliente"))


GENDER_SQL = "CASE WHEN genero IN ('male', 'mostly_male') THEN 'hombre' WHEN genero IN ('female', 'mostly_female') THEN 'mujer' WHEN genero IN ('unknown', 'andy') THEN 'desconocido' ELSE genero END"


@query("recoded_gender", "", f"SELECT cliente_id, {GENDER_SQL} AS genero_cliente FROM gente", more=NAMED)
def _(i):
    return people(i).select("cliente_id", synth.recode("genero", synth.GENDERS).alias("genero_cliente"))


@query(
    "client_dimension", "",
    f"""SELECT cliente_id, {PLAIN.format('nombre')} AS nombre_cliente, {PLAIN.format('apellido')} AS apellido_cliente,
 lower({PLAIN.format('nombre')}) || '.' || lower({PLAIN.format('apellido')}) || '@redhorn.com' AS email_cliente, {beta_sql('cliente_id', 'edad', 2, 5, 15, 90, 1000)} AS edad_cliente,
 {DROP.format('direccion')} AS direccion_cliente, {GENDER_SQL} AS genero_cliente, DATE '2023-01-01' + CAST(floor({u_sql('cliente_id', 'fecha', 1000)} * 425) AS INT) AS fecha_registro FROM gente""",
    more=NAMED,
)
def _(i):
    return synth.client_attributes(people(i))


# Replays.

RUNS = f"""carreras AS (SELECT s_suppkey AS run_id, {int_sql(u_sql('s_suppkey', 'viaje'), 1, 38)} AS viaje_id, {int_sql(u_sql('s_suppkey', 'vehiculo'), 1, 1000)} AS vehiculo_id,
 {int_sql(u_sql('s_suppkey', 'plazas'), 1, 4)} AS num_plazas, TIMESTAMP '2024-02-01 08:00:00' + to_seconds(s_suppkey % 3600) AS inicio FROM supplier)"""


def run_frame(i):
    start = F.timestamp_seconds(F.lit(1706774400) + F.col("s_suppkey") % 3600)
    return replay.draw_runs(i.supplier.select(F.col("s_suppkey").alias("run_id"), start.alias("start_ts")), SEED)


@query("drawn_runs", "", "SELECT run_id, viaje_id, vehiculo_id, num_plazas FROM carreras", more=RUNS)
def _(i):
    return run_frame(i).drop("start_ts")


@query(
    "replayed_positions", "route_points",
    """SELECT run_id, c.viaje_id, vehiculo_id, punto_ruta, latitud, longitud, num_plazas,
 first_value(latitud) OVER w AS latitud_final, first_value(longitud) OVER w AS longitud_final, inicio + to_seconds((punto_ruta - 1) * 7) AS ts
 FROM carreras c JOIN route_points r ON c.viaje_id = r.viaje_id WINDOW w AS (PARTITION BY run_id ORDER BY punto_ruta DESC)""",
    more=RUNS,
)
def _(i):
    return replay.replay_routes(i.route_points, run_frame(i)).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def feistel_sql(source: str, x: str) -> str:
    """One pass of the permutation of a tick: ``x`` cut into halves that move each other four times."""
    moves = [("l1", "l0", "r0", "a"), ("r1", "r0", "l1", "b"), ("l2", "l1", "r1", "a"), ("r2", "r1", "l2", "b")]
    text = f"(SELECT *, x0 // b AS l0, x0 % b AS r0 FROM (SELECT tick, posicion, n, a, b, {x} AS x0 FROM {source}))"
    for turn, (out, half, other, size) in enumerate(moves, 1):
        text = f"(SELECT *, ({half} + CAST(floor({u_sql(f'tick, {other}', f'punto{turn}')} * {size}) AS BIGINT)) % {size} AS {out} FROM {text})"
    return f"SELECT tick, posicion, n, a, b, l2 * b + r2 AS x FROM {text}"


N_CLIENTS = 200
KEYS = "c.cliente_id, t.tick"


@query(
    "request_batches", "route_points",
    f"""SELECT t.tick, c.cliente_id, {int_sql(u_sql('c.cliente_id', 'viaje'), 1, 38)} AS viaje_id, round(p.latitud + (0.001e0 + 0.001e0 * {u_sql(KEYS, 'lat')}), 9) AS latitud,
 round(p.longitud - (0.001e0 + 0.001e0 * {u_sql(KEYS, 'lon')}), 9) AS longitud, {beta_sql(KEYS, 'rating', 4, 2, 1, 10)} AS rating,
 (SELECT v FROM pagos WHERE {u_sql(KEYS, 'pago')} * total >= lo AND {u_sql(KEYS, 'pago')} * total < hi) AS metodo_pago, TIMESTAMP '2024-02-01 08:00:00' + to_seconds(t.tick * 3) AS ts
 FROM ticks t, elegidos c JOIN paseo w ON w.tick = t.tick AND w.posicion = c.posicion JOIN orden p ON p.rn = w.x + 1 WHERE w.x < w.n""",
    more=f"""{PAY},
 ticks AS (SELECT s_suppkey AS tick FROM supplier),
 elegidos AS (SELECT c_custkey AS cliente_id, row_number() OVER (ORDER BY {order_sql('c_custkey')}, c_custkey) AS posicion FROM customer QUALIFY posicion <= {N_CLIENTS}),
 orden AS (SELECT latitud, longitud, row_number() OVER (ORDER BY {order_sql('viaje_id, punto_ruta')}, viaje_id, punto_ruta) AS rn, count(*) OVER () AS n FROM route_points),
 red AS (SELECT count(*) AS n, CAST(ceil(sqrt(count(*))) AS BIGINT) AS a, CAST(ceil(count(*) / ceil(sqrt(count(*)))) AS BIGINT) AS b FROM route_points),
 paseo AS ({feistel_sql('ticks, elegidos, red', '(posicion - 1) % n')} UNION ALL {feistel_sql('paseo WHERE x >= n', 'x')})""",
)
def _(i):
    chosen = sampling.rank_by_hash(i.customer.select(F.col("c_custkey").alias("cliente_id")), "cliente_id", SEED).where(F.col("posicion") <= N_CLIENTS)
    ticks = i.supplier.select(F.col("s_suppkey").alias("tick"), F.timestamp_seconds(F.lit(1706774400)).alias("start_ts"))
    # N_CLIENTS rows at most.
    out = replay.request_batches(i.route_points, F.broadcast(chosen), ticks, SEED)
    return out.withColumns({"latitud": F.round("latitud", 9), "longitud": F.round("longitud", 9), "ts": F.col("ts").cast("timestamp_ntz")})
