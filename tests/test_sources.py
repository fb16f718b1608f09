import pytest
from pyspark.sql import functions as F

from wayfold import schemas
from wayfold.sources import tables
from wayfold.sources.messages import decode, to_messages


def points(spark):
    return spark.createDataFrame([(1, 1, 39.4, -0.3, 0.0, 12.5), (1, 2, 39.5, -0.4, 0.0, 0.0)], "viaje int, punto int, latitude double, longitude double, altitude double, distancia double")


def test_create_append_replace(spark):
    tables.ensure_table(spark, "rutas", schemas.ROUTE_POINTS)
    tables.ensure_table(spark, "rutas", schemas.ROUTE_POINTS)
    shuffled = points(spark).select("distancia", "punto", "viaje", "altitude", "longitude", "latitude")
    tables.append(shuffled, "rutas", schemas.ROUTE_POINTS, schemas.ROUTE_COLUMNS)
    tables.append(shuffled, "rutas", schemas.ROUTE_POINTS, schemas.ROUTE_COLUMNS)
    assert tables.scan(spark, "rutas").count() == 4
    assert tables.scan(spark, "rutas", "viaje_id", "latitud").columns == ["viaje_id", "latitud"]
    first = tables.scan(spark, "rutas").where("punto_ruta = 1").first()
    assert (first.latitud, first.longitud, first.distancia) == (39.4, -0.3, 12.5)
    tables.replace(points(spark), "otra")
    tables.replace(points(spark).limit(1), "otra")
    assert tables.scan(spark, "otra").count() == 1


def test_append_needs_table_and_required_values(spark):
    with pytest.raises(ValueError):
        tables.append(points(spark), "falta", schemas.ROUTE_POINTS, schemas.ROUTE_COLUMNS)
    tables.ensure_table(spark, "estricta", schemas.ROUTE_POINTS)
    holed = points(spark).withColumn("latitude", F.lit(None).cast("double"))
    with pytest.raises(Exception, match="latitud is required"):
        tables.append(holed, "estricta", schemas.ROUTE_POINTS, schemas.ROUTE_COLUMNS)


def test_messages_round_trip(spark):
    rows = spark.createDataFrame([(7, 3, 39.4, -0.3, 8, "Bizum")], schemas.CLIENT_MESSAGE)
    valid, bad = decode(to_messages(rows).withColumn("value", F.col("value").cast("binary")), schemas.CLIENT_MESSAGE)
    assert valid.collect() == rows.collect() and bad.isEmpty()


def test_quarantine_names_the_field(spark):
    raw = spark.createDataFrame([('{"cliente_id": 1, "viaje_id": 2}',), ("no json",)], "value string")
    valid, bad = decode(raw, schemas.CLIENT_MESSAGE)
    assert valid.isEmpty()
    assert {r.payload: r.reason for r in bad.collect()} == {
        '{"cliente_id": 1, "viaje_id": 2}': "missing latitud,longitud,rating,metodo_pago", "no json": "unreadable",
    }


def test_a_message_is_parsed_once(spark):
    from wayfold import schemas
    from wayfold.sources import messages

    text = '{"viaje_id":1,"vehiculo_id":2,"latitud":39.4,"longitud":-0.4,"num_plazas":3,"latitud_final":39.5,"longitud_final":-0.3}'
    raw = spark.createDataFrame([(1, text), (2, "{vehiculo"), (3, None), (4, text.replace('"num_plazas":3,', ""))], "event_id long, value string")
    valid, quarantine = messages.decode(raw, schemas.VEHICLE_MESSAGE)
    for part in (valid, quarantine):
        assert part._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
    assert [tuple(r) for r in valid.collect()] == [(1, 2, 39.4, -0.4, 3, 39.5, -0.3, 1)]
    assert {r.event_id: r.reason for r in quarantine.collect()} == {2: "unreadable", 3: "unreadable", 4: "missing num_plazas"}
