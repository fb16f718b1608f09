"""Declared schemas of the messages and tables."""

from pyspark.sql import types as T

VEHICLE_MESSAGE = T.StructType([
    T.StructField("viaje_id", T.LongType()),
    T.StructField("vehiculo_id", T.LongType()),
    T.StructField("latitud", T.DoubleType()),
    T.StructField("longitud", T.DoubleType()),
    T.StructField("num_plazas", T.LongType()),
    T.StructField("latitud_final", T.DoubleType()),
    T.StructField("longitud_final", T.DoubleType()),
])

CLIENT_MESSAGE = T.StructType([
    T.StructField("cliente_id", T.LongType()),
    T.StructField("viaje_id", T.LongType()),
    T.StructField("latitud", T.DoubleType()),
    T.StructField("longitud", T.DoubleType()),
    T.StructField("rating", T.LongType()),
    T.StructField("metodo_pago", T.StringType()),
])

# The broker's publish time and a message id travel beside the payload.
ENVELOPE = [T.StructField("ts", T.TimestampType()), T.StructField("event_id", T.LongType())]

RIDES = T.StructType([
    T.StructField("cliente_id", T.LongType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("metodo_pago", T.StringType()),
    T.StructField("pago_viaje", T.DoubleType()),
    T.StructField("viaje_id", T.LongType()),
    T.StructField("vehiculo_id", T.LongType()),
    T.StructField("latitud", T.DoubleType()),
    T.StructField("longitud", T.DoubleType()),
    T.StructField("latitud_final", T.DoubleType()),
    T.StructField("longitud_final", T.DoubleType()),
    T.StructField("timestamp", T.TimestampType()),
])

ROUTE_POINTS = T.StructType([
    T.StructField("viaje_id", T.LongType(), False),
    T.StructField("punto_ruta", T.LongType(), False),
    T.StructField("latitud", T.DoubleType(), False),
    T.StructField("longitud", T.DoubleType(), False),
    T.StructField("altura", T.DoubleType(), False),
    T.StructField("distancia", T.DoubleType(), False),
])

# Names a parsed route uses -> names of the stored table.
ROUTE_COLUMNS = {
    "viaje": "viaje_id",
    "punto": "punto_ruta",
    "latitude": "latitud",
    "longitude": "longitud",
    "altitude": "altura",
}

CLIENTS = T.StructType([
    T.StructField("cliente_id", T.LongType()),
    T.StructField("nombre_cliente", T.StringType()),
    T.StructField("apellido_cliente", T.StringType()),
    T.StructField("dni_cliente", T.StringType()),
    T.StructField("email_cliente", T.StringType()),
    T.StructField("edad_cliente", T.LongType()),
    T.StructField("numero_telefono", T.StringType()),
    T.StructField("direccion_cliente", T.StringType()),
    T.StructField("trabajo_cliente", T.StringType()),
    T.StructField("genero_cliente", T.StringType()),
    T.StructField("fecha_registro", T.TimestampNTZType()),
])

VEHICLES = T.StructType([
    T.StructField("vehiculo_id", T.LongType()),
    T.StructField("nombre_conductor", T.StringType()),
    T.StructField("conductor_id", T.LongType()),
    T.StructField("dni_conductor", T.StringType()),
    T.StructField("marca_coche", T.StringType()),
    T.StructField("color_coche", T.StringType()),
    T.StructField("anio_fabricacion", T.LongType()),
    T.StructField("tipo_combustible", T.StringType()),
    T.StructField("anio_registro_app", T.LongType()),
    T.StructField("tiene_calefaccion", T.BooleanType()),
    T.StructField("puntos_carnet", T.LongType()),
    T.StructField("cilindraje_motor", T.LongType()),
    T.StructField("kilometraje", T.LongType()),
])

# Columns each dimension adds to a ride; identity documents and contact data stay behind.
VEHICLE_ATTRIBUTES = [
    "nombre_conductor", "marca_coche", "color_coche", "anio_fabricacion", "tipo_combustible",
    "tiene_calefaccion", "puntos_carnet", "cilindraje_motor", "kilometraje", "anio_registro_app",
]
CLIENT_ATTRIBUTES = [
    "nombre_cliente", "apellido_cliente", "edad_cliente", "genero_cliente",
    "direccion_cliente", "trabajo_cliente", "fecha_registro",
]
