"""Seeded vehicle and client dimensions built as table jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfold.functions import draws as D
from wayfold.functions.text import email, recode, strip_accents
from wayfold.operators.sampling import permute, sample_n

# Brand, relative weight, fuel, probability of heating, engine sizes.
BRANDS = [
    ("Toyota", 0.12, "Híbrido", 0.2, [1200, 1500, 1800, 2500]),
    ("Honda", 0.1, "Híbrido", 0.3, [1300, 1600, 2000, 2500]),
    ("Ford", 0.1, "Gasolina", 0.4, [1500, 2000, 2500, 3000]),
    ("Chevrolet", 0.08, "Gasolina", 0.4, [1400, 1800, 2200, 3000]),
    ("Volkswagen", 0.08, "Gasolina", 0.4, [1200, 1600, 2000, 2500]),
    ("BMW", 0.07, "Eléctrico o Híbrido", 0.8, [1600, 2000, 2500, 3000]),
    ("Mercedes-Benz", 0.06, "Híbrido", 0.9, [1800, 2200, 2500, 3000]),
    ("Audi", 0.05, "Eléctrico o Híbrido", 0.8, [1600, 2000, 2500, 3000]),
    ("Nissan", 0.05, "Eléctrico", 0.3, [1200, 1500, 1800, 2500]),
    ("Hyundai", 0.04, "Híbrido", 0.5, [1200, 1500, 1800, 2500]),
    ("Kia", 0.04, "Híbrido", 0.5, [1300, 1600, 2000, 2500]),
    ("Mazda", 0.03, "Gasolina", 0.3, [1200, 1500, 1800, 2500]),
    ("Volvo", 0.03, "Híbrido o Eléctrico", 0.8, [1800, 2200, 2500, 3000]),
    ("Tesla", 0.02, "Eléctrico", 0.9, [0]),
    ("Porsche", 0.02, "Híbrido", 0.9, [2500, 3000, 3500, 4000]),
    ("Subaru", 0.02, "Gasolina", 0.4, [1500, 1800, 2000, 2500]),
    ("Jeep", 0.02, "Gasolina", 0.6, [1800, 2200, 2500, 3000]),
    ("Fiat", 0.01, "Gasolina", 0.3, [1200, 1400, 1600, 2000]),
    ("Jaguar", 0.01, "Eléctrico o Híbrido", 0.8, [1800, 2200, 2500, 3000]),
    ("Land Rover", 0.01, "Gasolina", 0.9, [1800, 2200, 2500, 3000]),
    ("Lexus", 0.01, "Híbrido", 0.7, [2000, 2500, 3000, 3500]),
    ("MINI", 0.01, "Gasolina", 0.5, [1200, 1400, 1600, 2000]),
    ("Alfa Romeo", 0.01, "Gasolina", 0.7, [1600, 1800, 2000, 2500]),
    ("Mitsubishi", 0.01, "Gasolina", 0.4, [1200, 1500, 1800, 2500]),
    ("Buick", 0.008, "Gasolina", 0.6, [1800, 2000, 2500, 3000]),
    ("Cadillac", 0.008, "Gasolina", 0.7, [2000, 2500, 3000, 3500]),
    ("Chrysler", 0.008, "Gasolina", 0.4, [1800, 2000, 2500, 3000]),
    ("Dodge", 0.008, "Gasolina", 0.5, [2000, 2500, 3000, 3500]),
    ("Ram", 0.008, "Gasolina", 0.6, [2000, 2500, 3000, 3500]),
    ("GMC", 0.008, "Gasolina", 0.6, [2000, 2500, 3000, 3500]),
    ("Acura", 0.007, "Gasolina", 0.7, [1600, 2000, 2500, 3000]),
    ("Infiniti", 0.007, "Gasolina", 0.7, [2000, 2500, 3000, 3500]),
    ("Lincoln", 0.006, "Gasolina", 0.6, [2000, 2500, 3000, 3500]),
    ("Bentley", 0.002, "Gasolina", 0.9, [4000, 5000, 6000, 7000]),
    ("Bugatti", 0.001, "Gasolina", 0.9, [6000, 8000, 10000, 12000]),
    ("Ferrari", 0.001, "Gasolina", 0.9, [4000, 5000, 6000, 7000]),
    ("Lamborghini", 0.001, "Gasolina", 0.9, [5000, 6000, 7000, 8000]),
    ("Maserati", 0.001, "Gasolina", 0.8, [3000, 4000, 5000, 6000]),
    ("McLaren", 0.001, "Gasolina", 0.8, [4000, 5000, 6000, 7000]),
    ("Rolls-Royce", 0.001, "Gasolina", 0.9, [4000, 5000, 6000, 7000]),
]

# First model year (one brand starts later), year of reference, share of brands whose
# fuel alternatives collapse to one (20 of 101), kilometres per year, licence letters.
FIRST_YEAR = 2000
FIRST_YEAR_OF = {"Tesla": 2009}
THIS_YEAR = 2023
COLLAPSE_SHARE = 20 / 101
KM_PER_YEAR = 15000
LICENCE_LETTERS = "TRWAGMYFPDXBNJZSQVHLCKE"

# Licence points and payment methods with their weights.
POINTS = [15, 14, 13, 12, 11, 10, 9, 8, 7, 6, 5, 4, 3, 2, 1]
POINT_WEIGHTS = [0.15, 0.11, 0.1, 0.1, 0.1, 0.06, 0.06, 0.06, 0.06, 0.06, 0.05, 0.04, 0.03, 0.02, 0.01]
PAYMENTS = ["Tarjeta", "Efectivo", "Bizum"]
PAYMENT_WEIGHTS = [0.65, 0.25, 0.10]

# Gender labels, mail domain.
GENDERS = {
    "male": "hombre",
    "female": "mujer",
    "unknown": "desconocido",
    "andy": "desconocido",
    "mostly_male": "hombre",
    "mostly_female": "mujer",
}
MAIL_DOMAIN = "redhorn.com"


def year_weight(year: int) -> float:
    return 1 / (THIS_YEAR - year + 1) ** 1.5


def years_of(first: int) -> list[int]:
    """Drawable model years; the reference year itself is never drawn."""
    return list(range(first, THIS_YEAR))


def brand_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(b, f, h, e, FIRST_YEAR_OF.get(b, FIRST_YEAR)) for b, _, f, h, e in BRANDS],
        "marca_coche string, combustibles string, p_calefaccion double, cilindrajes array<long>, primer_anio long",
    )


def with_brand(df: DataFrame, key: str, seed: int) -> DataFrame:
    return df.withColumn("marca_coche", D.weighted(D.uniform(key, seed, "marca"), [b[0] for b in BRANDS], [b[1] for b in BRANDS]))


def with_brand_facts(df: DataFrame) -> DataFrame:
    """Attach the dictionary of the brand; NULLs for a brand it does not list. Forty rows, broadcast."""
    return df.join(F.broadcast(brand_table(df.sparkSession)), "marca_coche", "left")


def with_fuel(df: DataFrame, key: str, seed: int) -> DataFrame:
    """One fuel. Where a brand lists alternatives, a few brands settle on one for all their cars;
    otherwise each car picks its own. A brand's decision hangs on its name, so no join is needed."""
    options = F.split("combustibles", " o ")
    for_brand = D.choice(D.uniform("marca_coche", seed, "combustible de marca"), options)
    for_car = D.choice(D.uniform(key, seed, "combustible"), options)
    collapses = D.uniform("marca_coche", seed, "marca unica") < COLLAPSE_SHARE
    mixed = F.col("combustibles").contains(" o ")
    return df.withColumn(
        "tipo_combustible", F.when(mixed & collapses, for_brand).when(mixed, for_car).otherwise(F.col("combustibles"))
    )


def with_year(df: DataFrame, key: str, seed: int) -> DataFrame:
    u = D.uniform(key, seed, "anio")
    pick = None
    for first in sorted({FIRST_YEAR, *FIRST_YEAR_OF.values()}):
        years = years_of(first)
        drawn = D.weighted(u, years, [year_weight(y) for y in years])
        test = F.col("primer_anio") == first
        pick = F.when(test, drawn) if pick is None else pick.when(test, drawn)
    return df.withColumn("anio_fabricacion", pick.cast("long"))


def with_engine(df: DataFrame, key: str, seed: int) -> DataFrame:
    burns = F.col("tipo_combustible").isin("Gasolina", "Híbrido")
    return df.withColumn(
        "cilindraje_motor", F.when(burns, D.choice(D.uniform(key, seed, "cilindraje"), F.col("cilindrajes"))).otherwise(F.lit(0)).cast("long")
    )


def with_mileage(df: DataFrame, key: str, seed: int) -> DataFrame:
    base = (F.lit(THIS_YEAR) - F.col("anio_fabricacion")) * KM_PER_YEAR
    return df.withColumn(
        "kilometraje", D.int_between(D.uniform(key, seed, "kilometraje"), F.floor(base * 0.8), F.floor(base * 1.2))
    )


def with_licence_id(df: DataFrame, key: str, seed: int) -> DataFrame:
    """Eight digits and a letter drawn at random (not a check letter)."""
    digits = F.floor(D.uniform(key, seed, "dni") * 100000000).cast("long")
    letter = F.substring(F.lit(LICENCE_LETTERS), (F.floor(D.uniform(key, seed, "letra") * len(LICENCE_LETTERS)) + 1).cast("int"), F.lit(1))
    return df.withColumn("dni_conductor", F.concat(F.lpad(digits.cast("string"), 8, "0"), letter))


def with_heating(df: DataFrame, key: str, seed: int) -> DataFrame:
    return df.withColumn("tiene_calefaccion", D.bernoulli(D.uniform(key, seed, "calefaccion"), F.col("p_calefaccion")))


def vehicle_attributes(base: DataFrame, seed: int, key: str = "vehiculo_id") -> DataFrame:
    """All drawn attributes for a frame of vehicle ids (and any columns the caller supplies, such
    as driver names and colours)."""
    df = permute(base, key, seed, "conductor_id")
    df = with_licence_id(df, key, seed)
    df = with_brand_facts(with_brand(df, key, seed))
    df = with_fuel(with_year(df, key, seed), key, seed)
    df = df.withColumn(
        "anio_registro_app", D.int_between(D.uniform(key, seed, "registro"), F.col("anio_fabricacion"), F.lit(THIS_YEAR))
    )
    df = with_heating(df, key, seed)
    df = df.withColumn("puntos_carnet", D.weighted(D.uniform(key, seed, "puntos"), POINTS, POINT_WEIGHTS).cast("long"))
    df = with_mileage(with_engine(df, key, seed), key, seed)
    return df.drop("combustibles", "p_calefaccion", "cilindrajes", "primer_anio")


def vehicles(spark: SparkSession, n: int = 1000, seed: int = 42) -> DataFrame:
    return vehicle_attributes(spark.range(1, n + 1).withColumnRenamed("id", "vehiculo_id"), seed)


def client_attributes(people: DataFrame, seed: int = 1000, end: str = "2024-02-29", key: str = "cliente_id") -> DataFrame:
    """Derived client columns from supplied ``nombre``, ``apellido``, ``direccion`` and ``genero``
    (the label a name dictionary gave)."""
    first, last = strip_accents("nombre"), strip_accents("apellido")
    return people.select(
        *[c for c in people.columns if c not in ("nombre", "apellido", "direccion", "genero")],
        first.alias("nombre_cliente"), last.alias("apellido_cliente"), email(first, last, MAIL_DOMAIN).alias("email_cliente"),
        D.beta_int(key, seed, "edad", 2, 5, 15, 90).alias("edad_cliente"),
        strip_accents("direccion", "drop").alias("direccion_cliente"),
        recode("genero", GENDERS).alias("genero_cliente"),
        D.date_between(D.uniform(key, seed, "fecha"), "2023-01-01", end).alias("fecha_registro"),
    )


def unique_ids(spark: SparkSession, n: int, upper: int, seed: int) -> DataFrame:
    """n different ids of 1..upper."""
    return sample_n(spark.range(1, upper + 1).withColumnRenamed("id", "cliente_id"), "cliente_id", n, seed)


def with_trip_attributes(points: DataFrame, seed: int) -> DataFrame:
    """One vehicle id and seat count per trip on all its rows: the draw hangs on the trip id, so
    nothing is shuffled."""
    return points.withColumns({
        "vehiculo_id": D.int_between(D.uniform("viaje_id", seed, "vehiculo"), 1, 1000),
        "num_plazas": D.int_between(D.uniform("viaje_id", seed, "plazas"), 1, 4),
    })
