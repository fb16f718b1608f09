"""Draws have the distribution they claim and do not depend on partitioning."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayfold.functions import draws as D
from wayfold.operators import sampling, synth

N = 20000


@pytest.fixture(scope="module")
def keys(spark):
    return spark.range(N).withColumnRenamed("id", "k").cache()


def test_uniform(keys):
    x = np.array([r[0] for r in keys.select(D.uniform("k", 1, "a")).collect()])
    assert 0 <= x.min() and x.max() < 1 and abs(x.mean() - 0.5) < 0.01 and abs(x.var() - 1 / 12) < 0.005
    assert keys.select(D.uniform("k", 1, "a").alias("u")).exceptAll(keys.repartition(7).select(D.uniform("k", 1, "a").alias("u"))).isEmpty()


def test_weighted(keys):
    got = {r[0]: r[1] / N for r in keys.groupBy(D.weighted(D.uniform("k", 1, "p"), synth.PAYMENTS, synth.PAYMENT_WEIGHTS)).count().collect()}
    assert all(abs(got[p] - w) < 0.015 for p, w in zip(synth.PAYMENTS, synth.PAYMENT_WEIGHTS))


def test_beta(keys):
    x = np.array([r[0] for r in keys.select(D.beta_int("k", 1, "b", 4, 2, 1, 10)).collect()])
    assert x.min() >= 1 and x.max() <= 10 and abs(x.mean() - (1 + 9 * 4 / 6)) < 0.06


def test_rank_is_a_permutation(keys):
    row = sampling.permute(keys, "k", 3, "n").agg(F.min("n"), F.max("n"), F.count_distinct("n")).first()
    assert tuple(row) == (1, N, N)


@pytest.mark.parametrize("f", [0.0, 0.1, 0.37, 1.0])
def test_exact_fraction(keys, f):
    taken = sampling.sample_frac(keys, "k", f, 5)
    assert taken.count() == round(N * f) == taken.distinct().count()
    n = taken.count()
    assert n == 0 or taken.exceptAll(sampling.sample_n(keys, "k", n, 5)).isEmpty()


def test_split(keys):
    a, b = sampling.split(keys, "k")
    assert a.count() + b.count() == N and abs(a.count() / N - 0.8) < 0.02 and a.intersect(b).isEmpty()


def test_vehicles(spark):
    cars = synth.vehicles(spark, 1000).cache()
    assert cars.count() == cars.select("conductor_id").distinct().count() == 1000
    assert cars.where("anio_fabricacion < 2000 OR anio_fabricacion > 2022 OR anio_registro_app < anio_fabricacion OR anio_registro_app > 2023").isEmpty()
    assert cars.where("tipo_combustible = 'Eléctrico' AND cilindraje_motor <> 0").isEmpty()
    assert cars.where("marca_coche = 'Tesla' AND anio_fabricacion < 2009").isEmpty()
    assert cars.where("kilometraje < 12000 * (2023 - anio_fabricacion) OR kilometraje > 18000 * (2023 - anio_fabricacion)").isEmpty()
    assert {r[0] for r in cars.select("tipo_combustible").distinct().collect()} == {"Gasolina", "Híbrido", "Eléctrico"}


def test_letters_of_all_scripts_keep_their_base(spark):
    import unicodedata

    from wayfold.functions.text import ascii_any_script, strip_accents

    words = ["Dvořák", "Ștefănőć ę š", "ﬁn ½ ㎏ №", "Łódź", "漢字 x", "", None, "José", "".join(chr(c) for c in range(0x80, 0x3000))]
    rows = spark.createDataFrame([(w,) for w in words], "w string").select("w", strip_accents("w").alias("a"), ascii_any_script("w").alias("b")).collect()
    for r in rows:
        plain = None if r.w is None else unicodedata.normalize("NFKD", r.w).encode("ascii", "ignore").decode()
        assert r.a == plain and r.b == plain


def test_each_key_has_its_own_permutation(spark):
    for n in (1, 2, 3, 17, 1000):
        grid = spark.range(n).crossJoin(spark.range(3).toDF("tick"))
        rows = grid.select("tick", "id", D.permuted(F.col("id"), F.lit(n), "tick", 5, "p").alias("x")).collect()
        places = {t: [r.x for r in sorted(rows, key=lambda r: r.id) if r.tick == t] for t in range(3)}
        assert all(sorted(p) == list(range(n)) for p in places.values())
    # Neighbours of one tick are neighbours of another no more often than by chance (about two of a thousand).
    near = [{frozenset((a, b)) for a, b in zip(p, p[1:])} for p in places.values()]
    assert len(near[0] & near[1]) < 15 and len(near[0] & near[2]) < 15
    assert sum(b - a == 1 for a, b in zip(places[0], places[0][1:])) < 15


def test_requests_of_few_ticks_are_drawn_by_all_tasks(spark):
    from wayfold.operators import replay

    points = spark.range(50).select((F.col("id") % 3).alias("viaje_id"), F.col("id").alias("punto_ruta"), (39 + F.col("id") / 1000).alias("latitud"), (F.col("id") / -1000).alias("longitud"))
    clients = spark.range(60).select((F.col("id") + 100).alias("cliente_id"), (F.col("id") + 1).alias("posicion"))
    ticks = spark.range(40).coalesce(1).select(F.col("id").alias("tick"), F.timestamp_seconds(F.lit(1706774400)).alias("start_ts"))
    made = replay.request_batches(points, clients, ticks, 5)
    assert made.count() == 40 * 60 == made.select("tick", "cliente_id").distinct().count()
    # Ticks come in one partition; those that generate rows are as many as the session deals to.
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [tick#" in plan and plan.index("Generate explode") < plan.index("RepartitionByExpression [tick#")
