import random

import pytest
from pyspark.sql import functions as F

from wayfold.operators import model as H
from wayfold.operators.sampling import split
from wayfold.plans.registry import Inputs


@pytest.fixture(scope="module")
def parts(spark, small):
    df = Inputs(spark, small).enriched.withColumn("timestamp", F.current_timestamp())
    train, test = split(df, ["pedido", "linea"])
    drop = ["pedido", "linea", "event_ts"]
    return H.features(train.drop(*drop)).cache(), test.drop(*drop)


@pytest.fixture(scope="module")
def fitted(parts):
    return H.build_pipeline(parts[0].schema, maxIter=3, maxDepth=3).fit(parts[0])


def test_columns_by_type(parts):
    numeric, text, flags = H.feature_columns(parts[1].schema)
    assert "timestamp" not in numeric + text + flags and "fecha_registro" not in numeric + text + flags
    assert flags == ["tiene_calefaccion"] and "metodo_pago" in text and "rating" in numeric
    assert not set(H.LEFT_OUT) & set(numeric + text + flags)


def test_scaled_features(parts, fitted):
    out = fitted.transform(parts[0])
    row = out.agg(F.avg("num_kilometraje").alias("m"), F.stddev_pop("num_kilometraje").alias("s")).first()
    assert row.m == pytest.approx(0, abs=1e-9) and 0 < row.s <= 1 + 1e-9


def test_unknown_category_is_all_zeros(spark, parts, fitted):
    from pyspark.ml.functions import vector_to_array

    out = fitted.transform(H.scoring_frame(spark, [{"genero_cliente": "masculino"}, {"genero_cliente": "mujer"}]))
    sums = [sum(r[0]) for r in out.select(vector_to_array("hot_genero_cliente")).collect()]
    assert sums == [0.0, 1.0]


def test_names_and_variance(parts, fitted):
    out = fitted.transform(parts[0])
    names = H.feature_names(out)
    assert len(names) == len(out.first()["features"]) == len(set(names))
    rows = H.vector_variance(out).collect()
    assert [r.varianza for r in rows] == sorted(r.varianza for r in rows) and len(rows) == len(names)


def test_saved_model_scores_the_same(spark, parts, fitted, tmp_path):
    H.save(fitted, str(tmp_path / "m"))
    again = H.load(str(tmp_path / "m"))
    frame = H.scoring_frame(spark)
    assert H.score(fitted, frame).first()["pago_previsto"] == H.score(again, frame).first()["pago_previsto"]
    assert H.score(again, parts[1]).where("pago_previsto IS NULL").isEmpty()


def test_grid_search(parts):
    found = H.grid_search(parts[0], {"maxIter": [1, 2], "maxDepth": [2]}, folds=2, parallelism=2)
    assert len(found.avgMetrics) == 2
    predicted = H.best(found).transform(parts[1])
    assert H.mse(predicted).first()["mse"] > 0
    total = 1
    for values in H.GRID.values():
        total *= len(values)
    assert total == 243


def test_forms_send_flags_and_whole_numbers(spark):
    from wayfold.operators import model as H

    row = H.scoring_frame(spark, [{"tiene_calefaccion": 0, "rating": 9, "latitud_final": "39.5", "kilometraje": 10.0, "puntos_carnet": None}]).first()
    assert (row.tiene_calefaccion, row.rating, row.latitud_final, row.kilometraje, row.puntos_carnet) == (False, 9.0, 39.5, 10, None)
    assert H.scoring_frame(spark, [{"tiene_calefaccion": "1"}]).first().tiene_calefaccion is True


def test_staged_search_equals_one_fit_for_each_number_of_trees(spark):
    rnd = random.Random(3)
    rows = [(k, float(rnd.randint(1, 10)), rnd.choice("ab"), rnd.random() < 0.5, rnd.random() * 20) for k in range(300)]
    train = spark.createDataFrame(rows, "pedido long, rating double, metodo_pago string, tiene_calefaccion boolean, pago_viaje double")
    found = H.staged_grid_search(train, ["pedido"], {"maxIter": [1, 3], "stepSize": [0.1, 0.5], "maxDepth": [2]}, folds=2)
    assert [s for s, _ in found] == [{"maxIter": n, "stepSize": r, "maxDepth": 2} for r in (0.1, 0.5) for n in (1, 3)]
    single = H.grid_search(train, {"maxIter": [1, 3], "stepSize": [0.1, 0.5], "maxDepth": [2]}, folds=2, key=["pedido"])
    want = {}
    for m, e in zip(single.getEstimatorParamMaps(), single.avgMetrics):
        of = {p.name: v for p, v in m.items()}
        want[of["maxIter"], of["stepSize"]] = e
    for setting, errors in found:
        assert sum(errors) / 2 == pytest.approx(want[setting["maxIter"], setting["stepSize"]], rel=1e-6)


def test_steps_leave_one_table_and_the_settings(spark):
    import glob
    import uuid

    from wayfold.session import TIDY, shared_folder, stepwise

    before, label = spark.conf.get(TIDY, None), uuid.uuid4().hex
    rows = spark.range(100).withColumn("k", F.col("id") % 7)
    totals = rows.groupBy("k").agg(F.sum("id").alias("s"))
    got = stepwise(rows, label, lambda df: df.join(totals, "k"), lambda df: df.where("id < 10"))
    assert sorted(tuple(r) for r in got.select("id", "s").collect()) == [(k, sum(range(k % 7, 100, 7))) for k in range(10)]
    assert len(glob.glob(f"{shared_folder(spark).removeprefix('file:')}/{label}-*")) == 1 and spark.conf.get(TIDY, None) == before


@pytest.mark.parametrize("name", ["fare_predictions", "saved_fare_model"])
def test_a_fit_reads_rides_that_are_joined_once(spark, small, name, monkeypatch):
    from wayfold.plans.registry import QUERIES

    built = []
    whole = H.build_pipeline
    monkeypatch.setattr(H, "build_pipeline", lambda schema, **tree: (built.append(whole(schema, **tree)), built[-1])[1])
    seen, fit = [], H.Pipeline.fit
    monkeypatch.setattr(H.Pipeline, "fit", lambda self, df, *a: (seen.append(df), fit(self, df, *a))[1])
    scored = QUERIES[name](spark, small)
    assert len(built) == 1 and seen
    for df in (*seen, scored):
        assert "Join" not in df._jdf.queryExecution().optimizedPlan().toString()
    whole_rows = split(Inputs(spark, small).enriched, ["pedido", "linea"])[1]
    assert (scored.count() if name == "fare_predictions" else scored.first().filas) == whole_rows.count()
