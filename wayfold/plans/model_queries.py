"""Preparation steps of the fare model, and the model itself."""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from wayfold.operators import model as H
from wayfold.operators.analytics import enrich
from wayfold.operators.sampling import split
from wayfold.plans.analytics_queries import rounded
from wayfold.plans.draw_queries import u_sql
from wayfold.plans.registry import query
from wayfold.session import durable, shared_folder, stepwise
from wayfold.sources import tables

NUMERIC = ["rating", "anio_fabricacion", "puntos_carnet", "cilindraje_motor", "kilometraje", "anio_registro_app", "edad_cliente"]
TEXT = ["metodo_pago", "marca_coche", "tipo_combustible", "genero_cliente", "trabajo_cliente"]
KEY = ["pedido", "linea"]
TRAIN = f"train AS (SELECT * FROM enriched WHERE {u_sql('pedido, linea', 'particion')} < 0.8e0)"


@query(
    "model_features", "enriched",
    """SELECT pago_viaje, rating, metodo_pago, viaje_id, latitud_final, longitud_final, marca_coche, color_coche, anio_fabricacion, tipo_combustible, tiene_calefaccion,
 puntos_carnet, cilindraje_motor, kilometraje, anio_registro_app, edad_cliente, genero_cliente, trabajo_cliente FROM enriched""",
)
def _(i):
    return H.features(i.enriched.drop(*KEY))


@query(
    "mean_imputation", "enriched",
    "SELECT pedido, linea, " + ", ".join(f"round(coalesce(CAST({c} AS DOUBLE), (SELECT avg({c}) FROM train)), 6) AS {c}" for c in NUMERIC) + " FROM enriched",
    more=TRAIN,
)
def _(i):
    # Written once, so that the joins run once for the statistics and the rows.
    rows = durable(i.enriched.select(*KEY, *NUMERIC), "enriched")
    return rounded(H.impute_mean(rows, NUMERIC, split(rows, KEY)[0]), *NUMERIC)


@query(
    "population_scaling", "rides",
    "SELECT pedido, linea, " + ", ".join(f"round(({c} - avg({c}) OVER ()) / CASE WHEN stddev_pop({c}) OVER () = 0 THEN 1 ELSE stddev_pop({c}) OVER () END, 6) AS {c}" for c in ("rating", "pago_viaje", "latitud_final")) + " FROM rides",
)
def _(i):
    cols = ["rating", "pago_viaje", "latitud_final"]
    return rounded(H.scale_pop(i.rides.select(*KEY, *cols), cols), *cols)


MODE = "(SELECT {c} FROM train WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


@query(
    "mode_imputation", "enriched",
    "SELECT pedido, linea, " + ", ".join(f"coalesce({c}, {MODE.format(c=c)}) AS {c}" for c in [*TEXT, "tiene_calefaccion"]) + " FROM enriched",
    more=TRAIN,
)
def _(i):
    cols = [*TEXT, "tiene_calefaccion"]
    rows = durable(i.enriched.select(*KEY, *cols), "enriched")
    return H.impute_mode(rows, cols, split(rows, KEY)[0])


@query(
    "most_frequent_values", "enriched",
    " UNION ALL ".join(
        f"SELECT * FROM (SELECT '{c}' AS columna, CAST({c} AS VARCHAR) AS valor, count(*) AS veces FROM enriched WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY veces DESC, valor LIMIT 1)" for c in TEXT
    ),
)
def _(i):
    return H.modes(i.enriched, TEXT)


@query(
    "mean_squared_error", "rides",
    "SELECT round(avg(power(pago_viaje - m, 2)), 6) AS mse FROM (SELECT pago_viaje, avg(pago_viaje) OVER (PARTITION BY viaje_id) AS m FROM rides)",
)
def _(i):
    means = i.rides.groupBy("viaje_id").agg(F.avg("pago_viaje").alias("prediction"))
    return rounded(H.mse(i.rides.join(means, "viaje_id")), "mse")


@query(
    "feature_variance", "enriched",
    "SELECT variable, round(varianza, 4) AS varianza FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS variable, var_samp({c}) AS varianza FROM enriched" for c in NUMERIC) + ") ORDER BY varianza, variable",
)
def _(i):
    return rounded(H.feature_variance(i.enriched, NUMERIC), "varianza", digits=4)


def prepared(i):
    """Fitted preparation stages, without the trees, over the training rows."""
    train, _ = split(i.enriched, KEY)
    train = H.features(train.drop(*KEY))
    stages = []
    current = train
    for stage in H.build_pipeline(train.schema).getStages()[:-1]:
        fitted = stage.fit(current) if hasattr(stage, "fit") else stage
        current = fitted.transform(current)
        stages.append(fitted)
    return PipelineModel(stages), current


@query("one_hot_width", "enriched", "SELECT " + " + ".join(f"count(DISTINCT {c})" for c in [*TEXT, "color_coche"]) + " + 10 + 1 AS columnas FROM train", more=TRAIN)
def _(i):
    from pyspark.ml.functions import vector_to_array

    return prepared(i)[1].select(F.size(vector_to_array("features")).cast("long").alias("columnas")).distinct()


ALL_NUMERIC = ["rating", "viaje_id", "latitud_final", "longitud_final", *NUMERIC[1:]]
ALL_TEXT = ["metodo_pago", "marca_coche", "color_coche", "tipo_combustible", "genero_cliente", "trabajo_cliente"]
FILLED = "lleno AS (SELECT " + ", ".join(
    [f"coalesce(CAST({c} AS DOUBLE), (SELECT avg({c}) FROM train)) AS {c}" for c in ALL_NUMERIC]
    + [f"coalesce({c}, {MODE.format(c=c)}) AS {c}" for c in [*ALL_TEXT, "tiene_calefaccion"]]
) + " FROM train)"
SLOTS = " UNION ALL ".join(
    [f"SELECT 'num_{c}' AS variable, var_samp({c}) / var_pop({c}) AS varianza FROM lleno" for c in ALL_NUMERIC]
    + [f"SELECT 'hot_{c}_' || {c} AS variable, (n * 1e0 / t) * (1 - n * 1e0 / t) * t / (t - 1) AS varianza FROM (SELECT {c}, count(*) AS n, (SELECT count(*) FROM lleno) AS t FROM lleno GROUP BY {c})" for c in ALL_TEXT]
    + ["SELECT 'bool_tiene_calefaccion' AS variable, var_samp(CAST(tiene_calefaccion AS INT)) AS varianza FROM lleno"]
)


@query("transformed_feature_variance", "enriched", f"SELECT variable, round(varianza, 6) AS varianza FROM ({SLOTS})", more=f"{TRAIN},\n{FILLED}")
def _(i):
    return rounded(H.vector_variance(prepared(i)[1]), "varianza")


@query("transformed_feature_names", "enriched", f"SELECT variable FROM ({SLOTS})", more=f"{TRAIN},\n{FILLED}")
def _(i):
    names = H.feature_names(prepared(i)[1])
    return i.spark.createDataFrame([(n,) for n in names], "variable string")


def modelled(i):
    """Keys, features and fare of all rides, written once, so that neither the many passes of a fit nor scoring joins again.

    The rides take on clients and vehicles in steps, the wider dimension last, since every join deals out all rows anew.
    """
    columns = [*KEY, *H.features(i.enriched.drop(*KEY)).columns]
    known = lambda rows: [c for c in (*columns, "vehiculo_id") if c in rows.columns]
    return stepwise(
        i.rides.select(*known(i.rides), "cliente_id"), "modelled",
        lambda rows: (joined := enrich(rows, clients=i.clients)).select(*known(joined)),
        lambda rows: enrich(rows, vehicles=i.vehicles).select(*columns),
    )


@query("fare_predictions")
def _(i):
    """Train on the training rows, predict the test rows."""
    train, test = split(modelled(i), KEY)
    rows = H.features(train.drop(*KEY))
    fitted = H.build_pipeline(rows.schema, maxIter=5, maxDepth=3).fit(rows)
    return H.score(fitted, test).select(*KEY, "pago_viaje", "pago_previsto")


@query(
    "saved_fare_model", "enriched",
    f"SELECT count(*) AS filas, count(*) AS previstas, count(*) AS iguales FROM enriched WHERE NOT ({u_sql('pedido, linea', 'particion')} < 0.8e0)",
)
def _(i):
    """Train, save and load, and score the test rows with both: all get a fare, and the same one."""
    train, test = split(modelled(i), KEY)
    rows = H.features(train.drop(*KEY))
    path = f"{shared_folder(i.spark)}/model-{uuid.uuid4().hex}"
    fitted = H.build_pipeline(rows.schema, maxIter=5, maxDepth=3).fit(rows)
    H.save(fitted, path)
    both = H.score(H.load(path), H.score(fitted, test).withColumnRenamed("pago_previsto", "antes"))
    same = F.count(F.when(F.col("antes") == F.col("pago_previsto"), 1))
    return both.agg(F.count(F.lit(1)).alias("filas"), F.count("pago_previsto").alias("previstas"), same.alias("iguales"))


@query("fare_grid_search")
def _(i):
    """Cross-validated error of each setting of a small grid; every number of trees is read off one fit."""
    train, _ = split(i.enriched, KEY)
    grid = {"maxIter": [2, 4, 6], "stepSize": [0.05, 0.1], "maxDepth": [3]}
    rows = [(s["maxIter"], s["stepSize"], s["maxDepth"], sum(errors) / len(errors)) for s, errors in H.staged_grid_search(train, KEY, grid, folds=2)]
    return i.spark.createDataFrame(rows, "max_iter long, step_size double, max_depth long, mse double")


@query(
    "streamed_fare_predictions", "enriched",
    f"SELECT count(*) AS filas, count(*) AS previstas, count(*) AS iguales FROM enriched WHERE NOT ({u_sql('pedido, linea', 'particion')} < 0.8e0)",
)
def _(i):
    """A saved model scores rides as they arrive and appends the fares to a table that was written anew with its declared schema."""
    train, test = split(i.enriched, KEY)
    rows, folder = H.features(train.drop(*KEY)), f"{shared_folder(i.spark)}/scored-{uuid.uuid4().hex}"
    H.save(H.build_pipeline(rows.schema, maxIter=3, maxDepth=3).fit(rows), f"{folder}/model")
    test.write.parquet(f"{folder}/rides")
    arriving = i.spark.readStream.schema(test.schema).option("maxFilesPerTrigger", 4).parquet(f"{folder}/rides")
    scored = H.score(H.load(f"{folder}/model"), arriving).select(*KEY, "pago_previsto")
    name = f"fares_{uuid.uuid4().hex}"
    tables.ensure_table(i.spark, name, scored.schema, path=f"{folder}/fares")
    tables.replace(i.spark.createDataFrame([], scored.schema), name, scored.schema)
    tables.start_append_stream(scored, name, f"{folder}/checkpoint", scored.schema).awaitTermination()
    stored = durable(i.spark.read.table(name), "fares")
    i.spark.sql(f"DROP TABLE {name}")
    batch = H.score(H.load(f"{folder}/model"), i.spark.read.schema(test.schema).parquet(f"{folder}/rides")).select(*KEY, "pago_previsto")
    # Keys repeat, so both sides are compared as bags of (key, fare).
    fares = [*KEY, "pago_previsto"]
    counts = [df.groupBy(*fares).agg(F.count(F.lit(1)).alias(n)) for df, n in ((batch, "antes"), (stored, "ahora"))]
    met = counts[0].join(counts[1], fares, "full")
    return met.agg(
        F.sum("antes").alias("filas"), F.sum(F.when(F.col("pago_previsto").isNotNull(), F.col("ahora"))).alias("previstas"), F.sum(F.least("antes", "ahora")).alias("iguales"),
    )
