"""Fare model: relational preparation steps and the ``pyspark.ml`` pipeline."""

from __future__ import annotations

import itertools

from pyspark import keyword_only
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.stat import Summarizer
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfold.session import durable

TARGET = "pago_viaje"
# Columns that are no features.
LEFT_OUT = [
    "pago_viaje", "cliente_id", "longitud", "latitud", "vehiculo_id",
    "nombre_cliente", "apellido_cliente", "nombre_conductor", "direccion_cliente",
]


def feature_columns(schema: T.StructType) -> tuple[list[str], list[str], list[str]]:
    """Numeric, text and boolean features; the target, identifiers, names and times are none."""
    fields = [f for f in schema.fields if f.name not in LEFT_OUT]
    numeric = [f.name for f in fields if isinstance(f.dataType, T.NumericType)]
    text = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    flags = [f.name for f in fields if isinstance(f.dataType, T.BooleanType)]
    return numeric, text, flags


def features(df: DataFrame) -> DataFrame:
    """Features and target; everything else is dropped before any shuffle."""
    numeric, text, flags = feature_columns(df.schema)
    return df.select(*numeric, *text, *flags, TARGET)


# Relational forms: statistics come from ``train`` as a one-row subquery, so nothing reaches the driver.

def impute_mean(df: DataFrame, cols: list[str], train: DataFrame | None = None) -> DataFrame:
    means = (df if train is None else train).agg(F.struct(*[F.avg(c).alias(c) for c in cols]).alias("m")).scalar()
    return df.withColumn("_m", means).withColumns({c: F.coalesce(F.col(c).cast("double"), F.col(f"_m.{c}")) for c in cols}).drop("_m")


def scale_pop(df: DataFrame, cols: list[str], train: DataFrame | None = None) -> DataFrame:
    """Subtract the mean and divide by the population deviation, or by 1 where that is 0."""
    stats = (df if train is None else train).agg(
        F.struct(*[f(c).alias(f"{n}_{c}") for c in cols for n, f in (("m", F.avg), ("s", F.stddev_pop))]).alias("s")
    ).scalar()
    spread = {c: F.when(F.col(f"_s.s_{c}") == 0, F.lit(1.0)).otherwise(F.col(f"_s.s_{c}")) for c in cols}
    return df.withColumn("_s", stats).withColumns({c: (F.col(c) - F.col(f"_s.m_{c}")) / spread[c] for c in cols}).drop("_s")


def modes(df: DataFrame, cols: list[str]) -> DataFrame:
    """Most frequent value per column as text; ties go to the smallest. One pass for all columns."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("columna"), F.col(c).cast("string").alias("valor")) for c in cols])).alias("_x")).select("_x.*")
    tally = long.where(F.col("valor").isNotNull()).groupBy("columna", "valor").agg(F.count(F.lit(1)).alias("n"))
    return tally.groupBy("columna").agg(F.min_by("valor", F.struct(-F.col("n"), "valor")).alias("valor"), F.max("n").alias("veces"))


def impute_mode(df: DataFrame, cols: list[str], train: DataFrame | None = None) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema.fields}
    fill = modes(df if train is None else train, cols).agg(
        F.struct(*[F.max(F.when(F.col("columna") == c, F.col("valor"))).alias(c) for c in cols]).alias("m")
    ).scalar()
    return df.withColumn("_m", fill).withColumns({c: F.coalesce(F.col(c), F.col(f"_m.{c}").cast(types[c])) for c in cols}).drop("_m")


def mse(df: DataFrame, actual: str = TARGET, predicted: str = "prediction") -> DataFrame:
    error = F.col(actual) - F.col(predicted)
    return df.agg(F.avg(error * error).alias("mse"))


def feature_variance(df: DataFrame, cols: list[str]) -> DataFrame:
    """Sample variance per feature, smallest first."""
    one = df.agg(*[F.var_samp(c).alias(c) for c in cols])
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).alias("varianza")) for c in cols])).alias("_x")).select("_x.*").orderBy("varianza", "variable")


class TabularPrep(Estimator):
    """Fits means, population deviations and most frequent values in one pass each and returns a
    ``SQLTransformer`` with those constants, which any session can load again."""

    numeric = Param(Params._dummy(), "numeric", "numeric columns", TypeConverters.toListString)
    text = Param(Params._dummy(), "text", "text columns", TypeConverters.toListString)
    flags = Param(Params._dummy(), "flags", "boolean columns", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, numeric=None, text=None, flags=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> SQLTransformer:
        numeric, text, flags = (self.getOrDefault(p) for p in (self.numeric, self.text, self.flags))
        row = dataset.agg(
            *[F.avg(c).alias(f"m_{c}") for c in numeric],
            # The spread after imputation: filled-in means add rows but no deviation.
            *[F.sqrt(F.var_pop(c) * F.count(c) / F.count(F.lit(1))).alias(f"s_{c}") for c in numeric],
        ).first()
        common = {r["columna"]: r["valor"] for r in modes(dataset, text + flags).collect()} if text or flags else {}
        parts = []
        for c in numeric:
            m, s = row[f"m_{c}"] or 0.0, row[f"s_{c}"] or 1.0
            parts.append(f"(coalesce(CAST(`{c}` AS DOUBLE), {float(m)!r}D) - {float(m)!r}D) / {float(s)!r}D AS `num_{c}`")
        for c in text:
            value = (common.get(c) or "").replace("\\", "\\\\").replace("'", "\\'")
            parts.append(f"coalesce(`{c}`, '{value}') AS `cat_{c}`")
        for c in flags:
            parts.append(f"CAST(coalesce(CAST(`{c}` AS BOOLEAN), {common.get(c) or 'false'}) AS DOUBLE) AS `bool_{c}`")
        return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")


def build_pipeline(schema: T.StructType, seed: int = 42, **tree) -> Pipeline:
    """Imputation and scaling, one-hot coding, assembly and gradient-boosted trees.

    A category not seen in training gets the indexer's extra index, which is the one the encoder
    drops: its block is all zeros.
    """
    numeric, text, flags = feature_columns(schema)
    indexed, hot = [f"ix_{c}" for c in text], [f"hot_{c}" for c in text]
    return Pipeline(stages=[
        TabularPrep(numeric=numeric, text=text, flags=flags),
        StringIndexer(inputCols=[f"cat_{c}" for c in text], outputCols=indexed, handleInvalid="keep"),
        OneHotEncoder(inputCols=indexed, outputCols=hot, dropLast=True, handleInvalid="error"),
        VectorAssembler(inputCols=[f"num_{c}" for c in numeric] + hot + [f"bool_{c}" for c in flags], outputCol="features"),
        GBTRegressor(labelCol=TARGET, featuresCol="features", lossType="squared", seed=seed, **tree),
    ])


# Search grid of the fare model.
GRID = {
    "maxIter": [200, 300, 400],
    "stepSize": [0.01, 0.05, 0.1],
    "maxDepth": [4, 5, 6],
    "subsamplingRate": [0.8, 0.9, 1.0],
    "featureSubsetStrategy": ["0.8", "0.9", "1.0"],
}


def grid_search(
    train: DataFrame, grid: dict | None = None, folds: int = 5, parallelism: int = 4, seed: int = 42, key: list[str] | None = None, **tree,
) -> CrossValidatorModel:
    """Cross-validated search by mean squared error.

    With ``key`` a row's fold hangs on a hash of its key, so it is the same under any partitioning;
    the key is no feature.
    """
    columns = {}
    if key:
        fold = F.pmod(F.xxhash64(*key, F.lit(seed)), F.lit(folds)).cast("int")
        train = train.select(*features(train.drop(*key)).columns, fold.alias("_fold"))
        columns = {"foldCol": "_fold"}
    pipeline = build_pipeline(train.drop("_fold").schema, seed, **tree)
    trees = pipeline.getStages()[-1]
    builder = ParamGridBuilder()
    for name, values in (grid or GRID).items():
        builder = builder.addGrid(trees.getParam(name), values)
    evaluator = RegressionEvaluator(labelCol=TARGET, metricName="mse")
    return CrossValidator(
        estimator=pipeline, estimatorParamMaps=builder.build(), evaluator=evaluator, numFolds=folds, parallelism=parallelism, seed=seed, **columns
    ).fit(train)


def staged_grid_search(train: DataFrame, key: list[str], grid: dict | None = None, folds: int = 5, seed: int = 42) -> list[tuple[dict, list[float]]]:
    """Mean squared error of every setting on every fold, with one fit for all numbers of trees.

    Boosting adds trees one by one, so the model of ``n`` trees is the first ``n`` of a longer one: each combination of the
    other parameters is fitted once per fold with the most trees, and scored after each wanted number of them. The grid of
    243 settings takes 81 fits a fold instead of 243. Preparation is fitted once per fold and written. Folds hang on a hash
    of ``key``.
    """
    grid = dict(grid or GRID)
    trees = sorted(grid.pop("maxIter"))
    names = list(grid)
    fold = F.pmod(F.xxhash64(*key, F.lit(seed)), F.lit(folds))
    rows = durable(train.select(*features(train.drop(*key)).columns, fold.alias("_fold")), "folds")
    found: dict[tuple, list[float]] = {}
    for k in range(folds):
        learn, held = rows.where(F.col("_fold") != k).drop("_fold"), rows.where(F.col("_fold") == k).drop("_fold")
        prepare = Pipeline(stages=build_pipeline(learn.schema, seed).getStages()[:-1]).fit(learn)
        learn, held = (durable(prepare.transform(part).select("features", TARGET), "prepared") for part in (learn, held))
        for setting in itertools.product(*grid.values()):
            grower = GBTRegressor(labelCol=TARGET, featuresCol="features", lossType="squared", seed=seed, maxIter=trees[-1], **dict(zip(names, setting)))
            errors = grower.fit(learn).evaluateEachIteration(held, "squared")
            for n in trees:
                found.setdefault((n, *setting), []).append(errors[n - 1])
    return [(dict(zip(["maxIter", *names], setting)), errors) for setting, errors in found.items()]


def best(model: CrossValidatorModel) -> PipelineModel:
    return model.bestModel


def feature_names(transformed: DataFrame) -> list[str]:
    """Names of the vector's slots, in order, from its metadata."""
    groups = transformed.schema["features"].metadata["ml_attr"]["attrs"].values()
    return [a["name"] for a in sorted((a for g in groups for a in g), key=lambda a: a["idx"])]


def vector_variance(transformed: DataFrame) -> DataFrame:
    """Sample variance of every transformed feature, smallest first."""
    names = feature_names(transformed)
    one = transformed.agg(Summarizer.variance(F.col("features")).alias("v"))
    long = one.select(F.posexplode(vector_to_array("v")).alias("i", "varianza"))
    label = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("i") + 1)
    return long.select(label.alias("variable"), "varianza").orderBy("varianza", "variable")


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# The scoring form's defaults.
SCORING_DEFAULTS = {
    "rating": 8.0, "metodo_pago": "Tarjeta", "viaje_id": 23, "latitud_final": 39.47947, "longitud_final": -0.37594,
    "timestamp": "2024-02-17 11:10:33", "marca_coche": "BMW", "color_coche": "Marrón siena", "anio_fabricacion": 2020,
    "tipo_combustible": "Híbrido", "tiene_calefaccion": True, "puntos_carnet": 11, "cilindraje_motor": 2500, "kilometraje": 42353,
    "anio_registro_app": 2022, "edad_cliente": 48, "genero_cliente": "mujer", "trabajo_cliente": "Parquetero y colocador de suelos",
    "fecha_registro": "2023-09-24",
}


def scoring_frame(spark: SparkSession, rows: list[dict] | None = None) -> DataFrame:
    """A small frame to score; fields left out take the form's defaults.

    Forms send 0 or 1 for yes and no, whole numbers where fractions are possible, and numbers as
    text: values are turned into the field's type, and None stays.
    """
    schema = T.StructType([
        T.StructField(n, T.BooleanType() if isinstance(v, bool) else T.LongType() if isinstance(v, int) else T.DoubleType() if isinstance(v, float) else T.StringType())
        for n, v in SCORING_DEFAULTS.items()
    ])
    def typed(value, like):
        if value is None or isinstance(like, str):
            return value
        if isinstance(like, bool) and isinstance(value, str):
            return value.strip().lower() in ("1", "true", "yes", "on", "sí", "si")
        return type(like)(float(value)) if isinstance(like, int) and not isinstance(like, bool) else type(like)(value)

    data = [tuple(typed({**SCORING_DEFAULTS, **r}[f.name], SCORING_DEFAULTS[f.name]) for f in schema.fields) for r in (rows or [{}])]
    df = spark.createDataFrame(data, schema)
    return df.withColumn("timestamp", F.try_to_timestamp("timestamp", F.lit("yyyy-MM-dd HH:mm:ss"))).withColumn("fecha_registro", F.to_date("fecha_registro"))


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Predicted fare per row; a streaming frame works as well."""
    return model.transform(df).select(*df.columns, F.col("prediction").alias("pago_previsto"))
