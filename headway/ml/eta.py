"""Correction of predicted arrivals: features known when the prediction was made, baselines, model, fallback."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.constants import AGENCY_TZ, GRAIN, HORIZON_MAX_S
from headway.functions.expressions import lead_bucket, local

FEATURES = ("horizon_s", "hour", "dow", "stop_sequence_f", "agency_delay_s", "agency_delay_known", "uncertainty", "uncertainty_known", "direction_id", "n_stops_in_update")
SENTINEL = -99_999.0
FLOOR = 50


def features(predictions: DataFrame, arrivals: DataFrame, tz: str = AGENCY_TZ) -> DataFrame:
    """A row for each prediction with an arrival, made before it and no more than an hour ahead; residual_s is what the
    arrival came later than foretold. The horizon is to the predicted time: the lead to the actual one would leak it."""
    optional = {"agency_delay_s": "double", "uncertainty": "double", "direction_id": "double", "n_stops_in_update": "double", "route_id": "string"}
    p = predictions.select(*GRAIN, "issued", "predicted", *[F.col(c).cast(t).alias(c) if c in predictions.columns else F.lit(None).cast(t).alias(c) for c, t in optional.items()])
    a = arrivals.select(*GRAIN, "actual").distinct()
    at = local(F.timestamp_seconds("issued"), tz)
    out = p.join(a, list(GRAIN)).withColumn("horizon_s", F.col("predicted") - F.col("issued"))
    out = out.where((F.col("issued") < F.col("actual")) & F.col("horizon_s").between(1, HORIZON_MAX_S))
    known = lambda c: F.col(c).isNotNull().cast("int")
    return out.withColumns({"hour": F.hour(at), "dow": F.weekday(at), "stop_sequence_f": F.col("stop_sequence").cast("double"), "agency_delay_known": known("agency_delay_s"), "uncertainty_known": known("uncertainty"), "residual_s": F.col("actual") - F.col("predicted")})


def temporal_split(df: DataFrame, test: float = 0.25) -> tuple[DataFrame, DataFrame]:
    """(train, test): all that was issued before a time, and the rest; no prediction of a time is in both."""
    cut = df.agg(F.expr(f"percentile_disc({1 - test}) within group (order by issued)").alias("_cut"))
    marked = df.join(F.broadcast(cut))  # one row
    return marked.where("issued < _cut").drop("_cut"), marked.where("issued >= _cut").drop("_cut")


def degenerate(train: DataFrame, test: DataFrame, columns: list[str], few: int = 12) -> DataFrame:
    """(feature, reason): features that are all null, constant, or of few values with some unseen in training."""
    stats = train.agg(*[x for c in columns for x in (F.count(c).alias(f"n_{c}"), F.countDistinct(c).alias(f"d_{c}"))])
    rows = stats.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"n_{c}").alias("n"), F.col(f"d_{c}").alias("d")) for c in columns])).alias("s")).select("s.*")
    unseen = None
    for c in columns:
        x = test.select(F.col(c).cast("double").alias("v")).where("v is not null").distinct().join(train.select(F.col(c).cast("double").alias("v")).distinct(), "v", "left_anti").agg(F.lit(c).alias("feature"), F.count(F.lit(1)).alias("unseen"))
        unseen = x if unseen is None else unseen.unionAll(x)
    reason = F.when(F.col("n") == 0, "all null").when(F.col("d") <= 1, "constant").when((F.col("d") <= few) & (F.col("unseen") > 0), "unseen values")
    return rows.join(unseen, "feature").select("feature", reason.alias("reason")).where("reason is not null")


def metrics(df: DataFrame, error: Column, by: list[str] = ()) -> DataFrame:
    """n, MAE, RMSE, bias, interpolated p90 and shares within one and three minutes."""
    e = df.withColumn("_e", error.cast("double"))
    size = F.abs("_e")
    return e.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.avg(size).alias("mae"), F.sqrt(F.avg(F.col("_e") * F.col("_e"))).alias("rmse"), F.avg("_e").alias("bias"), F.expr("percentile(abs(_e), 0.9)").alias("p90"), (100 * F.avg((size <= 60).cast("int"))).alias("pct_60s"), (100 * F.avg((size <= 180).cast("int"))).alias("pct_180s"))


def baselines(train: DataFrame, test: DataFrame) -> DataFrame:
    """test with what each baseline foretells of the residual: nothing, the mean, the horizon bucket's mean."""
    b = lambda df: df.withColumn("bucket", lead_bucket(F.col("horizon_s")))
    means = b(train).groupBy("bucket").agg(F.avg("residual_s").alias("by_bucket"))
    mean = train.agg(F.avg("residual_s").alias("by_mean"))
    out = b(test).join(F.broadcast(means), "bucket", "left").join(F.broadcast(mean))  # five rows; one row
    return out.withColumns({"by_agency": F.lit(0.0), "by_bucket": F.coalesce("by_bucket", "by_mean")})


def assemble(df: DataFrame, columns: list[str]) -> DataFrame:
    """Nulls become a sentinel next to their _known flag: trees part it from any value."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(SENTINEL)) for c in columns})


def train_model(train: DataFrame, columns: list[str], iterations: int = 100, depth: int = 6, step: float = 0.08) -> PipelineModel:
    """The indexer sees training routes alone; routes it hasn't seen share one code."""
    stages = [StringIndexer(inputCol="route_id", outputCol="route_code", stringOrderType="alphabetAsc", handleInvalid="keep"), VectorAssembler(inputCols=[*columns, "route_code"], outputCol="features"), GBTRegressor(featuresCol="features", labelCol="residual_s", predictionCol="residual_hat", maxIter=iterations, maxDepth=depth, stepSize=step, minInstancesPerNode=50, maxBins=64, seed=7)]
    return Pipeline(stages=stages).fit(assemble(train.fillna({"route_id": "none"}), columns))


def predict(model: PipelineModel, df: DataFrame, columns: list[str]) -> DataFrame:
    return model.transform(assemble(df.fillna({"route_id": "none"}), columns))


def correct(df: DataFrame, gate: bool) -> DataFrame:
    """corrected: the agency's time plus the rounded residual, or unchanged where the model lost to a baseline, has no
    answer, or the horizon is out of range; source says which."""
    ok = F.lit(gate) & F.col("residual_hat").isNotNull() & F.col("horizon_s").between(1, HORIZON_MAX_S)
    return df.withColumns({"corrected": F.when(ok, F.col("predicted") + F.round("residual_hat").cast("long")).otherwise(F.col("predicted")), "source": F.when(ok, "model").otherwise("agency")})


def baseline_gate(scored: DataFrame) -> bool:
    """Whether the model's mean error is below each baseline's."""
    error = lambda c: F.avg(F.abs(F.col("residual_s") - F.col(c)))
    mae = scored.agg(error("residual_hat").alias("model"), *[error(b).alias(b) for b in BASELINES]).first()
    return mae.model is not None and mae.model < min(mae[b] for b in BASELINES)


BASELINES = ("by_agency", "by_mean", "by_bucket")


def save(model: PipelineModel, gate: bool, columns: list[str], path: str) -> None:
    """The model with its gate and features, as one artefact."""
    spark = SparkSession.getActiveSession()
    model.write().overwrite().save(f"{path}/model")
    spark.createDataFrame([(gate, list(columns))], "gate boolean, columns array<string>").coalesce(1).write.mode("overwrite").json(f"{path}/gate")


def load(path: str) -> tuple[PipelineModel | None, bool, list[str]]:
    """What save wrote; (None, False, []) if there is no artefact."""
    spark = SparkSession.getActiveSession()
    try:
        row = spark.read.schema("gate boolean, columns array<string>").json(f"{path}/gate").first()
        return PipelineModel.load(f"{path}/model"), row.gate, row.columns
    except AnalysisException:
        return None, False, []


def serve(df: DataFrame, path: str) -> DataFrame:
    """df corrected by the artefact at path; unchanged where there is none, or its gate is shut."""
    model, gate, columns = load(path)
    if model is None:
        return correct(df.withColumn("residual_hat", F.lit(None).cast("double")), False)
    return correct(predict(model, df, columns), gate)
