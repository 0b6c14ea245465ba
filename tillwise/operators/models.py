"""Sales forecast and customer clusters with Spark ML."""

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tillwise.constants import (
    CLUSTER_LABELS,
    CLUSTERS,
    CUSTOMER_FEATURES,
    FORECAST_DAYS,
    FORECAST_FEATURES,
    FOREST_TREES,
    SEED,
    TRAIN_PERCENT,
)
from tillwise.functions import money
from tillwise.functions.scalars import table_wide
from tillwise.operators.evaluate import regression_metrics
from tillwise.operators.features import LONG_LAG, SHORT_LAG


def in_training(day: Column, percent: int = TRAIN_PERCENT, seed: int = SEED) -> Column:
    """Split by a hash of the day: the same days on any cluster and partitioning."""
    return F.pmod(F.xxhash64(day, F.lit(seed)), F.lit(100)) < percent


def train_forecast(
    features: DataFrame, trees: int = FOREST_TREES, partitions: int = 8
) -> tuple[PipelineModel, DataFrame]:
    """Random forest on the forecast features, and its errors on the held-out days.

    The forest samples inside partitions, so their number is fixed for the same model on any
    cluster; there is one row per calendar day.  Sales without a date are no day of the series.
    """
    dated = features.filter(F.col("sale_date").isNotNull())
    known = dated.repartition(partitions, "sale_date").sortWithinPartitions("sale_date")
    training = known.filter(in_training(F.col("sale_date")))
    held_out = known.filter(~in_training(F.col("sale_date")))
    forest = RandomForestRegressor(
        featuresCol="features", labelCol="daily_revenue", numTrees=trees, seed=SEED
    )
    assembler = VectorAssembler(inputCols=list(FORECAST_FEATURES), outputCol="features")
    model = Pipeline(stages=[assembler, forest]).fit(training)
    return model, regression_metrics(model.transform(held_out)).select("mae", "rmse", "r2", "mape", "r_squared")


def future_features(daily: DataFrame, days: int = FORECAST_DAYS) -> DataFrame:
    """Feature rows for the days after the last one; lags come from the latest sales days."""
    latest = daily.select(F.make_date("Year", "Month", "Day").alias("sale_date"), "daily_revenue")
    # LONG_LAG rows, numbered from the newest.
    recent = (
        latest.orderBy(F.desc("sale_date"))
        .limit(LONG_LAG)
        .withColumn("age", F.row_number().over(Window.orderBy(F.desc("sale_date"))))
    )
    revenue = F.col("daily_revenue").cast("decimal(30,2)")

    def mean(rows: int) -> Column:
        near = F.when(F.col("age") <= rows, revenue)
        return F.try_divide(money.as_double(F.sum(near)), F.count(near))

    day = F.col("prediction_date")
    return (
        recent.agg(
            F.max("sale_date").alias("last"),
            mean(SHORT_LAG).alias("lag_7"),
            mean(LONG_LAG).alias("lag_30"),
            mean(SHORT_LAG).alias("rolling_mean_7"),
        )
        .select(
            F.explode(F.sequence(F.date_add("last", 1), F.date_add("last", days))).alias("prediction_date"),
            "lag_7",
            "lag_30",
            "rolling_mean_7",
        )
        .select(
            "prediction_date",
            F.dayofyear(day).alias("day_of_year"),
            F.month(day).alias("month"),
            F.dayofweek(day).alias("day_of_week"),
            "lag_7",
            "lag_30",
            "rolling_mean_7",
        )
    )


def forecast(model: PipelineModel, daily: DataFrame, days: int = FORECAST_DAYS) -> DataFrame:
    return model.transform(future_features(daily, days)).select("prediction_date", "prediction")


def train_direct(rows: DataFrame, trees: int = FOREST_TREES, partitions: int = 8) -> PipelineModel:
    """One random forest for all horizons, on the rows of ``features.horizon_features`` whose target day is known."""
    known = rows.filter(F.col("daily_revenue").isNotNull())
    known = known.repartition(partitions, "origin").sortWithinPartitions("origin", "horizon")
    forest = RandomForestRegressor(featuresCol="features", labelCol="daily_revenue", numTrees=trees, seed=SEED)
    assembler = VectorAssembler(inputCols=[*FORECAST_FEATURES, "horizon"], outputCol="features")
    return Pipeline(stages=[assembler, forest]).fit(known)


def forecast_direct(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Forecasts from the latest origin day of the rows, each horizon by its own features."""
    newest = table_wide(rows, origin=F.max("origin"))["origin"]
    made = model.transform(rows.filter(F.col("origin") == newest))
    return made.select(F.col("target").alias("prediction_date"), "horizon", "prediction")


def complete() -> Column:
    """The customer has every feature the clusters are made of."""
    known = F.lit(True)
    for name in CUSTOMER_FEATURES:
        known = known & F.col(name).isNotNull()
    return known


def incomplete_customers(features: DataFrame) -> int:
    return features.filter(~complete()).count()


def train_clusters(features: DataFrame, k: int = CLUSTERS) -> PipelineModel:
    """K-means on customer features scaled to unit deviation.

    Customers of whom a feature is unknown (no readable purchase date, say) are left out of the
    fit; ``incomplete_customers`` counts them, and ``assign_clusters`` still returns them.

    The features are kept on the executors for the iterations and recomputed from their
    tables if an executor is lost.
    """
    assembled = VectorAssembler(inputCols=list(CUSTOMER_FEATURES), outputCol="features_raw")
    scaled = StandardScaler(inputCol="features_raw", outputCol="features")
    kmeans = KMeans(featuresCol="features", predictionCol="cluster", k=k, seed=SEED)
    kept = features.filter(complete()).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return Pipeline(stages=[assembled, scaled, kmeans]).fit(kept)
    finally:
        kept.unpersist()


def cluster_labels(model: PipelineModel) -> Column:
    """Label by the rank of the cluster's centre in spend, read from the k centres."""
    spend = CUSTOMER_FEATURES.index("monetary")
    centres = [float(c[spend]) for c in model.stages[-1].clusterCenters()]
    by_spend = sorted(range(len(centres)), key=lambda c: -centres[c])
    named = [
        F.when(F.col("cluster") == cluster, CLUSTER_LABELS[min(rank, len(CLUSTER_LABELS) - 1)])
        for rank, cluster in enumerate(by_spend)
    ]
    return F.when(F.col("cluster").isNotNull(), F.coalesce(*named, F.lit(CLUSTER_LABELS[-1])))


def assign_clusters(model: PipelineModel, features: DataFrame) -> DataFrame:
    """All customers; those with an unknown feature have no cluster."""
    assigned = model.transform(features.filter(complete()))
    return assigned.unionByName(features.filter(~complete()), allowMissingColumns=True)


def nearest_checked(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Assigned customers with ``nearest``: no other centre is closer than that of their cluster."""
    place = vector_to_array("features")

    def distance(centre) -> Column:
        point = F.array(*[F.lit(float(x)) for x in centre])
        squares = F.zip_with(place, point, lambda a, b: (a - b) * (a - b))
        return F.aggregate(squares, F.lit(0.0), lambda total, x: total + x)

    distances = F.array(*[distance(c) for c in model.stages[-1].clusterCenters()])
    own = F.element_at("distances", F.col("cluster") + 1)
    assigned = assign_clusters(model, features).withColumn("distances", distances)
    return assigned.withColumn("nearest", own <= F.array_min("distances") + 1e-9).drop("distances")


def customer_segments(model: PipelineModel, features: DataFrame) -> DataFrame:
    return assign_clusters(model, features).select(
        "CustomerID",
        "cluster",
        cluster_labels(model).alias("segment_label"),
        "recency",
        "frequency",
        "monetary",
    )


def silhouette(predictions: DataFrame) -> float:
    known = predictions.filter(F.col("cluster").isNotNull())
    return ClusteringEvaluator(featuresCol="features", predictionCol="cluster").evaluate(known)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
