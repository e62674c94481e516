"""Split, forest training, scoring and accuracy."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark import StorageLevel

from batchlake.functions.cells import HASH_RANGE, hash_number, time_text
from batchlake.functions.schema import BATCH, MODEL_INPUTS, PREDICTION_COLUMNS, TARGET, TIME
from batchlake.operators.forest import fit

#: Rows that a task of the forest takes before there are more tasks than run at once.
TASK_ROWS = 2_000_000


def label_split(
    df: DataFrame, train_frac: float = 0.8, seed: int = 42, by: str = "row"
) -> DataFrame:
    """Append ``split`` ('train' or 'test') from a hash of the row's key.

    The label depends on the key alone, so it survives retries and
    repartitioning. ``by='batch'`` keeps a batch on one side, so that lagged
    features of test rows are never training rows.
    """
    parts = {"row": [F.col(BATCH), time_text(F.col(TIME))], "batch": [F.col(BATCH)]}[by]
    side = F.when(hash_number(seed, *parts) < int(train_frac * HASH_RANGE), "train").otherwise("test")
    return df.withColumn("split", side)


def split(
    df: DataFrame, train_frac: float = 0.8, seed: int = 42, by: str = "row"
) -> tuple[DataFrame, DataFrame]:
    """Train and test part. ``by='random'`` is Spark's ``randomSplit``."""
    if by == "random":
        train, test = df.randomSplit([train_frac, 1 - train_frac], seed)
        return train, test
    labelled = label_split(df, train_frac, seed, by)
    return (
        labelled.filter("split = 'train'").drop("split"),
        labelled.filter("split = 'test'").drop("split"),
    )


def split_sizes(df: DataFrame, train_frac: float = 0.8, seed: int = 42, by: str = "row") -> DataFrame:
    return label_split(df, train_frac, seed, by).groupBy("split").agg(F.count("*").alias("rows"))


def assembler(cols=MODEL_INPUTS) -> VectorAssembler:
    return VectorAssembler(inputCols=list(cols), outputCol="features")


def assemble(df: DataFrame, cols=MODEL_INPUTS) -> DataFrame:
    return assembler(cols).transform(df)


def train(
    df: DataFrame,
    cols=MODEL_INPUTS,
    label: str = TARGET,
    trees: int = 100,
    depth: int = 15,
    seed: int = 42,
    **forest_params,
) -> PipelineModel:
    """Fit the forest on the rows of ``df``.

    The training columns are kept (spilling to disk) while they are counted and put into bins.
    The forest is MLlib's, grown region by region (``operators/forest``). ``forest_params`` reach it,
    e.g. ``maxBins`` or ``minInstancesPerNode``.
    """
    forest = RandomForestRegressor(
        featuresCol="features",
        labelCol=label,
        numTrees=trees,
        maxDepth=depth,
        seed=seed,
        **forest_params,
    )
    rows = df.select(*cols, label).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        inputs = assembler(cols)
        return PipelineModel([inputs, fit(forest, gathered(rows), cols, label, inputs)])
    finally:
        rows.unpersist()


def gathered(rows: DataFrame) -> DataFrame:
    """The rows in as many tasks as run at once; in more only if a task would get over ``TASK_ROWS``."""
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // TASK_ROWS))
    return rows.coalesce(tasks)


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df)


def rmse_expr(label: str = TARGET, pred: str = "prediction") -> Column:
    return F.sqrt(F.avg(F.pow(F.col(label) - F.col(pred), F.lit(2))))


def r2_expr(label: str = TARGET, pred: str = "prediction") -> Column:
    """1 - residual/total sum of squares, NULL for a constant label."""
    residual = F.sum(F.pow(F.col(label) - F.col(pred), F.lit(2)))
    return 1 - F.try_divide(residual, F.var_pop(label) * F.count(label))


def rmse(df: DataFrame, label: str = TARGET, pred: str = "prediction") -> DataFrame:
    return df.agg(rmse_expr(label, pred).alias("rmse"))


def r2(df: DataFrame, label: str = TARGET, pred: str = "prediction") -> DataFrame:
    return df.agg(r2_expr(label, pred).alias("r2"))


def feature_importance(spark: SparkSession, model: PipelineModel, cols=MODEL_INPUTS) -> DataFrame:
    """Feature, importance, percent and rank, one row per model input."""
    weights = model.stages[-1].featureImportances.toArray()
    ranked = sorted(zip(cols, weights), key=lambda pair: (-pair[1], pair[0]))
    rows = [
        (rank, name, float(weight), float(weight) * 100)
        for rank, (name, weight) in enumerate(ranked, start=1)
    ]
    return spark.createDataFrame(
        rows, "rank int, feature string, importance double, importance_pct double"
    )


def prediction_table(scored: DataFrame) -> DataFrame:
    return scored.select(*PREDICTION_COLUMNS)
