"""Feature rows, the train/test split and the random forest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.ml.growing import fit_trees
from matchlake.sources.writers import intermediate

# The model's inputs, in order.
FEATURES = (
    "home_squad_market_value_eur",
    "away_squad_market_value_eur",
    "market_value_diff_eur",
    "home_avg_player_market_value_eur",
    "away_avg_player_market_value_eur",
    "home_players_count",
    "away_players_count",
    "home_rank",
    "away_rank",
    "home_points",
    "away_points",
    "home_goal_diff",
    "away_goal_diff",
)
TARGET = "target"
SPLIT_STEPS = 10_000
#: Rows that a task of the fit gets, and its least number of tasks.
ROWS_PER_TASK = 100_000
LEAST_TASKS = 16


def feature_rows(df: DataFrame, features: Sequence[str] = FEATURES, target: str | None = None) -> DataFrame:
    """Rows with every feature, and the target if one is named, present and not NaN."""
    return df.dropna(subset=[*features, *([target] if target else [])])


def split(
    df: DataFrame, keys: Sequence[str] = ("match_id", "source"), share: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Training and test part by a hash of the row's key.

    A row falls into the same part however the table is partitioned and whenever a
    lost task is run again; rows of one key stay together.
    """
    step = F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(SPLIT_STEPS))
    in_training = step < round(share * SPLIT_STEPS)
    return df.filter(in_training), df.filter(~in_training)


def fit_tasks(rows: int) -> int:
    """Tasks that a fit of so many rows is laid out over; the same rows always get the same number."""
    return max(LEAST_TASKS, -(-rows // ROWS_PER_TASK))


def fit_forest(
    training: DataFrame,
    features: Sequence[str] = FEATURES,
    target: str = TARGET,
    keys: Sequence[str] = ("match_id", "source"),
    trees: int = 100,
    depth: int = 5,
    seed: int = 42,
    tasks: int | None = None,
) -> PipelineModel:
    """Assemble the features and fit a random forest; both steps are kept in one model.

    The forest is that of ``RandomForestClassifier``, grown by passes that cost a fraction of its own (``fit_trees``).

    The trees' samples depend on the partition and position of each row, so rows are
    first laid out by their key over ``tasks`` partitions: the same rows give the same
    model however they arrive and whatever the session's settings, and a partition
    computed again after a loss equals the lost one. Without ``tasks`` the rows are stored
    and their number decides (``fit_tasks``).
    """
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    forest = RandomForestClassifier(
        featuresCol="features", labelCol=target, numTrees=trees, maxDepth=depth, seed=seed
    )
    # The fit reads its input several times; only the columns it needs are kept around, and on disk.
    rows = feature_rows(training.select(*keys, *features, target), features, target)
    if tasks is None:
        rows = intermediate(rows, "fit")
        tasks = fit_tasks(rows.count())
    laid = rows.repartition(tasks, *keys).sortWithinPartitions(*rows.columns)
    needed = laid.select(*features, target).persist(StorageLevel.DISK_ONLY)
    try:
        return PipelineModel([assembler, fit_trees(needed, features, forest)])
    finally:
        needed.unpersist()


def save_model(model: PipelineModel, path: str) -> None:
    """Save, replacing an earlier model; ``path`` must be shared storage on a cluster."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """A model saved by ``save_model``."""
    return PipelineModel.load(path)
