"""Persistence of model state and metadata (JSON / Parquet sinks).

Model state is a DataFrame (one row per entity) written as Parquet; the
metadata is a one-row DataFrame with a nested evaluation struct written as
JSON. Extra metadata keys are merged in and override the computed ones.
"""

from __future__ import annotations

import datetime as dt
import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

METADATA_SCHEMA = (
    "model_name string, version string, trained_at timestamp, last_train_date date, "
    "data_cutoff date, n_features int, n_groups int, groups array<string>, "
    "evaluation_metrics struct<window_start: date, window_end: date, n_days: int, wape: double, "
    "mae: double, rmse: double>, evaluation_note string, extra string"
)


def write_state(state: DataFrame, path: str) -> None:
    state.write.mode("overwrite").parquet(f"{path}/state")


def write_metadata(spark: SparkSession, path: str, model_name: str, meta: dict[str, Any],
                   extra: dict[str, Any] | None = None) -> DataFrame:
    """One-row metadata table written as JSON; ``extra`` keys override
    ``meta`` keys, and keys outside the schema are kept as a JSON string."""
    merged = {**meta, **(extra or {})}
    fields = ("version", "trained_at", "last_train_date", "data_cutoff", "n_features", "n_groups",
              "groups", "evaluation_metrics", "evaluation_note")
    rest = {k: v for k, v in merged.items() if k not in fields}
    row = (model_name, *[merged.get(k) for k in fields], json.dumps(rest, default=str) if rest else None)
    df = spark.createDataFrame([row], METADATA_SCHEMA)
    df.coalesce(1).write.mode("overwrite").json(f"{path}/metadata")
    return df


def read_model(spark: SparkSession, path: str, expected_model: str) -> tuple[DataFrame, DataFrame]:
    """State and metadata; raises when the stored model type differs."""
    meta = spark.read.schema(METADATA_SCHEMA).json(f"{path}/metadata")
    name = meta.select("model_name").first()[0]
    if name != expected_model:
        raise TypeError(f"Stored model is {name!r}, expected {expected_model!r}")
    return spark.read.parquet(f"{path}/state"), meta


def model_info(meta: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Projection of the metadata row for reporting (nested fields flattened);
    ``extra`` columns are carried along."""
    return meta.select("version", "trained_at", "last_train_date", "data_cutoff", "n_features",
                       "n_groups", "groups",
                       F.col("evaluation_metrics.window_start").alias("eval_window_start"),
                       F.col("evaluation_metrics.window_end").alias("eval_window_end"),
                       F.col("evaluation_metrics.wape").alias("eval_wape"),
                       F.col("evaluation_metrics.mae").alias("eval_mae"),
                       F.col("evaluation_metrics.rmse").alias("eval_rmse"),
                       "evaluation_note", *extra)


def read_params(spark: SparkSession, path: str, required: tuple[str, ...] = ()) -> dict[str, Any]:
    """Tuned-parameter JSON (multi-line) -> dict of ``best_params``; missing
    required keys raise."""
    df = spark.read.option("multiLine", True).json(path)
    if "best_params" not in df.columns:
        raise KeyError(f"{path}: no 'best_params' key")
    params = df.select("best_params.*").first().asDict()
    missing = [k for k in required if k not in params]
    if missing:
        raise KeyError(f"{path}: missing parameters {missing}")
    return params


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
