"""Saving study results as tables and models, and loading them without retraining."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession


def save_results(tables: Mapping[str, DataFrame], folder: str, mode: str = "errorifexists") -> None:
    """Write each named result table to its own parquet folder."""
    for name, table in tables.items():
        table.write.mode(mode).parquet(f"{folder}/{name}")


def load_results(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{folder}/{name}") for name in names}


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
