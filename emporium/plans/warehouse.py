"""Build the cleaned warehouse tables straight from the driver's Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.driver_tables import marketplace_sources
from .clean import CleanOptions, clean_all


def driver_warehouse(spark: SparkSession, sf_dir: str,
                     opts: CleanOptions = CleanOptions()) -> dict[str, DataFrame]:
    return clean_all(marketplace_sources(spark, sf_dir), opts)
