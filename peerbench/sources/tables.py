"""Typed readers for the input tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMAS = {
    "requests": "row_number int, name string, id string, sub_industry_flag string, "
    "focus_flag string, sector string",
    "requested_fields": "ord int, origin string, field string",
    "entities": "file string, file_ord int, sheet string, sheet_ord int, row_idx bigint, "
    "holding string, universe string, sub_industry string, focus string, id string",
    "cells": "file string, file_ord int, sheet string, sheet_ord int, row_idx bigint, "
    "col_idx int, value string",
    "metrics": "id string, file string, file_ord int, sheet string, sheet_ord int, "
    "row_idx bigint, col_ord int, header string, value string",
    "vendor": "id string, field string, fy int, value string, ord bigint",
    "universe": "id string, sector_code string, is_active boolean, is_public boolean, "
    "is_primary boolean, curn string, field string, value string",
}


def read_table(spark: SparkSession, kind: str, path: str, fmt: str = "parquet") -> DataFrame:
    """Read one of the input tables with its fixed schema; no inference job runs."""
    options = {"header": "true", "multiLine": "true"} if fmt == "csv" else {}
    return spark.read.format(fmt).options(**options).schema(SCHEMAS[kind]).load(path)
