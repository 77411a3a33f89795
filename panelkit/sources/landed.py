"""Landed survey files of unlike columns, read in one scan.

Every survey lands in its own folder with its own columns.  A registry of raw
column names and types stands for all of them: one reader takes all folders,
columns that a file lacks are NULL, and the survey is read off the file's path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.joins import _aligned, _common_type
from ..operators.schema import clean_name


def landed_registry(spark: SparkSession, path: str) -> StructType:
    """Raw columns of all files below ``path``: one distributed job over their footers.
    Files that give one name two types stop it."""
    return spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).parquet(path).schema


def read_landed(spark: SparkSession, path: str, registry: StructType | None = None, survey_col: str = "survey_id",
                survey_pattern: str = r"([^/=]+)/[^/]*$") -> DataFrame:
    """All files below ``path`` stacked by cleaned name, with the survey from the file's path.

    ``registry`` lists the raw columns; without one the footers are read.
    Raw names that clean to one name (spelled differently from survey to
    survey) become one column, with the first value present.  ``survey_pattern``
    finds the survey in the path; by default it is the file's folder.
    """
    registry = registry if registry is not None else landed_registry(spark, path)
    raw = spark.read.schema(registry).option("recursiveFileLookup", True).parquet(path)
    same: dict[str, list] = {}
    for f in registry.fields:
        same.setdefault(clean_name(f.name), []).append(f)
    columns = []
    for name, fields in same.items():
        to = _common_type([f.dataType for f in fields])
        columns.append(F.coalesce(*[_aligned(f, to) for f in fields]).alias(name))
    survey = F.regexp_extract(F.url_decode(F.col("_metadata.file_path")), survey_pattern, 1)
    return raw.select(*columns, survey.alias(survey_col))
