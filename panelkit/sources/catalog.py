"""Survey catalogue: wave, version and tag parsed from the survey name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import codebook as cb
from ..functions import text


def survey_fields(name: Column, wave_pattern: str = cb.SURVEY_WAVE_PATTERN,
                  version_pattern: str = cb.SURVEY_VERSION_PATTERN,
                  tag_pattern: str = cb.SURVEY_TAG_PATTERN) -> dict[str, Column]:
    """Lookbehind extraction (Java regex); NULL where the name does not match."""
    return {
        "survey_time": text.parse_integer(text.str_extract(name, wave_pattern)),
        "survey_version": text.parse_integer(text.str_extract(name, version_pattern)),
        "survey_tag": text.str_extract(name, tag_pattern),
    }


def survey_catalog(responses: DataFrame, id_col: str = "survey_name") -> DataFrame:
    """Distinct surveys seen in the responses with their parsed fields.

    A distinct over one short string column: partial aggregation leaves one
    row per survey per task, so the result is bounded by the survey count.
    """
    cat = responses.select(id_col).distinct()
    return cat.withColumns(survey_fields(F.col(id_col)))
