"""Reference tables: dominant region per postcode, district indicators, need index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimgrade.operators.clean import first_per
from claimgrade.schemas import FOOTNOTED_INDICATORS, INDICATOR_COLUMNS


def dominant(df: DataFrame, key: str, values: dict[str, Column]) -> DataFrame:
    """Most frequent combination of ``values`` per ``key``; ties go to the smaller values."""
    counted = df.groupBy(F.col(key), *[c.alias(n) for n, c in values.items()]).agg(
        F.count(F.lit(1)).alias("_n")
    )
    order = [F.col("_n").desc(), *[F.col(n).asc_nulls_last() for n in values]]
    return first_per(counted, [F.col(key)], order).drop("_n")


def bridge(directory: DataFrame) -> DataFrame:
    """One district and state per pincode, so that joining it never multiplies rows."""
    return dominant(
        directory,
        "pincode",
        {
            "district_norm": F.upper(F.trim("district")),
            "state_name": F.initcap(F.trim("statename")),
        },
    )


def footnoted_number(c: Column) -> Column:
    """A number written with footnote marks around it; NULL when only marks are left."""
    return F.regexp_replace(F.trim(c), "[()*]", "").try_cast("double")


def indicators(raw: DataFrame) -> DataFrame:
    """Curated, renamed district indicators."""
    columns = [
        (footnoted_number(F.col(s)) if s in FOOTNOTED_INDICATORS else F.col(s)).alias(n)
        for s, n in INDICATOR_COLUMNS.items()
    ]
    return raw.select(
        F.upper(F.trim("district_name")).alias("district_norm"),
        F.trim("state_ut").alias("state_ut"),
        *columns,
    )


SCREENING_COVERAGES = ("breast_exam_pct", "cervical_screen_pct", "oral_cancer_exam_pct")
BURDENS = {
    "hypertension_burden": "hypertension_women_pct",
    "diabetes_burden": "high_bloodsugar_women_pct",
    "anaemia_burden": "anaemia_women_pct",
}
UNKNOWN_BIRTH_COVERAGE = 50.0


def need_index(district_indicators: DataFrame) -> DataFrame:
    """Unmet need per district; a higher value means a higher need."""
    uncovered = 100 - F.coalesce("institutional_birth_5y_pct", F.lit(UNKNOWN_BIRTH_COVERAGE))
    # unknown coverages count as none, and the gap is not clamped
    coverage = sum(F.coalesce(c, F.lit(0.0)) for c in SCREENING_COVERAGES) / len(SCREENING_COVERAGES)
    return district_indicators.select(
        "district_norm",
        "state_ut",
        F.round(F.greatest(F.lit(0.0), uncovered), 1).alias("maternity_need"),
        F.round(100 - coverage, 1).alias("oncology_screening_gap"),
        *[F.round(F.coalesce(c, F.lit(0.0)), 1).alias(n) for n, c in BURDENS.items()],
        "institutional_birth_5y_pct",
        "births_delivered_by_csection_5y_pct",
        *SCREENING_COVERAGES,
        "health_insurance_pct",
    )
