from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from claimgrade import schemas
from claimgrade.session import tune


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return tune(session)


@pytest.fixture(scope="session")
def facilities(spark):
    """Raw rows from a few given fields; the rest is a plain hospital."""

    def make(*rows: dict) -> DataFrame:
        full = []
        for i, row in enumerate(rows):
            base = dict.fromkeys(schemas.RAW_FACILITIES.names)
            base |= {
                "unique_id": f"id{i}",
                "source_content_id": f"s{i}",
                "name": f"Name {i}",
                "facilityTypeId": "hospital",
            }
            full.append(tuple({**base, **row}[n] for n in schemas.RAW_FACILITIES.names))
        return spark.createDataFrame(full, schemas.RAW_FACILITIES)

    return make


@pytest.fixture(scope="session")
def graded_frame(spark, facilities):
    from claimgrade.operators import clean, grading

    def make(*rows: dict, as_of: str = "2024-01-01") -> DataFrame:
        bridge = spark.createDataFrame([], "pincode bigint, district_norm string, state_name string")
        profiles = clean.profiles(facilities(*rows), bridge)
        return grading.grade(profiles, as_of=as_of)

    return make


@pytest.fixture(scope="session")
def graded(graded_frame):
    """Graded rows of raw rows, by (unique_id, capability)."""

    def make(*rows: dict, as_of: str = "2024-01-01") -> dict:
        found = graded_frame(*rows, as_of=as_of).collect()
        return {(r["unique_id"], r["capability"]): r for r in found}

    return make


SUPPORTED = {
    "specialties": '["medicalOncology"]',
    "capability": '["Cancer treatment"]',
    "description": "chemotherapy day care",
    "source_urls": '["u1", "u2", "u3", "u4", "u5", "u6"]',
    "officialWebsite": "https://h.example",
    "affiliated_staff_presence": "true",
    "capacity": "80",
    "numberDoctors": "25",
}


@pytest.fixture(scope="session")
def supported():
    """An oncology hospital with every kind of support."""
    return dict(SUPPORTED)
