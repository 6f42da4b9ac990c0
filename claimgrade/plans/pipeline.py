"""The stages in order, stored one after the other; and the review sweep."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimgrade.config import FACILITY, GradingConfig
from claimgrade.operators import clean, geo, grading, mart, reference_data
from claimgrade.review import inputs as review_inputs
from claimgrade.review import pending, run, signals
from claimgrade.session import materialise, path_exists, tune
from claimgrade.sources import tables
from claimgrade.sources.tables import StageStore

ID = "unique_id"


@dataclass(frozen=True)
class Raw:
    facilities: DataFrame
    pincode_directory: DataFrame
    district_indicators: DataFrame


def rebuild(
    raw: Raw,
    store: StageStore,
    landing: str,
    cfg: GradingConfig = FACILITY,
    as_of: date | str | None = None,
    snapshot_ts: datetime | str | None = None,
) -> dict[str, DataFrame]:
    """Build and store every stage from the raw tables; the first failure stops it.

    Each stage reads the stored form of what it needs, so nothing is computed twice
    and a lost executor costs the work of its tasks, not of earlier stages.
    """
    tune(store.spark)
    out: dict[str, DataFrame] = {}
    out["quarantine"] = store.write(clean.quarantine(raw.facilities, cfg), "quarantine")
    out["entities"] = store.write(clean.entities(raw.facilities, cfg), "entities")
    out["bridge"] = store.write(reference_data.bridge(raw.pincode_directory), "bridge")
    out["indicators"] = store.write(reference_data.indicators(raw.district_indicators), "indicators")
    out["need_index"] = store.write(reference_data.need_index(out["indicators"]), "need_index")

    # the place join runs once: what follows reads its stored result. It is dealt by id before rows
    # multiply: graded rows, signals and the mart are made where their entity stands
    profiles = store.write(geo.resolve(out["entities"], out["bridge"]), "profiles", dealt_by=ID)
    out["profiles"] = profiles
    out["geo"] = store.write(geo.geo_table(profiles), "geo")
    graded = grading.grade(review_inputs.prepared(profiles), cfg, as_of)
    out["baseline"] = store.write(grading.baseline(graded), "baseline", dealt_by=ID)
    # per row the keys, the fingerprint and the verdict; the texts stay in the profiles
    out["inputs"] = store.write(review_inputs.inputs(graded, snapshot_ts), "inputs", dealt_by=ID)
    reviews = tables.create_landing(store.spark, landing)
    return out | refresh(store, reviews, cfg)


def refresh(store: StageStore, reviews: DataFrame, cfg: GradingConfig = FACILITY) -> dict[str, DataFrame]:
    """Rebuild only what depends on the reviews: the signals and the mart."""
    tune(store.spark)
    found = store.write(signals.signals(store.read("inputs"), reviews), "signals", dealt_by=ID)
    final = mart.final_from_tables(store.read("baseline"), found, cfg)
    return {"signals": found, "mart": store.write(final, "mart", ("capability",))}


def sweep(
    store: StageStore,
    landing: str,
    letters: str,
    reviewer: run.Reviewer,
    run_id: str,
    prompt_version: str,
    provider: str,
    target: str,
    batch: bool = True,
    template: str | None = None,
    concurrency: int | None = None,
    cfg: GradingConfig = FACILITY,
    refresh_after: bool = True,
    **selection: object,
) -> DataFrame:
    """Review what is pending, append results and failures, return the run's counters.

    Without a limit one sweep takes everything that is pending. Keys that this run
    gave up earlier are not asked again. What the reviewer says is kept next to the dead
    letters: a sweep that died goes on from there when it is run again with its run id.
    ``concurrency`` is the number of calls at the same time.
    """
    spark: SparkSession = tune(store.spark)
    reviews = tables.create_landing(spark, landing)
    selected = pending.pending(
        store.read("inputs"),
        reviews,
        prompt_version,
        mode="entity" if batch else "row",
        failed=_given_up(spark, letters, run_id),
        **selection,
    )
    profiles = store.read("profiles")
    if batch:
        requests = pending.batches(selected, profiles)
    else:
        requests = pending.single_requests(selected, store.read("inputs"), review_inputs.evidence(profiles))
    # one moment for the whole run, stored with the answers
    now = F.current_timestamp()
    said = f"{letters.rstrip('/')}-answers"
    answered = run.run(requests, reviewer, run_id, batch, template=template, answers=said, concurrency=concurrency)
    parsed = materialise(answered.withColumns({"run_id": F.lit(run_id), "answered_at": now}), "run")
    rows = run.rows(parsed, run_id, prompt_version, target, F.col("answered_at"))
    tables.append_reviews(rows, landing, run_id)
    failed = run.dead_letters(parsed, run_id, prompt_version, provider, target, F.col("answered_at"))
    tables.append_dead_letters(failed, letters)
    if refresh_after:
        refresh(store, tables.create_landing(spark, landing), cfg)
    return run.summary(parsed)


def _given_up(spark: SparkSession, letters: str, run_id: str) -> DataFrame | None:
    if not path_exists(spark, letters):
        return None
    return run.failed_keys(tables.read_dead_letters(spark, letters), run_id)
