"""Manual tier overrides, kept as an event log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimgrade.functions.text import strip
from claimgrade.operators.clean import first_per

KEY = ["unique_id", "capability"]
SAVE, CLEAR = "save", "clear"


def problem() -> Column:
    """Why an event cannot be used; NULL for a good one. A saved tier needs a note."""
    saving = F.col("action") == SAVE
    found = F.concat_ws(
        ",",
        F.when(F.col("unique_id").isNull() | F.col("capability").isNull(), "no_key"),
        F.when(~F.coalesce(F.col("action").isin(SAVE, CLEAR), F.lit(False)), "bad_action"),
        F.when(F.col("ts").isNull(), "no_time"),
        F.when(saving & F.col("tier").isNull(), "no_tier"),
        F.when(saving & ~F.coalesce(F.col("note").rlike(r"\S"), F.lit(False)), "no_note"),
    )
    return F.when(found != "", found)


def validate(events: DataFrame) -> DataFrame:
    """All events with ``problem``; notes are trimmed. Split on ``problem IS NULL``."""
    return events.withColumn("problem", problem()).withColumn("note", strip(F.col("note")))


def valid(events: DataFrame) -> DataFrame:
    return validate(events).where("problem IS NULL").drop("problem")


def rejected(events: DataFrame) -> DataFrame:
    return validate(events).where("problem IS NOT NULL")


def state(events: DataFrame) -> DataFrame:
    """Overrides in force: the last event per key, unless it cleared the key.

    At equal times a clear counts as later than a save.
    """
    order = [
        F.col("ts").desc(),
        F.col("action").asc(),
        *[F.col(c).desc_nulls_last() for c in ("tier", "note", "actor_email")],
    ]
    last = first_per(valid(events), [F.col(k) for k in KEY], order)
    return last.where(F.col("action") == SAVE).drop("action")


def effective(mart: DataFrame, in_force: DataFrame) -> DataFrame:
    """Mart rows with the override beside them; an override wins."""
    override = in_force.select(
        *KEY,
        F.col("tier").alias("override_tier"),
        F.col("note").alias("override_note"),
        F.col("ts").alias("override_ts"),
        F.col("actor_email").alias("override_actor"),
    )
    return mart.join(override, KEY, "left").withColumns(
        {
            "effective_tier": F.coalesce("override_tier", "tier"),
            "has_local_override": F.col("override_tier").isNotNull(),
        }
    )
