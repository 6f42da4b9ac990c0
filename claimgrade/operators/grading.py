"""Plausibility, corroboration and the rule ladder that turns evidence into a tier.

``grade`` keeps every column of the entity row, so later stages (review inputs,
final mart) carry on from the same frame instead of joining tables back together.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimgrade import config as texts
from claimgrade.config import FACILITY, GradingConfig, Plausibility
from claimgrade.functions.text import fill, null_literal_to_null
from claimgrade.operators import evidence

# raw text columns make room for the capability name of the graded row
RENAMED = {c: f"{c}_raw" for c in ("capability", "specialties", "procedure", "equipment", "description")}

BASELINE_COLUMNS = (
    "unique_id",
    "capability",
    "name",
    "facility_type",
    "operator_type",
    "district_norm",
    "state_name",
    "latitude",
    "longitude",
    "tier",
    "score",
    "explanation",
    "structured_hit",
    "claim_hit",
    "prose_hit",
    "screening_only",
    "well_corroborated",
    "implausible",
    "n_source_urls",
    "official_website",
    "staff_present",
    "evidence_json",
    "citation_urls",
)


def within(c: Column, bounds: tuple[int, int]) -> Column:
    """The value when it lies in the bounds, else NULL."""
    return F.when(c.between(*bounds), c)


def as_date(as_of: date | str | None) -> Column:
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


# --- entity level ----------------------------------------------------------


def plausibility(df: DataFrame, rules: Plausibility) -> DataFrame:
    beds, doctors = F.col("capacity_beds"), F.col("num_doctors")
    sane = df.withColumns(
        {"beds_sane": within(beds, rules.beds_range), "docs_sane": within(doctors, rules.doctors_range)}
    )
    large = (F.col("beds_sane") >= rules.supported_beds) | (F.col("docs_sane") >= rules.supported_doctors)
    tiny = (within(beds, rules.contradiction_beds_range) < rules.contradiction_beds_below) & (
        F.coalesce("docs_sane", F.lit(0)) < rules.contradiction_doctors_below
    )
    return sane.withColumns(
        {
            "capacity_supported": F.coalesce(large, F.lit(False)),
            "capacity_contradicts": F.coalesce(tiny, F.lit(False)),
        }
    )


def corroboration(df: DataFrame, cfg: GradingConfig) -> DataFrame:
    """Enough sources, a website and staff. Unknown staff or sources leave it unknown."""
    website = F.coalesce(null_literal_to_null(F.col("official_website")).isNotNull(), F.lit(False))
    enough = F.col("n_source_urls") >= cfg.scoring.corroboration_sources
    return df.withColumn("well_corroborated", enough & website & F.col("staff_present"))


def recency(df: DataFrame, cfg: GradingConfig, as_of: date | str | None) -> DataFrame:
    since = F.add_months(as_date(as_of), -cfg.scoring.recency_months)
    updated = df.withColumn("page_updated", F.col("recency_of_page_update").try_cast("date"))
    return updated.withColumn("recent_update", F.coalesce(F.col("page_updated") >= since, F.lit(False)))


def entity_flags(entities: DataFrame, cfg: GradingConfig, as_of: date | str | None) -> DataFrame:
    return recency(corroboration(plausibility(entities, cfg.plausibility), cfg), cfg, as_of)


# --- entity x capability level ---------------------------------------------


def any_hit() -> Column:
    return F.col("structured_hit") | F.col("claim_hit") | F.col("prose_hit")


def implausible(cfg: GradingConfig) -> Column:
    small = F.col("facility_type").isin(*cfg.plausibility.small_types)
    return (
        any_hit()
        & F.col("capability").isin(*cfg.high_acuity)
        & ((small & ~F.col("capacity_supported")) | F.col("capacity_contradicts"))
    )


def _conditions(cfg: GradingConfig) -> dict[str, Column]:
    structured = F.col("structured_hit")
    return {
        "no_hit": ~any_hit(),
        "scope_screening": F.col("capability_scope") == "screening_or_diagnostics_only",
        "scope_adjacent": F.col("capability_scope") == "adjacent_service",
        "screening_language": F.col("capability").isin(*cfg.screening_capped)
        & F.col("screening_only")
        & ~structured,
        "implausible": F.col("implausible"),
        "structured_corroborated": structured & F.col("well_corroborated"),
        "structured_or_claim": structured | F.col("claim_hit"),
        "prose_only": F.col("prose_hit"),
    }


def rule(ladder: tuple[str, ...], cfg: GradingConfig) -> Column:
    """Name of the first rule that holds; a condition that is NULL does not hold."""
    conditions = _conditions(cfg)
    *ordered, last = ladder
    out = F
    for name in ordered:
        out = out.when(conditions[name], F.lit(name))
    return out.otherwise(F.lit(last))


def tier_of(rule_column: Column, cfg: GradingConfig) -> Column:
    by_tier: dict[str, list[str]] = {}
    for name, tier in cfg.rule_tier.items():
        by_tier.setdefault(tier, []).append(name)
    out = F
    for tier, names in by_tier.items():
        out = out.when(rule_column.isin(*names), F.lit(tier))
    return out


def score(cfg: GradingConfig) -> Column:
    s = cfg.scoring
    base = F
    for tier, points in s.tier_base.items():
        base = base.when(F.col("tier") == tier, F.lit(points))
    sources = F.least(F.coalesce("n_source_urls", F.lit(0)), F.lit(s.source_cap))
    bonus = F.when(F.col("recent_update"), F.lit(s.recency_bonus)).otherwise(F.lit(0))
    return base.otherwise(F.lit(0)) + sources + bonus


def explanation(final: bool) -> Column:
    """One sentence for the rule that decided, with the facts it rests on."""
    fired = F.col("rule")
    corroborated, recent = F.col("well_corroborated"), F.col("recent_update")
    named = {
        "capability": F.col("capability"),
        "facility_type": F.col("facility_type"),
        "n_source_urls": F.col("n_source_urls").cast("string"),
        "channels": F.concat_ws(
            " and ",
            F.when(F.col("structured_hit"), F.lit(texts.CHANNEL_STRUCTURED)),
            F.when(F.col("claim_hit"), F.lit(texts.CHANNEL_CLAIM)),
        ),
    }

    def sentence(template: str) -> Column:
        return fill(template, **named)

    nothing = (
        F.when(corroborated & recent, F.lit(texts.NO_EVIDENCE_SOURCED_RECENT))
        .when(corroborated, F.lit(texts.NO_EVIDENCE_SOURCED))
        .when(recent, F.lit(texts.NO_EVIDENCE_RECENT))
        .otherwise(F.lit(texts.NO_EVIDENCE))
    )
    if final:
        screening, not_plausible = F.lit(texts.SCREENING_ONLY_FINAL), sentence(texts.IMPLAUSIBLE_FINAL)
    else:
        screening = F.lit(texts.SCREENING_ONLY_BASELINE)
        not_plausible = F.when(F.col("capacity_contradicts"), sentence(texts.CAPACITY_TOO_SMALL)).otherwise(
            sentence(texts.IMPLAUSIBLE_BASELINE)
        )
    return (
        F.when(F.col("tier") == "no_claim", nothing)
        .when(fired == "scope_screening", sentence(texts.SCOPE_SCREENING))
        .when(fired == "scope_adjacent", sentence(texts.SCOPE_ADJACENT))
        .when(fired == "screening_language", screening)
        .when(fired == "implausible", not_plausible)
        .when(fired == "structured_corroborated", sentence(texts.WELL_SUPPORTED))
        .when(fired == "structured_or_claim", sentence(texts.LIMITED))
        .when(fired == "prose_only", F.lit(texts.PROSE_ONLY))
        .otherwise(F.lit(texts.UNRELIABLE))
    )


def evidence_fields() -> list[Column]:
    return [
        F.col("structured_hit"),
        F.col("claim_hit"),
        F.col("prose_hit"),
        F.col("screening_only"),
        F.col("well_corroborated"),
        F.col("implausible"),
        F.col("n_source_urls"),
        null_literal_to_null(F.col("official_website")).alias("official_website"),
        F.col("recent_update"),
        F.col("page_updated").cast("string").alias("page_updated"),
        F.col("capacity_supported"),
        F.col("beds_sane").alias("beds"),
        F.col("docs_sane").alias("num_doctors"),
    ]


def decide(df: DataFrame, ladder: tuple[str, ...], cfg: GradingConfig) -> DataFrame:
    """Add ``rule``, ``tier`` and ``score`` by a ladder."""
    ruled = df.withColumn("rule", rule(ladder, cfg))
    tiered = ruled.withColumn("tier", tier_of(F.col("rule"), cfg))
    return tiered.withColumn("score", score(cfg))


def grade(profiles: DataFrame, cfg: GradingConfig = FACILITY, as_of: date | str | None = None) -> DataFrame:
    """Profiles (entities with a resolved place) -> graded entity x capability rows.

    The entity-level flags are computed before the expansion, once per entity.
    Columns nobody selects later are pruned, including the texts.
    """
    flagged = entity_flags(profiles, cfg, as_of)
    renamed = flagged.withColumnsRenamed(RENAMED).withColumnRenamed("source_urls_arr", "citation_urls")
    expanded = evidence.expand(renamed, cfg).withColumn("implausible", implausible(cfg))
    decided = decide(expanded, cfg.baseline_ladder, cfg)
    return decided.withColumns(
        {
            "explanation": explanation(final=False),
            "evidence_json": F.to_json(F.struct(*evidence_fields())),
        }
    )


def baseline(graded: DataFrame) -> DataFrame:
    """The stored columns of the baseline assessment."""
    return graded.select(*BASELINE_COLUMNS)
