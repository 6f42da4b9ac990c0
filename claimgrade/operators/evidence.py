"""Match capability evidence in the text channels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimgrade.config import FACILITY, CapabilityTerms, GradingConfig
from claimgrade.functions.text import contains_any, quote

HIT_COLUMNS = ("structured_hit", "claim_hit", "prose_hit", "screening_only")


def screening_only(terms: CapabilityTerms, column: str = "full_text") -> str:
    """SQL condition: the text speaks of the disease but of no treatment."""
    if not terms.screening_any:
        return "false"
    return f"({contains_any(column, terms.screening_any)} AND NOT {contains_any(column, terms.screening_none)})"


def _hit(terms: CapabilityTerms) -> str:
    fields = {
        "capability": quote(terms.capability),
        "structured_hit": contains_any("spec_eq_text", terms.structured, terms.structured_prefix),
        "claim_hit": contains_any("claim_text", terms.claim),
        "prose_hit": contains_any("prose_text", terms.prose),
        "screening_only": screening_only(terms),
    }
    return "struct(" + ", ".join(f"{sql} AS {name}" for name, sql in fields.items()) + ")"


def expand(entities: DataFrame, cfg: GradingConfig = FACILITY) -> DataFrame:
    """Entity rows -> entity x capability rows with hit flags, in one pass.

    The capability name takes the place of the raw capability text, so callers that
    still need that text must have renamed it.
    """
    hits = ", ".join(_hit(t) for t in cfg.lexicon)
    kept = [c for c in entities.columns if c != "capability"]
    return entities.select(*kept, F.expr(f"inline(array({hits}))"))


def hits(entities: DataFrame, cfg: GradingConfig = FACILITY) -> DataFrame:
    return expand(entities, cfg).select("unique_id", "capability", *HIT_COLUMNS)
