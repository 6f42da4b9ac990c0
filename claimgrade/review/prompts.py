"""Prompt texts: ``$name`` templates filled with columns."""

from __future__ import annotations

from string import Template

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SYSTEM = (
    "You audit what care providers say about their own services. Judge only the evidence in the"
    " request, never set a tier, and answer with one JSON object and nothing else."
)
_FIELDS = (
    "claim_hit, prose_hit, screening_only (true, false or null); capability_scope (full_capability,"
    " adjacent_service, screening_or_diagnostics_only or unclear); supporting_snippets (short quotes"
    " from the evidence); confidence (0 to 1); reasoning (one sentence)."
)
ROW_TEMPLATE = (
    'Does "$facility_name" ($unique_id) really offer "$capability"?\n'
    f"Answer with a JSON object that has exactly these keys: {_FIELDS}\n"
    "Evidence:\n$llm_input_json\n"
)
BATCH_TEMPLATE = (
    'Which of these $capability_count capabilities does "$facility_name" ($unique_id) really offer:'
    " $capabilities?\n"
    'Answer with a JSON object {"results": [...]} that has one entry for each of them, with the'
    f" keys capability, {_FIELDS}\n"
    "Evidence:\n$llm_input_json\n"
)
REPAIR_SYSTEM = "Turn the given text into one valid JSON object. Answer with JSON only."
REPAIR_TEMPLATE = (
    f"Rewrite the text below as a JSON object with the keys {_FIELDS}\n"
    "Use null for what it does not say.\nText:\n$prior_output\n"
)
BATCH_REPAIR_TEMPLATE = (
    'Rewrite the text below as a JSON object {"results": [...]} with one entry for each of'
    f" $capabilities_json, with the keys capability, {_FIELDS}\n"
    "Use null for what it does not say.\nText:\n$prior_output\n"
)


def substitute(template: str, **columns: Column) -> Column:
    """Fill ``$name`` and ``${name}`` with columns; ``$$`` is a dollar sign.

    The template is cut into pieces once, so a filled-in text that looks like a
    placeholder stays as it is. An unknown name is an error.
    """
    parts: list[Column] = []
    end = 0
    for match in Template.pattern.finditer(template):
        if match.start() > end:
            parts.append(F.lit(template[end : match.start()]))
        end = match.end()
        name = match["named"] or match["braced"]
        if match["escaped"] is not None:
            parts.append(F.lit("$"))
        elif name is not None:
            parts.append(F.coalesce(columns[name].cast("string"), F.lit("")))
        else:
            raise ValueError(f"bad placeholder at {match.start()} in the template")
    if end < len(template):
        parts.append(F.lit(template[end:]))
    return F.concat(*parts)


def row_prompt(template: str = ROW_TEMPLATE) -> Column:
    return substitute(
        template,
        facility_name=F.col("facility_name"),
        unique_id=F.col("unique_id"),
        capability=F.get("capabilities", F.lit(0)),
        llm_input_json=F.col("llm_input_json"),
    )


def batch_prompt(template: str = BATCH_TEMPLATE) -> Column:
    return substitute(
        template,
        facility_name=F.col("facility_name"),
        unique_id=F.col("unique_id"),
        capability_count=F.size("capabilities"),
        capabilities=F.array_join("capabilities", ", "),
        llm_input_json=F.col("llm_input_json"),
    )


def repair_prompt(prior: Column, batch: bool) -> Column:
    if not batch:
        return substitute(REPAIR_TEMPLATE, prior_output=prior)
    return substitute(
        BATCH_REPAIR_TEMPLATE, capabilities_json=F.to_json("capabilities"), prior_output=prior
    )


def render(requests: DataFrame, batch: bool = True, template: str | None = None) -> DataFrame:
    """Add the system and user prompt to each request."""
    if batch:
        prompt = batch_prompt(template or BATCH_TEMPLATE)
    else:
        prompt = row_prompt(template or ROW_TEMPLATE)
    return requests.withColumns({"system_prompt": F.lit(SYSTEM), "user_prompt": prompt})
