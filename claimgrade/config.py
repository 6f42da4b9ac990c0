"""Domain configuration: everything that is a word list, a label or a threshold.

The operators take a :class:`GradingConfig`; ``FACILITY`` is the one shipped with
the package. Another domain (another lexicon, other entity types, other rules)
is another instance.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class CapabilityTerms:
    """Terms that count as evidence for one capability, per text channel."""

    capability: str
    structured: tuple[str, ...]
    claim: tuple[str, ...]
    prose: tuple[str, ...]
    structured_prefix: tuple[str, ...] = ()
    screening_any: tuple[str, ...] = ()
    screening_none: tuple[str, ...] = ()
    high_acuity: bool = False

    @property
    def caps_screening(self) -> bool:
        return bool(self.screening_any)


@dataclass(frozen=True)
class RegionRules:
    synonyms: dict[str, tuple[str, ...]]
    null_literals: tuple[str, ...]


@dataclass(frozen=True)
class Plausibility:
    small_types: tuple[str, ...]
    beds_range: tuple[int, int] = (1, 5000)
    doctors_range: tuple[int, int] = (1, 2000)
    supported_beds: int = 20
    supported_doctors: int = 10
    # a reported zero still contradicts, although it is not a sane bed count
    contradiction_beds_range: tuple[int, int] = (0, 5000)
    contradiction_beds_below: int = 5
    contradiction_doctors_below: int = 2


@dataclass(frozen=True)
class Scoring:
    tier_base: dict[str, int]
    source_cap: int = 10
    recency_bonus: int = 10
    recency_months: int = 12
    corroboration_sources: int = 3


@dataclass(frozen=True)
class GradingConfig:
    valid_types: tuple[str, ...]
    type_remap: dict[str, str]
    regions: RegionRules
    lexicon: tuple[CapabilityTerms, ...]
    plausibility: Plausibility
    scoring: Scoring
    baseline_ladder: tuple[str, ...]
    final_ladder: tuple[str, ...]
    rule_tier: dict[str, str]
    # codes a row must carry to count as an entity operator; used by profiling only
    valid_operators: tuple[str, ...] = field(default=())

    @property
    def capabilities(self) -> tuple[str, ...]:
        return tuple(t.capability for t in self.lexicon)

    @property
    def high_acuity(self) -> tuple[str, ...]:
        return tuple(t.capability for t in self.lexicon if t.high_acuity)

    @property
    def screening_capped(self) -> tuple[str, ...]:
        return tuple(t.capability for t in self.lexicon if t.caps_screening)


# ---------------------------------------------------------------------------
# Tiers, scopes, statuses
# ---------------------------------------------------------------------------
TIERS = ("strong", "partial", "weak_suspicious", "no_claim")
SCOPES = (
    "full_capability",
    "adjacent_service",
    "screening_or_diagnostics_only",
    "unclear",
)

# ---------------------------------------------------------------------------
# Evidence terms, matched as lower-case substrings
# ---------------------------------------------------------------------------
ICU = CapabilityTerms(
    "icu",
    structured=("intensive care", "critical care", "criticalcare", " icu", "ventilator"),
    structured_prefix=("icu",),
    claim=("icu", "intensive care", "critical care"),
    prose=("icu", "intensive care", "critical care"),
    high_acuity=True,
)
NICU = CapabilityTerms(
    "nicu",
    structured=("nicu", "neonat", "incubator", "infant warmer"),
    claim=("nicu", "neonat", "newborn intensive"),
    prose=("nicu", "neonat", "newborn intensive"),
    high_acuity=True,
)
MATERNITY = CapabilityTerms(
    "maternity",
    structured=("obstetr", "gynec", "maternit", "neonatologyperinatal", "reproductiveendo"),
    claim=("maternit", "obstetr", "delivery", "labour", "labor room", "antenatal", "birthing"),
    prose=("maternit", "obstetr", "delivery", "antenatal", "childbirth"),
)
EMERGENCY = CapabilityTerms(
    "emergency",
    structured=("emergencymedicine", "emergency", "ambulance", "casualty"),
    claim=("emergency", "casualty", "24/7", "24 hour", "24 hrs", "24x7"),
    prose=("emergency", "casualty", "24/7", "24 hour"),
)
ONCOLOGY = CapabilityTerms(
    "oncology",
    structured=("oncolog", "chemotherap", "radiotherap", "linear accelerator", "radiation oncolog"),
    claim=("oncolog", "chemotherap", "radiotherap", "cancer treatment", "cancer care", "tumor board"),
    prose=("oncolog", "chemotherap", "cancer treatment"),
    screening_any=("cancer", "tumour", "tumor"),
    screening_none=("oncolog", "chemotherap", "radiotherap", "cancer treatment", "tumor board"),
    high_acuity=True,
)
TRAUMA = CapabilityTerms(
    "trauma",
    structured=("trauma", "traumasurgery"),
    claim=("trauma", "polytrauma", "poly trauma"),
    prose=("trauma", "accident and emergency"),
    high_acuity=True,
)

# ---------------------------------------------------------------------------
# Region synonyms (lower-case, trimmed input -> canonical name)
# ---------------------------------------------------------------------------
REGIONS = RegionRules(
    synonyms={
        "Tamil Nadu": ("tamilnadu", "tamil nadu", "chennai"),
        "Odisha": ("orissa", "odisha"),
        "Maharashtra": ("thane", "mumbai", "navi mumbai", "pune"),
        "Telangana": ("hyderabad",),
        "Kerala": ("thiruvananthapuram", "malappuram"),
    },
    null_literals=("", "null"),
)

# ---------------------------------------------------------------------------
# Rule names in ladder order and the tier each one assigns
# ---------------------------------------------------------------------------
RULE_TIER = {
    "no_hit": "no_claim",
    "scope_screening": "weak_suspicious",
    "scope_adjacent": "weak_suspicious",
    "screening_language": "weak_suspicious",
    "implausible": "weak_suspicious",
    "structured_corroborated": "strong",
    "structured_or_claim": "partial",
    "prose_only": "weak_suspicious",
    "otherwise": "no_claim",
}
FINAL_LADDER = tuple(RULE_TIER)
BASELINE_LADDER = tuple(r for r in RULE_TIER if not r.startswith("scope_"))

FACILITY = GradingConfig(
    valid_types=("hospital", "clinic", "dentist", "doctor", "pharmacy", "farmacy", "nursing_home"),
    type_remap={"farmacy": "pharmacy"},
    regions=REGIONS,
    lexicon=(ICU, NICU, MATERNITY, EMERGENCY, ONCOLOGY, TRAUMA),
    plausibility=Plausibility(small_types=("clinic", "dentist", "doctor", "pharmacy")),
    scoring=Scoring(tier_base={"strong": 90, "partial": 60, "weak_suspicious": 30, "no_claim": 0}),
    baseline_ladder=BASELINE_LADDER,
    final_ladder=FINAL_LADDER,
    rule_tier=RULE_TIER,
    valid_operators=("public", "private"),
)

# ---------------------------------------------------------------------------
# Explanation sentences
# ---------------------------------------------------------------------------
NO_EVIDENCE = "No evidence of this capability in the facility data."
NO_EVIDENCE_SOURCED_RECENT = (
    NO_EVIDENCE + " The facility profile itself is well-sourced and recently updated,"
    " but none of those sources mention this capability."
)
NO_EVIDENCE_SOURCED = (
    NO_EVIDENCE + " The facility profile itself is well-sourced,"
    " but none of those sources mention this capability."
)
NO_EVIDENCE_RECENT = (
    NO_EVIDENCE + " The facility has a recent public update,"
    " but that update still does not mention this capability."
)
SCREENING_ONLY_BASELINE = (
    "Only cancer-screening language found, with no treatment evidence — capped as weak/suspicious."
)
SCREENING_ONLY_FINAL = (
    "Only cancer-screening language found, with no treatment evidence - capped as weak/suspicious."
)
# {capability}, {facility_type}, {n_source_urls} and {channels} name columns
CAPACITY_TOO_SMALL = (
    "Claims {capability} but its reported capacity (beds/doctors) is too small to plausibly provide it"
    " — flagged weak/suspicious."
)
IMPLAUSIBLE_BASELINE = (
    "A {facility_type} claiming {capability} is implausible without hospital-level support"
    " (no hospital-scale capacity reported), so this is flagged weak/suspicious."
)
IMPLAUSIBLE_FINAL = (
    "A {facility_type} claiming {capability} is implausible without hospital-level support,"
    " so this is flagged weak/suspicious."
)
SCOPE_SCREENING = (
    "LLM review found only screening or diagnostic evidence for {capability},"
    " so this is capped as weak/suspicious."
)
SCOPE_ADJACENT = (
    "LLM review found only adjacent-service evidence for {capability}, not the full capability,"
    " so this is capped as weak/suspicious."
)
WELL_SUPPORTED = (
    "Listed in structured specialties/equipment and well-corroborated"
    " ({n_source_urls} sources, official website, affiliated staff)."
)
LIMITED = "Found in {channels}, but corroboration is limited."
CHANNEL_STRUCTURED = "structured specialties/equipment"
CHANNEL_CLAIM = "the facility's own capability claims"
PROSE_ONLY = "Mentioned only in free-text description, with no structured backing."
UNRELIABLE = "No reliable evidence."

# ---------------------------------------------------------------------------
# Labels shown with a drill-down
# ---------------------------------------------------------------------------
EVIDENCE_SIGNAL_LABELS = {
    "structured_hit": "structured evidence matched",
    "claim_hit": "capability claim matched",
    "prose_hit": "free-text mention matched",
}
CONTEXT_SIGNAL_LABELS = {
    "screening_only": "screening-only language",
    "well_corroborated": "facility well corroborated",
    "implausible": "implausible for facility type/scale",
    "recent_update": "recent facility page update",
    "capacity_supported": "hospital-scale capacity reported",
}
CONTEXT_NOTE_SOURCED_RECENT = (
    "The facility itself looks well-sourced and recently updated,"
    " but none of those sources mention this capability."
)
CONTEXT_NOTE_SOURCED = (
    "The facility itself looks well-sourced, but those sources do not mention this capability."
)
CONTEXT_NOTE_RECENT = (
    "The facility has a recent public update, but that update still does not mention this capability."
)
CONTEXT_NOTE_OTHER = "We found no direct evidence for this capability."
