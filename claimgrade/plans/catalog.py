"""Registered queries: each operator over whole tables, by name.

A query gets a session and a folder of generated tables and returns a lazy frame.
Lists are joined to text and documents are read back field by field, so that the
results can be compared with those of another engine.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce, wraps

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimgrade.config import FACILITY
from claimgrade.operators import (
    citations,
    clean,
    consistency,
    coordinates,
    evidence,
    geo,
    grading,
    lexicon,
    mart,
    overrides,
    profile,
    reference_data,
    serve,
    sketches,
)
from claimgrade.review import inputs as review_inputs
from claimgrade.review import parse, pending, prompts, run, signals
from claimgrade.plans import incremental, pipeline
from claimgrade.session import materialise, shared_folder, tune
from claimgrade.sources import tables, testdata
from claimgrade.sources.slices import SlicedStore
from claimgrade.sources.tables import StageStore

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SEPARATOR = "|"
TIME = "yyyy-MM-dd HH:mm:ss"
# columns of the profiles that neither the grading nor a review nor a served row has
UNREAD = (
    "websites_arr",
    "address_line1",
    "address_line2",
    "address_line3",
    "address_country",
    "address_countryCode",
    "facebook_link",
    "logo_present",
    "social_presence_count",
    "cluster_id",
    "state_raw",
)


def query(fn: Callable[[Stages], DataFrame]) -> Callable[[Stages], DataFrame]:
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(Stages(tune(spark), sf_dir))
    return fn


def stage(method: Callable[..., object]) -> Callable[..., object]:
    """Keep the frame of a stage, so that it is composed once per query."""

    @wraps(method)
    def kept(self: Stages, *args: object) -> object:
        key = (method.__name__, *args)
        if key not in self.made:
            self.made[key] = method(self, *args)
        return self.made[key]

    return kept


class Stages:
    """The stages of one query run, composed lazily from the raw tables.

    A stage used twice in a query is the same frame both times, so that Spark can
    reuse its shuffles.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.made: dict[tuple, object] = {}

    @stage
    def raw(self, name: str = "raw_facilities") -> DataFrame:
        return testdata.load(self.spark, self.sf_dir, name)

    @stage
    def entities(self) -> DataFrame:
        return clean.entities(self.raw())

    @stage
    def story_profiles(self) -> DataFrame:
        """Entities whose texts are whole documents and conversations."""
        return clean.profiles(self.raw("raw_documents"), self.bridge())

    @stage
    def stories(self) -> DataFrame:
        # from the stored profiles where the query has stored them
        stored = ("placed_stories",) in self.made
        return grading.grade(self.shared(self.placed_stories() if stored else self.story_profiles()), as_of=testdata.AS_OF)

    @stage
    def placed_stories(self) -> DataFrame:
        """The story profiles stored once, in slices of the id: what is made of them stands in its slice. The
        channels repeat whole texts up to three times: they are made behind the store again."""
        slices = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        store = SlicedStore(self.spark, self.folder(), f"story_{uuid.uuid4().hex}", slices=slices)
        return clean.text_channels(store.write(self.story_profiles().drop(*UNREAD, *clean.CHANNELS), "profiles"))

    @stage
    def bridge(self) -> DataFrame:
        return reference_data.bridge(self.raw("raw_pincode_directory"))

    @stage
    def indicators(self) -> DataFrame:
        return reference_data.indicators(self.raw("raw_district_indicators"))

    @stage
    def profiles(self) -> DataFrame:
        return clean.profiles(self.raw(), self.bridge())

    @stage
    def stored_profiles(self) -> DataFrame:
        """The profiles as the pipeline stores them, for queries that use them more than once, without what
        no review and no mart has: a list that is left out is not parsed."""
        return materialise(self.profiles().drop(*UNREAD), "profiles")

    @stage
    def graded(self) -> DataFrame:
        return grading.grade(self.shared(self.profiles()), as_of=testdata.AS_OF)

    @stage
    def fingerprinted(self) -> DataFrame:
        return review_inputs.with_fingerprint(self.graded())

    @stage
    def inputs(self, capability: str | None = None) -> DataFrame:
        """Stored input rows, as the pipeline has them; of one capability where the query asks for no other."""
        graded = serve.select_rows(grading.grade(self.shared(self.stored_profiles()), as_of=testdata.AS_OF), capability=capability)
        return materialise(review_inputs.inputs(graded, testdata.SNAPSHOT_TS), "inputs")

    @stage
    def rendered(self) -> DataFrame:
        return review_inputs.render(self.inputs(), review_inputs.evidence(self.stored_profiles()))

    @stage
    def reviews(self) -> DataFrame:
        return testdata.reviews(self.raw("responses"), self.inputs())

    @stage
    def reviews_alone(self) -> DataFrame:
        """``reviews`` for queries that use the fingerprints for nothing else: they are not stored."""
        return testdata.reviews(self.raw("responses"), self.fingerprinted())

    @stage
    def pending_keys(self) -> DataFrame:
        """What of the inputs decides on what is pending, stored: keys, name and fingerprint."""
        rows = review_inputs.inputs(self.graded_once(), testdata.SNAPSHOT_TS)
        return materialise(rows.select(*pending.KEY, "name", "evidence_fingerprint", "input_snapshot_ts"), "keys")

    def graded_once(self) -> DataFrame:
        """Graded rows from the stored profiles where the query has stored them, else straight from the raw rows."""
        stored = ("stored_profiles",) in self.made
        return grading.grade(self.shared(self.stored_profiles()), as_of=testdata.AS_OF) if stored else self.graded()

    def shared(self, profiles: DataFrame) -> DataFrame:
        return review_inputs.prepared(profiles)

    @stage
    def reviewed(self) -> DataFrame:
        """Graded rows with their reviews, from profiles that are stored once for both sides.

        The profiles are dealt by id before they become six rows each, so the rows stay where they are in both
        joins. The fingerprint is made where a review is held against it, not for every row.
        """
        return signals.attach(self.placed_rows(), self.present_reviews(), placed=True)

    def placed_rows(self) -> DataFrame:
        """Graded rows, dealt by id as profiles: joins by id leave them where they are."""
        return grading.grade(self.shared(self.stored_profiles().repartition("unique_id")), as_of=testdata.AS_OF)

    def present_reviews(self, profiles: DataFrame | None = None) -> DataFrame:
        """``reviews`` without the fingerprints of entities and rows that no response is held against."""
        responses = self.raw("responses")
        keys = testdata.present_keys(responses)
        asked = (profiles or self.stored_profiles()).join(keys.select("unique_id"), "unique_id", "left_semi")
        looked_at = grading.grade(self.shared(asked), as_of=testdata.AS_OF).join(keys, pending.KEY, "left_semi")
        return testdata.reviews(responses, review_inputs.with_fingerprint(looked_at))

    @stage
    def mart(self) -> DataFrame:
        return mart.final(self.reviewed())

    def mart_with_flags(self) -> DataFrame:
        """The mart with the signals that else only its documents have."""
        return mart.final(self.reviewed(), also=("recent_update", "capacity_supported"))

    def pending(self, **options: object) -> DataFrame:
        # stored inputs where the query needs them for more, else no more than decides
        rows = self.inputs() if ("inputs",) in self.made else self.pending_keys()
        return pending.pending(rows, testdata.reviews(self.raw("responses"), rows), testdata.PROMPT_VERSION, **options)

    def single_requests(self, rows: DataFrame) -> DataFrame:
        return pending.single_requests(rows, self.inputs(), review_inputs.evidence(self.stored_profiles()))

    def answers(self, batch: bool) -> DataFrame:
        """Raw answers in the shape of asked requests."""
        # one small file is one task, and reading an answer costs far more than moving its key
        name = "batch_responses" if batch else "responses"
        responses = testdata.load(self.spark, self.sf_dir, name, spread_by="event_id")
        names = F.array(*[F.lit(c) for c in FACILITY.capabilities]) if batch else F.array("capability")
        item = F.concat(F.lit("fp-"), F.col("event_id").cast("string"))
        return responses.withColumns(
            {
                "facility_name": F.concat(F.lit("Facility "), "unique_id"),
                "request_id": F.col("event_id").cast("string"),
                "capabilities": names,
                "requested": F.transform(
                    names,
                    lambda c: F.struct(
                        c.alias("capability"),
                        item.alias("evidence_fingerprint"),
                        F.lit(testdata.SNAPSHOT_TS).alias("source_snapshot_ts"),
                    ),
                ),
            }
        ).drop("capability", "record")

    def parsed(self, batch: bool) -> DataFrame:
        return parse.parse(self.answers(batch), batch)

    def folder(self) -> str:
        """A new folder for stored stages, in the folder that all executors share."""
        return f"{shared_folder(self.spark).rstrip('/')}/claimgrade/catalog-{uuid.uuid4().hex}"

    def store(self) -> StageStore:
        return StageStore(self.spark, self.folder())

    def landing(self, present: DataFrame | None = None) -> str:
        """A landing table with the stand-in reviews, appended run by run; ``present`` are stored inputs, if any."""
        path = self.folder()
        made = self.reviews_alone() if present is None else testdata.reviews(self.raw("responses"), present)
        reviews = materialise(made, "reviews")
        # all runs but one in one write; that one by append_reviews, twice
        one = "r7"
        others = reviews.where(F.col("run_id") != one)
        tables.create_landing(self.spark, path)
        others.write.mode("append").partitionBy("run_id").parquet(path)
        for _ in range(2):
            tables.append_reviews(reviews, path, one)
        return path

    @stage
    def effective(self) -> DataFrame:
        return overrides.effective(self.mart(), overrides.state(self.raw("override_events")))


def joined(name: str) -> Column:
    return F.array_join(name, SEPARATOR).alias(name)


def texts_of(df: DataFrame) -> DataFrame:
    """Lists joined to texts, all columns in place."""
    return df.select(*[joined(n) if t.startswith("array") else F.col(n) for n, t in df.dtypes])


def at_second(name: str) -> Column:
    return F.date_format(name, TIME).alias(name)


def fields(document: str, *names: str) -> Column:
    """Read back fields of a JSON document as text, all in one parse; a generator of one row."""
    return F.json_tuple(document, *names).alias(*names)


def nested_fields(df: DataFrame, document: str, *paths: str) -> DataFrame:
    """The document of ``df`` replaced by fields of it as text, also inside its objects (``object.field``): the
    document is parsed once, and each object that fields are taken from once more."""
    groups: dict[str, list[str]] = {}
    for path in paths:
        group, _, name = path.partition(".")
        groups.setdefault(group, []).extend([name] if name else [])
    kept = [c for c in df.columns if c != document]
    parts = {group: f"_part{i}" if names else group for i, (group, names) in enumerate(groups.items())}
    out = df.select(*kept, F.json_tuple(document, *parts).alias(*parts.values()))
    for group, names in groups.items():
        if names:
            out = out.select("*", F.json_tuple(parts[group], *names).alias(*names)).drop(parts[group])
    return out.select(*kept, *[p.split(".")[-1] for p in paths])


# --- cleaning ----------------------------------------------------------------

ENTITY_SCALARS = (
    "unique_id",
    "source_content_id",
    "cluster_id",
    "name",
    "facility_type",
    "operator_type",
    "num_doctors",
    "capacity_beds",
    "n_source_urls",
    "staff_present",
    "logo_present",
    "social_presence_count",
    "official_website",
    "facebook_link",
    "source",
    "recency_of_page_update",
    "address_line1",
    "address_city",
    "state_raw",
    "state_norm",
    "pincode",
    "address_country",
    "latitude",
    "longitude",
)


@query
def clean_entities(s: Stages) -> DataFrame:
    return s.entities().select(*ENTITY_SCALARS)


@query
def clean_quarantine(s: Stages) -> DataFrame:
    return clean.quarantine(s.raw()).select("source_content_id", "unique_id", "facilityTypeId", "reason")


@query
def clean_arrays(s: Stages) -> DataFrame:
    rows = clean.typed(s.raw())
    lists = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(c).alias("items"))
            for c in clean.PARSED_ARRAYS.values()
        ]
    )
    return (
        rows.select("source_content_id", F.inline(lists))
        .select("source_content_id", "column_name", F.posexplode("items").alias("position", "item"))
    )


@query
def clean_region(s: Stages) -> DataFrame:
    rows = s.raw().select(
        F.col("address_stateOrRegion").alias("state_raw"),
        clean.region(F.col("address_stateOrRegion"), FACILITY.regions).alias("state_norm"),
    )
    return rows.groupBy("state_raw", "state_norm").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def text_channels(s: Stages) -> DataFrame:
    return clean.text_channels(s.raw()).select(
        "source_content_id", "spec_eq_text", "claim_text", "prose_text", "full_text"
    )


@query
def dedupe_richest(s: Stages) -> DataFrame:
    valid = s.raw().where(clean.is_valid())
    return clean.dedupe_richest(valid).select("unique_id", "source_content_id", "cluster_id", "n_source_urls")


@query
def clean_indicators(s: Stages) -> DataFrame:
    return s.indicators()


# --- places and need -----------------------------------------------------------


@query
def bridge_dominant(s: Stages) -> DataFrame:
    return reference_data.bridge(s.raw("raw_pincode_directory"))


@query
def geo_resolve(s: Stages) -> DataFrame:
    return geo.geo_table(s.profiles())


@query
def need_index(s: Stages) -> DataFrame:
    return reference_data.need_index(s.indicators())


# --- evidence and grading --------------------------------------------------------


@query
def evidence_hits(s: Stages) -> DataFrame:
    return evidence.hits(s.entities())


@query
def evidence_lexicon(s: Stages) -> DataFrame:
    """``evidence_hits`` with the shipped lexicon as a table."""
    return lexicon.hits(s.entities(), lexicon.table(s.spark))


def passage_terms(s: Stages) -> DataFrame:
    """A lexicon of some thousand terms: neighbouring words of the benchmark passages."""
    passages = s.spark.read.schema("item_id bigint, text string").parquet(f"{s.sf_dir.rstrip('/')}/benchmark.parquet")
    words = passages.select("item_id", F.split(F.lower("text"), " ").alias("w")).where(F.size("w") > 1)
    pairs = F.expr("transform(sequence(0, size(w) - 2), i -> concat(w[i], ' ', w[i + 1]))")
    terms = words.select(F.concat(F.lit("c"), (F.col("item_id") % 6).cast("string")).alias("capability"), F.explode(pairs).alias("term"))
    rules = F.explode(F.array(F.lit("claim"), F.lit("prose"))).alias("rule")
    return terms.select("capability", rules, "term", F.lit(False).alias("anchored"))


@query
def lexicon_passages(s: Stages) -> DataFrame:
    """Whole documents and conversations against the terms of ``passage_terms``."""
    texts = clean.text_channels(s.raw("raw_documents"))
    return lexicon.hits(texts, passage_terms(s), "source_content_id").drop("structured_hit", "screening_only")


@query
def screening_only(s: Stages) -> DataFrame:
    capped = [t for t in FACILITY.lexicon if t.screening_any]
    flags = [F.struct(F.lit(t.capability).alias("capability"), F.expr(evidence.screening_only(t)).alias("screening_only")) for t in capped]
    return clean.text_channels(s.raw()).select("source_content_id", F.inline(F.array(*flags)))


@query
def plausibility(s: Stages) -> DataFrame:
    return s.graded().select(
        "unique_id",
        "capability",
        "facility_type",
        "beds_sane",
        "docs_sane",
        "capacity_supported",
        "capacity_contradicts",
        "implausible",
    )


@query
def corroboration(s: Stages) -> DataFrame:
    flagged = grading.corroboration(clean.typed(s.raw()), FACILITY)
    return flagged.select("source_content_id", "n_source_urls", "staff_present", "well_corroborated")


@query
def recency_bonus(s: Stages) -> DataFrame:
    flagged = grading.recency(clean.typed(s.raw()), FACILITY, testdata.AS_OF)
    return flagged.select(
        "source_content_id", F.col("page_updated").cast("string").alias("page_updated"), "recent_update"
    )


@query
def grade_heuristic(s: Stages) -> DataFrame:
    return grading.baseline(s.graded()).drop("evidence_json", "explanation").withColumn(
        "citation_urls", F.array_join("citation_urls", SEPARATOR)
    )


@query
def explain_heuristic(s: Stages) -> DataFrame:
    return s.graded().select("unique_id", "capability", "tier", "explanation")


BASELINE_DOCUMENT = (
    "structured_hit",
    "claim_hit",
    "prose_hit",
    "screening_only",
    "well_corroborated",
    "implausible",
    "n_source_urls",
    "official_website",
    "recent_update",
    "page_updated",
    "capacity_supported",
    "beds",
    "num_doctors",
)
FINAL_DOCUMENT = (
    *BASELINE_DOCUMENT,
    "capability_scope",
    "has_current_llm_review",
    "llm_review_status",
    "claim_hit_llm",
    "prose_hit_llm",
    "screening_only_llm",
    "supporting_snippets_llm",
    "confidence_llm",
    "reasoning_llm",
)


@query
def evidence_document(s: Stages) -> DataFrame:
    return s.graded().select("unique_id", "capability", fields("evidence_json", *BASELINE_DOCUMENT))


@query
def evidence_readback(s: Stages) -> DataFrame:
    return mart.evidence_readback(grading.baseline(s.graded())).select(
        "unique_id",
        "capability",
        "recent_update",
        "page_updated",
        "capacity_supported",
        "beds_sane",
        "docs_sane",
    )


@query
def story_grades(s: Stages) -> DataFrame:
    return s.stories().select(
        "unique_id", "capability", "tier", "score", "structured_hit", "claim_hit", "prose_hit", "screening_only", "explanation"
    )


@query
def story_payload(s: Stages) -> DataFrame:
    """Fingerprint and payload over whole texts, read back."""
    # whole texts are moved to their slice once, and stay there in the join of both sides
    profiles = s.placed_stories()
    inputs = review_inputs.inputs(s.stories(), testdata.SNAPSHOT_TS)
    texts = ("source_evidence.description", "source_evidence.claim_text", "source_evidence.full_text")
    rendered = review_inputs.render(inputs, review_inputs.evidence(profiles), placed=True)
    return nested_fields(rendered.select("unique_id", "capability", "evidence_fingerprint", "llm_input_json"), "llm_input_json", *texts)


# --- review: selection -----------------------------------------------------------


@query
def review_fingerprint(s: Stages) -> DataFrame:
    return s.fingerprinted().select("unique_id", "capability", "evidence_fingerprint")


@query
def review_inputs_table(s: Stages) -> DataFrame:
    skipped = ("heuristic_evidence_json", "llm_input_json", "input_snapshot_ts")
    every = (*review_inputs.ROW_COLUMNS, *review_inputs.EVIDENCE_COLUMNS[1:], *review_inputs.RENDERED)
    lists = ("citation_urls", "source_types_arr", *(f"{c}_arr" for c in ("capability", "specialties", "procedure", "equipment")))
    columns = [c for c in every if c not in skipped]
    return s.rendered().select(
        at_second("input_snapshot_ts"), *[joined(c) if c in lists else F.col(c) for c in columns]
    )


QUERIES["review_inputs"] = QUERIES.pop("review_inputs_table")

# every field of the payload but the notes
PAYLOAD_PATHS = tuple(
    f"{group}.{name}" if isinstance(names, dict) else group
    for group, names in review_inputs.PAYLOAD.items()
    if group != "notes"
    for name in (names if isinstance(names, dict) else [group])
)


@query
def review_payload(s: Stages) -> DataFrame:
    shown = nested_fields(s.rendered().select("llm_input_json"), "llm_input_json", *PAYLOAD_PATHS, "notes")
    return shown.withColumn("note", F.get_json_object("notes", "$[0]")).drop("notes")


@query
def review_latest(s: Stages) -> DataFrame:
    return signals.latest(s.reviews_alone()).select(
        "unique_id",
        "capability",
        "evidence_fingerprint",
        "prompt_version",
        "run_id",
        at_second("inference_ts"),
        "parsed_json",
    )


PENDING_COLUMNS = ("unique_id", "capability", "facility_name", "evidence_fingerprint", "source_snapshot_ts")


@query
def review_pending(s: Stages) -> DataFrame:
    return s.pending().select(*PENDING_COLUMNS)


@query
def review_pending_forced(s: Stages) -> DataFrame:
    return s.pending(force=True, capability="icu").select(*PENDING_COLUMNS)


@query
def review_pending_one(s: Stages) -> DataFrame:
    return s.pending(unique_id="f96").select(*PENDING_COLUMNS)


@query
def review_pending_rows(s: Stages) -> DataFrame:
    return s.pending(mode="row", limit=120).select(*PENDING_COLUMNS)


@query
def review_pending_batch(s: Stages) -> DataFrame:
    return s.pending(mode="entity", limit=25).select(*PENDING_COLUMNS)


BATCH_PATHS = (
    "facility.name",
    "facility.facility_type",
    "facility.district_norm",
    "facility.state_name",
    "facility.pincode",
    "facility.num_doctors",
    "requested_capabilities",
    "shared_source_evidence.capability_claims",
    "shared_source_evidence.specialties",
    "shared_source_evidence.description",
    "shared_source_evidence.n_source_urls",
    "shared_source_evidence.official_website",
    "shared_source_evidence.staff_present",
)


@query
def review_batches(s: Stages) -> DataFrame:
    profiles = s.stored_profiles()
    asked = pending.batches(s.pending(), profiles)
    shown = asked.select("unique_id", F.size("requested").alias("n_requested"), "llm_input_json")
    return nested_fields(shown, "llm_input_json", *BATCH_PATHS)


@query
def review_prompts(s: Stages) -> DataFrame:
    """Prompts of both modes, with the payload taken out again."""
    # pending rows keep their payload: neither they nor the inputs are stored, moved or joined again
    paid = review_inputs.with_payload(s.placed_rows(), testdata.SNAPSHOT_TS)
    rows = pending.pending(paid, s.present_reviews(), testdata.PROMPT_VERSION, also=("llm_input_json",), placed=True)
    by_entity = prompts.render(pending.batches(rows, s.stored_profiles()), batch=True)
    by_row = prompts.render(pending.as_requests(rows), batch=False)

    def shown(df: DataFrame, mode: str) -> DataFrame:
        return df.select(
            F.lit(mode).alias("mode"),
            "unique_id",
            F.array_join("capabilities", ", ").alias("capabilities"),
            F.replace("user_prompt", F.col("llm_input_json"), F.lit("<payload>")).alias("prompt"),
        )

    return shown(by_entity, "entity").unionByName(shown(by_row, "row"))


# --- review: answers ---------------------------------------------------------------


@query
def review_extract_text(s: Stages) -> DataFrame:
    return parse.extract_text(s.answers(batch=False)).select("event_id", "assistant_text", "error")


@query
def review_parse(s: Stages) -> DataFrame:
    objects = parse.extract_object(parse.extract_text(s.answers(batch=False)))
    return objects.select(
        "event_id",
        F.try_variant_get("payload", "$.claim_hit", "string").alias("claim_hit"),
        F.try_variant_get("payload", "$.capability_scope", "string").alias("capability_scope"),
        F.try_variant_get("payload", "$.reasoning", "string").alias("reasoning"),
        "error",
    )


@query
def review_validate(s: Stages) -> DataFrame:
    record = F.get("records", F.lit(0))
    columns = {f: record[f] for f in parse.SIGNAL_FIELDS}
    columns["supporting_snippets"] = F.array_join(columns["supporting_snippets"], SEPARATOR)
    return s.parsed(batch=False).select(
        "event_id", *[c.alias(f) for f, c in columns.items()], F.col("error").isNull().alias("valid")
    )


@query
def review_split(s: Stages) -> DataFrame:
    return parse.split(s.parsed(batch=True)).select(
        "event_id",
        "capability",
        "evidence_fingerprint",
        fields("parsed_json", "claim_hit", "capability_scope", "confidence", "reasoning"),
    )


@query
def review_rows(s: Stages) -> DataFrame:
    rows = run.rows(
        s.parsed(batch=False),
        F.col("run_id"),
        F.col("prompt_version"),
        testdata.TARGET,
        F.col("inference_ts"),
    )
    return rows.select(
        "unique_id",
        "capability",
        "evidence_fingerprint",
        "prompt_version",
        "model_name",
        "model_version",
        "run_id",
        at_second("source_snapshot_ts"),
        at_second("inference_ts"),
        F.get_json_object("parsed_json", "$.capability_scope").alias("capability_scope"),
    )


@query
def review_dead_letter(s: Stages) -> DataFrame:
    letters = run.dead_letters(
        s.parsed(batch=True),
        F.col("run_id"),
        F.col("prompt_version"),
        "test",
        testdata.TARGET,
        F.col("inference_ts"),
    )
    return letters.select(
        "run_id",
        "batch_number",
        "request_id",
        "unique_id",
        "facility_name",
        joined("capabilities"),
        "prompt_version",
        "provider",
        "target",
        "error",
        at_second("timestamp_utc"),
    )


@query
def review_run_summary(s: Stages) -> DataFrame:
    return run.summary(s.parsed(batch=True))


def stand_in(frame: pd.DataFrame) -> pd.Series:
    """Says by the last digit of the entity what becomes of its request: 0 an answer that cannot be
    read before its repair, 1 one that comes at the second attempt, 2 a call that always fails, 3 an
    unknown key that a repair mends for a whole entity; the others are answered at once."""
    import json

    if any(r.split(":")[2][-1] == "2" for r in frame["request_id"]):
        raise ConnectionError("no connection")

    def one(request: str) -> str:
        _, kind, entity, names, attempt, *repair = request.split(":")
        digit = entity[-1]
        record = {"claim_hit": True, "reasoning": f"{attempt}{':' if repair else ''}{''.join(repair)}"}
        if digit == "0" and not repair or digit == "1" and attempt == "attempt1":
            return json.dumps({"model": "stand-in", "output_text": "sorry"})
        if digit == "3" and not repair:
            record["unknown"] = 1
        results = {"results": [{**record, "capability": c} for c in names.split("+")]}
        return json.dumps({"model": "stand-in", "output_text": json.dumps(results if kind == "facility" else record)})

    return pd.Series([one(request) for request in frame["request_id"]], dtype=object)


@query
def review_repair(s: Stages) -> DataFrame:
    """Calls that fail, repairs and later attempts, for the ICU requests of both modes."""
    inputs = s.inputs("icu")
    reviews = testdata.reviews(s.raw("responses"), inputs)
    rows = pending.pending(inputs, reviews, testdata.PROMPT_VERSION, force=True, capability="icu")
    singles = pending.single_requests(rows, inputs, review_inputs.evidence(s.stored_profiles()))
    asked = {True: pending.batches(rows, s.stored_profiles()), False: singles}
    done = [run.run(requests, stand_in, "r1", batch, rounds=2).withColumn("mode", F.lit("entity" if batch else "row")) for batch, requests in asked.items()]
    record = F.get("records", F.lit(0))
    return done[0].unionByName(done[1]).select(
        "mode", "unique_id", F.substring_index("request_id", ":", -1).alias("attempt"), record["reasoning"].alias("reasoning"), "error"
    )


@query
def review_append(s: Stages) -> DataFrame:
    """The landing table after appends, one of them repeated."""
    return tables.create_landing(s.spark, s.landing()).select(
        "unique_id", "capability", "evidence_fingerprint", "prompt_version", "run_id", at_second("inference_ts"), "parsed_json"
    )


# --- review: signals and mart --------------------------------------------------------


@query
def review_typed(s: Stages) -> DataFrame:
    return signals.typed(s.reviews_alone()).select(
        "unique_id",
        "capability",
        "run_id",
        at_second("inference_ts"),
        "claim_hit_llm",
        "prose_hit_llm",
        "screening_only_llm",
        "capability_scope_llm",
        joined("supporting_snippets_llm"),
        "confidence_llm",
        "reasoning_llm",
    )


@query
def review_signals(s: Stages) -> DataFrame:
    return (
        signals.signals(s.inputs(), s.reviews())
        .withColumn("supporting_snippets_llm", F.array_join("supporting_snippets_llm", SEPARATOR))
        .withColumn("source_snapshot_ts", F.date_format("source_snapshot_ts", TIME))
        .withColumn("inference_ts", F.date_format("inference_ts", TIME))
    )


@query
def review_overlay(s: Stages) -> DataFrame:
    return mart.overlay(s.reviewed()).select(
        "unique_id",
        "capability",
        "current_llm_review",
        "structured_hit",
        "claim_hit",
        "prose_hit",
        "screening_only",
        "implausible",
        "capability_scope",
    )


@query
def mart_final(s: Stages) -> DataFrame:
    return (
        s.mart()
        .drop("evidence_json", "heuristic_evidence_json", "explanation", "heuristic_explanation")
        .withColumn("citation_urls", F.array_join("citation_urls", SEPARATOR))
        .withColumn("supporting_snippets_llm", F.array_join("supporting_snippets_llm", SEPARATOR))
        .withColumn("source_snapshot_ts", F.date_format("source_snapshot_ts", TIME))
        .withColumn("inference_ts", F.date_format("inference_ts", TIME))
    )


@query
def explain_final(s: Stages) -> DataFrame:
    return s.mart().select("unique_id", "capability", "tier", "explanation", "heuristic_explanation")


@query
def evidence_document_final(s: Stages) -> DataFrame:
    return s.mart().select("unique_id", "capability", fields("evidence_json", *FINAL_DOCUMENT))


@query
def run_pipeline(s: Stages) -> DataFrame:
    """All stages rebuilt from the raw tables into a store, before any review."""
    raw = pipeline.Raw(s.raw(), s.raw("raw_pincode_directory"), s.raw("raw_district_indicators"))
    store = s.store()
    built = pipeline.rebuild(raw, store, s.folder(), as_of=testdata.AS_OF, snapshot_ts=testdata.SNAPSHOT_TS)
    counted = [f.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("stage"), "n_rows") for name, f in built.items()]
    return reduce(DataFrame.unionByName, counted)


@query
def mart_refresh(s: Stages) -> DataFrame:
    """Signals and mart built anew from stored baseline and inputs after reviews came in."""
    store = s.store()
    graded = grading.grade(s.shared(s.stored_profiles()), as_of=testdata.AS_OF)
    store.write(grading.baseline(graded), "baseline")
    inputs = store.write(review_inputs.inputs(graded, testdata.SNAPSHOT_TS), "inputs")
    pipeline.refresh(store, tables.create_landing(s.spark, s.landing(inputs)))
    return store.read("mart").select(
        "unique_id", "capability", "tier", "score", "explanation", "heuristic_tier", "current_llm_review", "llm_review_status", "run_id"
    )


@query
def mart_update(s: Stages) -> DataFrame:
    """The mart after two runs of reviews came in one by one, the later one first and twice."""
    store = SlicedStore(s.spark, s.folder(), f"mart_{uuid.uuid4().hex}", slices=16)
    # profiles in the same slices: what is graded from them is written where it stands
    profiles = store.write(s.profiles().drop(*UNREAD), "profiles")
    graded = grading.grade(s.shared(profiles), as_of=testdata.AS_OF)
    reviews = materialise(s.present_reviews(profiles).select(*incremental.CURRENT), "reviews")
    late = ("r7", "r3")
    inputs = review_inputs.inputs(graded, testdata.SNAPSHOT_TS)
    incremental.start(store, grading.baseline(graded), inputs, reviews.where(~F.col("run_id").isin(*late)))
    for run_id in (*late, late[0]):
        incremental.update(store, reviews.where(F.col("run_id") == run_id))
    return store.read("mart").select(
        "unique_id", "capability", "tier", "score", "explanation", "heuristic_tier", "current_llm_review", "llm_review_status", "run_id"
    )


# --- serving -------------------------------------------------------------------------


# rows of a page of the ranking, as the page asks for
PAGE = 200
# lengths a drill-down page shows
SHOWN = {"max_snippets": 5, "max_citations": 10, "max_badges": 24}


@query
def serve_regions(s: Stages) -> DataFrame:
    return serve.regions(s.mart())


@query
def serve_ranked(s: Stages) -> DataFrame:
    return serve.ranked(s.mart(), "icu", n=PAGE)


@query
def serve_ranked_all(s: Stages) -> DataFrame:
    return serve.ranked(s.mart(), "icu")


@query
def serve_ranked_region(s: Stages) -> DataFrame:
    return serve.ranked(s.mart(), "maternity", region="Kerala", n=PAGE)


@query
def serve_ranked_tier(s: Stages) -> DataFrame:
    return serve.ranked(s.mart(), "oncology", tier="weak_suspicious", n=PAGE)


@query
def serve_ranked_sorted(s: Stages) -> DataFrame:
    return serve.ranked_sorted(s.mart(), "trauma", sort="district_norm", descending=True, n=PAGE)


@query
def serve_detail(s: Stages) -> DataFrame:
    return serve.detail(s.mart(), s.stored_profiles()).drop("evidence_json")


@query
def serve_detail_one(s: Stages) -> DataFrame:
    return serve.detail(s.mart(), s.stored_profiles(), unique_id="f96", capability="icu").drop("evidence_json")


@query
def serve_detail_compact(s: Stages) -> DataFrame:
    return serve.detail_compact(s.mart()).drop("evidence_json")


@query
def serve_summary(s: Stages) -> DataFrame:
    return serve.summary(s.effective())


@query
def serve_signals(s: Stages) -> DataFrame:
    return texts_of(serve.signals(s.mart_with_flags(), s.stored_profiles()))


@query
def serve_signals_page(s: Stages) -> DataFrame:
    return texts_of(serve.signals(s.mart_with_flags(), s.stored_profiles(), **SHOWN))


@query
def serve_signals_one(s: Stages) -> DataFrame:
    return texts_of(serve.signals(s.mart_with_flags(), s.stored_profiles(), unique_id="f96", capability="icu"))


@query
def overrides_valid(s: Stages) -> DataFrame:
    return overrides.validate(s.raw("override_events"))


@query
def overrides_state(s: Stages) -> DataFrame:
    return overrides.state(s.raw("override_events"))


@query
def overrides_effective(s: Stages) -> DataFrame:
    return s.effective().select(
        "unique_id", "capability", "tier", "effective_tier", "has_local_override", "override_note", "override_ts"
    )


# --- profiles ------------------------------------------------------------------------


@query
def profile_keys(s: Stages) -> DataFrame:
    return profile.keys(s.raw())


@query
def profile_top_groups(s: Stages) -> DataFrame:
    types = profile.top_groups(s.raw(), "facilityTypeId").select(F.lit("type").alias("grouping"), "*")
    regions = profile.top_groups(s.raw(), "address_stateOrRegion", 5).select(F.lit("region").alias("grouping"), "*")
    return types.unionByName(regions)


@query
def profile_groups(s: Stages) -> DataFrame:
    return profile.top_groups(s.raw(), "address_stateOrRegion")


@query
def profile_invalid_codes(s: Stages) -> DataFrame:
    return profile.invalid_codes(s.raw())


@query
def profile_geo_bounds(s: Stages) -> DataFrame:
    return profile.geo_bounds(s.raw())


@query
def profile_null_literals(s: Stages) -> DataFrame:
    return profile.null_literals(s.raw())


@query
def profile_join_quality(s: Stages) -> DataFrame:
    return profile.join_quality(s.raw(), s.bridge(), s.indicators())


@query
def state_consistency(s: Stages) -> DataFrame:
    return consistency.state_consistency(s.entities(), s.bridge())


@query
def profile_keys_merged(s: Stages) -> DataFrame:
    """Distinct counts from sketches of loads (ends of the record number) beside the exact ones."""
    load = F.concat(F.lit("d"), F.right("source_content_id", F.lit(1)))
    made = sketches.sketch(s.raw(), load)
    return sketches.compared(sketches.merged(made), profile.keys(s.raw()))


@query
def coordinate_repair(s: Stages) -> DataFrame:
    # the columns needed are stored, as both the centres and the rows read them
    places = materialise(s.entities().select("unique_id", "pincode", "latitude", "longitude"), "places")
    return coordinates.repair(places)


@query
def citation_quality(s: Stages) -> DataFrame:
    cited = s.entities().select("unique_id", "official_website", "facebook_link", "source_urls_arr", "websites_arr")
    suffixes = s.spark.createDataFrame(testdata.CITATION_SUFFIXES, "suffix string, class string")
    return citations.quality(materialise(cited, "cited"), suffixes)


@query
def profile_capability_by_type(s: Stages) -> DataFrame:
    return profile.capability_by_type(s.raw())


@query
def profile_vocabulary(s: Stages) -> DataFrame:
    return profile.vocabulary(s.raw())


@query
def profile_min_support(s: Stages) -> DataFrame:
    return profile.min_support(s.raw(), profile.VOCABULARY_COLUMNS)
