"""From a reviewer's raw answer to validated records.

Everything is a column expression: the answer is read as a VARIANT, and each field
is looked at with its JSON type before it is converted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimgrade.config import SCOPES
from claimgrade.functions import variants as v
from claimgrade.functions.steps import compute, let
from claimgrade.functions.text import WHITE_SPACE, strip

# Texts read as booleans, and the fields a record may have
TRUE_TEXTS = ("1", "on", "t", "true", "y", "yes")
FALSE_TEXTS = ("0", "off", "f", "false", "n", "no")
SIGNAL_FIELDS = (
    "claim_hit",
    "prose_hit",
    "screening_only",
    "capability_scope",
    "supporting_snippets",
    "confidence",
    "reasoning",
)
BOOLEAN_FIELDS = SIGNAL_FIELDS[:3]
FLAT_KEYS = ("output_text", "response", "result", "text", "content")
NUMBER_TEXT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"

NO_TEXT = "no assistant text in the response"
NO_OBJECT = "the answer holds no JSON object"
NOT_AN_OBJECT = "the JSON of the answer is not an object"


# --- assistant text ----------------------------------------------------------


def _content_text(content: Column) -> Column:
    """Text of a message: a string, or the text parts of a list of blocks."""
    blocks = v.array_at(content, "$")
    texts = F.transform(
        F.filter(blocks, lambda b: v.string_at(b, "$.type") == "text"),
        lambda b: v.string_at(b, "$.text"),
    )

    def other(block: Column) -> Column:
        own = F.when(
            ~F.coalesce(v.string_at(block, "$.type") == "text", F.lit(False)), v.string_at(block, "$.text")
        )
        summaries = F.transform(
            F.coalesce(v.array_at(block, "$.summary"), F.array().cast(v.ANY_ARRAY)),
            lambda s: v.string_at(s, "$.text"),
        )
        return F.concat(F.array(own), summaries)

    others = F.flatten(F.transform(blocks, other))
    joined = F.coalesce(
        _non_empty(F.array_join(texts, "")),
        _non_empty(F.array_join(F.array_compact(others), "\n")),
    )
    return F.when(v.is_string(content), _non_empty(F.try_variant_get(content, "$", "string"))).otherwise(joined)


def _non_empty(c: Column) -> Column:
    return F.when(c != "", c)


def assistant_text(response: Column) -> Column:
    """The first text found in the known response shapes; NULL when there is none."""
    outputs = F.transform(
        v.array_at(response, "$.output"),
        lambda item: F.coalesce(_content_text(v.at(item, "$.content")), v.string_at(item, "$.text")),
    )
    return F.coalesce(
        _content_text(v.at(response, "$.choices[0].message.content")),
        v.string_at(response, "$.choices[0].text"),
        F.get(F.array_compact(outputs), F.lit(0)),
        v.string_at(response, "$.predictions[0]"),
        v.string_at(response, "$.predictions[0].content"),
        v.string_at(response, "$.predictions[0].text"),
        *[v.string_at(response, f"$.{k}") for k in FLAT_KEYS],
    )


def extract_text(responses: DataFrame) -> DataFrame:
    """Add ``assistant_text`` and ``error`` from ``raw_response_json``."""
    read = compute(responses, _response=F.try_parse_json("raw_response_json"))
    found = compute(read, assistant_text=assistant_text(F.col("_response"))).drop("_response")
    return found.withColumn("error", F.when(F.col("assistant_text").isNull(), F.lit(NO_TEXT)))


# --- JSON object -------------------------------------------------------------


def unfenced(text: Column) -> Column:
    """Drop a code fence around the whole text."""
    fence = r"(?s)^```[^\n\r]*\R(.*)\R[^\n\r]*```$"
    # trimming walks over the whole text, so that is done once, and only where an end has something to trim
    ends = [F.contains(F.lit(WHITE_SPACE), end) for end in (F.left(text, F.lit(1)), F.right(text, F.lit(1)))]
    return let(
        F.when(ends[0] | ends[1], strip(text)).otherwise(text),
        lambda t: F.when(t.rlike(fence), strip(F.regexp_extract(t, fence, 1))).otherwise(t),
    )


def extract_object(texts: DataFrame) -> DataFrame:
    """Add ``payload`` (VARIANT object or NULL) and complete ``error``.

    When the text as a whole is not JSON, the part from the first opening to the
    last closing brace is tried.
    """
    braces = r"(?s)\{.*\}"
    clean = compute(texts, _clean=unfenced(F.col("assistant_text")))
    whole = compute(clean, _whole=v.parse(F.col("_clean")))
    part = F.when(F.col("_whole").isNull(), v.parse(F.regexp_extract("_clean", braces, 0)))
    value = compute(whole, _value=F.coalesce("_whole", part))
    ok = v.is_object(F.col("_value"))
    problem = F.coalesce(
        "error",
        F.when(F.col("_value").isNull(), F.lit(NO_OBJECT)),
        F.when(~ok, F.lit(NOT_AN_OBJECT)),
    )
    return compute(value, payload=F.when(ok, F.col("_value")), error=problem).drop("_clean", "_whole", "_value")


# --- records -----------------------------------------------------------------


_TEXTS = "struct<" + ", ".join(
    f"{f}: {'variant' if f == 'supporting_snippets' else 'string'}" for f in (*SIGNAL_FIELDS, "capability")
) + ">"
_NUMBERS = ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT")


def signal(record: Column) -> Column:
    """A record as a struct, with ``problem`` set when it breaks a rule.

    Null or absent is allowed everywhere but in the snippets, which may only be
    absent. Booleans and numbers may be written as text. Unknown keys are refused.

    The JSON types are taken from one description of the whole record and the values
    from one conversion of it. A description of something nested can be mistaken for
    one of a field, but no field may hold anything nested, so that is refused anyway.
    """
    read = F.struct(
        v.kind(record).alias("kinds"),
        F.try_variant_get(record, "$", _TEXTS).alias("texts"),
        v.keys(record).alias("keys"),
    )

    def typed(r: Column) -> Column:
        kinds = [F.regexp_extract(r["kinds"], rf"\b{f}: ([A-Z]+)", 1).alias(f) for f in (*SIGNAL_FIELDS, "capability")]
        return F.struct(
            F.struct(*kinds).alias("kind"),
            r["texts"].alias("text"),
            F.try_variant_get(r["texts"]["supporting_snippets"], "$", "array<string>").alias("snippets"),
            r["kinds"].rlike(r"\bsupporting_snippets: ARRAY<(STRING|VOID)>").alias("strings"),
            r["keys"].alias("keys"),
        )

    def valued(r: Column) -> Column:
        kind, text = r["kind"], r["text"]
        values = {f: _boolean(kind[f], text[f]) for f in BOOLEAN_FIELDS}
        values["capability_scope"] = F.when(
            (kind["capability_scope"] == "STRING") & text["capability_scope"].isin(*SCOPES), text["capability_scope"]
        )
        snippets = F.filter(F.transform(r["snippets"], strip), lambda t: t != "")
        values["supporting_snippets"] = F.coalesce(snippets, F.array().cast("array<string>"))
        values["confidence"] = _share(kind["confidence"], text["confidence"])
        values["reasoning"] = F.when(kind["reasoning"] == "STRING", text["reasoning"])
        named = F.when(kind["capability"] == "STRING", text["capability"])
        return F.struct(
            *[c.alias(f) for f, c in values.items()],
            named.alias("named"),
            F.array_contains(r["keys"], F.lit("capability")).alias("has_name"),
            kind.alias("kind"),
            r["keys"].alias("keys"),
            (r["strings"] & ~F.exists(r["snippets"], F.isnull)).alias("strings"),
        )

    known = F.array(*[F.lit(f) for f in (*SIGNAL_FIELDS, "capability")])

    def judged(r: Column) -> Column:
        checks = {
            f: r["kind"][f].isin("", "VOID") | r[f].isNotNull() for f in SIGNAL_FIELDS if f != "supporting_snippets"
        }
        checks["supporting_snippets"] = (r["kind"]["supporting_snippets"] == "") | F.coalesce(
            r["strings"], F.lit(False)
        )
        unknown = F.array_join(F.array_except(r["keys"], known), ", ")
        problem = F.concat_ws(
            "; ",
            F.when(r["keys"].isNull(), "not an object"),
            F.concat(F.lit("unknown keys: "), _non_empty(unknown)),
            *[F.when(~checks[f], F.lit(f"bad {f}")) for f in SIGNAL_FIELDS],
        )
        return F.struct(
            *[r[f].alias(f) for f in SIGNAL_FIELDS],
            r["named"].alias("named"),
            r["has_name"].alias("has_name"),
            _non_empty(problem).alias("problem"),
        )

    return let(let(let(read, typed), valued), judged)


def _boolean(kind: Column, text: Column) -> Column:
    as_text = F.lower(text)
    number = text.try_cast("double")
    return (
        F.when(kind == "BOOLEAN", text == "true")
        .when(kind.isin(*_NUMBERS) & number.isin(0.0, 1.0), number == 1.0)
        .when((kind == "STRING") & as_text.isin(*TRUE_TEXTS), F.lit(True))
        .when((kind == "STRING") & as_text.isin(*FALSE_TEXTS), F.lit(False))
    )


def _share(kind: Column, text: Column) -> Column:
    """A number from 0 to 1, also written as text or as a boolean; else NULL."""
    number = (
        F.when(kind == "BOOLEAN", F.when(text == "true", F.lit(1.0)).otherwise(F.lit(0.0)))
        .when(kind.isin(*_NUMBERS), text.try_cast("double"))
        .when((kind == "STRING") & F.trim(text).rlike(NUMBER_TEXT), F.trim(text).try_cast("double"))
    )
    return let(number, lambda n: F.when(n.between(0.0, 1.0), n))


def validate_single(objects: DataFrame) -> DataFrame:
    """One record per answer: add ``records`` (one struct per requested capability)."""
    checked = compute(objects, _signal=F.when(F.col("error").isNull(), signal(F.col("payload"))))
    # a single record has no place for a capability name
    extra = F.when(F.col("_signal.has_name"), F.lit("unknown keys: capability"))
    problem = _non_empty(F.concat_ws("; ", F.col("_signal.problem"), extra))
    record = F.struct(
        F.get("capabilities", F.lit(0)).alias("capability"), *[F.col(f"_signal.{f}") for f in SIGNAL_FIELDS]
    )
    judged = compute(checked, error=F.coalesce("error", problem))
    return judged.withColumn("records", F.when(F.col("error").isNull(), F.array(record))).drop(
        "_signal", "payload"
    )


def validate_batch(objects: DataFrame) -> DataFrame:
    """One record per requested capability, or an error for the whole answer.

    Records are matched to requests without regard to case; of several records for
    one capability the last counts, and records nobody asked for are ignored.
    """
    results = v.at(F.col("payload"), "$.results")

    def keyed(item: Column) -> Column:
        return let(
            signal(item),
            lambda s: F.struct(
                F.lower(strip(s["named"])).alias("key"),
                F.coalesce(
                    s["problem"], F.when(s["named"].isNull(), F.lit("a result without capability"))
                ).alias("problem"),
                F.struct(*[s[f].alias(f) for f in SIGNAL_FIELDS]).alias("record"),
            ),
        )

    def last(capability: Column) -> Column:
        # lower case is made once per capability, not once per pair of a capability and a result
        same = let(
            F.lower(capability), lambda name: F.filter("_results", lambda r: F.coalesce(r["key"] == name, F.lit(False)))
        )
        return F.struct(
            capability.alias("capability"), F.try_element_at(same, F.lit(-1))["record"].alias("record")
        )

    read = compute(
        objects,
        _results=F.transform(v.array_at(results, "$"), keyed),
        _unknown=_non_empty(
            F.array_join(F.array_except(v.keys(F.col("payload")), F.array(F.lit("results"))), ", ")
        ),
        _listed=v.is_array(results),
    )
    matched = compute(read, _matched=F.transform("capabilities", last))
    bad = F.array_compact(F.transform("_results", lambda r: r["problem"]))
    missing = F.array_sort(
        F.transform(F.filter("_matched", lambda m: m["record"].isNull()), lambda m: m["capability"])
    )
    problem = F.concat_ws(
        "; ",
        F.concat(F.lit("unknown keys: "), F.col("_unknown")),
        F.when(~F.col("_listed"), F.lit("no list of results")),
        _non_empty(F.array_join(bad, "; ")),
        F.when(
            F.col("_listed"),
            F.concat(F.lit("missing capabilities: "), _non_empty(F.array_join(missing, ", "))),
        ),
    )
    judged = compute(matched, error=F.coalesce("error", _non_empty(problem)))
    records = F.transform(
        "_matched",
        lambda m: F.struct(m["capability"].alias("capability"), *[m["record"][f].alias(f) for f in SIGNAL_FIELDS]),
    )
    return judged.withColumn("records", F.when(F.col("error").isNull(), records)).drop(
        "_results", "_unknown", "_listed", "_matched", "payload"
    )


def parse(responses: DataFrame, batch: bool = True) -> DataFrame:
    """Raw answers -> ``records`` or ``error``, one row per request."""
    objects = extract_object(extract_text(responses))
    return validate_batch(objects) if batch else validate_single(objects)


def split(parsed: DataFrame) -> DataFrame:
    """One row per requested capability of the valid answers, with ``parsed_json``."""
    document = F.struct(*[F.col(f"_pair.records.{f}") for f in SIGNAL_FIELDS])
    asked = ("capability", "evidence_fingerprint", "source_snapshot_ts")
    return (
        parsed.where(F.col("error").isNull())
        .withColumn("_pair", F.explode(F.arrays_zip("requested", "records")))
        .withColumns(
            {
                **{name: F.col(f"_pair.requested.{name}") for name in asked},
                "parsed_json": F.to_json(document, {"ignoreNullFields": "false"}),
            }
        )
        .drop("_pair")
    )
