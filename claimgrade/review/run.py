"""The review run: requests through a pluggable reviewer to landing rows."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimgrade.functions import variants as v
from claimgrade.functions.steps import compute
from claimgrade.functions.text import strip
from claimgrade.review import parse, prompts
from claimgrade.schemas import DEAD_LETTERS, REVIEWS_RAW
from claimgrade.session import materialise, path_exists, shared_folder

# A reviewer gets one pandas frame of requests (request_id, system_prompt,
# user_prompt) and gives back the raw response JSON of each, in the same order.
Reviewer = Callable[[pd.DataFrame], pd.Series]

ROUNDS = 3
# parts in which the answers of one attempt are stored, each complete or not there at all
GROUPS = 4
CALL_FAILED = "call failed: "
# Keys that name the model and its version, in order
MODEL_KEYS = ("model", "served_model_name", "served_entity_name")
VERSION_KEYS = ("model_version", "served_model_version", "served_entity_version")


def call(
    requests: DataFrame,
    reviewer: Reviewer,
    folder: str,
    concurrency: int | None = None,
    groups: int = GROUPS,
    shown: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Answers as ``raw_response_json``, or ``call_error`` where the reviewer raised.

    Answers are paid for and not the same twice. They are appended to ``folder`` in
    ``groups`` committed parts, and requests whose answer lies there already are not
    asked again: a run that died goes on under the same folder. Only answers are stored
    for good; a request whose call failed is asked anew.

    ``concurrency`` is the number of tasks that call at the same time; without it the
    shuffle partitions of the session. ``shown`` puts the prompts to the requests where they
    have none yet: they are made where they are shown, and neither stored nor moved with the answers.
    """
    spark = requests.sparkSession
    tasks = concurrency or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = requests.withColumn("_group", F.pmod(F.xxhash64("request_id"), F.lit(groups)).cast("int"))
    wanted = materialise(dealt, "requests", ("_group",))
    schema = T.StructType(
        [T.StructField(n, T.StringType()) for n in ("request_id", "raw_response_json", "call_error")]
    )
    ask = _asker(reviewer)
    # answers of an earlier run: what is appended below is of other groups
    before = _stored(spark, folder, schema).select("request_id") if path_exists(spark, folder) else None
    for group in range(groups):
        part = wanted.where(F.col("_group") == group)
        if before is not None:
            part = part.join(before, "request_id", "left_anti")
        prompted = (shown(part) if shown else part).select("request_id", "system_prompt", "user_prompt")
        # a given number of parts, which adaptive execution does not put together
        prompted.repartition(tasks, "request_id").mapInPandas(ask, schema).write.mode("append").parquet(folder)
    # an answer that came beside an earlier failure counts
    answers = _stored(spark, folder, schema).groupBy("request_id").agg(
        F.max("raw_response_json").alias("raw_response_json"), F.max("call_error").alias("call_error")
    )
    answers = answers.withColumn("call_error", F.when(F.col("raw_response_json").isNull(), F.col("call_error")))
    return wanted.drop("_group").join(answers, "request_id")


def _asker(reviewer: Reviewer) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """The function of a task. It is local, so that workers need not have this package."""

    def one(asked: pd.DataFrame) -> tuple[str | None, str | None]:
        try:
            return list(reviewer(asked))[0], None
        except Exception as problem:  # whatever a reviewer raises concerns its request only
            return None, f"{type(problem).__name__}: {problem}"

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            try:
                answers = [(a, None) for a in reviewer(frame)]
                if len(answers) != len(frame):
                    raise ValueError(f"{len(answers)} answers to {len(frame)} requests")
            except Exception:
                # one request must not cost the others their answer: ask one by one
                answers = [one(frame.iloc[i : i + 1]) for i in range(len(frame))]
            columns = {"raw_response_json": [a for a, _ in answers], "call_error": [e for _, e in answers]}
            yield pd.DataFrame({"request_id": frame["request_id"].to_numpy(), **columns}).astype(object)

    return ask


def _stored(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """Answers in a folder; failed calls are left out where an answer is there."""
    if not path_exists(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(folder)


def run(
    requests: DataFrame,
    reviewer: Reviewer,
    run_id: str,
    batch: bool = True,
    rounds: int = ROUNDS,
    template: str | None = None,
    answers: str | None = None,
    concurrency: int | None = None,
    groups: int = GROUPS,
) -> DataFrame:
    """Ask, parse, repair; repeat at most ``rounds`` times for what still fails.

    Returns the parsed requests: ``records`` where an answer was valid, else
    ``error`` of the last try. ``raw_response_json`` is the answer to the request
    itself also where the record came from a repair. A call that fails is asked again
    in the next round. For a whole entity every invalid answer is repaired; a single
    row is, when its answer holds no readable object.

    ``answers`` is a folder for what the reviewer said; run again under the same
    folder and ``run_id``, only what is missing is asked.
    """
    kind = "facility" if batch else "row"
    key = F.concat_ws(":", F.lit(run_id), F.lit(kind), "unique_id", F.array_join("capabilities", "+"))
    folder = answers or f"{shared_folder(requests.sparkSession).rstrip('/')}/claimgrade/answers-{uuid.uuid4().hex}"
    open_requests = requests.withColumn("base_id", key)

    def prompted(frame: DataFrame) -> DataFrame:
        return prompts.render(frame, batch, template)

    def asked(frame: DataFrame, name: str, shown: Callable[[DataFrame], DataFrame] = prompted) -> DataFrame:
        said = call(frame, reviewer, f"{folder.rstrip('/')}/{kind}/{run_id}/{name}", concurrency, groups, shown)
        parsed = parse.parse(said, batch)
        failed = F.concat(F.lit(CALL_FAILED), F.col("call_error"))
        return parsed.withColumn("error", F.coalesce(failed, "error")).drop("call_error")

    done: list[DataFrame] = []
    for attempt in range(1, rounds + 1):
        named = open_requests.withColumn("request_id", F.concat("base_id", F.lit(f":attempt{attempt}")))
        first = materialise(asked(named, f"attempt{attempt}"), "parsed")
        done.append(first.where("error IS NULL"))
        failed = first.where("error IS NOT NULL")
        if failed.isEmpty():
            break
        can = _repairable(batch)
        second = materialise(
            failed.where(~can).unionByName(_repair(failed.where(can), lambda f, shown: asked(f, f"repair{attempt}", shown), batch)),
            "repaired",
        )
        done.append(second.where("error IS NULL"))
        failed = second.where("error IS NOT NULL")
        if attempt == rounds or failed.isEmpty():
            done.append(failed)
            break
        open_requests = failed.select(*open_requests.columns)
    # the prompts follow from the request: whoever wants them beside the answer has them made again
    return prompted(_union(done))


def _repairable(batch: bool) -> Column:
    """A failed request that has an answer to repair."""
    answered = F.col("raw_response_json").isNotNull()
    return answered if batch else answered & F.col("error").isin(parse.NO_TEXT, parse.NO_OBJECT, parse.NOT_AN_OBJECT)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def _repair(failed: DataFrame, ask: Callable[[DataFrame, Callable[[DataFrame], DataFrame]], DataFrame], batch: bool) -> DataFrame:
    """One more call that only has to bring the previous answer into form."""
    kept = {"raw_response_json": "_raw", "request_id": "_id"}
    asked = (
        failed.withColumnsRenamed(kept)
        .withColumns({"_prior": F.coalesce("assistant_text", "_raw"), "request_id": F.concat("_id", F.lit(":repair"))})
        .drop("assistant_text", "error", "records")
    )

    def shown(frame: DataFrame) -> DataFrame:
        prompt = prompts.repair_prompt(F.col("_prior"), batch)
        return frame.withColumns({"system_prompt": F.lit(prompts.REPAIR_SYSTEM), "user_prompt": prompt})

    parsed = ask(asked, shown)
    return parsed.drop("_prior", *kept).withColumnsRenamed({v: k for k, v in kept.items()})


def with_model(answered: DataFrame) -> DataFrame:
    """Add ``model_name`` and ``model_version``, wherever in the response they are named.

    Each is the first text that is not blank under one of its keys, the nearest level
    first and then depth first in the order of the document. At the root, where nearly
    all responses name them, that needs no order and is read from the VARIANT. Python,
    which keeps the order of the document, sees a text only if something is missing at
    the root and one of its keys occurs further down.
    """
    response = F.col("raw_response_json")
    read = compute(answered, _root=F.try_parse_json(response))

    def at_root(keys: tuple[str, ...]) -> Column:
        named = [strip(v.string_at(F.col("_root"), f"$.{k}")) for k in keys]
        return F.coalesce(*[F.when(n != "", n) for n in named])

    near = compute(read, _name=at_root(MODEL_KEYS), _version=at_root(VERSION_KEYS)).drop("_root")

    def deeper(found: str, keys: tuple[str, ...]) -> Column:
        quoted = "|".join(keys)
        return F.col(found).isNull() & response.rlike(f'"({quoted})"')

    asked = F.when(deeper("_name", MODEL_KEYS) | deeper("_version", VERSION_KEYS), response)
    searched = near.withColumn("_far", _search()(asked))
    return searched.withColumns(
        {
            "model_name": F.coalesce("_name", "_far.model_name"),
            "model_version": F.coalesce("_version", "_far.model_version"),
        }
    ).drop("_name", "_version", "_far")


def _search() -> Callable[[Column], Column]:
    """Both names in one walk over the parsed text. Local, so that workers need not have this package."""
    wanted = {"model_name": MODEL_KEYS, "model_version": VERSION_KEYS}

    def walk(text: str) -> dict[str, str]:
        found: dict[str, str] = {}
        try:
            todo = [json.loads(text)]
        except ValueError:
            return found
        while todo and len(found) < len(wanted):
            here = todo.pop()
            if isinstance(here, dict):
                texts = {k: t.strip() for k, t in here.items() if isinstance(t, str)}
                for column in wanted.keys() - found.keys():
                    named = [texts[k] for k in wanted[column] if texts.get(k)]
                    found.update({column: n for n in named[:1]})
                here = list(here.values())
            if isinstance(here, list):
                # the first child is looked at next
                todo += here[::-1]
        return found

    @F.pandas_udf("model_name string, model_version string")
    def both(texts: pd.Series) -> pd.DataFrame:
        found = [walk(t) if t else {} for t in texts]
        return pd.DataFrame({c: [f.get(c) for f in found] for c in wanted}, dtype=object)

    return both


def rows(
    parsed: DataFrame, run_id: Column | str, prompt_version: Column | str, target: str, inference_ts: Column
) -> DataFrame:
    """Landing rows of the valid answers, one per requested capability.

    The model is read once per answer, before the answer is split.
    """
    split = parse.split(with_model(parsed.where("error IS NULL"))).withColumns(
        {
            "prompt_version": _lit(prompt_version),
            "model_name": F.coalesce("model_name", F.lit(target)),
            "run_id": _lit(run_id),
            "source_snapshot_ts": F.col("source_snapshot_ts").cast("timestamp"),
            "inference_ts": F.date_trunc("second", inference_ts),
        }
    )
    return split.select(*[f.name for f in REVIEWS_RAW])


def _lit(c: Column | str) -> Column:
    return F.lit(c) if isinstance(c, str) else c


def dead_letters(
    parsed: DataFrame,
    run_id: Column | str,
    prompt_version: Column | str,
    provider: str,
    target: str,
    at: Column,
    batch_number: int = 1,
) -> DataFrame:
    """One record per request that failed for good."""
    return (
        parsed.where("error IS NOT NULL")
        .withColumns(
            {
                "run_id": _lit(run_id),
                "batch_number": F.lit(batch_number),
                "prompt_version": _lit(prompt_version),
                "provider": F.lit(provider),
                "target": F.lit(target),
                "timestamp_utc": at,
            }
        )
        .select(*[f.name for f in DEAD_LETTERS])
    )


def failed_keys(letters: DataFrame, run_id: str) -> DataFrame:
    """Keys given up in a run, one row each, for the next pending selection."""
    return letters.where(F.col("run_id") == run_id).select(
        "unique_id", F.explode("capabilities").alias("capability")
    )


def summary(parsed: DataFrame) -> DataFrame:
    """Counters per run: requests, rows covered, rows written, failed requests."""
    ok = F.col("error").isNull()
    asked = F.size("capabilities")
    return parsed.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("requests"),
        F.sum(asked).alias("covered_rows"),
        F.sum(F.when(ok, asked).otherwise(0)).alias("written_rows"),
        F.count_if(~ok).alias("failed_requests"),
    )
