"""The mart kept up to date after new reviews, at the cost of what they touch.

Four tables sliced by entity: ``baseline`` and ``inputs`` (rewritten by a rebuild only), ``current`` (the latest
review of every key) and ``mart``; a fifth, ``changed``, holds the keys of the last update. New reviews are merged
into the slices of their entities and only these slices of the mart are written again: rows of keys with a new
review are made anew, the others are taken over as they stand. The history of reviews is never read.

The latest review is a maximum in a total order, so it does not matter in which order runs arrive, or
whether one arrives twice. ``current`` is replaced before the mart. An update notes its slices before it changes
any, and takes the note back at its end: after one that died, the next makes its slices of the mart whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimgrade.config import FACILITY, GradingConfig
from claimgrade.operators import mart
from claimgrade.review import signals
from claimgrade.review.pending import KEY
from claimgrade.session import materialise, tune
from claimgrade.sources.slices import SlicedStore

CURRENT = (*KEY, "evidence_fingerprint", *signals.PROVENANCE, "parsed_json")
# what the mart needs of the inputs
JUDGED = (*KEY, "heuristic_tier", "heuristic_score", "heuristic_explanation", "evidence_fingerprint")


def start(store: SlicedStore, baseline: DataFrame, inputs: DataFrame, reviews: DataFrame, cfg: GradingConfig = FACILITY) -> DataFrame:
    """Store all four tables from a rebuilt baseline, its review inputs and the reviews so far."""
    tune(store.spark)
    store.write(baseline, "baseline")
    store.write(inputs.select(*JUDGED), "inputs")
    store.write(signals.latest(reviews).select(*CURRENT), "current")
    return store.write(joined(store, cfg=cfg), "mart")


def joined(store: SlicedStore, touched: Sequence[int] | None = None, cfg: GradingConfig = FACILITY) -> DataFrame:
    """The mart of all slices, or of the ``touched`` ones. Joins stay within slices: nothing moves."""
    found = signals.signals(store.read("inputs", touched), store.read("current", touched))
    return mart.final_from_tables(store.read("baseline", touched), found, cfg)


def renewed(store: SlicedStore, touched: Sequence[int], cfg: GradingConfig = FACILITY) -> DataFrame:
    """``joined`` of the ``touched`` slices where only rows of the keys in ``changed`` are made anew. Rows stay in
    their slices and meet a hash table of the changed keys of their slice; none of the mart's are sorted."""
    changed = store.read("changed", touched).select(*KEY).hint("shuffle_hash")
    baseline, inputs, current = (store.read(t, touched).join(changed, KEY, "left_semi") for t in ("baseline", "inputs", "current"))
    made = mart.final_from_tables(baseline, signals.signals(inputs, current), cfg)
    kept = store.read("mart", touched).join(changed, KEY, "left_anti").select(*made.columns)
    return kept.unionByName(made)


def news(store: SlicedStore, arrived: DataFrame) -> DataFrame:
    """Keys whose latest review is one of the ``arrived``: a review that is older than the one at hand, or is that
    one again, changes nothing. A review without an id is news always, and reaches no row."""
    keys = arrived.select(*KEY).distinct()
    held = store.read("current", store.touched(arrived)).select(*CURRENT).join(keys.hint("shuffle_hash"), KEY, "left_semi")
    both = held.withColumn("_new", F.lit(False)).unionByName(arrived.withColumn("_new", F.lit(True)))
    return signals.latest(both, also=("_new",)).where("_new").select(*KEY)


def update(store: SlicedStore, new: DataFrame, cfg: GradingConfig = FACILITY) -> list[int]:
    """Merge ``new`` reviews and make their rows of the mart again; the slices written, in order.

    Reviews of entities that have no input are kept in ``current`` and reach no row, as in a full
    rebuild. Without a review that becomes the latest of its key nothing is written.
    """
    tune(store.spark)
    arrived = materialise(new.select(*CURRENT), "arrived")
    changed = store.write(news(store, arrived), "changed")
    touched, died = store.touched(changed), store.begun("mart")
    every = sorted({*touched, *died})
    if not every:
        return every
    store.begin("mart", every)
    if touched:
        of_touched = arrived.where(store.slice_of().isin(touched))
        merged = signals.latest(store.read("current", touched).select(*CURRENT).unionByName(of_touched))
        store.replace(merged, "current", touched)
    # rows of slices that an update left half done are not taken over, but made from the other three tables
    made = joined(store, every, cfg) if died else renewed(store, touched, cfg)
    store.replace(made, "mart", every, like="baseline")
    store.begin("mart", [])
    return every
