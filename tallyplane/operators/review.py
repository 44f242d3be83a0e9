"""Review and release: what must be confirmed, who may, what is withheld, and what may go through without a person."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import canonical_json
from .grid import union_all
from .tiers import CELL_CONFIRMATION, FINALIZABLE

#: Artefacts that each mode of review needs.
ARTIFACTS = {"BAR_MONO_GEOMETRY_RESOLVED": ("OVERLAY", "GEOMETRY", "RESOLUTION"), "BAR_MONO_GEOMETRY": ("OVERLAY", "GEOMETRY"), "OVERLAY": ("OVERLAY",), "WPD_ONLY": ("WPD_PROJECT",)}


def review_mode(has_geometry: Column, resolved: Column, has_overlay: Column) -> Column:
    return F.when(has_geometry & resolved, "BAR_MONO_GEOMETRY_RESOLVED").when(has_geometry, "BAR_MONO_GEOMETRY").when(has_overlay, "OVERLAY").otherwise("WPD_ONLY")


def missing_artifacts(queue: DataFrame, artifacts: DataFrame) -> DataFrame:
    """(panel, missing) for queue rows (panel, mode) whose ledger (panel, type) lacks what the mode needs."""
    need = F.create_map(*[x for m, a in ARTIFACTS.items() for x in (F.lit(m), F.array(*[F.lit(t) for t in a]))])
    have = artifacts.groupBy("panel").agg(F.collect_set("type").alias("_h"))
    q = queue.join(have, "panel", "left").withColumn("missing", F.array_sort(F.array_except(F.try_element_at(need, F.col("mode")), F.coalesce("_h", F.array().cast("array<string>")))))
    return q.where(F.size("missing") > 0).select("panel", "missing")


def inference_ids(values: DataFrame, canonical: bool = True) -> DataFrame:
    """Cells that a person must confirm, each with an id made of its content: any change of it asks anew.

    The content is canonical JSON, so no two contents share an id. Ids recorded before were made of joined fields, where a bar in a field or a
    blank for a null may give two rows one id: canonical=False makes those, to read old records only.
    """
    fields = ("panel", "unit", "cell", "identity_method", "value_method", "dispersion_method", "value")
    text = canonical_json({c: F.col(c) for c in fields}) if canonical else F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in fields])
    return values.where(F.col("tier").isin(*CELL_CONFIRMATION, "R2")).withColumn("inference_id", F.sha2(text, 256))


def blocked_by_method(values: DataFrame) -> DataFrame:
    return values.where(~F.col("tier").isin(*FINALIZABLE)).withColumn("block", F.lit("MODEL_ESTIMATE_ONLY"))


def finalize(values: DataFrame, blamed: DataFrame, approved: DataFrame, answers: DataFrame, declared: DataFrame, demo: bool = False) -> DataFrame:
    """values with released and the first reason against it.

    blamed: unit. approved: panel, approved. declared and answers: inference_id (with panel), answers with confirmed. A panel whose answers are not exactly its
    declared ids is withheld whole; a cell that was refused is withheld alone.
    """
    told = answers.select("inference_id", "confirmed", F.col("panel").alias("_ap"))
    both = declared.select("inference_id", "panel").join(told, "inference_id", "full")
    broken = both.where(F.col("confirmed").isNull() | F.col("panel").isNull()).select(F.coalesce("panel", "_ap").alias("panel")).distinct().withColumn("_broken", F.lit(True))
    refused = answers.where("not confirmed").select("inference_id").distinct().withColumn("_refused", F.lit(True))
    v = values.join(blamed.select("unit").distinct().withColumn("_blamed", F.lit(True)), "unit", "left").join(approved.select("panel", F.col("approved").alias("_ok")), "panel", "left").join(broken, "panel", "left")
    v = v.join(refused, "inference_id", "left")
    reason = (
        F.when(F.lit(demo), "DEMO_ONLY")
        .when(F.col("_blamed").isNotNull(), "QC_FAILED")
        .when(~F.coalesce("_ok", F.lit(False)), "NOT_APPROVED")
        .when(F.col("_broken").isNotNull(), "INFERENCE_SET_INCOMPLETE")
        .when(~F.coalesce(F.col("tier").isin(*FINALIZABLE), F.lit(False)), "MODEL_ESTIMATE_ONLY")
        .when(F.col("_refused").isNotNull(), "INFERENCE_REFUSED")
    )
    return v.withColumn("released", reason.isNull()).withColumn("reason", reason).drop("_blamed", "_ok", "_broken", "_refused")


def disagreements(first: DataFrame, second: DataFrame, key: str, decision: str) -> DataFrame:
    """Keys that two reviewers decided differently, after trimming and case; one side's silence is none."""
    a, b = (df.select(key, F.upper(F.trim(decision)).alias(n)) for df, n in ((first, "first"), (second, "second")))
    return a.join(b, key).where(~F.col("first").eqNullSafe(F.col("second")))


def cross_check(items: DataFrame, cards: DataFrame, max_rounds: int | None = None) -> DataFrame:
    """(item, to, code): AUTO only if the second look agrees, with confidence and evidence, and no card is shared with an item that goes to a person.

    items: item, person_only, proposal, options, choice, confidence, evidence, text, v_text. cards: item, card. Sharing spreads until nothing moves; each round is a join over the cards. With max_rounds, it is an error if something still moves after them.
    """
    norm = lambda c: F.lower(F.regexp_replace(F.trim(F.coalesce(F.col(c), F.lit(""))), r"\s+", " "))
    choice = F.upper(F.trim("choice"))
    code = (
        F.when(F.col("person_only"), "PERSON_ONLY")
        .when(F.col("choice").isNull(), "NO_VERDICT")
        .when(choice == "HOLD", "VERIFIER_HELD")
        .when(~F.array_contains("options", choice), "UNKNOWN_CHOICE")
        .when(choice != F.col("proposal"), "DISAGREE")
        .when(~F.coalesce(F.upper(F.trim("confidence")) == "HIGH", F.lit(False)), "LOW_CONFIDENCE")
        .when(F.trim(F.coalesce("evidence", F.lit(""))) == "", "NO_EVIDENCE")
        .when(norm("text") != norm("v_text"), "TEXT_DIFFERS")
    )
    state = items.select("item", code.alias("code"))
    rounds = 0
    while True:
        held = cards.join(state.where("code is not null"), "item").select("card").distinct()
        hit = cards.join(held, "card", "left_semi").select("item").distinct()
        moved = state.where("code is null").join(hit, "item", "left_semi").select("item")
        if not moved.limit(1).count():
            break
        if max_rounds is not None and rounds >= max_rounds:
            raise RuntimeError(f"sharing still spreads after {max_rounds} rounds")
        rounds += 1
        state = state.join(moved.withColumn("_m", F.lit("SHARED_CARD")), "item", "left").select("item", F.coalesce("code", "_m").alias("code")).checkpoint()
    return state.select("item", F.when(F.col("code").isNull(), "AUTO").otherwise("PERSON").alias("to"), F.coalesce("code", F.lit("AGREE")).alias("code"))


def upsert(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """New rows replace those of their key."""
    return union_all([existing.join(new.select(key).distinct(), key, "left_anti"), new])
