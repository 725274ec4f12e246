"""Review loop: cases from flags, append-only reviews and status events, versioned labels."""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas
from ..config import ConfigError, Settings
from ..functions import scalars as S
from ..operators.guards import ContractError, require_none, require_unique
from ..sources.commits import CommitLog
from ..sources.tables import exists, write_text

# Decisions, fraud types, case states and sources.
DECISIONS = ("true_positive", "false_positive", "needs_more_review", "insufficient_evidence")
TRAINABLE = ("true_positive", "false_positive")
FRAUD_TYPES = ("multi_accounting", "payment_fraud", "betting_anomaly", "other")
STATES = ("open", "in_review", "closed")
MODEL, HUMAN = "model_flagged", "human_discovered"


def new_run_id(settings: Settings, snapshot: str, now: datetime | None = None) -> str:
    """Time, rule version, snapshot and a random end, safe as a folder name."""
    at = (now or datetime.now(timezone.utc)).strftime("%Y%m%dT%H%M%SZ")
    return "-".join(re.sub(r"[^A-Za-z0-9._]+", "_", x) for x in (at, settings.ruleset_version, snapshot, uuid.uuid4().hex[:8]))


def _cases(rows: DataFrame, run_id: str, source: str, settings: Settings, snapshot: str, created: Column | None, available: Column) -> DataFrame:
    """Cases with what the model said of the player; a player that it has not seen has no scores, no band and was not routed."""
    text = lambda c, empty: F.coalesce(F.col(c), F.lit(empty)).alias(c)
    made = {
        "case_id": S.hashed_id("case_", F.lit(run_id), F.col("player_key"), F.lit(source)), "run_id": F.lit(run_id), "created_at": created if created is not None else F.current_timestamp(), "fired_rules": text("fired_rules", "[]"),
        "unmeasured_features": text("unmeasured_features", "[]"), "feature_snapshot": text("feature_snapshot", "{}"), "status": F.lit("open"), "ruleset_version": F.lit(settings.ruleset_version), "snapshot_id": F.lit(snapshot),
        "detection_source": F.lit(source), "model_output_available": available, "model_routed": F.coalesce(F.col("band").isin(*settings.routing_bands), F.lit(False)),
    }
    return rows.select(*(made[f.name].alias(f.name) if f.name in made else F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.CASES))


def route(flags: DataFrame, run_id: str, settings: Settings, snapshot: str, created: Column | None = None) -> DataFrame:
    """A case for every flag whose band is routed."""
    return _cases(flags.where(F.col("band").isin(*settings.routing_bands)), run_id, MODEL, settings, snapshot, created, F.lit(True))


def human_cases(requests: DataFrame, flags: DataFrame, run_id: str, settings: Settings, snapshot: str, created: Column | None = None) -> DataFrame:
    """Cases that people opened, with what the model said of the player at that time, or nothing."""
    known = flags.drop("fired_rule_ids").withColumn("_seen", F.lit(True))
    rows = requests.select("player_key").distinct().join(known, "player_key", "left")
    return _cases(rows, run_id, HUMAN, settings, snapshot, created, F.coalesce("_seen", F.lit(False)))


def unrouted_player(flags: DataFrame, settings: Settings) -> DataFrame:
    """The first player, by key, that the model did not route: one row (player_key), or none."""
    return flags.where(~F.coalesce(F.col("band").isin(*settings.routing_bands), F.lit(False))).orderBy("player_key").limit(1).select("player_key")


def check_reviews(reviews: DataFrame) -> None:
    allowed = F.coalesce(F.col("decision").isin(*DECISIONS), F.lit(False)) & (F.col("fraud_type").isNull() | F.col("fraud_type").isin(*FRAUD_TYPES))
    require_none(reviews.where(~allowed).select("case_id", "decision", "fraud_type"), "unknown decision or fraud type")


def with_ids(reviews: DataFrame) -> DataFrame:
    """Reviews with ids that depend on what they say."""
    at = F.date_format("reviewed_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    parts = [F.coalesce(c, F.lit("")) for c in (F.col("case_id"), F.col("decision"), at, F.col("notes"), F.col("fraud_type"))]
    return reviews.withColumn("review_id", S.hashed_id("review_", *parts)).select(*schemas.REVIEWS.fieldNames())


def latest(df: DataFrame, key: str, *order: Column) -> DataFrame:
    """The last row of each key."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_n = 1").drop("_n")


def labels(cases: DataFrame, reviews: DataFrame) -> DataFrame:
    """Cases with their latest review (then greatest id): trainable if the decision is clear, false negative if people found what was not routed."""
    last = latest(reviews, "case_id", F.desc("reviewed_at"), F.desc("review_id"))
    joined = cases.join(last, "case_id")
    missed = (F.col("decision") == "true_positive") & (F.col("detection_source") == HUMAN) & ~F.col("model_routed")
    return joined.withColumn("is_trainable_label", F.col("decision").isin(*TRAINABLE)).withColumn("is_false_negative", missed)


def trainable(labelled: DataFrame) -> DataFrame:
    """The labels that a model may learn from."""
    return labelled.where("is_trainable_label")


def manifest(cases: DataFrame, reviews: DataFrame, labelled: DataFrame, flags: DataFrame, settings: Settings) -> dict[str, int]:
    """Counters of a run, one row from each table."""
    a = cases.agg(F.count(F.lit(1)).alias("case_row_count"), F.count_if(F.col("detection_source") == HUMAN).alias("human_discovered_case_count"))
    b = reviews.agg(F.count(F.lit(1)).alias("review_row_count"))
    clear = F.col("is_trainable_label")
    c = labelled.agg(F.count(F.lit(1)).alias("reviewed_case_count"), F.count_if(clear).alias("trainable_label_count"), F.count_if(~clear).alias("non_trainable_reviewed_count"), F.count_if(clear & F.col("is_false_negative")).alias("false_negative_label_count"), *(F.count_if(F.col("decision") == d).alias(d) for d in DECISIONS))
    d = flags.agg(F.count(F.lit(1)).alias("flags_row_count"), F.count_if(F.col("band").isin(*settings.routing_bands)).alias("routed_case_count"))
    return {k: v for df in (a, b, c, d) for k, v in df.first().asDict().items()}


@dataclass
class FeedbackStore:
    """Append-only tables below one folder: cases, reviews, status events. Several runs may write at once."""

    spark: SparkSession
    path: str

    def _log(self, name: str) -> CommitLog:
        return CommitLog(self.spark, f"{self.path}/{name}", {"cases": schemas.CASES, "reviews": schemas.REVIEWS, "status": schemas.STATUS_EVENTS}[name])

    def cases(self) -> DataFrame:
        """Cases with their current state: the last event by order of writing."""
        last = latest(self._log("status").read(), "case_id", F.desc("seq")).select("case_id", F.col("status").alias("_now"))
        return self._log("cases").read().join(last, "case_id", "left").withColumn("status", F.coalesce("_now", "status")).drop("_now").select(*schemas.CASES.fieldNames())

    def reviews(self) -> DataFrame:
        return self._log("reviews").read()

    def write_cases(self, cases: DataFrame) -> int:
        """Appends cases whose id is not there yet; returns how many. Of writers with the same id, one writes it."""
        require_unique(cases, "case_id", what="cases")
        return self._log("cases").commit(lambda there: cases.join(there.select("case_id"), "case_id", "left_anti"))

    def write_reviews(self, reviews: DataFrame) -> None:
        """Appends reviews of known cases; an id that is there already, or an unknown case, is an error. States follow."""
        check_reviews(reviews)
        rows = with_ids(reviews) if "review_id" not in reviews.columns else reviews.select(*schemas.REVIEWS.fieldNames())
        require_unique(rows, "review_id", what="reviews")
        require_none(rows.join(self._log("cases").read().select("case_id"), "case_id", "left_anti").select("case_id"), "unknown case")  # cases never go

        def fresh(there: DataFrame) -> DataFrame:
            require_none(rows.join(there.select("review_id"), "review_id", "left_semi").select("review_id"), "review exists already")
            return rows

        self._log("reviews").commit(fresh)
        state = F.when(F.col("decision").isin(*TRAINABLE), "closed").otherwise("in_review")
        self._events(rows.select("case_id", state.alias("status"), "reviewed_at", "review_id"))

    def set_status(self, case_id: str, status: str) -> None:
        if status not in STATES:
            raise ConfigError(f"unknown state: {status}")
        if self._log("cases").read().where(F.col("case_id") == case_id).isEmpty():
            raise KeyError(case_id)
        self._events(self.spark.createDataFrame([(case_id, status)], "case_id string, status string").withColumn("reviewed_at", F.current_timestamp()).withColumn("review_id", F.lit("")))

    def _events(self, rows: DataFrame) -> None:
        """Events of one call are numbered after all earlier ones, whoever writes at the same time; a batch of reviews is small, and made by people."""
        order = Window.partitionBy("case_id").orderBy("reviewed_at", "review_id")

        def numbered(there: DataFrame) -> DataFrame:
            old = there.agg(F.max("seq")).first()[0] or 0
            return rows.select("case_id", (F.row_number().over(order) + F.lit(old)).cast("long").alias("seq"), "status")

        self._log("status").commit(numbered)


@dataclass(frozen=True)
class FeedbackRun:
    """labels: those that a model may learn from; reviewed: all cases with their latest review; manifest: what was written as JSON."""

    run_id: str
    cases: DataFrame
    labels: DataFrame
    reviewed: DataFrame
    manifest: dict


def run_feedback(store: FeedbackStore, flags: DataFrame, requests: DataFrame | None, reviews, settings: Settings, snapshot: str, run_id: str | None = None, flags_path: str = "") -> FeedbackRun:
    """Routes flags, adds cases opened by people, records reviews, and writes the run's labels, reviewed cases and manifest.

    reviews: a function of the run's cases that gives review rows (case_id, decision, reviewed_at, notes, fraud_type).
    """
    run_id, spark = run_id or new_run_id(settings, snapshot), store.spark
    created = datetime.now(timezone.utc).isoformat()
    store.write_cases(route(flags, run_id, settings, snapshot))
    if requests is not None:
        store.write_cases(human_cases(requests, flags, run_id, settings, snapshot))
    own = store.cases().where(F.col("run_id") == run_id)
    before = store.reviews().count()
    made = reviews(own)
    if made is not None:
        store.write_reviews(made)
    cases = store.cases().where(F.col("run_id") == run_id)
    own_reviews = store.reviews().join(cases.select("case_id"), "case_id", "left_semi")
    path = f"{store.path}/runs/{run_id}"
    if exists(spark, f"{path}/labels"):
        raise ContractError(f"run {run_id} has labels already")
    labels(cases, own_reviews).write.parquet(f"{path}/reviewed")
    reviewed = spark.read.parquet(f"{path}/reviewed")
    trainable(reviewed).write.parquet(f"{path}/labels")
    told = {"run_id": run_id, "created_at": created, "ruleset_version": settings.ruleset_version, "snapshot_id": snapshot, "flags_input_path": flags_path, "routing_bands": sorted(settings.routing_bands)}
    told |= manifest(cases, own_reviews, reviewed, flags, settings) | {"reviews_recorded_this_run": store.reviews().count() - before}
    told |= {"artifact_paths": {"labels": f"{path}/labels", "run_manifest": f"{path}/run_manifest"}, "notes": ["Reviews are what was given to this run; no quality of labels is measured."]}
    write_text(spark, json.dumps(told, indent=2, sort_keys=True), f"{path}/run_manifest")
    return FeedbackRun(run_id, cases, spark.read.parquet(f"{path}/labels"), reviewed, told)
