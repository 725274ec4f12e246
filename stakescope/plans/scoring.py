"""Rules compiled to columns: group gate, scores, bands, reasons."""

from __future__ import annotations

import json
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ConfigError, RuleSpec, Settings
from ..functions import scalars as S
from ..operators.linkage import with_others
from ..operators.multi_accounting import SHARED_FEATURES
from ..operators.specs import ALL, OTHERS, Spec

GROUPS = {"ma": "multi_accounting_score", "pay": "payment_fraud_score", "bet": "betting_anomaly_score"}


def group_of(name: str) -> str:
    head = name.split("_", 1)[0]
    if head not in GROUPS:
        raise ConfigError(f"no group for {name}")
    return head


def check_rules(rules: tuple[RuleSpec, ...], specs: dict[str, Spec] = ALL) -> None:
    seen = set()
    for r in rules:
        group_of(r.feature)
        if r.feature not in specs:
            raise ConfigError(f"{r.rule_id}: unknown feature {r.feature}")
        if r.rule_id in seen:
            raise ConfigError(f"{r.rule_id} stands twice")
        seen.add(r.rule_id)
        S.condition(F.lit(0.0), r.op, r.threshold)


def reason(rule: RuleSpec, context: set[str]) -> Column:
    """The reason text of a rule as a concatenation of columns; placeholders are known when the plan is built. The context may hold the value as it is to be shown."""
    value = F.col(f"{rule.feature}.ctx.shown" if "shown" in context else f"{rule.feature}.value")
    parts: list[Column] = []
    for text, name, spec, _ in string.Formatter().parse(rule.reason):
        if text:
            parts.append(F.lit(text))
        if name is None:
            continue
        if name == "points":
            x = F.lit(float(rule.points))
        elif name == "value":
            x = value
        elif name == "value_int":
            x = value.cast("bigint")
        elif name in context:
            x = F.col(f"{rule.feature}.ctx.{name}")
        else:
            raise ConfigError(f"{rule.rule_id}: unknown placeholder {name}")
        if spec == "g":
            x = S.general(x)
        elif spec and spec[0] == "." and spec[-1] == "f":
            x = S.fixed(x, int(spec[1:-1]))
        elif spec:
            raise ConfigError(f"{rule.rule_id}: unknown format {spec}")
        parts.append(F.coalesce(x.cast("string"), F.lit("[]")))
    return F.concat(*parts)


def fires(rule: RuleSpec) -> Column:
    """Measured, and the condition holds; with evidence that is empty it is an error when it happens (evidence that was not gathered is null)."""
    f = F.col(rule.feature)
    met = F.coalesce(S.condition(f["value"], rule.op, rule.threshold), F.lit(False))
    unproved = f"rule {rule.rule_id} fired without evidence"
    return F.when(met & F.coalesce(f["evidence"] == "[]", F.lit(False)), F.raise_error(F.lit(unproved)).cast("boolean")).otherwise(met)


def score_players(structs: DataFrame, settings: Settings | None = None, iforest: DataFrame | None = None) -> DataFrame:
    """Flags: one row per player, in projections over the feature structs, so that what a caller does not select is neither read nor built.

    A supporting rule counts only if a scoring rule of its group fired; context features never score.
    iforest: (player_key, iforest_score_untrusted), or none for zeros; it never adds to the risk.
    """
    settings = settings or Settings()
    check_rules(settings.rules)
    fields = {f.name: f.dataType for f in structs.schema}
    hit = {r.rule_id: F.col(f"`_hit {r.rule_id}`") for r in settings.rules}
    rows = structs.withColumns({f"_hit {r.rule_id}": fires(r) for r in settings.rules})
    fired, ids, scores = [], [], {}
    for group, column in GROUPS.items():
        own = [r for r in settings.rules if group_of(r.feature) == group]
        scoring = [r for r in own if ALL[r.feature].role == "scoring"]
        gate = F.lit(False)
        for r in scoring:
            gate = gate | hit[r.rule_id]
        score = F.lit(0.0)
        for r in [*scoring, *(r for r in own if ALL[r.feature].role == "supporting")]:
            on = hit[r.rule_id] if r in scoring else hit[r.rule_id] & gate
            context = set(fields[r.feature]["ctx"].dataType.names)
            ids.append(F.when(on, F.lit(r.rule_id)))
            fired.append(F.when(on, F.struct(F.col(f"{r.feature}.value").cast("double").alias("feature_value"), F.lit(r.feature).alias("feature"), F.lit(group).alias("group"), F.lit(float(r.points)).alias("points"), reason(r, context).alias("reason"), F.lit(r.rule_id).alias("rule_id"))))
            score = score + F.when(on, float(r.points)).otherwise(0.0)
        scores[column] = score
    every = F.array_compact(F.array(*fired))
    missing = F.filter(F.array(*(F.when(F.col(f"{n}.null_reason").isNotNull(), F.struct(F.lit(n).alias("feature_name"), F.col(f"{n}.null_reason").alias("null_reason"))) for n in sorted(ALL))), lambda x: x.isNotNull())
    snapshot = S.json_text(F.struct(*(F.col(f"{n}.value").alias(n) for n in sorted(ALL))))
    out = rows.select("player_key", *(c.alias(k) for k, c in scores.items()), every.alias("fired"), F.array_compact(F.array(*ids)).alias("fired_rule_ids"), S.json_text(missing).alias("unmeasured_features"), snapshot.alias("feature_snapshot"))
    out = out.withColumn("overall_risk", F.col("multi_accounting_score") + F.col("payment_fraud_score") + F.col("betting_anomaly_score"))
    out = out.withColumn("band", S.band("overall_risk", settings.medium_cut, settings.high_cut)).withColumn("fired_rules", S.json_text(F.col("fired")))
    if iforest is None:
        out = out.withColumn("iforest_score_untrusted", F.lit(0.0))
    else:
        out = out.join(iforest, "player_key", "left").withColumn("iforest_score_untrusted", F.coalesce("iforest_score_untrusted", F.lit(0.0)))
    return out.select("player_key", *GROUPS.values(), "overall_risk", "band", "iforest_score_untrusted", "fired_rules", "unmeasured_features", "feature_snapshot", "fired_rule_ids")


def fired_reasons(flags: DataFrame) -> DataFrame:
    """player_key, rule_id, points, reason: one row for each rule that fired."""
    fired = F.from_json("fired_rules", "array<struct<rule_id: string, points: double, reason: string>>")
    return flags.select("player_key", F.explode(fired).alias("r")).select("player_key", "r.*")


def whole_reasons(rows: DataFrame, shared: DataFrame, settings: Settings | None = None) -> DataFrame:
    """fired_reasons over features that are TOLD, with the names of all others where OTHERS stands for them; shared: holders of shared keys."""
    kinds = {name: kind for kind, name in SHARED_FEATURES.items()}
    by_rule = [F.when(F.col("rule_id") == r.rule_id, F.lit(kinds[r.feature])) for r in (settings or Settings()).rules if r.feature in kinds and "{other_player_keys" in r.reason]
    kind = F.coalesce(*by_rule) if by_rule else F.lit(None).cast("string")
    named = with_others(rows.where(kind.isNotNull()).withColumn("key_type", kind), shared)
    return rows.where(kind.isNull()).unionByName(named.select("player_key", "rule_id", "points", F.replace("reason", F.lit(OTHERS), "others").alias("reason")))


def rule_counts(flags: DataFrame) -> DataFrame:
    """How many players each rule fired for."""
    return flags.select(F.explode("fired_rule_ids").alias("rule_id")).groupBy("rule_id").agg(F.count(F.lit(1)).alias("players"))


def top_flags(flags: DataFrame, n: int) -> DataFrame:
    return flags.orderBy(F.desc("overall_risk"), "player_key").limit(n)


def report(flags: DataFrame, settings: Settings | None = None) -> str:
    """A Markdown report of the riskiest players with a line for each fired rule and each feature that could not be measured.

    Only those players' rows come to the driver, besides one row of counts.
    """
    settings = settings or Settings()
    device = F.count_if(F.array_contains("fired_rule_ids", "R-MA-03"))
    counts = flags.agg(F.count_if(F.col("overall_risk") > 0).alias("risky"), F.count_if(F.col("band") == "medium").alias("medium"), device.alias("device")).first()
    if counts["device"]:
        note = f"{counts['risky']} players with risk and {counts['medium']} of medium band; device sharing (R-MA-03) fired for {counts['device']}, and shared devices may be offices."
    else:
        note = "No device sharing (R-MA-03) fired."
    lines = ["# Risk report", "", f"Rules: {settings.ruleset_version}", "", note, ""]
    for r in top_flags(flags, settings.report_top_n).collect():
        lines += [f"## {r['player_key']}", "", f"- Band: {r['band']}", f"- Overall risk: {r['overall_risk']:g}"]
        lines += [f"- {name.replace('_score', '').replace('_', ' ').capitalize()}: {r[name]:g}" for name in GROUPS.values()]
        lines += [f"- Isolation forest (untrusted): {r['iforest_score_untrusted']:g}", "", "### Fired rules"]
        lines += [f"- {x['rule_id']} ({x['points']:g}): {x['reason']}" for x in json.loads(r["fired_rules"])] or ["- none"]
        lines += ["", "### Not measurable"]
        lines += [f"- {x['feature_name']}: {x['null_reason']}" for x in json.loads(r["unmeasured_features"])] or ["- none"]
        lines.append("")
    return "\n".join(lines)
