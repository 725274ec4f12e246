"""The fourteen payment features."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Thresholds
from ..functions import scalars as S
from . import specs
from .guards import population
from .pairs import MONEY_SLICE_SECONDS, as_of_pairs, bets_between, staked_pairs, trigger_pairs, turnover, worst_turnover
from .specs import PAY, TOLD, barrier, item, nonempty


def money_totals(money: DataFrame, evidence: bool = True) -> DataFrame:
    """One row per player with every count, sum and list that the ledger gives, in one pass; without evidence, counts stand for the lists of ids."""
    into, out = F.coalesce("is_money_in", F.lit(False)), (F.col("txn_type") == "WITHDRAWAL") & F.coalesce("is_money_out", F.lit(False))
    withdrawal, status, third = F.col("txn_type") == "WITHDRAWAL", F.col("final_status"), F.coalesce("is_third_party_recipient", F.lit(False))
    total = lambda c: F.round(F.coalesce(F.sum(F.when(c, S.amount("amount"))), F.lit(0.0)), 6)  # noqa: E731  # the last bits depend on the order of the rows
    ids = lambda c, x=F.col("transaction_id"): F.array_sort(F.collect_list(F.when(c, x))) if evidence else F.count_if(c)
    recipient = F.struct(F.col("transaction_id").alias("withdrawal_id"), F.col("recipient_normalized").alias("recipient_number"))
    return money.groupBy("player_key").agg(
        F.count_if(into).alias("n_in"), F.count_if(out).alias("n_out"), F.count_if(withdrawal).alias("n_withdrawals"), total(into).alias("sum_in"), total(out).alias("sum_out"),
        ids(into & (status == "manual_reconciliation")).alias("manual"), ids(withdrawal & (status == "declined")).alias("declined"), ids(withdrawal & (status == "failed")).alias("failed"),
        ids(out & third, recipient).alias("third"),
        F.array_sort(F.collect_set(S.optional_text("payment_method"))).alias("methods"), F.array_sort(F.collect_set(S.optional_text("account_number"))).alias("accounts"),
    )


def payment(players: DataFrame, money: DataFrame, bets: DataFrame, t: Thresholds, evidence: bool | str = True, keep: Callable[[DataFrame, str], DataFrame] | None = None, context: bool = True) -> DataFrame:
    """player_key and one struct for each feature. Without evidence, ids of transactions are counted and not gathered.

    keep: writes the pairs; stakes are then looked for only around those of which the turnover is asked. Without it, all is one
    plan, in one pass over deposits, withdrawals and bets. context=False: structs of value and null_reason.
    evidence TOLD: ids that reasons show, without evidence.
    """
    evidence, gathered = bool(evidence), bool(evidence) and evidence != TOLD
    people = players.where("player_key is not null").select("player_key")
    ledger, own_bets = population(money, people), population(bets, people)
    ins = ledger.where(F.coalesce("is_money_in", F.lit(False)))
    outs = ledger.where((F.col("txn_type") == "WITHDRAWAL") & F.coalesce("is_money_out", F.lit(False)))
    if keep is None:
        pairs = as_of_pairs(ins, outs, own_bets)
        staked = pairs
    else:
        pairs = keep(as_of_pairs(ins, outs, seconds=MONEY_SLICE_SECONDS), "pairs")
        staked = staked_pairs(trigger_pairs(pairs, t), ins, outs, own_bets)
    brief = F.struct("gap_minutes", "deposit_id", "withdrawal_id")
    fast = F.struct("deposit_id", "withdrawal_id")
    paired = pairs.groupBy("player_key").agg(F.min(brief).alias("nearest"), F.array_sort(F.collect_list(F.when(F.col("gap_minutes") <= t.fast_minutes, fast))).alias("fast"))
    worst = worst_turnover(turnover(trigger_pairs(staked, t)))
    if gathered:
        worst = worst.join(bets_between(worst, own_bets), "player_key", "left")
    active = own_bets.select("player_key").distinct().withColumn("active", F.lit(True))
    base = people.join(money_totals(ledger, evidence), "player_key", "left").join(paired, "player_key", "left").join(worst, "player_key", "left").join(active, "player_key", "left")
    base = barrier(base)
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("n_in", "n_out", "n_withdrawals")}
    sums = {c: F.coalesce(c, F.lit(0.0)) for c in ("sum_in", "sum_out")}
    none = lambda c: F.coalesce(F.col(c), F.array().cast("array<string>"))
    no_in, no_out, no_pair = zero["n_in"] == 0, zero["n_out"] == 0, F.col("nearest").isNull()
    unpaired = [(no_in, "no_completed_deposits"), (no_out, "no_completed_withdrawals"), (no_pair, "no_subsequent_completed_withdrawal")]
    unseen = [(F.col("active").isNull(), "casino_activity_not_observable"), *unpaired]
    w = F.col("worst")
    pct = w["withdrawal_amount"] / w["deposit_amount"] * 100
    played = none("bet_ids") if gathered else F.array().cast("array<string>")
    exit_item = F.when(w.isNotNull(), item(deposit_id=w["deposit_id"], withdrawal_id=w["withdrawal_id"], pct_withdrawn=pct, intervening_bet_ids=played, intervening_stake_sum=w["stake_sum"]))
    of_pair = {"deposit_id": w["deposit_id"], "withdrawal_id": w["withdrawal_id"], "pct_withdrawn": F.round(pct, 6), "intervening_stake_sum": F.round(w["stake_sum"], 6)}
    many = lambda c: F.coalesce(F.size(c), F.lit(0)) if evidence else F.coalesce(c, F.lit(0))
    nothing = F.lit(None).cast("string")
    if evidence:
        third, manual, declined, failed = F.col("third"), none("manual"), none("declined"), none("failed")
        third_json = F.when(F.size(third) > 0, S.json_text(third))
        numbers = S.list_text(S.sorted_distinct(F.transform(third, lambda x: x["recipient_number"])))
        listed, shown = (lambda c, **f: nonempty(c, item(**f))), S.list_text
    else:
        third, manual, declined, failed = (F.col(c) for c in ("third", "manual", "declined", "failed"))
        third_json = numbers = nothing
        listed, shown = (lambda c, **f: nothing), (lambda c: nothing)
    unpaid = [(no_out, "no_completed_withdrawals")]
    ratio_text = F.concat(F.lit("completed money_out UGX "), S.general(sums["sum_out"]), F.lit(" / completed money_in UGX "), S.general(sums["sum_in"]))
    near = F.col("nearest")
    fast_pairs = F.coalesce("fast", F.array().cast("array<struct<deposit_id:string,withdrawal_id:string>>"))
    no_deposit, no_withdrawal = [(no_in, "no_completed_deposits")], [(zero["n_withdrawals"] == 0, "no_withdrawals")]
    methods, accounts = none("methods"), none("accounts")
    feature = partial(specs.feature, gathered=gathered, told=context)
    out = [
        feature("pay_deposit_then_exit_flag", F.coalesce(w["turnover_ratio"] < t.turnover_pct, F.lit(False)), exit_item, unseen, **of_pair),
        feature("pay_intervening_turnover_ratio", w["turnover_ratio"], exit_item, [*unseen, (w.isNull(), "no_triggering_deposit_withdrawal_pair")], **of_pair),
        feature("pay_min_minutes_deposit_to_withdrawal", near["gap_minutes"], item(deposit_id=near["deposit_id"], withdrawal_id=near["withdrawal_id"], gap_minutes=near["gap_minutes"]), unpaired, deposit_id=near["deposit_id"], withdrawal_id=near["withdrawal_id"], shown=F.round(near["gap_minutes"], 6)),
        feature("pay_third_party_withdrawal_flag", many(third) > 0, third_json, unpaid, recipient_numbers=numbers),
        feature("pay_third_party_withdrawal_count", many(third), third_json, unpaid, recipient_numbers=numbers),
        feature("pay_withdrawal_to_deposit_ratio", F.try_divide(sums["sum_out"], sums["sum_in"]), item(reason_text=ratio_text, money_in_sum_ugx=sums["sum_in"], money_out_sum_ugx=sums["sum_out"]), [(no_in, "no_completed_deposits"), (sums["sum_in"] < t.min_deposit, "insufficient_deposit_denominator")], reason_text=ratio_text),
        feature("pay_fast_withdrawal_count", F.size(fast_pairs), nonempty(fast_pairs, S.json_text(fast_pairs)), [(no_in, "no_completed_deposits"), (no_out, "no_completed_withdrawals")]),
        feature("pay_manual_reconciliation_count", many(manual), listed(manual, deposit_ids=manual), no_deposit, deposit_ids=shown(manual)),
        feature("pay_manual_reconciliation_ratio", F.try_divide(many(manual), zero["n_in"]), listed(manual, deposit_ids=manual), no_deposit, deposit_ids=shown(manual)),
        feature("pay_declined_withdrawal_count", many(declined), listed(declined, withdrawal_ids=declined), no_withdrawal, withdrawal_ids=shown(declined)),
        feature("pay_failed_withdrawal_count", many(failed), listed(failed, withdrawal_ids=failed), no_withdrawal, withdrawal_ids=shown(failed)),
        feature("pay_net_money_flow", sums["sum_in"] - sums["sum_out"], item(money_in_sum_ugx=sums["sum_in"], money_out_sum_ugx=sums["sum_out"])),
        feature("pay_distinct_payment_methods", F.size(methods), nonempty(methods, item(payment_methods=methods))),
        feature("pay_distinct_payment_accounts", F.size(accounts), nonempty(accounts, item(payment_accounts=accounts))),
    ]
    assert len(out) == len(PAY)
    return base.select("player_key", *out)
