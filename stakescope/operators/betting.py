"""The ten betting features, by game and reduced to the most suspicious game."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import Thresholds
from ..functions import scalars as S
from . import specs
from .guards import population
from .specs import BET, TOLD, barrier, item, nonempty


def by_game(bets: DataFrame, evidence: bool | str = True) -> DataFrame:
    """One row per player and game: counts, stakes, gaps between consecutive bets (order: time, ticket); without evidence, no lists; TOLD: tickets alone."""
    order = Window.partitionBy("player_key", "game").orderBy(F.col("created_at").asc_nulls_last(), "ticket_id")
    rows = bets.select("player_key", F.coalesce(S.optional_text("game_type"), F.lit("unknown")).alias("game"), "ticket_id", "status", "result", "created_at", S.amount("stake").alias("stake"))
    rows = rows.withColumn("gap", S.seconds_between(F.lag("created_at").over(order), "created_at"))
    settled = F.coalesce(F.col("status") == "SETTLED", F.lit(False))
    won = settled & F.coalesce(F.col("result") == "WIN", F.lit(False))
    ends, gathered, told = F.struct("stake", "ticket_id"), _gathered(rows, bool(evidence) and evidence != TOLD), _gathered(rows, bool(evidence))
    g = rows.groupBy("player_key", "game").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(settled).alias("settled"), F.count_if(won).alias("wins"), gathered(F.when(won, F.col("ticket_id"))).alias("winning"),
        told(F.col("ticket_id")).alias("tickets"), gathered(F.struct("created_at", "ticket_id", "gap")).alias("timed"), F.avg("gap").alias("gap_mean"), F.stddev_pop("gap").alias("gap_std"),
        F.sum("stake").alias("stake_sum"), F.avg("stake").alias("stake_mean"), F.stddev_pop("stake").alias("stake_std"), F.min(ends).alias("least"), F.max(ends).alias("most"),
    )
    return g.withColumn("win_rate", F.try_divide("wins", "settled")).withColumn("timing_cv", S.variation(F.col("gap_mean"), F.col("gap_std"))).withColumn("stake_cv", F.when(F.col("stake_mean") > 0, F.col("stake_std") / F.col("stake_mean")).otherwise(0.0))


def _gathered(df: DataFrame, evidence: bool):
    """Sorted lists of a column as an aggregate; without evidence, nulls of the same type."""
    if evidence:
        return lambda x: F.array_sort(F.collect_list(x))
    return lambda x: F.max(F.lit(None).cast(df.select(F.array(x).alias("x")).schema["x"].dataType))


def bet_totals(bets: DataFrame, evidence: bool | str = True) -> DataFrame:
    """One row per player over all games; without evidence, no lists of tickets; TOLD: bonus tickets alone."""
    odds, bonus, free = S.as_double("total_odds"), S.amount("stake_bonus"), F.coalesce("is_free_bet", F.lit(False))
    tickets = lambda c, listed=bool(evidence) and evidence != TOLD: _gathered(bets, listed)(F.when(c, F.col("ticket_id")))
    return bets.groupBy("player_key").agg(
        F.count(F.lit(1)).alias("bets"), tickets(F.lit(True)).alias("all_tickets"), F.sum(S.amount("stake")).alias("stakes"), F.sum(bonus).alias("bonus"), tickets((bonus > 0) | free, bool(evidence)).alias("bonus_tickets"), F.count_if(free).alias("free"),
        F.avg(odds).alias("odds_mean"), F.stddev_pop(odds).alias("odds_std"), F.min(odds).alias("odds_min"), F.max(odds).alias("odds_max"), F.count(odds).alias("odds_n"), tickets(odds.isNotNull()).alias("odds_tickets"),
        F.array_sort(F.collect_set(F.to_date("created_at").cast("string"))).alias("days"), tickets(F.col("status") == "VOID").alias("void"), F.count_if(F.col("status") == "VOID").alias("n_void"),
    )


def betting(players: DataFrame, bets: DataFrame, t: Thresholds, evidence: bool | str = True, context: bool = True) -> DataFrame:
    """player_key and one struct for each feature. Without evidence, no lists of tickets are gathered; TOLD: those that reasons show. context=False: structs of value and null_reason."""
    people = players.where("player_key is not null").select("player_key")
    own = population(bets, people)
    games = by_game(own, evidence)
    rated = F.struct((-F.col("win_rate")).alias("order"), "game", F.struct(F.col("game").alias("game_type"), F.col("settled").alias("settled_bets"), F.concat_ws("", F.col("wins"), F.lit(" wins / "), F.col("settled"), F.lit(" settled bets")).alias("reason_text"), "win_rate", F.col("winning").alias("winning_ticket_ids"), "wins").alias("e"))
    timed = F.struct(F.col("timing_cv").alias("order"), "game", F.struct(F.col("timing_cv").alias("coefficient_of_variation"), F.col("game").alias("game_type"), F.filter(F.transform("timed", lambda x: x["gap"]), lambda x: x.isNotNull()).alias("gap_seconds"), F.col("tickets").alias("ticket_ids"), F.transform("timed", lambda x: F.date_format(x["created_at"], "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")).alias("timestamps")).alias("e"))
    extremes = S.sorted_distinct(F.array(F.col("least.ticket_id"), F.col("most.ticket_id")))
    varied = F.struct((-F.col("stake_cv")).alias("order"), "game", F.struct(extremes.alias("extreme_ticket_ids"), F.col("game").alias("game_type"), F.col("most.stake").alias("max_stake"), F.col("least.stake").alias("min_stake"), "stake_cv", "stake_mean", "stake_std").alias("e"))
    kept = lambda gate, x: F.array_sort(F.collect_list(F.when(gate, x)))
    per_game = F.struct("game", "n", "stake_sum", "tickets")
    top = games.groupBy("player_key").agg(kept(F.col("settled") >= t.min_settled, rated).alias("rated"), kept(F.col("n") >= t.min_timing, timed).alias("timed"), kept(F.col("n") >= t.min_volatility, varied).alias("varied"), F.array_sort(F.collect_list(per_game)).alias("games"))
    base = people.join(top, "player_key", "left").join(bet_totals(own, evidence), "player_key", "left")
    base = barrier(base)
    none = [(F.col("bets").isNull(), "no_bets")]
    first = lambda c: F.get(F.col(c), F.lit(0))["e"]
    listed = lambda c: S.json_text(F.transform(c, lambda x: x["e"]))
    rate, timing, stake = first("rated"), first("timed"), first("varied")
    empty = lambda c: F.coalesce(F.size(c), F.lit(0)) <= 0
    total = F.col("stakes")
    shares = F.transform("games", lambda g: F.struct(g["n"].alias("bet_count"), g["game"].alias("game_type"), F.when(total > 0, g["stake_sum"] / total).otherwise(0.0).alias("stake_share"), g["stake_sum"].alias("stake_sum"), g["tickets"].alias("ticket_ids")))
    best = F.array_max(F.transform(shares, lambda g: F.struct(g["stake_share"].alias("share"), g["game_type"].alias("game"))))
    tickets, days, void, bonus = F.col("all_tickets"), F.col("days"), F.coalesce("void", F.array().cast("array<string>")), F.col("bonus_tickets")
    feature = partial(specs.feature, gathered=bool(evidence) and evidence != TOLD, told=context)
    out = [
        feature("bet_win_rate_vs_volume", rate["win_rate"], listed("rated"), [*none, (empty("rated"), "insufficient_settled_bets")], settled_bets=rate["settled_bets"], wins=rate["wins"]),
        feature("bet_timing_regularity", timing["coefficient_of_variation"], listed("timed"), [*none, (empty("timed"), "insufficient_bets_for_timing")], ticket_count=F.size(F.array_distinct(F.flatten(F.transform("timed", lambda x: x["e"]["ticket_ids"]))))),
        feature("bet_stake_volatility", stake["stake_cv"], listed("varied"), [*none, (empty("varied"), "insufficient_bets_for_volatility")], min_stake=stake["min_stake"], max_stake=stake["max_stake"]),
        feature("bet_bonus_funded_stake_share", F.when(total > 0, F.col("bonus") / total).otherwise(0.0), nonempty(bonus, item(bonus_staked_ticket_ids=bonus, bonus_stake_sum=F.col("bonus"), free_bet_count=F.col("free"), total_stake=total)), none, bonus_staked_ticket_ids=S.list_text(bonus)),
        feature("bet_game_type_concentration", F.when(total > 0, best["share"]).otherwise(0.0), item(dominant_game_type=best["game"], dominant_share=best["share"], per_game_type=shares), none),
        feature("bet_avg_odds", F.col("odds_mean"), item(ticket_ids=F.col("odds_tickets"), odds_count=F.col("odds_n")), [*none, (F.col("odds_n") == 0, "no_bets")]),
        feature("bet_odds_profile", F.col("odds_std"), item(ticket_ids=F.col("odds_tickets"), odds_mean=F.col("odds_mean"), odds_std=F.col("odds_std"), odds_min=F.col("odds_min"), odds_max=F.col("odds_max")), [*none, (F.col("odds_n") == 0, "no_bets")]),
        feature("bet_count", F.coalesce("bets", F.lit(0)), nonempty(tickets, item(ticket_ids=tickets))),
        feature("bet_active_days", F.coalesce(F.size(days), F.lit(0)), nonempty(days, item(active_dates=days, ticket_ids=tickets))),
        feature("bet_void_rate", F.col("n_void") / F.col("bets"), nonempty(void, item(void_ticket_ids=void)), none),
    ]
    assert len(out) == len(BET)
    return base.select("player_key", *out)
