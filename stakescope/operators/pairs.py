"""As-of pairing of withdrawals with the deposit before them, and the turnover between."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Thresholds
from ..functions import scalars as S


#: Length of a time slice in seconds: one task sees a player's rows of one slice, whatever the player's number of rows.
SLICE_SECONDS = 86_400
#: The same where no bets are in the rows.
MONEY_SLICE_SECONDS = 7 * SLICE_SECONDS
_EXACT = "decimal(38,12)"


def _slice(time: str, seconds: int) -> Column:
    return F.floor(F.unix_seconds(F.col(time).cast("timestamp")) / seconds)


def _stream(deposits: DataFrame, withdrawals: DataFrame, bets: DataFrame | None, seconds: int) -> DataFrame:
    """Deposits (d), withdrawals (w) and stakes (s) with a time, one row each, with the slice of the time."""
    ins = deposits.where("finalized_at is not null").select("player_key", F.col("finalized_at").alias("t"), F.struct(F.col("finalized_at").alias("at"), F.col("transaction_id").alias("id"), S.amount("amount").alias("amount")).alias("d"), F.lit(None).cast("struct<id:string,amount:double>").alias("w"), F.lit(None).cast(_EXACT).alias("s"))
    outs = withdrawals.where("requested_at is not null").select("player_key", F.col("requested_at").alias("t"), F.lit(None).cast(ins.schema["d"].dataType).alias("d"), F.struct(F.col("transaction_id").alias("id"), S.amount("amount").alias("amount")).alias("w"), F.lit(None).cast(_EXACT).alias("s"))
    rows = ins.unionByName(outs)
    if bets is not None:
        stake = F.coalesce(S.amount("stake").try_cast(_EXACT), F.lit(0).cast(_EXACT))
        rows = rows.unionByName(bets.where("created_at is not null").select("player_key", F.col("created_at").alias("t"), F.lit(None).cast(ins.schema["d"].dataType).alias("d"), F.lit(None).cast("struct<id:string,amount:double>").alias("w"), stake.alias("s")))
    return rows.withColumn("slice", _slice("t", seconds))


def as_of_pairs(deposits: DataFrame, withdrawals: DataFrame, bets: DataFrame | None = None, seconds: int = SLICE_SECONDS) -> DataFrame:
    """Each withdrawal with the latest deposit finalised at or before its request (equal times: greatest transaction id).

    With bets also stake_sum and n_bets: the stakes placed from the deposit to the withdrawal, both ends included, as the
    difference of two running totals, in exact decimals. Nothing is joined by a range. A scan in two passes: windows over a
    player's slice of time give the last deposit and the totals inside it; what the slices before hold (one row for each) is
    carried on and joined by player and slice. So a player's rows are spread over its slices. Rows at the same time count as
    peers; rows without a time, and withdrawals without a deposit before them, have no pair.
    """
    inside = Window.partitionBy("player_key", "slice").orderBy("t")
    upto, peers = inside.rangeBetween(Window.unboundedPreceding, Window.currentRow), inside.rangeBetween(Window.currentRow, Window.currentRow)
    zero = F.lit(0).cast(_EXACT)
    total = lambda w: F.coalesce(F.sum("s").over(w), zero)
    rows = _stream(deposits, withdrawals, bets, seconds)
    if bets is None:
        return _last_deposits(rows, upto)
    rows = rows.withColumns({"p": total(upto).cast(_EXACT), "n": F.count("s").over(upto), "_p": total(peers).cast(_EXACT), "_n": F.count("s").over(peers)})
    before = {"q": (F.col("p") - F.col("_p")).cast(_EXACT), "m": F.col("n") - F.col("_n")}  # stakes of the slice before the deposit
    rows = rows.withColumn("d", F.when(F.col("d").isNotNull(), F.struct("d.*", *(c.alias(k) for k, c in before.items()))))

    slices = rows.groupBy("player_key", "slice").agg(F.coalesce(F.sum("s"), zero).cast(_EXACT).alias("p"), F.count("s").alias("n"), F.max("d").alias("d"))
    earlier = Window.partitionBy("player_key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumns({"_p": F.coalesce(F.sum("p").over(earlier), zero).cast(_EXACT), "_n": F.coalesce(F.sum("n").over(earlier), F.lit(0))})
    whole = F.when(F.col("d").isNotNull(), F.struct("d.at", "d.id", "d.amount", (F.col("d.q") + F.col("_p")).cast(_EXACT).alias("q"), (F.col("d.m") + F.col("_n")).alias("m")))
    carried = slices.withColumn("d", whole).select("player_key", "slice", F.max("d").over(earlier).alias("c"), F.col("_p").alias("cp"), F.col("_n").alias("cn"))

    asked = rows.withColumn("last", F.max("d").over(upto)).where("w is not null").join(carried, ["player_key", "slice"])
    own = F.col("last").isNotNull()
    use = F.when(own, F.col("last")).otherwise(F.col("c"))
    asked = asked.withColumns({"u": use, "stakes": F.when(own, F.col("p") - F.col("last.q")).otherwise(F.col("p") + F.col("cp") - F.col("c.q")), "plays": F.when(own, F.col("n") - F.col("last.m")).otherwise(F.col("n") + F.col("cn") - F.col("c.m"))}).where("u is not null")
    return _pair(asked).withColumns({"stake_sum": F.col("stakes").cast("double"), "n_bets": F.col("plays")}).drop("stakes", "plays")


def _last_deposits(rows: DataFrame, upto: Window) -> DataFrame:
    """as_of_pairs without bets: the same two passes over the deposits alone."""
    earlier = Window.partitionBy("player_key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select("player_key", "slice", "t", "d", "w")
    carried = rows.groupBy("player_key", "slice").agg(F.max("d").alias("d")).select("player_key", "slice", F.max("d").over(earlier).alias("c"))
    asked = rows.withColumn("last", F.max("d").over(upto)).where("w is not null").join(carried, ["player_key", "slice"])
    return _pair(asked.withColumn("u", F.coalesce("last", "c")).where("u is not null"))


def _pair(asked: DataFrame) -> DataFrame:
    also = [c for c in ("stakes", "plays") if c in asked.columns]
    return asked.select("player_key", F.col("u.id").alias("deposit_id"), F.col("u.amount").alias("deposit_amount"), F.col("u.at").alias("deposit_at"), F.col("w.id").alias("withdrawal_id"), F.col("w.amount").alias("withdrawal_amount"), F.col("t").alias("withdrawal_at"), S.minutes_between("u.at", "t").alias("gap_minutes"), *also)


def staked_pairs(some: DataFrame, deposits: DataFrame, withdrawals: DataFrame, bets: DataFrame, seconds: int = SLICE_SECONDS) -> DataFrame:
    """as_of_pairs with stakes for some of its pairs, at least; meant for pairs with short gaps.

    Bets of slices that no such pair touches are in both of its running totals or in neither, so they are left out, as are the
    deposits and withdrawals of other times. Others' withdrawals of the same time come along.
    """
    at = lambda df, time, of: df.join(some.select("player_key", F.col(of).alias(time)), ["player_key", time], "left_semi")
    touched = some.select("player_key", F.explode(F.sequence(_slice("deposit_at", seconds), _slice("withdrawal_at", seconds))).alias("_slice"))
    played = bets.withColumn("_slice", _slice("created_at", seconds)).join(touched, ["player_key", "_slice"], "left_semi").drop("_slice")
    return as_of_pairs(at(deposits, "finalized_at", "deposit_at"), at(withdrawals, "requested_at", "withdrawal_at"), played, seconds)


def trigger_pairs(pairs: DataFrame, t: Thresholds) -> DataFrame:
    """Fast pairs in which most of the deposit left again."""
    return pairs.where((F.col("gap_minutes") <= t.fast_minutes) & (F.col("deposit_amount") > 0) & (F.col("withdrawal_amount") >= t.pct_withdrawn * F.col("deposit_amount")))


def turnover(pairs: DataFrame) -> DataFrame:
    """Pairs with stakes (as_of_pairs with bets) and the share of the deposit that was staked."""
    return pairs.withColumn("turnover_ratio", F.col("stake_sum") / F.col("deposit_amount"))


def worst_turnover(measured: DataFrame) -> DataFrame:
    """Each player's pair with the smallest turnover, then gap, then ids."""
    order = F.struct("turnover_ratio", "gap_minutes", "deposit_id", "withdrawal_id")
    row = F.struct("turnover_ratio", "gap_minutes", "deposit_id", "withdrawal_id", "deposit_amount", "withdrawal_amount", "deposit_at", "withdrawal_at", "stake_sum", "n_bets")
    return measured.groupBy("player_key").agg(F.min_by(row, order).alias("worst"))


def bets_between(worst: DataFrame, bets: DataFrame, seconds: int = SLICE_SECONDS) -> DataFrame:
    """(player_key, bet_ids): the tickets of each player's worst pair, for evidence; only bets of the slices that the pair touches meet it."""
    ends = worst.select("player_key", F.col("worst.deposit_at").alias("a"), F.col("worst.withdrawal_at").alias("b"))
    ends = ends.withColumn("slice", F.explode(F.sequence(_slice("a", seconds), _slice("b", seconds))))
    played = bets.where("created_at is not null").select("player_key", F.col("created_at").alias("t"), "ticket_id", _slice("created_at", seconds).alias("slice"))
    return played.join(ends, ["player_key", "slice"]).where("t >= a and t <= b").groupBy("player_key").agg(F.array_sort(F.collect_list("ticket_id")).alias("bet_ids"))
