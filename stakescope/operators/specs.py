"""What each feature is: kind of value, strength and role. And how a feature's column is built."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S


@dataclass(frozen=True)
class Spec:
    strength: str
    role: str
    kind: str

    @property
    def spark_type(self) -> str:
        return {"count": "bigint", "float": "double", "bool": "boolean"}[self.kind]


# Names of features with strength, role and kind.
MA = {
    "ma_nin_shared_account_count": Spec("strong", "scoring", "count"),
    "ma_email_shared_account_count": Spec("strong", "scoring", "count"),
    "ma_device_shared_account_count": Spec("strong", "scoring", "count"),
    "ma_withdrawal_recipient_shared_count": Spec("strong", "scoring", "count"),
    "ma_identity_phone_collision_count": Spec("strong", "scoring", "count"),
    "ma_referred_by_linked_account": Spec("strong", "supporting", "bool"),
    "ma_referral_fanout_count": Spec("weak", "supporting", "count"),
    "ma_cocreated_linked_count": Spec("moderate", "supporting", "count"),
    "ma_device_count": Spec("weak", "context_only", "count"),
}
PAY = {
    "pay_deposit_then_exit_flag": Spec("strong", "scoring", "bool"),
    "pay_intervening_turnover_ratio": Spec("strong", "scoring", "float"),
    "pay_min_minutes_deposit_to_withdrawal": Spec("strong", "supporting", "float"),
    "pay_third_party_withdrawal_flag": Spec("strong", "scoring", "bool"),
    "pay_third_party_withdrawal_count": Spec("strong", "scoring", "count"),
    "pay_withdrawal_to_deposit_ratio": Spec("moderate", "supporting", "float"),
    "pay_fast_withdrawal_count": Spec("moderate", "supporting", "count"),
    "pay_manual_reconciliation_count": Spec("moderate", "supporting", "count"),
    "pay_manual_reconciliation_ratio": Spec("moderate", "supporting", "float"),
    "pay_declined_withdrawal_count": Spec("moderate", "supporting", "count"),
    "pay_failed_withdrawal_count": Spec("weak", "context_only", "count"),
    "pay_net_money_flow": Spec("weak", "context_only", "float"),
    "pay_distinct_payment_methods": Spec("weak", "context_only", "count"),
    "pay_distinct_payment_accounts": Spec("weak", "context_only", "count"),
}
BET = {
    "bet_win_rate_vs_volume": Spec("strong", "scoring", "float"),
    "bet_timing_regularity": Spec("strong", "scoring", "float"),
    "bet_stake_volatility": Spec("moderate", "supporting", "float"),
    "bet_bonus_funded_stake_share": Spec("moderate", "supporting", "float"),
    "bet_game_type_concentration": Spec("moderate", "context_only", "float"),
    "bet_avg_odds": Spec("weak", "context_only", "float"),
    "bet_odds_profile": Spec("weak", "context_only", "float"),
    "bet_count": Spec("weak", "context_only", "count"),
    "bet_active_days": Spec("weak", "context_only", "count"),
    "bet_void_rate": Spec("weak", "context_only", "float"),
}
ALL = MA | PAY | BET
#: Contexts of reasons as with evidence, without evidence; OTHERS stands for the other holders of a player's shared keys.
TOLD, OTHERS = "told", "\0others\0"


def feature(name: str, value: Column, evidence: Column, unmeasured: list[tuple[Column, str]] | None = None, gathered: bool = True, told: bool = True, **context: Column) -> Column:
    """A struct (value, null_reason, evidence as JSON text, context for reasons).

    The first condition that holds makes the value null and gives the reason; then there is no evidence either. Evidence that
    has not been gathered is null, which is not the same as none. told=False: value and null_reason alone, for queries that show
    nothing else; the optimizer would not take the texts of a context out of a struct that is used twice.
    """
    reason = F.lit(None).cast("string")
    for condition, why in reversed(unmeasured or []):
        reason = F.when(condition, why).otherwise(reason)
    measured = reason.isNull()
    known = F.when(measured, value.cast(ALL[name].spark_type)).alias("value"), reason.alias("null_reason")
    if not told:
        return F.struct(*known).alias(name)
    return F.struct(
        *known,
        (F.when(measured, F.coalesce(evidence, F.lit("[]"))).otherwise("[]") if gathered else F.lit(None).cast("string")).alias("evidence"),
        F.struct(F.lit(1).alias("_"), *(c.alias(k) for k, c in context.items())).alias("ctx"),
    ).alias(name)


def item(**fields: Column) -> Column:
    """Evidence of one item, fields in alphabetical order."""
    return S.json_text(F.array(F.struct(*(fields[k].alias(k) for k in sorted(fields)))))


def nonempty(ids: Column, evidence: Column) -> Column:
    return F.when(F.size(ids) > 0, evidence)


def barrier(df: DataFrame) -> DataFrame:
    """The same rows, behind a generator that the optimizer does not see through.

    Columns that later steps use many times are computed once, instead of being copied into every use.
    """
    return df.select(F.explode(F.array(F.struct(*df.columns))).alias("_row")).select("_row.*")
