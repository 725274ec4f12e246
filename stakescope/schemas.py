"""Declared schemas of the tables."""

from __future__ import annotations

from pyspark.sql import types as T

_KINDS = {"s": T.StringType(), "d": T.DoubleType(), "b": T.BooleanType(), "t": T.TimestampType(), "i": T.IntegerType(), "l": T.LongType(), "a": T.ArrayType(T.StringType())}


def _schema(text: str) -> T.StructType:
    """Fields written as name:kind."""
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in (x.split(":") for x in text.split())])


PLAYERS = _schema("player_key:s phone:s created_at:t kyc_status:s is_deleted:b archived:b nin_hash:s email_hash:s referred_by_key:s nationality:s dob:s username_raw:s")
BETS = _schema(
    "player_key:s unjoined_class:s ticket_id:s game_type:s status:s result:s stake:d stake_real:d stake_bonus:d is_free_bet:b payout:d potential_payout:d "
    "total_odds:d currency:s source_currency:s created_at:t settled_at:t bet_type:s n_selections:i min_part_odds:d max_part_odds:d sports:a"
)
MONEY = _schema(
    "player_key:s unjoined_class:s txn_type:s transaction_id:s amount:d currency:s payment_method:s account_number:s final_status:s requested_at:t finalized_at:t "
    "execution_type:s recipient_normalized:s is_third_party_recipient:b bonus_tags:a is_money_in:b is_money_out:b is_pending_withdrawal:b"
)
BONUS = _schema("player_key:s unjoined_class:s source_id:s txn_type:s amount:d bonus_type:s ref_trans_id:s ref_kind:s currency:s created_at:t")
ACTIVITY = _schema("player_key:s unjoined_class:s source_id:s action:s client_ip:s page:s device_type:s created_at:t")
LOGINS = _schema("player_key:s unjoined_class:s source_id:s fingerprint:s user_type:s success:b failure_reason:s created_at:t")
CASES = _schema(
    "case_id:s run_id:s player_key:s created_at:t overall_risk:d band:s multi_accounting_score:d payment_fraud_score:d betting_anomaly_score:d fired_rules:s unmeasured_features:s feature_snapshot:s "
    "status:s ruleset_version:s snapshot_id:s detection_source:s model_output_available:b model_routed:b"
)
REVIEWS = _schema("review_id:s case_id:s decision:s reviewed_at:t notes:s fraud_type:s")
STATUS_EVENTS = _schema("case_id:s seq:l status:s")
TABLES = {"players": PLAYERS, "bets": BETS, "money": MONEY, "bonus": BONUS, "activity": ACTIVITY, "logins": LOGINS}

# Raw documents: only what the flatteners read, every field may be missing.
RAW_PLAYERS = _schema("_id:s username:s contactNo:s playerId:s referralCode:s referredBy:s nin:s emailId:s isDeleted:b archived:b KycVerified:s nationality:s DOB:s createdAt:s")
RAW_OTPS = _schema("contactNo:s")
RAW_BETS = T.StructType(
    _schema("ticketId:s loginId:s gameType:s status:s result:s stake:d stakeReal:d stakeBonus:d isFreeBet:b payout:d potentialPayout:d totalOdds:s currency:s createdDate:s createdAt:s updatedAt:s betType:s").fields
    + [T.StructField("betParts", T.ArrayType(_schema("odds:s sportName:s")))]
)
RAW_MONEY = _schema("_id:s transactionId:s userId:s amount:d currency:s status:s createdAt:s updatedAt:s paymentMethod:s accountNumber:s executionType:s recipientId:s fromAccountId:s toAccountId:s bonusTagName:a")
RAW_BONUS = _schema("_id:s transactionType:s userId:s amount:d bonusTypeId:s subBonusTypeId:s refTransId:s createdAt:s")
RAW_ACTIVITY = _schema("_id:s playerId:s action:s ip_address:s page:s device_type:s created_at:s")
RAW_LOGINS = _schema("_id:s loginId:s userType:s operationType:s success:b failureReason:s fingerprint:s createdAt:s")
