"""The driver's star-schema and event tables as the contracts of this library, by plain arithmetic.

ORACLE has the same derivations as SQL common table expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SALT = "salt"
_EPOCH = "TIMESTAMP_NTZ'2024-01-01 00:00:00'"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _phone(c: str) -> Column:
    return (F.lit(700000000) + F.when(F.col(c) % 50 == 1, F.col(c) - 1).otherwise(F.col(c))).cast("string")


def _hash(tag: str, x: Column) -> Column:
    return F.sha2(F.concat(F.lit(f"{SALT}\0{tag}"), x.cast("string")), 256)


def players(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    return _read(spark, sf_dir, "customer").select(
        F.concat(F.lit("C"), c).alias("player_key"), _phone("c_custkey").alias("phone"), F.expr(f"timestampadd(MINUTE, c_custkey, {_EPOCH})").alias("created_at"),
        F.when(c % 7 < 2, _hash("n", F.floor(c / 2))).alias("nin_hash"), F.when(c % 11 < 2, _hash("e", F.floor(c / 3))).alias("email_hash"), F.when(c % 5 == 1, F.concat(F.lit("C"), c - 1)).alias("referred_by_key"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", F.get_json_object("props", "$.k").cast("int").alias("k"))


def money(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, k = events(spark, sf_dir), F.col("k")
    common = [F.concat(F.lit("C"), "user_id").alias("player_key"), F.concat(F.lit("T"), "event_id").alias("transaction_id"), (F.col("value") * 100).alias("amount"), F.lit("UGX").alias("currency"),
              F.when(F.col("event_id") % 2 == 0, "mobile").otherwise("bank").alias("payment_method"), F.concat(F.lit("A"), F.col("user_id") % 3).alias("account_number"), F.col("ts").alias("requested_at"), F.col("ts").alias("finalized_at")]
    ins = F.when(k < 80, "completed").when(k < 85, "manual_reconciliation").when(k < 93, "failed").otherwise("initiated")
    outs = F.when(k < 70, "completed").when(k < 80, "declined").when(k < 90, "failed").otherwise("pending")
    recipient = F.when(F.col("event_id") % 11 == 0, (F.lit(799000000) + F.col("user_id") % 5).cast("string")).otherwise(_phone("user_id"))
    no = F.lit(False)
    d = e.where("event_type = 'purchase'").select(*common, F.lit("DEPOSIT").alias("txn_type"), ins.alias("final_status"), F.lit(None).cast("string").alias("recipient_normalized"), no.alias("is_third_party_recipient"), (k < 85).alias("is_money_in"), no.alias("is_money_out"))
    w = e.where("event_type = 'error'").select(*common, F.lit("WITHDRAWAL").alias("txn_type"), outs.alias("final_status"), recipient.alias("recipient_normalized"), (recipient != _phone("user_id")).alias("is_third_party_recipient"), no.alias("is_money_in"), (k < 70).alias("is_money_out"))
    return d.unionByName(w)


def bets(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    return events(spark, sf_dir).where("event_type in ('click', 'view')").select(
        F.concat(F.lit("C"), "user_id").alias("player_key"), F.concat(F.lit("B"), "event_id").alias("ticket_id"), F.when(k % 3 == 0, "football").when(k % 3 == 1, " tennis ").alias("game_type"),
        F.when(k < 85, "SETTLED").when(k < 90, "VOID").otherwise("ACCEPTED").alias("status"), F.when(k % 2 == 0, "WIN").otherwise("LOSS").alias("result"), F.col("value").alias("stake"), F.when(k % 5 == 0, F.col("value") / 4).alias("stake_bonus"),
        (k % 10 == 0).alias("is_free_bet"), (F.lit(1.0) + k / 10).alias("total_odds"), F.lit("UGX").alias("currency"), F.col("ts").alias("created_at"),
    )


def logins(spark: SparkSession, sf_dir: str) -> DataFrame:
    group = F.when(F.col("event_id") % 10 == 0, "office").otherwise(F.floor(F.col("user_id") / 2).cast("string"))
    return events(spark, sf_dir).where("event_type = 'signup'").select(
        F.concat(F.lit("C"), "user_id").alias("player_key"), F.when(F.col("k") < 95, "PLAYER").otherwise("STAFF").alias("user_type"), F.sha2(F.concat(F.lit("dev"), group), 256).alias("fingerprint"), F.concat(F.lit("L"), "event_id").alias("source_id"), F.col("ts").alias("created_at")
    )


def _iso(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def raw_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Player documents: object ids, phones in several spellings, referrals in three forms."""
    c = F.col("c_custkey")
    before = F.when(c % 3 == 0, F.concat(F.lit("P"), c - 1)).when(c % 3 == 1, F.concat(F.lit("R"), c - 1)).otherwise(F.concat(F.lit("0"), F.lit(700000000) + c - 1))
    return _read(spark, sf_dir, "customer").select(
        F.lpad(F.lower(F.hex(c)), 24, "0").alias("_id"), F.concat(F.lit("0"), _phone("c_custkey")).alias("username"), F.when(c % 4 != 0, F.concat(F.lit("+256 "), _phone("c_custkey"))).alias("contactNo"), F.concat(F.lit("P"), c).alias("playerId"),
        F.concat(F.lit(" R"), c, F.lit(" ")).alias("referralCode"), F.when(c % 5 == 1, before).alias("referredBy"), F.when(c % 7 < 2, F.concat(F.lit("cm "), F.floor(c / 2))).alias("nin"), F.when(c % 11 < 2, F.concat(F.lit(" M"), F.floor(c / 3), F.lit("@X.ug"))).alias("emailId"),
        F.when(c % 13 == 0, True).alias("isDeleted"), F.lit(None).cast("boolean").alias("archived"), F.lit("yes").alias("KycVerified"), F.lit("UG").alias("nationality"), F.lit(None).cast("string").alias("DOB"),
        F.date_format(F.expr(f"timestampadd(MINUTE, c_custkey, {_EPOCH})"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("createdAt"),
    )


def raw_otps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "supplier").select(F.concat(F.lit("0"), F.lit(712345000) + F.col("s_suppkey")).alias("contactNo"))


def login_id(u: str = "user_id", e: str = "event_id") -> Column:
    """Identifiers as feeds write them: phones in several spellings, object ids, early phones, made-up numbers, rubbish."""
    n = F.col(e) % 10
    phone = _phone(u)
    return (
        F.when(n < 4, F.concat(F.lit("0"), phone)).when(n < 6, F.concat(F.lit("256"), phone)).when(n == 6, F.upper(F.lpad(F.lower(F.hex(u)), 24, "0"))).when(n == 7, F.concat(F.lit("0"), F.lit(712345000) + F.col(u) % 7)).when(n == 8, "0777777777").otherwise("n/a")
    )


def raw_withdrawals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Life-cycle documents: consecutive events of type error belong to one transaction."""
    k = F.col("k")
    status = F.when(k < 30, " Completed").when(k < 50, "declined").when(k < 60, "FAILED").when(k < 80, "pending").when(k < 95, "initiated").otherwise("odd")
    return events(spark, sf_dir).where("event_type = 'error'").select(
        F.concat(F.lit("W"), F.lpad(F.col("event_id").cast("string"), 9, "0")).alias("_id"), F.when(F.col("event_id") % 9 != 0, F.concat(F.lit("X"), F.floor(F.col("event_id") / 8))).alias("transactionId"), login_id().alias("userId"), F.col("value").alias("amount"), F.lit("UGX").alias("currency"),
        status.alias("status"), _iso("ts").alias("createdAt"), F.when(F.col("event_id") % 6 != 0, _iso("ts")).alias("updatedAt"), F.lit("mobile").alias("paymentMethod"), F.lit("A1").alias("accountNumber"), F.lit("auto").alias("executionType"),
        F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("0"), F.lit(799000000) + F.col("user_id") % 5)).otherwise(F.concat(F.lit("0"), _phone("user_id"))).alias("recipientId"),
        F.when(k % 4 == 0, "w1").when(k % 4 == 1, "c1").when(k % 4 == 2, "zz").alias("fromAccountId"), F.when(k % 5 < 3, "c1").when(k % 5 == 3, "w1").alias("toAccountId"), F.lit(None).cast("array<string>").alias("bonusTagName"),
    )


def raw_deposits(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, none = F.col("k"), F.lit(None).cast("string")
    status = F.when(k < 80, "COMPLETED ").when(k < 85, "manual_reconciliation").otherwise("failed")
    return events(spark, sf_dir).where("event_type = 'purchase'").select(
        F.concat(F.lit("D"), "event_id").alias("_id"), F.concat(F.lit("T"), "event_id").alias("transactionId"), login_id().alias("userId"), F.col("value").alias("amount"), F.lit("UGX").alias("currency"), status.alias("status"), _iso("ts").alias("createdAt"),
        F.when(F.col("event_id") % 4 != 0, _iso("ts")).alias("updatedAt"), F.lit("bank").alias("paymentMethod"), none.alias("accountNumber"), none.alias("executionType"), none.alias("recipientId"), none.alias("fromAccountId"), none.alias("toAccountId"), F.when(k % 6 == 0, F.array(F.lit("promo"))).alias("bonusTagName"),
    )


def raw_bets(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, none = F.col("k"), F.lit(None)
    parts = F.array(F.struct(F.concat((k % 7 + 1).cast("string"), F.lit(".5")).alias("odds"), F.lit("football").alias("sportName")), F.struct(F.when(k % 4 == 0, "x").otherwise("2.25").alias("odds"), F.when(k % 2 == 0, "tennis").otherwise("").alias("sportName")))
    return events(spark, sf_dir).where("event_type in ('click', 'view')").select(
        F.concat(F.lit("B"), "event_id").alias("ticketId"), login_id().alias("loginId"), F.lit("football").alias("gameType"), F.lit("SETTLED").alias("status"), F.lit("WIN").alias("result"), F.col("value").alias("stake"), F.col("value").alias("stakeReal"), none.cast("double").alias("stakeBonus"),
        (k % 10 == 0).alias("isFreeBet"), none.cast("double").alias("payout"), none.cast("double").alias("potentialPayout"), F.when(k % 8 == 0, "n/a").otherwise((k / 4).cast("string")).alias("totalOdds"), F.when(k % 3 == 0, " inr ").otherwise("UGX").alias("currency"),
        F.when(k % 2 == 0, _iso("ts")).alias("createdDate"), _iso("ts").alias("createdAt"), F.date_format(F.expr("timestampadd(MINUTE, k, ts)"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("updatedAt"), F.lit("multi").alias("betType"), F.when(k % 9 != 0, parts).alias("betParts"),
    )


def raw_bonus(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    ref = F.when(k % 4 == 0, F.concat(F.lit("T"), "event_id")).when(k % 4 == 1, F.concat(F.lit("B"), F.col("event_id") - 1)).when(k % 4 == 2, "zz")
    kind = F.when(k % 4 == 0, "ALLOCATED").when(k % 4 == 1, "RELEASE").when(k % 4 == 2, "CONSUME").otherwise("EXPIRED")
    return events(spark, sf_dir).where("event_type in ('purchase', 'signup')").select(
        F.concat(F.lit("N"), "event_id").alias("_id"), kind.alias("transactionType"), login_id().alias("userId"), F.col("value").alias("amount"), F.when(k % 2 == 0, "b1").alias("bonusTypeId"), F.lit("s1").alias("subBonusTypeId"), ref.alias("refTransId"), _iso("ts").alias("createdAt")
    )


def raw_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    client = F.concat(F.lit("80.227."), k, F.lit("."), F.col("user_id") % 256)
    chain = F.when(k % 5 == 0, "").when(k % 5 == 1, F.concat(client, F.lit(", 162.159.122.165"))).when(k % 5 == 2, F.concat(F.lit("172.70.1.1 ,, "), client)).when(k % 5 == 3, "104.16.0.1,104.27.255.255").otherwise("2606:4700::1, 999.1.1.1")
    return events(spark, sf_dir).where("event_type = 'view'").select(F.concat(F.lit("Y"), "event_id").alias("_id"), login_id().alias("playerId"), F.lit("open").alias("action"), chain.alias("ip_address"), F.lit("home").alias("page"), F.lit("web").alias("device_type"), _iso("ts").alias("created_at"))


def raw_logins(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    mark = F.when(k % 6 == 0, "not-found").when(k % 6 == 1, F.concat(F.lit(" "), F.sha2(F.concat(F.lit("dev"), "user_id"), 256))).when(k % 6 == 2, "abc").otherwise(F.sha2(F.concat(F.lit("dev"), F.col("user_id") % 50), 256))
    return events(spark, sf_dir).where("event_type = 'signup'").select(
        F.concat(F.lit("L"), "event_id").alias("_id"), login_id().alias("loginId"), F.when(k % 7 == 0, "ADMIN").otherwise("PLAYER").alias("userType"), F.when(k % 2 == 0, "Login").otherwise("logout").alias("operationType"), F.when(k % 5 == 0, False).alias("success"), F.lit(None).cast("string").alias("failureReason"), mark.alias("fingerprint"), _iso("ts").alias("createdAt")
    )


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {"players": players(spark, sf_dir), "money": money(spark, sf_dir), "bets": bets(spark, sf_dir), "logins": logins(spark, sf_dir)}


_P = "CAST(700000000 + CASE WHEN {c} % 50 = 1 THEN {c} - 1 ELSE {c} END AS VARCHAR)"
_USER, _CUST = _P.format(c="user_id"), _P.format(c="c_custkey")
_LOGIN = (
    f"CASE WHEN event_id % 10 < 4 THEN '0' || {_USER} WHEN event_id % 10 < 6 THEN '256' || {_USER} WHEN event_id % 10 = 6 THEN upper(lpad(lower(to_hex(user_id)), 24, '0')) "
    "WHEN event_id % 10 = 7 THEN '0' || CAST(712345000 + user_id % 7 AS VARCHAR) WHEN event_id % 10 = 8 THEN '0777777777' ELSE 'n/a' END"
)
#: Common table expressions of the contracts, to stand after WITH.
ORACLE = f"""
ev AS (SELECT event_id, ts, user_id, event_type, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
players AS (SELECT 'C' || c_custkey AS player_key, {_CUST} AS phone, TIMESTAMP '2024-01-01' + to_minutes(CAST(c_custkey AS BIGINT)) AS created_at,
  CASE WHEN c_custkey % 7 < 2 THEN sha256('{SALT}' || chr(0) || 'n' || CAST(c_custkey // 2 AS VARCHAR)) END AS nin_hash,
  CASE WHEN c_custkey % 11 < 2 THEN sha256('{SALT}' || chr(0) || 'e' || CAST(c_custkey // 3 AS VARCHAR)) END AS email_hash,
  CASE WHEN c_custkey % 5 = 1 THEN 'C' || (c_custkey - 1) END AS referred_by_key FROM customer),
money AS (
  SELECT 'C' || user_id AS player_key, 'DEPOSIT' AS txn_type, 'T' || event_id AS transaction_id, value * 100 AS amount, CASE WHEN event_id % 2 = 0 THEN 'mobile' ELSE 'bank' END AS payment_method, 'A' || (user_id % 3) AS account_number,
    CASE WHEN k < 80 THEN 'completed' WHEN k < 85 THEN 'manual_reconciliation' WHEN k < 93 THEN 'failed' ELSE 'initiated' END AS final_status, ts AS requested_at, ts AS finalized_at, CAST(NULL AS VARCHAR) AS recipient, false AS third, k < 85 AS is_in, false AS is_out
  FROM ev WHERE event_type = 'purchase'
  UNION ALL SELECT 'C' || user_id, 'WITHDRAWAL', 'T' || event_id, value * 100, CASE WHEN event_id % 2 = 0 THEN 'mobile' ELSE 'bank' END, 'A' || (user_id % 3),
    CASE WHEN k < 70 THEN 'completed' WHEN k < 80 THEN 'declined' WHEN k < 90 THEN 'failed' ELSE 'pending' END, ts, ts,
    CASE WHEN event_id % 11 = 0 THEN CAST(799000000 + user_id % 5 AS VARCHAR) ELSE {_USER} END, event_id % 11 = 0, false, k < 70
  FROM ev WHERE event_type = 'error'),
bets AS (SELECT 'C' || user_id AS player_key, 'B' || event_id AS ticket_id, CASE k % 3 WHEN 0 THEN 'football' WHEN 1 THEN 'tennis' ELSE 'unknown' END AS game,
    CASE WHEN k < 85 THEN 'SETTLED' WHEN k < 90 THEN 'VOID' ELSE 'ACCEPTED' END AS status, k % 2 = 0 AS won, value AS stake, CASE WHEN k % 5 = 0 THEN value / 4 END AS stake_bonus, 1.0::DOUBLE + k / 10 AS odds, ts AS created_at
  FROM ev WHERE event_type IN ('click', 'view')),
logins AS (SELECT 'C' || user_id AS player_key, sha256('dev' || CASE WHEN event_id % 10 = 0 THEN 'office' ELSE CAST(user_id // 2 AS VARCHAR) END) AS fingerprint, 'L' || event_id AS source_id
  FROM ev WHERE event_type = 'signup' AND k < 95)"""
LOGIN_ID = _LOGIN
CUSTOMER_PHONE = _CUST
