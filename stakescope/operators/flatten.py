"""Raw documents to the six flat tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..config import BONUS_TYPES, CURRENCY, DEPOSIT_IN, STATUS_RANK, WITHDRAWAL_OUT, WITHDRAWAL_PENDING
from ..functions import scalars as S
from .guards import require_none
from .identity import resolve


def _shaped(df: DataFrame, schema) -> DataFrame:
    """The declared columns in their order and types."""
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema))


def players(docs: DataFrame, ids: DataFrame, salt: str) -> DataFrame:
    """One row per player; identity numbers and mail addresses leave only as salted hashes."""
    found = resolve(docs, "referredBy", ids, player_id=True, referral=True, key="referred_by_key", label="_why")
    first = lambda a, b: F.coalesce(S.blank_to_null(F.col(a)), F.col(b))
    return _shaped(
        found.select(
            F.col("_id").alias("player_key"), S.normalize_phone(first("contactNo", "username")).alias("phone"), S.utc("createdAt").alias("created_at"), F.col("KycVerified").alias("kyc_status"),
            F.coalesce("isDeleted", F.lit(False)).alias("is_deleted"), F.coalesce("archived", F.lit(False)).alias("archived"),
            S.salted_hash(S.normalize_nin("nin"), salt).alias("nin_hash"), S.salted_hash(S.normalize_email("emailId"), salt).alias("email_hash"),
            F.when(F.coalesce(F.col("referredBy") != "", F.lit(False)), F.col("referred_by_key")).alias("referred_by_key"), "nationality", F.col("DOB").alias("dob"), F.col("username").alias("username_raw"),
        ),
        schemas.PLAYERS,
    )


def bets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per ticket; odds and sports of the parts are folded with higher-order functions, without exploding."""
    parts = F.coalesce("betParts", F.array().cast(docs.schema["betParts"].dataType))
    odds = F.filter(F.transform(parts, lambda p: S.as_double(p["odds"])), lambda x: x.isNotNull())
    sports = F.filter(F.transform(parts, lambda p: p["sportName"]), lambda x: x.isNotNull() & (x != ""))
    found = resolve(docs, "loginId", ids)
    return _shaped(
        found.select(
            "player_key", "unjoined_class", F.col("ticketId").alias("ticket_id"), F.col("gameType").alias("game_type"), "status", "result", "stake", F.col("stakeReal").alias("stake_real"),
            F.col("stakeBonus").alias("stake_bonus"), F.col("isFreeBet").alias("is_free_bet"), "payout", F.col("potentialPayout").alias("potential_payout"), S.as_double("totalOdds").alias("total_odds"),
            S.relabel_currency("currency").alias("currency"), F.col("currency").alias("source_currency"), S.utc(F.coalesce(S.blank_to_null(F.col("createdDate")), F.col("createdAt"))).alias("created_at"),
            S.utc("updatedAt").alias("settled_at"), F.col("betType").alias("bet_type"), F.size(parts).alias("n_selections"), F.array_min(odds).alias("min_part_odds"), F.array_max(odds).alias("max_part_odds"),
            S.sorted_distinct(sports).alias("sports"),
        ),
        schemas.BETS,
    )


def collapse_withdrawals(docs: DataFrame) -> DataFrame:
    """One row per transaction: its furthest state (then latest update, then greatest id), first request, number of documents.

    One aggregate with map-side combination; no group is gathered or sorted.
    """
    rank = F.lit(-1)
    for status, n in STATUS_RANK.items():
        rank = F.when(S.lowered("status") == status, n).otherwise(rank)
    order = F.struct(rank.alias("rank"), S.utc("updatedAt").alias("updated"), F.col("_id").alias("id"))
    group = F.coalesce(S.blank_to_null(F.col("transactionId")), F.col("_id"))
    kept = docs.withColumn("_group", group).groupBy("_group").agg(F.max_by(F.struct(*docs.columns), order).alias("kept"), F.min(S.utc("createdAt")).alias("requested_at"), F.count(F.lit(1)).alias("lifecycle_docs"))
    return kept.select(F.col("_group").alias("group_id"), "kept.*", "requested_at", "lifecycle_docs")


def money(deposits: DataFrame, withdrawals: DataFrame, ids: DataFrame) -> DataFrame:
    """Deposits and collapsed withdrawals in one ledger; direction is told by flags, no row is dropped."""
    status, no = S.lowered("status"), F.lit(False)
    common = ["player_key", "unjoined_class", F.col("transactionId").alias("transaction_id"), "amount", "currency", F.col("paymentMethod").alias("payment_method"), F.col("accountNumber").alias("account_number"), status.alias("final_status")]
    ins = resolve(deposits, "userId", ids).select(
        *common, F.lit("DEPOSIT").alias("txn_type"), S.utc("createdAt").alias("requested_at"), F.coalesce(S.utc("updatedAt"), S.utc("createdAt")).alias("finalized_at"), F.lit(None).cast("string").alias("execution_type"),
        F.lit(None).cast("string").alias("recipient_normalized"), no.alias("is_third_party_recipient"), S.as_list("bonusTagName").alias("bonus_tags"), status.isin(*DEPOSIT_IN).alias("is_money_in"), no.alias("is_money_out"), no.alias("is_pending_withdrawal"),
    )
    user, recipient = S.normalize_phone("userId"), S.normalize_phone("recipientId")
    outs = resolve(collapse_withdrawals(withdrawals), "userId", ids).select(
        *common, F.lit("WITHDRAWAL").alias("txn_type"), "requested_at", S.utc("updatedAt").alias("finalized_at"), F.col("executionType").alias("execution_type"), recipient.alias("recipient_normalized"),
        F.coalesce(recipient != user, no).alias("is_third_party_recipient"), F.array().cast("array<string>").alias("bonus_tags"), no.alias("is_money_in"), status.isin(*WITHDRAWAL_OUT).alias("is_money_out"),
        status.isin(*WITHDRAWAL_PENDING).alias("is_pending_withdrawal"),
    )
    return _shaped(ins.unionByName(outs), schemas.MONEY)


def bonus(docs: DataFrame, ids: DataFrame, deposits: DataFrame, bet_docs: DataFrame) -> DataFrame:
    """Bonus movements; types outside the allowed ones are an error. A reference is a deposit, else a bet, else unresolved."""
    require_none(docs.where(~F.coalesce(F.col("transactionType").isin(*BONUS_TYPES), F.lit(False))).select("transactionType"), "unexpected bonus transaction type")
    d = deposits.select(F.col("transactionId").alias("refTransId"), F.lit(True).alias("_d")).where("refTransId is not null").distinct()
    b = bet_docs.select(F.col("ticketId").alias("refTransId"), F.lit(True).alias("_b")).where("refTransId is not null").distinct()
    kind = F.when(F.coalesce("refTransId", F.lit("")) == "", "missing").when(F.col("_d"), "deposit").when(F.col("_b"), "bet").otherwise("unresolved")
    found = resolve(docs, "userId", ids).join(d, "refTransId", "left").join(b, "refTransId", "left")
    return _shaped(
        found.select(
            "player_key", "unjoined_class", F.col("_id").alias("source_id"), F.col("transactionType").alias("txn_type"), "amount", F.coalesce(S.blank_to_null(F.col("bonusTypeId")), F.col("subBonusTypeId")).alias("bonus_type"),
            F.col("refTransId").alias("ref_trans_id"), kind.alias("ref_kind"), F.lit(CURRENCY).alias("currency"), S.utc("createdAt").alias("created_at"),
        ),
        schemas.BONUS,
    )


def activity(docs: DataFrame, ids: DataFrame) -> DataFrame:
    found = resolve(docs, "playerId", ids)
    return _shaped(found.select("player_key", "unjoined_class", F.col("_id").alias("source_id"), "action", S.extract_client_ip("ip_address").alias("client_ip"), "page", "device_type", S.utc("created_at").alias("created_at")), schemas.ACTIVITY)


def logins(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Logins; only players' are joined, the others are staff."""
    player = F.coalesce(F.col("userType") == "PLAYER", F.lit(False))
    found = resolve(docs, "loginId", ids)
    return _shaped(
        found.select(
            F.when(player, F.col("player_key")).alias("player_key"), F.when(player, F.col("unjoined_class")).otherwise("staff").alias("unjoined_class"), F.col("_id").alias("source_id"), S.valid_fingerprint("fingerprint").alias("fingerprint"),
            F.col("userType").alias("user_type"), S.login_success("success", "operationType").alias("success"), F.col("failureReason").alias("failure_reason"), S.utc("createdAt").alias("created_at"),
        ),
        schemas.LOGINS,
    )


ACCOUNT_CLASSES = ("missing", "cash", "wallet", "unresolved")


def withdrawal_accounts(withdrawals: DataFrame, cash: DataFrame, wallets: DataFrame) -> DataFrame:
    """Each withdrawal document with the class of its two accounts: missing, cash (checked first), wallet or unresolved."""
    out = withdrawals.select("_id", "transactionId", "status", "fromAccountId", "toAccountId")
    for side in ("from", "to"):
        out = first_match(out, f"{side}AccountId", {"cash": (cash, "_id"), "wallet": (wallets, "_id")}, f"{side}_class")
    return out


def account_crosstab(accounts: DataFrame, side: str) -> DataFrame:
    """Documents by status and class of one side; all classes have a column."""
    return accounts.groupBy(S.lowered("status").alias("status")).pivot(f"{side}_class", list(ACCOUNT_CLASSES)).count().na.fill(0)


def missing_from_crosstab(accounts: DataFrame) -> DataFrame:
    """Documents without a source account, by status and class of the target account."""
    return account_crosstab(accounts.where("from_class = 'missing'"), "to")


# The two rules of the account graph, which rows they look at, and the statuses that they allow.
ACCOUNT_RULES = {
    "wallet_pointing_toAccountId_statuses_subset_failed_declined": ("to_class = 'wallet'", ("declined", "failed")),
    "non_reversal_missing_fromAccountId_statuses_subset_initiated": ("from_class = 'missing' and to_class <> 'wallet'", ("initiated",)),
}


def account_anomalies(accounts: DataFrame) -> DataFrame:
    """Documents that break a rule of the account graph: money into a wallet is a reversal, and only a first request has no source account."""
    status, broken = S.lowered("status"), []
    for name, (rows, allowed) in ACCOUNT_RULES.items():
        broken.append(F.when(F.expr(rows) & ~status.isin(*allowed), F.lit(name)))
    rows = accounts.select(F.explode(F.filter(F.array(*broken), lambda x: x.isNotNull())).alias("invariant"), "_id", "transactionId", status.alias("status"), "from_class", "to_class", "fromAccountId", "toAccountId")
    return rows.select("invariant", F.col("_id").alias("source_id"), F.col("transactionId").alias("transaction_id"), "status", "from_class", "to_class", "fromAccountId", "toAccountId")


def account_invariants(accounts: DataFrame) -> DataFrame:
    """One row for each rule: whether it holds, the statuses it allows, the rows it looked at and those that break it; one pass."""
    status, sums = S.lowered("status"), []
    for i, (rows, allowed) in enumerate(ACCOUNT_RULES.values()):
        sums += [F.count_if(F.expr(rows)).alias(f"seen{i}"), F.count_if(F.expr(rows) & ~status.isin(*allowed)).alias(f"broken{i}")]
    items = [F.struct(F.lit(n).alias("name"), (F.col(f"broken{i}") == 0).alias("verified"), F.lit(", ".join(a)).alias("allowed"), F.col(f"seen{i}").alias("n_rows"), F.col(f"broken{i}").alias("offenders")) for i, (n, (_, a)) in enumerate(ACCOUNT_RULES.items())]
    return accounts.agg(*sums).select(F.explode(F.array(*items)).alias("i")).select("i.*")


def first_match(df: DataFrame, column: str, tables: dict[str, tuple[DataFrame, str]], label: str) -> DataFrame:
    """df with the name of the first of the tables (by order) that holds the value of the column: missing for null, unresolved for none.

    tables: name to (table, its id column). Their ids are one long table, reduced to the first name for each id, so any
    number of tables costs one join.
    """
    names = list(tables)
    known = None
    for i, (table, id_col) in enumerate(tables.values()):
        part = table.select(F.col(id_col).cast("string").alias("_id_value"), F.lit(i).alias("_place")).where("_id_value is not null")
        known = part if known is None else known.unionByName(part)
    first = known.groupBy("_id_value").agg(F.min("_place").alias("_place"))
    out = df.withColumn("_value", F.col(column).cast("string")).join(first, F.col("_value") == F.col("_id_value"), "left")
    name = F.when(F.col("_place").isNotNull(), F.get(F.array(*map(F.lit, names)), F.col("_place")))
    return out.withColumn(label, F.when(F.col("_value").isNull(), "missing").otherwise(F.coalesce(name, F.lit("unresolved")))).drop("_value", "_id_value", "_place")


def ordered(df: DataFrame, *keys: str) -> DataFrame:
    """Rows in a stable order, nulls last; for sinks only."""
    return df.orderBy(*(F.col(k).asc_nulls_last() for k in keys))
