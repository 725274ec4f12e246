"""Contracts of the operators on small hand-made rows."""

from __future__ import annotations

import hashlib
import json
import math
import random
import threading
from collections import Counter
from datetime import datetime, timedelta

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stakescope import schemas
from stakescope.config import ConfigError, RuleSpec, Settings, Thresholds, load_settings
from stakescope.functions import scalars as S
from stakescope.operators import flatten, identity, linkage, pairs
from stakescope.operators.betting import betting
from stakescope.operators.guards import ContractError, require_currency, require_unique
from stakescope.operators.iforest import average_path, grow, isolation_scores, subsamples
from stakescope.operators.multi_accounting import multi_accounting
from stakescope.operators.payment import payment
from stakescope.operators.quantiles import quantiles
from stakescope.operators.specs import ALL, MA, PAY, TOLD
from stakescope.plans import audit
from stakescope.plans.features import GROUPS, broken_contract, build_features, combine
from stakescope.plans.feedback import FeedbackStore, run_feedback
from stakescope.plans.outputs import load_features, score_and_write, write_features
from stakescope.plans.rebuild import rebuild
from stakescope.plans.scoring import check_rules, score_players, whole_reasons
from stakescope.queries import QUERIES, SQL
from stakescope.sources import adapter as A
from stakescope.sources.commits import CommitLog, renamed
from stakescope.sources.tables import DocumentStore, Workspace, exists, kept, load_table, long_rows, read_text
from stakescope.streaming.ingest import ingest
from tests.oracle import compare

T0 = datetime(2024, 1, 1, 10)
PLAYERS = "player_key string, phone string, created_at timestamp, nin_hash string, email_hash string, referred_by_key string"
LOGINS = "player_key string, user_type string, fingerprint string, source_id string"
MONEY = (
    "player_key string, txn_type string, transaction_id string, amount double, currency string, payment_method string, account_number string, final_status string, requested_at timestamp, "
    "finalized_at timestamp, recipient_normalized string, is_third_party_recipient boolean, is_money_in boolean, is_money_out boolean"
)
BETS = "player_key string, ticket_id string, game_type string, status string, result string, stake double, stake_bonus double, is_free_bet boolean, total_odds double, currency string, created_at timestamp"


def minutes(n):
    return T0 + timedelta(minutes=n)


def deposit(p, i, amount, at, status="completed"):
    return (p, "DEPOSIT", i, amount, "UGX", "bank", "A", status, at, at, None, False, True, False)


def withdrawal(p, i, amount, at, recipient=None, third=False, status="completed"):
    return (p, "WITHDRAWAL", i, amount, "UGX", " bank ", None, status, at, at, recipient, third, False, status == "completed")


def bet(p, i, stake, at, game="g", status="SETTLED", result="WIN", odds=2.0):
    return (p, i, game, status, result, stake, None, False, odds, "UGX", at)


def people(spark, *keys, **fields):
    return spark.createDataFrame([(k, fields.get("phone"), T0, fields.get("nin"), None, None) for k in keys], PLAYERS)


def scalars(spark, values, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(f(F.col("x")).alias("y")).collect()]


def test_phones(spark):
    values = ["0756123456", "256756123456", "+256 (0)756-123456", "756123456", "2560757123456", "abc", "123", "", None]
    assert scalars(spark, values, S.normalize_phone) == ["756123456", "756123456", "756123456", "756123456", "757123456", None, "123", None, None]
    assert scalars(spark, ["751111111", "751010101", "789789789", "6666699999", "756123489", "", None], S.looks_like_test_number) == [True, True, True, True, False, False, False]
    assert scalars(spark, ["a" * 24, "A1" * 12, "g" * 24, None], S.is_objectid_hex) == [True, True, False, False]


def test_addresses(spark):
    assert scalars(spark, ["162.159.122.165", "104.16.0.0", "104.27.255.255", "104.28.0.0", "80.1.1.1", "2606:4700::1", "x", "1.2.3", "999.1.1.1", None], S.is_cdn) == [True, True, True, False, False, False, False, False, False, False]
    assert scalars(spark, ["80.1.1.1, 162.159.1.1", " 172.70.0.1,, 81.0.0.1", "104.16.0.1", "junk", "", None], S.extract_client_ip) == ["80.1.1.1", "81.0.0.1", None, "junk", None, None]


def test_cleaning(spark):
    assert scalars(spark, [" inr ", "INR", "UGX", None], S.relabel_currency) == ["UGX", "UGX", "UGX", None]
    assert scalars(spark, [" cm 12\ta ", " ", None], S.normalize_nin) == ["CM12A", None, None]
    assert scalars(spark, [" A@B.c ", None], S.normalize_email) == ["a@b.c", None]
    assert scalars(spark, ["v", None], lambda x: S.salted_hash(x, "s")) == [hashlib.sha256(b"s\0v").hexdigest(), None]
    assert scalars(spark, ["a" * 64, f" {'b' * 64} ", "not-found", "a", None], S.valid_fingerprint) == ["a" * 64, "b" * 64, None, None, None]
    assert scalars(spark, ["1.5", "x", "NaN", None], S.as_double) == [1.5, None, None, None]
    assert scalars(spark, ["2024-01-01T00:00:00Z", "bad", None], S.utc) == [datetime(2024, 1, 1), None, None]


def test_general_format(spark):
    values = [35.0, 0.0, 1.5, 100000.0, 1000000.0, 123456.7, 0.0001, 0.00001234, -2.25, 999999.5, 1e-5, 1234567890.0]
    assert scalars(spark, values, S.general, "double") == [f"{v:g}" for v in values]


def test_formats_round_the_double_itself(spark):
    """Shortest decimals that end in a half, at which Java's formats round up whatever the double holds."""
    values = [0.125, 0.375, 0.575, 2.675, 1.005, -0.125, -0.005, 187.075, 1.5625, 0.0, 1e22, 17.0]
    for digits in (1, 2, 3):
        assert scalars(spark, values, lambda x, k=digits: S.fixed(x, k), "double") == [f"{v:.{digits}f}" for v in values]
    values = [1234565.0, 1234575.0, 239794.5, -239794.5, 999999.5, 12345675.0, 0.0001234565, 1.234565e-9, 1234565e15, 2.5]
    assert scalars(spark, values, S.general, "double") == [f"{v:g}" for v in values]


def test_resolution(spark):
    docs = [{"_id": "a" * 24, "username": "0756123456", "contactNo": "+256756123456", "playerId": "P1", "referralCode": " R1 ", "createdAt": "2024-01-01T00:00:00Z"}, {"_id": "b" * 24, "username": "0756123456", "isDeleted": True, "createdAt": "2025-01-01T00:00:00Z"}, {"_id": "c" * 24, "username": "0756999111", "createdAt": "2024-01-01T00:00:00Z"}, {"_id": "d" * 24, "username": "0756999111", "createdAt": "2024-02-01T00:00:00Z"}]
    players = spark.createDataFrame(docs, schemas.RAW_PLAYERS)
    ids = identity.identity_map(players, spark.createDataFrame([("0712345678",), ("0756123456",)], schemas.RAW_OTPS))
    values = ["0756123456", "A" * 24, "P1", "R1", "0756999111", "0712345678", "0777777777", "e" * 24, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    rows = [(r["player_key"], r["unjoined_class"]) for r in identity.resolve(df, "x", ids).orderBy("i").collect()]
    a, d = "a" * 24, "d" * 24
    assert rows == [(a, None), (a, None), (None, "test_pattern"), (None, "test_pattern"), (d, None), (None, "pre_registration"), (None, "test_pattern"), (None, "unknown"), (None, "unknown")]
    opted = [r["player_key"] for r in identity.resolve(df, "x", ids, player_id=True, referral=True).orderBy("i").collect()]
    assert opted[2:4] == [a, a]
    assert {r["phone"]: (r["winning_key"], r["losing_keys"]) for r in identity.phone_collisions(players).collect()} == {"756123456": (a, ["b" * 24]), "756999111": (d, ["c" * 24])}


def test_lifecycle(spark):
    rows = [("1", "T", "initiated", "2024-01-01T09:00:00Z", "2024-01-01T09:00:00Z"), ("2", "T", " Completed", "2024-01-01T10:00:00Z", None), ("3", "T", "declined", "2024-01-01T08:00:00Z", "2024-01-02T00:00:00Z"), ("4", None, "odd", None, None)]
    docs = spark.createDataFrame([{"_id": i, "transactionId": t, "status": s, "createdAt": c, "updatedAt": u} for i, t, s, c, u in rows], schemas.RAW_MONEY)
    got = {r["group_id"]: (r["_id"], r["requested_at"], r["lifecycle_docs"]) for r in flatten.collapse_withdrawals(docs).collect()}
    assert got == {"T": ("2", datetime(2024, 1, 1, 8), 3), "4": ("4", None, 1)}


def test_bonus_types_are_checked(spark):
    docs = spark.createDataFrame([{"_id": "1", "transactionType": "ODD"}], schemas.RAW_BONUS)
    none = spark.createDataFrame([], schemas.RAW_MONEY)
    with pytest.raises(ContractError):
        flatten.bonus(docs, identity.identity_map(spark.createDataFrame([], schemas.RAW_PLAYERS)), none, spark.createDataFrame([], schemas.RAW_BETS))


def test_guards(spark):
    df = spark.createDataFrame([("a", "UGX"), ("a", "KES"), (None, None), (None, None)], "k string, currency string")
    with pytest.raises(ContractError):
        require_unique(df, "k")
    require_unique(df.where("k is null"), "k")
    with pytest.raises(ContractError):
        require_currency(df, F.lit(True))


def values(structs, feature):
    return {r[0]: (r[1], r[2]) for r in structs.select("player_key", f"{feature}.value", f"{feature}.null_reason").collect()}


def test_links_are_one_hop_and_capped(spark):
    players = people(spark, *"abcdef")
    f1, f2, office = ("1" * 64, "2" * 64, "f" * 64)
    logins = [("a", "PLAYER", f1, "l1"), ("b", "PLAYER", f1, "l2"), ("b", "PLAYER", f2, "l3"), ("c", "PLAYER", f2, "l4"), ("d", "STAFF", f2, "l5"), ("zz", "PLAYER", f1, "l6"), ("e", "PLAYER", "short", "l7")]
    logins += [(p, "PLAYER", office, f"o{p}") for p in "abf"]
    none = spark.createDataFrame([], MONEY)
    s = multi_accounting(players, spark.createDataFrame(logins, LOGINS), none, Thresholds.of(device_max_players=2))
    got = values(s, "ma_device_shared_account_count")
    assert got == {"a": (1, None), "b": (2, None), "c": (1, None), "d": (None, "no_valid_fingerprint_logins"), "e": (None, "no_valid_fingerprint_logins"), "f": (0, None)}
    assert values(s, "ma_device_count")["a"] == (2, None)
    evidence = json.loads({r[0]: r[1] for r in s.select("player_key", "ma_device_shared_account_count.evidence").collect()}["b"])
    assert [(e["shared_key"], e["other_player_keys"], e["source_record_ids"], e["linked_source_record_ids"]) for e in evidence] == [(f1, ["a"], ["l2"], {"a": ["l1"]}), (f2, ["c"], ["l3"], {"c": ["l4"]})]
    assert values(s, "ma_withdrawal_recipient_shared_count")["a"] == (None, "no_completed_withdrawals")
    with pytest.raises(ConfigError):
        Thresholds.of(device_max_players=0)


def test_linked_counts_are_those_of_the_pairs(spark):
    """With hot keys, several keys a player, equal and different sets of hot keys, on both sides of the bound."""
    rng = random.Random(3)
    rows = {("r", f"hot{k}", f"p{p}") for k in range(3) for p in range(40) if rng.random() < 0.6}
    rows |= {("r", f"cold{rng.randrange(25)}", f"p{p}") for p in range(60) for _ in range(rng.randrange(3))}
    rows |= {("e", f"mail{p // 2}", f"p{p}") for p in range(30)} | {("e", "single", "p59")}
    held = spark.createDataFrame([(*r, ["x"]) for r in sorted(rows)], "key_type string, shared_key string, player_key string, record_ids array<string>")
    shared = linkage.shared_holders(held, 10)
    want = Counter()
    others = {}
    for kind, key, p in rows:
        others.setdefault((p, kind), set()).update(q for k2, key2, q in rows if (k2, key2) == (kind, key) and q != p)
    want = {k: len(v) for k, v in others.items() if v}
    for hot in (5, 12, 1000):
        assert {(r[0], r[1]): r[2] for r in linkage.linked_counts(shared, hot).collect()} == want
    plain = {tuple(r) for r in linkage.edges(shared).select("player_key", "other", "key_type", "shared_key").collect()}
    tiled = linkage.edges(shared, 5).select("player_key", "other", "key_type", "shared_key").collect()
    assert {tuple(r) for r in tiled} == plain and len(tiled) == len(plain)


def test_a_key_of_very_many_players_makes_no_pairs(spark):
    """100,000 players of one recipient, a tenth of them with a second one: exact counts, and no step that has N x N rows."""
    n = 100_000
    first = spark.range(n).select(F.lit("recipient_normalized").alias("key_type"), F.lit("all").alias("shared_key"), F.concat(F.lit("p"), "id").alias("player_key"))
    second = spark.range(n).where("id % 10 = 0").select(F.lit("recipient_normalized").alias("key_type"), F.concat(F.lit("k"), (F.col("id") / 40).cast("int")).alias("shared_key"), F.concat(F.lit("p"), "id").alias("player_key"))
    outside = spark.range(0, n // 40, 2).select(F.lit("recipient_normalized").alias("key_type"), F.concat(F.lit("k"), "id").alias("shared_key"), F.concat(F.lit("q"), "id").alias("player_key"))
    held = first.unionByName(second).unionByName(outside).withColumn("record_ids", F.array(F.lit("x")))
    counts = linkage.linked_counts(linkage.shared_holders(held, 10))
    got = Counter(tuple(r) for r in counts.select(F.substring("player_key", 1, 1), "linked").collect())
    # a second key has four holders; every other one of them also a player from outside, who is linked with those four only
    assert got == {("p", n - 1): n - 10_000 // 2, ("p", n): 10_000 // 2, ("q", 4): n // 80}


def test_counts_without_evidence_are_those_with_it(spark, sf_dir):
    t = A.tables(spark, sf_dir)
    bare, full = (multi_accounting(t["players"], t["logins"], t["money"], Thresholds(), evidence=e) for e in (False, True))
    read = lambda s: sorted(map(tuple, s.select("player_key", *(f"{n}.value" for n in MA), *(f"{n}.null_reason" for n in MA)).collect()))
    assert read(bare) == read(full)


def test_referrals(spark):
    rows = [("a", None, minutes(0), "n", None, "a"), ("b", None, minutes(15), "n", None, "a"), ("c", None, minutes(16), "n", None, "zz"), ("d", None, None, "n", None, None), ("e", None, minutes(0), None, None, "e")]
    s = multi_accounting(spark.createDataFrame(rows, PLAYERS), spark.createDataFrame([], LOGINS), spark.createDataFrame([], MONEY), Thresholds())
    assert {k: v for k, (v, _) in values(s, "ma_referred_by_linked_account").items()} == {"a": True, "b": True, "c": False, "d": False, "e": False}
    assert {k: v for k, (v, _) in values(s, "ma_referral_fanout_count").items()} == {"a": 2, "b": 0, "c": 0, "d": 0, "e": 1}
    assert {k: v for k, (v, _) in values(s, "ma_cocreated_linked_count").items()} == {"a": 1, "b": 2, "c": 1, "d": 0, "e": 0}


def test_as_of_pairs(spark):
    ins = spark.createDataFrame([deposit("p", "d1", 100.0, minutes(0)), deposit("p", "d3", 300.0, minutes(5)), deposit("p", "d2", 200.0, minutes(5)), deposit("p", "d9", 1.0, None), deposit("q", "d4", 1.0, minutes(9))], MONEY)
    outs = spark.createDataFrame([withdrawal("p", "w1", 1.0, minutes(5)), withdrawal("p", "w0", 1.0, minutes(-1)), withdrawal("p", "w2", 1.0, minutes(4)), withdrawal("p", "w3", 1.0, None), withdrawal("q", "w4", 1.0, minutes(8))], MONEY)
    got = {r["withdrawal_id"]: (r["deposit_id"], r["gap_minutes"]) for r in pairs.as_of_pairs(ins, outs).collect()}
    assert got == {"w1": ("d3", 0.0), "w2": ("d1", 4.0)}


def brute_pairs(ins, outs, bets):
    out = []
    for p, _, w, amount, *_, at in [(r[0], r[1], r[2], r[3], r[8]) for r in outs]:
        before = [(r[9], r[2], r[3]) for r in ins if r[0] == p and r[9] is not None and at is not None and r[9] <= at]
        if before:
            d_at, d, d_amount = max(before)
            stakes = [b[5] or 0.0 for b in bets if b[0] == p and b[-1] is not None and d_at <= b[-1] <= at]
            out.append((p, d, w, d_amount, amount, round(sum(stakes), 6), len(stakes)))
    return sorted(out)


def test_turnover_from_running_totals(spark):
    """Against brute force: ties in time, overlapping pairs, deposits and totals carried over several slices, odd amounts."""
    rng = random.Random(5)
    at = lambda: None if rng.random() < 0.03 else minutes(rng.randrange(-300, 300) / 2)
    ins = [deposit(p, f"d{k}", rng.choice([0.1, 100.0, 33.3]), at()) for k, p in enumerate("aab" * 12)] + [deposit("c", "dc", 5.0, minutes(-9000))]
    outs = [withdrawal(p, f"w{k}", 1.0, at()) for k, p in enumerate("aabz" * 15)] + [withdrawal("c", "wc", 1.0, minutes(9000))]
    bets = [bet(p, f"t{k}", rng.choice([0.1, 0.2, 1e9 + 0.3, None]), at()) for k, p in enumerate("aaabc" * 40)]
    want = brute_pairs(ins, outs, bets)
    frames = [spark.createDataFrame(x, s) for x, s in ((ins, MONEY), (outs, MONEY), (bets, BETS))]
    for seconds in (600, 3600, pairs.SLICE_SECONDS):
        got = pairs.as_of_pairs(*frames, seconds)
        assert sorted((r["player_key"], r["deposit_id"], r["withdrawal_id"], r["deposit_amount"], r["withdrawal_amount"], round(r["stake_sum"], 6), r["n_bets"]) for r in got.collect()) == want
        assert sorted((r[0], r[1]) for r in pairs.as_of_pairs(frames[0], frames[1], seconds=seconds).select("withdrawal_id", "deposit_id").collect()) == sorted((w, d) for _, d, w, *_ in want)
    worst = pairs.worst_turnover(pairs.turnover(pairs.as_of_pairs(*frames, 600)))
    listed = {r["player_key"]: r["bet_ids"] for r in pairs.bets_between(worst, frames[2], 600).collect()}
    for r in worst.select("player_key", "worst.*").collect():
        assert listed.get(r["player_key"], []) == sorted(b[1] for b in bets if b[0] == r["player_key"] and b[-1] is not None and r["deposit_at"] <= b[-1] <= r["withdrawal_at"])


def test_one_players_rows_are_spread(spark):
    """300,000 rows of one player: no join by a range, and no window's task sees more than a slice."""
    n = 100_000
    t = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 60)
    row = spark.range(n).select(F.lit("p").alias("player_key"), F.col("id").cast("string").alias("transaction_id"), F.lit(2.0).alias("amount"), F.lit(1.0).alias("stake"), t.alias("finalized_at"), t.alias("created_at"), F.timestamp_seconds(F.unix_seconds(t) + 30).alias("requested_at"))
    got = pairs.as_of_pairs(row, row, row)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(player_key" in plan and ", slice" in plan and "NestedLoop" not in plan and ">=" not in plan
    assert got.where("deposit_id = withdrawal_id and stake_sum = 1.0 and n_bets = 1").count() == n
    largest = pairs._stream(row, row, row, pairs.SLICE_SECONDS).groupBy("player_key", "slice").count().agg(F.max("count")).first()[0]
    assert largest <= 3 * 1440


def test_exit_flag(spark):
    players = people(spark, *"abcdefg")
    rows = [deposit("a", "d", 10000.0, minutes(0)), withdrawal("a", "w", 9000.0, minutes(30), "7", True), deposit("b", "d", 10000.0, minutes(0)), withdrawal("b", "w", 9000.0, minutes(30))]
    rows += [deposit("c", "d", 10000.0, minutes(0)), withdrawal("d", "w", 1.0, minutes(0)), deposit("e", "d", 100.0, minutes(9)), withdrawal("e", "w", 1.0, minutes(0)), deposit("f", "d", 10000.0, minutes(0)), withdrawal("f", "w", 9000.0, minutes(99)), withdrawal("g", "w", 1.0, minutes(0), status="declined")]
    bets = [bet("a", "t1", 999.0, minutes(0)), bet("a", "t2", 5000.0, minutes(31)), bet("b", "t3", 600.0, minutes(0)), bet("b", "t4", 400.0, minutes(30))] + [bet(p, p, 1.0, minutes(500)) for p in "cdef"]
    s = payment(players, spark.createDataFrame(rows, MONEY), spark.createDataFrame(bets, BETS), Thresholds())
    flag = values(s, "pay_deposit_then_exit_flag")
    assert flag == {"a": (True, None), "b": (False, None), "c": (None, "no_completed_withdrawals"), "d": (None, "no_completed_deposits"), "e": (None, "no_subsequent_completed_withdrawal"), "f": (False, None), "g": (None, "casino_activity_not_observable")}
    ratio = values(s, "pay_intervening_turnover_ratio")
    assert ratio["a"] == (pytest.approx(0.0999), None) and ratio["b"] == (pytest.approx(0.1), None) and ratio["f"] == (None, "no_triggering_deposit_withdrawal_pair")
    assert values(s, "pay_withdrawal_to_deposit_ratio")["e"] == (None, "insufficient_deposit_denominator")
    assert values(s, "pay_fast_withdrawal_count")["e"] == (0, None) and values(s, "pay_fast_withdrawal_count")["a"] == (1, None)
    assert values(s, "pay_declined_withdrawal_count")["g"] == (1, None) and values(s, "pay_declined_withdrawal_count")["c"] == (None, "no_withdrawals")
    assert values(s, "pay_third_party_withdrawal_flag")["a"] == (True, None) and values(s, "pay_distinct_payment_methods")["a"] == (1, None)
    item = json.loads({r[0]: r[1] for r in s.select("player_key", "pay_deposit_then_exit_flag.evidence").collect()}["a"])
    assert item == [{"deposit_id": "d", "withdrawal_id": "w", "pct_withdrawn": 90.0, "intervening_bet_ids": ["t1"], "intervening_stake_sum": 999.0}]


def test_betting_gates(spark):
    t = Thresholds.of(min_settled=3, min_timing=4, min_volatility=3)
    rows = [bet("a", f"t{k}", [1.0, 2.0, 3.0][k % 3], minutes(k), " g ", result="WIN" if k else "LOSS") for k in range(4)] + [bet("a", "x", 1.0, minutes(9), None, "VOID", None, None)] + [bet("b", "y", 0.0, None)]
    s = betting(people(spark, *"abc"), spark.createDataFrame(rows, BETS), t)
    assert values(s, "bet_win_rate_vs_volume") == {"a": (0.75, None), "b": (None, "insufficient_settled_bets"), "c": (None, "no_bets")}
    assert values(s, "bet_timing_regularity")["a"] == (0.0, None)
    assert values(s, "bet_stake_volatility")["a"][0] == pytest.approx(0.47380354) and values(s, "bet_avg_odds")["a"] == (2.0, None)
    assert values(s, "bet_count") == {"a": (5, None), "b": (1, None), "c": (0, None)} and values(s, "bet_void_rate")["a"] == (0.2, None)
    assert values(s, "bet_game_type_concentration")["a"][0] == pytest.approx(7 / 8) and values(s, "bet_bonus_funded_stake_share")["b"] == (0.0, None)
    assert values(s, "bet_active_days") == {"a": (1, None), "b": (0, None), "c": (0, None)}


@pytest.fixture(scope="module")
def features(spark, sf_dir):
    t = A.tables(spark, sf_dir)
    f = build_features(t["players"], t["logins"], t["money"], t["bets"])
    f.structs.persist()
    return f


def test_tables(spark, features, tmp_path):
    assert len(features.wide.columns) == 133
    n = features.structs.count()
    write_features(features, str(tmp_path))
    wide, evidence = load_features(spark, str(tmp_path))
    assert (wide.count(), evidence.count()) == (n, n * len(ALL))
    assert broken_contract(features.structs).count() == 0
    scored = score_and_write(features, str(tmp_path))
    assert scored.flags.count() == n and "# Risk report" in scored.report and read_text(spark, f"{tmp_path}/flags_report").strip() == scored.report.strip()
    top = scored.flags.orderBy(F.desc("overall_risk"), "player_key").first()
    assert all(f"- {x['rule_id']} ({x['points']:g}): {x['reason']}" in scored.report for x in json.loads(top["fired_rules"]))
    forest = scored.flags.agg(F.min("iforest_score_untrusted"), F.max("iforest_score_untrusted")).first()
    assert -1 < forest[0] < forest[1] < 0


def test_a_failing_forest_gives_zeros_unless_it_counts(spark, features, tmp_path, monkeypatch):
    from stakescope.plans import outputs

    def broken(*_):
        return spark.range(1).select(F.raise_error(F.lit("forest")).alias("player_key"))

    monkeypatch.setattr(outputs, "isolation_scores", broken)
    scored = score_and_write(features, str(tmp_path))
    assert {r[0] for r in scored.flags.select("iforest_score_untrusted").distinct().collect()} == {0.0}
    with pytest.raises(RuntimeError, match="weight"):
        score_and_write(features, str(tmp_path), Settings(iforest_weight=1.0))


def test_written_groups_are_joined_where_they_lie(spark, sf_dir):
    """All 33 features, checked, without an exchange; the tables on the way are dropped, and the result still reads its own."""
    t, work = A.tables(spark, sf_dir), Workspace(spark)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        structs = build_features(t["players"], t["logins"], t["money"], t["bets"], keep=work, evidence=False).structs
        plan = structs._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Exchange" not in plan and plan.count("SortMergeJoin") == 2 and plan.count("Bucketed: true") == 3
    places = [f.rsplit("/", 1)[0] for name in ("players", "holders") for f in spark.table(work.written[name][0]).inputFiles()]
    work.end(but=GROUPS)
    assert set(work.written) == set(GROUPS) and places and not any(exists(spark, p) for p in places)
    assert structs.count() == t["players"].count()
    work.end()
    assert not work.written


def test_written_groups_must_have_the_same_players(spark):
    with Workspace(spark) as work:
        group = lambda *keys, c: work(spark.createDataFrame([(k,) for k in keys], "player_key string").withColumn(c, F.lit(1)), c, "player_key")
        assert sorted(r[0] for r in combine([group("a", "b", c="x"), group("b", "a", c="y")], written=True).collect()) == ["a", "b"]
        for bad in (("a",), ("a", "b", "b"), ("a", "a"), ("a", "c"), ("b", "b"), ("a", "b", "c")):
            with pytest.raises(Exception, match="not once in each"):
                combine([group("a", "b", c="x"), group(*bad, c="y")], written=True).collect()


def test_doubled_players_are_an_error(spark, sf_dir):
    t = A.tables(spark, sf_dir)
    with pytest.raises(ContractError):
        build_features(t["players"].union(t["players"]), t["logins"], t["money"], t["bets"])
    with pytest.raises(Exception, match="not once in each"):  # found by the merge itself
        build_features(t["players"].union(t["players"]), t["logins"], t["money"], t["bets"], keep=kept, evidence=False).structs.collect()
    kenyan = t["bets"].withColumn("currency", F.when(F.col("ticket_id") == t["bets"].where("player_key is not null").first()["ticket_id"], "KES").otherwise(F.col("currency")))
    with pytest.raises(ContractError, match="KES"):
        build_features(t["players"], t["logins"], t["money"], kenyan, keep=kept, evidence=False)
    strangers = t["bets"].withColumn("currency", F.lit("KES")).withColumn("player_key", F.lit("nobody"))
    built = build_features(t["players"], t["logins"], t["money"], t["bets"].unionByName(strangers), keep=kept, evidence=False)
    assert built.structs.count() == t["players"].count()
    assert built.structs.where("bet_count.evidence is not null or ma_device_count.evidence is not null").isEmpty()


def test_account_references(spark):
    docs = ['{"fromAccountId": "a1", "toAccountId": [{"ref": "x"}, {"ref": "y"}, {"id": 1}, "z", null]}', '{"fromAccountId": null, "toAccountId": []}', '{"fromAccountId": {"ref": "q"}}', '{"toAccountId": [{"ref": "x"}]}', "{cut", None]
    got = audit.account_references({"f": spark.createDataFrame([(x,) for x in docs], "doc string")})
    assert {tuple(r)[1:4]: r["n"] for r in got.collect()} == {
        ("fromAccountId", "id", None): 1, ("fromAccountId", "missing", None): 3, ("fromAccountId", "other", None): 1, ("fromAccountId", "unreadable", None): 1,
        ("toAccountId", "names", None): 3, ("toAccountId", "missing", None): 2, ("toAccountId", "unreadable", None): 1, ("toAccountId", "name", "x"): 2, ("toAccountId", "name", "y"): 1,
    }


def test_merge_of_groups(spark):
    group = lambda *keys, c="x": spark.createDataFrame([(k, 1) for k in keys], f"player_key string, {c} int")
    assert sorted(r[0] for r in combine([group("a", "b"), group("b", "a", c="y"), group("a", "b", c="z")]).collect()) == ["a", "b"]
    for bad in (("a",), ("a", "b", "c"), ("a", "a", "b")):
        with pytest.raises(Exception, match="not once in each"):
            combine([group("a", "b"), group(*bad, c="y")]).collect()


def structs(spark, **set_values):
    """Feature structs of one player, with values for some features."""
    cols = []
    context = {"other_player_keys": "[x]", "shared_keys": "[k]", "referrer_player_key": "r", "shared_key_types": "[t]", "referred_player_keys": "[y]", "deposit_id": "d1", "withdrawal_id": "w1", "pct_withdrawn": 95.3, "intervening_stake_sum": 35.0, "recipient_numbers": "[7]", "reason_text": "why", "deposit_ids": "[d1]", "withdrawal_ids": "[w1]", "settled_bets": 30, "wins": 25, "ticket_count": 20, "min_stake": 1.0, "max_stake": 2.5, "bonus_staked_ticket_ids": "[b]"}
    for name, spec in ALL.items():
        v = set_values.get(name)
        reason = F.lit("no_bets" if v is None else None).cast("string")
        cols.append(F.struct(F.lit(v).cast(spec.spark_type).alias("value"), reason.alias("null_reason"), F.lit("[{}]" if v else "[]").alias("evidence"), F.struct(*(F.lit(x).alias(k) for k, x in context.items())).alias("ctx")).alias(name))
    return spark.range(1).select(F.lit("p").alias("player_key"), *cols)


def test_supporting_rules_need_a_scoring_rule(spark):
    alone = score_players(structs(spark, pay_min_minutes_deposit_to_withdrawal=5.0, ma_referral_fanout_count=9)).first()
    assert (alone["overall_risk"], alone["band"], alone["fired_rules"]) == (0.0, "low", "[]")
    both = score_players(structs(spark, pay_deposit_then_exit_flag=True, pay_min_minutes_deposit_to_withdrawal=5.0, ma_referral_fanout_count=9)).first()
    fired = json.loads(both["fired_rules"])
    assert (both["payment_fraud_score"], both["overall_risk"], both["band"]) == (50.0, 50.0, "medium")
    assert [f["reason"] for f in fired] == ["deposit d1 -> withdrawal w1: withdrew 95.3% of deposit, intervening stake 35 (+40)", "minimum deposit-to-withdrawal gap is 5.0 min via d1->w1 (+10)"]
    unmeasured = json.loads(both["unmeasured_features"])
    assert len(unmeasured) == 30 and unmeasured == sorted(unmeasured, key=lambda x: x["feature_name"])
    assert len(json.loads(both["feature_snapshot"])) == len(ALL)


def test_bands_and_turnover_have_no_rule(spark):
    high = score_players(structs(spark, ma_identity_phone_collision_count=1, pay_third_party_withdrawal_flag=True, bet_timing_regularity=0.2)).first()
    assert (high["overall_risk"], high["band"]) == (100.0, "high")
    middle = score_players(structs(spark, ma_identity_phone_collision_count=1)).first()
    assert (middle["overall_risk"], middle["band"]) == (40.0, "medium")
    quiet = score_players(structs(spark, pay_intervening_turnover_ratio=0.01, pay_third_party_withdrawal_count=3, pay_declined_withdrawal_count=2)).first()
    assert quiet["overall_risk"] == 0.0


def test_firing_without_evidence_is_an_error(spark):
    bare = structs(spark, ma_nin_shared_account_count=2).withColumn("ma_nin_shared_account_count", F.col("ma_nin_shared_account_count").withField("evidence", F.lit("[]")))
    with pytest.raises(Exception, match="without evidence"):
        score_players(bare).collect()


def test_rules_are_checked():
    for bad in (RuleSpec("R", "ma_device_count", "near", 1, 0, ""), RuleSpec("R", "ma_device_count", "gt", 1, None, ""), RuleSpec("R", "odd_feature", "gt", 1, 0, ""), RuleSpec("R", "ma_unknown", "gt", 1, 0, "")):
        with pytest.raises(ConfigError):
            check_rules((bad,))


def test_feedback(spark, tmp_path):
    flags = score_players(structs(spark, ma_identity_phone_collision_count=1)).drop("player_key").crossJoin(spark.createDataFrame([("p",)], "player_key string"))
    store, settings = FeedbackStore(spark, str(tmp_path)), Settings()
    people_ = spark.createDataFrame([("q",)], "player_key string")

    def reviews(cases):
        at = [(r["case_id"], "needs_more_review" if k == 0 else "true_positive", minutes(k), None, "other") for r in cases.collect() for k in range(2)]
        return spark.createDataFrame(at, "case_id string, decision string, reviewed_at timestamp, notes string, fraud_type string")

    run = run_feedback(store, flags, people_, reviews, settings, "snap", "run1")
    counts = {"case_row_count": 2, "flags_row_count": 1, "routed_case_count": 1, "human_discovered_case_count": 1, "review_row_count": 4, "reviews_recorded_this_run": 4, "reviewed_case_count": 2, "trainable_label_count": 2, "non_trainable_reviewed_count": 0, "false_negative_label_count": 1, "true_positive": 2, "false_positive": 0, "needs_more_review": 0, "insufficient_evidence": 0}
    assert {k: run.manifest[k] for k in counts} == counts and run.manifest["ruleset_version"] == settings.ruleset_version
    assert json.loads(read_text(spark, run.manifest["artifact_paths"]["run_manifest"])) == run.manifest
    assert run.labels.count() == 2 and run.reviewed.count() == 2
    assert {r["status"] for r in store.cases().collect()} == {"closed"}
    assert store.write_cases(store.cases()) == 0
    with pytest.raises(ContractError):
        store.write_reviews(reviews(store.cases()))
    with pytest.raises(ContractError):
        store.write_reviews(spark.createDataFrame([("nobody", "true_positive", minutes(0), None, None)], "case_id string, decision string, reviewed_at timestamp, notes string, fraud_type string"))
    with pytest.raises(ContractError):
        store.write_reviews(spark.createDataFrame([("x", "maybe", minutes(0), None, None)], "case_id string, decision string, reviewed_at timestamp, notes string, fraud_type string"))
    case = store.cases().first()["case_id"]
    store.set_status(case, "in_review")
    assert store.cases().where(F.col("case_id") == case).first()["status"] == "in_review"
    with pytest.raises(KeyError):
        store.set_status("nobody", "open")
    with pytest.raises(ConfigError):
        store.set_status(case, "lost")


def test_two_writers(spark, tmp_path):
    """Writers at the same time: every id once, every event kept with a number of its own, drafts unseen."""
    log = CommitLog(spark, str(tmp_path / "log"), T.StructType([T.StructField("id", T.LongType()), T.StructField("seq", T.LongType())]))
    assert log.version() == 0 and log.read().count() == 0
    barrier, failed = threading.Barrier(3), []

    def write(k):
        def make(there):
            if there.isEmpty() and not failed:  # all three have seen the empty table before one of them writes
                barrier.wait(60)
                failed.append(k)
            old = there.agg(F.max("seq")).first()[0] or 0
            return spark.range(10 * k, 10 * k + 20).join(there.select("id"), "id", "left_anti").select("id", (F.lit(old) + F.row_number().over(Window.orderBy("id"))).alias("seq"))

        log.commit(make)

    threads = [threading.Thread(target=write, args=(k,)) for k in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join(120)
    rows = [tuple(r) for r in log.read().collect()]
    assert sorted(i for i, _ in rows) == list(range(40)) and sorted(n for _, n in rows) == list(range(1, 41))
    last = log.version()  # the middle writer has nothing left to add if it comes last
    assert last in (2, 3) and log.read(1).count() == 20
    assert log.commit(lambda there: there.limit(0)) == 0 and log.version() == last
    spark.range(5).selectExpr("id", "id AS seq").write.parquet(str(tmp_path / "log" / "_draft-x"))  # of a writer that was lost
    assert log.read().count() == 40
    spark.range(5).write.parquet(str(tmp_path / "other"))
    assert not renamed(spark, str(tmp_path / "other"), str(tmp_path / "log" / f"version={last}")) and renamed(spark, str(tmp_path / "other"), str(tmp_path / "new"))


def test_settings_files(tmp_path):
    (tmp_path / "a.json").write_text('{"medium_cut": 50, "thresholds": {"fast_minutes": 5}}')
    (tmp_path / "a.yaml").write_text("medium_cut: 50\nthresholds:\n  fast_minutes: 5\n")
    for name in ("a.json", "a.yaml"):
        assert load_settings(str(tmp_path / name)).thresholds.fast_minutes == 5 and load_settings(str(tmp_path / name)).medium_cut == 50
        with pytest.raises(ConfigError, match="missing thresholds"):
            load_settings(str(tmp_path / name), complete=True)


def test_document_store(spark, tmp_path):
    schema = T.StructType([T.StructField("_id", T.StringType()), T.StructField("amount", T.DoubleType())])
    spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 3.0)], schema).write.json(str(tmp_path / "money"))
    store = DocumentStore(spark, str(tmp_path), "json", {"money": schema, "gone": schema})
    assert store.ping() and store.names() == ["money"] and store.count("money") == 3
    assert [tuple(r) for r in store.counts().collect()] == [("money", 3)]
    assert store.sample("money", 2).count() == 2 and sorted(tuple(r) for r in store.find("money", F.col("amount") > 1.5, ["_id"], 5).collect()) == [("b",), ("c",)]
    with pytest.raises(ContractError, match="missing"):
        store.read("gone")
    with pytest.raises(ConfigError, match="not configured"):
        store.read("other")
    assert not DocumentStore(spark, str(tmp_path / "no")).ping() and DocumentStore(spark, str(tmp_path / "no")).names() == []
    spark.range(2).write.json(str(tmp_path / "extra"))
    assert store.names() == ["extra", "money"] and DocumentStore(spark, str(tmp_path)).names() == ["extra", "money"]
    assert [tuple(r) for r in store.counts().collect()] == [("money", 3)]
    for declared in ({}, {"money": schema}):  # no server, no connector
        assert not DocumentStore(spark, "mongodb://127.0.0.1:1/db", "mongodb", declared).ping()
    with pytest.raises(ConfigError, match="no location"):
        DocumentStore(spark, "", "json", {"x": schema}).read("x")


def test_quantiles_by_selection(spark):
    """Against sorting: ties, one value, few and no values, huge spans; brackets are searched although a task could hold all."""
    rng = random.Random(8)
    columns = {
        "ties": [float(rng.randrange(7)) for _ in range(3000)], "wide": [rng.choice([-1, 1]) * 10.0 ** rng.uniform(-300, 300) for _ in range(3000)], "same": [4.5] * 3000,
        "some": [rng.random() if k % 50 == 0 else None for k in range(3000)], "one": [7.0, *[None] * 2999], "none": [None] * 3000, "half": [0.0] * 1500 + [rng.random() for _ in range(1500)],
    }
    df = spark.createDataFrame(list(zip(*columns.values(), strict=True)), ", ".join(f"{c} double" for c in columns)).repartition(7)
    at = (0.0, 0.5, 0.731)
    want = {}
    for c, x in columns.items():
        x = sorted(v for v in x if v is not None)
        spots = [p * (len(x) - 1) for p in at]
        low = lambda s: x[math.floor(s)]  # noqa: B023, E731
        want[c] = [low(s) if low(s) == x[math.ceil(s)] or s == math.floor(s) else (math.ceil(s) - s) * low(s) + (s - math.floor(s)) * x[math.ceil(s)] for s in spots] if x else None
    for limit, accuracy in ((10**6, 2000), (20, 100)):
        assert quantiles(df, {c: at for c in columns}, limit, accuracy) == want
    assert quantiles(df.limit(0), {"ties": at}) == {"ties": None} and quantiles(df, {}) == {}


def test_currency_check(spark):
    stakes = spark.createDataFrame([("p", 100.0), ("p", 200.0), ("q", 300.0)], "player_key string, stake double")
    pays = lambda *x: spark.createDataFrame([("p", v) for v in x], "player_key string, amount double")
    assert audit.check_currency(stakes, pays(200.0, 200.0)) == 1.0
    for bad, why in ((pays(6000.0), "converted"), (pays(250.0), "no amount"), (pays().limit(0), "same players")):
        with pytest.raises(ContractError, match=why):
            audit.check_currency(stakes, bad)


def test_rebuild(spark, sf_dir, tmp_path):
    docs = {"players": A.raw_players(spark, sf_dir), "otps": A.raw_otps(spark, sf_dir), "bets": A.raw_bets(spark, sf_dir), "deposits": A.raw_deposits(spark, sf_dir), "withdrawals": A.raw_withdrawals(spark, sf_dir), "bonus": A.raw_bonus(spark, sf_dir), "activity": A.raw_activity(spark, sf_dir), "logins": A.raw_logins(spark, sf_dir)}
    accounts = (spark.createDataFrame([("c1",)], "_id string"), spark.createDataFrame([("w1",)], "_id string"))
    done = rebuild(docs, str(tmp_path), "salt", accounts)
    assert done.counts["players"] == 150 and "test_pattern" in done.reports["unjoined"]
    with pytest.raises(ConfigError, match="known: activity"):
        load_table(spark, str(tmp_path), "odd")
    with pytest.raises(ContractError):
        rebuild(docs | {"bets": docs["bets"].union(docs["bets"])}, str(tmp_path), "salt")


def test_rebuild_reports_every_phone_collision(spark, tmp_path):
    raw = {"players": schemas.RAW_PLAYERS, "bets": schemas.RAW_BETS, "deposits": schemas.RAW_MONEY, "withdrawals": schemas.RAW_MONEY, "bonus": schemas.RAW_BONUS, "activity": schemas.RAW_ACTIVITY, "logins": schemas.RAW_LOGINS}
    docs = {n: spark.createDataFrame([], x) for n, x in raw.items()}
    rows = [{"_id": f"{k:024x}", "contactNo": f"07{k % 1100:08d}", "createdAt": "2024-01-01T00:00:00Z"} for k in range(2200)]
    done = rebuild(docs | {"players": spark.createDataFrame(rows, raw["players"])}, str(tmp_path), "salt")
    assert len(done.reports["identity"].split("\n")) == 2 + 1100
    assert spark.read.parquet(str(tmp_path / "phone_collisions")).count() == 1100


def test_each_tree_of_the_isolation_forest_draws_its_own_rows(spark):
    names = [n for n, s in ALL.items() if s.kind != "bool"]
    rows = [(f"p{k}", *(float(k) for _ in names)) for k in range(3000)]
    wide = spark.createDataFrame(rows, "player_key string, " + ", ".join(f"{n} double" for n in names)).repartition(3)
    samples = [frozenset(x[:, 0]) for x in subsamples(wide, names, 20, 42)]
    assert all(len(x) == 256 for x in samples) and len(set(samples)) == 20 and len(frozenset().union(*samples)) > 2000
    assert samples == [frozenset(x[:, 0]) for x in subsamples(wide.repartition(5), names, 20, 42)]
    scores = {r["player_key"]: r["iforest_score_untrusted"] for r in isolation_scores(wide).collect()}
    assert len(scores) == 3000 and scores["p0"] < scores["p1500"] and scores["p2999"] < scores["p1500"]


def test_isolation_forest_equals_a_descent_row_by_row(spark):
    """Ties, constant columns, missing values and few players; the plan has no Python in it."""
    names = [n for n, s in ALL.items() if s.kind != "bool"]
    schema = "player_key string, " + ", ".join(f"{n} double" for n in names)
    for n in (1, 3, 300):
        rows = [(f"p{k}", *(None if (k + j) % 7 == 0 else 5.0 if j % 3 == 0 else float((k * (j + 1)) % 11) for j in range(len(names)))) for k in range(n)]
        wide = spark.createDataFrame(rows, schema).repartition(3)
        scored = isolation_scores(wide, trees=9)
        got = {r[0]: r[1] for r in scored.collect()}
        if n < 2:
            assert got == {r[0]: 0.0 for r in rows}
            continue
        assert "Python" not in scored._jdf.queryExecution().executedPlan().toString()
        mid = {c: float(np.median([r[j] for r in rows if r[j] is not None])) if any(r[j] is not None for r in rows) else 0.0 for j, c in enumerate(["key", *names]) if j}
        full = {r[0]: [round(mid[c] if v is None else v, 6) for c, v in zip(names, r[1:], strict=True)] for r in rows}
        total = dict.fromkeys(full, 0)
        for tree in range(9):
            drawn = sorted(full, key=lambda k, tree=tree: (hashlib.md5(f"42:{tree}:{k}".encode()).hexdigest(), k))[:256]
            nodes = {r[1]: r for r in grow(np.array([full[k] for k in drawn]), tree, 42, math.ceil(math.log2(len(drawn))))}
            for k, x in full.items():
                at = 1
                while nodes[at][2] >= 0:
                    at = 2 * at + (x[nodes[at][2]] >= nodes[at][3])
                total[k] += nodes[at][4]
        scale = float(average_path(np.array(min(n, 256))))
        want = {k: -(2 ** (-v / 1e9 / 9 / scale)) for k, v in total.items()}
        assert set(got) == set(want) and all(math.isclose(got[k], want[k], rel_tol=1e-12) for k in want)


def test_ingest(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(2):
        (tmp_path / "in" / f"{k}.json").write_text(json.dumps({"_id": str(k), "userType": "ADMIN", "createdAt": "2024-01-01T00:00:00Z"}))
        ids = identity.identity_map(spark.createDataFrame([], schemas.RAW_PLAYERS))
        ingest(spark, str(tmp_path / "in"), schemas.RAW_LOGINS, lambda b, ids=ids: flatten.logins(b, ids), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert sorted(r["source_id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["0", "1"]


def test_linkage_ignores_empty_keys(spark):
    df = spark.createDataFrame([("a", "k", "r2"), ("a", "k", "r1"), ("b", "", "r3"), (None, "k", "r4"), ("c", None, "r5")], "player_key string, key string, record string")
    held = linkage.holders(linkage.frame_observations(df, "t", "key", F.col("record"))).collect()
    assert [(r["player_key"], r["record_ids"]) for r in held] == [("a", ["r1", "r2"])]


def test_evidence_without_pairs(spark):
    """Texts of a key's other holders, tiled or not, against its pairs; ids may hold separators."""
    held = spark.createDataFrame([("fingerprint", "k", p, r, 4) for p, r in (("a", ["1", "2"]), ("b,c", ["3"]), ("c", []), ("é", ["9"]))] + [("nin_hash", "k", p, [], 2) for p in ("a", "zz")], "key_type string, shared_key string, player_key string, record_ids array<string>, players long")
    pairs = linkage.edges(held).collect()
    for hot in (1, 1000):
        for r in linkage.listed_holders(held, hot).collect():
            others = sorted((p["other"], ",".join(p["other_records"])) for p in pairs if (p["player_key"], p["key_type"]) == (r["player_key"], r["key_type"]))
            assert (r["others"], r["other_records"]) == (",".join(o for o, _ in others), ";".join(f"{o}={x}" for o, x in others))
    some = linkage.edges(held, hot=1, only=spark.createDataFrame([("b,c",)], "player_key string")).collect()
    assert sorted(tuple(r)[:4] for r in some) == sorted(tuple(r)[:4] for r in pairs if r["player_key"] == "b,c")


def test_pairs_between_groups_no_pairs(spark):
    """Keys of pairs told at the first common key, by lists and by grouping, against grouping all pairs."""
    draw = random.Random(5)
    rows = {(kind, f"k{draw.randrange(4)}", f"p{draw.randrange(9)}") for kind in (*linkage.CORROBORATING, linkage.PHONE) for _ in range(14)}
    held = spark.createDataFrame([(*r, []) for r in sorted(rows)], "key_type string, shared_key string, player_key string, record_ids array<string>")
    shared = linkage.shared_holders(held, 10)
    want = sorted(map(repr, linkage.keys_between(linkage.edges(shared)).collect()))
    for hot, listed in ((2, 64), (1000, 3), (1000, 0)):
        assert sorted(map(repr, linkage.pairs_between(shared, hot, listed).collect())) == want


def test_scores_alone_build_no_reasons(spark):
    """What a caller does not select is not built: neither reasons nor snapshots stand in the plan of the scores."""
    spark.conf.set("spark.sql.debug.maxToStringFields", "100000")
    try:
        flags = score_players(structs(spark, ma_identity_phone_collision_count=1))
        plan = flags.select("player_key", "overall_risk", "band", "fired_rule_ids")._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert "feature_snapshot" not in plan and "unmeasured_features" not in plan and "fired_rules" not in plan
    row = flags.first()
    assert row["fired_rule_ids"] == [x["rule_id"] for x in json.loads(row["fired_rules"])] != []


def test_only_the_groups_asked_for_are_built(spark, sf_dir):
    """Features of one kind are made without the other groups; inputs are checked as ever."""
    t = A.tables(spark, sf_dir)
    with Workspace(spark) as work:
        built = build_features(t["players"], t["logins"], t["money"], t["bets"], keep=work, evidence=False, only=("ma_device_count",))
        assert set(work.written) & set(GROUPS) == {GROUPS[0]} and built.structs.columns == ["player_key", *MA]
        assert built.structs.count() == t["players"].count()
    for unknown in ((), ("no_such_feature",)):
        with pytest.raises(ContractError, match="features"):
            build_features(t["players"], t["logins"], t["money"], t["bets"], keep=kept, evidence=False, check=False, only=unknown)
    with pytest.raises(ContractError, match="KES"):
        build_features(t["players"], t["logins"], t["money"], t["bets"].withColumn("currency", F.lit("KES")), keep=kept, evidence=False, only=("ma_device_count",))


def test_payment_from_written_pairs(spark):
    """With keep, stakes are read around the pairs that ask for them alone; features are those of the one pass over all bets."""
    rng = random.Random(7)
    at = lambda: None if rng.random() < 0.03 else minutes(rng.randrange(-3000, 3000) / 2)
    rows = [deposit(p, f"d{k}", rng.choice([0.0, 0.1, 100.0, 20000.0]), at()) for k, p in enumerate("aabcd" * 24)] + [withdrawal(p, f"w{k}", rng.choice([0.1, 90.0, 18000.0]), at()) for k, p in enumerate("aabce" * 24)]
    rows += [deposit("f", "d", 100.0, minutes(1435)), deposit("f", "d", 50.0, minutes(1435)), withdrawal("f", "w", 90.0, minutes(1445)), withdrawal("f", "w", 1.0, minutes(1445))]
    bets = [bet(p, f"t{k}", rng.choice([0.1, 0.2, 1e9 + 0.3, None]), at()) for k, p in enumerate("aaabce" * 60)] + [bet("f", "f1", 3.0, minutes(1435)), bet("f", "f2", 4.0, minutes(1441))]
    inputs = people(spark, *"abcdefg"), spark.createDataFrame(rows, MONEY), spark.createDataFrame(bets, BETS), Thresholds()
    written = []

    def keep(df, name):
        written.append(name)
        return kept(df, name)

    read = lambda df: {r[0]: tuple((r[n]["value"], r[n]["null_reason"]) for n in PAY) for r in df.collect()}
    want, got = payment(*inputs, evidence=False), payment(*inputs, evidence=False, keep=keep, context=False)
    assert read(got) == read(want) and written == ["pairs"] and any(x[1][0] for x in read(want).values())
    assert got.schema["pay_net_money_flow"].dataType.names == ["value", "null_reason"]


def test_holders_without_records(spark):
    rows = [("a", "k", "r1"), ("a", "k", "r1"), ("a", "k", "r2"), ("b", "k", None), ("b", "", "r3"), (None, "k", "r4")]
    df = spark.createDataFrame(rows, "player_key string, key string, record string")
    key = ["key_type", "shared_key", "player_key"]
    every, none = linkage.holders(linkage.frame_observations(df, "t", "key", F.col("record"))), linkage.holders(linkage.frame_observations(df, "t", "key", F.col("record"), once=False), records=False)
    assert none.schema.simpleString() == every.schema.simpleString()
    assert sorted(none.collect()) == sorted((*r[:3], []) for r in every.select(*key).collect()) and none.count() == 2


def test_others_are_read_off_the_texts_of_keys(spark):
    """Lists of all others by kind of key, from each key's text and what further keys add, against lists made of pairs."""
    draw = random.Random(7)
    names = ["a", "b, c", "é", "日本", *(f"p{i}" for i in range(9))]
    rows = {(kind, f"k{draw.randrange(4)}", draw.choice(names)) for kind in (linkage.NIN, linkage.PHONE) for _ in range(22)}
    held = spark.createDataFrame([(*r, []) for r in sorted(rows)], "key_type string, shared_key string, player_key string, record_ids array<string>")
    shared = linkage.shared_holders(held, 10)
    want = {}
    for p in linkage.edges(shared).collect():
        want.setdefault((p["player_key"], p["key_type"]), set()).add(p["other"])
    asked = spark.createDataFrame([(*k, i) for i, k in enumerate(sorted(want))], "player_key string, key_type string, n long")
    for hot in (1, 1000):
        got = {(r["player_key"], r["key_type"]): r["others"] for r in linkage.with_others(asked, shared, hot).collect()}
        assert got == {k: f"[{', '.join(sorted(v, key=str.encode))}]" for k, v in want.items()}


def test_reasons_need_no_pairs_of_holders(spark):
    """Features that are TOLD write no pairs, and the names of others stand in the reasons at the end."""
    people = spark.createDataFrame([(p, None, T0, "n" if p != "c" else None, None, None) for p in "abcd"], PLAYERS)
    written = {}
    built = multi_accounting(people, spark.createDataFrame([], LOGINS), spark.createDataFrame([], MONEY), Thresholds(), TOLD, lambda df, name: written.setdefault(name, df))
    assert set(written) == {"holders", "shared"}
    rows = built.select("player_key", F.lit("R-MA-01").alias("rule_id"), F.lit(35.0).alias("points"), F.col("ma_nin_shared_account_count.ctx.other_player_keys").alias("reason")).where("player_key <> 'c'")
    rows = rows.unionByName(rows.withColumns({"rule_id": F.lit("R-PAY-05"), "reason": F.lit("as it is")}))
    got = {tuple(r) for r in whole_reasons(rows, written["shared"]).collect()}
    assert got == {(p, "R-MA-01", 35.0, others) for p, others in (("a", "[b, d]"), ("b", "[a, d]"), ("d", "[a, b]"))} | {(p, "R-PAY-05", 35.0, "as it is") for p in "abd"}
    assert built.where("ma_nin_shared_account_count.evidence is not null").isEmpty()


def test_long_rows_are_not_held_back(spark, tmp_path):
    """A writer of rows of megabytes ends row groups by their size, not after a hundred rows."""
    names = ("parquet.page.size.row.check.min", "parquet.block.size.row.check.min")
    rows = spark.range(60, numPartitions=1).select(F.repeat(F.sha2(F.col("id").cast("string"), 512), 4000).alias("text"))
    try:
        long_rows(spark)
        rows.write.option("parquet.block.size", 1 << 22).option("compression", "none").option("parquet.enable.dictionary", "false").parquet(str(tmp_path / "long"))
    finally:
        for name in names:
            spark.conf.unset(name)
    (file,) = (tmp_path / "long").glob("*.parquet")
    assert pq.ParquetFile(file).metadata.num_row_groups > 3


def test_evidence_of_shared_keys_is_written_as_long_rows(spark, sf_dir):
    names = ("parquet.page.size.row.check.min", "parquet.block.size.row.check.min")
    for n in names:
        spark.conf.unset(n)
    try:
        assert compare(spark, sf_dir, QUERIES["evidence_multi_accounting"], SQL["evidence_multi_accounting"]) == ""
        assert [spark.conf.get(n) for n in names] == ["1", "1"]
    finally:
        for n in names:
            spark.conf.unset(n)
