"""SQL of the larger registered queries, written against the source tables for an independent engine."""

from __future__ import annotations

import math

from .operators.specs import ALL
from .sources.adapter import CUSTOMER_PHONE, LOGIN_ID, ORACLE

# One-hop links: observations, holders, capped keys, edges.
LINKS = f"""{ORACLE},
done AS (SELECT * FROM money WHERE is_out),
obs AS (
  SELECT DISTINCT 'nin_hash' AS kt, nin_hash AS sk, player_key AS p FROM players WHERE nin_hash IS NOT NULL
  UNION SELECT 'email_hash', email_hash, player_key FROM players WHERE email_hash IS NOT NULL
  UNION SELECT 'normalized_phone', phone, player_key FROM players
  UNION SELECT 'fingerprint', fingerprint, player_key FROM logins WHERE player_key IN (SELECT player_key FROM players)
  UNION SELECT 'recipient_normalized', recipient, player_key FROM done WHERE recipient IS NOT NULL AND player_key IN (SELECT player_key FROM players)),
sized AS (SELECT kt, sk, count(DISTINCT p) AS n FROM obs GROUP BY ALL),
usable AS (SELECT kt, sk FROM sized WHERE kt <> 'fingerprint' OR n <= 10),
links AS (SELECT a.p, b.p AS o, a.kt, a.sk FROM obs a JOIN obs b ON a.kt = b.kt AND a.sk = b.sk AND a.p <> b.p JOIN usable u ON u.kt = a.kt AND u.sk = a.sk)"""

MA = f"""{LINKS},
cnt AS (SELECT p, kt, count(DISTINCT o) AS n FROM links GROUP BY ALL),
own AS (SELECT DISTINCT obs.p, obs.kt, obs.sk FROM obs JOIN usable u ON u.kt = obs.kt AND u.sk = obs.sk WHERE obs.kt <> 'normalized_phone'),
refs AS (SELECT DISTINCT c.player_key FROM players c JOIN own a ON a.p = c.player_key JOIN own b ON b.p = c.referred_by_key AND a.kt = b.kt AND a.sk = b.sk),
fan AS (SELECT referred_by_key AS p, count(DISTINCT player_key) AS n FROM players WHERE referred_by_key IS NOT NULL GROUP BY 1),
near AS (SELECT l.p, count(DISTINCT l.o) AS n FROM links l JOIN players a ON a.player_key = l.p JOIN players b ON b.player_key = l.o WHERE l.kt <> 'normalized_phone' AND abs(epoch(a.created_at) - epoch(b.created_at)) <= 900 GROUP BY 1),
dev AS (SELECT p, count(DISTINCT sk) AS n FROM obs WHERE kt = 'fingerprint' GROUP BY 1),
ma AS (SELECT q.player_key,
  coalesce((SELECT n FROM cnt WHERE p = q.player_key AND kt = 'nin_hash'), 0) AS ma_nin_shared_account_count,
  coalesce((SELECT n FROM cnt WHERE p = q.player_key AND kt = 'email_hash'), 0) AS ma_email_shared_account_count,
  CASE WHEN dev.n IS NOT NULL THEN coalesce((SELECT n FROM cnt WHERE p = q.player_key AND kt = 'fingerprint'), 0) END AS ma_device_shared_account_count,
  CASE WHEN q.player_key IN (SELECT player_key FROM done) THEN coalesce((SELECT n FROM cnt WHERE p = q.player_key AND kt = 'recipient_normalized'), 0) END AS ma_withdrawal_recipient_shared_count,
  coalesce((SELECT n FROM cnt WHERE p = q.player_key AND kt = 'normalized_phone'), 0) AS ma_identity_phone_collision_count,
  q.player_key IN (SELECT player_key FROM refs) AS ma_referred_by_linked_account,
  coalesce(fan.n, 0) AS ma_referral_fanout_count, coalesce(near.n, 0) AS ma_cocreated_linked_count, dev.n AS ma_device_count,
  CASE WHEN dev.n IS NULL THEN 'no_valid_fingerprint_logins' END AS device_reason,
  CASE WHEN q.player_key NOT IN (SELECT player_key FROM done) THEN 'no_completed_withdrawals' END AS recipient_reason
  FROM players q LEFT JOIN dev ON dev.p = q.player_key LEFT JOIN fan ON fan.p = q.player_key LEFT JOIN near ON near.p = q.player_key)"""

PAIRS = """,
ins AS (SELECT * FROM money WHERE is_in AND player_key IN (SELECT player_key FROM players)),
outs AS (SELECT * FROM money WHERE is_out AND player_key IN (SELECT player_key FROM players)),
paired AS (SELECT w.player_key, w.transaction_id AS w_id, w.amount AS w_amount, w.requested_at AS w_at, d.transaction_id AS d_id, d.amount AS d_amount, d.finalized_at AS d_at,
    row_number() OVER (PARTITION BY w.transaction_id ORDER BY d.finalized_at DESC, d.transaction_id DESC) AS rn
  FROM outs w JOIN ins d ON d.player_key = w.player_key AND d.finalized_at <= w.requested_at),
pairs AS (SELECT *, (epoch_us(w_at) - epoch_us(d_at)) / 6e7 AS gap FROM paired WHERE rn = 1),
trig AS (SELECT * FROM pairs WHERE gap <= 60 AND d_amount > 0 AND w_amount >= 0.8 * d_amount),
turn AS (SELECT t.player_key, t.d_id, t.w_id, t.gap, t.d_amount, t.w_amount, coalesce(sum(b.stake), 0) AS stake_sum, count(b.ticket_id) AS n_bets
  FROM trig t LEFT JOIN bets b ON b.player_key = t.player_key AND b.created_at >= t.d_at AND b.created_at <= t.w_at GROUP BY ALL),
worst AS (SELECT *, stake_sum / d_amount AS ratio, row_number() OVER (PARTITION BY player_key ORDER BY stake_sum / d_amount, gap, d_id, w_id) AS rn FROM turn)"""

PAY = (
    PAIRS
    + """,
tot AS (SELECT player_key, count(*) FILTER (is_in) AS n_in, count(*) FILTER (is_out) AS n_out, count(*) FILTER (txn_type = 'WITHDRAWAL') AS n_wd,
    coalesce(sum(amount) FILTER (is_in), 0) AS s_in, coalesce(sum(amount) FILTER (is_out), 0) AS s_out, count(*) FILTER (is_in AND final_status = 'manual_reconciliation') AS manual,
    count(*) FILTER (txn_type = 'WITHDRAWAL' AND final_status = 'declined') AS declined, count(*) FILTER (txn_type = 'WITHDRAWAL' AND final_status = 'failed') AS failed,
    count(*) FILTER (is_out AND third) AS third, count(DISTINCT payment_method) AS methods, count(DISTINCT account_number) AS accounts FROM money GROUP BY 1),
pg AS (SELECT player_key, min(gap) AS gap, count(*) FILTER (gap <= 60) AS fast FROM pairs GROUP BY 1),
pay0 AS (SELECT q.player_key, coalesce(n_in, 0) AS n_in, coalesce(n_out, 0) AS n_out, coalesce(n_wd, 0) AS n_wd, coalesce(s_in, 0) AS s_in, coalesce(s_out, 0) AS s_out, coalesce(manual, 0) AS manual,
    coalesce(declined, 0) AS declined, coalesce(failed, 0) AS failed, coalesce(third, 0) AS third, coalesce(methods, 0) AS methods, coalesce(accounts, 0) AS accounts, pg.gap, coalesce(pg.fast, 0) AS fast, w.ratio,
    q.player_key IN (SELECT player_key FROM bets) AS active
  FROM players q LEFT JOIN tot USING (player_key) LEFT JOIN pg USING (player_key) LEFT JOIN (SELECT * FROM worst WHERE rn = 1) w USING (player_key)),
pay1 AS (SELECT *, CASE WHEN n_in = 0 THEN 'no_completed_deposits' WHEN n_out = 0 THEN 'no_completed_withdrawals' WHEN gap IS NULL THEN 'no_subsequent_completed_withdrawal' END AS pair_reason FROM pay0),
pay2 AS (SELECT *, CASE WHEN NOT active THEN 'casino_activity_not_observable' ELSE pair_reason END AS exit_reason FROM pay1),
pay AS (SELECT player_key, exit_reason, pair_reason,
    CASE WHEN exit_reason IS NULL THEN coalesce(ratio < 0.1, false) END AS pay_deposit_then_exit_flag,
    CASE WHEN exit_reason IS NULL THEN ratio END AS pay_intervening_turnover_ratio,
    CASE WHEN pair_reason IS NULL THEN gap END AS pay_min_minutes_deposit_to_withdrawal,
    CASE WHEN n_out > 0 THEN third > 0 END AS pay_third_party_withdrawal_flag, CASE WHEN n_out > 0 THEN third END AS pay_third_party_withdrawal_count,
    CASE WHEN n_in > 0 AND s_in >= 10000 THEN s_out / s_in END AS pay_withdrawal_to_deposit_ratio,
    CASE WHEN n_in = 0 THEN 'no_completed_deposits' WHEN s_in < 10000 THEN 'insufficient_deposit_denominator' END AS ratio_reason,
    CASE WHEN n_in > 0 AND n_out > 0 THEN fast END AS pay_fast_withdrawal_count,
    CASE WHEN n_in > 0 THEN manual END AS pay_manual_reconciliation_count, CASE WHEN n_in > 0 THEN manual / n_in END AS pay_manual_reconciliation_ratio,
    CASE WHEN n_wd > 0 THEN declined END AS pay_declined_withdrawal_count, CASE WHEN n_wd > 0 THEN failed END AS pay_failed_withdrawal_count,
    s_in - s_out AS pay_net_money_flow, methods AS pay_distinct_payment_methods, accounts AS pay_distinct_payment_accounts FROM pay2)"""
)

BET = """,
gaps AS (SELECT *, (epoch_us(created_at) - epoch_us(lag(created_at) OVER (PARTITION BY player_key, game ORDER BY created_at, ticket_id))) / 1e6 AS gap FROM bets WHERE player_key IN (SELECT player_key FROM players)),
gm AS (SELECT player_key, game, count(*) AS n, count(*) FILTER (status = 'SETTLED') AS settled, count(*) FILTER (status = 'SETTLED' AND won) AS wins, CASE WHEN coalesce(avg(gap), 0) = 0 THEN 0 ELSE stddev_pop(gap) / avg(gap) END AS cv,
    CASE WHEN avg(stake) > 0 THEN stddev_pop(stake) / avg(stake) ELSE 0 END AS scv, sum(stake) AS stakes FROM gaps GROUP BY 1, 2),
gt AS (SELECT player_key, max(wins / settled) FILTER (settled >= 30) AS rate, min(cv) FILTER (n >= 20) AS cv, max(scv) FILTER (n >= 10) AS scv, max(stakes) AS top FROM gm GROUP BY 1),
bt AS (SELECT player_key, count(*) AS n, sum(stake) AS stakes, coalesce(sum(stake_bonus), 0) AS bonus, avg(odds) AS om, stddev_pop(odds) AS os, count(DISTINCT created_at::DATE) AS days, count(*) FILTER (status = 'VOID') AS void FROM gaps GROUP BY 1),
bet AS (SELECT q.player_key, gt.rate AS bet_win_rate_vs_volume, gt.cv AS bet_timing_regularity, gt.scv AS bet_stake_volatility, CASE WHEN bt.stakes > 0 THEN bt.bonus / bt.stakes WHEN bt.n > 0 THEN 0 END AS bet_bonus_funded_stake_share,
    CASE WHEN bt.stakes > 0 THEN gt.top / bt.stakes WHEN bt.n > 0 THEN 0 END AS bet_game_type_concentration, bt.om AS bet_avg_odds, bt.os AS bet_odds_profile, coalesce(bt.n, 0) AS bet_count, coalesce(bt.days, 0) AS bet_active_days, bt.void / bt.n AS bet_void_rate,
    CASE WHEN bt.n IS NULL THEN 'no_bets' WHEN gt.rate IS NULL THEN 'insufficient_settled_bets' END AS rate_reason, CASE WHEN bt.n IS NULL THEN 'no_bets' WHEN gt.cv IS NULL THEN 'insufficient_bets_for_timing' END AS timing_reason,
    CASE WHEN bt.n IS NULL THEN 'no_bets' WHEN gt.scv IS NULL THEN 'insufficient_bets_for_volatility' END AS volatility_reason
  FROM players q LEFT JOIN bt USING (player_key) LEFT JOIN gt USING (player_key))"""

ALL_FEATURES = f"{MA}{PAY}{BET},\nwide AS (SELECT * FROM ma JOIN pay USING (player_key) JOIN bet USING (player_key))"

# Group, rule id, condition, points, and whether the rule scores by itself.
_RULES = [
    ("ma", "R-MA-01", "ma_nin_shared_account_count > 0", 35, True), ("ma", "R-MA-02", "ma_email_shared_account_count > 0", 30, True), ("ma", "R-MA-03", "ma_device_shared_account_count > 0", 25, True),
    ("ma", "R-MA-04", "ma_withdrawal_recipient_shared_count > 0", 35, True), ("ma", "R-MA-05", "ma_identity_phone_collision_count > 0", 40, True), ("ma", "R-MA-06", "ma_referred_by_linked_account", 15, False),
    ("ma", "R-MA-07", "ma_referral_fanout_count >= 3", 10, False), ("ma", "R-MA-08", "ma_cocreated_linked_count > 0", 15, False), ("pay", "R-PAY-01", "pay_deposit_then_exit_flag", 40, True), ("pay", "R-PAY-02", "pay_third_party_withdrawal_flag", 35, True),
    ("pay", "R-PAY-03", "pay_min_minutes_deposit_to_withdrawal <= 60", 10, False), ("pay", "R-PAY-04", "pay_withdrawal_to_deposit_ratio >= 1.5", 15, False), ("pay", "R-PAY-05", "pay_fast_withdrawal_count >= 2", 8, False),
    ("pay", "R-PAY-06", "pay_manual_reconciliation_count >= 2", 8, False), ("pay", "R-PAY-07", "pay_manual_reconciliation_ratio >= 0.25", 8, False), ("pay", "R-PAY-08", "pay_declined_withdrawal_count > 0", 8, False),
    ("bet", "R-BET-01", "bet_win_rate_vs_volume >= 0.7", 25, True), ("bet", "R-BET-02", "bet_timing_regularity <= 0.2", 25, True), ("bet", "R-BET-03", "bet_stake_volatility >= 1.0", 10, False), ("bet", "R-BET-04", "bet_bonus_funded_stake_share >= 0.5", 10, False),
]


def _gate(group: str) -> str:
    return "(" + " OR ".join(f"coalesce({c}, false)" for g, _, c, _, s in _RULES if g == group and s) + ")"


def _on(rule) -> str:
    group, _, condition, _, scoring = rule
    return f"coalesce({condition}, false)" + ("" if scoring else f" AND {_gate(group)}")


SCORED = (
    ALL_FEATURES
    + ",\nscored AS (SELECT player_key, "
    + ", ".join("CAST(" + " + ".join(f"CASE WHEN {_on(r)} THEN {r[3]} ELSE 0 END" for r in _RULES if r[0] == g) + f" AS DOUBLE) AS {name}" for g, name in (("ma", "multi_accounting_score"), ("pay", "payment_fraud_score"), ("bet", "betting_anomaly_score")))
    + ", concat_ws(',', "
    + ", ".join(f"CASE WHEN {_on(r)} THEN '{r[1]}' END" for r in _RULES)
    + ") AS rules FROM wide),\nflags AS (SELECT *, multi_accounting_score + payment_fraud_score + betting_anomaly_score AS overall_risk, CASE WHEN multi_accounting_score + payment_fraud_score + betting_anomaly_score >= 80 THEN 'high' WHEN multi_accounting_score + payment_fraud_score + betting_anomaly_score >= 40 THEN 'medium' ELSE 'low' END AS band FROM scored)"
)


def phone_sql(x: str) -> str:
    digits = f"regexp_replace({x}, '\\D', '', 'g')"
    a = f"CASE WHEN {digits} LIKE '256%' AND length({digits}) > 9 THEN substr({digits}, 4) ELSE {digits} END"
    return f"nullif(CASE WHEN ({a}) LIKE '0%' AND length({a}) > 9 THEN substr(({a}), 2) ELSE ({a}) END, '')"


def made_up_sql(p: str) -> str:
    """Patterns spelt out, for an engine without back-references."""
    five = " OR ".join(f"{p} LIKE '%{str(d) * 5}%'" for d in range(10))
    two = " OR ".join(f"{p} LIKE '%{f'{d:02d}' * 3}%'" for d in range(100))
    three = f"list_bool_or(list_transform(range(1, greatest(length({p}) - 4, 1)), lambda i: substr({p}, i, 3) = substr({p}, i + 3, 3) AND length(substr({p}, i + 3, 3)) = 3))"
    return f"coalesce({p} <> '' AND ({five} OR {two} OR coalesce({three}, false) OR length({p}) > 0 AND len(list_distinct(string_split({p}, ''))) <= 2), false)"


# Raw player documents and what identifiers resolve to.
IDENTITY = f"""
ev AS (SELECT event_id, ts, user_id, event_type, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
docs AS (SELECT c_custkey AS c, lpad(lower(to_hex(c_custkey)), 24, '0') AS id, '0' || {CUSTOMER_PHONE} AS username, CASE WHEN c_custkey % 4 <> 0 THEN '+256 ' || {CUSTOMER_PHONE} END AS contact, c_custkey % 13 = 0 AS gone FROM customer),
claims AS (SELECT DISTINCT {CUSTOMER_PHONE} AS phone, id, NOT gone AS live, c FROM docs JOIN customer ON c = c_custkey),
owners AS (SELECT phone, arg_max(id, (CASE WHEN live THEN 1000000000 ELSE 0 END) + c) AS id, count(*) AS n FROM claims GROUP BY 1),
early AS (SELECT CAST(712345000 + s_suppkey AS VARCHAR) AS phone FROM supplier),
feed AS (SELECT event_id, ts, user_id, event_type, value, k, {LOGIN_ID} AS login FROM ev),
phoned AS (SELECT *, {phone_sql("login")} AS phone FROM feed),
found AS (SELECT f.*, coalesce(d.id, o.id) AS player_key, CASE WHEN d.id IS NULL AND o.id IS NULL THEN CASE WHEN f.phone IN (SELECT phone FROM early) AND f.phone NOT IN (SELECT phone FROM owners) THEN 'pre_registration' WHEN {made_up_sql("f.phone")} THEN 'test_pattern' ELSE 'unknown' END END AS unjoined_class
  FROM phoned f LEFT JOIN docs d ON d.id = lower(f.login) LEFT JOIN owners o ON o.phone = f.phone)"""


# What the evidence of the features says, item by item.
_KIND = "CASE kt WHEN 'nin_hash' THEN 0 WHEN 'email_hash' THEN 1 WHEN 'fingerprint' THEN 2 ELSE 3 END"
EVIDENCE_MA = f"""WITH {MA},
rec AS (SELECT DISTINCT 'fingerprint' AS kt, fingerprint AS sk, player_key AS p, source_id AS r FROM logins UNION SELECT 'recipient_normalized', recipient, player_key, transaction_id FROM done WHERE recipient IS NOT NULL),
recs AS (SELECT kt, sk, p, string_agg(r, ',' ORDER BY r) AS rs FROM rec GROUP BY ALL),
kinds AS (SELECT DISTINCT p, o, kt, sk FROM links WHERE kt <> 'normalized_phone'),
both_keys AS (SELECT p, o, string_agg(kt || ':' || sk, ';' ORDER BY {_KIND}, sk) AS ks FROM kinds GROUP BY ALL),
mine AS (SELECT c.player_key AS p, c.referred_by_key AS o, string_agg(a.kt || ':' || a.sk, ';' ORDER BY {_KIND.replace("kt", "a.kt")}, a.sk) AS ks FROM players c JOIN own a ON a.p = c.player_key JOIN own b ON b.p = c.referred_by_key AND a.kt = b.kt AND a.sk = b.sk GROUP BY ALL)
SELECT l.p AS player_key, CASE l.kt WHEN 'nin_hash' THEN 'ma_nin_shared_account_count' WHEN 'email_hash' THEN 'ma_email_shared_account_count' WHEN 'fingerprint' THEN 'ma_device_shared_account_count' WHEN 'recipient_normalized' THEN 'ma_withdrawal_recipient_shared_count' ELSE 'ma_identity_phone_collision_count' END AS feature_name, l.sk AS item,
  string_agg(l.o, ',' ORDER BY l.o) || '|' || coalesce(any_value(a.rs), '') || '|' || string_agg(l.o || '=' || coalesce(b.rs, ''), ';' ORDER BY l.o) AS detail, CAST(NULL AS DOUBLE) AS x, CAST(NULL AS DOUBLE) AS y
  FROM links l LEFT JOIN recs a ON a.kt = l.kt AND a.sk = l.sk AND a.p = l.p LEFT JOIN recs b ON b.kt = l.kt AND b.sk = l.sk AND b.p = l.o WHERE l.kt <> 'recipient_normalized' OR l.p IN (SELECT player_key FROM done) GROUP BY l.p, l.kt, l.sk
UNION ALL SELECT p, 'ma_referred_by_linked_account', o, ks, NULL, NULL FROM mine
UNION ALL SELECT DISTINCT referred_by_key, 'ma_referral_fanout_count', player_key, NULL, NULL, NULL FROM players WHERE referred_by_key IN (SELECT player_key FROM players)
UNION ALL SELECT k.p, 'ma_cocreated_linked_count', k.o, k.ks, round(abs(epoch(a.created_at) - epoch(b.created_at)) / 60, 6), NULL FROM both_keys k JOIN players a ON a.player_key = k.p JOIN players b ON b.player_key = k.o WHERE abs(epoch(a.created_at) - epoch(b.created_at)) <= 900
UNION ALL SELECT DISTINCT p, 'ma_device_count', sk, NULL, NULL, NULL FROM obs WHERE kt = 'fingerprint'"""

EVIDENCE_PAY = f"""WITH {ORACLE}{PAY},
mm AS (SELECT * FROM money WHERE player_key IN (SELECT player_key FROM players)),
near AS (SELECT *, row_number() OVER (PARTITION BY player_key ORDER BY gap, d_id, w_id) AS nr FROM pairs),
ex AS (SELECT w.player_key, w.d_id || '>' || w.w_id AS item, coalesce((SELECT string_agg(b.ticket_id, ',' ORDER BY b.ticket_id) FROM bets b JOIN trig t ON t.d_id = w.d_id AND t.w_id = w.w_id AND t.player_key = w.player_key WHERE b.player_key = t.player_key AND b.created_at >= t.d_at AND b.created_at <= t.w_at), '') AS detail,
  round(w.w_amount / w.d_amount * 100, 6) AS x, round(w.stake_sum, 6) AS y FROM worst w JOIN pay p ON p.player_key = w.player_key WHERE w.rn = 1 AND p.exit_reason IS NULL)
SELECT player_key, 'pay_deposit_then_exit_flag' AS feature_name, item, detail, x, y FROM ex
UNION ALL SELECT player_key, 'pay_intervening_turnover_ratio', item, detail, x, y FROM ex
UNION ALL SELECT player_key, 'pay_min_minutes_deposit_to_withdrawal', d_id || '>' || w_id, NULL, round(gap, 6), NULL FROM near WHERE nr = 1
UNION ALL SELECT player_key, f, transaction_id, recipient, NULL, NULL FROM mm, (SELECT unnest(['pay_third_party_withdrawal_flag', 'pay_third_party_withdrawal_count']) AS f) WHERE is_out AND third
UNION ALL SELECT player_key, 'pay_withdrawal_to_deposit_ratio', '', NULL, round(s_in, 6), round(s_out, 6) FROM pay0 WHERE n_in > 0 AND s_in >= 10000
UNION ALL SELECT player_key, 'pay_fast_withdrawal_count', d_id || '>' || w_id, NULL, NULL, NULL FROM pairs WHERE gap <= 60
UNION ALL SELECT player_key, f, transaction_id, NULL, NULL, NULL FROM mm, (SELECT unnest(['pay_manual_reconciliation_count', 'pay_manual_reconciliation_ratio']) AS f) WHERE is_in AND final_status = 'manual_reconciliation'
UNION ALL SELECT player_key, 'pay_' || final_status || '_withdrawal_count', transaction_id, NULL, NULL, NULL FROM mm WHERE txn_type = 'WITHDRAWAL' AND final_status IN ('declined', 'failed')
UNION ALL SELECT player_key, 'pay_net_money_flow', '', NULL, round(s_in, 6), round(s_out, 6) FROM pay0
UNION ALL SELECT DISTINCT player_key, 'pay_distinct_payment_methods', payment_method, NULL, NULL, NULL FROM mm
UNION ALL SELECT DISTINCT player_key, 'pay_distinct_payment_accounts', account_number, NULL, NULL, NULL FROM mm"""

EVIDENCE_BET = f"""WITH {ORACLE}{BET},
b AS (SELECT g.*, e.k FROM gaps g JOIN ev e ON 'B' || e.event_id = g.ticket_id),
gs AS (SELECT player_key, game, string_agg(ticket_id, ',' ORDER BY ticket_id) AS ids, coalesce(string_agg(ticket_id, ',' ORDER BY ticket_id) FILTER (status = 'SETTLED' AND won), '') AS winning, count(gap) AS n_gaps, arg_min(ticket_id, struct_pack(a := stake, b := ticket_id)) AS low, arg_max(ticket_id, struct_pack(a := stake, b := ticket_id)) AS high, max(stake) - min(stake) AS spread FROM b GROUP BY ALL),
ps AS (SELECT player_key, string_agg(ticket_id, ',' ORDER BY ticket_id) AS ids, string_agg(ticket_id, ',' ORDER BY ticket_id) FILTER (stake_bonus > 0 OR k % 10 = 0) AS bonus_ids, max(odds) - min(odds) AS odds_range FROM b GROUP BY 1)
SELECT player_key, 'bet_win_rate_vs_volume' AS feature_name, game AS item, winning AS detail, round(wins / settled, 6) AS x, settled::DOUBLE AS y FROM gm JOIN gs USING (player_key, game) WHERE settled >= 30
UNION ALL SELECT player_key, 'bet_timing_regularity', game, ids, round(cv, 6), n_gaps::DOUBLE FROM gm JOIN gs USING (player_key, game) WHERE n >= 20
UNION ALL SELECT player_key, 'bet_stake_volatility', game, CASE WHEN low < high THEN low || ',' || high WHEN low > high THEN high || ',' || low ELSE low END, round(scv, 6), round(spread, 6) FROM gm JOIN gs USING (player_key, game) WHERE n >= 10
UNION ALL SELECT player_key, 'bet_bonus_funded_stake_share', '', bonus_ids, round(bonus, 6), round(stakes, 6) FROM bt JOIN ps USING (player_key) WHERE bonus_ids IS NOT NULL
UNION ALL SELECT gm.player_key, 'bet_game_type_concentration', game, NULL, round(CASE WHEN bt.stakes > 0 THEN gm.stakes / bt.stakes ELSE 0 END, 6), gm.n::DOUBLE FROM gm JOIN bt USING (player_key)
UNION ALL SELECT player_key, 'bet_avg_odds', '', ids, n::DOUBLE, NULL FROM bt JOIN ps USING (player_key)
UNION ALL SELECT player_key, 'bet_odds_profile', '', ids, round(om, 6), round(odds_range, 6) FROM bt JOIN ps USING (player_key)
UNION ALL SELECT player_key, 'bet_count', '', ids, NULL, NULL FROM ps
UNION ALL SELECT DISTINCT player_key, 'bet_active_days', CAST(created_at::DATE AS VARCHAR), NULL, NULL, NULL FROM b
UNION ALL SELECT player_key, 'bet_void_rate', ticket_id, NULL, NULL, NULL FROM b WHERE status = 'VOID'"""


# Reasons of fired rules, from the evidence above.
def _list(x: str) -> str:
    return f"'[' || string_agg(DISTINCT {x}, ', ' ORDER BY {x}) || ']'"


_SHARED_RULES = {"R-MA-01": ("nin_hash", "shares NIN hash with"), "R-MA-02": ("email_hash", "shares email hash with"), "R-MA-03": ("fingerprint", "shares valid device fingerprint with")}
REASONS = (
    SCORED
    + f""",
em AS ({EVIDENCE_MA}), ep AS ({EVIDENCE_PAY}), eb AS ({EVIDENCE_BET}),
others AS (SELECT p AS player_key, kt, count(DISTINCT o) AS n, {_list("o")} AS os, {_list("sk")} AS ks FROM links GROUP BY ALL),
ids AS (SELECT player_key, feature_name, {_list("item")} AS items, count(*) AS n FROM (SELECT * FROM em UNION ALL SELECT * FROM ep UNION ALL SELECT * FROM eb) GROUP BY ALL),
kinds AS (SELECT c.player_key, {_list("a.kt")} AS ts, any_value(c.referred_by_key) AS ref FROM players c JOIN own a ON a.p = c.player_key JOIN own b ON b.p = c.referred_by_key AND a.kt = b.kt AND a.sk = b.sk GROUP BY 1),
first_win AS (SELECT player_key, arg_min(struct_pack(s := settled, w := wins), struct_pack(o := -wins / settled, g := game)) AS e FROM gm WHERE settled >= 30 GROUP BY 1),
timed AS (SELECT player_key, sum(n) AS n FROM gm WHERE n >= 20 GROUP BY 1),
first_stake AS (SELECT g.player_key, arg_min(struct_pack(a := g.low, b := g.high), struct_pack(o := -m.scv, g := g.game)) AS e FROM (SELECT player_key, game, min(stake) AS low, max(stake) AS high FROM gaps GROUP BY ALL) g JOIN gm m USING (player_key, game) WHERE m.n >= 10 GROUP BY 1),
said AS (
"""
    + " UNION ALL ".join(f"SELECT player_key, '{r}' AS rule_id, '{text} ' || n || ' other account(s): ' || os AS reason FROM others WHERE kt = '{kt}'" for r, (kt, text) in _SHARED_RULES.items())
    + """
UNION ALL SELECT player_key, 'R-MA-04', 'shares withdrawal recipient(s) ' || ks || ' with ' || n || ' other account(s): ' || os FROM others WHERE kt = 'recipient_normalized'
UNION ALL SELECT player_key, 'R-MA-05', 'normalized phone collides with ' || n || ' other player record(s): ' || os FROM others WHERE kt = 'normalized_phone'
UNION ALL SELECT player_key, 'R-MA-06', 'referred by linked account ' || ref || ' with corroborating linkage ' || ts FROM kinds
UNION ALL SELECT player_key, 'R-MA-07', 'referred ' || n || ' account(s): ' || items FROM ids WHERE feature_name = 'ma_referral_fanout_count'
UNION ALL SELECT player_key, 'R-MA-08', 'created close in time to ' || n || ' directly linked account(s): ' || items FROM ids WHERE feature_name = 'ma_cocreated_linked_count'
UNION ALL SELECT player_key, 'R-PAY-01', 'deposit ' || replace(item, '>', ' -> withdrawal ') || ': withdrew ' || printf('%.1f', x) || '% of deposit, intervening stake ' || printf('%g', y) FROM ep WHERE feature_name = 'pay_deposit_then_exit_flag'
UNION ALL SELECT player_key, 'R-PAY-02', 'completed withdrawal to third-party recipient(s) ' || '[' || string_agg(DISTINCT detail, ', ' ORDER BY detail) || ']' FROM ep WHERE feature_name = 'pay_third_party_withdrawal_flag' GROUP BY 1
UNION ALL SELECT player_key, 'R-PAY-03', 'minimum deposit-to-withdrawal gap is ' || printf('%.1f', x) || ' min via ' || replace(item, '>', '->') FROM ep WHERE feature_name = 'pay_min_minutes_deposit_to_withdrawal'
UNION ALL SELECT player_key, 'R-PAY-04', 'withdrawal/deposit ratio is ' || printf('%.2f', y / x) || '; completed money_out UGX ' || printf('%g', y) || ' / completed money_in UGX ' || printf('%g', x) FROM ep WHERE feature_name = 'pay_withdrawal_to_deposit_ratio'
UNION ALL SELECT player_key, 'R-PAY-05', n || ' fast withdrawal(s) after deposits' FROM ids WHERE feature_name = 'pay_fast_withdrawal_count'
UNION ALL SELECT player_key, 'R-PAY-06', n || ' manual reconciliation deposit(s): ' || items FROM ids WHERE feature_name = 'pay_manual_reconciliation_count'
UNION ALL SELECT player_key, 'R-PAY-07', 'manual reconciliation ratio is ' || printf('%.2f', pay_manual_reconciliation_ratio) || '; deposit IDs ' || items FROM ids JOIN pay USING (player_key) WHERE feature_name = 'pay_manual_reconciliation_ratio'
UNION ALL SELECT player_key, 'R-PAY-08', n || ' declined withdrawal(s): ' || items FROM ids WHERE feature_name = 'pay_declined_withdrawal_count'
UNION ALL SELECT player_key, 'R-BET-01', 'settled win rate ' || printf('%.2f', bet_win_rate_vs_volume) || ' over ' || e.s || ' settled bet(s); wins ' || e.w FROM first_win JOIN bet USING (player_key)
UNION ALL SELECT player_key, 'R-BET-02', 'near-regular betting cadence: CV ' || printf('%.3f', bet_timing_regularity) || ' across ' || timed.n || ' ticket(s)' FROM timed JOIN bet USING (player_key)
UNION ALL SELECT player_key, 'R-BET-03', 'stake volatility CV ' || printf('%.2f', bet_stake_volatility) || '; stake range ' || printf('%g', e.a) || '-' || printf('%g', e.b) FROM first_stake JOIN bet USING (player_key)
UNION ALL SELECT player_key, 'R-BET-04', 'bonus-funded stake share ' || printf('%.2f', bet_bonus_funded_stake_share) || '; bonus tickets [' || replace(detail, ',', ', ') || ']' FROM eb JOIN bet USING (player_key) WHERE feature_name = 'bet_bonus_funded_stake_share'),
fired AS (SELECT player_key, unnest(string_split(rules, ',')) AS rule_id FROM flags),
pts AS (SELECT * FROM (VALUES """
    + ", ".join(f"('{r[1]}', {r[3]})" for r in _RULES)
    + ") AS t(rule_id, points))"
)


def forest_sql(trees: int = 100, seed: int = 42, subsample: int = 256) -> str:
    """The isolation forest: draws, trees and scores of all players, level by level."""
    numeric = [n for n, s in ALL.items() if s.kind != "bool"]
    levels = math.ceil(math.log2(subsample))
    value = "s.lo + s.share * (s.hi - s.lo)"
    parts = [
        "medians AS (SELECT " + ", ".join(f"median({n}::DOUBLE) AS {n}" for n in numeric) + " FROM wide)",
        "filled AS MATERIALIZED (SELECT w.player_key, [" + ", ".join(f"round(coalesce(w.{n}::DOUBLE, m.{n}, 0), 6)" for n in numeric) + "] AS x FROM wide w, medians m)",
        f"""walk0 AS MATERIALIZED (SELECT tree, player_key, x, 1 AS node,
  row_number() OVER (PARTITION BY tree ORDER BY md5('{seed}:' || tree || ':' || player_key), player_key) <= {subsample} AS drawn FROM filled, range({trees}) t(tree))""",
        f"size AS (SELECT least({subsample}, count(*)) AS n FROM filled)",
    ]
    for d in range(levels):
        parts += [
            f"""cells{d} AS (SELECT tree, node, i, min(x[i + 1]) AS lo, max(x[i + 1]) AS hi FROM walk{d}, range({len(numeric)}) t(i) WHERE drawn GROUP BY ALL HAVING lo < hi)""",
            f"""ranked{d} AS (SELECT *, md5('{seed}:' || tree || ':' || node) AS h, row_number() OVER (PARTITION BY tree, node ORDER BY i) - 1 AS k, count(*) OVER (PARTITION BY tree, node) AS usable FROM cells{d})""",
            f"""split{d} AS MATERIALIZED (SELECT s.tree, s.node, s.i, CASE WHEN {value} <= s.lo THEN s.hi ELSE {value} END AS value
  FROM (SELECT *, ('0x' || h[9:16])::BIGINT / 4294967296.0::DOUBLE AS share FROM ranked{d} WHERE k = ('0x' || h[1:8])::BIGINT % usable) s, size WHERE {d} < ceil(log2(size.n)))""",
            f"""walk{d + 1} AS MATERIALIZED (SELECT w.tree, w.player_key, w.x, w.drawn, CASE WHEN s.node IS NULL THEN w.node WHEN w.x[s.i + 1] < s.value THEN 2 * w.node ELSE 2 * w.node + 1 END AS node
  FROM walk{d} w LEFT JOIN split{d} s ON s.tree = w.tree AND s.node = w.node)""",
        ]
    mean = "(CASE WHEN {n} > 2 THEN 2 * (ln({n} - 1) + 0.5772156649015329) - 2 * ({n} - 1) / {n}::DOUBLE WHEN {n} = 2 THEN 1 ELSE 0 END)"
    parts += [
        f"leaves AS (SELECT tree, node, round((floor(log2(node)) + {mean.format(n='count(*)')}) * 1e9)::BIGINT AS credit FROM walk{levels} WHERE drawn GROUP BY tree, node)",
        f"lengths AS (SELECT player_key, sum(credit)::DOUBLE / 1e9 / {trees} AS length FROM walk{levels} JOIN leaves USING (tree, node) GROUP BY 1)",
    ]
    score = f"CASE WHEN n < 2 THEN 0 ELSE -pow(2.0, -(length / {mean.format(n='n')})) END"
    return f"WITH {ALL_FEATURES},\n" + ",\n".join(parts) + f"\nSELECT player_key, round({score}, 6) AS iforest_score_untrusted FROM lengths, size"
