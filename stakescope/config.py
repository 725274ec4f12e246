"""Settings: statuses, thresholds, content-delivery ranges, rules, bands; all can be replaced by the caller."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field, replace
from functools import lru_cache

# The public address ranges of one content-delivery network, as listed in the settings to be matched.
CDN_RANGES = (
    "173.245.48.0/20", "103.21.244.0/22", "103.22.200.0/22", "103.31.4.0/22", "141.101.64.0/18", "108.162.192.0/18", "190.93.240.0/20", "188.114.96.0/20",
    "197.234.240.0/22", "198.41.128.0/17", "162.158.0.0/15", "104.16.0.0/13", "104.24.0.0/14", "172.64.0.0/13", "131.0.72.0/22",
)
# Life-cycle order of withdrawal states, state groups, bonus types, decisions, fraud types.
STATUS_RANK = {"initiated": 1, "pending": 2, "failed": 3, "declined": 4, "completed": 5}
DEPOSIT_IN = ("completed", "manual_reconciliation")
WITHDRAWAL_OUT = ("completed",)
WITHDRAWAL_PENDING = ("initiated", "pending")
BONUS_TYPES = ("ALLOCATED", "RELEASE", "CONSUME", "EXPIRED")
CURRENCY = "UGX"


class ConfigError(ValueError):
    """A setting is missing or cannot be used."""


@dataclass(frozen=True)
class Thresholds:
    """Windows, gates and caps of the features."""

    # The defaults to be matched.
    cocreation_minutes: float = 15
    device_max_players: int = 10
    fast_minutes: float = 60
    pct_withdrawn: float = 0.80
    turnover_pct: float = 0.10
    min_deposit: float = 10_000
    min_settled: int = 30
    min_timing: int = 20
    min_volatility: int = 10

    def __post_init__(self) -> None:
        if self.device_max_players < 1:
            raise ConfigError("device_max_players must be at least 1")

    @classmethod
    def of(cls, **values: float) -> Thresholds:
        unknown = set(values) - set(cls.__dataclass_fields__)
        if unknown:
            raise ConfigError(f"unknown thresholds: {', '.join(sorted(unknown))}")
        return replace(cls(), **values)


@dataclass(frozen=True)
class RuleSpec:
    """One rule as written in the settings: what it looks at, when it fires, what it is worth and what it says."""

    rule_id: str
    feature: str
    op: str
    points: float
    threshold: float | None
    reason: str


# Rule ids, features, conditions, points, thresholds and reason texts.
RULES = (
    RuleSpec("R-MA-01", "ma_nin_shared_account_count", "gt", 35, 0, "shares NIN hash with {value_int} other account(s): {other_player_keys} (+{points:g})"),
    RuleSpec("R-MA-02", "ma_email_shared_account_count", "gt", 30, 0, "shares email hash with {value_int} other account(s): {other_player_keys} (+{points:g})"),
    RuleSpec("R-MA-03", "ma_device_shared_account_count", "gt", 25, 0, "shares valid device fingerprint with {value_int} other account(s): {other_player_keys} (+{points:g})"),
    RuleSpec("R-MA-04", "ma_withdrawal_recipient_shared_count", "gt", 35, 0, "shares withdrawal recipient(s) {shared_keys} with {value_int} other account(s): {other_player_keys} (+{points:g})"),
    RuleSpec("R-MA-05", "ma_identity_phone_collision_count", "gt", 40, 0, "normalized phone collides with {value_int} other player record(s): {other_player_keys} (+{points:g})"),
    RuleSpec("R-MA-06", "ma_referred_by_linked_account", "is_true", 15, None, "referred by linked account {referrer_player_key} with corroborating linkage {shared_key_types} (+{points:g})"),
    RuleSpec("R-MA-07", "ma_referral_fanout_count", "gte", 10, 3, "referred {value_int} account(s): {referred_player_keys} (+{points:g})"),
    RuleSpec("R-MA-08", "ma_cocreated_linked_count", "gt", 15, 0, "created close in time to {value_int} directly linked account(s): {other_player_keys} (+{points:g})"),
    RuleSpec("R-PAY-01", "pay_deposit_then_exit_flag", "is_true", 40, None, "deposit {deposit_id} -> withdrawal {withdrawal_id}: withdrew {pct_withdrawn:.1f}% of deposit, intervening stake {intervening_stake_sum:g} (+{points:g})"),
    RuleSpec("R-PAY-02", "pay_third_party_withdrawal_flag", "is_true", 35, None, "completed withdrawal to third-party recipient(s) {recipient_numbers} (+{points:g})"),
    RuleSpec("R-PAY-03", "pay_min_minutes_deposit_to_withdrawal", "lte", 10, 60, "minimum deposit-to-withdrawal gap is {value:.1f} min via {deposit_id}->{withdrawal_id} (+{points:g})"),
    RuleSpec("R-PAY-04", "pay_withdrawal_to_deposit_ratio", "gte", 15, 1.5, "withdrawal/deposit ratio is {value:.2f}; {reason_text} (+{points:g})"),
    RuleSpec("R-PAY-05", "pay_fast_withdrawal_count", "gte", 8, 2, "{value_int} fast withdrawal(s) after deposits (+{points:g})"),
    RuleSpec("R-PAY-06", "pay_manual_reconciliation_count", "gte", 8, 2, "{value_int} manual reconciliation deposit(s): {deposit_ids} (+{points:g})"),
    RuleSpec("R-PAY-07", "pay_manual_reconciliation_ratio", "gte", 8, 0.25, "manual reconciliation ratio is {value:.2f}; deposit IDs {deposit_ids} (+{points:g})"),
    RuleSpec("R-PAY-08", "pay_declined_withdrawal_count", "gt", 8, 0, "{value_int} declined withdrawal(s): {withdrawal_ids} (+{points:g})"),
    RuleSpec("R-BET-01", "bet_win_rate_vs_volume", "gte", 25, 0.70, "settled win rate {value:.2f} over {settled_bets} settled bet(s); wins {wins} (+{points:g})"),
    RuleSpec("R-BET-02", "bet_timing_regularity", "lte", 25, 0.20, "near-regular betting cadence: CV {value:.3f} across {ticket_count} ticket(s) (+{points:g})"),
    RuleSpec("R-BET-03", "bet_stake_volatility", "gte", 10, 1.0, "stake volatility CV {value:.2f}; stake range {min_stake:g}-{max_stake:g} (+{points:g})"),
    RuleSpec("R-BET-04", "bet_bonus_funded_stake_share", "gte", 10, 0.50, "bonus-funded stake share {value:.2f}; bonus tickets {bonus_staked_ticket_ids} (+{points:g})"),
)


@dataclass(frozen=True)
class Settings:
    """Everything a run needs besides its inputs."""

    # The defaults to be matched.
    thresholds: Thresholds = field(default_factory=Thresholds)
    rules: tuple[RuleSpec, ...] = RULES
    ruleset_version: str = "2026-06-25.1"
    medium_cut: float = 40
    high_cut: float = 80
    iforest_enabled: bool = True
    iforest_weight: float = 0
    iforest_trees: int = 100
    iforest_seed: int = 42
    report_top_n: int = 20
    routing_bands: tuple[str, ...] = ("medium", "high")
    samples_per_class: int = 10


@lru_cache(maxsize=8)
def load_settings(path: str | None = None, complete: bool = False) -> Settings:
    """The defaults, or those of a JSON or YAML file whose keys name fields of Settings and Thresholds; unknown keys are errors.

    complete: the file must give every threshold. A file is read once.
    """
    if path is None:
        return Settings()
    with open(path, encoding="utf-8") as f:
        if path.endswith((".yaml", ".yml")):
            try:
                import yaml
            except ImportError as error:
                raise ConfigError("YAML settings need the yaml library; JSON does not") from error
            given = yaml.safe_load(f) or {}
        else:
            given = json.load(f)
    values = given.pop("thresholds", {})
    missing = set(Thresholds.__dataclass_fields__) - set(values)
    if complete and missing:
        raise ConfigError(f"missing thresholds: {', '.join(sorted(missing))}")
    thresholds = Thresholds.of(**values)
    unknown = set(given) - set(Settings.__dataclass_fields__)
    if unknown:
        raise ConfigError(f"unknown settings: {', '.join(sorted(unknown))}")
    if "rules" in given:
        given["rules"] = tuple(RuleSpec(**r) for r in given["rules"])
    if "routing_bands" in given:
        given["routing_bands"] = tuple(given["routing_bands"])
    return replace(Settings(thresholds=thresholds), **given)


def secret(name: str) -> str:
    """A secret from the environment; an error if it is unset or empty."""
    value = os.environ.get(name, "")
    if not value:
        raise ConfigError(f"environment variable {name} is not set")
    return value
