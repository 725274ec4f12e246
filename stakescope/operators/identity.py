"""Identity resolution: messy identifiers to one player key, through a small table of known identifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S

OBJECT, PLAYER_ID, REFERRAL, PHONE, PRE_REGISTRATION = "objectid", "player_id", "referral_code", "phone", "pre_registration"


def phone_candidates(players: DataFrame) -> DataFrame:
    """(phone, player) for every distinct normalised phone of a player, with what decides who owns it."""
    phones = F.array_distinct(F.filter(F.array(S.normalize_phone("username"), S.normalize_phone("contactNo")), lambda p: p.isNotNull()))
    claim = F.struct((~F.coalesce("isDeleted", F.lit(False))).alias("live"), S.utc("createdAt").alias("created"), F.col("_id").alias("key"))
    return players.where(F.col("_id").isNotNull()).select(F.explode(phones).alias("phone"), claim.alias("claim"))


def phone_owners(players: DataFrame) -> DataFrame:
    """(phone, player_key, claimants, losing_keys): the owner is the live, latest created, greatest key; losers sorted."""
    owners = phone_candidates(players).groupBy("phone").agg(F.max("claim").alias("best"), F.collect_set("claim.key").alias("keys"))
    winner = F.col("best.key")
    return owners.select("phone", winner.alias("player_key"), F.size("keys").alias("claimants"), F.array_sort(F.array_except("keys", F.array(winner))).alias("losing_keys"))


def phone_collisions(players: DataFrame) -> DataFrame:
    return phone_owners(players).where("claimants > 1").select("phone", F.col("player_key").alias("winning_key"), "losing_keys")


def pre_registration_phones(otps: DataFrame, owners: DataFrame) -> DataFrame:
    phones = otps.select(S.normalize_phone("contactNo").alias("phone")).where(F.col("phone").isNotNull()).distinct()
    return phones.join(owners.select("phone"), "phone", "left_anti")


def identity_map(players: DataFrame, otps: DataFrame | None = None) -> DataFrame:
    """(id_kind, id_value, player_key): one row for each known identifier.

    Player numbers and referral codes that stand for several players resolve to the greatest player key, which does not
    depend on the order of the rows.
    """
    known = players.where(F.col("_id").isNotNull())
    owners = phone_owners(players)

    def kind(name: str, value: Column) -> DataFrame:
        rows = known.select(F.lit(name).alias("id_kind"), value.alias("id_value"), F.col("_id").alias("player_key"))
        return rows.where("id_value is not null and id_value <> ''").groupBy("id_kind", "id_value").agg(F.max("player_key").alias("player_key"))

    out = kind(OBJECT, F.lower("_id")).unionByName(kind(PLAYER_ID, F.col("playerId"))).unionByName(kind(REFERRAL, F.trim("referralCode")))
    out = out.unionByName(owners.select(F.lit(PHONE).alias("id_kind"), F.col("phone").alias("id_value"), "player_key"))
    if otps is not None:
        early = pre_registration_phones(otps, owners)
        out = out.unionByName(early.select(F.lit(PRE_REGISTRATION).alias("id_kind"), F.col("phone").alias("id_value"), F.lit(None).cast("string").alias("player_key")))
    return out


def resolve(df: DataFrame, column: str, ids: DataFrame, player_id: bool = False, referral: bool = False, key: str = "player_key", label: str = "unjoined_class") -> DataFrame:
    """df with the player key and, where there is none, why: pre_registration, test_pattern or unknown.

    Order: object id, then player number and referral code if asked for, then phone. An object id that is not known goes
    on as a phone of its digits. Phones of players and early phones are one lookup (no phone is both). Each lookup is a
    left join on a value made once; Spark broadcasts the identifiers where they are small enough, and shuffles otherwise.
    """
    text = F.trim(F.col(column).cast("string"))
    steps = [((OBJECT,), F.when(S.is_objectid_hex(text), F.lower(text)))]
    steps += [((PLAYER_ID,), text)] if player_id else []
    steps += [((REFERRAL,), text)] if referral else []
    steps += [((PHONE, PRE_REGISTRATION), S.normalize_phone(column))]
    df = df.withColumns({f"_v{i}": value for i, (_, value) in enumerate(steps)})
    for i, (kinds, _) in enumerate(steps):
        side = ids.where(F.col("id_kind").isin(*kinds)).select(F.col("id_value").alias(f"_v{i}"), F.col("player_key").alias(f"_key{i}"), F.lit(True).alias(f"_hit{i}"))
        df = df.join(side, f"_v{i}", "left")
    last = len(steps) - 1
    why = F.when(F.col(f"_hit{last}"), "pre_registration").when(S.looks_like_test_number(f"_v{last}"), "test_pattern").otherwise("unknown")
    df = df.withColumn(key, F.coalesce(*(f"_key{i}" for i in range(len(steps)))))
    return df.withColumn(label, F.when(F.col(key).isNull(), why)).drop(*(f"_{x}{i}" for x in ("v", "key", "hit") for i in range(len(steps))))
