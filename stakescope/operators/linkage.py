"""One-hop linkage: observations of shared keys, capped, joined into edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from .guards import population

NIN, EMAIL, DEVICE, RECIPIENT, PHONE = "nin_hash", "email_hash", "fingerprint", "recipient_normalized", "normalized_phone"
CORROBORATING = (NIN, EMAIL, DEVICE, RECIPIENT)
#: A key with more holders is hot: its unions are counted by classes of players, its pairs dealt in tiles.
HOT_HOLDERS = 1000
#: Holders of a tile's side; a key's rows are repeated as often as a side has tiles.
TILE_HOLDERS = 2000
#: Players with more shared keys meet by grouping their pairs; lists of all others' keys travel with their rows.
LISTED_KEYS = 64


def frame_observations(df: DataFrame, key_type: str, key: str, record: Column | None = None, once: bool = True) -> DataFrame:
    """Distinct (key_type, shared_key, player_key, record_id); empty keys and players are left out. once=False: rows may repeat."""
    rows = df.select(F.lit(key_type).alias("key_type"), F.col(key).cast("string").alias("shared_key"), F.col("player_key").cast("string").alias("player_key"), (record if record is not None else F.lit(None)).cast("string").alias("record_id"))
    rows = rows.where("shared_key <> '' and player_key <> ''")
    return rows.distinct() if once else rows


def completed_withdrawals(money: DataFrame, players: DataFrame) -> DataFrame:
    return population(money.where((F.col("txn_type") == "WITHDRAWAL") & F.coalesce("is_money_out", F.lit(False))), players)


def observations(players: DataFrame, logins: DataFrame, money: DataFrame, once: bool = True) -> DataFrame:
    """All five kinds of observations in one long table. once=False: rows may repeat, for holders, which makes them one."""
    people = players.where(F.col("player_key").isNotNull())
    used = population(logins.where((F.col("user_type") == "PLAYER") & S.is_fingerprint_hex("fingerprint")), people)
    parts = [frame_observations(people, kind, key, once=once) for kind, key in ((NIN, NIN), (EMAIL, EMAIL), (PHONE, "phone"))]
    parts += [frame_observations(used, DEVICE, DEVICE, F.col("source_id"), once), frame_observations(completed_withdrawals(money, people), RECIPIENT, RECIPIENT, F.col("transaction_id"), once)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def holders(obs: DataFrame, records: bool = True) -> DataFrame:
    """(key_type, shared_key, player_key, record_ids sorted): one row for each player of a key. records=False: none are listed."""
    if not records:
        return obs.select("key_type", "shared_key", "player_key").distinct().withColumn("record_ids", F.array().cast("array<string>"))
    return obs.groupBy("key_type", "shared_key", "player_key").agg(F.array_sort(F.collect_set("record_id")).alias("record_ids"))


def shared_holders(held: DataFrame, device_cap: int) -> DataFrame:
    """Holders of keys that at least two players have, with the key's number of `players`; fingerprints with more than device_cap players are left out before any join."""
    sizes = held.groupBy("key_type", "shared_key").agg(F.count(F.lit(1)).alias("players")).where(F.col("players") >= 2)
    return held.join(sizes.where((F.col("key_type") != DEVICE) | (F.col("players") <= device_cap)), ["key_type", "shared_key"])


def _tile(players: str = "players", hot: int = HOT_HOLDERS) -> tuple[Column, Column]:
    """Into how many parts a key's holders are dealt, and the part of a row's player."""
    tiles = F.ceil(F.col(players) / F.lit(hot)).cast("int")
    return tiles, F.pmod(F.xxhash64("player_key"), tiles.cast("long")).cast("int")


def edges(shared: DataFrame, hot: int = TILE_HOLDERS, only: DataFrame | None = None, also: tuple[str, ...] = ()) -> DataFrame:
    """(player_key, other, key_type, shared_key, records of both): one hop, both directions; never closed transitively. only: of these players, to all others. also: columns of both sides, the other's as other_<name>.

    A key with more than `hot` holders is dealt into tiles of about hot x hot pairs: its rows go to one part by their player
    and are repeated for each part of the other side, so no task sees a whole key. The pairs themselves are the result; who
    needs only counts takes linked_counts.
    """
    tiles, mine = _tile(hot=hot)
    every = F.explode(F.sequence(F.lit(0), tiles - 1))
    asked = shared
    if only is not None:
        asked = shared.join(only.select("player_key"), "player_key", "left_semi")
        shared = shared.join(asked.select("key_type", "shared_key").distinct(), ["key_type", "shared_key"], "left_semi")
    a = asked.withColumn("_i", mine).withColumn("_j", every).alias("a")
    b = shared.withColumn("_j", mine).withColumn("_i", every).alias("b")
    same = (F.col("a.player_key") != F.col("b.player_key")) & F.lit(True)
    for c in ("key_type", "shared_key", "_i", "_j"):
        same = same & (F.col(f"a.{c}") == F.col(f"b.{c}"))
    return a.join(b, same).select(F.col("a.player_key").alias("player_key"), F.col("b.player_key").alias("other"), F.col("a.key_type").alias("key_type"), F.col("a.shared_key").alias("shared_key"), F.col("a.record_ids").alias("own_records"), F.col("b.record_ids").alias("other_records"), *(F.col(f"a.{c}").alias(c) for c in also), *(F.col(f"b.{c}").alias(f"other_{c}") for c in also))


def linked_counts(shared: DataFrame, hot: int = HOT_HOLDERS) -> DataFrame:
    """(player_key, key_type, linked): distinct others that share a key of the kind, from the groups of holders, without pairs.

    A player with one shared key has as many others as the key has other holders. With several keys the union of their
    holders is counted in two parts. Hot keys (more than `hot` holders): players are classed by the set of hot keys that they
    hold, and the union is the sum of the classes that meet the player's own. Other keys: their holders, `hot` at most a key,
    are listed and made distinct, without those that the first part has counted.
    """
    is_hot = F.col("players") > hot
    signature = F.array_sort(F.collect_set(F.when(is_hot, F.col("shared_key")))).alias("sig")
    mine = shared.groupBy("player_key", "key_type").agg(signature, F.count(F.lit(1)).alias("n_keys"), F.max("players").alias("size"))
    one = mine.where("n_keys = 1").select("player_key", "key_type", (F.col("size") - 1).alias("linked"))
    many = mine.where("n_keys > 1").select("player_key", "key_type", "sig")

    classes = mine.where(F.size("sig") > 0).groupBy("key_type", "sig").agg(F.count(F.lit(1)).alias("n"))
    by_key = classes.withColumn("shared_key", F.explode("sig"))
    asked = many.where(F.size("sig") > 0).select("key_type", "sig").distinct().withColumn("shared_key", F.explode("sig"))
    met = asked.join(by_key.withColumnRenamed("sig", "_sig"), ["key_type", "shared_key"]).groupBy("key_type", "sig", "_sig").agg(F.max("n").alias("n"))
    hot_union = met.groupBy("key_type", "sig").agg((F.sum("n") - 1).alias("_hot"))  # the player is in it

    cold = shared.where(~is_hot).select("key_type", "shared_key", "player_key")
    own = cold.join(many, ["player_key", "key_type"])
    holding = cold.join(mine.select("player_key", "key_type", "sig"), ["player_key", "key_type"])
    theirs = holding.select("key_type", "shared_key", F.col("player_key").alias("other"), F.col("sig").alias("_sig"))
    listed = own.join(theirs, ["key_type", "shared_key"]).where((F.col("other") != F.col("player_key")) & ~F.arrays_overlap("sig", "_sig"))
    cold_union = listed.select("player_key", "key_type", "other").distinct().groupBy("player_key", "key_type").agg(F.count(F.lit(1)).alias("_cold"))
    several = many.join(hot_union, ["key_type", "sig"], "left").join(cold_union, ["player_key", "key_type"], "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    return one.unionByName(several.select("player_key", "key_type", (zero("_hot") + zero("_cold")).alias("linked")))


def close_pairs(shared: DataFrame, people: DataFrame, minutes: float) -> DataFrame:
    """(player_key, other, key_type, shared_key): corroborating keys in common with others whose account was created within `minutes`.

    Times are cut into slots of that length, so only holders of the same key in neighbouring slots meet.
    """
    micros = max(int(minutes * 60_000_000), 1)
    born = people.where("created_at is not null").select("player_key", F.unix_micros(F.col("created_at").cast("timestamp")).alias("_t"))
    rows = shared.where(F.col("key_type").isin(*CORROBORATING)).select("key_type", "shared_key", "player_key").join(born, "player_key").withColumn("_slot", F.floor(F.col("_t") / micros))
    near = rows.select("key_type", "shared_key", F.explode(F.array(*(F.col("_slot") + k for k in (-1, 0, 1)))).alias("_slot"), F.col("player_key").alias("other"), F.col("_t").alias("_u"))
    close = rows.join(near, ["key_type", "shared_key", "_slot"]).where((F.col("other") != F.col("player_key")) & (F.abs(F.col("_t") - F.col("_u")) <= F.lit(int(minutes * 60_000_000))))
    return close.select("player_key", "other", "key_type", "shared_key")


def created_close(shared: DataFrame, people: DataFrame, minutes: float) -> DataFrame:
    """(player_key, near): how many others close_pairs finds."""
    return close_pairs(shared, people, minutes).select("player_key", "other").distinct().groupBy("player_key").agg(F.count(F.lit(1)).alias("near"))


def keys_with_referrer(shared: DataFrame, people: DataFrame) -> DataFrame:
    """(player_key, key_type, shared_key): corroborating keys that a player shares with the one it names as referrer; each player meets its referrer only."""
    rows = shared.where(F.col("key_type").isin(*CORROBORATING)).select("key_type", "shared_key", "player_key")
    named = people.where("referred_by_key <> player_key").select("player_key", "referred_by_key")
    theirs = rows.withColumnRenamed("player_key", "referred_by_key")
    return rows.join(named, "player_key").join(theirs, ["referred_by_key", "key_type", "shared_key"], "left_semi").select("player_key", "key_type", "shared_key")


def shared_groups(links: DataFrame) -> DataFrame:
    """Evidence of each player by kind of key: one item for each shared key, sorted by it."""
    item = links.groupBy("player_key", "key_type", "shared_key").agg(F.array_sort(F.collect_set("other")).alias("other_player_keys"), F.first("own_records").alias("source_record_ids"), F.array_sort(F.collect_list(F.struct("other", "other_records"))).alias("_others"))
    linked = F.map_from_entries("_others").alias("linked_source_record_ids")
    packed = F.struct("shared_key", F.col("key_type").alias("shared_key_type"), "other_player_keys", "source_record_ids", linked)
    return item.select("player_key", "key_type", packed.alias("item")).groupBy("player_key", "key_type").agg(F.sort_array(F.collect_list(F.struct(F.col("item.shared_key").alias("k"), F.to_json("item", {"ignoreNullFields": "false"}).alias("j"))))
        .alias("_items")).select("player_key", "key_type", F.concat(F.lit("["), F.array_join(F.transform("_items", lambda x: x["j"]), ","), F.lit("]")).alias("evidence"))


def listed_holders(shared: DataFrame, hot: int = HOT_HOLDERS) -> DataFrame:
    """(player_key, key_type, shared_key, record_ids, others, other_records): all other holders of the key, sorted, as text `a,b` and `a=r1,r2;b=r3`.

    The texts of a key are written once, and each holder cuts its own piece out by its place. They are as long as the key is
    held, so what is read off the rows stays quadratic; but neither pairs nor rows with lists are exchanged, only each key's
    texts for every `hot` of its holders. Texts are cut by bytes: characters would have to be counted from the start each time.
    """
    key = ("key_type", "shared_key")
    tiles, mine = _tile(hot=hot)
    before = Window.partitionBy(*key).orderBy("player_key").rowsBetween(Window.unboundedPreceding, -1)
    rows = shared.withColumn("_piece", F.concat("player_key", F.lit("="), F.array_join("record_ids", ",")))
    texts = rows.groupBy(*key, "players").agg(F.array_sort(F.collect_list(F.struct("player_key", "_piece"))).alias("_all"))
    texts = texts.select(*key, F.array_join("_all.player_key", ",").cast("binary").alias("_names"), F.array_join("_all._piece", ";").cast("binary").alias("_records"), F.explode(F.sequence(F.lit(0), tiles - 1)).alias("_i"))
    at = lambda c: F.coalesce(F.sum(F.octet_length(c) + 1).over(before), F.lit(0)).cast("int")
    rows = rows.withColumns({"_i": mine, "_at": at("player_key"), "_from": at("_piece")}).join(texts, [*key, "_i"])

    return rows.select("player_key", *key, "record_ids", _without("_names", "_at", "player_key").alias("others"), _without("_records", "_from", "_piece").alias("other_records"))


def _without(text: str, at: str, piece: str, between: int = 1) -> Column:
    """A list's text (binary) without the piece that begins after `at` bytes; between: bytes that part two pieces."""
    text, at, size = F.col(text), F.col(at), F.octet_length(piece)
    rest = lambda start: F.substring(text, start, F.octet_length(text))
    return F.when(at == 0, rest(size + between + 1)).otherwise(F.concat(F.substring(text, F.lit(1), at - between), rest(at + size + 1))).cast("string")


def with_others(asked: DataFrame, shared: DataFrame, hot: int = HOT_HOLDERS) -> DataFrame:
    """The rows asked for (player_key, key_type and more) with `others`: all distinct others that hold a key of the kind in common with the player, as text `[a, b]`.

    A player's list is cut out of the text of its most held key, which is written once for every `hot` holders; only others that
    it meets by its further keys alone are gathered, and sorted in. Neither pairs of that key nor rows with lists are exchanged.
    """
    key, whose = ("key_type", "shared_key"), ("player_key", "key_type")
    tiles, mine = _tile(hot=hot)
    before = Window.partitionBy(*key).orderBy("player_key").rowsBetween(Window.unboundedPreceding, -1)
    placed = shared.select(*whose, "shared_key", "players", F.coalesce(F.sum(F.octet_length("player_key") + 2).over(before), F.lit(0)).cast("int").alias("_at"), mine.alias("_i"))
    main = shared.groupBy(*whose).agg(F.max(F.struct("players", "shared_key")).alias("_most"), F.count(F.lit(1)).alias("_n"))
    main = main.select(*whose, F.col("_most.shared_key").alias("_main"), "_n")
    further = shared.join(main.where("_n > 1"), [*whose]).where("shared_key <> _main")
    a = further.select(*whose, "shared_key", "_main", F.explode(F.sequence(F.lit(0), tiles - 1)).alias("_j"))
    met = a.join(shared.select(*key, F.col("player_key").alias("other"), mine.alias("_j")), [*key, "_j"]).where("other <> player_key").select(*whose, "_main", "other").distinct()
    more = met.join(shared.select("key_type", F.col("shared_key").alias("_main"), F.col("player_key").alias("other")), ["key_type", "_main", "other"], "left_anti")
    more = more.groupBy(*whose).agg(F.collect_list("other").alias("_more"))
    texts = shared.groupBy(*key, "players").agg(F.array_sort(F.collect_list("player_key")).alias("_names"))
    texts = texts.select(*key, "_names", F.array_join("_names", ", ").cast("binary").alias("_text"), F.explode(F.sequence(F.lit(0), tiles - 1)).alias("_i"))
    rows = asked.join(main.drop("_n").withColumnRenamed("_main", "shared_key"), [*whose]).join(placed, [*whose, "shared_key"]).join(more, [*whose], "left").join(texts, [*key, "_i"])
    merged = F.array_join(F.sort_array(F.array_union(F.array_remove("_names", F.col("player_key")), "_more")), ", ")
    others = F.concat(F.lit("["), F.when(F.col("_more").isNull(), _without("_text", "_at", "player_key", 2)).otherwise(merged), F.lit("]"))
    return rows.select(*(F.col(c) for c in asked.columns), others.alias("others"))


def shared_keys(shared: DataFrame) -> DataFrame:
    """Short evidence of each player by kind of key: its shared keys, sorted, and how many others hold each; no other player is listed."""
    one = F.struct("shared_key", F.col("key_type").alias("shared_key_type"), (F.col("players") - 1).alias("other_players"), F.col("record_ids").alias("source_record_ids"))
    return shared.groupBy("player_key", "key_type").agg(S.json_text(F.array_sort(F.collect_list(one))).alias("evidence"))


def pairs_between(shared: DataFrame, hot: int = TILE_HOLDERS, listed: int = LISTED_KEYS) -> DataFrame:
    """What keys_between says of all pairs, without an exchange of pairs.

    Both sides of a pair carry their own corroborating keys, so it is told once, at the first key that both have, with all
    keys that both have. Players with more than `listed` keys would carry long lists; their pairs are grouped.
    """
    one = F.struct(_rank().alias("r"), F.col("shared_key").alias("shared_key"), F.col("key_type").alias("shared_key_type"))
    shared = shared.where(F.col("key_type").isin(*CORROBORATING))
    own = shared.groupBy("player_key").agg(F.array_sort(F.collect_list(one)).alias("keys"))
    rows = shared.join(own.where(F.size("keys") <= listed), "player_key")
    met = edges(rows, hot, also=("keys",))
    alone = (F.size("keys") == 1) | (F.size("other_keys") == 1)  # then this key is the one that both have, as for most pairs
    pair, shown = ("player_key", "other"), lambda t, k: F.struct(t.alias("shared_key_type"), k.alias("shared_key"))
    both = F.when(alone, F.array(shown(F.col("key_type"), F.col("shared_key")))).otherwise(F.transform(F.array_intersect("keys", "other_keys"), lambda x: shown(x["shared_key_type"], x["shared_key"])))
    few = met.select(*pair, "key_type", "shared_key", both.alias("shared_linkages"))
    first = F.get("shared_linkages", F.lit(0))
    few = few.where((first["shared_key"] == F.col("shared_key")) & (first["shared_key_type"] == F.col("key_type"))).select(*pair, "shared_linkages")
    long = own.where(F.size("keys") > listed).select("player_key")
    theirs = edges(shared, hot, only=long).select("player_key", "other", "key_type", "shared_key")
    back = theirs.join(long.withColumnRenamed("player_key", "other"), "other", "left_anti").select(F.col("other").alias("player_key"), F.col("player_key").alias("other"), "key_type", "shared_key")
    return few.unionByName(keys_between(theirs.unionByName(back)))


def _rank() -> Column:
    """The place of a kind of key in the order of corroboration."""
    return F.coalesce(*(F.when(F.col("key_type") == k, F.lit(i)) for i, k in enumerate(CORROBORATING)))


def keys_between(links: DataFrame) -> DataFrame:
    """Keys that two players share, sorted by kind (in the order of corroboration) and key."""
    corroborating = links.where(F.col("key_type").isin(*CORROBORATING))
    items = F.array_sort(F.collect_set(F.struct(_rank().alias("r"), F.col("shared_key").alias("shared_key"), F.col("key_type").alias("shared_key_type"))))
    return corroborating.groupBy("player_key", "other").agg(F.transform(items, lambda x: F.struct(x["shared_key_type"].alias("shared_key_type"), x["shared_key"].alias("shared_key"))).alias("shared_linkages"))
