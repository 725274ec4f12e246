"""Raw documents to the six tables on storage, with checks and reports."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CURRENCY, STATUS_RANK
from ..operators import flatten
from ..operators.guards import ContractError, require_unique
from ..operators.identity import identity_map, phone_collisions
from ..sources.tables import load_table, write_tables, write_text
from . import audit

ORDER = {"players": ["player_key"], "bets": ["created_at", "ticket_id"], "money": ["requested_at", "txn_type", "transaction_id"], "bonus": ["created_at", "ref_trans_id", "txn_type"], "activity": ["created_at", "action", "page"], "logins": ["created_at", "user_type", "player_key"]}
SAMPLE_ID = {"bets": "ticket_id", "money": "transaction_id", "bonus": "source_id", "activity": "source_id", "logins": "source_id"}


@dataclass
class Rebuilt:
    """The written tables, and the reports as Markdown."""

    tables: dict[str, DataFrame]
    counts: dict[str, int]
    reports: dict[str, str] = field(default_factory=dict)


def markdown_table(header: list[str], rows: list[tuple]) -> str:
    line = lambda cells: "| " + " | ".join("" if c is None else str(c) for c in cells) + " |"
    return "\n".join([line(header), line(["---"] * len(header)), *map(line, rows)])


def flat_tables(docs: dict[str, DataFrame], salt: str) -> dict[str, DataFrame]:
    """The six tables as plans; docs: players, otps, bets, deposits, withdrawals, bonus, activity, logins."""
    ids = identity_map(docs["players"], docs.get("otps"))
    return {
        "players": flatten.players(docs["players"], ids, salt), "bets": flatten.bets(docs["bets"], ids), "money": flatten.money(docs["deposits"], docs["withdrawals"], ids),
        "bonus": flatten.bonus(docs["bonus"], ids, docs["deposits"], docs["bets"]), "activity": flatten.activity(docs["activity"], ids), "logins": flatten.logins(docs["logins"], ids),
    }


def invariant_report(accounts: DataFrame, anomalies: DataFrame) -> str:
    """Whether each rule of the account graph holds; rows that break one are listed, streamed to the driver in order."""
    blocks = []
    for r in flatten.account_invariants(accounts).orderBy(F.desc("name")).collect():
        if r["verified"]:
            blocks.append(f"VERIFIED invariant `{r['name']}`; allowed statuses: {r['allowed']}.")
        else:
            rows = anomalies.where(F.col("invariant") == r["name"]).drop("invariant").orderBy("source_id")
            blocks.append(f"ANOMALY invariant `{r['name']}` violated; allowed statuses: {r['allowed']}.\n\n" + markdown_table(rows.columns, [tuple(x) for x in rows.toLocalIterator()]))
    return "\n\n".join(blocks)


def unjoined_report(tables: dict[str, DataFrame], samples: int) -> str:
    """Rows without a player by table and class, with the first ids of each class."""
    lines = ["# Rows without a player", ""]
    for name, id_col in SAMPLE_ID.items():
        rows = audit.first_samples(tables[name].where("player_key is null"), "unjoined_class", id_col, samples).orderBy("unjoined_class").collect()
        lines += [f"## {name}", "", markdown_table(["class", "rows", "samples"], [(r["unjoined_class"], r["n"], ", ".join(r["samples"])) for r in rows]), ""]
    return "\n".join(lines)


def reconciliation(docs: dict[str, DataFrame], tables: dict[str, DataFrame]) -> dict[str, int]:
    """Counts in and out; the ledger must have one row per deposit and per collapsed withdrawal."""
    counts = {f"raw_{k}": v.count() for k, v in docs.items()} | {k: v.count() for k, v in tables.items()}
    groups = flatten.collapse_withdrawals(docs["withdrawals"]).count()
    counts["withdrawal_groups"] = groups
    if counts["money"] != counts["raw_deposits"] + groups:
        raise ContractError(f"ledger has {counts['money']} rows, expected {counts['raw_deposits']} deposits and {groups} withdrawals")
    for name in ("players", "bets", "bonus", "activity", "logins"):
        if counts[name] != counts[f"raw_{name}"]:
            raise ContractError(f"{name}: {counts[f'raw_{name}']} documents became {counts[name]} rows")
    return counts


def reconciliation_report(counts: dict[str, int]) -> str:
    """Documents and rows of each source, and what explains the difference."""
    why = {"players": "one row per player", "bets": "one row per ticket; rows without a player stay", "bonus": f"one row per movement; the currency is taken to be {CURRENCY}", "activity": "one row per event; rows without a player stay", "logins": "one row per login; staff without a player stay"}
    rows = [(n, counts[f"raw_{n}"], counts[n], text) for n, text in why.items()]
    rows += [("deposits", counts["raw_deposits"], "in money", "no deposit is dropped; flags tell money in"), ("withdrawals", counts["raw_withdrawals"], f"{counts['withdrawal_groups']} groups", "life cycles collapsed by transaction: " + " > ".join(sorted(STATUS_RANK, key=STATUS_RANK.get, reverse=True)))]
    rows.append(("money", f"{counts['raw_deposits']} + {counts['withdrawal_groups']}", counts["money"], "checked: deposits plus collapsed withdrawals"))
    return "# Reconciliation\n\n" + markdown_table(["source", "documents", "rows", "difference"], rows)


def rebuild(docs: dict[str, DataFrame], folder: str, salt: str, accounts: tuple[DataFrame, DataFrame] | None = None, samples: int = 10) -> Rebuilt:
    """Checks keys, writes all tables in a stable order, reads them back, checks counts, and reports.

    Phone collisions and rows that break a rule of the account graph are written too (phone_collisions, account_anomalies),
    and the reports list every one of them. Reports are written as Markdown below reports/.
    """
    require_unique(docs["bets"], "ticketId", what="bets")
    require_unique(docs["deposits"], "transactionId", what="deposits")
    spark = docs["players"].sparkSession
    write_tables({n: flatten.ordered(df, *ORDER[n]) for n, df in flat_tables(docs, salt).items()}, folder)
    tables = {n: load_table(spark, folder, n) for n in ORDER}
    counts = reconciliation(docs, tables)
    reports = {"unjoined": unjoined_report(tables, samples), "reconciliation": reconciliation_report(counts)}
    write_tables({"phone_collisions": phone_collisions(docs["players"]).orderBy("phone")}, folder)
    collisions = spark.read.parquet(f"{folder}/phone_collisions")
    status = audit.distribution(tables["money"].where("txn_type = 'DEPOSIT'"), "final_status")
    reports["identity"] = markdown_table(["phone", "owner", "others"], [(r["phone"], r["winning_key"], ", ".join(r["losing_keys"])) for r in collisions.orderBy("phone").toLocalIterator()])
    reports["deposit_status"] = markdown_table(["status", "rows"], [tuple(r) for r in status.orderBy(F.col("final_status").asc_nulls_last()).collect()])
    if accounts is not None:
        found = flatten.withdrawal_accounts(docs["withdrawals"], *accounts)
        crosstabs = {"accounts_from": flatten.account_crosstab(found, "from"), "accounts_to": flatten.account_crosstab(found, "to"), "accounts_missing_from": flatten.missing_from_crosstab(found)}
        for name, table in crosstabs.items():
            reports[name] = markdown_table(table.columns, [tuple(r) for r in table.orderBy("status").collect()])
        write_tables({"account_anomalies": flatten.account_anomalies(found).orderBy("invariant", "source_id")}, folder)
        reports["accounts_anomalies"] = invariant_report(found, spark.read.parquet(f"{folder}/account_anomalies"))
    for name, text in reports.items():
        write_text(spark, text, f"{folder}/reports/{name}.md")
    return Rebuilt(tables, counts, reports)
