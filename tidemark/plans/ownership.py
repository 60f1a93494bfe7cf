"""Ownership reports: transactions and holdings, one row for each reporting owner."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame

from .batches import Row, number, parse_each, text_at, xml_root

TRUE = ("1", "true", "True", "yes")
OWNER = "reporting_owner_cik string, reporting_owner_name string, is_director boolean, is_officer boolean, officer_title string, is_ten_pct_owner boolean"
ISSUER = "issuer_cik string, issuer_name string, issuer_ticker string"
SCHEMA = (
    f"kind string, position int, {ISSUER}, {OWNER}, security_title string, transaction_date string, transaction_code string, shares double, price_per_share double, "
    "acquired_disposed string, shares_owned_after double, direct_indirect string, nature_of_ownership string, is_derivative boolean"
)
#: Column: path below a transaction or holding.
VALUES = {
    "transaction_date": ".//transactionDate/value",
    "transaction_code": ".//transactionCoding/transactionCode",
    "acquired_disposed": ".//transactionAmounts//transactionAcquiredDisposedCode/value",
    "direct_indirect": ".//ownershipNature//directOrIndirectOwnership/value",
    "nature_of_ownership": ".//ownershipNature//natureOfOwnership/value",
}
NUMBERS = {
    "shares": ".//transactionAmounts//transactionShares/value",
    "price_per_share": ".//transactionAmounts//transactionPricePerShare/value",
    "shares_owned_after": ".//postTransactionAmounts//sharesOwnedFollowingTransaction/value",
}


def parse(content: bytes | str) -> Iterator[Row]:
    root = xml_root(content)
    if root is None:
        return
    issuer = root.find(".//issuer")
    about = {"issuer_cik": text_at(issuer, "issuerCik"), "issuer_name": text_at(issuer, "issuerName"), "issuer_ticker": text_at(issuer, "issuerTradingSymbol")}
    owners = []
    for node in root.iter("reportingOwner"):
        who, what = node.find("reportingOwnerId"), node.find("reportingOwnerRelationship")
        owners.append(
            {
                "reporting_owner_cik": text_at(who, "rptOwnerCik"),
                "reporting_owner_name": text_at(who, "rptOwnerName"),
                "is_director": text_at(what, "isDirector") in TRUE,
                "is_officer": text_at(what, "isOfficer") in TRUE,
                "officer_title": text_at(what, "officerTitle"),
                "is_ten_pct_owner": text_at(what, "isTenPercentOwner") in TRUE,
            }
        )
    owners = owners or [{"is_director": False, "is_officer": False, "is_ten_pct_owner": False}]
    position = 0
    for prefix, derivative in (("nonDerivative", False), ("derivative", True)):
        table = root.find(f".//{prefix}Table")
        for kind in ("Transaction", "Holding"):
            for node in table.findall(prefix + kind) if table is not None else ():
                row = {"kind": kind.lower(), "position": position, "is_derivative": derivative, **about}
                row["security_title"] = text_at(node, ".//securityTitle/value", "securityTitle")
                row |= {c: text_at(node, path) for c, path in VALUES.items()}
                row["transaction_date"] = row["transaction_date"] or text_at(node, "transactionDate")
                row |= {c: number(text_at(node, path), "") for c, path in NUMBERS.items()}
                for owner in owners:
                    yield row | owner
                position += 1


def footnotes(content: bytes | str) -> Iterator[Row]:
    root = xml_root(content)
    for node in root.iter("footnote") if root is not None else ():
        if node.get("id"):
            yield {"id": node.get("id"), "text": (node.text or "").strip()}


def ownership_rows(docs: DataFrame) -> DataFrame:
    """docs: accession, content."""
    return parse_each(docs, parse, SCHEMA)


def footnote_rows(docs: DataFrame) -> DataFrame:
    return parse_each(docs, footnotes, "id string, text string")
