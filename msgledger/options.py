"""Settings a run can change, with the default values that decide results."""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

# Canonical field -> other names it goes by.
SYNONYMS: dict[str, tuple[str, ...]] = {
    "date": ("trans_date", "date_of_transaction", "txn_date"),
    "account_name": ("acct_name", "account", "account_title"),
    "account_number": ("acct_number", "account_no", "acc_num"),
    "internal_entity": (
        "Payment made by", "Payment made from", "Paid from", "“Payment originated from”",
    ),
    "institution": ("bank", "bank_name"),
    "external_entity": (
        "payee", "recipient", "merchant", "vendor", "Payment made to", "Paid to",
        "“Beneficiary”", "“Payment received by”",
    ),
    "description": ("narrative", "desc", "details"),
    "amount": ("amt", "value", "transaction_amount", "for the amount of"),
    "currency": ("curr", "currency_code"),
    "available_balance": ("balance", "avail_balance", "available"),
}

# Names the text patterns use -> record fields.
FIELD_RENAMES: dict[str, str] = {
    "account_name": "internal_entity",
    "account_number": "internal_account_number",
}


@dataclass(frozen=True)
class MaskOptions:
    """How account numbers are masked in text, and how many digits stay visible."""

    pattern: str = r"\*+(\d{4})"
    suffix_length: int = 4


@dataclass(frozen=True)
class Thresholds:
    """Pass limits for replicate runs."""

    struct: float = 1.0
    identity: float = 0.99
    alpha: float = 0.05
    latency_cv: float = 0.05


@dataclass(frozen=True)
class Limits:
    """Sizes that choose a plan; they never change a result.

    broadcast_rows, broadcast_bytes: a join side is broadcast only when counted at or below both.
    hot_key_rows: a key with more rows than this is split over many tasks.
    chunk_rows: rows per contiguous piece when a hot key is split in order.
    exploded_rows: accounts that one task at most makes endings of.
    pushed_ids: ids looked up in the ledger by name, so that row groups without them are skipped.
    """

    broadcast_rows: int = 200_000
    broadcast_bytes: int = 64 * 1024 * 1024
    hot_key_rows: int = 5_000_000
    chunk_rows: int = 2_000_000
    exploded_rows: int = 100_000
    pushed_ids: int = 200


LIMITS = Limits()


@dataclass(frozen=True)
class Options:
    mask: MaskOptions = field(default_factory=MaskOptions)
    thresholds: Thresholds = field(default_factory=Thresholds)
    limits: Limits = field(default_factory=Limits)
    synonyms: Mapping[str, Sequence[str]] = field(default_factory=lambda: dict(SYNONYMS))
    overlap_hours: int = 1


def normalise_synonyms(table: Mapping[str, object] | None) -> dict[str, tuple[str, ...]]:
    """Accept a single alias, a list or nothing per field."""
    out: dict[str, tuple[str, ...]] = {}
    for name, aliases in (table or {}).items():
        if aliases is None:
            out[name] = ()
        elif isinstance(aliases, (list, tuple)):
            out[name] = tuple(str(a) for a in aliases)
        else:
            out[name] = (str(aliases),)
    return out
