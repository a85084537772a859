"""Everything the operators would otherwise hard-code."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# Product codes, their catalog entries and labels.
CATALOG = [
    # product, category, fee_bps
    ("equities", "core", 0),
    ("etf", "core", 0),
    ("mutual_funds", "core", 25),
    ("crypto", "new_launch", 40),
    ("options", "new_launch", 30),
    ("agentic", "new_launch", 50),
]
CATALOG_SCHEMA = "product STRING, category STRING, fee_bps INT"
PRODUCT_LABELS = {
    "crypto": "crypto trading",
    "options": "options trading",
    "agentic": "the AI agentic trading assistant",
}


@dataclass(frozen=True)
class Settings:
    """Parameters of one experiment wave.

    launch: ISO date; an event at midnight of that day already counts as after launch.
    post_window_days: upper bound of the adoption window, None for an open one.
    labels_require_pre_activity: True drops the adoption label of users without any
        event before launch (the behaviour of a join that starts from pre-launch users).
    """

    launch: str
    products: tuple[str, ...] = ("crypto", "options", "agentic")
    experiment_id: str = "{product}_launch"
    post_window_days: int | None = None
    notional_usd: float = 25000.0
    labels_require_pre_activity: bool = False

    def __post_init__(self) -> None:
        dt.date.fromisoformat(self.launch)
        if not self.products or len(set(self.products)) != len(self.products):
            raise ValueError("products must be a non-empty list of distinct codes")
        if not all(p.isidentifier() for p in self.products):
            raise ValueError("product codes name columns, so they must be identifiers")
