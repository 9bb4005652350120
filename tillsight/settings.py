"""Thresholds, run options and the injected clock."""

from __future__ import annotations

from dataclasses import dataclass

PATTERNS = ("upgrade", "child", "gender_skew")
# Fixed value: rows per chunk.
CHUNK_ROWS = 10_000


@dataclass(frozen=True)
class Thresholds:
    """Cut-offs of the three rules."""

    # Fixed values.
    min_merchant_txns: int = 50_000  # UPGRADE: merchant has at least this many rows
    top_share: float = 0.1  # UPGRADE: rank by row count, rounded to 4 places
    bottom_share: float = 0.1  # UPGRADE: rank by average weight, not rounded
    max_avg_amount: float = 23  # CHILD: average strictly below
    min_pair_txns: int = 80  # CHILD: at least this many rows
    min_female: int = 100  # DEI-NEEDED: strictly more women than this


@dataclass(frozen=True)
class Clock:
    """The two India-time strings stamped on every detection of one evaluation."""

    start: str
    detected: str


@dataclass(frozen=True)
class Options:
    """How a run treats ids and amounts, and where it changes physical strategy.

    id_style      "reference" keeps the quotes of ids in UPGRADE and CHILD rows and drops the
                  first and last character in DEI-NEEDED rows; "clean" removes surrounding
                  quotes on input, everywhere.
    amount_scale  decimal places of the amounts, which are then summed exactly; None sums
                  doubles.
    broadcast_rows  a counted lookup table of at most this many rows is broadcast; a larger
                  one is joined on salted keys.
    window_rows   a ranking window may hold at most this many rows of one merchant in one
                  task; larger merchants are ranked in range slices.
    salts         number of ways a hot key is spread in a salted join.
    """

    id_style: str = "reference"
    amount_scale: int | None = None
    broadcast_rows: int = 200_000
    window_rows: int = 1_000_000
    salts: int = 32

    def __post_init__(self):
        if self.id_style not in ("reference", "clean"):
            raise ValueError(f"id_style must be 'reference' or 'clean', not {self.id_style!r}")
