"""Parameters of one run, checked and normalised."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

# The allowed choices, and what is said of missing ones.
NO_RUN, NO_DATES = "Run Id was not provided.", "Date input was not provided in the event."
FULL_LOAD, INCREMENTAL_LOAD = "full_load", "incremental_load"
LOAD_TYPES = (FULL_LOAD, INCREMENTAL_LOAD)
BACKFILL_CHOICES = ("0", "1")


def _iso(text: str) -> str:
    return datetime.strptime(text, "%Y-%m-%d").strftime("%Y-%m-%d")


@dataclass(frozen=True)
class RunParameters:
    """``start_date`` only counts with ``backfill`` set to ``"1"``."""

    run_id: int
    input_date: str
    start_date: str
    load_type: str = INCREMENTAL_LOAD
    backfill: str = "0"

    def __post_init__(self):
        if not self.run_id:
            raise ValueError(NO_RUN)
        if not (self.input_date and self.start_date and self.backfill):
            raise ValueError(NO_DATES)
        if int(self.run_id) < 1:
            raise ValueError("The run id starts at 1.")
        if self.load_type not in LOAD_TYPES:
            raise ValueError(f"load_type is one of {LOAD_TYPES}")
        if self.backfill not in BACKFILL_CHOICES:
            raise ValueError(f"backfill is one of {BACKFILL_CHOICES}")
        object.__setattr__(self, "run_id", int(self.run_id))
        object.__setattr__(self, "input_date", _iso(self.input_date))
        object.__setattr__(self, "start_date", _iso(self.start_date))

    @property
    def window(self) -> tuple[str, str]:
        """First and last day of facts to take in."""
        first = self.input_date if self.backfill == "0" else self.start_date
        return first, self.input_date
