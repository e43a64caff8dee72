"""Run parameters and size limits, handed to operators instead of module globals."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from types import MappingProxyType

# Session codes, long session names, session weights, tyre compounds.
SESSION_TYPES = ("FP1", "FP2", "FP3", "Q", "SQ", "S", "R")
SESSION_NAMES = MappingProxyType(
    {
        "Practice 1": "FP1",
        "Practice 2": "FP2",
        "Practice 3": "FP3",
        "Qualifying": "Q",
        "Sprint Qualifying": "SQ",
        "Sprint": "S",
        "Race": "R",
    }
)
SESSION_WEIGHTS = MappingProxyType(
    {"FP1": 0.15, "FP2": 0.25, "FP3": 0.35, "Q": 0.7, "SQ": 0.6, "S": 0.5, "R": 1.0}
)
COMPOUNDS = ("SOFT", "MEDIUM", "HARD", "INTER", "WET")
UNKNOWN_COMPOUND = "UNKNOWN"


@dataclass(frozen=True)
class Params:
    """What one pipeline run is about. Defaults match the documented model."""

    season: int
    event: str
    round_number: int
    recency_lambda: float = 0.15
    session_weights: Mapping[str, float] = field(default_factory=lambda: SESSION_WEIGHTS)
    session_types: tuple[str, ...] = SESSION_TYPES
    compounds: tuple[str, ...] = COMPOUNDS
    # e.g. {"INTERMEDIATE": "INTER"}; empty keeps such spellings as UNKNOWN.
    compound_aliases: Mapping[str, str] = field(default_factory=dict)
    # Training rows of a session without a weight: "fail", or "drop" to leave them out.
    unknown_session: str = "fail"
    outlier_threshold: float = 1.07
    recent_rounds: int = 2
    baseline_rounds: int = 4
    replicates: int = 20
    resample_fraction: float = 0.8
    trees: int = 100
    depth: int = 4
    seed: int = 42

    @property
    def scored_sessions(self) -> tuple[str, ...]:
        """Sessions shown next to a prediction: all but the race itself."""
        return tuple(s for s in self.session_types if s != "R")


@dataclass(frozen=True)
class Limits:
    """When an operator leaves its small-side plan for its large-side plan.

    ``broadcast_bytes``: measured size up to which a join side is broadcast.
    ``task_rows``: measured rows up to which an ordered window may use one task.
    ``hot_rows``: rows per key from which a shuffled join spreads that key.
    ``salts``: over how many tasks a hot key is spread at least; a key with more than ``salts``
    times ``hot_rows`` rows is spread over one task per ``hot_rows``.
    ``fit_rows``: training rows a task of a fit gets at most on average. A forest keeps each row
    with a count per tree, some 530 bytes for a hundred trees, and reads them once a level.
    """

    broadcast_bytes: int = 64 << 20
    task_rows: int = 1_000_000
    hot_rows: int = 5_000_000
    salts: int = 64
    fit_rows: int = 250_000


LIMITS = Limits()
