"""Thresholds of the detectors and of brand discovery."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date


@dataclass(frozen=True)
class SpikeParams:
    """All comparisons with these are strict, except counts of days or values, the tolerance and the least GMV."""

    period_from: date = date(2026, 4, 1)
    period_to: date = date(2026, 4, 30)
    radius: int = 120
    min_daily_count: float = 10
    min_baseline_days: int = 2
    jump_mult: float = 3
    cumulative_ratio: float = 0.7
    frozen_max_unique: int = 2
    frozen_min_days: int = 2
    iqr_mult: float = 3.0
    ghost_min_gap_days: int = 30
    ghost_delta_tolerance: float = 2
    ghost_new_min_count: float = 5
    include_stale: bool = False
    enable_ghost: bool = True
    min_gmv: float = 0.5


@dataclass(frozen=True)
class RangeParams:
    """The variant for one target range within a fixed detection window."""

    detection_from: date
    detection_to: date
    target_from: date
    target_to: date
    channel: str
    l3title: str = ""
    shops: tuple[str, ...] = ()
    min_days: int = 2
    min_count: float = 10
    jump_mult: float = 5
    cumulative_ratio: float = 0.7


@dataclass(frozen=True)
class BrandParams:
    min_df: int = 2
    max_df: float = 0.005
    leading_words: int = 4
    min_occurrences: int = 2
    min_skeleton: int = 5
    min_phonetic: int = 4
    min_length_ratio: float = 0.60
    max_length_ratio: float = 1.67
    min_fuzz: float = 95.0
    accept_delta: float = 0.10
    reject_delta: float = -0.08
    min_confidence: float = 0.60
    rules_per_batch: int = 100
    ids_per_chunk: int = 500
