"""Settings shared by the jobs. The defaults are fixed values that decide results."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class ReviewConfig:
    cleaning_version: str = "2.1"

    # Review text bounds, in characters of the cleaned text. Texts stay whole unless max_chars is set.
    min_chars: int = 15
    max_chars: int | None = None

    # Star scale and label cuts.
    star_min: float = 1.0
    star_max: float = 5.0
    high_star: float = 4.0
    mid_star: float = 3.0

    # The small sample, the first clean rows of the input: rows kept, and raw rows scanned in fast mode.
    sample_rows: int = 100_000
    raw_cap: int = 600_000

    # Training set.
    min_train_chars: int = 10
    seed: int = 42
    train_fraction: float = 0.8
    validation_fraction: float = 0.8
    parallel_fits: int = 2

    # Feature widths and document-frequency floors.
    word_buckets: int = 3072
    bigram_buckets: int = 2048
    category_vocab: int = 150
    word_min_df: int = 2
    bigram_min_df: int = 3

    # Labelled rows that a fit may use, drawn by a hash of their key; None: all. Counts, baseline and test metrics
    # always cover all rows.
    max_fit_rows: int | None = None

    # Points of the ROC arrays in the metric document; the curve itself is of all rows.
    roc_points: int = 1_000
