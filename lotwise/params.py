"""All constants of the pricing model and of the deal rules in one place."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    # row filters
    price_cap: float = 365_000.0  # keep price < cap
    min_year: int = 2013  # keep year > min_year
    mileage_limit: float = 650_000.0  # profile filter on implausible mileage
    # scalar columns
    tier_width: float = 10_000.0
    age_year: int = 2024
    # additive model
    floor_share: float = 0.2
    year_rate: float = 0.1
    mileage_weight: float = 0.16
    mileage_scale: float = 100_000.0
    flat_slope: float = 1e-9  # a fitted slope below this is summation noise: treated as 0
    fit_on: str = "full"  # rows behind the group means: "full" or "train"
    # split
    validation_share: float = 0.1
    test_share: float = 0.2
    strata: int = 4  # price quartiles
    seed: int = 123
    order_buckets: int = 100_003
    # forest: the grid is the published one, depth the library's limit
    rf_trees: int = 500
    rf_depth: int = 30
    rf_bins: int = 64
    rf_folds: int = 3
    rf_grid_trees: tuple[int, ...] = (500, 1000, 1500)
    rf_grid_subsets: tuple[str, ...] = ("2", "3", "4", "5")
    rf_prior_rows: float = 10.0  # rows at the overall mean added to each level
    rf_encoding: str = "means"  # text predictors: "means" of their levels or "onehot"
    rf_repeats: int = 1  # cross-validations with other folds
    rf_parallel: int = 2  # fits of one fold at a time
    # a caller's choice, which no query makes: beyond this many, rows that no tree tells apart
    # become one row with their number; each such set is kept in parts for the bootstrap, as many
    # as stay within this number. None: every row is a training row of its own, however many
    rf_rows: int | None = None
    # deal rules
    gap_full: float = 20.0
    gap_recent: float = 10.0
    min_count: int = 10
    max_mileage: float = 80_000.0
    top_per_trim: int = 2
    deadband: float = 0.01
