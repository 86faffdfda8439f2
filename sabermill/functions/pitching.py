"""Pitching rates from summed counts.

Innings are summed as they are written: "6.1" counts as 6.1, not as six innings and a third.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from sabermill.functions.rates import quotient, rate

INNINGS = "innings_pitched"


@dataclass(frozen=True)
class FieldingIndependentWeights:
    """Weights and constant of FIP; hit batsmen do not count."""

    home_run: int = 13
    walk: int = 3
    strikeout: int = 2
    constant: str = "3.20"


def per_nine(count: str) -> Column:
    return rate(F.col(count) * 9, F.col(INNINGS), 2)


def era() -> Column:
    return per_nine("earned_runs")


def whip() -> Column:
    return rate(F.col("walks") + F.col("hits_allowed"), F.col(INNINGS), 2)


def strikeout_walk_ratio() -> Column:
    return rate(F.col("strikeouts"), F.col("walks"), 2)


def _outs_and_hits() -> Column:
    return F.col(INNINGS) * 3 + F.col("hits_allowed")


def batting_average_against() -> Column:
    return rate(F.col("hits_allowed"), _outs_and_hits(), 3, guard=F.col(INNINGS))


def fip(weights: FieldingIndependentWeights = FieldingIndependentWeights()) -> Column:
    events = (
        F.col("home_runs_allowed") * weights.home_run
        + F.col("walks") * weights.walk
        - F.col("strikeouts") * weights.strikeout
    )
    constant = F.lit(weights.constant).cast("decimal(4,2)")
    return F.when(
        F.col(INNINGS) > 0, F.round(quotient(events, F.col(INNINGS)) + constant, 2)
    )


def win_share() -> Column:
    return rate(F.col("wins"), F.col("wins") + F.col("losses"), 3)


def per_batter_faced(count: str) -> Column:
    faced = _outs_and_hits() + F.col("walks") + F.col("hit_batsmen")
    return rate(F.col(count), faced, 3, guard=F.col(INNINGS))


def is_starter() -> Column:
    """More than half of the games started."""
    return F.col("games_started") * 2 > F.col("games")


def is_reliever() -> Column:
    return F.col("games_started") * 2 <= F.col("games")


def role() -> Column:
    return F.when(is_starter(), "Starter").otherwise("Reliever")
