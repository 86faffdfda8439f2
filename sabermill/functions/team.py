"""Team record metrics."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from sabermill.functions.rates import rate


def win_pct() -> Column:
    return rate(F.col("wins"), F.col("games_played"), 3)


def games_behind() -> Column:
    """From the rounded win share of the best team in the division."""
    gap = F.col("best_win_pct") * F.col("games_played") - F.col("wins")
    return F.when(
        F.col("best_win_pct").isNotNull() & (F.col("games_played") > 0), F.round(gap, 1)
    )


def team_ops() -> Column:
    """Sum of the two rounded rates."""
    return F.round(F.col("team_obp") + F.col("team_slg"), 3)


def _square(runs: str) -> Column:
    value = F.col(runs).cast("decimal(18,0)")
    return (value * value).cast("decimal(24,0)")


def _both_scored() -> Column:
    return (F.col("runs_scored") > 0) & (F.col("runs_allowed") > 0)


def _squares() -> Column:
    return (_square("runs_scored") + _square("runs_allowed")).cast("decimal(24,0)")


def pythagorean_win_pct() -> Column:
    return F.when(_both_scored(), F.round(_square("runs_scored") / _squares(), 3))


def pythagorean_wins() -> Column:
    """Games times the unrounded share."""
    games = F.col("games_played").cast("decimal(10,0)")
    expected = (_square("runs_scored") * games).cast("decimal(30,0)") / _squares()
    return F.when(_both_scored() & (F.col("games_played") > 0), F.round(expected, 0))


def luck() -> Column:
    return F.col("wins") - F.col("pythagorean_wins")
