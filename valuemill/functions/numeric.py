"""Numeric helpers: half-to-even rounding, the label transform and its inverses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_even(c: Column | str, to_type: str = "int") -> Column:
    """Banker's rounding (2.5 -> 2, 5.5 -> 6), then cast. ``round`` would be half-up."""
    return F.bround(_col(c), 0).cast(to_type)


def label_log(c: Column | str) -> Column:
    """Training label on log scale: log(1 + price)."""
    return F.log1p(_col(c))


def label_inverse(c: Column | str, inverse: str = "expm1") -> Column:
    """Back to the price scale: ``expm1`` (exact inverse of ``label_log``) or ``exp`` (+1 offset)."""
    if inverse == "expm1":
        return F.expm1(_col(c))
    if inverse == "exp":
        return F.exp(_col(c))
    raise ValueError(f"unknown inverse {inverse!r}")


def round6(c: Column | str) -> Column:
    return F.round(_col(c), 6)
