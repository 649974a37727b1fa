"""Gradient boosting on binned features: many ensembles grown by shared scans or, on small tables, a task each, scored in the JVM."""

from valuemill.boosting.bins import BinnedTable, bin_features, cut_points
from valuemill.boosting.ensembles import fit, search, validate
from valuemill.boosting.grow import Settings
from valuemill.boosting.model import BoostedTrees

__all__ = ["BinnedTable", "BoostedTrees", "Settings", "bin_features", "cut_points", "fit", "search", "validate"]
