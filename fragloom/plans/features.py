"""Fragments to feature matrix for a whole cohort."""

from dataclasses import dataclass

from pyspark.sql import DataFrame

from fragloom.operators import coverage, gc, matrix, regions
from fragloom.params import DEFAULTS, Params
from fragloom.session import stage


@dataclass
class FeatureTables:
    bins: DataFrame
    counts: DataFrame
    corrected: DataFrame
    arms: DataFrame
    features: DataFrame


def feature_tables(fragments: DataFrame, sizes: DataFrame, samples: DataFrame, reference: DataFrame | None = None,
                   arms: DataFrame | None = None, extra=(), params: Params = DEFAULTS, correction: str = "lowess") -> FeatureTables:
    """Bins, counts, corrected coverage, arm features and the long feature table.

    `extra` holds further long feature groups (mitochondrial, motif). The corrected
    table is stored once: it is the input of both the bin and the arm features, and
    LOWESS must not run twice. `correction` may also be linear.
    """
    tiles = coverage.make_bins(sizes, params.bin_size, params.autosomes_only)
    bins = coverage.annotate_gc(tiles, reference, params.bin_size)
    counts = coverage.dense_bin_counts(fragments, bins, samples, params.bin_size, params)
    corrected = stage(gc.correct(counts, tiles.count(), params, correction), "corrected")
    if arms is not None:
        arm_table = regions.arm_features(corrected, arms, samples, tiles)
    else:
        arm_table = regions.chrom_features(corrected)
    groups = [matrix.all_bin_features(corrected), regions.arm_long(arm_table), *extra]
    return FeatureTables(bins, counts, corrected, arm_table, matrix.union_features(*groups))
