"""Parameters that define the meaning of results, with their default values."""

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    min_mapq: int = 30
    min_length: int = 50
    max_length: int = 500
    short_min: int = 100
    short_max: int = 150
    long_min: int = 151
    long_max: int = 220
    chrom_style: str = "match_bins"
    autosomes_only: bool = True
    bin_size: int = 100_000
    bin_size_large: int = 5_000_000
    histogram_max: int = 1000
    lowess_frac: float = 0.30
    exclude_flags: int = 3844
    wps_window: int = 120
    wps_default_regions: int = 100
    max_features: int = 5000
    test_size: float = 0.25
    seed: int = 7
    folds: int = 5
    # Limits for the opt-in quality flags.
    qc_min_fragments: int = 5_000_000
    qc_min_coverage: float = 0.1
    qc_max_duplicate_rate: float = 0.35
    qc_min_median_length: int = 120
    qc_max_median_length: int = 190
    qc_max_mito_fraction: float = 0.20
    qc_min_proper_pair: float = 0.80


DEFAULTS = Params()
