"""Settings of the analytics, with their usual values; fixed values of the published method."""

from __future__ import annotations

from dataclasses import dataclass

EPS = 1e-6


@dataclass(frozen=True)
class Settings:
    """Everything a run can vary.

    strata: further columns within which periods are scaled; features: slopes, greenup3 or cover2, unless one_feature names a single slope
    (intensity_slope, fill_slope, uniformity_slope); silhouette_error: by how much a silhouette may be off so that cells of points can stand for them, or none; index_column: the summer index's column, found by its name if none is given; cluster_index: whether it is clustered into ages.
    """

    trend_periods: tuple[int, ...] = (3, 4, 5, 6, 7)
    use_valid_fraction: bool = True
    strata: tuple[str, ...] = ()
    features: str = "cover2"
    one_feature: str | None = None
    shrink: str = "sqrt"
    shrink_level: bool = False
    min_quality: float = 0.2
    min_periods: int = 2
    assign_min_quality: float = 0.0
    ks: tuple[int, ...] = (2, 3)
    k_select: str = "silhouette"
    method: str = "kmeans"
    label_schema: str = "likely"
    confidence_threshold: float = 0.6
    distance_threshold: float = 1.5
    index_column: str | None = None
    cluster_index: bool = True
    index_ks: tuple[int, ...] = (2, 3)
    index_select: str = "silhouette"
    silhouette_error: float | None = None
    ui_uncertain_threshold: float = 0.15
    season_mid: str = "-01-31"

    @property
    def feature_set(self) -> str:
        return self.one_feature or self.features

    @property
    def cluster_method(self) -> str:
        """BIC always means a mixture."""
        return "gmm" if self.k_select == "bic" else self.method


#: Winter windows (number, start month-day, end month-day exclusive); months before November belong to
#: the next year. They overlap. Fixed values.
WINTER_WINDOWS = (
    (1, "11-16", "11-30"),
    (2, "11-28", "12-18"),
    (3, "12-12", "01-05"),
    (4, "01-01", "01-15"),
    (5, "01-16", "01-31"),
    (6, "01-28", "02-18"),
    (7, "02-12", "03-05"),
    (8, "03-01", "03-16"),
)
