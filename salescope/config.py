"""Settings of an analysis: dimensions, thresholds, filters and report sizes."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

# Band edges (upper bound, exclusive) with the labels they close, and the open last label.
AGE_BOUNDS = (26, 36, 46, 56)
AGE_LABELS = ("18-25", "26-35", "36-45", "46-55", "55+")
INCOME_BOUNDS = (40000, 80000)
INCOME_LABELS = ("Low Income", "Middle Income", "High Income")
HOUSE_OWNER_LABELS = {"1": "Home Owner", "0": "Non Home Owner"}

ALL = "All"


@dataclass(frozen=True)
class Thresholds:
    """Cut-offs of the growth, margin, signal and flag rules."""

    strong_growth: float = 0.10
    high_margin: float = 0.40
    medium_margin: float = 0.25
    healthy_margin: float = 0.30
    thin_margin: float = 0.20
    new_base_ratio: float = 0.05
    year_materiality: float = 0.05


@dataclass(frozen=True)
class AnalysisConfig:
    """What to analyse; every operator takes its column names from here or as arguments."""

    core_dimensions: tuple[str, ...] = (
        "ProductCategory",
        "ProductSubcategory",
        "Country",
        "IncomeGroup",
        "AgeGroup",
    )
    context_dimensions: tuple[str, ...] = ("Region", "TerritoryGroup")
    chart_dimensions: tuple[str, ...] = ("ProductCategory", "Country", "AgeGroup")
    matrix_dimension: str = "ProductCategory"
    active_filters: Mapping[str, str] = field(default_factory=dict)
    attach_anchor: str = "Bikes"
    attach_category: str = "Accessories"
    currency: str = "€"
    thresholds: Thresholds = Thresholds()
    history_top: int = 8
    ranked_top: int = 5
    new_top: int = 8
    chart_top: int = 6
    matrix_top: int = 10
    outlook_complete_years_only: bool = True

    @property
    def history_dimensions(self) -> tuple[str, ...]:
        return self.core_dimensions + self.context_dimensions
