"""What is checked, per dataset. New rules are added here, not in the checks."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Checks:
    """Rules of one dataset; everything but the key may stay empty."""

    key: tuple[str, ...]
    completeness: float = 0.90
    ranges: dict[str, tuple[float, float]] = field(default_factory=dict)
    dates: tuple[str, ...] = ()
    rules: tuple[dict, ...] = ()
    references: dict[str, tuple[str, str]] = field(default_factory=dict)
    distribution: tuple[str, ...] = ()
    outliers: tuple[str, ...] = ()
    fresh_column: str | None = None
    fresh_days: int | None = None
    top_share: float = 0.30
    max_z: float = 3.0


# Thresholds of the three operational datasets.
DATASETS: dict[str, Checks] = {
    "projects": Checks(
        key=("project_id",),
        completeness=0.90,
        ranges={"budget": (0, 10_000_000), "actual_cost": (0, 10_000_000)},
        dates=("start_date", "end_date"),
        rules=(
            {"type": "before", "columns": ("start_date", "end_date")},
            {"type": "non_negative", "column": "actual_cost"},
        ),
        references={"project_manager_id": ("employees", "employee_id")},
        distribution=("department", "status", "region"),
        outliers=("budget", "actual_cost"),
    ),
    "employees": Checks(
        key=("employee_id",),
        completeness=0.85,
        ranges={"salary": (10_000, 100_000), "years_experience": (0, 50)},
        dates=("hire_date",),
        rules=(
            {"type": "non_negative", "column": "salary"},
            {"type": "band", "column": "salary", "group": "level"},
        ),
        references={"manager_id": ("employees", "employee_id")},
        distribution=("department", "level", "region"),
        outliers=("salary",),
    ),
    "transactions": Checks(
        key=("transaction_id",),
        completeness=0.80,
        ranges={"amount": (0, 1_000_000)},
        dates=("transaction_date",),
        rules=({"type": "non_negative", "column": "amount"},),
        references={"project_id": ("projects", "project_id"), "approved_by": ("employees", "employee_id")},
        distribution=("category", "payment_status"),
        outliers=("amount",),
        fresh_column="transaction_date",
        fresh_days=30,
    ),
}


def checks_for(dataset: str, datasets: dict[str, Checks] = DATASETS) -> Checks:
    if dataset not in datasets:
        raise KeyError(f"no checks configured for dataset {dataset!r}")
    return datasets[dataset]
