"""Report export: the analyses written as CSV files with a header row.

The reference exported six of its views to CSV for its dashboard; by
default the same six are written, each in the view's presentation order
(a distributed sort; part files are in order).
"""

from __future__ import annotations

from collections.abc import Iterable

from ..functions.expr import presentation
from ..functions.params import DEFAULT, Params
from ..sources import feed
from ..sources.warehouse import Warehouse
from . import registry

# the reports the reference exported (fixed list)
EXPORTED = (
    "category_performance",
    "executive_kpi_dashboard",
    "reorder_analysis",
    "seasonality_summary",
    "stockout_risk",
    "store_performance",
)


def export_reports(wh: Warehouse, out_dir: str, names: Iterable[str] = EXPORTED, p: Params = DEFAULT) -> list[str]:
    """Write ``<out_dir>/<name>`` for every report; returns the paths."""
    paths = []
    for name in names:
        df = registry.present(name, presentation(registry.QUERIES[name](wh, p)))
        path = f"{out_dir.rstrip('/')}/{name}"
        feed.export_csv(df, path)
        paths.append(path)
    return paths
