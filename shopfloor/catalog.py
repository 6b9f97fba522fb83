"""The named queries over the five tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame

from shopfloor.plans import analyses, explore, extract, profile, rankings, reports, sketches, validate
from shopfloor.sources.tables import Tables


def _preview(table: str) -> Callable[[Tables], DataFrame]:
    return lambda tables: explore.preview(getattr(tables, table))


def _on_extract(query: Callable[[DataFrame], DataFrame]) -> Callable[[Tables], DataFrame]:
    return lambda tables: query(extract.run_extract(tables, ordered=False))


def _with_extract(query: Callable[[Tables, DataFrame], DataFrame]) -> Callable[[Tables], DataFrame]:
    return lambda tables: query(tables, extract.run_extract(tables, ordered=False))


QUERIES: dict[str, Callable[[Tables], DataFrame]] = {
    **{f"preview_{t}": _preview(t) for t in ("production_runs", "quality_checks", "equipment", "plants", "products")},
    "preview_rows_found": explore.preview_rows_found,
    "table_row_counts": explore.table_row_counts,
    "defect_rate_by_plant": reports.defect_rate_by_plant,
    "defect_rate_top10": reports.defect_rate_top10,
    "efficiency_by_shift": reports.efficiency_by_shift,
    "pass_rate_by_category": reports.pass_rate_by_category,
    "pass_rate_by_category_short": reports.pass_rate_by_category_short,
    "quality_rollup": lambda tables: extract.quality_rollup(tables.quality_checks),
    "latest_equipment": lambda tables: extract.latest_equipment(tables.equipment),
    "run_extract": extract.run_extract,
    "join_preview_10": extract.join_preview,
    "plant_efficiency_summary": reports.plant_efficiency_summary,
    "plant_efficiency_short": reports.plant_efficiency_short,
    "efficiency_rank": rankings.efficiency_rank,
    "efficiency_rank_top50": rankings.efficiency_rank_top50,
    "efficiency_rank_top20": rankings.efficiency_rank_top20,
    "extract_profile": _on_extract(profile.extract_profile),
    "null_report": _on_extract(profile.null_report),
    "quality_flags": _on_extract(profile.quality_flags),
    "completeness": _with_extract(validate.completeness),
    "fan_out": _with_extract(validate.fan_out),
    "null_rates": lambda tables: validate.null_rates(tables.production_runs),
    "defect_coverage": _on_extract(validate.defect_coverage),
    "defect_by_plant_shift": analyses.defect_by_plant_shift,
    "maintenance_vs_quality": _on_extract(analyses.maintenance_vs_quality),
    "quality_correlations": _on_extract(analyses.quality_correlations),
    "downtime_vs_yield": analyses.downtime_vs_yield,
    "top_run_conditions": analyses.top_run_conditions,
    "monthly_trend": analyses.monthly_trend,
    "time_rollup": analyses.time_rollup,
    "output_quantiles": analyses.output_quantiles,
    "output_quantiles_by_year": analyses.output_quantiles_by_year,
    "distinct_by_year": lambda tables: sketches.distinct_by_year(tables).drop("estimate"),
    "distinct_estimates": lambda tables: sketches.estimates(sketches.monthly_sketches(tables)),
    "rejected_runs": validate.rejected_runs,
}


def run_named(name: str, tables: Tables) -> DataFrame:
    if name not in QUERIES:
        raise KeyError(f"no query named {name!r}; known: {', '.join(QUERIES)}")
    return QUERIES[name](tables)
