"""The ten governed views over a set of warehouse tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from convoy.operators import kpi
from convoy.sources.tables import publish_views


Tables = Mapping[str, DataFrame]


def _routes(t: Tables) -> DataFrame:
    return kpi.route_performance(t["dim_route"], t["fact_delivery"])


def _efficiency(t: Tables) -> DataFrame:
    return kpi.fuel_efficiency(t["fact_fuel"])


def _upkeep(t: Tables) -> DataFrame:
    return kpi.maintenance_kpi(t["fact_maintenance"])


def _fleet(t: Tables) -> tuple[DataFrame, ...]:
    return tuple(t[n] for n in ("dim_vehicle", "fact_delivery", "fact_gps", "fact_fuel", "fact_maintenance"))


VIEWS: dict[str, Callable[[Tables], DataFrame]] = {
    "vw_delivery_trend": lambda t: kpi.delivery_trend(t["fact_delivery"]),
    "vw_fuel_efficiency": _efficiency,
    "vw_cost_per_delivery": lambda t: kpi.cost_per_delivery(t["dim_vehicle"], t["fact_fuel"], t["fact_delivery"]),
    "vw_idle_time": lambda t: kpi.idle_time(t["fact_vehicle_telemetry"]),
    "vw_maintenance_kpi": _upkeep,
    "vw_route_performance": _routes,
    "vw_vehicle_kpi": lambda t: kpi.vehicle_kpi(*_fleet(t)),
    "vw_depot_performance": lambda t: kpi.depot_performance(*_fleet(t)),
    "vw_executive_kpis": lambda t: kpi.executive_kpis(
        t["dim_vehicle"], t["dim_driver"], t["dim_route"], t["fact_delivery"], t["fact_fuel"], t["fact_maintenance"]
    ),
    "vw_exceptions": lambda t: kpi.exceptions(_routes(t), _efficiency(t), _upkeep(t)),
}


def kpi_view(tables: Tables, name: str) -> DataFrame:
    """One view, nothing computed yet; only the tables it uses are touched."""
    return VIEWS[name](tables)


def publish_kpis(tables: Tables) -> dict[str, DataFrame]:
    """Publish all views to SQL under their names."""
    views = {name: kpi_view(tables, name) for name in VIEWS}
    publish_views(views)
    return views
