"""Composite metrics, report sections, the weekly job and the registered queries."""

from homestat.plans.metrics import (appraisal_gap, assessment_ratio, buyer_value_index, cash_flow_zones,
                                    inventory_absorption, investor_activity, market_snapshot, price_pressure,
                                    resale_flips, run_metrics, trailing_year_trend, trend_lines)

__all__ = ["appraisal_gap", "assessment_ratio", "buyer_value_index", "cash_flow_zones", "inventory_absorption",
           "investor_activity", "market_snapshot", "price_pressure", "resale_flips", "run_metrics",
           "trailing_year_trend", "trend_lines"]
