"""Spark-native rental-yield comparison.

Compares the yearly net revenue of short-stay listings with that of long-term
lets per 4-digit postal area (PC4) and recommends a strategy per area.

Layout:
  sources/    readers and sinks (CSV, multi-line JSON, GeoJSON zones, tables)
  functions/  column expressions (text standardisation, predicates, casts)
  operators/  DataFrame operators (spatial join, revenue model, aggregates, comparison)
  plans/      layer jobs (bronze, silver, gold), profiling, the ordered run
"""

from .params import Assumptions, Bounds, Labels, Paths

__all__ = ["Assumptions", "Bounds", "Labels", "Paths"]
