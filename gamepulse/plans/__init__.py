"""The jobs: warehouse KPIs, cohorts, bills, points and recommendations."""
