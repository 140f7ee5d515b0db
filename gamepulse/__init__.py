"""Game-publishing KPIs, cohorts, bills, points and recommendations on Spark DataFrames."""
