"""Parameters of the registered queries, shared by the Spark jobs and the SQL text."""

KPI_START, KPI_END = "2024-01-05", "2024-01-12"
COHORT_DAY = "2024-01-20"
POINTS_DAY = "2024-01-10"
BILL_START, BILL_END = "1998-01-01", "1998-02-01"
INTEGRAL = 50
TOP_K = 80
# The stored table holds all days to a split, the batch merged into it all days since an earlier one.
TARGET_DAYS = (None, "2024-01-10")
BATCH_DAYS = ("2024-01-08", None)
ALL_DAYS = (None, None)
LATE_SPLIT_DAY = "2024-01-11"
