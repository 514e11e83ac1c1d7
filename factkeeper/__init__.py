"""Table maintenance, recency and KPI reporting on Spark DataFrames."""
