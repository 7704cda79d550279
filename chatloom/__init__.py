"""Chat threads, claims, entities and pages as typed Spark DataFrames."""
