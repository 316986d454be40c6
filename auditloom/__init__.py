"""auditloom: data-governance and provenance analytics on Spark DataFrames."""
