"""Column-level functions (all built from pyspark.sql.functions, so they stay in codegen)."""
