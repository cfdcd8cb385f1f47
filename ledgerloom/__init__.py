"""A layered transaction lakehouse written as plain PySpark DataFrame jobs."""
