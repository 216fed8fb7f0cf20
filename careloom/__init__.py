"""careloom: clinical data harmonisation as Spark DataFrame jobs.

Partner extracts are formatted, de-duplicated, code-mapped, repaired and loaded
into a common data model.  Every operator takes and returns DataFrames and is
built from native expressions, so Catalyst plans each stage as one lazy query.
"""
