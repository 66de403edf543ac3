"""A PySpark engine for mining documents and the life cycles of agreements."""
