"""PySpark jobs that turn stored web and API responses into linked, citable tables."""
