from lakeload.sources.connections import spark_properties, storage_summary
from lakeload.sources.csv import load_csv, resolve_path
from lakeload.sources.rows import from_rows

__all__ = ["from_rows", "load_csv", "resolve_path", "spark_properties", "storage_summary"]
