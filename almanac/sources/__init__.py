from almanac.sources.tables import read_table, read_tables, TABLES
from almanac.sources.csv import read_csv, read_csv_checked
from almanac.sources.config import RunConfig, load_config
from almanac.sources.sinks import publish_forecasts, read_published, write_forecasts

__all__ = ["read_table", "read_tables", "TABLES", "read_csv", "RunConfig", "load_config",
           "write_forecasts", "publish_forecasts", "read_published", "read_csv_checked"]
