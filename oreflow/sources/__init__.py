from oreflow.sources.readers import jdbc_bounds, jdbc_options, open_table, read_jdbc, read_source, rows_like
from oreflow.sources.sinks import balanced, clustered, read_merged, write_all, write_table
from oreflow.sources.target import ChangeTarget

__all__ = [
    "ChangeTarget", "balanced", "clustered", "jdbc_bounds", "jdbc_options", "open_table", "read_jdbc",
    "read_merged", "read_source", "rows_like", "write_all", "write_table",
]
