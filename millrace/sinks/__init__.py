"""Table writers."""

from millrace.sinks.bronze import write_bronze
from millrace.sinks.silver import SilverTable

__all__ = ["SilverTable", "write_bronze", "write_csv"]


def write_csv(df, path: str, mode: str = "errorifexists") -> None:
    """CSV with a header, NULL as an empty cell."""
    df.write.mode(mode).option("header", True).option("nullValue", "").option("emptyValue", "").csv(path)
