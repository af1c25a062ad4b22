"""millrace: Spark-native reshaping, cleaning and versioning of irregular report deliveries."""

from millrace.config import ColumnMap, FeedSpec, SilverSpec
from millrace.session import build_session, workspace

__all__ = ["ColumnMap", "FeedSpec", "SilverSpec", "build_session", "workspace"]
