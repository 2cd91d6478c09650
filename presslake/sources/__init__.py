"""Readers: test tables, sitemap listings, captured pages, messages, layers."""

from presslake.sources.tables import table
from presslake.sources.sitemap import read_sitemap
from presslake.sources.pages import read_pages
from presslake.sources.messages import read_messages
from presslake.sources.layers import read_silver, read_state, SilverMissing
from presslake.sources.metrics import read_metric_samples

__all__ = ["table", "read_sitemap", "read_pages", "read_messages", "read_silver", "read_state", "SilverMissing",
           "read_metric_samples"]
