"""presslake: a Spark-native news lakehouse.

Listings and captured pages become articles, articles become messages,
messages become bronze and silver layers, and silver becomes gold counts
and operational metric views. Everything is expressed as DataFrame
transformations so Catalyst plans, prunes and pushes down the work.

Typical use::

    from presslake import get_spark, read_pages, extract_articles, PROFILE_SEG3, to_silver, gold_counts
"""

from presslake.functions import clean_text, normalize_date, parse_date
from presslake.operators.extract import PROFILE_SEG3, PROFILE_SEG6, Profile, extract_articles
from presslake.operators.gold import gold_counts, gold_one_pass, split_gold, top_categories
from presslake.operators.incremental import retry_quarantine, run_incremental, unseen
from presslake.operators.listing import drop_media, first_n, newer_than, newest_first, valid_entries
from presslake.operators.messages import decode_messages, encode_messages, to_bronze
from presslake.operators.metrics import increase, instant_rate_sum, latest, rate, sum_latest
from presslake.operators.silver import dedup_first, to_silver
from presslake.session import checkpoint_dir, get_spark
from presslake.sources import read_messages, read_pages, read_silver, read_sitemap, read_state

__all__ = [
    "get_spark", "checkpoint_dir",
    "clean_text", "parse_date", "normalize_date",
    "Profile", "PROFILE_SEG3", "PROFILE_SEG6", "extract_articles",
    "valid_entries", "drop_media", "newer_than", "newest_first", "first_n",
    "encode_messages", "decode_messages", "to_bronze", "to_silver", "dedup_first",
    "gold_one_pass", "split_gold", "gold_counts", "top_categories",
    "unseen", "run_incremental", "retry_quarantine",
    "latest", "sum_latest", "increase", "rate", "instant_rate_sum",
    "read_sitemap", "read_pages", "read_messages", "read_silver", "read_state",
]
