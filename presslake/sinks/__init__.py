"""Writers: messages, state log, gold tables (K1, K4, K6, K8), page captures (S3)."""

from presslake.sinks.pages import write_pages
from presslake.sinks.writers import write_messages, write_state, write_gold, register_gold, GoldTarget

__all__ = ["write_pages", "write_messages", "write_state", "write_gold", "register_gold", "GoldTarget"]
