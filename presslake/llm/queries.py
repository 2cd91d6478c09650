"""The operators' queries over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from presslake.llm.centroids import OP12_SQL, op12_centroids
from presslake.llm.conversations import op11_conversations
from presslake.llm.mixing import op9_mixing
from presslake.llm.packing import op4_packing
from presslake.llm.personal import op13_pii
from presslake.llm.quality import op7_quality
from presslake.llm.rules import op6_quality_rules
from presslake.llm.secrets import op10_secrets
from presslake.llm.simhash import op1_simhash
from presslake.llm.simple8b import op3_token_ids
from presslake.llm.topk import OP2_SQL, op2_top_k
from presslake.llm.toxicity import op5_toxicity
from presslake.llm.warc import OP8_SQL, op8_warc_fixity

QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_top_k": op2_top_k,
    "op3_token_ids": op3_token_ids,
    "op4_packing": op4_packing,
    "op5_toxicity": op5_toxicity,
    "op6_quality_rules": op6_quality_rules,
    "op7_quality": op7_quality,
    "op8_warc_fixity": op8_warc_fixity,
    "op9_mixing": op9_mixing,
    "op10_secrets": op10_secrets,
    "op11_conversations": op11_conversations,
    "op12_centroids": op12_centroids,
    "op13_pii": op13_pii,
}
ORACLE_SQL: dict[str, str] = {
    "op2_top_k": OP2_SQL,
    "op8_warc_fixity": OP8_SQL,
    "op12_centroids": OP12_SQL,
}
