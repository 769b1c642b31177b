"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from envgrade.llm.bpe import op2_bpe
from envgrade.llm.conversations import op13_conversations
from envgrade.llm.jaccard import op10_jaccard
from envgrade.llm.licenses import op11_licenses
from envgrade.llm.mtree import ORACLE_SQL as TOP_K_SQL
from envgrade.llm.mtree import op3_top_k
from envgrade.llm.neardup import op6_neardup
from envgrade.llm.oracle import LICENCES, NEAR_TEXTS, NEAR_VECTORS, PERSONAL
from envgrade.llm.packing import op8_packing
from envgrade.llm.pii import op5_pii
from envgrade.llm.sharding import op1_sharding
from envgrade.llm.spelling import op12_spelling
from envgrade.llm.suffixes import op4_suffix_dedup
from envgrade.llm.toxicity import op9_toxicity
from envgrade.llm.warc import ORACLE_SQL as WARC_SQL
from envgrade.llm.warc import op7_warc

QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_bpe": op2_bpe,
    "op3_top_k": op3_top_k,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_pii": op5_pii,
    "op6_neardup": op6_neardup,
    "op7_warc": op7_warc,
    "op8_packing": op8_packing,
    "op9_toxicity": op9_toxicity,
    "op10_jaccard": op10_jaccard,
    "op11_licenses": op11_licenses,
    "op12_spelling": op12_spelling,
    "op13_conversations": op13_conversations,
}
ORACLE: dict[str, str] = {
    "op3_top_k": TOP_K_SQL,
    # On these tables no text holds the added kinds, so all spans are base spans.
    "op5_pii": PERSONAL,
    "op6_neardup": NEAR_VECTORS,
    "op7_warc": WARC_SQL,
    "op10_jaccard": NEAR_TEXTS,
    "op11_licenses": LICENCES,
}
