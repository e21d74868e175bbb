"""Registered queries of the numbered operators."""

from .fingerprint import op3_fingerprints
from .htmltext import op9_html_text
from .langid import op1_language_id
from .mix import op5_mix
from .neardup import op10_near_duplicates
from .pack import op4_packing
from .pii import op7_personal_data
from .quality import op6_quality
from .repair import op11_conversation_repair
from .search import op13_search
from .setjoin import op12_set_join
from .shard import op8_shards
from .tokencount import op2_token_counts

QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_token_counts, op3_fingerprints, op4_packing, op5_mix, op6_quality, op7_personal_data, op8_shards,
    op9_html_text, op10_near_duplicates, op11_conversation_repair, op12_set_join, op13_search)}
