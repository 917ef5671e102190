"""The registered queries of this folder and their SQL."""
from __future__ import annotations

from minutebook.llm import op1_ngram_join as op1
from minutebook.llm import op10_topk as op10
from minutebook.llm import op11_sentencepiece as op11
from minutebook.llm import op12_filter_audit as op12
from minutebook.llm import op13_ranked_search as op13
from minutebook.llm import op2_token_counts as op2
from minutebook.llm import op3_packing as op3
from minutebook.llm import op4_quality as op4
from minutebook.llm import op5_mixing as op5
from minutebook.llm import op6_line_dedup as op6
from minutebook.llm import op7_preferences as op7
from minutebook.llm import op8_language as op8
from minutebook.llm import op9_fingerprint as op9

QUERIES = {
    "op1_ngram_join": op1.op1_ngram_join,
    "op2_token_counts": op2.op2_token_counts,
    "op3_packing": op3.op3_packing,
    "op4_quality": op4.op4_quality,
    "op5_mixing": op5.op5_mixing,
    "op6_line_dedup": op6.op6_line_dedup,
    "op7_preferences": op7.op7_preferences,
    "op8_language": op8.op8_language,
    "op9_fingerprint": op9.op9_fingerprint,
    "op10_topk": op10.op10_topk,
    "op11_sentencepiece": op11.op11_sentencepiece,
    "op12_filter_audit": op12.op12_filter_audit,
    "op13_ranked_search": op13.op13_ranked_search,
}

ORACLE: dict[str, str] = {
    "op5_mixing": op5.ORACLE,
    "op6_line_dedup": op6.ORACLE,
    "op7_preferences": op7.ORACLE,
    "op9_fingerprint": op9.ORACLE,
    "op10_topk": op10.ORACLE,
    "op12_filter_audit": op12.ORACLE,
    "op13_ranked_search": op13.ORACLE,
}
