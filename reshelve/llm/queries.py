"""The registered query of each operator, and the SQL it must equal where SQL can express it."""

from __future__ import annotations

from reshelve.llm.alignment import op13_align
from reshelve.llm.chat import op9_chat
from reshelve.llm.embedding_dedup import op3_embedding_dedup
from reshelve.llm.fingerprint import op1_fingerprint
from reshelve.llm.html_text import op8_html_text
from reshelve.llm.line_dedup import op4_line_dedup, op4_passages
from reshelve.llm.mixing import OP6_SQL, op6_mixing
from reshelve.llm.near_dedup import op2_near_dedup
from reshelve.llm.phrases import OP11_SQL, op11_phrases
from reshelve.llm.pieces import op7_pieces
from reshelve.llm.quality import op5_quality
from reshelve.llm.secret_scan import op10_secret_scan
from reshelve.llm.toxicity import op12_toxicity

QUERIES = (op1_fingerprint, op2_near_dedup, op3_embedding_dedup, op4_line_dedup, op4_passages,
           op5_quality, op6_mixing, op7_pieces, op8_html_text, op9_chat, op10_secret_scan, op11_phrases, op12_toxicity,
           op13_align)


def registered():
    return {query.__name__: query for query in QUERIES}


def statements():
    return {"op6_mixing": OP6_SQL, "op11_phrases": OP11_SQL}
