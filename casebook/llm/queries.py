"""Registered queries of the text operators."""

from __future__ import annotations

from casebook.llm.bpe import op2_bpe
from casebook.llm.chat import OP6_SQL, op6_chat
from casebook.llm.counting import op4_counts
from casebook.llm.decontam import op7_decontam
from casebook.llm.langid import op5_langid
from casebook.llm.pii import op10_pii
from casebook.llm.quality import op9_quality
from casebook.llm.rabitq import op8_rabitq
from casebook.llm.simhash import op1_simhash
from casebook.llm.toxicity import op3_toxicity

QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_bpe": op2_bpe,
    "op3_toxicity": op3_toxicity,
    "op4_counts": op4_counts,
    "op5_langid": op5_langid,
    "op6_chat": op6_chat,
    "op7_decontam": op7_decontam,
    "op8_rabitq": op8_rabitq,
    "op9_quality": op9_quality,
    "op10_pii": op10_pii,
}
SQL: dict[str, str] = {"op6_chat": OP6_SQL}
