"""Registered queries of the text operators, one per operator, and their reference SQL."""

from __future__ import annotations

from eventloom.llm.decontamination import op3_decontamination
from eventloom.llm.html_text import op4_html_text
from eventloom.llm.licenses import op9_licenses
from eventloom.llm.line_dedup import op6_line_dedup
from eventloom.llm.lm_scoring import op10_lm_scoring
from eventloom.llm.oracles import ORACLES as ORACLES  # where SQL can't express a query, tests/llm has brute force
from eventloom.llm.packing import op1_packing
from eventloom.llm.quality import op5_quality
from eventloom.llm.set_join import op13_set_join
from eventloom.llm.simhash import op8_simhash
from eventloom.llm.spellings import op11_spellings
from eventloom.llm.token_files import op2_token_files
from eventloom.llm.toxicity import op7_toxicity
from eventloom.llm.vector_codes import op12_vector_codes

QUERIES = {f.__name__: f for f in (
    op1_packing, op2_token_files, op3_decontamination, op4_html_text, op5_quality,
    op6_line_dedup, op7_toxicity, op8_simhash, op9_licenses, op10_lm_scoring,
    op11_spellings, op12_vector_codes, op13_set_join,
)}
