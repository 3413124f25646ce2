"""The queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from docweave.llm.fingerprint import op4_fingerprint
from docweave.llm.html_text import op8_html
from docweave.llm.langid import op10_language
from docweave.llm.media import op2_media
from docweave.llm.mixing import OP7_SQL, op7_mixing
from docweave.llm.negatives import OP11_SQL, op11_negatives
from docweave.llm.ordered import op13_ordered
from docweave.llm.packing import op3_packing
from docweave.llm.pii import op1_pii
from docweave.llm.simhash import op5_simhash
from docweave.llm.spelling import op12_spelling
from docweave.llm.substrings import op9_substrings
from docweave.llm.suffixes import op6_suffixes

QUERIES = {f.__name__: f for f in (op1_pii, op2_media, op3_packing, op4_fingerprint, op5_simhash, op6_suffixes, op7_mixing, op8_html, op9_substrings, op10_language, op11_negatives, op12_spelling, op13_ordered)}
ORACLES = {"op7_mixing": OP7_SQL, "op11_negatives": OP11_SQL}
