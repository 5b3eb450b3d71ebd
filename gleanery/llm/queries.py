"""The subpackage's registered queries: QUERIES by name, and ORACLE_SQL where DuckDB can say the same."""

from gleanery.llm.bpe import op5_bpe
from gleanery.llm.decontaminate import op8_decontaminate
from gleanery.llm.filteraudit import OP13_SQL, op13_filteraudit
from gleanery.llm.fingerprint import op9_fingerprint
from gleanery.llm.htmltext import op4_htmltext
from gleanery.llm.langid import op6_langid
from gleanery.llm.linededup import OP3_SQL, op3_linededup
from gleanery.llm.quality import op1_quality
from gleanery.llm.qualityrules import op11_qualityrules
from gleanery.llm.simhash import op10_simhash
from gleanery.llm.tokenalign import op12_tokenalign
from gleanery.llm.toxicity import op7_toxicity
from gleanery.llm.urlfilter import OP2_SQL, op2_urlfilter

QUERIES = {
    "op1_quality": op1_quality,
    "op2_urlfilter": op2_urlfilter,
    "op3_linededup": op3_linededup,
    "op4_htmltext": op4_htmltext,
    "op5_bpe": op5_bpe,
    "op6_langid": op6_langid,
    "op7_toxicity": op7_toxicity,
    "op8_decontaminate": op8_decontaminate,
    "op9_fingerprint": op9_fingerprint,
    "op10_simhash": op10_simhash,
    "op11_qualityrules": op11_qualityrules,
    "op12_tokenalign": op12_tokenalign,
    "op13_filteraudit": op13_filteraudit,
}

ORACLE_SQL: dict[str, str] = {"op2_urlfilter": OP2_SQL, "op3_linededup": OP3_SQL, "op13_filteraudit": OP13_SQL}
