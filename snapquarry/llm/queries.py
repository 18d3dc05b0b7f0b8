"""The registered queries of the text operators. SQL can say op11 alone; tests/llm checks the others against brute force."""

from snapquarry.llm import collocations
from snapquarry.llm.bpe import op5_bpe
from snapquarry.llm.collocations import op11_collocations
from snapquarry.llm.decontaminate import op7_decontaminate
from snapquarry.llm.html import op2_html
from snapquarry.llm.iblt import op6_fingerprints
from snapquarry.llm.langid import op8_language
from snapquarry.llm.periodic import op12_periodic
from snapquarry.llm.pii import op13_personal_data
from snapquarry.llm.quality import op10_quality
from snapquarry.llm.secrets import op3_secrets
from snapquarry.llm.simhash import op9_simhash
from snapquarry.llm.tokencount import op4_token_counts
from snapquarry.llm.toxicity import op1_toxicity

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_html": op2_html,
    "op3_secrets": op3_secrets,
    "op4_token_counts": op4_token_counts,
    "op5_bpe": op5_bpe,
    "op6_fingerprints": op6_fingerprints,
    "op7_decontaminate": op7_decontaminate,
    "op8_language": op8_language,
    "op9_simhash": op9_simhash,
    "op10_quality": op10_quality,
    "op11_collocations": op11_collocations,
    "op12_periodic": op12_periodic,
    "op13_personal_data": op13_personal_data,
}
ORACLE_SQL: dict[str, str] = {"op11_collocations": collocations.ORACLE}
