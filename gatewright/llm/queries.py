"""Registered queries of this package, and their SQL where SQL can express them."""

from gatewright.llm.alignment import op13_alignment
from gatewright.llm.decontaminate import OP3_SQL, op3_decontaminate
from gatewright.llm.lexical import OP12_SQL, op12_lexical_search
from gatewright.llm.packing import op6_packing
from gatewright.llm.pair_index import op11_pair_index
from gatewright.llm.quality_model import op9_quality_model
from gatewright.llm.quality_rules import OP10_SQL, op10_quality_rules
from gatewright.llm.simhash import op7_simhash
from gatewright.llm.suffix_array import op5_suffix_array
from gatewright.llm.tokens import op4_token_counts
from gatewright.llm.toxicity import op8_toxicity
from gatewright.llm.url_filter import OP1_SQL, op1_url_filter
from gatewright.llm.warc import OP2_SQL, op2_warc_index

QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_warc_index": op2_warc_index,
    "op3_decontaminate": op3_decontaminate,
    "op4_token_counts": op4_token_counts,
    "op5_suffix_array": op5_suffix_array,
    "op6_packing": op6_packing,
    "op7_simhash": op7_simhash,
    "op8_toxicity": op8_toxicity,
    "op9_quality_model": op9_quality_model,
    "op10_quality_rules": op10_quality_rules,
    "op11_pair_index": op11_pair_index,
    "op12_lexical_search": op12_lexical_search,
    "op13_alignment": op13_alignment,
}

ORACLES = {
    "op1_url_filter": OP1_SQL,
    "op2_warc_index": OP2_SQL,
    "op3_decontaminate": OP3_SQL,
    "op10_quality_rules": OP10_SQL,
    "op12_lexical_search": OP12_SQL,
}
