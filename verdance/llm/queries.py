"""The numbered operators as queries over the driver tables, with SQL where SQL can say it."""

from __future__ import annotations

from verdance.llm.collocations import COLLOCATION_SQL, collocation_query
from verdance.llm.decontaminate import decontamination_query
from verdance.llm.jaccard_join import JACCARD_SQL, jaccard_query
from verdance.llm.licenses import LICENSE_SQL, license_query
from verdance.llm.packing import packing_query
from verdance.llm.quality_model import quality_query
from verdance.llm.retrieval_packing import retrieval_packing_query
from verdance.llm.rules import RULES_SQL, rules_query
from verdance.llm.secrets import secrets_query
from verdance.llm.spelling import SPELLING_SQL, spelling_query
from verdance.llm.token_files import token_query
from verdance.llm.token_rollup import rollup_query
from verdance.llm.warc import WARC_SQL, warc_query

QUERIES = {
    "op1_quality_classifier": quality_query,
    "op2_best_fit_packing": packing_query,
    "op3_token_rollup": rollup_query,
    "op4_benchmark_decontamination": decontamination_query,
    "op5_secret_scan": secrets_query,
    "op6_warc_derivatives": warc_query,
    "op7_license_scan": license_query,
    "op8_ngram_jaccard_join": jaccard_query,
    "op9_token_files": token_query,
    "op10_quality_rules": rules_query,
    "op11_phrase_collocations": collocation_query,
    "op12_retrieval_packing": retrieval_packing_query,
    "op13_spelling_variants": spelling_query,
}

#: The others learn, align, pack or encode, which SQL cannot say; tests compare them with brute force.
ORACLES = {
    "op6_warc_derivatives": WARC_SQL,
    "op7_license_scan": LICENSE_SQL,
    "op8_ngram_jaccard_join": JACCARD_SQL,
    "op10_quality_rules": RULES_SQL,
    "op11_phrase_collocations": COLLOCATION_SQL,
    "op13_spelling_variants": SPELLING_SQL,
}
