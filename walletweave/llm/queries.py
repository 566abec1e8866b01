"""The registered queries of this subpackage and their SQL, by name."""

from . import decontaminate, language, neardup, pieces, quality, secrets, sharding, tokens, toxicity, warc

QUERIES = {
    "op1_minhash_forest": neardup.op1_minhash_forest,
    "op2_gumbel_top_k": pieces.op2_gumbel_top_k,
    "op3_multipart_secrets": secrets.op3_multipart_secrets,
    "op4_classifier_chain": toxicity.op4_classifier_chain,
    "op5_language_mixture": language.op5_language_mixture,
    "op6_virtual_slots": sharding.op6_virtual_slots,
    "op7_revisits": warc.op7_revisits,
    "op8_host_rules": quality.op8_host_rules,
    "op9_separator_scan": tokens.op9_separator_scan,
    "op10_cgk_edit_lsh": decontaminate.op10_cgk_edit_lsh,
}
SQL = {
    "op1_minhash_forest": neardup.OP1_SQL,
    "op3_multipart_secrets": secrets.OP3_SQL,
    "op7_revisits": warc.OP7_SQL,
    "op8_host_rules": quality.OP8_SQL,
}
