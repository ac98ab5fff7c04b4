"""The queries of the numbered operators and their SQL, for the registry."""

from hiregrain.llm import (
    byte_bpe,
    class_lm,
    decontamination,
    filter_audit,
    language_id,
    periodic_runs,
    quality,
    simhash,
    spot_signatures,
    token_counts,
    toxicity,
    url_filter,
    warc_zip,
)

QUERIES = {
    "op1_language_id": language_id.op1_language_id,
    "op2_quality_rules": quality.op2_quality_rules,
    "op3_decontamination": decontamination.op3_decontamination,
    "op4_simhash": simhash.op4_simhash,
    "op5_token_counts": token_counts.op5_token_counts,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_class_lm": class_lm.op7_class_lm,
    "op8_byte_bpe": byte_bpe.op8_byte_bpe,
    "op9_warc_zip": warc_zip.op9_warc_zip,
    "op10_url_filter": url_filter.op10_url_filter,
    "op11_spot_signatures": spot_signatures.op11_spot_signatures,
    "op12_periodic_runs": periodic_runs.op12_periodic_runs,
    "op13_filter_audit": filter_audit.op13_filter_audit,
}

ORACLES = {
    "op3_decontamination": decontamination.OP3_SQL,
    "op9_warc_zip": warc_zip.OP9_SQL,
    "op10_url_filter": url_filter.OP10_SQL,
    "op11_spot_signatures": spot_signatures.op11_spot_signatures,
    "op12_periodic_runs": periodic_runs.op12_periodic_runs,
    "op11_spot_signatures": spot_signatures.OP11_SQL,
    "op13_filter_audit": filter_audit.OP13_SQL,
}
