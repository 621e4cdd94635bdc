"""Queries of the operators in this subpackage, with SQL where SQL can express them."""

import corpus_pipeline
from attestry.llm import chat, decontamination, language, licenses, lines, mixing, ngrams, quality, simhash, warc

QUERIES = {
    "op1_chat_formatting": chat.op1_chat_formatting,
    "op2_quality_rules": quality.op2_quality_rules,
    "op3_language_id": language.op3_language_id,
    "op4_warc": warc.op4_warc,
    "op5_line_dedup": lines.op5_line_dedup,
    "op6_simhash_near_dedup": simhash.op6_simhash_near_dedup,
    "op7_mixing": mixing.op7_mixing,
    "op8_decontamination": decontamination.op8_decontamination,
    "op9_lm_scoring": ngrams.op9_lm_scoring,
    "op10_license_scans": licenses.op10_license_scans,
    "pipeline": corpus_pipeline.run,
}
ORACLE_SQL = {
    "op1_chat_formatting": chat.ORACLE,
    "op2_quality_rules": quality.ORACLE,
    "op4_warc": warc.ORACLE,
}
