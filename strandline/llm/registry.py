"""Queries of this subpackage, and their SQL where SQL can express them."""

from strandline.llm import bpe, chat, decontaminate, language, quality, secrets, sharding, simhash, token_counts, urls

QUERIES = {
    "op1_chat_formatting": chat.query,
    "op2_simhash_near_dedup": simhash.query,
    "op3_url_filters": urls.query,
    "op4_decontamination": decontaminate.query,
    "op5_language_id": language.query,
    "op6_sharding": sharding.query,
    "op7_quality_rules": quality.query,
    "op8_byte_level_bpe": bpe.query,
    "op9_secret_scans": secrets.query,
    "op10_token_counts": token_counts.query,
}
ORACLE_SQL = {
    "op1_chat_formatting": chat.ORACLE,
    "op3_url_filters": urls.ORACLE,
    "op4_decontamination": decontaminate.ORACLE,
    "op6_sharding": sharding.ORACLE,
}
