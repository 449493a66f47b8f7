"""The subpackage's queries and their SQL, gathered for the entry module."""

from __future__ import annotations

from terrace.llm import ann, bpe, chat, kdtree, langid, mixing, quality, simhash, substring, token_file

QUERIES = {
    "op1_mix_sources": mixing.op1_mix_sources,
    "op2_substring_dedup": substring.op2_substring_dedup,
    "op3_token_files": token_file.op3_token_files,
    "op4_language_id": langid.op4_language_id,
    "op5_ann": ann.op5_ann,
    "op6_simhash": simhash.op6_simhash,
    "op7_byte_bpe": bpe.op7_byte_bpe,
    "op8_exact_topk": kdtree.op8_exact_topk,
    "op9_quality": quality.op9_quality,
    "op10_chat": chat.op10_chat,
}
ORACLE_SQL = {"op1_mix_sources": mixing.OP1_SQL, "op8_exact_topk": kdtree.OP8_SQL, "op10_chat": chat.OP10_SQL}
