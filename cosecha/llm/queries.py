"""The queries of this subpackage and, where SQL can express them, their DuckDB SQL."""

from cosecha.llm import decontamination, embedding_links, html_text, language_id, mixing, near_duplicates, passages, prefix_trie, quality, secrets, spelling, token_files, warc

QUERIES = {
    "op1_warc": warc.op1,
    "op2_decontamination": decontamination.op2,
    "op3_embedding_links": embedding_links.op3,
    "op4_near_duplicates": near_duplicates.op4,
    "op5_quality": quality.op5,
    "op6_token_files": token_files.op6,
    "op7_html_text": html_text.op7,
    "op8_language_id": language_id.op8,
    "op9_passages": passages.op9,
    "op10_mixing": mixing.op10,
    "op11_prefix_trie": prefix_trie.op11,
    "op12_secrets": secrets.op12,
    "op13_spelling": spelling.op13,
}

ORACLE_SQL = {
    "op1_warc": warc.OP1_SQL,
    "op3_embedding_links": embedding_links.OP3_SQL,
    "op4_near_duplicates": near_duplicates.OP4_SQL,
    "op10_mixing": mixing.OP10_SQL,
    "op11_prefix_trie": prefix_trie.OP11_SQL,
    "op12_secrets": secrets.OP12_SQL,
    "op13_spelling": spelling.OP13_SQL,
}
