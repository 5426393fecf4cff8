"""The named queries of this subpackage and the SQL that gives the same rows."""

from __future__ import annotations

from stratalake.llm import chat, decontaminate, embeddings, langid, minhash, packing, repair, substring, suffix, toxicity, trie, urls, warc

QUERIES = {
    "op1_chat_formatting": chat.op1_chat_formatting,
    "op2_decontaminate": decontaminate.op2_decontaminate,
    "op3_url_reputation": urls.op3_url_reputation,
    "op4_substring_dedup": substring.op4_substring_dedup,
    "op5_minhash_near_dedup": minhash.op5_minhash_near_dedup,
    "op6_embedding_near_dedup": embeddings.op6_embedding_near_dedup,
    "op7_suffix_array_dedup": suffix.op7_suffix_array_dedup,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_language_id": langid.op9_language_id,
    "op10_packing": packing.op10_packing,
    "op11_conversation_repair": repair.op11_conversation_repair,
    "op12_conversation_trie": trie.op12_conversation_trie,
    "op13_warc": warc.op13_warc,
}
# The others are held against brute force, held-out labels or a round trip in tests/llm; SQL for op7 would
# hold every 100-byte string of the table at once.
ORACLE = {
    "op1_chat_formatting": chat.ORACLE,
    "op3_url_reputation": urls.ORACLE,
    "op4_substring_dedup": substring.ORACLE,
    "op5_minhash_near_dedup": minhash.ORACLE,
    "op6_embedding_near_dedup": embeddings.ORACLE,
    "op11_conversation_repair": repair.ORACLE,
    "op12_conversation_trie": trie.ORACLE,
    "op13_warc": warc.ORACLE,
}
