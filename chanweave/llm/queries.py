"""The registered queries of the training-data operators and the SQL of those that SQL can express."""

from __future__ import annotations

from . import ann, collocations, conversations, embedding_dedup, exact_dedup, jaccard, langid, line_dedup, mixing, packing, pii, secrets, sharding

QUERIES = {
    "op1_packing": packing.op1_packing,
    "op2_langid": langid.op2_langid,
    "op3_ann": ann.op3_ann,
    "op4_pii": pii.op4_pii,
    "op5_exact_dedup": exact_dedup.op5_exact_dedup,
    "op6_sharding": sharding.op6_sharding,
    "op7_line_dedup": line_dedup.op7_line_dedup,
    "op8_secrets": secrets.op8_secrets,
    "op9_jaccard_join": jaccard.op9_jaccard_join,
    "op10_mixing": mixing.op10_mixing,
    "op11_conversation_repair": conversations.op11_conversation_repair,
    "op12_embedding_dedup": embedding_dedup.op12_embedding_dedup,
    "op13_collocations": collocations.op13_collocations,
}

ORACLES = {
    "op5_exact_dedup": exact_dedup.ORACLE_SQL,
    "op8_secrets": secrets.ORACLE_SQL,
    "op9_jaccard_join": jaccard.ORACLE_SQL,
    "op10_mixing": mixing.ORACLE_SQL,
    "op11_conversation_repair": conversations.ORACLE_SQL,
    "op12_embedding_dedup": embedding_dedup.ORACLE_SQL,
    "op13_collocations": collocations.ORACLE_SQL,
}
