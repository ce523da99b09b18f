"""The registered queries of the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from quire.llm import decontam, embeddings, fim, langid, linkgraph, mixing, ngramlm, pii, piecebpe, simhash, templates, tokenalign, toxicity
from quire.llm.common import table

QUERIES = {
    "op1_pii_feistel": lambda spark, d: pii.query(table(spark, d, "documents")),
    "op2_embedding_dedup": lambda spark, d: embeddings.near_duplicates(table(spark, d, "embeddings")),
    "op3_mixing": lambda spark, d: mixing.query(table(spark, d, "documents")),
    "op4_ngram_trie": lambda spark, d: ngramlm.query(table(spark, d, "documents")),
    "op5_decontamination": lambda spark, d: decontam.query(table(spark, d, "documents"), table(spark, d, "benchmark")),
    "op6_site_templates": lambda spark, d: templates.query(table(spark, d, "pages")),
    "op7_link_graph": lambda spark, d: linkgraph.query(table(spark, d, "pages")),
    "linked_hosts": lambda spark, d: linkgraph.linked_events(table(spark, d, "events")),
    "op8_language_id": lambda spark, d: langid.query(table(spark, d, "documents")),
    "op9_simhash": lambda spark, d: simhash.query(table(spark, d, "documents")),
    "op10_toxicity": lambda spark, d: toxicity.query(table(spark, d, "documents"), table(spark, d, "labels")),
    "op11_fill_in_middle": lambda spark, d: fim.query(table(spark, d, "documents")),
    "op12_piece_bpe": lambda spark, d: piecebpe.query(table(spark, d, "documents")),
    "op13_token_alignment": lambda spark, d: tokenalign.query(table(spark, d, "documents")),
}

ORACLE_SQL = {
    "op2_embedding_dedup": embeddings.ORACLE_SQL,
    "op3_mixing": mixing.ORACLE_SQL,
    "op5_decontamination": decontam.ORACLE_SQL,
    "op7_link_graph": linkgraph.ORACLE_SQL,
    "linked_hosts": linkgraph.LINKED_SQL,
    "op11_fill_in_middle": fim.ORACLE_SQL,
}
