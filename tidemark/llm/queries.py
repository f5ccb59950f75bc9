"""The registered queries of this package, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tidemark.llm import jaccard, lines, negatives, topk
from tidemark.llm.bpe import op10_bpe_encode_decode
from tidemark.llm.jaccard import op13_ngram_jaccard_join
from tidemark.llm.language import op5_language_id
from tidemark.llm.licenses import op3_license_scan
from tidemark.llm.lines import op6_line_dedup
from tidemark.llm.mixing import op2_source_mix
from tidemark.llm.negatives import op11_hard_negatives
from tidemark.llm.neighbours import op8_nearest_neighbours
from tidemark.llm.pii import op9_pii_pseudonyms
from tidemark.llm.simhash import op4_simhash_near_dedup
from tidemark.llm.topk import op7_exact_top_k
from tidemark.llm.toxicity import op1_toxicity
from tidemark.llm.whitening import op12_embedding_whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_toxicity,
        op2_source_mix,
        op3_license_scan,
        op4_simhash_near_dedup,
        op5_language_id,
        op6_line_dedup,
        op7_exact_top_k,
        op8_nearest_neighbours,
        op9_pii_pseudonyms,
        op10_bpe_encode_decode,
        op11_hard_negatives,
        op12_embedding_whitening,
        op13_ngram_jaccard_join,
    )
} | {"pipeline": corpus_pipeline.run}

ORACLES: dict[str, str] = {"op6_line_dedup": lines.ORACLE, "op7_exact_top_k": topk.ORACLE, "op11_hard_negatives": negatives.ORACLE, "op13_ngram_jaccard_join": jaccard.ORACLE}
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
