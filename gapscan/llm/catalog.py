"""The queries of the document operators and of the pipeline."""

from __future__ import annotations

import corpus_pipeline
from gapscan.llm.conversations import op13_repair
from gapscan.llm.fingerprints import op1_fingerprints
from gapscan.llm.line_dedup import op4_line_dedup
from gapscan.llm.mixing import op5_mix
from gapscan.llm.oracle import OP3_SQL, OP9_SQL, OP11_SQL, OP13_SQL
from gapscan.llm.packing import op10_pack
from gapscan.llm.pii import op2_pii
from gapscan.llm.quality import op3_quality
from gapscan.llm.simhash import op6_simhash
from gapscan.llm.spelling import op11_spelling
from gapscan.llm.token_files import op8_token_files
from gapscan.llm.topk import OP12_SQL, op12_topk
from gapscan.llm.toxicity import op7_toxicity
from gapscan.llm.warc import op9_warc

QUERIES = {f.__name__: f for f in (
    op1_fingerprints, op2_pii, op3_quality, op4_line_dedup, op5_mix, op6_simhash, op7_toxicity,
    op8_token_files, op9_warc, op10_pack, op11_spelling, op12_topk, op13_repair)}
QUERIES["pipeline"] = corpus_pipeline.run

# DuckDB SQL for the queries that it can express.
SQL: dict[str, str] = {"op3_quality": OP3_SQL, "op9_warc": OP9_SQL, "op11_spelling": OP11_SQL,
                       "op12_topk": OP12_SQL, "op13_repair": OP13_SQL}
if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
