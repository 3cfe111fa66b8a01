"""All queries of this subpackage and of the pipeline, and the SQL that checks them."""

import corpus_pipeline
from tillwright.llm import oracle, queries

QUERIES = {**queries.QUERIES, "pipeline": corpus_pipeline.run}
ORACLE = dict(oracle.ORACLE)
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
