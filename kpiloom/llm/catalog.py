"""The registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from kpiloom.llm import divergence, embeddings, labeller, lines, minhash, mixing, phrases, pieces, repeats, search, toxicity, urls, warc
from kpiloom.llm.common import ship

Query = Callable[[SparkSession, str], DataFrame]


def shipped(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


_OWN: dict[str, Query] = {
    "op1_mixing": mixing.query,
    "op2_warc": warc.query,
    "op3_vantage_trees": search.query,
    "op4_minhash": minhash.query,
    "op5_html_text": labeller.query,
    "op6_embedding_dedup": embeddings.query,
    "op7_substring_dedup": repeats.query,
    "op8_sentencepiece": pieces.query,
    "op9_toxicity": toxicity.query,
    "op10_line_dedup": lines.query,
    "op11_source_divergence": divergence.query,
    "op12_url_filter": urls.query,
    "op13_collocations": phrases.query,
}
QUERIES = {name: shipped(query) for name, query in _OWN.items()}
ORACLE_SQL: dict[str, str] = {
    "op1_mixing": mixing.SQL,
    "op2_warc": warc.SQL,
    "op7_substring_dedup": repeats.SQL,
    "op11_source_divergence": divergence.SQL,
    "op12_url_filter": urls.SQL,
    "op13_collocations": phrases.SQL,
}
