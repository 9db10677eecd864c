"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gaugelake.llm.best_two_fit import op12_best_two_fit
from gaugelake.llm.fill_in_middle import OP11_SQL, op11_displacement_fill_in_middle
from gaugelake.llm.fingerprints import op2_iblt_fingerprints
from gaugelake.llm.host_quality import OP8_SQL, op8_host_quality
from gaugelake.llm.language import op10_byte_cnn_language
from gaugelake.llm.licenses import op4_licence_sentences
from gaugelake.llm.max_sketches import OP13_SQL, op13_max_sketch_search
from gaugelake.llm.mixing import op5_cube_sampling
from gaugelake.llm.ngram_join import op1_ngram_jaccard_join
from gaugelake.llm.packing import op9_vector_packing
from gaugelake.llm.private_data import op3_semi_crf_private_data
from gaugelake.llm.secrets import op7_layered_secret_scan
from gaugelake.llm.token_files import op6_bit_packed_tokens
from gaugelake.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]


def on_workers(query: Query) -> Query:
    """The query, with this package sent to the Python workers beforehand."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {query.__name__: on_workers(query) for query in (
    op1_ngram_jaccard_join,
    op2_iblt_fingerprints,
    op3_semi_crf_private_data,
    op4_licence_sentences,
    op5_cube_sampling,
    op6_bit_packed_tokens,
    op7_layered_secret_scan,
    op8_host_quality,
    op9_vector_packing,
    op10_byte_cnn_language,
    op11_displacement_fill_in_middle,
    op12_best_two_fit,
    op13_max_sketch_search,
)}

ORACLE_SQL: dict[str, str] = {
    "op8_host_quality": OP8_SQL, "op11_displacement_fill_in_middle": OP11_SQL, "op13_max_sketch_search": OP13_SQL}
