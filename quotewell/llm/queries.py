"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import exact_dedup, line_dedup, secret_scan
from .bpe import op3_bpe
from .licenses import op8_licenses
from .line_dedup import op6_line_dedup
from .mixing import op4_mixing
from .neighbours import op11_neighbours
from .periodic import op12_periodic_runs
from .quality import op2_quality
from .secret_scan import op10_secrets
from .simhash import op9_simhash
from .substring_dedup import op5_substring_dedup
from .token_align import op13_token_align
from .url_filter import op1_url_filter
from .common import load


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of documents; texts are compared as they are, and the largest doc_id of equals stays."""
    return exact_dedup.exact_dedup(load(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_url_filter, op2_quality, op3_bpe, op4_mixing, op5_substring_dedup, op6_line_dedup, op7_exact_dedup, op8_licenses, op9_simhash, op10_secrets, op11_neighbours, op12_periodic_runs, op13_token_align)}
ORACLES = {"op6_line_dedup": line_dedup.SQL, "op7_exact_dedup": exact_dedup.SQL, "op10_secrets": secret_scan.SQL}
