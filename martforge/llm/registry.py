"""Registered queries of the corpus operators, and DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from martforge.llm.decontamination import op3_decontamination
from martforge.llm.jaccard_join import op7_jaccard_join
from martforge.llm.knn_quality import op9_knn_quality
from martforge.llm.packing import op2_packing
from martforge.llm.periodic_runs import op13_periodic_runs
from martforge.llm.prefix_trie import op12_prefix_trie
from martforge.llm.quality_rules import op1_quality_rules
from martforge.llm.sharding import op8_sharding
from martforge.llm.source_mix import OP11_SQL, op11_source_mix
from martforge.llm.style_tree import op10_html_extraction
from martforge.llm.token_counts import op5_token_counts
from martforge.llm.url_filter import OP4_SQL, op4_url_filter
from martforge.llm.warc import OP6_SQL, op6_warc

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_quality_rules": op1_quality_rules,
        "op2_packing": op2_packing,
        "op3_decontamination": op3_decontamination,
        "op4_url_filter": op4_url_filter,
        "op5_token_counts": op5_token_counts,
        "op6_warc": op6_warc,
        "op7_jaccard_join": op7_jaccard_join,
        "op8_sharding": op8_sharding,
        "op9_knn_quality": op9_knn_quality,
        "op10_html_extraction": op10_html_extraction,
        "op11_source_mix": op11_source_mix,
        "op12_prefix_trie": op12_prefix_trie,
        "op13_periodic_runs": op13_periodic_runs,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_url_filter": OP4_SQL,
        "op6_warc": OP6_SQL,
        "op11_source_mix": OP11_SQL,
    }
