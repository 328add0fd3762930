"""The queries of this sub-package and their SQL."""

from __future__ import annotations

import functools
import os
from collections.abc import Callable

from pyspark.sql import DataFrame

from recoflow.llm import alignment, decontaminate, jaccard_join, line_dedup, maxscore, packing, preferences, quality, sharding, surrogates, toxicity, treap_search, warc

_HOME = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``query`` with this package on the path of Python workers, where no submit option put it there."""
    @functools.wraps(query)
    def run(spark, *args):
        paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
        if _HOME not in paths:
            spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([*filter(None, paths), _HOME])
        return query(spark, *args)
    return run


QUERIES = {name: importable(query) for name, query in {
    "op1_label_propagation": sharding.op1_label_propagation,
    "op2_dictionary_warc": warc.op2_dictionary_warc,
    "op3_suffix_decontamination": decontaminate.op3_suffix_decontamination,
    "op4_ftrl_toxicity": toxicity.op4_ftrl_toxicity,
    "op5_best_fit_packing": packing.op5_best_fit_packing,
    "op6_preference_pairs": preferences.op6_preference_pairs,
    "op7_line_frequency": quality.op7_line_frequency,
    "op8_divide_skip_join": jaccard_join.op8_divide_skip_join,
    "op9_line_set_join": line_dedup.op9_line_set_join,
    "op10_surrogates": surrogates.op10_surrogates,
    "op11_maxscore": maxscore.op11_maxscore,
    "op12_token_alignment": alignment.op12_token_alignment,
    "op13_treap_search": treap_search.op13_treap_search,
}.items()}
SQL = {
    "op3_suffix_decontamination": decontaminate.OP3_SQL,
    "op6_preference_pairs": preferences.OP6_SQL,
    "op7_line_frequency": quality.OP7_SQL,
    "op8_divide_skip_join": jaccard_join.OP8_SQL,
    "op9_line_set_join": line_dedup.OP9_SQL,
    "op11_maxscore": maxscore.OP11_SQL,
    "op13_treap_search": treap_search.OP13_SQL,
}
