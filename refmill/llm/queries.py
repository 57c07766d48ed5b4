"""The queries of the numbered operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import ann, bpe, centroids, chat, idfiles, langid, packing, pivots, quality, repair, simhash, urls, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        quality.op1_weak_label_quality,
        bpe.op2_bpe_tree_concatenation,
        urls.op3_path_template_tree,
        packing.op4_best_fit_packing,
        warc.op5_merkle_fixity,
        chat.op6_snapshot_collapse,
        ann.op7_block_matrix_join,
        pivots.op8_pivot_distance,
        simhash.op9_gray_simhash,
        langid.op10_ftrl_language,
        idfiles.op11_mixing_range_coder,
        centroids.op12_ns_bounds_centroids,
        repair.op13_run_length_repair,
    )
}

ORACLES: dict[str, str] = {
    "op5_merkle_fixity": warc.OP5_SQL,
    "op6_snapshot_collapse": chat.OP6_SQL,
    "op12_ns_bounds_centroids": centroids.OP12_SQL,
}
