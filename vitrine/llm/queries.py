"""Registry of the corpus queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vitrine.llm import anchors, brown, covertree, decontaminate, licenses, linehash, mixing, quality, simhash, suffixes, trie, warc, whiten


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    return {
        "pipeline": corpus_pipeline.run,
        "op1_mix": mixing.op1_mix,
        "op2_simhash": simhash.op2_simhash,
        "op3_cover_tree": covertree.op3_cover_tree,
        "op4_brown": brown.op4_brown,
        "op5_suffixes": suffixes.op5_suffixes,
        "op6_licenses": licenses.op6_licenses,
        "op7_quality": quality.op7_quality,
        "op8_warc": warc.op8_warc,
        "op9_anchors": anchors.op9_anchors,
        "op10_decontaminate": decontaminate.op10_decontaminate,
        "op11_whiten": whiten.op11_whiten,
        "op12_trie": trie.op12_trie,
        "op13_lines": linehash.op13_lines,
    }


def llm_sql() -> dict[str, str]:
    import corpus_pipeline

    found = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return found | {
        "op1_mix": mixing.OP1_SQL,
        "op3_cover_tree": covertree.OP3_SQL,
        "op5_suffixes": suffixes.OP5_SQL,
        "op6_licenses": licenses.OP6_SQL,
        "op8_warc": warc.OP8_SQL,
        "op9_anchors": anchors.OP9_SQL,
        "op12_trie": trie.OP12_SQL,
        "op13_lines": linehash.OP13_SQL,
    }
