"""The queries of this subpackage and the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import (
    bpe,
    fill_middle,
    hard_negatives,
    main_text,
    near_dup,
    neighbours,
    packing,
    quality_rules,
    suffix_dedup,
    token_counts,
    toxic_spans,
    url_filter,
    warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": bpe.op1_byte_bpe,
    "op2_url_filter": url_filter.op2_url_filter,
    "op3_warc": warc.op3_warc,
    "op4_bwt_dedup": suffix_dedup.op4_bwt_dedup,
    "op5_main_text": main_text.op5_main_text,
    "op6_cross_polytope": neighbours.op6_cross_polytope,
    "op7_minhash": near_dup.op7_minhash,
    "op8_trie_counts": token_counts.op8_trie_counts,
    "op9_concat_cut": packing.op9_concat_cut,
    "op10_decision_list": quality_rules.op10_decision_list,
    "op11_fill_middle": fill_middle.op11_fill_middle,
    "op12_crf_toxicity": toxic_spans.op12_crf_toxicity,
    "op13_threshold_negatives": hard_negatives.op13_threshold_negatives,
}

ORACLE_SQL: dict[str, str] = {
    "op11_fill_middle": fill_middle.ORACLE,
    "op13_threshold_negatives": hard_negatives.ORACLE,
    "op7_minhash": near_dup.ORACLE,
    "op3_warc": """
        with p as (
            select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes,
                sha1(coalesce(html, '')) as h
            from pages
        ), d as (
            select *, list_aggregate(list_transform(range(0, 32), lambda i: substr(
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                1 + ((('0x' || substr(h, 1 + 10 * (i // 8), 10))::bigint >> (35 - 5 * (i % 8))) & 31)::bigint, 1)),
                'string_agg', '') as payload_digest,
                max(page_id) over (partition by h) as top
            from p
        )
        select page_id, payload_bytes, payload_digest,
            case when page_id <> top then 'revisit' else 'response' end as record_type,
            case when page_id <> top then top end as refers_to
        from d
    """,
}
