"""One query for each operator, over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acreage.llm.bpe import encode_decode, token_digests
from acreage.llm.chat import format_chats
from acreage.llm.chosen_path import jaccard_classes
from acreage.llm.decontam import decontaminate
from acreage.llm.exact_dedup import exact_dedup
from acreage.llm.langid import identify_languages
from acreage.llm.line_dedup import dedup_lines
from acreage.llm.quality import grade_of, score_quality
from acreage.llm.secrets import scan_secrets
from acreage.llm.url_filter import filter_urls

URL_RULES = [
    ("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"),
    ("block", "org/es/")
]
REPLY_SCHEMA = {"reply": {"query": {"type": "string", "required": True, "min_length": 1}}}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), grade_of(table(spark, sf_dir, "labels")))


def op2_line_set_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents"))


def op3_lexicon_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")))


def op4_qgram_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_secret_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans", "n_linked"
    )


def op6_tool_call_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = format_chats(table(spark, sf_dir, "conversations"), REPLY_SCHEMA)
    return found.select(
        F.col("conv").alias("conv_id"), F.col("id").alias("call_id"), "name", "turn", "depth", "status",
        F.array_join("faults", "; ").alias("faults"), "json"
    )


def op7_kneser_ney_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(table(spark, sf_dir, "documents"))


def op8_exact_tree_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op9_chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(table(spark, sf_dir, "documents"))


def op10_host_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


QUERIES = {
    "op1_ordinal_quality": op1_ordinal_quality,
    "op2_line_set_join": op2_line_set_join,
    "op3_lexicon_bpe": op3_lexicon_bpe,
    "op4_qgram_decontamination": op4_qgram_decontamination,
    "op5_secret_links": op5_secret_links,
    "op6_tool_call_links": op6_tool_call_links,
    "op7_kneser_ney_langid": op7_kneser_ney_langid,
    "op8_exact_tree_merge": op8_exact_tree_merge,
    "op9_chosen_path_join": op9_chosen_path_join,
    "op10_host_trust": op10_host_trust,
}

ORACLES = {
    "op2_line_set_join": r"""
        with l as (
                 select doc_id, cast(i - 1 as bigint) as n, string_split(text, chr(10))[i] as line
                 from documents, unnest(range(1, len(string_split(text, chr(10))) + 1)) as u(i)),
             t as (
                 select doc_id, n, doc_id * 2097152 + n as place,
                        list_sort(list_distinct(list_filter(regexp_split_to_array(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0b\f\r]+'), lambda w: w <> ''))) as s
                 from l),
             d as (select s, min(place) as place, len(s) as size from t where len(s) > 0 group by s),
             m as (
                 select distinct b.place
                 from d a join d b on a.place < b.place and a.size * 5 >= b.size * 4 and b.size * 5 >= a.size * 4
                 where len(list_intersect(a.s, b.s)) * 9 >= 4 * (a.size + b.size)),
             gone as (
                 select t.doc_id, t.n from t join d on t.s = d.s left join m on d.place = m.place
                 where len(t.s) > 0 and (t.place > d.place or m.place is not null))
        select x.doc_id, len(string_split(x.text, chr(10))) as n_lines, count(g.n) as n_removed,
               coalesce(string_agg(cast(g.n as varchar), ',' order by g.n), '') as removed
        from documents x left join gone g on x.doc_id = g.doc_id group by x.doc_id, x.text
    """,
    "op6_tool_call_links": """
        with q as (select conv_id, turn, text from conversations where role = 'user'),
             a as (select conv_id, turn - 1 as turn, turn as at, coalesce(text, '') as text from conversations where role = 'assistant'),
             j as (
                 select coalesce(q.conv_id, a.conv_id) as conv_id, 't' || coalesce(q.turn, a.turn) as call_id,
                        case when q.conv_id is not null then 'reply' end as name, coalesce(q.turn, a.at) as turn,
                        case when q.conv_id is not null then 0 end as depth,
                        case when q.conv_id is null then 'orphan' when coalesce(q.text, '') = '' then 'invalid' when a.conv_id is null then 'unanswered' else 'ok' end as status,
                        case when q.conv_id is not null and coalesce(q.text, '') = '' then 'query is too short' else '' end as faults,
                        case when q.conv_id is null then '""' else '{"query":' || to_json(coalesce(q.text, ''))::varchar || '}' end as arguments,
                        case when a.conv_id is null then 'null' else to_json(a.text)::varchar end as result
                 from q full join a on q.conv_id = a.conv_id and q.turn = a.turn)
        select conv_id, call_id, name, turn, depth, status, faults,
               '{"arguments":' || arguments || ',"call_id":"' || call_id || '","name":"' || coalesce(name, '') || '","result":' || result || ',"status":"' || status || '"}' as json
        from j
    """,
    "op8_exact_tree_merge": """
        with n as (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents)
        select doc_id, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
               doc_id = max(doc_id) over (partition by t) as kept, sha256(t) as text_sha256
        from n
    """,
}
