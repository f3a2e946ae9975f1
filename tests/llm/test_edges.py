"""Nulls in any column, empty and long texts, repeated rows, empty tables, clashing extra columns: a defined result, no crash."""

from __future__ import annotations

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from acreage.llm import bpe, chat, chosen_path, decontam, langid, line_dedup, quality, queries, secrets, url_filter
from acreage.llm.exact_dedup import exact_dedup

LONG = "lorem ipsum dolor " * 20_000 + "x" * 50_000
ROWS = [
    (1, "a line\nb line of words", "en"), (1, "a line\nb line of words", "en"), (2, "", None), (3, None, "de"),
    (None, "no id here", "de"), (None, None, None), (4, LONG, "en"), (5, " \n\t ", "fr"), (6, "123 456", "fr"),
    (7, "eine zeile", "de")
]
CLASHES = {
    "id": 9, "slot": 8, "path": "p", "kept": "k", "place": 7, "k1": 1, "size": 3, "n": 2, "host": "h", "hit": "x", "sha": "s",
    "_id": 4, "_worded": "w", "root": 5, "grade": 6, "word": "y", "found": "z"
}


def docs(spark, rows=ROWS):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return df.withColumns({k: F.lit(v) for k, v in CLASHES.items()}).withColumns(
        {"source": F.lit("s"), "n_chars": F.length("text").cast("long")}
    )


def bench(spark, rows=((1, "zzz yyy xxx www"), (None, "a line"), (2, None), (3, ""))):
    return spark.createDataFrame(list(rows), "item_id long, text string")


def ratings(spark):
    return spark.createDataFrame([(1, 2), (4, 0), (7, 1), (None, 1), (6, None), (99, 0)], "id long, grade int")


RUNS = {
    "quality": lambda s, d: quality.score_quality(d, ratings(s)),
    "lines": lambda s, d: line_dedup.dedup_lines(d),
    "bpe": lambda s, d: bpe.encode_decode(d, public_tokenizers.path("byte_bpe_50k.json")),
    "decontam": lambda s, d: decontam.decontaminate(d, bench(s)),
    "secrets": lambda s, d: secrets.scan_secrets(d),
    "langid": lambda s, d: langid.identify_languages(d),
    "exact": lambda s, d: exact_dedup(d),
    "jaccard": lambda s, d: chosen_path.jaccard_classes(d),
}


@pytest.mark.parametrize("name", RUNS)
def test_every_row_gets_a_result(name, spark):
    got = RUNS[name](spark, docs(spark)).collect()
    assert len(got) == len(ROWS)
    same = [str(r) for r in got if r.doc_id == 1]
    assert len(same) == 2 and same[0] == same[1]


@pytest.mark.parametrize("name", RUNS)
def test_empty_table(name, spark):
    assert RUNS[name](spark, docs(spark, [])).collect() == []


def test_quality_without_two_grades_keeps_nothing(spark):
    few = ratings(spark).where("id = 1")
    assert [
        (r.expected_grade, r.tail, r.kept) for r in quality.score_quality(docs(spark), few).collect()
    ] == [(None, None, False)] * len(ROWS)
    assert quality.keep_quality(
        docs(spark), few.limit(0)
    ).collect() == [] and quality.keep_quality(docs(spark, []), few).collect() == []
    assert line_dedup.drop_lines(docs(spark, [])).collect() == [] and decontam.drop_contaminated(
        docs(spark, []), bench(spark)
    ).collect() == []


def test_defined_results(spark):
    d = docs(spark)
    q = {r.doc_id: r for r in RUNS["quality"](spark, d).collect()}
    assert not q[2].kept and q[3].tail == 0 and not q[5].kept
    lang = {r.doc_id: r for r in RUNS["langid"](spark, d).collect()}
    assert lang[2].lang_pred == lang[3].lang_pred == lang[6].lang_pred == "und" and lang[3].score == 0
    lines = {r.doc_id: r for r in RUNS["lines"](spark, d).collect()}
    assert lines[3].n_lines == 0 and lines[2].n_lines == 1 and lines[None].n_removed == 0 and lines[1].removed == ""
    near = RUNS["jaccard"](spark, d).collect()
    assert all(r.kept and r.n_links == 0 for r in near)
    assert all(not r.contaminated for r in RUNS["decontam"](spark, d).collect())
    assert all(not r.contaminated for r in decontam.decontaminate(d, bench(spark, [])).collect())


def test_any_id_and_many_lines(spark):
    rows = [
        (-(1 << 63), "a\nc", "en"), ((1 << 63) - 1, "a\nd e", "en"), (7, "x\n" * (1 << 21) + "b", "en"), (8, "b\nx", "en"),
        (9, "a", "en"), (9, "z\nq", "en")
    ]
    got = {(r.doc_id, r.n_lines): (r.n_removed, r.removed[:9]) for r in line_dedup.dedup_lines(docs(spark, rows)).collect()}
    assert got == {
        (-(1 << 63), 2): (0, ""), ((1 << 63) - 1, 2): (1, "0"), (7, (1 << 21) + 1): ((1 << 21) - 1, "1,2,3,4,5"),
        (8, 2): (2, "0,1"), (9, 1): (0, ""), (9, 2): (0, "")
    }


def test_filters_keep_all_columns(spark):
    d = docs(spark)
    for out in (
        quality.keep_quality(d, ratings(spark), least_tail=0.0), line_dedup.drop_lines(d),
        decontam.drop_contaminated(d, bench(spark))
    ):
        assert out.columns == d.columns and out.count() >= 1


def test_a_document_without_own_lines_goes(spark):
    rows = [
        (1, "one two three\nfour five six", "en"), (2, "four five six", "en"), (3, "\n\n", "en"),
        (4, "one two three\nseven eight", "en")
    ]
    assert {
        r.doc_id: r.text for r in line_dedup.drop_lines(docs(spark, rows)).collect()
    } == {1: rows[0][1], 3: "\n\n", 4: "seven eight"}


def test_pages_and_chats(spark):
    pages = spark.createDataFrame(
        [
            (1, "http://a.com/en/", None), (1, "http://a.com/en/", None), (None, None, None), (2, "", "<a href=http://b.org>"),
            (3, "http://", LONG)
        ],
        "page_id long, url string, html string"
    ).withColumns({k: F.lit(v) for k, v in CLASHES.items()})
    assert url_filter.filter_urls(pages, queries.URL_RULES).count() == 5
    assert url_filter.filter_urls(pages.limit(0), queries.URL_RULES).count() == 0
    chats = spark.createDataFrame(
        [
            (1, 0, "user", LONG), (1, 0, "user", LONG), (None, 1, "user", "x"), (1, None, "user", "x"), (1, 1, None, "x"),
            (1, 2, "assistant", None), (1, 3, "user", '{"tool_calls": 5}'), (1, 4, "user", "{broken")
        ],
        "conv_id long, turn long, role string, text string"
    ).withColumns({k: F.lit(v) for k, v in CLASHES.items()})
    got = {r.id: r.status for r in chat.format_chats(chats, queries.REPLY_SCHEMA).collect()}
    assert got == {"t0": "ambiguous", "t1": "orphan", "t3": "unanswered", "t4": "unanswered"}
    assert chat.format_chats(chats.limit(0), queries.REPLY_SCHEMA).count() == 0


def test_columns_of_any_name_stay(spark):
    names = ["_line_id", "_line_kept", "row", "gone", "worded", "id", "kept"]
    d = spark.createDataFrame(
        [(1, "a b c\nd", *names), (2, "a b c", *names)],
        ", ".join(["doc_id long", "text string", *[f"{n} string" for n in names]])
    )
    got = line_dedup.drop_lines(d).collect()
    assert [tuple(r) for r in got] == [(1, "a b c\nd", *names)]


def test_languages_of_hot_and_repeated_ids(spark):
    rows = [(5, "das ist ein satz", "de")] * 3000 + [
        (k, f"this is sentence {k}", "en") for k in range(2000)
    ] + [(9000, "x" * 300_000, "en"), (None, "niemand", "de")]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    known = d.selectExpr("doc_id as id", "lang", "text").where("id is not null")
    got = langid.sample_of(known, 50).groupBy("lang").count().collect()
    assert {r.lang: r["count"] for r in got} == {"de": 1, "en": 50}
    out = langid.identify_languages(d, per_language=50)
    assert out.count() == len(rows) and out.where("doc_id = 5").select("lang_pred", "score").distinct().count() == 1


def test_no_shared_folder_on_a_cluster_is_an_error(spark, monkeypatch):
    from types import SimpleNamespace

    from acreage.llm import scratch

    conf = SimpleNamespace(get=lambda *_: None)
    cluster = SimpleNamespace(
        conf=conf, sparkContext=SimpleNamespace(applicationId="a-cluster", master="yarn", getConf=lambda: conf)
    )
    with pytest.raises(ValueError, match="checkpoint.dir"):
        scratch.shared_dir(cluster)


def test_empty_pipeline(spark, tmp_path):
    import corpus_pipeline as p

    sf = "/root/testdata/sf0.001"
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{sf}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert p.run(spark, str(tmp_path)).collect() == []


def test_pipeline_stages(spark):
    """Every stage's result is what its operator decides on what the stage before it kept."""
    import corpus_pipeline as p

    sf = "/root/testdata/sf0.001"
    raw = spark.read.parquet(f"{sf}/documents.parquet")
    d1 = p.quality(spark, raw, sf)
    scored = {r.doc_id for r in queries.op1_ordinal_quality(spark, sf).where("kept").collect()}
    assert {r.doc_id for r in d1.select("doc_id").collect()} == scored
    d2 = p.lines(spark, d1, sf)
    assert d2.columns == raw.columns
    want = {r.doc_id for r in line_dedup.dedup_lines(d1).collect()}
    kept2 = {r.doc_id: r for r in d2.collect()}
    assert set(kept2) <= want and all(r.n_chars == len(r.text) for r in kept2.values())
    seen = set()
    for i in sorted(kept2):
        own = {line for line in kept2[i].text.split("\n") if line.strip()}
        assert not own & seen
        seen |= own
    out = p.run(spark, sf).collect()
    assert len({r.doc_id for r in out}) == len(out) and {r.doc_id for r in out} <= set(kept2)
    assert [n for n, _ in p.STAGES] == ["quality", "lines", "near_duplicates", "decontamination", "tokens"]
