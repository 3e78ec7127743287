"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns, for every operator and stage."""

import math

import pytest

import corpus_pipeline
from tripwise.llm import ann, quality, url_rules, warc
from tripwise.llm.queries import QUERIES

LONG = "alpha beta gamma delta " * 20_000
ODD = [
    (1, "same words in this line here and more of them\nother line", "en", "a"),
    (1, "same words in this line here and more of them\nother line", "en", "a"),
    (2, "same words in this line here and more of them\nother line", None, None),
    (3, None, "en", "a"), (4, "", "en", None), (5, " \n\t \n", None, "b"), (6, LONG, "en", "a"),
    (None, "a row without an id password = abcdef123456", "en", "a"), (7, "THE!! the ▁ mark 😀", "fr", "b"),
]


@pytest.fixture(scope="module", params=["odd", "empty"])
def folder(request, spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))

    def write(name, rows, schema, *extra):
        rows = rows if request.param == "odd" else []
        df = spark.createDataFrame(rows, schema)
        for column in extra:  # columns whose names clash with the operators' own
            df = df.selectExpr("*", f"'x' AS {column}")
        df.write.parquet(f"{path}/{name}.parquet")

    write("documents", [(*r, None if r[1] is None else len(r[1])) for r in ODD], "doc_id long, text string, lang string, source string, n_chars long",
          "key", "size", "words", "line", "n_words", "component_id", "score", "id", "qc_score", "LD_removed", "dc_text", "dc_words")
    write("labels", [(1, 1, 0), (1, 0, 1), (2, 1, None), (3, None, None), (None, 1, 1), (99, 0, 0)], "doc_id long, quality int, toxic int", "score")
    write("benchmark", [(1, "other line"), (2, None), (3, ""), (4, "of them other line"), (None, "the mark")], "item_id long, text string", "doc_id")
    write("pages", [(1, "http://a.net/x", "<p>" + "a" * 200), (2, None, "<p>" + "a" * 200), (2, "https://Ex.example.com/de/1", None), (3, "nohost", ""),
                    (4, "x://y z\r\nWARC/1.0", "WARC/1.0\r\nContent-Length: 5\r\n\r\n" * 9), (None, "a://b", "q")], "page_id long, url string, html string", "digest")
    nan = float("nan")
    write("embeddings", [(0, [1.0, 0.0], 0), (0, [1.0, 0.0], 0), (50, [0.0, 1.0], 0), (1, [1.0, 1.0], 0), (2, [1.0, 1.0], 0), (3, None, 0), (4, [0.0, 0.0], 0),
                         (5, [nan, 1.0], 0), (6, [math.inf, 1.0], 0), (7, [None, 1.0], 0), (None, [1.0, 2.0], 0), (8, [1.0, 2.0, 3.0], 0), (100, [], 0)],
          "vec_id long, embedding array<float>, label int", "id")
    return request.param, path



@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_gives_a_row_per_row(spark, folder, name):
    kind, path = folder
    rows = QUERIES[name](spark, path).collect()
    if kind == "empty":
        assert rows == []
    elif name.startswith("op13_"):  # only phrases of the long text occur 30 times; 12 words twice, 8 and 80,000 are English
        assert {(r.lang, r.n) for r in rows} == {("en", 80_032)} and {r.a for r in rows} == {20_000, 19_999}
    elif name.startswith("op6_"):
        assert {(r.query_id, r.rank, r.vec_id) for r in rows} == {(0, 1, 1), (0, 2, 2), (0, 3, 50), (50, 1, 1), (50, 2, 2), (50, 3, 0), (50, 4, 0)}
    else:
        assert len(rows) == (6 if int(name[2:].split("_")[0]) in (4, 8) else len(ODD))


def test_documents_of_the_odd_table(spark, folder):
    kind, path = folder
    if kind == "empty":
        return
    by = lambda name: {r.doc_id: r for r in QUERIES[name](spark, path).collect()}
    lines = by("op2_line_dedup")
    assert lines[1].removed_lines == "" and lines[2].removed_lines == "0,1" and lines[3].n_lines == 0 and lines[5].n_removed == 0
    joined = by("op7_ngram_join")
    assert joined[2].component_id == 1 and joined[3].n_shingles == joined[4].n_shingles == 0 and joined[None].component_id is None
    hits = by("op3_decontamination")
    assert hits[1].n_hit == 4 and hits[1].contaminated and hits[1].n_items == 2 and hits[3].n_words == 0 and not hits[6].contaminated
    assert by("op9_secret_scan")[None].spans == "assign:20:43"
    counts = by("op11_token_counts")
    assert counts[3].n_tokens == counts[4].n_tokens == counts[3].n_bytes == 0 and counts[6].over_limit and counts[6].n_bytes == len(LONG)
    drawn = by("op12_importance_resampling")
    assert drawn[3].n_features == 0 and drawn[3].weight == 0 and drawn[6].n_features == 80_000 and drawn[None].n_features == 7
    assert [i for i, r in drawn.items() if r.rank is not None] == []  # a tenth of the few rows of 20 words is none
    tokens = by("op10_sentencepiece")
    assert tokens[3].tokens is None and tokens[4].tokens == [] and tokens[6].round_trip and not tokens[7].round_trip
    pages = {r.page_id: r for r in QUERIES["op4_warc"](spark, path).collect()}
    assert pages[1].record_type == "response" and pages[4].payload_bytes == 279
    revisits = [r for r in QUERIES["op4_warc"](spark, path).collect() if r.record_type == "revisit"]
    assert [(r.page_id, r.refers_to) for r in revisits] == [(2, 1)]


def test_pipeline_stages(spark, folder):
    kind, path = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, path)
        assert out.columns == docs.columns
        assert out.count() <= docs.count()
    assert corpus_pipeline.run(spark, path).count() <= docs.count()
    assert [name for name, _ in corpus_pipeline.STAGES] and corpus_pipeline.ORACLE_SQL is None


def test_null_page_ids_revisit_the_smallest_id(spark, tmp_path):
    big, other = "a" * 200, "b" * 200
    rows = [(1, big), (None, big), (7, big), (None, other), (None, other), (3, "s"), (None, "s")]
    spark.createDataFrame([(i, "http://h/x", t) for i, t in rows], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted((str(r.page_id), r.payload_bytes, r.record_type, r.refers_to) for r in QUERIES["op4_warc"](spark, str(tmp_path)).collect())
    assert got == sorted([("1", 200, "response", None), ("None", 200, "revisit", 1), ("7", 200, "revisit", 1), ("None", 200, "response", None),
                          ("None", 200, "response", None), ("3", 1, "response", None), ("None", 1, "response", None)])


def test_repeated_labelled_ids_are_collected_once(spark):
    docs = spark.createDataFrame([(i % 4 + 1, f"text number {i} of some words") for i in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, 0), (4, 1)], "doc_id long, quality int")
    seen = []
    whole, quality.fit = quality.fit, lambda rows, marks: seen.append(len(rows)) or whole(rows, marks)
    try:
        quality.train(docs, labels, max_train=3)
    finally:
        quality.fit = whole
    assert seen[0] <= 3


def test_reader_rejects_magic_inside_payloads_and_broken_chains(spark, tmp_path):
    fake = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\n"
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"{i} " + fake * 40) for i in range(30)], "page_id long, url string, html string")
    warc.write_archives(pages.coalesce(1), f"{tmp_path}/w", records_per_file=20)
    got = {r.page_id: r.payload.decode() for r in warc.read_archives(spark, f"{tmp_path}/w", block=4096).collect()}
    assert got == {str(i): f"{i} " + fake * 40 for i in range(30)}
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "a.warc").write_bytes(b"WARC/1.0\r\nContent-Length: 900\r\n\r\nabc")
    with pytest.raises(Exception, match="chain of records breaks"):
        warc.read_archives(spark, f"{tmp_path}/broken").collect()


def test_reader_takes_long_headers_across_block_ends(spark, tmp_path):
    urls = {str(i): u for i, u in enumerate(["http://h/" + "a" * 70_000, "http://h/" + "é" * 30_000, "http://h/" + "b" * 300_000, "http://h/c"])}
    pages = spark.createDataFrame([(int(i), u, f"page {i}") for i, u in urls.items()], "page_id long, url string, html string")
    warc.write_archives(pages.coalesce(1), f"{tmp_path}/w")
    for block in (4096, 100_000):
        got = {r.page_id: r.payload.decode() for r in warc.read_archives(spark, f"{tmp_path}/w", block=block).collect()}
        assert got == {i: f"page {i}" for i in urls}


def test_search_in_several_blocks_is_the_same(spark):
    rows = [(i, [float((i * 37) % 11) - 5, float((i * 17) % 7) - 3, 1.0]) for i in range(300)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    queries = vectors.where("vec_id % 50 = 0")
    one = ann.search(vectors, queries).orderBy("query_id", "rank").collect()
    many = ann.search(vectors, queries, block_bytes=200).orderBy("query_id", "rank").collect()
    assert one == many and len(one) == 30


def test_mined_rules_block_what_the_labels_follow(spark):
    keys = "&".join(f"k{i}=1" for i in range(30))  # thirty tokens of the same baskets
    urls = [(i, f"https://h{i % 7}.test/{'spam' if i % 4 == 1 else 'news'}/{i}" + (f"?{keys}" if i % 12 == 0 else "")) for i in range(600)]
    more = [(1000, "https://x.test/a/spam/b"), (1001, "https://x.test/news/b"), (1002, "https://x.test/zz?k7=2"), (1003, None)]
    pages = url_rules.parsed(spark.createDataFrame(urls + more, "page_id long, url string"))
    bad = {i for i in range(600) if i % 4 == 1 or i % 12 == 0}  # a third, too few for a rule of what all pages share
    labels = spark.createDataFrame([(i, 0 if i in bad else 1, 0) for i in range(600)], "doc_id long, quality int, toxic int")
    rules = url_rules.mine(pages, labels)
    got = {r.page_id: r.url_verdict for r in url_rules.judge(pages, rules).collect()}
    assert all(got[i] == ("block" if i in bad else "allow") for i in range(600))
    assert [got[i] for i in range(1000, 1004)] == ["block", "allow", "block", "allow"]
    groups = {frozenset(t) for r in rules.collect() for t in r.tokens}
    assert frozenset(f"query=k{i}" for i in range(30)) in groups and frozenset(["path=spam"]) in groups
