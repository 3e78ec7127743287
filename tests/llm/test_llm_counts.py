"""Token counts, importance resampling and collocations against the public library and brute force."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st

import public_tokenizers
from tripwise.llm import collocations, importance, token_counts

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


# ------------------------------------------------------------------------------------------------ token counts
def test_token_counts_are_the_librarys(spark, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()}
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.op11_token_counts(spark, SF_SMALL).collect()}
    want = {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in texts.items()}
    assert got == {i: (len(texts[i].encode()), n, n > 512) for i, n in want.items()}


def test_special_strings_count_as_the_librarys_default(spark, scratch, library):
    texts = ["a<|endoftext|>b", "<|endoftext|><|endoftext|>", " <|endoftext|> ", "<|endof text|>", "it's  we'll\n\n 123 ١٢"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs, scratch).collect()}
    assert got == {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}


def test_only_what_the_cache_lacks_is_encoded(spark, scratch):
    first = spark.createDataFrame([(1, "one text"), (2, "another text"), (3, None), (4, "one text")], "doc_id int, text string")
    more = first.unionByName(spark.createDataFrame([(5, "a third text"), (6, "a third text")], first.schema))
    model = token_counts.Tokenizer(token_counts.MODEL)

    def rows():
        return spark.read.parquet(token_counts.cache_path(scratch, model)).count()

    token_counts.token_counts(first, scratch).count()
    assert rows() == 3
    token_counts.token_counts(first, scratch).count()
    assert rows() == 3
    got = {r.doc_id: r.n_tokens for r in token_counts.token_counts(more, scratch).collect()}
    assert rows() == 4 and got[5] == got[6] == 3 and got[1] == got[4] == 2 and got[3] == 0
    # counts are taken from the cache, not made again
    other = token_counts.Tokenizer(public_tokenizers.path("piece_bpe_32k.model"))
    digests = first.select(token_counts.content_digest("text").alias("digest")).distinct()
    digests.selectExpr("digest", "77L AS n_tokens").write.parquet(token_counts.cache_path(scratch, other))
    found = token_counts.token_counts(first, scratch, model=public_tokenizers.path("piece_bpe_32k.model")).collect()
    assert {r.n_tokens for r in found} == {77}


def test_another_library_and_clashing_columns(spark, scratch):
    import sentencepiece
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    docs = spark.createDataFrame([(i, f"word {i} Über", i % 3) for i in range(50)], "doc_id int, text string, digest int")
    docs = docs.selectExpr("*", "1 AS n_tokens", "2 AS copies", "3 AS hot_tokens")
    got = token_counts.token_counts(docs, scratch, ("doc_id", "digest", "n_tokens", "copies", "hot_tokens"), model=path).collect()
    assert {(r.doc_id, r.digest, r.copies, r.hot_tokens, r.n_tokens) for r in got} == {
        (i, i % 3, 2, 3, len(model.encode(f"word {i} Über"))) for i in range(50)}


def test_a_text_held_by_most_rows(spark, scratch):
    docs = spark.range(5000).selectExpr("id AS doc_id", "if(id % 3 > 0, 'the same text', concat('text ', id)) AS text")
    got = token_counts.token_counts(docs, scratch)
    assert got.count() == 5000 and got.where("doc_id % 3 > 0").select("n_tokens").distinct().count() == 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["ab", " cd", "  ", "\n", " x", "Zé", " 1", "'s", " 's", "!", "<|endoftext|>", "你"]), min_size=1, max_size=60))
def test_parts_of_long_texts_add_up(library, pieces):
    text = "".join(pieces)
    token_counts.STRETCH, kept = 5, token_counts.STRETCH
    try:
        parts = list(token_counts.parts(text, True))
        assert "".join(parts) == text
        assert token_counts.Tokenizer(token_counts.MODEL).may_cut()
        assert sum(len(library.encode(p, add_special_tokens=False).ids) for p in parts) == len(library.encode(text, add_special_tokens=False).ids)
    finally:
        token_counts.STRETCH = kept


# ------------------------------------------------------------------------------------------------ resampling
def _resampled(docs, target, ngram=1, buckets=10_000, least=20, percent=10):
    def feats(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII_LOWER))
        runs = [" ".join(words[i:i + n]) for n in range(1, ngram + 1) for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(r.encode()) % buckets for r in runs]

    import hashlib
    raw, aim = Counter(b for _, t in docs for b in feats(t)[1]), Counter(b for t in target for b in feats(t)[1])
    s_all, t_all = sum(raw.values()), sum(aim.values())
    out = []
    for i, text in docs:
        n, own = feats(text)
        gain = [math.floor(1000 * math.log((aim[b] + 1) * (s_all + buckets) / ((raw[b] + 1) * (t_all + buckets)))) for b in own]
        weight = sum(gain) // len(own) if own else 0
        h = int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
        out.append((i, n, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    order = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0]))
    rank = {r[0]: k for k, r in enumerate(order[:percent * len(order) // 100], 1)}
    return {(*r, rank.get(r[0])) for r in out}


@pytest.mark.parametrize("ngram", [1, 2, 3])
def test_resampling_against_brute_force(spark, ngram):
    docs = [(i, " ".join(f"W{(i * j) % 37}é" for j in range(i % 45))) for i in range(400)]
    target = [" ".join(f"w{j}é" for j in range(0, 37, 3))] * 5
    got = importance.resample(spark.createDataFrame(docs, "doc_id long, text string"),
                              spark.createDataFrame([(t,) for t in target], "text string"), ngram=ngram, percent=30).collect()
    assert {(r.doc_id, r.n_words, r.n_features, r.weight, r.score, r.rank) for r in got} == _resampled(docs, target, ngram, percent=30)


@pytest.mark.parametrize("ngram", [1, 2, 4])
def test_features_of_texts_in_stretches(ngram, monkeypatch):
    text = " ".join(f"W{j}-é{j}" * (j % 4) for j in range(60)).encode()
    whole = [x for _, runs in importance.features(text, ngram) for x in runs]
    for size in (1, 9, 40):
        monkeypatch.setattr(importance, "STRETCH", size)
        found = list(importance.features(text, ngram))
        assert len(found) > 3 and Counter(x for _, runs in found for x in runs) == Counter(whole)
        assert sum(n for n, _ in found) == sum(1 for x in whole if b" " not in x)


@pytest.mark.parametrize("margin", [1e-9, 0.01, 3.0])
def test_a_bracket_that_misses_is_widened(spark, margin):
    rows = [(i, 30, (i * 7919) % 1000) for i in range(3000)] + [(5000 + i, 3, 5000) for i in range(10)]
    scores = spark.createDataFrame(rows, "doc_id long, n_words long, score long").selectExpr("*", "30L AS n_features", "0L AS weight")
    order = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[2], r[0]))
    want = {r[0]: k for k, r in enumerate(order[:300], 1)}
    got = {r.doc_id: r.rank for r in importance.drawn(scores, "doc_id", margin=margin).collect()}
    assert got == {r[0]: want.get(r[0]) for r in rows}


def test_equal_scores_at_the_cutoff(spark):
    scores = spark.range(2000).selectExpr("if(id % 2 = 0, 7L, id) AS doc_id", "25L AS n_words", "25L AS n_features", "0L AS weight",
                                          "if(id % 2 = 0, 100L, 1L) AS score")
    got = importance.drawn(scores, "doc_id").where("rank IS NOT NULL").collect()
    assert sorted(r["rank"] for r in got) == list(range(1, 201)) and {r.doc_id for r in got} == {7}


# ------------------------------------------------------------------------------------------------ collocations
def _collocations(docs, longest=4, least=30, percent=80, top=2000):
    count, total = {}, Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        own = count.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(ASCII_LOWER)):
            words = re.findall(r"[^ \t]+", piece)
            total[lang] += len(words)
            for n in range(1, longest + 1):
                own.update(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
    out = set()
    for lang, own in count.items():
        cands = {g: a for g, a in own.items() if len(g) > 1 and a >= least}
        inside = Counter()
        for g, a in cands.items():
            for n in range(2, len(g)):
                for i in range(len(g) - n + 1):
                    inside[g[i:i + n]] = max(inside[g[i:i + n]], a)
        rows = []
        for g, a in cands.items():
            if 100 * inside[g] >= percent * a:
                continue
            score, _, left, right = min((2_000_000 * a // (own[g[:k]] + own[g[k:]]), k, own[g[:k]], own[g[k:]]) for k in range(1, len(g)))
            rows.append((-score, -a, " ".join(g).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return out


def _rows(df):
    return {(r.lang, r.rank, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect()}


ODD_TEXTS = [
    ("A\x01 a\x01\x02 A a. The\tthe  the \x00 \x00a, \x1f\x00 é É ü" * 3, "en"), ("a b c d e f. " * 12 + "a b c x a b", "en"), ("a b a b a b a b", None),
    (None, "en"), ("", "fr"), (" . ,", "de"), ("x\x00y z\x01 " * 9, "od\x00\x01d"), ("x y z", ""), ("a b c d e f. " * 12, "und"),
]


@pytest.mark.parametrize("longest", [1, 2, 4])
def test_keys_of_texts_in_stretches(longest, monkeypatch):
    for text, _ in ODD_TEXTS:
        want = Counter()
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(ASCII_LOWER)):
            words = re.findall(r"[^ \t]+", piece)
            want.update(("en", min(longest, len(words) - i), " ".join(words[i:i + longest])) for i in range(len(words)))
        for size in (1, 2, 7, 30, 1 << 22):
            monkeypatch.setattr(collocations, "STRETCH", size)
            got = Counter()
            for part, end in collocations._stretches((text or "").encode(), longest):
                for key, n in zip(*(x.to_pylist() for x in collocations.count_keys(part, end, b"en", longest))):
                    words = key.split(b"\0\0")[0]
                    got[("en", words.count(b"\0") + 1, collocations._phrase(words))] += n
            assert got == want


def test_collocations_against_brute_force(spark):
    docs = spark.createDataFrame(ODD_TEXTS, "text string, lang string").selectExpr("*", "'x' AS gram", "1 AS n", "2 AS phrase").repartition(5)
    # one row a batch and many ranges: sums run on over batches and partitions
    for size in ("1", "10000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            assert _rows(collocations.collocations(docs, least=2, top=7)) == _collocations(ODD_TEXTS, least=2, top=7)
            assert _rows(collocations.collocations(docs, longest=6, least=3)) == _collocations(ODD_TEXTS, longest=6, least=3)
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["en", "", "a\0\0b"]), st.lists(st.sampled_from("ab"), max_size=5)), min_size=1, max_size=60),
       st.integers(1, 9), st.integers(1, 4))
def test_flows_over_batches_and_ranges(pieces, size, cuts):
    count = Counter()
    keys = Counter()
    for lang, words in pieces:
        for i in range(len(words)):
            keys["\0".join([*words[i:i + 4], "\0" + lang]).encode()] += 1
            count[lang, ""] += 1
            for n in range(1, 5):
                if i + n <= len(words):
                    count[lang, " ".join(words[i:i + n])] += 1
    rows = sorted((k, 1) for k in keys.elements())
    got = Counter()
    for own in np.array_split(np.arange(len(rows)), cuts):
        batches = [pa.RecordBatch.from_arrays([pa.array([rows[i][0] for i in part], pa.binary()), pa.array([rows[i][1] for i in part], pa.int64())],
                                              names=["gram", "n"]) for part in (own[j:j + size] for j in range(0, len(own), size))]
        for out in collocations._flows_of(4, 3)(iter(batches)):
            for r in out.to_pylist():
                words = r["phrase"].split(" ") if r["words"] else []
                for n in range(r["words"] - r["same"], r["words"] + 1):
                    got[r["lang"], " ".join(words[:n])] += r["n"]
    assert {p: n for p, n in got.items() if n >= 3} == {p: n for p, n in count.items() if n >= 3}
