"""Batches of a bounded length, and products that make one row for each pair."""

import itertools
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T

from tripwise.llm import common, line_dedup, ngram_join, paragraph_dedup, sentencepiece_codec
from tripwise.llm.words import shingles


def test_add_columns_computes_few_rows_at_once(spark):
    def make():
        return lambda batch: [pa.array([batch.num_rows] * batch.num_rows, pa.int64())]

    rows = common.add_columns(spark.range(2500).coalesce(1), [T.StructField("n", T.LongType())], make).collect()
    assert sorted(r.id for r in rows) == list(range(2500)) and max(r.n for r in rows) <= 1000


def test_product_joins_no_row_per_common_column(spark, monkeypatch):
    plans = []

    def stored(df, what):
        if what == "ngram-entries":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return common.stored(df, what)

    monkeypatch.setattr(ngram_join, "stored", stored)
    rows = [(k, 100, list(range(k, k + 100)), [sum(x % 64 == i for x in range(k, k + 100)) for i in range(64)]) for k in range(4)]
    matrix = spark.createDataFrame(rows, "key long, size long, columns array<long>, blocks array<int>")
    got = ngram_join.product(spark.createDataFrame([(0, 1), (0, 2), (0, 3)], "a long, b long"), matrix, 97).collect()
    assert {(r.a, r.b) for r in got} == {(0, 1)}
    assert len(plans) == 1 + ngram_join.COLUMN_BLOCKS // ngram_join.PART_BLOCKS and not any("explode" in p for p in plans)


def test_tasks_of_a_worker_share_an_encoder(spark):
    vocabulary = sentencepiece_codec.Vocabulary.__new__(sentencepiece_codec.Vocabulary)
    other = sentencepiece_codec.Vocabulary.__new__(sentencepiece_codec.Vocabulary)
    vocabulary.unit = other.unit = "[a-z]+"
    encoder = sentencepiece_codec.worker_encoder(vocabulary)
    assert sentencepiece_codec.worker_encoder(vocabulary) is encoder and sentencepiece_codec.worker_encoder(other) is not encoder
    # one task after another in one worker gives what fresh encoders give
    texts = [f"word{i % 7} and some{i} more, text{i * i}" for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.sp_tokens, r.sp_same) for r in sentencepiece_codec.encode_texts(docs).collect()}
    fresh = sentencepiece_codec.Vocabulary()
    assert got == {i: (sentencepiece_codec.Encoder(fresh)([t])[0].tolist(), True) for i, t in enumerate(texts)}


def test_near_copies_do_not_all_meet(spark, monkeypatch):
    """Of a group of near copies few pairs are compared, and the components are those of all pairs."""
    rng = random.Random(5)
    texts, n = [], 160
    for _ in range(n):
        words = [f"w{i}" for i in range(120)]
        for place in rng.sample(range(10, 110), rng.choice((1, 1, 2, 2, 3))):
            words[place] = f"x{rng.randrange(4)}"
        texts.append(" ".join(words))
    met = []
    product = ngram_join.product

    def counted(pairs, matrix, percent):
        met.append(pairs.count())
        return product(pairs, matrix, percent)

    monkeypatch.setattr(ngram_join, "product", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in ngram_join.join_components(docs).collect()}
    sets = [{tuple(t.split()[i:i + 3]) for i in range(118)} for t in texts]
    links = [(a, b) for a, b in itertools.combinations(range(n), 2) if 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])]
    least, before = list(range(n)), None
    while least != before:
        before = list(least)
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    assert got == dict(enumerate(least)) and len(set(least)) > 1
    assert sum(met[1:]) <= n, met


def test_bitmaps_differ_in_no_more_bits_than_shingles():
    rng = random.Random(3)
    split = paragraph_dedup.word_splitter()
    for size in (5, 30, 400):
        words = split(" ".join(f"w{rng.randrange(40)}" for _ in range(size)).encode())[0]
        begins = np.array([0, 0, size // 3])
        ends = np.array([size, max(5, size // 2), max(size // 3 + 5, size)])
        begins, ends = begins[ends <= size], ends[ends <= size]
        maps = paragraph_dedup.bitmaps(words, begins, ends)
        sets = [set(shingles(words, 5)[b:e - 4].tolist()) for b, e in zip(begins, ends)]
        for i, j in itertools.combinations(range(len(sets)), 2):
            differ = sum(int(x ^ y).bit_count() for x, y in zip(maps[i], maps[j]))
            assert (sets[i] != sets[j] or differ == 0) and differ <= len(sets[i] ^ sets[j])


def test_whole_sets_move_only_for_paragraphs_alike(spark, monkeypatch):
    """Paragraphs that share a bucket by a common phrase are not sent with their whole sets; near copies are found."""
    rng = random.Random(4)
    texts = [" ".join([f"w{rng.randrange(10**6)}" for _ in range(18)] + "this phrase stands in all of them here".split()) for _ in range(120)]
    texts.append(texts[7] + " more")
    met = []
    linked = paragraph_dedup.linked

    def counted(pairs, sets, percent):
        met.append(pairs.count())
        return linked(pairs, sets, percent)

    monkeypatch.setattr(paragraph_dedup, "linked", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.pd_removed for r in paragraph_dedup.removals(docs).collect()}
    assert got == {i: int(i == 120) for i in range(121)}
    assert sum(met) <= 60, met  # nearly all of them of one text: its window and the whole


def test_workers_get_small_batches_and_keep_one_thing(spark):
    """Batches are bounded on Spark's side too, and what a worker keeps goes when another operator's task runs."""
    spark.conf.unset(common.BATCH_ROWS)
    made = []
    key = object()
    assert common.worker_keeps(key, lambda k: made.append(k) or [k]) is common.worker_keeps(key, made.append) and made == [key]
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(5)], "doc_id long, text string").coalesce(1)
    assert sentencepiece_codec.encode_texts(docs).count() == 5

    def make():
        return lambda batch: [pa.array([len(common._KEPT)] * batch.num_rows, pa.int64())]

    rows = common.add_columns(spark.range(2500).coalesce(1), [T.StructField("n", T.LongType())], make)
    assert {r.n for r in rows.collect()} == {0} and 0 < int(spark.conf.get(common.BATCH_ROWS)) <= common.ROWS_AT_ONCE
    sizes = spark.range(2500).coalesce(1).mapInArrow(lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["n"]) for b in batches), "n long")
    assert max(r.n for r in sizes.collect()) <= common.ROWS_AT_ONCE


def test_marks_in_texts_are_spaces_and_kept_tokens_are_right():
    from sentencepiece import SentencePieceProcessor
    library = SentencePieceProcessor(model_file=sentencepiece_codec.MODEL)
    encoder = sentencepiece_codec.Encoder(sentencepiece_codec.Vocabulary())
    texts = ["a\u2581b \u2581 c", "a b", "\u2581", "x \u2581\ny", "a\u2581b \u2581 c"]
    for _ in range(2):
        assert [t.tolist() for t in encoder(texts)] == library.encode(texts, num_threads=1)
    assert all(isinstance(v, bytes) for v in encoder.known.values()) and any(encoder.known)


def test_words_of_a_line_are_hashed_once(spark):
    """No condition holds the words' hashes, which Spark would compute for it and once more for the rows."""
    docs = spark.createDataFrame([(1, "a b\tc d e\n \x0b \nA b c d e\n\u00a0"), (2, "\n\n"), (None, "a b c d e")], "doc_id long, text string")
    lines = line_dedup.lines_of(docs, "doc_id", "text")
    plan = line_dedup._as_sets(line_dedup._hashed(lines))._jdf.queryExecution().optimizedPlan().toString()
    assert not [part for part in plan.splitlines() if "Filter" in part and "xxhash64" in part]
    got = {r.doc_id: (r.ld_lines, r.ld_removed) for r in line_dedup.removed_lines(docs).collect()}
    assert got == {1: (4, [2]), 2: (3, []), None: (1, [])}


def test_paragraphs_of_many_texts_are_those_of_each(spark, monkeypatch):
    """Texts worked on together have the windows, lines and blocks that each of them has alone."""
    rng = random.Random(9)
    values = [None, b"", b"one two"] + [(" ".join(rng.choice(["w%d" % rng.randrange(50), "x\n", "y\n\n"]) for _ in range(rng.randrange(200)))).encode() for _ in range(60)]
    split = paragraph_dedup.word_splitter()
    texts = paragraph_dedup.Texts(split, values)
    begins, ends = paragraph_dedup.paragraph_spans(texts)
    of = texts.of(begins)
    key, own, order = paragraph_dedup.sketches(texts.words, begins, ends)
    for i, value in enumerate(values):
        alone = paragraph_dedup.Texts(split, [value])
        first, last = paragraph_dedup.paragraph_spans(alone)
        mine = of == i
        assert (begins[mine] - texts.first[i]).tolist() == first.tolist() and (ends[mine] - texts.first[i]).tolist() == last.tolist()
        windows = paragraph_dedup.paragraph_begins(alone.words) if len(alone.words) >= 5 else []
        assert set(windows) <= set(first.tolist())
        if len(first):
            assert all((a == b[mine]).all() for a, b in zip(paragraph_dedup.sketches(alone.words, first, last), (key, own, order)))
    assert list(paragraph_dedup.stretches([b"a" * 400_000] * 3 + [None])) == [(0, 1), (1, 2), (2, 4)]
