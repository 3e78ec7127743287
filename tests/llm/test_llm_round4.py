"""Findings of the latest round: what operators leave behind, and sort keys of phrases."""

import os

import numpy as np
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tripwise.llm import collocations, common, paragraph_dedup
from tripwise.session import shared_dir


def test_arrays_leave_the_driver_with_the_next_stored_table(spark):
    array = common.fixed_array(spark.createDataFrame([(1, 5), (3, 7)], "i int, value bigint"), 4)
    held = spark.range(4).select("id", F.element_at(array, F.col("id").cast("int") + 1).alias("v"))
    want = [(0, 0), (1, 5), (2, 0), (3, 7)]
    assert sorted(map(tuple, common.stored(held, "held").collect())) == want
    assert not common._ARRAYS
    with pytest.raises(AnalysisException):
        spark.range(1).select(array).collect()
    # a DataFrame made before keeps its array
    assert sorted(map(tuple, held.join(held.select("id"), "id").collect())) == want


def test_keys_of_a_stretch_are_ascending_runs_of_ranges():
    words = [b"b", b"a", b"\xc3\xa9", b"a", b"c" * 30, b"ab"] * 50
    keys, counts = collocations.count_keys(b" ".join(words), 10 ** 6, b"en", 4)
    found = keys.to_pylist()
    assert found == sorted(set(found)) and sum(counts.to_pylist()) == len(words)
    edges = np.array(sorted([b"a\x00c", b"b", b"c" * 16]), f"S{collocations.HEAD}")
    heads = [k[:collocations.HEAD].ljust(collocations.HEAD, b"\x00") for k in found]
    assert collocations._ranges(keys, edges).tolist() == [sum(e.ljust(collocations.HEAD, b"\x00") <= h for e in edges.tolist()) for h in heads]
    none = collocations.count_keys(b"", 0, b"en", 4)[0]
    assert not len(none) and not len(collocations._ranges(none, edges))


def test_rarest_columns_as_sorted_one_by_one(spark):
    rng = np.random.default_rng(3)
    counts = np.zeros(paragraph_dedup.RARITY_BUCKETS, np.int64)
    counts[:50] = rng.integers(0, 4, 50)
    rows = [(k, n, [int(x) for x in rng.integers(-60, 60, n)]) for k, n in enumerate([1, 4, 5, 9, 20, 31])]
    sets = spark.createDataFrame(rows, "key bigint, size bigint, columns array<int>")
    got = {r.key: r.prefix for r in paragraph_dedup.rarest(sets, spark.sparkContext.broadcast(counts), 80).collect()}
    for key, size, columns in rows:
        ranked = sorted(columns, key=lambda c: (counts[c & (paragraph_dedup.RARITY_BUCKETS - 1)], c & 0xFFFFFFFF))
        assert got[key] == ranked[:size - -(-80 * size // 100) + 1]


def test_tables_that_nothing_reads_are_deleted(spark):
    path = shared_dir(spark).removeprefix("file://")
    before = set(os.listdir(path))
    passage = " ".join(f"shared{i}" for i in range(70))
    docs = spark.createDataFrame([(k, f"own{k} words{k} stand{k} here{k} first{k} {passage} end{k}") for k in range(5)], "doc_id bigint, text string")
    found = paragraph_dedup.removals(docs)
    left = {name.rsplit("-", 1)[0] for name in set(os.listdir(path)) - before}
    assert not left & {"paragraph-sets", "paragraph-places", "paragraph-pairs", "paragraph-close", "paragraph-prefixes", "paragraph-rare", "paragraph-rest"}
    assert "paragraphs" in left
    assert {r.doc_id: r.pd_removed > 0 for r in found.collect()} == {0: False, 1: True, 2: True, 3: True, 4: True}
