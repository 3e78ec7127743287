"""Queries that SQL cannot express, against brute force, a public library, or held-out labels."""

import math
import random
import re
import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
from conftest import SF_SMALL

import corpus_pipeline
from tripwise.llm import ngram_join, paragraph_dedup, quality, secret_scan, sentencepiece_codec
from tripwise.llm.components import connected_components
from tripwise.llm.decontaminate import SuffixAutomaton
from tripwise.llm.line_dedup import op2_line_dedup

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()}


def _components(ids, linked):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in linked:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    return {i: find(i) for i in ids}


def test_ngram_join_against_all_pairs(spark, texts):
    def shingled(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text.translate(ASCII_LOWER))
        return {tuple(words[i:i + 3]) for i in range(max(1, len(words) - 2))} if words else set()

    sets = {i: shingled(t) for i, t in texts.items()}
    linked = [(a, b) for a, b in combinations(sets, 2) if sets[a] and sets[b]
              and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])]
    want = _components(sets, linked)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.op7_ngram_join(spark, SF_SMALL).collect()}
    assert got == {i: (len(s), want[i]) for i, s in sets.items()}


def test_near_copies_of_one_text_are_one_component(spark):
    base = [f"word{i}" for i in range(200)]
    rows = []
    for i in range(60):
        words = list(base)
        words[3 * i] = f"other{i}"
        rows.append((i, " ".join(words)))
    rows += [(100 + i, " ".join(f"w{i}x{j}" for j in range(50))) for i in range(20)]
    got = {r.doc_id: r.component_id for r in ngram_join.join_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {got[i] for i in range(60)} == {0}
    assert all(got[100 + i] == 100 + i for i in range(20))


def test_near_copy_stage_against_all_pairs(spark):
    """Near copies of 5-word Jaccard 0.8 to 0.9 go, those just below 0.8 stay."""
    rng = np.random.default_rng(7)
    rows = []
    for i in range(40):
        base = [f"b{i}w{j}" for j in range(100)]
        copy = list(base)
        for place in rng.choice(np.arange(10, 90, 12), i % 4, replace=False):
            copy[place] = f"edit{i}x{place}"
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(copy))]
    sets = {i: {tuple(t.split()[k:k + 5]) for k in range(len(t.split()) - 4)} for i, t in rows}
    linked = [(a, b) for a, b in combinations(sets, 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert {len(sets[a] & sets[b]) for a, b in linked} == {96, 91, 86} and len(linked) == 30
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id for r in corpus_pipeline.ngram_join_stage(spark, docs, "").collect()}
    assert got == set(sets) - {b for _, b in linked}


def test_product_counts_all_parts_of_the_columns(spark):
    """Pairs around the bound, and one row with more partners than a block of pairs takes."""
    rng = np.random.default_rng(11)
    base = rng.integers(-2**62, 2**62, 120)
    sets = {0: set(base.tolist())}
    for i in range(1, 701):
        swapped = int(rng.integers(0, 25))
        own = np.concatenate((rng.permutation(base)[swapped:], rng.integers(-2**62, 2**62, swapped)))
        sets[i] = set(own[:len(own) - int(rng.integers(0, 10))].tolist())
    rows = [(k, len(v), sorted(v), np.bincount([x % 64 for x in v], minlength=64).tolist()) for k, v in sets.items()]
    matrix = spark.createDataFrame(rows, "key long, size long, columns array<long>, blocks array<int>")
    pairs = [(0, i) for i in range(1, 701)] + [(i, i + 1) for i in range(1, 700)]
    want = {(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    got = ngram_join.product(spark.createDataFrame(pairs, "a long, b long"), matrix, 80).collect()
    assert 0 < len(want) < len(pairs) and len(got) == len(want) and {(r.a, r.b) for r in got} == want


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (1001, 1000), (7, 7)], "a long, b long")
    got = {r.vertex: r.component for r in connected_components(edges).collect()}
    assert got == {**dict.fromkeys(range(301), 0), 1000: 1000, 1001: 1000}


def test_line_dedup_against_all_pairs(spark, texts):
    lines = []
    for i in sorted(texts):
        for n, line in enumerate(texts[i].split("\n")):
            words = frozenset(w for w in re.split(r"[\x20\x09-\x0D]+", line.lower()) if w)
            if words:
                lines.append((i, n, words))
    by_set = {}
    for i, n, words in lines:
        by_set.setdefault(words, (i, n))
    sets = sorted(by_set, key=by_set.get)
    kept = set()
    holders = defaultdict(list)
    for words in sets:
        near = {other for w in words for other in holders[w]}
        if not any(100 * len(words & other) >= 80 * len(words | other) for other in near):
            kept.add(by_set[words])
        for w in words:
            holders[w].append(words)
    removed = defaultdict(list)
    for i, n, _ in lines:
        if (i, n) not in kept:
            removed[i].append(str(n))
    got = {r.doc_id: r.removed_lines for r in op2_line_dedup(spark, SF_SMALL).collect()}
    assert got == {i: ",".join(removed[i]) for i in texts}


def test_paragraph_dedup_finds_every_shared_passage(spark, texts):
    got = {r.doc_id: r for r in paragraph_dedup.op1_paragraph_dedup(spark, SF_SMALL).collect()}
    first, share = {}, defaultdict(set)
    for i in sorted(texts):
        words = [w.lower() for w in re.findall(rb"[0-9A-Za-z\x80-\xff]+", texts[i].encode())]
        for k in range(len(words) - 50):
            j = first.setdefault(tuple(words[k:k + 51]), i)
            if j != i:
                share[i].add(j)
    assert share
    assert all(got[i].n_removed and set(got[i].kept_in) & set(got[j].kept_in) for i in share for j in share[i])


def test_paragraph_dedup_cuts_a_passage_from_the_middle_of_a_line(spark):
    rng = np.random.default_rng(1)
    word = lambda: "".join(chr(97 + c) for c in rng.integers(0, 26, 7))
    passage = " ".join(word() for _ in range(60))
    rows = [(i, " ".join(word() for _ in range(80)) + " " + passage + " " + " ".join(word() for _ in range(40))) for i in range(5)]
    rows.append((9, " ".join(word() for _ in range(200))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id: r.text for r in paragraph_dedup.without_repeats(docs).collect()}
    assert kept[0] == rows[0][1] and kept[9] == rows[5][1]
    for i in range(1, 5):
        left = len(set(kept[i].split()) & set(passage.split()))
        assert left < 40 and kept[i].startswith(rows[i][1][:300])


def test_near_copy_paragraphs_of_any_length_against_all_pairs(spark):
    """Lines, blocks of lines and whole texts of 30 to 400 words with edits: one of each pair of 5-word Jaccard >= 0.8 goes."""
    rng = np.random.default_rng(5)
    word = lambda: "".join(chr(97 + c) for c in rng.integers(0, 26, 8))
    rows, pairs = [], []
    for length, edits in [(30, [1]), (40, [1]), (50, [25]), (60, [30]), (60, [20]), (100, [33, 66]), (100, [20, 80]), (400, list(range(50, 400, 60))),
                          (100, [15, 35, 55, 75]), (40, [13, 26])]:
        base = [word() for _ in range(length)]
        copy = [word() if k in edits else w for k, w in enumerate(base)]
        gram = lambda words: {tuple(words[k:k + 5]) for k in range(len(words) - 4)}
        near = 100 * len(gram(base) & gram(copy)) >= 80 * len(gram(base) | gram(copy))
        broken = lambda words: "\n".join(" ".join(words[k:k + 10]) for k in range(0, len(words), 10))
        for form in (" ".join, broken, lambda words: words_around() + "\n" + " ".join(words) + "\n" + words_around(),
                     lambda words: words_around() + "\n\n" + broken(words) + "\n \n" + words_around()):
            words_around = lambda: " ".join(word() for _ in range(70))
            fresh = {w: word() for w in base + copy}  # a passage of its own for every form
            pairs.append((len(rows), near, length))
            rows += [(len(rows), form([fresh[w] for w in base])), (len(rows) + 1, form([fresh[w] for w in copy]))]
    assert sum(near for _, near, _ in pairs) == 32
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in paragraph_dedup.removals(docs).collect()}
    for i, near, length in pairs:
        gone = sum(e - b for b, e in got[i + 1].pd_spans)
        assert got[i].pd_spans == [] and (length <= gone <= length + 4) == near, (i, near, length, got[i + 1])


def test_paragraphs_of_one_bucket_are_all_compared(spark):
    """Pairs of Jaccard 0.9 among many paragraphs that share most shingles with them, and so their buckets."""
    rng = np.random.default_rng(11)
    word = lambda: "".join(chr(97 + c) for c in rng.integers(0, 26, 8))
    shared = [word() for _ in range(16)]
    rows = []
    for i in range(300):  # 12 of 20 shingles are everyone's
        rows.append((i, " ".join([word() for _ in range(4)] + shared + [word() for _ in range(4)])))
    for i in range(0, 300, 10):  # one last word differs: 19 of 21 shingles
        rows.append((1000 + i, " ".join(rows[i][1].split()[:-1] + [word()])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.pd_first for r in paragraph_dedup.removals(docs).collect()}
    found = [i for i in range(0, 300, 10) if got[1000 + i] == [i] == got[i]]
    assert found == list(range(0, 300, 10))
    assert all(got[i] == [] for i in range(300) if i % 10)


def test_quality_on_held_out_labels(spark):
    got = {r.doc_id: r for r in quality.op5_quality(spark, SF_SMALL).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    held = [i for i in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].held_out for i in held) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    assert np.mean([got[i].predicted == labels[i] for i in held]) >= 0.9
    assert min(got[i].score for i in held if labels[i] == 1) > max(got[i].score for i in held if labels[i] == 0) - 0.5


def test_tokens_are_those_of_the_public_library(texts):
    from sentencepiece import SentencePieceProcessor
    library = SentencePieceProcessor(model_file=sentencepiece_codec.MODEL)
    vocabulary = sentencepiece_codec.Vocabulary()
    odd = ["", " ", "   ", "\n\n", " a  b   c\n\n  d", "ünï 😀 中文字符", "x" * 3000, " " * 300, "a\tb\r\nc", "_----====__,. .", "a b", "1234567890"]
    whole = list(texts.values()) + odd
    tokens = sentencepiece_codec.Encoder(vocabulary)(whole)
    assert [t.tolist() for t in tokens] == library.encode(whole, num_threads=1)
    assert [sentencepiece_codec.decode(vocabulary, t) for t in tokens] == whole


def test_unigram_forward_step_finds_the_best_sum():
    v = object.__new__(sentencepiece_codec.Vocabulary)
    v.kind, v.byte_id = 1, list(range(1000, 1256))
    v.score = {"a": -1.0, "b": -1.0, "ab": -1.5, "abc": -4.0, "c": -1.0, "bc": -0.2}
    v.id = {p: i for i, p in enumerate(v.score)}
    v.trie = {}
    for p in v.score:
        node = v.trie
        for c in p:
            node = node.setdefault(c, {})
        node[""] = p
    encoder = sentencepiece_codec.PrefixEncoder(v, {})
    assert [encoder.encode(u) for u in ("ab", "abc", "abz")] == [(v.id["ab"],), (v.id["a"], v.id["bc"]), (v.id["ab"], 1000 + ord("z"))]


def test_automaton_against_window_search():
    rng = np.random.default_rng(3)
    for _ in range(200):
        window = int(rng.integers(2, 5))
        draw = lambda n: [bytes([97 + c]) for c in rng.integers(0, 4, n)]
        items = [(str(k), draw(int(rng.integers(0, 8)))) for k in range(int(rng.integers(1, 6)))]
        doc = draw(int(rng.integers(0, 40)))
        hit, found = set(), set()
        for k, words in items:
            n = min(window, len(words))
            for s in range(len(words) - n + 1) if n else ():
                for at in range(len(doc) - n + 1):
                    if doc[at:at + n] == words[s:s + n]:
                        hit |= set(range(at, at + n))
                        found.add(k)
        automaton = SuffixAutomaton(items, window)
        spans, ids, _ = automaton.scan(doc)
        assert {i for a, b in spans for i in range(a, b)} == hit and {automaton.ids[k] for k in ids} == found


def _entropy_spans(text):
    """Window by window, with counts taken anew."""
    base = [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]{24,}", text)]
    base += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 20]
    found = set()
    for candidate in re.finditer(secret_scan.CANDIDATE, text):
        if any(re.fullmatch(p, candidate[0]) for p in secret_scan.ALLOWED):
            continue
        for pattern, least in secret_scan.CLASSES:
            for run in re.finditer(pattern, candidate[0]):
                spans, begin = [], candidate.start() + run.start()
                for i in range(len(run[0]) - 19):
                    window = run[0][i:i + 20]
                    if -sum(window.count(c) / 20 * math.log2(window.count(c) / 20) for c in set(window)) >= least - 1e-9:
                        if spans and spans[-1][1] >= begin + i:
                            spans[-1][1] = begin + i + 20
                        else:
                            spans.append([begin + i, begin + i + 20])
                found |= {(a, 3, b) for a, b in spans}
    return sorted(base + [x for x in found if not any(b[0] <= x[0] and x[2] <= b[2] for b in base)])


def test_secret_spans_against_window_search(spark):
    draw = random.Random(3)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
    texts = [None, "", "a" * 40, letters, "é " + letters[::-1] * 2]
    for size in (19, 20, 21, 60, 700, 3000):  # few letters give windows on both sides of the limits
        for few in (letters, letters[:14], letters[50:], "0123456789abcdef", "0123456789ABCDEF", "01234567abXY"):
            texts.append(" ".join("".join(draw.choice(few) for _ in range(size)) for _ in range(2)))
    texts.append(" ".join("%032x" % draw.getrandbits(128) for _ in range(1500)))  # more matches than one block gathers
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in secret_scan.scan(rows).collect():
        assert [tuple(x) for x in row.sec_spans] == _entropy_spans(row.text or ""), row.doc_id


def test_secret_scan_of_a_very_long_run(spark):
    draw = random.Random(4)
    run = "".join(draw.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(200_000))
    row = secret_scan.scan(spark.createDataFrame([(1, run)], "doc_id long, text string")).first()
    assert row.sec_base == [] and sum(x["end"] - x["start"] for x in row.sec_spans) > 100_000
