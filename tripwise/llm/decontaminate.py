"""Benchmark decontamination with a generalised suffix automaton.

The normalised items are inserted word by word into one automaton.  A document
streams through it; at every word the automaton gives the longest suffix of the
words read that occurs in some item.  A match of ``window`` words or more covers
its words, and so does a whole item that is shorter than the window.

Only stretches of a document whose neighbouring words all stand side by side in
some item are streamed: everywhere else the longest match is under two words,
which numpy finds beforehand from the items' word pairs.

Null texts have no words.  Items without words match nothing; equal items are
all reported.  Very long texts are read whole.  An empty item table leaves every
document clean.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwise.llm.common import add_columns, table, utf8

WINDOW = 13
#: begins the names of added columns
PREFIX = "dc_"
#: the share of hit words from which a document counts as contaminated: 1 in 20
COVERAGE_DIVISOR = 20
#: words of all items together; the automaton goes to every executor, so its size is checked
MAX_ITEM_WORDS = 5_000_000

# A-Z become a-z; digits, a-z and all bytes of non-ASCII characters stay; the rest separates words
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def fold_words(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


class SuffixAutomaton:
    """Generalised suffix automaton over word numbers, with the items that each window stands for."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.length, self.link = [0], [-1]
        self.next: list[dict[int, int]] = [{}]
        self.ids = [item_id for item_id, _ in items]
        coded = [[self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words] for _, words in items]
        for sequence in coded:
            state = 0
            for word in sequence:
                state = self._extend(state, word)
        self._mark(coded)
        size = max(1, len(self.vocabulary))
        pairs = {a * size + b for s in coded for a, b in zip(s, s[1:])}
        self.pairs = np.array(sorted(pairs), dtype=np.int64)
        self.shortest = min((min(len(s), window) for s in coded if s), default=0)

    def _extend(self, last: int, word: int) -> int:
        length, link, nxt = self.length, self.link, self.next
        known = nxt[last].get(word)
        if known is not None:
            return known if length[known] == length[last] + 1 else self._clone(last, word, known)
        new = len(length)
        length.append(length[last] + 1)
        link.append(0)
        nxt.append({})
        state = last
        while state != -1 and word not in nxt[state]:
            nxt[state][word] = new
            state = link[state]
        if state != -1:
            target = nxt[state][word]
            link[new] = target if length[target] == length[state] + 1 else self._clone(state, word, target)
        return new

    def _clone(self, state: int, word: int, target: int) -> int:
        copy = len(self.length)
        self.length.append(self.length[state] + 1)
        self.link.append(self.link[target])
        self.next.append(dict(self.next[target]))
        self.link[target] = copy
        while state != -1 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _mark(self, coded: list[list[int]]) -> None:
        """For each state: the items of the window that ends there, and the short items that end there."""
        window, length, link = self.window, self.length, self.link
        order = sorted(range(1, len(length)), key=length.__getitem__)
        self.of_window = [0] * len(length)  # the state of the suffix of `window` words
        for s in order:
            if length[s] >= window:
                self.of_window[s] = s if length[link[s]] < window else self.of_window[link[s]]
        self.window_items: dict[int, set[int]] = {}
        whole: dict[int, list[tuple[int, int]]] = {}
        for number, sequence in enumerate(coded):
            state = 0
            for i, word in enumerate(sequence):
                state = self.next[state][word]
                if i + 1 >= window:
                    self.window_items.setdefault(self.of_window[state], set()).add(number)
            if 0 < len(sequence) < window:
                whole.setdefault(state, []).append((len(sequence), number))
        self.whole = whole
        self.next_whole = [-1] * len(length)  # the state itself or its nearest suffix that ends a short item
        for s in order:
            self.next_whole[s] = s if s in whole else self.next_whole[link[s]] if link[s] > 0 else -1

    def stretches(self, codes: np.ndarray) -> list[tuple[int, int]]:
        """Runs of words whose every neighbouring pair occurs in an item, long enough for the shortest window."""
        if self.shortest == 0 or len(codes) < self.shortest:
            return []
        if self.shortest == 1:
            known = codes >= 0
            edges = np.flatnonzero(np.diff(np.concatenate(([0], known.view(np.int8), [0]))))
            return list(zip(edges[::2].tolist(), edges[1::2].tolist()))
        pair = codes[:-1].astype(np.int64) * len(self.vocabulary) + codes[1:]
        pair[(codes[:-1] < 0) | (codes[1:] < 0)] = -1
        at = np.searchsorted(self.pairs, pair)
        at[at == len(self.pairs)] = 0
        joined = (self.pairs[at] == pair) if len(self.pairs) else np.zeros(len(pair), bool)
        edges = np.flatnonzero(np.diff(np.concatenate(([0], joined.view(np.int8), [0]))))
        begin, end = edges[::2], edges[1::2]  # pairs begin..end-1, so words begin..end
        long = end - begin + 1 >= self.shortest
        return list(zip(begin[long].tolist(), (end[long] + 1).tolist()))

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int], int]:
        """Covered word spans (disjoint, ascending), the items found and the longest match."""
        if not words:
            return [], set(), 0
        lookup = self.vocabulary.get
        codes = np.array([lookup(w, -1) for w in words], dtype=np.int32)
        spans: list[list[int]] = []
        found: set[int] = set()
        longest = 0
        nxt, link, length, window = self.next, self.link, self.length, self.window

        def cover(begin: int, end: int) -> None:
            while spans and spans[-1][1] >= begin:
                last = spans.pop()
                begin, end = min(begin, last[0]), max(end, last[1])
            spans.append([begin, end])

        for begin, end in self.stretches(codes):
            state = matched = 0
            for i, word in enumerate(codes[begin:end].tolist(), begin):
                while state and word not in nxt[state]:
                    state = link[state]
                    matched = length[state]
                if word in nxt[state]:
                    state = nxt[state][word]
                    matched += 1
                if matched > longest:
                    longest = matched
                if matched >= window:
                    cover(i + 1 - matched, i + 1)
                    found |= self.window_items[self.of_window[state]]
                ends = self.next_whole[state] if state else -1
                while ends > 0:
                    for size, number in self.whole[ends]:
                        if size <= matched:
                            cover(i + 1 - size, i + 1)
                            found.add(number)
                    ends = self.next_whole[link[ends]] if link[ends] > 0 else -1
        return [(a, b) for a, b in spans], found, longest


def _without(text: bytes, spans: list[tuple[int, int]]) -> str:
    """The text without the covered words and what stands between them."""
    at = [m.span() for m in _WORD.finditer(text)]
    kept, begin = [], 0
    for first, last in spans:
        kept.append(text[begin:at[first][0]])
        begin = at[last - 1][1]
    kept.append(text[begin:])
    return b"".join(kept).decode("utf-8", "replace")


def build_automaton(items: DataFrame, item_id: str, item_text: str, window: int,
                    max_item_words: int = MAX_ITEM_WORDS) -> SuffixAutomaton:
    """The automaton of all items; refuses item tables beyond ``max_item_words`` instead of dropping any."""
    size = items.agg(F.sum(F.octet_length(item_text))).first()[0] or 0
    if size > 16 * max_item_words:
        raise ValueError(f"the items hold {size} bytes, beyond the bound of {16 * max_item_words}; pass parts of the table")
    rows = items.select(F.col(item_id).cast("string"), F.col(item_text).cast("binary")).toLocalIterator()
    return SuffixAutomaton([("" if k is None else k, fold_words(bytes(t) if t is not None else None)) for k, t in rows], window)


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = WINDOW, clean_text: bool = True, prefix: str = PREFIX) -> DataFrame:
    """Every row of ``docs`` with what it shares with the items.

    Adds ``dc_words`` and ``dc_hit`` (words, hit words), ``dc_longest`` (longest
    match in words), ``dc_items`` (item ids as strings, sorted), ``dc_spans``
    (covered spans ``begin:end`` in words) and, with ``clean_text``, ``dc_text``
    (the text without the covered spans; null for null).  Another ``prefix`` than
    ``dc_`` is for tables that have columns of these names.
    """
    automaton = docs.sparkSession.sparkContext.broadcast(build_automaton(items, item_id, item_text, window))
    fields = [T.StructField(prefix + "words", T.LongType()), T.StructField(prefix + "hit", T.LongType()),
              T.StructField(prefix + "longest", T.LongType()), T.StructField(prefix + "items", T.ArrayType(T.StringType())),
              T.StructField(prefix + "spans", T.StringType())] + [T.StructField(prefix + "text", T.StringType())] * clean_text

    def make():
        scanner = automaton.value

        def compute(batch: pa.RecordBatch) -> list[pa.Array]:
            n_words, n_hit, longest, ids, spans_out, texts = [], [], [], [], [], []
            for value in utf8(batch.column(text)):
                words = fold_words(value)
                spans, found, most = scanner.scan(words)
                n_words.append(len(words))
                n_hit.append(sum(b - a for a, b in spans))
                longest.append(most)
                ids.append(sorted(scanner.ids[k] for k in found))
                spans_out.append(",".join(f"{a}:{b}" for a, b in spans))
                if clean_text:
                    texts.append(None if value is None else _without(value, spans) if spans else value.decode("utf-8", "replace"))
            arrays = [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(longest, pa.int64()),
                      pa.array(ids, pa.list_(pa.string())), pa.array(spans_out, pa.string())]
            return arrays + [pa.array(texts, pa.string())] * clean_text

        return compute

    return add_columns(docs, fields, make, drop=() if clean_text else (text,))


def is_contaminated(prefix: str = PREFIX):
    hit = F.col(prefix + "hit")
    return (hit > 0) & (COVERAGE_DIVISOR * hit >= F.col(prefix + "words"))


def op3_decontamination(spark, sf_dir: str) -> DataFrame:
    """Per document: words, hit words, items with occurring windows and the contamination verdict."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    out = decontaminate(docs, table(spark, sf_dir, "benchmark", "item_id", "text"), clean_text=False)
    return out.select("doc_id", F.col("dc_words").alias("n_words"), F.col("dc_hit").alias("n_hit"),
                      F.size("dc_items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("dc_items", ","), 256).alias("items_sha256"),
                      is_contaminated().alias("contaminated"))


ORACLE = """
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(len(w), 13) + 1)) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
grams AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM words, sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, item_id, i, n FROM grams JOIN windows USING (n, g)),
covered AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS k FROM hits) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""
