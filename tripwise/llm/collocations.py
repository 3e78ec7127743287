"""Phrase collocations from a weighted word graph.

Nodes are the runs of three words, edges the runs of four: an edge leads from its
first three words to its last three.  Only edges are counted over the corpus, along
with the shorter runs that end a piece, as no edge begins there.  The count of a
shorter phrase is the flow out of its node, the sum of the edges that begin with it,
plus the pieces that end with it.

1. Tasks turn texts into (words, language) keys, one for each word of a piece and the
   words after it, and sort and count them in stretches (Arrow kernels, no Python object
   a word).
2. One exchange deals the keys into ranges, whose bounds come from a sample of the
   texts, and Spark sorts each (and spills): it merges the stretches' sorted runs, which
   also compress well on the way.  A language's keys that begin with the
   same words follow each other, so one pass with a running sum for each length gives
   all flows.  A frequent phrase's continuations may fill several ranges: the first
   and the last sum of each length in a range are added up afterwards.
3. Unary paths are compacted: a phrase that goes on in one way only, and never ends a
   piece, has its continuation's count, and one row stands for both.
4. Candidates are scored by joins with their parts' counts.  One-word parts, which
   many candidates share, are dealt over ``SALTS`` copies of the words' counts.

Null texts have no words, a null language is ``und``.  Repeated rows count again.  A
piece of any length is read in stretches that overlap by the words of an edge.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripwise.llm.common import stored, table, utf8

LONGEST, LEAST, COVER_PERCENT, TOP = 4, 30, 80, 2_000
SCALE = 2_000_000
NO_LANG = "und"
#: bytes of text counted at once
STRETCH = 1 << 22
#: copies of each word's count among which the candidates that hold it are dealt
SALTS = 32
ROWS_AT_ONCE = 1 << 16
#: bytes of a key that decide on its range; texts sampled for each range
HEAD, SAMPLED_TEXTS = 16, 8

_BREAKS, _BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
_KIND = np.array([0 if b in _BREAKS else 1 if b in _BLANKS else 2 for b in range(256)], np.uint8)
# A key holds words with byte 0, the least one, between them, then two bytes 0 and the language, so that in byte
# order a phrase and a language's keys that begin with it have no other key of the language among them.
# A word's own byte 0 becomes "A", which lower-cased words never hold.
_LOWER = bytes(65 if b == 0 else b + 32 if 65 <= b <= 90 else b for b in range(256))
_BREAK = re.compile(rb"[.,;:!?\n-\r]")
_BLANK = re.compile(rb"[ \t]")

FLOW_SCHEMA = "lang string, words int, phrase string, n bigint, same int"


def _phrase(words: bytes) -> str:
    return words.replace(b"\x00", b" ").replace(b"A", b"\x00").decode("utf-8", "replace")


def _stretches(text: bytes, longest: int) -> Iterator[tuple[bytes, int]]:
    """(bytes, end): the stretches of a text, each to be counted for the words that begin before ``end``."""
    after = re.compile(rb"(?:[ \t]+[^ \t.,;:!?\n-\r]+){0,%d}" % (longest - 1))
    begin = 0
    while len(text) - begin > STRETCH:
        found = _BREAK.search(text, begin + STRETCH, begin + 2 * STRETCH) or _BLANK.search(text, begin + STRETCH)
        if not found:
            break
        end = found.start()
        yield text[begin:after.match(text, end).end()], end - begin
        begin = end
    yield text[begin:], len(text) - begin


def count_keys(text: bytes, end: int, lang: bytes, longest: int) -> tuple[pa.Array, pa.Array]:
    """Ascending distinct keys, with counts, of the words that begin before ``end`` and up to ``longest - 1`` words after each."""
    data = np.frombuffer(text.translate(_LOWER), np.uint8)
    kind = _KIND[np.frombuffer(text, np.uint8)]
    is_word = kind == 2
    edge = np.diff(is_word.astype(np.int8), prepend=0, append=0)
    begin, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    n = len(begin)
    piece = np.cumsum(kind == 0, dtype=np.int32)[begin] if n else np.empty(0, np.int32)
    offsets = np.concatenate(([0], np.cumsum(stop - begin))).astype(np.int32)
    values = pa.py_buffer(data[is_word].tobytes())
    columns = []
    for ahead in range(min(longest, n)):
        same = np.packbits(piece[ahead:] == piece[:n - ahead], bitorder="little").tobytes()
        words = pa.Array.from_buffers(pa.binary(), n - ahead, [pa.py_buffer(same), pa.py_buffer(offsets[ahead:].tobytes()), values])
        columns.append(pa.concat_arrays([words, pa.nulls(ahead, pa.binary())]))
    columns.append(pa.scalar(b"\x00" + lang, pa.binary()))
    keys = pc.binary_join_element_wise(*columns, pa.scalar(b"\x00", pa.binary()), null_handling="skip") if n else pa.array([], pa.binary())
    keys = keys.slice(0, int(np.searchsorted(begin, end)))
    keys = keys.take(pc.sort_indices(keys))
    first = np.ones(len(keys), bool)
    first[1:] = pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)
    start = np.flatnonzero(first)
    return keys.take(pa.array(start)), pa.array(np.diff(start, append=len(keys)), pa.int64())


def _heads(keys: pa.Array) -> np.ndarray:
    """The first ``HEAD`` bytes of each key, filled up with bytes 0."""
    offsets = np.frombuffer(keys.buffers()[1], np.int32)[keys.offset:keys.offset + len(keys) + 1].astype(np.int64)
    data = np.frombuffer(keys.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    heads = np.lib.stride_tricks.sliding_window_view(np.concatenate((data, np.zeros(HEAD, np.uint8))), HEAD)[offsets[:-1] - offsets[0]]
    size = np.diff(offsets)
    short = np.flatnonzero(size < HEAD)
    heads[short] *= np.arange(HEAD) < size[short, None]
    return heads.view(f"S{HEAD}").ravel()


def _ranges(keys: pa.Array, edges: np.ndarray) -> np.ndarray:
    """The number of each ascending key's range: how many of the ascending ``edges`` its head reaches."""
    at = np.searchsorted(_heads(keys), edges)
    return np.repeat(np.arange(len(edges) + 1, dtype=np.int32), np.diff(at, prepend=0, append=len(keys)))


def _keys_of(longest: int, bounds: list[bytes] | None):
    """Batches of (gram, n) with, where there are ``bounds``, the number of the gram's range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list[bytes]] = {}
        size = 0
        edges = None if bounds is None else np.array(bounds, f"S{HEAD}")

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, texts in waiting.items():
                for text, end in _stretches(b"\n".join(texts), longest):
                    keys, counts = count_keys(text, end, lang.encode(), longest)
                    columns = [keys, counts] if edges is None else [keys, counts, pa.array(_ranges(keys, edges))]
                    for at in range(0, len(keys), ROWS_AT_ONCE):
                        yield pa.RecordBatch.from_arrays([c.slice(at, ROWS_AT_ONCE) for c in columns], names=["gram", "n", "range"][:len(columns)])
            waiting.clear()

        for batch in batches:
            for text, lang in zip(utf8(batch.column("text")), batch.column("lang").to_pylist()):
                if text:
                    waiting.setdefault(NO_LANG if lang is None else lang, []).append(text)
                    size += len(text)
                    if size >= STRETCH:
                        yield from flush()
                        size = 0
        yield from flush()

    return run


def _range_bounds(texts: DataFrame, ranges: int, longest: int) -> list[bytes]:
    """Heads of keys that split the keys into about equal ranges, from a sample of texts that grows with ``ranges`` alone.

    They decide where a key is counted, never what the counts are.
    """
    rows = texts.count()
    sample = texts.sample(min(1.0, SAMPLED_TEXTS * ranges / rows), seed=1) if rows else texts
    heads = sample.mapInArrow(_keys_of(longest, None), "gram binary, n bigint").select(F.expr(f"substring(gram, 1, {HEAD})").alias("head"))
    found = np.sort(np.concatenate([_heads(c) for c in heads.toArrow().column(0).chunks] or [np.empty(0, f"S{HEAD}")]))
    return sorted({bytes(found[len(found) * i // ranges]) for i in range(1, ranges)}) if len(found) else []


def _prefixes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    """The byte strings from ``begin`` to ``end``."""
    size = end - begin
    offsets = np.concatenate(([0], np.cumsum(size)))
    at = np.repeat(begin - offsets[:-1], size) + np.arange(offsets[-1])
    return pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(data[at].tobytes())])


class Prefix:
    """The sums of a language's prefixes of one length in a sorted range; the last one of a batch runs on into the next."""

    def __init__(self, lang: str, words: int):
        self.lang, self.words = lang, words
        self.key: bytes | None = None
        self.sum = 0
        self.first = True

    def add(self, row: np.ndarray, key: pa.Array, sums: np.ndarray, least: int, out: list) -> dict[int, tuple[int, int]]:
        """Takes a batch's groups.  Sums that end at the range's begin, or ran on, go to ``out``; the others that are
        frequent are returned as row of their begin -> (place in ``key``, sum)."""
        i = 0
        if self.key is not None:
            if key[0].as_py() == self.key:
                self.sum += int(sums[0])
                i = 1
            if i == len(key):
                return {}
            self._end(least, out)
        if self.first and i + 1 < len(key):
            self.key, self.sum = key[i].as_py(), int(sums[i])
            self._end(least, out)
            i += 1
        self.key, self.sum = key[-1].as_py(), int(sums[-1])
        inner = i + np.flatnonzero(sums[i:-1] >= least)
        return {int(row[g]): (int(g), int(sums[g])) for g in inner}

    def _end(self, least: int, out: list) -> None:
        if self.first or self.sum >= least:
            out.append((self.lang, self.words, self.key, self.sum, 0))
        self.first = False

    def close(self, out: list) -> None:
        if self.key is not None:
            out.append((self.lang, self.words, self.key, self.sum, 0))


def _flow_rows(found: list[tuple[str, int, bytes, int, int]]) -> pa.RecordBatch:
    kinds = {"lang": pa.string(), "words": pa.int32(), "phrase": pa.string(), "n": pa.int64(), "same": pa.int32()}
    rows = [(lang, words, _phrase(key), n, same) for lang, words, key, n, same in found]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds.values())], names=list(kinds))


Groups = tuple[np.ndarray, pa.Array, np.ndarray]


def batch_groups(batch: pa.RecordBatch, longest: int) -> dict[str, list[Groups | None]]:
    """By language, for phrases of 0 to ``longest`` words: (first row, phrase, sum) of the groups of sorted rows that begin with it."""
    keys, counts = batch.column(0), batch.column(1).to_numpy()
    offsets = np.frombuffer(keys.buffers()[1], np.int32)[keys.offset:keys.offset + len(keys) + 1].astype(np.int64)
    data = np.frombuffer(keys.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    begin, stop = offsets[:-1], offsets[1:]
    marks = np.flatnonzero(data == 0)
    double = marks[:-1][np.diff(marks) == 1]
    end = double[np.searchsorted(double, begin)]  # a language may hold bytes 0 too; the first two in a row count
    langs = _prefixes(data, end + 2, stop).dictionary_encode()
    names = [x.decode() for x in langs.dictionary.to_pylist()]
    code = langs.indices.to_numpy()
    if len(names) > 1:  # a language's rows side by side, in their order
        order = np.argsort(code, kind="stable")
        begin, end, code, counts = begin[order], end[order], code[order], counts[order]
    first_mark = np.searchsorted(marks, begin)
    words = np.searchsorted(marks, end) - first_mark + 1
    out: dict[str, list[Groups | None]] = {name: [] for name in names}
    for level in range(longest + 1):
        rows = np.flatnonzero(words >= level)
        cut = end[rows].copy()
        if level:
            more = words[rows] > level
            cut[more] = marks[first_mark[rows[more]] + level - 1]
        else:
            cut = begin[rows]
        change = np.ones(len(rows), bool)
        if len(rows):
            phrase = _prefixes(data, begin[rows], cut)
            change[1:] = (code[rows][1:] != code[rows][:-1]) | pc.not_equal(phrase[1:], phrase[:-1]).to_numpy(zero_copy_only=False)
        start = np.flatnonzero(change)
        if len(start):
            phrase, sums, row = phrase.take(pa.array(start)), np.add.reduceat(counts[rows], start), rows[start]
        at = np.searchsorted(code[rows][start], np.arange(len(names) + 1))
        for i, name in enumerate(names):
            some = slice(at[i], at[i + 1])
            out[name].append((row[some], phrase[some], sums[some]) if at[i] < at[i + 1] else None)
    return out


def _flows_of(longest: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict[str, list[Prefix]] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            out: list[tuple[str, int, bytes, int, int]] = []
            for lang, groups in batch_groups(batch, longest).items():
                prefixes = state.setdefault(lang, [Prefix(lang, words) for words in range(longest + 1)])
                whole = [{} if g is None else prefix.add(*g, least, out) for prefix, g in zip(prefixes, groups)] + [{}]
                same: dict[int, int] = {}  # begin of a group -> how many shorter prefixes it stands for
                for words, (found, longer) in enumerate(zip(whole, whole[1:])):
                    going_on: dict[int, int] = {}
                    for row, (place, n) in found.items():
                        if row in longer and longer[row][1] == n:
                            going_on[row] = same.get(row, 0) + 1
                        else:
                            out.append((lang, words, groups[words][1][place].as_py(), n, same.get(row, 0)))
                    same = going_on
            yield _flow_rows(out)
        out = []
        for prefixes in state.values():
            for prefix in prefixes:
                prefix.close(out)
        yield _flow_rows(out)

    return run


def _first_words(words: str, count) -> F.Column:
    return F.array_join(F.slice(words, F.lit(1), count), " ")


def flows(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, words, phrase, n): every phrase of up to ``longest`` words that occurs ``least`` times in its language.

    The phrase of no words has the number of all the language's words.
    """
    texts = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = texts.mapInArrow(_keys_of(longest, _range_bounds(texts, ranges, longest)), "gram binary, n bigint, range int")
    ordered = keys.repartitionById(ranges, "range").select("gram", "n").sortWithinPartitions("gram")
    found = ordered.mapInArrow(_flows_of(longest, least), FLOW_SCHEMA)
    split = F.when(F.col("words") > 0, F.split("phrase", " ")).otherwise(F.array().cast("array<string>"))
    each = (found.select("lang", "n", split.alias("all"), F.explode(F.sequence(F.col("words") - F.col("same"), F.col("words"))).alias("words"))
            .select("lang", "words", F.when(F.col("words") > 0, _first_words("all", F.col("words"))).otherwise("").alias("phrase"), "n"))
    total = each.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"))
    return stored(total.where((F.col("n") >= least) | (F.col("words") == 0)), "phrase-counts")


def _merged(side: DataFrame) -> DataFrame:
    """A side of a join that grows with the corpus: never broadcast, though Spark, which sees the packed file and not what ``explode`` makes of it, may size it low."""
    return side.hint("merge")


def _wide(c: str) -> F.Column:
    return F.col(c).cast("decimal(20,0)")


def scored(counts: DataFrame) -> DataFrame:
    """Every phrase of two or more words with its weakest cut: (lang, words, phrase, a, l, r, score)."""
    phrases = counts.where("words >= 2").withColumnRenamed("n", "a")
    every = F.split("phrase", " ")
    cuts = (phrases.select("lang", "words", "phrase", "a", every.alias("all"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
            .select("lang", "words", "phrase", "a", "k", _first_words("all", F.col("k")).alias("left"),
                    F.array_join(F.slice("all", F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("right")))

    def deal(one_word) -> F.Column:
        return F.when(one_word, F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int")).otherwise(F.lit(0))

    parts = counts.where("words >= 1").select("lang", F.col("phrase").alias("part"), "n", F.explode(
        F.when(F.col("words") == 1, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))).alias("deal"))
    left = parts.select("lang", F.col("part").alias("left"), F.col("n").alias("l"), F.col("deal").alias("deal_left"))
    right = parts.select("lang", F.col("part").alias("right"), F.col("n").alias("r"), F.col("deal").alias("deal_right"))
    cuts = cuts.withColumn("deal_left", deal(F.col("k") == 1)).withColumn("deal_right", deal(F.col("words") - F.col("k") == 1))
    cuts = cuts.join(_merged(left), ["lang", "left", "deal_left"]).join(_merged(right), ["lang", "right", "deal_right"])
    # whole-number division of decimals; nothing is rounded
    value = F.expr(f"(cast({SCALE} as decimal(8,0)) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    weakest = F.min(F.struct(value.alias("score"), "k", "l", "r")).alias("cut")
    return (cuts.groupBy("lang", "words", "phrase", "a").agg(weakest)
            .select("lang", "words", "phrase", "a", "cut.l", "cut.r", "cut.score"))


def covered(counts: DataFrame, percent: int = COVER_PERCENT) -> DataFrame:
    """(lang, phrase) of the phrases that stand inside a longer one which has ``percent`` of their count."""
    longer = counts.where("words >= 3")
    size = F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("size")
    inside = (longer.select("lang", "n", "words", F.split("phrase", " ").alias("all"), size)
              .select("lang", "n", "all", "size", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)).alias("begin"))
              .groupBy("lang", F.array_join(F.slice("all", F.col("begin"), F.col("size")), " ").alias("phrase")).agg(F.max("n").alias("most")))
    own = counts.where("words >= 2").select("lang", "phrase", "n")
    return own.join(_merged(inside), ["lang", "phrase"]).where(_wide("most") * 100 >= _wide("n") * percent).select("lang", "phrase")


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, percent: int = COVER_PERCENT, top: int = TOP,
                 text: str = "text", lang: str = "lang") -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n and score."""
    counts = flows(docs, longest, least, text, lang)
    left = scored(counts).join(_merged(covered(counts, percent)), ["lang", "phrase"], "left_anti")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    best = left.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    words = counts.where("words = 0").select("lang", "n")
    return best.join(words, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of two to four words of each language of ``documents``."""
    return collocations(table(spark, sf_dir, "documents", "text", "lang"))


ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM words, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(w) >= m)
  GROUP BY ALL),
candidates AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE m > 1 AND f >= 30),
cuts AS (
  SELECT c.lang, c.m, c.phrase, a, k, x.f AS l, y.f AS r, (2000000::HUGEINT * a // (x.f + y.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates) c
  JOIN grams x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:k], ' ')
  JOIN grams y ON y.lang = c.lang AND y.phrase = array_to_string(w[k + 1:], ' ')),
weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_phrases AS (
  SELECT lang, a AS longer, array_to_string(w[i:i + s - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, m - s + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS s FROM candidates))),
kept AS (
  SELECT * FROM weakest c
  WHERE NOT EXISTS (FROM inner_phrases i WHERE i.lang = c.lang AND i.phrase = c.phrase AND 100 * i.longer >= 80 * c.a))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r,
       (SELECT sum(f) FROM grams g WHERE g.lang = kept.lang AND m = 1)::BIGINT AS n, score
FROM kept QUALIFY rank <= 2000
"""
