"""Importance resampling towards a target distribution.

Every text is a bag of hashed word features.  From the feature counts of the raw
texts and of the target texts each bucket gets a gain (a log ratio, in thousandths);
a text's weight is the mean gain of its features, looked up in one array of a fixed
number of buckets.  Gumbel noise, drawn from the id, is added to the weight, and the
highest scores are the sample.

The cutoff is found without sorting all scores: a quantile sketch gives a bracket
that should hold it, exact counts of the rows above and inside the bracket either
prove that it does or widen it, and only the bracket's rows are sorted.  Drawn rows
are numbered in sorted ranges, which need no row in one place.

Null and empty texts have no features and weight 0.  A null id draws its noise as an
empty one and comes last among equal scores.  Repeated rows have the same score and
stand next to each other in the order; at the cutoff as many of them are drawn as
there is room for.  Empty targets or raw texts give gains from the smoothing alone.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwise.functions.keys import with_consecutive_ids
from tripwise.llm.common import add_columns, fresh, stored, table, utf8

BUCKETS, NGRAM, SEED = 10_000, 1, 2024
LEAST_WORDS, PERCENT = 20, 10
#: the sketch's size; its ranks are then off by less than 0.2 % as a rule
SKETCH_K = 2_000
#: half the first bracket's width, as a share of the rows
FIRST_MARGIN = 0.005
#: bytes of a text split into words at once
STRETCH = 1 << 20

# A-Z fold to a-z; bytes other than 0-9, a-z and those of characters beyond ASCII separate words
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def word_lists(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, some ``STRETCH`` bytes at a time."""
    folded, begin = text.translate(_FOLD), 0
    while begin < len(folded):
        end = folded.find(b" ", begin + STRETCH)
        end = len(folded) if end < 0 else end
        yield folded[begin:end].split()
        begin = end


def features(text: bytes, ngram: int) -> Iterator[tuple[int, list[bytes]]]:
    """(number of words, the runs of 1 to ``ngram`` words that end in them) for each stretch of a text."""
    before: list[bytes] = []
    for words in word_lists(text):
        runs, every = list(words), before + words
        for n in range(2, ngram + 1):
            runs.extend(b" ".join(every[i - n + 1:i + 1]) for i in range(max(len(before), n - 1), len(every)))
        before = every[max(0, len(every) - ngram + 1):] if ngram > 1 else []
        yield len(words), runs


def _buckets(runs: list[bytes], buckets: int) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, runs), np.int64, len(runs)) % buckets


def bucket_counts(df: DataFrame, text: str = "text", ngram: int = NGRAM, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket; every task adds up its own first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for value in utf8(batch.column(0)):
                for _, runs in features(value or b"", ngram):
                    np.add.at(total, _buckets(runs, buckets), 1)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    rows = df.select(text).mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    for row in rows.collect():  # one row a bucket
        out[row.bucket] = row.n
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket the floor of 1000 ln of the smoothed target share over the smoothed raw share."""
    raw_all, target_all, buckets = int(raw.sum()), int(target.sum()), len(raw)
    return np.array([math.floor(1000 * math.log((int(t) + 1) * (raw_all + buckets) / ((int(s) + 1) * (target_all + buckets))))
                     for s, t in zip(raw, target)], np.int64)


def noise(key: str, seed: int) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of a digest of seed and id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))) * F.lit(-1000.0)).cast("bigint")


def scored(df: DataFrame, gain: np.ndarray, key: str = "doc_id", text: str = "text", ngram: int = NGRAM, seed: int = SEED) -> DataFrame:
    """Every row's ``key`` with ``n_words``, ``n_features``, ``weight`` and ``score``."""
    shared = df.sparkSession.sparkContext.broadcast(gain)  # one number a bucket

    def make():
        value = shared.value

        def compute(batch: pa.RecordBatch) -> list[pa.Array]:
            rows = []
            for data in utf8(batch.column("dsir_text")):
                n_words = n = total = 0
                for w, runs in features(data or b"", ngram):
                    n_words, n, total = n_words + w, n + len(runs), total + int(value[_buckets(runs, len(value))].sum())
                rows.append((n_words, n, total // n if n else 0))
            return [pa.array([r[i] for r in rows], pa.int64()) for i in range(3)]

        return compute

    new = [T.StructField(n, T.LongType()) for n in ("n_words", "n_features", "weight")]
    found = add_columns(df.select(F.col(key).alias("dsir_key"), F.col(text).alias("dsir_text")), new, make, drop=("dsir_text",))
    return found.withColumn("score", F.col("weight") + noise("dsir_key", seed)).withColumnRenamed("dsir_key", fresh(key, [f.name for f in new] + ["score"]))


def bracket(scores: DataFrame, n: int, k: int, margin: float = FIRST_MARGIN) -> tuple[int | None, int | None, int]:
    """(lowest, highest score of a bracket that holds the ``k`` th highest of ``n`` scores, rows above it).

    A bound of None is open.  The sketch proposes, the counts decide; each try is four times as wide.
    """
    sketch = scores.agg(F.kll_sketch_agg_bigint("score", F.lit(SKETCH_K)).alias("sketch")).first()["sketch"]
    one = scores.sparkSession.range(1).select(F.lit(bytes(sketch)).alias("sketch"))
    while True:
        low, high = 1 - k / n - margin, 1 - k / n + margin
        at = one.select(F.kll_sketch_get_quantile_bigint("sketch", F.lit(max(low, 0.0))).alias("low"),
                        F.kll_sketch_get_quantile_bigint("sketch", F.lit(min(high, 1.0))).alias("high")).first()
        lowest, highest = (at["low"] if low > 0 else None), (at["high"] if high < 1 else None)
        above = F.lit(False) if highest is None else F.col("score") > highest
        below = F.lit(False) if lowest is None else F.col("score") < lowest
        seen = scores.agg(F.count_if(above).alias("above"), F.count_if(~above & ~below).alias("inside")).first()
        if seen["above"] < k <= seen["above"] + seen["inside"]:
            return lowest, highest, seen["above"]
        margin *= 4


def _numbered(rows: DataFrame, key: str) -> DataFrame:
    """``place_in`` = 1, 2, ... by score from the highest, then key; the row's own place keeps equal rows apart."""
    order = F.struct(-F.col("score"), F.col(key).isNull(), F.col(key), F.col("place"))
    return with_consecutive_ids(rows.withColumn("order", order), "order", "place_in").drop("order")


def drawn(scores: DataFrame, key: str, least_words: int = LEAST_WORDS, percent: int = PERCENT, margin: float = FIRST_MARGIN) -> DataFrame:
    """All rows of ``scored`` with ``rank``: 1, 2, ... for the highest ``percent`` of the rows with enough words, else null."""
    scores = stored(scores.withColumn("place", F.monotonically_increasing_id()), "importance-scores")
    enough = F.col("n_words") >= least_words
    fit = scores.where(enough)
    n = fit.count()
    k = percent * n // 100
    no_rank = F.lit(None).cast("bigint")
    if not k:
        return scores.withColumn("rank", no_rank).drop("place")
    lowest, highest, above = bracket(fit, n, k, margin)
    over = F.lit(False) if highest is None else enough & (F.col("score") > highest)
    under = F.lit(False) if lowest is None else F.col("score") < lowest
    inside = _numbered(scores.where(enough & ~over & ~under), key)
    place = F.col("place_in")
    inside = inside.withColumn("rank", F.when(place <= k - above, place + above)).drop("place_in")
    over_rows = _numbered(scores.where(over), key).withColumnRenamed("place_in", "rank")
    rest = scores.where(~enough | under).withColumn("rank", no_rank)
    return rest.unionByName(inside).unionByName(over_rows).drop("place")


def resample(df: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text", ngram: int = NGRAM,
             buckets: int = BUCKETS, seed: int = SEED, least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """Every row of ``df``: its key, n_words, n_features, weight, score and rank in the sample (null: not drawn)."""
    gain = gains(bucket_counts(df, text, ngram, buckets), bucket_counts(target, target_text, ngram, buckets))
    found = scored(df, gain, key, text, ngram, seed)
    return drawn(found, found.columns[0], least_words, percent)


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: features, weight, score, and its rank among those drawn towards ``benchmark``."""
    found = resample(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "text"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


#: crc32 is spelled out, as DuckDB has none
ORACLE = r"""
WITH steps AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b::BIGINT, range(8)),
           lambda c, i: if(c % 2 = 1, xor(c // 2, 3988292384), c // 2))) AS t),
bag AS (
  SELECT kind, id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
  FROM (SELECT 'raw' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'target', item_id, text FROM benchmark)),
bytes AS (SELECT word, hex(encode(word)) AS x FROM (SELECT DISTINCT word FROM bag)),
hashed AS (
  SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(x), 2), lambda i: ('0x' || x[i:i + 1])::BIGINT)),
                     lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])), 4294967295) % 10000 AS bucket
  FROM bytes, steps),
cells AS (
  SELECT bucket, count(*) FILTER (kind = 'raw') AS s, count(*) FILTER (kind = 'target') AS t FROM bag JOIN hashed USING (word) GROUP BY ALL),
gain AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM cells) + 10000)::DOUBLE
                                 / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM cells) + 10000)::DOUBLE)))::BIGINT AS g FROM cells),
weighed AS (
  SELECT id, count(*) AS n, floor(sum(g)::DOUBLE / count(*))::BIGINT AS w
  FROM bag JOIN hashed USING (word) JOIN gain USING (bucket) WHERE kind = 'raw' GROUP BY id),
noise AS (
  SELECT doc_id, coalesce(n, 0) AS n, coalesce(w, 0) AS w, ('0x' || substr(sha256('2024:' || doc_id::VARCHAR), 1, 8))::BIGINT AS h
  FROM documents LEFT JOIN weighed ON id = doc_id),
scores AS (SELECT doc_id, n, w, w + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM noise),
ordered AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS fit FROM scores WHERE n >= 20)
SELECT s.doc_id, n::BIGINT AS n_features, w AS weight, score, if(place <= 10 * fit // 100, place, NULL)::BIGINT AS rank
FROM scores s LEFT JOIN ordered o ON o.doc_id = s.doc_id
"""
