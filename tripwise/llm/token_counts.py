"""Token counts by a digest cache: every distinct text is encoded once, ever.

The cache is a Parquet table in a shared folder, one subfolder for each tokenizer
version (a digest of the tokenizer's file and its library's release) with the rows
(digest of the normalised text, number of tokens).  A run

1. writes each row's digest; copies are counted with map-side partial sums;
2. takes the digests that the cache lacks (anti join);
3. gathers one text for each missing digest (map-side first, so a text held by a
   third of all rows costs one row a task), encodes those and appends their counts;
4. joins the rows' digests to the cache.

Texts cross the network in step 3 alone, and only once.  Where few digests are
missing (``FEW_MISSING``, a bound on what is broadcast) the others' texts stay where
they are.  A digest with more than a thousandth of all rows, of which there are
fewer than a thousand, is looked up in a broadcast table in step 4, so that its rows
don't meet in one task.

Null and empty texts have no tokens.  Repeated rows each get a row.  A text held
twice in the cache (two runs at once) has the same count twice and counts once.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwise.llm.common import fresh, scratch_path, stored, stored_or_none, table

MODEL = public_tokenizers.path("byte_bpe_50k.json")
LIMIT = 512
#: missing digests up to which their set (about 60 bytes each) is broadcast
FEW_MISSING = 200_000
#: a digest with more than one in so many rows is hot; there are fewer than so many of them
HOT_SHARE = 1000
#: characters encoded at once; longer texts are cut where no token can reach across
STRETCH = 1 << 19
CACHE_SCHEMA = "digest binary, n_tokens bigint"

# a token of the byte-level pattern begins at a space between two letters, whatever stands around
_SURE_CUT = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")


class Tokenizer:
    """A public tokenizer's file with what its counts depend on: ``.json`` for tokenizers, ``.model`` for sentencepiece."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.content = f.read()
        self.kind = os.path.splitext(path)[1]
        if self.kind == ".json":
            import tokenizers as library
        elif self.kind == ".model":
            import sentencepiece as library
        else:
            raise ValueError(f"no library for {path}")
        self.version = hashlib.sha256(f"{library.__name__} {library.__version__}\n".encode() + self.content).hexdigest()

    def counter(self) -> Callable[[list[str]], list[int]]:
        """Counts the tokens of texts, without begin, end or added special tokens."""
        if self.kind == ".model":
            import sentencepiece
            model = sentencepiece.SentencePieceProcessor(model_proto=self.content)
            return lambda texts: list(map(len, model.encode(texts, num_threads=1)))
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one thread
        import tokenizers
        model = tokenizers.Tokenizer.from_str(self.content.decode())
        model.no_truncation()
        model.no_padding()
        return lambda texts: list(map(len, model.encode_batch_fast(texts, add_special_tokens=False)))

    def may_cut(self) -> bool:
        """Whether counts of the parts of a text cut at ``_SURE_CUT`` add up to that of the text."""
        if self.kind != ".json":
            return False
        spec = json.loads(self.content)
        before = spec.get("pre_tokenizer") or {}
        return (before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
                and not spec.get("normalizer") and not any(t["lstrip"] or t["rstrip"] or " " in t["content"] for t in spec["added_tokens"]))


def parts(text: str, cut: bool) -> Iterator[str]:
    """The text, in parts of about ``STRETCH`` characters where it may be cut."""
    begin = 0
    while cut and len(text) - begin > STRETCH:
        found = _SURE_CUT.search(text, begin + STRETCH)
        if not found:
            break
        yield text[begin:found.start()]
        begin = found.start()
    yield text[begin:]


def count_texts(texts: list[str], count: Callable[[list[str]], list[int]], cut: bool) -> np.ndarray:
    """Numbers of tokens, with about ``STRETCH`` characters at a time in the library."""
    out = np.zeros(len(texts), np.int64)
    owner, waiting, size = [], [], 0
    for i, text in enumerate(texts):
        for part in parts(text, cut):
            owner.append(i)
            waiting.append(part)
            size += len(part)
            if size >= STRETCH:
                np.add.at(out, owner, count(waiting))
                owner, waiting, size = [], [], 0
    if waiting:
        np.add.at(out, owner, count(waiting))
    return out


def normalised(text: str) -> Column:
    """What the digest is taken of.  The byte-level models tell every character apart, so only null changes."""
    return F.coalesce(F.col(text), F.lit(""))


def content_digest(text: str) -> Column:
    return F.unhex(F.sha2(normalised(text).cast("binary"), 256))


def cache_path(cache: str, tokenizer: Tokenizer) -> str:
    return f"{cache.rstrip('/')}/tokenizer={tokenizer.version}"


def cached(spark: SparkSession, cache: str, tokenizer: Tokenizer) -> DataFrame | None:
    """(digest, n_tokens), one row a digest; None before the first count with this tokenizer version."""
    found = stored_or_none(spark, cache_path(cache, tokenizer), CACHE_SCHEMA)
    return None if found is None else found.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def encode_missing(df: DataFrame, digests: DataFrame, cache: str, tokenizer: Tokenizer, text: str = "text") -> int:
    """Appends the counts of those of ``digests`` (distinct) that the cache lacks; ``df`` holds their texts."""
    spark = df.sparkSession
    known = cached(spark, cache, tokenizer)
    missing = digests.select("digest")
    if known is not None:
        missing = stored(missing.join(known, "digest", "left_anti"), "missing-digests")
    n_missing = missing.count()
    if not n_missing:
        return 0
    texts = df.select(content_digest(text).alias("digest"), normalised(text).alias("text"))
    few = known is not None and n_missing <= FEW_MISSING
    if few:
        texts = texts.join(F.broadcast(missing), "digest", "left_semi")
    texts = texts.groupBy("digest").agg(F.first("text").alias("text"))
    if known is not None and not few:
        texts = texts.join(missing, "digest", "left_semi")
    shared = spark.sparkContext.broadcast(tokenizer)  # a file of a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, cut = shared.value.counter(), shared.value.may_cut()
        for batch in batches:
            n = count_texts(batch.column("text").to_pylist(), count, cut)
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(n)], names=["digest", "n_tokens"])

    texts.mapInArrow(run, CACHE_SCHEMA).write.mode("append").parquet(cache_path(cache, tokenizer))
    return n_missing


def token_counts(df: DataFrame, cache: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text", model: str = MODEL) -> DataFrame:
    """``keep``, ``n_bytes`` (of the text in UTF-8) and ``n_tokens`` of every row; fills the cache on the way.

    A kept column with one of the two new names gives way to the new one.
    """
    tokenizer = Tokenizer(model)
    keep = tuple(c for c in keep if c not in ("n_bytes", "n_tokens"))
    digest, hot_count = fresh("digest", keep), fresh("hot_tokens", keep)
    rows = stored(df.select(*keep, F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
                            content_digest(text).alias(digest)), "text-digests")
    copies = stored(rows.groupBy(F.col(digest).alias("digest")).agg(F.count(F.lit(1)).alias("copies")), "text-copies")
    encode_missing(df, copies, cache, tokenizer, text)
    counts = cached(df.sparkSession, cache, tokenizer)
    if counts is None:  # no row at all
        return rows.select(*keep, "n_bytes", F.lit(0).cast("long").alias("n_tokens"))
    counts = counts.select(F.col("digest").alias(digest), "n_tokens")
    total = copies.agg(F.sum("copies").alias("n")).first()["n"] or 0
    hot = copies.where(F.col("copies") * HOT_SHARE > total).select(F.col("digest").alias(digest))
    hot = stored(hot.join(counts, digest).withColumnRenamed("n_tokens", hot_count), "hot-texts")
    looked_up = rows.join(F.broadcast(hot), digest, "left")
    hot_rows = looked_up.where(F.col(hot_count).isNotNull()).select(*keep, "n_bytes", F.col(hot_count).alias("n_tokens"))
    others = rows.join(F.broadcast(hot), digest, "left_anti").join(counts, digest).select(*keep, "n_bytes", "n_tokens")
    return hot_rows.unionByName(others)


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: bytes, tokens of the byte-level model, and whether there are more than 512 of them."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = token_counts(docs, scratch_path(spark, "token-cache"))
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))
