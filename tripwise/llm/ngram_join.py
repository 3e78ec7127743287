"""N-gram Jaccard join: a blocked sparse product of the document by n-gram matrix, pruned by size-derived bounds.

A document is the set of its distinct word n-grams; documents with equal sets are
one row of the incidence matrix.  Two rows can only link if their overlap reaches
``t * size`` of each, so at most ``size - ceil(t * size)`` of a row's columns may
be its own alone.  Rows beyond that bound leave (first on a fixed share of the
columns chosen by hash, then on all), which empties most of the matrix.

Which entries of the product can matter is told by each row's rarest columns
(``size - ceil(t * size) + 1`` of them: two rows that link share one).  Within a
column, rows are first paired with one of them only, chosen alike in all columns.
What that links is one component; then pairs of rows in different components
follow, if parities of the rows (a column flips one bit, so two rows differ in no
more bits than columns) leave a link possible.  Of these pairs, too, each row's
first few are settled before the others, of which those inside one component then
need no look.  So no link is lost, and copies of one text, exact or near, never make
all their pairs.

The entries are accumulated over parts of the columns in turn: a pair's two rows
meet with their columns of the part, and those that they share are counted, so
that a part makes one row for each pair and not for each common column.  After each part, pairs go whose count, with what their rows' sizes in the blocks of
columns to come allow, cannot reach the overlap that both sizes need; the count
over all parts is the overlap.  The pairs of one row are dealt into blocks.

Null and empty texts have no n-grams and link with nothing; rows with a
null id get a size and no component.  Equal ids are one document in the links.
N-grams are compared by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwise.llm.common import add_columns, stored, table, utf8
from tripwise.llm.components import connected_components
from tripwise.llm.set_pairs import PAIRS_PER_TASK, least_overlap, needed_overlap
from tripwise.llm.words import distinct, mix, shingles, white_space_splitter

NGRAM, PERCENT = 3, 90
#: one in so many columns is looked at first
FIRST_SHARE = 4
#: blocks of columns whose sizes bound the product
COLUMN_BLOCKS = 64
#: blocks of columns that one part of the product takes
PART_BLOCKS = 16
#: bits of a row's parity
PARITY_BITS = 1024


def _key(numbers: np.ndarray) -> int:
    """Hash of a whole set, from its ascending numbers."""
    with np.errstate(over="ignore"):
        place = mix(np.arange(1, len(numbers) + 1, dtype=np.uint64)) | np.uint64(1)
        total = (mix(numbers ^ np.uint64(0x5851F42D4C957F2D)) * place).sum(dtype=np.uint64, keepdims=True)
    return int(mix(total).view(np.int64)[0])


def _parity(numbers: np.ndarray) -> np.ndarray:
    """``PARITY_BITS`` bits, each flipped by every number that falls on it."""
    place = (numbers >> np.uint64(16)) % np.uint64(PARITY_BITS)
    return np.packbits(np.bincount(place.astype(np.int64), minlength=PARITY_BITS).astype(np.uint8) & 1).view(np.int64)


def ngram_sets(docs: DataFrame, ngram: int, share: int | None, text: str = "text") -> DataFrame:
    """Every row without its text, with ``ng_size`` and ``ng_key`` of its n-gram set and, given a share,
    ``ng_columns``: those n-grams whose hash falls into one of ``share`` parts (1: all), and ``ng_blocks``:
    how many n-grams lie in each block of columns; whole rows (share 1) have ``ng_parity`` too."""
    fields = [T.StructField("ng_size", T.LongType()), T.StructField("ng_key", T.LongType())]
    if share is not None:
        fields += [T.StructField("ng_columns", T.ArrayType(T.LongType())), T.StructField("ng_blocks", T.ArrayType(T.IntegerType()))]
    if share == 1:
        fields.append(T.StructField("ng_parity", T.ArrayType(T.LongType())))

    def make():
        split = white_space_splitter()

        def compute(batch: pa.RecordBatch) -> list[pa.Array]:
            sizes, keys, columns, counts, parities = [], [], [], [], []
            for value in utf8(batch.column(text)):
                own = distinct(shingles(split(value)[0], ngram)) if value else np.empty(0, np.uint64)
                sizes.append(len(own))
                keys.append(_key(own) if len(own) else None)
                if share is not None:
                    counts.append(np.bincount((own % np.uint64(COLUMN_BLOCKS)).astype(np.int64), minlength=COLUMN_BLOCKS).astype(np.int32))
                    if share == 1:
                        parities.append(_parity(own))
                    columns.append(own.view(np.int64) if share == 1 else own[(own >> np.uint64(32)) % np.uint64(share) == 0].view(np.int64))
            out = [pa.array(sizes, pa.int64()), pa.array(keys, pa.int64())]
            if share is not None:
                ends = np.cumsum([0] + [len(c) for c in columns]).astype(np.int32)
                flat = np.concatenate(columns) if columns else np.empty(0, np.int64)
                out.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64())))
                out.append(pa.array([c.tolist() for c in counts], pa.list_(pa.int32())))
            if share == 1:
                out.append(pa.array([p.tolist() for p in parities], pa.list_(pa.int64())))
            return out

        return compute

    return add_columns(docs, fields, make, drop=(text,))


def _alone(cells: DataFrame) -> DataFrame:
    """(key, own): how many columns of a row hold no other row; rows without such columns are absent."""
    # all partial aggregates: a column that very many rows share is one row per task
    columns = cells.groupBy("column").agg(F.min("key").alias("key"), F.max("key").alias("other")).where("key = other")
    return columns.groupBy("key").agg(F.count("*").alias("own"))


def _within_bound(rows: DataFrame, cells: DataFrame, percent: int) -> DataFrame:
    """Rows (key, size) whose own columns leave enough for the overlap."""
    return (rows.join(_alone(cells), "key", "left")
            .where(F.coalesce("own", F.lit(0)) <= F.col("size") - least_overlap(F.col("size"), percent)).select("key", "size"))


def _at_most(first: int):
    """The columns that two rows can share from block ``first`` on, by their sizes in the blocks."""
    rest = lambda name: F.slice(name, first + 1, COLUMN_BLOCKS)
    return F.aggregate(F.zip_with(rest("blocks_a"), rest("blocks_b"), lambda x, y: F.least(x, y)), F.lit(0), lambda total, x: total + x)


def product(pairs: DataFrame, matrix: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b) of keys those that link, by their overlaps accumulated over the matrix (key, size, columns, blocks)."""
    begins = range(0, COLUMN_BLOCKS, PART_BLOCKS)
    deals = pairs.groupBy("a").agg(F.floor((F.count("*") - 1) / PAIRS_PER_TASK).cast("int").alias("last"))
    dealt = pairs.join(deals, "a").select("a", F.pmod(F.xxhash64("b"), F.col("last") + 1).cast("int").alias("deal"), "b")
    of = lambda name: matrix.select(F.col("key").alias(name), F.col("size").alias("size_" + name), F.col("blocks").alias("blocks_" + name))
    first = dealt.select("a", "deal").distinct().join(of("a"), "a")
    needed = needed_overlap(F.col("size_a"), F.col("size_b"), percent)
    entries = (dealt.join(of("b"), "b").join(first, ["a", "deal"]).where(F.least("size_a", "size_b") >= needed)
               .select("a", "deal", "b", needed.alias("needed"), F.array(*[_at_most(i) for i in (*begins, COLUMN_BLOCKS)]).alias("at_most"))
               .where(F.col("at_most")[0] >= F.col("needed")).withColumn("overlap", F.lit(0).cast("long")))
    entries = stored(entries, "ngram-entries")

    def inside(begin: int):
        block = lambda column: F.pmod(column, F.lit(COLUMN_BLOCKS))
        return F.filter("columns", lambda column: (block(column) >= begin) & (block(column) < begin + PART_BLOCKS))

    # the rows in question, a list of columns for each part
    wanted = entries.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    parts = stored(matrix.join(wanted, "key", "left_semi").select("key", *[
        inside(begin).alias(f"part_{begin}") for begin in begins]), "ngram-parts")
    for part, begin in enumerate(begins):
        cells = lambda name: parts.select(F.col("key").alias(name), F.col(f"part_{begin}").alias(f"cells_{name}"))
        rows_a = entries.select("a", "deal").distinct().join(cells("a"), "a")
        entries = stored(entries.join(cells("b"), "b").join(rows_a, ["a", "deal"])
                         .withColumn("overlap", F.col("overlap") + F.size(F.array_intersect("cells_a", "cells_b")))
                         .where(F.col("overlap") + F.col("at_most")[part + 1] >= F.col("needed"))
                         .select("a", "deal", "b", "needed", "at_most", "overlap"), "ngram-entries")
    return entries.select("a", "b")


def _some(pairs: DataFrame) -> DataFrame:
    """Of the pairs (a, b) a few for each row: with its first and last partner, and with the first by two hashes."""
    both = pairs.select(F.col("a").alias("v"), F.col("b").alias("n")).union(pairs.select("b", "a"))
    first = lambda seed: F.min(F.struct(F.xxhash64("n", F.lit(seed)), "n"))["n"]
    met = both.groupBy("v").agg(F.array(F.min("n"), F.max("n"), first(1), first(2)).alias("n")).select("v", F.explode("n").alias("n"))
    return met.select(F.least("v", "n").alias("a"), F.greatest("v", "n").alias("b")).distinct()


def _between(pairs: DataFrame, named: DataFrame) -> DataFrame:
    """The pairs (a, b) whose rows are in different components."""
    for name in ("a", "b"):
        own = named.select(F.col("vertex").alias(name), F.col("component").alias("of_" + name))
        pairs = pairs.join(own, name, "left").withColumn("of_" + name, F.coalesce("of_" + name, name))
    return pairs.where("of_a <> of_b").select("a", "b")


def link_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ngram: int = NGRAM, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(every row without its text, with ng_size and ng_key; components (key, component) of the linked keys)."""
    source = docs.select(doc_id, text)
    # one pass gives the sets' sizes and names, and the columns of the first look
    first = ngram_sets(source, ngram, FIRST_SHARE, text).where("ng_key IS NOT NULL")
    seen = stored(ngram_sets(source, ngram, None, text), "ngram-rows")
    rows = seen.where("ng_key IS NOT NULL").groupBy(F.col("ng_key").alias("key")).agg(
        F.max("ng_size").alias("size"), F.min(doc_id).alias("id"))
    cells = first.select(F.col("ng_key").alias("key"), F.explode("ng_columns").alias("column"))
    left = _within_bound(rows, cells, percent)

    # whole rows of what is left, one document each
    chosen = left.join(rows.select("key", "id"), "key").where("id IS NOT NULL").select(F.col("id").alias(doc_id)).distinct()
    chosen = stored(chosen, "ngram-chosen")  # of known size, so that texts are shuffled only where it is too large to broadcast
    whole = ngram_sets(source.join(chosen, doc_id, "left_semi"), ngram, 1, text).where("ng_key IS NOT NULL")
    whole = whole.select(F.col("ng_key").alias("key"), F.col("ng_size").alias("size"), F.col("ng_columns").alias("columns"), F.col("ng_blocks").alias("blocks"),
                         F.col("ng_parity").alias("parity"))
    whole = stored(whole.dropDuplicates(["key"]), "ngram-matrix")
    cells = whole.select("key", F.explode("columns").alias("column"))
    left = stored(_within_bound(whole.select("key", "size"), cells, percent), "ngram-left")

    # the rarest columns of each row; columns of one row alone come first and meet nothing
    cells = cells.join(left.select("key"), "key", "left_semi")
    shared = cells.groupBy("column").agg(F.count("*").alias("rows")).where("rows > 1")
    ranked = cells.join(shared, "column").groupBy("key").agg(F.sort_array(F.collect_list(F.struct("rows", "column"))).alias("ranked"))
    ranked = ranked.join(left, "key").withColumn("own", F.col("size") - F.size("ranked")).withColumn(
        "taken", (F.col("size") - least_overlap(F.col("size"), percent) + 1 - F.col("own")).cast("int"))
    rare = (ranked.where("taken > 0").select("key", "size", "own", F.posexplode(F.slice("ranked", F.lit(1), F.col("taken"))).alias("rank", "cell"))
            .select(F.col("cell.column").alias("column"), "key", "size", (F.col("own") + F.col("rank")).alias("place")))
    rare = stored(rare, "ngram-rare")

    # within a column each row meets the row whose hash is smallest
    order = F.struct(F.xxhash64("key"), "key", "size")
    chief = rare.groupBy("column").agg(F.min(order).alias("chief")).select("column", F.col("chief.key").alias("a"), F.col("chief.size").alias("size_a"))
    near = (100 * F.least("size", "size_a") >= percent * F.greatest("size", "size_a"))
    pairs = stored(rare.join(chief, "column").where((F.col("key") != F.col("a")) & near).select("a", F.col("key").alias("b")).distinct(), "ngram-pairs")
    links = product(pairs, whole, percent)

    # pairs across components, where bounds from sizes, places and parities leave a link possible
    named = connected_components(links)
    placed = rare.join(named.withColumnRenamed("vertex", "key"), "key", "left").withColumn("component", F.coalesce("component", "key"))
    mixed = placed.groupBy("column").agg(F.min("component").alias("one"), F.max("component").alias("two")).where("one <> two").select("column")
    placed = stored(placed.join(mixed, "column", "left_semi").join(whole.select("key", "parity"), "key"), "ngram-mixed")
    other = placed.select("column", *[F.col(c).alias(c + "_b") for c in ("key", "size", "place", "component", "parity")])
    needed = needed_overlap(F.col("size"), F.col("size_b"), percent)
    flipped = [F.bit_count(F.col("parity")[i].bitwiseXOR(F.col("parity_b")[i])) for i in range(PARITY_BITS // 64)]
    rest = (placed.join(other, "column")
            .where((F.col("key") < F.col("key_b")) & (F.col("component") != F.col("component_b"))
                   & (F.least("size", "size_b") >= needed) & (F.col("size") - F.col("place") >= needed)
                   & (F.col("size_b") - F.col("place_b") >= needed) & (sum(flipped[1:], flipped[0]) <= F.col("size") + F.col("size_b") - 2 * needed))
            .select(F.col("key").alias("a"), F.col("key_b").alias("b")).distinct())
    tested = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = stored(rest.join(tested, ["a", "b"], "left_anti"), "ngram-rest")
    # a few partners of each row first, which make one component of most near copies; then what is still between components
    for last in (False, True):
        if not rest.head(1):
            break
        some = rest if last else stored(_some(rest), "ngram-some")
        more = product(some, whole, percent)
        if more.head(1):
            links = links.union(more)
            named = connected_components(links)
        if not last:
            rest = stored(_between(rest.join(some, ["a", "b"], "left_anti"), named), "ngram-rest")
    found = named
    return seen, found.select(F.col("vertex").alias("key"), "component")


def join_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ngram: int = NGRAM, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs``: its id, ``n_shingles`` and ``component_id``, the smallest id that links reach."""
    seen, found = link_rows(docs, doc_id, text, ngram, percent)
    keys = seen.groupBy(F.col("ng_key").alias("key")).agg(F.min(doc_id).alias("least"), F.count("*").alias("n"))
    # the components' smallest ids; keys of one document alone need no row
    named = keys.where("key IS NOT NULL").join(found, "key", "left").withColumn("component", F.coalesce("component", "key"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"), F.sum("n").alias("members"))
    groups = named.join(least.where("members > 1"), "component").select(F.col("key").alias("ng_key"), "component_id")
    return (seen.join(groups, "ng_key", "left")
            .select(doc_id, F.col("ng_size").alias("n_shingles"),
                    F.when(F.col(doc_id).isNotNull(), F.coalesce("component_id", doc_id)).alias("component_id")))


def op7_ngram_join(spark, sf_dir: str) -> DataFrame:
    """Per document: the size of its set of 3-word shingles and its component under Jaccard 0.9."""
    return join_components(table(spark, sf_dir, "documents", "doc_id", "text"))
