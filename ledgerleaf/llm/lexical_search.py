r"""Ranked lexical search by dense blocked matrix products.

Terms are runs of ASCII letters, digits and characters beyond ASCII, with A-Z
lower-cased. An item's score of a document is the sum of
``weight(term) * impact(document, term)`` over its terms, repeats included:
a product of an item matrix (terms x counts and weights) and an impact matrix.

1. The items' terms become a vocabulary. One pass over the documents keeps, for
   each, its length and the counts of vocabulary terms, and writes them.
2. Document counts of terms, the number of documents and their length come from
   that table; weights follow on the driver (one number per vocabulary term).
3. The table is read once more. Items are taken in tiles of ``ITEM_ROWS``, the
   terms of a tile in tiles of ``TERM_ROWS``, documents in tiles of ``DOC_ROWS``;
   each meeting is one BLAS product in float64. All numbers are whole, and
   ``exact_product`` splits weights so that no partial sum reaches 2^53: results
   are exact, whatever the order of the additions. Tiles add up in int64.
4. A task keeps the best ``k`` of each item, comparing score and identifier, so
   ties at the edge are settled alike in every order of tiles. What tasks found
   meets in two steps, first by a hash of the document, so that no task reads
   all candidates of an item.

Memory holds one tile of either kind and ``k`` rows per item. What is broadcast
is bounded: items are taken in passes of at most ``PASS_PAIRS`` distinct
(item, term) pairs (one item beyond that has a pass of its own), however many
there are. Terms are compared by a 64-bit hash within the vocabulary.

Defined cases: a null or empty text has no terms; such a document does not count
and is never found, such an item finds nothing. Rows sharing an item identifier
(null included) are one item with the terms of all. Each document row counts on
its own, even if it repeats; among equal scores a null identifier comes first,
then the smaller. Identifiers of documents are whole numbers. Without documents
or items the result is empty. Further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerleaf.llm import words as W
from ledgerleaf.llm.mapping import map_texts
from ledgerleaf.llm.registry import query, table
from ledgerleaf.operators.ordered import running
from ledgerleaf.scratch import materialize

TOP = 10
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

PASS_PAIRS = 1 << 18
ITEM_ROWS, TERM_ROWS, DOC_ROWS = 256, 2048, 256
#: An impact is below this: 10^9 tf / (1000 tf + 8 m) with m of at least 25.
MOST_IMPACT = 10**6
#: Doubles hold every whole number up to here.
EXACT = 1 << 53
#: Groups of candidates that an item's best are chosen from before they meet.
SALTS = 64


@dataclass
class Items:
    """Items as rows of a sparse matrix over a vocabulary of hashed terms."""

    ids: list
    row: np.ndarray  # of each entry, ascending
    term: np.ndarray
    count: np.ndarray
    hashes: np.ndarray  # of the vocabulary, ascending

    @classmethod
    def of(cls, pairs: list) -> Items:
        """From rows (item_id, term, n)."""
        ids = sorted({p.item_id for p in pairs}, key=lambda i: (i is not None, i))
        at = {item: i for i, item in enumerate(ids)}
        data, offsets = W.joined([p.term.encode("utf-8", "surrogateescape") for p in pairs])
        hashed, _ = W.hash_words(data, offsets, W.NOT_ALNUM) if pairs else (np.zeros(0, np.uint64), None)
        vocabulary, term = np.unique(hashed, return_inverse=True)
        row = np.array([at[p.item_id] for p in pairs], np.int64)
        order = np.lexsort((term, row))
        count = np.array([p.n for p in pairs], np.int64)
        return cls(ids, row[order], term[order], count[order], vocabulary)


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, term, n) for each distinct term of each item."""
    lowered = F.translate(F.coalesce(items[f"`{text}`"], F.lit("")), UPPER, LOWER)
    terms = items.select(
        items[f"`{item_id}`"].alias("item_id"), F.explode(F.regexp_extract_all(lowered, F.lit(TERM), 0)).alias("term")
    )
    return terms.groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("n"))


def passes(pairs: DataFrame, most: int) -> Iterator[list]:
    """The pairs in lists of about ``most`` rows, all of an item in one list."""
    if pairs.count() <= most:
        yield pairs.collect()
        return
    sizes = pairs.groupBy("item_id").agg(F.count(F.lit(1)).alias("size"))
    placed = running(sizes, [F.col("item_id").asc_nulls_first()], totals={"upto": "size"})
    placed = materialize(
        placed.select(F.col("item_id").alias("id"), F.floor((F.col("upto") - F.col("size")) / most).alias("pass")), "item-passes"
    )
    for k in range(placed.agg(F.max("pass")).first()[0] + 1):
        mine = placed.filter(F.col("pass") == k)
        found = pairs.join(mine, pairs["item_id"].eqNullSafe(mine["id"]), "left_semi").collect()
        if found:
            yield found


def term_counts(docs: DataFrame, hashes: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n, terms, counts) of the documents that have terms: their number
    of terms, and the vocabulary terms among them with their counts."""
    sent = docs.sparkSession.sparkContext.broadcast(hashes)
    numbers = T.ArrayType(T.IntegerType(), False)
    made = [T.StructField("n", T.LongType()), T.StructField("terms", numbers), T.StructField("counts", numbers)]

    def report(group: list[bytes]) -> list[pa.Array]:
        known = sent.value
        data, offsets = W.joined(group)
        parts = [W.hash_words(data, offsets[a : b + 1], W.NOT_ALNUM) for a, b in W.blocks(offsets)]
        n = np.concatenate([np.diff(p[1]) for p in parts])
        found = np.concatenate([p[0] for p in parts])
        owner = np.repeat(np.arange(len(group), dtype=np.int64), n)
        place = np.minimum(np.searchsorted(known, found), max(len(known) - 1, 0))
        hit = known[place] == found if len(known) else np.zeros(len(found), bool)
        width = max(len(known), 1)
        keys, counts = np.unique(owner[hit] * width + place[hit], return_counts=True)
        owners, terms = np.divmod(keys, width)
        cuts = pa.array(np.searchsorted(owners, np.arange(len(group) + 1)).astype(np.int32))
        lists = [pa.ListArray.from_arrays(cuts, pa.array(v.astype(np.int32))) for v in (terms, counts)]
        return [pa.array(n), *lists]

    counted = map_texts(docs, text, [doc_id], made, report)
    return counted.select(F.col(f"row.`{doc_id}`").cast("bigint").alias("doc_id"), "n", "terms", "counts").filter("n > 0")


def document_counts(counted: DataFrame, size: int) -> np.ndarray:
    """How many documents hold each of the ``size`` vocabulary terms."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(size, np.int64)
        for batch in batches:
            held += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(held[some])], ["term", "docs"])

    per_part = counted.select("terms").mapInArrow(work, "term bigint, docs bigint")
    out = np.zeros(size, np.int64)
    for row in per_part.groupBy("term").agg(F.sum("docs").alias("docs")).collect():  # one row per vocabulary term
        out[row.term] = row.docs
    return out


def weights_of(held: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in held], np.int64)


def exact_product(weights: np.ndarray, impacts: np.ndarray) -> np.ndarray:
    """``weights @ impacts`` in whole numbers by float64 products whose partial
    sums stay below 2^53; weights too large for that are taken in two halves."""
    if int(weights.sum(axis=1).max(initial=0)) * MOST_IMPACT < EXACT:
        return (weights.astype(np.float64) @ impacts).astype(np.int64)
    low = weights & ((1 << 20) - 1)
    return (exact_product(weights >> 20, impacts) << 20) + exact_product(low, impacts)


class Best:
    """The best ``k`` (score, document) of each item; equal scores go to the
    document without an identifier, then to the smaller one."""

    def __init__(self, n_items: int, k: int) -> None:
        self.k = k
        self.least = np.ones(n_items, np.int64)  # a score below this cannot enter
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.held = 0

    def offer(self, first: int, scores: np.ndarray, known: np.ndarray, ids: np.ndarray) -> None:
        """Scores of items ``first``.. (rows) in documents (columns)."""
        item, doc = np.nonzero(scores >= self.least[first : first + len(scores), None])
        if len(item):
            self.parts.append((item + first, scores[item, doc], known[doc], ids[doc]))
            self.held += len(item)
            if self.held > 4 * self.k * len(self.least) + (1 << 14):
                self.settle()

    def settle(self) -> tuple[np.ndarray, ...]:
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)
        item, score, known, ids = (np.concatenate(part) for part in zip(*self.parts, strict=True))
        order = np.lexsort((ids, known, -score, item))
        item, score, known, ids = item[order], score[order], known[order], ids[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        full = item[place == self.k - 1]
        self.least[full] = score[place == self.k - 1]
        kept = place < self.k
        self.parts = [(item[kept], score[kept], known[kept], ids[kept])]
        self.held = int(kept.sum())
        return self.parts[0]


@dataclass
class Tile:
    """Items ``first`` to ``last`` and the terms they use."""

    first: int
    last: int
    column: np.ndarray  # of each vocabulary term, -1 where no item uses it
    row: np.ndarray
    place: np.ndarray
    value: np.ndarray
    width: int

    def dense(self, begin: int, end: int) -> np.ndarray:
        inside = (self.place >= begin) & (self.place < end)
        out = np.zeros((self.last - self.first, end - begin), np.int64)
        out[self.row[inside], self.place[inside] - begin] = self.value[inside]
        return out


def item_tiles(items: Items, weights: np.ndarray) -> list[Tile]:
    value = items.count * weights[items.term]
    tiles = []
    for first in range(0, len(items.ids), ITEM_ROWS):
        last = min(first + ITEM_ROWS, len(items.ids))
        a, b = np.searchsorted(items.row, [first, last])
        used = np.unique(items.term[a:b])
        column = np.full(len(items.hashes), -1, np.int64)
        column[used] = np.arange(len(used))
        tiles.append(Tile(first, last, column, items.row[a:b] - first, column[items.term[a:b]], value[a:b], len(used)))
    return tiles


def best_of_parts(counted: DataFrame, items: Items, weights: np.ndarray, n_docs: int, length: int, k: int, kind: T.DataType) -> DataFrame:
    """(item_id, doc_id, score): the best ``k`` of each item in each part."""
    sent = counted.sparkSession.sparkContext.broadcast((items, weights))
    schema = T.StructType([T.StructField("item", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])

    def impacts(n: np.ndarray, sizes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        # In Python's whole numbers: 75 * n * n_docs has no bound.
        m = np.array([25 + 75 * x * n_docs // length for x in n.tolist()], np.int64)
        return (1_000_000_000 * counts) // (1000 * counts + 8 * np.repeat(m, sizes))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights = sent.value
        tiles = item_tiles(items, weights)
        best = Best(len(items.ids), k)
        matrix = lru_cache(maxsize=8)(lambda t, begin, end: tiles[t].dense(begin, end))
        for whole in batches:
            for at in range(0, len(whole), DOC_ROWS):
                batch = whole.slice(at, DOC_ROWS)
                known = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
                ids = batch.column(0).fill_null(0).to_numpy()
                sizes = np.diff(batch.column(2).offsets.to_numpy())
                term = batch.column(2).flatten().to_numpy()
                counts = batch.column(3).flatten().to_numpy().astype(np.int64)
                impact = impacts(batch.column(1).to_numpy(), sizes, counts)
                doc = np.repeat(np.arange(len(batch)), sizes)
                for t, tile in enumerate(tiles):
                    place = tile.column[term]
                    scores = np.zeros((tile.last - tile.first, len(batch)), np.int64)
                    for begin in range(0, tile.width, TERM_ROWS):
                        end = min(begin + TERM_ROWS, tile.width)
                        inside = np.flatnonzero((place >= begin) & (place < end))
                        if len(inside):
                            dense = np.zeros((end - begin, len(batch)))
                            dense[place[inside] - begin, doc[inside]] = impact[inside]
                            scores += exact_product(matrix(t, begin, end), dense)
                    best.offer(tile.first, scores, known, ids)
        item, score, known, ids = best.settle()
        found = pa.array(ids, pa.int64(), mask=~known)
        yield pa.RecordBatch.from_arrays([pa.array(item), found, pa.array(score)], schema.names)

    made = counted.filter(F.size("terms") > 0).mapInArrow(work, schema)
    names = counted.sparkSession.createDataFrame(list(enumerate(items.ids)), T.StructType([T.StructField("at", T.LongType()), T.StructField("item_id", kind)]))
    # One row per item of the pass.
    return made.join(F.broadcast(names), made["item"] == names["at"]).select("item_id", "doc_id", "score")


def search(
    docs: DataFrame, items: DataFrame, k: int = TOP, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", most_pairs: int = PASS_PAIRS
) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` best documents."""
    kind = items.schema[item_id].dataType
    pairs = materialize(item_terms(items, item_id, text), "item-terms")
    found = None
    for mine in passes(pairs, most_pairs):
        tile = Items.of(mine)
        counted = materialize(term_counts(docs, tile.hashes, doc_id, text), "term-counts")
        n_docs, length = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        weights = weights_of(document_counts(counted, len(tile.hashes)), n_docs)
        one = best_of_parts(counted, tile, weights, n_docs, length, k, kind)
        found = one if found is None else found.unionByName(one)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_first()]
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    near = salted.withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "salt").orderBy(*order))).filter(F.col("rank") <= k)
    last = near.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order))).filter(F.col("rank") <= k)
    return last.select("item_id", "rank", "doc_id", "score")


SQL = rf"""
with items as (
  select item_id, term, count(*) as times
  from (select item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}')) as term from benchmark)
  group by item_id, term
), read as (
  select row_number() over () as place, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}') as terms
  from documents
), sized as (
  select place, doc_id, cast(len(terms) as bigint) as n from read where len(terms) > 0
), totals as (
  select count(*) as n_docs, cast(sum(n) as bigint) as length from sized
), counted as (
  select place, term, count(*) as tf
  from (select place, unnest(terms) as term from read) where term in (select term from items)
  group by place, term
), weighed as (
  select term, cast(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) as bigint) as w
  from counted, totals group by term, n_docs
), impacts as (
  select place, doc_id, term, (1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // length)) as impact
  from counted join sized using (place), totals
), scored as (
  select item_id, place, doc_id, cast(sum(times * w * impact) as bigint) as score
  from items join weighed using (term) join impacts using (term) group by item_id, place, doc_id
)
select item_id, cast(row_number() over best as integer) as rank, doc_id, score
from scored where score > 0
window best as (partition by item_id order by score desc, doc_id nulls first)
qualify row_number() over best <= {TOP}
"""


@query("op11_lexical_search", SQL)
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
