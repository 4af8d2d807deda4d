r"""Document fingerprints: one-permutation MinHash with packed low-order bits.

A text's set holds its runs of five words (A-Z as a-z, words are runs of
anything but white space); a shorter text gives one run of all its words. Every
run is hashed once. The upper bits of the hash choose one of 256 bins, each bin
keeps its smallest value, and of that value four bits are stored. An empty bin
takes the value of a bin that is not empty, found by hashing (bin, attempt)
until one is hit: the optimal densification, in which every bin asks on its
own. Two fingerprints agree in a bin by chance in one case of 2^bits, which
``likeness`` takes out: (agreement - 2^-bits) / (1 - 2^-bits), kept in [0, 1].

Defined cases: a null text counts as empty. A text without words has the
fingerprint "" and is like another such text (1) and unlike all others (0).
Equal texts have equal fingerprints. Columns may have any name.

``neighbour_fingerprints`` needs each document's successor by falling
identifier. Rows go to parts between sampled identifiers that exist in the
table, so the first document of every part is known beforehand and is sent to
the part before it as well: one shuffle, no second pass over the texts, no
window over the whole table. Equal identifiers go by text, null ones come last,
and the last document is followed by the first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerleaf.llm import words as W
from ledgerleaf.llm.registry import query, table

BINS = 256
BITS = 4
WIDTH = 5
#: Sampled identifiers per part; the sample is bounded by this and the number of parts.
SAMPLE_PER_PART = 20

_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_BIN_SHIFT = np.uint64(64 - BINS.bit_length() + 1)


def minima(shingles: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The smallest value of each text and bin; all ones where a bin is empty."""
    n = len(offsets) - 1
    owner = np.repeat(np.arange(n), np.diff(offsets))
    cell = owner * BINS + (shingles >> _BIN_SHIFT).astype(np.int64)
    found = np.full(n * BINS, _EMPTY)
    np.minimum.at(found, cell, W.mix(shingles) >> np.uint64(1))
    return found.reshape(n, BINS)


def densified(found: np.ndarray) -> np.ndarray:
    """Empty bins filled; texts without any value stay empty."""
    empty = found == _EMPTY
    rows, bins = np.nonzero(empty & ~empty.all(axis=1, keepdims=True))
    filled = found.copy()
    attempt = 0
    while len(rows):
        attempt += 1
        asked = (W.mix(bins.astype(np.uint64) * np.uint64(1 << 32) + np.uint64(attempt)) % np.uint64(BINS)).astype(int)
        hit = ~empty[rows, asked]
        filled[rows[hit], bins[hit]] = found[rows[hit], asked[hit]]
        rows, bins = rows[~hit], bins[~hit]
    return filled


def codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Low-order bits by text and bin, and which texts have words at all."""
    data, offsets = W.joined(texts)
    made = [np.zeros((0, BINS), np.uint8)]
    some = [np.zeros(0, bool)]
    for first, last in W.blocks(offsets):
        runs, at = W.shingles(*W.hash_words(data, offsets[first : last + 1]), WIDTH)
        low = densified(minima(runs, at)) & np.uint64((1 << BITS) - 1)
        made.append(low.astype(np.uint8))
        some.append(np.diff(at) > 0)
    return np.concatenate(made), np.concatenate(some)


def packed(low: np.ndarray, some: np.ndarray) -> list[str]:
    """Two bins to a byte, as hexadecimal digits."""
    both = (low[:, 0::2] << BITS) | low[:, 1::2]
    return [row.tobytes().hex() if there else "" for row, there in zip(both, some, strict=True)]


def unpacked(fingerprints: list[str]) -> tuple[np.ndarray, np.ndarray]:
    some = np.array([bool(f) for f in fingerprints], bool)
    raw = np.frombuffer(b"".join(bytes.fromhex(f) if f else bytes(BINS // 2) for f in fingerprints), np.uint8)
    both = raw.reshape(len(fingerprints), BINS // 2)
    low = np.empty((len(fingerprints), BINS), np.uint8)
    low[:, 0::2], low[:, 1::2] = both >> BITS, both & ((1 << BITS) - 1)
    return low, some


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Estimated Jaccard likeness of the sets behind two lists of codes."""
    chance = 2.0**-BITS
    agree = (a[0] == b[0]).mean(axis=1) if len(a[0]) else np.zeros(0)
    value = np.clip((agree - chance) / (1 - chance), 0.0, 1.0)
    both, neither = a[1] & b[1], ~a[1] & ~b[1]
    return np.where(both, value, np.where(neither, 1.0, 0.0))


def fingerprint_column(docs: DataFrame, text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """(id, fingerprint) of every row."""
    schema = T.StructType([T.StructField("id", docs.schema[row_id].dataType), T.StructField("fingerprint", T.StringType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed(*codes(texts)))], ["id", "fingerprint"])

    return _plain(docs, text, row_id).mapInArrow(work, schema).select(F.col("id").alias(row_id), "fingerprint")


def _plain(docs: DataFrame, text: str, row_id: str) -> DataFrame:
    return docs.select(docs[f"`{row_id}`"].alias("id"), F.coalesce(docs[f"`{text}`"], F.lit("")).alias("content"))


def _steps_down(value: Column, bounds: list, kind: T.DataType) -> Column:
    """How many of the falling ``bounds`` are at or above ``value``.

    Bounds are held in rows of about the square root of their number, so that
    a row of the table meets few of them.
    """
    if not bounds:
        return F.lit(0)
    wide = max(1, int(len(bounds) ** 0.5))
    rows = [bounds[i : i + wide] for i in range(0, len(bounds), wide)]
    typed = lambda items: F.array(*[F.lit(x).cast(kind) for x in items])
    row = F.size(F.filter(typed([r[0] for r in rows]), lambda b: b >= value))
    inner = F.element_at(F.array(*[typed(r) for r in rows]), F.greatest(row, F.lit(1)))
    within = F.size(F.filter(inner, lambda b: b >= value))
    return F.when(row == 0, 0).otherwise((row - 1) * wide + within)


def with_successors(plain: DataFrame) -> DataFrame:
    """(id, content, tail) in parts by falling id; a part's rows are sorted and
    followed by the first row of the next part, marked as its tail."""
    spark = plain.sparkSession
    kind = plain.schema["id"].dataType
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = plain.select("id").filter("id is not null")
    count, top = ids.agg(F.count(F.lit(1)), F.max("id")).first()
    wanted = parts * SAMPLE_PER_PART
    if count > wanted:
        # By hash, so that the choice is the same in every run.
        ids = ids.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int((1 << 30) * wanted / count))
    sample = sorted((r.id for r in ids.distinct().collect()), reverse=True)
    places = sorted({len(sample) * k // parts for k in range(1, parts)} - {0})
    bounds = [sample[k] for k in places]
    last = len(bounds)
    part = F.when(F.col("id").isNull(), last).otherwise(_steps_down(F.col("id"), bounds, kind))
    opens = F.col("id").isin(bounds) if bounds else F.lit(False)
    own = F.struct(part.cast("int").alias("part"), F.lit(False).alias("tail"))
    before = F.struct((part - 1).cast("int").alias("part"), F.lit(True).alias("tail"))
    around = F.struct(F.lit(last).cast("int").alias("part"), F.lit(True).alias("tail"))
    homes = F.filter(
        F.array(own, F.when(opens, before), F.when(F.col("id") == F.lit(top).cast(kind), around)),
        lambda home: home.isNotNull(),
    )
    sent = plain.select("id", "content", F.inline(homes))
    placed = sent.repartitionById(last + 1, F.col("part"))
    return placed.sortWithinPartitions("tail", F.col("id").desc_nulls_last(), "content").select("id", "content", "tail")


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as much of the following one."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def neighbour_fingerprints(docs: DataFrame, text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """Fingerprints of each text, its edited text, and their likeness."""
    kind = docs.schema[row_id].dataType
    schema = T.StructType(
        [
            T.StructField(row_id, kind),
            T.StructField("n_chars", T.LongType()),
            T.StructField("edited_sha256", T.StringType()),
            T.StructField("fingerprint", T.StringType()),
            T.StructField("edited_fingerprint", T.StringType()),
            T.StructField("near_edited", T.DoubleType()),
            T.StructField("near_next", T.DoubleType()),
        ]
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            content = batch.column(1).cast(pa.binary())
            ids = batch.column(0).to_pylist()
            for i, tail in enumerate(batch.column(2).to_pylist()):
                yield ids[i], content[i].as_py(), tail

    def report(chunk: list[tuple], following: bytes) -> pa.RecordBatch:
        raw = [r[1] for r in chunk] + [following]
        plain = [t.decode("utf-8", "surrogateescape") for t in raw]
        changed = [edited(a, b).encode("utf-8", "surrogateescape") for a, b in zip(plain[:-1], plain[1:], strict=True)]
        own, other = codes(raw), codes(changed)
        mine = (own[0][:-1], own[1][:-1])
        columns = [
            [r[0] for r in chunk],
            [len(t) for t in plain[:-1]],
            [hashlib.sha256(t).hexdigest() for t in changed],
            packed(*mine),
            packed(*other),
            likeness(mine, other),
            likeness(mine, (own[0][1:], own[1][1:])),
        ]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema.names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk: list[tuple] = []
        held, first, following = 0, None, None
        for row in rows(batches):
            if row[2]:
                following = row[1] if following is None else following
                continue
            first = row[1] if first is None else first
            if held > W.BLOCK_BYTES or len(chunk) >= 2000:
                yield report(chunk, row[1])
                chunk, held = [], 0
            chunk.append(row)
            held += len(row[1])
        if chunk:
            yield report(chunk, first if following is None else following)

    return with_successors(_plain(docs, text, row_id)).mapInArrow(_typed(work, schema), schema)


def _typed(work, schema: T.StructType):
    """Casts what ``work`` yields to the declared types (empty columns have none)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def typed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in work(batches):
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(batch.columns, arrow, strict=True)], schema=arrow)

    return typed


@query("op7_fingerprints")
def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbour_fingerprints(table(spark, sf_dir, "documents"))
