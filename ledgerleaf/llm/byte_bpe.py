"""Byte-level BPE encoding and decoding by a rank file.

Each match of the pre-tokenizer's pattern is encoded on its own, in two tiers.
A minimal perfect hash over the vocabulary (hash and displace) gives the one
slot a whole pre-token can have; if the key there is equal, its id is the
answer. All other pre-tokens are merged by a heap of candidate pairs over
linked bytes: the pair of lowest rank first, the left one of equals, stale
entries skipped. The distinct pre-tokens of a block of texts are looked up
together; merged pre-tokens are remembered in a table of bounded size.

The vocabulary is read once on the driver and sent to the workers: its size is
that of the rank file, whatever the size of the table. Texts are mapped
partition by partition without a shuffle.

Defined cases: a null or empty text has no tokens. Special tokens are ordinary
text. Bytes that are no valid UTF-8 are kept as they are when decoding. Every
row gives a row, so ties and repeated rows need no rule; an empty table gives
an empty result. Columns may have any name.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerleaf.llm import words as W
from ledgerleaf.llm.mapping import map_texts
from ledgerleaf.llm.registry import query, table

RANK_FILE = "byte_bpe_50k.tiktoken"
#: Merged pre-tokens that a worker remembers.
REMEMBERED = 400_000


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    ranked = {int(rank): base64.b64decode(token) for token, rank in pairs}
    if sorted(ranked) != list(range(len(ranked))):
        raise ValueError("ranks are not 0 to n - 1")
    return [ranked[i] for i in range(len(ranked))]


class PerfectHash:
    """A minimal perfect hash: n keys, n slots, one key in each.

    Keys fall into buckets by one hash. Larger buckets first, each looks for
    the displacement that moves all its keys to free slots; a bucket of one key
    simply names a free slot.
    """

    _TRIED = 2048

    def __init__(self, keys: list[bytes]) -> None:
        n = len(keys)
        self.n, self.n_buckets = n, n // 3 + 1
        hashes = W.hash_strings(keys)
        if len(np.unique(hashes)) != n:
            raise ValueError("keys are not distinct")
        bucket = (hashes % np.uint64(self.n_buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[order], np.arange(self.n_buckets + 1))
        sizes = np.diff(edges)
        self.move = np.zeros(self.n_buckets, np.int64)
        self.key_at = np.full(n, -1, np.int64)
        taken = np.zeros(n, bool)
        for b in np.argsort(-sizes, kind="stable"):
            members = order[edges[b] : edges[b + 1]]
            if len(members) < 2:
                break
            first = 0
            while True:
                tried = np.arange(first, first + self._TRIED, dtype=np.uint64)
                slots = np.sort(self._moved(hashes[members], tried[:, None]), axis=1)
                good = ~taken[slots].any(axis=1) & (slots[:, 1:] != slots[:, :-1]).all(axis=1)
                if good.any():
                    break
                first += self._TRIED
            step = first + int(good.argmax())
            slots = self._moved(hashes[members], np.array([step], np.uint64))
            self.move[b] = step
            taken[slots] = True
            self.key_at[slots] = members
        free = iter(np.flatnonzero(~taken))
        for b in np.flatnonzero(sizes == 1):
            slot = next(free)
            self.move[b] = -1 - slot
            self.key_at[slot] = order[edges[b]]

    def _moved(self, hashes: np.ndarray, step: np.ndarray) -> np.ndarray:
        return (W.mix(hashes + step * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(self.n)).astype(np.int64)

    def slots(self, strings: list[bytes]) -> np.ndarray:
        """Key numbers at the slots of the given strings; the caller compares."""
        hashes = W.hash_strings(strings)
        move = self.move[(hashes % np.uint64(self.n_buckets)).astype(np.int64)]
        moved = self._moved(hashes, np.maximum(move, 0).astype(np.uint64))
        return self.key_at[np.where(move < 0, -1 - move, moved)]


def merge(piece: bytes, rank_of: dict[bytes, int]) -> list[int]:
    """The ids of one pre-token.

    ``end[i]`` is where the symbol that begins at i ends, 0 if none begins
    there; ``begin[e]`` is where the symbol that ends at e begins. Neighbours
    are thus linked by position.
    """
    n = len(piece)
    end = list(range(1, n + 1))
    begin = list(range(-1, n))
    rank = rank_of.get
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(piece[i : i + 2])) is not None]
    heapify(heap)
    while heap:
        _, i, stop = heappop(heap)
        middle = end[i]
        if not middle or middle >= stop or end[middle] != stop:
            continue
        end[middle] = 0
        end[i] = stop
        begin[stop] = i
        if i and (r := rank(piece[begin[i] : stop])) is not None:
            heappush(heap, (r, begin[i], stop))
        if stop < n and (r := rank(piece[i : end[stop]])) is not None:
            heappush(heap, (r, i, end[stop]))
    ids, i = [], 0
    while i < n:
        ids.append(rank_of[piece[i : end[i]]])
        i = end[i]
    return ids


class ByteBPE:
    """Encoder and decoder over one rank file."""

    def __init__(self, tokens: list[bytes], pattern: str = public_tokenizers.PATTERN) -> None:
        self.tokens = tokens
        self.pattern = pattern
        self.perfect = PerfectHash(tokens)
        self._prepare()

    def _prepare(self) -> None:
        self.split = regex.compile(self.pattern).findall
        self.rank_of = {token: i for i, token in enumerate(self.tokens)}
        self.whole: dict[str, bytes] = {}
        self.data, self.offsets = W.joined(self.tokens)

    def __getstate__(self) -> tuple:
        return self.tokens, self.pattern, self.perfect

    def __setstate__(self, state: tuple) -> None:
        self.tokens, self.pattern, self.perfect = state
        self._prepare()

    def _learn(self, pieces: set[str]) -> None:
        """Ids of pre-tokens not met before."""
        new = list(pieces.difference(self.whole))
        if len(self.whole) + len(new) > REMEMBERED:
            self.whole.clear()
            new = list(pieces)
        if not new:
            return
        raw = [p.encode("utf-8", "surrogateescape") for p in new]
        for piece, text, key in zip(new, raw, self.perfect.slots(raw).tolist(), strict=True):
            ids = [key] if self.tokens[key] == text else merge(text, self.rank_of)
            self.whole[piece] = np.array(ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        split = [self.split(t) for t in texts]
        self._learn(set().union(*split))
        return [b"".join(map(self.whole.__getitem__, pieces)) for pieces in split]

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """The bytes behind each list of ids."""
        if not ids:
            return []
        every = np.frombuffer(b"".join(ids), "<u4")
        sizes = np.diff(self.offsets)[every]
        ends = np.cumsum(sizes)
        source = np.repeat(self.offsets[:-1][every] - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)
        text = self.data[source].tobytes()
        counts = np.cumsum(np.fromiter((len(x) // 4 for x in ids), np.int64, len(ids)))
        stops = np.append(0, ends)[counts]
        return [text[a:b] for a, b in zip(np.append(0, stops[:-1]).tolist(), stops.tolist(), strict=True)]


@functools.cache
def _coder(path: str, pattern: str) -> ByteBPE:
    return ByteBPE(read_ranks(path), pattern)


def load(spark: SparkSession, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> Broadcast:
    """The coder as a broadcast; its size is that of the rank file."""
    return spark.sparkContext.broadcast(_coder(path or public_tokenizers.path(RANK_FILE), pattern))


def _text(group: list[bytes]) -> list[str]:
    return [t.decode("utf-8", "surrogateescape") for t in group]


def encode_column(docs: DataFrame, text: str = "text", into: str = "token_ids", **model) -> DataFrame:
    """The rows with the ids of their text as one more column, ``array<int>``."""
    coder = load(docs.sparkSession, **model)

    def report(group: list[bytes]) -> list[pa.Array]:
        ids = coder.value.encode(_text(group))
        offsets = np.append(0, np.cumsum([len(x) // 4 for x in ids])).astype(np.int32)
        return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(ids), "<i4")))]

    made = map_texts(docs, text, docs.columns, [T.StructField("ids", T.ArrayType(T.IntegerType()))], report)
    return made.select("row.*", F.col("ids").alias(into))


def decode_column(rows: DataFrame, ids: str = "token_ids", into: str = "decoded", **model) -> DataFrame:
    """The rows with the bytes behind their ids as one more column, ``binary``."""
    coder = load(rows.sparkSession, **model)
    row = F.struct(*[rows[f"`{name}`"] for name in rows.columns]).alias("row")
    schema = T.StructType([T.StructField("row", rows.schema), T.StructField("text", T.BinaryType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [np.array(x or [], "<u4").tobytes() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(coder.value.decode(lists), pa.binary())], schema.names)

    ids_column = F.coalesce(rows[f"`{ids}`"], F.array().cast("array<int>")).alias("ids")
    return rows.select(row, ids_column).mapInArrow(work, schema).select("row.*", F.col("text").alias(into))


def token_digests(docs: DataFrame, text: str = "text", row_id: str = "doc_id", **model) -> DataFrame:
    """Encodes, decodes again, and gives number and digests of both."""
    coder = load(docs.sparkSession, **model)

    def report(group: list[bytes]) -> list[pa.Array]:
        ids = coder.value.encode(_text(group))
        back = coder.value.decode(ids)
        return [
            pa.array([len(x) // 4 for x in ids], pa.int64()),
            pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
            pa.array([hashlib.sha256(x).hexdigest() for x in back], pa.string()),
        ]

    fields = [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
    return map_texts(docs, text, [row_id], fields, report).select("row.*", *[f.name for f in fields])


@query("op10_byte_bpe")
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"))
