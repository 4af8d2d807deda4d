r"""Prefix trie of conversations, built from ternary search trees of range shards.

1. Turns become digests of role and text; the distinct digests are ordered and
   numbered (the dictionary), so that everything later carries one number and
   one length for a turn.
2. Conversations are rebuilt (``rebuilt``): the first turns of the conversation
   that opens their hundred, then their own. Positions come from range parts
   (``ordered.running``), so a conversation of any length is spread over tasks.
3. A conversation is cut into segments of ``BAND`` turns, and equal segments
   after equal paths become one row. Nothing longer than a segment is one value.
4. Segments are dealt by ranges of (path, turn numbers). A shard inserts its
   segments into a ternary search tree, the middle one first, then the middles
   of the halves, so that the trees of siblings are balanced. Nodes are visited
   without recursion, later ones first: members, childless nodes and savings add
   up from the ends to the root.
5. Only nodes on the paths of a shard's first and last segment can lie in other
   shards too. They leave the shard as two paths with what hangs below them; the
   paths are dealt again by the same rules until one small shard is left. Each
   round halves the paths at least.
6. Bands run from the deepest up; what a band's groups found hangs below the
   nodes that end the band above. Most tables have one band.

``ends_sha256`` is the digest of one sequence of any length: parts of a range
shard join their identifiers to pieces of bounded size, and a task streams the
pieces of a node in order, without holding them.

Defined cases: a null role or text is empty. Turns are ordered by number, null
first, equal numbers by digest; a repeated row is a turn of its own. Rows with a
null conversation belong to none and are left out. c % 100 and the prefix of a
negative c follow the sign of c (-7 opens with 0). A conversation may be left
without turns; it is a member of the root. An empty table gives no node, not
even a root. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerleaf.llm.registry import query, table
from ledgerleaf.operators.joins import join_unique
from ledgerleaf.operators.ordered import running
from ledgerleaf.scratch import materialize

#: The opening turns taken over are fewer than this; openings belong to this many conversations.
OPENINGS, BLOCK = 6, 100
#: Turns of a segment.
BAND = 1 << 16
#: Turns of a shard.
SHARD = 1 << 15
#: Bytes of joined identifiers in one piece.
PIECE = 1 << 20

_NOBODY = (1 << 63) - 1
EMPTY = hashlib.sha256(b"").hexdigest()

_PAYLOAD = "depth int, convs bigint, least bigint, leaves bigint, saved bigint, children bigint, ends string"
PAYLOAD_NAMES = [part.split()[0] for part in _PAYLOAD.split(", ")]
_PATH = f"prefix binary, symbols array<bigint>, sizes array<bigint>, payload array<struct<{_PAYLOAD.replace(' ', ':').replace(',:', ',')}>>"
_NODE = (
    "prefix binary, depth int, least bigint, parent_least bigint, parent_key binary, key binary,"
    " convs bigint, children bigint, leaves bigint, saved bigint, ends string"
)


def encoded_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, symbol, size): each turn as its number in the dictionary
    of distinct turns, with the code points of its text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    # The length of the role keeps role and text apart.
    digest = F.unhex(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256))
    slim = rows.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", digest.alias("digest"), F.char_length(text).cast("bigint").alias("size")
    )
    slim = materialize(slim, "turn-digests")
    dictionary = slim.select("digest").distinct().orderBy("digest").withColumn("symbol", F.monotonically_increasing_id())
    return join_unique(slim, materialize(dictionary, "turn-dictionary"), "digest", "inner").drop("digest")


def prefix_length(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % OPENINGS


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, symbol, size, total) of the rebuilt turns, and (conv_id,
    total) of all conversations."""
    order = [F.col("turn").asc_nulls_first(), F.col("symbol")]
    placed = materialize(running(turns, order, group_by=["conv_id"], row_number="pos"), "placed-turns")
    convs = placed.groupBy("conv_id").agg(F.max("pos").alias("n"))
    convs = convs.withColumn("skipped", prefix_length(F.col("conv_id"))).withColumn("base", F.col("conv_id") - F.col("conv_id") % BLOCK)
    opening = placed.filter((F.col("conv_id") % BLOCK == 0) & (F.col("pos") < OPENINGS))
    held = opening.groupBy(F.col("conv_id").alias("opener")).agg(F.max("pos").alias("held"))
    convs = convs.join(held, F.col("base") == F.col("opener"), "left").withColumn("taken", F.least("skipped", F.coalesce("held", F.lit(0))))
    total = F.col("taken") + F.greatest(F.col("n") - F.col("skipped"), F.lit(0))
    convs = materialize(convs.select("conv_id", "base", "skipped", "taken", total.alias("total")), "conversations")
    own = join_unique(placed, convs.select("conv_id", "skipped", "taken", "total"), "conv_id", "inner")
    own = own.filter("pos > skipped").select("conv_id", (F.col("pos") - F.col("skipped") + F.col("taken")).alias("depth"), "symbol", "size", "total")
    shared = opening.select(F.col("conv_id").alias("opener"), "pos", "symbol", "size")
    given = convs.filter("taken > 0").join(shared, (F.col("base") == F.col("opener")) & (F.col("pos") <= F.col("taken")))
    given = given.select("conv_id", F.col("pos").alias("depth"), "symbol", "size", "total")
    return own.unionByName(given), convs.select("conv_id", "total")


def segments(turns: DataFrame, convs: DataFrame, band: int) -> DataFrame:
    """(conv_id, band, symbols, sizes, last): runs of at most ``band`` turns; a
    conversation without turns has one empty run."""
    inside = F.sort_array(F.collect_list(F.struct("depth", "symbol", "size")))
    number = F.floor((F.col("depth") - 1) / band).cast("bigint")
    cut = turns.groupBy("conv_id", number.alias("band")).agg(inside.alias("run"), F.first("total").alias("total"))
    full = cut.select(
        "conv_id",
        "band",
        F.transform("run", lambda t: t.symbol).alias("symbols"),
        F.transform("run", lambda t: t.size).alias("sizes"),
        (F.col("total") <= (F.col("band") + 1) * band).alias("last"),
    )
    none = F.array().cast("array<bigint>")
    bare = convs.filter("total = 0").select("conv_id", F.lit(0).cast("bigint").alias("band"), none.alias("symbols"), none.alias("sizes"), F.lit(True).alias("last"))
    return full.unionByName(bare)


def _content(symbols: Column) -> Column:
    return F.unhex(F.sha2(F.array_join(symbols.cast("array<string>"), ","), 256))


def _chained(prefix: bytes, content: bytes) -> bytes:
    return hashlib.sha256(prefix + content).digest()


def _typed(work, schema: str | T.StructType):
    arrow = to_arrow_schema(T.StructType.fromDDL(schema) if isinstance(schema, str) else schema)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for row in work(batches):
            rows.append(row)
            if len(rows) == 10_000:
                yield _batch(rows, arrow)
                rows = []
        if rows:
            yield _batch(rows, arrow)

    return made


def _batch(rows: list[tuple], arrow: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)


def with_paths(cut: DataFrame) -> DataFrame:
    """Segments with ``prefix``, a digest of all that comes before, and
    ``after``, the same with the segment itself."""
    cut = cut.withColumn("content", _content(F.col("symbols")))
    first = F.lit(b"")
    if cut.filter("band > 0").isEmpty():
        return cut.select("*", first.alias("prefix"), F.unhex(F.sha2(F.concat(first, F.col("content")), 256)).alias("after"))

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        # A conversation's segments pass in order; only the last digest is held.
        conv, path = None, b""
        for conv_id, band, content in _rows(batches):
            path = path if conv_id == conv else b""
            yield conv_id, band, path
            conv, path = conv_id, _chained(path, content)

    long = cut.filter("band = 1").select(F.col("conv_id").alias("long_id"))
    slim = cut.select("conv_id", "band", "content").join(long, F.col("conv_id") == F.col("long_id"), "left_semi")
    dealt = slim.repartition("conv_id").sortWithinPartitions("conv_id", "band")
    schema = "path_id bigint, path_band bigint, path binary"
    paths = dealt.mapInArrow(_typed(chain, schema), schema)
    met = cut.join(paths, (F.col("conv_id") == F.col("path_id")) & (F.col("band") == F.col("path_band")), "left")
    prefixed = met.withColumn("prefix", F.coalesce("path", first)).drop("path_id", "path_band", "path")
    return prefixed.withColumn("after", F.unhex(F.sha2(F.concat("prefix", "content"), 256)))


def end_digests(ends: DataFrame) -> DataFrame:
    """(ended, ends) from rows (ended, conv_id): the SHA-256 of each group's
    identifiers, ascending and joined by commas."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        ended, first, held, size = None, 0, [], 0
        for key, conv_id in _rows(batches):
            if held and (key != ended or size > PIECE):
                yield ended, first, ",".join(held)
                held, size = [], 0
            if not held:
                ended, first = key, conv_id
            held.append(str(conv_id))
            size += len(held[-1]) + 1
        if held:
            yield ended, first, ",".join(held)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        ended, state = None, None
        for key, _, piece in _rows(batches):
            if state is not None and key == ended:
                state.update(b",")
            else:
                if state is not None:
                    yield ended, state.hexdigest()
                ended, state = key, hashlib.sha256()
            state.update(piece.encode())
        if state is not None:
            yield ended, state.hexdigest()

    schema = "ended binary, first bigint, piece string"
    ranged = ends.repartitionByRange("ended", "conv_id").sortWithinPartitions("ended", "conv_id")
    pieces = ranged.mapInArrow(_typed(join, schema), schema)
    dealt = pieces.repartition("ended").sortWithinPartitions("ended", "first")
    return dealt.mapInArrow(_typed(digest, "ended binary, ends string"), "ended binary, ends string")


class Tree:
    """A ternary search tree of sequences; node i stands for a trie node.

    ``less`` and ``more`` lead to siblings, ``down`` to the children. A node is
    made after its parent, so later nodes are never above earlier ones.
    """

    def __init__(self) -> None:
        self.symbol, self.less, self.more, self.down = [0], [-1], [-1], [-1]
        self.parent, self.depth, self.size = [-1], [-1], [0]

    def _add(self, symbol: int, parent: int, size: int) -> int:
        self.symbol.append(symbol)
        for links in (self.less, self.more, self.down):
            links.append(-1)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        self.size.append(size)
        return len(self.symbol) - 1

    def insert(self, symbols: list[int], sizes: list[int]) -> list[int]:
        """The nodes of the path."""
        node, path = 0, []
        for symbol, size in zip(symbols, sizes, strict=True):
            at, links, origin = self.down[node], self.down, node
            while at >= 0 and self.symbol[at] != symbol:
                links, origin = (self.less if symbol < self.symbol[at] else self.more), at
                at = links[origin]
            if at < 0:
                at = self._add(symbol, node, size)
                links[origin] = at
            node = at
            path.append(node)
        return path


def middles(n: int) -> Iterator[int]:
    """0 to n - 1, the middle first, then the middles of the halves."""
    waiting = [(0, n)]
    while waiting:
        first, last = waiting.pop()
        if first < last:
            middle = (first + last) // 2
            yield middle
            waiting += [(middle + 1, last), (first, middle)]


def shard_nodes(rows: list[tuple], band: int, whole: bool, keyed: bool) -> Iterator[tuple[tuple | None, tuple | None]]:
    """(node, None) for each node that lies in this shard alone and (None, path)
    for what may lie in others; of a ``whole`` shard all nodes are final.

    ``rows`` are sorted paths (prefix, symbols, sizes, payload). A node's key is
    given where nodes of other shards or bands may name it as their parent:
    everywhere if ``keyed``, else at the end of the band.
    """
    tree, groups = Tree(), {}
    for prefix, _, _, _ in rows:
        groups.setdefault(prefix, len(groups))
    paths: list[list[int]] = [[] for _ in rows]
    for i in middles(len(rows)):
        prefix, symbols, sizes, _ = rows[i]
        # The group stands before the turns: its node is the top at depth 0.
        paths[i] = tree.insert([groups[prefix], *symbols], [0, *sizes])
    n = len(tree.symbol)
    convs, leaves, saved, children = ([0] * n for _ in range(4))
    least, ends = [_NOBODY] * n, [None] * n
    for i, path in enumerate(paths):
        for depth, c, low, leaf, save, child, digest in (p.values() for p in rows[i][3]):
            node = path[depth]
            convs[node] += c
            leaves[node] += leaf
            saved[node] += save
            children[node] += child
            least[node] = min(least[node], low)
            ends[node] = digest or ends[node]
    edge = [False] * n
    if not whole:
        for path in (paths[0], paths[-1]):
            for node in path:
                edge[node] = True
    keys: list[bytes | None] = [None] * n
    for i, path in enumerate(paths):
        prefix, symbols, _, _ = rows[i]
        if keyed or edge[path[0]]:
            state = hashlib.sha256(b"node" + prefix)
            keys[path[0]] = prefix
            for node, symbol in zip(path[1:], symbols, strict=True):
                if not (keyed or edge[node]):
                    break
                state.update(b"%d," % symbol)
                keys[node] = state.copy().digest()
        if len(symbols) == band:
            keys[path[-1]] = _chained(prefix, hashlib.sha256(",".join(map(str, symbols)).encode()).digest())
    prefixes = list(groups)
    group = [0] * n
    for node in range(1, n):
        group[node] = group[tree.parent[node]] if tree.parent[node] else tree.symbol[node]
    for node in range(n - 1, 0, -1):
        if edge[node]:
            continue
        if not children[node]:
            leaves[node] = 1
        saved[node] += (convs[node] - 1) * tree.size[node]
        above = tree.parent[node]
        convs[above] += convs[node]
        leaves[above] += leaves[node]
        saved[above] += saved[node]
        children[above] += 1
        least[above] = min(least[above], least[node])
    for node in range(1, n):
        if edge[node]:
            continue
        depth, above, prefix = tree.depth[node], tree.parent[node], prefixes[group[node]]
        told = (None, None)
        if depth > 0:
            # The top of a later band is the end of a path in the band above.
            outside = edge[above] or (depth == 1 and prefix)
            told = (None, prefix if depth == 1 else keys[above]) if outside else (least[above], None)
        yield (prefix, depth, least[node], *told, keys[node], convs[node], children[node], leaves[node], saved[node], ends[node]), None
    if whole:
        return
    given: set[int] = set()
    for i in dict.fromkeys((0, len(rows) - 1)):
        prefix, symbols, sizes, _ = rows[i]
        hung = [(depth, convs[v], least[v], leaves[v], saved[v], children[v], ends[v]) for depth, v in enumerate(paths[i]) if v not in given]
        payload = [dict(zip(PAYLOAD_NAMES, p, strict=True)) for p in hung]
        given.update(paths[i])
        yield None, (prefix, symbols, sizes, payload)


def trie_band(items: DataFrame, band: int, shard: int) -> list[DataFrame]:
    """The nodes of one band, as tables, from its paths."""
    out, rows, keyed = [], materialize(items, "trie-paths"), False
    schema = T.StructType([T.StructField("node", T.StructType.fromDDL(_NODE)), T.StructField("path", T.StructType.fromDDL(_PATH))])
    names = [[f.name for f in field.dataType.fields] for field in schema.fields]
    while True:
        n, turns = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("symbols") + 1), F.lit(0))).first()
        if not n:
            return out
        shards = min(ceil(turns / shard), ceil(n / 4))
        whole = shards == 1
        dealt = rows.repartition(1) if whole else rows.repartitionByRange(shards, "prefix", "symbols")

        def work(batches: Iterator[pa.RecordBatch], whole: bool = whole, keyed: bool = keyed) -> Iterator[tuple]:
            mine = list(_rows(batches))
            if mine:
                for node, path in shard_nodes(mine, band, whole, keyed):
                    named = [None if v is None else dict(zip(k, v, strict=True)) for k, v in zip(names, (node, path), strict=True)]
                    yield tuple(named)

        made = dealt.sortWithinPartitions("prefix", "symbols").mapInArrow(_typed(work, schema), schema)
        made = materialize(made, "trie-nodes")
        out.append(made.filter("node is not null").select("node.*"))
        if whole:
            return out
        rows, keyed = made.filter("path is not null").select("path.*"), True


def conversation_trie(rows: DataFrame, band: int = BAND, shard: int = SHARD) -> DataFrame:
    """One row per node; see the module's docstring and the query's contract."""
    turns, convs = rebuilt(encoded_turns(rows))
    cut = materialize(with_paths(materialize(segments(turns, convs, band), "segments")), "segment-paths")
    digests = end_digests(cut.filter("last").select(F.col("after").alias("ended"), "conv_id"))
    same = cut.groupBy("band", "prefix", "after").agg(
        F.first("symbols").alias("symbols"),
        F.first("sizes").alias("sizes"),
        F.count_if("last").alias("convs"),
        F.coalesce(F.min(F.when(F.col("last"), F.col("conv_id"))), F.lit(_NOBODY)).alias("least"),
    )
    items = materialize(same.join(digests, F.col("after") == F.col("ended"), "left").drop("ended"), "trie-items")
    deepest = items.agg(F.max("band")).first()[0]
    nodes, below = [], None
    for number in range(-1 if deepest is None else deepest, -1, -1):
        mine = items.filter(F.col("band") == number)
        hung = [F.col(c) for c in ("convs", "least")] + [F.lit(0).cast("bigint").alias(c) for c in ("leaves", "saved", "children")]
        if below is not None:
            mine = mine.join(below, F.col("after") == F.col("top"), "left")
            more = lambda c: F.coalesce(F.col(f"b_{c}"), F.lit(0))
            hung = [(F.col("convs") + more("convs")).alias("convs"), F.least("least", F.coalesce("b_least", F.lit(_NOBODY))).alias("least")]
            hung += [more(c).alias(c) for c in ("leaves", "saved", "children")]
        payload = F.array(F.struct(F.size("symbols").alias("depth"), *hung, "ends"))
        parts = trie_band(mine.select("prefix", "symbols", "sizes", payload.alias("payload")), band, shard)
        found = parts[0]
        for part in parts[1:]:
            found = found.unionByName(part)
        if number:
            below = found.filter("depth = 0").select(
                F.col("prefix").alias("top"), *[F.col(c).alias(f"b_{c}") for c in ("convs", "least", "leaves", "saved", "children")]
            )
            found = found.filter("depth > 0")
        nodes.append(found.withColumn("depth", F.col("depth").cast("bigint") + number * band))
    if not nodes:
        nodes = [rows.sparkSession.createDataFrame([], _NODE).withColumn("depth", F.col("depth").cast("bigint"))]
    every = nodes[0]
    for part in nodes[1:]:
        every = every.unionByName(part)
    # Parents in another shard or band are met by their key; most are known.
    named = every.filter("key is not null").select(F.col("key").alias("parent_key"), F.col("least").alias("named_least"))
    near = every.filter("parent_key is null").withColumn("named_least", F.lit(None).cast("bigint"))
    far = join_unique(every.filter("parent_key is not null"), named, "parent_key", "left")
    return near.unionByName(far).select(
        F.col("least").alias("conv_id"),
        "depth",
        F.coalesce("parent_least", "named_least").alias("parent_conv_id"),
        F.col("convs").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.lit(EMPTY)).alias("ends_sha256"),
    )


SQL = rf"""
with recursive turns as (
  select conv_id, turn, coalesce(text, '') as text,
         sha256(concat(cast(length(coalesce(role, '')) as varchar), ':', coalesce(role, ''), coalesce(text, ''))) as digest
  from conversations where conv_id is not null
), placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, digest) as pos from turns
), bits as (
  select range as byte, range as value, 0 as k from range(256)
  union all select byte, xor(value >> 1, (value & 1) * 3988292384), k + 1 from bits where k < 8
), crc as (
  select distinct conv_id, cast(conv_id as varchar) as said, 0 as bytes_read, cast(4294967295 as bigint) as state from turns
  union all
  select conv_id, said, bytes_read + 1, xor(state >> 8, value)
  from crc join bits on k = 8 and byte = xor(state & 255, cast(ascii(said[bytes_read + 1]) as bigint))
  where bytes_read < length(said)
), convs as (
  select conv_id, xor(state, cast(4294967295 as bigint)) % {OPENINGS} as h, conv_id - conv_id % {BLOCK} as base from crc where bytes_read = length(said)
), turns_of as (
  select conv_id, 1 as part, pos, text, digest from placed join convs using (conv_id) where pos > h
  union all
  select c.conv_id, 0 as part, pos, text, digest from convs c join placed p on p.conv_id = c.base and pos <= h
), ordered as (
  select conv_id, row_number() over (partition by conv_id order by part, pos) as depth, text, digest from turns_of
), whole as (
  select c.conv_id, coalesce(list(o.digest order by o.depth) filter (where o.depth is not null), []) as turns,
         coalesce(list(length(o.text) order by o.depth) filter (where o.depth is not null), []) as sizes
  from convs c left join ordered o using (conv_id) group by c.conv_id
), steps as (
  select conv_id, unnest(range(len(turns) + 1)) as depth, turns, sizes from whole
), nodes as (
  select depth, turns[1:depth] as path, min(conv_id) as conv_id, count(*) as n_convs,
         case when depth = 0 then 0 else (count(*) - 1) * any_value(sizes[depth]) end as own,
         sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (where len(turns) = depth), '')) as ends_sha256
  from steps group by depth, turns[1:depth]
), counted as (
  select n.*, (select count(*) from nodes k where k.depth = n.depth + 1 and k.path[1:n.depth] = n.path) as n_children from nodes n
), above as (
  select *, unnest(range(depth + 1)) as top from counted
), summed as (
  select top as depth, path[1:top] as path, sum(own) as saved, count(*) filter (where n_children = 0) as n_leaves
  from above group by top, path[1:top]
)
select n.conv_id, cast(n.depth as bigint) as depth, p.conv_id as parent_conv_id, n.n_convs, n.n_children, s.n_leaves,
       cast(s.saved as bigint) as saved_tokens, n.ends_sha256
from counted n join summed s on s.depth = n.depth and s.path = n.path
left join nodes p on p.depth = n.depth - 1 and p.path = n.path[1:n.depth - 1]
"""


@query("op13_conversation_trie", SQL)
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))
