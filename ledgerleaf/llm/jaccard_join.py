r"""N-gram Jaccard join: documents whose sets of five-word shingles are alike.

A-Z count as a-z, words are runs of ``[^\x20\x09-\x0D]``; a text with fewer
than five words has its whole sequence as its one shingle. Two documents link
when 100 * |A & B| >= 75 * |A | B|, and a component is what links connect.

1. Each text becomes its set; equal sets are one class, known by a digest.
2. In any order of tokens that is the same for all, the first k common tokens of
   two linked sets stand among the first n - ceil(0.75 n) + k of either. So a set
   sends that many, k being a seventh of n. Tokens known to be frequent come
   last in the order, by frequency, all others by hash. Which are frequent is
   estimated from a fixed share of the documents: that decides how much work
   there is, never the result. Of its tokens that another class has sent too, a
   class keeps all but k - 1, those held by the fewest classes first: two sets
   with k of them in common still share one. This leaves out classes that have
   a passage in common and nothing else.
   Classes left that share a token are put together by edges to the smallest of
   them: rare tokens meet in one shuffle, frequent ones (at most ``FREQUENT``) by
   a broadcast of one row per token. So no group of documents, however large, is
   listed as pairs. Their components are the neighbourhoods outside of which no
   link can lie.
3. Inside a neighbourhood signature trees find the links (signature_tree.py).
   A neighbourhood beyond ``UNIT_TOKENS`` is dealt over several tasks: chunks
   of sets of like size first, then one document of each group of each chunk,
   and at last whatever is still outside the largest group. Before those texts
   move, chunks and records are joined as numbers: by the tokens of step 2, of
   which linked sets have one in common, and by the range of sizes and the
   groups that a chunk holds them in. A text goes to the chunks that pass, so no
   pair that can link is left out.
4. Components of the links, and for every document the smallest identifier.

Sets travel as texts and are computed again where they are compared; only the
documents inside neighbourhoods travel at all.

Defined cases: a null or empty text, or one of white space, has no shingles
and is linked with nothing. Equal sets are one class. Null identifiers are
never the smallest unless all are null; rows may repeat an identifier or a
whole row. An empty table gives an empty result. Columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerleaf.llm import words as W
from ledgerleaf.llm.components import connected_components
from ledgerleaf.llm.mapping import text_groups
from ledgerleaf.llm.registry import query, table
from ledgerleaf.llm.signature_tree import Linker
from ledgerleaf.scratch import materialize

WIDTH = 5
SHARE = (75, 100)
#: One document in so many is read to learn which tokens are frequent.
SAMPLE_ONE_IN = 16
SEEN_LEAST = 3
#: Frequent tokens that are told apart.
FREQUENT = 1 << 16
#: Frequent tokens are spread over so many tasks each.
SALTS = 16
#: One common token in so many is asked for (k in the docstring).
ASKED_ONE_IN = 7
#: Tokens that one task compares at once.
UNIT_TOKENS = 1 << 22

_HIGH = np.uint64(1 << 63)


class Order:
    """The common order of tokens: others by hash, then frequent ones by rank."""

    def __init__(self, frequent: np.ndarray) -> None:
        self.by_rank = frequent.astype(np.uint64)
        self.place = np.argsort(self.by_rank)
        self.sorted = self.by_rank[self.place]

    def keys(self, tokens: np.ndarray) -> np.ndarray:
        if not len(self.sorted):
            return tokens
        at = np.searchsorted(self.sorted, tokens)
        at[at == len(self.sorted)] = 0
        return np.where(self.sorted[at] == tokens, _HIGH + self.place[at].astype(np.uint64), tokens)

    def tokens(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.by_rank):
            return keys
        late = keys >= _HIGH
        return np.where(late, self.by_rank[np.where(late, keys & ~_HIGH, np.uint64(0)).astype(np.int64)], keys)


def token_sets(group: list[bytes], order: Order | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Each text's sorted distinct tokens (63 bits, or keys of ``order``) and their offsets."""
    data, offsets = W.joined(group)
    runs, at = W.shingles(*W.hash_words(data, offsets), WIDTH)
    tokens = runs >> np.uint64(1)
    if order is not None:
        tokens = order.keys(tokens)
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        tokens[a:b].sort()
    keep = np.ones(len(tokens), bool)
    keep[1:] = tokens[1:] != tokens[:-1]
    starts = at[:-1][at[:-1] < len(tokens)]
    keep[starts] = True
    kept = np.append(0, np.cumsum(keep))
    return tokens[keep], kept[at]


def asked(n: np.ndarray) -> np.ndarray:
    """Common tokens that are looked for in a set of n."""
    return np.maximum(n // ASKED_ONE_IN, 1)


def prefix_lengths(n: np.ndarray) -> np.ndarray:
    """Tokens among which a linked set has at least ``asked`` common ones."""
    return np.where(n > 0, np.minimum(n, n - -(-SHARE[0] * n // SHARE[1]) + asked(n)), 0)


def digests(tokens: np.ndarray, at: np.ndarray) -> np.ndarray:
    """128 bits of each set, independent of the order of its tokens; zeros without tokens."""
    out = np.zeros((len(at) - 1, 2), np.uint64)
    full = np.flatnonzero(np.diff(at))
    if len(full):
        for k, salt in enumerate((0x5851F42D4C957F2D, 0x14057B7EF767814F)):
            out[full, k] = np.add.reduceat(W.mix(tokens ^ np.uint64(salt)), at[:-1][full])
    return out.view(np.int64)


def _plain(docs: DataFrame, text: str, row_id: str) -> DataFrame:
    return docs.select(docs[f"`{row_id}`"].alias("id"), docs[f"`{text}`"].alias("content"))


def frequent_tokens(plain: DataFrame) -> np.ndarray:
    """The most frequent tokens of the sampled documents, rarest first."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, group in text_groups(batch.column(0)):
                tokens, _ = token_sets(group)
                yield pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64))], ["token"])

    sampled = plain.filter(F.pmod(F.xxhash64("id"), F.lit(SAMPLE_ONE_IN)) == 0).select("content")
    counts = sampled.mapInArrow(work, "token bigint").groupBy("token").count().filter(F.col("count") >= SEEN_LEAST)
    rows = counts.orderBy(F.desc("count"), "token").limit(FREQUENT).toPandas()
    return rows["token"].to_numpy(np.int64)[::-1].view(np.uint64) if len(rows) else np.zeros(0, np.uint64)


def document_sets(plain: DataFrame) -> DataFrame:
    """(rec, id, n, d1, d2): size and digest of each document's set."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, group in text_groups(batch.column(1)):
                tokens, at = token_sets(group)
                both = digests(tokens, at)
                columns = [batch.column(0).slice(first, len(group)), pa.array(np.diff(at)), pa.array(both[:, 0]), pa.array(both[:, 1])]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n", "d1", "d2"])

    kind = plain.schema["id"].dataType.simpleString()
    made = plain.mapInArrow(work, f"id {kind}, n bigint, d1 bigint, d2 bigint")
    # Numbers are fixed by being written.
    return materialize(made.withColumn("rec", F.monotonically_increasing_id()), "document-sets")


def prefix_tokens(plain: DataFrame, order: Order) -> DataFrame:
    """(token, node): the first tokens of each set under its digest, once per
    task; frequent tokens as negative numbers."""
    sent = plain.sparkSession.sparkContext.broadcast(order)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[tuple[int, int]] = set()
        for batch in batches:
            for _, group in text_groups(batch.column(0)):
                keys, at = token_sets(group, sent.value)
                n = np.diff(at)
                both = digests(sent.value.tokens(keys), at)
                length = prefix_lengths(n)
                for k, pair in enumerate(map(tuple, both.tolist())):
                    if pair in known:
                        length[k] = 0
                    known.add(pair)
                chosen = np.arange(len(keys)) - np.repeat(at[:-1], n) < np.repeat(length, n)
                keys, node = keys[chosen], np.repeat(both[:, 0], n)[chosen]
                token = np.where(keys >= _HIGH, -1 - (keys & ~_HIGH).astype(np.int64), keys.astype(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(token), pa.array(node)], ["token", "node"])

    return plain.select("content").mapInArrow(work, "token bigint, node bigint")


def _by_token(rows: DataFrame) -> DataFrame:
    salt = F.when(F.col("token") < 0, F.pmod("node", F.lit(SALTS))).otherwise(0)
    return rows.repartition("token", salt).sortWithinPartitions("token", "node")


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, node, held): rows whose token has another node too (frequent
    tokens: all rows), each once, with the number of nodes that hold the token
    (frequent tokens: beyond any such number, by rank). Rows come sorted by
    token and node; the last token of a batch waits for the next."""
    waiting = np.zeros((0, 2), np.int64)

    def kept(rows: np.ndarray) -> pa.RecordBatch:
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:] != rows[:-1]).any(axis=1)
        rows = rows[new]
        starts = np.flatnonzero(np.append(True, rows[1:, 0] != rows[:-1, 0])) if len(rows) else np.zeros(0, np.int64)
        runs = np.diff(np.append(starts, len(rows)))
        held = np.repeat(runs, runs)
        late = rows[:, 0] < 0
        held[late] = (1 << 40) - rows[late, 0]
        rows, held = rows[held > 1], held[held > 1]
        return pa.RecordBatch.from_arrays([pa.array(rows[:, 0]), pa.array(rows[:, 1]), pa.array(held)], ["token", "node", "held"])

    for batch in batches:
        rows = np.stack([c.to_numpy() for c in batch.columns], axis=1)
        if not len(rows):
            continue
        cut = int(np.searchsorted(rows[:, 0], rows[-1, 0], "left"))
        if cut or (len(waiting) and waiting[0, 0] != rows[0, 0]):
            yield kept(np.concatenate([waiting, rows[:cut]]))
            waiting = rows[cut:]
        else:
            # One token over many batches: only its distinct nodes are kept.
            waiting = np.unique(np.concatenate([waiting, rows]), axis=0)
    yield kept(waiting)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges from each node to the first of its token; rows sorted by token."""
    last_token = last_first = None
    for batch in batches:
        token, node = (c.to_numpy() for c in batch.columns)
        if not len(token):
            continue
        new = np.ones(len(token), bool)
        new[1:] = token[1:] != token[:-1]
        if last_token is not None and token[0] == last_token:
            new[0] = False
        begins = np.maximum.accumulate(np.where(new, np.arange(len(token)), -1))
        first = np.where(begins >= 0, node[begins], 0 if last_first is None else last_first)
        last_token, last_first = token[-1], first[-1]
        edges = np.unique(np.stack([node, first], axis=1)[node != first], axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(edges[:, 0]), pa.array(edges[:, 1])], ["a", "b"])


def rarest_shared(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """(token, node): of two linked sets some token is always left under both."""
    shared = _by_token(rows).mapInArrow(_shared, "token bigint, node bigint, held bigint")
    sizes = sets.filter("n > 0").groupBy(F.col("d1").alias("node")).agg(F.min("n").alias("n"))
    # What the smallest set that can link to one of n asks for.
    smallest = F.ceil(F.col("n") * SHARE[0] / F.lit(SHARE[1]))
    least = F.greatest(F.floor(smallest / ASKED_ONE_IN), F.lit(1))
    # A node's shared tokens are no more than the tokens of one text.
    own = Window.partitionBy("node")
    placed = shared.withColumn("place", F.row_number().over(own.orderBy("held", "token"))).withColumn(
        "shared", F.count(F.lit(1)).over(own)
    )
    # Of two linked sets one of the rarest shared tokens of either is common.
    rarest = F.col("place") <= F.col("shared") - least + 1
    return materialize(placed.join(sizes, "node").filter(rarest).select("token", "node"), "rarest-shared")


def neighbourhood_edges(rows: DataFrame) -> DataFrame:
    """Edges (a, b) of digests: linked sets are always connected."""
    rare = _by_token(rows.filter("token >= 0")).select("token", "node").mapInArrow(_runs, "a bigint, b bigint")
    late = rows.filter("token < 0")
    # One row per frequent token: at most FREQUENT.
    firsts = late.groupBy("token").agg(F.min("node").alias("b"))
    linked = late.join(F.broadcast(firsts), "token").filter("node != b").select(F.col("node").alias("a"), "b")
    return rare.union(linked).distinct()


def _link_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b): each linked record of a unit and the smallest of its group, itself
    included; rows (unit1, unit2, unit3, rec, d1, d2, grp, content) sorted by unit."""
    current, rows = None, []

    def finish() -> pa.RecordBatch:
        made = {}
        sizes = np.fromiter((len(r[4]) for r in rows), np.int64, len(rows))
        for first, last in W.blocks(np.append(0, np.cumsum(sizes))):
            tokens, at = token_sets([r[4] for r in rows[first:last]])
            both = digests(tokens, at).tolist()
            for k in range(last - first):
                rec, d1, d2, grp, _ = rows[first + k]
                # Another text under the same identifier has another digest.
                if [d1, d2] == both[k]:
                    made[rec] = (tokens[at[k] : at[k + 1]], grp)
        recs = sorted(made)
        roots: dict[int, int] = {}
        if len(recs) > 1:
            linker = Linker([made[r][0] for r in recs], np.array([made[r][1] for r in recs]), SHARE)
            linker.run()
            # The first record of a group is its smallest.
            roots = {r: recs[k] for r, k in zip(recs, linker.groups.labels().tolist(), strict=True)}
            linked = set(roots.values()) & {k for r, k in roots.items() if r != k}
            roots = {r: k for r, k in roots.items() if k in linked}
        return pa.RecordBatch.from_arrays(
            [pa.array(list(roots), pa.int64()), pa.array(list(roots.values()), pa.int64())], ["a", "b"]
        )

    for batch in batches:
        units = list(zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True))
        recs, d1, d2, grp = (batch.column(k).to_pylist() for k in range(3, 7))
        content = batch.column(7).cast(pa.binary())
        for k, unit in enumerate(units):
            if unit != current and rows:
                yield finish()
                rows = []
            current = unit
            rows.append((recs[k], d1[k], d2[k], grp[k], content[k].as_py() or b""))
    if rows:
        yield finish()


def _linked(dealt: DataFrame) -> DataFrame:
    """Runs the units of ``dealt`` and keeps their links."""
    units = ["unit1", "unit2", "unit3"]
    placed = dealt.repartition(*units).sortWithinPartitions(*units)
    links = placed.select(*units, "rec", "d1", "d2", "grp", "content").mapInArrow(_link_units, "a bigint, b bigint")
    return materialize(links, "links")


def linked_records(
    plain: DataFrame, classes: DataFrame, edges: DataFrame, held: DataFrame, unit_tokens: int = UNIT_TOKENS
) -> DataFrame:
    """(node, root) of the class records that any link connects; ``held`` are the
    rows (token, node) of which two linked sets always have a token in common."""
    homes = connected_components(edges).withColumnsRenamed({"node": "d1", "root": "home"})
    leads = classes.select("rec", F.col("lead.id").alias("member_id"), F.col("lead.copies").alias("copies"), "n", "d1", "d2")
    members = homes.join(leads, "d1")
    sizes = members.groupBy("home").agg(F.sum("n").alias("tokens"), F.max("copies").alias("copies"))
    most = sizes.agg(F.max("tokens").alias("tokens"), F.max("copies").alias("copies")).first()
    if (most["tokens"] or 0) <= unit_tokens:
        # Each neighbourhood is one unit: its groups are the components.
        texts = _texts(plain, members, most["copies"])
        return _linked(texts.select("*", F.col("rec").alias("grp"), *_unit("home", F.lit(0), F.lit(0)))).withColumnsRenamed(
            {"a": "node", "b": "root"}
        )
    wide = sizes.filter(F.col("tokens") > unit_tokens).select("home")
    members = _by_size(members, members.join(wide, "home", "left_semi"), unit_tokens, "chunk")
    # Wide neighbourhoods come back twice, so their texts are kept.
    texts = materialize(_texts(plain, members, most["copies"]), "neighbourhood-texts")
    links = _linked(texts.select("*", F.col("rec").alias("grp"), *_unit("home", F.coalesce("chunk", F.lit(0)), F.lit(0))))
    numbers = texts.filter("chunk IS NOT NULL").select("rec", "d1", "n", "home", "chunk").distinct()
    # One document of each group of each chunk.
    grouped = _grouped(numbers, links)
    heads = grouped.groupBy("home", "chunk", "grp").agg(F.min("rec").alias("rec")).select("rec")
    some = grouped.join(heads, "rec", "left_semi").drop("chunk")
    some = _by_size(some, some, unit_tokens, "chunk").select("rec", "grp", *_unit("home", "chunk", F.lit(1)))
    links = links.union(_linked(_with_texts(some, texts)))
    # Whatever is outside the largest group of its neighbourhood, against the chunks it can link to.
    grouped = materialize(_grouped(numbers, links), "grouped-records")
    groups = grouped.groupBy("home", "grp").agg(F.sum("n").alias("weight"))
    largest = groups.groupBy("home").agg(F.max_by("grp", "weight").alias("main"))
    outside = grouped.join(largest, "home").filter("grp != main").drop("main", "chunk")
    outside = materialize(_by_size(outside, outside, unit_tokens, "own"), "outside-records")
    crossed = _sent(grouped, "chunk", outside, "own", held).union(_sent(outside, "own", grouped, "chunk", held))
    crossed = crossed.distinct().select("rec", "grp", *_unit("home", "own", "chunk"))
    return connected_components(links.union(_linked(_with_texts(crossed, texts))))


def _texts(plain: DataFrame, members: DataFrame, copies: int | None) -> DataFrame:
    """Members with their texts; of equal rows under one identifier one is sent."""

    def fetched(ids: DataFrame) -> DataFrame:
        return plain.join(ids, F.col("id").eqNullSafe(F.col("member_id"))).drop("id", "member_id", "copies")

    if (copies or 1) == 1:
        return fetched(members)
    again = fetched(members.filter("copies > 1"))
    rest = [c for c in again.columns if c != "content"]
    once = again.groupBy(*rest, F.xxhash64("content").alias("text_hash")).agg(F.any_value("content").alias("content"))
    return fetched(members.filter("copies = 1")).unionByName(once.drop("text_hash"))


def _by_size(rows: DataFrame, cut: DataFrame, unit_tokens: int, name: str) -> DataFrame:
    """Column ``name``: parts of at most about ``unit_tokens`` for the homes of
    ``cut`` (null for others), sets of like size together. A home has as many
    bands as its sizes have steps of an eighth, so its bands are few."""
    band = F.floor(F.log("n") / F.log(F.lit(1.125))).alias("band")
    bands = cut.groupBy("home", band).agg(F.sum("n").alias("weight"))
    earlier = Window.partitionBy("home").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    bands = bands.withColumn("before", F.coalesce(F.sum("weight").over(earlier), F.lit(0)))
    third = F.lit(unit_tokens / 3)
    placed = rows.withColumn("band", band).join(bands, ["home", "band"], "left")
    within = F.pmod(F.xxhash64("rec"), F.ceil(F.col("weight") / third).cast("bigint"))
    # A part gets the end of one band, whole bands and the start of another: a third each.
    return placed.withColumn(name, F.floor(F.col("before") / third) + within).drop("band", "weight", "before")


def _sent(rows: DataFrame, own: str, others: DataFrame, other: str, held: DataFrame) -> DataFrame:
    """(home, rec, grp, own, chunk): each record with the parts of ``others`` in
    which a set of another group, of a size that can link, holds one of its tokens."""
    tokens = held.withColumnRenamed("node", "d1")
    # What a part holds of a token: its sizes and groups.
    signs = others.join(tokens, "d1").groupBy("home", F.col(other), "token").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.min("grp").alias("one"), F.max("grp").alias("another")
    )
    near = (F.col("n") * SHARE[1] >= F.col("least") * SHARE[0]) & (F.col("most") * SHARE[1] >= F.col("n") * SHARE[0])
    apart = (F.col("one") != F.col("grp")) | (F.col("another") != F.col("grp"))
    found = rows.join(tokens, "d1").join(signs, ["home", "token"]).filter(near & apart)
    return found.select("home", "rec", "grp", "own", "chunk").distinct()


def _with_texts(dealt: DataFrame, texts: DataFrame) -> DataFrame:
    return dealt.join(texts.select("rec", "d1", "d2", "content"), "rec")


def _unit(first, second, third) -> list:
    return [
        (F.col(c) if isinstance(c, str) else c).cast("bigint").alias(f"unit{k}") for k, c in enumerate((first, second, third), 1)
    ]


def _grouped(records: DataFrame, links: DataFrame) -> DataFrame:
    """Records with the group that the links so far put them in."""
    roots = connected_components(links).withColumnRenamed("node", "rec")
    return records.join(roots, "rec", "left").withColumn("grp", F.coalesce("root", "rec")).drop("root")


def jaccard_records(docs: DataFrame, text: str = "text", row_id: str = "doc_id", unit_tokens: int = UNIT_TOKENS) -> DataFrame:
    """(rec, id, n, d1, d2, component, least_id, least_rec) of every row."""
    plain = _plain(docs, text, row_id)
    sets = document_sets(plain)
    least = F.min(F.struct(F.col("id").isNull().alias("late"), "id", "rec"))
    # Equal sets are one class: one row each, combined before the shuffle. The
    # record of its first row stands for it.
    each = sets.filter("n > 0").groupBy("d1", "d2", "n", "id").agg(F.min("rec").alias("rec"), F.count(F.lit(1)).alias("copies"))
    classes = each.groupBy("d1", "d2", "n").agg(F.min(F.struct("rec", "id", "copies")).alias("lead"), least.alias("least"))
    classes = classes.withColumn("rec", F.col("lead.rec"))
    held = rarest_shared(prefix_tokens(plain, Order(frequent_tokens(plain))), sets)
    roots = linked_records(plain, classes, neighbourhood_edges(held), held, unit_tokens)
    classes = classes.join(roots, classes["rec"] == roots["node"], "left").withColumn("component", F.coalesce("root", "rec"))
    best = classes.groupBy("component").agg(F.min("least").alias("best"))
    named = materialize(classes.select("d1", "d2", "n", "component").join(best, "component"), "class-components")
    # Both sides are read from disk, so a class of very many rows can be split.
    return sets.join(named, ["d1", "d2", "n"], "left").select(
        "rec",
        "id",
        "n",
        F.coalesce("component", "rec").alias("component"),
        F.when(F.col("best").isNotNull(), F.col("best.id")).otherwise(F.col("id")).alias("least_id"),
        F.coalesce("best.rec", "rec").alias("least_rec"),
    )


def _mark(docs: DataFrame, text: str, row_id: str):
    """Identifier and text hash: by both, a class fetches its own text only,
    however many rows share an identifier or have none."""
    ident = docs[f"`{row_id}`"]
    return F.struct(ident.isNull().alias("late"), ident.alias("id"), F.xxhash64(docs[f"`{text}`"]).alias("text_hash"))


def jaccard_components(docs: DataFrame, text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """One row per document: id, n_shingles, component_id."""
    slim = docs.select(_mark(docs, text, row_id).alias("mark"), docs[f"`{text}`"].alias("content"))
    made = jaccard_records(slim, "content", "mark")
    return made.select(F.col("id.id").alias(row_id), F.col("n").alias("n_shingles"), F.col("least_id.id").alias("component_id"))


def drop_near_copies(docs: DataFrame, text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """One document of each component, the one with the smallest identifier,
    with all its columns. Documents without words all stay."""
    mark = _mark(docs, text, row_id)
    slim = docs.select(mark.alias("mark"), docs[f"`{text}`"].alias("content"))
    made = jaccard_records(slim, "content", "mark")
    lost = made.filter("rec != least_rec").select(F.col("id").alias("mark"))
    kept = made.filter("rec = least_rec").select(F.col("id").alias("mark"))
    # A row that repeats a kept one in identifier and text is told apart by number.
    shared = lost.groupBy("mark").count().join(kept.distinct(), "mark", "left_semi").select("mark")
    rows = docs.withColumn("_mark", mark)
    gone = lost.join(kept, "mark", "left_anti").distinct()
    left = rows.join(gone, rows["_mark"].eqNullSafe(gone["mark"]), "left_anti")
    if not shared.isEmpty():
        again = left["_mark"].eqNullSafe(shared["mark"])
        single = left.join(shared, again, "left_anti")
        repeated = left.join(shared, again, "left_semi").dropDuplicates(["_mark"])
        left = single.unionByName(repeated)
    return left.drop("_mark")


@query("op9_jaccard_join")
def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))
