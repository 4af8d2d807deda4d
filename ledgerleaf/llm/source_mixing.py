r"""Mixing sources to target weights.

A document's size is its number of words (runs of anything but
``[\x20\x09-\x0D]``). Sources, in code point order with null last, get the
weights 5, 2, 1, 5, 2, 1, ... and share all words by weight. No target exceeds
three times the words of its source; what is above is shared again by weight
until none is above. The repetition rate of a source is target / words. Each of
its documents is taken floor(rate) times and once more with a probability equal
to the fraction, drawn from a hash of the seed and the document's identifier,
so that reruns agree.

Sizes are counted once and kept in the shared folder. All that follows works on
one pre-aggregated row per source; the resharing loop brings only four numbers
to the driver in each round, and source ranks come from a range-partitioned
numbering, so the number of sources may grow as well.

Defined cases: a null or empty text has size 0 and is taken like any other of
its source. If all sizes are 0 every target is 0 and nothing is taken. A null
identifier draws as the text "null"; repeated rows draw alike. An empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerleaf.llm.registry import query, table
from ledgerleaf.operators.ordered import numbered
from ledgerleaf.scratch import materialize

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
SEED = "mix"
#: A draw uses 52 bits of the digest: every value is exact as a double.
_DIGITS, _STEPS = 13, float(1 << 52)


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def draw(row_id: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on the seed and the identifier alone."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(row_id.cast("string"), F.lit("null"))).cast("binary"))
    return F.conv(F.left(digest, F.lit(_DIGITS)), 16, 10).cast("double") / F.lit(_STEPS)


def source_targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """(source, source_size, target) from rows (source, size)."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = numbered(totals, [F.col("source").asc_nulls_last()], name="place")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    weighted = materialize(ranked.withColumn("weight", weight.cast("bigint")), "source-weights")
    share, full = 0.0, -1
    while True:
        # Sources at their most stay there: a share only ever grows.
        over = F.col("weight") * F.lit(share) >= F.col("source_size") * F.lit(most)
        now = weighted.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)).alias("words"),
            F.coalesce(F.sum(F.when(over, F.col("source_size") * most)), F.lit(0)).alias("held"),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)).alias("open"),
            F.count(F.when(over, F.lit(1))).alias("full"),
        ).first()
        if now["open"] == 0 or now["full"] == full:
            break
        full = now["full"]
        share = (now["words"] - now["held"]) / now["open"]
    return weighted.select(
        "source",
        "source_size",
        F.least(F.col("weight") * F.lit(share), (F.col("source_size") * most).cast("double")).alias("target"),
    )


def copies(rate: Column, row_id: Column, seed: str = SEED) -> Column:
    whole = F.floor(rate)
    return (whole + F.when(draw(row_id, seed) < rate - whole, 1).otherwise(0)).cast("bigint")


def mix_plan(docs: DataFrame, text: str = "text", row_id: str = "doc_id", source: str = "source") -> DataFrame:
    """One row per document: id, size, source_size, target and the copies the mix takes."""
    sized = materialize(
        docs.select(
            docs[f"`{row_id}`"].alias("id"), docs[f"`{source}`"].alias("source"), word_count(docs[f"`{text}`"]).alias("size")
        ),
        "document-sizes",
    )
    return _with_copies(sized, source_targets(sized))


def _with_copies(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Rows with their source's figures.

    A source may hold any share of the rows: the targets join as a side with a
    shuffle of its own, which adaptive execution can split against.
    """
    wide = targets.withColumnRenamed("source", "target_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    joined = rows.join(wide, rows["source"].eqNullSafe(wide["target_source"]), "left").drop("target_source")
    return joined.withColumn("copies", copies(F.least(rate, F.lit(float(MOST_REPEATS))), F.col("id")))


def mix_sources(docs: DataFrame, text: str = "text", row_id: str = "doc_id", source: str = "source") -> DataFrame:
    """The mix itself: each document as often as the mix takes it, with its columns."""
    sized = materialize(
        docs.select(docs[f"`{source}`"].alias("source"), word_count(docs[f"`{text}`"]).alias("size")), "document-sizes"
    )
    targets = source_targets(sized)
    row = F.struct(*[docs[f"`{name}`"] for name in docs.columns])
    rows = docs.select(row.alias("row"), docs[f"`{row_id}`"].alias("id"), docs[f"`{source}`"].alias("source"))
    planned = _with_copies(rows, targets).filter("copies > 0")
    return planned.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")


SQL = r"""
with sized as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size
  from documents
), totals as (
  select source, cast(sum(size) as bigint) as source_size from sized group by source
), weighted as (
  select *, case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5 when 1 then 2 else 1 end as weight
  from totals
), ordered as (
  select *, coalesce(sum(3 * source_size) over before, 0) as held, sum(weight) over rest as open,
         sum(source_size) over () as words,
         row_number() over (order by 3 * source_size / weight, source nulls last) as step
  from weighted
  window before as (order by 3 * source_size / weight, source nulls last rows between unbounded preceding and 1 preceding),
         rest as (order by 3 * source_size / weight, source nulls last rows between current row and unbounded following)
), shares as (
  select *, cast(words - held as double) / cast(open as double) as share from ordered
), level as (
  select coalesce(arg_min(share, step) filter (weight * share <= 3 * source_size), 0) as share from shares
), targets as (
  select source, source_size, least(weight * level.share, cast(3 * source_size as double)) as target from weighted, level
), rated as (
  select doc_id, size, source_size, target,
         case when source_size > 0 then least(target / source_size, 3.0) else 0.0 end as rate,
         cast(('0x' || left(md5('mix:' || coalesce(cast(doc_id as varchar), 'null')), 13)) as bigint) / 4503599627370496.0 as draw
  from sized join targets on sized.source is not distinct from targets.source
)
select doc_id, size, source_size, target,
       size * (cast(floor(rate) as bigint) + case when draw < rate - floor(rate) then 1 else 0 end) as taken
from rated
"""


@query("op8_source_mixing", SQL)
def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mix_plan(table(spark, sf_dir, "documents"))
    return plan.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )
