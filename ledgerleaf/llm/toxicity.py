"""Toxicity: a convolutional text classifier trained in numpy.

A word's vector is the sum of its parts in two hashed embedding tables, looked
up by independent bits of its hash: a rare word that meets a telling one in one
table does not meet it in the other. Filters of one, two and three words run
over the whole text, each keeps its largest response (max pooling, floor 0),
and a logistic layer weighs the responses. Training follows the gradient to the
winning positions only (Adagrad).

The model is fitted on a bounded sample of labelled rows, ``MAX_LABELLED`` of
either class with texts of at most ``MAX_CHARS`` characters and ``MAX_BYTES``
together, chosen by a hash of the identifier; rows whose crc32(identifier) mod 5 is 0 are never used. Rows
where it is 1 set the thresholds: one for all, moved to 0.5, and one for each
language. All of them that are labelled count, whatever the length of the text,
in a histogram of scores, so a threshold lies on an edge of a bin, at most
1/``BINS`` of log odds from the best. Language, source and labels never enter a
score. Scoring reads every whole text; the model is a broadcast of fixed size.

Defined cases: a null or empty text has no words and gets the score of the bare
bias. Rows without a label, or with a null identifier, train nothing, and a null
identifier is not held out; of several documents of one identifier the one whose
text has the least hash is fitted; with no
usable labels of both classes every score is 0. A language that has fewer than
``MIN_PER_LANGUAGE`` labelled rows among all that set the thresholds, or those
of one class only, has the threshold 0.5; so has null. Repeated rows score alike.
Columns may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerleaf.llm import words as W
from ledgerleaf.llm.mapping import map_texts
from ledgerleaf.llm.registry import query, table
from ledgerleaf.operators.joins import join_unique

MAX_LABELLED = 2000
MAX_CHARS = 50_000
#: Of all texts that are fitted.
MAX_BYTES = 32 << 20
FOLDS, HELD_OUT, CALIBRATION = 5, 0, 1
MIN_PER_LANGUAGE = 20
#: Bins for one unit of log odds, and the log odds beyond which all share a bin.
BINS, FARTHEST = 64, 30

BUCKETS = 1 << 16
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
PAD = max(WIDTHS) - 1
#: Labelled texts that the common rate of toxic texts weighs as in a word's odds.
PRIOR = 10
#: Words whose responses are computed at once: few enough for a core's cache.
BLOCK_WORDS = 1 << 13


@dataclass
class Words:
    """Texts as places in the two tables, with padding after each text."""

    one: np.ndarray
    two: np.ndarray
    starts: np.ndarray  # of each text; windows begin at starts[i] + 0 .. counts[i] - 1
    counts: np.ndarray


def read_words(texts: list[bytes]) -> Words:
    data, offsets = W.joined(texts)
    parts = [W.hash_words(data, offsets[a : b + 1], W.NOT_ALNUM) for a, b in W.blocks(offsets)]
    hashes = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.uint64)
    counts = np.concatenate([np.diff(p[1]) for p in parts]) if parts else np.zeros(0, np.int64)
    ends = np.cumsum(counts + PAD)
    starts = ends - counts - PAD
    place = np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(len(hashes))
    total = int(ends[-1]) if len(ends) else 0
    one, two = (np.full(total + PAD, BUCKETS, np.int32) for _ in range(2))
    one[place] = hashes & np.uint64(BUCKETS - 1)
    two[place] = (hashes >> np.uint64(24)) & np.uint64(BUCKETS - 1)
    return Words(one, two, starts, counts)


class TextCNN:
    def __init__(self, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        draw = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        # The last row stands for padding and stays zero.
        self.tables = [np.vstack([draw(BUCKETS, DIM), np.zeros((1, DIM), np.float32)]) for _ in range(2)]
        self.filters = [draw(width, DIM, FILTERS) for width in WIDTHS]
        self.bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.out = np.abs(draw(len(WIDTHS) * FILTERS)) * 5
        self.shift = -1.0
        self.languages: dict[str, float] = {}

    def start_from(self, words: Words, labels: np.ndarray) -> None:
        """The first number of each vector begins as the word's log odds
        between the classes, which spares many rounds of chance discoveries."""
        owner = np.repeat(np.arange(len(words.counts)), words.counts)
        place = np.repeat(words.starts - (np.cumsum(words.counts) - words.counts), words.counts) + np.arange(len(owner))
        for part, at in zip(self.tables, (words.one, words.two), strict=True):
            pairs = np.unique(owner * BUCKETS + at[place])
            texts, buckets = np.divmod(pairs, BUCKETS)
            toxic = np.bincount(buckets[labels[texts] == 1], minlength=BUCKETS)
            clean = np.bincount(buckets[labels[texts] == 0], minlength=BUCKETS)
            # Drawn towards the common rate, so that a word met once tells little.
            rate = labels.mean()
            odds = np.log(toxic + PRIOR * rate) - np.log(clean + PRIOR * (1 - rate)) - np.log(rate / (1 - rate))
            part[:BUCKETS, 0] = odds / 2
        for weights in self.filters:
            weights[:, 0, :] = np.abs(weights[:, 0, :]) * 5

    def _responses(self, vectors: np.ndarray) -> np.ndarray:
        """Responses of all filters to the windows that begin at each word but
        the last ``PAD``, and a row of zeros."""
        n = len(vectors) - PAD
        every = vectors @ np.concatenate([w for weights in self.filters for w in weights], axis=1)
        value = np.empty((n + 1, len(self.out)), np.float32)
        at = 0
        for j, weights in enumerate(self.filters):
            part = value[:n, j * FILTERS : (j + 1) * FILTERS]
            np.add(every[:n, at : at + FILTERS], self.bias[j], out=part)
            at += FILTERS
            for k in range(1, len(weights)):
                part += every[k : k + n, at : at + FILTERS]
                at += FILTERS
        value[n] = 0
        return value

    def _vectors(self, words: Words, first: int, last: int) -> np.ndarray:
        return self.tables[0][words.one[first:last]] + self.tables[1][words.two[first:last]]

    def pooled(self, words: Words) -> np.ndarray:
        """The largest response of each text and filter, at least 0."""
        best = np.zeros((len(words.counts), len(self.out)), np.float32)
        full = np.flatnonzero(words.counts)
        starts = words.starts[full]
        stops = starts + words.counts[full]
        total = len(words.one) - PAD
        for first in range(0, total, BLOCK_WORDS):
            last = min(first + BLOCK_WORDS, total)
            a, b = np.searchsorted(stops, first, "right"), np.searchsorted(starts, last, "left")
            if a == b:
                continue
            value = self._responses(self._vectors(words, first, last + PAD))
            # Windows in the padding belong to no text.
            begin, end = np.maximum(starts[a:b], first) - first, np.minimum(stops[a:b], last) - first
            edges = np.stack([begin, end], axis=1).ravel()
            top = np.maximum.reduceat(value, edges, axis=0)[::2]
            best[full[a:b]] = np.maximum(best[full[a:b]], top)
        return best

    def logits(self, words: Words) -> np.ndarray:
        return self.pooled(words) @ self.out + self.shift

    def fit(self, words: Words, labels: np.ndarray, rounds: int = 6, batch: int = 32, rate: float = 0.05, seed: int = 11) -> None:
        self.start_from(words, labels)
        params = [*self.tables, *self.filters, *self.bias, self.out]
        squares = [np.full(p.shape, 1e-2, np.float32) for p in params]
        shift_square = 1e-2
        rng = np.random.default_rng(seed)

        def step(k: int, grad: np.ndarray, rows=slice(None)) -> None:
            squares[k][rows] += grad * grad
            params[k][rows] -= rate * grad / np.sqrt(squares[k][rows])

        n_filters = [len(w) for w in self.filters]
        usable = np.flatnonzero(words.counts)
        for _ in range(rounds):
            for chosen in np.array_split(rng.permutation(usable), max(1, len(usable) // batch)):
                where = np.zeros((len(chosen), len(self.out)), np.int64)
                best = np.zeros((len(chosen), len(self.out)), np.float32)
                for i, doc in enumerate(chosen):
                    first, n = words.starts[doc], words.counts[doc]
                    value = self._responses(self._vectors(words, first, first + n + PAD))[:-1]
                    at = value.argmax(axis=0)
                    best[i], where[i] = value[at, np.arange(len(at))], first + at
                pooled = np.maximum(best, 0)
                error = 1 / (1 + np.exp(-(pooled @ self.out + self.shift))) - labels[chosen]
                error = (error / len(chosen)).astype(np.float32)
                back = error[:, None] * self.out[None, :] * (best > 0)
                touched: list[tuple[np.ndarray, np.ndarray]] = []
                for j, width in enumerate(n_filters):
                    part = slice(j * FILTERS, (j + 1) * FILTERS)
                    grad = np.zeros_like(self.filters[j])
                    for k in range(width):
                        at = where[:, part] + k
                        vectors = self.tables[0][words.one[at]] + self.tables[1][words.two[at]]
                        grad[k] = np.einsum("dfi,df->if", vectors, back[:, part])
                        flow = back[:, part, None] * self.filters[j][k].T[None, :, :]
                        touched.append((at.ravel(), flow.reshape(-1, DIM)))
                    step(2 + j, grad)
                    step(2 + len(WIDTHS) + j, back[:, part].sum(axis=0))
                places = np.concatenate([t[0] for t in touched])
                flows = np.concatenate([t[1] for t in touched])
                for k, rows in enumerate((words.one[places], words.two[places])):
                    unique, inverse = np.unique(rows, return_inverse=True)
                    grad = np.zeros((len(unique), DIM), np.float32)
                    np.add.at(grad, inverse, flows)
                    grad[unique == BUCKETS] = 0
                    step(k, grad, unique)
                step(len(params) - 1, pooled.T @ error)
                total = float(error.sum())
                shift_square += total * total
                self.shift -= rate * total / shift_square**0.5

    def calibrate(self, bins: list[Row]) -> None:
        """Moves the best common threshold to 0.5, then sets one per language but null.

        ``bins`` has (lang, bin, low, high, n, toxic) for each language and bin."""
        number = np.array([r.bin for r in bins])
        low, high = np.array([r.low for r in bins], float), np.array([r.high for r in bins], float)
        n, toxic = np.array([r.n for r in bins]), np.array([r.toxic for r in bins])
        common = best_cut(number, low, high, n, toxic)
        self.shift -= common
        places: dict[str | None, list[int]] = {}
        for i, r in enumerate(bins):
            places.setdefault(r.lang, []).append(i)
        for language, mine in places.items():
            if language is not None and 0 < toxic[mine].sum() < n[mine].sum():
                cut = best_cut(number[mine], low[mine] - common, high[mine] - common, n[mine], toxic[mine])
                self.languages[language] = float(sigmoid(cut))

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return sigmoid(self.logits(read_words(texts)))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def best_cut(number: np.ndarray, low: np.ndarray, high: np.ndarray, n: np.ndarray, toxic: np.ndarray) -> float:
    """The threshold of best F1 between bins of log odds; in the middle of the
    gap, the one nearest to 0 of equals."""
    if not 0 < toxic.sum() < n.sum():
        return 0.0
    order = np.argsort(-number, kind="stable")
    first = np.flatnonzero(np.diff(number[order], prepend=np.inf))
    low, high = np.minimum.reduceat(low[order], first), np.maximum.reduceat(high[order], first)
    n, hit = np.add.reduceat(n[order], first), np.cumsum(np.add.reduceat(toxic[order], first))
    f1 = 2 * hit / (np.cumsum(n) + hit[-1])
    cuts = (low + np.append(high[1:], low[-1] - 2)) / 2
    good = np.flatnonzero(f1 >= f1.max() - 1e-12)
    return float(cuts[good[np.abs(cuts[good]).argmin()]])


def fold_of(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def labelled_sample(docs: DataFrame, labels: DataFrame) -> list[tuple[bytes, int]]:
    """(text, label) of the bounded sample that the model is fitted on: at most
    ``2 * MAX_LABELLED`` texts of ``MAX_BYTES`` together, one for each
    identifier and label however many documents share the identifier."""
    usable = labels.select("doc_id", F.col("toxic").alias("label")).filter(~fold_of(F.col("doc_id")).isin(HELD_OUT, CALIBRATION))
    parts = []
    for label in (0, 1):
        mine = usable.filter(F.col("label") == label).dropDuplicates(["doc_id"])
        parts.append(mine.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED))
    # At most 2 * MAX_LABELLED rows.
    chosen = F.broadcast(parts[0].unionByName(parts[1]))
    fits = docs.select("doc_id", "text").filter(F.length("text") <= MAX_CHARS)
    sized = fits.withColumns({"hash": F.xxhash64("text"), "size": F.octet_length("text")}).join(chosen, "doc_id")
    one = sized.groupBy("doc_id", "label").agg(F.min(F.struct("hash", "size")).alias("t"))
    found = one.select("doc_id", "label", "t.hash", "t.size", F.xxhash64("doc_id").alias("turn")).collect()
    kept, held = [], 0
    for row in sorted(found, key=lambda r: (r.turn, r.doc_id, r.label)):
        if held + row.size <= MAX_BYTES:
            held += row.size
            kept.append((row.doc_id, row.label, row.hash))
    if not kept:
        return []
    known = docs.sparkSession.createDataFrame(kept, f"known_id {docs.schema['doc_id'].dataType.simpleString()}, label int, known_hash bigint")
    same = (F.col("doc_id") == F.col("known_id")) & (F.xxhash64("text") == F.col("known_hash"))
    texts = fits.join(F.broadcast(known), same)
    # Equal rows are one text again before any of them moves.
    rows = texts.groupBy("doc_id", "label").agg(F.min("text").alias("text")).collect()
    rows.sort(key=lambda r: (r.doc_id, r.label, r.text))
    return [(r.text.encode("utf-8", "surrogateescape"), r.label) for r in rows]


def score_bins(docs: DataFrame, labels: DataFrame, model: TextCNN, folds: list[int]) -> list[Row]:
    """(lang, bin, low, high, n, toxic) of all labelled rows of the folds;
    languages with fewer than ``MIN_PER_LANGUAGE`` of them count under null.

    Texts are scored where they lie; only their log odds meet the labels."""
    inside = lambda frame: frame.filter(fold_of(F.col("doc_id")).isin(folds))
    scored = score_column(inside(docs.select("doc_id", "text", "lang")), model, ["doc_id", "lang"], odds=True)
    of_class = lambda label: F.max((F.col("toxic") == label).cast("int"))
    known = inside(labels).filter(F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(of_class(0).alias("is_clean"), of_class(1).alias("is_toxic"))
    clipped = F.greatest(F.lit(-float(FARTHEST)), F.least(F.lit(float(FARTHEST)), F.col("score")))
    met = join_unique(scored, known, "doc_id", "inner")
    bins = met.groupBy("lang", F.floor(clipped * BINS).alias("bin")).agg(
        F.min("score").alias("low"),
        F.max("score").alias("high"),
        F.sum(F.col("is_clean") + F.col("is_toxic")).alias("n"),
        F.sum("is_toxic").alias("toxic"),
    )
    # At most 2 * FARTHEST * BINS + 1 rows for each language, so for all rare ones together.
    common = F.sum("n").over(Window.partitionBy("lang")) >= MIN_PER_LANGUAGE
    bins = bins.withColumn("lang", F.when(common, F.col("lang"))).groupBy("lang", "bin")
    return bins.agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"), F.sum("toxic").alias("toxic")).collect()


def train(docs: DataFrame, labels: DataFrame) -> TextCNN | None:
    """A fitted and calibrated model; None without labels of both classes."""
    sample = labelled_sample(docs, labels)
    classes = np.array([label for _, label in sample], np.float32)
    if not 0 < classes.sum() < len(classes):
        return None
    model = TextCNN()
    model.fit(read_words([text for text, _ in sample]), classes)
    bins = score_bins(docs, labels, model, [CALIBRATION])
    if not 0 < sum(r.toxic for r in bins) < sum(r.n for r in bins):
        bins = score_bins(docs, labels, model, [k for k in range(FOLDS) if k != HELD_OUT])
    model.calibrate(bins)
    return model


def score_column(
    docs: DataFrame, model: TextCNN | None, carried: list[str], text: str = "text", into: str = "score", odds: bool = False
) -> DataFrame:
    """The carried columns with the score of each whole text, or its log odds."""
    if model is None:
        return docs.select(*[docs[f"`{c}`"] for c in carried], F.lit(0.0).alias(into))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def report(group: list[bytes]) -> list[pa.Array]:
        made = sent.value.logits(read_words(group)) if odds else sent.value.scores(group)
        return [pa.array(made.astype(np.float64))]

    made = map_texts(docs, text, carried, [T.StructField("score", T.DoubleType())], report)
    return made.select("row.*", F.col("score").alias(into))


def threshold(language, model: TextCNN | None):
    """The calibrated threshold of a language column."""
    known = sorted(model.languages.items()) if model else []
    if not known:
        return F.lit(0.5)
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in known for x in pair]), language), F.lit(0.5))


def drop_toxic(docs: DataFrame, labels: DataFrame, model: TextCNN | None = None) -> DataFrame:
    """The rows below the threshold of their language, with all their columns."""
    model = model or train(docs, labels)
    nested = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("whole"), docs["text"], docs["lang"])
    scored = score_column(nested, model, ["whole", "lang"])
    return scored.filter(F.col("score") < threshold(F.col("lang"), model)).select("whole.*")


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    held_out = F.coalesce(fold_of(F.col("doc_id")) == HELD_OUT, F.lit(False))
    scored = score_column(docs, model, ["doc_id", "lang"])
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        threshold(F.col("lang"), model).alias("language_threshold"),
    )
