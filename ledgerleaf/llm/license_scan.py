r"""Licence scan with a positional rare-token index, in Spark expressions only.

Notices are short texts of words. A word's weight is its inverse frequency
among the notices (IDF); the ``RARE`` highest-weighted words of each notice are
its rare tokens, and the index holds every position of them: token -> postings
(notice, position). A file's rare tokens are looked up wherever they stand.
A posting at notice position q met at file position p says that the notice
would begin at p - q; a notice is a candidate where at least half of its
postings agree on one beginning. A candidate counts once its mandatory key
phrases stand word for word at their places.

Plain phrases (``BASE``) are found through the same index of places, at every
place where their words stand one after another.

Everything about a file happens in its own row: no shuffle, no Python, work
linear in its words. The index is a literal of fixed size.

Defined cases: a null or empty text has no words, null first and last word,
empty labels and score 0. Every row gives one row, so ties and repeated rows
need no rule; an empty table gives an empty result. Columns may have any name.
The score is 1 for a base phrase only when it is part of a full notice: it is
the largest share of a found notice's words that stand at their places, 0.5
if there are base phrases alone, else 0.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerleaf.llm.registry import query, table

RARE = 5

# Phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Runs of lower-case letters, digits and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Label, notice, mandatory key phrases (wording of the public licences).
NOTICES = (
    ("agpl", "gnu affero general public license", ("affero general public license",)),
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that"
        " the following conditions are met",
        ("redistribution and use in source and binary forms", "following conditions are met"),
    ),
    ("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    ("cc0-1.0", "cc0 1 0 universal public domain dedication", ("cc0 1 0 universal",)),
    ("gpl-2.0", "licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    ("gpl-3.0", "licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    (
        "gpl-notice",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general"
        " public license as published by the free software foundation",
        ("free software you can redistribute it", "terms of the gnu general public license"),
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby"
        " granted",
        ("distribute this software for any purpose with or without fee",),
    ),
    ("lgpl", "gnu lesser general public license", ("lesser general public license",)),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
        " documentation files the software to deal in the software without restriction",
        ("permission is hereby granted free of charge", "deal in the software without restriction"),
    ),
    (
        "mpl-2.0",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        ("terms of the mozilla public license v 2 0",),
    ),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        ("unencumbered software released into the public domain",),
    ),
)


@dataclass(frozen=True)
class Notice:
    number: int
    label: str
    words: tuple[str, ...]
    keys: tuple[tuple[int, tuple[str, ...]], ...]  # position in the notice, words
    postings: tuple[tuple[str, int], ...]  # rare token, position

    @property
    def needed(self) -> int:
        return math.ceil(len(self.postings) / 2)


def _place(words: tuple[str, ...], phrase: tuple[str, ...]) -> int:
    return next(i for i in range(len(words)) if words[i : i + len(phrase)] == phrase)


def build_index(notices=NOTICES, rare: int = RARE) -> list[Notice]:
    split = [tuple(text.split()) for _, text, _ in notices]
    known_in = Counter(word for words in split for word in set(words))
    made = []
    for number, ((label, _, keys), words) in enumerate(zip(notices, split, strict=True)):
        by_weight = sorted(set(words), key=lambda w: (known_in[w], words.index(w)))
        tokens = set(by_weight[:rare])
        phrases = tuple((_place(words, tuple(k.split())), tuple(k.split())) for k in keys)
        made.append(Notice(number, label, words, phrases, tuple((w, i) for i, w in enumerate(words) if w in tokens)))
    return made


def _strings(words) -> Column:
    return F.array(*[F.lit(w) for w in words])


def _stands(words: Column, start: Column, phrase: Column) -> Column:
    """Whether the phrase's words stand at ``start`` (from 0)."""
    return (start >= 0) & (F.slice(words, F.greatest(start, F.lit(0)) + 1, F.size(phrase)) == phrase)


def _phrase_places(phrase: tuple[str, ...], label: str) -> Column:
    """(label, at) of each place of a phrase, from the columns hits and words."""
    ends = F.filter("hits", lambda h: h.w == phrase[-1])
    starts = F.transform(ends, lambda h: h.p - (len(phrase) - 1))
    good = F.filter(starts, lambda s: _stands(F.col("words"), s, _strings(phrase)))
    return F.transform(good, lambda s: F.struct(F.lit(label).alias("label"), s.alias("at")))


def license_matches(docs: DataFrame, carried: list[str], text: str = "text", notices: list[Notice] | None = None) -> DataFrame:
    """The carried columns (nested in ``row``) with n_words, ``base`` (array of
    label and place) and ``found`` (array of label, place and share)."""
    notices = build_index() if notices is None else notices
    by_number = {
        "label": F.array(*[F.lit(n.label) for n in notices]),
        "needed": F.array(*[F.lit(n.needed) for n in notices]),
        "words": F.array(*[_strings(n.words) for n in notices]),
        "keys": F.array(
            *[F.array(*[F.struct(F.lit(p).alias("at"), _strings(k).alias("words")) for p, k in n.keys]) for n in notices]
        ),
    }
    of = lambda name, number: F.element_at(by_number[name], number + 1)
    postings: dict[str, list[Column]] = {}
    for notice in notices:
        for word, at in notice.postings:
            postings.setdefault(word, []).append(F.struct(F.lit(notice.number).alias("n"), F.lit(at).alias("at")))
    index = F.create_map(*[x for word, where in postings.items() for x in (F.lit(word), F.array(*where))])
    # A plain phrase is looked up by its last word.
    phrases = {tuple(phrase.split()): label for phrase, label in BASE.items()}
    looked_up = sorted(set(postings) | {phrase[-1] for phrase in phrases})

    # Only A-Z matter here: lower() changes letters beyond ASCII too, but makes
    # no word end elsewhere, and no word of the index holds one.
    lowered = F.lower(F.coalesce(docs[f"`{text}`"], F.lit("")))
    df = docs.select(
        F.struct(*[docs[f"`{name}`"] for name in carried]).alias("row"),
        F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0)).alias("words"),
    )
    seen = F.transform("words", lambda w, i: F.when(w.isin(looked_up), F.struct(i.alias("p"), w.alias("w"))))
    df = df.withColumn("hits", F.filter(seen, lambda x: x.isNotNull()))

    df = df.withColumn("base", F.concat(*[_phrase_places(phrase, label) for phrase, label in phrases.items()]))

    votes = F.flatten(
        F.transform(
            F.filter("hits", lambda h: F.map_contains_key(index, h.w)),
            lambda h: F.transform(index[h.w], lambda q: F.struct(q.n.alias("n"), (h.p - q["at"]).alias("start"))),
        )
    )
    df = df.withColumn("votes", F.array_sort(votes))
    # Equal votes are neighbours: the first of a run long enough is a candidate.
    agreed = F.filter(
        "votes",
        lambda v, i: ((i == 0) | (F.get("votes", i - 1) != v)) & F.coalesce(F.get("votes", i + of("needed", v.n) - 1) == v, F.lit(False)),
    )
    verified = F.filter(
        agreed, lambda v: F.forall(of("keys", v.n), lambda k: _stands(F.col("words"), v.start + k["at"], k.words))
    )

    def share(v: Column) -> Column:
        own = of("words", v.n)
        fits = F.filter(own, lambda w, i: F.coalesce(F.get("words", v.start + i) == w, F.lit(False)))
        return F.size(fits).cast("double") / F.size(own)

    found = F.transform(
        verified, lambda v: F.struct(of("label", v.n).alias("label"), v.start.alias("at"), share(v).alias("share"))
    )
    return df.withColumn("found", found).select("row", F.size("words").cast("bigint").alias("n_words"), "base", "found")


def license_scan(docs: DataFrame, text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """One row per file; see the module's docstring."""
    m = license_matches(docs, [row_id], text)
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    score = F.coalesce(F.array_max("found.share"), F.when(F.size("base") > 0, 0.5), F.lit(0.0))
    return m.select(
        F.col(f"row.`{row_id}`").alias(row_id),
        "n_words",
        F.size("base").cast("bigint").alias("n_base"),
        F.array_min("base.at").cast("bigint").alias("first_word"),
        F.array_max("base.at").cast("bigint").alias("last_word"),
        joined(F.col("base.label")).alias("base_labels"),
        joined(F.concat("base.label", "found.label")).alias("labels"),
        score.alias("score"),
    )


def _sql() -> str:
    """The same by trying every notice at every place."""

    def stands(start: str, phrase) -> str:
        items = ", ".join(f"'{w}'" for w in phrase)
        return f"({start} >= 0 and words[{start} + 1 : {start} + {len(phrase)}] = [{items}])"

    base, found = [], []
    for phrase, label in BASE.items():
        last = phrase.split()
        base.append(
            f"list_transform(list_filter(list_filter(places, lambda p: words[p + 1] = '{last[0]}'), lambda p: {stands('p', last)}),"
            f" lambda p: {{'label': '{label}', 'at': p}})"
        )
    for n in build_index():
        at, key = n.keys[0]
        starts = f"list_transform(list_filter(places, lambda p: words[p + 1] = '{key[0]}'), lambda p: p - {at})"
        tests = [stands(f"(s + {p})", k) for p, k in n.keys]
        one = lambda i, w: f"(case when s + {i} >= 0 and words[s + {i} + 1] = '{w}' then 1 else 0 end)"
        votes = " + ".join(one(i, w) for w, i in n.postings)
        fits = " + ".join(one(i, w) for i, w in enumerate(n.words))
        found.append(
            f"list_transform(list_filter({starts}, lambda s: {' and '.join(tests)} and {votes} >= {n.needed}),"
            f" lambda s: {{'label': '{n.label}', 'share': cast({fits} as double) / {len(n.words)}}})"
        )
    az, low = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
with split as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{az}', '{low}'), '{WORD}') as words from documents
), placed as (
  select *, range(len(words)) as places from split
), matched as (
  select doc_id, cast(len(words) as bigint) as n_words, {" || ".join(base)} as base, {" || ".join(found)} as found from placed
)
select doc_id, n_words, cast(len(base) as bigint) as n_base,
       list_min(list_transform(base, lambda b: b.at)) as first_word, list_max(list_transform(base, lambda b: b.at)) as last_word,
       coalesce(array_to_string(list_sort(list_distinct(list_transform(base, lambda b: b.label))), ','), '') as base_labels,
       coalesce(array_to_string(list_sort(list_distinct(
         list_transform(base, lambda b: b.label) || list_transform(found, lambda f: f.label))), ','), '') as labels,
       coalesce(list_max(list_transform(found, lambda f: f.share)), case when len(base) > 0 then 0.5 end, 0.0) as score
from matched
"""


SQL_TEXT = _sql()


@query("op1_license_scan", SQL_TEXT)
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))
