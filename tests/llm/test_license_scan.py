import re

import pytest

from ledgerleaf.llm.license_scan import BASE, SQL_TEXT, build_index, license_scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"
CASES = [
    (1, "Licensed under CC BY-NC 4.0."), (2, "licensed under the GNU General Public License, version 3. All rights reserved."),
    (3, MIT), (4, "x " * 50_000 + MIT + " cc-by cc by"), (5, None), (6, ""), (7, "... \n"), (8, "by cc by by"), (9, "reserved rights all"),
    (10, "all rights reserved"), (11, "Permission is hereby granted, free of charge. deal in the software without restriction"),
    (12, "ÉCOLE cc by école 4 0 Licensed under cc BY 4.0"), (13, "KK İ CC\tBY"), (13, "Apache License, Version 2.0"), (None, "public license"),
    (14, "license version 2 0 licensed under the apache license"), (15, "version 2"),
]


def brute(text):
    words = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    at = lambda phrase: [i for i in range(len(words)) if words[i : i + len(phrase)] == phrase]
    base = [(label, i) for phrase, label in BASE.items() for i in at(phrase.split())]
    found = []
    for n in build_index():
        p, key = n.keys[0]
        for start in (i - p for i in at(list(key))):
            there = lambda i, w: 0 <= start + i < len(words) and words[start + i] == w  # noqa: B023, E731
            keys = all(start + q >= 0 and words[start + q : start + q + len(k)] == list(k) for q, k in n.keys)
            if keys and sum(there(i, w) for w, i in n.postings) >= n.needed:
                found.append((n.label, sum(there(i, w) for i, w in enumerate(n.words)) / len(n.words)))
    places = [i for _, i in base]
    labels = sorted({label for label, _ in base})
    score = max([s for _, s in found], default=0.5 if base else 0.0)
    return (len(words), len(base), min(places, default=None), max(places, default=None), ",".join(labels),
            ",".join(sorted({*labels, *(label for label, _ in found)})), score)


def test_brute_force(documents):
    docs = documents(CASES, extra=("words", "hits", "base", "row", "votes"))
    got = sorted((str(r[0]), *r[1:]) for r in license_scan(docs).collect())
    assert got == sorted((str(i), *brute(t)) for i, t in CASES)
    assert license_scan(documents([])).count() == 0


def test_sql(documents, sql_rows):
    docs = documents([c for c in CASES if c[0] != 13])
    names, want = sql_rows(SQL_TEXT, documents=docs.toPandas())
    assert sorted(map(tuple, license_scan(docs).select(*names).collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("notice", build_index(), ids=lambda n: n.label)
def test_every_notice_is_found_in_full(documents, notice):
    row = license_scan(documents([(1, "filler words " + " ".join(notice.words).upper() + " more")])).first()
    assert notice.label in row.labels.split(",") and row.score == 1.0


def test_no_python_in_the_plan(documents):
    plan = license_scan(documents(CASES))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
