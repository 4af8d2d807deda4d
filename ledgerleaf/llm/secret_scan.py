"""Secret scans: patterns find candidates, a random forest removes false ones.

Candidates are found in every whole text: keys of a known form, values assigned
to a telling name, and long mixed strings. The forest judges each by its
length, its character transitions (mean log probability of its letter pairs in
ordinary words, changes between letters, digits and case), the share covered by
dictionary words, the path or source it stands in, and its neighbouring words.

Labelled findings are made by ``labelled_findings``: secrets of each form and
look-alikes (digests, identifiers, placeholders, long words, examples) in the
usual surroundings, drawn with a fixed seed. A table of labelled findings can
be given instead; it is fitted on at most ``MAX_LABELLED`` rows, chosen by hash.
The dictionary is the ordinary words of ``ORDINARY``; the model is a broadcast
of fixed size. Texts are mapped without a shuffle.

Candidates are taken whole, however long. A private key goes up to its END line
and may have header lines; without that line it goes as far as key text does.

Defined cases: a null or empty text has no candidate and gives no row; so does
an empty table. A value or mixed string that lies in an assigned value is counted
once, with that value; a key of a known form inside a longer value or mixed
string, or an assignment whose name ends such a string, has a row of its own.
Null paths and identifiers are allowed. Repeated rows give repeated findings.
Columns may have any name.
"""

from __future__ import annotations

import functools
import math
import random
import re
import string
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerleaf.llm.mapping import text_groups
from ledgerleaf.llm.registry import query, table
from ledgerleaf.llm.trees import Forest

MAX_LABELLED = 20_000
#: Characters before and after a candidate that are read for its neighbours.
AROUND = 60

# Forms of published key formats.
_KEY_TEXT = r"Proc-Type:\s*+\d,[A-Z-]++|DEK-Info:\s*+[A-Z0-9-]++,[0-9A-Fa-f]++|\\++[nr]|\s|[A-Za-z0-9+/=]++"
_HEADER_LINE = r"(?:\n|\\++n)[ \t]*+[A-Za-z][A-Za-z0-9-]*+:[^\n\\]*+"
FORMS = (
    (
        "private_key",
        r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"
        rf"(?:(?:{_HEADER_LINE}|{_KEY_TEXT})*+-----END (?:[A-Z]+ )*PRIVATE KEY-----|(?:{_KEY_TEXT})*+)",
    ),
    ("cloud_key", r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])"),
    ("forge_token", r"(?<![A-Za-z0-9])gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])"),
    ("chat_token", r"(?<![A-Za-z0-9])xox[abprs]-[A-Za-z0-9-]{10,}"),
    ("web_token", r"(?<![A-Za-z0-9])eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    (
        "assigned",
        r"(?i:passw(?:or)?d|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|credential)s?[\"']?\s*+[:=]\s*+[\"']?"
        r"(?P<value>[^\s\"',;<>]{6,}+)",
    ),
    ("mixed", r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}"),
)
SEARCH = re.compile("|".join(f"(?P<{name}>{form})" for name, form in FORMS))
KNOWN = re.compile("|".join(f"(?P<{name}>{form})" for name, form in FORMS if name not in ("assigned", "mixed")))
DIGIT, LETTER = re.compile("[0-9]"), re.compile("[A-Za-z]")
KINDS = [name for name, _ in FORMS]

TELLING = ("password", "passwd", "pwd", "secret", "token", "key", "api", "auth", "credential", "login", "bearer", "private")
INNOCENT = ("example", "sample", "dummy", "test", "placeholder", "commit", "sha", "hash", "md5", "checksum", "digest", "uuid", "id",
            "revision", "fixture", "changeme", "your", "xxx", "integrity", "etag", "build", "version")
ORDINARY = (
    "the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which one you were all"
    " her she there would their we him been has when who will no more if out so up said what its about than into them can only other"
    " time new some could these two may first then do any like my now over such our man me even most made after also well many before"
    " must through back years where much your way down should because long each just state those people too mr how little good world"
    " make very year still see own work men day get here old life both between being under three never know same last another while us"
    " off might great go come since against right came take used himself few house use place during high without again home around"
    " small however found mrs part thought went say general once upon school every data value name user file code test example sample"
    " change password secret token key config default server client request response number string letter document version license"
).split()


@functools.cache
def _pairs() -> dict[str, float]:
    counts = Counter(a + b for word in ORDINARY for a, b in zip(word, word[1:], strict=False))
    total = sum(counts.values()) + 26 * 26
    return {a + b: math.log((counts[a + b] + 1) / total) for a in string.ascii_lowercase for b in string.ascii_lowercase}


_DICTIONARY = sorted((w for w in set(ORDINARY) if len(w) >= 4), key=lambda w: (-len(w), w))
_COVER = re.compile("|".join(map(re.escape, _DICTIONARY)))
_CLASS = {**dict.fromkeys(string.ascii_lowercase, 0), **dict.fromkeys(string.ascii_uppercase, 1), **dict.fromkeys(string.digits, 2)}

FEATURES = (
    "kind length entropy pair_log_probability class_changes lower_share upper_share digit_share hex_share distinct_share"
    " dictionary_share longest_run telling_before innocent_before innocent_after innocent_inside telling_path innocent_path quoted"
    " dashes repeated_pattern"
).split()


def features(kind: str, value: str, before: str, after: str, path: str) -> list[float]:
    """The numbers the forest sees, in the order of ``FEATURES``."""
    n, low = len(value), value.lower()
    counts = Counter(value)
    pairs = _pairs()
    logs = [pairs[low[i : i + 2]] for i in range(n - 1) if low[i : i + 2] in pairs]
    classes = [_CLASS.get(c, 3) for c in value]
    changes = sum(a != b for a, b in zip(classes, classes[1:], strict=False))
    run = longest = 1
    for a, b in zip(value, value[1:], strict=False):
        run = run + 1 if a == b else 1
        longest = max(longest, run)
    words_before = set(re.findall(r"[a-z]+", before.lower())[-6:])
    words_after = set(re.findall(r"[a-z]+", after.lower())[:4])
    steps = sum(ord(b) - ord(a) == 1 for a, b in zip(value, value[1:], strict=False))
    return [
        KINDS.index(kind),
        n,
        -sum(c / n * math.log2(c / n) for c in counts.values()),
        sum(logs) / len(logs) if logs else -9.0,
        changes / max(1, n - 1),
        classes.count(0) / n,
        classes.count(1) / n,
        classes.count(2) / n,
        sum(c in "0123456789abcdef" for c in low) / n,
        len(counts) / n,
        sum(len(m) for m in _COVER.findall(low)) / n,
        longest,
        len(words_before.intersection(TELLING)),
        len(words_before.intersection(INNOCENT)),
        len(words_after.intersection(INNOCENT)),
        sum(w in low for w in INNOCENT if len(w) > 3),
        sum(w in path.lower() for w in TELLING),
        sum(w in path.lower() for w in INNOCENT if len(w) > 3),
        float(before[-1:] in "\"'" and before != ""),
        value.count("-") / n,
        steps / n,
    ]


def candidates(text: str) -> Iterator[tuple[str, int, str]]:
    """(kind, start, value) of each candidate, left to right."""
    at = 0
    while found := SEARCH.search(text, at):
        at = found.end()
        kind = found.lastgroup if found.lastgroup != "value" else "assigned"
        if kind == "assigned":
            start, end = found.span("value")
            yield kind, start, found["value"]
            for inner in KNOWN.finditer(text, start + 1, end):
                yield inner.lastgroup, inner.start(), inner[0]
        elif kind == "mixed":
            if DIGIT.search(found[0]) and LETTER.search(found[0]):
                yield kind, found.start(), found[0]
            # No second mixed string starts in the run, but other forms may.
            at = found.start() + 1
        else:
            yield kind, found.start(), found[0]


def labelled_findings(n: int = 6000, seed: int = 3) -> list[tuple[str, str, int]]:
    """(text, path, label): one candidate in its surroundings each."""
    rng = random.Random(seed)
    alnum = string.ascii_letters + string.digits
    draw = lambda letters, k: "".join(rng.choice(letters) for _ in range(k))
    word = lambda: rng.choice(ORDINARY)
    prose = lambda k: " ".join(word() for _ in range(k))
    name = lambda: rng.choice(("password", "passwd", "secret", "token", "api_key", "apikey", "access_key", "pwd"))
    mark = lambda: rng.choice(("=", " = ", ": ", ":"))
    quote = lambda v: rng.choice((v, f'"{v}"', f"'{v}'"))
    true = (
        lambda: rng.choice(("AKIA", "ASIA")) + draw(string.ascii_uppercase + string.digits, 16),
        lambda: f"gh{rng.choice('pousr')}_" + draw(alnum, 36),
        lambda: f"xox{rng.choice('abprs')}-{draw(string.digits, 11)}-{draw(alnum, 24)}",
        lambda: f"eyJ{draw(alnum, 20)}.eyJ{draw(alnum, 40)}.{draw(alnum + '_-', 43)}",
        lambda: f"-----BEGIN RSA PRIVATE KEY-----\n{draw(alnum + '+/', 64)}\n-----END RSA PRIVATE KEY-----",
        lambda: name() + mark() + quote(draw("0123456789abcdef", rng.randrange(12, 48))),
        lambda: name() + mark() + quote(draw(alnum, rng.randrange(8, 40))),
        lambda: name() + mark() + quote(draw(alnum + "!#%&*+-_", rng.randrange(8, 24))),
        lambda: rng.choice(("bearer ", "auth key ", "secret key ", "login token ")) + draw(alnum + "+/", rng.randrange(24, 48)),
    )
    false = (
        lambda: rng.choice(("commit ", "revision ", "sha ", "md5 ", "checksum: ", "digest ")) + draw("0123456789abcdef", rng.choice((32, 40, 64))),
        lambda: rng.choice(("uuid ", "id ", "build ", "")) + "-".join(draw("0123456789abcdef", k) for k in (8, 4, 4, 4, 12)),
        lambda: name() + mark() + quote(rng.choice(("changeme", "your_password_here", "example-token-value", "xxxxxxxxxxxx", "placeholder",
                                                    "password", "secret123", "test1234", "dummy_value_1", "************", "<token>xxxx"))),
        lambda: name() + mark() + word() + word() + word() + word(),
        lambda: name() + mark() + rng.choice(("os.environ", "config.get(key)", "getenv(NAME)", "${SECRET_NAME}", "{{password}}", "request.token")),
        lambda: rng.choice(("AKIA", "ASIA")) + rng.choice(("IOSFODNN7EXAMPLE", "XXXXXXXXXXXXXXXX", "0000000000000000", "1234567890123456", "EXAMPLEEXAMPLE12")),
        lambda: "_".join(word() for _ in range(5)) + str(rng.randrange(100)),
        lambda: "-".join(word() for _ in range(5)) + "-" + str(rng.randrange(3000)),
        lambda: "example " + name() + mark() + quote(draw(alnum, rng.randrange(8, 30))),
        lambda: "/".join(word() for _ in range(6)) + "/" + str(rng.randrange(9999)),
        lambda: "".join(word() for _ in range(6)) + str(rng.randrange(10)),
        lambda: draw(string.digits, 24) + "a",
        lambda: "integrity hash sha" + draw("0123456789", 3) + "-" + draw(alnum + "+/", 43) + "=",
        lambda: rng.choice(("ghp_", "gho_")) + rng.choice(("x" * 36, "0" * 36, "abcdefghijklmnopqrstuvwxyz0123456789")),
    )
    made = []
    for _ in range(n):
        label = int(rng.random() < 0.5)
        middle = rng.choice(true if label else false)()
        path = rng.choice(("src/app/main.py", "config/settings.yaml", ".env", "src1", "src12", "web", "deploy/secrets.env") if rng.random() < 0.85
                          else ("tests/fixtures/sample.json", "docs/example.md"))
        made.append((f"{prose(rng.randrange(8))} {middle} {prose(rng.randrange(8))}", path, label))
    return made


def train(findings: list[tuple[str, str, int]] | None = None) -> Forest:
    """A forest on labelled findings; each text's candidates bear its label."""
    rows, labels = [], []
    for text, path, label in labelled_findings() if findings is None else findings:
        for kind, start, value in candidates(text):
            end = start + len(value)
            rows.append(features(kind, value, text[max(0, start - AROUND) : start], text[end : end + AROUND], path))
            labels.append(label)
    return Forest.fit(np.array(rows, float).reshape(-1, len(FEATURES)), np.array(labels))


def findings_of(table_: DataFrame) -> list[tuple[str, str, int]]:
    """At most ``MAX_LABELLED`` rows (text, path, label), chosen by hash."""
    chosen = table_.select("text", "path", "label").orderBy(F.xxhash64("text", "path"), "text", "path", "label").limit(MAX_LABELLED)
    return [(r.text or "", r.path or "", int(r.label)) for r in chosen.collect()]


def secret_scan(docs: DataFrame, model: Forest | None = None, text: str = "text", row_id: str = "doc_id", path: str = "source") -> DataFrame:
    """One row per candidate: id, kind, place and length in characters, score
    and whether it is taken for a secret (score of 0.5 or more)."""
    sent = docs.sparkSession.sparkContext.broadcast(train() if model is None else model)
    schema = T.StructType(
        [
            T.StructField(row_id, docs.schema[row_id].dataType),
            T.StructField("kind", T.StringType()),
            T.StructField("place", T.LongType()),
            T.StructField("n_chars", T.LongType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
    arrow = to_arrow_schema(schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, paths = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for first, group in text_groups(batch.column(2)):
                found, rows = [], []
                for k, raw in enumerate(group, first):
                    whole = raw.decode("utf-8", "surrogateescape")
                    for kind, start, value in candidates(whole):
                        end = start + len(value)
                        found.append((ids[k], kind, start, len(value)))
                        before, after = whole[max(0, start - AROUND) : start], whole[end : end + AROUND]
                        rows.append(features(kind, value, before, after, paths[k] or ""))
                scores = sent.value.probability(np.array(rows, float).reshape(-1, len(FEATURES)))
                columns = [*(zip(*found, strict=True) if found else ([], [], [], [])), scores]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    slim = docs.select(docs[f"`{row_id}`"].alias("id"), docs[f"`{path}`"].alias("path"), docs[f"`{text}`"].alias("content"))
    return slim.mapInArrow(work, schema).withColumn("secret", F.col("score") >= 0.5)


@query("op4_secret_scan")
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents"))
