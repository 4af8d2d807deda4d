import re
import zlib

import corpus_pipeline as pipe
from ledgerleaf.llm import toxicity as tox
from test_jaccard_join import brute, made_rows

NAMES = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_against_brute_force(spark, tmp_path):
    rng_rows = [r for r in made_rows(11, 90) if r[0] is not None][:-3]
    rows = [(i, t, "en", f"s{i % 4}", len(t or "")) for i, t in rng_rows]
    rows += [(2000 + i, f"vile words number {i} stand in this text of {i}", "en", "s1", 0) for i in range(120)]
    labels = [(2000 + i, 0, 1) for i in range(120)] + [(i, 1, 0) for i in range(90)]
    sf = str(tmp_path)
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")

    clean = pipe.toxicity(spark, docs, sf)
    assert clean.columns == NAMES
    model = tox.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    kept = sorted((r.doc_id, r.text) for r in clean.collect())
    cut = model.languages.get("en", 0.5)
    scores = model.scores([(r[1] or "").encode() for r in rows])
    assert kept == sorted((r[0], r[1]) for r, s in zip(rows, scores, strict=True) if s < cut)
    assert sum(i >= 2000 for i, _ in kept) <= 2

    unique = pipe.exact_dedup(spark, clean, sf)
    first = {}
    for ident, text in kept:
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), ident)
    left = sorted((r.doc_id, r.text) for r in unique.collect())
    assert sorted(i for i, _ in left) == sorted(first.values())

    near = pipe.near_dedup(spark, unique, sf)
    groups = brute(left)
    assert sorted(r.doc_id for r in near.collect()) == sorted({least for _, n, least in groups if n} | {i for i, n, _ in groups if not n})

    mixed = pipe.mixing(spark, near, sf)
    assert mixed.columns == NAMES and {r.doc_id for r in mixed.collect()} <= {r.doc_id for r in near.collect()}
    last = pipe.run(spark, sf)
    assert last.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(r.doc_id for r in last.collect()) == sorted(r.doc_id for r in mixed.collect())


def test_stages_of_empty_tables(spark, tmp_path):
    sf = str(tmp_path)
    spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    assert pipe.run(spark, sf).count() == 0


def test_held_out_rule():
    assert zlib.crc32(b"5") % tox.FOLDS in range(5) and [name for name, _ in pipe.STAGES][0] == "toxicity"
