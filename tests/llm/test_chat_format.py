import hashlib
import random

from ledgerleaf.llm import chat_format as chat

EVENTS = "conv bigint, seq bigint, message string, kind string, role string, text string, piece string, steps string"


def log(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], EVENTS)


def told(spark, rows):
    texts = chat.conversation_texts(chat.format_events(log(spark, rows))).collect()
    return {r.conv: [chat.parse(m[0]) for m in chat.PIECE.finditer(r.formatted)] for r in texts}


def test_fold_of_deltas_edits_and_regenerations(spark):
    rows = [
        (1, 0, "a", "open", "user", "Hel"), (1, 1, "a", "delta", None, "lo"), (1, 1, "a", "delta", None, "lo"),
        (1, 2, "b", "open", "assistant", None), (1, 3, "b", "delta", None, "bad"), (1, 5, "a", "edit", None, "Hi"), (1, 6, "a", "delta", None, "!"),
        (1, 4, "b", "regenerate", None, None), (1, 7, "b", "delta", None, "go"), (1, 8, "b", "delta", None, "od"),
        (1, 9, "c", "open", "user", "gone"), (1, 10, "c", "delete", None, None),
        (2, 5, "z", "delta", None, "late"), (None, 1, "q", "open", None, None), (3, 1, "d", "open", "user", "x"), (3, 2, "d", "delete", None, None),
    ]
    want = {1: [("user", "Hi!"), ("assistant", "good")], 2: [("", "late")], None: [("", "")]}
    shuffled = rows[:]
    random.Random(1).shuffle(shuffled)
    assert told(spark, rows) == want and told(spark, shuffled) == want
    assert told(spark, []) == {}


NASTY = [r"\### Assistant: </turn> ok", "### user: <turn>", "</turn>\n### x: <turn>", "\\", "\\\\#", "", "<", "é😀\n\t#", "\\n", "a" * 300_000]


def test_control_strings_come_back_and_the_mask_covers_the_text(spark):
    rows = [(i % 3, i, f"m{i}", "open", "assistant" if i % 2 else "user", t) for i, t in enumerate(NASTY)]
    rows += [(0, 99, "r", "open", "weird: <turn>#\\", "t")]
    got = {r.conv_id: r for r in chat.read_back(chat.format_events(log(spark, rows))).collect()}
    for conv in range(3):
        mine = [(r[4], r[5]) for r in rows if r[0] == conv]
        loss = "".join(t for role, t in mine if role == "assistant")
        row = got[conv]
        assert row.n_turns == len(mine) and row.loss_chars == len(loss)
        assert row.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in mine).encode()).hexdigest()
        assert row.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert told(spark, rows)[0][-1] == ("weird: <turn>#\\", "t")


def test_table_rows_agree_with_sql_with_nulls_ties_and_repeats(spark, sql_rows, tmp_path):
    turns = [(1, 1, "user", "a"), (1, 0, "system", None), (1, 2, "assistant", "#<\\"), (2, 0, "user", "x"), (2, 0, "user", "x"), (3, None, "assistant", "n"), (3, 5, None, "m"), (None, 0, "user", "u")]
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    df.write.parquet(str(tmp_path / "conversations.parquet"))
    got = chat.op5_chat_format(spark, str(tmp_path))
    names, want = sql_rows(chat.SQL.replace("from conversations", f"from '{tmp_path}/conversations.parquet/*.parquet'"))
    assert sorted(map(tuple, got.select(*names).collect()), key=str) == sorted(want, key=str)


def test_a_long_conversation_is_folded_apart(spark):
    """The fold and the rendering shuffle by message, not by conversation."""
    rows = [(7, i, f"m{i // 2}", "open" if i % 2 == 0 else "delta", "user", f"t{i}") for i in range(4000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spread = chat.format_events(log(spark, rows).repartition(4))
        sizes = [n for n in spread.rdd.glom().map(len).collect() if n]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 2000 and max(sizes) < 600
