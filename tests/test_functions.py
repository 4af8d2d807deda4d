import itertools
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerleaf.functions import arrays, maps, numbers, text, times
from ledgerleaf.operators import words


def one(spark, value, kind, expression):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expression(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "value", [12.5, 0.0, -3.0, 1.5e7, 12345678.912, 1e10, -2.5e12, 1.5e-4, 1e-5, -7.25e-9, 123456789012.345, 9.99e20]
)
def test_plain_number_has_no_exponent(spark, value):
    got = one(spark, value, "double", numbers.plain_number)
    assert "E" not in got and Decimal(got) == Decimal(repr(value))


def test_plain_number_of_whole_numbers(spark):
    assert one(spark, 7, "int", numbers.plain_number) == "7"
    assert one(spark, 1.0e10, "double", numbers.plain_number) == "10000000000"


@pytest.mark.parametrize(
    "value,want",
    [("a b", ["a", "b"]), ("a  b", ["a", "", "b"]), ("a b  ", ["a", "b"]), ("", [""]), ("   ", []), (" a", ["", "a"]), (None, None)],
)
def test_words_drop_trailing_blanks_only(spark, value, want):
    assert one(spark, value, "string", text.split_words) == want


def test_words_with_longer_separator(spark):
    assert one(spark, "a||b||", "string", lambda c: text.split_words(c, "||")) == ["a", "b"]


def test_digit_flags(spark):
    for value, some, every in [("", False, True), ("12", True, True), ("a1", True, False), ("ab", False, False), ("٣", True, True)]:
        assert one(spark, value, "string", text.has_digit) is some
        assert one(spark, value, "string", text.all_digits) is every


def test_stop_words_and_digit_words(spark):
    got = one(spark, "the|law|3rd|of|court", "string", lambda c: text.drop_stop_words(text.split_words(c, "|"), ["the", "of"]))
    assert got == ["law", "court"]
    assert one(spark, "a1|b", "string", lambda c: text.drop_digit_words(text.split_words(c, "|"))) == ["b"]


def test_list_product_of_the_known_sample(spark):
    rows = [(1, "a,b,c|d,e|f,g"), (2, "a||b"), (3, None), (4, "x"), (5, "|"), (6, "|".join(["p,q,r,s"] * 7))]
    df = spark.createDataFrame(rows, "id int, lists string")
    got = {}
    for row in words.list_combinations(df, "lists").collect():
        got.setdefault(row.id, []).append(tuple(row.combination))
    assert got[1] == list(itertools.product("abc", "de", "fg"))
    assert got[2] == [("a", "", "b")] and got[4] == [("x",)] and not {3, 5} & set(got)
    # More combinations than are numbered at once.
    assert sorted(got[6]) == sorted(itertools.product("pqrs", repeat=7))


def test_times(spark):
    assert one(spark, "2017-11-11 21:21:56.0", "string", times.epoch_millis) == 1510435316000
    assert one(spark, "2017-11-11 21:21:5", "string", times.epoch_millis) == 1510435265000
    for bad in ("", "junk", None):
        assert one(spark, bad, "string", times.epoch_millis) is None
        assert one(spark, bad, "string", lambda c: times.epoch_millis(c, default=0)) == 0
        assert one(spark, bad, "string", times.slot30) == 1535760000 // 2592000
    assert one(spark, "2018-08-02 00:00:00", "string", times.slot30) == 1
    assert one(spark, "2018-08-02 00:00:01", "string", times.slot30) == 0
    assert one(spark, "2018-09-20 00:00:00", "string", times.slot30) == 0


def test_to_double(spark):
    assert [one(spark, v, "string", numbers.to_double) for v in ("5", "4.0", "x", None)] == [5.0, 4.0, None, None]
    with pytest.raises(Exception):
        one(spark, "x", "string", lambda c: numbers.to_double(c, strict=True))


def test_round_half_up_and_clamp(spark):
    assert one(spark, 1.005, "double", lambda c: numbers.round_half_up(c, 2)) == 1.01
    assert one(spark, -0.125, "double", lambda c: numbers.round_half_up(c, 2)) == -0.13
    assert [one(spark, v, "double", numbers.clamp) for v in (-1.0, 0.4, 7.0)] == [0.0, 0.4, 1.0]


def test_hashed_draws_look_normal_and_do_not_depend_on_layout(spark):
    ids = spark.range(20000)
    draw = numbers.hashed_gaussian(F.col("id"), "t", 0.3, 0.25).alias("z")
    stats = ids.select(draw).agg(F.avg("z"), F.var_samp("z")).first()
    assert abs(stats[0] - 0.3) < 0.02 and abs(stats[1] - 0.25) < 0.02
    a = {r.id: r.z for r in ids.select("id", draw).collect()}
    b = {r.id: r.z for r in ids.repartition(13).select("id", draw).collect()}
    assert a == b


def test_label_number(spark):
    labels = {"b": 1, "a": 2}
    assert [one(spark, v, "string", lambda c: maps.label_number(c, labels)) for v in ("b", "a", "z", None)] == [1, 2, 0, 0]
    assert one(spark, "b", "string", lambda c: maps.label_number(c, {})) == 0


def test_vectors(spark):
    v = F.array(*[F.lit(x) for x in (1.0, 2.0, 3.0, 4.0)])
    w = F.array(*[F.lit(x) for x in (1.0, 3.0, 5.0, 7.0)])
    row = spark.range(1).select(arrays.dot(v, w), arrays.hadamard(v, w), arrays.argmax(v), arrays.outer(v, w)).first()
    assert row[0] == 50.0 and row[1] == [1.0, 6.0, 15.0, 28.0] and row[2] == 3
    assert row[3][1] == [2.0, 6.0, 10.0, 14.0]
