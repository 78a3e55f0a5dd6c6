"""Algebra that follows from the definitions, on random inputs in one batch each."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from tidemark.functions import salts as S
from tidemark.functions import text as T
from tidemark.operators import identity as I

words = st.lists(st.sampled_from("dolo crocin plus 650 500mg 5mcg tablet syrup paracetamol acid n of 10's".split()), min_size=0, max_size=5).map(" ".join)
few = settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@few
@given(st.lists(st.tuples(words, words, words, words), min_size=5, max_size=25))
def test_matching_is_symmetric(spark, rows):
    df = spark.createDataFrame(rows, "a string, b string, c string, d string")
    df = df.select("*", I.identity(F.col("a"), F.col("c")).alias("x"), I.identity(F.col("b"), F.col("d")).alias("y"))
    x, y = F.col("x"), F.col("y")
    out = df.select(I.same_medicine(x, y).alias("p"), I.same_medicine(y, x).alias("q"), S.overlap(F.col("c"), F.col("d")).alias("r"), S.overlap(F.col("d"), F.col("c")).alias("s"), S.word_jaccard(F.col("a"), F.col("b")).alias("t"), S.word_jaccard(F.col("b"), F.col("a")).alias("u")).collect()
    assert all(r.p == r.q and r.r == r.s and r.t == r.u for r in out)


@few
@given(st.lists(st.text(max_size=40), min_size=5, max_size=25))
def test_text_functions_settle(spark, rows):
    df = spark.createDataFrame([(r,) for r in rows], "s string")
    once = T.plain(F.col("s"))
    out = df.select(once.alias("a"), T.plain(once).alias("b"), I.relevance(F.col("s"), F.col("s")).alias("r")).collect()
    assert all(r.a == r.b and 0 <= r.r <= 1 for r in out)


@few
@given(st.lists(st.permutations(["Ibuprofen", "Paracetamol 500mg", "Clavulanic Acid"]), min_size=2, max_size=6))
def test_salt_key_ignores_order(spark, rows):
    df = spark.createDataFrame([(" + ".join(r),) for r in rows], "s string")
    assert {r.k for r in df.select(S.salt_key(F.col("s")).alias("k")).collect()} == {"clavulanic acid ibuprofen paracetamol"}
