import re

import pytest
from pyspark.sql import functions as F

from lexistat.functions import text as T


def column(spark, values, expression):
    rows = spark.createDataFrame(list(enumerate(values)), "id int, text string")
    return [r[0] for r in rows.orderBy("id").select(expression(F.col("text"))).collect()]


def plain_clean(text):
    words = re.sub(r"[^a-z0-9\s#+]", " ", text.lower()).replace("#", " # ").split()
    joined = {w.replace(" ", ""): w.split() for w in T.SPLIT_WORDS}
    words = [part for w in words for part in joined.get(w, [w])]
    return " ".join(w for w in words if w not in T.STOP_WORDS)


CASES = [
    "The Quick brown fox, isn't it?",
    "C++ and C# are languages; f# too ##",
    "You cannot gonna WANNA cannots wanna",
    "naïve café №5\ttabs\nlines",
    "",
    "   ",
    "the of and",
    "a+b c++11 +1 _under_score_",
]


@pytest.mark.parametrize("case", CASES)
def test_clean_text_follows_the_chain(spark, case):
    assert column(spark, [case], T.clean_text) == [plain_clean(case)]


def test_stop_list_can_be_replaced(spark):
    assert column(spark, ["the cat"], lambda c: T.clean_text(c, ["cat"])) == ["the"]
    assert column(spark, ["the cat"], lambda c: T.clean_text(c, [])) == ["the cat"]


def test_vector_terms_are_word_runs_of_two(spark):
    found = column(spark, ["c++ c++11 foo+bar # x yy"], T.vector_terms)
    assert found == [["11", "foo", "bar", "yy"]]


def test_word_terms_keep_other_scripts(spark):
    found = column(spark, ["Élan vital, x été_2 — 東京"], T.word_terms)
    assert found == [["élan", "vital", "été_2", "東京"]]
