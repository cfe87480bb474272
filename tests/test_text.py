"""Review text: cleaning, themes, tokens, encodings."""

from __future__ import annotations

import re
import string

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import complaints as C
from tallyloom.operators import text as X

REVIEWS = [
    "The <b>PRICE</b> is too high!!! see http://x.y/z?q=1 now",
    "Missing feature,\tversion 2.0\nand 3 hours  wait",
    "late-delivery; (rude) staff... don't",
    "Überteuert: ١٢٣ Straße 42x",
    "a < b > c <not\nclosed> costs",
    "",
    "nothing wrong",
]


@pytest.fixture(scope="module")
def reviews(spark):
    rows = [(i, text, "Negative" if i < 6 else "positive") for i, text in enumerate(REVIEWS)]
    return spark.createDataFrame(rows, "review_id int, review_text string, sentiment string")


def by_id(df, column):
    return [r[column] for r in df.orderBy("review_id").collect()]


def test_cleaning(reviews):
    marks = "[" + re.escape(string.punctuation) + "]"

    def expected(text):
        text = re.sub(r"http\S+", "", re.sub(r"<.*?>", "", text.lower()))
        text = re.sub(marks, " ", re.sub(r"\d+", " ", text))
        return re.sub(r"\s+", " ", text).strip()

    assert by_id(X.clean_reviews(reviews), "clean_review") == [expected(t) for t in REVIEWS]
    strict = [re.sub(marks, "", re.sub("<.*?>", "", t.lower())) for t in REVIEWS]
    assert by_id(X.clean_reviews(reviews, strict=True), "clean_review") == strict


def test_tokens(reviews):
    found = by_id(X.tokenise_reviews(reviews, ["the", "too"]), "tokens")
    assert found[0] == ["price", "high", "see", "now"]
    assert found[1] == ["missing", "feature", "version", "and", "hours", "wait"]
    assert found[2] == ["late", "delivery", "rude", "staff", "don"] and found[5] == []


def test_stop_words():
    words = X.default_stop_words()
    assert {"the", "don't", "dont", "would", "im"} <= set(words)


def test_themes_need_whole_words(reviews):
    flagged = C.theme_flags(C.negative_reviews(X.clean_reviews(reviews)))
    rows = {r["review_id"]: r for r in flagged.collect()}
    assert set(rows) == set(range(6))  # the negative class is found in any case
    price, features, service = (C.theme_column(t) for t in C.COMPLAINT_THEMES)
    assert (rows[0][price], rows[0][features], rows[0][service]) == (True, False, False)
    assert (rows[1][price], rows[1][features], rows[1][service]) == (False, True, True)
    assert rows[2][service] and not rows[4][price]  # 'costs' is not 'cost'
    assert [rows[i]["is_buyer_complaint"] for i in range(6)] == [True, True, True, False, False, False]
    shares = {r["theme"]: (r["reviews"], round(r["share_pct"], 3)) for r in C.theme_breakdown(flagged).collect()}
    assert shares["Poor Service Quality"] == (2, round(100 * 2 / 6, 3))


@pytest.mark.parametrize("theme", list(C.COMPLAINT_THEMES))
def test_each_keyword_is_found(spark, theme):
    words = C.COMPLAINT_THEMES[theme]
    frame = spark.createDataFrame([(f"it is {w} here",) for w in words] + [(w,) for w in words], "clean_review string")
    assert C.theme_flags(frame).where(~F.col(C.theme_column(theme))).count() == 0


def test_negative_class_without_a_name(spark):
    frame = spark.createDataFrame([("good",), ("Bad",), ("bad",)], "sentiment string")
    assert C.negative_reviews(frame).count() == 2


def test_top_words_break_ties_by_word(spark):
    frame = spark.createDataFrame([("b b a a the the c",)], "clean_review string")
    rows = X.top_words(frame, F.split("clean_review", " "), 2, ["the"]).collect()
    assert [(r["word"], r["count"]) for r in rows] == [("a", 2), ("b", 2)]


def test_service_figures(spark):
    rows = [("YES", 1.0, 2.0), ("no", 5.0, None), ("true", None, 4.0), (None, 9.0, 10.0)]
    frame = spark.createDataFrame(rows, "issue_resolved string, customer_rating double, response_time_hours double")
    found = C.service_metrics(frame, frame).first()
    assert found["resolved_pct"] == 50.0 and found["median_response_hours"] == 4.0
    assert found["p90_response_hours"] == pytest.approx(8.8) and found["avg_rating_all"] == 5.0
    shares = {r["value"]: r["share_pct"] for r in C.value_share(frame, "issue_resolved").collect()}
    assert shares == {"yes": 25.0, "no": 25.0, "true": 25.0, None: 25.0}  # a missing value is a value


def test_sequences(spark):
    frame = spark.createDataFrame([(1, "b a b"), (2, "b c " + "a " * 9), (3, "")], "review_id int, clean_review string")
    found = {r["review_id"]: r["sequence"] for r in X.sequence_encode(frame, "review_id", size=4, length=5).collect()}
    # two words fit the vocabulary: 'a' (10 times) is 2 and 'b' (3 times) is 3; 'c' is unknown
    assert found == {1: [3, 2, 3, 0, 0], 2: [3, 1, 2, 2, 2], 3: [0, 0, 0, 0, 0]}


def test_vocabulary_limits(spark):
    frame = spark.createDataFrame([(["x", "y"],), (["x", "z"],), (["x", "y", "y"],), (["y", "w"],), (["v"],)], "tokens array<string>")
    found = {r["term"]: r["documents"] for r in X.build_vocabulary(frame, min_documents=2, max_share=0.6).collect()}
    assert found == {"x": 3, "y": 3}  # at exactly 60 % a term stays
    assert set(X.fit_bag_of_words(frame, 2, 0.6).vocabulary) == {"x", "y"}


def test_seed_hits_keep_repeats(spark):
    frame = spark.createDataFrame([(["price", "bad", "price"],), (["nice"],)], "tokens array<string>")
    hits = X.seed_hits(frame)
    first = hits.collect()[0]
    assert first["competitor_hits"] == ["price", "price"] and first["pain_hits"] == ["bad"] and first["has_pain"]
    totals = X.seed_totals(hits).first()
    assert (totals["reviews"], totals["competitor_mentions"], totals["pain_mentions"]) == (2, 1, 1)
    assert X.top_seed_terms(hits).first()["count"] == 2


def test_each_review_is_one_sequence_even_if_ids_repeat(spark):
    frame = spark.createDataFrame([(1, "a b c"), (1, "b c d e f"), (None, "")], "review_id int, clean_review string")
    rows = X.sequence_encode(frame, "review_id", size=100, length=4).collect()
    assert len(rows) == 3 and all(len(r["sequence"]) == 4 for r in rows)


def test_vocabulary_is_never_cut(spark):
    frame = spark.createDataFrame([([f"w{i}" for i in range(4000)],), ([f"w{i}" for i in range(4000)],), (["z"],)], "tokens array<string>")
    assert X.build_vocabulary(frame, 2, 0.9).count() == 4000
    with pytest.raises(ValueError):
        X.fit_bag_of_words(frame, 2, 0.9, most=3999)
