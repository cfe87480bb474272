"""Review text: cleaning, tokens, vocabulary, bags of words, integer sequences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import CountVectorizerModel, StopWordsRemover
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.session import stored

# Patterns removed from reviews.  White space and digits are meant in the Unicode sense.
TAGS = r"<[^\n]*?>"
LINKS = r"(?U)http[^\s\x1c-\x1f]+"
DIGITS = r"(?U)\d+"
PUNCTUATION = r"\p{Punct}"
SPACES = r"(?U)[\s\x1c-\x1f]+"

# Words ignored besides a language's usual stop words.
EXTRA_STOPS = (
    "would", "could", "should", "also", "really", "very", "just", "get",
    "got", "said", "one", "two", "three", "us", "im", "ive", "dont",
    "didnt", "wasnt", "isnt", "cant", "wont", "via", "pm", "am",
)


def replace_all(column: Column, pattern: str, replacement: str) -> Column:
    return F.regexp_replace(column, F.lit(pattern), F.lit(replacement))


def clean(column: Column) -> Column:
    """Lower case; no tags or links; digits and punctuation become spaces; single spaces."""
    text = F.lower(column)
    for pattern, replacement in ((TAGS, ""), (LINKS, ""), (DIGITS, " "), (PUNCTUATION, " "), (SPACES, " ")):
        text = replace_all(text, pattern, replacement)
    return F.btrim(text)


def clean_strict(column: Column) -> Column:
    """Lower case; tags and punctuation removed without a space; digits kept."""
    return replace_all(replace_all(F.lower(column), TAGS, ""), PUNCTUATION, "")


def clean_reviews(reviews: DataFrame, column: str = "review_text", strict: bool = False) -> DataFrame:
    """Add `clean_review`."""
    return reviews.withColumn("clean_review", (clean_strict if strict else clean)(F.col(column)))


def default_stop_words(language: str = "english") -> list[str]:
    """A language's stop words as the ML library lists them, without apostrophes too, and the extra ones."""
    words = StopWordsRemover.loadDefaultStopWords(language)
    return sorted({*words, *[w.replace("'", "") for w in words], *EXTRA_STOPS})


def tokens_of(column: Column, stops: Sequence[str], min_length: int = 3) -> Column:
    """Words of a text: no tags, links, punctuation or ASCII digits, no stop words, at least `min_length` long."""
    text = F.lower(column)
    for pattern, replacement in ((TAGS, ""), (LINKS, ""), (PUNCTUATION, " "), ("[0-9]+", ""), (SPACES, " ")):
        text = replace_all(text, pattern, replacement)
    words = F.split(text, " ")
    return F.filter(words, lambda w: (F.length(w) >= min_length) & ~w.isin(list(stops)))


def tokenise_reviews(reviews: DataFrame, stops: Sequence[str], min_length: int = 3, column: str = "review_text") -> DataFrame:
    """Add `tokens`."""
    return reviews.withColumn("tokens", tokens_of(F.col(column), stops, min_length))


def word_counts(df: DataFrame, words: Column) -> DataFrame:
    """Occurrences of each word of an array column; a frequent word is summed before the shuffle."""
    return df.select(F.explode(words).alias("word")).where("word <> ''").groupBy("word").agg(F.count("*").alias("count"))


def top_words(df: DataFrame, words: Column, n: int = 15, stops: Sequence[str] = ()) -> DataFrame:
    """The n most frequent words that are not stop words; ties in word order."""
    counts = word_counts(df, words)
    kept = counts.where(~F.col("word").isin(list(stops))) if stops else counts
    return kept.orderBy(F.col("count").desc(), "word").limit(n)


def build_vocabulary(tokenised: DataFrame, min_documents: int = 3, max_share: float = 0.6) -> DataFrame:
    """Terms in at least `min_documents` documents and at most `max_share` of them, with their document counts."""
    documents = tokenised.agg(F.count("*").alias("n"))
    limit = documents.select(F.col("n") * F.lit(max_share)).scalar()
    in_documents = (
        tokenised.select(F.explode(F.array_distinct("tokens")).alias("term"))
        .groupBy("term")
        .agg(F.count("*").alias("documents"))
    )
    return in_documents.where((F.col("documents") >= min_documents) & (F.col("documents") <= limit))


def fit_bag_of_words(
    tokenised: DataFrame, min_documents: int = 3, max_share: float = 0.6, most: int = 1_000_000
) -> CountVectorizerModel:
    """The terms of `build_vocabulary` as a vectoriser, most frequent first.

    A model holds its vocabulary on every node: more than `most` terms are an error, never a cut.
    """
    terms = build_vocabulary(tokenised, min_documents, max_share)
    terms = terms.orderBy(F.col("documents").desc(), "term").limit(most + 1).collect()
    if len(terms) > most:
        raise ValueError(f"more than {most} terms; raise min_documents or most")
    if not terms:
        raise ValueError("no term is in enough documents")
    return CountVectorizerModel.from_vocabulary([row["term"] for row in terms], inputCol="tokens", outputCol="bag")


def bag_of_words(tokenised: DataFrame, vocabulary: DataFrame, key: str) -> DataFrame:
    """Sparse counts per document in long form: key, term, count, for the terms of the vocabulary.

    Words are counted before they meet the stored vocabulary: then both sides of the join are plain shuffles, of which
    adaptive execution splits those of a term that most documents hold.
    """
    counts = tokenised.select(key, F.explode("tokens").alias("term")).groupBy(key, "term").agg(F.count("*").alias("count"))
    return counts.join(stored(vocabulary.select("term"), "bag-terms"), "term").select(key, "term", "count")


def encoding_vocabulary(cleaned: DataFrame, size: int = 5_000, column: str = "clean_review") -> DataFrame:
    """The most frequent words with ids from 2, in order of frequency then word; 0 is padding and 1 is unknown."""
    ranked = top_words(cleaned, F.split(column, " "), n=size - 2)
    listed = F.array_sort(
        F.collect_list(F.struct((-F.col("count")).alias("c"), F.col("word").alias("w")))
    )  # at most `size` entries
    return ranked.agg(listed.alias("l")).select(F.posexplode("l").alias("at", "e")).select(
        F.col("e.w").alias("word"), (F.col("at") + 2).alias("id")
    )


def sequence_encode(cleaned: DataFrame, key: str, size: int = 5_000, length: int = 100, column: str = "clean_review") -> DataFrame:
    """Each review as `length` word ids, cut or padded at the end; the vocabulary counts whole reviews.

    One row per review, whether or not its key repeats: each review gets a number of its own, fixed in a stored table.
    """
    vocabulary = encoding_vocabulary(cleaned, size, column)
    words = F.slice(F.filter(F.split(column, " "), lambda w: w != ""), 1, length)
    numbered = stored(cleaned.select(key, words.alias("_words"), F.monotonically_increasing_id().alias("_row")), "sequences")
    placed = numbered.select("_row", key, F.posexplode_outer("_words").alias("at", "word"))
    known = placed.join(F.broadcast(vocabulary), "word", "left")  # fewer than `size` rows
    code = F.struct("at", F.coalesce("id", F.lit(1)).alias("id"))
    gathered = known.groupBy("_row", key).agg(F.array_sort(F.collect_list(F.when(F.col("at").isNotNull(), code))).alias("_c"))
    ids = F.transform("_c", lambda c: c["id"])  # at most `length` per review
    padding = F.array_repeat(F.lit(0), F.lit(length) - F.size(ids))
    return gathered.select(key, F.concat(ids, padding).alias("sequence"))


# Terms that point to competitors, and terms that point to pain.
COMPETITOR_SEEDS = (
    "competitor", "competition", "rival", "alternative", "switch", "switched",
    "switching", "left", "moved", "migrated", "cancel", "cancelled", "canceled",
    "unsubscribe", "churn",
    "ai", "automation", "chatbot", "bot", "self-service", "app", "platform",
    "digital", "online", "api", "integration",
    "cheaper", "discount", "free", "trial", "promo", "offer",
    "deal", "price", "pricing", "cost", "expensive", "affordable",
    "slow", "delay", "delayed", "wait", "waiting", "unresponsive", "ignored",
    "unreliable", "broken", "bug", "error", "crash", "down", "outage",
    "refund", "billing", "overcharged",
)
PAIN_POINT_SEEDS = (
    "problem", "issue", "complaint", "frustrated", "frustrating", "terrible",
    "awful", "poor", "bad", "worst", "horrible", "disappointing", "disappointed",
    "useless", "broken", "fix", "difficult", "confusing", "complicated",
)


def seed_hits(
    tokenised: DataFrame, competitor: Sequence[str] = COMPETITOR_SEEDS, pain: Sequence[str] = PAIN_POINT_SEEDS
) -> DataFrame:
    """Tokens in each seed set, repeats kept, and whether there are any."""
    hits = tokenised.select(
        "*",
        F.filter("tokens", lambda t: t.isin(list(competitor))).alias("competitor_hits"),
        F.filter("tokens", lambda t: t.isin(list(pain))).alias("pain_hits"),
    )
    return hits.select(
        "*",
        (F.size("competitor_hits") > 0).alias("has_competitor"),
        (F.size("pain_hits") > 0).alias("has_pain"),
    )


def seed_totals(hits: DataFrame) -> DataFrame:
    """Reviews with competitor mentions and with pain mentions."""
    return hits.agg(
        F.count("*").alias("reviews"),
        F.count_if("has_competitor").alias("competitor_mentions"),
        F.count_if("has_pain").alias("pain_mentions"),
    )


def top_seed_terms(hits: DataFrame, column: str = "competitor_hits", n: int = 15) -> DataFrame:
    """The most frequent seed terms."""
    return top_words(hits, F.col(column), n)
