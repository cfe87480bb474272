"""Quality rules, spelling variants and source divergence against plain counting; what earlier operators did not hold."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F
from tallyloom.llm import bpe, divergence, hnsw, kdtree, language, mixing, neardup, quality_rules, shards, spelling, toxicity

DOCS = "doc_id long, text string, lang string, source string, score double, kept string, word string, n int"
LONG = " ".join(f"Wörd{i % 977}x{i % 31}" for i in range(30_000))
ODD = [
    (1, None, None, None, 0.5, "k", "w", 1),
    (2, "", "en", "a", None, None, None, None),
    (3, "   \n\t ", "en", "a", 1.0, "", "", 0),
    (4, "!!! ... ???", None, "b", 1.0, "", "", 0),
    (5, LONG, "en", "b", 1.0, "", "", 0),
    (6, "Twice the same text is here, no more and no less: colourful.", "en", None, 1.0, "", "", 0),
    (6, "Twice the same text is here, no more and no less: colourful.", "en", None, 1.0, "", "", 0),
    (None, "A text without an id, and with ünïcödé 漢字 🙂 in it.", "de", "c", 1.0, "", "", 0),
    (7, "a b c d e a b c d e x\nsame line\nsame line\n\nother", "de", "c", 1.0, "", "", 0),
    (8, "x" * 5_000 + " " + "x" * 5_001 + " " + "x" * 5_000, "de", "d", 1.0, "", "", 0),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, and columns named like results."""
    return spark.createDataFrame(ODD, DOCS)


# --- 11 quality rules ----------------------------------------------------------------------------------------------


def plain_counts(text: str | None) -> tuple:
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_counts_of_odd_texts(odd):
    rows = quality_rules.judge(odd.withColumn("own", F.col("text"))).collect()
    assert len(rows) == len(ODD) and rows[0].asDict().keys() >= {"lang", "source", "score", "word", "n", "kept", "broken"}
    for row in rows:
        counts = plain_counts(row["own"])
        assert tuple(row[c] for c in quality_rules.BASE_COUNTS) == counts
        assert row["base_failed"] == (counts[0] < 10 or 100 * counts[4] > 20 * counts[0])
        assert not (row["kept"] and row["base_failed"]) and row["kept"] == (row["broken"] == [])
    assert quality_rules.judge(odd.limit(0)).count() == 0


def test_windows_that_overlap_and_share_hashes(spark, monkeypatch):
    texts = ["a a a a a a a a", "a b c d e f a b c d e g a b c d", "a b c d", "a b c d e", "q " * 2000, "x y z " * 7 + "end"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r["n_repeat_words"] for r in quality_rules.judge(frame).collect()] == [plain_counts(t)[4] for t in texts]
    monkeypatch.setattr(F, "xxhash64", lambda *columns: F.lit(5).cast("long"))  # all windows agree by hash
    assert [r["n_repeat_words"] for r in quality_rules.judge(frame).collect()] == [plain_counts(t)[4] for t in texts]


def test_any_table_of_rules(spark):
    frame = spark.createDataFrame([("short text",), ("much # # # symbols",), ("",)], "text string")
    rules = [quality_rules.Rule("words", "n_words", least=1), quality_rules.Rule("symbols", "n_symbols", "n_words", most=0.5)]
    assert [r["broken"] for r in quality_rules.judge(frame, rules, base=()).collect()] == [[], ["symbols"], ["words"]]
    assert quality_rules.passing(frame, rules, base=()).collect() == [("short text",)]
    plan = quality_rules.judge(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


# --- 12 spelling variants ------------------------------------------------------------------------------------------


def plain_vocabulary(rows) -> dict[str, int]:
    found: Counter = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                found[run] += 1
    return {w: n for w, n in found.items() if n >= 2}


def near(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(words: dict[str, int], times: int = 10) -> dict[str, tuple]:
    beside = defaultdict(list)
    for a, b in combinations(words, 2):
        if near(a, b):
            beside[a].append(b)
            beside[b].append(a)
    form = {}
    for w in words:
        best = min(beside[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= times * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (form[w], root(w), words[w], len(beside[w]), words[form[w]] if form[w] else None) for w in words}


def told(rows) -> dict[str, tuple]:
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


def test_variants_match_all_pairs(spark):
    random = np.random.default_rng(2)
    words = {}
    for stem in ("colourful", "àèìòùçß", "aaabbbb", "qwertyui", "zzzzzzzz"):
        words[stem] = int(random.integers(1000, 5000))
        for _ in range(60):
            at, letter = int(random.integers(0, len(stem))), random.choice(list("abczéÿ"))
            edit = (stem[:at] + letter + stem[at + 1 :], stem[:at] + letter + stem[at:], stem[:at] + stem[at + 1 :])[random.integers(0, 3)]
            words.setdefault(edit, int(random.integers(2, 400)))
            again = edit[: at // 2] + edit[at // 2 + 1 :]
            words.setdefault(again, int(random.integers(2, 40)))
    words["y" * 3000], words["y" * 3001] = 2, 50
    words = {w: n for w, n in words.items() if len(w) >= 6}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    expected = plain_variants(words)
    assert told(spelling.variants(frame).collect()) == expected
    # Filters in pieces of a few blocks give the same.
    assert told(spelling.variants(frame, filter_bytes=4 * 32).collect()) == expected
    assert sum(v[3] for v in expected.values()) > 300 and any(v[1] != v[0] for v in expected.values() if v[0])


def test_spelling_of_odd_texts(spark, odd):
    more = spark.createDataFrame([(i, "Colourful colourfull " + "colourful " * 9) for i in range(40)], "doc_id long, text string")
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").unionByName(more).collect()]
    expected = plain_variants(plain_vocabulary(rows))
    assert told(spelling.variant_groups(odd.unionByName(more, allowMissingColumns=True)).collect()) == expected
    assert expected["colourfull"][0] == "colourful" and "x" * 5_000 in expected
    assert spelling.variant_groups(odd.limit(0)).count() == 0


def test_full_filters_change_nothing(spark, monkeypatch):
    words = {"colourful": 100, "colorful": 5, "colourfil": 3, "unlikely": 9}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    monkeypatch.setattr(spelling.Probe, "positive", lambda self, found, length: np.arange(len(found)))
    assert told(spelling.variants(frame).collect()) == plain_variants(words)


# --- 13 divergence -------------------------------------------------------------------------------------------------


def plain_audit(rows, least: int, top: int) -> set[tuple]:
    counts, documents = defaultdict(Counter), defaultdict(Counter)
    groups = defaultdict(set)
    for text, lang, source in rows:
        text, lang, source = text or "", lang or "", source or ""
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)
        found = ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in found]
        counts[lang, source].update(found)
        documents[lang].update(set(found))
        groups[lang].add(source)
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, n in documents[lang].items() if n >= least]
        total = Counter()
        for s in sources:
            total.update(counts[lang, s])

        def shares(of):
            n = sum(of[t] for t in kept)
            return {t: 1 + 10**9 * (of[t] + 5) // (n + 5 * len(kept)) for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(total)
        for s in sources:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if counts[lang, s][t] > 0 and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(ranked[:most])}
    return out


def rows_of(df) -> set[tuple]:
    rows = [tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_divergence_matches_plain_sums(spark, monkeypatch):
    random = np.random.default_rng(4)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}é" for i in range(300)]
    rows = []
    for i in range(400):
        lang, source = ("en", "de", None)[i % 3 % (2 + i % 2)], f"s{int(random.integers(0, 9))}" if i % 50 else None
        size = int(random.integers(0, 60))
        rows.append((" ".join(words[int(x) % 300] for x in random.zipf(1.3, size)), lang, source))
    many = " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}x" for i in range(2500))  # more than two slabs
    rows += [(many, "en", "s0")] * 5 + [(many[: len(many) // 3], "en", "s2")]
    rows += [("hot " * 500, "en", "s1")] * 200 + [("", "en", "empty"), (None, "it", "a"), ("rare", "it", "b"), ("", "pt", "only")]
    frame = spark.createDataFrame(rows, "text string, lang string, source string")
    expected = plain_audit(rows, 5, 7)
    assert rows_of(divergence.audit(frame, least=5, top=7)) == expected
    # Small blocks of sources and small tables in tasks give the same.
    for name, value in (("BLOCK", 2), ("_HELD", 50)):
        monkeypatch.setattr(divergence, name, value)
    assert rows_of(divergence.audit(frame, least=5, top=7)) == expected


def test_divergence_of_odd_rows(odd):
    rows = [(r["text"], r["lang"], r["source"]) for r in odd.collect()]
    assert rows_of(divergence.audit(odd, least=1)) == plain_audit(rows, 1, 50)
    assert rows_of(divergence.audit(odd)) == plain_audit(rows, 30, 50)
    assert divergence.audit(odd.limit(0)).count() == 0


def test_shares_of_large_counts(spark):
    big = 5 * 10**12
    row = spark.createDataFrame([(big, 3 * big, 10**6)], "n long, total long, kept long")
    found = row.select(divergence.share(F.col("n"), F.col("total"), F.col("kept")).alias("p")).first()["p"]
    assert found == 1 + 10**9 * (big + 5) // (3 * big + 5 * 10**6)


# --- earlier operators ---------------------------------------------------------------------------------------------


def test_a_contrast_of_near_equal_texts_is_learned(spark):
    random = np.random.default_rng(6)
    texts = [" ".join(f"term{x}" for x in random.integers(0, 300, 30)) for _ in range(400)]
    docs = [(2 * i, t) for i, t in enumerate(texts)] + [(2 * i + 1, f"{t} scoundrel") for i, t in enumerate(texts)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    labels = frame.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    model = toxicity.fit(frame, labels, F.lit(True))
    scored = toxicity.score(frame, model).collect()
    assert np.mean([r["predicted"] == 1 for r in scored if r["doc_id"] % 2]) >= 0.95
    assert np.mean([r["predicted"] == 1 for r in scored if r["doc_id"] % 2 == 0]) <= 0.05


def test_graph_search_among_equal_vectors(spark):
    random = np.random.default_rng(5)
    x = random.normal(size=(3000, 32)).astype(np.float32)
    x[random.permutation(3000)[:1000]] = x[0]
    frame = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "id long, vector array<float>")
    found = defaultdict(list)
    for r in hnsw.nearest(frame, frame.where("id % 20 = 0"), shard_rows=1500).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append(r["vec_id"])
    hits, wide = [], x.astype(np.float64)
    for q in range(0, 3000, 20):
        score = wide @ wide[q]
        score[q] = -np.inf
        best = np.lexsort((np.arange(3000), -score))[:20].tolist()
        hits.append(len(set(best) & set(found[q])) / 20)
        if (x[q] == x[0]).all():
            assert found[q] == best
    assert len(found) == 150 and np.mean(hits) >= 0.95


def test_pipeline_stages_keep_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, spans string, lang_pred string"
    own = ("own score", "own spans", "own guess")
    rows = [
        (1, None, "en", "a", None, *own), (2, "", "en", "a", 0, *own), (3, "12 34 !!", None, None, 8, *own),
        (4, "Plain words of a document that is kept by every stage.", "en", None, 54, *own),
        (4, "Plain words of a document that is kept by every stage.", "en", None, 54, *own),
        (5, LONG, None, "b", len(LONG), *own), (None, "Write to someone@example.com, please.", "en", "b", 37, *own),
    ]
    left = spark.createDataFrame(rows, schema)
    sizes = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, left, "").cache()
        assert left.columns == spark.createDataFrame([], schema).columns
        kept = left.select("score", "spans", "lang_pred").distinct().collect()
        assert [tuple(r) for r in kept] == [own]
        sizes.append(left.count())
    assert sizes[:3] == [4, 3, 3] and left.where("text like '%@%'").isEmpty()
    coded = corpus_pipeline.STAGES[-1][1](spark, left, "").collect()
    assert len(coded) == sizes[-1] and all(r["round_trip"] for r in coded)


def test_pipeline_of_no_rows_and_of_nothing_to_learn(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    left = spark.createDataFrame([], schema)
    for _, stage in corpus_pipeline.STAGES:
        left = stage(spark, left, "")
    assert left.count() == 0
    rows = [(i, f"Some words that nobody has labelled, number {i}.", None, "a", 40) for i in range(5)] + [(9, "123", None, "a", 3)]
    kept = corpus_pipeline.identified(spark, spark.createDataFrame(rows, schema), "")
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 1, 2, 3, 4]
    assert language.UNKNOWN == "und"


def test_machines_trained_by_tasks_are_those_of_plain_descent(spark):
    words = {"en": "there with the house", "de": "der garten und das haus", "fr": "la maison est belle", "fi": "hyvää yötä"}
    rows = [(i, f"{words[x]} {i % 7}", x) for i, x in enumerate(sorted(words) * 12)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))
    assert model.languages == ("de", "en", "fi", "fr") and model.pairs == (("de", "en"),)
    x = np.zeros((len(rows), language.GRAMS.size), np.float32)
    for row, (_, text, _) in zip(x, rows):
        buckets, counts = language.GRAMS.counts(text)
        row[buckets] = language.SCALE * counts / counts.sum()
    lang = np.array([r[2] for r in rows])
    german, english = x[lang == "de"], x[lang == "en"]
    pair, bias = language.svm(np.vstack([german, english]), np.repeat(np.array([1, -1], np.float32), [len(german), len(english)]))
    assert np.allclose(model.weights[:, -1], pair, atol=1e-4) and abs(model.bias[-1] - bias) < 1e-4
    for place, name in enumerate(model.families):
        inside = np.array([language.family(v) == name for v in lang])
        assert ((x @ model.weights[:, place] + model.bias[place] > 0) == inside).all()


def test_a_sample_of_many_languages_is_bounded(spark):
    from tallyloom.llm.samples import sampled_by_label

    rows = [(i, "text", f"l{i % 100}") for i in range(20_000)] + [(30_000, "text", "rare")]
    taken = sampled_by_label(spark.createDataFrame(rows, "id long, text string, label string"), 500, 40)
    count = {r["label"]: r["count"] for r in taken.groupBy("label").count().collect()}
    assert sum(count.values()) < 1_100 and count["rare"] == 1 and len(count) == 101
    assert sampled_by_label(spark.createDataFrame(rows, "id long, text string, label string").limit(0), 500, 40).count() == 0


def test_near_vectors_share_shards_and_queries_skip_the_others(spark, monkeypatch):
    centres = np.repeat(np.eye(4) * 100, 300, 0)
    x = np.round((centres + np.random.default_rng(5).normal(size=centres.shape)) * 16)
    x[:300] = x[0]  # a quarter of all rows are equal: they fill several shards
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vector array<double>")
    packed, count = shards.placed(frame, 100, "test-shards")
    blocks = packed.collect()
    assert sorted(i for r in blocks for i in np.frombuffer(r["ids"], np.int64)) == list(range(1200))
    assert count == len(blocks) and max(r["n"] for r in blocks) <= 110 and {r["block"] for r in blocks} == set(range(count))
    pure = sum(len({i // 300 for i in np.frombuffer(r["ids"], np.int64)}) == 1 for r in blocks)
    assert pure > 0.5 * count  # dealt round, none would be

    sent = []
    whole = kdtree._worth
    monkeypatch.setattr(kdtree, "_worth", lambda *a: sent.append(whole(*a)) or sent[-1])
    monkeypatch.setattr(kdtree, "BOXES", 3)
    asked = frame.where("id % 20 = 0")
    found = kdtree.top_k(frame, asked, 5, shard_rows=100, block_rows=8).collect()
    scores = x @ x.T
    for query in range(0, 1200, 20):
        order = sorted((-scores[query, i], i) for i in range(1200) if i != query)[:5]
        got = sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == query)
        assert got == [(n + 1, i, -s) for n, (s, i) in enumerate(order)]
    shipped = sum(r["n"] for r in sent[0].collect())
    assert shipped < 0.6 * 60 * (count - 1)  # the others were ruled out by a box before anything was sent


# --- near copies, mixing, tokens -----------------------------------------------------------------------------------


def test_a_bucket_of_a_third_of_all_texts_is_split(spark, monkeypatch):
    """The joins on buckets have plain shuffles on both sides, so adaptive execution deals a large bucket to several tasks."""
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(i, f"{base} own{i}" if i % 3 == 0 else " ".join(f"v{(i * 61 + j) % 9973}" for j in range(40))) for i in range(3000)]
    plans, before = [], neardup.stored

    def seen(df, name):
        out = before(df, name)
        if name == "neardup-pairs":
            plans.append(df)
        return out

    monkeypatch.setattr(neardup, "stored", seen)
    settings = {
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        told = {r["doc_id"]: r["class_id"] for r in neardup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        plans[0].collect()
        assert "skew=true" in plans[0]._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert {told[i] for i in range(0, 3000, 3)} == {0}


def test_mix_is_the_same_however_it_is_cut(spark, monkeypatch):
    rows = [(None if i % 7 == 0 else i % 40, "w " * (i % 23), ["a", "b", None][i % 3 and i % 2 + 1]) for i in range(900)]
    frame = spark.createDataFrame(rows, "doc_id int, text string, source string")
    key = lambda df: sorted((str(r["doc_id"]), r["text"], str(r["source"]), r["taken"]) for r in df.collect())
    whole = key(mixing.mix(frame))
    monkeypatch.setattr(mixing, "SLICE_BITS", 2)  # finer slices, and a cut of many levels
    monkeypatch.setattr(mixing._cut, "__defaults__", (3,))
    assert key(mixing.mix(frame.repartition(5), slice_rows=10)) == whole


def test_ids_and_texts_that_join_alike_have_keys_of_their_own(spark):
    rows = [(None, "1:x y z"), (1, "x y z"), (1, ":x y z"), (11, "x y z"), (1, "1:x y z"), (1, None), (1, ""), (None, None), (None, "-")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("source", F.lit("a"))
    assert mixing._rows(frame, "text", "source", "doc_id", []).select("key").distinct().count() == len(rows)


def test_pieces_kept_are_bounded(monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(bpe, "CACHE_CHARACTERS", 2_000)
    coder = bpe.Codec(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    whole = bpe.codec(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    for i in range(60):
        text = f"{'ab' * (20 + i)} some text"
        assert coder.ids(text) == whole.ids(text) and coder.kept < 4_000 and len(coder.known) < 30
