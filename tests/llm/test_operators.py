"""The training-data operators against plain counting, public libraries and held-out labels, with odd rows among them."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tallyloom.llm import bpe, hnsw, kdtree, language, mixing, neardup, pii, quality, substring, toxicity
from tallyloom.llm.components import components
from tallyloom.llm.words import BLOCK, Grams, word_hashes

FOLDER = "/root/testdata/sf0.01"
PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
DOCS = "doc_id long, text string, lang string, source string, score double, spans int, removed int, node string"
LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(60_000))
ODD = [
    (1, None, None, None, 0.5, 1, 2, "n"),
    (2, "", "en", "a", None, None, None, None),
    (3, "   \n\t ", "en", "a", 1.0, 0, 0, "x"),
    (4, "!!! ... ???", None, "b", 1.0, 0, 0, "x"),
    (5, LONG, "en", "b", 1.0, 0, 0, "x"),
    (6, "Twice the same text is here, no more and no less.", "en", None, 1.0, 0, 0, "x"),
    (6, "Twice the same text is here, no more and no less.", "en", None, 1.0, 0, 0, "x"),
    (None, "A text without an id, and with ünïcödé 漢字 🙂 in it.", "de", "c", 1.0, 0, 0, "x"),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, and columns named like results."""
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


# --- words ---------------------------------------------------------------------------------------------------------


def test_long_texts_are_cut_without_a_trace():
    text = " ".join(f"w{i}" for i in range(BLOCK // 3))
    whole, bounds = word_hashes([text, None, "w1 W2", ""])
    single, _ = word_hashes([f"w{i}" for i in range(BLOCK // 3)])
    assert bounds.tolist() == [0, BLOCK // 3, BLOCK // 3, BLOCK // 3 + 2, BLOCK // 3 + 2]
    assert (whole[: BLOCK // 3] == single).all() and (whole[-2:] == single[1:3]).all()
    grams = Grams((1, 2, 3), 10, words=True)
    weights = np.ones((grams.size, 1), np.float32)
    total, count = grams.sums([text, None, "ab ab"], weights)
    assert total[:, 0].tolist() == count.tolist() and count[1] == 0
    # a, b, twice; _a, ab, b_, twice; _ab, ab_, twice; two words, one repeat
    assert count[2] == 4 + 6 + 4 + 2 + 1
    buckets, times = grams.counts(text)
    assert times.sum() == count[0]


# --- 1 personal data -----------------------------------------------------------------------------------------------

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def plain_spans(text: str | None) -> list[tuple[str, int, int]]:
    found = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            fits = {
                "email": True,
                "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True,
                "card": 13 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if fits:
                found.append((kind, *m.span()))
    return found


TRICKY = [
    "a@b.c_d@e.f.g x.y+z@q-r.com, 🙂é me@x.de. @no a@b .c a@.b a@b..c",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.0255 99999999999999999999.1.1.1 1.2.3 0.0.0.0",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 5500000000000004  4111  1111 " + "4" * 30_000,
    "+1 (415) 555-2671 +49.30.123456-7 ++1 23456789 +1 2 +123456789012345678",
    "+" + "(" * 50_000 + " " + "a" * 200_000 + "." * 1000 + "1" * 5000 + "@" + "x." * 20_000,
    "j.doe@example.org" * 300,
    "Zoë’s IP: 10.0.0.1 10.0.0.2\n10.0.0.3",
]


def test_base_spans_are_those_of_the_patterns(spark, docs):
    rows = [(i, t) for i, t in enumerate([*TRICKY, None, ""])] + [(r["doc_id"] + 100, r["text"]) for r in docs.limit(400).collect()]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    told = {r["doc_id"]: r for r in pii.digest(frame).collect()}
    for i, text in rows:
        spans = plain_spans(text)
        shown = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        assert told[i]["base_sha256"] == hashlib.sha256(shown.encode()).hexdigest(), text
        assert [told[i][f"n_{k}"] for k in PLAIN] == [sum(s[0] == k for s in spans) for k in PLAIN]
        assert told[i]["spans"] == shown or told[i]["spans"].startswith((shown + ",term:") if shown else "term:")


def test_terms_that_disclose_an_entity(spark):
    plain = [(i, f"ordinary words number {i} stand here with others") for i in range(400)]
    named = [(1000 + i, f"Please ask Alucarda about others at alu@corp{i % 2}.com, said Alucarda; with {i}") for i in range(10)]
    frame = spark.createDataFrame(plain + named, "doc_id long, text string")
    found = {(r["entity"], r["term"]) for r in pii.disclosures(frame).collect()}
    assert ("email:alu@corp0.com", "alucarda") in found and not any(t in ("others", "with") for _, t in found)
    safe = {r["doc_id"]: r for r in pii.sanitise(frame).collect()}
    for i, text in plain:
        assert safe[i]["text"] == text and not safe[i]["spans"]
    for i, text in named:
        assert "alu" not in safe[i]["text"].lower() and "[EMAIL]" in safe[i]["text"]
        terms = [s for s in safe[i]["spans"] if s["kind"] == "term" and s["value"] == "Alucarda"]
        assert [text[s["first"] : s["end"]] for s in terms] == ["Alucarda"] * 2


def test_names_far_from_an_entity_and_behind_other_numbers(spark):
    plain = [(i, f"these words of number {i} now stand at the door 12/25 and pay with an exp of the words") for i in range(400)]
    far = "of these words at the door now stand number words and pay"
    named = [(1000 + i, f"Alucarda {far} {far} of the words alu@corp.com now {i}") for i in range(10)]
    carded = [(2000 + i, f"pay 4111111111111111 exp 12/25 Jane Zobrist now {i}") for i in range(10)]
    frame = spark.createDataFrame(plain + named + carded, "doc_id long, text string")
    found = {(r["entity"], r["term"]) for r in pii.disclosures(frame).collect()}
    assert {e for e in found if e[0] == "email:alu@corp.com"} == {("email:alu@corp.com", t) for t in ("alucarda", "alu", "corp", "com")}
    assert {e for e in found if e[0] != "email:alu@corp.com"} == {("card:4111111111111111", t) for t in ("jane", "zobrist")}
    for row in pii.sanitise(frame).where("doc_id >= 1000").collect():
        assert not re.search("alucarda|jane|zobrist", row["text"].lower())
        assert far in row["text"] or row["text"].startswith("pay [CARD] exp 12/25 ")


def test_disclosures_are_those_of_plain_counting(spark):
    rng = random.Random(8)
    texts = []
    for i in range(300):
        own = [f"user{j}@x.org" for j in range(6) if rng.random() < 0.05 * (j + 1)]
        words = rng.choices([f"w{chr(97 + k)}" for k in range(26)], k=rng.randrange(1, 12))
        words += [f"mark{chr(97 + int(e[4]))}" for e in own if rng.random() < 0.9]
        rng.shuffle(words)
        texts.append(" ".join([*own, *words]))
    texts += ["only once copied name zed@x.org"] * 200 + [None, ""]  # copies to the letter are one sighting
    held = [(set(re.findall(r"[a-z0-9]+@x\.org", t or "")), {w for w in re.split(r"[^a-z]+", t or "") if len(w) > 1}, t) for t in texts]
    n, expected = len(texts), {}
    for e in {e for entities, _, _ in held for e in entities}:
        for t in {t for entities, words, _ in held if e in entities for t in words}:
            both = [text for entities, words, text in held if e in entities and t in words]
            ne, nt = sum(e in x for x, _, _ in held), sum(t in w for _, w, _ in held)
            told = round(math.log2(n * len(both) / (ne * nt)) / math.log2(n / ne), 9)
            if len(set(both)) >= 4 and told >= 0.8:
                expected["email:" + e, t] = told
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = {(r["entity"], r["term"]): r["disclosure"] for r in pii.disclosures(frame).collect()}
    assert found == pytest.approx(expected) and any(t.startswith("mark") for _, t in found)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "a@b.c"), (1, "a@b.c"), (None, "a@b.c")]])
def test_personal_data_in_odd_tables(spark, rows):
    frame = spark.createDataFrame([(*row, "own") for row in rows], "doc_id long, text string, Spans string")
    assert pii.find(frame).columns == ["doc_id", "text", "spans"]
    safe = sorted(((r["doc_id"], r["text"]) for r in pii.sanitise(frame).collect()), key=repr)
    assert safe == sorted(((i, t and "[EMAIL]") for i, t in rows), key=repr)
    assert pii.digest(frame).count() == len(rows)


def test_safe_texts_hold_no_entity(spark):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate([*TRICKY[:4], None, "", "1.1.1.1"])], "doc_id long, text string")
    for row in pii.sanitise(frame).collect():
        text = None if row["doc_id"] == 4 else dict(enumerate([*TRICKY[:4], None, "", "1.1.1.1"]))[row["doc_id"]]
        if text is None:
            assert row["text"] is None
            continue
        spans = sorted((s, e) for _, s, e in plain_spans(text))
        outside, at = [], 0
        for s, e in spans:
            outside.append(text[at:s])
            at = max(at, e)
        assert re.sub(r"\[[A-Z]+\]", "", row["text"]) == "".join([*outside, text[at:]])


# --- 2 byte-level BPE ----------------------------------------------------------------------------------------------


def test_tokens_are_those_of_the_public_ranks(spark, docs, odd):
    ranks = {
        base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))
    }
    public = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = docs.select("doc_id", "text").limit(300).unionByName(odd.select("doc_id", "text"))
    extra = ["<|endoftext|> 's   \x1c x\u0000y ́ ﷺ 👩‍👩‍👧 " + "z" * 5000]
    rows = rows.unionByName(spark.createDataFrame([(-1, t) for t in extra], "doc_id long, text string"))
    for r in bpe.round_trip(rows.withColumn("n_tokens", F.lit(7)), PATH, PATTERN, keep=["text", "n_tokens"]).collect():
        ids = public.encode_ordinary(r["text"] or "")
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()


def test_offsets_cover_split_characters(spark):
    frame = spark.createDataFrame([("é🙂 ok 漢",), (None,), ("",)], "text string")
    coded = bpe.encode(frame, PATH, PATTERN)
    row, *rest = coded.collect()
    assert all(r["ids"] == [] and r["starts"] == [] for r in rest)
    assert row["starts"][0] == 0 and row["ends"][-1] == len(row["text"])
    assert "".join(row["text"][max(s, p) : e] for s, e, p in zip(row["starts"], row["ends"], [0, *row["ends"]])) == row["text"]
    assert [r["decoded"] for r in bpe.decode(coded, PATH, PATTERN).collect()] == ["é🙂 ok 漢", "", ""]
    cut = coded.select(F.slice("ids", 2, 1).alias("ids")).limit(1)
    assert bpe.decode(cut, PATH, PATTERN).first()["decoded"] is not None


# --- 3 repeated passages -------------------------------------------------------------------------------------------


def plain_passages(rows, least):
    """Texts after the removal of repeated runs, in order of id."""
    seen, out = {}, {}
    for i, text in sorted(rows):
        gone = set()
        for key, s, e in substring.runs(text, least):
            if seen.setdefault(key, (i, s, e)) != (i, s, e):
                gone |= set(range(s, e + 1))
        out[i] = "".join(x for n, x in enumerate(substring.sentences(text)) if n not in gone)
    return out


def test_repeated_passages_go(spark, docs, odd):
    rows = [(r["doc_id"], r["text"]) for r in docs.limit(300).collect()]
    passage = " ".join(f"Sentence {i} has its own nine words in it." for i in range(8))
    rows += [(10_000, f"Start one. {passage} End one."), (10_001, f"Other start! {passage} Other end, longer."), (10_002, "Clean text.")]
    told = {r["doc_id"]: r for r in substring.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i: r["text"] for i, r in told.items()} == plain_passages(rows, substring.LEAST_WORDS)
    assert passage in told[10_000]["text"] and "Sentence" not in told[10_001]["text"]
    assert told[10_001]["text"] == "Other start! Other end, longer." and told[10_002]["removed"] == 0
    back = substring.deduplicate(odd)
    assert back.count() == len(ODD) and set(back.columns) == set(odd.columns)
    assert {r["text"] for r in back.where("doc_id < 5").collect()} == {t for i, t, *_ in ODD if i and i < 5}
    assert back.where("doc_id = 6").distinct().count() == 1
    assert substring.deduplicate(odd.limit(0)).count() == 0
    for text in ("A b. C d! e\n\nf", "1.5 of it... Well?\tyes", LONG[:5000], ""):
        assert "".join(substring.sentences(text)) == text


# --- 4, 5, 6 classifiers -------------------------------------------------------------------------------------------


def auc(y, score):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    ones = y.sum()
    return (rank[y == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(y) - ones))


def held(i, modulus, left):
    return zlib.crc32(str(i).encode()) % modulus == left


def labelled(spark, folder="/root/testdata/sf0.1"):
    rows = spark.read.parquet(f"{folder}/documents.parquet").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    return rows.select("doc_id", "text", "quality", "toxic").orderBy("doc_id").collect()


@pytest.fixture(scope="module")
def marks(spark):
    return labelled(spark)


def test_toxicity_on_held_out_rows(marks):
    own = [r for r in marks if not held(r["doc_id"], 5, 0)]
    buckets, ends = toxicity._buckets([r["text"] for r in own])
    model = toxicity.train([buckets[s:e] for s, e in zip(ends[:-1], ends[1:])], np.array([r["toxic"] for r in own], float))
    rest = [r for r in marks if held(r["doc_id"], 5, 0)]
    score, y = model.scores([r["text"] for r in rest]), np.array([r["toxic"] for r in rest])
    # A third of the toxic texts hold no insult, and are labelled so at random.
    assert auc(y, score) > 0.9 and (y[score >= 0.5] == 1).mean() > 0.95
    insult = np.array([bool(re.search("idiot|moron|pathetic", r["text"])) for r in rest])
    assert (score[insult] >= 0.5).mean() > 0.95
    assert model.scores([None, ""]).tolist() == [model.scores(["zzz"])[0]] * 2
    assert toxicity.train([], np.empty(0)).scores(["any"])[0] == 0.5


def test_factors_learn_a_pair_that_weights_cannot():
    random = np.random.default_rng(0)
    x = random.integers(0, 2, (600, 2))
    y = (x[:, 0] == x[:, 1]).astype(float)  # neither term alone tells
    y[:30] = x[:30, 0]  # enough for the screening to take both
    y[30:60] = x[30:60, 1]
    rows = [np.array([i + 10 for i in range(2) if line[i]] + [50]) for line in x]
    before = toxicity._screened
    toxicity._screened = lambda *_: np.array([10, 11])
    try:
        model = toxicity.train(rows, y, rounds=2000, penalty=(1e-6, 1e-6))
    finally:
        toxicity._screened = before
    assert abs((model.factors[0] * model.factors[1]).sum()) > 1


def test_toxicity_learns_pairs_from_the_labels(spark):
    random = np.random.default_rng(0)
    rows = []
    for i in range(1200):
        insult, group = random.random(2) < 0.5
        text = [f"w{x}" for x in random.integers(0, 400, 30)] + ["zig"] * int(insult) + ["grp"] * int(group)
        random.shuffle(text)
        rows.append((i, " ".join(text), int(insult == group)))  # neither term alone tells
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(docs.drop("toxic"), docs.drop("text"), F.col("doc_id") < 900)
    score = model.scores([t for i, t, _ in rows if i >= 900])
    assert ((score >= 0.5) == [y for i, _, y in rows if i >= 900]).mean() > 0.95


def test_quality_on_held_out_rows(marks):
    own = [r for r in marks if not held(r["doc_id"], 3, 1)][:1200]
    model = quality.train([quality.GRAMS.counts(r["text"]) for r in own], np.array([r["quality"] for r in own]))
    rest = [r for r in marks if held(r["doc_id"], 3, 1)]
    score, y = model.scores([r["text"] for r in rest]), np.array([r["quality"] for r in rest])
    assert auc(y, score) > 0.98 and ((score >= 0.5) == (y == 1)).mean() > 0.97


def test_language_on_held_out_rows(spark, docs, odd):
    ids = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) != 2, F.lit(False))
    model = language.fit(docs, ids)
    assert model.families == ("germanic", "romance") and model.pairs == (("de", "en"), ("es", "fr"))
    rows = docs.where(~ids).select("text", "lang").collect()
    names, scores = model.predict([r["text"] for r in rows])
    assert np.mean([a == r["lang"] for a, r in zip(names, rows)]) > 0.97 and 0 <= min(scores) <= max(scores) <= 1
    told = {r["doc_id"]: r for r in language.identify(odd, model).collect()}
    assert all(told[i]["lang_pred"] == "und" and told[i]["score"] == 0 for i in (1, 2, 3, 4))
    assert told[5]["lang_pred"] in model.languages and len(told) == len({r[0] for r in ODD})
    none = language.fit(docs.limit(0), ids)
    assert none.predict(["text"]) == (["und"], [0.0])


def test_a_rare_language_is_learned(spark):
    random = np.random.default_rng(9)
    words = {"en": ["the", "which", "there", "with"], "fi": ["jälkeen", "yötä", "hyvää", "päivää"]}
    rows = [(i, " ".join(random.choice(words[x], 12)), x) for i, x in enumerate(["en"] * 6000 + ["fi"] * 12)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True), sample_rows=50)
    assert model.languages == ("en", "fi") and model.predict(["hyvää yötä", "there with the"])[0] == ["fi", "en"]


def test_classifiers_take_odd_rows(spark, odd):
    marks = spark.createDataFrame([(5, 1, 0), (6, 0, 1), (6, 0, 1), (None, 1, 1), (9, None, None)], "doc_id long, quality int, toxic int")
    for module in (toxicity, quality):
        model = module.fit(odd, marks, F.lit(True))
        rows = module.score(odd, model).collect()
        assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
        assert module.score(odd.limit(0), module.fit(odd.limit(0), marks.limit(0), F.lit(True))).count() == 0


# --- 7 near copies -------------------------------------------------------------------------------------------------


def weighted_sets(texts, words=5):
    """Shingles with exact TF-IDF weights."""
    sets = []
    for t in texts:
        w = re.findall(r"[^\W_]+", (t or "").lower())
        sets.append(Counter(tuple(w[i : i + words]) for i in range(len(w) - words + 1)) or Counter([tuple(w)] if w else []))
    df, n = Counter(s for c in sets for s in c), len(texts)
    return [{s: v * max(np.log((1 + n) / (1 + df[s])), 0.01) for s, v in c.items()} for c in sets]


def weighted_jaccard(a, b):
    low = sum(min(a[s], b[s]) for s in a if s in b)
    return low / max(sum(a.values()) + sum(b.values()) - low, 1e-12)


def test_samples_agree_as_often_as_sets_are_alike():
    random = np.random.default_rng(1)
    base = random.integers(0, 1 << 62, 300).astype(np.uint64)
    other = np.concatenate([base[:240], random.integers(0, 1 << 62, 60).astype(np.uint64)])
    weights = random.uniform(0.5, 8, 300)
    values, ends = np.concatenate([base, other]), np.array([0, 300, 600])
    marks = neardup.signatures(values, np.concatenate([weights, weights]), ends, 800)
    low, total = weights[:240].sum(), 2 * weights.sum()
    assert abs((marks[0] == marks[1]).mean() - low / (total - low)) < 0.06


def test_near_copies_are_classed_whole(spark, docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    random = np.random.default_rng(2)
    base = [f"w{x}" for x in random.integers(0, 5000, 200)]
    for i in range(40):  # a group of different near copies
        text = list(base)
        text[int(random.integers(0, 200))] = f"changed{i}"
        rows.append((20_000 + i, " ".join(text)))
    told = {r["doc_id"]: r for r in neardup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = dict(zip([i for i, _ in rows], weighted_sets([t for _, t in rows])))
    by_shingle = {}
    for i, s in sets.items():
        for x in s:
            by_shingle.setdefault(x, []).append(i)
    pairs = {(a, b) for ids in by_shingle.values() if len(ids) < 100 for a in ids for b in ids if a < b}
    alike = [(a, b) for a, b in pairs if weighted_jaccard(sets[a], sets[b]) >= 0.82]
    assert len(alike) > 800 and all(told[a]["class_id"] == told[b]["class_id"] for a, b in alike)
    apart = [(i, r["class_id"]) for i, r in told.items() if r["class_id"] != i]
    linked = {i for p in pairs if weighted_jaccard(sets[p[0]], sets[p[1]]) >= 0.75 for i in p}
    assert all(i in linked or dict(rows)[i] == dict(rows)[c] for i, c in apart)
    assert sum(r["keep"] for r in told.values()) == len({r["class_id"] for r in told.values()})


def test_variants_of_a_third_of_all_rows_are_one_class(spark):
    random = np.random.default_rng(12)
    text = lambda: [f"w{x}" for x in random.integers(0, 5000, 500)]
    base, rows = text(), [(i, " ".join(text())) for i in range(600)]
    for i in range(300):
        own = list(base)
        for place in random.choice(500, 4, replace=False):
            own[place] = f"changed{i}x{place}"
        rows.append((1000 + i, " ".join(own)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for part in (frame, frame.where("doc_id >= 1000")):  # also where there is nothing else
        told = {r["doc_id"]: r["class_id"] for r in neardup.classes(part).collect()}
        assert {i: c for i, c in told.items() if c != (1000 if i >= 1000 else i)} == {}


def test_near_copies_take_odd_rows(spark, odd):
    told = neardup.classes(odd).collect()
    assert len(told) == len(ODD)
    twice = [r for r in told if r["doc_id"] == 6]
    assert [(r["class_id"], r["class_size"]) for r in twice] == [(6, 2)] * 2
    left = neardup.deduplicate(odd)
    assert left.columns == odd.columns and sorted(r["doc_id"] or 0 for r in left.collect()) == [0, 1, 2, 3, 4, 5, 6]
    assert neardup.classes(odd.limit(0)).count() == 0 and neardup.deduplicate(odd.limit(0)).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 102), (200, 200)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a int, b int"), "test-components").collect()}
    assert found == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100}


# --- 8, 9 searches -------------------------------------------------------------------------------------------------


def vectors(n, width, seed):
    return np.random.default_rng(seed).normal(size=(n, width))


def brute(x, ids, queries, k):
    out = []
    for q in queries:
        score = x @ x[q]
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != ids[q]][:k]
        out += [(int(ids[q]), r + 1, int(ids[j]), float(score[j])) for r, j in enumerate(order)]
    return out


ODD_VECTORS = [(9001, None), (9002, [None, 1.0]), (9003, [float("nan"), 1.0]), (9004, [float("inf"), 0.0]), (None, [1.0, 1.0]), (9005, [])]


@pytest.mark.parametrize("width", [2, 24])
def test_exact_search(spark, width):
    x = np.floor(vectors(700, width, 3) * 8)  # whole numbers: many ties
    x[300:500] = x[0]  # and many equal vectors
    ids = np.arange(700)
    rows = [(int(i), v.tolist()) for i, v in zip(ids, x)] + [(i, v) for i, v in ODD_VECTORS if width == 2]
    frame = spark.createDataFrame(rows, "id long, vector array<double>")
    asked = frame.where("id % 20 = 0 OR id IS NULL OR id > 9000")
    found = kdtree.top_k(frame, asked, 20, shard_rows=150, block_rows=16, leaf_rows=8).collect()
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] < 9000)
    assert got == sorted(brute(x, ids, np.flatnonzero(ids % 20 == 0), 20))
    few = kdtree.top_k(frame.where("id < 5"), frame.where("id = 2"), 20).collect()
    assert len(few) == 4 and kdtree.top_k(frame.limit(0), frame.limit(0)).count() == 0


def test_tree_boxes_are_tight():
    x = vectors(500, 5, 4)
    order, first, end, left, low, high = kdtree.build(x, 16)
    assert sorted(order) == list(range(500))
    for s, e, c, lo, hi in zip(first, end, left, low, high):
        own = x[order[s:e]]
        assert (own.min(0) == lo).all() and (own.max(0) == hi).all()
        assert c < 0 or (first[c], end[c + 1], end[c]) == (s, e, first[c + 1])


def test_graph_search_recall(spark):
    centres = vectors(30, 32, 5) * 2
    x = centres[np.random.default_rng(6).integers(0, 30, 3000)] + vectors(3000, 32, 7)
    ids = np.arange(3000)
    rows = [(int(i), v.tolist()) for i, v in zip(ids, x)] + [(3001, [0.0] * 32), (3020, None)] + [(i, v) for i, v in ODD_VECTORS]
    frame = spark.createDataFrame(rows, "id long, vector array<double>")
    found = hnsw.nearest(frame, frame.where("id % 20 = 0"), shard_rows=1000).collect()
    wanted = brute(x, ids, np.flatnonzero(ids % 20 == 0), 20)
    hits = {(q, v) for q, _, v, _ in wanted} & {(r["query_id"], r["vec_id"]) for r in found}
    assert len(hits) >= 0.9 * len(wanted)
    scores = {(r["query_id"], r["vec_id"]): r["score"] for r in found if r["query_id"] < 3000}
    assert all(s == pytest.approx(float(x[q] @ x[v])) for (q, v), s in list(scores.items())[:300])
    per_query = Counter(r["query_id"] for r in found)
    assert set(per_query.values()) == {20} and 3020 not in per_query
    few = hnsw.nearest(frame.where("id < 7"), frame.where("id = 0")).collect()
    assert sorted(r["vec_id"] for r in few) == [1, 2, 3, 4, 5, 6] and hnsw.nearest(frame.limit(0), frame.limit(0)).count() == 0


# --- 10 mixing -----------------------------------------------------------------------------------------------------


def plain_targets(sizes, weights=(5, 2, 1), passes=3):
    """Shares by weight; what is above a source's most is shared again until none is."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    given, open_ = {}, list(names)
    while open_:
        left, total = sum(sizes.values()) - sum(given.values()), sum(weight[s] for s in open_)
        share = {s: left * weight[s] / total for s in open_}
        full = [s for s in open_ if share[s] > passes * sizes[s]]
        if not full:
            return given | share
        given |= {s: passes * sizes[s] for s in full}
        open_ = [s for s in open_ if s not in full]
    return given


def test_mix_comes_near_its_targets(spark, docs, odd):
    rows = mixing.mix(docs).collect()
    sizes = Counter()
    for r in rows:
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
        assert r["taken"] in (0, r["size"], 2 * r["size"], 3 * r["size"])
        sizes[r["source"]] += r["size"]
    taken, wanted = Counter(), plain_targets(sizes)
    for r in rows:
        taken[r["source"]] += r["taken"]
        assert r["target"] == pytest.approx(wanted[r["source"]]) and r["source_size"] == sizes[r["source"]]
    longest = max(r["size"] for r in rows)
    assert all(abs(taken[s] - wanted[s]) <= longest for s in wanted) and sum(taken.values()) <= sum(sizes.values())
    again = mixing.mix(docs.repartition(7), keep=["doc_id"], slice_rows=50).collect()
    assert {r["doc_id"]: r["taken"] for r in again} == {r["doc_id"]: r["taken"] for r in rows}
    mixed = mixing.mixed_rows(docs)
    assert mixed.columns == docs.columns
    assert Counter(r["doc_id"] for r in mixed.collect()) == Counter({r["doc_id"]: r["turns"] for r in rows if r["turns"]})


def test_mix_takes_odd_rows(spark, odd):
    rows = mixing.mix(odd.withColumn("size", F.lit("x"))).collect()
    assert len(rows) == len(ODD) and all(r["taken"] <= 3 * r["size"] for r in rows)
    assert mixing.mix(odd.limit(0)).count() == 0
    assert mixing.mixed_rows(odd).count() == sum(r["turns"] for r in rows)
    tiny = spark.createDataFrame([("a", "x" + " y" * 9), ("b", "z"), ("c", None)], "source string, text string").withColumn("doc_id", F.lit(1))
    assert {r["source"]: r["target"] for r in mixing.mix(tiny).collect()} == pytest.approx({"a": 8.0, "b": 3.0, "c": 0.0})
