"""Latent Dirichlet allocation by variational Bayes, with learned priors of topics in documents and of words in topics.

The word sums of the topics are a table of one row per term and stay one: no node holds the vocabulary, and a term limit
is not needed.  Documents are dealt into blocks of bounded size, blocks into groups, and the ids and counts of their terms
are stored by group once, in buckets, so that passes don't shuffle them; other columns stay out of the passes.  In a pass
each group meets the rows of its own terms and its documents' weights, improves these block by block over whole arrays, and
gives back one row of sums per term; sums of groups make the next table.  A pass writes over the tables of the last but one.
The driver sees numbers of topics only.

Weights of documents are kept from pass to pass, and priors take a Newton step only as far as it raises the bound, so the
bound of the passes never falls.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.gammas import digamma, log_gamma, trigamma
from tallyloom.functions.numbering import numbered
from tallyloom.operators.text import build_vocabulary
from tallyloom.session import stored, stored_buckets, work_name

#: Counts of terms in documents that a block holds, about.
BLOCK_TERMS = 200_000
#: Most blocks of a group.
GROUP_BLOCKS = 40
#: Steps of the weights of a block's documents in a pass, and the mean change that ends them earlier.
STEPS, SETTLED = 50, 1e-4
#: Parts of a Newton step that are tried on the prior of words.
_HALVINGS = [0.5**i for i in range(8)]
_DOCUMENT, _TERM, _SUMS = 0, 1, 2
#: Documents are worked out together whose numbers of terms differ by this factor at most.
ALIKE = 1.2
#: Places of terms that are worked on together, and steps taken before it is asked whether a block has settled.
NEAR, STRIDE = 32_768, 5


@dataclass(frozen=True)
class TopicModel:
    """Learned topics.

    `terms`: term_id, term, documents.  `topics`: term_id, eta (the word's prior), weights (its sum in each topic),
    held (the part of each weight that is prior).
    `documents`: every document with `_row`, its known `terms` and `counts`, and `gamma`, its topic weights.
    `alpha`: the prior of topics; `totals`: sums of the topics' weights; `bounds`: the bound of each pass.
    """

    k: int
    terms: DataFrame
    topics: DataFrame
    documents: DataFrame
    alpha: np.ndarray
    totals: np.ndarray
    bounds: list[float] = field(default_factory=list)


def _word_counts(rows: DataFrame) -> DataFrame:
    """(_row, term, n): every document's different words.  A document is counted where it is, without a shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1).fill_null([])
            words = lists.flatten().dictionary_encode()
            place = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
            known = words.indices.is_valid().to_numpy(zero_copy_only=False)
            codes = words.indices.fill_null(0).to_numpy()[known].astype(np.int64)
            width = max(1, len(words.dictionary))
            pairs, n = np.unique(place[known] * width + codes, return_counts=True)
            columns = [batch.column(0).take(pa.array(pairs // width)), words.dictionary.take(pa.array(pairs % width)), pa.array(n, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["_row", "term", "n"])

    return rows.select("_row", "tokens").mapInArrow(count, "_row long, term string, n long")


def _spread_labels(spark: SparkSession, groups: int) -> list[int]:
    """A number for each of some groups, each of which falls into a bucket of its own."""
    tried = spark.range(groups * (20 + groups.bit_length())).select("id", F.pmod(F.hash("id"), F.lit(groups)).alias("bucket"))
    found = [r["id"] for r in tried.groupBy("bucket").agg(F.min("id").alias("id")).orderBy("id").collect()]
    return found + [-1 - i for i in range(groups - len(found))]  # any other numbers do too, less evenly


def bags(rows: DataFrame, vocabulary: DataFrame, block_terms: int = BLOCK_TERMS) -> tuple[DataFrame, int, int]:
    """`_group`, `_block`, `_row`, and the ids and counts of terms in `vocabulary` (term, term_id) of rows (_row, tokens), and
    the numbers of groups and blocks.

    Words of a document are counted before they meet the vocabulary, so a common word is one row per document.
    """
    known = _word_counts(rows).join(vocabulary.select("term", "term_id").hint("shuffle_hash"), "term").select("_row", "term_id", "n")
    gathered = known.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("term_id", "n"))).alias("_b"))
    gathered = stored(
        gathered.select("_row", F.col("_b")["term_id"].alias("terms"), F.col("_b")["n"].alias("counts")), "topic-counts"
    )
    size = gathered.agg(F.sum(F.size("terms")).alias("n")).first()["n"] or 0
    blocks = -(-size // block_terms) or 1
    cores = rows.sparkSession.sparkContext.defaultParallelism
    waves = max(1, -(-blocks // (GROUP_BLOCKS * cores)))  # groups of equal size for each core
    groups = min(blocks, waves * cores)
    labels = F.array(*[F.lit(x).cast("long") for x in _spread_labels(rows.sparkSession, groups)])
    none = F.array().cast("array<long>")
    block = F.pmod(F.xxhash64("_row"), F.lit(blocks))
    dealt = rows.select("_row").join(gathered, "_row", "left").select(
        F.element_at(labels, (F.pmod(block, F.lit(groups)) + 1).cast("int")).alias("_group"), block.alias("_block"), "_row",
        F.coalesce("terms", none).alias("terms"), F.coalesce("counts", none).alias("counts"),
    )
    return dealt, groups, blocks


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def log_expectation(weights: np.ndarray) -> np.ndarray:
    """Expected logarithms of Dirichlet rows."""
    return digamma(weights) - digamma(weights.sum(axis=1, keepdims=True))


def _alike(lengths: np.ndarray) -> list[tuple[int, int]]:
    """Where stretches of ascending lengths begin and end that differ by a factor of `ALIKE` at most and make about `NEAR`
    places; lengths of 0 are left out."""
    at, parts = int(np.searchsorted(lengths, 0, "right")), []
    while at < len(lengths):
        end = int(np.searchsorted(lengths, lengths[at] * ALIKE, "right"))
        end = min(end, at + max(1, int(NEAR / (lengths[at] * ALIKE))))
        parts.append((at, end))
        at = end
    return parts


def _steps(alike: list[tuple], gamma: np.ndarray, alpha: np.ndarray, steps: int) -> np.ndarray:
    """Weights of documents after each of some steps.  Stretches of about `NEAR` places take all steps in turn, while they
    are near to the processor."""
    out = np.empty((steps, *gamma.shape))
    out[:, : alike[0][0] if alike else len(gamma)] = alpha  # documents without terms
    at = 0
    while at < len(alike):
        to, size = at, 0
        while to < len(alike) and (to == at or size + alike[to][3].size <= NEAR):
            size += alike[to][3].size
            to += 1
        low, high = alike[at][0], alike[to - 1][1]
        now = gamma[low:high]
        for turn in range(steps):
            theta = np.exp(log_expectation(now))
            now = out[turn, low:high]
            for start, end, _, held, beta in alike[at:to]:
                share = np.matmul(beta, theta[start - low : end - low, :, None])[:, :, 0]
                share += 1e-300
                np.divide(held, share, out=share)
                now[start - low : end - low] = np.matmul(share[:, None, :], beta)[:, 0, :]
            now *= theta
            now += alpha
        at = to
    return out


def improve(
    place: np.ndarray, term: np.ndarray, counts: np.ndarray, gamma: np.ndarray, words: np.ndarray, alpha: np.ndarray, steps: int = STEPS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Topic weights of documents, expected counts of terms in topics, and sums over the documents (their number, their part
    of the bound, expected logarithms and counts of each topic), from (document, term, count) triples, ordered by document, earlier weights, and exponentials of the words' expected
    logarithms.

    Documents are put in order of length, and those of like length make one array of matrices: a step is two products of each.
    The steps are those of the whole block up to the first that changes it little.
    """
    n, k = gamma.shape
    lengths = np.bincount(place, minlength=n)
    order = np.argsort(lengths, kind="stable")
    first, lengths, gamma = (np.cumsum(lengths) - lengths)[order], lengths[order], gamma[order]
    alike = []
    for start, end in _alike(lengths):
        span = np.arange(lengths[end - 1])
        blank = span >= lengths[start:end, None]
        at = np.where(blank, first[start:end, None], first[start:end, None] + span)
        alike.append((start, end, term[at], np.where(blank, 0.0, counts[at]), words[term[at]]))

    done = 0
    while done < steps:
        after = _steps(alike, gamma, alpha, min(STRIDE, steps - done))
        changes = np.abs(after - np.concatenate([gamma[None], after[:-1]])).mean(axis=(1, 2)) if n else np.zeros(1)
        settled = np.flatnonzero(changes < SETTLED)
        gamma, done = after[settled[0] if len(settled) else -1], steps if len(settled) else done + len(after)
    logs = log_expectation(gamma)
    theta = np.exp(logs)
    sums, bound, used, given = np.zeros((len(words), k)), 0.0, [np.zeros(0, np.int64)], [np.zeros((k, 0))]
    for start, end, own, held, beta in alike:
        norm = np.matmul(beta, theta[start:end, :, None])[:, :, 0] + 1e-300
        share = held / norm
        used.append(own.ravel())
        given.append(np.stack([(beta[:, :, i] * (share * theta[start:end, i, None])).ravel() for i in range(k)]))
        bound += float((held * np.log(norm)).sum())
    used, given = np.concatenate(used), np.concatenate(given, axis=1)
    for i in range(k):
        sums[:, i] = np.bincount(used, given[i], len(words))
    bound += float(((alpha - gamma) * logs + log_gamma(gamma)).sum())
    bound += float((log_gamma(np.array([alpha.sum()])) - log_gamma(alpha).sum() - log_gamma(gamma.sum(axis=1))).sum())
    after = np.empty_like(gamma)
    after[order] = gamma
    return after, sums, np.concatenate([[n, bound], logs.sum(axis=0), sums.sum(axis=0)])


_PARTS, _KINDS = ("rows", "lengths", "used", "terms", "counts"), (np.int64, np.int32, np.int32, np.int32, np.int32)
_PACKED = "_group long, _block long, rows binary, lengths binary, used binary, terms binary, counts binary"


def _pack(documents: pa.Table) -> pa.Table:
    """A group's blocks, a row each: numbers and lengths of its documents, the places of its terms among those of the
    group, and for each term of a document its place in the block and its count.  Block -1 has the group's terms."""
    documents = documents.sort_by("_block")
    number, whole = documents.column("_group")[0].as_py(), documents.column("terms").combine_chunks()
    ids, places = np.unique(whole.flatten().to_numpy(), return_inverse=True)
    counts, rows = documents.column("counts").combine_chunks().flatten().to_numpy(), documents.column("_row").to_numpy()
    lengths, blocks = whole.value_lengths().to_numpy(), documents.column("_block").to_numpy()
    ends = np.cumsum(lengths)
    edges = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
    out = [(number, -1, b"", b"", ids.astype(np.int64).tobytes(), b"", b"")]
    for start, end in zip(edges, edges[1:]):
        own = slice(ends[start] - lengths[start], ends[end - 1])
        used, terms = np.unique(places[own], return_inverse=True)
        kept = (rows[start:end], lengths[start:end], used, terms, counts[own])
        kept = [x.astype(kind).tobytes() for x, kind in zip(kept, _KINDS)]
        out.append((number, int(blocks[start]), *kept))
    kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 5]
    return pa.table([pa.array(c, kind) for c, kind in zip(zip(*out), kinds)], names=["_group", "_block", *_PARTS])


def _needed(packed: DataFrame) -> DataFrame:
    """(term_id, groups): the groups that hold each term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group, held in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.frombuffer(held.as_buffer(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), group)), pa.array(ids)], names=["_group", "term_id"])

    pairs = packed.where("_block = -1").select("_group", "used").mapInArrow(run, "_group long, term_id long")
    return pairs.groupBy("term_id").agg(F.collect_list("_group").alias("groups"))


def _expectation(k: int, alpha: np.ndarray, totals: np.ndarray):
    """The work of one group in one pass, block by block."""
    spent = digamma(totals)

    def block(held: dict, own: np.ndarray, known: np.ndarray, weights: np.ndarray):
        rows, lengths, used, term, counts = (np.frombuffer(held[n], kind) for n, kind in zip(_PARTS, _KINDS))
        place, counts = np.repeat(np.arange(len(lengths)), lengths), counts.astype(np.float64)
        if len(known):
            gamma = weights[np.searchsorted(known, rows)]
        else:
            gamma = alpha + np.bincount(place, counts, len(lengths))[:, None] / k
        return rows, used, *improve(place, term, counts, gamma, own[used], alpha)

    def group(documents: pa.Table, met: pa.Table) -> pa.Table:
        kinds, at, vectors = met.column("kind").to_numpy(), met.column("id").to_numpy(), _matrix(met.column("vec"), k)
        sides = []
        for kind in (_TERM, _DOCUMENT):
            chosen = np.flatnonzero(kinds == kind)
            chosen = chosen[np.argsort(at[chosen])]
            sides.append((at[chosen], vectors[chosen]))
        (ids, words), (known, weights) = sides
        own = np.exp(digamma(words) - spent) if len(ids) else np.zeros((0, k))
        sums, told, rows, gammas = np.zeros((len(ids), k)), np.zeros(2 + 2 * k), [np.zeros(0, np.int64)], [np.zeros((0, k))]
        documents = documents.sort_by("_block")
        for i in range(documents.num_rows):
            held = {name: documents.column(name)[i].as_buffer() for name in _PARTS}
            here, used, gamma, given, part = block(held, own, known, weights)
            sums[used] += given
            told += part
            rows.append(here)
            gammas.append(gamma)
        rows = np.concatenate(rows)
        kind = np.concatenate([np.full(len(rows), _DOCUMENT), np.full(len(ids), _TERM), [_SUMS]])
        flat = np.concatenate([*[g.ravel() for g in gammas], sums.ravel(), told])
        ends = np.append(np.arange(len(rows) + len(ids) + 1) * k, len(flat))
        vec = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
        number = documents.column("_group")[0].as_py() if documents.num_rows else met.column("_group")[0].as_py()
        whole = [pa.array(np.full(len(kind), number), pa.int64()), pa.array(kind, pa.int32()), pa.array(np.concatenate([rows, ids, [0]]), pa.int64()), vec]
        return pa.table(whole, names=["_group", "kind", "id", "vec"])

    return group


_PASS = "_group long, kind int, id long, vec array<double>"


def _pass(
    documents: DataFrame, needed: DataFrame, topics: DataFrame, last: DataFrame | None, k: int, alpha: np.ndarray, totals: np.ndarray, name: str
) -> DataFrame:
    """(_group, kind, id, vec) of one pass over all groups: documents' weights, terms' sums, and each group's own sums."""
    words = needed.join(topics.select("term_id", "weights"), "term_id")
    met = words.select(F.explode("groups").alias("_group"), F.lit(_TERM).alias("kind"), F.col("term_id").alias("id"), F.col("weights").alias("vec"))
    if last is not None:
        met = met.unionByName(last.where(F.col("kind") == _DOCUMENT))
    sides = documents.where("_block >= 0").groupBy("_group").cogroup(met.groupBy("_group"))
    return stored(sides.applyInArrow(_expectation(k, alpha, totals), _PASS), "topic-pass", name)


def _summed(table: DataFrame, work, width: int) -> np.ndarray:
    """Sums of a row of numbers that `work` makes of (eta, weights) arrays, over a whole topic table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            if batch.num_rows:
                weights = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                total += work(batch.column(0).to_numpy(), weights)
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["sums"])

    sums = table.select("eta", "weights").mapInArrow(run, "sums array<double>")
    told = sums.agg(*[F.sum(F.col("sums")[i]) for i in range(width)]).first()
    return np.array([x or 0.0 for x in told])


def dirichlet_prior(prior: np.ndarray, logs: np.ndarray, n: float, rounds: int = 20) -> np.ndarray:
    """A Dirichlet prior that fits summed expected logarithms of `n` rows, by Newton steps that only rise."""

    def fit(x):
        return n * (log_gamma(np.array([x.sum()]))[0] - log_gamma(x).sum()) + float(x @ logs)

    for _ in range(rounds):
        slope = n * (digamma(np.array([prior.sum()]))[0] - digamma(prior)) + logs
        own, shared = -n * trigamma(prior), n * trigamma(np.array([prior.sum()]))[0]
        step = (slope - (slope / own).sum() / (1 / shared + (1 / own).sum())) / own
        for part in _HALVINGS:
            after = prior - part * step
            if (after > 0).all() and fit(after) > fit(prior):
                break
        else:
            return prior
        settled = np.abs(after - prior).max() < 1e-9
        prior = after
        if settled:
            break
    return prior


def _slopes(eta: np.ndarray, weights: np.ndarray, spent: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Summed expected logarithms of words, and first and second derivatives of the bound by their priors."""
    k, logs = len(spent), (digamma(weights) - spent).sum(axis=1)
    return logs, k * (digamma(np.array([prior]))[0] - digamma(eta)) + logs, -k * trigamma(eta)


def _word_prior(topics: DataFrame, totals: np.ndarray, prior: float) -> tuple[DataFrame, float, float]:
    """One Newton step of the words' prior, as far as it raises the bound: the table with it, its sum, and the topics'
    part of the bound."""
    k, spent = len(totals), digamma(totals)

    def first(eta, weights):
        logs, slope, own = _slopes(eta, weights, spent, prior)
        cells = float((-weights * (digamma(weights) - spent) + log_gamma(weights)).sum())
        return np.array([(slope / own).sum(), (1 / own).sum(), cells, log_gamma(eta).sum(), (eta * logs).sum()])

    ratio, inverse, cells, ends, fitted = _summed(topics, first, 5)
    middle = ratio / (1 / (k * trigamma(np.array([prior]))[0]) + inverse)

    def parts(eta, weights):
        logs, slope, own = _slopes(eta, weights, spent, prior)
        out = []
        for part in _HALVINGS:
            after = eta - part * (slope - middle) / own
            safe = np.maximum(after, 1e-12)
            out += [after.sum(), log_gamma(safe).sum(), (safe * logs).sum(), float((after <= 1e-9).sum())]
        return np.array(out)

    def fit(whole, ends, fitted):
        return k * (log_gamma(np.array([whole]))[0] - ends) + fitted

    start, rest = fit(prior, ends, fitted), cells - float(log_gamma(totals).sum())
    tried = _summed(topics, parts, 4 * len(_HALVINGS)).reshape(-1, 4)
    fits = [fit(*row[:3]) if row[3] == 0 and row[0] > 0 else -np.inf for row in tried]
    best = int(np.argmax(fits))
    if not fits[best] > start:
        return topics, prior, rest + start
    chosen = _HALVINGS[best]

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                eta = batch.column(1).to_numpy()
                _, slope, own = _slopes(eta, batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1), spent, prior)
                columns = [batch.column(0), pa.array(eta - chosen * (slope - middle) / own), batch.column(2), batch.column(3)]
                yield pa.RecordBatch.from_arrays(columns, names=["term_id", "eta", "weights", "held"])

    columns, schema = topics.select("term_id", "eta", "weights", "held"), "term_id long, eta double, weights array<double>, held double"
    return columns.mapInArrow(move, schema), float(tried[best][0]), rest + fits[best]


def _totals(topics: DataFrame, k: int) -> tuple[np.ndarray, float]:
    row = topics.agg(*[F.sum(F.col("weights")[i]) for i in range(k)], F.sum("eta")).first()
    return np.array(row[:k], np.float64), float(row[k])


def first_topics(terms: DataFrame, k: int, seed: int) -> DataFrame:
    """Word sums to start from: near 1, by hash of term, topic and seed, so that they don't depend on partitions."""
    part = lambda i: F.pmod(F.xxhash64("term", F.lit(i), F.lit(seed)), F.lit(1 << 20)) / float(1 << 20)
    prior = F.lit(1.0 / k)
    return terms.select("term_id", prior.alias("eta"), prior.alias("held"), F.array(*[part(i) + 0.5 for i in range(k)]).alias("weights"))


def fit(
    tokenised: DataFrame, k: int, passes: int = 15, seed: int = 42, min_documents: int = 3, max_share: float = 0.6,
    block_terms: int = BLOCK_TERMS,
) -> TopicModel:
    """Topics of `tokenised` rows, whose `tokens` are arrays of words; other columns stay with the documents.

    Both priors start at 1/k.  Rows without a known word have the prior as their weights.
    """
    rows = stored(tokenised.withColumn("_row", F.monotonically_increasing_id()), "topic-documents")
    vocabulary = build_vocabulary(rows, min_documents, max_share).withColumn("_rare", -F.col("documents"))
    terms = stored(numbered(vocabulary, ["_rare", "term"], "term_id").drop("_rare"), "topic-terms")
    if terms.isEmpty():
        raise ValueError("no term is in enough documents")
    dealt, groups, blocks = bags(rows.select("_row", "tokens"), terms, block_terms)
    documents = stored_buckets(dealt.groupBy("_group").applyInArrow(_pack, _PACKED), "topic-bags", "_group", groups)
    needed = stored(_needed(documents), "topic-needs")
    slots = [work_name("topic-slot") for _ in range(2)]
    topics = stored(first_topics(terms, k, seed), "topic-words", slots[1])
    alpha, bounds, result = np.full(k, 1.0 / k), [], None
    totals, prior = _totals(topics, k)
    topic_bound = None  # not that of the starting weights, which no prior explains
    for turn in range(passes):
        slot = slots[turn % 2]
        result = _pass(documents, needed, topics, result, k, alpha, totals, slot)
        sums = result.where(F.col("kind") == _SUMS).agg(*[F.sum(F.col("vec")[i]) for i in range(2 * k + 2)]).first()
        if topic_bound is not None:
            bounds.append(float(sums[1]) + topic_bound)
        alpha = dirichlet_prior(alpha, np.array(sums[2 : 2 + k], np.float64), float(sums[0]))
        totals = prior + np.array(sums[2 + k :], np.float64)
        topics, prior, topic_bound = _word_prior(stored(_maximised(result, topics, k), "topic-words", slot), totals, prior)
    topics = stored(topics, "topic-words")
    last = _pass(documents, needed, topics, result, k, alpha, totals, work_name("topic-slot"))
    weights = last.where(F.col("kind") == _DOCUMENT).select(F.col("id").alias("_row"), F.col("vec").alias("gamma"))
    placed = rows.drop("tokens").join(dealt.drop("_group").join(weights, "_row"), "_row")
    return TopicModel(k, terms, topics, stored(placed, "topic-placed"), alpha, totals, bounds)


def _maximised(result: DataFrame, topics: DataFrame, k: int) -> DataFrame:
    """The next topic table: the prior of each term plus the sums of all blocks."""
    given = result.where(F.col("kind") == _TERM).select(F.col("id").alias("term_id"), "vec", F.lit(None).cast("double").alias("eta"))
    start = topics.select("term_id", F.array_repeat("eta", k).alias("vec"), "eta")
    both = given.unionByName(start).groupBy("term_id")
    return both.agg(F.max("eta").alias("eta"), F.max("eta").alias("held"), F.array(*[F.sum(F.col("vec")[i]) for i in range(k)]).alias("weights"))


def shares(model: TopicModel) -> DataFrame:
    """(term_id, term, topic_id, weight): every word's share of every topic."""
    total = F.array(*[F.lit(float(x)) for x in model.totals])
    named = model.topics.join(model.terms.select("term_id", "term"), "term_id")
    return named.select("term_id", "term", F.posexplode(F.zip_with("weights", total, lambda a, b: a / b)).alias("topic_id", "weight"))


def document_topics(model: TopicModel) -> DataFrame:
    """Every document with `topics`, its share of each."""
    own = F.aggregate("gamma", F.lit(0.0), lambda a, x: a + x)
    return model.documents.withColumn("topics", F.transform("gamma", lambda x: x / own)).drop("terms", "counts", "gamma", "_block", "_row")
