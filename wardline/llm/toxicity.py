"""Toxicity by weak supervision.

Terms (hashed words and word beginnings) that go with toxic labels in a bounded sample of labelled rows
become many small lexicon voters; a few patterns of the text are voters too. A generative label model,
estimated without labels from how the voters of all documents agree, gives each voter's accuracy and the
pairs that agree more than their accuracies explain. Its posterior labels train a linear classifier
over the terms.
"""

from __future__ import annotations

import re
import uuid
import zlib
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import column, in_groups, map_batches, store, texts

# Labelled documents that terms and weights are fitted on, at most (expected number).
TRAINING_DOCS = 20_000
# Counters of the first count, which only narrows the terms down.
BUCKETS = 1 << 20
BEGINNINGS = (4, 5, 6, 7)
# Terms that become lexicon entries: at most so many, in so many labelled documents at least.
TERMS = 4096
LEAST_DOCS = 4
# Share of toxic documents among those that hold the term.
LEAST_RATE = 0.65
# Log likelihood gain that a term of BUCKETS reaches by chance about once.
LEAST_GAIN = float(np.log(BUCKETS))
LEXICONS = 30
SIGNATURES = 4
# Log odds of a given label: right in 999 of 1000 cases.
LABEL_ODDS = 7.0
REMEMBERED_WORDS = 300_000

WORD = re.compile(r"[^\W\d_]+")
PATTERNS = (
    lambda text: text.isupper(),
    lambda text: text.count("!") >= 3,
    lambda text: "***" in text or "@#" in text or "#$" in text,
)
VOTERS = LEXICONS + len(PATTERNS)


def term_hashes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(owner, 64-bit hash) of the terms of each word: the word, and its beginnings if it is longer than they are."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.uint64)
    begin = np.cumsum(sizes) - sizes
    h = np.full(len(words), 7, np.uint64)
    owners, hashes = [], []
    left = np.flatnonzero(sizes > 0)

    def add(at: np.ndarray, kind: int) -> None:
        mixed = (h[at] ^ np.uint64(kind * 0x51ED)) * np.uint64(0xBF58476D1CE4E5B9)
        owners.append(at)
        hashes.append((mixed ^ (mixed >> np.uint64(32))).view(np.int64))

    with np.errstate(over="ignore"):
        for j in range(int(sizes.max(initial=0))):
            h[left] = (h[left] ^ codes[begin[left] + j]) * np.uint64(0x9E3779B97F4A7C15)
            h[left] ^= h[left] >> np.uint64(29)
            done = sizes[left] == j + 1
            add(left[done], 0)
            left = left[~done]
            if j + 1 in BEGINNINGS:
                add(left, j + 1)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *owners]), np.concatenate([none, *hashes])


def bucket_of(hashes: np.ndarray) -> np.ndarray:
    return hashes & (BUCKETS - 1)


class AllTerms:
    """The hashes of all terms of texts."""

    def __init__(self):
        self.known: dict[str, np.ndarray] = {}

    def of(self, text: str) -> np.ndarray:
        ws = set(WORD.findall(text.lower()))
        if len(self.known) > REMEMBERED_WORDS // 4:
            self.known = {}
        new = [w for w in ws if w not in self.known]
        if new:
            owner, hashes = term_hashes(new)
            order = np.argsort(owner, kind="stable")
            parts = np.split(hashes[order], np.searchsorted(owner[order], np.arange(1, len(new))))
            self.known.update(zip(new, parts))
        return np.unique(np.concatenate([np.zeros(0, np.int64), *[self.known[w] for w in ws]]))


class Terms:
    """Chosen terms in texts, with a memory of words: most words hold none."""

    def __init__(self, chosen: np.ndarray):
        self.order = np.argsort(chosen, kind="stable")
        self.sorted = chosen[self.order]
        self.known: dict[str, tuple[int, ...]] = {}

    def number(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each term among the chosen ones, or -1."""
        if not len(self.sorted):
            return np.full(len(hashes), -1)
        place = np.minimum(np.searchsorted(self.sorted, hashes), len(self.sorted) - 1)
        return np.where(self.sorted[place] == hashes, self.order[place], -1)

    def of(self, batch: list[str]) -> list[list[int]]:
        """Distinct terms of each text, in ascending order."""
        return [sorted({t for w in hits for t in self.known[w]}) for hits in self.words(batch)]

    def words(self, batch: list[str]) -> list[list[str]]:
        """Distinct words of each text that hold chosen terms."""
        if len(self.known) > REMEMBERED_WORDS:
            self.known = {}
        split = [set(WORD.findall(t.lower())) for t in batch]
        known = self.known
        new = list({w for ws in split for w in ws if w not in known})
        if new:
            owner, hashes = term_hashes(new)
            number = self.number(hashes)
            keep = number >= 0
            known.update(dict.fromkeys(new, ()))
            for w, t in zip(owner[keep].tolist(), number[keep].tolist()):
                known[new[w]] += (t,)
        return [[w for w in ws if known[w]] for ws in split]

    def votes(self, batch: list[str]) -> tuple[list[list[int]], np.ndarray]:
        """Terms of each text, and texts by voters, 1 where a voter fires.

        Words are dealt to lexicons by their beginning, so all forms of a word are with one voter. A
        voter that does not fire abstains.
        """
        terms, out = [], np.zeros((len(batch), VOTERS))
        for i, (text, hits) in enumerate(zip(batch, self.words(batch))):
            terms.append(sorted({t for w in hits for t in self.known[w]}))
            out[i, [zlib.crc32(w[:3].encode()) % LEXICONS for w in hits]] = 1
            out[i, LEXICONS:] = [p(text) for p in PATTERNS]
        return terms, out


@dataclass
class LabelModel:
    """Rates at which each voter fires on toxic and on clean texts, and how much of its vote counts."""

    prior: float
    on_toxic: np.ndarray
    on_clean: np.ndarray
    weight: np.ndarray
    correlated: np.ndarray = field(repr=False)

    def log_odds(self, votes: np.ndarray) -> np.ndarray:
        fires = np.log(self.on_toxic / self.on_clean)
        return np.log(self.prior / (1 - self.prior)) + votes @ (self.weight * fires)


def _accuracy(cov: np.ndarray, fit: np.ndarray, i: int, spread: float) -> float:
    """Of voter i, the median over all pairs of other voters that fit with it and each other; 0 without any."""
    v = len(cov)
    found = [cov[i, j] * cov[i, k] / cov[j, k] for j in range(v) for k in range(j + 1, v) if i not in (j, k) and fit[i, j] and fit[i, k] and fit[j, k]]
    return float(np.sqrt(max(np.median(found), 0) / spread)) if found else 0.0


def fit_label_model(n: float, fired: np.ndarray, together: np.ndarray, prior: float) -> LabelModel:
    """From n texts, how often each voter fired and each pair fired together.

    If voters are independent given the class, the covariance of a pair is prior * (1 - prior) times the
    product of both accuracies (the difference of firing rates on toxic and clean texts), so three
    voters give the accuracy of one of them; the median over all threes is taken. A pair whose covariance is
    well above that product is correlated, and both share their weight.
    """
    mean = fired / max(n, 1)
    cov = together / max(n, 1) - np.outer(mean, mean)
    v = len(mean)
    spread = max(prior * (1 - prior), 1e-6)
    variance = np.maximum(mean * (1 - mean), 1e-12)
    scale = np.sqrt(np.outer(variance, variance))
    sure = cov > 3 * scale / np.sqrt(max(n, 1))
    # Near copies of a voter first; then, in turn, accuracies without the correlated pairs, and the pairs anew.
    correlated = cov > 0.8 * scale
    np.fill_diagonal(correlated, False)
    most = np.minimum(mean / max(prior, 1e-6), (1 - mean) / max(1 - prior, 1e-6))
    for _ in range(5):
        fit = sure & ~correlated
        accuracy = np.array([_accuracy(cov, fit, i, spread) for i in range(v)])
        accuracy = np.minimum(accuracy, most)
        excess = sure & (cov - spread * np.outer(accuracy, accuracy) > 0.25 * scale)
        np.fill_diagonal(excess, False)
        if (excess | correlated == correlated).all():
            break
        correlated |= excess
    low, high = 1e-4, 1 - 1e-4
    return LabelModel(
        prior,
        np.clip(mean + (1 - prior) * accuracy, low, high),
        np.clip(mean - prior * accuracy, low, high),
        1 / (1 + correlated.sum(1)),
        correlated,
    )


@dataclass
class Classifier:
    chosen: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, terms: list[list[int]]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.array([self.weights[t].sum() + self.bias for t in terms])))


def train(terms: list[list[int]], target: np.ndarray, n_terms: int, rounds: int = 600, ridge: float = 1e-5) -> tuple[np.ndarray, float]:
    """Logistic regression on soft targets, by gradient steps with momentum."""
    rows = np.repeat(np.arange(len(terms)), [len(t) for t in terms])
    cols = np.array([t for ts in terms for t in ts], np.int64)
    w, b = np.zeros(n_terms), float(np.log((target.mean() + 1e-3) / (1 - target.mean() + 1e-3)))
    m, s, mb, sb = np.zeros(n_terms), np.zeros(n_terms), 0.0, 0.0
    for step in range(1, rounds + 1):
        z = b + np.bincount(rows, w[cols], len(terms))
        error = (1 / (1 + np.exp(-z)) - target) / len(terms)
        g, gb = np.bincount(cols, error[rows], n_terms) + ridge * w, error.sum()
        m, s, mb, sb = 0.9 * m + 0.1 * g, 0.99 * s + 0.01 * g * g, 0.9 * mb + 0.1 * gb, 0.99 * sb + 0.01 * gb * gb
        fix, fix2 = 1 - 0.9**step, 1 - 0.99**step
        w -= 0.1 * (m / fix) / (np.sqrt(s / fix2) + 1e-9)
        b -= 0.1 * (mb / fix) / (np.sqrt(sb / fix2) + 1e-9)
    return w, b


def gains(positive: np.ndarray, negative: np.ndarray, n_positive: int, n_negative: int) -> tuple[np.ndarray, np.ndarray]:
    """Rate of toxic documents among those with each term, and the log likelihood of its counts at that rate over the common one."""
    prior = min(max(n_positive / max(1, n_positive + n_negative), 1e-6), 1 - 1e-6)
    rate = np.clip(positive / np.maximum(positive + negative, 1), 1e-9, 1 - 1e-9)
    return rate, positive * np.log(rate / prior) + negative * np.log((1 - rate) / (1 - prior))


def signatures(text: str) -> list[int]:
    """Smallest hashes of a text's runs of three words, under ``SIGNATURES`` hash functions; copies share most of them."""
    ws = text.lower().split()
    codes = np.fromiter((zlib.crc32(w.encode()) for w in ws), np.uint64, len(ws))
    if len(codes) < 3:
        return [zlib.crc32(text.encode())] * SIGNATURES
    with np.errstate(over="ignore"):
        runs = (codes[:-2] * np.uint64(0x9E3779B1) + codes[1:-1]) * np.uint64(0x85EBCA6B) + codes[2:]
        return [int(((runs ^ np.uint64(k)) * np.uint64(0xBF58476D1CE4E5B9 + 2 * k) >> np.uint64(1)).min()) for k in range(SIGNATURES)]


def one_of_copies(sample: DataFrame) -> DataFrame:
    """doc_id and _toxic of one document of each group of copies in the sample.

    A toxic text's words would else count once for each of its copies and pass for toxic terms.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([signatures(t) for t in column(batch, "text").to_pylist()], np.int64)
        out = {"doc_id": column(batch, "doc_id"), "_toxic": column(batch, "_toxic")}
        return pa.RecordBatch.from_pydict(out | {f"s{k}": pa.array(found[:, k]) for k in range(SIGNATURES)})

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sample.select("doc_id", "_toxic").schema)
    rows = map_batches(sample, work, kinds + "".join(f", s{k} bigint" for k in range(SIGNATURES)))
    for k in range(SIGNATURES):
        names = [c for c in rows.columns if c != f"s{k}"]
        rows = rows.groupBy(f"s{k}").agg(F.min(F.struct(*names)).alias("r")).select("r.*")
    return rows.dropDuplicates(["doc_id"])


def fit(docs: DataFrame, labels: DataFrame, most: int = TRAINING_DOCS) -> Classifier:
    """A classifier from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic); pass only rows that may be learnt from.

    Terms and weights come from about ``most`` labelled documents, chosen by a hash of the id; the
    voters' agreement is counted over every row of ``docs``. Labels that contradict each other count as toxic.
    Without toxic labels nothing is learnt and every score is small.
    """
    spark = docs.sparkSession
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("_toxic"))
    n = known.count()
    # The bound on the rows makes the broadcast small.
    few = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int((1 << 20) * min(1.0, most / max(n, 1)))) if n > most else known
    few = store(one_of_copies(texts(docs).join(F.broadcast(few), "doc_id")), "toxicity-sample")
    sample = texts(docs).join(F.broadcast(few), "doc_id")

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        total = np.zeros((2, BUCKETS + 1), np.int64)
        for y, text in zip(column(batch, "_toxic").to_pylist(), column(batch, "text").to_pylist()):
            total[int(y > 0), np.unique(bucket_of(_all_terms.of(text)))] += 1
            total[int(y > 0), BUCKETS] += 1
        place = np.flatnonzero(total.any(0))
        return pa.RecordBatch.from_pydict({"place": pa.array(place, pa.int64()), "toxic": pa.array(total[1, place]), "clean": pa.array(total[0, place])})

    def summed(work) -> pd.DataFrame:
        both = map_batches(sample, work, "place bigint, toxic bigint, clean bigint").groupBy("place")
        return both.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where("toxic > 0").toPandas()

    got = summed(count)
    of_all = got["place"] == BUCKETS
    n_toxic = int(got.loc[of_all, "toxic"].sum())
    n_clean = int(got.loc[of_all, "clean"].sum())
    rate, gain = gains(got["toxic"].to_numpy(), got["clean"].to_numpy(), n_toxic, n_clean)
    busy = np.zeros(BUCKETS + 1, bool)
    busy[got["place"][(rate > 0.2) & (gain > LEAST_GAIN / 2) & (got["toxic"] >= LEAST_DOCS)]] = True
    busy[BUCKETS] = False
    narrowed = spark.sparkContext.broadcast(np.packbits(busy))

    def exact(batch: pa.RecordBatch) -> pa.RecordBatch:
        busy, total = np.unpackbits(narrowed.value).astype(bool), {}
        for y, text in zip(column(batch, "_toxic").to_pylist(), column(batch, "text").to_pylist()):
            found = _all_terms.of(text)
            for h in found[busy[bucket_of(found)]].tolist():
                total.setdefault(h, [0, 0])[int(y > 0)] += 1
        return pa.RecordBatch.from_pydict({"place": pa.array(total, pa.int64()), "toxic": pa.array([t for _, t in total.values()], pa.int64()), "clean": pa.array([c for c, _ in total.values()], pa.int64())})

    got = summed(exact).sort_values("place")
    rate, gain = gains(got["toxic"].to_numpy(), got["clean"].to_numpy(), n_toxic, n_clean)
    # A term must be in enough toxic documents, and go with toxicity more than the best of all terms does by luck.
    ok = np.flatnonzero((got["toxic"].to_numpy() >= LEAST_DOCS) & (rate > LEAST_RATE) & (gain > LEAST_GAIN))
    chosen = got["place"].to_numpy(np.int64)[ok[np.argsort(-gain[ok], kind="stable")[:TERMS]]]
    if not len(chosen):
        return Classifier(chosen, np.zeros(0), -4.0)
    shared, number = spark.sparkContext.broadcast(chosen), uuid.uuid4().hex

    def agree(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, fired, together = 0, np.zeros(VOTERS), np.zeros((VOTERS, VOTERS))
        for group in in_groups(column(batch, "text").to_pylist()):
            _, v = _terms(number, shared.value).votes(group)
            n, fired, together = n + len(group), fired + v.sum(0), together + v.T @ v
        flat = np.concatenate([[n], fired, together.ravel()]).astype(np.int64)
        return pa.RecordBatch.from_pydict({"place": pa.array(np.arange(len(flat)), pa.int32()), "n": pa.array(flat)})

    sums = map_batches(texts(docs), agree, "place int, n bigint").groupBy("place").agg(F.sum("n").alias("n")).toPandas().sort_values("place")["n"].to_numpy()
    model = fit_label_model(float(sums[0]), sums[1 : VOTERS + 1].astype(float), sums[VOTERS + 1 :].reshape(VOTERS, VOTERS).astype(float), n_toxic / max(1, n_toxic + n_clean))

    def examples(batch: pa.RecordBatch) -> pa.RecordBatch:
        out_terms, out_odds = [], []
        for group in in_groups(column(batch, "text").to_pylist()):
            terms, v = _terms(number, shared.value).votes(group)
            out_terms += terms
            out_odds += model.log_odds(v).tolist()
        return pa.RecordBatch.from_pydict({"doc_id": column(batch, "doc_id"), "toxic": column(batch, "_toxic").cast(pa.int32()), "terms": pa.array(out_terms, pa.list_(pa.int32())), "odds": pa.array(out_odds, pa.float64())})

    kind = sample.schema["doc_id"].dataType.simpleString()
    rows: pd.DataFrame = map_batches(sample, examples, f"doc_id {kind}, toxic int, terms array<int>, odds double").dropDuplicates(["doc_id"]).toPandas()
    # The label itself is one more voter, of known accuracy.
    odds = rows["odds"].to_numpy() + np.where(rows["toxic"] > 0, LABEL_ODDS, -LABEL_ODDS)
    target = 1 / (1 + np.exp(-odds))
    order = np.argsort(rows["doc_id"].to_numpy(), kind="stable")
    terms = [list(t) for t in rows["terms"]]
    weights, bias = train([terms[i] for i in order], target[order], len(chosen))
    return Classifier(chosen, weights, bias)


_all_terms = AllTerms()
_known_terms: dict[str, Terms] = {}


def _terms(number: str, chosen: np.ndarray) -> Terms:
    if number not in _known_terms:
        _known_terms.clear()
        _known_terms[number] = Terms(chosen)
    return _known_terms[number]


def score(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """doc_id and score of every row; null and empty texts get the score of a text without terms.

    Repeated rows stay repeated; columns other than doc_id and text are not looked at.
    """
    shared, number = docs.sparkSession.sparkContext.broadcast(classifier), uuid.uuid4().hex

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        own, out = shared.value, []
        for group in in_groups(column(batch, "text").to_pylist()):
            out += own.scores(_terms(number, own.chosen).of(group)).tolist()
        return pa.RecordBatch.from_pydict({"doc_id": column(batch, "doc_id"), "score": pa.array(out, pa.float64())})

    rows = texts(docs)
    return map_batches(rows, work, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")
