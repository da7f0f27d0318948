"""Language of mixed text: script ranges narrow the candidates, Viterbi over words labels spans.

A model holds, for each language, the share of each script among its letters and log frequencies of hashed
character n-grams of words. A word's candidates are the languages that use its script; its score
for each of them is the mean log frequency of its n-grams. The best path through all words of a text, with a
penalty for each change of language, labels its spans; the language with most letters is the text's.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import column, in_groups, map_batches, texts

# Documents that the model is fitted on, at most (expected number; the largest languages decide).
TRAINING_DOCS = 20_000
BUCKETS = 1 << 16
GRAMS = (2, 3, 4)
SWITCH_PENALTY = 6.0
# A language uses a script if at least this share of its letters is in it.
SCRIPT_SHARE = 0.001
UNDETERMINED = "und"
REMEMBERED_WORDS = 400_000

# First and last code points of the letters of scripts, from Unicode's blocks.
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "kana": [(0x3040, 0x30FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF)],
    "hangul": [(0xAC00, 0xD7AF), (0x1100, 0x11FF)],
}
OTHER = len(SCRIPTS)
WORD = re.compile(r"[^\W\d_]+")

_table = np.full(0x110000, OTHER, np.int8)
for _i, _ranges in enumerate(SCRIPTS.values()):
    for _a, _b in _ranges:
        _table[_a : _b + 1] = _i


def words(text: str) -> list[str]:
    """Runs of word characters but digits that hold a letter; fractions, Roman numerals and the like are none."""
    return [w for w in WORD.findall(text.lower()) if w.isalpha() or any(map(str.isalpha, w))]


def grams(batch: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, bucket) of the n-grams of each word, with marks around it, and the script of each word.

    A word's script is that of its first letter with a known one.
    """
    marked = [f"<{w}>" for w in batch]
    codes = np.frombuffer("".join(marked).encode("utf-32-le"), "<u4").astype(np.int64)
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(batch)), sizes)
    letters = _table[codes]
    letters[ends - 1] = letters[ends - sizes] = OTHER
    script = np.full(len(batch), OTHER, np.int8)
    known = np.flatnonzero(letters != OTHER)[::-1]
    script[owner[known]] = letters[known]
    owners, buckets = [], []
    for n in GRAMS:
        if len(codes) < n:
            continue
        last = len(codes) - n + 1
        h = np.full(last, n, np.uint64)
        with np.errstate(over="ignore"):
            for j in range(n):
                h = (h ^ codes[j : j + last].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
        inside = np.flatnonzero(owner[:last] == owner[n - 1 :])
        owners.append(owner[inside])
        buckets.append((h[inside] % np.uint64(BUCKETS)).astype(np.int64))
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *owners]), np.concatenate([none, *buckets]), script


@dataclass
class Model:
    """``log_freq``: languages by buckets; ``uses``: scripts by languages, whether a language is a candidate."""

    languages: list[str]
    log_freq: np.ndarray
    uses: np.ndarray


def fit(docs: DataFrame, most: int = TRAINING_DOCS) -> Model:
    """A model from the rows of ``docs`` (text, lang) with a language.

    About ``most`` rows are taken, by a hash of their text: this documented bound keeps the fit as small for
    any table. Counts are summed in Spark; languages * buckets numbers reach the driver, whatever the
    number of rows. The same word is counted once a document.
    """
    labelled = docs.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")
    n = labelled.count()
    share = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < int((1 << 20) * min(1.0, most / max(n, 1)))
    sample = labelled.where(share) if n > most else labelled

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        total: dict[str, np.ndarray] = {}
        for lang, text in zip(column(batch, "lang").to_pylist(), column(batch, "text").to_pylist()):
            found = list(set(words(text)))
            if not found:
                continue
            owner, bucket, script = grams(found)
            counts = total.setdefault(lang, np.zeros(BUCKETS + OTHER + 1, np.int64))
            counts[:BUCKETS] += np.bincount(bucket, minlength=BUCKETS)
            counts[BUCKETS:] += np.bincount(script, minlength=OTHER + 1)
        rows = [(lang, i, c[i]) for lang, c in total.items() for i in np.flatnonzero(c).tolist()]
        langs, places, counts = zip(*rows) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(places, pa.int32()), pa.array(counts, pa.int64())], ["lang", "place", "n"]
        )

    counted = map_batches(sample, work, "lang string, place int, n bigint").groupBy("lang", "place").agg(F.sum("n").alias("n"))
    got = counted.toPandas()
    languages = sorted(got["lang"].unique())
    table = np.zeros((len(languages), BUCKETS + OTHER + 1))
    table[got["lang"].map({x: i for i, x in enumerate(languages)}).astype(int), got["place"]] = got["n"]
    grams_of, scripts_of = table[:, :BUCKETS], table[:, BUCKETS:]
    log_freq = np.log((grams_of + 0.5) / (grams_of.sum(1, keepdims=True) + 0.5 * BUCKETS))
    uses = (scripts_of >= SCRIPT_SHARE * scripts_of.sum(1, keepdims=True)).T
    uses[~uses.any(1)] = True
    return Model(languages, log_freq.T.astype(np.float32).copy(), uses)


def score_words(model: Model, batch: list[str]) -> np.ndarray:
    """Words by languages: log score, minus infinity for languages that do not use the word's script.

    A word's score is the sum over its n-grams, divided by the number of sizes, so long words weigh more.
    """
    owner, bucket, script = grams(batch)
    out = np.zeros((len(batch), len(model.languages)), np.float32)
    for lang in range(len(model.languages)):
        out[:, lang] = np.bincount(owner, model.log_freq[bucket, lang], len(batch)) / len(GRAMS)
    out -= out.max(1, keepdims=True)
    out[~model.uses[script]] = -np.inf
    return out


def viterbi(scores: np.ndarray, sizes: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of each word of many texts at once; ``sizes`` are their numbers of words.

    Texts go by length, so at each step those still running are a prefix of the rows.
    """
    order = np.argsort(-sizes, kind="stable")
    begins = (np.cumsum(sizes) - sizes)[order]
    sorted_sizes = sizes[order]
    longest = int(sorted_sizes[0]) if len(sizes) else 0
    running = np.searchsorted(-sorted_sizes, -np.arange(longest), "left")
    stay = np.zeros(scores.shape, bool)
    came = np.zeros(len(scores), np.int16)
    labels = np.zeros(len(scores), np.int16)
    state = np.zeros((len(sizes), scores.shape[1]), np.float32)
    for t in range(longest):
        n = running[t]
        at = begins[:n] + t
        now = state[:n]
        best = now.argmax(1)
        switched = now[np.arange(n), best] - penalty
        keep = now >= switched[:, None]
        stay[at], came[at] = keep, best
        state[:n] = np.where(keep, now, switched[:, None]) + scores[at]
        if t % 64 == 63:
            state[:n] -= state[:n].max(1, keepdims=True)
    final = state.argmax(1)
    for t in range(longest - 1, -1, -1):
        n = running[t]
        at = begins[:n] + t
        label = final[:n]
        labels[at] = label
        final[:n] = np.where(stay[at, label], label, came[at])
    return labels


class Labeller:
    """The model with a memory of words."""

    def __init__(self, model: Model, penalty: float):
        self.model, self.penalty = model, penalty
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.scores = np.zeros((0, len(self.model.languages)), np.float32)
        self.letters = np.zeros(0, np.int64)

    def label(self, batch: list[str]) -> list[tuple[list[str], np.ndarray, np.ndarray, np.ndarray]]:
        """For each text its words, their labels, scores and numbers of letters."""
        if len(self.place) > REMEMBERED_WORDS:
            self._forget()
        split = [words(t) for t in batch]
        new = list({w for ws in split for w in ws if w not in self.place})
        if new:
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
            self.scores = np.concatenate([self.scores, score_words(self.model, new)])
            self.letters = np.concatenate([self.letters, np.fromiter(map(len, new), np.int64, len(new))])
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        get = self.place.__getitem__
        at = np.fromiter((i for ws in split for i in map(get, ws)), np.int64, int(sizes.sum()))
        scores = self.scores[at]
        labels = viterbi(scores, sizes, self.penalty)
        cuts = np.cumsum(sizes)[:-1]
        return list(zip(split, np.split(labels, cuts), np.split(scores, cuts), np.split(self.letters[at], cuts)))


_labellers: dict[str, Labeller] = {}


def identify(docs: DataFrame, model: Model, penalty: float = SWITCH_PENALTY, with_spans: bool = False) -> DataFrame:
    """doc_id, lang_pred, score of every row, and with ``with_spans`` spans (lang, first word, word after the last).

    The score is the share of the text's letters in spans of the predicted language. Null texts, texts without
    a letter and all texts under a model without languages are ``und`` with score 0 and no spans. Ties go
    to the language that sorts first. Repeated rows stay; other columns are not looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    number = uuid.uuid4().hex

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = shared.value
        if number not in _labellers:
            _labellers.clear()
            _labellers[number] = Labeller(model, penalty)
        own, langs, scores, spans = _labellers[number], [], [], []
        for group in in_groups(column(batch, "text").to_pylist()):
            found = own.label(group) if model.languages else [([], None, None, None)] * len(group)
            for ws, labels, _, letters in found:
                if not ws:
                    langs.append(UNDETERMINED)
                    scores.append(0.0)
                    spans.append([])
                    continue
                share = np.bincount(labels, letters, len(model.languages))
                best = int(share.argmax())
                langs.append(model.languages[best])
                scores.append(float(share[best] / share.sum()))
                if with_spans:
                    cuts = [0, *(np.flatnonzero(np.diff(labels)) + 1).tolist(), len(ws)]
                    spans.append([{"lang": model.languages[labels[a]], "first": a, "last": b} for a, b in zip(cuts, cuts[1:])])
        out = {"doc_id": column(batch, "doc_id"), "lang_pred": pa.array(langs, pa.string()), "score": pa.array(scores, pa.float64())}
        if with_spans:
            out["spans"] = pa.array(spans, pa.list_(pa.struct([("lang", pa.string()), ("first", pa.int32()), ("last", pa.int32())])))
        return pa.RecordBatch.from_pydict(out)

    rows = texts(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()
    more = ", spans array<struct<lang:string,first:int,last:int>>" * with_spans
    return map_batches(rows, work, f"doc_id {kind}, lang_pred string, score double{more}")
