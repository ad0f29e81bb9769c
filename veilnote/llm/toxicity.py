"""Toxicity by gradient-boosted trees over dense features of whole texts, with isotonic calibration."""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilnote.llm.boosting import Boosted, calibrated, fit, isotonic
from veilnote.llm.bytewords import LETTERS, LOWER, hash_words, slices, utf8, words
from veilnote.llm.common import map_batches, written

#: Labelled rows that the lexicon, the trees and the calibration are fitted on, at most; the rows with the smallest
#: hashes of their ids are taken. Entries of each learned lexicon, at most; documents that an entry must occur in.
SAMPLE, ENTRIES, LEAST_DOCS = 20_000, 4_000, 3
#: Leading bytes that stand for a word's stem; parts of the sample for cross-fitting, with their columns of counts.
STEMS = (4, 5, 6)
FOLDS = 3
COUNTS = [f"n{k}" for k in range(2 * FOLDS)]

# Words to start from, and words of the second person in the four languages of the corpus.
INSULTS = ("idiot", "stupid", "moron", "loser", "scum", "trash", "garbage", "pathetic", "worthless", "disgusting", "clown",
           "dumb", "ugly", "hate", "idiota", "basura", "asco", "imbécile", "ordure", "dégoûtant", "abschaum", "dumm", "müll")
SECOND_PERSON = ("you", "your", "yours", "yourself", "u", "ur", "tu", "te", "toi", "ton", "ta", "tes", "vous", "votre", "vos",
                 "usted", "ustedes", "tú", "ti", "tus", "du", "dich", "dir", "dein", "deine", "ihr", "euch", "euer", "sie")

FEATURES = ("insults_per_word", "insults", "learned_words_per_word", "learned_words", "learned_stems_per_word", "learned_stems",
            "second_person_per_word", "insult_near_second_person", "learned_near_second_person", "capitals", "capital_words",
            "exclamations", "questions", "punctuation", "obfuscated_words", "obfuscated_insults", "longest_repeat", "log_words")

#: Digits and signs that stand for letters in obfuscated words.
_READ = LOWER.copy()
_READ[[ord(c) for c in "013457@$!|"]] = [ord(c) for c in "oieastasii"]
_SIGNS = np.zeros(256, bool)
_SIGNS[[ord(c) for c in "0123456789@$!|*#"]] = True
#: Words may hold the signs that hide letters.
_HIDING = LETTERS | _SIGNS
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_ALPHA = LETTERS.copy()
_ALPHA[48:58] = False


def word_hashes(listed: tuple[str, ...]) -> np.ndarray:
    data, offsets = utf8(pa.array(listed))
    return np.unique(hash_words(data, offsets[:-1], offsets[1:]))


@dataclass
class Lexicon:
    """Sorted hashes of words, and of stems by their length."""

    words: np.ndarray
    stems: dict[int, np.ndarray]


def _in(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(hashes), bool)
    return known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] == hashes


def _near(flags: np.ndarray, other: np.ndarray, doc: np.ndarray, reach: int = 3) -> np.ndarray:
    """Flags with another flag within `reach` words of the same document."""
    out = np.zeros(len(flags), bool)
    for k in range(1, reach + 1):
        same = doc[k:] == doc[:-k]
        out[k:] |= other[:-k] & same
        out[:-k] |= other[k:] & same
    return out & flags


def features(column: pa.Array, lexicon: Lexicon) -> np.ndarray:
    """A row of FEATURES for each text."""
    insults, persons = word_hashes(INSULTS), word_hashes(SECOND_PERSON)
    data, offsets = utf8(column)
    out = np.zeros((len(offsets) - 1, len(FEATURES)))
    for lo, hi in slices(offsets):
        raw, own = data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        low, n = LOWER[raw], hi - lo
        starts, ends, doc = words(low, own, _HIDING)
        hashes = hash_words(low, starts, ends)
        insult, person, learned = _in(hashes, insults), _in(hashes, persons), _in(hashes, lexicon.words)
        stem = np.zeros(len(hashes), bool)
        for size, known in lexicon.stems.items():
            long = np.flatnonzero(ends - starts > size)
            stem[long] |= _in(hash_words(low, starts[long], starts[long] + size), known)
        signs = np.append(0, np.cumsum(_SIGNS[low]))
        letters = np.append(0, np.cumsum(_ALPHA[low]))
        hidden = (signs[ends] > signs[starts]) & (letters[ends] > letters[starts])
        read = np.flatnonzero(hidden)
        hidden_insult = np.zeros(len(hashes), bool)
        plain = hash_words(_READ[raw], starts[read], ends[read])
        hidden_insult[read] = (_in(plain, insults) | _in(plain, lexicon.words)) & ~insult[read] & ~learned[read]
        upper = np.append(0, np.cumsum((raw >= 65) & (raw <= 90)))
        shouted = (upper[ends] - upper[starts] == ends - starts) & (ends - starts > 1)

        def per_doc(flags: np.ndarray) -> np.ndarray:
            return np.bincount(doc[flags], minlength=n).astype(float)

        def bytes_of(flags: np.ndarray) -> np.ndarray:
            total = np.append(0, np.cumsum(flags))
            return (total[own[1:]] - total[own[:-1]]).astype(float)

        repeat = (raw[2:] == raw[1:-1]) & (raw[1:-1] == raw[:-2]) & ~_SPACE[raw[2:]] if n and len(raw) > 2 else np.zeros(0, bool)
        count, size = np.maximum(np.bincount(doc, minlength=n), 1), np.maximum(np.diff(own), 1)
        columns = (per_doc(insult) / count, per_doc(insult), per_doc(learned) / count, per_doc(learned), per_doc(stem) / count, per_doc(stem),
                   per_doc(person) / count, per_doc(_near(insult, person, doc)) / count, per_doc(_near(learned | stem, person, doc)) / count,
                   bytes_of((raw >= 65) & (raw <= 90)) / size, per_doc(shouted) / count,
                   bytes_of(raw == 33) / size, bytes_of(raw == 63) / size, bytes_of((raw < 128) & ~LETTERS[low] & ~_SPACE[raw]) / size,
                   per_doc(hidden) / count, per_doc(hidden_insult) / count,
                   bytes_of(np.append(repeat, [False] * (len(raw) - len(repeat)))) / size, np.log1p(np.bincount(doc, minlength=n)))
        out[lo:hi] = np.stack(columns, 1)
    return out


def held_out(doc_id: str = "doc_id") -> F.Column:
    """True for rows whose labels nothing may learn from."""
    return F.crc32(F.col(doc_id).cast("string")) % 3 == 1


def training_rows(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """(text, toxic) of a bounded sample of labelled rows that aren't held out."""
    usable = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int")).where(
        F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = written(usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample), "labelled")
    return written(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(F.broadcast(chosen), "doc_id")
                   .select("doc_id", "text", "toxic"), "training")


def learn_lexicons(rows: DataFrame) -> list[Lexicon]:
    """Words and stems that occur in toxic rows much more often than in others, by document counts: for each fold from
    the rows of the others, and last from all rows."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = utf8(batch.column(1))
        group = np.asarray(batch.column(3)).astype(np.int64) * 2 + np.asarray(batch.column(2))
        found: list[list[np.ndarray]] = [[] for _ in range(3)]
        for lo, hi in slices(offsets):
            low, own = LOWER[data[offsets[lo]:offsets[hi]]], offsets[lo:hi + 1] - offsets[lo]
            starts, ends, doc = words(low, own, _HIDING)
            for size in (0, *STEMS):
                long = ends - starts > size
                hashes = hash_words(low, starts[long], starts[long] + size if size else ends[long])
                order = np.lexsort((hashes, doc[long]))
                hashes, owner = hashes[order], doc[long][order]
                new = np.append(True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1]))[:len(hashes)]
                for out, x in zip(found, (np.full(new.sum(), size), hashes[new].view(np.int64), group[lo + owner[new]]), strict=True):
                    out.append(x)
        size, entry, label = (np.concatenate(x).astype(np.int64) for x in found)
        order = np.lexsort((entry, size))
        size, entry, label = size[order], entry[order], label[order]
        new = np.append(True, (size[1:] != size[:-1]) | (entry[1:] != entry[:-1]))[:len(size)]
        at = np.cumsum(new) - 1
        sums = [np.bincount(at[label == k], minlength=int(new.sum())) for k in range(2 * FOLDS)]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (size[new], entry[new], *sums)], ["size", "entry", *COUNTS])

    seen = {(r.toxic, r.fold): r["count"] for r in rows.groupBy("toxic", "fold").count().collect()}
    sums = written(map_batches(rows.select("doc_id", "text", "toxic", "fold"), count,
                               "size long, entry long, " + ", ".join(f"{c} long" for c in COUNTS))
                   .groupBy("size", "entry").agg(*(F.sum(c).alias(c) for c in COUNTS)), "entries")
    out = []
    for left_out in (*range(FOLDS), None):
        folds = [k for k in range(FOLDS) if k != left_out]
        good, bad = (sum((F.col(f"n{2 * k + label}") for k in folds), F.lit(0)) for label in (0, 1))
        goods, bads = (sum(seen.get((label, k), 0) for k in folds) for label in (0, 1))
        ratio = (F.col("bad") / F.lit(bads + 1.0)) / ((F.col("good") + 0.5) / F.lit(goods + 1.0))
        telling = sums.select("size", "entry", bad.alias("bad"), good.alias("good")).where(
            (F.col("bad") >= LEAST_DOCS) & (ratio > 8)).orderBy(F.desc("bad"), "size", "entry").limit(ENTRIES).collect()
        hashes = {size: np.unique(np.array([r.entry for r in telling if r["size"] == size], np.int64).view(np.uint64)) for size in (0, *STEMS)}
        out.append(Lexicon(hashes.pop(0), hashes))
    return out


@dataclass
class Model:
    lexicon: Lexicon
    trees: Boosted
    knots: np.ndarray
    values: np.ndarray

    def score(self, texts: pa.Array) -> np.ndarray:
        return calibrated(self.trees.raw(features(texts, self.lexicon)), self.knots, self.values)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Each training row is measured with the lexicon learned without its fold, so that the trees see hits as they
    are on new texts; the calibration uses scores of trees that haven't seen the row's fold either."""
    rows = training_rows(docs, labels, sample).withColumn("fold", F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int"))
    lexicons = learn_lexicons(rows)

    def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
        folds, x = np.asarray(batch.column(3)), np.zeros((batch.num_rows, len(FEATURES)))
        for k in range(FOLDS):
            if (mine := folds == k).any():
                x[mine] = features(batch.column(1).filter(pa.array(mine)), lexicons[k])
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(FEATURES)), pa.array(x.ravel()))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), lists], ["doc_id", "toxic", "fold", "x"])

    seen = map_batches(rows.select("doc_id", "text", "toxic", "fold"), measure,
                       "doc_id long, toxic int, fold int, x array<double>").orderBy("doc_id", "toxic", "x").collect()
    x = np.array([r.x for r in seen], float).reshape(-1, len(FEATURES))
    y, fold = np.array([r.toxic for r in seen], float), np.array([r.fold for r in seen])
    raw = np.zeros(len(y))
    for k in range(FOLDS):
        raw[fold == k] = fit(x[fold != k], y[fold != k]).raw(x[fold == k])
    return Model(lexicons[-1], fit(x, y), *isotonic(raw, y))


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of each row of docs(doc_id, text): the calibrated chance that the text is toxic.

    Null and empty texts are scored by their features, all zero. Null and repeated ids are rows like any other; extra
    columns are ignored. Scores depend on the text alone.
    """

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(batch.column(1)))], ["doc_id", "score"])

    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), score, "doc_id long, score double")


def judge(docs: DataFrame, labels: DataFrame, limit: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each document, with a model trained from the labels.

    Without usable labels of both kinds each score is the share of toxic rows. held_out is null without an id.
    """
    return score_toxicity(docs, train(docs, labels)).select(
        "doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= limit, 1).otherwise(0).alias("predicted"))


def accepted(docs: DataFrame, model: Model, limit: float = 0.7) -> DataFrame:
    """The rows of docs with a score below the limit, as they are. Null and empty texts have a score like any other."""
    at = docs.columns.index("text")

    def keep(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(model.score(batch.column(at)) < limit))

    return map_batches(docs, keep, docs.schema)
