"""Class-based n-grams: exchange clustering of all words, class transitions and word emissions.

The corpus is encoded once into chunks: each chunk has its own word codes, and each word belongs to one of many shards, by
hash. What chunks and shards tell each other are packed arrays in the order of a chunk's words, so a sweep moves some
bytes for each different word of a chunk and no row for each token:

1. a shard finds its different words over all chunks and numbers those that occur in training texts;
2. a chunk is told the classes of its words and returns, for each word, how often each class follows and precedes it;
3. a shard sums that up over all chunks and moves words to the class that raises the likelihood of the class bigrams most.

A sweep is steps 2 and 3 for all words. All shards move at once against the same class bigrams (CLASSES * CLASSES numbers,
the only thing that goes through the driver), so after the first sweep half of the words may move in each, in turns.
The gain of a frequent word is computed exactly, that of a rare one from the derivative of the likelihood.

Then, with h the class of the token before, c that of word w, and counts of training tokens,

    P(w | h) = P(c | h) * (n(w) - d(c)) / N(c),    P(c | h) = (G(h, c) + WEIGHT * N(c) / N) / (G(h) + WEIGHT),

and what the discounts d(c) leave goes to the unknown word, of which there is one kind, as in the base score; it has at
least its share there. After an unknown word, h is the class that it most likely has there. A text ends with a token of a class of its own, which is also
what stands before its first word.
"""
from __future__ import annotations

import math
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilnote.llm.common import TEXT_ROWS, Scratch, new_path, remove, written

#: Classes (0 is the end's) and sweeps; bytes of text of a chunk and, in the whole, for each shard.
CLASSES, SWEEPS, CHUNK_BYTES, SHARD_BYTES = 64, 4, 4 << 20, 12 << 20
#: Occurrences from which a gain is exact; added to class bigrams in other gains; weight of P(c) in P(c | h).
FREQUENT, ADDED, WEIGHT = 200, 0.5, 32.0

_REPLY = "chunk long, shard int, ids binary, classes binary, counts binary, sums array<long>"
_CONTEXT = "chunk long, shard int, ids binary, classes binary, filled binary, beside binary, times binary, often array<long>, bigrams array<long>"
_SCORE = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def encoded(docs: DataFrame, shards: int) -> DataFrame:
    """For each chunk a row with its texts (shard -1) and a row for each shard with its words there, in order of their
    codes: code 0 is the end, then come the words of shard 0, those of shard 1 and so on."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: defaultdict[bytes, int] = defaultdict(count(1).__next__)
        ids, held, sizes, codes, size, first = [], [], [], [], 0, None

        def chunk() -> pa.RecordBatch:
            found = list(numbers)
            of = np.fromiter((zlib.crc32(w) % shards for w in found), np.int64, len(found))
            order = np.argsort(of, kind="stable")
            code = np.zeros(len(found) + 1, np.int32)
            code[order + 1] = np.arange(1, len(found) + 1)
            train = np.bincount(np.concatenate([[0], *(own for own, out in zip(codes, held, strict=True) if not out)]).astype(np.int64), minlength=len(found) + 1)
            ends, where = np.searchsorted(of[order], np.arange(shards + 1)), []
            words, counts = [None], [None]
            for k in range(shards):
                if ends[k] < ends[k + 1]:
                    own = order[ends[k]:ends[k + 1]]
                    where.append(k)
                    words.append([found[w] for w in own])
                    counts.append(train[own + 1].tobytes())
            n = len(where) + 1
            rest = [None] * (n - 1)
            return pa.RecordBatch.from_arrays(
                [pa.array([first] * n, pa.int64()), pa.array([-1, *where], pa.int32()), pa.array([ids, *rest], pa.list_(pa.int64())),
                 pa.array([held, *rest], pa.list_(pa.bool_())), pa.array([np.array(sizes, np.int64).tobytes(), *rest], pa.binary()),
                 pa.array([packed(code[np.concatenate(codes)]), *rest], pa.binary()), pa.array(words, pa.list_(pa.binary())), pa.array(counts, pa.binary())],
                ["chunk", "shard", "doc_ids", "held", "sizes", "codes", "words", "counts"]).append_column(
                "part", pa.array(["texts", *["words"] * (n - 1)]))

        for batch in batches:
            for row, doc_id, out, text in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                data = (text or "").encode().lower()
                own = np.fromiter(map(numbers.__getitem__, data.split()), np.int32)
                ids.append(doc_id)
                held.append(out)
                sizes.append(len(own) + 1)
                codes.append(np.append(own, np.int32(0)))
                size += len(data)
                first = row if first is None else first
                if size >= CHUNK_BYTES:
                    yield chunk()
                    numbers = defaultdict(count(1).__next__)
                    ids, held, sizes, codes, size, first = [], [], [], [], 0, None
        if ids:
            yield chunk()

    spark = docs.sparkSession
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_ROWS))
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), held_out(), F.col("text").cast("string")).mapInArrow(
        encode, "chunk long, shard int, doc_ids array<long>, held array<boolean>, sizes binary, codes binary, words array<binary>, counts binary, part string")


def packed(codes: np.ndarray) -> bytes:
    """Codes as planes of bytes, the lowest first and without the empty ones, since the higher planes compress well."""
    planes = codes.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return planes[:max(1, 4 - int(np.argmax(planes.any(axis=1)[::-1])))].tobytes()


def unpacked(data: bytes, count: int) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(-1, count)
    out = np.zeros((count, 4), np.uint8)
    out[:, :len(planes)] = planes.T
    return out.view("<u4").ravel().astype(np.int64)


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, F.lit(False)).alias("held_out")


def numbered(rows: pa.Table) -> pa.Table:
    """Of all rows (chunk, shard, words, counts) of a shard: the numbers of each chunk's words, -1 for words that occur in
    no training text, and in a row of chunk -1 the most frequent words and their counts."""
    rows = rows.sort_by("chunk")
    words = pa.concat_arrays([c.flatten() for c in rows.column("words").chunks]).dictionary_encode()
    at = words.indices.to_numpy()
    total = np.zeros(len(words.dictionary), np.int64)
    np.add.at(total, at, np.frombuffer(b"".join(rows.column("counts").to_pylist()), np.int64))
    number = np.where(total > 0, np.cumsum(total > 0) - 1, -1).astype(np.int32)
    known = total[total > 0]
    top = np.argsort(-known, kind="stable")[:CLASSES]
    ids = np.split(number[at], np.cumsum([len(w) for w in rows.column("words")])[:-1])
    chunks = rows.column("chunk").to_pylist()
    return table([(c, i.tobytes(), None, None, None) for c, i in zip(chunks, ids, strict=True)]
                 + [(-1, top.astype(np.int32).tobytes(), None, None, known[top].tolist())], rows.column("shard")[0].as_py())


def table(replies: list[tuple], shard: int) -> pa.Table:
    """A table of _REPLY."""
    chunk, ids, classes, counts, sums = zip(*replies, strict=True)
    return pa.table({"chunk": pa.array(chunk, pa.int64()), "shard": pa.array([shard] * len(chunk), pa.int32()), "ids": pa.array(ids, pa.binary()),
                     "classes": pa.array(classes, pa.binary()), "counts": pa.array(counts, pa.binary()), "sums": pa.array(sums, pa.list_(pa.int64()))})


def joined(replies: pa.Table, name: str, kind: type, end: int) -> np.ndarray:
    """An array by code, from the replies of all shards: `end` first, for code 0."""
    return np.frombuffer(np.array([end], kind).tobytes() + b"".join(replies.column(name).to_pylist()), kind)


def contexts(texts: pa.Table, replies: pa.Table) -> pa.Table:
    """For each shard, what stands beside a chunk's words in training texts: `filled` is the number of entries of a word,
    `beside` their classes (CLASSES + class for one before it), `times` how often, in a byte; where that is 255, `often` has
    the number. And the class bigrams, in a row of shard -1."""
    replies = replies.sort_by("shard")
    chunk = texts.column("chunk")[0].as_py()
    classes = joined(replies, "classes", np.uint8, 0)
    codes, before, _ = training(texts)
    after = np.flatnonzero(before >= 0)
    word, previous = codes[after], before[after]
    known = classes[word].astype(np.int64), classes[previous].astype(np.int64)
    bigrams = np.bincount(known[1] * CLASSES + known[0], minlength=CLASSES * CLASSES)
    entry, times = np.unique(np.concatenate([word * 2 * CLASSES + CLASSES + known[1], previous * 2 * CLASSES + known[0]]), return_counts=True)
    filled = np.bincount(entry // (2 * CLASSES), minlength=len(classes)).astype(np.uint8)
    beside, short = (entry % (2 * CLASSES)).astype(np.uint8), np.minimum(times, 255).astype(np.uint8)
    ends = np.append(0, np.cumsum(filled, dtype=np.int64))
    rows, at = [(chunk, -1, None, None, None, None, None, None, bigrams.tolist())], 1
    for shard, ids, own in zip(*(replies.column(c).to_pylist() for c in ("shard", "ids", "classes")), strict=True):
        lo, hi = ends[at], ends[at + len(own)]
        often = times[lo:hi][times[lo:hi] >= 255].tolist()
        rows.append((chunk, shard, ids, own, filled[at:at + len(own)].tobytes(), beside[lo:hi].tobytes(), short[lo:hi].tobytes(), often, None))
        at += len(own)
    columns = zip(*rows, strict=True)
    kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 5, pa.list_(pa.int64()), pa.list_(pa.int64())]
    names = ["chunk", "shard", "ids", "classes", "filled", "beside", "times", "often", "bigrams"]
    return pa.table({name: pa.array(c, kind) for name, c, kind in zip(names, columns, kinds, strict=True)})


def training(texts: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of a chunk's tokens, the code before each (0 at the start of a text; -1 in texts that are held out), and where
    texts start."""
    sizes = np.frombuffer(texts.column("sizes")[0].as_py(), np.int64)
    codes = unpacked(texts.column("codes")[0].as_py(), int(sizes.sum()))
    starts = np.append(0, np.cumsum(sizes)[:-1])
    before = np.append(0, codes[:-1])
    before[starts] = 0
    before[np.repeat(np.array(texts.column("held")[0].as_py(), bool), sizes)] = -1
    return codes, before, starts


def xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def best_classes(own: np.ndarray, old: np.ndarray, bigrams: np.ndarray) -> np.ndarray:
    """The best class of each word, by its neighbours own[word, class after | CLASSES + class before]."""
    after, before = own[:, :CLASSES], own[:, CLASSES:]
    n, total = before.sum(1), bigrams.sum(1)
    log, log_total = np.log(bigrams + ADDED), 2 * np.log(total + CLASSES * ADDED)
    gain = after @ log.T + before @ log - n[:, None] * log_total
    row, column = bigrams[old], bigrams[:, old].T
    alone = ((after * np.log(np.maximum(row - after, 0) + ADDED)).sum(1) + (before * np.log(np.maximum(column - before, 0) + ADDED)).sum(1)
             - 2 * n * np.log(np.maximum(total[old] - n, 0) + CLASSES * ADDED))
    gain[np.arange(len(own)), old] = alone
    for w in np.flatnonzero(n >= FREQUENT):
        rest, left = bigrams.copy(), total.copy()
        rest[old[w]] -= after[w]
        rest[:, old[w]] -= before[w]
        left[old[w]] -= n[w]
        np.maximum(rest, 0, out=rest)
        np.maximum(left, 0, out=left)
        now, row, column = xlogx(rest), xlogx(rest + after[w]), xlogx(rest + before[w][:, None])
        both = xlogx(rest.diagonal() + after[w] + before[w]) + (now - row - column).diagonal()  # a pair within the class counts once
        gain[w] = (row - now).sum(1) + (column - now).sum(0) + both - 2 * (xlogx(left + n[w]) - xlogx(left))
    gain[:, 0] = -np.inf
    return gain.argmax(1)


def exchange(bigrams: np.ndarray, sweep: int) -> Callable[[pa.Table], pa.Table]:
    """Moves the words of a shard, by the contexts that all chunks found; replies the new classes to the chunks. In a row of
    chunk -1 the number of words, of tokens, of words that occur once and of those that occur twice, of each class."""

    def move(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("chunk")
        ids = [np.frombuffer(x, np.int32) for x in rows.column("ids").to_pylist()]
        size = max((int(x.max(initial=-1)) for x in ids), default=-1) + 1
        own, classes = np.zeros((size, 2 * CLASSES)), np.zeros(size, np.int64)
        for number, old, filled, beside, short, often in zip(ids, *(rows.column(c).to_pylist() for c in ("classes", "filled", "beside", "times", "often")), strict=True):
            known = number >= 0
            classes[number[known]] = np.frombuffer(old, np.uint8)[known]
            word = np.repeat(number, np.frombuffer(filled, np.uint8))
            times = np.frombuffer(short, np.uint8).astype(np.int64)
            times[times == 255] = often
            own[word, np.frombuffer(beside, np.uint8)] += times
        n = own[:, CLASSES:].sum(1).astype(np.int64)
        moves = np.ones(size, bool) if sweep == 0 else (np.arange(size) + sweep) % 2 == 0
        classes = np.where(moves, best_classes(own, classes, bigrams.astype(float)), classes)
        new, counts = np.append(classes, 0).astype(np.uint8), np.append(n, 0)
        sums = [np.bincount(classes, of, CLASSES).astype(np.int64) for of in (np.ones(size), n, n == 1, n == 2)]
        last = sweep == SWEEPS - 1
        replies = [(c, x.tobytes(), new[x].tobytes(), counts[x].tobytes() if last else None, None)
                   for c, x in zip(rows.column("chunk").to_pylist(), ids, strict=True)]
        return table([*replies, (-1, None, None, None, np.concatenate(sums).tolist())], rows.column("shard")[0].as_py())

    return move


class Model:
    """Log10 probabilities of classes and words, from class bigrams and the sums of `exchange`."""

    def __init__(self, bigrams: np.ndarray, sums: np.ndarray, ends: int) -> None:
        words, tokens, once, twice = sums.reshape(4, CLASSES).astype(float)
        words[0], tokens[0] = float(ends > 0), float(ends)
        self.words, self.tokens = int(words.sum()), int(tokens.sum())
        discount = np.where(once + twice > 0, once / np.maximum(once + 2 * twice, 1), 0.5).clip(0.1, 0.9)
        discount[0] = 0.0
        share = tokens / max(self.tokens, 1)
        follows = (bigrams + WEIGHT * share) / (bigrams.sum(1, keepdims=True) + WEIGHT)
        unknown = follows * np.where(tokens > 0, discount * words / np.maximum(tokens, 1), 0.0)
        least = 0.5 / (self.tokens + 0.5 * (self.words + 1))
        with np.errstate(divide="ignore"):
            self.follows, self.unknown = np.log10(follows * (1 - least)), np.log10(unknown.sum(1) * (1 - least) + least)
        self.likely, self.discount, self.sizes = unknown.argmax(1), discount, tokens

    def scores(self, texts: pa.Table, replies: pa.Table) -> pa.Table:
        """Scores of a chunk's texts."""
        replies = replies.sort_by("shard")
        codes, _, starts = training(texts)
        counts = joined(replies, "counts", np.int64, int(self.sizes[0]))[codes]
        classes = joined(replies, "classes", np.uint8, 0).astype(np.int64)[codes]
        known = counts > 0
        first = np.zeros(len(codes) + 1, bool)
        first[starts] = first[-1] = True
        state = np.where(known, classes, -1)
        before = lambda at: np.where(first[at], 0, state[at - 1])
        open_ = np.flatnonzero(~known & (before(np.arange(len(codes))) >= 0))
        while len(open_):  # each unknown word after the one before it
            state[open_] = self.likely[before(open_)]
            open_ = open_[~first[open_ + 1]] + 1
            open_ = open_[~known[open_]]
        h = before(np.arange(len(codes)))
        emitted = np.log10(np.maximum(counts - self.discount[classes], 1e-300) / np.maximum(self.sizes[classes], 1))
        score = np.where(known, self.follows[h, classes] + emitted, self.unknown[h])
        base = np.log10((counts + 0.5) / (self.tokens + 0.5 * (self.words + 1)))
        sizes = np.frombuffer(texts.column("sizes")[0].as_py(), np.int64)
        return pa.table({"doc_id": pa.array(texts.column("doc_ids")[0].as_py(), pa.int64()), "held_out": pa.array(texts.column("held")[0].as_py(), pa.bool_()),
                         "n_tokens": sizes, "n_known": np.add.reduceat(known.astype(np.int64), starts),
                         "base_score": np.add.reduceat(base, starts), "score": np.add.reduceat(score, starts)})


def score(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row of docs(doc_id, text).

    score is the model's log10 probability of the whole text and its end, base_score that of single words. Null and empty
    texts have the end alone. Rows that repeat an id count and are scored one by one; a row without id is a training text.
    Without training texts every token is the unknown word, and both scores are 0. An empty table gives no rows; extra
    columns are ignored.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    size, ends = docs.select(F.octet_length(F.col("text").cast("string")).alias("size"), held_out()).agg(
        F.coalesce(F.sum("size"), F.lit(0)), F.count(F.when(~F.col("held_out"), 1))).first()
    chunks, kept = encoded(docs, max(8, math.ceil(size / SHARD_BYTES))), new_path(spark, "chunks")
    chunks.write.partitionBy("part").parquet(kept)
    read = spark.read.schema(chunks.schema).parquet(kept)
    texts = read.where("part = 'texts'").select("chunk", "doc_ids", "held", "sizes", "codes")
    words = read.where("part = 'words'").select("chunk", "shard", "words", "counts")
    numbers = scratch.put(words.groupBy("shard").applyInArrow(numbered, _REPLY), "numbers")
    remove(spark, f"{kept}/part=words")

    # At first each of the most frequent words is a class, and all others are the last one.
    place = numbers.where("chunk < 0").select("shard", "ids", "sums").collect()
    top = sorted((-n, r.shard, i) for r in place for i, n in zip(np.frombuffer(r.ids, np.int32).tolist(), r.sums, strict=True))[:CLASSES - 2]
    given = {(shard, i): k + 1 for k, (_, shard, i) in enumerate(top)}
    state = scratch.put(numbers.where("chunk >= 0").mapInArrow(first_classes(given), _REPLY), "state")
    scratch.drop("numbers")

    def told() -> DataFrame:
        return state.where("chunk >= 0")

    for sweep in range(SWEEPS):
        found = scratch.put(texts.groupBy("chunk").cogroup(told().groupBy("chunk")).applyInArrow(contexts, _CONTEXT), "contexts")
        state = scratch.put(found.where("shard >= 0").groupBy("shard").applyInArrow(exchange(bigrams_of(found), sweep), _REPLY), "state")
    scratch.drop("contexts")
    final = bigrams_of(texts.groupBy("chunk").cogroup(told().groupBy("chunk")).applyInArrow(contexts, _CONTEXT))
    model = Model(final, added_up(state.where("chunk < 0").select(F.col("sums").alias("x")), 4 * CLASSES), ends)
    out = written(texts.groupBy("chunk").cogroup(told().groupBy("chunk")).applyInArrow(lambda own, replies: model.scores(own, replies), _SCORE), "scores")
    scratch.drop(*list(scratch.paths))
    remove(spark, kept)
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def first_classes(given: dict[tuple[int, int], int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Gives words their first classes: those in `given` (shard, number), all others the last one."""
    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for shard, ids in zip(batch.column("shard").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                own = np.full(len(ids) // 4, CLASSES - 1, np.uint8)
                number = np.frombuffer(ids, np.int32)
                for (of, i), k in given.items():
                    if of == shard:
                        own[number == i] = k
                out.append(own.tobytes())
            yield batch.set_column(batch.schema.get_field_index("classes"), "classes", pa.array(out, pa.binary()))

    return classes


def bigrams_of(found: DataFrame) -> np.ndarray:
    """The class bigrams of all chunks."""
    return added_up(found.where("shard < 0").select(F.col("bigrams").alias("x")), CLASSES * CLASSES).reshape(CLASSES, CLASSES)


def added_up(arrays: DataFrame, size: int) -> np.ndarray:
    """The sum of arrays x of one size, element by element."""
    out = np.zeros(size, np.int64)
    for r in arrays.select(F.posexplode("x").alias("k", "n")).groupBy("k").agg(F.sum("n").alias("n")).collect():  # `size` rows at most
        out[r.k] = r.n
    return out
