"""LM scoring: a log-bilinear neural model of words, trained by noise-contrastive estimation.

The model predicts a word from the ``CONTEXT`` words before it: the vectors of these, one table per
distance, sum to a prediction; its products with the output vectors, plus a bias each, are the
scores. Outputs are the most frequent words and classes of all others by their ending; within a
class a word has its smoothed share of the class's tokens, with room for unknown words. The
scores are normalised over all outputs by batched matrix products, so the token probabilities of a
context sum to one over the whole vocabulary, unknown words included.

Training passes over all learning documents where they lie: every task goes through its rows by
mini-batches from common first parameters, with noise words shared by a batch, and the parameters of all tasks are
averaged by aggregation, weighted by tokens. Word counts are aggregated the same way. Counts of
the ``HEAD`` most frequent words (a bound) go to every task; the others are joined by word.

Tokens are runs of characters other than ASCII white space, A-Z lower-cased, and one end per
text. Defined results:

* a null text is empty: the end alone; rows with equal id and equal text score alike;
* without learning documents counts are zero and every output is as likely as any other;
* other columns are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripfold.llm.common import staged

HEAD = 200_000  # words whose counts every task has
WORDS = 128  # outputs that are one word
CLASSES = 64  # outputs that are a class of words
CONTEXT = 3
SIZE = 16
NOISE = 24
BATCH = 4096  # tokens of a training step
SCORED = 1024  # tokens of a matrix product when scoring
RATE = 0.15
SLICE_TOKENS = 16_384
COUNTED_WORDS = 400_000  # distinct words counted in a task before they are passed on
SMOOTHING = 0.1
END = b"\n"


def tokens_of(text: str) -> list[bytes]:
    words = text.encode("utf-8", "surrogatepass").lower().split()  # ASCII case and white space
    words.append(END)
    return words


def ending(word: str) -> str:
    return word[-2:]


# counts


def word_counts(documents: DataFrame) -> DataFrame:
    """word and n over all texts, the end as a line feed."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column(0):
                found.update(tokens_of(text.as_py()))
                if len(found) > COUNTED_WORDS:
                    yield _counts(found)
                    found = Counter()
        yield _counts(found)

    parts = documents.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        counted, "word string, n bigint"
    )
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def _counts(found: Counter) -> pa.RecordBatch:
    words = pa.array(list(found), pa.binary()).cast(pa.string())
    return pa.RecordBatch.from_arrays([words, pa.array(list(found.values()), pa.int64())], names=["word", "n"])


@dataclass
class Vocabulary:
    """What every task knows of the words: a bounded head, and totals of the classes."""

    tokens: int
    distinct: int
    number: dict[bytes, int]  # head words, most frequent first
    outputs: np.ndarray  # the output of every head word
    log_count: np.ndarray  # log10(n + SMOOTHING) of every head word
    endings: dict[str, int]
    class_log_total: np.ndarray  # of every output; zero for words
    share: np.ndarray  # of the tokens, by output

    def coded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
        """Per token its head number or -1 and its output; per text its size; tokens not in the head."""
        get = self.number.get
        numbers: list[int] = []
        sizes, rest = [], []
        for text in texts:
            words = tokens_of(text)
            own = [get(word, -1) for word in words]
            numbers += own
            sizes.append(len(words))
            if -1 in own:
                rest += [word for word, number in zip(words, own) if number < 0]
        number = np.array(numbers, np.int64)
        output = self.outputs[number] if len(self.outputs) else np.zeros(len(number), np.int64)
        if rest:
            other = WORDS + CLASSES - 1
            find = self.endings.get
            output = output.copy()
            output[number < 0] = [find(ending(word[-8:].decode("utf-8", "ignore")), other) for word in rest]
        return number, output, np.array(sizes), rest


def _head(counts: DataFrame, head: int) -> list:
    """The most frequent words, ``head`` at most, most frequent first.

    Words are taken down to a count that keeps them within the bound, found from a table of
    frequency classes, an eighth of an octave each; so no task sends more than it has of them.
    """
    frequency = F.floor(F.log2("n") * 8).cast("int")
    classes = counts.groupBy(frequency.alias("frequency")).agg(F.count("*").alias("words")).collect()
    least, words = None, 0
    for row in sorted(classes, key=lambda row: -row.frequency):
        words += row.words
        if words > head:
            break
        least = row.frequency
    if least is None:
        return []
    rows = counts.where(frequency >= least).select("word", "n").collect()
    return sorted(rows, key=lambda row: (-row.n, row.word.encode()))


def vocabulary_of(counts: DataFrame, head: int = HEAD) -> Vocabulary:
    """From the staged counts; collects the head and as many endings as there are classes."""
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("words")).first()
    top = _head(counts, head)
    single = [row.word for row in top[:WORDS]]
    others = counts.where(~F.col("word").isin(single)) if single else counts
    by_ending = staged(
        others.groupBy(F.expr("right(word, 2)").alias("ending"))
        .agg(F.sum("n").alias("n"), F.count("*").alias("words")),
        "endings",
    )
    common = by_ending.orderBy(F.desc("n"), "ending").limit(CLASSES - 1).collect()
    endings = {row.ending: WORDS + i for i, row in enumerate(common)}
    all_others = by_ending.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("words"), F.lit(0)).alias("words")
    ).first()
    size = WORDS + CLASSES
    tokens, words = np.zeros(size), np.zeros(size)
    for i, row in enumerate(common):
        tokens[WORDS + i], words[WORDS + i] = row.n, row.words
    tokens[-1] = all_others.n - tokens[WORDS:-1].sum()
    words[-1] = all_others.words - words[WORDS:-1].sum()
    class_log_total = np.zeros(size)
    class_log_total[WORDS:] = np.log10(tokens[WORDS:] + SMOOTHING * (words[WORDS:] + 1))
    tokens[: len(single)] = [row.n for row in top[:WORDS]]
    outputs = [i if i < WORDS else endings.get(ending(row.word), size - 1) for i, row in enumerate(top)]
    share = tokens + 1.0
    return Vocabulary(
        total.n,
        total.words,
        {row.word.encode(): i for i, row in enumerate(top)},
        np.array(outputs, np.int64),
        np.array([math.log10(row.n + SMOOTHING) for row in top]),
        endings,
        class_log_total,
        share / share.sum(),
    )


# model


@dataclass
class Model:
    context: np.ndarray  # (CONTEXT, outputs + 1, SIZE); the last row stands before a text
    output: np.ndarray  # (outputs, SIZE)
    bias: np.ndarray  # (outputs,)

    @staticmethod
    def fresh(share: np.ndarray, seed: int = 11) -> Model:
        rng = np.random.default_rng(seed)
        return Model(
            rng.normal(0, 0.1, (CONTEXT, len(share) + 1, SIZE)).astype(np.float32),
            rng.normal(0, 0.1, (len(share), SIZE)).astype(np.float32),
            np.log(share).astype(np.float32),
        )

    def flat(self) -> np.ndarray:
        return np.concatenate([self.context.ravel(), self.output.ravel(), self.bias.ravel()])

    def filled(self, values: np.ndarray) -> Model:
        a, b = self.context.size, self.context.size + self.output.size
        values = values.astype(np.float32)
        return Model(
            values[:a].reshape(self.context.shape), values[a:b].reshape(self.output.shape), values[b:]
        )

    def prediction(self, before: np.ndarray) -> np.ndarray:
        total = self.context[0][before[0]]
        for table, ids in zip(self.context[1:], before[1:]):
            total = total + table[ids]
        return total

    def log_probability(self, output: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Natural log of the normalised probability of every output after its context."""
        scores = self.prediction(before) @ self.output.T
        scores += self.bias
        own = scores[np.arange(len(output)), output]
        if scores.size and scores.max() > 60:  # beyond what float32 can sum
            top = scores.max(axis=1, keepdims=True)
            return own - top[:, 0] - np.log(np.exp(scores - top).sum(axis=1))
        return own - np.log(np.exp(scores, out=scores).sum(axis=1))


def contexts_of(output: np.ndarray, sizes: np.ndarray, start: int) -> np.ndarray:
    """(CONTEXT, tokens): the outputs one, two, … before each, ``start`` before the text."""
    place = np.arange(len(output)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    before = np.full((CONTEXT, len(output)), start, np.int64)
    for k in range(CONTEXT):
        before[k, k + 1 :] = output[: -k - 1]
        before[k, place <= k] = start
    return before


class Trainer:
    """Noise-contrastive estimation with Adagrad on one task's tokens."""

    def __init__(self, model: Model, share: np.ndarray, seed: int):
        self.model, self.share = model, share
        self.rng = np.random.default_rng(seed)
        self.expected = np.log(NOISE * share).astype(np.float32)
        self.seen = [np.full(p.shape, 1e-4, np.float32) for p in (model.context, model.output, model.bias)]
        self.tokens = 0
        self.cumulative = np.cumsum(share)

    def learn(self, output: np.ndarray, before: np.ndarray) -> None:
        for at in range(0, len(output), BATCH):
            self._step(output[at : at + BATCH], before[:, at : at + BATCH])
        self.tokens += len(output)

    def _step(self, own: np.ndarray, before: np.ndarray) -> None:
        m, n = self.model, len(own)
        noise = np.searchsorted(self.cumulative, self.rng.random(NOISE)).clip(max=len(self.share) - 1)
        q = m.prediction(before)
        own_vectors, noise_vectors = m.output[own], m.output[noise]
        own_score = np.einsum("nd,nd->n", q, own_vectors) + m.bias[own] - self.expected[own]
        noise_score = q @ noise_vectors.T + (m.bias[noise] - self.expected[noise])
        own_error = -1 / (1 + np.exp(own_score))  # probability of data minus one
        noise_error = 1 / (1 + np.exp(-noise_score))
        d_q = own_error[:, None] * own_vectors + noise_error @ noise_vectors
        columns = np.arange(SIZE)

        def scattered(ids: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
            flat = (ids[:, None] * SIZE + columns).ravel()
            return np.bincount(flat, rows.ravel(), size * SIZE).reshape(size, SIZE)

        outputs = len(m.output)
        d_output = scattered(own, own_error[:, None] * q, outputs)
        np.add.at(d_output, noise, noise_error.T @ q)
        d_bias = np.bincount(own, own_error, outputs)
        np.add.at(d_bias, noise, noise_error.sum(axis=0))
        d_context = np.stack([scattered(ids, d_q, outputs + 1) for ids in before])
        for value, gradient, seen in zip(
            (m.context, m.output, m.bias), (d_context, d_output, d_bias), self.seen
        ):
            gradient = (gradient / n).astype(np.float32)
            seen += gradient * gradient
            value -= RATE * gradient / np.sqrt(seen)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, list[str]]]:
    """ids, hashes and texts of so many rows that they hold about SLICE_TOKENS tokens."""
    for batch in batches:
        ids, hashes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        start, chars, texts = 0, 0, []
        for i, text in enumerate(batch.column(2)):
            texts.append(text.as_py())
            chars += len(texts[-1])
            if chars > 6 * SLICE_TOKENS:
                yield ids[start : i + 1], hashes[start : i + 1], texts
                start, chars, texts = i + 1, 0, []
        if texts:
            yield ids[start:], hashes[start:], texts


def _rows(documents: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit("")).alias("text")
    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("hash"), text)


def trained(learning: DataFrame, vocabulary: Vocabulary, seed: int = 11) -> Model:
    """The average of what every task learns from its rows."""
    fresh = Model.fresh(vocabulary.share, seed)
    start = len(vocabulary.share)
    length = fresh.flat().size

    def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = Trainer(Model.fresh(vocabulary.share, seed), vocabulary.share, seed)
        for _, _, texts in _slices(batches):
            _, output, sizes, _ = vocabulary.coded(texts)
            trainer.learn(output, contexts_of(output, sizes, start))
        if trainer.tokens:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(length), pa.int32()),
                    pa.array(trainer.model.flat().astype(np.float64) * trainer.tokens),
                    pa.array(np.full(length, trainer.tokens), pa.int64()),
                ],
                names=["parameter", "value", "tokens"],
            )

    # One row per parameter of the model, whatever the corpus.
    averages = (
        _rows(learning)
        .mapInArrow(learned, "parameter int, value double, tokens bigint")
        .groupBy("parameter")
        .agg((F.sum("value") / F.sum("tokens")).alias("value"))
        .collect()
    )
    if not averages:
        return fresh
    values = np.zeros(length)
    for row in averages:
        values[row.parameter] = row.value
    return fresh.filled(values)


def scores(documents: DataFrame, counts: DataFrame, vocabulary: Vocabulary, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every document."""
    start = len(vocabulary.share)

    def by_head(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, hashes, texts in _slices(batches):
            number, output, sizes, _ = vocabulary.coded(texts)
            before = contexts_of(output, sizes, start)
            log_p = np.empty(len(output))
            for at in range(0, len(output), SCORED):
                part = slice(at, at + SCORED)
                log_p[part] = model.log_probability(output[part], before[:, part])
            known = number >= 0
            log_count = np.where(known, vocabulary.log_count[number], 0.0) if len(vocabulary.log_count) else np.zeros(len(number))
            inside = np.where(output >= WORDS, log_count, 0.0) - vocabulary.class_log_total[output]
            first = np.cumsum(sizes) - sizes
            add = lambda x: pa.array(np.add.reduceat(x.astype(float), first))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(hashes, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(np.add.reduceat(known.astype(np.int64), first), pa.int64()),
                    add(log_count),
                    add(log_p / math.log(10) + inside),
                ],
                names=["doc_id", "hash", "n_tokens", "head_known", "head_log", "model_log"],
            )

    def beyond_head(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = vocabulary.number.get
        for ids, hashes, texts in _slices(batches):
            columns: list[list] = [[], [], [], []]
            for doc_id, own_hash, text in zip(ids, hashes, texts):
                rest = Counter(word for word in tokens_of(text) if get(word) is None)
                columns[0] += [doc_id] * len(rest)
                columns[1] += [own_hash] * len(rest)
                columns[2] += rest
                columns[3] += rest.values()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(columns[0], pa.int64()),
                    pa.array(columns[1], pa.int64()),
                    pa.array(columns[2], pa.binary()).cast(pa.string()),
                    pa.array(columns[3], pa.int64()),
                ],
                names=["doc_id", "hash", "word", "m"],
            )

    heads = staged(
        _rows(documents).mapInArrow(
            by_head,
            "doc_id bigint, hash bigint, n_tokens bigint, head_known bigint, head_log double, model_log double",
        ),
        "head-scores",
    )
    key = F.struct("doc_id", "hash")
    # Every known word beyond the head has a count; a word without one was never learned.
    n = F.coalesce("n", F.lit(0))
    tails = (
        _rows(documents)
        .mapInArrow(beyond_head, "doc_id bigint, hash bigint, word string, m bigint")
        .join(counts, "word", "left")
        .groupBy(key.alias("key"))
        .agg(
            F.sum(F.col("m") * F.log10(n + SMOOTHING)).alias("tail_log"),
            F.sum(F.when(n > 0, F.col("m")).otherwise(0)).alias("tail_known"),
        )
    )
    # Rows that repeat whole have sent their words as often.
    copies = heads.groupBy(key.alias("key")).agg(F.count("*").alias("copies"))
    tails = tails.join(copies, "key").select(
        F.col("key").alias("tail_key"),
        (F.col("tail_log") / F.col("copies")).alias("tail_log"),
        (F.col("tail_known") / F.col("copies")).cast("bigint").alias("tail_known"),
    )
    tail_log = F.coalesce("tail_log", F.lit(0.0))
    norm = math.log10(vocabulary.tokens + SMOOTHING * (vocabulary.distinct + 1))
    return heads.join(tails, key.eqNullSafe(F.col("tail_key")), "left").select(
        "doc_id",
        "n_tokens",
        (F.col("head_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.tokens).cast("bigint").alias("train_tokens"),
        (F.col("head_log") + tail_log - F.col("n_tokens") * norm).alias("base_score"),
        (F.col("model_log") + tail_log).alias("score"),
    )


def score_corpus(documents: DataFrame, learning: DataFrame) -> DataFrame:
    """Train on ``learning``, score ``documents``."""
    counts = staged(word_counts(learning), "word-counts")
    vocabulary = vocabulary_of(counts)
    return scores(documents, counts, vocabulary, trained(learning, vocabulary))
