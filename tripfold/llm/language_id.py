"""Language identification: a linear-chain conditional random field over the words of a text.

A word's features are its affixes, its character n-grams and, if the lexicon has it, the word
itself with the languages it is found in. The field adds learned transitions between the languages of neighbouring
words; forward-backward gives every word its language probabilities, so code-switched text gets
different labels word by word. A document's language is the one with the most probability summed
over its words, its score that sum's share.

Documents carry one label each, so training sequences are spliced: runs of words from documents
of different languages follow each other, and the transitions are learned from where they change. The
sample is bounded: ``SAMPLE`` documents of each language, the least by hash.

A document is in none of the languages when its spelling is that of none: letter trigrams give
every word a likelihood in each language, the field's word probabilities mix them, and the sum of their
logarithms over the words, a letter, is held against a floor. The floor depends on the number of letters (short texts
vary more) and is fitted on texts and parts of texts, down to one word and spliced from several
languages, each scored by trigrams of the other folds of the sample. Neither depends on the number of languages.

Words are runs of letters, lower-cased; digits, also raised and Roman ones of one character, are no
letters. Runs beyond ``LONGEST`` letters, as in scripts without spaces, are cut into consecutive words, so
that all their letters count. Defined results:

* a null text or one without a letter is ``und`` with score 0;
* without any labelled document every text is ``und`` with score 0;
* rows that repeat repeat their result; ids may be null; other columns are not looked at.

The sample is fitted on the driver. Its texts are numbers of words there, and its held-out texts are scored
``FITTED_WORDS`` at a time, so that only the words of the sample and one slice of scores are in memory.

Words are scored once per worker and remembered; texts are processed whole, many at a time, in
blocks of words joined exactly, so a very long text costs memory for its words only.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripfold.llm.common import give_back, held_by_worker, matched_rows, row_key, small_side, staged, whole_text

SAMPLE = 300  # documents per language at most
SAMPLE_WORDS = 250_000  # words of training sequences at most
LEXICON = 4000  # words of the lexicon at most
BUCKETS = 1 << 15  # hashed features
STORED_WORDS = 250_000
SLICE_WORDS = 100_000  # words labelled at once, and one text at least
FITTED_WORDS = 50_000  # words of held-out texts scored at once, and one text at least
WORDS_AT_ONCE = 5000  # distinct words scored at once
BATCH = 64  # sequences in a training step
BLOCK = 256
FOLDS = 5
SMOOTHING = 2.0  # letters of the next shorter context mixed into one
FLOOR_SLACK = 1.0  # of the distance from the median to the least held-out text
UNFITTED = 20  # held-out texts below which no floor is set
UNKNOWN = "und"
LONGEST = 40  # letters of a word

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    words = _WORD.findall(text.lower())
    if not all(map(str.isalpha, words)):  # the pattern takes ², ½ and Ⅷ for letters
        kept = "".join(c if c.isalpha() else " " for c in " ".join(words))
        words = kept.split()
    if max(map(len, words), default=0) > LONGEST:
        words = [word[i : i + LONGEST] for word in words for i in range(0, len(word), LONGEST)]
    return words


def features_of(word: str, lexicon: dict[str, int]) -> list[int]:
    """Hashed features: affixes of one to four letters, n-grams of two and three, lexicon entries."""
    names = []
    for n in range(1, min(4, len(word)) + 1):
        names.append(f"p{word[:n]}")
        names.append(f"s{word[-n:]}")
    framed = f"^{word}$"
    for n in (2, 3):
        names += [f"{n}{framed[i : i + n]}" for i in range(len(framed) - n + 1)]
    names.append("l" + (word if word in lexicon else ""))
    if word in lexicon:
        names.append(f"m{lexicon[word]}")
    return [crc32(name.encode()) & (BUCKETS - 1) for name in names]


@dataclass
class Spelling:
    """Letter trigrams of every language with back-off, and the floor of texts in one of them."""

    number: dict[str, int]  # rows: "abc" or "bc" or "c" seen, "-ab" back-off after ab
    table: np.ndarray  # (rows, languages); row 0 is an unseen letter
    floor: np.ndarray  # least log likelihood a letter, by the octave of the number of letters

    @staticmethod
    def of(texts: list[tuple[np.ndarray, int]], vocabulary: list[str], kinds: int) -> Spelling:
        """Interpolated trigrams of labelled texts, each the numbers of its words."""
        grams: tuple[dict, dict, dict] = ({}, {}, {})
        for label in range(kinds):
            codes, times, _ = _by_appearance([own for own, its in texts if its == label])
            for code, n in zip(codes.tolist(), times.tolist()):
                framed = f"^^{vocabulary[code]}$"
                for i in range(2, len(framed)):
                    for length, found in enumerate(grams, 1):
                        part = framed[i + 1 - length : i + 1]
                        if part not in found:
                            found[part] = [0] * kinds
                        found[part][label] += n
        counts = [np.array(list(found.values()), float).reshape(-1, kinds) for found in grams]
        share = 1 / (len(grams[0]) + 1)
        letters = counts[0].sum(axis=0)
        number: dict[str, int] = {}
        tables = [np.log(share * SMOOTHING / (letters + SMOOTHING))[None, :]]
        shorter, place = np.full((1, kinds), share), {"": 0}
        for found, n in zip(grams, counts):
            before: dict[str, int] = {}
            own = np.array([before.setdefault(part[:-1], len(before)) for part in found], np.int64)
            total = np.zeros((len(before), kinds))
            np.add.at(total, own, n)
            p = n + SMOOTHING * shorter[[place[part[1:]] for part in found]]
            p /= total[own] + SMOOTHING
            first = len(number) + 1
            number.update(zip(found, range(first, first + len(found))))
            number.update(("-" + part, first + len(found) + i) for part, i in before.items())
            tables += [np.log(p), np.log(SMOOTHING / (total + SMOOTHING))]
            shorter, place = p, dict(zip(found, range(len(found))))
        return Spelling(number, np.vstack(tables), np.zeros(0))

    def likelihoods(self, words: list[str]) -> np.ndarray:
        """Log likelihood of every word in every language, its end included."""
        if len(words) > WORDS_AT_ONCE:
            some = (words[i : i + WORDS_AT_ONCE] for i in range(0, len(words), WORDS_AT_ONCE))
            return np.vstack([self.likelihoods(part) for part in some])
        get, ids, begins = self.number.get, [], []
        for word in words:
            framed = f"^^{word}$"
            begins.append(len(ids))
            for i in range(2, len(framed)):
                for at in (i - 2, i - 1, i):
                    row = get(framed[at : i + 1])
                    if row is not None:
                        ids.append(row)
                        break
                    if at < i:
                        row = get("-" + framed[at:i])
                        if row is not None:
                            ids.append(row)
                else:
                    ids.append(0)
        return np.add.reduceat(self.table[np.array(ids, np.int64)], begins, axis=0)

    def fit_floor(self, totals: list[float], letters: list[int]) -> None:
        """From held-out texts: their log likelihoods and numbers of letters."""
        octave = np.log2(np.array(letters)).astype(int)
        each = np.array(totals) / np.array(letters)
        floor = np.full(32, -np.inf)
        for k in range(32):
            own = each[octave == k]
            if len(own) >= UNFITTED:
                floor[k] = own.min() - FLOOR_SLACK * (np.median(own) - own.min())
        # Longer texts vary less: one the sample has too few of takes the floor of the last shorter ones.
        for k in range(1, 32):
            floor[k] = max(floor[k], floor[k - 1])
        self.floor = floor

    def fits(self, totals: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """Whether texts of these log likelihoods and numbers of letters are in a language."""
        if not len(self.floor):
            return np.ones(len(totals), bool)
        return totals / letters >= self.floor[np.log2(letters).astype(int).clip(max=31)]


def _letters(words: list[str]) -> int:
    return sum(map(len, words)) + len(words)


def _by_appearance(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different numbers in the order they first appear, how often each does, and the place of every one there."""
    every = np.concatenate([np.zeros(0, np.int32), *texts])
    codes, first, place, times = np.unique(every, return_index=True, return_inverse=True, return_counts=True)
    order = np.argsort(first)
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    return codes[order], times[order], rank[place]


def _sliced(texts: list[np.ndarray], words: int) -> Iterator[list[np.ndarray]]:
    """Neighbouring texts of so many words together, or one text."""
    held: list[np.ndarray] = []
    waiting = 0
    for own in texts:
        if held and waiting + len(own) > words:
            yield held
            held, waiting = [], 0
        held.append(own)
        waiting += len(own)
    if held:
        yield held


def mixed(p: np.ndarray, spelt: np.ndarray) -> np.ndarray:
    """Log likelihood of every word, its language as probable as the field says."""
    top = spelt.max(axis=1)
    return top + np.log((p * np.exp(spelt - top[:, None])).sum(axis=1) + 1e-30)


def spelling_of(texts: list[tuple[np.ndarray, int]], model: Field, seed: int = 3) -> Spelling:
    """Trigrams of all texts, with a floor fitted on each fold by the trigrams of the others."""
    rng, kinds, vocabulary = np.random.default_rng(seed), len(model.languages), model.vocabulary
    fold = rng.permutation(len(texts)) % FOLDS
    emission = model.emissions(vocabulary)
    size_of = np.array([len(word) + 1 for word in vocabulary], np.int64)
    totals: list[float] = []
    letters: list[int] = []
    for k in range(FOLDS):
        held = [own for (own, _), its in zip(texts, fold) if its == k and len(own)]
        rest = [text for text, its in zip(texts, fold) if its != k]
        if not held or not rest:
            continue
        parts = list(held)
        for own in held:  # parts of all sizes
            size = 1
            while size < len(own):
                at = int(rng.integers(len(own) - size + 1))
                parts.append(own[at : at + size])
                size *= 2
        for own in held:  # code-switched
            other = held[int(rng.integers(len(held)))]
            parts.append(np.concatenate([own[: 1 + len(own) // 2], other[len(other) // 2 :]]))
        distinct, _, _ = _by_appearance(held)
        place = np.zeros(len(vocabulary), np.int32)
        place[distinct] = np.arange(len(distinct))
        spelt = Spelling.of(rest, vocabulary, kinds).likelihoods([vocabulary[code] for code in distinct])
        for some in _sliced(parts, FITTED_WORDS):
            every, sizes = np.concatenate(some), np.array([len(own) for own in some])
            begins = np.cumsum(sizes) - sizes
            each = mixed(marginals(emission[every], sizes, model.transitions), spelt[place[every]])
            totals += np.add.reduceat(each, begins).tolist()
            letters += np.add.reduceat(size_of[every], begins).tolist()
    whole = Spelling.of(texts, vocabulary, kinds)
    if totals:
        whole.fit_floor(totals, letters)
    return whole


@dataclass
class Field:
    """Weights of the conditional random field; ``name`` tells models apart in a worker."""

    languages: list[str]
    lexicon: dict[str, int]
    weights: np.ndarray  # (BUCKETS, languages)
    transitions: np.ndarray  # (languages, languages)
    name: str = ""
    texts: list[tuple[np.ndarray, int]] | None = None  # learned from, as places in vocabulary; stay on the driver
    vocabulary: list[str] | None = None
    spelling: Spelling | None = None

    def __getstate__(self):
        return self.__dict__ | {"texts": None, "vocabulary": None}

    def with_spelling(self) -> Field:
        """The field, its spelling fitted if it was not; the texts it was learned from go."""
        if self.spelling is None and self.texts:
            self.spelling = spelling_of(self.texts, self)
            self.texts = self.vocabulary = None
            give_back()
        return self

    def emissions(self, words: list[str]) -> np.ndarray:
        """Scores of words, not remembered."""
        if len(words) > WORDS_AT_ONCE:
            return np.vstack([self.emissions(words[i : i + WORDS_AT_ONCE]) for i in range(0, len(words), WORDS_AT_ONCE)])
        lists = [features_of(word, self.lexicon) for word in words]
        sizes = np.array([len(ids) for ids in lists])
        begins = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        gathered = self.weights[np.fromiter(chain.from_iterable(lists), np.int64)]
        return np.add.reduceat(gathered, begins, axis=0) / np.sqrt(sizes)[:, None]


class WordScores:
    """Scores of the words a worker has met; begun anew when there are too many."""

    def __init__(self, model: Field, spelt: bool = False):
        self.model, self.spelt = model, spelt
        self.number: dict[str, int] = {}
        self.table = np.zeros((STORED_WORDS // 8, len(model.languages) * (1 + spelt)), np.float32)

    def of(self, texts: list[list[str]]) -> np.ndarray:
        """A row per word of all texts, one text after the other; its spelling's likelihoods behind."""
        if len(self.number) > STORED_WORDS:
            self.number = {}
        number = self.number
        new = list(dict.fromkeys(word for words in texts for word in words if word not in number))
        used = len(number)
        while used + len(new) > len(self.table):
            self.table = np.vstack([self.table, np.zeros_like(self.table)])
        for at in range(0, len(new), WORDS_AT_ONCE):
            part = new[at : at + WORDS_AT_ONCE]
            kinds = len(self.model.languages)
            self.table[used : used + len(part), :kinds] = self.model.emissions(part)
            if self.spelt:
                self.table[used : used + len(part), kinds:] = self.model.spelling.likelihoods(part)
            number.update(zip(part, range(used, used + len(part))))
            used += len(part)
        found = np.fromiter((number[word] for words in texts for word in words), np.int64)
        return self.table[found]


def _normal(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=-1, keepdims=True)


def messages(
    emission: np.ndarray, sizes: np.ndarray, transitions: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over many sequences, one after the other, none of them empty.

    Returns, a row per word and scaled freely, the forward message (the word's own score
    included), the backward message and the exponentiated score of the word.

    Sequences are cut into blocks of BLOCK words. For all blocks at once the product of their
    step matrices is made, the blocks of a sequence are joined one after the other, and then all
    blocks run forward and backward from the messages they get: exact, whatever the lengths.
    """
    kinds = emission.shape[1]
    step = np.exp(transitions - transitions.max())
    scores = np.exp((emission - emission.max(axis=1, keepdims=True)).astype(np.float64))
    blocks = -(-sizes // BLOCK)
    rank = np.arange(int(blocks.sum())) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    starts = np.repeat(np.cumsum(sizes) - sizes, blocks) + rank * BLOCK
    length = np.minimum(BLOCK, np.repeat(sizes, blocks) - rank * BLOCK)
    opens = rank == 0  # nothing steps into the first word of a sequence
    before, after = _joined(scores, step, blocks, rank, starts, length)

    # Longest blocks first, so that those still running are a prefix.
    order = np.argsort(-length, kind="stable")
    starts, opens = starts[order], opens[order]
    running = np.searchsorted(-length[order], -np.arange(BLOCK + 1), side="left")
    forward, backward = np.empty_like(scores), np.empty_like(scores)
    message = before[order]
    for t in range(int(length.max())):
        n = running[t]
        reached = message[:n] @ step
        if t == 0:
            reached[opens] = 1.0
        at = starts[:n] + t
        message[:n] = _normal(reached * scores[at])
        forward[at] = message[:n]
    message = after[order]
    for t in range(int(length.max()) - 1, -1, -1):
        n = running[t]
        at = starts[:n] + t
        backward[at] = message[:n]
        message[:n] = _normal((scores[at] * message[:n]) @ step.T)
    return forward, backward, scores


def _joined(scores, step, blocks, rank, starts, length) -> tuple[np.ndarray, np.ndarray]:
    """Messages into every block from the words before it and from those after it."""
    kinds, total = len(step), len(rank)
    before, after = np.ones((total, kinds)), np.ones((total, kinds))
    several = np.flatnonzero(np.repeat(blocks > 1, blocks))
    if not len(several):
        return before, after
    # products of the step matrices of the blocks that have neighbours
    order = several[np.argsort(-length[several], kind="stable")]
    running = np.searchsorted(-length[order], -np.arange(BLOCK + 1), side="left")
    product = np.broadcast_to(np.eye(kinds), (len(order), kinds, kinds)).copy()
    for t in range(int(length[order].max())):
        n = running[t]
        new = (product[:n].reshape(-1, kinds) @ step).reshape(n, kinds, kinds)
        if t == 0:
            new[rank[order] == 0] = np.eye(kinds)
        new *= scores[starts[order[:n]] + t][:, None, :]
        product[:n] = new / new.sum(axis=(1, 2), keepdims=True)
    place = np.zeros(total, np.int64)
    place[order] = np.arange(len(order))
    behind = np.repeat(blocks, blocks) - 1 - rank
    for k in range(1, int(blocks.max())):
        now = np.flatnonzero(rank == k)
        before[now] = _normal(np.einsum("bi,bij->bj", before[now - 1], product[place[now - 1]]))
        now = np.flatnonzero(behind == k)
        after[now] = _normal(np.einsum("bij,bj->bi", product[place[now + 1]], after[now + 1]))
    return before, after


def marginals(emission: np.ndarray, sizes: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """P(label of a word | its text), a row per word."""
    forward, backward, _ = messages(emission, sizes, transitions)
    return _normal(forward * backward)


def _spliced(
    texts: list[tuple[np.ndarray, int]], rng: np.random.Generator
) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Sequences of runs of 4 to 40 words, each from a document of its own, with their labels."""
    runs = []
    for words, label in texts:
        at = 0
        while at < len(words):
            size = int(rng.integers(4, 41))
            runs.append((words[at : at + size], label))
            at += size
    rng.shuffle(runs)
    runs = runs[: SAMPLE_WORDS // 22]
    sequences, labels = [], []
    for i in range(0, len(runs), 4):
        sequences.append(np.concatenate([words for words, _ in runs[i : i + 4]]))
        labels.append(np.concatenate([np.full(len(words), label) for words, label in runs[i : i + 4]]))
    return sequences, labels


def trained(sample: list[tuple[str, str]], seed: int = 3, epochs: int = 6) -> Field:
    """A field fitted to (text, language) pairs by likelihood gradients (Adagrad)."""
    languages = sorted({language for _, language in sample})
    rng = np.random.default_rng(seed)
    number: dict[str, int] = {}
    texts = []
    for text, language in sample:
        codes = [number.setdefault(word, len(number)) for word in words_of(text)]
        texts.append((np.array(codes, np.int32), languages.index(language)))
    vocabulary = list(number)
    found = np.zeros((len(vocabulary), len(languages)))
    for codes, label in texts:
        np.add.at(found[:, label], codes, 1)
    times = found.sum(axis=1)
    frequent = sorted(number, key=lambda word: (-times[number[word]], word))[:LEXICON]
    # in which languages a word is usual, as a bit set
    lexicon = {
        word: int(sum(1 << i for i, n in enumerate(found[number[word]]) if n >= 0.2 * times[number[word]]))
        for word in frequent
    }
    kinds = len(languages)
    model = Field(languages, lexicon, np.zeros((BUCKETS, kinds)), np.zeros((kinds, kinds)), "", texts, vocabulary)
    if kinds < 2:
        return model
    sequences, labels = _spliced(texts, rng)
    met, _, places = _by_appearance(sequences)
    coded = np.split(places, np.cumsum([len(s) for s in sequences])[:-1]) if sequences else []
    lists = [np.array(features_of(vocabulary[code], lexicon), np.int32) for code in met]
    seen_weights, seen_steps = np.full((BUCKETS, kinds), 1e-8), np.full((kinds, kinds), 1e-8)
    for _ in range(epochs):
        order = rng.permutation(len(coded))
        for i in range(0, len(order), BATCH):
            rows = order[i : i + BATCH]
            at = np.concatenate([coded[r] for r in rows])
            truth = np.concatenate([labels[r] for r in rows])
            sizes = np.array([len(coded[r]) for r in rows])
            used, inverse = np.unique(at, return_inverse=True)
            times = np.array([len(lists[u]) for u in used])
            ids = np.concatenate([lists[u] for u in used])
            root = np.sqrt(times)[:, None]
            table = np.add.reduceat(model.weights[ids], np.cumsum(times) - times, axis=0) / root
            forward, backward, scores = messages(table[inverse], sizes, model.transitions)
            wrong = _normal(forward * backward)
            wrong[np.arange(len(wrong)), truth] -= 1
            per_word = np.stack([np.bincount(inverse, wrong[:, k], len(used)) for k in range(kinds)], 1)
            per_feature = np.repeat(per_word / root, times, axis=0)
            gradient = np.stack([np.bincount(ids, per_feature[:, k], BUCKETS) for k in range(kinds)], 1)
            gradient = gradient / len(at) + 1e-7 * model.weights
            seen_weights += gradient**2
            model.weights -= 0.3 * gradient / np.sqrt(seen_weights)
            # label pairs of neighbouring words: expected against true
            inner = np.ones(len(at), bool)
            inner[np.cumsum(sizes) - sizes] = False
            later = np.flatnonzero(inner)
            joint = (
                forward[later - 1][:, :, None]
                * np.exp(model.transitions - model.transitions.max())
                * (scores[later] * backward[later])[:, None, :]
            )
            expected = (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            np.add.at(expected, (truth[later - 1], truth[later]), -1.0)
            step = expected / len(at) + 1e-6 * model.transitions
            seen_steps += step**2
            model.transitions -= 0.2 * step / np.sqrt(seen_steps)
    return model


def sampled(documents: DataFrame, per_language: int = SAMPLE) -> list[tuple[str, str]]:
    """(text, language) of at most ``per_language`` labelled documents of each language, the least by hash.

    Distinct texts are counted per language; the count says below which hash there are a few more than
    wanted, so only those are ever ranked, whatever the number of documents.
    """
    usable = documents.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    # Equal texts share their hash: the place of a text among all hashes, from 0 to 1.
    place = (F.col("hash") / F.lit(2.0**64) + F.lit(0.5)).alias("place")
    hashes = staged(usable.select("lang", F.xxhash64("text").alias("hash")).distinct(), "language-hashes")
    counts = staged(hashes.groupBy("lang").count(), "language-counts")
    # Six standard deviations above the wanted number, so that fewer below the cut do not occur.
    above = per_language + 6 * per_language**0.5 + 20
    cuts = small_side(counts.select("lang", (F.lit(above) / F.col("count")).alias("cut")))
    few = hashes.join(cuts, "lang").where(place <= F.col("cut")).select("lang", "hash")
    order = Window.partitionBy("lang").orderBy("hash")
    ranked = few.withColumn("rank", F.row_number().over(order))
    chosen = staged(ranked.where(F.col("rank") <= per_language).select("lang", "hash"), "language-sample")
    rows = (
        usable.select(F.col("lang").cast("string").alias("lang"), "text", F.xxhash64("text").alias("hash"))
        .join(small_side(chosen), ["lang", "hash"], "left_semi")
        .dropDuplicates(["lang", "hash"])
        .collect()
    )
    return sorted((row.text, row.lang) for row in rows)


def fitted(documents: DataFrame, per_language: int = SAMPLE) -> Field:
    """A field fitted to a bounded sample of the documents with a language."""
    model = trained(sampled(documents, per_language))
    model.name = uuid.uuid4().hex
    give_back()
    return model


def word_languages(text: str, model: Field) -> list[tuple[str, str, float]]:
    """Every word of a text with its most probable language and that probability."""
    words = words_of(text)
    if not words or not model.languages:
        return []
    p = marginals(model.emissions(words), np.array([len(words)]), model.transitions)
    return [(w, model.languages[int(k)], float(q)) for w, k, q in zip(words, p.argmax(1), p.max(1))]


def identify(documents: DataFrame, model: Field, spelt: bool = False) -> DataFrame:
    """doc_id, hash (of the text; tells rows of one id apart), lang_pred and score.

    With ``spelt`` also fits: whether the text is spelt like one of the languages.
    """

    def scores() -> WordScores:
        return held_by_worker(f"language {model.name} {spelt}", lambda: WordScores(model, spelt))

    def identified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[str] = []
            certain: list[float] = []
            fit: list[bool] | None = [] if spelt else None
            held: list[list[str]] = []
            waiting = 0
            for text in batch.column(2):
                held.append(words_of(text.as_py()))
                waiting += len(held[-1])
                if waiting > SLICE_WORDS:
                    _decide(held, model, scores(), found, certain, fit)
                    held, waiting = [], 0
            _decide(held, model, scores(), found, certain, fit)
            columns = [batch.column(0), batch.column(1), pa.array(found, pa.string()), pa.array(certain, pa.float64())]
            names = ["doc_id", "hash", "lang_pred", "score"]
            if spelt:
                columns, names = [*columns, pa.array(fit, pa.bool_())], [*names, "fits"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), row_key().alias("hash"), whole_text().alias("text")
    ).mapInArrow(
        identified, "doc_id bigint, hash bigint, lang_pred string, score double" + (", fits boolean" if spelt else "")
    )


def _decide(
    texts: list[list[str]],
    model: Field,
    scores: WordScores,
    found: list[str],
    certain: list[float],
    fit: list[bool] | None = None,
) -> None:
    """Append language and score of every text, and to ``fit`` whether it is spelt like a language."""
    worded = [words for words in texts if words] if model.languages else []
    shares = np.zeros((0, max(1, len(model.languages))))
    if worded:
        sizes = np.array([len(words) for words in worded])
        rows = scores.of(worded)
        p = marginals(rows[:, : len(model.languages)], sizes, model.transitions)
        shares = np.add.reduceat(p, np.cumsum(sizes) - sizes, axis=0) / sizes[:, None]
    if fit is not None:
        good = iter(())
        if worded:
            totals = np.add.reduceat(mixed(p, rows[:, len(model.languages) :]), np.cumsum(sizes) - sizes)
            good = iter(model.spelling.fits(totals, np.array([_letters(words) for words in worded])).tolist())
        fit += [next(good) if words and model.languages else False for words in texts]
    rows = iter(shares)
    for words in texts:
        if not words or not model.languages:
            found.append(UNKNOWN)
            certain.append(0.0)
        else:
            share = next(rows)
            found.append(model.languages[int(share.argmax())])
            certain.append(min(1.0, float(share.max())))


def held_out(modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves the remainder; a null id is the empty text."""
    text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % modulus == remainder


def with_language(documents: DataFrame, model: Field) -> DataFrame:
    """The documents, all columns, whose text is in one of the learned languages."""
    found = identify(documents, model.with_spelling(), spelt=True)
    unfit = (F.col("lang_pred") == UNKNOWN) | ~F.col("fits")
    rejected = staged(found.where(unfit).select("doc_id", "hash").distinct(), "no-language")
    return matched_rows(documents, rejected, "left_anti")
