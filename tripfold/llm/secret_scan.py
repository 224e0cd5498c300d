"""Secret scans: base rules, and a character convolutional network for what they miss.

Base rules find assignments to secret names, access key ids and long hex strings. Everything else
that could be a credential is a candidate: eight or more characters of the usual alphabet in a
row, unless they are plain words, lower-case or capitalised, with signs between them. What a
base span leaves of such a run is a candidate of its own. A small convolutional network in numpy
reads the characters of the candidate with its surrounding context and says how secret-like it is. It is
trained on labelled findings: the base findings in the passages around long tokens of all texts
(their value alone is a secret, whatever names it), generated credentials of public formats, and
tokens that are no secrets, both set into those passages.

Every different passage is learned from. Passages are dealt to shards by their hash; in each of
``ROUNDS`` rounds every shard goes on from the same network, and what they make of it is averaged,
weighted by windows. The first network, where the rounds begin, is one fitted on the driver to a
bounded number of passages: networks averaged have to begin from one that is already near. A fifth
of the windows, by their checksum, is never learned from, neither first nor in the rounds. Counted
over all shards, it calibrates the scores (Platt scaling) and sets the threshold: the highest grade
of score that keeps the wanted recall there. A candidate at or above it becomes a span of kind
``network``. The network does not depend on how rows lie in partitions.

Positions are code points, ends exclusive. Defined results: a null or empty text has no spans;
repeated rows give repeated results; other columns are not looked at; an empty table gives no
rows. Texts are scanned whole; the network sees at most ``WIDTH`` characters around a candidate's
start and reads longer candidates window by window, the highest score counting.
"""

from __future__ import annotations

import bisect
import hashlib
import random
import re
import string
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripfold.llm.common import staged, whole_text

# The base rules.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "network")
ASSIGN_CHARS, ACCESS_CHARS = 6, 20

# Runs of credential characters that are not plain words: with a digit in them,
# or with a capital after another letter.
CANDIDATE = re.compile(
    r"(?<![A-Za-z0-9+/_.=~-])(?=[A-Za-z+/_.=~-]*?(?:[0-9]|[A-Za-z][A-Z]))[A-Za-z0-9+/_.=~-]{8,}"
)
UNLIKE_WORDS = re.compile(r"[0-9]|[A-Za-z][A-Z]")
CANDIDATE_CHARS = 8
CONSONANTS, VOWELS = "bcdfghklmnprstvw", "aeiou"
WORD = re.compile(r"\b[a-z]{3,12}\b")

WIDTH, BEFORE = 64, 24
FILTERS, SPAN = 24, 5
RECALL = 0.98
SAMPLE_PASSAGES = 3000  # the first network's
GENERATED = 2000  # credentials made up to learn from, at least; twice as many plain tokens
BATCH = 128  # windows of a training step
RATE = 0.01
HELD_OUT = 5  # one window of so many calibrates
# Rounds over all passages.
ROUNDS, ROUND_EPOCHS = 3, 4
SHARD_PASSAGES = 512
UNIT = 1 << 24  # parameters are added up as whole numbers of this fraction: no order matters
# Raw scores are counted in grades of 1 / GRADES; beyond the outer ones nothing is told apart.
GRADES, OUTER = 64, 64 * 32
# What passages for labelling are taken around, and how much on either side.
CORE = "([0-9a-f]{24,200}|AKIA[A-Z0-9]{16,100}|[0-9]{8,30})"
LEFT, RIGHT = 60, 80

Span = tuple[int, int, int]  # start, rank of the kind, end


def base_spans(text: str) -> list[Span]:
    spans = [
        (m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_CHARS
    ]
    if "AKIA" in text:
        spans += [
            (m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_CHARS
        ]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def candidates(text: str, taken: list[Span]) -> list[tuple[int, int]]:
    """Start and end of credential-like runs, or of what the taken spans leave of them."""
    ends = np.maximum.accumulate([end for _, _, end in taken]).tolist() if taken else []
    starts = [start for start, _, _ in taken]
    found = []
    for m in CANDIDATE.finditer(text):
        start, stop = m.span()
        first = bisect.bisect_right(ends, start)  # the first span that ends in or after the run
        if first == len(starts) or starts[first] >= stop:
            pieces = [(start, stop)]
        else:
            pieces, at = [], start
            for low, _, high in taken[first:]:
                if low >= stop:
                    break
                pieces.append((at, min(low, stop)))
                at = max(at, high)
            pieces.append((at, stop))
        for low, high in pieces:
            high = low + len(text[low:high].rstrip(".-="))
            if high - low >= CANDIDATE_CHARS and UNLIKE_WORDS.search(text, low, high):
                found.append((low, high))
    return found


def windows_of(text: str, start: int, end: int) -> list[str]:
    """The candidate with its context, in as many windows as its length needs."""
    inner = WIDTH - BEFORE
    return [
        (text[max(0, at - BEFORE) : at]).rjust(BEFORE, "\0") + text[at : at + inner].ljust(inner, "\0")
        for at in range(start, end, inner)
    ]


# Characters as the network sees them: printable ASCII, nothing, anything else.
_ALPHABET = 98
_CODES = np.full(128, 1, dtype=np.int64)
_CODES[0] = 0
_CODES[32:127] = np.arange(2, 97)
_CODES[10] = 97


def encoded(windows: list[str]) -> np.ndarray:
    points = np.frombuffer("".join(windows).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    codes = _CODES[np.minimum(points, 127)]
    codes = np.where(points > 126, 1, codes)
    return codes.reshape(len(windows), WIDTH)


@dataclass
class Network:
    """Embedded characters and position, convolution, ReLU, maximum over places, logistic output."""

    filters: np.ndarray  # (SPAN, alphabet, FILTERS): a one-hot convolution
    bias: np.ndarray
    out: np.ndarray  # (2 * FILTERS,): filters in the context, filters in the candidate
    out_bias: float
    scale: float = 1.0
    shift: float = 0.0
    threshold: float = 0.5

    def flat(self) -> np.ndarray:
        return np.concatenate([self.filters.ravel(), self.bias, self.out, [self.out_bias]]).astype(float)

    def filled(self, values: np.ndarray) -> Network:
        filters, bias, out, out_bias = np.split(
            values.astype(np.float32), np.cumsum([self.filters.size, self.bias.size, self.out.size])
        )
        return replace(
            self, filters=filters.reshape(self.filters.shape), bias=bias, out=out, out_bias=float(out_bias[0])
        )

    def _pooled(self, codes: np.ndarray):
        places = WIDTH - SPAN + 1
        total = self.bias[None, None, :].astype(np.float32)
        for k in range(SPAN):
            total = total + self.filters[k][codes[:, k : k + places]]
        active = np.maximum(total, 0)
        context, inner = active[:, : BEFORE - 1], active[:, BEFORE - 1 :]
        return active, np.concatenate([context.max(axis=1), inner.max(axis=1)], axis=1)

    def raw(self, codes: np.ndarray) -> np.ndarray:
        parts = [
            self._pooled(codes[i : i + 2048])[1] @ self.out + self.out_bias
            for i in range(0, len(codes), 2048)
        ]
        return np.concatenate(parts) if parts else np.zeros(0)

    def scaled(self, raw: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.scale * raw + self.shift)))

    def probability(self, codes: np.ndarray) -> np.ndarray:
        return self.scaled(self.raw(codes))


def held_out(windows: list[str]) -> np.ndarray:
    """Which windows calibrate; equal windows are on one side, whatever passage they come from."""
    sums = [zlib.crc32(window.encode("utf-8", "surrogatepass")) for window in windows]
    return np.array(sums, dtype=np.int64) % HELD_OUT == 0


def trained(windows: list[str], labels: np.ndarray, seed: int = 7, epochs: int = 12) -> Network:
    """A network from scratch; the held-out windows calibrate and set the threshold."""
    rng = np.random.default_rng(seed)
    codes, held = encoded(windows), held_out(windows)
    net = Network(
        rng.normal(0, 0.1, (SPAN, _ALPHABET, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32),
        rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32),
        0.0,
    )
    _learn(net, codes[~held], labels[~held], rng, epochs)
    _calibrate(net, *_graded(net.raw(codes[held]), labels[held]))
    return net


def _learn(
    net: Network, codes: np.ndarray, labels: np.ndarray, rng: np.random.Generator, epochs: int, rate: float = RATE
) -> None:
    """Adam on the logistic loss, both labels weighing the same; changes the network in place."""
    used = np.arange(len(codes))
    parameters = [net.filters, net.bias, net.out]
    first = [np.zeros_like(p) for p in parameters]
    second = [np.zeros_like(p) for p in parameters]
    weight = np.where(labels > 0, 0.5 / max(labels.mean(), 1e-6), 0.5 / max(1 - labels.mean(), 1e-6))
    step, places = 0, WIDTH - SPAN + 1
    for _ in range(epochs):
        rng.shuffle(used)
        for i in range(0, len(used), BATCH):
            rows = used[i : i + BATCH]
            own = codes[rows]
            active, pooled = net._pooled(own)
            p = 1 / (1 + np.exp(-(pooled @ net.out + net.out_bias)))
            error = ((p - labels[rows]) * weight[rows] / len(rows)).astype(np.float32)
            d_pooled = error[:, None] * net.out[None, :]
            d_active = np.zeros_like(active)
            for part, lo, hi in ((0, 0, BEFORE - 1), (1, BEFORE - 1, places)):
                slab = active[:, lo:hi]
                top = slab.argmax(axis=1) + lo
                grad = d_pooled[:, part * FILTERS : (part + 1) * FILTERS]
                n, f = np.indices(top.shape)
                d_active[n, top, f] += grad * (active[n, top, f] > 0)
            d_filters = np.zeros_like(net.filters)
            for k in range(SPAN):
                np.add.at(d_filters[k], own[:, k : k + places].ravel(), d_active.reshape(-1, FILTERS))
            gradients = [d_filters + 1e-4 * net.filters, d_active.sum(axis=(0, 1)), pooled.T @ error]
            step += 1
            for value, gradient, m, v in zip(parameters, gradients, first, second):
                m += 0.1 * (gradient - m)
                v += 0.001 * (gradient * gradient - v)
                value -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            net.out_bias -= rate * float(error.sum())


def _graded(raw: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Grades of raw scores, whether they are a secret's, and how many windows have both."""
    grade = np.floor(np.clip(raw * GRADES, -OUTER, OUTER)).astype(np.int64)
    pairs, n = np.unique(2 * grade + (labels > 0), return_counts=True)
    return pairs >> 1, pairs & 1 > 0, n


def _calibrate(net: Network, grade: np.ndarray, secret: np.ndarray, n: np.ndarray) -> None:
    net.scale, net.shift = 1.0, 0.0
    raw, share = (grade + 0.5) / GRADES, n / max(n.sum(), 1)
    for _ in range(300):  # Platt scaling by gradient steps
        p = 1 / (1 + np.exp(-(net.scale * raw + net.shift)))
        net.scale -= 0.05 * float(((p - secret) * raw * share).sum())
        net.shift -= 0.05 * float(((p - secret) * share).sum())
    order = np.argsort(grade[secret])
    below = np.cumsum(n[secret][order])  # secrets up to each grade
    if len(below):
        lowest = grade[secret][order][np.searchsorted(below, int((1 - RECALL) * below[-1]), "right")]
        edge = np.array([lowest / GRADES], np.float32)  # the scores' own type
        net.threshold = float(net.scaled(edge)[0]) if lowest > -OUTER else 0.0


def _generated(rng: random.Random, words: Sequence[str] = (), count: int = GENERATED) -> list[tuple[str, int]]:
    """``count`` credentials of public formats, and twice as many tokens of ordinary text that are none.

    The latter are made of the given words, and of random syllables.
    """
    alnum, b64 = string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/"
    make = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    digits = lambda n: make(string.digits, n)

    def word() -> str:
        if words and rng.random() < 0.7:
            return rng.choice(words)
        syllable = lambda: rng.choice(CONSONANTS) + rng.choice(VOWELS) + rng.choice(["", rng.choice(CONSONANTS)])
        return "".join(syllable() for _ in range(rng.randint(1, 3)))

    secrets = [
        lambda: "ghp_" + make(alnum, 36),
        lambda: "sk_live_" + make(alnum, 24),
        lambda: "xoxb-" + digits(11) + "-" + make(alnum, 24),
        lambda: "AIza" + make(alnum + "_-", 35),
        lambda: "eyJ" + make(alnum, 20) + "." + make(alnum, 30) + "." + make(alnum + "_-", 30),
        lambda: make(b64, 40),
        lambda: make(alnum, rng.randint(20, 44)),
        lambda: make(string.hexdigits.lower(), rng.choice((32, 40, 64))),
        lambda: make("0123456789ABCDEF", rng.choice((32, 40, 64))),
        lambda: make(alnum + "_-", rng.randint(18, 30)),
        lambda: make(string.ascii_letters, rng.randint(16, 40)),
        lambda: make(alnum, rng.randint(12, 20)),
    ]
    plain = [
        lambda: digits(16),
        lambda: digits(rng.randint(8, 14)),
        lambda: ".".join(str(rng.randint(0, 255)) for _ in range(4)),
        lambda: f"{rng.randint(1900, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}",
        lambda: f"{word()}.{digits(2)}",
        lambda: f"mail{digits(1)}.{word()}.com",
        lambda: f"{word()}/{word()}/{digits(4)}/{word()}.html",
        lambda: f"v{digits(1)}.{digits(2)}.{digits(1)}-{word()}",
        lambda: f"{word()}_{word()}_{digits(3)}",
        lambda: f"{word()}-{word()}-{digits(3)}",
        lambda: f"555-{digits(4)}",
        lambda: word() + word() + digits(2),
        lambda: f"{digits(3)}-{digits(3)}-{digits(4)}",
        lambda: f"{digits(1)}.{digits(6)}",
        lambda: f"{word()}{digits(2)}.{word()}.{word()}",
        lambda: f"ISBN-{digits(3)}-{digits(9)}",
        lambda: word().capitalize() + word().capitalize() + rng.choice(["", word().capitalize()]),
        lambda: word() + word().capitalize() + rng.choice(["", f".{word()}"]),
        lambda: (word() + word()).upper(),
        lambda: (word() + word() + word()).upper(),
        lambda: (word() + word()).upper() + rng.choice([".", "=", "-"]) + word().upper(),
        lambda: f"{word().upper()}-{word()}{rng.choice(['', '-' + word()])}",
        lambda: f"{make(string.ascii_uppercase, 3)}-{word().upper()}/{word().upper()}",
        lambda: "-" * rng.randint(4, 30) + word().upper() + "-" * rng.randint(4, 9),
        lambda: f"{word()}.{word()}/{word().capitalize()}_{word().capitalize()}{digits(1)}",
    ]
    return [(rng.choice(secrets)(), 1) for _ in range(count)] + [(rng.choice(plain)(), 0) for _ in range(2 * count)]


def labelled_findings(texts: list[str], seed: int = 7, count: int = GENERATED) -> tuple[list[str], np.ndarray]:
    """Windows with labels: base findings, generated tokens in contexts of the texts, plain tokens."""
    rng = random.Random(seed)
    windows, labels, places = [], [], []
    for text in texts:
        spans = base_spans(text)
        for start, kind, end in spans:
            if kind:  # the value itself, without the name before it
                windows += windows_of(text, start, end)[:1]
                labels.append(1)
        if text:
            places.append(text)
    words = sorted({word for text in texts for word in WORD.findall(text)})
    generated = _generated(rng, words, count)
    rng.shuffle(generated)
    rng.shuffle(places)
    for i, (token, label) in enumerate(generated):  # every text is a context in its turn
        text = places[i % len(places)] if places else ""
        at = text.find(" ", rng.randrange(len(text) or 1)) + 1
        left, right = text[max(0, at - 40) : at], text[at : at + 60]
        left += rng.choice(["", "", "", '"', "key: ", "= ", "Bearer ", "(", "no. "])
        joined = left + token + rng.choice([" ", ". ", '" ', ", ", ")"]) + right
        windows += windows_of(joined, len(left), len(left) + len(token))[:1]
        labels.append(label)
    return windows, np.array(labels, dtype=float)


def spans_of(text: str, net: Network) -> tuple[list[Span], list[Span]]:
    """Base spans, and the network's on top of them."""
    base = base_spans(text)
    places = candidates(text, base)
    if not places:
        return base, []
    windows, owner = [], []
    for i, (start, end) in enumerate(places):
        own = windows_of(text, start, end)
        windows += own
        owner += [i] * len(own)
    best = np.zeros(len(places))
    np.maximum.at(best, owner, net.probability(encoded(windows)))
    return base, [
        (start, 3, end) for (start, end), score in zip(places, best) if score >= net.threshold
    ]


def _listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def passages_of(documents: DataFrame) -> DataFrame:
    """Every different passage around a long token of all texts."""
    # One pass of the pattern marks the cores; every second part between marks is one.
    mark = "\x01"
    marked = F.regexp_replace(F.translate("text", mark, " "), CORE, f"{mark}$1{mark}")
    parts = F.col("parts")
    passages = F.transform(
        F.sequence(F.lit(1), F.size(parts) - 2, F.lit(2)),
        lambda i: F.concat(
            F.right(parts[i - 1], F.lit(LEFT)), parts[i], F.left(parts[i + 1], F.lit(RIGHT))
        ),
    )
    return (
        documents.select(F.split(marked, mark).alias("parts"))
        .where(F.size("parts") > 2)
        .select(F.explode(passages).alias("passage"))
    )


def fitted(documents: DataFrame, sample: int = SAMPLE_PASSAGES, passages: DataFrame | None = None) -> Network:
    """The first network, where ``learned`` begins: from at most ``sample`` passages.

    Passages are dealt to ``sample`` bins by their hash, and the one of lowest hash stands for its
    bin: at most so many reach the driver.
    """
    passages = passages_of(documents) if passages is None else passages
    texts = (
        passages.select(F.struct(F.xxhash64("passage").alias("order"), "passage").alias("offer"))
        .groupBy(F.pmod(F.xxhash64("offer.passage", F.lit("bin")), F.lit(sample)).alias("bin"))
        .agg(F.min("offer").alias("offer"))
        .orderBy("offer")
        .select("offer.passage")
        .collect()
    )
    return trained(*labelled_findings([row.passage for row in texts]))


def learned(documents: DataFrame, sample: int = SAMPLE_PASSAGES) -> Network:
    """The network for these documents, learned from and calibrated on the passages of all of them."""
    passages = staged(passages_of(documents).distinct(), "passages")
    net = fitted(documents, sample, passages)
    shards = -(-passages.count() // SHARD_PASSAGES)
    if not shards:
        return net
    # As many partitions as shards: a shard is little to read, but some time of computing.
    dealt = passages.select(
        F.pmod(F.xxhash64("passage", F.lit("shard")), F.lit(shards)).alias("shard"), "passage"
    ).repartition(shards, "shard")
    for number in range(ROUNDS):
        net = _round(dealt, net, shards, number)
    rows = sorted(_counted(dealt, net, shards).collect())
    columns = list(zip(*((row.grade, row.secret, row.n) for row in rows)))
    if columns:
        _calibrate(net, *(np.array(column) for column in columns))
    return net


def _windows(table: pa.Table, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Codes, labels and who is held out, of a shard's passages; and the shard's number."""
    texts, shard = sorted(table.column("passage").to_pylist()), table.column("shard")[0].as_py()
    # Two tokens for every passage, and in small corpora as many as the first network had.
    count = max(-(-GENERATED // shards), -(-2 * len(texts) // 3))
    windows, labels = labelled_findings(texts, 1000 + shard, count)
    return encoded(windows), labels, held_out(windows), shard


def _round(dealt: DataFrame, net: Network, shards: int, number: int) -> Network:
    """The average of what the shards make of the network."""

    def taught(table: pa.Table) -> pa.Table:
        codes, labels, held, shard = _windows(table, shards)
        own = net.filled(net.flat())
        rng = np.random.default_rng((number, shard))
        _learn(own, codes[~held], labels[~held], rng, ROUND_EPOCHS, RATE / 2 ** (number + 1))
        n = int((~held).sum())
        values = np.rint(own.flat() * UNIT).astype(np.int64) * n
        return pa.table(
            {
                "parameter": pa.array(np.arange(len(values)), pa.int32()),
                "value": pa.array(values),
                "windows": pa.array(np.full(len(values), n), pa.int64()),
            }
        )

    # One row per parameter of the network, whatever the corpus.
    sums = (
        dealt.groupBy("shard")
        .applyInArrow(taught, "parameter int, value bigint, windows bigint")
        .groupBy("parameter")
        .agg(F.sum("value").alias("value"), F.sum("windows").alias("windows"))
        .collect()
    )
    values = net.flat()
    for row in sums:
        values[row.parameter] = row.value / (row.windows * UNIT)
    return net.filled(values)


def _counted(dealt: DataFrame, net: Network, shards: int) -> DataFrame:
    """grade, secret and n: the held-out windows of all shards by grade of score, a bounded table."""

    def graded(table: pa.Table) -> pa.Table:
        codes, labels, held, _ = _windows(table, shards)
        grade, secret, n = _graded(net.raw(codes[held]), labels[held])
        return pa.table({"grade": pa.array(grade), "secret": pa.array(secret), "n": pa.array(n, pa.int64())})

    return (
        dealt.groupBy("shard")
        .applyInArrow(graded, "grade bigint, secret boolean, n bigint")
        .groupBy("grade", "secret")
        .agg(F.sum("n").alias("n"))
    )


def scan(documents: DataFrame, net: Network | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_network, base_sha256 and spans of every document."""
    net = net or learned(documents)

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[list[int]] = [[], [], [], []]
            sums, lists = [], []
            for value in batch.column(1):
                base, more = spans_of(value.as_py(), net)
                kinds = [kind for _, kind, _ in base]
                for rank in range(3):
                    counts[rank].append(kinds.count(rank))
                counts[3].append(len(more))
                sums.append(hashlib.sha256(_listed(base).encode()).hexdigest())
                lists.append(_listed(base + more))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *(pa.array(column, pa.int64()) for column in counts),
                    pa.array(sums, pa.string()),
                    pa.array(lists, pa.string()),
                ],
                names=["doc_id", "n_assign", "n_access", "n_hex", "n_network", "base_sha256", "spans"],
            )

    return documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text")
    ).mapInArrow(
        scanned,
        "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, n_network bigint, "
        "base_sha256 string, spans string",
    )
