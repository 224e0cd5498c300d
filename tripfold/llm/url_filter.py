"""URL filters: longest listed rule of host and path, by Bloom filter cascades.

A rule is a host and the beginning of a path with a verdict, ``allow`` or ``block``. It fits the
host itself and all its subdomains. Every URL has a few keys that could be rules: for each shape
that occurs among the rules (labels of the host, length of the path) the host's last labels
followed by the beginning of the path. Which of them are listed is answered by a cascade of Bloom
filters for each verdict: the first level holds the listed keys; the second those keys of the corpus
that the first takes for listed though they are not; the third the listed keys that the second
takes for those; and so on until a level errs on none. The levels are built over *all* keys the
corpus has, so for its URLs the answer is exact, and judging them needs no join and no shuffle: the
filters are constants of the plan.

Keys are dealt by hash into blocks of at most ``KEYS_PER_BLOCK`` listed keys, each with a cascade
of its own, so a filter is never larger than ``BITS_PER_KEY`` times that in bits, however long the
list is; more than ``BLOCKS_PER_PASS`` blocks are applied in several passes over the pages with the
intermediate result written in between. Everything is DataFrame functions.

Host: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; ports
and user names stay in it. Path: from there up to ``?``, ``#`` or the end. The longest rule wins,
by the characters of host and path together, of equally long ones the one with the longer host, and
a key listed with both verdicts is blocked. A URL none of whose keys is listed is allowed.

Defined results: a null URL, or one without ``://``, has an empty host and path, no rule and is
allowed; repeated rows give repeated results; no rules or no pages are fine; only ``page_id`` and
``url`` are looked at. Very long URLs cost what the shapes of the rules ask for, no more.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripfold.llm.common import staged

ALLOW, BLOCK = "allow", "block"
BITS_PER_KEY = 8
HASHES = 4
KEYS_PER_BLOCK = 1_000_000
BLOCKS_PER_PASS = 8
WORD = 64


def host_and_path(url: Column) -> tuple[Column, Column]:
    text = F.coalesce(url.cast("string"), F.lit(""))
    start = F.instr(text, "://")
    rest = F.when(start > 0, F.substring(text, start + 3, F.length(text))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    after = F.substring(rest, F.length(host) + 1, F.length(rest))
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, capitals, capitals.lower()), F.regexp_extract(after, "^[^?#]*", 0)


def rule_frame(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """host, path and verdict of a short list of rules, as constants of a plan."""
    if not rules:
        return spark.range(0).selectExpr("'' AS host", "'' AS path", "'' AS verdict")
    rows = [
        F.struct(F.lit(host).alias("host"), F.lit(path).alias("path"), F.lit(verdict).alias("verdict"))
        for host, path, verdict in rules
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


# --- keys ---------------------------------------------------------------------------------


def labels_of(host: Column) -> Column:
    return F.size(F.split(host, "[.]"))


def rule_shapes(rules: DataFrame) -> list[tuple[int, int]]:
    """Label counts and path lengths that occur: bounded by the forms of rules, not their number."""
    shape = F.struct(labels_of(F.col("host")).alias("labels"), F.length("path").alias("length"))
    return [tuple(row) for row in rules.select(shape.alias("s")).distinct().select("s.*").collect()]


def candidate_keys(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """Keys of a URL of the given shapes, each with its length and that of its host."""

    def of_shape(shape: Column) -> Column:
        last = F.call_function("substring_index", host, F.lit("."), -shape["labels"])
        key = F.concat(last, F.substring(path, F.lit(1), shape["length"]))
        fits = (shape["labels"] <= labels_of(host)) & (shape["length"] <= F.length(path))
        return F.when(
            fits & (host != ""),
            F.struct(F.length(key).alias("length"), F.length(last).alias("host_length"), key.alias("key")),
        )

    if not shapes:
        return F.array().cast("array<struct<length:int,host_length:int,key:string>>")
    listed = F.array(
        *(F.struct(F.lit(n).alias("labels"), F.lit(length).alias("length")) for n, length in sorted(shapes))
    )
    return F.array_compact(F.transform(listed, of_shape))


# --- Bloom filters and their cascade --------------------------------------------------------


@dataclass(frozen=True)
class Bloom:
    """Bits of one level; ``salt`` makes its hashes its own."""

    bits: bytes
    salt: int

    def positions(self, key: Column) -> list[Column]:
        size = F.lit(len(self.bits) * 8).cast("bigint")
        return [F.pmod(F.xxhash64(key, F.lit(self.salt), F.lit(i)), size) for i in range(HASHES)]

    def may_contain(self, key: Column) -> Column:
        found = F.lit(True)
        bits = F.lit(self.bits)
        for position in self.positions(key):
            # Words are written from their highest byte on.
            place = F.shiftright(position, 6) * 8 + 7 - F.shiftright(position, 3).bitwiseAND(7)
            byte = F.conv(F.hex(F.substring(bits, (place + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
            found = found & (F.getbit(byte, position.bitwiseAND(7).cast("int")) == 1)
        return found


def bloom_of(keys: DataFrame, count: int, salt: int) -> Bloom:
    """A filter of ``count`` keys: bits are set by aggregation, word by word."""
    words = max(1, -(-count * BITS_PER_KEY // WORD))
    empty = Bloom(bytes(words * 8), salt)
    one_bit = F.call_function(
        "shiftleft", F.lit(1).cast("bigint"), F.col("position").bitwiseAND(63).cast("int")
    )
    set_bits = (
        keys.select(F.explode(F.array(*empty.positions(F.col("key")))).alias("position"))
        .groupBy(F.shiftright("position", 6).alias("word"))
        .agg(F.bit_or(one_bit).alias("bits"))
    )
    every = keys.sparkSession.range(words).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("bits"))
    dense = set_bits.union(every).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    ordered = F.sort_array(F.collect_list(F.struct("word", "bits")))
    digits = F.transform(ordered, lambda entry: F.lpad(F.hex(entry["bits"]), 16, "0"))
    row = dense.agg(F.unhex(F.array_join(digits, "")).alias("bits")).first()
    return Bloom(bytes(row.bits), salt)


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Bloom, ...]

    def contains(self, key: Column) -> Column:
        """The first level a key is not in decides: listed after an even one, else not."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for number in range(len(self.levels), 0, -1):
            level = self.levels[number - 1]
            answer = F.when(level.may_contain(key), answer).otherwise(F.lit(number % 2 == 0))
        return answer


def cascade_of(keys: DataFrame) -> Cascade:
    """A cascade for (key, listed) rows, exact for each of them.

    Level by level the keys of one side that all levels so far claim are encoded; each level
    lets a small share of the other side through, so there are about log(keys) levels.
    """
    levels: list[Bloom] = []
    while True:
        encodes_listed = len(levels) % 2 == 0
        wanted = keys.where(F.col("listed") if encodes_listed else ~F.col("listed"))
        for level in levels:
            wanted = wanted.where(level.may_contain(F.col("key")))
        count = wanted.count()
        if not count:
            return Cascade(tuple(levels))
        levels.append(bloom_of(wanted, count, len(levels)))


# --- judging ------------------------------------------------------------------------------


def judge(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """page_id, host, path, rule (null if none fits) and verdict of every page."""
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    rules = rules.select(
        F.translate("host", capitals, capitals.lower()).alias("host"), "path", "verdict"
    )
    shapes = rule_shapes(rules)
    candidates = candidate_keys(F.col("host"), F.col("path"), shapes)
    listed = rules.groupBy(F.concat("host", "path").alias("key")).agg(
        *(F.max(F.col("verdict") == verdict).alias(verdict) for verdict in (ALLOW, BLOCK))
    )
    blocks = max(1, -(-listed.count() // KEYS_PER_BLOCK))

    def block_of(key: Column) -> Column:
        return F.pmod(F.xxhash64(key, F.lit("block")), F.lit(blocks).cast("bigint"))

    # The complete universe: every key of the corpus or the list, and which verdicts it has.
    no = F.lit(False)
    universe = staged(
        urls.select(F.explode(candidates).alias("candidate"))
        .select("candidate.key", no.alias(ALLOW), no.alias(BLOCK))
        .union(listed.select("key", ALLOW, BLOCK))
        .groupBy("key")
        .agg(F.max(ALLOW).alias(ALLOW), F.max(BLOCK).alias(BLOCK))
        .withColumn("block_no", block_of(F.col("key")))
        .sortWithinPartitions("block_no"),
        "url-keys",
    )
    best = F.lit(None).cast("struct<length:int,host_length:int,key:string,verdict:string>")
    judged = urls.withColumn("best", best)
    for block in range(blocks):
        own = universe.where(F.col("block_no") == block)
        cascades = {
            verdict: cascade_of(own.select("key", F.col(verdict).alias("listed")))
            for verdict in (BLOCK, ALLOW)
        }
        judged = judged.withColumn("best", _better(F.col("best"), candidates, cascades, block_of, block))
        if (block + 1) % BLOCKS_PER_PASS == 0 and block + 1 < blocks:
            judged = staged(judged, "url-verdicts")
    return judged.select(
        "page_id",
        "host",
        "path",
        F.col("best.key").alias("rule"),
        F.coalesce("best.verdict", F.lit(ALLOW)).alias("verdict"),
    )


def _better(best: Column, candidates: Column, cascades: dict, block_of, block: int) -> Column:
    """The longest of what was found so far and the candidates that a block lists."""

    def found(candidate: Column) -> Column:
        key = candidate["key"]
        verdict = F.lit(None).cast("string")
        for name in (ALLOW, BLOCK):  # the later one is asked first
            verdict = F.when(cascades[name].contains(key), F.lit(name)).otherwise(verdict)
        return F.struct(
            candidate["length"].alias("length"),
            candidate["host_length"].alias("host_length"),
            key.alias("key"),
            verdict.alias("verdict"),
        )

    own = F.filter(candidates, lambda candidate: block_of(candidate["key"]) == block)
    listed = F.filter(F.transform(own, found), lambda entry: entry["verdict"].isNotNull())
    return F.array_max(F.array_compact(F.concat(F.array(best), listed)))
