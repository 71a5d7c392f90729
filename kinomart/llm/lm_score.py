"""Language model scores by context-tree weighting over bytes.

A byte is nine binary decisions: whether the text ends, then the byte's bits from the highest on.
Each decision has, for each context of the last 0 to `depth` bytes, a Krichevsky-Trofimov estimate
from the zeros and ones the training texts show there. Context-tree weighting mixes the estimates
of all depths: a context's weighted probability is half its own estimate plus half the product of
its longer contexts' weighted probabilities, which gives each depth its weight in a prediction. A
context that training never showed has no estimate, and the mix ends above it.

All counts follow from counts of byte strings of length depth + 1. Texts are dealt to blocks of
bounded size. Each block reports its distinct strings and words; these are counted over the corpus,
the tree is weighted from the longest contexts to the empty one and back, its upper part as tables
and each lower part in one task, and each block gets back the log probabilities of its own strings
and the counts of its own words. No table goes to every task.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinomart.llm.byte_texts import EDGE, WIDTH, Places, Texts
from kinomart.llm.common import small_batches, stored

DEPTH = 5
#: Contexts of this length and longer are weighted within tasks, shorter ones as tables.
SUFFIX = 3
GROUP_GRAMS = 100_000
#: Bytes of text in a block, which one task holds at a time, and of a slice of it.
BLOCK, SLICE = 8 << 20, 256 << 10
#: Blocks that one task counts, one after the other, if there are enough for all cores.
COUNTED = 3
#: Rows of a batch that goes from a task's Python worker to Spark.
BATCH_ROWS = 50_000
#: Keys of words are negative, 63 bits of hash; those of byte strings are not.
WORD = np.iinfo(np.int64).min
END_WORD = -1
#: Numbers of blocks that one list holds.
LISTED = 4096


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys of several (keys, counts), and their sums."""
    keys = np.concatenate([np.zeros(0, np.int64), *(k for k, _ in parts)])
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    # The parts are sorted: a stable sort merges them.
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    heads = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[heads], np.add.reduceat(np.concatenate([n for _, n in parts])[order], heads)


def _gathered(parts: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The same for many parts, merged as they come: each part held is more than twice the next, so
    that all of them are about as large as their distinct keys."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for part in parts:
        held.append(part)
        while len(held) > 1 and len(held[-2][0]) <= 2 * len(held[-1][0]):
            held[-2:] = [_merged(held[-2:])]
    return _merged(held)


def _counted(keys: np.ndarray, taught: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, and how many of each count."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    order = np.sort(keys)
    heads = np.flatnonzero(np.r_[True, order[1:] != order[:-1]])
    distinct = order[heads]
    counts = np.diff(np.r_[heads, len(order)])
    known = np.sort(keys[~taught])
    if len(known):
        heads = np.flatnonzero(np.r_[True, known[1:] != known[:-1]])
        counts[np.searchsorted(distinct, known[heads])] -= np.diff(np.r_[heads, len(known)])
    return distinct, counts


def _words(parts: Texts) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The keys and the text of each word, slice by slice."""
    for part in parts.slices(SLICE):
        hashes, owner = parts.words(*part)
        yield hashes | WORD, owner.astype(np.int32)


def _word_counts(words: Iterable[tuple[np.ndarray, np.ndarray]], taught: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    end = (np.array([END_WORD]), np.array([int(taught.sum())]))
    return _merged([end, _gathered(_counted(keys, taught[owner]) for keys, owner in words)])


def _gram_counts(parts: Texts, taught: np.ndarray, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for part in parts.slices(SLICE):
        codes, owner = parts.grams(*part, depth)
        yield _counted(codes, taught[owner])


def _block_counts(parts: Texts, taught: np.ndarray, depth: int):
    """Distinct grams and words of a block, each with its number in the training texts."""
    return _gathered(_gram_counts(parts, taught, depth)), _word_counts(_words(parts), taught)


def _batched(*tables: pa.Table) -> pa.Table:
    """The rows of all tables, in batches that neither Python nor Spark has to hold at once."""
    batches = [b for t in tables for b in t.to_batches(max_chunksize=BATCH_ROWS)]
    return pa.Table.from_batches(batches, tables[0].schema)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lower-cases each text and compresses it for its way to its block."""
    codec = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        packed = [codec.compress(t.as_buffer().to_pybytes().lower()) for t in batch.column("text")]
        columns = [batch.column(c) for c in ("block", "doc_id", "taught")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(packed, pa.binary())], names=["block", "doc_id", "taught", "packed"])


def _unpacked(table: pa.Table) -> Texts:
    codec = zstandard.ZstdDecompressor()
    data, ends = bytearray(), [0]
    for packed in table["packed"]:
        data += codec.decompress(packed.as_buffer())
        ends.append(len(data))
    buffers = [None, pa.py_buffer(np.array(ends, np.int64)), pa.py_buffer(data)]
    return Texts(pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, buffers), lower=False)


def _report(depth: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        counts = _block_counts(_unpacked(table), table["taught"].to_numpy(), depth)
        block = np.int32(key[0].as_py())
        return _batched(*(pa.table({"block": np.full(len(keys), block), "key": keys, "seen": seen}) for keys, seen in counts))

    return run


def _sums(values: np.ndarray, owner: np.ndarray, size: int) -> np.ndarray:
    return np.bincount(owner, values, size)


def _score(depth: int, total: int, distinct: int):
    """A block's scores from its answers."""

    def run(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        parts, taught = _unpacked(table), table["taught"].to_numpy()
        size = table.num_rows
        keys, value = answers["key"].to_numpy(), answers["value"].to_numpy()
        gram = keys >= 0
        log, places, others, seen = value[gram], Places(keys[gram]), keys[~gram], value[~gram].astype(np.int64)
        # The answers are copied, and what strings need is let go before words are looked at.
        del answers, keys, value, gram
        score, base, tokens, known = (np.zeros(size) for _ in range(4))
        floor = np.log10(total + distinct + 1)
        for part in parts.slices(SLICE):
            codes, owner = parts.grams(*part, depth)
            score += _sums(log[places.find(codes)], owner, size)
        del log, places
        # Words of this block alone are not sent: their counts are the block's own.
        words = list(_words(parts))
        word, count = _word_counts(words, taught)
        count[np.searchsorted(word, others)] = seen
        places = Places(word)
        for hashes, owner in words:
            c = count[places.find(hashes)]
            base += _sums(np.log10(c + 1.0) - floor, owner, size)
            tokens += np.bincount(owner, minlength=size)
            known += _sums(c > 0, owner, size)
        c = count[np.searchsorted(word, END_WORD)]
        return pa.table(
            {
                "doc_id": table["doc_id"],
                "held_out": pa.array(~taught),
                "n_tokens": (tokens + 1).astype(np.int64),
                "n_known": (known + (c > 0)).astype(np.int64),
                "train_tokens": np.full(size, total, np.int64),
                "base_score": base + np.log10(c + 1.0) - floor,
                "score": score,
                "n_bytes": np.diff(parts.ends).astype(np.int64),
            }
        )

    return run


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln of the gamma function for x > 0, by Stirling's series at x + 8."""
    y = x + 8
    product = np.multiply.reduce([x + k for k in range(8)])
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - np.log(product)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of so many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - math.log(math.pi) - log_gamma(zeros + ones + 1)


def decisions(symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node, bit, is one) of the nine decisions of each symbol; node 0 is the end, which is the
    last decision of an EDGE."""
    step = np.arange(8)
    value = symbol[:, None] & 255
    node = np.c_[np.zeros(len(symbol), np.int64), (value >> (8 - step)) + (1 << step)]
    end = symbol == EDGE
    bit = np.c_[end, value >> (7 - step) & 1].astype(np.int64)
    valid = np.ones(node.shape, bool)
    valid[end, 1:] = False
    return node, bit, valid


class Level:
    """The decisions in contexts of one length: counts, estimates and weights."""

    def __init__(self, codes: np.ndarray, zeros: np.ndarray, ones: np.ndarray, longer: np.ndarray | None):
        self.codes, self.zeros, self.ones = codes, zeros, ones
        self.estimate = (ones + 0.5) / (zeros + ones + 1)
        own = log_kt(zeros, ones)
        if longer is None:
            self.weighted, self.stay = own, np.ones(len(codes))
        else:  # the mean of the own estimate and the longer contexts' product
            gap = longer - own
            self.weighted = np.maximum(longer, own) + np.log1p(np.exp(-np.abs(gap))) - math.log(2)
            self.stay = 1 / (1 + np.exp(np.minimum(gap, 700)))

    def shorter(self, length: int) -> tuple[Level, np.ndarray]:
        """The level of contexts of `length` symbols that these end in, and their places there."""
        low = (1 << (WIDTH * length + WIDTH)) - 1
        codes, place = np.unique(self.codes & low, return_inverse=True)
        sums = [np.bincount(place, x, len(codes)) for x in (self.zeros, self.ones, self.weighted)]
        return Level(codes, *sums), place


def _levels(key: np.ndarray, seen: np.ndarray, depth: int, suffix: int):
    """The levels from `depth` down to `suffix`, the places of each in the next, and the decisions of
    each gram with their places in the first level. A code is a context and a node."""
    node, bit, valid = decisions(key & ((1 << WIDTH) - 1))
    all_codes = (key >> WIDTH << WIDTH)[:, None] | node
    codes, place = np.unique(all_codes, return_inverse=True)
    place = place.reshape(node.shape)
    count = np.repeat(seen, 9).reshape(node.shape) * valid
    zeros = np.bincount(place.ravel(), (count * (bit == 0)).ravel(), len(codes))
    ones = np.bincount(place.ravel(), (count * (bit == 1)).ravel(), len(codes))
    levels, places = [Level(codes, zeros, ones, None)], []
    for length in range(depth - 1, suffix - 1, -1):
        level, at = levels[-1].shorter(length)
        levels.append(level)
        places.append(at)
    return levels, places, (place, bit, valid)


def _lower(depth: int, suffix: int):
    """The shortest contexts' level of a group of grams."""

    def run(table: pa.Table) -> pa.Table:
        top = _levels(table["key"].to_numpy(), table["seen"].to_numpy(), depth, suffix)[0][-1]
        return _batched(pa.table({"code": top.codes, "a": top.zeros, "b": top.ones, "weighted": top.weighted, "stay": top.stay}))

    return run


def _finish(depth: int, suffix: int):
    """The log10 probabilities of a group's grams, given the mix over its shortest contexts."""

    def run(key: tuple, table: pa.Table, mixes: pa.Table) -> pa.Table:
        keys = table["key"].to_numpy()
        if not len(keys):
            return pa.table({"key": pa.array([], pa.int64()), "value": pa.array([], pa.float64())})
        levels, places, (place, bit, valid) = _levels(keys, table["seen"].to_numpy(), depth, suffix)
        order = np.argsort(mixes["code"].to_numpy())
        mixed, reach, one = (mixes[c].to_numpy()[order] for c in ("mixed", "reach", "one"))
        for above, level, at in zip(levels[:0:-1], levels[-2::-1], places[::-1], strict=True):
            mixed = (mixed + reach * above.stay * above.estimate)[at]
            reach = (reach * (1 - above.stay))[at]
            one = np.where(level.zeros + level.ones > 0, mixed + reach * level.estimate, one[at])
        chance = np.where(bit == 1, one[place], 1 - one[place])
        value = np.where(valid, np.log10(chance), 0).sum(axis=1)
        return _batched(pa.table({"key": keys, "value": value}))

    return run


def gram_scores(grams: DataFrame, depth: int, groups: int) -> DataFrame:
    """key, value: the log10 probability of the last symbol of each gram (key, seen) behind the
    others, by the tree that all grams' `seen` make."""
    suffix = min(SUFFIX, depth)
    low = (1 << (WIDTH * suffix)) - 1

    def group(context: Column) -> Column:
        return F.pmod(F.xxhash64(context), F.lit(groups)).alias("group")

    dealt = grams.select(group(F.shiftright("key", WIDTH).bitwiseAND(F.lit(low))), "key", "seen")
    lower = dealt.groupBy("group").applyInArrow(
        _lower(depth, suffix), "code bigint, a double, b double, weighted double, stay double"
    )
    levels = [stored(lower)]
    for length in range(suffix - 1, -1, -1):
        level = (
            levels[-1]
            .groupBy(F.col("code").bitwiseAND(F.lit((1 << (WIDTH * length + WIDTH)) - 1)).alias("code"))
            .agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("weighted").alias("longer"))
            .mapInArrow(_shorter, "code bigint, a double, b double, weighted double, stay double")
        )
        levels.append(stored(level))
    levels.reverse()
    estimate = (F.col("b") + 0.5) / (F.col("a") + F.col("b") + 1)
    path = levels[0].select("code", F.lit(0.0).alias("mixed"), F.lit(1.0).alias("reach"), "stay", estimate.alias("own"), estimate.alias("one"))
    for length in range(1, suffix + 1):
        above = path.select(
            F.col("code").alias("parent"),
            (F.col("mixed") + F.col("reach") * F.col("stay") * F.col("own")).alias("mixed"),
            (F.col("reach") * (1 - F.col("stay"))).alias("reach"),
            F.col("one").alias("fallback"),
        )
        parent = F.col("code").bitwiseAND(F.lit((1 << (WIDTH * (length - 1) + WIDTH)) - 1))
        here = levels[length].select("code", "stay", "a", "b", estimate.alias("own"), parent.alias("parent"))
        mixed = F.col("mixed") + F.col("reach") * F.col("own")
        path = here.join(above, "parent").select(
            "code", "mixed", "reach", "stay", "own", F.when(F.col("a") + F.col("b") > 0, mixed).otherwise(F.col("fallback")).alias("one")
        )
    mixes = path.select(group(F.shiftright("code", WIDTH)), "code", "mixed", "reach", "one")
    return (
        dealt.groupBy("group")
        .cogroup(mixes.groupBy("group"))
        .applyInArrow(_finish(depth, suffix), "key bigint, value double")
    )


def _shorter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        code, zeros, ones, longer = (batch.column(c).to_numpy() for c in ("code", "a", "b", "longer"))
        level = Level(code, zeros, ones, longer)
        columns = {"code": code, "a": zeros, "b": ones, "weighted": level.weighted, "stay": level.stay}
        yield pa.RecordBatch.from_pydict(columns)


def dealt(rows: DataFrame, blocks: int, together: int) -> DataFrame:
    """The rows with `together` neighbouring blocks in each partition, which `task` numbers. By hash some
    tasks would sort and sum the strings of several times as many blocks as others."""
    tasks = -(-blocks // together)
    return rows.withColumn("task", F.expr(f"int(block div {together})")).repartitionById(tasks, "task")


def score(docs: DataFrame, held_out: Column, depth: int = DEPTH, block: int = BLOCK) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes: one row per row
    of `docs` (doc_id bigint, text).

    Texts are lower-cased in A-Z; null counts as empty, which has one token, the end. Rows for which
    `held_out` is true are scored but teach nothing; repeated rows count and are scored each. `score`
    is the log10 probability of the whole text and its end; divided by n_bytes and log10 2 it is the
    code length per byte. base_score is the sum of log10((c + 1) / (N + V + 1)) over words and end.
    Words are told apart by 63-bit hashes. No rows give no rows.
    """
    rows = small_batches(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"), (~held_out).alias("taught"))
    spark = docs.sparkSession
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    least = 2 * spark.sparkContext.defaultParallelism
    blocks = max(least, -(-size // block))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))
    rows = rows.mapInArrow(_pack, "block int, doc_id bigint, taught boolean, packed binary")
    reports = dealt(rows, blocks, min(COUNTED, blocks // least)).groupBy("block", "task").applyInArrow(_report(depth), "block int, key bigint, seen bigint")
    # A string that occurs everywhere has several lists of blocks, none longer than LISTED.
    lists = stored(
        reports.groupBy("key", F.expr(f"block div {LISTED}").alias("part")).agg(
            F.sum("seen").alias("seen"), F.collect_list("block").alias("blocks")
        )
    )
    sums = lists.groupBy("key").agg(F.sum("seen").alias("seen"), F.sum(F.size("blocks")).alias("n"))
    grams = stored(sums.where("key >= 0").select("key", "seen"))
    words = stored(sums.where("key < 0"))
    known = words.where("seen > 0").agg(F.sum("seen").alias("n"), F.count("*").alias("v")).first()
    groups = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-grams.count() // GROUP_GRAMS))
    values = gram_scores(grams, depth, groups).unionByName(
        words.where("n > 1").select("key", F.col("seen").cast("double").alias("value"))
    )
    answers = lists.select("key", "blocks").join(values, "key").select(F.explode("blocks").alias("block"), "key", "value")
    return (
        rows.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(
            _score(depth, known.n or 0, known.v or 0),
            "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
            "base_score double, score double, n_bytes bigint",
        )
    )
