"""URL filters as Bloom filter cascades.

Listed keys are hosts with a path prefix. Every key the corpus can ask for (each host suffix with
each path prefix of a listed length) is known in advance, so a cascade of filters answers exactly:
the first level holds the listed keys, the second the keys of the corpus that the first one takes
for listed, the third the listed keys the second one takes for those, and so on until none is left.
Urls are then judged by looking up bits; no url is joined to a list.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinomart.llm.common import stored

HASHES = 7
BITS_PER_KEY = 10
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    """What follows the first :// up to / ? # or the end, A-Z lower-cased; empty without one."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path(url: Column) -> Column:
    """What follows the host up to ? # or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def candidate_keys(host: str, path: str, lengths: Sequence[int]) -> Column:
    """The keys that may list a url: each suffix of its host's labels with each path prefix of a
    length that occurs in the list."""
    sizes = ", ".join(map(str, sorted(set(lengths)))) or "0"
    return F.expr(
        f"""flatten(transform(sequence(1, size(split({host}, '[.]'))), i -> transform(
            filter(array({sizes}), n -> n <= length({path})),
            n -> concat(substring_index({host}, '.', -i), substring({path}, 1, n)))))"""
    )


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def positions(a: np.ndarray, b: np.ndarray, level: int, bits: int) -> np.ndarray:
    """The bits of keys with hashes a and b on a level: one row of HASHES per key."""
    salt = np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)
    x, y = _mix(a.view(np.uint64) ^ salt), _mix(b.view(np.uint64) + salt) | np.uint64(1)
    steps = np.arange(HASHES, dtype=np.uint64)
    return ((x[:, None] + steps * y[:, None]) % np.uint64(bits)).astype(np.int64)


class Cascade:
    """Levels of (bits, words); a key that fails level k (from 0) first is listed if k is odd."""

    def __init__(self, levels: Sequence[tuple[int, np.ndarray]] = ()):
        self.levels = list(levels)

    def listed(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        depth = np.zeros(len(a), np.int64)
        alive = np.arange(len(a))
        for level, (bits, words) in enumerate(self.levels):
            at = positions(a[alive], b[alive], level, bits)
            alive = alive[(words[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).all(axis=1)]
            depth[alive] = level + 1
        return depth % 2 == 1


def _encode(level: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(c).to_numpy() for c in ("a", "b"))
            at = positions(a, b, level, bits).ravel()
            word, place = np.unique(at >> 6, return_inverse=True)
            value = np.zeros(len(word), np.uint64)
            np.bitwise_or.at(value, place, np.uint64(1) << (at & 63).astype(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(value.view(np.int64))], names=["word", "value"])

    return run


def _passing(levels: list[tuple[int, np.ndarray]], first: int):
    """Keeps the keys that pass the last level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, words = levels[-1]
        for batch in batches:
            a, b = (batch.column(c).to_numpy() for c in ("a", "b"))
            at = positions(a, b, first, bits)
            passed = (words[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).all(axis=1)
            yield batch.filter(pa.array(passed))

    return run


def hashed(keys: DataFrame) -> DataFrame:
    return keys.select(F.xxhash64("key").alias("a"), F.xxhash64("key", F.lit(1)).alias("b"))


def cascade(listed: DataFrame, others: DataFrame, max_bytes: int, overlap: bool = False) -> Cascade:
    """The cascade that tells the keys `listed` from the keys `others`, both as hashes a, b.

    With `overlap` the others may hold listed keys: of those that pass the first level, which are few, the listed ones
    are taken out. The levels go to the driver and from there to the tasks; a list whose first level would take
    more than `max_bytes` has to be parted before (see `judge`)."""
    levels: list[tuple[int, np.ndarray]] = []
    inside, outside = listed, others
    while True:
        count = inside.count()
        if not count:
            break
        bits = 64 * max(1, math.ceil(count * BITS_PER_KEY / 64))
        if bits // 8 > max_bytes:
            raise ValueError(f"a level of {bits // 8} bytes; part the list further")
        level = len(levels)
        encoded = inside.mapInArrow(_encode(level, bits), "word bigint, value bigint")
        table = encoded.groupBy("word").agg(F.bit_or("value").alias("value")).toArrow()
        words = np.zeros(bits // 64, np.uint64)
        words[table.column("word").to_numpy()] = table.column("value").to_numpy().view(np.uint64)
        levels.append((bits, words))
        wrong = outside.mapInArrow(_passing(levels, level), "a bigint, b bigint")
        if overlap and not level:
            wrong = stored(wrong).join(listed, ["a", "b"], "left_anti")
        inside, outside = stored(wrong), inside
    return Cascade(levels)


def _look_up(cascades: dict[str, Cascade], part: int, parts: int):
    """Adds to each url the numbers of its keys that are listed, are rules and block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            lists = batch.column("a")
            a = lists.flatten().to_numpy(zero_copy_only=False)
            b = batch.column("b").flatten().to_numpy(zero_copy_only=False)
            mine = (a.view(np.uint64) % np.uint64(parts)) == part
            flags = np.zeros(len(a), np.int64)
            for bit, name in enumerate(("listed", "rule", "block")):
                flags |= cascades[name].listed(a, b).astype(np.int64) << bit
            flags[~mine | ((flags & 1) == 0)] = 0
            before = batch.column("flags").flatten().to_numpy(zero_copy_only=False)
            offsets = pa.array(np.r_[0, np.cumsum(lists.value_lengths().to_numpy())], pa.int32())
            columns = [batch.column(n) for n in names if n != "flags"]
            merged = pa.ListArray.from_arrays(offsets, pa.array(before | flags))
            yield pa.RecordBatch.from_arrays([*columns, merged], names=[n for n in names if n != "flags"] + ["flags"])

    return run


def judge(pages: DataFrame, rules: DataFrame, key: str = "page_id", max_bytes: int = 64 << 20) -> DataFrame:
    """key, host, path, rule, verdict: one row per row of `pages` (key, url).

    `rules` has host, path, verdict (allow or block) and is_rule. An entry fits its host and all
    subdomains if the url's path starts with its path; the longest fitting rule (host and path
    together, then the longer host) is reported and decides. Where no rule fits, a fitting entry that is no rule (a plain
    block list) blocks if it says so; else the url is allowed. Null urls and urls without ://
    have an empty host and path and are allowed. Entries with nulls are left out; of repeated
    entries blocking wins. Repeated pages are each judged. Keys are told apart by 128 bits of hash.

    A list too large for `max_bytes` of filter is parted by hash, and the parts are looked up one
    after the other, each pass over a stored table.
    """
    entries = rules.where("host is not null and path is not null and verdict is not null").select(
        F.concat(F.translate("host", UPPER, LOWER), "path").alias("key"),
        F.length("path").alias("n"),
        F.col("verdict").eqNullSafe("block").alias("block"),
        F.coalesce("is_rule", F.lit(False)).alias("is_rule"),
    )
    # Path lengths of a list are few: they are counted, and asked for only as lengths.
    lengths = [r.n for r in entries.select("n").distinct().orderBy("n").collect()]
    urls = pages.select(F.col(key).alias("page_key"), host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    asked = urls.withColumn("keys", candidate_keys("host", "path", lengths))
    keys = F.explode("keys").alias("key")
    universe = stored(hashed(asked.select(keys)).distinct())
    by_key = entries.groupBy("key").agg(F.max("block").alias("block"), F.max("is_rule").alias("is_rule"))
    listed = stored(by_key.select("block", "is_rule", F.xxhash64("key").alias("a"), F.xxhash64("key", F.lit(1)).alias("b")))
    count = listed.count()
    parts = max(1, math.ceil(count * BITS_PER_KEY / 8 / max_bytes * 1.25))
    number = F.expr(f"pmod(pmod(a, {parts}) + if(a < 0, {2**64 % parts}, 0), {parts})")
    rows = asked.select(
        "page_key",
        "host",
        "path",
        "keys",
        F.transform("keys", lambda k: F.xxhash64(k)).alias("a"),
        F.transform("keys", lambda k: F.xxhash64(k, F.lit(1))).alias("b"),
        F.transform("keys", lambda k: F.lit(0).cast("long")).alias("flags"),
    )
    kind = dict(pages.dtypes)[key]
    schema = (
        f"page_key {kind}, host string, path string, keys array<string>, a array<bigint>, b array<bigint>, "
        "flags array<bigint>"
    )
    for part in range(parts):
        taken, asked_for = listed.where(number == part), universe.where(number == part)
        cascades = {
            "listed": cascade(taken.select("a", "b"), asked_for, max_bytes, overlap=True),
            "rule": cascade(taken.where("is_rule").select("a", "b"), taken.where("not is_rule").select("a", "b"), max_bytes),
            "block": cascade(taken.where("block").select("a", "b"), taken.where("not block").select("a", "b"), max_bytes),
        }
        rows = rows.mapInArrow(_look_up(cascades, part, parts), schema)
        if part + 1 < parts:
            rows = stored(rows)
    found = F.expr(
        """filter(zip_with(keys, flags, (k, f) -> struct(length(k) AS n, length(substring_index(k, '/', 1)) AS h,
           k AS key, f AS flags)), x -> x.flags & 1 = 1)"""
    )
    best = F.expr("array_max(filter(found, x -> x.flags & 2 = 2))")
    plain_block = F.expr("exists(found, x -> x.flags & 6 = 4)")
    rows = rows.withColumn("found", found).withColumn("best", best)
    verdict = F.when(F.col("best").isNotNull(), F.expr("if(best.flags & 4 = 4, 'block', 'allow')"))
    return rows.select(
        F.col("page_key").alias(key),
        "host",
        "path",
        F.col("best.key").alias("rule"),
        F.coalesce(verdict, F.when(plain_block, "block").otherwise("allow")).alias("verdict"),
    )
