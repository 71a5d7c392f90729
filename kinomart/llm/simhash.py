"""SimHash fingerprints: hashes of weighted terms vote on signed bits.

A term is a word as written, its weight the word's length. Each bit of a text's fingerprint is the side
on which most weight of its words' hashes lies. Likeness of two fingerprints is the share of equal bits.

Fingerprints within a Hamming radius are found by block tables: of more blocks of bits than the radius
some agree whole, so there is one table for each choice of that many blocks, keyed by their bits.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinomart.llm.common import stored, texts

BITS = 128
#: Bits that may differ, and blocks: two of eight blocks of 16 bits agree if six bits differ at most.
RADIUS, BLOCKS = 6, 8
#: Two counts lie in one long: the votes for bit k and for bit k + 32. A text is shorter than 2^31.
LANES = (1 << 32) + 1
#: Documents of a range of ids, and most ranges. The first rows of ranges are broadcast: a few numbers each.
RANGE_ROWS, MAX_RANGES = 4096, 1 << 14


def _long(number: int) -> Column:
    return F.lit(number - (1 << 64) if number >> 63 else number).cast("long")


def _halves() -> list[tuple[str, Column]]:
    """The fingerprint's longs by name, with the hash of `term` that votes on each."""
    return [(f"f{i}", F.xxhash64("term") if i == 0 else F.xxhash64("term", F.lit(i))) for i in range(BITS // 64)]


def _either(parts: list[Column]) -> Column:
    while len(parts) > 1:
        parts = [reduce(Column.bitwiseOR, parts[i : i + 2]) for i in range(0, len(parts), 2)]
    return parts[0]


def fingerprints(rows: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """The keys, f0 and f1: the fingerprint of each row's whole text; keys are unique.

    Words of a text vote in the task that reads it; one row for each text is shuffled. Null and empty
    texts have no votes, so that their fingerprint is 0.
    """
    # A pattern of one character needs no regular expression; empty words weigh nothing.
    words = F.split(F.translate(F.col(text), "\t\n\x0b\x0c\r", " " * 5), " ")
    terms = rows.select(*keys, F.explode_outer(words).alias("term")).withColumn("term", F.coalesce("term", F.lit("")))
    hashed = terms.select(*keys, F.length("term").cast("long").alias("weight"), *[h.alias(n) for n, h in _halves()])
    names = [n for n, _ in _halves()]
    votes = [
        F.sum(F.shiftrightunsigned(n, k).bitwiseAND(_long(LANES)) * F.col("weight")).alias(f"{n}_{k}")
        for n in names
        for k in range(32)
    ]
    counted = hashed.groupBy(*keys).agg(F.sum("weight").alias("weight"), *votes)

    def bit(name: str, b: int) -> Column:
        lanes = F.col(f"{name}_{b % 32}")
        votes_for = F.shiftrightunsigned(lanes, 32) if b >= 32 else lanes.bitwiseAND(_long((1 << 32) - 1))
        return F.when(votes_for * 2 > F.col("weight"), _long(1 << b)).otherwise(_long(0))

    return counted.select(*keys, *[_either([bit(n, b) for b in range(64)]).alias(n) for n in names])


def _differing(left: str, right: str) -> Column:
    return sum((F.bit_count(F.col(f"{left}{i}").bitwiseXOR(F.col(f"{right}{i}"))) for i in range(BITS // 64)), F.lit(0))


def likeness(left: str, right: str) -> Column:
    """The share of equal bits of two fingerprints in the columns `left`0, `left`1, ..., and `right`0, ..."""
    return F.lit(1.0) - _differing(left, right) / F.lit(float(BITS))


def as_text(name: str) -> Column:
    return F.lower(F.concat(*[F.lpad(F.hex(f"{name}{i}"), 16, "0") for i in range(BITS // 64)]))


def _block(name: str, b: int, blocks: int) -> Column:
    """Block b's bits of the fingerprint."""
    per_long = blocks // (BITS // 64)
    size = 64 // per_long
    whole = F.shiftrightunsigned(f"{name}{b // per_long}", size * (b % per_long))
    return whole.bitwiseAND(_long((1 << size) - 1)) if size < 64 else whole


def neighbours(prints: DataFrame, wanted: Column, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """f0, f1, g0, g1, n_rows: each distinct fingerprint f of a row for which `wanted` holds, with each
    distinct fingerprint g (its own too) at most `radius` bits away and the number of rows that have g.

    `prints` has f0 and f1; `blocks` divides the bits evenly in each long and exceeds the radius. Every
    pair within the radius is found, once: by the first of the tables in which both are equal. Equal
    fingerprints are one, so copies make no pairs.
    """
    longs = [f"f{i}" for i in range(BITS // 64)]
    distinct = stored(
        prints.select(*longs, wanted.alias("wanted")).groupBy(*longs).agg(
            F.count("*").alias("n_rows"), F.max(F.coalesce("wanted", F.lit(False))).alias("wanted")
        )
    )
    tables = list(combinations(range(blocks), blocks - radius))

    def keyed(rows: DataFrame, name: str, *more: str) -> DataFrame:
        cut = rows.select(*[F.col(f"f{i}").alias(f"{name}{i}") for i in range(len(longs))], *more)
        each = [
            F.struct(F.lit(t).alias("number"), F.lit(table[-1]).alias("last"), F.xxhash64(*[_block(name, b, blocks) for b in table]).alias("bits"))
            for t, table in enumerate(tables)
        ]
        cut = cut.select("*", F.explode(F.array(*each)).alias("table"))
        return cut.select("*", "table.number", "table.bits", "table.last").drop("table")

    searched = keyed(distinct.where("wanted"), "f")
    listed = keyed(distinct, "g", "n_rows").drop("last")
    equal = [
        ((F.col("last") >= b) & (_block("f", b, blocks) == _block("g", b, blocks))).cast("int") for b in range(blocks)
    ]
    first = sum(equal[1:], equal[0]) == blocks - radius
    near = searched.join(listed, ["number", "bits"]).where((_differing("f", "g") <= radius) & first)
    return near.select(*longs, *[f"g{i}" for i in range(len(longs))], "n_rows")


def _bounds(docs: DataFrame) -> list[int]:
    """Falling ids that part the documents into ranges of about RANGE_ROWS."""
    ranges = min(MAX_RANGES, docs.count() // RANGE_ROWS + 1)
    if ranges == 1:
        return []
    shares = [i / ranges for i in range(1, ranges)]
    found = docs.agg(F.percentile_approx(F.col("doc_id").cast("long"), shares, 10 * ranges).alias("ids")).first()["ids"]
    return sorted(set(found or []), reverse=True)


def _range(bounds: list[int]) -> Column:
    """How many bounds lie above the id, all for a null id: counted among every step-th one first."""
    if not bounds:
        return F.lit(0)
    step = isqrt(len(bounds)) + 1
    whole, coarse = (F.lit(b).cast("array<bigint>") for b in (bounds, bounds[step - 1 :: step] or bounds[-1:]))

    def above(ids: Column) -> Column:
        return F.size(F.filter(ids, lambda b: b > F.col("doc_id")))

    before = above(coarse) * step if len(bounds) >= step else F.lit(0)
    found = before + above(F.slice(whole, before + 1, F.lit(step)))
    return F.when(F.col("doc_id").isNull(), len(bounds)).otherwise(found)


def with_next(docs: DataFrame) -> DataFrame:
    """part, place, doc_id, text, next_part, next_place, next_text: each document (doc_id, text) with the
    one after it by falling doc_id, the first one after the last.

    Rows of one doc_id follow each other by their text's hash, then text; null ids come last. (part,
    place) is a row's own key and the same however often it is computed, as only equal rows could change
    places. Ranges of ids are sorted side by side; the first rows of a range also go to the range before
    it. A doc_id that fills the table makes one large range, which is sorted with spilling.
    """
    rows = docs.select("doc_id", "text", _range(_bounds(docs)).alias("part"))
    heads = rows.groupBy("part").agg(F.max("doc_id").alias("head"))
    # At most MAX_RANGES rows.
    along = Window.orderBy("part")
    target = F.coalesce(F.lag("part").over(along), F.max("part").over(along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    heads = heads.select("part", "head", target.alias("before"))
    own, copy = (F.struct(F.col(c).alias("target"), F.lit(tail).alias("tail")) for c, tail in (("part", False), ("before", True)))
    places = F.when(F.col("doc_id").eqNullSafe(F.col("head")), F.array(own, copy)).otherwise(F.array(own))
    dealt = rows.join(F.broadcast(heads), "part").select("part", "doc_id", "text", F.explode(places).alias("at"))
    dealt = dealt.select("at.target", "at.tail", "part", "doc_id", "text", F.xxhash64("text").alias("hash"))
    order = Window.partitionBy("target").orderBy("tail", F.desc_nulls_last("doc_id"), "hash", "text")
    number = F.row_number().over(order)
    placed = dealt.select(
        "part", "tail", number.alias("place"), "doc_id", "text",
        F.lead("part").over(order).alias("next_part"),
        F.when(F.lead("tail").over(order), 1).otherwise(number + 1).alias("next_place"),
        F.lead("text").over(order).alias("next_text"),
    )
    return placed.where("not tail").drop("tail")


def report(docs: DataFrame, wanted: Column, radius: int = RADIUS) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_near: one
    row per document.

    The edited text is the text with its last third (cut down) replaced by as many first code points of
    the next document's (see `with_next`), or all it has. near_edited and near_next are the likeness to
    the edited text and to the next document. n_near is, where `wanted` (on doc_id) holds, the number of
    other rows within the radius, else null. Null texts count as empty; empty texts have fingerprint 0
    and are alike; one document is its own next one. Repeated rows are rows of their own; other columns
    stay out; no rows give no rows.
    """
    pairs = with_next(texts(docs))
    third = F.floor(F.length("text") / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - third), F.substring("next_text", F.lit(1), third))
    keys = ["part", "place", "doc_id", "next_part", "next_place", "n_chars", "edited_sha256", "is_edited"]
    both = pairs.select(*keys[:5], F.length("text").cast("long").alias("n_chars"), "text", edited.alias("edited"))
    both = both.withColumn("edited_sha256", F.sha2("edited", 256))
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("is_edited"), F.col(c).alias("text")) for i, c in enumerate(("text", "edited"))]))
    each = both.select(*keys[:-1], each.alias("t")).select(*keys[:-1], "t.is_edited", "t.text")
    signed = stored(fingerprints(each, keys))
    own = signed.where("is_edited = 0").drop("is_edited", "edited_sha256")
    near = neighbours(own, wanted, radius).groupBy("f0", "f1").agg((F.sum("n_rows") - 1).alias("n_near"))
    changed = signed.where("is_edited = 1").select("part", "place", "edited_sha256", F.col("f0").alias("e0"), F.col("f1").alias("e1"))
    following = own.select(
        F.col("part").alias("next_part"), F.col("place").alias("next_place"), F.col("f0").alias("n0"), F.col("f1").alias("n1")
    )
    rows = own.join(changed, ["part", "place"]).join(following, ["next_part", "next_place"]).join(near, ["f0", "f1"], "left")
    return rows.select(
        "doc_id", "n_chars", "edited_sha256",
        as_text("f").alias("fingerprint"),
        as_text("e").alias("edited_fingerprint"),
        likeness("f", "e").alias("near_edited"),
        likeness("f", "n").alias("near_next"),
        F.when(wanted, F.col("n_near")).alias("n_near"),
    )
