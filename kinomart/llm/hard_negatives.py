"""Hard negatives by vertical scans (BOND): blocks of vectors lie in columns, one for each dimension.

An anchor reads a block's columns in falling order of its own components' size. After each few columns a
candidate's score lies between what it has so far plus the least, and plus the most, that the columns
still to come can add, by their least and greatest entries in the block. Candidates that cannot be
among the wanted ones leave the bitmap; the columns to come are then read for the others alone, until
scores are exact. Anchors are dealt to tiles and blocks to splits. A task holds one tile, and the blocks of one split
pass by one after the other; it returns a few rows for each anchor, and Spark keeps the first of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinomart.llm.common import small_batches, stored
from kinomart.llm.vectors import finite, matrix, width

SCALE = 256
#: Bytes of a block of vectors, the most anchors of a tile and blocks of a split, and columns read between two looks at the bounds.
BLOCK_BYTES, ANCHORS, SPLIT_BLOCKS, STEP = 2 << 20, 32_768, 16, 8
#: The fewest anchors of a tile that is made smaller so that all cores have one, and anchors whose rows leave a task together.
FEW_ANCHORS, TOGETHER = 64, 1024
#: Candidates are gathered once they are fewer than this share of those looked at.
GATHER = 0.5
MAX = 2**63 - 1
Batches = Iterator[pa.RecordBatch]
Range = tuple[int, int]


def _narrow(x: np.ndarray) -> np.ndarray:
    """The same integers in 2, 4 or 8 bytes each, as few as hold them all."""
    low, high = (int(x.min()), int(x.max())) if x.size else (0, 0)
    return x.astype(next(t for t in (np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max))


class Block:
    """Vectors in columns, with each column's least and greatest entry."""

    def __init__(self, row: dict):
        self.rows = np.frombuffer(row["rows"], np.int64)
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.missing = np.frombuffer(row["missing"], np.bool_)
        self.labels = np.frombuffer(row["labels"], np.int64)
        columns = np.frombuffer(row["columns"], f"i{row.get('width', 8)}").reshape(-1, len(self.rows))
        self.columns = columns.astype(np.int64, copy=False)
        self.low, self.high = self.columns.min(axis=1), self.columns.max(axis=1)

    def order(self, at: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """Places in `at` by falling score, then by id, null ids last."""
        return np.lexsort((self.rows[at], self.ids[at], self.missing[at], -scores))


class Scan:
    """One anchor's scores over a block, column by column."""

    def __init__(self, block: Block, anchor: np.ndarray, alive: np.ndarray):
        self.block, self.at = block, np.flatnonzero(alive)
        self.dims = np.argsort(-np.abs(anchor), kind="stable")
        self.weights = anchor[self.dims]
        ends = self.weights * block.low[self.dims], self.weights * block.high[self.dims]
        # What the columns from each place on can add at least and at most.
        self.least = np.r_[np.cumsum(np.minimum(*ends)[::-1])[::-1], 0]
        self.most = np.r_[np.cumsum(np.maximum(*ends)[::-1])[::-1], 0]
        self.scores = np.zeros(len(self.at), np.int64)
        self.read = 0
        self.whole = len(self.at) == len(block.rows)

    def step(self) -> bool:
        """Reads some more columns; false when all are read or no candidate is left."""
        if self.read == len(self.dims) or not len(self.at):
            return False
        chosen = self.dims[self.read : self.read + STEP]
        columns = self.block.columns[chosen] if self.whole else self.block.columns[chosen[:, None], self.at]
        self.scores += self.weights[self.read : self.read + STEP] @ columns
        self.read += len(chosen)
        return True

    def keep(self, wanted: np.ndarray) -> None:
        if wanted.sum() < GATHER * len(wanted) or self.read == len(self.dims):
            self.at, self.scores, self.whole = self.at[wanted], self.scores[wanted], False

    def nearest(self, k: int, known: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The k candidates with the highest scores; some may be missing that are below the `known` one."""
        while self.step():
            floors = [] if known is None else [known]
            if len(self.at) > k:
                floors.append(int(np.partition(self.scores, -k)[-k] + self.least[self.read]))
            if floors:
                self.keep(self.scores + self.most[self.read] >= max(floors))
        first = self.block.order(self.at, self.scores)[:k]
        return self.at[first], self.scores[first]

    def within(self, windows: list[Range], k: int, known: list[int | None] | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each window of scores the k candidates in it with the highest scores; some may be missing that are
        below the window's `known` one."""
        floors = [low if score is None else max(low, score) for (low, _), score in zip(windows, known or [None] * len(windows), strict=True)]
        while self.step():
            least, most = self.least[self.read], self.most[self.read]
            wanted = np.zeros(len(self.at), bool)
            for w, (low, high) in enumerate(windows):
                if high - low >= most - least:  # else no open score lies within for sure
                    sure = self.scores[(self.scores + least >= low) & (self.scores + most <= high)]
                    if len(sure) >= k:
                        floors[w] = max(floors[w], int(np.partition(sure, -k)[-k] + least))
                wanted |= (self.scores + most >= floors[w]) & (self.scores + least <= high)
            self.keep(wanted)
        found = []
        for low, high in windows:
            inside = np.flatnonzero((self.scores >= low) & (self.scores <= high))
            first = inside[self.block.order(self.at[inside], self.scores[inside])[:k]]
            found.append((self.at[first], self.scores[first]))
        return found


def _pack(columns: int) -> Callable[[Batches], Batches]:
    """Blocks of vectors, as columns."""
    size = max(64, BLOCK_BYTES // (8 * columns))

    def run(batches: Batches) -> Batches:
        held: list[pa.RecordBatch] = []

        def flush(table: pa.Table) -> pa.RecordBatch:
            part = table.combine_chunks()
            ids = part["vec_id"].combine_chunks()
            x = np.floor(SCALE * matrix(part["vector"].combine_chunks(), columns)).astype(np.int64)
            fields = {
                "rows": part["row"].to_numpy(),
                "ids": ids.fill_null(0).to_numpy(),
                "missing": ids.is_null().to_numpy(zero_copy_only=False),
                "labels": part["label"].to_numpy(),
                "anchors": part["is_anchor"].to_numpy(),
                "columns": _narrow(np.ascontiguousarray(x.T)),
            }
            about = {"block": int(fields["rows"][0]), "width": fields["columns"].itemsize}
            return pa.RecordBatch.from_pylist([about | {k: v.tobytes() for k, v in fields.items()}])

        for batch in batches:
            held.append(batch)
            table = pa.Table.from_batches(held)
            while len(table) >= size:
                yield flush(table.slice(0, size))
                table = table.slice(size)
            held = table.to_batches()
        if sum(map(len, held)):
            yield flush(pa.Table.from_batches(held))

    return run


def _anchors(batches: Batches) -> Batches:
    """The anchors' rows of blocks."""
    for batch in batches:
        for row in batch.to_pylist():
            block = Block(row)
            at = np.flatnonzero(np.frombuffer(row["anchors"], np.bool_))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(block.rows[at]),
                    pa.array(block.ids[at], mask=block.missing[at]),
                    pa.array(block.labels[at]),
                    pa.array([_narrow(block.columns[:, i]).tobytes() for i in at], pa.binary()),
                ],
                names=["anchor", "anchor_id", "label", "vector"],
            )


class Member:
    """An anchor of a task's tile, with the first k rows found so far for each thing that is looked for."""

    def __init__(self, row: dict, columns: int, wanted: list[int], windows: list[Range]):
        self.anchor, self.label, self.wanted, self.windows = row["anchor"], row["label"], wanted, windows
        self.vector = np.frombuffer(row["vector"], f"i{len(row['vector']) // columns}").astype(np.int64)
        # Negated scores, whether the id is null, ids and rows: in the order in which the first ones count.
        self.found = [np.zeros((4, 0), np.int64) for _ in wanted]

    def known(self, place: int, k: int) -> int | None:
        """The k-th score so far."""
        return -int(self.found[place][0, k - 1]) if self.found[place].shape[1] == k else None

    def add(self, place: int, block: Block, at: np.ndarray, scores: np.ndarray, k: int) -> None:
        if len(at):
            more = np.stack([-scores, block.missing[at].astype(np.int64), block.ids[at], block.rows[at]])
            both = np.concatenate([self.found[place], more], axis=1)
            self.found[place] = both[:, np.lexsort(both[::-1])[:k]]


def _results(members: list[Member]) -> Batches:
    for start in range(0, len(members), TOGETHER):
        several = [(m.anchor, w, f) for m in members[start : start + TOGETHER] for w, f in zip(m.wanted, m.found, strict=True)]
        sizes = [f.shape[1] for _, _, f in several]
        negated, missing, ids, rows = np.concatenate([np.zeros((4, 0), np.int64), *[f for _, _, f in several]], axis=1)
        columns = {
            "anchor": pa.array(np.repeat(np.array([a for a, _, _ in several], np.int64), sizes)),
            "positive": pa.array(np.repeat(np.array([w for _, w, _ in several], np.int64), sizes)),
            "row": pa.array(rows),
            "id": pa.array(ids, mask=missing.astype(bool)),
            "score": pa.array(-negated),
        }
        yield pa.RecordBatch.from_pydict(columns)


def _scan(member: Callable[[dict], Member], look: Callable[[Block, Member], None]) -> Callable[[Batches], Batches]:
    """One tile of anchors comes first, then the blocks of a split, each seen by every anchor."""

    def run(batches: Batches) -> Batches:
        members: list[Member] = []
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["block"] is None:
                    members.append(member(row))
                else:
                    block = Block(row)
                    for m in members:
                        look(block, m)
        yield from _results(members)

    return run


def _positives(k: int, columns: int) -> Callable[[Batches], Batches]:
    """An anchor's nearest rows of its label; `positive` stays 0."""

    def look(block: Block, m: Member) -> None:
        others = (block.labels == m.label) & (block.rows != m.anchor)
        m.add(0, block, *Scan(block, m.vector, others).nearest(k, m.known(0, k)), k)

    return _scan(lambda row: Member(row, columns, [0], []), look)


def _negatives(k: int, low: int, high: int, columns: int) -> Callable[[Batches], Batches]:
    def member(row: dict) -> Member:
        # low * positive <= 100 * negative <= high * positive
        windows = [(-(-low * p["score"] // 100), high * p["score"] // 100) for p in row["positives"]]
        return Member(row, columns, [p["row"] for p in row["positives"]], windows)

    def look(block: Block, m: Member) -> None:
        known = [m.known(place, k) for place in range(len(m.windows))]
        found = Scan(block, m.vector, block.labels != m.label).within(m.windows, k, known)
        for place, (at, scores) in enumerate(found):
            m.add(place, block, at, scores, k)

    return _scan(member, look)


def _first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The first k rows of each key by falling score, then id (null ids last), numbered."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def grid(anchors: int, blocks: int, least: int) -> tuple[int, int]:
    """Tiles of anchors and splits of blocks: bounded by ANCHORS and SPLIT_BLOCKS, and at least so many pairs
    of them, if there are enough of either."""
    splits = max(1, -(-blocks // SPLIT_BLOCKS), min(blocks, least))
    few = max(1, anchors // FEW_ANCHORS)
    return max(1, -(-anchors // ANCHORS), min(few, -(-least // splits))), splits


def mine(
    rows: DataFrame,
    anchor: Column,
    key: str = "vec_id",
    column: str = "embedding",
    label: Column | None = None,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Scores are inner products of floor(256 * x). An anchor's positives are its nearest other rows of its
    label; a positive's negatives are the nearest rows of other labels whose score is from `low` to
    `high` percent of the positive's. Higher scores come first, then smaller keys, null keys last; rank
    counts from 1. Anchors and positives without negatives have no row.

    Rows with a null label, with a null vector, with a null, infinite or NaN component, or one so large
    that a score might not fit into a long, and those not as long as most vectors take no part. Rows
    are told apart by themselves, not by key: repeated rows are each other's neighbours, and anchors
    each for itself. Keys and labels are integers; other columns stay out. No rows give no rows.
    """
    label = F.col("label") if label is None else label
    named = rows.select(
        F.col(key).cast("long").alias("vec_id"),
        label.cast("long").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("is_anchor"),
        F.col(column).alias("vector"),
    ).where(F.col("label").isNotNull() & finite("vector", 2.0**52))
    columns = width(named, "vector")
    limit = float(isqrt(MAX // max(columns, 1)) // SCALE - 1)
    counted = named.where((F.size("vector") == columns) & finite("vector", limit))
    counted = counted.select(F.monotonically_increasing_id().alias("row"), "*")
    columns = max(columns, 1)
    fields = "block bigint, width bigint, rows binary, ids binary, missing binary, labels binary, anchors binary, columns binary"
    blocks = stored(small_batches(counted).mapInArrow(_pack(columns), fields))
    anchors = stored(blocks.mapInArrow(_anchors, "anchor bigint, anchor_id bigint, label bigint, vector binary"))
    tiles, splits = grid(anchors.count(), blocks.count(), 4 * rows.sparkSession.sparkContext.defaultParallelism)
    # One number for each block of some thousand vectors, so that splits have equally many.
    numbers = blocks.select("block", (F.row_number().over(Window.orderBy("block")) - 1).alias("number"))

    def scan(members: DataFrame, answer: Callable[[Batches], Batches]) -> DataFrame:
        """Each tile of members against each split of the blocks, a cell, in a task of its own. No table is
        broadcast: files hold vectors in a small part of the bytes that they take in memory."""

        def cell(tile: Column, split: Column) -> Column:
            return (tile * splits + split).cast("int").alias("cell")

        tile = F.pmod(F.xxhash64("anchor"), F.lit(tiles))
        all_splits, all_tiles = (F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("other") for n in (splits, tiles))
        of_members = members.select("*", all_splits).select(cell(tile, F.col("other")), *members.columns)
        numbered = blocks.drop("anchors").join(numbers.hint("merge"), "block")
        of_blocks = numbered.select("*", all_tiles).select(cell(F.col("other"), F.col("number") % splits), *blocks.drop("anchors").columns)
        dealt = of_members.unionByName(of_blocks, allowMissingColumns=True).repartitionById(tiles * splits, "cell")
        dealt = dealt.sortWithinPartitions(F.asc_nulls_first("block"))
        return dealt.mapInArrow(answer, "anchor bigint, positive bigint, row bigint, id bigint, score bigint")

    near = scan(anchors.drop("anchor_id"), _positives(positives, columns)).drop("positive")
    chosen = stored(_first(near, ["anchor"], positives).drop("rank"))
    of_anchor = chosen.groupBy("anchor").agg(F.collect_list(F.struct("row", "score")).alias("positives"))
    members = anchors.drop("anchor_id").join(of_anchor.hint("merge"), "anchor")
    hard = scan(members, _negatives(negatives, low, high, columns))
    ranked = _first(hard, ["anchor", "positive"], negatives).select(
        "anchor", "positive", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    named_positives = chosen.select(
        "anchor", F.col("row").alias("positive"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return (
        ranked.join(named_positives.hint("merge"), ["anchor", "positive"])
        .join(anchors.select("anchor", "anchor_id").hint("merge"), "anchor")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
