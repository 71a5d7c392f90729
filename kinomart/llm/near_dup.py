"""Near-duplicates by ProbMinHash.

A document is the set of its five-word shingles. Each shingle is a Poisson process whose rate is its
weight: its arrivals fall, after exponential gaps, on random registers, and a register keeps the
shingle that arrived first. A process ends once its next arrival is later than all registers' first
ones. Two documents agree in a register with the probability Jaccard similarity of their weights.
All weights are 1, however often a shingle occurs, so that this is the Jaccard similarity of the sets, by
which links are verified.

Bands of registers put texts into buckets. Small buckets are compared pair by pair, in large ones every
text with one other. Of large buckets that this does not connect, the texts that are not in the main
component are compared with all others of other components: tiles of a bucket meet as arrays, and only
links become rows, as many as connect what is similar. So every two similar texts that share a band are
linked or connected. Every link is verified by the Jaccard similarity of the shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinomart.llm.byte_texts import Texts, mix
from kinomart.llm.common import SPACE, small_batches, stored
from kinomart.llm.components import components

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 36, 6
SLICE = 1 << 20
#: Buckets of at most this many documents are compared pair by pair.
SMALL = 16
#: Pairs whose registers agree in a smaller part are no candidates: 0.8 lies six deviations above.
LEAST_AGREEMENT = 0.6
#: The same for pairs of tiles: 0.8 lies 4.4 deviations above (with 216 registers), a miss of 5 in a million.
TILE_AGREEMENT = 0.68
#: Texts of a tile, and how many of them are compared with another tile at a time.
TILE, STRIP = 512, 32
NO_ID = (1 << 63) - 1  # behind all others


def shingles(words: np.ndarray, owner: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of `size` words, and their texts; a shorter text is one run. Words are in
    the order of their texts."""
    if not len(words):
        return np.zeros(0, np.uint64), owner[:0]
    place = np.arange(len(words))
    first = np.r_[True, owner[1:] != owner[:-1]]
    begin = np.maximum.accumulate(np.where(first, place, 0))
    ends = np.r_[np.flatnonzero(first)[1:], len(words)]
    end = np.repeat(ends, np.diff(np.r_[0, ends]))
    heads = np.flatnonzero((place + size <= end) | (place == begin))
    source = words.view(np.uint64)
    out = source[heads].copy()
    for k in range(1, size):
        inside = heads + k < end[heads]
        out[inside] = mix(out[inside]) + source[heads[inside] + k]
    return mix(out), owner[heads]


def _distinct(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (hash, text) with their counts, sorted by text and hash."""
    order = np.lexsort((hashes, owner))
    h, o = hashes[order], owner[order]
    new = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (o[1:] != o[:-1])]) if len(h) else np.zeros(0, np.int64)
    return h[new], o[new], np.diff(np.r_[new, len(h)])


def _uniform(seed: np.ndarray) -> np.ndarray:
    return ((seed >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53


def signatures(hashes: np.ndarray, owner: np.ndarray, weights: np.ndarray, texts: int, registers: int) -> np.ndarray:
    """The shingle that came first to each register of each text, 0 for texts without shingles."""
    soonest = np.full(texts * registers, np.inf)
    winner = np.zeros(texts * registers, np.uint64)
    time = np.zeros(len(hashes))
    alive = np.arange(len(hashes))
    arrival = 0
    while len(alive):
        seed = mix(hashes[alive] + np.uint64((2 * arrival + 1) * 0xD1342543DE82EF95 % 2**64))
        time[alive] -= np.log(_uniform(seed)) / weights[alive]
        now = time[alive]
        register = owner[alive] * registers + (mix(seed) % np.uint64(registers)).astype(np.int64)
        better = np.flatnonzero(now < soonest[register])
        # Of several arrivals at a register the soonest is written last.
        better = better[np.argsort(-now[better], kind="stable")]
        soonest[register[better]] = now[better]
        winner[register[better]] = hashes[alive[better]]
        latest = soonest.reshape(texts, registers).max(axis=1) if arrival % 8 == 7 or arrival < 4 else latest
        alive = alive[time[alive] < latest[owner[alive]]]
        arrival += 1
    return winner.reshape(texts, registers)


def _sign(bands: int, rows: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = Texts(batch.column("text"), lower=False)
            for text, start, end in parts.whole(SLICE):
                words, owner = parts.words(text, start, end)
                h, o, _ = _distinct(*shingles(words, owner - text[0], size))
                # Arrivals' hashes must not be 0, which stands for none.
                signed = signatures(h | np.uint64(1), o, np.ones(len(h)), len(text), bands * rows)
                keys = np.zeros((len(text), bands), np.uint64)
                for r in range(rows):
                    keys = mix(keys + signed[:, r::rows])
                keys = mix(keys + np.arange(bands, dtype=np.uint64))
                short = (mix(signed) >> np.uint64(48)).astype(np.uint16)
                sizes = np.bincount(o, minlength=len(text))
                at = int(text[0])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(at, len(text)),
                        batch.column("content").slice(at, len(text)),
                        pa.array(sizes, pa.int64()),
                        pa.array([row.tobytes() for row in keys], pa.binary()),
                        pa.array([row.tobytes() for row in short], pa.binary()),
                    ],
                    names=["id", "content", "n", "keys", "registers"],
                )

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = Texts(batch.column("text"), lower=False)
            for text, start, end in parts.whole(SLICE):
                words, owner = parts.words(text, start, end)
                h, o, _ = _distinct(*shingles(words, owner - text[0], size))
                offsets = np.r_[0, np.cumsum(np.bincount(o, minlength=len(text)))].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(int(text[0]), len(text)),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(h.view(np.int64))),
                    ],
                    names=["id", "shingles"],
                )

    return run


def _agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keeps the pairs whose registers agree often enough."""
    for batch in batches:
        if not batch.num_rows:
            continue
        left, right = (np.array([np.frombuffer(x, np.uint16) for x in batch.column(c).to_pylist()]) for c in ("ra", "rb"))
        near = (left == right).mean(axis=1) >= LEAST_AGREEMENT
        yield batch.select(["a", "b"]).filter(pa.array(near))


def _band_rows(signed: DataFrame, bands: int) -> DataFrame:
    """id, n, band, key: one row per band."""
    return signed.where("n > 0").select(
        "id", "n", F.explode(F.expr(f"transform(sequence(0, {bands - 1}), i -> struct(i AS band, conv(hex(substring(keys, 8 * i + 1, 8)), 16, -10) AS key))")).alias("b")
    ).select("id", "n", "b.band", F.col("b.key").cast("long").alias("key"))


def _classes(rows_in: DataFrame, similarity: float, size: int, bands: int, rows: int) -> DataFrame:
    """id, content, class of each row (id, text, content); classes have numbers of no meaning."""
    signed = stored(
        rows_in.mapInArrow(_sign(bands, rows, size), "id bigint, content string, n bigint, keys binary, registers binary")
    )
    # One text stands for all its copies. Its number is its own, whatever the ids of its rows.
    texts = stored(
        signed.groupBy("content")
        .agg(
            F.min("id").alias("home"),
            F.first("n").alias("n"),
            F.first("keys").alias("keys"),
            F.first("registers").alias("registers"),
        )
        .withColumn("id", F.monotonically_increasing_id())
    )
    homes = signed.select("id", "content").join(texts.select("content", F.col("id").alias("first")), "content")
    keyed = _band_rows(texts, bands).withColumn("label", F.col("id"))
    pairs, large = _candidates(keyed, similarity)
    links = stored(_verified(rows_in, texts, pairs, similarity, size))
    if not large.isEmpty():
        # Large buckets whose texts are not all connected.
        labels = stored(components(links))
        named = large.drop("label").join(labels, F.col("id") == F.col("node"), "left")
        named = stored(named.select("id", "n", "key", F.coalesce("root", "id").alias("label")))
        home = named.groupBy("key").agg(
            F.mode("label", True).alias("home"), F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("members")
        )
        still = stored(named.join(stored(home.where("low != high").select("key", "home", "members")), "key"))
        if not still.isEmpty():
            links = stored(links.union(_rest(rows_in, texts, still, similarity, size)))
    labels = stored(components(links))
    return stored(homes.join(labels, F.col("first") == F.col("node"), "left").select("id", "content", F.coalesce("root", "first").alias("class")))


def _rows(docs: DataFrame) -> DataFrame:
    content = F.md5(F.trim(F.regexp_replace("text", SPACE, " ")).cast("binary"))
    rows = small_batches(docs).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.withColumn("content", content)


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, size: int = SHINGLE, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, class_id, class_size: one row per row of `docs` (doc_id bigint, text).

    Texts are linked if the Jaccard similarity of their sets of `size`-word shingles is at least
    `similarity`; texts of one to four words are one shingle. Classes are what links connect; class_id
    is the smallest doc_id of a class, null if it has none. Words are what white space parts, as
    written. Copies (equal up to white space) are one text. Null and empty texts have no shingles and
    are only in a class with their copies. Ids link nothing: rows with one doc_id, or with none, are in
    one class only if their texts are. No rows give no rows.
    """
    classes = _classes(_rows(docs), similarity, size, bands, rows)
    sizes = stored(classes.groupBy("class").agg(F.count("*").alias("class_size"), F.min("id").alias("least")))
    return classes.join(sizes, "class").select(
        F.nullif("id", F.lit(NO_ID)).alias("doc_id"), F.nullif("least", F.lit(NO_ID)).alias("class_id"), "class_size"
    )


def first_of_classes(docs: DataFrame, similarity: float = SIMILARITY, size: int = SHINGLE) -> DataFrame:
    """One row of each class of `near_duplicates`, with all columns of `docs`: the one with the smallest
    doc_id (null ids last), of several texts with that id one by its content, of equal rows one."""
    classes = _classes(_rows(docs), similarity, size, BANDS, ROWS)
    first = classes.groupBy("class").agg(F.min(F.struct("id", "content")).alias("first")).select("first.*")
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    text, doc_id = (F.col(names[docs.columns.index(c)]) for c in ("text", "doc_id"))
    own = plain.withColumns({"text": F.coalesce(text, F.lit("")), "doc_id": doc_id})
    keyed = own.withColumns({"id": F.coalesce("doc_id", F.lit(NO_ID)), "content": F.md5(F.trim(F.regexp_replace("text", SPACE, " ")).cast("binary"))})
    kept = keyed.drop("text", "doc_id").join(first, ["id", "content"], "left_semi").dropDuplicates(["id", "content"])
    return kept.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)])


def _candidates(keyed: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of different components to compare, and the rows of large buckets.

    Small buckets give all pairs whose sizes allow the similarity, in large ones each document meets
    one of them.
    """
    buckets = (
        keyed.groupBy("key")
        .agg(
            F.count("*").alias("members"),
            F.min(F.struct(F.xxhash64("id", F.lit(1)).alias("h"), "id", "n", "label")).alias("pivot"),
        )
        .where("members > 1")
    )
    placed = stored(keyed.join(stored(buckets), "key"))
    few = placed.where(F.col("members") <= SMALL)
    left = few.select("key", F.col("id").alias("a"), F.col("n").alias("na"), F.col("label").alias("la"))
    right = few.select("key", F.col("id").alias("b"), F.col("n").alias("nb"), F.col("label").alias("lb"))
    pairs = left.join(right, "key").where((F.col("a") < F.col("b")) & _possible(similarity)).select("a", "b")
    large = placed.where(F.col("members") > SMALL)
    star = large.where("id != pivot.id").select(
        F.least("id", "pivot.id").alias("a"),
        F.greatest("id", "pivot.id").alias("b"),
        F.col("n").alias("na"),
        F.col("pivot.n").alias("nb"),
        F.col("label").alias("la"),
        F.col("pivot.label").alias("lb"),
    )
    star = star.where(_possible(similarity)).select("a", "b")
    return pairs.union(star).distinct(), large.select("id", "n", "key", "label")


def _possible(similarity: float) -> Column:
    """Different components, and sizes that allow the similarity."""
    return (F.col("la") != F.col("lb")) & (F.least("na", "nb") >= similarity * F.greatest("na", "nb"))


def _compare(similarity: float):
    def run(table: pa.Table) -> pa.Table:
        """Links of one tile and another (or the same): of different components, one of them a stray, of
        sizes that allow the similarity, with registers that agree often enough, and similar by their
        shingles. A link between texts that the links before it connect says nothing new."""
        table = table.combine_chunks()
        ids, labels, n, tile = (table[c].to_numpy() for c in ("id", "label", "n", "tile"))
        stray = table["stray"].to_numpy(zero_copy_only=False)
        registers = np.frombuffer(b"".join(table["registers"].to_pylist()), np.uint16).reshape(len(ids), -1)
        low, high = table["i"][0].as_py(), table["j"][0].as_py()
        one, two = np.flatnonzero(tile == low), np.flatnonzero(tile == high)
        sets = table["shingles"].combine_chunks()
        root: dict[int, int] = {}

        def find(label: int) -> int:
            while label in root:
                label = root[label]
            return label

        found = []
        for at in range(0, len(one), STRIP):
            a = one[at : at + STRIP]
            wanted = (labels[a, None] != labels[two]) & (stray[a, None] | stray[two])
            sizes = np.minimum(n[a, None], n[two]), np.maximum(n[a, None], n[two])
            x, y = np.nonzero(wanted & (sizes[0] >= similarity * sizes[1]))
            for part in range(0, len(x), TILE * STRIP // 4):
                p, q = a[x[part : part + TILE * STRIP // 4]], two[y[part : part + TILE * STRIP // 4]]
                near = (registers[p] == registers[q]).mean(axis=1) >= TILE_AGREEMENT
                for k, m in zip(p[near].tolist(), q[near].tolist(), strict=True):
                    first, second = find(int(labels[k])), find(int(labels[m]))
                    if first == second:
                        continue
                    left, right = (sets[x].values.to_numpy() for x in (k, m))
                    both = len(np.intersect1d(left, right, assume_unique=True))
                    if both >= similarity * (len(left) + len(right) - both):
                        root[max(first, second)] = min(first, second)
                        found.append(sorted((int(ids[k]), int(ids[m]))))
        a, b = zip(*found, strict=True) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _rest(rows: DataFrame, texts: DataFrame, still: DataFrame, similarity: float, size: int) -> DataFrame:
    """Links (a, b) of a bucket's strays, texts outside of its main component, and its texts of other
    components: enough to connect all that are similar.

    A bucket is dealt to tiles of about TILE texts, and every two of its tiles to one task: a text is
    sent once for each tile of its bucket. Two tiles give fewer links than they have texts.
    """
    tiles = F.ceil(F.col("members") / TILE).cast("int")
    dealt = still.select("key", "id", "n", "label", (F.col("label") != F.col("home")).alias("stray"), tiles.alias("tiles"))
    dealt = dealt.withColumn("tile", F.pmod(F.xxhash64("id", F.lit(2)), F.col("tiles")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
    placed = dealt.select("key", "id", "n", "label", "stray", "tile", other).withColumns(
        {"i": F.least("tile", "other"), "j": F.greatest("tile", "other")}
    )
    sets = _shingle_sets(rows, texts, still.select("id"), size)
    whole = placed.join(texts.select("id", "registers"), "id").join(sets, "id").drop("other")
    return whole.groupBy("key", "i", "j").applyInArrow(_compare(similarity), "a bigint, b bigint").distinct()


def _shingle_sets(rows: DataFrame, texts: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """id, shingles of the texts with these ids."""
    wanted = texts.select(F.col("id").alias("node"), F.col("home").alias("id"), "content")
    wanted = wanted.join(ids.select(F.col("id").alias("node")).distinct(), "node", "left_semi")
    own = rows.join(wanted, ["id", "content"]).dropDuplicates(["node"]).select(F.col("node").alias("id"), "text")
    return stored(own.mapInArrow(_sets(size), "id bigint, shingles array<bigint>"))


def _verified(rows: DataFrame, texts: DataFrame, pairs: DataFrame, similarity: float, size: int) -> DataFrame:
    """The pairs whose shingle sets are similar enough."""
    left = texts.select(F.col("id").alias("a"), F.col("registers").alias("ra"))
    right = texts.select(F.col("id").alias("b"), F.col("registers").alias("rb"))
    near = stored(pairs.join(left, "a").join(right, "b").mapInArrow(_agree, "a bigint, b bigint").distinct())
    if near.isEmpty():
        return near
    sets = _shingle_sets(rows, texts, near.select(F.col("a").alias("id")).union(near.select("b")), size)
    one = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    compared = near.join(one, "a").join(two, "b").select("a", "b", both.alias("both"), (F.size("sa") + F.size("sb") - both).alias("all"))
    return compared.where(F.col("both") >= similarity * F.col("all")).select("a", "b").distinct()
