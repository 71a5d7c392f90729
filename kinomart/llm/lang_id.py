"""Language identification: words first, then ever shorter character n-grams.

A known word scores by its log frequency in each language. A word no language knows falls back to
the longest n-grams of it that any language knows, and scores by the mean of their log frequencies.
A text's evidence is the sum over its words; its score is the posterior of the best language.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinomart.llm.common import small_batches, stored

LETTERS = re.compile(r"[^\W\d_]+")
LONGEST = 4
#: Spark's seed of xxhash64.
SEED = 42
#: Words a task remembers the scores of, or counts, before it starts anew; texts it takes up, and words it
#: scores at a time. They bound memory, not results.
REMEMBERED, COUNTED, SLICE, CHUNK = 100_000, 50_000, 200, 10_000
UNKNOWN = "und"
#: Evidence of a word or n-gram that a language never showed, below its rarest one, in nats.
PENALTY = 2.0


def grams(word: str, n: int) -> list[str]:
    """The character n-grams of a word with its borders; none of a border alone."""
    marked = f" {word} "
    return [marked[i : i + n] for i in range(n == 1, len(marked) - n + 1 - (n == 1))]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: how often each language shows each word (n = 0) and n-gram."""
    schema = pa.schema([("lang", pa.string()), ("n", pa.int32()), ("gram", pa.string()), ("seen", pa.int64())])

    def drain(words: Counter) -> Iterator[pa.RecordBatch]:
        pieces: Counter = Counter()
        for (lang, word), k in words.items():
            pieces[lang, 0, word] += k
            for n in range(1, LONGEST + 1):
                for g in grams(word, n):
                    pieces[lang, n, g] += k
        rows = list(pieces.items())
        for at in range(0, len(rows), 50_000):
            part = rows[at : at + 50_000]
            columns = [[k[0] for k, _ in part], [k[1] for k, _ in part], [k[2] for k, _ in part], [c for _, c in part]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    words: Counter = Counter()
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            words.update((lang, w) for w in LETTERS.findall(text.lower()))
            if len(words) > COUNTED:
                yield from drain(words)
                words = Counter()
    yield from drain(words)


def _sums(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """The sums of the rows of each of n owners; an owner's rows follow each other."""
    total = np.zeros((n, values.shape[1]), values.dtype)
    if len(owner):
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        total[owner[first]] = np.add.reduceat(values, first, axis=0)
    return total


class Table:
    """The words or n-grams of one length: sorted 64-bit hashes, and for each the log frequencies and
    which languages showed it. Among as many entries as there can be, two of one hash are as good as
    impossible (a chance of 1 in 10^8 for a million), and would share their counts."""

    def __init__(self, hashes: np.ndarray, langs: np.ndarray, seen: np.ndarray, size: int):
        totals = np.bincount(langs, seen, size)
        self.hashes, at = np.unique(hashes, return_inverse=True)
        self.rows = np.tile(-np.log(np.maximum(totals, 1)) - PENALTY, (len(self.hashes), 1))
        counts = np.zeros(self.rows.shape)
        np.add.at(counts, (at, langs), seen)
        self.shown = counts > 0
        self.rows[self.shown] = np.log((counts / np.maximum(totals, 1))[self.shown])

    def __len__(self) -> int:
        return len(self.hashes)

    def find(self, grams: list[str]) -> np.ndarray:
        """The place of each, -1 where it is unknown."""
        wanted = np.array([xxhash.xxh64_intdigest(g, SEED) for g in grams], np.uint64).view(np.int64)
        if not len(self.hashes):
            return np.full(len(wanted), -1)
        at = np.minimum(np.searchsorted(self.hashes, wanted), len(self.hashes) - 1)
        return np.where(self.hashes[at] == wanted, at, -1)

    def __contains__(self, gram: str) -> bool:
        return bool(self.find([gram])[0] >= 0)


class Model:
    """Per-language log frequencies of words and n-grams, as arrays of numbers."""

    def __init__(self, languages: list[str], entries: Iterable[tuple[str, int, str, int]] = ()):
        """From (lang, n, gram, seen); n = 0 are words."""
        self.languages = sorted(languages)
        place = {name: i for i, name in enumerate(self.languages)}
        rows = [(place[lang], n, xxhash.xxh64_intdigest(gram, SEED), seen) for lang, n, gram, seen in entries]
        langs, lengths, hashes, seen = zip(*rows, strict=True) if rows else ((), (), (), ())
        self._fill(np.array(langs, np.int64), np.array(lengths, np.int64), np.array(hashes, np.uint64).view(np.int64), np.array(seen, float))

    @classmethod
    def of_columns(cls, languages: list[str], langs: np.ndarray, lengths: np.ndarray, hashes: np.ndarray, seen: np.ndarray) -> Model:
        """From columns: each entry's place in the sorted languages, n, hash and count."""
        model = cls(languages)
        model._fill(langs, lengths, hashes, seen)
        return model

    def _fill(self, langs: np.ndarray, lengths: np.ndarray, hashes: np.ndarray, seen: np.ndarray) -> None:
        self.tables = []
        for n in range(LONGEST + 1):
            own = lengths == n
            self.tables.append(Table(hashes[own], langs[own], seen[own], len(self.languages)))

    def _grams(self, words: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
        """The places of the words' n-grams, and the word of each."""
        parts = [grams(w, n) for w in words]
        owner = np.repeat(np.arange(len(words)), [len(p) for p in parts])
        return self.tables[n].find([g for p in parts for g in p]), owner

    def scores(self, words: list[str]) -> np.ndarray:
        """A row for each word: its own log frequencies, else the mean of its longest known n-grams'; 0
        if nothing is known."""
        found = self.tables[0].find(words)
        scored = np.zeros((len(words), len(self.languages)))
        scored[found >= 0] = self.tables[0].rows[found[found >= 0]]
        open_words = np.flatnonzero(found < 0)
        for n in range(LONGEST, 0, -1):
            if not len(open_words):
                break
            at, owner = self._grams([words[i] for i in open_words], n)
            owner, at = owner[at >= 0], at[at >= 0]
            counts = np.bincount(owner, minlength=len(open_words))
            sums, known = _sums(self.tables[n].rows[at], owner, len(open_words)), counts > 0
            scored[open_words[known]] = sums[known] / counts[known, None]
            open_words = open_words[~known]
        return scored

    def score(self, word: str) -> np.ndarray:
        return self.scores([word])[0]

    def known(self, words: list[str]) -> np.ndarray:
        """How far each language knows each word: 1 if it showed it, else half the share of its longest
        n-grams that it showed."""
        shares = np.zeros((len(words), len(self.languages)), np.float32)
        sizes = np.array([min(LONGEST, len(w) + 2) for w in words])
        for n in np.unique(sizes):
            own = np.flatnonzero(sizes == n)
            at, owner = self._grams([words[i] for i in own], int(n))
            parts = np.bincount(owner, minlength=len(own))
            sums = _sums(self.tables[n].shown[at[at >= 0]].astype(np.float32), owner[at >= 0], len(own))
            shares[own] = sums / np.maximum(2 * parts, 1)[:, None]
        found = self.tables[0].find(words)
        shares[found >= 0] = np.maximum(shares[found >= 0], self.tables[0].shown[found[found >= 0]])
        return shares


def fit(labelled: DataFrame, max_documents: int = 20_000) -> Model:
    """Learns from rows with text and lang. Of more than `max_documents` rows a share by hash of the
    text is used that leaves about as many, whatever the input's size; all words and n-grams of these
    rows stay, for every language."""
    rows = small_batches(labelled).where("text is not null and lang is not null").select("lang", "text")
    count = rows.count()
    if count > max_documents:
        share = int(2**31 * max_documents / count)
        rows = rows.where(F.xxhash64("text").bitwiseAND(F.lit(2**31 - 1)) < share)
    counted = rows.mapInArrow(_count, "lang string, n int, gram string, seen bigint")
    total = stored(counted.groupBy("lang", "n", "gram").agg(F.sum("seen").alias("seen")))
    languages = sorted(r["lang"] for r in total.select("lang").distinct().collect())
    # Numbers alone reach the driver: the hash is the one that tasks form.
    table = total.select("lang", "n", F.xxhash64("gram").alias("hash"), "seen").toArrow()
    place = pc.index_in(table["lang"], pa.array(languages, pa.string())).to_numpy()
    columns = [table[c].to_numpy() for c in ("n", "hash", "seen")]
    return Model.of_columns(languages, place.astype(np.int64), columns[0].astype(np.int64), columns[1], columns[2].astype(float))


def _predict(model: Model, text_column: str, with_known: bool = False):
    size = len(model.languages)

    def learn(words: list[str], rows: np.ndarray, known: np.ndarray) -> None:
        for at in range(0, len(words), CHUNK):
            part = words[at : at + CHUNK]
            rows[at : at + len(part)] = model.scores(part)
            if with_known:
                known[at : at + len(part)] = model.known(part)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, int] = {}
        rows, known = np.zeros((REMEMBERED, size)), np.zeros((REMEMBERED, size), np.float32)
        for batch in batches:
            names, scores, shares = [], [], []
            texts = batch.column(text_column)
            # A few texts at a time: as Python's strings they take several times their size.
            for at in range(0, len(texts), SLICE):
                counted = [Counter(LETTERS.findall((t or "").lower())) for t in texts.slice(at, SLICE).to_pylist()]
                fresh = list(dict.fromkeys(w for counts in counted for w in counts if w not in seen))
                if len(seen) + len(fresh) > len(rows):
                    seen, fresh = {}, list(dict.fromkeys(w for counts in counted for w in counts))
                    if len(fresh) > len(rows):
                        rows, known = np.zeros((len(fresh), size)), np.zeros((len(fresh), size), np.float32)
                learn(fresh, rows[len(seen) :], known[len(seen) :])
                seen.update(zip(fresh, range(len(seen), len(seen) + len(fresh)), strict=True))
                for counts in counted:
                    if not (size and any(c.isalpha() for w in counts for c in w)):
                        names.append(UNKNOWN)
                        scores.append(0.0)
                        shares.append(0.0)
                        continue
                    times, places = np.fromiter(counts.values(), float, len(counts)), [seen[w] for w in counts]
                    evidence = times @ rows[places]
                    best = int(evidence.argmax())
                    names.append(model.languages[best])
                    scores.append(float(1 / np.exp(evidence - evidence[best]).sum()))
                    shares.append(float(times @ known[places, best] / times.sum()))
            more = {"known": pa.array(shares, pa.float64())} if with_known else {}
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64()), *more.values()],
                names=[*batch.schema.names, "lang_pred", "score", *more],
            )

    return run


def identify(docs: DataFrame, model: Model, carried: Sequence[str] = ("doc_id",), results: tuple[str, ...] = ("lang_pred", "score")) -> DataFrame:
    """The columns named in `carried`, and the prediction and score of every row's whole text, named
    by `results`; a third name there stands for how far the predicted language knows the text's words,
    from 0 to 1.

    Nothing but the text enters a prediction. Null texts and texts without a letter, and all texts
    if nothing was learned, are `und` with score 0. Equal evidence goes to the first language by
    name. Repeated rows get equal answers; columns that are not named, whatever they are called,
    stay out.
    """
    types = dict(docs.dtypes)
    names = [*carried, *([] if "text" in carried else ["text"])]
    rows = small_batches(docs).select(*[F.col(c).alias(f"c_{i}") for i, c in enumerate(names)])
    given = [f"c_{i} {types[c]}" for i, c in enumerate(names)]
    at = names.index("text")
    new = ["lang_pred string", "score double", "known double"][: len(results)]
    predicted = rows.mapInArrow(_predict(model, f"c_{at}", len(results) > 2), ", ".join([*given, *new]))
    answers = [F.col(t.split()[0]).alias(c) for t, c in zip(new, results, strict=True)]
    return predicted.select(*[F.col(f"c_{i}").alias(c) for i, c in enumerate(carried)], *answers)


def accepted(min_score: float = 0.3, results: tuple[str, str, str] = ("lang_pred", "score", "known"), min_known: float = 0.5) -> Column:
    """Whether a prediction names a language with at least this posterior that knows at least this
    share of the text's words. The posterior alone only compares the languages learned: it nears 1
    with a text's length in any other language, too."""
    return (F.col(results[0]) != UNKNOWN) & (F.col(results[1]) >= min_score) & (F.col(results[2]) >= min_known)
