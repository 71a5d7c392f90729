"""SentencePiece BPE encoding and decoding in vectorised merge rounds.

Each distinct word of a batch becomes a run of symbols in one flat array. In a round every word
finds the smallest rank among its adjacent pairs and merges the leftmost pair of that rank, and
with it all further such pairs where that cannot change the order; all words do so at once, and
the array is compacted. It ends when no pair of any word is a piece. Nothing here calls the
sentencepiece library's encoder or decoder; the library only reads the model file.

Pieces never hold the space mark behind another character, so that no merge crosses the start of a
word (this is checked when a model is loaded). Words are encoded once per task and then looked up.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinomart.llm.common import small_batches, texts

MARK = "▁"
WORDS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
#: Where no piece holds a full stop or comma behind a Latin letter, words also end there.
LETTER = "[A-Za-zÀ-ÖØ-öø-ÿ]"
_REST = f"(?:[^{MARK}.,]+|(?<!{LETTER})[.,])"
SENTENCE_WORDS = re.compile(f"{MARK}*{_REST}+|[.,]{_REST}*|{MARK}+")
NONE = np.int64(1 << 40)
#: Distinct words a task remembers before it starts anew: bounds its memory, not its results.
REMEMBERED = 300_000
ROUND_SYMBOLS = 1 << 17
#: Bytes of text that are split into words at a time.
PORTION = 1 << 21
#: Stands between words while a text is split; texts that hold it are split more slowly.
SEPARATOR = "\x00"
CUT = re.compile(f"(?<=[^ {MARK}]) ")


class Vocabulary:
    """The pieces of a BPE model with byte fallback and without normalisation rules."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.plain: tuple[np.ndarray, ...] | None = None
        self.special = {i for i in range(size) if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
        plain = [i for i in range(size) if i not in self.special and i not in self.byte_of]
        if len(self.bytes) != 256:
            raise ValueError("the model has no byte fallback")
        if any(re.search(f"[^{MARK}]{MARK}", self.pieces[i]) for i in plain):
            raise ValueError("a piece holds a space mark behind another character")
        scores = np.array([model.get_score(i) for i in range(size)])
        # Equal scores get equal ranks; the leftmost pair then goes first.
        ranks = np.unique(-scores, return_inverse=True)[1].astype(np.int64)
        self.id_of = {self.pieces[i]: i for i in plain}
        self.characters = {p: i for p, i in self.id_of.items() if len(p) == 1}
        keys, made = [], []
        for piece, i in self.id_of.items():
            for cut in range(1, len(piece)):
                left, right = self._symbol(piece[:cut]), self._symbol(piece[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    made.append(i)
        self.pair_keys = np.array(keys, np.int64)
        self.pair_ids = np.array(made, np.int64)
        self.pair_ranks = np.r_[ranks[self.pair_ids], NONE]  # the last stands for no pair
        self.pair_ids = np.r_[self.pair_ids, 0]
        self.slots = self._place_pairs()
        # A merge may be repeated within its round if the piece it makes begins no better pair.
        best = np.full(size, NONE)
        np.minimum.at(best, self.pair_keys >> 32, self.pair_ranks[:-1])
        np.minimum.at(best, self.pair_keys & 0xFFFFFFFF, self.pair_ranks[:-1])
        self.repeatable = best > ranks
        inside = any(re.search(f"{LETTER}[.,]", p) for p in self.id_of)
        self.words = WORDS if inside else SENTENCE_WORDS

    def _symbol(self, piece: str) -> int | None:
        return self.id_of.get(piece)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(44)).astype(np.int64)

    def _place_pairs(self) -> np.ndarray:
        """An open-addressed table of 2^20 places, -1 where empty, else the number of a pair."""
        slots = np.full(1 << 20, -1, np.int64)
        left = np.arange(len(self.pair_keys))
        place = self._home(self.pair_keys)
        while len(left):
            empty = slots[place[left]] < 0
            slots[place[left[empty]]] = left[empty]
            left = left[slots[place[left]] != left]
            place[left] = (place[left] + 1) & (len(slots) - 1)
        return slots

    def _pairs(self, keys: np.ndarray) -> np.ndarray:
        """The number of each pair, or the number behind the last where it makes no piece."""
        place = self._home(keys)
        pair = self.slots[place]
        wrong = np.flatnonzero((pair >= 0) & (self.pair_keys[pair] != keys))
        while len(wrong):
            place[wrong] = (place[wrong] + 1) & (len(self.slots) - 1)
            pair[wrong] = self.slots[place[wrong]]
            wrong = wrong[(pair[wrong] >= 0) & (self.pair_keys[pair[wrong]] != keys[wrong])]
        pair[pair < 0] = len(self.pair_keys)
        return pair

    def encode_words(self, words: list[str]) -> list[np.ndarray]:
        """The ids of each word (with its space marks), in merge rounds over all words together."""
        size = len(self.pieces)
        lengths = np.array([len(w) for w in words], np.int64)
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        known, place = np.unique(points, return_inverse=True)
        # Characters without a piece get a symbol of their own beyond the ids; no pair holds one.
        table = np.array([self.characters.get(chr(c), size + k) for k, c in enumerate(known)], np.int64)
        symbols = table[place] if len(points) else points
        word = np.repeat(np.arange(len(words)), lengths)
        done_word, done_symbol, done_place = [], [], []
        position = np.arange(len(symbols))
        while len(symbols):
            border = word[:-1] != word[1:]
            at = self._pairs(symbols[:-1] << 32 | symbols[1:])
            rank = self.pair_ranks[at]
            rank[border] = NONE
            starts = np.flatnonzero(np.r_[True, border])
            least = np.minimum.reduceat(np.r_[rank, NONE], starts)
            runs = np.diff(np.r_[starts, len(word)])
            open_ = np.repeat(least < NONE, runs)
            if not open_.all():  # words without a pair are finished and leave the arrays
                done_word.append(word[~open_])
                done_symbol.append(symbols[~open_])
                done_place.append(position[~open_])
                symbols, word, position = symbols[open_], word[open_], position[open_]
                if not len(symbols):
                    break
                inside = open_[:-1] & open_[1:]
                # Pairs between a finished and an open word were none before; rebuild the rest.
                rank_all = np.r_[rank, NONE]
                rank_all[np.flatnonzero(~np.r_[inside, False])] = NONE
                made_all = np.r_[self.pair_ids[at], 0]
                rank, made = rank_all[open_][:-1], made_all[open_][:-1]
                runs, least = runs[least < NONE], least[least < NONE]
            else:
                made = self.pair_ids[at]
            hit = np.flatnonzero(np.r_[rank, NONE] == np.repeat(least, runs))
            first = np.r_[True, word[hit[1:]] != word[hit[:-1]]]
            anchor = made[hit][np.maximum.accumulate(np.where(first, np.arange(len(hit)), 0))]
            # Besides the leftmost pair, the same pair further right where the order allows it.
            take = first | (self.repeatable[anchor] & (made[hit] == anchor))
            hit = hit[take]
            # Of pairs that overlap in a run such as aaaa every other one is taken, from the left.
            linked = np.r_[False, hit[1:] == hit[:-1] + 1]
            head = np.maximum.accumulate(np.where(linked, 0, np.arange(len(hit))))
            hit = hit[(np.arange(len(hit)) - head) % 2 == 0]
            symbols[hit] = made[hit]
            keep = np.ones(len(symbols), bool)
            keep[hit + 1] = False
            symbols, word, position = symbols[keep], word[keep], position[keep]
        if not done_word:
            return [np.zeros(0, np.int32) for _ in words]
        order = np.argsort(np.concatenate(done_place), kind="stable")
        symbols = np.concatenate(done_symbol)[order]
        word = np.concatenate(done_word)[order]
        if (symbols >= size).any():
            symbols, word = self._fall_back(symbols, word, known)
        ends = np.cumsum(np.bincount(word, minlength=len(words))).tolist()
        symbols = symbols.astype(np.int32)
        return [symbols[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def _fall_back(self, symbols: np.ndarray, word: np.ndarray, known: np.ndarray):
        """Characters without a piece as their UTF-8 bytes."""
        size = len(self.pieces)
        spelled = [[self.bytes[b] for b in chr(c).encode("utf-8", "surrogatepass")] for c in known]
        lengths = np.ones(len(symbols), np.int64)
        lost = np.flatnonzero(symbols >= size)
        which = symbols[lost] - size
        lengths[lost] = np.array([len(x) for x in spelled], np.int64)[which]
        start = np.cumsum(lengths) - lengths
        out, word = np.repeat(symbols, lengths), np.repeat(word, lengths)
        padded = np.array([x + [0] * (4 - len(x)) for x in spelled], np.int64)
        for k in range(4):
            longer = lengths[lost] > k
            out[start[lost[longer]] + k] = padded[which[longer], k]
        return out, word

    def decode(self, ids: list[int]) -> str:
        """The text of ids: pieces joined, byte runs read as UTF-8 with U+FFFD for each byte that is
        none, space marks as spaces, without the space that encoding put in front."""
        out, run = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            if run:
                out.append(_utf8(run))
                run = bytearray()
            if i not in self.special:
                out.append(self.pieces[i])
            elif self.pieces[i] == "<unk>":
                out.append(" ⁇ ")
        if run:
            out.append(_utf8(run))
        text = "".join(out)
        first = ids[0] if len(ids) else -1
        if first >= 0 and first not in self.byte_of and text.startswith(MARK):
            text = text[1:]
        return text.replace(MARK, " ")

    def _plain(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The pieces' UTF-8 bytes in a row with spaces for marks, where each begins, its length, whether it
        begins with a mark, and whether it stands for something else than its own text."""
        spaced = [p.replace(MARK, " ").encode() for p in self.pieces]
        lengths = np.array([len(p) for p in spaced], np.int64)
        odd = np.zeros(len(spaced), bool)
        odd[[*self.byte_of, *self.special]] = True
        marked = np.array([p.startswith(MARK) for p in self.pieces])
        return np.frombuffer(b"".join(spaced), np.uint8), np.cumsum(lengths) - lengths, lengths, marked, odd

    def decode_lists(self, lists: pa.ListArray) -> list[str]:
        """Each list's text; those of plain pieces are put together as bytes, for all lists at once."""
        if self.plain is None:
            self.plain = self._plain()
        data, starts, lengths, marked, odd = self.plain
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        last = np.cumsum(counts)
        strange = np.r_[0, np.cumsum(odd[flat])]
        place, ends = _gather(starts, lengths, flat)
        text, byte_ends = data[place], np.r_[0, ends]
        out = []
        for i, (low, high) in enumerate(zip(last - counts, last, strict=True)):
            if strange[high] > strange[low]:
                out.append(self.decode(flat[low:high].tolist()))
            else:  # without the space that encoding put in front
                begin = byte_ends[low] + (high > low and marked[flat[low]])
                out.append(text[begin : byte_ends[high]].tobytes().decode())
        return out


def _utf8(run: bytearray) -> str:
    try:
        return run.decode("utf-8")
    except UnicodeDecodeError:
        pass
    out, k = [], 0
    while k < len(run):
        for n in (1, 2, 3, 4):
            try:
                out.append(run[k : k + n].decode("utf-8"))
                k += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            k += 1
    return "".join(out)


def portions(text: str, size: int = PORTION) -> Iterator[str]:
    """A long text in parts that begin with a word, so that each is encoded by itself."""
    start = 0
    while start < len(text):
        cut = CUT.search(text, start + size)
        end = cut.start() if cut else len(text)
        yield text[start:end]
        start = end


def _gather(starts: np.ndarray, lengths: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the runs `at`, one after the other, and where each of them ends."""
    ends = np.cumsum(lengths[at])
    shift = starts[at] - ends + lengths[at]
    return np.repeat(shift, lengths[at]) + np.arange(ends[-1] if len(ends) else 0), ends


class Encoder:
    """Encodes texts word by word; remembers the words of a task up to a bound."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.seen = vocabulary, {}
        self.letter_end = vocabulary.words is SENTENCE_WORDS

    def _ids_of(self, words: list[str]) -> list[bytes]:
        """The ids of distinct words as bytes of int32."""
        if len(self.seen) > REMEMBERED:
            self.seen = {}
        seen = self.seen
        seen[""] = b""
        fresh = [w for w in words if w not in seen]
        at = 0
        while at < len(fresh):  # rounds over a bounded number of symbols
            end, symbols = at, 0
            while end < len(fresh) and (end == at or symbols + len(fresh[end]) <= ROUND_SYMBOLS):
                symbols += len(fresh[end])
                end += 1
            found = self.vocabulary.encode_words(fresh[at:end])
            seen.update((w, ids.tobytes()) for w, ids in zip(fresh[at:end], found, strict=True))
            at = end
        return [seen[w] for w in words]

    def encode(self, texts: pa.Array, begins: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, and the place where each text ends."""
        texts = pc.fill_null(texts, "")
        empty = pc.equal(pc.binary_length(texts), 0)
        # Spaces become marks and a word begins at each run of marks.
        marked = pc.replace_substring(pc.replace_substring(texts, MARK, " "), " ", SEPARATOR + MARK)
        if begins:
            marked = pc.if_else(empty, "", pc.binary_join_element_wise(MARK, marked, ""))
        lists = pc.split_pattern(pc.replace_substring(marked, MARK + SEPARATOR, MARK), SEPARATOR)
        words = lists.flatten().dictionary_encode()
        pieces = words.dictionary
        if self.letter_end:
            pieces = pc.replace_substring_regex(pieces, f"({LETTER})([.,])", rf"\1{SEPARATOR}\2")
        pieces = pc.split_pattern(pieces, SEPARATOR)
        parts = pieces.flatten().dictionary_encode()
        known = self._ids_of(parts.dictionary.to_pylist())
        lengths = np.fromiter(map(len, known), np.int64, len(known)) // 4
        pool = np.frombuffer(b"".join(known), np.int32)
        first = pieces.offsets.to_numpy()
        at, ends = _gather(first[:-1].astype(np.int64), np.diff(first), words.indices.to_numpy())
        place, stops = _gather(np.cumsum(lengths) - lengths, lengths, parts.indices.to_numpy()[at])
        word_ends = np.r_[0, stops][ends]
        return pool[place], word_ends[lists.offsets.to_numpy()[1:] - 1]

    def encode_one(self, text: str) -> np.ndarray:
        """The ids of a long text, or of one that holds SEPARATOR: memory follows PORTION and the ids."""
        found = [np.zeros(0, np.int32)]
        for k, part in enumerate(portions(text)):
            if SEPARATOR in part:
                words = WORDS.findall(MARK * (k == 0) + part.replace(" ", MARK))
                ids = dict(zip(distinct := list(dict.fromkeys(words)), self._ids_of(distinct), strict=True))
                found.append(np.frombuffer(b"".join(ids[w] for w in words), np.int32))
            else:
                found.append(self.encode(pa.array([part]), k == 0)[0])
        return np.concatenate(found)

    def encode_batch(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(rows, ids, ends) for row after row of `texts`, in runs of at most PORTION bytes."""
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        alone = sizes > PORTION
        alone |= pc.fill_null(pc.match_substring(texts, SEPARATOR), False).to_numpy(zero_copy_only=False)
        at = 0
        while at < len(sizes):
            if alone[at]:
                ids = self.encode_one(texts[at].as_py())
                yield 1, ids, np.array([len(ids)])
                at += 1
                continue
            end, held = at, 0
            while end < len(sizes) and not alone[end] and (end == at or held + sizes[end] <= PORTION):
                held += sizes[end]
                end += 1
            yield end - at, *self.encode(texts.slice(at, end - at))
            at = end


@lru_cache(1)
def _vocabulary(path: str) -> Vocabulary:
    """Built once in a worker, for all its tasks."""
    return Vocabulary(path)


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(_vocabulary(path))
        for batch in batches:
            at = 0
            for rows, ids, ends in encoder.encode_batch(batch.column("text")):
                offsets = pa.array(np.r_[0, ends].astype(np.int32))
                listed = pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, rows), listed], names=["doc_id", "ids"])
                at += rows

    return run


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("ids"), pa.array(vocabulary.decode_lists(part.column("ids")), pa.string())],
                    names=["doc_id", "ids", "decoded"],
                )

    return run


def _round_trip(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _decode(path)(_encode(path)(batches))

    return run


def encode(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, ids (array of int): the whole text's ids without begin or end ids. Null and empty texts
    have no ids; each row is encoded by itself, so repeated rows and doc_ids stay as they are."""
    return texts(small_batches(docs)).mapInArrow(_encode(model), "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id, ids, decoded: the text of each row's ids; null ids count as none."""
    return encoded.select("doc_id", "ids").mapInArrow(_decode(model), "doc_id bigint, ids array<int>, decoded string")


def round_trip(docs: DataFrame, model: str) -> DataFrame:
    """What `decode` makes of `encode`, in one task for each text: doc_id, ids, decoded."""
    return texts(small_batches(docs)).mapInArrow(_round_trip(model), "doc_id bigint, ids array<int>, decoded string")


def token_digests(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row, encoded and decoded again."""
    return round_trip(docs, model).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
