"""Surrogates for personal data.

Detected entities are replaced by keyed surrogates of the same type, script and format; equal
entities get equal surrogates everywhere (coreference), different ones different ones.

Numbers, addresses and keys go through a keyed permutation of all strings of their shape (a Feistel
network walked until the result is of the same type again), which cannot collide. First names are
permuted among the names of their gender and script. Surnames are open: theirs are spelled from
syllables of their script, and a pass over all surnames of the corpus finds those that collide and
gives them another try, until none does.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinomart.llm.common import stored

MAX_EXCEPTIONS = 100_000

#: First names by script and gender.
FIRST_NAMES = {
    ("latin", "f"): tuple(
        """
        Alice Amanda Amelia Amy Ana Andrea Angela Anna Anne Barbara Beatriz Brigitte Camille Carla Carmen
        Carol Catherine Charlotte Chiara Christine Claire Clara Claudia Cristina Deborah Diana Dorothy Elena
        Elisabeth Elizabeth Emily Emma Esther Eva Francesca Franziska Gabriele Giulia Hannah Heike Helen Helga
        Ingrid Inés Isabel Isabelle Jane Jennifer Jessica Julia Julie Karen Karin Katharina Kathrin Laura
        Linda Lisa Lucia Lucy Lucía Léa Manon Margaret Maria Marie Marta Martha Mary María Michelle Monika
        Nancy Nathalie Nicole Nina Olivia Patricia Petra Pilar Rachel Rebecca Renate Rosa Ruth Sabine Samantha
        Sandra Sara Sarah Silvia Sofia Sofía Sophie Stefanie Stephanie Susan Susanne Sylvie Teresa Ursula
        Valentina Valérie Victoria Virginie
        """.split()
    ),
    ("latin", "m"): tuple(
        """
        Adam Albert Alberto Alejandro Alexander Alfred Andreas Andrew Anthony Antoine Antonio Arthur Benjamin
        Bernard Bernd Brian Carlos Charles Christian Christoph Christopher Daniel David Diego Dieter Dominik
        Donald Edward Enrique Eric Felix Fernando Florian Francesco Francisco Franz François Friedrich Gary
        Georg George Gerhard Giovanni Giuseppe Guillaume Günter Hans Heinz Helmut Henri Henry Hugo Jacob
        Jacques James Jan Javier Jean Jeffrey Jens Joachim Johannes John Jonas Jonathan Joseph José Juan
        Jérôme Jürgen Kenneth Kevin Klaus Laurent Lorenzo Luca Lucas Luis Lukas Manfred Manuel Marco Markus
        Martin Matthew Matthias Max Michael Michel Miguel Nicolas Oliver Pablo Pascal Patrick Paul Pedro Peter
        Philip Philippe Pierre Rafael Rainer Ralf Richard Robert Roberto Ryan Samuel Scott Sebastian Sergio
        Simon Stefan Stephen Steven Thierry Thomas Timothy Uwe Vincent Walter Werner William Wolfgang
        """.split()
    ),
    ("cyrillic", "f"): tuple(
        """
        Александра Алина Алла Анастасия Анна Валентина Валерия Вера Виктория Галина Дарья Евгения Екатерина
        Елена Елизавета Зинаида Инна Ирина Ксения Лариса Лидия Людмила Маргарита Марина Мария Надежда Наталия
        Наталья Нина Оксана Ольга Полина Раиса Светлана София Тамара Татьяна Юлия Яна
        """.split()
    ),
    ("cyrillic", "m"): tuple(
        """
        Александр Алексей Анатолий Андрей Антон Артём Борис Вадим Валерий Василий Виктор Виталий Владимир
        Владислав Вячеслав Геннадий Георгий Григорий Денис Дмитрий Евгений Егор Иван Игорь Илья Кирилл
        Константин Леонид Максим Михаил Никита Николай Олег Павел Пётр Роман Сергей Станислав Степан Фёдор
        Юрий Яков
        """.split()
    ),
}
#: Titles in front of a name, without their stop.
TITLES = frozenset(
    """
    Mr Mrs Ms Miss Sir Dr Prof Professor Doctor Doktor Herr Herrn Frau Mme Mlle Madame Monsieur Mademoiselle Señor Señora Señorita Sr Sra Srta
    Dra Don Doña Signor Signora Господин Госпожа Доктор Профессор
    """.split()
)
#: Consonants and vowels surnames are spelled from.
SYLLABLES = {"latin": ("bdfghklmnprstvw", "aeiou"), "cyrillic": ("бвгдзклмнпрст", "аеиоу")}
#: Characters that stand for each other: digits, and the letters of a case and script.
ALPHABETS = (
    "0123456789",
    "abcdefghijklmnopqrstuvwxyz",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "".join(chr(c) for c in range(0xE0, 0x100) if c != 0xF7),
    "".join(chr(c) for c in range(0xC0, 0xDF) if c != 0xD7),
    "".join(map(chr, range(0x430, 0x450))),
    "".join(map(chr, range(0x410, 0x430))),
    "".join(map(chr, range(0x4E00, 0x9FA6))),
)
HEX = "0123456789abcdef"
OPTIONS = {"access_key": "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "hex_secret": HEX}

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
ENTITIES = re.compile(
    "|".join(
        (
            r"(?P<email>(?<![\w.+-])[\w.+-]+@[\w-]+(?:\.[\w-]+)+(?![\w-]))",
            rf"(?P<ip>(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\w|\.\d))",
            r"(?P<access_key>(?<!\w)AKIA[A-Z0-9]{16}(?!\w))",
            r"(?P<hex_secret>(?<![0-9A-Za-z])[0-9a-f]{40}(?![0-9A-Za-z])|(?<=password=)[0-9a-f]{8,64}(?![0-9A-Za-z]))",
            r"(?P<secret>(?<=password=)[^\s\"']{6,})",
            r"(?P<iban>(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w))",
            r"(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))",
            r"(?P<phone>(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,5}){1,4}(?!\w)"
            r"|(?<!\w)\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\w)|(?<![\w.-])(?:\d{3}-\d{3}-\d{4}|\d{3}\.\d{3}\.\d{4})(?![\w-]))",
            r"(?P<card>(?<![\w.-])(?:[3-6]|2(?=2(?:0[0-4]|2[1-9]|[3-9]\d)|[3-6]\d\d|7[01]\d|720))(?:[ -]?\d){12,18}(?![\w-]))",
        )
    )
)
_WORD = "[A-ZÀ-ÖØ-ÞЀ-Я][a-zß-öø-ÿа-џ]+"
#: White space within a name: at most one line break.
_GAP = r"(?:[^\S\n]+|[^\S\n]*\n[^\S\n]*)"
PAIR = re.compile(rf"(?<!\w)({_WORD}\.?)(?=({_GAP})({_WORD}(?:-{_WORD})?)(?!\w))")
FURTHER = re.compile(rf"[^\S\n]+({_WORD}(?:-{_WORD})?)(?!\w)")
GENDER = {n: key for key, names in FIRST_NAMES.items() for n in names}


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed([int(c) for c in digits if c.isdigit()])):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _card_ends(run: str) -> tuple[list[int], list[int]]:
    """Where a card that begins a run of digits can end, behind a whole group: ends that pass Luhn, and
    those of 15 and 16 digits; 16 and 15 digits come before others."""
    ends, digits = [], 0
    for m in re.finditer(r"\d+", run):
        digits += len(m[0])
        if 13 <= digits <= 19:
            ends.append((digits, m.end()))
    ends.sort(key=lambda e: (e[0] != 16, e[0] != 15, -e[0]))
    return [e for _, e in ends if luhn(run[:e])], [e for n, e in ends if n in (15, 16)]


def _usual(card: str) -> bool:
    return [len(g) for g in re.findall(r"\d+", card)] in ([len(card)], [4, 4, 4, 4], [4, 6, 5])


def card_length(run: str) -> int:
    """The length of the card that a run of digits begins with; 0 if there is none, or if a card of
    usual groups that passes Luhn begins within a doubtful one."""
    sure, maybe = _card_ends(run)
    end = next((e for e in sure if _usual(run[:e])), 0)
    if end or not (sure or maybe):
        return end
    end = [*sure, *maybe][0]
    behind = sum(map(str.isdigit, run[end:]))
    if not _usual(run[:end]) or 0 < behind < 13:
        for m in re.finditer(r"(?<!\d)[2-6]", run[:end]):
            rest = run[m.start() :]
            if m.start() and any(_usual(rest[:e]) for e in _card_ends(rest)[0]):
                return 0
    return end


def _number(key: bytes, *parts: object) -> int:
    return int.from_bytes(hashlib.blake2b("\x1f".join(map(str, parts)).encode("utf-8", "surrogatepass"), key=key, digest_size=32).digest(), "big")


def permute(x: int, size: int, key: bytes, label: str, accept: Callable[[int], bool] = lambda _: True) -> int:
    """A keyed permutation of the numbers below `size` that `accept` takes; x is one of them."""
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    while True:
        left, right = x >> half, x & mask
        for r in range(8):
            left, right = right, left ^ (_number(key, label, size, r, right) & mask)
        x = left << half | right
        if x < size and accept(x):
            return x


def _shaped(text: str, key: bytes, kind: str, keep: int = 0, valid: Callable[[str], bool] = lambda _: True) -> str:
    """The string that a permutation of all strings of this shape puts in place of `text`."""
    sets = []
    for i, c in enumerate(text):
        options = OPTIONS.get(kind, "")
        own = options if c in options else next((a for a in ALPHABETS if c in a), c)
        sets.append(c if i < keep else own)
    size, x = 1, 0
    for c, options in zip(text, sets, strict=True):
        x = x * len(options) + options.index(c)
        size *= len(options)

    def spell(n: int) -> str:
        out = []
        for options in reversed(sets):
            n, at = divmod(n, len(options))
            out.append(options[at])
        return "".join(reversed(out))

    shape = kind + "|" + "".join(s[0] if len(s) > 1 else f"={s}" for s in sets)
    return spell(permute(x, size, key, shape, lambda n: valid(spell(n))))


def _is(kind: str, text: str) -> bool:
    found = ENTITIES.fullmatch(text)
    return bool(found) and found.lastgroup == kind


def _private(octets: list[int]) -> bool:
    a, b = octets[:2]
    return a in (0, 10, 127) or a >= 224 or (a, b) in ((192, 168), (169, 254)) or (a == 172 and 16 <= b < 32)


def surrogate(kind: str, text: str, key: bytes) -> str:
    """The replacement of an entity that is no name: same type and format."""
    if kind == "ip":
        parts = [int(p) for p in text.split(".")]
        value = int.from_bytes(bytes(parts), "big")
        new = permute(value, 2**32, key, kind, lambda n: _private(list(n.to_bytes(4, "big"))) == _private(parts))
        return ".".join(map(str, new.to_bytes(4, "big")))
    if kind == "email":
        local, domain = text.rsplit("@", 1)
        name, dot, top = domain.rpartition(".")
        body = _shaped(f"{local}@{name}", key, kind + dot + top, valid=lambda s: _is(kind, f"{s}.{top}"))
        return f"{body}.{top}"
    if kind == "card":
        return _shaped(text, key, kind, 4 if text[0] == "2" else 1, lambda s: luhn(s) == luhn(text))
    if kind == "phone":
        keep = len(re.match(r"\+\d{1,3}(?=\D)|\+?", text).group())
        area = text[keep:].lstrip(" (.-")[:1]
        first = text.index(area, keep)
        return _shaped(text, key, kind, keep, lambda s: _is(kind, s) and (s[first] > "1") == (area > "1"))
    if kind == "access_key":
        return _shaped(text, key, kind, 4)
    if kind == "iban":
        return _shaped(text, key, kind, 2, lambda s: _is(kind, s))
    return _shaped(text, key, kind)


def first_name(name: str, key: bytes) -> str:
    """Another first name of the same gender and script; a permutation of each list."""
    names = FIRST_NAMES[GENDER[name]]
    order = sorted(names, key=lambda n: _number(key, "first", n))
    return order[(order.index(name) + 1) % len(order)]


def surname(name: str, attempt: int, syllables: int, key: bytes) -> str:
    """A surname of the same script and number of parts, spelled from syllables."""
    parts = []
    for part in name.split("-"):
        consonants, vowels = SYLLABLES["cyrillic" if "Ѐ" <= part[0] <= "џ" else "latin"]
        n, word = _number(key, "surname", name, part, attempt), ""
        for _ in range(syllables):
            n, c = divmod(n, len(consonants))
            n, v = divmod(n, len(vowels))
            word += consonants[c] + vowels[v]
        parts.append(word.capitalize())
    return "-".join(parts)


def names_in(text: str) -> tuple[list[tuple[int, int]], set[str]]:
    """Where first names stand in front of a surname or behind a title, and the surnames found behind a
    first name or title.

    A first name of unknown gender behind a title counts as a surname, as does the word behind it. Words that
    the text also has in lower case are no surnames behind a line break or such a first name.
    """
    places, last = [], set()
    lower: set[str] = set()

    def common(word: str) -> bool:
        if not lower:
            lower.update(re.findall(r"\w+", text))
        return word.lower() in lower

    for m in PAIR.finditer(text):
        known, title = m[1] in GENDER, m[1].rstrip(".") in TITLES
        if not (known or title) or m[3] in TITLES or ("\n" in m[2] and common(m[3])):
            continue
        if known:
            places.append(m.span(1))
            last.add(m[3])
        elif m[3] in GENDER:
            places.append(m.span(3))
        else:
            last.add(m[3])
            further = FURTHER.match(text, m.end(3))
            if further and further[1] not in TITLES and not common(further[1]):
                last.add(further[1])
    return places, last


def replace(text: str, tries: dict[str, int], syllables: int, key: bytes) -> tuple[str, list[str]]:
    """The text with surrogates, and the types of what was replaced, in order.

    A surname found with a first name or title, and a first name found with a surname or title, is replaced
    wherever it stands as a word in the text. A word found as both is a first name where it was found as one.
    """
    kinds: list[str] = []

    first, last = names_in(text)
    given, spans = {text[a:b] for a, b in first}, set(first)
    if last or given:
        listed = re.compile(rf"(?<!\w)(?:{'|'.join(map(re.escape, sorted(last | given, key=lambda n: (-len(n), n))))})(?!\w)")
        found = [(m.start(), m.end(), m[0]) for m in listed.finditer(text)]
        out, at = [], 0
        for start, end, name in sorted({*found, *((a, b, text[a:b]) for a, b in first)}):
            if start >= at:
                is_first = name in given and (name not in last or (start, end) in spans)
                out += [text[at:start], first_name(name, key) if is_first else surname(name, tries.get(name, 0), syllables, key)]
                at = end
                kinds.append("name")
        text = "".join([*out, text[at:]])
    if re.search(r"[0-9@]|password=", text):
        out, at = [], 0
        m = ENTITIES.search(text)
        while m:
            kind, (start, end) = m.lastgroup, m.span()
            if kind == "card":
                run = re.match(r"\d(?:[ -]?\d){,37}(?!\d)|\d+", text[start : start + 80])[0]
                end = start + card_length(run)
            if start < end:
                out += [text[at:start], surrogate(kind, text[start:end], key)]
                kinds.append(kind)
                at = end
            # What the pattern took along is searched too, behind a card or else behind the first digits.
            m = ENTITIES.search(text, end if start < end else start + len(re.match(r"\d+", m[0])[0]))
        text = "".join([*out, text[at:]])
    return text, kinds


def _find_surnames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = {n for t in batch.column("text").to_pylist() if t for n in names_in(t)[1]}
        yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.string())], names=["name"])


def _spell(syllables: int, key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, tries = batch.column("name").to_pylist(), batch.column("attempt").to_pylist()
            new = [surname(n, a, syllables, key) for n, a in zip(names, tries, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("name"), batch.column("attempt"), pa.array(new, pa.string())], names=["name", "attempt", "new"])

    return run


def resolved_surnames(docs: DataFrame, key: bytes, syllables: int = 5) -> tuple[dict[str, int], int]:
    """Which surnames need another try so that no two of the corpus share a surrogate and none is
    itself a surname of the corpus, and how many syllables surrogates have.

    The names stay in Spark. Only the exceptions reach the driver, if they are at most
    MAX_EXCEPTIONS; else surrogates get a syllable more, and hundredfold fewer collide.
    """
    names = stored(
        docs.select("text").where("text is not null").mapInArrow(_find_surnames, "name string").distinct()
    )
    while True:
        state = names.withColumn("attempt", F.lit(0))
        while True:
            spelled = stored(state.mapInArrow(_spell(syllables, key), "name string, attempt int, new string"))
            taken = spelled.select(F.col("name").alias("new")).withColumn("real", F.lit(True))
            # Surrogates are hashes: no key of this window is hot.
            rank = F.row_number().over(Window.partitionBy("new").orderBy("name"))
            judged = spelled.join(taken, "new", "left").withColumn("rank", rank)
            state = stored(
                judged.select(
                    "name", (F.col("attempt") + F.when(F.col("real") | (F.col("rank") > 1), 1).otherwise(0)).alias("attempt"),
                    (F.col("real") | (F.col("rank") > 1)).alias("again"),
                )
            )
            again = not state.where("again").isEmpty()
            state = state.drop("again")
            if not again:
                break
        exceptions = state.where("attempt > 0").limit(MAX_EXCEPTIONS + 1).collect()
        if len(exceptions) <= MAX_EXCEPTIONS:
            return {r.name: r.attempt for r in exceptions}, syllables
        syllables += 1


def _replace_all(tries: dict[str, int], syllables: int, key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [(None, []) if t is None else replace(t, tries, syllables, key) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([t for t, _ in done], pa.string()), pa.array([k for _, k in done], pa.list_(pa.string()))],
                names=["doc_id", "text", "kinds"],
            )

    return run


def pseudonymize(docs: DataFrame, key: bytes) -> DataFrame:
    """doc_id, text, n_entities, kinds: every row's whole text with surrogates.

    `key` (not empty, at most 64 bytes) is the caller's secret: who has it can undo the permutations, and equal
    keys give equal surrogates from run to run.
    Null texts stay null and empty ones empty, without entities. A surrogate depends on the key and
    the entity, and for surnames on the corpus; repeated rows get equal texts. A permutation may map
    an entity to itself, with a chance of one in the number of strings of its shape.
    """
    if not key:
        raise ValueError("surrogates need a secret key")
    tries, syllables = resolved_surnames(docs, key)
    rows = docs.select("doc_id", "text").mapInArrow(
        _replace_all(tries, syllables, key), "doc_id bigint, text string, kinds array<string>"
    )
    return rows.select(
        "doc_id", "text", F.size("kinds").cast("long").alias("n_entities"), F.array_join(F.array_sort(F.array_distinct("kinds")), ",").alias("kinds")
    )
