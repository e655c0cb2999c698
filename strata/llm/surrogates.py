"""Operator 2: replacement of personal data by keyed surrogates.

Detected entities get a surrogate of the same kind and format that depends on a secret key and the
entity alone, so every mention of it in the corpus gets the same one. Given names keep gender and
script, surnames keep the script, card numbers keep their check digit, addresses stay addresses.
Names are found after titles, with a listed given name, or by words around them ("my name is", "Dear",
"wrote"); within a text, every other mention of such a name is one too. Scripts without a list of names
get names made up of letters of the script; where nothing tells the gender, it is a kind of its own.

Distinct entities must stay distinct. Surrogates of all entities are compared with each other and
with all real entities of the corpus; where two meet, one takes its next candidate. What still meets
after some rounds, as where a format is nearly full, is settled exactly: the free values of the format
are listed and dealt out one by one. Entities that find no free value go on to the next wider format:
one more digit (phones, numbers, cards), one more letter before the ``@``, one more given name or
syllable; addresses go from ``192.168.`` and ``172.x.`` to ``10.``, to public ones, to one more part.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache, reduce
from operator import mul

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import permute, text_of
from strata.session import stage

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
ADDRESS = re.compile(rf"(?<![\w.]){OCTET}(?:\.{OCTET}){{3}}(?!\.?\w)", re.ASCII)
PHONE = re.compile(
    r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){1,4}(?!\w)|\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\w)"
    r"|(?<![\w.,+-])(?:\d{3}([-.])\d{3}\1\d{4}|0\d(?:[ .]\d\d){4}|0\d{2,4}[ /-]\d{3,4}[ -]?\d{3,4})(?![\w-]|[.,]\d)",
    re.ASCII,
)
LEAD = re.compile(r"\+1|\+\d\d|0|")
NUMBER = re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])", re.ASCII)
CARD = re.compile(r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-])", re.ASCII)
#: Titles by gender; ``n``: it is not told (fixed values).
TITLES = {
    "m": ("Mr", "Mister", "Sir", "Herr", "Monsieur", "Señor", "Sr", "господин", "κύριος", "Κύριος"),
    "f": ("Mrs", "Ms", "Miss", "Lady", "Frau", "Madame", "Mme", "Señora", "Sra", "госпожа", "κυρία", "Κυρία"),
    "n": ("Dr", "Doctor", "Doktor", "Prof", "Professor", "Rev", "доктор"),
}
#: Given names by script and gender, both looked for and given as surrogates (fixed values).
GIVEN = {
    ("latin", "m"): "Adam Albert Anton Bernard Carlos Charles Daniel David Diego Edward Emil Felix Frank George Hans Henry Hugo Jakob James Jean John Jonas José Juan Karl Louis Lucas Luis Martin Michael Miguel Oscar Paul Peter Pierre Richard Robert Samuel Stefan Thomas Walter William".split(),
    ("latin", "f"): "Adele Alice Amelia Anna Beatrice Camille Carla Carmen Caroline Catherine Clara Claire Diana Elena Elisabeth Emma Eva Frieda Greta Hannah Helen Ines Isabel Jane Johanna Julia Karin Laura Lucia Margaret Maria Marie Martha Nora Olivia Paula Rosa Sarah Sofia Susanne Teresa Victoria".split(),
    ("cyrillic", "m"): "Алексей Андрей Борис Виктор Дмитрий Иван Михаил Николай Павел Сергей".split(),
    ("cyrillic", "f"): "Анна Вера Елена Ирина Мария Наталья Ольга Светлана София Татьяна".split(),
    ("greek", "m"): "Αντώνης Γιώργος Δημήτρης Κώστας Νίκος Πέτρος Σπύρος Χρήστος".split(),
    ("greek", "f"): "Αγγελική Βασιλική Δέσποινα Ειρήνη Ελένη Κατερίνα Σοφία Χριστίνα".split(),
}
#: Given names of either gender: given only, as they are words or surnames too (fixed values).
NEUTRAL = {"latin": "Alexis Ariel Blake Casey Dana Drew Ellis Finley Jamie Jordan Kendall Kim Morgan Quinn Reese Robin Rowan Taylor".split(), "cyrillic": "Валя Женя Саша Слава Шура".split()}
#: Words around a name that has neither title nor listed given name, and words that are none there (fixed values).
BEFORE = "[Mm]y name is|[Nn]ame:|[Dd]ear|[Rr]egards,|[Ss]incerely,|[Ss]igned:|[Ss]igned by"
AFTER = "wrote|writes|said|says|called|asked|replied|told|lives in|works at|works for"
OTHER_WORDS = frozenset("A All An And As At Both But Colleague Colleagues Customer Each Everyone Friend Friends He Her His However I If In It Its Madam Member My No On One Or Our She Sir Some Team That The Their Then These They This Those User We What When Who You Your".split())
#: Syllables of surnames that are made up, of equal length in each script (fixed values).
SYLLABLES = {
    "latin": "bal cor den far gol han kel lin mar nor pel ros sol tan var wen".split(),
    "cyrillic": "бал вор ден гор кел лин мар нов пел рос сол тан".split(),
    "greek": "βαλ γορ δεν καλ λιν μαρ νικ πελ ροδ σαλ ταν φιλ".split(),
    "cjk": list("安白成方高何江林明宁青石文辛远周"),
}
GENDER = {name: (script, gender) for (script, gender), names in GIVEN.items() for name in names}
GENDER |= {name.upper(): kind for name, kind in GENDER.items()}
TITLE_GENDER = {form: gender for gender, titles in TITLES.items() for t in titles for form in (t, t.upper())}
WORD = r"[^\W\d_][^\W\d_'’-]*(?:-[^\W\d_]+)*"
TITLED = re.compile(rf"\b({'|'.join(TITLE_GENDER)})\.? ({WORD})(?: ({WORD}))?")
NAMED = re.compile(rf"(?<![\w-])({'|'.join(map(re.escape, GENDER))}) ({WORD})")
CUED = re.compile(rf"(?<!\w)(?:{BEFORE})\s+({WORD})(?: ({WORD}))?")
CUE = re.compile(rf" (?:{AFTER})(?!\w)")
TWO_WORDS = re.compile(rf"(?<![\w'’-])({WORD}) ({WORD})\Z")
MENTION = re.compile(rf"(?<![\w-]){WORD}")
TITLE_WORDS = frozenset(TITLE_GENDER)
#: Runs of letters from a first letter of a title or given name on. Both patterns need one as a whole
#: run, whatever stands around it, so texts without any are passed over.
LEADS = re.compile(rf"[{''.join(sorted({w[0] for w in (*TITLE_WORDS, *GENDER)}))}][^\W\d_]*")
ENTITIES = "digest long, found array<struct<start: int, end: int, kind: string, value: string>>"


@lru_cache(maxsize=None)
def letters(script: str) -> tuple[str, ...]:
    """Up to 32 letters of a script, spread over all that it has; capitals are not among them."""
    every = [c for c in map(chr, range(0x250, 0x20000)) if unicodedata.name(c, "").startswith(f"{script.upper()} ") and c.isalpha() and unicodedata.normalize("NFKC", c.casefold()) == c]
    return tuple(every[:: max(1, len(every) // 32)][:32])


@lru_cache(maxsize=4096)
def script_of_letter(letter: str) -> str:
    script = unicodedata.name(letter, "LATIN").split()[0].split("-")[0].lower()
    return script if script in SYLLABLES or len(letters(script)) >= 16 else "latin"


def script_of(word: str) -> str:
    return "latin" if word[0] < "\u0250" else script_of_letter(word[0])


def syllables(script: str) -> list[str]:
    return SYLLABLES.get(script) or list(letters(script))


def given_names(script: str, gender: str) -> list[str]:
    """The given names that surrogates of a kind are taken from; kinds of one script share none."""
    listed = GIVEN.get((script, gender)) or (NEUTRAL.get(script) if gender == "n" else None)
    if listed:
        return listed
    parts = syllables(script)
    return [a + b for a in parts["mfn".index(gender) :: 3] for b in parts[::2]]


def capital(word: str) -> bool:
    """Whether a word may be a name: it begins with a capital, or its script has none."""
    return not word[0].islower() and (word[0].isupper() or script_of(word) != "latin")


def given(word: str, gender: str) -> str:
    script, gender = GENDER.get(word) or GENDER.get(word.title()) or (script_of(word), gender)
    return f"given {script} {gender}"


def surname(word: str) -> str:
    return f"surname {script_of(word)}"


def parts_of_name(m: re.Match, first: int, gender: str, alone: str, offset: int = 0) -> Iterator[tuple[int, int, str, str]]:
    """Groups ``first`` and the next of a match as given name and surname; one word alone is of kind ``alone``."""
    if not capital(m[first]):
        return
    if m[first + 1] and capital(m[first + 1]):
        yield offset + m.start(first), offset + m.end(first), given(m[first], gender), m[first].casefold()
        first, alone = first + 1, "surname"
    kind = surname(m[first]) if alone == "surname" else given(m[first], gender)
    yield offset + m.start(first), offset + m.end(first), kind, m[first].casefold()


def marked_names(text: str) -> Iterator[tuple[int, int, str, str]]:
    """Parts of names after titles, known given names and words that go with names; only capitalised words count."""
    words = set(LEADS.findall(text))
    if not TITLE_WORDS.isdisjoint(words):
        for m in TITLED.finditer(text):
            yield from parts_of_name(m, 2, TITLE_GENDER[m[1]], "surname")
    if not words.isdisjoint(GENDER):
        for m in NAMED.finditer(text):
            # In capitals throughout, short words are seldom names.
            if capital(m[2]) and len(m[2]) > 1 and (not m[1].isupper() or (m[2].isupper() and len(m[2]) > 2)):
                yield m.start(1), m.end(1), given(m[1], "n"), m[1].casefold()
                yield m.start(2), m.end(2), surname(m[2]), m[2].casefold()
    for m in CUED.finditer(text):
        if m[1] not in OTHER_WORDS and m[1] not in TITLE_WORDS and len(m[1]) > 1:
            yield from parts_of_name(m, 1, "n", "given")
    for cue in CUE.finditer(text):
        start = max(0, cue.start() - 100)
        m = TWO_WORDS.search(text, start, cue.start())
        if m and m[1][0].isupper() and m[2][0].isupper() and OTHER_WORDS.isdisjoint((m[1], m[2])) and m[1] not in TITLE_WORDS:
            yield from parts_of_name(m, 1, "n", "given")


def names(text: str) -> list[tuple[int, int, str, str]]:
    """Marked names, and every other capitalised mention of one of their parts within the text."""
    found = list(marked_names(text))
    kinds: dict[str, str] = {}
    for *_, kind, value in found:
        if len(value) > 2 or script_of(value) != "latin":
            kinds.setdefault(value, kind)
    if kinds:
        for m in MENTION.finditer(text):
            kind = kinds.get(m[0].casefold())
            if kind and capital(m[0]):
                found.append((m.start(), m.end(), kind, m[0].casefold()))
    return found


def detect(text: str) -> list[tuple[int, int, str, str]]:
    """Entities from left to right, without overlaps: start, end, kind, value. Formats of a value are not part of it."""
    found = names(text)
    if "@" in text:
        found += [(m.start(), m.end(), "email", m[0].lower()) for m in EMAIL.finditer(text)]
    if re.search(r"[0-9]", text):
        found += [(m.start(), m.end(), "address", m[0]) for m in ADDRESS.finditer(text)]
        found += [(m.start(), m.end(), "phone", re.sub(r"[^0-9+]", "", m[0])) for m in PHONE.finditer(text)]
        found += [(m.start(), m.end(), "number", m[0]) for m in NUMBER.finditer(text)]
        found += [(m.start(), m.end(), "card", re.sub(r"[^0-9]", "", m[0])) for m in CARD.finditer(text)]
    kept, end = [], 0
    for x in sorted(dict.fromkeys(found), key=lambda x: (x[0], -x[1])):  # of equal spans, the first found
        if x[0] >= end:
            kept.append(x)
            end = x[1]
    return kept


def stream(key: bytes, *parts: str) -> Iterator[int]:
    """Endless pseudorandom bytes that depend on the key and the parts."""
    block = 0
    while True:
        yield from hashlib.blake2b("\x1f".join((*parts, str(block))).encode(), key=key).digest()
        block += 1


def digits_like(value: str, bytes_: Iterator[int]) -> str:
    return "".join(str(next(bytes_) * 251 % 10) if c.isdigit() else c for c in value)


def letters_like(value: str, bytes_: Iterator[int]) -> str:
    """Letters for letters, digits for digits, everything else as it is."""
    return "".join(chr(97 + next(bytes_) % 26) if c.isalpha() else str(next(bytes_) % 10) if c.isdigit() else c for c in value)


def check_digit(digits: str) -> str:
    """The last digit that makes ``digits`` and it pass the usual card check."""
    total = sum(d if i % 2 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(int(c) for c in reversed(digits)))
    return str(-total % 10)


def surrogate(key: bytes, kind: str, value: str, attempt: int) -> str:
    """The candidate number ``attempt`` for an entity."""
    rand = stream(key, kind, value, str(attempt))
    if kind == "email":
        local, domain = value.split("@", 1)
        name, top = domain.rsplit(".", 1)
        return f"{letters_like(local, rand)}@{letters_like(name, stream(key, 'domain', domain))}.{top}"
    if kind == "address":
        lead = re.match(r"10\.|192\.168\.|172\.(?:1[6-9]|2\d|3[01])\.|", value)[0]
        rest = 4 - lead.count(".")
        made = [str(1 + next(rand) % 254) for _ in range(rest)]
        if not lead:
            made[0] = str(11 + next(rand) % 112)
        return lead + ".".join(made)
    if kind == "phone":
        lead = LEAD.match(value)[0]
        return lead + str(2 + next(rand) % 8) + digits_like(value[len(lead) + 1 :], rand)
    if kind == "card":
        body = value[0] + digits_like(value[1:-1], rand)
        return body + (check_digit(body) if value[-1] == check_digit(value[:-1]) else str(next(rand) % 10))
    if kind == "number":
        return digits_like(value, rand)
    _, script, *gender = kind.split()
    if gender:
        pool = given_names(script, gender[0])
        # Where the names of the pool don't suffice, double names do.
        return "-".join(pool[(next(rand) * 256 + next(rand)) % len(pool)] for _ in range(1 + min(attempt, 3))).casefold()
    pool = syllables(script)
    return "".join(pool[next(rand) % len(pool)] for _ in range(3 + attempt % 3))


PRIVATE = re.compile(r"10\.|192\.168\.|172\.(?:1[6-9]|2\d|3[01])\.|")
MOST = 2**62  # values of a format that are told apart; more than any corpus needs


def form(kind: str, value: str) -> str:
    """The format of a surrogate: ``*`` for what is drawn, or for emails ``a`` and ``0``. Values of two formats differ."""
    if kind == "email":
        local, domain = value.split("@", 1)
        return "".join("a" if c.isalpha() else "0" if c.isdigit() else c for c in local) + "@" + domain
    if kind == "address":
        lead = PRIVATE.match(value)[0]
        return lead + ".".join("*" * (value.count(".") + 1 - lead.count(".")))
    if kind == "phone":
        lead = LEAD.match(value)[0]
        return lead + "*" * (len(value) - len(lead))
    if kind == "card":
        return value[0] + "*" * (len(value) - 1) + ("!" if value[-1] == check_digit(value[:-1]) else "")
    if kind == "number":
        return re.sub(r"\d", "*", value)
    return "-".join("*" * (value.count("-") + 1)) if kind.startswith("given") else "*" * (len(value) // len(syllables(kind.split()[1])[0]))


def first_form(key: bytes, kind: str, value: str) -> str:
    """The format in which an entity looks for a surrogate first."""
    if kind == "email":
        return form(kind, surrogate(key, kind, value, 0))
    return "*" if kind.startswith("given") else "***" if kind.startswith("surname") else form(kind, value)


def wider(kind: str, shape: str) -> str:
    """The format to go on with where all values of ``shape`` are taken."""
    if kind == "email":
        return "a" + shape
    if kind == "address":
        return "10.*.*.*" if re.match("192|172", shape) else "*.*.*.*" if shape == "10.*.*.*" else shape + ".*"
    if kind == "card":
        return shape[:-1] + "*!" if shape[-1] == "!" else shape + "*"
    return shape + ("-*" if kind.startswith("given") else "*")


def choices(kind: str, shape: str) -> list[list[str]]:
    """What may stand at each place of a format, from left to right; a card's last digit is not among them."""
    digits = list("0123456789")
    if kind == "email":
        local, domain = shape.split("@", 1)
        letters = [chr(97 + i) for i in range(26)]
        return [*[letters if c == "a" else digits if c == "0" else [c] for c in local], ["@" + domain]]
    if kind == "address":
        lead = PRIVATE.match(shape)[0]
        rest = [[f".{i}" for i in range(1, 255)]] * (shape.count("*") - 1)
        return [[f"{lead}{i}" for i in (range(1, 255) if lead else range(11, 123))], *rest]
    if kind == "phone":
        return [[shape.rstrip("*")], list("23456789"), *[digits] * (shape.count("*") - 1)]
    if kind == "card":
        # Without a right check digit, the last digit is one of the nine that are wrong.
        return [[shape[0]], *[digits] * (shape.count("*") - 1), [""] if shape[-1] == "!" else list("123456789")]
    if kind == "number":
        return [digits if c == "*" else [c] for c in shape]
    _, script, *gender = kind.split()
    if gender:
        pool = [name.casefold() for name in given_names(script, gender[0])]
        return [pool, *[[f"-{name}" for name in pool]] * shape.count("-")]
    return [syllables(script)] * len(shape)


def size_of(kind: str, shape: str) -> int:
    return min(reduce(mul, map(len, choices(kind, shape)), 1), MOST)


def value_at(kind: str, shape: str, index: int) -> str:
    """The value number ``index`` of a format, each another one."""
    parts = []
    for options in reversed(choices(kind, shape)):
        index, at = divmod(index, len(options))
        parts.append(options[at])
    made = "".join(reversed(parts))
    if kind == "card":
        body, off = (made, 0) if shape[-1] == "!" else (made[:-1], int(made[-1]))
        return body + str((int(check_digit(body)) + off) % 10)
    return made


def in_format(mention: str, made: str, kind: str) -> str:
    """The surrogate in the format of the mention: its separators, or its capitals. Digits beyond the mention's come last."""
    if kind in ("phone", "card"):
        digits = iter(re.sub(r"[^0-9]", "", made))
        return "".join(next(digits, "") if c.isdigit() else c for c in mention) + "".join(digits)
    if kind.startswith(("given", "surname")):
        if mention.isupper() and len(mention) > 1:
            return made.upper()
        return "-".join(p[:1].upper() + p[1:] for p in made.split("-"))
    return made.upper() if mention.isupper() and kind == "email" else made


def find_entities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shape = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("value", pa.string())]))
    for batch in batches:
        found = [detect(t.as_py()) for t in batch.column("text")]
        at = pa.array([i for i, x in enumerate(found) if x], pa.int64())
        lists = pa.array([[dict(zip(("start", "end", "kind", "value"), e, strict=True)) for e in x] for x in found if x], shape)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(at), batch.column("digest").take(at), lists], ["doc_id", "digest", "found"])


def choose_surrogates(entities: DataFrame, key: bytes, most: int = 32) -> DataFrame:
    """kind, value, made for distinct ``entities`` (kind, value): no two share one and none is a real entity."""

    @F.pandas_udf("string")
    def made(kind: pd.Series, value: pd.Series, attempt: pd.Series) -> pd.Series:
        return pd.Series([surrogate(key, *x) for x in zip(kind, value, attempt, strict=True)])

    entities = stage(entities.distinct(), "surrogate-entities")
    real = entities.select(F.col("kind").alias("k"), F.col("value").alias("v"))
    now = entities.withColumn("attempt", F.lit(0))
    before = 0
    for attempt in range(most):
        now = stage(now.select("kind", "value", "attempt", made("kind", "value", "attempt").alias("made")), "surrogate-candidates")
        first = now.groupBy("kind", "made").agg(F.min("value").alias("holder"))
        judged = now.join(first, ["kind", "made"]).join(real, (F.col("kind") == F.col("k")) & (F.col("made") == F.col("v")), "left")
        judged = stage(judged.select("kind", "value", "attempt", "made", ((F.col("value") != F.col("holder")) | F.col("v").isNotNull()).alias("clash")), "surrogate-judged")
        clashes = judged.filter("clash").count()
        if not clashes:
            return judged.select("kind", "value", "made")
        # Names have had all their lengths by then; rounds that don't halve the clashes meet full formats.
        if attempt > 4 and 2 * clashes > before:
            break
        before = clashes
        now = judged.select("kind", "value", (F.col("attempt") + F.col("clash").cast("int")).alias("attempt"))
    return settle(judged.filter("not clash").select("kind", "value", "made"), judged.filter("clash").select("kind", "value"), real, key)


def numbered(rows: DataFrame, order: str, chunks: int = 64) -> DataFrame:
    """Adds _nth, the rows of each kind and form from 0 on, without ranking a whole form in one task."""
    rows = rows.withColumn("_chunk", F.pmod(F.xxhash64(order), F.lit(chunks)))
    counts = rows.groupBy("kind", "form", "_chunk").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("kind", "form").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("kind", "form", "_chunk", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    nth = F.row_number().over(Window.partitionBy("kind", "form", "_chunk").orderBy(order)) - 1
    return rows.withColumn("_nth", nth).join(starts, ["kind", "form", "_chunk"]).withColumn("_nth", F.col("_nth") + F.col("_start")).drop("_chunk", "_start")


def settle(done: DataFrame, still: DataFrame, real: DataFrame, key: bytes) -> DataFrame:
    """``done`` (kind, value, made) and the entities of ``still`` (kind, value) with free values of their formats.

    As many values of a format are listed as it has entities and taken values, so there are enough free
    ones unless the format itself has fewer; the rest goes on to the next wider format, which has at
    least as many values and in the end more than are needed.
    """

    @F.pandas_udf("string")
    def form_of(kind: pd.Series, value: pd.Series) -> pd.Series:
        return pd.Series([form(*x) for x in zip(kind, value, strict=True)])

    @F.pandas_udf("form string, keyed string")
    def start(kind: pd.Series, value: pd.Series) -> pd.DataFrame:
        pairs = list(zip(kind, value, strict=True))
        keyed = [hashlib.blake2b("\x1f".join(("order", *x)).encode(), key=key, digest_size=16).hexdigest() for x in pairs]
        return pd.DataFrame({"form": [first_form(key, *x) for x in pairs], "keyed": keyed})

    @F.pandas_udf("string")
    def widened(kind: pd.Series, shape: pd.Series) -> pd.Series:
        return pd.Series([wider(*x) for x in zip(kind, shape, strict=True)])

    @F.pandas_udf("long")
    def size(kind: pd.Series, shape: pd.Series) -> pd.Series:
        return pd.Series([size_of(*x) for x in zip(kind, shape, strict=True)], dtype="int64")

    @F.pandas_udf("string")
    def value(kind: pd.Series, shape: pd.Series, index: pd.Series) -> pd.Series:
        return pd.Series([value_at(*x) for x in zip(kind, shape, index, strict=True)])

    seed = int.from_bytes(hashlib.blake2b(b"free values", key=key, digest_size=4).digest(), "big") >> 1
    still = stage(still.select("kind", "value", start("kind", "value").alias("s")).select("kind", "value", "s.*"), "surrogate-still")
    taken = real.select(F.col("k").alias("kind"), F.col("v").alias("made")).union(done.select("kind", "made")).distinct()
    taken = stage(taken.select("kind", "made", form_of("kind", "made").alias("form")), "surrogate-taken")
    while not still.isEmpty():
        forms = still.groupBy("kind", "form").agg(F.count("*").alias("r"))
        used = taken.groupBy("kind", "form").agg(F.count("*").alias("t"))
        forms = forms.join(used, ["kind", "form"], "left").select("kind", "form", "r", F.coalesce("t", F.lit(0)).alias("t"), size("kind", "form").alias("size"))
        forms = stage(forms.withColumn("most", F.least("size", F.col("r") + F.col("t"))), "surrogate-forms")
        step = 65_536
        blocks = forms.select("kind", "form", "size", "most", F.explode(F.sequence(F.lit(0).cast("long"), F.col("most") - 1, F.lit(step).cast("long"))).alias("from"))
        blocks = blocks.repartition("kind", "form", "from")
        listed = blocks.select("kind", "form", "size", F.explode(F.sequence("from", F.least(F.col("from") + step, F.col("most")) - 1)).alias("i"))
        index = permute(F.col("i"), F.col("size"), seed, F.col("kind"), F.col("form"))
        listed = listed.select("kind", "form", "i", value("kind", "form", index).alias("made"))
        free = numbered(stage(listed.join(taken, ["kind", "form", "made"], "left_anti"), "surrogate-free"), "i")
        dealt = numbered(still, "keyed").join(free.select("kind", "form", "_nth", "made"), ["kind", "form", "_nth"], "left")
        dealt = stage(dealt.select("kind", "value", "form", "keyed", "made"), "surrogate-dealt")
        found = dealt.filter("made is not null")
        done = done.union(found.select("kind", "value", "made"))
        taken = taken.union(found.select("kind", "made", "form"))
        still = dealt.filter("made is null").select("kind", "value", widened("kind", "form").alias("form"), "keyed")
        still = stage(still, "surrogate-still")
    return done


def replace_entities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, counts = [], []
        for text, swaps in zip(batch.column("text"), batch.column("swaps"), strict=True):
            text, swaps = text.as_py(), sorted(swaps.as_py() or [], key=lambda x: x["start"])
            parts, end = [], 0
            for x in swaps:
                mention = text[x["start"] : x["end"]]
                parts += [text[end : x["start"]], in_format(mention, x["made"], x["kind"])]
                end = x["end"]
            texts.append("".join([*parts, text[end:]]))
            counts.append(len(swaps))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(texts, pa.string())], ["doc_id", "n_entities", "text"])


def replace_personal_data(docs: DataFrame, key: bytes) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_entities and the text with surrogates.

    Null and empty texts have no entities and come out empty; repeated rows get equal texts; texts without entities stay as
    they are; texts are read whole; ids keep their type; a table without rows gives none; other columns are ignored. The same key gives the same surrogates for the same corpus.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    keyed = docs.select("doc_id", F.xxhash64(text_of()).alias("digest"), text_of().alias("text"))
    found = stage(keyed.mapInArrow(find_entities, f"doc_id {id_type}, {ENTITIES}").dropDuplicates(["doc_id", "digest"]), "surrogate-found")
    each = found.select("doc_id", "digest", F.explode("found").alias("e")).select("doc_id", "digest", "e.*")
    chosen = choose_surrogates(each.select("kind", "value"), key)
    swaps = each.join(chosen, ["kind", "value"]).groupBy("doc_id", "digest").agg(F.collect_list(F.struct("start", "end", "kind", "made")).alias("swaps"))
    swaps = swaps.withColumnsRenamed({"doc_id": "d", "digest": "g"})
    joined = keyed.join(swaps, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("digest") == F.col("g")), "left")
    return joined.select("doc_id", "text", "swaps").mapInArrow(replace_entities, f"doc_id {id_type}, n_entities long, text string")


def op2(spark, sf_dir: str) -> DataFrame:
    """The query: all documents with surrogates under a fixed key."""
    return replace_personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), b"a key for tests; real ones are secret")
