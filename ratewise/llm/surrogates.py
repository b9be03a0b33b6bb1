"""Personal data replaced by keyed surrogates of the same kind.

Entities (e-mail addresses, phone and card numbers, IPv4 addresses, account
numbers, secret tokens, people) are reduced to a canonical form, so that every
mention of one entity gets one surrogate. A surrogate is a keyed digest of type,
canonical form and attempt, shaped like what it replaces: digits for digits,
letters of the same script, case and vowel class, the same separators and check
digit, a given name of the same gender.

People are found after a form of address; then each further mention of the names
found in a text, whole or in part, is replaced as well, with or without one. A
surname has one surrogate, whatever the title and the given name. Given names
follow the whole name: a shorter form is read as the longest name of the text
that has its words, and a title without gender as that of the same name under
another title in the text, else in the corpus. A person who has no form of
address anywhere in a text is not detected in it.

Surrogates are checked over the whole corpus: if two entities of a type get the
same one, or one that is a real entity, all but the first try their next
attempt, until none clash. Only entities with an attempt above 0 or a gender
from elsewhere need a table; all other surrogates are computed where needed.

Defined results: a null text stays null and an empty one empty; texts without
entities are returned as they are; rows that repeat get equal surrogates; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import count

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm import kernels as K
from ratewise.session import checkpointed

#: Entities with an attempt or type of their own that may be broadcast; more are joined by document.
BROADCAST_ENTITIES = 500_000
#: From this attempt on a surrogate may be longer than what it replaces.
_LONGER_FROM = 6

# Forms of address by gender, and given names by gender and script.
TITLES = {
    "f": "Mrs Ms Miss Frau Señora Sra Madame Mme Mlle Госпожа Κυρία".split(),
    "m": "Mr Herr Señor Sr Monsieur Господин Κύριος".split(),
    "n": "Dr Prof".split(),
}
GIVEN = {
    ("f", "latin"): "Alma Berta Clara Dora Edith Flora Greta Helen Irene Julia Karin Laura Maria Nora Olga Paula".split(),
    ("m", "latin"): "Adam Bruno Carl David Erik Felix Georg Hugo Ivan Jonas Karl Leon Martin Niels Oscar Peter".split(),
    ("n", "latin"): "Alex Andrea Chris Dana Jamie Jordan Kim Luca Morgan Noa Robin Sam Sascha Taylor Toni Yael".split(),
    ("f", "cyrillic"): "Анна Вера Дарья Елена Зоя Ирина Лидия Мария".split(),
    ("m", "cyrillic"): "Антон Борис Виктор Денис Егор Иван Лев Павел".split(),
    ("n", "cyrillic"): "Женя Саша Слава Валя".split(),
    ("f", "greek"): "Άννα Ελένη Ζωή Μαρία".split(),
    ("m", "greek"): "Γιώργος Κώστας Νίκος Πέτρος".split(),
    ("n", "greek"): "Άρης Φώτης Αλέξης Χάρις".split(),
}
_LETTERS = {"latin": ("aeiou", "bcdfghklmnprstvz"), "cyrillic": ("аеиоу", "бвгдзклмнпрст"), "greek": ("αειου", "βγδζθκλμνπρστ")}
_VOWELS = set("aeiouyäöüàáâèéêìíîòóôùúûаеёиоуыэюяαεηιουωάέήίόύώ")

_EMAIL = re.compile(r"(?<![\w.+-])[\w.+-]+@[\w-]+(?:\.[\w-]+)*\.[^\W\d_]{2,}")
_SECRET = re.compile(r"(?<!\w)[0-9a-fA-F]{32,128}(?!\w)")
_IP = re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\w|\.\d)")
_IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?!\w)")
_CARD = re.compile(r"(?<![\w.+-])\d(?:[ -]?\d){12,18}(?![\w-])")
_PHONE = re.compile(r"(?<![\w.])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\w)")
_PERSON = re.compile(
    r"(?<!\w)(" + "|".join(t for ts in TITLES.values() for t in ts) + r")\.? ((?:[^\W\d_a-zа-яα-ω][^\W\d_]+)(?:[ -][^\W\d_a-zа-яα-ω][^\W\d_]+){0,2})"
)
_NAME = re.compile(r"(?<!\w)[^\W\d_a-zа-яα-ω][^\W\d_]+(?:-[^\W\d_a-zа-яα-ω][^\W\d_]+)*")
_DIGIT = re.compile(r"\d")
_GENDER = {t: g for g, ts in TITLES.items() for t in ts}


def _luhn(digits: str) -> int:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10


def entities(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, type, canonical) of the entities of a text, in order and without overlap."""
    found: list[tuple[int, int, str, str]] = []
    taken: list[tuple[int, int]] = []

    def add(start, end, kind, canonical):
        if not any(start < b and a < end for a, b in taken):
            taken.append((start, end))
            found.append((start, end, kind, canonical))

    if "@" in text:
        for m in _EMAIL.finditer(text):
            add(*m.span(), "email", m.group().casefold())
    if _DIGIT.search(text):
        for m in _SECRET.finditer(text):
            if not m.group().isalpha() and not (m.group().isdigit()):
                add(*m.span(), "secret", m.group().lower())
        for m in _IP.finditer(text):
            add(*m.span(), "ip", m.group())
        for m in _IBAN.finditer(text):
            add(*m.span(), "account", m.group().replace(" ", ""))
        for m in _CARD.finditer(text):
            add(*m.span(), "card", re.sub(r"\D", "", m.group()))
        for m in _PHONE.finditer(text):
            if 9 <= len(digits := re.sub(r"\D", "", m.group())) <= 15:
                add(*m.span(), "phone", digits)
    titled = [(m.span(2), _GENDER[m.group(1)], _units(m.group(2))) for m in _PERSON.finditer(text)]
    if titled:
        people = _people([(gender, units) for _, gender, units in titled])
        for (span, _, _), (kind, canonical) in zip(titled, people):
            add(*span, kind, canonical)
        for start, end, kind, canonical in _repeats(text, people, taken):
            add(start, end, kind, canonical)
    return sorted(found)


def _units(name: str) -> tuple[str, ...]:
    """Given names and surname; a double surname is one word, a double given name is two."""
    *given, last = name.casefold().split(" ")
    return (*(part for word in given for part in word.split("-")), last)


def _within(short: tuple[str, ...], name: tuple[str, ...]) -> bool:
    words = iter(name)
    return all(word in words for word in short)


def _people(mentions: list[tuple[str, tuple[str, ...]]]) -> list[tuple[str, str]]:
    """(type, canonical) of mentions (gender, words) of one text: short forms get the whole name, but for surnames."""
    genders: dict[tuple[str, ...], set[str]] = {}
    for gender, units in mentions:
        genders.setdefault(units, set()).add(gender)
    whole = sorted((u for u in genders if len(u) > 1), key=len, reverse=True)

    def name_of(gender, units):
        if len(units) == 1 and any(units[0] == w[-1] for w in whole):
            return units
        for name in whole:
            fits = gender == "n" or gender in genders[name] or genders[name] == {"n"}
            if fits and len(name) > len(units) and _within(units, name) and (len(units) == 1 or units[-1] == name[-1]):
                return name
        return units

    names = [name_of(*mention) for mention in mentions]
    told: dict[tuple[str, ...], set[str]] = {}
    for (gender, _), name in zip(mentions, names):
        told.setdefault(name, set()).update({gender} - {"n"})
    made = []
    for (gender, _), name in zip(mentions, names):
        if gender == "n" and len(name) > 1 and len(told[name]) == 1:
            (gender,) = told[name]
        made.append((f"person_{gender}", " ".join(name)))
    return made


def _repeats(text: str, people: list[tuple[str, str]], taken: list[tuple[int, int]]) -> Iterator[tuple[int, int, str, str]]:
    """Mentions of the people of a text outside ``taken``, by their whole names or by single words of them."""
    surnames: dict[str, tuple[str, str]] = {}
    given: dict[str, tuple[str, str]] = {}
    whole: list[tuple[tuple[str, ...], tuple[str, str]]] = []
    for kind, canonical in dict.fromkeys(people):
        *first, last = units = tuple(canonical.split(" "))
        surnames.setdefault(last, (kind, last))
        for word in first:
            given.setdefault(word, (kind, canonical))
        if first:
            whole.append((units, (kind, canonical)))
    whole.sort(key=lambda w: -len(w[0]))
    known = given | surnames
    before, words = sorted(taken), []
    for m in _NAME.finditer(text):
        while before and before[0][1] <= m.start():
            before.pop(0)
        if before and before[0][0] < m.end():
            continue
        word = m.group().casefold()
        if word in known or "-" in word and any(part in known for part in word.split("-")):
            words.append(m.span())
    i = 0
    while i < len(words):
        run = 1
        while run < 3 and i + run < len(words) and text[words[i + run - 1][1] : words[i + run][0]] == " ":
            run += 1
        for n in range(run, 1, -1):
            units = _units(text[words[i][0] : words[i + n - 1][1]])
            person = next((p for name, p in whole if units[-1] == name[-1] and _within(units, name)), None)
            if person:
                yield words[i][0], words[i + n - 1][1], *person
                i += n
                break
        else:
            start, end = words[i]
            word = text[start:end].casefold()
            if word in known:
                yield start, end, *known[word]
            else:
                for m in re.finditer("[^-]+", text[start:end]):
                    if (part := m.group().casefold()) in known:
                        yield start + m.start(), start + m.end(), *known[part]
            i += 1


def tried(kind: str, canonical: str) -> list[tuple[str, str]]:
    """The entities whose attempts make the surrogate: a person's surname is one of its own."""
    if not kind.startswith("person"):
        return [(kind, canonical)]
    surname = ("surname", canonical.rpartition(" ")[2])
    return [surname, (kind, canonical)] if " " in canonical else [surname]


def _script(text: str) -> str:
    for c in text:
        if "Ѐ" <= c <= "ӿ":
            return "cyrillic"
        if "Ͱ" <= c <= "Ͽ":
            return "greek"
    return "latin"


def _stream(key: bytes, kind: str, canonical: str, attempt: int) -> Iterator[int]:
    """Endless keyed bytes of one entity and attempt."""
    for block in count():
        yield from hashlib.blake2b(f"{kind}\0{canonical}\0{attempt}\0{block}".encode(), key=key).digest()


def _letters(word: str, stream: Iterator[int], script: str) -> str:
    vowels, others = _LETTERS[script]
    pick = lambda c: (vowels if c in _VOWELS else others)
    return "".join(pick(c)[next(stream) % len(pick(c))] if c.isalpha() else str(next(stream) % 10) if c.isdigit() else c for c in word)


def surrogate(key: bytes, kind: str, canonical: str, attempt: int) -> str:
    """Canonical form of the surrogate; that of a person's given names, before the surname as it is."""
    stream = _stream(key, kind, canonical, attempt)
    extra = max(0, attempt - _LONGER_FROM + 1)
    if kind == "email":
        local, _, domain = canonical.partition("@")
        host, _, top = domain.rpartition(".")
        return f"{_letters(local + 'a' * extra, stream, _script(local))}@{_letters(host, stream, _script(host))}.{top}"
    if kind == "secret":
        return "".join("0123456789abcdef"[next(stream) % 16] for _ in canonical)
    if kind == "ip":
        first, *rest = canonical.split(".")
        private = first in ("10", "127")
        return ".".join([first if private else str(11 + next(stream) % 112), *(str(1 + next(stream) % 254) for _ in rest)])
    if kind == "account":
        body = "".join(str(next(stream) % 10) if c.isdigit() else chr(65 + next(stream) % 26) for c in canonical[4:])
        value = int("".join(str(int(c, 36)) for c in body + canonical[:2] + "00"))
        return f"{canonical[:2]}{98 - value % 97:02d}{body}"
    if kind == "card":
        body = canonical[0] + "".join(str(next(stream) % 10) for _ in canonical[1:-1])
        valid = next(d for d in "0123456789" if _luhn(body + d) == 0)
        # A number that passes the check keeps passing it; one that does not, does not.
        return body + (valid if _luhn(canonical) == 0 else str((int(valid) + 1 + next(stream) % 9) % 10))
    if kind == "phone":
        keep = max(1, len(canonical) - 10)
        return canonical[:keep] + str(2 + next(stream) % 8) + "".join(str(next(stream) % 10) for _ in canonical[keep + 1 :])
    if kind == "surname":
        return _letters(canonical + canonical[-1] * extra, stream, _script(canonical))
    *names, last = canonical.split(" ")
    given = [g for g in map(str.casefold, GIVEN[kind[-1], _script(canonical)]) if g not in names]
    # Many people may share a surname: later attempts join two given names or more.
    return " ".join([*("".join(given[next(stream) % len(given)] for _ in range(1 + attempt // 4)) for _ in names), last])


Lookup = Callable[[str, str], tuple[str, int]]


def whole_surrogate(key: bytes, kind: str, canonical: str, attempt: Lookup) -> str:
    """Surrogate under the type and attempt that ``attempt`` gives for each entity in it."""
    made = {}
    for k, c in tried(kind, canonical):
        taken_as, n = attempt(k, c)
        made[k] = surrogate(key, taken_as, c, n)
    if not kind.startswith("person"):
        return made[kind]
    given = made[kind].rpartition(" ")[0] if kind in made else ""
    return f"{given} {made['surname']}".strip()


def shaped(original: str, kind: str, canonical: str, real: str) -> str:
    """The canonical surrogate of ``real`` in the spelling of one mention: its words, case and separators."""
    if kind in ("card", "phone", "account"):
        stream = iter(canonical)
        return "".join(next(stream) if c.isalnum() else c for c in original)
    if kind.startswith("person"):
        units = dict(zip(real.split(" "), canonical.split(" ")))

        def spelled(word):
            low = word.casefold()
            new = units[low] if low in units else "-".join(units[part] for part in low.split("-"))
            return new.upper() if word.isupper() else "-".join(part.capitalize() for part in new.split("-"))

        return " ".join(map(spelled, original.split(" ")))
    if original.isupper():
        return canonical.upper()
    if kind == "email" and original[:1].isupper():
        return canonical[0].upper() + canonical[1:]
    return canonical


def replaced(text: str, key: bytes, attempt: Lookup) -> tuple[str, int]:
    """Text with all entities replaced, and how many there were."""
    out, last = [], 0
    found = entities(text)
    for start, end, kind, canonical in found:
        made = whole_surrogate(key, kind, canonical, attempt)
        out += [text[last:start], shaped(text[start:end], kind, made, canonical)]
        last = end
    return "".join([*out, text[last:]]) if found else text, len(found)


def _mentions(docs: DataFrame, *keep: str) -> DataFrame:
    def run(batch):
        out = []
        for text in batch.column("text").to_pylist():
            pairs = {pair for _, _, kind, canonical in entities(text or "") for pair in tried(kind, canonical)}
            out.append([{"kind": k, "canonical": c} for k, c in sorted(pairs)])
        return {"found": out}

    return K.map_batches(docs.select(*keep, "text"), run, "found array<struct<kind: string, canonical: string>>", keep)


def _with_surrogate(pending: DataFrame, key: bytes, attempt: int) -> DataFrame:
    def run(batch):
        rows = zip(batch.column("kind").to_pylist(), batch.column("canonical").to_pylist())
        return {"made": [surrogate(key, k, c, attempt) for k, c in rows]}

    return K.map_batches(pending, run, "made string", ("kind", "canonical"), rows=4096)


def attempts(known: DataFrame, key: bytes, max_attempts: int = 40) -> DataFrame:
    """(kind, canonical, attempt, made) of all distinct entities, free of clashes.

    People are compared without regard to gender, as their names may be.
    """
    family = lambda kind: F.regexp_replace(kind, "_.*", "")
    real = known.select(family("kind").alias("_f"), F.col("canonical").alias("made")).distinct()
    settled, pending = None, known
    for attempt in range(max_attempts):
        made = checkpointed(_with_surrogate(pending, key, attempt).withColumn("_f", family("kind")))
        free = made.join(real, ["_f", "made"], "left_anti")
        if settled is not None:
            free = free.join(settled.select("_f", "made"), ["_f", "made"], "left_anti")
        first = free.groupBy("_f", "made").agg(F.min(F.struct("kind", "canonical")).alias("_first"))
        done = first.select("_first.kind", "_first.canonical", F.lit(attempt).alias("attempt"), "made", "_f")
        settled = checkpointed(done if settled is None else settled.unionByName(done))
        pending = checkpointed(made.join(settled, ["kind", "canonical"], "left_anti").select("kind", "canonical"))
        if pending.limit(1).count() == 0:
            return settled.drop("_f")
    raise RuntimeError("a type of entity has too few surrogates for its entities")


def _retried(known: DataFrame, key: bytes) -> DataFrame:
    """(kind, canonical, taken_as, attempt) of the entities that are not taken as they are at their first attempt."""
    kinds = known.where(F.col("kind").startswith("person_")).groupBy("canonical").agg(F.collect_set("kind").alias("kinds"))
    neutral = F.array(F.lit("person_n"))
    told = checkpointed(
        kinds.where((F.size("kinds") == 2) & F.array_contains("kinds", "person_n")).select(
            F.lit("person_n").alias("kind"), "canonical", F.array_except("kinds", neutral)[0].alias("taken_as")
        )
    )
    later = attempts(known.join(told, ["kind", "canonical"], "left_anti"), key).where(F.col("attempt") > 0)
    later = checkpointed(later.select("kind", "canonical", F.col("kind").alias("taken_as"), "attempt"))
    same = told.join(later.select("taken_as", "canonical", "attempt"), ["taken_as", "canonical"], "left").select(
        "kind", "canonical", "taken_as", F.coalesce("attempt", F.lit(0)).alias("attempt")
    )
    return later.unionByName(same)


def pseudonymised(docs: DataFrame, key: bytes, broadcast_entities: int = BROADCAST_ENTITIES) -> DataFrame:
    """(doc_id, n_entities, text) with every entity replaced."""
    docs = docs.select("doc_id", "text")
    known = checkpointed(_mentions(docs).select(F.inline("found")).distinct())
    retried = checkpointed(_retried(known, key))
    schema = "n_entities long, text string"

    def rows(batch, lookup):
        numbers, texts = [], []
        for i, text in enumerate(batch.column("text").to_pylist()):
            made, n = (None, 0) if text is None else replaced(text, key, lookup(i))
            numbers.append(n)
            texts.append(made)
        return {"n_entities": numbers, "text": texts}

    if retried.limit(broadcast_entities + 1).count() <= broadcast_entities:
        table = {(r.kind, r.canonical): (r.taken_as, r.attempt) for r in retried.toLocalIterator()}
        shared = docs.sparkSession.sparkContext.broadcast(table)
        one = lambda i: lambda kind, canonical: shared.value.get((kind, canonical), (kind, 0))
        return K.map_batches(docs, lambda batch: rows(batch, one), schema, ("doc_id",))

    # More than may be broadcast: each document gets the attempts of its own entities.
    keyed = docs.withColumn("_row", F.xxhash64("doc_id", "text"))
    own = (
        _mentions(keyed, "doc_id", "_row")
        .select("doc_id", "_row", F.inline("found"))
        .distinct()
        .join(retried, ["kind", "canonical"])
        .groupBy(F.col("doc_id").alias("_doc"), F.col("_row").alias("_key"))
        .agg(F.collect_list(F.struct("kind", "canonical", "taken_as", "attempt")).alias("_own"))
    )
    joined = keyed.join(own, keyed["doc_id"].eqNullSafe(own["_doc"]) & (keyed["_row"] == own["_key"]), "left")

    def from_row(batch):
        column: pa.Array = batch.column("_own")

        def lookup(i):
            mine = {(r["kind"], r["canonical"]): (r["taken_as"], r["attempt"]) for r in column[i].as_py() or []}
            return lambda kind, canonical: mine.get((kind, canonical), (kind, 0))

        return rows(batch, lookup)

    return K.map_batches(joined.select("doc_id", "text", "_own"), from_row, schema, ("doc_id",))
