"""Personal data: keyed surrogates of the same type, gender, script and format.

A value's letters and digits, in their order and kinds, are one number in the
range of all values of its format. A keyed permutation of that range, a single
cycle without fixed points, gives the surrogate: equal values get equal
surrogates everywhere (coreference), different values different ones
(distinctness), and no value is its own surrogate. No mapping table is kept, so
documents are independent. ``collisions`` checks both properties over a corpus.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import map_batches, text_or_empty

# Given names by gender and script.
GIVEN = {
    ("f", "latin"): ["Alice", "Anna", "Carmen", "Charlotte", "Claire", "Elena", "Emma", "Hannah", "Isabel", "Julia", "Laura",
                     "Linda", "Lucia", "Maria", "Marie", "Mary", "Olivia", "Patricia", "Sarah", "Sophie"],
    ("m", "latin"): ["Carlos", "Charles", "Daniel", "David", "Fernando", "Hans", "James", "Jean", "John", "Juan", "Lucas",
                     "Michael", "Paul", "Pierre", "Robert", "Stefan", "Thomas", "Walter", "William", "Wolfgang"],
    ("f", "cyrillic"): ["Анна", "Елена", "Ирина", "Мария", "Наталья", "Ольга", "Светлана", "Татьяна"],
    ("m", "cyrillic"): ["Александр", "Алексей", "Андрей", "Дмитрий", "Иван", "Михаил", "Николай", "Сергей"],
}
# Titles that announce a person, by gender.
TITLES = {
    "m": ["Mr", "Herr", "Monsieur", "Sr", "Señor", "Don"], "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Sra", "Señora", "Doña"],
    "": ["Dr", "Prof"],
}
GENDER_OF_TITLE = {t.lower(): gender for gender, titles in TITLES.items() for t in titles}
KIND_OF_NAME = {name.lower(): kind for kind, names in GIVEN.items() for name in names}

# Alphabets whose letters replace each other.
ALPHABETS = [
    "0123456789", "aeiou", "bcdfghjklmnpqrstvwxyz", "AEIOU", "BCDFGHJKLMNPQRSTVWXYZ",
    "аеиоуыэюя", "бвгджзклмнпрстфхцчшщ", "АЕИОУЫЭЮЯ", "БВГДЖЗКЛМНПРСТФХЦЧШЩ",
    "àáâäèéêëìíîïòóôöùúûü", "ÀÁÂÄÈÉÊËÌÍÎÏÒÓÔÖÙÚÛÜ", "αεηιουω", "βγδζθκλμνξπρστφχψ",
]
ALPHABET_OF = {c: alphabet for alphabet in ALPHABETS for c in alphabet}
HEX = ["0123456789abcdef", "0123456789ABCDEF"]

CAPITAL = r"[^\W\d_a-zß-öø-ÿа-яα-ω][^\W\d_A-ZА-Я]+(?:-[^\W\d_]+)?"
_TITLES = "|".join(sorted((t for titles in TITLES.values() for t in titles), key=len, reverse=True))
_GIVEN = "|".join(sorted((n for names in GIVEN.values() for n in names), key=len, reverse=True))
# An international prefix, an area code and groups of digits, up to so many after the first.
PHONE = r"(?:\+\d{{1,3}}[ .\-]?)?(?:\(\d{{2,4}}\)[ .\-]?)?\d{{2,4}}(?:[ .\-]\d{{2,4}}){{1,{}}}"
SHORTER_PHONES = [re.compile(PHONE.format(n) + r"(?![\w\-])") for n in (3, 2, 1)]
# In order of precedence at one place. Runs are possessive, so no text costs more than one pass.
PATTERNS = [
    ("secret", r"""(?i:\b(?:api[_-]?key|access[_-]?key|token|secret|password|passwd|pwd))["']?\s{0,3}[:=]\s{0,3}["']?(?P<secret>[A-Za-z0-9_+/=\-]{8,}+)"""),
    ("hex", r"(?<![\w])(?P<hex>[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![\w])"),
    ("email", r"(?<![\w.%+\-])(?P<email>[\w.%+\-]{1,254}+@[A-Za-z0-9\-]{1,63}+(?:\.[A-Za-z0-9\-]{1,63}+){1,8}+)"),
    ("ip", r"(?<![\w.])(?P<ip>(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d))(?![\w]|\.\d)"),
    ("iban", r"(?<!\w)(?P<iban>[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?)(?!\w)"),
    ("card", r"(?<![\w.+])(?P<card>\d{4}[ \-]?\d{4}[ \-]?\d{4}[ \-]?\d{1,7})(?!\w)"),
    ("ssn", r"(?<![\w\-])(?P<ssn>\d{3}-\d{2}-\d{4})(?![\w\-])"),
    ("phone", r"(?<![\w+(.\-])(?P<phone>" + PHONE.format(4) + r"|\+\d{8,15})(?![\w\-])"),
    ("person", rf"(?<!\w)(?P<person>(?:(?:{_TITLES})\.? {CAPITAL}(?: {CAPITAL}){{0,2}})|(?:(?:{_GIVEN}) {CAPITAL}))(?!\w)"),
]
ENTITY = re.compile("|".join(p for _, p in PATTERNS))
OTHER = re.compile("|".join(p for kind, p in PATTERNS if kind in ("ip", "card", "ssn", "email")))
# Nothing can match without one of these.
HINT = re.compile(rf"[\d@]|(?i:token|key|secret|passw|pwd)|\b(?:{_TITLES}|{_GIVEN})\b")
DATE = re.compile(r"(?:19|20)\d\d([ .\-])\d\d\1\d\d|\d\d([ .\-])\d\d\2(?:19|20)\d\d")


def entities(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` of everything personal, left to right, without overlaps.

    Of the phone form only 7 to 15 digits that are not a date are taken. Groups that
    follow a number are let go where they would make it too long, or where an
    address or card begins with them.
    """
    if HINT.search(text) is None:
        return []
    found, at = [], 0
    while m := ENTITY.search(text, at):
        kind = m.lastgroup
        start, end = m.span(kind)
        if kind == "phone":
            ends = [end] + [s.end() for p in SHORTER_PHONES if (s := p.match(text, start))]
            end = next((e for e in ends if _is_phone(text[start:e]) and not _cuts(text, start, e)), None)
            if end is None:
                # Go on behind the first group; nothing in it can start another number.
                at = re.compile(r"[+(]*\d+").match(text, start).end()
                continue
        found.append((start, end, kind))
        at = end
    return found


def _is_phone(value: str) -> bool:
    return 7 <= sum(c.isdigit() for c in value) <= 15 and not DATE.fullmatch(value)


def _cuts(text: str, start: int, end: int) -> bool:
    """Whether another entity begins inside a phone number and ends behind it."""
    for blank in re.compile(" ").finditer(text, start, end):
        m = OTHER.match(text, blank.end())
        if m and m.end() > end:
            return True
    return False


def _feistel(x: int, size: int, key: bytes, forward: bool) -> int:
    """A keyed permutation of ``range(size)``: a balanced network on bits, walked until inside the range."""
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    octets = (half + 7) // 8
    rounds = range(8) if forward else range(7, -1, -1)
    while True:
        left, right = x >> half, x & mask
        for r in rounds:
            seed = key + bytes([r]) + size.to_bytes((size.bit_length() + 7) // 8, "big")
            if forward:
                f = int.from_bytes(hashlib.shake_256(seed + right.to_bytes(octets, "big")).digest(octets), "big") & mask
                left, right = right, left ^ f
            else:
                f = int.from_bytes(hashlib.shake_256(seed + left.to_bytes(octets, "big")).digest(octets), "big") & mask
                left, right = right ^ f, left
        x = left << half | right
        if x < size:
            return x


def permuted(x: int, size: int, key: bytes) -> int:
    """One step along a keyed cycle through the whole range: a permutation without fixed points."""
    return _feistel((_feistel(x, size, key, True) + 1) % size, size, key, False) if size > 1 else x


def _keyed(key: bytes, kind: str, form: str) -> bytes:
    return hashlib.blake2b(f"{kind}\0{form}".encode(), key=key[:64], digest_size=16).digest()


def reshaped(value: str, kind: str, key: bytes, alphabets: list[str] = ALPHABETS) -> str:
    """The surrogate of a value in its own format; characters of no alphabet stay."""
    of = ALPHABET_OF if alphabets is ALPHABETS else {c: a for a in alphabets for c in a}
    used = [of.get(c) for c in value]
    number, size = 0, 1
    for c, alphabet in zip(value, used):
        if alphabet:
            number, size = number * len(alphabet) + alphabet.index(c), size * len(alphabet)
    form = "".join(str(ALPHABETS.index(a)) + "," if a in ALPHABETS else "x" if a else c for c, a in zip(value, used))
    number = permuted(number, size, _keyed(key, kind, form))
    out = []
    for c, alphabet in zip(reversed(value), reversed(used)):
        if alphabet:
            number, digit = divmod(number, len(alphabet))
            c = alphabet[digit]
        out.append(c)
    return "".join(reversed(out))


def _luhn(value: str) -> bool:
    digits = [int(c) for c in value if c.isdigit()][::-1]
    return (sum(digits[::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[1::2])) % 10 == 0


def _person(value: str, key: bytes) -> str:
    """Titles stay, known given names are exchanged within gender and script, other names keep their shape."""
    out, gender = [], ""
    for word in value.split(" "):
        bare = word.rstrip(".").lower()
        if bare in GENDER_OF_TITLE and not out:
            gender = GENDER_OF_TITLE[bare]
            out.append(word)
        elif bare in KIND_OF_NAME:
            # A name keeps its own gender, so a title of the same gender still agrees.
            names = GIVEN[KIND_OF_NAME[bare]]
            at = next(i for i, n in enumerate(names) if n.lower() == bare)
            name = names[permuted(at, len(names), _keyed(key, "given", str(KIND_OF_NAME[bare])))]
            out.append(name.upper() if word.isupper() else name)
        else:
            name = reshaped(word, "name", key)
            # Walking on past known given names keeps the two kinds of names apart.
            while name.lower() in KIND_OF_NAME:
                name = reshaped(name, "name", key)
            out.append(name)
    return " ".join(out)


def _ip(value: str, key: bytes) -> str:
    number = int.from_bytes(bytes(map(int, value.split("."))), "big")
    return ".".join(map(str, permuted(number, 1 << 32, _keyed(key, "ip", "")).to_bytes(4, "big")))


def surrogate(value: str, kind: str, key: bytes) -> str:
    """The keyed replacement of a value."""
    if kind == "person":
        return _person(value, key)
    if kind == "ip":
        return _ip(value, key)
    if kind == "email":
        # The last label is kept; host names and mailboxes are one value.
        body, dot, last = value.rpartition(".")
        return reshaped(body, kind, key) + dot + last
    if kind == "hex":
        return reshaped(value, kind, key, [HEX[value.upper() == value]])
    if kind == "card":
        # Valid numbers go to valid ones and invalid to invalid: walk along the cycle.
        made = reshaped(value, kind, key)
        while _luhn(made) != _luhn(value):
            made = reshaped(made, kind, key)
        return made
    if kind == "secret" and re.fullmatch(r"[0-9a-f]{16,}|[0-9A-F]{16,}", value):
        return reshaped(value, kind, key, [HEX[value.upper() == value]])
    return reshaped(value, kind, key)


def _replacer(key: bytes):
    cached = lru_cache(maxsize=100_000)(lambda value, kind: surrogate(value, kind, key))

    def replace(text: str) -> tuple[str, list[tuple[str, str, str]]]:
        found, parts, at = [], [], 0
        for start, end, kind in entities(text):
            value = text[start:end]
            made = cached(value, kind)
            found.append((kind, value, made))
            parts += [text[at:start], made]
            at = end
        return ("".join([*parts, text[at:]]) if found else text), found

    return replace


def anonymise(docs: DataFrame, secret: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``<key>, n_entities, kinds`` (sorted, comma-joined)``, text`` with surrogates.

    ``secret`` keys the permutations; another secret gives unrelated surrogates. A
    text without personal data is returned as it is, NULL as an empty text. Whole
    texts are read, however long. NULL keys, ties and repeated rows each give
    their own row; other columns are not read; an empty table gives an empty table.
    """
    code = hashlib.sha256(secret.encode("utf-8")).digest()

    def open_task():
        replace = _replacer(code)

        def work(keys, texts):
            done = [replace(t) for t in texts]
            kinds = [",".join(sorted({kind for kind, _, _ in found})) for _, found in done]
            return keys, [len(found) for _, found in done], kinds, [t for t, _ in done]

        return work

    rows = docs.select(F.col(key).cast("bigint").alias(key), text_or_empty(F.col(text)).alias("_text"))
    return map_batches(rows, open_task, {key: "bigint", "n_entities": "bigint", "kinds": "string", "text": "string"})


def mentions(docs: DataFrame, secret: str, text: str = "text") -> DataFrame:
    """Every distinct ``kind, value, surrogate`` of a corpus; reduced inside tasks before the shuffle."""
    code = hashlib.sha256(secret.encode("utf-8")).digest()

    def open_task():
        replace = _replacer(code)
        return lambda texts: list(zip(*(m for t in texts for m in replace(t)[1]))) or [[]] * 3

    rows = docs.select(text_or_empty(F.col(text)).alias("_text"))
    return map_batches(rows, open_task, {"kind": "string", "value": "string", "surrogate": "string"}).distinct()


def collisions(found: DataFrame) -> DataFrame:
    """The check of ``mentions``: surrogates that stand for several values, and values with several surrogates.

    ``kind, shared`` with the number of partners; no rows mean that distinctness
    and coreference hold over the whole corpus. Both counts combine map-side.
    """
    def several(by: str, other: str) -> DataFrame:
        return found.groupBy("kind", F.col(by).alias("shared")).agg(F.countDistinct(other).alias("n")).where("n > 1")

    return several("surrogate", "value").unionByName(several("value", "surrogate"))
