"""Keyed surrogates for personal data: consistent, distinct, and of the type and format replaced."""

from __future__ import annotations

import bisect
import hashlib
import hmac
import ipaddress
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date, timedelta

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from roomlens.llm.common import MAX_BROADCAST_BYTES, broadcast_if_small
from roomlens.sources.scratch import shared_table

MAX_ROUNDS = 40
_GROW_FROM = 12  # attempts after which a surrogate may be longer than what it replaces

# Titles by gender, and given names by gender and script.
TITLES = {
    "m": ("Mr", "Mister", "Sir", "Herr", "Monsieur", "Señor", "Sr", "Don", "Signor", "г-н", "господин", "κύριος"),
    "f": ("Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Mademoiselle", "Mlle", "Señora", "Sra", "Srta",
          "Doña", "Signora", "г-жа", "госпожа", "κυρία"),
}
GIVEN = {
    ("m", "LATIN"): (
        "James", "Robert", "Michael", "David", "William", "Richard", "Thomas", "Charles", "Daniel", "Matthew", "Anthony",
        "Steven", "Andrew", "Kenneth", "George", "Edward", "Brian", "Kevin", "Peter", "Walter", "Hans", "Jürgen",
        "Wolfgang", "Stefan", "Pierre", "François", "Philippe", "Laurent", "José", "Carlos", "Miguel", "Javier",
        "John", "Paul", "Mark", "Henry", "Ali", "Ahmed", "Omar", "Hassan", "Yusuf", "Wei", "Jun", "Hiroshi", "Raj", "Arjun",
    ),
    ("f", "LATIN"): (
        "Mary", "Patricia", "Jennifer", "Linda", "Elizabeth", "Barbara", "Susan", "Jessica", "Sarah", "Karen", "Nancy",
        "Margaret", "Sandra", "Ashley", "Emily", "Donna", "Michelle", "Carol", "Amanda", "Laura", "Ursula", "Monika",
        "Sabine", "Petra", "Nathalie", "Isabelle", "Sylvie", "Céline", "Carmen", "Lucía", "Pilar", "Dolores",
        "Anna", "Maria", "Julia", "Emma", "Fatima", "Aisha", "Layla", "Zainab", "Mei", "Ling", "Yuki", "Sakura", "Priya",
    ),
    ("m", "CYRILLIC"): ("Иван", "Сергей", "Дмитрий", "Алексей", "Николай", "Михаил", "Павел", "Виктор"),
    ("f", "CYRILLIC"): ("Анна", "Елена", "Ольга", "Наталья", "Ирина", "Татьяна", "Светлана", "Мария"),
    ("m", "GREEK"): ("Γιώργος", "Νίκος", "Δημήτρης", "Κώστας", "Παναγιώτης", "Βασίλης"),
    ("f", "GREEK"): ("Μαρία", "Ελένη", "Κατερίνα", "Σοφία", "Αγγελική", "Δήμητρα"),
}
_LETTERS = {
    "LATIN": "abcdefghijklmnopqrstuvwxyz", "CYRILLIC": "абвгдежзиклмнопрстуфхцчшэюя", "GREEK": "αβγδεζηθικλμνξοπρστυφχψω",
}
_SYLLABLES = {  # consonants and vowels of surrogate surnames
    "LATIN": ("bdfgklmnprstvw", "aeiou"), "CYRILLIC": ("бвгдклмнпрстфч", "аеиоу"), "GREEK": ("βγδκλμνπρστφ", "αεηιου"),
}
# Words that precede or follow the name of a person, and capitalised words that are no part of one.
_BEFORE = ("met", "named", "dear", "attn", "regards", "sincerely", "signed", "married", "contact", "wrote to", "spoke to", "spoke with",
           "thanks to", "thanked", "hired", "author", "interviewed", "emailed", "colleague", "brother", "sister", "father", "mother")
_WEAKLY_BEFORE = ("by", "from", "with", "to", "for")
_AFTER = ("said", "says", "wrote", "writes", "met", "told", "asked", "lives", "lived", "works", "worked", "emailed", "phoned", "replied",
          "was born", "married", "explained", "added", "graduated")
_WEAKLY_AFTER = (", who", " who", "'s", "’s", " has", " and his", " and her")
_NO_NAMES = frozenset(
    "The This That These Those A An In On At By For From With To And But Or If When While After Before Since As It He She They We You I "
    "His Her Their Our My Your What Where Who Why How There Here Then Now Yesterday Today Tomorrow Dear Hello Hi Thanks Regards Sincerely "
    "January February March April June July August September October November December Monday Tuesday Wednesday Thursday Friday Saturday "
    "Sunday North South East West New Old Great Upper Lower United States Kingdom Republic City County State University College School "
    "Institute Hospital Museum Church Park Street Road Avenue Lane River Lake Mount Mountain Island Sea Ocean Bay Inc Ltd Corp Company "
    "Group Bank Act Law Court Party Union Council Committee Department Ministry Office Press Times News Journal War World International "
    "National Royal Federal License Public General Chapter Section Table Figure Part Volume".split()
)
# Street words, dialling codes of two digits (one digit: 1 and 7; all others three) and lengths of national numbers.
_STREETS = ("Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Drive|Dr|Boulevard|Blvd|Court|Ct|Place|Pl|Square|Sq|Terrace|Way|Close|Crescent")
_STREET_ENDS = "straße|strasse|allee|platz|gasse|weg"
_TWO_DIGIT_CODES = frozenset(
    "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()
)
_NATIONAL_DIGITS = {"1": (10, 10), "7": (10, 10), "33": (9, 9), "34": (9, 9), "44": (9, 10), "48": (9, 9), "86": (8, 11), "91": (10, 10)}
_MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
_BIRTH_CUES = ("born", "birth", "dob", "d.o.b", "geboren", "geburtsdatum", "née", "né le", "naissance", "nacid", "nacimiento")
_BIRTHS = (date(1900, 1, 1), date(2029, 12, 31))
_GENDER = {name.lower(): (gender, script) for (gender, script), names in GIVEN.items() for name in names}
_TITLE = {title.lower(): gender for gender, titles in TITLES.items() for title in titles}

_WORD = r"[^\W\d_]+(?:[-'’][^\W\d_]+)*"
_SECRET_NAMES = r"(?:api|access|auth|client|private|secret)[_-]?(?:key|token|secret)|token|secret|password|passwd|pwd"
_PATTERNS = (
    ("email", r"(?<![\w.%+-])[\w.%+-]+@(?:[^\W_](?:[\w-]*[^\W_])?\.)+[^\W\d_]{2,24}"),
    ("secret", r"\bAKIA[0-9A-Z]{16}\b|\b(?:sk|pk)[-_](?:live[-_]|test[-_])?[A-Za-z0-9]{16,}|\bgh[pousr]_[A-Za-z0-9]{20,}"
               r"|(?<=\")[0-9a-f]{32,}(?=\")|\beyJ[\w-]{6,}\.eyJ[\w-]{6,}\.[\w-]{10,}|(?<=[Bb]earer )(?P<bearer>[\w.~+/-]{20,}=*)"
               r"|(?<=://)[^\s/:@]{1,64}:(?P<pw>[^\s/@]{1,128})@"
               rf"|(?i:(?<![^\W_])(?:{_SECRET_NAMES})\"?\s*[=:]\s*[\"']?)(?P<value>[^\s\"',;]{{6,}})"),
    ("iban", r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b"),
    ("card", r"(?<![\w.-])(?:\d{13,19}|\d{4}(?P<gap>[ -])\d{4}(?P=gap)\d{4}(?:(?P=gap)\d{1,4}){1,2}|\d{4}[ -]\d{6}[ -]\d{5})(?![\w-])"),
    ("phone", r"(?<![\w.])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w-])"
              r"|(?<!\w)\+[1-9](?:[ .-]?\(?\d{1,12}\)?){1,7}(?!\w)|(?<![\w.])\(0\d{1,5}\) ?\d(?:[ -]?\d){3,9}(?!\w)"),
    ("ssn", r"(?<![\w-])(?<!\d )\d{3}(?P<dash>[- ])\d{2}(?P=dash)\d{4}(?![\w-]| \d)"),
    ("ipv6", r"(?<![\w:.])(?:[0-9A-Fa-f]{1,4}:|::)(?::{0,2}[0-9A-Fa-f]{1,4}){0,7}(?:::)?(?![\w:])"),
    ("ip", r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d)(?!\w)"),
)
_FIND = re.compile("|".join(f"(?P<{kind}>{pattern})" for kind, pattern in _PATTERNS))
_MAYBE = re.compile(r"[0-9@=:]|AKIA|[sp]k[-_]|gh[pousr]_|eyJ")
# Patterns that begin with a set of characters, and go on only at the start of a word, are fast on any text.
_UPPER_SET = "A-ZÀ-ÖØ-ÞΆ-ΫЀ-Я"
_TITLED = re.compile(
    "(?P<title>" + "|".join(sorted(map(re.escape, (t for ts in TITLES.values() for t in ts)), key=len, reverse=True))
    + rf")(?=\.? +(?P<names>{_WORD}(?: {_WORD}){{0,2}}))"
)
_GIVEN = re.compile(rf"(?P<given>[{_UPPER_SET}](?<!\w.)[^\W\d_]+) (?=(?P<surname>{_WORD}))")
_CAP = rf"[{_UPPER_SET}](?<![^\W\d_].)[^\W\d_]+(?:[-'’][^\W\d_]+)*"
_SEQUENCE = re.compile(rf"{_CAP}(?: (?:[A-Z]\. )?(?:(?:van|von|de|da|dos|bin|ibn|al|der|den|la) ){{0,2}}{_CAP})+")
_CUE_BEFORE = re.compile(rf"(?<!\w)(?:(?P<strong>{'|'.join(_BEFORE)})|{'|'.join(_WEAKLY_BEFORE)})[:,]?\s{{1,2}}$", re.IGNORECASE)
_CUE_AFTER = re.compile(rf"(?P<strong> (?:{'|'.join(_AFTER)})(?!\w))|{'|'.join(_WEAKLY_AFTER)}")
_JOINED = re.compile(r" (?:and|&|und|et|y) |, (?:and )?")
_STREET = re.compile(
    rf"\d(?:\d{{0,4}}[A-Za-z]? (?:{_CAP} ){{1,3}}(?:{_STREETS})(?!\w)"
    rf"|\d{{0,3}}(?: bis| ter)?,? (?:rue|avenue|boulevard|place|chemin|quai) (?:(?:de la|de|du|des) |d['’])?{_CAP}(?: {_CAP}){{0,2}})"
)
_STREET_NUMBER = re.compile(rf"(?<!\w)[A-ZÄÖÜ][^\W\d_]*(?:{_STREET_ENDS}) \d{{1,4}}[a-z]?(?!\w)")
_STREET_FIXED = re.compile(
    rf"(?<!\w)(?:{_STREETS}|rue|avenue|boulevard|place|chemin|quai|bis|ter|de|la|du|des|d)(?!\w)|(?:{_STREET_ENDS})(?= \d)"
)
_BIRTH_CUE = (r"(?i:(?<!\w)(?:born(?: on)?|date of birth|birth ?date|birthday|d\.?o\.?b\.?|geboren am|geburtsdatum|née? le|"
              r"date de naissance|nacid[oa] el|fecha de nacimiento)(?: is| was)?(?!\w)[:\s]{1,3})")
_BORN = re.compile(
    rf"{_BIRTH_CUE}(?P<date>(?P<y1>\d{{4}})(?P<s1>[-/.])(?P<m1>\d\d?)(?P=s1)(?P<d1>\d\d?)|(?P<d2>\d\d?)(?P<s2>[-/.])(?P<m2>\d\d?)(?P=s2)(?P<y2>\d{{4}})"
    rf"|(?P<d3>\d\d?)\.? (?P<n3>(?i:{'|'.join(_MONTHS)})) (?P<y3>\d{{4}})|(?P<n4>(?i:{'|'.join(_MONTHS)})) (?P<d4>\d\d?),? (?P<y4>\d{{4}}))(?!\w)"
)


@dataclass(frozen=True)
class Mention:
    """A piece of text to replace: where, what type, the entity it names, and the entity's shape."""

    start: int
    end: int
    kind: str
    canonical: str
    shape: str


# Shapes are made of marks for what is drawn and of the characters that stay.
_LOWER, _DIGIT, _HEX, _UPPER, _CYRILLIC, _GREEK, _CHECK, _CONSONANT, _VOWEL = "\x01", "\x02", "\x03", "\x04", "\x05", "\x06", "\x07", "\x0e", "\x0f"


def script_of(char: str) -> str:
    name = unicodedata.name(char, "")
    return next((s for s in _LETTERS if name.startswith(s)), "LATIN")


def _shape(text: str) -> str:
    """Marks for letters (by script and case) and digits; everything else stays."""
    mark = {"LATIN": _LOWER, "CYRILLIC": _CYRILLIC, "GREEK": _GREEK}
    return "".join(
        _DIGIT if c.isdigit() else (_UPPER if c.isupper() and c.isascii() else mark[script_of(c)]) if c.isalpha() else c
        for c in text
    )


def _luhn(digits: str) -> int:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10


def _iban_rest(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def find_mentions(text: str) -> list[Mention]:
    """All mentions in order, none overlapping; checksums and ranges are tested, not only patterns.

    Of overlapping ones typed numbers and secrets come first, then dates of birth, streets, names
    after titles or known given names, and last capitalised words that their context makes a name.
    """
    found: list[Mention] = []
    if _MAYBE.search(text):
        for match in _FIND.finditer(text):
            kind = next(k for k, _ in _PATTERNS if match[k] is not None)
            start, end = match.span(next((g for g in ("value", "pw", "bearer") if match[g] is not None), kind))
            if mention := _typed(kind, start, end, text[start:end]):
                found.append(mention)
    for search in (_births, _streets, _titled, _sequences):
        found = _with_free(found, search(text))
    return _with_free(found, _repeats(text, found))


def _with_free(found: list[Mention], more: list[Mention]) -> list[Mention]:
    """``found`` (in order) and those of ``more`` that overlap none of it, in order."""
    starts = [m.start for m in found]
    free = []
    for m in more:
        before = bisect.bisect_left(starts, m.end) - 1  # the last one that starts before this ends
        if before < 0 or found[before].end <= m.start:
            free.append(m)
    return sorted(found + free, key=lambda m: m.start) if free else found


def _births(text: str) -> list[Mention]:
    """Dates after a word that makes them a birth, from 1900 to 2029, as the day they are."""
    low = text.lower()
    if not any(cue in low for cue in _BIRTH_CUES):
        return []
    out = []
    for match in _BORN.finditer(text):
        if day := _day(match):
            out.append(Mention(*match.span("date"), "birth", day.isoformat(), "birth"))
    return out


def _day(match: re.Match) -> date | None:
    nth = next(i for i in "1234" if match["y" + i])
    year, day = int(match["y" + nth]), int(match["d" + nth])
    month = int(match["m" + nth]) if nth in "12" else _MONTHS.index(match["n" + nth].lower()) + 1
    if month > 12:
        day, month = month, day  # 02/29/1980
    try:
        found = date(year, month, day)
    except ValueError:
        return None
    return found if _BIRTHS[0] <= found <= _BIRTHS[1] else None


def _streets(text: str) -> list[Mention]:
    """House number and street; the words that say it is one stay."""
    matches = [m for m in _STREET.finditer(text) if m.start() == 0 or not (text[m.start() - 1].isalnum() or text[m.start() - 1] in "._-")]
    if any(end in text for end in _STREET_ENDS.split("|")):
        matches += _STREET_NUMBER.finditer(text)
    out = []
    for match in matches:
        part = match[0]
        fixed = {i for f in _STREET_FIXED.finditer(part) for i in range(*f.span())}
        vowel, shape = False, []
        for i, c in enumerate(part):
            if c.isdigit():
                shape.append(_DIGIT)
            elif c.isalpha() and i not in fixed and any(d.isalpha() for d in part[max(0, i - 1) : i] + part[i + 1 : i + 2]):
                shape.append(_VOWEL if vowel else _CONSONANT)
                vowel = not vowel
            else:
                vowel = False
                shape.append(c.lower())
        out.append(Mention(*match.span(), "street", part.lower(), "".join(shape)))
    return out


def _titled(text: str) -> list[Mention]:
    """Names after a title or that begin with a known given name; in the order they start, none overlapping."""
    matches = [m for m in _TITLED.finditer(text) if not (m.start() and (text[m.start() - 1].isalnum() or text[m.start() - 1] == "_"))]
    matches += (m for m in _GIVEN.finditer(text) if m["given"].lower() in _GENDER)
    out: list[Mention] = []
    for match in sorted(matches, key=re.Match.start):
        persons = _names(match)
        if persons and (not out or out[-1].end <= persons[0].start):
            out += persons
    return out


def _sequences(text: str) -> list[Mention]:
    """Names of two to four capitalised words, by a score of what stands before and after them.

    A known given name, a word like "met" before, a word like "said" after, or a name beside it in a
    list counts 2, weaker words 1; 2 make a name. Words that begin sentences, and words of places,
    dates and offices, are no part of a name.
    """
    runs: list[tuple[list[tuple[int, str]], int, int]] = []  # words, end, score
    for match in _SEQUENCE.finditer(text):
        if match.start() and (text[match.start() - 1].isalnum() or text[match.start() - 1] in "_@/-.&"):
            continue
        words = [(match.start() + m.start(), m[0]) for m in re.finditer(_CAP, match[0])]
        while words and words[0][1] in _NO_NAMES:
            words = words[1:]
        if not 2 <= len(words) <= 4 or any(w in _NO_NAMES or w.lower() in _TITLE or w.isupper() for _, w in words):
            continue
        start, end = words[0][0], match.end()
        before = _CUE_BEFORE.search(text, max(0, start - 24), start)
        after = _CUE_AFTER.match(text, end)
        score = 2 * (words[0][1].lower() in _GENDER)
        score += (2 if before["strong"] else 1) if before else 0
        score += (2 if after["strong"] else 1) if after else 0
        runs.append((words, end, score))
    chosen = [score >= 2 for _, _, score in runs]
    beside = [bool(_JOINED.fullmatch(text, a[1], b[0][0][0])) for a, b in zip(runs, runs[1:])]
    for i, joined in enumerate(beside):
        chosen[i + 1] |= joined and chosen[i]
    for i in reversed(range(len(beside))):
        chosen[i] |= beside[i] and chosen[i + 1]
    return [m for (words, _, _), yes in zip(runs, chosen) if yes for m in _persons(words, _GENDER.get(words[0][1].lower(), "n")[0])]


def _repeats(text: str, found: list[Mention]) -> list[Mention]:
    """Capitalised whole-word repeats of the names found in the same text.

    A word found both as a given name and as a surname counts as what it was first.
    """
    persons: dict[str, Mention] = {}
    spellings: set[str] = set()
    for m in found:
        if m.kind == "surname" or m.kind.startswith("given_"):
            persons.setdefault(m.canonical, m)
            spellings.add(text[m.start : m.end])
    if not persons:
        return []
    words = "|".join(map(re.escape, sorted(spellings, key=lambda w: (-len(w), w))))
    out = []
    for match in re.finditer(rf"(?<!\w)(?:{words})(?!\w)", text, re.IGNORECASE):
        known = persons.get(match[0].lower())
        if known and match[0][0].isupper():
            out.append(Mention(*match.span(), known.kind, known.canonical, known.shape))
    return out


def _typed(kind: str, start: int, end: int, part: str) -> Mention | None:
    digits = "".join(c for c in part if c.isdigit())
    if kind == "email":
        local, _, domain = part.lower().rpartition("@")
        labels, _, last = domain.rpartition(".")
        return Mention(start, end, kind, part.lower(), f"{_shape(local)}@{_shape(labels)}.{last}")
    if kind == "secret":
        hexed = re.fullmatch(r"[0-9a-f]+", part)
        prefix = re.match(r"AKIA|eyJ|(?:sk|pk)[-_](?:live[-_]|test[-_])?|gh[pousr]_|", part)[0]
        head, dot, body = part[len(prefix):].partition(".eyJ" if prefix == "eyJ" else "\0")
        shape = _HEX * len(part) if hexed else prefix + _shape(head) + dot + _shape(body)
        return Mention(start, end, kind, part, shape)
    if kind == "card":
        if _luhn(digits):  # no card, but a number of an account all the same
            return Mention(start, end, "account", digits, digits[0] + _DIGIT * (len(digits) - 1))
        return Mention(start, end, kind, digits, digits[0] + _DIGIT * (len(digits) - 2) + _CHECK)
    if kind == "iban":
        plain = part.replace(" ", "")
        if not 15 <= len(plain) <= 34 or _iban_rest(plain) != 1:
            return None
        return Mention(start, end, kind, plain, plain[:2] + _CHECK * 2 + _shape(plain[4:]))
    if kind == "phone":
        return _phone(start, end, part, digits)
    if kind == "ipv6":
        try:
            address = ipaddress.IPv6Address(part).compressed
        except ValueError:
            return None
        groups = [g for g in address.split(":") if g]
        if len(groups) < 2 or not digits:
            return None  # "::", and words of hex letters around a scope operator
        return Mention(start, end, kind, address, re.sub("[0-9a-f]", _HEX, address))
    if kind == "ssn":
        if digits[:3] in ("000", "666") or digits[3:5] == "00" or digits[5:] == "0000":
            return None
        return Mention(start, end, kind, digits, _DIGIT * 9)
    return Mention(start, end, "ip", ".".join(str(int(o)) for o in part.split(".")), "ip")


def _phone(start: int, end: int, part: str, digits: str) -> Mention | None:
    """A telephone number; one of ten digits is the same with and without the code 1."""
    code = ""
    if part.startswith("+"):
        code = next((c for c in (digits[:1], digits[:2]) if c in ("1", "7") or c in _TWO_DIGIT_CODES), digits[:3])
        least, most = _NATIONAL_DIGITS.get(code, (6, 12))
        trunk = 1 if "(0)" in part else 0
        if not least <= len(digits) - len(code) - trunk <= most:
            return None
        digits = digits[len(code) + trunk :]
    head = f"+{code} " if code not in ("", "1") else ""
    kept = "0" if digits.startswith("0") else ""
    return Mention(start, end, "phone", head + digits, head + kept + _DIGIT * (len(digits) - len(kept)))


def _names(match: re.Match) -> list[Mention]:
    """Given names and surname of a person, each an entity of its own, so that "Mr Smith" and
    "Mr John Smith" share the surname's surrogate."""
    if match.re is _TITLED:
        gender = _TITLE[match["title"].lower()]
        words = [(m.start() + match.start("names"), m[0]) for m in re.finditer(_WORD, match["names"])]
        upper = 0
        while upper < len(words) and words[upper][1][0].isupper():
            upper += 1
        words = words[:upper]
    else:
        gender, _ = _GENDER[match["given"].lower()]
        words = [(match.start("given"), match["given"]), (match.start("surname"), match["surname"])]
        if not match["surname"][0].isupper():
            return []
    return _persons(words, gender)


def _persons(words: list[tuple[int, str]], gender: str) -> list[Mention]:
    """The last of ``words`` (start, word) is the surname, the others are given names."""
    out = []
    for i, (start, word) in enumerate(words):
        word = re.sub(r"(?<=\w)['’]s$", "", word)  # a possessive names the same person
        script = script_of(word[0])
        kind = "surname" if i == len(words) - 1 else f"given_{gender}"
        out.append(Mention(start, start + len(word), kind, word.lower(), f"{script}:{len(word)}"))
    return out


class Surrogates:
    """Draws surrogates from a secret key; knows nothing of other entities.

    Days of birth are few, so they are not drawn but exchanged one to one, none for itself.
    """

    def __init__(self, key: bytes):
        self.key = key

    def digest(self, kind: str, canonical: str) -> str:
        """Keyed identity of an entity; tables of entities hold this, never the entity."""
        return hmac.new(self.key, f"entity\0{kind}\0{canonical}".encode("utf-8", "surrogatepass"), "sha256").hexdigest()[:32]

    def _draw(self, kind: str, digest: str, attempt: int, size: int) -> bytes:
        seed = hmac.new(self.key, f"draw\0{kind}\0{digest}\0{attempt}".encode(), "sha256").digest()
        return hashlib.shake_256(seed).digest(size)

    def _swap(self, number: int, backwards: bool) -> int:
        """A keyed one-to-one mapping of the numbers below 2 ** 16, or its inverse: four Feistel rounds."""
        left, right = number >> 8, number & 255
        for i in reversed(range(4)) if backwards else range(4):
            if backwards:
                left, right = right ^ hmac.new(self.key, f"day\0{i}\0{left}".encode(), "sha256").digest()[0], left
            else:
                left, right = right, left ^ hmac.new(self.key, f"day\0{i}\0{right}".encode(), "sha256").digest()[0]
        return left << 8 | right

    def _place(self, number: int, days: int, backwards: bool) -> int:
        """The mapping of the numbers below ``days``: steps outside are walked through."""
        number = self._swap(number, backwards)
        while number >= days:
            number = self._swap(number, backwards)
        return number

    def birth(self, canonical: str) -> str:
        """Another day: a keyed order of all days, moved on by a keyed number of days."""
        days = (_BIRTHS[1] - _BIRTHS[0]).days + 1
        moved = 1 + int.from_bytes(hmac.new(self.key, b"days", "sha256").digest()[:4], "big") % (days - 1)
        at = self._place((date.fromisoformat(canonical) - _BIRTHS[0]).days, days, False)
        return (_BIRTHS[0] + timedelta(self._place((at + moved) % days, days, True))).isoformat()

    def make(self, kind: str, digest: str, shape: str, attempt: int) -> str:
        """The canonical surrogate of an entity at the given attempt."""
        drawn = iter(self._draw(kind, digest, attempt, 2 * len(shape) + 80))

        def pick(choices: str) -> str:
            return choices[(next(drawn) << 8 | next(drawn)) % len(choices)]

        more = max(0, attempt - _GROW_FROM + 1)
        if kind == "ip":
            return ".".join(str(1 + next(drawn) % 223 if i == 0 else 1 + next(drawn) % 254) for i in range(4))
        if kind.startswith("given_") or kind == "surname":
            script, _, size = shape.partition(":")
            names = GIVEN.get((kind[-1], script), ()) if kind != "surname" else ()
            if names and attempt == 0:
                return names[int.from_bytes(self._draw(kind, digest, 0, 4), "big") % len(names)].lower()
            consonants, vowels = _SYLLABLES[script]
            pairs = max(2, min(5, int(size) // 2)) + more + attempt // 4
            stem = "".join(pick(consonants) + pick(vowels) for _ in range(min(pairs, 20)))
            return stem + ("а" if script == "CYRILLIC" else "α" if script == "GREEK" else "a") if kind == "given_f" else stem + pick(consonants)
        marks = {
            _LOWER: _LETTERS["LATIN"], _UPPER: _LETTERS["LATIN"].upper(), _DIGIT: "0123456789", _HEX: "0123456789abcdef",
            _CYRILLIC: _LETTERS["CYRILLIC"], _GREEK: _LETTERS["GREEK"],
            _CONSONANT: _SYLLABLES["LATIN"][0], _VOWEL: _SYLLABLES["LATIN"][1],
        }
        if kind == "ipv6" and more:
            shape = ":".join([_HEX * 4] * 8)
        out = "".join(pick(marks[c]) if c in marks else c for c in shape)
        if kind == "phone":
            at = shape.index(_DIGIT)
            out = out[:at] + "23456789"[int(out[at]) % 8] + out[at + 1 :]
        elif kind == "ipv6":
            out = re.sub(r"(?<![0-9a-f])0", "1", out)  # no group changes its length
            out = re.sub(r"^[0-9a-f]+(?=:)", lambda g: g[0] if g[0][0].isdigit() else "2" + g[0][1:], out)
        elif kind == "street":
            out = re.sub(r"^0|(?<= )0(?=\d*[a-z]?$)", "1", out) + ("bdfgklmnprst"[more % 12] if more else "")
        elif kind == "ssn":
            out = str(1 + int(out[0]) % 5) + out[1:3] + "23456789"[int(out[3]) % 8] + out[4] + "123456789"[int(out[5]) % 9] + out[6:]
        elif kind == "card":
            out = out.replace(_CHECK, "0")
            out = out[:-1] + str((10 - _luhn(out)) % 10)
        elif kind == "account" and not _luhn(out):
            out = out[:-1] + str((int(out[-1]) + 1) % 10)  # stays a number that is no card's
        elif kind == "iban":
            out = out.replace(_CHECK, "0").upper()
            out = out[:2] + f"{98 - _iban_rest(out):02d}" + out[4:]
        elif more:
            extra = "".join(pick(marks[_HEX]) for _ in range(more))
            out = extra + out if kind == "email" else out + extra
        return out


def render(surrogate: str, mention: Mention, text: str) -> str:
    """The surrogate in the format of one mention: its separators, its letter case."""
    part = text[mention.start : mention.end]
    if mention.kind in ("account", "card", "ssn", "iban"):
        left = iter(surrogate)
        return "".join(next(left) if c.isalnum() else c for c in part)
    if mention.kind == "phone":
        surrogate = surrogate.rpartition(" ")[2]
        prefix = sum(c.isdigit() for c in part) - len(surrogate)
        left, out, seen = iter(surrogate), [], 0
        for c in part:
            if c.isdigit():
                seen += 1
                out.append(c if seen <= prefix else next(left))
            else:
                out.append(c)
        return "".join(out)
    if mention.kind == "birth":
        return _same_date_form(date.fromisoformat(surrogate), part)
    if mention.kind == "street":
        return "".join(c.upper() if i < len(part) and part[i].isupper() else c for i, c in enumerate(surrogate))
    if mention.kind == "ipv6":
        made = surrogate if "::" in part else ipaddress.IPv6Address(surrogate).exploded
        return made.upper() if part.isupper() else made
    if mention.kind == "email":
        return surrogate.upper() if part.isupper() else surrogate
    if mention.kind == "surname" or mention.kind.startswith("given_"):
        return surrogate.upper() if len(part) > 1 and part.isupper() else surrogate[:1].upper() + surrogate[1:]
    return surrogate


def _same_date_form(day: date, part: str) -> str:
    """``day`` written as the date ``part`` is: order of its parts, separators, leading zeros, month's name."""
    written = _BORN.match("born " + part)
    nth = next(i for i in "1234" if written["y" + i])
    swapped = nth in "12" and int(written["m" + nth]) > 12

    def padded(number: int, like: str) -> str:
        return f"{number:02d}" if len(like) > 1 else str(number)

    new = {"y" + nth: str(day.year), "d" + nth: padded(day.day, written["d" + nth])}
    if nth in "12":
        new["m" + nth] = padded(day.month, written["m" + nth])
        if swapped:
            new["d" + nth], new["m" + nth] = padded(day.month, written["d" + nth]), padded(day.day, written["m" + nth])
    else:
        name = _MONTHS[day.month - 1]
        new["n" + nth] = name.upper() if written["n" + nth].isupper() else name.capitalize() if written["n" + nth][0].isupper() else name
    out, at = [], 5
    for group in sorted(new, key=written.start):
        out += [written.string[at : written.start(group)], new[group]]
        at = written.end(group)
    return "".join([*out, written.string[at:]])


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def entities(docs: DataFrame, key: bytes) -> DataFrame:
    """(doc_id, text_key, kind, digest, shape) of every entity of every text, once a text; births cannot collide."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = Surrogates(key)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text_key, text in zip(batch["doc_id"].to_pylist(), batch["text_key"].to_pylist(), batch["text"]):
                seen = {(m.kind, m.canonical): m.shape for m in find_mentions(text.as_py()) if m.kind != "birth"}
                rows += [(doc_id, text_key, kind, source.digest(kind, name), shape) for (kind, name), shape in seen.items()]
            columns = list(zip(*rows)) or [()] * 5
            types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=["doc_id", "text_key", "kind", "digest", "shape"]
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64(_text()).alias("text_key"), _text().alias("text"))
    return rows.mapInArrow(run, "doc_id long, text_key long, kind string, digest string, shape string")


def _drawn(state: DataFrame, key: bytes) -> DataFrame:
    """``state`` (kind, digest, shape, attempt) with the keyed identity of each surrogate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = Surrogates(key)
        for batch in batches:
            made = [
                source.digest(r["kind"], source.make(r["kind"], r["digest"], r["shape"], r["attempt"])) for r in batch.to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], names=[*batch.schema.names, "made"])

    return state.mapInArrow(run, "kind string, digest string, shape string, attempt int, made string")


def settle_collisions(found: DataFrame, key: bytes) -> DataFrame:
    """(kind, digest, attempt) of the entities whose first surrogate would collide.

    A surrogate collides if another entity of the type has it, or if it is itself an entity of the
    corpus. Of entities with one surrogate that with the fewest attempts, then the smallest digest,
    keeps it; the others draw again, until no two entities share one.
    """
    state = shared_table(
        found.groupBy("kind", "digest").agg(F.min("shape").alias("shape")).withColumn("attempt", F.lit(0)), "pii-entities"
    )
    real = state.select("kind", F.col("digest").alias("made")).withColumn("real", F.lit(True))
    for _ in range(MAX_ROUNDS):
        order = Window.partitionBy("kind", "made").orderBy("attempt", "digest")
        judged = shared_table(
            _drawn(state, key).withColumn("nth", F.row_number().over(order)).join(real, ["kind", "made"], "left")
            .withColumn("again", (F.col("nth") > 1) | F.col("real").isNotNull()),
            "pii-judged",
        )
        if judged.where("again").isEmpty():
            return state.where("attempt > 0").select("kind", "digest", "attempt")
        state = judged.select("kind", "digest", "shape", F.expr("INT(if(again, attempt + 1, attempt))").alias("attempt"))
    raise RuntimeError(f"surrogates still collide after {MAX_ROUNDS} rounds")


def replace_entities(docs: DataFrame, key: bytes, max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``docs`` with every detected entity in ``text`` replaced, and the counts n_mentions, n_entities.

    Equal entities (emails but for case, numbers but for separators, names but for case) get equal
    surrogates in every document, different ones different surrogates, of the same type, script,
    length or check digits, and in a name the same gender (given names beyond the list have none). The same key gives the same surrogates
    for a corpus. A task draws them itself; only the few entities that had to draw again are joined,
    by document. Null texts stay null; texts without entities stay as they are; repeated rows come
    back as often; all other columns are kept; columns with the names of the counts are replaced. A
    text is searched whole in a task, whatever its length; no rows give no rows.
    """
    found = shared_table(entities(docs, key), "pii-found")
    again = settle_collisions(found, key)
    per_doc = shared_table(
        found.join(again, ["kind", "digest"])
        .groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
        .agg(F.collect_set(F.struct("kind", "digest", "attempt")).alias("_again")),
        "pii-again",
    )
    kept = [c for c in docs.columns if c not in ("n_mentions", "n_entities")]
    small = broadcast_if_small(per_doc, "32 + 64 * size(_again)", max_broadcast_bytes)
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.xxhash64(_text()) == F.col("_key"))
    joined = docs.select(*(F.col(f"`{c}`") for c in kept)).join(small, same, "left").select(
        *(F.col(f"`{c}`") for c in kept if c != "text"), F.col("text").cast("string"), "_again"
    )
    last = len(kept) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = Surrogates(key)
        for batch in batches:
            texts, mentions, names = [], [], []
            for text, redrawn in zip(batch.column(last), batch.column(last + 1)):
                text = text.as_py()
                found = find_mentions(text) if text else []
                attempts = {(a["kind"], a["digest"]): a["attempt"] for a in redrawn.as_py() or ()}
                out, at, seen = [], 0, set()
                for m in found:
                    digest = source.digest(m.kind, m.canonical)
                    made = (
                        source.birth(m.canonical) if m.kind == "birth"
                        else source.make(m.kind, digest, m.shape, attempts.get((m.kind, digest), 0))
                    )
                    out += [text[at : m.start], render(made, m, text)]
                    at = m.end
                    seen.add((m.kind, digest))
                texts.append("".join([*out, text[at:]]) if found else text)
                mentions.append(len(found))
                names.append(len(seen))
            others = iter(batch.columns[:last])
            new = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(
                [*(new if c == "text" else next(others) for c in kept), pa.array(mentions, pa.int64()), pa.array(names, pa.int64())],
                names=[*kept, "n_mentions", "n_entities"],
            )

    types = {f.name: f.dataType.simpleString() for f in docs.schema} | {"text": "string"}
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in kept), "n_mentions long", "n_entities long"])
    return joined.mapInArrow(run, schema)
