"""Personal data: format-preserving pseudonyms by keyed Feistel permutations."""

from __future__ import annotations

import calendar
import hashlib
import re
import unicodedata
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from datetime import date
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "secret", "key", "iban", "ip", "date", "ssn", "phone", "card")

#: Demonstration key; pass your own.
KEY = b"readlake-demonstration-key"

_DIGITS = "0123456789"
_LOWER = "abcdefghijklmnopqrstuvwxyz"
_LATIN = "".join(map(chr, [*range(0xDF, 0xF7), *range(0xF8, 0x100)]))
_LATIN_UPPER = "".join(map(chr, [*range(0xC0, 0xD7), *range(0xD8, 0xDF)]))
_CLASSES = (_DIGITS, _LOWER, _LOWER.upper(), _LATIN, _LATIN_UPPER)
_CLASS = {c: k for k in _CLASSES for c in k}
#: Country codes of telephone numbers with one and with two digits; all others have three. Fixed values.
_ONE_DIGIT = {"1", "7"}
_TWO_DIGITS = set(
    "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()
)

_PATTERN = re.compile(
    r"""
    (?P<email>[\w.+-]+@[\w-]+(?:\.[\w-]+)*\.[A-Za-z]{2,})
  | (?P<secret>\b(?:\w{0,40}[_-])?(?i:token|secret|passw(?:or)?d|pwd|api[_-]?key|access[_-]?key|secret[_-]?key|private[_-]?key)\b["']?
      (?:\s*(?P<equals>=)\s*|\s*:\s*)(?P<quote>["']?)(?![\w.+-]+@[\w-]+\.)(?P<secret_value>[A-Za-z0-9+/_.~!@\#$%^&*-]*[A-Za-z0-9+/_~!@\#$%^&*-]=*))
  | (?P<key>\b(?:AKIA|ASIA)[0-9A-Z]{16}\b|\bgh[pousr]_[A-Za-z0-9]{36}\b|\bsk-[A-Za-z0-9]{20,}\b|\bxox[abprs]-[A-Za-z0-9-]{10,}\b)
  | (?P<iban>\b[A-Z]{2}\d{2}(?:\ ?[A-Z0-9]{4}){2,7}(?:\ ?[A-Z0-9]{1,3})?\b)
  | (?P<ip>(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\.?\d))
  | (?P<date>(?<![\d/.-])(?:\d{4}-\d{2}-\d{2}|\d{1,2}(?P<sep>[./])\d{1,2}(?P=sep)\d{4})(?![\d/-]))
  | (?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))
  | (?P<phone>(?<![\d+])(?:(?:\+[1-9]\d{0,2}[ .-]?|00[1-9]\d{0,2}[ .-])(?:\(0\)[ ]?)?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,4}|\(\d{3}\)[ ]?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?![\d-]))
  | (?P<card>(?<!\d)(?:(?<!-)|(?<=\d-))\d(?:[ -]?\d){12})
    """,
    re.VERBOSE,
)
#: The same alternatives one by one, for places where the first of them fails its check.
_EACH = {
    k: re.compile(p, re.VERBOSE)
    for k, p in zip(KINDS, re.split(r"\n  \| (?=\(\?P<(?:%s)>)" % "|".join(KINDS), _PATTERN.pattern.strip()))
}
_GROUP = re.compile(r"[ -]?(\d+)")
_FIRST = re.compile(r"[^\W_]+")
#: Digit groups as cards print them; a card written without spaces is one group.
_CARD_GROUPS = {(4, 4, 4, 4), (4, 6, 5), (4, 6, 4)}
_CARD_MOST = 19
#: Length of an IBAN by country.
_IBAN_LENGTHS = {
    c: int(n)
    for n, cs in (x.split(":") for x in (
        "15:NO 16:BE 18:DK,FI,FK,FO,GL,NL,SD 19:MK,SI 20:AT,BA,EE,KZ,LT,LU,MN,XK 21:CH,HR,LI,LV "
        "22:BG,BH,CR,DE,GB,GE,IE,ME,RS,VA 23:AE,GI,IL,IQ,OM,SO,TL 24:AD,CZ,ES,MD,PK,RO,SA,SE,SK,TN,VG 25:LY,PT,ST "
        "26:IS,TR 27:BI,DJ,FR,GR,IT,MC,MR,SM 28:AL,AZ,BY,CY,DO,GT,HN,HU,LB,NI,PL,SV 29:BR,EG,PS,QA,UA 30:JO,KW,YE 31:MT,SC 32:LC 33:RU"
    ).split())
    for c in cs.split(",")
}
_MAYBE = re.compile(r"[@0-9]|(?i:token|secret|passw|pwd|key)|sk-|xox")


def permute(key: bytes, tweak: str, x: int, n: int) -> int:
    """A keyed permutation of range(n): eight Feistel rounds over the next even number of bits, walked until back in range."""
    if n < 2:
        return x
    half = max(1, -(-(n - 1).bit_length() // 2))
    mask = (1 << half) - 1
    size = -(-half // 8)
    while True:
        a, b = x >> half, x & mask
        for i in range(8):
            block = f"{tweak}:{n}:{i}:{b}".encode()
            f, word = 0, b""
            while len(word) < size:
                word += hashlib.blake2b(block + bytes([len(word) // 32]), key=key[:64], digest_size=32).digest()
            f = int.from_bytes(word[:size], "little") & mask
            a, b = b, a ^ f
        x = (a << half) | b
        if x < n:
            return x


@lru_cache(maxsize=1)
def _lone() -> str:
    """Letters and digits that no other of their kind shares 256 code points with."""
    near = [(i >> 8, unicodedata.category(chr(i)), chr(i)) for i in range(0x110000) if chr(i).isalnum() and chr(i) not in _CLASS]
    count = Counter(x[:2] for x in near)
    return "".join(c for block, kind, c in near if count[block, kind] == 1)


@lru_cache(maxsize=1 << 12)
def _class_of(c: str) -> str:
    """The characters that `c` is permuted among: those of its class or, for letters and digits of other scripts, those of
    the same category in its 256 code points; none for separators."""
    if c in _CLASS or not c.isalnum():
        return _CLASS.get(c, "")
    kind, block = unicodedata.category(c), ord(c) >> 8 << 8
    near = "".join(x for x in map(chr, range(block, block + 256)) if x.isalnum() and x not in _CLASS and unicodedata.category(x) == kind)
    return near if len(near) > 1 else _lone()


def _shuffle_classes(key: bytes, tweak: str, s: str, classes: dict[str, str] | None = None) -> str:
    """Permute a string among all with the same kind of character at each place; separators stay."""
    kinds = [_class_of(c) if classes is None else classes.get(c, "") for c in s]
    x, n = 0, 1
    for c, k in zip(s, kinds):
        if k:
            x, n = x * len(k) + k.index(c), n * len(k)
    y = permute(key, tweak, x, n)
    out = []
    for c, k in zip(reversed(s), reversed(kinds)):
        if k:
            y, r = divmod(y, len(k))
            c = k[r]  # noqa: PLW2901
        out.append(c)
    return "".join(reversed(out))


def _refill(like: str, digits: str) -> str:
    """`digits` in place of those of `like`."""
    it = iter(digits)
    return "".join(next(it) if c.isdecimal() else c for c in like)


def luhn_digit(payload: str) -> str:
    """The check digit that makes payload plus it valid."""
    total = 0
    for i, c in enumerate(reversed(payload)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _is_card(d: str) -> bool:
    return 13 <= len(d) <= _CARD_MOST and len(set(d)) > 1 and int(luhn_digit(d[:-1])) == int(d[-1])


def _card_end(text: str, start: int) -> int | None:
    """Where the card ends whose first digit group begins at `start`: a valid span of whole groups, one that is grouped as
    cards are before longer ones. None if there is none, or if it would cut into a card that begins at a later group."""
    groups: list[tuple[int, int]] = []
    at, total = start, 0
    # a span has at most _CARD_MOST digits, and so has one that begins inside it
    while total <= 2 * _CARD_MOST and (g := _GROUP.match(text, at)):
        groups.append(g.span(1))
        at, total = g.end(), total + g.end(1) - g.start(1)
    open_end = text.startswith("-", at)

    def spans(i: int) -> Iterator[tuple[int, bool]]:
        d, sizes = "", ()
        for j, (a, b) in enumerate(groups[i:], i):
            if len(d) + b - a > _CARD_MOST:
                return
            d, sizes = d + text[a:b], (*sizes, b - a)
            if _is_card(d) and not (open_end and j == len(groups) - 1):
                yield j, len(sizes) == 1 or sizes in _CARD_GROUPS

    last = None
    for j, usual in spans(0):
        if usual:
            return groups[j][1]
        last = j
    if last is None or any(usual for i in range(1, last + 1) for _, usual in spans(i)):
        return None
    return groups[last][1]


def _iban_end(s: str) -> list[int]:
    """Where an IBAN may end that begins `s`: at its country's length, then at the end; in unknown countries after any group."""
    after = [i + 1 for i, c in enumerate(s) if c != " "]
    whole = {i for i in after if i == len(s) or s[i] == " "}
    n = _IBAN_LENGTHS.get(s[:2])
    if n is None:
        return sorted(whole, reverse=True)
    return [*([after[n - 1]] if n <= len(after) and after[n - 1] in whole else []), len(s)]


def _card(key: bytes, s: str) -> str | None:
    d = re.sub(r"\D", "", s)
    if not _is_card(d):
        return None
    body = str(permute(key, "card", int(d[:-1]), 10 ** (len(d) - 1))).zfill(len(d) - 1)
    return _refill(s, body + luhn_digit(body))


def _iban(key: bytes, s: str) -> str | None:
    c = s.replace(" ", "")
    number = lambda t: int("".join(str(int(x, 36)) for x in t))
    if not 15 <= len(c) <= 34 or number(c[4:] + c[:4]) % 97 != 1:
        return None
    body = _shuffle_classes(key, "iban" + c[:2], c[4:])
    new = c[:2] + f"{98 - number(body + c[:2] + '00') % 97:02d}" + body
    it = iter(new)
    return "".join(x if x == " " else next(it) for x in s)


def _ip(key: bytes, s: str) -> str | None:
    parts = s.split(".")
    if any(int(p) > 255 or str(int(p)) != p for p in parts):
        return None
    # each part moves among those with as many digits
    low = [(0, 10, 100)[len(p) - 1] for p in parts]
    size = [(10, 90, 156)[len(p) - 1] for p in parts]
    x, n = 0, 1
    for p, a, m in zip(parts, low, size):
        x, n = x * m + int(p) - a, n * m
    x = permute(key, f"ip{low}", x, n)
    out = []
    for a, m in zip(reversed(low), reversed(size)):
        x, r = divmod(x, m)
        out.append(str(a + r))
    return ".".join(reversed(out))


@lru_cache(maxsize=64)
def _days(block: int, day_wide: bool, month_wide: bool) -> list[int]:
    """Of the 200 years from 200 * block - 100: the days whose day and month have two digits or one, as ordinals."""
    first, last = max(1, 200 * block - 100), min(9999, 200 * block + 99)
    months = range(10, 13) if month_wide else range(1, 10)
    out = []
    for y in range(first, last + 1):
        for m in months:
            for d in range(10, calendar.monthrange(y, m)[1] + 1) if day_wide else range(1, 10):
                out.append(date(y, m, d).toordinal())
    return out


def _date(key: bytes, s: str) -> str | None:
    """The same day gives the same pseudonym however it is written; day before month, unless only month first is valid.

    A day moves within its 200 years (1900 to 2099, and so before and after) and among those whose day and month have as
    many digits, so every spelling keeps its length.
    """
    iso, sep = "-" in s, "/" if "/" in s else "."
    parts = re.split(r"[./-]", s)
    a = [int(p) for p in parts]
    orders = [(a[0], a[1], a[2])] if iso else [(a[2], a[1], a[0]), (a[2], a[0], a[1])]
    for i, (y, m, d) in enumerate(orders):
        try:
            day = date(y, m, d).toordinal()
        except ValueError:
            continue
        block, kind = (y + 100) // 200, (d > 9, m > 9)
        days = _days(block, *kind)
        new = date.fromordinal(days[permute(key, f"date{block}{kind}", bisect_left(days, day), len(days))])
        if iso:
            return f"{new.year:04d}-{new.month:02d}-{new.day:02d}"
        first, second = (new.day, new.month) if i == 0 else (new.month, new.day)
        return f"{first:0{len(parts[0])}d}{sep}{second:0{len(parts[1])}d}{sep}{new.year:04d}"
    return None


def _ssn(key: bytes, s: str) -> str | None:
    a, g, n = map(int, s.split("-"))
    if a in (0, 666) or a >= 900 or not g or not n:
        return None
    areas = [x for x in range(1, 900) if x != 666]
    x = permute(key, "ssn", (areas.index(a) * 99 + g - 1) * 9999 + n - 1, len(areas) * 99 * 9999)
    return f"{areas[x // 9999 // 99]:03d}-{x // 9999 % 99 + 1:02d}-{x % 9999 + 1:04d}"


def _phone(key: bytes, s: str) -> str | None:
    """The digits after the country code are permuted, so all spellings of a number stay linked; without a code it is 1."""
    head = re.match(r"\+|00|", s).group()
    d = re.sub(r"\D", "", s[len(head) :])
    code = "1"
    if head:
        code = d[:1] if d[:1] in _ONE_DIGIT else d[:2] if d[:2] in _TWO_DIGITS else d[:3]
        keep = re.match(r"(?:\D*\d){%d}(?:[ .-]?\(0\))?" % len(code), s[len(head) :])
        head += keep.group()
        d = re.sub(r"\D", "", s[len(head) :])
    if not 6 <= len(d) <= 13:
        return None
    return head + _refill(s[len(head) :], str(permute(key, f"phone{code}", int(d), 10 ** len(d))).zfill(len(d)))


def _email(key: bytes, s: str) -> str:
    local, _, domain = s.rpartition("@")
    return _shuffle_classes(key, "email", local) + "@" + domain


def _secret(key: bytes, s: str) -> str | None:
    if re.fullmatch("[0-9a-f]+", s) and re.search("[0-9]", s):
        return _shuffle_classes(key, "hex", s, dict.fromkeys("0123456789abcdef", "0123456789abcdef"))
    if re.fullmatch("[0-9A-F]+", s) and re.search("[0-9]", s):
        return _shuffle_classes(key, "hex", s, dict.fromkeys("0123456789ABCDEF", "0123456789ABCDEF"))
    return _shuffle_classes(key, "secret", s)


def _is_secret(m: re.Match) -> bool:
    """A value that is assigned, quoted, long or holds a digit; a short plain word after a colon is prose."""
    value = m.group("secret_value")
    return bool(m.group("equals") or m.group("quote") or len(value) >= 12 or re.search(r"\d", value))


def _key(key: bytes, s: str) -> str:
    """Keys known by their first letters, which stay."""
    head = re.match(r"AKIA|ASIA|gh[pousr]_|sk-|xox[abprs]-", s).group()
    return head + _shuffle_classes(key, "secret", s[len(head) :])


_MAKERS = {"key": _key, "iban": _iban, "ip": _ip, "date": _date, "ssn": _ssn, "phone": _phone, "card": _card, "email": _email}


def pseudonymise(text: str, key: bytes = KEY) -> tuple[str, dict[str, int]]:
    """The text with pseudonyms in place of what was found and valid, and how many of each kind."""
    counts: dict[str, int] = {}
    if not _MAYBE.search(text):
        return text, counts

    def swap(kind: str, m: re.Match) -> tuple[str, int] | None:
        """What comes in place of the text from the match's start to an end, and that end."""
        s, start = m.group(kind), m.start()
        if kind == "secret":
            value = m.group("secret_value")
            new = _secret(key, value) if _is_secret(m) else None
            return None if new is None else (s[: len(s) - len(value)] + new, m.end())
        ends = [m.end()]
        if kind == "card":
            ends = [end] if (end := _card_end(text, start)) else []
        elif kind == "iban":
            ends = [start + x for x in _iban_end(s)]
        for end in ends:
            if (new := _MAKERS[kind](key, text[start:end])) is not None:
                return new, end
        return None

    out, done, at = [], 0, 0
    while m := _PATTERN.search(text, at):
        start = m.start()
        kind = next(k for k in KINDS if m.group(k) is not None)
        new = swap(kind, m)
        for other in KINDS[KINDS.index(kind) + 1 :] if new is None else ():
            if (m2 := _EACH[other].match(text, start)) and (new := swap(other, m2)):
                kind = other
                break
        if new is None:
            # what fails may begin with something else, or hold it: go on after its first group
            first = _FIRST.match(text, start)
            at = first.end() if first else start + 1
            continue
        counts[kind] = counts.get(kind, 0) + 1
        out += [text[done:start], new[0]]
        done = at = new[1]
    return "".join([*out, text[done:]]), counts


def pseudonymise_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: bytes = KEY) -> DataFrame:
    """One row per document: `id_col`, text (null stays null), n_found and a count n_<kind> for each kind.

    Mail addresses (their domain stays), labelled secrets and keys known by their first letters, IBANs, IPv4 addresses, dates, social security numbers, phone numbers and card
    numbers are found by pattern; those with a checksum or a calendar are checked. Where a match fails, shorter spans of
    its digit groups and what begins after its first group are tried; what fails them all stays. Each is
    replaced by a keyed permutation among the values of its own format, with its checksum made anew, so a pseudonym is
    valid and equal values, wherever they stand, have equal pseudonyms. One pass without a shuffle.

    Rows that repeat an id stay apart. Empty and null texts have nothing found. A very long text is scanned whole by one
    task. Extra columns do not matter.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found = [], []
            for t in batch.column("text"):
                t = t.as_py()  # noqa: PLW2901
                new, counts = (None, {}) if t is None else pseudonymise(t, key)
                texts.append(new)
                found.append([sum(counts.values()), *(counts.get(k, 0) for k in KINDS)])
            cols = [pa.array(c, pa.int64()) for c in zip(*found)] if found else [pa.array([], pa.int64())] * (len(KINDS) + 1)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string()), *cols], names)

    names = [id_col, "text", "n_found", *(f"n_{k}" for k in KINDS)]
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = ", ".join([f"`{id_col}` {src.schema['id'].dataType.simpleString()}", "text string", *(f"{n} long" for n in names[2:])])
    return src.mapInArrow(run, schema)
