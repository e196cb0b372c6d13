"""Format-preserving pseudonyms for personal data by a keyed Feistel permutation.

A value is validated, ranked within its format (all card numbers with a right check digit, all
calendar dates of two centuries, ...), the rank is permuted by a balanced Feistel network with
cycle walking, and the new rank is written in the same format. Equal values get equal pseudonyms in
every document, different ones stay different, and who holds the key can undo it.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from bisect import bisect
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import annotate

ROUNDS = 8
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()
LOWER, UPPER, DIGIT = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"

_DIGITS = re.compile(r"[+(]?\d")
_NUMBER = re.compile(r"""
   (?P<ip>\d{1,3}(?:\.\d{1,3}){3})(?![\w]|\.\d)
 | (?P<ymd>\d{4}(?P<s1>[-/.])\d{1,2}(?P=s1)\d{1,2})(?:(?=T\d)|(?!\w|[-/.]\d))
 | (?P<dmy>\d{1,2}(?P<s2>[-/.])\d{1,2}(?P=s2)\d{4})(?:(?=T\d)|(?!\w|[-/.]\d))
 | (?P<ssn>\d{3}-\d{2}-\d{4})(?![\w]|-\d)
 | (?P<nanp>(?:\+1[ .-]?)?\(?[2-9]\d\d\)?[ .-]\d{3}[ .-]\d{4})(?![\w]|-\d)
 | (?P<phone>\+\d{1,3}(?:(?!DATE)[ .-]?\(?\d{1,4}\)?){2,5})(?!\w)
""".replace("DATE", r"[ ](?:\d{4}[-/.]\d{1,2}[-/.]\d{1,2}|\d{1,2}[-/.]\d{1,2}[-/.]\d{4})(?!\d)"), re.X | re.A)
#: Shapes of card numbers, from the shortest on. None holds another one but at its own beginning; a last group that
#: begins a date or another hyphenated number is none, and the longest shape ends a row of groups.
_CARDS = [re.compile(r"\d{%s}(?!\w|-\d\d?-\d%s)" % (r"}[ -]\d{".join(groups), r"|[ -]\d" if len(groups) == 5 else ""), re.A)
          for groups in (("13,19",), ("4", "4", "5"), ("4", "6", "4"), ("4", "6", "5"), ("4",) * 4, ("4", "4", "4", "4", "3"))]
_EMAIL = re.compile(r"(?<![\w.%+-])[\w.%+-]+@[\w-]+(?:\.[\w-]+)*\.[A-Za-z]{2,}", re.A)
_IBAN = re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30}\b", re.A)
_KEYED = re.compile(r"""\b(?:password|passwd|pwd|token|secret|api[_-]?key)\b["']?\s*[=:]\s*["']?([A-Za-z0-9_\-+/]{8,})""",
                    re.I | re.A)
_ACCESS = re.compile(r"\bAKIA[0-9A-Z]{16}\b", re.A)


class Feistel:
    """A keyed permutation of 0..size-1 for any size, different for each format."""

    def __init__(self, key: bytes):
        self.key = key

    def _rounds(self, x: int, half: int, tweak: bytes, order) -> int:
        mask = (1 << half) - 1
        left, right = x >> half, x & mask
        for r in order:
            data = b"%d|%d|%d|" % (r, half, right) + tweak
            f = int.from_bytes(hashlib.shake_128(self.key + b"|" + data).digest((half + 7) // 8), "big") & mask
            left, right = right, left ^ f
        return right << half | left  # halves swapped, so that the reversed rounds undo it

    def permute(self, x: int, size: int, tweak: str, back: bool = False) -> int:
        half = max(1, ((size - 1).bit_length() + 1) // 2)
        order = range(ROUNDS - 1, -1, -1) if back else range(ROUNDS)
        while True:  # walks the cycle back into the domain
            x = self._rounds(x, half, tweak.encode(), order)
            if x < size:
                return x


def luhn(digits: str) -> int:
    """The sum that is a multiple of ten for a valid number."""
    odd = [int(c) for c in digits[::-1]]
    return sum(odd[0::2]) + sum(sum(divmod(2 * d, 10)) for d in odd[1::2])


def _is_card(text: str) -> bool:
    d = "".join(c for c in text if c.isdigit())
    return 13 <= len(d) <= 19 and d[0] in "23456" and luhn(d) % 10 == 0


def _pour(shape: str, chars: str) -> str:
    """``chars`` written over the ASCII letters and digits of ``shape``."""
    it = iter(chars)
    return "".join(next(it) if c.isascii() and c.isalnum() else c for c in shape)


class Pseudonyms:
    """Finds validated values of each kind and gives their pseudonyms, or with ``back`` the originals."""

    def __init__(self, key: bytes, back: bool = False):
        self.feistel, self.back = Feistel(key), back
        self.known = lru_cache(200_000)(self._replace)

    def _turn(self, x: int, size: int, kind: str) -> int:
        return self.feistel.permute(x, size, kind, self.back)

    def _spelled(self, text: str, kind: str, fold: bool = False) -> str:
        """Letters stay letters of their case and digits digits, place by place; other characters stay."""
        own = [c for c in text if c.isascii() and c.isalnum()]
        sets = [DIGIT if c.isdigit() else LOWER if c.islower() or fold else UPPER for c in own]
        rank, size = 0, 1
        for c, s in zip(own, sets):
            rank, size = rank * len(s) + s.index(c.lower() if fold else c), size * len(s)
        rank = self._turn(rank, size, kind + "|" + "".join(s[0] for s in sets))
        out = []
        for c, s in zip(reversed(own), reversed(sets)):
            rank, i = divmod(rank, len(s))
            out.append(s[i].upper() if fold and c.isupper() else s[i])
        return _pour(text, "".join(reversed(out)))

    def _replace(self, kind: str, text: str) -> str | None:
        """The value in another guise; None if it is not valid."""
        digits = "".join(c for c in text if c.isdigit())
        if kind == "ip":
            parts = [int(x) for x in text.split(".")]
            usual = lambda p: 1 <= p[0] <= 223 and p[0] != 127
            if max(parts) > 255 or any(len(x) > 1 and x[0] == "0" for x in text.split(".")):
                return None
            x = int.from_bytes(bytes(parts), "big")
            while True:
                x = self._turn(x, 1 << 32, "ip")
                if usual(x.to_bytes(4, "big")) == usual(parts):  # the others are a class of their own
                    return ".".join(map(str, x.to_bytes(4, "big")))
        if kind in ("ymd", "dmy"):
            return self._date(kind, text)
        if kind == "ssn":
            a, b, c = int(digits[:3]), int(digits[3:5]), int(digits[5:])
            if a in (0, 666) or a >= 900 or not b or not c:
                return None
            x = self._turn(((a - 1 - (a > 666)) * 99 + b - 1) * 9999 + c - 1, 898 * 99 * 9999, "ssn")
            x, c = divmod(x, 9999)
            a, b = divmod(x, 99)
            return f"{a + 1 + (a >= 665):03d}-{b + 1:02d}-{c + 1:04d}"
        if kind == "nanp":
            own = digits[-10:]
            if len(digits) == 11 and digits[0] != "1" or text.count("(") != text.count(")"):
                return None
            strict = lambda d: d[0] > "1" and d[3] > "1"
            if not strict(own):
                if len(digits) == 10 or own[0] == "1":
                    return None
                while True:  # country code 1 outside the plan's ranges is a class of its own
                    own = f"{self._turn(int(own), 10 ** 10, 'odd1'):010d}"
                    if not strict(own) and own[0] != "1":
                        return _pour(text, "1" + own)
            x = self._turn(((int(own[:3]) - 200) * 800 + int(own[3:6]) - 200) * 10_000 + int(own[6:]), 6_400_000_000, "nanp")
            x, line = divmod(x, 10_000)
            area, office = divmod(x, 800)
            return _pour(text, digits[:-10] + f"{area + 200:03d}{office + 200:03d}{line:04d}")
        if kind == "phone":
            if digits[0] == "1":  # country code 1 has the shape above
                return self._replace("nanp", text) if len(digits) == 11 else None
            if not 8 <= len(digits) <= 15 or digits[0] == "0" or text.count("(") != text.count(")"):
                return None
            rest = digits[2:]
            return _pour(text, digits[:2] + f"{self._turn(int(rest), 10 ** len(rest), 'phone%d' % len(rest)):0{len(rest)}d}")
        if kind == "card":
            if not _is_card(digits):
                return None
            n = len(digits) - 2
            body = digits[0] + f"{self._turn(int(digits[1:-1]), 10 ** n, 'card%d' % n):0{n}d}"
            return _pour(text, body + str(-luhn(body + "0") % 10))
        if kind == "iban":
            own = text.replace(" ", "")
            number = lambda s: int("".join(str(int(c, 36)) for c in s))
            if number(own[4:] + own[:4]) % 97 != 1:
                return None
            body = self._spelled(own[4:], "iban" + own[:2])
            return _pour(text, own[:2] + f"{98 - number(body + own[:2] + '00') % 97:02d}" + body)
        if kind == "email":
            stem, dot, top = text.rpartition(".")
            return self._spelled(stem, "email", True) + dot + top
        return ("AKIA" + self._spelled(text[4:], "access")) if kind == "access" else self._spelled(text, "secret")

    def _date(self, kind: str, text: str) -> str | None:
        sep = re.search(r"[-/.]", text)[0]
        parts = text.split(sep)
        y, m, d = (parts[0], parts[1], parts[2]) if kind == "ymd" else (parts[2], parts[1], parts[0])
        swapped = kind == "dmy" and int(m) > 12
        if swapped:
            m, d = d, m
        try:
            day = datetime.date(int(y), int(m), int(d)).toordinal()
        except ValueError:
            return None
        if not FIRST_DAY <= day <= LAST_DAY:
            return None
        size = LAST_DAY - FIRST_DAY + 1
        padded = len(m) == 2 and len(d) == 2
        x = day - FIRST_DAY
        while True:
            x = self._turn(x, size, "date")
            new = datetime.date.fromordinal(FIRST_DAY + x)
            # A month-first date shows by a day over 12, an unpadded one by one digit; so must the pseudonym.
            if (not swapped or new.day > 12) and (padded or new.month < 10 or new.day < 10):
                break
        show = (lambda n: f"{n:02d}") if padded else str
        new_parts = [str(new.year), show(new.month), show(new.day)]
        if kind == "ymd":
            return sep.join(new_parts)
        return sep.join([new_parts[1], new_parts[2], new_parts[0]] if swapped else [new_parts[2], new_parts[1], new_parts[0]])

    def _card(self, text: str, start: int, failed: list[tuple[int, int]]) -> tuple[int, str] | None:
        """(end, new) of the card number that begins at ``start``; spans that are none join ``failed``.

        The shapes of a card are tried from the shortest on. A pseudonym is walked on until neither a
        shorter shape of the number nor a failed span that reaches into it has become valid, so the
        same numbers are found in the new text, whatever else stands there.
        """
        for shape in _CARDS:
            m = shape.match(text, start)
            if not m:
                continue
            end, new = m.end(), self.known("card", m[0])
            if new is None:
                failed.append((start, end))
                continue
            reach = [(a, b) for a, b in failed if b > start]
            while any(_is_card(text[a:start] + new[:b - start]) for a, b in reach):
                new = self.known("card", new)
            return end, new
        return None

    def _spans(self, text: str):
        """(start, end, kind, replacement if known) of candidates; where two overlap the first kind listed here stands."""
        if "@" in text:
            for m in _EMAIL.finditer(text):
                yield m.start(), m.end(), "email", None
        if "AKIA" in text:
            for m in _ACCESS.finditer(text):
                yield m.start(), m.end(), "access", None
        if "=" in text or ":" in text:
            for m in _KEYED.finditer(text):
                yield m.start(1), m.end(1), "secret", None
        for m in _IBAN.finditer(text):
            if self.known("iban", m[0]) is not None:
                yield m.start(), m.end(), "iban", None
                text = text[:m.start()] + "_" * len(m[0]) + text[m.end():]
        at, failed = 0, []
        while m := _DIGITS.search(text, at):
            start = m.start()
            at = m.end()
            if start and (text[start - 1].isalnum() or text[start - 1] in "_@"):
                while at < len(text) and text[at].isdigit():
                    at += 1
                continue
            failed = [f for f in failed[-8:] if f[1] > start]
            n = _NUMBER.match(text, start)
            kind = n and (n.lastgroup if n.lastgroup not in ("s1", "s2") else "ymd" if n["ymd"] else "dmy")
            # A candidate that does not validate may have taken in too much: its last groups go one by one.
            end = n.end() if n else start
            while end > start and self.known(kind, text[start:end]) is None:
                cut = re.search(r"[ .-]\(?\d+\)?$", text[start:end], re.A) if kind == "phone" else None
                end = start + cut.start() if cut else start
            if end > start:
                yield start, end, kind, None
                at = end
            elif card := self._card(text, start, failed):
                at = card[0]
                yield start, at, "card", card[1]
            else:
                while at < len(text) and text[at].isdigit():
                    at += 1

    def apply(self, text: str | None) -> tuple[str | None, list[dict]]:
        """The text with pseudonyms, and where in the original each value stood."""
        if not text:
            return text, []
        out, found, held = [], [], []  # ``held`` is sorted, and no two in it overlap
        for start, end, kind, new in self._spans(text):
            i = bisect(held, (start,))
            if (not i or held[i - 1][1] <= start) and (i == len(held) or held[i][0] >= end):
                new = self.known(kind, text[start:end]) if new is None else new
                if new is not None:
                    held.insert(i, (start, end, kind, new))
        at = 0
        for start, end, kind, new in held:
            out += [text[at:start], new]
            found.append({"kind": "date" if kind in ("ymd", "dmy") else "phone" if kind == "nanp" else kind,
                          "start": start, "length": end - start})
            at = end
        return "".join([*out, text[at:]]), found


def pseudonymize(df: DataFrame, key: bytes, text: str = "text", back: bool = False, keep: list[str] | None = None) -> DataFrame:
    """``df`` with ``text`` pseudonymised and ``found``, the (kind, start, length) of each value in the original.

    Kinds: email, phone, card (Luhn), ip (version 4), ssn, iban (mod 97), date, access (access keys) and
    secret (value after a password-like name). What does not validate stays as it is. A null text
    stays null, an empty one empty. ``back`` undoes it with the same key. All else is untouched.
    """
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("length", pa.int32())]))

    def setup():
        names = Pseudonyms(key, back)

        def run(texts):
            got = [names.apply(t) for t in texts]
            return pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], arrow)
        return run
    own = [c for c in (df.columns if keep is None else keep) if c != text]
    return annotate(df, text, setup, [(text, "string"), ("found", "array<struct<kind:string,start:int,length:int>>")], own)
