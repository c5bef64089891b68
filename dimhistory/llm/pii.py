"""Personal data in texts, also where it is disguised, by offsets into the source.

Detectors find mail addresses, IP addresses, card numbers and phone numbers in a text as it is. Then
transducers rewrite disguises: look-alike and invisible characters, spelled digits, and
words for @ and dot. Each carries, for every character it writes, the span of the source it came
from, so that the same detectors run on the rewritten text and their spans map back. What they find
there is added unless it overlaps a span of its kind that it doesn't extend.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from itertools import islice, takewhile

from pyspark.sql import DataFrame

from dimhistory.llm.frames import map_texts

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int]

# -- detectors ---------------------------------------------------------------------------

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# A start inside a run of digits can only fail as the run's own start did, hence the lookbehind.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGITS = re.compile(r"[^0-9]+")


def emails(text: str) -> Iterator[Span]:
    """Leftmost matches, found from the @ outwards: each run of name characters is read once."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def ips(text: str) -> Iterator[Span]:
    for found in _IP.finditer(text):
        if all(len(part) <= 3 and int(part) <= 255 for part in (p.lstrip("0") or "0" for p in found.groups())):
            yield found.span()


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def cards(text: str) -> Iterator[Span]:
    for found in _CARD.finditer(text):
        digits = _NOT_DIGITS.sub("", found[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield found.span()


def phones(text: str) -> Iterator[Span]:
    if "+" not in text:
        return
    for found in _PHONE.finditer(text):
        if 9 <= len(_NOT_DIGITS.sub("", found[0])) <= 15:
            yield found.span()


DETECTORS: dict[str, Callable[[str], Iterator[Span]]] = dict(
    zip(KINDS, (emails, ips, cards, phones), strict=True)
)


def detect(text: str) -> dict[str, list[Span]]:
    return {kind: list(find(text)) for kind, find in DETECTORS.items()}


# -- transducers -------------------------------------------------------------------------


class Tape:
    """A rewritten text and, for each of its characters, the source span it stands for."""

    def __init__(self, text: str):
        self.text = text
        self.starts: list[int] | range = range(len(text))
        self.ends: list[int] | range = range(1, len(text) + 1)

    def rewrite(self, changes: list[tuple[int, int, str]]) -> Tape:
        """The tape with each ``text[start:end]`` replaced; ``changes`` are sorted and apart."""
        out, starts, ends, at = [], [], [], 0
        for start, end, new in changes:
            out += [self.text[at:start], new]
            starts += [*self.starts[at:start], *[self.starts[start]] * len(new)]
            ends += [*self.ends[at:start], *[self.ends[end - 1]] * len(new)]
            at = end
        tape = Tape("".join([*out, self.text[at:]]))
        tape.starts = [*starts, *self.starts[at:]]
        tape.ends = [*ends, *self.ends[at:]]
        return tape

    def source(self, span: Span) -> Span:
        return self.starts[span[0]], self.ends[span[1] - 1]


#: Letters that look like Latin ones, in Cyrillic, Greek and a few more; fixed values.
LOOKALIKES = dict(
    zip(
        "АВЕЅІЈКМНОРСТУХаеѕіјкорсухԁԛԝһһӏΑΒΕΖΗΙΚΜΝΟΡΤΥΧαικνορυχϲϳıɡɑⅼⅰⅽⅾⅿ",
        "ABESIJKMHOPCTYXaesijkopcyxdqwhhlABEZHIKMNOPTYXaiknopuxcjigalicdm",
        strict=True,
    )
)
_INVISIBLE = "­͏؜᠎​‌‍‎‏⁠⁡⁢⁣﻿"
_DASHES = "‐‑‒–—―−﹘﹣"
_DOTS = "․。﹒｡·∙⋅"
_BLANKS = "              　"
_ODD = re.compile(r"[^\x00-\x7f]")


def _plain(c: str) -> str | None:
    """What a character beyond ASCII is to be read as; None if it is itself."""
    if c in LOOKALIKES:
        return LOOKALIKES[c]
    if c in _INVISIBLE:
        return ""
    if c in _DASHES:
        return "-"
    if c in _DOTS:
        return "."
    if c in _BLANKS:
        return " "
    digit = unicodedata.digit(c, None)
    if digit is not None:
        return str(digit)
    wide = unicodedata.normalize("NFKC", c)
    if len(wide) == 1 and wide != c and "!" <= wide <= "~":
        return wide
    return None


class _Characters(dict):
    def __missing__(self, c: str) -> str | None:
        self[c] = value = _plain(c)
        return value


_CHARACTERS = _Characters()


def characters(tape: Tape) -> Tape:
    """Look-alikes, wide forms, other digits, dashes, dots and blanks as ASCII; invisible ones go."""
    changes = []
    for found in _ODD.finditer(tape.text):
        new = _CHARACTERS[found[0]]
        if new is not None:
            changes.append((found.start(), found.end(), new))
    return tape.rewrite(changes) if changes else tape


#: Digits as words in four languages, and the words around them; fixed values.
DIGIT_WORDS = (
    {w: str(i) for i, w in enumerate("zero one two three four five six seven eight nine".split())}
    | {w: str(i) for i, w in enumerate("null eins zwei drei vier fünf sechs sieben acht neun".split())}
    | {w: str(i) for i, w in enumerate("zéro un deux trois quatre cinq six sept huit neuf".split())}
    | {w: str(i) for i, w in enumerate("cero uno dos tres cuatro cinco seis siete ocho nueve".split())}
    | {"oh": "0", "nought": "0", "zwo": "2", "fuenf": "5", "une": "1"}
)
MARK_WORDS = {"plus": "+", "mas": "+", "más": "+", "dot": ".", "point": ".", "punkt": ".", "punto": "."}
MARK_WORDS |= {"dash": "-", "hyphen": "-", "strich": "-", "tiret": "-", "guion": "-"}
REPEAT_WORDS = {"double": 2, "triple": 3, "doppel": 2}
_SPOKEN = re.compile(
    r"(?<![^\W_])(?:" + "|".join(sorted([*DIGIT_WORDS], key=len, reverse=True)) + r")(?![^\W_])", re.I
)
_LEADS = frozenset("+().0123456789 \t-")
_LEAD_WORD = re.compile(r"(?<![^\W_])(?:plus|m[aá]s|double|triple|doppel)\Z", re.I)
#: A full stop before a blank ends a sentence, and with it a run of digits.
_PIECE = re.compile(
    r"(?P<word>[^\W\d_]+)|(?P<digits>[0-9]+)|(?P<plus>\+)|(?P<mark>[()-]|\.(?!\s))|(?P<blank>[ \t,/_]+)|(?P<end>.)",
    re.S,
)


def spelled_digits(tape: Tape) -> Tape:
    """Runs of at least four digits, some of them spelled, as digits.

    Spelled digits next to each other join; a blank beside written digits stays one blank. A
    single spelled digit counts if a detector finds it in the rewritten run, and if it is not
    just a word before or after something that is found without it.
    """
    if not _SPOKEN.search(tape.text):
        return tape
    changes: list[tuple[int, int, str]] = []
    text, at = tape.text, 0
    for first in _SPOKEN.finditer(text):
        if first.start() < at:
            continue
        start = _lead(text, at, first.start())
        end, new = _run(text, start)
        if new is not None:
            changes.append((start, end, new))
            at = end
    return tape.rewrite(changes) if changes else tape


def _lead(text: str, least: int, start: int) -> int:
    """Where the run of digits that the word at ``start`` belongs to begins, however long it is.

    The characters before the word are read back to the last one that is no part of a number, so
    none is read for two words.
    """
    low = start
    while low > least and text[low - 1] in _LEADS:
        low -= 1
    if low < start and text[low] in " \t":
        word = _LEAD_WORD.search(text, max(least, low - 6), low)
        if word:
            return word.start()
    first = next((i for i in range(low, start) if text[i] in "+(" or text[i].isdigit()), start)
    if first < start and first > 0 and text[first - 1].isalnum():
        return start
    return first


def _run(text: str, start: int) -> tuple[int, str | None]:
    """The end of the run of digits from ``start`` and what it says, None if it is too short."""
    out: list[str] = []
    kinds: list[str] = []
    ends: list[int] = []
    times, gap, spoken, digits, word = 1, False, 0, 0, 0
    for piece in _PIECE.finditer(text, start):
        kind, value = piece.lastgroup, piece[0]
        if kind == "word":
            low = value.lower()
            if low in DIGIT_WORDS:
                new, kind = DIGIT_WORDS[low] * times, "spoken"
                times, spoken, digits = 1, spoken + 1, digits + 1
            elif low in MARK_WORDS:
                new, kind = MARK_WORDS[low], "mark"
            elif low in REPEAT_WORDS:
                times = REPEAT_WORDS[low]
                continue
            else:
                break
        elif kind == "digits":
            new, digits = value, digits + len(value)
        elif kind in ("plus", "mark"):
            new = value
        elif kind == "blank":
            gap = True
            continue
        else:
            break
        if gap and kinds and "mark" not in (kind, kinds[-1]) and not (kind == kinds[-1] == "spoken"):
            out.append(" ")
        if kind == "spoken" and spoken == 1:
            word = sum(map(len, out))
        out.append(new)
        kinds.append(kind)
        ends.append(piece.end())
        gap = False
    while kinds and kinds[-1] in ("mark", "plus"):
        kinds.pop(), ends.pop(), out.pop()
    if not kinds or not spoken or digits < 4:
        return start, None
    new = "".join(out)
    if spoken == 1:
        found = any(a <= word < b for find in (ips, cards, phones) for a, b in find(new))
        outside = "spoken" in (kinds[0], kinds[-1])
        if not found or (outside and any(any(find(text[start : ends[-1]])) for find in (ips, cards, phones))):
            return start, None
    return ends[-1], new


_OPEN, _CLOSE = r"[\[({<]", r"[\])}>]"
_AT = rf"\s*{_OPEN}\s*(?:at|@|arroba|arobase)\s*{_CLOSE}\s*|\s+(?:at|arroba|arobase)\s+|\s*@\s*"
_DOT = rf"\s*{_OPEN}\s*(?:dot|\.|punkt|punto|point)\s*{_CLOSE}\s*|\s+(?:dot|punkt|punto|point)\s+"
_HINT = re.compile(rf"{_OPEN}\s*(?:at|@|arroba|arobase|dot|\.|punkt|punto|point)\s*{_CLOSE}|\s(?:dot|punkt|punto|point)\s|\s@|@\s|\s(?:at|arroba|arobase)\s+[A-Za-z0-9-]++\.[A-Za-z]", re.I)
_NAME = r"[A-Za-z0-9_%+-]"
_CHAIN = re.compile(rf"(?<![A-Za-z0-9._%+-]){_NAME}++(?:(?:{_DOT}|\.){_NAME}++)*+", re.I)
_AT_HOST = re.compile(
    rf"(?P<at>{_AT})(?P<host>[A-Za-z0-9-]++(?:(?:{_DOT}|\.)[A-Za-z0-9-]++)++)", re.I
)
_DOT_RE = re.compile(_DOT, re.I)
_UNLIKE_PROSE = re.compile(r"[._0-9]")
_LAST_LABEL = re.compile(r"\.[A-Za-z]{2,}\Z")


_NUMBERS = re.compile(rf"(?<![0-9A-Za-z.])[0-9]++(?:(?:{_DOT}|\.)[0-9]++){{3}}(?![0-9A-Za-z])", re.I)
_NUMBER_HINT = re.compile(rf"[0-9]\s*{_OPEN}\s*(?:dot|\.|punkt|punto|point)\s*{_CLOSE}|[0-9]\s+(?:dot|punkt|punto|point)\s", re.I)


def dotted_numbers(tape: Tape) -> Tape:
    """IP addresses with words or brackets for some of their dots, as addresses."""
    if not _NUMBER_HINT.search(tape.text):
        return tape
    changes: list[tuple[int, int, str]] = []
    for found in _NUMBERS.finditer(tape.text):
        if any(ips(_DOT_RE.sub(".", found[0]))):
            changes += [
                (found.start() + m.start(), found.start() + m.end(), ".")
                for m in _DOT_RE.finditer(found[0])
            ]
    return tape.rewrite(changes) if changes else tape


#: Ends of hosts that are taken after a dot with blanks around it; fixed values.
_ENDS = "com|org|net|edu|gov|info|io|co|de|fr|es|uk|eu|at|ch|it|nl"
_SPACED = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{2,64}+(?P<at>[ \t]+@[ \t]+)"
    rf"(?P<host>[A-Za-z0-9-]{{2,63}}+(?:[ \t]*\.[ \t]*[A-Za-z0-9-]{{1,63}}+)*[ \t]+\.[ \t]+(?:{_ENDS}))"
    r"(?![A-Za-z0-9-])"
)
_SPACED_DOT = re.compile(r"[ \t]+\.[ \t]*|[ \t]*\.[ \t]+")


def spaced_addresses(tape: Tape) -> Tape:
    """Addresses with blanks around the @ and around the last dot of the host, which ends well known.

    Other words after a full stop with blanks around it begin a sentence; single letters around
    the @ are no name and no host.
    """
    if " . " not in tape.text.replace("\t", " ") or "@" not in tape.text:
        return tape
    changes: list[tuple[int, int, str]] = []
    for found in _SPACED.finditer(tape.text):
        base = found.start("host")
        changes.append((*found.span("at"), "@"))
        changes += [(base + m.start(), base + m.end(), ".") for m in _SPACED_DOT.finditer(found["host"])]
    return tape.rewrite(changes) if changes else tape


def _disguised(text: str) -> Iterator[tuple[int, re.Match]]:
    """Starts of names, and what follows them if it is a sign for @ and a host.

    A name that nothing follows is passed as a whole: what begins inside it ends where it does.
    """
    at = 0
    while name := _CHAIN.search(text, at):
        found = _AT_HOST.match(text, name.end())
        if found:
            yield name.start(), found
        at = found.end() if found else name.end()


def at_and_dot(tape: Tape) -> Tape:
    """Addresses with words or brackets for @ and dot, as addresses.

    A written @ with a blank after it counts if the host's last label is of letters; without
    that blank it may begin a person's handle. A bare word for @ only counts if a dot of the
    host is disguised as well, or if the last label is of letters and the name has a dot, digit
    or underscore, because prose is full of "at".
    """
    if not _HINT.search(tape.text):
        return tape
    changes: list[tuple[int, int, str]] = []
    for start, found in _disguised(tape.text):
        sign = found["at"]
        dots = [*_DOT_RE.finditer(found["host"])]
        if not any(c in sign for c in "[({<") and not dots:
            if not _LAST_LABEL.search(found["host"]):
                continue
            if "@" in sign:
                if "\n" in sign or not sign[-1].isspace():
                    continue
            elif not _UNLIKE_PROSE.search(tape.text, start, found.start()):
                continue
        base = found.start("host")
        changes += [
            (m.start() + start, m.end() + start, ".")
            for m in _DOT_RE.finditer(tape.text[start : found.start()])
        ]
        changes.append((*found.span("at"), "@"))
        changes += [(base + m.start(), base + m.end(), ".") for m in dots]
    return tape.rewrite(changes) if changes else tape


TRANSDUCERS = (characters, dotted_numbers, spelled_digits, spaced_addresses, at_and_dot)


def find(text: str) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
    """The spans of the text as it is, and those that only its rewritten form shows."""
    base = detect(text)
    tape = plain = Tape(text)
    for transduce in TRANSDUCERS:
        tape = transduce(tape)
    added: dict[str, list[Span]] = {kind: [] for kind in KINDS}
    if tape is plain:
        return base, added
    for kind, spans in detect(tape.text).items():
        taken, i = base[kind], 0
        for start, end in sorted(map(tape.source, spans)):
            while i < len(taken) and taken[i][1] <= start:
                i += 1
            met = [*takewhile(lambda s: s[0] < end, islice(taken, i, None))]
            more = (start, end) not in met and all(start <= a and b <= end for a, b in met)
            if more and not (added[kind] and added[kind][-1][1] > start):
                added[kind].append((start, end))
    return base, added


def find_personal_data(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, base, added)``: spans by kind and start, in code points, end exclusive.

    A null text counts as empty and has no spans; repeated rows stay; an empty table gives no
    rows; other columns are not read.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def make():
        def row(key, text):
            base, added = find(text or "")
            return key, *([{"kind": k, "start": s, "end": e} for k in KINDS for s, e in x[k]] for x in (base, added))

        return row

    spans = "array<struct<kind:string,start:int,end:int>>"
    return map_texts(df, [id_col, text_col], f"{id_col} {kind}, base {spans}, added {spans}", make)
