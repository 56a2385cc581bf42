"""Personal data: base patterns, and spans found behind disguises.

A cascade of transducers rewrites a text (look-alike characters, spelled digits,
at/dot disguises). Each keeps, for every character it puts out, the source
characters it came from, so that a span found in the rewritten text is reported in
the characters of the original.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from pricegrid.llm.common import texts

KINDS = ("email", "ip", "card", "phone")
FOUND = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
    "base_sha256 string, spans string, n_added long"
)

# The patterns are equal to the stated ones in what they match; a run of digits is
# taken whole (possessive), and an address is looked for from its @, so that long runs
# without an end take linear time.
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = ord(c) - 48
        if k % 2:
            v = 2 * v - 9 if v > 4 else 2 * v
        total += v
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: the run of name characters before an @, no further left than the last match."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _HOST.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", done)


def detect(text: str) -> list[tuple[int, int, str]]:
    """(kind number, start, end) of the base patterns, per kind leftmost and apart."""
    found = [(0, s, e) for s, e in _emails(text)] if "@" in text else []
    if _DIGIT.search(text) is None:
        return found
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()):
            found.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and _luhn(digits):
            found.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c in "0123456789" for c in m[0]) <= 15:
                found.append((3, m.start(), m.end()))
    return found


# Characters that look like ASCII ones, by block.
HOMOGLYPHS = {
    **{chr(0xFF01 + k): chr(0x21 + k) for k in range(94)},  # full-width forms
    **{chr(base + k): str(k) for base in (0x0660, 0x06F0, 0x0966) for k in range(10)},
    **{chr(0x1D7CE + k): str(k % 10) for k in range(50)},  # mathematical digits
    **{chr(0x2080 + k): str(k) for k in range(10)},
    **{chr(0x2070 + k): str(k) for k in (0, 4, 5, 6, 7, 8, 9)},
    **dict(zip("АВЕКМНОРСТУХІЈЅаеорсухіјѕԁһ", "ABEKMHOPCTYXIJSaeopcyxijsdh")),
    **dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧονρ", "ABEZHIKMNOPTYXovp")),
    **dict.fromkeys("‐‑‒–—−", "-"),
    **dict.fromkeys("    ", " "),
    **dict.fromkeys("․。", "."),
    **dict.fromkeys("​‌‍⁠﻿­", ""),
}
SPELLED = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4",
    "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
}

_LOOKALIKE = re.compile("[" + "".join(map(re.escape, HOMOGLYPHS)) + "]")
_NUMBER = "|".join(w for w in SPELLED)
# Spelled digits count where two stand next to each other, or one stands by a digit.
_SPOKEN = re.compile(
    rf"(?i)(?<![A-Za-z0-9])(?:(?:plus[ -])?(?:{_NUMBER}|[0-9]+)(?:[ ,-]{{1,2}}|(?: dot | point |\.))){{2,}}"
    rf"(?:{_NUMBER}|[0-9]+)(?![A-Za-z0-9])"
)
_SPOKEN_PART = re.compile(
    rf"(?i)(?P<plus>plus[ -])|(?P<word>{_NUMBER})|(?P<digits>[0-9]+)|(?P<dot> (?:dot|point) )|(?P<gap>[ ,.-]{{1,2}})"
)
_SPOKEN_HINT = re.compile(rf"(?i)(?<![A-Za-z])(?:{_NUMBER})[ ,.-]{{1,2}}(?:dot |point )?(?:{_NUMBER}|[0-9])")

_LABEL = r"[A-Za-z0-9][A-Za-z0-9_%+-]*"
_LABEL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_%+-")
_DOT_MARK = r"(?:\s?[\[({<]\s?(?:(?i:dot)|\.)\s?[\])}>]\s?)"
_DOT_WORD = "(?: (?i:dot) )"
_DOT_REACH = 9  # the longest of these separators
# All places where a mark may begin, overlapping ones too. A bare "at" or "dot" counts
# only together with the other; bracketed ones by themselves.
_AT = re.compile(r"(?=(?P<mark>\s?[\[({<]\s?(?:(?i:at)|@)\s?[\])}>]\s?|@)|(?P<bare> (?i:at) ))")
_HOSTS = {
    "mark": re.compile(rf"{_LABEL}(?:(?:\.|{_DOT_MARK}|{_DOT_WORD}){_LABEL})+"),
    "bare": re.compile(rf"{_LABEL}(?:(?:{_DOT_MARK}|{_DOT_WORD}){_LABEL})+"),
}
_DOT_BEFORE = re.compile(rf"(?:\.|{_DOT_MARK}|{_DOT_WORD})\Z")
_AT_HINT = re.compile(r"(?i)[\[({<]\s?(?:at|@|dot|\.)\s?[\])}>]| dot ")
_DOT_PART = re.compile(rf"{_DOT_MARK}|{_DOT_WORD}")


Edit = tuple[int, int, str]


def lookalikes(text: str) -> list[Edit]:
    """Homoglyphs to ASCII, invisible characters away."""
    if text.isascii():
        return []
    return [(m.start(), m.end(), HOMOGLYPHS[m[0]]) for m in _LOOKALIKE.finditer(text)]


def spoken_digits(text: str) -> list[Edit]:
    """Runs of spelled digits ("four one, one") to digits."""
    if _SPOKEN_HINT.search(text) is None:
        return []
    edits = []
    for run in _SPOKEN.finditer(text):
        parts = list(_SPOKEN_PART.finditer(text, run.start(), run.end()))
        kinds = [m.lastgroup for m in parts]
        for k, (m, kind) in enumerate(zip(parts, kinds)):
            if kind == "word":
                edits.append((m.start(), m.end(), SPELLED[m[0].lower()]))
            elif kind == "plus":
                edits.append((m.start(), m.end(), "+"))
            elif kind == "dot":
                edits.append((m.start(), m.end(), "."))
            elif kind == "gap" and "word" in kinds[k - 1 : k + 2] and m[0] != ".":
                edits.append((m.start(), m.end(), ""))
    return edits


def _name_start(text: str, end: int, limit: int) -> int | None:
    """Where the name begins that ends at ``end``: labels and dots, to the left as far as they go."""
    start = None
    while True:
        at = end
        while at > 0 and text[at - 1] in _LABEL_CHARS:
            at -= 1
        if at == end or at < limit or text[at] in "_%+-":
            return start
        start = at
        dot = _DOT_BEFORE.search(text[max(limit, at - _DOT_REACH) : at])
        if dot is None:
            return start
        end = at - (dot.end() - dot.start())


def at_and_dot(text: str) -> list[Edit]:
    """``name (at) host dot tld`` to ``name@host.tld``.

    Starts from the mark and goes to both sides, so names and hosts may have any length
    and any number of labels, and a text takes time in proportion to its length.
    """
    if _AT_HINT.search(text) is None:
        return []
    edits, limit = [], 0
    for m in _AT.finditer(text):
        kind = "mark" if m["mark"] is not None else "bare"
        begin, end = m.span(kind)
        if begin <= limit or text[begin - 1] not in _LABEL_CHARS:
            continue
        host = _HOSTS[kind].match(text, end)
        start = _name_start(text, begin, limit) if host else None
        if start is None:
            continue
        edits += [(d.start(), d.end(), ".") for d in _DOT_PART.finditer(text, start, begin)]
        if m[kind] != "@":
            edits.append((begin, end, "@"))
        edits += [(d.start(), d.end(), ".") for d in _DOT_PART.finditer(text, end, host.end())]
        limit = host.end()
    return edits


TRANSDUCERS = (lookalikes, spoken_digits, at_and_dot)


class Rewritten:
    """A text after edits, and the way from its offsets back to the source's."""

    def __init__(self, text: str, edits: list[Edit]):
        out, self.at, self.edits, size, done = [], [], edits, 0, 0
        for start, end, new in edits:
            out += (text[done:start], new)
            size += start - done
            self.at.append((size, size + len(new)))  # where the edit stands in the new text
            size += len(new)
            done = end
        out.append(text[done:])
        self.text = "".join(out)
        self._ends = [e for _, e in self.at]

    def source(self, start: int, end: int) -> tuple[int, int]:
        """Source span of a span of the new text; an edit that it touches comes in whole."""
        return self._left(start), self._right(end)

    def _left(self, at: int) -> int:
        k = bisect_left(self._ends, at + 1)  # first edit that ends after this place
        if k < len(self.at) and self.at[k][0] <= at:
            return self.edits[k][0]
        return at + (self.edits[k - 1][1] - self.at[k - 1][1] if k else 0)

    def _right(self, at: int) -> int:
        k = bisect_left(self._ends, at)  # first edit that ends at this place or after it
        if k < len(self.at) and self.at[k][0] < at:
            return self.edits[k][1]
        return at + (self.edits[k - 1][1] - self.at[k - 1][1] if k else 0)


def find(text: str) -> tuple[list, list]:
    """Base spans, and spans only found after rewriting, as (kind number, start, end)."""
    base = detect(text)
    steps, now = [], text
    for transducer in TRANSDUCERS:
        if edits := transducer(now):
            steps.append(Rewritten(now, edits))
            now = steps[-1].text
    if not steps:
        return base, []
    known = {}
    for kind, s, e in base:
        known.setdefault(kind, []).append((s, e))
    for spans in known.values():
        spans.sort()
    added = set()
    for kind, s, e in detect(now):
        for step in reversed(steps):
            s, e = step.source(s, e)
        spans = known.get(kind, [])
        k = bisect_left(spans, (s + 1,)) - 1
        inside = k >= 0 and spans[k][1] >= e
        if not inside:
            added.add((kind, s, e))
    return base, sorted(added)


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted((s, k, e) for k, s, e in spans))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, digests, joined, extra = ([], [], [], []), [], [], []
        for text in batch["text"].to_pylist():
            base, added = find(text)
            for k in range(4):
                counts[k].append(sum(x[0] == k for x in base))
            digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
            joined.append(_joined([*base, *added]))
            extra.append(len(added))
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()),
             pa.array(joined, pa.string()), pa.array(extra, pa.int64())],
            names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"],
        )


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Spans of personal data of every document, in code points of its own text.

    One row per row of ``docs``, repeated rows included; no shuffle. ``base_sha256``
    covers the base spans; ``spans`` has those and the ones found behind a disguise.
    Null or empty text: no spans. Null doc_id: kept as null. Other columns are
    ignored. A text of any length is scanned whole.
    """
    return texts(docs).mapInArrow(_scan, FOUND)
