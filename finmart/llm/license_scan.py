"""Licence scans: lines, paragraphs and whole texts against templates by Dice over word bigrams.

Texts and templates are normalised alike: A-Z in lower case, ASCII marks as spaces. With bigram
sets A and B, Dice is 2 |A and B| / (|A| + |B|); as the intersection is no larger than the
smaller set, a unit of a bigrams can only reach t with templates of between a t / (2 - t) and
a (2 - t) / t bigrams. Most lines of a corpus are ruled out by that bound and a first look.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from finmart.llm.license_templates import BODIES, NOTICES, TEMPLATES
from finmart.llm.tables import long_id

#: Least Dice coefficient of a match, and least bigrams of a unit and a template.
DICE = 0.9
LEAST_BIGRAMS = 4
#: Least bigrams of a paragraph of a whole licence text, so that its headings are no templates; up
#: to NOTICE bigrams a template is a notice, all of whose marks a unit has to carry.
PARAGRAPH = 16
NOTICE = 150
#: Characters of a unit: letters and digits in lower case, other scripts as they are.
_FOLD = bytes(b if b >= 0x80 or b == 0x0A or chr(b).isdigit() else ord(chr(b).lower()) if chr(b).isalpha() else 0x20 for b in range(256))

MATCHES = "doc_id long, matches array<struct<licence:string,dice:double,first_line:int,lines:int>>"
_MATCH = pa.list_(pa.struct([("licence", pa.string()), ("dice", pa.float64()), ("first_line", pa.int32()), ("lines", pa.int32())]))


#: Words that tell sibling licences apart, and words that numbers of versions follow.
_FAMILY = {b"lesser", b"library", b"affero", b"mozilla", b"apache", b"nc", b"sa", b"nd", b"noncommercial", b"sharealike",
           b"noderivatives", b"clause", b"zero", b"cc0"}
_TERMS = {b"noncommercial", b"sharealike", b"noderivatives"}
_VERSION = _FAMILY - {b"library"} | {b"version", b"v", b"by", b"attribution", b"bsd"}


class Template(NamedTuple):
    size: int
    licence: str
    bigrams: frozenset
    marks: frozenset = frozenset()


def marks(pairs: set[tuple[bytes, bytes]] | frozenset) -> frozenset:
    """What has to agree between a text and its licence: family words, versions, later versions, and
    the clauses of siblings that differ by little else."""
    found: set = set()
    for a, b in pairs:
        found.update(_FAMILY & {a, b})
        if a in _VERSION and b.isdigit() and len(b) <= 2:
            found.add((a, b))
            if b == b"2" and (b, b"1") in pairs:
                found.add((a, b, b"1"))
        elif (a, b) in ((b"later", b"version"), (b"remote", b"network"), (b"neither", b"the"), (b"endorse", b"or")):
            found.add((a, b))
    return frozenset(found)


def bigrams(words: list[bytes]) -> set[tuple[bytes, bytes]]:
    return set(zip(words, words[1:]))


def normal_words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


def make_templates(texts: dict[str, str] = TEMPLATES, notices: dict[str, tuple[str, ...]] = NOTICES,
                   bodies: dict[str, str] = BODIES) -> list[Template]:
    """Whole texts, their paragraphs and the notices, by size; short ones are left out."""
    pieces = [(name, part) for name, text in texts.items() for part in (text, *text.split("\n\n"))]
    pieces += [(name, notice) for name, several in notices.items() for notice in several]
    found = {(name, frozenset(bigrams(normal_words(piece)))) for name, piece in pieces}
    for name, text in bodies.items():
        parts = [frozenset(bigrams(normal_words(part))) for part in (text, *re.split(r"\n\s*\n", text))]
        found.update((name, b) for b in parts if len(b) >= PARAGRAPH)
    return sorted((Template(len(b), name, b) for name, b in found if len(b) >= LEAST_BIGRAMS), key=lambda t: (t.size, t.licence))


class LicenceScanner:
    def __init__(self, templates: list[Template], least: float = DICE):
        self.templates = sorted((t._replace(marks=marks(t.bigrams)) for t in templates), key=lambda t: (t.size, t.licence))
        self.least = least
        self.sizes = [t.size for t in self.templates]
        self.known = frozenset(word for t in self.templates for pair in t.bigrams for word in pair)
        self.pairs = frozenset(pair for t in self.templates for pair in t.bigrams)
        ratio = (2 - least) / least
        self.smallest = (min(self.sizes) / ratio) if self.sizes else float("inf")
        self.largest = (max(self.sizes) * ratio) if self.sizes else 0.0

    def best(self, words: list[bytes], agree: bool = False, first: str | None = None) -> tuple[str, float] | None:
        """Licence and Dice of the nearest template that reaches the threshold; ties by name, but
        ``first`` before others. With ``agree`` the marks have to agree too: none that the template
        lacks, and in notices all of the template's.
        """
        # words bound bigrams from above only: repeats shrink the set
        if len(words) - 1 < self.smallest:
            return None
        pairs = bigrams(words)
        a, t = len(pairs), self.least
        if a < LEAST_BIGRAMS or a > self.largest:
            return None
        # a match shares at least a t / (2 - t) bigrams with its template
        if len(pairs & self.pairs) < a * t / (2 - t) - 1e-9:
            return None
        low = bisect_left(self.sizes, a * t / (2 - t) - 1e-9)
        high = bisect_right(self.sizes, a * (2 - t) / t + 1e-9)
        found, own = None, None
        for template in self.templates[low:high]:
            dice = 2 * len(pairs & template.bigrams) / (a + template.size)
            if dice < t:
                continue
            if agree:
                own = marks(pairs) if own is None else own
                needed = template.marks if template.size <= NOTICE else template.marks & _TERMS
                if not needed <= own <= template.marks:
                    continue
            key = (-dice, template.licence != first, template.licence)
            if found is None or key < found:
                found = key
        return found and (found[2], -found[0])

    def scan(self, raw: bytes | None) -> list[tuple[str, float, int, int]]:
        """(licence, dice, first line, lines) of matching units.

        Inside a match, smaller units are reported only if they name another licence.
        """
        if not raw or not self.templates:
            return []
        lines = [line.split() for line in raw.translate(_FOLD).split(b"\n")]
        found: list[tuple[str, float, int, int]] = []
        covered: list[str | None] = [None] * len(lines)

        def look(first: int, stop: int) -> None:
            words = lines[first] if stop == first + 1 else [w for line in lines[first:stop] for w in line]
            hit = self.best(words, True, covered[first])
            if hit and covered[first] != hit[0]:
                found.append((*hit, first, stop - first))
                covered[first:stop] = [hit[0]] * (stop - first)

        # whole text, then paragraphs of several lines, then lines
        if len(lines) > 1:
            look(0, len(lines))
        first = 0
        for i in range(len(lines) + 1):
            if i == len(lines) or not lines[i]:
                if i - first > 1 and not (first == 0 and i == len(lines)):
                    look(first, i)
                first = i + 1
        for i, words in enumerate(lines):
            # a match shares most words with a template, so one of any ten neighbours is known
            if len(words) > LEAST_BIGRAMS and not self.known.isdisjoint(words):
                look(i, i + 1)
        return sorted(found, key=lambda m: (m[2], -m[3], m[0]))


def _scan(scanner: LicenceScanner):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("licence", "dice", "first_line", "lines")
        for batch in batches:
            found = [[dict(zip(names, m)) for m in scanner.scan(t.as_py())] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, _MATCH)], names=["doc_id", "matches"])

    return run


def licence_matches(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    templates: list[Template] | None = None, least: float = DICE) -> DataFrame:
    """``(doc_id, matches)`` for every row of ``docs``: every matching unit with its span of lines.

    A NULL, empty or wordless text has no matches. NULL ids and repeated rows are scanned like
    others; other columns are not read.
    """
    scanner = LicenceScanner(make_templates() if templates is None else templates, least)
    return docs.select(
        long_id(F.col(doc_id)).alias("doc_id"), F.col(text).cast("string").cast("binary").alias("text")
    ).mapInArrow(_scan(scanner), MATCHES)


def licence_report(matches: DataFrame) -> DataFrame:
    """One row per document: number of matches, the best one (highest Dice, then name) and all names."""
    best = F.array_min(F.transform("matches", lambda m: F.struct((-m["dice"]).alias("d"), m["licence"].alias("l"))))
    return matches.select(
        "doc_id", F.size("matches").cast("long").alias("n_matches"), best["l"].alias("licence"),
        (-best["d"]).alias("dice"), F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["licence"]))).alias("licences"))
