"""Personal information in free text: candidate spans, boosted trees, calibrated thresholds, placeholders.

High-recall generators propose spans that may overlap.  Each has features of format (shape, digits,
case, which generator) and of context (words and characters around it), words and shapes by their
log-odds in a bounded training sample.  Boosted trees, one model a kind, give calibrated
probabilities; spans above their kind's threshold are taken where they do not overlap, the most
probable first and the longer of equals.  There are no labels, so the sample is labelled by rules that
judge clear cases and leave the rest out, and by hard negatives: the shapes of phone and identity
numbers in the surroundings of numbers that are neither.  Odds, trees, calibration and thresholds each
see rows that the step before has not fitted.
"""

from __future__ import annotations

import json
import math
import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .boost import BoostedTrees, platt

KINDS = ("email", "phone", "identity_number", "address", "name")
#: Models: one a kind, and one for names with words that are in no table.
JUDGES = (*KINDS, "context")
PLACEHOLDERS = {"email": "[EMAIL]", "phone": "[PHONE]", "identity_number": "[ID]", "address": "[ADDRESS]", "name": "[NAME]"}

# Words and patterns of formats.

DIGIT_WORDS = "oh zero one two three four five six seven eight nine double triple".split()
STREET_ENDS = "Street St Road Rd Avenue Ave Boulevard Blvd Lane Ln Way Drive Dr Court Ct Terrace Ter Place Pl Square Sq Crescent Close Row Hill".split()
TITLES = frozenset("dr prof professor mr mrs ms miss mx nurse sister pt patient dra sr sra herr frau doctor".split())
KIN = frozenset("son daughter wife husband mother father brother sister neighbour neighbor carer grandson granddaughter grandmother grandfather aunt uncle partner cousin niece nephew friend".split())
PARTICLES = frozenset("van von der den de la le du del della di da dos bin ibn al el ter ten".split())
#: Words after which, or before which, a name is a person's.
BEFORE_NAME = frozenset("cc re: name: by from with called met when to billing: and pt spoke informed signed accompanied discussed contact:".split())
AFTER_NAME = frozenset("called was were is slept manages fell asked present both today w/ and has had says rang drove (the".split())
#: Words after which a name-like word is a place, a test, a month or a verb.
AFTER_OTHER = frozenset(
    "annex annex. clinic clinic. ward ward. lab lab. pharmacy pharmacy. imaging suite hospital house sign score test test. stain bengal period return the hold halve double stop resume"
    " start continue taper decide decide. disease syndrome phenomenon maneuver scale index road street avenue".split()
)
CLEAR_TITLES = frozenset("dr prof professor mr mrs ms miss mx dra sr sra herr frau".split())
#: Capitalised words that are part of no name.
NO_NAME = TITLES | KIN | AFTER_OTHER | {w.strip("(:") for w in BEFORE_NAME | AFTER_NAME}
NOT_A_NUMBER_OF = frozenset(
    "lot ref serial upc order code claim ext ext. error offset lsn version pager invoice tracking ticket batch model part item room reference parcel shipment case build port receipt".split()
)
#: Words that may stand between such a word and its number.
NUMBER_LABELS = ("no", "no.", "number", "#", "nr", "id")

_SEP = r"[ ]{1,2}"
_UNIT = rf"(?:,?{_SEP}?(?:#[ ]?|(?:apt|apartment|unit|suite|ste|no)\.?{_SEP})\d+\w?)?"
_DIGIT_WORD = "(?:" + "|".join(DIGIT_WORDS) + ")"
_L = r"[^\W\d_]"
_SPAN = {
    "email": [
        ("mail", r"(?<![\w.+\-])[\w.+\-]+[ ]?(?:[@＠]|\(at\)|\[at\]|[ ]at[ ])[ ]?[\w\-]+(?:(?:\.|[ ]?\(dot\)[ ]?|[ ]?\[dot\][ ]?|[ ]dot[ ])[\w\-]+)+"),
    ],
    "phone": [
        ("grouped", r"(?<![\w#+.\-/])(?:\+?\d{1,2}[ .\-])?(?:\(\d{3}\)|\d{3})(?:[ ]?/[ ]?|[ .\-]|(?<=\))[ ]{0,2})\d{3}[ .\-]\d{4}(?![\w]|-\d)"),
        ("seven", r"(?<![\w#+.\-/])\d{3}[ .\-]\d{4}(?![\w]|-\d)"),
        ("bare", r"(?<![\w#+.\-/])\d{10}(?![\w\-])"),
        ("words", rf"(?<!\w){_DIGIT_WORD}(?:[ ,\-]{{1,2}}{_DIGIT_WORD}){{6,}}(?!\w)"),
    ],
    "identity_number": [
        ("three_two_four", r"(?<![\w\-#.])\d{3}([ .\-])\d{2}\1\d{4}(?![\w]|-\d)"),
        ("nine", r"(?<![\w\-#.])\d{9}(?![\w\-])"),
        ("letters_digits", r"(?<![\w\-#])[a-z]{1,3}\d{6,10}(?![\w\-])"),
        ("dashed", r"(?<![\w\-#])\d{4}-\d{3}(?![\w]|-\d)"),
        ("mixed", r"(?<![\w\-#])[a-z]\d[a-z](?:-\d{3}){2}(?![\w\-])"),
        ("labelled", r"\b(?:ssn|mrn|chart no|member id|member #|member no|passport|passport no|record no|id)[ .:#\-]{1,3}([a-z]{0,3}\d[\da-z]*(?:[\-.](?=\w*\d)\w+){0,3})(?!\w)"),
    ],
    "address": [
        ("street", rf"(?<![\w\-/.])\d{{1,5}}[a-z]?(?:{_SEP}1/2)?{_SEP}(?:[nsew]\.?{_SEP})?(?:{_L}+{_SEP}){{1,3}}?(?:{'|'.join(STREET_ENDS)})(?![\w\-])\.?{_UNIT}"),
        ("french", rf"(?<![\w\-/.])\d{{1,5}}{_SEP}(?:bis )?(?:rue|avenue|chemin|place){_SEP}(?:de la |de l'|du |des |de |d')?{_L}+(?!\w){_UNIT}"),
        ("spanish", rf"(?<!\w)(?:calle|avenida|rua|via){_SEP}(?:de la |del |de )?{_L}+{_SEP}\d{{1,5}}(?![\w\-]){_UNIT}"),
        ("german", rf"(?<!\w){_L}+(?:straße|strasse|gasse|allee){_SEP}\d{{1,5}}[a-z]?(?![\w\-]){_UNIT}"),
    ],
}
_GENERATORS = [(k, name, re.compile(p, re.I)) for k, ps in _SPAN.items() for name, p in ps]
_INTERNATIONAL = re.compile(r"(?<![\w+])\+\d{1,3}(?:[ .\-]?\(?\d{1,5}\)?){2,8}(?![\w])")
_GROUP = re.compile(r"[ .\-]?\(?\d+\)?")
_OTHER_NUMBER = re.compile(r"(?<!\S)[^\s@]*\d{3}[^\s@]*")
_TAIL_OF = re.compile(r"\d\)?[ ]?[ .\-/]?[ ]?\Z")
#: Dashes, blanks, digits and signs of other widths, by the plain one: the text keeps its length.
_PLAIN = str.maketrans("\u2010\u2011\u2012\u2013\u2014\u2015\u2212\ufe58\ufe63\uff0d\u00a0\u2002\u2003\u2007\u2009\u202f\u3000０１２３４５６７８９（）．／＃＋", "----------" + " " * 7 + "0123456789()./#+")
#: Words without one of which a generator finds nothing.
_NEEDS = {
    "words": frozenset(DIGIT_WORDS), "street": frozenset(x.lower() for x in STREET_ENDS), "french": frozenset("rue avenue chemin place".split()),
    "spanish": frozenset("calle avenida rua via".split()), "labelled": frozenset("ssn mrn chart member passport record id".split()),
}
_GERMAN_ENDS = ("straße", "strasse", "gasse", "allee")
#: Six digits or more with at most three signs between two: where a phone or identity number can be.
_ZONE = re.compile(r"\d(?:[ .\-/()]{0,3}\d){5,}")
_AT = re.compile(r"[@＠]|\(at\)|\[at\]| at \w+(?: dot|\.\w)", re.I)
_MAIL = re.compile(_SPAN["email"][0][1], re.I)
_WORD = re.compile(r"[^\W\d_]+(?:['’\-][^\W\d_]+)*")
#: What e-mail addresses and the names of hosts and accounts have in them.
_JOINED = re.compile(r"[@＠]|[^\W_][._]\w")
#: Where a word may start a sentence: first in a text, or after a dot or dash that is in no word.
_START = re.compile(r"(?:\A|\.|(?<![^\W\d_])-|-(?=\s))\s*(?=[^\W\d_])")
_GAP = re.compile(r"(?:,?[ ]{0,2}|[ ]{1,2}[^\W\d_]\.?[ ]{1,2})(?:(?<=[ ])(?:" + "|".join(sorted(PARTICLES)) + r")[ ]{1,2})*\Z", re.I)
_INITIAL_BEFORE = re.compile(r"(?:^|[\s(/,:;])([^\W\d_]\.[ ]?)\Z")
_INITIAL_AFTER = re.compile(r"[ ][^\W\d_]\.(?=\W|$)")
_PARTICLE_BEFORE = re.compile(r"(?:^|(?<=[\s(/,:;]))((?:(?:" + "|".join(PARTICLES) + r")[ ]{1,2})+)\Z", re.I)
_ABBREVIATED = re.compile(r"(?<!\w)(?:\w|" + "|".join(sorted(TITLES)) + r")\.\Z", re.I)


def plain(found: str) -> str:
    """As written, lower-cased, letters and digits only."""
    return "".join(c for c in found.lower() if c.isalnum())


def same_width(t: str) -> str:
    """The text with its typographic dashes, blanks and digits made plain, character by character."""
    return t if t.isascii() else t.translate(_PLAIN)


def fold(word: str) -> str:
    return word.lower() if word.isascii() else unicodedata.normalize("NFC", word).lower()


@dataclass
class NameWords:
    """How much a word looks like a first or last name: known ones, and last names by beginning and ending."""

    first: dict[str, int] = field(default_factory=dict)
    last: dict[str, int] = field(default_factory=dict)
    heads: set[str] = field(default_factory=set)
    tails: set[str] = field(default_factory=set)
    #: Words of no name that the texts write small, or often begin sentences with.
    ordinary: set[str] = field(default_factory=set)

    @classmethod
    def learn(cls, firsts: list[str], lasts: list[str]) -> NameWords:
        """From first and last names held in memory; ``name_words`` counts those of tables."""
        f, s = (Counter(w for n in names if n for w in words_of_name(n)) for names in (firsts, lasts))
        heads, tails = Counter(), Counter()
        for w in s:
            heads.update({w[:n] for n in range(3, 7) if len(w) > n + 2})
            tails.update({w[-n:] for n in range(3, 7) if len(w) > n + 2})
        return cls(dict(f), dict(s), {h for h, n in heads.items() if n >= 4}, {t for t, n in tails.items() if n >= 4})

    def like(self, w: str) -> tuple[float, float]:
        """First- and last-name likeness of a folded word."""
        f, s = self.first.get(w, 0), self.last.get(w, 0)
        last = 1.0 if s else 0.0
        if not s and len(w) >= 6 and any(w[:n] in self.heads and w[n:] in self.tails for n in range(3, len(w) - 2)):
            last = 0.6
        return (1.0 if f and f * 4 >= s else 0.5 if f else 0.0), (last if s * 4 >= f else min(last, 0.5))


    def unknown(self, text: str) -> bool:
        """Whether a word of it stands in no table and is no ordinary word."""
        return any(self.like(w) == (0.0, 0.0) and w not in self.ordinary for w in words_of_name(text))

    def without(self, held: Callable[[str], bool]) -> NameWords:
        """As if the words for which ``held`` is true stood in no table."""
        return _Blind(self.first, self.last, self.heads, self.tails, self.ordinary, held)


@dataclass
class _Blind(NameWords):
    held: Callable[[str], bool] = bool

    def like(self, w: str) -> tuple[float, float]:
        return (0.0, 0.0) if self.held(w) else super().like(w)


#: Texts to a start of a sentence with a word, at most, that make it an ordinary one; five starts at least.
TEXTS_A_START = 5000


def count_words(texts: dict[str, int]) -> dict[str, list[int]]:
    """Of each folded word of the texts (each with how often it stands): cases in small letters, in others, at starts of sentences, in texts in capitals.

    Words of e-mail addresses and the like, which are small in names too, are no cases.
    """
    written, capitals, starts = Counter(), Counter(), Counter()
    for t, n in texts.items():
        to = capitals if t.isupper() else written
        alone = " ".join(x for x in t.split() if not _JOINED.search(x)) if _JOINED.search(t) else t
        for w in _WORD.findall(alone if to is written else t):
            to[w] += n
        if to is written:
            for m in _START.finditer(t):
                w = _WORD.match(t, m.end()).group()
                # the dot of a title or an initial ends no sentence
                if not w.islower() and not _ABBREVIATED.search(t[max(0, m.end() - 20):m.end()].rstrip()):
                    starts[w] += n
    out: dict[str, list[int]] = {}
    for k, counts in enumerate((written, written, starts, capitals)):
        for w, n in counts.items():
            own = out.setdefault(fold(w), [0, 0, 0, 0])
            if k > 1 or w.islower() == (k == 0):
                own[k] += n
    return out


def ordinary_words(texts: list[tuple[str, str]], names: NameWords) -> set[str]:
    """Of texts held in memory, the words of no table that stand twice in small letters (and in a fifth of all cases), or often at a start of a sentence; ``name_words`` counts those of tables."""
    least = max(5, len(texts) / TEXTS_A_START)
    counts = count_words(Counter(t for t, _ in texts))
    return {w for w, (small, large, starts, _) in counts.items() if (small >= 2 and small * 4 >= large or starts >= least) and names.like(w) == (0.0, 0.0)}


def words_of_name(name: str) -> list[str]:
    """Folded words of a name, without particles, titles and initials."""
    return [w for x in _WORD.findall(name) if len(w := fold(x)) > 1 and w not in PARTICLES and w not in TITLES]


def _shape(s: str) -> str:
    return "".join("9" if c.isdigit() else "A" if c.isalpha() else c for c in s)


def _case(words: list[str]) -> str:
    kinds = {"U" if w.isupper() and len(w) > 1 else "T" if w[:1].isupper() else "l" for w in words}
    return kinds.pop() if len(kinds) == 1 else "x"


def _joins(a: str, gap: str, b: str) -> bool:
    """Whether two name words with this between them belong together: first last, or last, first."""
    return (a, b) == ("L", "F") if "," in gap else (a, b) == ("F", "L")


#: A candidate: kind, generator, start, end, then words and numbers its features come from.
Candidate = tuple


class Proposer:
    """All generators over one text."""

    def __init__(self, names: NameWords):
        self.names = names
        self.known: dict[str, tuple[float, float]] = {}

    def _like(self, word: str) -> tuple[float, float]:
        got = self.known.get(word)
        if got is None:
            got = self.names.like(fold(word))
            if len(self.known) > 200_000:
                self.known.clear()
            self.known[word] = got
        return got

    def spans(self, t: str, kinds: tuple[str, ...] = KINDS) -> list[tuple[str, str, int, int, str, float, float]]:
        """kind, generator, start, end, shape, first- and last-name likeness."""
        out = []
        words = [(*m.span(), m.group()) for m in _WORD.finditer(t)]
        said = {w.lower() for _, _, w in words}
        zones = [m.span() for m in _ZONE.finditer(t)]
        for kind, name, p in _GENERATORS:
            if kind not in kinds or kind == "email":
                continue
            needs = _NEEDS.get(name)
            if needs is None and kind != "address":  # numbers: a match ends where a zone does or before
                for x, y in zones:
                    for m in p.finditer(t, max(0, x - 8), y + 12):
                        if m.end() <= y:
                            out.append((kind, name, *m.span(), _shape(m.group()), 0.0, 0.0))
            elif any(w.endswith(_GERMAN_ENDS) for w in said) if needs is None else not said.isdisjoint(needs):
                for m in p.finditer(t):
                    a, b = m.span(1) if name == "labelled" else m.span()
                    out.append((kind, name, a, b, _shape(t[a:b]) if kind != "address" else name, 0.0, 0.0))
        if "email" in kinds:
            done = 0
            for at in _AT.finditer(t):  # around each sign; the part before it has at most 64 characters, the one after 255
                if at.end() > done:
                    for m in _MAIL.finditer(t, max(done, at.start() - 66), at.end() + 255):
                        out.append(("email", "mail", *m.span(), _shape(m.group()), 0.0, 0.0))
                        done = m.end()
                        break
        if "+" in t and "phone" in kinds:
            for m in _INTERNATIONAL.finditer(t):
                at = m.start() + 1
                ends = [g.end() for g in _GROUP.finditer(t, at, m.end())]
                ends = [e for e in ends if 8 <= sum(map(str.isdigit, t[at:e])) <= 15]
                for e in ends:  # by the number of digits, whether they are grouped, and whether another group follows
                    n, grouped = sum(map(str.isdigit, t[at:e])), not t[at:e].isdigit()
                    shape = f"+{'1 ' if t[at:at + 1] == '1' and grouped else ''}{n if grouped else 'run'}{'$' if e == m.end() else ''}"
                    out.append(("phone", "international", m.start(), e, shape, 0.0, 0.0))
        if "name" in kinds:
            out += self._names(t, words)
        return out

    def _context(self, t: str, words: list[tuple[int, int, str, tuple[float, float]]]):
        """Names with a capitalised word that is in no table, where the words around it are such as stand at a person."""
        runs: list[list] = []
        words = [x for x in words if len(x[2]) > 1]  # initials stand between
        joined = lambda a, b: _GAP.match(t[a[1]:b[0]]) is not None
        up = t.isupper()
        for k, x in enumerate(words):
            a, b, w, l = x
            if not w[0].isupper():
                continue
            strange = l == (0.0, 0.0) and fold(w) in self.names.ordinary
            if runs and not strange and runs[-1][-1][0] == words[k - 1][0] and joined(words[k - 1], x):
                runs[-1].append(x)
                continue
            lead = t[max(0, a - 24):a]
            part = _PARTICLE_BEFORE.search(lead)
            before = (lead[:part.start(1)] if part else lead).split()
            prev = before[-1].lower().lstrip("(") if before else ""
            bare = prev.rstrip(".:,")
            if up or strange:  # every word looks like a name, or it is an ordinary one: clear titles only
                near = bare in CLEAR_TITLES and not (strange and up)
            else:
                near = bare in TITLES or bare in KIN or prev in BEFORE_NAME
                if not near and k + 1 < len(words):
                    y = words[k + 1]
                    near = (y[3] != (0.0, 0.0) and y[2][0].isupper() and joined(x, y)) or (t[b:y[0]].strip("( ") == "" and y[2] in AFTER_NAME)
                near = near or l[0] > 0
            if near:
                runs.append([(a, b, w, l, a - len(lead) + part.start(1) if part else a)])
        for run in runs:
            run = [x if len(x) == 5 else (*x, x[0]) for x in run]
            kinds = ["U" if l == (0.0, 0.0) else "F" if l[0] >= l[1] else "L" for *_, l, _ in run]
            for i in range(len(run)):
                for j in sorted({*range(i, min(i + 3, len(run))), len(run) - 1}):
                    types, part = kinds[i:j + 1], run[i:j + 1]
                    if "U" not in types or any(fold(w) in NO_NAME for _, _, w, *_ in part):
                        continue
                    shape = types[0]
                    for x, y, kind in zip(part, part[1:], types[1:]):
                        gap = t[x[1]:y[0]]
                        shape += ("," if "," in gap else "i" if "." in gap or len(gap.strip()) == 1 else "p" if gap.strip() else " ") + kind
                    more = ("<" if i else "") + (">" if j + 1 < len(run) else "")
                    edge = f"{shape}{more}:{_case([x[2] for x in part])}"
                    f, s = max(x[3][0] for x in part), max(x[3][1] for x in part)
                    a, b, at = part[0][0], part[-1][1], part[0][4]
                    if at < a:
                        yield ("name", "context", at, b, "p" + edge, f, s)
                        edge = "." + edge
                    yield ("name", "context", a, b, edge, f, s)

    def _names(self, t: str, plain_words: list[tuple[int, int, str]]):
        like, known, runs, strange = self._like, self.known, [], False
        none = (0.0, 0.0)
        words = [(a, b, w, known.get(w) or like(w)) for a, b, w in plain_words]
        for x in words:
            if x[3] == none:
                strange = strange or x[2][0].isupper()
            elif runs and _GAP.match(t[runs[-1][-1][1]:x[0]]):
                runs[-1].append(x)
            else:
                runs.append([x])
        if strange:
            yield from self._context(t, words)
        for run in runs:
            kinds = ["F" if l[0] >= l[1] else "L" for _, _, _, l in run]
            for i in range(len(run)):
                for j in sorted({*range(i, min(i + 4, len(run))), len(run) - 1}):  # of longer runs, the whole rest too
                    part = run[i:j + 1]
                    a, b = part[0][0], part[-1][1]
                    types = kinds[i:j + 1]
                    shape = types[0]
                    for x, y, k in zip(part, part[1:], types[1:]):
                        gap = t[x[1]:y[0]]
                        shape += ("," if "," in gap else "i" if "." in gap or len(gap.strip()) == 1 else "p" if gap.strip() else " ") + k
                    words = [w for _, _, w, _ in part]
                    f, s = max(l[0] for *_, l in part), max(l[1] for *_, l in part)
                    # whether the next or previous word would make a longer name of it
                    longer = (i > 0 and _joins(kinds[i - 1], t[run[i - 1][1]:a], types[0])) or (j + 1 < len(run) and _joins(types[-1], t[b:run[j + 1][0]], kinds[j + 1]))
                    edge = f"{shape}{'+' if longer else ''}:{_case(words)}"
                    out = [(a, b, edge)]
                    head = _INITIAL_BEFORE.search(t, max(0, a - 4), a) if i == 0 and types[0] == "L" else None
                    if head:
                        out.append((head.start(1), b, "i" + edge))
                        out[0] = (a, b, "." + edge)
                    part_ = _PARTICLE_BEFORE.search(t, max(0, a - 10), a) if i == 0 and types[0] == "L" and not head else None
                    if part_:
                        out.append((part_.start(1), b, "p" + edge))
                        out[0] = (a, b, "." + edge)
                    tail = _INITIAL_AFTER.match(t, b) if j + 1 == len(run) and types[-1] == "F" and "," in shape else None
                    if tail:
                        out.append((a, tail.end(), edge + "i"))
                    for x, y, e in out:
                        yield ("name", "words", x, y, e, f, s)

    def candidates(self, t: str, hint: str, kinds: tuple[str, ...] = KINDS) -> list[Candidate]:
        """Spans of a text (in plain width) with their surroundings: ..., two words before, one after, characters at the edges, digits, length, upper share, text."""
        spans = self.spans(t, kinds)
        if not spans:
            return []
        up = t.isupper()
        return [self.around(t, hint, x, up) for x in spans]

    @staticmethod
    def around(t: str, hint: str, span: tuple, up: bool | None = None) -> Candidate:
        """A span with what stands around it."""
        a, b = span[2:4]
        lead = t[max(0, a - 40):a]
        words = lead.lower().split()
        prev1 = words[-1] if words else "^" + hint
        prev2 = words[-2] if len(words) > 1 else "^" + hint
        if lead and lead.rstrip(" \t")[-1:] in "\n":
            prev1 = "\\n"
        rest = t[b:b + 30].lower().split(None, 1)
        after = rest[0] if rest and not t[b:b + 1].isspace() else ("_" + rest[0] if rest else "$")
        return (*span, prev1, prev2, after, lead[-1:] or "^", t[b:b + 1] or "$", sum(map(str.isdigit, t[a:b])), b - a, t.isupper() if up is None else up)


# --- rules that label clear candidates of the training sample ---------------------------------


def rule(t: str, c: Candidate) -> int | None:
    """1 or 0 where a candidate's case is clear, else None."""
    kind, gen, a, b, shape, f, s, prev1, prev2, after, cb, ca, digits, length, up = c
    text = t[a:b]
    near = {prev1.strip("(:,."), prev2.strip("(:,.")}
    if kind == "email":
        end = re.split(r"[.\s()\[\]]+", text.strip("()[] "))[-1]
        return int(end.isalpha() and len(end) >= 2 and ("@" in text or "＠" in text or re.search(r"dot|\(at\)|\[at\]|at [\w\-]+\.", text, re.I) is not None))
    if kind == "phone":
        if near & NOT_A_NUMBER_OF:
            return 0
        if gen == "words":
            return 1
        if gen == "international":
            if re.match(r"\+1\D", text):
                return int(digits == 11)
            # other countries: the whole run where it is of a usual length; where a run goes on too long, its end is unclear
            if shape == "+run$":
                return 1
            if shape.endswith("$"):
                return 1 if 10 <= digits <= 12 else None
            return 0 if digits < 10 else 1 if digits == 12 else None
        if gen == "seven":
            if _TAIL_OF.search(t, max(0, a - 8), a):  # the end of a longer number
                return 0
            return 1 if text[3] in "-." else None
        if gen == "grouped":
            return int(digits in (10, 11))
        return 1 if prev1.strip("(:,.") in {"at", "on", "ph", "cell", "phone", "use", "to", "mobile", "tel", "rang", "call", "number", "/"} else None
    if kind == "identity_number":
        if near & NOT_A_NUMBER_OF:
            return 0
        labels = {"ssn", "mrn", "id", "passport", "sec", "number", "no", "member", "chart", "file", "is", "security", "#", "shows", "verified"}
        labelled = bool(near & labels) or re.search(r"(?:ssn|mrn|id|passport|sec|no|#)\W{0,3}$", t[max(0, a - 12):a], re.I) is not None
        if gen == "labelled":
            return 1 if digits >= 6 else 0
        return 1 if labelled else None if gen == "three_two_four" else 0
    if kind == "address":
        words = text.split()
        return int(ca != "-" and len(words) <= 8 and not {"ecg", "and", "in", "the", "of", "mg", "tabs", "weeks", "tests", "lead"} & {w.lower().strip(",.") for w in words})
    if ca in "@＠_+\\" or cb in "@＠_+-." or (ca in ".-" and t[b + 1:b + 2].isalnum()) or re.match(r"\s?(?:[@＠]|\(at\)|\[at\])", t[b:b + 6]) or re.match(r" at \w+ dot", t[b:b + 16]):
        return 0
    nxt, core = after.strip("_,.;:)"), shape.split(":")[0]
    if nxt in AFTER_OTHER or after.strip("_") in AFTER_OTHER:
        return 0
    if gen == "context":  # labelled by words held out, see train
        return None
    if core.startswith(".") or core.endswith("+"):
        return 0
    case = shape.split(":")[1][0]
    if case == "x":
        return 0
    bare = core.replace("i", "").replace("p", "").replace(" ", "")
    if core in ("F L", "FiL", "FpL", "L,F", "L,Fi", "pL,F") or (core == "iL" and case != "l"):
        return 1
    title = prev1.strip(".:,()")
    if bare == "L":
        return 1 if title in TITLES else 0
    if bare == "F":
        if title in KIN or title in TITLES:
            return 1
        if prev1 in ("since", "in", "until", "last", "the", "every", "early", "late"):
            return 0
        return 1 if after in ("_(the", ",") or nxt == "manages" else 0 if case == "l" or prev1.endswith((".", "\\n", "-")) or prev1.startswith("^") else None
    return 0


def judge(c: Candidate) -> str:
    """Whose trees decide: the kind's, or those of names by context."""
    return "context" if c[1] == "context" else c[0]


def features(c: Candidate, odds: dict[str, dict[str, float]]) -> list[float]:
    kind, gen, a, b, shape, f, s, prev1, prev2, after, cb, ca, digits, length, up = c
    get = odds[judge(c)].get
    return [
        get("s" + shape, 0.0), get("g" + gen, 0.0), get("p" + prev1, 0.0), get("q" + prev2, 0.0), get("n" + after, 0.0), get("b" + cb, 0.0), get("a" + ca, 0.0),
        f, s, float(digits), float(length), float(up),
    ]


@dataclass
class PiiModel:
    names: NameWords
    odds: dict[str, dict[str, float]]
    trees: dict[str, BoostedTrees]
    thresholds: dict[str, float]
    #: Kinds with too few clear cases for trees: clear candidates are decided by ``rule``.
    rare: set[str] = field(default_factory=set)

    def proposer(self) -> Proposer:
        if "_proposer" not in self.__dict__:
            self._proposer = Proposer(self.names)
        return self._proposer

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_proposer"}

    def detect(self, texts: list[tuple[str, str]]) -> list[list[tuple[int, int, str]]]:
        """Of each (text, hint): the spans taken, in order: start, end, kind.  All texts are scored together."""
        propose = self.proposer().candidates
        texts = [(same_width(t), h) for t, h in texts]
        by_kind: dict[str, list[tuple[int, Candidate]]] = {k: [] for k in JUDGES}
        for i, (t, h) in enumerate(texts):
            for c in propose(t, h):
                by_kind[judge(c)].append((i, c))
        good: list[list[tuple[float, int, int, int, str]]] = [[] for _ in texts]
        for by, cs in by_kind.items():
            if cs and (by in self.trees or by in self.rare):
                p = self.trees[by].predict(np.array([features(c, self.odds) for _, c in cs])) if by in self.trees else np.zeros(len(cs))
                least, kind = self.thresholds.get(by, 0.5), "name" if by == "context" else by
                if by in self.rare:
                    p = [v if (y := rule(texts[i][0], c)) is None else float(y) for (i, c), v in zip(cs, p)]
                for (i, c), v in zip(cs, p):
                    if v >= least:
                        good[i].append((-float(v), c[2] - c[3], c[2], c[3], kind))
        out = []
        for spans in good:
            taken: list[tuple[int, int, str]] = []
            for *_, a, b, kind in sorted(spans):  # the most probable first, longer before shorter
                if all(b <= x or a >= y for x, y, _ in taken):
                    taken.append((a, b, kind))
            out.append(sorted(taken))
        return out


def _held(word: str) -> bool:
    return zlib.crc32(word.encode()) % 2 == 0


#: Clear findings from which a kind's trees are trusted alone; those of rarer kinds are sought in all rows.
FEW = 50


def _personal(c: Candidate) -> bool:
    """Whether a person is to be expected here, so that a word in no table is not known to be none."""
    prev, nxt = c[7].lstrip("("), c[9].strip("_,.;:)")
    return nxt not in AFTER_OTHER and c[9].strip("_") not in AFTER_OTHER and (prev.rstrip(".:,") in TITLES or prev.rstrip(".:,") in KIN or prev in BEFORE_NAME or nxt in AFTER_NAME)


#: A labelled candidate and the half of the sample its text belongs to.
Labelled = tuple[Candidate, int, int]


def _elsewhere(c: Candidate, around: Candidate) -> Candidate:
    """A candidate's shape in other surroundings."""
    return (*c[:7], *around[7:12], *c[12:])


def labelled(texts: list[tuple[str, str]], names: NameWords) -> dict[str, list[Labelled]]:
    """Clear candidates of each model with their labels, and hard negatives of the number kinds.

    A hard negative is a clear finding's shape where the sample has a number of another sort, or after a word
    that numbers of other sorts have before them.  International numbers stand for those written in one run, too.
    """
    propose, blind = Proposer(names).candidates, Proposer(names.without(_held)).candidates
    rows: dict[str, list[Labelled]] = {k: [] for k in JUDGES}
    others: list[tuple[Candidate, int]] = []
    for t, h in texts:
        t = same_width(t)
        part = zlib.crc32(t.encode("utf-8", "replace")) % 2
        clear: dict[tuple[int, int], int | None] = {}
        maybe: list[tuple[int, int]] = []
        for c in propose(t, h):
            y = rule(t, c)
            if c[0] == "name" and c[1] != "context":
                clear[c[2], c[3]] = y
            elif y != 0:
                maybe.append((c[2], c[3]))
            if y is not None and c[1] != "context":
                rows[c[0]].append((c, y, part))
        for c in blind(t, h, ("name",)):
            if c[1] == "context":
                y = clear.get((c[2], c[3]), None if _personal(c) and names.unknown(t[c[2]:c[3]]) else 0)
                if y is not None:
                    rows["context"].append((c, y, part))
        for m in _OTHER_NUMBER.finditer(t):
            a, b = m.span()
            if all(b <= x or a >= y for x, y in maybe):
                others.append((Proposer.around(t, h, ("", "", a, b, "", 0.0, 0.0)), part))
    words = sorted(NOT_A_NUMBER_OF)
    for kind in ("phone", "identity_number"):
        found = [(c, part) for c, y, part in rows[kind] if y and c[1] not in ("labelled", "words", "international")]
        for i, (c, part) in enumerate(found):
            same = [o for o in (others[i * 7919 % len(others)], others[i * 104729 % len(others)]) if o[1] == part] if others else []
            rows[kind] += [(_elsewhere(c, o), 0, part) for o, _ in same[:1]]
            word = words[i % len(words)]
            before = (word, c[8]) if i % 3 else (NUMBER_LABELS[i % len(NUMBER_LABELS)], word)
            if i % 2 == 0:
                rows[kind].append(((*c[:7], *before, *c[9:]), 0, part))
    abroad = [(c, part) for c, y, part in rows["phone"] if y and c[1] == "international"]
    for i, (c, part) in enumerate(abroad):  # the same in one run of any length
        n = (9, 10, 11, 12, 13, 14, 15)[i % 7]
        rows["phone"].append(((*c[:4], "+run$", *c[5:12], n, n + 1, c[14]), 1, part))
    return rows


def _log_odds(rows: list[Labelled], smooth: float) -> dict[str, float]:
    n, hit = Counter(), Counter()
    for c, y, _ in rows:
        for key in ("s" + c[4], "g" + c[1], "p" + c[7], "q" + c[8], "n" + c[9], "b" + c[10], "a" + c[11]):
            n[key] += 1
            hit[key] += y
    share = (sum(y for _, y, _ in rows) + 1) / (len(rows) + 2)
    out = {}
    for key, m in n.items():
        p = (hit[key] + smooth * share) / (m + smooth)
        if m > 1:
            out[key] = math.log(p / (1 - p)) - math.log(share / (1 - share)) if 0 < p < 1 else 0.0
    return out


def fit_judge(kind: str, rows: list[Labelled], smooth: float) -> tuple[dict[str, float], BoostedTrees, float]:
    """Log-odds, trees and threshold from labelled rows.

    The sample has two halves.  A row's log-odds come from the other half; trees of one half give margins of
    the other; of those margins every second row calibrates and the rest chooses the threshold.  The trees
    returned are fitted to all rows.  With labels of one sort there is nothing to tell apart: all pass, or none.
    """
    part = np.array([f for *_, f in rows])
    if part.min() == part.max():
        part = np.arange(len(rows)) % 2
    y = np.array([y for _, y, _ in rows], float)
    odds = [_log_odds([r for r, f in zip(rows, part) if f != half], smooth) for half in (0, 1)]
    x = np.array([features(c, {kind: odds[f]}) for (c, *_), f in zip(rows, part)])
    margin = np.zeros(len(rows))
    for half in (0, 1):
        if (part == half).any() and (part != half).any():
            margin[part == half] = BoostedTrees().fit(x[part != half], y[part != half], held=0).margin(x[part == half])
    model = BoostedTrees().fit(x, y, held=0)
    rest = np.arange(len(rows)) % 4 < 2
    threshold = 0.5
    if 0 < y[rest].sum() < rest.sum() and 0 < y[~rest].sum() < (~rest).sum():
        model.scale = platt(margin[rest], y[rest])
        threshold = _threshold(model.calibrated(margin[~rest]), y[~rest])
    return _log_odds(rows, smooth), model, threshold


def train(
    texts: list[tuple[str, str]], firsts: list[str] = (), lasts: list[str] = (), smooth: float = 2.0,
    names: NameWords | None = None, more: Callable[[list[str], NameWords], list[tuple[str, str]]] | None = None,
) -> PiiModel:
    """Model from a bounded sample of texts and the words (``names`` of ``name_words``, or those of ``firsts``, ``lasts`` and the texts).

    How words in no table are judged by their context is learned by holding out half of the known words: what
    the rules call a name with them known is a name without, and every other such candidate is none.
    ``more`` gives further texts with clear findings of kinds that have less than ``FEW`` in the sample.  Kinds
    that are rarer still find all that the rules call clear, and leave only unclear candidates to their trees.
    """
    if names is None:
        names = NameWords.learn(firsts, lasts)
        names.ordinary = ordinary_words(texts, names)
    rows = labelled(texts, names)

    def lacking() -> list[str]:
        return [k for k in KINDS if sum(y for _, y, _ in rows[k]) < FEW]

    if more is not None and lacking():
        seen = set(texts)
        for k, cs in labelled([x for x in more(lacking(), names) if x not in seen], names).items():
            rows[k] += cs
    rare = set(lacking()) if texts else set()
    odds: dict[str, dict[str, float]] = {}
    trees, thresholds = {}, {}
    for kind, cs in rows.items():
        odds[kind] = {}
        if cs:
            odds[kind], trees[kind], thresholds[kind] = fit_judge(kind, cs, smooth)
    return PiiModel(names, odds, trees, thresholds, rare)


def _threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The calibrated probability with the best F1 on the sample, between 0.3 and 0.7; the middle of equals."""
    grid = np.linspace(0.3, 0.7, 41)
    hit = [((p >= g) & (y > 0.5)).sum() for g in grid]
    f1 = np.array([2 * h / max(1, (p >= g).sum() + y.sum()) for g, h in zip(grid, hit)])
    best = np.flatnonzero(f1 >= f1.max() - 1e-12)
    return float(grid[best[len(best) // 2]])


# --- tables -----------------------------------------------------------------------------------


def values(text: str | None, is_json: bool) -> list[tuple[str, str]]:
    """(text, hint) of the texts in a value: itself, or the strings (and numbers) inside JSON with their key.

    What is not JSON is one text.  Null and blank give none.  Keys are names of fields and not searched, nor are
    numbers of less than seven characters: no number of any kind is so short.
    """
    if text is None or not text.strip():
        return []
    if not is_json:
        return [(text, "")]
    try:
        v = json.loads(text)
    except ValueError:
        return [(text, "")]
    out: list[tuple[str, str]] = []
    todo = [(v, "")]
    while todo:
        x, key = todo.pop()
        if isinstance(x, dict):
            todo += [(y, str(k)) for k, y in x.items()]
        elif isinstance(x, list):
            todo += [(y, key) for y in x]
        elif isinstance(x, str):
            if x.strip():
                out.append((x, key))
        elif isinstance(x, (int, float)) and not isinstance(x, bool) and len(str(x)) >= 7:
            out.append((str(x), key))
    return out


def redact_text(t: str, spans: list[tuple[int, int, str]]) -> str:
    out, at = [], 0
    for a, b, kind in spans:
        out += [t[at:a], PLACEHOLDERS[kind]]
        at = b
    return "".join(out) + t[at:]


def _is_json(text: str) -> bool:
    try:
        json.loads(text)
    except ValueError:
        return False
    return True


def _replaced(x, done: dict[tuple[str, str], str], key: str):
    """JSON with the texts in ``done`` (by text and key they stand under) replaced."""
    if isinstance(x, dict):
        return {k: _replaced(y, done, str(k)) for k, y in x.items()}
    if isinstance(x, list):
        return [_replaced(y, done, key) for y in x]
    if isinstance(x, str):
        return done.get((x, key), x)
    if isinstance(x, (int, float)) and not isinstance(x, bool):
        return done.get((str(x), key), x)
    return x


def name_words(texts: list[tuple[DataFrame, str, str, bool]], people: list[tuple]) -> NameWords:
    """Words of all rows of the name columns and ordinary words of all rows of the texts, counted by Spark.

    A person's frame has first-, last- and (if given) full-name columns; a full name's last word counts as a last
    name, or its first where a comma follows.  Only words that stand in the texts reach the driver, and beginnings
    and endings that four last names share, and of ordinary words those that are written with a capital somewhere, as
    no others are looked up; so what is broadcast is bounded by the texts' distinct words that
    are names or ordinary and by the number of distinct last names, not by rows.
    """

    def counter(f: list[str], s: list[str], whole: list[str]):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for p in batches:
                first, last = Counter(), Counter()
                for columns, to in ((f, first), (s, last)):
                    for c in columns:
                        for name, n in p[c].dropna().value_counts().items():
                            for w in words_of_name(str(name)):
                                to[w] += n
                for c in whole:
                    for name, n in p[c].dropna().value_counts().items():
                        head, comma, tail = str(name).partition(",")
                        one, two = words_of_name(head), words_of_name(tail)
                        lasts = one if comma and two else one[-1:]
                        for w in lasts:
                            last[w] += n
                        for w in two if comma and two else one[:-1]:
                            first[w] += n
                words = sorted({*first, *last})
                yield pd.DataFrame({"word": words, "f": [first[w] for w in words], "s": [last[w] for w in words]}).astype({"word": str, "f": "int64", "s": "int64"})

        return run

    def words(column: str, is_json: bool):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for p in batches:
                each = Counter()
                for t, n in Counter(p[column]).items():
                    for v, _ in values(t if isinstance(t, str) else None, is_json):
                        each[v] += n
                yield pd.DataFrame([("", 0, 0, each.total(), 0), *((w, *n) for w, n in count_words(each).items())], columns=["word", "small", "large", "starts", "capitals"])

        return run

    counts = None
    for df, f, s, *whole in people:
        whole = whole[0] if whole else []
        own = df.select(*dict.fromkeys([*f, *s, *whole])).mapInPandas(counter(f, s, whole), "word string, f bigint, s bigint")
        counts = own if counts is None else counts.unionByName(own)
    counts = cut(counts.groupBy("word").agg(F.sum("f").alias("f"), F.sum("s").alias("s"))) if counts is not None else None
    found = None
    for df, _, text, is_json in texts:
        own = df.select(text).where(F.col(text).isNotNull()).mapInPandas(words(text, is_json), "word string, small bigint, large bigint, starts bigint, capitals bigint")
        found = own if found is None else found.unionByName(own)
    known, ordinary = [], set()
    if found is not None:  # the empty word's starts are the number of texts
        found = cut(found.groupBy("word").agg(*[F.sum(c).alias(c) for c in ("small", "large", "starts", "capitals")]))
        least = max(5, sum(r.starts for r in found.where("word = ''").collect()) / TEXTS_A_START)
        often = found.where((F.col("small") >= 2) & (F.col("small") * 4 >= F.col("large")) | (F.col("starts") >= least)).where("word <> '' AND large + capitals > 0")
        known = counts.join(found, "word", "left_semi").collect() if counts is not None else []
        ordinary = {r.word for r in (often.join(counts, "word", "left_anti") if counts is not None else often).select("word").collect()}
    if counts is None:
        return NameWords(ordinary=ordinary)

    def edges(take) -> set[str]:
        pieces = F.array(*[F.when(F.length("word") > n + 2, take(n)) for n in range(3, 7)])
        shared = counts.where("s > 0").select(F.explode(pieces).alias("piece")).where("piece is not null").groupBy("piece").count()
        return {r.piece for r in shared.where("count >= 4").collect()}

    heads, tails = edges(lambda n: F.substring("word", 1, n)), edges(lambda n: F.substring("word", -n, n))
    names = NameWords({r.word: r.f for r in known if r.f}, {r.word: r.s for r in known if r.s}, heads, tails)
    names.ordinary = {w for w in ordinary if names.like(w) == (0.0, 0.0)}
    return names


def clear_texts(texts: list[tuple[DataFrame, str, str, bool]], kinds: list[str], names: NameWords, most: int = 500) -> list[tuple[str, str]]:
    """From all rows, at most ``most`` texts a kind that have a clear finding of it, chosen by hash."""
    shared = texts[0][0].sparkSession.sparkContext.broadcast(names)

    def clear(column: str, is_json: bool):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            propose = Proposer(shared.value).candidates
            for p in batches:
                rows = set()
                for value in p[column]:
                    for t, h in values(value if isinstance(value, str) else None, is_json):
                        rows |= {(c[0], zlib.crc32(t.encode("utf-8", "replace")), t, h) for c in propose(same_width(t), h, tuple(kinds)) if rule(same_width(t), c)}
                best = [x for k in kinds for x in sorted(r for r in rows if r[0] == k)[:most]]
                yield pd.DataFrame(best, columns=["kind", "draw", "value", "hint"])

        return run

    found = None
    for df, _, text, is_json in texts:
        own = df.select(text).where(F.col(text).isNotNull()).mapInPandas(clear(text, is_json), "kind string, draw bigint, value string, hint string")
        found = own if found is None else found.unionByName(own)
    found = cut(found.distinct())
    return sorted({(r.value, r.hint) for k in kinds for r in found.where(F.col("kind") == k).orderBy("draw", "value", "hint").limit(most).collect()})


def fit(texts: list[tuple[DataFrame, str, str, bool]], people: list[tuple], sample: int = 6000) -> PiiModel:
    """Model for tables (frame, id column, text column, is JSON) and people (frame, first-, last- and full-name columns).

    About ``sample`` rows a text table reach the driver (never more than twice that), chosen by a hash of their
    values, so the same rows on every run; fewer rows are all used.  From them words' and shapes' odds and trees
    are learned; kinds with few clear findings there get more texts from all rows (``clear_texts``).  Words of names and ordinary words are those of all rows (``name_words``).  Without any text or name the model
    finds nothing.
    """

    parts = []

    def drawn(df: DataFrame, columns: list[str], most: int) -> list:
        df = df.select(*columns).where(F.col(columns[-1]).isNotNull())
        share = min(1.0, most / max(1, df.count()))
        if share < 1:
            parts.append(share)
        return df.where(F.pmod(F.xxhash64(*columns), F.lit(1_000_003)) < F.lit(int(share * 1_000_003) + 1)).limit(2 * most).collect()

    got: list[tuple[str, str]] = []
    for df, key, text, is_json in texts:
        for r in sorted(drawn(df, [key, text], sample), key=lambda r: (str(r[0]), r[1])):
            got += values(r[1], is_json)
    return train(got, names=name_words(texts, people), more=(lambda kinds, names: clear_texts(texts, kinds, names)) if parts else None)


def find(df: DataFrame, key: str, text: str, is_json: bool, label: str, model: PiiModel) -> DataFrame:
    """source_table (``label``), row_id, pii_kind, found: each distinct piece of a row once.

    Null, blank and empty texts have none; rows delivered again add nothing; JSON escapes are decoded and what
    is not JSON is searched as it is.  Whole texts are searched.  A map over partitions and a distinct of its results.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for p in batches:
            ids, texts = [], []
            for i, t in zip(p[key], p[text]):
                for v in values(t if isinstance(t, str) else None, is_json):
                    ids.append(i)
                    texts.append(v)
            each = list(dict.fromkeys(texts))  # texts delivered again, and answers given by many, once a batch
            done = {v: {(k, w) for a, b, k in spans if (w := plain(v[0][a:b]))} for v, spans in zip(each, m.detect(each))}
            rows = {(i, k, w) for i, v in zip(ids, texts) for k, w in done[v]}
            yield pd.DataFrame(sorted(rows, key=str), columns=["row_id", "pii_kind", "found"])

    rows = df.select(key, text).where(F.col(text).isNotNull() & F.col(key).isNotNull()).mapInPandas(run, f"row_id {kind}, pii_kind string, found string")
    return rows.distinct().select(F.lit(label).alias("source_table"), "row_id", "pii_kind", "found")


def redact(df: DataFrame, key: str, text: str, is_json: bool, model: PiiModel) -> DataFrame:
    """``key`` and redacted: every row's text with typed placeholders for what was found, the rest as it was.

    Rows are kept one for one; null stays null.  JSON stays JSON of the same shape (written anew where anything
    was replaced); a number that is a finding becomes its placeholder.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for p in batches:
            pieces = [values(t, is_json) if isinstance(t, str) else [] for t in p[text]]
            each = list(dict.fromkeys(v for own in pieces for v in own))
            done = {v: r for v, spans in zip(each, m.detect(each)) if (r := redact_text(v[0], spans)) != v[0]}  # all of a batch are scored together
            out = []
            for t, own in zip(p[text], pieces):
                if not any(v in done for v in own):
                    out.append(t if isinstance(t, str) else None)
                elif (t, "") in own and not (is_json and _is_json(t)):
                    out.append(done[t, ""])
                else:
                    out.append(json.dumps(_replaced(json.loads(t), done, ""), ensure_ascii=False))
            yield pd.DataFrame({key: p[key], "redacted": out})

    return df.select(key, text).mapInPandas(run, f"`{key}` {kind}, redacted string")
