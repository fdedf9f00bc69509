"""Personal details inside free text: found, and replaced by typed placeholders.

Method: weak supervision. Format patterns, a gazetteer and context cues vote on candidate spans; expectation
maximisation over the vote patterns of all candidates estimates how reliable each labeler is; a logistic span
classifier trained on the resulting probabilities decides.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinweave.plans.scratch import materialize

FIELDS = ("question", "answer", "focus")
#: First names up to which the gazetteer is sent to every executor; the rarer ones beyond it are joined to the rows whose texts hold them.
MOST_SENT_NAMES = 200_000
PLACEHOLDERS = {"email": "[REDACTED_EMAIL]", "phone": "[REDACTED_PHONE]", "id_number": "[REDACTED_ID_NUMBER]", "address": "[REDACTED_ADDRESS]", "name": "[REDACTED_NAME]"}
LABELERS = ("format", "context", "gazetteer", "contrary")

_AT = r"(?:\s?@\s?|\s?[\[({]\s?(?:at|@)\s?[\])}]\s?)"
_DOT = r"(?:\.|\s?[\[({]\s?(?:dot|\.)\s?[\])}]\s?)"
EMAIL = re.compile(rf"[A-Za-z0-9](?:[\w.+%'-]*[A-Za-z0-9_])?(?:{_AT}[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)*|\sat\s[A-Za-z0-9-]+(?:\sdot\s[A-Za-z0-9-]+)+)")
EMAIL_HINTS = ("@", "[at", "(at", "{at", "[ at", "( at", " dot ")
EMAIL_FULL = re.compile(rf"[\w.+%'-]+(?:{_AT}|\sat\s)[A-Za-z0-9-]+(?:(?:{_DOT}|\sdot\s)[A-Za-z0-9-]+)*(?:{_DOT}|\sdot\s)[A-Za-z]{{2,63}}")
EMAIL_CUE = re.compile(r"(?:e-?mail|mail|mailto|write|contact|reach|repl(?:y|ies)|results go|address|send|at|to)\W{0,4}(?:\w+\W+){0,3}$", re.I)

_SEP = r"[\s().\-‐-―/]"
DIGITS = re.compile(rf"(?<![\w@])(?:\+\s?|\((?=\d{{2,5}}\)))?\d(?:(?!\s[-‐-―/]\s){_SEP}{{0,3}}\d){{6,17}}(?!\w)(?:\s?(?:ext|x|extension)\b\.?\s?\d{{1,6}})?", re.I)
_DIGIT = r"(?:zero|oh|one|two|three|four|five|six|seven|eight|nine|double|triple)"
SPELLED = re.compile(rf"\b{_DIGIT}(?:[\s,.-]{{1,3}}{_DIGIT}){{5,15}}\b", re.I)
SPELLED_DIGITS = frozenset("zero oh one two three four five six seven eight nine double triple".split())
#: Usual ways to write telephone numbers.
PHONE_FORMATS = re.compile(
    r"(?:\+?1[\s.\-‐-―]?)?(?:\(\d{3}\)\s?|\d{3}[\s.\-‐-―])\d{3}[\s.\-‐-―]?\d{4}(?:\s?(?:ext|x|extension)\b\.?\s?\d+)?|(?:\+|00\s?)\d{1,3}(?:[\s.()\-‐-―]{0,3}\d{1,6}){2,6}"
    r"|0\d{2,5}[\s-]?\d{3}[\s-]?\d{3,4}|\d{10}|\(\d{2,4}\)\s?\d{3,5}[\s-]?\d{4}|\+1\(\d{3}\)\d{3}-\d{4}|\d{3}[\s.\-‐-―]\d{4}",
    re.I,
)
PHONE_CUE = re.compile(r"(?:\b(?:call\w*|tel|telephone|phone\w*|fax|ring|reach|line|mobile|cell|dial|text|whatsapp|hotline|number is|contact|or)\b[^.;\d]{0,18}|[(;,:–—-]\s*)$", re.I)
PHONE_CONTRARY = re.compile(r"\b(?:serial|lot|batch|ref|reference|ratio|code|version|model|part|rate|room|degrees|trial|isbn|grant|order|protocol|between|from)\b[^.;,]{0,12}$", re.I)

_LABEL = (
    r"(?:ssn|social security(?: (?:number|no|num))?|cpf(?:/mf)?|cnpj|nif|tin|tax(?:payer)?(?: (?:id|identification))?(?: (?:number|no|num))?|itin|national insurance(?: (?:number|no))?|nino"
    r"|medical record(?: (?:number|no|num))?|mrn|patient (?:id|identifier|number|no)|chart (?:number|no)|(?:health )?insurance(?: (?:member|policy))?(?: (?:id|number|no))?|member (?:id|number|no)"
    r"|policy (?:number|no)|nhs (?:number|no)|passport(?: (?:number|no))?|driv(?:er|ing)(?:['’]?s)? licen[cs]e(?: (?:number|no))?|licen[cs]e (?:number|no)|national id(?: (?:number|no))?|identity (?:card )?(?:number|no)|id (?:number|no)|pesel|dni|curp)"
)
_VALUE = r"[A-Z]{0,3}[\s-]?\d[\dA-Z]*(?:[\s.\-/‐-―]{1,2}[\dA-Z]*\d[\dA-Z]*){0,5}(?:[\s-][A-Z]\b)?"
ID_LABELLED = re.compile(rf"\b{_LABEL}\b\.?\s?(?:nº|n°|no\.?|#|is)?\s?[:=#]?\s?({_VALUE})(?!\w)", re.I)
ID_HINTS = frozenset(
    "ssn social cpf cnpj nif tin tax taxpayer itin insurance nino record mrn patient chart member policy nhs passport driver driving licence license licences national identity id pesel dni curp".split()
)
ID_BARE = re.compile(r"(?<![\w.-])(?:\d{3}-\d{2}-\d{4}|\d{3}\.\d{3}\.\d{3}-\d{2}|[A-CEGHJ-PR-TW-Z]{2}\s\d{2}\s\d{2}\s\d{2}\s[A-D])(?![\w-])")
#: Usual shapes of identity numbers.
ID_FORMATS = re.compile(
    r"\d{3}[-\s]?\d{2}[-\s]?\d{4}|\d{3}\.?\d{3}\.?\d{3}-?\d{2}|[A-Z]{2}\s?\d{2}\s?\d{2}\s?\d{2}\s?[A-D]|[A-Z]{1,3}[-\s]?\d{5,9}|[A-Z]\d{3}(?:[\s-]\d{3,4}){2}|\d{4}[-\s]\d{4}|\d{6,10}|\d{3}\s\d{3}\s\d{4}", re.I
)

_STREET = r"(?:street|st|avenue|ave|road|rd|lane|ln|drive|dr|court|ct|square|sq|terrace|ter|way|close|boulevard|blvd|place|pl|crescent|cres|parkway|pkwy|highway|hwy|row|walk|alley|grove|gardens|circle|cir|trail|loop|parade|mews|quay|esplanade|promenade|wharf|turnpike)"
ADDRESS = re.compile(
    rf"(?:\b(?:flat|apt|apartment|unit|suite|no)\.?\s?\d+[A-Za-z]?,\s*)?(?<![\w.,-])\d{{1,5}}\s?[A-Za-z]?,?\s(?:[NSEW]{{1,2}}\.?\s)?(?:[^\W\d_][\w'’-]*\s){{1,3}}{_STREET}\b\.?(?:,\s*(?:apt|apartment|unit|suite|flat|floor|#)\.?\s?\d+\w?)?"
    r"|\bp\.?\s?o\.?\s?box\s?#?\d+|\bpost(?:al|\soffice)?\sbox\s?\d+|\bpostfach\s\d+"
    r"|\b[^\W\d_]{3,}(?:stra(?:ß|ss)e|str\.|gasse|platz|allee|weg)\s\d+[a-z]?\b|\b(?:rua|avenida|av\.|calle|via|viale|rue|ulica|ul\.|plaza|piazza|corso|travessa)\s(?:[^\W\d_][\w'’-]*\s?){1,4},?\s(?:n[ºo°.]\s?)?\d+\b",
    re.I,
)
ADDRESS_HINTS = frozenset(
    "street st avenue ave road rd lane ln drive dr court ct square sq terrace ter way close boulevard blvd place pl crescent cres parkway pkwy highway hwy row walk alley grove gardens circle cir trail loop parade mews quay esplanade promenade wharf turnpike"
    " box postfach rua avenida av calle via viale rue ulica ul plaza piazza corso travessa".split()
)
ADDRESS_ENDS = ("straße", "strasse", "str", "gasse", "platz", "allee", "weg")
#: Where a number and a few words after it are a place, whatever the last word; the votes tell whether it is an address.
ADDRESS_PLACE = re.compile(
    r"\b(?:live[sd]?|living|moved|move|send|sent|mail(?:ed)?|deliver(?:ed)?|visit(?:s|ed)?|reside[sd]?|located|stay(?:s|ed)?)\b[^.;\d]{0,24}\b(?:at|to|in)\s"
    r"((?:(?:flat|apt|apartment|unit|suite|no)\.?\s?\d+[A-Za-z]?,\s*)?\d{1,5}[A-Za-z]?,?\s(?:[NSEW]{1,2}\.?\s)?[^\W\d_][\w'’-]+(?:\s[^\W\d_][\w'’-]+){1,2}?(?=[,.;)]|\s(?:was|is|has|and|for|from)\b|$)(?:,\s*(?:apt|apartment|unit|suite|flat|floor|#)\.?\s?\d+\w?)?)",
    re.I,
)
#: Words that count or measure, and so stand in no address.
MEASURES = frozenset("mg ml days weeks months years hours minutes people percent units is are was were has have can for of the and with adults families children patients times degrees".split())
ADDRESS_CUE = re.compile(r"(?:\b(?:live\w*|moved?|send|visit|address|reside\w*|located|home|at|to|mail)\b[^.;\d]{0,12}|[(;,–—-]\s*)$", re.I)
ADDRESS_CONTRARY = re.compile(r"^\W{0,2}(?:cohort|study|trial|scale|score|registry|survey|clinic|hospital)\b|^[^.]{0,3}\b(?:mg|percent|patients|people|adults)\b", re.I)
TOWN = re.compile(r",\s[A-Z][\w'’-]+(?:\s[A-Z][\w'’-]+)?")

_CAP = r"[A-ZÀ-ÖØ-Þ][\w'’]*[a-zß-öø-ÿ][\w'’]*(?:-[A-ZÀ-ÖØ-Þ][\w'’]+)*"
_NAME = rf"{_CAP}(?:\s(?:[A-ZÀ-ÖØ-Þ]\.\s)?{_CAP}){{0,3}}"
_KIN = "son|daughter|husband|wife|mother|father|brother|sister|aunt|uncle|cousin|nephew|niece|grandmother|grandfather|friend|neighbour|neighbor|partner|child|boy|girl|baby|roommate|colleague"
#: Words that must occur, and the pattern that takes the name from beside them.
NAME_CUES = [
    ("name surname contact kin", rf"\b(?i:patient(?:'s|’s)? name|name of (?:the )?patient|full name|surname|first name|last name|contact person|next of kin)\s?[:=-]\s?({_NAME}|[A-ZÀ-ÖØ-Þ'’-]{{2,}}(?:,?\s[A-ZÀ-ÖØ-Þ'’-]{{2,}}){{0,2}}|(?i:[^\W\d_]{{3,}}(?:\s[^\W\d_]{{3,}}){{0,2}}))"),
    ("name called named", rf"\b(?i:(?:my|his|her|their|the patient(?:'s|’s)?) name is|i am called|(?:is|was) called|named)\s({_NAME}|[^\W\d_]{{3,}}\s[^\W\d_]{{3,}})"),
    ("dr mr mrs ms miss prof professor doctor nurse sir madam frau herr señor señora madame monsieur", rf"\b(?i:dr|mr|mrs|ms|miss|prof|professor|doctor|nurse|sir|madam|frau|herr|señora?|madame|monsieur)\b\.?\s({_NAME}|[A-ZÀ-ÖØ-Þ]\.\s{_CAP})"),
    ("regards signed sincerely yours thanks best love from", rf"\b(?i:regards|signed|sincerely|yours|thanks|best|love|from)\s?[,:]\s?((?:[A-ZÀ-ÖØ-Þ]\.\s){{1,2}}{_CAP}|{_NAME}|(?i:[^\W\d_]\.\s[^\W\d_]{{3,}}))"),
    ("ask asked speak attention care", rf"\b(?i:ask(?:ed)? for|speak (?:to|with)|attention of|care of|c/o)\s({_NAME})"),
    (_KIN.replace("|", " "), rf"\b(?i:(?:my|our|her|his|their)(?: \w+)?) (?:{_KIN})\s({_CAP}(?:\s{_CAP})?)(?=\s(?:has|had|is|was|suffers|takes|got|also|and|will)\b|\W*$|,)"),
    ("patient", r"\b(?i:patient)\s([A-ZÀ-ÖØ-Þ'’-]{2,},\s[A-ZÀ-ÖØ-Þ'’-]{2,}(?:\s[A-Z]\.?)?)(?!\w)"),
    ("patient", rf"\b(?i:patient)\s({_CAP}\s{_CAP})(?=\s(?:was|is|has|had)\b)"),
    ("filled told wrote asked called signed phoned says said reported brought came lives visited complained mentioned sent recommended", rf"(?<![\w-])({_CAP}\s(?:[A-ZÀ-ÖØ-Þ]\.\s)?{_CAP})(?=,?\s(?:filled|told|wrote|asked|called|signed|phoned|says|said|reported|brought|came|lives|visited|complained|mentioned|sent|recommended)\b)"),
]
NAME_CUES = [(frozenset(hints.split()), re.compile(pattern)) for hints, pattern in NAME_CUES]
#: Cues beside which a name may stand in small letters: "name:", "name is", "signed,".
LOOSE_CUES = (0, 1, 3)
#: Words that a person's name does not have.
NOT_NAMES = frozenset(
    "disease disorder syndrome ataxia fever anemia palsy myopathy neuropathy dystrophy dysplasia deficiency trust center centre clinic clinics hospital society registry foundation college institute"
    " laboratory group network university road scale cohort study trial association department school ward service team committee council agency the a an this that what which who when where why how"
    " is was are were has have had can could does do if in on at by for with and or not no yes it its they we you he she my our your their his her visits visit required id number complex"
    " about stopped developed found told read last after before since during while although because until still also very mrs mr ms dr prof".split()
)
PLACEHOLDER = re.compile(r"[\[<{][A-Z][A-Z_ ]{3,40}[\]>}]")


@dataclass
class Gazetteer:
    """First names gathered from the corpus."""

    names: frozenset[str] = frozenset()

    def spans(self, text: str) -> Iterator[tuple[int, int]]:
        """The names of the gazetteer in a text, each with a capitalised word after it."""
        last = 0
        for w in WORDS.finditer(text):
            if w.group() in self.names and w.start() >= last and not BEFORE_NAME.search(text, max(0, w.start() - 1), w.start()):
                m = NAME_REST.match(text, w.end())
                if m:
                    last = m.end()
                    yield w.start(), last


Span = tuple[int, int, str, tuple[int, int, int, int]]


WORDS = re.compile(r"[^\W\d_]+")
BEFORE_NAME = re.compile(r"[\w@.+%'-]")
NAME_REST = re.compile(rf"(?:\s(?:[A-ZÀ-ÖØ-Þ]\.\s)?{_CAP})?(?![\w@+%])")


def _digits(text: str) -> int:
    return sum(map(text.count, "0123456789"))


def _names(text: str, gazetteer: Gazetteer, taken: list[tuple[int, int]], words_here: frozenset[str]) -> Iterator[Span]:
    spans = [(m.start(1), m.end(1), 1, n) for n, (hints, cue) in enumerate(NAME_CUES) if not hints.isdisjoint(words_here) for m in cue.finditer(text)]
    if not gazetteer.names.isdisjoint(WORDS.findall(text)):
        spans += [(start, end, 0, -1) for start, end in gazetteer.spans(text)]
    seen: set[tuple[int, int]] = set()
    for start, end, cued, n in spans:
        shown = text[start:end]
        words = [w.lower() for w in WORDS.findall(shown)]
        while words and words[-1] in NOT_NAMES and " " in shown:
            shown = shown[: shown.rfind(" ")]
            words = words[:-1]
        end = start + len(shown)
        if not words or (start, end) in seen or any(s < end and start < e for s, e in taken):
            continue
        seen.add((start, end))
        after = re.match(r"\s+([^\W\d_]+)", text[end : end + 24])
        follows = after.group(1).lower() if after else ""
        known = any(w in gazetteer.names or w.capitalize() in gazetteer.names for w in words)
        capital = shown[0].isupper()
        title_case = bool(after) and after.group(1)[0].isupper() and text[: start].rstrip()[-1:].isalpha() and WORDS.findall(text[:start])[-1][0].isupper() and not known
        contrary = not NOT_NAMES.isdisjoint(w for w in words if len(w) > 1) or (follows in NOT_NAMES and follows not in AFTER_NAMES) or re.search(r"\b(?:the|an?)\s$", text[max(0, start - 5) : start], re.I) or title_case
        shape = 1 if len(words) > 1 and (capital or n in LOOSE_CUES) else 0
        if not capital and not known and n not in LOOSE_CUES:
            shape = -1
        yield start, end, "name", (shape, cued, 1 if known else 0, -1 if contrary else 0)


#: Words of NOT_NAMES that may follow a name.
AFTER_NAMES = frozenset("is was has had are were have and can could does do if in on at by for with or not who it he she they we my visits visit id number about stopped developed found told read last after before since during while although because until still also".split())


def candidates(text: str, gazetteer: Gazetteer) -> list[Span]:
    """Candidate spans (start, end, type, votes of LABELERS: 1 for, -1 against, 0 silent) of one text."""
    out: list[Span] = []
    taken = [m.span() for m in PLACEHOLDER.finditer(text)] if "[" in text or "<" in text or "{" in text else []

    def free(start: int, end: int) -> bool:
        return not any(s < end and start < e for s, e in taken)

    low = text.lower()
    words_here = frozenset(WORDS.findall(low))
    digits = _digits(text)
    if any(h in low for h in EMAIL_HINTS):
        for m in EMAIL.finditer(text):
            if not free(*m.span()):
                continue
            full = EMAIL_FULL.fullmatch(m.group())
            cue = EMAIL_CUE.search(text[max(0, m.start() - 40) : m.start()])
            domain = re.split(r"\W+", m.group())[-1].lower()
            out.append((*m.span(), "email", (1 if full else -1, 1 if cue else 0, 1 if domain.isalpha() and full and len(domain) >= 2 else 0, 0 if full else -1)))
            if full:
                taken.append(m.span())
    if digits >= 4 and not ID_HINTS.isdisjoint(words_here):
        for m in ID_LABELLED.finditer(text):
            value = m.group(1)
            n = _digits(value)
            if free(*m.span(1)) and n >= 4:
                out.append((*m.span(1), "id_number", (1 if ID_FORMATS.fullmatch(value.strip()) else 0, 1, 1 if n >= 6 else 0, 0)))
                taken.append(m.span(1))
    if digits >= 7:
        for m in ID_BARE.finditer(text):
            if free(*m.span()):
                before = text[max(0, m.start() - 30) : m.start()]
                out.append((*m.span(), "id_number", (1, 0, 1, -1 if PHONE_CONTRARY.search(before) else 0)))
                taken.append(m.span())
        for m in DIGITS.finditer(text):
            shown = m.group()
            n = _digits(shown)
            if not free(*m.span()) or n < 7:
                continue
            before = text[max(0, m.start() - 40) : m.start()]
            fits = PHONE_FORMATS.fullmatch(shown.strip())
            contrary = PHONE_CONTRARY.search(before) or re.fullmatch(r"\s*(?:19|20)\d\d\s?[-–]\s?(?:19|20)\d\d", shown)
            out.append((*m.span(), "phone", (1 if fits and n >= 9 else 0 if fits else -1, 1 if PHONE_CUE.search(before) else 0, 1 if 10 <= n <= 15 else 0, -1 if contrary else 0)))
            if fits and not contrary:
                taken.append(m.span())
    if len(words_here & SPELLED_DIGITS) >= 2:
        for m in SPELLED.finditer(text):
            if free(*m.span()):
                cue = PHONE_CUE.search(text[max(0, m.start() - 40) : m.start()])
                out.append((*m.span(), "phone", (1, 1 if cue else 0, 0, 0)))
                taken.append(m.span())
    if digits and (not ADDRESS_HINTS.isdisjoint(words_here) or any(w.endswith(ADDRESS_ENDS) for w in words_here)):
        for m in ADDRESS.finditer(text):
            if not free(*m.span()):
                continue
            town = TOWN.match(text, m.end())
            end = town.end() if town else m.end()
            before, after = text[max(0, m.start() - 40) : m.start()], text[m.end() : m.end() + 30]
            inside = {w.lower() for w in WORDS.findall(m.group())}
            contrary = (not m.group().endswith(".") and ADDRESS_CONTRARY.search(after)) or not MEASURES.isdisjoint(inside)
            out.append((m.start(), end, "address", (1, 1 if ADDRESS_CUE.search(before) else 0, 1 if town or re.search(r"(?i)\b(?:apt|suite|unit|flat|box)\b", m.group()) else 0, -1 if contrary else 0)))
            if not contrary:
                taken.append((m.start(), end))
    if digits:
        for m in ADDRESS_PLACE.finditer(text):
            if free(*m.span(1)):
                town = TOWN.match(text, m.end(1))
                shown = m.group(1)
                contrary = not MEASURES.isdisjoint(w.lower() for w in WORDS.findall(shown))
                part = town or re.search(r"(?i)\b(?:apt|suite|unit|flat|floor)\b", shown)
                out.append((m.start(1), town.end() if town else m.end(1), "address", (0, 1, 1 if part else 0, -1 if contrary else 0)))
                if not contrary:
                    taken.append((m.start(1), town.end() if town else m.end(1)))
    out += _names(text, gazetteer, taken, words_here)
    return out


def reliabilities(patterns: dict[tuple[int, ...], float], rounds: int = 60) -> tuple[np.ndarray, np.ndarray, float]:
    """Expectation maximisation over vote patterns and their counts: log P(vote | class) per labeler, the posteriors, the prior.

    Labelers are taken as independent given the class. The start says that more votes for than against mean a hit.
    """
    keys = sorted(patterns)
    votes = np.array(keys, int)
    weight = np.array([patterns[k] for k in keys], float)
    belief = 1 / (1 + np.exp(-1.5 * (votes.sum(axis=1) - 0.5)))
    logs = np.zeros((2, votes.shape[1], 3))
    prior = 0.5
    for _ in range(rounds):
        for c, share in enumerate((1 - belief, belief)):
            for j in range(votes.shape[1]):
                for v in (-1, 0, 1):
                    # votes for are likelier on hits and votes against on the rest, before any is counted
                    lean = 3.0 if (v == 1) == (c == 1) and v else 1.0
                    logs[c, j, v + 1] = np.log((share * weight)[votes[:, j] == v].sum() + lean)
                logs[c, j] -= np.log(np.exp(logs[c, j]).sum())
        prior = float(np.clip((belief * weight).sum() / weight.sum(), 0.02, 0.98))
        scores = [sum(logs[c, j][votes[:, j] + 1] for j in range(votes.shape[1])) for c in (0, 1)]
        odds = np.log(prior / (1 - prior)) + scores[1] - scores[0]
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        if np.abs(new - belief).max() < 1e-6:
            break
        belief = new
    return logs, belief, prior


def shape(shown: str) -> tuple[int, int, bool]:
    """Digits (16 for more), words (6 for more) and whether it begins with a capital."""
    return min(_digits(shown), 16), min(len(shown.split()), 6), shown[:1].isupper()


def features(kind: str, votes: tuple[int, ...], shown: str | tuple[int, int, bool]) -> list[str]:
    """What the span classifier sees of a candidate, given by its text or the text's shape."""
    digits, words, capital = shape(shown) if isinstance(shown, str) else shown
    return [f"{kind}", *(f"{kind} {name} {v}" for name, v in zip(LABELERS, votes, strict=True)), f"{kind} digits {digits}", f"{kind} words {words}", f"{kind} capital {capital}"]


@dataclass
class SpanModel:
    weights: dict[str, float] = field(default_factory=dict)

    def probability(self, kind: str, votes: tuple[int, ...], shown: str) -> float:
        z = sum(self.weights.get(f, 0.0) for f in features(kind, votes, shown))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def train(rows: list[tuple[list[str], float, int]], rounds: int = 300, rate: float = 0.5, decay: float = 1e-3) -> SpanModel:
    """Logistic regression on soft labels, each with the number of its candidates, by full-batch gradient steps; equal features are merged first."""
    merged: dict[tuple[str, ...], list[float]] = {}
    for f, p, times in rows:
        total = merged.setdefault(tuple(f), [0.0, 0.0])
        total[0] += times
        total[1] += p * times
    names = sorted({x for f in merged for x in f})
    at = {x: i for i, x in enumerate(names)}
    x = np.zeros((len(merged), len(names)))
    for i, f in enumerate(merged):
        x[i, [at[y] for y in f]] = 1
    n = np.array([t[0] for t in merged.values()])
    y = np.array([t[1] / t[0] for t in merged.values()])
    n = np.sqrt(n) / np.sqrt(n).sum()
    w = np.zeros(len(names))
    grown = np.full(len(names), 1e-8)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-x @ w))
        g = x.T @ (n * (p - y)) + decay * w
        grown += g * g
        w -= rate * g / np.sqrt(grown)
    return SpanModel(dict(zip(names, w.tolist(), strict=True)))


def first_names(records: DataFrame) -> DataFrame:
    """(name, n) of the first names that stand in a name's context at least twice in the texts of all rows."""
    nobody = Gazetteer()

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: Counter = Counter()
            for column in range(len(FIELDS)):
                for text in b.column(column).to_pylist():
                    for start, end, _, votes in _names(text or "", nobody, [], frozenset(WORDS.findall((text or "").lower()))):
                        words = WORDS.findall(text[start:end])
                        if votes[1] == 1 and votes[3] == 0 and len(words) > 1:
                            name = words[-1] if "," in text[start:end] else words[0]
                            if len(name) > 2:
                                out[name.capitalize()] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(out.keys()), pa.string()), pa.array(list(out.values()), pa.int64())], names=["name", "n"])

    return records.select(*FIELDS).mapInArrow(count, "name string, n bigint").groupBy("name").agg(F.sum("n").alias("n")).filter("n >= 2")


def gather_gazetteer(records: DataFrame) -> tuple[Gazetteer, DataFrame | None]:
    """The MOST_SENT_NAMES most frequent first names and, if there are more, (row_id, own) with the others that the texts of a row hold."""
    names = materialize(first_names(records), "first-names")
    order = [F.desc("n"), F.asc("name")]
    sent = Gazetteer(frozenset(r.name for r in names.orderBy(*order).limit(MOST_SENT_NAMES).collect()))
    if names.count() <= MOST_SENT_NAMES:
        return sent, None

    def words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids: list[int] = []
            own: list[str] = []
            for i, *texts in zip(*(c.to_pylist() for c in b.columns), strict=True):
                here = {w.capitalize() for t in texts for w in WORDS.findall(t or "")}
                own += here
                ids += [i] * len(here)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(own, pa.string())], names=["row_id", "name"])

    rest = names.join(names.orderBy(*order).limit(MOST_SENT_NAMES).select("name"), "name", "left_anti")
    held = records.select(F.col("row_id").cast("long").alias("row_id"), *FIELDS).mapInArrow(words, "row_id bigint, name string")
    return sent, held.join(rest.select("name"), "name").groupBy("row_id").agg(F.collect_list("name").alias("own"))


SPANS = "row_id bigint, field_name string, start int, stop int, pii_type string, votes array<tinyint>, shown string, digits int, words int, capital boolean"


def _with_names(records: DataFrame, own: DataFrame | None) -> DataFrame:
    rows = records.select(F.col("row_id").cast("long").alias("row_id"), *FIELDS)
    return rows if own is None else rows.join(own, "row_id", "left")


def _candidates_of(batch: pa.RecordBatch, gazetteer: Gazetteer) -> list[tuple]:
    """(row, field, start, stop, type, votes) of each candidate of a batch of row_id, the fields and perhaps further names of each row."""
    texts = [batch.column(i).to_pylist() for i in range(1, 1 + len(FIELDS))]
    more = batch.column(1 + len(FIELDS)).to_pylist() if batch.num_columns > 1 + len(FIELDS) else [None] * batch.num_rows
    out = []
    for row, own in enumerate(more):
        names = gazetteer
        if own:
            names = Gazetteer(frozenset(own) | gazetteer.names.intersection(w.capitalize() for t in texts for w in WORDS.findall(t[row] or "")))
        for column, t in enumerate(texts):
            if t[row]:
                out += [(row, column, s, e, kind, votes) for s, e, kind, votes in candidates(t[row], names)]
    return out


def candidate_spans(records: DataFrame, gazetteer: Gazetteer, own: DataFrame | None = None) -> DataFrame:
    """Candidates of all rows and fields with their votes; ``own`` has further names of the gazetteer by row_id."""
    sent = records.sparkSession.sparkContext.broadcast(gazetteer)

    def label(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_pylist()
            rows = []
            for r, c, s, e, kind, votes in _candidates_of(b, sent.value):
                shown = b.column(1 + c)[r].as_py()[s:e]
                rows.append((ids[r], FIELDS[c], s, e, kind, list(votes), shown, *shape(shown)))
            columns = list(zip(*rows, strict=True)) or [()] * 10
            types = (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.list_(pa.int8()), pa.string(), pa.int32(), pa.int32(), pa.bool_())
            names = ["row_id", "field_name", "start", "stop", "pii_type", "votes", "shown", "digits", "words", "capital"]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=names)

    return _with_names(records, own).mapInArrow(label, SPANS)


def fit_spans(spans: DataFrame) -> SpanModel:
    """Reliabilities from the vote patterns of all candidates, then the classifier on all candidates.

    Candidates with the same type, votes and shape are alike to the classifier, so only their counts reach the driver:
    at most 5 types x 3 ** labelers votes x 17 x 7 x 2 shapes.
    """
    counts = spans.groupBy("pii_type", "votes", "digits", "words", "capital").agg(F.count("*").alias("n")).collect()
    belief: dict[tuple, float] = {}
    for kind in {r.pii_type for r in counts}:
        patterns: dict[tuple[int, ...], float] = {}
        for r in counts:
            if r.pii_type == kind:
                patterns[tuple(r.votes)] = patterns.get(tuple(r.votes), 0.0) + r.n
        _, posterior, _ = reliabilities(patterns)
        belief |= {(kind, k): float(p) for k, p in zip(sorted(patterns), posterior, strict=True)}
    if not counts:
        return SpanModel()
    return train([(features(r.pii_type, tuple(r.votes), (r.digits, r.words, r.capital)), belief[r.pii_type, tuple(r.votes)], r.n) for r in counts])


def accepted_spans(records: DataFrame, model: SpanModel | None = None, gazetteer: Gazetteer | None = None) -> DataFrame:
    """Spans judged personal: row_id, field_name, start, stop (code points, end exclusive) and pii_type.

    ``records`` needs row_id, question, answer and focus; other columns are ignored. Null and empty texts have none;
    placeholders already set are left alone. Texts are read whole.
    """
    spans = materialize(candidate_spans(records, *((gazetteer,) if gazetteer else gather_gazetteer(records))), "pii-candidates")
    sent = records.sparkSession.sparkContext.broadcast(model or fit_spans(spans))

    def decide(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kinds, votes, shown = (b.column(i).to_pylist() for i in (4, 5, 6))
            keep = [sent.value.probability(k, tuple(v), s) >= 0.5 for k, v, s in zip(kinds, votes, shown, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(i) for i in range(5)], names=["row_id", "field_name", "start", "stop", "pii_type"]).filter(pa.array(keep, pa.bool_()))

    return spans.mapInArrow(decide, "row_id bigint, field_name string, start int, stop int, pii_type string")


def found_types(records: DataFrame) -> DataFrame:
    """(row_id, field_name, pii_type), distinct."""
    return accepted_spans(records).select("row_id", "field_name", "pii_type").distinct()


def redact(records: DataFrame, model: SpanModel | None = None, gazetteer: Gazetteer | None = None) -> DataFrame:
    """row_id, question, answer and focus with each span judged personal replaced by its placeholder; null stays null.

    Once the model is fitted, spans are found, judged and replaced in one pass over the rows; no text is shuffled,
    unless there are more first names than are sent to every executor. Of overlapping spans the first holds.
    """
    names = (gazetteer, None) if gazetteer else gather_gazetteer(records)
    fitted = model or fit_spans(materialize(candidate_spans(records, *names), "pii-candidates"))
    sent = records.sparkSession.sparkContext.broadcast((names[0], fitted))

    def replace(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, judge = sent.value
        for b in batches:
            texts = [b.column(1 + c).to_pylist() for c in range(len(FIELDS))]
            spans: dict[tuple[int, int], list[tuple[int, int, str]]] = {}
            for r, c, start, stop, kind, votes in _candidates_of(b, known):
                if judge.probability(kind, votes, texts[c][r][start:stop]) >= 0.5:
                    spans.setdefault((r, c), []).append((start, -stop, kind))
            for (r, c), own in spans.items():
                text, out, at = texts[c][r], [], 0
                for start, stop, kind in sorted(own):
                    if start >= at:
                        out += [text[at:start], PLACEHOLDERS[kind]]
                        at = -stop
                texts[c][r] = "".join(out) + text[at:]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(t, pa.string()) for t in texts)], names=["row_id", *FIELDS])

    return _with_names(records, names[1]).mapInArrow(replace, "row_id bigint, question string, answer string, focus string")


def redaction_report(records: DataFrame, spans: DataFrame | None = None) -> DataFrame:
    """Rows and spans found per field and type."""
    spans = accepted_spans(records) if spans is None else spans
    return spans.groupBy("field_name", "pii_type").agg(F.countDistinct("row_id").alias("n_rows"), F.count("*").alias("n_spans"))
