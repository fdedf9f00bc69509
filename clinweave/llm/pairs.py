"""Broken prompt and response pairs: which answers fail their question, and how.

Method: a pushdown parser over fences, brackets, quotations, lists and markup finds what is left open; greedy string
tiling against the question finds echoes; script and language checks compare both fields; a refusal grammar finds
declined answers. Whether an answer without closing punctuation is broken off is judged by a classifier over its
last words, fitted on sentences of the corpus and the same sentences cut short.
"""

from __future__ import annotations

import heapq
import html
import itertools
import math
import random
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows from which the end-of-sentence model, and for each language (a label of two letters, so 676 at most) the language model, are fitted.
TAIL_SAMPLE = 6_000
LANGUAGE_SAMPLE = 400

# Frequent function words of the languages known beforehand.
FUNCTION_WORDS = {
    "en": "the of and is are to in for with what how when which can does who there it that from not be about should why",
    "es": "el la los las de que y en con para una por del se es como no puede más qué cómo un su si durante",
    "pt": "o a os as de que e em com para uma por do da se é como não pode mais quais ou um após dos",
    "fr": "le la les des de et est une un pour avec dans que qui du au sont pas plus par ou se peut quels il",
    "it": "il la le gli di che e è una un per con del della non può più quali sono si dopo i dei al ma",
    "de": "der die das und ist eine ein für mit von den bei nicht zu auf dem nach oder wie welche man durch im sich es",
    "pl": "jest nie się na w z i do to po jak który przez oraz dla są co od może ma lub ale czy jakie które",
}

# First code points of blocks that tell scripts apart.
SCRIPTS = [
    (0x41, "latin"), (0x370, "greek"), (0x400, "cyrillic"), (0x530, "armenian"), (0x590, "hebrew"), (0x600, "arabic"), (0x780, "other"),
    (0x900, "devanagari"), (0x980, "indic"), (0xE00, "thai"), (0xE80, "other"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"),
    (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3100, "han"), (0xAC00, "hangul"), (0xD800, "other"), (0xFF21, "latin"), (0xFF66, "kana"),
]

WORD = re.compile(r"[^\W_]+")
MARKUP = re.compile(r"<!--.*?-->|</?[A-Za-z][^<>]*>", re.S)
INVISIBLE = re.compile("[­​-‏ -‮⁠-⁤﻿]")

#: Answers that only stand in for one, after case and punctuation are gone.
STAND_IN = re.compile(
    r"(?:(?:the )?(?:answer|response|reply|a)(?: is)? )?(?:"
    r"n ?a|nan|none|null|nil|void|undefined|tb[adc]|to ?do|to be (?:added|answered|completed|confirmed|determined|done|provided|supplied)"
    r"|(?:currently |still )?(?:no|not?|without)(?: an?)?(?: \w+){0,2} ?(?:answer|answers|response|reply|text|data|content|information|available|provided|given|applicable|found|known|specified|supplied|recorded|stated|yet)"
    r"|not (?:available|applicable|provided|given|known|specified|supplied|answered|recorded|stated|found)(?: yet)?|unanswered|unavailable|unspecified"
    r"|blank|empty|missing|pending|placeholder|coming soon|left (?:blank|empty)|(?:intentionally|deliberately) left (?:blank|empty)|no|x{2,}|lorem ipsum"
    r"|answer|response|reply|answer here|insert answer(?: here)?|see (?:above|below)|ditto|same as above|error|false|unknown|object object|br|nbsp"
    r")(?: (?:answer|response|here|yet))?"
)

_SAY = (
    r"(?:answer\w*|respon\w+|repl(?:y|ies|ying)|help\w*|assist\w*|advi[sc]e\w*|comment\w*|discuss\w*|provid\w+|giv\w+|offer\w*|shar\w+|say|speak|talk"
    r"|tell|address\w*|guid\w+|recommend\w*|suggest\w*|diagnos\w*|engag\w*|continu\w*|complet\w*|do (?:that|this|so)|weigh in|go into|opinion|view|engage|fulfil\w*|proceed)"
)
_WHO = r"(?:i|we|this (?:assistant|service|system|model|tool|chat\w*|program\w*)|the (?:assistant|service|system|model|tool))"
_NOT = (
    r"(?:ca ?nnot|cant|can not|could not|couldnt|wont|will not|would not|wouldnt|do not|dont|am not|are not|arent|isnt|is not|must not|may not|shall not|am unable|are unable|unable"
    r"|would rather not|d rather not|rather not|prefer not|would prefer not|d prefer not)"
)
#: The refusal grammar, over lower-case words without apostrophes.
REFUSAL = re.compile(
    "|".join(
        (
            rf"\b{_WHO}(?: \w+){{0,2}} {_NOT}(?: (?!but\b)\w+){{0,6}}? {_SAY}\b",
            rf"\bid (?:rather|prefer) not(?: to)?(?: \w+){{0,3}}? {_SAY}\b",
            rf"\b(?:im|i am|we are|were)(?: \w+){{0,2}} (?:unable|not able|not (?:allowed|permitted|authori[sz]ed|qualified|comfortable|prepared|willing|licensed|equipped|programmed|trained|in a position))(?: \w+){{0,4}}? {_SAY}\b",
            r"\b(?:i|we) (?:must|have to|need to|will have to|would have to|am going to|am forced to)(?: \w+)? (?:decline|pass|refuse|refrain|abstain)\b",
            rf"\b(?:i|we) (?:\w+ )?(?:decline|refuse|refrain)(?: \w+){{0,3}}? {_SAY}\b",
            rf"\b(?:not|dont|doesnt)(?: \w+)? (?:feel )?(?:comfortable|able|allowed|permitted|at liberty|in a position)(?: \w+){{0,2}}? {_SAY}\b(?! \w+ \w+ruled)",
            rf"\b(?:no|not any) (?:\w+ )?(?:guidance|advice|answer|information|help|comment|opinion|response|recommendation)s?(?: \w+){{0,8}}? (?:can|may|will|could) be {_SAY}",
            r"\b(?:falls?|is|lies|goes) (?:outside|beyond|out of|against)(?: of)?(?: \w+){0,5}? (?:allowed|permitted|scope|able|policy|policies|guidelines|rules|remit|can)\b",
            rf"\b{_SAY}(?: \w+){{0,3}} (?:is|would be|goes|are) (?:against|outside|not permitted|not allowed|prohibited|forbidden)\b",
            rf"\b(?:would|is|be) not (?:be )?(?:appropriate|right|proper|responsible|safe|suitable|possible|ethical)(?: for (?:me|us|this \w+))?(?: to)?(?: \w+){{0,2}}? {_SAY}\b",
            rf"\b(?:would be|is) (?:inappropriate|improper|irresponsible|unsafe|unethical)(?: \w+){{0,4}}? {_SAY}\b",
            r"\b(?:no comment|i pass on this|request (?:has been |was |is )?(?:denied|declined|refused|blocked)|cannot comply|cant comply|unable to comply|cannot fulfil\w*|cant fulfil\w*)\b",
            rf"\bas an? (?:\w+ ){{0,3}}(?:ai|assistant|language model|chatbot|bot|machine|computer program)\b(?: \w+){{0,8}}? (?:{_NOT}|unable|decline|not)\b",
            rf"\bnot able to {_SAY}(?: \w+){{0,3}} (?:question|questions|request|this|that)\b",
            r"\b(?:no puedo|no podemos|lo siento pero no|no es posible) (?:\w+ ){0,2}(?:responder|contestar|ayudar|dar|ofrecer|comentar|aconsejar)\w*",
            r"\b(?:não posso|não podemos|lamento mas não) (?:\w+ ){0,2}(?:responder|ajudar|dar|oferecer|comentar|aconselhar)\w*",
            r"\b(?:je ne peux pas|nous ne pouvons pas|je ne suis pas en mesure|je suis désolée? mais je ne) (?:\w+ ){0,3}(?:répondre|aider|donner|fournir|commenter|conseiller)",
            r"\b(?:non posso|non possiamo|mi dispiace ma non) (?:\w+ ){0,2}(?:rispondere|aiutar\w*|dare|fornire|commentare|consigliar\w*)",
            r"\b(?:ich kann|wir können|leider kann ich|leider können wir)(?: \w+){0,8} nicht (?:beantworten|antworten|helfen|geben|weiterhelfen|beraten|sagen)",
            r"\b(?:nie mogę|nie możemy|przykro mi ale nie) (?:\w+ ){0,2}(?:odpowiedzieć|odpowiadać|pomóc|udzielić|udzielać|doradzić|komentować)",
        )
    )
)
#: Words without which the grammar cannot match; most answers have none of them.
REFUSAL_HINTS = frozenset(
    "i we im id assistant service system model tool chatbot bot computer machine request requests policy policies guidelines rules remit scope allowed permitted"
    " comment decline refuse appropriate right proper responsible safe suitable possible ethical inappropriate improper irresponsible unsafe unethical prohibited"
    " forbidden against outside guidance advice answer information opinion response recommendation help comply fulfil comfortable able liberty"
    " puedo podemos posible siento posso podemos lamento possiamo dispiace peux pouvons suis kann können mogę możemy przykro".split()
)

# Pairs that open and close.
PAIRS = {"(": ")", "[": "]", "{": "}", "“": "”", "«": "»", "„": "“”", "‹": "›", "「": "」", "（": "）", "【": "】"}
CLOSERS = frozenset("".join(PAIRS.values()))
VOID_TAGS = frozenset("br hr img input meta link wbr col area base source track embed param".split())
#: What begins an item: a bullet or number at a line's start, or a number in brackets or with a stop inside a line.
ITEM = re.compile(r"(?:^|\n)[ \t]*(?:[-*•·+]|(\d{1,3})[.)]|[a-z]\))(?=\s|$)|(?<=[\s:;,])\(?(\d{1,2})[.)](?=\s|$)")
# Numbers in words.
NUMBERS = {w: n for n, w in enumerate("two three four five six seven eight nine ten".split(), 2)}
#: A number of things to come, before a colon.
ANNOUNCED = re.compile(rf"\b({'|'.join(NUMBERS)}|[2-9]|1\d)(?: \w+){{0,3}}? (?:steps|reasons|signs|ways|things|points|types|kinds|forms|stages|symptoms|causes|tests|options|rules|parts|phases|tips|groups|measures|items|questions)\b[^.!?:\n]*:\s", re.I)
TOKENS = re.compile(r"```|~~~|\*\*|__|`|<(/?)([A-Za-z][A-Za-z0-9]*)([^<>]*)>|[()\[\]{}“”«»„‹›「」（）【】\"]|(?<![A-Za-z0-9])[:;]-?[()]")
MARKS = re.compile(r"[`~*_<()\[\]{}“”«»„‹›「」（）【】\"]")
#: What a text that was broken off, or cut by a tool, ends with.
BROKEN_END = re.compile(
    r"(?:…|\.\.\.|\[\s*…?|\b(?:continued?|cont|read more|see more|show more|more|truncated|cut off|to be continued)[\].:…)]*|[,:;/&+=(\[{<“„«–—]|\s-|\(\s*[\w ]{0,24}|\b(?:including|for example|such as|e\.g\.?|i\.e\.?|namely|like|so-called))\s*$",
    re.I,
)
BROKEN_OFF = re.compile(r"[\[(]\s*(?:continued?|cont\.?|more|truncated|…)[^\])]{0,40}$|(?<=\s)\[…?$|\b(?:to be continued|read more|show more|see more)\W{0,9}$", re.I)
END_REACH = 80


def list_left_open(text: str) -> str | None:
    """``item`` if the text ends with an item that says nothing, ``list`` if fewer items follow than were announced, else None.

    The parser's state of lists: an item ends the one before it. A number inside a line begins an item only if it
    continues the count of the items before, or is 1, so that "in 30." and "(2)" alone are no items.
    """
    last = None
    inline = 0  # the number of the last item inside a line
    starts = []
    for m in ITEM.finditer(text):
        if m.group(2):
            if int(m.group(2)) not in (1, inline + 1):
                continue
            inline = int(m.group(2))
        elif m.group(1):
            inline = int(m.group(1))
        last = m
        starts.append(m.start())
    if last is None or (last.group(2) and inline == 1 and len(starts) == 1 and text[last.start() : last.end()].endswith(".")):
        return None
    if not WORD.search(text, last.end()):
        return "item"
    told = ANNOUNCED.search(text)
    if told:
        word = told.group(1).lower()
        after = sum(at >= told.end() - 1 for at in starts)
        if 0 < after < (NUMBERS.get(word) or int(word)):
            return "list"
    return None


def left_open(text: str) -> list[str]:
    """What a pushdown parser finds open at the text's end: fences, brackets, quotations, markup, lists; the outermost first.

    A closer without its opener is ignored. Inside a fence everything but the fence is plain. Straight quotation
    marks and doubled stars toggle; a mark after a digit is an inch sign. Face marks such as :( are no brackets.
    """
    stack = _marks_left_open(text)
    unfinished = None if any(o in ("```", "~~~", "`") for o in stack) else list_left_open(text)
    return [*stack, unfinished] if unfinished else stack


def _marks_left_open(text: str) -> list[str]:
    stack: list[str] = []
    if not MARKS.search(text):
        return stack
    for m in TOKENS.finditer(text):
        t = m.group()
        if stack and stack[-1] in ("```", "~~~", "`") and t != stack[-1]:
            continue
        if t in ("```", "~~~", "**", "__", "`", '"'):
            if t == '"' and m.start() and text[m.start() - 1].isdigit() and t not in stack:
                continue
            if t == "__" and text[m.start() - 1 : m.start()].isalnum() and text[m.end() : m.end() + 1].isalnum():
                continue
            if t in stack:
                del stack[len(stack) - 1 - stack[::-1].index(t) :]
            else:
                stack.append(t)
        elif m.group(2):
            tag = "<" + m.group(2).lower()
            if m.group(1):
                if tag in stack:
                    del stack[len(stack) - 1 - stack[::-1].index(tag) :]
            elif tag[1:] not in VOID_TAGS and not m.group(3).rstrip().endswith("/"):
                stack.append(tag)
        elif len(t) > 1:
            continue
        elif any(t in PAIRS.get(o, "") for o in stack) and (t not in PAIRS or t == "“"):
            while stack and t not in PAIRS.get(stack.pop(), ""):
                pass
        elif t in PAIRS:
            stack.append(t)
    return stack


def tiles(question: list[str], answer: list[str], least: int = 2) -> tuple[int, int]:
    """Greedy string tiling: (answer words covered, question words used) by the longest common runs of at least ``least`` words.

    The longest run is marked first, then the next longest among unmarked words. Question words stay usable, so
    that a question said twice is covered twice.
    """
    where: dict[str, list[int]] = {}
    for j, w in enumerate(question):
        where.setdefault(w, []).append(j)
    runs: list[tuple[int, int, int]] = []  # (-length, place in the answer, place in the question) of maximal runs
    before: dict[int, int] = {}
    for i, w in enumerate([*answer, None]):
        now = {j: before.get(j - 1, 0) + 1 for j in where.get(w, ())} if w is not None else {}
        runs += [(-n, i - n, j - n + 1) for j, n in before.items() if n >= least and j + 1 not in now]
        before = now
    heapq.heapify(runs)
    marked, used = [False] * len(answer), [False] * len(question)
    while runs:
        n, i, j = heapq.heappop(runs)
        free = [k for k in range(i, i - n) if not marked[k]]
        if len(free) == -n:
            marked[i : i - n] = [True] * -n
            used[j : j - n] = [True] * -n
            continue
        for _, part in itertools.groupby(enumerate(free), lambda x: x[1] - x[0]):  # what is left of the run, in its turn
            places = [k for _, k in part]
            if len(places) >= least:
                heapq.heappush(runs, (-len(places), places[0], j + places[0] - i))
    return sum(marked), sum(used)


def is_echo(question: list[str], answer: list[str]) -> bool:
    """Whether the answer says only the question again, perhaps after a short lead-in; spacing and punctuation are free."""
    if not answer:
        return False
    q, a = "".join(question), "".join(answer)
    if q == a:
        return True
    if len(question) < 3:
        return False
    if len(q) > 12 and q in a and len(a) - a.count(q) * len(q) <= 30 and len(a.replace(q, " ").split()) <= 3:
        return True
    if len(set(answer) & set(question)) < 0.5 * len(set(answer)):
        return False
    covered, used = tiles(question, answer)
    return covered >= 0.75 * len(answer) and used >= 0.7 * len(question) and len(answer) - covered <= 8


def script_of(text: str) -> str | None:
    """The script of most letters; None without letters."""
    from bisect import bisect

    if text.isascii():
        return "latin" if any(c.isalpha() for c in text) else None
    starts = [s for s, _ in SCRIPTS]
    counts = Counter(SCRIPTS[bisect(starts, ord(c)) - 1][1] for c in text if c.isalpha())
    return max(sorted(counts), key=lambda s: counts[s]) if counts else None


@dataclass
class Languages:
    """Word likelihoods by language: a row of the table per known word."""

    names: list[str] = field(default_factory=list)
    rows: dict[str, int] = field(default_factory=dict)
    table: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))

    @staticmethod
    def fit(rows: Iterable[tuple[str, list[str]]]) -> Languages:
        counts = {lang: Counter({w: 5.0 for w in words.split()}) for lang, words in FUNCTION_WORDS.items()}
        seen: dict[str, Counter] = {}
        for lang, words in rows:
            seen.setdefault(lang, Counter()).update(set(words))
        for lang, c in seen.items():
            total = sum(c.values()) or 1
            counts.setdefault(lang, Counter()).update({w: 400.0 * n / total for w, n in c.items() if n >= 2})
        totals = {lang: sum(c.values()) + 100 for lang, c in counts.items()}
        vocabulary = {w for c in counts.values() for w in c}
        names, words = sorted(counts), sorted(vocabulary)
        table = np.log([[(counts[lang].get(w, 0) + 0.05) / totals[lang] for lang in names] for w in words])
        return Languages(names, {w: i for i, w in enumerate(words)}, table)

    def scores(self, words: list[str]) -> np.ndarray | None:
        """Log likelihoods of the known words in the order of ``names``; None with fewer than two of them."""
        at = [i for i in map(self.rows.get, words) if i is not None]
        return self.table[at].sum(axis=0) if len(at) >= 2 else None


SENTENCE_END = re.compile(r"(?<=[.!?。！？])[\"”’)»*]*\s+|\n+\s*(?:[-*•·]|\d+[.)])?\s*|<[^<>]*>")


def _tail_features(words: list[str], opening: list[str]) -> list[str]:
    last = words[-3:]
    start = " ".join(opening[:2])
    out = [f"1 {last[-1]}", f"2 {' '.join(last[-2:])}", f"3 {' '.join(last)}", f"o {start} | {last[-1]}"]
    return out


@dataclass
class Tails:
    """Log odds that words end a sentence rather than stand where it was cut."""

    odds: dict[str, float] = field(default_factory=dict)
    words: frozenset[str] = frozenset()
    final: frozenset[str] = frozenset()

    def shape(self, text: str) -> list[str]:
        out = []
        for w in WORD.findall(text):
            low = w.lower()
            out.append(low if low in self.words else "#" if w.isdigit() else "^" if w[0].isupper() else "?")
        return out

    @staticmethod
    def fit(sentences: list[str], seed: int = 7) -> Tails:
        rng = random.Random(seed)
        counts = Counter(w.lower() for s in sentences for w in WORD.findall(s))
        model = Tails(words=frozenset(w for w, n in counts.items() if n >= 4 and not w.isdigit()))
        good: Counter = Counter()
        bad: Counter = Counter()
        for s in sentences:
            whole = model.shape(s)
            if len(whole) < 2:
                continue
            good.update(_tail_features(whole, whole))
            body = s.rstrip(".!?")
            for _ in range(2):
                cut = rng.randrange(max(2, len(body) // 8), max(3, len(body) - 1))
                part = model.shape(body[:cut].rstrip())
                if part and part != whole:
                    bad.update(_tail_features(part, whole))
        scale = sum(bad.values()) / max(1, sum(good.values()))
        model.odds = {f: math.log((scale * good[f] + 0.5) / (bad[f] + 0.5)) for f in good.keys() | bad.keys()}
        ends = Counter(f for f in good.elements() if f.startswith("1 "))
        model.final = frozenset(f[2:] for f, n in ends.items() if n >= 2)
        return model

    def score(self, sentence: str) -> float:
        """Above zero for a sentence that ends where it should."""
        words = self.shape(sentence)
        if not words:
            return 0.0
        total = sum(self.odds.get(f, -0.4) for f in _tail_features(words, words))
        return total - (0 if words[-1] in self.final else 2.0)


@dataclass
class Models:
    tails: Tails
    languages: Languages


def plain_answer(text: str | None) -> str:
    """Without markup, entities and invisible characters; runs of white space become one blank."""
    if not text:
        return ""
    if "&" in text:
        text = html.unescape(text)
    if "<" in text:
        text = MARKUP.sub(" ", text)
    return " ".join((text if text.isascii() else INVISIBLE.sub("", text)).split())


def is_empty(words: list[str]) -> bool:
    """Whether the lower-case words of a text without markup are none, or only stand in for an answer."""
    return not words or STAND_IN.fullmatch(" ".join(words)) is not None


def is_refusal(bare: str) -> bool:
    """Whether the answer declines: a refusal among its first sentences and little besides."""
    low = bare.lower()
    if REFUSAL_HINTS.isdisjoint(WORD.findall(low)):
        return False
    words = " ".join(WORD.findall(low.replace("'", "").replace("’", "").replace("`", "")))
    m = REFUSAL.search(words)
    return m is not None and len(words[: m.start()].split()) <= 30 and len(words[m.end() :].split()) <= 50


def ends_in_aside(text: str) -> bool:
    """Whether the text ends with a bracket or quotation that opened within it, apart from any around the whole."""
    shown = text.strip("*_ .\n")
    while shown and shown[-1] in CLOSERS:
        depth = 0
        for i in range(len(shown) - 1, -1, -1):
            if shown[i] == shown[-1]:
                depth += 1
            elif shown[-1] in PAIRS.get(shown[i], ""):
                depth -= 1
                if not depth:
                    break
        else:
            i = 0
        if i > 0:
            return len(shown[:i].split()) > 1
        shown = shown[1 if shown[0] in PAIRS else 0 : -1].strip("*_ .\n")
    return False


def is_truncated(text: str, bare: str, tails: Tails) -> bool:
    """Whether the answer stops before its last sentence, list or markup is finished."""
    shown = html.unescape(text) if "&" in text else text
    shown = (shown if shown.isascii() else INVISIBLE.sub("", shown)).rstrip()
    end = shown[-END_REACH:]  # none of the endings is longer
    if BROKEN_OFF.search(end) or BROKEN_END.search(end):
        return True
    if re.search(r"<[^<>]{0,200}$", shown) and re.search(r"</?[a-zA-Z]", shown[shown.rfind("<") :]):
        return True
    inner = MARKUP.sub(" ", shown).rstrip() if "<" in shown else shown
    open_now = left_open(shown)
    if any(o in PAIRS or o in ("```", "~~~", "**", '"', "`", "item", "list") or o.startswith("<") for o in open_now):
        return True
    if ends_in_aside(inner):
        return False
    core = inner.rstrip("\"”’'»›*_`)]}（） ")
    if not core:
        return False
    if core[-1] in ".!?。！？…%°":
        return False
    sentence = SENTENCE_END.split(core)[-1]
    words = WORD.findall(sentence)
    if not words or script_of(sentence) not in ("latin", None):
        return False
    return tails.score(sentence) < -1.0


def defect_of(question: str | None, answer: str | None, models: Models) -> str | None:
    """The kind of defect of a pair, or None. Kinds are tried in this order: empty, echo, refusal, other_language, truncated."""
    bare, asked = plain_answer(answer), plain_answer(question)
    q, a = WORD.findall(asked.lower()), WORD.findall(bare.lower())
    if is_empty(a):
        return "empty"
    if is_echo(q, a):
        return "echo"
    if is_refusal(bare):
        return "refusal"
    one, two = script_of(asked), script_of(bare)
    if one and two and one != two and "other" not in (one, two):
        return "other_language"
    mine, theirs = models.languages.scores(q), models.languages.scores(a)
    if mine is not None and theirs is not None:
        i, j = int(mine.argmax()), int(theirs.argmax())
        if i != j and theirs[j] - theirs[i] > 3.0 and mine[i] - mine[j] > 2.0:
            return "other_language"
    return "truncated" if is_truncated(answer or "", bare, models.tails) else None


def fit_models(records: DataFrame) -> Models:
    """Fits both models on bounded samples: TAIL_SAMPLE answers, and LANGUAGE_SAMPLE rows of each label of two letters.

    Samples are the rows with the smallest hashes of their ids, so they are the same in every run and layout.
    """
    rows = records.select(F.col("row_id").cast("long").alias("row_id"), F.lower(F.substring(F.trim("language"), 1, 2)).alias("lang"), "question", "answer").filter("answer is not null and row_id is not null")
    place = F.pmod(F.xxhash64(F.lit(1), "row_id"), F.lit(2**31))
    counts = {r.lang or "": r.n for r in rows.groupBy(F.when(F.col("lang").rlike("^[a-z]{2}$"), F.col("lang")).alias("lang")).agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    if not total:
        return Models(Tails.fit([]), Languages.fit([]))

    def bound(most: int, n: int) -> float:
        return min(1.0, 2 * most / n + 20 / n) * 2**31  # about twice as many as are kept, so that sorting sees few rows

    tail = rows.filter(place < bound(TAIL_SAMPLE, total)).orderBy(place, "row_id").limit(TAIL_SAMPLE).select("question", "answer").collect()
    sentences = []
    for r in tail:
        for text in (r.question, r.answer):
            sentences += [s for s in SENTENCE_END.split((text or "").strip()) if s and s[-1] in ".!?" and len(s) >= 8 and not s.endswith("...")]
    langs = sorted(lang for lang in counts if lang)
    if not langs:
        return Models(Tails.fit(sentences), Languages.fit([]))
    bounds = F.create_map(*[x for lang in langs for x in (F.lit(lang), F.lit(bound(LANGUAGE_SAMPLE, counts[lang])))])
    order = Window.partitionBy("lang").orderBy(place, "row_id")
    labelled = rows.filter(place < F.try_element_at(bounds, F.col("lang"))).withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= LANGUAGE_SAMPLE)
    spoken = [(r.lang, WORD.findall(f"{plain_answer(r.question)} {plain_answer(r.answer)}".lower())) for r in labelled.orderBy("lang", "nth").select("lang", "question", "answer").collect()]
    return Models(Tails.fit(sentences), Languages.fit(spoken))


def _judged(rows: DataFrame, models: Models | None, records: DataFrame, keep: str) -> DataFrame:
    """(``keep``, defect_type) of the defective rows of (``keep``, question, answer)."""
    fitted = records.sparkSession.sparkContext.broadcast(models or fit_models(records))

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kinds = [defect_of(q, a, fitted.value) for q, a in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
            found = pa.RecordBatch.from_arrays([b.column(0), pa.array(kinds, pa.string())], names=[keep, "defect_type"])
            yield found.filter(found.column(1).is_valid())

    return rows.mapInArrow(judge, f"{keep} {rows.schema[keep].dataType.simpleString()}, defect_type string")


def defective_pairs(records: DataFrame, models: Models | None = None) -> DataFrame:
    """(row_id, defect_type) of each row whose answer fails its question; see ``defect_of`` for the kinds.

    ``records`` needs row_id, question, answer and, to fit the models, language; other columns are ignored. A null
    question counts as empty: then only the answer's own defects are seen. Repeated rows are judged one by one.
    An empty table gives an empty result. Texts are read whole.
    """
    return _judged(records.select(F.col("row_id").cast("long").alias("row_id"), "question", "answer"), models, records, "row_id")


def defect_counts(records: DataFrame, models: Models | None = None) -> DataFrame:
    """Defective rows per collection and kind, counted in one pass."""
    rows = records.select(F.col("source.collection").alias("collection"), "question", "answer")
    return _judged(rows, models, records, "collection").groupBy("collection", "defect_type").agg(F.count("*").alias("n_rows"))
