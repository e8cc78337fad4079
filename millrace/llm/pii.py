"""Personal data by patterns and a semi-Markov conditional random field.

Four kinds of spans are found by fixed patterns; these always stay. Around the places that could hold more (digits, at signs and
how people write them out) the field looks at whole candidate spans: for each kind the number of digits and how they are
grouped, the separators, check digits, the parts of an address, the words and characters around it. A segmentation scores the
sum of its spans' features and of the transitions between the kinds of spans that follow each other. Spans have at most
``MAX_TOKENS`` tokens, so the best segmentation, boundaries and kinds at once, comes from a dynamic programme that is linear in
the text; it leaves out whatever overlaps a pattern's span, and takes a very long stretch of such places part by part. A span it chooses is added if its probability, over all
segmentations, is ``SURE`` or more. Text farther from such places than a span is long cannot be part of one and is not looked
at a second time.

The field is trained here, by gradient ascent on the likelihood of ``EXAMPLES`` made texts with spans in many spellings and
with numbers that are none (dates, versions, amounts, serial numbers); they come from ``SEED`` and not from the corpus, so every
run and every size of input has the same field.

Defined cases: null is an empty text and has no spans; repeated rows are reported row by row; an empty table gives no rows; the
report ignores extra columns and ``mask`` keeps them. Offsets count code points.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from .words import slices

KINDS = ("email", "ip", "card", "phone")
EXAMPLES, ROUNDS, SEED = 1500, 60, 12
SURE = 0.9
MAX_TOKENS, MAX_CHARS = 24, 72
# Characters of a stretch that are decoded at a time.
STRETCH = 4096
_NONE = np.zeros((0, 2), np.int64)
SLICE_BYTES = 4 * 1024 * 1024
SPAN = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
    T.StructField("base", T.BooleanType()),
])

# The patterns. Texts are searched in linear time, so some are spelled in another way than they are defined.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(map(int, reversed(digits))):
        total += digit if place % 2 == 0 else digit * 2 - 9 * (digit > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at, free = text.find("@"), 0
    while at >= 0:
        begin = at  # the first character of the run of local characters that ends here
        while begin > free and text[begin - 1] in _LOCAL_CHARS:
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            yield begin, domain.end()
        free = domain.end() if domain else at + 1
        at = text.find("@", free)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for found in _DOTTED.finditer(text):
        if found.group().count(".") < 3:
            continue
        ends = [m.span() for m in re.finditer("[0-9]+", found.group())]
        for k in range(0, len(ends) - 3, 4):
            four = ends[k: k + 4]
            if all(b - a < 4 or not found.group()[a:b].lstrip("0")[3:] for a, b in four) and all(
                int(found.group()[a:b].lstrip("0") or 0) <= 255 for a, b in four
            ):
                yield found.start() + four[0][0], found.start() + four[3][1]


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The spans of the fixed patterns, by kind and start."""
    found = [("email", a, b) for a, b in _emails(text)]
    found += [("ip", a, b) for a, b in _ips(text)]
    for match in _CARD.finditer(text):
        if 16 <= match.end() - match.start() and 16 <= len(digits := _digits(match.group())) <= 19 and luhn(digits):
            found.append(("card", *match.span()))
    for match in _PHONE.finditer(text):
        if 8 <= len(_digits(match.group())) <= 15:
            found.append(("phone", *match.span()))
    return found


# ---------------------------------------------------------------- candidates and their features

_TOKEN = re.compile(r"[0-9]+|[A-Za-z]+|[^\x00-\x7F]+|.", re.DOTALL)
# What a span that no pattern finds has to hold.
_SIGN = re.compile(r"[0-9@]|[\[({<]\s?(?:at|AT|At)\s?[\])}>]|\b(?:dot|DOT|Dot)\b")
_AT = re.compile(r"\s?(?:@|[\[({<]\s?(?:at|AT|At)\s?[\])}>]|(?<=\s)(?:at|AT)(?=\s))\s?")
_DOT = re.compile(r"\.|\s?[\[({<]\s?(?:dot|DOT|Dot|\.)\s?[\])}>]\s?|\s(?:dot|DOT|Dot)\s")
_LABEL = re.compile(r"[A-Za-z0-9-]{1,63}")
_BETWEEN = frozenset(" .-()/+[]")
# Words that announce a kind, and endings of domains.
_CUES = {
    "email": "mail email e-mail contact write", "ip": "ip host address server addr",
    "card": "card visa credit mastercard amex payment", "phone": "phone tel call fax mobile cell telefon",
}
_CUE_OF = {word: kind for kind, words in _CUES.items() for word in words.split()}
_ENDINGS = frozenset("com org net edu gov io de fr es uk eu info biz co us at ch it nl".split())


def _side(text: str, at: int) -> str:
    if not 0 <= at < len(text):
        return "edge"
    c = text[at]
    return "digit" if c.isdigit() else "letter" if c.isalpha() else "blank" if c.isspace() else c if c in "+-.:/=#$%,()" else "mark"


def _cue(text: str, start: int) -> str:
    before = re.findall(r"[A-Za-z-]+", text[max(0, start - 24): start])[-2:]
    return next((_CUE_OF[w.lower()] for w in reversed(before) if w.lower() in _CUE_OF), "none")


def _common(kind: str, text: str, start: int, end: int) -> list[str]:
    return [kind, f"{kind} left {_side(text, start - 1)}", f"{kind} right {_side(text, end)}", f"{kind} cue {_cue(text, start)}"]


def _number_features(kind: str, text: str, start: int, end: int) -> list[str]:
    span = text[start:end]
    groups = re.findall("[0-9]+", span)
    digits, between = "".join(groups), "".join(sorted(set(re.sub("[0-9]", "", span))))
    shape = "-".join(str(len(g)) for g in groups) if len(groups) < 7 else "many"
    first = span[0] if span[0] in "+(" else "zero" if span[0] == "0" else "digit"
    found = _common(kind, text, start, end) + [
        f"{kind} n {len(digits)}", f"{kind} shape {shape}", f"{kind} between {between}", f"{kind} shape {shape} between {between}",
        f"{kind} first {first}", f"{kind} first {first} shape {shape}",
    ]
    if kind == "card":
        found.append(f"card luhn {luhn(digits)} {len(digits) >= 15}")
    if kind == "ip":
        found.append(f"ip octets {all(len(g) < 4 and int(g) < 256 for g in groups)} {set(re.sub('[0-9]', ' ', span).split())}")
    return found


def _numbers(text: str, begin: int, end: int) -> Iterator[tuple[str, int, int]]:
    tokens = [m.span() for m in _TOKEN.finditer(text, begin, end)]
    for k, (start, _) in enumerate(tokens):
        first = text[start]
        if not (first.isascii() and (first.isdigit() or first in "+(")) or _side(text, start - 1) in ("digit", "letter"):
            continue
        count = groups = 0
        for a, b in tokens[k: k + MAX_TOKENS]:
            if b - start > MAX_CHARS:
                break
            if "0" <= text[a] <= "9":
                count, groups = count + b - a, groups + 1
                if count > 19:
                    break
                if _side(text, b) in ("digit", "letter"):
                    continue
                if groups == 4 and first.isdigit() and count <= 12:
                    yield "ip", start, b
                if 13 <= count:
                    yield "card", start, b
                if 8 <= count <= 15:
                    yield "phone", start, b
            elif text[a] not in _BETWEEN or text[a: a + 2] == "  ":
                break


def _address_parts(text: str, begin: int, end: int) -> Iterator[tuple[int, int, str, list[str]]]:
    """Start, end, how "at" is spelled, and the labels and dots behind it; several ends and starts for one "at"."""
    for mark in _AT.finditer(text, begin, end):
        starts, at = [], mark.start()
        while len(starts) < 4 and at > begin and mark.start() - at < MAX_CHARS // 2 and text[at - 1] in _LOCAL_CHARS:
            at -= 1
            if text[at].isalnum() and (at == 0 or not text[at - 1].isalnum()):
                starts.append(at)
        labels, here = [], mark.end()
        while len(labels) < 9 and (label := _LABEL.match(text, here, end)) and label.end() - mark.start() < MAX_CHARS // 2:
            labels.append(label.group())
            if len(labels) > 1 and _side(text, label.end()) not in ("letter", "digit"):
                for start in starts:
                    yield start, label.end(), mark.group().strip(), list(labels)
            dot = _DOT.match(text, label.end(), end)
            if not dot:
                break
            labels.append(dot.group())
            here = dot.end()


def _address_features(text: str, start: int, end: int, at: str, labels: list[str]) -> list[str]:
    spelled = "sign" if at == "@" else "word" if at.isalpha() else "bracket"
    dots = sorted({"sign" if d == "." else "word" if d.strip().isalpha() else "bracket" for d in labels[1::2]})
    ending = labels[-1].lower()
    whole = start == 0 or text[start - 1] not in _LOCAL_CHARS
    return _common("email", text, start, end) + [
        f"email at {spelled} dot {' '.join(dots)}", f"email at {spelled} ending {ending in _ENDINGS}", f"email whole {whole}",
        f"email ending alpha {ending.isalpha()} {min(len(ending), 5)}", f"email more {_DOT.match(text, end) is not None}",
        f"email labels {len(labels)}", f"email blank {text[start:end].count(' ') > 0} {spelled}",
    ]


@dataclass
class Lattice:
    """Candidate spans of one stretch of text."""

    spans: list[tuple[str, int, int]]
    features: list[list[str]]

    def __post_init__(self):
        points = {p: k for k, p in enumerate(sorted({p for _, a, b in self.spans for p in (a, b)}))}
        self.size = len(points)
        self.edges = [(points[a], points[b], KINDS.index(kind) + 1) for kind, a, b in self.spans]


def lattice(text: str, fixed: np.ndarray, begin: int, end: int) -> Lattice:
    """The candidates between ``begin`` and ``end`` that overlap none of the ``fixed`` spans (rows of start and end)."""
    spans, features = [], []
    free = np.ones(end - begin, bool)
    for a, b in fixed - begin:
        free[max(a, 0): max(b, 0)] = False
    for start, stop, at, labels in _address_parts(text, begin, end):
        if free[start - begin: stop - begin].all():
            spans.append(("email", start, stop))
            features.append(_address_features(text, start, stop, at, labels))
    for kind, start, stop in _numbers(text, begin, end):
        if free[start - begin: stop - begin].all():
            spans.append((kind, start, stop))
            features.append(_number_features(kind, text, start, stop))
    return Lattice(spans, features)


# ---------------------------------------------------------------- the field

_LOW = -1e30
_STATES = len(KINDS) + 1  # the kind of the span before, or none


def _add(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    return a + math.log1p(math.exp(b - a)) if b > _LOW / 2 else a


def _forward(size: int, edges: list, scores: list[float], turn: list[list[float]], join) -> list[list[float]]:
    table = [[_LOW] * _STATES for _ in range(size)]
    table[0][0] = 0.0
    begin: list[list[int]] = [[] for _ in range(size)]
    for k, (a, _, _) in enumerate(edges):
        begin[a].append(k)
    for p in range(size):
        if p:
            table[p] = [join(x, y) for x, y in zip(table[p], table[p - 1])]
        for k in begin[p]:
            _, b, kind = edges[k]
            for before in range(_STATES):
                if table[p][before] > _LOW / 2:
                    table[b][kind] = join(table[b][kind], table[p][before] + turn[before][kind] + scores[k])
    return table


def _backward(size: int, edges: list, scores: list[float], turn: list[list[float]]) -> list[list[float]]:
    table = [[_LOW] * _STATES for _ in range(size)]
    table[size - 1] = [0.0] * _STATES
    begin: list[list[int]] = [[] for _ in range(size)]
    for k, (a, _, _) in enumerate(edges):
        begin[a].append(k)
    for p in range(size - 1, -1, -1):
        if p < size - 1:
            table[p] = list(table[p + 1])
        for k in begin[p]:
            _, b, kind = edges[k]
            for before in range(_STATES):
                table[p][before] = _add(table[p][before], turn[before][kind] + scores[k] + table[b][kind])
    return table


@dataclass
class Field:
    """Weights of features and of transitions between the kinds of spans that follow each other."""

    names: dict[str, int]
    weights: np.ndarray
    turn: list[list[float]]

    def scores(self, found: Lattice) -> list[float]:
        return [float(sum(self.weights[self.names[f]] for f in own if f in self.names)) for own in found.features]

    def probabilities(self, found: Lattice, scores: list[float]) -> tuple[list[list[float]], float]:
        """Of every candidate, by the kind before it; and the logarithm of the sum over all segmentations."""
        front = _forward(found.size, found.edges, scores, self.turn, _add)
        back = _backward(found.size, found.edges, scores, self.turn)
        total = back[0][0]
        chances = [
            [math.exp(min(0.0, front[a][s] + self.turn[s][kind] + scores[k] + back[b][kind] - total)) for s in range(_STATES)]
            for k, (a, b, kind) in enumerate(found.edges)
        ]
        return chances, total

    def best(self, found: Lattice) -> list[tuple[str, int, int]]:
        """The sure spans of the best segmentation."""
        if not found.spans:
            return []
        scores = self.scores(found)
        if max(scores) + max(map(max, self.turn)) <= 0:
            return []  # nothing is better than no span at all
        table = _forward(found.size, found.edges, scores, self.turn, max)
        at, state = found.size - 1, max(range(_STATES), key=lambda s: table[found.size - 1][s])
        chosen = []
        while at >= 0 and state:
            if at and table[at - 1][state] == table[at][state]:
                at -= 1
                continue
            k, before = next(
                (k, s) for k, (a, b, kind) in enumerate(found.edges) if b == at and kind == state
                for s in range(_STATES) if table[a][s] > _LOW / 2 and table[a][s] + self.turn[s][kind] + scores[k] == table[at][state]
            )
            chosen.append(k)
            at, state = found.edges[k][0], before
        if not chosen:
            return []
        chances, _ = self.probabilities(found, scores)
        return [found.spans[k] for k in reversed(chosen) if sum(chances[k]) >= SURE]


def made_examples(texts: int, seed: int) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """Made texts with the spans in them."""
    rng = random.Random(seed)
    some = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    word = lambda: "".join(rng.choice("aeiourstlnmdchbg") for _ in range(rng.randint(2, 9)))

    def card(size: int) -> str:
        body = some(size - 1)
        return next(body + d for d in "0123456789" if luhn(body + d))

    def dotted(parts, dot="."):
        return dot.join(map(str, parts))

    def email() -> str:
        host, ending, name = word(), rng.choice(["com", "org", "net", "de", "fr", "es", "io", "co"]), word()
        name = rng.choice([name, f"{name}.{word()}", f"{name}{some(2)}", f"{name}_{word()}", f"{name}.{some(2)}"])
        host = rng.choice([host, f"{host}.{word()}", f"{host}{some(1)}.{word()}"])
        at, dot = rng.choice([("@", "."), (" at ", " dot "), (" [at] ", " [dot] "), ("(at)", "."), ("[at]", "[dot]"), (" @ ", "."),
                              (" (at) ", " (dot) "), (" AT ", " DOT "), ("(at)", "(dot)"), ("[at]", ".")])
        return name + at + f"{host}.{ending}".replace(".", dot)

    def ip() -> str:
        return dotted((rng.randint(1, 255) for _ in range(4)), rng.choice([".", "[.]", "[.]"]))

    def number() -> str:
        a, b, c = some(3), some(3), some(4)
        return rng.choice([
            f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"1-{a}-{b}-{c}", f"+{some(2)} {a} {some(7)}",
            f"+{some(2)}-{some(2)}-{c}-{some(4)}", f"00{rng.randint(1, 9)}{some(1)} {a} {some(7)}", f"({a}) {b} {c}", f"1 ({a}) {b}-{c}",
        ])

    def payment() -> str:
        whole = card(16)
        four = [whole[k: k + 4] for k in range(0, 16, 4)]
        short = card(15)
        return rng.choice([whole, " ".join(four), "-".join(four), ".".join(four), ".".join(four), f"{short[:4]} {short[4:10]} {short[10:]}",
                           f"{short[:4]}-{short[4:10]}-{short[10:]}"])

    def other() -> str:
        """Numbers and phrases that are not personal data."""
        year, month, day = rng.randint(1900, 2030), rng.randint(1, 12), rng.randint(1, 28)
        wrong = some(15)
        wrong += next(d for d in rng.sample("0123456789", 10) if not luhn(wrong + d))
        four = [wrong[k: k + 4] for k in range(0, 16, 4)]
        return rng.choice([
            some(rng.randint(1, 20)), some(rng.randint(7, 13)), some(rng.randint(7, 13)), wrong, " ".join(four), "-".join(four), ".".join(four),
            f"{year}-{month:02}-{day:02}", f"{day:02}.{month:02}.{year}", f"{month:02}/{day:02}/{year}", f"{year}-{month:02}-{day:02} 10:{some(2)}:{some(2)}",
            f"{some(2)}:{some(2)}:{some(2)}", dotted((rng.randint(0, 20) for _ in range(3))), dotted((rng.randint(0, 2000) for _ in range(2))),
            f"{rng.randint(256, 999)}.{some(3)}.{rng.randint(256, 999)}.{some(2)}", f"{some(rng.randint(4, 8))}.{some(rng.randint(1, 8))}",
            f"{some(3)}-{some(2)}-{some(4)}", f"978-{some(1)}-{some(2)}-{some(6)}-{some(1)}", f"{rng.randint(1, 9)} {some(3)} {some(3)}.{some(2)}",
            f"{some(2)}.{some(6)} {some(2)}.{some(6)}", f"{some(3)} - {some(3)}", ", ".join(some(rng.randint(1, 3)) for _ in range(4)),
            " ".join(some(rng.randint(1, 4)) for _ in range(rng.randint(3, 8))), f"{some(4)}-{some(4)}", f"{year}-{year + 3}", f"{year} {year + 1} {year + 2}",
            "".join(rng.choice("0123456789abcdef") for _ in range(16)), f"{word()} at {word()}.", f"{word()} at the dot {word()}", f"look at {word()} dot", f"@{word()}",
            f"{word()} at {word()} {word()} dot {word()}", f"{word()} at {word()}. {word()}", f"{some(1)}.{some(1)}.{some(1)}", f"{some(5)}/{some(5)}",
            f"§ {some(2)} ({some(1)})", f"({some(4)}) {some(3)}", f"{some(3)} ({some(2)}) {some(1)}", f"{some(2)}-{some(3)}-{some(2)}-{some(3)}",
        ])

    makers = {"email": email, "ip": ip, "card": payment, "phone": number}
    examples = []
    for _ in range(texts):
        text, gold = word(), []
        for _ in range(rng.randint(1, 3)):
            kind = rng.choice([*KINDS, None, None, None])
            cue = rng.choice([word(), word(), word(), rng.choice(_CUES[kind].split()) if kind else word()])
            text += rng.choice([f" {word()} {cue} ", f". {cue}: ", f" {cue} ", f", {cue} (", f" {cue}\n"])
            piece = makers[kind]() if kind else other()
            if kind:
                gold.append((kind, len(text), len(text) + len(piece)))
            text += piece + rng.choice([" ", ". ", ", ", ") ", "\n", "; "]) + word()
        examples.append((text, gold))
    return examples


def train(examples: list[tuple[str, list[tuple[str, int, int]]]], rounds: int = ROUNDS, rate: float = 1.0, decay: float = 0.0002) -> Field:
    """Weights that make the given spans likely, by gradient ascent with a step per weight."""
    cases = []
    for text, gold in examples:
        found = lattice(text, _NONE, 0, len(text))
        if found.spans:
            cases.append((found, [k for k, span in enumerate(found.spans) if span in gold]))
    names: dict[str, int] = {}
    for found, _ in cases:
        for own in found.features:
            for name in own:
                names.setdefault(name, len(names))
    codes = [np.array([names[f] for f in own]) for found, _ in cases for own in found.features]
    flat, bounds = np.concatenate(codes), np.cumsum([0, *map(len, codes)])
    field = Field(names, np.zeros(len(names)), [[0.0] * _STATES for _ in range(_STATES)])
    step, turn_step = np.full(len(names), 1e-6), np.full((_STATES, _STATES), 1e-6)
    for _ in range(rounds):
        scores = np.add.reduceat(field.weights[flat], bounds[:-1])
        excess, turns, at = np.zeros(len(codes)), np.zeros((_STATES, _STATES)), 0
        for found, gold in cases:
            count = len(found.spans)
            chances, _ = field.probabilities(found, scores[at: at + count].tolist())
            excess[at: at + count] = [-sum(c) for c in chances]
            excess[at + np.array(gold, int)] += 1
            for (_, _, kind), own in zip(found.edges, chances):
                turns[:, kind] -= own
            before = 0
            for k in sorted(gold, key=lambda k: found.edges[k][0]):
                turns[before, found.edges[k][2]] += 1
                before = found.edges[k][2]
            at += count
        slope = np.bincount(flat, np.repeat(excess, np.diff(bounds)), len(names)) / len(cases) - decay * field.weights
        step += slope ** 2
        field.weights = field.weights + rate * slope / np.sqrt(step)
        turns = turns / len(cases) - decay * np.array(field.turn)
        turn_step += turns ** 2
        field.turn = (np.array(field.turn) + rate * turns / np.sqrt(turn_step)).tolist()
    return field


def _added(text: str, field: Field, fixed: np.ndarray, begin: int, end: int) -> Iterator[tuple[str, int, int]]:
    """The spans of the field in one stretch, ``STRETCH`` characters at a time: each part is seen with what spans that begin in
    it may reach, and the next begins behind the last of its spans."""
    reach = np.maximum.accumulate(fixed[:, 1])
    while begin < end:
        cut = begin + STRETCH
        stop = min(end, cut + MAX_CHARS + 1)
        own = fixed[np.searchsorted(reach, begin, side="right"): np.searchsorted(fixed[:, 0], stop)]
        best = field.best(lattice(text, own, begin, stop))
        if stop < end:
            best = [span for span in best if span[1] < cut]
        yield from best
        begin = max([cut, *(span[2] for span in best)])


def spans_of(text: str, field: Field) -> list[tuple[str, int, int, bool]]:
    """All spans of a text by kind and start; the last value tells those of the patterns."""
    base = base_spans(text)
    fixed = np.array(sorted((a, b) for _, a, b in base), np.int64).reshape(-1, 2)
    found = [(*span, True) for span in base]
    begin = end = None
    for sign in _SIGN.finditer(text):
        if end is None or sign.start() - MAX_CHARS - 1 > end:
            if end is not None:
                found += [(*span, False) for span in _added(text, field, fixed, begin, end)]
            begin = max(0, sign.start() - MAX_CHARS - 1)
        end = min(len(text), sign.end() + MAX_CHARS + 1)
    if end is not None:
        found += [(*span, False) for span in _added(text, field, fixed, begin, end)]
    return sorted(found, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def find(docs: DataFrame, *, text_col: str = "text", id_col: str = "doc_id", field: Field | None = None) -> DataFrame:
    """Per document: its id, and ``spans``, an array of kind, start, end and ``base`` (found by a pattern), by kind and start."""
    shared = docs.sparkSession.sparkContext.broadcast(field or train(made_examples(EXAMPLES, SEED)))
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("spans", T.ArrayType(SPAN))])
    span_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                rows = [
                    [dict(zip(SPAN.names, span)) for span in spans_of(text or "", shared.value)]
                    for text in part.column("text").to_pylist()
                ]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(rows, span_type)], names=schema.names)

    found = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInArrow(compute, schema)
    return found.withColumnRenamed("id", id_col)


def masked(text: str, spans: list[tuple[str, int, int, bool]]) -> str:
    """The text with every span replaced by its kind in brackets; spans that overlap are one, named by the first."""
    out, at = [], 0
    for kind, a, b, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def mask(docs: DataFrame, *, text_col: str = "text", field: Field | None = None) -> DataFrame:
    """All documents with their spans masked; null stays null."""
    shared = docs.sparkSession.sparkContext.broadcast(field or train(made_examples(EXAMPLES, SEED)))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col, SLICE_BYTES):
                texts = [t and masked(t, spans_of(t, shared.value)) for t in part.column(text_col).to_pylist()]
                place = part.schema.get_field_index(text_col)
                yield part.set_column(place, part.schema.field(place), pa.array(texts, part.schema.field(place).type))

    return docs.mapInArrow(compute, docs.schema)
