"""Operator 8: personal data by base patterns and a semi-Markov conditional random field (Sarawagi and Cohen, 2004).

Base patterns find emails, IP addresses, cards and phones in their usual spelling; what they find stays. The field segments all material
of the text that has the makings of such data: whole-span features (digit groups, separators, checksum, cue words before and after, whether a base
pattern takes the segment) score each candidate segment as each kind, and dynamic programming over segments of bounded length chooses
boundaries and kinds together. What it finds apart from base matches is added. The field is trained here, on examples made from a seed.

Bounds of a segment, which keep the time in proportion to the text: MOST_TOKENS tokens; numbers of 7 to 19 digits with up to three marks between two
digits; quads of numbers of up to three digits; addresses with names of up to 64 characters, up to 4 dots before the sign and 5 after.
Base matches have no bound, in the result or as candidates.
"""

from __future__ import annotations

import collections
import functools
import hashlib
import math
import random
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from arborline.llm.common import tidy

#: Kinds of personal data, in the order of the results; fixed values.
KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, str]  # start, end (exclusive), kind; in code points

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A match never begins inside a run of digits: one that begins at the run's start would have been found first.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]+\.[0-9]+\.[0-9]+")
#: Repeats that nothing follows are possessive: the same matches, without a state for each turn.
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> Iterator[Span]:
    taken, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > taken and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            taken = found.end()
            yield start, taken, "email"
        at = text.find("@", max(at + 1, taken))


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind's pattern that pass its check; in order of start, then kind."""
    found = list(_emails(text))
    if any(map(text.__contains__, "0123456789")):
        found += [(m.start(), m.end(), "ip") for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split("."))]
        found += [(m.start(), m.end(), "card") for m in _CARD.finditer(text) if 14 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
        found += [(m.start(), m.end(), "phone") for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return in_order(found)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


# ---------------------------------------------------------------- candidate segments and their features

MOST_TOKENS = 24
_CONTEXT = 32
_TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|.", re.S)
#: Marks inside a spelt-out number.
_MARKS = r"[ ().\[\]/+_\u00a0\u00b7\u2010-\u2015-]"
_DIGITY = re.compile(rf"[+(]?[0-9](?:{_MARKS}{{0,3}}[0-9]){{6,}}+")
_AT = r"(?:\s?[@\uff20]\s?|\s?[(\[{<]\s?at\s?[)\]}>]\s?|\s?\(@\)\s?|\sat\s|_at_|&#64;|%40)"
_DOT = r"(?:\.|\s?[(\[{<]\s?dot\s?[)\]}>]\s?|\s?[(\[]\.[)\]]\s?|\sdot\s|_dot_)"
_NAME = r"[A-Za-z0-9+-](?:_?(?!at_|dot_)[A-Za-z0-9+-]){0,63}"
#: What an at sign, said in any way, has in it, and where that lies inside it at most.
_AT_CORE, _AT_LEAD = re.compile(r"[@\uff20]|(?<![A-Za-z0-9])at(?![A-Za-z0-9])|&#64;|%40", re.I), 3
_AT_SIGN = re.compile(_AT, re.I)
_BEFORE_AT = re.compile(rf"(?<![\w.+-]){_NAME}(?:{_DOT}{_NAME}){{0,4}}\Z", re.I)
_AFTER_AT = re.compile(rf"[A-Za-z0-9-]{{1,63}}(?:{_DOT}[A-Za-z0-9-]{{1,63}}){{1,5}}", re.I)
_MOST_BEFORE_AT = 5 * 64 + 4 * 7
_MAIL_WHOLE = re.compile(rf"[A-Za-z0-9_+-]+(?:{_DOT}[A-Za-z0-9_+-]+)*{_AT}[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)*{_DOT}[A-Za-z]{{2,}}", re.I)
_QUAD = re.compile(r"([0-9]{1,3})(\s?\.\s?|\s?[(\[{](?:\.|dot)[)\]}]\s?|\sdot\s|,)([0-9]{1,3})\2([0-9]{1,3})\2([0-9]{1,3})", re.I)
#: Quads of any number of digits; they may overlap.
_QUADDY = re.compile(rf"(?<![0-9])(?={_QUAD.pattern}(?![0-9]))", re.I)
_MORE_MAIL = re.compile(rf"(?:{_DOT}|{_AT})[A-Za-z0-9-]+", re.I)
#: Cue words near a segment, by kind; fixed values.
CUES = {
    "email": ("mail", "email", "mails", "write", "contact", "correo", "courriel", "kontakt", "inbox", "sender", "escribe", "schreib"),
    "ip": ("ip", "host", "server", "address", "adresse", "ping", "gateway", "router", "node", "subnet", "dns", "from", "connect", "servidor", "serveur"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "debit", "carte", "karte", "tarjeta", "kreditkarte", "pay", "charged"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "telefono", "telephone", "cell", "ring", "text", "whatsapp", "sms", "handy", "movil", "portable", "reach", "dial"),
    "other": ("order", "id", "no", "nr", "invoice", "isbn", "date", "version", "serial", "ref", "account", "ticket", "article", "page", "pages", "chapter", "part", "batch", "score", "population", "chromosome", "sku", "tracking", "section", "v"),
}


def candidates(text: str, low: int = 0, high: int | None = None) -> list[tuple[int, int]]:
    """Segments (start, end) of text[low:high] that may be an entity: whole tokens, bounded in number, with digits enough or the shape of a quad or an email."""
    marks = [m.span() for m in _TOKEN.finditer(text, low, len(text) if high is None else high)]
    out = []
    for i, (a, _) in enumerate(marks):
        if not (text[a].isalnum() or text[a] in "+(") or (a and text[a - 1].isalnum()):
            continue
        digits, letters = 0, False
        for c, b in marks[i : i + MOST_TOKENS]:
            digits += (b - c) * text[c].isdigit()
            letters |= text[c].isalpha()
            if not text[b - 1].isalnum() or (b < len(text) and text[b].isalnum()):
                continue
            if (7 <= digits <= 19 and not letters) or (digits > 3 and _QUAD.fullmatch(text, a, b)) or (letters and _MAIL_WHOLE.fullmatch(text, a, b)):
                out.append((a, b))
    return out


@functools.lru_cache(1 << 14)
def _inner(s: str) -> tuple[str, ...]:
    """Features of a segment's own text."""
    if s[-1:].isalpha() and _MAIL_WHOLE.fullmatch(s):
        f = ["mail shape", "mail odd at" if not re.search(r"\S@\S", s) else "mail plain", "mail words" if re.search(r"\sat\s", s) else "mail marks", "mail says dot" if re.search("dot", s, re.I) else "mail has point"]
        return (*f, "mail end short" if len(re.findall("[A-Za-z]+", s)[-1]) <= 4 else "mail end long")
    groups = re.findall("[0-9]+", s)
    d = "".join(groups)
    quad = _QUAD.fullmatch(s)
    f = ["quad" if quad and all(int(quad[i]) <= 255 for i in (1, 3, 4, 5)) else "no quad"]
    f += ["quad by commas"] * bool(quad and quad[2] == ",")
    f.append("digits " + ("<9" if len(d) < 9 else "9" if len(d) == 9 else "10" if len(d) == 10 else "11" if len(d) == 11 else "12-13" if len(d) < 14 else "14-19"))
    f.append("luhn" if 14 <= len(d) <= 19 and luhn(d) else "no luhn")
    shape = "-".join(str(len(g)) for g in groups)
    f.append("shape " + (shape if shape in ("3-3-4", "1-3-3-4", "4-4-4-4", "4-6-5", "3-4", "10", "16", "4-2-2", "2-2-4", "3-1-2-6-1", "2-2-2-2-2", "3-3-3", "4-3-3", "5-6", "4-7") else "other"))
    inner = set(re.sub("[0-9]+", "", s))
    f.append("joined by " + ("nothing" if not inner else min(inner) if len(inner) == 1 else "brackets" if "(" in inner else "several"))
    f += ["plus"] * s.startswith("+") + ["bracket"] * s.startswith("(") + ["open bracket"] * (s.count("(") != s.count(")"))
    return (*f, "first digit 0" if d[:1] in "01" else "first digit 2-9")


def _before(text: str, start: int) -> tuple[list[str], bool]:
    """(cues in the words before a place, whether digits run up to it)."""
    words = re.findall("[a-z]+", text[max(0, start - _CONTEXT) : start].lower())[-3:]
    return [f"cue {k}" for k, known in CUES.items() if any(w in known for w in words)], bool(re.search(r"[0-9][ ./()+-]{0,2}$", text[max(0, start - 3) : start]))


def _after(text: str, end: int) -> tuple[list[str], bool, bool]:
    """(cues in the words after a place, whether digits go on there, whether an address does)."""
    words = re.findall("[a-z]+", text[end : end + _CONTEXT].lower())[:3]
    return [f"cue after {k}" for k, known in CUES.items() if any(w in known for w in words)], bool(re.match(r"[ ./()+-]{0,2}[0-9]", text[end : end + 3])), bool(_MORE_MAIL.match(text, end))


def features(text: str, start: int, end: int, base: dict[tuple[int, int], set[str]] | None = None) -> list[str]:
    """Whole-span features of text[start:end]; base: the kinds of which the base patterns take a span."""
    own, (before, runs_up), (after, runs_on, more) = _inner(text[start:end]), _before(text, start), _after(text, end)
    f = ["any", *(f"base {k}" for k in sorted((base or {}).get((start, end), ()))), *own, *((before + after) or ["no cue"])]
    return f + ["mail goes on"] * (more and own[0] == "mail shape") + ["digits go on"] * (runs_up or runs_on)


# ---------------------------------------------------------------- the field

Segment = tuple[int, int, list[tuple[int, list[str]]]]


def _log_add(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


def _lattice(text: str, low: int = 0, high: int | None = None, base: list[Span] | None = None) -> list[tuple[int, int, list[str]]]:
    """The candidate segments of text[low:high], base matches among them, with their features."""
    took: dict[tuple[int, int], set[str]] = {}
    for a, b, k in base_spans(text) if base is None else base:
        took.setdefault((a, b), set()).add(k)
    return [(a, b, features(text, a, b, took)) for a, b in sorted({*candidates(text, low, high), *took})]


def _scores(lattice: list, weights: dict[tuple[str, str], float]) -> list[tuple[int, int, str, float]]:
    return [(a, b, k, sum(weights.get((k, x), 0.0) for x in f)) for a, b, f in lattice for k in KINDS]


def _compact(arcs: list) -> tuple[dict[int, list], list[int]]:
    """Arcs by their end, and all points where arcs begin or end; text outside entities scores 0, so other points don't matter."""
    points = sorted({0} | {x for arc in arcs for x in arc[:2]})
    by_end: dict[int, list] = {}
    for arc in arcs:
        by_end.setdefault(arc[1], []).append(arc)
    return by_end, points


Sums = tuple[float, ...]  # a number a kind


class _Scorer:
    """Scores of segments by their parts: of the text inside, of what stands before and of what follows, each worked out once where segments share it."""

    def __init__(self, weights: dict[tuple[str, str], float]) -> None:
        self.weights = weights
        self.inner = functools.lru_cache(1 << 14)(self._of_text)
        self.any, self.mute, self.runs, self.mail = (self.total([x]) for x in ("any", "no cue", "digits go on", "mail goes on"))

    def total(self, names) -> Sums:
        return tuple(sum(self.weights.get((k, x), 0.0) for x in names) for k in KINDS)

    def _of_text(self, s: str) -> tuple[Sums, bool]:
        own = _inner(s)
        return self.total(own), own[0] == "mail shape"

    def before(self, text: str, at: int) -> tuple[Sums, bool, bool]:
        cues, runs = _before(text, at)
        return self.total(cues), bool(cues), runs

    def after(self, text: str, at: int) -> tuple[Sums, bool, bool, bool]:
        cues, runs, more = _after(text, at)
        return self.total(cues), bool(cues), runs, more

    def scores(self, s: str, before: tuple, after: tuple, base: set[str] | None) -> list[float]:
        own, mail = self.inner(s)
        out = [a + b + c + d for a, b, c, d in zip(self.any, own, before[0], after[0])]
        for wanted, more in ((not (before[1] or after[1]), self.mute), (before[2] or after[2], self.runs), (mail and after[3], self.mail)):
            if wanted:
                out = [a + b for a, b in zip(out, more)]
        return [a + b for a, b in zip(out, self.total([f"base {k}" for k in base]))] if base else out


def decode(text: str, low: int, high: int, base: list[Span], scorer: _Scorer) -> list[Span]:
    """The entities of the best segmentation of text[low:high], base matches among its candidates.

    The text is gone through once. What is kept is the best segmentation up to each of the last MOST_TOKENS places and to where open base matches begin; segmentations
    share what they have in common, so the memory is that of the entities found.
    """
    took: dict[tuple[int, int], set[str]] = {}
    for a, b, k in base:
        took.setdefault((a, b), set()).add(k)
    ends: dict[int, list[int]] = {}
    for a, b in sorted(took):
        ends.setdefault(b, []).append(a)
    begins = {a for a, _ in took}
    marks = [x for ab in took for x in ab]
    stops = iter(sorted(set(marks)))
    stop = next(stops, None)
    held: dict[int, tuple[float, tuple | None]] = {}  # where open base matches begin
    best: tuple[float, tuple | None] = (0.0, None)
    window: collections.deque = collections.deque(maxlen=MOST_TOKENS)  # (start, digits before, letters before, best up to it, what stands before) of tokens where a segment may begin
    digits = letters = 0
    number = 0

    def arrive(at: int, starts: list) -> None:
        """Arcs that end here: base matches, and (start, best up to it, what stands before) of candidates."""
        nonlocal best
        known = {a for a, _, _ in starts}
        arcs = starts + [(a, held[a], None) for a in ends.get(at, ()) if a not in known]
        if arcs:
            after = scorer.after(text, at)
            new = best
            for a, (so_far, path), before in sorted(arcs, key=lambda x: x[0]):
                before = before or scorer.before(text, a)
                for k, s in zip(KINDS, scorer.scores(text[a:at], before, after, took.get((a, at)))):
                    if so_far + s > new[0]:
                        new = (so_far + s, ((a, at, k), path))
            best = new
        if at in begins:
            held[at] = best

    for m in _TOKEN.finditer(text, low, high):
        a, b = m.span()
        while stop is not None and stop < b:  # base matches that begin or end at a token's start or inside one
            if stop != a or number == 0:
                arrive(stop, [])
            stop = next(stops, None)
        number += 1
        begin = (text[a].isalnum() or text[a] in "+(") and not (a and text[a - 1].isalnum())
        window.append((a, digits, letters, best, [None]) if begin else None)
        digits += (b - a) * text[a].isdigit()
        letters += text[a].isalpha()
        starts = []
        if text[b - 1].isalnum() and not (b < len(text) and text[b].isalnum()):
            for entry in window:
                if entry is None:
                    continue
                start, d, w, so_far, before = entry
                n, worded = digits - d, letters > w
                if (7 <= n <= 19 and not worded) or (n > 3 and _QUAD.fullmatch(text, start, b)) or (worded and _MAIL_WHOLE.fullmatch(text, start, b)):
                    before[0] = before[0] or scorer.before(text, start)
                    starts.append((start, so_far, before[0]))
        arrive(b, starts)
    out, path = [], best[1]
    while path:
        span, path = path
        out.append(span)
    return out[::-1]


def _expectations(arcs: list) -> list[float]:
    """Each arc's probability in the field, by the forward and backward sums."""
    by_end, points = _compact(arcs)
    by_start: dict[int, list] = {}
    for arc in arcs:
        by_start.setdefault(arc[0], []).append(arc)
    forward = {points[0]: 0.0}
    for before, p in zip(points, points[1:]):
        forward[p] = _log_add([forward[before]] + [forward[a] + s for a, _, _, s in by_end.get(p, ())])
    backward = {points[-1]: 0.0}
    for after, p in zip(points[::-1], points[-2::-1]):
        backward[p] = _log_add([backward[after]] + [backward[b] + s for _, b, _, s in by_start.get(p, ())])
    return [math.exp(forward[a] + s + backward[b] - forward[points[-1]]) for a, b, _, s in arcs]


def examples(n: int, seed: int) -> list[tuple[str, list[Span]]]:
    """Made texts with and without personal data in odd spellings, and where it lies."""
    r = random.Random(seed)
    num = lambda k, first="123456789": r.choice(first) + "".join(r.choice("0123456789") for _ in range(k - 1))
    word = lambda: "".join(r.choice("aeioulnrst") for _ in range(r.randint(3, 8)))

    def card() -> list[str]:
        d = num(15, "3456")
        return re.findall("....", d + next(c for c in "0123456789" if luhn(d + c)))

    def entity() -> tuple[str, str]:
        k = r.choice(KINDS)
        if k == "email":
            at, dot = r.choice([(" at ", " dot "), (" (at) ", " (dot) "), ("[at]", "[dot]"), (" @ ", "."), (" [at] ", "."), ("(at)", "."), (" at ", " dot "), (" AT ", " DOT "), ("_at_", "_dot_"), ("&#64;", "."), ("{at}", "{dot}"), ("(@)", "."), (" at ", "."), ("@", "."), ("@", "[.]")])
            return k, word() + r.choice(["", dot + word()]) + at + word() + r.choice(["", dot + word()]) + dot + r.choice(["com", "org", "net", "de", "fr"])
        if k == "ip":
            return k, r.choice([" . ", "[.]", "(.)", " .", ". ", ".", " dot ", "[dot]", "(dot)"]).join(str(r.randint(r.choice([0, 1]), r.choice([9, 255]))) for _ in range(4))
        if k == "card":
            return k, r.choice([".", "/", "  ", " - ", "--", "_", "\u2013", "\u00a0", " ", "-", ""]).join(card())
        a, b, c = num(3, "23456789"), num(3, "23456789"), num(4)
        if r.random() < 0.3:
            two = lambda: num(2, "0123456789")
            return k, r.choice([f"+{num(2)} {a} {b}{c}", f"+{num(1)}-{a}-{b}-{c}", f"0{num(1)} {two()} {two()} {two()} {two()}", f"0{num(1)}.{two()}.{two()}.{two()}.{two()}", f"0{a} {num(7)}", f"0{a}/{num(6)}", f"0{num(4)}-{num(6)}", f"00{num(2)} {a} {num(7)}"])
        return k, r.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}", f"1-{a}-{b}-{c}", f"({a}){b}-{c}", f"1 ({a}) {b}-{c}"])

    def other() -> str:
        y, m, d = r.randint(1900, 2030), r.randint(1, 12), r.randint(1, 28)
        return r.choice([
            f"{y}-{m:02}-{d:02}", f"{d:02}.{m:02}.{y}", f"{m:02}/{d:02}/{y} {r.randint(0, 23):02}", num(r.randint(7, 19)), f"{y}-{y + 3}", f"{num(1)}.{num(r.randint(7, 12))}",
            f"978-{num(1)}-{num(2)}-{num(6)}-{num(1)}", f"{num(1)}.{num(1)}.{num(2)}.{num(4)}", f"{num(2)} {num(3)} {num(3)}", f"{num(4)} {num(4)}", f"{num(5)}-{num(4)}", f"{num(4)}.{num(4)}.{num(4)}.{num(4)}",
            f"{num(3)} {num(4)} {num(5)}", f"{num(3)},{num(3)},{num(3)}", f"{num(2)}, {num(2)}, {num(2)}, {num(2)}", f"{num(1)}.{num(1)}.{num(1)}", f"{num(1)}.{num(3)}.{num(3)}.{num(3)}", f"{y}.{m}.{d}.{num(4)}", f"{word()} at {word()}", f"{word()} @ {word()}", f"{num(2)}/{num(3)}/{num(4)}", f"{num(3)}-{num(2)}-{num(4)}", f"{word()} at {word()}. {word()}",
        ])

    out = []
    for _ in range(n):
        text, gold = "", []
        for _ in range(r.randint(1, 3)):
            text += " ".join(word() for _ in range(r.randint(1, 4))) + " "
            if r.random() < 0.5:
                k, s = entity()
                text += r.choice(["", "", r.choice(CUES[k]) + r.choice([" ", ": ", " at "])])
                gold.append((len(text), len(text) + len(s), k))
            else:
                s = other()
                text += r.choice(["", r.choice(CUES["other"]) + " "])
            text += s + r.choice([" ", ", ", ". "])
            if gold and gold[-1][1] > len(text) - 4 and r.random() < 0.2:
                text += r.choice([f"is my {r.choice(CUES[k])} ", f"({r.choice(CUES[k])}) "])
        out.append((text, gold))
    return out


@functools.cache
def train(n: int = 900, seed: int = 5, rounds: int = 12, ridge: float = 1e-3, rate: float = 0.5) -> dict[tuple[str, str], float]:
    """Maximise the likelihood of the made examples' segmentations, by adaptive gradient steps."""
    weights: dict[tuple[str, str], float] = {}
    past: dict[tuple[str, str], float] = {}
    made = [(_lattice(text), set(gold)) for text, gold in examples(n, seed)]
    for _ in range(rounds):
        for lattice, gold in made:
            if not lattice:
                continue
            arcs = _scores(lattice, weights)
            change: dict[tuple[str, str], float] = {}
            for (a, b, k, _), p, f in zip(arcs, _expectations(arcs), (f for _, _, f in lattice for _ in KINDS)):
                if g := ((a, b, k) in gold) - p:
                    for x in f:
                        change[k, x] = change.get((k, x), 0.0) + g
            for key, g in change.items():
                g -= ridge * weights.get(key, 0.0)
                past[key] = past.get(key, 1e-6) + g * g
                weights[key] = weights.get(key, 0.0) + rate * g / math.sqrt(past[key])
    return weights


def regions_of(text: str, base: list[Span]) -> list[tuple[int, int]]:
    """The parts of text in which entities may lie, apart from each other and in order: base matches and what is spelt like numbers, quads or emails."""
    found = [(a, b) for a, b, _ in base]
    if any(map(text.__contains__, "0123456789")):
        found += [m.span() for m in _DIGITY.finditer(text)]
        found += [(m.start(), m.end(5)) for m in _QUADDY.finditer(text)]
    for core in _AT_CORE.finditer(text):
        sign = next((m for q in range(max(0, core.start() - _AT_LEAD), core.start() + 1) if (m := _AT_SIGN.match(text, q)) and m.end() >= core.end()), None)
        host = _AFTER_AT.match(text, sign.end()) if sign else None
        name = _BEFORE_AT.search(text, max(0, sign.start() - _MOST_BEFORE_AT), sign.start()) if host else None
        if name:
            found.append((name.start(), host.end()))
    merged: list[list[int]] = []
    for s, e in sorted(found):
        if merged and s <= merged[-1][1]:
            merged[-1][1] = max(e, merged[-1][1])
        else:
            merged.append([s, e])
    return [(s, e) for s, e in merged]


def added_spans(text: str, base: list[Span], scorer: _Scorer) -> list[Span]:
    """What the field finds apart from base spans."""
    out, first = [], 0
    taken = sorted(base)
    for s, e in regions_of(text, base):
        last = first
        while last < len(taken) and taken[last][0] < e:
            last += 1
        own, first = taken[first:last], last
        edges = sorted({(a, b) for a, b, _ in own})
        at = 0
        for a, b, k in decode(text, s, e, own, scorer):
            while at < len(edges) and edges[at][1] <= a and (at + 1 == len(edges) or edges[at + 1][0] <= a):
                at += 1
            if not any(x < b and y > a for x, y in edges[max(0, at - len(KINDS)) : at + len(KINDS) + 1]):
                out.append((a, b, k))
    return out


_SCORERS: list[tuple[dict, _Scorer]] = []


def _scorer_of(weights: dict[tuple[str, str], float]) -> _Scorer:
    """One scorer for all texts that are scored by the same weights."""
    if not _SCORERS or _SCORERS[0][0] is not weights:
        _SCORERS[:] = [(weights, _Scorer(weights))]
    return _SCORERS[0][1]


def find_spans(text: str, weights: dict[tuple[str, str], float]) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans), each in order."""
    base = base_spans(text)
    return base, in_order(base + added_spans(text, base, _scorer_of(weights)))


def named(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def redacted(text: str, spans: list[Span]) -> str:
    """text with each span, or run of overlapping spans, replaced by its first kind in brackets."""
    out, at = [], 0
    for s, e, k in spans:
        if s >= at:
            out += [text[at:s], f"[{k.upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def _over_texts(df: DataFrame, place: int, added: list[StructField], work) -> DataFrame:
    names = [f.name for f in added]
    kinds = pa.schema([(f.name, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())])) if isinstance(f.dataType, ArrayType) else pa.string()) for f in added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                rows = [work(t) for t in part.column(place).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, *(pa.array([r[i] for r in rows], kinds.field(i).type) for i in range(len(names)))], names=[*part.schema.names, *names])

    return df.mapInArrow(tidy(run), StructType([*df.schema.fields, *added]))


def scan(df: DataFrame, text: str) -> DataFrame:
    """Add base_spans and spans (arrays of start, end, kind in code points) and redacted (the text without them) to df.

    Cases: a null text is empty and stays null in redacted; repeated rows get equal results; an empty table stays empty; other
    columns are carried, those with the outputs' names replaced; texts of any length are read whole, in time in proportion to them; of
    segmentations that score alike the one that leaves more text outside, then begins entities earlier and names the earlier kind, stands. For bounds of the field's segments see the module.
    """
    df = df.drop("base_spans", "spans", "redacted")
    weights = train()
    found = ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("kind", StringType())]))
    as_rows = lambda spans: [{"start": s, "end": e, "kind": k} for s, e, k in spans]

    def work(t: str | None) -> tuple:
        if not t:
            return [], [], t
        base, every = find_spans(t, weights)
        return as_rows(base), as_rows(every), redacted(t, every) if every else t

    return _over_texts(df, df.columns.index(text), [StructField("base_spans", found), StructField("spans", found), StructField("redacted", StringType())], work)
