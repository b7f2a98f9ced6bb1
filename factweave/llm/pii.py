"""Personal data: base patterns, and a semi-Markov conditional random field that adds spans.

Base patterns find e-mail addresses, IP addresses, card and phone numbers by
form. The field finds what the forms miss (card numbers with a wrong check digit,
phone numbers without a plus sign, spelled-out e-mail addresses, ...). It reads a
window of tokens around each digit or at sign. Whole candidate spans of at most
``MAX_TOKENS`` tokens are scored by features of the span (shape, numbers of
digits, separators, check digit, cue words beside it), and pairs of neighbouring
segments by their types; a dynamic programme chooses the boundaries and types of
all spans of a window together. The weights are trained here, by likelihood over
all segmentations, on a fixed generated training set.

Cases: null or empty text has no spans; texts are read whole, in linear time;
repeated rows give repeated rows; empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import math
import random
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factweave.llm.common import pick

KINDS = ("email", "ip", "card", "phone")
_EMAIL_LEFT = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_EMAIL_RIGHT = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A match always starts where a run of digits starts, so looking there alone is the same and linear.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """Spans of the base patterns, leftmost and non-overlapping for each kind, in code points."""
    found: list[Span] = []
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _EMAIL_LEFT:
            start -= 1
        if start < at and (m := _EMAIL_RIGHT.match(text, at + 1)):
            end = m.end()
            found.append((start, end, "email"))
        at = text.find("@", max(at + 1, end))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            found.append((m.start(), m.end(), "ip"))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(d := _digits(m.group())) <= 19 and luhn(d):
            found.append((m.start(), m.end(), "card"))
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m.group())) <= 15:
            found.append((m.start(), m.end(), "phone"))
    return sorted(found, key=_order)


def _order(span: Span) -> tuple[int, int, int]:
    return span[0], KINDS.index(span[2]), span[1]


# ---- the semi-Markov field ----

MAX_TOKENS = 16
TRIGGER = re.compile(r"[0-9@]|(?i:[\[({<][ ]?at[ ]?[\])}>])|(?i:\bdot\b)")
TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]|_")
#: A window holds the tokens around triggers that lie at most this many characters apart, and so many beside them.
WINDOW_GAP, WINDOW_SIDE = 48, 48
#: Cue words, by what they hint at.
CUES = {
    "call": "tel telephone phone phones call calls called ring dial mobile cell fax text whatsapp sms reach hotline",
    "card": "card cards visa mastercard amex credit debit pay paid charge charged billing cvv",
    "ip": "ip host server address router ping gateway subnet",
    "mail": "email mail mails write contact inbox send cc reply",
    "ref": "ref reference invoice order no nr number id isbn issn doi version v serial account acct sku iban vat tax ticket case part tracking parcel policy build patent zip",
    "date": "on dated since until due between from date day year born",
}
_CUE = {word: cue for cue, words in CUES.items() for word in words.split()}
_DATE = re.compile(r"(?:(?:[0-2]?\d|3[01])[./ -](?:0?\d|1[0-2])[./ -](?:19|20)?\d\d|(?:19|20)\d\d[./ -](?:0?\d|1[0-2])[./ -](?:[0-2]?\d|3[01]))(?!\d)")
_AT, _DOT = r"(?:@|[(\[{<] ?at ?[)\]}>]|\bat\b)", r"(?:\.|[(\[{<] ?dot ?[)\]}>]|\bdot\b)"
_SPELLED = re.compile(rf"[\w+-]+(?:\s?{_DOT}\s?[\w+-]+)*\s?{_AT}\s?[\w-]+(?:\s?{_DOT}\s?[\w-]+)+")
_IBAN = re.compile(r"[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4})*[ ]?$")


def _shape(c: str) -> str:
    return "A" if c.isalpha() else "9" if c.isdigit() else c


def span_features(tokens, i: int, j: int, text: str) -> list[str]:
    """Features of the whole span of tokens i..j-1."""
    start, end = tokens[i][0], tokens[j - 1][1]
    span = text[start:end]
    d = _digits(span)
    n, low = len(d), span.lower()
    letters = sum(c.isalpha() for c in span)
    groups = [len(x) for x in re.findall(r"\d+", span)]
    marks = sorted({c for c in span if not c.isalnum()})
    few = "few" if len(groups) <= 6 else "many"
    out = [f"digits={n if n < 20 else 'many'}", f"first={_shape(span[0])}", f"last={_shape(span[-1])}", f"letters={min(letters, 3)}", "marks=" + "".join(marks)[:8]]
    out.append("groups=" + ("-".join(map(str, groups)) if few == "few" else few))
    if not letters and n:
        out += [f"digits={n} {few} groups", f"kinds of marks={len(marks)}", f"begins={'+' if span[0] == '+' else '0' if d[0] == '0' else '9'}, digits={min(n, 20)}"]
        if 12 <= n <= 19:
            out += ["long number", f"luhn={luhn(d)}", f"issuer={d[0] in '3456'}", f"even groups={len(set(groups[:-1])) <= 1 and groups[-1] <= groups[0]}"]
        if 9 <= n <= 12 and len(groups) >= 2 and max(groups) <= 8 and len(marks) <= 3:
            out.append("grouped like a phone" + (", zero" if d[0] == "0" else ""))
        if span[:2] in ("19", "20") and groups[0] == 4:
            out.append("begins like a year")
    if _DATE.search(span):
        out.append("holds a date")
    if len(groups) == 4 and span.count(".") == 3 and letters == 0:
        out.append(f"four parts, byte={all(int(x) <= 255 for x in re.findall('[0-9]+', span) if len(x) < 10)}")
    cues = {_CUE[w] for k in range(max(0, i - 5), i) if (w := text[tokens[k][0] : tokens[k][1]].lower()) in _CUE}
    if letters:
        at, dot = "@" in span or bool(re.search(_AT, low)), bool(re.search(_DOT, low))
        form = _SPELLED.fullmatch(low)
        out.append(f"at={at} dot={dot}")
        if form:
            kind = "sign" if "@" in span else "bracket" if re.search(r"[(\[{<] ?at", low) else "word"
            plain = "." in span.partition("@")[2] if kind == "sign" else False
            name = re.split(_AT, low)[0].strip()
            out += [f"address form, {kind}", f"address form, {kind}, cue={'mail' in cues}", f"address form, {kind}, odd name={bool(re.search(r'[0-9_.+-]|dot', name))}", f"plain domain={plain}"]
            if kind == "word":
                out.append(f"marks of {'dots' if '.' in span else 'words'}, cue={'mail' in cues}")
        else:
            out.append("letters, no address form")
    for cue in cues or {"none"}:
        out += [f"cue={cue}", f"cue={cue}, {'letters' if letters else 'long' if n >= 12 else 'short'}"]
    if _IBAN.search(text[max(0, start - 34) : start]) or _IBAN.match(span[:4]):
        out.append("in an account number")
    for side, k in (("left", i - 1), ("right", j)):
        if 0 <= k < len(tokens):
            t = text[tokens[k][0] : tokens[k][1]]
            touch = (tokens[k][1] == start) if side == "left" else (tokens[k][0] == end)
            gap = abs(tokens[k][1] - start if side == "left" else tokens[k][0] - end)
            out.append(f"{side}={_shape(t[0])}{' touches' if touch else ''}")
            if t.lower() in ("at", "dot") or t == "@":
                out.append(f"{side} goes on")
            if t[0].isdigit() and gap <= 1:
                out.append(f"{side} digits go on")
        else:
            out.append(f"{side}=edge")
    return out


def candidates(tokens, text: str) -> list[tuple[int, int]]:
    """Candidate spans as token ranges: enough digits, or a sign or word for at with what an address needs, and no white space wider than one character."""
    out = []
    words = [text[s:e] for s, e in tokens]
    for i, first in enumerate(words):
        if not (first[0].isalnum() or first[0] in "+("):
            continue
        digits, sign, dot = 0, False, False
        for j in range(i + 1, min(len(tokens), i + MAX_TOKENS) + 1):
            s, e = tokens[j - 1]
            if j - 1 > i and s - tokens[j - 2][1] > 1:
                break
            word = words[j - 1]
            if word[0].isdigit():
                digits += len(word)
            elif sign and (word == "." or word in ("dot", "DOT", "Dot")):
                dot = True
            elif word == "@" or word in ("at", "AT", "At"):
                sign = sign or j - 1 > i
            if word[-1].isalnum() and (digits >= 7 or sign and dot and j - i >= 5 or word[0].isdigit() and digits >= 4 and j - i >= 7):
                out.append((i, j))
    return out


NONE = len(KINDS)


class SemiMarkovField:
    """Weights of features for each type, and of pairs of neighbouring segments' types.

    Tokens outside entities are segments of type NONE with score 0; two such segments side by side have weight 0.
    """

    def __init__(self):
        self.w: dict[str, list[float]] = {"bias": [-2.0] * NONE}
        self.pairs = [[0.0] * (NONE + 1) for _ in range(NONE + 1)]

    def scores(self, feats) -> list[float]:
        a, b, c, d = self.w["bias"]
        get = self.w.get
        for f in feats:
            if (x := get(f)) is not None:
                a, b, c, d = a + x[0], b + x[1], c + x[2], d + x[3]
        return [a, b, c, d]

    def most_gained(self) -> list[float]:
        """By type: the most that pairs can add to a segment's score, against tokens of type NONE in its place."""
        t, every = self.pairs, range(NONE + 1)
        return [max(t[a][k] - t[a][NONE] for a in every) + max(t[k][b] - t[NONE][b] for b in every) for k in range(NONE)]

    def decode(self, n: int, spans) -> list[tuple[int, int, str]]:
        """The best segmentation of n tokens; ``spans`` has (i, j, scores by type)."""
        ending: dict[int, list] = {}
        for i, j, by in spans:
            ending.setdefault(j, []).append((i, by))
        stops = sorted({0, n, *(x for i, j, _ in spans for x in (i, j))})
        t, every, low = self.pairs, range(NONE + 1), float("-inf")
        best: dict[int, list[float]] = {0: [low] * NONE + [0.0]}
        back: dict[tuple[int, int], tuple] = {}
        for before, at in zip(stops, stops[1:]):
            a = max(every, key=lambda x: best[before][x] + t[x][NONE])
            row = [low] * NONE + [best[before][a] + t[a][NONE]]
            back[at, NONE] = (before, a)
            for i, by in ending.get(at, ()):
                for k in range(NONE):
                    a = max(every, key=lambda x: best[i][x] + t[x][k])
                    if (v := best[i][a] + t[a][k] + by[k]) > row[k]:
                        row[k], back[at, k] = v, (i, a)
            best[at] = row
        out, at = [], n
        label = max(reversed(every), key=lambda x: best[n][x])
        while at:
            i, a = back[at, label]
            if label != NONE:
                out.append((i, at, KINDS[label]))
            at, label = i, a
        return out[::-1]

    def marginals(self, n: int, spans):
        """Probability of each typed span, and the expected number of each pair of types, under all segmentations (forward-backward in logarithms)."""
        ending: dict[int, list] = {}
        starting: dict[int, list] = {}
        for i, j, by in spans:
            ending.setdefault(j, []).append((i, by))
            starting.setdefault(i, []).append((j, by))
        t, every, low = self.pairs, range(NONE + 1), float("-inf")
        into: list[list[float]] = []  # by position and type: all that leads to a segment of the type there
        ahead = [[low] * NONE + [0.0]]
        for j in range(n + 1):
            if j:
                row = [low] * NONE + [into[j - 1][NONE]]
                parts: list[list[float]] = [[] for _ in KINDS]
                for i, by in ending.get(j, ()):
                    for k in range(NONE):
                        parts[k].append(into[i][k] + by[k])
                for k in range(NONE):
                    if parts[k]:
                        row[k] = _log_sum(parts[k])
                ahead.append(row)
            into.append([_log_sum([ahead[j][a] + t[a][b] for a in every]) for b in every])
        behind = [[0.0] * (NONE + 1) for _ in range(n + 1)]
        follow: list[list[float]] = [[] for _ in range(n)]  # by position and type: a segment of the type there and all after it
        for i in range(n - 1, -1, -1):
            row = [low] * NONE + [behind[i + 1][NONE]]
            parts = [[] for _ in KINDS]
            for j, by in starting.get(i, ()):
                for k in range(NONE):
                    parts[k].append(by[k] + behind[j][k])
            for k in range(NONE):
                if parts[k]:
                    row[k] = _log_sum(parts[k])
            follow[i] = row
            behind[i] = [_log_sum([t[a][b] + row[b] for b in every]) for a in every]
        total = _log_sum(ahead[n])
        p = {(i, j): [math.exp(into[i][k] + by[k] + behind[j][k] - total) for k in range(NONE)] for i, j, by in spans}
        pairs = [[0.0] * (NONE + 1) for _ in every]
        for i in range(n):
            for a in every:
                if ahead[i][a] > low:
                    for b in every:
                        if follow[i][b] > low:
                            pairs[a][b] += math.exp(ahead[i][a] + t[a][b] + follow[i][b] - total)
        return p, pairs

    def train(self, examples, rounds: int = 5, rate: float = 0.3, decay: float = 1e-3) -> SemiMarkovField:
        """Gradient ascent on the likelihood of ``examples`` (text, gold spans in characters)."""
        ready = []
        for text, gold in examples:
            tokens = [m.span() for m in TOKEN.finditer(text)]
            found = candidates(tokens, text)
            kinds = {(s, e): KINDS.index(k) for s, e, k in gold}
            want = {(i, j): kinds[key] for i, j in found if (key := (tokens[i][0], tokens[j - 1][1])) in kinds}
            ready.append((len(tokens), [(i, j, [*span_features(tokens, i, j, text), "bias"]) for i, j in found], want))
        for _ in range(rounds):
            for n, spans, want in ready:
                for _, _, feats in spans:
                    for f in feats:
                        self.w.setdefault(f, [0.0] * NONE)
                p, pairs = self.marginals(n, [(i, j, self.scores(f[:-1])) for i, j, f in spans])
                for i, j, feats in spans:
                    gold = want.get((i, j))
                    for k in range(NONE):
                        step = rate * ((k == gold) - p[i, j][k])
                        if abs(step) > 1e-4:
                            for f in feats:
                                row = self.w[f]
                                row[k] += step - rate * decay * row[k]
                at, last = 0, NONE
                ends = {i: (j, k) for (i, j), k in want.items()}
                while at < n:
                    at, label = ends.get(at, (at + 1, NONE))
                    pairs[last][label] -= 1
                    last = label
                for a in range(NONE + 1):
                    for b in range(NONE + 1):
                        if a != NONE or b != NONE:
                            self.pairs[a][b] -= rate / 4 * (pairs[a][b] + decay * self.pairs[a][b])
        return self

    def find(self, text: str) -> list[Span]:
        """Spans of a whole text, window by window; a window is decoded whole, whatever its length."""
        out: list[Span] = []
        gain = self.most_gained()
        for start, end in windows(text):
            tokens = [(m.start(), m.end()) for m in TOKEN.finditer(text, start, end)]
            spans = []
            for i, j in candidates(tokens, text):
                by = self.scores(span_features(tokens, i, j, text))
                if any(by[k] + gain[k] > 0 for k in range(NONE)):  # no other can be part of the best
                    spans.append((i, j, by))
            if spans:
                out += [(tokens[i][0], tokens[j - 1][1], k) for i, j, k in self.decode(len(tokens), spans)]
        return out


def windows(text: str) -> Iterator[tuple[int, int]]:
    """Stretches of text around triggers, cut at white space."""
    start = end = None
    for m in TRIGGER.finditer(text):
        if start is not None and m.start() - end <= WINDOW_GAP:
            end = m.end()
            continue
        if start is not None:
            yield _widen(text, start, end)
        start, end = m.span()
    if start is not None:
        yield _widen(text, start, end)


def _widen(text: str, start: int, end: int) -> tuple[int, int]:
    left = max(0, start - WINDOW_SIDE)
    right = min(len(text), end + WINDOW_SIDE)
    if left and (m := re.search(r"\s", text[left:start])):
        left += m.start()
    if right < len(text):
        cut = max(text.rfind(" ", end, right), text.rfind("\n", end, right))
        right = cut if cut > end else right
    return left, right


def _log_sum(values) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


#: Words of the training set's prose.
PROSE = "the of and to a in is was for it with as his on be at by had not are but from or have an they which one you were all her she there would their we him been has when who will no more if out so up said what its about than into them can only other time new some could these two may first then do any like my now over such our man me even most made after also did many off before must well back through years much where your way down should because long each just state those people too how good make still own see work life between being under never day same another know while last might us great go come since against came right take used".split()


def training_set(size: int = 420, seed: int = 7) -> list[tuple[str, list[Span]]]:
    """Generated lines with personal data, with and without cues, and with numbers and phrases that are none."""
    r = random.Random(seed)
    syllables = "an be co da el fi go ha in jo ka le mo ne or pe ra st tion ure".split()

    def name() -> str:
        return "".join(r.choice(syllables) for _ in range(r.randint(1, 4)))

    def word() -> str:
        return r.choice(PROSE) if r.random() < 0.6 else name()

    def digits(n: int) -> str:
        return str(r.randint(1, 9)) + "".join(str(r.randint(0, 9)) for _ in range(n - 1))

    def cue(kind: str) -> str:
        words = CUES[kind].split()
        return r.choice([r.choice(words), r.choice(words) + ":", "my " + r.choice(words) + " is", r.choice(words) + " me at" if kind == "mail" else r.choice(words)]) + " "

    def email() -> str:
        at, dot = r.choice([("@", "."), (" at ", " dot "), (" at ", " dot "), (" (at) ", " (dot) "), ("[at]", "[dot]"), (" [at] ", " [dot] "), (" @ ", "."), (" at ", ".")])
        inner = {".": ".", " dot ": " dot "}.get(dot, ".")
        who = name() + r.choice(["", inner, "_", "-" if at == "@" else inner]) + r.choice([name(), digits(2)])
        where = name() + r.choice(["", "", digits(1)])
        said = f"{who}{at}{where}{dot}{r.choice(['com', 'org', 'example', 'net', 'de'])}{r.choice(['', '', dot + 'uk'])}"
        # A word for at is no address without a cue, but for names that people do not have in prose.
        return (cue("mail") if at == " at " else ""), said

    def ip() -> str:
        return r.choice(["", cue("ip")]), ".".join(str(r.randint(0, 255)) for _ in range(4))

    def card() -> str:
        n = r.choice(["4", "5", "37", "6", "2"]) + digits(15)
        n = n[: r.choice([16, 16, 16, 15])]
        sep = r.choice(["", "", " ", "-"])
        return r.choice(["", cue("card")]), sep.join(n[i : i + 4] for i in range(0, len(n), 4)) if sep else n

    def phone() -> str:
        a, b, c = digits(3), digits(3), digits(4)
        forms = [
            f"+{digits(1)} ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a} {b} {c}", f"+{digits(2)} {a} {b}{c}", f"{a}.{b}.{c}", f"0{digits(3)} {digits(6)}", f"0{digits(4)} {digits(6)}", f"0{digits(2)} {digits(4)} {digits(4)}",
            f"0{digits(3)} {b} {c}", f"(0{digits(2)}) {digits(4)} {digits(4)}", f"0{digits(1)} {digits(2)} {digits(2)} {digits(2)} {digits(2)}", f"0{digits(2)}/{digits(7)}", f"1-{a}-{b}-{c}", f"00{digits(2)} {a} {digits(6)}",
        ]
        return r.choice(["", cue("call"), cue("call")]), r.choice(forms)

    def date() -> str:
        d, m, y = f"{r.randint(1, 28):02d}", f"{r.randint(1, 12):02d}", r.randint(1950, 2040)
        return r.choice([f"{d}.{m}.{y}", f"{y}-{m}-{d}", f"{d}/{m}/{y}", f"{d}.{m}.{y} {r.randint(8, 20)}", f"{d}.{m}.{y} {r.randint(8, 20)}:{r.randint(10, 59)}", f"{y}-{m}-{d} {r.randint(10, 23)}:{r.randint(10, 59)}:{r.randint(10, 59)}", f"{y}-{r.randint(2000, 2040)} {digits(3)}", f"{d}.{m}.{y} - {d}.{m}.{y + 1}"])

    def other() -> str:
        hexa = "".join(r.choice("0123456789abcdef") for _ in range(r.choice([16, 32, 40, 40])))
        country = "".join(r.choice("ABDEFGINRSTU") for _ in range(2))
        return r.choice([
            f'{r.choice(["token", "key", "id"])} = "{hexa}"', date(), date(), date(), f"version {r.randint(1, 9)}.{r.randint(0, 9)}.{r.randint(0, 20)}", digits(r.randint(1, 8)), digits(r.randint(20, 30)), f"{digits(2)},{digits(3)},{digits(3)}",
            f"{digits(2)}.{digits(2)}", f"{r.randint(10, 23)}:{r.randint(10, 59)}:{r.randint(10, 59)}", f"{word()} at {word()} {word()}", f"{name()}{digits(8)}", f"{digits(3)} {word()} {digits(4)}", f"ISBN {digits(3)}-{digits(1)}-{digits(2)}-{digits(6)}-{digits(1)}",
            f"@{name()}", f"{digits(4)} {digits(4)}", hexa, f"AKIA{hexa[:16].upper()}", f"{name()}({digits(2)})", f"{word()} at {word()} dot com {word()}", f"looked at {name()} dot com", f"the {word()} at {name()} dot {r.choice(['com', 'org'])} {word()} {word()}",
            f"{cue('ref')}{r.randint(1990, 2040)}-{digits(4)}-{digits(4)}-{digits(4)}", f"{cue('ref')}{digits(4)}-{digits(4)}-{digits(4)}", f"{cue('ref')}{digits(r.randint(9, 16))}", f"{cue('ref')}{digits(3)} {digits(3)} {digits(4)}", f"{country}{digits(2)} {digits(4)} {digits(4)} {digits(4)} {digits(4)} {digits(2)}",
            f"{country}{digits(2)} {name()[:4].upper()} {digits(4)} {digits(4)} {digits(4)} {digits(2)}", f"{country}{digits(20)}", f"{digits(3)} {digits(3)} {digits(3)} {r.choice(['people', 'euros', 'years', 'miles'])}", f"{r.choice(['from', 'between'])} {r.randint(1800, 2040)} to {r.randint(1800, 2040)}, {digits(3)} and {digits(3)}",
            f"{digits(1)}.{digits(6)}, {digits(2)}.{digits(6)}", f"{digits(3)}.{digits(3)},{digits(2)}", f"{digits(2)} {digits(2)} {digits(2)} {digits(2)} {digits(2)}",
        ])

    makers = {"email": email, "ip": ip, "card": card, "phone": phone}
    out = []
    for _ in range(size):
        text, gold = "", []
        for _ in range(r.randint(2, 4)):
            text += " ".join(word() for _ in range(r.randint(1, 4))) + " "
            kind = r.choice([*KINDS, "phone", "other", "other", "other", "other", "other"])
            before, s = makers[kind]() if kind in makers else ("", other())
            text += before
            if kind in makers:
                gold.append((len(text), len(text) + len(s), kind))
            text += s + r.choice(["", ".", ",", "&&&", "###", "$$$"]) + r.choice([" ", " ", " ", "\n"])
        out.append((text + word(), gold))
    return out


@functools.cache
def trained() -> SemiMarkovField:
    return SemiMarkovField().train(training_set())


def all_spans(text: str, field: SemiMarkovField) -> tuple[list[Span], list[Span]]:
    """The base spans, and all spans: base ones, and those of the field that touch none of them."""
    base = base_spans(text)
    added = field.find(text)
    if base and added:
        taken = sorted((s, e) for s, e, _ in base)
        added = [x for x in added if not any(s < x[1] and x[0] < e for s, e in taken)] if len(taken) < 50 else _free_of(added, taken)
    return base, sorted(base + added, key=_order)


def _free_of(added, taken):
    """``added`` (in order) without what overlaps ``taken`` (in order), in one pass."""
    out, k, reach = [], 0, -1
    for x in added:
        while k < len(taken) and taken[k][0] < x[1]:
            reach = max(reach, taken[k][1])
            k += 1
        if reach <= x[0]:
            out.append(x)
    return out


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def personal_data(docs: DataFrame, field: SemiMarkovField | None = None) -> DataFrame:
    """``doc_id``, base counts, the base spans' digest and all spans for every row of ``docs``."""
    field = field or trained()

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            columns: list[list] = [[] for _ in range(6)]
            for text in batch.column(1):
                base, spans = all_spans(text.as_py() or "", field)
                for c, k in zip(columns, KINDS):
                    c.append(sum(1 for x in base if x[2] == k))
                columns[4].append(hashlib.sha256(joined(base).encode()).hexdigest())
                columns[5].append(joined(spans))
            out = [pa.array(c, pa.int64() if i < 4 else pa.string()) for i, c in enumerate(columns)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *out], ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    rows = pick(docs, doc_id="doc_id", text="text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string")


def masked_documents(docs: DataFrame, field: SemiMarkovField | None = None) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; ``n_chars``, if there, is counted anew."""
    field = field or trained()

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            at = batch.schema.get_field_index("_text")
            out = []
            for text in batch.column(at):
                raw = text.as_py()
                if raw:
                    parts, upto = [], 0
                    for s, e, k in all_spans(raw, field)[1]:
                        if e > upto:
                            parts += [raw[upto : max(s, upto)], f"<{k}>"]
                            upto = e
                    raw = "".join(parts) + raw[upto:]
                out.append(raw)
            yield batch.set_column(at, "_text", pa.array(out, pa.string()))

    names = docs.columns
    work = docs.toDF(*(f"_{i}" for i in range(len(names)))).withColumnRenamed(f"_{names.index('text')}", "_text")
    work = work.mapInArrow(run, work.schema)
    out = {"text": F.col("_text"), "n_chars": F.length("_text").cast("long")}
    return work.select(*(out.get(n, F.col(f"_{i}")).alias(n) for i, n in enumerate(names)))
