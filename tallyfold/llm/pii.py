"""Personal data by fixed patterns and a semi-Markov conditional random field.

The patterns give the base spans, which always stay. The field then looks where
patterns do not reach (obfuscated addresses, numbers without their usual marks,
keys and passwords that a text gives away beside their name).
Its segments are whole candidate spans of at most SPAN tokens, scored by
features of the span as a whole (shape, digit count, checks, the word before
it); everything else is single tokens of kind O. Dynamic programming over the
bounded segments chooses boundaries and kinds jointly. The weights are fitted
here, by gradient ascent on the exact likelihood of generated sentences.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left
from functools import lru_cache
from math import exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, slices

KINDS = ("email", "ip", "card", "phone")
#: Kinds of the field: those of the patterns, and secrets.
FIELD_KINDS = (*KINDS, "secret")
#: The base patterns of the contract (fixed values).
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
#: Everything that IP can match lies in such runs; its matches are their numbers, four by four.
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Tokens in the longest segment.
SPAN = 9
#: Runs of at least KEY letters and digits, both among them, are one token; they read the same backwards, as all tokens do.
KEY = 20
TOKEN = re.compile(rf"(?<![^\W_])(?=[A-Za-z]*[0-9])(?=[0-9]*[A-Za-z])[A-Za-z0-9]{{{KEY},}}+(?![^\W_])|[0-9]+|[^\W\d_]+|[^\w\s]|_")
#: Every segment holds a run of letters and digits with a digit, or the word that stands for @.
HOT = re.compile(r"(?<![A-Za-z0-9])[A-Za-z]*+[0-9][A-Za-z0-9]*+|(?<![^\W\d_])[aA][tT](?![^\W\d_])")
_RUN = re.compile(r"[^\W_]*")
#: Tokens on each side of it that its segments and their features can reach.
REACH = SPAN + 3
CUES = {"email": {"mail", "email", "contact", "write"}, "ip": {"ip", "host", "address", "server"}, "card": {"card", "visa", "mastercard", "amex"}, "phone": {"phone", "call", "tel", "mobile", "fax", "telephone"}, "secret": {"token", "key", "apikey", "secret", "password", "passwd", "pwd", "bearer"}}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _number(word: str) -> bool:
    return word.isascii() and word.isdigit()


def _keylike(word: str) -> bool:
    return len(word) >= KEY and word.isascii() and word.isalnum() and not word.isalpha() and not word.isdigit()


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, kinds in their fixed order, by start."""
    out = []
    at = text.find("@")
    done = 0
    while at >= 0:  # a match holds the first @ after its beginning, so only the word before an @ can begin one
        begin = at
        while begin > done and (text[begin - 1].isascii() and (text[begin - 1].isalnum() or text[begin - 1] in "._%+-")):
            begin -= 1
        m = EMAIL.match(text, begin) if begin < at else None
        if m:
            out.append(("email", m.start(), m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    if not re.search("[0-9]", text):
        return out
    for m in DOTTED.finditer(text):  # IP itself takes quadratic time on long numbers
        parts, begin = m[0].split("."), m.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = begin + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                out.append(("ip", begin, end))
            begin = end + 1
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            d = _digits(m[0])
            if 16 <= len(d) <= 19 and luhn(d):
                out.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(_digits(m[0])) <= 15:
                out.append(("phone", *m.span()))
    return out


def span_features(kind: str, words: list[str], a: int, b: int, seen: str) -> tuple[str, ...]:
    """Features of words[a:b] (text `seen`) as one segment of `kind`."""
    own = words[a:b]
    low = [w.lower() for w in own]
    d = _digits(seen)
    before = next((w.lower() for w in reversed(words[max(0, a - 3) : a]) if w[0].isalpha()), "")
    if kind == "secret":
        marks = [w for w in words[max(0, a - 2) : a] if not w[0].isalnum()]
        return tuple(f"{kind}|{x}" for x in ("bias", f"cue{before in CUES[kind]}", f"given{any(w in '=:' for w in marks)}", f"hex{set(low[0]) <= set('0123456789abcdef')}", f"length{min(len(seen) // 8, 10)}"))
    groups = [w for w in own if _number(w)]
    shape = re.sub("[0-9]+", "9", re.sub(r"[^\W\d_]+", "a", seen))
    f = [f"digits{min(len(d), 20)}", f"shape:{shape}", f"groups{len(groups)}", f"cue{before in CUES[kind]}", "bias"]
    if kind == "email":
        f += [f"at{sum(w == 'at' for w in low)}", f"dot{min(2, sum(w == 'dot' for w in low))}", f"whole{bool(own[0][0].isalpha() and own[-1][0].isalpha())}"]
    elif kind == "ip":
        f += [f"octets{len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups)}", f"dots{sum(w == 'dot' or w == '.' for w in low)}"]
    elif kind == "card":
        f += [f"luhn{len(d) > 11 and luhn(d)}", f"even{len({len(g) for g in groups}) == 1}"]
    else:
        f += [f"lengths:{'-'.join(str(len(g)) for g in groups)}", f"edges{own[0] in '(+' or _number(own[0])}{_number(own[-1])}"]
    return tuple(f"{kind}|{x}" for x in f)


def candidates(words: list[str], spans: list[tuple[int, int]], text: str) -> list[tuple[int, int, str]]:
    """Segments (first token, end token, kind) worth a score: bounded, and of a form the kind can have."""
    out = []
    at = [i for i, w in enumerate(words) if w.lower() == "at"]
    for i in at:
        for a in range(max(0, i - 3), i):
            for b in range(i + 3, min(len(words), a + SPAN) + 1):
                if words[a][0].isalnum() and words[b - 1][0].isalpha() and any(w.lower() == "dot" or w == "." for w in words[i + 1 : b]):
                    out.append((a, b, "email"))
    for a in range(len(words)):
        if not (_number(words[a]) or words[a] in "(+"):
            continue
        digits = 0
        for b in range(a + 1, min(len(words), a + SPAN) + 1):
            w = words[b - 1]
            if _number(w):
                digits += len(w)
            elif not (w in "()+-./" or w.lower() == "dot") or b - 1 > a and spans[b - 1][0] - spans[b - 2][1] > 2:
                break
            if digits > 19:
                break
            if _number(w):
                if 4 <= digits <= 12 and b - a >= 7:
                    out.append((a, b, "ip"))
                if 12 <= digits <= 19:
                    out.append((a, b, "card"))
                if 7 <= digits <= 15 and b - a >= 2:
                    out.append((a, b, "phone"))
    return out + [(i, i + 1, "secret") for i, w in enumerate(words) if _keylike(w)]


def _logadd(x: float, y: float) -> float:
    if x < y:
        x, y = y, x
    return x if y == -np.inf else x + log(1 + exp(y - x))


class SemiMarkov:
    """Segments score by the weights of their features, single O tokens by 0."""

    def __init__(self, weights: dict[str, float]):
        self.weights = weights

    def decode(self, text: str, stretches: list[tuple[int, int]] | None = None) -> list[tuple[str, int, int]]:
        """The best segmentation's entities, as (kind, start, end)."""
        out = []
        for begin, end in windows(text) if stretches is None else stretches:
            spans = [(begin + m.start(), begin + m.end()) for m in TOKEN.finditer(text[begin:end])]
            words = [text[a:b] for a, b in spans]
            ending: dict[int, list[tuple[int, str, float]]] = {}
            for a, b, kind in candidates(words, spans, text):
                s = sum(self.weights.get(f, 0.0) for f in span_features(kind, words, a, b, text[spans[a][0] : spans[b - 1][1]]))
                if s > 0:
                    ending.setdefault(b, []).append((a, kind, s))
            if not ending:
                continue
            best, back = [0.0] * (len(words) + 1), [None] * (len(words) + 1)
            for b in range(1, len(words) + 1):
                best[b] = best[b - 1]
                for a, kind, s in ending.get(b, ()):
                    if best[a] + s > best[b]:
                        best[b], back[b] = best[a] + s, (a, kind)
            b = len(words)
            while b:
                if back[b]:
                    a, kind = back[b]
                    out.append((kind, spans[a][0], spans[b - 1][1]))
                    b = a
                else:
                    b -= 1
        return out


def windows(text: str, near: int = 100) -> list[tuple[int, int]]:
    """Stretches that hold every possible segment and the tokens its features see; elsewhere all tokens are O in any best path.

    A stretch reaches REACH whole tokens to each side of what HOT finds,
    however long those tokens and the white space between them are.
    """
    out: list[tuple[int, int]] = []
    hot: list[list[int]] = []
    for m in HOT.finditer(text):
        if hot and m.start() - hot[-1][1] <= near:
            hot[-1][1] = m.end()
        else:
            hot.append([m.start(), m.end()])
    for a, b in hot:
        if out and a <= out[-1][1]:  # begins inside the last stretch, whose left side it shares
            begin = out.pop()[0]
        else:
            begin = a - _reach(lambda n, a=a: text[max(0, a - n) : a][::-1], a)
            if out and begin <= out[-1][1]:
                begin = out.pop()[0]
        out.append((begin, b + _reach(lambda n, b=b: text[b : b + n], len(text) - b)))
    return out


def _reach(ahead, left: int) -> int:
    """Characters that hold the next REACH tokens of ahead(n), the next n of `left` characters (tokens read the same backwards)."""
    n = 200
    while True:
        last, seen = 0, ahead(n)
        for k, m in enumerate(TOKEN.finditer(seen), 1):
            if n < left and (m.end() == n or _RUN.fullmatch(seen, m.start())):  # the token, or a run that may be one, goes on
                break
            last = m.end()
            if k == REACH:
                return last
        if n >= left:
            return last
        n *= 4


def examples(n: int, seed: int) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """Generated sentences with their entities: what the fit and its held-out check use."""
    rng = random.Random(seed)
    syll = ["an", "er", "the", "on", "in", "re", "ti", "es", "la", "de", "mo", "ka", "lu"]
    word = lambda: "".join(rng.choice(syll) for _ in range(rng.randint(1, 3)))
    num = lambda k: "".join(rng.choice("0123456789") for _ in range(k))

    def mixed() -> str:
        letters = rng.choice(["abcdef", "abcdef", "ABCDEF", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"])
        return "a" + "".join(rng.choice("0123456789" + letters) for _ in range(rng.choice([22, 30, 38, 62]))) + "7"

    def card() -> str:
        d = rng.choice("3456") + num(14)
        return next(d + c for c in "0123456789" if luhn(d + c))

    def entity() -> tuple[str, str]:
        kind = rng.choice(FIELD_KINDS)
        if kind == "secret":
            return kind, mixed()
        if kind == "email":
            at, dot = rng.choice([(" at ", " dot "), ("[at]", "[dot]"), (" [at] ", " [dot] "), ("(at)", "(dot)"), (" (at) ", "."), (" AT ", " DOT ")])
            return kind, f"{word()}{at}{word()}{dot}{rng.choice(['com', 'org', 'net', 'de', 'fr'])}"
        if kind == "ip":
            return kind, rng.choice([" . ", " dot ", " dot "]).join(str(rng.randint(1, 255)) for _ in range(4))
        if kind == "card":
            d = card()
            return kind, rng.choice([".", " / ", "/"]).join(d[i : i + 4] for i in range(0, 16, 4))
        a, b, c = num(3), num(3), num(4)
        return kind, rng.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"({a}) {b} {c}"])

    def other() -> str:
        return rng.choice([num(rng.randint(1, 6)), num(16), f"{num(4)}-{num(2)}-{num(2)}", f"{num(2)}:{num(2)}", f"{num(1)}.{num(2)}", f"{num(3)} {num(3)}", f"at {word()}", f"{word()} at {word()} and {word()}", f"look at the {word()}. {word().title()}", f"{num(4)}/{num(4)}", f"{num(2)}-{num(5)}", f"{num(4)} {num(4)} {num(4)} {num(4)}", f"v{num(1)}.{num(1)}.{num(2)}", f"{rng.choice(['sha', 'commit', 'id', 'etag', word()])}{rng.choice([' ', ': ', '='])}{mixed()}"])

    out = []
    for _ in range(n):
        text, spans = word(), []
        for _ in range(rng.randint(1, 4)):
            text += " " + " ".join(word() for _ in range(rng.randint(0, 4)))
            if rng.random() < 0.5:
                kind, e = entity()
                secret = kind == "secret"
                if secret or rng.random() < 0.4:
                    text += f" {rng.choice(sorted(CUES[kind]))}"
                text += rng.choice([' = "', '="', "=", ": ", " "]) if secret else " "
                quoted = text.endswith('"')
                spans.append((kind, len(text), len(text) + len(e)))
                text += e + '"' * quoted
            else:
                text += f" {other()}"
        out.append((text + f" {word()}", spans))
    return out


def fit(data: list[tuple[str, list[tuple[str, int, int]]]], epochs: int = 15, rate: float = 0.3, decay: float = 1e-4) -> SemiMarkov:
    """Stochastic gradient ascent on the likelihood, by the forward-backward sums over segmentations."""
    prepared = []
    for text, gold in data:
        spans = [m.span() for m in TOKEN.finditer(text)]
        words = [text[a:b] for a, b in spans]
        cand = [(a, b, span_features(k, words, a, b, text[spans[a][0] : spans[b - 1][1]]), (k, spans[a][0], spans[b - 1][1]) in gold) for a, b, k in candidates(words, spans, text)]
        prepared.append((len(words), sorted(cand, key=lambda c: c[1])))
    w: dict[str, float] = {}
    for epoch in range(epochs):
        step = rate / (1 + epoch / 3)
        for n, cand in prepared:
            score = [sum(w.get(f, 0.0) for f in c[2]) for c in cand]
            ahead, behind = [0.0] * (n + 1), [0.0] * (n + 1)
            i = 0
            for b in range(1, n + 1):
                ahead[b] = ahead[b - 1]
                while i < len(cand) and cand[i][1] == b:
                    ahead[b] = _logadd(ahead[b], ahead[cand[i][0]] + score[i])
                    i += 1
            by_start: dict[int, list[int]] = {}
            for i, c in enumerate(cand):
                by_start.setdefault(c[0], []).append(i)
            for a in range(n - 1, -1, -1):
                behind[a] = behind[a + 1]
                for i in by_start.get(a, ()):
                    behind[a] = _logadd(behind[a], behind[cand[i][1]] + score[i])
            for (a, b, features, gold), s in zip(cand, score, strict=True):
                g = gold - exp(min(0.0, ahead[a] + s + behind[b] - ahead[n]))
                if abs(g) > 1e-4:
                    for f in features:
                        w[f] = w.get(f, 0.0) * (1 - step * decay) + step * g
    return SemiMarkov(w)


@lru_cache(1)
def model() -> SemiMarkov:
    return fit(examples(700, 17))


def all_spans(text: str, field: SemiMarkov) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(base spans, all spans): base ones, and the field's that overlap none of them; by kind, then start."""
    base = base_spans(text)
    taken: list[list[int]] = []
    for a, b in sorted((a, b) for _, a, b in base):
        if taken and a < taken[-1][1]:
            taken[-1][1] = max(b, taken[-1][1])
        else:
            taken.append([a, b])
    starts, more = [a for a, _ in taken], []
    for kind, a, b in field.decode(text):
        before = bisect_left(starts, b)  # of the disjoint stretches that begin before b, the last ends last
        if not before or taken[before - 1][1] <= a:
            more.append((kind, a, b))
    order = {k: i for i, k in enumerate(FIELD_KINDS)}
    return base, sorted(base + more, key=lambda s: (order[s[0]], s[1]))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_secret, n_spans) for every row of `docs`.

    Counts and digest are of the base spans (kind:start:end, code points, end
    exclusive, by kind in the order of KINDS, then start, comma-joined); spans
    also holds the field's, secrets last; n_secret and n_spans count there. Null counts as empty; texts are scanned whole;
    repeated rows and null ids are kept; other columns are ignored; an empty
    table gives no rows.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    field = model()

    def run(batches):
        for b in slices(batches):
            rows = []
            for text in b.column("text").to_pylist():
                base, spans = all_spans(text or "", field)
                name = lambda s: ",".join(f"{k}:{x}:{y}" for k, x, y in s)
                rows.append((*[sum(s[0] == k for s in base) for k in KINDS], hashlib.sha256(name(base).encode()).hexdigest(), name(spans), sum(s[0] == "secret" for s in spans), len(spans)))
            cols = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *[pa.array(c, pa.int64()) for c in cols[:4]], *[pa.array(c) for c in cols[4:6]], *[pa.array(c, pa.int64()) for c in cols[6:]]], ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_secret", "n_spans"])

    return arrow_map(docs, run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_secret long, n_spans long")
