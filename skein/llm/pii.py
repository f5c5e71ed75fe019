"""Personal data: fixed patterns, and a semi-Markov conditional random field.

The patterns (:func:`base_spans`) find e-mail addresses, IP addresses, card and
phone numbers in plain notation. The field adds what is written differently,
such as phone numbers without a country code or "name [at] host [dot] com".

The field labels segments, not tokens. A segment is a run of up to
``MAX_TOKENS`` tokens with one of the four kinds, or one token that is nothing.
Features are taken from whole segments (their digits, groups, check sum,
separators, and the words beside them), so a segment's score is one sum, and
dynamic programming over the ends of segments (:func:`Field.decode`) chooses
boundaries and kinds jointly. Training maximises the conditional likelihood by
gradient steps with the forward and backward sums of the same recursion, on
generated windows (:func:`examples`: templates under a fixed seed, positive and
negative); no row of the input takes part.

Only stretches around digits, @ and bracketed "at" can hold a segment: any other
token is nothing whatever the weights, so a text is decoded there and nowhere
else, and the result is that of decoding the whole text.

Spans are (start, kind, end) in code points, end exclusive. Base spans always
stay; added spans never overlap them. Defined cases: null and empty texts have
no spans; equal ids are handled one by one; very long texts are handled whole; of added spans that tie the
leftmost stays; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.textarrays import slices
from skein.llm.workers import map_batches, tidy

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
MAX_TOKENS = 24

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
# a run of digits that fails from its beginning fails from within too
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """The fixed patterns: leftmost, non-overlapping within a kind, failing matches dropped."""
    out = []
    at, free = text.find("@"), 0
    while at >= 0:
        begin = at
        # back over the local part, never into the match before
        while begin > free and not _NOT_LOCAL.match(text, begin - 1):
            begin -= 1
        m = _DOMAIN.match(text, at + 1) if begin < at else None
        if m:
            out.append((begin, EMAIL, m.end()))
            free = m.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", max(at + 1, free))
    for m in _CARD.finditer(text):
        d = _digits(m.group())
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), CARD, m.end()))
    if "." in text:
        for m in _IP.finditer(text):
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in m.group().split("."))):
                out.append((m.start(), IP, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_digits(m.group())) <= 15:
                out.append((m.start(), PHONE, m.end()))
    return sorted(out)


# -- the field ------------------------------------------------------------------

#: What a stretch that can hold a segment has in each of its words.
_CUE = re.compile(r"[0-9@]|[\[({] ?(?:at|dot) ?[\])}]", re.I)
_NEXT = re.compile(r" ?\S*")
_REST = re.compile(r"\S*")
_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|[ \t]+|.", re.S)
_AT = re.compile(r"\s?[\[({]\s?at\s?[\])}]\s?", re.I)
_DOT = re.compile(r"\s?[\[({]\s?dot\s?[\])}]\s?", re.I)
_PLAIN_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}\Z")
_ONLY = {IP: re.compile(r"[0-9]+(?:\.[0-9]+){3}\Z"), CARD: re.compile(r"[0-9][0-9 -]*[0-9]\Z"), PHONE: re.compile(r"[+(]?[0-9][0-9 ().-]*[0-9]\Z")}
_GROUPS = re.compile(r"[0-9]+")
#: Words beside a number or address that name it.
CONTEXT = {
    "email": EMAIL, "mail": EMAIL, "contact": EMAIL, "ip": IP, "host": IP, "server": IP, "card": CARD, "visa": CARD,
    "credit": CARD, "phone": PHONE, "tel": PHONE, "call": PHONE, "fax": PHONE, "mobile": PHONE,
}


def _possible(s: str) -> list[int]:
    """Kinds that a segment may have at all."""
    out = []
    c = s[0]
    if c.isalnum() and s[-1].isalpha() and ("@" in s or "[" in s or "(" in s or "{" in s):
        plain = _DOT.sub(".", _AT.sub("@", s))
        if plain.count("@") == 1 and _PLAIN_EMAIL.match(plain):
            out.append(EMAIL)
    if c in "+(0123456789" and s[-1] in "0123456789":
        n = sum(1 for x in s if "0" <= x <= "9")
        if 4 <= n <= 12 and _ONLY[IP].match(s):
            out.append(IP)
        if 12 <= n <= 19 and _ONLY[CARD].match(s):
            out.append(CARD)
        if 7 <= n <= 15 and _ONLY[PHONE].match(s):
            out.append(PHONE)
    return out


def _features(text: str, a: int, b: int, kind: int) -> list[str]:
    """What a whole segment, with its neighbours, says about its kind."""
    s = text[a:b]
    before, after = text[a - 1 : a], text[b : b + 1]
    out = ["bias"]
    if before and (before.isalnum() or before in "#$%+-./:=_@"):
        out.append("left:" + ("word" if before.isalnum() else before))
    if after and (after.isalnum() or after in "%/_@-:"):
        out.append("right:" + ("word" if after.isalnum() else after))
    if after == "." and text[b + 1 : b + 2].isalnum():
        out.append("right:.x")
    if kind != EMAIL and after == " " and text[b + 1 : b + 2].isdigit() or before == " " and text[a - 2 : a - 1].isdigit():
        out.append("beside:number")
    word = re.findall(r"[^\W\d_]+", text[max(0, a - 24) : a])[-2:]
    named = {CONTEXT[w.lower()] for w in word if w.lower() in CONTEXT}
    out.append("named" if kind in named else "named:other" if named else "unnamed")
    if kind == EMAIL:
        out.append("plain" if "@" in s else "bracketed")
        return out
    groups = [len(g) for g in _GROUPS.findall(s)]
    n = sum(groups)
    out.append(f"digits:{n}")
    if kind == IP:
        out.append("parts:ok" if all(int(p) < 256 for p in s.split(".")) else "parts:high")
        return out
    out.append("groups:" + ("-".join(map(str, groups)) if len(groups) < 6 else "many"))
    out.append("separators:" + "".join(sorted(set(re.sub("[0-9]", "", s)))))
    if kind == CARD:
        out.append("check" if luhn(_digits(s)) else "nocheck")
    else:
        out.append("lead:" + (s[0] if s[0] in "+(" else "0" if s[0] == "0" else "digit"))
        if re.match(r"(?:19|20)[0-9]{2}[-. ][01]?[0-9][-. ]", s):
            out.append("date")
    return out


class Field:
    """Weights by (kind, feature), and the recursions over segments."""

    def __init__(self):
        self.weights: dict[tuple[int, str], float] = {}

    def segments(self, text: str) -> tuple[list[int], dict[int, list[tuple[int, int, list[str]]]]]:
        """Token bounds of a window, and by end the possible segments (begin, kind, features)."""
        cuts = [0, *(m.end() for m in _TOKEN.finditer(text))]
        by_end: dict[int, list] = {}
        for i in range(len(cuts) - 1):
            c = text[cuts[i]]
            if not (c.isalnum() or c in "+("):
                continue
            for j in range(i + 1, min(i + MAX_TOKENS, len(cuts) - 1) + 1):
                if text[cuts[j] - 1].isalnum():
                    for kind in _possible(text[cuts[i] : cuts[j]]):
                        by_end.setdefault(j, []).append((i, kind, _features(text, cuts[i], cuts[j], kind)))
        return cuts, by_end

    def _score(self, kind: int, features: list[str]) -> float:
        w = self.weights
        return sum(w.get((kind, f), 0.0) for f in features)

    def decode(self, text: str) -> list[tuple[int, int, int]]:
        """The best segmentation of a window: its segments that are something."""
        cuts, by_end = self.segments(text)
        best, back = [0.0], [None]
        for j in range(1, len(cuts)):
            s, b = best[j - 1], None
            for i, kind, features in by_end.get(j, ()):
                x = best[i] + self._score(kind, features)
                if x > s:
                    s, b = x, (i, kind)
            best.append(s), back.append(b)
        out, j = [], len(cuts) - 1
        while j > 0:
            if back[j] is None:
                j -= 1
            else:
                i, kind = back[j]
                out.append((cuts[i], kind, cuts[j]))
                j = i
        return out[::-1]

    def step(self, text: str, truth: set[tuple[int, int, int]], rate: float, decay: float) -> None:
        """One gradient step on the conditional log-likelihood of a window."""
        cuts, by_end = self.segments(text)
        n = len(cuts)
        forward = [0.0] + [-math.inf] * (n - 1)
        scored = {j: [(i, k, f, self._score(k, f)) for i, k, f in x] for j, x in by_end.items()}
        for j in range(1, n):
            forward[j] = _logsum([forward[j - 1], *(forward[i] + s for i, _, _, s in scored.get(j, ()))])
        backward = [-math.inf] * (n - 1) + [0.0]
        by_begin: dict[int, list] = {}
        for j, x in scored.items():
            for i, _, _, s in x:
                by_begin.setdefault(i, []).append((j, s))
        for i in range(n - 2, -1, -1):
            backward[i] = _logsum([backward[i + 1], *(s + backward[j] for j, s in by_begin.get(i, ()))])
        for j, x in scored.items():
            for i, kind, features, s in x:
                expected = math.exp(min(0.0, forward[i] + s + backward[j] - forward[-1]))
                g = ((cuts[i], kind, cuts[j]) in truth) - expected
                for f in features:
                    old = self.weights.get((kind, f), 0.0)
                    self.weights[kind, f] = old + rate * (g - decay * old)


def _logsum(x: list[float]) -> float:
    m = max(x)
    return m if m == -math.inf else m + math.log(sum(math.exp(v - m) for v in x))


def examples(seed: int = 7, n: int = 1_500) -> list[tuple[str, set[tuple[int, int, int]]]]:
    """Generated windows with their true segments."""
    r = random.Random(seed)
    number = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    letters = lambda a, b: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(a, b)))

    def card(valid: bool) -> str:
        while True:
            d = r.choice("3456") + number(r.choice([14, 15, 15, 15]))
            if luhn(d) == valid:
                sep = r.choice(["", "", " ", "-"])
                return sep.join(d[k : k + 4] for k in range(0, len(d), 4))

    def phone() -> str:
        a, b, c = str(r.randint(2, 9)) + number(2), number(3), number(4)
        return r.choice([f"+1 ({a}) {b}-{c}", f"+{r.randint(20, 99)} {number(3)} {number(7)}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"+1 {a} {b} {c}", f"0{number(2)} {number(4)} {number(4)}"])

    def email() -> str:
        name, host, top = letters(3, 7) + r.choice(["", "." + number(2), "." + letters(3, 6)]), letters(3, 8), r.choice(["com", "org", "net", "de", "example.com"])
        return r.choice([f"{name}@{host}.{top}", f"{name} [at] {host}.{top}", f"{name}(at){host}.{top}", f"{name} [at] {host} [dot] {top}", f"{name} (at) {host} (dot) {top}"])

    def ip() -> str:
        return ".".join(str(r.randint(0, 255)) for _ in range(4))

    def nothing() -> str:
        return r.choice([
            lambda: f"20{number(2)}-0{r.randint(1, 9)}-{r.randint(10, 28)}", lambda: f"{r.randint(1, 28)}.{r.randint(1, 12)}.20{number(2)}",
            lambda: f"{r.randint(10, 23)}:{r.randint(10, 59)}", lambda: f"{r.randint(1, 9)}.{number(1)}.{number(1)}", lambda: f"{number(2)}.{number(2)}",
            lambda: f"${number(3)}.{number(2)}", lambda: f"#{number(6)}", lambda: f"{r.randint(1, 9)},{number(3)},{number(3)}", lambda: card(False),
            lambda: f"password={''.join(r.choice('0123456789abcdef') for _ in range(18))}", lambda: f"{r.randint(256, 999)}.{number(2)}.{number(2)}.{number(3)}",
            lambda: f"AKIA{number(4)}{letters(4, 8).upper()}{number(6)}", lambda: number(r.randint(1, 12)), lambda: f"{number(3)}-{number(2)}", lambda: f"v{ip()}",
            lambda: f"{number(3)} {number(3)} {number(4)} {number(2)}", lambda: f"978-{number(1)}-{number(4)}-{number(4)}-{number(1)}", lambda: f"@{letters(4, 8)}",
            lambda: f"{number(4)} {number(4)}", lambda: f"{ip()}.{number(2)}", lambda: f"{number(10)}", lambda: f"{number(3)}.{number(3)}.{number(4)}.{number(3)}",
        ])()

    makers = [(email, EMAIL), (ip, IP), (lambda: card(True), CARD), (phone, PHONE)]
    out = []
    for _ in range(n):
        text, truth = letters(2, 8) + " ", set()
        for _ in range(r.choice([1, 1, 1, 2])):
            if r.random() < 0.45:
                make, kind = r.choice(makers)
                if r.random() < 0.3:
                    text += r.choice([w for w, k in CONTEXT.items() if k == kind]) + r.choice([": ", " "])
                s = make()
                truth.add((len(text), kind, len(text) + len(s)))
            else:
                s = nothing()
            text += s + r.choice([" ", ". ", ", "]) + letters(2, 8) + " "
        out.append((text, truth))
    return out


@lru_cache(maxsize=2)
def trained(seed: int = 7, epochs: int = 6) -> Field:
    """The field after gradient steps over the generated windows; the same on every machine."""
    field, rows, r = Field(), examples(seed), random.Random(seed)
    for epoch in range(epochs):
        r.shuffle(rows)
        for text, truth in rows:
            field.step(text, truth, 0.5 / (1 + epoch), 1e-4)
    return field


def _windows(text: str) -> Iterator[tuple[int, str]]:
    """Stretches that can hold a segment: neighbouring words with a cue, with a few words before for context.

    After a bracketed form the next word belongs to the stretch. Every character is looked at a fixed number of times.
    """
    m, at = _CUE.search(text), 0
    while m:
        a = m.start()
        while a > at and not text[a - 1].isspace():
            a -= 1
        begin, end = a, m.end()
        while True:
            last = m
            end = _REST.match(text, m.end()).end()
            if last.group()[-1] in "])}" and end == m.end():
                end = _NEXT.match(text, end).end()
            m = _CUE.search(text, end)
            # goes on if only one space stands between this word and the next cue's word
            if not m or text[end : end + 1] != " " or not _REST.fullmatch(text, end + 1, m.start()):
                break
        context = max(at, text.rfind("\n", 0, begin) + 1, begin - 48)
        at = end
        yield context, text[context : min(len(text), end + 2)]


def all_spans(text: str, field: Field, memo: dict | None = None) -> tuple[list, list]:
    """Base spans, and what the field adds to them."""
    base = base_spans(text)
    added = []
    for a, window in _windows(text):
        found = None if memo is None else memo.get(window)
        if found is None:
            found = field.decode(window)
            if memo is not None and len(window) <= 200:
                if len(memo) > 100_000:
                    memo.clear()
                memo[window] = found
        added += [(a + s, kind, a + e) for s, kind, e in found]
    taken = sorted((s, e) for s, _, e in base)
    begins = [s for s, _ in taken]
    out, last = [], -1
    longest = list(np.maximum.accumulate([e for _, e in taken])) if taken else []
    for s, kind, e in sorted(added):
        k = bisect.bisect_left(begins, e) - 1  # base spans that begin before its end
        if s >= last and not (k >= 0 and longest[k] > s):
            out.append((s, kind, e))
            last = e
    return base, out


def spell(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long, n_spans long"


def found(docs: DataFrame) -> DataFrame:
    """One row for every row of ``docs``: counts of base spans, their digest, and all spans; no shuffle."""
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    shared = docs.sparkSession.sparkContext.broadcast(trained())

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict = {}
        for batch in batches:
            for part in slices(batch):
                rows = []
                for d, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    base, added = all_spans(t or "", shared.value, memo)
                    kinds = [k for _, k, _ in base]
                    rows.append((d, *(kinds.count(k) for k in range(4)), hashlib.sha256(spell(base).encode()).hexdigest(), spell(base + added), len(added), len(base) + len(added)))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if n in ("base_sha256", "spans") else pa.int64()) for c, n in zip(zip(*rows), names)], names=names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).transform(map_batches, run, SCHEMA)


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; other columns pass through."""
    shared, place, schema = docs.sparkSession.sparkContext.broadcast(trained()), docs.columns.index("text"), docs.schema

    def clean(text: str | None) -> str | None:
        if not text:
            return text
        base, added = all_spans(text, shared.value)
        out, at = [], 0
        for s, k, e in sorted(base + added):
            if s >= at:
                out += [text[at:s], f"<{KINDS[k]}>"]
            at = max(at, e)
        return "".join(out) + text[at:]

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([clean(t) for t in batch.column(place).to_pylist()], batch.schema.field(place).type)
            yield batch.set_column(place, batch.schema.field(place), texts)

    return docs.transform(map_batches, run, schema)
