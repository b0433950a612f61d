"""Personal data by a semi-Markov conditional random field over candidate segments.

*Base.* Four patterns (email, ip, card, phone) with their checks; these spans always stay.

*Candidates.* Wider patterns propose whole segments of up to ``LONGEST`` code points: spelled-out or defanged addresses,
numbers with other separators, numbers without a plus. A segment may be proposed with several boundaries and kinds.

*Model.* A segment scores by features of the whole span (digits, checks, separators, words to its left, limits on either side)
for its kind, and by the kind of the entity before it if that is near. A labelling of a stretch of text is a set of
segments that do not overlap; dynamic programming over their ends gives the best set and the sum over all sets. The weights
are trained on at most ``max_windows`` stretches of the corpus (bounded and documented; those with the smallest hash) in which
base spans are the truth and other candidates are not, and on the same stretches with the separators of base spans rewritten.

Added spans are those of the best labelling that no base span touches, whose odds against every labelling without them
reach ``ODDS``. Positions are code points, ends exclusive.

Defined results: null and empty texts have no spans; without any base span to learn from nothing is added; repeated rows
each get their result; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

KINDS = ("email", "ip", "card", "phone")
# The base patterns.
BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
LONGEST = 64
NEAR = 24
ODDS = math.log(9.0)
MAX_WINDOWS = 1500
_DOT = r"(?:\.|\x20?[\[(]\.[\])]\x20?|\x20?[\[(]dot[\])]\x20?|\x20dot\x20)"
_AT = r"(?:@|\x20?[\[({](?:at|@)[\])}]\x20?|\x20at\x20)"
WIDER = {
    "email": re.compile(rf"[A-Za-z0-9._%+-]{{1,24}}{_AT}[A-Za-z0-9-]{{1,24}}(?:{_DOT}[A-Za-z0-9-]{{2,16}}){{1,3}}", re.I),
    "ip": re.compile(rf"(?<![0-9.])[0-9]{{1,3}}(?:{_DOT}[0-9]{{1,3}}){{3}}(?![0-9])", re.I),
    "card": re.compile(r"(?<![0-9])[0-9](?:[\x20._/-]{0,2}[0-9]){13,18}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9+])(?:\+|00)?\(?[0-9]{1,4}\)?(?:[\x20./-]{1,2}\(?[0-9]{2,5}\)?){1,5}(?![0-9])"),
}
_DIGITS = re.compile("[0-9]")
_TRIGGER = re.compile(r"[0-9@]|[\[({ ](?:at|AT)[\])} ]")
_SEEN = re.compile(r"[0-9]{2}|@|[\[({ ](?:at|AT)[\])} ][^\n]{1,40}?(?:\.|dot|DOT)")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def passes(kind: str, s: str) -> bool:
    if kind == "email":
        return True
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in s.split("."))
    digits = "".join(_DIGITS.findall(s))
    return 14 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 10 <= len(digits) <= 15


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end), by start, then kind as listed."""
    out = []
    numbers = _DIGITS.search(text) is not None
    for at, kind in enumerate(KINDS):
        if (kind != "email" and not numbers) or (NEEDS[kind] and NEEDS[kind] not in text):
            continue
        for m in BASE[kind].finditer(text):
            if passes(kind, m[0]):
                out.append((m.start(), at, m.end()))
    return [(a, KINDS[k], b) for a, k, b in sorted(out)]


def candidates(text: str, base: list[tuple[int, str, int]]) -> list[tuple[int, int, str]]:
    """(start, end, kind) of proposed segments, base spans among them."""
    found = {(a, b, k) for a, k, b in base if b - a <= 2 * LONGEST}
    for kind, pattern in WIDER.items():
        for m in pattern.finditer(text):
            a, b = m.span()
            if b - a > LONGEST:
                continue
            found.add((a, b, kind))
            for cut in (text.find(" ", a, b), text.rfind(" ", a, b)):
                # The same segment without its first or its last word.
                if cut > a and kind in ("card", "phone"):
                    found.update({(cut + 1, b, kind), (a, cut, kind)})
    return sorted(found)


def features(text: str, a: int, b: int, kind: str) -> list[str]:
    s = text[a:b]
    digits = "".join(_DIGITS.findall(s))
    left, right = text[max(0, a - 16):a], text[b:b + 2]
    word = re.search(r"([A-Za-z]+)[^A-Za-z0-9]*$", left)
    tight = "".join(sorted(set(re.sub(r"[A-Za-z0-9]", "", s))))
    out = ["bias", f"digits={min(len(digits), 20) if kind in ('card', 'phone') else min(len(digits), 1)}", f"shape={kind in ('card', 'phone') and len(tight) > 3}"]
    out.append(f"left={'none' if not left else 'blank' if left[-1].isspace() else 'word' if left[-1].isalnum() else 'sign'}")
    out.append(f"right={'none' if not right else 'blank' if right[0].isspace() else 'word' if right[0].isalnum() else 'sign'}")
    if word and word[1].lower() in ("phone", "tel", "call", "email", "mail", "card", "ip", "address", "fax", "mobile"):
        out.append(f"cue={word[1].lower()}")
    if kind == "email":
        bare = re.sub(_DOT, ".", re.sub(_AT, "@", s, flags=re.I), flags=re.I)
        out += [f"valid={BASE['email'].fullmatch(bare) is not None}", f"mark={'@' in s or '[' in s or '(' in s or '{' in s}"]
        out.append(f"host={bool(re.search(r'[.](com|org|net|edu|info|io|example|de|fr|es)$', bare, re.I))}")
    elif kind == "ip":
        parts = re.findall("[0-9]+", s)
        out.append(f"valid={len(parts) == 4 and all(int(p) <= 255 for p in parts)}")
    elif kind == "card":
        out += [f"luhn={luhn(digits)}", f"length={14 <= len(digits) <= 19}", f"both={luhn(digits) and 14 <= len(digits) <= 19}"]
    else:
        out += [f"plus={s.startswith('+') or s.startswith('00')}", f"length={10 <= len(digits) <= 15}", f"round={'(' in s and ')' in s}"]
    return [f"{kind}:{f}" for f in out]


class Segments:
    """Candidates of one stretch as a lattice: forward and backward sums, and the best labelling."""

    def __init__(self, text: str, spans: list[tuple[int, int, str]]):
        # By end, so that all that may come before a segment stands before it.
        self.spans = sorted(spans, key=lambda x: (x[1], x[0], x[2]))
        self.features = [features(text, a, b, k) for a, b, k in self.spans]
        self.before = []
        for i, (a, _, k) in enumerate(self.spans):
            ok = [j for j in range(i) if self.spans[j][1] <= a]
            self.before.append([(j, f"{self.spans[j][2]}>{k}" if a - self.spans[j][1] <= NEAR else None) for j in ok])

    def scores(self, w: dict[str, float]) -> list[float]:
        return [sum(w.get(f, 0.0) for f in fs) for fs in self.features]

    def forward(self, w: dict[str, float], s: list[float], out: int | None = None) -> tuple[list[float], float]:
        """Log sums of labellings that end in each segment, and of all; ``out`` leaves one segment out."""
        alpha: list[float] = []
        for i, sc in enumerate(s):
            if i == out:
                alpha.append(-math.inf)
                continue
            terms = [0.0] + [alpha[j] + w.get(t, 0.0) if t else alpha[j] for j, t in self.before[i] if alpha[j] > -math.inf]
            alpha.append(sc + _logsum(terms))
        return alpha, _logsum([0.0, *[a for a in alpha if a > -math.inf]])

    def gradient(self, w: dict[str, float], truth: set[tuple[int, int, str]], grad: dict[str, float]) -> None:
        """Adds the features of the truth minus those expected."""
        s = self.scores(w)
        alpha, z = self.forward(w, s)
        beta = [0.0] * len(s)
        for i in range(len(s) - 1, -1, -1):
            terms = [0.0]
            for m in range(i + 1, len(s)):
                for j, t in self.before[m]:
                    if j == i:
                        terms.append(s[m] + beta[m] + (w.get(t, 0.0) if t else 0.0))
            beta[i] = _logsum(terms)
        for i, fs in enumerate(self.features):
            d = (1.0 if self.spans[i] in truth else 0.0) - math.exp(min(0.0, alpha[i] + beta[i] - z))
            for f in fs:
                grad[f] = grad.get(f, 0.0) + d
            for j, t in self.before[i]:
                if t:
                    e = math.exp(min(0.0, alpha[j] + w.get(t, 0.0) + s[i] + beta[i] - z))
                    between = any(self.spans[x] in truth for x in range(len(s)) if self.spans[j][1] <= self.spans[x][0] and self.spans[x][1] <= self.spans[i][0])
                    grad[t] = grad.get(t, 0.0) + (1.0 if self.spans[i] in truth and self.spans[j] in truth and not between else 0.0) - e

    def best(self, w: dict[str, float]) -> list[tuple[tuple[int, int, str], float]]:
        """Segments of the best labelling, each with its log odds against all labellings without it."""
        s = self.scores(w)
        top, back = [], []
        for i, sc in enumerate(s):
            choice = max([(0.0, -1)] + [(top[j] + (w.get(t, 0.0) if t else 0.0), j) for j, t in self.before[i]])
            top.append(sc + choice[0])
            back.append(choice[1])
        if not top or max(top) <= 0:
            return []
        i, z, out = max(range(len(top)), key=top.__getitem__), self.forward(w, s)[1], []
        while i >= 0:
            without = self.forward(w, s, i)[1]
            p = -math.expm1(min(-1e-12, without - z))
            out.append((self.spans[i], math.log(p) - math.log1p(-p) if p < 1 else math.inf))
            i = back[i]
        return out[::-1]


def _logsum(x: list[float]) -> float:
    m = max(x)
    return m + math.log(sum(math.exp(v - m) for v in x))


def stretches(spans: list[tuple[int, int, str]]) -> Iterator[list[tuple[int, int, str]]]:
    """Candidates that may touch or follow one another closely; at most 40 at a time."""
    held: list[tuple[int, int, str]] = []
    end = 0
    for s in sorted(spans):
        if held and (s[0] > end + NEAR or (len(held) >= 40 and s[0] >= end)):
            yield held
            held, end = [], 0
        held.append(s)
        end = max(end, s[1])
    if held:
        yield held


def learn(windows: list[str], rounds: int = 40) -> dict[str, float]:
    """Weights from stretches of text in which base spans are the truth, plain and rewritten."""
    lattices = []
    for text in windows:
        base = base_spans(text)
        for variant in (0, 1, 2):
            if variant and not base:
                continue
            t, truth = (text, {(a, b, k) for a, k, b in base}) if not variant else rewritten(text, base, variant)
            for part in stretches(candidates(t, [(a, k, b) for a, b, k in truth])):
                if len(part) <= 60:
                    lattices.append((Segments(t, part), truth))
    w: dict[str, float] = {}
    square: dict[str, float] = {}
    if not any(truth for _, truth in lattices):
        return w
    for _ in range(rounds):
        for a in range(0, len(lattices), 64):
            grad: dict[str, float] = {}
            for lattice, truth in lattices[a:a + 64]:
                lattice.gradient(w, truth, grad)
            for f, g in grad.items():
                g = g / 64 - 1e-3 * w.get(f, 0.0)
                square[f] = square.get(f, 0.0) + g * g
                w[f] = w.get(f, 0.0) + 0.3 * g / (math.sqrt(square[f]) + 1e-6)
    return w


def rewritten(text: str, base: list[tuple[int, str, int]], variant: int) -> tuple[str, set[tuple[int, int, str]]]:
    """The stretch with other separators in its base spans, and where they then stand."""
    change = {
        "email": [lambda s: s.replace("@", " [at] ").replace(".", "[.]"), lambda s: s.split("@")[0] + " at " + s.split("@")[1].replace(".", " dot ")],
        "ip": [lambda s: s.replace(".", "[.]"), lambda s: s.replace(".", "[dot]")],
        "card": [lambda s: re.sub("[^0-9]", "", s)[:4] + "." + re.sub("[^0-9]", "", s)[4:8] + "." + re.sub("[^0-9]", "", s)[8:12] + "." + re.sub("[^0-9]", "", s)[12:],
                 lambda s: "/".join(re.findall("[0-9]{1,4}", re.sub("[^0-9]", "", s)))],
        "phone": [lambda s: "00" + s[1:], lambda s: s[s.find("("):] if "(" in s else "00" + s[1:]],
    }
    out, at, truth = [], 0, set()
    for a, kind, b in base:
        if a < at:
            continue
        out.append(text[at:a])
        start = sum(map(len, out))
        out.append(change[kind][variant - 1](text[a:b]))
        truth.add((start, start + len(out[-1]), kind))
        at = b
    return "".join([*out, text[at:]]), truth


def added(text: str, base: list[tuple[int, str, int]], w: dict[str, float]) -> list[tuple[int, str, int]]:
    if not w or not _SEEN.search(text):
        return []
    limits = sorted((a, b) for a, _, b in base)
    out = []
    for part in stretches(candidates(text, base)):
        if all(any(x < b and a < y for x, y in limits) for a, b, _ in part):
            continue
        for (a, b, k), odds in Segments(text, part).best(w):
            if odds >= ODDS and not any(x < b and a < y for x, y in limits):
                out.append((a, k, b))
    return out


def joined(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, k, b in sorted(spans, key=lambda x: (x[0], KINDS.index(x[1]), x[2])))


def train(docs: DataFrame, max_windows: int = MAX_WINDOWS) -> dict[str, float]:
    """Weights learned from a bounded number of stretches round candidates; the stretches come to the driver."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t in batch.column(0):
                text = t.as_py() or ""
                if not _TRIGGER.search(text):
                    continue
                base = base_spans(text)
                for part in stretches(candidates(text, base)):
                    a, b = part[0][0], max(x[1] for x in part)
                    if b - a <= 400:
                        out.append(text[max(0, a - 24):b + 24])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["window"])

    windows = docs.select("text").mapInArrow(cut, "window string").distinct().orderBy(F.xxhash64("window"), "window").limit(max_windows).collect()
    return learn([r.window for r in windows])


def find(docs: DataFrame, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """doc_id, base and spans (both joined kind:start:end), n_email, n_ip, n_card, n_phone (of the base spans)."""
    w = train(docs, max_windows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base_, all_, counts = [], [], [[] for _ in KINDS]
            for t in batch.column(1):
                text = t.as_py() or ""
                base = base_spans(text)
                base_.append(joined(base))
                all_.append(joined(base + added(text, base, w)))
                for i, k in enumerate(KINDS):
                    counts[i].append(sum(x[1] == k for x in base))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in counts], pa.array(base_, pa.string()), pa.array(all_, pa.string())],
                ["doc_id", *[f"n_{k}" for k in KINDS], "base", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base string, spans string")
