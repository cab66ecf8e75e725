"""Personal data: overlapping candidates, boosted trees, calibrated thresholds.

High-recall generators propose spans of four kinds, looser than the base
patterns (national phone numbers, other separators, spelt-out addresses).
Spans of the base patterns always stand. Every other candidate is scored by
gradient-boosted trees over format and context features.

What the trees learn from is certain on both sides; most candidates are neither and stay unlabelled, as a number without
its plus may well be a phone number:

* right: base spans with the mark that the base pattern needs taken away (the plus of a phone number, and in a second
  reading its country code; the @ and dots of an address count like spelt-out ones);
* wrong: candidates that cannot be personal data by a rule (``excluded``: a failed Luhn sum, an address part over 255, the
  shape of a date, price or version, a span of another kind), and for every base span a
  ``spoiled`` one in its place, whose digits or ending break such a rule.

Candidates of equal texts count once. The trees learn from the texts with odd hashes, of which a threshold on a
hash of the candidate leaves a bounded number per kind and side. The thresholds come from all texts with
even hashes, which the trees never saw: Spark counts right and wrong ones per kind and
score bin, and a kind takes the lowest bin at which the exact binomial
lower bound of the precision reaches ``PRECISION``; a kind with too few base spans
in the whole table keeps those only. The model also tells the share of the unseen masked base spans that its thresholds find (``recall``).

Defined results: null and empty texts have no spans; repeated rows get equal
spans; an empty table gives an empty result; ``redact`` leaves a null text
null and returns the other columns as they came.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindle.llm.common import arrow_rows, filled, scratch_table

KINDS = ("email", "ip", "card", "phone")
SAMPLE_CANDIDATES = 50_000  # documented bound of the sample from which the trees learn, shared evenly by kinds and sides
LEAST_EXAMPLES = 20
PRECISION, CONFIDENCE = 0.95, 0.95
TREES, DEPTH, RATE, BINS = 40, 3, 0.2, 32
#: Lower edges of the score bins, evenly spaced in log odds; scores under 0.5 are in none of them.
EDGES = 1 / (1 + np.exp(-np.arange(1024) / 64))

Span = tuple[int, int, str]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_AT = re.compile(r" ?[(\[]at[)\]] ?| at ", re.I)
_DOT = re.compile(r" ?[(\[]dot[)\]] ?| dot ", re.I)
_HAS = re.compile(r"[0-9@]|\bat\b", re.I)


def luhn(digits: str) -> bool:
    d = np.frombuffer(digits.encode(), np.uint8)[::-1].astype(np.int64) - 48
    twice = d[1::2] * 2
    return int(d[::2].sum() + (twice - 9 * (twice > 9)).sum()) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Walks from each @ both ways, so that long words without one cost nothing."""
    done, at = 0, text.find("@")
    while at >= 0:
        lo = at
        while lo > done and text[lo - 1] in _LOCAL:
            lo -= 1
        right = _DOMAIN.match(text, at + 1) if lo < at else None
        if right:
            yield lo, right.end()
            done = right.end()
        at = text.find("@", max(at + 1, done))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base_spans(text: str) -> list[Span]:
    """Spans of the base patterns, by start and then kind."""
    out = [(lo, hi, "email") for lo, hi in _emails(text)]
    out += [(*m.span(), "ip") for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((*m.span(), "card"))
    if "+" in text:
        out += [(*m.span(), "phone") for m in _PHONE.finditer(text) if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


_LOOSE = {
    "email": re.compile(r"(?<![\w.%+-])[\w.%+-]{1,64}(?:@| ?[(\[]at[)\]] ?| at )[\w-]{1,63}(?:(?:\.| ?[(\[]dot[)\]] ?| dot )[\w-]{1,63}){1,4}", re.I),
    "ip": re.compile(r"(?<![0-9.])[0-9]{1,4}(?: ?[.,] ?[0-9]{1,4}){3}(?![0-9])"),
    "card": re.compile(r"(?<![0-9])[0-9](?:[ ._-]{0,2}[0-9]){12,18}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9.])\(?[0-9]{1,4}\)?(?:[ ./-]{1,2}\(?[0-9]{2,4}\)?){2,4}(?![0-9])"),
}


def candidates(text: str) -> list[Span]:
    """Overlapping loose spans, together with the base ones."""
    found = {s for s in base_spans(text)}
    for kind, pattern in _LOOSE.items():
        found.update((*m.span(), kind) for m in pattern.finditer(text))
    return sorted(found)


FEATURES = 17

_DATE = re.compile(r"(?:[12][0-9]{3}[ ./-]{1,2}[01]?[0-9][ ./-]{1,2}[0-3]?[0-9]|[0-3]?[0-9][ ./-]{1,2}[01]?[0-9][ ./-]{1,2}(?:[12][0-9])?[0-9]{2})\Z")
_VERSION = re.compile(r"[0-9]+(?:\.[0-9]+){2,}\Z")
_PRICE = re.compile(r"[0-9]{1,3}(?:[ .][0-9]{3})*[.,][0-9]{2}\Z")
_NAMED = re.compile(r"(?:\bv|version|release|build|rev)\.? ?\Z", re.I)
_CONTACT = re.compile(r"mail|contact|write|reach|addr", re.I)
_COUNTRY = re.compile(r"\+[0-9]{1,3}[ .-]*(?=[(0-9])")
_PLAIN_AT = re.compile(r" at ", re.I)


def _ending(body: str) -> str:
    return body.rpartition(".")[2]


def excluded(text: str, span: Span, base: set[Span], speech: bool = True) -> bool:
    """Whether a rule says that this candidate is no personal data of its kind. ``speech``: also an "at" without
    brackets and without a word of contact before it, whose form says nothing."""
    lo, hi, kind = span
    body, before, after = text[lo:hi], text[max(0, lo - 24):lo], text[hi:hi + 4]
    if any(b[2] != kind and lo < b[1] and b[0] < hi for b in base):
        return True
    digits = _NOT_DIGIT.sub("", body)
    if kind == "card":
        return not (13 <= len(digits) <= 19 and luhn(digits))
    if kind == "ip":
        return ("," in body or bool(_NAMED.search(before)) or not all(map(_small, filter(None, _NOT_DIGIT.split(body)))))
    if kind == "phone":
        return (not 7 <= len(digits) <= 15 or bool(_DATE.match(body) or _VERSION.match(body) or _PRICE.match(body))
                or before.rstrip()[-1:] in ("$", "€", "£") or after.lstrip()[:1] in ("%", "€", "$"))
    ending = _ending(_DOT.sub(".", body))
    return (not ending.isalpha() or not 2 <= len(ending) <= 10
            or speech and bool(_PLAIN_AT.search(body)) and not _CONTACT.search(before))


def masked(body: str, kind: str) -> list[str]:
    """A base span without the mark that made it one."""
    if kind != "phone":
        return [body]
    national = _COUNTRY.sub("", body)
    return [body.lstrip("+")] + ([national] if national != body and len(_NOT_DIGIT.sub("", national)) >= 7 else [])


def spoiled(body: str, kind: str) -> str:
    """A span like a base one that some rule excludes; the same for equal bodies."""
    n = zlib.crc32(body.encode())
    if kind == "card":
        return body[:-1] + str((int(body[-1]) + 1 + n % 9) % 10)
    if kind == "ip":
        return f"{256 + n % 744}.{body.split('.', 1)[1]}"
    if kind == "email":
        return f"{body.rpartition('.')[0]}.{n % 1000}"
    a, b, c = n % 28 + 1, n // 28 % 12 + 1, n // 336 % 900 + 100
    return (f"{1900 + c % 130}-{b:02}-{a:02}", f"{a:02}/{b:02}/{1900 + c % 130}", f"{a} {c}.{b:02}", f"{a}.{10 + b}.{c}",
            f"{a:02}.{b:02}.{1900 + c % 130}")[n // 302_400 % 5]


def features(text: str, span: Span) -> list[float]:
    lo, hi, kind = span
    return _features(kind, text[lo:hi], text[max(0, lo - 24):lo], text[hi:hi + 12])


def _features(kind: str, body: str, before: str, after: str) -> list[float]:
    body, before = body.lstrip("+"), before.rstrip("+")
    ending = ""
    if kind == "email":
        body = _DOT.sub(".", _AT.sub("@", body))
        ending = _ending(body)
    digits = _NOT_DIGIT.sub("", body)
    groups = [g for g in re.split(r"[^0-9]+", body) if g]
    longest = max(map(len, groups), default=0)
    return [
        KINDS.index(kind), len(body), len(digits), len(groups), longest,
        float(14 <= len(digits) <= 19 and luhn(digits)),
        max((int(g) if len(g) < 10 else 10**9 for g in groups), default=0),
        body.count("(") + body.count(")"), body.count("-"), body.count("."), body.count(" "), body.count("@"),
        float(before[-1:].isalnum() or before[-1:] in ("#", "$", "=", "/")), float(after[:1].isalnum()),
        float(bool(re.search(r"(?i)mail|contact|phone|tel|call|fax|card|visa|pay|ip|host|addr", before))),
        float(len(ending) if ending.isalpha() else 0), float(len(groups[0]) if groups else 0),
    ]


@dataclass
class Boosted:
    """Newton-boosted trees for log odds, over binned features."""

    cuts: list[np.ndarray] = field(default_factory=list)
    trees: list[list[tuple]] = field(default_factory=list)
    start: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)
    recall: dict[str, float] = field(default_factory=dict)  # of unseen base spans without their mark

    def _bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(self.cuts)], axis=1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        self.cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:])) for j in range(x.shape[1])]
        b, p0 = self._bins(x), (y.sum() + 1) / (len(y) + 2)
        self.start = math.log(p0 / (1 - p0))
        f = np.full(len(y), self.start)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-f))
            tree: list[tuple] = []
            self._grow(tree, b, p - y, p * (1 - p), np.arange(len(y)), DEPTH)
            self.trees.append(tree)
            f += self._leaf(tree, b)
        return self

    def _grow(self, tree: list, b: np.ndarray, g: np.ndarray, h: np.ndarray, rows: np.ndarray, depth: int) -> int:
        at = len(tree)
        total_g, total_h = g[rows].sum(), h[rows].sum()
        tree.append((-1, 0, -RATE * total_g / (total_h + 1), 0, 0))
        best = (1e-6, -1, 0)
        for j in range(b.shape[1] if depth else 0):
            gs = np.bincount(b[rows, j], weights=g[rows], minlength=BINS + 2).cumsum()[:-1]
            hs = np.bincount(b[rows, j], weights=h[rows], minlength=BINS + 2).cumsum()[:-1]
            gain = (gs**2 / (hs + 1) + (total_g - gs)**2 / (total_h - hs + 1)) - total_g**2 / (total_h + 1)
            gain[(hs < 1e-3) | (total_h - hs < 1e-3)] = 0
            if gain.max() > best[0]:
                best = (float(gain.max()), j, int(gain.argmax()))
        if best[1] >= 0:
            left = b[rows, best[1]] <= best[2]
            lo = self._grow(tree, b, g, h, rows[left], depth - 1)
            hi = self._grow(tree, b, g, h, rows[~left], depth - 1)
            tree[at] = (best[1], best[2], 0.0, lo, hi)
        return at

    @staticmethod
    def _leaf(tree: list[tuple], b: np.ndarray) -> np.ndarray:
        out, todo = np.zeros(len(b)), [(0, np.arange(len(b)))]
        while todo:
            at, rows = todo.pop()
            j, cut, value, lo, hi = tree[at]
            if j < 0:
                out[rows] = value
            else:
                left = b[rows, j] <= cut
                todo += [(lo, rows[left]), (hi, rows[~left])]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        b = self._bins(x)
        return 1 / (1 + np.exp(-(self.start + sum(self._leaf(t, b) for t in self.trees))))


def _at_most(k: int, n: int, p: float) -> float:
    """P(X <= k) of a binomial variable, summed from k down until terms no longer count."""
    if p <= 0 or k >= n:
        return 1.0
    term = math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p))
    total = 0.0
    for i in range(k, -1, -1):
        total += term
        if i < n * p and term < 1e-17 * total:
            break
        term *= i * (1 - p) / ((n - i + 1) * p)
    return min(1.0, total)


def learn(rows: list[tuple[list[float], bool]]) -> Boosted:
    """Trees from (features, base span or not)."""
    model = Boosted()
    x, y = np.array([r[0] for r in rows], float), np.array([r[1] for r in rows], float)
    if len(rows) < LEAST_EXAMPLES or not 0 < y.sum() < len(y):
        return model
    return model.fit(x, y)


def threshold(counts: dict[int, tuple[int, int]]) -> float | None:
    """The lowest score whose precision holds, from (right, wrong) per score bin."""
    best, right, wrong = None, 0, 0
    for i in sorted((i for i in counts if i >= 0), reverse=True):  # from the surest down, until the bound no longer holds
        right, wrong = right + counts[i][0], wrong + counts[i][1]
        n = right + wrong
        if best is not None and wrong > 0.5 * (1 - PRECISION) * n:
            break
        # the precision is at least PRECISION unless so few errors are improbable
        if wrong < (1 - PRECISION) * n and _at_most(wrong, n, 1 - PRECISION) <= 1 - CONFIDENCE:
            best = float(EDGES[i])
        elif best is not None:
            break
    return best


def spans(text: str | None, model: Boosted) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans), both by start and then kind. Added spans overlap no base span and
    no better added one."""
    if not text or not _HAS.search(text):
        return [], []
    base = base_spans(text)
    if not model.thresholds:
        return base, base
    own = set(base)
    open_ = [c for c in candidates(text) if c[2] in model.thresholds and c not in own
             and not any(c[0] < b[1] and b[0] < c[1] for b in base) and not excluded(text, c, own)]
    added: list[Span] = []
    if open_:
        score = model.score(np.array([features(text, c) for c in open_], float))
        for i in np.argsort(-score, kind="stable"):
            c = open_[i]
            if score[i] >= model.thresholds[c[2]] and not any(c[0] < a[1] and a[0] < c[1] for a in added):
                added.append(c)
    return base, sorted(base + added, key=lambda s: (s[0], KINDS.index(s[2])))


def told(found: list[Span]) -> str:
    return ",".join(f"{k}:{lo}:{hi}" for lo, hi, k in found)


def fit(docs: DataFrame, sample_candidates: int = SAMPLE_CANDIDATES) -> Boosted:
    """Trees from about ``sample_candidates`` candidates at most, thresholds from those of all distinct texts."""
    arrow_rows(docs.sparkSession)
    rows = docs.where(F.col("text").isNotNull()).select(F.col("text").cast("string").alias("text"))
    rows = rows.select(F.xxhash64(F.lit(8), "text").alias("key"), "text")

    def examples(text: str) -> Iterator[tuple]:
        """(start, stop, kind, variant, features, right) of what is certain in a text."""
        base = base_spans(text)
        own = set(base)
        for lo, hi, kind in base:
            before, body, after = text[max(0, lo - 24):lo], text[lo:hi], text[hi:hi + 12]
            for i, m in enumerate(masked(body, kind)):
                yield lo, hi, kind, i, _features(kind, m, before, after), True
            yield lo, hi, kind, 9, _features(kind, spoiled(body, kind), before, after), False
        for c in candidates(text):
            if c not in own and not any(c[2] == b[2] and c[0] < b[1] and b[0] < c[1] for b in base) and excluded(text, c, own, False):
                yield *c, 8, features(text, c), False

    def propose(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = [(key, *e) for key, text in zip(pdf["key"], pdf["text"]) if _HAS.search(text) for e in examples(text)]
            yield pd.DataFrame(out, columns=[*one, "x", "y"])

    one, taught = ["key", "start", "stop", "kind", "variant"], F.col("key").bitwiseAND(F.lit(1)) == 1
    named = "key long, start int, stop int, kind string, variant int"
    found = scratch_table(rows.mapInPandas(filled(propose), f"{named}, x array<double>, y boolean"), "candidates")
    sizes = {(r["kind"], r["taught"], r["y"]): r["n"] for r in found.select(*one, "y").distinct()
             .groupBy("kind", taught.alias("taught"), "y").agg(F.count("*").alias("n")).collect()}  # 16 rows at most

    each, place = sample_candidates // (2 * len(KINDS)), F.pmod(F.xxhash64(F.lit(9), *one), F.lit(1 << 40))
    drawn = F.lit(False)
    for (kind, odd, y), n in sizes.items():
        if odd:
            drawn |= (F.col("kind") == kind) & (F.col("y") == y) & (place < int((1 << 40) * min(1.0, each / n)))
    sample = found.where(taught & drawn).dropDuplicates(one).collect()
    model = learn([(r["x"], r["y"]) for r in sorted(sample, key=lambda r: tuple(r[c] for c in one))])
    if not model.trees:
        return model

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            if len(pdf):
                at = np.searchsorted(EDGES, model.score(np.stack(pdf["x"])), side="right") - 1
                yield pdf[[*one, "y"]].assign(bin=at.astype(np.int32))

    counts: dict[str, dict[int, tuple[int, int]]] = {k: {} for k in KINDS}
    right = F.col("y").cast("long")
    for r in (found.where(~taught).mapInPandas(filled(score), f"{named}, y boolean, bin int").distinct()
              .groupBy("kind", "bin").agg(F.sum(right).alias("right"), F.sum(1 - right).alias("wrong")).collect()):
        counts[r["kind"]][r["bin"]] = (r["right"], r["wrong"])  # kinds x bins at most
    for k in KINDS:
        if min(sizes.get((k, odd, y), 0) for odd in (False, True) for y in (False, True)) >= LEAST_EXAMPLES:
            if (least := threshold(counts[k])) is not None:
                model.thresholds[k] = least
                right = sum(c[0] for c in counts[k].values())
                model.recall[k] = sum(c[0] for i, c in counts[k].items() if i >= 0 and EDGES[i] >= least) / max(1, right)
    return model


RESULT = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def find(docs: DataFrame, model: Boosted | None = None) -> DataFrame:
    """One row per document with its counts, the digest of its base spans and all spans."""
    spark = docs.sparkSession
    arrow_rows(spark)
    shared = spark.sparkContext.broadcast(model or fit(docs))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = []
            for text in pdf["text"]:
                base, every = spans(text, shared.value)
                out.append((*[sum(s[2] == k for s in base) for k in KINDS],
                            hashlib.sha256(told(base).encode()).hexdigest(), told(every)))
            made = pd.DataFrame(out, columns=["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])
            made.insert(0, "doc_id", pdf["doc_id"].to_numpy())
            yield made

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).mapInPandas(filled(run), RESULT)


def redact(docs: DataFrame, model: Boosted | None = None) -> DataFrame:
    """``docs`` with every found span of its texts replaced by its kind in brackets."""
    spark = docs.sparkSession
    arrow_rows(spark)
    shared = spark.sparkContext.broadcast(model or fit(docs))

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            parts, done = [], 0
            for lo, hi, kind in spans(text, shared.value)[1]:
                if lo >= done:
                    parts += [text[done:lo], f"[{kind.upper()}]"]
                done = max(done, hi)
            out.append("".join([*parts, text[done:]]) if parts else text)
        return pd.Series(out, dtype=object)

    return docs.withColumn("text", clean(F.col("text").cast("string"))).select(*[F.col(f"`{c}`") for c in docs.columns])
