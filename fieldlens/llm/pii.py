"""Personal data: base patterns, candidates of wider patterns, and boosted trees that choose among them.

Spans that pass the base rules always stay. Generators of high recall propose more spans, which may overlap:
other separators, masked at-signs, numbers without a plus. Boosted trees score each by its format and its
surroundings. They learn from made examples (``lessons``), in which both classes share their shapes, from the
documents' own base spans written in wider formats, and from candidates that their surroundings rule out. The scores
are calibrated, and each kind's threshold set, on formats that the trees did not see: the lowest threshold that
keeps precision. Chosen spans do not overlap others.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.llm import lessons
from fieldlens.llm.boosting import Trees, boost, calibrate
from fieldlens.llm.common import whole

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCS = 4000  # documents with something to find that the fit reads, about
SAMPLE_SPANS = 50  # candidates of one of them that it reads
SAMPLE_EACH = 200  # candidates of a kind and class, over all documents, that it learns from
PRECISION = 0.95  # among spans of formats that the trees did not see; formats that they saw come out higher
AROUND = 40

Span = tuple[str, int, int]

_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

_MASKED_AT = re.compile(r"\s?[(\[{]\s?(?:at|AT)\s?[)\]}]\s?|\s@\s")
_MASKED_RIGHT = re.compile(r"[A-Za-z0-9-]{1,63}(?:\s?(?:\.|[(\[{]\s?(?:dot|DOT)\s?[)\]}])\s?[A-Za-z0-9-]{2,63}){1,4}")
_MASKED_DOT = re.compile(r"\s?[(\[{]\s?(?:dot|DOT)\s?[)\]}]\s?")
_WIDE_IP = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){4,7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])|(?<![0-9])[0-9]{1,3}(?:\[\.\][0-9]{1,3}){3}(?![0-9])")
_WIDE_CARD = re.compile(r"(?<![0-9])[0-9](?:[ ./ ‐-―-]{0,2}[0-9]){12,18}(?![0-9])")
_WIDE_PHONE = re.compile(r"(?<![0-9+])(?:\+|00)?\(?[0-9][0-9 ()./ ‐-―-]{5,24}[0-9](?![0-9])")
_ANYTHING = r"[0-9@]|[(\[{]\s?(at|AT)\s?[)\]}]"
_YEAR_FIRST = re.compile(r"(?:1[5-9]|20)[0-9]{2}[-./ ](?P<m>[0-9]{1,2})[-./ ](?P<d>[0-9]{1,2})")
_YEAR_LAST = re.compile(r"(?P<d>[0-9]{1,2})[-./ ](?P<m>[0-9]{1,2})[-./ ](?:1[5-9]|20)[0-9]{2}")
_YEARS = re.compile(r"(?:1[5-9]|20)[0-9]{2} ?[-/‐-―] ?(?:1[5-9]|20)[0-9]{2}")
_AMOUNT_BEFORE = re.compile(r"(?i)(?:[$€£#]|\b(?:v|ver|version|isbn|issn|doi)[.:]{0,2})\s?\Z")
_NUMBER = re.compile(r"\s*[0-9]+(?:[.,][0-9]+)*\s*")


def _any_of(words: list[str]) -> re.Pattern:
    return re.compile(r"(?i)(?<!\w)(?:" + "|".join(re.escape(w) for w in sorted(words, key=len, reverse=True)) + r")(?!\w)")


_CUES = {kind: _any_of(words) for kind, words in lessons.CUES.items()}  # surroundings that speak for a kind
_NUMBERED, _MONEY = _any_of(lessons.NUMBERED), re.compile("|".join(re.escape(m) for m in lessons.MONEY))
_TLD = re.compile(r"(?:\.|(?:dot|DOT)\s?[)\]}]\s?)(" + "|".join(re.escape(d) for d in lessons.DOMAINS) + r")\Z")


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return sum(v if i % 2 == 0 else (2 * v - 9 if v > 4 else 2 * v) for i, v in enumerate(values)) % 10 == 0


def _digits(s: str) -> str:
    return re.sub(r"[^0-9]", "", s)


def base_spans(text: str) -> list[Span]:
    """Leftmost matches of each kind that do not overlap; those that fail their check are dropped.

    An address is found from its at-sign: it starts where the run of characters before it does, or where
    the match before ended.
    """
    found: list[Span] = []
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and _LOCAL.match(text, start - 1):
            start -= 1
        match = _DOMAIN.match(text, at) if start < at else None
        if match:
            found.append(("email", start, match.end()))
        free = match.end() if match else at + 1
        at = text.find("@", free)
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            found.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if 16 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            found.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_digits(m[0])) <= 15:
            found.append(("phone", m.start(), m.end()))
    return found


def _ends(host: str) -> list[int]:
    """Where a masked host may end: behind each of its parts but the first."""
    return [m.end() for m in re.finditer(r"[A-Za-z0-9-]+", _MASKED_DOT.sub(lambda d: "." * len(d[0]), host))][1:]


def candidates(text: str) -> list[Span]:
    """Spans of the wider patterns; they may overlap one another and base spans."""
    found: list[Span] = []
    for m in _MASKED_AT.finditer(text):
        left = m.start()
        while left and _LOCAL.match(text, left - 1):  # runs between two marks are apart, so this stays linear
            left -= 1
        right = _MASKED_RIGHT.match(text, m.end())
        if left < m.start() and right:  # a host may end at each of its parts; what follows may be the next sentence
            found += [("email", left, m.end() + e) for e in _ends(right[0])]
    for kind, pattern in (("ip", _WIDE_IP), ("card", _WIDE_CARD), ("phone", _WIDE_PHONE)):
        found += [(kind, m.start(), m.end()) for m in pattern.finditer(text)]
    return found


def _shape(c: str) -> int:
    return 0 if not c else 1 if c.isspace() else 2 if c.isalpha() else 3 if c.isdigit() else 4


def features(text: str, span: Span) -> list[float]:
    kind, start, end = span
    s, before, after = text[start:end], text[max(0, start - AROUND) : start], text[end : end + AROUND]
    d, around, near = _digits(s), before + after, before[-25:]
    groups = [len(g) for g in re.findall(r"[0-9]+", s)] or [0]
    parts = [len(p) for p in re.split(r"[^0-9A-Za-z]+", s) if p]
    years = sum(len(g) == 4 and "1500" <= g <= "2099" for g in re.findall(r"[0-9]+", s))
    return [
        KINDS.index(kind), len(s), len(d), len(groups), max(groups), min(groups), groups[0], groups[-1], len(set(d)), s.count(" "), s.count("-"), s.count("."), s.count("(") + s.count("["),
        s.count("/"), s.startswith("+"), s.startswith("00"), s.startswith("0"), bool(d) and luhn(d), max((int(g) for g in re.findall(r"[0-9]{1,9}", s)), default=0) <= 255,
        s.count(":"), sum(c.isalpha() for c in s), sum(c.isupper() for c in s), _shape(before[-1:]), _shape(after[:1]), sum(c.isdigit() for c in around) / (len(around) + 1), around.count("|"),
        bool(_CUES[kind].search(near)), any(bool(p.search(near)) for k, p in _CUES.items() if k != kind), bool(_NUMBERED.search(near)), bool(_MONEY.search(before[-8:]) or _MONEY.search(after[:5]) or after.lstrip()[:1] == "%"),
        before.rstrip()[-1:] in ("=", '"', "[", "_", "#", "'"), before[-1:].isalnum() + after[:1].isalnum(), _is_date(s), years, bool(_TLD.search(s)), s[:1].isdigit(),
        max(parts), sum(parts) / len(parts), len(set(parts)),
    ]


def _variants(text: str, span: Span) -> list[tuple[str, Span]]:
    """A base span written in other ways, in its surroundings; what the trees learn wider formats from."""
    kind, start, end = span
    s, before, after = text[start:end], text[max(0, start - AROUND) : start], text[end : end + AROUND]
    if kind == "email":
        name, host = s.split("@", 1)
        forms = [f"{name} (at) {host}", f"{name}[at]{host.replace('.', '[dot]')}"]
    elif kind == "ip":
        forms = [s.replace(".", "[.]")]
    elif kind == "card":
        d = _digits(s)
        forms = [".".join(d[i : i + 4] for i in range(0, len(d), 4))]
    else:
        forms = ["00" + s[1:], s[1:].lstrip()] if re.search(r"[ ().-]", s) else ["00" + s[1:]]
    return [(before + f + after, (kind, len(before), len(before) + len(f))) for f in forms]


def _is_date(s: str) -> bool:
    for m in (_YEAR_FIRST.fullmatch(s), _YEAR_LAST.fullmatch(s)):
        if m and 1 <= int(m["m"]) <= 12 and 1 <= int(m["d"]) <= 31 or m and 1 <= int(m["d"]) <= 12 and 1 <= int(m["m"]) <= 31:
            return True
    return bool(_YEARS.fullmatch(s))


def ruled_out(text: str, span: Span) -> int:
    """Why the surroundings rule a candidate out: 1 a date, 2 an amount, 3 a cell of numbers, 4 part of a longer word; 0 if nothing does.

    No check of digits is among them: those are features, and labels must not repeat them.
    """
    kind, start, end = span
    s = text[start:end]
    if kind == "email":
        return 0 if re.search(r"[A-Za-z]{2,}\s?\Z", re.split(r"\.|(?i:dot)\s?[)\]}]", s)[-1]) else 2  # no host ends in digits
    if kind != "phone":
        return 0
    line = text[text.rfind("\n", 0, start) + 1 : (text.find("\n", end) + 1 or len(text) + 1) - 1]
    cells = [c for c in re.split(r"[|\t]", line) if _NUMBER.fullmatch(c)] if "|" in line or "\t" in line else []
    if _is_date(s):
        return 1
    if _AMOUNT_BEFORE.search(text, max(0, start - 12), start) or text[end : end + 2].lstrip()[:1] == "%":
        return 2
    if len(cells) > 2 and _NUMBER.fullmatch(s):
        return 3
    return 4 if text[max(0, start - 1) : start].isalpha() and text[end : end + 1].isalpha() else 0


def examples(text: str) -> list[tuple[list[float], int, int]]:
    """(features, personal, part): base spans written in wider formats are personal, candidates that are ruled out are not.

    Other candidates may be personal in a format that no base pattern has, so they say nothing either way. A
    format, or a reason, lies in one part.
    """
    base = base_spans(text)
    out = [(features(t, s), 1, number % lessons.PARTS) for b in base for number, (t, s) in enumerate(_variants(text, b))]
    apart = [c for c in candidates(text) if not any(c[1] < e and b < c[2] for _, b, e in base)]
    return out + [(features(text, c), 0, why % lessons.PARTS) for c in apart if (why := ruled_out(text, c))]


@dataclass(frozen=True)
class Model:
    trees: Trees
    scale: tuple[float, float] = (1.0, 0.0)
    threshold: dict[str, float] = field(default_factory=dict)

    def scaled(self, margin: np.ndarray) -> np.ndarray:
        a, b = self.scale
        return 1 / (1 + np.exp(-(a * margin + b)))

    def probability(self, x: np.ndarray) -> np.ndarray:
        return self.scaled(self.trees.margin(x))


def _threshold(p: np.ndarray, y: np.ndarray, precision: float) -> float:
    """The lowest threshold at which, and above which, precision holds; beyond 1 if there is none."""
    order = np.argsort(-p, kind="stable")
    right = np.cumsum(y[order]) / np.arange(1, len(y) + 1)
    ends = np.nonzero(np.append(np.diff(p[order]) != 0, True))[0] if len(p) else np.zeros(0, np.int64)
    good = [k for k in ends if right[k] >= precision]
    return max(0.5, float(p[order][good[-1]])) if good else 2.0


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, precision: float = PRECISION, doc_id: str = "doc_id", text: str = "text") -> Model:
    """Learns from the made examples and from about ``sample_docs`` documents, chosen by a hash of the id, with a digit or at-sign.

    The made examples hold both classes of every kind, so there is a model whatever the documents hold. Scores
    are calibrated, and thresholds set, on formats that the trees behind them did not see.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("text")).where(F.col("text").rlike(_ANYTHING))
    rate = min(1.0, sample_docs / max(1, rows.count()))
    chosen = rows.where(F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(1 << 30)) < int(rate * (1 << 30))).select("text")

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [x for t in batch.column(0).to_pylist() for x in examples(t)[:SAMPLE_SPANS]]
            types = [pa.list_(pa.float64()), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], t) for k, t in enumerate(types)], names=["x", "y", "part"])

    found = sorted((list(r.x), r.y, r.part) for r in chosen.mapInArrow(judged, "x array<double>, y int, part int").collect())
    # Of each kind and class an even share of the sorted examples, so that no common format outweighs the made ones.
    for k in range(len(KINDS)):
        for label in (0, 1):
            own = [i for i, f in enumerate(found) if f[0][0] == k and f[1] == label]
            over = set(own) - {own[i * len(own) // SAMPLE_EACH] for i in range(SAMPLE_EACH)} if len(own) > SAMPLE_EACH else set()
            found = [f for i, f in enumerate(found) if i not in over]
    return learn([([float(v) for v in features(t, s)], y, part) for t, s, y, part in lessons.examples()] + found, precision)


def learn(found: list[tuple[list[float], int, int]], precision: float = PRECISION) -> Model:
    """A model of examples (features, personal, part).

    Each part is judged by trees of the other parts, so calibration and thresholds rest on formats that were not
    seen; the trees that are used then learn from all.
    """
    x, y, part = (np.array([f[k] for f in found], dtype=float) for k in range(3))
    margin = np.zeros(len(y))
    for k in np.unique(part):
        margin[part == k] = boost(x[part != k], y[part != k], rounds=60, depth=4).margin(x[part == k])
    model = Model(boost(x, y, rounds=60, depth=4), calibrate(margin, y))
    p, kind = model.scaled(margin), x[:, 0].astype(int)
    return Model(model.trees, model.scale, {name: _threshold(p[kind == k], y[kind == k], precision) for k, name in enumerate(KINDS)})


def spans(text: str, model: Model) -> list[tuple[str, int, int, float, bool]]:
    """(kind, start, end, probability, is base) by kind, then start."""
    base = base_spans(text)
    chosen = [(k, s, e, 1.0, True) for k, s, e in base]
    wide = [c for c in candidates(text) if not any(c[1] < e and s < c[2] for _, s, e in base)]
    if wide:
        p = model.probability(np.array([features(text, c) for c in wide], dtype=float))
        taken: list[tuple[int, int]] = []
        for i in sorted(range(len(wide)), key=lambda i: (-p[i], wide[i])):
            kind, s, e = wide[i]
            if p[i] >= model.threshold[kind] and not any(s < b and a < e for a, b in taken):
                taken.append((s, e))
                chosen.append((kind, s, e, float(p[i]), False))
    return sorted(chosen, key=lambda c: (KINDS.index(c[0]), c[1], c[2]))


def redacted(text: str, found: list[tuple[str, int, int, float, bool]]) -> str:
    """The text with each span, or union of overlapping spans, replaced by its kind in brackets."""
    out, at = [], 0
    for kind, s, e, *_ in sorted(found, key=lambda f: (f[1], -f[2])):
        if s >= at:
            out += [text[at:s], f"[{kind}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


SPAN = "array<struct<kind: string, start: long, end: long, probability: double, base: boolean>>"


def find(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", redact: bool = False) -> DataFrame:
    """One row per input row: doc_id, spans and, if asked for, the redacted text.

    Places are code points, ends exclusive. NULL texts count as empty; rows are judged one by one, so repeated
    rows and NULL ids do not matter, and an empty table gives no rows. Other columns are ignored.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    type_ = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64()), ("base", pa.bool_())]))
    names = [f.name for f in type_.value_type]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            found: list[list] = [[] for _ in range(len(texts))]
            for i in np.nonzero(pc.match_substring_regex(texts, _ANYTHING).to_numpy(zero_copy_only=False))[0].tolist():
                found[i] = spans(texts[i].as_py(), model)
            columns = [batch.column(0), pa.array([[dict(zip(names, f, strict=True)) for f in row] for row in found], type_)]
            if redact:
                columns.append(pa.array([redacted(t.as_py(), f) for t, f in zip(texts, found, strict=True)], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "spans", "redacted"][: len(columns)])

    return rows.mapInArrow(run, f"doc_id {kind}, spans {SPAN}" + ", redacted string" * redact)


def digest(found: DataFrame) -> DataFrame:
    """doc_id, base spans of each kind, the SHA-256 of the base spans as text, and all spans as text."""
    written = lambda kept: F.array_join(F.transform(kept, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in KINDS], F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
