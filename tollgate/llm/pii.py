"""Personal data: base patterns, and candidates judged by boosted trees.

The base spans (email, ip, card, phone) are always taken. Besides, generators
of high recall propose looser spans that may overlap: numbers in groups and
their parts between separators, spelt mail addresses and long keys. Boosted trees
judge the format and the context of every candidate, and only those whose
calibrated probability reaches the threshold are taken, the likeliest first. The
trees learn from the corpus itself: rules label the candidates that they settle (a
check digit, a plus, a well-formed spelt address, an order number, a date) and
leave the rest out, so that a form does not become less likely by being common.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import boosting
from .common import bounded_share, forget_cache, slices, strings

KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = (*KINDS, "secret")
#: Documents and candidates that a fit uses at most, about.
SAMPLE_DOCS, SAMPLE_CANDIDATES = 12_000, 30_000
THRESHOLD = 0.9

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits that fails from its start fails from each later digit too.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NUMBER = re.compile(r"\+?\(?[0-9](?:[ ().\-/]{0,2}[0-9])+")
_GROUP = re.compile(r"\+?\(?[0-9]+")
_QUAD = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_SPELT = re.compile(r"[A-Za-z0-9._%+-]++ ?[\[(]at[\])] ?[A-Za-z0-9-]++(?: ?(?:\.|[\[(]dot[\])]) ?[A-Za-z0-9-]++)+")
_KEY = re.compile(r"(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]{24,}+={0,2}")
_NAMED = re.compile(r"(?:token|key|secret|passw(?:or)?d|bearer)\W{0,6}$", re.I)
#: Words that say a number is no phone or card number (its first groups may be
#: between), dates, issuers' first digits, spelt addresses.
_OTHER = re.compile(r"\b(?:order|invoice|ref(?:erence)?|ticket|serial|isbn|issn|sku|item|article|tracking|case|version|doi)"
                    r"(?:\W{0,3}(?:no|nr|number|id))?\W{0,4}[0-9 ().\-/]{0,8}$", re.I)
_DATE = re.compile(r"(?:19|20)[0-9]{2}([-/. ])(?:0?[1-9]|1[0-2])\1(?:0?[1-9]|[12][0-9]|3[01])(?![0-9])"
                   r"|(?:0?[1-9]|[12][0-9]|3[01])([-/. ])(?:0?[1-9]|[12][0-9]|3[01])\2(?:19|20)[0-9]{2}(?![0-9])")
_ISSUED, _AMEX = re.compile(r"[3-6]|2[2-7]"), re.compile(r"3[47]")
_AT, _DOT = re.compile(r" ?[\[(]at[\])] ?"), re.compile(r" ?[\[(]dot[\])] ?")
_LOOSE = re.compile(r" \. ?|\. ")
_ADDRESS = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,24}")
_CUES = [re.compile(p, re.I) for p in (r"mail|contact|write", r"\bip\b|host|server|addr", r"card|visa|pay|credit",
                                       r"phone|call|tel|mobile|fax")] + [_OTHER]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns, by kind, then start; code points.
    Each kind: leftmost matches that do not overlap; failing ones are dropped."""
    found, end = [], 0
    if "@" in text:
        for m in _DOMAIN.finditer(text):
            local = text[max(end, text.rfind("@", end, m.start()) + 1):m.start()]
            if n := len(local) - len(local.rstrip(_LOCAL)):
                end = m.end()
                found.append(("email", m.start() - n, end))
    found += [("ip", *m.span()) for m in _IP.finditer(text) if all(_octet(p) for p in m[0].split("."))]
    found += [("card", *m.span()) for m in _CARD.finditer(text) if 16 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
    if "+" in text:
        found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return found


def _octet(part: str) -> bool:
    return len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255


def _numbers(text: str, start: int, end: int) -> Iterator[tuple[int, int, int]]:
    """(start, end, digits) of a run of number groups, if it has 4 digits at
    least, and of its parts: at most 19 digits in whole groups, parentheses closed."""
    groups = [(m.start(), m.end(), len(_digits(m[0]))) for m in _GROUP.finditer(text, start, end)]
    if (n := sum(g for _, _, g in groups)) >= 4:
        yield start, end, n
    for i, (s, _, _) in enumerate(groups):
        n = 0
        for _, e, g in groups[i:i + 19]:
            if (n := n + g) > 19:
                break
            if n >= 4 and (s, e) != (start, end) and text.count("(", s, e) == text.count(")", s, e):
                yield s, e, n


def candidates(text: str) -> list[tuple[str, int, int]]:
    """Looser spans, which may overlap base spans and each other."""
    found = []
    for m in _NUMBER.finditer(text):
        for s, e, n in _numbers(text, *m.span()):
            whole = (s, e) == m.span()
            if whole and n >= 7 and text.count(".", s, e) == 3 or not whole and _QUAD.fullmatch(text, s, e):
                found.append(("ip", s, e))
            if 15 <= n <= 19:
                found.append(("card", s, e))
            if 7 <= n <= 15:
                found.append(("phone", s, e))
    if "at)" in text or "at]" in text:
        for m in _SPELT.finditer(text):
            found.append(("email", *m.span()))
            # a loose dot may end a sentence: the address up to there
            found += [("email", *p.span()) for d in _LOOSE.finditer(text, *m.span()) if (p := _SPELT.fullmatch(text, m.start(), d.start()))]
    found += [("secret", *m.span()) for m in _KEY.finditer(text) if any(c.isdigit() for c in m[0])]
    return found


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format and context of a candidate: check digits, number ranges and dates as
    well, but not what only a labelled form has (a leading plus, a key's name, the
    spelling of an address), so that the forms that no rule settles are judged by
    what they share with others."""
    s = _plain(text[start:end]) if kind == "email" else text[start:end].lstrip("+")
    before, after = text[max(0, start - 24):start], text[end:end + 12]
    groups = [len(g) for g in re.split(r"[^0-9]+", s) if g] or [0]
    n, digits = max(1, len(s)), sum(groups)
    counts = Counter(s)
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
    return [
        float(ADDED_KINDS.index(kind)), float(len(s)), float(digits), digits / n, float(len(groups)), float(max(groups)),
        float(min(groups)), float(s.count(" ")), float(s.count("-")), float(s.count(".")), float(s.count("(") + s.count(")")),
        entropy, sum(c in "0123456789abcdef" for c in s) / n, sum(c.isupper() for c in s) / n,
        float(before[-1:].isalnum()), float(after[:1].isalnum()), sum(c.isdigit() for c in before + after) / 36,
        *(float(bool(p.search(before))) for p in _CUES), *_checks(s, kind, before, after),
    ]


def _checks(s: str, kind: str, before: str, after: str) -> list[float]:
    """Check digit, issuer and usual groups of a card; parts of an address in their
    range and ended; a date. -1 where it does not apply."""
    digits = _digits(s)
    card, ip = kind == "card", kind == "ip"
    groups = [len(g) for g in re.split("[^0-9]+", s) if g] if card else []
    usual = groups in ([len(digits)], [4, 6, 5]) or groups[:4] == [4] * 4 and len(groups) <= 5
    quad = ip and bool(_QUAD.fullmatch(s)) and all(_octet(p) for p in s.split("."))
    return [float(luhn(digits)) if card else -1.0, float(bool(_ISSUED.match(digits))) if card else -1.0,
            float(usual) if card else -1.0, float(len(digits) == 15 and not _AMEX.match(digits)) if card else -1.0,
            float(quad and before[-1:] != "." and not (after[:1] == "." and after[1:2].isdigit())) if ip else -1.0,
            float(bool(_DATE.match(s))) if kind == "phone" else -1.0, float(bool(_LOOSE.search(s))) if kind == "email" else -1.0]


N_FEATURES = 24 + len(_CUES)


def _plain(address: str) -> str:
    return _DOT.sub(".", _AT.sub("@", address))


def verdict(text: str, kind: str, start: int, end: int) -> int | None:
    """1: a rule confirms the candidate, 0: a rule refutes it, None: neither."""
    s, before, after = text[start:end], text[max(0, start - 24):start], text[end:end + 2]
    if kind == "email":
        return 1 if _ADDRESS.fullmatch(_plain(s)) else 0 if _LOOSE.search(s) else None
    if kind == "secret":
        return 1 if _NAMED.search(before) else None
    if kind == "ip":
        if not _QUAD.fullmatch(s) or not all(_octet(p) for p in s.split(".")):
            return 0
        longer = before[-1:] == "." or after[:1] == "." and after[1:].isdigit()
        return None if longer else 1
    digits = _digits(s)
    if before[-1:].isalnum() or before[-1:] == "_" or after[:1].isalnum() or after[:1] == "_":
        return 0
    if kind == "phone":
        if s[0] == "+" and len(digits) >= 8:
            return 1
        return 0 if _OTHER.search(before) or _DATE.match(s) else None
    if not luhn(digits) or s[0] == "+":
        return 0
    groups = [len(g) for g in re.split("[^0-9]+", s) if g]
    if len(digits) == 15:
        return 1 if _AMEX.match(digits) and groups in ([15], [4, 6, 5]) else 0 if _OTHER.search(before) else None
    if len(groups) == 1 or _ISSUED.match(digits) and groups[:4] == [4] * 4 and len(groups) <= 5:
        return 1
    return 0 if _OTHER.search(before) else None


def label(text: str, kind: str, start: int, end: int, base: list[tuple[str, int, int]]) -> int | None:
    """What a fit learns of a candidate: 1 for a base span, 0 for one that
    overlaps base spans of other kinds only, None (left out) for one that
    overlaps its own kind and for what no rule settles. A key is settled by its name."""
    if (kind, start, end) in base:
        return 1
    if met := {k for k, s, e in base if s < end and start < e}:
        return None if kind in met else 0
    found = verdict(text, kind, start, end)
    return int(found or 0) if kind == "secret" else found


def examples(text: str) -> Iterator[tuple[int, int, list[float]]]:
    """(start, label, features) of candidates and base addresses that have a
    label, and of base spans as if written in another way."""
    base = base_spans(text)
    for c in (*candidates(text), *(b for b in base if b[0] == "email")):
        if (y := label(text, *c, base)) is not None:
            yield c[1], y, features(text, *c)
    for kind, s, e in base:
        for y, before, form, after in _rewritten(text, kind, s, e):
            at = s + len(before)
            yield at, y, features(text[:s] + before + form + after + text[e:], kind, at, at + len(form))


def _rewritten(text: str, kind: str, start: int, end: int) -> Iterator[tuple[int, str, str, str]]:
    """(label, text before, span, text after) of what could stand for a base span: a
    phone number without its country code, in the writing that its place in the text
    picks, also as an order's number; an address out of range or with a part too
    many; a date or an amount; a card with a wrong digit; a sentence that only looks like a
    spelt address."""
    s = text[start:end]
    if kind == "phone":
        groups = [m.start() for m in _GROUP.finditer(text, start, end)]
        if len(groups) > 1 and len(d := _digits(text[groups[1]:end])) >= 7:
            written = (f"0{d[:3]} {d[3:6]} {d[6:]}", f"({d[:3]}) {d[3:6]}-{d[6:]}", f"{d[:3]} {d[3:6]} {d[6:]}", f"0{d[:2]} {d[2:4]} {d[4:]}",
                       f"(0{d[:2]}) {d[2:7]}-{d[7:]}", d, f"0{d[:3]} {d[3:]}", f"0{d[:2]}/{d[2:]}")[start % 8].rstrip(" -/")
            yield 1, "", text[groups[1]:end], ""
            yield 1, "", written, ""
            yield 0, ("order ", "invoice no. ", "ref ", "ticket ")[start % 4], written, ""
            yield 0, "", (f"20{d[:2]}-0{1 + int(d[2]) % 9}-1{d[3]}", f"1{d[3]}.0{1 + int(d[2]) % 9}.19{d[:2]}")[start % 2], ""
            yield 0, "", (f"{d[:2]} {d[2:5]} {d[3:6]}", f"19{d[:2]} 20{d[2:4]} 20{d[4:6]}", " ".join(d[:8]), f"{d[:3]}.{d[3:6]}.{d[4:7]}")[start // 2 % 4], ""
    elif kind == "card":
        d = _digits(s)
        wrong = d[:-1] + str((int(d[-1]) + 1 + start % 8) % 10)
        yield 1, "", " ".join(d[i:i + 4] for i in range(0, len(d), 4)), ""
        yield 0, "", " ".join(wrong[i:i + 4] for i in range(0, len(d), 4)), ""
        yield 0, "", wrong, ""
    elif kind == "ip":
        a, b, c, d = s.split(".")
        yield 0, "", f"{a}.{b}.{300 + int(c) % 600}.{d}", ""
        yield 0, "", s, f".{d}"
    elif kind == "email":
        local, domain = s.split("@", 1)
        yield 0, "", f"{local} (at) {domain.split('.')[0]}. Then", ""


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> boosting.Boosted:
    """Trees from the candidates of about ``SAMPLE_DOCS`` documents (by a hash of
    the id), of which about ``SAMPLE_CANDIDATES`` are used."""
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))

    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_cache()
        for batch in slices(batches):
            out: dict[str, list] = {"key": [], "label": [], "features": []}
            for key, text in zip(batch.column("id").to_pylist(), strings(batch, "text"), strict=True):
                for start, y, x in examples(text):
                    out["key"].append(f"{key}:{start}")
                    out["label"].append(y)
                    out["features"].append(x)
            yield pa.RecordBatch.from_arrays([pa.array(out["key"], pa.string()), pa.array(out["label"], pa.int32()),
                                              pa.array(out["features"], pa.list_(pa.float64()))], names=list(out))

    proposed = bounded_share(rows, F.col("id"), SAMPLE_DOCS).mapInArrow(
        propose, "key string, label int, features array<double>").persist()
    try:
        return boosting.fit(bounded_share(proposed, F.col("key"), SAMPLE_CANDIDATES), rounds=30, depth=5)
    finally:
        proposed.unpersist()


def added_spans(text: str, base: list[tuple[str, int, int]], model: boosting.Boosted, threshold: float) -> list[tuple[str, int, int]]:
    """Candidates of at least ``threshold``, the likeliest first (the longest of a
    tie), if they overlap neither a base span nor a better candidate."""
    taken = _disjoint((s, e) for _, s, e in base)
    free = [c for c in candidates(text) if not _meets(taken, c[1], c[2])]
    if not free:
        return []
    out = []
    for _, _, c in sorted((-q, c[1] - c[2], c) for c, q in zip(free, _scores(text, free, model), strict=True) if q >= threshold):
        if not _meets(taken, c[1], c[2]):
            out.append(c)
            insort(taken, c[1:])
    return out


def _scores(text: str, spans: list[tuple[str, int, int]], model: boosting.Boosted) -> list[float]:
    """Probabilities; the features of a few thousand candidates at a time."""
    return [p for i in range(0, len(spans), 4_096)
            for p in model.probability(np.array([features(text, *c) for c in spans[i:i + 4_096]])).tolist()]


def _disjoint(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s < out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _meets(taken: list[tuple[int, int]], start: int, end: int) -> bool:
    """Whether [start, end) overlaps one of the sorted, disjoint spans."""
    k = bisect_left(taken, (end,))
    return k > 0 and taken[k - 1][1] > start


def all_spans(text: str, model: boosting.Boosted, threshold: float) -> tuple[list, list]:
    base = base_spans(text)
    both = [*base, *added_spans(text, base, model, threshold)]
    return base, sorted(both, key=lambda c: (ADDED_KINDS.index(c[0]), c[1], c[2]))


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def find(docs: DataFrame, model: boosting.Boosted, id_col: str = "doc_id", text_col: str = "text",
         *, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: id, n_email, n_ip, n_card, n_phone (base
    spans), base_sha256 and spans (kind:start:end, comma-joined).

    Null and empty texts have no spans; a text of any length is searched whole;
    repeated rows are searched one by one; other columns, whatever their names, are
    ignored; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [all_spans(t, shared.value, threshold) for t in strings(batch, "text")]
            counts = [Counter(k for k, _, _ in base) for base, _ in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(pa.array([c[k] for c in counts], pa.int64()) for k in KINDS),
                 pa.array([_joined(b) for b, _ in found], pa.string()), pa.array([_joined(s) for _, s in found], pa.string())],
                names=["id", *(f"n_{k}" for k in KINDS), "base", "spans"])

    out = rows.mapInArrow(search, f"id {kind}, n_email long, n_ip long, n_card long, n_phone long, base string, spans string")
    return out.select(F.col("id").alias(id_col), *(f"n_{k}" for k in KINDS),
                      F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind in brackets; spans that
    overlap become one, named by the first."""
    out, end = [], 0
    for kind, s, e in sorted(spans, key=lambda c: c[1:]):
        if s >= end:
            out += [text[end:s], f"[{kind.upper()}]"]
        end = max(end, e)
    return "".join([*out, text[end:]])


def redact(docs: DataFrame, model: boosting.Boosted, text_col: str = "text", *, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with personal data in the text replaced; null texts stay null,
    texts without findings, repeated rows and all other columns stay as they are; a
    text of any length is searched whole; an empty table gives an empty result."""
    cols = docs.columns
    inner = docs.toDF(*(f"c{i}" for i in range(len(cols))))
    text = f"c{cols.index(text_col)}"
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_cache()
        for batch in slices(batches):
            out = [t and redacted(t, all_spans(t, shared.value, threshold)[1]) for t in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()) if c == text else batch.column(c)
                                              for c in batch.schema.names], names=batch.schema.names)

    return inner.mapInArrow(replace, inner.schema).toDF(*cols)
