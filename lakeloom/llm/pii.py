"""Personal data in texts, by weak supervision: labelers vote, EM weighs them, a classifier decides.

Fixed patterns find the base spans, which always stay. Looser patterns find further candidates: addresses with written-out
marks, numbers without a country code, other separators. Five labelers vote yes, no or nothing on every
candidate: the pattern, the format, a gazetteer, the words before it, its neighbours. Expectation-maximisation estimates how
reliable each labeler is for each kind, without labels, and gives every candidate a probability. From
those a logistic classifier of the span's votes and shape is trained, and it decides which loose candidates are added.

A candidate is described by one small code, so Spark counts equal descriptions over the whole corpus and the driver
fits on the counts: at most ``3**5 * 2**8`` for each kind, whatever the number of documents.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import materialize, sigmoid, text_slices

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("pattern", "format", "gazetteer", "context", "neighbours")
NO, NOTHING, YES = 0, 1, 2
SHAPE_BITS = 8

# The patterns of base spans, possessive so that they stay linear, and the looser ones.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
AT_MARK = re.compile(r" ?[(\[{] ?(?:at|AT|At) ?[)\]}] ?| (?:at|AT) |＠")
LOOSE_DOMAIN = re.compile(
    r"[A-Za-z0-9-]{1,63}+(?:(?:\.| ?[(\[{] ?(?:dot|DOT|Dot|\.) ?[)\]}] ?| (?:dot|DOT) )[A-Za-z0-9-]{1,63}+){1,8}+"
)
LOOSE_IP = re.compile(
    r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])"
    r"|(?<![0-9A-Za-z.])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|\[dot\]|\(dot\))[0-9]{1,3}){3}(?![0-9A-Za-z])"
)
LOOSE_CARD = re.compile(r"(?<![0-9])[0-9]{4}(?:[  ._/-]{1,2}[0-9]{4,6}){2,3}(?:[  ._/-]{1,2}[0-9]{1,5})?(?![0-9])")
LOOSE_PHONE = re.compile(
    r"(?<![\w.+-])(?:00[1-9](?:[ ()./-]{0,2}[0-9]){7,14}|(?:\+[0-9]{1,3}[ .-]?)?\(?0?[0-9]{2,4}\)?[ ./-]{1,2}[0-9]{3,4}[ ./-][0-9]{3,5})(?![\w-])"
)

# The gazetteers.
TOP_LEVELS = frozenset(
    "at au be biz br ca ch cn com cz de dk edu es eu fi fr gov gr hu ie in info int io it jp kr mil mx net nl no nz org pl pt ru se sk tr tw uk us za".split()
)
CALLING_CODES = tuple(
    "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98 "
    "212 213 216 218 220 234 254 255 256 351 352 353 354 355 356 357 358 359 370 371 372 380 381 385 386 420 421 852 886 961 962 965 966 971 972".split()
)
CARD_PREFIXES = re.compile(r"4|5[1-5]|2[2-7]|3[47]|3[068]|6011|65|64[4-9]|62|35")
RESERVED = re.compile(r"0\.|10\.|127\.|169\.254\.|172\.(?:1[6-9]|2[0-9]|3[01])\.|192\.168\.|2[2-5][0-9]\.")

# Words before a span that speak for a kind, and words that speak against any.
FOR = {
    "email": re.compile(r"\b(?:e-?mails?|mail|contact|write|reach|courriel|correo|kontakt)\b"),
    "ip": re.compile(r"\b(?:ip|ipv[46]|host|server|address|adresse|login|from)\b"),
    "card": re.compile(r"\b(?:card|cards|credit|debit|visa|mastercard|amex|carte|karte|tarjeta|paid|payment)\b"),
    "phone": re.compile(r"\b(?:phone|tel|telephone|telefon|téléphone|teléfono|call|mobile|cell|fax|handy|whatsapp)\b"),
}
AGAINST = re.compile(r"\b(?:version|ver|isbn|issn|order|invoice|token|password|secret|key|hash|sha|md5|license|chapter|section|figure|page|doi)\b")
CONTEXT = 40

CANDIDATE = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("code", pa.int32())])
CANDIDATES = "array<struct<kind:int,start:long,end:long,base:boolean,code:int>>"
SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("probability", pa.float64())])
SPANS = "array<struct<kind:string,start:long,end:long,base:boolean,probability:double>>"


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    doubled = (sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])
    return (sum(map(int, digits[::-2])) + sum(doubled)) % 10 == 0


def base_emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, read outwards from each ``@``: linear also in long unspaced texts."""
    spans, done = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at + 1) if start < at else None
        if match:
            done = match.end()
            spans.append((start, done))
        at = text.find("@", max(at + 1, done))
    return spans


def base_ips(text: str) -> list[tuple[int, int]]:
    spans = (match.span() for match in IP.finditer(text))
    return [(a, b) for a, b in spans if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in text[a:b].split("."))]


def base_cards(text: str) -> list[tuple[int, int]]:
    found = ((match.span(), digits_of(match.group())) for match in CARD.finditer(text) if match.end() - match.start() >= 13)
    return [span for span, digits in found if 13 <= len(digits) <= 19 and luhn(digits)]


def base_phones(text: str) -> list[tuple[int, int]]:
    found = ((match.span(), len(digits_of(match.group()))) for match in PHONE.finditer(text))
    return [span for span, n in found if 9 <= n <= 15]


def loose_emails(text: str) -> list[tuple[int, int]]:
    spans = []
    for mark in AT_MARK.finditer(text):
        start = mark.start()
        while start > max(0, mark.start() - 64) and text[start - 1] in LOCAL:
            start -= 1
        match = LOOSE_DOMAIN.match(text, mark.end()) if start < mark.start() else None
        if match:
            spans.append((start, match.end()))
    return spans


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base spans, by kind, then start."""
    finders = (base_emails, base_ips, base_cards, base_phones)
    return [(kind, a, b) for kind, find in enumerate(finders) for a, b in find(text)]


def loose_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of looser candidates, without those that touch a base span or one before them."""
    found = [(0, a, b) for a, b in loose_emails(text)]
    for kind, pattern in ((1, LOOSE_IP), (2, LOOSE_CARD), (2, CARD), (3, LOOSE_PHONE)):
        found += [(kind, *match.span()) for match in pattern.finditer(text) if match.end() - match.start() >= 7]
    return [(kind, a, b) for kind, a, b in found if kind != 2 or 13 <= len(digits_of(text[a:b])) <= 19]


def candidates(text: str) -> list[tuple[int, int, int, bool]]:
    """(kind, start, end, base): all base spans, then those loose ones that overlap no other kept before them."""
    has_digit = any(c in text for c in "0123456789")
    base = base_spans(text) if has_digit or "@" in text else []
    loose = loose_spans(text) if has_digit or base else [(0, a, b) for a, b in loose_emails(text)]
    taken = sorted((a, b) for _, a, b in base)
    out = [(kind, a, b, True) for kind, a, b in base]
    if not loose:
        return out
    # Base spans of different kinds may overlap, so the furthest end so far counts.
    starts = np.array([a for a, _ in taken], np.int64)
    ends = np.maximum.accumulate(np.array([b for _, b in taken], np.int64)) if taken else starts
    reach = 0
    for kind, a, b in sorted(loose, key=lambda span: (span[1], -span[2], span[0])):
        at = int(np.searchsorted(starts, b))
        if a >= reach and (at == 0 or ends[at - 1] <= a):
            out.append((kind, a, b, False))
            reach = b
    return out


def _normal(kind: int, span: str) -> str:
    """The span with written-out marks as plain ones."""
    if kind == 0:
        span = AT_MARK.sub("@", span, count=1) if "@" not in span else span
    if kind <= 1:
        span = re.sub(r" ?[(\[{] ?(?:dot|DOT|Dot|\.) ?[)\]}] ?| (?:dot|DOT) ", ".", span)
    return span


def votes(text: str, kind: int, start: int, end: int, base: bool) -> tuple[int, ...]:
    """NO, NOTHING or YES of each labeler."""
    span = _normal(kind, text[start:end])
    digits = digits_of(span)
    before = text[max(0, start - CONTEXT) : start].lower()
    if kind == 0:
        name, _, domain = span.rpartition("@")
        labels = domain.split(".")
        fine = all(label and label[0] != "-" and label[-1] != "-" for label in labels) and labels[-1].isalpha() and name[0] != "."
        known = YES if labels[-1].lower() in TOP_LEVELS else NO
    elif kind == 1:
        fine = ":" in span or all(len(part) <= 3 and part == str(int(part)) for part in span.split(".") if part.isdigit())
        known = NOTHING if ":" in span else NO if RESERVED.match(span) else YES
    elif kind == 2:
        fine = luhn(digits)
        known = YES if CARD_PREFIXES.match(digits) and len(digits) in (14, 15, 16, 19) else NO
    else:
        fine = 9 <= len(digits) <= 15 and len(set(digits)) > 2
        code = digits if span[0] == "+" else digits[2:] if digits.startswith("00") else ""
        known = NOTHING if not code else YES if code.startswith(CALLING_CODES) else NO
    context = NO if AGAINST.search(before) else YES if FOR[KINDS[kind]].search(before) else NOTHING
    left, right = text[start - 1 : start], text[end : end + 1]
    joined = (left.isalnum() or left in ("_", "=", "/", "#", "-", ".")) if left else False
    joined |= (right.isalnum() or right in ("_", "=", "/", "@", "-")) if right else False
    # "at" between words with a plain dot after it is mostly a sentence.
    prose = kind == 0 and not base and not re.search(r"[(\[{＠]| dot ", text[start:end])
    pattern = YES if base else NO if prose else NOTHING
    return pattern, YES if fine else NO, known, context, NO if joined else YES


def shape(text: str, kind: int, start: int, end: int) -> int:
    """Eight bits on how the span is written."""
    span = text[start:end]
    digits = len(digits_of(span))
    left = text[start - 1 : start]
    bits = (
        any(c in "([{" for c in span),
        " " in span,
        "." in span,
        "-" in span,
        span[0] in "+(0",
        digits >= (15 if kind == 2 else 10 if kind == 3 else 1),
        len(span) > (30 if kind == 0 else 20),
        left in ("", " ", "\n", "\t", ":", "<"),
    )
    return sum(bit << i for i, bit in enumerate(map(bool, bits)))


def code_of(given: tuple[int, ...], bits: int) -> int:
    """Votes and shape in one number."""
    value = 0
    for vote in given:
        value = 3 * value + vote
    return value << SHAPE_BITS | bits


def votes_of(codes: np.ndarray) -> np.ndarray:
    """The votes in each code, a column per labeler."""
    rest, columns = codes >> SHAPE_BITS, []
    for _ in LABELERS:
        columns.append(rest % 3)
        rest = rest // 3
    return np.array(columns[::-1]).T.reshape(len(codes), len(LABELERS))


def inputs_of(codes: np.ndarray) -> np.ndarray:
    """Inputs of the classifier: a constant, yes and no of each labeler, the bits of the shape."""
    given = votes_of(codes)
    bits = (codes[:, None] >> np.arange(SHAPE_BITS)) & 1
    return np.column_stack([np.ones(len(codes)), given == YES, given == NO, bits]).astype(np.float64)


def expect_maximise(given: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray, float]:
    """(probability of each row, reliabilities, share) of rows of votes that occur ``counts`` times.

    ``reliabilities[c, labeler, vote]`` is the probability of a vote given the class. A weak prior says that yes
    is likelier for personal data and no for the rest, so the classes cannot swap.
    """
    prior = np.array([[4.0, 2.0, 2.0], [2.0, 2.0, 4.0]])
    one_hot = (given[:, :, None] == np.arange(3)).astype(np.float64)
    yes, no = (given == YES).sum(axis=1), (given == NO).sum(axis=1)
    chance = sigmoid(1.5 * (yes - no))
    for _ in range(rounds):
        weights = np.stack([(1 - chance) * counts, chance * counts])
        tables = np.einsum("cr,rlv->clv", weights, one_hot) + prior[:, None, :]
        tables /= tables.sum(axis=2, keepdims=True)
        share = (weights[1].sum() + 1) / (counts.sum() + 2)
        odds = np.log(share / (1 - share)) + (one_hot * np.log(tables[1] / tables[0])).sum(axis=(1, 2))
        fresh = sigmoid(odds)
        settled = len(fresh) == 0 or np.abs(fresh - chance).max() < 1e-9
        chance = fresh
        if settled:
            break
    return chance, tables, float(share)


def fit_logistic(inputs: np.ndarray, targets: np.ndarray, counts: np.ndarray, ridge: float = 0.1, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic classifier for soft targets, by Newton's method with a ridge."""
    weights = np.zeros(inputs.shape[1])
    for _ in range(rounds):
        chance = sigmoid(inputs @ weights)
        slope = inputs.T @ (counts * (chance - targets)) + ridge * weights
        curve = (inputs * (counts * chance * (1 - chance))[:, None]).T @ inputs + ridge * np.eye(len(weights))
        step = np.linalg.solve(curve, slope)
        # A bounded step keeps far starts from overshooting.
        weights -= step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return weights


@dataclass(frozen=True)
class SpanModel:
    """By kind: weights of the classifier, and the labelers' reliabilities that trained it."""

    weights: np.ndarray
    reliabilities: np.ndarray


def candidates_udf() -> Callable[[Column], Column]:
    """Column function from a text to its candidates; a null text has none."""

    def scan(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            rows = []
            for _, _, texts in text_slices(part):
                for text in texts.to_pylist():
                    rows.append(
                        [
                            {"kind": kind, "start": a, "end": b, "base": base, "code": code_of(votes(text, kind, a, b, base), shape(text, kind, a, b))}
                            for kind, a, b, base in candidates(text)
                        ]
                        if text
                        else []
                    )
            yield pa.array(rows, pa.list_(CANDIDATE))

    return F.arrow_udf(scan, CANDIDATES)


def train(found: DataFrame) -> SpanModel:
    """Model of the written candidates (column ``found``) of a corpus; all of them count."""
    codes = found.select(F.explode("found").alias("c")).groupBy("c.kind", "c.code").agg(F.count("*").alias("n"))
    # One row for each description of a candidate: 4 * 3**5 * 2**8 at most.
    table = codes.orderBy("kind", "code").toArrow()
    kind, code, n = (table[name].to_numpy() for name in ("kind", "code", "n"))
    weights, reliabilities = [], []
    for i in range(len(KINDS)):
        own, times = code[kind == i].astype(np.int64), n[kind == i].astype(np.float64)
        chance, tables, _ = expect_maximise(votes_of(own), times)
        weights.append(fit_logistic(inputs_of(own), chance, times))
        reliabilities.append(tables)
    return SpanModel(np.array(weights), np.array(reliabilities))


def spans_udf(model: SpanModel, threshold: float) -> Callable[[Column], Column]:
    """Column function from candidates to the spans kept: base ones, and those from the threshold on."""
    weights = model.weights

    def decide(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            rows = []
            for listed in part.to_pylist():
                codes = np.array([c["code"] for c in listed], np.int64)
                kinds = np.array([c["kind"] for c in listed], np.int64)
                chance = sigmoid((inputs_of(codes) * weights[kinds]).sum(axis=1)) if listed else ()
                kept = [
                    {"kind": c["kind"], "start": c["start"], "end": c["end"], "base": c["base"], "probability": float(p)}
                    for c, p in zip(listed, chance, strict=True)
                    if c["base"] or p >= threshold
                ]
                kept.sort(key=lambda span: (span["kind"], span["start"]))
                rows.append([span | {"kind": KINDS[span["kind"]]} for span in kept])
            yield pa.array(rows, pa.list_(SPAN))

    return F.arrow_udf(decide, SPANS)


def find_personal_data(
    docs: DataFrame, threshold: float = 0.9, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(doc_id, spans) for every row of ``docs``: array of (kind, start, end, base, probability) by kind, then start.

    Places are code points of the text, ends exclusive. Base spans are all there; others are there from a
    probability of ``threshold`` on and overlap no base span. Texts are scanned once; candidates are written to the
    scratch folder and the model is learned from all of them. Rows with equal or null ids each get a row and count in
    the model; a null or empty text has no spans; an empty table gives no rows. Other columns are not read.
    """
    scanned = docs.select(F.col(id_column).cast("long").alias("doc_id"), candidates_udf()(F.col(text_column)).alias("found"))
    scanned = materialize(scanned, "pii-candidates")
    model = train(scanned.select("found"))
    return scanned.select("doc_id", spans_udf(model, threshold)(F.col("found")).alias("spans"))
