"""Personal data by weak supervision: labelers vote on spans, EM weighs them, a span classifier decides."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, write_through

#: Kinds in the order in which spans are listed.
KINDS = ("email", "ip", "card", "phone")

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of what the fixed patterns find, sorted; ``kind`` is a place in KINDS."""
    found = []
    last = 0
    for match in _DOMAIN.finditer(text):
        # The local part is what directly precedes the sign, back to the last address.
        before = text[last : match.start()] if match.start() - last < 256 else text[match.start() - 256 : match.start()]
        local = len(before) - len(before.rstrip(_LOCAL))
        if local == 256:
            before = text[last : match.start()]
            local = len(before) - len(before.rstrip(_LOCAL))
        if local:
            found.append((match.start() - local, 0, match.end()))
            last = match.end()
    for match in _IP.finditer(text):
        parts = [part.lstrip("0") or "0" for part in match.group().split(".")]
        if all(len(part) <= 3 and int(part) <= 255 for part in parts):
            found.append((match.start(), 1, match.end()))
    for match in _CARD.finditer(text):
        if match.end() - match.start() >= 14:
            digits = _NOT_DIGIT.sub("", match.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((match.start(), 2, match.end()))
    for match in _PHONE.finditer(text):
        if 10 <= len(_NOT_DIGIT.sub("", match.group())) <= 15:
            found.append((match.start(), 3, match.end()))
    return sorted(found)


# ------------------------------------------------------------- candidates and labelers

#: Wider patterns: what might be personal data of a kind beyond the fixed patterns.
_WIDER = (
    re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}\x20?(?:\[at\]|\(at\)|\x20at\x20)\x20?[A-Za-z0-9-]{1,63}(?:\x20?(?:\[dot\]|\(dot\)|\x20dot\x20|\.)\x20?[A-Za-z0-9-]{2,63}){1,4}"),
    re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"),
    re.compile(r"(?<![0-9.-])[0-9]{4}(?:[./][0-9]{4}){2}[./][0-9]{2,7}(?![0-9.-])"),
    re.compile(r"(?<![0-9+().-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.\x20-])[0-9]{3}[.\x20-][0-9]{4}(?![0-9.-])"),
)
_HINT = (re.compile(r"[\[(]at[\])]|\x20at\x20"), re.compile(r":[0-9A-Fa-f]{1,4}:"), re.compile(r"[0-9][./][0-9]"), re.compile(r"[0-9][.\x20-][0-9]{4}"))

#: Gazetteers (top-level domains, private and documentation networks, issuer digits, area codes' first digits).
_TOP_LEVEL = frozenset("com org net edu gov info io de fr es uk eu it nl ch at be pl us ca".split())
_ISSUERS = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65", "35", "36")
#: Words that announce a kind.
_CONTEXT = (
    frozenset("email e-mail mail write contact correo courriel".split()),
    frozenset("ip address host server login adresse".split()),
    frozenset("card visa mastercard amex credit debit payment karte tarjeta carte".split()),
    frozenset("phone tel telephone call mobile cell fax telefon teléfono téléphone".split()),
)
_AGAINST = frozenset("version isbn issn order invoice ref figure table section total no".split())
_WORDS = re.compile(r"[^\W\d_][\w-]*")
#: Votes: -1 against, 0 abstains, 1 for.
LABELERS = ("pattern", "gazetteer", "context", "shape")
FEATURES = ("strict", "listed", "announced", "denied", "bounded", "long", "mixed")


@dataclass(frozen=True)
class Candidate:
    start: int
    end: int
    kind: int
    base: bool
    votes: tuple[int, ...]
    features: tuple[int, ...]


def candidates(text: str) -> list[Candidate]:
    """Base spans, and wider ones that do not overlap them, with the labelers' votes and the classifier's features."""
    base = base_spans(text)
    spans = [(start, end, kind, True) for start, kind, end in base]
    taken = np.array([(start, end) for start, _, end in base], np.int64).reshape(-1, 2)
    for kind, wider in enumerate(_WIDER):
        if _HINT[kind].search(text):
            for match in wider.finditer(text):
                if not ((taken[:, 0] < match.end()) & (taken[:, 1] > match.start())).any():
                    spans.append((match.start(), match.end(), kind, False))
    return [_judged(text, *span) for span in sorted(spans)]


def _judged(text: str, start: int, end: int, kind: int, base: bool) -> Candidate:
    span = text[start:end]
    digits = _NOT_DIGIT.sub("", span)
    around = {w.lower() for w in _WORDS.findall(text[max(0, start - 48) : start])[-5:]}
    around |= {w.lower() for w in _WORDS.findall(text[end : end + 24])[:2]}
    if kind == 0:
        strict, listed = "@" in span or "[" in span or "(" in span, re.split(r"[^A-Za-z]+", span.lower())[-1] in _TOP_LEVEL
        shape = 1 if 6 <= len(span) <= 80 else -1
    elif kind == 1:
        strict, listed = True, ":" in span or not span.startswith(("0.", "127.", "255."))
        shape = 1 if ":" in span or len(span) >= 9 else 0
    elif kind == 2:
        strict, listed = 14 <= len(digits) <= 19 and luhn(digits), digits.startswith(_ISSUERS)
        shape = 1 if 14 <= len(digits) <= 16 else -1
    else:
        strict = span.startswith("+") or "(" in span
        national = digits[-10:]
        listed = len(national) == 10 and national[0] not in "01"
        shape = 1 if 10 <= len(digits) <= 15 else -1
    announced, denied = bool(around & _CONTEXT[kind]), bool(around & _AGAINST)
    edge = not (text[start - 1 : start].isalnum() or text[end : end + 1].isalnum())
    votes = (1 if strict else -1, 1 if listed else -1, 1 if announced else -1 if denied else 0, shape)
    features = (strict, listed, announced, denied, edge, len(span) >= 16, len({c for c in span if not c.isalnum()}) > 1)
    return Candidate(start, end, kind, base, votes, tuple(int(f) for f in features))


# ------------------------------------------------------------- reliabilities and classifier


def expectation_maximisation(votes: np.ndarray, counts: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Probability that each vote pattern is personal data, and each labeler's P(vote | class).

    ``votes`` has a row per different pattern with -1, 0, 1 and ``counts`` says
    how often it occurs, so the sums are over all candidates. Starts from the
    share of votes for, and keeps a weak prior that labelers are right.
    """
    prior = np.array([[2.0, 1.0, 1.0], [1.0, 1.0, 2.0]])  # class, vote -1 0 1
    cast = np.abs(votes).sum(axis=1)
    belief = np.where(cast > 0, (votes == 1).sum(axis=1) / np.maximum(cast, 1), 0.5)
    for _ in range(rounds):
        weight = np.stack([(1 - belief) * counts, belief * counts])
        share = (weight.sum(axis=1) + 1.0) / (weight.sum() + 2.0)
        table = np.stack([prior.copy() for _ in range(votes.shape[1])])
        for j in range(votes.shape[1]):
            for v in (-1, 0, 1):
                table[j, :, v + 1] += weight[:, votes[:, j] == v].sum(axis=1)
        table /= table.sum(axis=2, keepdims=True)
        score = np.log(share)[:, None] + sum(np.log(table[j][:, votes[:, j] + 1]) for j in range(votes.shape[1]))
        belief = 1.0 / (1.0 + np.exp(np.clip(score[0] - score[1], -500, 500)))
    return belief, table


def fit_classifier(features: np.ndarray, belief: np.ndarray, counts: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Weights of a logistic regression with soft labels, by Newton's steps with a ridge of 1; the last is the intercept."""
    x = np.column_stack([features, np.ones(len(features))]).astype(float)
    weights = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (counts * (belief - p)) - weights
        curve = (x * (counts * p * (1 - p))[:, None]).T @ x + np.eye(x.shape[1])
        step = np.linalg.solve(curve, slope)
        weights += step
        if np.abs(step).max() < 1e-9:
            break
    return weights


def train_spans(found: DataFrame) -> dict[int, np.ndarray]:
    """Classifier weights by kind, from ``spans`` of all documents.

    Only counts of different vote and feature patterns come to the driver, at
    most 81 x 128 a kind.
    """
    rows = found.select(F.explode("spans").alias("s")).groupBy("s.kind", "s.votes", "s.features")
    rows = rows.agg(F.count("*").alias("n")).orderBy("kind", "votes", "features").collect()
    out = {}
    for kind in range(len(KINDS)):
        own = [r for r in rows if r["kind"] == kind]
        if not own:
            continue
        votes, features = np.array([r["votes"] for r in own]), np.array([r["features"] for r in own])
        counts = np.array([r["n"] for r in own], float)
        belief, _ = expectation_maximisation(votes, counts)
        out[kind] = fit_classifier(features, belief, counts)
    return out


def accepted(span, weights: dict[int, np.ndarray], least: float = 0.5) -> bool:
    """Base spans stay; of the others those stay that the classifier gives at least ``least``."""
    if span["base"]:
        return True
    own = weights.get(span["kind"])
    if own is None:
        return False
    value = float(np.dot(own[:-1], np.array(span["features"], float)) + own[-1])
    return 1.0 / (1.0 + np.exp(-np.clip(value, -500, 500))) >= least


_SPANS = "array<struct<start:bigint,`end`:bigint,kind:int,base:boolean,votes:array<int>,features:array<int>>>"


def _candidate_lists(texts: pd.Series) -> pd.Series:
    return pd.Series([
        [
            {"start": c.start, "end": c.end, "kind": c.kind, "base": c.base, "votes": list(c.votes), "features": list(c.features)}
            for c in (candidates(t) if t else ())
        ]
        for t in texts
    ])


def find_candidates(text: str) -> Column:
    return F.pandas_udf(_candidate_lists, _SPANS)(text)


def _joined(spans) -> str:
    ordered = sorted((s["start"], s["kind"], s["end"]) for s in spans)
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in ordered)


def find_personal_data(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added`` per row of ``docs (doc_id, text)``.

    Counts and digest are of the fixed patterns; ``spans`` are those and the
    ones that the trained classifier adds, as ``kind:start:end`` in code points,
    end exclusive. Candidates of every document, without their texts, are
    written to the shared folder once; training and result read them.

    Null and empty texts have no spans. Null ids and repeated rows are documents
    like any other. Without candidates of a kind nothing of it is added. An
    empty table gives an empty one.
    """
    found = write_through(docs.select("doc_id", find_candidates("text").alias("spans")), "spans")
    weights = train_spans(found)

    @F.pandas_udf("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")
    def report(column: pd.Series) -> pd.DataFrame:
        rows = []
        for spans in column:
            base = [s for s in spans if s["base"]]
            kept = [s for s in spans if accepted(s, weights, least)]
            counts = [sum(s["kind"] == kind for s in base) for kind in range(len(KINDS))]
            digest = hashlib.sha256(_joined(base).encode()).hexdigest()
            rows.append((*counts, digest, _joined(kept), len(kept) - len(base)))
        names = ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"]
        return pd.DataFrame(rows, columns=names)

    return found.select("doc_id", report("spans").alias("r")).select("doc_id", "r.*")


def redacted(text: str, weights: dict[int, np.ndarray], least: float = 0.5) -> str:
    """The text with each accepted span replaced by its kind in brackets; of overlapping spans the first stands."""
    out, last = [], 0
    for c in candidates(text):
        span = {"base": c.base, "kind": c.kind, "features": c.features}
        if accepted(span, weights, least):
            if c.start >= last:
                out += [text[last : c.start], f"[{KINDS[c.kind].upper()}]"]
            last = max(last, c.end)
    return "".join([*out, text[last:]])


def redact(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced; every row and column stays.

    ``n_chars``, where it is there, is set to the new length. Trains on all
    documents first; texts are not moved between tasks. Candidates are written
    to the shared folder for that: Spark would find those of a column that it
    explodes twice, in two workers a task.
    """
    found = write_through(docs.select(find_candidates("text").alias("spans")), "spans")
    weights = train_spans(found)
    discard(found)

    def replace(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([redacted(t, weights, least) if t else t for t in texts], dtype=object)

    out = docs.withColumn("text", F.pandas_udf(replace, "string")("text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text")).cast(docs.schema["n_chars"].dataType))
    return out
