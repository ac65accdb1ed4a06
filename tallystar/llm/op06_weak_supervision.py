"""Personal data by weak supervision.

1. Candidates: wide patterns (addresses, numbers of several shapes, keys behind words such as "password", names
   behind titles) and the base patterns of the contract.
2. Labelers vote on every candidate: patterns, checksums, a gazetteer and words in the context say yes, no or
   nothing.
3. Candidates are counted by kind, votes and features, over all documents. Expectation-maximisation on those
   counts estimates how reliable each labeler is and how likely each vote pattern is personal data; a logistic
   classifier of the spans' features is then trained on these probabilities.
4. Every base span stays; other candidates are added where the classifier says yes.

The driver sees one row per kind, vote pattern and feature pattern, whose number is bounded by the number of
labelers and features. Defined cases: a null or empty text has no spans. Of overlapping added spans of one kind
the leftmost stays. Repeated rows are scanned each; extra columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.llm.common import ids, map_batches, table, text_bytes

# Fixed values of the result contract: the base kinds in their order.
BASE_KINDS = ["email", "ip", "card", "phone"]
KINDS = [*BASE_KINDS, "secret", "name", "national_id", "iban"]

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# No start within a run of figures: where the first figure of a run does not match, later ones do not either.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
# Shorter runs would be dropped, and a run is always taken from its first figure.
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9]){11,}")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Candidates beyond the base.
LOCAL_PHONE = re.compile(r"(?<![0-9+(])(?:\([0-9]{2,4}\)\x20?|[0-9]{2,4}[-.\x20])[0-9]{3,4}[-.\x20][0-9]{3,4}(?![0-9])")
NATIONAL = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
IBAN = re.compile(r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?\b")
ASSIGNED = re.compile(r"\b(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)\b\s{0,3}[=:]\s{0,3}[\"']?([^\s\"',;]{6,200})", re.I)
KEY_SHAPES = re.compile(r"\b(?:AKIA[0-9A-Z]{16}|ghp_[0-9A-Za-z]{36}|sk-[0-9A-Za-z]{20,60})\b")
LONG_CODE = re.compile(r"(?<![0-9A-Za-z])(?=[0-9A-Za-z]{0,40}[0-9])(?=[0-9A-Za-z]{0,40}[A-Za-z])[0-9A-Za-z]{16,80}(?![0-9A-Za-z])")
TITLED = re.compile(r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sr|Sra)\.?\x20([A-Z][a-z]{1,20}(?:\x20[A-Z][a-z]{1,20})?)")
GIVEN_FAMILY = re.compile(r"\b([A-Z][a-z]{1,20})\x20([A-Z][a-z]{1,20})\b")

# A gazetteer of frequent given names, and words that announce kinds of data.
GIVEN_NAMES = frozenset(
    "James Mary Robert Patricia John Jennifer Michael Linda David Elizabeth William Barbara Richard Susan Joseph "
    "Jessica Thomas Sarah Charles Karen Daniel Lisa Matthew Nancy Anthony Sandra Mark Ashley Paul Emily Steven Donna "
    "Andrew Michelle George Laura Peter Anna Hans Ursula Klaus Monika Wolfgang Petra Stefan Sabine Jean Marie Pierre "
    "Isabelle Philippe Nathalie Michel Sophie Carlos Carmen Antonio Pilar Manuel Dolores Javier Lucia".split()
)
CONTEXT = {
    "email": re.compile(r"mail|contact|write to|courriel|correo", re.I),
    "ip": re.compile(r"\bip\b|address|host|server|login|from", re.I),
    "card": re.compile(r"card|visa|master|credit|karte|carte|tarjeta", re.I),
    "phone": re.compile(r"phone|tel|call|mobile|fax|anruf", re.I),
    "secret": re.compile(r"password|passwd|pwd|secret|token|key", re.I),
    "name": re.compile(r"\b(?:mr|mrs|ms|dr|prof|herr|frau|mme|sra?|name|dear|by)\b", re.I),
    "national_id": re.compile(r"ssn|social|security|national|\bid\b", re.I),
    "iban": re.compile(r"iban|account|bank|konto|compte|cuenta", re.I),
}
NEAR = 40  # characters of context looked at

LABELERS = ["pattern", "checksum", "context", "gazetteer", "shape"]
FEATURES = ["base", "checked", "announced", "mixed", "long", "separated", "repeated", "bounded"]
ROUNDS = 30
ACCEPT = 0.5

SCHEMA = "doc_id long, " + ", ".join(f"n_{k} long" for k in BASE_KINDS) + ", base_sha256 string, spans string"
ARROW = pa.schema(
    [("doc_id", pa.int64())] + [(f"n_{k}", pa.int64()) for k in BASE_KINDS] + [("base_sha256", pa.string()), ("spans", pa.string())]
)

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> list[Span]:
    """Around every @: the run of local characters before it and the domain behind it. Linear in the text."""
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        domain = DOMAIN.match(text, at + 1)
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if domain and start < at:
            found.append(("email", start, domain.end()))
            done = domain.end()
        at = text.find("@", max(at + 1, done))
    return found


def base_spans(text: str) -> list[Span]:
    """The contract's spans, by kind."""
    found = emails(text) if "@" in text else []
    if FIGURE.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
                found.append(("ip", *m.span()))
        for m in CARD.finditer(text):
            digits = digits_of(m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= len(digits_of(m[0])) <= 15:
                    found.append(("phone", *m.span()))
    return found


FIGURE = re.compile(r"[0-9]")


def wide_spans(text: str) -> list[Span]:
    """Candidates of all kinds that the base does not have to hold."""
    found: list[Span] = []
    if FIGURE.search(text):
        found += [("phone", *m.span()) for m in LOCAL_PHONE.finditer(text)]
        found += [("national_id", *m.span()) for m in NATIONAL.finditer(text)]
        found += [("iban", *m.span()) for m in IBAN.finditer(text)]
        found += [("card", *m.span()) for m in CARD.finditer(text)]
        found += [("ip", *m.span()) for m in IP.finditer(text)]
        found += [("secret", *m.span()) for m in KEY_SHAPES.finditer(text)]
        found += [("secret", *m.span()) for m in LONG_CODE.finditer(text)]
    if "=" in text or ":" in text:
        found += [("secret", *m.span(1)) for m in ASSIGNED.finditer(text)]
    found += [("name", *m.span(1)) for m in TITLED.finditer(text)]
    found += [("name", *m.span()) for m in GIVEN_FAMILY.finditer(text) if m[1] in GIVEN_NAMES]
    return found


def iban_checks(text: str) -> bool:
    compact = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in compact[4:] + compact[:4])) % 97 == 1


def votes_and_features(text: str, span: Span, is_base: bool) -> tuple[int, int]:
    """Votes in base 3 (0 nothing, 1 no, 2 yes), one figure per labeler; features as bits."""
    kind, start, end = span
    own = text[start:end]
    before = text[max(0, start - NEAR) : start]
    digits = digits_of(own)
    announced = bool(CONTEXT[kind].search(before))
    mixed = any(c.islower() for c in own) + any(c.isupper() for c in own) + bool(digits) >= 2
    bounded = not (text[start - 1 : start].isalnum() or text[end : end + 1].isalnum())
    same = len(set(digits)) <= 2 and len(digits) > 4

    pattern = 2 if is_base or kind in ("national_id", "secret") and KEY_SHAPES.fullmatch(own) else 0
    checked = 0
    if kind == "card":
        checked = 2 if 12 <= len(digits) <= 19 and luhn(digits) else 1
    elif kind == "ip":
        checked = 2 if all(len(p) <= 3 and int(p) <= 255 for p in own.split(".")) else 1
    elif kind == "iban":
        checked = 2 if iban_checks(own) else 1
    elif kind == "phone":
        checked = 2 if 9 <= len(digits) <= 15 else 1 if len(digits) < 7 else 0
    elif kind == "national_id":
        checked = 1 if own[:3] in ("000", "666") or own[0] == "9" or own[4:6] == "00" or own[7:] == "0000" else 2
    known = 0
    if kind == "name":
        known = 2 if own.split(" ")[0] in GIVEN_NAMES else 1
    shape = 2 if kind == "secret" and mixed and len(own) >= 16 else 1 if same or not bounded else 0
    votes = 0
    for vote in (pattern, checked, 2 if announced else 0, known, shape):
        votes = votes * 3 + vote
    flags = (is_base, checked == 2, announced, mixed, len(own) >= 12, any(c in " -.()" for c in own), same, bounded)
    return votes, sum(1 << i for i, f in enumerate(flags) if f)


def candidates(text: str) -> list[tuple[Span, bool, int, int]]:
    """(span, is base, votes, features); wide candidates that overlap a base span are left to it."""
    base = base_spans(text)
    found = [(span, True, *votes_and_features(text, span, True)) for span in base]
    taken: dict[str, int] = {}
    order = sorted(set(wide_spans(text)), key=lambda s: (s[1], -s[2], KINDS.index(s[0])))
    edges: list[tuple[int, int]] = []  # what base spans cover, without overlaps
    for _, start, end in sorted(base, key=lambda s: s[1:]):
        if edges and start < edges[-1][1]:
            edges[-1] = (edges[-1][0], max(end, edges[-1][1]))
        else:
            edges.append((start, end))
    at = 0
    for span in order:
        kind, start, end = span
        while at < len(edges) and edges[at][1] <= start:
            at += 1
        if (at < len(edges) and edges[at][0] < end) or start < taken.get(kind, 0):
            continue
        taken[kind] = end
        found.append((span, False, *votes_and_features(text, span, False)))
    return found


def texts(batch: pa.RecordBatch) -> Iterator[str]:
    for text in text_bytes(batch):
        yield text.decode("utf-8")


def pattern_counts(docs: DataFrame) -> DataFrame:
    """How many candidates have each kind, vote pattern and feature pattern, over all documents."""

    def count(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in iterator:
            for text in texts(batch):
                seen.update((KINDS.index(span[0]), votes, features) for span, _, votes, features in candidates(text))
        rows = list(seen.items())
        columns = [[k[i] for k, _ in rows] for i in range(3)] + [[n for _, n in rows]]
        types = (pa.int32(), pa.int32(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["kind", "votes", "features", "n"])

    counted = map_batches(docs.select("text"), count, "kind int, votes int, features int, n long")
    return counted.groupBy("kind", "votes", "features").agg(F.sum("n").alias("n"))


def unpack_votes(votes: np.ndarray) -> np.ndarray:
    """One column per labeler: 0 nothing, 1 no, 2 yes."""
    return np.stack([votes // 3 ** (len(LABELERS) - 1 - i) % 3 for i in range(len(LABELERS))], axis=1)


def reliabilities(votes: np.ndarray, n: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, float]:
    """EM over vote patterns with counts: (P(vote | class, labeler), P(personal | pattern), prior).

    It starts from the majority of votes; the prior of each reliability is that labelers are right more often
    than not.
    """
    table_ = unpack_votes(votes)
    yes, no = (table_ == 2).sum(axis=1), (table_ == 1).sum(axis=1)
    p = (yes + 1.0) / (yes + no + 2.0)
    right = np.array([[0.5, 0.35, 0.15], [0.5, 0.15, 0.35]]) * 10.0  # prior counts: class x vote
    prior, chance = 0.5, np.zeros((len(LABELERS), 2, 3))
    for _ in range(rounds):
        prior = ((n * p).sum() + 1.0) / (n.sum() + 2.0)
        for labeler in range(len(LABELERS)):
            for vote in range(3):
                has = table_[:, labeler] == vote
                chance[labeler, 0, vote] = (n * (1 - p))[has].sum() + right[0, vote]
                chance[labeler, 1, vote] = (n * p)[has].sum() + right[1, vote]
        chance /= chance.sum(axis=2, keepdims=True)
        log = np.log(np.array([1 - prior, prior]))[None, :].repeat(len(votes), axis=0)
        for labeler in range(len(LABELERS)):
            log += np.log(chance[labeler][:, table_[:, labeler]]).T
        p = 1.0 / (1.0 + np.exp(log[:, 0] - log[:, 1]))
    return chance, p, prior


def unpack_features(kinds: np.ndarray, features: np.ndarray) -> np.ndarray:
    bits = (features[:, None] >> np.arange(len(FEATURES))) & 1
    return np.hstack([np.ones((len(kinds), 1)), bits, np.eye(len(KINDS))[kinds]]).astype(float)


def train_classifier(kinds: np.ndarray, features: np.ndarray, p: np.ndarray, n: np.ndarray, steps: int = 100) -> np.ndarray:
    """Logistic regression on soft labels with counts, by Newton's method with a ridge."""
    x = unpack_features(kinds, features)
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        q = 1.0 / (1.0 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (n * (q - p)) + beta
        hessian = (x * (n * q * (1 - q))[:, None]).T @ x + np.eye(x.shape[1])
        step = np.linalg.solve(hessian, gradient)
        beta -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def fit(docs: DataFrame) -> np.ndarray:
    """Coefficients of the span classifier."""
    rows = pattern_counts(docs).orderBy("kind", "votes", "features").collect()
    if not rows:
        return np.zeros(1 + len(FEATURES) + len(KINDS))
    kind, votes, features, n = (np.array([r[c] for r in rows]) for c in ("kind", "votes", "features", "n"))
    p = np.zeros(len(rows))
    for k in np.unique(kind):  # labelers differ in reliability from kind to kind
        own = kind == k
        p[own] = reliabilities(votes[own], n[own].astype(float))[1]
    return train_classifier(kind, features, p, n.astype(float))


def written(spans: list[Span]) -> str:
    order = sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in order)


def weak_supervision(docs: DataFrame) -> DataFrame:
    """One row per document: base counts, digest of the base spans, all spans."""
    beta = fit(docs)

    def find(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        accepted: dict[tuple[int, int], bool] = {}
        for batch in iterator:
            rows = []
            for text in texts(batch):
                base, spans = [], []
                for span, is_base, _, features in candidates(text):
                    if is_base:
                        base.append(span)
                        spans.append(span)
                        continue
                    key = (KINDS.index(span[0]), features)
                    if key not in accepted:
                        x = unpack_features(np.array([key[0]]), np.array([features]))
                        accepted[key] = bool(1.0 / (1.0 + np.exp(-(x @ beta)[0])) >= ACCEPT)
                    if accepted[key]:
                        spans.append(span)
                kinds = Counter(s[0] for s in base)
                digest = hashlib.sha256(written(base).encode()).hexdigest()
                rows.append((*(kinds[k] for k in BASE_KINDS), digest, written(spans)))
            if rows:
                columns = [ids(batch), *map(list, zip(*rows, strict=True))]
                yield pa.RecordBatch.from_pydict(dict(zip(ARROW.names, columns, strict=True)), schema=ARROW)

    return map_batches(docs.select("doc_id", "text"), find, SCHEMA)


def op6_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_supervision(table(spark, sf_dir, "documents"))
