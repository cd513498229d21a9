"""Personal data in texts by weak supervision.

Patterns find the base kinds (mail and network addresses, card and phone numbers), which always count. Wider patterns
propose candidates for further kinds: access secrets, account numbers, names of persons and street addresses. Nobody has
labelled those, so labelers vote on each candidate: regular expressions on its shape, gazetteers of words, and what stands
before and after it. A labeler says yes, no or nothing. Expectation-maximisation over the counted vote patterns of the
whole corpus estimates how often each labeler is right and how likely each pattern is, and a final classifier (a logistic
model over shape and context, not over the votes themselves) is fitted to those likelihoods; it decides on each candidate.

Counts of vote and feature patterns are all that is gathered: both are small bit masks, so that there are few of them
whatever the corpus.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.frames import slices, texts

BASE_KINDS = ("email", "ip", "card", "phone")
FURTHER_KINDS = ("secret", "account", "person", "street")
KINDS = BASE_KINDS + FURTHER_KINDS

# The base patterns.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    doubled = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each @ with the longest run before it and a domain after it, in time proportional to the text."""
    free = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[Span]:
    """The base spans, by kind as listed, then by start."""
    found: list[Span] = [("email", a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.groups()):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = re.sub("[ -]", "", m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append(("phone", *m.span()))
    return found


# --- candidates of further kinds and the labelers that vote on them ---------------------------------------------------

# Gazetteers.
_SECRET_WORDS = "password passwd pwd pass token secret apikey api_key api-key key auth bearer credential credentials".split()
_ACCOUNT_WORDS = "iban account konto kontonummer cuenta compte ssn passport passeport pasaporte ausweis tax steuer nif".split()
_TITLES = "mr mrs ms dr prof herr frau monsieur madame señor señora don doña".split()
_SAID = "name called author contact from by dear signed regards nombre nom heißt sincerely".split()
_STREETS = "street st avenue ave road rd lane boulevard blvd drive straße strasse weg platz calle avenida rue chemin".split()
_COUNTRIES = frozenset("AT BE CH CZ DE DK ES FI FR GB GR HR HU IE IT LU NL NO PL PT RO SE SI SK".split())

_LONG = re.compile(r"[A-Za-z0-9_+/~-]{12,}+={0,2}")
_ACCOUNT = re.compile(r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b|\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b", re.ASCII)
_PERSON = re.compile(
    rf"\b(?i:{'|'.join(_TITLES)}|name(?: is)?|author|contact|nombre|nom)\b[.:]? {{0,3}}([A-ZÀ-Þ][\w'-]{{1,30}}(?: [A-ZÀ-Þ][\w'-]{{1,30}}){{0,2}})"
)
_STREET = re.compile(
    rf"\b[0-9]{{1,5}} [A-ZÀ-Þ]\w{{1,30}}(?: [A-ZÀ-Þ]\w{{1,30}})? (?i:{'|'.join(_STREETS)})\b"
    rf"|\b(?i:calle|avenida|rue|chemin) (?:(?i:de|del|de la|du|des) )?[A-ZÀ-Þ]\w{{1,30}},? [0-9]{{1,5}}\b"
    rf"|\b[A-ZÄÖÜ]\w{{1,30}}(?:straße|strasse|weg|platz) [0-9]{{1,5}}\b"
)
_BEFORE, _AFTER = 32, 16
_TRAIL = re.compile(r"[\w-]+", re.UNICODE)


@dataclass(frozen=True)
class Candidate:
    kind: str
    start: int
    end: int
    text: str
    before: str
    after: str


def candidates(text: str) -> Iterator[Candidate]:
    """Everything that might be a span of a further kind, by kind as listed, then by start; in linear time."""

    def made(kind: str, start: int, end: int) -> Candidate:
        before, after = text[max(0, start - _BEFORE) : start], text[end : end + _AFTER]
        return Candidate(kind, start, end, text[start:end], before, after)

    for m in _LONG.finditer(text):
        if any(c.isdigit() for c in m[0]) and any(c.isalpha() for c in m[0]):
            yield made("secret", *m.span())
    for m in _ACCOUNT.finditer(text):
        yield made("account", *m.span())
    for m in _PERSON.finditer(text):
        yield made("person", *m.span(1))
    for m in _STREET.finditer(text):
        yield made("street", *m.span())


def _last_words(c: Candidate, n: int = 2) -> list[str]:
    return [w.lower() for w in _TRAIL.findall(c.before)[-n:]]


def _iban(text: str) -> bool:
    plain = text.replace(" ", "")
    return 15 <= len(plain) <= 34 and int("".join(str(int(x, 36)) for x in plain[4:] + plain[:4])) % 97 == 1


def _changes(text: str) -> int:
    """How often letters and digits alternate."""
    kinds = [c.isdigit() for c in text if c.isalnum()]
    return sum(a != b for a, b in zip(kinds, kinds[1:], strict=False))


def _vote(yes: bool, no: bool = False) -> int:
    return 1 if yes else -1 if no else 0


#: Labelers of each kind: 1 for yes, -1 for no, 0 for no opinion.
LABELERS: dict[str, tuple[Callable[[Candidate], int], ...]] = {
    "secret": (
        lambda c: _vote(bool(re.fullmatch(r"[0-9a-f]{16,}|[0-9A-F]{16,}", c.text)), "/" in c.text or c.text.count("-") > 1),
        lambda c: _vote(any(w in _SECRET_WORDS for w in _last_words(c))),
        lambda c: _vote(bool(re.search(r"[=:] ?[\"']?$", c.before)), bool(re.search(r"[/.@#?&]$|://\S*$", c.before))),
        lambda c: _vote(_changes(c.text) >= 5, _changes(c.text) <= 1),
        lambda c: _vote(bool(re.match(r"[\"';]", c.after)), bool(re.match(r"[@/]|\.\w", c.after))),
    ),
    "account": (
        lambda c: _vote(c.text[:2].isalpha() and _iban(c.text), c.text[:2].isalpha() and not _iban(c.text)),
        lambda c: _vote(c.text[:2] in _COUNTRIES, c.text[:2].isalpha() and c.text[:2] not in _COUNTRIES),
        lambda c: _vote(any(w in _ACCOUNT_WORDS for w in _last_words(c, 3))),
        lambda c: _vote(bool(re.match(r"[0-9]{3}-", c.text)) and c.text[:3] not in ("000", "666") and c.text[0] != "9"),
    ),
    "person": (
        lambda c: _vote(any(w in _TITLES for w in _last_words(c, 1))),
        lambda c: _vote(any(w in _SAID for w in _last_words(c, 2))),
        lambda c: _vote(1 <= c.text.count(" ") <= 2, any(x.isdigit() or x == "_" for x in c.text)),
        lambda c: _vote(bool(re.match(r"[,.;\n]|$", c.after)), bool(re.match(r"[=(/]", c.after))),
    ),
    "street": (
        lambda c: _vote(any(w.lower() in _STREETS for w in c.text.split()), False),
        lambda c: _vote(bool(re.match(r",? [0-9]{4,5}\b|, [A-ZÀ-Þ]", c.after))),
        lambda c: _vote(any(w in ("at", "address", "adresse", "dirección", "lives", "live") for w in _last_words(c))),
        lambda c: _vote(len(re.findall("[0-9]", c.text)) <= 3, len(re.findall("[0-9]", c.text)) >= 5),
    ),
}

#: What the final classifier sees of a candidate: shape and surroundings, as yes or no.
FEATURES: tuple[Callable[[Candidate], bool], ...] = (
    lambda c: len(c.text) >= 16,
    lambda c: len(c.text) >= 32,
    lambda c: c.text.islower() or not any(x.isupper() for x in c.text),
    lambda c: any(x.isdigit() for x in c.text),
    lambda c: _changes(c.text) >= 3,
    lambda c: _changes(c.text) >= 8,
    lambda c: any(x in "/+_-" for x in c.text),
    lambda c: " " in c.text,
    lambda c: bool(re.search(r"[=:] ?[\"']?$", c.before)),
    lambda c: bool(re.search(r"[\"']$", c.before)),
    lambda c: bool(re.search(r"[/.@#?&]$", c.before)),
    lambda c: any(w in _SECRET_WORDS + _ACCOUNT_WORDS + _TITLES + _SAID for w in _last_words(c)),
    lambda c: bool(re.match(r"[\"']", c.after)),
    lambda c: bool(re.match(r"\s|$", c.after)),
)


def pattern(c: Candidate) -> tuple[int, int]:
    """Votes in base 3 and features in base 2."""
    votes = features = 0
    for labeler in LABELERS[c.kind]:
        votes = votes * 3 + labeler(c) + 1
    for feature in FEATURES:
        features = features * 2 + int(feature(c))
    return votes, features


def _votes(number: int, n: int) -> list[int]:
    found = []
    for _ in range(n):
        number, vote = divmod(number, 3)
        found.append(vote - 1)
    return found[::-1]


# --- from votes to a classifier -----------------------------------------------------------------------------------------


def likelihoods(votes: np.ndarray, n: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """By expectation-maximisation: how likely each vote pattern is personal data, and the reliability of each labeler.

    ``votes`` holds 1, -1 and 0 (no opinion), ``n`` how often the pattern occurs. A labeler is right with the same chance
    on both classes; it starts at 0.8 and stays between 0.55 and 0.99, so that the classes cannot change places.
    """
    reliable, share = np.full(votes.shape[1], 0.8), 0.5
    for _ in range(rounds):
        odds = np.log(share / (1 - share)) + votes @ np.log(reliable / (1 - reliable))
        likely = 1 / (1 + np.exp(-odds))
        share = float(np.clip((n @ likely + 1) / (n.sum() + 2), 0.02, 0.98))
        said = np.abs(votes)
        right = (n[:, None] * np.where(votes > 0, likely[:, None], np.where(votes < 0, 1 - likely[:, None], 0))).sum(axis=0)
        reliable = np.clip((right + 8) / ((n[:, None] * said).sum(axis=0) + 10), 0.55, 0.99)
    return likely, reliable


def logistic(features: np.ndarray, likely: np.ndarray, n: np.ndarray, rounds: int = 30, ridge: float = 1.0) -> np.ndarray:
    """Weights (the last is the constant) of a logistic model fitted to likelihoods by Newton steps."""
    x = np.concatenate([features, np.ones((len(features), 1))], axis=1)
    w = np.zeros(x.shape[1])
    weight = n / n.sum() * min(n.sum(), 10_000.0)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - likely)) + ridge * w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w -= np.linalg.solve(curve, slope)
    return w


@dataclass(frozen=True)
class Model:
    weights: dict[str, np.ndarray]
    reliabilities: dict[str, np.ndarray]

    def accepts(self, c: Candidate, threshold: float) -> bool:
        w = self.weights.get(c.kind)
        if w is None:
            return False
        z = float(w[-1]) + sum(float(v) for v, f in zip(w, FEATURES, strict=False) if f(c))
        return z >= np.log(threshold / (1 - threshold))


def fit(docs: DataFrame, *, text: str = "text") -> Model:
    """Reliabilities and classifiers from the candidates of all texts; a kind without candidates has none and finds none."""
    rows = docs.select(F.col(f"`{text}`").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, int, int], int] = {}
        for batch in slices(batches, "text"):
            for value in texts(batch, "text"):
                for c in candidates(value):
                    key = (FURTHER_KINDS.index(c.kind), *pattern(c))
                    seen[key] = seen.get(key, 0) + 1
        if seen:
            columns = [pa.array([k[i] for k in seen], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(seen.values(), pa.int64())], ["kind", "votes", "features", "n"])

    counted = rows.mapInArrow(count, "kind long, votes long, features long, n long")
    # at most 3^5 vote times 2^14 feature patterns of each kind, of which few occur
    found = counted.groupBy("kind", "votes", "features").agg(F.sum("n").alias("n")).collect()
    return fit_patterns([(r.kind, r.votes, r.features, r.n) for r in found])


def fit_patterns(found: Sequence[tuple[int, int, int, int]]) -> Model:
    weights, reliabilities = {}, {}
    for number, kind in enumerate(FURTHER_KINDS):
        own = sorted(x[1:] for x in found if x[0] == number)
        if not own:
            continue
        votes = np.array([_votes(v, len(LABELERS[kind])) for v, _, _ in own], np.float64)
        features = np.array([[f >> i & 1 for i in range(len(FEATURES) - 1, -1, -1)] for _, f, _ in own], np.float64)
        n = np.array([x[2] for x in own], np.float64)
        likely, reliabilities[kind] = likelihoods(votes, n)
        weights[kind] = logistic(features, likely, n)
    return Model(weights, reliabilities)


class _Taken:
    """Spans of one kind in the order of their starts, none of which overlap: a look at two neighbours tells what is free."""

    def __init__(self, spans: Sequence[Span] = ()):
        self._starts, self._ends = [s for _, s, _ in spans], [e for _, _, e in spans]

    def add(self, start: int, end: int) -> None:
        self._starts.append(start)
        self._ends.append(end)

    def free(self, start: int, end: int) -> bool:
        at = bisect.bisect_left(self._starts, end)  # those before begin before the end
        return at == 0 or self._ends[at - 1] <= start


def find(text: str, model: Model, threshold: float = 0.5) -> tuple[list[Span], list[Span]]:
    """Base spans and further ones. A further span overlaps neither a base span nor an earlier further one.

    Time grows with the text and the logarithm of its spans.
    """
    base = base_spans(text)
    further: list[Span] = []
    # within a kind spans do not overlap and come by their starts
    taken = {kind: _Taken([s for s in base if s[0] == kind]) for kind in BASE_KINDS} | {kind: _Taken() for kind in FURTHER_KINDS}
    for c in candidates(text):
        if model.accepts(c, threshold) and all(kind.free(c.start, c.end) for kind in taken.values()):
            taken[c.kind].add(c.start, c.end)
            further.append((c.kind, c.start, c.end))
    return base, further


def redacted(text: str, spans: Sequence[Span]) -> str:
    """The text with its kind in angle brackets in place of each span; overlapping spans are replaced as one."""
    out, at, merged = [], 0, []
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if merged and start < merged[-1][2]:
            merged[-1] = (merged[-1][0], merged[-1][1], max(end, merged[-1][2]))
        else:
            merged.append((kind, start, end))
    for kind, start, end in merged:
        out += [text[at:start], f"<{kind.upper()}>"]
        at = end
    return "".join([*out, text[at:]])


SPAN = "struct<kind: string, start: bigint, end: bigint>"


def detect(
    docs: DataFrame, model: Model, *, text: str = "text", threshold: float = 0.5, redact: bool = False, keep_text: bool = True
) -> DataFrame:
    """``docs`` with ``pii``: a struct of the spans ``base`` and ``further`` (arrays of kind, start, end in code points).

    ``redact`` puts the kind, as in ``<EMAIL>``, in place of every span of ``text``. A null or empty text has no span and
    stays as it is. Texts of any length are read whole. Repeated rows come out alike, an empty table gives no rows, and
    null ids are values like others. A column called ``pii`` is replaced.
    """
    kept = [c for c in docs.columns if c.lower() != "pii" and c != text]
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("row"), F.col(f"`{text}`").alias("text"))
    own = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            values = batch.column("text").to_pylist()
            spans = [find(t or "", model, threshold) for t in values]
            lists = [
                pa.array([[dict(zip(("kind", "start", "end"), s, strict=True)) for s in x[i]] for x in spans], own)
                for i in (0, 1)
            ]
            if redact:
                values = [t if t is None else redacted(t, [*b, *f]) for t, (b, f) in zip(values, spans, strict=True)]
            elif not keep_text:
                values = [None] * len(values)
            columns = [batch.column("row"), pa.array(values, pa.string()), *lists]
            yield pa.RecordBatch.from_arrays(columns, ["row", "text", "base", "further"])

    empty = F.array().cast(f"array<{SPAN}>")
    out = rows.mapInArrow(run, rows.select("row", "text", empty.alias("base"), empty.alias("further")).schema)
    columns = [
        F.col("text").alias(c) if c == text else F.col("row").getField(c).alias(c)
        for c in docs.columns
        if c.lower() != "pii" and (c != text or keep_text)
    ]
    return out.select(*columns, F.struct("base", "further").alias("pii"))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of spans, by kind as listed, then by start, with commas between them."""
    order = F.create_map(*(F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)))
    keyed = F.array_sort(F.transform(spans, lambda s: F.struct(order[s["kind"]], s["start"], s["end"], s["kind"])))
    parts = F.transform(keyed, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.concat_ws(",", parts)
