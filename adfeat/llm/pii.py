"""Personal data by rules and a skip-chain conditional random field (operator 5).

Rules find e-mail addresses, IP addresses, card and phone numbers.  The field then labels
the document's evidence tokens (those with a digit or an at sign; all others are fixed to
"none").  Tokens that are neighbours in the text share a chain potential; tokens that repeat
or resemble an earlier one, at any distance, share a skip potential, so that one occurrence's
evidence reaches the others.  Loopy sum-product messages give every token's marginals, and a
token whose marginal for a kind is high enough adds a span where no rule found one.  The
weights are fitted by pseudo-likelihood on a bounded sample that the rules label.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adfeat.llm.common import bounded_sample, use_session

KINDS = ("email", "ip", "card", "phone")
NONE = len(KINDS)

#: The bounded training sample: texts, and code points of a text that may be in it.
SAMPLE_TEXTS, SAMPLE_CHARS = 1500, 20_000

#: Message rounds, damping, and the marginal that a token needs to add a span.
ROUNDS, DAMPING, CERTAIN = 12, 0.3, 0.9

#: Every such token's features are hidden while the field is fitted.
MASKED = 2

Span = tuple[int, int, int]  # start, kind, end

_EVIDENCE = re.compile("[0-9@]").search
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+").match
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}").finditer
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+").finditer
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]").finditer
_TOKEN = re.compile(r"[^ \t-\r]+").finditer
_BLANK = re.compile(r"[ \t-\r]+").fullmatch
_NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")
_NOT_DIGIT = re.compile("[^0-9]")
_NUMBERS = re.compile("[0-9]+").findall
_SHORT_NUMBER = re.compile("[0-9]{1,3}").fullmatch
_PIECE = re.compile(r"[A-Za-z0-9@._%+()-]+").finditer

#: A longer token (minified data, text without blanks) is cut into the pieces that could be evidence.
LONG_TOKEN = 200


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _byte(digits: str) -> bool:
    """At most 255; the number may have any zeros before it."""
    rest = digits.lstrip("0")
    return len(rest) <= 3 and int(rest or "0") <= 255


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost, non-overlapping: for each at sign the longest local part after the last match.

    Found from the at signs, as a search over the text is quadratic in a long run of letters.
    """
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end:
            lo = max(end, start - 256)
            bad = [m.end() for m in _NOT_LOCAL.finditer(text, lo, start)]
            start = lo + (bad[-1] - lo) if bad else lo
            if bad:
                break
        m = _DOMAIN(text, at) if start < at else None
        if m:
            yield start, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[Span]:
    """The rules' spans by start, then kind; leftmost and non-overlapping per kind."""
    out: list[Span] = [(s, 0, e) for s, e in _emails(text)]
    for m in _IP(text):
        if all(_byte(x) for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD(text):
        digits = _NOT_DIGIT.sub("", m[0]) if len(m[0]) < 64 else ""
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in _PHONE(text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def shown(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


@dataclass
class Graph:
    """Evidence tokens of some texts: place, features, and edges (u, v) along the text and between like tokens."""

    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    features: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


_DIGIT_BOUNDS = (1, 3, 5, 7, 8, 10, 12, 14, 17, 20)
N_FEATURES = 14 + len(_DIGIT_BOUNDS)


def _features(token: str) -> list[float]:
    digits = _NOT_DIGIT.sub("", token)
    n = len(digits)
    parts = token.split(".")
    quad = len(parts) == 4 and all(_SHORT_NUMBER(p) for p in parts)
    out = [
        True, "@" in token, "@" in token and "." in token.partition("@")[2], any(c.isalpha() for c in token), "." in token,
        quad, quad and all(int(p) < 256 for p in parts), token.startswith("+"), "(" in token or ")" in token, "-" in token,
        n == len(token), 14 <= n <= 19, 14 <= n <= 19 and luhn(digits), "=" in token or '"' in token or ":" in token,
    ]
    return [float(x) for x in out] + [float(n >= b) for b in _DIGIT_BOUNDS]


def _likeness(token: str) -> list[str]:
    """Keys under which tokens resemble each other: the token, its last seven digits, an address's host and name."""
    low = token.lower()
    keys = [low]
    digits = _NOT_DIGIT.sub("", low)
    if len(digits) >= 7:
        keys.append("#" + digits[-7:])
    parts = _NUMBERS(low)
    if len(parts) == 4:
        keys.append("/".join(parts))
    name, at, host = low.partition("@")
    if at:
        keys += [f"{name}@", f"@{host}"]
    return keys


def _tokens(text: str) -> Iterator[tuple[int, str]]:
    """(place, token) in order; a token over LONG_TOKEN gives its pieces."""
    for m in _TOKEN(text):
        if m.end() - m.start() <= LONG_TOKEN:
            yield m.start(), m[0]
        else:
            for p in _PIECE(m[0]):
                yield m.start() + p.start(), p[0]


def graph(texts: list[str]) -> Graph:
    where: list[tuple[int, int, int]] = []
    features, chain, skip = [], [], []
    for i, text in enumerate(texts):
        if not text or not _EVIDENCE(text):
            continue
        last: dict[str, int] = {}
        before = -2
        for nth, (at, word) in enumerate(_tokens(text)):
            if not _EVIDENCE(word):
                continue
            core = word.strip("\"'.,;:!?<>[]{}|*#$%&")
            if not core:
                continue
            node = len(where)
            s = at + word.index(core)
            where.append((i, s, s + len(core)))
            features.append(_features(core))
            if before == nth - 1:
                chain.append((node - 1, node))
            before = nth
            for key in _likeness(core):
                if key in last:
                    skip.append((last[key], node))
                last[key] = node
    w = np.array(where, np.int64).reshape(-1, 3)
    pairs = lambda x: np.array(x, np.int64).reshape(-1, 2)
    return Graph(w[:, 0], w[:, 1], w[:, 2], np.array(features).reshape(-1, N_FEATURES), pairs(chain), np.unique(pairs(skip), axis=0))


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@dataclass
class Field:
    """Weights of the tokens' features, of neighbours in the text and of like tokens."""

    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    def marginals(self, g: Graph) -> np.ndarray:
        """Label marginals of every token after ROUNDS rounds of damped sum-product messages."""
        n, k = len(g.start), NONE + 1
        local = g.features @ self.unary
        edges = [(g.chain, self.chain), (g.skip, self.skip)]
        src = np.concatenate([np.r_[e[:, 0], e[:, 1]] for e, _ in edges])
        dst = np.concatenate([np.r_[e[:, 1], e[:, 0]] for e, _ in edges])
        back = np.concatenate([np.r_[len(e) : 2 * len(e), 0 : len(e)] + o for (e, _), o in zip(edges, (0, 2 * len(g.chain)), strict=True)])
        table = np.concatenate([t[None].repeat(len(e), 0) for e, w in edges for t in (w, w.T)]).reshape(-1, k, k)
        message = np.zeros((len(src), k))
        for _ in range(ROUNDS if len(src) else 0):
            belief = local.copy()
            np.add.at(belief, dst, message)
            x = (belief[src] - message[back])[:, :, None] + table
            top = x.max(axis=1)
            new = top + np.log(np.exp(x - top[:, None]).sum(axis=1))
            new -= new.max(axis=1, keepdims=True)
            message = DAMPING * message + (1 - DAMPING) * new
        np.add.at(local, dst, message)
        return _softmax(local)


def fit(texts: list[str], steps: int = 300, decay: float = 1e-3) -> Field | None:
    """Pseudo-likelihood fit on texts that the rules label; None without an evidence token.

    The rules' labels can be read off a token's own features, so a field fitted to them as they
    are learns nothing from the edges.  For every MASKED-th token all features but the first
    (a constant) are hidden: what it is has to come from its neighbours and its likes, as it
    does for a damaged mention later.
    """
    g = graph(texts)
    n, k = len(g.start), NONE + 1
    if not n:
        return None
    y = rule_labels(g, texts)
    truth = np.eye(k)[y]
    g.features[::MASKED, 1:] = 0
    field = Field(np.zeros((N_FEATURES, k)), np.zeros((k, k)), np.zeros((k, k)))
    state = [(w, np.zeros_like(w), np.zeros_like(w)) for w in (field.unary, field.chain, field.skip)]
    for step in range(1, steps + 1):
        x = g.features @ field.unary
        for e, w in ((g.chain, field.chain), (g.skip, field.skip)):
            np.add.at(x, e[:, 1], w[y[e[:, 0]]])
            np.add.at(x, e[:, 0], w.T[y[e[:, 1]]])
        err = (_softmax(x) - truth) / n
        grads = [g.features.T @ err]
        for e in (g.chain, g.skip):
            grad = np.zeros((k, k))
            np.add.at(grad, y[e[:, 0]], err[e[:, 1]])
            np.add.at(grad.T, y[e[:, 1]], err[e[:, 0]])
            grads.append(grad)
        for (w, m, v), grad, d in zip(state, grads, (decay, decay / 100, decay / 100), strict=True):
            grad = grad + d * w
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            w -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return field


def rule_labels(g: Graph, texts: list[str]) -> np.ndarray:
    """The kind of the rule span that a token overlaps, the first kind listed if several do."""
    y = np.full(len(g.start), NONE)
    first = np.searchsorted(g.text, np.arange(len(texts) + 1))
    for i in np.unique(g.text):
        a, b = first[i], first[i + 1]
        for s, k, e in sorted(base_spans(texts[i]), key=lambda x: -x[1]):
            # tokens do not overlap, so their ends are in order too
            y[a + np.searchsorted(g.end[a:b], s, "right") : a + np.searchsorted(g.start[a:b], e, "left")] = k
    return y


def all_spans(texts: list[str], field: Field | None) -> list[tuple[list[Span], list[Span]]]:
    """(rules' spans, all spans) of every text; an added span overlaps no rule's span.

    Tokens of one kind with nothing but white space between them are one added span.
    """
    base = [base_spans(t) if t and _EVIDENCE(t) else [] for t in texts]
    out = [(b, b) for b in base]
    if field is None:
        return out
    g = graph(texts)
    if not len(g.start):
        return out
    p = field.marginals(g)
    kind = p[:, :NONE].argmax(axis=1)
    certain = np.flatnonzero(p[np.arange(len(p)), kind] >= CERTAIN)
    first = np.searchsorted(g.text[certain], np.arange(len(texts) + 1))
    for i in np.unique(g.text[certain]).tolist():
        starts = np.array([s for s, _, _ in base[i]], np.int64)
        reach = np.r_[-1, np.maximum.accumulate(np.array([e for _, _, e in base[i]], np.int64))] if len(starts) else np.full(1, -1)
        added: list[Span] = []
        for j in certain[first[i] : first[i + 1]].tolist():
            s, e, k = int(g.start[j]), int(g.end[j]), int(kind[j])
            if reach[np.searchsorted(starts, e, "left")] > s:  # a rule's span starts before its end and ends after its start
                continue
            if added and added[-1][1] == k and _BLANK(texts[i], added[-1][2], s):
                added[-1] = added[-1][0], k, e
            else:
                added.append((s, k, e))
        if added:
            out[i] = base[i], sorted([*base[i], *added])
    return out


def sample_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", texts: int = SAMPLE_TEXTS) -> list[str]:
    """At most ``texts`` texts with evidence, none over SAMPLE_CHARS: those with the smallest hash."""
    t = F.col("t")
    rows = docs.select(F.col(id_col).cast("string").alias("d"), F.col(text_col).alias("t"))
    rows = rows.where((F.length(t) <= SAMPLE_CHARS) & t.rlike("[0-9@]"))
    return [r.t for r in bounded_sample(rows, texts, "d", "t").select("t").collect()]


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every row's whole text.

    The counts and base_sha256 are of the rules' spans; ``spans`` lists all, those of the
    field included, as kind:start:end in code points.  A null or empty text has none; a null
    id is kept; repeated rows each give a row; an empty table gives none.  One pass, no shuffle.
    """
    use_session(docs.sparkSession)
    field = fit(sample_texts(docs, id_col, text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = all_spans([t or "" for t in b.column(1).to_pylist()], field)
            counts = [[sum(k == kind for _, k, _ in base) for base, _ in found] for kind in range(NONE)]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    *(pa.array(c, pa.int64()) for c in counts),
                    pa.array([hashlib.sha256(shown(base).encode()).hexdigest() for base, _ in found], pa.string()),
                    pa.array([shown(every) for _, every in found], pa.string()),
                ],
                names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
            )

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
