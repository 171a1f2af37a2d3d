"""Personal data: fixed patterns, extended by a skip-chain conditional random field.

The patterns for e-mail addresses, IP addresses, card and phone numbers give
the base spans, which always stay.  A conditional random field over the tokens
that hold a digit or ``@`` then looks for mentions that the patterns miss,
such as a number repeated without its country code.  Neighbouring groups of
digits are one mention.  Its labels are none, e-mail, ip, card and phone; its
potentials are

* one for each token, from its shape and its mention's (weights of a softmax),
* one for each pair of neighbouring tokens (chain), and
* one for each pair of tokens of distant mentions that are equal or similar
  (skip chain: the same text without case, or numbers with the same last
  digits), which draws both to one label.

All are trained here together, by the composite likelihood of each token given
its neighbours' labels (pseudo-likelihood) and given its shape alone.  The
base spans are the labels.  Each labelled document is followed by a repeat of
itself whose phone numbers lack the country code (``repeated``), since that is
how distant mentions look.  The training documents are ``TRAIN_DOCS`` different ones that
hold base spans and as many that hold candidate tokens only (those with the
smallest hashes; all where there are fewer); Spark counts their distinct token
patterns, and only these reach the driver.

In every document with candidate tokens loopy message passing then spreads
labels along both kinds of edges, with the tokens under a base span observed.
A token is added where the belief in a label reaches ``BELIEF`` and its mention
is tied to another one; a lone mention has nothing to be consistent with.
A kind also needs its own evidence (``NEEDED``), so repeated dates are no phones;
a repeated plain number of 9 to 13 digits still counts as one.

Repeated mentions are linked to the next and to the first of their kind, token
by token from their ends, so the number of edges follows the number of tokens.

Cases: null text counts as empty; null doc_id and repeated rows give a row each;
a table without any personal data trains nothing and adds nothing; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_rows, stored

KINDS = ("email", "ip", "card", "phone")
TRAIN_DOCS = 2000
BELIEF = 0.9
ROUNDS = 20

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+")
_HAS = re.compile(r"[0-9@]")
_NOT_DIGIT = re.compile(r"[^0-9]")
_NOT_DIGITS = re.compile(r"[^0-9]+")
_COUNTRY = re.compile(r"\+[0-9]{1,3}[\x20-]+(?=[0-9(])")
_CORE = re.compile(r"[A-Za-z0-9+(](?:.*[A-Za-z0-9)])?", re.DOTALL)


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: each starts with the longest run of local characters
    before an ``@``, since all starts in a run meet the same ``@``."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and _LOCAL.match(text, start - 1):
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            yield start, end
        at = text.find("@", max(end, at + 1))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, end, kind)`` of the patterns' matches, by start, then kind."""
    if not _HAS.search(text):
        return []
    spans = [(a, b, 0) for a, b in emails(text)]
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in (p.lstrip("0") for p in m.group().split("."))):
            spans.append((*m.span(), 1))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            spans.append((*m.span(), 2))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                spans.append((*m.span(), 3))
    return sorted(spans, key=lambda s: (s[0], s[2]))


@dataclass
class Tokens:
    """The tokens of a document that hold a digit or ``@``."""

    spans: list[tuple[int, int]]
    features: list[list[int]]
    labels: np.ndarray  # 0: under no base span
    chain: list[tuple[int, int]]
    skip: list[tuple[int, int]]


N_FEATURES = 42
LABELS = len(KINDS) + 1
#: The feature that a token needs for each kind: an ``@``, four parts of an
#: address, a mention passing Luhn, a mention of 9 to 13 digits (no date).
NEEDED = (27, 41, 40, 37)


def _shape(core: str, mention: str, before: str | None, after: str | None) -> list[int]:
    """The numbers of the features that a token has."""
    digits = sum(c.isdigit() for c in core)
    on = [0, 1 + min(digits, 20) // 2, 12 + min(core.count("."), 4), 17 + min(core.count("-"), 3), 21 + min(len(core) // 4, 5)]
    for i, test in enumerate(("@" in core, core[:1] == "+", "(" in core, any(c.isalpha() for c in core), before is not None, after is not None, (before or "")[:1] == "+")):
        if test:
            on.append(27 + i)
    whole = _NOT_DIGIT.sub("", mention)
    on.append(34 + sum(len(whole) >= n for n in (4, 7, 9, 14, 20)))
    if 14 <= len(whole) <= 19 and luhn(whole):
        on.append(40)
    parts = core.split(".")
    if len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts):
        on.append(41)
    return on


def similarity_key(mention: str) -> str:
    """Mentions with the same key are linked: a number's last seven digits (so
    without country or area code), all digits of a longer one, else the text
    without case."""
    digits = _NOT_DIGIT.sub("", mention)
    if len(digits) >= 7 and _number(mention) and mention.count(".") != 3:
        return digits[-7:] if len(digits) <= 13 else digits
    return mention.lower()


def _number(core: str) -> bool:
    return "@" not in core and not any(c.isalpha() for c in core)


def _mentions(text: str, spans: list[tuple[int, int]], cores: list[str], under: list[int]) -> list[list[int]]:
    """Tokens by mention: groups of digits with only spaces between them are
    one, unless one of them is a whole number, or a base span ends."""
    short = [_number(c) and sum(d.isdigit() for d in c) < 9 for c in cores]
    out: list[list[int]] = []
    for i, (start, _) in enumerate(spans):
        joins = i > 0 and short[i] and short[i - 1] and under[i] == under[i - 1] and cores[i][:1] != "+"
        gap = text[spans[i - 1][1] : start] if joins and start - spans[i - 1][1] <= 3 else "-"
        if joins and not gap.strip(" "):
            out[-1].append(i)
        else:
            out.append([i])
    return out


def _aligned(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Two mentions' tokens in pairs from their ends; those that the longer one
    has more go with the first of the shorter."""
    n = min(len(a), len(b))
    more = [(a[0], j) for j in b[:-n]] + [(i, b[0]) for i in a[:-n]]
    return more + list(zip(a[-n:], b[-n:]))


def tokens_of(text: str, base: list[tuple[int, int, int]]) -> Tokens:
    spans, cores = [], []
    for m in _TOKEN.finditer(text):
        core = _CORE.search(m.group())
        if core:
            spans.append((m.start() + core.start(), m.start() + core.end()))
            cores.append(core.group())
    near = [b[0] - a[1] <= 3 and not text[a[1] : b[0]].strip(" .,;:!?\"'") for a, b in zip(spans, spans[1:])]
    labels = np.zeros(len(spans), dtype=np.int64)
    under = [-1] * len(spans)
    starts = [a for a, _ in spans]
    for nth, (a, b, kind) in enumerate(base):
        i = max(0, bisect_left(starts, a) - 1)
        while i < len(spans) and spans[i][0] < b:
            if spans[i][1] > a and labels[i] == 0:
                labels[i], under[i] = kind + 1, nth
            i += 1
    skip, last, first = [], {}, {}
    features: list[list[int]] = []
    for mention in _mentions(text, spans, cores, under):
        whole = " ".join(cores[i] for i in mention)
        for i in mention:
            features.append(_shape(cores[i], whole, cores[i - 1] if i and near[i - 1] else None, cores[i + 1] if i < len(near) and near[i] else None))
        key = similarity_key(whole)
        if key in first:
            skip.extend(_aligned(last[key], mention))
            if first[key] is not last[key]:
                skip.extend(_aligned(first[key], mention))
        else:
            first[key] = mention
        last[key] = mention
    return Tokens(spans, features, labels, [(i, i + 1) for i, n in enumerate(near) if n], skip)


@dataclass
class Model:
    weights: np.ndarray  # features x labels
    chain: np.ndarray  # log potentials, labels x labels
    skip: float  # log potential of agreement

    def local(self, features: list[list[int]]) -> np.ndarray:
        z = np.array([self.weights[on].sum(axis=0) for on in features])
        z[:, 1:] -= [[30.0 * (need not in on) for need in NEEDED] for on in features]
        return z - np.logaddexp.reduce(z, axis=1, keepdims=True)


def patterns(tokens: Tokens) -> Counter:
    """How often each pattern of a token and its neighbours' labels occurs: a
    row of bytes holding the features, the labels of the left and right
    neighbours, the labels at skip edges (at most 3 of each), and its own."""
    width = N_FEATURES + 3 * LABELS
    rows = np.zeros((len(tokens.spans), width + 1), dtype=np.uint8)
    for i, on in enumerate(tokens.features):
        rows[i, on] = 1
    y = tokens.labels
    for i, j in tokens.chain:
        rows[j, N_FEATURES + y[i]] = rows[i, N_FEATURES + LABELS + y[j]] = 1
    for pair in tokens.skip:
        for i, j in (pair, pair[::-1]):
            rows[i, N_FEATURES + 2 * LABELS + y[j]] = min(3, rows[i, N_FEATURES + 2 * LABELS + y[j]] + 1)
    rows[:, width] = y
    return Counter(r.tobytes() for r in rows)


def repeated(text: str, base: list[tuple[int, int, int]]) -> tuple[str, list[tuple[int, int, int]]]:
    """The text followed by itself, with its base spans in both; in the repeat,
    phone numbers lack their country code and are written as they were, with
    hyphens or with spaces, in turn.  Overlapping spans count as their first."""
    parts, spans, at = [text, "\n"], list(base), 0
    size = len(text) + 1
    for nth, (a, b, kind) in enumerate(base):
        if a < at:
            continue
        code = _COUNTRY.match(text, a, b) if kind == 3 else None
        mention = text[code.end() : b] if code else text[a:b]
        if code and nth % 3:
            mention = _NOT_DIGITS.sub("- "[nth % 3 - 1], mention).strip("- ")
        parts += [text[at:a], mention]
        size += a - at
        spans.append((size, size + len(mention), kind))
        size, at = size + len(mention), b
    return "".join([*parts, text[at:]]), spans


def train_patterns(counted: dict[bytes, int], rounds: int = 600, rate: float = 0.05, decay: float = 1e-4) -> Model:
    """The potentials that maximise the composite likelihood, by Adam; rounds
    and order are fixed, so reruns agree."""
    keys = sorted(counted)
    rows = np.array([np.frombuffer(k, dtype=np.uint8) for k in keys]).reshape(len(keys), N_FEATURES + 3 * LABELS + 1).astype(float)
    weight = np.array([counted[k] for k in keys], dtype=float)
    weight /= max(weight.sum(), 1)
    x, left, right, tied = np.split(rows[:, :-1], [N_FEATURES, N_FEATURES + LABELS, N_FEATURES + 2 * LABELS], axis=1)
    target = np.eye(LABELS)[rows[:, -1].astype(int)]
    w, chain, skip = np.zeros((N_FEATURES, LABELS)), np.zeros((LABELS, LABELS)), np.zeros(1)
    parts = [w, chain, skip]
    mean, square = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]

    def error(z: np.ndarray) -> np.ndarray:
        return (np.exp(z - np.logaddexp.reduce(z, axis=1, keepdims=True)) - target) * weight[:, None]

    for n in range(1, rounds + 1 if len(keys) else 1):
        alone = x @ w
        given = error(alone + left @ chain + right @ chain.T + skip * tied)
        steps = [x.T @ (given + error(alone)), left.T @ given + given.T @ right, np.array([(given * tied).sum()])]
        for p, g, m, v in zip(parts, steps, mean, square):
            g = g + decay * p
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= rate * (m / (1 - 0.9**n)) / (np.sqrt(v / (1 - 0.999**n)) + 1e-8)
    return Model(w, chain, float(max(skip[0], 0.0)))


def train(sample: list[Tokens]) -> Model:
    return train_patterns(sum(map(patterns, sample), Counter()))


def beliefs(tokens: Tokens, model: Model, rounds: int = ROUNDS) -> np.ndarray:
    """Label probabilities of each token by damped loopy message passing."""
    local = model.local(tokens.features)
    seen = tokens.labels > 0
    local[seen] = -30.0
    local[seen, tokens.labels[seen]] = 0.0
    n, chains, edges = len(local), len(tokens.chain), tokens.chain + tokens.skip
    if edges:
        a, b = np.array(edges).T
        source, target = np.concatenate([a, b]), np.concatenate([b, a])
        back = np.concatenate([np.arange(len(a)) + len(a), np.arange(len(a))])
        along, agree = np.exp(model.chain), np.exp(model.skip * np.eye(LABELS))
        tables = [(slice(0, chains), along), (slice(chains, len(a)), agree), (slice(len(a), len(a) + chains), along.T), (slice(len(a) + chains, None), agree)]
        messages = np.zeros((len(source), LABELS))
        gathered = lambda m: np.stack([np.bincount(target, weights=m[:, k], minlength=n) for k in range(LABELS)], axis=1)
        for _ in range(rounds):
            held = (local + gathered(messages))[source] - messages[back]
            held = np.exp(held - held.max(axis=1, keepdims=True))
            sent = np.empty_like(held)
            for part, t in tables:
                sent[part] = held[part] @ t
            sent = np.log(sent / sent.sum(axis=1, keepdims=True))
            change = np.abs(sent - messages).max()
            messages = 0.5 * messages + 0.5 * sent
            if change < 1e-3:
                break
        local = local + gathered(messages)
    return np.exp(local - np.logaddexp.reduce(local, axis=1, keepdims=True))


def added_spans(text: str, base: list[tuple[int, int, int]], model: Model | None) -> list[tuple[int, int, int]]:
    """Spans that the field adds to the base spans; none overlaps a base span."""
    if model is None or not _HAS.search(text):
        return []
    tokens = tokens_of(text, base)
    tied = np.zeros(len(tokens.spans), dtype=bool)
    for pair in tokens.skip:
        tied[list(pair)] = True
    open_ = tied & (tokens.labels == 0)
    if not open_.any():
        return []  # only tied tokens are added
    belief = beliefs(tokens, model)
    best = belief.argmax(axis=1)
    new = open_ & (best > 0) & (belief.max(axis=1) >= BELIEF)
    near, out = {j: i for i, j in tokens.chain}, []
    for i in np.flatnonzero(new).tolist():
        a, b = tokens.spans[i]
        joins = near.get(i)
        if out and joins is not None and new[joins] and best[joins] == best[i] and out[-1][1] == tokens.spans[joins][1]:
            out[-1] = (out[-1][0], b, out[-1][2])
        else:
            out.append((a, b, int(best[i]) - 1))
    return _apart(out, base)


def _apart(spans: list[tuple[int, int, int]], base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The spans that overlap no base span; both by start."""
    out, reach, at = [], -1, 0
    for a, b, kind in spans:
        while at < len(base) and base[at][0] < b:
            reach, at = max(reach, base[at][1]), at + 1
        if reach <= a:
            out.append((a, b, kind))
    return out


def spans_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], s[2])))


def _drawn(marks: DataFrame, train_docs: int) -> int | None:
    """The hash up to which the first ``train_docs`` of the marked documents
    lie; None if there are no more than that.  ``marks`` holds their different
    hashes, stored; a share of them is sorted that is doubled until it is enough."""
    total = marks.count()
    share = 1.2 * train_docs / max(total, 1)
    while total > train_docs:
        first = marks.where(F.col("h") < share * (1 << 52)).orderBy("h").limit(train_docs).collect()
        if len(first) == train_docs:
            return first[-1]["h"]
        share *= 2
    return None


def training_patterns(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """``(h, labelled, pattern, n)``: the token patterns of the training
    documents, each known by its hash; copies count once."""
    hashed = F.shiftrightunsigned(F.xxhash64("text"), 12).alias("h")
    candidates = docs.where(F.col("text").rlike("[0-9@]")).select(hashed, "text")

    def marked(rows: Iterator[tuple]) -> Iterator[tuple]:
        for h, text in rows:
            yield h, bool(base_spans(text))

    marks = candidates.mapInArrow(map_rows(marked, ["h", "text"], pa.schema([("h", pa.int64()), ("labelled", pa.bool_())])), "h long, labelled boolean")
    marks = stored(marks.distinct(), "pii-marks")
    last = {labelled: _drawn(marks.where(F.col("labelled") == labelled), train_docs) for labelled in (True, False)}

    def kernel(rows: Iterator[tuple]) -> Iterator[tuple]:
        for h, text in rows:
            base = base_spans(text)
            if last[bool(base)] is None or h <= last[bool(base)]:
                seen = tokens_of(*repeated(text, base)) if base else tokens_of(text, base)
                for pattern, n in patterns(seen).items():
                    yield h, bool(base), pattern, n

    if None not in last.values():
        candidates = candidates.where(F.col("h") <= max(last.values()))
    schema = pa.schema([("h", pa.int64()), ("labelled", pa.bool_()), ("pattern", pa.binary()), ("n", pa.int64())])
    return candidates.mapInArrow(map_rows(kernel, ["h", "text"], schema), "h long, labelled boolean, pattern binary, n long").distinct()


def fit(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> Model | None:
    """The model from ``train_docs`` documents at most that hold base spans and
    as many without; None only if no document holds one."""
    counted = training_patterns(docs, train_docs).groupBy("pattern").agg(F.sum("n").alias("n"), F.max("labelled").alias("labelled")).collect()
    return train_patterns({bytes(r["pattern"]): r["n"] for r in counted}) if any(r["labelled"] for r in counted) else None


def find(docs: DataFrame, model: Model | None) -> DataFrame:
    """``(doc_id, base, spans)`` for every row: arrays of ``kind, start, end``."""
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    schema = pa.schema([("doc_id", pa.int64()), ("base", span), ("spans", span)])

    def rows_for(spans: list[tuple[int, int, int]]) -> list[dict]:
        return [{"kind": KINDS[k], "start": a, "end": b} for a, b, k in spans]

    def kernel(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, text in rows:
            base = base_spans(text or "")
            more = added_spans(text or "", base, model)
            yield doc_id, rows_for(base), rows_for(sorted(base + more, key=lambda s: (s[0], s[2])))

    out = "array<struct<kind:string,start:long,end:long>>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(map_rows(kernel, ["doc_id", "text"], schema), f"doc_id long, base {out}, spans {out}")


