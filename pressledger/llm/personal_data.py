"""Personal data by candidate gradient boosting.

Fixed formats are always found. High-recall generators propose further, overlapping spans; boosted trees judge them by format and
context; those over a calibrated threshold are added. The trees learn from the corpus: fixed-format spans against candidates that fail
their format, described by features that do not repeat the test itself.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import pinned, released, smallest
from .text_arrays import text_slices

#: in the order of equal starts
KINDS = ["email", "ip", "card", "phone"]
#: fixed values of the contract, written so that a long run is read once (a match always takes whole runs of digits)
DOMAIN = r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: generators beside the fixed formats: name, pattern and the kind a span would have
GENERATORS = [
    ("spelled email", r"[A-Za-z0-9._-]{1,64} ?[\[(] ?at ?[\])] ?[A-Za-z0-9-]{1,63}(?: ?[\[(] ?dot ?[\])] ?[A-Za-z0-9-]{1,63}){1,5}", "email"),
    ("address of six parts and more", r"(?<![0-9A-Za-z:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){5,7}(?![0-9A-Za-z:])", "ip"),
    ("dotted numbers", r"(?<![0-9])[0-9]{1,3}(?:\.[0-9]{1,3}){2,5}(?![0-9])", "ip"),
    ("digits in groups", r"[0-9]{2,}(?:[ .\-/][0-9]{2,}){2,6}", "card"),
    ("long number", r"[0-9]{9,24}", "card"),
    ("local phone", r"(?<![0-9])\(?0?[0-9]{2,5}\)?[ .\-/][0-9]{3,4}[ .\-/]?[0-9]{3,5}(?![0-9])", "phone"),
]
#: candidates the trees are fitted on at most, those whose hash is smallest
FIT_CANDIDATES = 20_000
TREES, DEPTH, RATE, LEAST = 40, 3, 0.2, 20
#: share of right spans that the threshold must reach among the candidates set aside
PRECISION = 0.99
FEATURES = 18
CUES = re.compile(r"tel|phone|call|fax|mobil|mail|contact|write|card|visa|iban|account|addr|host|server", re.IGNORECASE)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        value = ord(d) - 48
        total += value if i % 2 == 0 else value * 2 - 9 * (value > 4)
    return total % 10 == 0


def digits_of(span: str) -> str:
    return "".join(c for c in span if "0" <= c <= "9")


def detector():
    """(base, others): the fixed formats of a text, and all proposals of the generators; spans are (start, end, kind number)."""
    domain, ip, card, phone = map(re.compile, (DOMAIN, IP, CARD, PHONE))
    generators = [(i, re.compile(p), KINDS.index(k)) for i, (_, p, k) in enumerate(GENERATORS)]

    def emails(text: str) -> Iterator[tuple[int, int, int]]:
        free, at = 0, text.find("@")
        while at >= 0:
            start = at
            while start > free and text[start - 1] in LOCAL:
                start -= 1
            found = domain.match(text, at) if start < at else None
            if found:
                yield start, found.end(), 0
                free = found.end()
            at = text.find("@", max(at + 1, free))

    def fixed(text: str) -> tuple[list, list]:
        """Spans of the contract and matches that fail its tests."""
        good, bad = list(emails(text)), []
        for m in ip.finditer(text):
            right = all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))
            (good if right else bad).append((m.start(), m.end(), 1))
        for m in card.finditer(text):
            number = digits_of(m.group()) if m.end() - m.start() < 60 else ""
            (good if 14 <= len(number) <= 19 and luhn(number) else bad).append((m.start(), m.end(), 2))
        for m in phone.finditer(text):
            (good if 10 <= len(digits_of(m.group())) <= 15 else bad).append((m.start(), m.end(), 3))
        good.sort(key=lambda s: (s[0], s[2]))
        return good, bad

    def proposed(text: str) -> tuple[list, list]:
        good, bad = fixed(text)
        own = {s[:2] for s in good}
        others = {s for s in bad if s[1] - s[0] >= 7} | {
            (m.start(), m.end(), kind) for _, p, kind in generators for m in p.finditer(text) if m.end() - m.start() >= 7}
        return good, sorted(s for s in others if s[:2] not in own)

    return fixed, proposed


def described(text: str, span: tuple[int, int, int]) -> list[float]:
    """Format and context of a span, without the tests of the fixed formats (leading +, checksum, ranges)."""
    start, end, kind = span
    own, before, after = text[start:end], text[max(0, start - 24):start], text[end:end + 8]
    numbers = [c for c in own if "0" <= c <= "9"]
    groups = [len(g) for g in re.split(r"[^0-9]+", own) if g]
    last, following = before[-1:], after[:1]
    return [kind, end - start, len(numbers), len(groups), max(groups, default=0), min(groups, default=0), own.count(" "), own.count("."), own.count("-"),
            own.count("("), sum(c.isalpha() for c in own), len(set(numbers)), float(last.isalnum()), float(following.isalnum()),
            float(last in "" or last.isspace()), float(bool(CUES.search(before))), float(last in ".:/=\"'#"), float(following in ".,;" or following.isspace())]


def fit_trees(x: np.ndarray, y: np.ndarray) -> dict:
    """Boosted regression trees on the log loss over up to 32 quantile bins, with a calibrated threshold.

    Every fifth candidate is set aside: its raw scores give, by a logistic fit, the calibration, and the threshold is the smallest
    probability above which at least PRECISION of those set aside are right. Without both labels nothing is added.
    """
    model = {"trees": [], "threshold": np.inf, "scale": 1.0, "shift": 0.0}
    aside = np.arange(len(y)) % 5 == 0
    if not 0 < y[~aside].sum() < (~aside).sum() or not 0 < y[aside].sum() < aside.sum():
        return model
    cuts = [np.unique(np.quantile(x[~aside][:, f], np.linspace(0, 1, 33)[1:-1])) for f in range(x.shape[1])]
    bins = np.column_stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)])
    raw = np.zeros(len(y))
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-raw))
        gradient, weight = np.where(aside, 0, y - p), np.where(aside, 0, p * (1 - p))
        tree, node = {}, np.ones(len(y), np.int64)
        for at in range(1, 2**DEPTH):
            here = (node == at) & ~aside
            best = (1e-6, None)
            if here.sum() >= 2 * LEAST:
                g, w, total_g, total_w = gradient[here], weight[here], gradient[here].sum(), weight[here].sum()
                for f, c in enumerate(cuts):
                    sg, sw, sn = (np.bincount(bins[here, f], v, len(c) + 1).cumsum()[:-1] for v in (g, w, np.ones(len(g))))
                    gain = sg**2 / (sw + 1) + (total_g - sg)**2 / (total_w - sw + 1) - total_g**2 / (total_w + 1)
                    gain[(sn < LEAST) | (len(g) - sn < LEAST)] = 0
                    k = int(np.argmax(gain)) if len(gain) else 0
                    if len(gain) and gain[k] > best[0]:
                        best = (gain[k], (f, float(c[k])))
            if best[1]:
                tree[at] = best[1]
                node = np.where(node == at, 2 * node + (x[:, best[1][0]] > best[1][1]), node)
        leaves = {int(k): RATE * gradient[node == k].sum() / (weight[node == k].sum() + 1) for k in np.unique(node)}
        raw += np.array([leaves[int(k)] for k in node])
        model["trees"].append((tree, leaves))
    # Platt's calibration by a few Newton steps
    s, t, a, b = raw[aside], y[aside], 1.0, 0.0
    for _ in range(20):
        p = 1 / (1 + np.exp(-(a * s + b)))
        w, e = p * (1 - p) + 1e-6, t - p
        h = np.array([[(w * s * s).sum() + 1e-3, (w * s).sum()], [(w * s).sum(), w.sum() + 1e-3]])
        a, b = np.array([a, b]) + np.linalg.solve(h, [(e * s).sum() - 1e-3 * (a - 1), e.sum() - 1e-3 * b])
    model["scale"], model["shift"] = float(a), float(b)
    p = 1 / (1 + np.exp(-(a * s + b)))
    order = np.argsort(-p, kind="stable")
    right = np.cumsum(t[order]) / np.arange(1, len(t) + 1)
    enough = np.flatnonzero(right >= PRECISION)
    model["threshold"] = float(max(p[order][enough[-1]], 0.5)) if len(enough) else np.inf
    return model


def probability(model: dict, row: list[float]) -> float:
    raw = 0.0
    for tree, leaves in model["trees"]:
        node = 1
        while node in tree:
            f, cut = tree[node]
            node = 2 * node + (row[f] > cut)
        raw += leaves.get(node, 0.0)
    return float(1 / (1 + np.exp(-np.clip(model["scale"] * raw + model["shift"], -30, 30))))


def _suspects(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, str]]:
    """(row, text) of the texts that hold a digit, an @ or a bracket; all others cannot hold a span."""
    marks = np.zeros(256, bool)
    marks[[ord("@"), ord("["), ord("("), *range(ord("0"), ord("9") + 1)]] = True
    texts = batch.column(column)
    for first, _, data, offsets in text_slices(batch, column):
        for i in np.unique(np.searchsorted(offsets, np.flatnonzero(marks[data]), side="right") - 1):
            yield first + int(i), texts[first + int(i)].as_py()


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    _, proposed = detector()
    for batch in batches:
        rows, labels, order = [], [], []
        for _, text in _suspects(batch, "text"):
            good, others = proposed(text)
            others = [s for s in others if all(s[1] <= a or b <= s[0] for a, b, _ in good)]
            for label, spans in ((1, good), (0, others)):
                for span in spans:
                    rows.append(described(text, span))
                    labels.append(label)
                    around = text[max(0, span[0] - 24):span[1] + 8]
                    digest = hashlib.blake2b(f"{span[2]}:{around}".encode("utf-8", "replace"), digest_size=6).digest()
                    order.append(int.from_bytes(digest) / (1 << 48))
        yield pa.RecordBatch.from_arrays([pa.array(order, pa.float64()), pa.array(labels, pa.int32()), pa.array(rows, pa.list_(pa.float64()))],
                                         ["place", "label", "features"])


def train(docs: DataFrame, text: str = "text") -> dict:
    """The trees, fitted on at most FIT_CANDIDATES candidates of all documents. Proposals that overlap a fixed-format span are no
    evidence either way."""
    found = pinned(docs.select(F.col(text).alias("text")).mapInArrow(released(_candidates), "place double, label int, features array<double>"))
    rows = smallest(found, F.col("place"), FIT_CANDIDATES, "label", "features").toPandas()
    x = np.array(rows["features"].tolist(), float).reshape(len(rows), FEATURES)
    return fit_trees(x, rows["label"].to_numpy(dtype=float))


def finder(model: dict):
    """A function from a text to (fixed-format spans, all spans), both sorted by start and kind. Added spans overlap no other."""
    _, proposed = detector()

    def find(text: str) -> tuple[list, list]:
        good, others = proposed(text)
        spans = list(good)
        if model["trees"] and others:
            rated = sorted(((-probability(model, described(text, s)), s) for s in others))
            for minus, (start, end, kind) in rated:
                if -minus >= model["threshold"] and all(end <= a or b <= start for a, b, _ in spans):
                    spans.append((start, end, kind))
        return good, sorted(spans, key=lambda s: (s[0], s[2], s[1]))

    return find


def written(spans: list) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def spans_of(docs: DataFrame, model: dict, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_email, n_ip, n_card, n_phone, base, spans) of every row.

    Counts and ``base`` are of the fixed formats, ``spans`` has the added ones too; places are code points, ends exclusive. Null and empty
    texts have none. Repeated rows stay; other columns are not read. Rows never leave their task.
    """
    counts = [f"n_{k}" for k in KINDS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = finder(model)
        for batch in batches:
            numbers, base, every = np.zeros((len(KINDS), batch.num_rows), np.int64), [""] * batch.num_rows, [""] * batch.num_rows
            for i, own in _suspects(batch, text):
                good, spans = find(own)
                for _, _, kind in good:
                    numbers[kind, i] += 1
                base[i], every[i] = written(good), written(spans)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, numbers), pa.array(base), pa.array(every)], [key, *counts, "base", "spans"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(released(run), f"{key} {kind}, {', '.join(f'{c} long' for c in counts)}, base string, spans string")


def redacted(docs: DataFrame, model: dict, text: str = "text", size: str = "n_chars") -> DataFrame:
    """The rows of ``docs`` with every span replaced by its kind in brackets; overlapping spans go together under the first's kind. The
    column ``size``, if there is one, gets the new length of changed texts. All other columns stay, whatever they are called."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = finder(model)
        for batch in batches:
            changed = {}
            for i, own in _suspects(batch, text):
                parts, done = [], 0
                spans = find(own)[1]
                for k, (start, end, kind) in enumerate(spans):
                    if start >= done or k == 0:
                        parts += [own[done:start], f"[{KINDS[kind].upper()}]"]
                    done = max(done, end)
                if spans:
                    changed[i] = "".join([*parts, own[done:]])
            if changed:
                texts = batch.column(text).to_pylist()
                for i, new in changed.items():
                    texts[i] = new
                at = batch.schema.get_field_index(text)
                batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
                if size in batch.schema.names:
                    at = batch.schema.get_field_index(size)
                    lengths = batch.column(at).to_pylist()
                    for i, new in changed.items():
                        lengths[i] = len(new)
                    batch = batch.set_column(at, batch.schema.field(at), pa.array(lengths, batch.schema.field(at).type))
            yield batch

    return docs.mapInArrow(released(run), docs.schema)
