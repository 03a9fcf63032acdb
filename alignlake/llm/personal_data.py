"""Personal data by fixed expressions and a skip-chain conditional random field.

Base spans come from four expressions with their checks. Tokens with a digit, ``@`` or ``+`` are then the
nodes of a random field per document with the labels none, email, ip, card, phone:

* node potentials from token shapes, chain potentials between tokens that only white space parts;
* skip potentials between tokens that are equal or similar: same letters and digits, or the
  same last seven digits. Each occurrence is linked to a hub: the first one observed, for each observed label,
  or the first of all if none is observed. So what one occurrence shows reaches all others over one link, however many there are.

Loopy belief propagation runs over all links of a batch at once, for each document until its messages rest (at most
``ROUNDS``, for loops that never do). Nodes inside base spans are observed.
Runs of equally labelled nodes become further spans if the posterior is high, the form allows the
kind, and either skip links, over any number of them, tie the run to an observed one of its label or the run is a complete number or address.
All other tokens have one possible label, none, and need no node.

The field is trained in numpy by pseudo-likelihood on a bounded sample of documents (``SAMPLE_DOCS``, the first by a
hash of id and text among a share of all; of each at most ``SAMPLE_NODES`` nodes), labelled by the base spans. It does not depend on how rows are dealt. Without a sample no spans are added.

Null texts are empty. Rows with equal texts get equal spans. Other columns are ignored; an empty table gives
an empty result. Spans are ``kind:start:end`` in code points, end exclusive, ordered by kind as listed, then start.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
LABELS = len(KINDS) + 1
SAMPLE_DOCS, SAMPLE_NODES = 3000, 200
ROUNDS, STILL, SURE = 1000, 1e-3, 0.9
MARKS = 50_000  # characters that may belong to nodes, of the texts that are worked on at once
ROWS = 20_000
SPANS = "array<struct<kind:int,start:int,stop:int,base:boolean>>"

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")  # a match never starts inside a run of digits
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
MARK = re.compile(r"[0-9@+]")
CHUNK = re.compile(r"\S+")
EDGE = "\"'()[]{}<>,;:!?#*$%&|."


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from each ``@`` so that text without one costs nothing."""
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            found.append((start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    return found


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, stop) of the base kinds, in the order of the result."""
    spans = [(0, a, b) for a, b in emails(text)]
    spans += [(1, *m.span()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        d = only_digits(m[0])
        if 16 <= len(d) <= 19 and luhn(d):
            spans.append((2, *m.span()))
    spans += [(3, *m.span()) for m in PHONE.finditer(text) if 8 <= len(only_digits(m[0])) <= 15]
    return spans


def nodes(text: str) -> list[tuple[int, int, str]]:
    """(start, stop, token) of the chunks with a mark, less punctuation at their ends."""
    found, at = [], 0
    while m := MARK.search(text, at):
        start = m.start()
        while start > 0 and not text[start - 1].isspace():
            start -= 1
        stop = CHUNK.match(text, start).end()
        a, b = start, stop
        while a < b and text[a] in EDGE and not (text[a] == "(" and ")" in text[a:b]):
            a += 1
        while a < b and text[b - 1] in EDGE and not (text[b - 1] == ")" and "(" in text[a:b]):
            b -= 1
        if a < b:
            found.append((a, b, text[a:b]))
        at = stop
    return found


def shape(token: str) -> list[int]:
    """Indices of the features that hold; ``FEATURES`` in all."""
    d, dots = len(only_digits(token)), token.count(".")
    letters = sum(c.isalpha() for c in token)
    parts = token.split(".")
    dotted = len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) < 4 and int(p) <= 255 for p in parts)
    at = token.find("@")
    on = [0, 1 + min(d, 20), 22 + min(dots, 5), 28 + min(letters, 6), 35 + min(len(token) // 4, 8)]
    flags = (token.isascii() and token.isdigit(), at > 0, at > 0 and "." in token[at:], token[0] == "+", "-" in token,
             token[0] == "(" and token[-1] == ")", dotted, 16 <= d <= 19 and luhn(only_digits(token)), "=" in token or ":" in token)
    return on + [44 + i for i, f in enumerate(flags) if f]


FEATURES = 53


def possible(token: str) -> list[bool]:
    """Which labels the token can have as (a part of) an entity."""
    d = only_digits(token)
    plain = not any(c.isalpha() for c in token)
    return [True, "@" in token, plain and token.count(".") == 3, plain and bool(d), plain and bool(d)]


def links(found: list[tuple[int, int, str]], text: str, label: list[int]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Chain links between neighbours and skip links from equal or similar tokens to their hubs, by node index."""
    chain = [(i, i + 1) for i in range(len(found) - 1) if not text[found[i][1] : found[i + 1][0]].strip(" \t()")]
    groups: dict[tuple, list[int]] = {}
    for i, (_, _, token) in enumerate(found):
        d = only_digits(token)
        keys = [("same", "".join(c for c in token.lower() if c.isalnum()))]
        if len(d) >= 7:
            keys.append(("digits", d[-7:]))
        for key in keys:
            if len(key[1]) >= 4:
                groups.setdefault(key, []).append(i)
    skip = set()
    for members in groups.values():
        seen: dict[int, int] = {}
        for i in members:
            if label[i]:
                seen.setdefault(label[i], i)
        hubs = list(seen.values()) or members[:1]
        skip |= {(min(i, hub), max(i, hub)) for hub in hubs for i in members if i != hub}
    return chain, sorted(skip)


def connected(n: int, pairs: np.ndarray) -> np.ndarray:
    """The smallest node that each node is linked to, over any number of links."""
    parent = list(range(n))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, j in pairs.tolist():
        a, b = sorted((root(i), root(j)))
        parent[b] = a
    return np.array([root(i) for i in range(n)], np.int64)


class Graph:
    """All nodes and links of a batch of texts."""

    def __init__(self, texts: list[str], base: list[list[tuple[int, int, int]]], most: int | None = None):
        self.doc, self.spans, self.tokens, self.label = [], [], [], []
        chain, skip = [], []
        for k, text in enumerate(texts):
            found = nodes(text) if text else []
            found = found[:most] if most else found
            offset = len(self.tokens)
            for a, b, token in found:
                self.doc.append(k)
                self.spans.append((a, b))
                self.tokens.append(token)
                self.label.append(next((kind + 1 for kind, s, e in base[k] if s < b and a < e), 0))
            c, s = links(found, text, self.label[offset:]) if len(found) > 1 else ([], [])
            chain += [(i + offset, j + offset) for i, j in c]
            skip += [(i + offset, j + offset) for i, j in s]
        self.chain, self.skip = (np.array(x, np.int64).reshape(-1, 2) for x in (chain, skip))
        self.label = np.array(self.label, np.int64)
        self.on = [shape(t) for t in self.tokens]
        self.can = np.array([possible(t) for t in self.tokens], bool).reshape(-1, LABELS)

    def design(self, low: int = 0, high: int | None = None) -> np.ndarray:
        rows = self.on[low:high]
        x = np.zeros((len(rows), FEATURES))
        for row, on in zip(x, rows, strict=True):
            row[on] = 1
        return x

    def scores(self, weights: np.ndarray) -> np.ndarray:
        """Node potentials, some rows at a time."""
        out = np.empty((len(self.on), LABELS))
        for low in range(0, len(self.on), ROWS):
            out[low : low + ROWS] = self.design(low, low + ROWS) @ weights
        return out


def train(graph: Graph, steps: int = 200, rate: float = 0.5, decay: float = 1e-3) -> dict[str, np.ndarray]:
    """Weights by pseudo-likelihood: each node given the labels of its neighbours."""
    x, n = graph.design(), len(graph.tokens)
    one = np.eye(LABELS)[graph.label]
    before, after, far = (np.zeros((n, LABELS)) for _ in range(3))
    np.add.at(before, graph.chain[:, 1], one[graph.chain[:, 0]])
    np.add.at(after, graph.chain[:, 0], one[graph.chain[:, 1]])
    np.add.at(far, graph.skip[:, 0], one[graph.skip[:, 1]])
    np.add.at(far, graph.skip[:, 1], one[graph.skip[:, 0]])
    inputs = [x, before, after, far]
    weights = [np.zeros((i.shape[1], LABELS)) for i in inputs]
    sums = [np.full_like(w, 1e-8) for w in weights]
    closed = np.where(graph.can | (one > 0), 0, -30.0)
    share = 1 / np.maximum(1, np.bincount(graph.label, minlength=LABELS))[graph.label][:, None] / LABELS
    for _ in range(steps):
        score = sum(i @ w for i, w in zip(inputs, weights, strict=True)) + closed
        p = np.exp(score - score.max(1, keepdims=True))
        error = (one - p / p.sum(1, keepdims=True)) * share
        for i, w, s in zip(inputs, weights, sums, strict=True):
            g = i.T @ error - decay * w
            s += g * g
            w += rate * g / np.sqrt(s)
    return {"node": weights[0], "chain": (weights[1].T + weights[2]) / 2, "skip": (weights[3] + weights[3].T) / 2}


def posteriors(graph: Graph, model: dict[str, np.ndarray]) -> np.ndarray:
    """Node beliefs after loopy sum-product with damping; observed nodes keep their label."""
    own = graph.scores(model["node"]) + np.where(graph.can, 0, -30.0)
    seen = graph.label > 0
    own[seen] = -30.0
    own[seen, graph.label[seen]] = 0
    ends = np.concatenate([graph.chain, graph.chain[:, ::-1], graph.skip, graph.skip[:, ::-1]])
    c, s = len(graph.chain), len(graph.skip)
    source, target = ends[:, 0], ends[:, 1]
    back = np.concatenate([np.arange(c, 2 * c), np.arange(c), 2 * c + np.arange(s, 2 * s), 2 * c + np.arange(s)])
    pair = np.concatenate([np.broadcast_to(m, (k, LABELS, LABELS)) for m, k in
                           ((model["chain"], c), (model["chain"].T, c), (model["skip"], s), (model["skip"], s))])
    sent = np.zeros((len(ends), LABELS))
    home = np.array(graph.doc, np.int64)[target]
    live = np.arange(len(ends))
    # each document ends by its own messages, so that its result does not depend on the others of the batch
    for _ in range(ROUNDS):
        if not len(live):
            break
        belief = own.copy()
        np.add.at(belief, target[live], sent[live])
        inner = (belief[source[live]] - sent[back[live]])[:, :, None] + pair[live]
        top = inner.max(1, keepdims=True)
        new = (top + np.log(np.exp(inner - top).sum(1, keepdims=True)))[:, 0]
        new = new - new.max(1, keepdims=True)
        moved = np.zeros(graph.doc[-1] + 1)
        np.maximum.at(moved, home[live], np.abs(new - sent[live]).max(1))
        sent[live] = 0.5 * sent[live] + 0.5 * new
        live = live[moved[home[live]] > STILL]
    belief = own.copy()
    np.add.at(belief, target, sent)
    p = np.exp(belief - belief.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def whole(kind: int, text: str) -> bool:
    """Whether a run of tokens has the form of its kind."""
    d = only_digits(text)
    if kind == 0:
        return text.count("@") == 1 and "." in text.split("@")[1]
    if kind == 1:
        parts = text.split(".")
        return len(parts) == 4 and all(p.isascii() and p.isdigit() and int(p) <= 255 for p in parts)
    return 16 <= len(d) <= 19 and luhn(d) if kind == 2 else 10 <= len(d) <= 15 and any(c in text for c in " ()-.")


def complete_parts(kind: int, spans: list[tuple[int, int]], text: str, tied: np.ndarray) -> list[tuple[int, int]]:
    """The run cut into its longest complete parts, from the left; tokens outside them only where they are tied."""
    parts, i = [], 0
    while i < len(spans):
        j = next((j for j in range(min(len(spans), i + 8), i, -1) if whole(kind, text[spans[i][0] : spans[j - 1][1]])), i)
        if j > i:
            parts.append((spans[i][0], spans[j - 1][1]))
        elif tied[i]:
            parts.append(spans[i])
        i = max(j, i + 1)
    return parts


def added_spans(texts: list[str], base: list[list[tuple[int, int, int]]], model: dict[str, np.ndarray] | None) -> list[list[tuple[int, int, int]]]:
    """Spans of the random field besides the base spans, per text."""
    more: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if model is None:
        return more
    graph = Graph(texts, base)
    if not graph.tokens or not (graph.label == 0).any():
        return more
    p = posteriors(graph, model)
    label = np.where((p.max(1) >= SURE) & (graph.label == 0), p.argmax(1), 0)
    group = connected(len(label), graph.skip)
    seen = np.zeros((len(label), LABELS), bool)
    np.logical_or.at(seen, (group, graph.label), graph.label > 0)
    tied = seen[group, label]
    joined = {int(j) for i, j in graph.chain if label[i] == label[j]}
    i = 0
    while i < len(label):
        j = i
        while j + 1 < len(label) and j + 1 in joined:
            j += 1
        if label[i]:
            k, kind = graph.doc[i], int(label[i]) - 1
            for a, b in complete_parts(kind, [graph.spans[n] for n in range(i, j + 1)], texts[k], tied[i : j + 1]):
                if not any(s < b and a < e for _, s, e in base[k]):
                    more[k].append((kind, a, b))
        i = j + 1
    return more


def fitted(docs: DataFrame, id_column: str, text_column: str) -> dict[str, np.ndarray] | None:
    """The field, trained on the driver on the bounded sample."""
    text = F.col(f"`{text_column}`")
    n = docs.count()
    # some rows more than needed by a 63-bit hash, then the first of them in order of that hash
    draw = F.shiftrightunsigned(F.xxhash64(F.col(f"`{id_column}`"), text), 1)
    share = F.lit(True) if n <= 4 * SAMPLE_DOCS else draw < F.lit((4 * SAMPLE_DOCS << 63) // n)
    chosen = docs.filter(share)

    def excerpts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for t in batch.column(0).to_pylist():
                found = nodes(t)[:SAMPLE_NODES]
                # the nodes with the gaps between them, so that links stay what they are
                pieces = [t[max(a - 30, found[i - 1][1] if i else 0) : b + 20 if i + 1 == len(found) or found[i + 1][0] > b + 50 else found[i + 1][0]]
                          for i, (a, b, _) in enumerate(found)]
                kept.append("".join(pieces)[: 60 * SAMPLE_NODES])
            yield pa.RecordBatch.from_arrays([pa.array(kept, pa.string()), batch.column(1)], ["text", "draw"])

    marked = chosen.filter(text.rlike("[0-9@+]")).select(text.alias("text"), draw.alias("draw")).mapInArrow(excerpts, "text string, draw bigint")
    texts = [r.text for r in marked.orderBy("draw", "text").limit(SAMPLE_DOCS).collect()]
    graph = Graph(texts, [base_spans(t) for t in texts], SAMPLE_NODES)
    return train(graph) if graph.tokens and graph.label.any() else None


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut so that their texts hold about ``MARKS`` characters of nodes; a text stays whole."""
    for batch in batches:
        low, held = 0, 0
        for i, t in enumerate(batch.column(1).to_pylist()):
            marks = sum(map(t.count, "0123456789@+")) if t else 0
            if i > low and held + marks > MARKS:
                yield batch.slice(low, i - low)
                low, held = i, 0
            held += marks
        yield batch.slice(low)


def find(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, spans) of every row; ``spans`` holds kind number, start, stop and whether it is a base span."""
    model = fitted(docs, id_column, text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32()), ("base", pa.bool_())]))
        for batch in sliced(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            base = [base_spans(t) if MARK.search(t) else [] for t in texts]
            more = added_spans(texts, base, model)
            rows = [[{"kind": k, "start": a, "stop": b, "base": own} for k, a, b, own in
                     sorted([(*s, True) for s in x] + [(*s, False) for s in y])] for x, y in zip(base, more, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], [id_column, "spans"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(f"`{id_column}`"), F.col(f"`{text_column}`")).mapInArrow(run, f"`{id_column}` {kind}, spans {SPANS}")


def span_text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", names[x["kind"]], x["start"].cast("string"), x["stop"].cast("string"))), ",")


def digest(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Counts of base spans per kind, the hash of the base spans, and all spans."""
    def count(name: str) -> Column:
        kind = KINDS.index(name)
        return F.size(F.filter("spans", lambda x: x["base"] & (x["kind"] == kind))).cast("long").alias(f"n_{name}")

    base = F.filter("spans", lambda x: x["base"])
    return found.select(id_column, *map(count, KINDS), F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))
