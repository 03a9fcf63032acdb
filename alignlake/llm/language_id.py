"""Language identification by a bidirectional gated recurrent network over bytes.

The UTF-8 bytes of a text are cut into stretches of ``STRETCH`` bytes. In each stretch one gated recurrent layer reads forwards
and one backwards; both states together give a distribution over the languages at every byte. The mean of
all bytes of the whole text is the document's distribution: its maximum is the prediction and the score.

The network is trained in numpy by backpropagation through time on a bounded sample of labelled rows: about
``SAMPLE`` stretches per language, drawn by hash from all stretches of all labelled texts, so that the size of the sample depends on
neither the table nor its longest text. Stretches that are equally labelled are equally likely to be drawn. Only text and
label are used.

Null texts and texts without a letter are ``und`` with score 0, as is every text where no label was learned. Repeated rows get
equal results. Other columns stay as they are; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STRETCH = 128
SAMPLE = 600  # stretches per language
HIDDEN = 12
STEPS, BATCH, RATE = 220, 96, 0.02
LANES = 1024  # stretches read side by side
PIECE = 1 << 21  # bytes in work at once
LETTER = re.compile(r"[^\W\d_]")
SPACE = 1 << 30


def _gates(a: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * a) + 0.5


def read(x: np.ndarray, valid: np.ndarray, inputs: np.ndarray, recurrent: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States (time, lanes, hidden) of one layer over bytes ``x`` (time, lanes); ``keep`` collects what training needs."""
    size = recurrent.shape[0]
    h = np.zeros((x.shape[1], size), np.float32)
    states = np.empty((*x.shape, size), np.float32)
    full = valid.all(1)
    for t in range(len(x)):
        own = inputs[x[t]]
        past = h @ recurrent
        zr = _gates(own[:, : 2 * size] + past[:, : 2 * size])
        z, r = zr[:, :size], zr[:, size:]
        n = np.tanh(own[:, 2 * size :] + r * past[:, 2 * size :])
        new = n + z * (h - n)
        if not full[t]:
            new *= valid[t][:, None]
        if keep is not None:
            keep.append((h, z, r, n, past[:, 2 * size :]))
        h = states[t] = new
    return states


def unread(x: np.ndarray, valid: np.ndarray, recurrent: np.ndarray, keep: list, d_states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of ``inputs`` and ``recurrent`` by backpropagation through time."""
    size = recurrent.shape[0]
    d_recurrent, d_own = np.zeros_like(recurrent), np.empty((*x.shape, 3 * size), np.float32)
    d_h = np.zeros((x.shape[1], size), np.float32)
    for t in range(len(x) - 1, -1, -1):
        h, z, r, n, past = keep[t]
        d = (d_states[t] + d_h) * valid[t][:, None]
        d_n = d * (1 - z) * (1 - n * n)
        d_z = d * (h - n) * z * (1 - z)
        d_r = d_n * past * r * (1 - r)
        g = np.concatenate([d_z, d_r, d_n * r], 1)
        d_own[t] = np.concatenate([d_z, d_r, d_n], 1)
        d_recurrent += h.T @ g
        d_h = d * z + g @ recurrent.T
    d_inputs = np.zeros((256, 3 * size), np.float32)
    np.add.at(d_inputs, x.ravel(), d_own.reshape(-1, 3 * size))
    return d_inputs, d_recurrent


def lanes(stretches: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes (time, lanes) and which of them are text."""
    size = np.array([len(s) for s in stretches])
    x = np.zeros((len(stretches), int(size.max())), np.uint8)
    for row, s in zip(x, stretches, strict=True):
        row[: len(s)] = np.frombuffer(s, np.uint8)
    return np.ascontiguousarray(x.T), np.arange(x.shape[1])[:, None] < size[None, :]


def positions(x: np.ndarray, valid: np.ndarray, model: dict[str, np.ndarray]) -> np.ndarray:
    """Distribution over the languages at every position (time, lanes, languages)."""
    forth = read(x, valid, model["in_f"], model["rec_f"])
    back = read(x[::-1], valid[::-1], model["in_b"], model["rec_b"])[::-1]
    score = forth @ model["out_f"] + back @ model["out_b"] + model["bias"]
    score -= score.max(-1, keepdims=True)
    np.exp(score, out=score)
    score /= score.sum(-1, keepdims=True)
    return score


def train(stretches: list[bytes], labels: np.ndarray, languages: int, seed: int = 3) -> dict[str, np.ndarray]:
    """Weights after ``STEPS`` steps of Adam; every language is drawn equally often."""
    rng = np.random.default_rng(seed)
    shape = {"in_f": (256, 3 * HIDDEN), "rec_f": (HIDDEN, 3 * HIDDEN), "in_b": (256, 3 * HIDDEN), "rec_b": (HIDDEN, 3 * HIDDEN),
             "out_f": (HIDDEN, languages), "out_b": (HIDDEN, languages), "bias": (languages,)}
    model = {k: (rng.standard_normal(s) * (0.3 if len(s) > 1 else 0)).astype(np.float32) for k, s in shape.items()}
    first = {k: np.zeros_like(v) for k, v in model.items()}
    second = {k: np.zeros_like(v) for k, v in model.items()}
    groups = [np.flatnonzero(labels == k) for k in range(languages)]
    for step in range(1, STEPS + 1):
        chosen = np.concatenate([rng.choice(g, max(1, BATCH // languages)) for g in groups])
        x, valid = lanes([stretches[i] for i in chosen])
        one = np.eye(languages, dtype=np.float32)[labels[chosen]]
        kept_f, kept_b = [], []
        forth = read(x, valid, model["in_f"], model["rec_f"], kept_f)
        back = read(x[::-1], valid[::-1], model["in_b"], model["rec_b"], kept_b)[::-1]
        score = forth @ model["out_f"] + back @ model["out_b"] + model["bias"]
        p = np.exp(score - score.max(-1, keepdims=True))
        d = (p / p.sum(-1, keepdims=True) - one[None]) * (valid / valid.sum())[..., None].astype(np.float32)
        grad = {"bias": d.sum((0, 1)), "out_f": np.einsum("tbh,tbl->hl", forth, d), "out_b": np.einsum("tbh,tbl->hl", back, d)}
        grad["in_f"], grad["rec_f"] = unread(x, valid, model["rec_f"], kept_f, d @ model["out_f"].T)
        grad["in_b"], grad["rec_b"] = unread(x[::-1], valid[::-1], model["rec_b"], kept_b, (d @ model["out_b"].T)[::-1])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
        rate = RATE * min(1.0, 2 * (1 - step / (STEPS + 1)))
        for k, g in grad.items():
            g = g * min(1.0, 1.0 / (norm + 1e-9))
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            model[k] -= (rate * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return model


def fitted(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "lang",
           where: Column | None = None) -> tuple[list[str], dict[str, np.ndarray] | None]:
    """Languages and network, trained on the driver on the bounded sample of the labelled rows."""
    text, label = F.col(f"`{text_column}`"), F.col(f"`{label_column}`")
    known = docs.filter(label.isNotNull() & (F.octet_length(text) > 0))
    known = known if where is None else known.filter(where)
    pieces = F.ceil(F.octet_length(text) / STRETCH).cast("int")
    totals = {r[0]: r[1] for r in known.groupBy(label).agg(F.sum(pieces)).collect()}
    names = sorted(totals)
    if len(names) < 2:
        return names, None
    share = F.coalesce(*[F.when(label == k, F.lit(int(min(1.0, 1.2 * SAMPLE / totals[k]) * SPACE))) for k in names])
    order = lambda i: F.xxhash64(F.col("id"), F.col("hash"), i)
    drawn = (
        known.select(F.col(f"`{id_column}`").alias("id"), label.alias("label"), text.cast("binary").alias("bytes"), F.xxhash64(text).alias("hash"),
                     share.alias("share"), pieces.alias("pieces"))
        .withColumn("taken", F.filter(F.sequence(F.lit(0), F.col("pieces") - 1), lambda i: F.pmod(order(i), F.lit(SPACE)) < F.col("share")))
        .filter(F.size("taken") > 0).withColumn("at", F.explode("taken"))
        .select("label", F.expr(f"substring(bytes, at * {STRETCH} + 1, {STRETCH})").alias("stretch"), order(F.col("at")).alias("o"), "id", "at"))
    rows = drawn.orderBy("o", "id", "at").limit(2 * SAMPLE * len(names)).select("label", "stretch").collect()
    labels = np.array([names.index(r.label) for r in rows])
    if len(set(labels.tolist())) < len(names):
        names = sorted({r.label for r in rows})
        labels = np.array([names.index(r.label) for r in rows])
    if len(names) < 2:
        return names, None
    return names, train([bytes(r.stretch) for r in rows], labels, len(names))


def pooled(texts: list[bytes], model: dict[str, np.ndarray]) -> np.ndarray:
    """Mean distribution over all bytes of each text."""
    stretches, owner = [], []
    for k, t in enumerate(texts):
        stretches.extend(t[i : i + STRETCH] for i in range(0, len(t), STRETCH))
        owner.extend([k] * -(-len(t) // STRETCH))
    sums = np.zeros((len(texts), len(model["bias"])))
    order = sorted(range(len(stretches)), key=lambda i: -len(stretches[i]))
    for i in range(0, len(order), LANES):
        part = order[i : i + LANES]
        x, valid = lanes([stretches[j] for j in part])
        p = positions(x, valid, model)
        np.add.at(sums, np.array(owner)[part], np.where(valid[..., None], p, 0).sum(0))
    return sums / np.maximum(1, [len(t) for t in texts])[:, None]


def predict(docs: DataFrame, names: list[str], model: dict[str, np.ndarray] | None, text_column: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``."""
    kept = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score")]
    at = [f.name for f in kept].index(text_column)

    def pieces(texts: list[str | None]) -> Iterator[list[str | None]]:
        first, size = 0, 0
        for i, t in enumerate(texts):
            size += 4 * len(t or "")
            if size > PIECE:
                yield texts[first : i + 1]
                first, size = i + 1, 0
        yield texts[first:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            languages, scores = [], []
            for texts in pieces(batch.column(at).to_pylist()):
                spoken = [i for i, t in enumerate(texts) if t and names and LETTER.search(t)]
                own, score = ["und"] * len(texts), [0.0] * len(texts)
                if spoken:
                    p = pooled([texts[i].encode() for i in spoken], model) if model else np.ones((len(spoken), 1))
                    for i, best, top in zip(spoken, p.argmax(1), p.max(1), strict=True):
                        own[i], score[i] = names[best], min(1.0, float(top))
                languages += own
                scores += score
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(languages, pa.string()), pa.array(scores, pa.float64())],
                [*batch.schema.names, "lang_pred", "score"])

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept], "lang_pred string", "score double"])
    return docs.select(*[F.col(f"`{f.name}`") for f in kept]).mapInArrow(run, schema)


def held_out(id_column: str = "doc_id") -> Column:
    """Rows that are never learned from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(f"`{id_column}`").cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "lang") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``held_out``, learned from the labelled rows that are not held out."""
    names, model = fitted(docs, id_column, text_column, label_column, ~held_out(id_column))
    return predict(docs, names, model, text_column).withColumn("held_out", held_out(id_column))
