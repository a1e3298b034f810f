"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages, its label says only whether the bag is good. Every passage is
encoded; gated attention weights, learned from document labels, say which passages decide; the
weighted sum of the encodings is scored. The model is fitted on a bounded sample of labelled
documents and applied to every passage of every document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilowise.llm.common import flat, slices, word_hashes, word_places

PASSAGE_WORDS = 64
SAMPLE_PER_CLASS = 2000  # labelled documents of each class that the model is fitted on
THRESHOLD = 0.7
_PAIR_BUCKETS = 48
_HIDDEN, _GATE = 24, 12
_PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_CLASSES = np.zeros(256, dtype=np.int64)  # 0 other control, 1 lower, 2 upper, 3 digit, 4 space, 5 line end, 6 non-ASCII
_CLASSES[ord("a") : ord("z") + 1], _CLASSES[ord("A") : ord("Z") + 1], _CLASSES[ord("0") : ord("9") + 1] = 1, 2, 3
_CLASSES[0x20], _CLASSES[0x0A], _CLASSES[0x80:] = 4, 5, 6
for _i, _c in enumerate(_PUNCTUATION):
    _CLASSES[_c] = 7 + _i
_N_CLASSES = 7 + len(_PUNCTUATION)
WIDTH = 4 + _N_CLASSES + _PAIR_BUCKETS


def is_held_out(doc_id: Column) -> Column:
    """Documents whose labels are never learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def passages(texts: pa.Array, size: int = PASSAGE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """A row of numbers per passage, and where the passages of each text begin (n + 1).

    A passage is a run of ``size`` words and what stands between; a text without words is one passage.
    Shares are taken over a little more than the passage has, so that a few words prove nothing.
    """
    raw, starts = flat(texts)
    first, end, upto = word_places(raw, starts)
    n_words = np.diff(upto)
    many = np.maximum(1, -(-n_words // size))
    begins = np.concatenate(([0], np.cumsum(many)))
    total = int(begins[-1])
    text_of = np.repeat(np.arange(len(many)), many)
    inside = np.arange(total) - begins[text_of]
    word_at = upto[text_of] + inside * size
    left = np.where(inside == 0, starts[text_of], first[np.minimum(word_at, len(first) - 1)] if len(first) else 0)
    stops = np.append(left[1:], len(raw))
    words = np.minimum(size, np.maximum(n_words[text_of] - inside * size, 0)).astype(float)
    n_bytes = (stops - left).astype(float)
    passage = np.repeat(np.arange(total), stops - left)
    counts = np.bincount(passage * _N_CLASSES + _CLASSES[raw], minlength=total * _N_CLASSES).reshape(total, -1)
    pairs = np.zeros((total, _PAIR_BUCKETS))
    if len(raw) > 1:
        code = (raw[:-1].astype(np.uint32) * np.uint32(2654435761) + raw[1:].astype(np.uint32) * np.uint32(40503 * 7919)) >> np.uint32(9)
        at = passage[1:] * _PAIR_BUCKETS + (code % np.uint32(_PAIR_BUCKETS)).astype(np.int64)
        pairs = np.bincount(at, minlength=total * _PAIR_BUCKETS).reshape(total, -1)
    hashes = word_hashes(raw, first, end)
    owner = np.repeat(np.arange(total), words.astype(np.int64))
    again = np.zeros((2, total))
    for step in (1, 2):
        if len(hashes) > step:
            same = (hashes[step:] == hashes[:-step]) & (owner[step:] == owner[:-step])
            again[step - 1] = np.bincount(owner[step:][same], minlength=total)
    letters = (end - first).astype(float)
    length = np.bincount(owner, weights=letters, minlength=total) / np.maximum(words, 1) if len(owner) else np.zeros(total)
    few, few_bytes = words + 8, n_bytes + 40
    columns = [np.log1p(words), length, again[0] / few, again[1] / few]
    return np.column_stack([*columns, np.sqrt(counts / few_bytes[:, None]), np.sqrt(pairs / few_bytes[:, None])]).astype(np.float32), begins


class Model:
    """Passage encoder, gated attention and scorer; numpy arrays by name."""

    def __init__(self, centre: np.ndarray, scale: np.ndarray, prior: float, seed: int = 11):
        draw = np.random.default_rng(seed).normal
        self.centre, self.scale, self.prior, self.fitted = centre, scale, prior, False
        self.p = {
            "enc": draw(0, 1 / np.sqrt(WIDTH), (WIDTH, _HIDDEN)), "enc_b": np.zeros(_HIDDEN),
            "v": draw(0, 0.3, (_HIDDEN, _GATE)), "u": draw(0, 0.3, (_HIDDEN, _GATE)), "w": draw(0, 0.3, _GATE),
            "out": draw(0, 0.3, _HIDDEN), "out_b": np.zeros(1),
        }

    def forward(self, x: np.ndarray, begins: np.ndarray) -> dict[str, np.ndarray]:
        p, at = self.p, begins[:-1]
        x = np.clip((x - self.centre) / self.scale, -8, 8)
        h = np.tanh(x @ p["enc"] + p["enc_b"])
        a, g = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-(h @ p["u"])))
        e = (a * g) @ p["w"]
        many = np.diff(begins)
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, at), many))
        weight = e / np.repeat(np.add.reduceat(e, at), many)
        z = np.add.reduceat(weight[:, None] * h, at)
        return {"x": x, "h": h, "a": a, "g": g, "weight": weight, "z": z, "score": 1 / (1 + np.exp(-(z @ p["out"] + p["out_b"])))}

    def score(self, x: np.ndarray, begins: np.ndarray) -> np.ndarray:
        return self.forward(x, begins)["score"] if self.fitted else np.full(len(begins) - 1, self.prior)

    def gradients(self, f: dict[str, np.ndarray], begins: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, many = self.p, np.diff(begins)
        d_logit = (f["score"] - y) / len(y)
        d_z = np.repeat(d_logit[:, None] * p["out"], many, axis=0)
        d_weight = (d_z * f["h"]).sum(1)
        mean = np.repeat(np.add.reduceat(f["weight"] * d_weight, begins[:-1]), many)
        d_e = f["weight"] * (d_weight - mean)
        d_a = d_e[:, None] * p["w"] * f["g"] * (1 - f["a"] ** 2)
        d_g = d_e[:, None] * p["w"] * f["a"] * f["g"] * (1 - f["g"])
        d_h = f["weight"][:, None] * d_z + d_a @ p["v"].T + d_g @ p["u"].T
        d_x = d_h * (1 - f["h"] ** 2)
        return {"enc": f["x"].T @ d_x, "enc_b": d_x.sum(0), "v": f["h"].T @ d_a, "u": f["h"].T @ d_g,
                "w": (d_e[:, None] * f["a"] * f["g"]).sum(0), "out": f["z"].T @ d_logit, "out_b": d_logit.sum(keepdims=True)}

    def fit(self, bags: list[np.ndarray], y: np.ndarray, epochs: int = 12, batch: int = 64, rate: float = 0.01, seed: int = 5) -> None:
        """Adam on the cross entropy of the document labels, with a little weight decay."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(bags))
            for at in range(0, len(order), batch):
                own = order[at : at + batch]
                begins = np.concatenate(([0], np.cumsum([len(bags[i]) for i in own])))
                x = np.concatenate([bags[i] for i in own]).astype(float)
                found = self.gradients(self.forward(x, begins), begins, y[own])
                step += 1
                for k, g in found.items():
                    g = g + 1e-4 * self.p[k]
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g**2
                    self.p[k] = self.p[k] - rate * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
        self.fitted = True


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Model:
    """A model from at most ``per_class`` labelled documents of each class that are not held out, chosen by a
    hash of the id. Labels of 1 and 0 count; a document with both is taken as 0; null labels and
    null ids are left out. Without both classes the score is the share of label 1 (0.5 without labels)."""
    known = labels.filter("quality in (0, 1) and doc_id is not null").filter(~is_held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = None
    for value in (0, 1):
        own = known.filter(F.col("quality") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = own if chosen is None else chosen.union(own)
    chosen = chosen.select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("_label"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                x, begins = passages(part.column("text"))
                bags = [x[a:b].tobytes() for a, b in zip(begins[:-1], begins[1:])]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("_label"), pa.array(bags, pa.binary())], ["doc_id", "label", "bag"])

    # At most 2 * per_class rows of labels are sent to the tasks.
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    rows = sample.select("doc_id", "text", "_label").mapInArrow(encode, "doc_id long, label int, bag binary")
    rows = sorted(rows.toLocalIterator(), key=lambda r: (r["doc_id"], r["bag"]))
    bags = [np.frombuffer(r["bag"], np.float32).reshape(-1, WIDTH) for r in rows]
    y = np.array([r["label"] for r in rows], dtype=float)
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(WIDTH), np.ones(WIDTH), float(y.mean()) if len(y) else 0.5)
    every = np.concatenate(bags).astype(float)
    model = Model(every.mean(0), every.std(0) + 0.01, float(y.mean()))
    model.fit(bags, y)
    return model


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score (0 to 1, higher is better) and predicted (1 where score >= threshold).

    Only the text is looked at; null and empty texts are one empty passage; other columns pass as they
    are, columns named score or predicted are replaced."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts], ["text"])
        scores = [sent.value.score(*passages(part.column("text"))) for part in slices(batch, "text")]
        return pa.array(np.concatenate(scores) if scores else np.zeros(0))

    out = docs.withColumn("score", scored(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def classify(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``; repeated rows score alike, an empty table
    gives an empty one."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = score(own, fit(own, labels, per_class), threshold)
    return found.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier does not reject, with their own columns.

    Null and empty texts have a score as others and go or stay by it; a score at the threshold stays. Repeated rows are
    scored alike, a row without doc_id is scored but never learned from, and an empty table gives an empty one.
    """
    model = fit(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), labels, per_class)
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("text").cast("string").alias("text"))
    kept = score(own, model, threshold).filter("predicted = 1")
    return kept.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
