"""Quality by nearest-neighbour voting in a latent-semantic space.

A text becomes a bag of hashed words, of word shapes (case, digits and
punctuation of a word) and of repetition marks; TF-IDF weights and a truncated
singular value decomposition, both from the labelled sample, take it to a
short vector. The labelled vectors (``MAX_EXAMPLES`` of each label at most)
are broadcast; the cosines of every document with all of them are exact
products of blocks, and the nearest vote with the power of their similarity.

Defined cases: null and empty texts have a zero vector and the share of good
labels as score; without labels of both kinds the score is that share (0.5
without any label); an empty table gives an empty result; repeated rows give
one row each; equal similarities vote alike in the order of the sample; other
columns are ignored, so clashing names do no harm; null ids are carried
through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import labelled
from tidewatch.llm.common import as_bytes, batches, doc_bucket, schema_of, table_batch, word_hashes

#: Labelled rows of each label that the classifier is fitted on, at most.
MAX_EXAMPLES = 2048
WORDS, SHAPES, MARKS = 1 << 12, 1 << 8, 2
FEATURES = WORDS + SHAPES + MARKS
DIMENSIONS, NEIGHBOURS, POWER = 48, 15, 4


def shape(word: bytes) -> bytes:
    """'Word,' -> b'Aa,'; runs of a kind of character count once."""
    out = bytearray()
    for c in word[:64]:
        kind = 97 if 97 <= c <= 122 or c >= 128 else 65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else c
        if not out or out[-1] != kind:
            out.append(kind)
    return bytes(out[:12])


class _Codes(word_hashes):
    """word -> 64 bits: a hash of the word, and in the lowest ones its shape."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.limit:
            self.clear()
        code = (xxhash.xxh64_intdigest(word, 7) & ~(SHAPES - 1)) | (xxhash.xxh64_intdigest(shape(word)) % SHAPES)
        self[word] = code
        return code


def bag(text: bytes, codes: _Codes) -> np.ndarray:
    """The features of a text, one entry for each occurrence."""
    words = text.split()
    code = codes.of(words, len(words))
    word = ((code >> np.uint64(20)) % np.uint64(WORDS)).astype(np.int64)
    form = (code & np.uint64(SHAPES - 1)).astype(np.int64) + WORDS
    same = np.flatnonzero(code[1:] == code[:-1]) * 0 + WORDS + SHAPES
    if len(code) < 3:
        return np.concatenate([word, form, same])
    with np.errstate(over="ignore"):
        window = np.sort(code[:-2] * np.uint64(31) + code[1:-1] * np.uint64(17) + code[2:])
    again = np.full(int((window[1:] == window[:-1]).sum()), WORDS + SHAPES + 1)
    return np.concatenate([word, form, same, again])


def counts(texts: list[bytes], codes: _Codes) -> np.ndarray:
    bags = [bag(t, codes) for t in texts]
    row = np.repeat(np.arange(len(texts)), [len(b) for b in bags])
    flat = np.concatenate([np.zeros(0, np.int64), *bags])
    return np.bincount(row * FEATURES + flat, minlength=len(texts) * FEATURES).reshape(-1, FEATURES).astype(np.float32)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


@dataclass
class Model:
    idf: np.ndarray
    basis: np.ndarray
    examples: np.ndarray
    label: np.ndarray
    prior: float

    def vectors(self, found: np.ndarray) -> np.ndarray:
        weights = np.log1p(found, out=found) * self.idf
        weights[:, :WORDS] = _unit(weights[:, :WORDS])
        weights[:, WORDS:] = _unit(weights[:, WORDS:])
        return _unit(weights @ self.basis)

    def score(self, texts: list[bytes], codes: _Codes) -> np.ndarray:
        if not len(self.label) or self.label.min() == self.label.max():
            return np.full(len(texts), self.prior)
        mine = self.vectors(counts(texts, codes))
        near = mine @ self.examples.T
        k = min(NEIGHBOURS, near.shape[1])
        at = np.argpartition(-near, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(near, at, axis=1), 0).astype(np.float64) ** POWER
        small = 1e-3  # what the prior weighs beside the votes
        return ((weight * self.label[at]).sum(axis=1) + small * self.prior) / (weight.sum(axis=1) + small)


def fit(found: np.ndarray, label: np.ndarray, prior: float, in_place: bool = False) -> Model:
    """TF-IDF and a randomised truncated SVD of the labelled counts. With
    ``in_place`` the counts are weighted where they are, and so held once."""
    if not len(label):
        return Model(np.zeros(FEATURES, np.float32), np.zeros((FEATURES, 1), np.float32), np.zeros((0, 1)), label, prior)
    idf = np.log((1 + len(label)) / (1 + np.count_nonzero(found, axis=0))).astype(np.float32) + np.float32(0.1)
    raw = found if in_place else found.copy()
    for lo in range(0, len(raw), 256):
        part = raw[lo : lo + 256]
        np.log1p(part, out=part)
        part *= idf
        part[:, :WORDS] = _unit(part[:, :WORDS])
        part[:, WORDS:] = _unit(part[:, WORDS:])
    size = min(DIMENSIONS, *raw.shape)
    probe = raw @ np.random.default_rng(11).standard_normal((FEATURES, size + 8)).astype(np.float32)
    for _ in range(3):
        probe = raw @ (raw.T @ np.linalg.qr(probe)[0])
    basis = np.linalg.svd(np.linalg.qr(probe)[0].T @ raw, full_matrices=False)[2][:size].T
    basis = np.ascontiguousarray(basis, np.float32)
    return Model(idf, basis, _unit(raw @ basis), label, prior)


def train(docs: DataFrame, labels: DataFrame, allowed, label_col: str = "quality", text_col: str = "text",
          id_col: str = "doc_id", most: int = MAX_EXAMPLES) -> Model:
    """Fit on a bounded sample of the labelled rows that ``allowed`` admits."""
    sampled = labelled.sample(labels, label_col, most, allowed, id_col)
    share = (labels.where(allowed).select(F.col(label_col).cast("double").alias("y")).where("y IN (0, 1)")
             .agg(F.avg("y")).first()[0])
    rows = sorted(labelled.texts(docs, sampled, text_col, id_col).collect(), key=lambda r: r["id"])
    codes, found = _Codes(), np.zeros((len(rows), FEATURES), np.float32)
    for lo in range(0, len(rows), 256):
        found[lo : lo + 256] = counts([(r["text"] or "").encode() for r in rows[lo : lo + 256]], codes)
    return fit(found, np.array([r["label"] for r in rows], float), 0.5 if share is None else share, in_place=True)


def score(docs: DataFrame, model: Model, text_col: str = "text", id_col: str = "doc_id", block: int = 256) -> DataFrame:
    """(id, score) of every document."""
    frame = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    spark_schema, arrow = schema_of(f"id {frame.schema['id'].dataType.simpleString()}, score double")

    def run(it):
        known, codes = shared.value, _Codes()
        for b in batches(it):
            for lo in range(0, b.num_rows, block):
                some = b.slice(lo, block)
                yield table_batch({"id": some.column("id"), "score": known.score(as_bytes(some.column("text")), codes)},
                                  arrow)

    return frame.mapInArrow(run, spark_schema).withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, model: Model, threshold: float, text_col: str = "text", block: int = 256) -> DataFrame:
    """The rows of ``docs``, with all their columns, that score ``threshold``
    or more; a narrow pass, nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(it):
        known, codes = shared.value, _Codes()
        for b in batches(it, text_col):
            for lo in range(0, b.num_rows, block):
                some = b.slice(lo, block)
                yield some.filter(pa.array(known.score(as_bytes(some.column(text_col)), codes) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def op8_quality_knn(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Learns from labelled rows whose crc32 of the id modulo 5 is not 0."""
    model = train(docs, labels, doc_bucket(5) != 0)
    return score(docs, model).select("doc_id", (doc_bucket(5) == 0).alias("held_out"), "score",
                                     (F.col("score") >= threshold).cast("int").alias("predicted"))
