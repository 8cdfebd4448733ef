"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Terms are words (A-Z lower-cased, without ASCII punctuation around them) and
their beginnings of four and five characters. Terms that tell the labels apart
on the labelled sample (by chi-square, and at least ten times as frequent
under one label) form the vocabulary. The labelled examples
(``MAX_EXAMPLES`` of each label at most) stand in an inverted index whose
posting lists are cut into blocks of examples with the largest weight of each
block; blocks are visited in the order of their upper bounds and the search
ends when the next bound cannot beat the k-th best, so the neighbours are
exact. They vote with the inverse of their distance, and the vote is
calibrated on leave-one-out votes of the examples. The neighbours' ids are the
evidence.

Defined cases: null and empty texts, and texts without a term of the
vocabulary, get the share of toxic ones among the examples without a term;
without labels of both kinds the score is their share (0 without any label);
an empty table gives an empty result; repeated rows give one row each; equally
near examples are taken in the order of the index; other columns are ignored,
so clashing names do no harm; null ids are carried through.
"""

from __future__ import annotations

import string
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import labelled
from tidewatch.llm.common import as_bytes, batches, cut, doc_bucket, schema_of, table_batch

#: Labelled rows of each label that the index holds, at most.
MAX_EXAMPLES = 4096
#: Terms of the vocabulary, at most: those with the highest chi-square.
MAX_TERMS = 20_000
LEAST_CHI2, LEAST_LIFT, LEAST_DOCS, NEIGHBOURS, BLOCK = 30.0, 10.0, 4, 15, 64
_PUNCTUATION = string.punctuation.encode()


def word_terms(word: bytes) -> tuple[bytes, ...]:
    """A word and its beginnings, marked by ^."""
    bare = word.strip(_PUNCTUATION)
    if not bare or len(bare) > 64:
        return ()
    letters = bare.decode(errors="replace")
    return (bare, *(b"^" + letters[:n].encode() for n in (4, 5) if len(letters) >= n))


def term_counts(docs: DataFrame) -> DataFrame:
    """(id, label, text) -> (term, label, n): documents that hold a term."""
    spark_schema, arrow = schema_of("term binary, label int, n long")

    def run(it):
        found: dict[int, Counter] = {0: Counter(), 1: Counter()}

        def flush():
            rows = [(t, k, n) for k, c in found.items() for t, n in c.items()]
            for c in found.values():
                c.clear()
            return table_batch(dict(zip(arrow.names, zip(*rows, strict=True) if rows else ((), (), ()), strict=True)), arrow)

        for b in batches(it):
            for text, k in zip(as_bytes(b.column("text")), b.column("label").to_pylist(), strict=True):
                found[k].update({t for w in set(text.lower().split()) for t in word_terms(w)})
                if sum(map(len, found.values())) > 400_000:
                    yield flush()
        yield flush()

    return docs.select("label", "text").mapInArrow(run, spark_schema)


def vocabulary(docs: DataFrame) -> list[tuple[bytes, int]]:
    """(term, documents) of the terms that tell the labels apart."""
    sizes = {r["label"]: r["count"] for r in docs.groupBy("label").count().collect()}
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    if not n0 or not n1:
        return []
    by = term_counts(docs).groupBy("term").agg(F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("a"),
                                               F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("b"))
    a, b, n = F.col("a"), F.col("b"), float(n0 + n1)
    top = n * F.pow(a * (n1 - b) - b * (n0 - a), F.lit(2))
    low = (a + b) * (n - a - b) * float(n0) * float(n1)
    chi2 = F.when(low > 0, top / low).otherwise(n)
    more, less = F.greatest(a * n1, b * n0), F.least(a * n1, b * n0)
    rows = (by.where((a + b >= LEAST_DOCS) & (more >= LEAST_LIFT * less)).withColumn("chi2", chi2)
            .where(F.col("chi2") >= LEAST_CHI2)
            .orderBy(F.desc("chi2"), "term").limit(MAX_TERMS).collect())
    return [(bytes(r["term"]), int(r["a"] + r["b"])) for r in rows]


class Terms(dict):
    """word -> its terms' places in the vocabulary, remembered for a bounded number of words."""

    def __init__(self, vocabulary: dict[bytes, int], limit: int = 200_000):
        super().__init__()
        self.vocabulary, self.limit = vocabulary, limit

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= self.limit:
            self.clear()
        known = self.vocabulary
        found = self[word] = tuple(known[t] for t in word_terms(word) if t in known)
        return found

    def of(self, text: bytes) -> Counter:
        out: Counter = Counter()
        for hit in filter(None, map(self.__getitem__, text.lower().split())):
            out.update(hit)
        return out


class Index:
    """Labelled TF-IDF vectors in a block-max inverted index."""

    def __init__(self, terms: list[tuple[bytes, int]], rows: list[tuple[object, int, Counter]], n_docs: int):
        self.place = {t: i for i, (t, _) in enumerate(terms)}
        self.idf = np.log((1 + n_docs) / (1 + np.array([n for _, n in terms], float))) + 1
        vectors = [self.vector(c) for _, _, c in rows]
        # examples with the same strongest term stand together, which keeps the blocks' bounds low
        order = sorted(range(len(rows)), key=lambda i: (
            len(vectors[i][0]) == 0, vectors[i][0][np.argmax(vectors[i][1])] if len(vectors[i][0]) else 0, rows[i][0]))
        self.ids = [rows[i][0] for i in order]
        self.label = np.array([rows[i][1] for i in order], float)
        self.vectors = [vectors[i] for i in order]
        lists: list[list[tuple[int, float]]] = [[] for _ in terms]
        for i, (at, weight) in enumerate(self.vectors):
            for t, w in zip(at.tolist(), weight.tolist(), strict=True):
                lists[t].append((i, w))
        self.postings = [(np.array([i for i, _ in p], np.int64), np.array([w for _, w in p])) for p in lists]
        self.blocks = []
        for at, weight in self.postings:
            block, first = np.unique(at // BLOCK, return_index=True)
            highest = np.maximum.reduceat(weight, first) if len(first) else weight
            self.blocks.append((block, highest, np.append(first, len(at))))
        self.n_blocks = -(-len(rows) // BLOCK)
        none = np.array([len(at) == 0 for at, _ in self.vectors], bool)
        self.without = (self.label[none].sum(), int(none.sum()))

    def vector(self, found: Counter) -> tuple[np.ndarray, np.ndarray]:
        at = np.array(sorted(found), np.int64)
        weight = (1 + np.log(np.array([found[t] for t in at.tolist()], float))) * self.idf[at] if len(at) else np.zeros(0)
        return at, weight / max(np.linalg.norm(weight), 1e-12)

    def nearest(self, at: np.ndarray, weight: np.ndarray, k: int = NEIGHBOURS, leave: int = -1):
        """(examples, cosines) of the k nearest with a term in common, exactly."""
        bound, lists = np.zeros(self.n_blocks), []
        for t, q in zip(at.tolist(), weight.tolist(), strict=True):
            block, highest, first = self.blocks[t]
            bound[block] += q * highest
            lists.append((t, q, dict(zip(block.tolist(), range(len(block))))))
        best_at, best = np.zeros(0, np.int64), np.zeros(0)
        for b in np.argsort(-bound, kind="stable").tolist():
            if bound[b] <= 0 or (len(best) >= k and bound[b] <= best[-1] - 1e-12):
                break
            sums = np.zeros(BLOCK)
            for t, q, where in lists:
                if (j := where.get(b)) is not None:
                    first = self.blocks[t][2]
                    own, w = self.postings[t]
                    sums[own[first[j] : first[j + 1]] - b * BLOCK] += q * w[first[j] : first[j + 1]]
            got = np.flatnonzero(sums > 0)
            place, value = got + b * BLOCK, sums[got]
            if leave >= 0:
                value, place = value[place != leave], place[place != leave]
            best_at, best = np.concatenate([best_at, place]), np.concatenate([best, value])
            keep = np.lexsort((best_at, -best))[:k]
            best_at, best = best_at[keep], best[keep]
        return best_at, best

    def vote(self, at: np.ndarray, weight: np.ndarray, leave: int = -1):
        """(weighted share of toxic neighbours or None, neighbours)."""
        near, cosine = self.nearest(at, weight, leave=leave)
        if not len(near):
            return None, near
        pull = 1 / (1 - np.minimum(cosine, 1) + 0.05)
        return float((pull * self.label[near]).sum() / pull.sum()), near


def calibrate(votes: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression (pool adjacent violators): (votes, probabilities)."""
    order = np.argsort(votes, kind="stable")
    pools: list[list[float]] = []  # smallest vote, weighted labels, weight
    for i in order:
        pools.append([votes[i], label[i] * weight[i], weight[i]])
        while len(pools) > 1 and (pools[-2][0] == pools[-1][0] or pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]):
            _, y, w = pools.pop()
            pools[-1][1] += y
            pools[-1][2] += w
    return np.array([p[0] for p in pools]), np.array([p[1] / p[2] for p in pools])


class Model:
    def __init__(self, index: Index, shares: dict[int, tuple[int, int]]):
        """shares: for each label its labelled rows and those in the index."""
        self.index = index
        weight = np.array([shares[int(y)][0] / max(1, shares[int(y)][1]) for y in index.label])
        self.prior = float((weight * index.label).sum() / weight.sum()) if len(weight) else 0.0
        votes = [index.vote(*v, leave=i)[0] for i, v in enumerate(index.vectors)]
        some = np.array([v is not None for v in votes], bool)
        none = weight[~some]
        self.without = float((none * index.label[~some]).sum() / none.sum()) if len(none) else self.prior
        self.votes, self.chances = (
            calibrate(np.array([v for v in votes if v is not None]), index.label[some], weight[some])
            if some.any() else (np.zeros(1), np.array([self.prior])))

    def judge(self, found: Counter) -> tuple[float, list]:
        raw, near = self.index.vote(*self.index.vector(found)) if found else (None, [])
        if raw is None:
            return self.without, []
        return float(np.interp(raw, self.votes, self.chances)), [self.index.ids[i] for i in near[:3]]


def train(docs: DataFrame, labels: DataFrame, allowed, label_col: str = "toxic", text_col: str = "text",
          id_col: str = "doc_id", most: int = MAX_EXAMPLES) -> Model:
    sampled = cut(labelled.sample(labels, label_col, most, allowed, id_col), "toxic-sample")
    rows = cut(labelled.texts(docs, sampled, text_col, id_col), "toxic-texts")
    terms = vocabulary(rows)
    place = {t: i for i, (t, _) in enumerate(terms)}
    spark_schema, arrow = schema_of(
        f"id {rows.schema['id'].dataType.simpleString()}, label int, terms array<int>, counts array<int>")

    def bags(it):
        known = Terms(place)
        for b in batches(it):
            found = [known.of(t) for t in as_bytes(b.column("text"))]
            yield table_batch({"id": b.column("id"), "label": b.column("label"),
                               "terms": [list(c) for c in found], "counts": [list(c.values()) for c in found]}, arrow)

    got = [(r["id"], r["label"], Counter(dict(zip(r["terms"], r["counts"], strict=True))))
           for r in rows.mapInArrow(bags, spark_schema).collect()]
    every = (labels.where(allowed).select(F.col(label_col).cast("int").alias("label")).where("label IN (0, 1)")
             .groupBy("label").count().collect())
    held = Counter(label for _, label, _ in got)
    shares = {r["label"]: (r["count"], held[r["label"]]) for r in every}
    return Model(Index(terms, sorted(got, key=lambda r: r[0]), len(got)), shares)


def score(docs: DataFrame, model: Model, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, score, evidence): probability and the ids of the nearest examples."""
    frame = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = frame.schema["id"].dataType.simpleString()
    spark_schema, arrow = schema_of(f"id {kind}, score double, evidence array<{kind}>")

    def run(it):
        known = shared.value
        terms = Terms(known.index.place)
        for b in batches(it):
            found = [known.judge(terms.of(t)) for t in as_bytes(b.column("text"))]
            yield table_batch({"id": b.column("id"), "score": [s for s, _ in found], "evidence": [e for _, e in found]},
                              arrow)

    return frame.mapInArrow(run, spark_schema).withColumnRenamed("id", id_col)


def op9_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Learns from labelled rows whose crc32 of the id modulo 4 is not 2."""
    model = train(docs, labels, doc_bucket(4) != 2)
    return score(docs, model).select(
        "doc_id", (doc_bucket(4) == 2).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"), "evidence")
