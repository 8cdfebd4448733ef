"""SimHash near-duplicates by pivot distance tables.

A fingerprint has a bit set if it is set in over half of the hashes of the
text's shingles. For every distinct fingerprint a table holds its Hamming
distances to reference fingerprints (pivots), each distance split over bands
of the bits. Two fingerprints within ``max_bits`` differ in at most that many
bands, so they agree on all pivots in each of some ``bands - max_bits`` bands;
the distances there are the keys under which candidates meet. A candidate pair
is discarded if its distance to any pivot differs by more than ``max_bits``
(the triangle inequality), and survivors are verified bit by bit. No link is
lost.

Candidates of a key are compared in tiles of a bounded number of
fingerprints: a key with more is split into tiles that meet pairwise, and each
tile hands on a spanning forest, never its pairs. Exact copies share one
fingerprint from the start, however many they are.

Defined cases: a null text counts as empty; a text without a word has
fingerprint zero and is linked like any other; one with fewer words than a
shingle has one shingle, its whole sequence; an empty table gives an empty
result; repeated rows get the same class; rows without an id get the class of
their fingerprint and count as no id; other columns are ignored, so clashing
names do no harm.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import as_bytes, batches, cut, mix64, schema_of, table_batch
from tidewatch.llm.components import components

PIVOTS = 16
TILE = 1024


def fingerprint(text: bytes, size: int = 4) -> int:
    """SimHash over the text's shingles, repeats included (XXH64, seed 42)."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return 0
    line, n = b" ".join(words), max(1, len(words) - size + 1)
    starts = list(accumulate(map(len, words), lambda a, b: a + b + 1, initial=0))
    ends = starts[size:] if len(words) > size else [len(line) + 1]
    hashes = np.fromiter((xxh64_intdigest(line[a : b - 1], 42) for a, b in zip(starts, ends)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for lo in range(0, n, 1 << 16):
        part = hashes[lo : lo + (1 << 16)]
        ones += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = 4, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, fp): the fingerprint of each document, as a signed long."""
    frame = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    spark_schema, arrow = schema_of(f"id {frame.schema['id'].dataType.simpleString()}, fp long")

    def run(it):
        for b in batches(it, at_most=4 << 20):
            fps = np.array([fingerprint(t, size) for t in as_bytes(b.column("text"))], np.uint64)
            yield table_batch({"id": b.column("id"), "fp": fps.view(np.int64)}, arrow)

    return frame.mapInArrow(run, spark_schema)


class PivotTable:
    """Distances of 64-bit fingerprints to pivots, by bands of their bits."""

    def __init__(self, max_bits: int, bands: int):
        if not max_bits < bands <= 16:
            raise ValueError("there must be more bands than differing bits, and 16 at most")
        self.max_bits = max_bits
        self.pivots = mix64(np.arange(1, PIVOTS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        edges = [64 * b // bands for b in range(bands + 1)]
        self.masks = np.array([(1 << hi) - (1 << lo) for lo, hi in zip(edges, edges[1:])], np.uint64)
        self.subsets = list(combinations(range(bands), bands - max_bits))

    def by_band(self, fps: np.ndarray) -> np.ndarray:
        """(n, pivots, bands) distances; summed over bands: to the whole pivot."""
        return np.bitwise_count((fps[:, None, None] ^ self.pivots[None, :, None]) & self.masks[None, None, :])

    def keys(self, fps: np.ndarray) -> np.ndarray:
        """(n, subsets) keys: all pivots' distances in a subset of the bands."""
        near = self.by_band(fps).astype(np.uint64)
        with np.errstate(over="ignore"):
            place = np.uint64(65) ** np.arange(PIVOTS, dtype=np.uint64)
            band = mix64((near * place[None, :, None]).sum(axis=1) + np.arange(near.shape[2], dtype=np.uint64))
            out = np.empty((len(fps), len(self.subsets)), np.uint64)
            for k, subset in enumerate(self.subsets):
                key = np.full(len(fps), k + 1, np.uint64)
                for b in subset:
                    key = mix64(key * np.uint64(31) + band[:, b])
                out[:, k] = key
        return out

    def links(self, fps: np.ndarray) -> list[tuple[int, int]]:
        """A spanning forest of the pairs within ``max_bits``: (node, smallest)."""
        far = self.by_band(fps).sum(axis=2).astype(np.int16)
        if len(fps) == 2:
            close = np.abs(far[0] - far[1]).max() <= self.max_bits and (
                int(np.bitwise_count(fps[0] ^ fps[1])) <= self.max_bits)
            return [(1, 0)] if close else []
        near = np.zeros((len(fps), len(fps)), bool)
        for i in range(len(fps)):
            left = np.flatnonzero((np.abs(far[:, 0] - far[i, 0]) <= self.max_bits))
            left = left[np.abs(far[left] - far[i]).max(axis=1) <= self.max_bits]
            near[i, left] = np.bitwise_count(fps[left] ^ fps[i]) <= self.max_bits
        out, todo = [], np.ones(len(fps), bool)
        for root in range(len(fps)):
            if todo[root]:
                todo[root], edge = False, np.array([root])
                while len(edge):
                    edge = np.flatnonzero(near[edge].any(axis=0) & todo)
                    todo[edge] = False
                    out += [(int(x), root) for x in edge]
        return out


def links(fps: DataFrame, max_bits: int = 4, bands: int = 7) -> DataFrame:
    """Distinct fingerprints (fp) -> edges (u, v) that span the links."""
    table = PivotTable(max_bits, bands)
    key_schema, key_arrow = schema_of("key long, fp long")

    def make_keys(it):
        for b in it:
            for lo in range(0, b.num_rows, 4096):
                some = b.column("fp").slice(lo, 4096).to_numpy(zero_copy_only=False)
                keys = table.keys(some.view(np.uint64))
                yield table_batch({"key": keys.view(np.int64).ravel(), "fp": np.repeat(some, keys.shape[1])}, key_arrow)

    keyed = fps.mapInArrow(make_keys, key_schema)
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    tiles = F.ceil(F.col("n") / TILE).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    # the planner takes the keys to be as few bytes as the fingerprints, and would send all of them through the driver
    met = (keyed.hint("merge").join(shared, "key").withColumn("tiles", tiles).withColumn("own", own)
           .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
           .groupBy("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
           .agg(F.array_sort(F.collect_set("fp")).alias("fps")).where(F.size("fps") > 1).select("fps").distinct())
    edge_schema, edge_arrow = schema_of("u long, v long")

    def compare(it):
        for b in it:
            u, v = [], []
            for some in b.column("fps"):
                fps_ = np.array(some.values.to_numpy(zero_copy_only=False), np.int64)
                for a, c in table.links(fps_.view(np.uint64)):
                    u.append(fps_[a])
                    v.append(fps_[c])
            yield table_batch({"u": u, "v": v}, edge_arrow)

    return met.mapInArrow(compare, edge_schema)


def near_duplicates(docs: DataFrame, size: int = 4, max_bits: int = 4, bands: int = 7, text_col: str = "text",
                    id_col: str = "doc_id") -> DataFrame:
    """(id, fp, class_fp, component_id) of each document: its fingerprint, the
    smallest fingerprint of its class, and the smallest id in it."""
    found = cut(fingerprints(docs, size, text_col, id_col), "fingerprints")
    distinct = cut(found.groupBy("fp").agg(F.min("id").alias("least")), "distinct-fingerprints")
    roots = components(links(distinct.select("fp"), max_bits, bands))
    classes = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("class_fp"))
    least = classes.groupBy("class_fp").agg(F.min("least").alias("component_id"))
    return (found.join(classes.select("fp", "class_fp").join(least, "class_fp"), "fp")
            .select("id", "fp", "class_fp", "component_id").withColumnRenamed("id", id_col))


def keep_first(docs: DataFrame, size: int = 4, max_bits: int = 4, text_col: str = "text") -> DataFrame:
    """``docs`` without all but one row of each class. ``docs`` must be a
    written table, whose rows are numbered alike each time it is read; so equal
    ids, or none, do no harm, and columns of any name stay."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.monotonically_increasing_id().alias("at"))
    found = near_duplicates(rows.select("at", F.col(f"row.`{text_col}`").alias("text")), size, max_bits, id_col="at")
    first = cut(found.where("at = component_id").select("at"), "first-of-class")
    return rows.join(first, "at", "left_semi").select("row.*")


def op2_simhash(docs: DataFrame) -> DataFrame:
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return near_duplicates(docs).select("doc_id", hexed.alias("fingerprint"), "component_id")
