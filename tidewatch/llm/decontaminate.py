"""Benchmark decontamination by size-partitioned MinHash containment search.

A test item is found in a document if the document holds at least
``least`` of the item's distinct shingles (five words each, A-Z
lower-cased). Items are partitioned by their number of shingles. Within a
partition every item is represented by its lowest shingle hashes, as many as
the partition's size demands: of an item of q shingles a document above the
threshold misses at most ``q - ceil(least * q)``, so one hash more than that
cannot all be missed. A document is hashed once and probed against the
MinHashes; one common hash makes a candidate, and exact shingle containment
verifies it. Short items inside long documents are thus found with certainty.

Defined cases: null texts count as empty; a text of fewer than five words is
one shingle, its whole sequence, and an item of n < 5 words is looked up as a
sequence of n words inside documents; items without a word are found nowhere;
either table empty gives an empty result; repeated rows give one row for each
pair; other columns are ignored, so clashing names do no harm; null document
ids are carried through.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import as_bytes, batches, schema_of, shingle_hashes, table_batch, word_hashes

#: The test set travels to every executor; a larger one is refused, not cut.
MAX_ITEM_BYTES = 256 << 20


class Index:
    """Size partitions of items with their MinHashes and exact shingle sets."""

    def __init__(self, items: list[tuple[object, bytes]], size: int = 5, least: float = 0.8):
        self.size, self.least = size, least
        hashes = word_hashes()
        self.items: list[tuple[object, int, np.ndarray]] = []  # id, words in a shingle, distinct shingle hashes
        partitions: dict[tuple[int, int], list[int]] = defaultdict(list)
        for name, text in items:
            words = text.lower().split()
            if words:
                shingles = np.unique(shingle_hashes(hashes.of(words, len(words)), size))
                partitions[min(size, len(words)), int(len(shingles)).bit_length()].append(len(self.items))
                self.items.append((name, min(size, len(words)), shingles))
        # for each shingle width: sorted MinHashes and the items that own them
        self.probes: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        owners: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for (width, _), members in partitions.items():
            largest = max(len(self.items[m][2]) for m in members)
            count = largest - int(np.ceil(least * largest - 1e-9)) + 1
            for m in members:
                owners[width] += [(int(h), m) for h in self.items[m][2][:count]]
        for width, pairs in owners.items():
            pairs.sort()
            values = np.array([h for h, _ in pairs], np.uint64)
            filled = np.zeros(1 << 20, bool)
            filled[values & np.uint64((1 << 20) - 1)] = True
            self.probes[width] = values, np.array([m for _, m in pairs]), filled

    def find(self, words: np.ndarray) -> list[tuple[object, float, int]]:
        """(item, containment, shared shingles) at ``least`` or more."""
        out = []
        for width, (values, owner, filled) in self.probes.items():
            if len(words) < width:
                continue
            have = shingle_hashes(words, width)
            maybe = have[filled[have & np.uint64((1 << 20) - 1)]]
            if not len(maybe):
                continue
            lo, hi = np.searchsorted(values, maybe), np.searchsorted(values, maybe, "right")
            candidates = {int(m) for a, b in zip(lo, hi, strict=True) for m in owner[a:b]}
            if not candidates:
                continue
            have = np.unique(have)
            for m in candidates:
                name, _, shingles = self.items[m]
                at = np.minimum(np.searchsorted(have, shingles), len(have) - 1)
                shared = int((have[at] == shingles).sum())
                if shared >= self.least * len(shingles) - 1e-9:
                    out.append((name, shared / len(shingles), shared))
        return out

    def clean(self, texts: list[bytes], hashes: word_hashes) -> list[bool]:
        """Whether each text holds no item; the words of one text are held at a time."""
        split = (t.lower().split() for t in texts)
        return [not self.find(hashes.of(w, len(w))) for w in split]


def _shared_index(items: DataFrame, least: float, size: int, item_col: str, item_text: str):
    total = items.agg(F.sum(F.octet_length(item_text))).first()[0] or 0
    if total > MAX_ITEM_BYTES:
        raise ValueError(f"test items hold {total} bytes; call once for each slice of {MAX_ITEM_BYTES}")
    rows = items.select(F.col(item_col).alias("item"), F.col(item_text).alias("text")).distinct().collect()
    return items.sparkSession.sparkContext.broadcast(
        Index([(r["item"], (r["text"] or "").encode()) for r in rows], size, least))


def drop_contaminated(docs: DataFrame, items: DataFrame, least: float = 0.8, size: int = 5, text_col: str = "text",
                      item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no item; a
    narrow pass, nothing is shuffled."""
    index = _shared_index(items, least, size, item_col, item_text)

    def run(it):
        known, hashes = index.value, word_hashes()
        for b in batches(it, text_col):
            yield b.filter(pa.array(known.clean(as_bytes(b.column(text_col)), hashes), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def containment(docs: DataFrame, items: DataFrame, least: float = 0.8, size: int = 5, text_col: str = "text",
                id_col: str = "doc_id", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Pairs (id, item_id, containment, n_shared) at ``least`` or more."""
    index = _shared_index(items, least, size, item_col, item_text)
    frame = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    spark_schema, arrow = schema_of(
        f"id {frame.schema['id'].dataType.simpleString()}, item {items.schema[item_col].dataType.simpleString()}, "
        "containment double, n_shared long")

    def run(it):
        known, hashes = index.value, word_hashes()
        for b in batches(it):
            found = []
            for name, text in zip(b.column("id").to_pylist(), as_bytes(b.column("text")), strict=True):
                words = text.lower().split()
                found += [(name, *x) for x in known.find(hashes.of(words, len(words)))]
            yield table_batch(dict(zip(arrow.names, zip(*found, strict=True) if found else ((),) * 4, strict=True)), arrow)

    return frame.mapInArrow(run, spark_schema).distinct().withColumnsRenamed({"id": id_col, "item": item_col})


def op7_decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return containment(docs, benchmark).select("doc_id", "item_id", "containment", "n_shared")


#: The same by SQL: all five-word shingles of documents against those of items.
OP7_SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
b AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM benchmark),
items AS (
  SELECT item_id, least(5, len(words)) AS width,
         unnest(list_transform(range(1, greatest(2, len(words) - 3)),
                               lambda i: array_to_string(words[i:i + 4], ' '))) AS shingle
  FROM b WHERE len(words) > 0),
di AS (SELECT DISTINCT * FROM items),
widths AS (SELECT DISTINCT width FROM di),
docs AS (
  SELECT doc_id, width, unnest(list_transform(range(1, len(words) - width + 2),
                               lambda i: array_to_string(words[i:i + width - 1], ' '))) AS shingle
  FROM w, widths WHERE len(words) >= width),
dd AS (SELECT DISTINCT docs.* FROM docs WHERE shingle IN (SELECT shingle FROM di)),
sizes AS (SELECT item_id, count(*) AS n FROM di GROUP BY item_id)
SELECT dd.doc_id, di.item_id, count(*) / any_value(n)::DOUBLE AS containment, count(*) AS n_shared
FROM dd JOIN di USING (width, shingle) JOIN sizes USING (item_id)
GROUP BY dd.doc_id, di.item_id HAVING count(*) >= 0.8 * any_value(n) - 1e-9
"""
