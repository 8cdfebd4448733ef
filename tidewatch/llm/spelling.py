"""Spelling variants: words that differ by one code point, and the form that
each of them most likely stands for.

Generated edits are looked up in Bloom filters before anything is shuffled.
Every word probes its deletions in the filter of the words one shorter, and
its replacements in the filter of its own length; insertions are the deletions
of the other word. Filters are blocked (a probe reads one block of 512 bits)
and sharded by word length, so a length that no word has costs no probe. Only
positives, as (key of the edit, word, edit), travel to an exact join with the
vocabulary; two words that share a key are told apart by their texts, so false
positives and hash collisions both end there.

The filters take at most ``FILTER_BYTES`` in all, whatever the vocabulary: a
larger one gets fewer bits per word, which lets more false positives into the
join but loses none of the pairs. Keys of edits follow from the prefix hashes
of a word, without writing the edits out, so a word of any length costs time
and memory in proportion to it.

Defined cases: a null text has no words, a null id counts as empty text in the
damage hash; an empty table gives an empty result; repeated rows count each
time; ties among near words go to the smallest in code-point order; words of
any length are compared whole; other columns are ignored, so clashing names do
no harm.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import as_bytes, cut, mix64, schema_of, table_batch

RUN = r"[A-Za-zÀ-ÿ]+"
LETTERS = np.array([*range(97, 123), *range(0xC0, 0x100)], np.uint64)  # what a lower-cased run may hold
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FILTER_BYTES = 32 << 20
BLOCK, PROBES = 512, 8
CHUNK = 128  # blocks of a filter that travel as one row
_BASE = np.uint64(0x9E3779B97F4A7C15)


def damaged_runs(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", every: int = 199) -> DataFrame:
    """(run): each lower-cased run of letters of the texts; where ``every``
    divides the crc32 of ``<id>:<run>``, it lacks the code point at crc32
    modulo its length."""
    runs = F.explode(F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(RUN), F.lit(0)))
    frame = (docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), runs.alias("run"))
             .withColumn("run", F.translate("run", UPPER, LOWER)))
    h = F.crc32(F.concat_ws(":", "id", "run").cast("binary"))
    at = (h % F.length("run")).cast("int")
    run = F.col("run")
    return frame.select(F.when(h % every == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run))))
                        .otherwise(run).alias("run"))


def vocabulary(runs: DataFrame, shortest: int = 6, least: int = 5) -> DataFrame:
    """(word, n): runs of at least ``shortest`` code points that occur at least
    ``least`` times."""
    return (runs.where(F.length("run") >= shortest).groupBy(F.col("run").alias("word"))
            .agg(F.count("*").alias("n")).where(F.col("n") >= least))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE)
    out[:1] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


def _codes(words: list[bytes]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """length -> (places, code points) of the words of that length."""
    by_length: dict[int, list] = {}
    for i, w in enumerate(words):
        points = np.frombuffer(w.decode().encode("utf-32-le"), "<u4")
        by_length.setdefault(len(points), []).append((i, points))
    return {n: (np.array([i for i, _ in some]), np.stack([p for _, p in some]).astype(np.uint64))
            for n, some in by_length.items()}


def keys(points: np.ndarray) -> np.ndarray:
    """64-bit keys of words of one length (a polynomial of their code points)."""
    with np.errstate(over="ignore"):
        return mix64((points * _powers(points.shape[1])[::-1]).sum(axis=1, dtype=np.uint64) + np.uint64(points.shape[1]))


def deletions(points: np.ndarray) -> np.ndarray:
    """(words, places) keys of the words without the code point at a place."""
    n = points.shape[1]
    power = _powers(n)
    with np.errstate(over="ignore"):
        tail = np.zeros((len(points), n), np.uint64)
        tail[:, :-1] = np.cumsum((points * power[::-1])[:, :0:-1], axis=1, dtype=np.uint64)[:, ::-1]
        # what stands before a place moves up by one, and so loses one power
        head = np.zeros((len(points), n), np.uint64)
        head[:, 1:] = np.cumsum(points[:, :-1] * power[: n - 1][::-1], axis=1, dtype=np.uint64)
        return mix64(head + tail + np.uint64(n - 1))


def replacements(points: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """(words, places from lo to hi, letters) keys of the words with a letter
    in the place of a smaller one; 0 where it is not smaller."""
    n = points.shape[1]
    power = _powers(n)[::-1]
    with np.errstate(over="ignore"):
        whole = (points * power).sum(axis=1, dtype=np.uint64) + np.uint64(n)
        change = (LETTERS[None, None, :] - points[:, lo:hi, None]) * power[None, lo:hi, None]
        out = mix64(whole[:, None, None] + change)
    out[LETTERS[None, None, :] <= points[:, lo:hi, None]] = 0
    return out


def _bits(found: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """The block of each key, and its ``PROBES`` bits in there."""
    block = (found >> np.uint64(32)) % np.uint64(blocks)
    step = mix64(found ^ _BASE)
    return block, (step[..., None] >> (np.uint64(7) * np.arange(PROBES, dtype=np.uint64))) & np.uint64(BLOCK - 1)


class Filters:
    """Blocked Bloom filters by word length: length -> (blocks, 64) bytes."""

    def __init__(self, shards: dict[int, np.ndarray]):
        self.shards = shards

    def may_hold(self, length: int, found: np.ndarray) -> np.ndarray:
        shard = self.shards.get(length)
        if shard is None:
            return np.zeros(found.shape, bool)
        block, bit = _bits(found, len(shard))
        return ((shard[block[..., None], bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1).all(axis=-1)


def sizes(lengths: dict[int, int], most: int = FILTER_BYTES, per_word: int = 16) -> dict[int, int]:
    """Blocks of each length's filter: ``per_word`` bits for a word, or fewer,
    so that all of them stay within ``most`` bytes. Lengths are given the rest
    in ascending order; one for which no block is left has no filter (-1) and
    all its probes count as positive."""
    total = sum(lengths.values())
    share = min(per_word, 8 * most / max(1, total))
    room, out = most // (BLOCK // 8), {}
    for length, n in sorted(lengths.items()):
        blocks = min(room, max(1, int(n * share) // BLOCK))
        out[length] = blocks or -1
        room -= blocks
    return out


def filters(words: DataFrame, most: int = FILTER_BYTES) -> Filters:
    """The filters over ``words`` (word): set bits are joined within each task
    and then by chunk; the driver gets the finished chunks, ``most`` bytes."""
    lengths = {r["length"]: r["n"] for r in words.groupBy(F.length("word").alias("length")).agg(F.count("*").alias("n")).collect()}
    blocks = sizes(lengths, most)
    spark_schema, arrow = schema_of("length int, chunk int, bits binary")

    def chunks(it, of):
        held: dict[tuple[int, int], np.ndarray] = {}
        for b in it:
            for key, part in of(b):
                if key in held:
                    held[key] |= part
                else:
                    held[key] = part
        if held:
            yield table_batch({"length": [k[0] for k in held], "chunk": [k[1] for k in held],
                               "bits": [v.tobytes() for v in held.values()]}, arrow)

    def set_bits(b):
        for length, (_, points) in _codes(as_bytes(b.column("word"))).items():
            if blocks[length] < 0:
                continue
            block, bit = _bits(keys(points), blocks[length])
            for chunk in np.unique(block // np.uint64(CHUNK)):
                own = block // np.uint64(CHUNK) == chunk
                part = np.zeros((CHUNK, BLOCK // 8), np.uint8)
                rows = np.broadcast_to((block[own] % np.uint64(CHUNK))[:, None], bit[own].shape)
                np.bitwise_or.at(part, (rows, bit[own] >> np.uint64(3)), np.uint8(1) << (bit[own] & np.uint64(7)).astype(np.uint8))
                yield (length, int(chunk)), part

    def joined(b):
        for length, chunk, bits in zip(*(b.column(c).to_pylist() for c in ("length", "chunk", "bits")), strict=True):
            yield (length, chunk), np.frombuffer(bits, np.uint8).reshape(CHUNK, BLOCK // 8).copy()

    parts = words.select("word").mapInArrow(lambda it: chunks(it, set_bits), spark_schema)
    whole = parts.repartition("length", "chunk").mapInArrow(lambda it: chunks(it, joined), spark_schema)
    shards = {length: np.zeros((-(-n // CHUNK) * CHUNK, BLOCK // 8), np.uint8) for length, n in blocks.items() if n > 0}
    for r in whole.toLocalIterator():
        shards[r["length"]][r["chunk"] * CHUNK : (r["chunk"] + 1) * CHUNK] |= np.frombuffer(r["bits"], np.uint8).reshape(CHUNK, -1)
    return Filters({length: shard[: blocks[length]] for length, shard in shards.items()}
                   | {length: np.full((1, BLOCK // 8), 255, np.uint8) for length, n in blocks.items() if n < 0})


def positives(words: DataFrame, known: Filters) -> DataFrame:
    """(key, word, at, letter): the edits of the words that a filter may hold:
    the code point at ``at`` left out (letter null) or replaced."""
    spark_schema, arrow = schema_of("key long, word string, at int, letter string")
    shared = words.sparkSession.sparkContext.broadcast(known.shards)
    at_once = 1 << 18

    def probes(length, points, held):
        """(rows, places, letters or None, keys) of the positives."""
        if length - 1 in held.shards:
            step = max(1, at_once // length)
            for lo in range(0, len(points), step):
                some = points[lo : lo + step]
                found = deletions(some)
                hit = held.may_hold(length - 1, found)
                hit[:, 1:] &= some[:, 1:] != some[:, :-1]  # places of a run of one letter give one edit
                row, at = np.nonzero(hit)
                yield lo + row, at, None, found[row, at]
        wide = max(1, min(length, at_once // len(LETTERS)))
        step = max(1, at_once // (wide * len(LETTERS)))
        for lo in range(0, len(points), step):
            for first in range(0, length, wide):
                found = replacements(points[lo : lo + step], first, first + wide)
                row, at, letter = np.nonzero(found)
                value = found[row, at, letter]
                hit = held.may_hold(length, value)
                yield lo + row[hit], first + at[hit], letter[hit], value[hit]

    def run(it):
        held = Filters(shared.value)
        letters = [chr(c) for c in LETTERS]
        for b in it:
            words_ = b.column("word").to_pylist()
            for length, (places, points) in _codes(as_bytes(b.column("word"))).items():
                step = max(1, (4 << 20) // length)
                for row, at, letter, found in probes(length, points, held):
                    for lo in range(0, len(row), step):
                        part = slice(lo, lo + step)
                        yield table_batch({
                            "key": found[part].view(np.int64), "word": [words_[i] for i in places[row[part]]], "at": at[part],
                            "letter": [None] * len(at[part]) if letter is None else [letters[i] for i in letter[part]]}, arrow)

    # a vocabulary is small on disk for the work it makes: one task for each shuffle partition
    tasks = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return words.select("word").repartition(tasks, "word").mapInArrow(run, spark_schema)


def keyed(words: DataFrame) -> DataFrame:
    """``words`` (word, n) with the key of each word."""
    spark_schema, arrow = schema_of("word string, n long, key long")

    def run(it):
        for b in it:
            out = np.zeros(b.num_rows, np.uint64)
            for places, points in _codes(as_bytes(b.column("word"))).values():
                out[places] = keys(points)
            yield table_batch({"word": b.column("word"), "n": b.column("n"), "key": out.view(np.int64)}, arrow)

    return words.select("word", "n").mapInArrow(run, spark_schema)


def near_pairs(words: DataFrame, most: int = FILTER_BYTES) -> DataFrame:
    """words (word, n) -> (word, near, near_n), both ways round."""
    vocabulary_ = cut(keyed(words), "vocabulary")
    edits = positives(vocabulary_, filters(vocabulary_, most))
    edit = F.concat(F.substring("word", F.lit(1), F.col("at")), F.coalesce("letter", F.lit("")),
                    F.substring("word", F.col("at") + 2, F.length("word")))
    met = (edits.join(vocabulary_.select("key", F.col("word").alias("near"), F.col("n").alias("near_n")), "key")
           .where(edit == F.col("near")).select("word", "near", "near_n"))
    one_way = cut(met.join(vocabulary_.select("word", "n"), "word"), "near")
    return one_way.select("word", "near", "near_n").union(
        one_way.select(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")))


def forms(words: DataFrame, pairs: DataFrame, times: int = 5) -> DataFrame:
    """words (word, n) -> (word, n, n_near, form, form_n): the near word of
    largest count, if that is at least ``times`` the word's own."""
    best = pairs.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best"))
    found = words.join(best, "word", "left")
    enough = -F.col("best.m") >= times * F.col("n")
    return found.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                        F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.m")).alias("form_n"))


def roots(found: DataFrame) -> DataFrame:
    """``found`` (word, form, ..) with root: the end of the way from form to
    form. Counts grow along it, so it has an end; each round doubles the part
    of it that is known."""
    links = cut(found.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = cut(links.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                              F.col("next").isNotNull().alias("moved")), "roots")
        links = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return found.join(links, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op12_spelling(docs: DataFrame) -> DataFrame:
    words = cut(vocabulary(damaged_runs(docs)), "words")
    found = cut(forms(words, near_pairs(words)), "forms")
    return roots(found).select("word", "form", "root", "n", "n_near", "form_n")


#: DuckDB: crc32 by its byte table, once for each run of a document; near
#: words by the word with one place left out, or with a gap in its place.
OP12_SQL = r"""
WITH RECURSIVE
crc_table AS (SELECT list_transform(range(256), lambda b: list_reduce([b] || range(8),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents) GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(list_reduce([4294967295] || list_transform(range(octet_length(encode(tagged))),
      lambda i: ('0x' || substr(hex(encode(tagged)), 2 * i + 1, 2))::BIGINT),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM (SELECT run, n, coalesce(doc_id::VARCHAR, '') || ':' || run AS tagged FROM runs), crc_table),
words AS (
  SELECT CASE WHEN h % 199 = 0 THEN run[: h % length(run)] || run[h % length(run) + 2 :] ELSE run END AS word, sum(n)::BIGINT AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 6 AND sum(n) >= 5),
gaps AS (SELECT word, n, i, word[: i] AS a, word[i + 2 :] AS b FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
pairs AS (
  SELECT g.word, h.word AS near, h.n AS near_n FROM gaps g JOIN gaps h ON g.a = h.a AND g.b = h.b AND g.word <> h.word
  UNION SELECT g.word, w.word, w.n FROM gaps g JOIN words w ON w.word = g.a || g.b
  UNION SELECT w.word, g.word, g.n FROM gaps g JOIN words w ON w.word = g.a || g.b),
best AS (
  SELECT word, count(*) AS n_near, max(near_n) AS top FROM pairs GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near,
    (SELECT min(p.near) FROM pairs p WHERE p.word = w.word AND p.near_n = b.top AND b.top >= 5 * w.n) AS form,
    CASE WHEN b.top >= 5 * w.n THEN b.top END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word),
ways(word, root) AS (
  SELECT word, word FROM forms
  UNION ALL SELECT y.word, f.form FROM ways y JOIN forms f ON f.word = y.root WHERE f.form IS NOT NULL),
ends AS (SELECT y.word, y.root FROM ways y JOIN forms f ON f.word = y.root WHERE f.form IS NULL)
SELECT f.word, f.form, e.root, f.n, f.n_near, f.form_n FROM forms f JOIN ends e ON e.word = f.word
"""
