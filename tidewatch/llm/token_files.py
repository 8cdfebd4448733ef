"""Token ids in compressed binary blocks: a static range asymmetric numeral
system (rANS) with shared frequency tables.

Texts are put in ascending id order by a range shuffle and tokenised; one
frequency table over all ids, quantised to 2**20, is shared by every block.
A block holds the ids of whole consecutive documents and decodes on its own:
its ids are dealt over interleaved lanes, and every few steps a checkpoint
keeps the lanes' states, the place in the stream and a checksum of the ids up
to the next one, so that parts of a block decode in parallel as well. Blocks
travel in Parquet (one row each), so that task commits, any shared store and
column pruning apply to them; ``codes`` is the block format itself.

Defined cases: a null text counts as empty and becomes the end id alone; an
empty table gives an empty result; rows with one id follow one another in the
order of a hash of their texts (rows that are equal in it, as they are read),
null ids come first; a document longer than a
block gets a block of its own; other columns are ignored, so clashing names
do no harm.
"""

from __future__ import annotations

import string
import struct
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import as_bytes, batches, schema_of, scratch_path, table_batch

SCALE = 20
LOW = np.uint64(1 << 31)
LANES, EVERY, BLOCK_IDS = 4096, 128, 1 << 20
_HEAD = struct.Struct("<4sBBHIIII")  # magic, version, scale, lanes, steps between checkpoints, ids, checkpoints, words
_MASK = np.uint64((1 << SCALE) - 1)
_32 = np.uint64(32)


class Table:
    """Frequencies that add up to 2**20, each id that occurs having one at least."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)

    @staticmethod
    def quantise(counts: np.ndarray) -> np.ndarray:
        total, room = counts.sum(), 1 << SCALE
        if not total:
            return np.zeros(len(counts), np.int64)
        freq = np.where(counts > 0, np.maximum(1, (counts * float(room) / total).astype(np.int64)), 0)
        over = int(freq.sum()) - room
        order = np.argsort(-freq, kind="stable")
        if over < 0:
            freq[order[0]] -= over
        while over > 0:  # take from the largest, leaving one each
            give = np.minimum(freq[order] - 1, np.maximum(1, freq[order] * over // room))
            taken = np.minimum(np.cumsum(give), over)
            freq[order] -= np.diff(taken, prepend=0)
            over = int(freq.sum()) - room
        return freq


def encode(ids: np.ndarray, table: Table, lanes: int = LANES, every: int = EVERY) -> bytes:
    """One block: header, checkpoints (offset, checksum), states, words,
    checksum. A short block takes fewer lanes, so that its states stay small."""
    n = len(ids)
    lanes = max(16, min(lanes, 1 << (n // (2 * every)).bit_length()))
    steps = -(-n // lanes)
    freq, start = table.freq[ids], table.start[ids]
    if n and not freq.all():
        raise ValueError("an id is missing from the frequency table")
    state, words, states = np.full(lanes, LOW), [None] * steps, []
    for t in range(steps - 1, -1, -1):
        f, c = freq[t * lanes : (t + 1) * lanes], start[t * lanes : (t + 1) * lanes]
        x = state[: len(f)]
        full = x >= (f << np.uint64(63 - SCALE))
        words[t] = x[full].astype(np.uint32)
        x[full] >>= _32
        q = x // f
        state[: len(f)] = (q << np.uint64(SCALE)) + (x - q * f) + c
        if t % every == 0:
            states.append(state.copy())
    states.reverse()
    sizes = np.cumsum([0, *map(len, words)])
    sums = [zlib.crc32(ids[t * lanes : (t + every) * lanes].astype("<u4").tobytes()) for t in range(0, steps, every)]
    stream = np.concatenate([np.zeros(0, np.uint32), *words]).astype("<u4")
    body = b"".join([
        _HEAD.pack(b"RANS", 1, SCALE, lanes, every, n, len(states), len(stream)),
        sizes[:-1][::every].astype("<u4").tobytes(), np.array(sums, "<u4").tobytes(),
        np.array(states, "<u8").tobytes(), stream.tobytes()])
    return body + struct.pack("<I", zlib.crc32(body))


def decode(block: bytes, table: Table, parts: range | None = None) -> np.ndarray:
    """The ids of a block, or of some of its checkpoints only."""
    magic, version, scale, lanes, every, n, marks, length = _HEAD.unpack_from(block)
    if (magic, version, scale) != (b"RANS", 1, SCALE):
        raise ValueError("not a block of this format")
    if zlib.crc32(memoryview(block)[:-4]) != struct.unpack("<I", block[-4:])[0]:
        raise ValueError("block checksum differs")
    at = _HEAD.size
    offsets = np.frombuffer(block, "<u4", marks, at)
    sums = np.frombuffer(block, "<u4", marks, at + 4 * marks)
    states = np.frombuffer(block, "<u8", marks * lanes, at + 8 * marks).reshape(marks, lanes)
    words = np.frombuffer(block, "<u4", length, at + 8 * marks + 8 * marks * lanes)
    out = []
    for k in range(marks) if parts is None else parts:
        x, p = states[k].astype(np.uint64), int(offsets[k])
        ids = np.empty(max(0, min(n, (k + 1) * every * lanes) - k * every * lanes), np.uint32)
        for lo in range(0, len(ids), lanes):
            live = x[: len(ids[lo : lo + lanes])]
            slot = live & _MASK
            s = table.symbol[slot]
            ids[lo : lo + lanes] = s
            live = table.freq[s] * (live >> np.uint64(SCALE)) + slot - table.start[s]
            need = np.flatnonzero(live < LOW)
            live[need] = (live[need] << _32) | words[p : p + len(need)]
            p += len(need)
            x[: len(live)] = live
        if zlib.crc32(ids.astype("<u4").tobytes()) != sums[k]:
            raise ValueError("checkpoint checksum differs")
        out.append(ids)
    return np.concatenate([np.zeros(0, np.uint32), *out])


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the
    others, in order, for the letters from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


_PUNCTUATION = string.punctuation.encode()


class _Words(dict):
    """ids (as little-endian bytes) of ``before`` + word, remembered until
    they take about ``limit`` bytes: a full memory becomes the old one, of
    which a word that comes again is taken over, so that two are held at most.

    A word of Latin letters with ASCII punctuation behind it consists of two
    pieces that the pre-tokenizer would cut, and one line feed within a word
    is a piece of its own; other words go through the pre-tokenizer.
    """

    def __init__(self, tokenizer, kind: str, before: str, limit: int = 40 << 20):
        super().__init__()
        self.model, self.cut = tokenizer.model.tokenize, tokenizer.pre_tokenizer.pre_tokenize_str
        self.raw = [np.array([i], kind).tobytes() for i in range(tokenizer.get_vocab_size())]
        self.before, self.letters = before, _byte_letters()
        self.first = before.replace(" ", self.letters[32])
        self.limit, self.held, self.old, self.tails = limit, 0, {}, {}
        self.bare = _Words(tokenizer, kind, "", limit // 10) if before else self

    def piece(self, letters: str) -> bytes:
        raw = self.raw
        return b"".join([raw[t.id] for t in self.model(letters)])

    def tail(self, tail: bytes) -> bytes:
        if (ids := self.tails.get(tail)) is None:
            ids = self.piece(tail.decode().replace("\n", self.letters[10]))
            if len(tail) < 8 and len(self.tails) < 10_000:
                self.tails[tail] = ids
        return ids

    def __missing__(self, word: bytes) -> bytes:
        if (ids := self.old.get(word)) is None:
            core = word.rstrip(_PUNCTUATION)
            if core.isalpha() or (not core.isascii() and max(core) < 0xC9 and core.decode(errors="replace").isalpha()):
                if len(core) < len(word):
                    ids = self[core] + self.tail(word[len(core):])
                elif core.isascii():
                    ids = self.piece(self.first + core.decode())
                else:
                    ids = self.piece(self.first + core.decode("latin-1").translate(self.letters))
            elif word.count(b"\n") == 1 and word[0] != 10:
                left, right = word.split(b"\n")
                ids = self[left] + self.tail(b"\n") + (self.bare[right] if right else b"")
            else:
                ids = b"".join([self.piece(p) for p, _ in self.cut(self.before + word.decode(errors="replace"))])
        if len(word) < 64:
            if self.held >= self.limit:
                self.old, self.held = dict(self), 0
                self.clear()
            self[word] = ids
            self.held += 120 + len(word) + len(ids)  # with the objects' own heads and the table's slot
        return ids


# fixed values: ASCII white space, and the UTF-8 beginnings of the other white space
_SPACE = np.zeros(256, bool)
_SPACE[[*range(9, 14), *range(28, 33)]] = True
_WIDE = (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80")


def _odd(texts: pa.Array, special: tuple[bytes, ...]) -> list[int]:
    """Places of the texts in which a space may not begin a word: after white
    space, beside white space outside ASCII, or in a special token."""
    wide = pa.types.is_large_string(texts.type)
    ends = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset :][: len(texts) + 1]
    seen = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    whole = seen.tobytes()
    after = np.flatnonzero(seen == 32)
    after = after[after > 0]
    found = [after[_SPACE[seen[after - 1]]]]
    for mark in (*special, *_WIDE):
        at = whole.find(mark)
        while at >= 0:
            found.append(np.array([at]))
            at = whole.find(mark, at + 1)
    return np.unique(np.searchsorted(ends - ends[0], np.concatenate(found), "right") - 1).tolist()


class Encoder:
    """Whole-text encoding by the tokenizers library, as little-endian bytes.

    A byte-level pre-tokenizer without prefix space cuts before every single
    space that follows other than white space; there a text falls into words
    that are encoded once and remembered. Texts with runs of white space or
    special tokens, and tokenizers of other kinds, are encoded whole.
    """

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = tuple(t["content"].encode() for t in spec["added_tokens"])
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 65536 else "<u4"
        cutter = spec["pre_tokenizer"] or {}
        self.by_word = (spec["model"]["type"], cutter.get("type"), spec["normalizer"], cutter.get("add_prefix_space"),
                        cutter.get("use_regex", True)) == ("BPE", "ByteLevel", None, False, True)
        self.words = _Words(self.tokenizer, self.kind, " ") if self.by_word else {}

    def whole(self, text: bytes) -> bytes:
        found = self.tokenizer.encode(text.decode(errors="replace"), add_special_tokens=False)
        return np.array(found.ids, self.kind).tobytes()

    def ids(self, texts: pa.Array) -> list[bytes]:
        """ids of each text of an Arrow string column. The words of the batch
        are made distinct first, and the ids put together by their places."""
        if not self.by_word or not len(texts):
            return [self.whole(t) for t in as_bytes(texts)]
        texts = pc.fill_null(texts, "")
        pieces = pc.split_pattern(texts, " ")
        cuts = np.diff(pieces.offsets.to_numpy(), prepend=pieces.offsets[0].as_py()).cumsum()
        coded = pieces.flatten().dictionary_encode()
        place, words = coded.indices.to_numpy(zero_copy_only=False).astype(np.int32), as_bytes(coded.dictionary)
        found = list(map(self.words.__getitem__, words))
        bare = self.words.bare
        firsts = [bare[words[place[c]]] for c in cuts[:-1]]
        place[cuts[:-1]] = np.arange(len(words), len(words) + len(firsts))
        found += firsts
        pool = np.frombuffer(b"".join(found), self.kind)
        size = np.fromiter(map(len, found), np.int32, len(found)) // pool.itemsize
        size, start = size[place], (np.cumsum(size, dtype=np.int32) - size)[place]
        ends = np.cumsum(size, dtype=np.int32)
        where = np.repeat(start - (ends - size), size)
        where += np.arange(len(where), dtype=np.int32)
        flat, stops = pool[where].tobytes(), np.concatenate([[0], ends])[cuts] * pool.itemsize
        out = [flat[lo:hi] for lo, hi in zip(stops.tolist(), stops[1:].tolist())]
        for i in _odd(texts, self.special):
            out[i] = self.whole((texts[i].as_py() or "").encode())
        return out


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def tokenise(docs: DataFrame, path: str, tokenizer: str, n_ids: int, end_id: int, text_col: str,
             id_col: str) -> DataFrame:
    """Documents in ascending id order as (part, first, id, ids): part is the
    place of the range, first the ids that stand before in that part. The last
    row of a part has no ids but ``counts``, how often each id occurs in it."""
    frame = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                        F.monotonically_increasing_id().alias("pos"))
    order = ["id", F.xxhash64("text"), "pos"]
    ordered = frame.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")
    spark_schema, arrow = schema_of(
        f"part int, first long, id {frame.schema['id'].dataType.simpleString()}, ids binary, counts binary")

    def run(it):
        encoder, part, first = _encoder(tokenizer), TaskContext.get().partitionId(), 0
        end = np.array([end_id], encoder.kind).tobytes()
        width, counts = len(end), np.zeros(n_ids, np.int64)
        for b in batches(it, at_most=12 << 20):
            ids = [x + end for x in encoder.ids(b.column("text"))]
            sizes = np.cumsum([first, *(len(x) // width for x in ids)])
            yield table_batch({"part": [part] * len(ids), "first": sizes[:-1], "id": b.column("id"), "ids": ids,
                               "counts": [None] * len(ids)}, arrow)
            first = int(sizes[-1])
            counts += np.bincount(np.frombuffer(b"".join(ids), encoder.kind), minlength=n_ids)
        if first:
            yield table_batch({"part": [part], "first": [first], "id": [None], "ids": [None],
                               "counts": [counts.astype("<i8").tobytes()]}, arrow)

    ordered.mapInArrow(run, spark_schema).write.parquet(path)
    return docs.sparkSession.read.schema(spark_schema).parquet(path)


def count_ids(tokens: DataFrame, n_ids: int) -> np.ndarray:
    """How often each id occurs: the parts' counts, added up in the tasks that
    read them and then by id, so the driver gets one row for each id."""
    spark_schema, arrow = schema_of("token int, n long")

    def run(it):
        total = np.zeros(n_ids, np.int64)
        for b in it:
            for counts in b.column("counts").to_pylist():
                total += np.frombuffer(counts, "<i8")
        some = np.flatnonzero(total)
        yield table_batch({"token": some, "n": total[some]}, arrow)

    counts = np.zeros(n_ids, np.int64)
    parts = tokens.where("counts IS NOT NULL").select("counts")
    for r in parts.mapInArrow(run, spark_schema).groupBy("token").agg(F.sum("n").alias("n")).collect():
        counts[r["token"]] = r["n"]
    return counts


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, text_col: str = "text", id_col: str = "doc_id",
          block_ids: int = BLOCK_IDS) -> None:
    """Write ``path``/table (token, freq) and ``path``/blocks, one row each:
    part, first (ids before it in its part), n_ids, doc_ids, doc_sizes, block."""
    spark = docs.sparkSession
    encoder = _encoder(tokenizer)
    kind, n_ids = encoder.kind, encoder.tokenizer.get_vocab_size()
    tokens = tokenise(docs, f"{path}/ids", tokenizer, n_ids, end_id, text_col, id_col)
    freq = Table.quantise(count_ids(tokens, n_ids))
    spark.createDataFrame([(i, int(f)) for i, f in enumerate(freq)], "token int, freq int").write.parquet(f"{path}/table")
    shared = spark.sparkContext.broadcast(freq)
    id_type = tokens.schema["id"].dataType.simpleString()
    spark_schema, arrow = schema_of(
        f"part int, first long, n_ids long, doc_ids array<{id_type}>, doc_sizes array<int>, block binary")

    def pack(rows, table):
        ids = np.frombuffer(b"".join(r[3] for r in rows), kind)
        width = ids.itemsize
        return {"part": [rows[0][0]], "first": [rows[0][1]], "n_ids": [len(ids)], "doc_ids": [[r[2] for r in rows]],
                "doc_sizes": [[len(r[3]) // width for r in rows]], "block": [encode(ids, table)]}

    def run(it):
        table, rows, held = Table(shared.value), [], 0
        limit = block_ids * np.dtype(kind).itemsize
        for b in it:
            for row in zip(*(b.column(c).to_pylist() for c in ("part", "first", "id", "ids")), strict=True):
                if rows and (row[0] != rows[0][0] or held + len(row[3]) > limit):
                    yield table_batch(pack(rows, table), arrow)
                    rows, held = [], 0
                rows.append(row)
                held += len(row[3])
        if rows:
            yield table_batch(pack(rows, table), arrow)

    rows = tokens.where("counts IS NULL").select("part", "first", "id", "ids")
    rows.mapInArrow(run, spark_schema).write.option("compression", "none").parquet(f"{path}/blocks")


def read(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Documents from the files: id, start (ids of all documents before it),
    n_tokens, ids_crc32 and, if asked for, the ids themselves."""
    freq = np.array([r["freq"] for r in spark.read.parquet(f"{path}/table").orderBy("token").collect()], np.int64)
    blocks = spark.read.parquet(f"{path}/blocks")
    # one row for each part, that is for each task that wrote
    sizes = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    before = dict(zip([r["part"] for r in sizes], np.cumsum([0, *(r["n"] for r in sizes)]).tolist()))
    shared = spark.sparkContext.broadcast((freq, before))
    id_type = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    spark_schema, arrow = schema_of(f"id {id_type}, start long, n_tokens long, ids_crc32 long"
                                    + ", ids array<int>" * with_ids)

    def run(it):
        table, starts = Table(shared.value[0]), shared.value[1]
        for b in it:
            for i in range(b.num_rows):
                part, first, names, sizes, block = (
                    b.column(c)[i].as_py() for c in ("part", "first", "doc_ids", "doc_sizes", "block"))
                ids, cuts = decode(block, table).astype("<u4"), np.cumsum([0, *sizes])
                own = [ids[lo:hi] for lo, hi in zip(cuts, cuts[1:])]
                cols = {"id": names, "start": starts[part] + first + cuts[:-1], "n_tokens": sizes,
                        "ids_crc32": [zlib.crc32(x.tobytes()) for x in own]}
                yield table_batch(cols | ({"ids": [x.tolist() for x in own]} if with_ids else {}), arrow)

    return blocks.select("part", "first", "doc_ids", "doc_sizes", "block").mapInArrow(run, spark_schema)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op4_token_files(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    path = scratch_path(docs.sparkSession, "token-files")
    write(docs, path, tokenizer or default_tokenizer(), end_id=2)
    return read(docs.sparkSession, path).withColumnRenamed("id", "doc_id")
