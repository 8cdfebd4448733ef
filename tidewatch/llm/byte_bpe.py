"""Byte-level BPE by prefix dynamic programming.

The encoding of every byte prefix of a piece ends in one valid token, and that
token alone is stored for each prefix: it is the one token which ends there
and whose border with the token stored before it no merge would cross. Walking
back from the end gives the whole encoding. A byte that is appended adds one
entry, and after an edit only the entries near it change: once as many entries
in a row as the longest token has bytes are the same as before, all later ones
are too.

Texts are cut into pieces by a pattern first, and each piece is encoded by
itself. ``EncodedText`` keeps the pieces of one text and follows appends and
edits; ``encode`` and ``decode`` work on tables.

Defined cases: a null text counts as empty and has no token; an empty table
gives an empty result; texts and pieces of any length are encoded whole, in
time that grows with their length; repeated rows and ids, and rows without an
id, are encoded one by one; other columns are ignored, so clashing names do no
harm. Special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import re
from bisect import bisect_left, bisect_right
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import as_bytes, batches, schema_of, table_batch

END = 1 << 60  # later than any merge
UNFIT = "the vocabulary does not hold every byte, or its ranks do not follow its merges"


@lru_cache(maxsize=2)
def read_tokens(path: str) -> dict[int, bytes]:
    """rank -> token of a file of base64 tokens and their ranks."""
    with open(path, "rb") as f:
        return {int(rank): base64.b64decode(token) for token, rank in (line.split() for line in f if line.strip())}


class Vocabulary:
    """Tokens by rank, their merge trees, and the border test."""

    def __init__(self, path: str):
        self.token = read_tokens(path)
        self.rank = {token: rank for rank, token in self.token.items()}
        self.longest = max(map(len, self.rank))
        #: for each token that merges can make: the ends of its merge tree
        #: that face a neighbour, as (part, rank of the merge that takes it in)
        self.right_side: dict[int, tuple] = {}
        self.left_side: dict[int, tuple] = {}
        for rank in sorted(self.token):
            parts = self._merge(self.token[rank], rank)
            if len(parts) == 1:
                self.right_side[rank] = self.left_side[rank] = ((self.token[rank], END),)
            elif len(parts) == 2:
                a, b = (self.rank[p] for p in parts)
                if a in self.left_side and b in self.right_side:
                    self.left_side[rank] = self._inside(self.left_side[a], rank)
                    self.right_side[rank] = self._inside(self.right_side[b], rank)
        #: every ending of such a token: its rank if it is one, else -1
        self.ending: dict[bytes, int] = {}
        for rank in self.left_side:
            token = self.token[rank]
            for i in range(1, len(token)):
                self.ending.setdefault(token[i:], -1)
            self.ending[token] = rank
        self.borders: dict[tuple[int, int], bool] = {}

    def _inside(self, side: tuple, rank: int) -> tuple:
        """The side of a token's part, as that of the token itself."""
        whole = (self.token[rank], END)
        return (*side[:-1], (side[-1][0], rank), whole)

    def _merge(self, token: bytes, below: int) -> list[bytes]:
        """The parts that merges of rank under ``below`` leave of a token."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 1:
            rank, i = min((self.rank.get(a + b, END), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank >= below:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def border(self, a: int, b: int) -> bool:
        """Whether no merge crosses the border of tokens ``a`` and ``b``.

        Merges go by rank, the left one first among equals. The parts that
        face each other at the border grow as the two tokens are built; the
        border is lost if a merge of the two comes before both are taken in.
        """
        if (known := self.borders.get((a, b))) is None:
            if len(self.borders) >= 300_000:
                self.borders.clear()
            left, right, i, j = self.right_side[a], self.left_side[b], 0, 0
            while True:
                (x, grows_x), (y, grows_y) = left[i], right[j]
                crossing = self.rank.get(x + y, END)
                if crossing < grows_x and crossing <= grows_y:
                    known = False
                    break
                if grows_x == grows_y == END:
                    known = True
                    break
                if grows_x <= grows_y:
                    i += 1
                else:
                    j += 1
            self.borders[a, b] = known
        return known

    def last(self, data: bytes, at: int, before: list[int]) -> int:
        """The last token of ``data[:at]``; before[k] is that of ``data[:k]``."""
        for k in range(at - 1, -1, -1):
            found = self.ending.get(data[k:at])
            if found is None:
                break
            if found >= 0 and (k == 0 or self.border(before[k], found)):
                return found
        raise ValueError(UNFIT)


class Piece:
    """A piece's bytes and, for each prefix, its last token."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.lasts = vocabulary, b"", [-1]
        self.append(data)

    def append(self, more: bytes) -> None:
        self.data += more
        for at in range(len(self.lasts), len(self.data) + 1):
            self.lasts.append(self.vocabulary.last(self.data, at, self.lasts))

    def replace(self, lo: int, hi: int, new: bytes) -> int:
        """Put ``new`` in the place of the bytes from lo to hi; the number of
        prefixes whose last token was computed anew."""
        old, shift = self.lasts, len(new) - (hi - lo)
        self.data = self.data[:lo] + new + self.data[hi:]
        self.lasts, same, done = old[: lo + 1], 0, 0
        for at in range(lo + 1, len(self.data) + 1):
            token = self.vocabulary.last(self.data, at, self.lasts)
            self.lasts.append(token)
            done += 1
            # a token that lies behind the edit and stood there before
            behind = at - len(self.vocabulary.token[token]) >= lo + len(new)
            same = same + 1 if behind and old[at - shift] == token else 0
            if same == self.vocabulary.longest:
                self.lasts += old[at - shift + 1 :]
                break
        return done

    def ids(self) -> list[int]:
        whole = self.vocabulary.rank.get(self.data)
        if whole is not None:  # a piece that is a token stays one, whatever the merges make of it
            return [whole]
        out, at = [], len(self.data)
        while at:
            out.append(self.lasts[at])
            at -= len(self.vocabulary.token[out[-1]])
        return out[::-1]


class EncodedText:
    """A text, its pieces and their prefix tables, under appends and edits.

    A match of the pattern looks at most as far as two characters past its
    beginning or one past its end, so a piece with two others behind it is not
    changed by what follows these.
    """

    def __init__(self, vocabulary: Vocabulary, pattern: str, text: str = ""):
        self.vocabulary, self.find = vocabulary, regex.compile(pattern).finditer
        self.text, self.starts, self.pieces = "", [], []
        self.append(text)

    def ids(self) -> list[int]:
        return [i for p in self.pieces for i in p.ids()]

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, lo: int, hi: int, new: str) -> None:
        """Put ``new`` in the place of the characters from lo to hi. Pieces
        are cut anew from the second one before the edit until a cut meets an
        old one behind it; a last piece that only grew keeps its table."""
        shift = len(new) - (hi - lo)
        self.text = self.text[:lo] + new + self.text[hi:]
        first = max(0, bisect_right(self.starts, lo) - 3)
        begin = self.starts[first] if self.starts else 0
        starts, pieces, rest = self.starts[:first], self.pieces[:first], len(self.starts)
        for m in self.find(self.text, begin):
            k = bisect_left(self.starts, m.start() - shift)
            if m.start() >= lo + len(new) and k < len(self.starts) and self.starts[k] == m.start() - shift and m.start() - shift >= hi:
                rest = k
                break
            data, at = m.group().encode(), len(starts)
            old = self.pieces[at] if at < len(self.pieces) and self.starts[at] == m.start() else None
            grew = old is not None and m.start() < lo and data.startswith(old.data)
            piece = old if grew else Piece(self.vocabulary)
            piece.append(data[len(piece.data):])
            pieces.append(piece)
            starts.append(m.start())
        self.starts = starts + [s + shift for s in self.starts[rest:]]
        self.pieces = pieces + self.pieces[rest:]


def _latin_pattern(pattern: str) -> str | None:
    """``pattern`` with its Unicode classes written out for code points below
    256, as the faster engine of the standard library reads it; None if it
    holds an escape that is no such class."""
    members = {kind: "".join(re.escape(chr(c)) for c in range(256) if regex.fullmatch(kind, chr(c)))
               for kind in (r"\p{L}", r"\p{N}", r"\s")}
    out, inside = [], False
    for part in re.findall(r"\\p\{\w+\}|\\.|.", pattern, re.DOTALL):
        if part in members:
            out.append(members[part] if inside else f"[{members[part]}]")
        elif part == r"\S" and not inside:
            out.append(f"[^{members[chr(92) + 's']}]")
        elif part[0] == "\\":
            return None
        else:
            inside = part == "[" or (inside and part != "]")
            out.append(part)
    return "".join(out)


class Cutter:
    """Cuts texts into pieces; texts of Latin-1 letters take the faster way."""

    def __init__(self, pattern: str):
        self.any = regex.compile(pattern).findall
        latin = _latin_pattern(pattern)
        self.latin = re.compile(latin).findall if latin else self.any

    def __call__(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.any(text)
        return self.latin(text)


class _Pieces(dict):
    """piece -> its ids as little-endian bytes.

    The last tokens of prefixes are remembered across pieces, and only those
    prefixes are looked at on which the answer hangs: of the tokens that end a
    piece, longest first, the valid one leaves the next prefix to ask about.
    Both memories are emptied when they hold about ``limit`` bytes.
    """

    def __init__(self, vocabulary: Vocabulary, limit: int = 80 << 20):
        super().__init__()
        self.vocabulary, self.limit, self.held, self.lasts = vocabulary, limit, 0, {}
        self.raw = {i: np.array([i], "<u4").tobytes() for i in vocabulary.token}

    def last(self, data: bytes) -> int:
        if (token := self.lasts.get(data)) is None:
            ending, border, fits = self.vocabulary.ending.get, self.vocabulary.border, []
            for k in range(len(data) - 1, -1, -1):
                if (found := ending(data[k:])) is None:
                    break
                if found >= 0:
                    fits.append((k, found))
            for k, token in reversed(fits):
                if not k or border(self.last(data[:k]), token):
                    break
            else:
                raise ValueError(UNFIT)
            self.held += 120 + len(data)
            self.lasts[data] = token
        return token

    def __missing__(self, piece: str) -> bytes:
        data = piece.encode()
        if len(data) > 64:
            return b"".join(map(self.raw.__getitem__, Piece(self.vocabulary, data).ids()))
        if self.held > self.limit:
            self.clear()
            self.lasts.clear()
            self.held = 0
        rank, token = self.vocabulary.rank.get(data), self.vocabulary.token
        out, left = [] if rank is None else [self.raw[rank]], data if rank is None else b""
        while left:
            out.append(self.raw[last := self.last(left)])
            left = left[: -len(token[last])]
        ids = self[piece] = b"".join(reversed(out))
        self.held += 200 + len(data) + len(ids)
        return ids


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, ids): the token ids of each whole text, as little-endian unsigned
    32-bit integers."""
    frame = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    spark_schema, arrow = schema_of(f"id {frame.schema['id'].dataType.simpleString()}, ids binary")

    def run(it):
        find, known = Cutter(pattern), _Pieces(vocabulary(path))
        for b in batches(it, at_most=8 << 20):
            ids = [b"".join(map(known.__getitem__, find(t.decode()))) for t in as_bytes(b.column("text"))]
            yield table_batch({"id": b.column("id"), "ids": ids}, arrow)

    return frame.mapInArrow(run, spark_schema)


def decode(tokens: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """``tokens`` with ``decoded``, the bytes that the ids stand for, in place
    of the ids."""
    rest = tokens.drop(ids_col).schema
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rest)
    spark_schema, arrow = schema_of(f"{kinds}decoded binary")

    def run(it):
        words = read_tokens(path)
        table = [words.get(i, b"") for i in range(max(words) + 1)]
        for b in batches(it, ids_col, at_most=8 << 20):
            found = [b"".join(map(table.__getitem__, np.frombuffer(x or b"", "<u4").tolist()))
                     for x in b.column(ids_col).to_pylist()]
            yield table_batch({f.name: b.column(f.name) for f in rest} | {"decoded": found}, arrow)

    return tokens.mapInArrow(run, spark_schema)


def op11_byte_bpe(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    if path is None or pattern is None:
        import public_tokenizers

        path = path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
        pattern = pattern or public_tokenizers.PATTERN
    tokens = encode(docs, path, pattern).select(
        F.col("id").alias("doc_id"), F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), "ids")
    return decode(tokens, path).withColumn("decoded_sha256", F.sha2("decoded", 256)).drop("decoded")
