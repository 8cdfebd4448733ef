"""Byte-level BPE by prefixes against the tiktoken library."""

import random
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tidewatch.llm import byte_bpe
from tidewatch.llm.byte_bpe import EncodedText, Piece

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
BITS = ["the ", "don", "'", "l", "re", " ", "  ", "\n", "über", "123", "!!", "ing", " a", "s", "日本", "😀", "\x1c", " "]
TEXTS = [None, "", " ", " \n\t ", "one", "don't we'LL 're", "  a   b \n\n c\t", "日本語 ünï ١٢٣ ½ ⅷ", "​  x　y",
         "😀😀 👨‍👩‍👧", "a" * 5000, "ab" * 3000, " " * 1000, "\n" * 777, "é" * 999, "<|endoftext|> as text", "x\x1cy \x85z"]


@pytest.fixture(scope="module")
def words():
    return byte_bpe.vocabulary(PATH)


@pytest.fixture(scope="module")
def theirs(words):
    return tiktoken.Encoding("test", pat_str=PATTERN, mergeable_ranks=words.rank, special_tokens={})


def expected(theirs, rows):
    out = []
    for doc_id, text in rows:
        ids = theirs.encode_ordinary(text or "")
        out.append((doc_id, len(ids), sha256(np.array(ids, "<u4").tobytes()).hexdigest(), sha256((text or "").encode()).hexdigest()))
    return sorted(map(repr, out))


def test_table_against_tiktoken(spark, theirs):
    r = random.Random(3)
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    rows += [(100 + i, "".join(r.choice(BITS) for _ in range(r.randint(0, 200)))) for i in range(60)]
    rows += [rows[4], (None, "no id"), (7, "same id"), (500, "word " * 400_000 + "x" * 300_000)]
    docs = spark.createDataFrame([(*x, "i", 1, 2) for x in rows], "doc_id long, text string, ids string, id int, decoded int")
    assert sorted(map(repr, map(tuple, byte_bpe.op11_byte_bpe(docs).collect()))) == expected(theirs, rows)
    assert byte_bpe.op11_byte_bpe(docs.limit(0)).count() == 0


def test_every_token_and_random_bytes(words, theirs):
    r, tokens = random.Random(4), list(words.rank)
    data = tokens[::7] + [bytes(r.choice(b"abcaab \n") for _ in range(r.randint(1, 30))) for _ in range(3000)]
    data += [bytes(r.randrange(256) for _ in range(r.randint(1, 20))) for _ in range(3000)]
    data += [b"".join(r.choice(tokens) for _ in range(r.randint(1, 6))) for _ in range(3000)]
    assert all(Piece(words, d).ids() == theirs._core_bpe.encode_single_piece(d) for d in data)


def test_each_prefix_ends_in_its_stored_token(words, theirs):
    data = "unbelievably überraschend 1234567".encode()
    piece = Piece(words, data)
    assert piece.lasts[1:] == [theirs._core_bpe.encode_single_piece(data[:i])[-1] for i in range(1, len(data) + 1)]


def test_a_vocabulary_that_does_not_fit_is_refused(tmp_path):
    import base64

    path = tmp_path / "ranks"
    path.write_text("".join(f"{base64.b64encode(t).decode()} {i}\n" for i, t in enumerate([b"a", b"b", b"abab"])))
    short = byte_bpe.Vocabulary(str(path))
    assert Piece(short, b"abab").ids() == [2] and Piece(short, b"ab").ids() == [0, 1]
    for encode in (lambda d: Piece(short, d.encode()).ids(), byte_bpe._Pieces(short).__getitem__):
        with pytest.raises(ValueError):
            encode("ac")


def test_both_ways_of_cutting_agree():
    import regex

    r, cut, find = random.Random(9), byte_bpe.Cutter(PATTERN), regex.compile(PATTERN).findall
    assert cut.latin != cut.any
    for _ in range(3000):
        text = "".join(chr(r.choice([r.randrange(256), r.randrange(32, 127), 32, 39, 10])) for _ in range(r.randint(0, 60)))
        assert cut(text) == find(text)
        assert cut(text + "日") == find(text + "日")
    assert byte_bpe._latin_pattern(r"\w+") is None


def test_memory_that_is_emptied_changes_nothing(words, theirs):
    r = random.Random(5)
    small = byte_bpe._Pieces(words, limit=3000)
    for _ in range(2000):
        piece = "".join(r.choice("abcdeé") for _ in range(r.randint(1, 12)))
        assert np.frombuffer(small[piece], "<u4").tolist() == theirs._core_bpe.encode_single_piece(piece.encode())
    assert small.held < 10_000


def test_bytes_replaced_within_a_piece(words, theirs):
    r, done = random.Random(6), []
    for _ in range(300):
        piece = Piece(words, bytes(r.choice(b"abcdeing") for _ in range(400)))
        lo = r.randint(0, 400)
        hi = r.randint(lo, min(400, lo + 5))
        done.append(piece.replace(lo, hi, bytes(r.choice(b"abcdeing") for _ in range(r.randint(0, 5)))))
        assert piece.ids() == Piece(words, piece.data).ids()
    assert sum(done) / len(done) < 100  # near the edit only


def test_texts_under_appends_and_edits(words, theirs):
    r = random.Random(7)
    for _ in range(400):
        text = EncodedText(words, PATTERN, "".join(r.choice(BITS) for _ in range(r.randint(0, 30))))
        for _ in range(5):
            n = len(text.text)
            lo = n if r.random() < 0.4 else r.randint(0, n)
            hi = r.randint(lo, min(n, lo + 4))
            text.replace(lo, hi, r.choice([*BITS, "", "x", " quick"]))
            assert text.ids() == theirs.encode_ordinary(text.text), text.text


def test_an_edit_leaves_the_other_pieces_alone(words):
    text = EncodedText(words, PATTERN, "one two three four five six seven eight nine ten")
    before = list(text.pieces)
    text.replace(19, 23, "FIVE")
    assert sum(p is q for p, q in zip(before, text.pieces)) >= 7
