"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np

from tidewatch.llm import spelling

LOW = str.maketrans(spelling.UPPER, spelling.LOWER)


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            at = h % len(run)
            count[run if h % 199 else run[:at] + run[at + 1 :]] += 1
    words = {w: n for w, n in count.items() if len(w) >= 6 and n >= 5}
    some = {w: [v for v in words if v != w and abs(len(v) - len(w)) < 2 and near(w, v)] for w in words}
    form = {}
    for w, ns in some.items():
        best = min(ns, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, words[w], len(some[w]), words.get(form[w])))
    return sorted(map(repr, out))


def corpus():
    r = random.Random(8)
    stems = ["general", "generell", "national", "möglich", "ÉTRANGER", "ßßßßßßß", "aaaaaaa", "Information", "informatiön"]
    rows = []
    for i in range(120):
        words = []
        for _ in range(80):
            w = list(r.choice(stems))
            if r.random() < 0.1:
                k, kind = r.randrange(len(w)), r.randrange(3)
                w[k : k + (kind > 0)] = ["", "", r.choice("aeiö")][kind] or ([] if kind else ["e"])
            words.append("".join(w))
        rows.append((i, r.choice([" ", ", ", "\n", "3"]).join(words)))
    long = "ab" * 20_000
    chain = " ".join(["chainer"] * 200 + ["chainex"] * 30 + ["chainyx"] * 6 + ["ties­ix"])
    rows += [(200 + i, f"{long} {long[:-1]} {long[:777]}c{long[778:]}") for i in range(6)]
    rows += [(300, chain), (301, "tiedaaa " * 25 + "tiedbbb " * 25 + "tiedabb " * 5 + "tiedaab " * 5), (302, None), (303, ""), (None, "Chainer " * 7),
             rows[3], (3, "general " * 9), (304, "×÷×÷×÷ " * 6 + "×÷×÷×ø " * 40)]
    return rows


def test_spelling_against_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, "w", 1, 2, "k") for r in rows], "doc_id long, text string, word string, n int, n_near int, key string")
    got = spelling.op12_spelling(docs).collect()
    want = brute(rows)
    assert sorted(map(repr, map(tuple, got))) == want
    assert sum(r.form is not None for r in got) > 5 and any(r.root != r.form for r in got if r.form)
    assert spelling.op12_spelling(docs.limit(0)).count() == 0


def test_any_size_of_filters_gives_the_same_pairs(spark):
    words = spelling.vocabulary(spelling.damaged_runs(spark.createDataFrame(corpus()[:120], "doc_id long, text string")))
    pairs = lambda most: sorted(map(tuple, spelling.near_pairs(words, most).collect()))
    full = pairs(spelling.FILTER_BYTES)
    assert full and pairs(64) == full and pairs(640) == full


def test_filters_let_little_through(spark):
    words = spark.createDataFrame([(f"word{i:05d}".translate(str.maketrans("0123456789", "abcdefghij")),) for i in range(20000)], "word string")
    found = spelling.filters(words)
    keys = spelling.mix64(np.arange(1, 200_000, dtype=np.uint64))
    assert found.may_hold(9, keys).mean() < 0.01 and not found.may_hold(8, keys).any()
    assert sum(s.nbytes for s in found.shards.values()) <= spelling.FILTER_BYTES
    sizes = spelling.sizes({6: 10**9, 7: 5, 8: 10**9})
    assert sum(n for n in sizes.values() if n > 0) * 64 <= spelling.FILTER_BYTES


def test_keys_of_edits_are_the_keys_of_the_edited_words():
    points = lambda w: np.array([[ord(c) for c in w]], np.uint64)
    word = "überall"
    for i in range(len(word)):
        assert spelling.deletions(points(word))[0, i] == spelling.keys(points(word[:i] + word[i + 1 :]))[0]
        for k, c in enumerate(spelling.LETTERS):
            got = spelling.replacements(points(word), i, i + 1)[0, 0, k]
            assert got == (spelling.keys(points(word[:i] + chr(c) + word[i + 1 :]))[0] if c > ord(word[i]) else 0)


def test_spelling_sql():
    rows = [r for r in corpus() if r[0] is None or not 200 <= r[0] < 206]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    assert sorted(map(repr, con.execute(spelling.OP12_SQL).fetchall())) == brute(rows)
