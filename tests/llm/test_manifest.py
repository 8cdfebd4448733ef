"""The Merkle manifest against a tree built by hand."""

import zlib
from hashlib import sha256

import duckdb
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import manifest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(r, text):
    fields = [None if v is None else str(v) for v in (r[0], r[3], r[2], r[4], text)]
    return H(*("-" if v is None else f"{len(v.encode())}:{v}" for v in fields))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i : i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def way(tree, pos):
    """(left, right) of each run on the way up."""
    out = []
    for nodes in tree[:-1]:
        lo = pos // 3 * 3
        out.append((nodes[lo:pos], nodes[pos + 1 : lo + 3]))
        pos //= 3
    return out


def brute(rows):
    null_first = lambda v: (v is not None, v if v is not None else 0)
    by_source = {}
    for r in rows:
        by_source.setdefault(r[3], []).append((null_first(r[0]), leaf(r, r[1]), r))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([x[1] for x in sorted(by_source[s], key=lambda x: x[:2])]) for s in names}
    top = levels([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for pos, (_, digest, r) in enumerate(sorted(by_source[s], key=lambda x: x[:2])):
            path = way(trees[s], pos) + way(top, k)
            odd = zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 2
            h = digest if odd else leaf(r, None if r[1] is None else r[1].replace("\n", ""))
            for left, right in path:
                h = H(*left, h, *right)
            out.append((r[0], digest, trees[s][-1][0], top[-1][0], H(*(x for a, b in path for x in a + b)), h,
                        h == top[-1][0]))
    return out


ROWS = [(i, ("a\nb" if i % 3 else "plain ") * (i % 7), ("en", None)[i % 2], ("hot", "hot", "b", "ü", None)[i % 5], i)
        for i in range(60)]
ROWS += [ROWS[7], ROWS[7], (None, "no\nid", "en", "hot", None), (None, None, None, None, None), (100, None, "en", "lone", 3),
         (101, "", "en", "", -4), (102, "x\n" * 300_000, "de", "b", 5), (3, "same id\n", "en", "hot", 1)]


@pytest.mark.parametrize("rows", [ROWS, ROWS[:1], ROWS[:2], []], ids=["all", "one", "two", "none"])
def test_manifest_against_brute_force(spark, rows):
    docs = spark.createDataFrame([(*r, "s", 1, 2, "p", "q") for r in rows],
                                 DOCS + ", leaf string, pos int, tree int, path string, digest string")
    got = manifest.op13_manifest(docs).collect()
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(map(repr, brute(rows)))


def test_some_leaves_and_a_forged_one(spark):
    """The operator itself: proofs of requested leaves only; a changed leaf or path does not fold to the root."""
    rows = spark.createDataFrame(ROWS[:40], DOCS).select("source", "doc_id", manifest.leaf_digest(
        [F.col(c) for c in manifest.FIELDS]).alias("digest"))
    tree = manifest.build(rows, "source", "doc_id")
    wanted = tree.leaves.where("doc_id % 9 = 4").select("tree", "pos", F.struct("doc_id").alias("request"))
    found = manifest.proofs(tree, wanted)
    other = F.concat(F.slice("path", 2, 100), F.slice("path", 1, 1))
    got = found.select("request.doc_id", (manifest.fold(F.col("leaf"), "path") == F.col("root")).alias("holds"),
                       (manifest.fold(F.unhex(F.sha2("leaf", 256)), "path") == F.col("root")).alias("forged"),
                       (manifest.fold(F.col("leaf"), other) == F.col("root")).alias("shuffled")).collect()
    assert sorted(r.doc_id for r in got) == [4, 13, 22, 31]
    assert all(r.holds and not r.forged and not r.shuffled for r in got)


def test_manifest_sql(spark):
    rows = [r for r in ROWS if r[0] != 102]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    assert sorted(map(repr, con.execute(manifest.OP13_SQL).fetchall())) == sorted(map(repr, brute(rows)))
