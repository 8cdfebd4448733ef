"""Merkle manifest of a dataset: digests over all rows, and a proof for each.

Rows are the leaves of one tree per group (source), in ascending order of
their key; every three consecutive nodes become one. The trees' roots, in
order of the group, are the leaves of a last tree, whose root stands for the
dataset. Every inner node is a record (digest, children) of a content-addressed
store, kept by height.

Proofs descend: requests are grouped by the prefixes of their rank, so one row
stands for all requests below a node. From the root, each row finds its
record by digest, goes on with the children that the rank digits ask for and
collects the others. What was collected on the way is reversed in the end, so
that it runs from the leaf to the root. No key is hot: a node at one place is
met once per height, and ranks come from a range shuffle, so a source that
holds most of the rows is spread like any other.

Defined cases: a null field is ``-``; rows with a null key come first in their
group, a null group is the first one; rows with one key follow one another by
their leaf digest, and equal rows get proofs of their own places; an empty
table has no root and gives an empty result; a lone leaf is its tree's root; a
null id counts as empty text where tampering is decided; texts of any length
are hashed whole; other columns are ignored, so clashing names do no harm.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewatch.llm.common import cut

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
WIDTH = 3
CUT_EVERY = 4  # heights that one plan descends before its rows are written
_UP = f"pos div {WIDTH}"
_PATH = "array<struct<left:binary,right:binary>>"


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def leaf_digest(columns: list[Column]) -> Column:
    """Digest of a row: each field as ``-`` if null, else byte count, colon, value."""
    parts = []
    for c in columns:
        text = c.cast("string")
        parts.append(F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)))
    return _digest(F.concat(*parts))


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``name``: their place from 0 in the order of ``order``.

    A range shuffle puts them in order; each row gets its place within its
    part, and the parts' sizes, one row for each task, are added up.
    """
    placed = cut(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                 .withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_at", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("_part", before.alias("_before"))
    return (placed.withColumn("_part", part).join(offsets, "_part")
            .withColumn(name, F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1))
            .drop("_at", "_part", "_before"))


def grow(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Leaves (tree, pos, digest, size) -> records (digest, children) of the
    inner nodes by height, from 1 on, and the trees' tops (tree, digest,
    height). ``size`` is the number of leaves of the tree."""
    most = nodes.agg(F.max("size")).first()[0] or 0
    records, tops, level = [], [], nodes
    while True:
        tops.append(level.where("size = 1").select("tree", "digest", F.lit(len(records)).alias("height")))
        if most <= 1:
            break
        run = F.array_sort(F.collect_list(F.struct("pos", "digest")))
        joined = F.array_join(F.transform(F.col("children"), _hex), "")
        level = cut(level.where("size > 1")
                    .groupBy("tree", F.expr(f"(size + {WIDTH - 1}) div {WIDTH}").alias("size"), F.expr(_UP).alias("pos"))
                    .agg(run.alias("run")).withColumn("children", F.col("run.digest"))
                    .select("tree", "pos", "size", _digest(joined).alias("digest"), "children"), "manifest")
        records.append(level.select("digest", "children"))
        most = -(-most // WIDTH)
    out = tops[0]
    for t in tops[1:]:
        out = out.union(t)
    return records, out


@dataclass
class Manifest:
    """leaves: (tree, pos, digest, size) and the rows' own columns; trees:
    (tree, digest, height); the records of the trees and of the tree over
    their tops; root: (tree, digest, height), one row, none if empty."""

    leaves: DataFrame
    trees: DataFrame
    records: list[DataFrame]
    root: DataFrame
    root_records: list[DataFrame]


def build(rows: DataFrame, group: str, key: str) -> Manifest:
    """The manifest of ``rows``, which hold ``digest`` (of each row), ``group``
    and ``key``; their other columns stay with the leaves."""
    # equal rows differ by their place in the written table, so that they spread
    rows = cut(rows, "manifest-rows").withColumn("_row", F.monotonically_increasing_id())
    placed = cut(numbered(rows, [group, key, "digest", "_row"], "_place"), "manifest-leaves")
    groups = placed.groupBy(group).agg(F.min("_place").alias("_first"), F.count("*").alias("size"))
    groups = numbered(groups, ["_first"], "tree").select(F.col(group).alias("_group"), "_first", "size", "tree")
    leaves = cut(placed.join(groups, placed[group].eqNullSafe(groups["_group"]))
                 .withColumn("pos", F.col("_place") - F.col("_first"))
                 .drop("_row", "_place", "_first", "_group"), "manifest-leaves")
    records, tops = grow(leaves.select("tree", "pos", "digest", "size"))
    trees = cut(tops, "manifest-trees")
    n = trees.count()
    root_records, root = grow(trees.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), "digest",
                                           F.lit(n).cast("long").alias("size")))
    return Manifest(leaves, trees, records, root, root_records)


def _descend(tops: DataFrame, records: list[DataFrame], requests: DataFrame) -> DataFrame:
    """tops (tree, digest, height, path); requests (tree, pos, request) ->
    requests as (tree, request, digest, path), path from the root down."""
    digit = (F.col("pos") % WIDTH).cast("int").alias("digit")
    asked = [cut(requests.groupBy("tree", F.expr(_UP).alias("pos"))
                 .agg(F.collect_list(F.struct(digit, "request")).alias("below")), "asked")] if records else []
    for _ in records[1:]:
        asked.append(cut(asked[-1].groupBy("tree", F.expr(_UP).alias("pos"))
                         .agg(F.collect_list(F.struct(digit)).alias("below")), "asked"))
    # a tree of one leaf: its top is the leaf that is asked for
    out = (tops.where("height = 0").join(requests, "tree").select("tree", "request", "digest", "path"))
    front = None
    for h in range(len(records), 0, -1):
        here = tops.where(F.col("height") == h).select("tree", F.lit(0).cast("long").alias("pos"), "digest", "path")
        front = here if front is None else front.union(here)
        met = (front.join(asked[h - 1], ["tree", "pos"])
               .join(records[h - 1].dropDuplicates(["digest"]), "digest")
               .select("tree", "pos", "path", "children", F.explode("below").alias("go")))
        at = F.col("go.digit")
        rest = lambda part: F.array_join(F.transform(part, _hex), "")
        others = F.struct(F.unhex(rest(F.slice("children", F.lit(1), at))).alias("left"),
                          F.unhex(rest(F.slice("children", at + 2, F.lit(WIDTH)))).alias("right"))
        path = F.concat("path", F.array(others)).cast(_PATH).alias("path")
        child = F.element_at("children", at + 1).alias("digest")
        if h == 1:
            return out.union(met.select("tree", F.col("go.request").alias("request"), child, path))
        front = met.select("tree", (F.col("pos") * WIDTH + at).alias("pos"), child, path)
        if h % CUT_EVERY == 0:
            front = cut(front, "front")
    return out


def proofs(manifest: Manifest, requests: DataFrame) -> DataFrame:
    """requests (tree, pos, request) -> (request, leaf, subroot, root, path):
    path holds, from the leaf to the root, the hashed run's other nodes to the
    left and to the right of the way, each joined."""
    asked = requests.select("tree").distinct().select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"),
                                                      F.struct("tree").alias("request"))
    root = manifest.root.withColumn("path", F.array().cast(_PATH))
    tops = _descend(root, manifest.root_records, asked).select(F.col("request.tree").alias("tree"), "path")
    tops = cut(manifest.trees.join(tops, "tree"), "tops")
    found = _descend(tops, manifest.records, requests)
    heads = manifest.trees.select("tree", F.col("digest").alias("subroot")).crossJoin(
        F.broadcast(manifest.root.select(F.col("digest").alias("root"))))  # one row
    return (found.withColumnRenamed("digest", "leaf").join(heads, "tree")
            .select("request", "leaf", "subroot", "root", F.reverse("path").alias("path")))


def fold(leaf: Column, path: str) -> Column:
    """The root's digest, recomputed from a leaf and its path."""
    return F.aggregate(path, leaf, lambda a, x: _digest(F.concat(_hex(x["left"]), _hex(a), _hex(x["right"]))))


def proof_digest(path: str) -> Column:
    """Digest of the path's nodes, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda x: F.concat(_hex(x["left"]), _hex(x["right"]))), ""), 256)


def op13_manifest(docs: DataFrame) -> DataFrame:
    plain = [F.col(c) for c in FIELDS]
    tampered = [*plain[:-1], F.replace(plain[-1].cast("string"), F.lit("\n"), F.lit(""))]
    even = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 2 == 0
    rows = docs.select("doc_id", "source", leaf_digest(plain).alias("digest"),
                       F.when(even, leaf_digest(tampered)).alias("tampered"))
    manifest = build(rows, "source", "doc_id")
    request = F.struct("doc_id", "tampered").alias("request")
    found = proofs(manifest, manifest.leaves.select("tree", "pos", request))
    start = F.coalesce("request.tampered", "leaf")
    folded = _hex(fold(start, "path"))
    return found.select(
        F.col("request.doc_id").alias("doc_id"), _hex(F.col("leaf")).alias("leaf"), _hex(F.col("subroot")).alias("subroot"),
        _hex(F.col("root")).alias("root"), proof_digest("path").alias("proof_sha256"), folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


#: DuckDB: the same trees as lists, level by level; crc32 by its byte table.
OP13_SQL = r"""
WITH RECURSIVE
crc_table AS (SELECT list_transform(range(256), lambda b: list_reduce([b] || range(8),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
docs AS (
  SELECT row_number() OVER () AS rid, doc_id, source, text,
    (CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END) ||
    (CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END) ||
    (CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END) ||
    (CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(n_chars::VARCHAR) || ':' || n_chars END) AS head,
    doc_id IS NULL OR list_reduce([4294967295] || list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])) % 2 = 1 AS even
  FROM documents, crc_table),
leaves AS (
  SELECT rid, doc_id, source, sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END) AS leaf,
    CASE WHEN even THEN sha256(head || CASE WHEN text IS NULL THEN '-'
      ELSE strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), '') END) END AS tampered
  FROM docs),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, rid) - 1 AS pos FROM leaves),
sources AS (
  SELECT source, list(leaf ORDER BY pos) AS nodes, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree
  FROM placed GROUP BY source),
levels(tree, lvl, nodes) AS (
  SELECT tree, 0, nodes FROM sources
  UNION ALL
  SELECT tree, lvl + 1, list_transform(range((len(nodes) + 2) // 3),
    lambda i: sha256(array_to_string(nodes[3 * i + 1 : 3 * i + 3], ''))) FROM levels WHERE len(nodes) > 1),
subroots AS (SELECT tree, nodes[1] AS subroot FROM levels WHERE len(nodes) = 1),
top_levels(lvl, nodes) AS (
  SELECT 0, list(subroot ORDER BY tree) FROM subroots HAVING count(*) > 0
  UNION ALL
  SELECT lvl + 1, list_transform(range((len(nodes) + 2) // 3),
    lambda i: sha256(array_to_string(nodes[3 * i + 1 : 3 * i + 3], ''))) FROM top_levels WHERE len(nodes) > 1),
root AS (SELECT nodes[1] AS root FROM top_levels WHERE len(nodes) = 1),
steps AS (
  SELECT p.rid, l.lvl, p.pos // (3 ** l.lvl)::BIGINT AS place, l.nodes
  FROM placed p JOIN sources s ON p.source IS NOT DISTINCT FROM s.source JOIN levels l ON l.tree = s.tree AND len(l.nodes) > 1
  UNION ALL
  SELECT p.rid, 1000 + l.lvl, s.tree // (3 ** l.lvl)::BIGINT, l.nodes
  FROM placed p JOIN sources s ON p.source IS NOT DISTINCT FROM s.source JOIN top_levels l ON len(l.nodes) > 1),
sides AS (
  SELECT rid, lvl, array_to_string(nodes[place // 3 * 3 + 1 : place], '') AS lft,
    array_to_string(nodes[place + 2 : place // 3 * 3 + 3], '') AS rgt FROM steps),
paths AS (SELECT rid, list({'lft': lft, 'rgt': rgt} ORDER BY lvl) AS path FROM sides GROUP BY rid),
folds(rid, k, h) AS (
  SELECT rid, 0, coalesce(tampered, leaf) FROM leaves
  UNION ALL
  SELECT f.rid, k + 1, sha256(path[k + 1].lft || h || path[k + 1].rgt) FROM folds f JOIN paths p ON p.rid = f.rid WHERE k < len(path)),
folded AS (SELECT rid, arg_max(h, k) AS folded_root FROM folds GROUP BY rid)
SELECT p.doc_id, p.leaf, b.subroot, r.root,
  sha256(array_to_string(list_transform(coalesce(q.path, []), lambda x: x.lft || x.rgt), '')) AS proof_sha256,
  f.folded_root, f.folded_root = r.root AS verified
FROM placed p JOIN sources s ON p.source IS NOT DISTINCT FROM s.source JOIN subroots b ON b.tree = s.tree
CROSS JOIN root r LEFT JOIN paths q ON q.rid = p.rid JOIN folded f ON f.rid = p.rid
"""
