"""URL filters: allow and block rules, and a logistic regression for the rest.

The regression works on hashed character n-grams of host and path and is
trained from a small labelled URL table (url, blocked), at most ``MAX_LABELS``
rows of it. A rule fits its host and all subdomains if the path starts with
the rule's path; the longest rule wins.

Defined cases: a null url, or one without ``://``, has an empty host and path
and goes to the model; an empty table gives an empty result; without labels
of both kinds the model returns the share of blocked labels (0 without any);
repeated rows give one row each; other columns are ignored, so clashing names
do no harm; null ids are carried through.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import as_bytes, mix64, schema_of, table_batch

#: Labelled rows the regression is fitted on, at most: those with the smallest hashes.
MAX_LABELS = 20_000
BUCKETS = 1 << 14
SIZES = (2, 3, 4, 5)

# Fixed values: (rule, verdict), a rule being host + path.
RULES: tuple[tuple[str, str], ...] = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    text, parts = F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return F.translate(F.regexp_extract(text, parts, 1), _UPPER, _LOWER), F.regexp_extract(text, parts, 2)


def longest_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule (host + path) that fits, or null."""
    out = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        rule_host, _, rest = rule.partition("/")
        fits = (host == rule_host) | host.endswith("." + rule_host)
        out = F.when(fits & path.startswith("/" + rest), F.lit(rule)).otherwise(out)
    return out


def features(host: bytes, path: bytes) -> np.ndarray:
    """Distinct buckets of the character n-grams of '^host$' and '^path$'."""
    out = [np.zeros(1, np.int64)]
    for side, part in enumerate((host, path), 1):
        chars = np.frombuffer(b"\x02" + part + b"\x03", np.uint8).astype(np.uint64)
        for n in SIZES:
            if len(chars) >= n:
                code = np.full(len(chars) - n + 1, side * 8 + n, np.uint64)
                for k in range(n):
                    code = (code << np.uint64(8)) + chars[k : k + len(code)]
                out.append((mix64(code) % np.uint64(BUCKETS - 1)).astype(np.int64) + 1)
    return np.unique(np.concatenate(out))


def fit(rows: list[tuple[bytes, bytes, int]], epochs: int = 8, rate: float = 0.5, decay: float = 1e-6) -> np.ndarray:
    """Weights by AdaGrad over (host, path, blocked) rows, classes weighted
    alike. Each row's features are scaled to unit length."""
    weights, seen = np.zeros(BUCKETS), np.full(BUCKETS, 1e-6)
    blocked = sum(r[2] for r in rows)
    if not rows or blocked in (0, len(rows)):
        weights[0] = 0.0 if not rows else (30.0 if blocked else -30.0)
        if not rows:
            weights[0] = -30.0
        return weights
    balance = {1: len(rows) / (2 * blocked), 0: len(rows) / (2 * (len(rows) - blocked))}
    sparse = [features(h, p) for h, p, _ in rows]
    random = np.random.default_rng(7)
    for _ in range(epochs):
        for i in random.permutation(len(rows)):
            at = sparse[i]
            scale = 1 / np.sqrt(len(at))
            p = 1 / (1 + np.exp(-np.clip(weights[at].sum() * scale, -30, 30)))
            step = balance[rows[i][2]] * (p - rows[i][2]) * scale + decay * weights[at]
            seen[at] += step * step
            weights[at] -= rate * step / np.sqrt(seen[at])
    return weights


def score(weights: np.ndarray, host: bytes, path: bytes) -> float:
    at = features(host, path)
    if abs(weights[0]) == 30.0 and not weights[1:].any():
        return float(weights[0] > 0)
    return float(1 / (1 + np.exp(-np.clip(weights[at].sum() / np.sqrt(len(at)), -30, 30))))


def train(labelled: DataFrame, max_labels: int = MAX_LABELS) -> np.ndarray:
    """Fit on a labelled table (host, path, blocked 0/1); the bounded sample
    is the distinct rows with the smallest hashes."""
    few = (labelled.where("host IS NOT NULL AND path IS NOT NULL AND blocked IS NOT NULL")
           .select("host", "path", F.col("blocked").cast("int").alias("blocked")).distinct()
           .orderBy(F.xxhash64("host", "path"), "host", "path", "blocked").limit(max_labels))
    return fit([(r["host"].encode(), r["path"].encode(), r["blocked"]) for r in few.collect()])


def judge(urls: DataFrame, weights: np.ndarray, threshold: float = 0.5) -> DataFrame:
    """``urls`` (id, host, path, rule, verdict) with ``p_block`` and the model's
    verdict where no rule gave one."""
    spark_schema, arrow = schema_of(
        f"id {urls.schema['id'].dataType.simpleString()}, host string, path string, rule string, verdict string, "
        "p_block double")
    model = urls.sparkSession.sparkContext.broadcast(weights)

    def run(it):
        w = model.value
        for b in it:
            p = [score(w, h, q) for h, q in zip(as_bytes(b.column("host")), as_bytes(b.column("path")), strict=True)]
            verdict = [v or ("block" if x >= threshold else "allow")
                       for v, x in zip(b.column("verdict").to_pylist(), p, strict=True)]
            cols = {n: b.column(n) for n in ("id", "host", "path", "rule")}
            yield table_batch(cols | {"verdict": verdict, "p_block": p}, arrow)

    return urls.mapInArrow(run, spark_schema)


def with_rules(urls: DataFrame, rules=RULES, url_col: str = "url", id_col: str = "page_id") -> DataFrame:
    host, path = url_parts(F.col(url_col))
    parts = urls.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    verdicts = dict(rules)
    rule = F.col("rule")
    verdict = F.lit(None).cast("string")
    for name, v in verdicts.items():
        verdict = F.when(rule == name, v).otherwise(verdict)
    return parts.withColumn("rule", longest_rule(F.col("host"), F.col("path"), rules)).withColumn("verdict", verdict)


def op3_url_filter(pages: DataFrame) -> DataFrame:
    """The labelled table is what the rules decide; the model judges the rest."""
    urls = with_rules(pages)
    labelled = urls.where("rule IS NOT NULL").withColumn("blocked", (F.col("verdict") == "block").cast("int"))
    return judge(urls, train(labelled)).withColumnRenamed("id", "page_id")
