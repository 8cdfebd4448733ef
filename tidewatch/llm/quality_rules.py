"""Quality rules combined by weak supervision.

Each rule looks at a document's counts and votes 1 (good), 0 (poor) or -1
(abstains). Expectation-maximisation on the vote patterns estimates how often
each rule votes either way on good documents and on each kind of poor ones,
and each document gets the posterior probability of being good.

Defined cases: a null text counts as empty (no words, every ratio rule
abstains, ``base_failed``); an empty table gives an empty result; repeated
rows are judged alike, one output row each; other columns are ignored, so
clashing names do no harm; null ids are carried through.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import as_bytes, batches, cut, schema_of, table_batch

COUNTS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "n_lines long, n_upper long, n_letters long, n_exclaim long, n_distinct long")

# classes of bytes: bit 0 symbol, 1 white space, 2 upper case, 3 letter, 4 '!', 5 continuation byte
_CLASS = np.zeros(256, np.uint8)
for _c in b"#*$%&|<>":
    _CLASS[_c] |= 1
for _c in b" \t\n\x0b\x0c\r":
    _CLASS[_c] |= 2
_CLASS[65:91] |= 4 | 8
_CLASS[97:123] |= 8
_CLASS[33] |= 16
_CLASS[128:192] |= 32


def _repeated(words: list[bytes]) -> tuple[int, int]:
    """Words that lie in a 3-word window found twice or more, and distinct words."""
    ids: dict[bytes, int] = {}
    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    if len(words) < 4:
        return 0, len(ids)
    pair = codes[:-1] * len(ids) + codes[1:]
    if len(ids) > 2_000_000:  # three ids no longer fit in 63 bits
        pair = np.unique(pair, return_inverse=True)[1]
    window = pair[:-1] * len(ids) + codes[2:]
    order = np.argsort(window, kind="stable")
    same = window[order][1:] == window[order][:-1]
    if not same.any():
        return 0, len(ids)
    twice = np.zeros(len(window), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k : k + len(window)] |= twice
    return int(covered.sum()), len(ids)


def text_counts(text: bytes) -> tuple[int, ...]:
    """The values of COUNTS for one text."""
    words = text.split()
    by_class = np.bincount(_CLASS[np.frombuffer(text, np.uint8)], minlength=64) if text else np.zeros(64, int)
    bit = [int(by_class[[c for c in range(64) if c >> k & 1]].sum()) for k in range(6)]
    seen: set[bytes] = set()
    lines = repeats = 0
    for line in text.split(b"\n"):
        if line.strip():
            lines += 1
            repeats += line in seen
            seen.add(line)
    again, distinct = _repeated(words)
    return (len(words), len(text) - bit[5] - bit[1], bit[0], repeats, again, lines, bit[2], bit[3], bit[4], distinct)


def counts(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row of counts for each document."""
    frame = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    spark_schema, arrow = schema_of(f"id {frame.schema['id'].dataType.simpleString()}, {COUNTS}")
    names = arrow.names[1:]

    def run(it):
        for b in batches(it):
            rows = [text_counts(t) for t in as_bytes(b.column("text"))]
            cols = dict(zip(names, zip(*rows), strict=True)) if rows else dict.fromkeys(names, ())
            yield table_batch({"id": b.column("id"), **cols}, arrow)

    return frame.mapInArrow(run, spark_schema).withColumnRenamed("id", id_col)


RULES = ("length", "word_length", "symbols", "dup_lines", "repeats", "upper_case", "exclaim", "variety")


def _band(value: Column, poor: Column, good: Column) -> Column:
    return F.when(value.isNull(), -1).when(poor, 0).when(good, 1).otherwise(-1)


def _votes() -> dict[str, Column]:
    def share(a: str, b: str) -> Column:
        return F.col(a) / F.when(F.col(b) > 0, F.col(b))

    words, length = F.col("n_words"), share("word_chars", "n_words")
    symbols, dup = share("n_symbols", "n_words"), share("n_dup_lines", "n_lines")
    again, upper = share("n_repeat_words", "n_words"), share("n_upper", "n_letters")
    loud, fresh = share("n_exclaim", "n_words"), share("n_distinct", "n_words")
    return {
        "length": _band(words, words < 20, words >= 50),
        "word_length": _band(length, (length < 2.5) | (length > 12), (length >= 3) & (length <= 10)),
        "symbols": _band(symbols, symbols > 0.1, symbols < 0.02),
        "dup_lines": _band(dup, dup > 0.4, (dup < 0.05) & (F.col("n_lines") > 1)),
        "repeats": _band(again, again > 0.4, again < 0.1),
        "upper_case": _band(upper, upper > 0.4, upper < 0.15),
        "exclaim": _band(loud, loud > 0.2, loud < 0.02),
        "variety": _band(fresh, (fresh < 0.2) & (words < 2000), fresh > 0.35),
    }


def fit(patterns: np.ndarray, weights: np.ndarray, rounds: int = 200, smooth: float = 1.0,
        trust: float = 0.25):
    """Expectation-maximisation over distinct vote patterns.

    ``patterns`` (p, rules) holds votes 1, 0, -1 and ``weights`` (p,) how many
    documents cast them. Poor documents are poor in different ways, and most
    rules see nothing wrong with any one of them; so there is one hidden class
    of good documents and one of poor documents for each rule, which starts
    with the documents that the rule calls poor. ``trust`` is the prior belief
    that rules seldom call a good document poor: good votes on good documents,
    as many as this share of all. Abstentions say nothing either way. Returns
    the class shares, an array (class, rule, vote) of the probabilities of
    votes 0 and 1 where the rule votes (its accuracy on that class), and the
    posterior of the good class, class 0, for each pattern.
    """
    one_hot = np.stack([patterns == v for v in range(2)], axis=2).astype(float)
    poor = one_hot[:, :, 0]
    post = np.column_stack([np.where(poor.any(axis=1), 0.1, 1.0), poor / np.maximum(poor.sum(axis=1), 1)[:, None]])
    post /= post.sum(axis=1, keepdims=True)
    share = table = None
    for _ in range(rounds):
        before = post
        by_class = post * weights[:, None]
        share = (by_class.sum(axis=0) + smooth) / (weights.sum() + smooth * post.shape[1])
        table = np.einsum("pc,prv->crv", by_class, one_hot) + smooth
        table[0, :, 1] += trust * weights.sum()
        table /= table.sum(axis=2, keepdims=True)
        log = np.einsum("crv,prv->pc", np.log(table), one_hot) + np.log(share)
        post = np.exp(log - log.max(axis=1, keepdims=True))
        post /= post.sum(axis=1, keepdims=True)
        if np.abs(post - before).max(initial=0) < 1e-9:
            break
    return share, table, post[:, 0]


def weak_supervision(docs: DataFrame, threshold: float = 0.5, text_col: str = "text",
                     id_col: str = "doc_id") -> DataFrame:
    """Counts, votes, posterior and verdict (``accepted``) of each document.

    The counts are written once; the vote patterns (3 to the number of rules
    at most, whatever the number of documents) come to the driver for the
    estimation, and their posteriors go back as a small table.
    """
    spark = docs.sparkSession
    table = cut(counts(docs, text_col, id_col).withColumns({f"vote_{k}": v.cast("int") for k, v in _votes().items()}),
                "quality-counts")
    pattern = F.concat_ws(",", *[F.col(f"vote_{k}") for k in RULES])
    seen = table.groupBy(pattern.alias("pattern")).count().orderBy("pattern").collect()
    if not seen:
        return table.withColumns({"posterior": F.lit(None).cast("double"), "accepted": F.lit(None).cast("boolean")})
    votes = np.array([[int(v) for v in r["pattern"].split(",")] for r in seen])
    _, _, good = fit(votes, np.array([r["count"] for r in seen], float))
    known = spark.createDataFrame([(r["pattern"], float(g)) for r, g in zip(seen, good, strict=True)],
                                  "pattern string, posterior double")
    return (table.withColumn("pattern", pattern).join(F.broadcast(known), "pattern").drop("pattern")
            .withColumn("accepted", F.col("posterior") >= threshold))


def op6_quality_rules(docs: DataFrame) -> DataFrame:
    """Weak supervision over ``docs``, with the base counts and the base rule."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (weak_supervision(docs)
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    failed.alias("base_failed"), (~failed & F.col("accepted")).alias("kept"), "posterior",
                    *[f"vote_{k}" for k in RULES]))
