"""Each operator against brute force on small tables, and on odd input: nulls,
empty and long texts, ties, repeated rows, empty tables, clashing names."""

import itertools
import math
import random
import time
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import plan_text
from tidewatch.llm import (decontaminate, license_scan, lm_scoring, mixing, quality_knn, quality_rules,
                           simhash, token_files, toxicity, url_filter)
from tidewatch.llm.common import doc_bucket, shingle_hashes, word_hashes
from tidewatch.llm.components import components
from tidewatch.session import checkpoint_dir

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed, n, words="the of and to in that is was for on with as at by".split()):
    r = random.Random(seed)
    return " ".join(r.choice(words) + r.choice(["", "ing", "ed", "er", "ly", ","]) for _ in range(n)) + "."


BASE = prose(1, 300)
TEXTS = [None, "", " \n\t ", "one", "two words", BASE, BASE, BASE.replace("the", "a", 1), prose(2, 120),
         prose(3, 5000), "!!" * 40, "line\n" * 30, "# $ % | < >", "ünï cödé wörter " * 20,
         "Licensed under CC BY-NC 4.0.\n" + prose(4, 60), prose(5, 60).upper(), prose(6, 80) + " idiot scum moron"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ("en", "de", "fr", "es")[i % 4], "s", len(t or "")) for i, t in enumerate(TEXTS)]
    rows += [rows[5], (None, "no id here", None, None, None), (None, BASE, None, None, None)]
    return spark.createDataFrame([(*r, "s", 1, 2, 3, 4) for r in rows],
                                 DOCS + ", score string, rate int, id int, label int, fp int")


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, int(i % 3 > 0), int(i % 5 == 0)) for i in range(len(TEXTS))] + [(None, 1, 1), (2, None, None), (3, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_lm_scoring_counts_and_gain(spark, docs, none):
    got = lm_scoring.op1_lm_scoring(docs).collect()
    rows = [(r.doc_id, (r.text or "").encode().lower().split() + [b" "]) for r in docs.collect()]
    out = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    c = Counter(w for i, ws in rows if not out(i) for w in ws)
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), out(i), len(ws), sum(c[w] > 0 for w in ws), n,
                   round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6)) for i, ws in rows)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
                  for r in got) == want
    assert all(r.score <= 1e-9 for r in got) and sum(r.score for r in got) > sum(r.base_score for r in got)
    assert lm_scoring.op1_lm_scoring(none).count() == 0


def test_lm_chances_add_up(spark, docs):
    found, model = lm_scoring.counted(docs, doc_bucket(7) == 2)
    model = lm_scoring.train(found, model)
    # over all types, whatever went before: the classes' softmax and the shares within add up to one at most
    logits = model.class_bias + model.of_class[5]
    soft = lm_scoring._softmax(logits[None, :].copy())[0]
    assert abs(soft.sum() - 1) < 1e-5 and model.total > 0


def test_decontamination_holds_the_words_of_one_text():
    import tracemalloc

    index, texts = decontaminate.Index([(1, b" ".join(b"w%d" % i for i in range(40)))], 5, 0.8), [b"some words " * 500] * 400
    texts.append(b"x " + b" ".join(b"W%d" % i for i in range(40)))
    tracemalloc.start()
    clean = index.clean(texts, word_hashes())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert clean == [True] * 400 + [False] and peak < 1 << 20


def test_simhash_keys_are_not_sent_to_the_driver(spark):
    fps = spark.range(50).select(F.xxhash64("id").alias("fp"))
    assert "Broadcast" not in plan_text(simhash.links(fps))


def test_simhash_against_brute_force(docs, none):
    from xxhash import xxh64_intdigest

    rows, prints = docs.collect(), []
    for r in rows:
        w = (r.text or "").encode().lower().split()
        s = [b" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
        h = [xxh64_intdigest(x, 42) for x in s]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    group = list(range(len(rows)))
    for _ in rows:
        for i, j in itertools.combinations(range(len(rows)), 2):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                group[i] = group[j] = min(group[i], group[j])
    least = {g: min((rows[i].doc_id for i in range(len(rows)) if group[i] == g and rows[i].doc_id is not None),
                    default=None) for g in group}
    want = sorted((str(r.doc_id), format(p, "016x"), str(least[g])) for r, p, g in zip(rows, prints, group))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in simhash.op2_simhash(docs).collect()) == want
    assert simhash.op2_simhash(none).count() == 0


def test_pivot_links_lose_nothing():
    r = np.random.default_rng(3)
    base = r.integers(0, 1 << 63, 40, dtype=np.uint64)
    fps = [base]
    for flips in range(1, 7):
        fps.append(base ^ np.array([sum(1 << int(b) for b in r.choice(64, flips, replace=False)) for _ in base], np.uint64))
    fps = np.unique(np.concatenate(fps))
    table = simhash.PivotTable(4, 7)
    keys = table.keys(fps)
    for i, j in itertools.combinations(range(len(fps)), 2):
        if int(np.bitwise_count(fps[i] ^ fps[j])) <= 4:
            assert (keys[i] == keys[j]).any()


def test_hot_bucket_is_tiled(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 16)
    fps = [((1 << (i % 64)) | (1 << (i * 7 % 64))) for i in range(200)]
    fps = sorted({f - (1 << 64) if f >> 63 else f for f in fps})
    edges = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"))
    roots = components(edges).collect()
    assert {r.node for r in roots} | {r.root for r in roots} == set(fps) and len({r.root for r in roots}) == 1


def test_components_chain_and_star(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {100 + i: 100 for i in range(1, 40)}


def test_url_rules_and_model(spark):
    urls = ["http://A.example.com/en/1", "https://www.example.com/en/x?q#f", "http://x.net/es/1", "http://x.net/de/1",
            "http://com", "http://com/", "ftp://Bexample.com/en/", "no scheme", None, "", "http://h?x", "a://b://c/d",
            "http://x.net/fr/9", "http://x.net/fr/9", "http://y.net/es/" + "z" * 5000]
    pages = spark.createDataFrame([(i, u, None, "h") for i, u in enumerate(urls)],
                                  "page_id long, url string, html string, host string")
    got = {r.page_id: r for r in url_filter.op3_url_filter(pages).collect()}
    want = [("a.example.com", "/en/1", "example.com/en/"), ("www.example.com", "/en/x", "www.example.com/en/"),
            ("x.net", "/es/1", "net/es/"), ("x.net", "/de/1", None), ("com", "", None), ("com", "/", "com/"),
            ("bexample.com", "/en/", "com/"), ("", "", None), ("", "", None), ("", "", None), ("h", "", None),
            ("b:", "//c/d", None), ("x.net", "/fr/9", "net/fr/"), ("x.net", "/fr/9", "net/fr/")]
    assert [(got[i].host, got[i].path, got[i].rule) for i in range(len(want))] == want
    verdicts = dict(url_filter.RULES)
    assert all(r.verdict == verdicts[r.rule] for r in got.values() if r.rule)
    assert {r.verdict for r in got.values()} <= {"allow", "block"} and got[3].verdict == "block"
    assert url_filter.op3_url_filter(pages.limit(0)).count() == 0


def test_token_files_round_trip(docs, none, spark):
    from tokenizers import Tokenizer

    path = token_files.default_tokenizer()
    tokenizer = Tokenizer.from_file(path)
    got = [tuple(r) for r in token_files.op4_token_files(docs).collect()]
    rows = sorted(((r.doc_id, tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2]) for r in docs.collect()),
                  key=lambda r: -1 if r[0] is None else r[0])
    by_id = {}
    for i, ids in rows:
        by_id.setdefault(i, []).append(zlib.crc32(np.array(ids, "<u4").tobytes()))
    assert sorted((str(i), c) for i, _, _, c in got) == sorted((str(i), c) for i, cs in by_id.items() for c in cs)
    order = sorted(got, key=lambda r: r[1])
    assert order[0][1] == 0
    assert all(a[1] + a[2] == b[1] for a, b in zip(order, order[1:]))
    assert [r[0] for r in order] == [i for i, _ in rows]
    assert token_files.op4_token_files(none).count() == 0


def test_token_files_order_of_one_id(spark):
    rows = [(7, "b b"), (7, "a"), (7, "c c c"), (None, "x"), (7, "a")]
    orders = [[tuple(r) for r in token_files.op4_token_files(spark.createDataFrame(some, "doc_id long, text string"))
               .orderBy("start").collect()] for some in (rows, rows[::-1])]
    assert orders[0] == orders[1]


def test_word_memory_is_bounded_by_bytes():
    path = token_files.default_tokenizer()
    small, large = token_files.Encoder(path), token_files.Encoder(path)
    small.words.limit = small.words.bare.limit = 3000
    texts = pa.array([prose(s, 200, [f"w{i}x" for i in range(300)]) for s in range(20)])
    assert small.ids(texts) == large.ids(texts) and len(small.words) + len(small.words.old) < 100


ODD = ["", " ", "  ", None, "a  b", "a\n b", "a \n", "it's don't  x", "é ñ  x", "a\u00a0 b", "x<|endoftext|>y", "日本 語 12ab  ",
       "tab\t a", "'s 'll a's", " lead", "trail ", "a_b __ c-d", "x\x1c y", "\x85 q", "\n", "x\ny", "\nx", "x\n", "x.\ny.",
       "x\n\ny", "a.\n.b c", "a\u2003 b", "ß. ß.) ¿que? «la» l'été 12.3 12th ab12 '"]


def test_encoder_equals_the_library():
    encoder = token_files.Encoder(token_files.default_tokenizer())
    assert encoder.by_word
    for texts in (ODD, [t for t in TEXTS], []):
        assert encoder.ids(pa.array(texts, pa.string())) == [encoder.whole((t or "").encode()) for t in texts]


@pytest.mark.parametrize("n", [0, 1, 15, 16, 17, 1000, 70_000, 600_000])
def test_blocks_decode_whole_and_in_parts(n):
    ids = (np.random.default_rng(n).integers(0, 300, n) ** 2 % 50_000).astype(np.uint16)
    table = token_files.Table(token_files.Table.quantise(np.bincount(ids, minlength=50_257)))
    block = token_files.encode(ids, table)
    assert (token_files.decode(block, table) == ids).all()
    marks = token_files._HEAD.unpack_from(block)[6]
    parts = [token_files.decode(block, table, range(k, k + 1)) for k in range(marks)]
    assert (np.concatenate([np.zeros(0, np.uint32), *parts]) == ids).all()
    if n:
        broken = bytearray(block)
        broken[-9] ^= 1
        with pytest.raises(ValueError):
            token_files.decode(bytes(broken), table)


def test_mixing_reaches_targets(spark, docs, labels, none):
    langs = {"en": "the of and to".split(), "de": "der die und zu".split(), "fr": "le la et du".split(),
             "es": "el los y del".split()}
    rows = [(i, prose(i, 40 + i % 50, langs[k]), k, "s", 0) for i, k in enumerate(["en"] * 120 + ["de"] * 40
                                                                                 + ["fr"] * 40 + ["es"] * 20)]
    many = spark.createDataFrame(rows, DOCS)
    known = spark.createDataFrame([(i,) for i in range(0, 220, 2)], "doc_id long")
    got = mixing.op5_mixing(many, known).collect()
    total = sum(r.rate * r.n_tokens for r in got)
    for k, share in mixing.TARGETS.items():
        assert abs(sum(r.rate * r.n_tokens * r[f"p_{k}"] for r in got) / total - share) < 0.01
    lang = {r[0]: r[2] for r in rows}
    assert sum(max("en de fr es".split(), key=lambda k: r[f"p_{k}"]) == lang[r.doc_id] for r in got) > 215
    odd = mixing.op5_mixing(docs, labels).collect()
    assert len(odd) == docs.count() and all(r.rate >= 0 and abs(r.p_en + r.p_de + r.p_fr + r.p_es - 1) < 1e-6 for r in odd)
    words = {r.doc_id: len((r.text or "").split()) for r in docs.collect() if r.doc_id not in (None, 10)}
    assert all(r.n_tokens == words[r.doc_id] for r in odd if r.doc_id in words)
    assert mixing.op5_mixing(none, labels).count() == 0 and mixing.op5_mixing(docs, labels.limit(0)).count() == len(odd)


def test_quality_rules_counts(docs, none):
    def brute(t):
        w, lines, seen, dup = t.split(), t.split(b"\n"), set(), 0
        for x in lines:
            if x.split():
                dup += x in seen
                seen.add(x)
        win = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        c = Counter(win)
        cover = {i + k for i, x in enumerate(win) if c[x] > 1 for k in range(3)}
        return (len(w), sum(len(x.decode()) for x in w), sum(t.count(bytes([s])) for s in b"#*$%&|<>"), dup, len(cover))

    want = sorted((str(r.doc_id), *brute((r.text or "").encode())) for r in docs.collect())
    got = quality_rules.op6_quality_rules(docs).collect()
    assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in got)
    assert not any(r.kept and r.base_failed for r in got)
    assert quality_rules.op6_quality_rules(none).count() == 0


def test_weak_supervision_finds_each_kind_of_poor():
    good, a, b = [1, 1, 1, 1], [0, 1, 1, 1], [1, 1, 0, -1]
    _, table, post = quality_rules.fit(np.array([good, a, b, [-1] * 4]), np.array([900.0, 60, 40, 10]))
    assert post[0] > 0.95 and post[1] < 0.5 and post[2] < 0.5 and post[3] > 0.5
    assert np.allclose(table.sum(axis=2), 1)


def test_decontamination_against_brute_force(spark, docs, none):
    passage = prose(9, 30)
    words = passage.split()
    items = [(0, passage), (1, "two words"), (2, ""), (3, None), (4, prose(11, 25)), (5, passage), (5, passage)]
    bench = spark.createDataFrame([(*i, "c") for i in items], "item_id long, text string, containment string")
    more = docs.select("doc_id", "text").union(spark.createDataFrame(
        [(100, prose(3, 4000) + " " + passage.upper() + " " + prose(7, 900)), (101, " ".join(words[:15])),
         (102, " ".join(words[:28]) + " x y")], "doc_id long, text string"))

    def sh(t, n):
        w = t.lower().split()
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}

    want = set()
    for r in more.collect():
        for i, t in items:
            n = min(5, len((t or "").split()))
            if n and (s := sh(t, n)) and len(s & sh(r.text or "", n)) >= 0.8 * len(s):
                want.add((r.doc_id, i, round(len(s & sh(r.text or "", n)) / len(s), 9)))
    got = decontaminate.op7_decontaminate(more, bench).collect()
    assert {(r.doc_id, r.item_id, round(r.containment, 9)) for r in got} == want and len(got) == len(want)
    assert (100, 0, 1.0) in want and (102, 0) in {w[:2] for w in want} and (101, 0) not in {w[:2] for w in want}
    assert decontaminate.op7_decontaminate(none, bench).count() == 0
    assert decontaminate.op7_decontaminate(more, bench.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["quality", "toxic"])
def test_classifiers_on_odd_input(name, docs, labels, none, spark):
    op = {"quality": quality_knn.op8_quality_knn, "toxic": toxicity.op9_toxicity}[name]
    got = op(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert op(none, labels).count() == 0
    assert all(0 <= r.score <= 1 for r in op(docs, labels.limit(0)).collect())


@pytest.mark.parametrize("name", ["quality", "toxic"])
def test_classifiers_held_out(name, spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    op = {"quality": quality_knn.op8_quality_knn, "toxic": toxicity.op9_toxicity}[name]
    rows = op(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r[name] for r in rows) / len(rows) >= 0.9


def test_block_max_search_is_exact():
    r = random.Random(5)
    terms = [(b"t%d" % i, r.randint(1, 50)) for i in range(40)]
    rows = [(i, r.randint(0, 1), Counter(r.choices(range(40), k=r.randint(0, 6)))) for i in range(500)]
    index = toxicity.Index(terms, rows, 500)
    dense = np.zeros((500, 40))
    for i, (at, w) in enumerate(index.vectors):
        dense[i, at] = w
    for _ in range(50):
        at, w = index.vector(Counter(r.choices(range(40), k=4)))
        near, cosine = index.nearest(at, w)
        want = np.sort(dense[:, at] @ w)[::-1][: len(near)]
        assert len(near) == 15 and np.allclose(cosine, want)


def test_latent_cosines_are_exact(spark):
    texts = [prose(i, 80) for i in range(60)]
    codes = quality_knn._Codes()
    found = quality_knn.counts([t.encode() for t in texts], codes)
    model = quality_knn.fit(found, np.arange(60) % 2.0, 0.5)
    mine = model.vectors(found.copy())
    near = mine @ model.examples.T
    for i, s in enumerate(model.score([t.encode() for t in texts], codes)):
        at = np.argsort(-near[i])[:15]
        w = np.maximum(near[i][at], 0) ** 4
        assert abs(s - ((w * model.label[at]).sum() + 5e-4) / (w.sum() + 1e-3)) < 1e-3


def test_license_scan_against_brute_force(docs, none, spark):
    line = "Released under the MIT License."
    more = docs.select("doc_id", "text").union(spark.createDataFrame(
        [(200, f"{prose(8, 30)}\n  {line}\n{prose(8, 30)}"), (201, f"Some words here. {line} And more."),
         (202, "This work is licensed\nunder the GNU General Public License, version 3."),
         (203, "the license is under discussion")], "doc_id long, text string"))
    got = {r.doc_id: r for r in license_scan.op10_license_scan(more).collect()}
    assert [got[i].licenses for i in (14, 200, 201, 202, 203)] == ["CC-BY-NC-4.0", "MIT", "MIT", "GPL-3.0", ""]
    assert got[14].restricted and not got[200].restricted and got[200].best_dice == 1.0 and got[0].n_notices == 0

    def every(text):  # all templates, no size bounds, no index
        out = {}
        for part in _segments(text):
            g = license_scan.bigrams(license_scan.normalise(part))
            for name, t in license_scan.TEMPLATES:
                h = license_scan.bigrams(license_scan.normalise(t.encode()))
                if g and 2 * len(g & h) / (len(g) + len(h)) >= 0.8:
                    out[name] = max(out.get(name, 0), 2 * len(g & h) / (len(g) + len(h)))
        return out

    scanner = license_scan.Scanner(license_scan.TEMPLATES, 0.8)
    for r in more.collect():
        found = {n: d for n, d, _ in scanner.scan((r.text or "").encode())}
        best = every((r.text or "").encode())
        assert set(found) <= set(best) and (not best or max(found.values()) == max(best.values()))
    assert license_scan.op10_license_scan(none).count() == 0


def _segments(text):
    yield text
    for p in license_scan._PARAGRAPH.split(text):
        yield p
    for line in text.split(b"\n"):
        yield line
        yield from license_scan._SENTENCE.split(line)


def test_shingles_of_short_texts():
    h = word_hashes()
    w = h.of([b"a", b"b", b"c"], 3)
    assert len(shingle_hashes(w, 5)) == 1 and len(shingle_hashes(w[:0], 5)) == 0 and len(shingle_hashes(w, 2)) == 2


def test_pipeline_stages(spark, docs, none):
    sf = "/root/testdata/sf0.001"
    rows = docs.select(*[c.split()[0] for c in DOCS.split(", ")])
    path = token_files.scratch_path(spark, "pipeline-input")
    rows.write.parquet(path)
    state = spark.read.parquet(path)
    empty = none
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, state, sf)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == rows.columns, name
        empty = stage(spark, empty, sf) if name == "quality classifier" else stage(spark, none, sf)
        assert empty.count() == 0, name
        next_path = token_files.scratch_path(spark, "pipeline-stage")
        out.write.parquet(next_path)
        state = spark.read.parquet(next_path)
    assert state.count() > 0


def test_near_dedup_keeps_one_of_each(spark, docs):
    path = token_files.scratch_path(spark, "dedup-input")
    docs.write.parquet(path)
    rows = spark.read.parquet(path)
    kept = [r.text or "" for r in corpus_pipeline.near_dedup(spark, rows, "").collect()]
    assert kept.count(BASE) == 1 and BASE.replace("the", "a", 1) not in kept
    # texts without a word share fingerprint zero, so one of them stays
    assert {t for t in TEXTS if t and t.strip() and t != BASE} - {BASE.replace("the", "a", 1)} <= set(kept)


def test_near_dedup_against_brute_force(spark):
    r, words = random.Random(9), [f"w{i}" for i in range(3000)]
    texts = []
    for _ in range(30):
        base = r.choices(words, k=300)
        for changed in (0, 1, 2, 4):
            copy = list(base)
            for at in r.sample(range(300), changed):
                copy[at] = "x" + copy[at]
            texts.append(" ".join(copy))
    texts += [None, "", " \n"]
    prints = [simhash.fingerprint((t or "").encode()) for t in texts]
    group = list(range(len(texts)))
    for i, j in itertools.combinations(range(len(texts)), 2):
        if group[i] != group[j] and (prints[i] ^ prints[j]).bit_count() <= 4:
            old, new = max(group[i], group[j]), min(group[i], group[j])
            group = [new if g == old else g for g in group]
    path = token_files.scratch_path(spark, "dedup-similar")
    spark.createDataFrame([(i, t, 1, "a", 2.0) for i, t in enumerate(texts)],
                          "doc_id long, text string, at int, row string, component_id double").write.parquet(path)
    kept = corpus_pipeline.near_dedup(spark, spark.read.parquet(path), "")
    assert kept.columns == ["doc_id", "text", "at", "row", "component_id"]
    assert sorted(group[x.doc_id] for x in kept.collect()) == sorted(set(group)) and len(set(group)) < len(texts) - 20


@pytest.mark.parametrize("shares", [(0.05, 0.35, 0.30, 0.30), (0.30, 0.30, 0.399, 0.001)])
def test_mixing_reaches_skewed_targets(spark, shares):
    goal = np.array(list(mixing.TARGETS.values()))
    for sharp in (1.0, 0.9):
        posts = [[sharp if i == j else (1 - sharp) / 3 for j in range(4)] for i in range(4)]
        rows = [(int(1000 * s) + 0, posts[i]) for i, s in enumerate(shares)] * 5
        table = spark.createDataFrame(rows, "n long, post array<double>")
        if sharp < 1:
            table = table.union(spark.createDataFrame([(300, [0.97, 0.01, 0.01, 0.01]), (200, [0.01, 0.01, 0.01, 0.97])], table.schema))
        pull, came = mixing.fit_rates(table, goal)
        got = sum(n * max(0.0, 1 + float(pull @ np.array(p))) * np.array(p) for n, p in [tuple(r) for r in table.collect()])
        assert np.abs(came - 1).max() < mixing.CLOSE and np.abs(got / got.sum() - goal).max() < 1e-4


def test_mixing_reports_a_target_out_of_reach(spark, docs, labels):
    with pytest.warns(UserWarning, match="targets not met"):
        assert mixing.op5_mixing(docs, labels.limit(0)).count() == docs.count()


def test_lm_classes_follow_the_counts(spark):
    head = [(i, 1_000_000 + i) for i in range(640)]
    rest = [(1000, 64), (1001, 4096), (1002, 1 << 18), (1003, 1)]
    model, coded = lm_scoring.start(spark.createDataFrame(head + rest, "word long, c long"))
    places = {r.word: r.place for r in coded.collect()}
    assert sorted(places[i] for i in range(640)) == list(range(1, 641)) and places[1000] is None
    kinds = lm_scoring.band(np.array([64, 4096, 1 << 18, 1, 0]), len(model.mass))
    assert len(set(kinds.tolist())) == 5 and kinds.max() == len(model.mass) - 1
    assert model.mass[kinds[:4]].tolist() == [64, 4096, 1 << 18, 1]
    # the last word with the third last one is a context of its own
    words = np.array([[5, 6, 7, 8], [9, 6, 7, 8]], np.uint64)
    a, b = (lm_scoring._features(w, np.arange(4) == 0)[:, 3] for w in words)
    assert len(a) == 4 and (a != b).tolist() == [False, False, False, True]


def plain_learn(model, row, weights):
    """Steps token by token batch, as the model is defined: every logit row made
    at once, slopes sorted by bucket and added up."""
    p, seen = lm_scoring.Pass(model, row), (np.ones(lm_scoring.BUCKETS, "f4"), np.ones(lm_scoring.BUCKETS, "f4"))

    def steps(table, seen, idx, bias, target):
        logits = bias + sum(table[i] for i in idx)
        logits -= logits.max(axis=1, keepdims=True)
        slope = np.exp(logits)
        slope /= slope.sum(axis=1, keepdims=True)
        slope[np.arange(len(target)), target] -= 1
        for i in idx:
            order = np.argsort(i, kind="stable")
            start = np.flatnonzero(np.diff(i[order], prepend=-1))
            sums, at = np.add.reduceat(slope[order], start, axis=0), i[order][start]
            seen[at] += (sums * sums).mean(axis=1)
            table[at] -= lm_scoring.RATE * sums / np.sqrt(seen[at])[:, None]

    target, known = p.classes(1)[p.codes], p.known[p.codes]
    use, rows = np.flatnonzero(~p.held), p.rows(np.arange(len(p.codes)))
    for lo in range(0, len(use), lm_scoring.BATCH):
        at = use[lo : lo + lm_scoring.BATCH]
        steps(weights[0], seen[0], lm_scoring._buckets(rows[:, at]), model.class_bias, target[at])
        at = at[known[at] >= 0]
        kind, slot = np.divmod(known[at], lm_scoring.SLOTS)
        steps(weights[1], seen[1], lm_scoring.word_rows(rows[:, at], kind), model.word_bias[kind], slot)


def test_lm_steps_equal_the_plain_ones_at_half_the_cost():
    r = np.random.default_rng(1)
    words, tokens, docs = 30_000, 130_000, 400
    counts = np.maximum(1, 400_000 // np.arange(1, words + 1))
    head = np.where(np.arange(words) < 640, np.arange(1, words + 1), 0)
    codes = np.minimum(r.zipf(1.2, tokens), words) - 1
    sizes = np.diff(np.concatenate([[0], np.sort(r.choice(np.arange(1, tokens), docs - 1, replace=False)), [tokens]]))
    places = r.permutation(words)
    row = {"hashes": r.integers(-(1 << 31), 1 << 31, words), "places": places,
           "found": ((counts << lm_scoring.HEAD_BITS) + head)[places],
           "codes": lm_scoring._packed(codes), "sizes": sizes.tolist(), "held": (r.random(docs) < 1 / 7).tolist()}
    classes = lm_scoring.FILLED + 20
    bias = np.append(r.normal(8, 3, classes - 1), lm_scoring.NONE).astype("f4")
    model = lm_scoring.Model(int(counts.sum()), words, np.full(classes, 1e6), bias,
                             np.log(counts[:640]).reshape(lm_scoring.FILLED, -1).astype("f4"),
                             np.zeros((lm_scoring.BUCKETS, classes), "f4"),
                             np.zeros((lm_scoring.BUCKETS, lm_scoring.SLOTS), "f4"))

    def run(f):
        best = math.inf
        for _ in range(2):
            weights = model.of_class.copy(), model.of_word.copy()
            began = time.process_time()
            f(weights)
            best = min(best, time.process_time() - began)
        return weights, best

    want, plain = run(lambda w: plain_learn(model, row, w))
    got, fast = run(lambda w: lm_scoring.learn(model, [row], w))
    assert all(np.abs(a - b).max() < 1e-4 and np.abs(b).max() > 0.1 for a, b in zip(got, want, strict=True))
    assert fast < 0.7 * plain
    # the chances of the tokens are those of the plain softmax, also where the exponentials go out of range
    model.of_class, model.of_word = want
    p = lm_scoring.Pass(model, row)
    rows, code = p.rows(np.arange(500)), p.codes[:500]
    kinds, known = p.classes()[code], p.known[code]
    for shift in (0, 300):
        model.class_bias = bias + np.float32(shift)
        logits = model.class_bias.astype(float) + sum(model.of_class[i] for i in lm_scoring._buckets(rows))
        logits -= logits.max(axis=1, keepdims=True)
        plain = (logits - np.log(np.exp(logits).sum(axis=1, keepdims=True)))[np.arange(500), kinds]
        kind, slot = np.divmod(np.maximum(known, 0), lm_scoring.SLOTS)
        logits = model.word_bias[kind].astype(float) + sum(model.of_word[i] for i in lm_scoring.word_rows(rows, kind))
        within = (logits - np.log(np.exp(logits).sum(axis=1, keepdims=True)))[np.arange(500), slot]
        plain += np.where(known >= 0, within, np.log(p.count[code] / model.mass[kinds]))
        assert np.abs(lm_scoring.log_chances(model, p)[:500] * np.log(10) - plain).max() < 1e-3


@pytest.mark.parametrize("equal", [1, 2, 15, 16, 17, 32, 33, 500])
def test_lm_slopes_of_equal_buckets_add_up(equal):
    r = np.random.default_rng(equal)
    rows = r.permutation(np.concatenate([np.full(equal, 7), np.arange(20, 60), np.arange(30, 50), [0]])).astype(np.int16)
    slope = r.normal(size=(len(rows), 5)).astype("f4")
    at, place, sums = lm_scoring._sums(rows, slope)
    assert at.tolist() == sorted(set(rows.tolist()))
    for bucket, got in zip(at, sums[place], strict=True):
        assert np.abs(got - slope[rows == bucket].sum(axis=0)).max() < 1e-4


def test_lm_scratch_holds_the_counted_blocks_alone(spark, docs):
    folder = Path(checkpoint_dir(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    found, _ = lm_scoring.counted(docs, doc_bucket(7) == 2)
    assert [p.name.rpartition("-")[0] for p in set(folder.iterdir()) - before] == ["lm-counted"]
    assert sum(len(r.ids) for r in found.collect()) == docs.count()


def test_lm_blocks_take_many_short_texts(spark):
    def took(n):
        rows = spark.range(n, numPartitions=1).select(F.col("id").alias("doc_id"), F.lit(None).cast("string").alias("text"))
        began = time.perf_counter()
        got = lm_scoring.blocks(rows, F.lit(False), "text", "doc_id").selectExpr("size(sizes)").collect()
        assert [x[0] for x in got] == [n]
        return time.perf_counter() - began

    took(100)
    # before, every text added up the sizes of all texts before it
    assert took(80_000) < took(800) + 4


@pytest.mark.parametrize("name,parts", license_scan.WHOLE)
def test_whole_licence_texts_are_found(name, parts):
    import textwrap

    scanner = license_scan.Scanner(license_scan.TEMPLATES, 0.8)
    wrapped = [textwrap.fill(p, 76) for p in parts]
    for text in (" ".join(parts), "\n".join(wrapped), "\n\n".join(wrapped),
                 f"{prose(1, 90)}\n\n" + "\n\n".join(wrapped) + f"\n\n{prose(2, 90)}"):
        assert [n for n, _, _ in scanner.scan(text.encode())] == [name]
