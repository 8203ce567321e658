"""N-gram join against all pairs by brute force; the pipeline's stages."""

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from replylens.llm import ngram_join as nj
from tests.conftest import SMOKE


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def brute(rows):
    """doc_id -> (class_id, text_id, n_copies, n_links)."""
    by_text = {}
    for i, t in rows:
        by_text.setdefault(t, []).append(i)
    reps = {t: min(ids) for t, ids in by_text.items() if shingles(t)}
    sets = {r: shingles(t) for t, r in reps.items()}
    links, root = dict.fromkeys(sets, 0), {r: r for r in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        inter = len(sets[a] & sets[b])
        if inter and inter >= 0.8 * (len(sets[a]) + len(sets[b]) - inter):
            links[a] += 1
            links[b] += 1
            x, y = sorted((find(a), find(b)))
            root[y] = x
    out = {}
    for i, t in rows:
        r = reps.get(t)
        out[i] = (i, i, 1, 0) if r is None else (find(r), r, len(by_text[t]), links[r])
    return out


def noisy_corpus(seed=1, groups=12, alone=60):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 5)))
    texts = [" ".join(word() for _ in range(rnd.randint(1, 150))) for _ in range(alone)]
    common = " ".join(word() for _ in range(40))
    for _ in range(groups):
        base = [word() for _ in range(rnd.randint(30, 150))]
        for _ in range(rnd.randint(2, 12)):
            copy = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 3])):
                copy[rnd.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
        texts.append(common + " " + " ".join(word() for _ in range(30)))
    big = [word() for _ in range(200)]                         # one large group of near copies
    for _ in range(90):
        copy = list(big)
        copy[rnd.randrange(200)] = word()
        texts.append(" ".join(copy))
    rnd.shuffle(texts)
    return [(i, t) for i, t in enumerate(texts)]


def result(df):
    return {r["doc_id"]: (r["class_id"], r["text_id"], r["n_copies"], r["n_links"]) for r in df.collect()}


@pytest.mark.parametrize("leaf, block", [(200, 512), (8, 16)])
def test_join_matches_all_pairs(spark, leaf, block):
    """The second form forces deep paths and tiles of a bucket."""
    rows = noisy_corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(nj.near_duplicates(df, leaf=leaf, block=block)) == brute(rows)


def test_join_on_the_given_documents(spark):
    df = spark.read.parquet(f"{SMOKE}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert result(nj.near_duplicates(df)) == brute(rows)


def test_join_odd_inputs(spark, odd_docs, no_docs):
    rows = nj.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    got = {r["doc_id"]: r for r in rows}
    assert got[1]["class_id"] == got[8]["class_id"] == 1 and got[8]["n_copies"] == 3
    assert all(got[i]["class_id"] == i and got[i]["n_links"] == 0 for i in (2, 3, 4, 5))
    assert got[None]["class_id"] is None
    assert nj.near_duplicates(no_docs).count() == 0


def test_recall_of_the_runs():
    """Chance that sets at the threshold share a bucket after three levels in one of the runs."""
    rng = np.random.default_rng(0)
    pairs, found = 400, 0
    toks = rng.integers(0, 2 ** 16, (pairs, 2, nj.SLOTS)).astype("u2")
    same = rng.random((pairs, nj.SLOTS)) < nj.THRESHOLD
    toks[:, 1][same] = toks[:, 0][same]
    for p in range(pairs):
        hit = False
        for r in range(nj.runs_for()):
            node = [nj.mix(np.array([r + 1], "u8") * nj.GOLD)] * 2
            for _ in range(3):
                kids = [np.unique(nj.split(node[s], np.repeat(toks[p, s][None], len(node[s]), 0))[1]) for s in (0, 1)]
                both = np.intersect1d(*kids)
                node = [both, both]
                if not len(both):
                    break
            hit = hit or len(node[0]) > 0
        found += hit
    assert found / pairs >= 0.99


def test_components(spark):
    edges = [(i, i + 1) for i in range(20, 40)] + [(100, 50), (100, 51), (51, 99), (7, 7)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["root"] for r in nj.components(df).collect()}
    assert got == {i: 20 for i in range(21, 41)} | {51: 50, 99: 50, 100: 50}


# --- pipeline

def test_stage_order_and_columns():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dups", "pii", "mixing", "packing"]


def test_pipeline_stages_on_documents(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    lang = corpus_pipeline.language_id(spark, docs, SMOKE)
    assert lang.columns == docs.columns
    kept = {r["doc_id"] for r in lang.collect()}
    assert kept == {r["doc_id"] for r in docs.collect() if re.search(r"[^\W\d_]", r["text"] or "")}
    dups = corpus_pipeline.near_dups(spark, docs, SMOKE)
    want = {i for i, v in brute([(r["doc_id"], r["text"]) for r in docs.collect()]).items() if v[0] == i}
    assert {r["doc_id"] for r in dups.collect()} == want and dups.columns == docs.columns
    masked = {r["doc_id"]: r for r in corpus_pipeline.private_data(spark, docs, SMOKE).collect()}
    for r in docs.collect():
        if not re.search(r"[0-9@]", r["text"] or ""):
            assert masked[r["doc_id"]] == r
        assert masked[r["doc_id"]]["n_chars"] == len(masked[r["doc_id"]]["text"])
    assert any("[EMAIL]" in r["text"] for r in masked.values())
    assert not any(re.search(r"[a-z0-9.]+@mail[0-9]\.example\.com", r["text"]) for r in masked.values())


def test_equal_ids_do_not_mix_texts(spark):
    """Ids that stand for several texts: each text is linked by itself, and no unique text is lost."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    near = b.replace("b29", "other")
    rows = [(5, a, 1), (5, b, 2), (9, b, 3), (9, near, 4), (3, c, 5), (3, c, 6), (None, c, 7), (8, "", 8), (8, None, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, key int")
    got = sorted((r["doc_id"] is None, r["doc_id"], r["class_id"], r["text_id"], r["n_copies"], r["n_links"]) for r in nj.near_duplicates(df).collect()
                 if r["doc_id"] is not None)
    assert [x[1:] for x in got] == [(3, 3, 3, 2, 0), (3, 3, 3, 2, 0), (5, 5, 5, 1, 0), (5, 5, 5, 2, 1), (8, 8, 8, 1, 0), (8, 8, 8, 1, 0),
                                    (9, 5, 5, 2, 1), (9, 5, 9, 1, 1)]
    kept = sorted((r["key"], r["text"]) for r in corpus_pipeline.near_dups(spark, df, SMOKE).collect())
    keys = [k for k, _ in kept]
    assert [k for k in keys if k not in (5, 6)] == [1, 2, 7, 8, 9] and len(set(keys) & {5, 6}) == 1


def test_pipeline_runs_whole(spark):
    out = corpus_pipeline.run(spark, SMOKE).toPandas()
    assert len(out) and {"doc_id", "n_tokens", "bucket", "batch", "slot"} <= set(out.columns)
    rows = out.groupby(["bucket", "batch"]).slot.agg(["size", "max"])
    assert (rows["size"] == rows["max"] + 1).all()


def test_stages_survive_odd_documents(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SMOKE)
            out.collect()
            if name != "packing":
                assert out.columns == docs.columns, name
    kept = corpus_pipeline.near_dups(spark, odd_docs, SMOKE)
    assert kept.where(F.col("doc_id") == 1).count() == 1 and kept.where(F.col("doc_id") == 8).count() == 0
