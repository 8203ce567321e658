"""MinHash near duplicates, collocations and ball-tree search against brute force."""

import itertools
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from replylens.llm import balltree, collocation, minhash
from replylens.llm.textscan import Scanner, byte_set, slices

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, score string, rank int, node long"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, lang, None, 1, 2) for i, t, lang in rows], DOCS)


def key(x):
    return (x is None, x or 0)


# --- tokens

def test_word_hashes_depend_on_the_word_alone():
    import pyarrow as pa
    texts = ["Ab c", None, "", "ab  c \x85d", "é" * 3000 + " C", "x" * 5000]
    scan, seen = Scanner(~byte_set(b" \t\n\x0b\x0c\r")), {}
    for limit in (10, 1 << 20):
        for s in slices(pa.array(texts), limit):
            start, end, h = scan.find(s.data)
            for a, b, x, d in zip(start, end, h, s.owner(start)):
                word = s.data[a:b].tobytes()
                assert word in (texts[s.rows[d]] or "").encode()
                assert seen.setdefault(word.lower(), x) == x
    assert len(set(seen.values())) == len(seen) == 5


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    import pyarrow as pa
    from replylens.llm import textscan
    text = " ".join(f"w{i % 50}" for i in range(2000)) + " " + "z" * 3000 + " w1"
    scan = Scanner(~byte_set(b" "))
    s = next(slices(pa.array([text])))
    whole = scan.find(s.data)[2]
    monkeypatch.setattr(textscan, "CHUNK", 64)
    assert (scan.find(s.data)[2] == whole).all()


# --- op11

def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_groups(rows):
    sets = [shingles(t) for _, t, _ in rows]
    part = list(range(len(rows)))

    def root(i):
        while part[i] != i:
            i = part[i]
        return i
    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and rows[i][0] is not None and rows[j][0] is not None and 100 * len(a & b) >= 85 * len(a | b):
            part[root(i)] = root(j)
    low = {}
    for i, r in enumerate(rows):
        low[root(i)] = min(low.get(root(i), r[0]), r[0]) if r[0] is not None else None
    return Counter((r[0], len(sets[i]), low[root(i)]) for i, r in enumerate(rows))


def edited(rng, words, n):
    words = list(words)
    for at in rng.choice(len(words), n, replace=False):
        words[at] = f"new{rng.integers(1 << 40)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def near_rows():
    """Near copies around the threshold, chains, short texts, copies, equal ids with different texts."""
    rng = np.random.default_rng(5)
    rows, at = [], 0
    for size in (6, 8, 20, 60, 200, 400):
        base = [f"b{size}w{rng.integers(1 << 30)}" for _ in range(size)]
        for k in range(14):
            rows.append((at, edited(rng, base, int(rng.integers(0, max(2, size // 40 + 1)))), "en"))
            at += 1
        step = list(base)
        for _ in range(8):                               # a chain: each text is near the one before it
            step = edited(rng, step, max(1, size // 100)).split()
            rows.append((at, " ".join(step), "en"))
            at += 1
    rows += [(900, rows[3][1].upper(), "en"), (901, "  " + rows[3][1].replace(" ", "\n\t"), "en"), (5, "an id used twice here", None),
             (950, "an id used twice here", None), (951, "Two words", "en"), (952, "two  words", "en"), (953, "two words", "en"),
             (None, rows[3][1], "en"), (960, None, None), (961, "", "en"), (962, " \n", "en"), (3, rows[3][1], "en")]
    return rows


@pytest.mark.parametrize("rounds,block", [(2, 512), (1, 3), (3, 8)])
def test_near_duplicates_equal_all_pairs(spark, near_rows, rounds, block, monkeypatch):
    monkeypatch.setattr(minhash, "CHUNK", 4)
    got = minhash.near_duplicates(docs_of(spark, near_rows), rounds=rounds, block=block).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute_groups(near_rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) if r["doc_id"] is not None else r["kept"] is None for r in got)


def test_a_group_no_star_decides_is_still_grouped(spark):
    """Classes linked only to some of the others: every one differs from the centre by more than the threshold allows."""
    rng = np.random.default_rng(8)
    base = [f"w{i}" for i in range(300)]
    rows = [(1000 + i, edited(rng, base, 4 + i % 3), "en") for i in range(60)]
    got = minhash.near_duplicates(docs_of(spark, rows), rounds=1, block=7).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute_groups(rows)


def test_signatures_agree_as_often_as_sets():
    rng = np.random.default_rng(2)
    for size in (1, 3, 40, 2000):
        a = rng.integers(0, 1 << 63, size, dtype="u8")
        near = []
        for _ in range(40 if size < 2000 else 5):
            b = np.where(rng.random(size) < 0.9, a, rng.integers(0, 1 << 63, size, dtype="u8"))
            t = minhash.signatures([np.unique(a), np.unique(b)])
            both = len(np.intersect1d(a, b))
            near.append((t[0] == t[1]).mean() - both / (2 * size - both))
        assert abs(np.mean(near)) < 0.06
    assert (minhash.signatures([a]) == minhash.signatures([a])).all()


def test_near_duplicates_of_odd_tables(spark, odd_docs, no_docs):
    got = minhash.near_duplicates(odd_docs).collect()
    rows = [(r["doc_id"], r["text"], None) for r in odd_docs.collect()]
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute_groups(rows)
    assert minhash.near_duplicates(no_docs).count() == 0


# --- op12

def brute_phrases(rows, min_count=30, top=2000):
    f, total = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(w)
            for k in range(1, 5):
                f[lang or "und"].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) >= 2 and a >= min_count}
        kept = []
        for p, a in found.items():
            if any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in found.items()):
                continue
            cuts = [(2000000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p))]
            s, _, left, right = min(cuts)
            kept.append((-s, -a, " ".join(p).encode(), left, right))
        for r, (s, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, r, p.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


@pytest.fixture(scope="module")
def phrase_rows():
    rng = np.random.default_rng(3)
    rows = []
    for i in range(300):
        w = rng.choice(["The", "red", "fox", "DOG", "ran", "é", "\x85", "a" * 40], int(rng.integers(0, 30)), p=[.3, .2, .1, .1, .1, .1, .05, .05])
        sep = rng.choice([" ", "  ", "\t", ", ", "\n"], len(w), p=[.7, .1, .1, .05, .05])
        rows.append((int(rng.integers(0, 200)) if i % 7 else None, "".join(a + b for a, b in zip(w, sep)), [None, "en", "und", "de"][i % 4]))
    return rows + [(1, None, "en"), (2, "", None), (3, " , . \n", "fr"), *[rows[1]] * 3]


@pytest.mark.parametrize("bits,count,top", [(64, 30, 2000), (64, 5, 7), (10, 5, 2000), (5, 30, 50)])
def test_collocations_equal_brute_force(spark, phrase_rows, bits, count, top):
    """Few ``bits`` make fingerprints collide all the time: the counts by text must make up for it."""
    got = collocation.collocations(docs_of(spark, phrase_rows), min_count=count, top=top, bits=bits).collect()
    cols = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r[c] for c in cols) for r in got) == brute_phrases(phrase_rows, count, top)


def test_collocations_hand_on_what_they_hold(spark, phrase_rows, monkeypatch):
    monkeypatch.setattr(collocation, "HELD", 50)
    monkeypatch.setattr(collocation, "TABLE_BITS", 1 << 13)
    got = collocation.collocations(docs_of(spark, phrase_rows), min_count=10).count()
    assert got == len(brute_phrases(phrase_rows, 10))


def test_bit_table_has_no_false_negatives(spark):
    fps = np.random.default_rng(1).integers(0, 1 << 63, 5000, dtype="u8")
    table = collocation.bit_table(spark.createDataFrame([(int(x),) for x in fps], "fp long"))
    assert collocation.passes(table, fps).all()
    assert collocation.passes(table, fps + np.uint64(1)).mean() < 0.1


def test_scores_pass_64_bits(spark):
    big = 9 * 10 ** 15
    from pyspark.sql import functions as F
    row = spark.createDataFrame([(big, big, big)], "a long, l long, r long").select(
        F.expr(f"(cast({collocation.SCALE} as decimal(18,0)) * cast(a as decimal(19,0))) div (cast(l as decimal(19,0)) + r)").alias("s")).first()
    assert row["s"] == collocation.SCALE * big // (2 * big)


def test_collocations_of_odd_tables(spark, odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in odd_docs.collect()]
    got = collocation.collocations(odd_docs).collect()
    assert sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in got) == brute_phrases(rows)
    assert collocation.collocations(no_docs).count() == 0


# --- op13

def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute_rank(docs, items, k=10):
    bags = [(i, Counter(terms(t))) for i, t, _ in docs if terms(t)]
    n_docs, length = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    w = {t: math.floor(1000 * np.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    wanted = defaultdict(set)
    for i, t in items:
        wanted[i] |= set(terms(t))
    out = []
    for item, ts in wanted.items():
        rows = []
        for i, bag in bags:
            m = 10 + 90 * sum(bag.values()) * n_docs // length
            s = sum(w[t] * (10 ** 9 * bag[t] // (1000 * bag[t] + 8 * m)) for t in ts if t in bag)
            if s > 0:
                rows.append((-s, key(i), i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(rows)[:k], 1)]
    return Counter(out)


@pytest.fixture(scope="module")
def search_rows():
    rng = np.random.default_rng(4)
    vocabulary = [f"t{i}" for i in range(60)] + ["É", "naïve", "X9", "a" * 300]
    p = 1 / np.arange(1, len(vocabulary) + 1)
    draw = lambda n: rng.choice(["-", " ", ", ", "\x00", "\x7f"]).join(rng.choice(vocabulary, n, p=p / p.sum()))
    docs = [(int(i), draw(int(rng.integers(0, 40))), "en") for i in range(400)]
    docs += [docs[7], docs[7], (None, docs[7][1], "en"), (500, docs[9][1], "en"), (501, None, "en"), (502, " -- ", None), (503, "t0 " * 4000, "en")]
    items = [(int(i), draw(int(rng.integers(1, 15)))) for i in range(40)]
    return docs, items + [(40, None), (41, ""), (42, "nowhere"), (43, "t1 T1 t1"), (3, "t5 x9"), (None, "t2 t3"), (44, " ".join(vocabulary))]


@pytest.mark.parametrize("tile,leaf,items,most", [(8192, 64, 256, 32768), (16, 2, 256, 32768), (50, 5, 6, 20)])
def test_search_equals_brute_force(spark, search_rows, tile, leaf, items, most, monkeypatch):
    for name, value in (("TILE", tile), ("LEAF", leaf), ("ITEMS", items), ("TERMS", most)):
        monkeypatch.setattr(balltree, name, value)
    docs, queries = search_rows
    table = spark.createDataFrame([(i, t, 1) for i, t in queries], "item_id long, text string, score int")
    blocks = lambda t: balltree_blocks(t, items, most)
    monkeypatch.setattr(balltree, "item_blocks", blocks)
    block = balltree.search_block
    monkeypatch.setattr(balltree, "search_block", lambda d, t, k: block(d, t, k, tile, leaf))
    got = balltree.rank(docs_of(spark, docs).repartition(3), table).collect()
    assert Counter((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got) == brute_rank(docs, queries)


balltree_blocks = balltree.item_blocks


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(6)
    size, at, value = 50, [], []
    for group in range(8):                               # tight groups of documents with few terms in common
        for _ in range(64):
            own = np.unique(np.concatenate([rng.choice(6, 4, replace=False) + 6 * group, rng.choice(50, 1)]))
            at.append(own)
            value.append(rng.integers(400_000, 420_000, len(own)))
    weights = np.zeros((size, 8))
    for q in range(8):
        weights[6 * q:6 * q + 6, q] = rng.integers(3000, 9000, 6)
    dense = np.zeros((len(at), size))
    for i, (a, v) in enumerate(zip(at, value)):
        dense[i, a] = v
    tile = balltree.Tile(np.arange(len(at)), at, value)
    root = balltree.build(tile, size, 16)
    todo, leaves = [root], 0
    while todo:
        node = todo.pop()
        best = (dense[tile.ids[node.lo:node.hi]] @ weights).max(axis=0)
        assert (balltree.bounds(node, weights) >= best).all()
        todo.extend(node.below)
        leaves += not node.below
    lists = balltree.Lists(8, 10)
    scored = balltree.search(balltree.Tile(np.arange(len(at)), at, value), weights, lists, True, 16)
    assert scored < leaves * 8                           # some subtrees are pruned
    for q in range(8):
        want = sorted(zip(-(dense @ weights)[:, q], range(len(at))))[:10]
        assert [(int(-s), i) for s, i in want] == list(zip(lists.score[q].tolist(), lists.id[q].tolist()))


def test_search_in_int64_where_floats_are_too_small(spark, search_rows):
    docs, _ = search_rows
    at, value = [np.array([0, 1])] * 3, [np.array([10 ** 6, 10 ** 6 - i]) for i in range(3)]
    weights = np.array([[2.0 ** 40], [2.0 ** 40 + 1]])
    lists = balltree.Lists(1, 2)
    balltree.search(balltree.Tile([5, 6, 7], at, value), weights, lists, False)
    assert lists.score[0].tolist() == [2 ** 40 * 10 ** 6 + (2 ** 40 + 1) * (10 ** 6 - i) for i in range(2)]


def test_search_of_odd_tables(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "the cat"), (2, None), (None, "katze DOG")], "item_id long, text string")
    rows = [(r["doc_id"], r["text"], None) for r in odd_docs.collect()]
    got = balltree.rank(odd_docs, items).collect()
    assert Counter((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got) == brute_rank(rows, [(1, "the cat"), (2, None), (None, "katze DOG")])
    assert balltree.rank(no_docs, items).count() == 0
    assert balltree.rank(odd_docs, items.where("item_id = 2")).count() == 0
    assert balltree.rank(odd_docs, items.limit(0)).count() == 0
