"""Packing, mixing, fingerprints, exact search and extraction against brute force."""

import hashlib
import itertools
import re
import time
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from replylens.llm import fingerprint as fp
from replylens.llm import html_extract, mixing, packing, topk
from tests.conftest import SMOKE

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def size(text):
    return len(WORDS.findall(text or ""))


# --- packing

@pytest.mark.parametrize("buckets", [1, 2, 3, 5])
def test_boundaries_are_optimal(buckets):
    rng = np.random.default_rng(buckets)
    for _ in range(20):
        lengths = np.sort(rng.choice(np.arange(1, 60), size=int(rng.integers(1, 9)), replace=False))
        counts = rng.integers(1, 30, len(lengths))
        cost = lambda ends: sum(int(n) * (min(e for e in ends if e >= x) - int(x)) for x, n in zip(lengths, counts))
        inner, top = [int(x) for x in lengths[:-1]], int(lengths[-1])
        best = min(cost([*c, top]) for k in range(min(buckets, len(lengths))) for c in itertools.combinations(inner, k))
        got = packing.boundaries(lengths, counts, buckets)
        assert len(got) <= buckets and got[-1] == top and cost(got) == best


def test_pack_places_every_row_within_budget(spark, odd_docs, no_docs):
    rows = packing.pack(odd_docs, buckets=3, token_budget=64, block_rows=2).collect()
    want = Counter((r["doc_id"], size(r["text"])) for r in odd_docs.collect())
    assert Counter((r["doc_id"], r["n_tokens"]) for r in rows) == want
    batches = {}
    for r in rows:
        assert r["n_tokens"] <= r["bucket_len"] and r["padding"] == r["bucket_len"] - r["n_tokens"]
        batches.setdefault((r["bucket"], r["batch"]), []).append(r)
    for batch in batches.values():
        assert len(batch) == 1 or sum(r["bucket_len"] for r in batch) <= 64
        assert sorted(r["slot"] for r in batch) == list(range(len(batch)))
    for b in {k[0] for k in batches}:                      # only a bucket's last batch may be short
        numbers = sorted(k[1] for k in batches if k[0] == b)
        assert numbers == list(range(len(numbers)))
        assert all(len(batches[b, n]) == batches[b, n][0]["batch_rows"] for n in numbers[:-1])
    assert packing.pack(no_docs).count() == 0


# --- mixing

def brute_targets(sizes, repeats=3):
    """Share by weight, cap, and share the excess again until none is above."""
    keys = sorted((k for k in sizes if k is not None), key=lambda k: k.encode()) + ([None] if None in sizes else [])
    weight = {k: i % 3 + 1 for i, k in enumerate(keys)}
    target, open_, left = {}, set(keys), float(sum(sizes.values()))
    while open_:
        level = left / sum(weight[k] for k in open_)
        over = [k for k in open_ if weight[k] * level > repeats * sizes[k]]
        if not over:
            target |= {k: weight[k] * level for k in open_}
            break
        for k in over:
            target[k] = float(repeats * sizes[k])
            left -= target[k]
            open_.discard(k)
    return target


def test_targets_and_taken(spark, odd_docs):
    docs = odd_docs.unionByName(spark.createDataFrame(
        [(100 + i, "w " * (i % 40 + 1), "en", "abcde"[i % 5], 1, None, None, None, None) for i in range(300)], odd_docs.schema))
    rows = mixing.mix(docs, block_words=4, shard_rows=50).collect()
    sizes = {}
    for r in docs.collect():
        sizes[r["source"]] = sizes.get(r["source"], 0) + size(r["text"])
    want = brute_targets(sizes)
    by_id = {r["doc_id"]: r["source"] for r in docs.collect()}
    taken = Counter()
    for r in rows:
        s = by_id[r["doc_id"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[s] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 4 * 10 + 0.02 * want[s]
    again = mixing.mix(docs, block_words=4, shard_rows=50).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_apportionment_is_highest_quotients(spark):
    rng = np.random.default_rng(1)
    for seats in (0, 1, 7, 50, 333):
        votes = [float(x) for x in rng.integers(0, 1000, 9)]
        quotients = sorted(((v / (2 * k + 1), -i) for i, v in enumerate(votes) if v for k in range(seats)), reverse=True)[:seats]
        want = Counter(-i for _, i in quotients)
        df = spark.createDataFrame([(i, v) for i, v in enumerate(votes)], "k int, votes double")
        got = {r["k"]: r["s"] for r in mixing.apportion(df, [], "k", "votes", F.lit(seats), "s").collect()}
        assert got == {i: want.get(i, 0) for i in range(9)}


def test_mixed_documents_hold_the_taken_words(spark, odd_docs, no_docs):
    plan = mixing.mix(odd_docs, block_words=4)
    want = Counter()
    for r in plan.collect():
        want[r["doc_id"]] += r["taken"]
    out = mixing.mixed_documents(odd_docs, block_words=4)
    assert out.columns == odd_docs.columns
    got = Counter()
    for r in out.collect():
        got[r["doc_id"]] += size(r["text"])
        assert r["n_chars"] == len(r["text"])
    assert +got == +want
    assert mixing.mix(no_docs).count() == 0 and mixing.mixed_documents(no_docs).count() == 0


def test_mixed_documents_equal_the_plan_word_by_word(spark):
    """The pipeline's stage against texts cut in Python by the plan's passes and parts."""
    rng = np.random.default_rng(9)
    rows = [(i if i % 9 else None, " ".join(f"w{i}x{k}" for k in range(int(rng.integers(0, 60)))), f"s{i % 4}") for i in range(250)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    options = dict(block_words=5, shard_rows=60)
    texts = {(i, size(t)): t for i, t, _ in rows if i is not None}
    want = Counter()
    for r in mixing.mix(docs.where("doc_id is not null"), **options).collect():
        words = WORDS.findall(texts[r["doc_id"], r["size"]])
        if r["size"]:
            want[r["doc_id"], " ".join(words)] += r["passes"]
            cut = [w for p in r["parts"] for w in words[p["first"]:p["first"] + p["words"]]]
            want[r["doc_id"], " ".join(cut)] += bool(cut)
    got = Counter((r["doc_id"], r["text"]) for r in mixing.mixed_documents(docs.where("doc_id is not null"), **options).collect())
    assert got == +want
    taken = {(r["doc_id"], r["taken"]) for r in mixing.mix(docs, **options).collect() if r["doc_id"] is None}
    assert len({t for _, t in taken}) > 2                     # rows without an id are placed apart


def test_mixing_is_linear_in_the_text(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{k}" for k in range(160_000)), f"s{i}") for i in range(3)], "doc_id long, text string, source string")
    began = time.time()
    out = mixing.mixed_documents(docs).select(F.size(F.split("text", " ")).alias("n")).agg(F.sum("n")).first()[0]
    assert abs(out - 480_000) <= 3 * 64 and time.time() - began < 60


# --- fingerprints

def test_fingerprint_contract(spark, odd_docs, no_docs):
    docs = odd_docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    rows = sorted(docs.collect(), key=lambda r: r["doc_id"])
    got = {r["doc_id"]: r for r in fp.fingerprints(docs, bucket_rows=2).collect()}
    texts = [r["text"] or "" for r in rows]
    for i, r in enumerate(rows):
        t, nxt = texts[i], texts[(i + 1) % len(texts)]
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        g = got[r["doc_id"]]
        assert g["n_chars"] == len(t) and g["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= g["near_edited"] <= 1 and 0 <= g["near_next"] <= 1
    assert got[1]["fingerprint"] == got[8]["fingerprint"] != got[7]["fingerprint"]
    assert fp.fingerprints(odd_docs).count() == odd_docs.count() and fp.fingerprints(no_docs).count() == 0


def lanes(text):
    """Sentences, exact lanes and sketch words of a text, summed paragraph by paragraph in Python."""
    def h(x, mark):
        first = xxhash.xxh64_intdigest(x.encode(), 42)
        return xxhash.xxh64_intdigest(mark.encode(), first)
    n, exact, sums = 0, [0] * fp.EXACT, np.zeros((fp.PLANES, 2, fp.LANES), object)
    for p in text.split("\n"):
        if not p.strip(" "):
            continue
        for i in range(fp.EXACT):
            exact[i] = (exact[i] + (h(p, f"x{i}") & fp.LOW)) % 2 ** 32
        for s in [x for x in re.split(r"[.!?]+", p) if x.strip(" ")] or [p]:
            n += 1
            for plane in range(fp.PLANES):
                v = h(s.strip(" "), f"s{plane}")
                for b in range(fp.LANES):
                    sums[plane, 0, b] += v >> b & 1
                    sums[plane, 1, b] += v >> (b + 31) & 1
    return n, exact, sums


def brute_likeness(a, b):
    if a[0] == b[0] and a[1] == b[1] and (a[2] == b[2]).all():
        return 1.0
    x, y = 2 * a[2] - a[0], 2 * b[2] - b[0]
    both = (x * x).sum() + (y * y).sum()
    return min(1.0, max(0.0, 2.0 * (x * y).sum() / both)) if both else 0.0


def hexed(v):
    words = [v[0], *v[1], *(int(v[2][p, 0, b]) + (int(v[2][p, 1, b]) << 31) for p in range(fp.PLANES) for b in range(fp.LANES))]
    return "".join(f"{w:016X}" for w in words)


def signed_hash(text):
    x = xxhash.xxh64_intdigest(text.encode(), 42)
    return x - 2 ** 64 if x >= 2 ** 63 else x


@pytest.mark.parametrize("bucket_rows", [1, 3, 7, 1000])
def test_fingerprints_equal_brute_force(spark, bucket_rows):
    """Clustered ids with far outliers, one id and the null id in many rows, equal rows."""
    rng = np.random.default_rng(bucket_rows)
    draw = lambda: "".join(rng.choice(["One line here. ", "Two! ", "\n", "more words", "...", "é", "  "], int(rng.integers(0, 12))))
    ids = [*range(5000, 5040), -(10 ** 15), 10 ** 17, *[77] * 30, *[None] * 25, 2 ** 62]
    rows = [(i, draw()) for i in ids] + [(78, None), (5003, draw())]
    rows += [rows[0], rows[45]]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, bucket string")
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, signed_hash(r[1]), r[1]))
    want = Counter()
    for k, (i, t) in enumerate(order):
        nxt = order[(k + 1) % len(order)][1]
        edited = t[:len(t) - len(t) // 2] + nxt[:len(t) // 2]
        a, b, c = lanes(t), lanes(edited), lanes(nxt)
        want[(i, len(t), hashlib.sha256(edited.encode()).hexdigest(), hexed(a), hexed(b), round(brute_likeness(a, b), 9), round(brute_likeness(a, c), 9))] += 1
    got = Counter((r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"], round(r["near_edited"], 9),
                   round(r["near_next"], 9)) for r in fp.fingerprints(docs, bucket_rows).collect())
    assert got == want


def test_ranges_hold_few_rows_whatever_the_ids(spark):
    ids = [*range(8000), 10 ** 15, *[123] * 4000, *[None] * 3000]
    docs = spark.createDataFrame([(i, f"text {k}") for k, i in enumerate(ids)], "doc_id long, text string")
    sizes = fp.with_next(docs, 500).where("home").groupBy("bucket").count().collect()
    assert sum(r["count"] for r in sizes) == len(ids) and max(r["count"] for r in sizes) <= 1500


def vec(spark, text):
    df = spark.createDataFrame([(0, text)], "k int, t string")
    return fp.vector_sums(df, ["k"], "t").select(fp.packed().alias("v"))


def test_fingerprint_is_homomorphic(spark):
    a, b = "One line. Two parts!\nAnother line", "Some more.\nOne line. Two parts!"
    va, vb, both = vec(spark, a), vec(spark, b), vec(spark, b + "\n" + a)
    r = (va.select(F.col("v").alias("a")).crossJoin(vb.select(F.col("v").alias("b"))).crossJoin(both.select(F.col("v").alias("c")))
         .select((fp.combine(F.col("a"), F.col("b")) == F.col("c")).alias("add"), (fp.combine(F.col("c"), F.col("b"), -1) == F.col("a")).alias("del"),
                 fp.likeness(F.col("a"), F.col("a")).alias("same")).first())
    assert r["add"] and r["del"] and r["same"] == 1.0
    assert vec(spark, "x.\ny").first() == vec(spark, "y\n\nx.").first()


def test_likeness_follows_shared_sentences(spark):
    s = [f"sentence number {i} here" for i in range(400)]
    texts = [". ".join(s[:200]), ". ".join(s[100:300]), ". ".join(s[200:])]
    v = [vec(spark, t).first()["v"] for t in texts]
    df = spark.createDataFrame([(v[0], v[1], v[2])], "a array<long>, b array<long>, c array<long>")
    r = df.select(fp.likeness(F.col("a"), F.col("b")).alias("half"), fp.likeness(F.col("a"), F.col("c")).alias("none")).first()
    assert abs(r["half"] - 0.5) < 0.2 and r["none"] < 0.2


# --- exact top-k

def brute_top(rows, queries, k):
    out = []
    for q, qv in queries:
        scored = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in rows if i != q and len(v) == len(qv))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def test_top_k_matches_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(0, 1, 6)]) for i in range(150)]
    rows += [(200 + i, rows[0][1]) for i in range(30)]                     # ties beyond k
    odd = [(500, None), (501, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (502, [float("nan")] * 6), (503, [float("inf")] * 6), (504, []), (505, [0.5, 0.25]), (506, [1.0, 2.0])]
    df = spark.createDataFrame(rows + odd, "id long, vec array<double>")
    whole = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows + [(505, [0.5, 0.25]), (506, [1.0, 2.0])]]
    queries = [(i, v) for i, v in whole if i % 5 == 0]
    got = topk.top_k(df, df.where("id % 5 = 0"), k=5, tile_rows=16, query_rows=7, fan_in=3)
    assert sorted(tuple(r) for r in got.select("query_id", "rank", "id", "score").collect()) == brute_top(whole, queries, 5)
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0
    assert topk.top_k(df.where("id < 3"), df.where("id = 0")).count() == 2   # fewer candidates than k


def test_top_k_broadcasts_nothing(spark):
    """Blocks go to every rack, so a plan that takes them for small would send all their copies through the driver."""
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.normal(0, 1, 4)]) for i in range(90)]
    df = spark.createDataFrame(rows, "id long, vec array<double>")
    got = topk.top_k(df, df.where("id % 9 = 0"), k=3, tile_rows=8, query_rows=4, fan_in=2)
    whole = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows]
    assert sorted(tuple(r) for r in got.collect()) == brute_top(whole, [q for q in whole if q[0] % 9 == 0], 3)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan and "Broadcast" not in plan and "Join" not in plan


@pytest.mark.parametrize("top, tile", [(9, 16), (9, 1000), (3000, 16), (10 ** 8, 16), (2 ** 62, 16)])
def test_rack_keeps_the_best_over_its_tiles(top, tile):
    """Single and double floats and wrapping integers; ties within and across tiles, repeated ids, own rows, ascending scores."""
    rng = np.random.default_rng(7)
    vecs = rng.integers(-top, top, (600, 3), endpoint=True)
    vecs[200:400] = vecs[0]
    vecs[400:500] = np.sort(vecs[400:500], axis=0)
    ids = np.r_[rng.permutation(500), np.repeat([3, 7, 900], [40, 40, 20])]
    rack = topk._Rack([(ids[i:i + 37], vecs[i:i + 37]) for i in range(0, 600, 37)], tile)
    asked = np.array([3, 7, 900, -1, 444, 10 ** 6])
    q = np.r_[rng.integers(-top, top, (5, 3), endpoint=True), vecs[:1]]
    row, found, score = rack.search(asked, q, 5)
    scores = q @ vecs.T
    want = []
    for r, a in enumerate(asked):
        want += [(r, i, -s) for s, i in sorted((-int(s), int(i)) for s, i in zip(scores[r], ids) if i != a)[:5]]
    assert list(zip(row.tolist(), found.tolist(), score.tolist())) == want
    few = topk._Rack([(ids[:3], vecs[:3])], tile).search(ids[:1], vecs[:1], 5)
    assert len(few[0]) == 2


def test_top_k_of_large_components(spark):
    rows = [(i, [(-1.0) ** i * (1e7 + i), 0.5]) for i in range(20)] + [(100, [2.0, 1.0]), (101, [1e300, 0.0]), (102, [1.1e7, -1.1e7])]
    df = spark.createDataFrame(rows, "id long, vec array<double>")
    whole = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows if i != 101]
    queries = [(i, v) for i, v in whole if i == 100]
    got = topk.top_k(df.where("id <> 101"), df.where("id = 100"), k=8, tile_rows=6)
    assert sorted(tuple(r) for r in got.select("query_id", "rank", "id", "score").collect()) == brute_top(whole, queries, 8)
    assert [r[0][0] for r in df.where("id = 101").select(topk.quantised(df.vec)).collect()] == [2 ** 63 - 1]


def test_repeated_query_ids_ask_with_one_fixed_vector(spark):
    df = spark.createDataFrame([(1, [4.0, 1.0]), (2, [1.0, 4.0])], "id long, vec array<double>")
    asked = [(9, [1.0, 0.0]), (9, [0.0, 1.0])]
    for q in (asked, asked[::-1]):
        got = topk.top_k(df, spark.createDataFrame(q, "id long, vec array<double>").coalesce(1), k=1).collect()
        assert [(r["query_id"], r["id"], r["score"]) for r in got] == [(9, 2, 4 * 256 * 256)]


# --- extraction

PAGE = """<!DOCTYPE html><html><head><title>T, t, t</title><style>p{}</style><script>var t="</p><p>no";</script></head><body>
<header><h2>Site</h2></header><nav><ul><li><a href="/a">One</a></li></ul></nav><div class="cookie-notice">We use cookies, you know, a lot.</div>
<div id="wrap"><div class="sidebar">Side, side, side text that is long enough to look like prose, really.</div>
<article><h1>Head &amp; line</h1><p>First   paragraph, with
 <b>bold</b> text.<p>Second&nbsp;one &lt;x&gt;, <a href="#">linked</a> word.<form><input><p>Name, please</p></form>
<section class="comments"><p>Nice, article, thanks, a lot, friend, for, this.</p></section></article>
<div class="ad">Buy, buy, buy this now, it is good, and cheap.</div></div><footer>&copy; Site</footer></body></html>"""


def test_main_text():
    assert html_extract.main_text(PAGE) == "Head & line First paragraph, with bold text. Second one <x>, linked word."
    assert html_extract.main_text(None) == "" and html_extract.main_text("  ") == "" and html_extract.main_text("<p></p>") == ""
    assert html_extract.main_text("just text &amp; more") == "just text & more"
    div = "<body><div class=menu><a href=1>a</a> <a href=2>b</a></div><div id=c><p>Some text, long, with, commas and words.</p><p>More of it, and more.</p></div></body>"
    assert html_extract.main_text(div) == "Some text, long, with, commas and words. More of it, and more."


def test_names_that_mislead():
    page = ("<div class='layout has-sidebar'><article class='post'><p>The text, as it is, of the article.</p></article>"
            "<section id='comments'><article class='comment-body'><p>Reader, one, says, a lot, of, things, here.</p></article></section></div>")
    assert html_extract.main_text(page) == "The text, as it is, of the article."


BODY = "<p>The text, as it is, of the story.</p><p>More of it, and it goes on, for a while.</p>"
BODY_TEXT = "The text, as it is, of the story. More of it, and it goes on, for a while."


@pytest.mark.parametrize("page", [
    f"<div id='content' class='no-sidebar'>{BODY}</div>",
    f"<div class='post comments-open'>{BODY}</div>",
    f"<div class='layout has-sidebar'><div class='entry'>{BODY}</div><div class='sidebar'>Side text.</div></div><p><a href=1>Home</a></p>",
    f"<form action='x'><div class='menu'><a href=1>a</a></div><div>{BODY}</div><input></form>",
    f"<form action='x'><main>{BODY}</main></form>",
    f"<div class='sidebar-right'><div>{BODY}</div><div class='sidebar'>Side text.</div></div><div><a href=1>Home</a></div>",
    f"<div class='related'><div class='comments'>{BODY}</div></div>",
    f"<article class='post category-related comments-open'>{BODY}</article>",
    f"<article><div class='content-with-sidebar search'>{BODY}</div></article>",
    f"<div class='cookie-consent'>{'We use cookies, and we like them. ' * 9}</div><div class='c'>{BODY}</div>",
    f"<div class='c'>{BODY}</div><div class='comments'>{'I say, that is, so good. ' * 20}</div>",
    f"<div class='c'>{BODY}</div><div class='post-comments'>{'I say, that is, so good. ' * 20}</div>",
    f"<article>{BODY}</article><div class='sidebar'>{'Side text, long, and so on. ' * 20}</div>",
])
def test_unlikely_names_without_marked_article(page):
    assert html_extract.main_text(f"<html><body>{page}</body></html>") == BODY_TEXT


def test_own_headline():
    for head in ("<div class='article-header'><h1>Head</h1></div>", "<div class='header'><h1>Head</h1></div>", "<header><h1>Head</h1></header>"):
        assert html_extract.main_text(f"<article>{head}{BODY}</article>") == "Head " + BODY_TEXT
        assert html_extract.main_text(f"<div class='header'>Site</div><div class='post'>{head}{BODY}</div>") == "Head " + BODY_TEXT


LONG = "<p>" + "One more word, and then, so it goes on and on. " * 6 + "</p>"
SHORT = ["<section><h2>Second</h2><p>" + "A shorter part, with less to say, that counts. " * 3 + "</p></section>", "<section><p>Short.</p></section>",
         "<h4>Small head</h4>", "<ul><li>first</li><li>second</li></ul>", "<table><tr><td>a</td><td>b</td></tr></table>", "bare <b>words</b> here"]


def plain(markup):
    return " ".join(re.sub(r"</?(?:b|a)\b[^>]*>", "", markup).replace("<", " <").replace(">", "> ").split())


def words_of(markup):
    return re.sub(r"<[^>]*>", " ", plain(markup)).split()


@pytest.mark.parametrize("around", ["<div>%s</div>", "<div class='c'>%s</div><div class='menu'>m</div>", "%s"])
def test_sections_without_marked_article(around):
    story = f"<section>{LONG * 10}</section>" + "".join(SHORT) + f"<section>{LONG}</section>"
    links = "<ul><li><a href=1>Other</a></li><li><a href=2>Pages</a></li></ul>"
    got = html_extract.main_text(f"<html><body>{around % (story + links)}</body></html>")
    assert got.split() == words_of(story)


def test_rows_of_sections():
    story = "".join(f"<div class='row'><div>{p}</div></div>" for p in (LONG * 10, LONG, SHORT[0], SHORT[3]))
    page = f"<body><div>Tag line</div><div id='wrap'><div>{story}</div></div><div>Imprint</div></body>"
    assert html_extract.main_text(page).split() == words_of(story)
    many = "".join(f"{i} <p>Part {i}, short.</p>" for i in range(20000))
    assert html_extract.main_text(f"<div><section>{LONG * 10}</section>{many}</div>").count("short.") == 20000


@pytest.mark.parametrize("bad", ["<", "<p", "<p class='", "<!--", "<!-- x", "<script>", "</p>" * 50, "<div>" * 3000 + "x", "a < b > c", "&am", "<a b=\"" + "x" * 20000])
def test_broken_pages_do_not_fail(bad):
    assert isinstance(html_extract.main_text(bad), str)


def test_extract_frame(spark):
    df = spark.createDataFrame([(1, "u", PAGE, "x"), (2, None, None, None), (None, "v", "", ""), (1, "u", PAGE, "x")], "page_id long, url string, html string, text string")
    rows = html_extract.extract(df).collect()
    assert len(rows) == 4 and all(r["n_chars"] == len(r["text"]) for r in rows)
    assert html_extract.extract(df.limit(0)).count() == 0
    pages = spark.read.parquet(f"{SMOKE}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in html_extract.extract(pages).collect()}
    for r in pages.collect():                              # generated pages: the article element without markup
        body = re.search(r"<article>(.*?)(?:</article>|<footer>|$)", r["html"], re.S)
        if body:
            plain = re.sub(r"<br>", " ", body[1])
            plain = __import__("html").unescape(re.sub(r"<[^>]*>", " ", plain))
            assert got[r["page_id"]].split() == plain.split()


@pytest.mark.parametrize("page", [
    "".join('<div class="sidebar">' for _ in range(6000)) + "Some prose, and more. " * 20,
    "<b>" * 8000 + "".join(f"<p>paragraph {i}, and so on" for i in range(8000)),
    "<p><td>" + "<span>" * 8000 + "<div>x, y" * 4000,
    '<div class="notice">some prose here, and there ' * 8000,
    "<article>" + "<header>h" * 8000], ids=["named divs", "open inline", "open block", "nested prose", "headers"])
def test_deep_pages_take_linear_time(page):
    began = time.time()
    html_extract.main_text(page)
    assert time.time() - began < 3
