"""Classifiers, language ID and PII: held-out accuracy on the given tables, exact rules by brute force, odd inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from replylens.llm import langid, pii, quality, toxicity
from replylens.llm.common import held_out
from replylens.llm.queries import QUERIES
from tests.conftest import SMALL


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    for v in np.unique(score):                               # ties share their mean rank
        rank[score == v] = rank[score == v].mean()
    pos = label == 1
    return (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


@pytest.mark.parametrize("name, column, mod, rest, least", [("op2_toxicity", "toxic", 3, 1, 0.8), ("op5_quality", "quality", 5, 0, 0.95)])
def test_held_out_accuracy(spark, name, column, mod, rest, least):
    out = QUERIES[name](spark, SMALL).toPandas()
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").toPandas()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert len(out) == docs.count() and out.score.between(0, 1).all()
    assert (out.held_out == out.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % mod == rest)).all()
    got = out[out.held_out].merge(labels, on="doc_id")
    assert auc(got.score.to_numpy(), got[column].to_numpy()) >= least
    assert (out.predicted == (out.score >= (0.7 if column == "toxic" else 0.3))).all()


def test_language_accuracy(spark):
    out = QUERIES["op3_language_id"](spark, SMALL).toPandas()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang", "n_chars").toPandas()
    got = out[out.held_out].merge(docs[docs.lang.notna()], on="doc_id")
    assert (got.lang_pred == got.lang).mean() >= 0.97 and out.score.between(0, 1).all()


def test_out_of_place_distance_by_brute_force():
    """The vectorised distance against the definition."""
    texts = {"en": "the cat and the dog sat on the mat", "de": "der hund und die katze sind im haus"}

    def grams(text):
        c = Counter()
        for w in re.findall(r"[^\W\d_]+", text.lower()):
            p = f" {w} "
            for n in (1, 2, 3):
                for i in range(len(p) - n + 1):
                    if p[i:i + n] != " ":
                        c[p[i:i + n]] += 1
        return c

    def code(g):
        x = 0
        for ch in g:
            x = x << 21 | ord(ch)
        return x

    def ranked(c, size):
        return [code(g) for g, _ in sorted(c.items(), key=lambda kv: (-kv[1], code(kv[0])))][:size]

    size = 12
    profiles = [(lang, c, r) for lang, t in texts.items() for r, c in enumerate(ranked(grams(t), size))]
    langs, codes, ranks = langid.rank_table(profiles, size)
    text = "the dog and the house"
    got = langid.distances(Counter(text.split()), codes, ranks, size)
    for j, lang in enumerate(langs):
        place = {c: r for r, c in enumerate(ranked(grams(texts[lang]), size))}
        own = ranked(grams(text), size)
        want = sum(abs(i - place[c]) if c in place else size for i, c in enumerate(own)) / (size * len(own))
        assert got[j] == pytest.approx(want)


def test_odd_inputs(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (7, 0, 1), (None, 1, 1), (2, None, None), (99, 1, 1)], "doc_id long, quality int, toxic int")
    learn = lambda i: ~held_out(i, 3, 1)
    for docs, lab in ((odd_docs, labels), (odd_docs, labels.limit(0)), (no_docs, labels)):
        n = docs.count()
        tox = toxicity.score(docs, toxicity.train(docs, lab, learn), ["doc_id"]).collect()
        qual = quality.score(docs, quality.train(docs, lab, learn), ["doc_id"]).collect()
        assert len(tox) == len(qual) == n and all(0 <= r["score"] <= 1 for r in tox + qual)
        profiles = langid.train(docs, F.col("lang"))
        found = langid.predict(docs.select("doc_id", "text"), profiles, ["doc_id"]).collect()
        assert len(found) == n
        und = {r["doc_id"] for r in found if r["lang_pred"] == "und"}
        assert und == ({2, 3, 4, 6} if n else set())
        model = pii.train(docs, made=60, epochs=1)
        assert pii.find(docs, model).count() == n
        assert sorted(map(str, pii.masked_documents(docs, model).select("doc_id", "lang", "score").collect())) == sorted(map(str, docs.select("doc_id", "lang", "score").collect()))


def test_nnpu_recovers_positives_among_unlabelled():
    rng = np.random.default_rng(0)
    clean = lambda: rng.choice(np.arange(100, 400, dtype="u4"), 20)
    toxic = lambda: np.concatenate([clean(), rng.choice(np.arange(1, 6, dtype="u4"), 2)])
    pos = [np.unique(toxic()) for _ in range(150)]
    unl = [np.unique(toxic() if i % 10 == 0 else clean()) for i in range(900)]
    codes = np.arange(400, dtype="u4")
    n, m = (np.bincount(np.concatenate(x), minlength=400) for x in (pos, unl))
    features = toxicity.best_codes(codes, n, m, len(pos), len(unl))
    assert set(range(1, 6)) <= set(features)
    prior = toxicity.held_prior(n[features], m[features], len(pos), len(unl), 0.3)
    assert 0.05 < prior < 0.2
    w, b = toxicity.fit(toxicity.design(pos, features), toxicity.design(unl, features), prior)
    score = toxicity.sigmoid(toxicity.design([np.unique(toxic()) for _ in range(200)] + [np.unique(clean()) for _ in range(200)], features) @ w + b)
    assert (score[:200] >= 0.7).mean() > 0.85 and (score[200:] >= 0.7).mean() < 0.03


@pytest.mark.parametrize("prior,negative", [(0.2, False), (0.9, True)])
def test_nnpu_slopes_are_the_gradient_of_the_corrected_risk(prior, negative):
    """Against numerical derivatives: of p E[l(+)] + E_u[l(-)] - p E_p[l(-)], or up the last two terms where they are negative."""
    rng = np.random.default_rng(7)
    zp, zu = rng.normal(2.0 if negative else 0.0, 1, 9), rng.normal(-3.0 if negative else 0.0, 1, 14)
    clean = lambda p, u: np.logaddexp(0, u).mean() - prior * np.logaddexp(0, p).mean()
    whole = lambda p, u: prior * np.logaddexp(0, -p).mean() + clean(p, u)
    assert (clean(zp, zu) < -toxicity.SLACK) == negative
    goal = (lambda p, u: -toxicity.STEP_BACK * clean(p, u)) if negative else whole
    dp, du = toxicity.slopes(zp, zu, prior)
    for k in range(len(zp)):
        e = np.eye(len(zp))[k] * 1e-5
        assert dp[k] == pytest.approx((goal(zp + e, zu) - goal(zp - e, zu)) / 2e-5, abs=1e-7)
    for k in range(len(zu)):
        e = np.eye(len(zu))[k] * 1e-5
        assert du[k] == pytest.approx((goal(zp, zu + e) - goal(zp, zu - e)) / 2e-5, abs=1e-7)


def test_best_codes_equal_the_likelihood_ratio():
    rng = np.random.default_rng(3)
    n, m, n_pos, n_unl = rng.integers(0, 30, 50), rng.integers(0, 300, 50), 30, 400

    def gain(a, c):
        if a < toxicity.MIN_POSITIVE_DOCS or a / n_pos <= c / n_unl:
            return 0.0
        share = (a + c + 0.5) / (n_pos + n_unl + 1)
        side = lambda k, t: (k * math.log(k / t / share) if k else 0) + ((t - k) * math.log((1 - k / t) / (1 - share)) if k < t else 0)
        return side(a, n_pos) + side(c, n_unl)
    want = [i for i in range(50) if gain(int(n[i]), int(m[i])) >= toxicity.MIN_GAIN]
    assert toxicity.best_codes(np.arange(50), n, m, n_pos, n_unl).tolist() == want


def test_toxicity_learns_from_every_unlabelled_row(spark):
    """Shards of a few rows: all rows count, and the models still find the toxic words."""
    rng = np.random.default_rng(1)
    words = [f"word{i}" for i in range(200)]
    rows = [(i, " ".join([*rng.choice(words, 20), *(rng.choice(["vile", "nasty", "hateful"], 2) if i % 8 == 0 else [])])) for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 8 == 0)) for i in range(0, 1200, 2)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, lambda i: ~held_out(i, 3, 1), shard_rows=150)
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, model, ["doc_id"]).collect()}
    assert np.mean([got[i] for i in range(0, 1200, 8)]) > 0.9 and np.mean([got[i] for i in range(1200) if i % 8]) < 0.02


def test_shallow_trees_and_quads_take_the_best_split():
    """One cut of a tree, and the 2 x 2 split of a pair's table, against all of them."""
    rng = np.random.default_rng(5)
    for _ in range(30):
        n = int(rng.integers(2, 12))
        g, h, c = rng.normal(size=n), rng.random(n) + 0.1, rng.integers(0, 40, n).astype(float)
        value = lambda a, b: g[a:b].sum() ** 2 / (h[a:b].sum() + 1.0)
        cuts = [(value(0, k) + value(k, n) - value(0, n), k) for k in range(1, n)
                if min(c[:k].sum(), c[k:].sum()) >= quality.MIN_LEAF]
        gain, k = max(cuts, default=(0, 0))
        parts = [(0, k), (k, n)] if gain > 1e-9 else [(0, n)]
        want = np.concatenate([np.full(b - a, -g[a:b].sum() / (h[a:b].sum() + 1.0)) for a, b in parts])
        assert np.allclose(quality.shallow_tree(g, h, c, cuts=1), want)
        G, H = rng.normal(size=(n, 5)), rng.random((n, 5)) + 0.1
        score = lambda i, j: sum(G[r, s].sum() ** 2 / (H[r, s].sum() + 1.0)
                                 for r in (slice(0, i), slice(i, None)) for s in (slice(0, j), slice(j, None))) - G.sum() ** 2 / (H.sum() + 1.0)
        best = max(((score(i, j), i, j) for i in range(1, n) for j in range(1, 5)))
        got = quality.best_quad(G, H)
        assert got[0] == pytest.approx(best[0]) and got[1:] == best[1:]


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(2)
    x = rng.random((1500, len(quality.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x[:1000], y[:1000])
    got = quality.apply(model, x[1000:])
    assert ((got > 0.5) == (y[1000:] > 0.5)).mean() > 0.9
    assert any({i, j} == {0, 1} for i, j, _ in model["pairs"])


# --- personal data

KIND_RULES = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(re.sub("[^0-9]", "", s)) <= 19 and pii.luhn(re.sub("[^0-9]", "", s))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(re.sub("[^0-9]", "", s)) <= 15),
]


def plain_base(text):
    out = []
    for kind, pattern, ok in KIND_RULES:
        out += [f"{kind}:{m.start()}:{m.end()}" for m in re.finditer(pattern, text) if ok(m[0])]
    return out


SAMPLES = ["", "a@b.c@d.e f@g", "x a.b+c@d-e.f.g. @h.i j@k", "1.2.3.4.5.6.7.8 300.1.1.1 0001.2.3.255", "4111 1111 1111 1111 and 4111-1111-1111-1112",
           "+1 (555) 123-4567, + 12345678, +12 3", "tel +44 20 7946 0958. x@y.zz_q@r.ss", "12 4111111111111111", "é ü 10.0.0.1 ñ@a.b 🙂 q@w.er"]


@pytest.mark.parametrize("text", SAMPLES)
def test_base_spans_are_the_plain_rules(text):
    assert pii.spans_text(pii.base_spans(text)).split(",") == (plain_base(text) or [""])


def test_luhn():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112") and pii.luhn("79927398713")


def test_base_spans_on_random_text():
    rng = np.random.default_rng(4)
    for _ in range(400):
        text = "".join(rng.choice(list("a1.@+- ()9Z_\n%"), int(rng.integers(0, 40))))
        assert pii.spans_text(pii.base_spans(text)).split(",") == (plain_base(text) or [""])


@pytest.fixture(scope="module")
def network():
    return pii.fit(*pii.labelled_windows(pii.made_up([])))


def test_gradient_matches_differences():
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, pii.CODES, (3, 7)), rng.integers(0, pii.TAGS, (3, 7))
    live = np.ones((3, 7), bool)
    live[1, 5:] = False
    model = {k: v.astype("f8") for k, v in pii.new_model().items()}
    loss = lambda: pii.crf_grad(model, pii.emissions(model, x).astype("f8"), y, live)[0]
    _, de, dtrans, dstart = pii.crf_grad(model, pii.emissions(model, x).astype("f8"), y, live)
    for name, grad, at in (("trans", dtrans, (1, 2)), ("start", dstart, (3,)), ("out_b", de.sum((0, 1)), (2,))):
        keep, h = model[name][at], 1e-4
        model[name][at] = keep + h
        up = loss()
        model[name][at] = keep - h
        down = loss()
        model[name][at] = keep
        assert (up - down) / (2 * h) == pytest.approx(grad[at], abs=2e-3)


def test_viterbi_by_brute_force():
    import itertools
    rng = np.random.default_rng(1)
    model = {"trans": rng.normal(0, 1, (pii.TAGS, pii.TAGS)), "start": rng.normal(0, 1, pii.TAGS)}
    e = rng.normal(0, 1, (2, 4, pii.TAGS))
    lengths = np.array([4, 3])
    got = pii.viterbi(model, e, lengths)
    for r in range(2):
        best = None
        for path in itertools.product(range(pii.TAGS), repeat=int(lengths[r])):
            if any(t and t % 2 == 0 and (i == 0 or path[i - 1] not in (t, t - 1)) for i, t in enumerate(path)):
                continue
            s = model["start"][path[0]] + e[r, 0, path[0]] + sum(model["trans"][path[i - 1], t] + e[r, i, t] for i, t in enumerate(path) if i)
            best = max(best or (s, path), (s, path))
        assert tuple(got[r, :lengths[r]]) == best[1]


def test_network_adds_spans_the_rules_miss(network):
    held_out_samples = pii.made_up(["alpha", "beta", "gamma", "delta"], 300, seed=99)
    hit = miss = wrong = 0
    for text, spans in held_out_samples:
        base, every = pii.find_in(network, [text])[0]
        assert set(base) <= set(every)
        added, want = set(every) - set(base), set(spans) - set(base)
        hit += len(added & want)
        miss += len(want - set(every))
        wrong += len([a for a in added - set(spans) if not any(a[1] < e and s < a[2] for _, s, e in spans)])
    assert hit > 0.7 * (hit + miss) and wrong <= 0.05 * (hit + miss)


def test_overlapping_windows_agree_wherever_a_span_lies(network):
    for pad in range(0, 80, 7):
        text = "w " * 40 + "x" * pad + " mail ab.cd_x(at)mail1.example.com now " + "y " * 60
        spans = pii.find_in(network, [text])[0][1]
        assert [text[s:e] for _, s, e in spans] == ["ab.cd_x(at)mail1.example.com"]


def numbers_text(chars):
    """Digit-dense text: one run of windows all through."""
    rng = np.random.default_rng(5)
    made = [t for t, _ in pii.made_up(["a"], 200, seed=5)]
    parts, n = [], 0
    while n < chars:
        parts.append(str(int(rng.integers(1, 10 ** 9))) if rng.random() < 0.7 else made[int(rng.integers(len(made)))])
        n += len(parts[-1]) + 1
    return " ".join(parts)[:chars]


def test_pieces_give_the_path_of_the_whole_run(network, monkeypatch):
    texts = [numbers_text(n) for n in (1, 63, 64, 65, 127, 128, 129, 3000, 7777)] + ["w " * 300 + numbers_text(900) + " w" * 300, "0" * 1000, ""]
    monkeypatch.setattr(pii, "PIECE", 10 ** 6)
    whole = pii.decode(network, texts)
    assert sum(map(len, whole)) > 100
    for piece in (64, 128, 1024):
        monkeypatch.setattr(pii, "PIECE", piece)
        monkeypatch.setattr(pii, "CELLS", 3 * piece)
        assert [sorted(r) for r in pii.decode(network, texts)] == [sorted(r) for r in whole]


def test_path_in_pieces_by_whole_viterbi():
    rng = np.random.default_rng(2)
    for scale in (0.01, 1.0):
        model = {"trans": rng.normal(0, 2, (pii.TAGS, pii.TAGS)), "start": rng.normal(0, 1, pii.TAGS)}
        e = rng.normal(0, scale, (1, 500, pii.TAGS))
        score, back = pii._forward(pii._transitions(model), e[:, 1:], np.array([499]), pii._first_scores(model, e[:, 0]))
        path, rows = pii.Path(500), np.concatenate([np.zeros((1, pii.TAGS), np.int8), back[0]])
        for a in range(0, 500, 37):
            path.add(rows[a:a + 37])
        assert (path.end(int(score[0].argmax())) == pii.viterbi(model, e, np.array([500]))[0]).all()


def test_memory_does_not_follow_the_longest_run(network):
    import tracemalloc
    texts = [numbers_text(60_000)] + ["call 12345 now"] * 127
    tracemalloc.start()
    try:
        found = pii.decode(network, texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found[0] and peak < 100_000_000


def test_added_spans_touch_no_base_span(network):
    text = "192.168.0.1 " * 3 + "0049 30 1234567 and 0049 30 7654321"
    read = [(1, 0, 11), (3, 36, 51), (3, 56, 71)]
    assert pii.added_spans(text, pii.base_spans(text), read) == [(3, 36, 51), (3, 56, 71)]
    assert pii.added_spans(text, [(3, 30, 40), (3, 32, 34)], read) == [(1, 0, 11), (3, 56, 71)]


def test_pii_query_contract(spark):
    out = {r["doc_id"]: r for r in QUERIES["op8_pii"](spark, SMALL).collect()}
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        got, base = out[r["doc_id"]], plain_base(r["text"] or "")
        assert got["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        spans = got["spans"].split(",") if got["spans"] else []
        assert set(base) <= set(spans)
        for k in pii.KINDS:
            assert got[f"n_{k}"] == sum(s.startswith(k + ":") for s in spans)


def test_masking():
    assert pii.mask("a b@c.de f", [(0, 2, 8)]) == "a [EMAIL] f" and pii.mask("abc", []) == "abc"
