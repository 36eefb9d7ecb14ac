import random

import numpy as np

from gleanery.llm import weak_quality as Q

GOOD = "Then the small river ran on past the old mill. It was cold, and nobody saw it. "


def texts(rng, n):
    """(text, good): prose, and three kinds of junk."""
    words = [w.strip(".,") for w in GOOD.lower().split()]
    out = []
    for _ in range(n):
        prose = " ".join(rng.choice(words) + (". " if rng.random() < 0.1 else ", " if rng.random() < 0.05 else "") + "".join(rng.choices("aeioulnrst", k=rng.randint(1, 7))) for _ in range(rng.randint(20, 200))) + "."
        kind = rng.random()
        if kind < 0.8:
            out.append((prose, True))
        elif kind < 0.87:
            out.append((" ".join(w + rng.choice(["###", "%%%", "$$$"]) for w in prose.split()), False))
        elif kind < 0.94:
            out.append((" ".join(w.strip(".,") for w in prose.split()[:3] for _ in range(40)), False))
        else:
            out.append((" ".join(w.upper() + "!!" for w in prose.split()), False))
    return out


def test_posteriors_find_each_kind():
    found = texts(random.Random(1), 2000)
    patterns = [Q.pattern(Q.seen(t)[0]) for t, _ in found]
    share, accuracy, post = Q.fit_votes({p: patterns.count(p) for p in set(patterns)})
    assert 0.7 < share < 0.9 and accuracy.shape == (2, len(Q.LABELLERS)) and (accuracy[1] > 0.9).all()
    right = np.mean([(post[p] >= 0.5) == good for p, (_, good) in zip(patterns, found)])
    assert right > 0.95


def test_held_out_accuracy(spark):
    train, test = texts(random.Random(2), 1500), texts(random.Random(3), 500)
    model = Q.fit(spark.createDataFrame([(i, t) for i, (t, _) in enumerate(train)], "doc_id long, text string"))
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(test)], "doc_id long, text string")
    kept = {r["doc_id"]: r["kept"] for r in Q.classify(df, model).collect()}
    good, bad = [[kept[i] for i, (_, g) in enumerate(test) if g is want] for want in (True, False)]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.1


def test_edges(spark):
    prose = [t for t, good in texts(random.Random(7), 60) if good]
    rows = [(1, prose[0]), (1, prose[0]), (None, prose[1]), *[(100 + i, t) for i, t in enumerate(prose)], (2, None), (3, ""), (4, "\n \t"), (5, "日本語 " * 10), (6, "x " * 1_000_000)]
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, score string")
    out = Q.classify(df)
    assert out.count() == len(rows) and out.columns == ["doc_id", "score", "kept"]
    got = {r["doc_id"]: r for r in out.collect()}
    assert got[1]["kept"] and not any(got[i]["kept"] or got[i]["score"] for i in (2, 3, 4))
    assert Q.accepted(df).columns == df.columns and Q.accepted(df).where("doc_id = 1").count() == 2
    assert Q.classify(df.limit(0)).count() == 0


def test_no_votes_give_the_prior():
    share, _, post = Q.fit_votes({})
    assert 0 < share < 1 and post == {}
    assert Q.fit_scorer([])[1] == 0


def plain_posteriors(patterns):
    """Expectation-maximisation document by document."""
    m, n = len(Q.LABELLERS), len(patterns)
    votes = [[p // 3**i % 3 for i in range(m)] for p in patterns]
    weight = [max(1.0, n / 100) * w for w in [1.0] + [1 / m] * m]
    share_prior = [0.8] + [0.2 / m] * m
    prior = [[0.02] * m] + [[0.85 if i == k else 0.25 for i in range(m)] for k in range(m)]
    share, rate = list(share_prior), [list(p) for p in prior]
    for _ in range(60):
        chances = []
        for v in votes:
            c = [share[k] * np.prod([(rate[k][i] if x == Q.BAD else 1 - rate[k][i]) for i, x in enumerate(v) if x != Q.NONE]) for k in range(m + 1)]
            chances.append([x / sum(c) for x in c])
        share = [(sum(c[k] for c in chances) + share_prior[k] * weight[0]) / (n + weight[0]) for k in range(m + 1)]
        for k in range(m + 1):
            for i in range(m):
                objects = sum(c[k] for c, v in zip(chances, votes) if v[i] == Q.BAD)
                cast = sum(c[k] for c, v in zip(chances, votes) if v[i] != Q.NONE)
                r = (objects + prior[k][i] * weight[k]) / (cast + weight[k])
                rate[k][i] = min(0.999, max(r, 0.5 if i == k - 1 else 0.0, 0.001))
                if k == 0:
                    rate[0][i] = min(rate[0][i], 0.3)
    return share[0], [c[0] for c in chances]


def plain_features(text):
    found, shapes, times = Q.seen(text)
    out = {}
    for s, t in zip(shapes, times):
        out[int(s)] = out.get(int(s), 0) + t / found.n
    tenths = [min(10, 10 * v // found.n) for v in (found.plain, found.distinct, found.repeated, found.symbols, found.upper, found.exclamations, found.stops)] + [10 * found.dup_lines // max(found.lines, 1)]
    for i, v in enumerate(tenths):
        k = Q.crc32(b"m%d=%d" % (i, v)) % Q.DIMENSIONS
        out[k] = out.get(k, 0) + 0.5
    return out


def plain_scorer(rows):
    """Logistic regression by dictionaries."""
    w, c, past, past_c = {}, 0.0, {}, 1e-8
    n = {side: max(1, sum((y >= 0.5) == side for _, y in rows)) for side in (True, False)}
    per = {side: 0.5 / n[side] for side in n}
    total = sum(per[y >= 0.5] for _, y in rows)
    for _ in range(300):
        g, g_c = {k: 1e-5 * v for k, v in w.items()}, 0.0
        for x, y in rows:
            err = (1 / (1 + np.exp(-(sum(w.get(k, 0.0) * v for k, v in x.items()) + c))) - y) * per[y >= 0.5] / total
            g_c += err
            for k, v in x.items():
                g[k] = g.get(k, 0.0) + v * err
        for k, v in g.items():
            past[k] = past.get(k, 1e-8) + v * v
            w[k] = w.get(k, 0.0) - 0.5 * v / past[k] ** 0.5
        past_c += g_c * g_c
        c -= 0.5 * g_c / past_c**0.5
    return lambda x: 1 / (1 + np.exp(-(sum(w.get(k, 0.0) * v for k, v in x.items()) + c)))


def test_against_plain(spark):
    found = [t for t, _ in texts(random.Random(5), 150)]
    patterns = [Q.pattern(Q.seen(t)[0]) for t in found]
    share, posterior = plain_posteriors(patterns)
    features = [plain_features(t) for t in found]
    score = plain_scorer(list(zip(features, posterior)))
    odds = share / (1 - share)
    got = {r["doc_id"]: r["score"] for r in Q.classify(spark.createDataFrame(list(enumerate(found)), "doc_id long, text string")).collect()}
    for i, x in enumerate(features):
        p = score(x)
        assert abs(got[i] - p * odds / (p * odds + 1 - p)) < 2e-3


def test_the_rare_side_is_not_starved(spark):
    rng = random.Random(6)
    good = [t for t, ok in texts(rng, 1200) if ok]
    bad = [t for t, ok in texts(rng, 400) if not ok][:12]
    rows = [(i, t) for i, t in enumerate(good + bad)] + [(5, good[5])] * 500
    seen, fit = [], Q.fit_scorer
    Q.fit_scorer = lambda r: seen.append(sorted(y >= 0.5 for *_, y in r)) or fit(r)
    try:
        a, b = (Q.fit(spark.createDataFrame(rows, "doc_id long, text string").repartition(n), train_rows=40) for n in (2, 5))
    finally:
        Q.fit_scorer = fit
    assert seen[0] == seen[1] and seen[0].count(True) == 20 and 10 <= seen[0].count(False) <= 20
    assert np.array_equal(a.weights, b.weights)
