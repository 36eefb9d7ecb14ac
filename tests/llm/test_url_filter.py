from itertools import product

import pytest

from gleanery.llm import url_filter as U

URLS = [None, "", "no scheme", "http://A.Example.ORG/es/1?x=/en/1#f", "https://example.org", "x://example.org/en/1", "http://m.example.org/en/12/", "http://notexample.org/es/", "http://shop.com/fr/a?b", "http://a.com/de/", "http://com/fr/", "http://a.net#frag", "ftp://h://i/j", "http://a.net?u=http://org/", "http://ÄÖ.Net/Ä"]


def plain(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    tail = rest[cut:]
    end = min([tail.find(c) for c in "?#" if c in tail], default=len(tail))
    path, best = tail[:end], (None, None)
    for verdict, rule in U.RULES:
        name, start = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start) and len(rule) > len(best[0] or ""):
            best = rule, verdict
    return host, path, *best


def test_rules_against_plain(spark):
    pages = [(i, u, f"<p>words shop {i}</p>") for i, u in enumerate(URLS)] + [(None, "http://a.org/", None), (3, URLS[3], "")]
    df = spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, html string, host string")
    out = U.judge(df).collect()
    assert len(out) == len(pages)
    for r in out:
        host, path, rule, verdict = plain(URLS[r["page_id"]] if r["page_id"] is not None else "http://a.org/")
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule) and r["verdict"] in ("allow", "block")
        assert verdict is None or r["verdict"] == verdict
    assert U.judge(df.limit(0)).count() == 0


def test_segmentation_is_the_best_split():
    split = U.Segmenter({"spam": 50, "farm": 40, "far": 5, "spa": 30, "m": 2, "a": 1}, 200)
    assert split("spamfarm") == ["spam", "farm"]

    def cost(parts):
        return sum(split.cost.get(w, split.unknown + 2.5 * (len(w) - 1)) for w in parts)

    for name in ("spafarm", "mspamfarx", "aaam", "farmspa"):
        ways = [[name[i:j] for i, j in zip((0, *c), (*c, len(name)))] for mask in product((0, 1), repeat=len(name) - 1) for c in [[k + 1 for k, x in enumerate(mask) if x]]]
        assert cost(split(name)) == pytest.approx(min(map(cost, ways)))
    assert "".join(split("x" * 5000)) == "x" * 5000


def test_bayes_learns_from_the_rules(spark):
    pages = [(i, f"http://{'casinowin' if i % 2 else 'gardenclub'}{i}.{'com/de/' if i % 2 else 'com/fr/'}x", "<p>casino win garden club</p>") for i in range(40)] + [(100, "http://bigcasinowin.net/x", ""), (101, "http://gardenclubs.net/x", "")]
    got = {r["page_id"]: r for r in U.judge(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert (got[100]["rule"], got[100]["verdict"], got[101]["verdict"]) == (None, "block", "allow")
    assert {"h:casino", "h:win"} <= set(got[100]["tokens"])


def plain_judge(pages):
    """p_block by dictionaries: counts, splits and odds without a table."""
    import re
    from collections import Counter
    from math import exp, log

    words = Counter(w for _, _, html in pages for w in re.findall("[a-z]+", re.sub("<[^>]*>", " ", html or "").lower()) if 2 <= len(w) <= U.LONGEST)
    split = U.Segmenter(dict(words), sum(words.values()))
    cut, counts, judged = [], {"allow": Counter(), "block": Counter()}, Counter()
    for _, url, _ in pages:
        host, path, _, verdict = plain(url)
        tokens = []
        for mark, text in (("h:", host), ("p:", path.lower())):
            for x in re.findall("[a-z]+|[0-9]+|[^\x00-\x7f]+", text):
                tokens += [mark + "0"] if x[0].isdigit() else [mark + w for w in (split(x) if x[0].isascii() else [x])]
        cut.append((tokens, verdict))
        if verdict:
            counts[verdict].update(tokens)
            judged[verdict] += 1
    vocabulary = set(counts["allow"]) | set(counts["block"])
    part = lambda t, v: log((counts[v][t] + 1) / (sum(counts[v].values()) + len(vocabulary) + 1))
    prior = log((judged["block"] + 1) / (judged["allow"] + 1))
    out = []
    for tokens, verdict in cut:
        p = 1 / (1 + exp(-max(-500, min(500, prior + sum(part(t, "block") - part(t, "allow") for t in tokens if t in vocabulary)))))
        out.append((tokens, p, verdict or ("block" if p > 0.5 else "allow")))
    return out


def test_judgement_against_plain(spark, monkeypatch):
    import random

    rng = random.Random(3)
    words = ["casino", "win", "garden", "club", "spam", "farm", "far", "news", "paper"]
    urls = [f"http://{rng.choice(['', 'www.'])}{''.join(rng.choices(words, k=rng.randint(1, 3)))}.{rng.choice(['org', 'com', 'net', 'de'])}/{rng.choice(['de', 'fr', 'x'])}/{rng.choice(words)}{rng.randint(1, 99)}" for _ in range(300)]
    pages = [(i, u, " ".join(rng.choices(words, k=5)) + " thisrunisfarlongerthananywordmaybe") for i, u in enumerate([*urls, *URLS, "http://" + "spamfarm" * 3000 + ".net/ÄÖü/Ä1"])]
    for most in (10_000, 20):  # the second makes fewer runs heavy
        monkeypatch.setattr(U, "HEAVY", most)
        got = {r["page_id"]: r for r in U.judge(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
        for (i, _, _), (tokens, p, verdict) in zip(pages, plain_judge(pages)):
            assert (got[i]["tokens"], got[i]["verdict"]) == (tokens, verdict) and got[i]["p_block"] == pytest.approx(p, abs=1e-6)


def test_no_word_is_dropped_however_many_there_are(spark):
    letters = "bcdfghjklm"
    names = ["q" + "".join(letters[i // 10**k % 10] for k in range(5)) for i in range(50_001)]
    pages = [(i, f"http://{names[i]}{names[i + 7]}.net/", " ".join(names[i::50])) for i in range(50)]
    got = U.judge(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert all(r["tokens"][:2] == ["h:" + names[r["page_id"]], "h:" + names[r["page_id"] + 7]] for r in got)
