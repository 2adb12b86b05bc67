import math
from collections import Counter, defaultdict

import pytest

from ledgerfold.llm.url_filter import RULES, judge

SCHEMA = "page_id long, url string, host string, said string, score int"
URLS = ["https://Shop.Example.COM/en/x?q=1", "http://example.com/en/", "https://www.example.com/en/a#b", "http://deep.www.example.com/en/", "http://b.net/es/1", "http://net/fr/2", "http://b.net/de/3",
        "http://sub.other.com", "http://sub.other.com/", "ftp://COM/a://b", "no scheme", "", None, "://", "http://notexample.com/en/q", "http://x.org/en/1", "http://x.org/es/1?net/es/", "http://ünï.org/fr/\U0001f600", "http://x.org/en/1"]
URLS += [f"http://good{i}.com/news/{i}" for i in range(12)] + [f"http://bad{i}.net/es/spam-{i}" for i in range(12)] + ["http://a.org/news/7", "http://a.org/es/spam-3"]


def cut(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = rest
    for c in "/?#":
        host = host.split(c, 1)[0]
    path = rest[len(host):].split("?", 1)[0].split("#", 1)[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def ruled(host, path):
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text), default=None)


def brute(urls, order=4):
    """Mean scores in thousandths and the threshold, from plain counts."""
    told = [(*cut(u), ruled(*cut(u))) for u in urls]
    grams = lambda s: [("\x02" * order + s + "\x03")[i : i + order + 1] for i in range(len(s) + 1)]
    alphabet = {g[-1] for h, p, _ in told for g in grams(h + p)}
    counts = {True: Counter(), False: Counter()}
    for h, p, r in told:
        if r is not None:
            for g in grams(h + p):
                counts[r.allow].update(g[-k:] for k in range(1, order + 2))
    followers = {side: defaultdict(set) for side in counts}
    totals = {side: Counter() for side in counts}
    for side, seen in counts.items():
        for tail, n in seen.items():
            followers[side][tail[:-1]].add(tail[-1])
            totals[side][tail[:-1]] += n

    def chance(side, gram):
        p = 1.0 / len(alphabet)
        for k in range(1, order + 2):
            context, t = gram[-k:-1], len(followers[side][gram[-k:-1]])
            if totals[side][context]:
                p = (counts[side][gram[-k:]] + t * p) / (totals[side][context] + t)
        return p

    mean = {}
    for h, p, _ in told:
        all_ = grams(h + p)
        mean[h + p] = math.floor(sum(round((math.log(chance(True, g)) - math.log(chance(False, g))) * 1_000_000) for g in all_) / (len(all_) * 1000))
    steps = sorted({mean[h + p] for h, p, r in told if r is not None})
    allowed = [mean[h + p] for h, p, r in told if r is not None and r.allow]
    blocked = [mean[h + p] for h, p, r in told if r is not None and not r.allow]
    rate = {s: sum(b < s for b in blocked) / len(blocked) + sum(a >= s for a in allowed) / len(allowed) for s in steps}
    best = max(steps, key=lambda s: (rate[s], -s))
    before = steps[max(0, steps.index(best) - 1)]
    return told, mean, (before + best) // 2


def test_rules_and_model_against_brute_force(spark):
    rows = spark.createDataFrame([(i, u, "x", "y", 0) for i, u in enumerate(URLS)], SCHEMA)
    got = {r.page_id: r for r in judge(rows).collect()}
    told, mean, least = brute(URLS)
    assert len(got) == len(URLS)
    for i, (h, p, r) in enumerate(told):
        allow = r.allow if r is not None else mean[h + p] >= least
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (h, p, r and r.text, "allow" if allow else "block")
        assert got[i].score == (None if r is not None else mean[h + p])
    assert got[len(URLS) - 2].verdict == "allow" and got[len(URLS) - 1].verdict == "block"


@pytest.mark.parametrize("urls", [[], ["http://x.org/", None], ["http://x.com/", "http://x.org/"]])
def test_nothing_to_learn_from(spark, urls):
    got = judge(spark.createDataFrame([(i, u, "", "", 0) for i, u in enumerate(urls)], SCHEMA)).collect()
    assert len(got) == len(urls) and all(r.verdict == "allow" for r in got)
