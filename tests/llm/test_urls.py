import math
import re
import zlib
from collections import Counter

import numpy as np

from ratingflow.llm import queries, urls
from tests.llm.helpers import SF

RULES = queries.URL_RULES


def reference(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest, maxsplit=1)[0]
        path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0]))
            and path.startswith(r[r.index("/"):])]
    return host, path, max(fits, key=len, default=None)


def test_query_equals_brute_force(spark):
    url = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()}
    rows = queries.op2_urls(spark, SF).collect()
    assert sorted(r.page_id for r in rows) == sorted(url)
    ruled = [(u or "", int(RULES[rule] == "allow")) for u in url.values() if (rule := reference(u)[2])]
    held = lambda u: zlib.crc32(u.encode()) % urls.CALIBRATION_FOLDS == 0
    learned = {s: slow_counts(u for u, own in ruled if own == s and not held(u)) for s in (0, 1)}
    histogram = Counter((math.floor(slow_score(None, u, learned) / urls._BIN), own) for u, own in ruled if held(u))
    threshold = urls.best_threshold([(b, own, n) for (b, own), n in histogram.items()])
    every = {s: slow_counts(u for u, own in ruled if own == s) for s in (0, 1)}
    for r in rows:
        assert (r.host, r.path, r.rule) == reference(url[r.page_id])
        if r.rule:
            assert r.verdict == RULES[r.rule]
            continue
        score = slow_score(None, url[r.page_id] or "", every)
        assert abs(score - r.score) < 1e-6
        assert abs(score - threshold) < 1e-6 or r.verdict == ("allow" if score >= threshold else "block")


def slow_counts(texts):
    seen, after = {}, {}
    for t in texts:
        t = "\2" * urls.ORDER + t.lower() + "\3"
        for i in range(urls.ORDER, len(t)):
            for k in range(urls.ORDER + 1):
                c = t[i - k:i]
                seen[c] = seen.get(c, 0) + 1
                after.setdefault(c, {}).setdefault(t[i], 0)
                after[c][t[i]] += 1
    return seen, after


def slow_score(texts_by_side, text, counts=None):
    """Witten-Bell blended contexts, counted in dictionaries."""
    counts = counts or {s: slow_counts(ts) for s, ts in texts_by_side.items()}
    out = 0.0
    padded = "\2" * urls.ORDER + text.lower() + "\3"
    for side, sign in ((1, 1), (0, -1)):
        seen, after = counts[side]
        for i in range(urls.ORDER, len(padded)):
            p = 1 / 256
            for k in range(urls.ORDER + 1):
                c = padded[i - k:i]
                if seen.get(c, 0) < (urls.LEAST if k else 1):
                    break
                p = (after[c].get(padded[i], 0) + len(after[c]) * p) / (seen[c] + len(after[c]))
            out += sign * np.log(p)
    return out / (len(text) + 1)


def test_scores_equal_plain_counting(spark):
    sides = {1: ["http://a.org/fr/12", "http://b.org/fr/3", "http://c.org/fr/444"],
             0: ["https://x.example.net/de/9", "https://y.example.net/es/1"]}
    rows = spark.createDataFrame([(t, s) for s, ts in sides.items() for t in ts], "text string, side int")
    model = urls.Model(urls.counts_of(urls.pair_counts(rows)), 0.0)
    some = ["http://a.org/fr/13", "https://z.example.net/de/1", "", "É?"]
    assert np.allclose(model.scores(some), [slow_score(sides, t) for t in some], atol=1e-4)


def test_no_context_lends_its_counts_to_another(spark):
    few = [("http://a.org/fr/12", 1), ("http://b.org/fr/3", 1), ("http://x.net/de/9", 0)] * 3
    many = few + [(f"{i * 7919 % 10 ** 6:06d}", 1) for i in range(0, 10 ** 6, 50)]
    rows = spark.createDataFrame(many, "text string, side int")
    model = urls.Model(urls.counts_of(urls.pair_counts(rows)), 0.0)
    blocked, allowed = ([t for t, own in many if own == s] for s in (0, 1))
    some = ["http://c.org/fr/12", "http://q.net/de/9", "000004", "qwerty", "987123"]
    want = [slow_score({0: blocked, 1: allowed}, t) for t in some]
    assert np.allclose(model.scores(some), want, atol=1e-6)
    found = urls.score(spark.createDataFrame(list(enumerate(some)), "i int, text string"), model, ["i"])
    assert np.allclose([r.score for r in sorted(found.collect())], want, atol=1e-6)


def test_threshold_parts_the_sides():
    assert 10 * urls._BIN <= urls.best_threshold([(-5, 0, 3), (9, 0, 1), (30, 1, 4)]) <= 30 * urls._BIN
    assert urls.best_threshold([(0, 0, 1), (1, 1, 1)]) == urls._BIN


def test_awkward_rows(spark):
    some = [(1, None), (2, ""), (3, "no scheme"), (4, "http://A.NET"), (5, "http://a.net/"), (6, "ftp://X.example.net/en/?q#f"),
            (7, "http://example.com/de/x://y"), (8, "http://notexample.com/de/"), (9, "http://org?/fr/"),
            (10, "http://a.org/fr/" + "x" * 50_000), (None, "http://b.org/fr/"), (11, "http://É.org/fr/é\n#"),
            (12, "http://u"), (12, "http://u")]
    some += [(100 + i, f"http://h{i}.org/fr/{i}") for i in range(20)] + [(200 + i, f"http://h{i}.net/{i}") for i in range(20)]
    pages = spark.createDataFrame([(i, u, "html", "t", 1) for i, u in some],
                                  "page_id long, url string, html string, text string, side int")
    rows = urls.judge(pages, RULES).collect()
    assert len(rows) == len(some)
    want = sorted((i is None, i or 0, *map(str, reference(u))) for i, u in some)
    assert sorted((r.page_id is None, r.page_id or 0, r.host, r.path, str(r.rule)) for r in rows) == want
    assert all(r.verdict in ("allow", "block") for r in rows)
    none = urls.judge(pages.where("page_id < 4"), RULES).collect()
    assert {r.verdict for r in none} == {"allow"}
    assert urls.judge(pages.where("page_id < 0"), RULES).collect() == []
