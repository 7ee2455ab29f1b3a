import re

import numpy as np
import pytest

from cohortloom.llm.queries import URL_RULES
from cohortloom.llm.url_filter import judge_urls, propagate


def parts(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")


def rule_of(host, path):
    fits = []
    for verdict, rule in URL_RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((len(h) + len(p), rule, verdict))
    return max(fits)[1:] if fits else (None, None)


def pages_of(spark, rows):
    return spark.createDataFrame([(i, u, h, "x") for i, u, h in rows], "page_id long, url string, html string, host string")


def test_rules_and_parts(spark, work):
    urls = [None, "", "no host", "http://", "HTTP://A.Example.NET/en/1?x#y", "http://example.net", "http://example.net/", "ftp://b.net/en/",
            "http://x.example.com/de/?q", "http://x.example.com/DE/", "http://notexample.com/de/1", "http://a.org/fr/", "http://a.org/frx",
            "http://a.org?fr", "http://q://z.net/", "x://y.org/fr/\nz"]
    found = judge_urls(work, pages_of(spark, [(i, u, None) for i, u in enumerate(urls)]), URL_RULES).collect()
    assert len(found) == len(urls)
    for r in found:
        host, path = parts(urls[r["page_id"]])
        rule, verdict = rule_of(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or r["verdict"]) and r["verdict"] in ("allow", "block")


def test_given_pages_follow_their_rules(spark, work):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    urls = {r["page_id"]: r["url"] for r in pages.collect()}
    # These pages link within their hosts only, so scores are those of the seeds.
    shares = {}
    for url in urls.values():
        host, path = parts(url)
        shares.setdefault(host, []).append(rule_of(host, path)[1])
    mass = {v: {h: s.count(v) / len(s) for h, s in shares.items() if h} for v in ("allow", "block")}
    total = {v: sum(m.values()) for v, m in mass.items()}
    found = judge_urls(work, pages, URL_RULES).collect()
    assert len(found) == len(urls)
    for r in found:
        host, path = parts(urls[r["page_id"]])
        rule, verdict = rule_of(host, path)
        trust, distrust = (mass[v].get(host, 0) / total[v] for v in ("allow", "block"))
        bad = distrust > trust and distrust >= 0.25 / len(mass["block"])
        assert r["rule"] == rule and r["verdict"] == (verdict or ("block" if bad else "allow"))


def test_distrust_goes_against_links(spark, work):
    link = lambda h: f'<a href="http://{h}/">x</a> <a href="/own">y</a>'
    rows = [(1, "http://good.org/fr/1", link("liked.info")), (2, "http://bad.net/1", link("bad2.info")), (3, "http://liked.info/1", None),
            (4, "http://farm.info/1", link("bad.net") + link("bad.net")), (5, "http://alone.info/1", "<p>")]
    found = {r["page_id"]: r["verdict"] for r in judge_urls(work, pages_of(spark, rows), URL_RULES).collect()}
    assert found == {1: "allow", 2: "block", 3: "allow", 4: "block", 5: "allow"}


def test_scores_are_those_of_a_dense_iteration(spark, work):
    rng = np.random.default_rng(3)
    edges = sorted({(int(a), int(b)) for a, b in rng.integers(0, 30, (120, 2)) if a != b and a < 25})
    weight = np.zeros((30, 30))
    for n, (a, b) in enumerate(edges):
        weight[a, b] = 1 + n % 3
    seeds = np.zeros(30)
    seeds[[2, 9]] = 0.5
    score = seeds.copy()
    for _ in range(12):
        out = weight.sum(1)
        flow = 0.85 * ((score / np.where(out, out, 1)) @ weight)
        score = flow + (1 - flow.sum()) * seeds
    frame = spark.createDataFrame([(str(a), str(b), int(weight[a, b])) for a, b in edges], "src string, dst string, links long")
    start = spark.createDataFrame([("2", 0.5), ("9", 0.5)], "host string, mass double")
    found = {int(r["host"]): r["score"] for r in propagate(work, frame, start, rounds=12, tolerance=0).collect()}
    assert found == {h: pytest.approx(score[h], abs=1e-9) for h in found}
    assert sum(found.values()) == pytest.approx(1.0)


def test_distrust_reaches_hosts_beyond_twenty_links(spark, work):
    """A chain of 24 links to a blocked host, among 1,500 hosts without links."""
    far = 24
    rows = [(0, "http://h0.net/1", None)]
    rows += [(k, f"http://h{k}.info/1", f'<a href="http://h{k - 1}.{"net" if k == 1 else "info"}/">x</a>') for k in range(1, far + 1)]
    rows += [(k, f"http://alone{k}.info/1", None) for k in range(100, 1600)]
    scores = 0.15 * 0.85 ** np.arange(far + 1)
    scores /= 1 - 0.85 ** (far + 1)  # the end of the chain gives back to the seed what it holds
    assert scores[far] > 1.5 * 0.25 / len(rows)
    found = {r["page_id"]: r["verdict"] for r in judge_urls(work, pages_of(spark, rows), URL_RULES).collect()}
    assert found == {k: "block" if k <= far else "allow" for k in found}


def test_converged_scores_are_those_of_the_linear_system(spark, work):
    """A ring with a way out, so that rounds are many and some mass returns to the seed."""
    edges = [(k, (k + 1) % 5) for k in range(5)] + [(3, 5)]
    frame = spark.createDataFrame([(str(a), str(b), 1) for a, b in edges], "src string, dst string, links long")
    start = spark.createDataFrame([("0", 1.0)], "host string, mass double")
    flow = np.zeros((6, 6))
    for a, b in edges:
        flow[b, a] = 1 / sum(x == a for x, _ in edges)
    score = np.linalg.solve(np.eye(6) - 0.85 * flow, np.eye(6)[0])
    score /= score.sum()
    found = {int(r["host"]): r["score"] for r in propagate(work, frame, start, tolerance=1e-4).collect()}
    assert found == {h: pytest.approx(score[h], abs=1e-4) for h in range(6)}
    with pytest.raises(RuntimeError, match="after 3 rounds"):
        propagate(work, frame, start, rounds=3, tolerance=1e-4)


def test_no_pages(spark, work):
    assert judge_urls(work, pages_of(spark, []), URL_RULES).count() == 0
