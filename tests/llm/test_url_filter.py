"""URL filter against a brute-force version."""

import re
from collections import Counter, defaultdict

from ledgerline.llm import url_filter as u

SCHEMA = "page_id long, url string, html string, host string, rule string, links int, `odd name` string"


def pages(spark, rows):
    return spark.createDataFrame([(i, url, html, "x", "y", 3, "z") for i, url, html in rows], SCHEMA)


def lower(text):
    return text.translate(str.maketrans(u.UPPER, u.LOWER))


def split(url):
    if "://" not in (url or ""):
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    return lower(host), re.split("[?#]", rest[len(host):], maxsplit=1)[0]


def rule_of(host, path):
    fits = [r for r in u.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name)) if fits else None


def spread(seeds, edges):
    """Scores by plain loops over all edges."""
    total = sum(seeds.values())
    start = {h: u.MASS * n // total for h, n in seeds.items()}
    out = defaultdict(set)
    for a, b in edges:
        out[a].add(b)
    scores = dict(start)
    for _ in range(u.STEPS):
        after = Counter({h: (100 - u.DAMPING) * s // 100 for h, s in start.items()})
        for a, targets in out.items():
            for b in targets:
                after[b] += u.DAMPING * scores.get(a, 0) // (100 * len(targets))
        scores = after
    return scores


def brute(rows):
    parsed = [(i, *split(url), html or "") for i, url, html in rows]
    hosts = {h for _, h, _, _ in parsed if h}
    edges = set()
    for _, host, _, html in parsed:
        if host:
            edges |= {(host, lower(t)) for t in re.findall(u.LINK, html)}
    edges |= {(h, h.split(".", 1)[1]) for h in hosts if "." in h and h.split(".", 1)[1] in hosts}
    edges = {(a, b) for a, b in edges if a != b}
    seeds = {"allow": Counter(), "block": Counter()}
    for _, host, path, _ in parsed:
        rule = rule_of(host, path)
        if rule:
            seeds[rule.verdict][host] += 1
    trust = spread(seeds["allow"], edges)
    distrust = spread(seeds["block"], {(b, a) for a, b in edges})
    out = []
    for i, host, path, _ in parsed:
        rule, t, d = rule_of(host, path), trust.get(host, 0), distrust.get(host, 0)
        graph = "block" if 100 * d > u.BLOCK_PERCENT * (t + d) else "allow"
        out.append((i, host, path, rule and rule.name, rule.verdict if rule else graph, t, d))
    return sorted(out, key=repr)


def got(spark, rows):
    return sorted((tuple(r) for r in u.filter_urls(pages(spark, rows)).collect()), key=repr)


def link(*hosts):
    return "".join(f'<a href="http://{h}/x">x</a>' for h in hosts)


def test_graph_against_brute_force(spark):
    rows = [(1, "http://a.org/fr/1", link("b.com", "c.com")), (2, "http://b.com/1", link("c.com")),
            (3, "https://bad.net/", None), (4, "http://d.com/", link("bad.net", "a.org")), (5, "http://e.com/", link("d.com", "E.com")),
            (6, "http://sub.b.com/", "<img SRC = '//cdn.f.com/i.png'>"), (7, "http://f.com/", link("e.com") * 3),
            (8, "http://cdn.f.com/", ""), (9, "http://x.example.net/en/", ""), (10, "http://x.example.net/de/", link("c.com"))]
    rows += [(100 + i, f"http://h{i}.com/p", link(*(f"h{(i * k + 1) % 30}.com" for k in (2, 3, 7)),
                                                  *(["bad.net"] if i % 7 == 0 else []))) for i in range(30)]
    result = got(spark, rows)
    assert result == brute(rows)
    by_id = {r[0]: r[4] for r in result}
    assert by_id[2] == "allow" and by_id[4] == "block" and by_id[5] == "block" and {r[4] for r in result} == {"allow", "block"}


def test_defined_cases(spark):
    rows = [(1, None, link("b.com")), (2, "no scheme", None), (3, "http://", ""), (None, "HTTP://Www.ORG/fr/", None),
            (4, "http://net", None), (4, "http://net", None), (5, "x://a.net?x://b.org/fr/", None), (6, "http://net/\nq", None),
            (7, "http://example.com/de/" + "y" * 50_000, None), (8, "http://notexample.com/de/", None), (9, "", None)]
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == []
    kept = u.drop_blocked(pages(spark, rows))
    assert kept.columns == pages(spark, rows).columns
    assert Counter(r.page_id for r in kept.collect()) == Counter(r[0] for r in brute(rows) if r[4] == "allow")


def test_hot_host(spark):
    rows = [(i, f"http://hot.com/{i}" if i % 3 == 0 else f"http://h{i % 50}.com/", link("bad.net", f"h{i % 40}.com"))
            for i in range(300)] + [(1000, "http://bad.net/", link("hot.com"))]
    assert got(spark, rows) == brute(rows)
