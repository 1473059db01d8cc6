import random
import re

from tallyfold.llm import url_filters as U

PAGES = "page_id long, url string, html string"
LABELS = "page_id long, bad boolean"


def judged(spark, rows, labels=(), **options):
    pages = spark.createDataFrame([(i, u, None) for i, u in rows], PAGES).selectExpr("*", "1 as host", "2 as bad", "3 as n")
    got = U.filter_urls(pages, spark.createDataFrame(list(labels), LABELS), **options)
    return {r["page_id"]: r for r in got.collect()}


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    upper = str.maketrans(U.UPPER, U.LOWER)
    return host.translate(upper), re.match(r"[^?#]*", rest[len(host) :])[0]


def rule_of(host, path, rules):
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name), default=None)


def test_parts_and_rules_equal_brute_force(spark):
    urls = [
        None, "", "no scheme", "http://", "http://A.EXAMPLE.org/es/1?x", "https://example.org/en/12#t", "x://example.org",
        "http://org/a", "http://xorg/a", "http://b.com/fr/", "http://b.com/fr", "http://com/de/9", "http://É.net/a b\nc?q://x/",
        "http://h?p=/x", "http://h#/x", "http://example.org/en/2", "a://b://c/d", "http://example.org//es/",
    ]
    rows = judged(spark, list(enumerate(urls)))
    assert len(rows) == len(urls)
    for i, url in enumerate(urls):
        host, path = parts(url)
        assert (rows[i]["host"], rows[i]["path"]) == (host, path)
        rule = rule_of(host, path, U.RULES)
        assert rows[i]["rule"] == (rule.name if rule else None)
        assert rows[i]["verdict"] == (rule.verdict if rule else "allow")


def test_impure_templates_go_and_others_stay(spark):
    rows = [(i, f"http://h.net/spam/{i}.html") for i in range(40)] + [(100 + i, f"http://h.net/good/{i}") for i in range(40)]
    labels = [(i, True) for i in range(0, 40, 2)] + [(100 + i, False) for i in range(30)] + [(3, None), (None, True), (999, True)]
    found = judged(spark, rows, labels)
    assert {r["verdict"] for i, r in found.items() if i < 100} == {"block"}
    assert {r["verdict"] for i, r in found.items() if i >= 100} == {"allow"}
    assert found[0]["template"] == "spam/*"


def test_little_evidence_is_smoothed_away(spark):
    rows = [(i, f"http://h.net/a/{i}") for i in range(3)] + [(10 + i, f"http://g.net/b/{i}") for i in range(50)]
    labels = [(0, True), (1, True)] + [(10 + i, False) for i in range(50)]
    assert {r["verdict"] for r in judged(spark, rows, labels).values()} == {"allow"}


def test_names_that_vary_become_wildcards(spark):
    rows = [(i, f"http://h.net/u/name{chr(97 + i)}/p") for i in range(20)] + [(50, "http://h.net/v/x/p"), (51, "http://h.net/v/y/p")]
    found = judged(spark, rows)
    assert found[0]["template"] == "u/*/p" and found[50]["template"] == "v/x/p"


def test_like_siblings_pool_their_labels(spark):
    # Twenty branches with one bad page each say little alone and enough together.
    rows = [(i, f"http://h.net/s/part{'abcdefghijklmnopqrst'[i // 4]}/{i}") for i in range(80)] + [(100 + i, f"http://g.net/{i}") for i in range(90)]
    labels = [(i, True) for i in range(0, 80, 4)] + [(100 + i, False) for i in range(90)]
    found = judged(spark, rows, labels, min_children=100)
    assert {r["verdict"] for i, r in found.items() if i < 80} == {"allow"}  # parents differ, so no pool
    pooled = [(i, f"http://h.net/s/part{'abcdefghijklmnopqrst'[i // 4]}") for i in range(80)] + rows[80:]
    found = judged(spark, pooled, labels, min_children=100)
    assert {r["verdict"] for i, r in found.items() if i < 80} == {"block"}


def test_like_subtrees_pool_their_labels(spark):
    # Four languages with 3 bad of 3 pages each say little alone and enough together.
    rows = [(10 * k + i, f"http://h.net/{lang}/{i}") for k, lang in enumerate(("en", "de", "fr", "es")) for i in range(3)]
    rows += [(100 + i, f"http://g.net/{i}") for i in range(68)]
    labels = [(i, i < 100) for i, _ in rows]
    found = judged(spark, rows, labels, depth=None, inner=True)
    assert {i for i, r in found.items() if r["verdict"] == "block"} == {i for i, _ in rows if i < 100}
    assert found[0]["template"] == "en/*"


def plain_branches(leaves, z_squared=4):
    """Templates (tuples) of one host with n and b, to the counts of the branch each falls in."""
    branch = {t: t for t in leaves}
    for level in reversed(range(max(map(len, leaves)))):
        trees = {}
        for t, own in branch.items():
            if len(own) > level:
                n, b = trees.setdefault(own[:level], {}).get(own[level], (0, 0))
                trees[own[:level]][own[level]] = n + leaves[t][0], b + leaves[t][1]
        for t, own in branch.items():
            if len(own) > level:
                around = trees[own[:level]].values()
                big_n, big_b, (n, b) = sum(x for x, _ in around), sum(x for _, x in around), trees[own[:level]][own[level]]
                if (b * big_n - big_b * n) ** 2 <= z_squared * big_b * (big_n - big_b) * n:
                    branch[t] = (*own[:level], None, *own[level + 1 :])
    return {t: tuple(sum(leaves[o][k] for o in leaves if branch[o] == branch[t]) for k in (0, 1)) for t in leaves}


def test_subtrees_equal_brute_force(spark):
    rng = random.Random(5)
    hosts = {}
    for h in range(12):
        for _ in range(15):
            t = tuple(rng.choice("abc*") for _ in range(rng.randint(0, 9)))
            n = rng.choice([0, 1, 3, 20])
            hosts.setdefault(f"h{h}", {})[t] = (n, rng.choice([0, n, rng.randint(0, n)]))
    rows = [(h, list(t), n, b) for h, leaves in hosts.items() for t, (n, b) in leaves.items()]
    frame = spark.createDataFrame(rows, "host string, template array<string>, n long, b long")
    got = {(r["host"], r["template"]): (r["n"], r["b"]) for r in U.pool_subtrees(frame, 4).collect()}
    assert got == {(h, "/".join(t)): x for h, leaves in hosts.items() for t, x in plain_branches(leaves).items()}


def test_whole_paths(spark):
    deep = "http://h.net/" + "/".join("abcdefghij")
    assert judged(spark, [(1, deep)], depth=None, inner=True)[1]["template"] == "a/b/c/d/e/f/g/h/i/j"
    rows = [(i, f"http://h.net/a/b/c/d/e/f/g/{x}/p") for i, x in enumerate("abcdefghijkl")]
    assert judged(spark, rows, depth=None, inner=True)[0]["template"] == "a/b/c/d/e/f/g/*/p"
    assert judged(spark, [], depth=None, inner=True) == {}


def test_repeats_deep_paths_and_no_rows(spark):
    deep = "http://h.net/" + "/".join("abcdefghij") + "/" + "k" * 50_000
    found = judged(spark, [(1, deep), (1, deep), (None, deep)])
    assert found[1]["template"] == "a/b/c/d/e/f/**"
    assert judged(spark, []) == {}
