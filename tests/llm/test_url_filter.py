"""URL rules against a plain version, and judged templates."""

import collections
import math
import random
import time

import pytest

from medalith.llm import url_filter


def plain_parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    at = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:at])
    path = rest[at:]
    return host, path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]


def plain_rule(host, path):
    best = None
    for rule, verdict in url_filter.RULES:
        name, _, start = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start) and (best is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    return best


def run(spark, rows, **how):
    schema = "page_id long, url string" + (", label int" if how else "")
    return url_filter.judge(spark, spark.createDataFrame(rows, schema), **how).collect()


EDGES = [
    None, "", "no address", "x://", "://a.net", "http://NET/", "http://net", "http://net?x", "http://A.Example.NET/en/1#t", "http://example.net/en",
    "http://xexample.com/de/", "http://a.example.com/de/x?y=/en/", "http://example.org/fr/", "http://b.org/FR/1", "http://É.org/fr/é", "HTTP://u:p@h.com:80/a b/%20",
    "http://a.com//b///c/1/2/3/4/5/6/7/8/9", "http://a.com/\n/x", "http://a.com/a://b.net/",
]


def test_rules_and_parts(spark):
    rows = [(i, u) for i, u in enumerate(EDGES)] + [(100, EDGES[8]), (100, EDGES[8]), (None, EDGES[5])]
    found = run(spark, rows)
    assert len(found) == len(rows)
    urls = dict(rows[: len(EDGES)]) | {100: EDGES[8], None: EDGES[5]}
    for row in found:
        host, path = plain_parts(urls[row.page_id])
        rule = plain_rule(host, path)
        assert (row.host, row.path, row.rule) == (host, path, rule[0] if rule else None)
        assert row.verdict == (rule[1] if rule else "allow")


def test_bad_branches_are_rejected_and_alike_ones_merged(spark):
    pick = random.Random(2)
    rows = []
    for i in range(600):
        rows.append((i, f"http://shop.com/offers/{pick.randrange(10**6)}.html", 1))
        rows.append((1000 + i, f"http://shop.com/articles/{pick.choice('abc')}{pick.randrange(10**6)}/{pick.randrange(99)}", 0))
        rows.append((2000 + i, f"http://shop.com/pages/{''.join(pick.choices('xyz', k=9))}", 0))
    rows += [(5000, "http://shop.com/offers/7.html", None), (5001, "http://shop.com/articles/q1/2", None), (5002, "http://new.com/offers/1.html", None)]
    found = {r.page_id: r for r in run(spark, rows, label_col="label")}
    assert (found[5000].verdict, found[5001].verdict, found[5002].verdict) == ("block", "allow", "allow")
    assert found[5000].template == "/offers/{n}.html"
    assert found[2000].template.split("/")[2] == "*"
    assert found[1000].template.split("/")[1] == found[2000].template.split("/")[1] == "*-"


def test_named_hosts_are_rejected(spark):
    rows = [(i, f"https://www.cheap-pills.example.com/en/{i}") for i in range(30)] + [(100 + i, f"https://good.example.com/en/{i}") for i in range(30)]
    rows += [(200, "https://pillstone.example.com/en/1")]
    verdicts = {r.page_id: r.verdict for r in run(spark, rows)}
    assert {verdicts[i] for i in range(30)} == {"block"}
    assert {verdicts[i] for i in (*range(100, 130), 200)} == {"allow"}


def test_empty_table_and_other_columns(spark):
    assert run(spark, []) == []
    schema = "page_id long, url string, host string, path string, n int, child string, template string, names string, id string"
    pages = spark.createDataFrame([(1, "http://a.com/x", "h", "p", 1, "c", "t", "n", "i")], schema)
    row = url_filter.judge(spark, pages).first()
    assert (row.page_id, row.host, row.path, row.verdict) == (1, "a.com", "/x", "allow")


def test_weak_labels_tell_branches_of_a_host_apart(spark):
    good, bad = "<p>News of the town, nothing else.</p>", "<p>Casino, casino! The best <b>poker</b>.</p>"
    rows = [(k, f"http://mixed.com/news/{k}.html", good) for k in range(40)] + [(100 + k, f"http://mixed.com/x/{k}.html", bad) for k in range(40)]
    rows += [(200 + k, f"http://paths.com/{'casino' if k % 2 else 'town'}/{k}", good) for k in range(60)]
    rows += [(300, "http://cheap-pills.com/1", good), (301, "http://other.com/1", "<p class='ads spam casino'>One word of spam.</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    blocked = {r.page_id for r in url_filter.judge(spark, pages).where("verdict = 'block'").collect()}
    assert blocked == {*range(100, 140), *(200 + k for k in range(60) if k % 2), 300}


def test_paths_grow_to_their_last_name(spark):
    start = "http://deep.com/a/b/c/d/e/f/g/h"
    rows = [(k, f"{start}/{'good' if k % 2 else 'bad'}/{k}", 1 - k % 2) for k in range(40)] + [(100, "http://deep.com/q" + "/r" * 300, 0)]
    found = {r.page_id: r for r in run(spark, rows, label_col="label")}
    assert (found[0].verdict, found[1].verdict) == ("block", "allow")
    assert found[0].template.endswith("/bad/{n}") and found[100].template.count("/") == 301


def test_long_paths_in_common_take_few_rounds(spark):
    """Paths of hundreds of names, which end on the way of a longer one or leave it, grow as one level at a time would do it."""
    trap = [("trap.org", "/a/b" * k) for k in range(1, 151)]
    long = "/".join(f"x{chr(97 + k % 26)}" for k in range(300))
    twins = [("twin.org", f"/{long}/{end}") for end in ("one", "two", "two/three")]
    forks = [("fork.org", p) for p in ("/p", "/p/q", "/p/q/r/s", "/p/q/r/s/t", "/p/q/z", "/p/q-x/y")]
    made = [(h, p, k % 2) for k, (h, p) in enumerate(trap + twins + forks)]
    urls = spark.createDataFrame(made, "host string, path string, label int")
    begin = time.monotonic()
    found = {(r.host, r.path): r.template for r in url_filter.path_templates(spark, urls).collect()}
    assert time.monotonic() - begin < 120
    for host, path in trap:
        assert found[host, path] == path
    merged = _level_by_level(made)
    assert found == merged


def _level_by_level(made):
    """Templates of the tree in plain Python, one name a round."""
    rows = [(h, p, [s for s in p.split("/") if s], "", y) for h, p, y in made]
    done = {}
    while rows:
        nodes = collections.defaultdict(lambda: collections.defaultdict(list))
        for h, p, names, template, y in rows:
            if names:
                nodes[h, template][names[0]].append((h, p, names, template, y))
            else:
                done[h, p] = template
        rows = []
        for children in nodes.values():
            sides = _sides(children)
            size = sum(map(len, children.values()))
            for child, own in children.items():
                group = {c: r for c, r in children.items() if sides[c] == sides[child]}
                if len(group) > 1 and _sides(group)[child] == 0:
                    name = {1: "*+", -1: "*-", 0: "*"}[sides[child]]
                elif len(children) > url_filter.MANY_CHILDREN and len(own) < url_filter.RARE_SHARE * size:
                    name = "*"
                else:
                    name = child
                rows += [(h, p, names[1:], f"{template}/{name}", y) for h, p, names, template, y in own]
    return done


def _sides(children):
    n, bad = sum(map(len, children.values())), sum(r[4] for rows in children.values() for r in rows)
    sides = {}
    for child, rows in children.items():
        own, own_bad = len(rows), sum(r[4] for r in rows)
        sides[child] = 0
        if n > own:
            spread = math.sqrt(bad / n * (1 - bad / n) * (1 / own + 1 / (n - own)))
            apart = own_bad / own - (bad - own_bad) / (n - own)
            if spread > 0 and abs(apart) > url_filter.DIFFERENT_Z * spread:
                sides[child] = 1 if apart > 0 else -1
    return sides


@pytest.mark.parametrize("seed", range(3))
def test_templates_against_a_plain_tree(spark, seed):
    pick = random.Random(seed)
    made = {}
    for _ in range(400):
        path = "".join(f"/{pick.choice('abcdefghijklmnopqrstuvw' if pick.random() < 0.2 else 'ab')}" for _ in range(pick.randint(0, 7)))
        made[f"{pick.choice('xyz')}.org", path] = int(pick.random() < (0.8 if "/b/a" in path else 0.2))
    rows = [(h, p, y) for (h, p), y in made.items()]
    urls = spark.createDataFrame(rows, "host string, path string, label int")
    assert {(r.host, r.path): r.template for r in url_filter.path_templates(spark, urls).collect()} == _level_by_level(rows)
