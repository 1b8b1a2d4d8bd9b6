import math
import re

import pytest

from tillbook.llm.url_templates import RULES, UrlRule, filter_urls, path_templates
from tillbook.llm.queries import op4_url_templates

SF = "/root/testdata/sf0.01"


def slow_parse(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest)[0]
    path = re.split(r"[?#]", rest[len(host):])[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def slow_rule(host, path, rules):
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fit, key=lambda r: len(r.name)) if fit else None


def slow_templates(kinds, most, alike):
    """kinds: {(host, path): [n, labelled, bad]}; the template of each, node by node."""
    out = {}

    def apart(x, n, y, m):
        share = (x + y) / (n + m)
        return x * m != y * n and abs(x / n - y / m) >= alike * math.sqrt(share * (1 - share) * (1 / n + 1 / m))

    def merge(stats):
        """stats: {token: [n, labelled, bad]}; lists of tokens."""
        groups, sums, plain = [], [], [t for t in stats if not stats[t][1]]
        for t in sorted((t for t in stats if stats[t][1]), key=lambda t: (stats[t][2] / stats[t][1], t)):
            if groups and not apart(sums[-1][2], sums[-1][1], stats[t][2], stats[t][1]):
                groups[-1].append(t)
                sums[-1] = [a + b for a, b in zip(sums[-1], stats[t])]
            else:
                groups.append([t])
                sums.append(stats[t])
        return groups + ([plain] if plain else [])

    def descend(host, prefix, members, level):
        """members: [(path, segments, counts)]"""
        for path, segments, _ in members:
            if len(segments) <= level:
                out[host, path] = prefix
        here = [m for m in members if len(m[1]) > level]
        total, by_segment = sum(m[2][0] for m in here), {}
        for m in here:
            by_segment.setdefault(m[1][level], []).append(m)
        by_token = {}
        for segment, ms in by_segment.items():
            rare = len(by_segment) > most and sum(m[2][0] for m in ms) * most < total
            by_token.setdefault("*" if rare else segment, []).extend(ms)
        stats = {t: [sum(m[2][k] for m in ms) for k in range(3)] for t, ms in by_token.items()}
        for g in merge(stats):
            descend(host, prefix + "/" + "|".join(sorted(g)), [m for t in g for m in by_token[t]], level + 1)

    for host in {h for h, _ in kinds}:
        descend(host, "", [(path, re.sub("^/", "", path).split("/"), counts) for (h, path), counts in kinds.items() if h == host], 0)
    return out


def slow_filter(urls, rules=RULES, most=16, alike=1.96, reject=0.9):
    kinds, parsed = {}, [(k, *slow_parse(u)) for k, u in urls]
    for _, host, path in parsed:
        r = slow_rule(host, path, rules)
        counts = kinds.setdefault((host, path), [0, 0, 0])
        counts[0] += 1
        counts[1] += r is not None
        counts[2] += r is not None and r.verdict == "block"
    templates = slow_templates(kinds, most, alike)
    sums = {}
    for (host, path), counts in kinds.items():
        s = sums.setdefault((host, templates[host, path]), [0, 0])
        s[0] += counts[1]
        s[1] += counts[2]
    out = []
    for k, host, path in parsed:
        r, t = slow_rule(host, path, rules), templates[host, path]
        labelled, bad = sums[host, t]
        verdict = r.verdict if r else "block" if (bad + 1) / (labelled + 2) >= reject else "allow"
        out.append((k, host, path, r.name if r else None, verdict, t))
    return sorted(out, key=repr)


def test_query_matches_brute_force(spark):
    urls = [(r["page_id"], r["url"]) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    assert sorted(map(tuple, op4_url_templates(spark, SF).collect()), key=repr) == slow_filter(urls)


def hard_urls():
    urls = ["http://a.Example.COM/de/x", "https://net/y", "https://x.net", "https://x.net?q=/", "https://x.net#f", "https://x.net/",
            "https://xnet/", "ftp://a.org/fr/1#2", "https://a.org/fr", "https://notexample.net/en/1", "https://b.example.net/en/9?x#y",
            "nothing", "", None, "://", "x://://a/b", "HTTP://É.example.com/DE/1", "https://h.com//a//", "https://h.com/" + "s/" * 300,
            "https://h.com/a\nb/c", "https://net/%2f/ü"]
    urls += [f"https://big.com/item/{i}/view" for i in range(60)] + ["https://big.com/item/top/view"] * 30
    urls += [f"https://bad.com/promo/{i}/x" for i in range(20)] + [f"https://bad.com/news/{i}/x" for i in range(20)]
    return [*((i, u) for i, u in enumerate(urls)), (None, "https://h.com/z"), (3, "https://x.net?q=/"), (3, "https://x.net?q=/")]


@pytest.mark.parametrize("most", [16, 3])
def test_hard_urls(table, most):
    rules = (*RULES, UrlRule("bad.com", "/promo/1", "block"), UrlRule("bad.com", "/news/1", "allow"))
    rows = hard_urls()
    frame = table([(k, u, "x", 1, "t") for k, u in rows], "page_id long, url string, host string, n long, template string")
    got = sorted(map(tuple, filter_urls(frame, rules=rules, most=most).collect()), key=repr)
    assert got == slow_filter(rows, rules, most=most)
    assert filter_urls(frame.where("false")).collect() == []


def test_a_labelled_template_judges_its_unlabelled_urls(table):
    rules = tuple(UrlRule("s.com", f"/go/{i}", "block") for i in range(1, 10))
    rows = [(i, f"https://s.com/go/{i}") for i in range(100, 200)] + [(i, f"https://s.com/read/{i}") for i in range(200, 260)]
    rows += [(300, "https://s.com/go/"), (301, "https://s.com/go/zz")]
    verdicts = {r["page_id"]: r["verdict"] for r in filter_urls(table(rows, "page_id long, url string"), rules=rules).collect()}
    assert verdicts[301] == "block" and all(verdicts[i] == "allow" for i in range(200, 260))
    many = table([("h", f"/a/{i}", 1, 0, 0) for i in range(40)], "host string, path string, n long, labelled long, bad long")
    assert {r["template"] for r in path_templates(many).collect()} == {"/a/*"}


def test_deep_segments_are_generalised_one_by_one(table):
    rules = tuple(UrlRule("d.com", f"/a/b/c/d/e/{i}/spam/", "block") for i in range(100, 140)) + tuple(
        UrlRule("d.com", f"/a/b/c/d/e/{i}/ok/", "allow") for i in range(100, 140))
    urls = [f"https://d.com/a/b/c/d/e/{i}/{kind}/{i * 7}" for i in range(100, 180) for kind in ("spam", "ok")]
    urls += [f"https://d.com/{'x/' * 40}{i}" for i in range(3)] + ["https://d.com/a/b/c/d/e", "https://d.com/a/b/c"]
    rows = list(enumerate(urls))
    found = filter_urls(table(rows, "page_id long, url string"), rules=rules).collect()
    assert sorted(map(tuple, found), key=repr) == slow_filter(rows, rules)
    verdict = {r["path"]: (r["rule"], r["verdict"], r["template"]) for r in found}
    assert verdict["/a/b/c/d/e/150/spam/1050"] == (None, "block", "/a/b/c/d/e/*/spam/*")
    assert verdict["/a/b/c/d/e/150/ok/1050"] == (None, "allow", "/a/b/c/d/e/*/ok/*")


def test_branches_are_compared_with_what_is_merged_not_with_their_neighbour(table):
    # bad shares rise by small steps: no neighbours differ, but the last differs from all before it together
    bad = [0, 4, 9, 15, 22, 30, 38, 46, 54, 60]
    kinds = [("h", f"/{chr(97 + i)}/{j}", 1, 1, int(j < b)) for i, b in enumerate(bad) for j in range(60)]
    kinds += [("h", f"/new{i}/1", 1, 0, 0) for i in range(3)]
    rows = path_templates(table(kinds, "host string, path string, n long, labelled long, bad long")).collect()
    want = slow_templates({(h, p): [n, lab, b] for h, p, n, lab, b in kinds}, 16, 1.96)
    assert {(r["host"], r["path"]): r["template"] for r in rows} == want
    first = {r["template"].split("/")[1] for r in rows}
    assert "new0|new1|new2" in first and 2 < len(first) < 11 and not any("a" in t and "j" in t for t in first)


def test_no_unruled_url_of_the_given_pages_shares_its_first_segment_with_a_ruled_one(spark):
    rows = op4_url_templates(spark, SF).selectExpr("host", "split(path, '/')[1] AS first", "rule IS NOT NULL AS ruled", "verdict")
    branches = rows.groupBy("host", "first").agg({"ruled": "max"}).withColumnRenamed("max(ruled)", "known")
    unruled = rows.where("NOT ruled").join(branches, ["host", "first"])
    assert unruled.count() > 100 and unruled.where("known").count() == 0 and unruled.where("verdict = 'block'").count() == 0
