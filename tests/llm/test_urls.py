"""URL verdicts: parsing and rules against plain Python, the template tree on known sites."""

import math
import random
import re

import pytest

from refmill.llm import urls

SCHEMA = "page_id bigint, url string, good double, general string, pages int"


def table(spark, rows):
    return spark.createDataFrame([(i, u, g, "x", 1) for i, u, g in rows], SCHEMA)


def parts(url):
    match = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
    host, path = match.groups() if match else ("", "")
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule_of(host, path):
    fit = []
    for action, rule in urls.RULES:
        rule_host, slash, rest = rule.partition("/")
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith(slash + rest):
            fit.append((len(rule), rule, action))
    return max(fit)[1:] if fit else (None, None)


HOSTS = ["example.com", "WWW.Example.com", "blog.example.com", "notexample.com", "a.net", "net", "x.org", "com", "ÄÖ.net", "e.example.com:80", ""]
PATHS = ["", "/", "/en", "/en/", "/en/1", "/es/5", "/fr/x?q=/en/", "/fr#top", "/de/7.html", "/a\nb/c", "?x://y.net/es/", "/" + "/".join("abcdefghijklm")]


def test_parsing_and_rules_equal_plain_python(spark):
    rnd = random.Random(1)
    rows = [(i, rnd.choice(["http", "https", ""]) + "://" + rnd.choice(HOSTS) + rnd.choice(PATHS), None) for i in range(300)]
    rows += [(1000, None, None), (1001, "", None), (1002, "no scheme/en/", None), (None, "http://a.net/es/1", None), (5, rows[5][1], 1.0), (5, rows[5][1], 1.0)]
    got = urls.judge_urls(table(spark, rows), urls.rule_table(spark, urls.RULES)).collect()
    want = []
    for page_id, url, _ in rows:
        host, path = parts(url)
        rule, action = rule_of(host, path)
        want.append((page_id, host, path, rule, action))
    assert sorted(((r.page_id, r.host, r.path, r.rule, r.verdict if r.rule else None) for r in got), key=repr) == sorted(want, key=repr)
    assert all(r.verdict in ("allow", "block") for r in got)


def site(spark):
    rows, n = [], 0
    for section, share in (("news", 0.95), ("blog", 0.94), ("spam", 0.1)):
        for i in range(60):
            rows.append((n, f"http://s.org/{section}/{1000 + i}.html", float(i < 60 * share) if i % 2 == 0 else None))
            n += 1
    for i in range(80):  # too many names to be anything but variable
        rows.append((n, f"http://s.org/user/{'abcdefgh'[i % 8]}{'klmnopqrst'[i // 8]}x/posts", 1.0))
        n += 1
    return rows


def test_tree_merges_alike_branches_and_rejects_impure_ones(spark):
    rows = site(spark)
    got = {r.page_id: r for r in urls.judge_urls(table(spark, rows), urls.rule_table(spark, [])).collect()}
    by_section = {}
    for page_id, url, _ in rows:
        by_section.setdefault(url.split("/")[3], set()).add((got[page_id].template, got[page_id].verdict))
    assert by_section["spam"] == {("/spam/#.html", "block")}
    assert {v for _, v in by_section["news"] | by_section["blog"]} == {"allow"}
    assert by_section["user"] == {("/user/*/posts", "allow")}


def test_alike_siblings_share_a_template(spark):
    rows = [(i, f"http://s.org/{'en fr de es'.split()[i % 4]}/{i}", float(i // 4 % 10 > 0)) for i in range(400)]
    got = urls.judge_urls(table(spark, rows), urls.rule_table(spark, [])).select("template", "verdict").distinct().collect()
    assert [tuple(r) for r in got] == [("/*/#", "allow")]


def test_impure_branch_stands_alone_among_many_siblings_and_deep_down(spark):
    for parent in ("", "a/b/c/d/e/f/g/"):
        rows = [(i, f"http://s.org/{parent}s{'abcdefgh'[i % 8]}{'klmnop'[i // 8 % 6]}/{i}", float(i % 20 > 0)) for i in range(960)]
        rows += [(2000 + i, f"http://s.org/{parent}spam/{i}", float(i % 10 == 0)) for i in range(60)]
        rows += [(3000 + i, f"http://s.org/{parent}rare{'xyz'[i]}/{i}", 1.0 if i else None) for i in range(3)]
        got = {r.page_id: (r.template, r.verdict) for r in urls.judge_urls(table(spark, rows), urls.rule_table(spark, [])).collect()}
        assert {got[2000 + i] for i in range(60)} == {(f"/{parent}spam/#", "block")}
        assert {got[i][1] for i in got if not 2000 <= i < 2060} == {"allow"}
        assert len({got[i][0] for i in got}) < 8  # the others share


@pytest.mark.parametrize("depth", [0, 3, 6, 7, 9, 40])
def test_good_pages_stay_at_any_depth(spark, depth):
    lead = "".join(f"d{'abcdefghij'[i % 10]}/" for i in range(depth))
    rows = [(i, f"http://s.org/{lead}{'pqrstuvw'[i // 2 % 8]}{'ijklmnop'[i // 16 % 8]}/{('good', 'spam')[i % 2]}", float(i % 2 == 0)) for i in range(400)]
    got = {r.page_id: r.verdict for r in urls.judge_urls(table(spark, rows), urls.rule_table(spark, [])).collect()}
    assert {got[i] for i in range(0, 400, 2)} == {"allow"} and {got[i] for i in range(1, 400, 2)} == {"block"}


def general(path):
    return tuple("*" if re.fullmatch("(?=.*[0-9])[0-9A-Fa-f-]{16,}", s) or len(s) > 64 else re.sub("[0-9]+", "#", s) for s in path.removeprefix("/").split("/"))


def alike(nodes, name):
    """Whether a child, given as counters of (pages, labelled, good) per next segment, is merged with its siblings."""
    total = [sum(c[i] for kinds in nodes.values() for c in kinds.values()) for i in range(3)]
    own = [sum(c[i] for c in nodes[name].values()) for i in range(3)]
    pooled = {}
    for kinds in nodes.values():
        for k, c in kinds.items():
            pooled[k] = pooled.get(k, 0) + c[0]
    apart = sum(abs(nodes[name].get(k, (0,))[0] / own[0] - n / total[0]) for k, n in pooled.items()) / 2
    uneven = max(0.0, 1 - sum(n * n for n in pooled.values()) / total[0] ** 2)
    chance = (math.sqrt(len(pooled) * uneven) / 2 + urls.CHANCE) / math.sqrt(own[0])
    others, same = total[1] - own[1], True
    if own[1] >= urls.FEW and others > 0:
        share = total[2] / total[1]
        error = math.sqrt(share * (1 - share) * (1 / own[1] + 1 / others))
        same = abs(own[2] / own[1] - (total[2] - own[2]) / others) <= urls.SIGNIFICANT * error + 1e-12
    return len(nodes) > 1 and apart <= max(urls.SPREAD, chance) + 1e-12 and same


def plain_templates(rows):
    """``page_id → (template, verdict)`` by a tree in plain Python: every level of every path."""
    pages = [(i, *parts(u), g) for i, u, g in rows]
    paths = {(h, general(p)): general(p) for _, h, p, _ in pages}
    for level in range(max(map(len, paths.values()), default=0)):
        nodes = {}
        for _, h, p, g in pages:
            key = paths[h, general(p)]
            if len(key) > level:
                after = key[level + 1] if len(key) > level + 1 else "/"
                c = nodes.setdefault((h, key[:level]), {}).setdefault(key[level], {}).setdefault(after, [0, 0, 0])
                c[0], c[1], c[2] = c[0] + 1, c[1] + (g is not None), c[2] + (g or 0)
        merged = {(*node, name) for node, children in nodes.items() for name in children if alike(children, name)}
        for at, key in paths.items():
            if len(key) > level and (at[0], key[:level], key[level]) in merged:
                paths[at] = (*key[:level], "*", *key[level + 1 :])
    labels = [g for _, _, _, g in pages if g is not None]
    overall = sum(labels) / len(labels) if labels else 1.0
    groups, found = {}, {}
    for i, h, p, g in pages:
        groups.setdefault((h, paths[h, general(p)]), []).append((i, g))
    for (_, key), members in groups.items():
        known = [g for _, g in members if g is not None]
        purity = (sum(known) + urls.SMOOTHING * overall) / (len(known) + urls.SMOOTHING)
        error = math.sqrt(overall * (1 - overall) / (len(known) + urls.SMOOTHING))
        pure = not known or purity + urls.DOUBT * error >= min(urls.PUREST, overall)
        found |= {i: ("/" + "/".join(key), "allow" if pure else "block") for i, _ in members}
    return found


@pytest.mark.parametrize("seed", range(4))
def test_verdicts_equal_a_plain_tree(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(900):
        host = rnd.choice(["a.org", "b.org", "c.net"])
        lead = "/".join(rnd.choice(["x", "y"]) for _ in range(rnd.choice([0, 0, 1, 8])))
        section = rnd.choice(["news", "blog", "spam", "u" + rnd.choice("abcdefgh"), "v" + rnd.choice("abcdefghijklmnop") + rnd.choice("xyz")])
        rest = rnd.choice([f"/{i}", f"/{i}.html", "/about", "", "/p/q/r/s/t/u/v/w/" + rnd.choice(["m", "n"]), "/0123456789abcdef0"])
        good = None if rnd.random() < 0.3 else float(rnd.random() > (0.85 if section == "spam" else 0.1))
        rows.append((i, f"http://{host}/{lead}/{section}{rest}", good))
    got = {r.page_id: (r.template, r.verdict) for r in urls.judge_urls(table(spark, rows), urls.rule_table(spark, [])).collect()}
    want = plain_templates(rows)
    assert {v for _, v in want.values()} == {"allow", "block"}
    assert got == want


def test_few_good_pages_overall_block_no_clean_template(spark):
    rnd, rows = random.Random(3), []
    for host in range(40):
        rows += [(len(rows), f"http://h{host}.org/a/{i}", float(rnd.random() < 0.72)) for i in range(10 + host)]
    rows += [(len(rows), f"http://new.org/a/{i}", None) for i in range(20)]
    rows += [(len(rows), f"http://spam.org/a/{i}", float(i % 10 == 0)) for i in range(60)]
    got = {r.page_id: r for r in urls.judge_urls(table(spark, rows), urls.rule_table(spark, [])).collect()}
    labels = [g for _, _, g in rows if g is not None]
    assert sum(labels) / len(labels) < urls.PUREST
    blocked = [(u.split("/")[2], g) for i, u, g in rows if got[i].verdict == "block"]
    assert {h for h, _ in blocked} == {"spam.org"} and len(blocked) == 60
    assert sum(g for _, g in blocked) / len(blocked) < 0.2


def test_empty_table(spark):
    assert urls.judge_urls(table(spark, []), urls.rule_table(spark, urls.RULES)).count() == 0
