"""The URL filter: rules, shapes of segments, the learned tree against a plain one in Python and against SQL."""

from __future__ import annotations

import math
import random
import re
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from coverlens.llm import lookup as lookup_module
from coverlens.llm import queries
from coverlens.llm.lookup import lookup
from coverlens.llm.url_templates import host_of, judge, labelled_pages, path_of, shaped

RULES = queries.URL_RULES


def _judge(spark, rows, rules=RULES):
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, bad int, host string, n string")
    return sorted((tuple(r) for r in judge(pages, rules).collect()), key=str)


def _parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def _shape(s):
    if re.fullmatch("[0-9a-fA-F-]{8,}", s) and re.search("[0-9]", s) and re.search("[a-fA-F]", s):
        return "{hex}"
    if re.fullmatch("[^-_]+([-_][^-_]+){3,}", s):
        return "{slug}"
    if len(s) >= 24 and re.search("[0-9]", s):
        return "{id}"
    return re.sub("[0-9]+", "{n}", s)


def _rate(labelled, bad):
    r = (bad + 0.5) / (labelled + 1)
    return r, r * (1 - r) / (labelled + 1)


def _brute(rows, rules=RULES):
    parsed = []
    for page_id, url, bad in rows:
        host, path = _parts(url)
        cut = [s for s in path.split("/") if s]
        segments = [_shape(s) for s in cut] if len(cut) <= 8 else [*map(_shape, cut[:7]), "**"]
        parsed.append((page_id, host, path, bad, segments))
    template = [""] * len(rows)

    def sums(members):
        marks = [parsed[i][3] for i in members if parsed[i][3] is not None]
        return len(members), len(marks), sum(marks)

    for level in range(8):
        nodes = defaultdict(lambda: defaultdict(list))
        for i, (_, host, _, _, segments) in enumerate(parsed):
            if len(segments) > level:
                nodes[host, template[i]][segments[level]].append(i)
        for branches in nodes.values():
            n = sum(map(len, branches.values()))
            shares = defaultdict(list)
            for segment, members in branches.items():
                shares[segment if len(members) >= 8 and len(members) * 20 >= n else ""] += members
            groups = []
            for segment, members in sorted(shares.items(), key=lambda s: (_rate(*sums(s[1])[1:])[0], s[0])):
                if groups:
                    (one, e1), (two, e2) = _rate(*sums(groups[-1][1])[1:]), _rate(*sums(members)[1:])
                if groups and abs(one - two) <= 2 * math.sqrt(e1 + e2):
                    groups[-1] = (groups[-1][0] + [segment], groups[-1][1] + members)
                else:
                    groups.append(([segment], members))
            for names, members in groups:
                name = "*" if "" in names else names[0] if len(names) == 1 else f"({'|'.join(sorted(names))})"
                for i in members:
                    template[i] += "/" + name
    hosts, leaves = defaultdict(list), defaultdict(list)
    for i, (_, host, *_) in enumerate(parsed):
        hosts[host].append(i)
        leaves[host, template[i]].append(i)
    _, labelled, bad = sums(range(len(rows)))
    general = (bad + 1) / (labelled + 2)
    out = []
    for i, (page_id, host, path, _, _) in enumerate(parsed):
        _, labelled, bad = sums(hosts[host])
        rate = (bad + 4 * general) / (labelled + 4)
        _, labelled, bad = sums(leaves[host, template[i]])
        purity = 1 - (bad + 4 * rate) / (labelled + 4)
        fits = [r for r in rules if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
        best = max(fits, key=lambda r: (len(r[1] + r[2]), len(r[1]), r[0]), default=None)
        verdict = best[0] if best else "block" if purity < 0.5 else "allow"
        out.append((page_id, host, path, best[1] + best[2] if best else None, verdict, template[i], round(purity, 9)))
    return sorted(out, key=str)


ODD = [
    None, "", "no scheme", "://", "http://", "HTTP://WWW.Example.COM", "http://www.example.com/en/1?x=/fr/", "http://example.com/en/",
    "http://x.example.com/en/a#b", "http://notexample.com/en/1", "http://net/es/1", "http://a.net/es", "http://a.net/es/?q", "http://a.net?/es/",
    "http://a.org/1://b.net/es/", "http://É.org/É/", "http://a.org//x///y/", "http://a.org/" + "/".join("abcdefghij"), "http://a.org/a\n/b",
    "http://a.org/" + "z" * 100_000, "http://b.org:80/en/1", "x://y.com/es/", "http://a.org/99999999999999999999999",
    "http://a.org/0a1b2c3d/a-b-c-d/" + "x1" * 12,
]


def _rows(seed):
    draw = random.Random(seed)
    rows = [(i, u, draw.choice([0, 1, None])) for i, u in enumerate(ODD)]
    for i in range(400):
        host = draw.choice(["hot.org"] * 6 + ["a.org", "b.net", "c.com", "www.example.com"])
        first = draw.choice(["shop", "shop", "blog", f"user{draw.choice('abcdefgh')}", draw.choice("pqrstu") * 3])
        tail = draw.choice([f"/{draw.randrange(99)}", f"/{draw.choice('xyz')}/{draw.randrange(9)}.html", ""])
        bad = draw.choice([None, int(draw.random() < (0.9 if first == "shop" else 0.1))])
        rows.append((draw.choice([i, 7, None]), f"https://{host}/{first}{tail}", bad))
    return rows + rows[-20:]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_a_plain_tree(spark, seed, monkeypatch):
    monkeypatch.setattr(lookup_module, "HOTTEST", 2 if seed == 2 else 1000)
    rows = _rows(seed)
    found = [(*r[:6], round(r[6], 9)) for r in _judge(spark, rows)]
    assert found == _brute(rows)


def test_rules_without_labels(spark):
    urls = ["http://a.com/x", "http://example.com/en/x", "http://www.example.com/en/x", "http://b.www.example.com/en/", "http://x.net/es/1", "http://x.net/de/1"]
    found = _judge(spark, [(i, u, None) for i, u in enumerate(urls)])
    assert [(r[3], r[4]) for r in found] == [
        ("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("www.example.com/en/", "allow"),
        ("net/es/", "block"), (None, "allow"),
    ]
    assert {r[4] for r in _judge(spark, [(1, "http://x.net/es/1", None)], ())} == {"allow"}


def test_a_bad_branch_is_rejected_and_like_branches_merge(spark):
    rows = [(i, f"http://h.org/{'spam' if i % 4 == 0 else 'abc'[i % 3]}/{i}", int(i % 4 == 0)) for i in range(200)]
    rows += [(900, "http://h.org/spam/77777", None)]
    found = {r[0]: r for r in _judge(spark, rows)}
    assert found[900][4:6] == ("block", "/spam/{n}") and {r[5] for r in found.values()} == {"/spam/{n}", "/(a|b|c)/{n}"}
    rows += [(1000 + i, f"http://h.org/new{'x' * i}/1", 0) for i in range(9)]
    found = {r[0]: r for r in _judge(spark, rows)}
    assert found[900][4:6] == ("block", "/spam/{n}") and {r[5] for r in found.values()} == {"/spam/{n}", "/*/{n}"}


def test_empty_table(spark):
    assert _judge(spark, []) == []


def test_columns_of_urls(spark):
    frame = spark.createDataFrame([(u,) for u in ODD], "url string")
    for row in frame.select("url", host_of("url"), path_of("url")).collect():
        assert tuple(row[1:]) == _parts(row[0])
    words = ["12", "a1", "0a1b2c3d", "abcdefab", "a-b-c-d", "a_b_c_d_e", "a-b-c", "--a-b-c", "x1" * 12, "a" * 30, "deadbeef0\n"]
    frame = spark.createDataFrame([(w,) for w in words], "s string").select("s", shaped(F.col("s")))
    assert all(row[1] == _shape(row[0]) for row in frame.collect())


def test_labels_by_document_number(spark):
    pages = spark.createDataFrame([(1, "x://h/en/5"), (2, "x://h/5/"), (3, "x://h/6"), (4, None), (None, "x://h/7"), (6, "x://h/8")], "page_id long, url string")
    labels = spark.createDataFrame(
        [(5, 1, 0), (5, 1, 1), (6, 1, 0), (7, 0, None), (8, None, None), (None, 0, 1)], "doc_id long, quality int, toxic int"
    )
    found = sorted(((r["page_id"], r["bad"]) for r in labelled_pages(pages, labels).collect()), key=str)
    assert found == sorted([(1, 1), (2, 1), (3, 0), (4, None), (None, 1), (6, 0)], key=str)


def test_sql_says_the_same_on_odd_rows(spark, tmp_path):
    draw = random.Random(5)
    rows = [(i, url) for i, (_, url, _) in enumerate(_rows(3))]
    spark.createDataFrame(rows, "page_id long, url string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    marks = [(i, draw.choice([0, 1]), draw.choice([0, 0, 1, None])) for i in range(60)]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").coalesce(1).write.parquet(f"{tmp_path}/labels.parquet")
    connection = duckdb.connect()
    for name in ("pages", "labels"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    wanted = connection.execute(queries.ORACLE["op11_url_filters"]).fetchall()
    found = [tuple(r) for r in queries.op11_url_filters(spark, str(tmp_path)).collect()]
    tidy = lambda table: sorted(((*r[:6], round(r[6], 9)) for r in table), key=str)
    assert tidy(found) == tidy(wanted)


def test_lookup_of_hot_and_null_keys(spark, monkeypatch):
    monkeypatch.setattr(lookup_module, "HOTTEST", 1)
    rows = spark.createDataFrame([(i, k) for i, k in enumerate([1] * 50 + [2, 3, None, 4])], "i long, k int")
    table = spark.createDataFrame([(1, 50, "a"), (2, 1, "b"), (None, 1, "n"), (3, 1, None)], "k int, n long, v string")
    found = {r["i"]: r["v"] for r in lookup(rows, table, ("k",), "n", F.col("i")).collect()}
    assert found == {**dict.fromkeys(range(50), "a"), 50: "b", 51: None, 52: "n", 53: None}
