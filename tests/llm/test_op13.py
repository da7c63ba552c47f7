"""URL filters: rules and the host graph against plain Python."""

import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from churnwise.llm import op13_urlfilter as U

SCHEMA = "page_id long, url string, html string"
SP = r"[\x20\x09-\x0D]"


def lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


def locate(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return lower(host), re.match(r"[^?#]*", rest[len(host):])[0]


def rule_of(host, path):
    fits = [r for r in U.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.host + r.path), default=None)


def brute(rows):
    pages = [(i, *locate(u)) for i, u, _ in rows]
    rules = [rule_of(h, p) for _, h, p in pages]
    seed, undecided = {"t": Counter(), "d": Counter()}, Counter()
    for (_, h, _), r in zip(pages, rules):
        if h:
            (undecided if r is None else seed["t"] if r.verdict == "allow" else seed["d"])[h] += 1
    links = Counter()
    for (_, h, _), (_, _, html) in zip(pages, rows):
        for x in re.findall(rf"""{SP}(?:[hH][rR][eE][fF]){SP}*+={SP}*+["']?{SP}*+(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#"'<>\x20\x09-\x0D]+)""", html or ""):
            if h and lower(x) != h:
                links[h, lower(x)] += 1
    total = {}
    for kind in "td":
        out = defaultdict(float)
        ways = {(a, b) if kind == "t" else (b, a): n for (a, b), n in links.items()}
        degree = Counter()
        for (a, _), n in ways.items():
            degree[a] += n
        now = dict(seed[kind])
        for k in range(U.ROUNDS + 1):
            after = defaultdict(float)
            for h, m in now.items():
                out[h] += m
            for (a, b), n in ways.items():
                if a in now:
                    after[b] += now[a] * U.DAMPING * n / degree[a]
            now = after
        total[kind] = out
    result = []
    for (i, h, p), r in zip(pages, rules):
        t, d = total["t"][h], total["d"][h]
        bad = h and d > 0 and round(d, 9) >= round((t + d + undecided[h]) * U.THRESHOLD, 9)
        result.append((i, h, p, r and r.host + r.path, r.verdict if r else "block" if bad else "allow"))
    return result


def run(spark, rows):
    pages = spark.createDataFrame(rows, SCHEMA).withColumn("HOST", F.lit("clash")).withColumn("verdict", F.lit(1)).withColumn("rest", F.lit(2))
    return [tuple(r) for r in U.judge(pages).select("page_id", "host", "path", "rule", "verdict").collect()]


def same(got, want):
    key = lambda t: tuple(map(str, t))
    assert sorted(got, key=key) == sorted(want, key=key)


ODD = ["http://a.net/x", "http://net/", "http://net", "http://xnet/", "HTTP://EN.Example.NET/en/1?x=/de/", "http://example.net/en", "http://example.net/en/", "http://www.example.com/de/a#b",
       "http://example.com/DE/", "http://badexample.com/de/", "https://a.org/fr/", "https://a.org?/fr/", "https://ORG/fr/x", "no scheme", "", None, "://", ":///", "a://b://c/d?e", "http://é.org/fr/ü",
       "http://a.com:80/x", "http://u@a.net/x", "x://" + "h" * 100_000 + "/" + "p" * 2_000_000, "http://a.net\n/x", "http://İ.com/", "http:/a.net/"]


def test_rules_and_parts(spark):
    rows = [(i, u, None) for i, u in enumerate(ODD)] + [(None, "http://a.net/x", ""), (0, "http://b.com/", None), (0, "http://b.com/", None)]
    same(run(spark, rows), brute(rows))


def web():
    a = lambda *urls: "".join(f'<a class="x" href="{u}">y</a>' for u in urls)
    rows = [(1, "http://good.org/fr/1", a("http://friend.com/x", "//Friend.com", "/local", "http://other.com/")), (2, "http://friend.com/en/", a("http://far.com/")),
            (3, "http://spam.net/", None), (4, "http://linker.com/1", a(*["http://spam.net/a"] * 9) + "<a HREF = 'https://mixed.com/?q'>"), (5, "http://second.com/", a("http://linker.com/")),
            (6, "http://mixed.com/", a("http://spam.net/", "http://good.org/")), (7, "http://mixed.com/de/", "<a\nhref=//spam.net>"), (8, "http://half.example.com/de/", ""), (9, "http://half.example.com/en/", ""),
            (10, "http://third.example.com/de/", ""), (11, "http://third.example.com/en/", ""), (12, "http://third.example.com/", ""), (13, "http://far.com/", "<a data-href='http://spam.net'> href=x"),
            (14, "http://lonely.com/", "href=http://spam.net/ " + " href=" + " " * 200_000 + "x"), (15, "nothing", a("http://spam.net/"))]
    rows += [(200 + i, f"http://spam.net/{i}", None) for i in range(20)]
    rows += [(100 + i, f"http://fan{i % 40}.com/{i}", a("http://linker.com/", f"http://fan{(i + 1) % 40}.com/")) for i in range(120)]
    rows += [(300 + i, "http://hub.net/", a(*(f"http://leaf{i}x{k}.com/" for k in range(30)))) for i in range(10)]
    rows += [(500 + i, f"http://leaf{i}x3.com/", a("http://hub.net/")) for i in range(10)] + [(600 + i, "http://hot.com/", a("http://friend.com/")) for i in range(400)]
    return rows


def test_graph_equals_plain_python(spark):
    rows = web()
    got, want = run(spark, rows), brute(rows)
    same(got, want)
    verdict = {r[0]: r[4] for r in got}
    assert verdict[4] == "block" and verdict[2] == "allow" and verdict[9] == "block" and verdict[11] == "allow" and verdict[1] == "allow"


def test_chunks_change_nothing(spark):
    hosts = spark.createDataFrame([("a", 3, 0), ("b", 0, 5)], "host string, trust long, distrust long")
    edges = spark.createDataFrame([("a", f"t{i}", i % 3 + 1) for i in range(100)] + [(f"t{i}", "b", 1) for i in range(0, 100, 7)] + [("b", "a", 2)], "src string, dst string, n long")
    look = lambda df: sorted((r.host, round(r.trust, 9), round(r.distrust, 9)) for r in df.collect())
    assert look(U.propagate(edges, hosts, chunk=7)) == look(U.propagate(edges, hosts)) != []


def test_equals_sql(spark):
    import duckdb
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    rows = web() + [(1000 + i, u, None) for i, u in enumerate(ODD)]
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    same(run(spark, rows), con.execute(f"SELECT page_id, host, path, rule, verdict FROM ({U.SQL})").fetchall())


def test_no_python_in_the_plan(spark):
    plan = U.judge(spark.createDataFrame(web(), SCHEMA))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_empty_table(spark):
    assert run(spark, []) == []
