from pyspark.sql import functions as F

from seriesship.llm import url_templates as U
from tests.llm import cases


def judged(spark, rows, rules=U.RULES):
    df = spark.createDataFrame([(i, u, b) for i, (u, b) in enumerate(rows)], "page_id long, url string, bad int")
    df = df.withColumns({c: F.lit("x") for c in ("raw", "host", "path", "template", "purity", "rule", "segment", "n")})
    return [r for r in U.judge(df, rules).orderBy("page_id").collect()]


def test_hosts_paths_and_rules(spark):
    want = [
        ("HTTP://WWW.Example.ORG/es/1?a#b", "www.example.org", "/es/1", "example.org/es/", "block"),
        ("https://example.org/en/15", "example.org", "/en/15", "example.org/en/1", "block"),
        ("https://example.org/en/25", "example.org", "/en/25", "org/", "allow"),
        ("https://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
        ("x://a.com/fr/x", "a.com", "/fr/x", "com/fr/", "allow"),
        ("x://a.com/de/", "a.com", "/de/", "com/de/", "block"),
        ("x://a.com/dex", "a.com", "/dex", None, "allow"),
        ("x://com/de/?q=://y", "com", "/de/", "com/de/", "block"),
        ("x://h?y/z", "h", "", None, "allow"),
        ("x://h#y", "h", "", None, "allow"),
        ("x://a://b/c", "a:", "//b/c", None, "allow"),
        ("x://É.NET/\n/a", "É.net", "/\n/a", None, "allow"),
        ("no scheme", "", "", None, "allow"),
        ("", "", "", None, "allow"),
        (None, "", "", None, "allow"),
    ]
    rows = judged(spark, [(u, None) for u, *_ in want])
    assert [(r.host, r.path, r.rule, r.verdict) for r in rows] == [w[1:] for w in want]


def test_bad_templates_are_rejected_and_others_stay(spark):
    rows = [(f"http://h.net/spam/{i}.html", 1) for i in range(60)]
    rows += [(f"http://h.net/news/{i}.html", 0) for i in range(60)]
    rows += [(f"http://h.net/user/name{i}x/home", i % 2) for i in range(60)]
    rows += [("http://h.net/spam/999.html", None), ("http://h.net/news/999.html", None), ("http://other.net/spam/1.html", None)]
    out = judged(spark, rows)
    verdicts = {k: {r.verdict for r in out if f"h.net{k}" in f"{r.host}{r.path}"} for k in ("/spam", "/news", "/user")}
    assert verdicts == {"/spam": {"block"}, "/news": {"allow"}, "/user": {"allow"}}
    assert [r.verdict for r in out[-3:]] == ["block", "allow", "allow"]
    assert {r.template for r in out if "/user" in r.path} == {"/(alike)/*/(alike)"}
    assert {r.template for r in out if r.host == "h.net" and "/spam" in r.path} == {"/spam/{n}.html"}


def test_branches_that_do_not_differ_are_merged(spark):
    rows = [(f"http://h.net/{lang}/{i}", int(i % 5 == 0)) for lang in ("en", "de", "fr") for i in range(50)]
    assert {r.template for r in judged(spark, rows)} == {"/(alike)/{n}"}


def test_purity_against_arithmetic(spark):
    rows = [(f"http://a.net/x/{i}", int(i < 7)) for i in range(10)] + [(f"http://b.net/y/{i}", 0) for i in range(30)]
    out = {(r.host): r.purity for r in judged(spark, rows)}
    overall = (40 - 7 + 10) / (40 + 10)
    host = (10 - 7 + 10 * overall) / 20
    assert abs(out["a.net"] - (3 + 10 * host) / 20) < 1e-12


def test_no_labels_repeats_and_empty(spark):
    rows = [("http://h.net/a/1", None)] * 3
    assert [r.verdict for r in judged(spark, rows)] == ["allow"] * 3
    none = cases.empty(spark).select(F.col("doc_id").alias("page_id"), F.col("text").alias("url"), F.lit(1).alias("bad"))
    assert U.judge(none).count() == 0


def tree(pages):
    """{(host, path): template} of ``pages`` (host, path, bad), by going down every host's tree with lists."""
    import math
    import re

    def general(segment):
        segment = re.sub(r"\A[0-9]+(\.[A-Za-z0-9]{1,5})?\Z", lambda m: "{n}" + (m[1] or ""), segment)
        return re.sub(r"\A(?=[a-f-]*[0-9])[0-9a-f-]{8,}(\.[A-Za-z0-9]{1,5})?\Z", lambda m: "{h}" + (m[1] or ""), segment)

    out = {}

    def down(rows, level, template):
        """``rows``: (key, segments, bad)."""
        branches = {}
        for row in rows:
            branches.setdefault(row[1][level] if level < len(row[1]) else None, []).append(row)
        inner = [r for s, b in branches.items() if s is not None for r in b]
        known = [r[2] for r in inner if r[2] is not None]
        share = sum(known) / max(len(known), 1)
        values = sum(s is not None for s in branches)
        varies = values >= U.VALUES and values > U.VARIETY * len(inner)
        meets = {}
        for s, b in branches.items():
            if s is None:
                for r in b:
                    out[r[0]] = template
                continue
            own = [r[2] for r in b if r[2] is not None]
            alike = not own or abs(sum(own) / len(own) - share) <= U.Z * math.sqrt(share * (1 - share) / len(own))
            if re.match(r"\{[nh]\}", s):
                step = "/" + s
            elif varies and len(own) < U.PRIOR:
                step = "/*"
            elif s == "" and template == "":
                step = ""
            else:
                step = "/(alike)" if alike else "/" + s
            meets.setdefault(template + step, []).extend(b)
        for name, b in meets.items():
            if level + 1 <= max(len(r[1]) for r in b):
                down(b, level + 1, name)

    hosts = {}
    for host, path, bad in pages:
        hosts.setdefault(host, []).append(((host, path), [general(s) for s in path.split("/", U.DEPTH - 1)], bad))
    for rows in hosts.values():
        down(rows, 0, "")
    return out


def test_templates_against_a_tree_of_lists(spark):
    import random

    rng, pages = random.Random(7), []
    for host in ("a.net", "b.net"):
        for i in range(400):
            top = rng.choice(["spam", "news", "shop", f"u{rng.randrange(200)}"])
            rest = rng.choice([f"{i}.html", "x", f"{i:08x}", "", "a/b/c", f"{rng.randrange(3)}/y"])
            bad = None if rng.random() < 0.2 else int(rng.random() < {"spam": 0.9, "news": 0.1}.get(top, 0.4))
            pages.append((host, f"/{top}/{rest}", bad))
    pages += [("c.net", f"/w{i}/x", i % 2) for i in range(60)] + [("c.net", f"/clean/{i}", 0) for i in range(80)]
    want = tree(pages)
    out = judged(spark, [(f"http://{h}{p}", b) for h, p, b in pages])
    assert [r.template for r in out] == [want[h, p] for h, p, _ in pages]
    assert {"/*/(alike)", "/clean/{n}"} <= {r.template for r in out if r.host == "c.net"}


def test_many_slashes_cost_no_more_rounds(spark):
    deep = "http://h.net" + "/a" * 5_000
    out = judged(spark, [(deep, 1), (deep + "/b", 0), ("http://h.net/" + "/" * 5_000, None), ("http://h.net/a/b", 0)])
    assert [r.path.count("/") for r in out] == [5_000, 5_001, 5_001, 2] and all(r.template is not None for r in out)


def test_a_bad_branch_beside_one_off_segments(spark):
    rows = [(f"http://h.net/spam/{i}", 1) for i in range(100)] + [(f"http://h.net/page{i}x/1", 0) for i in range(60)]
    out = judged(spark, rows)
    assert {r.verdict for r in out[:100]} == {"block"} and {r.verdict for r in out[100:]} == {"allow"}
