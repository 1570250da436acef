import random
import re

from flowlab.llm import url_filter as U

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("b.net", "", "block"), ("a.b.net", "/es", "allow")]
LISTED = [("bad.org", "", "block"), ("worse.bad.org", "/x", "block")]


def brute(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)

    def fits(rules):
        return [(len(h + p), len(h), h + p, v) for h, p, v in rules
                if (host == h or host.endswith("." + h)) and path.startswith(p)]

    ruled, listed = fits(RULES), fits(LISTED)
    if ruled:
        return host, path, max(ruled)[2], max(ruled)[3], False
    return host, path, None, max(listed)[3] if listed else "allow", bool(listed)


def tables(spark):
    schema = "host string, path string, verdict string"
    rules = spark.createDataFrame(RULES + [RULES[0], (None, "/", "block")], schema)
    return U.rule_table(rules).union(U.rule_table(spark.createDataFrame(LISTED, schema), listed=True))


def test_equals_brute_force(spark, with_clashes):
    r = random.Random(3)
    urls = [None, "", "no scheme", "http://", "://", "http://com/", "http://com", "http://COM/x", "http://É.com/en/",
            "ftp://user@www.Example.com:80/en/", "http://example.com/en", "http://example.com/EN/",
            "http://x/?u=http://y.com/", "http://a.b.net/es/1#t", "http://xb.net/", "http://bad.org", "http://bad.org/",
            "http://a..com/", "http://." + "a." * 300 + "com/" + "p" * 9000, "http://a\nb.com/\nc"]
    for _ in range(300):
        host = ".".join(r.choices(["www", "example", "b", "a", "bad", "worse"], k=r.randint(1, 3)))
        urls.append(f"http://{host}.{r.choice(['com', 'net', 'org'])}{r.choice(['', '/', '/en/', '/es/x', '/es', '/x?q#f'])}")
    urls += urls[5:9]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r["page_id"]: tuple(r)[1:] for r in U.judge_urls(with_clashes(pages), tables(spark)).collect()}
    assert got == {i: brute(u) for i, u in enumerate(urls)}


def test_equal_digests_are_told_apart():
    import pyarrow as pa

    fields = ["digest", "is_probe", "site", "verdict", "host_length", "listed"]
    kinds = [pa.int64(), pa.bool_(), pa.string(), pa.string(), pa.int32(), pa.bool_()]

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], fields)

    rules = [(5, False, "a/", "block", 1, False), (5, False, "b/", "allow", 1, False), (9, False, "c/", "block", 1, False)]
    probes = [(4, True, "d/", None, None, None), (5, True, "b/", None, None, None), (9, True, "x/", None, None, None)]
    for cut in range(1, 6):
        batches = [batch((rules + probes)[:cut]), batch((rules + probes)[cut:])]
        assert [x for b in U._probe(batches) for x in b.to_pylist()] == [
            {"site": "b/", "verdict": "allow", "host_length": 1, "listed": False}]
    assert [b for b in U._probe([batch(probes)]) if b.num_rows] == []


def test_empty_tables(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert U.judge_urls(none, tables(spark)).count() == 0
    one = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    no_rules = U.rule_table(spark.createDataFrame([], "host string, path string, verdict string"))
    assert [tuple(r) for r in U.judge_urls(one, no_rules).collect()] == [(1, "a.com", "/", None, "allow", False)]
