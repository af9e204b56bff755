import fnmatch
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tidewatch.llm import urls
from tidewatch.llm.queries import URL_RULES


def matches(rules, pairs):
    size = np.array([len(h) + len(p) + 2 for h, p in pairs])
    symbols = np.concatenate([np.array([46, *h.encode(), urls.BOUNDARY, *p.encode()], np.int16) for h, p in pairs])
    return urls.simulate(urls.compile_rules(rules), symbols, size)


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10**9))
def test_all_patterns_against_one_by_one(seed):
    rng = random.Random(seed)
    word = lambda chars, most: "".join(rng.choice(chars) for _ in range(rng.randint(0, most)))
    rules = [urls.Rule("block", word("ab.*?", 6) or "a", "/" + word("ab/*?", 12), rng.random() < 0.5, rng.random() < 0.5)
             for _ in range(rng.randint(1, 30))]
    pairs = [(word("ab.", 9), word("/ab", 14)) for _ in range(20)]
    expected = [[any(fnmatch.fnmatchcase(h[cut:], r.host) for cut in ([0] + [i + 1 for i, c in enumerate(h) if c == "."] if r.subdomains else [0]))
                 and fnmatch.fnmatchcase(p, r.path + "*" * r.prefix) for r in rules] for h, p in pairs]
    assert matches(rules, pairs).tolist() == expected


def judge(spark, given, rules=URL_RULES, **more):
    df = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(given)], "page_id long, url string, key string, rule string")
    return [tuple(r)[1:] for r in urls.judge_urls(df, rules, **more).orderBy("page_id").collect()]


@pytest.mark.parametrize("url,host,path,rule,verdict", [
    ("http://A.Example.ORG/en/1?x#y", "a.example.org", "/en/1", "example.org/en/1", "block"),
    ("http://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
    ("http://badexample.org/es/", "badexample.org", "/es/", "org/", "allow"),
    ("http://example.org", "example.org", "", None, "allow"),
    ("http://x.com/de/1", "x.com", "/de/1", "com/de/", "block"),
    ("http://x.com/q?u=http://example.org/es/", "x.com", "/q", None, "allow"),
    ("http://x.net/.example.org/es/", "x.net", "/.example.org/es/", None, "allow"),
    ("example.org/es/", "", "", None, "block"), (None, "", "", None, "block"), ("", "", "", None, "block"),
    ("http://org/", "org", "/", "org/", "allow"), ("http://example.org:80/es/", "example.org:80", "/es/", None, "allow"),
    ("://\nx.com#/de/", "\nx.com", "", None, "allow"), ("a\nb://com/fr/\n", "com", "/fr/\n", "com/fr/", "allow"),
])
def test_contract(spark, url, host, path, rule, verdict):
    assert judge(spark, [url]) == [(host, path, rule, verdict)]


def test_ties_long_urls_and_repeats(spark):
    rules = [urls.Rule("allow", "org", "/abc"), urls.Rule("block", "a.org", "/a"), urls.Rule("block", "*.org", "/z*.exe", prefix=False)]
    long = "http://b.org/z" + "y" * 500_000 + ".exe"
    found = judge(spark, ["http://a.org/abc", long, long, long + "x"], rules)
    assert [f[2:] for f in found] == [("a.org/a", "block"), ("*.org/z*.exe", "block"), ("*.org/z*.exe", "block"), (None, "allow")]
    assert judge(spark, ["http://a.org/"], []) == [("a.org", "/", None, "allow")]
    assert judge(spark, []) == []
