import random
import re

import llm_brute as B
import numpy as np
import pyarrow as pa
import pytest

from wardline.llm import url_filter as U


def glob_regex(glob):
    """A plain translation to Python's re."""
    out, host, i = "", True, 0
    while i < len(glob):
        c = glob[i]
        if c == "\\" and i + 1 < len(glob):
            i += 1
            out += re.escape(glob[i])
            host = host and glob[i] != "/"
        elif c == "*":
            out += "[^/]*" if host else ".*"
        elif c == "?":
            out += "."
        elif c == "[" and "]" in glob[i + 2:]:
            end = glob.index("]", i + 2)
            body = glob[i + 1:end]
            out += f"(?![^\\x00-\\x7f])[^{body[1:]}]" if body[0] == "!" else f"[{body}]"
            i = end
        else:
            out += re.escape(c)
            host = host and c != "/"
        i += 1
    return re.compile(out, re.S)


def brute(url, rules=U.DOMAIN_RULES, globs=U.GLOBS, default=U.DEFAULT):
    """(host, path, rule, pattern, verdict) by the contract's words."""
    host = path = query = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
        host, rest = rest[:cut].translate(B.LOWER), rest[cut:].split("#", 1)[0]
        path, _, query = rest.partition("?")
        query = rest[len(path):]
    fits = [(len(h + p), v == "block", h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        best = max(fits)
        return host, path, best[2], None, best[3]
    for g, v in sorted(globs, key=lambda g: (-len(g[0]), g[1] != "block", g[0])):
        if glob_regex(g).fullmatch(host + path + query):
            return host, path, None, g, v
    return host, path, None, None, default


URLS = [None, "", "no url", "://", "http://", "http://org", "http://org/", "https://a.ORG/x?y#z", "http://example.org/es",
        "http://example.org/es/", "http://www.Example.Org/es/1", "http://example.org/en/19", "http://xexample.org/es/",
        "http://example.org/en/2", "http://shop.com/fr/a", "http://shop.com/de/a", "http://shop.com/en/a.exe",
        "http://com/fr/", "http://com.fr/fr/", "http://x.net/org/", "http://x.net/.org/", "http://spam.x.net/",
        "http://a.spamfarm.net/b", "http://x.net/cart/1", "http://x.net/a?sessionid=3", "http://x.net/a?b=1&sessionid=3",
        "http://x.net/a#sessionid=3", "http://a#://b.org/?c", "http://x.net/tags/", "http://x.net/tag/",
        "http://m.example.net/é7.html", "http://m.example.net/7.htmlx", "http://é.org/日本", "http://a.b?http://example.org/es/",
        "http://x.net/" + "a" * 70_000 + ".exe", "http://user@org/", "http://org:80/", "x://Ä.ORG/ \n\t/z"]


def test_equals_brute_force(spark):
    rows = [(i, u, *["x"] * 4) for i, u in enumerate(URLS)] + [(None, "http://a.org/"), (5, URLS[5]), (5, URLS[5])]
    rows = [r + ("x",) * (6 - len(r)) for r in rows]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, path string, canonical string, rule string")
    got = U.judge(pages).collect()
    want = [(i, *brute(u)) for i, u, *_ in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert U.judge(pages.limit(0)).collect() == []


def test_random_globs_over_many_words():
    rng = random.Random(4)
    parts = ["a", "b", "ab", "é", "日", "/", ".", "?", "*", "[ab]", "[!a]", "[a-c/]", "\\*", "aaaaaaaaaaaaaaaaaaaa", ""]
    globs = ["".join(rng.choice(parts) for _ in range(rng.randrange(8))) for _ in range(300)] + ["*", "", "a" * 200 + "*"]
    urls = ["".join(rng.choice(["a", "b", "c", "é", "日", "/", ".", "*", "aaaaaaaaaaaaaaaaaaaa"])
                    for _ in range(rng.randrange(9))) for _ in range(400)] + ["a" * 200, "a" * 500, "/" * 3]
    hits = U.Automaton.build(globs).hits(pa.array(urls).cast(pa.large_binary()))
    want = np.array([[bool(glob_regex(g).fullmatch(u)) for g in globs] for u in urls])
    assert (hits == want).all(), [(urls[i], globs[j]) for i, j in np.argwhere(hits != want)[:5]]
    sliced = pa.array(urls).cast(pa.large_binary()).slice(7, 90)
    assert (U.Automaton.build(globs).hits(sliced) == want[7:97]).all()


def test_ties_and_wrong_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.b/x"), (2, "http://c/")], "page_id long, url string")
    got = U.judge(pages, [("a.b", "/x", "allow"), ("a.b", "/x", "block")], [("?/", "allow"), ("c/", "block")], "block")
    assert [(r.rule, r.pattern, r.verdict) for r in got.orderBy("page_id").collect()] == [
        ("a.b/x", None, "block"), (None, "c/", "block")]
    quoted = U.judge(pages, [("a.b", "/*", "block")], [])
    assert [r.verdict for r in quoted.orderBy("page_id").collect()] == ["allow", "allow"]
    for wrong in [("a/b", "/", "block"), ("", "/", "block"), ("a", "/?x", "block"), ("a", "/", "maybe")]:
        with pytest.raises(ValueError):
            U.judge(pages, [wrong])
