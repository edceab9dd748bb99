"""URL filters and licence scans against plain Python."""

import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from irspark.llm import hostrank, licenses
from irspark.llm.query_web import RULES, op2_urls, op8_licenses
from irspark.llm.registry import table

from .conftest import DIR


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule(host, path):
    fits = []
    for r in RULES:
        name, _, rest = r.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            fits.append(r)
    return max(fits, key=len) if fits else None


def judged(pages):
    edges, trust, distrust, hosts = Counter(), Counter(), Counter(), set()
    for _, url, html in pages:
        host, path = parts(url)
        r = rule(host, path)
        if r:
            (trust if RULES[r] == "allow" else distrust)[host] += 1
        if host:
            hosts.add(host)
            for link in re.findall(r"""(?i)<a\s[^>]*?href\s*=\s*["']?([^"'\s>]+)""", html or ""):
                if re.match(r"([A-Za-z][A-Za-z0-9+.-]*:)?//", link):
                    other = parts("x:" + link if link.startswith("//") else link)[0]
                    if other and other != host:
                        edges[host, other] += 1
    owned = set()
    for h in hosts:
        labels = h.split(".")
        for k in range(2, len(labels)):
            owned |= {(h, ".".join(labels[-k:])), (".".join(labels[-k:]), h)}
    for e in owned:
        edges[e] += 1
    out, into = Counter(), Counter()
    for (a, b), n in edges.items():
        out[a] += n
        into[b] += n
    t, d = dict(trust), dict(distrust)
    for _ in range(hostrank.ROUNDS):
        nt, nd = defaultdict(float), defaultdict(float)
        for h, n in trust.items():
            nt[h] += 0.15 * n
        for h, n in distrust.items():
            nd[h] += 0.15 * n
        for (a, b), n in edges.items():
            nt[b] += 0.85 * n / out[a] * t.get(a, 0)
            nd[a] += 0.85 * n / into[b] * d.get(b, 0)
        t, d = nt, nd
    rows = []
    for i, url, _ in pages:
        host, path = parts(url)
        r = rule(host, path)
        x, y = t.get(host, 0), d.get(host, 0)
        rows.append((i, host, path, r, RULES[r] if r else ("block" if y > 0.5 * (x + y) else "allow")))
    return rows


def shown(out):
    return sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in out), key=str)


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_op2_whole_table(spark, sf):
    d = DIR.replace("0.001", sf)
    pages = [(r.page_id, r.url, r.html) for r in table(spark, d, "pages").collect()]
    assert shown(op2_urls(spark, d).collect()) == sorted(judged(pages), key=str)


def test_urls_odd_rows(spark):
    link = '<a class=x href="{}">l</a>'
    pages = [(1, None, None), (2, "no scheme.org/en/", ""), (3, "http://A.Example.ORG/es/x?y://z", link.format("//spam.com/de/")),
             (4, "http://example.org/en/12", "<a href='http://b.net/'>"), (5, "http://b.net?q=/", link.format("https://spam.com/x")),
             (6, "http://spam.com/de/", link.format("/de/") * 3), (7, "http://spam.com/other#/fr/", None), (8, "ftp://x.org", ""),
             (9, "http://é.ÀB.org/é", ""), (None, "http://spam.com/q", ""), (11, "http://://x", ""), (12, "a\nb://c.com/fr/\nd", ""),
             (6, "http://spam.com/de/", link.format("/de/") * 3), (13, "http://myorg/en/", ""), (14, "http://good.org/a", link.format("http://b.net/") * 2000)]
    rows = [(*p, "x", "y") for p in pages]
    given = spark.createDataFrame(rows, "page_id bigint, url string, html string, host string, trust string")
    assert shown(hostrank.judge(given, RULES).collect()) == sorted(judged(pages), key=str)
    assert hostrank.judge(given.limit(0), RULES).count() == 0


def tokens(line):
    return re.findall(r"[a-z0-9]+(?:[.\-][a-z0-9]+)*", line.lower())


def is_license(path):
    return path is not None and re.search(r"(?i)(^|/)(LICEN[CS]E|COPYING)[^/]*$", path)


def cosines(texts, corpus, templates):
    """text -> {template: cosine} of counted terms, by the frequencies in corpus and templates."""
    given = {k: Counter(tokens(v)) for k, v in templates.items()}
    held = [set(tokens(x)) for x in corpus]
    df = Counter(t for c in [*held, *given.values()] for t in set(c))
    n = sum(1 for c in held if c) + len(given)
    idf = {t: math.log((1 + n) / (1 + k)) + 1 for t, k in df.items()}
    norm = lambda c: math.sqrt(sum((v * idf[t]) ** 2 for t, v in c.items()))
    out = {}
    for x in texts:
        c = Counter(tokens(x))
        if c:
            out[x] = {k: round(sum(v * g[t] * idf[t] ** 2 for t, v in c.items() if t in g) / (norm(c) * norm(g)), 6)
                      for k, g in given.items()}
    return out


def runs(line):
    """The line, and if it is long every run of its terms as long as a template that states something."""
    lengths = {len(tokens(v)) for v in licenses.TEMPLATES.values()}
    t = tokens(line)
    out = {line}
    if len(t) > 2 * max(lengths):
        states = [bool(re.search("licen[cs]e|copyright|^public$", x)) for x in t]
        out |= {" ".join(t[i : i + k]) for k in lengths for i in range(len(t) - k + 1) if any(states[i : i + k])}
    return out


def own_licenses(files):
    lines = {x for _, t in files for x in (t or "").split("\n") if re.search(r"(?i)licen[cs]e|copyright|public domain", x)}
    parts = {x: runs(x) for x in lines}
    scores = cosines({u for us in parts.values() for u in us}, lines, licenses.TEMPLATES)
    bodies = [" ".join(t or "" for p, t in files if p == path) for path in sorted({p for p, _ in files if is_license(p)})]
    whole = cosines(bodies, bodies, licenses.BODIES)
    by_path = defaultdict(list)
    for path, text in files:
        by_path[path] += [(-v, k) for x in (text or "").split("\n") for u in parts.get(x, ()) for k, v in scores.get(u, {}).items()]
    for path in by_path:
        if is_license(path):
            text = " ".join(t or "" for p, t in files if p == path)
            by_path[path] += [(-v, k) for k, v in whole.get(text, {}).items()]
    best = {p: min(found) for p, found in by_path.items() if found}
    return {p: (k, -v) for p, (v, k) in best.items() if -v >= licenses.THRESHOLD}


def scanned(files):
    own = own_licenses(files)
    folders = {}
    for p in sorted((p for p in own if is_license(p)), reverse=True):
        folders[p.rpartition("/")[0]] = own[p]
    out = []
    for p, _ in files:
        if p is None:
            out.append((None, None, None, None))
        elif p in own:
            out.append((p, *own[p], "own"))
        else:
            up, found = p, None
            while True:
                up = up.rpartition("/")[0]
                found = folders.get(up)
                if found or not up:
                    break
            out.append((p, *found, "inherited") if found else (p, None, None, None))
    return sorted(out, key=str)


def test_op8_whole_table(spark):
    d = DIR.replace("0.001", "0.01")
    out = op8_licenses(spark, d).collect()
    assert len(out) == table(spark, d, "documents").count()
    text = {r.doc_id: r.text for r in table(spark, d, "documents").collect()}
    want = scanned([(r.path, text[r.doc_id]) for r in out])
    assert sorted(((r.path, r.license, r.score, r.origin) for r in out), key=str) == want
    assert {r.license for r in out} >= {"MIT", "GPL-3.0", "CC-BY-NC-4.0", "Apache-2.0"}


def test_licenses_odd_rows(spark):
    mit, gpl = licenses.TEMPLATES["MIT"], licenses.TEMPLATES["GPL-3.0"]
    files = [("LICENSE", mit), ("a/LICENSE-x", gpl + "\nmore"), ("a/LICENCE", "no terms here"), ("a/b/c/d.txt", "x"), ("a/b/COPYING", None),
             ("z.txt", ""), (None, mit), (None, None), ("q/r", "word " * 50_000 + "license"), ("q/r", "word"), ("s/t", "\n" * 1000 + mit.upper()),
             ("u/v", "This license is about something else"), ("", "empty path"), ("/abs/file", "x"), ("w/LICENSE", mit + "\n" + gpl), ("w/x", None)]
    given = spark.createDataFrame([(p, t, 1, "z") for p, t in files], "path string, text string, score int, origin string")
    out = licenses.scan(given).collect()
    assert sorted((tuple(r) for r in out), key=str) == scanned(files)
    assert licenses.scan(given.limit(0)).count() == 0


def test_statements_in_long_lines_and_bodies(spark):
    mit, prose = licenses.TEMPLATES["MIT"], "plain words about the weather and the sea "
    body = "Copyright (c) 2020 Somebody\n\n" + licenses.BODIES["MIT"].replace("charge, to any", "charge,\nto any")
    files = [("a/long.txt", prose * 20 + mit + " " + prose * 400), ("b/LICENSE", body), ("b/c/x.py", "x = 1"), ("b/copy.txt", body),
             ("d/COPYING", licenses.BODIES["BSD-3-Clause"].upper()), ("d/y", ""), ("e/none.txt", prose * 30 + "this license is new " + prose * 30)]
    out = licenses.scan(spark.createDataFrame(files, "path string, text string")).collect()
    assert sorted((tuple(r) for r in out), key=str) == scanned(files)
    found = {r.path: (r.license, r.origin) for r in out}
    assert found["a/long.txt"] == ("MIT", "own") and found["b/LICENSE"] == ("MIT", "own")
    assert found["b/c/x.py"] == ("MIT", "inherited") and found["d/y"] == ("BSD-3-Clause", "inherited")
    assert found["e/none.txt"] == (None, None)


def test_op8_with_odd_ids(spark, tmp_path):
    """Null and negative ids, and languages that end in digits, through the query itself."""
    mit = "Licensed under the MIT License."
    rows = [(None, "nothing", "en"), (None, "nothing here", "x9"), (-20, "plain", "en"), (-5, "plain", "v12"), (7, None, None), (40, mit, "en")]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumn("source", F.lit("s1")).write.parquet(
        f"{tmp_path}/documents.parquet")
    found = op8_licenses(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in found) == sorted((d is None, d or 0) for d, _, _ in rows)
