"""WARC round trips, main text of pages, licence scan and fingerprints."""

from __future__ import annotations

import base64
import gzip
import hashlib
import math
import random
import time
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from ticklake.llm import fingerprints, html_text, licenses, warc
from ticklake.llm.common import Scratch, scratch_path

# ---- WARC

TRICKY = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\nWARC/1.1\r\n\r\n"
PAGES = [(5, "http://a.example/x y?q=1", "<p>same</p>"), (3, "https://b.example", "<p>same</p>"), (9, None, None),
         (7, "x", ""), (1, "http://t.example/\n", TRICKY), (2, "http://u.example", "é 中文 \x00 \r\n\r\n"),
         (8, "http://u.example", "long " * 5000), (None, "http://n.example", "<p>same</p>"), (11, "u", "only")]
PAGE_SCHEMA = "page_id long, url string, html string"


def sha32(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_warc_round_trip(spark):
    df = spark.createDataFrame([(*r, "s", 1) for r in PAGES], PAGE_SCHEMA + ", record_type string, size int").repartition(3)
    rows = {r["page_id"]: r for r in warc.round_trip(df).collect()}
    assert len(rows) == len(PAGES)
    for page_id, _, html in PAGES:
        r = rows[page_id]
        assert r["payload_bytes"] == len((html or "").encode()) and r["payload_digest"] == sha32(html)
        same = [k for k, _, h in PAGES if (h or "") == (html or "") and k is not None]
        first = min(same)
        assert r["record_type"] == ("response" if page_id == first else "revisit")
        assert r["refers_to"] == (None if page_id == first else first)
    assert warc.round_trip(df.where("page_id < 0")).count() == 0


def test_payloads_under_the_least_size_are_responses(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")], PAGE_SCHEMA)
    rows = {r["page_id"]: r["record_type"] for r in warc.round_trip(df, min_bytes=3).collect()}
    assert rows == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_repeated_rows_are_captures_of_their_own(spark):
    df = spark.createDataFrame([(1, "u", "ab")] * 3, PAGE_SCHEMA)
    rows = warc.round_trip(df).collect()
    assert sorted(r["record_type"] for r in rows) == ["response", "revisit", "revisit"]
    assert {r["refers_to"] for r in rows if r["record_type"] == "revisit"} == {1}


def test_transactions_nest_request_and_metadata(spark):
    df = spark.createDataFrame(PAGES, PAGE_SCHEMA).select(
        F.monotonically_increasing_id().alias("capture_key"), F.col("page_id").alias("order_key"), "url", "html")
    path = scratch_path(spark, "warc-test")
    scratch = Scratch(spark)
    keyed = scratch.keep(df, "keyed")
    warc.write_archives(keyed, path, scratch)
    recs = warc.read_records(spark, path)
    assert {r["type"]: r["count"] for r in recs.groupBy("type").count().collect()} == {
        "request": 9, "metadata": 9, "response": 6, "revisit": 3}
    whole = warc.assemble(recs).collect()
    html = {r["capture_key"]: r["html"] or "" for r in keyed.collect()}
    for r in whole:
        assert r["request"]["target_uri"] == r["target_uri"] and r["metadata"]["capture_key"] == r["capture_key"]
        if r["record_type"] == "response":
            assert bytes(r["payload"]).decode() == html[r["capture_key"]]
            assert r["payload_digest"] == r["true_digest"] == sha32(html[r["capture_key"]])


def test_archives_hold_a_bounded_number_of_records(spark):
    pages = spark.range(100).select(
        F.col("id").alias("capture_key"), F.col("id").alias("order_key"), F.when(F.col("id") > 3, "http://h/").alias("url"),
        F.when(F.col("id") == 5, F.repeat(F.lit("\r\n\r\nWARC/1.1 é"), 400_000)).otherwise("one payload").alias("html"))
    path = scratch_path(spark, "warc-bounded")
    warc.write_archives(pages.coalesce(1), path, Scratch(spark), records_per_file=30)
    files = spark.read.format("binaryFile").load(path).select("content").collect()
    held = [sum(1 for _ in warc.records(gzip.decompress(bytes(f["content"])))) for f in files]
    assert sum(held) == 300 and max(held) <= 30
    whole = warc.assemble(warc.read_records(spark, path))
    assert whole.count() == 100 and whole.where("metadata is null or request is null").count() == 0
    assert whole.where("capture_key = 5 and payload_bytes = 15 * 400000").count() == 1


def test_a_damaged_archive_is_an_error():
    good = b"WARC/1.1\r\nWARC-Type: request\r\nContent-Length: 2\r\n\r\nab\r\n\r\n"
    assert [bytes(b) for _, b in warc.records(good * 2)] == [b"ab", b"ab"]
    for bad in (good[:-1], b"x" + good, good.replace(b"Length: 2", b"Length: 1")):
        with pytest.raises((ValueError, IndexError)):
            list(warc.records(bad))


# ---- HTML

def text_of(spark, pages, **options):
    df = spark.createDataFrame([(k, u, h, "x", 1) for k, (u, h) in enumerate(pages)],
                               PAGE_SCHEMA + ", path string, n int")
    return {r["page_id"]: r["text"] for r in html_text.extract(df, **options).collect()}


ARTICLE = ("<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t='</p><p>no</p>';</script></head>"
           "<body><nav><ul><li><a href='/x'>Menu</a></ul></nav><!-- ad > --><div class=\"ad\">Buy.</div><article>"
           "<h1>Head &amp; more</h1><p><b>Bold\n  text.<br><p>Two &lt;x&gt; &eacute;&#x4e2d; A&nbsp;B</p>"
           "<form>Mail <input value='>'></form><div id=comments>First!</div><ul><li>one<li>two <i>x</i></ul>"
           "<aside>Side</aside></article><footer>&copy; us</footer></body></html>")


def test_main_text_of_articles(spark):
    odd = [("http://h.example/1", ARTICLE), (None, None), ("", ""), ("http://h.example/2", "plain < text & more"),
           ("http://h.example/3", "<p>open <b>never closed"), ("http://h.example/4", "<article><p>" + "w " * 20000),
           ("u", "<div>a<script>x</div><p>y</p>"), ("u", "<p>one<p>two</div></p><main>only</main>")]
    got = text_of(spark, odd)
    assert got[0] == "Head & more\n\nBold text.\n\nTwo <x> é中 A B\n\none\n\ntwo x"
    assert got[1] == got[2] == ""
    assert got[3] == "plain < text & more"
    assert got[4] == "open never closed"
    assert got[5] == " ".join(["w"] * 20000)
    assert got[6] == "a"
    assert got[7] == "only"
    assert text_of(spark, odd[:0] or [("u", "")]) == {0: ""}


def test_site_style_tree_drops_what_a_host_repeats(spark):
    rnd = random.Random(2)

    def page(k):
        body = " ".join(rnd.choice(["red", "blue", "green", "tall"]) + str(rnd.randrange(999)) for _ in range(12))
        return (f"https://user@Site.example:80/{k}", f"<html><body><div class=top>Welcome to our site</div>"
                f"<div class=text><p>{body}</p></div><div class=end>Terms and privacy</div></body></html>")
    pages = [page(k) for k in range(20)] + [("http://other.example/", "<body><div class=top>Welcome to our site</div>")]
    got = text_of(spark, pages)
    for k in range(20):
        assert "Welcome" not in got[k] and "Terms" not in got[k] and len(got[k].split()) == 12
    assert got[20] == "Welcome to our site"  # one page of a host is no template


def test_importance_is_one_minus_mean_entropy(spark):
    rows = [("h", [("p", "leaf", 1 if k < 6 else k)]) for k in range(8)]
    df = spark.createDataFrame(rows, "host string, " + html_text.TREE)
    got = html_text.importance(df).collect()
    want = 1 - (6 * math.log(6)) / 8 / math.log(8)
    assert got[0]["pages"] == 8 and got[0]["importance"] == pytest.approx(html_text.GAMMA * want)


def test_layouts_of_a_parent_never_lower_a_leaf(spark):
    # 1000 pages of a host in 25 layouts, one of them dominant; no page marks an article
    pages = []
    for k in range(1000):
        extra = "".join(f"<div class=x{j}></div>" for j in range(k % 25 if k % 4 == 0 else 0))
        pages.append((f"http://hot.example/{k}", f"<body><div class=top>Welcome to us</div>{extra}<p>own text {k}</p></body>"))
    got = text_of(spark, pages)
    assert all(got[k] == f"own text {k}" for k in range(1000))


def test_tree_judges_pages_with_an_article(spark):
    def page(k):
        return (f"http://cards.example/{k}", f"<body><div class=top>Welcome to us</div><div class=content><p>own text {k}</p>"
                f"</div><article class=card><p>teaser {k}</p><div class=more>Read more here</div></article></body>")
    copy = ("http://copies.example/", "<body><p>about</p><article><p>same text</p></article></body>")
    got = text_of(spark, [page(k) for k in range(20)] + [copy] * 20)
    for k in range(20):
        assert got[k] == f"own text {k}\n\nteaser {k}"
        assert got[20 + k] == "same text"  # copies of one page are no template


def test_slugs_are_no_furniture():
    body = ('<section id="related-work"><h2 id="share-of-market">A</h2>B</section><div id="social-impact">C</div>'
            '<h2 id="menu-design">D</h2><h3 id="comments">E</h3>')
    gone = '<div id="share-buttons">x</div><div class="wide ad">x</div><div id=comments>x</div>'
    for page in (f"<article>{body}<div class=menu-design>F</div>{gone}</article>", f"<div>{body}<p>F</p>{gone}</div>"):
        assert [b[1] for b in html_text.parse(page)[0]] == list("ABCDEF")


def test_headings_that_a_host_repeats_stay(spark):
    def page(k, outer):
        return (f"http://{outer}.example/{k}", f"<body><{outer}><h1>Paper {k}</h1><section><h2>Introduction</h2><p>own {k}</p></section>"
                f"<div class=part><h2>Results</h2></div><p>Thanks to all.</p><div class=end><p>Cite us</p></div></{outer}></body>")
    got = text_of(spark, [page(k, outer) for outer in ("article", "div") for k in range(20)])
    for k, outer in ((k, outer) for outer in ("article", "div") for k in range(20)):
        want = [f"Paper {k}", "Introduction", f"own {k}", "Results", "Thanks to all."]
        assert got[k + 20 * (outer == "div")].split("\n\n") == want


def test_furniture_inside_articles():
    names = ["notice", "promo", "related", "ad-slot", "menu", "social-links", "newsletter-box", "related-posts", "share-buttons"]
    page = "<article><p>A</p>" + "".join(f'<div class="{n}"><p>x</p></div>' for n in names) + "<p class=menu-design>B</p></article>"
    assert [b[1] for b in html_text.parse(page)[0]] == ["A", "B"]


def test_names_outside_articles_are_whole_classes():
    keeps = '<div class="article-header"><h1>A</h1></div><div class="share-prices"><p>B</p></div><div class="notice-period">C</div>'
    gone = '<div class="site-header">x</div><div class="header">x</div><div class="wide share-bar">x</div><ul class="main-menu"><li>x</ul>'
    assert [b[1] for b in html_text.parse(f"<body>{keeps}{gone}</body>")[0]] == ["A", "B", "C"]


HOSTILE = {"unclosed tags": "<a " * 350_000, "open quotes": "<a '" * 250_000, "quoted ends": "<a '>' " * 150_000,
           "nesting": "<div>" * 100_000 + "x", "odd ends": "<b>x" * 100_000 + "</i>" * 100_000, "rules": "<b>" * 50_000 + "<hr>x" * 50_000,
           "attributes": "<p " + "x " * 500_000 + "y=1>t", "raw": "<script>" * 100_000 + "</script " * 10, "comments": "<!--" * 200_000,
           "lists": "<b>" * 30_000 + "<li>" * 30_000 + "x"}


@pytest.mark.parametrize("name", HOSTILE)
def test_hostile_pages_take_linear_time(name):
    started = time.monotonic()
    html_text.parse(HOSTILE[name])
    assert time.monotonic() - started < 5


def test_raw_elements_end_at_their_tag():
    page = "<article><p>a<script>if(a<b && c=='x>y'){x<y;}</script>b</p><style>p>a{}</style ><p>c<textarea></p></textarea>d"
    assert [b[1] for b in html_text.parse(page)[0]] == ["ab", "cd"]


def brute_extract(sites, low, least):
    """Texts of pages given as [(host, [(outside, [(branch, tag, text)])])], by the rules on the model."""
    seen, placed = defaultdict(list), defaultdict(set)
    trees = {(h, frozenset((not o, b, t, x) for o, blocks in g for b, t, x in blocks)) for h, g in sites}  # copies count once
    for host, leaves in trees:
        for inside, branch, tag, text in leaves:
            seen[host, inside, branch, tag].append(text)
            placed[host, inside, branch].add(tag)
        for key in {x[:3] for x in leaves}:
            seen[(host, *key, "pages")].append(1)

    def faint(*key):
        texts, m = seen[key], len(seen[(*key, "pages")])
        if m < least:
            return False
        entropy = sum(c * math.log(c) for c in Counter(texts).values()) / len(texts) / math.log(max(m, 2))
        return html_text.GAMMA * (1 - entropy) + (1 - html_text.GAMMA) * key[1] < low

    def stays(host, inside, branch, tag, marked):
        if inside or not marked:
            mine = placed[host, inside, branch]
            return not branch or not (all(faint(host, inside, branch, t) for t in mine) and any(t[0] != "h" for t in mine))
        return len(seen[host, inside, branch, tag, "pages"]) >= least and not faint(host, inside, branch, tag)

    out = []
    for host, groups in sites:
        marked = any(blocks for outside, blocks in groups if not outside)
        every = [(not o, b, t, x) for o, blocks in groups for b, t, x in blocks]
        kept = [x for i, b, t, x in every if stays(host, i, b, t, marked)]
        out.append("\n\n".join(kept or [x for i, _, _, x in every if i]))
    return out


def test_extract_equals_brute_force(spark):
    rng = random.Random(8)
    sites = []
    for k in range(120):
        host = rng.choice(["a.example", "b.example", "few.example"] if k > 100 else ["a.example", "b.example"])
        groups = []
        for outside in rng.choice([[True], [False], [True, False], [True, False, True]]):
            blocks = [(rng.choice(["", "one", "two", "three"]), rng.choice(["p", "h2", "blockquote"])) for _ in range(rng.randint(0, 4))]
            groups.append((outside, [(b, t, rng.choice([f"Same {b or 'it'}", f"Same {b or 'it'}", f"Either {rng.randint(0, 1)}"]) if b in ("one", "two")
                                      or t == "h2" else f"Own {k} {rng.randint(0, 99)}") for b, t in blocks]))
        sites += [(host, groups)] * rng.choice([1, 1, 1, 3])

    def html_of(groups):
        def block(b, t, x):
            return f"<div class='{b}'><{t}>{x}</{t}></div>" if b else f"<{t}>{x}</{t}>"
        return "<body>" + "".join(("<main>{}</main>" if not o else "{}").format("".join(block(*x) for x in blocks))
                                  for o, blocks in groups) + "</body>"
    got = text_of(spark, [(f"http://{h}/{k}", html_of(g)) for k, (h, g) in enumerate(sites)])
    want = brute_extract(sites, html_text.LOW, html_text.MIN_PAGES)
    assert [got[k] for k in range(len(sites))] == want
    assert sum(len(w) < sum(len(x) + 2 for _, bs in g for *_, x in bs) - 2 for w, (_, g) in zip(want, sites, strict=True)) > 10


def test_a_branch_above_text_of_its_own_stays(spark):
    """What pages repeat in a branch stays where a branch below it has text of its own."""
    def page(k):
        return (f"http://deep.example/{k}", "<body><div class=content><p>By our staff</p><ul class=list><li class=x><div class=body>"
                f"<p>own text {k}</p></div></li></ul></div><div class=end><p>Terms</p><div class=more><p>Privacy</p></div></div></body>")
    got = text_of(spark, [page(k) for k in range(20)])
    assert all(got[k] == f"By our staff\n\nown text {k}" for k in range(20))


def test_a_branch_that_pages_lay_out_in_their_own_ways_stays(spark):
    """Repeated leaves, but another choice of them on every page: the layouts are of importance."""
    def page(k):
        picks = "".join(f"<p class=f{j}>Feature {j}</p>" for j in range(6) if (k + 1) >> j & 1)
        return f"http://picks.example/{k}", f"<body><div class=picks>{picks}</div><div class=end>Terms</div><p>own {k}</p></body>"
    got = text_of(spark, [page(k) for k in range(60)])
    for k in range(60):
        assert got[k].split("\n\n") == [*(f"Feature {j}" for j in range(6) if (k + 1) >> j & 1), f"own {k}"]


def test_composite_importance_equals_recursion(spark):
    rng = random.Random(4)
    above = {k: rng.randrange(k) for k in range(1, 14)}  # branch 0 is the root
    pages = []
    for _ in range(12):
        for b in range(14):
            children = [(f"b{c}", False) for c, up in above.items() if up == b] + [(f"l{b}{j}", True) for j in range(3)]
            kept = [c for c in children if not c[1] or rng.random() < 0.7] or children[-1:]
            pages.append((b, html_text._shares(html_text.Layout(b, f"b{b}", False, f"b{above[b]}" if b else "", kept))))
    leaves = {f"l{b}{j}": rng.random() for b in range(14) for j in range(3)}
    df = spark.createDataFrame([("h", [a]) for _, a in pages], "host string, " + html_text.LAYOUTS).selectExpr("host", "inline(layouts)")
    known = spark.createDataFrame([("h", k, False, v) for k, v in leaves.items()], "host string, path string, inside boolean, importance double")
    got = {r["path"]: r for r in html_text.composite(Scratch(spark), df, known).collect()}

    def want(b):
        mine = [a for k, a in pages if k == b]
        n = Counter(a["h"] for a in mine)
        entropy = -sum(c / len(mine) * math.log(c / len(mine), len(mine)) for c in n.values())
        below = {f"b{c}": want(c) for c, up in above.items() if up == b}
        mean = sum(x["share"] * (leaves[x["path"]] if x["leaf"] else below[x["path"]][0]) for a in mine for x in a["children"]) / len(mine)
        less = html_text.GAMMA ** len(n)
        value = (1 - less) * entropy + less * mean
        return value, max([value, *(v[1] for v in below.values()), *(leaves[x["path"]] for a in mine for x in a["children"] if x["leaf"])])

    assert len(got) == 14
    for b in range(14):
        assert (got[f"b{b}"]["importance"], got[f"b{b}"]["highest"]) == pytest.approx(want(b))


def test_clashing_columns_of_pages(spark):
    df = spark.createDataFrame([(1, "http://h/", "<p>a", "x", [1], 2)], PAGE_SCHEMA + ", text string, blocks array<int>, key int")
    assert [tuple(r) for r in html_text.extract(df).collect()] == [(1, "http://h/", "a")]


def test_repeated_and_null_ids_are_pages_of_their_own(spark):
    df = spark.createDataFrame([(1, "u", "<p>a"), (1, "u", "<p>b"), (None, "u", "<p>c")], PAGE_SCHEMA)
    assert sorted(r["text"] for r in html_text.extract(df).collect()) == ["a", "b", "c"]
    assert html_text.extract(df.where("page_id > 5")).count() == 0


# ---- licences

def test_licences_and_inheritance(spark):
    files = [
        (1, "a/LICENSE", "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy "
                         "of this software and associated documentation files"),
        (2, "a/b/c/x.py", "print(1)"), (3, "a/b/LICENSE.txt", "Licensed under the Apache License, Version 2.0.\n" + "x " * 99),
        (4, "a/b/y.py", "# Released under the MIT License.\ncode"), (5, "z.py", "no word"), (6, "q/r.py", None),
        (7, None, "Licensed under CC BY 4.0."), (8, "q/s/t", "Licensed under CC BY-SA 4.0."), (9, "q/s/u/v", "x"),
        (10, "ab/x", ""), (11, "k/n", "to licence or not to licence, that is no header of ours at all, dear reader")]
    df = spark.createDataFrame([(*f, 0.5) for f in files] + [(*files[1], 0.5)],
                               "doc_id long, path string, text string, score double")
    rows = licenses.scan(df).collect()
    assert len(rows) == 12
    got = {r["doc_id"]: (r["own_license"], r["license"], r["license_dir"]) for r in rows}
    assert got[1] == ("MIT", "MIT", None)
    assert got[2] == (None, "Apache-2.0", "a/b")
    assert got[4] == ("MIT", "MIT", None)
    assert got[5] == got[6] == got[10] == got[11] == (None, None, None)
    assert got[7] == ("CC-BY-4.0", "CC-BY-4.0", None)
    assert got[9] == (None, "CC-BY-SA-4.0", "q/s")
    assert licenses.scan(df.where("doc_id < 0")).count() == 0


def test_licence_cosine_matches_brute_force(spark):
    texts = ["Released under the MIT License.", "x\nThis is Released under the Apache License today", None, "copyright me",
             "Licensed under CC BY-NC 4.0. All rights reserved."]
    df = spark.createDataFrame([(k, f"d{k}/f", t) for k, t in enumerate(texts)], "doc_id long, path string, text string")
    idf = licenses.inverse_frequency(df)
    for r in licenses.scan(df, threshold=0.0).collect():
        best = 0.0
        for line in (texts[r["doc_id"]] or "").split("\n"):
            own = {t: licenses.terms(line).count(t) * idf.get(t, idf[""]) for t in licenses.terms(line)}
            if not __import__("re").search(licenses.MARK, line):
                continue
            for _, t in licenses.TEMPLATES:
                w = {x: licenses.terms(t).count(x) * idf[x] for x in licenses.terms(t)}
                dot = sum(w[x] * own.get(x, 0) for x in w)
                best = max(best, dot / math.sqrt(sum(x * x for x in w.values()) * sum(x * x for x in own.values())))
        assert r["score"] == pytest.approx(best, abs=1e-8)


def test_repeated_rows_do_not_raise_the_coverage(spark):
    body = "Released under the MIT License.\n" + "word " * 7  # 5 of 12 terms: no licence file
    df = spark.createDataFrame([(1, "p/x.txt", body), (1, "p/x.txt", body), (2, "p/y.txt", "plain")],
                               "doc_id long, path string, text string")
    got = sorted((r["doc_id"], r["own_license"], r["license"]) for r in licenses.scan(df).collect())
    assert got == [(1, "MIT", "MIT"), (1, "MIT", "MIT"), (2, None, None)]


BESIDE = ["Copyright 2021 Acme Inc. Licensed under the Apache License, Version 2.0.",
          "This article is licensed under CC BY-SA 4.0, see the footer."]


def test_words_beside_a_statement_do_not_sink_it_at_any_size(spark, monkeypatch):
    files = [(k, f"d{k}/f", t) for k, t in enumerate([*BESIDE, "w " * 300 + BESIDE[0] + " v" * 300, "licensed under x 4.0"])]
    df = spark.createDataFrame(files, "doc_id long, path string, text string")
    for n in (10 ** 3, 10 ** 8):  # a licence term in 1 % of the files
        idf = {t: math.log((n + 1) / (n // 100 + 1)) + 1 for t in licenses.VOCABULARY} | {"": math.log(n + 1) + 1}
        monkeypatch.setattr(licenses, "inverse_frequency", lambda *_, idf=idf: idf)
        got = {r["doc_id"]: r["own_license"] for r in licenses.scan(df).collect()}
        assert got == {0: "Apache-2.0", 1: "CC-BY-SA-4.0", 2: "Apache-2.0", 3: None}, n


GPL = """# This file is part of it. It is free software; you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation; either version {} of the License, or
# (at your option) any later version."""


def test_headers_wrapped_in_one_line_and_as_tags(spark):
    bsd = licenses._BSD.replace(". ", ".\n").replace(", ", ",\n * ")
    cases = [("// SPDX-License-Identifier: MIT\nint x;", "MIT"), ("# SPDX-License-Identifier: Apache-2.0", "Apache-2.0"),
             ("SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0"), ("SPDX-License-Identifier: FooBar-1.0", None),
             (GPL.format(2), "GPL-2.0"), (GPL.format(3), "GPL-3.0"), ("code " * 400 + GPL.format(2).replace("\n#", "") + " more" * 400, "GPL-2.0"),
             ("modify it under the terms of the GNU\nLesser General Public License as published", None),
             (bsd, "BSD-2-Clause"), (bsd + licenses._NO_NAME, "BSD-3-Clause"),
             ("made available under the\nterms of the Eclipse Public License 2.0. This program and the accompanying materials are\n"
              "made available under the terms of the\nEclipse Public License 2.0", "EPL-2.0"),
             ("GNU GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007\n\n Everyone is permitted", "GPL-3.0"),
             ("free software: you can redistribute it under our licence", None)]
    df = spark.createDataFrame([(k, f"d{k}/f.c", t) for k, (t, _) in enumerate(cases)], "doc_id long, path string, text string")
    got = {r["doc_id"]: r["own_license"] for r in licenses.scan(df).collect()}
    assert got == {k: want for k, (_, want) in enumerate(cases)}


# ---- fingerprints

def brute_edited(rows):
    order = sorted(rows, key=lambda r: (-r[0], r[1] or ""))
    for k, (key, text) in enumerate(order):
        text, nxt = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        yield key, text, text[:len(text) - half] + nxt[:half], nxt


def test_edited_texts_and_likeness(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    got = {r["doc_id"]: r for r in fingerprints.fingerprint_documents(docs).collect()}

    def sh(t):
        w = t.lower().split()
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    off = []
    for key, text, edited, nxt in brute_edited(rows):
        r = got[key]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        for name, other in (("near_edited", edited), ("near_next", nxt)):
            a, b = sh(text), sh(other)
            off.append(r[name] - (len(a & b) / len(a | b) if a | b else 1.0))
    assert abs(sum(off) / len(off)) < 0.02 and max(map(abs, off)) < 0.2


def test_odd_fingerprints(spark):
    texts = [None, "", " \n", "a", "A", "a b c d", "a b c d e", "中文 é " * 40, "one two three four five six " * 30]
    rows = list(enumerate(texts)) + [(8, texts[8]), (20, "a")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, fingerprint string, n_chars int")
    out = fingerprints.fingerprint_documents(df).collect()
    assert len(out) == len(rows)
    by = {r["doc_id"]: r["fingerprint"] for r in out}
    assert by[0] == by[1] == by[2] == "" and by[3] == by[4] == by[20] and by[5] != by[6]
    assert all(len(f) in (0, fingerprints.BINS) and 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
               for r in out for f in (r["fingerprint"], r["edited_fingerprint"]))
    want = sorted(hashlib.sha256(e.encode()).hexdigest() for _, _, e, _ in brute_edited(rows))
    assert sorted(r["edited_sha256"] for r in out) == want
    one = fingerprints.fingerprint_documents(df.where("doc_id = 5")).first()
    assert one["near_next"] == 1.0
    assert fingerprints.fingerprint_documents(df.where("doc_id < 0")).count() == 0
    none = spark.createDataFrame([(None, "p q"), (None, None), (4, "r s t")], "doc_id long, text string")
    assert fingerprints.fingerprint_documents(none).count() == 3


def test_ranges_of_ids_keep_the_order(spark):
    ids = random.Random(6).sample(range(-500, 5000), 700)
    df = spark.createDataFrame([(k, f"text of number {k}") for k in ids], "doc_id long, text string").repartition(5)
    rows = fingerprints.with_next(df, Scratch(spark), "doc_id", "text", range_rows=13).collect()
    order = sorted(ids, reverse=True)
    want = {k: order[(i + 1) % len(order)] for i, k in enumerate(order)}
    assert {r["id"]: int(r["next_text"].split()[-1]) for r in rows} == want


def test_empty_bins_borrow_from_the_first_filled_on_their_walk(spark):
    rnd = random.Random(8)
    texts = ["", " ", "one", "a b c d", "a b c d e", "ab " * 900, "x y " * 700]
    texts += [" ".join(rnd.choices("abcdefghijklmnopq", k=n)) for n in (5, 6, 9, 14, 18, 19, 20, 21, 24, 40, 90, 300, 3000)]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, text string")
    rows = fingerprints.with_fingerprint(df.withColumn("h", fingerprints.shingle_hashes(F.col("text"))), "text", "fp").withColumn(
        "in_one", fingerprints.fingerprint(F.col("text"))).collect()
    bins, low = fingerprints.BINS, fingerprints._LOW
    pairs = []
    for r in rows:
        least = {}
        for x in sorted(r["h"], reverse=True):
            least[(x >> low) + bins // 2] = x & fingerprints._EMPTY
        for b in range(bins if least else 0):
            walk = [b, *((fingerprints._START[b] + t * fingerprints._STRIDE[b]) % bins for t in range(bins))]
            pairs.append((r["k"], b, least[next(w for w in walk if w in least)]))
    digits = spark.createDataFrame(pairs, "k long, b int, x long").select("k", "b", F.xxhash64("x", "b").bitwiseAND(F.lit(15)).alias("d"))
    want = {k: "" for k in range(len(texts))}
    for k, _, d in sorted(map(tuple, digits.collect())):
        want[k] += f"{d:x}"
    assert {r["k"]: r["fp"] for r in rows} == want == {r["k"]: r["in_one"] for r in rows}


def test_likeness_counts_equal_digits(spark):
    rnd = random.Random(9)
    a = "".join(rnd.choices("0123456789abcdef", k=256))
    cases = [(a, a), ("", ""), ("", a), (a, ""), ("0" * 256, "f" * 256), ("80" * 128, "7f" * 128), ("f" * 256, "e" * 256), (
        "8" + "0" * 255, "0" * 256)] + [(a, "".join(x if rnd.random() < p else rnd.choice("0123456789abcdef") for x in a)) for p in (0.1, 0.5, 0.9)]
    got = spark.createDataFrame([(k, *c) for k, c in enumerate(cases)], "k int, a string, b string").select(
        "k", fingerprints.likeness(F.col("a"), F.col("b")).alias("x")).collect()
    for k, x in got:
        a, b = cases[k]
        same = sum(i == j for i, j in zip(a, b)) / 256
        assert x == (1.0 if a == b else 0.0 if not a or not b else max(0.0, (same - 1 / 16) / (1 - 1 / 16)))


def test_short_texts_cost_no_more_than_long_ones(spark):
    """Most bins of a short text are empty; laying out a whole walk for each made it cost more than a long text."""
    words = [f"w{k}" for k in range(2100)]

    def seconds(n):
        df = spark.createDataFrame([(i, " ".join(words[i % 50:i % 50 + n])) for i in range(600)], "k long, text string").coalesce(1).cache()
        df.count()
        out, best = df.select(fingerprints.fingerprint(F.col("text"))), []
        for _ in range(3):
            began = time.perf_counter()
            out.write.format("noop").mode("overwrite").save()
            best.append(time.perf_counter() - began)
        df.unpersist()
        return min(best)

    assert seconds(24) < seconds(2000)
