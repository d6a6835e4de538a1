"""Benchmark matching, boilerplate lines, quality rules, toxicity and page texts."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_data import documents, edited, empty, rows, sentence, texts

from pyspark.sql import functions as F

from shelfdiff.llm import decontaminate, html_paths, line_spread, quality, toxicity


def word_distance(a, b):
    """Least edits that turn all of `a` into some run of words of `b`."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_bit_parallel_distance_equals_the_table():
    r = random.Random(0)
    for _ in range(300):
        a = [r.randrange(4) for _ in range(r.randint(1, 90))]
        b = [r.randrange(4) for _ in range(r.randint(1, 60))]
        distance, _ = decontaminate.ends(decontaminate._masks(a), len(a), b, len(a))
        assert distance == min(word_distance(a, b), len(a))


def bench(spark):
    r = random.Random(8)
    items = [sentence(r, n) for n in (30, 12, 45, 8)]
    table = [*enumerate(items), (2, items[2]), (10, None), (11, ""), (12, "too short"), (None, items[0])]
    return items, spark.createDataFrame([(i, t, 5) for i, t in table], "item_id long, text string, doc_id long")


def test_matches_equal_brute_force(spark):
    items, table = bench(spark)
    r = random.Random(9)
    data = []
    for i in range(80):
        item = items[i % 4]
        inside = edited(item, i, i % 8).upper() if i % 3 else sentence(r, 20)
        data.append((i, f"{sentence(r, r.randint(0, 30))} {inside}, {sentence(r, r.randint(0, 30))}".strip()))
    docs = spark.createDataFrame(data, "doc_id long, text string")
    got = {(m.doc_id, m.item_id): (m.distance, m.start_word, m.end_word) for m in decontaminate.find_matches(docs, table, block_items=2).collect()}
    for i, text in data:
        for k, item in enumerate(items):
            a, b = decontaminate.normal_hashes(item).tolist(), decontaminate.normal_hashes(text).tolist()
            budget = min(int(decontaminate.RATE * len(a)), len(a) // decontaminate.PROBE - 1)
            distance = word_distance(a, b)
            assert ((i, k) in got) == (distance <= budget)
            if distance <= budget:
                found, lo, hi = got[i, k]
                assert found == distance == word_distance(a, b[lo:hi])
    clean = decontaminate.remove_contaminated(docs, table)
    assert {x.doc_id for x in clean.collect()} == {i for i, _ in data} - {i for i, _ in got}


def test_decontamination_of_awkward_rows(spark):
    _, table = bench(spark)
    assert decontaminate.find_matches(documents(spark), table).count() == 0
    kept = decontaminate.remove_contaminated(documents(spark), table)
    assert kept.count() == len(rows()) and kept.columns == documents(spark).columns
    assert decontaminate.find_matches(empty(spark), table).count() == 0
    assert decontaminate.find_matches(documents(spark), table.limit(0)).count() == 0


def boilerplate(spark):
    r = random.Random(4)
    copied = "\n".join(sentence(r, 9) for _ in range(4))
    data = []
    for i in range(40):
        lines = [sentence(r, 8) for _ in range(3)]
        if i % 2:
            lines.insert(r.randint(0, 3), " All rights reserved.\t")
        if i % 4 == 0:
            lines.append(f"only on few {i % 3}")
        data.append((i, "\n".join(lines), f"s{i % 16}"))
    # A document that was copied to twelve sites is no boilerplate.
    data += [(100 + i, copied, f"s{i}") for i in range(12)]
    data += [(200, None, "s1"), (201, "", None), (202, "All rights reserved.", None)]
    return data, spark.createDataFrame([(*x, 1, 2) for x in data], "doc_id long, text string, source string, line int, sketch int")


@pytest.mark.parametrize("min_sites, max_literals", [(8, 5000), (8, 0), (9, 5000)])
def test_boilerplate_lines(spark, min_sites, max_literals):
    data, docs = boilerplate(spark)
    lines = line_spread.spread_lines(docs, min_sites=min_sites)
    got = {x.doc_id: x.text for x in line_spread.remove_lines(docs, lines, max_literals=max_literals).collect()}
    # The line is on the eight odd sites, and on a nameless one.
    gone = "All rights reserved."
    expected = {
        i: t if t is None else "\n".join(x for x in t.split("\n") if x.strip() != gone) for i, t, _ in data
    }
    assert got == expected
    assert line_spread.dedup_lines(docs, min_sites=min_sites).columns == docs.columns


def test_blocks_go_whatever_stands_around_and_copies_stay(spark):
    r = random.Random(14)
    head, foot = ["Home - About - Contact", "Menu"], ["Terms of use", "Privacy", "(c) the owner"]
    shared = [sentence(r, 12) for _ in range(12)]
    data, expected = [], {}
    for i in range(60):
        own = [sentence(r, 15) for _ in range(4)]
        gap = "\n\n" if i % 2 else "\n"
        data.append((i, gap.join([*head, *own, *foot]), f"s{i % 20}"))
        expected[i] = [x for x in gap.join(own).split("\n") if x]
    for i in range(100, 160):  # near copies on many sites, each with a word of its own
        lines = [*shared[:5], f"{shared[5]} {i}", *shared[6:]]
        data.append((i, "\n".join([*lines, foot[1]]), f"s{i % 20}"))
        expected[i] = lines
    docs = spark.createDataFrame(data, "doc_id long, text string, source string").repartition(3)
    got = {x.doc_id: [y for y in x.text.split("\n") if y] for x in line_spread.dedup_lines(docs).collect()}
    assert got == expected


def test_boilerplate_of_awkward_rows(spark):
    assert line_spread.dedup_lines(documents(spark)).count() == len(rows())
    assert line_spread.dedup_lines(empty(spark)).count() == 0
    assert line_spread.spread_lines(documents(spark), min_sites=50).count() == 0


def base_counts(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {i + k for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_quality_counts_and_verdicts(spark):
    r = random.Random(6)
    odd = ["a b c d e f " * 20, "x y\nx y\nx y z w v u\n" * 3, "### $$$ " * 30, "a b c d e a b c d e", "w" * 5000]
    data = [(i, t, "en", "s") for i, t in enumerate([*texts(2, 80), *odd, None, "", " \n"])]
    data += [(500 + i, sentence(r, 50), None, None) for i in range(3)]
    docs = spark.createDataFrame([(*x, 0, 0.0) for x in data], "doc_id long, text string, lang string, source string, n_words int, n_docs double")
    got = {x.doc_id: x for x in quality.judge(docs).collect()}
    assert len(got) == len(data)
    for i, t, *_ in data:
        x, exp = got[i], base_counts(t)
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == exp
        assert x.base_failed == (exp[0] < 10 or 100 * exp[4] > 20 * exp[0])
        assert not (x.base_failed and x.kept)
    assert all(got[i].kept == (not got[i].base_failed) for i in range(80))
    assert not got[82].kept and not got[85].kept
    assert all(got[500 + i].kept for i in range(3))


def test_quality_of_awkward_rows(spark):
    assert quality.judge(documents(spark)).count() == len(rows())
    assert quality.judge(empty(spark)).count() == 0


def toxic_tables(spark):
    data, marks = [], []
    r = random.Random(1)
    for i, t in enumerate(texts(7, 400)):
        bad = i % 8 == 0
        data.append((i, t + (f" {r.choice(['bloxxer', 'Bloxxing,', 'QUOZZLE!'])}" * 2 if bad else "")))
        if i % 3 == 0:
            marks.append((i, int(bad), "x"))
    data += [(900, None), (901, ""), (3, data[3][1])]
    labels = [*marks, (999, 1, "x"), (None, 1, "x"), (5, None, "x")]
    return (
        data,
        spark.createDataFrame(data, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, toxic int, text string"),
    )


def test_toxicity_on_rows_held_out(spark):
    data, docs, labels = toxic_tables(spark)
    weights = toxicity.fit(docs, labels, learn=F.col("doc_id") % 5 != 0, classifiers=2)
    got = [(x.doc_id, x.score) for x in toxicity.scored(docs, weights).collect()]
    assert len(got) == len(data) and all(0 <= s <= 1 for _, s in got)
    held = [(s >= 0.5) == (i % 8 == 0) for i, s in got if i < 900 and i % 5 == 0]
    assert np.mean(held) > 0.95
    assert {s for i, s in got if i in (900, 901)} == {0.0}
    kept = {x.doc_id for x in toxicity.remove_toxic(docs, weights).collect()}
    assert kept == {i for i, s in got if s < 0.5}


def test_toxicity_without_labels(spark):
    _, docs, labels = toxic_tables(spark)
    for some in (labels.limit(0), labels.filter("toxic = 0")):
        weights = toxicity.fit(docs, some)
        assert {x.score for x in toxicity.scored(docs, weights).collect()} == {0.0}
    assert toxicity.scored(empty(spark), weights).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="<p>no</p>";</script></head><body>
<header><h2>Site</h2></header><div class="menu2"><a href=/>Home</a></div>
<div class="post-{n}"><h1>Head &amp; {n}</h1><p>First   line<br>goes
on <b>bold</b>word<p>Second <a href="x>y">link</a>.<form><p>no</form><aside>no</aside>
<ul><li>one<li>two</ul><div class="ad box">no</div><div id=comments><p>no</p></div></div>
<div class="sidebar"><p>{long}</p></div><footer><p>no</p></footer></body></html>"""


def test_page_text_by_the_path_of_its_host(spark):
    wanted = "Head & {n}\nFirst line goes on boldword\nSecond link.\none\ntwo"
    data = [(i, f"https://Host.example/{i}", PAGE.replace("{n}", str(i)).replace("{long}", "x " * i * 20)) for i in range(12)]
    data += [(100, None, PAGE), (101, "no url", None), (102, "https://host.example/e", ""), (103, "https://host.example/b", "<p>a &lt; b<table><td>c")]
    data += [data[0]]
    pages = spark.createDataFrame([(*x, "q", 1) for x in data], "page_id long, url string, html string, host string, path int")
    out = html_paths.main_text(pages).collect()
    assert len(out) == len(data)
    got = {x.page_id: x.text for x in out}
    assert all(got[i] == wanted.replace("{n}", str(i)) for i in range(12))
    assert got[101] == got[102] == "" and got[103] == "a < b\nc"
    assert all(x.n_chars == len(x.text) for x in out)
    assert html_paths.main_text(pages.limit(0)).count() == 0


def test_broken_and_deep_markup():
    for source in ("", "<", "</", "<p", "<!-- ", "<script>", "x<b>y</p></b>", "<div>" * 5000 + "x"):
        html_paths.extract(html_paths.parse(source), None)
    assert html_paths.extract(html_paths.parse("<div>" * 5000 + "x"), None) == "x"


@pytest.mark.parametrize(
    "opened, closed",
    [
        ('<div class="layout has-sidebar"><article>', "</article></div>"),
        ('<div class="no-comments">', "</div>"),
        ('<article class="post with-sidebar">', "</article>"),
        ('<div id="content-widget">', "</div>"),
        ('<div class="widget"><div class="overlay"><article>', "</article></div></div>"),
        ('<article><section class="related-work">', "</section></article>"),
        ('<article><div class="social">', "</div></article>"),
        ('<main><section class="legal">', "</section></main>"),
    ],
)
def test_wrappers_and_sections_named_like_asides(opened, closed):
    long = "One line of the article that says something. " * 5
    aside = '<div class="sidebar"><p>no</p></div><div class="comments"><article class="comment"><p>no no</p></article></div>'
    page = f"<body>{opened}<p>{long}</p><div class='ad'>no</div><div class='share'><a href=x>no</a></div>{closed}{aside}</body>"
    assert html_paths.extract(html_paths.parse(page), None) == long.strip()


def test_comments_with_articles_stay_aside():
    page = "<div class=post><p>{}</p></div><div class=comments><article><p>no no</p></article></div>".format("yes " * 9)
    assert html_paths.extract(html_paths.parse(page), None) == ("yes " * 9).strip()


def test_formulas_and_fallbacks_of_an_article():
    inner = "<p>So <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds.</p><noscript><p>Plain.</p></noscript><object><p>Table.</p></object>"
    page = f"<noscript>no</noscript><article>{inner}<svg><title>no</title><path d=x /><text>Axis</text></svg></article>"
    assert html_paths.extract(html_paths.parse(page), None) == "So x=1 holds.\nPlain.\nTable.\nAxis"


def test_short_items_match_exactly(spark):
    items = [(1, "What is it?"), (2, "one two three four five six seven"), (3, "what"), (4, "-- ?"), (5, " ")]
    data = [(1, "So, WHAT is it"), (2, "what is, that it"), (3, "zero one two three four five six seven"), (4, "one two three four six seven"), (5, "?")]
    table = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame(data, "doc_id long, text string")
    got = {(x.doc_id, x.item_id, x.distance, x.start_word, x.end_word) for x in decontaminate.find_matches(docs, table).collect()}
    assert got == {(1, 1, 0, 1, 4), (1, 3, 0, 1, 2), (2, 3, 0, 0, 1), (3, 2, 0, 1, 8)}
    assert {x.doc_id for x in decontaminate.remove_contaminated(docs, table).collect()} == {4, 5}


def test_blocks_are_bounded_by_their_words(spark):
    long = " ".join(f"w{k}" for k in range(decontaminate.ITEM_WORDS * 3))
    table = spark.createDataFrame([(i, f"x{i} {long}") for i in range(8)], "item_id long, text string")
    rules = {"rate": 0.2, "probe": 4, "min_words": 8}
    blocks = list(decontaminate._blocks(table, "item_id", "text", 8, **rules))
    assert len(blocks) > 2 and sum(len(b.items) for b in blocks) == 8
