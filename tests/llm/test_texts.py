"""Decontamination, near copies, quality, tokens and pages against brute force."""
import hashlib
import html as entities
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import AWKWARD, SMALL, frame
from tidepanel.llm import (binary_files, common, decontaminate, html_samples, html_text, near_copies,
                           quality, token_counts, token_files, warc)

WORD = re.compile(r"[^\W_]+")


def distance(a, b, anywhere=False):
    """Edit distance; `anywhere`: of a to its best place in b, with that place's end."""
    column = list(range(len(a) + 1))
    best = (column[-1], 0)
    for j, y in enumerate(b, 1):
        new = [0 if anywhere else j]
        for i, x in enumerate(a, 1):
            new.append(min(column[i - 1] + (x != y), column[i] + 1, new[-1] + 1))
        column = new
        best = min(best, (column[-1], j))
    return best if anywhere else column[-1]


letters = st.lists(st.sampled_from("abcd"), max_size=30)


@settings(max_examples=200, deadline=None)
@given(letters.filter(bool), letters)
def test_least_distance(pattern, text):
    got = decontaminate.least_distance(pattern, text, len(pattern))
    want = distance(pattern, text, anywhere=True)
    assert got == (want if want[1] else got)


@settings(max_examples=300, deadline=None)
@given(letters, letters, st.integers(0, 12))
def test_banded_distance(a, b, most):
    assert near_copies.banded_distance(a, b, most) == min(distance(a, b), most + 1)


def test_decontaminate(shipped, awkward, nothing, small_docs):
    benchmark = shipped.read.parquet(f"{SMALL}/benchmark.parquet")
    items = {r.item_id: WORD.findall(r.text.lower()) for r in benchmark.collect()}
    some = list(items.values())[0]
    changed = [*some[:3], "changed", *some[4:]] if len(some) >= 10 else some
    extra = [(900_000, "Before it. " + " ".join(changed) + " after it"),
             (900_001, "Before it. " + " ".join(some[:len(some) // 2])), (900_002, None)]
    docs = small_docs.select("doc_id", "text").unionByName(
        frame(shipped, extra).select("doc_id", "text"))
    want = set()
    for r in docs.collect():
        words = WORD.findall((r.text or "").lower())
        for key, pattern in items.items():
            if set(pattern) & set(words):
                got = distance(pattern, words, anywhere=True)
                if got[0] <= int(0.1 * len(pattern)):
                    want.add((r.doc_id, key, *got))
    for block in (1_000_000, 2_000):  # one block of items, and several
        found = decontaminate.find_items(docs, benchmark, block_bytes=block).collect()
        assert {tuple(r) for r in found} == want and len(found) == len(want)
    clean = decontaminate.drop_contaminated(docs, benchmark, block_bytes=4_000)
    assert {r.doc_id for r in clean.collect()} == {
        r.doc_id for r in docs.collect()} - {x[0] for x in want}
    kept = decontaminate.drop_contaminated(awkward, benchmark)
    assert kept.columns == awkward.columns and kept.count() == len(AWKWARD)
    for b in (shipped.createDataFrame([], "item_id long, text string"),
              shipped.createDataFrame([(1, None), (None, "")], "item_id long, text string")):
        assert decontaminate.find_items(awkward, b).count() == 0
        assert decontaminate.drop_contaminated(awkward, b).count() == len(AWKWARD)
    assert decontaminate.find_items(nothing, benchmark).count() == 0


def brute_classes(docs):
    words = {i: WORD.findall((t or "").lower()) for i, t in docs if i is not None}
    parent = {i: i for i in words}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(words)
    bags = {i: set(w) for i, w in words.items()}
    for n, i in enumerate(ids):
        for j in ids[:n]:
            a, b = words[i], words[j]
            longest = max(len(a), len(b))
            if root(i) == root(j) or 5 * (longest - min(len(a), len(b))) > longest or (
                    longest and 5 * len(bags[i] & bags[j]) < len(bags[i])):
                continue
            if a == b or near_copies.near(*(np.array([zlib.crc32(x.encode()) for x in w], dtype=int)
                                            for w in (a, b))):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return {i: root(i) for i in words}


def test_near_classes_of_small_documents(small_docs):
    rows = near_copies.near_classes(small_docs).collect()
    want = brute_classes([(r.doc_id, r.text) for r in small_docs.collect()])
    assert {r.doc_id: r.class_id for r in rows} == want
    kept = near_copies.keep_one_each(small_docs)
    assert kept.columns == small_docs.columns
    assert {r.doc_id for r in kept.collect()} == set(want.values())


def test_near_classes_of_awkward_rows(awkward, nothing):
    rows = near_copies.near_classes(awkward).collect()
    want = brute_classes(AWKWARD)
    assert {r.doc_id: r.class_id for r in rows if r.doc_id is not None} == want
    assert [r.kept for r in rows if r.doc_id is None] == [True]
    assert len(rows) == len(AWKWARD)
    assert near_copies.near_classes(nothing).count() == 0
    assert near_copies.keep_one_each(awkward).columns == awkward.columns


def test_near_copies_in_a_crowd(shipped):
    """A large group of near copies, and texts that share one passage only."""
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    base = list(rng.choice(vocabulary, 200))
    passage = list(rng.choice(vocabulary, 60))
    docs = []
    for i in range(120):
        copy = list(base)
        for at in rng.integers(0, 200, 3):
            copy[at] = f"new{i}"
        docs.append((i, " ".join(copy)))
    for i in range(200, 280):
        docs.append((i, " ".join([*rng.choice(vocabulary, 90), *passage,
                                  *rng.choice(vocabulary, 60)])))
    rows = {r.doc_id: r.class_id for r in near_copies.near_classes(frame(shipped, docs)).collect()}
    assert all(rows[i] == 0 for i in range(120))
    assert all(rows[i] == i for i in range(200, 280))


def test_near_pairs_inside_a_passage_crowd(shipped):
    """All texts share most of their words; only each pair is near."""
    rng = np.random.default_rng(8)
    passage = [f"p{i}" for i in range(150)]
    docs = []
    for i in range(60):
        own = [f"a{i}x{j}" for j in rng.permutation(45)]
        docs.append((2 * i, " ".join([*passage, *own])))
        docs.append((2 * i + 1, " ".join([*passage, *[f"{w}y" for w in own[:36]], *own[36:]])))
    rows = {r.doc_id: r.class_id for r in near_copies.near_classes(frame(shipped, docs)).collect()}
    assert rows == {i: i - i % 2 for i, _ in docs}


def test_recall_in_a_large_crowd(shipped):
    """2,000 texts of one passage; each is near one other, by edits anywhere."""
    rng = np.random.default_rng(4)
    passage = [f"p{i}" for i in range(150)]
    docs, want = [], set()
    for i in range(1000):
        text = [*passage, *[f"a{i}x{j}" for j in rng.permutation(45)]]
        copy = list(text)
        for at in rng.choice(len(text), rng.integers(1, 40), replace=False):
            copy[at] = f"new{i}x{at}"
        docs += [(2 * i, " ".join(text)), (2 * i + 1, " ".join(copy))]
        if distance(text, copy) <= int(0.2 * 195):
            want.add(i)
    rows = {r.doc_id: r.class_id for r in near_copies.near_classes(frame(shipped, docs)).collect()}
    found = {i for i in range(1000) if rows[2 * i] == rows[2 * i + 1]}
    assert len(want) > 900 and len(found & want) >= 0.9 * len(want), (len(found & want), len(want))
    # two texts of different pairs differ in at least 45 of 195 words
    assert len(set(rows.values())) == 2000 - len(found)


def test_kmers_set_aside_by_a_join(shipped, monkeypatch):
    """More k-mers than every task gets: the same keys from a join."""
    passage = " ".join(f"p{i}" for i in range(80))
    docs = frame(shipped, [(i, f"{passage} " + " ".join(f"a{i}x{j}" for j in range(20 * (i % 3) + 4)))
                           for i in range(12)] + [(20, "two words"), (21, None)])
    texts = near_copies.sketch_documents(docs, 4, 1).select(
        near_copies.F.col("doc_id").alias("id"), "digest")
    aside = near_copies.with_words(docs).where("doc_id < 2")
    aside = near_copies.per_text(aside, {"keys": lambda w: near_copies.kmers(w).view(np.int64)}).select(
        near_copies.F.explode("keys").alias("kmer")).distinct()
    one = near_copies.keys_without(near_copies.only(docs, texts), aside).collect()
    monkeypatch.setattr(near_copies, "MOST_ASIDE", 0)
    other = near_copies.keys_without(near_copies.only(docs, texts), aside).collect()
    assert len(one) == 14
    assert {(r.doc_id, *sorted(r.keys)) for r in one} == {(r.doc_id, *sorted(r.keys)) for r in other}


def test_many_hot_keys_stay_salted(shipped, monkeypatch):
    rows = shipped.range(4000).selectExpr("id", "id % 40 as key")
    facts = rows.groupBy("key").count().selectExpr("key", "count as n", "key * 2 as fact")
    monkeypatch.setattr(common, "MOST_HOT_KEYS", 5)
    got = common.salted_join(rows, facts, "key", "id", 10, "n")
    assert {(r.id, r.fact) for r in got.collect()} == {(i, i % 40 * 2) for i in range(4000)}


def test_scratch_tables_are_deleted(shipped):
    import os
    table = common.materialize(shipped.createDataFrame([(1,)], "a int"), "some")
    path = table._scratch_path
    assert os.path.isdir(path)
    common.forget(table, None)
    assert not os.path.exists(path)


def test_components_of_chains_and_stars(shipped):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 180)] + [(7, 300)]
    got = near_copies.components(shipped.createDataFrame(edges, "leader long, id long")).collect()
    assert {r.id: r.component for r in got} == {
        **{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 180)}, 300: 0}


def test_quality(shipped, awkward, nothing):
    sf = "/root/testdata/sf0.01"
    docs, labels = (shipped.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, labels)
    rows = quality.score(docs, model).collect()
    truth = {r.doc_id: r.quality for r in labels.collect()}
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.93
    assert len(quality.score(awkward, model).collect()) == len(AWKWARD)
    kept = quality.drop_rejected(awkward, model)
    assert kept.columns == awkward.columns
    assert quality.score(nothing, model).count() == 0
    none = quality.train(docs, labels.limit(0))
    assert {r.score for r in quality.score(awkward, none).collect()} == {0.5}


def test_trees_score_like_a_walk():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 6))
    y = (x[:, 1] + x[:, 4] ** 2 > 0.7).astype(float)
    t = quality.fit(x, y, trees=30)
    for i in range(0, 500, 50):
        odds = t.base
        for f, c, v in zip(t.feature, t.threshold, t.value):
            at = 0
            while at < len(f):
                at = 2 * at + 1 + int(x[i, f[at]] > c[at])
            odds += v[at - len(f)]
        assert abs(1 / (1 + np.exp(-odds)) - t.score(x)[i]) < 1e-9
    assert ((t.score(x) > 0.5) == y).mean() > 0.95


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aeth é9.,!' \n\t\xa0_-ñ", max_size=60))
def test_counts_are_the_librarys(text):
    from tidepanel.llm.encoding import encoder
    from tidepanel.llm.queries import vocabulary
    ids = encoder(vocabulary()).tokenizer.encode(text, add_special_tokens=False).ids
    assert token_counts.counter(vocabulary()).batch([text]) == [len(ids)]


def test_token_counts_and_files(awkward, small_docs, nothing, vocabulary):
    from tidepanel.llm.encoding import encoder
    tokenizer = encoder(vocabulary).tokenizer
    for docs in (awkward, small_docs):
        pairs = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
        ids = {(i, t): tokenizer.encode(t, add_special_tokens=False).ids for i, t in pairs}
        rows = token_counts.count_tokens(docs, vocabulary).collect()
        assert sorted(map(repr, ((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in rows))) \
            == sorted(map(repr, ((i, len(t.encode()), len(ids[i, t]), len(ids[i, t]) > 1024)
                                 for i, t in pairs)))
        rows = token_files.round_trip(docs, vocabulary).collect()
        pairs.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode()))
        want, start = [], 0
        for i, t in pairs:
            x = ids[i, t] + [0]
            want.append((i, start, len(x), zlib.crc32(np.array(x, "<u4").tobytes())))
            start += len(x)
        assert sorted(map(tuple, rows), key=lambda r: r[1]) == want
    assert token_counts.count_tokens(nothing, vocabulary).count() == 0
    assert token_files.round_trip(nothing, vocabulary).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2 ** 32 - 1) | st.integers(0, 70_000), max_size=50))
def test_rank_codes(ranks):
    ranks = np.array(ranks, dtype=np.uint32)
    control, codes = token_files.encode_ranks(ranks)
    assert token_files.decode_ranks(control, codes, len(ranks)).tolist() == ranks.tolist()
    assert len(control) == -(-len(ranks) // 4)


def pages(spark, rows):
    return spark.createDataFrame([(i, f"http://x/{i}?a b", h, "x", "y") for i, h in rows],
                                 "page_id long, url string, html string, content string, rows string")


PAGES = [(1, None), (2, ""), (3, "<p>a" + "b" * 3000), (4, "<p>a" + "b" * 3000), (4, "<p>a" + "b" * 3000),
         (5, "short"), (6, "short"), (7, "é" * 500), (8, "é" * 500), (9, "x" * 999), (10, "x" * 999),
         (11, "\r\n\r\n" + "z" * 5000), (None, "w" * 2000), (12, "P*M\x18\0\0\0\0" * 200)]


def test_warc(shipped, tmpdir_path):
    rows = warc.round_trip(pages(shipped, PAGES)).collect()
    want = []
    for i, h in PAGES:
        data = (h or "").encode()
        same = [j for j, g in PAGES if (g or "") == (h or "") and j is not None]
        revisit = len(data) >= 1000 and same and i != max(same)
        want.append((i, len(data), hashlib.sha1(data).hexdigest(),
                     "revisit" if revisit else "response", max(same) if revisit else None))
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, want))
    assert warc.round_trip(pages(shipped, [])).count() == 0


def test_archive_layout(shipped, tmpdir_path):
    """A leading dictionary frame, then one frame a record, each decodable alone."""
    import struct
    many = [(i, f"<html><p>page {i} " + "common words of all pages " * 20) for i in range(200)]
    path = f"{tmpdir_path}/warc"
    warc.write_archives(pages(shipped, many), path, dictionary_bytes=2048)
    for f in shipped.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect():
        if f.length:
            magic, size = struct.unpack_from("<II", f.content)
            assert magic == 0x184D2A5D and size > 0
            records = list(warc.records_of(bytes(f.content)))
            assert all(r.startswith(b"WARC/1.1\r\n") and r.endswith(b"\r\n\r\n") for r in records)


def brute_text(page):
    body = re.search(r"<article>(.*?)(?:</article>|<footer>|$)", page, re.S)[1]
    out = []
    for block in re.split(r"</?(?:p|h1|h2|h3|li|ul|ol|div|article|section|blockquote)\b[^>]*>", body):
        text = " ".join(entities.unescape(re.sub(r"<[^>]*>", "", block)).split())
        if text:
            out.append(text)
    return "\n".join(out)


def test_html_text(shipped):
    table = shipped.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {r.page_id: brute_text(r.html) for r in table.collect()}
    rows = html_text.extract(table).collect()
    assert {r.page_id: r.text for r in rows} == want
    assert all(r.n_chars == len(r.text) for r in rows)


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("  \n", ""),
    ("<article><h1>T &amp; t</h1><p>a&nbsp;b\n c<br>d<p>e<script>var x='</p>';</script></article>",
     "T & t\na b c d\ne"),
    ("<body><nav><a href=/>Home</a></nav><article><h1>T</h1><p>Some words here. And more words."
     "</p><section class=comments><p>First! nice words.</p></section></article><footer>c</footer>",
     "T\nSome words here. And more words."),
])
def test_html_cases(shipped, html, text):
    assert html_text.extract(pages(shipped, [(1, html)])).first().text == text


@pytest.mark.parametrize("inside", [
    "<svg viewBox='0 0 1 1'/>", "<math/>", "<video src=a.mp4>", "<audio src=a.mp3>",
    "<object data=a>", "<select>", "<canvas>", "<template>", "<svg>", "<svg><title>icon</title></svg>",
    "<video><p>No video here.</p></video>", "<select><option>One<option>Two</select>",
    "<object><object>x</object>Nothing to show.</object>", "<video src=a><video>none</video>"])
def test_html_elements_without_text_hide_nothing_else(inside):
    first, second = ("The river rose for three days, and the town moved its boats uphill.",
                     "On the fourth day it fell again, and nobody had lost a thing.")
    page = html_text.parse(f"<article><p>{first} {inside}</p><p>{second}</p></article>"
                           f"<footer><svg><path/></svg></video></footer>")
    assert [text for _, text in page.blocks] == [first, second]
    page = html_text.parse(f"<article><div>{inside}<p>{first}</p></div><p>{second}</p></article>"
                           f"<footer><svg><path/></svg></video></footer>")
    assert [text for _, text in page.blocks] == [first, second]


def test_html_empty_and_deep(shipped):
    assert html_text.extract(pages(shipped, [])).count() == 0
    deep = "<div>" * 3000 + "<article><p>deep words here.</p></article>"
    assert html_text.extract(pages(shipped, [(None, deep), (None, deep)])).count() == 2


FLOOD = ("The river rose for three days, and the town moved all its boats uphill to the old mill.",
         "On the fourth day it fell again, and nobody had lost a thing, though the bridge needed new planks.")


@pytest.fixture(scope="module")
def page_model():
    return html_text.train(html_samples.labelled_pages())


def text_by(model, html):
    page = html_text.parse(html)
    return html_text.main_text(page, model.marginals([page])[0])


@pytest.mark.parametrize("html", [
    "<div class=topbar><a href=/>Home</a> <a href=/n>News</a></div><div class=story>{}</div>"
    "<div class=bottom>All rights reserved</div>",
    "<div id=page><div id=masthead><a href=/>Blog</a></div><div id=primary><div class='post hentry'>"
    "<div class=entry-content>{}</div></div><div id=comments><ol><li><p>Great post, I liked it a lot.</p>"
    "</ol><div id=respond><h3>Leave a reply</h3><form><p>Name</p></form></div></div></div>"
    "<div id=colophon>Powered by x</div></div>",
    "<body><nav><a href=/>Home</a></nav><section>{}</section><footer>c</footer>",
    "<noscript><p>Please turn on JavaScript to see this page as it was meant to be.</p></noscript>"
    "<article>{}</article>",
    "{}",
])
def test_html_layouts_never_seen(page_model, html):
    assert text_by(page_model, html.format("".join(f"<p>{p}</p>" for p in FLOOD))) == "\n".join(FLOOD)


def test_html_page_with_prose_is_never_empty(page_model):
    page = "<div class=cookie><div class=advert>" + "".join(f"<p>{p}</p>" for p in FLOOD) + "</div></div>"
    assert set(FLOOD) & set(text_by(page_model, page).split("\n"))
    assert text_by(page_model, "<nav><ul><li><a href=/>Home</a></ul></nav><footer>c</footer>") == ""


def block_f1(model, sources):
    parsed = [html_text.parse(h, with_marks=True) for h in sources]
    hit = seen = wanted = 0
    for page, marginal in zip(parsed, model.marginals(parsed)):
        label = html_text.labels_of(page)
        for v, _ in page.blocks:
            seen, wanted = seen + (marginal[v] > 0.5), wanted + label[v]
            hit += label[v] and marginal[v] > 0.5
    return 2 * hit / max(1, seen + wanted)


def test_html_layout_left_out():
    """Every layout and body, judged by a model that was trained without it."""
    found = []
    for layout in html_samples.LAYOUTS + html_samples.BODIES:
        model = html_text.train(html_samples.labelled_pages(6, without=layout), steps=300)
        own = [layout] if layout in html_samples.LAYOUTS else html_samples.layouts(only=layout, each=6, seed=99)
        found.append(block_f1(model, html_samples.fill_in(own, 48 // len(own), 5)))
    assert np.mean(found) >= 0.95
    assert sum(f >= 0.9 for f in found) >= len(found) - 4
    assert min(found) >= 0.5


def test_marginals_are_exact():
    """Messages against the sum over all labellings of a small tree."""
    from itertools import product
    model = html_text.train(html_samples.labelled_pages(3))
    page = html_text.parse("<div class=ad><p>a b</p></div><article><p>c.</p><ul><li>d</li></ul></article>")
    evidence, kind = model.evidence(page), html_text.kinds(page)
    n, total = len(page.parent), 0
    on = np.zeros(n)
    for y in product((0, 1), repeat=n):
        w = np.exp(sum(e for e, v in zip(evidence, y) if v)
                   + sum(model.edge[kind[v], y[page.parent[v]], y[v]] for v in range(1, n)))
        total += w
        on += w * np.array(y)
    assert np.allclose(model.marginals([page, page])[1], on / total)


def test_pipeline_stages(shipped, awkward, nothing):
    import corpus_pipeline
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality", "exact_dedup", "near_dedup", "decontaminate", "pack"]
    docs = awkward
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(shipped, nothing, SMALL).count() == 0
        docs = stage(shipped, docs, SMALL)
        assert docs.columns == awkward.columns
    assert corpus_pipeline.STAGES[-1][1](shipped, nothing, SMALL).count() == 0


def test_pipeline_against_brute_force(shipped, vocabulary):
    """run() on the small tables, each stage done plainly on its input."""
    import corpus_pipeline
    from tidepanel.llm.encoding import encoder
    docs = shipped.read.parquet(f"{SMALL}/documents.parquet")
    model = quality.train(docs, shipped.read.parquet(f"{SMALL}/labels.parquet"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rows = [(i, t) for i, t in rows if quality.scores_of([t], model)[0] >= 0.7]
    first = {}
    for i, t in sorted(rows):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t), i)
    rows = [(i, t) for i, t in rows if i in set(first.values())]
    classes = brute_classes(rows)
    rows = [(i, t) for i, t in rows if classes[i] == i]
    items = [WORD.findall(r.text.lower())
             for r in shipped.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    rows = [(i, t) for i, t in rows if not any(
        distance(p, WORD.findall(t.lower()), anywhere=True)[0] <= int(0.1 * len(p)) for p in items
        if set(p[:len(p) // 2]) <= set(WORD.findall(t.lower()))
        or set(p[len(p) // 2:]) <= set(WORD.findall(t.lower())))]
    tokens = defaultdict(int)
    for r in corpus_pipeline.run(shipped, SMALL).collect():
        tokens[r.doc_id] += r.length
    want = {i: len(encoder(vocabulary).tokenizer.encode(t, add_special_tokens=False).ids) + 1
            for i, t in rows}
    assert dict(tokens) == want


def test_files_keep_bytes(shipped, tmpdir_path):
    path = f"{tmpdir_path}/bytes"
    blocks = [bytes(range(256)) * 3, b"", b"\n\xff\xfe\n"]

    def make(batches):
        for _ in batches:
            yield from blocks

    binary_files.write_files(shipped.range(1).coalesce(1), make, path, "\n")
    got = shipped.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect()
    assert b"".join(bytes(r.content) for r in got) == b"".join(b + b"\n" for b in blocks)


def test_every_round_reads_the_documents_once(shipped, monkeypatch):
    """The texts of a round served one step each: up to three scans of all documents."""
    rng = np.random.default_rng(8)
    passage = [f"p{i}" for i in range(150)]
    docs = []
    for i in range(12):
        own = [f"a{i}x{j}" for j in rng.permutation(45)]
        docs.append((2 * i, " ".join([*passage, *own])))
        docs.append((2 * i + 1, " ".join([*passage, *[f"{w}y" for w in own[:36]], *own[36:]])))
    docs.append((2, docs[2][1].upper()))  # a row twice, one text in two spellings
    calls = {"only": 0, "candidates": 0}
    for name in calls:
        def counted(*a, name=name, real=getattr(near_copies, name)):
            calls[name] += 1
            return real(*a)
        monkeypatch.setattr(near_copies, name, counted)
    rows = {r.doc_id: r.class_id for r in near_copies.near_classes(frame(shipped, docs)).collect()}
    assert rows == {i: i - i % 2 for i, _ in docs}
    assert calls["candidates"] > 1 and calls["only"] == calls["candidates"]
