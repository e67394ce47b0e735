"""Trained operators: brute force of their formulas, held-out results, odd rows."""

import itertools
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quayside.llm import gbdt
from quayside.llm import language as L
from quayside.llm import toxicity as T
from quayside.llm.hmm_lm import Model, expected_counts, forward, score_texts
from quayside.llm.html_extract import Page, decode, extract, features, main_text, teach
from quayside.llm.language import fourth_of_ids, keep_languages, languages
from quayside.llm.quality_model import keep_quality, quality_scores, statistics, third_of_ids
from quayside.llm.toxicity import Kernel, learn, toxicity_scores, units, Scorer
from quayside.llm.text import utf8
from tests.llm.conftest import LANGS, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def left(i, parts, remainder):
    return i is not None and zlib.crc32(str(i).encode()) % parts == remainder


# ---- 2


def test_languages_of_held_out_texts(docs, texts):
    got = [r.asDict() for r in languages(docs, fourth_of_ids()).collect()]
    assert len(got) == len(texts)
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    for i, text, lang in texts:
        if i is not None and i < 90:
            assert by_id[i]["lang_pred"] == lang and by_id[i]["score"] > 0.5
            assert by_id[i]["held_out"] == left(i, 4, 2)
    for i in (200, 201, 202, 203, 212):
        assert by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0
    for i in (204, 205, 208, 211):
        assert by_id[i]["lang_pred"] in LANGS
    assert all(0 <= r["score"] <= 1 for r in got)


def test_votes_against_plain_sets(docs):
    """Masks, popcounts and the correction for false positives, against sets of n-grams."""
    learnt = docs.filter("doc_id < 90").select(F.col("doc_id").alias("id"), "text", "lang")
    names, masks = L.learn_filter(learnt, "text", "lang")
    assert sorted(names) == sorted(LANGS)
    text = prose("de", 999, 40) + " " + prose("fr", 7, 9)
    data, offsets = utf8(pa.array([text, "zzz qqq", ""]))
    keys, firsts = L.grams(data, offsets)
    best, score, share = L.votes(masks, len(names), data, offsets)
    for row in range(3):
        own = [int(k) for k in keys[firsts[row]:firsts[row + 1]]]
        shares = []
        for k in range(len(names)):
            held = {int(s) for s in np.flatnonzero(masks[0] >> np.uint64(k) & np.uint64(1))}
            false = (len(held) / (1 << L.SLOT_BITS)) ** L.PROBES
            low = (1 << L.SLOT_BITS) - 1
            found = sum(all((g >> L.SLOT_BITS * p & low) in held for p in range(L.PROBES)) for g in own)
            shares.append(max(found / max(len(own), 1) - false, 0) / (1 - false))
        top, second = sorted(shares)[-1], sorted(shares)[-2]
        assert share[row] == pytest.approx(top if row < 2 else 0, abs=1e-9)
        assert best[row] == (shares.index(top) if row < 2 else len(names))
        assert score[row] == pytest.approx(top / (top + second) if row < 2 and top > 0 else 0, abs=1e-6)
    # Every n-gram that is frequent in one language only has that language's bit in all its slots.
    per = {name: {} for name in names}
    for r in learnt.collect():
        d, o = utf8(pa.array([r["text"]]))
        for g in L.grams(d, o)[0].tolist():
            per[r["lang"]][g] = per[r["lang"]].get(g, 0) + 1
    for k, name in enumerate(names):
        others = set().union(*[per[o] for o in names if o != name])
        own = np.array([g for g, n in per[name].items() if n >= 5 and g not in others], np.uint64)
        assert len(own) > 20
        for at in L.slots(own):
            assert (masks[0][at] >> np.uint64(k) & np.uint64(1)).all()


def test_language_sample_follows_ids_and_texts_alone(docs):
    learnt = docs.filter("doc_id < 90").select(F.col("doc_id").alias("id"), "text", "lang")
    one = L.learn_filter(learnt, "text", "lang", sample=8)
    two = L.learn_filter(learnt.repartition(9), "text", "lang", sample=8)
    assert one[0] == two[0] and (one[1] == two[1]).all()


def test_kept_languages_pass_unchanged(docs, nothing):
    kept = keep_languages(docs, fourth_of_ids())
    assert kept.columns == docs.columns
    ids = {r[0] for r in kept.select("doc_id").collect()}
    assert set(range(90)) <= ids and not ids & {200, 201, 202, 203, 212}
    assert languages(nothing, fourth_of_ids()).count() == 0
    assert keep_languages(docs.withColumn("lang", F.lit(None).cast("string")), fourth_of_ids()).filter("doc_id = 5").count() == 1


# ---- 6 and 7


@pytest.fixture(scope="session")
def labelled(spark):
    """300 texts: every third junk, every fourth with insults, some of them disguised."""
    insults = ["grobnik", "snarfel"]
    rows, labels = [], []
    for k in range(300):
        words = prose(list(LANGS)[k % 3], k + 500, 60).split()
        toxic = k % 4 == 0
        if toxic:
            for j in range(3):
                word = insults[(k // 4 + j) % 2]
                if k % 8 == 0:
                    word = [word, word[:3] + "x" + word[3:], ".".join(word), " ".join(word)][(k // 8 + j) % 4]
                words.insert(5 + 9 * j, word)
        if k % 3 == 0:
            words = [w + "***" for w in words]
        rows.append((k, " ".join(words)))
        labels.append((k, int(k % 3 != 0), int(toxic)))
    labels += [(3, None, None), (None, 1, 1), (9999, 1, 0)]
    rows += [(1000, None), (1001, ""), (None, "words without an id"), (5, rows[5][1])]
    return (spark.createDataFrame(rows, "doc_id long, text string").withColumn("predicted", F.lit("clash")).repartition(3),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_toxic_texts_held_out(labelled):
    docs, labels = labelled
    got = [r.asDict() for r in toxicity_scores(docs, labels, third_of_ids()).collect()]
    assert len(got) == 304
    held = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 300 and r["held_out"]]
    assert len(held) > 60
    right = [(r["predicted"] == 1) == (r["doc_id"] % 4 == 0) for r in held]
    assert np.mean(right) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)


def test_disguised_words_are_near():
    data, offsets = utf8(__import__("pyarrow").array(["grobnik gro.bnik grobxnik GROBNIK gr0bnik g r o b n i k river"]))
    codes, first, row, _ = units(data, offsets)
    assert len(first) == 8
    plain = Kernel(codes[first[0]:first[1]], np.array([0, first[1]]))
    near = plain.values(codes, first)[:, 0]
    assert near[0] == pytest.approx(1) and near[1] == near[3] == near[4] == near[5] == near[0]
    assert 0.2 < near[2] < 1 and near[6] == 0


def kernel_by_force(a, b):
    """The kernel by enumerating all subsequences of the marked words."""
    def counts(word):
        out = {}
        for at in itertools.combinations(range(len(word)), T.LENGTH):
            gaps = [y - x - 1 for x, y in itertools.pairwise(at)]
            if max(gaps) <= T.GAPS:
                key = tuple(word[k] for k in at)
                out[key] = out.get(key, 0) + T.DECAY ** sum(gaps)
        return out

    x, y = counts(a), counts(b)
    dot = sum(v * y.get(k, 0) for k, v in x.items())
    return dot / math.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values())) if x and y else 0.0


def test_kernel_against_enumerated_subsequences():
    words = ["banana", "bananas", "baxnana", "ananas", "grobnik", "grxobnik", "an", "ana", "snarfel", "barnfell", "aaaaaaa"]
    data, offsets = utf8(pa.array([" ".join(words)]))
    codes, first, *_ = units(data, offsets)
    kernel = Kernel(codes, first)
    got = kernel.values(codes, first)
    split = [codes[a:b].tolist() for a, b in itertools.pairwise(first)]
    for i, j in itertools.product(range(len(words)), repeat=2):
        want = kernel_by_force(split[i], split[j])
        assert got[i, j] == pytest.approx(want ** 2, abs=1e-5)


def test_inserted_letters_do_not_hide_insults(labelled):
    """Held-out insults with a letter put into each of them."""
    docs, labels = labelled
    rows = {r["doc_id"]: r["text"] for r in docs.filter("doc_id < 300").collect()}
    marks = {r["doc_id"]: r["toxic"] for r in labels.filter("doc_id < 300 and toxic is not null").collect()}
    taught = [k for k in rows if not left(k, 3, 1)]
    model = learn([rows[k] for k in taught], np.array([marks[k] for k in taught]))
    rng = np.random.default_rng(2)

    def hide(text):
        return re.sub("grobnik|snarfel", lambda m: m[0][:(k := int(rng.integers(1, 7)))] + "x" + m[0][k:], text)

    held = [k for k in rows if left(k, 3, 1)]
    scores = Scorer(model).texts(*utf8(pa.array([hide(rows[k]) for k in held])))
    bad = np.array([marks[k] == 1 for k in held])
    assert (scores[bad] >= 0.7).mean() >= 0.75 and (scores[~bad] >= 0.7).mean() <= 0.01


def test_words_below_the_least_value_are_like_none():
    data, offsets = utf8(pa.array(["grobnik grob bnik groxyzbnik river"]))
    codes, first, *_ = units(data, offsets)
    plain = Kernel(codes[first[0]:first[1]], np.array([0, first[1]]))
    got = plain.values(codes, first)[:, 0]
    split = [codes[a:b].tolist() for a, b in itertools.pairwise(first)]
    for value, word in zip(got, split):
        want = kernel_by_force(word, split[0])
        assert value == 0 or value == pytest.approx(want ** 2, abs=1e-5)
        assert value > 0 or want < T.LEAST_VALUE + 1e-6 or want == 0


def test_without_both_classes(labelled, spark):
    docs, labels = labelled
    assert learn(["a b"], np.array([0])) is None
    scores = toxicity_scores(docs, labels.filter("toxic = 0"), third_of_ids()).select("score").distinct().collect()
    assert len(scores) == 1 and scores[0][0] < 0.1
    assert quality_scores(docs, labels.limit(0), third_of_ids()).select("score").distinct().count() == 1
    assert toxicity_scores(docs.limit(0), labels, third_of_ids()).count() == 0
    assert quality_scores(docs.limit(0), labels, third_of_ids()).count() == 0


def test_quality_held_out(labelled):
    docs, labels = labelled
    got = [r.asDict() for r in quality_scores(docs, labels, third_of_ids()).collect()]
    held = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 300 and r["held_out"]]
    assert all(r["predicted"] == int(r["doc_id"] % 3 != 0) for r in held)
    kept = keep_quality(docs, labels, third_of_ids())
    assert kept.columns == docs.columns
    ids = {r[0] for r in kept.select("doc_id").collect()}
    assert {k for k in range(300) if k % 3} <= ids and not {k for k in range(300) if k % 3 == 0} & ids


def test_statistics_against_plain_python():
    texts = ["", "One two two. three", "A b\nA b\n\nline! *x* (1,2) https://a.b/c_d=e", "ÄÖ der Der DER der\n| a | b |", "x" * 30]
    data, offsets = utf8(pa.array(texts))
    got = statistics(data, offsets)
    for text, row in zip(texts, got):
        raw, words = text.encode(), WORD.findall(text)
        n, size = max(len(words), 1), max(len(raw), 1)
        low = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words]
        lines = [x for x in text.split("\n") if x]
        count = max(len(lines), 1)
        again = lambda items: len(items) - len(set(items))
        kinds = [b"#*$%&|<>", b"|", b"!", b".!?", b",;:", b"()[]{}\"'", b"0123456789", bytes(range(65, 91)), bytes(range(97, 123)),
                 b"/\\_=@", bytes(range(128, 256))]
        want = [math.log1p(len(words)), math.log1p(len(raw)), *[sum(b in k for b in raw) / size for k in kinds]]
        lengths = [len(w.encode()) for w in words]
        want += [sum(lengths) / n, sum(x <= 3 for x in lengths) / n, sum(x >= 14 for x in lengths) / n,
                 sum(w[0] in "#*$%&|<>" or w[-1] in "#*$%&|<>" for w in words) / n, sum("A" <= w[0] <= "Z" for w in words) / n,
                 again(low) / n]
        assert row[:len(want)] == pytest.approx(want, abs=1e-6), text
        pairs = again([*itertools.pairwise(low), *([(low[-1], "")] if low else [])]) / n
        assert abs(row[len(want)] - pairs) <= 1 / n + 1e-6  # the last word pairs with what follows the text
        rest = [sum(a == b for a, b in itertools.pairwise(low)) / n,
                sum(x.rstrip("\n")[-1] in ".!?" for x in lines) / count, math.log1p(len(words) / count), again(lines) / count, math.log1p(len(lines))]
        assert row[len(want) + 1:] == pytest.approx(rest, abs=1e-6), text


def test_labels_and_texts_of_one_id_teach_once(labelled, spark):
    """Several labels, several rows of an id and other partitions leave the models as they are."""
    docs, labels = labelled
    more = labels.unionByName(labels.filter("doc_id % 2 = 0")).unionByName(spark.createDataFrame(
        [(k, 0, 0) for k in range(0, 300, 4)], "doc_id long, quality int, toxic int"))
    copies = docs.unionByName(docs.filter("doc_id = 7").crossJoin(spark.range(40)).drop("id"))
    for scores in (toxicity_scores, quality_scores):
        one = {r["doc_id"]: r["score"] for r in scores(docs, labels, third_of_ids()).collect()}
        two = {r["doc_id"]: r["score"] for r in scores(copies.repartition(7), more.repartition(5), third_of_ids()).collect()}
        assert one.keys() == two.keys() and all(one[k] == pytest.approx(two[k], abs=1e-9) for k in one if k != 5)


def test_flat_trees_walk_like_nested_ones():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(800, 4)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    model = gbdt.fit(x[:600], y[:600], rounds=40)
    fast = gbdt.predict(model, x)
    for k in range(0, 800, 37):
        score = float(model["base"])
        for column, above, leaf in zip(model["column"], model["above"], model["leaf"]):
            node = 0
            while node < len(column):
                node = 2 * node + 1 + int(x[k, column[node]] > above[node])
            score += leaf[node - len(column)]
        assert fast[k] == pytest.approx(1 / (1 + math.exp(-score)))
    assert ((fast[600:] > 0.5) == (y[600:] == 1)).mean() > 0.93
    assert gbdt.predict(gbdt.fit(np.zeros((0, 2)), np.zeros(0)), np.zeros((3, 2))).tolist() == [0.5] * 3


# ---- 8

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no";</script></head><body>
<nav><ul><li><a href="/a">Home</a><li><a href="/b">News</a></ul></nav><!-- <p>no</p> -->
<article><h1>Head&nbsp;line</h1><p>First  para &amp; <b>bold
</b> text, with some more words in it.<p>Second para<br>line, also with quite a few words in it.</p>
<div class="ad">Buy now</div><blockquote>A quote of a number of words.</blockquote></article>
<div id="comments"><div class="comment"><p>I am a comment of a reader, who writes long texts about things.</p></div></div>
<footer>&copy; me</footer>"""


def test_page_blocks_and_decoding(spark):
    page = Page(PAGE)
    texts = [t for t in page.texts if t]
    assert texts == ["Home", "News", "Head line", "First para & bold text, with some more words in it.",
                     "Second para line, also with quite a few words in it.", "Buy now", "A quote of a number of words.",
                     "I am a comment of a reader, who writes long texts about things.", "© me"]
    assert len(features(page)) == len(page.tag)
    kept = decode(page, np.linspace(0.9, 0.1, len(page.tag)))
    assert all(kept[page.parent[k]] for k in range(1, len(page.tag)) if kept[k])
    for broken in ("", "<", "<p", "a<!-- b", "<script>x", "</p></div>x", "<div>" * 3000 + "deep", "<a <b>> &#xZZ; &amp"):
        p = Page(broken)
        main_text(p, decode(p, np.full(len(p.tag), 0.5)), np.full(len(p.tag), 0.5))


def test_decoding_is_the_likeliest_consistent_choice():
    page = Page("<div>aa<p>bbbb</p><section><p>c</p>d</section></div><p>ee</p>")
    n = len(page.tag)
    rng = np.random.default_rng(4)
    weight = np.full(n, 0.5)
    for (node, _, _), text in zip(page.segments, page.texts):
        weight[node] += np.log1p(len(text))
    for _ in range(40):
        p = rng.uniform(0.02, 0.98, n)
        best = max(
            (sum(weight[k] * math.log(p[k] if c[k] else 1 - p[k]) for k in range(1, n)), c)
            for c in itertools.product((0, 1), repeat=n)
            if c[0] and all(c[page.parent[k]] or not c[k] for k in range(1, n)))[1]
        assert decode(page, p).tolist() == [bool(v) for v in best]


def test_extraction(spark):
    rows = [(k, f"u{k}", PAGE.replace("First", f"First {prose('en', k, 30)}")) for k in range(30)]
    rows += [(100, None, None), (101, "u", ""), (0, "u0", rows[0][2])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = extract(df).collect()
    assert len(got) == 33
    for r in got:
        assert r["n_chars"] == len(r["text"])
        if r["page_id"] < 100:
            assert r["text"].startswith("Head line\n\nFirst ") and r["text"].endswith("A quote of a number of words.")
            assert "Buy" not in r["text"] and "comment" not in r["text"] and "Home" not in r["text"]
        else:
            assert r["text"] == ""
    assert extract(df.limit(0)).count() == 0


def _div_page(k):
    page = PAGE.replace("First", f"First {prose('en', k, 30)}")
    return page.replace("<article>", '<div class="post">').replace("</article>", "</div>")


def test_pages_without_named_articles_keep_their_text(spark):
    rows = [(k, f"u{k}", _div_page(k)) for k in range(30)]
    got = extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(got) == 30
    for r in got:
        assert "First " in r["text"] and "Second para line" in r["text"] and "Home" not in r["text"]


def test_other_pages_and_copies_leave_the_sample_alone(spark, monkeypatch):
    import quayside.llm.html_extract as H

    taught = []
    monkeypatch.setattr(H, "teach", lambda pages: taught.append(pages) or teach(pages[:2]))
    named = [PAGE.replace("First", f"First {prose('en', k, 30)}") for k in range(260)]
    rows = [(k, "u", p) for k, p in enumerate(named + [_div_page(k) for k in range(3000)] + [named[0]] * 500)]
    extract(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert len(taught[0]) == len(set(taught[0])) == H.SAMPLE + H.MADE and set(taught[0][:H.SAMPLE]) <= set(named)


def _texts(source):
    return [t for t in Page(source).texts if t]


def test_unclosed_and_embedded_elements_keep_the_article():
    for tag in ("button", "select", "object", "svg", "noscript", "template", "iframe"):
        got = _texts(f"<article><p>One</p><{tag}><p>Two</p></article><p>Three</p>")
        assert got == ["One", "Two", "Three"], tag
    assert _texts("<p>a <button><b>x</b><div>y</div></button> b <select><option>1<option>2</select> c</p>") == ["a b c"]
    assert _texts("<p>a <svg><g><path d=''/></g></svg>b <noscript><img></noscript>c</p>") == ["a b c"]
    assert _texts("<p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be</p><object>fall <p>back</object>") == [
        "Let x=1 be", "fall", "back"]
    assert Page("<p><a href='/'><svg><path/></svg> Home</a>").segments[0][2] == len(" Home")
    assert _texts("<ul><li>a<button>x<li>b</ul><p>c") == ["a", "b", "c"]
    assert _texts("<template><div>no<p>no</div></template><p>yes") == ["yes"]


def test_skips_end_where_the_source_says():
    dots = "\u0130" * 40
    assert _texts(f"<p>{dots}</p><script>a</SCRIPT><p>Diyarbak</p><style>b</style><p>next") == [dots, "Diyarbak", "next"]


# ---- 10


def test_forward_sums_over_all_paths():
    rng = np.random.default_rng(5)
    model = Model(rng.dirichlet([1, 1, 1]), rng.dirichlet([1, 1, 1], 3), rng.dirichlet([1] * 4, 3).T)
    seqs = [[0, 1, 2, 3], [3], [2, 2, 1], []]
    firsts = np.concatenate([[0], np.cumsum([len(s) for s in seqs])])
    got = forward(model, np.array(sum(seqs, []), int), firsts)
    for s, value in zip(seqs, got):
        total = 0.0
        for path in itertools.product(range(3), repeat=len(s)):
            p = 1.0
            for t, (z, c) in enumerate(zip(path, s)):
                p *= (model.start[z] if t == 0 else model.move[path[t - 1], z]) * model.emit[c, z]
            total += p
        assert value == pytest.approx(math.log(total), abs=1e-12)
    # Expected counts against posteriors from all paths, for one sequence.
    into = np.zeros((1 + 3 + 4, 3))
    expected_counts(model, np.array(seqs[0]), np.array([0, 4]), into)
    want = np.zeros_like(into)
    paths = list(itertools.product(range(3), repeat=4))
    weights = []
    for path in paths:
        p = 1.0
        for t, (z, c) in enumerate(zip(path, seqs[0])):
            p *= (model.start[z] if t == 0 else model.move[path[t - 1], z]) * model.emit[c, z]
        weights.append(p)
    for path, w in zip(paths, np.array(weights) / sum(weights)):
        want[0, path[0]] += w
        for t, (z, c) in enumerate(zip(path, seqs[0])):
            want[4 + c, z] += w
            if t:
                want[1 + path[t - 1], z] += w
    assert np.allclose(into, want, atol=1e-5)


def test_training_raises_the_likelihood():
    rng = np.random.default_rng(6)
    seqs = [np.repeat(rng.integers(1, 3), 40) + 2 * rng.integers(0, 2, 40) for _ in range(60)]
    classes, firsts = np.concatenate(seqs), np.arange(61) * 40
    counts = np.bincount(classes, minlength=5).astype(float)
    model, last = Model.begin(counts, 4), -np.inf
    for _ in range(6):
        now = forward(model, classes, firsts).sum()
        assert now > last - 1
        last = now
        into = np.zeros((1 + 4 + 5, 4))
        expected_counts(model, classes, firsts, into)
        model = model.learn(into, counts)


def test_scores(docs, texts, nothing):
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 1
    got = [r.asDict() for r in score_texts(docs, held).collect()]
    assert len(got) == len(texts)
    low = [[re.sub("[A-Z]", lambda m: m.group().lower(), w) for w in WORD.findall(t or "")] + [None] for _, t, _ in texts]
    count = {}
    for (i, _, _), tokens in zip(texts, low):
        if not left(i, 5, 1):
            for w in tokens:
                count[w] = count.get(w, 0) + 1
    total, distinct = sum(count.values()), len(count)
    want = sorted((str(i), left(i, 5, 1), len(ts), sum(w in count for w in ts), total, round(sum(
        math.log10((count.get(w, 0) + 0.5) / (total + 0.5 * (distinct + 1))) for w in ts), 6)) for (i, _, _), ts in zip(texts, low))
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
    assert sum(r["score"] for r in got if r["held_out"]) > sum(r["base_score"] for r in got if r["held_out"])
    assert not [r for r in got if not r["score"] < 0]
    assert score_texts(nothing, held).count() == 0
    alone = score_texts(docs.filter("doc_id = 5"), F.lit(True)).first()
    assert alone["train_tokens"] == 0 and alone["base_score"] == 0 and alone["n_known"] == 0


def test_every_sweep_sees_all_training_texts(spark, monkeypatch):
    import quayside.llm.hmm_lm as H

    seen = []
    gather = H._gather
    monkeypatch.setattr(H, "_gather", lambda part, model: seen.append(gather(part, model)) or seen[-1])
    rows = [(k, prose(list(LANGS)[k % 3], k, 12)) for k in range(1800)]
    score_texts(spark.createDataFrame(rows, "doc_id long, text string"), F.lit(False))
    assert len(seen) % H.PARTS == 0 and 2 * H.PARTS <= len(seen) <= H.SWEEPS * H.PARTS
    logs = []
    for a in range(0, len(seen), H.PARTS):  # a start per text and an emission per token in every sweep
        sweep = seen[a:a + H.PARTS]
        assert sum(c[0].sum() for c, _ in sweep) == pytest.approx(1800, rel=1e-3)
        assert sum(c[1:1 + H.STATES].sum() for c, _ in sweep) == pytest.approx(1800 * 12, rel=1e-3)
        assert sum(c[1 + H.STATES:].sum() for c, _ in sweep) == pytest.approx(1800 * 13, rel=1e-3)
        logs.append(sum(x for _, x in sweep))
    settled = logs[-1] - logs[-2] < H.SETTLED * 1800 * 13
    assert logs[-1] > logs[0] and (settled or len(seen) == H.SWEEPS * H.PARTS)


def test_cuts_leave_the_counts_as_they_are(monkeypatch):
    import quayside.llm.hmm_lm as H

    rng = np.random.default_rng(9)
    model = Model(rng.dirichlet([1] * 4), 0.7 * np.eye(4) + 0.3 * rng.dirichlet([1] * 4, 4), rng.dirichlet([0.4] * 30, 4).T)
    lengths = [1, 700, 2500, 512, 0, 513, 530]
    classes = rng.integers(0, 30, sum(lengths))
    firsts = np.concatenate([[0], np.cumsum(lengths)])
    whole, cut = np.zeros((35, 4)), np.zeros((35, 4))
    logs = [expected_counts(model, classes, firsts, cut)]
    monkeypatch.setattr(H, "RUN", 1 << 20)
    logs.append(expected_counts(model, classes, firsts, whole))
    assert np.allclose(cut, whole, rtol=2e-3, atol=0.05) and abs(logs[0] - logs[1]) < 1e-3 * abs(logs[1])
    assert cut[1:5].sum() == pytest.approx(sum(max(n - 1, 0) for n in lengths), rel=1e-4)
    assert cut[5:].sum(1) == pytest.approx(np.bincount(classes, minlength=30), rel=1e-4)


def test_first_states_hold_classes_of_like_neighbours():
    import quayside.llm.hmm_lm as H

    rng = np.random.default_rng(3)
    seq = np.concatenate([rng.integers(0, 10, 5000) * 2 + rng.integers(0, 2) for _ in range(6)])  # even or odd for long
    classes = np.bincount(seq, minlength=20).astype(float)
    kind = np.arange(20)
    near = np.zeros((20, 40))
    np.add.at(near, (seq[:-1], seq[1:]), 1)
    np.add.at(near, (seq[1:], 20 + seq[:-1]), 1)
    model = H.first_model(classes, near, kind, 2)
    state = model.emit.argmax(1)
    assert len(set(state[::2])) == 1 and len(set(state[1::2])) == 1 and state[0] != state[1]
    assert np.allclose(model.emit.sum(0), 1) and np.allclose(model.move.sum(1), 1) and model.move.diagonal().min() > 0.9
    alone = H.first_model(np.array([3.0]), np.zeros((1, 2)), np.array([0]), 2)
    assert np.isfinite(alone.emit).all() and np.isfinite(alone.move).all()


# ---- pipeline


def test_pipeline_stage_by_stage(spark, docs, tmp_path):
    import corpus_pipeline as C
    from tests.llm.test_exact import brute_groups

    folder = str(tmp_path)
    docs.write.parquet(folder + "/documents.parquet")
    spark.createDataFrame(
        [(k, int(k < 100), 0) for k in [*range(0, 90), *range(120, 160)]], "doc_id long, quality int, toxic int",
    ).write.parquet(folder + "/labels.parquet")
    now = spark.read.parquet(folder + "/documents.parquet")
    seen, kept = [], []
    for name, stage in C.STAGES:
        step = C.durable(stage(spark, now, folder), name)
        if name != C.STAGES[-1][0]:
            assert step.columns == docs.columns
        kept.append(step)
        seen.append({r[0] for r in step.select("doc_id").collect()})
        now = step
    assert set(range(90)) - {3} <= seen[0] and not seen[0] & {200, 201, 202, 203}
    assert set(range(90)) <= seen[1] and not seen[1] & set(range(120, 160))
    stayed = [(r[0], r[1], None) for r in kept[1].select("doc_id", "text").collect()]
    assert seen[2] == {c for _, _, c in brute_groups(stayed)}
    assert not seen[2] & {*range(100, 106), *range(111, 115)}
    assert seen[3] == seen[2]
    assert {r[0] for r in C.run(spark, folder).select("doc_id").collect()} == seen[3]


def test_pipeline_of_empty_tables(spark, nothing, labelled, tmp_path):
    import corpus_pipeline as C

    nothing.write.parquet(str(tmp_path / "documents.parquet"))
    labelled[1].limit(0).write.parquet(str(tmp_path / "labels.parquet"))
    assert C.run(spark, str(tmp_path)).count() == 0
    assert keep_quality(nothing, labelled[1], third_of_ids()).count() == 0
    assert keep_quality(labelled[0], labelled[1].limit(0), third_of_ids()).columns == labelled[0].columns
