"""Toxicity and quality: automata by brute force, held-out accuracy, edge cases, the pipeline."""
import random

import numpy as np
import pytest

from potluck.llm import cotraining, html, toxicity


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, old[j] + 1, old[j - 1] + (x != y)))
    return row[-1]


def test_lexicon_against_edit_distance():
    rng = random.Random(1)
    terms = ["".join(rng.choice("abc") for _ in range(rng.randint(2, 11))) for _ in range(25)] + ["abca*", "ccab*", "abccb*", "cabbacaab*"]
    lexicon = toxicity.Lexicon(terms, keep=50)  # a bound small enough to start afresh many times
    for _ in range(1500):
        word = "".join(rng.choice("abcd") for _ in range(rng.randint(0, 13)))
        if rng.random() < 0.5:
            word = list(rng.choice(terms).rstrip("*"))
            for _ in range(rng.randint(0, 2)):
                word.insert(rng.randrange(len(word) + 1), rng.choice("abcd"))
            word = "".join(word)
        want = {}
        for k, t in enumerate(lexicon.terms):
            if t.endswith("*"):
                least = min(edits(word[:n], t[:-1]) for n in range(len(word) + 1))
                if least <= toxicity.allowed_edits(t):
                    want[k] = least
            elif edits(word, t) <= toxicity.allowed_edits(t):
                want[k] = edits(word, t)
        assert dict(lexicon.match(word)) == want, word


def clean_text(rng, n=60):
    return " ".join(rng.choice(["ba", "lo", "mi", "ster", "ven"]) + rng.choice(["ka", "nel", "tor", "si", "dum", "rap"]) + rng.choice(["", "a", "on"]) for _ in range(n))


BAD = ["grumblefool", "snotface", "dirtbag", "blockhead"]


def toxic_table(n=600, seed=2):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = clean_text(rng, rng.randint(10, 90)).split()
        toxic = i % 4 == 0
        if toxic:
            for _ in range(rng.randint(1, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
        docs.append((i, " ".join(words), "en", f"s{i % 5}", 1))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def test_rare_toxic_terms_are_learned(spark, make_docs, labels):
    """A third of the toxic rows carry only one of 60 terms, each in few rows; none is cut, clean rows stay, runs agree."""
    rng = random.Random(17)
    vocab = ["".join(rng.choice("abcdeghilmnoprstu") for _ in range(rng.randint(3, 9))) for _ in range(3000)]
    rare = ["zq" + "".join(rng.choice("aeioubdfgkmnprt") for _ in range(6)) for _ in range(60)]
    rows, marks = [], []
    for i in range(9000):
        words = [rng.choice(vocab) for _ in range(rng.randint(30, 60))]
        toxic = i % 3 == 0
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(rare) if rng.random() < 0.4 else rng.choice(["vilewort", "grimscum"]))
        rows.append((i, " ".join(words)))
        marks.append((i, 1, int(toxic)))
    docs = make_docs(rows)
    model = toxicity.learn(docs, labels(marks), max_rows=400)
    assert model.terms == toxicity.learn(docs, labels(marks), max_rows=400).terms
    scored = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    hard = [i for i, t in rows if i % 3 == 0 and any(w in t for w in rare)]
    assert len(hard) > 1000 and sum(scored[i] >= 0.5 for i in hard) >= 0.95 * len(hard)
    clean = [i for i, _ in rows if i % 3]
    assert sum(scored[i] >= 0.5 for i in clean) == 0


def test_copies_share_a_pair_of_minima_and_passages_do_not():
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    passage = [word() for _ in range(50)]
    common = [set(toxicity._sketch([word() for _ in range(250)] + passage)) for _ in range(200)]
    assert sum(bool(a & b) for a, b in zip(common, common[1:])) < 40
    text = [word() for _ in range(300)]
    copies = []
    for _ in range(200):
        copy = list(text)
        for _ in range(5):
            copy[rng.randrange(300)] = word()
        copies.append(set(toxicity._sketch(copy)))
    assert sum(bool(c & set(toxicity._sketch(text))) for c in copies) > 180
    assert toxicity._sketch([]) == toxicity._sketch([]) and len(toxicity._sketch(["a"])) == 1


def test_toxicity_learns_catches_misspellings_and_spares_quotations(spark, make_docs, labels):
    docs, marks = toxic_table()
    model = toxicity.learn(make_docs(docs), labels(marks))
    assert {t.rstrip("*") for t in model.terms} >= set(BAD) or all(any(b.startswith(t.rstrip("*")) for t in model.terms) for b in BAD)
    scorer = toxicity.Scorer(model)
    rng = random.Random(9)
    base = clean_text(rng, 40)
    score = lambda t: float(scorer.score([t])[0])
    assert score(base) < 0.1 and score("") < 0.5 and score(None) < 0.5
    assert score(base + " grumblefool dirtbag " + base) > 0.9
    assert score(base + " GRUMBLEFOL snotfaces " + base) > 0.5
    assert score(f'{base} he said "you grumblefool" and left {base}') < 0.5
    assert score('the "snotface" of it') < 0.5 and score("snotface") > 0.5
    got = toxicity.score(make_docs(docs, extra=("score2",)), model).collect()
    assert all((r["score"] >= 0.5) == (r["doc_id"] % 4 == 0) for r in got)


def test_toxicity_edge_cases(edge_docs, no_docs, labels, make_docs):
    assert edge_docs.count() == toxicity.keep_clean(edge_docs, labels([])).count()
    only = labels([(5, 1, 1), (6, 1, 1)])
    assert toxicity.keep_clean(edge_docs, only).columns == edge_docs.columns
    assert toxicity.keep_clean(no_docs, labels([])).count() == 0
    docs, marks = toxic_table(300)
    twice = docs + docs[:40] + [(None, "grumblefool snotface dirtbag", None, None, None), (900, None, "en", "s", 0)]
    kept = toxicity.keep_clean(make_docs(twice), labels(marks + marks[:20] + [(None, 1, 1), (900, None, None)]))
    ids = [r["doc_id"] for r in kept.collect()]
    assert None not in ids and 900 in ids and all(i % 4 for i in ids if i != 900)


def quality_table(n=500, seed=4):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        poor = i % 5 == 0
        text = clean_text(rng, rng.randint(20, 120))
        if poor:
            kind = i // 5 % 3
            text = text.upper() if kind == 0 else " ".join(w + "%%%" for w in text.split()) if kind == 1 else " ".join([w for x in text.split()[:9] for w in [x] * 8])
        docs.append((i, text, "en", "bad.example" if poor and rng.random() < 0.7 else f"s{i % 7}", len(text)))
        if i % 2 or i % 20 == 0 or i % 25 == 0:
            labels.append((i, int(not poor), 0))
    labels += [(i, 0, 0) for i in range(0, n, 5) if i % 3 == 0]
    return docs, labels


def test_co_training_held_out(make_docs, labels):
    docs, marks = quality_table()
    model = cotraining.learn(make_docs(docs), labels(marks), max_rows=400, pool_rows=300)
    got = cotraining.score(make_docs(docs, extra=("score2",)), model).collect()
    right = np.mean([(r["score"] >= 0.5) == (r["doc_id"] % 5 != 0) for r in got])
    assert right > 0.97
    assert all(0 <= r[c] <= 1 for r in got for c in ("score", "text_score", "meta_score"))


def test_quality_edge_cases(edge_docs, no_docs, labels):
    assert cotraining.keep_good(edge_docs, labels([])).count() == edge_docs.count()
    some = labels([(i, i % 2, 0) for i in range(1, 9)] + [(None, 0, 0), (3, None, None), (1, 1, 1)])
    assert cotraining.keep_good(edge_docs, some).columns == edge_docs.columns
    assert cotraining.score(edge_docs, cotraining.learn(edge_docs, some), names=("a1", "a2", "a3")).count() == edge_docs.count()
    assert cotraining.keep_good(no_docs, labels([])).count() == 0


# ------------------------------------------------------------------ pages ---
def test_main_text_held_out_pages():
    rng = random.Random(1234)  # other pages than those of the training seed
    same = total = 0
    for _ in range(60):
        page = html.training_page(rng)
        truth = html.Page(page)
        on, kept, runs = False, [], []
        for node, data in truth.runs:
            got = ""
            for part in html.re.split("([\x01\x02])", data):
                if part in ("\x01", "\x02"):
                    on = part == "\x01"
                elif on:
                    got += part
            runs.append((node, got))
        truth.runs = runs
        want = html.blocks_of(truth, [True] * len(truth.tag))
        (got,) = html.extract_texts([page.replace("\x01", "").replace("\x02", "")], html.trained())
        a, b = want.split(), got.split()
        same += 2 * len(set(a) & set(b))
        total += len(set(a)) + len(set(b))
    assert same / total > 0.98


def test_decode_is_the_best_consistent_choice():
    rng = random.Random(3)
    for _ in range(200):
        n = rng.randint(1, 9)
        parent = [-1] + [rng.randrange(i) for i in range(1, n)]
        odds = np.array([rng.uniform(-3, 3) for _ in range(n)])
        odds[0] = abs(odds[0])
        below = np.array([rng.randint(1, 20) for _ in range(n)], float)
        vote = odds * below
        best = max((sum(v if k >> i & 1 else -v for i, v in enumerate(vote)), k) for k in range(1, 1 << n, 2)
                   if all(k >> parent[i] & 1 or not k >> i & 1 for i in range(1, n)))
        got = html.decode(parent, odds, below)
        assert abs(sum(v if g else -v for g, v in zip(got, vote)) - best[0]) < 1e-9
        assert all(got[parent[i]] or not got[i] for i in range(1, n))


@pytest.mark.parametrize(("page", "text"), [
    ("", ""), (None, ""), ("just  plain\n text &amp; more", "just plain text & more"),
    ("<p>one <b>two</b>three<p>four<br>five", "one twothree four five"),
    ("<body><nav><ul><li><a href=x>Menu</a></li></ul></nav><article><p>Main &eacute;&#33; text of the page, with some words.</p></article><script>var t='</p>';</script><footer>foot note</footer>",
     "Main é! text of the page, with some words."),
    ("<div><div><p>unclosed", "unclosed"), ("</p></div>", ""), ("<![x", ""),
])
def test_pages(page, text):
    got = html.extract_texts([page], html.trained())
    assert got == [text] or page == "<![x"


def visible(page):
    return " ".join("".join(t if node >= 0 else " " for node, t in html.Page(page).runs).split())


@pytest.mark.parametrize(("page", "text"), [
    ("<html><head><title>t</title><body><p>text</p></body></html>", "text"),
    ("<head><title>t</title><meta charset=utf-8><p>a<p>b", "a b"),
    ("<head><title>t</title>plain <b>text</b>", "plain text"),
    ("<head><head></head><p>c", "c"),
    ("<head><noscript><img src=x></noscript><style>p{}</style></head><p>d", "d"),
    ("<article><p>so <math><mi>q</mi></math> and <svg><title>no</title><text>label</text></svg></p></article>", "so q and label"),
])
def test_text_after_an_open_head_and_in_formulas(page, text):
    assert visible(page) == text


@pytest.mark.parametrize(("page", "text"), [
    ("<p>a</p><![foo[x]]><p>b</p>", "a b"), ("<p>x <![ y</p><p>b</p>", "x b"), ("<p>a<![>b", "ab"),
    ("<p>a</p><![CDATA[x<p>b</p>", "a b"), ("<p>a<![CDATA[x > y]]>b</p>", "ab"), ("<p>a<![if !IE]>b<![endif]>c</p>", "abc"),
])
def test_text_after_unknown_sections(page, text):
    assert visible(page) == text


def test_page_rows(spark):
    rows = [(1, "u", "<p>Hello world, this is it.</p>"), (1, "u", "<p>Hello world, this is it.</p>"), (None, None, None), (2, "v", "<div>" * 3000 + "deep")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as n_chars")
    got = [r["text"] for r in html.extract(df).collect()]
    assert got[0] == got[1] == "Hello world, this is it." and got[2] == "" and got[3] == "deep"
    assert html.extract(df.where("false")).count() == 0


def test_computed_columns_replace_clashing_ones(edge_docs, spark):
    from pyspark.sql import functions as F

    scored = toxicity.score(edge_docs, toxicity.Model())
    assert scored.columns.count("score") == 1 and {r["score"] for r in scored.collect()} != {"x"}
    pages = spark.createDataFrame([(1, "<p>Some words here.</p>")], "page_id long, html string").withColumn("TEXT", F.lit("old"))
    assert [r["text"] for r in html.extract(pages).collect()] == ["Some words here."]
    with pytest.raises(ValueError):
        html.extract(pages, out="html")


# Pages written by hand, not by the generator that the trees learn from.
P = "Ministers met on Monday to discuss the new harbour plan, which has been delayed twice. The council said the work would start in spring."
Q = "Local traders are worried about the noise, but most of them welcome the investment. A second meeting is planned for June."
NAV = "<nav><a href=/>Home</a><a href=/n>News</a></nav>"
LAYOUTS = {
    "one form around the page": (f"<form id=aspnetForm>{NAV}<div id=main><h1>Harbour</h1><p>{P}</p><p>{Q}</p><p>{P}</p></div></form>", f"Harbour {P} {Q} {P}"),
    "misleading names": (f"{NAV}<div class='alert-news message-body'><p>{P}</p><p>{Q}</p><p>{P}</p><p>{Q}</p></div>", f"{P} {Q} {P} {Q}"),
    "lines by br": (f"{NAV}<div>{P}<br>{Q}<br>{P}<br>{Q}</div>", f"{P} {Q} {P} {Q}"),
    "paragraph of links": ("<article><p>See <a href=a>the report of the harbour council</a> and <a href=b>the answer of the traders</a>.</p></article>",
                           "See the report of the harbour council and the answer of the traders."),
    "comment left open": (f"<article><p>{P}</p><!-- open <p>{Q}</p></article>", f"{P} {Q}"),
    "comment open to the end": (f"<article><p>{P}</p></article><!-- open", P),
    "comments without names": (f"<article><h1>Harbour</h1><p>{P}</p><p>{Q}</p><p>{P}</p></article><h3>Opinions</h3><ul><li><b>Ann</b> <p>I do not agree at all.</p></li>"
                               "<li><b>Bob</b> <p>Nice piece, thanks.</p></li><li><b>Cid</b> <p>What about parking?</p></li></ul>", f"Harbour {P} {Q} {P}"),
    "fallback in an article": (f"{NAV}<noscript>Please enable scripts.</noscript><article><p>{P}</p><canvas>{Q}</canvas><p>{P}</p></article>", f"{P} {Q} {P}"),
    "columns of a table": (f"<table><tr><td><a href=1>One</a><br><a href=2>Two</a></td><td><p>{P}</p><p>{Q}</p><p>{P}</p></td></tr></table>", f"{P} {Q} {P}"),
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_main_text_of_layouts_written_by_hand(name):
    body, want = LAYOUTS[name]
    assert html.extract_texts([f"<html><head><title>t</title></head><body>{body}</body></html>"], html.trained()) == [want]


def test_reading_goes_on_behind_what_the_parser_cannot_take(monkeypatch):
    plain = html.HTMLParser.parse_starttag

    def fails(self, i):
        if self.rawdata.startswith("<bad", i):
            raise AssertionError("no such construct")
        return plain(self, i)
    monkeypatch.setattr(html.HTMLParser, "parse_starttag", fails)
    page = f"<article><p>{P}</p><bad x><p>{Q}</p><bad><bad y><p>{P}</p></article><bad"
    assert html.extract_texts([page, "<bad", "<bad>"], html.trained()) == [f"{P} {Q} {P}", "", ""]


def test_term_counts_remember_few_words(monkeypatch):
    """The words whose terms a task remembers are bounded; the counts do not change."""
    import tracemalloc

    import pyarrow as pa
    from potluck.llm import toxicity

    texts = [" ".join(f"stem{i}w{k}" for k in range(i, i + 40)) for i in range(1500)]
    batches = [pa.record_batch([pa.array(texts[at:at + 300]), pa.array([k % 2 for k in range(300)])], names=["text", "y"]) for at in range(0, 1500, 300)]

    def counted(words):
        monkeypatch.setattr(toxicity, "HELD_WORDS", words, raising=False)
        tracemalloc.start()
        got = pa.Table.from_batches(list(toxicity._term_counts(batches))).to_pylist()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return sorted(got, key=lambda r: (r["term"], r["y"])), peak

    (some, small), (every, large) = counted(500), counted(10 ** 9)
    assert some == every and small < 0.85 * large
