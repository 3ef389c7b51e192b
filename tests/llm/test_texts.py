"""Operators 2, 3, 4 and 6: brute force, held-out accuracy, known pages, and the defined cases."""

import hashlib
import itertools
import json
import random
import re
import zlib
from html import unescape

import numpy as np
import public_tokenizers
import pytest

from orderstream.llm import bpe, html_main, language, pii, queries, word_pieces
from orderstream.llm.common import read_table
from orderstream.llm.html_main import COMMENTS, CONTENT, ELEMENT, MAYBE, NAMED, NOTHING

SF001, SF01, SF1 = "/root/testdata/sf0.001", "/root/testdata/sf0.01", "/root/testdata/sf0.1"


# ---- PII -------------------------------------------------------------------------

def plain_spans(text):
    """The base definition, read off word by word."""
    luhn = lambda d: sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0
    digits = lambda s: re.sub("[^0-9]", "", s)
    kinds = [(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
             (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
             (r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(digits(s)) <= 19 and luhn(digits(s))),
             (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(digits(s)) <= 15)]
    return [[m.span() for m in re.finditer(p, text) if ok(m.group())] for p, ok in kinds]


def test_base_spans_equal_plain_patterns():
    rnd = random.Random(8)
    pieces = ["a", "b.c", "@", "@@", ".", "-", "+", " ", "12", "255", "256", "0007", "1.2.3.4", "4111 1111-1111 1111", "4111111111111111", "(", ")",
              "+1 (222) 555-0199", "x@y.zz", "é", "\n", "5500-0000-0000-0004", "%"]
    for _ in range(20000):
        t = "".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 14)))
        assert pii.base_spans(t) == plain_spans(t), t
    for long in ("1" * 100_000, "a" * 200_000, "1." * 50_000, "+1" + "(" * 100_000, "@" * 50_000, "a@" * 50_000, "1 " * 50_000):
        pii.base_spans(long)
        list(pii.candidates(long))


def test_trees_learn_what_isn_t_linear():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    t = pii.boost(x[:2000], y[:2000])
    assert ((t.margin(x[2000:]) > 0) == y[2000:]).mean() > 0.95


@pytest.fixture(scope="module")
def pii_rows(spark):
    docs = read_table(spark, SF01, "documents")
    model = pii.fit(docs)
    return model, {r.doc_id: r.text for r in docs.collect()}


def test_pii_query(spark, pii_rows):
    _, text = pii_rows
    got = queries.op2_pii(spark, SF01).collect()
    assert len(got) == len(text)
    for r in got:
        base = [f"{k}:{a}:{b}" for k, spans in zip(pii.KINDS, plain_spans(text[r.doc_id] or "")) for a, b in spans]
        every = r.spans.split(",") if r.spans else []
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(every)
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s.startswith(k + ":") for s in every) for k in pii.KINDS]


def test_model_adds_rewritten_values_and_little_else(pii_rows):
    model, text = pii_rows
    wanted = {"write to jane.doe (at) example (dot) org today": "email", "host 10[.]20[.]30[.]44 is down": "ip",
              "card 4111.1111.1111.1111 was used": "card", "call (212) 555-0187 now": "phone"}
    caught = sum(any(pii.KINDS[k] == kind for k, *_ in model.added(t, pii.base_spans(t))) for t, kind in wanted.items())
    assert caught >= 3
    added = sum(len(model.added(t or "", pii.base_spans(t or ""))) for t in text.values())
    assert added <= len(text) * 0.01
    for t in ("order 1234567890123456 shipped", "on 2024-01-31 at 10:20:30", "version 1.2.3", "meet me at noon dot"):
        assert model.added(t, pii.base_spans(t)) == []


def test_written_addresses_are_proposed_without_an_at_sign_nearby():
    rng = np.random.default_rng(1)
    forms = {pii._rewritten("john.doe@mail.example.com", 0, rng) for _ in range(400)} - {"john.doe@mail.example.com"}
    forms = {f for f in forms if "@" not in f}
    assert len(forms) == 16
    for f in [*forms, "john at example.com", "john at example[.]com", "john [AT] example.com", "john (AT) example (DOT) com",
              "john {at} example{dot}com", "john ( at ) example.com"]:
        assert (0, 9, 9 + len(f)) in list(pii.candidates(f"write to {f}, soon")), f


def test_a_rare_kind_is_learnt_in_a_large_table(spark):
    rnd = random.Random(8)
    docs = []
    for i in range(3000):
        if i % 75 == 0:
            docs.append((i, f"note {i} mail ann{i}@host{rnd.randint(1, 99)}.example.com for more"))
        else:
            docs.append((i, f"order {rnd.randint(10**7, 10**8)} of lot {rnd.randint(1, 9)} came at noon"))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    model = pii.fit(df, max_texts=60)
    assert model.thresholds[0] <= 1
    for t in ("mail jo@x.example.com or bob (at) corp (dot) example (dot) com", "write to ann [at] host7[.]example[.]com"):
        assert any(k == 0 for k, *_ in model.added(t, pii.base_spans(t)))


def test_shares_leave_small_groups_whole():
    assert pii.level({0: 10, 4: 5}, 100) == {0: 1.0, 4: 1.0}
    got = pii.level({0: 1000, 1: 10, 4: 500}, 110)
    assert got[1] == 1.0 and got[0] == pytest.approx(0.05) and got[4] == pytest.approx(0.1)
    assert pii.level({}, 5) == {}


def test_pii_cases(spark):
    df = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, "é😀 a@b.co", 0), (3, "é😀 a@b.co", 0)], "doc_id long, text string, spans int")
    got = sorted((r.doc_id, [tuple(s) for s in r.spans]) for r in pii.find(df, pii.Model()).collect())
    assert got == [(1, []), (2, []), (3, [("email", 3, 9)]), (3, [("email", 3, 9)])]
    assert pii.fit(df.where("doc_id < 3")).trees is None and pii.fit(df.where("false")).trees is None
    assert pii.find(df.where("false"), pii.Model()).count() == 0


# ---- language --------------------------------------------------------------------

def test_held_out_languages(spark):
    got = {r.doc_id: r for r in queries.op3_language_id(spark, SF1).collect()}
    docs = read_table(spark, SF1, "documents").collect()
    assert len(got) == len(docs)
    held = [(d, got[d.doc_id]) for d in docs if zlib.crc32(str(d.doc_id).encode()) % 4 == 2]
    assert all(r.held_out for _, r in held) and sum(r.held_out for r in got.values()) == len(held)
    right = [r.lang_pred == d.lang for d, r in held if d.lang and d.text]
    assert np.mean(right) > 0.97
    sure = [r.lang_pred == d.lang for d, r in held if d.lang and r.language != "und"]
    assert np.mean(sure) >= 0.98 and len(sure) > 0.8 * len(held)


def test_subwords_by_hand():
    texts = [b"", b"Ab", b"a bc!", "é".encode()]
    starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    b, at = language.subwords(np.frombuffer(b"".join(texts), np.uint8), starts)
    bucket = lambda s: int(language.mix(np.array([int.from_bytes(s, "big")], np.uint64) + language._SALTS[len(s)])[0] % language.BUCKETS)
    want = [[], [" ab", "ab ", " ab "], [" bc", "bc ", " bc "], [" é", "é ", " é "]]
    for i, grams in enumerate(want):
        assert sorted(b[at[i]:at[i + 1]].tolist()) == sorted(bucket(g.encode()) for g in grams), i


def test_language_cases(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "le chat et le chien", "fr"), (3, None, "en"), (4, "123 !?", "fr"), (5, "", None), (None, "le chien", "fr"), (6, "x", None)]
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, lang string, score double")
    m = language.fit(df)
    got = {r.doc_id: r for r in language.identify(df, m).collect()}
    assert {i for i, r in got.items() if r.lang_pred == "und"} == {3, 4, 5}
    assert all((r.score == 0) == (r.lang_pred == "und") for r in got.values()) and all(0 <= r.score <= 1 for r in got.values())
    none = language.fit(df.where("false"))
    assert {r.lang_pred for r in language.identify(df, none).collect()} == {"und"}
    assert language.identify(df.where("false"), m).count() == 0


# ---- HTML ------------------------------------------------------------------------

def test_least_cut_is_least():
    rnd = random.Random(2)
    for _ in range(300):
        n = rnd.randint(1, 9)
        unary = np.array([rnd.uniform(-2, 2) for _ in range(n)])
        edges = [(rnd.randrange(n), rnd.randrange(n), rnd.uniform(0, 2)) for _ in range(rnd.randint(0, 16))]
        total = lambda keep: sum(-u if k else 0 for u, k in zip(unary, keep)) + sum(w for a, b, w in edges if keep[a] != keep[b])  # noqa: E731,B023
        best = min(total(k) for k in itertools.product([False, True], repeat=n))
        assert total(html_main.least_cut(unary, edges)) == pytest.approx(best)


def article_by_pattern(html):
    """The generated pages' articles, by their known outline."""
    body = html[html.index("<article>") + 9:html.index("</article>")]
    blocks = re.split(r"</?(?:p|h1)>", body)
    clean = [" ".join(unescape(re.sub(r"</?(?:b|br)>", lambda m: " " if m.group() == "<br>" else "", b)).split()) for b in blocks]
    return "\n".join(b for b in clean if b)


def test_generated_pages(spark):
    got = {r.page_id: r for r in queries.op4_html_main(spark, SF01).collect()}
    pages = read_table(spark, SF01, "pages").collect()
    assert len(got) == len(pages)
    for p in pages:
        assert got[p.page_id].text == article_by_pattern(p.html)
        assert got[p.page_id].n_chars == len(got[p.page_id].text) and got[p.page_id].url == p.url


SENTENCE = "This is a sentence of the story, and it goes on for quite a while. "


def test_page_without_landmarks(spark):
    model = html_main.fit(read_table(spark, SF01, "pages"))
    html = ("<html><head><title>T</title><style>x{}</style></head><body><div><a href=a>Home</a> <a href=b>News</a></div>"
            + "".join(f"<p>{SENTENCE * 4}</p>" for _ in range(3)) + "<p>Short.</p>" + f"<p>{SENTENCE * 3}</p>"
            "<div class='comments'><p>Nice post, I like it very much, thanks!</p></div><form>Search <input></form>"
            "<script>var a='<p>no</p>'</script><div id=footer>&copy; 2024</div>")
    text = model.extract(html)
    assert "Short." in text and text.count("story") == 15
    assert "Home" not in text and "Nice post" not in text and "2024" not in text and "Search" not in text and "no" not in text.split()


def test_blocks_of_odd_html():
    read = lambda h: [b.text for b in html_main.read_blocks(h)]
    assert read("") == [] and read("plain &amp; text") == ["plain & text"] and read("a < b") == ["a < b"]
    assert read("<p>a<br>b <i>c</i>d\n\te&nbsp;f<p>g") == ["a b cd e f", "g"]
    assert read("<!-- x --><p title=\"a>b\">y</p><!-- open") == ["y"]
    assert read("<p>it's</p><p title=don't>z</p>") == ["it's", "z"]
    assert read("<script>if (a<b) '<p>'</script><style>p</style><p>q<textarea>no</textarea>r") == ["q", "r"]
    assert read("<head><title>t</title><body>b") == ["b"] and read("<head><title>t</title></head>c") == ["c"]
    assert read("<ul><li>a<li>b</ul></div></p>c") == ["a", "b", "c"]
    for long in ("<" * 200_000, "<a " * 100_000, "<div>" * 100_000, "<p>x" * 50_000, "<a title=\"" * 50_000, "&amp" * 50_000, "<script>" * 20_000):
        html_main.Model(html_main.prior_weights()).extract(long)


def test_surroundings():
    state = lambda h: [(b.text, b.state) for b in html_main.read_blocks(h)]
    assert state("<div class='layout with-sidebar'><article class=post><div class=article-header><h1>T</h1></div><p>a</p>"
                 "<aside>x</aside><div class='commentlist'><article>c</article></div><p>b</p><div class=share-bar>s</div></article><p>r</p></div>") == [
        ("T", CONTENT), ("a", CONTENT), ("x", ELEMENT), ("c", COMMENTS), ("b", CONTENT), ("s", NAMED), ("r", NOTHING)]
    assert state("<header><h1>Site</h1></header><main><header><h1>T</h1></header>a<footer>f</footer></main><nav>n</nav>z") == [
        ("Site", ELEMENT), ("T", CONTENT), ("a", CONTENT), ("f", ELEMENT), ("n", ELEMENT), ("z", NOTHING)]


STORY = "".join(f"<p>{SENTENCE * k}</p>" for k in (4, 2, 5))


@pytest.mark.parametrize(("html", "kept", "gone"), [
    ("<article class='post hentry category-commentary'><h1>Title here</h1>" + STORY + "</article>", ["Title here"], []),
    ("<main class='site-main comments-open'><h1>Title here</h1>" + STORY + "</main>", ["Title here"], []),
    ("<article><h2 id='related-work'>Related work</h2>" + STORY + "<section id='legal-framework'><h3>Law</h3>" + STORY + "</section></article>", ["Related work", "Law"], []),
    ("<article><h2 id='comments'>On comments</h2>" + STORY + "<p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> hold in what follows, as it did before.</p></article>", ["On comments", "Let x=2 hold"], []),
    ("<article><p>Short.</p><p>Shorter</p></article>", ["Short.", "Shorter"], []),
    ("<article>" + STORY + "<div class='share-bar'>Share</div><div class='ad'><p>" + SENTENCE.replace("story", "product") + "</p></div>" + STORY + "</article>", [], ["Share", "product"]),
    ("<article>" + STORY + "</article><div id='comments'><ol class='comment-list'><li class='comment'><article><p>"
     + SENTENCE.replace("story", "remark") * 3 + "</p></article></li></ol></div>", [], ["remark"]),
    ("<div class='shared-memory'>" + STORY + "</div>", [], []),
])
def test_articles_are_whole(spark, html, kept, gone):
    page = ("<html><head><title>T</title></head><body class='with-sidebar'><nav><ul><li><a href=a>Home</a><li><a href=b>News of today</a></ul></nav>" + html
            + "<aside class='widget-area'><p>" + SENTENCE.replace("story", "sidebar") + "</p></aside><footer>&copy; 2024 Someone</footer></body></html>")
    for model in (html_main.fit(read_table(spark, SF01, "pages")), html_main.Model(html_main.prior_weights())):
        text = model.extract(page)
        assert text.count("story") == html.count("story") and all(k in text for k in kept)
        assert not any(g in text for g in [*gone, "Home", "News", "sidebar", "2024"])


@pytest.mark.parametrize(("words", "inside", "state"), [
    ("post hentry", False, NOTHING), ("category-commentary", False, NOTHING), ("related-work", False, NOTHING), ("related-posts", False, NAMED),
    ("share-bar", True, NAMED), ("site-header", False, MAYBE), ("article-header", True, NOTHING), ("masthead", True, NOTHING), ("Cookie-Notice", False, NAMED),
    ("legal", False, MAYBE), ("legal-framework", False, NOTHING), ("x comment_list", False, COMMENTS), ("comments-open", False, NOTHING), ("tags ad", False, NAMED),
    ("", False, NOTHING), ("adobe admin loading", False, NOTHING)])
def test_names_are_whole_words(words, inside, state):
    assert html_main.name_state(words, inside) == state


def test_the_cut_changes_labels():
    """A short line among paragraphs goes with them, and a long one among links with those, against their own costs."""
    line = "<p>Ok</p>"
    blocks = html_main.read_blocks("<div>" + STORY + line + STORY + "</div><div><ul>" + "".join("<li><a href=x>Go</a>" for _ in range(4)) + "</ul></div>")
    model = html_main.Model(html_main.prior_weights())
    cost, label = model.costs(blocks), model.labels(blocks)
    at = [b.text for b in blocks].index("Ok")
    assert cost[at] < 0 and label[at] and not label[-4:].any() and label[:7].all()
    strength = np.zeros(len(blocks))
    for a, b, w in html_main.ties(blocks):
        strength[[a, b]] += w
    assert (np.abs(cost) < strength).sum() >= 6  # not settled by their own costs
    assert html_main.TEXT_CAP + np.abs(html_main.PRIOR).max() < 2 * html_main.TIE


def test_long_pages_are_cut_in_time():
    rng = random.Random(2)
    html = "<main>" + "".join(rng.choice([f"<p>{SENTENCE}</p>", "<p>Go</p>", "<div><a href=x>Next</a></div>", "<div class=ad><p>Buy it now.</p></div>"]) for _ in range(20_000)) + "</main>"
    text = html_main.Model(html_main.prior_weights()).extract(html)
    assert text.count("story") == html.count("story")


def test_html_cases(spark):
    df = spark.createDataFrame([(1, "u", None, 0), (2, None, "", 0), (3, "u", "just text", 0), (3, "u", "just text", 0)], "page_id long, url string, html string, text int")
    m = html_main.fit(df)
    out = html_main.extract(df, m, ["page_id", "url"])
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted(((r.page_id, r.n_chars) for r in out.collect()))
    assert [g for g in got if g[0] < 3] == [(1, 0), (2, 0)] and len(got) == 4
    assert html_main.extract(df.where("false"), m, ["page_id"]).count() == 0


# ---- word pieces -----------------------------------------------------------------

def greedy(symbols, pieces, longest):
    n = i = 0
    while i < len(symbols):
        for k in range(min(longest, len(symbols) - i), 0, -1):
            if symbols[i:i + k] in pieces:
                break
        else:
            return -1
        i, n = i + k, n + 1
    return n


def test_automaton_equals_greedy_matching():
    rnd = random.Random(6)
    for _ in range(300):
        pieces = {tuple(rnd.choice("abc") for _ in range(rnd.randint(1, 5))) for _ in range(rnd.randint(1, 9))}
        a = word_pieces.Automaton(sorted(pieces))
        for _ in range(40):
            w = tuple(rnd.choice("abc") for _ in range(rnd.randint(1, 12)))
            assert a.count(w) == greedy(w, pieces, 5), (pieces, w)


def test_word_piece_query(spark):
    with open(public_tokenizers.path(queries.BPE_FILE), encoding="utf-8") as f:
        content = f.read()
    reader = bpe.read_encoder(content)
    pieces = {bpe.Encoder.symbols(t) for t in json.loads(content)["model"]["vocab"]}
    longest = max(map(len, pieces))

    def brute(text):
        n = 0
        for w in reader.words_of(text or ""):
            s = [reader.letters[b] for b in w.encode()]
            s[-1] += bpe.MARK
            n += greedy(tuple(s), pieces, longest)
        return n

    docs = {r.doc_id: r.text for r in read_table(spark, SF001, "documents").collect()}
    got = {r.doc_id: r.n_tokens for r in queries.op6_word_pieces(spark, SF001).collect()}
    assert got == {i: brute(t) for i, t in docs.items()}


def test_word_piece_cases(spark):
    df = spark.createDataFrame([(1, None, 0), (2, " \n", 0), (3, "<|endoftext|>the<|startoftext|>", 0), (4, "q" * 100_000, 0)], "doc_id long, text string, n_tokens int")
    got = {r.doc_id: (r.n_words, r.n_tokens) for r in word_pieces.count_pieces(df, public_tokenizers.path(queries.BPE_FILE)).collect()}
    assert got[1] == got[2] == (0, 0) and got[3] == (3, 3) and got[4][0] == 1
    assert word_pieces.count_pieces(df.where("false"), public_tokenizers.path(queries.BPE_FILE)).count() == 0


def test_samples_of_long_texts_are_bounded_and_come_from_all_over(spark):
    short, long = np.arange(language.SAMPLE_SUBWORDS), np.arange(3_000_001)
    assert (language.spread(short) == short).all()
    part = language.spread(long)
    assert len(part) == language.SAMPLE_SUBWORDS and part[0] == 0 and part[-1] == long[-1]
    assert np.diff(part).max() < len(long) / 20
    rows = [(i, f"{'der und die ' if i % 2 else 'the and of '}" * (300_000 if i < 2 else 20), "de" if i % 2 else "en") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in language.identify(df, language.fit(df)).collect()}
    assert all(got[i] == lang for i, _, lang in rows)
