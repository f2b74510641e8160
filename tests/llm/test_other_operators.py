"""HTML text, URL rules, n-best pieces, MaxScore search and chat repair."""

import math
import random
import time

import brute
import numpy as np
import pytest

from qaforge.llm import chat_format, html_text, maxscore, sentencepiece_nbest, url_filter
from qaforge.session import materialize

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body class="home">
<header class="site"><a href="/">Home</a></header><nav><ul><li><a href=1>one</a><li><a href=2>two</a></ul></nav>
<div class="cookie-banner">We use cookies.</div><div id="sidebar"><p>Side text that is rather long, but beside the point.</p></div>
<main><header><h1>A  title &amp; more</h1></header><p>First <b>bold</b> words&nbsp;here,<br>and a <a href="x">link</a>.
<p>Second &lt;block&gt; of text, long enough to count.<ul><li>item one<li>item two</ul><!-- no --><table><tr><td>c1<td>c2</table>
<form><input><button>Send</button></form><section class="comments"><p>I do not agree with this article at all.</p></section></main>
<footer>&copy; 2020</footer></body></html>"""


def test_html_page():
    assert html_text.main_text(PAGE) == ("A title & more\nFirst bold words here, and a link.\nSecond <block> of text, long enough to count.\n"
                                         "item one\nitem two\nc1\nc2")


def test_html_density_picks_the_article():
    menu = "".join(f"<li><a href='/{i}'>menu entry {i}</a></li>" for i in range(40))
    story = "".join(f"<p>Sentence number {i} of a story that goes on for a while, as stories do.</p>" for i in range(8))
    page = f"<body><div class=x><ul>{menu}</ul></div><div class=y>{story}</div><div class=z><a href=1>more</a> <a href=2>links</a></div></body>"
    text = html_text.main_text(page)
    assert text.count("\n") == 7 and text.startswith("Sentence number 0") and "menu" not in text


@pytest.mark.parametrize("after", ["", "<ul>" + "".join(f"<li><a href={i}>elsewhere {i}</a>" for i in range(60)) + "</ul>"])
@pytest.mark.parametrize("wrap", ["{}", "<div class=page>{}</div>"])
def test_html_sections_without_article(wrap, after):
    part = lambda name, n: "<div>" + "".join(f"<p>Paragraph {i} of the {name} part, which has a few words to say.</p>" for i in range(n)) + "</div>"
    body = "<h1>Headline</h1>" + part("first", 6) + part("second", 4)
    want = ["Headline"] + [f"Paragraph {i} of the {name} part, which has a few words to say." for name, n in (("first", 6), ("second", 4)) for i in range(n)]
    page = "<body>" + wrap.format(body) + after + "</body>"
    assert html_text.main_text(page).split("\n") == want


def test_html_heading_of_links_is_left_out():
    story = "<div>" + "".join(f"<p>Sentence {i} of a story that goes on for a while, as stories do.</p>" for i in range(6)) + "</div>"
    links = "<h2>Elsewhere</h2><ul>" + "".join(f"<li><a href={i}>entry {i}</a>" for i in range(40)) + "</ul>"
    text = html_text.main_text(f"<body><h1>Title</h1>{story}{links}</body>")
    assert text.startswith("Title\nSentence 0") and text.count("\n") == 6 and "Elsewhere" not in text and "entry" not in text


@pytest.mark.parametrize("source, want", [
    (None, ""), ("", ""), ("no tags  at\nall", "no tags at all"), ("<p>a<p>b", "a\nb"), ("a < b <3", "a < b <3"),
    ("<p>x</b></i></p>y", "x\ny"), ("<div>a<script>b", "a"), ("<p>cut <a href='", "cut"), ("<![CDATA[<p>]]>", "<p>"), ("&#65;&eacute;", "Aé")])
def test_html_odd_sources(source, want):
    assert html_text.main_text(source) == want


def test_html_names_inside_an_article():
    """Plain words in longer names do not drop an article's text; names of page parts and link lists do."""
    keep = '<p class="social-science">One study.</p><div class="share-price"><p>It rose by ten.</p></div><p id="recommended-dose">Two a day.</p><p class="market-share">A third.</p>'
    drop = ('<div class="share-buttons">Post it</div><div class="post-comments"><p>I do not agree with this.</p></div><div class="comment-list">Me too, says one.</div>'
            '<div class="related-coverage"><a href=1>Other story</a> <a href=2>Third story</a></div><p class="share">Tell others</p>')
    story = "".join(f"<p>Sentence {i} of a story that goes on for a while, as stories do.</p>" for i in range(5))
    text = html_text.main_text(f"<body><article><h1>Title</h1>{story}{keep}{drop}</article></body>")
    assert text.split("\n")[-4:] == ["One study.", "It rose by ten.", "Two a day.", "A third."] and text.count("\n") == 9


def test_html_references_end_with_their_node():
    assert html_text.main_text("<p>x &<b>amp;</b> y &amp;amp; &#x41<i>1;</i></p>") == "x &amp; y &amp; A1;"


def test_html_long_and_deep():
    assert html_text.main_text("<div>" * 50_000 + "deep") == "deep"
    assert len(html_text.main_text("<p>word</p>" * 50_000)) == 5 * 50_000 - 1


def test_html_extract(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, "x"), (None, None, None, "x"), (1, "u", PAGE, "x")], "page_id long, url string, html string, text string")
    out = html_text.extract(pages).orderBy("page_id").collect()
    assert [r["n_chars"] for r in out] == [0, len(out[1]["text"]), len(out[1]["text"])] and out[0]["text"] == ""
    assert html_text.extract(spark.createDataFrame([], pages.schema)).collect() == []


def random_page(pick):
    """A page of nested sections, paragraphs, lists of links and page parts, with all its end tags."""
    words = lambda most: " ".join(pick.choice(["word", "of", "story", "two", "longer &amp; longer", "É", "sentences"]) for _ in range(pick.randrange(1, most)))

    def inline():
        kind = pick.random()
        return f"<a href=x>{words(5)}</a>" if kind < 0.2 else f"<b>{words(4)}</b>" if kind < 0.3 else "<br>" if kind < 0.35 else words(25)

    def block(depth):
        kind = pick.random()
        if kind < 0.45 or depth > 4:
            return "<p>" + " ".join(inline() for _ in range(pick.randrange(4))) + "</p>"
        if kind < 0.55:
            return "<h2>" + (f"<b>{words(4)}</b>" if pick.random() < 0.3 else words(6)) + "</h2>"
        if kind < 0.65:
            return "<ul>" + "".join(f"<li><a href=x>{words(4)}</a></li>" for _ in range(pick.randrange(8))) + "</ul>"
        tag = pick.choice(["div"] * 6 + ["section", "blockquote", "article", "main", "nav", "aside", "footer", "form"])
        name = pick.choice(['', '', '', ' class="story"', ' class="sidebar"', ' class="comments"', ' class="x"'])
        return f"<{tag}{name}>" + pick.choice(["", " ", words(6)]) + "".join(block(depth + 1) for _ in range(pick.randrange(6))) + f"</{tag}>"

    return "<html><head><title>T</title><script>var a = 1 < 2;</script></head><body>" + "".join(block(0) for _ in range(pick.randrange(1, 8))) + "</body></html>"


def test_html_against_brute_force(spark):
    pick = random.Random(3)
    pages = [random_page(pick) for _ in range(400)]
    cut = {"head", "title", "script", "nav", "aside", "footer", "form"}
    blocks = {"body", "head", "title", "p", "h2", "ul", "li", "div", "section", "blockquote", "article", "main", "nav", "aside", "footer", "form"}
    want = [brute.main_text(p, cut, {"sidebar", "comments"}, blocks) for p in pages]
    table = spark.createDataFrame([(i, "u", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_text.extract(table).collect()}
    assert [k for k, w in enumerate(want) if got[k] != w] == []
    assert len(set(want)) > 300 and sum(0 < len(w) < len(html_text.re.sub("<[^>]*>", "", p)) * 0.8 for p, w in zip(pages, want)) > 100


def judge(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = rest[:cut].translate(brute.LOWER)
    path = rest[cut:].split("?")[0].split("#")[0]
    fit = []
    for verdict, rule in rules:
        h, p = rule[:rule.index("/")], rule[rule.index("/"):]
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            fit.append((-len(rule), -len(h), rule, verdict != "block", verdict))
    best = min(fit, default=None)
    return host, path, best and best[2], best[4] if best else "allow"


def test_url_rules(spark):
    pick = random.Random(9)
    part = lambda: pick.choice(["a", "b", "ab"])
    rules = {(pick.choice(["allow", "block"]), ".".join(part() for _ in range(pick.randrange(1, 4))) + "/" + part() * pick.randrange(3) + "/" * pick.randrange(2))
             for _ in range(30)}
    urls = [f"http{'s' * (i % 2)}://{'.'.join(part() for _ in range(pick.randrange(1, 5)))}/{'/'.join(part() * 2 for _ in range(3))}?q#f" for i in range(300)]
    urls += [None, "", "no scheme/a", "x://", "x://A.B", "x://a?b/c", "x://a#/b", "x://a/b://c/d", "x://a\nb/ab", urls[3]]
    rows = [(i if i % 9 else None, u, "extra", "key") for i, u in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, key string")
    got = url_filter.judge_urls(pages, url_filter.rules_frame(spark, sorted(rules))).collect()
    want = [(i, *judge(u, rules)) for i, u, *_ in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert url_filter.judge_urls(spark.createDataFrame([], pages.schema), url_filter.rules_frame(spark)).collect() == []


def test_many_rules_of_one_host(spark):
    """The time of 20,000 rules of one area is that of a join, not of all their pairs."""
    rules = [("block" if i % 2 else "allow", f"host.org/{i % 100}/{i}") for i in range(20_000)] + [("block", "org/"), ("allow", "host.org/7")]
    pages = spark.createDataFrame([(i, f"http://www.host.org/{i % 100}/{i}x") for i in range(0, 20_000, 7)], "page_id long, url string")
    began = time.time()
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.judge_urls(pages, url_filter.rules_frame(spark, rules)).collect()}
    assert time.time() - began < 30
    assert got == {i: (f"host.org/{i % 100}/{i}", "block" if i % 2 else "allow") for i in range(0, 20_000, 7)}


@pytest.fixture(scope="module")
def vocab():
    return sentencepiece_nbest.vocabulary()


def test_nbest_of_words(vocab):
    for word in (" the", " hello", " straße", " 日本", "aaaa", " a▁b", "\n", "   x"):
        text = sentencepiece_nbest.escape(word)
        every = brute.segmentations(text, vocab.scores, vocab.byte_ids, sentencepiece_nbest.BYTE_SCORE)
        if "\0" in text:
            continue  # a mark of the text's own is encoded as its bytes
        got = sentencepiece_nbest.nbest_word(word, vocab, 5)
        assert [round(s, 3) for s, _ in got] == [round(s, 3) for s, _ in every[:5]]
        assert {p for _, p in got} <= {p for _, p in every}


def test_nbest_of_texts(vocab):
    text = "the cat sat on"
    words = sentencepiece_nbest.split_words(text)
    assert "".join(words) == " " + text
    best = [brute.segmentations(sentencepiece_nbest.escape(w), vocab.scores, vocab.byte_ids, sentencepiece_nbest.BYTE_SCORE)[:4] for w in words]
    sums = [0.0]
    for b in best:
        sums = sorted((s + t for s in sums for t, _ in b), reverse=True)[:4]
    assert [round(s, 3) for s, _ in sentencepiece_nbest.nbest(text, vocab, 4)] == [round(s, 3) for s in sums]


def test_log_probabilities():
    zipf = sentencepiece_nbest.log_probabilities([0.0, -1.0, -3.0, -1e9, -1e9])  # ranks 1, 2, 4, 5, 5
    assert abs(sum(math.exp(x) for x in zipf) - 1) < 0.01 and zipf[3] == zipf[4]
    assert [round(math.exp(zipf[0] - x)) for x in zipf] == [1, 2, 4, 5, 5]
    assert sentencepiece_nbest.log_probabilities([-2.5, -3.25, -1e9]) == [-2.5, -3.25, -4.25]
    with pytest.raises(ValueError):
        sentencepiece_nbest.log_probabilities([-1e9])


def test_weights_follow_the_vocabulary(vocab):
    """Common words that are pieces stay whole; byte pieces are the last resort."""
    assert [vocab.pieces[i] for i in sentencepiece_nbest.nbest("the international", vocab, 1)[0][1]] == ["▁the", "▁international"]
    assert min(s for s, _ in vocab.scores.values()) > sentencepiece_nbest.BYTE_SCORE
    assert all(s * sentencepiece_nbest.STEPS == int(s * sentencepiece_nbest.STEPS) for s, _ in vocab.scores.values())


def test_encode_scores_of_whole_texts(spark, vocab):
    """Scores and sizes per document against all paths of the whole text, word bounds unknown."""
    texts = ["", "a", "the cat sat on the mat", "  two  spaces ", "international relations\nof the theatre", "▁mark of 東京 é\tx", "aaaa aaaa aaaa", "Ünïcödé 👍 word",
             "un deux trois quatre cinq", "\n\n", "the the the the the the"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in sentencepiece_nbest.encode(docs, n=5).collect():
        if not texts[r["doc_id"]]:
            assert (r["scores"], r["sizes"]) == ([0.0], [0])
            continue
        text = sentencepiece_nbest.escape(" " + texts[r["doc_id"]])
        every = brute.best_scores(text, vocab.scores, vocab.byte_ids, sentencepiece_nbest.BYTE_SCORE, 5)
        want = [s for s, (count, _) in every.items() for _ in range(count)][:5]
        assert list(r["scores"]) == want, texts[r["doc_id"]]
        assert all(k in every[s][1] for s, k in zip(r["scores"], r["sizes"]))


def test_encode_round_trip(spark, vocab):
    texts = [None, "", "a", " lead", "two  spaces ", "tab\tand\nline\n\nend", "▁mark ▁▁", "emoji 👍🏽 \u0000 nul", "é" * 500, "x" * 3000, "naïve café 東京"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(None, "a", "x"), (2, "a", "x")], "doc_id long, text string, ids string")
    enc = sentencepiece_nbest.encode(docs)
    out = {r["doc_id"]: r for r in enc.collect()}
    assert enc.count() == len(texts) + 2 and out[0]["ids"] is None and out[1]["ids"] == []
    assert all(out[i]["round_trip"] for i in range(1, len(texts)))
    back = {r["doc_id"]: r["text"] for r in sentencepiece_nbest.decode_ids(enc).collect()}
    assert [back[i] for i in range(len(texts))] == texts
    assert all(list(r["scores"]) == sorted(r["scores"], reverse=True) for r in out.values() if r["scores"])
    assert sentencepiece_nbest.encode(spark.createDataFrame([], docs.schema)).collect() == []


def test_maxscore(spark):
    pick = np.random.default_rng(0)
    x = np.round(pick.normal(size=(400, 12)), 2)
    x[50:120] = x[7]  # ties
    rows = [(int(i), [float(v) for v in r], "x") for i, r in enumerate(x)]
    rows += [(1000, None, "x"), (1020, [1.0, None], "x"), (1040, [float("nan")] * 12, "x"), (1060, [float("inf")] * 12, "x"), (None, rows[0][1], "x"),
             (1080, [], "x"), (1100, [0.5, -0.25], "x"), rows[20], (20, [9.0] * 12, "x")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, terms string")
    live = [(i, tuple(int(np.floor(64 * v)) for v in e)) for i, e, _ in rows
            if i is not None and e is not None and all(v is not None and np.isfinite(v) for v in e)]
    want = []
    for at, (q, a) in enumerate(live):  # every row but the query's own, also those of its id
        if q % 20 == 0:
            found = sorted((-sum(s * t for s, t in zip(a, b)), i) for other, (i, b) in enumerate(live) if other != at)[:20]
            want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found)]
    vectors = materialize(maxscore.vectors_of(table))
    got = maxscore.top_k(vectors.where("vec_id % 20 = 0"), vectors, 20, shard=64, block=8)
    assert sorted(map(tuple, got.collect())) == sorted(want) and sum(q == 20 for q, *_ in want) == 60
    assert maxscore.search_table(spark.createDataFrame([], table.schema)).collect() == []


def test_maxscore_large_components():
    x = np.array([[1 << 31, 3], [1 << 31, 5], [-(1 << 31), 7]], np.int64)
    (ids, scores), = maxscore.maxscore_shard(np.array([1, 2, 3]), np.array([5, 6, 7]), x, np.array([9]), np.array([[1 << 30, 1]], np.int64), 2)
    assert ids.tolist() == [2, 1] and scores.tolist() == [(1 << 61) + 5, (1 << 61) + 3]


def cost_of(pieces):
    return sum({"keep": 0, "merge": 2, "relabel": 3, "relabel+merge": 5, "insert": 4}[p[3]] for p in pieces)


def test_chat_repair_is_optimal():
    pick = random.Random(0)
    for _ in range(150):
        roles = [pick.choice(["system", "user", "assistant", "tool", None]) for _ in range(pick.randrange(1, 6))]
        out = chat_format.repair(roles, [f"t{i}" for i in range(len(roles))])
        cost, states = brute.repair_states(roles)
        assert cost_of(out) == cost
        assert [p[2] for p in out if p[3] != "insert"] == [("system", "user", "assistant")[s - 1] for s in states]


def test_chat_rendering():
    out = chat_format.repair(["user", "user", "assistant", "user"], ["a", "b<|im_end|>", "c", None])
    text = "".join(p[4] for p in out)
    assert text == ("<|im_start|>user\na\nb<\u200d|im_end|><|im_end|>\n<|im_start|>assistant\nc<|im_end|>\n"
                    "<|im_start|>user\n<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n")
    assert chat_format.repair([], []) == []


def test_chats_over_partitions(spark):
    """A conversation that covers all partitions is repaired as if it were in one place."""
    pick = random.Random(7)
    rows = [(5, t, pick.choice(["user", "assistant", "user", "assistant", "system", "tool"]), f"x{t}", 0) for t in range(400)]
    rows += [(c, t, pick.choice(["user", "assistant"]), f"y{t}", 0) for c in (1, 2, 9, None) for t in range(6)]
    rows += [(12, None, None, None, 0), (13, 0, "user", "same", 0), (13, 0, "user", "same", 0)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part int")
    got = {}
    for r in chat_format.format_chats(turns).collect():
        got.setdefault(r["conv_id"], []).append(((-1 if r["turn"] is None else r["turn"]), r["source_role"] or "", r["piece"], r["role"], r["action"], r["rendered"]))
    for conv in {r[0] for r in rows}:
        own = sorted([r for r in rows if r[0] == conv], key=lambda r: (-1 if r[1] is None else r[1], r[2] or ""))
        want = [((-1 if own[t][1] is None else own[t][1]), own[t][2] or "", *p) for t, *p in chat_format.repair([r[2] for r in own], [r[3] for r in own])]
        assert sorted(got[conv]) == sorted(want)
    assert chat_format.format_chats(spark.createDataFrame([], turns.schema)).collect() == []
