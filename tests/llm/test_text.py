"""HTML extraction, decontamination, language ID and the quality classifier."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from lapsewise.llm import decontamination, html_extract, language_id, quality_bayes
from lapsewise.llm.html_extract import Page

ARTICLE = "<article><h1>Title &amp; more</h1><p>One <b>two</b>\n  three<br>four.</p><p><b>Open<br><p>Last &lt;p&gt; &#65;&copy</article>"
TEXT = "Title & more\nOne two three four.\nOpen\nLast <p> A©"


def page(body, head="<title>t</title><style>p{}</style><script>var t='</p>';</script>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


@pytest.mark.parametrize("body", [
    f"<nav><ul><li><a href=/a>Menu</a></ul></nav>{ARTICLE}<footer>foot</footer>",
    f"<header>Site</header><div class='sidebar'>side <p>text</div>{ARTICLE}<div id=comments><p>reader says so much more than the article does, at length, again and again and again</p></div>",
    f"<div class='cookie-notice'>We use cookies</div><!-- <p>hidden --><main>{ARTICLE}</main><form><label>Mail</label><input></form>",
    f"<div class=ad>Buy <span>now</span></div>{ARTICLE}<aside>x</aside><div style='display: none'>no</div><noscript>no</noscript>",
    ARTICLE.replace("</article>", "<script>document.write('<p>no</p>')</script><div class='newsletter'>Join</div></article>"),
])
def test_parts_beside_the_article_go(body):
    p = Page(page(body))
    assert p.text(p.best()) == TEXT


def test_pages_without_an_article_tag():
    p = Page(page("<div class=top><a href=/>Home</a> <a href=/b>More links</a></div><div class='post-content'><p>Long text of the story.</p>"
                  "<ul><li>a<li>b</ul><table><tr><td>c<td>d</table></div><div><a href=x>related related</a></div>"))
    assert p.text(p.best()) == "Long text of the story.\na\nb\nc\nd"
    for broken in ("", "<", "a < b", "<p", "text only", "<p>a<p", "</p></div>x", "<div class='x>y", "<!-- never closed"):
        Page(broken).scores()
    assert Page("text only").text(Page("text only").best()) == "text only"


WORDS = "Words of the story, many of them, one after the other. " * 6


@pytest.mark.parametrize("body", [
    "<div class='page-with-sidebar'>{}<div class=sidebar>short note</div></div>", "<div id='menu-wrapper-all'><nav>x</nav>{}</div>",
    "<div class='has-banner'><div class='banner'>Sale today</div>{}</div>", "<form action=/page><input name=state>{}<label>Search</label></form>",
    "<div class='content has-comments'>{}<div id=comments><p>Nice story, thanks for it</p></div></div>",
    "<div class='comments-open'>{}</div>", "{}<div class='comment-list'>" + "<p>Readers write much more than the author does. </p>" * 60 + "</div>",
    "<div class='post-wrapper ad-free'>{}</div><form class=search><p>Find what you look for</p></form>",
])
def test_wrappers_named_like_a_part_beside_stay(body):
    story = f"<div class=story><p>{WORDS}</p><p>The end.</p></div>"
    p = Page(page(body.replace("{}", story)))
    assert p.text(p.best()) == f"{WORDS.strip()}\nThe end."


@pytest.mark.parametrize("part", [
    "<div class='post-ad'>Buy now</div>", "<div class='entry-share'>Tell your friends</div>", "<section class='related-content'><p>More stories</p></section>",
    "<p>kept <span class='share-count'>12 shares</span></p>", "<div class='article-comments'><article class=comment>I agree</article></div>"])
def test_parts_beside_inside_the_article_go(part):
    p = Page(page(f"<article class='post entry'><p>{WORDS}</p>{part}<p>The end.</p></article>"))
    kept = "\nkept" if "kept" in part else ""
    assert p.text(p.best()) == f"{WORDS.strip()}{kept}\nThe end."


@pytest.mark.parametrize("deep", ["<div>", "<div class=c><span>", "<b>", "<ul><li>", "<table><tr><td>", "<p><i></b>"])
def test_deep_pages_cost_in_proportion(deep):
    import time

    start = time.time()
    p = Page(f"<body>{deep * 100_000}text of the page")
    best = p.best()
    assert p.text(best) == "text of the page" and p.spelled(best).startswith(">body")
    assert time.time() - start < 20


def test_votes_by_brute_force(spark):
    """The counts of votes against pages taken one by one, over random templates."""
    from collections import Counter

    rng = random.Random(4)
    rows = []
    for i in range(150):
        parts = [f"<div class='{rng.choice(['a1', 'a2', 'b', 'side-x'])}'><p>{'word ' * rng.randint(1, 40)}</p></div>" for _ in range(rng.randint(1, 4))]
        rows.append((i, f"http://h{rng.randint(0, 3)}.example/{i}", page("".join(parts))))
    table = spark.createDataFrame(rows, "page_id long, url string, text string").withColumn("host", html_extract.host_of("url"))
    votes, has, spelled = Counter(), Counter(), {}
    for _, url, source in rows:
        p, host = Page(source), url.split("/")[2]
        scores = p.scores()
        votes[host, max(scores, key=lambda k: (scores[k], p.depth[p._first[k]], k))] += 1
        has.update((host, k) for k in scores)
        spelled.update((k, p.spelled(k)) for k in scores)
    want = {k: (votes[k], n) for k, n in has.items() if n > 1 and 2 * votes[k] > n - 1}
    got = {(r.host, bytes(r.path)): (r.votes, r.has) for r in html_extract.census(table).collect()}
    assert got == want and len({spelled[k] for _, k in got}) == len({k for _, k in got})


def test_hosts_vote(spark):
    side = "<div class='box1'><p>{}</p></div><div class='story7'><p>{}</p></div>"
    rows = [(i, f"https://www.Host.example/{i}", page(side.format("note", "the main text of this page is long"))) for i in range(9)]
    # on this page the box is longer, but the host's path wins
    rows += [(9, "http://user@host.example:80/x", page(side.format("a box that holds far more text than usual " * 5, "short story")))]
    rows += [(10, None, page(ARTICLE)), (11, "no url", None), (12, "https://other.example", ""), (13, "//other.example/1", "<p></p>"),
             (9, "http://host.example/x", page("<p>plain</p>"))]
    table = spark.createDataFrame([(*r, "h", "p") for r in rows], "page_id long, url string, html string, host string, path string")
    for limit in (None, 0):
        got = html_extract.extract(table, limit=limit).collect()
        assert len(got) == len(rows)
        by = {(r.page_id, r.url): r for r in got}
        assert by[(9, rows[9][1])].text == "short story" and by[(9, rows[9][1])].path == ">body>div.story#"
        assert by[(10, None)].text == TEXT and by[(9, "http://host.example/x")].text == "plain"
        assert all(by[(i, rows[i][1])].text == "" and by[(i, rows[i][1])].n_chars == 0 for i in (11, 12, 13))
        assert all(r.n_chars == len(r.text) for r in got)
    assert html_extract.extract(table.limit(0)).collect() == []


def test_rare_templates_of_a_host(spark):
    """A template is extracted by its own path, however large its host is."""
    long = "a sentence of the main text of the page. " * 4
    rare = page(f"<div class=box>tip</div><div class=blog><p>{long}</p></div><p>Other words below the story.</p>")
    kinds = [page(f"<p>{long}</p>")] * 40 + [page(f"<div class=box><p>{long}</p></div>")] * 60
    for common in (kinds[:50], kinds):
        pages = [*common, rare, rare, rare]
        table = spark.createDataFrame([(i, f"https://blogs.example/{i}", p) for i, p in enumerate(pages)],
                                      "page_id long, url string, html string")
        for limit in (None, 0):
            got = {r.page_id: (r.path, r.text) for r in html_extract.extract(table, limit=limit).collect()}
            assert {got[len(common) + i] for i in range(3)} == {(">body>div.blog", long.strip())}
            assert got[0][0] == ">body" and got[49][0] == ">body>div.box"


ITEM = "If Anna buys 12 apples and gives Anna 3 of them to Bob how many kg are left after 5 km of walk ok"


def test_decontamination(spark, make_docs):
    rows = [
        (1, f"Some words before. {ITEM} and after"), (2, ITEM.replace("12", "7").replace("Anna", "Carla").replace("Bob", "Dan")),
        (3, ITEM.replace("gives Anna", "gives Eve")), (4, None), (5, ""), (6, "If Anna buys some"), (7, "pre " * 4000 + ITEM),
        (None, ITEM), (1, f"Some words before. {ITEM} and after"), (8, "1 2 3 4 5 6 7 8 9 10"), (9, "rare word"), (10, "x rare word y z u v")]
    items = spark.createDataFrame([(1, ITEM, 0), (2, None, 0), (3, "1 2 3 4 5 6 7 8", 0), (4, "rare word", 0), (None, "", 0)],
                                  "item_id long, text string, pos int")
    for limit in (None, 0):
        got = decontamination.contaminated(make_docs(rows), items, limit=limit).collect()
        assert sorted(((r.doc_id, r.item_id, r.verbatim) for r in got), key=repr) == sorted(
            [(1, 1, True), (2, 1, False), (7, 1, True), (None, 1, True), (8, 3, True), (9, 4, True), (10, 4, True)], key=repr)
    assert {r.doc_id: r.start for r in got}[7] == 4000
    docs = make_docs(rows)
    left = decontamination.clean(docs, items)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [3, 4, 5, 6]
    assert decontamination.contaminated(make_docs([]), items).collect() == []
    assert decontamination.clean(docs, items.limit(0)).count() == len(rows)


OPENING = "Tom buys 12 apples. Tom eats 3 apples. How many apples does Tom have left?"


def test_names_that_open_a_sentence(spark, make_docs):
    other = OPENING.replace("12", "15").replace("3", "4")
    rows = [(1, other.replace("Tom", "Mia")), (2, "She asked how it was. " + other.replace("Tom", "Mary Ann")),
            (3, other.replace("Tom eats", "Eve eats")), (4, "Tom buys 12 pears. Who knows how many?"),
            (5, f"And how? {OPENING}"), (6, other.replace("Tom", "Anne-Marie O'Neil"))]
    items = spark.createDataFrame([(1, OPENING)], "item_id long, text string")
    for limit in (None, 0):
        got = decontamination.contaminated(make_docs(rows), items, limit=limit).collect()
        assert sorted((r.doc_id, r.verbatim, r.start) for r in got) == [
            (1, False, 0), (2, False, 5), (5, True, 2), (6, False, 0)]


def test_short_and_dense_items(spark, make_docs):
    sums, dense = "What is 48 + 27 - 13?", "Add 1 2 3 4 5 6 7 8 9 to get 45 or 46 47 48 49 50 51"
    rows = [(1, f"A task for you. {sums} Please answer."), (2, "What is 48 + 27 - 14?"), (3, "now rare little word here"),
            (4, f"so {dense} it was"), (5, f"so {dense.replace('51', '52')}"), (6, "add 1 2 3 4 5 6 7 8 9 to get"),
            (7, dense.replace("9", "x")), (8, "rare little")]
    items = spark.createDataFrame([(1, sums), (2, "rare little word"), (3, dense)], "item_id long, text string")
    for limit in (None, 0):
        got = decontamination.contaminated(make_docs(rows), items, limit=limit).collect()
        assert sorted((r.doc_id, r.item_id, r.verbatim, r.start) for r in got) == [
            (1, 1, True, 4), (2, 1, False, 0), (3, 2, True, 1), (4, 3, True, 1), (5, 3, True, 1)]


def test_short_items_by_brute_force(spark, make_docs):
    """Items without a full set of windows against all places of all documents: as a whole template with
    consistent slots, or word by word."""
    rng = random.Random(8)
    vocabulary = ["add", "what", "is", "the", "sum", "of", "and", "7", "12", "30", "45"]
    fold = lambda t: t.split()
    items = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 6))) for _ in range(40)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 40))) for _ in range(120)]
    number = lambda w: w.isdigit()

    def holds(item, text):
        a, b = fold(item), fold(text)
        plain = sum(not number(w) for w in a)
        for i in range(len(b) - len(a) + 1):
            part, slots = b[i: i + len(a)], {}
            if part == a and (len(a) >= (2 if plain else 4) or len(a) == len(b) and plain):
                return True
            fits = all(number(x) == number(y) and (number(x) or x == y) for x, y in zip(a, part))
            if fits and plain >= (2 if len(a) < 5 else 1) and all(slots.setdefault(x, y) == y for x, y in zip(a, part) if number(x)):
                return True
        return False

    def short(item):
        """No window of five tokens with three literals from every token on."""
        a = fold(item)
        return len(a) < 5 or not all(sum(not number(w) for w in a[i: i + 5]) >= 3 for i in range(len(a) - 4))

    items = [i for i in items if short(i)]
    table = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.contaminated(make_docs(list(enumerate(texts))), table).collect()}
    want = {(d, i) for d, t in enumerate(texts) for i, x in enumerate(items) if holds(x, t)}
    # items with some window may also be found by most of their windows
    assert want <= got and all(len(fold(items[i])) >= 5 for _, i in got - want)


def test_each_alignment_is_judged(spark, make_docs):
    spoilt = ITEM.replace("gives Anna", "gives Eve")
    words = ITEM.split()
    scattered = " ".join(" ".join([*words[i: i + 5], *["pad"] * 60]) for i in range(len(words) - 4))
    rows = [(1, f"{spoilt} . {ITEM}"), (2, f"{spoilt} . {'pre ' * 500}. {spoilt} . {ITEM.replace('12', '7')}"), (3, scattered),
            (4, ITEM.replace("them to", "them really to").replace("left after", "left over after")), (5, f"{spoilt} . {spoilt}")]
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    for limit in (None, 0):
        got = decontamination.contaminated(make_docs(rows), items, limit=limit, coverage=0.5).collect()
        assert sorted((r.doc_id, r.verbatim) for r in got) == [(1, True), (2, False), (4, True)]
        assert {r.doc_id: r.start for r in got}[1] == len(words)


STEMS = {"en": ["th", "ing", "er", "on", "wh"], "fr": ["eau", "è", "oi", "qu", "ç"], "de": ["sch", "ung", "ß", "ö", "ei"]}


def language_rows(n=240):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        lang = "en fr de".split()[rng.choice([0, 0, 0, 1, 2])]
        words = ["".join(rng.choices(STEMS[lang] + ["a", "e", "n"], k=rng.randint(1, 4))) for _ in range(rng.randint(4, 60))]
        rows.append((i, " ".join(words), lang, "s0"))
    return rows


def test_language_id(spark, make_docs, monkeypatch):
    monkeypatch.setattr(language_id, "TRAIN_PER_LANGUAGE", 60)
    rows = language_rows() + [(900, None, "fr", "s"), (901, "", "en", "s"), (902, "12 !! 3", "de", "s"), (903, "thing", None, "s"),
                              (None, "schung ö", "de", "s"), (904, "thering " * 20000, "en", "s"), (3, "ung sch", "en", "s")]
    docs = make_docs(rows)
    model = language_id.fit(docs.where(~language_id.held_out()))
    assert model.languages == ["de", "en", "fr"] and model.temperature > 0
    out = language_id.predict(docs, model).withColumn("held_out", language_id.held_out()).collect()
    assert len(out) == len(rows)
    held = {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(240)}
    truth = {r[0]: r[2] for r in rows[:240]}
    tested = [r for r in out if r.doc_id in held and r.doc_id != 3 and held[r.doc_id]]
    assert all(r.held_out for r in tested) and len(tested) > 30
    assert sum(r.lang_pred == truth[r.doc_id] for r in tested) >= 0.97 * len(tested)
    assert all(0 <= r.score <= 1 for r in out)
    by = {r.doc_id: r for r in out}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (900, 901, 902))
    assert by[None].lang_pred == "de" and not by[None].held_out and by[904].lang_pred == "en"
    kept = language_id.keep_identified(docs, model)
    assert kept.columns == docs.columns and not {900, 901, 902} & {r.doc_id for r in kept.collect()}


@pytest.mark.parametrize("languages", [{"en"}, {"en", "fr"}, {"en", "fr", "de"}])
def test_unlearned_languages_go(make_docs, languages):
    rows = [r for r in language_rows(400) if r[2] in languages]
    strange = [(900, "привет как дела сегодня хорошая погода и мы идём гулять", None, "s"), (901, "xqzv kjwq zzkx vvqj wxyz " * 9, None, "s"),
               (902, "12 !! 3", None, "s")]
    docs = make_docs(rows + strange)
    kept = {r.doc_id for r in language_id.keep_identified(docs, language_id.fit(docs)).collect()}
    assert kept == {r[0] for r in rows}


def test_shards_do_not_follow_the_sample(spark):
    """A sample of every 4th or 6th row has a like part in each shard."""
    rows = spark.range(24000).select(F.xxhash64(F.lit("sample"), "id").alias("draw"))
    for every in (1, 2, 4, 6, 8):
        sample = rows.where(F.pmod("draw", F.lit(every)) == 0)
        parts = {r.s: r["count"] for r in sample.groupBy(language_id.shard_of(F.col("draw")).alias("s")).count().collect()}
        assert len(parts) == language_id.SHARDS and min(parts.values()) > 0.8 * sum(parts.values()) / language_id.SHARDS


def test_language_id_without_examples(make_docs):
    docs = make_docs([(1, "abc", None, "s"), (None, "abc", "en", "s")])
    assert language_id.fit(docs) is None and language_id.fit(make_docs([])) is None
    assert {r.lang_pred for r in language_id.predict(docs, None).collect()} == {"und"}
    assert language_id.keep_identified(docs, None).count() == 2  # nothing learned, nothing rejected


def test_quality(spark, make_docs):
    rng = random.Random(6)
    rows, labels = [], []
    for i, (_, text, lang, _) in enumerate(language_rows(400)):
        good, toxic = rng.random() > 0.3, rng.random() < 0.2
        words = text.split()
        if not good:
            words = [w + "$$$" for w in words]
        if toxic:
            words[rng.randrange(len(words))] = "scumbag"
        rows.append((i, " ".join(words), lang, "big" if i % 3 else f"site{i % 40}"))
        if i % 2 == 0:
            labels.append((i, int(good), int(toxic)))
    truth = {i: ("$$$" not in t, "scumbag" in t) for i, t, _, _ in rows}
    rows += [(900, None, None, None), (901, "", "en", "s"), (None, "thing ing", "en", "big"), (3, "thing", "en", "big"), (902, "la " * 50000, "en", "big")]
    table = spark.createDataFrame(labels + [(None, 1, 0), (900, None, None)], "doc_id long, quality int, toxic int")
    classify = lambda docs, labels, **kw: quality_bayes.classify(
        docs, labels, F.col("source"), F.concat_ws("/", "source", "lang"), **kw)
    for limit in (None, 0):
        out = classify(make_docs(rows), table, limit=limit).collect()
        assert len(out) == len(rows) and all(0 <= p <= 1 for r in out for p in (r.quality, r.toxic))
        tested = [r for r in out if r.doc_id is not None and r.doc_id % 2 and r.doc_id in truth and r.doc_id != 3]
        right = [(r.quality >= 0.5) == truth[r.doc_id][0] for r in tested]
        caught = [not r.keep for r in tested if truth[r.doc_id][1]]
        assert sum(right) >= 0.95 * len(right) and sum(caught) >= 0.9 * len(caught)
    assert classify(make_docs([]), table).collect() == []
    assert {round(r.quality, 6) for r in classify(make_docs(rows[:5]), table.limit(0)).collect()} == {0.5}


def test_sparse_sites_shrink(spark):
    """A path with few documents stays near its parent, a full one shows its own rate."""
    scored = spark.createDataFrame(
        [("a", "a/full", 3.0, 0.0)] * 500 + [("a", "a/thin", 3.0, 0.0)] + [("b", "b/full", -3.0, 0.0)] * 500 + [("b", "b/thin", 3.0, 0.0)],
        "host string, path string, quality double, toxic double")
    shift = {r.path: r.quality_shift for r in quality_bayes.site_posteriors(scored).collect()}
    assert shift["a/full"] > 1 and shift["b/full"] < -1
    assert shift["b/thin"] < 0 < shift["a/thin"]
