"""Sharding, mixing, top-k search, PII and HTML extraction, against brute force."""

import collections
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from gridops.llm import html_extract, mixing, pii, sharding, topk_search

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(9)
    rows = []
    for i in range(600):
        text = " ".join("w" * rng.randint(1, 9) for _ in range(int(rng.paretovariate(0.8)) % 3000))
        rows.append((i, text, "en", rng.choice(["a", "b", "c", None, "é", "a", "a"]), 0))
    rows += [(1000 + i, "same text in every one of these", "en", "a", 0) for i in range(400)]
    rows += [(5, rows[5][1], "en", rows[5][3], 0)] * 30 + [(None, None, None, None, None), (7000, None, None, "b", 1), (7001, "", None, "b", 1), (7002, " \n", None, "zero", 1)]
    return spark.createDataFrame(rows, DOCS).withColumns({"shard": F.lit("x"), "range": F.lit(1), "k": F.lit(2), "bucket": F.lit("b"), "key": F.lit("q")})


def multiset(df, *cols):
    return collections.Counter(map(str, (tuple(r) for r in df.select(*cols).collect())))


@pytest.mark.parametrize("n_shards", [1, 7, 40])
def test_shards_hold_all_rows_near_equal_and_gapless(spark, docs, n_shards):
    out = sharding.shard(docs, n_shards)
    assert multiset(out.select("row.*"), *docs.columns) == multiset(docs, *docs.columns)
    rows = out.select("row.doc_id", "row.text", "size", "shard", "slot").collect()
    slots = collections.defaultdict(list)
    load = collections.Counter()
    for r in rows:
        assert r.size == len((r.text or "").encode()) + 16
        slots[r.shard].append(r.slot)
        load[r.shard] += r.size
    assert all(sorted(x) == list(range(len(x))) for x in slots.values()) and set(slots) <= set(range(n_shards))
    # near equal, but for one record at either end of a shard
    assert max(load.values()) <= sum(load.values()) / n_shards + 2 * max(r.size for r in rows)
    if n_shards == 40:
        parts = {r.shard for r in rows if r.text == "same text in every one of these"}
        assert max(parts) - min(parts) == len(parts) - 1  # equal texts are neighbours


def test_hot_group_is_cut_and_runs_agree(spark):
    same = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("one text for all").alias("text"))
    one = sharding.shard(same, 10)
    sizes = collections.Counter(r.shard for r in one.collect())
    assert len(sizes) == 10 and max(sizes.values()) < 1.2 * min(sizes.values())
    again = sharding.shard(same, 10)
    cols = ("row.doc_id", "shard", "slot")
    assert multiset(one, *cols) == multiset(again, *cols)


def brute_targets(sizes, weights=(5, 2, 1), cap=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, done = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in done]
        left = total - sum(done.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > cap * sizes[s]]
        if not over:
            return done | share
        done |= {s: float(cap * sizes[s]) for s in over}


def test_mix_comes_to_the_targets(spark, docs):
    plan = mixing.mix_plan(docs, shards=8, blocks_per_shard=256)
    rows = plan.select("row.doc_id", "row.text", "row.source", "size", "source_size", "target", "draws").collect()
    assert len(rows) == docs.count()
    size, taken, most = collections.Counter(), collections.Counter(), collections.Counter()
    for r in rows:
        assert r.size == len(re.findall(rb"[^\x20\x09-\x0D]+", (r.text or "").encode()))
        size[r.source] += r.size
        taken[r.source] += r.size * len(r.draws)
        most[r.source] = max(most[r.source], r.size)
        assert len(r.draws) <= 3 and len({d["repeat"] for d in r.draws}) == len(r.draws)
        assert all(0 <= d["shard"] < 8 for d in r.draws)
    want = brute_targets(dict(size))
    for r in rows:
        assert r.source_size == size[r.source] and math.isclose(r.target, want[r.source], rel_tol=1e-9, abs_tol=1e-9)
    for s in size:
        assert abs(taken[s] - want[s]) <= most[s] / 2 + sum(size.values()) / (8 * 256) + 1
    again = mixing.mix_plan(docs.repartition(5), shards=8, blocks_per_shard=256)
    assert multiset(again, "row.doc_id", "size", "target", "draws") == multiset(plan, "row.doc_id", "size", "target", "draws")


def test_capped_sources_are_taken_whole(spark):
    rows = [(i, "a b c d", "en", "big", 0) for i in range(300)] + [(1000 + i, "x y", "en", "aaa", 0) for i in range(10)]
    plan = mixing.mix_plan(spark.createDataFrame(rows, DOCS), shards=4).collect()
    small = [len(r.draws) for r in plan if r.row.source == "aaa"]
    assert set(small) == {3}


def test_tree_deals_each_quota_exactly_and_evenly(spark):
    quotas = {"a": 900, "b": 90, "c": 10, "d": 0}
    q = spark.createDataFrame(list(quotas.items()), "key string, quota long")
    spread = collections.Counter()
    for seed in range(6):
        got = mixing.splitting_tree(q, 13, seed).collect()
        assert collections.Counter(r.key for r in got) == {k: n for k, n in quotas.items() if n}
        assert len({(r.key, r.block) for r in got}) == 1000
        per = collections.Counter(r.shard for r in got)
        assert set(per) == set(range(13)) and max(per.values()) - min(per.values()) <= 4
        spread.update(r.shard for r in got if r.key == "b")
    assert max(spread.values()) < 3 * min(spread.values())  # 540 draws over 13 shards, 41 each


def test_the_tree_decides_what_is_drawn_and_where(spark, docs, monkeypatch):
    plan = mixing.mix_plan(docs, shards=8, blocks_per_shard=64).select("row.doc_id", "size", "draws").collect()
    words, blocks = collections.Counter(), collections.defaultdict(set)
    for r in plan:
        for d in r.draws:
            words[d["shard"]] += r.size
            blocks[d["shard"]].add(d["block"])
    assert set(words) == set(range(8))  # every shard gets its share of the words
    assert max(words.values()) < 1.5 * min(words.values()) + 2 * max(r.size for r in plan)
    tree = mixing.splitting_tree
    monkeypatch.setattr(mixing, "splitting_tree", lambda q, shards, seed=0: tree(q, shards, seed).filter("false"))
    assert all(not r.draws for r in mixing.mix_plan(docs, shards=8, blocks_per_shard=64).collect())
    # dealt the other way round, every document goes to the other end
    monkeypatch.setattr(mixing, "splitting_tree", lambda q, shards, seed=0: tree(q, shards, seed).withColumn("shard", F.lit(shards - 1) - F.col("shard")))
    other = mixing.mix_plan(docs, shards=8, blocks_per_shard=64).select("row.doc_id", "size", "draws").collect()
    placed = lambda rows, turn: sorted(str((r.doc_id, r["size"], [(d["repeat"], 7 - d["shard"] if turn else d["shard"]) for d in r.draws])) for r in rows)
    assert placed(other, True) == placed(plan, False)


def test_the_tree_ranks_in_buckets_as_in_one_group(spark, monkeypatch):
    q = spark.createDataFrame([(f"s{i}", 1 + i % 7) for i in range(200)], "key string, quota long")
    whole = multiset(mixing.splitting_tree(q, 5), "key", "block", "shard")
    monkeypatch.setattr(mixing, "RANKED", 20)
    assert multiset(mixing.splitting_tree(q, 5), "key", "block", "shard") == whole


def test_targets_of_many_sources(spark):
    rng = random.Random(2)
    sizes = {f"h{i}": int(rng.paretovariate(0.7)) for i in range(3000)} | {None: 7, "zero": 0}
    df = spark.createDataFrame([(str(s), s, n) for s, n in sizes.items()], "key string, source string, source_size long").repartition(7)
    want = brute_targets(sizes)
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    assert set(got) == set(want) and all(math.isclose(got[s], want[s], rel_tol=1e-9, abs_tol=1e-9) for s in want)
    plan = mixing.targets(df)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_mixed_rows_are_documents(spark, docs):
    out = mixing.mixed(docs, shards=4)
    assert set(multiset(out.select("row.*"), *docs.columns)) <= set(multiset(docs, *docs.columns))


def test_top_k_is_exact(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(12)], 0) for i in range(700)]
    rows += [(700 + i, [0.1] * 12, 0) for i in range(40)]  # ties
    rows += [(1000, None, 0), (1001, [1.0] * 11 + [None], 0), (1002, [float("nan")] * 12, 0), (1050, [float("inf")] * 12, 0), (None, [1.0] * 12, 0), (1100, [], 0), (1150, [2.0], 0), (50, rows[50][1], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("block", F.lit("x"))
    import numpy as np

    # rows, not ids: a repeated row is a query and a candidate of its own
    good = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, _ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for at, (q, own) in enumerate(good):
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(own, v, strict=False)), i) for n, (i, v) in enumerate(good) if n != at)[:5]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scored)]
    assert sorted(tuple(r) for r in topk_search.top_k(df).collect()) == sorted(want)


@pytest.mark.parametrize("block,batch", [(37, 3), (5, 100)])
def test_top_k_over_many_blocks(spark, monkeypatch, block, batch):
    monkeypatch.setattr(topk_search, "BLOCK", block)
    monkeypatch.setattr(topk_search, "BATCH", batch)
    test_top_k_is_exact(spark)


def test_copies_are_candidates_each(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (1, [2.0]), (1, [2.0]), (2, [1.5]), (0, [0.5])], "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in topk_search.top_k(df, k=4).collect())
    assert got == sorted([(0, r, 1, 256 * 512) for r in (1, 2, 3)] + [(0, 4, 2, 256 * 384)] + [(0, r, 1, 128 * 512) for r in (1, 2, 3)] + [(0, 4, 2, 128 * 384)])


def test_top_k_of_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [0.5, 0.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk_search.top_k(df).collect()] == [(0, 1, 1, 256 * 128)]
    assert topk_search.top_k(df.filter("false")).count() == 0


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(x) * (1 + k % 2) for k, x in enumerate(reversed(digits))]
    return sum(x - 9 if x > 9 else x for x in doubled) % 10 == 0


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    return {
        "email": True, "ip": all(int(x) <= 255 for x in match.split(".")) if kind == "ip" else False,
        "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15,
    }[kind]


def test_base_spans_are_those_of_the_patterns(spark):
    rng = random.Random(12)
    bits = ["a@b.c", "x_y%z@q-r.s.t", ".", "@", "+", "1", "12.3", ".4", "255", "256", " ", "-", "(", ")", "é", "ñ ", "4111111111111111", "4111 1111 1111 1111", "+1 (555) 010-9999", "10.0.0.1", "\n", "b"]
    rows = [(i, "".join(rng.choices(bits, k=rng.randint(0, 30)))) for i in range(500)]
    rows += [(900, None), (901, "9" * 30_000), (902, "a" * 30_000 + "@"), (903, "1-" * 9_000), (904, "+1" + " " * 9_000), (905, "x@" * 4_000), (5, rows[5][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"base": F.lit(1), "spans": F.lit("s"), "x": F.lit(0)})
    got = sorted((r.doc_id, r.b) for r in pii.find_spans(df, keep=["doc_id"]).select("row.doc_id", pii.listed("base").alias("b")).collect())

    def spans(text):
        return ",".join(f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS.items() for m in re.finditer(p, text) if passes(k, m[0]))

    assert got == sorted((i, spans(t or "") if len(t or "") < 20_000 else "") for i, t in rows)


def test_trees_add_look_alikes_and_leave_clean_texts(spark):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        number = f"({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
        rows.append((i, f"please call +1 {number} today" if i % 2 else f"serial {rng.randint(10**11, 10**12)} of the part, {rng.randint(1, 9)}.{rng.randint(300, 999)}.1.2"))
    rows += [(1000, "please call (415) 555-2671 today"), (1001, "nothing to see here, chapter 12 of 30")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    score, least = pii.learn(df)
    assert score and "phone" in least
    out = {r.doc_id: (r.b, r.s) for r in pii.find_spans(df, keep=["doc_id"]).select("row.doc_id", pii.listed("base").alias("b"), pii.listed("spans").alias("s")).collect()}
    assert out[1000] == ("", "phone:12:26") and out[1001] == ("", "")
    assert all(s.startswith(b) or b in s for b, s in out.values())
    red = {r.row.doc_id: r.redacted for r in pii.redact(df).collect()}
    assert red[1] == "please call [PHONE] today" and red[1001] == rows[-1][1]


def test_trees_and_thresholds_come_from_all_matches(spark, monkeypatch):
    text = "concat('please call +1 (415) 555-', 1000 + id % 9000, if(id % 3 = 0, concat(', number 4111 1111 1111 ', 1000 + id % 9000), ''), ' and x', id, '@b.c today')"
    docs = spark.range(30_000).selectExpr("id as doc_id", f"{text} as text")
    fitted, fit = [], pii._fit
    monkeypatch.setattr(pii, "_fit", lambda cells, *rest: fitted.append(cells.agg(F.sum("weight")).first()[0]) or fit(cells, *rest))
    score, least = pii.learn(docs)
    assert score and {"email", "phone"} <= set(least)
    # two halves, then all: an address and a phone number in each text, a card in a third
    assert fitted[0] + fitted[1] == fitted[2] >= 70_000


def test_pii_plan_is_native(spark):
    df = spark.createDataFrame([(1, "a@b.c")], "doc_id long, text string")
    for out in (pii.find_spans(df), mixing.mix_plan(df.withColumn("source", F.lit("s")))):
        assert not re.search("Python|Pandas|Arrow", out._jdf.queryExecution().executedPlan().toString())


PAGE = (
    "<!DOCTYPE html><html><head><title>T &amp; t</title><script>var a='<p>no</p>';</script></head><body>"
    '<header>Site name</header><nav><ul><li><a href="/">Home</a></li></ul></nav><!-- x --><div class="ad">Buy {ad}</div>'
    '<div id="cookie-notice">We use cookies</div><article id="post-{n}"><header><h1>Title {n}</h1></header><p>First <b>bo</b>ld &eacute;&amp;\n text {n}<br>'
    "<p>Second   one {n}</p><form>Your mail</form><div class='comments'>Nice {n}</div><p>Read on</p></article><aside>Old posts</aside><footer>&copy; {n}</footer></body></html>"
)


def test_main_text_of_pages(spark):
    rows = [(i, f"http://a.example/{i}", PAGE.replace("{n}", str(i)).replace("{ad}", "x" * i)) for i in range(12)]
    rows += [(50, "http://b.example/1", PAGE.replace("{n}", "7")), (51, None, None), (52, "http://c.example/x", ""), (53, "no url", "plain &lt;words&gt;\n only"),
             (54, "http://c.example/y", "<div>" * 3000 + "deep" + "</p>" * 10), (55, "http://c.example/z", "<html><body><article><p>cut off <b>he"), (1, rows[1][1], rows[1][2])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"host": F.lit("h"), "main": F.lit("m"), "text": F.lit("t")})
    out = html_extract.main_text(df)
    got = [(r.page_id, r.url, r.text, r.n_chars) for r in out.collect()]
    assert len(got) == len(rows) and all(n == len(t) for _, _, t, n in got)
    text = {i: t for i, _, t, _ in got}
    # "Read on" stands in all sampled pages of a.example, but in the article: it stays
    assert text[3] == "Title 3 First bold é& text 3 Second one 3 Read on"
    assert text[50] == "Title 7 First bold é& text 7 Second one 7 Read on"
    assert (text[51], text[52], text[53]) == ("", "", "plain <words> only")
    assert text[54] == "deep" and text[55] == "cut off he"
    assert html_extract.main_text(df.filter("false")).count() == 0


@pytest.mark.parametrize("shape", ["article", "div"])
def test_an_article_is_whole_whatever_the_number_of_pages(spark, shape):
    """Paragraphs that all pages of a host carry stay in the article; what is around it goes."""
    top, end = ("<article>", "</article>") if shape == "article" else ("<div class='story'>", "</div>")

    def page(host, i):
        body = "".join(f"<p>words {host} {i} of paragraph {k} that no other page has {i * 31 + k}</p>" for k in range(4))
        return (
            f"<html><body><header>{host} news</header><div class='x1'>The house of {host} since 1901</div>{top}<h1>Title {i} of {host}</h1>{body}"
            f"<h2>License</h2><p>This text may be shared under the same terms.</p>{end}<div class='x2'>Imprint and contact of {host}</div><footer>End</footer></body></html>"
        )

    counts = (1, 2, 4, 5, 8, 50)
    rows = [(100 * n + i, f"http://h{n}.example/{i}", page(f"h{n}", i)) for n in counts for i in range(n)]
    rows += [(9000 + i, "http://h8.example/copy", page("h8", 0)) for i in range(200)]  # copies of one page
    out = {r.page_id: r.text for r in html_extract.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for n in counts:
        for i in range(n):
            want = f"Title {i} of h{n} " + " ".join(f"words h{n} {i} of paragraph {k} that no other page has {i * 31 + k}" for k in range(4)) + " License This text may be shared under the same terms."
            if n > 1 or shape == "article":  # a lone page without an article element has no template
                assert out[100 * n + i] == want, (n, i)
            else:
                assert want in out[100 * n + i]


def test_simple_tree_matching_is_maximal():
    a = html_extract.parse("<div><p>1</p><ul><li>x</li></ul><p>2</p></div>")
    b = html_extract.parse("<div><ul><li>y</li><li>z</li></ul><p>2</p></div>")
    found = []
    assert html_extract.tree_match(a, b, "", found) == 5  # root, div, ul, li, p
    assert len(found) == 5


def test_empty_tables(spark, docs):
    none = docs.filter("false")
    assert sharding.shard(none, 40).count() == 0
    assert mixing.mix_plan(none).count() == 0
    assert pii.find_spans(none).count() == 0


def copied(n, extra=""):
    body = "".join(f"<p>Sentence {k} of an article that many pages carry word for word.</p>" for k in range(4))
    return f"<html><body><div class='wrap'><div class='text'><h1>One title</h1>{body}</div><div class='strip'>Offer number {n}{extra}</div></div></body></html>"


def test_article_that_all_pages_of_a_host_carry_stays():
    pages = [copied("x" * (k + 1)) for k in range(9)]
    wrapper = html_extract.induce(pages)
    for page in pages:
        assert "Sentence 0 of" in html_extract.extract(page, wrapper) and "Sentence 3 of" in html_extract.extract(page, wrapper)
    # whatever the wrapper says, a page's text is not template down to nothing
    page = "<html><body><p>All there is</p></body></html>"
    assert html_extract.extract(page, {"main": "/html/body", "constant": frozenset({("/html/body/p", "All there is")})}) == "All there is"
    # copies of one text count once among the sampled pages
    assert len(html_extract._distinct(["<p>a</p>", "<div><p>a</p></div>", "<p>b</p><nav>x</nav>", "<p>b</p>"], 8)) == 2


def plain_page(n, odd=False):
    words = " ".join(f"word{n}x{k}" for k in range(40))
    tail = "Made with care by the web team of this house"
    return f"<html><body><div class='a1'>{'Odd' if odd else 'Our shop, our town, our news'}</div><div class='a2'><p>Text {words}</p><p>Shared line</p></div><div class='a3'><p>{tail}</p></div></body></html>"


@pytest.mark.parametrize("n", [2, 3, 4, 5, 8])
def test_template_of_few_pages_and_with_an_odd_one(n):
    pages = [plain_page(k) for k in range(n)]
    for given in [pages] + [[*pages[:k], plain_page(99, odd=True), *pages[k:]] for k in (0, n)] * (n > 2) + [["<p>one odd page</p>", *pages]] * (n > 2):
        wrapper = html_extract.induce(given)
        for page in pages:
            text = html_extract.extract(page, wrapper)
            assert "Text word" in text and "web team" not in text and "our town" not in text
            assert ("Shared line" in text) == (sum("Shared line" in x for x in given) < 5)  # a paragraph among others


def test_no_part_of_an_article_is_cut():
    body = " ".join(f"word{k}" for k in range(100))
    whole = f"Title Lead of it {body}"
    inner = f"<h1>Title</h1><div class=lead>Lead of it</div><div class=body><p>{body}</p></div>"
    for page in (
        f"<body><article>{inner}</article></body>", f"<body><div class=w>{inner}</div></body>", f"<body class='no-sidebar'>{inner}</body>",
        f"<body><nav>x</nav><article id='social-policy'>{inner}</article></body>", f"<body><div class='share-price-report'>{inner}</div><div class=share>Tell others</div></body>",
        f"<body><main class='widget'>{inner}</main><div class='comments'>{'So good. ' * 200}</div></body>",
    ):
        assert html_extract.extract(page, None) == whole
    # a host's other layout keeps what stands outside the common path
    wrapper = html_extract.induce([f"<body><div class=a><p>{k} {body}</p></div></body>" for k in range(6)])
    assert wrapper["main"].endswith("div.a")
    assert html_extract.extract(f"<body><div class=a><p>Teaser</p></div><div class=b><p>{body}</p></div></body>", wrapper) == f"Teaser {body}"


def test_many_sources_come_to_their_targets(spark):
    # far more sources than blocks: no source's quota is rounded away
    rows = [(s * 100 + i, " ".join(["w"] * 5), "en", f"s{s:03}", 0) for s in range(90) for i in range(24)]
    taken, target = collections.Counter(), {}
    for r in mixing.mix_plan(spark.createDataFrame(rows, DOCS), shards=4, blocks_per_shard=4).collect():
        taken[r.row.source] += r.size * len(r.draws)
        target[r.row.source] = r.target
        assert all(0 <= d["shard"] < 4 for d in r.draws)
    assert len(target) == 90 and all(abs(taken[s] - target[s]) <= 2.5 + 1e-6 for s in target)
    # sources of one document, larger than the targets of some: right on average
    rows = [(s, "a b c d e f g h", "en", f"s{s:03}", 0) for s in range(600)]
    plan = mixing.mix_plan(spark.createDataFrame(rows, DOCS), shards=4, blocks_per_shard=4).collect()
    least = min(r.target for r in plan)
    light = [r for r in plan if r.target == least]
    got = sum(r.size * len(r.draws) for r in light)
    assert len(light) == 200 and least < 4 and 0.7 < got / (200 * least) < 1.3
