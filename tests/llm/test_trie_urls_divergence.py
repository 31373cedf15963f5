"""Prefix trie, URL filters and source divergence, against brute force."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from gridops.llm import prefix_trie, source_divergence, url_filter

NONE = hashlib.sha256(b"").hexdigest()


# --- prefix trie ------------------------------------------------------------------------
def trie_by_hand(rows, group=5, longest=9):
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(x)] for c, x in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % longest
        base = c - (abs(c) % group) * (1 if c >= 0 else -1)
        built[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = collections.defaultdict(list)
    for c, s in built.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    kids = collections.Counter(k[:-1] for k in members if k)
    leaves, saved = collections.Counter(), collections.Counter()
    for k, cs in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += kids[k] == 0
            saved[k[:d]] += (len(cs) - 1) * len(k[-1][1].encode()) if k else 0
    out = []
    for k, cs in members.items():
        ends = sorted(c for c in cs if built[c] == k)
        sha = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        out.append((min(cs), len(k), min(members[k[:-1]]) if k else None, len(cs), kids[k], leaves[k], saved[k], sha))
    return collections.Counter(out)


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
TURNS = "conv_id long, turn long, role string, text string"


def found_trie(df, **params):
    return collections.Counter(tuple(r) for r in prefix_trie.conversation_trie(df, **params).select(*COLUMNS).collect())


def conversations(seed):
    rng = random.Random(seed)
    rows = []
    for c in range(300):
        for t in range(rng.choice([0, 1, 2, 3, 5, 8, 12])):
            rows.append((c, t if rng.random() < 0.95 else None, rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "é", "", None])))
    rows += [(1000 + 5 * i, t, "user", f"the same {t}") for i in range(200) for t in range(3)]  # a hot conversation
    rows += rows[:40]  # repeated rows
    rows += [(-7, 0, "user", "x"), (-5, 0, "user", "y"), (-5, 0, "user", "Y"), (None, 0, "user", "no id"), (7000, 1, "user", "long " * 20_000)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("shard_turns", "merged"), [(100_000, 64), (20, 3), (60, 64)])
def test_trie_is_the_one_by_hand(spark, monkeypatch, shard_turns, merged):
    monkeypatch.setattr(prefix_trie, "MERGED", merged)
    monkeypatch.setattr(prefix_trie, "RUN", 2000 if merged == 64 else 7)
    rows = conversations(merged)
    df = spark.createDataFrame(rows, TURNS).withColumns({"seq": F.lit(1), "number": F.lit("n"), "digest": F.lit("d"), "size": F.lit(0), "place": F.lit("p"), "shard": F.lit(1)})
    assert found_trie(df, shard_turns=shard_turns) == trie_by_hand(rows)


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    assert not found_trie(spark.createDataFrame([], TURNS))
    rows = [(1, 0, "user", "x"), (2, 0, "user", "x")]  # crc32 of 1 and 2 take the absent base's turns
    assert found_trie(spark.createDataFrame(rows, TURNS)) == trie_by_hand(rows)


def test_medians_come_before_their_halves():
    order = list(prefix_trie.medians(100))
    assert sorted(order) == list(range(100)) and order[0] == 50
    trie = prefix_trie.Trie()
    for i in prefix_trie.medians(1023):
        trie.insert([i])

    def height(x):
        return 0 if x < 0 else 1 + max(height(trie.low[x]), height(trie.high[x]))

    assert height(trie.middle[0]) == 10


# --- URL filters ------------------------------------------------------------------------
LIST = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def cut(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host = (m.group(1) if m else "").translate({i: i + 32 for i in range(65, 91)})
    return host, m.group(2) if m else ""


def listed(url):
    host, path = cut(url)
    fit = [(-len(h + p), h + p, v) for h, p, v in LIST if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return min(fit)[1:] if fit else None


def url_tokens(url):
    host, path = cut(url)
    lower = {i: i + 32 for i in range(65, 91)}
    labels = [x for x in host.split(".") if x]
    out = {":" + url.split("://")[0].translate(lower)} if "://" in url else set()
    out |= {"@" + x for x in labels} | ({"." + labels[-1]} if labels else set())
    out |= {"/" + x for x in re.findall(r"[^/._~!$&()*+,;=:@%-]+", path.translate(lower))}
    query = re.match(r"(?s).*?://[^?#]*[?]([^#]*)", url)
    return out | {"?" + x.split("=")[0] for x in (query.group(1).split("&") if query else []) if x}


def verdicts_by_hand(urls, min_share, min_count, confidence):
    labels = {u: listed(u) for u in urls}
    learn = {u: v[1] for u, v in labels.items() if v}
    least = max(min_count, -(-len(learn) * round(min_share * 1e6) // 1_000_000))
    holders = collections.defaultdict(set)
    for u in learn:
        for t in url_tokens(u):
            holders[t].add(u)
    names_of = {}
    for t in sorted(holders, reverse=True):
        if len(holders[t]) >= least:
            names_of[frozenset(holders[t])] = t
    names = sorted(names_of.values())
    item = {t: names_of[frozenset(x)] for t, x in holders.items() if len(x) >= least}
    rules = {}
    for n in (1, 2, 3):
        for combo in itertools.combinations(names, n):
            held = set.intersection(*(holders[t] for t in combo))
            for v in ("allow", "block"):
                support = sum(learn[u] == v for u in held)
                if support >= least and support / len(held) >= confidence:
                    rules[combo, v] = (support, support / len(held))
    best = {r: x for r, x in rules.items() if not any(q[1] == r[1] and set(q[0]) < set(r[0]) and y[1] >= x[1] for q, y in rules.items())}
    out = {}
    for u, label in labels.items():
        fit = [(-conf, -support, v != "block", combo, v) for (combo, v), (support, conf) in best.items() if set(combo) <= {item[t] for t in url_tokens(u) if t in item}]
        out[u] = (*cut(u), label[0] if label else None, label[1] if label else min(fit)[4] if fit else "allow", "list" if label else "mined" if fit else "default")
    return out


def urls_of(seed, n=400):
    rng = random.Random(seed)
    hosts = ["a.example.org", "example.org", "b.example.com", "casino.example.com", "c.example.net", "casino.net", "EXAMPLE.ORG", "notexample.org"]
    paths = ["/en/1", "/en/25", "/es/3", "/fr/8", "/de/9.html", "/de/x", "", "/", "/win/de/", "/fr"]
    tails = ["", "?ref=x&page=2", "#top", "?", "?a=1#b"]
    return [f"{rng.choice(['http', 'HTTPS'])}://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(tails)}" for _ in range(n)]


@pytest.mark.parametrize(("share", "count", "confidence"), [(0.005, 5, 0.8), (0.05, 2, 0.6), (0.3, 1, 0.95)])
def test_urls_are_judged_as_by_hand(spark, share, count, confidence):
    urls = [*urls_of(3), None, "", "no scheme", "http://", "://", "http://h?x=/a", "http://x.org", "http://" + "a." * 3000 + "org/" + "p/" * 3000, "mailto:x@y.com"]
    rows = list(enumerate(urls + urls[:50] + urls[:1] * 300, 1)) + [(None, urls[0])]  # a hot page
    df = spark.createDataFrame(rows, "page_id long, url string").withColumns({x: F.lit(x) for x in ("host", "path", "rule", "token", "tokens", "verdict", "row", "listed")})
    got = url_filter.judge(df, url_filter.url_list(spark, LIST), min_share=share, min_count=count, confidence=confidence)
    got = got.select("row.page_id", "row.url", "row.host", "host", "path", "rule", "verdict", "how").collect()
    want = verdicts_by_hand({u or "" for u in urls}, share, count, confidence)
    assert len(got) == len(rows) and {r[2] for r in got} == {"host"}
    assert collections.Counter(r.page_id for r in got) == collections.Counter(r[0] for r in rows)
    assert {(r[1] or "", tuple(r[3:])) for r in got} == {(u, w) for u, w in want.items()}
    if share < 0.3:
        assert {"list", "mined", "default"} == {r.how for r in got}


def test_a_path_shared_by_many_does_not_multiply_rules(spark):
    deep = "/".join(f"d{i}" for i in range(40))
    rows = [(i, f"http://h{i}.example.com/de/{deep}/{i}") for i in range(60)] + [(100 + i, f"http://h{i}.example.net/{deep}") for i in range(20)]
    out = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string"), url_filter.url_list(spark, LIST)).collect()
    assert {(r.verdict, r.how) for r in out if r.row.page_id >= 100} == {("block", "mined")}


def test_urls_without_labels_or_rows(spark):
    rules = url_filter.url_list(spark, LIST)
    one = spark.createDataFrame([(1, "http://x.net/a")], "page_id long, url string")
    assert [(r.verdict, r.how, r.rule) for r in url_filter.judge(one, rules).collect()] == [("allow", "default", None)]
    assert url_filter.judge(one.limit(0), rules).count() == 0


def test_mined_rules_hold_on_urls_they_have_not_seen(spark):
    urls = sorted({u for u in urls_of(8, 3000)} | {f"https://s{i % 40}.example.com/{x}/{i}" for i in range(2000) for x in ("de", "fr")})
    known = [u for u in urls if listed(u)]
    held_out = [u for u in known if zlib.crc32(u.encode()) % 4 == 0]
    frame = lambda us: spark.createDataFrame([(u, *cut(u), listed(u)[1]) for u in us], "url string, host string, path string, verdict string").withColumn("tokens", url_filter.tokens())
    rules, items = url_filter.mine(frame([u for u in known if u not in set(held_out)]).select("url", "tokens", "verdict"))
    got = {r.url: r.mined for r in url_filter.matched(frame(held_out).select("url", "tokens"), rules, items).collect()}
    right = sum(got.get(u) == listed(u)[1] for u in held_out)
    assert right / len(held_out) >= 0.9


# --- source divergence ------------------------------------------------------------------
def divergences_by_hand(rows, min_docs, top):
    lower = {i: i + 32 for i in range(65, 91)}
    counts, docs, langs = collections.Counter(), collections.Counter(), collections.defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        langs[lang].add(source)
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(lower))
        for w in words:
            counts[lang, source, w] += 1
        for w in set(words):
            docs[lang, w] += 1
    out = []
    for lang, sources in langs.items():
        kept = [w for (x, w), n in docs.items() if x == lang and n >= min_docs]

        def shares(get, kept=kept):
            n = {w: get(w) for w in kept}
            return {w: 1 + 10**9 * (n[w] + 1) // (sum(n.values()) + len(kept)) for w in kept}

        p = {s: shares(lambda w, s=s, lang=lang: counts[lang, s, w]) for s in sources}
        q = shares(lambda w, lang=lang, sources=sources: sum(counts[lang, s, w] for s in sources))
        for s in sources:
            pairs = [(-sum((p[s][w] - p[o][w]) ** 2 // p[o][w] for w in kept), o.encode(), o) for o in sources if o != s]
            terms = [(-((p[s][w] - q[w]) ** 2 // q[w]), w.encode(), w) for w in kept if counts[lang, s, w] and p[s][w] > q[w]]
            out += [(lang, s, "pair", o, -v, i) for i, (v, _, o) in enumerate(sorted(pairs), 1)]
            out += [(lang, s, "term", w, -v, i) for i, (v, _, w) in enumerate(sorted(terms)[:top], 1)]
    return collections.Counter(out)


@pytest.mark.parametrize(("group_block", "term_block", "held"), [(8, 2048, 400_000), (2, 5, 30), (1, 1, 1)])
def test_divergences_are_the_ones_by_hand(spark, monkeypatch, group_block, term_block, held):
    rng = random.Random(term_block)
    monkeypatch.setattr(source_divergence, "HELD", held)
    words = ["the", "The", "été", "Été", "straße", "x1y", "a_b", "Zoo", "日本", "q", "w", "e", "r", "K", "İ"]
    rows = [(rng.choice(["en", "fr", None, ""]), rng.choice(["a", "b", "hot", "hot", "hot", None, "é"]), " ".join(rng.choices(words, k=rng.randint(0, 30)))) for _ in range(200)]
    rows += [("de", "only", "one two three")] * 2 + [("it", "a", "1 2 3"), ("it", "b", None), ("hu", "solo", "szó " * 50_000)] + rows[:30]
    df = spark.createDataFrame(rows, "lang string, source string, text string").withColumns({x: F.lit("9") for x in ("term", "n", "p", "q", "block", "item", "t", "v", "rank")})
    got = source_divergence.divergences(df, group_block=group_block, term_block=term_block, top_terms=5)
    assert collections.Counter(tuple(r) for r in got.select("lang", "source", "part", "item", "value", "rank").collect()) == divergences_by_hand(rows, 3, 5)


def test_divergence_of_nothing(spark):
    assert source_divergence.divergences(spark.createDataFrame([], "lang string, source string, text string")).count() == 0
