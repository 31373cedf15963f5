"""The operators on words of documents, against plain Python brute force."""

import collections
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from gridops.llm import common, decontaminate, jaccard_join, language_id, substring_dedup, token_counts

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows, extra=True):
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)
    # extra columns whose names look like helper columns
    return df.withColumns({"th": F.lit("x"), "key": F.lit(1), "row": F.lit(2), "size": F.lit("z")}) if extra else df


def words(text):
    return WORD.findall((text or "").encode())


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(300)] + ["é", "ñandú", "Wort", "THE"]
    rows = []
    base = [rng.choices(vocab, k=120) for _ in range(8)]
    passage = rng.choices(vocab, k=70)
    for i in range(160):
        w = list(base[i % 8]) if i % 3 else rng.choices(vocab, k=rng.randint(0, 200))
        for _ in range(rng.randint(0, 6)):
            if w:
                w[rng.randrange(len(w))] = rng.choice(vocab)
        if i % 10 == 0:
            at = rng.randint(0, len(w))
            w[at:at] = passage
        rows.append((i, rng.choice([" ", "\n", " \t "]).join(w)))
    rows += [(500, None), (501, ""), (502, " \n\t "), (503, "one"), (504, "one"), (505, "One two"), (506, "one TWO")]
    rows += [(600, "x " * 400), (601, "x " * 400), (602, "y" * 50_000), (3, rows[3][1]), (4, "other text of four")]
    rows += [(None, rows[7][1]), (None, None)]
    return rows


def test_words_and_windows_hash_alike_exactly_when_equal(corpus):
    import pyarrow as pa

    seen = {}
    for lo, hi, data, offsets in common.chunks(pa.array([t for _, t in corpus], pa.string()), 3000):
        w = common.Words(data, offsets)
        for r in range(lo, hi):
            own = words(corpus[r][1])
            a, b = w.first[r - lo], w.first[r - lo + 1]
            assert [data[s:e].tobytes() for s, e in zip(w.start[a:b], w.end[a:b], strict=True)] == own
            for x, h in zip(own, w.hash[a:b].tolist(), strict=True):
                assert seen.setdefault(x, h) == h
    assert len(set(seen.values())) == len(seen)


def shingles(text, n):
    lower = [re.sub(rb"[A-Z]", lambda m: m[0].lower(), x) for x in words(text)]
    if not lower:
        return frozenset()
    return frozenset(tuple(lower[k : k + n]) for k in range(len(lower) - n + 1)) if len(lower) >= n else frozenset([tuple(lower)])


def brute_components(rows, n, percent):
    sets = [(i, shingles(t, n)) for i, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if s and t and i is not None and j is not None and 100 * len(s & t) >= percent * len(s | t):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return sorted(((i, len(s), root(i) if i is not None else None) for i, s in sets), key=str)


@pytest.mark.parametrize("n,percent", [(4, 85), (5, 80), (2, 50)])
def test_jaccard_components_are_exact(spark, corpus, n, percent):
    # an id with two texts is one node of the graph, as in the brute force
    rows = [r for r in corpus if r != (4, "other text of four")]
    got = jaccard_join.jaccard_components(frame(spark, rows), n, percent).select("doc_id", "n_shingles", "component_id")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_components(rows, n, percent)


def test_one_of_each_group_stays_and_wordless_rows_stay(spark, corpus):
    df = frame(spark, corpus).withColumns({x: F.lit("x") for x in ("__id", "__th", "__kth", "rest")})
    kept = jaccard_join.drop_near_copies(df, 5, 80)
    assert kept.columns == df.columns
    parts = collections.Counter(r.doc_id for r in kept.collect())
    found = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(df, 5, 80).collect() if r.doc_id is not None and r.n_shingles}
    assert {i for i in parts if i in found} == set(found.values())
    assert parts[500] == parts[501] == parts[502] == 1 and parts[3] <= 1


def test_of_equal_rows_the_same_one_stays_on_every_run(spark):
    rows = [(1, "one two three four five six", "en", f"s{i}", 0) for i in range(50)]
    runs = {tuple(jaccard_join.drop_near_copies(spark.createDataFrame(rows[k:] + rows[:k], DOCS).repartition(5)).collect()[0]) for k in (0, 13, 31)}
    assert len(runs) == 1


def test_large_regions_join_as_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 7)
    rng = random.Random(2)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(80):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = f"n{i}x{rng.randint(0, 9)}"
        rows.append((i, " ".join(w)))
    got = jaccard_join.jaccard_components(frame(spark, rows), 4, 85).select("doc_id", "n_shingles", "component_id")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_components(rows, 4, 85)


def brute_dedup(rows, n):
    first = {}
    for i, t in rows:
        w = words(t)
        if i is not None:
            for k in range(len(w) - n + 1):
                x = tuple(w[k : k + n])
                first[x] = min(first.get(x, i), i)
    out = []
    for i, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - n + 1):
            if i is not None and first[tuple(w[k : k + n])] < i:
                gone[k : k + n] = [True] * n
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest(), kept.decode()))
    return sorted(out, key=str)


@pytest.mark.parametrize("n", [50, 7, 2])
def test_substring_dedup_is_exact(spark, corpus, n):
    summary, texts = substring_dedup.dedup_substrings(frame(spark, corpus), n)
    got = sorted((tuple(r) for r in summary.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=str)
    want = brute_dedup(corpus, n)
    assert got == [x[:4] for x in want]
    kept = {(x[0], x[4]) for x in want}
    assert {(r.doc_id, r.kept_text) for r in texts.collect()} <= kept


def brute_edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(row[j] + 1, now[-1] + 1, row[j - 1] + (x != y)))
        row = now
    return row[-1]


def test_nearest_passage_is_the_one_by_hand():
    rng = random.Random(8)
    for n in range(300):
        item = rng.choices(range(4), k=rng.randint(1, 70 if n % 10 == 0 else 12))
        text = rng.choices(range(4), k=rng.randint(0, 30))
        assert list(decontaminate.distances(item, text, anchored=True)) == [brute_edit(item, text[:j]) for j in range(1, len(text) + 1)]
        most = len(item) // 3
        all_of_them = [(brute_edit(item, text[i:j]), j, abs(j - i - len(item)), j - i, i) for i in range(len(text)) for j in range(i + 1, len(text) + 1)]
        best = min(all_of_them, default=(most + 1,))
        assert decontaminate.nearest(item, text, most) == ((best[0], best[4], best[3]) if best[0] <= most else None)


def brute_least(item, text):
    """Least edit distance of the item to any passage."""
    row = list(range(len(item) + 1))
    least = row[-1]
    for y in text:
        now = [0]
        for i, x in enumerate(item, 1):
            now.append(min(row[i] + 1, now[-1] + 1, row[i - 1] + (x != y)))
        row = now
        least = min(least, row[-1])
    return least


@pytest.mark.parametrize("share", [0.2, 0.1])
def test_recall_against_all_passages_of_all_lengths(spark, share):
    """Words replaced, left out, put in, or all of these, in items of 1 to 60 words, inside a
    text or as the whole document; and texts of few different words, near items by chance."""
    rng = random.Random(12)
    vocab = [f"v{i}" for i in range(900)]
    items = [rng.choices(vocab, k=w) for w in [*range(1, 13), 15, 18, 20, 24, 25, 30, 36, 40, 50, 60]]
    items += [rng.choices(vocab[:9], k=w) for w in (3, 5, 6, 9)]
    docs = []
    for item in items:
        for kind in ("replace", "leave out", "put in", "mixed"):
            for whole in (True, False, False):
                x = list(item)
                for _ in range(int(len(item) * share + 1e-9)):
                    do, at = kind if kind != "mixed" else rng.choice(["replace", "leave out", "put in"]), rng.randrange(len(x))
                    x[at : at + (do != "put in")] = [] if do == "leave out" else [f"e{rng.randrange(10**6)}"]
                docs.append(x if whole else rng.choices(vocab, k=rng.randint(1, 60)) + x + rng.choices(vocab, k=rng.randint(1, 60)))
    docs += [rng.choices(vocab[:9], k=40) for _ in range(30)]
    known = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    found = decontaminate.find_items(frame(spark, [(i, " ".join(x)) for i, x in enumerate(docs)]), known, share)
    got = {(r.doc_id, r.item_id): r.distance for r in found.collect()}
    want = {(d, i): n for d, x in enumerate(docs) for i, item in enumerate(items) if (n := brute_least(item, x)) <= int(len(item) * share + 1e-9)}
    assert not set(got) - set(want) and all(got[k] >= want[k] for k in got)
    assert len(got) >= 0.99 * len(want), sorted(set(want) - set(got))
    # all planted ones are there
    assert len(want) >= 12 * len(items)


def test_planted_items_are_found_and_clean_documents_are_not(spark):
    rng = random.Random(3)
    vocab = [f"v{i}" for i in range(2500)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.randint(8, 60)))) for i in range(40)]
    docs, planted = [], {}
    for d in range(300):
        w = rng.choices(vocab, k=rng.randint(0, 200))
        if d % 2:
            k = rng.randrange(40)
            x = items[k][1].split()
            for _ in range(rng.randint(0, len(x) // 5)):
                x[rng.randrange(len(x))] = "edited"
            at = rng.randint(0, len(w))
            w[at:at] = [y.upper() if rng.random() < 0.1 else y for y in x]
            planted[d] = k
        docs.append((d, " ".join(w)))
    docs += [(900, None), (901, ""), (902, "single"), (903, docs[1][1]), (903, docs[1][1]), (None, docs[1][1])]
    known = spark.createDataFrame([*items, (70, None), (71, ""), (72, "single"), (72, "single")], "item_id long, text string")
    found = decontaminate.find_items(frame(spark, docs), known)
    got = collections.Counter((r.doc_id, r.item_id) for r in found.collect())
    want = {*planted.items(), (902, 72), (903, planted[1])}
    assert len(want - set(got)) <= 1 and not set(got) - want  # the recall wanted is 0.999
    assert set(got.values()) == {1}
    near = {(r.doc_id, r.item_id): r for r in found.collect()}
    text = dict(docs)
    for (d, k), r in near.items():
        window = [x.lower() for x in text[d].split()[r.start : r.start + r.passage_words]]
        item = [x.lower() for x in dict(items + [(72, "single")])[k].split()]
        assert brute_edit(window, item) == r.distance <= len(item) // 5
    df = frame(spark, docs).withColumns({x: F.lit("x") for x in ("__id", "__th", "found_id", "Found_TH", "found_0")})
    kept = decontaminate.drop_contaminated(df, known)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in docs if d is None or d not in {a for a, _ in want}}


def test_language_spans_and_scores(spark):
    rng = random.Random(4)
    tongues = {"aa": ["kala", "mano", "tiko", "rasa", "lumo"], "bb": ["schtr", "pfung", "ächz", "wurst", "krumpf"], "ru": ["дом", "река", "слово"]}
    rows = []
    for i in range(400):
        lang = list(tongues)[i % 3]
        rows.append((i, " ".join(rng.choices(tongues[lang], k=rng.randint(5, 40))), lang if i % 7 else None, None, 0))
    rows += [(1000, None, "aa", None, 0), (1001, "", "aa", None, 0), (1002, "12 34 --", "bb", None, 0), (1003, "kala " * 30 + "wurst schtr " * 20, None, None, 0), (None, "kala mano", "aa", None, 0)]
    df = spark.createDataFrame(rows, DOCS).withColumn("score", F.lit("clash"))
    model = language_id.train(df)
    out = {r.doc_id: r for r in language_id.identify(df, model).collect()}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert {i for i in range(400) if out[i].doc_id is not None} and held
    assert sum(out[i].lang_pred == list(tongues)[i % 3] for i in held) >= 0.99 * len(held)
    assert [(out[i].lang_pred, out[i].score) for i in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert [(s["lang"], s["first"], s["end"]) for s in out[1003].spans] == [("aa", 0, 30), ("bb", 30, 70)]
    flags = {r.doc_id: r.h for r in df.select("doc_id", language_id.held_out(F.col("doc_id")).alias("h")).collect()}
    assert all(flags[i] == (i in held) for i in range(400)) and flags[None] is False
    kept = language_id.keep_identified(df, model)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, *_ in rows if i not in (1000, 1001, 1002))
    assert {r.lang_pred for r in language_id.identify(df, language_id.train(df.filter("false"))).collect()} == {"und"}


def test_viterbi_is_the_best_path():
    import itertools

    import numpy as np

    rng = np.random.default_rng(1)
    sizes = [0, 1, 5, 7, 3]
    first = np.concatenate([[0], np.cumsum(sizes)])
    scores = rng.normal(size=(first[-1], 3)).astype(np.float32)
    label = language_id.viterbi(scores, first, 0.7)

    def value(path, s):
        return sum(s[t, x] for t, x in enumerate(path)) - 0.7 * sum(a != b for a, b in zip(path, path[1:], strict=False))

    for a, b in zip(first[:-1], first[1:], strict=True):
        best = max(value(p, scores[a:b]) for p in itertools.product(range(3), repeat=b - a)) if b > a else 0
        assert abs(value(label[a:b], scores[a:b]) - best) < 1e-4


def greedy(word, vocabulary):
    n = 0
    while word:
        for k in range(len(word), 0, -1):
            if word[:k] in vocabulary:
                n, word = n + 1, word[k:]
                break
        else:
            n, word = n + len(word[0].encode()), word[1:]
    return n


def test_token_counts_are_greedy_longest_match(spark, corpus):
    rng = random.Random(6)
    for _ in range(60):
        vocabulary = {"".join(rng.choices("abc", k=rng.randint(1, 5))) for _ in range(rng.randint(0, 12))}
        machine = token_counts.Automaton(sorted(vocabulary))
        for _ in range(40):
            word = "".join(rng.choices("abcdé", k=rng.randint(0, 20)))
            assert machine.count(word) == greedy(word, vocabulary)
    pieces = ["▁w", "▁", "w1", "w", "1", "11", "2", "ñan", "▁x", "yyyy", "▁TH"]
    got = sorted((tuple(r) for r in token_counts.token_counts(frame(spark, corpus), pieces).collect()), key=str)
    want = [(i, len(words(t)), sum(greedy("▁" + w.decode(), set(pieces)) for w in words(t)) if len(t or "") < 40_000 else None) for i, t in corpus]
    by = {(a, b): c for a, b, c in got}
    for i, n, tokens in want:
        assert (i, n) in by and tokens in (None, by[i, n])
    assert len(got) == len(corpus)
    assert by[602, 1] == 1 + 50_000 // 4


def test_empty_tables(spark):
    none = frame(spark, [(1, "a")]).filter("false")
    items = spark.createDataFrame([], "item_id long, text string")
    assert jaccard_join.jaccard_components(none).count() == 0
    assert jaccard_join.drop_near_copies(none).count() == 0
    assert all(x.count() == 0 for x in substring_dedup.dedup_substrings(none))
    assert decontaminate.find_items(none, items).count() == 0
    some = frame(spark, [(1, "a b c d"), (None, None)])
    assert decontaminate.drop_contaminated(some, items).count() == 2
    assert language_id.identify(none, language_id.train(none)).count() == 0
    assert token_counts.token_counts(none, ["a"]).count() == 0


def test_texts_of_one_id_have_their_own_links(spark, corpus):
    rng = random.Random(11)
    texts = [[f"{k}v{rng.randint(0, 999)}" for _ in range(100)] for k in range(3)]
    near = lambda k, edit: " ".join([*texts[k][:-1], edit])
    # the smallest id of two groups, and near copies under one id
    rows = [*corpus, (-4, near(0, "a")), (-4, near(1, "a")), (700, near(0, "b")), (701, near(1, "b")), (702, near(0, "c")), (-5, near(2, "a")), (-5, near(2, "b"))]
    named = [r for r in dict.fromkeys(rows) if r[0] is not None]
    found = brute_components([(k, t) for k, (_, t) in enumerate(named)], 5, 80)
    group = {k: root for k, _, root in found}
    least = {root: min(named[k][0] for k in group if group[k] == root) for root in group.values()}
    at = {r: least[group[k]] for k, r in enumerate(named)}
    want = sorted((i, len(shingles(t, 5)), at.get((i, t))) for i, t in rows if i is not None)
    df = frame(spark, rows)
    got = jaccard_join.jaccard_components(df, 5, 80).filter("doc_id IS NOT NULL").select("doc_id", "n_shingles", "component_id")
    assert sorted(tuple(r) for r in got.collect()) == want
    kept = jaccard_join.drop_near_copies(df, 5, 80).collect()
    assert [r.doc_id for r in kept if r.doc_id in (-4, -5, 700, 701, 702)].count(-4) == 2
    assert sum(r.doc_id == -5 for r in kept) == 1 and not {700, 701, 702} & {r.doc_id for r in kept}
