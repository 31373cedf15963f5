"""Language of whole texts: script ranges, per-word scores, Viterbi spans.

Learned: byte trigrams inside words (hashed to ``SLOTS``), as counts for each language over
a bounded sample of labelled documents (``per_language`` documents of each language on
average, picked by a hash), and the scripts that the language's words are written in. A
script is a range of Unicode, read off a character's first UTF-8 byte.

Predicted: the languages that are written in a word's script are its candidates; a
candidate's score is the sum of its trigrams' log probabilities. Over all words of the
text, Viterbi finds the best sequence of languages with a penalty for each switch; its runs
are the spans. The text's language is the one whose spans have most letter bytes (ties: the
first by name), the score their share.

Words are runs outside ``\\x20\\x09-\\x0D`` and keep the language of their neighbours if they
have no letter. A null text, a text without a letter, or nothing learned gives ``und`` with
score 0. Null labels teach nothing. Every input row gives one output row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridops.llm import common as c

SLOTS = 1 << 16
#: Natural-log cost of a switch between neighbouring words.
SWITCH = 8.0
#: Share of a language's letters from which a script counts as its own.
OWN_SCRIPT = 0.01
#: Texts are scored together up to this many bytes, so that the steps of Viterbi are shared.
TOGETHER = 1 << 22

# Scripts by first UTF-8 byte.
SCRIPTS = (
    ("latin", (0x41, 0x5A)), ("latin", (0x61, 0x7A)), ("latin", (0xC3, 0xCA)), ("greek", (0xCD, 0xCF)),
    ("cyrillic", (0xD0, 0xD4)), ("hebrew or armenian", (0xD5, 0xD7)), ("arabic", (0xD8, 0xDB)),
    ("indic or thai", (0xE0, 0xE0)), ("kana", (0xE3, 0xE3)), ("han", (0xE4, 0xE9)), ("hangul", (0xEA, 0xED)),
)

_NAMES = tuple(dict.fromkeys(name for name, _ in SCRIPTS))
_SCRIPT = np.zeros(256, np.int8)  # 0: no letter
for _name, (_lo, _hi) in SCRIPTS:
    _SCRIPT[_lo : _hi + 1] = 1 + _NAMES.index(_name)
_LETTER = (_SCRIPT > 0) | ((np.arange(256) >= 0x80) & (np.arange(256) < 0xC0))
_FOLD = np.where(_LETTER, np.arange(256), 32).astype(np.int64)
_FOLD[0x41:0x5B] += 32


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def _trigrams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The hashed trigram around each byte, of folded bytes; texts are apart."""
    b = _FOLD[data]
    before, after = np.full(len(b), 32), np.full(len(b), 32)
    before[1:], after[:-1] = b[:-1], b[1:]
    before[offsets[:-1][offsets[:-1] < len(b)]] = 32
    ends = offsets[1:][offsets[1:] > 0] - 1
    after[ends] = 32
    key = (before << 16 | b << 8 | after).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (key >> np.uint64(48)).astype(np.int64)


def _learn(batches):
    counts: dict[str, np.ndarray] = {}
    scripts: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column(0).to_pylist()
        for lo, hi, data, offsets in c.chunks(batch.column(1)):
            slot, letter = _trigrams(data, offsets), _LETTER[data]
            for r in range(lo, hi):
                part = slice(offsets[r - lo], offsets[r - lo + 1])
                seen = slot[part][letter[part]]
                if langs[r] not in counts:
                    counts[langs[r]] = np.zeros(SLOTS, np.int64)
                    scripts[langs[r]] = np.zeros(len(_NAMES) + 1, np.int64)
                counts[langs[r]] += np.bincount(seen, minlength=SLOTS)
                scripts[langs[r]] += np.bincount(_SCRIPT[data[part]], minlength=len(_NAMES) + 1)
    for lang, n in counts.items():
        at = np.flatnonzero(n)
        s = np.flatnonzero(scripts[lang])
        slots = np.concatenate([at, -s])  # scripts as slots below 0
        found = np.concatenate([n[at], scripts[lang][s]])
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(slots)), pa.array(slots, pa.int64()), pa.array(found, pa.int64())], names=["lang", "slot", "n"])


class Model:
    """Log probabilities (SLOTS x languages) and candidate languages for each script."""

    def __init__(self, langs: list[str], counts: np.ndarray, scripts: np.ndarray):
        self.langs = langs
        total = counts.sum(axis=0, keepdims=True)
        self.logp = np.log((counts + 0.5) / (total + 0.5 * SLOTS)).astype(np.float32) if langs else np.zeros((SLOTS, 0), np.float32)
        share = scripts / np.maximum(1, scripts[1:].sum(axis=0, keepdims=True))
        self.candidate = share >= OWN_SCRIPT
        self.candidate[~self.candidate.any(axis=1)] = True  # a script nobody learned leaves all


def train(docs: DataFrame, per_language: int = 5000) -> Model:
    """The model, from rows that are not held out and have a label."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.select(F.col("lang").cast("string").alias("lang"), "text", "doc_id")
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model([], np.zeros((SLOTS, 0)), np.zeros((len(_NAMES) + 1, 0)))
    rates = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, per_language / n))])
    chance = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20)
    sample = known.filter(chance < rates[F.col("lang")]).select("lang", "text")
    rows = sample.mapInArrow(_learn, "lang string, slot long, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(set(rows["lang"]))
    counts, scripts = np.zeros((SLOTS, len(langs))), np.zeros((len(_NAMES) + 1, len(langs)))
    for k, lang in enumerate(langs):
        own = rows[rows["lang"] == lang]
        slot, n = own["slot"].to_numpy(), own["n"].to_numpy()
        # slot 0 of scripts is "no letter" and is not needed
        counts[slot[slot >= 0], k] = n[slot >= 0]
        scripts[-slot[slot < 0], k] = n[slot < 0]
    return Model(langs, counts, scripts)


def word_scores(model: Model, words: c.Words, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scores (words x languages) and each word's letter bytes."""
    slot, letter = _trigrams(words.data, offsets), _LETTER[words.data]
    slot[~letter] = SLOTS
    n, k = len(words.start), len(model.langs)
    scores = np.zeros((n, k), np.float32)
    bounds = np.stack([words.start, np.minimum(words.end, len(words.data) - 1)], axis=1).ravel()
    script = _SCRIPT[words.data]
    main = np.maximum.reduceat(script, bounds)[::2] if n else np.zeros(0, np.int8)
    alone = words.end - words.start == 1
    main = np.where(alone, script[words.start], main) if n else main
    for j in range(k):
        table = np.append(model.logp[:, j], np.float32(0))
        run = np.concatenate([[0], np.cumsum(table[slot], dtype=np.float64)])
        scores[:, j] = run[words.end] - run[words.start]
    letters = np.concatenate([[0], np.cumsum(letter)])
    letters = letters[words.end] - letters[words.start]
    barred = ~model.candidate[main] & (letters > 0)[:, None]
    scores[barred] -= 1000.0
    return scores, letters


def viterbi(scores: np.ndarray, first: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The language of each word; ``first[r]:first[r + 1]`` are the words of text ``r``. All
    texts take their steps together."""
    sizes = np.diff(first)
    order = np.argsort(-sizes, kind="stable")
    start, size = first[:-1][order], sizes[order]
    k = scores.shape[1]
    label = np.zeros(len(scores), np.int16)
    came = np.zeros((len(scores), k), np.int16)
    steps = int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(steps), side="left")  # texts longer than the step
    value = np.zeros((len(size), k))
    own = np.arange(k, dtype=np.int16)[None, :]
    for t in range(steps):
        a = active[t]
        at = start[:a] + t
        v = value[:a]
        if t:
            top = v.argmax(axis=1)
            best = v[np.arange(a), top][:, None] - switch
            stay = v >= best
            came[at] = np.where(stay, own, top[:, None])
            v = np.where(stay, v, best)
            v -= v.max(axis=1, keepdims=True)
        value[:a] = v + scores[at]
    now = value.argmax(axis=1).astype(np.int16)
    for t in range(steps - 1, -1, -1):
        a = active[t]
        at = start[:a] + t
        label[at] = now[:a]
        if t:
            now[:a] = came[at, now[:a]]
    return label


def _joined(batches, most: int):
    """Batches put together to about ``most`` bytes."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= most:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    full = [b for b in held if b.num_rows]
    if full:
        yield pa.Table.from_batches(full).combine_chunks().to_batches()[0]


def _predict(model, switch: float):
    def run(batches):
        m: Model = model.value
        k = len(m.langs)
        for batch in _joined(batches, TOGETHER):
            texts = batch.column(2)
            scores, letters, firsts, count = [], [], [], 0
            for _, _, data, offsets in c.chunks(texts):
                words = c.Words(data, offsets, hashed=False)
                s, n = word_scores(m, words, offsets)
                scores.append(s)
                letters.append(n)
                firsts.append(words.first[:-1] + count)
                count += len(n)
            first = np.append(np.concatenate(firsts), count) if firsts else np.zeros(1, np.int64)
            letter = np.concatenate(letters) if letters else np.zeros(0, np.int64)
            label = viterbi(np.concatenate(scores), first, switch) if k and count else np.zeros(count, np.int16)
            row = np.repeat(np.arange(batch.num_rows), np.diff(first))
            mass = np.bincount(row * max(k, 1) + label, weights=letter, minlength=batch.num_rows * max(k, 1)).reshape(batch.num_rows, -1)
            total, top = mass.sum(axis=1), mass.argmax(axis=1)
            turn = np.flatnonzero(np.append(True, (label[1:] != label[:-1]) | (row[1:] != row[:-1]))) if count else np.zeros(0, np.int64)
            ends = np.append(turn[1:], count)[: len(turn)]
            langs, score, spans = [], [], [[] for _ in range(batch.num_rows)]
            for a, b in zip(turn.tolist(), ends.tolist(), strict=True):
                if k:
                    spans[row[a]].append({"first": a - int(first[row[a]]), "end": b - int(first[row[a]]), "lang": m.langs[label[a]]})
            for r in range(batch.num_rows):
                known = k and total[r] > 0 and any(ch.isalpha() for ch in texts[r].as_py())
                langs.append(m.langs[top[r]] if known else "und")
                score.append(float(mass[r, top[r]] / total[r]) if known else 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(langs, pa.string()), pa.array(score, pa.float64()), pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64()), ("lang", pa.string())])))],
                names=["doc_id", "th", "lang_pred", "score", "spans"],
            )

    return run


def identify(docs: DataFrame, model: Model, switch: float = SWITCH) -> DataFrame:
    """doc_id, th (the text's hash), lang_pred, score, spans (first and end word, lang)."""
    c.small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)  # SLOTS numbers for each language
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), c.row_hash(F.col("text")).alias("th"), "text")
    return rows.mapInArrow(_predict(held, switch), "doc_id long, th long, lang_pred string, score double, spans array<struct<first:long,end:long,lang:string>>")


def keep_identified(docs: DataFrame, model: Model, least: float = 0.5, switch: float = SWITCH) -> DataFrame:
    """The documents with a language whose spans hold at least ``least`` of the letters.
    Judged row by row: the rows themselves pass through, whatever their columns."""
    c.small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)
    judge = _predict(held, switch)

    def run(batches):
        for batch in _joined(batches, TOGETHER):
            plain = pa.RecordBatch.from_arrays([pa.nulls(batch.num_rows, pa.int64())] * 2 + [batch.column(batch.num_columns - 1)], names=["doc_id", "th", "text"])
            kept = [ok and s >= least for made in judge(iter([plain])) for ok, s in zip([x != "und" for x in made.column(2).to_pylist()], made.column(3).to_pylist(), strict=True)]
            yield batch.select(range(batch.num_columns - 1)).filter(pa.array(kept, pa.bool_()))

    names = [f"c{k}" for k in range(len(docs.columns))]
    numbered = docs.toDF(*names)
    judged = numbered.withColumn("judged", F.col(names[docs.columns.index("text")]).cast("string"))
    return judged.mapInArrow(run, numbered.schema).toDF(*docs.columns)
