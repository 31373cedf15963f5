"""Personal data in whole texts: candidate spans judged by boosted trees.

Generators propose spans with high recall: for each kind (email, ip, card, phone) the base
pattern, leftmost and without overlap, and looser patterns (spelled-out at and dot signs,
version 6 addresses, cards and national phone numbers with other separators), whose spans
may overlap others. A base match that passes its check (address parts up to 255, Luhn and 13
to 19 digits, 9 to 15 digits) is always a span; one that fails is never tried again.

Gradient-boosted trees learn from the base matches of all documents (passed or failed), none
left out, on format features (digits, groups, signs, checks) and context features
(neighbouring characters, key words before); matches of equal features are one row that
weighs as many. The trees become one SQL expression, so all texts are judged in one pass
without a shuffle. Each kind's threshold is calibrated on all base matches too, each half
scored by trees that learned from the other: the lowest grid score above which the share of
true ones is at least ``precision``. Loose candidates
that reach it and overlap no base span are added; of overlapping additions the best stays.
Without both outcomes to learn from, or without such a threshold, nothing is added.

DataFrame functions only. Offsets are code points, ends exclusive. Null texts are empty.
Every input row gives one output row; repeated rows each get theirs.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridops.llm import common as c

KINDS = ("email", "ip", "card", "phone")

# The base patterns, with possessive repeats where nothing can follow, so that
# long runs are read once: a match can only begin where a run begins or the last one ended.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold before a pattern is tried at all.
NEEDS = {"email": "@", "ip": ".", "phone": "+"}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[(\[{](?i:at)[)\]}]\x20?[A-Za-z0-9-]++(?:\x20?(?:[(\[{](?i:dot)[)\]}]|\.)\x20?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])[0-9]{4}(?:[\x20._/-]{1,2}[0-9]{4}){3}(?![0-9])",
    "phone": r"(?<![0-9])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}
#: Key words looked for before a candidate.
CONTEXT = r"(?i)(mail|contact|tel|phone|call|fax|mobile|card|visa|credit|payment|address|host|server)[^A-Za-z]{0,3}$"
BEFORE, AFTER = 24, 1

_SPAN = "struct<kind:int,start:int,end:int,match:string>"


def _located(kind: str, pattern: str, guard: str | None) -> Column:
    """All matches of a pattern with their places, from the pieces between them."""
    escaped = pattern.replace("\\", "\\\\").replace("'", "\\'")
    number = KINDS.index(kind)
    walk = f"""aggregate(sequence(0, size(m) - 1), cast(struct(0, array()) as struct<at:int,out:array<{_SPAN}>>),
        (a, i) -> struct(a.at + length(p[i]) + length(m[i]) as at,
            array_append(a.out, struct({number} as kind, a.at + length(p[i]) as start, a.at + length(p[i]) + length(m[i]) as end, m[i] as match)) as out), a -> a.out)"""
    matches = f"regexp_extract_all(text, '{escaped}', 0)"
    # the one-element arrays name what is used twice
    found = f"""element_at(transform(array({matches}), m -> if(size(m) = 0, cast(array() as array<{_SPAN}>),
        element_at(transform(array(split(text, '{escaped}', -1)), p -> {walk}), 1))), 1)"""
    return F.expr(f"if({guard}, {found}, cast(array() as array<{_SPAN}>))" if guard else found)


_DIGITS = "regexp_replace(x.match, '[^0-9]', '')"
_LUHN = f"""(length({_DIGITS}) between 13 and 19 and element_at(transform(array({_DIGITS}), d -> aggregate(sequence(1, length(d)), 0, (a, i) -> a + element_at(transform(
    array(cast(substring(d, length(d) - i + 1, 1) as int) * if(i % 2 = 0, 2, 1)), v -> if(v > 9, v - 9, v)), 1))), 1) % 10 = 0)"""
_PARTS = "forall(split(x.match, '[.]'), v -> try_cast(v as double) <= 255)"
_CHECK = f"""case x.kind when 0 then true when 1 then {_PARTS} when 2 then {_LUHN}
    else length({_DIGITS}) between 9 and 15 end"""

#: Name and SQL of each feature of a candidate x.
FEATURES = {
    "email": "x.kind = 0", "ip": "x.kind = 1", "card": "x.kind = 2", "phone": "x.kind = 3",
    "digits": f"length({_DIGITS})",
    "size": "least(length(x.match), 1000)",
    "groups": "least(size(split(x.match, '[^0-9A-Za-z]+')), 100)",
    "spaces": "length(x.match) - length(replace(x.match, ' ', ''))",
    "hyphens": "length(x.match) - length(replace(x.match, '-', ''))",
    "dots": "length(x.match) - length(replace(x.match, '.', ''))",
    "letters": "least(length(regexp_replace(x.match, '[^A-Za-z]', '')), 1000)",
    "plus": "startswith(x.match, '+')",
    "luhn": _LUHN,
    "parts": f"(x.match rlike '^[0-9.]+$' and {_PARTS})",
    "distinct": "size(array_distinct(split(regexp_replace(substring(x.match, 1, 100), '[^0-9]', ''), '')))",
    "word_before": "x.before rlike '[A-Za-z0-9]$'",
    "word_after": "x.after rlike '^[A-Za-z0-9]'",
    "key_word": "x.before rlike '" + CONTEXT.replace("\\", "\\\\") + "'",
}


def _candidates(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Row by row: base matches with their check, and loose matches, with their context."""
    digit = "text rlike '[0-9]'"
    rows = docs.select(F.struct(*keep).alias("row"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    base = [_located(k, BASE[k], f"instr(text, '{NEEDS[k]}') > 0 and {digit}" if k in ("ip", "phone") else f"instr(text, '{NEEDS[k]}') > 0" if k in NEEDS else digit) for k in KINDS]
    loose = [_located(k, LOOSE[k], "text rlike '(?i)[(\\\\[{]at[)\\\\]}]'" if k == "email" else f"{digit} and text rlike '[0-9A-Fa-f]:[0-9A-Fa-f]'" if k == "ip" else digit) for k in KINDS]
    context = f"""transform({{}}, x -> struct(x.kind as kind, x.start as start, x.end as end, x.match as match,
        substring(text, greatest(x.start - {BEFORE}, 0) + 1, least(x.start, {BEFORE})) as before, substring(text, x.end + 1, {AFTER}) as after))"""
    rows = rows.withColumn("base", F.concat(*base)).withColumn("loose", F.concat(*loose))
    rows = rows.withColumn("base", F.expr(context.format("base"))).withColumn("loose", F.expr(context.format("loose")))
    return rows.withColumn("base", F.expr(f"transform(base, x -> struct(x.*, {_CHECK} as passed))".replace("x.*", "x.kind as kind, x.start as start, x.end as end, x.match as match, x.before as before, x.after as after")))


def _tree_sql(node, names: list[str]) -> str:
    if node.getClass().getSimpleName() == "LeafNode":
        return repr(float(node.prediction()))
    split = node.split()
    test = f"f.{names[split.featureIndex()]} <= {float(split.threshold())!r}"
    return f"if({test}, {_tree_sql(node.leftChild(), names)}, {_tree_sql(node.rightChild(), names)})"


def ensemble_sql(model: GBTClassificationModel, names: list[str]) -> str:
    """The model's probability as SQL over a struct ``f`` of its features."""
    java = model._java_obj
    trees, weights = java.trees(), java.treeWeights()
    terms = [f"{float(weights[k])!r} * {_tree_sql(trees[k].rootNode(), names)}" for k in range(len(weights))]
    return f"1 / (1 + exp(-2 * ({' + '.join(terms)})))"


def _feature_sql() -> str:
    return "struct(" + ", ".join(f"coalesce(cast({sql} as double), 0d) as {name}" for name, sql in FEATURES.items()) + ")"


def _fit(cells: DataFrame, names: list[str], bins: int) -> str:
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(cells).select("features", "label", "weight")
    trees = GBTClassifier(maxIter=8, maxDepth=3, maxBins=bins, seed=7, labelCol="label", featuresCol="features", weightCol="weight", cacheNodeIds=False)
    return ensemble_sql(trees.fit(vectors), names)


def learn(docs: DataFrame, precision: float = 0.98) -> tuple[str | None, dict[str, float]]:
    """The score's SQL and each kind's threshold, for the kinds that have one."""
    names = list(FEATURES)
    found = _candidates(docs, ["text"]).select(F.explode("base").alias("x")).select("x.kind", "x.passed", F.xxhash64("x.match", "x.before").alias("h"), F.expr(_feature_sql()).alias("f"))
    found = found.select("kind", F.col("passed").cast("double").alias("label"), F.pmod(F.shiftright("h", 24), F.lit(2)).alias("half"), "f.*")
    # candidates of equal features are one row of their number: no more than the trees tell apart
    cells = c.written(found.groupBy("kind", "label", "half", *names).agg(F.count(F.lit(1)).cast("double").alias("weight")), "pii-candidates")
    sides = cells.groupBy("half", "label").agg(F.count(F.lit(1)).alias("n")).collect()
    if len({r["label"] for r in sides}) < 2:
        return None, {}
    # Spark looks for split points in 10,000 rows, or the square of the bins: in all of these
    rows = sum(r["n"] for r in sides)
    bins = 32 if rows <= 10000 else math.isqrt(rows) + 1
    judged = None
    for half in (0, 1):
        if len({r["label"] for r in sides if r["half"] == 1 - half}) == 2:
            score = _fit(cells.filter(F.col("half") == 1 - half), names, bins)
            part = cells.filter(F.col("half") == half).select("kind", "label", "weight", F.struct(*names).alias("f")).select("kind", "label", "weight", F.expr(score).alias("score"))
            judged = part if judged is None else judged.unionByName(part)
    if judged is None:
        return None, {}
    grid = judged.withColumn("t", F.explode(F.array(*[F.lit(k / 20) for k in range(10, 20)]))).filter("score >= t")
    rates = grid.groupBy("kind", "t").agg(F.sum("weight").alias("n"), (F.sum(F.col("label") * F.col("weight")) / F.sum("weight")).alias("true"))
    best = rates.filter((F.col("true") >= precision) & (F.col("n") >= 10)).groupBy("kind").agg(F.min("t").alias("t")).collect()
    return _fit(cells, names, bins), {KINDS[r["kind"]]: r["t"] for r in best}


def find_spans(docs: DataFrame, keep: list[str] | None = None, precision: float = 0.98) -> DataFrame:
    """``row`` (a struct of the columns in ``keep``, by default all), text, ``base`` and
    ``spans`` (base and added), arrays of (kind, start, end) in order of kind and start."""
    score, thresholds = learn(docs, precision)
    rows = _candidates(docs, keep or docs.columns)
    flat = "array_sort(transform(filter(base, x -> x.passed), x -> struct(x.kind as kind, x.start as start, x.end as end)))"
    rows = rows.withColumn("base", F.expr(flat))
    if not thresholds:
        return rows.select("row", "text", "base", F.col("base").alias("spans"))
    least = "case x.kind " + " ".join(f"when {KINDS.index(k)} then {t}" for k, t in thresholds.items()) + " else 2 end"
    judged = f"transform(loose, x -> struct(x.kind as kind, x.start as start, x.end as end, {least} as least, element_at(transform(array({_feature_sql()}), f -> {score}), 1) as score))"
    able = "filter(judged, x -> x.score >= x.least and not exists(base, y -> y.start < x.end and x.start < y.end))"
    added = "filter(able, x -> not exists(able, y -> y.start < x.end and x.start < y.end and (y.score > x.score or (y.score = x.score and (y.start < x.start or (y.start = x.start and y.kind < x.kind))))))"
    rows = rows.withColumn("judged", F.expr(judged)).withColumn("able", F.expr(able)).withColumn("added", F.expr(added))
    both = "array_sort(concat(base, transform(added, x -> struct(x.kind as kind, x.start as start, x.end as end))))"
    return rows.select("row", "text", "base", F.expr(both).alias("spans"))


def listed(spans: str) -> Column:
    """A span array as kind:start:end, comma-joined."""
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return F.expr(f"array_join(transform({spans}, x -> concat(element_at({names}, x.kind + 1), ':', x.start, ':', x.end)), ',')")


def redact(docs: DataFrame, **params) -> DataFrame:
    """``row`` and ``redacted``: the text with each span replaced by its kind in brackets
    (of overlapping spans the first)."""
    names = "array(" + ", ".join(f"'[{k.upper()}]'" for k in KINDS) + ")"
    walk = f"""aggregate(array_sort(transform(spans, x -> struct(x.start as start, x.end as end, x.kind as kind))), struct(0 as at, '' as out),
        (a, x) -> if(x.end <= a.at, a, struct(x.end as at, concat(a.out, if(x.start >= a.at, concat(substring(text, a.at + 1, x.start - a.at), element_at({names}, x.kind + 1)), '')) as out)),
        a -> concat(a.out, substring(text, a.at + 1)))"""
    return find_spans(docs, **params).select("row", F.expr(walk).alias("redacted"))
