r"""Personal data: fixed base spans for four kinds, and further spans that boosted trees choose among candidates.

Everything is DataFrame expressions within a row: spans are arrays beside the text, so nothing is exploded, shuffled or
joined, and a long text or a hot source costs its length only. Regular expressions give the matches, the pieces between
them give the places. The trees are fitted by Spark ML on the candidates of all documents and written out as one
expression; what travels is one row for each distinct vector of counts, with how often it occurs.

High-recall generators propose overlapping spans in looser formats than the base rules take: mail addresses with spelled
marks, numbers with any usual separator, quoted values assigned to names. Trees see the format and the words before a
candidate. Labels come from the corpus itself, by evidence the trees do not see: a candidate in a base format is personal
if it passes that kind's check (Luhn sum, octets, number of digits, a top-level domain of letters), a value is secret if
its name says so, while the trees see counts of characters, and of a value nothing but the value. Each half of the
documents fits trees and is scored by the trees of the other half; the scores of all of them set, for each kind, the
lowest score at which TARGET of those chosen are right; candidates outside the base formats that reach it, by the mean
over the trees of both halves, become further spans. Overlapping ones give way to the first.

Defined cases: a null text is empty and has no spans; repeated rows have equal results; a half that lacks either label
fits no trees, and an empty table, or one with two such halves, gets no further spans; nothing but doc_id and text is read.
"""

import math

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pedalflow.llm.common import picked
from pedalflow.session import stored

KINDS = ("email", "ip", "card", "phone")
#: The base formats, written so that no character is scanned twice (possessive, and starting where a run starts).
FORMATS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
#: Looser formats of the candidates. The first group of a secret is what goes before its value.
LOOSE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]++)++",
    "number": r"(?<![A-Za-z0-9+(])(?:\+|\(\+?)?[0-9](?:[\x20()./-]{0,2}[0-9]){6,}+(?![A-Za-z0-9])",
    "secret": r"(?i)(?<![a-z0-9_-])[a-z][a-z0-9_-]{1,30}+\x20?[=:]\x20?\"[a-z0-9_/+-]{8,}+\"",
}
#: Names whose values are secret; they label the values, of which alone the trees see the format.
SECRET_NAME = r"(?i)^(?:[a-z0-9_-]*[_-])?(?:token|secret|password|passwd|pwd|api[_-]?key|access[_-]?key)\x20?[=:]"
#: Bounds of the fit: trees and their depth, share of chosen candidates that must be right.
TREES = 10
DEPTH = 3
TARGET = 0.99
#: Splits of a feature, at least.
BINS = 1024
#: Scores are told apart by so many digits.
SCORE_DIGITS = 6
FEATURES = ("digits", "letters", "length", "groups", "dots", "spaces", "plus", "cue", "edge")


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]+", "")


def _luhn(text: Column) -> Column:
    number = digits(text)
    return F.when(F.length(number).between(14, 19), F.call_function("luhn_check", number)).otherwise(F.lit(False))


def passes(kind: str, match: Column) -> Column:
    """Whether a match of a base format counts."""
    if kind == "ip":
        return match.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return _luhn(match)
    if kind == "phone":
        return F.length(digits(match)).between(10, 15)
    return F.lit(True)


def running(name: str) -> Column:
    """Running totals before each element of an array column, in chunks so that long arrays stay cheap."""
    chunk = 128
    add = lambda s, x: s + x
    zero = F.lit(0)
    push = lambda acc, x: F.concat(acc, F.array(F.get(acc, F.size(acc) - 1) + x))
    firsts = F.sequence(F.lit(1), F.size(name), F.lit(chunk))
    sums = F.transform(firsts, lambda i: F.aggregate(F.slice(name, i, chunk), zero, add))
    heads = F.aggregate(sums, F.array(zero), push)
    inner = lambda i, h: F.slice(F.aggregate(F.slice(name, i, chunk), F.array(h), push), 1, F.least(F.lit(chunk), F.size(name) - i + 1))
    pairs = F.transform(F.arrays_zip(firsts.alias("i"), F.slice(heads, 1, F.size(firsts)).alias("h")), lambda p: inner(p["i"], p["h"]))
    return F.when(F.size(name) > 0, F.flatten(pairs)).otherwise(F.array().cast("array<int>"))


def located(df: DataFrame, name: str, pattern: str, needs: Column) -> DataFrame:
    """Add an array column of the matches of ``pattern`` in ``text``, as text, start and end in code points."""
    raw, steps, at = f"{name}_raw", f"{name}_steps", f"{name}_at"
    df = df.withColumn(raw, F.when(needs, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>")))
    gaps = F.transform(F.split("text", pattern, -1), lambda g: F.length(g))
    df = df.withColumn(
        steps,
        F.when(
            F.size(raw) > 0,
            F.zip_with(F.slice(gaps, 1, F.size(raw)), F.concat(F.array(F.lit(0)), F.transform(F.slice(raw, 1, F.greatest(F.size(raw) - 1, F.lit(0))), lambda m: F.length(m))), lambda g, m: g + m),
        ).otherwise(F.array().cast("array<int>")),
    )
    df = df.withColumn(at, running(steps))
    # A start is what goes before it: earlier gaps and matches, and the gap right before.
    spans = F.transform(
        F.arrays_zip(F.col(raw).alias("m"), F.col(steps).alias("s"), F.col(at).alias("b")),
        lambda x: F.struct(x["m"].alias("match"), (x["s"] + x["b"]).alias("start"), (x["s"] + x["b"] + F.length(x["m"])).alias("end")),
    )
    return df.withColumn(name, spans).drop(raw, steps, at)


def features(kind: str, text: Column, span: Column) -> Column:
    """What the trees see of a candidate: its format and the words around it, as a struct of doubles."""
    match = F.regexp_replace(span["match"], r"^[^=:]*[=:]\x20?", "") if kind == "secret" else span["match"]
    number = digits(match)
    before = F.lower(F.substr(text, F.greatest(span["start"] - 23, F.lit(1)), F.least(F.lit(24), span["start"])))
    before = F.when(span["start"] > 0, before).otherwise(F.lit(""))
    count = lambda p: F.length(match) - F.length(F.regexp_replace(match, p, ""))
    flag = lambda c: F.when(c, 1.0).otherwise(0.0)
    values = {
        "digits": F.length(number),
        "letters": count("[A-Za-z]"),
        "length": F.length(match),
        "groups": F.size(F.split(match, "[^A-Za-z0-9]+", -1)),
        "dots": count("[.]"),
        "spaces": count(r"\x20"),
        "plus": flag(F.startswith(match, F.lit("+"))),
        "cue": flag(before.rlike(r"(?:mail|phone|tel|call|card|visa|ip|address|token|secret|key)\W*$")),
        "edge": flag(before.rlike(r"[a-z0-9_=/-]$")),
    }
    return F.struct(F.lit(kind).alias("kind"), *[values[f].cast("double").alias(f) for f in FEATURES])


def is_base_format(kind: str, match: Column) -> Column:
    if kind == "email":
        return F.regexp_replace(match, FORMATS["email"], "") == ""
    if kind == "number":
        shapes = [match.rlike(rf"^(?:{FORMATS[k]})$") for k in ("ip", "card", "phone")]
        return shapes[0] | shapes[1] | shapes[2]
    return F.lit(False)


def weak_label(kind: str, match: Column) -> Column:
    """1 or 0 where the corpus itself tells, else null."""
    if kind == "email":
        return F.when(is_base_format(kind, match), F.when(match.rlike(r"\.[A-Za-z]{2,}$"), 1.0).otherwise(0.0))
    if kind == "number":
        good = [match.rlike(rf"^(?:{FORMATS[k]})$") & passes(k, match) for k in ("ip", "card", "phone")]
        return F.when(is_base_format(kind, match), F.when(good[0] | good[1] | good[2], 1.0).otherwise(0.0))
    return F.when(match.rlike(SECRET_NAME), 1.0).otherwise(0.0)


def _needs(kind: str) -> Column:
    if kind == "email":
        return F.col("text").contains("@") | F.col("text").contains("at)") | F.col("text").contains("at]")
    return F.col("text").rlike("[0-9]") if kind == "number" else F.col("text").rlike("[=:]")


def candidates(df: DataFrame) -> DataFrame:
    """Add ``found``: all candidates of a text, each with its kind, span, features and whether a base format fits."""
    for kind, pattern in LOOSE.items():
        df = located(df, f"loose_{kind}", pattern, _needs(kind))

    def described(kind: str):
        return lambda s: F.struct(
            s.alias("span"),
            features(kind, F.col("text"), s).alias("x"),
            is_base_format(kind, s["match"]).alias("base"),
            weak_label(kind, s["match"]).alias("label"),
        )

    parts = [F.transform(f"loose_{kind}", described(kind)) for kind in LOOSE]
    return df.withColumn("found", F.concat(*parts)).drop(*[f"loose_{kind}" for kind in LOOSE])


class Chooser:
    """Boosted trees as one expression, and the calibrated threshold of each kind."""

    def __init__(self, trees: list, weights: list[float], thresholds: dict[str, float]):
        self.trees, self.weights, self.thresholds = trees, weights, thresholds

    def score(self, x: Column) -> Column:
        def value(node) -> Column:
            if isinstance(node, float):
                return F.lit(node)
            feature, threshold, low, high = node
            field = (x["kind"] == feature).cast("double") if feature in LOOSE else x[feature]
            return F.when(field <= threshold, value(low)).otherwise(value(high))

        total = F.lit(0.0)
        for tree, weight in zip(self.trees, self.weights, strict=True):
            total = total + value(tree) * weight
        return total

    def chooses(self, x: Column) -> Column:
        limit = F.lit(float("inf"))
        for kind, threshold in self.thresholds.items():
            limit = F.when(x["kind"] == kind, F.lit(threshold)).otherwise(limit)
        # Thresholds are scores of SCORE_DIGITS digits, so scores are compared as such.
        return F.round(self.score(x), SCORE_DIGITS) >= limit


def bins(n: int) -> int:
    """Splits of a feature for ``n`` rows: Spark looks for them in no more rows than their square, and else draws some."""
    return max(BINS, math.isqrt(max(n - 1, 0)) + 1)


def _boosted(rows: DataFrame) -> tuple[list, list[float]] | None:
    """Trees and their weights, fitted on rows of weighted feature vectors; none if they lack either label."""
    n, labels = rows.agg(F.count("*"), F.count_distinct("label")).first()
    if labels < 2:
        return None
    inputs = [*FEATURES, *[f"is_{k}" for k in LOOSE]]
    ready = VectorAssembler(inputCols=inputs, outputCol="vector").transform(rows.withColumn("count", F.col("count").cast("double")))
    model = GBTClassifier(featuresCol="vector", labelCol="label", weightCol="count", maxIter=TREES, maxDepth=DEPTH, maxBins=bins(n), seed=7).fit(ready)
    fields = [*FEATURES, *LOOSE]

    def unfold(node):
        if node.subtreeDepth() == 0:
            return float(node.prediction())
        split = node.split()
        return fields[split.featureIndex()], float(split.threshold()), unfold(node.leftChild()), unfold(node.rightChild())

    return [unfold(tree._java_obj.rootNode()) for tree in model.trees], [float(w) for w in model.treeWeights]


def fit_chooser(docs: DataFrame) -> Chooser | None:
    """Fit on the candidates of all documents, each of which counts in trees and in thresholds.

    Each half of the documents fits trees and is scored by those of the other half; all these scores set the thresholds.
    A candidate's score is the mean over both. Only numbers travel, and those that agree travel as one row. The outer form
    of the generator keeps the planner from a filter that would look for all candidates once more.
    """
    df = picked(docs, doc_id="doc_id", text="text")
    rows = candidates(df).select(F.xxhash64("doc_id").alias("h"), F.explode_outer("found").alias("c")).where("c.label is not null")
    flat = rows.select(
        F.pmod("h", F.lit(2)).alias("half"),
        F.col("c.label").alias("label"),
        F.col("c.x.kind").alias("kind"),
        *[F.col(f"c.x.{f}") for f in FEATURES],
        *[(F.col("c.x.kind") == k).cast("double").alias(f"is_{k}") for k in LOOSE],
    )
    # A row for each distinct vector and label, weighted by how often it occurs: few beside the texts, in any number of tasks.
    flat = stored(flat.groupBy(*flat.columns).count(), "candidates")
    fitted = {half: _boosted(flat.where(F.col("half") == half)) for half in (0, 1)}
    fitted = {half: model for half, model in fitted.items() if model}
    by_kind: dict[str, list] = {}
    for half, model in fitted.items():
        held = flat.where(F.col("half") != half).withColumn("x", F.struct("kind", *FEATURES))
        scored = held.select("kind", F.round(Chooser(*model, {}).score(F.col("x")), SCORE_DIGITS).alias("score"), "label", "count")
        tally = scored.groupBy("kind", "score").agg(F.sum("count").alias("n"), F.sum(F.col("count") * F.col("label")).alias("right"))
        for row in tally.collect():  # as many rows as the trees have distinct scores, at any number of documents
            by_kind.setdefault(row["kind"], []).append((row["score"], row["n"], row["right"]))
    trees = [tree for model in fitted.values() for tree in model[0]]
    chooser = Chooser(trees, [weight / len(fitted) for model in fitted.values() for weight in model[1]], {})
    for kind, tallies in by_kind.items():
        n = right = 0.0
        for score, more, good in sorted(tallies, reverse=True):
            n, right = n + more, right + good
            if right >= TARGET * n and score > 0:
                chooser.thresholds[kind] = score
    return chooser if chooser.thresholds else None


def _overlaps(span: Column, others: str) -> Column:
    return F.exists(others, lambda o: (o["start"] < span["end"]) & (span["start"] < o["end"]))


def find_personal(docs: DataFrame, chooser: Chooser | None, *more: str) -> DataFrame:
    """doc_id, text, ``base`` and ``spans``: arrays of start, rank, kind, end, in order of start, then kind.

    ``more`` names further columns of the input to keep.
    """
    df = picked(docs, "doc_id", *more, text="text").withColumn("text", F.coalesce("text", F.lit("")))
    needs = {"email": F.col("text").contains("@"), "phone": F.col("text").contains("+")}
    for kind in KINDS:
        df = located(df, kind, FORMATS[kind], needs.get(kind, F.col("text").rlike("[0-9][0-9. -][0-9. -]")))

    def checked(rank: int, kind: str) -> Column:
        good = F.filter(kind, lambda s: passes(kind, s["match"]))
        return F.transform(good, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), s["end"].alias("end")))

    kept = [checked(rank, kind) for rank, kind in enumerate(KINDS)]
    df = df.withColumn("base", F.sort_array(F.concat(*kept))).drop(*KINDS)
    if chooser is None:
        return df.withColumn("spans", F.col("base"))
    df = candidates(df)
    more = F.transform(
        F.filter("found", lambda c: ~c["base"] & chooser.chooses(c["x"]) & ~_overlaps(c["span"], "base")),
        lambda c: F.struct(
            c["span"]["start"].alias("start"), F.lit(len(KINDS)).alias("rank"), c["x"]["kind"].alias("kind"), c["span"]["end"].alias("end")
        ),
    )
    df = df.withColumn("more", F.sort_array(more)).drop("found")
    # Kinds may propose the same place; the first of those that overlap stays.
    last = F.lit(0)
    firsts = F.aggregate(
        "more",
        F.struct(last.alias("end"), F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>").alias("out")),
        lambda acc, s: F.when(s["start"] >= acc["end"], F.struct(s["end"].alias("end"), F.concat(acc["out"], F.array(s)).alias("out"))).otherwise(acc),
    )["out"]
    return df.withColumn("spans", F.sort_array(F.concat("base", firsts))).drop("more")


def joined(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(df: DataFrame) -> DataFrame:
    """Replace ``text`` by one in which each stretch of spans is a mark with the kind of the first of them."""
    merge = F.aggregate(
        "spans",
        F.array().cast("array<struct<start:int,end:int,kind:string>>"),
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (s["start"] < F.get(acc, F.size(acc) - 1)["end"]),
            F.concat(
                F.slice(acc, 1, F.size(acc) - 1),
                F.array(
                    F.struct(
                        F.get(acc, F.size(acc) - 1)["start"].alias("start"),
                        F.greatest(F.get(acc, F.size(acc) - 1)["end"], s["end"]).alias("end"),
                        F.get(acc, F.size(acc) - 1)["kind"].alias("kind"),
                    )
                ),
            ),
        ).otherwise(F.concat(acc, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))),
    )
    df = df.withColumn("cuts", merge)
    between = F.transform(
        "cuts",
        lambda c, i: F.concat(
            F.substr("text", F.coalesce(F.get("cuts", i - 1)["end"], F.lit(0)) + 1, c["start"] - F.coalesce(F.get("cuts", i - 1)["end"], F.lit(0))),
            F.concat(F.lit("<"), F.upper(c["kind"]), F.lit(">")),
        ),
    )
    rest = F.substr("text", F.get("cuts", F.size("cuts") - 1)["end"] + 1, F.length("text"))
    text = F.when(F.size("cuts") == 0, F.col("text")).otherwise(F.concat(F.array_join(between, ""), rest))
    return df.withColumn("text", text).drop("cuts")
