"""Quality rules: text statistics, fixed base rules, and robust outliers per language and source.

All of it is DataFrame expressions. The statistics are worked out once, in arrays within a row, and written down as a
narrow table; estimates then need only sums per group, which every task forms for itself before anything is shuffled,
so that a source with a third of all rows costs no more than any other.

Defined cases: a null text is an empty one and fails the base rules; null languages and sources form groups of their
own; repeated rows each get their own verdict; an empty table gives an empty result; a group of a single document, or
one whose documents all look alike, rejects none of its own members, because each variance has a floor.
"""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pedalflow.llm.common import picked, words
from pedalflow.session import stored

#: Base rules.
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
#: Transformed statistics, and for each the standard deviation that any group is granted on top of its own. A group in
#: which hardly anyone repeats a line or writes a symbol would else take an ordinary single case for an outlier.
GRANTED = {"x_length": 0.3, "x_symbols": 0.04, "x_lines": 0.1, "x_repeats": 0.1}
#: Share of a group that the estimates rest on, concentration steps, and the squared distance that is too far.
SUBSET = 0.75
STEPS = 3
CUTOFF = 36.0
#: Quantile 0.75 of the chi-squared distribution by degrees of freedom.
CHI2_75 = {1: 1.3233, 2: 2.7726, 3: 4.1083, 4: 5.3853, 5: 6.6257}
#: Bins of distance to each doubling, for exact counts in place of a quantile sketch.
BINS = 32


#: Columns that are read in any case.
_OWN = ("doc_id", "lang", "source", "text")


def text_stats(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, lang, source, further columns ``more`` of the input, and the counts of each whole text."""
    df = picked(docs, "doc_id", "lang", "source", *[c for c in more if c not in _OWN], text="text")
    # What the input calls text goes along as it is; a null counts as empty.
    df = df.withColumn("given", F.col("text")).withColumn("text", F.coalesce("text", F.lit("")))
    names = [c for c in more if c not in _OWN or c == "text"]
    more = [F.col("given").alias(c) if c == "text" else F.col(c) for c in names]
    df = df.withColumn("ws", words(F.col("text"))).withColumn("ls", F.split("text", "\n", -1))
    df = df.withColumn("n_words", F.size("ws").cast("long")).withColumn(
        "grams",
        # Element access, not a slice for each window: a slice copies the whole array.
        F.slice(
            F.transform("ws", lambda w, i: F.xxhash64(w, *[F.get("ws", i + k) for k in range(1, WINDOW)])),
            1,
            F.greatest(F.size("ws") - (WINDOW - 1), F.lit(0)),
        ),
    )
    df = df.withColumn("ls", F.filter("ls", lambda line: line.rlike(r"[^\x20\x09-\x0D]")))
    df = df.select(
        "doc_id",
        "lang",
        "source",
        *more,
        "n_words",
        F.length(F.array_join("ws", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        F.size("ls").cast("long").alias("n_lines"),
        (F.size("ls") - F.size(F.array_distinct("ls"))).cast("long").alias("n_dup_lines"),
        F.when(
            F.size(F.array_distinct("grams")) < F.size("grams"),
            F.sort_array(F.transform("grams", lambda g, i: F.struct(g.alias("g"), i.alias("i")))),
        ).alias("found"),
    )
    # Equal windows are neighbours now; `twice` has the places of those that occur again, in order of place.
    alike = lambda x, k: (x["g"] == F.get("found", k + 1)["g"]) | (x["g"] == F.get("found", k - 1)["g"])
    df = df.withColumn(
        "twice",
        F.when(
            F.col("found").isNotNull(),
            F.sort_array(
                F.filter(
                    F.transform("found", lambda x, k: F.when(F.coalesce(alike(x, k), F.lit(False)), x["i"])),
                    lambda i: i.isNotNull(),
                )
            ),
        ),
    )
    # A window covers its words up to where the next one starts.
    covered = F.transform("twice", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get("twice", k + 1) - p, F.lit(WINDOW))))
    return df.select(
        "doc_id",
        "lang",
        "source",
        *names,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_lines",
        "n_dup_lines",
        F.coalesce(F.aggregate(covered, F.lit(0).cast("long"), lambda s, x: s + x), F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def transformed(stats: DataFrame) -> DataFrame:
    """The statistic vector. Roots steady the shares; added constants draw those of short texts to what is usual."""
    share = lambda a, b, usual: F.sqrt(F.col(a) / (F.col(b) + F.lit(usual)))
    return stats.withColumns(
        {
            "x_length": (F.col("word_chars") + 120.0) / (F.col("n_words") + 20.0),
            "x_symbols": share("n_symbols", "word_chars", 40.0),
            "x_lines": share("n_dup_lines", "n_lines", 10.0),
            "x_repeats": share("n_repeat_words", "n_words", 40.0),
        }
    )


def _moments(rows: DataFrame) -> DataFrame:
    names = list(GRANTED)
    sums = [F.count("*").alias("n"), *[F.avg(x).alias(f"m_{x}") for x in names]]
    sums += [F.covar_pop(a, b).alias(f"c_{a}_{b}") for i, a in enumerate(names) for b in names[: i + 1]]
    return rows.groupBy("lang", "source").agg(*sums)


def _factored(groups: DataFrame) -> DataFrame:
    """Add the Cholesky factor of each group's covariance, with the granted variances, column by column."""
    names = list(GRANTED)
    for i, a in enumerate(names):
        for j, b in enumerate(names[: i + 1]):
            entry = F.col(f"c_{a}_{b}") + F.lit(GRANTED[a] ** 2 if i == j else 0.0)
            for k in range(j):
                entry = entry - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            entry = F.sqrt(F.greatest(entry, F.lit(1e-9))) if i == j else entry / F.col(f"l_{j}_{j}")
            groups = groups.withColumn(f"l_{i}_{j}", entry)
    factors = [f"l_{i}_{j}" for i in range(len(names)) for j in range(i + 1)]
    return stored(groups.select("lang", "source", *[f"m_{x}" for x in names], *factors), "mcd")


def _measured(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Add ``raw``, the squared Mahalanobis distance of each row in its group, by forward substitution."""
    theirs = groups.withColumnsRenamed({"lang": "g_lang", "source": "g_source"})
    alike = rows["lang"].eqNullSafe(theirs["g_lang"]) & rows["source"].eqNullSafe(theirs["g_source"])
    rows = rows.join(theirs, alike, "left")
    total = F.lit(0.0)
    for i, a in enumerate(GRANTED):
        rest = F.col(a) - F.col(f"m_{a}")
        for k in range(i):
            rest = rest - F.col(f"l_{i}_{k}") * F.col(f"y_{k}")
        rows = rows.withColumn(f"y_{i}", rest / F.col(f"l_{i}_{i}"))
        total = total + F.col(f"y_{i}") * F.col(f"y_{i}")
    return rows.withColumn("raw", total)


def _bin() -> Column:
    return F.floor(BINS * F.log2(F.col("raw") + 1e-3))


def _limits(measured: DataFrame) -> DataFrame:
    """Per group the bin of distance that its nearest SUBSET of documents reach up to, from exact counts of bins."""
    counts = measured.groupBy("lang", "source", _bin().alias("bin")).count()
    group = Window.partitionBy("lang", "source")
    counts = counts.withColumn("below", F.sum("count").over(group.orderBy("bin"))).withColumn("all", F.sum("count").over(group))
    reached = counts.where(F.col("below") >= SUBSET * F.col("all")).groupBy("lang", "source").agg(F.min("bin").alias("limit"))
    return reached.withColumnsRenamed({"lang": "b_lang", "source": "b_source"})


def _bounded(measured: DataFrame, limits: DataFrame) -> DataFrame:
    alike = measured["lang"].eqNullSafe(limits["b_lang"]) & measured["source"].eqNullSafe(limits["b_source"])
    return measured.join(limits, alike, "left")


def covariance_determinant(stats: DataFrame) -> DataFrame:
    """Minimum-covariance-determinant estimates: centre, Cholesky factor and spread for each language and source.

    Start from all documents with a diagonal covariance, then repeat: take the nearest SUBSET of each group and estimate
    anew. Each step can only lower the determinant. ``spread`` corrects the covariance for being taken from the near
    documents alone. Estimates are written down after each step; they are one row a group.
    """
    rows = transformed(stats)
    names = list(GRANTED)
    middle = rows.groupBy("lang", "source").agg(
        F.count("*").alias("n"), *[F.percentile_approx(x, 0.5, 1000).alias(f"m_{x}") for x in names]
    )
    pairs = [(a, b) for i, a in enumerate(names) for b in names[: i + 1]]
    groups = _factored(middle.select("*", *[F.lit(0.0).alias(f"c_{a}_{b}") for a, b in pairs]))
    for _ in range(STEPS):
        measured = _measured(rows, groups)
        near = _bounded(measured, _limits(measured)).where(_bin() <= F.col("limit"))
        groups = _factored(_moments(near))
    reach = _limits(_measured(rows, groups)).withColumn("spread", F.greatest(F.pow(2.0, (F.col("limit") + 1) / BINS) / CHI2_75[len(names)], F.lit(1.0)))
    return stored(_bounded(groups, reach).drop("b_lang", "b_source", "limit"), "mcd")


def quality_verdicts(docs: DataFrame, *more: str) -> DataFrame:
    """Each document with its counts, ``base_failed``, the squared ``distance`` from its group, and ``kept``.

    ``more`` names further columns of the input to carry along: they are written down with the counts, so that estimates
    read the counts alone and the verdict still stands on the row it belongs to.
    """
    stats = stored(text_stats(docs, *more), "stats")
    judged = _measured(transformed(stats), covariance_determinant(stats.drop(*[c for c in more if c not in ("doc_id", "lang", "source")]))).withColumn("distance", F.col("raw") / F.col("spread"))
    return judged.select(
        "doc_id",
        "lang",
        "source",
        *[c for c in more if c not in ("doc_id", "lang", "source")],
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed().alias("base_failed"),
        (~base_failed() & (F.coalesce("distance", F.lit(math.inf)) <= CUTOFF)).alias("kept"),
        "distance",
    )
