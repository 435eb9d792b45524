"""URL filters: fixed rules first, and for all other addresses naive Bayes on the words in host and path.

Hosts run words together. Their labels are cut by a unigram model: word counts over the visible text of all pages, and
the most probable split by Viterbi. Counts meet labels in a join: each different label is exploded into its substrings,
so no lexicon has to fit anywhere. Multinomial naive Bayes then learns from the addresses that a rule decides, over
hashed words, so its two rows of BUCKETS counts are bounded, and judges the rest.

Defined cases: a null url, or one without ``://``, has empty host and path; labels over LABEL characters are cut there;
html may be null; without any address that a rule decides, the verdict is allow, also in a tie; repeated rows get equal
results; an empty table is empty.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pedalflow.llm.common import picked
from pedalflow.session import stored

#: The rules, host and path, with what they say.
RULES = {
    "org/": "allow",
    "example.org/es/": "block",
    "example.org/en/1": "block",
    "com/fr/": "allow",
    "com/de/": "block",
}
LABEL = 63
LONGEST = 20
BUCKETS = 1 << 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased, and path."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    pick = lambda k: F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", k)
    return F.translate(pick(1), UPPER, LOWER), pick(2)


def rule(host: Column, path: Column) -> Column:
    """The longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for name in sorted(RULES, key=len):
        site, slash, rest = name.partition("/")
        fits = ((host == site) | host.endswith("." + site)) & path.startswith(slash + rest)
        out = F.when(fits, F.lit(name)).otherwise(out)
    return out


def word_counts(pages: DataFrame) -> DataFrame:
    """word, n: of the visible text of all pages."""
    text = F.lower(F.regexp_replace("html", r"(?s)<(?:script|style)\b.*?</(?:script|style)>|<[^>]*>", " "))
    found = pages.select(F.explode(F.split(text, r"[^a-z]+", -1)).alias("word"))
    return found.where((F.length("word") > 0) & (F.length("word") <= LONGEST)).groupBy("word").agg(F.count("*").alias("n"))


def best_split(label: str, known: dict[str, float], unknown: float) -> list[str]:
    """The most probable words of a label. An unknown word costs more with every letter."""
    best: list[tuple[float, int]] = [(0.0, 0)]
    for end in range(1, len(label) + 1):
        choices = []
        for start in range(max(0, end - LONGEST), end):
            piece = label[start:end]
            cost = known.get(piece, unknown - 2.5 * len(piece))
            choices.append((best[start][0] + cost, start))
        best.append(max(choices))
    out, end = [], len(label)
    while end:
        start = best[end][1]
        out.append(label[start:end])
        end = start
    return out[::-1]


def segmented(labels: DataFrame, counts: DataFrame) -> DataFrame:
    """label and ``tokens`` for each of the different labels (letters only, at most LABEL long)."""
    total = counts.agg(F.sum("n")).first()[0] or 1
    ends = F.sequence(F.lit(1), F.least(F.lit(LONGEST), F.length("label") - F.col("at") + 1))
    pieces = labels.select("label", F.explode(F.sequence(F.lit(1), F.length("label"))).alias("at"))
    pieces = pieces.select("label", F.explode(F.transform(ends, lambda k: F.substr("label", F.col("at"), k))).alias("word")).distinct()
    known = pieces.join(counts, "word").groupBy("label").agg(F.collect_list(F.struct("word", "n")).alias("known"))
    ready = labels.join(known, "label", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for label, rows in zip(batch.column("label").to_pylist(), batch.column("known").to_pylist(), strict=True):
                # A single letter is hardly ever a word of its own.
                costs = {r["word"]: math.log(r["n"] / total) for r in rows or () if len(r["word"]) > 1}
                found.append(best_split(label, costs, -math.log(total)))
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(found, pa.list_(pa.string()))], ["label", "tokens"])

    return ready.mapInArrow(run, "label string, tokens array<string>")


def judged(pages: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict, the method's ``score`` (over 0: block) and the host's ``words``."""
    df = picked(pages, page_id="page_id", url="url", html="html")
    host, path = parts(F.col("url"))
    urls = stored(df.select("page_id", host.alias("host"), path.alias("path")), "urls")
    # Different hosts, their runs of letters, and what these split into.
    runs = F.flatten(F.transform(F.regexp_extract_all("host", F.lit("[a-z]+"), F.lit(0)), lambda r: F.regexp_extract_all(r, F.lit(f".{{1,{LABEL}}}"), F.lit(0))))
    hosts = urls.select("host").distinct().select("host", F.posexplode(runs).alias("place", "label"))
    counts = stored(word_counts(df), "lexicon")
    split = segmented(hosts.select("label").distinct(), counts)
    hosts = hosts.join(split, "label").groupBy("host").agg(F.sort_array(F.collect_list(F.struct("place", "tokens"))).alias("found"))
    hosts = hosts.select(F.col("host").alias("name"), F.flatten(F.col("found.tokens")).alias("words"))
    urls = urls.join(hosts, urls["host"] == hosts["name"], "left").drop("name")
    steps = F.regexp_extract_all(F.lower(F.regexp_replace("path", "[0-9]+", "0")), F.lit("[a-z]+|0"), F.lit(0))
    urls = urls.withColumn("words", F.coalesce("words", F.array().cast("array<string>"))).withColumn("rule", rule(F.col("host"), F.col("path")))
    place = lambda kind: lambda w: F.pmod(F.xxhash64(F.lit(kind), w), F.lit(BUCKETS)).cast("int")
    urls = urls.withColumn("places", F.concat(F.transform("words", place("host")), F.transform(steps, place("path"))))
    urls = stored(urls, "urls")
    said = F.element_at(F.create_map(*[F.lit(x) for pair in RULES.items() for x in pair]), F.col("rule"))
    urls = urls.withColumn("said", said)
    taught = urls.where("rule is not null").groupBy("said", "places").count()
    tally = taught.select("said", "count", F.explode("places").alias("place")).groupBy("said", "place").agg(F.sum("count").alias("n"))
    seen = np.ones((2, BUCKETS))
    for row in tally.collect():  # at most two rows a bucket
        seen[int(row["said"] == "block"), row["place"]] += row["n"]
    groups = dict(taught.groupBy("said").agg(F.sum("count")).collect())
    lead = np.log(seen[1] / seen[1].sum()) - np.log(seen[0] / seen[0].sum())
    prior = math.log((groups.get("block", 0) + 1) / (groups.get("allow", 0) + 1)) if groups else 0.0
    shared = df.sparkSession.sparkContext.broadcast((lead, prior, bool(groups)))
    kind = urls.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leads, start, taught_any = shared.value
        for batch in batches:
            scores = [start + float(leads[p].sum()) if taught_any else 0.0 for p in batch.column("places").to_pylist()]
            said_so = batch.column("said").to_pylist()
            verdicts = [s or ("block" if x > 0 else "allow") for s, x in zip(said_so, scores, strict=True)]
            columns = [*[batch.column(c) for c in ("page_id", "host", "path", "rule")], pa.array(verdicts, pa.string()), pa.array(scores, pa.float64()), batch.column("words")]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "host", "path", "rule", "verdict", "score", "words"])

    shape = f"page_id {kind}, host string, path string, rule string, verdict string, score double, words array<string>"
    return urls.select("page_id", "host", "path", "rule", "said", "places", "words").mapInArrow(run, shape)
