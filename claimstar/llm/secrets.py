"""Secret scans: candidates by pattern, false positives removed by a random forest.

DataFrame functions and Spark ML only; no Python runs on the executors.

Candidates are runs of at least `MIN_LENGTH` key characters and, of any length, the values assigned to
names that hold a credential word. Each gets its place and the text around
it, and numbers: length, shares of character classes, transitions between classes, distinct
characters, how far it is covered by the corpus's commonest words (the dictionary, counted over all
documents), signs of a path or address, and its neighbouring words. A forest trained on labelled
findings decides. Where no findings have been labelled by hand, `rule_labels` labels the clear cases:
providers' key forms and assignments to credential words against plain words, plain numbers, paths
and addresses; the rest, passwords in addresses and parts of dotted tokens among it, is left to the
forest. The fit uses at most `LABELLED_ROWS` findings of each
label (those of least hash).

Nulls: a null or empty text has no candidates; a null doc_id keeps its findings under null. Rows of
equal doc_id are scanned one by one. If only one label occurs, findings are those the rules label 1.
An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimstar.llm import common

MIN_LENGTH = 16
LABELLED_ROWS = 3000
DICTIONARY = 500
TREES = 20
DEPTH = 6
THRESHOLD = 0.5
MASK = "[secret]"
AROUND = 40  # pieces that hold the text around a candidate
STEP = 64  # pieces of a block of sums
CHUNK = 4096  # characters of a text that are masked at once

# Forms of keys that providers publish, and words that name credentials.
PROVIDERS = (
    "^(AKIA|ASIA|ABIA|ACCA)[0-9A-Z]{16}$",
    "^gh[pousr]_[0-9A-Za-z]{36,}$",
    "^xox[abprs]-[0-9A-Za-z-]{10,}$",
    "^sk-[0-9A-Za-z_-]{20,}$",
    "^(sk|rk|pk)_(live|test)_[0-9A-Za-z]{16,}$",
    "^AIza[0-9A-Za-z_-]{35}$",
    "^eyJ[0-9A-Za-z_-]{16,}$",
    "^glpat-[0-9A-Za-z_-]{20,}$",
)
CREDENTIALS = "(?i)(pass(word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|auth|credential|private[_-]?key|bearer)"
_ASSIGNED = CREDENTIALS + "[\\w-]*[\"']?\\s*(=|:|=>|:=|\\s)\\s*[\"']?$"

# Runs and names begin where no character of theirs stands before, so a word is tried once, not at each
# of its letters.
_RUN = "(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}(?:={1,2}(?![A-Za-z0-9+/_=\"'-]))?" % MIN_LENGTH  # not the = of an assignment
_NAME = "(?<![\\w-])[\\w-]*" + re.sub(r"\((?!\?)", "(?:", CREDENTIALS) + "[\\w-]*"
_VALUE = "[^\\s\"',;<>]*[^\\s\"',;<>.)\\]}]"
_FORM = f"({_NAME})([\"']?\\s*(?::=|=>|=|:)\\s*[\"']?)({_VALUE})|({_RUN})"
_MARK = "\u0001"
_LOWER = "abcdefghijklmnopqrstuvwxyz"
_CLASSES = (_LOWER + _LOWER.upper() + "0123456789+/_-=", "a" * 26 + "A" * 26 + "0" * 10 + "-----")

NUMBERS = (
    "n", "digits", "uppers", "lowers", "marks", "transitions", "distinct", "longest_word", "hex",
    "coverage", "slashes", "address", "in_word", "assigned", "credential_near", "quoted",
)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body over a value that is computed once, however often and deep the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda total, n: total + n)


def _begins(pieces: Column) -> Column:
    """Where each piece of a text begins, in code points.

    Sums over blocks of `STEP` pieces, then within them: the work grows with the number of pieces,
    where an array extended piece by piece would be copied as often as there are pieces.
    """

    def block(i: Column) -> Column:
        return F.floor(i / STEP).cast("int")

    def extended(sums: Column, n: Column) -> Column:
        return F.concat(sums, F.array(F.element_at(sums, -1) + n))

    def begins(sizes: Column) -> Column:
        numbers = F.sequence(F.lit(0), block(F.size(sizes) - 1))
        blocks = F.transform(numbers, lambda b: _sum(F.slice(sizes, b * STEP + 1, F.lit(STEP))))
        starts = _let(blocks, lambda sums: F.aggregate(sums, F.array(F.lit(0)), extended))
        within = lambda i: _sum(F.slice(sizes, block(i) * STEP + 1, i % STEP))
        at = lambda starts: F.transform(sizes, lambda _, i: F.get(starts, block(i)) + within(i))
        return _let(starts, at)

    return _let(F.transform(pieces, F.length), begins)


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, row, begin, secret, before, after: every candidate and the text around it.

    The marked text falls into gap, name, separator, value or run, gap, and so on; a run without a
    name has an empty one. Names are candidates where they are runs themselves.
    """
    plain = common.keyed(docs).where(F.col("text").rlike(_FORM))
    form = f"{_MARK}$1{_MARK}$2{_MARK}$3$4{_MARK}"
    marked = F.regexp_replace(F.translate("text", _MARK, " "), F.lit(_FORM), F.lit(form))

    def found_in(p: Column) -> Column:
        around = F.struct(
            _begins(p).alias("begins"),
            F.transform(p, lambda x: F.substring(x, -60, 60)).alias("heads"),
            F.transform(p, lambda x: F.substring(x, 1, 40)).alias("tails"),
        )
        return _let(around, lambda z: F.transform(odd(p), lambda i: candidate(p, z, i)))

    def odd(p: Column) -> Column:
        return F.sequence(F.lit(1), F.size(p) - 2, F.lit(2))

    def candidate(p: Column, z: Column, i: Column) -> Column:
        n = F.least(i, F.lit(AROUND))
        before = F.array_join(F.slice(z["heads"], i - n + 1, n), "")
        after = F.array_join(F.slice(z["tails"], i + 2, F.lit(AROUND)), "")
        return F.struct(
            F.get(z["begins"], i).alias("begin"),
            F.get(p, i).alias("secret"),
            F.substring(before, -60, 60).alias("before"),
            F.substring(after, 1, 40).alias("after"),
            (i % 4 == 1).alias("name"),
        )

    pieces = F.split(marked, _MARK)
    found = plain.select("doc_id", "row", F.explode(_let(pieces, found_in)).alias("c"))
    kept = F.when(F.col("c.name"), F.col("c.secret").rlike(f"^{_RUN}$")).otherwise(F.col("c.secret") != "")
    return found.where(kept).select("doc_id", "row", "c.begin", "c.secret", "c.before", "c.after")


def dictionary(docs: DataFrame, words: int = DICTIONARY) -> list[str]:
    """The commonest words of four to eight letters, counted over all documents; at most `words`."""
    found = common.texts(docs).select(
        F.explode(F.regexp_extract_all(F.lower("text"), F.lit("\\b[a-z]{4,8}\\b"), F.lit(0))).alias("w")
    )
    top = found.groupBy("w").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "w").limit(words)
    return sorted(r["w"] for r in top.collect())


def _share(pattern: str) -> Column:
    return F.length(F.regexp_replace("secret", f"[^{pattern}]", "")) / F.length("secret")


def with_numbers(found: DataFrame, words: list[str]) -> DataFrame:
    """The findings with the forest's numbers."""
    classes = F.translate("secret", *_CLASSES)
    runs = F.regexp_replace(classes, "(.)\\1+", "$1")
    size = F.length("secret")
    lower = F.lower("secret")
    letters = F.regexp_extract_all(lower, F.lit("[a-z]+"), F.lit(0))
    longest = F.coalesce(F.array_max(F.transform(letters, F.length)), F.lit(0))
    if words:
        known = F.filter(F.array(*map(F.lit, words)), lambda w: F.contains(lower, w))
        covered = F.aggregate(F.transform(known, F.length), F.lit(0), lambda a, b: a + b)
    else:
        covered = F.lit(0)
    flag = lambda c: c.cast("double")
    near = F.concat_ws(" ", F.coalesce("before", F.lit("")), F.coalesce("after", F.lit("")))
    address = F.col("before").rlike("([a-z]+://|www\\.|[@.#?&/])\\S*$") | F.col("after").rlike("^(@|\\.[a-z])")
    numbers = {
        "n": size.cast("double"),
        "digits": _share("0-9"),
        "uppers": _share("A-Z"),
        "lowers": _share("a-z"),
        "marks": _share("+/_=\\-"),
        "transitions": (F.length(runs) - 1) / size,
        "distinct": F.size(F.array_distinct(F.split("secret", ""))) / size,
        "longest_word": longest / size,
        "hex": flag(F.col("secret").rlike("^[0-9a-f]+$")),
        "coverage": F.least(F.lit(1.0), covered / size),
        "slashes": (size - F.length(F.replace("secret", F.lit("/")))).cast("double"),
        "address": flag(address),
        "in_word": flag(F.col("before").rlike("[^\\x00-\\x7F]$") | F.col("after").rlike("^[^\\x00-\\x7F]")),
        "assigned": flag(F.col("before").rlike("[=:]\\s*[\"']?$")),
        "credential_near": flag(near.rlike(CREDENTIALS)),
        "quoted": flag(F.col("before").rlike("[\"']$")),
    }
    return found.withColumns(numbers)


def rule_labels(found: DataFrame) -> DataFrame:
    """The findings with a label: 1 and 0 in the clear cases, null in the others."""
    provider = F.lit(False)
    for form in PROVIDERS:
        provider = provider | F.col("secret").rlike(form)
    digit = F.col("secret").rlike("[0-9]")
    assigned = F.col("before").rlike(_ASSIGNED) & digit & ~F.col("secret").rlike("^[0-9]+$")
    plain = ~digit | F.col("secret").rlike("^[0-9-]+$") | (F.col("address") > 0) | (F.col("slashes") > 2)
    password = F.col("before").rlike("://[^\\s/@]*$") & F.col("after").rlike("^[^\\s/]*@")
    dotted = F.col("before").rlike("[0-9A-Za-z_-]{%d,}\\.$" % MIN_LENGTH)
    label = F.when(provider | assigned, 1.0).when(plain & ~password & ~dotted, 0.0)
    return found.withColumn("label", label)


def train(labelled: DataFrame, rows: int = LABELLED_ROWS) -> PipelineModel | None:
    """The forest of at most `rows` findings of each label; None if a label does not occur."""
    known = labelled.where("label is not null")
    order = [F.xxhash64("secret", "before"), "secret", "before", "after"]
    parts = [
        known.where(F.col("label") == y).orderBy(*order).limit(rows).select("label", *NUMBERS)
        for y in (0.0, 1.0)
    ]
    sample = common.stored(parts[0].union(parts[1]).coalesce(1), "labelled-findings")
    if sample.select("label").distinct().count() < 2:
        return None
    inputs = VectorAssembler(inputCols=list(NUMBERS), outputCol="numbers", handleInvalid="keep")
    forest = RandomForestClassifier(
        featuresCol="numbers", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=7
    )
    return Pipeline(stages=[inputs, forest]).fit(sample)


def scan(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """doc_id, begin, end, secret, probability, row of every finding that the forest leaves standing.

    `labelled` may bring findings of the same columns with labels of one's own.
    """
    words = dictionary(docs)
    found = common.stored(rule_labels(with_numbers(candidates(docs), words)), "findings")
    model = train(found if labelled is None else labelled)
    if model is None:
        sure = found.where("label = 1.0").withColumn("probability", F.lit(1.0))
    else:
        share = F.element_at(vector_to_array("probability"), 2)
        sure = model.transform(found).withColumn("probability", share)
        sure = sure.where(F.col("probability") >= THRESHOLD)
    end = (F.col("begin") + F.length("secret")).alias("end")
    return sure.select("doc_id", "begin", end, "secret", "probability", "row")


def _spans(findings: DataFrame, by: str) -> DataFrame:
    """claimstar_key, chunk, parts: the places to mask of each chunk; overlapping findings are one."""
    found = findings.select(F.col(by).alias("claimstar_key"), "begin", "end")
    found = found.where("claimstar_key is not null and begin < end").distinct()
    one = Window.partitionBy("claimstar_key").orderBy("begin", "end")
    earlier = F.max("end").over(one.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.coalesce(F.col("begin") >= earlier, F.lit(True)).cast("int")
    runs = found.withColumn("fresh", fresh).withColumn("run", F.sum("fresh").over(one))
    runs = runs.groupBy("claimstar_key", "run").agg(F.min("begin").alias("begin"), F.max("end").alias("end"))
    first, last = F.floor(F.col("begin") / CHUNK), F.floor((F.col("end") - 1) / CHUNK)
    split = runs.withColumn("chunk", F.explode(F.sequence(first, last)))
    at = F.col("chunk") * CHUNK
    part = F.struct(
        F.greatest(F.col("begin") - at, F.lit(0)).cast("int").alias("begin"),
        F.least(F.col("end") - at, F.lit(CHUNK)).cast("int").alias("end"),
        F.when(F.col("begin") >= at, MASK).otherwise("").alias("mask"),
    )
    return split.groupBy("claimstar_key", "chunk").agg(F.sort_array(F.collect_list(part)).alias("parts"))


def redacted(docs: DataFrame, findings: DataFrame, by: str | None = None) -> DataFrame:
    """The documents with the place of every finding masked and n_chars counted anew.

    Text outside of the findings' places stays, also where it equals a secret. By "row", findings belong to
    the rows they were found in, as `scan` gives them; by "doc_id", for findings from elsewhere, their
    places are those of every text of that id, and rows without an id stay as they are. Unless told, it
    goes by doc_id, and by row where the findings have no doc_id. Places
    beyond the end of a text mask nothing. Texts are worked on in chunks, so the work grows with
    their length and not with that times the number of findings.
    """
    if by is None:
        by = "doc_id" if "doc_id" in findings.columns else "row"
    if by not in ("doc_id", "row"):
        raise ValueError("findings belong to documents by doc_id or by row")
    spans = common.stored(_spans(findings, by), "secrets-by-document")
    key = common.row_key() if by == "row" else F.col("doc_id")
    texts = docs.select(common.row_key().alias("claimstar_row"), key.alias("claimstar_key"), "text")
    texts = texts.where("text is not null")
    texts = texts.join(spans.select("claimstar_key").distinct(), "claimstar_key", "left_semi")
    chunks = F.regexp_extract_all("text", F.lit("(?s).{1,%d}" % CHUNK), F.lit(0))
    chunks = texts.dropDuplicates(["claimstar_row"]).select(
        "claimstar_row", "claimstar_key", F.posexplode(chunks).alias("chunk", "part")
    )
    chunks = chunks.withColumn("chunk", F.col("chunk").cast("long"))
    masked = F.aggregate(
        "parts",
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda a, s: F.struct(
            s["end"].alias("at"),
            F.concat(
                a["out"],
                F.substring("part", a["at"] + 1, F.greatest(s["begin"] - a["at"], F.lit(0))),
                F.when(s["begin"] < F.length("part"), s["mask"]).otherwise(""),
            ).alias("out"),
        ),
        lambda a: F.concat(a["out"], F.substring("part", a["at"] + 1, F.lit(CHUNK))),
    )
    masked = F.when(F.col("parts").isNull(), F.col("part")).otherwise(masked)
    rebuilt = (
        chunks.join(spans, ["claimstar_key", "chunk"], "left")
        .select("claimstar_row", F.struct("chunk", masked.alias("masked")).alias("piece"))
        .groupBy("claimstar_row")
        .agg(F.sort_array(F.collect_list("piece")).alias("pieces"))
        .select("claimstar_row", F.array_join("pieces.masked", "").alias("claimstar_text"))
    )
    out = docs.withColumn("claimstar_row", common.row_key()).join(rebuilt, "claimstar_row", "left")
    changed = F.col("claimstar_text").isNotNull()
    new = {"text": F.coalesce("claimstar_text", "text")}
    if "n_chars" in docs.columns:
        size = F.length("claimstar_text").cast("long")
        new["n_chars"] = F.when(changed, size).otherwise(F.col("n_chars"))
    return out.withColumns(new).select(*docs.columns)


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(common.table(spark, sf_dir, "documents")).drop("row")
