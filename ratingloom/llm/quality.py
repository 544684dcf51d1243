"""Quality rules with thresholds learned per language and source.

Each document is measured inside its row. A measure is a rate with half a hit and
half a unit added, so that a document without a hit still says how rare hits can be
in a text of its size, and quartiles differ where most rates are zero. Quantile
sketches of the measures are histograms whose bucket width follows the value (at
most 1/128 of it), so a sketch is an ordinary count per bucket: it merges by
addition, from tasks into groups and from (language, source) into the language and
the whole. The upper fence of a group, the third quartile times a power of the
ratio of the quartiles, replaces a fixed cutoff: Tukey's outer fence of the
logarithms. Fences of smaller groups lean on those of the language and of the
whole, without any size at which one takes over.

Sketches hold the documents that pass the base rule, as those are judged by them.
All counts are integers, so nothing depends on the order of a sum.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.llm.words import NO_BREAK, documents, word_array
from ratingloom.session import durable

SYMBOLS = "[#*$%&|<>]"
MILLION = 1_000_000


@dataclass(frozen=True)
class Rule:
    """A rate in millionths; a document fails above the fence of its group."""

    name: str
    part: str
    whole: str


RULES = (
    Rule("symbol_share", "n_symbols", "word_chars"),
    Rule("dup_line_share", "n_dup_lines", "n_lines"),
    Rule("repeat_share", "n_repeat_words", "n_words"),
    Rule("word_length", "word_chars", "n_words"),
)
# Outer fence: so many quartile distances above the third quartile, on the scale of logarithms.
SPREAD = 3
# The logarithm of a fence of n documents has the weight n / (n + PRIOR), that of the next wider group the rest.
PRIOR = 50
# Leading bits of a value that its bucket keeps.
BITS = 8
BASE_FAILED = "n_words < 50 or 100 * n_repeat_words > 50 * n_words"


def measure(docs: DataFrame) -> DataFrame:
    """Measures of every document: ``doc_id, lang, source`` and the counts.

    ``n_repeat_words`` are the words inside a window of three words that occurs
    at least twice in the text. A null text counts as empty; every row of the
    input, repeated or not, gives one row.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    split = documents(docs, "doc_id", "lang", "source", "text").select(
        "doc_id",
        "lang",
        "source",
        word_array(F.col("text")).alias("words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(NO_BREAK)).alias("lines"),
        (F.size(F.split(text, SYMBOLS)) - 1).cast("long").alias("n_symbols"),
    )
    n = F.size("words")
    inner = F.greatest(n - 2, F.lit(0))
    thirds = F.arrays_zip(*[F.slice("words", start, inner).alias(f"w{start}") for start in (1, 2, 3)])
    windows = split.select(
        "doc_id",
        "lang",
        "source",
        "n_symbols",
        n.cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.array_sort(
            F.transform(thirds, lambda w, i: F.struct(F.xxhash64(w["w1"], w["w2"], w["w3"]).alias("h"), i.alias("at")))
        ).alias("sorted"),
    )

    def twice(window: Column, i: Column) -> Column:
        same = F.lit(False)
        for other in (i - 1, i + 1):
            same = same | F.coalesce(F.get("sorted", other)["h"] == window["h"], F.lit(False))
        return same

    found = windows.withColumn("found", F.array_sort(F.transform(F.filter("sorted", twice), lambda w: w["at"])))
    covered = F.aggregate(
        "found",
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("total")),
        lambda acc, at: F.struct(
            (at + 3).alias("end"), (acc["total"] + F.least(F.lit(3), at + 3 - acc["end"])).alias("total")
        ),
        lambda acc: acc["total"],
    )
    return found.withColumn("n_repeat_words", covered).drop("sorted", "found")


def _value(rule: Rule) -> Column:
    """The rate in millionths; null where there is nothing to measure."""
    return F.expr(f"case when {rule.whole} > 0 then ({MILLION} * (2 * {rule.part} + 1)) div (2 * {rule.whole} + 1) end")


def _bucket(value: str) -> Column:
    """Upper end of the bucket, above all its values: those with the same leading bits."""
    shift = f"greatest(length(bin({value})) - {BITS}, 0)"
    return F.expr(f"shiftleft(shiftright({value}, {shift}) + 1, {shift})")


def sketches(measured: DataFrame) -> DataFrame:
    """Mergeable sketches: documents that pass the base rule, per ``lang, source, rule, bucket``."""
    pairs = F.array(*[F.struct(F.lit(r.name).alias("rule"), _value(r).alias("value")) for r in RULES])
    passed = measured.filter(~F.expr(BASE_FAILED))
    values = passed.select("lang", "source", F.explode(pairs).alias("m")).select("lang", "source", "m.*")
    known = values.filter(F.col("value").isNotNull())
    return known.groupBy("lang", "source", "rule", _bucket("value").alias("bucket")).agg(F.count("*").alias("n"))


def _fences(sketch: DataFrame, keys: list[str], spread: int, name: str) -> DataFrame:
    """Upper fence of each group of ``keys`` and rule, with the documents it rests on."""
    merged = sketch.groupBy(*keys, "rule", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "rule")
    counted = merged.withColumn("below", F.sum("n").over(group.orderBy("bucket"))).withColumn(
        "total", F.sum("n").over(group)
    )
    quartile = {
        q: F.min(F.when(F.col("below") * 4 >= F.col("total") * q, F.col("bucket"))).cast("double") for q in (1, 3)
    }
    fence, ratio = F.col("q3"), F.col("q3") / F.col("q1")
    for _ in range(spread):
        fence = fence * ratio
    return (
        counted.groupBy(*keys, "rule")
        .agg(quartile[1].alias("q1"), quartile[3].alias("q3"), F.max("total").cast("double").alias(f"{name}_n"))
        .withColumn(f"{name}_fence", fence)
        .drop("q1", "q3")
    )


def thresholds(sketch: DataFrame, spread: int = SPREAD, prior: int = PRIOR) -> DataFrame:
    """Fences of every ``lang, source, rule``: ``group_n, group_fence, lang_n, lang_fence, all_fence`` and the ``fence`` in force."""
    groups = _fences(sketch, ["lang", "source"], spread, "group")
    languages = _fences(sketch, ["lang"], spread, "lang").withColumnsRenamed({"lang": "lang_key", "rule": "lang_rule"})
    whole = _fences(sketch, [], spread, "all").withColumnRenamed("rule", "all_rule")
    joined = groups.join(
        languages, groups["lang"].eqNullSafe(languages["lang_key"]) & (groups["rule"] == languages["lang_rule"])
    ).join(whole, F.col("rule") == F.col("all_rule"))

    def blended(name: str, wider: Column) -> Column:
        weight = F.col(f"{name}_n") / (F.col(f"{name}_n") + F.lit(float(prior)))
        return weight * F.ln(f"{name}_fence") + (F.lit(1.0) - weight) * wider

    return joined.select(
        "lang", "source", "rule", "group_n", "group_fence", "lang_n", "lang_fence", "all_fence",
        F.exp(blended("group", blended("lang", F.ln("all_fence")))).alias("fence"),
    )


def quality_rules(docs: DataFrame, spread: int = SPREAD, prior: int = PRIOR) -> DataFrame:
    """Measures and verdict of every document of ``documents(doc_id, text, lang, source)``.

    ``base_failed``: fewer than 50 words, or more than half of them repeated.
    ``kept``: not ``base_failed`` and no measure above the fence of its language
    and source. Null languages and sources are groups of their own; a document
    without words has no measures and fails the base rule. Ties with a fence are
    kept. Further columns of the input are ignored. An empty table gives no rows.
    """
    measured = durable(measure(docs), "quality-measures")
    one = {r.name: F.max(F.when(F.col("rule") == r.name, F.col("fence"))).alias(f"{r.name}_fence") for r in RULES}
    fences = thresholds(sketches(measured), spread, prior).groupBy("lang", "source").agg(*one.values())
    fences = fences.withColumnsRenamed({"lang": "fence_lang", "source": "fence_source"})
    joined = measured.join(
        fences,
        measured["lang"].eqNullSafe(fences["fence_lang"]) & measured["source"].eqNullSafe(fences["fence_source"]),
        "left",
    )
    above = F.lit(False)
    for rule in RULES:
        above = above | F.coalesce(_value(rule) > F.col(f"{rule.name}_fence"), F.lit(False))
    base = F.expr(BASE_FAILED)
    return joined.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base.alias("base_failed"),
        (~base & ~above).alias("kept"),
    )
