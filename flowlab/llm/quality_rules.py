"""Quality rules: text statistics, and lines that too many documents of a host share.

Method: normalised lines are hashed, the distinct documents with each line are counted per
host, lines above the limits are removed, and documents depleted by that are rejected.
Only DataFrame functions run here.

Cases: a null text is the empty text (no words, so the base rule fails it). A null host is
a host of its own. Texts that are equal count once for their lines, so copies of one text
never make its lines frequent; repeated rows are judged alike. An empty table gives an
empty result. Columns other than the id, text and host columns are never looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from flowlab.functions.columns import col
from flowlab.llm.common import SPACES, digest, stored, text_of, whole_rows, words_of

WINDOW = 8            # words of a window looked for twice in one text
MIN_WORDS = 20        # shorter texts fail the base rule
MAX_REPEAT_PCT = 30   # share of words in repeated windows above which the base rule fails
MAX_HOST_SHARE = 0.1  # a line in more than this share of a host's documents is removed ...
MIN_LINE_DOCS = 10    # ... if at least so many documents have it
MIN_KEPT_PCT = 30     # a document with less of its words left is depleted


def normalised_lines(text: Column) -> Column:
    """Per line with a word: hash of the lower-cased line, digits and spaces evened out, and its words."""
    even = F.regexp_replace(F.regexp_replace(F.lower(text), r"[\x20\x09\x0B-\x0D]+", " "), "[0-9]+", "0")
    lines = F.filter(F.transform(F.split(even, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    return F.transform(lines, lambda x: F.struct(
        F.xxhash64(x).alias("h"),
        (F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1).alias("n")))


def frequent_lines(docs: DataFrame, text: str = "text", host: str = "source",
                   max_share: float = MAX_HOST_SHARE, min_docs: int = MIN_LINE_DOCS) -> DataFrame:
    """Per host the hashes of the lines above the limits: (host, lines).

    Each document has a line once, so a host has at most (its mean number of distinct
    lines / max_share) such lines, however large it is."""
    rows = docs.select(
        col(host).alias("host"), digest(text_of(text)).alias("d"),
        F.array_distinct(F.transform(normalised_lines(text_of(text)), lambda x: x["h"])).alias("hs"))
    texts = rows.groupBy("host", "d").agg(F.any_value("hs").alias("hs"))
    # A null stands for the document itself, which gives the host's total in the same count.
    each = texts.select("host", F.explode(F.concat("hs", F.array(F.lit(None).cast("bigint")))).alias("h"))
    counts = stored(each.groupBy("host", "h").agg(F.count(F.lit(1)).alias("n"))
                    .where((F.col("n") >= min_docs) | F.col("h").isNull()))
    totals = counts.where("h IS NULL").select(F.col("host").alias("total_host"), F.col("n").alias("total"))
    return (counts.where("h IS NOT NULL")
            .join(totals, F.col("host").eqNullSafe(F.col("total_host")))
            .where(F.col("n") > F.col("total") * F.lit(max_share))
            .groupBy("host").agg(F.collect_list("h").alias("lines")))


def with_repeats(rows: DataFrame, words: str, out: str, window: int = WINDOW) -> DataFrame:
    """Adds `out`: words that stand in a window found twice or more in the same row.

    Windows are hashed by doubling (1, 2, 4, 8 words), so their cost doesn't grow with
    their length; equal hashes meet by sorting (hash, position)."""
    assert window & (window - 1) == 0, "a power of two"
    rows = rows.withColumn("_h", F.transform(words, lambda w: F.xxhash64(w)))
    step = 1
    while step < window:
        rows = rows.withColumn("_h", F.zip_with(
            "_h", F.slice("_h", step + 1, F.greatest(F.size("_h"), F.lit(1))), lambda a, b: F.xxhash64(a, b)))
        step *= 2
    rows = rows.withColumn("_h", F.slice("_h", 1, F.greatest(F.size("_h") - (window - 1), F.lit(0))))
    rows = rows.withColumn("_s", F.when(
        F.size(F.array_distinct("_h")) < F.size("_h"),
        F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    twice = F.flatten(F.zip_with(
        "_s", F.slice("_s", 2, F.size("_s")),
        lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>"))))
    rows = rows.withColumn("_p", F.sort_array(F.array_distinct(twice)))
    covered = F.aggregate(
        F.zip_with("_p", F.slice("_p", 2, F.greatest(F.size("_p"), F.lit(1))),
                   lambda p, q: F.least(F.lit(window), q - p)),
        F.lit(0).cast("bigint"), lambda x, y: x + y)
    return rows.withColumn(out, F.coalesce(covered, F.lit(0).cast("bigint"))).drop("_h", "_s", "_p")


def judge(docs: DataFrame, id_col: str = "doc_id", text: str = "text", host: str = "source",
          max_share: float = MAX_HOST_SHARE, min_docs: int = MIN_LINE_DOCS) -> DataFrame:
    """One row per row of `docs`: its statistics, `base_failed`, `n_kept_words`, `kept`, and
    `row`, the whole input row (dropped from the plan where it isn't used)."""
    return _judged(docs, _frequent(docs, text, host, max_share, min_docs), id_col, text, host)


def _frequent(docs: DataFrame, text: str, host: str, max_share: float, min_docs: int) -> DataFrame:
    return stored(frequent_lines(docs, text, host, max_share, min_docs)
                  .withColumnRenamed("host", "frequent_host"))


def _judged(docs: DataFrame, frequent: DataFrame, id_col: str, text: str, host: str) -> DataFrame:
    t = F.col("_text")
    rows = docs.select(whole_rows(docs).alias("row"), col(id_col).alias("doc_id"),
                       col(host).alias("_host"), text_of(text).alias("_text"))
    rows = rows.withColumn("_words", words_of(t)).withColumn(
        "_texts", F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    rows = with_repeats(rows, "_words", "n_repeat_words").select(
        "row", "doc_id", "_host",
        F.size("_words").cast("bigint").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        (F.size("_texts") - F.size(F.array_distinct("_texts"))).cast("bigint").alias("n_dup_lines"),
        "n_repeat_words",
        normalised_lines(t).alias("_lines"))
    judged = rows.join(frequent, F.col("_host").eqNullSafe(F.col("frequent_host")), "left")
    removed = F.aggregate(
        F.filter("_lines", lambda x: F.array_contains("lines", x["h"])),
        F.lit(0).cast("bigint"), lambda n, x: n + x["n"])
    failed = ((F.col("n_words") < MIN_WORDS)
              | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words")))
    left = F.col("n_words") - F.when(F.col("lines").isNull(), F.lit(0)).otherwise(removed)
    return (judged.withColumn("base_failed", failed).withColumn("n_kept_words", left)
            # One expression over both sides of the join: a filter on it stays above the join,
            # where the statistics are columns, instead of repeating their expressions.
            .withColumn("kept", F.when(F.col("base_failed"), F.lit(False)).otherwise(
                (F.col("n_kept_words") >= MIN_WORDS)
                & (100 * F.col("n_kept_words") >= MIN_KEPT_PCT * F.col("n_words"))))
            .select("row", "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                    "n_repeat_words", "n_kept_words", "base_failed", "kept"))


def without_frequent_lines(docs: DataFrame, text: str = "text", host: str = "source",
                           max_share: float = MAX_HOST_SHARE, min_docs: int = MIN_LINE_DOCS) -> DataFrame:
    """`docs` with the lines above the limits taken out of their texts."""
    return _without(docs, _frequent(docs, text, host, max_share, min_docs), text, host)


def _without(docs: DataFrame, frequent: DataFrame, text: str, host: str) -> DataFrame:
    rows = docs.select(whole_rows(docs).alias("row"), col(host).alias("_host"))
    t = F.col("row").getField(text)
    even = F.regexp_replace(F.regexp_replace(F.lower(t), r"[\x20\x09\x0B-\x0D]+", " "), "[0-9]+", "0")
    rows = rows.select("row", "_host", F.transform(
        F.arrays_zip(F.split(t, "\n").alias("line"), F.split(even, "\n").alias("even")),
        lambda x: F.struct(x["line"].alias("line"), F.xxhash64(F.trim(x["even"])).alias("h"))).alias("_lines"))
    rows = rows.join(frequent, F.col("_host").eqNullSafe(F.col("frequent_host")), "left")
    kept = F.filter("_lines", lambda x: ~F.coalesce(F.array_contains("lines", x["h"]), F.lit(False)))
    clean = F.when(t.isNotNull(), F.array_join(F.transform(kept, lambda x: x["line"]), "\n"))
    return rows.select(F.col("row").withField(f"`{text}`", clean).alias("row")).select("row.*")


def keep_good(docs: DataFrame, id_col: str = "doc_id", text: str = "text", host: str = "source",
              max_share: float = MAX_HOST_SHARE, min_docs: int = MIN_LINE_DOCS) -> DataFrame:
    """The rows of `docs` that the rules keep, without the lines above the limits. Other columns
    are unchanged, also where they tell of the text as it was."""
    frequent = _frequent(docs, text, host, max_share, min_docs)
    kept = _judged(docs, frequent, id_col, text, host).where("kept").select("row.*")
    return _without(kept, frequent, text, host)
