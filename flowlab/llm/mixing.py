"""Mixing sources to target weights by a low-discrepancy schedule.

Method: the words of each source are laid out as one line, its documents in shuffled order,
and repeated; the line is cut into blocks of equal numbers of words. Slot i of the schedule
holds the golden-ratio point frac(i * phi), which the cumulative target weights map to a
source. Slots are ranked within their source, and slot number r of a source takes block r.
Every stretch of the schedule thus holds each source in its share, to within a few blocks;
a source that ends a few blocks short gets its last ones at the end of the schedule, and
its last block is cut where the target is reached.

All ranks and positions are sums over hash buckets of bounded size, in two levels, so no
source is ever in one task. Only DataFrame functions run here.

A document's places in the mix are the slots of its blocks; mixed rows are written in that order.

Cases: a null or wordless text has size 0 and is never taken. A null source is a source of
its own, the last one. Repeated rows are laid out one after the other, each with its own
words. An empty table gives an empty result. Ids may be null or repeat. Other columns
aren't looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from flowlab.functions.columns import col
from flowlab.llm.common import offsets, row_digest, stored, text_of, whole_rows, words_of

WEIGHTS = (1, 2, 3)     # of the sources in order of their names, repeating
MAX_REPEATS = 3         # of a document
SLOTS_PER_DOC = 4       # so that even small sources get many blocks
BUCKET_ROWS = 4_096     # rows ranked together, about
POINT_BITS = 31         # so that products of two such numbers fit a long
PHI = 1_327_217_885     # fixed value: the golden ratio's fraction times 2^31, rounded to odd


def sized_rows(docs: DataFrame, id_col: str, text: str, source: str) -> DataFrame:
    """Per row its id, source, size in words, and a digest of all its columns' values."""
    return docs.select(
        col(id_col).alias("doc_id"), col(source).alias("source"),
        F.size(words_of(text_of(text))).cast("bigint").alias("size"),
        row_digest(docs).alias("d"))


def source_targets(rows: DataFrame, weights: Sequence[int] = WEIGHTS,
                   max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Per source: its rows, its size, its weight, and its target of the total of all sizes.

    Targets follow the weights, up to max_repeats times a source's size; the excess is
    shared again until none is above. A round fixes at least one source."""
    sizes = rows.groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    at = F.row_number().over(order) - 1
    sources = stored(sizes.withColumn("at", at.cast("bigint")).withColumn(
        "weight", F.element_at(F.array(*[F.lit(int(w)).cast("bigint") for w in weights]),
                               (F.col("at") % len(weights) + 1).cast("int"))))
    most = (F.col("source_size") * max_repeats).cast("double")
    total = rest = sources.agg(F.sum("source_size")).head()[0] or 0
    weight, fixed, known = 1, F.lit(False), -1
    while True:
        now = sources.agg(F.count_if(fixed), F.sum(F.when(fixed, F.col("source_size") * max_repeats)),
                          F.sum(F.when(~fixed, F.col("weight")))).head()
        if now[0] == known or not now[2]:
            break
        known, rest, weight = now[0], total - (now[1] or 0), now[2]
        share = F.lit(float(rest)) * F.col("weight") / F.lit(float(weight))
        fixed = most < share
    return sources.withColumn("target", F.when(fixed, most).otherwise(
        F.lit(float(rest)) * F.col("weight") / F.lit(float(weight))))


def placed_rows(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Per row its source's figures and `start`, its first word's place on the source's line."""
    line = sources.withColumnRenamed("source", "_source")
    mark = F.xxhash64("doc_id", "d")
    rows = (rows.join(line, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
            .withColumn("mark", mark)
            .withColumn("bucket", F.pmod("mark", F.ceil(F.col("rows") / F.lit(BUCKET_ROWS)))))
    sums = rows.groupBy("at", "bucket").agg(F.sum("size").alias("bucket_size"))
    before = offsets(sums, ["at"], "bucket", "bucket_size").select("at", "bucket", "before")
    inside = (Window.partitionBy("at", "bucket").orderBy("mark", "doc_id", "d")
              .rowsBetween(Window.unboundedPreceding, -1))
    return (rows.join(before, ["at", "bucket"])
            .withColumn("start", F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .drop("mark", "bucket", "before", "rows"))


def slots(sources: DataFrame, block: int, total: int) -> DataFrame:
    """(slot, at, rank): the schedule, as far as each source's quota of words needs it."""
    spark = sources.sparkSession
    count, whole = -(-total // block), 1 << POINT_BITS
    order = Window.orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    high = F.least(F.round(F.sum("target").over(order) / F.lit(float(max(total, 1))) * whole), F.lit(whole))
    ranges = sources.withColumn("high", high.cast("bigint")).withColumn(
        "low", F.coalesce(F.lag("high").over(Window.orderBy("at")), F.lit(0)))
    # Points meet the sources' ranges by the bin they fall in; bins grow with the sources.
    bins = 1 << max(10, sources.count().bit_length() + 2)
    width = whole // bins
    cells = ranges.where("low < high").select(
        "at", "low", "high",
        F.explode(F.sequence(F.floor(F.col("low") / width), F.floor((F.col("high") - 1) / width))).alias("bin"))
    ids = spark.range(count).withColumnRenamed("id", "slot")
    points = ids.withColumn(
        "point", (F.col("slot").bitwiseAND(F.lit(whole - 1)) * PHI).bitwiseAND(F.lit(whole - 1)))
    drawn = (points.withColumn("bin", F.floor(F.col("point") / width)).join(stored(cells), "bin")
             .where("low <= point AND point < high")
             .select("slot", "at", F.floor(F.col("slot") / BUCKET_ROWS).alias("run")))
    each = drawn.groupBy("at", "run").agg(F.count(F.lit(1)).alias("drawn"))
    before = stored(offsets(each, ["at"], "run", "drawn"))
    inside = Window.partitionBy("at", "run").orderBy("slot")
    ranked = drawn.join(before.select("at", "run", "before"), ["at", "run"]).select(
        "slot", "at", (F.col("before") + F.row_number().over(inside) - 1).alias("rank"))
    needed = sources.select("at", F.ceil(F.col("quota") / F.lit(block)).alias("needed"))
    got = needed.join(before.groupBy("at").agg(F.sum("drawn").alias("got")), "at", "left").select(
        "at", "needed", F.coalesce("got", F.lit(0)).alias("got"))
    short = got.where("got < needed").select(
        "at", F.explode(F.sequence("got", F.col("needed") - 1)).alias("rank")).select(
        (F.lit(count) + F.col("rank")).alias("slot"), "at", "rank")
    return ranked.join(needed, "at").where("rank < needed").select("slot", "at", "rank").union(short)


def schedule(placed: DataFrame, sources: DataFrame) -> DataFrame:
    """The mixed sequence: (slot, at, doc_id, start, pass, first_word, n_words), pieces of
    documents in order of slot, source and place on the line."""
    sums = sources.agg(F.sum("source_size"), F.sum("rows")).head()
    total = sums[0] or 0
    block = max(1, -(-total // max(1, SLOTS_PER_DOC * (sums[1] or 0))))
    begin = F.col("pass") * F.col("source_size") + F.col("start")
    end = F.least(begin + F.col("size"), F.col("quota"))
    turns = (placed.where("size > 0 AND quota > start")
             .withColumn("pass", F.explode(F.sequence(
                 F.lit(0).cast("bigint"),
                 F.floor((F.col("quota") - 1 - F.col("start")) / F.col("source_size")))))
             .withColumn("begin", begin).withColumn("end", end))
    parts = turns.withColumn("rank", F.explode(F.sequence(
        F.floor(F.col("begin") / F.lit(block)), F.floor((F.col("end") - 1) / F.lit(block)))))
    first = F.greatest("begin", F.col("rank") * block)
    last = F.least("end", (F.col("rank") + 1) * block)
    return parts.join(slots(sources, block, total), ["at", "rank"]).select(
        "slot", "at", "doc_id", "start", "size", "pass",
        (first - F.col("begin")).alias("first_word"), (last - first).alias("n_words"))


def _mixed(docs: DataFrame, id_col: str, text: str, source: str, weights: Sequence[int],
           max_repeats: int) -> tuple[DataFrame, DataFrame]:
    """The placed rows, stored, and the schedule's pieces."""
    rows = stored(sized_rows(docs, id_col, text, source))
    sources = stored(source_targets(rows, weights, max_repeats)
                     .withColumn("quota", F.round("target").cast("bigint")))
    placed = stored(placed_rows(rows, sources))
    return placed, schedule(placed, sources)


def mixing_schedule(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
                    weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """The mixed sequence of pieces of documents; see `schedule`."""
    return _mixed(docs, id_col, text, source, weights, max_repeats)[1]


def mix(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
        weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per row of `docs`: doc_id, size, source_size, target, taken, and its places in the
    schedule: first_slot (null where nothing is taken) and n_slots."""
    placed, pieces = _mixed(docs, id_col, text, source, weights, max_repeats)
    taken = pieces.groupBy("at", "start").agg(
        F.sum("n_words").alias("words"), F.min("slot").alias("first_slot"), F.count(F.lit(1)).alias("n_slots"))
    own = F.col("size") > 0  # a row without words shares its start with the next one
    return placed.join(taken, ["at", "start"], "left").select(
        "doc_id", "size", "source_size", "target",
        F.when(own, F.coalesce("words", F.lit(0))).otherwise(F.lit(0)).alias("taken"),
        F.when(own, F.col("first_slot")).alias("first_slot"),
        F.when(own, F.coalesce("n_slots", F.lit(0))).otherwise(F.lit(0)).alias("n_slots"))


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
               weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """The rows of `docs` as the mix takes them, in order of the schedule's slots: once for each
    pass that takes half of the row's words or more (all of them, but where the source's target
    cuts a document), at the first slot of the pass."""
    placed, pieces = _mixed(docs, id_col, text, source, weights, max_repeats)
    passes = (pieces.groupBy("at", "start", "size", "pass")
              .agg(F.sum("n_words").alias("words"), F.min("slot").alias("slot")).where("2 * words >= size"))
    # Copies of a row are as many slots of its digest: rows of a join, which adaptive execution
    # splits where they are very many.
    places = (placed.where("size > 0").select("at", "start", "d").join(passes, ["at", "start"])
              .select(F.col("d").alias("_d"), F.col("slot").alias("_slot")))
    rows = docs.select(whole_rows(docs).alias("row"), row_digest(docs).alias("_d"))
    return (rows.dropDuplicates(["_d"]).join(stored(places).hint("merge"), "_d")
            .repartitionByRange("_slot").sortWithinPartitions("_slot").select("row.*"))
