"""Registered queries over the driver tables, each with its SQL where SQL can say it.

`lineitem` stands in for the flow table: its rows are flows, and `label` is the return
flag with the line status (six classes). Derived columns make a redundant feature
(`revenue`), one that is redundant and hardly varies (`tiny`) and a constant one. `band`
is a class that depends on the features in nine rows of ten, for the classifiers.
`events` and `orders` are two sources of differing columns.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.storagelevel import StorageLevel

from flowlab.functions.small import local_rows
from flowlab.functions.verdicts import one_vs_rest_probability, top_probability
from flowlab.operators import classifiers as C
from flowlab.operators import evaluate as V
from flowlab.operators import prepare as P
from flowlab.operators import profile as E
from flowlab.operators import sampling as M
from flowlab.operators import score as S
from flowlab.operators import select as X
from flowlab.operators.encoder import CategoryEncoder, CategoryEncoderModel
from flowlab.plans import train as T
from flowlab.plans.clean import clean
from flowlab.plans.scoring import score
from flowlab.plans.training import train_and_report
from flowlab.sources import models as model_store
from flowlab.sources import reports, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
FEATURES = ["quantity", "price", "discount", "tax", "revenue", "tiny", "constant"]
MODEL_FEATURES = FEATURES[:5]
KEYS = ", ".join(KEY)
SEED = 42


def query(name: str, sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tables.load(spark, f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A fresh folder on the cluster's shared storage."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return f"{shared}/{uuid.uuid4().hex}"


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        *KEY,
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"),
        (F.col("l_discount") * 0.01 + F.col("l_tax") * 0.001).alias("tiny"),
        F.lit(1.0).alias("constant"),
        F.concat("l_returnflag", "l_linestatus").alias("label"),
        F.when(F.col("l_partkey") % 10 == 0, F.col("l_suppkey") % 6).otherwise(
            (2 * F.floor((F.col("l_quantity") - 1) / 17)
             + (F.col("l_tax") >= 0.04).cast("int")).cast("bigint")).alias("band"),
    )


FLOWS = f"""flows AS (
  SELECT {KEYS}, l_quantity AS quantity, l_extendedprice AS price,
    l_discount AS discount, l_tax AS tax, l_extendedprice * (1 - l_discount) AS revenue,
    l_discount * 0.01::DOUBLE + l_tax * 0.001::DOUBLE AS tiny, CAST(1 AS DOUBLE) AS constant,
    l_returnflag || l_linestatus AS label,
    CASE WHEN l_partkey % 10 = 0 THEN l_suppkey % 6 ELSE
      CAST(2 * floor((l_quantity - 1) / 17) + CASE WHEN l_tax >= 0.04 THEN 1 ELSE 0 END AS BIGINT)
    END AS band
  FROM lineitem)"""


def order_sql(seed: int = SEED) -> str:
    return f"md5(concat_ws(':', '{seed}', {KEYS}))"


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in columns})


def r(expression: str, digits: int = 6) -> str:
    return f"round({expression}, {digits}) + 0.0"


# ---------------------------------------------------------------- sources and sinks

@query("parquet_scan", f"SELECT {KEYS}, l_quantity FROM lineitem")
def parquet_scan(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(*KEY, "l_quantity")


BOTH = """SELECT c_custkey AS k, c_acctbal AS bal FROM customer
  UNION ALL SELECT s_suppkey AS k, s_acctbal AS bal FROM supplier"""


@query("multi_file_concat", BOTH)
def multi_file_concat(spark, sf_dir):
    folder = scratch(spark)
    customer = table(spark, sf_dir, "customer").selectExpr("c_custkey k", "c_acctbal bal")
    supplier = table(spark, sf_dir, "supplier").selectExpr("s_suppkey k", "s_acctbal bal")
    tables.save(customer, f"{folder}/part_0")
    tables.save(supplier, f"{folder}/part_1")
    return tables.load_many(spark, [f"{folder}/part_0", f"{folder}/part_1"])


@query("parquet_sink", f"WITH {FLOWS} SELECT {KEYS}, label, revenue FROM flows")
def parquet_sink(spark, sf_dir):
    folder = scratch(spark)
    tables.save(flows(spark, sf_dir).select(*KEY, "label", "revenue"), f"{folder}/flows")
    return tables.load(spark, f"{folder}/flows")


# ---------------------------------------------------------------- profiling

@query("shape", f"""WITH {FLOWS} SELECT count(*) AS rows, 8 AS columns, 7 AS features FROM flows""")
def shape(spark, sf_dir):
    return E.shape(flows(spark, sf_dir).select(*FEATURES, "label"))


# DuckDB's type names in Spark's spelling.
DESCRIBED = f"""SELECT row_number() OVER () - 1 AS position, column_name AS "column",
  CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int'
    ELSE lower(column_type) END AS dtype FROM (DESCRIBE WITH {FLOWS} SELECT * FROM flows)"""


@query("dtypes", f"SELECT CAST(position AS INTEGER) AS position, \"column\", dtype FROM ({DESCRIBED})")
def dtypes(spark, sf_dir):
    return E.dtypes(flows(spark, sf_dir))


@query("dtype_counts", f"SELECT dtype, count(*) AS columns FROM ({DESCRIBED}) GROUP BY dtype")
def dtype_counts(spark, sf_dir):
    return E.dtype_counts(flows(spark, sf_dir))


def sources(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("id"),
        "user_id", "event_type", "value")
    orders = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("id"),
        F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("total"))
    return events, orders


MERGED = """merged AS (
  SELECT 'e' || event_id AS id, user_id, event_type, value, NULL AS status,
    CAST(NULL AS DOUBLE) AS total FROM events
  UNION ALL
  SELECT 'o' || o_orderkey, NULL, NULL, NULL, o_orderstatus, o_totalprice FROM orders)"""


@query("null_counts", f"""WITH {MERGED}
  SELECT * FROM (
  SELECT 'user_id' AS "column", count(*) - count(user_id) AS nulls FROM merged UNION ALL
  SELECT 'event_type', count(*) - count(event_type) FROM merged UNION ALL
  SELECT 'value', count(*) - count(value) FROM merged UNION ALL
  SELECT 'status', count(*) - count(status) FROM merged UNION ALL
  SELECT 'total', count(*) - count(total) FROM merged) WHERE nulls > 0""")
def null_counts(spark, sf_dir):
    return E.null_counts(P.merge_sources(*sources(spark, sf_dir)))


@query("null_total", f"""WITH {MERGED}
  SELECT 5 * count(*) - count(user_id) - count(event_type) - count(value) - count(status)
    - count(total) AS nulls FROM merged""")
def null_total(spark, sf_dir):
    return E.null_total(P.merge_sources(*sources(spark, sf_dir)))


def _describe_sql(c: str) -> str:
    quart = ", ".join(f"{r(f'quantile_cont({c}, {q})', 4)} AS {n}"
                      for q, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75")))
    return f"""SELECT '{c}' AS feature, count({c}) AS count, {r(f'avg({c})', 4)} AS mean,
      {r(f'stddev_samp({c})', 4)} AS std, {r(f'min({c})', 4)} AS min, {quart},
      {r(f'max({c})', 4)} AS max FROM flows"""


@query("describe", f"WITH {FLOWS} " + " UNION ALL ".join(_describe_sql(c) for c in FEATURES))
def describe(spark, sf_dir):
    out = E.describe(flows(spark, sf_dir), FEATURES)
    return rounded(out, 4, "mean", "std", "min", "p25", "p50", "p75", "max")


@query("describe_infinite", f"""WITH {FLOWS}, x AS (SELECT *,
    CASE WHEN l_linenumber <= 3 THEN price ELSE 'inf'::DOUBLE END AS up,
    CASE WHEN l_linenumber <= 3 THEN price ELSE '-inf'::DOUBLE END AS down FROM flows)
  SELECT 'up' AS feature, count(*) AS count, min(up) AS min, {r('quantile_cont(up, 0.25)', 4)} AS p25,
    quantile_disc(up, 0.5) AS p50, quantile_disc(up, 0.75) AS p75, max(up) AS max FROM x UNION ALL
  SELECT 'down', count(*), min(down), quantile_disc(down, 0.25), quantile_disc(down, 0.5),
    {r('quantile_cont(down, 0.75)', 4)}, max(down) FROM x""")
def describe_infinite(spark, sf_dir):
    def ended(sign: str):
        return F.when(F.col("l_linenumber") <= 3, F.col("price")).otherwise(F.lit(float(f"{sign}inf")))

    table = flows(spark, sf_dir).select(ended("").alias("up"), ended("-").alias("down"))
    out = E.describe(table, ["up", "down"]).drop("mean", "std")
    return out.withColumns({c: F.when(F.abs(c) == float("inf"), F.col(c)).otherwise(F.round(c, 4))
                            for c in ("p25", "p75")})


@query("head", f"SELECT {KEYS}, l_quantity FROM lineitem ORDER BY {KEYS} LIMIT 5")
def head(spark, sf_dir):
    return E.head(table(spark, sf_dir, "lineitem").select(*KEY, "l_quantity"), 5, KEY)


@query("class_distribution", f"WITH {FLOWS} SELECT label, count(*) AS n FROM flows GROUP BY label")
def class_distribution(spark, sf_dir):
    return E.class_distribution(flows(spark, sf_dir))


@query("label_summary", f"""WITH {FLOWS} SELECT count(DISTINCT band) AS classes,
  min(band) AS min_label, max(band) AS max_label FROM flows""")
def label_summary(spark, sf_dir):
    return E.label_summary(flows(spark, sf_dir), "band")


@query("imbalance", f"""WITH {FLOWS}, s AS (SELECT label, count(*) AS n FROM flows GROUP BY label),
  big AS (SELECT * FROM s ORDER BY n DESC, label LIMIT 1),
  small AS (SELECT * FROM s ORDER BY n, label LIMIT 1)
  SELECT big.n AS max_n, big.label AS max_label, small.n AS min_n, small.label AS min_label,
    {r('big.n / small.n')} AS ratio FROM big, small""")
def imbalance(spark, sf_dir):
    return rounded(E.imbalance(flows(spark, sf_dir)), 6, "ratio")


def corr_sql(columns: list[str], digits: int | None = 6) -> str:
    parts = []
    for i, a in enumerate(columns):
        for j, b in enumerate(columns):
            v = "max(1.0::DOUBLE)" if a == b else f"corr({a}, {b})"
            v = "max(CAST(NULL AS DOUBLE))" if "constant" in (a, b) else v
            v = r(v, digits) if digits else v
            parts.append(f"SELECT '{a}' AS feature_i, '{b}' AS feature_j, {i} AS pos_i, "
                         f"{j} AS pos_j, {v} AS r FROM flows")
    return " UNION ALL ".join(parts)


@query("correlation", f"WITH {FLOWS} {corr_sql(FEATURES)}")
def correlation(spark, sf_dir):
    return rounded(E.correlation(flows(spark, sf_dir), FEATURES), 6, "r")


@query("correlation_pairwise", f"WITH {FLOWS} {corr_sql(FEATURES)}")
def correlation_pairwise(spark, sf_dir):
    return rounded(E.correlation(flows(spark, sf_dir), FEATURES, pairwise=True), 6, "r")


SPARSE = ["user_id", "value", "total", "half", "phase"]
SPARSE_MERGED = f"""{MERGED}, flows AS (SELECT *, CAST(CAST(substr(id, 2) AS BIGINT) % 100 AS DOUBLE) AS phase,
  CASE WHEN user_id % 2 = 0 THEN value + (CAST(substr(id, 2) AS BIGINT) % 100) / 2 END AS half FROM merged)"""


def sparse(spark, sf_dir) -> DataFrame:
    """Numeric columns of two sources, each null where the other one's rows are."""
    phase = F.substring("id", 2, 20).cast("bigint") % 100
    half = F.when(F.col("user_id") % 2 == 0, F.col("value") + phase / 2)
    return P.merge_sources(*sources(spark, sf_dir)).withColumns({"phase": phase.cast("double"), "half": half})


@query("correlation_with_nulls", f"WITH {SPARSE_MERGED} " + corr_sql(SPARSE))
def correlation_with_nulls(spark, sf_dir):
    return rounded(E.correlation(sparse(spark, sf_dir), SPARSE, pairwise=True), 6, "r")


# half contains phase, value doesn't, so half has the higher mean |r| whatever the noise of a
# small table, and value goes; the SQL has that figure decide which of the two it shows.
@query("clean_with_nulls", f"""WITH {SPARSE_MERGED}, m AS ({corr_sql(SPARSE)}),
  a AS (SELECT feature_i AS f, avg(abs(r)) AS v FROM m GROUP BY feature_i),
  d AS (SELECT coalesce(max(abs(r)) >= 0.9, false) AND (SELECT v FROM a WHERE f = 'half') >= (SELECT v FROM a
    WHERE f = 'value') AS value_goes FROM m WHERE feature_i = 'half' AND feature_j = 'value')
  SELECT user_id, total, CASE WHEN value_goes THEN half ELSE value END AS half, phase, status FROM flows, d""")
def clean_with_nulls(spark, sf_dir):
    table = sparse(spark, sf_dir).select(*SPARSE, "status")
    return clean(table, "status", pairwise=True)[0]


@query("lower_triangle", f"""WITH {FLOWS}, m AS ({corr_sql(FEATURES)})
  SELECT * FROM m WHERE pos_j < pos_i""")
def lower_triangle(spark, sf_dir):
    return rounded(E.lower_triangle(E.correlation(flows(spark, sf_dir), FEATURES)), 6, "r")


@query("upper_triangle", f"""WITH {FLOWS}, m AS ({corr_sql(FEATURES)})
  SELECT * FROM m WHERE pos_i < pos_j""")
def upper_triangle(spark, sf_dir):
    return rounded(E.upper_triangle(E.correlation(flows(spark, sf_dir), FEATURES)), 6, "r")


@query("top_correlated", f"""WITH {FLOWS}, m AS ({corr_sql(FEATURES, None)})
  SELECT feature_i AS feature, {r('avg(abs(r))')} AS mean_abs_r FROM m
  GROUP BY feature_i, pos_i ORDER BY avg(abs(r)) DESC NULLS LAST, pos_i LIMIT 5""")
def top_correlated(spark, sf_dir):
    out = E.top_correlated(E.correlation(flows(spark, sf_dir), FEATURES), 5)
    return rounded(out, 6, "mean_abs_r")


@query("per_class_sample", f"""WITH {FLOWS}, picked AS (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY {order_sql()}) AS i FROM flows),
  kept AS (SELECT * FROM picked
    WHERE i <= greatest(1, 2000 // (SELECT count(DISTINCT label) FROM flows)))
  SELECT {KEYS}, label FROM kept ORDER BY {order_sql(SEED + 1)} LIMIT 2000""")
def per_class_sample(spark, sf_dir):
    return M.per_class_sample(flows(spark, sf_dir).select(*KEY, "label"), "label", 2000, KEY, SEED)


PANELS = FEATURES[:4]


def _cell_sql(feature: str, bins: int) -> str:
    width = f"((hi_{feature} - lo_{feature}) / {bins})"
    return f"CAST(least(greatest(floor(({feature} - lo_{feature}) / {width}), 0), {bins - 1}) AS INTEGER)"


_ENDS = f"""ends AS (SELECT {', '.join(f'min({c}) AS lo_{c}, max({c}) AS hi_{c}' for c in PANELS)} FROM flows)"""


@query("pair_panels", f"WITH {FLOWS}, {_ENDS} " + " UNION ALL ".join(
    f"""SELECT '{a}' AS feature_x, '{b}' AS feature_y, label, {_cell_sql(a, 20)} AS bin_x, {_cell_sql(b, 20)} AS bin_y,
    count(*) AS n FROM flows, ends GROUP BY ALL""" for i, a in enumerate(PANELS) for b in PANELS[i + 1:]))
def pair_panels(spark, sf_dir):
    return E.pair_panels(flows(spark, sf_dir), PANELS, "label", 20)


def _density_sql(feature: str, bins: int) -> str:
    width = f"((hi_{feature} - lo_{feature}) / {bins})"
    return f"""SELECT '{feature}' AS feature, c.label, i AS bin,
        sum(n * exp(-0.5 * ((lo_{feature} + (i + 0.5) * {width} - m) / h) ** 2) / (total * h * sqrt(2 * pi()))) AS density
      FROM (SELECT label, {_cell_sql(feature, bins)} AS b, count(*) AS n, avg({feature}) AS m FROM flows, ends GROUP BY ALL) c
      JOIN (SELECT label, count(*) AS total, stddev_samp({feature}) * count(*) ** -0.2 AS h FROM flows GROUP BY label) w
        ON c.label = w.label, ends, range({bins}) t(i) GROUP BY ALL"""


@query("smooth_density", f"WITH {FLOWS}, {_ENDS}, d AS (" + " UNION ALL ".join(
    _density_sql(c, 50) for c in PANELS) + f") SELECT feature, label, CAST(bin AS INTEGER) AS bin, {r('density * 1000', 4)} AS density FROM d")
def smooth_density(spark, sf_dir):
    """Per feature and class, a thousand times the density at each of 50 places."""
    place = F.row_number().over(Window.partitionBy("feature", "label").orderBy("at")) - 1
    found = E.smooth_density(flows(spark, sf_dir), PANELS, "label", 50).withColumn("bin", place)
    return rounded(found.select("feature", "label", "bin", (F.col("density") * 1000).alias("density")), 4, "density")


@query("feature_histogram", f"""WITH {FLOWS}, e AS (SELECT min(price) AS lo, max(price) AS hi FROM flows)
  SELECT label, CAST(least(greatest(floor((price - lo) / ((hi - lo) / 20)), 0), 19) AS INTEGER) AS bin,
    count(*) AS n FROM flows, e GROUP BY ALL""")
def feature_histogram(spark, sf_dir):
    return E.feature_histogram(flows(spark, sf_dir), "price", "label", 20)


# ---------------------------------------------------------------- cleaning and selection

@query("merge_sources", f"WITH {MERGED} SELECT * FROM merged")
def merge_sources(spark, sf_dir):
    return P.merge_sources(*sources(spark, sf_dir))


MIXED = """CASE event_type WHEN 'error' THEN 'n/a' WHEN 'click' THEN ''
  WHEN 'view' THEN '1.5e1' ELSE regexp_extract(props, '([0-9]+)', 1) END"""


@query("coerce_numeric", f"""SELECT event_id, TRY_CAST({MIXED} AS DOUBLE) AS k FROM events""")
def coerce_numeric(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", F.expr(MIXED).alias("k"))
    return P.coerce_numeric(events, ["k"])


@query("fill_median", f"""WITH {MERGED}, m AS (SELECT median(value) AS v, median(total) AS t FROM merged)
  SELECT id, {r('coalesce(value, v)', 4)} AS value, {r('coalesce(total, t)', 4)} AS total
  FROM merged, m""")
def fill_median(spark, sf_dir):
    merged = P.merge_sources(*sources(spark, sf_dir)).select("id", "value", "total")
    return rounded(P.fill_median(merged, ["value", "total"]), 4, "value", "total")


@query("label_encode", f"""WITH {MERGED} SELECT id,
  dense_rank() OVER (ORDER BY coalesce(event_type, 'unknown')) - 1 AS event_type,
  dense_rank() OVER (ORDER BY coalesce(status, 'unknown')) - 1 AS status FROM merged""")
def label_encode(spark, sf_dir):
    merged = P.merge_sources(*sources(spark, sf_dir)).select("id", "event_type", "status")
    return P.label_encode(merged, ["event_type", "status"])


@query("label_encode_numbers", """SELECT event_id,
  dense_rank() OVER (ORDER BY user_id) - 1 AS user_id, dense_rank() OVER (ORDER BY value) - 1 AS value
  FROM events""")
def label_encode_numbers(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    return P.label_encode(events, ["user_id", "value"])


@query("one_hot", """SELECT o_orderkey,
  CAST(o_orderstatus = 'F' AS INTEGER) AS "o_orderstatus_F",
  CAST(o_orderstatus = 'O' AS INTEGER) AS "o_orderstatus_O",
  CAST(o_orderstatus = 'P' AS INTEGER) AS "o_orderstatus_P" FROM orders""")
def one_hot(spark, sf_dir):
    return P.one_hot(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"),
                     ["o_orderstatus"])


_PRIORITIES = "(SELECT DISTINCT o_orderpriority AS p FROM orders WHERE o_orderpriority IS NOT NULL)"


# The last indicator is that of a missing value.
@query("one_hot_vector", f"""SELECT o_orderkey, o_orderpriority,
    string_agg(CASE WHEN p = o_orderpriority THEN 1 ELSE 0 END, ',' ORDER BY p) || ',' ||
    CASE WHEN o_orderpriority IS NULL THEN 1 ELSE 0 END AS indicators
  FROM orders, {_PRIORITIES} GROUP BY o_orderkey, o_orderpriority""")
def one_hot_vector(spark, sf_dir):
    """The indicators of each order's priority, written out."""
    rows = P.one_hot_vector(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority"), ["o_orderpriority"])
    return rows.withColumn("indicators", F.array_join(vector_to_array("indicators").cast("array<int>"), ","))


@query("label_encode_exact", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
  dense_rank() OVER (ORDER BY 9007199254740000::BIGINT + l_orderkey * 7 + l_linenumber) - 1 AS big,
  dense_rank() OVER (ORDER BY (l_extendedprice * 100)::DECIMAL(38,0) * 1000000000000000 + l_partkey) - 1 AS wide,
  dense_rank() OVER (ORDER BY l_shipdate) - 1 AS shipped,
  dense_rank() OVER (ORDER BY 'https://example.com/a/' || l_partkey || '/' || l_suppkey) - 1 AS url FROM lineitem""")
def label_encode_exact(spark, sf_dir):
    """Codes of integers beyond 2^53, wide decimals, timestamps and texts that all begin alike."""
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
        (F.lit(9007199254740000).cast("bigint") + F.col("l_orderkey") * 7 + F.col("l_linenumber")).alias("big"),
        ((F.col("l_extendedprice") * 100).cast("decimal(20,0)") * F.lit("1000000000000000").cast("decimal(16,0)")
         + F.col("l_partkey").cast("decimal(20,0)")).alias("wide"),
        F.col("l_shipdate").alias("shipped"),
        F.concat(F.lit("https://example.com/a/"), "l_partkey", F.lit("/"), "l_suppkey").alias("url"))
    return P.label_encode(rows, ["big", "wide", "shipped", "url"])


# Codes fitted on orders before 1995 and used for all of them.
_CLERK = "'c' || (o_custkey % (CASE WHEN year(o_orderdate) < 1995 THEN 40 ELSE 50 END))"


@query("encoder_save_load", f"""WITH o AS (SELECT o_orderkey, o_orderdate, {_CLERK} AS clerk FROM orders),
  k AS (SELECT clerk, dense_rank() OVER (ORDER BY clerk) - 1 AS code FROM o WHERE year(o_orderdate) < 1995 GROUP BY clerk)
  SELECT o_orderkey, coalesce(code, (SELECT count(*) FROM k)) AS code FROM o LEFT JOIN k USING (clerk)""")
def encoder_save_load(spark, sf_dir):
    """Codes of the training rows, saved, read again and given to all rows; unseen ones share the last."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", F.expr(
        _CLERK).alias("clerk"))
    folder = scratch(spark)
    CategoryEncoder(inputCols=["clerk"], outputCols=["code"], unseen="keep").fit(
        rows.where("year(o_orderdate) < 1995")).save(folder)
    return CategoryEncoderModel.load(folder).transform(rows).select("o_orderkey", "code")


@query("assert_numeric", f"WITH {FLOWS} SELECT {', '.join(FEATURES)}, band FROM flows")
def assert_numeric(spark, sf_dir):
    return P.assert_numeric(flows(spark, sf_dir).select(*FEATURES, "band"))


@query("drop_columns", f"WITH {FLOWS} SELECT {KEYS}, quantity, label FROM flows")
def drop_columns(spark, sf_dir):
    return P.drop_columns(flows(spark, sf_dir), [*FEATURES[1:], "band"])


SELECTABLE = ["quantity", "price", "discount", "tax", "revenue", "tiny", "constant"]


@query("select_uncorrelated", f"""WITH {FLOWS}, m AS ({corr_sql(SELECTABLE, None)}),
  s AS (SELECT feature_i AS f, pos_i, avg(abs(r)) AS v FROM m GROUP BY ALL),
  weaker AS (SELECT CASE WHEN b.v >= a.v THEN m.feature_i ELSE m.feature_j END AS f
    FROM m JOIN s a ON a.f = m.feature_i JOIN s b ON b.f = m.feature_j
    WHERE m.pos_i < m.pos_j AND abs(m.r) >= 0.9)
  SELECT pos_i AS position, f AS feature, f NOT IN (SELECT f FROM weaker) AS kept FROM s""")
def select_uncorrelated(spark, sf_dir):
    return X.select_uncorrelated(flows(spark, sf_dir).select(*SELECTABLE, "label"), "label")[1]


@query("clean_table", f"WITH {FLOWS} SELECT quantity, tax, revenue, label FROM flows")
def clean_table(spark, sf_dir):
    # Of price and revenue, and of discount and tiny, the first has the lower mean |r|;
    # tiny and constant then hardly vary.
    wide = flows(spark, sf_dir).select(*SELECTABLE, "band", "label")
    return clean(wide, "label", exclude=["band"])[0]


@query("correlated_pairs", f"""WITH {FLOWS}, m AS ({corr_sql(FEATURES, None)}),
  s AS (SELECT feature_i AS f, avg(abs(r)) AS v FROM m GROUP BY feature_i)
  SELECT m.feature_i, m.feature_j, {r('m.r')} AS r,
    CASE WHEN b.v >= a.v THEN m.feature_i ELSE m.feature_j END AS weaker
  FROM m JOIN s a ON a.f = m.feature_i JOIN s b ON b.f = m.feature_j
  WHERE m.pos_i < m.pos_j AND abs(m.r) >= 0.9""")
def correlated_pairs(spark, sf_dir):
    return rounded(X.correlated_pairs(E.correlation(flows(spark, sf_dir), FEATURES)), 6, "r")


@query("drop_low_variance", f"WITH {FLOWS} SELECT quantity, price, discount, tax, revenue, label FROM flows")
def drop_low_variance(spark, sf_dir):
    return X.drop_low_variance(flows(spark, sf_dir).select(*FEATURES, "label"), "label")


@query("split_xy", f"WITH {FLOWS} SELECT {', '.join(FEATURES)} FROM flows")
def split_xy(spark, sf_dir):
    return P.split_xy(flows(spark, sf_dir).select(*FEATURES, "label"))[0]


@query("split_xy_target", f"WITH {FLOWS} SELECT label FROM flows")
def split_xy_target(spark, sf_dir):
    return P.split_xy(flows(spark, sf_dir).select(*FEATURES, "label"))[1]


@query("align_features", f"WITH {FLOWS} SELECT tax, quantity, price, label FROM flows")
def align_features(spark, sf_dir):
    return P.align_features(flows(spark, sf_dir), ["tax", "quantity", "price"], ["label"])


SPLIT = f"""split AS (SELECT *,
  row_number() OVER (PARTITION BY label ORDER BY {order_sql()})
    <= round(0.2::DOUBLE * count(*) OVER (PARTITION BY label)) AS is_test FROM flows)"""
BAND_SPLIT = SPLIT.replace("PARTITION BY label", "PARTITION BY band")


def _scaled(c: str) -> str:
    return f"(s.{c} - m_{c}) / (CASE WHEN sd_{c} = 0 THEN 1 ELSE sd_{c} END)"


STATS = "stats AS (SELECT " + ", ".join(
    f"avg({c}) AS m_{c}, stddev_pop({c}) AS sd_{c}" for c in MODEL_FEATURES
) + " FROM split WHERE NOT is_test)"


@query("standardize", f"""WITH {FLOWS}, {SPLIT}, {STATS}
  SELECT {', '.join('s.' + k for k in KEY)}, {', '.join(f'{r(_scaled(c))} AS {c}' for c in MODEL_FEATURES)}
  FROM split s, stats WHERE is_test""")
def standardize(spark, sf_dir):
    split = M.stratified_split(flows(spark, sf_dir), "label", 0.2, KEY, SEED)
    _, test = P.standardize(split.where("NOT is_test"), split.where("is_test"), MODEL_FEATURES)
    return rounded(test.select(*KEY, *MODEL_FEATURES), 6, *MODEL_FEATURES)


@query("scaled_summary", "SELECT CAST(0 AS DOUBLE) AS mean, CAST(1 AS DOUBLE) AS std")
def scaled_summary(spark, sf_dir):
    whole = flows(spark, sf_dir)
    scaled = P.fit_scaling(whole, MODEL_FEATURES).apply(whole)
    return rounded(P.scaled_summary(scaled, MODEL_FEATURES), 6, "mean", "std")


@query("class_weights", f"""WITH {FLOWS}, s AS (SELECT label, count(*) AS n FROM flows GROUP BY label)
  SELECT {KEYS}, f.label, {r('(SELECT sum(n) FROM s) / ((SELECT count(*) FROM s) * s.n)')} AS weight
  FROM flows f JOIN s USING (label)""")
def class_weights(spark, sf_dir):
    return rounded(P.class_weights(flows(spark, sf_dir).select(*KEY, "label")), 6, "weight")


# ---------------------------------------------------------------- sampling and folds

@query("stratified_sample", f"""WITH {FLOWS}, p AS (SELECT *,
    row_number() OVER (PARTITION BY label ORDER BY {order_sql()}) AS i,
    count(*) OVER (PARTITION BY label) AS n FROM flows)
  SELECT {KEYS}, label FROM p WHERE i <= round(0.12::DOUBLE * n)""")
def stratified_sample(spark, sf_dir):
    return M.stratified_sample(flows(spark, sf_dir).select(*KEY, "label"), "label", 0.12, KEY, SEED)


@query("approximate_sample", f"""WITH {FLOWS} SELECT {KEYS}, label FROM flows
  WHERE {order_sql()} < '{round(0.12 * 16 ** 32):032x}'""")
def approximate_sample(spark, sf_dir):
    """The sample by hash alone: one scan, no ranks."""
    return M.approximate_sample(flows(spark, sf_dir).select(*KEY, "label"), 0.12, KEY, SEED)


@query("stratified_split", f"WITH {FLOWS}, {SPLIT} SELECT {KEYS}, label, is_test FROM split")
def stratified_split(spark, sf_dir):
    return M.stratified_split(flows(spark, sf_dir).select(*KEY, "label"), "label", 0.2, KEY, SEED)


@query("split_summary", f"""WITH {FLOWS}, {SPLIT}
  SELECT is_test, count(*) AS n, {r('100.0 * count(*) / (SELECT count(*) FROM flows)')} AS pct
  FROM split GROUP BY is_test""")
def split_summary(spark, sf_dir):
    return rounded(M.split_summary(stratified_split(spark, sf_dir)), 6, "pct")


@query("random_split", f"""WITH {FLOWS} SELECT {KEYS},
  row_number() OVER (ORDER BY {order_sql()}) <= round(0.2::DOUBLE * count(*) OVER ()) AS is_test
  FROM flows""")
def random_split(spark, sf_dir):
    return M.random_split(flows(spark, sf_dir).select(*KEY), 0.2, KEY, SEED)


@query("cv_subsample", f"""WITH {FLOWS}, p AS (SELECT *,
    row_number() OVER (PARTITION BY label ORDER BY {order_sql()}) AS i,
    count(*) OVER (PARTITION BY label) AS n, count(*) OVER () AS total FROM flows)
  SELECT {KEYS}, label FROM p WHERE i <= greatest(3, floor(30000 * n / total))""")
def cv_subsample(spark, sf_dir):
    return M.cv_subsample(flows(spark, sf_dir).select(*KEY, "label"), "label", 30_000, KEY, SEED)


@query("assign_folds", f"""WITH {FLOWS} SELECT {KEYS}, label,
  CAST(ntile(3) OVER (PARTITION BY label ORDER BY {order_sql()}) - 1 AS INTEGER) AS fold FROM flows""")
def assign_folds(spark, sf_dir):
    return M.assign_folds(flows(spark, sf_dir).select(*KEY, "label"), "label", 3, KEY, SEED)


@query("ensure_classes", f"""WITH {FLOWS}, p AS (SELECT *,
    row_number() OVER (PARTITION BY label ORDER BY {order_sql()}) AS i FROM flows)
  SELECT {KEYS}, label FROM p WHERE label NOT IN ('AF', 'RO') OR i = 1""")
def ensure_classes(spark, sf_dir):
    full = flows(spark, sf_dir).select(*KEY, "label")
    return M.ensure_classes(full.where("label NOT IN ('AF', 'RO')"), full, "label", KEY, SEED)


@query("sample_n", f"""WITH {FLOWS} SELECT {KEYS}, quantity, label FROM flows
  ORDER BY {order_sql()}, {KEYS} LIMIT 10""")
def sample_n(spark, sf_dir):
    return M.sample_n(flows(spark, sf_dir).select(*KEY, "quantity", "label"), 10, KEY, SEED)


# Rows of `events` share users and differ below the millisecond.
EVENT_ORDER = rf"""md5('{SEED}:' || user_id), md5('{SEED}:' || CAST(to_json(struct_pack(f0 := event_id,
  f1 := user_id, f2 := regexp_replace(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), '\.?0+$', ''),
  f3 := event_type, f4 := value, f5 := props)) AS VARCHAR))"""
EVENT_COLUMNS = "event_id, user_id, epoch_us(ts) AS us, event_type, value, props"


def _events(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type", "value", "props")


def _with_micros(df: DataFrame) -> DataFrame:
    start = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
    return df.withColumn("us", F.expr(f"timestampdiff(MICROSECOND, {start}, ts)")).drop("ts")


@query("stratified_sample_shared_key", f"""WITH p AS (SELECT *,
    row_number() OVER (PARTITION BY event_type ORDER BY {EVENT_ORDER}) AS i,
    count(*) OVER (PARTITION BY event_type) AS n FROM events)
  SELECT {EVENT_COLUMNS} FROM p WHERE i <= round(0.12::DOUBLE * n)""")
def stratified_sample_shared_key(spark, sf_dir):
    return _with_micros(M.stratified_sample(
        _events(spark, sf_dir), "event_type", 0.12, ["user_id"], SEED))


@query("sample_n_shared_key", f"SELECT {EVENT_COLUMNS} FROM events ORDER BY {EVENT_ORDER} LIMIT 1500")
def sample_n_shared_key(spark, sf_dir):
    return _with_micros(M.sample_n(_events(spark, sf_dir), 1500, ["user_id"], SEED))


@query("ensure_classes_shared_key", f"""WITH p AS (SELECT *,
    row_number() OVER (PARTITION BY event_type ORDER BY {EVENT_ORDER}) AS i FROM events)
  SELECT {EVENT_COLUMNS} FROM p WHERE event_type NOT IN ('error', 'click') OR i = 1""")
def ensure_classes_shared_key(spark, sf_dir):
    full = _events(spark, sf_dir)
    part = full.where("event_type NOT IN ('error', 'click')")
    return _with_micros(M.ensure_classes(part, full, "event_type", ["user_id"], SEED))


PART_KEY = ["l_orderkey", "l_linenumber"]
PART_ORDER = f"""md5('{SEED}:' || l_orderkey || ':' || l_linenumber), md5('{SEED}:' || CAST(to_json(struct_pack(
  f0 := l_orderkey, f1 := l_partkey, f2 := l_suppkey, f3 := l_linenumber)) AS VARCHAR))"""


@query("random_split_shared_key", f"""SELECT {KEYS},
  row_number() OVER (ORDER BY {PART_ORDER}) <= round(0.2::DOUBLE * count(*) OVER ()) AS is_test
  FROM lineitem""")
def random_split_shared_key(spark, sf_dir):
    return M.random_split(table(spark, sf_dir, "lineitem").select(*KEY), 0.2, PART_KEY, SEED)


# ---------------------------------------------------------------- classifiers

# The presets in full, but for boosting's rounds: for the queries that show one step of a model's life.
# train_and_compare, training_run and score_flow train the presets as they are.
BRIEF = {
    C.LOGISTIC.key: C.LOGISTIC,
    C.BAYES.key: C.BAYES,
    C.FOREST.key: C.FOREST,
    C.BOOSTING_REGULARISED.key: C.BOOSTING_REGULARISED.with_params(rounds=6, rate=0.1),
    C.BOOSTING_BALANCED.key: C.BOOSTING_BALANCED.with_params(rounds=6),
}


def banded(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Training and test side for the classifiers."""
    split = M.stratified_split(
        flows(spark, sf_dir).select(*KEY, *MODEL_FEATURES, "band"), "band", 0.2, KEY, SEED)
    return split.where("NOT is_test").drop("is_test"), split.where("is_test").drop("is_test")


def _class_report(preset: C.Preset, spark, sf_dir) -> DataFrame:
    train, test = banded(spark, sf_dir)
    model = C.fit_model(preset, train, MODEL_FEATURES, "band")
    counts = V.confusion_counts(model.transform(test), "band", f"{preset.key}_prediction")
    return rounded(V.class_report(counts), 6, "precision", "recall", "f1")


for _preset in (C.LOGISTIC, C.FOREST, C.BOOSTING_REGULARISED, C.BOOSTING_BALANCED):
    query(_preset.key)(functools.partial(_class_report, BRIEF[_preset.key]))


def _bayes_sql(label: str) -> str:
    z = {c: f"(x.{c} - m_{c}) / (CASE WHEN sd_{c} = 0 THEN 1 ELSE sd_{c} END)" for c in MODEL_FEATURES}
    every = ", ".join(f"{z[c]} AS {c}" for c in MODEL_FEATURES)
    fit = ", ".join(f"avg({c}) AS mu_{c}, var_pop({c}) AS va_{c}" for c in MODEL_FEATURES)
    largest = "greatest(" + ", ".join(f"var_pop({c})" for c in MODEL_FEATURES) + ")"
    terms = " + ".join(
        f"ln(2 * pi() * (va_{c} + eps)) + (z.{c} - mu_{c}) * (z.{c} - mu_{c}) / (va_{c} + eps)"
        for c in MODEL_FEATURES)
    split = SPLIT if label == "label" else BAND_SPLIT
    return f"""{FLOWS}, {split}, {STATS},
      z AS (SELECT {', '.join('x.' + k for k in KEY)}, x.{label}, x.is_test, {every} FROM split x, stats),
      fit AS (SELECT {label} AS c, count(*) AS n, {fit} FROM z WHERE NOT is_test GROUP BY {label}),
      eps AS (SELECT 1e-5 * {largest} AS eps, count(*) AS total FROM z WHERE NOT is_test),
      scored AS (SELECT {', '.join('z.' + k for k in KEY)}, z.{label}, fit.c AS prediction,
        ln(n / total) - 0.5 * ({terms}) AS s FROM z, fit, eps WHERE z.is_test),
      best AS (SELECT *, row_number() OVER (PARTITION BY {KEYS} ORDER BY s DESC, prediction) AS i
        FROM scored)"""


@query("naive_bayes", f"WITH {_bayes_sql('band')} SELECT {KEYS}, band, prediction FROM best WHERE i = 1")
def naive_bayes(spark, sf_dir):
    train, test = banded(spark, sf_dir)
    model = C.fit_model(C.BAYES, train, MODEL_FEATURES, "band")
    return S.predict_attacks(test, {C.BAYES.key: model}).select(
        *KEY, "band", F.col("naive_bayes_prediction").alias("prediction"))


BAYES_COUNTS = f"""WITH {_bayes_sql('band')},
  c AS (SELECT band AS label, prediction, count(*) AS n FROM best WHERE i = 1 GROUP BY ALL)"""


def report_sql(head: str, tail: str = "") -> str:
    """Per-class report from a CTE c(label, prediction, n)."""
    return f"""{head}, u AS (SELECT label AS class FROM c UNION SELECT prediction FROM c),
      t AS (SELECT class,
        CAST(coalesce((SELECT sum(n) FROM c WHERE c.label = class AND c.prediction = class), 0) AS BIGINT) AS correct,
        CAST(coalesce((SELECT sum(n) FROM c WHERE c.label = class), 0) AS BIGINT) AS support,
        CAST(coalesce((SELECT sum(n) FROM c WHERE c.prediction = class), 0) AS BIGINT) AS predicted FROM u),
      report AS (SELECT class,
        CASE WHEN predicted = 0 THEN 0 ELSE correct / predicted END AS precision,
        CASE WHEN support = 0 THEN 0 ELSE correct / support END AS recall,
        CASE WHEN support + predicted = 0 THEN 0 ELSE 2 * correct / (support + predicted) END AS f1,
        support, correct FROM t) {tail}"""


REPORT_COLUMNS = f"""SELECT class, {r('precision')} AS precision, {r('recall')} AS recall,
  {r('f1')} AS f1, support FROM report"""


@query("flow_class_report", report_sql(BAYES_COUNTS, REPORT_COLUMNS))
def flow_class_report(spark, sf_dir):
    """Split, scale, train, score and report in one go."""
    return _class_report(C.BAYES, spark, sf_dir)


# All 64 values of an embedding as features of its 10 labels, in long form.
WIDE = 64
WIDE_SQL = f"""split AS (SELECT vec_id, label, embedding, row_number() OVER (PARTITION BY label
      ORDER BY md5('{SEED}:' || vec_id)) <= round(0.2::DOUBLE * count(*) OVER (PARTITION BY label)) AS is_test
    FROM embeddings),
  x AS (SELECT vec_id, label, is_test, j, embedding[j]::DOUBLE AS x FROM split, range(1, {WIDE + 1}) t(j)),
  st AS (SELECT j, avg(x) AS m, stddev_pop(x) AS sd FROM x WHERE NOT is_test GROUP BY j),
  z AS (SELECT vec_id, label, is_test, j, (x - m) / CASE WHEN sd = 0 THEN 1 ELSE sd END AS x FROM x JOIN st USING (j)),
  eps AS (SELECT 1e-5 * max(v) AS eps FROM (SELECT var_pop(x) AS v FROM z WHERE NOT is_test GROUP BY j)),
  fit AS (SELECT label AS c, j, avg(x) AS mu, var_pop(x) + eps AS va FROM z, eps WHERE NOT is_test GROUP BY label, j, eps),
  prior AS (SELECT label AS c, ln(count(*) / sum(count(*)) OVER ()) AS p FROM split WHERE NOT is_test GROUP BY label),
  scored AS (SELECT vec_id, z.label, prior.c, p - 0.5 * sum(ln(2 * pi() * va) + (x - mu) * (x - mu) / va) AS s
    FROM z JOIN fit USING (j) JOIN prior ON prior.c = fit.c WHERE is_test GROUP BY vec_id, z.label, prior.c, p)"""


def _wide(spark, sf_dir) -> tuple[DataFrame, DataFrame, list[str]]:
    names = [f"v{j}" for j in range(WIDE)]
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", *[F.col("embedding")[j].cast("double").alias(n) for j, n in enumerate(names)])
    split = M.stratified_split(rows, "label", 0.2, ["vec_id"], SEED)
    return split.where("NOT is_test").drop("is_test"), split.where("is_test").drop("is_test"), names


@query("naive_bayes_wide", f"""WITH {WIDE_SQL} SELECT vec_id, label,
  CAST(max_by(c, s) AS BIGINT) AS prediction FROM scored GROUP BY vec_id, label""")
def naive_bayes_wide(spark, sf_dir):
    train, test, names = _wide(spark, sf_dir)
    model = C.fit_model(C.BAYES, train, names, "label")
    return S.predict_attacks(test, {C.BAYES.key: model}).select(
        "vec_id", "label", F.col("naive_bayes_prediction").alias("prediction"))


@query("attack_roc_auc", f"""WITH {WIDE_SQL},
  m AS (SELECT *, exp(s - max(s) OVER (PARTITION BY vec_id)) AS e FROM scored),
  a AS (SELECT vec_id, label <> 0 AS attack, 1 - sum(e) FILTER (c = 0) / sum(e) AS score FROM m GROUP BY vec_id, label),
  g AS (SELECT round(score, 9) AS score, count(*) FILTER (attack) AS p, count(*) FILTER (NOT attack) AS q FROM a GROUP BY 1),
  k AS (SELECT p, q, sum(p) OVER (ORDER BY score DESC) AS tp, sum(p) OVER () AS allp, sum(q) OVER () AS allq FROM g)
  SELECT {r('sum(q * (tp - p / 2) / (allp * allq))')} AS auc FROM k""")
def attack_roc_auc(spark, sf_dir):
    """Area under the ROC of a trained model's attack probability, class 0 being benign."""
    train, test, names = _wide(spark, sf_dir)
    model = C.fit_model(C.BAYES, train, names, "label")
    scored = rounded(S.attack_scores(test, C.BAYES.key, model), 9, "naive_bayes_attack")
    return rounded(V.roc_auc(scored, "naive_bayes_attack", F.col("label") != 0), 6, "auc")


@query("early_stopping")
def early_stopping(spark, sf_dir):
    """The watched rows' loss after each round, and the rounds kept: up to the lowest loss."""
    train, test = banded(spark, sf_dir)
    preset = C.BOOSTING_REGULARISED_FALLBACK.with_params(rounds=30, rate=1.0)
    return C.fit_early_stopping(preset, train, MODEL_FEATURES, "band", patience=5, watched=test)[1]


@query("feature_importance")
def feature_importance(spark, sf_dir):
    train, _ = banded(spark, sf_dir)
    model = C.fit_model(BRIEF[C.FOREST.key], train, MODEL_FEATURES, "band")
    return C.feature_importance(model, MODEL_FEATURES, spark, 15)


@query("preset_fallback")
def preset_fallback(spark, sf_dir):
    train, test = banded(spark, sf_dir)
    # A share of rows above 1 is refused, so the alternate settings take over.
    broken = C.BOOSTING_REGULARISED.with_params(rows=1.5)
    spare = C.BOOSTING_REGULARISED_FALLBACK.with_params(rounds=6)
    used, model, _ = C.fit_with_fallback(
        [broken, spare], lambda p: C.fit_model(p, train, MODEL_FEATURES, "band"))
    counts = V.confusion_counts(model.transform(test), "band", f"{used.key}_prediction")
    return V.summary(counts).withColumn("model", F.lit(used.title))


@query("grid_search")
def grid_search(spark, sf_dir):
    """All 27 settings by halving: tried with one round, the best third of them with three."""
    train, _ = banded(spark, sf_dir)
    folded = M.assign_folds(M.cv_subsample(train, "band", 30_000, KEY), "band", 3, KEY)
    assembler, booster = C.pipeline(C.BOOSTING_REGULARISED_FALLBACK, MODEL_FEATURES, "band", 0).getStages()
    vectors = assembler.transform(folded).withColumn("band", F.col("band").cast("double")).persist()
    out = C.grid_search(booster, C.boosting_grid(booster), vectors, "band", booster.getPredictionCol(),
                        parallelism=4, halving=(booster.rounds, 3))[1]
    vectors.unpersist()
    return out


# ---------------------------------------------------------------- evaluation

PSEUDO = """CASE WHEN quantity <= 35 THEN band WHEN quantity <= 45 THEN l_partkey % 5
  ELSE l_suppkey % 3 END"""
COUNTS = f"""WITH {FLOWS}, c AS (SELECT band AS label, {PSEUDO} AS prediction, count(*) AS n
  FROM flows GROUP BY ALL)"""


def pseudo_counts(spark, sf_dir) -> DataFrame:
    return V.confusion_counts(
        flows(spark, sf_dir).withColumn("prediction", F.expr(PSEUDO)), "band")


@query("confusion_counts", f"{COUNTS} SELECT * FROM c")
def confusion_counts(spark, sf_dir):
    return pseudo_counts(spark, sf_dir)


@query("confusion_matrix", f"""{COUNTS}, u AS (SELECT label AS k FROM c UNION SELECT prediction FROM c)
  SELECT a.k AS label, b.k AS prediction, coalesce(n, 0) AS n
  FROM u a CROSS JOIN u b LEFT JOIN c ON c.label = a.k AND c.prediction = b.k""")
def confusion_matrix(spark, sf_dir):
    return V.confusion_matrix(pseudo_counts(spark, sf_dir))


@query("accuracy", f"""{COUNTS}
  SELECT {r('sum(CASE WHEN label = prediction THEN n ELSE 0 END) / sum(n)')} AS accuracy FROM c""")
def accuracy(spark, sf_dir):
    return rounded(V.accuracy(pseudo_counts(spark, sf_dir)), 6, "accuracy")


@query("class_report", report_sql(COUNTS, REPORT_COLUMNS))
def class_report(spark, sf_dir):
    return rounded(V.class_report(pseudo_counts(spark, sf_dir)), 6, "precision", "recall", "f1")


@query("macro_avg", report_sql(COUNTS, f"""SELECT {r('avg(precision)')} AS precision,
  {r('avg(recall)')} AS recall, {r('avg(f1)')} AS f1, CAST(sum(support) AS BIGINT) AS support FROM report"""))
def macro_avg(spark, sf_dir):
    return rounded(V.macro_avg(V.class_report(pseudo_counts(spark, sf_dir))), 6,
                   "precision", "recall", "f1")


@query("weighted_avg", report_sql(COUNTS, f"""SELECT
  {r('sum(precision * support) / sum(support)')} AS precision,
  {r('sum(recall * support) / sum(support)')} AS recall,
  {r('sum(f1 * support) / sum(support)')} AS f1, CAST(sum(support) AS BIGINT) AS support FROM report"""))
def weighted_avg(spark, sf_dir):
    return rounded(V.weighted_avg(V.class_report(pseudo_counts(spark, sf_dir))), 6,
                   "precision", "recall", "f1")


@query("diagonal", report_sql(COUNTS, f"""SELECT class, correct, support AS total,
  {r('100.0 * recall')} AS pct FROM report"""))
def diagonal(spark, sf_dir):
    return rounded(V.diagonal(pseudo_counts(spark, sf_dir)), 6, "pct")


@query("evaluation_summary", report_sql(COUNTS, f"""SELECT {r('sum(correct) / sum(support)')} AS accuracy,
  {r('sum(f1 * support) / sum(support)')} AS f1_weighted, {r('avg(f1)')} AS f1_macro FROM report"""))
def evaluation_summary(spark, sf_dir):
    return rounded(V.summary(pseudo_counts(spark, sf_dir)), 6, "accuracy", "f1_weighted", "f1_macro")


@query("overfitting_gap", f"""WITH {FLOWS}, {BAND_SPLIT}, a AS (SELECT
    avg(CASE WHEN NOT is_test THEN CAST(band = {PSEUDO} AS INTEGER) END) AS tr,
    avg(CASE WHEN is_test THEN CAST(band = {PSEUDO} AS INTEGER) END) AS te FROM split)
  SELECT {r('tr')} AS train_accuracy, {r('te')} AS test_accuracy, {r('tr - te')} AS gap,
    tr - te > 0.10 AS overfitting,
    CASE WHEN tr - te < 0.02 THEN 'excellent' WHEN tr - te < 0.05 THEN 'good'
      WHEN tr - te < 0.10 THEN 'mild overfitting' ELSE 'overfitting' END AS verdict FROM a""")
def overfitting_gap(spark, sf_dir):
    split = M.stratified_split(flows(spark, sf_dir), "band", 0.2, KEY, SEED)
    counts = split.groupBy("is_test", F.col("band").alias("label"),
                           F.expr(PSEUDO).alias("prediction")).agg(F.count(F.lit(1)).alias("n"))
    return rounded(V.overfitting_gap(counts), 6, "train_accuracy", "test_accuracy", "gap")


@query("gap_verdict", f"""WITH {FLOWS}, g AS (SELECT label, avg(tax) AS gap FROM flows
    GROUP BY label UNION ALL
    SELECT label, avg(discount) FROM flows GROUP BY label UNION ALL
    SELECT label, max(discount) FROM flows GROUP BY label UNION ALL
    SELECT label, -max(tax) FROM flows GROUP BY label)
  SELECT label, {r('gap')} AS gap,
    CASE WHEN gap < 0.02 THEN 'excellent' WHEN gap < 0.05 THEN 'good'
      WHEN gap < 0.10 THEN 'mild overfitting' ELSE 'overfitting' END AS verdict FROM g""")
def gap_verdict(spark, sf_dir):
    f = flows(spark, sf_dir)
    gaps = f.groupBy("label").agg(
        F.array(F.avg("tax"), F.avg("discount"), F.max("discount"), -F.max("tax")).alias("g")
    ).select("label", F.explode("g").alias("gap"))
    out = gaps.withColumn("verdict", V.gap_verdict(F.col("gap")))
    return rounded(out, 6, "gap")


def _fold_bayes_sql(i: int) -> str:
    """Naive Bayes trained without fold i and its predictions of that fold."""
    z = {c: f"(x.{c} - m_{c}) / (CASE WHEN sd_{c} = 0 THEN 1 ELSE sd_{c} END)" for c in MODEL_FEATURES}
    terms = " + ".join(
        f"ln(2 * pi() * (va_{c} + eps)) + (z.{c} - mu_{c}) * (z.{c} - mu_{c}) / (va_{c} + eps)"
        for c in MODEL_FEATURES)
    return f"""st{i} AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS sd_{c}' for c in MODEL_FEATURES)}
        FROM folded WHERE fold <> {i}),
      z{i} AS (SELECT {', '.join('x.' + k for k in KEY)}, x.band, x.fold,
        {', '.join(f'{z[c]} AS {c}' for c in MODEL_FEATURES)} FROM folded x, st{i}),
      fit{i} AS (SELECT band AS c, count(*) AS n,
        {', '.join(f'avg({c}) AS mu_{c}, var_pop({c}) AS va_{c}' for c in MODEL_FEATURES)}
        FROM z{i} WHERE fold <> {i} GROUP BY band),
      eps{i} AS (SELECT 1e-5 * greatest({', '.join(f'var_pop({c})' for c in MODEL_FEATURES)}) AS eps,
        count(*) AS total FROM z{i} WHERE fold <> {i}),
      best{i} AS (SELECT z.band, f.c AS prediction, row_number() OVER (PARTITION BY
          {', '.join('z.' + k for k in KEY)} ORDER BY ln(n / total) - 0.5 * ({terms}) DESC, f.c) AS i
        FROM z{i} z, fit{i} f, eps{i} WHERE z.fold = {i})"""


def _fold_f1_sql(i: int) -> str:
    head = f"WITH c AS (SELECT band AS label, prediction, count(*) AS n FROM best{i} WHERE i = 1 GROUP BY ALL)"
    f1 = report_sql(head, "SELECT sum(f1 * support) / sum(support) AS f1_weighted FROM report")
    return f"SELECT {i} AS fold, f1_weighted FROM ({f1})"


FOLDS_F1 = f"""{FLOWS}, {BAND_SPLIT}, ranked AS (SELECT *,
    row_number() OVER (PARTITION BY band ORDER BY {order_sql()}) AS i,
    count(*) OVER (PARTITION BY band) AS n, count(*) OVER () AS total FROM split WHERE NOT is_test),
  folded AS (SELECT {KEYS}, band, {', '.join(MODEL_FEATURES)},
    ntile(3) OVER (PARTITION BY band ORDER BY {order_sql(SEED + 1)}) - 1 AS fold
    FROM ranked WHERE i <= greatest(3, floor(30000 * n / total))),
  {', '.join(_fold_bayes_sql(i) for i in range(3))},
  folds AS ({' UNION ALL '.join(_fold_f1_sql(i) for i in range(3))})"""


@query("cross_validate", f"WITH {FOLDS_F1} SELECT CAST(fold AS INTEGER) AS fold, {r('f1_weighted')} AS f1_weighted FROM folds")
def cross_validate(spark, sf_dir):
    train, _ = banded(spark, sf_dir)
    out = T.cross_validate(C.BAYES, train, MODEL_FEATURES, "band", 3, key_cols=KEY)
    return rounded(out, 6, "f1_weighted")


@query("cv_summary", f"""WITH {FLOWS}, folds AS (SELECT l_linenumber AS fold, avg(tax) AS f1_weighted
    FROM flows GROUP BY l_linenumber)
  SELECT {r('avg(f1_weighted)')} AS mean, {r('stddev_pop(f1_weighted)')} AS std FROM folds""")
def cv_summary(spark, sf_dir):
    folds = flows(spark, sf_dir).groupBy(F.col("l_linenumber").alias("fold")).agg(
        F.avg("tax").alias("f1_weighted"))
    return rounded(T.cv_summary(folds), 6, "mean", "std")


@query("timing", f"""WITH {FLOWS} SELECT 'confusion_counts' AS action, count(*) AS rows, true AS timed FROM flows""")
def timing(spark, sf_dir):
    counts, seconds = T.timed(lambda: pseudo_counts(spark, sf_dir).collect())
    return local_rows(spark, [("confusion_counts", sum(r["n"] for r in counts), seconds > 0)],
                      "action string, rows bigint, timed boolean")


def evaluations(spark, sf_dir, presets, k: int = 0) -> list[T.Evaluation]:
    train, test = banded(spark, sf_dir)
    train, test = train.persist(), test.persist()
    try:
        return T.evaluate_all(presets, train, test, MODEL_FEATURES, "band", KEY, k=k)
    finally:
        train.unpersist()
        test.unpersist()


def _side_sql(test: bool) -> str:
    side = "z.is_test" if test else "NOT z.is_test"
    head = f"""WITH {_bayes_sql('band').replace('WHERE z.is_test)', f'WHERE {side})')},
      c AS (SELECT band AS label, prediction, count(*) AS n FROM best WHERE i = 1 GROUP BY ALL)"""
    return report_sql(head, """SELECT sum(correct) / sum(support) AS accuracy,
      sum(f1 * support) / sum(support) AS f1_weighted, avg(f1) AS f1_macro FROM report""")


@query("evaluate_model", f"""WITH tr AS ({_side_sql(False)}), te AS ({_side_sql(True)}),
  cv AS (SELECT avg(f1_weighted) AS mean, stddev_pop(f1_weighted) AS std FROM (WITH {FOLDS_F1} SELECT * FROM folds))
  SELECT 'Naive Bayes' AS model, {r('tr.accuracy')} AS train_accuracy, {r('te.accuracy')} AS test_accuracy,
    {r('tr.f1_weighted')} AS train_f1_weighted, {r('te.f1_weighted')} AS test_f1_weighted,
    {r('te.f1_macro')} AS test_f1_macro, {r('mean')} AS cv_f1_weighted, {r('std')} AS cv_f1_std,
    {r('tr.accuracy - te.accuracy')} AS gap, true AS timed FROM tr, te, cv""")
def evaluate_model(spark, sf_dir):
    out = T.results_table(spark, evaluations(spark, sf_dir, [C.BAYES], k=3))
    seconds = ("train_seconds", "inference_seconds")
    timed = out.withColumn("timed", (F.col(seconds[0]) > 0) & (F.col(seconds[1]) > 0)).drop(*seconds)
    return rounded(timed, 6, *[f for f in T.FIGURES if f not in seconds])


@query("train_and_compare")
def train_and_compare(spark, sf_dir):
    return V.compare(T.results_table(spark, evaluations(spark, sf_dir, C.PRESETS, k=3)))


@query("training_run")
def training_run(spark, sf_dir):
    """The whole run: sample, split, five models with cross-validation, saved models, all
    report tables, and the comparison as it was written."""
    folder = scratch(spark)
    rows = flows(spark, sf_dir).select(*KEY, *MODEL_FEATURES, "band")
    train_and_report(rows, "band", MODEL_FEATURES, folder, KEY, fraction=0.5, seed=SEED)
    return reports.read_report(spark, f"{folder}/reports", "comparison")


RESULTS = f"""WITH {FLOWS}, results AS (SELECT label AS model,
  {r('avg(CAST(band = ' + PSEUDO + ' AS INTEGER))')} AS test_accuracy FROM flows GROUP BY label)"""


def result_rows(spark, sf_dir) -> DataFrame:
    right = F.avg((F.col("band") == F.expr(PSEUDO)).cast("int"))
    out = flows(spark, sf_dir).groupBy(F.col("label").alias("model")).agg(right.alias("test_accuracy"))
    return rounded(out, 6, "test_accuracy")


@query("compare_models", f"""{RESULTS} SELECT *,
  CAST(row_number() OVER (ORDER BY test_accuracy DESC, model) AS INTEGER) AS rank FROM results""")
def compare_models(spark, sf_dir):
    return V.compare(result_rows(spark, sf_dir))


@query("best_model", f"{RESULTS} SELECT * FROM results ORDER BY test_accuracy DESC, model LIMIT 1")
def best_model(spark, sf_dir):
    return V.best_model(result_rows(spark, sf_dir))


ERROR = "event_type = 'error'"
CURVE = f"""WITH g AS (SELECT value AS threshold, count(*) FILTER ({ERROR}) AS p,
    count(*) FILTER (NOT ({ERROR})) AS q FROM events GROUP BY value),
  k AS (SELECT threshold, p, q, sum(p) OVER (ORDER BY threshold DESC) AS tp,
    sum(q) OVER (ORDER BY threshold DESC) AS fp, sum(p) OVER () AS allp, sum(q) OVER () AS allq FROM g)"""


@query("roc", f"""{CURVE} SELECT threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
  {r('tp / allp')} AS tpr, {r('fp / allq')} AS fpr FROM k""")
def roc(spark, sf_dir):
    out = V.roc(table(spark, sf_dir, "events"), "value", F.expr(ERROR)).drop("area")
    return rounded(out, 6, "tpr", "fpr")


@query("roc_auc", f"{CURVE} SELECT {r('sum(q * (tp - p / 2) / (allp * allq))')} AS auc FROM k")
def roc_auc(spark, sf_dir):
    return rounded(V.roc_auc(table(spark, sf_dir, "events"), "value", F.expr(ERROR)), 6, "auc")


THRESHOLDS = [1.0, 10.0, 50.0, 99.0, 1000.0]


def _sweep_sql(t: float) -> str:
    n, p, a = f"count(*) FILTER (value >= {t})", f"count(*) FILTER (value >= {t} AND {ERROR})", f"count(*) FILTER ({ERROR})"
    return f"""SELECT CAST({t} AS DOUBLE) AS threshold, {n} AS flagged, {p} AS tp,
      {r(f'CASE WHEN {n} = 0 THEN 0 ELSE {p} / {n} END')} AS precision, {r(f'{p} / {a}')} AS recall,
      {r(f'2 * {p} / ({n} + {a})')} AS f1 FROM events"""


@query("threshold_sweep", " UNION ALL ".join(_sweep_sql(t) for t in THRESHOLDS))
def threshold_sweep(spark, sf_dir):
    out = V.threshold_sweep(table(spark, sf_dir, "events"), "value", F.expr(ERROR), THRESHOLDS)
    return rounded(out, 6, "precision", "recall", "f1")


# ---------------------------------------------------------------- scoring

@functools.lru_cache(maxsize=2)
def _fitted(spark, sf_dir, full: bool = False) -> tuple[dict[str, PipelineModel], DataFrame]:
    train, test = banded(spark, sf_dir)
    train = train.select(*MODEL_FEATURES, "band").persist(StorageLevel.DISK_ONLY)  # memory is left to the fits
    models = {p.key: C.fit_model(p if full else BRIEF[p.key], train, MODEL_FEATURES, "band") for p in C.PRESETS}
    train.unpersist()
    return models, test


@query("predict_attacks")
def predict_attacks(spark, sf_dir):
    models, test = _fitted(spark, sf_dir)
    return S.predict_attacks(test, models)


@query("model_checks", f"""WITH {FLOWS}, {BAND_SPLIT}
  SELECT model, count(*) AS rows, true AS classes_known, true AS shares_fit, true AS beats_largest_class
  FROM split, (SELECT unnest([{', '.join(f"'{p.key}'" for p in C.PRESETS)}]) AS model) WHERE is_test GROUP BY model""")
def model_checks(spark, sf_dir):
    """What holds for any trained model: every row scored with a known class and a fitting
    confidence, and more rows right than by always naming the largest class."""
    models, test = _fitted(spark, sf_dir)
    scored = S.predict_attacks(test, models)
    classes = test.groupBy("band").count()
    k, largest = classes.agg(F.count(F.lit(1)), F.max("count")).head()
    shapes = [F.struct(
        F.lit(key).alias("model"), F.col(f"{key}_prediction").alias("p"), F.col(f"{key}_confidence").alias("c"))
        for key in models]
    return scored.select("band", F.inline(F.array(*shapes))).groupBy("model").agg(
        F.count(F.lit(1)).alias("rows"),
        F.bool_and(F.col("p").between(0, k - 1)).alias("classes_known"),
        F.bool_and(F.col("c").between(1 / k - 1e-9, 1 + 1e-9)).alias("shares_fit"),
        (F.count_if(F.col("p") == F.col("band")) > largest).alias("beats_largest_class"))


@query("score_flow")
def score_flow(spark, sf_dir):
    models, test = _fitted(spark, sf_dir, full=True)
    return score(test, models, [*KEY, "band"])


@query("bayes_save_load", f"""WITH {_bayes_sql('band')}
  SELECT {KEYS}, band, prediction FROM best WHERE i = 1""")
def bayes_save_load(spark, sf_dir):
    train, test = banded(spark, sf_dir)
    folder = scratch(spark)
    model_store.save_models({C.BAYES.key: C.fit_model(C.BAYES, train, MODEL_FEATURES, "band")}, folder)
    return S.predict_attacks(test, model_store.load_models([C.BAYES.key], folder)).select(
        *KEY, "band", F.col("naive_bayes_prediction").alias("prediction"))


@query("model_save_load")
def model_save_load(spark, sf_dir):
    models, test = _fitted(spark, sf_dir)
    folder = scratch(spark)
    model_store.save_models(models, folder)
    loaded = model_store.load_models(list(models), folder)
    return T.vote_accuracy(score(test, loaded, ["band"]), "vote", "band")


@query("report_tables", report_sql(COUNTS, REPORT_COLUMNS))
def report_tables(spark, sf_dir):
    counts = pseudo_counts(spark, sf_dir)
    folder = scratch(spark)
    reports.write_report({
        "confusion": V.confusion_matrix(counts), "classes": V.class_report(counts),
        "metrics": V.summary(counts), "diagonal": V.diagonal(counts),
    }, folder)
    return rounded(reports.read_report(spark, folder, "classes"), 6, "precision", "recall", "f1")


@query("confidence", f"""WITH {FLOWS}, s AS (SELECT {KEYS}, quantity / (quantity + 20 + 100 * tax) AS a,
    20 / (quantity + 20 + 100 * tax) AS b, 100 * tax / (quantity + 20 + 100 * tax) AS c FROM flows)
  SELECT {KEYS}, {r('greatest(a, b, c)')} AS confidence FROM s""")
def confidence(spark, sf_dir):
    total = F.col("quantity") + 20 + 100 * F.col("tax")
    shares = F.array(F.col("quantity") / total, F.lit(20) / total, 100 * F.col("tax") / total)
    out = flows(spark, sf_dir).select(*KEY, top_probability(shares).alias("confidence"))
    return rounded(out, 6, "confidence")


@query("one_vs_rest_confidence", f"""SELECT vec_id,
  {r('''list_max(list_transform(embedding, lambda x: 1 / (1 + exp(-2 * x::DOUBLE))))
    / list_sum(list_transform(embedding, lambda x: 1 / (1 + exp(-2 * x::DOUBLE))))''')} AS confidence
  FROM embeddings""")
def one_vs_rest_confidence(spark, sf_dir):
    raw = F.col("embedding").cast("array<double>")
    out = table(spark, sf_dir, "embeddings").select(
        "vec_id", top_probability(one_vs_rest_probability(raw)).alias("confidence"))
    return rounded(out, 6, "confidence")


VOTES = {
    "a": "CASE WHEN quantity <= 30 THEN band ELSE l_partkey % 6 END",
    "b": "l_suppkey % 6",
    "c": "CASE WHEN discount < 0.05 THEN band ELSE CAST(l_linenumber AS BIGINT) END",
    "d": "l_orderkey % 6",
    "e": "(l_partkey + l_suppkey) % 6",
}
VOTED = f"""WITH {FLOWS}, v AS (SELECT {KEYS}, band, {', '.join(f'{e} AS {n}' for n, e in VOTES.items())}
    FROM flows),
  long AS ({' UNION ALL '.join(f'SELECT {KEYS}, band, {n} AS x FROM v' for n in VOTES)}),
  tally AS (SELECT {KEYS}, band, x, row_number() OVER (PARTITION BY {KEYS}
      ORDER BY count(*) DESC, x) AS i FROM long GROUP BY {KEYS}, band, x),
  voted AS (SELECT {KEYS}, band, x AS vote FROM tally WHERE i = 1)"""


def ballots(spark, sf_dir) -> DataFrame:
    return flows(spark, sf_dir).select(*KEY, "band", *[F.expr(e).alias(n) for n, e in VOTES.items()])


@query("majority_vote", f"{VOTED} SELECT {KEYS}, vote FROM voted")
def majority_vote(spark, sf_dir):
    return S.majority_vote(ballots(spark, sf_dir), list(VOTES)).select(*KEY, "vote")


@query("majority_vote_long", f"{VOTED} SELECT {KEYS}, vote FROM voted")
def majority_vote_long(spark, sf_dir):
    long = ballots(spark, sf_dir).select(*KEY, F.explode(F.array(*VOTES)).alias("prediction"))
    return S.majority_vote_long(long, KEY)


@query("match_status", f"""{VOTED} SELECT {KEYS}, vote,
  CASE WHEN vote = band THEN 'correct' ELSE 'wrong' END AS status FROM voted""")
def match_status(spark, sf_dir):
    voted = S.majority_vote(ballots(spark, sf_dir), list(VOTES))
    return S.match_status(voted, "vote", "band").select(*KEY, "vote", "status")


@query("vote_accuracy", f"""{VOTED} SELECT
  {r('avg(CAST(vote = band AS INTEGER))')} AS accuracy FROM voted""")
def vote_accuracy(spark, sf_dir):
    voted = S.majority_vote(ballots(spark, sf_dir), list(VOTES))
    return rounded(T.vote_accuracy(voted, "vote", "band"), 6, "accuracy")


@query("prediction_table", f"""WITH {FLOWS}, v AS (SELECT *, {', '.join(f'{e} AS {n}' for n, e in VOTES.items())}
    FROM flows)
  SELECT {KEYS}, band AS true_class, {', '.join(VOTES)}, {r('tax / 0.08')} AS confidence,
    CASE WHEN a = band THEN 'correct' ELSE 'wrong' END AS status FROM v""")
def prediction_table(spark, sf_dir):
    named = flows(spark, sf_dir).select(
        *KEY, "band", *[F.expr(e).alias(f"{n}_prediction") for n, e in VOTES.items()],
        (F.col("tax") / 0.08).alias("a_confidence"))
    return rounded(S.prediction_table(named, list(VOTES), "a", "band", KEY), 6, "confidence")


RULES = [("quantity > 40 AND tax < 0.02", "flood"), ("discount >= 0.09", "scan"),
         ("price < 5000 OR quantity = 1", "probe")]


@query("apply_rules", f"""WITH {FLOWS} SELECT {KEYS},
  CASE {' '.join(f"WHEN {e} THEN '{n}'" for e, n in RULES)} ELSE 'normal' END AS rule_class FROM flows""")
def apply_rules(spark, sf_dir):
    return S.apply_rules(flows(spark, sf_dir), RULES, "normal").select(*KEY, "rule_class")
