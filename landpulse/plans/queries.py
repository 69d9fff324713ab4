"""Each operator over the driver's tables, with equivalent SQL.

No rasters are given, so tables stand in for them: parts are cells of a grid
40 wide, events are dated pixels, orders and line items are series.
Transcendental results, percentiles and sums are rounded alike on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import indices, scalars
from ..operators import breaks, composite, disturbance, neighborhood, recovery, sen, sieve, spatial
from ..params import TCW, Composite
from ..sources import manifest, rasters, sinks

WIDTH = 40
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) + 0.0 for n in names})


# --- expressions -----------------------------------------------------------

_BANDS_SQL = """b AS (SELECT l_orderkey, l_linenumber, l_quantity AS B02, l_extendedprice / 1000 AS B03, l_discount * 100 AS B04,
  l_tax * 100 + l_quantity AS B08, l_linenumber::DOUBLE AS B11, l_discount * 10 + 1 AS B12 FROM lineitem)"""


def bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    q, c = F.col("l_quantity"), F.col
    return load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", q.alias("B02"), (c("l_extendedprice") / 1000).alias("B03"), (c("l_discount") * 100).alias("B04"), (c("l_tax") * 100 + q).alias("B08"), c("l_linenumber").cast("double").alias("B11"), (c("l_discount") * 10 + 1).alias("B12")
    )


def _nd(a: str, b: str) -> str:
    return f"round(({a} - {b}) / nullif({a} + {b}, 0), 6) + 0.0"


_TCW_SQL = " + ".join(f"{b} * ({w})" for b, w in TCW.items())
_SAVI_SQL = "round((B08 - B04) / nullif(B08 + B04 + 0.5, 0) * 1.5, 6) + 0.0"


@query(f"WITH {_BANDS_SQL} SELECT l_orderkey, l_linenumber, {_nd('B08', 'B12')} AS NBR, {_nd('B08', 'B04')} AS NDVI, {_nd('B08', 'B11')} AS NDMI, {_nd('B11', 'B12')} AS NBR2, {_SAVI_SQL} AS SAVI, round({_TCW_SQL}, 6) AS TCW FROM b")
def spectral_indices(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["NBR", "NDVI", "NDMI", "NBR2", "SAVI", "TCW"]
    return rounded(indices.add_indices(bands(spark, sf_dir), names, keep=False, keys=("l_orderkey", "l_linenumber")), *names)


@query(f"WITH {_BANDS_SQL} SELECT l_orderkey, l_linenumber, round(B04, 6) AS B04, B08, {_nd('B08', 'B12')} AS NBR, {_SAVI_SQL} AS SAVI FROM b")
def payload_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(indices.payload(bands(spark, sf_dir), "both", ["NBR", "SAVI"], ["B04", "B08"], ("l_orderkey", "l_linenumber")), "B04", "NBR", "SAVI")


_SCL = {"click": 3, "error": 8, "purchase": 9, "signup": 4}
_SCL_SQL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in _SCL.items()) + " END"
_EVENTS_SQL = f"e AS (SELECT event_id, user_id, ts, date_trunc('day', ts) AS t, value, {_SCL_SQL} AS scl FROM events)"


def scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as dated pixels; views have no class."""
    scl = F.lit(None).cast("int")
    for kind, code in _SCL.items():
        scl = F.when(F.col("event_type") == kind, code).otherwise(scl)
    return load(spark, sf_dir, "events").select("event_id", "user_id", "ts", F.date_trunc("day", "ts").alias("t"), "value", scl.alias("scl"))


@query(f"WITH {_EVENTS_SQL} SELECT event_id, coalesce(scl, 0) AS scl, coalesce(scl, 0) IN (3, 8, 9, 10) AS cloud, coalesce(scl, 0) IN (1, 2, 3, 7, 8, 9, 10) AS excluded FROM e")
def cloud_mask_scl(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("scl")
    return scenes(spark, sf_dir).select("event_id", F.coalesce(c, F.lit(0)).alias("scl"), scalars.is_cloud(c).alias("cloud"), scalars.is_excluded(c).alias("excluded"))


_DATE_SQL = "exp(-0.5 * pow((day(ts) - 15) * 0.2, 2)) * 0.07978845"


@query(f"SELECT event_id, day(ts)::INTEGER AS day, round({_DATE_SQL}, 9) AS date_score FROM events")
def date_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").select("event_id", F.dayofmonth("ts").alias("day"), F.round(scalars.date_score(F.col("ts")), 9).alias("date_score"))


_COVER_SQL = f"{_EVENTS_SQL}, c AS (SELECT *, coalesce(scl, 0) IN (3, 8, 9, 10) AS cloud FROM e), v AS (SELECT *, avg(1.0 - cloud::INTEGER) OVER (PARTITION BY t) AS coverage FROM c)"


def _covered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return composite.coverage(scenes(spark, sf_dir).withColumn("cloud", scalars.is_cloud(F.col("scl"))), "cloud", "coverage")


@query(f"WITH {_COVER_SQL} SELECT event_id, cloud, round(coverage, 9) AS coverage FROM v")
def coverage_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_covered(spark, sf_dir).select("event_id", "cloud", "coverage"), "coverage", digits=9)


_SCORE_SQL = f"{_COVER_SQL}, s AS (SELECT *, CASE WHEN NOT (cloud OR coalesce(scl, 0) IN (1, 2, 3, 7, 8, 9, 10)) THEN (1.0 * (value / 1000) + 0.8 * {_DATE_SQL} + 0.5 * coverage) / 2.3 END AS score FROM v)"


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    score = scalars.weighted([c("value") / 1000, scalars.date_score(c("ts")), c("coverage")], (1.0, 0.8, 0.5))
    return _covered(spark, sf_dir).withColumn("score", F.when(~(c("cloud") | scalars.is_excluded(c("scl"))), score))


@query(f"WITH {_SCORE_SQL} SELECT event_id, round(score, 9) AS score FROM s")
def bap_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_scored(spark, sf_dir).select("event_id", "score"), "score", digits=9)


# --- grid ------------------------------------------------------------------

_GRID_SQL = f"g AS (SELECT (p_partkey % {WIDTH})::INTEGER AS x, (p_partkey // {WIDTH})::INTEGER AS y, p_size AS v, p_retailprice AS price FROM part)"


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    return load(spark, sf_dir, "part").select((key % WIDTH).cast("int").alias("x"), F.floor(key / WIDTH).cast("int").alias("y"), F.col("p_size").alias("v"), F.col("p_retailprice").alias("price"))


def height(cells: DataFrame) -> int:
    return cells.agg(F.coalesce(F.max("y"), F.lit(-1)) + 1).first()[0]


@query(f"WITH {_GRID_SQL} SELECT a.x, a.y, coalesce(bool_or(b.v <= 3), false) AS cloud FROM g a JOIN g b ON b.x BETWEEN a.x - 2 AND a.x + 2 AND b.y BETWEEN a.y - 2 AND a.y + 2 GROUP BY a.x, a.y")
def dilate_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighborhood.dilate(grid(spark, sf_dir).select("x", "y", (F.col("v") <= 3).alias("cloud")), "cloud", 2)


_TAPS = neighborhood.kernel(30, 60)
_TAPS_SQL = "CASE {d} " + " ".join(f"WHEN {i - len(_TAPS) // 2} THEN {w!r}" for i, w in enumerate(_TAPS)) + " END"
_R = len(_TAPS) // 2


@query(
    f"WITH {_GRID_SQL} SELECT a.x, a.y, round(1 - sum(CASE WHEN b.v <= 3 THEN ({_TAPS_SQL.format(d='b.x - a.x')})::DOUBLE * ({_TAPS_SQL.format(d='b.y - a.y')})::DOUBLE ELSE 0 END), 9) AS dtc "
    f"FROM g a JOIN g b ON b.x BETWEEN a.x - {_R} AND a.x + {_R} AND b.y BETWEEN a.y - {_R} AND a.y + {_R} GROUP BY a.x, a.y"
)
def gaussian_dtc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = neighborhood.distance_score(grid(spark, sf_dir).withColumn("cloud", F.col("v") <= 3), "cloud", "dtc", 30, 60)
    return rounded(out.select("x", "y", "dtc"), "dtc", digits=9)


_CLASS_SQL = "(g.v - 1) // 10"
_MAJORITY_SQL = f"""{_GRID_SQL}, h AS (SELECT max(y) AS last FROM g),
o AS (SELECT dx, dy FROM range(-3, 4) a(dx), range(-3, 4) b(dy)),
n AS (SELECT g.x, g.y, least(greatest(g.x + dx, 0), {WIDTH - 1}) AS nx, least(greatest(g.y + dy, 0), last) AS ny FROM g, o, h),
c AS (SELECT n.x, n.y, {_CLASS_SQL} AS v, count(*) AS k FROM n JOIN g ON g.x = nx AND g.y = ny GROUP BY ALL),
m AS (SELECT x, y, v, row_number() OVER (PARTITION BY x, y ORDER BY k DESC, v) AS nth FROM c)"""


def classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid(spark, sf_dir).select("x", "y", F.floor((F.col("v") - 1) / 10).cast("int").alias("v"))


@query(f"WITH {_MAJORITY_SQL} SELECT x, y, v::INTEGER AS v FROM m WHERE nth = 1")
def majority_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = classes(spark, sf_dir)
    return neighborhood.majority(cells, "v", 7, height(cells), WIDTH)


@query()
def sieve_mmu(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sieve.sieve(classes(spark, sf_dir), 400.0, 100.0)


@query(f"WITH {_GRID_SQL}, c AS (SELECT x, y, CASE WHEN v % 7 = 0 THEN NULL ELSE 1990 + v END AS yr, -10.0 * v AS mag FROM g) SELECT x, y, CASE WHEN yr IS NULL THEN 1 WHEN mag <= -200 THEN yr ELSE 0 END::INTEGER AS code FROM c")
def break_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    year = F.when(F.col("v") % 7 != 0, F.col("v") + 1990)
    return grid(spark, sf_dir).select("x", "y", scalars.break_class(year, F.col("v") * -10.0, -200.0).alias("code"))


@query(f"WITH {_GRID_SQL} SELECT min(price) AS low, max(price) AS high FROM g")
def raster_minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rasters.minmax(grid(spark, sf_dir), "price")


# --- zones -----------------------------------------------------------------

#: A nation's rectangle: columns and rows that overlap its neighbours'.
_BOX = ("(n_nationkey % 5) * 8 - 0.5", "(n_nationkey // 5) * 8 - 0.5", "(n_nationkey % 5) * 8 + 9.5", "(n_nationkey // 5) * 8 + 9.5")
_ZONES_SQL = f"z AS (SELECT n_nationkey AS zone_id, {_BOX[0]} AS x0, {_BOX[1]} AS y0, {_BOX[2]} AS x1, {_BOX[3]} AS y1 FROM nation)"


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    layer = load(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("zone_id"))
    return spatial.rectangles(layer, *(F.expr(b.replace("//", "DIV").replace("n_nationkey", "zone_id")) for b in _BOX))


@query(
    f"WITH {_GRID_SQL}, {_ZONES_SQL} SELECT zone_id, count(g.v)::BIGINT AS size_count, round(sum(price), 4) AS price_sum FROM z LEFT JOIN g "
    "ON g.x + 0.5 > x0 AND g.x + 0.5 < x1 AND g.y + 0.5 > y0 AND g.y + 0.5 < y1 GROUP BY zone_id"
)
def zonal_count_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells, layer = grid(spark, sf_dir), zones(spark, sf_dir)
    out = spatial.zonal(cells, spatial.zonal(cells, layer, "v", "size", "count"), "price", "price", "sum")
    return rounded(out.select("zone_id", "size_count", "price_sum"), "price_sum", digits=4)


_POINTS_SQL = "p AS (SELECT (c_custkey * 7 % 400) / 10.0 AS px, (c_custkey * 13 % 410) / 10.0 AS py FROM customer)"


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return load(spark, sf_dir, "customer").select(key.alias("pid"), ((key * 7 % 400) / 10.0).alias("px"), ((key * 13 % 410) / 10.0).alias("py"))


@query(f"WITH {_POINTS_SQL}, {_ZONES_SQL} SELECT zone_id, count(px)::BIGINT AS fire_count FROM z LEFT JOIN p ON px > x0 AND px < x1 AND py > y0 AND py < y1 GROUP BY zone_id")
def points_in_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.points_in_zones(points(spark, sf_dir), zones(spark, sf_dir), "fire").select("zone_id", "fire_count")


@query(f"WITH {_ZONES_SQL} SELECT zone_id, x0::DOUBLE AS min_x, y0::DOUBLE AS min_y, x1::DOUBLE AS max_x, y1::DOUBLE AS max_y FROM z")
def zone_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.bbox(zones(spark, sf_dir))


_FACTORS_SQL = """f AS (SELECT n_nationkey AS zone_id, n_name, coalesce(c.n, 0) AS disturbance_count, coalesce(s.n, 0) AS fire_count, coalesce(o.total, 0) AS built_sum FROM nation
  LEFT JOIN (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1) c ON c_nationkey = n_nationkey
  LEFT JOIN (SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY 1) s ON s_nationkey = n_nationkey
  LEFT JOIN (SELECT c_nationkey AS k, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1) o ON o.k = n_nationkey)"""
FACTORS = ["disturbance_count", "fire_count", "built_sum"]


def factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations with three factors, each aggregated by nation before it is joined."""
    nation, customer, supplier, orders = (load(spark, sf_dir, t) for t in ("nation", "customer", "supplier", "orders"))
    by_nation = customer.groupBy(F.col("c_nationkey").alias("zone_id")).agg(F.count(F.lit(1)).alias("disturbance_count"))
    suppliers = supplier.groupBy(F.col("s_nationkey").alias("zone_id")).agg(F.count(F.lit(1)).alias("fire_count"))
    # totals by customer first, so that the join is on one row a customer
    totals = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum("o_totalprice").alias("t"))
    built = totals.join(customer, "c_custkey").groupBy(F.col("c_nationkey").alias("zone_id")).agg(F.round(F.sum("t"), 2).alias("built_sum"))
    base = nation.select(F.col("n_nationkey").alias("zone_id"), "n_name")
    for other in (by_nation, suppliers, built):
        base = base.join(other, "zone_id", "left")
    return base.fillna(0, FACTORS)


def _index_sql(caps: str) -> str:
    norm = lambda f: f"least(greatest(ln(1 + {f}) / CASE WHEN cap_{f} = 0 THEN 1 ELSE cap_{f} END, 0), 1)"
    return f"WITH {_FACTORS_SQL}, c AS ({caps}), n AS (SELECT zone_id, n_name, {', '.join(f'{norm(f)} AS {f}_norm' for f in FACTORS)} FROM f, c)"


_CAPS_SQL = "SELECT " + ", ".join(f"quantile_cont(ln(1 + {f}), 0.99) AS cap_{f}" for f in FACTORS) + " FROM f"
_MEAN_SQL = "round((disturbance_count_norm * 0.7 + fire_count_norm * 0.3 + built_sum_norm * 0.9) / 1.9, 6) AS disturbance_index"


@query(f"{_index_sql(_CAPS_SQL)} SELECT zone_id, {', '.join(f'round({f}_norm, 6) AS {f}_norm' for f in FACTORS)} FROM n")
def log_cap_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [f"{f}_norm" for f in FACTORS]
    return rounded(disturbance.disturbance_index(factors(spark, sf_dir), FACTORS, components=True).select("zone_id", *names), *names)


@query(f"{_index_sql(_CAPS_SQL)} SELECT zone_id, n_name, {_MEAN_SQL} FROM n")
def disturbance_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(disturbance.disturbance_index(factors(spark, sf_dir), FACTORS).select("zone_id", "n_name", "disturbance_index"), "disturbance_index")


@query(f"{_index_sql('SELECT 4.0 AS cap_disturbance_count, 1.5 AS cap_fire_count, 18.0 AS cap_built_sum')} SELECT zone_id, {_MEAN_SQL} FROM n")
def fixed_caps_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(disturbance.disturbance_index(factors(spark, sf_dir), FACTORS, caps=(4.0, 1.5, 18.0)).select("zone_id", "disturbance_index"), "disturbance_index")


# --- composites ------------------------------------------------------------


@query(
    "WITH s AS (SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice, max(o_totalprice) OVER (PARTITION BY o_custkey, date_trunc('month', o_orderdate)) AS best FROM orders) SELECT o_orderkey, o_custkey, o_totalprice FROM s WHERE o_totalprice = best"
)
def rank_month_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return composite.best_of_month(rows, "o_totalprice", ("o_custkey",), "o_orderdate").select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "WITH s AS (SELECT o_custkey, year(o_orderdate)::INTEGER AS year, o_totalprice, o_totalprice = max(o_totalprice) OVER (PARTITION BY o_custkey, date_trunc('month', o_orderdate)) AS best FROM orders) SELECT o_custkey, year, round(median(o_totalprice), 4) AS value FROM s WHERE best GROUP BY ALL"
)
def bap_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    best = composite.best_of_month(rows, "o_totalprice", ("o_custkey",), "o_orderdate")
    return best.groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(F.round(F.median("o_totalprice"), 4).alias("value"))


_RAW_SQL = """r AS (SELECT l_suppkey, year(l_shipdate)::INTEGER AS year, month(l_shipdate) AS month, l_shipdate > TIMESTAMP '2000-01-25' AS late, l_linenumber AS scl,
  CASE WHEN l_quantity - 2 > 0 THEN (l_quantity - 2) * 100 END AS red, CASE WHEN l_extendedprice > 0 THEN l_extendedprice END AS nir FROM lineitem),
k AS (SELECT l_suppkey, year, CASE WHEN scl NOT IN (3, 8, 9, 10) THEN (CASE WHEN late THEN nir - 1000 ELSE nir END) END AS n, CASE WHEN late THEN red - 1000 ELSE red END AS d FROM r WHERE month IN (9, 10, 11))"""


@query(f"WITH {_RAW_SQL} SELECT l_suppkey, year, round(median((n - d) / nullif(n + d + 0.5, 0) * 1.5), 6) AS savi FROM k GROUP BY ALL")
def savi_season_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    t = c("l_shipdate")
    red, nir = (scalars.baseline_offset(scalars.positive(v), t, "2000-01-25") for v in ((c("l_quantity") - 2) * 100, c("l_extendedprice")))
    value = F.when(~scalars.is_cloud(c("l_linenumber")), indices.savi(nir, red))
    rows = load(spark, sf_dir, "lineitem").where(F.month(t).isin(9, 10, 11)).select("l_suppkey", F.year(t).alias("year"), value.alias("savi"))
    return rounded(rows.groupBy("l_suppkey", "year").agg(F.median("savi").alias("savi")), "savi")


@query(
    "SELECT y || '_' || lpad(m::VARCHAR, 2, '0') AS label, y || '-' || lpad(m::VARCHAR, 2, '0') || '-01' AS start, last_day(make_date(y, m, 1))::VARCHAR AS \"end\", y || '-' || lpad(m::VARCHAR, 2, '0') || '-01' AS time_label FROM range(2018, 2021) a(y), (VALUES (2), (6), (12)) b(m) "
    "UNION ALL SELECT y || '_0401_0630', y || '-04-01', y || '-06-30', y || '-04-01' FROM range(2018, 2021) a(y)"
)
def periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = [Composite(years=(2018, 2019, 2020), mode="monthly", months=(2, 6, 12)), Composite(years=(2018, 2019, 2020), season_start="04-01", season_end="06-30")]
    rows = [tuple(p[k] for k in ("label", "start", "end", "time_label")) for r in runs for p in r.check().periods()]
    return spark.createDataFrame(rows, "label string, start string, end string, time_label string")


@query("SELECT * FROM (VALUES ('spectral_recovery', '2020.tif'), ('legacy', 'bap_yearly_2020_0101_0330_nbr-savi.tif'), ('profiled', 'bap_breaks_yearly_2020_0101_0330_indices_savi.tif'), ('bands', 'bap_custom_yearly_2020_0101_0330_reflectance_b04-b08-b12.tif')) t(kind, name)")
def output_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = {
        "spectral_recovery": Composite(profile="spectral_recovery").for_profile(),
        "legacy": Composite(indices=("NBR", "SAVI"), naming="legacy"),
        "profiled": Composite(profile="breaks", indices=("SAVI", "NBR")).for_profile(),
        "bands": Composite(indices=("NBR", "SAVI"), payload="reflectance"),
    }
    return spark.createDataFrame([(k, r.check().output_name("2020_0101_0330")) for k, r in runs.items()], "kind string, name string")


# --- manifests: an entry for each nation ------------------------------------

_ENTRIES_SQL = """e AS (SELECT n_nationkey AS pos, (2000 + n_nationkey % 7) || '_0401_0630' AS period_label, CASE WHEN n_nationkey % 6 <> 5 THEN n_name || '.tif' END AS file, '/out/' || lower(n_name) || '.tif' AS path,
  CASE n_nationkey % 3 WHEN 0 THEN 'indices' WHEN 1 THEN 'both' ELSE 'reflectance' END AS payload, CASE WHEN n_nationkey % 2 = 0 THEN ['NBR', 'SAVI'] ELSE ['SAVI'] END AS idx, ['B04', 'B08'] AS refl FROM nation),
n AS (SELECT *, coalesce(file, list_extract(string_split(path, '/'), -1)) AS name FROM e),
x AS (SELECT n_name || '.tif' AS name FROM nation WHERE n_nationkey % 4 <> 3)"""


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, name = F.col("n_nationkey"), F.col("n_name")
    arrays = lambda *v: F.array(*(F.lit(x) for x in v))
    return load(spark, sf_dir, "nation").select(
        k.alias("pos"),
        F.concat((k % 7 + 2000).cast("string"), F.lit("_0401_0630")).alias("period_label"),
        F.when(k % 6 != 5, F.concat(name, F.lit(".tif"))).alias("file"),
        F.concat(F.lit("/out/"), F.lower(name), F.lit(".tif")).alias("path"),
        F.when(k % 3 == 0, "indices").when(k % 3 == 1, "both").otherwise("reflectance").alias("export_payload"),
        F.when(k % 2 == 0, arrays("NBR", "SAVI")).otherwise(arrays("SAVI")).alias("indices"),
        arrays("B04", "B08").alias("reflectance_bands"),
    )


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "nation").where(F.col("n_nationkey") % 4 != 3).select(F.concat("n_name", F.lit(".tif")).alias("name"))


@query(
    f"WITH {_ENTRIES_SQL} SELECT pos, (CASE WHEN list_position(idx, 'NBR') > 0 THEN list_position(idx, 'NBR') + CASE WHEN payload = 'both' THEN 2 ELSE 0 END END)::INTEGER AS listed, "
    "nullif(coalesce(list_position(CASE payload WHEN 'reflectance' THEN refl WHEN 'indices' THEN idx ELSE list_concat(refl, idx) END, 'SAVI'), 0), 0)::INTEGER AS in_order FROM e"
)
def band_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.array_position(manifest.band_order(), "SAVI")
    return entries(spark, sf_dir).select("pos", manifest.band_position("NBR").cast("int").alias("listed"), F.when(at > 0, at).cast("int").alias("in_order"))


@query(f"WITH {_ENTRIES_SQL} SELECT left(period_label, 4)::INTEGER AS year, arg_max(n.name, pos) AS name FROM n SEMI JOIN x ON n.name = x.name GROUP BY 1")
def year_resolver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.yearly(entries(spark, sf_dir), files(spark, sf_dir))


@query(f"WITH {_ENTRIES_SQL}, p AS (SELECT pos, list_extract(string_split(path, '/'), -1) AS name FROM e), m AS (SELECT arg_min(p.name, pos) AS first FROM p ANTI JOIN x ON p.name = x.name) SELECT first IS NULL AS ok, CASE WHEN first IS NULL THEN 'ok' ELSE 'missing file: ' || first END AS reason FROM m")
def manifest_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.completeness(entries(spark, sf_dir), files(spark, sf_dir))


# --- trends ----------------------------------------------------------------

_MONTHS_SQL = """m AS (SELECT c_nationkey AS k, date_trunc('month', o_orderdate)::DATE AS t, max(o_totalprice) AS a FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
v AS (SELECT k, t, row_number() OVER (PARTITION BY k ORDER BY t) - 1 AS i, CASE WHEN month(t) = 2 AND k % 2 = 0 THEN NULL ELSE a END AS v FROM m)"""


def monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest order by nation and month; every second nation has none in February."""
    customer = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("k"))
    months = load(spark, sf_dir, "orders").join(customer, "o_custkey").groupBy("k", F.trunc("o_orderdate", "month").alias("t")).agg(F.max("o_totalprice").alias("a"))
    v = F.when(~((F.month("t") == 2) & (F.col("k") % 2 == 0)), F.col("a"))
    return sen.positions(months.select("k", "t", v.alias("v")), ["k"], "t")


def _sen_sql(rows: str, key: str, period: int) -> str:
    return f"""{rows}, q AS (SELECT {key}, i % {period} AS s, i // {period} AS c, i, v FROM v WHERE v IS NOT NULL),
s AS (SELECT a.{key}, median((b.v - a.v) / (b.c - a.c)) AS slope FROM q a JOIN q b ON a.{key} = b.{key} AND a.s = b.s AND a.c < b.c GROUP BY 1),
d AS (SELECT {key}, median(v) AS mv, median(i) AS mi FROM q GROUP BY 1),
tr AS (SELECT DISTINCT v.{key}, slope, mv - mi / {period} * slope AS intercept FROM v LEFT JOIN s ON v.{key} = s.{key} LEFT JOIN d ON v.{key} = d.{key})"""


@query(f"WITH {_sen_sql(_MONTHS_SQL, 'k', 12)} SELECT k, round(slope, 4) AS slope, round(intercept, 4) AS intercept FROM tr")
def seasonal_sen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(sen.seasonal_sen(monthly(spark, sf_dir), 12, ["k"]), "slope", "intercept", digits=4)


_DAYS_SQL = "dd AS (SELECT user_id, date_trunc('day', ts) AS t, max(value) AS a FROM events GROUP BY 1, 2), v AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY t) - 1 AS i, a AS v FROM dd)"


@query(f"WITH {_sen_sql(_DAYS_SQL, 'user_id', 7)} SELECT user_id, round(slope, 4) AS slope, round(intercept, 4) AS intercept FROM tr")
def seasonal_sen_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = load(spark, sf_dir, "events").groupBy("user_id", F.date_trunc("day", "ts").alias("t")).agg(F.max("value").alias("v"))
    return rounded(sen.seasonal_sen(sen.positions(days, ["user_id"], "t"), 7, ["user_id"]), "slope", "intercept", digits=4)


@query(
    f"WITH {_sen_sql(_MONTHS_SQL, 'k', 12)}, r AS (SELECT median(v) AS ref FROM v WHERE year(t) BETWEEN 1995 AND 1997), "
    "p AS (SELECT k, greatest(0, 2001 - CASE WHEN k % 3 = 0 THEN 1995 ELSE 1998 END + 1) AS span, slope, intercept, ref FROM tr, r) "
    "SELECT k, round(slope * span, 4) AS delta_ir, round((intercept + slope * span) / (0.8 * ref), 6) AS r80p, round(slope * span / ref * 100, 4) AS percent_change FROM p"
)
def sen_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = monthly(spark, sf_dir)
    trend = sen.seasonal_sen(series, 12, ["k"])
    ref = sen.reference_value(series, "t", "v", 12, restored=1998).select(F.col("value").alias("ref"))
    restored = F.when(F.col("k") % 3 != 0, F.lit(1998))
    out = sen.metrics(trend.crossJoin(F.broadcast(ref)), F.lit(2001), restored, F.lit(1995), F.col("ref"))
    return rounded(rounded(out.select("k", "delta_ir", "r80p", "percent_change"), "delta_ir", "percent_change", digits=4), "r80p")


@query(
    f"WITH {_MONTHS_SQL}, dt AS (SELECT t FROM v GROUP BY t ORDER BY t LIMIT 36) "
    "SELECT 'reference_baseline_year_1996' AS source, round(median(v), 4) AS value FROM v WHERE year(t) = 1996 UNION ALL SELECT 'restoration_relative_1995_1997', round(median(v), 4) FROM v WHERE year(t) BETWEEN 1995 AND 1997 "
    "UNION ALL SELECT 'fallback_early_window', round(median(v), 4) FROM v WHERE t IN (SELECT t FROM dt) UNION ALL SELECT 'restoration_relative_1977_1979_fallback_full', round(median(v), 4) FROM v"
)
def reference_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = monthly(spark, sf_dir)
    lots = [sen.reference_value(series, "t", "v", 12, **o) for o in ({"baseline": 1996}, {"restored": 1998}, {}, {"restored": 1980})]
    out = lots[0]
    for x in lots[1:]:
        out = out.unionByName(x)
    return out.select("source", F.round("value", 4).alias("value"))


@query("SELECT count(DISTINCT month(o_orderdate))::BIGINT AS period, min(year(o_orderdate))::INTEGER AS first_year, max(year(o_orderdate))::INTEGER AS last_year FROM orders")
def infer_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sen.infer_period(load(spark, sf_dir, "orders"), "o_orderdate")


# --- breaks and recovery ---------------------------------------------------


def yearly(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "lineitem")
    return rows.groupBy("l_suppkey", F.year("l_shipdate").alias("year")).agg(F.avg("l_discount").alias("v"))


def quarterly(spark: SparkSession, sf_dir: str) -> DataFrame:
    quarter = F.year("l_shipdate") * 4 + F.quarter("l_shipdate")
    return load(spark, sf_dir, "lineitem").groupBy("l_suppkey", quarter.alias("year")).agg(F.avg("l_discount").alias("v"))


def _complete(series: DataFrame) -> DataFrame:
    """series with a row for each year between its first and last; values of added years are null."""
    every = series.groupBy("l_suppkey").agg(F.min("year").alias("a"), F.max("year").alias("b")).select("l_suppkey", F.explode(F.sequence("a", "b")).alias("year"))
    return every.join(series, ["l_suppkey", "year"], "left")


@query()
def breaks_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return breaks.detect(_complete(yearly(spark, sf_dir)), ["l_suppkey"], threshold=5.0, scale=1000.0)


@query()
def breaks_metrics_quarterly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return breaks.detect(_complete(quarterly(spark, sf_dir)), ["l_suppkey"], threshold=5.0, scale=1000.0)


@query()
def breaks_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return breaks.strong(breaks_metrics(spark, sf_dir), -5.0)


@query(
    "WITH f AS (SELECT l_suppkey, count(*) AS n, regr_slope(l_discount, l_quantity) AS slope, regr_intercept(l_discount, l_quantity) AS intercept, regr_sxx(l_discount, l_quantity) AS sxx, regr_syy(l_discount, l_quantity) AS syy, regr_r2(l_discount, l_quantity) AS r2 FROM lineitem GROUP BY 1) "
    "SELECT l_suppkey, n, round(slope, 8) AS slope, round(intercept, 6) AS intercept, round(CASE WHEN n > 2 THEN (1 - r2) * syy / nullif(sxx, 0) / (n - 2) * (n - 1) END, 8) AS cost FROM f"
)
def segment_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = breaks.segment_regression(load(spark, sf_dir, "lineitem"), ["l_suppkey"], "l_quantity", "l_discount")
    return rounded(rounded(out, "slope", "cost", digits=8), "intercept")


_TARGET_SQL = "SELECT l_returnflag AS index, round(median(l_extendedprice), 4) AS target FROM lineitem WHERE year(l_shipdate) BETWEEN 1996 AND 1998 GROUP BY 1"


@query(_TARGET_SQL)
def reference_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("index"), F.year("l_shipdate").alias("year"), F.col("l_extendedprice").alias("v"))
    return rounded(recovery.reference_target(rows, 1996, 1998), "target", digits=4)


_SERIES_SQL = "s AS (SELECT l_suppkey, year(l_shipdate) AS year, round(avg(l_extendedprice), 2) AS v FROM lineitem GROUP BY 1, 2)"
_AT_SQL = ", ".join(f"max(CASE WHEN year = {y} THEN v END) AS v{y}" for y in (1995, 1996, 1999, 2000))


def _recovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = load(spark, sf_dir, "lineitem").groupBy("l_suppkey", F.year("l_shipdate").alias("year")).agg(F.round(F.avg("l_extendedprice"), 2).alias("v"))
    return recovery.recovery(series, ["l_suppkey"], 30000.0, 1996, 1995, 4)


@query(
    f"WITH {_SERIES_SQL}, a AS (SELECT l_suppkey, {_AT_SQL} FROM s GROUP BY 1) SELECT l_suppkey, round(v2000 - v1996, 4) AS deltaIR, round((v2000 - v1996) / 4, 4) AS YrYr, round(v2000 / 24000, 6) AS R80P, "
    "round(CASE WHEN abs(v1995 - v1996) > 1e-12 THEN (greatest(v2000, v1999) - v1996) / (v1995 - v1996) END, 6) AS RRI FROM a"
)
def recovery_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _recovered(spark, sf_dir).select("l_suppkey", "deltaIR", "YrYr", "R80P", "RRI")
    return rounded(rounded(out, "deltaIR", "YrYr", digits=4), "R80P", "RRI")


@query(f"WITH {_SERIES_SQL} SELECT l_suppkey, min(CASE WHEN year >= 1996 AND v >= 30000.0 * 0.8 THEN year - 1996 END)::INTEGER AS Y2R FROM s GROUP BY 1")
def y2r(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recovered(spark, sf_dir).select("l_suppkey", F.col("Y2R").cast("int").alias("Y2R"))


# --- summaries and checks --------------------------------------------------


@query("SELECT CASE WHEN n_nationkey % 4 = 0 THEN 'failed' ELSE 'ok' END AS status, CASE WHEN n_nationkey % 4 = 0 THEN 'no pixels; clip failed' ELSE '' END AS reason, count(*)::BIGINT AS n FROM nation GROUP BY ALL")
def site_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = F.col("n_nationkey") % 4 == 0
    rows = load(spark, sf_dir, "nation").select(F.when(failed, "failed").otherwise("ok").alias("status"), sinks.flat_reason(F.when(failed, "no pixels,\nclip failed").otherwise("")).alias("reason"))
    return rows.groupBy("status", "reason").agg(F.count(F.lit(1)).alias("n"))


_ID_SQL = "CASE WHEN p_partkey % 10 = 0 THEN '  ' ELSE ' ' || p_name || '#' || p_partkey || ' ' END"


@query(f"SELECT p_partkey, regexp_replace(coalesce(nullif(trim({_ID_SQL}), ''), 'site ' || p_partkey), '[^A-Za-z0-9._-]+', '_', 'g') AS id FROM part")
def id_sanitize(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    raw = F.when(key % 10 == 0, "  ").otherwise(F.concat(F.lit(" "), "p_name", F.lit("#"), key.cast("string"), F.lit(" ")))
    return load(spark, sf_dir, "part").select("p_partkey", scalars.sanitize(raw, F.concat(F.lit("site "), key.cast("string"))).alias("id"))


@query("SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN year(o_orderdate) WHEN 1 THEN year(o_orderdate) WHEN 2 THEN 1987 END::INTEGER AS year FROM orders")
def parse_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, t = F.col("o_orderkey") % 4, F.col("o_orderdate")
    text = F.when(k == 0, F.date_format(t, "yyyy-MM-dd")).when(k == 1, F.concat(F.lit("restored in "), F.year(t).cast("string"))).when(k == 2, "abt. 1987-ish").otherwise("unknown")
    return load(spark, sf_dir, "orders").select("o_orderkey", scalars.parse_year(text).alias("year"))


@query("SELECT count(*)::BIGINT AS n_rows, count(*) FILTER (c_custkey IS NULL)::BIGINT AS n_null, count(DISTINCT c_custkey)::BIGINT AS n_distinct, count(*) > 0 AND count(*) = count(DISTINCT c_custkey) AS ok FROM customer")
def basin_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recovery.check_basins(load(spark, sf_dir, "customer"), "c_custkey")


@query("SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN make_date(year(o_orderdate), 7, 1) WHEN 1 THEN o_orderdate::DATE END AS day FROM orders")
def item_datetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, t = F.col("o_orderkey") % 3, F.col("o_orderdate")
    label = F.when(k == 0, F.year(t).cast("string")).when(k == 1, F.date_format(t, "yyyy-MM-dd")).otherwise("composite")
    return load(spark, sf_dir, "orders").select("o_orderkey", scalars.item_datetime(label).alias("day"))


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return disturbance_index(spark, sf_dir)
