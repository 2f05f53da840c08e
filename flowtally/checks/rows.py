"""Filters, joins, ordered rows, aggregates, windows, sorts and reshaping.

Where the tables hold no NULL, some values are set to NULL by a rule on their row.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.nulls import (
    ascending,
    descending,
    is_one_of,
    lenient_sum,
    matches,
    ratio,
    strict_sum,
)
from ..operators import joins as J
from ..operators import ordered as R
from ..operators import reshape as S
from ..operators import totals as A
from ..plans import cubes as Q
from ..session import staged
from ..sources import tables as T
from .registry import LINES, MOVES, PRIORITIES, check


def _orders(spark, folder):
    return T.table(spark, folder, "orders")


# --- filters ---------------------------------------------------------------------


@check("O24", sql="SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= 250000 AND o_orderstatus <> 'F'")
def comparison_filter(spark, folder):
    chosen = (F.col("o_totalprice") >= 250000) & (F.col("o_orderstatus") != "F")
    return _orders(spark, folder).where(chosen).select("o_orderkey", "o_totalprice")


EVENTS = """WITH e AS (
    SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN event_type END AS event_type,
           CASE WHEN event_id % 2 <> 0 THEN value END AS value FROM events)"""


def _gappy_events(spark, folder):
    return T.table(spark, folder, "events").select(
        "event_id",
        F.when(F.col("event_id") % 3 != 0, F.col("event_type")).alias("event_type"),
        F.when(F.col("event_id") % 2 != 0, F.col("value")).alias("value"),
    )


@check("O25", sql=EVENTS + " SELECT * FROM e WHERE event_type IS NOT NULL OR value IS NOT NULL")
def drop_empty_rows(spark, folder):
    return _gappy_events(spark, folder).dropna(how="all", subset=["event_type", "value"])


@check("O27", "O29", "O87", sql=EVENTS + """ SELECT * FROM e
    WHERE NOT coalesce(regexp_matches(event_type, '(?i)^CL|view'), FALSE) AND NOT coalesce(event_type IN ('error'), FALSE)""")
def regex_and_label_filter(spark, folder):
    """Texts that match go; missing ones stay."""
    return _gappy_events(spark, folder).where(
        ~matches("event_type", "^CL|view", ignore_case=True) & ~is_one_of("event_type", ["error"])
    )


@check("O30", "O94", sql="SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders WHERE year(o_orderdate) = 1998")
def year_filter(spark, folder):
    orders = _orders(spark, folder).where(F.year("o_orderdate") == 1998)
    return orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))


@check("O28", "O40", sql="""WITH top AS (SELECT l_suppkey FROM lineitem GROUP BY 1 ORDER BY sum(l_quantity) DESC, 1 LIMIT 15)
    SELECT l_orderkey, l_linenumber, l_suppkey, sum(l_quantity) AS n FROM lineitem
    WHERE l_suppkey IN (SELECT l_suppkey FROM top) GROUP BY ALL""")
def membership_filter(spark, folder):
    """Lines of the fifteen busiest suppliers."""
    lines = T.table(spark, folder, "lineitem")
    top = A.top_by(lines, "l_suppkey", strict_sum("l_quantity"), 15).select("l_suppkey")
    kept = J.keep_members(lines, l_suppkey=top)
    return kept.groupBy("l_orderkey", "l_linenumber", "l_suppkey").agg(F.sum("l_quantity").alias("n"))


@check("O31", sql="""SELECT c_custkey, c_mktsegment FROM customer
    WHERE c_mktsegment NOT IN (SELECT c_mktsegment FROM customer GROUP BY 1 ORDER BY count(*), 1 LIMIT 2)""")
def exclusion_list(spark, folder):
    """Customers outside the two rarest segments, kept as an exclusion table."""
    customers = T.table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    rare = customers.groupBy("c_mktsegment").count().orderBy("count", "c_mktsegment").limit(2)
    return J.drop_members(customers, "c_mktsegment", rare)


@check("O33", sql="""SELECT bool_and(o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')) AS all_listed,
    bool_and(o_orderpriority IN ('1-URGENT', '2-HIGH')) AS two_listed, count(*) AS orders FROM orders""")
def all_values_known(spark, folder):
    orders = _orders(spark, folder)
    known = [J.all_known(orders, "o_orderpriority", levels) for levels in (PRIORITIES, PRIORITIES[:2])]
    return orders.agg(F.lit(known[0]).alias("all_listed"), F.lit(known[1]).alias("two_listed"), F.count(F.lit(1)).alias("orders"))


# --- joins -----------------------------------------------------------------------


@check("O34", sql="SELECT o_orderkey, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_custkey % 3 <> 0")
def left_join(spark, folder):
    customers = T.table(spark, folder, "customer").where(F.col("c_custkey") % 3 != 0)
    orders = _orders(spark, folder).select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    return J.join_on(orders, customers.select("c_custkey", "c_mktsegment"), "c_custkey").drop("c_custkey")


GAPS = """WITH a AS (SELECT c_nationkey AS k, c_mktsegment AS s, count(*) AS n FROM (
      SELECT CASE WHEN c_nationkey % 5 <> 0 THEN c_nationkey END AS c_nationkey, c_mktsegment FROM customer) GROUP BY ALL),
    b AS (SELECT k, s, count(*) AS m FROM (
      SELECT CASE WHEN s_nationkey % 5 <> 0 THEN s_nationkey END AS k,
             CASE WHEN s_suppkey % 2 = 0 THEN 'BUILDING' ELSE 'OTHER' END AS s FROM supplier) GROUP BY ALL)"""


def _gappy_keys(spark, folder):
    def gap(c):
        return F.when(F.col(c) % 5 != 0, F.col(c)).alias("k")

    a = T.table(spark, folder, "customer").groupBy(gap("c_nationkey"), F.col("c_mktsegment").alias("s")).agg(F.count(F.lit(1)).alias("n"))
    kind = F.when(F.col("s_suppkey") % 2 == 0, F.lit("BUILDING")).otherwise(F.lit("OTHER")).alias("s")
    b = T.table(spark, folder, "supplier").groupBy(gap("s_nationkey"), kind).agg(F.count(F.lit(1)).alias("m"))
    return a, b


@check("O35", sql=GAPS + """ SELECT a.k, a.s, n, m FROM a LEFT JOIN b ON a.k IS NOT DISTINCT FROM b.k AND a.s IS NOT DISTINCT FROM b.s""")
def natural_left_join(spark, folder):
    """Left join on all shared columns; missing keys meet."""
    return J.join_shared(*_gappy_keys(spark, folder))


@check("O38", "O39", sql=GAPS + """ SELECT coalesce(a.k, b.k) AS k, coalesce(a.s, b.s) AS s, n, m
    FROM a FULL JOIN b ON a.k IS NOT DISTINCT FROM b.k AND a.s IS NOT DISTINCT FROM b.s""")
def full_join(spark, folder):
    a, b = _gappy_keys(spark, folder)
    return J.join_on(a, b, ["k", "s"], "full")


@check("O36", sql="SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def join_differing_names(spark, folder):
    customers = T.table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nations = T.table(spark, folder, "nation").select("n_nationkey", "n_name")
    return J.join_on(customers, nations, {"c_nationkey": "n_nationkey"}).drop("c_nationkey")


@check("O37", sql="""SELECT c_custkey, CASE WHEN c_nationkey <> 7 THEN 'N' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') END AS iso FROM customer""")
def lookup_with_synonyms(spark, folder):
    """The dimension spells nation 3 differently and lacks nation 7."""
    dim = T.countries(spark, folder).where(F.col("name") != "NATION_7")
    dim = dim.withColumn("name", F.when(F.col("name") == "NATION_3", F.lit("NATION THREE")).otherwise(F.col("name")))
    named = J.join_on(
        T.table(spark, folder, "customer").select("c_custkey", "c_nationkey"),
        T.table(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("name")),
        {"c_nationkey": "n_nationkey"},
    )
    known = F.regexp_replace("name", "^NATION THREE$", "NATION_3")
    return J.with_lookup(named, "name", dim, "name", {"iso": "iso"}, known).select("c_custkey", "iso")


@check("O41", sql=f"WITH {LINES}, p AS (SELECT op_id, sum(amount) AS amount FROM lines GROUP BY 1) SELECT o_orderkey, CAST(amount AS DOUBLE) AS amount FROM orders LEFT JOIN p ON o_orderkey = op_id")
def join_to_aggregate(spark, folder):
    paid = T.ledger_lines(spark, folder).groupBy("op_id").agg(lenient_sum("amount").cast("double").alias("amount"))
    orders = _orders(spark, folder).select(F.col("o_orderkey").alias("op_id"))
    return J.join_on(orders, paid, "op_id", null_safe=False).select(F.col("op_id").alias("o_orderkey"), "amount")


@check("O42", sql="""SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1995 THEN CASE WHEN c_custkey % 2 = 0 THEN c_name END
    WHEN year(o_orderdate) = 1996 THEN 'own-' || o_orderstatus
    ELSE 'RO-' || CAST(year(o_orderdate) AS VARCHAR) || '-' || CAST(o_orderkey AS VARCHAR) END AS id
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def key_by_year(spark, folder):
    """Id joined, carried or built, by the year of the row."""
    candidates = T.table(spark, folder, "customer").where(F.col("c_custkey") % 2 == 0).select("c_custkey", "c_name")
    rows = J.join_on(_orders(spark, folder), candidates, {"o_custkey": "c_custkey"}, null_safe=False)
    year = F.year("o_orderdate")
    built = F.concat(F.lit("RO-"), year.cast("string"), F.lit("-"), F.col("o_orderkey").cast("string"))
    carried = F.concat(F.lit("own-"), "o_orderstatus")
    return rows.select("o_orderkey", F.when(year == 1995, F.col("c_name")).when(year == 1996, carried).otherwise(built).alias("id"))


# --- ordered rows ----------------------------------------------------------------


SPARSE = """WITH e AS (SELECT event_id, user_id, CASE WHEN event_id % 7 = 0 THEN event_type END AS event_type,
    CASE WHEN event_id % 5 = 0 THEN value END AS value FROM events)"""


def _sparse_events(spark, folder):
    return T.table(spark, folder, "events").select(
        "event_id",
        "user_id",
        F.when(F.col("event_id") % 7 == 0, F.col("event_type")).alias("event_type"),
        F.when(F.col("event_id") % 5 == 0, F.col("value")).alias("value"),
    )


@check("O43", sql=SPARSE + """ SELECT event_id, user_id,
    last_value(event_type IGNORE NULLS) OVER w AS event_type, last_value(value IGNORE NULLS) OVER w AS value
    FROM e WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)""")
def fill_down_by_key(spark, folder):
    return R.fill_down(_sparse_events(spark, folder), ["event_type", "value"], ["event_id"], ["user_id"])


@check("O43", sql=SPARSE + """ SELECT event_id, user_id,
    last_value(event_type IGNORE NULLS) OVER w AS event_type, last_value(value IGNORE NULLS) OVER w AS value
    FROM e WINDOW w AS (ORDER BY event_id ROWS UNBOUNDED PRECEDING)""")
def fill_down_whole_table(spark, folder):
    """One group holding every row, cut into chunks."""
    return R.fill_down(_sparse_events(spark, folder), ["event_type", "value"], ["event_id"], chunks=20)


@check("O43", sql=SPARSE + """ SELECT event_id, user_id % 2 AS half,
    last_value(event_type IGNORE NULLS) OVER w AS event_type
    FROM e WINDOW w AS (PARTITION BY user_id % 2 ORDER BY event_id ROWS UNBOUNDED PRECEDING)""")
def fill_down_large_groups(spark, folder):
    """Two groups, each far over the chunk size."""
    halves = _sparse_events(spark, folder).select("event_id", (F.col("user_id") % 2).alias("half"), "event_type")
    return R.fill_down(halves, ["event_type"], ["event_id"], ["half"], chunks=20)


@check("O45", sql="SELECT event_id, row_number() OVER (ORDER BY event_id) AS line FROM events")
def row_numbers(spark, folder):
    return R.number_rows(T.table(spark, folder, "events").select("event_id"), "line", ["event_id"], chunks=20)


@check("O63", sql="""SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2)))
    OVER (PARTITION BY year(o_orderdate) ORDER BY o_orderkey) AS DOUBLE) AS running FROM orders""")
def running_totals(spark, folder):
    priced = _orders(spark, folder).select(
        "o_orderkey", F.year("o_orderdate").alias("year"), F.col("o_totalprice").cast("decimal(18,2)").alias("price")
    )
    out = R.running_total(priced, {"running": "price"}, ["o_orderkey"], ["year"], chunks=20)
    return out.select("o_orderkey", "year", F.col("running").cast("double").alias("running"))


@check("O43", "O63", sql="""SELECT event_id, user_id, last_value(v IGNORE NULLS) OVER w AS latest, CAST(sum(CAST(v AS DECIMAL(38,12))) OVER w AS DOUBLE) AS total
    FROM (SELECT event_id, user_id, CASE WHEN event_id % 5 = 0 THEN value END AS v FROM events)
    WINDOW w AS (PARTITION BY user_id % 3 ORDER BY event_id ROWS UNBOUNDED PRECEDING)""")
def two_scans_of_one_column(spark, folder):
    """The latest value and the running total of one column, in one pass."""
    rows = _sparse_events(spark, folder).withColumn("third", F.col("user_id") % 3)
    scans = {"latest": ("value", R.LAST_VALUE), "total": ("value", R.TOTAL)}
    return R.scan_rows(rows, scans, ["event_id"], ["third"]).select("event_id", "user_id", "latest", "total")


# --- aggregates and windows --------------------------------------------------------


PART = """WITH p AS (SELECT l_suppkey AS k, CASE WHEN l_linenumber <> 7 OR l_suppkey % 3 = 0 THEN l_quantity END AS n FROM lineitem)"""


def _gappy_lines(spark, folder):
    there = (F.col("l_linenumber") != 7) | (F.col("l_suppkey") % 3 == 0)
    return T.table(spark, folder, "lineitem").select(F.col("l_suppkey").alias("k"), F.when(there, F.col("l_quantity")).alias("n"))


@check("O47", sql=PART + " SELECT k, CASE WHEN count(n) = count(*) THEN sum(n) END AS n FROM p GROUP BY k")
def strict_sums(spark, folder):
    return _gappy_lines(spark, folder).groupBy("k").agg(strict_sum("n").alias("n"))


@check("O46", sql="""SELECT l_suppkey AS k, coalesce(sum(CASE WHEN l_suppkey % 3 <> 0 THEN l_quantity END), 0) AS n
    FROM lineitem GROUP BY 1""")
def lenient_sums(spark, folder):
    lines = T.table(spark, folder, "lineitem").withColumn("n", F.when(F.col("l_suppkey") % 3 != 0, F.col("l_quantity")))
    return lines.groupBy(F.col("l_suppkey").alias("k")).agg(lenient_sum("n").alias("n"))


@check("O48", "O49", sql="""SELECT o_custkey, count(*) AS orders, CAST(count_if(o_orderpriority = '1-URGENT') AS BIGINT) AS urgent FROM orders GROUP BY 1""")
def counts(spark, folder):
    urgent = F.count_if(F.col("o_orderpriority") == "1-URGENT")
    return _orders(spark, folder).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"), urgent.alias("urgent"))


@check("O50", "O51", sql=f"""WITH {MOVES}, o AS (SELECT op_id, op_date, op_type, sum(n) AS n FROM moves GROUP BY ALL)
    SELECT op_type, sum(n) AS n, count(*) AS operations, max(n) AS largest FROM o GROUP BY 1""")
def two_level_aggregate(spark, folder):
    ops = T.movements(spark, folder, origin=False).groupBy("op_id", "op_date", "op_type").agg(lenient_sum("n").alias("n"))
    return ops.groupBy("op_type").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("operations"), F.max("n").alias("largest")
    )


@check("O52", "O56", sql="""SELECT substr(CAST(CAST(l_shipdate AS DATE) AS VARCHAR), 1, 4) AS year,
    CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / sum(l_quantity) AS price FROM lineitem GROUP BY 1""")
def computed_key_ratio(spark, folder):
    year = F.substring(F.col("l_shipdate").cast("date").cast("string"), 1, 4).alias("year")
    lines = T.table(spark, folder, "lineitem").withColumn("price", F.col("l_extendedprice").cast("decimal(18,2)"))
    return lines.groupBy(year).agg(ratio(F.sum("price"), F.sum("l_quantity")).alias("price"))


@check("O53", sql=f"""WITH {LINES} SELECT CASE WHEN grouping(origin) = 1 THEN 'average' ELSE origin END AS origin, sum(n) AS n,
    count(*) AS n_lines FROM lines GROUP BY ROLLUP (origin)""")
def grand_total_row(spark, folder):
    lines = T.movement_lines(spark, folder).select("origin", "n", F.lit(1).cast("long").alias("n_lines"))
    return A.with_grand_total(lines, "origin", "average")


@check("O54", sql=f"""WITH {LINES} SELECT origin, CASE WHEN grouping(op_type) = 1 THEN 'all types' ELSE op_type END AS op_type,
    sum(n) AS n FROM lines GROUP BY GROUPING SETS ((origin, op_type), (origin))""")
def subtotal_rows(spark, folder):
    return A.with_subtotal(T.movement_lines(spark, folder), ["origin", "op_type"], "op_type", "all types", ["n"])


@check("O57", sql="""SELECT o_custkey, count_if(o_orderstatus = 'F') / CAST(count(*) AS DOUBLE) AS share FROM orders GROUP BY 1""")
def share_of_group(spark, folder):
    finished = F.count_if(F.col("o_orderstatus") == "F")
    return _orders(spark, folder).groupBy("o_custkey").agg(ratio(finished, F.count(F.lit(1))).alias("share"))


@check("O58", sql="SELECT DISTINCT c_mktsegment, c_nationkey FROM customer")
def distinct_values(spark, folder):
    return T.table(spark, folder, "customer").select("c_mktsegment", "c_nationkey").distinct()


@check("O59", sql="SELECT max(t) AS top FROM (SELECT sum(l_quantity) AS t FROM lineitem GROUP BY l_orderkey)")
def largest_group_total(spark, folder):
    totals = T.table(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("total"))
    return totals.agg(F.max("total").alias("top"))


@check("O60", sql=f"""WITH {LINES}, r AS (SELECT dest, origin, sum(n) AS n FROM lines GROUP BY ALL)
    SELECT dest, origin, n, sum(n) OVER (PARTITION BY origin) AS n_origin, sum(n) OVER (PARTITION BY dest) AS n_dest FROM r""")
def partition_totals(spark, folder):
    """Totals of both sides on every route; the routes are aggregated first."""
    routes = Q.route_matrix(T.movement_lines(spark, folder))
    by_origin = A.with_group_total(routes, ["origin"], {"n_origin": strict_sum("n")})
    return A.with_group_total(by_origin, ["dest"], {"n_dest": strict_sum("n")})


@check("O61", sql=f"WITH {MOVES} SELECT op_id, dest, n, count(*) OVER (PARTITION BY op_id, op_date) AS n_dest FROM moves")
def partition_sizes(spark, folder):
    """Number of destinations on each row of an operation, at most one row per place."""
    moves = T.movements(spark, folder, origin=False)
    return A.with_group_total(moves, ["op_id", "op_date"], {"n_dest": F.count(F.lit(1))}).select("op_id", "dest", "n", "n_dest")


@check("O62", sql="""SELECT l_orderkey, min(l_partkey) AS l_partkey, min(l_quantity) AS l_quantity FROM lineitem
    GROUP BY l_orderkey HAVING count(*) = 1""")
def single_rows(spark, folder):
    lines = T.table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return A.single_rows(lines, ["l_orderkey"])


# --- sorts, top-k and shapes ---------------------------------------------------------


@check("O65", sql="""SELECT o_orderkey, v, row_number() OVER (ORDER BY v DESC NULLS LAST, o_orderkey) AS place FROM (
    SELECT o_orderkey, CASE WHEN o_orderkey % 10 <> 0 THEN o_totalprice END AS v FROM orders) QUALIFY place <= 200""")
def sorted_head(spark, folder):
    """The 200 dearest orders; missing prices sort last."""
    priced = _orders(spark, folder).select("o_orderkey", F.when(F.col("o_orderkey") % 10 != 0, F.col("o_totalprice")).alias("v"))
    head = priced.orderBy(descending("v"), ascending("o_orderkey")).limit(200)
    place = F.row_number().over(Window.orderBy(descending("v"), ascending("o_orderkey")))
    return head.withColumn("place", place.cast("long"))


@check("O66", "O67", sql=f"""WITH {LINES}, c AS (
      SELECT CASE WHEN grouping(dest) = 1 THEN 'all destinations' ELSE dest END AS dest, origin, sum(n) AS n
      FROM lines GROUP BY GROUPING SETS ((origin, dest), (origin)))
    SELECT dest, origin, n, row_number() OVER (ORDER BY dest = 'all destinations' DESC, n DESC, origin, dest) AS place FROM c""")
def pinned_sort(spark, folder):
    """Total rows first, then by size."""
    cube = A.with_subtotal(T.movement_lines(spark, folder), ["origin", "dest"], "dest", Q.ALL_DESTINATIONS, ["n"])
    ranked = cube.withColumns({"behind": F.col("dest") != Q.ALL_DESTINATIONS, "below": -F.col("n")})
    return R.number_rows(ranked, "place", ["behind", "below", "origin", "dest"]).drop("behind", "below")


@check("O68", sql="SELECT l_partkey, sum(l_quantity) AS total FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15")
def top_keys(spark, folder):
    return A.top_by(T.table(spark, folder, "lineitem"), "l_partkey", strict_sum("l_quantity"), 15)


@check("O71", sql="""SELECT c_name AS name, c_nationkey AS nation, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_name, s_nationkey, NULL FROM supplier""")
def union_of_differing_tables(spark, folder):
    customers = T.table(spark, folder, "customer").selectExpr("c_name AS name", "c_nationkey AS nation", "c_mktsegment AS segment")
    suppliers = T.table(spark, folder, "supplier").selectExpr("s_nationkey AS nation", "s_name AS name")
    return S.union_by_name(customers, suppliers)


@check("O72", sql="""SELECT o_orderkey, 'price' AS key, CASE WHEN o_orderkey % 4 <> 0 THEN o_totalprice END AS value FROM orders
    UNION ALL SELECT o_orderkey, 'client', CAST(o_custkey AS DOUBLE) FROM orders""")
def wide_to_long(spark, folder):
    """Missing values keep their row."""
    wide = _orders(spark, folder).select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 4 != 0, F.col("o_totalprice")).alias("price"),
        F.col("o_custkey").cast("double").alias("client"),
    )
    return S.wide_to_long(wide, ["o_orderkey"], ["price", "client"], "key", "value")


WIDE = f"""WITH o AS (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL)
    SELECT o_custkey, %s FROM o GROUP BY o_custkey"""


def _orders_by_client(spark, folder):
    return _orders(spark, folder).groupBy("o_custkey", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@check("O73", sql=WIDE % ", ".join(f"""CAST(sum(CASE WHEN o_orderpriority = '{p}' THEN n END) AS BIGINT) AS "{p}" """ for p in PRIORITIES))
def long_to_wide(spark, folder):
    """With the plan's own test that no cell has two rows."""
    return S.long_to_wide(_orders_by_client(spark, folder), ["o_custkey"], "o_orderpriority", "n", PRIORITIES)


@check("O75", sql=WIDE % ", ".join(f"""CAST(coalesce(sum(CASE WHEN o_orderpriority = '{p}' THEN n END), 0) AS BIGINT) AS "{p}" """ for p in PRIORITIES))
def filled_wide(spark, folder):
    wide = S.long_to_wide(_orders_by_client(spark, folder), ["o_custkey"], "o_orderpriority", "n", PRIORITIES, unique=True)
    return S.fill_columns(wide, PRIORITIES, 0).select("o_custkey", *[F.col(f"`{p}`").cast("long").alias(p) for p in PRIORITIES])


YEARS = list(range(1995, 2002))
GRID = f"""WITH s AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n FROM orders GROUP BY ALL),
    g AS (SELECT o_custkey, CAST(y.year AS INTEGER) AS year FROM (SELECT DISTINCT o_custkey FROM s), (SELECT unnest([{", ".join(map(str, YEARS))}]) AS year) y)
    SELECT g.o_custkey, g.year, coalesce(n, 0) AS n FROM g LEFT JOIN s ON g.o_custkey = s.o_custkey AND g.year = s.year"""


@check("O74", sql=GRID)
def dense_grid(spark, folder):
    """Every client gets a row for every year."""
    sums = _orders(spark, folder).groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("n"))
    return S.densify(sums, ["o_custkey"], "year", YEARS, "n")


@check("O76", sql=f"""WITH s AS (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL)
    SELECT o_custkey, o_orderpriority, {", ".join(f'''CASE WHEN o_orderpriority = '{p}' THEN n ELSE 0 END AS "{p}" ''' for p in PRIORITIES)} FROM s""")
def diagonal(spark, folder):
    return S.diagonal(_orders_by_client(spark, folder), "o_orderpriority", "n", PRIORITIES)


@check("O77", sql="""SELECT o_orderkey, 1 AS slot, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS label, CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS value FROM orders
    WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 <> 0
    UNION ALL SELECT o_orderkey, 2, o_orderpriority, NULL FROM orders WHERE o_orderkey % 5 = 0""")
def slots_to_rows(spark, folder):
    """Two repeated groups of (label, value); empty slots are left out."""
    wide = _orders(spark, folder).select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus")).alias("label 1"),
        F.when(F.col("o_orderkey") % 5 == 0, F.col("o_orderpriority")).alias("label 2"),
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice")).alias("value 1"),
        F.lit(None).cast("double").alias("value 2"),
    )
    return S.slots_to_rows(wide, ["o_orderkey"], {"label": ["label 1", "label 2"], "value": ["value 1", "value 2"]})


@check("O78", sql="""SELECT o_orderkey, CASE o_orderpriority WHEN '5-LOW' THEN 1 WHEN '1-URGENT' THEN 2 WHEN '3-MEDIUM' THEN 3 END AS level FROM orders""")
def value_ranks(spark, folder):
    """Rank in a fixed order; values outside it have none."""
    orders = _orders(spark, folder).select("o_orderkey", "o_orderpriority")
    return A.ranked_values(orders, "o_orderpriority", ["5-LOW", "1-URGENT", "3-MEDIUM"], "level").select("o_orderkey", "level")


@check("O78", "O33", sql=f"""WITH {LINES}, t AS (
      SELECT o_orderpriority AS op_type, CASE WHEN count(n) = count(*) THEN sum(n) END AS n
      FROM orders LEFT JOIN lines ON o_orderkey = op_id GROUP BY 1)
    SELECT op_type, CAST(row_number() OVER (ORDER BY n DESC NULLS LAST, op_type) AS INTEGER) AS level FROM t""")
def type_order_by_total(spark, folder):
    """No fixed order covers these types, so they are ranked by their totals, unknown ones by name."""
    totals = Q.operation_totals(T.movements(spark, folder, origin=False))
    ops = Q.operations(T.operation_types(spark, folder), totals, null_safe=False)
    cube = staged(Q.yearly_types_long(ops), "types")
    order = Q.type_order(cube)
    return A.ranked_values(cube.select("op_type").distinct(), "op_type", order, "level")
