"""The end-to-end analyses over movements and ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import RANKING_SYNONYMS_2021, operation_type_2022
from ..operators.reshape import union_by_name
from ..plans import costs as C
from ..plans import cubes as Q
from ..plans import flow as G
from ..plans.publish import publish
from ..session import new_folder, staged
from ..sources import tables as T
from ..sources.files import read_cube, write_cube
from .registry import AMOUNT, COSTS, LINES, MOVES, NATIONS, PRIORITIES, check, pivot_sql


@check("A1", "O47", sql=f"WITH {LINES} SELECT dest, origin, sum(n) AS n FROM lines GROUP BY dest, origin")
def route_matrix(spark: SparkSession, folder: str) -> DataFrame:
    """Summed by nation keys; names join the few routes afterwards."""
    return T.with_names(spark, folder, Q.route_matrix(T.keyed_lines(spark, folder)))


@check("A1", sql=f"WITH {LINES} SELECT dest, origin, sum(n) AS n FROM lines GROUP BY dest, origin HAVING sum(n) <> 0")
def nonzero_routes(spark, folder):
    return Q.nonzero_routes(T.movement_lines(spark, folder))


TOP = f"""WITH {LINES},
  routes AS (SELECT dest, origin, sum(n) AS n FROM lines GROUP BY dest, origin),
  top_o AS (SELECT origin, sum(n) AS n_origin FROM routes GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15),
  top_d AS (SELECT dest, sum(n) AS n_dest FROM routes GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15),
  ranked AS (
    SELECT dest, origin, n,
           CAST(dense_rank() OVER (ORDER BY n_origin DESC, origin) AS INTEGER) AS rank_origin,
           CAST(dense_rank() OVER (ORDER BY n_dest DESC, dest) AS INTEGER) AS rank_dest
    FROM routes JOIN top_o USING (origin) JOIN top_d USING (dest))"""


@check("A2", "O28", "O40", "O68", "O69", "O60", sql=TOP + " SELECT dest, origin, n FROM ranked")
def top_routes(spark, folder):
    return Q.top_routes(Q.route_matrix(T.movement_lines(spark, folder)))


@check("A2", "O66", sql=TOP + " SELECT dest, origin, n, rank_origin, rank_dest FROM ranked")
def top_routes_ranked(spark, folder):
    ranked = Q.ranked_top_routes(Q.route_matrix(T.movement_lines(spark, folder)))
    return ranked.select("dest", "origin", "n", "rank_origin", "rank_dest")


YEARLY_LONG = f"""WITH {LINES},
  cells AS (
    SELECT year, CASE WHEN grouping(dest) = 1 THEN 'all destinations' ELSE dest END AS dest, origin, sum(n) AS n
    FROM lines GROUP BY GROUPING SETS ((year, dest, origin), (year, origin)))"""


@check("A3", "O54", "O74", sql=YEARLY_LONG + " SELECT year, dest, origin, n FROM cells WHERE n > 0")
def yearly_returns_long(spark, folder):
    return Q.yearly_returns_long(T.movement_lines(spark, folder)).select("year", "dest", "origin", "n")


YEARLY = YEARLY_LONG + f" SELECT year, dest, {pivot_sql('origin', 'n', NATIONS)} FROM cells WHERE n > 0 GROUP BY year, dest"


@check("A3", "O18", "O67", "O73", "O75", sql=YEARLY)
def yearly_returns(spark, folder):
    """Columns in the order of their totals, taken from the staged long cube."""
    return Q.yearly_returns(T.movement_lines(spark, folder))


@check("A3", sql=YEARLY)
def yearly_returns_fixed_columns(spark, folder):
    """Columns given up front: a single job over the tables."""
    return Q.yearly_returns(T.movement_lines(spark, folder), origins=NATIONS)


# An order without lines keeps its type but has no date, as in a full join on the id.
TYPES = f"""WITH {MOVES},
  ops AS (
    SELECT coalesce(o_orderkey, op_id) AS op_id, op_date, o_orderpriority AS op_type, n
    FROM moves FULL JOIN orders ON op_id = o_orderkey),
  per_op AS (SELECT op_id, op_date, op_type, coalesce(sum(n), 0) AS n FROM ops GROUP BY ALL),
  cube AS (
    SELECT CAST(year(op_date) AS INTEGER) AS year, op_type, sum(n) AS people, count(*) AS operations
    FROM per_op GROUP BY ALL)"""


def _operations(spark, folder):
    # order ids are never NULL, so the plain key keeps the movements' partitioning
    totals = Q.operation_totals(T.movements(spark, folder, origin=False))
    return Q.operations(T.operation_types(spark, folder), totals, null_safe=False)


@check("A4", "O39", "O50", "O48", sql=TYPES + " SELECT year, op_type, people, operations FROM cube")
def yearly_types_long(spark, folder):
    return Q.yearly_types_long(_operations(spark, folder)).drop("known_people")


@check(
    "A4", "O72", "O78", "O33",
    sql=TYPES + f""" SELECT year, key, {pivot_sql('op_type', 'value', PRIORITIES)} FROM (
      SELECT year, op_type, 'Number of deported people' AS key, CAST(people AS DOUBLE) AS value FROM cube
      UNION ALL SELECT year, op_type, 'Number of operations', CAST(operations AS DOUBLE) FROM cube) GROUP BY year, key""",
)
def yearly_types(spark, folder):
    return Q.yearly_types(_operations(spark, folder))


CONTRIBUTIONS = f"""WITH {LINES},
  cells AS (SELECT year, dest AS payee, sum(amount) AS amount FROM lines GROUP BY ALL)"""


@check("A6", "O46", sql=CONTRIBUTIONS + " SELECT year, payee, CAST(amount AS DOUBLE) AS amount FROM cells")
def yearly_contributions_long(spark, folder):
    long = Q.yearly_contributions_long(T.payments(spark, folder))
    return long.withColumn("amount", F.col("amount").cast("double"))


@check(
    "A6", "O76", "O19", "O20",
    sql=CONTRIBUTIONS + f""",
  grid AS (
    SELECT year, payee AS key, amount, 'all EU member states' AS payee FROM cells
    UNION ALL SELECT year, payee, amount, payee FROM cells
    UNION ALL SELECT y.year, p.payee, 0, p.payee FROM (SELECT DISTINCT year FROM cells) y, (SELECT n_name AS payee FROM nation) p)
  SELECT year, payee, {pivot_sql('key', 'CAST(amount AS DECIMAL(38,4))', NATIONS)} FROM grid GROUP BY year, payee""".replace(
        "coalesce(sum(", "CAST(coalesce(sum("
    ).replace(" END), 0)", " END), 0) AS DOUBLE)"),
)
def yearly_contributions(spark, folder):
    """Columns given up front, so that a nation without payments has one too."""
    return Q.yearly_contributions(T.payments(spark, folder), payees=NATIONS)


@check("A7", "O41", "O61", "O62", sql=f"WITH {COSTS} SELECT op_id, dest, op_date, n, CAST(amount AS DOUBLE) AS amount, CAST(n_ops AS BIGINT) AS n_ops FROM costs")
def operation_costs(spark, folder):
    return _costs(spark, folder).withColumn("amount", F.col("amount").cast("double"))


def _costs(spark, folder):
    return C.operation_costs(T.movements(spark, folder, origin=False), T.operation_payments(spark, folder), null_safe=False)


RECORDS = f"""WITH {MOVES},
  single AS (SELECT op_id, min(dest) AS dest, sum(n) AS n FROM moves GROUP BY op_id HAVING count(*) = 1),
  pay AS (SELECT l_orderkey AS op_id, {AMOUNT} AS amount FROM lineitem WHERE l_orderkey % 7 <> 0),
  every AS (SELECT s.op_id, dest, n, coalesce(amount, 0) AS amount FROM single s LEFT JOIN pay ON s.op_id = pay.op_id)"""


def _costs_by_record(spark, folder):
    payments = T.ledger_lines(spark, folder).where(F.col("op_id") % 7 != 0)
    return C.operation_costs_by_record(T.movements(spark, folder, origin=False), payments, null_safe=False)


@check("A7", "O35", "O81", sql=RECORDS + """ SELECT op_id, dest, sum(n) AS n, CAST(sum(amount) AS DOUBLE) AS amount, count(*) AS payments
    FROM every GROUP BY op_id, dest""")
def operation_costs_by_record(spark, folder):
    """The older rule; every seventh operation has no payment at all."""
    out = _costs_by_record(spark, folder)
    return out.select("op_id", "dest", "n", F.col("amount").cast("double").alias("amount"), "payments")


@check("A8", sql=RECORDS + """,
  ranked AS (SELECT CASE WHEN grouping(dest) = 1 THEN 'average across all destinations' ELSE dest END AS dest, sum(n) AS n,
             CAST(sum(amount) AS DOUBLE) AS amount FROM every GROUP BY ROLLUP (dest))
  SELECT r.dest, n, amount, amount / n AS per_person,
         CASE WHEN n_nationkey IS NULL THEN '' ELSE 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') END AS iso
  FROM ranked r LEFT JOIN nation ON r.dest = n_name WHERE n >= 10 ORDER BY per_person DESC, r.dest LIMIT 26""")
def cost_per_person_older_rule(spark, folder):
    label = "average across all destinations"
    ranking = C.cost_per_person(
        _costs_by_record(spark, folder), T.countries(spark, folder), label=label, label_iso="", synonyms=RANKING_SYNONYMS_2021
    )
    return ranking.withColumn("amount", F.col("amount").cast("double"))


RANKING = f"""WITH {COSTS},
  ranked AS (
    SELECT CASE WHEN grouping(dest) = 1 THEN 'average' ELSE dest END AS dest, sum(n) AS n,
           CAST(sum(amount) AS DOUBLE) AS amount, CAST(sum(n_ops) AS BIGINT) AS n_ops
    FROM costs GROUP BY ROLLUP (dest))
  SELECT r.dest, n, amount, n_ops, amount / n AS per_person,
         CASE WHEN n_nationkey IS NOT NULL THEN 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') END AS iso
  FROM ranked r LEFT JOIN nation ON r.dest = n_name WHERE n >= 10
  ORDER BY per_person DESC, r.dest"""


@check("A8", "O53", "O55", "O56", "O70", "O37", sql=RANKING + " LIMIT 26")
def cost_per_person(spark, folder):
    out = C.cost_per_person(_costs(spark, folder), T.countries(spark, folder))
    return out.withColumn("amount", F.col("amount").cast("double"))


@check("A9", "O52", "O96", sql=f"""WITH {COSTS}
  SELECT year, CAST(sum(amount) AS DOUBLE) AS eur_total, sum(n) AS number_returned,
         round_even(CAST(sum(amount) AS DOUBLE) / sum(n), 2) AS avg_eur_per_person FROM costs GROUP BY year""")
def average_by_year(spark, folder):
    return C.average_by_year(_costs(spark, folder))


@check("A10", sql=f"""WITH {COSTS}
  SELECT year, dest AS destination, CAST(sum(amount) AS DOUBLE) AS eur_total, sum(n) AS number_returned,
         round_even(CAST(sum(amount) AS DOUBLE) / sum(n), 2) AS avg_eur_per_person FROM costs GROUP BY year, dest""")
def average_by_year_and_destination(spark, folder):
    return C.average_by_year_and_destination(_costs(spark, folder))


LEFT_OUT = f"""WITH {COSTS}
  SELECT year, CAST(coalesce(sum(CASE WHEN n_dest %s THEN 1 END), 0) AS BIGINT) AS doubles, count(*) AS total,
         round_even(coalesce(sum(CASE WHEN n_dest %s THEN 1 END), 0) / CAST(count(*) AS DOUBLE), 2) AS not_counted
  FROM sized GROUP BY year"""


@check("A11", "O49", "O57", sql=LEFT_OUT % ("= 2", "= 2"))
def share_left_out(spark, folder):
    return C.share_left_out(T.movements(spark, folder, origin=False))


@check("A11", sql=LEFT_OUT % ("> 1", "> 1"))
def share_left_out_any(spark, folder):
    return C.share_left_out(T.movements(spark, folder, origin=False), exactly=None)


@check("O10", "O7", sql=f"""WITH {COSTS}
  SELECT year, CAST(sum(amount) AS DOUBLE) AS eur_total, sum(n) AS number_returned,
         round_even(CAST(sum(amount) AS DOUBLE) / sum(n), 2) AS avg_eur_per_person FROM costs GROUP BY year""")
def averages_from_published_costs(spark, folder):
    """A second job that reads the cost table another job has written."""
    path = write_cube(_costs(spark, folder), new_folder(spark, "operation-costs"))
    return C.average_by_year(read_cube(spark, path))


STACK = TYPES + """,
  cells AS (SELECT year, op_type AS series, people AS value FROM cube),
  grid AS (
    SELECT y.year, s.series, s.series_rank, coalesce(c.value, 0) AS value
    FROM (SELECT DISTINCT year FROM cells) y
    CROSS JOIN (SELECT DISTINCT series, CAST(substr(series, 1, 1) AS INTEGER) AS series_rank FROM cells) s
    LEFT JOIN cells c ON c.series = s.series AND c.year IS NOT DISTINCT FROM y.year),
  bounds AS (
    SELECT year, series, series_rank,
           sum(value) OVER (PARTITION BY year ORDER BY series_rank) - value AS y0,
           sum(value) OVER (PARTITION BY year ORDER BY series_rank) AS y1,
           sum(value) OVER (PARTITION BY year) AS total
    FROM grid)"""


def _slice(spark, folder):
    cube = Q.yearly_types(_operations(spark, folder), PRIORITIES)
    return Q.cube_slice(cube, F.col("key") == Q.PEOPLE, "year", PRIORITIES)


@check("A16", "O32", "O23", "O99", sql=STACK + " SELECT year, total, series_rank, series, y0, y1 FROM bounds")
def cube_slice(spark, folder):
    return _slice(spark, folder)


@check("A16", "O59", sql=STACK + " SELECT max(total) AS axis_top FROM bounds")
def cube_axis_top(spark, folder):
    return Q.axis_top(_slice(spark, folder))


@check("A16", "O58", sql=f"WITH {LINES} SELECT DISTINCT dest FROM lines")
def cube_options(spark, folder):
    return Q.options(T.movement_lines(spark, folder), "dest")


@check("A16", "O9", sql=YEARLY_LONG + """
  SELECT year, sum(n) AS total FROM cells WHERE dest = 'all destinations' GROUP BY year""")
def published_cube_totals(spark, folder):
    """A consumer reads the written cube and totals its columns per row."""
    path = write_cube(Q.yearly_returns(T.movement_lines(spark, folder), NATIONS), new_folder(spark, "yearly-returns"))
    slice_ = Q.cube_slice(read_cube(spark, path), F.col("dest") == Q.ALL_DESTINATIONS, "year", NATIONS)
    return slice_.groupBy("year").agg(F.max("total").alias("total"))


# Origins and destinations share names here; the prefixes keep the two sides apart.
GRAPH = TOP + """,
  links AS (
    SELECT 'from ' || origin AS source, 'to ' || dest AS target, n AS value,
           CAST(rank_origin * 2147483648 + rank_dest AS BIGINT) AS position FROM ranked),
  ends AS (SELECT source AS name, position * 2 AS used FROM links UNION ALL SELECT target, position * 2 + 1 FROM links),
  nodes AS (SELECT name, row_number() OVER (ORDER BY min(used)) - 1 AS node FROM ends GROUP BY name),
  flows AS (
    SELECT name, sum(o) AS o, sum(i) AS i FROM (
      SELECT source AS name, value AS o, 0 AS i FROM links UNION ALL SELECT target, 0, value FROM links) GROUP BY name),
  indexed AS (
    SELECT position, a.node AS source_node, b.node AS target_node, value
    FROM links JOIN nodes a ON source = a.name JOIN nodes b ON target = b.name)"""


def _links(spark, folder):
    ranked = Q.ranked_top_routes(Q.route_matrix(T.movement_lines(spark, folder)))
    links = G.links_from_routes(ranked)
    return links.withColumns({"source": F.concat(F.lit("from "), "source"), "target": F.concat(F.lit("to "), "target")})


@check("A17", "O100", sql=GRAPH + " SELECT name, node FROM nodes")
def flow_nodes(spark, folder):
    return G.nodes(_links(spark, folder))


@check("A17", "O101", sql=GRAPH + " SELECT position, source_node, target_node, value FROM indexed")
def flow_links(spark, folder):
    links = staged(_links(spark, folder), "links")
    return G.indexed_links(links, G.nodes(links))


@check("A17", "O102", sql=GRAPH + " SELECT name, greatest(o, i) AS value FROM flows")
def flow_throughput(spark, folder):
    return G.throughput(_links(spark, folder))


@check("A17", "O103", sql=GRAPH + " SELECT name, CASE WHEN name LIKE 'to %' THEN 1 ELSE 0 END AS level FROM nodes")
def flow_levels(spark, folder):
    return G.node_levels(_links(spark, folder))


@check("A17", "O64", sql=GRAPH + """
  SELECT position, source_node, target_node, value,
         sum(value) OVER (PARTITION BY source_node ORDER BY target_node) - value AS source_offset,
         sum(value) OVER (PARTITION BY target_node ORDER BY source_node) - value AS target_offset
  FROM indexed""")
def flow_offsets(spark, folder):
    links = staged(_links(spark, folder), "links")
    return G.link_offsets(G.indexed_links(links, G.nodes(links)))


@check("A17", sql=GRAPH + """
  SELECT nodes.name, nodes.node, greatest(o, i) AS value, CASE WHEN nodes.name LIKE 'to %' THEN 1 ELSE 0 END AS level
  FROM nodes JOIN flows USING (name)""")
def flow_graph_nodes(spark, folder):
    return G.flow_graph(_links(spark, folder))[0]


@check("A17", "O104", sql=GRAPH + """,
  sides AS (
    SELECT source_node AS node, 'out' AS side, position, target_node AS other, value FROM indexed
    UNION ALL SELECT target_node, 'in', position, source_node, value FROM indexed)
  SELECT node, side, 0 AS part, count(*) AS n_links, sum(value) AS value,
         string_agg(CAST(other AS VARCHAR), ',' ORDER BY position) AS others
  FROM sides GROUP BY node, side""")
def flow_adjacency(spark, folder):
    links = staged(_links(spark, folder), "links")
    lists = G.adjacency(G.indexed_links(links, G.nodes(links)))
    return lists.select(
        "node",
        "side",
        "part",
        F.size("links").cast("long").alias("n_links"),
        F.aggregate("links.value", F.lit(0.0), lambda a, x: a + x).alias("value"),
        F.array_join(F.transform("links.other", lambda x: x.cast("string")), ",").alias("others"),
    )


SIZES = COSTS + """,
  yearly AS (SELECT year, dest FROM moves GROUP BY ALL),
  types AS (SELECT DISTINCT year(op_date) AS year FROM moves FULL JOIN orders ON op_id = o_orderkey),
  sums AS (SELECT dest, sum(n) AS n FROM costs GROUP BY 1 HAVING sum(n) >= 10)
  SELECT 'N_RETURNEES_MSNAME_DEST_new' AS cube, count(*) AS n_rows FROM (SELECT DISTINCT dest, origin FROM moves)
  UNION ALL SELECT 'N_RETURNEES_MSNAME_DEST_ROUTES_MIN_15_new', count(*) FROM (SELECT DISTINCT dest, origin FROM moves
    WHERE dest IN (SELECT dest FROM moves GROUP BY 1 ORDER BY sum(n) DESC, 1 LIMIT 15)
      AND origin IN (SELECT origin FROM moves GROUP BY 1 ORDER BY sum(n) DESC, 1 LIMIT 15))
  UNION ALL SELECT 'N_RETURNEES_YEARS_MSNAME_new', count(*) + count(DISTINCT year) FROM yearly
  UNION ALL SELECT 'OPTYPE_YEAR_new', 2 * count(*) FROM types
  UNION ALL SELECT 'FX_CONTRIB_YEARS_MSNAME_new', count(DISTINCT year) * (1 + count(DISTINCT dest)) FROM yearly
  UNION ALL SELECT 'CONTRIB_PP_BY_DEST_new', least(26, count(*) + 1) FROM sums
  UNION ALL SELECT 'average_per_year', count(DISTINCT year) FROM costs
  UNION ALL SELECT 'average_per_year_dest', count(DISTINCT (year, dest)) FROM costs
  UNION ALL SELECT 'averages_omitted', count(DISTINCT year) FROM moves"""


@check("O7", "O10", sql=f"WITH {SIZES}")
def published_cubes(spark, folder):
    """The whole publishing job; the result counts the rows of every written cube."""
    paths = publish(
        T.movements(spark, folder),
        T.operation_types(spark, folder),
        T.ledger(spark, folder),
        T.countries(spark, folder),
        new_folder(spark, "published"),
        null_safe=False,
    )
    counts = [read_cube(spark, p).agg(F.lit(name).alias("cube"), F.count(F.lit(1)).alias("n_rows")) for name, p in paths.items()]
    return union_by_name(*counts)


@check("A4", "O81", sql=f"""WITH {MOVES}, per_op AS (
      SELECT op_id, op_date, CASE WHEN op_id % 6 <> 0 THEN op_type ELSE 'unknown' END AS op_type, sum(n) AS n FROM moves GROUP BY ALL)
    SELECT CAST(year(op_date) AS INTEGER) AS year, op_type, sum(n) AS people, count(*) AS operations FROM per_op GROUP BY ALL""")
def yearly_types_older_rule(spark, folder):
    """Types as part of the movements, missing ones unknown."""
    moves = T.movements(spark, folder, origin=False)
    gappy = moves.withColumn("op_type", F.when(F.col("op_id") % 6 != 0, F.col("op_type")))
    return Q.yearly_types_long(gappy.withColumn("op_type", operation_type_2022("op_type"))).drop("known_people")


@check("A6", "O24", "O25", sql=CONTRIBUTIONS.replace("FROM lines", "FROM lines WHERE dest <> 'NATION_9' AND amount > 0")
       + " SELECT year, payee, CAST(amount AS DOUBLE) AS amount FROM cells")
def yearly_contributions_older_rule(spark, folder):
    payments = T.payments(spark, folder).withColumn("payee", F.when(F.col("payee") != "NATION_9", F.col("payee")))
    long = Q.yearly_contributions_long(Q.paid_contributions(payments))
    return long.withColumn("amount", F.col("amount").cast("double"))
