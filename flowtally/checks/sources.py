"""Scans and sinks. Tables are written once in the wanted layout and read back whole."""

from __future__ import annotations

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from ..operators.joins import join_on
from ..operators.matching import unmatched_names
from ..plans import cubes as Q
from ..session import new_folder
from ..sources import files as S
from ..sources import headers as H
from ..sources import infer as I
from ..sources import tables as T
from ..sources import workbook as W
from .registry import LINES, check, delivered

def _csv(df, spark, label, header=True):
    path = new_folder(spark, label)
    df.write.option("header", header).csv(path)
    return path


@check("O1", sql="""SELECT o_orderkey, o_orderstatus, CAST(o_totalprice AS DOUBLE) AS o_totalprice,
    CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders""")
def scan_typed(spark, folder):
    orders = T.table(spark, folder, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date")).drop("o_custkey")
    schema = "o_orderkey bigint, o_orderstatus string, o_totalprice double, o_orderdate date, o_orderpriority string"
    return S.read_typed(spark, _csv(orders, spark, "orders"), schema)


CUSTOMER_TYPES = {"c_custkey": "bigint", "c_nationkey": "int", "c_acctbal": "decimal(12,2)"}
CUSTOMER_COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def _customer_text(spark, folder):
    """Customers as text, every 11th balance written as a dash."""
    dash = F.col("c_custkey") % 11 == 0
    balance = F.when(dash, F.lit("-")).otherwise(F.col("c_acctbal").cast("decimal(12,2)").cast("string"))
    customers = T.table(spark, folder, "customer").withColumn("c_acctbal", balance).select(*CUSTOMER_COLUMNS)
    return S.read_rows(spark, _csv(customers, spark, "customers"), CUSTOMER_COLUMNS)


@check("O2", "O92", sql="""SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_custkey % 11 <> 0 THEN c_acctbal END AS c_acctbal,
    c_mktsegment FROM customer""")
def scan_declared_types(spark, folder):
    out = S.typed(_customer_text(spark, folder), CUSTOMER_TYPES).select(*CUSTOMER_COLUMNS)
    return out.withColumn("c_acctbal", F.col("c_acctbal").cast("double"))


@check("O2", sql="SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, '-' AS c_acctbal FROM customer WHERE c_custkey % 11 = 0")
def scan_quarantine(spark, folder):
    return S.unfit_rows(_customer_text(spark, folder), CUSTOMER_TYPES).select("c_custkey", "c_acctbal")


SHEETS = {2001: 12, 2000: 13, 1999: 14, 1998: 15, 1997: 16, 1996: 17, 1995: 18}


@check("O3", "O5", sql="""SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year,
    CAST(2013 - year(o_orderdate) AS INTEGER) AS sheet, o_orderpriority FROM orders""")
def scan_sheets(spark, folder):
    orders = T.table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", F.year("o_orderdate").alias("year"))
    path = new_folder(spark, "sheets")
    placed = orders.withColumn("sheet", S.sheet_for_year(SHEETS)).drop("year")
    placed.write.partitionBy("sheet").option("header", True).csv(path)
    rows = S.read_sheets(spark, path, ["o_orderkey", "o_orderpriority"], SHEETS)
    return rows.select(F.col("o_orderkey").try_cast("bigint").alias("o_orderkey"), "year", "sheet", "o_orderpriority")


@check("O4", sql="SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def scan_headerless(spark, folder):
    path = _csv(T.table(spark, folder, "supplier").drop("s_acctbal"), spark, "suppliers", header=False)
    rows = S.read_rows(spark, path, ["s_suppkey", "s_name", "s_nationkey"], header=False)
    return S.typed(rows, {"s_suppkey": "bigint", "s_nationkey": "int"}).select("s_suppkey", "s_name", "s_nationkey")


@check("O5", "O71", "O30", sql="""SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderkey, o_totalprice,
    CASE WHEN year(o_orderdate) < 1998 THEN o_orderstatus END AS o_orderstatus FROM orders""")
def scan_yearly_deliveries(spark, folder):
    """Two layouts of yearly files, one without the status column, under one another."""
    orders = T.table(spark, folder, "orders").withColumn("delivery", F.year("o_orderdate"))
    early, late = new_folder(spark, "early"), new_folder(spark, "late")
    orders.where(F.col("delivery") < 1998).select("o_orderkey", "o_totalprice", "o_orderstatus", "delivery").write.partitionBy(
        "delivery"
    ).option("header", True).csv(early)
    orders.where(F.col("delivery") >= 1998).select("o_orderkey", "o_totalprice", "delivery").write.partitionBy(
        "delivery"
    ).option("header", True).csv(late)
    first = S.read_rows(spark, f"{early}/*", ["o_orderkey", "o_totalprice", "o_orderstatus"])
    second = S.read_rows(spark, f"{late}/*", ["o_orderkey", "o_totalprice"])
    both = first.unionByName(second, allowMissingColumns=True).withColumn("year", S.year_from_path(r"delivery=(\d{4})/"))
    return S.typed(both, {"o_orderkey": "bigint", "o_totalprice": "double"}).select(
        "year", "o_orderkey", "o_totalprice", "o_orderstatus"
    )


@check("O6", sql="""SELECT n_name, count(*) AS customers, 2 AS tables FROM customer JOIN nation ON c_nationkey = n_nationkey
    GROUP BY n_name""")
def load_catalog(spark, folder):
    """A folder of tables becomes views; the published one is left alone."""
    base = new_folder(spark, "catalog")
    T.table(spark, folder, "customer").select("c_custkey", "c_nationkey").write.option("header", True).csv(f"{base}/clients.csv")
    nations = T.table(spark, folder, "nation").select("n_nationkey", "n_name")
    nations.write.option("header", True).csv(f"{base}/places.csv")
    nations.write.option("header", True).csv(f"{base}/places_new.csv")
    loaded = S.load_catalog(spark, base)
    return spark.sql(
        f"""SELECT n_name, count(*) AS customers, {len(loaded)} AS tables
            FROM clients JOIN places ON c_nationkey = n_nationkey GROUP BY n_name"""
    )


ROUTES = f"WITH {LINES} SELECT dest, origin, sum(n) AS n FROM lines GROUP BY dest, origin"


@check("O7", sql=ROUTES)
def sink_csv(spark, folder):
    path = S.write_cube(Q.route_matrix(T.movement_lines(spark, folder)), new_folder(spark, "routes-csv"), "csv")
    return S.read_typed(spark, path, "dest string, origin string, n double")


@check("O7", "O9", sql=ROUTES)
def sink_parquet(spark, folder):
    path = S.write_cube(Q.route_matrix(T.movement_lines(spark, folder)), new_folder(spark, "routes"))
    return S.read_cube(spark, path)


@check("O8", "O36", sql="""SELECT c_custkey, 'N' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS iso, n_name AS country
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def country_dimension(spark, folder):
    nations = T.table(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("name"))
    dimension = nations.join(T.countries(spark, folder), "name").withColumnRenamed("name", "country")
    customers = T.table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    return join_on(customers, dimension, {"c_nationkey": "n_nationkey"}).select("c_custkey", "iso", "country")


ORDER_HEADERS = {"op_id": ["Order Key"], "total": ["Total Price"], "status": [], "priority": ["Order Priority"]}
ORDER_TYPES = {"op_id": "bigint", "total": "double"}


@delivered
def _deliveries_by_header(spark, folder):
    """Three layouts in one folder: another order of columns, and one with a column nobody knows."""
    base = new_folder(spark, "deliveries")
    orders = T.table(spark, folder, "orders").withColumn("year", F.year("o_orderdate"))
    key, total, status, priority = (F.col(c) for c in ("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority"))
    early = orders.where("year < 1994").select(key.alias("Order Key"), total.alias("Total Price"), status.alias("Status"), priority.alias("Order Priority"))
    middle = orders.where("year IN (1994, 1995)").select(priority.alias("PRIORITY "), status.alias("status"), key.alias("order key"), total.alias("total"))
    late = orders.where("year > 1995").select(key.alias("Order Key"), status.alias("Status"), F.lit("none").alias("Clerk remark"))
    for name, delivery in (("early", early), ("middle", middle), ("late", late)):
        delivery.write.option("header", True).option("ignoreTrailingWhiteSpace", False).csv(f"{base}/{name}")
    return base


def _by_header(spark, folder):
    return H.scan_by_header(spark, f"{_deliveries_by_header(spark, folder)}/*", ORDER_HEADERS)


@check("O5", "O11", "O2", sql="""SELECT o_orderkey AS op_id, o_totalprice AS total, o_orderstatus AS status, o_orderpriority AS priority
    FROM orders WHERE year(o_orderdate) < 1996""")
def scan_by_header(spark, folder):
    """Two orders of columns, found by name."""
    return S.typed(_by_header(spark, folder).rows, ORDER_TYPES).select(*ORDER_HEADERS)


@check("O5", "O2", sql="""SELECT 'unknown columns: Clerk remark' AS reason, o_orderkey || ',' || o_orderstatus || ',none' AS line
    FROM orders WHERE year(o_orderdate) > 1995""")
def scan_by_header_quarantine(spark, folder):
    """Lines of deliveries whose header does not fit, their headers left aside."""
    lines = _by_header(spark, folder).quarantine
    return lines.where(~F.startswith("line", F.lit("Order Key"))).select("reason", "line")


@delivered
def _order_text(spark, folder):
    orders = T.table(spark, folder, "orders").withColumns(
        {
            "o_totalprice": F.col("o_totalprice").cast("decimal(14,2)"),
            "o_orderdate": F.date_format("o_orderdate", "dd/MM/yyyy"),
            "o_open": F.col("o_orderstatus") == "O",
            "o_code": F.lpad(F.col("o_custkey").cast("string"), 9, "0"),
        }
    )
    return _csv(orders.select(*ORDER_TEXT), spark, "orders-text")


ORDER_TEXT = ["o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority", "o_open", "o_code"]


@check("O1", "O92", "O93", sql="""SELECT o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority, o_orderstatus = 'O' AS o_open,
    lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS o_code FROM orders""")
def scan_inferred(spark, folder):
    """Types found in the rows: a key, an amount, a date, a flag, text, and a code that stays text."""
    rows = S.read_rows(spark, _order_text(spark, folder), ORDER_TEXT)
    return I.with_inferred_types(rows, ORDER_TEXT).select(*ORDER_TEXT).withColumn("o_totalprice", F.col("o_totalprice").cast("double"))


@check("O1", sql="""SELECT * FROM (VALUES (0, 'o_orderkey', 'bigint', NULL), (2, 'o_orderdate', 'date', 'dd/MM/yyyy'), (3, 'o_orderpriority', 'string', NULL),
    (4, 'o_open', 'boolean', NULL), (5, 'o_code', 'string', NULL)) t(position, "column", type, notation)
  UNION ALL SELECT 1, 'o_totalprice', 'decimal(' || (max(length(CAST(CAST(trunc(abs(o_totalprice)) AS BIGINT) AS VARCHAR))) + 2) || ',2)', NULL FROM orders""")
def inferred_schema(spark, folder):
    rows = S.read_rows(spark, _order_text(spark, folder), ORDER_TEXT)
    return I.inferred_schema(rows, ORDER_TEXT)


# every second customer's country is misspelt: accents and blanks, letters swapped, or no country at all
PLACE = """CASE c_custkey % 8 WHEN 1 THEN 'Nâtión ' || c_nationkey WHEN 3 THEN 'NATOIN_' || c_nationkey
  WHEN 5 THEN 'XY ' || (c_custkey % 5) WHEN 7 THEN NULL ELSE n_name END"""


@check("O37", "O31", sql=f"""
  WITH places AS (SELECT {PLACE} AS name FROM customer JOIN nation ON c_nationkey = n_nationkey),
  missing AS (SELECT name, count(*) AS n_rows FROM places WHERE name IS NOT NULL AND name NOT IN (SELECT n_name FROM nation) GROUP BY name),
  plain AS (
    SELECT name, proposal, trim(regexp_replace(lower(strip_accents(name)), '[^a-z0-9]+', ' ', 'g')) AS a,
           trim(regexp_replace(lower(strip_accents(proposal)), '[^a-z0-9]+', ' ', 'g')) AS b
    FROM missing CROSS JOIN (SELECT n_name AS proposal FROM nation)),
  sets AS (
    SELECT *, list_distinct([substr(' ' || a || ' ', k, 3) FOR k IN range(1, length(a) + 1)]) AS g,
           list_distinct([substr(' ' || b || ' ', k, 3) FOR k IN range(1, length(b) + 1)]) AS h FROM plain),
  pairs AS (
    SELECT name, proposal, 2.0 * len(list_intersect(g, h)) / (len(g) + len(h)) AS likeness, CAST(levenshtein(a, b) AS INTEGER) AS distance
    FROM sets),
  ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY name ORDER BY likeness DESC, distance, proposal) AS INTEGER) AS rank FROM pairs WHERE likeness >= 0.5)
  SELECT m.name, n_rows, rank, proposal, CAST(likeness AS DOUBLE) AS likeness, distance
  FROM missing m LEFT JOIN (SELECT * FROM ranked WHERE rank <= 3) r ON m.name = r.name""")
def unmatched_places(spark, folder):
    """Countries that the dimension lacks, with proposals; the SQL compares all pairs."""
    nations = T.table(spark, folder, "nation")
    customers = T.table(spark, folder, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return unmatched_names(customers.select(F.expr(PLACE).alias("name")), "name", nations, "n_name")


BOOK_COLUMNS = ["o_orderkey", "o_orderpriority", "o_totalprice"]


@delivered
def _workbooks(spark, folder):
    """A workbook for each partition of the orders, with one sheet of open orders and one of the others."""
    base = new_folder(spark, "workbooks")
    orders = T.table(spark, folder, "orders").repartition(4).select(*BOOK_COLUMNS, (F.col("o_orderstatus") == "O").alias("open"))

    def write(batches):
        sheets = {True: [BOOK_COLUMNS], False: [BOOK_COLUMNS]}
        for batch in batches:
            for *cells, is_open in zip(*[c.to_pylist() for c in batch.columns]):
                sheets[is_open].append(cells)
        path = f"{base}/book-{TaskContext.get().partitionId()}.xlsx"
        W.write_workbook(path, {"open": sheets[True], "other": sheets[False]})
        yield pa.RecordBatch.from_pydict({"path": [path]})

    return [r["path"] for r in orders.mapInArrow(write, "path string").collect()]


@check("O3", sql="""SELECT o_orderkey, o_orderpriority, o_totalprice, CASE o_orderstatus WHEN 'O' THEN 1 ELSE 2 END AS sheet,
    CASE o_orderstatus WHEN 'O' THEN 2001 ELSE 2002 END AS year FROM orders""")
def scan_workbooks(spark, folder):
    """Both sheets of every workbook, one by number and one by name."""
    listed = [s for path in _workbooks(spark, folder) for s in ((path, 1, 2001), (path, "other", 2002))]
    rows = W.read_workbooks(spark, listed, BOOK_COLUMNS)
    return S.typed(rows, {"o_orderkey": "bigint", "o_totalprice": "double"}).select(*BOOK_COLUMNS, "sheet", "year")
