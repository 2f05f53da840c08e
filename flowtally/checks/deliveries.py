"""Raw deliveries worked up to tidy tables.

The tables are first written out the way deliveries arrive (merged cells, subtotals,
repeated headers, currency text, several layouts); the plans must bring the original
values back. The SQL states those values directly from the tables.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.reshape import union_by_name
from ..plans import cubes as Q
from ..plans import deliveries as D
from ..plans import ledger as L
from ..plans.older import combined_movements
from ..session import new_folder, staged
from ..sources import tables as T
from ..sources.files import read_rows
from .registry import AMOUNT, MOVES, check, delivered

ID_LENGTH = 15


def _id(key: Column) -> Column:
    return F.concat(F.lit("RO-"), F.lpad(key.cast("string"), 12, "0"))


def _day(c: str, form: str = "dd/MM/yyyy") -> Column:
    return F.date_format(c, form)


def _number(c: str) -> Column:
    """Number within a name such as NATION_7."""
    return F.regexp_extract(c, r"(\d+)$", 1).cast("long")


def _with_first(rows: DataFrame) -> DataFrame:
    """The smallest `k` of each operation on its rows, which lie together after their join by operation.

    At most one row per place in each of these windows.
    """
    return rows.withColumn("first", F.min("k").over(Window.partitionBy("op_id")))


# --- returns with continuation rows -------------------------------------------------

@delivered
def _raw_returns(spark, folder) -> DataFrame:
    """Id and date only on an operation's first row, subtotals after it, headers between pages."""
    moves = T.movements(spark, folder).withColumn("k", _number("dest") + 1)
    moves = staged(_with_first(moves), "moves")
    head = F.col("k") == F.col("first")
    shifted, merged = F.col("op_id") % 40 == 7, F.col("op_id") % 9 == 0
    tail = F.concat(_day("op_date"), F.lit(" "), F.left("op_type", F.lit(3)))
    dest = (
        F.when(F.col("dest") == "NATION_1", F.lit("Kosovo*"))
        .when(F.col("dest") == "NATION_2", F.lit("The Gambia"))
        .otherwise(F.col("dest"))
    )
    count = F.col("n").cast("int").cast("string")
    none = F.lit(None).cast("string")
    source = F.concat(F.lit("returns-"), F.year("op_date").cast("string")).alias("src_file")

    def at(k) -> Column:
        return (F.col("op_id") * 64 + k).alias("src_row")

    rows = moves.select(
        F.when(head & merged, F.concat(_id(F.col("op_id")), F.lit(" "), tail)).when(head, _id(F.col("op_id"))).alias("op_id"),
        F.when(head & ~merged, tail).alias("date_type"),
        F.col("origin"),
        dest.alias("dest"),
        F.when(~shifted, count).alias("n"),
        F.when(shifted, count).alias("overflow"),
        source,
        at(F.col("k")),
    )
    whole = moves.groupBy("op_id", "op_date").agg(F.sum("n").cast("int").cast("string").alias("n"))
    subtotals = whole.select(
        F.concat(_id(F.col("op_id")), F.lit(" Total")).alias("op_id"), none.alias("origin"), F.col("n"), source, at(60)
    )
    headers = whole.where(F.col("op_id") % 50 == 0).select(
        F.lit(D.ID_HEADER).alias("op_id"),
        F.lit("Date of Departure type of operation").alias("date_type"),
        F.lit(D.STATE_HEADER).alias("origin"),
        F.lit("Destination(s)").alias("dest"),
        source,
        at(0),
    )
    # deliveries are files: write them before they are read several times
    return staged(union_by_name(rows, subtotals, headers), "raw-returns")


TIDY_ID = "'RO-' || lpad(CAST(op_id AS VARCHAR), 12, '0')"


@check("A13", "O26", "O27", "O43", "O44", sql=f"""WITH {MOVES}
    SELECT {TIDY_ID} AS op_id, op_date, substr(op_type, 1, 3) AS op_type, origin,
           CASE dest WHEN 'NATION_1' THEN 'Kosovo' WHEN 'NATION_2' THEN 'Gambia' ELSE dest END AS dest, n
    FROM moves WHERE op_id % 40 <> 7""")
def tidy_returns(spark, folder):
    return D.tidy_returns(_raw_returns(spark, folder), ["src_row"], ID_LENGTH)


@check("A13", sql=f"WITH {MOVES} SELECT op_id % 64 AS bucket, count(*) AS lost, sum(n) AS people FROM moves WHERE op_id % 40 = 7 GROUP BY 1")
def shifted_returns(spark, folder):
    """Rows whose count lies in a field beyond the header, by a digest of their place."""
    lost = D.shifted_returns(_raw_returns(spark, folder))
    bucket = (F.shiftright("src_row", 6) % 64).alias("bucket")
    return lost.groupBy(bucket).agg(F.count(F.lit(1)).alias("lost"), F.sum(F.col("overflow").cast("double")).alias("people"))


@check("A13", sql=f"""WITH {MOVES} SELECT {TIDY_ID} AS op_id, CAST(NULL AS DOUBLE) AS summed, sum(n) AS stated
    FROM moves WHERE op_id % 40 = 7 GROUP BY 1""")
def subtotal_differences(spark, folder):
    return D.subtotal_differences(_raw_returns(spark, folder), ["src_row"], ID_LENGTH)


# --- staff, costs, representatives ---------------------------------------------------

# per count column: factor and modulus of the made-up count
COUNTS = {c: (3 + 2 * i, 5 + i) for i, c in enumerate(D.STAFF_COLUMNS[4:])}


def _raw_staff(spark, folder, ops: DataFrame | None = None) -> DataFrame:
    ops = T.operation_headers(spark, folder) if ops is None else ops
    counts = {c: ((F.col("op_id") * a) % m).cast("string") for c, (a, m) in COUNTS.items()}
    counts["n_meds"] = F.when(F.col("op_id") % 2 == 0, counts["n_meds"])
    rows = ops.select(
        F.lit(None).cast("string").alias("blank"), _id(F.col("op_id")).alias("op_id"), _day("op_date").alias("op_date"), "origin",
        *[c.alias(n) for n, c in counts.items()],
    )
    headers = ops.where(F.col("op_id") % 109 == 1).select(F.lit(D.ID_HEADER).alias("op_id"), F.lit("RO Date").alias("op_date"), F.lit("Escorts").alias("n_esc"))
    return union_by_name(rows, headers)


def _raw_costs(spark, folder, ops: DataFrame | None = None) -> DataFrame:
    paid = T.ledger_lines(spark, folder).groupBy("op_id").agg(F.sum("amount").alias("amount"))
    ops = (T.operation_headers(spark, folder) if ops is None else ops).join(paid, "op_id")
    digits = F.format_number(F.col("amount").cast("decimal(18,4)"), 4)
    spaced = F.concat(F.lit("€       "), F.left(digits, F.lit(1)), F.lit(" "), F.substring(digits, 2, 40))
    rows = ops.select(
        _id(F.col("op_id")).alias("op_id"),
        _day("op_date").alias("op_date"),
        F.concat(F.lit("N"), F.lpad(_number("origin").cast("string"), 2, "0")).alias("iso"),
        F.when(F.col("op_id") % 5 == 0, F.lit("€      -")).otherwise(spaced).alias("amount"),
    )
    headers = ops.where(F.col("op_id") % 56 == 1).select(F.lit(D.ID_HEADER).alias("op_id"), F.lit("TOTAL PAID").alias("amount"))
    return union_by_name(rows, headers)


def _known_countries(spark, folder) -> DataFrame:
    return T.countries(spark, folder).where(F.col("name") != "NATION_7")


HEADS = """heads AS (
    SELECT o_orderkey AS op_id, CAST(o_orderdate AS DATE) AS op_date, n_name AS origin, n_nationkey AS nation
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


def _count_sql(c: str) -> str:
    a, m = COUNTS[c]
    text = f"CAST((op_id * {a}) % {m} AS DOUBLE)"
    return f"CASE WHEN op_id % 2 = 0 THEN {text} END" if c == "n_meds" else text


STAFF_SQL = f"""staff AS (
    SELECT {TIDY_ID} AS op_id, op_date, origin, nation, {", ".join(f"{_count_sql(c)} AS {c}" for c in COUNTS)} FROM heads),
  totals AS (
    SELECT *, n_monitors_nat + n_monitors_pool_ms + n_monitors_fx AS n_monitors, n_obs_ms + n_obs_tc AS n_obs,
           n_esc_lead + n_esc + coalesce(n_meds, 0) + n_obs_ms + n_obs_tc AS n_esc_obs_med FROM staff)"""


@check("A12", "O15", "O17", "O23", "O26", sql=f"WITH {HEADS}, {STAFF_SQL} SELECT * EXCLUDE (nation) FROM totals")
def staff_counts(spark, folder):
    return D.staff(_raw_staff(spark, folder))


COST_SQL = f"""paid AS (SELECT l_orderkey AS k, sum({AMOUNT}) AS amount FROM lineitem GROUP BY 1),
  costs AS (
    SELECT {TIDY_ID} AS op_id, op_date, 'N' || lpad(CAST(nation AS VARCHAR), 2, '0') AS iso,
           CASE WHEN op_id % 5 <> 0 THEN CAST(amount AS DOUBLE) END AS amount, CASE WHEN nation <> 7 THEN origin END AS origin
    FROM heads JOIN paid ON op_id = k)"""


@check("A12", "O91", "O26", sql=f"WITH {HEADS}, {COST_SQL} SELECT op_id, op_date, iso, amount FROM costs")
def cost_rows(spark, folder):
    return D.costs(_raw_costs(spark, folder)).withColumn("amount", F.col("amount").cast("double"))


# each of the two deliveries lacks some operations, which the other one has
STAFFED, PAID = "op_id % 3 <> 0 OR op_id % 4 = 0", "op_id % 4 <> 0"


@check("A12", "O38", sql=f"""WITH {HEADS}, {STAFF_SQL.replace("FROM heads)", f"FROM heads WHERE {STAFFED})")}, {COST_SQL[:-1]} WHERE {PAID}),
  present AS (SELECT *, CASE WHEN nation <> 7 THEN 'N' || lpad(CAST(nation AS VARCHAR), 2, '0') END AS iso FROM totals)
  SELECT coalesce(c.op_id, p.op_id) AS op_id, coalesce(c.op_date, p.op_date) AS op_date, coalesce(c.iso, p.iso) AS iso,
         coalesce(c.origin, p.origin) AS origin, amount, {", ".join([*COUNTS, "n_monitors", "n_obs", "n_esc_obs_med"])}
  FROM costs c FULL JOIN present p ON c.op_id = p.op_id AND c.op_date = p.op_date
       AND c.iso IS NOT DISTINCT FROM p.iso AND c.origin IS NOT DISTINCT FROM p.origin""")
def staff_and_costs(spark, folder):
    """Nation 7 is in no country list, so its costs and staff stay apart."""
    ops = T.operation_headers(spark, folder)
    paid, staffed = _raw_costs(spark, folder, ops.where(PAID)), _raw_staff(spark, folder, ops.where(STAFFED))
    out = D.staff_and_costs(paid, staffed, _known_countries(spark, folder))
    return out.withColumn("amount", F.col("amount").cast("double"))


@check("A14", "O26", "O71", "O92", sql=f"""WITH {HEADS} SELECT {TIDY_ID} AS op_id, op_date,
    CASE WHEN op_id % 6 <> 0 THEN CAST(op_id % 4 AS DOUBLE) END AS n_staff FROM heads""")
def representatives(spark, folder):
    ops = T.operation_headers(spark, folder, origin=False)
    rows = ops.select(
        _id(F.col("op_id")).alias("op_id"),
        _day("op_date").alias("op_date"),
        F.when(F.col("op_id") % 6 != 0, (F.col("op_id") % 4).cast("string")).otherwise(F.lit("?")).alias("n_staff"),
    )
    headers = ops.where(F.col("op_id") % 49 == 0).select(F.lit(D.ID_HEADER).alias("op_id"), F.lit("RO Date").alias("op_date"), F.lit("Count").alias("n_staff"))
    return D.representatives(union_by_name(rows, headers))


# --- sheets with repeated column groups -----------------------------------------------


@delivered
def _raw_sheets(spark, folder) -> DataFrame:
    """Three destinations side by side; an operation with more takes several lines."""
    places = Window.partitionBy("op_id").orderBy("dest")  # at most one row per place
    ranked = T.movements(spark, folder).withColumn("at", F.row_number().over(places) - 1)
    cells = ranked.select(
        "op_id", "op_date", "op_type", "origin",
        F.floor(F.col("at") / 3).alias("line"),
        (F.col("at") % 3 + 1).cast("int").alias("slot"),
        F.when(F.col("dest") == "NATION_24", F.lit("x")).when(F.col("dest") == "NATION_2", F.lit("The Gambia")).otherwise(F.col("dest")).alias("d"),
        "n",
        F.when(_number("dest") % 4 != 0, F.col("n") * 2).alias("e"),
        F.when(_number("dest") % 3 == 0, F.lit(1.0)).alias("l"),
    )
    wide = cells.groupBy("op_id", "op_date", "op_type", "origin", "line").pivot("slot", [1, 2, 3]).agg(
        F.first("d").alias("d"), F.first("n").alias("n"), F.first("e").alias("e"), F.first("l").alias("l")
    )
    slots = {f"{s}_{f}": D.SLOTS[g][s - 1] for s in (1, 2, 3) for f, g in {"d": "dest", "n": "n", "e": "n_esc", "l": "n_esc_lead"}.items()}
    spelled = (
        F.when(_number("origin") == 3, F.lit("UK police"))
        .when(_number("origin") == 5, F.concat("origin", F.lit(" (observer)")))
        .when(_number("origin") == 6, F.lit("N/A"))
        .otherwise(F.col("origin"))
    )
    sheets = wide.withColumnsRenamed(slots).select(
        F.year("op_date").alias("year"),
        F.when(F.col("op_id") % 11 != 0, F.col("op_id").cast("string")).alias("number"),
        F.when(F.col("op_id") % 13 != 0, F.col("op_date")).alias("op_date"),
        spelled.alias("origin"),
        F.lower("op_type").alias("op_type"),
        F.when(F.col("op_id") % 7 != 0, F.lit(120.0)).alias("n_esc_obs_med"),
        (F.col("op_id") % 3).cast("double").alias("n_meds"),
        F.when(F.col("op_id") % 2 == 0, F.lit(1.0)).alias("n_obs"),
        *[F.col(f"`{c}`") for c in slots.values()],
        (F.col("op_id") * 32 + F.col("line")).alias("src_row"),
    )
    return staged(sheets, "raw-sheets")


SHEETS = f"""WITH {MOVES},
  ranked AS (SELECT *, row_number() OVER (PARTITION BY op_id ORDER BY dest) - 1 AS place, CAST(substr(dest, 8) AS INTEGER) AS k FROM moves),
  cells AS (
    SELECT op_id, op_date, year, op_type, origin, place // 3 AS line, CAST(place % 3 + 1 AS INTEGER) AS slot, n,
           CASE WHEN k = 24 THEN NULL WHEN k = 2 THEN 'Gambia' ELSE dest END AS dest,
           CASE WHEN k % 4 <> 0 THEN n * 2 END AS n_esc, CASE WHEN k % 3 = 0 THEN 1.0 END AS n_esc_lead
    FROM ranked),
  parts AS (
    SELECT op_id, op_date, year, op_type, origin, line, coalesce(sum(n_esc), 0) + coalesce(sum(n_esc_lead), 0) AS escorts
    FROM cells GROUP BY ALL),
  lines_ AS (
    SELECT *, op_id % 3 + CASE WHEN op_id % 2 = 0 THEN 1 ELSE 0 END + escorts AS parts, CASE WHEN op_id % 7 <> 0 THEN 120.0 END AS stated,
           CAST(year AS VARCHAR) || '_' || CAST(row_number() OVER (PARTITION BY year ORDER BY op_id, line) AS VARCHAR) AS row_id
    FROM parts),
  heads AS (
    SELECT op_id, line, year, row_id,
           CASE WHEN op_id % 11 <> 0 THEN CAST(year AS VARCHAR) || '_' || CAST(op_id AS VARCHAR) END AS id,
           CASE WHEN op_id % 13 <> 0 THEN op_date ELSE make_date(year, 12, 31) END AS op_date,
           CASE origin WHEN 'NATION_3' THEN 'United Kingdom' WHEN 'NATION_6' THEN NULL ELSE origin END AS origin,
           op_type, CAST(CASE WHEN parts > stated THEN parts ELSE stated END AS DOUBLE) AS n_esc_obs_med,
           coalesce(parts >= stated, FALSE) AS staff_agrees, CAST(op_id % 3 AS DOUBLE) AS n_meds,
           CASE WHEN op_id % 2 = 0 THEN CAST(1 AS DOUBLE) END AS n_obs
    FROM lines_)"""


def _headers(spark, folder):
    return D.sheet_headers(_raw_sheets(spark, folder), T.countries(spark, folder), ["src_row"])


@check("A18", "O21", "O22", "O34", "O83", "O95", sql=SHEETS + """
  SELECT year, row_id, id, op_date, origin, upper(op_type) AS op_type, n_esc_obs_med, n_meds, n_obs,
         CASE WHEN n_nationkey IS NOT NULL THEN 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') END AS iso
  FROM heads LEFT JOIN nation ON origin = n_name""")
def sheet_operations(spark, folder):
    return D.sheet_operations(_headers(spark, folder)).drop("src_row")


@check("A15", "O77", "O72", sql=SHEETS + """
  SELECT row_id, slot, n, dest, n_esc, CAST(n_esc_lead AS DOUBLE) AS n_esc_lead,
         CASE WHEN n_esc IS NOT NULL THEN staff_agrees END AS staff_agrees
  FROM cells JOIN heads USING (op_id, line)""")
def sheet_destinations(spark, folder):
    return D.sheet_destinations(_headers(spark, folder))


COMBINED = SHEETS + """,
  combined AS (
    SELECT id AS op_id, heads.op_date, upper(heads.op_type) AS op_type, heads.origin, cells.dest, n FROM cells JOIN heads USING (op_id, line)
    UNION ALL SELECT 'RO-' || lpad(CAST(op_id AS VARCHAR), 12, '0'), op_date, substr(op_type, 1, 3), origin,
      CASE dest WHEN 'NATION_1' THEN 'Kosovo' WHEN 'NATION_2' THEN 'Gambia' ELSE dest END, n
    FROM moves WHERE op_id % 40 <> 7)"""


def _combined(spark, folder) -> DataFrame:
    headers = staged(_headers(spark, folder), "sheet-headers")  # read for operations and for destinations
    return combined_movements(D.sheet_operations(headers), D.sheet_destinations(headers), D.tidy_returns(_raw_returns(spark, folder), ["src_row"], ID_LENGTH))


@check("A3", "A15", "O71", sql=COMBINED + """
  SELECT CAST(year(op_date) AS INTEGER) AS year, CASE WHEN grouping(dest) = 1 THEN 'all destinations' ELSE dest END AS dest, origin, sum(n) AS n
  FROM combined GROUP BY GROUPING SETS ((year(op_date), origin, dest), (year(op_date), origin)) HAVING sum(n) > 0""")
def combined_yearly_returns(spark, folder):
    """Sheets joined to their lines, stacked on the later returns, by year, state and destination."""
    return Q.yearly_returns_long(_combined(spark, folder))


@check("A4", "A18", sql=COMBINED + """, per_op AS (SELECT op_id, op_date, op_type, sum(n) AS n FROM combined GROUP BY ALL)
  SELECT CAST(year(op_date) AS INTEGER) AS year, op_type, sum(n) AS people, count(*) AS operations FROM per_op GROUP BY ALL""")
def combined_yearly_types(spark, folder):
    """The same table by year and type."""
    return Q.yearly_types_long(_combined(spark, folder)).drop("known_people")


# --- ledger in five layouts -----------------------------------------------------------


@delivered
def _payments(spark, folder) -> DataFrame:
    """Ledger rows with the payee written in several ways, plus what must be dropped."""
    rows = T.ledger(spark, folder).join(T.operation_headers(spark, folder, origin=False).select("op_id", "op_date"), "op_id")
    rows = rows.withColumn("k", _number("payee"))
    rows = _with_first(rows)
    written = (
        F.when(F.col("k") == 4, F.lit("FX MISSIONS"))
        .when(F.col("k") == 5, F.lit("THE NETHERLANDS_CANCELLED"))
        .when(F.col("k") == 6, F.lit("UK_OBSERVERS"))
        .when(F.col("k") == 8, F.lit("BE, RO,SI"))
        .when(F.col("k") % 3 == 0, F.concat(F.lit("("), "payee", F.lit(") observer")))
        .otherwise(F.col("payee"))
    )
    amount = F.when(F.col("k") == 9, F.lit("n/a")).when(F.col("k") == 10, F.lit("-5.5")).otherwise(F.col("amount").cast("string"))
    raw = rows.select(
        "op_id", "op_date", "year", "k", F.col("k").alias("nation"), written.alias("payee"), amount.alias("amount"),
        (F.col("k") == F.col("first")).alias("head"),
        F.concat(F.lit("ledger-"), F.col("year").cast("string")).alias("src_file"),
        (F.col("op_id") * 32 + F.col("k")).alias("src_row"),
    )
    return staged(raw, "raw-ledger")


def _with_totals(rows: DataFrame) -> DataFrame:
    """Every tenth operation is followed by a total row."""
    totals = rows.where(F.col("head") & (F.col("op_id") % 10 == 0)).select(
        "op_id", "year", "src_file", F.lit("TOTAL COST").alias("payee"), F.lit("1000").alias("amount"),
        F.lit(False).alias("head"), (F.col("op_id") * 32 + 31).alias("src_row"),
    )
    return union_by_name(rows, totals)


def _name_countries(spark, folder) -> DataFrame:
    """Names in title case, and the United Kingdom and the Netherlands among them."""
    name = F.col("name")
    named = F.when(name == "NATION_6", F.lit("United Kingdom")).when(name == "NATION_5", F.lit("Netherlands"))
    return T.countries(spark, folder).withColumn("name", named.otherwise(F.initcap("name")))


def _parts(spark, folder):
    """Layout -> function that reads its rows."""
    raw, lands = _payments(spark, folder), _name_countries(spark, folder)
    head, order = F.col("head"), ["src_row"]
    key = F.col("op_id").cast("string")
    year = F.col("year")

    dated = _with_totals(raw.where(year == 1995)).withColumn(
        "info", F.when(head, F.concat(F.lit("JRO to somewhere "), _day("op_date", "dd"), F.lit("-"), _day("op_date")))
    )
    # one operation per date, as the layout needs it
    first = T.operation_headers(spark, folder, origin=False).where(F.year("op_date") == 1995).groupBy("op_date").agg(_id(F.min("op_id")).alias("op_id"))
    layout = F.when(year <= 1997, F.lit(L.NUMBERED)).when(year == 1998, F.lit(L.KEYED)).otherwise(F.lit(L.OWN_DATES))
    merged = union_by_name(_with_totals(raw.where(year.between(1996, 1998))), raw.where(year == 1999)).withColumns(
        {
            "layout": layout,
            "number": F.when(head & (year <= 1997), F.concat(key, F.lit(" (JRO)"))).when(head & (year == 1999), key),
            "op_id": F.when(head & (year == 1998), F.concat(F.lit("RO-1998-"), key)),
            "op_date": F.when(year == 1999, _day("op_date", "yyyy-MM-dd")),
        }
    )
    later = raw.where(year >= 2000).withColumns({"op_date": _day("op_date"), "op_id": F.concat(F.lit("RO-"), key)})
    code = F.when(F.col("nation") == 4, F.lit("FX")).otherwise(F.concat(F.lit("N"), F.lpad(F.col("nation").cast("string"), 2, "0")))
    drop = ["op_date", "op_id"]

    filled = union_by_name(dated.drop(*drop).withColumn("layout", F.lit(L.DATED)), merged)
    return {
        "merged": lambda: L.merged_ledger(filled, lands, order, operations=first),
        "named": lambda: L.named_ledger(later.where(year == 2000).withColumn("payee", F.initcap("payee")), lands),
        "coded": lambda: L.coded_ledger(later.where(year >= 2001).drop("payee").withColumn("iso", code), lands),
    }


DELIVERED = """SELECT 'RO-' || CAST(op_id AS VARCHAR) AS op_id, op_date, year,
      CASE k WHEN 4 THEN 'Fx Missions' WHEN 5 THEN 'The Netherlands_cancelled' WHEN 6 THEN 'Uk_observers' WHEN 8 THEN 'Be, Ro,si'
        ELSE CASE WHEN k % 3 = 0 THEN '(nation_' || CAST(k AS VARCHAR) || ') Observer' ELSE 'Nation_' || CAST(k AS VARCHAR) END END AS payee,
      CASE WHEN k NOT IN (4, 5, 8) AND k % 3 <> 0 THEN 'N' || lpad(CAST(k AS VARCHAR), 2, '0') END AS iso,
      CASE k WHEN 9 THEN NULL WHEN 10 THEN -5.5 ELSE amount END AS amount
    FROM pay WHERE year = 2000"""
LEDGER = f"""WITH {MOVES},
  pay AS (
    SELECT op_id, op_date, year, CAST(substr(dest, 8) AS INTEGER) AS k, CAST(sum(amount) AS DOUBLE) AS amount
    FROM lines GROUP BY ALL),
  named AS (
    SELECT *, CASE WHEN k = 4 THEN 'Frontex' WHEN k = 5 THEN 'Netherlands' WHEN k = 6 THEN 'United Kingdom' ELSE 'Nation_' || CAST(k AS VARCHAR) END AS payee,
           CASE WHEN k = 4 THEN 'FX' ELSE 'N' || lpad(CAST(k AS VARCHAR), 2, '0') END AS iso
    FROM pay WHERE k NOT IN (9, 10)),
  firsts AS (SELECT CAST(o_orderdate AS DATE) AS op_date, min(o_orderkey) AS first_id FROM orders GROUP BY 1),
  whole AS (
    SELECT 'RO-' || lpad(CAST(first_id AS VARCHAR), 12, '0') AS op_id, op_date, year, payee, iso, amount
    FROM named JOIN firsts USING (op_date) WHERE year = 1995 AND k <> 8
    UNION ALL SELECT 'RO-' || CAST(year AS VARCHAR) || '-' || CASE WHEN op_id < 100 THEN lpad(CAST(op_id AS VARCHAR), 3, '0') ELSE CAST(op_id AS VARCHAR) END,
           NULL, year, payee, iso, amount FROM named WHERE year BETWEEN 1996 AND 1997 AND k <> 8
    UNION ALL SELECT 'RO-1998-' || CAST(op_id AS VARCHAR), NULL, year, payee, iso, amount FROM named WHERE year = 1998 AND k <> 8
    UNION ALL SELECT 'RO-1999-' || CASE WHEN op_id < 100 THEN lpad(CAST(op_id AS VARCHAR), 3, '0') ELSE CAST(op_id AS VARCHAR) END,
           op_date, year, CASE WHEN k = 8 THEN 'Be, Ro,Si' ELSE payee END, CASE WHEN k <> 8 THEN iso END, amount FROM named WHERE year = 1999
    UNION ALL {DELIVERED}
    UNION ALL SELECT 'RO-' || CAST(op_id AS VARCHAR), op_date, year, payee, iso, amount FROM named WHERE year >= 2001)"""


@check("A5", "O3", "O4", "O5", "O29", "O31", "O37", "O42", "O43", "O71", "O88", "O90", sql=LEDGER + " SELECT * FROM whole")
def whole_ledger(spark, folder):
    """All five branches under one another, over all payments."""
    return _whole(spark, folder).withColumn("amount", F.col("amount").cast("double"))


def _whole(spark, folder) -> DataFrame:
    return L.whole_ledger(*[part() for part in _parts(spark, folder).values()])


@check("A5", "O35", sql=f"""WITH {MOVES}, pay AS (
    SELECT op_id, op_date, year, CAST(substr(dest, 8) AS INTEGER) AS k, CAST(sum(amount) AS DOUBLE) AS amount FROM lines GROUP BY ALL) {DELIVERED}""")
def named_ledger(spark, folder):
    """Names and amounts are kept as delivered, codes found where the name is a country's."""
    return _parts(spark, folder)["named"]().withColumn("amount", F.col("amount").cast("double"))


@check("A5", "A6", sql=LEDGER + """ SELECT year, payee, coalesce(sum(CAST(amount AS DECIMAL(18,4))), 0)::DOUBLE AS amount FROM whole GROUP BY year, payee""")
def whole_ledger_by_year_and_payee(spark, folder):
    """The contribution cube from the ledger as it was read."""
    long = Q.yearly_contributions_long(_whole(spark, folder))
    return long.withColumn("amount", F.col("amount").cast("double"))


# --- newer deliveries: returns and types ---------------------------------------------


def _newer_files(spark, rows: DataFrame, label: str) -> str:
    """One delivery per year, as CSV with a header."""
    path = new_folder(spark, label)
    rows.write.partitionBy("year").option("header", True).csv(path)
    return path


@delivered
def _returns_path(spark, folder) -> str:
    moves = T.movements(spark, folder)
    starred = F.when(_number("dest") % 2 == 0, F.concat("dest", F.lit("*"))).otherwise(F.col("dest"))
    rows = moves.select(
        F.year("op_date").alias("year"), "op_id", _day("op_date", "yyyy-MM-dd").alias("op_date"), "origin",
        starred.alias("dest"), F.col("n").cast("string").alias("n"),
    )
    return _newer_files(spark, rows, "newer-returns")


def _newer_returns(spark, folder) -> DataFrame:
    return D.newer_returns(read_rows(spark, _returns_path(spark, folder), D.NEWER_RETURN_COLUMNS))


@delivered
def _types_path(spark, folder) -> str:
    rows = T.operation_headers(spark, folder, origin=False).select(
        F.year("op_date").alias("year"), _day("op_date").alias("op_date"), F.concat(F.lit(" "), "op_type").alias("op_type"), "op_id"
    )
    return _newer_files(spark, rows, "newer-types")


def _newer_types(spark, folder) -> DataFrame:
    return D.newer_types(read_rows(spark, _types_path(spark, folder), D.NEWER_TYPE_COLUMNS))


TITLED = "'Nation_' || substr({0}, 8)"


@check("A1", "O12", "O79", "O84", sql=f"""WITH {MOVES} SELECT {TITLED.format('dest')} AS dest, {TITLED.format('origin')} AS origin, sum(n) AS n
    FROM moves GROUP BY dest, origin""")
def newer_route_matrix(spark, folder):
    """Route matrix from yearly deliveries taken by position, with names cleaned."""
    return Q.route_matrix(_newer_returns(spark, folder))


@check("A4", "O12", "O39", sql=f"""WITH {MOVES}, per_op AS (SELECT op_id, op_date, op_type, sum(n) AS n FROM moves GROUP BY ALL),
    known AS (SELECT CAST(o_orderkey AS BIGINT) AS op_id, o_orderpriority AS op_type FROM orders)
    SELECT CAST(year(op_date) AS INTEGER) AS year, known.op_type, coalesce(sum(n), 0) AS people, count(*) AS operations
    FROM known LEFT JOIN per_op USING (op_id) GROUP BY ALL""")
def newer_yearly_types(spark, folder):
    """Types from their own deliveries, joined in full to the returns."""
    totals = Q.operation_totals(_newer_returns(spark, folder))
    return Q.yearly_types_long(Q.operations(_newer_types(spark, folder), totals)).drop("known_people")
