"""Published cubes as their readers find them: by manifest, typed, after a second run."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import increments as N
from ..plans import publish as P
from ..session import new_folder, staged
from ..sources import snapshots as S
from ..sources import tables as T
from ..sources.files import read_typed
from .analyses import CONTRIBUTIONS, LEFT_OUT, RANKING, SIZES, TOP, TYPES, YEARLY
from .registry import COSTS, LINES, PRIORITIES, check, delivered, pivot_sql


@delivered
def _published(spark, folder):
    """Two runs into one folder as CSV, the first one from every other operation only."""
    out = new_folder(spark, "published-twice")
    types, countries = T.operation_types(spark, folder), T.countries(spark, folder)
    moves, ledger = T.movements(spark, folder), T.ledger(spark, folder)
    half = F.col("op_id") % 2 == 0
    P.publish(moves.where(half), types.where(half), ledger.where(half), countries, out, "csv", null_safe=False)
    P.publish(moves, types, ledger, countries, out, "csv", null_safe=False)
    return out


def _cube(spark, folder, name, version=None):
    return S.read_table(spark, _published(spark, folder), name, version)


@check("O7", "O10", sql="WITH counted AS (WITH " + SIZES + ") SELECT cube, CAST(2 AS BIGINT) AS version, 'csv' AS form, n_rows FROM counted")
def published_catalog(spark, folder):
    """What the current manifest lists after two runs."""
    return S.catalog(spark, _published(spark, folder)).drop("n_files")


def _routes(where):
    return f'WITH {LINES} SELECT dest AS "DEST", origin AS "MSNAME", sum(n) AS "N_RETURNEES" FROM lines {where} GROUP BY dest, origin'


@check("O7", "O9", "A1", sql=_routes(""))
def published_routes(spark, folder):
    return _cube(spark, folder, P.ROUTES)


@check("O7", "O9", "A1", sql=_routes(""))
def exported_routes(spark, folder):
    """One file per cube, as a chart reads it."""
    paths = P.export(spark, _published(spark, folder), new_folder(spark, "exported"))
    return read_typed(spark, paths[P.ROUTES], "DEST string, MSNAME string, N_RETURNEES double")


@check("O7", "O10", "A1", sql=_routes("WHERE op_id % 2 = 0"))
def published_routes_before(spark, folder):
    """The version before is still there, with the values of its own run."""
    return _cube(spark, folder, P.ROUTES, version=1)


@check("O7", "O9", "A2", sql=TOP + ' SELECT dest AS "DEST", origin AS "MSNAME", n AS "N_RETURNEES" FROM ranked')
def published_top_routes(spark, folder):
    return _cube(spark, folder, P.TOP_ROUTES)


@check("O7", "O9", "A3", sql=f'SELECT year AS "YEAR", dest AS "DEST", * EXCLUDE (year, dest) FROM ({YEARLY})')
def published_yearly_returns(spark, folder):
    return _cube(spark, folder, P.YEARLY_RETURNS)


@check("O7", "O9", "A4", sql=TYPES + f""" SELECT year AS "YEAR", key AS "KEY", {pivot_sql('op_type', 'value', PRIORITIES)} FROM (
      SELECT year, op_type, 'Number of deported people' AS key, CAST(people AS DOUBLE) AS value FROM cube
      UNION ALL SELECT year, op_type, 'Number of operations', CAST(operations AS DOUBLE) FROM cube) GROUP BY year, key""")
def published_yearly_types(spark, folder):
    return _cube(spark, folder, P.YEARLY_TYPES)


@check("O7", "O9", "A6", sql=CONTRIBUTIONS + """,
  payees AS (SELECT DISTINCT payee FROM cells),
  every AS (SELECT payee FROM payees UNION ALL SELECT 'all EU member states')
  SELECT y.year AS "YEAR", r.payee AS "MSNAME", k.payee AS "paid_to",
         CAST(CASE WHEN r.payee IN (k.payee, 'all EU member states') THEN coalesce(c.amount, 0) ELSE 0 END AS DOUBLE) AS amount
  FROM (SELECT DISTINCT year FROM cells) y CROSS JOIN every r CROSS JOIN payees k
  LEFT JOIN cells c ON c.payee = k.payee AND c.year = y.year""")
def published_yearly_contributions(spark, folder):
    """The diagonal cube, its columns turned to rows, as payees differ between table sizes."""
    cube = _cube(spark, folder, P.YEARLY_CONTRIBUTIONS)
    payees = [c for c in cube.columns if c not in ("YEAR", "MSNAME")]
    return cube.unpivot(["YEAR", "MSNAME"], payees, "paid_to", "amount").withColumn("amount", F.col("amount").cast("double"))


@check("O7", "O9", "A8", sql=f"""SELECT dest AS "DEST", n AS "N_RETURNEES", amount AS "EUR", n_ops AS "N_OPS", per_person AS "FX_CONTRIB_PP", iso
    FROM ({RANKING} LIMIT 26)""")
def published_cost_per_person(spark, folder):
    return _cube(spark, folder, P.PER_PERSON)


AVERAGE = """CAST(sum(amount) AS DOUBLE) AS eur_total, sum(n) AS number_returned,
  round_even(CAST(sum(amount) AS DOUBLE) / sum(n), 2) AS avg_eur_per_person FROM costs GROUP BY ALL"""


@check("O7", "O9", "A9", sql=f"WITH {COSTS} SELECT year, {AVERAGE}")
def published_averages(spark, folder):
    return _cube(spark, folder, P.AVERAGES)


@check("O7", "O9", "A10", sql=f"WITH {COSTS} SELECT year, dest AS destination, {AVERAGE}")
def published_averages_by_destination(spark, folder):
    return _cube(spark, folder, P.AVERAGES_BY_DESTINATION)


@check("O7", "O9", "A11", sql=LEFT_OUT % ("= 2", "= 2"))
def published_share_left_out(spark, folder):
    return _cube(spark, folder, P.LEFT_OUT)


INCREMENTS = {
    "routes": lambda s: N.cube_of(s, ["dest", "origin"], strict={"n": "n"}, lenient={"n_known": "n"}),
    "years": lambda s: N.cube_of(s, ["year", "dest"], strict={"n": "n"}, lenient={"n_known": "n"}),
}


@delivered
def _incremental(spark, folder):
    """Yearly deliveries one after the other; one comes short at first, one is taken back. Some counts are missing."""
    out = new_folder(spark, "incremental")
    lines = T.movement_lines(spark, folder).withColumn("year", F.year("op_date"))
    lines = staged(lines.withColumn("n", F.when(F.col("op_id") % 97 != 0, F.col("n"))).select("year", "dest", "origin", "op_id", "n"), "lines")
    put = lambda name, rows: N.add_delivery(spark, out, name, rows, ["year", "dest", "origin"], ["n"], INCREMENTS)
    put("to 1994", lines.where("year < 1995"))
    put("1995", lines.where("year = 1995 AND op_id % 3 = 0"))
    put("twice", lines.where("year = 1992"))
    put("1995", lines.where("year = 1995"))
    put("from 1996", lines.where("year > 1995"))
    N.remove_delivery(spark, out, "twice", INCREMENTS)
    return out


def _from_scratch(keys):
    n = "CASE WHEN op_id % 97 <> 0 THEN n END"
    return f"""WITH {LINES} SELECT {keys}, CASE WHEN count({n}) = count(*) THEN sum({n}) END AS n, coalesce(sum({n}), 0) AS n_known
      FROM lines GROUP BY {keys}"""


@check("O5", "O46", "O47", "A1", sql=_from_scratch("dest, origin"))
def routes_after_increments(spark, folder):
    """The cube after five more versions equals the one from all rows."""
    return S.read_table(spark, _incremental(spark, folder), "routes")


@check("O5", "O47", "A3", sql=_from_scratch("year, dest"))
def years_after_increments(spark, folder):
    return S.read_table(spark, _incremental(spark, folder), "years")
