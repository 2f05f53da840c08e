"""Places of nodes and links in the flow chart after a fixed number of sweeps."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import flow as G
from ..session import staged
from .analyses import GRAPH, _links
from .registry import check

HEIGHT, PADDING, SWEEPS = 600.0, 10.0, 2


def _sweeps(count: int) -> str:
    """One step after the other as SQL; routes have two levels, from 0 to 1.

    Sums are exact decimals, as in the library, so that ties stay ties.
    """
    exact = "CAST(CAST(sum(CAST({} AS DECIMAL(38,12))) AS VARCHAR) AS DOUBLE)"
    steps, state = [], "p0"

    def spread(old: str, new: str) -> str:
        above = "PARTITION BY level ORDER BY y, node ROWS BETWEEN UNBOUNDED PRECEDING AND"
        return f"""
  {new}d AS MATERIALIZED (SELECT *, CAST(coalesce(sum(CAST(dy + {PADDING} AS DECIMAL(38,12))) OVER ({above} 1 PRECEDING), 0) AS DOUBLE) AS d FROM {old}),
  {new} AS MATERIALIZED (SELECT node, level, dy, d + least(greatest(0, max(y - d) OVER ({above} CURRENT ROW)),
         {HEIGHT} - last_value(dy + d) OVER ({above} UNBOUNDED FOLLOWING)) AS y FROM {new}d)"""

    def pull(old: str, new: str, near: str, far: str, alpha: float) -> str:
        return f"""
  {new} AS MATERIALIZED (SELECT p.node, level, dy, CASE WHEN pull IS NULL THEN y ELSE y + (pull - (y + dy / 2)) * {alpha!r} END AS y
    FROM {old} p LEFT JOIN (
      SELECT {near} AS node, {exact.format("(f.y + f.dy / 2) * value")} / {exact.format("value")} AS pull
      FROM indexed JOIN {old} f ON {far} = f.node GROUP BY {near}) q ON p.node = q.node)"""

    steps.append(spread(state, "s0"))
    state, alpha, number = "s0", 1.0, 0
    for _ in range(count):
        alpha *= G.COOLING
        for near, far in (("source_node", "target_node"), ("target_node", "source_node")):
            number += 1
            steps.append(pull(state, f"r{number}", near, far, alpha))
            steps.append(spread(f"r{number}", f"s{number}"))
            state = f"s{number}"
    return ",".join(steps) + f",\n  placed AS MATERIALIZED (SELECT * FROM {state})"


PLACED = GRAPH.replace("AS (", "AS MATERIALIZED (") + f""",
  described AS MATERIALIZED (
    SELECT nodes.name, node, greatest(o, i) AS value, CASE WHEN nodes.name LIKE 'to %' THEN 1 ELSE 0 END AS level
    FROM nodes JOIN flows USING (name)),
  scale AS (SELECT min(({HEIGHT} - (n - 1) * {PADDING}) / value) AS unit FROM (SELECT level, count(*) AS n, sum(value) AS value FROM described GROUP BY 1)),
  p0 AS MATERIALIZED (
    SELECT node, level, value * unit AS dy, CAST(row_number() OVER (PARTITION BY level ORDER BY node) - 1 AS DOUBLE) AS y FROM described, scale),""" + _sweeps(SWEEPS)


def _layout(spark, folder):
    return G.flow_layout(staged(_links(spark, folder), "links"), HEIGHT, PADDING, SWEEPS)


@check("A17", "O103", sql=PLACED + " SELECT name, node, value, level, round(y, 6) AS y, round(dy, 6) AS dy FROM described JOIN (SELECT node, y, dy FROM placed) USING (node)")
def flow_positions(spark, folder):
    nodes, _ = _layout(spark, folder)
    return nodes.withColumns({c: F.round(c, 6) for c in ("y", "dy")})


@check("A17", "O64", sql=PLACED + """
  SELECT position, source_node, target_node, round(value * unit, 6) AS dy,
         round((sum(value) OVER (PARTITION BY source_node ORDER BY round(t.y, 6), target_node) - value) * unit, 6) AS sy,
         round((sum(value) OVER (PARTITION BY target_node ORDER BY round(s.y, 6), source_node) - value) * unit, 6) AS ty
  FROM indexed JOIN placed s ON source_node = s.node JOIN placed t ON target_node = t.node, scale""")
def flow_link_places(spark, folder):
    """Links start in the order in which their other ends lie on the chart."""
    _, links = _layout(spark, folder)
    return links.withColumns({c: F.round(c, 6) for c in ("dy", "sy", "ty")})
