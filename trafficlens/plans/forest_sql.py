"""The isolation forest in SQL: draws, growth, scores and threshold, from the same MD5 sums."""

from __future__ import annotations

from collections.abc import Sequence

from trafficlens.operators import iforest


def _chance(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, {iforest._DIGITS}))::BIGINT"


def forest_ctes(
    source: str, row_id: str, features: Sequence[str], contamination: float | str = iforest.CONTAMINATION, trees: int = iforest.TREES,
    sample_size: int = iforest.SAMPLE_SIZE, seed: int = iforest.SEED,
) -> str:
    """Common table expressions up to ``forest_scores`` (rid, anomaly_score, prediction, traffic_type) over ``forest_rows`` (rid, id).

    ``source`` is the name of a table whose ``row_id`` is unique; features hold no nulls.
    """
    span, unit = iforest._HASH_SPAN, int(1 / iforest.PATH_UNIT)
    xs = [f"x{j}" for j in range(len(features))]
    levels = (sample_size - 1).bit_length()
    columns = ", ".join(xs)
    typical = "CASE WHEN {n} > 2 THEN 2.0::DOUBLE * (ln({n}::DOUBLE - 1.0) + 0.5772156649015329::DOUBLE) - 2.0::DOUBLE * ({n}::DOUBLE - 1.0) / {n}::DOUBLE WHEN {n} = 2 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"
    ctes = [
        f"""forest_rows AS MATERIALIZED (SELECT row_number() OVER () AS rid, {row_id} AS id, {row_id}::VARCHAR AS key,
    {', '.join(f'{f}::DOUBLE AS {x}' for f, x in zip(features, xs))} FROM {source})""",
        f"""odds AS (SELECT n, s, ceil(log2(greatest(s, 2)))::INT AS deepest, least(1.0::DOUBLE, (s + 6.0::DOUBLE * sqrt(s)) / n) AS share,
    least(1.0::DOUBLE, least(1.0::DOUBLE, (s + 6.0::DOUBLE * sqrt(s)) / n) * {trees}) AS any_tree
  FROM (SELECT count(*) AS n, least({sample_size}, count(*)) AS s FROM forest_rows))""",
        f"""tickets AS (SELECT forest_rows.*, s, share, any_tree, unnest(range({trees}))::BIGINT AS tree FROM forest_rows, odds
  WHERE {_chance(f"key || '|{seed}'")} < floor(any_tree * {span}))""",
        f"""r0 AS MATERIALIZED (
  SELECT tree, 0::BIGINT AS node, {columns} FROM (SELECT *, {_chance(f"key || '|' || tree || '|{seed}'")} AS ticket FROM tickets)
  WHERE ticket < floor(share / any_tree * {span}) QUALIFY row_number() OVER (PARTITION BY tree ORDER BY ticket, id) <= s)""",
    ]
    for level in range(levels + 1):
        bounds = ", ".join(f"min(x{j}) AS l{j}, max(x{j}) AS h{j}" for j in range(len(features)))
        open_ = ", ".join(f"CASE WHEN h{j} > l{j} THEN {j} END" for j in range(len(features)))
        pick = " ".join(f"WHEN {j} THEN {{}}{j}" for j in range(len(features)))
        random = f"'{seed}|' || tree || '|' || node || '|"
        ctes.append(f"""k{level} AS (SELECT tree, node, count(*) AS m, {bounds} FROM r{level} GROUP BY tree, node),
o{level} AS (SELECT *, list_filter([{open_}], lambda v: v IS NOT NULL) AS open FROM k{level}),
f{level} AS (SELECT o.*, CASE WHEN {level} < deepest AND len(open) > 0 THEN open[1 + floor({_chance(random + "feature'")}::DOUBLE / {span} * len(open))::INT] END AS f FROM o{level} o, odds),
b{level} AS (SELECT tree, node, m, f, CASE f {pick.format(*['l'] * len(features))} END AS low, CASE f {pick.format(*['h'] * len(features))} END AS high FROM f{level}),
s{level} AS MATERIALIZED (SELECT tree, node, m, f, CASE WHEN cut <= low THEN high ELSE cut END AS cut, floor(({level} + {typical.format(n='m')}) * {unit} + 0.5)::BIGINT AS path
  FROM (SELECT *, low + {_chance(random + "cut'")}::DOUBLE / {span} * (high - low) AS cut FROM b{level}))""")
        value = f"CASE s.f {pick.format(*['x'] * len(features))} END"
        if level < levels:
            ctes.append(f"""r{level + 1} AS MATERIALIZED (SELECT tree, 2 * node + 1 + ({value} >= s.cut)::INT AS node, {columns} FROM r{level} JOIN s{level} s USING (tree, node) WHERE s.f IS NOT NULL)""")
    for level in range(levels + 1):
        value = f"CASE s.f {pick.format(*['x'] * len(features))} END"
        if level == 0:
            ctes.append(f"w0 AS (SELECT rid, unnest(range({trees}))::BIGINT AS tree, 0::BIGINT AS node FROM forest_rows)")
        else:
            ctes.append(f"""w{level} AS MATERIALIZED (SELECT w.rid, w.tree, 2 * w.node + 1 + ({value} >= s.cut)::INT AS node
  FROM w{level - 1} w JOIN s{level - 1} s USING (tree, node) JOIN forest_rows USING (rid) WHERE s.f IS NOT NULL)""")
    ends = " UNION ALL ".join(f"SELECT w.rid, s.path FROM w{level} w JOIN s{level} s USING (tree, node) WHERE s.f IS NULL" for level in range(levels + 1))
    offset = f"{iforest.AUTO_OFFSET}::DOUBLE" if contamination == "auto" else f"(SELECT quantile_cont(raw, {contamination}) FROM raw)"
    norm = f"(SELECT coalesce(nullif({typical.format(n='s')}, 0), 1) FROM odds)"
    ctes.append(f"""raw AS MATERIALIZED (SELECT rid, -pow(2.0::DOUBLE, -(sum(path)::DOUBLE / {unit} / {trees}) / {norm}) AS raw FROM ({ends}) GROUP BY rid),
values_ AS (SELECT rid, raw - {offset} AS v FROM raw),
forest_scores AS (SELECT rid, v AS anomaly_score, CASE WHEN v < 0 THEN 1 ELSE 0 END AS prediction, CASE WHEN v < 0 THEN 'anomaly' ELSE 'normal' END AS traffic_type FROM values_)""")
    return ",\n".join(ctes)
