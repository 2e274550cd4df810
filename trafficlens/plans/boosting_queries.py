"""Return flags of order lines by boosted trees, with the boosting itself in SQL, and by a forest without a depth bound."""

from __future__ import annotations

from pyspark.sql import functions as F

from trafficlens.operators import boosting, deep_forest
from trafficlens.operators.sampling import hash_split
from trafficlens.plans import tables
from trafficlens.plans.registry import query, rounded

FEATURES = ("line_number", "quantity", "discount", "tax", "ship_quarter")
ROUNDS, DEPTH = 4, 3


def lines(spark, folder):
    quarter = F.year("l_shipdate") * 4 + F.quarter("l_shipdate")
    rows = tables.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_returnflag", F.col("l_linenumber").alias("line_number"), F.col("l_quantity").alias("quantity"),
        F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"), quarter.alias("ship_quarter"))
    return hash_split(rows, "l_orderkey")


def fitted(spark, folder):
    """Held-out lines, and the model of the others."""
    rows = lines(spark, folder)
    return rows.filter("split = 'test'"), boosting.fit(rows.filter("split = 'train'"), FEATURES, "l_returnflag", ROUNDS, DEPTH)


def _sql(rounds: int, depth: int) -> str:
    """Common table expressions of the whole boosting: f0, f1, ... hold margins, s<round>_<level> the cuts."""
    unit, classes = boosting.UNIT, 3
    ctes = ["""raw AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, l_orderkey, l_partkey, l_returnflag, l_linenumber::DOUBLE AS x0, l_quantity AS x1, l_discount AS x2, l_tax AS x3,
    (year(l_shipdate) * 4 + quarter(l_shipdate))::DOUBLE AS x4, ('0x' || substr(md5(l_orderkey::VARCHAR || '|42'), 1, 8))::BIGINT % 100 >= 80 AS held_out
  FROM lineitem)""",
            "flags AS (SELECT list(DISTINCT l_returnflag ORDER BY l_returnflag) AS names FROM raw WHERE NOT held_out)"]
    # All these features have few values, so every value is a cut.
    edges = " UNION ALL ".join(f"SELECT {j} AS j, list(DISTINCT x{j} ORDER BY x{j}) AS e FROM raw WHERE NOT held_out" for j in range(len(FEATURES)))
    ctes.append(f"edges AS MATERIALIZED ({edges})")
    cells = " UNION ALL ".join(f"SELECT rid, {j} AS j, x{j} AS x FROM raw" for j in range(len(FEATURES)))
    ctes.append(f"long AS MATERIALIZED (SELECT rid, j, 1 + len(list_filter(e, lambda v: v < x)) AS b FROM ({cells}) JOIN edges USING (j))")
    ctes.append("m0 AS MATERIALIZED (SELECT rid, held_out, list_position(names, l_returnflag) - 1 AS y, "
                + ", ".join(f"0.0::DOUBLE AS f{k}" for k in range(classes)) + " FROM raw, flags)")
    for r in range(rounds + 1):
        # The chance of each class, written out as the margins minus the greatest one.
        ctes.append(f"""e{r} AS (SELECT *, {', '.join(f'exp(f{k} - greatest(f0, f1, f2)) AS e{k}' for k in range(classes))} FROM m{r}),
p{r} AS MATERIALIZED (SELECT *, {', '.join(f'e{k} / (e0 + e1 + e2) AS p{k}' for k in range(classes))} FROM e{r}),
l{r} AS (SELECT {r}::INT AS round, sum(floor(-ln(greatest(CASE y WHEN 0 THEN p0 WHEN 1 THEN p1 ELSE p2 END, 1e-16)) * {unit} + 0.5)::BIGINT)::DOUBLE / {unit} / count(*) AS loss
  FROM p{r} WHERE NOT held_out)""")
        if r == rounds:
            break
        grads = " UNION ALL ".join(
            f"SELECT rid, held_out, {k} AS k, floor((p{k} - (y = {k})::INT) * {unit} + 0.5)::BIGINT AS g, floor(greatest(2 * p{k} * (1 - p{k}), 1e-16) * {unit} + 0.5)::BIGINT AS h FROM p{r}"
            for k in range(classes))
        ctes.append(f"g{r} AS MATERIALIZED ({grads}),\nn{r}_0 AS (SELECT rid, held_out, k, g, h, 0 AS node FROM g{r})")
        leaves = []
        for level in range(depth):
            last = level + 1 == depth
            ctes.append(f"""c{r}_{level} AS (SELECT k, node, j, b, sum(g)::BIGINT AS g, sum(h)::BIGINT AS h, count(*) AS n FROM n{r}_{level} JOIN long USING (rid) WHERE NOT held_out GROUP BY ALL),
w{r}_{level} AS (
  SELECT *, sum(g) OVER upto::BIGINT AS gl, sum(h) OVER upto::BIGINT AS hl, sum(n) OVER upto::BIGINT AS nl,
    sum(g) OVER whole::BIGINT AS ga, sum(h) OVER whole::BIGINT AS ha, sum(n) OVER whole::BIGINT AS na
  FROM c{r}_{level} WINDOW whole AS (PARTITION BY k, node, j), upto AS (PARTITION BY k, node, j ORDER BY b ROWS UNBOUNDED PRECEDING)),
q{r}_{level} AS (
  SELECT k, node, j, b, gl, hl, nl, ga, ha, na, (gl::DOUBLE / {unit}) * (gl::DOUBLE / {unit}) / (hl::DOUBLE / {unit} + 1.0)
    + ((ga - gl)::DOUBLE / {unit}) * ((ga - gl)::DOUBLE / {unit}) / ((ha - hl)::DOUBLE / {unit} + 1.0)
    - (ga::DOUBLE / {unit}) * (ga::DOUBLE / {unit}) / (ha::DOUBLE / {unit} + 1.0) AS gain,
    nl < na AND hl >= {unit} AND ha - hl >= {unit} AS fits
  FROM w{r}_{level}),
s{r}_{level} AS MATERIALIZED (
  SELECT *, fits AND gain > {boosting.LEAST_GAIN} AS cuts FROM q{r}_{level}
  QUALIFY row_number() OVER (PARTITION BY k, node ORDER BY (fits AND gain > {boosting.LEAST_GAIN}) DESC, gain DESC, j, b) = 1),
n{r}_{level + 1} AS MATERIALIZED (
  SELECT n.rid, n.held_out, n.k, n.g, n.h, 2 * n.node + 1 + (long.b > s.b)::INT AS node
  FROM n{r}_{level} n JOIN s{r}_{level} s ON n.k = s.k AND n.node = s.node AND s.cuts JOIN long ON long.rid = n.rid AND long.j = s.j)""")
            leaves.append(f"SELECT k, node, ga AS g, ha AS h, na AS n FROM s{r}_{level} WHERE NOT cuts")
            if last:
                leaves += [f"SELECT k, 2 * node + 1, gl, hl, nl FROM s{r}_{level} WHERE cuts", f"SELECT k, 2 * node + 2, ga - gl, ha - hl, na - nl FROM s{r}_{level} WHERE cuts"]
        at = " UNION ALL ".join(f"SELECT rid, k, node FROM n{r}_{level}" for level in range(depth + 1))
        ctes.append(f"""v{r} AS MATERIALIZED (SELECT k, node, h, n, -{boosting.STEP}::DOUBLE * (g::DOUBLE / {unit}) / (h::DOUBLE / {unit} + 1.0) AS value FROM ({' UNION ALL '.join(leaves)})),
a{r} AS (SELECT rid, {', '.join(f'max(CASE WHEN k = {k} THEN value END) AS v{k}' for k in range(classes))} FROM ({at}) JOIN v{r} USING (k, node) GROUP BY rid),
m{r + 1} AS MATERIALIZED (SELECT m.rid, held_out, y, {', '.join(f'f{k} + v{k} AS f{k}' for k in range(classes))} FROM m{r} m JOIN a{r} USING (rid))""")
    return "WITH " + ",\n".join(ctes) + "\n"


_BOOSTED = _sql(ROUNDS, DEPTH)
_NAMES = "[" + ", ".join(f"'{f}'" for f in FEATURES) + "]"
_INNER = " UNION ALL ".join(f"SELECT {r} AS round, * FROM s{r}_{level} WHERE cuts" for r in range(ROUNDS) for level in range(DEPTH))
_LEAVES = " UNION ALL ".join(f"SELECT {r} AS round, * FROM v{r}" for r in range(ROUNDS))


@query(
    "boosted_nodes",
    _BOOSTED
    + f"""SELECT round::INT AS round, names[k + 1] AS class, node::INT AS node, {_NAMES}[j + 1] AS feature, round(e[b], 9) AS threshold, 0.0::DOUBLE AS value,
  round(gain, 6) AS gain, na::BIGINT AS row_count
FROM ({_INNER}) JOIN edges USING (j), flags
UNION ALL SELECT round::INT, names[k + 1], node::INT, NULL, NULL, round(value, 9), 0.0, n::BIGINT FROM ({_LEAVES}), flags""",
)
def boosted_nodes(spark, folder):
    """All nodes of the boosted trees, with cuts, leaf values and row counts."""
    model = fitted(spark, folder)[1]
    names = [None if j < 0 else model.features[j] for j in model.nodes["feature"]]
    rows = [(int(r), model.classes[c], int(node), f, None if f is None else float(t), float(v), float(g), int(n)) for r, c, node, f, t, v, g, n in zip(
        *(model.nodes[c] for c in ("round", "class", "node")), names, *(model.nodes[c] for c in ("threshold", "value", "gain", "rows")))]
    kinds = "round int, class string, node int, feature string, threshold double, value double, gain double, row_count long"
    return rounded(spark.createDataFrame(rows, kinds), gain=6)


@query(
    "boosted_types",
    _BOOSTED
    + f"""SELECT l_orderkey, l_partkey, l_returnflag AS traffic_type, names[CASE WHEN p0 >= p1 AND p0 >= p2 THEN 1 WHEN p1 >= p2 THEN 2 ELSE 3 END] AS predicted_traffic_type,
  round(greatest(p0, p1, p2), 9) AS prediction_confidence
FROM p{ROUNDS} JOIN raw USING (rid), flags WHERE raw.held_out""",
)
def boosted_types(spark, folder):
    """Return flag of the held-out lines by the boosted trees, with the probability of the chosen class."""
    held_out, model = fitted(spark, folder)
    out = boosting.predict(held_out, model, "predicted_traffic_type", "prediction_confidence")
    return rounded(out.select("l_orderkey", "l_partkey", F.col("l_returnflag").alias("traffic_type"), "predicted_traffic_type", "prediction_confidence"))


@query("boosted_loss", _BOOSTED + " UNION ALL ".join(f"SELECT round, round(loss, 9) AS loss FROM l{r}" for r in range(ROUNDS + 1)))
def boosted_loss(spark, folder):
    """Training loss before the first round and after each one."""
    return rounded(boosting.losses(spark, fitted(spark, folder)[1]))


@query(
    "boosted_importance",
    _BOOSTED
    + f"""SELECT f.name AS feature, coalesce(round(sum(gain) / (SELECT sum(gain) FROM ({_INNER})), 6), 0) AS importance, count(gain) AS cuts
FROM (SELECT unnest({_NAMES}) AS name, generate_subscripts({_NAMES}, 1) - 1 AS j) f LEFT JOIN ({_INNER}) USING (j) GROUP BY f.name""",
)
def boosted_importance(spark, folder):
    """Share of the gain and number of cuts of every feature."""
    return rounded(boosting.importance(spark, fitted(spark, folder)[1]), importance=6)


@query(
    "deep_forest_fit",
    """WITH rows_ AS (SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_returnflag AS traffic_type FROM lineitem),
votes AS (SELECT l_linenumber, l_quantity, l_extendedprice, l_discount, traffic_type AS vote, count(*) AS n FROM rows_ GROUP BY ALL),
groups AS (
  SELECT l_linenumber, l_quantity, l_extendedprice, l_discount, vote, n::DOUBLE / sum(n) OVER same AS share
  FROM votes WINDOW same AS (PARTITION BY l_linenumber, l_quantity, l_extendedprice, l_discount)
  QUALIFY row_number() OVER (PARTITION BY l_linenumber, l_quantity, l_extendedprice, l_discount ORDER BY n DESC, vote) = 1)
SELECT l_orderkey, l_partkey, traffic_type, vote AS predicted_traffic_type, round(share, 9) AS prediction_confidence
FROM rows_ JOIN groups USING (l_linenumber, l_quantity, l_extendedprice, l_discount)""",
)
def deep_forest_fit(spark, folder):
    """Trees grown to the end on all lines give every line its own flag, or the most frequent one of equal lines."""
    rows = tables.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", F.col("l_returnflag").alias("traffic_type"), "l_linenumber", "l_quantity", "l_extendedprice", "l_discount")
    forest = deep_forest.fit(rows, ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount"], "traffic_type", trees=2, bootstrap=False, fit_rows=rows.count())
    out = deep_forest.predict(rows, forest, "predicted_traffic_type", "prediction_confidence")
    return rounded(out.select("l_orderkey", "l_partkey", "traffic_type", "predicted_traffic_type", "prediction_confidence"))
