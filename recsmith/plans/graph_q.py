"""Graph queries (G1..G8, J9) on the click log's train split, with DuckDB
twins where the computation is deterministic SQL (walks included: the
uniform walk is a recursive CTE over the same md5 draws)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsmith.operators import graph as G
from recsmith.operators.alias import TICKS
from recsmith.operators.retrieval import topk_similar
from recsmith.operators.skipgram import skipgram_embeddings
from recsmith.plans.recall import _split_sql, recall_split
from recsmith.plans.registry import register
from recsmith.session import cut_lineage
from recsmith.sources.fixtures import CLICKS_SQL, clicks

_BASE = f"""{_split_sql(CLICKS_SQL)},
cnt AS (SELECT item_id, count(*) AS c FROM train GROUP BY item_id),
seq AS (SELECT user_id, item_id, time, row_number() OVER w - 1 AS pos, lead(item_id) OVER w AS nxt,
               lead(time) OVER w AS nt
        FROM train WINDOW w AS (PARTITION BY user_id ORDER BY time, item_id)),
s2 AS (SELECT s.*, ci.c AS ai, cj.c AS aj, abs(s.nt - s.time) / 43200.0::DOUBLE AS dt
       FROM seq s JOIN cnt ci ON ci.item_id = s.item_id JOIN cnt cj ON cj.item_id = s.nxt WHERE s.nxt IS NOT NULL),
edges AS (SELECT user_id, CAST(pos AS INT) AS pos, 0 AS dir, item_id AS src, nxt AS dst,
                 greatest(3.0::DOUBLE, ln(1.0::DOUBLE + CAST(ai AS DOUBLE) / CAST(aj AS DOUBLE))) / (1.0::DOUBLE + dt) AS weight
          FROM s2
          UNION ALL
          SELECT user_id, CAST(pos AS INT), 1, nxt, item_id,
                 greatest(3.0::DOUBLE, ln(1.0::DOUBLE + CAST(aj AS DOUBLE) / CAST(ai AS DOUBLE))) * 0.8::DOUBLE / (1.0::DOUBLE + dt)
          FROM s2),
graph AS (SELECT src, dst, weight FROM (SELECT *, row_number() OVER (PARTITION BY src, dst
            ORDER BY user_id DESC, pos DESC, dir DESC) AS rn FROM edges) WHERE rn = 1),
ugraph AS (SELECT DISTINCT least(item_id, nxt) AS src, greatest(item_id, nxt) AS dst, 1.0::DOUBLE AS weight FROM s2)"""


def _train(spark, sf_dir):
    return recall_split(clicks(spark, sf_dir))[0]


def directed_graph(spark, sf_dir):
    return G.build_graph(G.build_edges(_train(spark, sf_dir), direction=True), direction=True)


def undirected_graph(spark, sf_dir):
    return G.build_graph(G.build_edges(_train(spark, sf_dir), direction=False), direction=False)


@register("graph_edges", f"WITH {_BASE}\nSELECT user_id, pos, dir, src, dst, round(weight, 6) AS weight FROM edges")
def q_graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1: weighted forward and reverse edges between consecutive clicks."""
    e = G.build_edges(_train(spark, sf_dir), direction=True)
    return e.select("user_id", F.col("pos").cast("int").alias("pos"), "dir", "src", "dst",
                    F.round("weight", 6).alias("weight"))


@register("graph_build", f"WITH {_BASE}\nSELECT src, dst, round(weight, 6) AS weight FROM graph")
def q_graph_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G2 directed: one edge per (src, dst), last write wins."""
    return directed_graph(spark, sf_dir).select("src", "dst", F.round("weight", 6).alias("weight"))


@register("graph_undirected", f"WITH {_BASE}\nSELECT src, dst, weight FROM ugraph")
def q_graph_undirected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G2 undirected: unit edges keyed by the unordered pair."""
    return undirected_graph(spark, sf_dir)


@register("degree_reweight", f"""WITH {_BASE},
deg AS (SELECT node, count(*) AS d FROM (SELECT src AS node FROM graph UNION ALL SELECT dst FROM graph) GROUP BY node),
j AS (SELECT g.src, g.dst, g.weight, CAST(a.d AS DOUBLE) / CAST(b.d AS DOUBLE) AS r
      FROM graph g JOIN deg a ON a.node = g.src JOIN deg b ON b.node = g.dst)
SELECT src, dst, round(weight * CASE WHEN r < 1 THEN greatest(0.1::DOUBLE, r) ELSE least(3.0::DOUBLE, r) END, 6) AS weight
FROM j""")
def q_degree_reweight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights scaled by the clamped degree ratio."""
    r = G.degree_reweight(directed_graph(spark, sf_dir))
    return r.select("src", "dst", F.round("weight", 6).alias("weight"))


@register("transition_probs_first", f"""WITH {_BASE}
SELECT src, dst, round(weight / sum(weight) OVER (PARTITION BY src), 6) AS prob FROM graph""")
def q_transition_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G4 first order: w / sum of the source's out-weights."""
    first, _ = G.transition_probs(directed_graph(spark, sf_dir))
    return first.select("src", "dst", F.round("prob", 6).alias("prob"))


@register("transition_probs", f"""WITH {_BASE},
j AS (SELECT tv.src AS t, tv.dst AS v, vx.dst AS x, vx.weight AS w,
             EXISTS (SELECT 1 FROM graph g WHERE g.src = vx.dst AND g.dst = tv.src) AS xt
      FROM graph tv JOIN graph vx ON tv.dst = vx.src),
u AS (SELECT *, w * CASE WHEN x = t THEN 0.5::DOUBLE WHEN xt THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS u FROM j)
SELECT t, v, x, round(u / sum(u) OVER (PARTITION BY t, v), 6) AS prob FROM u""")
def q_transition_probs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G4 second order (p = 2, q = 0.5) for every (t -> v -> x)."""
    _, second = G.transition_probs(directed_graph(spark, sf_dir))
    return second.select("t", "v", "x", F.round("prob", 6).alias("prob"))


_WALK_SQL = f"""WITH RECURSIVE {_BASE},
adj AS (SELECT src, dst FROM ugraph UNION ALL SELECT dst, src FROM ugraph WHERE src <> dst),
nb AS (SELECT src AS node, dst, row_number() OVER (PARTITION BY src ORDER BY dst) - 1 AS k,
              count(*) OVER (PARTITION BY src) AS deg FROM adj),
nodes AS (SELECT src AS node FROM ugraph UNION SELECT dst FROM ugraph),
walks(start, walk, step, node) AS (
  SELECT node, w.walk, 0, node FROM nodes CROSS JOIN range({G.NUM_WALKS}) AS w(walk)
  UNION ALL
  SELECT wk.start, wk.walk, wk.step + 1, nb.dst
  FROM walks wk JOIN nb ON nb.node = wk.node
   AND nb.k = CAST(('0x' || substr(md5(concat_ws('|', wk.start, wk.walk, wk.step + 1)), 1, 8)) AS BIGINT) % nb.deg
  WHERE wk.step + 1 < {G.WALK_LENGTH})
SELECT start, CAST(walk AS INT) AS walk, CAST(step AS INT) AS step, node FROM walks"""


@register("uniform_walks", _WALK_SQL)
def q_uniform_walks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G5 (+J9): 80 uniform walks of length 20 from every node of the
    undirected click graph."""
    return G.uniform_walks(undirected_graph(spark, sf_dir))


def _u_sql(*parts: str) -> str:
    return f"(CAST(('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE)"


def alias_sql(rows: str, group: str, choice: str, ticks: str) -> str:
    """CTE chain of the alias table of integer weights: ends with
    ``slots(g, slot, c, cut, alias, size, n)``."""
    return f"""weighed AS (SELECT {group} AS g, {choice} AS c, CAST({ticks} AS HUGEINT) AS t,
       sum(CAST({ticks} AS HUGEINT)) OVER (PARTITION BY {group}) AS size, count(*) OVER (PARTITION BY {group}) AS n,
       row_number() OVER (PARTITION BY {group} ORDER BY {choice}) - 1 AS slot FROM {rows}),
ag AS (SELECT *, n * t > size AS heavy, abs(n * t - size) AS gap FROM weighed),
ae AS (SELECT *, sum(gap) OVER (PARTITION BY g, heavy ORDER BY c) AS fin, lead(c) OVER (PARTITION BY g, heavy ORDER BY c) AS nxt FROM ag),
light AS (SELECT * FROM ae WHERE NOT heavy AND gap > 0), heavy AS (SELECT * FROM ae WHERE heavy),
spent AS (SELECT h.g, h.c, max(l.fin) AS used FROM heavy h JOIN light l ON l.g = h.g AND l.fin - l.gap < h.fin GROUP BY h.g, h.c),
slots AS (SELECT g, slot, c, size AS cut, c AS alias, size, n FROM ae WHERE gap = 0
  UNION ALL SELECT l.g, l.slot, l.c, l.n * l.t, h.c, l.size, l.n FROM light l JOIN heavy h
            ON h.g = l.g AND h.fin - h.gap <= l.fin - l.gap AND l.fin - l.gap < h.fin
  UNION ALL SELECT h.g, h.slot, h.c, h.size - greatest(0, coalesce(s.used, 0) - h.fin), coalesce(h.nxt, h.c), h.size, h.n
            FROM heavy h LEFT JOIN spent s ON s.g = h.g AND s.c = h.c)"""


_P, _Q = G.RETURN_P, G.INOUT_Q
_AMAX = max(1.0 / _P, 1.0, 1.0 / _Q)
_BIASED_SQL = f"""WITH RECURSIVE {_BASE},
tk AS (SELECT src, dst, greatest(1, CAST(round(weight / max(weight) OVER (PARTITION BY src) * {float(TICKS)}::DOUBLE) AS BIGINT)) AS ticks
       FROM graph WHERE weight > 0),
{alias_sql('tk', 'src', 'dst', 'ticks')},
tab AS MATERIALIZED (SELECT g, CAST(slot AS BIGINT) AS slot, c, CAST(cut AS DOUBLE) AS cut, alias, CAST(size AS DOUBLE) AS size, CAST(n AS BIGINT) AS n FROM slots),
deg AS MATERIALIZED (SELECT DISTINCT g, n FROM tab),
back AS MATERIALIZED (SELECT src, dst FROM graph),
nodes AS (SELECT src AS node FROM graph UNION SELECT dst FROM graph),
-- one proposal for every walker that still moves, a row of attempt 0 is a step taken
tries(start, walk, step, a, cur, prev) AS (
  SELECT node, CAST(w.walk AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), node, CAST(NULL AS BIGINT) FROM nodes CROSS JOIN range({G.NUM_WALKS}) AS w(walk)
  UNION ALL
  SELECT start, walk, CASE WHEN ok THEN step + 1 ELSE step END, CASE WHEN ok THEN 0 ELSE a + 1 END,
         CASE WHEN ok THEN x ELSE cur END, CASE WHEN ok THEN cur ELSE prev END
  FROM (SELECT p.*, {_u_sql('p.start', 'p.walk', 'p.step + 1', 'p.a', "'a'")} <
               CASE WHEN p.prev IS NULL THEN {_AMAX}::DOUBLE WHEN p.x = p.prev THEN {1.0 / _P}::DOUBLE
                    WHEN b.src IS NOT NULL THEN 1.0::DOUBLE ELSE {1.0 / _Q}::DOUBLE END / {_AMAX}::DOUBLE AS ok
        FROM (SELECT t.*, CASE WHEN {_u_sql('t.start', 't.walk', 't.step + 1', 't.a', "'c'")} * tab.size < tab.cut
                               THEN tab.c ELSE tab.alias END AS x
              FROM tries t JOIN deg ON deg.g = t.cur JOIN tab ON tab.g = t.cur
               AND tab.slot = least(CAST(floor({_u_sql('t.start', 't.walk', 't.step + 1', 't.a', "'s'")} * deg.n) AS BIGINT), deg.n - 1)
              WHERE t.step + 1 < {G.WALK_LENGTH}) p
        LEFT JOIN back b ON b.src = p.x AND b.dst = p.prev))
SELECT start, CAST(walk AS INT) AS walk, CAST(step AS INT) AS step, cur AS node FROM tries WHERE a = 0"""


@register("biased_walks", _BIASED_SQL)
def q_biased_walks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """node2vec walks (p = 2, q = 0.5) on the weighted directed graph,
    proposals from the alias table."""
    return G.biased_walks(directed_graph(spark, sf_dir))


def _embeddings(spark, sf_dir):
    walks = cut_lineage(G.uniform_walks(undirected_graph(spark, sf_dir)))
    return skipgram_embeddings(walks, G.EMBED_SIZE, G.WINDOW_SIZE, G.EPOCHS)


@register("node_embeddings")
def q_node_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G7 (rows-only): skip-gram vectors (dim 128, window 10, 3 epochs)
    over the uniform walks, one row per place."""
    emb = _embeddings(spark, sf_dir)
    return emb.select("node", F.posexplode("vec").alias("place", "value")).select("node", "place", F.round(F.col("value").cast("double"), 6).alias("value"))


@register("most_similar_nodes")
def q_most_similar_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G8 (rows-only): 50 nearest nodes by cosine in the learned space,
    self excluded."""
    emb = _embeddings(spark, sf_dir)
    q = emb.select(F.col("node").alias("qid"), "vec")
    i = emb.select(F.col("node").alias("item_id"), "vec")
    return topk_similar(q, i, k=50, cosine=True, exclude_self=True)
