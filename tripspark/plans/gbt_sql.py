"""Gradient-boosted regression trees in DuckDB SQL, the independent check of the tree models.

``boosted(rows)`` gives CTEs that fit the boosting of ``operators.training`` (20 trees of depth 5, 31 split candidates a feature, step 0.1,
squared loss) on the rows of a CTE (v, row_no, y, x, w), ``x`` the list of features, apart for each ``v``; rows of ``w`` 0 are scored, not fitted on. The last CTE ``boost`` has the
prediction of every row. The trees grow by a recursive CTE, a level of one tree an iteration, over all nodes at once: rows per
node, feature and bin, running sums over the bins, the split with the largest drop in squared error, rows moved to the children. Spark
samples rows for its split candidates above 10,000 rows; up to there it takes all, as here.
"""

from __future__ import annotations

TREES, DEPTH, BINS, STEP = 20, 5, 32, 0.1


def boosted(rows: str) -> str:
    return f"""
tall AS (SELECT v, row_no, w, unnest(range(len(x))) AS f, unnest(x) AS x FROM {rows}),
counted AS (SELECT v, f, x, count(*) AS n FROM tall WHERE w = 1 GROUP BY v, f, x),
ranked AS (SELECT *, sum(n) OVER w AS upto, lag(x) OVER w AS last_x, sum(n) OVER (PARTITION BY v, f) AS total,
  count(*) OVER (PARTITION BY v, f) AS n_values FROM counted WINDOW w AS (PARTITION BY v, f ORDER BY x)),
target AS (SELECT v, f, min(struct_pack(x := r.x, last_x := r.last_x)) AS s FROM ranked r JOIN range(1, {BINS}) k(k) ON r.n_values > {BINS}
  AND r.last_x IS NOT NULL AND 2 * upto - n > 2.0 * k.k * total / {BINS} GROUP BY v, f, k.k),
threshold AS (SELECT v, f, (x + last_x) / 2.0 AS t FROM ranked WHERE n_values <= {BINS} AND last_x IS NOT NULL
  UNION ALL SELECT DISTINCT v, f, (s.x + s.last_x) / 2.0 FROM target),
thresholds AS (SELECT v, f, list(t ORDER BY t) AS ts FROM threshold GROUP BY v, f),
binned AS MATERIALIZED (SELECT v, row_no, list(bin ORDER BY f) AS bins FROM (SELECT tall.*, CAST(coalesce(len(list_filter(ts, lambda t: t < tall.x)), 0) AS INTEGER) AS bin
  FROM tall LEFT JOIN thresholds USING (v, f)) GROUP BY v, row_no),
boost_steps AS (
  SELECT 0 AS step, v, row_no, y, CAST(0 AS DOUBLE) AS pred, CAST(y AS DOUBLE) AS res, CAST(1 AS BIGINT) AS node, bins, w FROM {rows} JOIN binned USING (v, row_no)
  UNION ALL
  SELECT * FROM (
    WITH cells AS (SELECT v, node, f, bin, count(*) AS n, sum(res) AS s FROM (SELECT v, node, res, unnest(range(len(bins))) AS f, unnest(bins) AS bin
        FROM boost_steps WHERE w = 1 AND step % {DEPTH + 1} < {DEPTH}) GROUP BY v, node, f, bin),
    sums AS (SELECT *, sum(n) OVER w AS nl, sum(s) OVER w AS sl, sum(n) OVER p AS nt, sum(s) OVER p AS st FROM cells
        WINDOW p AS (PARTITION BY v, node, f), w AS (PARTITION BY v, node, f ORDER BY bin)),
    best AS (SELECT v, node, f, bin FROM sums WHERE nl < nt
        QUALIFY row_number() OVER (PARTITION BY v, node ORDER BY sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) DESC, f, bin) = 1),
    leaf AS (SELECT v, node, avg(res) AS mean FROM boost_steps WHERE w = 1 AND step % {DEPTH + 1} = {DEPTH} GROUP BY v, node),
    next AS (SELECT b.step + 1 AS step, b.v, b.row_no, b.y, b.pred + coalesce(leaf.mean, 0) * CASE WHEN b.step < {DEPTH + 1} THEN 1 ELSE CAST({STEP} AS DOUBLE) END AS pred, b.res,
        CASE WHEN leaf.mean IS NOT NULL THEN 1 ELSE 2 * b.node + CASE WHEN b.bins[best.f + 1] > best.bin THEN 1 ELSE 0 END END AS node, b.bins, b.w, leaf.mean IS NOT NULL AS grown
        FROM boost_steps b LEFT JOIN best ON best.v = b.v AND best.node = b.node AND b.step % {DEPTH + 1} < {DEPTH}
        LEFT JOIN leaf ON leaf.v = b.v AND leaf.node = b.node AND b.step % {DEPTH + 1} = {DEPTH})
    SELECT step, v, row_no, y, pred, CASE WHEN grown THEN 2 * (y - pred) ELSE res END AS res, CAST(node AS BIGINT) AS node, bins, w FROM next
    WHERE step <= {TREES * (DEPTH + 1)})),
boost AS (SELECT v, row_no, pred FROM boost_steps WHERE step = {TREES * (DEPTH + 1)})
"""
