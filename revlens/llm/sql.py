"""DuckDB SQL that must give the rows of a query."""


def _clustering(k=16, rounds=3) -> str:
    """Starting vectors, then assignment and replacement in turn, and a last assignment."""
    distance = "list_sum(list_transform(list_zip(n.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    steps = [
        """v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding::DOUBLE[], lambda x: floor(64 * x)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x) OR abs(64 * x::DOUBLE) >= 134217728)) = 0)""",
        f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), vec_id, v) - 1 AS k, v FROM v WHERE vec_id IS NOT NULL QUALIFY k < {k})""",
    ]
    for t in range(rounds + 1):
        steps.append(
            f"""a{t} AS MATERIALIZED (
  SELECT n.r, any_value(n.vec_id) AS vec_id, any_value(n.v) AS v, min({{'d': {distance}, 'k': c.k}}) AS best FROM v n CROSS JOIN c{t} c GROUP BY n.r)"""
        )
        if t < rounds:
            steps.append(
                f"""c{t + 1} AS MATERIALIZED (
  SELECT c.k, coalesce(m.v, c.v) AS v FROM c{t} c LEFT JOIN (
    SELECT k, list(mean ORDER BY i) AS v FROM (
      SELECT best.k AS k, i, ((sum(v[i]) - ((sum(v[i]) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS mean
      FROM a{t}, range(1, 65) t(i) GROUP BY best.k, i) GROUP BY k) m ON m.k = c.k)"""
            )
    return (
        "WITH "
        + ",\n".join(steps)
        + f"""
SELECT vec_id, best.k::INT AS cluster, best.d AS distance, (sum(best.d) OVER (PARTITION BY best.k))::BIGINT AS cluster_inertia,
  (sum(best.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} c ON c.k = best.k"""
    )


SQL = {
    "op11_centroid_clustering": _clustering(),
    "op1_ann": """
WITH v AS (
  SELECT vec_id, min(embedding::DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
  GROUP BY vec_id),
d AS (
  SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_reduce(list_transform(list_zip(q.e, c.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])), lambda a, b: a + b)) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INT) AS rank, vec_id, score
FROM d QUALIFY rank <= 10""",
}
