"""DuckDB counterparts of the queries on vectors, by comparing everything with everything."""

from __future__ import annotations

_FINITE = "embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0"


def clustering_sql(dims: int = 64, factor: int = 64, clusters: int = 16, rounds: int = 3, seed: int = 1) -> str:
    steps = [
        f"""kept AS (
            SELECT row_number() OVER () AS rid, vec_id,
                   [CAST(floor({factor} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
            FROM embeddings WHERE {_FINITE} AND len(embedding) = {dims}
        )""",
        "flat AS (SELECT rid, unnest(range(len(v))) AS place, unnest(v) AS x FROM kept)",
        f"""first AS (
            SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id) NULLS LAST, v) - 1 AS cluster, v FROM kept
            ORDER BY 1 LIMIT {clusters}
        )""",
        "c0 AS (SELECT cluster, unnest(range(len(v))) AS place, unnest(v) AS x FROM first)",
    ]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS (
            SELECT rid, cluster, distance FROM (
                SELECT f.rid, c.cluster, CAST(sum((f.x - c.x) * (f.x - c.x)) AS BIGINT) AS distance,
                       row_number() OVER (PARTITION BY f.rid ORDER BY sum((f.x - c.x) * (f.x - c.x)), c.cluster) AS place
                FROM flat f JOIN c{i} c USING (place) GROUP BY f.rid, c.cluster
            ) WHERE place = 1
        )""")
        if i < rounds:
            steps.append(f"""m{i} AS (
                SELECT cluster, place, CAST(floor(CAST(sum(x) AS DOUBLE) / count(*)) AS BIGINT) AS x
                FROM flat JOIN a{i} USING (rid) GROUP BY cluster, place
            ), c{i + 1} AS (
                SELECT c.cluster, c.place, coalesce(m.x, c.x) AS x
                FROM c{i} c LEFT JOIN m{i} m ON c.cluster = m.cluster AND c.place = m.place
            )""")
    return f"""
        WITH {", ".join(steps)}, digests AS (
            SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY place)) AS centroid_sha256
            FROM c{rounds} GROUP BY cluster
        )
        SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance,
               CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
               CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
        FROM a{rounds} JOIN kept USING (rid) JOIN digests USING (cluster)
    """


def compression_sql(dims: int = 64, parts: int = 8, factor: int = 4096, entries: int = 16, rounds: int = 6) -> str:
    width = dims // parts
    steps = [
        f"""kept AS (
            SELECT row_number() OVER () AS rid, vec_id, label,
                   [CAST(floor({factor} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
            FROM embeddings WHERE {_FINITE} AND len(embedding) = {dims}
        )""",
        f"""flat AS (
            SELECT rid, place // {width} AS part, place % {width} AS place, x
            FROM (SELECT rid, unnest(range(len(v))) AS place, unnest(v) AS x FROM kept)
        )""",
        f"""first AS (
            SELECT rid, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS entry FROM kept ORDER BY 2 LIMIT {entries}
        )""",
        "c0 AS (SELECT part, entry, place, x FROM flat JOIN first USING (rid))",
    ]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS (
            SELECT rid, part, entry, distance FROM (
                SELECT f.rid, f.part, c.entry, CAST(sum((f.x - c.x) * (f.x - c.x)) AS BIGINT) AS distance,
                       row_number() OVER (
                           PARTITION BY f.rid, f.part ORDER BY sum((f.x - c.x) * (f.x - c.x)), c.entry
                       ) AS place
                FROM flat f JOIN c{i} c ON f.part = c.part AND f.place = c.place GROUP BY f.rid, f.part, c.entry
            ) WHERE place = 1
        )""")
        if i < rounds:
            steps.append(f"""m{i} AS (
                SELECT f.part, a.entry, f.place, CAST(floor(CAST(sum(f.x) AS DOUBLE) / count(*)) AS BIGINT) AS x
                FROM flat f JOIN a{i} a ON f.rid = a.rid AND f.part = a.part GROUP BY f.part, a.entry, f.place
            ), c{i + 1} AS (
                SELECT c.part, c.entry, c.place, coalesce(m.x, c.x) AS x
                FROM c{i} c LEFT JOIN m{i} m ON c.part = m.part AND c.entry = m.entry AND c.place = m.place
            )""")
    return f"""
        WITH {", ".join(steps)}, coded AS (
            SELECT rid, string_agg(lpad(lower(to_hex(entry)), 2, '0'), '' ORDER BY part) AS code,
                   CAST(sum(distance) AS BIGINT) AS error
            FROM a{rounds} GROUP BY rid
        )
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
               (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, place)) FROM c{rounds}) AS codebooks_sha256
        FROM coded JOIN kept USING (rid)
    """
