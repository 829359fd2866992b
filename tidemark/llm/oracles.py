"""SQL over the sample tables that the operators SQL can express must equal."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

EXACT_DEDUP = f"""
SELECT DISTINCT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256
FROM (
    SELECT doc_id, norm, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size
    FROM (SELECT doc_id, {_LOWER} AS norm FROM documents)
)
"""

# Words as Spark's: cut at space and the controls 9 to 13.
_WORDS = f"list_filter(string_split_regex({_LOWER}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
# Shingles of five words; an item of fewer is one shingle of all its words.
DECONTAMINATION = f"""
WITH item_words AS (SELECT item_id, w, least(5, len(w)) AS n FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
items AS (
    SELECT DISTINCT item_id, list_aggregate(w[i:i + n - 1], 'string_agg', ' ') AS gram
    FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM item_words)
),
doc_words AS (
    SELECT doc_id, w, n FROM (SELECT doc_id, {_WORDS} AS w FROM documents), (SELECT DISTINCT n FROM item_words) WHERE len(w) >= n
),
docs AS (
    SELECT DISTINCT doc_id, list_aggregate(w[i:i + n - 1], 'string_agg', ' ') AS gram
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc_words)
),
sizes AS (SELECT item_id, count(*) AS item_shingles FROM items GROUP BY item_id)
SELECT doc_id, item_id, count(*) AS shared, item_shingles, count(*) / item_shingles AS containment
FROM docs JOIN items USING (gram) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id, item_shingles
HAVING count(*) >= 0.8 * item_shingles
"""

# Each level of hosts adds its rate, shrunk to its parent's with the strength found for the level.
_STRENGTH = """
SELECT 1 / least(greatest(coalesce((sum(s) - sum(free)) / nullif(greatest(sum(mass) - sum(free), 0), 0), 1e-4), 1e-4), 0.5) - 1 AS m
FROM (
    SELECT sum(n * pow(good / n - p, 2) / (p * (1 - p))) AS s, count(*) - 1 AS free, sum(n) - sum(n * n) / sum(n) AS mass
    FROM {children} WHERE n > 0 GROUP BY {parent}
)
"""
URL_FILTER = f"""
WITH marks AS (
    SELECT doc_id AS page_id, count(*) AS n, sum(quality) AS good
    FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id
),
cut AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
),
judged AS (
    SELECT page_id,
        translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
    FROM cut
),
hosts AS (
    SELECT host, string_split(regexp_replace(host, ':[0-9]*$', ''), '.') AS parts, coalesce(sum(n), 0)::DOUBLE AS n,
        coalesce(sum(good), 0)::DOUBLE AS good
    FROM judged LEFT JOIN marks USING (page_id) GROUP BY host
),
named AS (
    SELECT host, n, good, parts[-1] AS suffix,
        CASE WHEN len(parts) < 2 THEN parts[-1] ELSE parts[-2] || '.' || parts[-1] END AS domain
    FROM hosts
),
overall AS (SELECT (sum(good) + 1) / (sum(n) + 2) AS p FROM named),
suffixes AS (
    SELECT suffix, sum(n) AS n, sum(good) AS good, any_value(p) AS p FROM named, overall GROUP BY suffix
),
suffix_m AS ({_STRENGTH.format(children="suffixes", parent="p")}),
suffix_rate AS (SELECT suffix, (good + p * m) / (n + m) AS p FROM suffixes, suffix_m),
domains AS (
    SELECT suffix, domain, sum(n) AS n, sum(good) AS good, any_value(p) AS p
    FROM named JOIN suffix_rate USING (suffix) GROUP BY suffix, domain
),
domain_m AS ({_STRENGTH.format(children="domains", parent="suffix")}),
domain_rate AS (SELECT domain, (good + p * m) / (n + m) AS p FROM domains, domain_m),
children AS (SELECT host, domain, n, good, p FROM named JOIN domain_rate USING (domain)),
host_m AS ({_STRENGTH.format(children="children", parent="domain")}),
posterior AS (
    SELECT host, good + p * m AS a, n - good + (1 - p) * m AS b FROM children, host_m
),
bounds AS (
    SELECT host, a / (a + b) AS mean, a / (a + b) + 2 * sqrt(a / (a + b) * (b / (a + b)) / (a + b + 1)) AS upper
    FROM posterior
),
rules(action, rule_host, rule_path) AS (
    VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
),
ruled AS (
    SELECT page_id, host, path, rule_host || rule_path AS rule, action, mean, upper,
        row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(rule_host || rule_path) DESC) AS nth
    FROM judged JOIN bounds USING (host)
    LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT page_id, host, path, rule, coalesce(action, CASE WHEN upper < 0.5 THEN 'block' ELSE 'allow' END) AS verdict,
    round(mean, 9) AS good_mean, round(upper, 9) AS good_upper
FROM ruled WHERE nth = 1
"""


def _centroids(rounds: int = 5, k: int = 40, dimensions: int = 64) -> str:
    near = (
        "SELECT r, min(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * {k} + cluster) AS best "
        "FROM kept, c{t} GROUP BY r"
    )
    steps = [
        f"""kept AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda v: CAST(floor(256 * CAST(v AS DOUBLE)) AS BIGINT)) AS x
            FROM embeddings
            WHERE len(embedding) = {dimensions} AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
        )""",
        f"""c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS cluster, x AS c
            FROM kept ORDER BY sha256('2:' || vec_id) LIMIT {k}
        )""",
    ]
    for t in range(rounds):
        steps += [
            f"a{t} AS MATERIALIZED ({near.format(k=k, t=t)})",
            f"""m{t} AS (
                SELECT cluster, list(CAST((s - ((s % n + n) % n)) // n AS BIGINT) ORDER BY d) AS c
                FROM (
                    SELECT best % {k} AS cluster, d, sum(x[d]) AS s, count(*) AS n
                    FROM a{t} JOIN kept USING (r), range(1, {dimensions + 1}) AS dims(d) GROUP BY ALL
                ) GROUP BY cluster
            )""",
            f"c{t + 1} AS MATERIALIZED (SELECT cluster, coalesce(m{t}.c, c{t}.c) AS c FROM c{t} LEFT JOIN m{t} USING (cluster))",
        ]
    steps.append(f"a{rounds} AS MATERIALIZED ({near.format(k=k, t=rounds)})")
    return f"""
WITH {", ".join(steps)}
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(best // {k} AS BIGINT) AS distance,
    CAST(sum(best // {k}) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
    CAST(sum(best // {k}) OVER () AS BIGINT) AS inertia,
    sha256(array_to_string(c, ',')) AS centroid_sha256
FROM (SELECT r, best, best % {k} AS cluster FROM a{rounds}) JOIN kept USING (r) JOIN c{rounds} USING (cluster)
"""


CENTROID_CLUSTERING = _centroids()

WARC = """
SELECT page_id, strlen(body) AS payload_bytes, digest AS payload_digest,
    CASE WHEN strlen(body) >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN strlen(body) >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM (
    SELECT *, min(page_id) OVER (PARTITION BY digest) AS first_id
    FROM (SELECT page_id, coalesce(html, '') AS body, sha256(coalesce(html, '')) AS digest FROM pages)
)
"""
