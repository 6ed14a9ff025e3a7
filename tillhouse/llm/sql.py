"""Checks of the queries in the SQL of DuckDB."""

QUALITY_RULES = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM d),
grams AS (SELECT r, i, w[i:i + 4] AS g FROM w, unnest(range(1, greatest(len(w) - 3, 1))) t(i)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM grams) WHERE c > 1),
covered AS (SELECT r, sum(least(5, coalesce(after - i, 5))) AS n
            FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS after FROM twice) GROUP BY r),
lines AS (SELECT r, host, text, unnest(string_split(text, chr(10))) AS line FROM d),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
norm AS (SELECT r, host, text, line, lower(trim(regexp_replace(regexp_replace(line, '[0-9]', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ')) AS l
         FROM lines),
hosts AS (SELECT host, count(DISTINCT text) AS n FROM d GROUP BY host),
common AS (SELECT c.host, c.l FROM (SELECT host, l, count(DISTINCT text) AS n FROM norm WHERE l <> '' GROUP BY host, l) c
           JOIN hosts h ON c.host IS NOT DISTINCT FROM h.host WHERE c.n >= 20 AND c.n > least(0.1 * h.n, 50)),
remain AS (SELECT n.r, sum(len(regexp_extract_all(n.line, '[^\x20\x09-\x0D]+'))) AS n FROM norm n
           LEFT JOIN common c ON n.host IS NOT DISTINCT FROM c.host AND n.l = c.l WHERE c.l IS NULL GROUP BY n.r),
m AS (SELECT d.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(length(array_to_string(w.w, '')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(d.text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
             CAST(coalesce(remain.n, 0) AS BIGINT) AS words_left
      FROM d JOIN w USING (r) LEFT JOIN covered USING (r) LEFT JOIN dup USING (r) LEFT JOIN remain USING (r))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND words_left >= 0.3 * n_words AS kept
FROM m
"""

MIXING = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         greatest(0.05, length(regexp_replace(coalesce(text, ''), '[^\p{L}]+', '', 'g')) / greatest(length(coalesce(text, '')), 1)) AS weight
  FROM documents),
c AS (SELECT *, row_number() OVER (PARTITION BY source, doc_id, weight) - 1 AS copy FROM d),
k AS (SELECT *, -ln((CAST('0x' || substr(md5('mix-1|' || coalesce(CAST(doc_id AS VARCHAR), '')
                                             || CASE WHEN copy > 0 THEN '|' || copy ELSE '' END), 1, 13) AS BIGINT) + 0.5)
                    / CAST(4503599627370496 AS DOUBLE)) / weight AS key FROM c),
s AS (SELECT source, CAST(sum(size) AS DOUBLE) AS n, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM d GROUP BY source),
sw AS (SELECT *, [5.0::DOUBLE, 2.0, 1.0][(rank - 1) % 3 + 1] AS w, 2 * n AS cap FROM s),
lv AS (SELECT *, (1.5::DOUBLE * sum(n) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(w) OVER (ORDER BY cap / w, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM sw),
t AS (SELECT *, coalesce(least(max(CASE WHEN level <= cap / w THEN level END) OVER () * w, cap), cap) AS target FROM lv),
p AS (SELECT doc_id, size, n, target, CASE WHEN n > 0 THEN floor(target / n) ELSE 0 END AS epochs,
             sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS prefix
      FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(n AS BIGINT) AS source_size, target,
       CAST(size * (epochs + CASE WHEN prefix - size / 2 <= target - epochs * n THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM p
"""

WARC = r"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
s AS (SELECT payload, max(page_id) AS last FROM p WHERE octet_length(payload) >= 1000 GROUP BY payload HAVING count(*) > 1)
SELECT page_id, CAST(octet_length(p.payload) AS BIGINT) AS payload_bytes, sha1(p.payload) AS payload_digest,
       CASE WHEN page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < last THEN last END AS refers_to
FROM p LEFT JOIN s ON p.payload = s.payload
"""

LINE_DEDUP = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, i, lines[i] AS line,
             translate(trim(lines[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
      FROM d, unnest(range(1, len(lines) + 1)) t(i)),
common AS (SELECT key, max(doc_id) AS last FROM l WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
j AS (SELECT l.*, coalesce(doc_id <> last, false) AS dropped FROM l LEFT JOIN common ON l.key = common.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, CAST(count(*) FILTER (dropped) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256
FROM j GROUP BY r
"""


def clusters(rounds: int = 10) -> str:
    """Assignment and update of the centroids, one pair of queries for each round."""
    parts = [r"""
WITH raw AS (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings WHERE len(embedding) = 64
             AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
v AS MATERIALIZED (SELECT r, vec_id, d, CAST(floor(1024 * CAST(embedding[d] AS DOUBLE)) AS BIGINT) AS x FROM raw, unnest(range(1, 65)) t(d)),
first AS (SELECT r, row_number() OVER (ORDER BY sha256('3:' || CAST(vec_id AS VARCHAR))) - 1 AS k FROM raw),
c0 AS MATERIALIZED (SELECT k, d, x AS c FROM v JOIN first USING (r) WHERE k < 8)"""]
    for i in range(rounds + 1):
        parts.append(f"""
n{i} AS MATERIALIZED (SELECT r, k, s FROM (SELECT r, k, CAST(sum((x - c) * (x - c)) AS BIGINT) AS s FROM v JOIN c{i} USING (d) GROUP BY r, k)
       QUALIFY row_number() OVER (PARTITION BY r ORDER BY s, k) = 1)""")
        if i < rounds:
            parts.append(f"""
m{i} AS (SELECT k, d, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM v JOIN n{i} USING (r) GROUP BY k, d)""")
            parts.append(f"""
c{i + 1} AS MATERIALIZED (SELECT k, d, coalesce((s - ((s % n) + n) % n) // n, c) AS c FROM c{i} LEFT JOIN m{i} USING (k, d))""")
    parts.append(f"""
h AS (SELECT k, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY k)
SELECT vec_id, CAST(k AS INTEGER) AS cluster, s AS distance, CAST(sum(s) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
       CAST(sum(s) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM n{rounds} JOIN raw USING (r) JOIN h USING (k)
""")
    return ",".join(parts[:-1]) + "," + parts[-1]


def merkle(levels: int = 9, part_levels: int = 5) -> str:
    """Trees of up to 8^levels rows a part and 8^part_levels parts; a level on top of a finished tree changes nothing."""
    run = """
{t}s{i} AS MATERIALIZED (SELECT tree, pos, n, h, coalesce(string_agg(h, '') OVER (g ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a,
             coalesce(string_agg(h, '') OVER (g ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS b
       FROM {t}{i} WINDOW g AS (PARTITION BY tree, pos // 8 ORDER BY pos)),
{t}{j} AS MATERIALIZED (SELECT tree, pos // 8 AS pos, (n + 7) // 8 AS n, CASE WHEN any_value(n) = 1 THEN any_value(h)
             ELSE sha256(string_agg(h, '' ORDER BY pos)) END AS h FROM {t}s{i} GROUP BY tree, pos // 8, (n + 7) // 8)"""
    step = """
{t}p{j} AS MATERIALIZED (SELECT p.* REPLACE (p.{pos} // 8 AS {pos}, CASE WHEN s.n = 1 THEN proof ELSE proof || a || b END AS proof,
             CASE WHEN s.n = 1 THEN folded ELSE sha256(a || folded || b) END AS folded)
       FROM {t}p{i} p JOIN {t}s{i} s ON p.{tree} = s.tree AND p.{pos} = s.pos)"""
    value = "coalesce(octet_length(encode({0})) || ':' || {0}, '-')"
    row = " || ".join(value.format(x) for x in (
        "CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)"))
    parts = [f"""
WITH bits AS (SELECT doc_id, lang, sha256({row} || {value.format("text")}) AS leaf,
             sha256({row} || {value.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}) AS changed,
             flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c:
               list_transform(range(8), lambda i: (ascii(c) >> CAST(i AS INTEGER)) & 1))) AS bits FROM documents),
d AS (SELECT doc_id, coalesce('=' || lang, '') AS tree, leaf, CASE WHEN xor(list_reduce(list_transform(bits, lambda b: CAST(b AS BIGINT)),
             lambda c, b: xor(c >> 1, (xor(c, b) & 1) * 3988292384), CAST(4294967295 AS BIGINT)), 4294967295) % 3 = 0
             THEN changed ELSE leaf END AS folded FROM bits),
base AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
             count(*) OVER (PARTITION BY tree) AS n FROM d),
r0 AS (SELECT tree, pos, n, leaf AS h FROM base)"""]
    parts += [run.format(t="r", i=i, j=i + 1) for i in range(levels)]
    parts.append(f"""
t0 AS MATERIALIZED (SELECT '' AS tree, tree AS part, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, count(*) OVER () AS n, h FROM r{levels})""")
    parts += [run.format(t="t", i=i, j=i + 1) for i in range(part_levels)]
    parts.append("""
rp0 AS (SELECT doc_id, tree, leaf, folded, pos, '' AS proof FROM base)""")
    parts += [step.format(t="r", i=i, j=i + 1, tree="tree", pos="pos") for i in range(levels)]
    parts.append(f"""
tp0 AS (SELECT doc_id, leaf, folded, proof, t0.pos AS place, t0.h AS subroot, '' AS top FROM rp{levels} p JOIN t0 ON p.tree = t0.part)""")
    parts += [step.format(t="t", i=i, j=i + 1, tree="top", pos="place") for i in range(part_levels)]
    return ",".join(parts) + f"""
SELECT doc_id, leaf, subroot, t{part_levels}.h AS root, sha256(proof) AS proof_sha256, folded AS folded_root,
       folded = t{part_levels}.h AS verified
FROM tp{part_levels} p JOIN t{part_levels} ON p.top = t{part_levels}.tree
"""


CLUSTERS = clusters()
MERKLE = merkle()
