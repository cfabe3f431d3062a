"""SQL twins of the operators that SQL can express, over the given tables."""

from __future__ import annotations

_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

OP3_BYTE_SHARDS = """
WITH sized AS (
  SELECT doc_id, coalesce(strlen(text), 0) + 1 AS size, coalesce(md5(text), '') AS h, coalesce(text, '') AS t
  FROM documents),
placed AS (
  SELECT *, sum(size) OVER w - size AS off, row_number() OVER w - 1 AS i,
    sum(size) OVER () AS total
  FROM sized WINDOW w AS (ORDER BY h, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING)),
spans AS (SELECT h, min(off) AS a, max(off + size) AS b FROM placed GROUP BY h),
cuts AS (
  SELECT k, CASE WHEN a IS NULL OR (b - a) * 8 > total / 64 THEN t WHEN t - a <= b - t THEN a ELSE b END AS cut
  FROM (SELECT k, total, total * k // 8 AS t FROM range(1, 8) r(k), (SELECT sum(size) AS total FROM sized))
  LEFT JOIN spans ON a < t AND t < b),
dealt AS (SELECT p.*, (SELECT count(*) FROM cuts WHERE p.off >= cut)::INTEGER AS shard FROM placed p),
shifts AS (
  SELECT list(c ORDER BY n) AS tab FROM (
    SELECT n, list_reduce([n] || [0, 0, 0, 0, 0, 0, 0, 0],
      lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
    FROM range(0, 256) r(n))),
crcs AS (
  SELECT h, CASE WHEN any_value(t) = '' THEN 0 ELSE xor(list_reduce(
      [4294967295] || list_transform(string_split(regexp_replace(hex(any_value(t)), '(..)', '\\1 ', 'g'), ' ')[:-2], lambda x: ('0x' || x)::BIGINT),
      lambda c, b: xor(c // 256, any_value(tab)[(xor(c, b) % 256 + 1)::INTEGER])), 4294967295) END AS crc
  FROM dealt, shifts GROUP BY h)
SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'bytes' AS law, shard,
  (i - min(i) OVER (PARTITION BY shard))::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM dealt JOIN crcs USING (h)
"""

OP9_MIXTURE = f"""
WITH sized AS (
  SELECT doc_id, source, {_WORDS}::BIGINT AS size, md5('mix-1:' || coalesce(doc_id::VARCHAR, '')) AS place FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS s, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
  FROM sized GROUP BY source),
sorted AS (
  SELECT *, s * 3 AS cap, s * 3 / w AS r,
    coalesce(sum(s * 3) OVER b, 0) AS caps, coalesce(sum(w) OVER b, 0) AS ws,
    sum(s) OVER () AS total, sum(w) OVER () AS weights
  FROM sources
  WINDOW b AS (ORDER BY s * 3 / w, w, source NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT min_by(l, r) AS l
  FROM (SELECT r, (total - caps)::DOUBLE / (weights - ws)::DOUBLE AS l FROM sorted) WHERE l <= r),
targets AS (
  SELECT source, s, least(cap::DOUBLE, coalesce(w::DOUBLE * l, cap::DOUBLE)) AS target FROM sorted LEFT JOIN level ON true),
rounds AS (
  SELECT *, floor(target)::BIGINT AS budget, CASE WHEN s > 0 THEN floor(target)::BIGINT // s ELSE 0 END AS n FROM targets),
placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY place, doc_id NULLS FIRST, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off
  FROM sized)
SELECT p.doc_id, p.size, r.s AS source_size, r.target,
  (r.n * p.size + least(greatest(r.budget - r.n * r.s - p.off, 0), p.size))::BIGINT AS taken
FROM placed p JOIN rounds r ON p.source IS NOT DISTINCT FROM r.source
"""

OP11_RESAMPLING = r"""
WITH shifts AS (
  SELECT list(c ORDER BY n) AS tab FROM (
    SELECT n, list_reduce([n] || [0, 0, 0, 0, 0, 0, 0, 0],
      lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
    FROM range(0, 256) r(n))),
numbered AS (SELECT row_number() OVER () AS i, doc_id, text FROM documents),
texts AS (SELECT i, text FROM numbered UNION ALL SELECT -1, text FROM benchmark),
words AS (
  SELECT i, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
  FROM texts),
counted AS (SELECT i, w, count(*) AS n FROM words GROUP BY i, w),
codes AS (
  SELECT w, xor(list_reduce(
      [4294967295] || list_transform(string_split(regexp_replace(hex(w), '(..)', '\1 ', 'g'), ' ')[:-2], lambda x: ('0x' || x)::BIGINT),
      lambda c, b: xor(c // 256, tab[(xor(c, b) % 256 + 1)::INTEGER])), 4294967295) % 10000 AS b
  FROM (SELECT DISTINCT w FROM counted), shifts),
features AS (SELECT i, b, sum(n)::BIGINT AS n FROM counted JOIN codes USING (w) GROUP BY i, b),
sums AS (
  SELECT b, coalesce(sum(n) FILTER (i >= 0), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (i < 0), 0)::DOUBLE AS t
  FROM features GROUP BY b),
gains AS (
  SELECT b, floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM sums) + 10000) / ((s + 1) * ((SELECT sum(t) FROM sums) + 10000)))) AS g
  FROM sums),
weights AS (
  SELECT i, sum(n)::BIGINT AS n_features, floor(sum(n * g) / sum(n))::BIGINT AS weight
  FROM features JOIN gains USING (b) GROUP BY i),
scores AS (
  SELECT i, doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((
      ('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5) / 4294967296)))::BIGINT AS score
  FROM numbered LEFT JOIN weights USING (i)),
ranks AS (
  SELECT i, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST, n_features) AS r, count(*) OVER () AS n
  FROM scores WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= n * 10 // 100 THEN r END AS rank
FROM scores LEFT JOIN ranks USING (i)
"""

OP13_HARD_NEGATIVES = """
WITH usable AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding FROM embeddings)
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
    list_inner_product(a.q, b.q)::BIGINT AS score
  FROM usable a JOIN usable b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score
  FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
ranked AS (
  SELECT p.anchor_id, positive_id, other AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other) AS rank
  FROM positives p JOIN scores s ON p.anchor_id = s.anchor_id AND NOT same
    AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5
"""
