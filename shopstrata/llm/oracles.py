"""SQL for operators whose method is more than SQL, but whose result is not."""

TRIM = "trim(coalesce(text, ''), chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: str) -> str:
    return rf"CASE WHEN {text} = '' THEN []::VARCHAR[] ELSE string_split_regex({text}, '[\x20\x09-\x0D]+') END"


#: Every window of 35 words that occurs twice takes its words along.
REPEATS = f"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, {words(TRIM)} AS w FROM documents),
windows AS (
    SELECT r, i, array_to_string(list_slice(w, i, i + 34), ' ') AS s FROM w, LATERAL (SELECT unnest(range(1, len(w) - 33)) AS i)),
again AS (SELECT s FROM windows GROUP BY s HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS p FROM windows JOIN again USING (s)),
each AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM w),
kept AS (
    SELECT r, count(g.p) AS n_removed, string_agg(word, ' ' ORDER BY e.p) FILTER (g.p IS NULL) AS k
    FROM each e LEFT JOIN gone g USING (r, p) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (r)
"""

#: Shingle sets joined on shingles, links closed by recursion.
NEAR = f"""
WITH RECURSIVE w AS (
    SELECT doc_id, {words(f"translate({TRIM}, '{UPPER}', '{LOWER}')")} AS w FROM documents),
sets AS (
    SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') ELSE array_to_string(list_slice(w, i, i + 2), ' ') END AS s
    FROM w, LATERAL (SELECT unnest(range(1, greatest(len(w) - 1, 2))) AS i) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sets a JOIN sets b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY x, y),
links AS (
    SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 85 * (p.n + q.n - c)),
reach(x, y) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
least AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM least LEFT JOIN sizes USING (doc_id)
"""

#: All pairs of a label by cosine, links closed by recursion.
VECTORS = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
    SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach(x, y) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
least AS (SELECT x AS vec_id, min(y) AS component_id FROM reach GROUP BY x),
counted AS (SELECT x AS vec_id, count(*) AS n FROM links GROUP BY x)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM least LEFT JOIN counted USING (vec_id)
"""

_SCORE = "(('0x' || substr(md5(n || ':' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT + 0.5)"

#: The table of the checksum follows from its polynomial; bytes are folded in one by one.
SHARDS = f"""
WITH steps AS (
    SELECT list_transform(range(256), lambda b: list_reduce(
        list_prepend(b::BIGINT, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
sums AS (
    SELECT doc_id, coalesce(text, '') AS text, hex(encode(coalesce(text, ''))) AS h FROM documents),
checks AS (
    SELECT doc_id, strlen(text) AS bytes, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
        range(strlen(text)), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
    FROM sums, steps),
scored AS (SELECT doc_id, n, {_SCORE} AS u FROM documents, range(25) AS s(n)),
won AS (SELECT doc_id, arg_max(n, u) FILTER (n < 24) AS shard, arg_max(n, u) AS grown_shard FROM scored GROUP BY doc_id)
SELECT doc_id, (bytes + 8)::BIGINT AS size, text_crc32, 'key' AS law, shard::INTEGER AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY md5(doc_id::VARCHAR), doc_id) - 1 AS slot, grown_shard::INTEGER AS grown_shard
FROM won JOIN checks USING (doc_id)
"""

#: One byte after another into the checksum; ``steps`` holds its table.
STEPS = """steps AS (
    SELECT list_transform(range(256), lambda b: list_reduce(
        list_prepend(b::BIGINT, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"""


def crc32(text: str) -> str:
    return f"""xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(strlen({text})),
        lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"""


#: Islands of places that agree with the place one period on, for every period up to a third of a text.
RUNS = f"""
WITH {STEPS},
given AS (
    SELECT row_number() OVER () AS r, doc_id, {words(TRIM)} AS w,
           CASE WHEN doc_id IS NULL THEN 1 ELSE {crc32("doc_id::VARCHAR")} END AS h
    FROM documents, steps),
cut AS (SELECT *, len(w) AS n, h // 10 AS g, (h // 10) % greatest(len(w), 1) AS a FROM given),
shaped AS (
    SELECT r, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i:
        w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) ELSE w END AS w FROM cut),
each AS (SELECT r, n, unnest(w) AS word, unnest(range(n)) AS i FROM shaped),
agree AS (
    SELECT x.r, x.i, y.i - x.i AS q FROM each x JOIN each y ON x.r = y.r AND x.word = y.word AND y.i > x.i AND 3 * (y.i - x.i) <= x.n),
islands AS (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS k FROM agree),
stretches AS (SELECT r, q, min(i) AS s, count(*) + q AS l FROM islands GROUP BY r, q, k),
found AS (SELECT r, s, l, min(q) AS q FROM stretches WHERE l >= greatest(24, 3 * q) GROUP BY r, s, l),
best AS (SELECT * FROM found QUALIFY row_number() OVER (PARTITION BY r ORDER BY l::DOUBLE / q DESC, s, q) = 1),
listed AS (
    SELECT r, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS listing FROM found GROUP BY r),
gone AS (SELECT DISTINCT r, unnest(range(s + q, s + l)) AS i FROM found),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS k FROM each ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, s::BIGINT AS start, l::BIGINT AS length, q::BIGINT AS period,
       (1000 * l // q)::BIGINT AS exponent_milli, sha256(coalesce(listing, '')) AS runs_sha256, sha256(coalesce(k, '')) AS collapsed_sha256
FROM shaped LEFT JOIN listed USING (r) LEFT JOIN best USING (r) LEFT JOIN kept USING (r)
"""

#: Words that agree when a letter is left out, followed from form to form.
SPELLING = f"""
WITH RECURSIVE {STEPS},
found AS (
    SELECT coalesce(doc_id::VARCHAR, '') AS id,
           unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run
    FROM documents),
counted AS (SELECT id, run, id || ':' || run AS k, count(*) AS c FROM found GROUP BY id, run),
checked AS (SELECT run, c, {crc32("k")} AS h FROM counted, steps),
altered AS (
    SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c
    FROM checked),
words AS (SELECT word, sum(c)::BIGINT AS n FROM altered WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
less AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS v FROM words, LATERAL (SELECT unnest(range(1, length(word) + 1)) AS i)),
near AS (
    SELECT a.word, b.word AS other, b.n FROM less a JOIN less b ON a.v = b.v AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.v = b.word
    UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.v = b.word),
best AS (SELECT word, other, n, count(*) OVER (PARTITION BY word) AS n_near FROM near
         QUALIFY row_number() OVER (PARTITION BY word ORDER BY n DESC, other) = 1),
judged AS (
    SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
           CASE WHEN b.n >= 2 * w.n THEN other END AS form, CASE WHEN b.n >= 2 * w.n THEN b.n END AS form_n
    FROM words w LEFT JOIN best b USING (word)),
steps_on(word, spot) AS (
    SELECT word, word FROM judged UNION ALL SELECT s.word, j.form FROM steps_on s JOIN judged j ON j.word = s.spot WHERE j.form IS NOT NULL),
ends AS (SELECT s.word, s.spot AS root FROM steps_on s JOIN judged j ON j.word = s.spot WHERE j.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM judged JOIN ends USING (word)
"""
