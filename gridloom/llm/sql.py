"""DuckDB SQL with the results of those queries that SQL can express.

op3 needs XXH64, op6 a tokenizer, op7 a template's state, op10 a model: tests hold them against brute force.
"""

from __future__ import annotations

from . import mixing, quality

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP1 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
h AS (SELECT page_id, octet_length(body) AS n, sha1(body) AS d, max(page_id) OVER (PARTITION BY body) AS first FROM p)
SELECT page_id, n AS payload_bytes,
    array_to_string(list_transform(range(32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[((('0x' || d[(i // 4) * 5 + 1 : (i // 4) * 5 + 5])::BIGINT >> (15 - 5 * (i % 4))) & 31) + 1]), '') AS payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM h"""


def op2(block: int = 16, shard_words: int = 1 << 20, seed: int = 11) -> str:
    draw = lambda x: f"('0x' || md5({x})[1:15])::BIGINT"
    weights = ", ".join(map(str, mixing.WEIGHTS))
    near = lambda shift: f"coalesce(floor(CASE WHEN total <> 0 THEN target * (seats {shift}e0 * n) / total END + 0.5e0), 0)"
    upto = lambda words: f"floor(quota * coalesce(({words})::DOUBLE / nullif(source_size, 0), 0) + 0.5e0)"
    return f"""
WITH d0 AS (SELECT doc_id, source, len({WORDS})::BIGINT AS size FROM documents),
k AS (SELECT greatest(1, ceil(sum(size) / {shard_words}.0))::BIGINT AS k FROM d0),
d AS (SELECT doc_id, source, size, {draw(f"'{seed}:' || doc_id || ':' || size")} AS o FROM d0),
r AS (SELECT *, o % k AS shard FROM d, k),
parts AS (SELECT shard, source, sum(size)::BIGINT AS words FROM r GROUP BY 1, 2),
s AS (SELECT source, sum(words)::BIGINT AS source_size FROM parts GROUP BY 1),
w AS (SELECT *, ([{weights}])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)}) + 1]::BIGINT AS weight, 2e0 * source_size AS cap FROM s),
l AS (SELECT *, cap / weight AS ratio, (1.5e0 * sum(source_size) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w WINDOW o AS (ORDER BY cap / weight, source NULLS LAST)),
f AS (SELECT arg_min(level, ratio) AS level FROM l WHERE level < ratio),
t AS (SELECT l.source, source_size, CASE WHEN f.level IS NULL THEN cap ELSE least(cap, f.level * weight) END AS target FROM l LEFT JOIN f ON true),
q1 AS (SELECT *, sum(target) OVER () AS total, count(*) OVER () AS n, floor(sum(target) OVER () / {block} + 0.5e0) AS seats, (ceil(source_size / {block}.0) * 2)::BIGINT AS cap FROM t),
q2 AS (SELECT *, greatest(0, least({near('- 0.5')} - 1, cap))::BIGINT AS low, least({near('+ 1.5')} + 1, cap)::BIGINT AS high FROM q1),
q3 AS (SELECT *, seats - sum(low) OVER () AS left_ FROM q2),
c AS (SELECT source, left_, target / (2 * k - 1) AS quotient, k FROM (SELECT *, unnest(range(low + 1, high + 1)) AS k FROM q3 WHERE high > low)),
m AS (SELECT source, count(*) AS more FROM (SELECT *, row_number() OVER (ORDER BY quotient DESC, source NULLS LAST, k) AS place FROM c) WHERE place <= left_ GROUP BY 1),
q AS (SELECT q3.source, source_size, low + coalesce(more, 0) AS quota FROM q3 LEFT JOIN m ON m.source IS NOT DISTINCT FROM q3.source),
u AS (SELECT parts.*, source_size, quota, sum(words) OVER (PARTITION BY parts.source ORDER BY shard) AS upto FROM parts JOIN q ON q.source IS NOT DISTINCT FROM parts.source),
p AS (SELECT shard, source, ceil(words / {block}.0)::BIGINT AS blocks, least({upto('upto')} - {upto('upto - words')}, 2 * ceil(words / {block}.0))::BIGINT AS quota FROM u),
b AS (SELECT *, coalesce(quota // nullif(blocks, 0), 0) AS passes, {draw(f"'{seed}:begin:' || shard || ':' || coalesce(source, 'null')")} % greatest(blocks, 1) AS begin_ FROM p),
a AS (SELECT r.*, b.blocks, b.passes, b.begin_, b.begin_ + b.quota - b.passes * b.blocks AS end_, sum(size) OVER (PARTITION BY r.shard, r.source ORDER BY o, doc_id, size ROWS UNBOUNDED PRECEDING) AS stop FROM r JOIN b ON b.shard = r.shard AND b.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target, (passes * size + greatest(0, least(stop, end_ * {block}) - greatest(stop - size, begin_ * {block})) + greatest(0, least(stop, (end_ - blocks) * {block}) - (stop - size)))::BIGINT AS taken
FROM a JOIN t ON t.source IS NOT DISTINCT FROM a.source"""


OP4 = r"""
WITH l AS (SELECT doc_id AS id, unnest(range(len(string_split(text, chr(10)))))::INT AS no, unnest(string_split(text, chr(10))) AS raw FROM documents WHERE text IS NOT NULL),
n AS (SELECT id, no, regexp_extract_all(lower(raw), '[^\x20\x09-\x0D]+') AS w FROM l),
u AS (SELECT w, len(w) AS n, min((id, no)) AS place FROM n WHERE len(w) > 0 GROUP BY 1),
e AS (SELECT *, unnest([{'s': 'f', 'x': w[:n // 2]}, {'s': 'r', 'x': w[n - n // 2 + 1:]}, {'s': 'f', 'x': w[:(n - 1) // 2]}, {'s': 'r', 'x': w[n - (n - 1) // 2 + 1:]}]) AS k FROM u WHERE n >= 8),
h AS (SELECT *, md5(k.s || array_to_string(k.x, ' ')) AS h FROM e),
pairs AS (SELECT DISTINCT a.w AS a, b.w AS b, greatest(a.place, b.place) AS later FROM h a JOIN h b ON a.h = b.h AND a.w <> b.w AND (a.n = b.n + 1 OR (a.n = b.n AND a.place > b.place))),
near AS (SELECT DISTINCT later FROM pairs WHERE CASE WHEN len(a) = len(b) THEN len(list_filter(range(1, len(a) + 1), lambda i: a[i] <> b[i])) = 1 ELSE len(list_filter(range(1, len(a) + 1), lambda i: a[:i - 1] || a[i + 1:] = b)) > 0 END),
s AS (SELECT n.id, n.no, len(n.w) = 0 AS blank, u.place = (n.id, n.no) AS first, near.later IS NOT NULL AS near FROM n LEFT JOIN u ON u.w = n.w LEFT JOIN near ON near.later = (n.id, n.no)),
g AS (SELECT id, count(*) AS n_lines, count(CASE WHEN NOT blank AND NOT first THEN 1 END) AS n_equal, count(CASE WHEN NOT blank AND first AND near THEN 1 END) AS n_near, string_agg(CASE WHEN blank OR (first AND NOT near) THEN raw END, chr(10) ORDER BY no) AS kept FROM s JOIN l USING (id, no) GROUP BY 1)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_equal, 0) AS n_equal, coalesce(n_near, 0) AS n_near, md5(coalesce(kept, '')) AS kept_md5 FROM documents LEFT JOIN g ON g.id = doc_id"""


def op5(window: int = 5) -> str:
    stops = ", ".join(f"'{w}'" for w in quality.STOP_WORDS)
    measures = {name: f"({above} + {more})" if below is None else f"coalesce(({above} + {more})::DOUBLE / nullif({below}, 0), 0)" for name, (above, more, below) in quality.MEASURES.items()}
    rules = " AND ".join(f"{measures[m]} {op} {bound!r}" for _, m, least, most in quality.RULES for op, bound in ((">=", least), ("<=", most)) if bound is not None)
    return f"""
WITH d AS (SELECT doc_id, {WORDS} AS w, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines, length(coalesce(text, '')) - length(translate(coalesce(text, ''), '{quality.SYMBOLS}', '')) AS n_symbols FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i + 1 : i + {window}], ' ') AS x FROM (SELECT doc_id, w, unnest(range(len(w) - {window - 1})) AS i FROM d WHERE len(w) >= {window})),
t AS (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS j FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, x) AS n FROM g) WHERE n > 1),
r AS (SELECT doc_id, sum(least({window}, coalesce(j - i, {window})))::BIGINT AS n_repeat_words FROM t GROUP BY 1),
c AS (SELECT doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars, n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, len(list_filter(w, lambda x: lower(x) IN ({stops}))) AS n_stop_words, len(lines) AS n_lines FROM d LEFT JOIN r USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM c)
SELECT *, NOT base_failed AND {rules} AS kept FROM b"""


OP8 = r"""
WITH iw AS (SELECT item_id, regexp_extract_all(lower(text), '[a-z0-9\x{80}-\x{10FFFF}]+') AS w FROM benchmark),
i AS (SELECT item_id, w, len(w) AS m, least(5, len(w)) AS g FROM iw WHERE len(w) > 0),
ig AS (SELECT item_id, m, g, x, count(*) AS c FROM (SELECT item_id, m, g, unnest(list_transform(range(m - g + 1), lambda s: array_to_string(w[s + 1 : s + g], ' '))) AS x FROM i) GROUP BY ALL),
dw AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9\x{80}-\x{10FFFF}]+') AS w FROM documents),
dg AS (SELECT doc_id, n, g, p, array_to_string(w[p + 1 : p + g], ' ') AS x FROM (SELECT doc_id, w, len(w) AS n, g, unnest(range(len(w) - g + 1)) AS p FROM dw, (SELECT DISTINCT g FROM i) WHERE len(w) >= g)),
hits AS (SELECT doc_id, n, item_id, m, dg.g, p, dg.x, c, least(m, n) - dg.g + 1 AS k FROM dg JOIN ig ON ig.x = dg.x AND ig.g = dg.g),
many AS (SELECT doc_id, item_id FROM hits GROUP BY 1, 2 HAVING count(*) >= 0.8 * (max(m - g + 1) + max(k)) / 1.8 - 1e-9),
st AS (SELECT *, unnest(range(greatest(0, p - k + 1), least(p, n - g + 1 - k) + 1)) AS s FROM hits SEMI JOIN many USING (doc_id, item_id)),
ov AS (SELECT doc_id, item_id, s, any_value(m) AS m, any_value(n) AS n, any_value(g) AS g, any_value(k) AS k, x, least(count(*), any_value(c)) AS o FROM st GROUP BY doc_id, item_id, s, x),
sim AS (SELECT doc_id, item_id, s, any_value(least(m, n)) AS words, sum(o) / (any_value(k) + any_value(m - g + 1) - sum(o)) AS similarity FROM ov GROUP BY doc_id, item_id, s)
SELECT doc_id, item_id, max(similarity) AS similarity, min_by(s, (-similarity, s))::INT AS start, any_value(words)::INT AS words FROM sim WHERE similarity >= 0.8 - 1e-12 GROUP BY 1, 2"""

def op9(shards: int = 8, seed: int = 7, size: int = 32 << 20, rows: int = 1 << 14) -> str:
    draw = lambda x: f"('0x' || md5({x})[1:15])::BIGINT"
    shard = lambda n: "list_reverse_sort([" + ", ".join(f"({draw(f"'{seed}:' || doc_id || ':{s}'")}, {s})" for s in range(n)) + "])[1][2]"
    chunk = 2 * rows
    return f"""
WITH RECURSIVE tab AS (SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS t),
h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
d AS (SELECT doc_id, (len(h) // 2 + 1)::BIGINT AS size, xor(list_reduce(list_transform(range(len(h) // 2), lambda i: ('0x' || h[2 * i + 1 : 2 * i + 2])::BIGINT), lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8), 4294967295::BIGINT), 4294967295::BIGINT) AS text_crc32 FROM h, tab),
k AS (SELECT greatest(1, ceil(sum(size) / {shards * size}.0), ceil(count(*) / {shards * rows}.0))::BIGINT AS buckets FROM d),
o AS (SELECT *, {shard(shards)}::INT AS shard, {shard(shards + 1)}::INT AS grown_shard, {draw(f"'{seed}:bucket:' || doc_id || ':' || size || ':' || text_crc32")} % buckets AS bucket FROM d, k),
r AS (SELECT *, row_number() OVER (PARTITION BY shard, bucket ORDER BY doc_id, size, text_crc32) - 1 AS rank, count(*) OVER (PARTITION BY shard, bucket) AS n FROM o),
b AS (SELECT shard, bucket, n, sum(n) OVER (PARTITION BY shard ORDER BY bucket) - n AS base FROM (SELECT DISTINCT shard, bucket, n FROM r)),
c AS (SELECT shard, bucket, base, unnest(range((n - 1) // {chunk} + 1)) AS chunk, n FROM b),
f AS (SELECT *, least({chunk}, n - chunk * {chunk}) - 1 AS i, range(least({chunk}, n - chunk * {chunk})) AS perm FROM c
    UNION ALL SELECT shard, bucket, base, chunk, n, i - 1, list_transform(perm, lambda x, place: CASE place - 1 WHEN i THEN perm[j + 1] WHEN j THEN perm[i + 1] ELSE x END) FROM (SELECT *, {draw(f"'{seed}:' || shard || ':' || bucket || ':' || chunk || ':' || i")} % (i + 1) AS j FROM f WHERE i > 0))
SELECT doc_id, size, text_crc32, 'key' AS law, r.shard, (base + r.rank // {chunk} * {chunk} + perm[r.rank % {chunk} + 1])::BIGINT AS slot, grown_shard
FROM r JOIN f ON f.shard = r.shard AND f.bucket = r.bucket AND f.chunk = r.rank // {chunk} AND f.i = 0"""


OP13 = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents),
h AS (SELECT *, len(units) AS n, [('0x' || x[8 * k + 1 : 8 * k + 8])::BIGINT for k in range(4)] AS h FROM d),
c AS (SELECT *, h[1] % (n + 1) AS a, h[2] % (n + 1) AS b, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 90 THEN 'plain' WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT doc_id, n, form, text, array_to_string(units[1 : least(a, b)], '') AS prefix, array_to_string(units[least(a, b) + 1 : greatest(a, b)], '') AS middle, array_to_string(units[greatest(a, b) + 1 : n], '') AS suffix FROM c),
o AS (SELECT *, CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END AS output FROM p),
i AS (SELECT *, strpos(output, '<P>') AS ip, strpos(output, '<S>') AS s, strpos(output, '<M>') AS m FROM o)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars, sha256(output) AS output_sha256,
    sha256(CASE form WHEN 'plain' THEN output WHEN 'psm' THEN substring(output, 4, s - 4) || substring(output, m + 3) || substring(output, s + 3, m - s - 3)
        ELSE substring(output, ip + 3, m - ip - 3) || substring(output, m + 3) || substring(output, 4, ip - 4) END) AS restored_sha256
FROM i"""


def op12(k: int = 8, rounds: int = 10, seed: int = 3, dim: int = 64, scale: int = 1024) -> str:
    """A pair of CTEs a round: vectors' clusters, and centroids."""
    kept = f"v AS MATERIALIZED (SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: floor({scale} * x)) AS v FROM embeddings WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dim})"
    first = f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS cluster, v AS c FROM v ORDER BY cluster LIMIT {k})"
    ctes = [kept, first]
    for r in range(rounds + 1):
        ctes.append(f"a{r} AS MATERIALIZED (SELECT vec_id, v, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS d FROM (SELECT n, vec_id, v, cluster, list_dot_product(v, v) - 2 * list_dot_product(v, c) + list_dot_product(c, c) AS d FROM (SELECT *, row_number() OVER () AS n FROM v), c{r}) GROUP BY n, vec_id, v)")
        if r < rounds:
            means = f"SELECT cluster, list(x ORDER BY i) AS c FROM (SELECT cluster, i, floor(sum(x) / count(*)) AS x FROM (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{r}) GROUP BY ALL) GROUP BY ALL"
            ctes.append(f"c{r + 1} AS MATERIALIZED (SELECT o.cluster, coalesce(m.c, o.c) AS c FROM c{r} o LEFT JOIN ({means}) m USING (cluster))")
    return f"WITH {', '.join(ctes)} SELECT vec_id, cluster::INT AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(list_transform(c, lambda x: x::BIGINT), ',')) AS centroid_sha256 FROM a{rounds} JOIN c{rounds} USING (cluster)"


SQL = {"op1_warc": OP1, "op2_mixing": op2(), "op4_line_dedup": OP4, "op5_quality": op5(), "op8_decontaminate": OP8, "op9_sharding": op9(), "op12_centroids": op12(), "op13_fim": OP13}
