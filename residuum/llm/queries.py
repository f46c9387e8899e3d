"""The corpus queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from residuum.llm import decontamination, html_text, line_dedup, near_dedup, packing, pii, prefix_trie, quality_rules, secret_scan, substring_dedup, tandem_runs, toxicity, weak_labels
from residuum.llm.common import documents, shared_folder

QUERIES = {}
ORACLES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_order_minhash(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return near_dedup.classes(docs).withColumnRenamed("id", "doc_id")


@query
def op2_blob_ledger(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    ledger = secret_scan.scan_into(docs, f"{shared_folder(spark)}/ledger-{uuid.uuid4().hex}")
    return secret_scan.digest(secret_scan.findings(docs, ledger))


@query
def op3_dominance_packing(spark, sf_dir):
    import public_tokenizers

    places = packing.pack(documents(spark, sf_dir).select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))
    return places.withColumnRenamed("id", "doc_id")


@query
def op4_risk_rules(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_rules.digest(quality_rules.apply(documents(spark, sf_dir).select("doc_id", "text", "lang"), labels))


@query
def op9_block_anchors(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return substring_dedup.digest(substring_dedup.removed(docs))


@query
def op5_boosted_pii(spark, sf_dir):
    return pii.digest(pii.find(documents(spark, sf_dir).select("doc_id", "text")))


@query
def op6_layout_text(spark, sf_dir):
    found, name = html_text.extract(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "html"))
    return html_text.digest(found, name)


@query
def op7_weak_labels(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = weak_labels.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    found, name = weak_labels.judged(docs, model, with_text=False)
    return found.select("doc_id", f"{name}.*")


@query
def op8_winnowing(spark, sf_dir):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found, name = decontamination.find(documents(spark, sf_dir).select("doc_id", "text"), benchmark)
    return decontamination.digest(found, name)


@query
def op10_prefix_join(spark, sf_dir):
    return line_dedup.digest(line_dedup.judged(documents(spark, sf_dir).select("doc_id", "text")))


@query
def op11_tandem_runs(spark, sf_dir):
    docs = tandem_runs.periodic(documents(spark, sf_dir).select("doc_id", "text"))
    return tandem_runs.digest(*tandem_runs.find(docs))


@query
def op12_toxic_segments(spark, sf_dir):
    """Of four folds by CRC-32 of the id, 2 is held out, 3 sets the shares and the others the word scores."""
    docs, labels = documents(spark, sf_dir).select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    fold = lambda c: F.crc32(F.col(c).cast("string").cast("binary")) % 4
    model = toxicity.train(docs, labels.where(fold("doc_id") != 2), calibrate=fold("id") == 3)
    found, name = toxicity.scored(docs, model)
    score = F.col(f"{name}.score")
    return found.select("doc_id", (fold("doc_id") == 2).alias("held_out"), score.alias("score"), (score >= 0.3).cast("int").alias("predicted"), F.size(f"{name}.passages").alias("n_passages"))


@query
def op13_prefix_trie(spark, sf_dir):
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    return prefix_trie.trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"), head)


ORACLES["op8_winnowing"] = r"""
WITH dw AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
bw AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark),
bwin AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM bw WHERE len(w) > 0)),
dpos AS (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM dw, (SELECT DISTINCT m FROM bwin) WHERE len(w) >= m),
found AS (
  SELECT d.doc_id, d.i, d.m, b.item_id
  FROM (SELECT doc_id, i, m, array_to_string(w[i:i + m - 1], ' ') AS s FROM dpos) d JOIN bwin b ON d.m = b.m AND d.s = b.s),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n, sha256(string_agg(k, ',' ORDER BY k)) AS sha
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS k FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(i.n, 0) AS BIGINT) AS n_items,
       coalesce(i.sha, sha256('')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM dw d LEFT JOIN hit h USING (doc_id) LEFT JOIN items i USING (doc_id)
"""

ORACLES["op9_block_anchors"] = r"""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM w WHERE len(w) >= 50)),
early AS (SELECT s, min(doc_id) AS m FROM win GROUP BY s HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + 50)) AS p FROM win JOIN early USING (s) WHERE doc_id > m)),
word AS (SELECT doc_id, w[p] AS x, p FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM w)),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(len(w.w) - coalesce(k.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256
FROM w LEFT JOIN kept k USING (doc_id)
"""

ORACLES["op10_prefix_join"] = r"""
WITH raw AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents WHERE text IS NOT NULL),
l AS (SELECT doc_id, pos, list_sort(list_distinct(list_filter(string_split_regex(lower(line), '[\x20\x09\x0A\x0D]+'), lambda x: x <> ''))) AS w FROM raw),
line AS (SELECT doc_id, pos, w FROM l WHERE len(w) > 0),
sets AS (SELECT w, row_number() OVER () AS s, arg_min(doc_id, {'d': doc_id, 'p': pos}) AS doc_id, arg_min(pos, {'d': doc_id, 'p': pos}) AS pos FROM line GROUP BY w),
tok AS (SELECT s, doc_id, pos, len(w) AS n, unnest(w) AS t FROM sets),
freq AS (SELECT t, count(*) AS c FROM tok GROUP BY t),
pre AS (SELECT s, doc_id, pos, n, t FROM (SELECT *, row_number() OVER (PARTITION BY s ORDER BY c, t) AS i FROM tok JOIN freq USING (t)) WHERE i <= n - ceil(0.9 * n - 1e-9) + 1),
cand AS (SELECT DISTINCT a.s AS a, b.s AS b FROM pre a JOIN pre b ON a.t = b.t AND (b.doc_id, b.pos) < (a.doc_id, a.pos) AND least(a.n, b.n) >= 0.9 * greatest(a.n, b.n) - 1e-9),
near AS (
  SELECT DISTINCT a FROM (SELECT a, len(list_intersect(x.w, y.w)) AS o, len(x.w) + len(y.w) AS n FROM cand JOIN sets x ON x.s = a JOIN sets y ON y.s = b)
  WHERE o >= 0.9 * (n - o) - 1e-9),
stay AS (SELECT doc_id, pos FROM sets WHERE s NOT IN (SELECT a FROM near)),
gone AS (SELECT doc_id, pos FROM line ANTI JOIN stay USING (doc_id, pos))
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_lines, CAST(coalesce(g.n, 0) AS BIGINT) AS n_removed, coalesce(g.p, '') AS removed_lines
FROM documents d LEFT JOIN (SELECT doc_id, count(*) AS n FROM line GROUP BY 1) n USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n, string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) AS p FROM gone GROUP BY 1) g USING (doc_id)
"""

#: CRC-32 of the decimal digits of {id}, bit by bit.
CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST({id} AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
  lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda y, i: CASE WHEN y & 1 = 1 THEN xor(3988292384::BIGINT, y >> 1) ELSE y >> 1 END)))"""

ORACLES["op11_tandem_runs"] = rf"""
WITH h AS (SELECT doc_id, {CRC32.format(id="doc_id")} AS h, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
a AS (SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS periodic, h // 10 AS g, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM h),
d AS (
  SELECT doc_id, n, CASE WHEN periodic THEN list_transform(range(n), lambda i: w[CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END + 1]) ELSE w END AS w
  FROM a),
gram AS (SELECT doc_id, i, hash(array_to_string(w[i + 1:i + 6], ' ')) AS s FROM (SELECT doc_id, w, unnest(range(n - 5)) AS i FROM d WHERE n >= 12)),
twice AS (SELECT doc_id, i, s, count(*) OVER (PARTITION BY doc_id, s) AS c FROM gram),
pair AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM twice x JOIN twice y ON x.c > 1 AND y.c > 1 AND x.doc_id = y.doc_id AND x.s = y.s AND x.i < y.i),
stretch AS (SELECT doc_id, q, min(i) AS start, max(i) - min(i) + 6 + q AS length FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM pair) GROUP BY doc_id, q, k),
run AS (SELECT doc_id, start, length, min(q) AS period FROM stretch WHERE length >= greatest(12, 2 * q) GROUP BY doc_id, start, length),
per AS (
  SELECT doc_id, count(*) AS n_runs, arg_max({{'s': start, 'l': length, 'p': period}}, [length, -start, -period]) AS r,
         sha256(string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period)) AS sha
  FROM run GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM run),
kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t
  FROM (SELECT doc_id, unnest(w) AS x, unnest(range(n)) AS i FROM d WHERE doc_id IN (SELECT doc_id FROM run)) ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(r.s AS BIGINT) AS start, CAST(r.l AS BIGINT) AS length, CAST(r.p AS BIGINT) AS period, CAST(1000 * r.l // r.p AS BIGINT) AS exponent_milli,
       coalesce(per.sha, sha256('')) AS runs_sha256, sha256(coalesce(kept.t, array_to_string(d.w, ' '))) AS collapsed_sha256
FROM d LEFT JOIN per USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

ORACLES["op13_prefix_trie"] = rf"""
WITH t AS (
  SELECT conv_id AS c, concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, '')) AS x, length(coalesce(text, '')) AS n,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, '')))) - 1 AS i
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT c, c - c % 100 AS b, {CRC32.format(id="c")} % 6 AS h FROM (SELECT DISTINCT c FROM t)),
rebuilt AS (SELECT ids.c, i, x, n FROM ids JOIN t ON t.c = ids.b AND i < h UNION ALL SELECT ids.c, i, x, n FROM ids JOIN t ON t.c = ids.c AND i >= h),
step AS (SELECT c, n, row_number() OVER (PARTITION BY c ORDER BY i) AS d, string_agg(md5(x), '') OVER (PARTITION BY c ORDER BY i) AS k FROM rebuilt),
path AS (SELECT c, 0 AS d, 0 AS n, '' AS k, NULL AS up FROM ids UNION ALL SELECT c, d, n, md5(k), lag(md5(k), 1, '') OVER (PARTITION BY c ORDER BY d) FROM step),
node AS (SELECT k, min(d) AS d, min(up) AS up, min(n) AS n, min(c) AS c, count(*) AS m FROM path GROUP BY k),
kids AS (SELECT up AS k, count(*) AS n FROM node WHERE up IS NOT NULL GROUP BY up),
below AS (SELECT DISTINCT a.k AS k, u.k AS u FROM path a JOIN path u ON a.c = u.c AND u.d >= a.d),
sums AS (SELECT below.k, sum((node.m - 1) * node.n) AS saved, count(*) FILTER (kids.n IS NULL) AS leaves FROM below JOIN node ON node.k = below.u LEFT JOIN kids ON kids.k = below.u GROUP BY below.k),
ends AS (SELECT k, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS s FROM (SELECT c, arg_max(k, d) AS k FROM path GROUP BY c) GROUP BY k)
SELECT node.c AS conv_id, CAST(node.d AS BIGINT) AS depth, parent.c AS parent_conv_id, CAST(node.m AS BIGINT) AS n_convs, CAST(coalesce(kids.n, 0) AS BIGINT) AS n_children, CAST(leaves AS BIGINT) AS n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, coalesce(s, sha256('')) AS ends_sha256
FROM node LEFT JOIN node parent ON parent.k = node.up LEFT JOIN kids ON kids.k = node.k JOIN sums ON sums.k = node.k LEFT JOIN ends ON ends.k = node.k
"""
