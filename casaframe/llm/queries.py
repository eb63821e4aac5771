"""Named queries of the training-data operators and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from casaframe.llm import common

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


@query("op1_toxicity")
def op1_toxicity(spark, sf):
    from casaframe.llm.toxicity import toxicity
    return toxicity(common.documents(spark, sf), common.labels(spark, sf))


@query("op4_quality_rules")
def op4_quality_rules(spark, sf):
    from casaframe.llm.quality import quality_rules
    return quality_rules(common.documents(spark, sf), common.labels(spark, sf)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "score")


@query("op2_packing")
def op2_packing(spark, sf):
    from casaframe.llm.packing import pack
    return pack(common.documents(spark, sf), with_ids=False)


@query("op8_simhash")
def op8_simhash(spark, sf):
    from casaframe.llm.simhash import near_duplicates
    return near_duplicates(common.documents(spark, sf))


@query("op3_fingerprints")
def op3_fingerprints(spark, sf):
    from casaframe.llm.fingerprints import fingerprints
    return fingerprints(common.documents(spark, sf))


MIXED = """
WITH d AS (SELECT doc_id, text, source, coalesce(strlen(text), 0) AS sz FROM documents),
by_source AS (SELECT source, CAST(sum(sz) AS DOUBLE) AS b FROM d GROUP BY source),
weighed AS (SELECT source, b, CASE WHEN b > 0 THEN pow(b, 0.5) ELSE 0.0 END AS w FROM by_source),
total AS (SELECT sum(b) AS tb, sum(w) AS tw FROM weighed),
rated AS (SELECT source, CASE WHEN b > 0 THEN round(w / tw * (tb / b), 9) ELSE 1.0 END AS rate
          FROM weighed, total),
parted AS (SELECT source, greatest(1, CAST(ceil(rate / 16.0) AS INTEGER)) AS parts, rate
           FROM rated),
terms AS (SELECT source, parts, k, exp(-(rate / parts)) * pow(rate / parts, k) / gamma(k + 1) AS p
          FROM parted, range(0, 97) AS r(k)),
cum AS (SELECT source, parts, list(c ORDER BY k) AS c FROM (
          SELECT source, parts, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM terms)
        GROUP BY source, parts),
named AS (SELECT d.doc_id, d.text, d.source, c.c, c.parts,
            concat_ws(':', coalesce(CAST(d.doc_id AS VARCHAR), ''), md5(coalesce(d.text, ''))) AS ident
          FROM d JOIN cum c ON d.source IS NOT DISTINCT FROM c.source),
drawn AS (SELECT doc_id, text, source, ident, CAST(list_sum([
            len(list_filter(c, lambda x: x <= CAST(CAST(concat('0x', substr(md5(concat_ws(':', '7',
              CAST(j AS VARCHAR), ident)), 1, 13)) AS BIGINT) AS DOUBLE) / 4503599627370496.0))
            for j in range(1, parts + 1)]) AS INTEGER) AS copies FROM named)
SELECT doc_id, source, text, CAST(copy AS INTEGER) AS copy, copies,
       md5(concat_ws(':', 'order7', CAST(copy AS VARCHAR), ident)) AS shuffle_key
FROM (SELECT *, unnest(range(0, copies)) AS copy FROM drawn)
"""


@query("op7_mixing", MIXED)
def op7_mixing(spark, sf):
    from casaframe.llm.mixing import mix_sources
    docs = common.documents(spark, sf).select("doc_id", "source", "text")
    return mix_sources(docs)


@query("op9_sharding")
def op9_sharding(spark, sf):
    from casaframe.llm.sharding import shard
    return shard(common.documents(spark, sf))


def _license_oracle() -> str:
    from casaframe.llm import licenses as L
    known = [L.Template(label, t, sorted(set(t.split())), L.THRESHOLD) for label, t in L.TEMPLATES]
    quoted = ", ".join(f"({i}, '{t.label}', {t.tokens}, {t.need}, {t.run}, {t.slack})"
                       for i, t in enumerate(known))
    phrases = ", ".join(f"('{label}', string_split('{p}', ' '))" for p, label in L.PHRASES)
    better = """(u.k >= u.need AND u.k > x.k AND (u.c > x.c OR u.c = x.c AND u.n > x.n)
      AND list_has_all(u.hits, x.hits))"""
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
             translate(coalesce(text, ''), '{L.UPPER}', '{L.LOWER}') AS t FROM documents),
w AS (SELECT rid, doc_id, t, list_filter(string_split_regex(t, '{L.GAPS}'), lambda x: x <> '') AS w
      FROM d),
ph(label, p) AS (VALUES {phrases}),
places AS (SELECT rid, label, i FROM (
    SELECT rid, label, w, p, unnest(range(0, greatest(0, len(w) - len(p) + 1))) AS i FROM w, ph)
  WHERE w[i + 1] = p[1] AND w[i + 1:i + len(p)] = p),
base AS (SELECT rid, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word,
           list(DISTINCT label) AS labels FROM places GROUP BY rid),
tpl(id, label, tok, need, run, slack) AS (VALUES {quoted}),
-- sentences
b AS (SELECT rid, row_number() OVER () AS bid, list_distinct(string_split_regex(block, '{L.GAPS}')) AS held
      FROM (SELECT rid, unnest(string_split_regex(t, '{L.BLOCK_ENDS}')) AS block FROM d)),
met AS (SELECT rid, bid, label, need, hits, len(hits) AS k, n, len(hits) / CAST(n AS DOUBLE) AS c FROM (
    SELECT rid, bid, label, need, list_intersect(tok, held) AS hits, len(tok) AS n FROM b, tpl
    WHERE list_has_any(held, tok)) WHERE len(hits) >= need),
sentences AS (SELECT x.rid, x.label, x.c FROM met x
  WHERE NOT EXISTS (SELECT 1 FROM met u WHERE u.bid = x.bid AND {better})),
-- runs of words
near AS (SELECT rid, tpl.*, w FROM w, tpl WHERE len(list_intersect(tok, w)) >= need),
runs AS (SELECT rid, id, label, s, hits, len(hits) AS k, n, len(hits) / CAST(n AS DOUBLE) AS c, wide FROM (
    SELECT rid, id, label, need, s, list_intersect(tok, w[s + 1:s + run]) AS hits, len(tok) AS n,
      w[greatest(s - slack, 0) + 1:s + run + slack] AS wide
    FROM (SELECT *, unnest(range(0, len(w))) AS s FROM near)) WHERE len(hits) >= need),
rivals AS (SELECT rid, r.id, s, u.need, list_intersect(u.tok, wide) AS hits, len(u.tok) AS n
           FROM runs r, tpl u WHERE u.id <> r.id),
scored AS (SELECT *, len(hits) AS k, len(hits) / CAST(n AS DOUBLE) AS c FROM rivals),
stretches AS (SELECT x.rid, x.label, x.c FROM runs x
  WHERE NOT EXISTS (SELECT 1 FROM scored u WHERE u.rid = x.rid AND u.id = x.id AND u.s = x.s AND {better})),
meth AS (SELECT rid, list(DISTINCT label) AS labels, max(c) AS score
         FROM (SELECT * FROM sentences UNION ALL SELECT * FROM stretches) GROUP BY rid)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base,
  first_word, last_word, coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []),
    coalesce(meth.labels, [])))), ',') AS labels,
  CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(score, 0.0) END::DOUBLE AS score
FROM w LEFT JOIN base USING (rid) LEFT JOIN meth USING (rid)
"""


@query("op5_licenses", _license_oracle())
def op5_licenses(spark, sf):
    from casaframe.llm.licenses import license_report
    return license_report(common.documents(spark, sf))


LINES = """
WITH l AS (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line,
             unnest(range(0, len(string_split(text, chr(10))))) AS pos FROM documents),
known AS (SELECT trim(line) AS k, min((doc_id, pos)) AS first FROM l
          WHERE length(trim(line)) >= 16 GROUP BY 1 HAVING count(DISTINCT source) >= 8),
marked AS (SELECT l.*, known.k IS NOT NULL AND (doc_id, pos) <> first AS gone
           FROM l LEFT JOIN known ON trim(line) = known.k),
back AS (SELECT doc_id, CAST(count_if(gone) AS BIGINT) AS n_removed,
           coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text
         FROM marked GROUP BY doc_id)
SELECT d.doc_id, d.source, CASE WHEN d.text IS NULL THEN NULL ELSE back.text END AS text,
       coalesce(n_removed, 0) AS n_removed
FROM documents d LEFT JOIN back USING (doc_id)
"""


@query("op6_line_dedup", LINES)
def op6_line_dedup(spark, sf):
    from casaframe.llm.lines import dedup_lines
    return dedup_lines(common.documents(spark, sf).select("doc_id", "source", "text"))


@query("op10_pii")
def op10_pii(spark, sf):
    from casaframe.llm.pii import personal_data
    return personal_data(common.documents(spark, sf))


TRIE = r"""
WITH crc AS (SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z:
      CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i))),
own AS (SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')}
          ORDER BY turn NULLS FIRST, role, text) AS seq
        FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
named AS (SELECT conv_id, seq, conv_id - ((conv_id % 5) + 5) % 5 AS head,
    xor(list_reduce(list_concat([4294967295::BIGINT],
          list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
        lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1])), 4294967295) % 9 AS h
  FROM own, crc),
rebuilt AS (SELECT n.conv_id, CASE WHEN n.head = n.conv_id THEN n.seq
    ELSE list_concat(coalesce(b.seq[1:CAST(n.h AS INTEGER)], []), n.seq[CAST(n.h AS INTEGER) + 1:]) END AS p
  FROM named n LEFT JOIN own b ON n.head = b.conv_id),
pre AS (SELECT conv_id, d, p[1:d] AS node, len(p) AS total
        FROM (SELECT conv_id, p, unnest(range(0, CAST(len(p) AS INTEGER) + 1)) AS d FROM rebuilt)),
nodes AS (SELECT d, node, min(conv_id) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(CASE WHEN total = d THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '') AS ends
  FROM pre GROUP BY d, node),
kids AS (SELECT d - 1 AS d, node[1:d - 1] AS node, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1, 2),
full_nodes AS (SELECT nodes.*, coalesce(kids.n, 0) AS n_children,
    CASE WHEN nodes.d = 0 THEN 0 ELSE (n_convs - 1) * strlen(nodes.node[nodes.d].t) END AS saved
  FROM nodes LEFT JOIN kids ON nodes.d = kids.d AND nodes.node = kids.node),
spread AS (SELECT e AS d, node[1:e] AS node, saved, n_children
  FROM (SELECT *, unnest(range(0, CAST(d AS INTEGER) + 1)) AS e FROM full_nodes)),
sums AS (SELECT d, node, count_if(n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
         FROM spread GROUP BY d, node)
SELECT f.conv_id, CAST(f.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, f.n_convs, f.n_children,
  CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens,
  sha256(f.ends) AS ends_sha256
FROM full_nodes f JOIN sums s ON f.d = s.d AND f.node = s.node
LEFT JOIN nodes up ON up.d = f.d - 1 AND up.node = f.node[1:f.d - 1] AND f.d > 0
"""


@query("op11_prefix_trie", TRIE)
def op11_prefix_trie(spark, sf):
    from casaframe.llm.prefix_trie import prefix_trie
    return prefix_trie(spark.read.parquet(f"{sf}/conversations.parquet"))


RANKED = r"""
WITH low AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(text,
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
d AS (SELECT rid, doc_id, len(w) AS n FROM low WHERE len(w) > 0),
g AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM d),
it AS (SELECT DISTINCT item_id, text, unnest(regexp_extract_all(translate(text,
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
p AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(w) AS term FROM low)
      WHERE term IN (SELECT term FROM it) GROUP BY rid, term),
rare AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1))) AS BIGINT) AS weight
         FROM (SELECT term, count(*) AS df FROM p GROUP BY term), g),
hits AS (SELECT p.rid, p.term, weight * ((1000000000 * tf) // (1000 * tf
           + 8 * (10 + (90 * n * docs) // terms))) AS s
         FROM p JOIN d USING (rid) JOIN rare USING (term), g),
scored AS (SELECT item_id, text, rid, CAST(sum(s) AS BIGINT) AS score
           FROM it JOIN hits USING (term) GROUP BY item_id, text, rid HAVING sum(s) > 0)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id, text
         ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
FROM scored JOIN d USING (rid) QUALIFY rank <= 10
"""


@query("op12_ranked_search", RANKED)
def op12_ranked_search(spark, sf):
    from casaframe.llm.ranked_search import ranked_search
    return ranked_search(common.documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))


NEAREST = """
WITH v AS (SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
d AS (SELECT q.vec_id AS query_id, q.v AS q, c.vec_id, list_distance(q.v, c.v) AS score
  FROM v q JOIN v c ON len(q.v) = len(c.v) AND (q.vec_id IS DISTINCT FROM c.vec_id OR q.v <> c.v)
  WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id, q ORDER BY score, vec_id NULLS LAST)
  AS INTEGER) AS rank, vec_id, score FROM d QUALIFY rank <= 10
"""


@query("op13_vector_search", NEAREST)
def op13_vector_search(spark, sf):
    from casaframe.llm.vector_search import nearest_neighbours
    return nearest_neighbours(spark.read.parquet(f"{sf}/embeddings.parquet"))
