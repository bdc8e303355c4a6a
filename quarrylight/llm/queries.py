"""Queries over the training-data tables, one for each operator, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, html_extract, line_dedup, minhash, mixing, sharding, topk, toxicity, url_filter, warc
from .common import table


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.assign(table(spark, sf_dir, "documents"), 40)
    return out.withColumn("grown_shard", F.lit(None).cast("int"))


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.search(vectors, vectors.filter("vec_id % 100 = 0"), 10)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_table(table(spark, sf_dir, "documents"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.groups(table(spark, sf_dir, "documents"), shingle=4).drop("text_key")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(table(spark, sf_dir, "pages"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES = {f.__name__: f for f in (op1_sharding, op2_topk, op3_decontamination, op4_toxicity, op5_mixing, op6_minhash, op7_html_extraction, op8_line_dedup, op9_url_filter, op10_warc)}



def _url_sql() -> str:
    """The URL filter in SQL, level by level."""
    u = url_filter
    fits = [(f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')", r) for r in sorted(u.RULES, key=lambda r: -len(r.name))]
    pick = lambda what: "CASE " + " ".join(f"WHEN {f} THEN '{what(r)}'" for f, r in fits) + " END"
    levels = ""
    for k in range(u.DEPTH):
        levels += f"""w{k} AS (SELECT host, segments[1:{k}] AS parent FROM n{k} WHERE len(segments) > {k} GROUP BY 1, 2 HAVING count(DISTINCT segments[{k + 1}]) >= {u.MANY_CHILDREN}),
        n{k + 1} AS (SELECT n.host, shape, good, bad, CASE WHEN w.host IS NULL THEN segments ELSE list_transform(segments, lambda x, i: CASE WHEN i = {k + 1} THEN '*' ELSE x END) END AS segments
                     FROM n{k} n LEFT JOIN w{k} w ON n.host = w.host AND n.segments[1:{k}] = w.parent),
        """
    return rf"""
        WITH a AS (SELECT page_id, coalesce(CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END, '') AS rest FROM pages),
        b AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM a),
        c AS (SELECT *, {pick(lambda r: r.name)} AS rule, {pick(lambda r: r.verdict)} AS ruled,
                     list_transform(list_filter(string_split(regexp_replace(path, '[0-9]+', '{{n}}', 'g'), '/'), lambda x: x <> ''),
                                    lambda x: CASE WHEN contains(x, '{{n}}') AND regexp_matches(x, '{u.ID_SEGMENT}') THEN concat('{{id}}', regexp_extract(x, '\.[^.]*$')) ELSE x END) AS parts FROM b),
        d AS (SELECT *, CASE WHEN len(parts) > {u.DEPTH} THEN list_append(parts[1:{u.DEPTH}], '**') ELSE parts END AS shape,
                     CASE WHEN ruled = 'block' THEN 1 WHEN ruled = 'allow' THEN 0 WHEN regexp_matches(concat(host, '/', path), '{u.JUNK}') THEN 1 END AS label FROM c),
        n0 AS (SELECT host, shape, count(*) FILTER (label = 0) AS good, count(*) FILTER (label = 1) AS bad, shape AS segments FROM d GROUP BY host, shape),
        {levels}tree AS (SELECT host, segments, segments[1:greatest(len(segments) - 1, 0)] AS parent, sum(good) AS good, sum(bad) AS bad FROM n{u.DEPTH} GROUP BY 1, 2),
        prior AS (SELECT coalesce(sum(bad) / nullif(sum(good) + sum(bad), 0), 0.0) AS prior FROM n0),
        sib AS (SELECT host, parent, sum(good) AS sg, sum(bad) AS sb FROM tree GROUP BY 1, 2),
        e AS (SELECT t.*, good + bad AS n, sg + sb AS sn, sb, prior FROM tree t JOIN sib USING (host, parent), prior),
        f AS (SELECT *, coalesce(abs(bad / nullif(n, 0) - (sb - bad) / nullif(sn - n, 0)) <= {u.Z} * sqrt(sb / nullif(sn, 0) * (1 - sb / nullif(sn, 0)) * sn / nullif(n * (sn - n), 0)), false) AS pooled FROM e),
        g AS (SELECT host, segments, CASE WHEN CASE WHEN pooled THEN sn ELSE n END > 0 THEN (CASE WHEN pooled THEN sb ELSE bad END + {u.SMOOTHING} * prior) / (CASE WHEN pooled THEN sn ELSE n END + {u.SMOOTHING}) ELSE 0 END AS purity FROM f),
        v AS (SELECT m.host, m.shape, purity FROM n{u.DEPTH} m JOIN g USING (host, segments))
        SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN purity >= {u.REJECT} THEN 'block' ELSE 'allow' END) AS verdict FROM d LEFT JOIN v USING (host, shape)"""


_WORDS_SQL = r"list_filter(regexp_split_to_array(translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda t: t <> '')"

ORACLES = {
    "op6_minhash": f"""
        WITH RECURSIVE w AS (SELECT doc_id, {_WORDS_SQL.format(x="coalesce(text, '')")} AS w FROM documents),
        s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i : i + 3], ' '))) END AS s FROM w),
        t AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
        p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM t a JOIN t b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
        r AS (SELECT doc_id AS a, doc_id AS c FROM s UNION SELECT r.a, p.b FROM r JOIN p ON r.c = p.a)
        SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, m.c AS component_id, doc_id = m.c AS kept FROM s JOIN (SELECT a, min(c) AS c FROM r GROUP BY 1) m ON m.a = s.doc_id""",
    "op8_line_dedup": f"""
        WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
        l AS (SELECT doc_id, i - 1 AS line, list_sort(list_distinct({_WORDS_SQL.format(x="l[i]")})) AS s FROM d, unnest(range(1, len(l) + 1)) AS t(i)),
        o AS (SELECT *, row_number() OVER (ORDER BY doc_id, line) AS o FROM l WHERE len(s) > 0),
        n AS (SELECT s, min(o) AS o, len(s) AS n FROM o GROUP BY s),
        t AS (SELECT o, n, unnest(s) AS x FROM n),
        near AS (SELECT DISTINCT o FROM (SELECT b.o FROM t a JOIN t b ON a.x = b.x AND a.o < b.o AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n) GROUP BY a.o, b.o, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*)))),
        m AS (SELECT doc_id, line, o.o <> n.o AS same, near.o IS NOT NULL AS near FROM o JOIN n USING (s) LEFT JOIN near ON near.o = n.o),
        g AS (SELECT doc_id, count(*) FILTER (same) AS n_same, count(*) FILTER (NOT same AND near) AS n_near, string_agg(CAST(line AS VARCHAR), ',' ORDER BY line) FILTER (same OR near) AS removed FROM m GROUP BY 1)
        SELECT doc_id, CAST(coalesce(len(l), 0) AS BIGINT) AS n_lines, coalesce(n_same, 0) AS n_same, coalesce(n_near, 0) AS n_near, coalesce(removed, '') AS removed FROM d LEFT JOIN g USING (doc_id)""",
    "op9_url_filter": _url_sql(),
    "op3_decontamination": r"""
        WITH d AS (SELECT doc_id, row_number() OVER () AS r, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
        b AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
        g AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, w[i : i + least(13, len(w)) - 1] AS gram FROM b, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS t(i) WHERE len(w) > 0),
        sizes AS (SELECT DISTINCT n FROM g),
        p AS (SELECT r, i, n, w[i : i + n - 1] AS gram FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS t(i)),
        h AS (SELECT p.r, p.i, p.n, g.item_id FROM p JOIN g USING (gram)),
        c AS (SELECT r, count(DISTINCT k) AS n_hit FROM h, unnest(range(i, i + n)) AS t(k) GROUP BY 1),
        m AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items FROM h GROUP BY 1)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN c USING (r) LEFT JOIN m USING (r)""",
    "op2_topk": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
                   WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
              FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10""",
    "op10_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
        d AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest FROM p),
        g AS (SELECT payload_digest, max(page_id) AS last FROM d WHERE payload_bytes >= 1000 GROUP BY 1)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM last AND last IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM last THEN last END AS refers_to
        FROM d LEFT JOIN g USING (payload_digest)""",
}
