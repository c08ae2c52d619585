"""The operators over their whole tables, and what SQL gives for them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulselake.llm import cap_filters, hyperminhash
from pulselake.llm.decontamination import report
from pulselake.llm.lexical_search import search
from pulselake.llm.line_dedup import dedup_lines
from pulselake.llm.mixing import mix
from pulselake.llm.phrase_dedup import remove_repeated_phrases
from pulselake.llm.prefix_trie import rebuilt_trie
from pulselake.llm.secret_scan import report as secrets
from pulselake.llm.sharding import shard
from pulselake.llm.suffix_dedup import remove_repeated_bytes
from pulselake.llm.token_counts import count_tokens
from pulselake.llm.toxicity import score


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeated_bytes(table(spark, sf_dir, "documents"), window=100)
    return out.select("doc_id", F.col("n_units").alias("n_bytes"), "n_removed", "n_spans",
                      F.sha2("kept", 256).alias("kept_sha256"))


def op2_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cap_filters.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.98)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).drop("text")


def op5_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeated_phrases(table(spark, sf_dir, "documents"), window=13)
    return out.select("doc_id", F.col("n_units").alias("n_words"), "n_removed",
                      F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), size=10)
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.encode(F.array_join("items", ","), "UTF-8"), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_token_counts(spark: SparkSession, sf_dir: str, name: str = "byte_bpe_50k") -> DataFrame:
    import public_tokenizers
    out = count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(f"{name}.json"),
                       public_tokenizers.path(f"{name}.tiktoken"), public_tokenizers.PATTERN)
    return out.withColumn("over_limit", F.col("n_tokens") > 1024)


def op9_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.report(table(spark, sf_dir, "documents"), size=2, percent=80)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents").select("doc_id", "text"), shards=24).drop("text")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rebuilt_trie(table(spark, sf_dir, "conversations"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), most=10)


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_cap_filters": op2_cap_filters,
    "op3_line_dedup": op3_line_dedup,
    "op4_mixing": op4_mixing,
    "op5_phrase_dedup": op5_phrase_dedup,
    "op6_decontamination": op6_decontamination,
    "op7_toxicity": op7_toxicity,
    "op8_token_counts": op8_token_counts,
    "op9_hyperminhash": op9_hyperminhash,
    "op10_sharding": op10_sharding,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_lexical_search": op12_lexical_search,
    "op13_secret_scan": op13_secret_scan,
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_KEYWORDS = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in "password|passwd|secret|token|api_?key")
# Kind, expression before the value, value, its least length; as the report lists them.
_SECRETS = [
    ("assign", f"({_KEYWORDS})[\\x22\\x27]?\\x20*[:=]\\x20*[\\x22\\x27]?", "[A-Za-z0-9+/_.=-]+", 8),
    ("access", "(AKIA)", "[A-Z0-9]+", 12), ("hex", "()", "[0-9a-f]+", 32), ("github", "(gh[oprsu]_)", "[A-Za-z0-9]+", 36),
    ("slack", "(xox[abprs]-)", "[A-Za-z0-9-]+", 10),
    ("jwt", "(eyJ[A-Za-z0-9_-]+[.]eyJ[A-Za-z0-9_-]+[.])", "[A-Za-z0-9_-]+", 8),
    ("private_key", "(-----BEGIN )", "(?:[A-Z0-9]+ )*PRIVATE KEY-----", 0)]


def _spans(order: int, kind: str, head: str, value: str, least: int) -> str:
    """The matches of one rule, by the pieces of text between them."""
    return f"""
        SELECT doc_id, {order} AS k, '{kind}' AS kind, start, start + length(found) AS stop
        FROM (SELECT doc_id, found[i] AS found, CAST(list_sum(list_transform(pieces[1:i], lambda x: length(x)))
                     + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS start
              FROM (SELECT doc_id, pieces, found, unnest(generate_series(1, len(found))) AS i
                    FROM (SELECT doc_id, string_split_regex(t, '{head}{value}') AS pieces,
                                 regexp_extract_all(t, '{head}{value}') AS found FROM doc)))
        WHERE length(regexp_extract(found, '^{head}({value})$', 2)) >= {least}"""


ORACLE = {
    "op3_line_dedup": f"""
        WITH lines AS (
            SELECT doc_id, i, split[i] AS line,
                   translate(regexp_replace(regexp_replace(split[i], '^[\\x20\\x09-\\x0D]+', ''),
                                            '[\\x20\\x09-\\x0D]+$', ''), '{_UPPER}', '{_LOWER}') AS key
            FROM (SELECT doc_id, split, unnest(generate_series(1, len(split))) AS i
                  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS split FROM documents))),
        often AS (
            SELECT key FROM lines WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (often.key IS NOT NULL) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (often.key IS NULL), '')) AS kept_sha256
        FROM lines LEFT JOIN often USING (key) GROUP BY doc_id""",
    "op6_decontamination": f"""
        WITH doc AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                                              '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
        item AS (
            SELECT item_id, w, least(len(w), 10) AS n FROM (
                SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                                                   '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark)
            WHERE len(w) > 0),
        win AS (
            SELECT DISTINCT item_id, n, w[i : i + n - 1] AS win
            FROM (SELECT item_id, n, w, unnest(generate_series(1, len(w) - n + 1)) AS i FROM item)),
        spot AS (
            SELECT doc_id, i, n, w[i : i + n - 1] AS win
            FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
                  FROM doc, (SELECT DISTINCT n FROM item) WHERE len(w) >= n)),
        hit AS (SELECT doc_id, i, spot.n, item_id FROM spot JOIN win ON spot.n = win.n AND spot.win = win.win),
        covered AS (
            SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hit) GROUP BY doc_id),
        items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op2_cap_filters": """
        WITH vec AS MATERIALIZED (
            SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
            WHERE label IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        link AS MATERIALIZED (
            SELECT a.vec_id AS a, b.vec_id AS b FROM vec a JOIN vec b
            ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
            WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
        reach AS (
            WITH RECURSIVE r(node, other) AS (
                SELECT vec_id, vec_id FROM embeddings
                UNION SELECT r.node, link.b FROM r JOIN link ON r.other = link.a)
            SELECT node, min(other) AS component_id FROM r GROUP BY node)
        SELECT e.vec_id, (SELECT count(*) FROM link WHERE link.a = e.vec_id) AS n_links, component_id,
               e.vec_id = component_id AS kept
        FROM embeddings e JOIN reach ON e.vec_id = reach.node""",
    "op5_phrase_dedup": r"""
        WITH doc AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        win AS (
            SELECT doc_id, i, w[i : i + 12] AS g
            FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 12)) AS i FROM doc)),
        low AS (SELECT g, min(doc_id) AS least FROM win GROUP BY g),
        gone AS (
            SELECT DISTINCT doc_id, unnest(generate_series(i, i + 12)) AS p
            FROM win JOIN low USING (g) WHERE least < doc_id),
        each AS (SELECT doc_id, unnest(generate_series(1, len(w))) AS p, unnest(w) AS word FROM doc),
        kept AS (
            SELECT doc_id, count(gone.p) AS n_removed,
                   string_agg(word, ' ' ORDER BY each.p) FILTER (gone.p IS NULL) AS rest
            FROM each LEFT JOIN gone USING (doc_id, p) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
               sha256(coalesce(rest, '')) AS kept_sha256
        FROM doc LEFT JOIN kept USING (doc_id)""",
    "op9_hyperminhash": rf"""
        WITH doc AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                                              '[^\x20\x09-\x0D]+') AS w FROM documents),
        shingle AS MATERIALIZED (
            SELECT DISTINCT doc_id, w[i] || ' ' || coalesce(w[i + 1], '') AS s
            FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 1, least(len(w), 1)))) AS i FROM doc)),
        size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
        common AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
            FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
        link AS MATERIALIZED (
            SELECT a, b FROM common JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
            WHERE 100 * common.n >= 80 * (x.n + y.n - common.n)),
        reach AS (
            WITH RECURSIVE r(node, other) AS (
                SELECT doc_id, doc_id FROM documents
                UNION SELECT r.node, e.b FROM r JOIN (SELECT a, b FROM link UNION ALL SELECT b, a FROM link) e ON r.other = e.a)
            SELECT node, min(other) AS component_id FROM r GROUP BY node)
        SELECT doc.doc_id, coalesce(size.n, 0) AS n_shingles, component_id, doc.doc_id = component_id AS kept
        FROM doc LEFT JOIN size USING (doc_id) JOIN reach ON doc.doc_id = reach.node""",
    "op11_prefix_trie": r"""
        WITH conv AS MATERIALIZED (
            SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS turns,
                   xor(list_reduce(list_concat([4294967295], flatten(list_transform(
                       string_split(CAST(conv_id AS VARCHAR), ''), lambda c: [ord(c), 0, 0, 0, 0, 0, 0, 0]))),
                       lambda crc, x: xor(xor(crc, x) // 2, CASE WHEN xor(crc, x) % 2 = 1 THEN 3988292384 ELSE 0 END)),
                       4294967295) % 4 AS h
            FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
        rebuilt AS MATERIALIZED (
            SELECT own.conv_id, list_concat(coalesce(head.turns, [])[1:own.h], own.turns[own.h + 1:]) AS path
            FROM conv own LEFT JOIN conv head ON head.conv_id = own.conv_id - own.conv_id % 20),
        node AS MATERIALIZED (
            SELECT path[1:depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                   sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(path) = depth), '')) AS ends
            FROM (SELECT conv_id, path, unnest(generate_series(0, len(path))) AS depth FROM rebuilt) GROUP BY 1, 2),
        below AS (
            SELECT path[1:depth - 1] AS path, count(*) AS n FROM node WHERE depth > 0 GROUP BY 1),
        own AS (
            SELECT node.path, node.depth, CASE WHEN below.n IS NULL THEN 1 ELSE 0 END AS leaf,
                   CASE WHEN node.depth = 0 THEN 0
                        ELSE (n_convs - 1) * len(regexp_extract_all(node.path[node.depth].t, '[^\x20\x09-\x0D]+')) END AS saved
            FROM node LEFT JOIN below USING (path)),
        total AS (
            SELECT path[1:d] AS path, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens
            FROM (SELECT path, leaf, saved, unnest(generate_series(0, depth)) AS d FROM own) GROUP BY 1)
        SELECT node.conv_id, node.depth, up.conv_id AS parent_conv_id, node.n_convs, coalesce(below.n, 0) AS n_children,
               CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, node.ends AS ends_sha256
        FROM node JOIN total USING (path) LEFT JOIN below USING (path)
        LEFT JOIN node up ON node.depth > 0 AND up.path = node.path[1:node.depth - 1]""",
    "op12_lexical_search": f"""
        WITH doc AS MATERIALIZED (
            SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                                              '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
        item AS MATERIALIZED (
            SELECT item_id, word, count(*) AS times FROM (
                SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                                       '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS word FROM benchmark) GROUP BY ALL),
        total AS (SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM doc WHERE len(w) > 0),
        part AS (SELECT r, 25 + (75 * len(w) * n) // l AS m FROM doc, total WHERE len(w) > 0),
        tf AS MATERIALIZED (
            SELECT r, doc_id, word, count(*) AS tf FROM (SELECT r, doc_id, unnest(w) AS word FROM doc)
            WHERE word IN (SELECT word FROM item) GROUP BY ALL),
        weight AS (
            SELECT word, CAST(floor(1000 * ln((2 * n + 2) / (2 * df + 1))) AS BIGINT) AS weight
            FROM (SELECT word, count(*) AS df FROM tf GROUP BY word), total),
        score AS (
            SELECT item_id, r, doc_id, CAST(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
            FROM tf JOIN weight USING (word) JOIN item USING (word) JOIN part USING (r) GROUP BY ALL)
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
            SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM score WHERE score > 0)
        WHERE rank <= 10""",
    "op13_secret_scan": f"""
        WITH doc AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        span AS ({" UNION ALL ".join(_spans(k, *rule) for k, rule in enumerate(_SECRETS))}),
        base AS (
            SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
                   count(*) FILTER (kind = 'hex') AS n_hex,
                   string_agg(concat_ws(':', kind, start, stop), ',' ORDER BY start, k) FILTER (k < 3) AS base,
                   string_agg(concat_ws(':', kind, start, stop), ',' ORDER BY start, k) AS spans
            FROM span GROUP BY doc_id)
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
               sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM doc LEFT JOIN base USING (doc_id)""",
}
