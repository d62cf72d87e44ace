"""The operators' registered queries: production parameters, whole tables, whole results."""

from __future__ import annotations

from moodwire.llm import (bpe, exact_dedup, jaccard_join, language_id, license_scan, packing, prefix_trie, quality, secret_scan, sharding,
                          substring_dedup, token_counts, vector_codes)
from moodwire.llm.common import documents
from moodwire.sources.tables import table


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(documents(spark, sf_dir))


def op2_substring_dedup(spark, sf_dir):
    return substring_dedup.substring_digest(documents(spark, sf_dir))


def op3_jaccard_join(spark, sf_dir):
    return jaccard_join.jaccard_join(documents(spark, sf_dir)).select("doc_id", "class_id", "n_links", "copy_id")


def op4_token_counts(spark, sf_dir):
    return token_counts.token_counts(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"), limit=512)


def op5_bpe_round_trip(spark, sf_dir):
    return bpe.bpe_round_trip(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"), digests=True)


def op6_packing(spark, sf_dir):
    return packing.pack(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"), end_id=2)


def op7_sharding(spark, sf_dir):
    return sharding.sharding_digest(documents(spark, sf_dir), shards=8)


def op8_language_id(spark, sf_dir):
    return language_id.language_id(documents(spark, sf_dir))


def op9_secret_scan(spark, sf_dir):
    return secret_scan.secret_digest(documents(spark, sf_dir))


def op10_quality_rules(spark, sf_dir):
    return quality.quality_rules(documents(spark, sf_dir))


def op11_prefix_trie(spark, sf_dir):
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations")).drop("node_key", "parent_key")


def op12_license_scan(spark, sf_dir):
    return license_scan.license_digest(documents(spark, sf_dir))


def op13_vector_codes(spark, sf_dir):
    return vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_token_counts": op4_token_counts,
    "op5_bpe_round_trip": op5_bpe_round_trip,
    "op6_packing": op6_packing,
    "op7_sharding": op7_sharding,
    "op8_language_id": op8_language_id,
    "op9_secret_scan": op9_secret_scan,
    "op10_quality_rules": op10_quality_rules,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_license_scan": op12_license_scan,
    "op13_vector_codes": op13_vector_codes,
}

_WORDS = r"""SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
              FROM documents"""



def _code_rounds(rounds: int = 6) -> str:
    """Unrolled rounds of op13: nearest entries a_i by codebook c_(i-1), then codebook c_i."""
    out = []
    for i in range(1, rounds + 2):
        out.append(f"""
             a{i} AS MATERIALIZED (SELECT vec_id, p, min({{'d': d, 'e': e}}) AS m
                    FROM (SELECT vec_id, p, e, sum((x - c) * (x - c))::BIGINT AS d FROM x JOIN c{i - 1} USING (p, j) GROUP BY vec_id, p, e)
                    GROUP BY vec_id, p)""")
        if i <= rounds:
            out.append(f"""
             c{i} AS MATERIALIZED (SELECT p, e, j, coalesce(n.c, o.c) AS c FROM c{i - 1} o LEFT JOIN
                    (SELECT p, m.e AS e, j, floor(sum(x) / count(*))::BIGINT AS c FROM a{i} JOIN x USING (vec_id, p) GROUP BY 1, 2, 3) n
                    USING (p, e, j))""")
    return ",".join(out)


ORACLE_SQL: dict[str, str] = {
    "op1_exact_dedup": r"""
        WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS sha
                   FROM documents),
             g AS (SELECT sha, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY sha)
        SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, t.sha AS text_sha256
        FROM t JOIN g USING (sha)""",
    "op2_substring_dedup": rf"""
        WITH w AS ({_WORDS}),
             win AS (SELECT doc_id, i, md5(array_to_string(words[i : i + 49], ' ')) AS k
                     FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM w WHERE len(words) >= 50)),
             firsts AS (SELECT k, min(doc_id) AS least FROM win GROUP BY k),
             gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM win JOIN firsts USING (k) WHERE doc_id > least),
             each AS (SELECT doc_id, unnest(range(1, len(words) + 1)) AS p, unnest(words) AS word FROM w),
             kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text
                      FROM each ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
             removed AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
        SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(removed.n, 0) AS n_removed,
               sha256(coalesce(kept.text, '')) AS kept_sha256
        FROM w LEFT JOIN kept USING (doc_id) LEFT JOIN removed USING (doc_id)""",
    "op3_jaccard_join": rf"""
        WITH RECURSIVE w AS ({_WORDS}),
             s AS (SELECT doc_id, array_to_string(words, ' ') AS g FROM w WHERE len(words) BETWEEN 1 AND 4
                   UNION
                   SELECT doc_id, array_to_string(words[i : i + 4], ' ')
                   FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) >= 5)),
             n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
             pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
                       FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
             links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
                       WHERE 5 * shared >= 4 * (x.n + y.n - shared)),
             reach(doc_id, node) AS (SELECT doc_id, doc_id FROM w
                                     UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.node),
             class AS (SELECT doc_id, min(node) AS class_id FROM reach GROUP BY doc_id),
             degree AS (SELECT a AS doc_id, count(*) AS n_links FROM links GROUP BY a),
             copies AS (SELECT doc_id, CASE WHEN len(words) = 0 THEN doc_id
                               ELSE min(doc_id) OVER (PARTITION BY array_to_string(words, ' ')) END AS copy_id FROM w)
        SELECT doc_id, class_id, coalesce(n_links, 0) AS n_links, copy_id
        FROM class JOIN copies USING (doc_id) LEFT JOIN degree USING (doc_id)""",
    "op11_prefix_trie": r"""
        WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos,
                          coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
             c AS (SELECT DISTINCT conv_id, conv_id - conv_id % 20 AS base,
                          xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(conv_id::VARCHAR, ''),
                                lambda ch: [ord(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
                              lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295) % 4 AS h
                   FROM t),
             r AS (SELECT c.conv_id, 0 AS part, pos, role, text FROM c JOIN t ON t.conv_id = base WHERE pos <= h
                   UNION ALL SELECT conv_id, 1, pos, role, text FROM c JOIN t USING (conv_id) WHERE pos > h),
             q AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS d,
                          len(list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS words FROM r),
             k AS (SELECT conv_id, d, words, md5(string_agg(md5(role) || md5(text), '') OVER (PARTITION BY conv_id ORDER BY d)) AS key FROM q
                   UNION ALL SELECT conv_id, 0, 0, '' FROM c),
             p AS (SELECT *, lag(key) OVER (PARTITION BY conv_id ORDER BY d) AS parent, max(d) OVER (PARTITION BY conv_id) = d AS ended FROM k),
             nodes AS (SELECT key, d, min(conv_id) AS conv_id, count(*) AS n, any_value(parent) AS parent, any_value(words) AS words,
                              sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ended), '')) AS ends FROM p GROUP BY key, d),
             kids AS (SELECT parent AS key, count(*) AS kids FROM nodes WHERE d > 0 GROUP BY parent),
             full_nodes AS (SELECT nodes.*, coalesce(kids, 0) AS kids FROM nodes LEFT JOIN kids USING (key)),
             sub AS (SELECT a.key, sum((x.kids = 0)::BIGINT) AS leaves, sum((x.n - 1) * x.words) AS saved
                     FROM full_nodes x JOIN k a ON a.conv_id = x.conv_id AND a.d <= x.d GROUP BY a.key)
        SELECT f.conv_id, f.d::BIGINT AS depth, up.conv_id AS parent_conv_id, f.n AS n_convs, f.kids AS n_children,
               leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, f.ends AS ends_sha256
        FROM full_nodes f JOIN sub USING (key) LEFT JOIN nodes up ON up.key = f.parent""",
    "op13_vector_codes": rf"""
        WITH v AS MATERIALIZED (SELECT vec_id, label, len(embedding) // 8 AS w,
                          list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v
                   FROM embeddings WHERE embedding IS NOT NULL
                   AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
             x AS MATERIALIZED (SELECT vec_id, (i - 1) // w AS p, (i - 1) % w AS j, v[i] AS x
                   FROM (SELECT *, unnest(range(1, len(v) + 1)) AS i FROM v)),
             c0 AS MATERIALIZED (SELECT p, e, j, x AS c FROM x JOIN
                   (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM v ORDER BY vec_id LIMIT 16) USING (vec_id)),
             {_code_rounds()},
             coded AS (SELECT vec_id, string_agg(printf('%02x', m.e), '' ORDER BY p) AS code, sum(m.d)::BIGINT AS error FROM a7 GROUP BY vec_id)
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
               (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY p, e, j)) FROM c6) AS codebooks_sha256
        FROM coded JOIN v USING (vec_id)""",
}
