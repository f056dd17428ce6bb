"""One registered query for each operator, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tradeloom.llm import bpe, decontaminate, jaccard, line_dedup, merkle, packing, secrets, sharding, suffix_dedup, topk, toxicity, trie, url_rules
from tradeloom.llm.common import table
from tradeloom.operators.stage import staged

Query = Callable[[SparkSession, str], DataFrame]

#: The url rules of the query, as host, path and verdict.
URL_RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


#: First turns a conversation takes over at most.
MOST_TAKEN = 8

#: Scores from here on count as toxic.
TOXIC = 0.3


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def op1_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = suffix_dedup.dedup_substrings(table(spark, folder, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op2_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, folder, "documents"))


def op3_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    scanned = secrets.scan(table(spark, folder, "documents").select("doc_id", "text"))
    spans = F.col("secrets")
    base = F.filter(spans, lambda s: s["kind"] != "random")
    joined = lambda some: F.array_join(
        F.transform(some, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
    return scanned.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in secrets.KINDS),
        sha256(joined(base)).alias("base_sha256"),
        joined(spans).alias("spans"),
    )


def op4_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = table(spark, folder, "pages").select("page_id", "url")
    return url_rules.judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op5_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op6_minimax_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_by_bytes(table(spark, folder, "documents"), shards=24).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def toxicity_network(spark: SparkSession, folder: str) -> toxicity.Network:
    """The network of the query: trained on labels of rows that are not held out."""
    labels = table(spark, folder, "labels").filter(~toxicity.held_out("doc_id"))
    return toxicity.fit(table(spark, folder, "documents"), labels)


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return toxicity.score(documents, toxicity_network(spark, folder)).select(
        "doc_id",
        toxicity.held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= TOXIC).cast("int").alias("predicted"),
    )


def op8_sum_of_squares_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", sha256(F.col("text")).alias("kept_sha256"))


def op10_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return topk.top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0), k=5)


def rebuilt_conversations(spark: SparkSession, folder: str) -> DataFrame:
    """Each conversation behind first turns of its block's first conversation:
    as many as a hash of its id says, and its own turns after as many."""
    own = staged(trie.conversations(table(spark, folder, "conversations")), "conversations")
    base = F.col("conv_id") - F.col("conv_id") % 5
    first = own.filter(F.col("conv_id") % 5 == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, MOST_TAKEN).alias("first")
    )
    taken = (F.crc32(F.col("conv_id").cast("string")) % (MOST_TAKEN + 1)).cast("int")
    lead = F.coalesce(F.slice("first", 1, taken), F.array().cast(f"array<{trie.TURN}>"))
    rest = F.slice("turns", taken + 1, F.size("turns"))
    return own.withColumn("base", base).join(first, "base", "left").select("conv_id", F.concat(lead, rest).alias("turns"))


def op11_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie.prefix_trie(rebuilt_conversations(spark, folder))


def op12_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    encoded = bpe.encode(table(spark, folder, "documents").select("doc_id", "text"))
    return bpe.decode(encoded).select(
        "doc_id",
        "n_tokens",
        sha256(bpe.ids_text(F.col("ids"))).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    n_chars = F.when(tampered, F.try_add("n_chars", F.lit(1))).otherwise(F.col("n_chars"))
    made = merkle.manifest(table(spark, folder, "documents"), presented={"n_chars": n_chars})
    return merkle.proofs(made).withColumnRenamed("id", "doc_id")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_suffix_array_dedup,
        op2_ngram_jaccard_join,
        op3_secret_scan,
        op4_url_filter,
        op5_benchmark_decontamination,
        op6_minimax_sharding,
        op7_toxicity,
        op8_sum_of_squares_packing,
        op9_line_dedup,
        op10_exact_top_k,
        op11_conversation_trie,
        op12_byte_bpe,
        op13_merkle_manifest,
    )
}

#: Unsigned CRC-32 of the decimal text of a whole number, bit by bit.
CRC32 = """
    xor(4294967295, list_reduce(
        list_concat([4294967295::BIGINT], list_transform(string_split(({0})::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
        lambda crc, byte: list_reduce(
            list_concat([xor(crc, byte)], range(8)),
            lambda bits, step: CASE WHEN bits & 1 = 1 THEN xor(bits >> 1, 3988292384) ELSE bits >> 1 END)))
"""

ORACLE: dict[str, str] = {
    "op4_url_filter": """
        WITH cut AS (
            SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
            FROM pages
        ), parts AS (
            SELECT page_id,
                   translate(regexp_extract(rest, '^[^/?#]*'),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
            FROM cut
        ), rules(r_host, r_path, r_verdict) AS (
            VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                   ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
        ), fits AS (
            SELECT page_id, r_host || r_path AS rule, r_verdict,
                   row_number() OVER (PARTITION BY page_id ORDER BY length(r_host || r_path) DESC) AS place
            FROM parts, rules
            WHERE ends_with('.' || host, '.' || r_host) AND starts_with(path, r_path)
        )
        SELECT page_id, host, path, rule, coalesce(r_verdict, 'allow') AS verdict
        FROM parts LEFT JOIN (SELECT * FROM fits WHERE place = 1) USING (page_id)
    """,
    "op9_line_dedup": """
        WITH lines AS (
            SELECT doc_id, generate_subscripts(parts, 1) AS place, unnest(parts) AS line
            FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
        ), keyed AS (
            SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM lines
        ), marked AS (
            SELECT doc_id, place, line,
                   length(key) >= 10 AND doc_id > min(doc_id) OVER (PARTITION BY key) AS dropped
            FROM keyed
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), '')) AS kept_sha256
        FROM marked GROUP BY doc_id
    """,
    "op10_exact_top_k": """
        WITH whole AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
            FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
        ), ranked AS (
            SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank
            FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op11_conversation_trie": f"""
        WITH own AS (
            SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS turns
            FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
        ), hashed AS (
            SELECT *, ({CRC32.format('conv_id')}) % 9 AS h FROM own
        ), rebuilt AS (
            SELECT hashed.conv_id,
                   coalesce(list_slice(base.turns, 1, h), []) || list_slice(hashed.turns, h + 1, len(hashed.turns)) AS turns
            FROM hashed LEFT JOIN own base ON base.conv_id = hashed.conv_id - hashed.conv_id % 5
        ), prefixes AS (
            SELECT conv_id, unnest(range(len(turns) + 1)) AS depth, turns FROM rebuilt
        ), nodes AS (
            SELECT list_slice(turns, 1, depth) AS prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                   sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = len(turns)), ''))
                       AS ends_sha256,
                   CASE WHEN depth = 0 THEN 0 ELSE strlen(list_slice(turns, 1, depth)[depth].text) END AS bytes
            FROM prefixes GROUP BY ALL
        ), linked AS (
            SELECT child.*, parent.conv_id AS parent_conv_id,
                   (SELECT count(*) FROM nodes c WHERE c.depth = child.depth + 1
                        AND list_slice(c.prefix, 1, child.depth) = child.prefix) AS n_children
            FROM nodes child LEFT JOIN nodes parent
                ON parent.depth = child.depth - 1 AND parent.prefix = list_slice(child.prefix, 1, child.depth - 1)
        ), below AS (
            SELECT list_slice(prefix, 1, up) AS prefix, (n_children = 0)::BIGINT AS leaf, (n_convs - 1) * bytes AS saved
            FROM (SELECT *, unnest(range(depth + 1)) AS up FROM linked)
        ), sums AS (
            SELECT prefix, sum(leaf)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM below GROUP BY prefix
        )
        SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
        FROM linked JOIN sums USING (prefix)
    """,
    "op13_merkle_manifest": f"""
        WITH RECURSIVE texts AS (
            SELECT doc_id, lang, n_chars + (({CRC32.format('doc_id')}) % 7 = 0)::BIGINT AS presented_chars,
                   coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') ||
                   coalesce(strlen(source) || ':' || source, '-') ||
                   coalesce(strlen(lang) || ':' || lang, '-') AS head,
                   coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS chars,
                   coalesce(strlen(text) || ':' || text, '-') AS tail
            FROM documents
        ), leaves AS (
            SELECT doc_id, lang, sha256(head || chars || tail) AS leaf,
                   sha256(head || coalesce(strlen(presented_chars::VARCHAR) || ':' || presented_chars, '-') || tail)
                       AS presented,
                   row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS place,
                   count(*) OVER (PARTITION BY lang) AS n
            FROM texts
        ), nodes AS (
            SELECT lang, 0 AS level, place, n, leaf AS digest FROM leaves
            UNION ALL
            SELECT lang, level + 1, place // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY place))
            FROM nodes WHERE n > 1 GROUP BY lang, level, n, place // 2
        ), subroots AS (
            SELECT lang, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS n
            FROM nodes WHERE n = 1
        ), upper AS (
            SELECT 0 AS level, place, n, subroot AS digest FROM subroots
            UNION ALL
            SELECT level + 1, place // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY place))
            FROM upper WHERE n > 1 GROUP BY level, n, place // 2
        ), steps AS (
            SELECT doc_id, own.level, (own.place & 1) = 1 AS is_left, coalesce(other.digest, '') AS digest
            FROM leaves JOIN nodes own ON own.lang IS NOT DISTINCT FROM leaves.lang
                 AND own.place = leaves.place >> own.level AND own.n > 1
            LEFT JOIN nodes other ON other.lang IS NOT DISTINCT FROM own.lang
                 AND other.level = own.level AND other.place = xor(own.place, 1)
            UNION ALL
            SELECT doc_id, 100 + own.level, (own.place & 1) = 1, coalesce(other.digest, '')
            FROM leaves JOIN subroots ON subroots.lang IS NOT DISTINCT FROM leaves.lang
            JOIN upper own ON own.place = subroots.place >> own.level AND own.n > 1
            LEFT JOIN upper other ON other.level = own.level AND other.place = xor(own.place, 1)
        ), paths AS (
            SELECT doc_id, list({{'digest': digest, 'is_left': is_left}} ORDER BY level) AS path,
                   string_agg(digest, '' ORDER BY level) AS joined
            FROM steps GROUP BY doc_id
        ), proven AS (
            SELECT doc_id, leaf, subroot, (SELECT digest FROM upper WHERE n = 1) AS root,
                   sha256(coalesce(joined, '')) AS proof_sha256,
                   list_reduce(
                       list_concat([{{'digest': presented, 'is_left': false}}], coalesce(path, [])),
                       lambda below, step: {{'digest': sha256(CASE WHEN step.is_left THEN step.digest || below.digest
                                                                 ELSE below.digest || step.digest END),
                                            'is_left': false}}).digest AS folded_root
            FROM leaves LEFT JOIN paths USING (doc_id)
            JOIN subroots ON subroots.lang IS NOT DISTINCT FROM leaves.lang
        )
        SELECT *, folded_root = root AS verified FROM proven
    """,
}
