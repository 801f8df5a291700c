"""Registered queries of the training-data operators, with their SQL where SQL can state the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from levyline.llm import (
    chat, conversation_repair, decontaminate, langid, lattice, line_dedup, mixing, ngram_join, permutation_index, prefix_trie, secrets,
    tokenfiles, urls,
)
from levyline.session import work_folder, written


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# The rules of the url query, longest match wins.
URL_RULES = (
    urls.Rule("allow", "com/"),
    urls.Rule("block", "example.com/en/"),
    urls.Rule("allow", "www.example.com/en/"),
    urls.Rule("block", "net/es/"),
    urls.Rule("block", "net/fr/"),
)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language and score."""
    return langid.identify(table(spark, sf_dir, "documents"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document."""
    return secrets.scan(table(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's host, path, rule and verdict."""
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES)


def vocabulary() -> str:
    """The installed vocabulary file; never copied into the repository."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op4_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place and checksum in the token files, read back from them."""
    return tokenfiles.token_table(table(spark, sf_dir, "documents"), vocabulary(), escape=False)


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 3-word shingles have a Jaccard similarity of 0.9 or more."""
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"), 3, 90, 100)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without lines that are like an earlier one, as digests."""
    rows = line_dedup.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_lines", "n_lost", F.length("text").cast("long").alias("kept_chars"), F.sha2("text", 256).alias("kept_sha256"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the place and the number of edits."""
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors of every hundredth one."""
    return permutation_index.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted, written, read back and summed up by digests."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], rows.schema)
    messages = chat.reply_chain(rows.unionByName(extra))
    folder = work_folder(spark, "chat")
    chat.format_branches(chat.branches(messages)).write.parquet(folder)
    back = chat.read_back(spark.read.parquet(folder))
    plain = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return back.select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(plain, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("text").cast("long").alias("formatted_chars"),
    )


def op11_audit_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest audit and repaired text of every damaged conversation."""
    talk = table(spark, sf_dir, "conversations")
    rows = written(conversation_repair.damaged(talk), "damaged")
    audits, turns = conversation_repair.repair(rows)
    lines = F.transform(F.array_sort(F.collect_list(F.struct("chunk", "pos", F.concat("role", F.lit(":"), "text").alias("line")))), lambda t: t.line)
    digests = turns.groupBy(F.col("conv_id").alias("d_conv")).agg(F.sha2(F.array_join(lines, "\n"), 256).alias("repaired_sha256"))
    every = talk.select(F.col("conv_id").cast("long").alias("o_conv")).distinct()
    out = every.join(audits, F.col("o_conv").eqNullSafe(audits.conv_id), "left").join(digests, F.col("o_conv").eqNullSafe(F.col("d_conv")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(
        F.col("o_conv").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op12_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector among those of its label with a cosine of 0.93 or more."""
    return lattice.near_duplicates(table(spark, sf_dir, "embeddings"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix tree of conversations that share the first turns of their hundred."""
    turns, lengths = prefix_trie.shared_heads(prefix_trie.light(table(spark, sf_dir, "conversations")))
    return prefix_trie.nodes(turns, lengths)


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_secret_scan": op2_secret_scan,
    "op3_url_filter": op3_url_filter,
    "op4_token_planes": op4_token_planes,
    "op5_ngram_join": op5_ngram_join,
    "op6_mixing": op6_mixing,
    "op7_line_dedup": op7_line_dedup,
    "op8_decontaminate": op8_decontaminate,
    "op9_nearest": op9_nearest,
    "op10_chat_format": op10_chat_format,
    "op11_audit_repair": op11_audit_repair,
    "op12_lattice_dedup": op12_lattice_dedup,
    "op13_prefix_trie": op13_prefix_trie,
}
# crc32 of a text without other than ASCII characters, bit by bit (fixed polynomial), and edits of the repair as DuckDB structs (cost, audit, turns).
_CRC32 = (
    "xor(list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), list_transform(string_split({0}, ''), lambda x: CAST(ascii(x) AS UBIGINT))), "
    "lambda c, x: list_reduce(list_prepend(xor(c, x), list_transform(range(8), lambda z: CAST(0 AS UBIGINT))), "
    "lambda k, z: xor(k >> 1, CAST(3988292384 AS UBIGINT) * (k & 1)))), CAST(4294967295 AS UBIGINT))"
)
_DROP = "{{'c': {0}.c + 3, 'a': {0}.a || 'D', 't': {0}.t}}"
_STAY = "{{'c': {0}.c + {1} + CASE fault WHEN 't' THEN 1 ELSE 0 END, 'a': {0}.a || '{2}', 't': list_append({0}.t, {3} || ':' || text)}}"
# The lengths of the template's markers stand here as numbers, so that a change of the template shows.
ORACLES: dict[str, str] = {
    "op10_chat_format": """
        WITH talk AS (
          SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
          UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(8 + length(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), chr(10), '&#10;'))
                          + length(replace(replace(text, '&', '&amp;'), '<', '&lt;'))) AS BIGINT) AS formatted_chars
        FROM talk GROUP BY conv_id""",
    "op11_audit_repair": f"""
        WITH RECURSIVE hit AS (
          SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                 {_CRC32.format("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind FROM conversations),
        bad AS (
          SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                 CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
          FROM hit, (SELECT unnest([1, 2]) AS copy) WHERE kind <> 0 AND (copy = 1 OR kind = 3)),
        ordered AS (
          SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || text)) AS n FROM bad),
        judged AS (
          SELECT conv_id, turn, n, role, text, role[1] AS ini,
                 CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'b'
                      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'd'
                      WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 't' ELSE '' END AS fault,
                 lag(role[1]) OVER (PARTITION BY conv_id ORDER BY n) AS before
          FROM ordered),
        walk AS (
          SELECT conv_id, CAST(0 AS BIGINT) AS n, {{'c': CAST(0 AS BIGINT), 'a': '', 't': CAST([] AS VARCHAR[])}} AS s0,
                 {{'c': CAST(1000000000 AS BIGINT), 'a': '', 't': CAST([] AS VARCHAR[])}} AS s1,
                 {{'c': CAST(2 AS BIGINT), 'a': 'I', 't': ['user:']}} AS s2,
                 {{'c': CAST(4 AS BIGINT), 'a': 'II', 't': ['user:', 'assistant:']}} AS s3
          FROM (SELECT DISTINCT conv_id FROM judged)
          UNION ALL
          SELECT conv_id, n, m0, m1, m2,
                 list_sort([m3, {{'c': m2.c + 2, 'a': m2.a || 'I', 't': list_append(m2.t, 'assistant:')}}])[1]
          FROM (
            SELECT conv_id, n, m0, m1, m3, list_sort([m2] || list_transform([m0, m1, m3],
                   lambda x: {{'c': x.c + 2, 'a': x.a || 'I', 't': list_append(x.t, 'user:')}}))[1] AS m2
            FROM (
              SELECT w.conv_id, j.n, {_DROP.format("s0")} AS m0,
                     CASE WHEN fault IN ('', 't') AND ini = 's' THEN list_sort([{_DROP.format("s1")}, {_STAY.format("s0", 0, "K", "role")}])[1]
                          ELSE {_DROP.format("s1")} END AS m1,
                     CASE WHEN fault IN ('', 't') THEN list_sort([{_DROP.format("s2")}, {_STAY.format("s0", 2, "R", "'user'")}, {_STAY.format("s1", 2, "R", "'user'")},
                               {_STAY.format("s3", 2, "R", "'user'")}] || CASE WHEN ini = 'u' THEN [{_STAY.format("s0", 0, "K", "role")},
                               {_STAY.format("s1", 0, "K", "role")}, {_STAY.format("s3", 0, "K", "role")}] ELSE [] END)[1] ELSE {_DROP.format("s2")} END AS m2,
                     CASE WHEN fault IN ('', 't') THEN list_sort([{_DROP.format("s3")}, {_STAY.format("s2", 2, "R", "'assistant'")}]
                               || CASE WHEN ini = 'a' THEN [{_STAY.format("s2", 0, "K", "role")}] ELSE [] END)[1] ELSE {_DROP.format("s3")} END AS m3
              FROM walk w JOIN judged j ON j.conv_id = w.conv_id AND j.n = w.n + 1))),
        finished AS (
          SELECT conv_id, list_sort([s0, s3])[1] AS best FROM walk
          WHERE (conv_id, n) IN (SELECT (conv_id, max(n)) FROM judged GROUP BY conv_id)),
        counted AS (
          SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
                 count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
                 count(*) FILTER (n > 1 AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id)
        SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
               coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit,
               sha256(coalesce(array_to_string(best.t, chr(10)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN finished USING (conv_id) LEFT JOIN counted USING (conv_id)""",
    "op12_lattice_dedup": """
        WITH RECURSIVE v AS (
          SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
          WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        links AS (
          SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
          AND list_cosine_similarity(a.e, b.e) >= 0.93),
        reach AS (SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y)
        SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.x = e.vec_id) AS n_links, r.low AS component_id, e.vec_id = r.low AS kept
        FROM embeddings e JOIN (SELECT x, min(y) AS low FROM reach GROUP BY x) r ON r.x = e.vec_id""",
    "op13_prefix_trie": f"""
        WITH rows AS (
          SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                 row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                   sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS n
          FROM conversations WHERE conv_id IS NOT NULL),
        lengths AS (SELECT conv_id, count(*) AS n, {_CRC32.format("CAST(conv_id AS VARCHAR)")} % 6 AS h FROM rows GROUP BY conv_id),
        heads AS (SELECT l.*, least(l.h, coalesce(b.n, 0)) AS taken FROM lengths l LEFT JOIN lengths b ON b.conv_id = l.conv_id - l.conv_id % 100),
        turns AS (
          SELECT h.conv_id, CAST(r.n AS BIGINT) AS depth, role, text FROM heads h JOIN rows r ON r.conv_id = h.conv_id - h.conv_id % 100 AND r.n <= h.taken
          UNION ALL SELECT h.conv_id, CAST(r.n - h.h + h.taken AS BIGINT), role, text FROM heads h JOIN rows r ON r.conv_id = h.conv_id AND r.n > h.h),
        ends AS (SELECT conv_id, CAST(taken + greatest(n - h, 0) AS BIGINT) AS depth FROM heads),
        prefixes AS (
          SELECT conv_id, depth, text,
                 string_agg(sha256(length(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY depth) AS name FROM turns
          UNION ALL SELECT conv_id, 0, '', '' FROM lengths),
        nodes AS (
          SELECT p.depth, p.name, min(p.conv_id) AS conv_id, count(*) AS n_convs, any_value(length(p.text)) AS chars,
                 sha256(coalesce(string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id) FILTER (e.depth = p.depth), '')) AS ends_sha256
          FROM prefixes p JOIN ends e USING (conv_id) GROUP BY p.depth, p.name),
        tree AS (
          SELECT n.*, u.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.name[:-65] = n.name) AS n_children
          FROM nodes n LEFT JOIN nodes u ON u.depth = n.depth - 1 AND u.name = n.name[:-65]),
        sums AS (
          SELECT p.depth, p.name, sum((t.n_convs - 1) * t.chars) AS saved, count(*) FILTER (t.n_children = 0) AS leaves
          FROM tree t JOIN prefixes p ON p.conv_id = t.conv_id AND p.depth <= t.depth GROUP BY p.depth, p.name)
        SELECT t.conv_id, t.depth, t.parent_conv_id, t.n_convs, t.n_children, CAST(s.leaves AS BIGINT) AS n_leaves,
               CAST(s.saved AS BIGINT) AS saved_tokens, t.ends_sha256
        FROM tree t JOIN sums s USING (depth, name)""",
}
