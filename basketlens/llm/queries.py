"""The registered corpus queries and, where SQL can state it, their expected result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from basketlens.llm.common import table
from basketlens.llm.conv_repair import conversation_digests, repair_conversations
from basketlens.llm.decontaminate import contaminated_passages
from basketlens.llm.exact_dedup import exact_duplicates
from basketlens.llm.lang_id import detect_languages, held_out, learn_languages
from basketlens.llm.line_dedup import deduplicate_lines
from basketlens.llm.merkle import merkle_manifest
from basketlens.llm.mixing import mix_sources
from basketlens.llm.near_dedup import near_duplicates
from basketlens.llm.pii import personal_data
from basketlens.llm.simhash import simhash_duplicates
from basketlens.llm.substring import repeated_passages
from basketlens.llm.url_filter import RULES, judge_urls
from basketlens.llm.warc import BASE32, archive_round_trip

QUERIES: dict[str, callable] = {}
EXPECTED_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(function):
        QUERIES[name] = function
        if sql is not None:
            EXPECTED_SQL[name] = sql
        return function

    return wrap


#: [\x20\x09-\x0D] and the ASCII letters, for DuckDB.
SQL_BLANKS = "(chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"


def sql_lower(text: str) -> str:
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _sql_rules() -> str:
    text = lambda value: "'" + value.replace("'", "''") + "'"
    return ", ".join(f"({text(r.name)}, {text(r.regex)}, {text(r.verdict)}, {r.rank})" for r in RULES)


@query(
    "op1_url_filter",
    f"""
    WITH rules(name, regex, rule_verdict, rank) AS (VALUES {_sql_rules()}),
    rest AS (SELECT row_number() OVER () AS row, page_id,
                    CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
    urls AS (SELECT row, page_id, {sql_lower("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host,
                    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
    fits AS (SELECT row, row_number() OVER (PARTITION BY row ORDER BY rank DESC,
                    CASE WHEN rank = 1 THEN length(name) ELSE (rule_verdict = 'block')::INT END DESC, name DESC) AS place,
                    name, rule_verdict, rank
             FROM urls JOIN rules ON regexp_matches(host || path, regex))
    SELECT page_id, host, path, CASE WHEN rank = 1 THEN name END AS rule, coalesce(rule_verdict, 'allow') AS verdict
    FROM urls LEFT JOIN (SELECT * FROM fits WHERE place = 1) USING (row)
    """,
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = judge_urls(table(spark, sf_dir, "pages"))
    return found.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict")


@query("op2_language_id")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learned = learn_languages(docs.where(~held_out(F.col("doc_id"))).select("text", "lang"))
    found = detect_languages(docs, learned, carried=("doc_id",)).select("other.doc_id", "lang_pred", "score")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query(
    "op3_line_dedup",
    f"""
    WITH lines AS (
        SELECT doc_id, row, pos, line, {sql_lower(f"trim(line, {SQL_BLANKS})")} AS key
        FROM (SELECT doc_id, row, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos
              FROM (SELECT doc_id, row_number() OVER () AS row, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))
    ), shared AS (
        SELECT key, min(doc_id) AS first FROM lines WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1
    ), judged AS (
        SELECT l.*, coalesce(l.doc_id <> s.first, false) AS gone FROM lines l LEFT JOIN shared s USING (key)
    )
    SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
    FROM judged GROUP BY doc_id, row
    """,
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = deduplicate_lines(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_lines", "n_dropped", "kept_sha256")


def _sql_quotas(votes: str, blocks: str, keys: str, within: str) -> str:
    """Blocks by highest quotients, every quotient listed."""
    part = f"PARTITION BY {within}" if within else ""
    return f"""
        SELECT {keys}, count(*)::BIGINT AS quota
        FROM (SELECT *, row_number() OVER ({part} ORDER BY votes / (2 * k + 1) DESC, {keys} NULLS LAST) AS place
              FROM (SELECT *, unnest(generate_series(0, ceil(votes / sum(votes) OVER ({part}) * blocks)::BIGINT + 25)) AS k
                    FROM (SELECT *, {votes}::DOUBLE AS votes, {blocks} AS blocks FROM seats) WHERE votes > 0))
        WHERE place <= blocks GROUP BY {keys}"""


@query(
    "op4_mix_sources",
    f"""
    WITH d AS (SELECT doc_id, source,
                      CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) END::BIGINT AS size
               FROM documents),
    s AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n FROM d GROUP BY source),
    w AS (SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight,
                 source_size * 2.0::DOUBLE AS lim FROM s),
    l AS (SELECT *, ((SELECT sum(source_size) FROM s)::DOUBLE * 1.5
                     - coalesce(sum(lim) OVER (ORDER BY lim / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                    / sum(weight) OVER (ORDER BY lim / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
          FROM w),
    t AS (SELECT source, source_size, greatest(ceil(source_size / 4194304.0), ceil(n / 262144.0), 1)::BIGINT AS shards,
                 least(lim, coalesce((SELECT arg_min(level, lim / weight) FROM l WHERE level * weight <= lim) * weight, lim)) AS target
          FROM l),
    q AS (WITH seats AS (SELECT source, target, (SELECT floor(sum(target) / 32 + 0.5) FROM t)::BIGINT AS total FROM t)
          {_sql_quotas("target", "total", "source", "")}),
    p AS (SELECT d.*, t.source_size, t.target,
                 ('0x' || substr(md5('20:' || coalesce(doc_id::VARCHAR, '-')), 1, 8))::BIGINT % shards AS shard,
                 md5('21:' || coalesce(doc_id::VARCHAR, '-')) AS draw
          FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
    z AS (SELECT source, shard, sum(size)::BIGINT AS shard_size FROM p GROUP BY source, shard),
    y AS (WITH seats AS (SELECT z.*, q.quota AS total FROM z JOIN q ON z.source IS NOT DISTINCT FROM q.source)
          {_sql_quotas("shard_size", "total", "source, shard", "source")}),
    r AS (SELECT p.*, sum(size) OVER (PARTITION BY p.source, p.shard ORDER BY draw, doc_id, size ROWS UNBOUNDED PRECEDING)::BIGINT AS stop,
                 ceil(shard_size / 32.0)::BIGINT AS n,
                 least(coalesce(y.quota, 0), 2 * ceil(shard_size / 32.0)::BIGINT) AS quota
          FROM p JOIN z ON p.source IS NOT DISTINCT FROM z.source AND p.shard = z.shard
          LEFT JOIN y ON p.source IS NOT DISTINCT FROM y.source AND p.shard = y.shard),
    a AS (SELECT *, CASE WHEN n > 0 THEN quota // n ELSE 0 END AS passes,
                 CASE WHEN n > 0 THEN ('0x' || substr(md5('22:' || coalesce(source, '-') || ':' || shard), 1, 8))::BIGINT % n ELSE 0 END AS first
          FROM r)
    SELECT doc_id, size, source_size, target,
           (passes * size
            + greatest(least(stop, least(first + quota - passes * n, n) * 32) - greatest(stop - size, first * 32), 0)
            + greatest(least(stop, greatest(first + quota - passes * n - n, 0) * 32) - (stop - size), 0))::BIGINT AS taken
    FROM a
    """,
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mix_sources(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


@query("op5_decontaminate")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "item_id", "score", "start", "end")


@query(
    "op6_warc_round_trip",
    f"""
    WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
    f AS (SELECT h, min(page_id) AS first FROM p GROUP BY h),
    x AS (SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes, sha1(h) AS digits, first FROM p JOIN f USING (h))
    SELECT page_id, payload_bytes,
           array_to_string(list_transform(generate_series(0, 31), lambda i: substr('{BASE32}',
               (((('0x' || substr(digits, ((i // 4) * 5 + 1)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31) + 1)::INT, 1)), '') AS payload_digest,
           CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> first THEN first END AS refers_to
    FROM x
    """,
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = archive_round_trip(table(spark, sf_dir, "pages"))
    return found.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op7_personal_data")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans"
    )


@query("op8_substring_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_passages(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), F.col("other_id").alias("other_doc_id"), "start", "end", "other_start", "other_end", "share"
    )


@query(
    "op9_exact_dedup",
    f"""
    WITH d AS (SELECT doc_id, {sql_lower("coalesce(text, '')")} AS t FROM documents),
    g AS (SELECT t, max(doc_id) AS keep_id, count(*)::BIGINT AS group_size FROM d GROUP BY t)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)
    """,
)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("sha256").alias("text_sha256")
    )


@query("op10_minhash_near_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


@query("op11_simhash_near_dedup")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_duplicates(table(spark, sf_dir, "documents"), words=3, radius=3)
    return found.select(F.col("id").alias("doc_id"), "fingerprint", "component_id")


#: Entries of the CRC-32 table, and the checksum of an ASCII text, for DuckDB.
SQL_CRC_TABLE = """
    SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) ORDER BY b) AS crcs
    FROM range(256) t(b)"""


def sql_crc32(text: str) -> str:
    return f"""xor(list_reduce(list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT),
                               lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"""


def _sql_leaf(*fields: str) -> str:
    texts = [f"({f})::VARCHAR" for f in fields]
    return "sha256(" + " || ".join(f"coalesce(octet_length(encode({t})) || ':' || {t}, '-')" for t in texts) + ")"


def _sql_tree(nodes: str) -> str:
    """All nodes above those of level 0, pairs hashed while several remain."""
    return f"""
        SELECT tree, 0 AS level, pos, n, digest FROM {nodes}
        UNION ALL
        SELECT tree, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos))
        FROM {nodes}_all WHERE n > 1 GROUP BY tree, level, pos // 2, n"""


def _sql_walk(start: str, nodes: str, name: str) -> str:
    """From a node to its top, collecting siblings and folding."""
    return f"""
        SELECT row, tree, 0 AS level, pos, n, proof, folded FROM {start}
        UNION ALL
        SELECT w.row, w.tree, w.level + 1, w.pos // 2, (w.n + 1) // 2, w.proof || coalesce(s.digest, ''),
               sha256(CASE WHEN w.pos % 2 = 0 THEN w.folded || coalesce(s.digest, '') ELSE s.digest || w.folded END)
        FROM {name} w LEFT JOIN {nodes} s ON s.tree IS NOT DISTINCT FROM w.tree AND s.level = w.level AND s.pos = xor(w.pos, 1)
        WHERE w.n > 1"""


@query(
    "op13_merkle_manifest",
    f"""
    WITH RECURSIVE crc AS ({SQL_CRC_TABLE}),
    d AS (SELECT *, {_sql_leaf("doc_id", "source", "lang", "n_chars", "text")} AS leaf,
                 CASE WHEN {sql_crc32("doc_id::VARCHAR")} % 7 = 0 THEN 1 ELSE 0 END AS more FROM documents, crc),
    leaves AS (SELECT row_number() OVER () AS row, doc_id, lang AS tree, leaf AS digest,
                      row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n,
                      {_sql_leaf("doc_id", "source", "lang", "n_chars + more", "text")} AS tampered FROM d),
    leaves_all AS ({_sql_tree("leaves")}),
    tops AS (SELECT 0 AS tree, tree AS lang, digest, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
             FROM leaves_all WHERE n = 1),
    tops_all AS ({_sql_tree("tops")}),
    begun AS (SELECT row, tree, pos, n, '' AS proof, tampered AS folded FROM leaves),
    walk AS ({_sql_walk("begun", "leaves_all", "walk")}),
    joined AS (SELECT w.row, 0 AS tree, t.pos, t.n, w.proof, w.folded FROM walk w JOIN tops t ON t.lang IS NOT DISTINCT FROM w.tree WHERE w.n = 1),
    climb AS ({_sql_walk("joined", "tops_all", "climb")})
    SELECT l.doc_id, l.digest AS leaf, t.digest AS subroot, r.digest AS root, sha256(c.proof) AS proof_sha256, c.folded AS folded_root,
           c.folded = r.digest AS verified
    FROM leaves l JOIN climb c ON c.row = l.row AND c.n = 1 JOIN tops t ON t.lang IS NOT DISTINCT FROM l.tree
    CROSS JOIN (SELECT digest FROM tops_all WHERE n = 1) r
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    more = F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    found = merkle_manifest(table(spark, sf_dir, "documents"), replaced={"n_chars": more})
    return found.select(
        F.col("id").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        F.sha2(F.concat_ws("", "siblings").cast("binary"), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def damage_conversations(turns: DataFrame) -> DataFrame:
    """Rows of ``conversations`` dropped, emptied, cut, repeated or renamed by a checksum of conversation and turn; null is one space."""
    said = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    kind = F.crc32(F.concat(said["conv_id"], F.lit(":"), said["turn"]).cast("binary")) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace(said["text"], "[.!?]", "")).otherwise(said["text"])
    return (
        turns.withColumn("kind", kind)
        .where("kind <> 0")
        .withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        .select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(said["role"]).alias("role"), text.alias("text"))
    )


@query(
    "op12_conversation_repair",
    f"""
    WITH RECURSIVE crc AS ({SQL_CRC_TABLE}),
    told AS (SELECT conv_id, turn, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name,
                    coalesce(role, ' ') AS role, coalesce(text, ' ') AS text FROM conversations),
    named AS (SELECT told.*, ({sql_crc32("name")} % 20)::INT AS kind FROM told, crc),
    damaged AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                       CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                       unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
                FROM named WHERE kind <> 0),
    placed AS (SELECT *, row_number() OVER conv AS i, lag(left(role, 1)) OVER conv AS before,
                      row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again
               FROM damaged WINDOW conv AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
    faults AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank' WHEN again THEN 'duplicate'
                              WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 'truncated' ELSE '' END AS fault FROM placed),
    counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                      count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
                      count(*) FILTER (WHERE fault = 'truncated') AS truncated,
                      count(*) FILTER (WHERE i > 1 AND before || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
               FROM faults GROUP BY conv_id),
    edits(x, y, letter, price, needs, said) AS (VALUES
        ('E', 'E', 'D', 2, '', ''), ('S', 'S', 'D', 2, '', ''), ('U', 'U', 'D', 2, '', ''), ('A', 'A', 'D', 2, '', ''),
        ('E', 'S', 'K', 0, 's', ''), ('E', 'U', 'K', 0, 'u', ''), ('S', 'U', 'K', 0, 'u', ''), ('A', 'U', 'K', 0, 'u', ''), ('U', 'A', 'K', 0, 'a', ''),
        ('E', 'U', 'R', 1, '', 'user'), ('S', 'U', 'R', 1, '', 'user'), ('A', 'U', 'R', 1, '', 'user'), ('U', 'A', 'R', 1, '', 'assistant')),
    gifts(y, z, letters, price, lines) AS (VALUES
        ('E', 'E', '', 0, ''), ('S', 'S', '', 0, ''), ('U', 'U', '', 0, ''), ('A', 'A', '', 0, ''),
        ('E', 'U', 'I', 5, 'user:' || chr(10)), ('S', 'U', 'I', 5, 'user:' || chr(10)), ('A', 'U', 'I', 5, 'user:' || chr(10)),
        ('U', 'A', 'I', 5, 'assistant:' || chr(10)),
        ('E', 'A', 'II', 10, 'user:' || chr(10) || 'assistant:' || chr(10)), ('S', 'A', 'II', 10, 'user:' || chr(10) || 'assistant:' || chr(10))),
    ways AS (
        SELECT c.conv_id, 0 AS i, g.z AS state, g.price AS cost, g.letters AS audit, g.lines AS lines FROM counts c, gifts g WHERE g.y = 'E'
        UNION ALL
        SELECT conv_id, i, state, best.cost, best.audit, best.lines FROM (
            SELECT w.conv_id, f.i, g.z AS state,
                   min(struct_pack(cost := w.cost + e.price + g.price + CASE WHEN e.letter <> 'D' AND f.fault = 'truncated' THEN 5 ELSE 0 END,
                                   audit := w.audit || e.letter || g.letters,
                                   lines := w.lines || CASE WHEN e.letter = 'D' THEN '' ELSE CASE e.letter WHEN 'K' THEN f.role ELSE e.said END
                                                       || ':' || f.text || chr(10) END || g.lines)) AS best
            FROM ways w JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1
            JOIN edits e ON e.x = w.state AND (e.needs = '' OR e.needs = left(f.role, 1)) AND (e.letter = 'D' OR f.fault NOT IN ('blank', 'duplicate'))
            JOIN gifts g ON g.y = e.y
            GROUP BY w.conv_id, f.i, g.z)),
    best AS (SELECT w.conv_id, min(struct_pack(cost := w.cost, audit := w.audit, lines := w.lines)) AS way
             FROM ways w JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.i WHERE w.state IN ('E', 'A') GROUP BY w.conv_id)
    SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
           coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(way.cost, 0)::BIGINT AS cost,
           coalesce(way.audit, '') AS audit, sha256(coalesce(left(way.lines, length(way.lines) - 1), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
    LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM o.conv_id
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    repair = repair_conversations(damage_conversations(turns))
    digests = conversation_digests(repair.rows).withColumnRenamed("conv", "c")
    every = turns.select("conv_id").distinct()
    found = every.join(repair.report, F.col("conv_id").eqNullSafe(F.col("conv")), "left").join(digests, F.col("conv_id").eqNullSafe(F.col("c")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    none = F.sha2(F.lit("").cast("binary"), 256)
    return found.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", none).alias("repaired_sha256"))
