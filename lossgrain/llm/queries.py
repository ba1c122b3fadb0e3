"""The operators over the driver's tables; each query derives its digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lossgrain.llm import (
    chat_format, chunk_dedup, conversation_trie, decontaminate, line_dedup, merkle_manifest, perplexity_rules,
    pii_crf, secret_crf, sequence_packing, shard_balance, trie_join, warc_archive,
)
from lossgrain.llm.common import pin, ranked, table_if_there, tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


_PROBE = "</s>[INST] ok [/INST]"
_ESC = r"""regexp_replace(regexp_replace(replace({x}, '\', '\\'),
    '(<)(\||/?s>|</?SYS>>)', '\1\\\2', 'g'), '(\[)(/?INST\])', '\1\\\2', 'g')"""


@query("op10_chat_format", f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{_PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{_PROBE}'),
e AS (SELECT *, {_ESC.format(x='text')} AS ex, {_ESC.format(x='role')} AS er,
        CASE WHEN role IS DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text)
             THEN 1 ELSE 0 END AS first FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), ''))
    AS loss_sha256,
  CAST(sum(length(ex) + CASE WHEN first = 1 THEN length(er) + {len('<|turn|><|text|><|end|>')}
                             ELSE {len('<|sep|>')} END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
""")
def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = tables(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    kinds = dict(turns.dtypes)
    probe = spark.createDataFrame(
        [(-1, 0, "user", _PROBE), (-1, 1, "assistant", _PROBE)],
        "conv_id bigint, turn bigint, role string, text string",
    ).select(F.col("conv_id").cast(kinds["conv_id"]), F.col("turn").cast(kinds["turn"]), "role", "text")
    chats = chat_format.format_chats(turns.unionByName(probe))
    back = chats.select(
        "conv_id", "formatted", chat_format.parse_chats(F.col("formatted")).alias("back"),
        chat_format.masked_text(F.col("formatted"), F.col("loss_mask")).alias("loss"))
    return back.select(
        "conv_id", F.size("back").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("back", lambda t: F.concat(
            t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


@query("op9_warc_archive", """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS b, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS m FROM p WHERE b >= 100 GROUP BY d)
SELECT page_id, b AS payload_bytes, d AS payload_digest,
  CASE WHEN b >= 100 AND m <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN b >= 100 AND m <> page_id THEN m END AS refers_to
FROM p LEFT JOIN f USING (d)
""")
def op9_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc_archive.archive_path(spark)
    warc_archive.write_archives(tables(spark, sf_dir, "pages"), path)
    return warc_archive.read_archives(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op7_balanced_labels")
def op7_balanced_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = tables(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.sha2(text, 256).alias("same"))
    placed = pin(shard_balance.balance(docs, "same", 16).drop("same"))
    spread = 64
    return ranked(placed, "shard", ["doc_id", "text_crc32", "size"], "slot",
                  F.pmod(F.xxhash64("doc_id"), F.lit(spread)), spread).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query("op2_sequence_packing")
def op2_sequence_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence_packing.pack_documents(tables(spark, sf_dir, "documents"))


@query("op6_chunk_dedup")
def op6_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.repeats(tables(spark, sf_dir, "documents"))


@query("op3_spaced_seeds")
def op3_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.overlaps(
        tables(spark, sf_dir, "documents"), tables(spark, sf_dir, "benchmark"), short_items=True)
    return found.groupBy("doc_id", "item_id").agg(
        F.count(F.lit(1)).alias("n_places"), F.min("start").cast("long").alias("first_token"),
        F.max("matched").cast("long").alias("matched"), F.max("compared").cast("long").alias("compared"))


@query("op1_perplexity_rules")
def op1_perplexity_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity_rules.judge(
        tables(spark, sf_dir, "documents"), labels=table_if_there(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "kept", "lang", "log_perplexity")


@query("op8_trie_join")
def op8_trie_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_join.groups(tables(spark, sf_dir, "documents")).select(
        F.col("k").alias("doc_id"), "n_shingles", F.col("keeper").alias("component_id"))


def _span_digests(found: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """The contract's columns from the two span lists."""
    return found.select(
        "doc_id", *[F.regexp_count("base", F.lit(f"(^|,){k}:")).cast("long").alias(f"n_{k}") for k in kinds],
        F.sha2("base", 256).alias("base_sha256"), "spans")


@query("op4_pii_crf")
def op4_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables(spark, sf_dir, "documents")
    return _span_digests(pii_crf.detect(docs, pii_crf.fit(docs)), pii_crf.KINDS)


@query("op5_secret_crf")
def op5_secret_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables(spark, sf_dir, "documents")
    return _span_digests(secret_crf.detect(docs, secret_crf.fit(docs)), secret_crf.KINDS)


#: CRC-32 of the decimal text ``{x}`` beside ``crc``, which is the usual table, by its rule.
_CRC_TABLE = """crc AS (SELECT list_transform(range(256), lambda x: list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS crc_table)"""
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length({x})),
    lambda i: ord(substr({x}, i::INT + 1, 1))::BIGINT)),
    lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1])), 4294967295::BIGINT)"""


@query("op11_conversation_trie", f"""
WITH {_CRC_TABLE},
t AS (SELECT conv_id AS c, turn, sha256(strlen(r) || ':' || r || x) AS d, length(x) AS chars FROM (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL)),
n AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, d) - 1 AS k FROM t),
convs AS (SELECT c, {_CRC.format(x='CAST(c AS VARCHAR)')} % 6 AS h, c - ((c % 100) + 100) % 100 AS host, n_own
  FROM (SELECT c, count(*) AS n_own FROM n GROUP BY c), crc),
w AS (SELECT a.*, least(a.h, coalesce(b.n_own, 0)) AS taken FROM convs a LEFT JOIN convs b ON a.host = b.c),
rebuilt AS (SELECT w.c, k AS pos, d, chars FROM w JOIN n ON n.c = host WHERE k < h
  UNION ALL SELECT w.c, k - h + taken, d, chars FROM w JOIN n ON n.c = w.c WHERE k >= h),
p AS (SELECT c, pos + 1 AS depth, chars, string_agg(d, '') OVER (PARTITION BY c ORDER BY pos) AS pre FROM rebuilt
  UNION ALL SELECT c, 0, 0, '' FROM convs),
q AS (SELECT *, depth = max(depth) OVER (PARTITION BY c) AS ends FROM p),
nodes AS (SELECT pre, depth, min(c) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
  sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256
  FROM q GROUP BY pre, depth),
kids AS (SELECT left(pre, 64 * (depth - 1)) AS pre, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
whole AS (SELECT v.*, coalesce(n_children, 0) AS n_children FROM nodes v LEFT JOIN kids k ON v.pre = k.pre),
above AS (SELECT left(pre, 64 * d) AS pre, n_children, (n_convs - 1) * chars AS own
  FROM (SELECT *, unnest(range(depth + 1)) AS d FROM whole)),
sums AS (SELECT pre, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(own) AS saved FROM above GROUP BY pre)
SELECT v.conv_id, CAST(v.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, v.n_convs, v.n_children, n_leaves,
  CAST(saved AS BIGINT) AS saved_tokens, v.ends_sha256
FROM whole v JOIN sums s ON v.pre = s.pre LEFT JOIN nodes u ON v.depth > 0 AND u.pre = left(v.pre, 64 * (v.depth - 1))
""")
def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = conversation_trie.numbered_turns(tables(spark, sf_dir, "conversations"))
    rebuilt = conversation_trie.with_shared_start(
        turns, F.col("conv") - F.pmod("conv", F.lit(100)), F.crc32(F.col("conv").cast("string").cast("binary")) % 6)
    return conversation_trie.prefix_nodes(pin(conversation_trie.paths(rebuilt)))


def _hashed(*columns: str) -> str:
    """SQL of a leaf: each value behind its byte count, ``-`` for null."""
    return "sha256(" + " || ".join(
        f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in columns) + ")"


@query("op12_merkle_manifest", f"""
WITH RECURSIVE {_CRC_TABLE},
docs AS (SELECT *, CASE WHEN {_CRC.format(x='CAST(doc_id AS VARCHAR)')} % 7 = 0 THEN n_chars + 1 ELSE n_chars END AS m
  FROM documents, crc),
l AS (SELECT doc_id, lang, {_hashed('doc_id', 'source', 'lang', 'n_chars', 'text')} AS leaf,
  {_hashed('doc_id', 'source', 'lang', 'm', 'text')} AS changed FROM docs),
leaves AS (SELECT *, coalesce('=' || lang, '-') AS tree, row_number() OVER (
    PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM l),
nodes AS (SELECT tree, 0 AS lvl, i, n, leaf AS h FROM leaves
  UNION ALL SELECT tree, lvl + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM nodes
  WHERE n > 1 GROUP BY tree, lvl, i // 2, n),
subroots AS (SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1),
top AS (SELECT 0 AS lvl, i, n, h FROM subroots
  UNION ALL SELECT lvl + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM top
  WHERE n > 1 GROUP BY lvl, i // 2, n),
walk AS (SELECT tree, i AS leaf_i, i, 0 AS lvl, n, '' AS siblings, changed AS h FROM leaves
  UNION ALL SELECT w.tree, leaf_i, w.i // 2, w.lvl + 1, (w.n + 1) // 2, siblings || coalesce(o.h, ''),
    sha256(CASE WHEN w.i % 2 = 1 THEN o.h || w.h ELSE w.h || coalesce(o.h, '') END)
  FROM walk w LEFT JOIN nodes o ON o.tree = w.tree AND o.lvl = w.lvl AND o.i = xor(w.i, 1) WHERE w.n > 1),
up AS (SELECT w.tree, leaf_i, s.i, 0 AS lvl, s.n, siblings, w.h FROM walk w JOIN subroots s ON w.tree = s.tree WHERE w.n = 1
  UNION ALL SELECT w.tree, leaf_i, w.i // 2, w.lvl + 1, (w.n + 1) // 2, siblings || coalesce(o.h, ''),
    sha256(CASE WHEN w.i % 2 = 1 THEN o.h || w.h ELSE w.h || coalesce(o.h, '') END)
  FROM up w LEFT JOIN top o ON o.lvl = w.lvl AND o.i = xor(w.i, 1) WHERE w.n > 1)
SELECT doc_id, leaf, s.h AS subroot, r.h AS root, sha256(siblings) AS proof_sha256, u.h AS folded_root, u.h = r.h AS verified
FROM leaves x JOIN up u ON u.tree = x.tree AND u.leaf_i = x.i AND u.n = 1 JOIN subroots s ON s.tree = x.tree
JOIN top r ON r.n = 1
""")
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = merkle_manifest.FIELDS
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    whole = merkle_manifest.leaf_of(*[F.col(c) for c in names])
    changed = merkle_manifest.leaf_of(*[F.col(c) + 1 if c == "n_chars" else F.col(c) for c in names])
    manifest = merkle_manifest.of_table(
        tables(spark, sf_dir, "documents"), carry={"given": F.when(hit, changed).otherwise(whole)})
    proved = merkle_manifest.proofs(manifest)
    folded, root = merkle_manifest.fold(F.col("given"), F.col("proof")), F.lit(manifest.root)
    return proved.select(
        F.col("id").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", root.alias("root"),
        merkle_manifest.proof_digest(F.col("proof")).alias("proof_sha256"), folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


@query("op13_line_dedup", f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, unnest(range(len(lines))) AS i, unnest(lines) AS line FROM d),
k AS (SELECT *, translate(trim(line, {_BLANKS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
often AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10),
m AS (SELECT k.*, o.key IS NOT NULL AS gone FROM k LEFT JOIN often o ON k.key = o.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY r
""")
def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.drop_repeated(docs, least_docs=10, least_chars=1, keep_first=False).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
