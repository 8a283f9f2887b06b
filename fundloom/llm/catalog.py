"""The registered query of each operator, with production parameters, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from fundloom.llm import (
    bpe,
    forest,
    langid,
    lexical,
    licenses,
    merkle,
    mixing,
    passages,
    quality,
    secret_scan,
    sharding,
    simhash,
    sketches,
)
from fundloom.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def hex_sha256(text):
    return F.sha2(text.cast("binary"), 256)


@query("op1_simhash_near_duplicates")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"), words=4, max_bits=4)
    return found.select("doc_id", "fingerprint", "component_id")


@query("op7_secret_scan")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.find_secrets(docs, BYTE_RANKS).drop("text")
    base = F.filter("secrets", lambda s: s["kind"] != "random")

    def count(kind: str):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        hex_sha256(listed(base)).alias("base_sha256"),
        listed(F.col("secrets")).alias("spans"),
        count("random"),
    )


@query("op8_bpe_round_trip")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip_documents(docs, WORD_BPE).select(
        "doc_id",
        "n_tokens",
        hex_sha256(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"),
        hex_sha256(F.col("decoded")).alias("decoded_sha256"),
    )


SHARDS = 16
#: The CRC-32 of a list of bytes: the table of the reflected polynomial, then one step for each byte.
_CRC_TABLE = """SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i::UBIGINT, [0::UBIGINT for _ in range(8)]),
  lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END)) AS t"""


@query(
    "op9_jump_hash_shards",
    f"""WITH RECURSIVE crc AS ({_CRC_TABLE}),
    rows_ AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
    wide AS (SELECT r, doc_id, text, CASE WHEN coalesce(doc_id, 0) < 0 THEN coalesce(doc_id, 0)::HUGEINT
      + 18446744073709551616::HUGEINT ELSE coalesce(doc_id, 0)::HUGEINT END AS k, n
      FROM rows_, (VALUES ({SHARDS}), ({SHARDS + 1})) AS s(n)),
    walk AS (SELECT r, n, k, 0::BIGINT AS at_, 0::BIGINT AS j FROM wide
      UNION ALL
      SELECT r, n, k2, j, floor((j + 1)::DOUBLE * (2147483648.0::DOUBLE / ((k2 // 8589934592)::DOUBLE + 1)))::BIGINT
      FROM (SELECT *, (k * 2862933555777941757::HUGEINT + 1) % 18446744073709551616::HUGEINT AS k2
        FROM walk WHERE j < n)),
    ends AS (SELECT r, n, max(at_) AS shard FROM walk GROUP BY 1, 2),
    sized AS (SELECT r, doc_id, octet_length(encode(text)) + 1 AS size,
      xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT,
        list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: ('0x' || x)::UBIGINT)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255)::BIGINT + 1]))) AS text_crc32
      FROM rows_, crc)
    SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, a.shard::INTEGER AS shard,
      row_number() OVER (PARTITION BY a.shard ORDER BY substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || size || '|'
        || text_crc32), 1, {sharding.BLOCK_DIGITS}), doc_id NULLS FIRST, size, text_crc32) - 1 AS slot, b.shard::INTEGER AS grown_shard
    FROM sized JOIN ends a ON a.r = sized.r AND a.n = {SHARDS} JOIN ends b ON b.r = sized.r AND b.n = {SHARDS + 1}""",
)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    placed = sharding.shard_documents(docs, SHARDS)
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


@query("op10_language_id")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return langid.identify(docs).select("doc_id", "held_out", "lang_pred", "score")


@query("op6_document_fingerprints")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sketches.edited_documents(read(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        hex_sha256(F.col("edited")).alias("edited_sha256"),
        sketches.as_text(F.col("sketch")).alias("fingerprint"),
        sketches.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        sketches.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        sketches.resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        sketches.containment(F.col("edited_sketch"), F.col("sketch")).alias("edited_in_text"),
        sketches.distinct_shingles(F.col("sketch")).alias("n_shingles"),
    )


@query("op3_repeated_passages")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = passages.repeated_passages(read(spark, sf_dir, "documents"))
    kept = F.coalesce(hex_sha256(F.col("kept")), F.col("whole_sha256"))
    return found.select("doc_id", "n_words", "n_removed", kept.alias("kept_sha256"))


@query("op4_hash_prefix_forest")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.nearest_neighbours(read(spark, sf_dir, "embeddings"), every=100, nearest=10)


def _licenses_sql() -> str:
    quoted = [(n, t.replace("'", "''")) for n, t in licenses.KNOWN_TEXTS]
    values = ", ".join(f"('{n}', '{t}')" for n, t in quoted)
    return f"""WITH known AS (SELECT license, sha256({licenses.canonical_sql('t')}) AS digest
      FROM (VALUES {values}) AS k(license, t)),
    rows_ AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
    lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM rows_),
    found AS (SELECT r, string_agg(DISTINCT license, ',' ORDER BY license) AS line_licenses
      FROM (SELECT r, sha256({licenses.canonical_sql('line')}) AS digest FROM lines) JOIN known USING (digest)
      GROUP BY r)
    SELECT doc_id, digest, license, coalesce(line_licenses, '') AS line_licenses
    FROM (SELECT r, doc_id, sha256({licenses.canonical_sql('text')}) AS digest FROM rows_)
    LEFT JOIN known USING (digest) LEFT JOIN found USING (r)"""


@query("op2_license_scan", _licenses_sql())
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read(spark, sf_dir, "documents"))


@query("op5_pfair_mixture")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix(docs).select("doc_id", "source", "block", "slot", "position")


LEAF_COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Levels that the SQL spells out: enough for 8^9 rows of a language.
_SQL_LEVELS = 9


def _merkle_sql() -> str:
    def value(c: str) -> str:
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE octet_length(encode({c}::VARCHAR))::VARCHAR || ':' || {c}::VARCHAR END"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(value(text if c == "text" else c) for c in LEAF_COLUMNS) + ")"

    run = "PARTITION BY g, idx // 8 ORDER BY idx ROWS BETWEEN"

    def tree(name: str) -> str:
        """Levels {name}0, {name}1, ... with siblings, of nodes {name}n0 (g, idx, n, node)."""
        ctes = []
        for k in range(_SQL_LEVELS):
            ctes.append(f"""{name}{k} AS (SELECT g, idx, n, node,
              coalesce(string_agg(node, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lft,
              coalesce(string_agg(node, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rgt
              FROM {name}n{k} WHERE n > 1)""")
            ctes.append(f"""{name}n{k + 1} AS (SELECT g, idx // 8 AS idx, (n + 7) // 8 AS n,
              sha256(node || rgt) AS node FROM {name}{k} WHERE idx % 8 = 0)""")
        tops = " UNION ALL ".join(f"SELECT g, node FROM {name}n{k} WHERE n = 1" for k in range(_SQL_LEVELS + 1))
        return ", ".join(ctes) + f", {name}top AS ({tops})"

    def walk(name: str, source: str) -> str:
        """Folded digest and proof of every row of `source` (r, g, idx, fold, proof) at the top of its tree."""
        ctes, before = [], source
        for k in range(_SQL_LEVELS):
            ctes.append(f"""{name}w{k} AS (SELECT w.* REPLACE (w.idx // 8 AS idx,
              CASE WHEN s.g IS NULL THEN fold ELSE sha256(s.lft || fold || s.rgt) END AS fold,
              CASE WHEN s.g IS NULL THEN proof ELSE proof || s.lft || s.rgt END AS proof)
              FROM {before} w LEFT JOIN {name}{k} s ON s.g = w.g AND s.idx = w.idx)""")
            before = f"{name}w{k}"
        return ", ".join(ctes)

    last = _SQL_LEVELS - 1
    return f"""WITH RECURSIVE crc AS MATERIALIZED ({_CRC_TABLE}),
    rows_ AS (SELECT row_number() OVER () AS r, *, coalesce('+' || lang, '') AS g FROM documents),
    leaves AS MATERIALIZED (SELECT r, doc_id, g, {leaf('text')} AS node, CASE WHEN xor(4294967295::UBIGINT, list_reduce(
        list_prepend(4294967295::UBIGINT, list_transform(regexp_extract_all(hex(encode(coalesce(doc_id::VARCHAR, ''))),
        '..'), lambda x: ('0x' || x)::UBIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255)::BIGINT + 1]))) % 3 = 0
      THEN {leaf(f"translate(text, '{_UPPER}', '{_LOWER}')")} ELSE {leaf('text')} END AS claim FROM rows_, crc),
    an AS MATERIALIZED (SELECT r, doc_id, g, node, claim, count(*) OVER (PARTITION BY g) AS n,
      row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, node) - 1 AS idx FROM leaves),
    an0 AS (SELECT g, idx, n, node FROM an), {tree('a')},
    bs AS MATERIALIZED (SELECT g AS lang_, node, count(*) OVER () AS n, row_number() OVER (ORDER BY g) - 1 AS idx FROM atop),
    bn0 AS (SELECT '' AS g, idx, n, node FROM bs), {tree('b')},
    a_in AS (SELECT r, doc_id, g, node AS leaf, idx, claim AS fold, '' AS proof FROM an), {walk('a', 'a_in')},
    b_in AS (SELECT r, doc_id, leaf, fold, proof, s.node AS subroot, '' AS g, s.idx
      FROM aw{last} w JOIN bs s ON s.lang_ = w.g), {walk('b', 'b_in')}
    SELECT doc_id, leaf, subroot, t.node AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = t.node AS verified
    FROM bw{last}, btop t"""


@query("op11_merkle_manifest", _merkle_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(*LEAF_COLUMNS)
    tampered = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 0
    text = F.when(tampered, F.translate("text", _UPPER, _LOWER)).otherwise(F.col("text"))
    claim = merkle.leaf_digest([text if c == "text" else F.col(c) for c in LEAF_COLUMNS])
    found = merkle.manifest(docs, LEAF_COLUMNS, claim=claim)
    found = found.withColumn("folded_root", merkle.folded(F.col("claim"), F.col("path")))
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        hex_sha256(merkle.proof_text(F.col("path"))).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


_TERMS = r"regexp_extract_all(translate({}, '" + _UPPER + "', '" + _LOWER + r"'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


@query(
    "op13_reversed_search",
    f"""WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_TERMS.format("coalesce(text, '')")} AS terms
      FROM documents),
    totals AS (SELECT count(*)::BIGINT AS big_n, sum(len(terms))::BIGINT AS big_l FROM docs WHERE len(terms) > 0),
    wanted AS (SELECT DISTINCT item_id, unnest({_TERMS.format("coalesce(text, '')")}) AS term FROM benchmark),
    tfs AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(terms) AS term FROM docs) GROUP BY ALL),
    weights AS (SELECT term, floor(1000 * ln((2 * any_value(big_n) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
      FROM tfs, totals GROUP BY term),
    lengths AS (SELECT r, doc_id, 10 + (90 * len(terms)::BIGINT * big_n) // big_l AS m FROM docs, totals WHERE len(terms) > 0),
    scores AS (SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
      FROM wanted JOIN tfs USING (term) JOIN weights USING (term) JOIN lengths USING (r) GROUP BY ALL),
    ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST)::INTEGER
      AS rank, doc_id, score FROM scores WHERE score > 0)
    SELECT * FROM ranked WHERE rank <= 10""",
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), most=10)


@query("op12_passage_attention")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = quality.rate_documents(docs, read(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")
