"""The registered queries of this folder and their SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwell.llm import (
    fm_index,
    merkle,
    mixing,
    nbsvm,
    near_dups,
    packing,
    periodic,
    rans,
    sketches,
    suffix_tree,
    text,
    url_rules,
    warc,
    weak_rules,
)
from driftwell.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# --- 1: packing -------------------------------------------------------------


def op1_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return packing.pack(packing.tokenized_pieces(docs, tokenizer_path("word_bpe_49k.json"), False, True, 1))


# --- 2: quality classifier --------------------------------------------------

#: Scores from here on count as good.
ACCEPT = 0.7


def quality_model(docs: DataFrame, folder: str) -> nbsvm.Model:
    """Learns from labelled rows outside the held-out part."""
    labels = table(docs.sparkSession, folder, "labels").where(text.remainder(F.col("doc_id"), 4) != 2)
    return nbsvm.fit(docs, labels.select("doc_id", F.col("quality").alias("label")))


def op2_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    scored = nbsvm.with_score(docs.select("doc_id", "text"), quality_model(docs, folder))
    return scored.select(
        "doc_id",
        (text.remainder(F.col("doc_id"), 4) == 2).alias("held_out"),
        "score",
        F.when(F.col("score") >= ACCEPT, 1).otherwise(0).alias("predicted"),
    )


# --- 3: quality rules -------------------------------------------------------


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = weak_rules.apply_rules(table(spark, folder, "documents"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *counts, "base_failed", "kept", "quality")


# --- 4: language-model scores -----------------------------------------------


def op4_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    scored = suffix_tree.score_texts(docs, text.remainder(F.col("doc_id"), 7) != 2)
    return scored.withColumn("held_out", text.remainder(F.col("doc_id"), 7) == 2).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


# --- 5: mixing --------------------------------------------------------------


def op5_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return mixing.mix_sources(docs.select("doc_id", "source", text.count_words(F.col("text")).alias("size")))


# --- 6: token files ---------------------------------------------------------


def op6_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    rans.write_tokens(table(spark, folder, "documents"), path, tokenizer_path("byte_bpe_50k.json"), True, False, 0)
    return rans.read_tokens(spark, path, with_ids=False)


# --- 7: URL filters ---------------------------------------------------------

HOST_RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
PATTERN_RULES = (
    ("*/casino/*", "block"),
    ("*/login/*", "block"),
    ("*/wp-admin/*", "block"),
    ("*/cart/*", "block"),
    ("*/tag/*/page/*", "block"),
    ("*free-download.*", "block"),
    ("*.exe", "block"),
    ("*//*", "block"),
)


def url_rule_list() -> list[url_rules.UrlRule]:
    return [url_rules.host_rule(*r) for r in HOST_RULES] + [url_rules.wildcard_rule(*r) for r in PATTERN_RULES]


def op7_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    judged = url_rules.judge_urls(pages, url_rule_list())
    return judged.select("page_id", "host", "path", "rule", "verdict")


def _url_sql() -> str:
    fits = " ".join(
        f"WHEN (host = '{h}' OR suffix(host, '.{h}')) AND starts_with(path, '/{p}') THEN '{name}'"
        for name, h, p in sorted(
            ((n, *n.split("/", 1)) for n, _ in HOST_RULES), key=lambda r: -len(r[0])
        )
    )
    like = " OR ".join(
        f"host || path LIKE '{n.replace('*', '%')}'" for n, action in PATTERN_RULES if action == "block"
    )
    blocked = ", ".join(f"'{n}'" for n, action in HOST_RULES if action == "block")
    upper, lower = text.UPPER, text.LOWER
    return f"""
WITH cut AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
             FROM pages),
hosts AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{upper}', '{lower}') AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
ruled AS (SELECT *, CASE {fits} END AS rule FROM hosts)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ({blocked}) THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN {like} THEN 'block' ELSE 'allow' END AS verdict
FROM ruled"""


# --- 8: fingerprints --------------------------------------------------------


def op8_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return sketches.fingerprints(table(spark, folder, "documents"))


# --- 9: near duplicates -----------------------------------------------------


def op9_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    found = near_dups.near_duplicates(table(spark, folder, "documents"), 0.85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


# --- 10: archives -----------------------------------------------------------


def op10_warc_archives(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "archives")
    warc.write_archives(table(spark, folder, "pages"), path)
    return warc.read_archives(spark, path, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


_ARCHIVES_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                  sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to FROM f"""


#: crc32 of a decimal text, bit by bit.
_CRC_SQL = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""


# --- 11: periodic runs ------------------------------------------------------


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Rows doc_id, text: in one text of ten all words from some word on repeat a few."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))

    def repeated(ws: Column) -> Column:
        n, g = F.size(ws), F.floor(h / 10)
        a = g % F.greatest(n, F.lit(1))
        p = 1 + F.floor((n - a) / (3 + g % 8))
        spots = F.transform(F.sequence(F.lit(0).cast("long"), n.cast("long") - 1), lambda i: F.when(i < a, i).otherwise(a + (i - a) % p))
        return F.when(n > 0, F.array_join(F.transform(spots, lambda i: F.get(ws, i.cast("int"))), " ")).otherwise("")

    planted = text.let(text.words(F.col("text")), repeated)
    return rows.withColumn("text", F.when(h % 10 == 0, planted).otherwise(F.col("text")))


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic.repeated_runs(with_planted_runs(table(spark, folder, "documents")))
    longer = "CASE WHEN x.length * y.period <> y.length * x.period THEN sign(y.length * x.period - x.length * y.period)"
    by_exponent = f"{longer} WHEN x.start <> y.start THEN sign(x.start - y.start) ELSE sign(x.period - y.period) END"
    best = F.expr(f"get(array_sort(runs, (x, y) -> int({by_exponent})), 0)")
    line = F.concat_ws("", F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).alias("exponent_milli"),
        F.sha2(line.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def _runs_sql() -> str:
    least, times = periodic.LEAST, periodic.TIMES
    return f"""
WITH texts AS (SELECT doc_id, {_CRC_SQL} AS h, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
sized AS (SELECT *, len(ws) AS n, CASE WHEN len(ws) > 0 THEN (h // 10) % len(ws) ELSE 0 END AS a FROM texts),
spots AS (SELECT doc_id, n, ws, unnest(range(n)) AS i, a, 1 + (n - a) // (3 + (h // 10) % 8) AS p, h % 10 = 0 AS planted FROM sized),
words AS (SELECT doc_id, n, i, ws[1 + CASE WHEN planted AND i >= a THEN a + (i - a) % p ELSE i END] AS w FROM spots),
equal AS (SELECT x.doc_id, y.i - x.i AS q, x.i FROM words x JOIN words y
          ON x.doc_id = y.doc_id AND x.w = y.w AND y.i > x.i AND {times} * (y.i - x.i) <= x.n),
stretches AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length
              FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM equal)
              GROUP BY doc_id, q, island HAVING count(*) + q >= greatest({least}, {times} * q)),
runs AS (SELECT doc_id, start, length, min(q) AS period FROM stretches GROUP BY doc_id, start, length),
best AS (SELECT * FROM (SELECT x.*, row_number() OVER (PARTITION BY doc_id ORDER BY better, start, period) AS place
         FROM (SELECT x.*, (SELECT count(*) FROM runs y WHERE y.doc_id = x.doc_id AND y.length * x.period > x.length * y.period) AS better
               FROM runs x) x) WHERE place = 1),
listed AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
           FROM runs GROUP BY doc_id),
dropped AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS line FROM words ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id)
SELECT t.doc_id, coalesce(n_runs, 0) AS n_runs, b.start, b.length, b.period, b.length * 1000 // b.period AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(line, '')) AS collapsed_sha256
FROM texts t LEFT JOIN best b USING (doc_id) LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)"""


# --- 12: decontamination ----------------------------------------------------


def op12_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = fm_index.find_overlaps(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    hit = fm_index.covered(F.col("spans"))
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def _overlap_sql() -> str:
    def words(of: str) -> str:
        lower = f"translate(coalesce(text, ''), '{text.UPPER}', '{text.LOWER}')"
        return f"SELECT {of} AS id, regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words"

    def windows(of: str, length: str) -> str:
        return f"""SELECT DISTINCT id, i, l, array_to_string(words[i + 1 : i + l], ' ') AS phrase FROM (
  SELECT id, words, {length} AS l, unnest(range(0, len(words) - {length} + 1)) AS i FROM {of})"""

    return f"""
WITH items AS ({words("item_id::VARCHAR")} FROM benchmark),
docs AS ({words("doc_id")} FROM documents),
phrases AS (SELECT DISTINCT id, l, phrase FROM ({windows("items", f"least({fm_index.WINDOW}, len(words))")}) WHERE l > 0),
lengths AS (SELECT DISTINCT l AS length FROM phrases),
places AS ({windows("(SELECT * FROM docs, lengths)", "length")}),
hits AS (SELECT p.id AS doc_id, p.i, p.l, q.id AS item FROM places p JOIN phrases q USING (l, phrase)),
covered AS (SELECT doc_id, count(DISTINCT w) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + l)) AS w FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
          FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT id AS doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN covered ON covered.doc_id = id LEFT JOIN found ON found.doc_id = id"""


# --- 13: manifest -----------------------------------------------------------


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    tampered = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0) & F.col("doc_id").isNotNull()
    rows = docs.select(
        "doc_id",
        "source",
        merkle.document_leaves(docs, F.col("text")).alias("leaf"),
        F.when(tampered, merkle.document_leaves(docs, text.ascii_lower(F.col("text")))).alias("claim"),
    )
    proofs = merkle.prove(rows, "source", "doc_id", "leaf", "claim")
    return proofs.select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )


def _merkle_sql() -> str:
    def field(c: str) -> str:
        return f"coalesce(octet_length(encode({c}::VARCHAR))::VARCHAR || ':' || {c}::VARCHAR, '-')"

    head = " || ".join(map(field, ("doc_id", "source", "lang", "n_chars")))
    lower = f"translate(text, '{text.UPPER}', '{text.LOWER}')"

    def levels(name: str, start: str) -> str:
        """Nodes of all levels, their number in the level, and how many there are."""
        return f"""{name} AS (
  {start}
  UNION ALL
  SELECT tree, level + 1, i // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY i))
  FROM {name} WHERE n > 1 GROUP BY tree, level, i // 16, n)"""

    def siblings(name: str) -> str:
        return f"""
  SELECT b.tree, b.i, coalesce(string_agg(s.digest, '' ORDER BY s.level, s.i), '') AS path
  FROM {name} b LEFT JOIN {name} s ON s.tree IS NOT DISTINCT FROM b.tree AND s.n > 1
    AND s.i // 16 = (b.i // (16 ** s.level)::BIGINT) // 16 AND s.i <> b.i // (16 ** s.level)::BIGINT
  WHERE b.level = 0 GROUP BY b.tree, b.i"""

    return f"""
WITH RECURSIVE rows AS (
  SELECT doc_id, source, {_CRC_SQL} % 5 = 0 AS tampered, sha256({head} || {field("text")}) AS leaf,
         sha256({head} || {field(lower)}) AS changed,
         row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY source) AS n
  FROM documents),
{levels("nodes", "SELECT source AS tree, 0 AS level, i, n, leaf AS digest FROM rows")},
sub AS (SELECT tree, digest, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS i, count(*) OVER () AS n
        FROM nodes WHERE n = 1),
{levels("tops", "SELECT 'top' AS tree, 0 AS level, i, n, digest FROM sub")},
paths AS ({siblings("nodes")}),
top_paths AS ({siblings("tops")}),
proofs AS (
  SELECT r.*, s.digest AS subroot, s.i AS place, s.n AS trees, p.path || t.path AS path,
         (SELECT digest FROM tops WHERE n = 1) AS root
  FROM rows r JOIN sub s ON s.tree IS NOT DISTINCT FROM r.source
  JOIN paths p ON p.tree IS NOT DISTINCT FROM r.source AND p.i = r.i
  JOIN top_paths t ON t.i = s.i),
walk AS (
  SELECT doc_id, i, n, place, trees, path, CASE WHEN tampered THEN changed ELSE leaf END AS digest FROM proofs
  UNION ALL
  SELECT doc_id,
         CASE WHEN n > 1 THEN i // 16 ELSE i END,
         CASE WHEN n > 1 THEN (n + 15) // 16 ELSE n END,
         CASE WHEN n > 1 THEN place ELSE place // 16 END,
         CASE WHEN n > 1 THEN trees ELSE (trees + 15) // 16 END,
         substr(path, 64 * (least(16, width - spot // 16 * 16) - 1) + 1),
         sha256(substr(path, 1, 64 * (spot % 16)) || digest
                || substr(path, 64 * (spot % 16) + 1, 64 * (least(16, width - spot // 16 * 16) - 1 - spot % 16)))
  FROM (SELECT *, CASE WHEN n > 1 THEN i ELSE place END AS spot, CASE WHEN n > 1 THEN n ELSE trees END AS width FROM walk)
  WHERE width > 1),
ends AS (SELECT doc_id, digest AS folded_root FROM walk WHERE n = 1 AND trees = 1)
SELECT doc_id, leaf, subroot, root, sha256(path) AS proof_sha256, folded_root, folded_root = root AS verified
FROM proofs JOIN ends USING (doc_id)"""


def queries() -> dict[str, Query]:
    return {
        "op1_best_fit_packing": op1_best_fit_packing,
        "op2_quality_classifier": op2_quality_classifier,
        "op3_quality_rules": op3_quality_rules,
        "op4_lm_scores": op4_lm_scores,
        "op5_mix_sources": op5_mix_sources,
        "op6_token_files": op6_token_files,
        "op7_url_filters": op7_url_filters,
        "op8_fingerprints": op8_fingerprints,
        "op9_near_duplicates": op9_near_duplicates,
        "op10_warc_archives": op10_warc_archives,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_decontamination": op12_decontamination,
        "op13_merkle_manifest": op13_merkle_manifest,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op7_url_filters": _url_sql(),
        "op10_warc_archives": _ARCHIVES_SQL,
        "op11_periodic_runs": _runs_sql(),
        "op12_decontamination": _overlap_sql(),
        "op13_merkle_manifest": _merkle_sql(),
    }
