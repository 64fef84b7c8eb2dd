"""The corpus queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from rosterline.llm import (
    chat_tools, decontamination, licenses, line_dedup, manifest, packing, repeats, simhash, spectra, syncmers, token_counts, toxicity,
    url_filters,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def register(build):
        QUERIES[build.__name__] = build
        if sql:
            SQL[build.__name__] = sql.strip()
        return build

    return register


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (SELECT r, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM docs),
keyed AS (
  SELECT r, line, pos, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
frequent AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10),
kept AS (
  SELECT k.r, count(*) AS n_lines, count(f.key) AS n_dropped,
    string_agg(k.line, chr(10) ORDER BY k.pos) FILTER (WHERE f.key IS NULL) AS text
  FROM keyed k LEFT JOIN frequent f USING (key) GROUP BY k.r)
SELECT d.doc_id, k.n_lines, k.n_dropped, sha256(coalesce(k.text, '')) AS kept_sha256
FROM docs d JOIN kept k USING (r)
""")
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = line_dedup.deduplicate_lines(table(spark, sf_dir, "documents"))
    digest = F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)
    return result.select("doc_id", "n_lines", "n_dropped", digest.alias("kept_sha256"))


@query("""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT item_id::VARCHAR AS item_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
sized AS (SELECT item_id, w, least(10, len(w)) AS n FROM items WHERE len(w) > 0),
item_windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[p : p + n - 1], ' ') AS key
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM sized)),
doc_windows AS (
  SELECT r, p, n, array_to_string(w[p : p + n - 1], ' ') AS key
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p
    FROM docs CROSS JOIN (SELECT DISTINCT n FROM sized) WHERE len(w) >= n)),
found AS (SELECT r, p, n, item_id FROM doc_windows JOIN item_windows USING (n, key)),
hit AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM found) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, item_id FROM found) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
""")
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.locate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query()
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, max_distance=3)
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@query()
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=2, max_tokens=4096)


@query()
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    found = toxicity.scored(docs, model, keep=["doc_id"])
    return found.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query()
def op5_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = syncmers.with_edited(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", F.char_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_chars"),
        F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", "near_edited", "near_next",
    )


@query()
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    end_id = 49407  # <|endoftext|> of this tokenizer
    flat = token_counts.write_flat_files(table(spark, sf_dir, "documents"), tokenizer_path(), end_id)
    found = token_counts.document_lengths(flat, end_id)
    return found.select(F.get("doc_ids", F.col("index")).alias("doc_id"), "file_id", "ordinal", "start", "n_tokens", "complete")


_TEMPLATE_ROWS = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in licenses.TEMPLATES.items())


@query(f"""
WITH lowered AS (
  SELECT row_number() OVER () AS r, doc_id, 'd' AS kind,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
  UNION ALL
  SELECT 0, 0, license, translate(body, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
  FROM (VALUES {_TEMPLATE_ROWS}) AS v(license, body)),
words AS (SELECT r, doc_id, kind, regexp_extract_all(t, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM lowered),
shingles AS (
  SELECT DISTINCT r, doc_id, kind, array_to_string(w[i : i + 4], ' ') AS s
  FROM (SELECT r, doc_id, kind, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM words WHERE len(w) > 0)),
templates AS (SELECT kind AS license, s, count(*) OVER (PARTITION BY kind) AS n FROM shingles WHERE kind <> 'd')
SELECT doc_id, license, count(*)::INT AS n_found, n::INT AS n_shingles, count(*) / n AS containment
FROM (SELECT * FROM shingles WHERE kind = 'd') JOIN templates USING (s)
GROUP BY r, doc_id, license, n HAVING count(*) / n >= 0.8
""")
def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


_LISTED = """
named AS (
  SELECT page_id, {host} AS host FROM pages),
known AS (
  SELECT regexp_replace(host, '^(www|blog|m)[.]', '') AS domain, min(page_id) AS m
  FROM named WHERE host IS NOT NULL AND host LIKE '%.%' GROUP BY 1),
entries AS (
  SELECT domain, CASE m % 2 WHEN 0 THEN 'ads' ELSE 'malware' END AS category, 'add' AS action, (m * 31) % 200 AS day FROM known WHERE m % 3 = 0
  UNION ALL SELECT domain, CASE m % 2 WHEN 0 THEN 'ads' ELSE 'malware' END, 'remove', (m * 31) % 200 + 20 + m % 90 FROM known WHERE m % 3 = 0 AND m % 5 <> 0
  UNION ALL SELECT domain, CASE m % 2 WHEN 0 THEN 'ads' ELSE 'malware' END, 'add', 300 + m % 50 FROM known WHERE m % 6 = 0
  UNION ALL SELECT domain, 'tracker', 'add', (m * 17) % 300 FROM known WHERE m % 4 = 1
  UNION ALL SELECT domain, 'tracker', 'add', (m * 17) % 300 + 5 FROM known WHERE m % 4 = 1)
"""


@query("WITH " + _LISTED.format(host=r"""nullif(regexp_extract(lower(trim(url)), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1), '')""") + """,
captures AS (
  SELECT DISTINCT page_id, url, (page_id * 7919) % 366 AS day,
    nullif(regexp_extract(lower(trim(url)), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1), '') AS host FROM pages),
as_of AS (
  SELECT page_id, url, c.day, c.host, e.domain, e.category, arg_max(e.action, e.day) AS action
  FROM captures c JOIN entries e ON (c.host = e.domain OR c.host LIKE '%.' || e.domain) AND e.day <= c.day
  GROUP BY ALL),
listed AS (SELECT page_id, url, day, list_sort(list(DISTINCT category)) AS categories FROM as_of WHERE action = 'add' GROUP BY ALL)
SELECT c.page_id, c.url, (DATE '2024-01-01' + c.day::INT)::DATE AS fetched_at, c.host,
  coalesce(array_to_string(l.categories, ','), '') AS categories, l.categories IS NOT NULL AS blocked
FROM captures c LEFT JOIN listed l ON c.page_id = l.page_id AND c.url IS NOT DISTINCT FROM l.url AND c.day = l.day
""")
def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures of ``pages`` on days that follow from their ids, against lists that follow from their hosts."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    day = lambda n: F.date_add(F.lit("2024-01-01").cast("date"), n.cast("int"))
    name = url_filters.host(F.col("url"))
    known = pages.select("page_id", name.alias("host")).where(F.col("host").contains("."))
    known = known.groupBy(F.regexp_replace("host", "^(www|blog|m)[.]", "").alias("domain")).agg(F.min("page_id").alias("m"))
    kind = "CASE m % 2 WHEN 0 THEN 'ads' ELSE 'malware' END"
    entries = known.select("domain", F.explode(F.expr(f"""filter(array(
        named_struct('on', m % 3 = 0, 'category', {kind}, 'action', 'add', 'day', (m * 31) % 200),
        named_struct('on', m % 3 = 0 AND m % 5 <> 0, 'category', {kind}, 'action', 'remove', 'day', (m * 31) % 200 + 20 + m % 90),
        named_struct('on', m % 6 = 0, 'category', {kind}, 'action', 'add', 'day', 300 + m % 50),
        named_struct('on', m % 4 = 1, 'category', 'tracker', 'action', 'add', 'day', (m * 17) % 300),
        named_struct('on', m % 4 = 1, 'category', 'tracker', 'action', 'add', 'day', (m * 17) % 300 + 5)), e -> e.on)""")).alias("e"))
    entries = entries.select("domain", "e.category", "e.action", day(F.col("e.day")).alias("at"))
    captures = pages.withColumn("fetched_at", day((F.col("page_id") * 7919) % 366))
    found = url_filters.filter_captures(captures, url_filters.validity(entries))
    return found.withColumn("categories", F.array_join("categories", ","))


CHAT_SCHEMAS = {
    "lookup": {"limit": ("integer", True), "query": ("string", True)},
    "search": {"limit": ("integer", False), "query": ("string", True)},
    "write": {"limit": ("integer", True), "query": ("string", True)},
}


@query("""
WITH RECURSIVE calls AS (
  SELECT conv_id, 'c' || conv_id || '-' || turn AS call_id, turn AS position,
    CASE turn % 3 WHEN 0 THEN 'lookup' WHEN 1 THEN 'search' ELSE 'write' END AS name,
    (conv_id + turn) % 5 AS v, substr(text, 1, 20) AS q,
    CASE WHEN turn >= 3 THEN ['c' || conv_id || '-' || (turn - 2)] ELSE [] END AS needs
  FROM conversations WHERE role = 'assistant'),
results AS (
  SELECT conv_id, 'c' || conv_id || '-' || (turn - 1) AS call_id, text FROM conversations WHERE role = 'user' AND turn > 0),
linked AS (
  SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.call_id, r.call_id) AS call_id, c.position, c.name, c.v, c.q,
    c.needs, r.text AS result, c.call_id IS NOT NULL AS called
  FROM calls c FULL JOIN results r ON c.conv_id = r.conv_id AND c.call_id = r.call_id),
chain AS (
  SELECT c.conv_id, c.position, 0 AS level FROM calls c
  WHERE c.position < 3 OR NOT EXISTS (SELECT 1 FROM calls p WHERE p.conv_id = c.conv_id AND p.position = c.position - 2)
  UNION ALL
  SELECT c.conv_id, c.position, h.level + 1 FROM chain h JOIN calls c ON c.conv_id = h.conv_id AND c.position = h.position + 2 AND c.position >= 3),
placed AS (
  SELECT l.*, len(l.needs) > 0 AND p.call_id IS NULL AS lacks, h.level
  FROM linked l LEFT JOIN calls p ON p.conv_id = l.conv_id AND p.position = l.position - 2 AND l.position >= 3
  LEFT JOIN chain h ON h.conv_id = l.conv_id AND h.position = l.position),
judged AS (
  SELECT *, CASE WHEN NOT called THEN ['no call'] ELSE list_sort(list_concat(
      CASE v WHEN 1 THEN ['type of limit'] WHEN 2 THEN ['missing query'] WHEN 3 THEN ['unknown debug'] ELSE [] END,
      CASE WHEN lacks THEN ['missing call'] ELSE [] END)) END AS problems,
    CASE WHEN NOT called THEN NULL
      WHEN v = 1 THEN '{"limit":"' || position || '","query":' || to_json(q) || '}'
      WHEN v = 2 THEN '{"limit":' || position || '}'
      WHEN v = 3 THEN '{"debug":true,"limit":' || position || ',"query":' || to_json(q) || '}'
      ELSE '{"limit":' || position || ',"query":' || to_json(q) || '}' END AS canonical
  FROM placed)
SELECT conv_id, call_id, level, position, name, array_to_string(problems, ', ') AS problems,
  '{' || coalesce('"arguments":' || canonical || ',', '') || '"call_id":"' || call_id || '","conv_id":' || conv_id
    || coalesce(',"level":' || level, '') || coalesce(',"name":"' || name || '"', '')
    || CASE WHEN called THEN ',"needs":' || to_json(needs) ELSE '' END || ',"problems":' || to_json(problems)
    || coalesce(',"result":' || to_json(result), '') || '}' AS json
FROM judged
""")
def op7_chat_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls stand for the assistant's turns of ``conversations``, results for the user turns after them."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    args = F.expr("""CASE (conv_id + turn) % 5
        WHEN 1 THEN to_json(named_struct('query', substr(text, 1, 20), 'limit', cast(turn AS string)))
        WHEN 2 THEN to_json(named_struct('limit', turn))
        WHEN 3 THEN to_json(named_struct('query', substr(text, 1, 20), 'limit', turn, 'debug', true))
        ELSE to_json(named_struct('query', substr(text, 1, 20), 'limit', turn)) END""")
    calls = turns.where("role = 'assistant'").select(
        "conv_id", F.expr("concat('c', conv_id, '-', turn)").alias("call_id"), F.col("turn").alias("position"),
        F.expr("CASE turn % 3 WHEN 0 THEN 'lookup' WHEN 1 THEN 'search' ELSE 'write' END").alias("name"), args.alias("arguments"),
        F.expr("CASE WHEN turn >= 3 THEN array(concat('c', conv_id, '-', turn - 2)) ELSE cast(array() AS array<string>) END").alias("needs"),
    )
    results = turns.where("role = 'user' AND turn > 0").select(
        "conv_id", F.expr("concat('c', conv_id, '-', turn - 1)").alias("call_id"), F.col("turn").alias("position"), F.col("text").alias("content")
    )
    found = chat_tools.format_calls(calls, results, CHAT_SCHEMAS)
    return found.withColumn("problems", F.array_join("problems", ", "))


@query()
def op11_spectra(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spectra.whiten(table(spark, sf_dir, "embeddings"))


@query(r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT r, doc_id, p, array_to_string(w[p : p + 12], ' ') AS key
  FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS p FROM docs WHERE len(w) >= 13)),
firsts AS (SELECT key, min(doc_id) AS first_id FROM windows GROUP BY key HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT r, unnest(range(p, p + 13)) AS q FROM windows JOIN firsts USING (key) WHERE doc_id > first_id),
kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY q) AS text, count(*) AS n
  FROM (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS q FROM docs) ANTI JOIN gone USING (r, q) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, len(w)::BIGINT - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)
""")
def op12_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


_LEAF = "sha256(" + " || ".join(
    f"CASE WHEN {c} IS NULL THEN '-' ELSE octet_length(encode(({c})::VARCHAR)) || ':' || ({c})::VARCHAR END"
    for c in ("doc_id", "source", "lang", "{n_chars}", "text")
) + ")"


@query(rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, coalesce('=' || lang, '-') AS tree, {_LEAF.format(n_chars="n_chars")} AS leaf, {_LEAF.format(n_chars="n_chars + 1")} AS other,
    xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) % 7 = 0 AS chosen
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS total,
    row_number() OVER () AS r FROM docs),
nodes AS (
  SELECT tree, 0 AS lvl, pos, leaf AS digest, total FROM leaves
  UNION ALL
  SELECT tree, lvl + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), any_value((total + 1) // 2)
  FROM nodes WHERE total > 1 GROUP BY tree, lvl, pos // 2),
subroots AS (SELECT tree, digest, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS total FROM nodes WHERE total = 1),
tops AS (
  SELECT 0 AS lvl, pos, digest, total FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), any_value((total + 1) // 2)
  FROM tops WHERE total > 1 GROUP BY lvl, pos // 2),
steps AS (
  SELECT r, n.lvl, (l.pos >> n.lvl) & 1 AS side, s.digest
  FROM leaves l JOIN nodes n ON n.tree = l.tree AND n.total > 1 AND n.pos = l.pos >> n.lvl
  LEFT JOIN nodes s ON s.tree = l.tree AND s.lvl = n.lvl AND s.pos = xor(l.pos >> n.lvl, 1)
  UNION ALL
  SELECT r, 1000 + n.lvl, (g.pos >> n.lvl) & 1, s.digest
  FROM leaves l JOIN subroots g USING (tree) JOIN tops n ON n.total > 1 AND n.pos = g.pos >> n.lvl
  LEFT JOIN tops s ON s.lvl = n.lvl AND s.pos = xor(g.pos >> n.lvl, 1)),
paths AS (
  SELECT r, list({{'side': side, 'digest': digest}} ORDER BY lvl) AS path, string_agg(digest, '' ORDER BY lvl) AS proof FROM steps GROUP BY r),
folded AS (
  SELECT l.*, coalesce(p.proof, '') AS proof, list_reduce(
      list_prepend({{'side': 0::BIGINT, 'digest': CASE WHEN chosen THEN other ELSE leaf END}}, coalesce(p.path, [])),
      lambda a, b: {{'side': 0::BIGINT, 'digest': sha256(CASE WHEN b.digest IS NULL THEN a.digest WHEN b.side = 1 THEN b.digest || a.digest
        ELSE a.digest || b.digest END)}}).digest AS folded_root
  FROM leaves l LEFT JOIN paths p USING (r))
SELECT doc_id, leaf, g.digest AS subroot, t.digest AS root, sha256(proof) AS proof_sha256, folded_root, folded_root = t.digest AS verified
FROM folded JOIN subroots g USING (tree) CROSS JOIN (SELECT digest FROM tops WHERE total = 1) t
""")
def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    found = manifest.manifest(table(spark, sf_dir, "documents"), tampered={"n_chars": F.col("n_chars") + 1}, when=chosen)
    proof = manifest.proof_digest(F.col("path")).alias("proof_sha256")
    return found.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", "verified")
