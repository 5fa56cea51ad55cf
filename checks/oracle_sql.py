"""DuckDB oracle SQL for the registered queries.

Each entry is one SELECT over the pre-registered views (documents, events, ...). The
derived inputs use the same fixed formulas as ``shardloom.plans.fixtures``.
"""

from __future__ import annotations

# Fixed values, stated here again on purpose: the oracle shares no constant with the Spark side.
# White space: U+0009-000D, U+001C-0020, U+0085, U+00A0, U+1680, U+2000-200A, U+2028, U+2029, U+202F, U+205F, U+3000
WS = (r"\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
# Digits: category Nd and the superscript, subscript, circled and other digits below.
DIGIT = (r"\p{Nd}\x{B2}\x{B3}\x{B9}\x{1369}-\x{1371}\x{19DA}\x{2070}\x{2074}-\x{2079}\x{2080}-\x{2089}\x{2460}-\x{2468}"
         r"\x{2474}-\x{247C}\x{2488}-\x{2490}\x{24EA}\x{24F5}-\x{24FD}\x{24FF}\x{2776}-\x{277E}\x{2780}-\x{2788}\x{278A}-\x{2792}"
         r"\x{10A40}-\x{10A43}\x{10E60}-\x{10E68}\x{11052}-\x{1105A}\x{1F100}-\x{1F10A}")
BOILER = (r"(?i)^(?:(cookie|privacy) policy|all rights reserved|copyright \p{Nd}{4}|subscribe (to|now)|(sign|log) (in|up)"
          rf"|\p{{Nd}}+[{WS}]*(comments?|shares?|likes?|views?)|(click here|read more|see also)|advertisement|this (article|page) (was|is))")
HEADING = r"^=+.*=+$"
SYMBOLS = r"^[^\p{L}\p{N}]+$"
CITE_NUMBER = r"\[[0-9]+\]"
CITE = r"(?i)\[[^\]]*citation[^\]]*\]"
MIN_CHARS, MAX_CHARS, MIN_ALPHA, MAX_DIGIT = 100, 80000, 0.62, 0.15
PROTECTED = ["checkpoints/", "tokenizer/", "logs/", "data/manifests/", "data/tokenized/train_packed.bin",
             "data/tokenized/validation_packed.bin", "data/tokenized/test_packed.bin"]


def norm(x: str) -> str:
    return f"trim(regexp_replace({x}, '[{WS}]+', ' ', 'g'))"


def wiki(x: str) -> str:
    return f"replace(replace(replace({x}, '@-@', '-'), '@,@', ','), '@.@', '.')"


def heading(x: str) -> str:
    return f"regexp_matches({x}, '{HEADING}')"


def symbols(x: str) -> str:
    return f"regexp_matches({x}, '{SYMBOLS}')"


def boiler(x: str) -> str:
    return f"regexp_matches({x}, '{BOILER}')"


def cite(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '{CITE_NUMBER}', '', 'g'), '{CITE}', '', 'g')"


def alpha_cnt(x: str) -> str:
    return f"length(regexp_replace({x}, '[^\\p{{L}}{WS}]', '', 'g'))"


def digit_cnt(x: str) -> str:
    return f"length(regexp_replace({x}, '[^{DIGIT}]', '', 'g'))"


def ratio(cnt: str, x: str) -> str:
    return f"(CASE WHEN length({x}) > 0 THEN {cnt} / length({x}) ELSE 0.0 END)"


def quality_reason(c: str) -> str:
    return (f"(CASE WHEN length({c}) < {MIN_CHARS} THEN 'too_short' "
            f"WHEN length({c}) > {MAX_CHARS} THEN 'too_long' "
            f"WHEN {alpha_cnt(c)} / length({c}) < {MIN_ALPHA} THEN 'low_alpha' "
            f"WHEN {digit_cnt(c)} / length({c}) > {MAX_DIGIT} THEN 'high_digit' END)")


def not_blank(x: str) -> str:
    return f"({x} IS NOT NULL AND regexp_matches({x}, '[^{WS}]'))"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def policy(src: str) -> str:
    n = f"regexp_extract({src}, '([0-9]+)$', 1)"
    return (f"(CASE WHEN {n} = '' THEN 'default' WHEN CAST({n} AS BIGINT) % 3 = 0 THEN 'wikitext' "
            f"WHEN CAST({n} AS BIGINT) % 3 = 1 THEN 'bookcorpus' ELSE 'default' END)")


def sha256_mod(x: str) -> str:
    h = f"sha256({x})"
    acc = "CAST(0 AS BIGINT)"
    for i in range(8):
        acc = f"(({acc} * 4294967296 + CAST(('0x' || substr({h}, {i * 8 + 1}, 8)) AS BIGINT)) % 10000)"
    return acc


def split_of(x: str, test_cut: int = 500, val_cut: int = 1500) -> str:
    m = sha256_mod(x)
    return f"(CASE WHEN {m} < {test_cut} THEN 'test' WHEN {m} < {val_cut} THEN 'validation' ELSE 'train' END)"


LINES = f"""lines AS (
  SELECT source, doc_id, line_idx, line FROM (
    SELECT source, doc_id, unnest(lst) AS line, CAST(unnest(range(len(lst))) AS BIGINT) AS line_idx
    FROM (SELECT source, doc_id, string_split_regex(text, '\\r\\n|\\r|\\n') AS lst FROM documents))
  WHERE {not_blank('line')})"""

SHARDS = """sh AS (
  SELECT source, 'train' AS split, doc_id, text,
         CAST((row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 5 AS INTEGER) AS shard_idx
  FROM documents),
sh2 AS (SELECT *, printf('%s__%s__%06d', source, split, shard_idx) AS shard_id FROM sh),
shards AS (SELECT DISTINCT source, split, shard_idx, shard_id,
                  CAST(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT) AS n FROM sh2)"""

CLEANED = SHARDS + f""",
slines AS (
  SELECT source, split, shard_idx, shard_id, doc_id, line_idx, line FROM (
    SELECT source, split, shard_idx, shard_id, doc_id, unnest(lst) AS line,
           CAST(unnest(range(len(lst))) AS BIGINT) AS line_idx
    FROM (SELECT *, string_split_regex(text, '\\r\\n|\\r|\\n') AS lst FROM sh2))
  WHERE {not_blank('line')}),
c1 AS (SELECT *, {policy('source')} AS policy, {norm('line')} AS n FROM slines),
c2 AS (SELECT *, {wiki('n')} AS w FROM c1),
c3 AS (SELECT *,
  CASE WHEN policy = 'wikitext' THEN (CASE WHEN {heading('w')} OR {symbols('w')} THEN '' ELSE w END)
       WHEN policy = 'bookcorpus' THEN {cite(f"(CASE WHEN {boiler('n')} THEN '' ELSE n END)")}
       ELSE (CASE WHEN {boiler('n')} THEN '' ELSE n END) END AS cleaned,
  CASE WHEN policy = 'wikitext' AND {heading('w')} THEN 'heading'
       WHEN policy = 'wikitext' AND {symbols('w')} THEN 'symbols_only'
       WHEN policy <> 'wikitext' AND {boiler('n')} THEN 'boilerplate' END AS rule_reason
  FROM c2),
cleaned AS (SELECT *, coalesce(rule_reason, {quality_reason('cleaned')}) AS reject_reason FROM c3),
kept AS (SELECT *, sha1(cleaned) AS sha1 FROM cleaned WHERE reject_reason IS NULL),
dedup AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY shard_id, sha1 ORDER BY doc_id, line_idx) AS rn
                         FROM kept) WHERE rn = 1)"""


def W(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


ORACLE: dict[str, str] = {}

# ----------------------------------------------------------------------------- cleaning
ORACLE["clean_yield"] = W(CLEANED, """, ph AS (
  SELECT shard_id, CASE WHEN reject_reason IS NULL THEN sha1(cleaned) END AS sha1, count(*) AS n
  FROM cleaned GROUP BY 1, 2)
SELECT shard_id, CAST(sum(n) AS BIGINT) AS docs_in, count(sha1) AS docs_out FROM ph GROUP BY ROLLUP (shard_id)""")

ORACLE["explode_lines"] = W(LINES, "SELECT source, doc_id, line_idx, line FROM lines")
ORACLE["normalize_text"] = W(LINES, f"SELECT doc_id, line_idx, {norm('line')} AS normalized FROM lines")
ORACLE["wiki_artifacts"] = W(LINES, f"SELECT doc_id, line_idx, {wiki(norm('line'))} AS fixed FROM lines")
ORACLE["wiki_markup"] = W(LINES, f""", m AS (SELECT doc_id, line_idx, {wiki(norm('line'))} AS w FROM lines)
SELECT doc_id, line_idx, {heading('w')} AS is_heading, {symbols('w')} AS is_symbols_only,
       CASE WHEN {heading('w')} OR {symbols('w')} THEN '' ELSE w END AS marked FROM m""")
ORACLE["boilerplate_filter"] = W(LINES, f""", m AS (SELECT doc_id, line_idx, {norm('line')} AS n FROM lines)
SELECT doc_id, line_idx, {boiler('n')} AS is_boilerplate, CASE WHEN {boiler('n')} THEN '' ELSE n END AS kept_text FROM m""")
ORACLE["remove_citations"] = W(LINES, f"SELECT doc_id, line_idx, {cite(norm('line'))} AS uncited FROM lines")
ORACLE["char_ratios"] = W(LINES, f""", m AS (SELECT doc_id, line_idx, {norm('line')} AS n FROM lines)
SELECT doc_id, line_idx, CAST(length(n) AS INTEGER) AS n_chars, round({ratio(alpha_cnt('n'), 'n')}, 6) AS alpha_ratio,
       round({ratio(digit_cnt('n'), 'n')}, 6) AS digit_ratio FROM m""")
ORACLE["quality_filter"] = W(LINES, f""", m AS (SELECT doc_id, line_idx, {norm('line')} AS n FROM lines)
SELECT doc_id, line_idx, coalesce({quality_reason('n')}, 'ok') AS reason, {quality_reason('n')} IS NULL AS passes FROM m""")
ORACLE["clean_documents"] = W(CLEANED, """
SELECT shard_id, doc_id, line_idx, policy, cleaned, coalesce(reject_reason, 'kept') AS reject_reason,
       reject_reason IS NULL AS kept FROM cleaned""")
ORACLE["reject_reasons"] = W(CLEANED, """
SELECT policy, coalesce(reject_reason, 'kept') AS reason, count(*) AS n FROM cleaned GROUP BY 1, 2""")
ORACLE["dedup_shard"] = W(CLEANED, "SELECT shard_id, doc_id, line_idx, sha1 FROM dedup")
ORACLE["dedup_global"] = W(CLEANED, """
SELECT shard_id, doc_id, line_idx, sha1 FROM (
  SELECT *, row_number() OVER (PARTITION BY sha1 ORDER BY shard_id, doc_id, line_idx) AS g FROM kept) WHERE g = 1""")
ORACLE["corpus_lines"] = W(CLEANED, "SELECT count(*) AS lines, CAST(sum(length(cleaned)) AS BIGINT) AS chars FROM dedup")
ORACLE["shard_checksums"] = W(CLEANED, """
SELECT shard_id, sha256(string_agg(sha1, '' ORDER BY sha1)) AS checksum, count(*) AS rows FROM dedup GROUP BY shard_id""")

# ----------------------------------------------------------------------------- ingest / shards
ORACLE["shard_documents"] = W(SHARDS, "SELECT source, split, doc_id, shard_idx, shard_id FROM sh2")
ORACLE["parse_shard_id"] = W(SHARDS, """
SELECT shard_id, split_part(shard_id, '__', 1) AS source, split_part(shard_id, '__', 2) AS split,
       CAST(split_part(shard_id, '__', 3) AS INTEGER) AS shard_idx FROM shards""")
ORACLE["cap_shards"] = W(SHARDS, """, c AS (
  SELECT *, CASE WHEN CAST(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT) % 2 = 0 THEN NULL
                 ELSE CAST(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT) % 7 + 1 END AS max_shards FROM sh2)
SELECT source, split, doc_id, shard_idx FROM c WHERE max_shards IS NULL OR shard_idx < max_shards""")
ORACLE["discover_shards"] = W(SHARDS, "SELECT shard_id FROM shards WHERE starts_with(shard_id, 'src3__train__') ORDER BY shard_id")
ORACLE["read_one_shard"] = W(SHARDS, f""", sl AS (
  SELECT shard_id, source, split, shard_idx, doc_id, unnest(lst) AS line, CAST(unnest(range(len(lst))) AS BIGINT) AS line_idx
  FROM (SELECT *, string_split_regex(text, '\\r\\n|\\r|\\n') AS lst FROM sh2))
SELECT shard_id, doc_id, line_idx, line FROM sl
WHERE {not_blank('line')} AND source = 'src3' AND split = 'train' AND shard_idx = 2""")
ORACLE["scan_parquet_text"] = f"SELECT doc_id, {strip('text')} AS text FROM documents WHERE {not_blank('text')}"

INGEST = f"""ing AS (
  SELECT source, 'train' AS split, CAST(doc_id AS BIGINT) AS doc_id, {strip('text')} AS text FROM documents WHERE {not_blank('text')}
  UNION ALL
  SELECT 'aux', 'train', CAST(conv_id * 1048576 + turn AS BIGINT), {strip('text')} FROM conversations WHERE {not_blank('text')}
  UNION ALL
  SELECT 'aux', 'test', CAST(item_id AS BIGINT), {strip('text')} FROM benchmark WHERE {not_blank('text')})"""
ORACLE["ingest_sources"] = W(INGEST, "SELECT source, split, doc_id, text FROM ing")
ORACLE["ingest_counts"] = W(INGEST, """, s AS (
  SELECT source, split, CAST((row_number() OVER (PARTITION BY source, split ORDER BY doc_id) - 1) // 5 AS INTEGER) AS shard_idx FROM ing),
per AS (SELECT source, split, shard_idx, count(*) AS docs FROM s GROUP BY 1, 2, 3)
SELECT source, split, CAST(sum(docs) AS BIGINT) AS docs, count(*) AS shards FROM per GROUP BY ROLLUP (source, split)""")
ORACLE["split_assignment"] = W(SHARDS, f"SELECT shard_id, {sha256_mod('shard_id')} AS bucket, {split_of('shard_id')} AS split FROM shards")
ORACLE["split_counts"] = W(SHARDS, f"SELECT {split_of('shard_id')} AS split, count(*) AS shards FROM shards GROUP BY 1")

# ----------------------------------------------------------------------------- ledger / integrity
LEDGER = SHARDS + """,
lk AS (SELECT *, n * 10 + shard_idx AS k FROM shards),
led0 AS (SELECT source AS stage, shard_id, k, n,
  CASE WHEN n % 4 = 0 OR k % 10 < 6 THEN 'done' WHEN k % 10 = 6 THEN 'verified' WHEN k % 10 = 7 THEN 'processing'
       WHEN k % 10 = 8 THEN 'failed' ELSE 'pending' END AS state FROM lk),
fbody AS (SELECT shard_id, string_agg(text || chr(10), '' ORDER BY doc_id) AS body, string_agg(text || '#altered' || chr(10), '' ORDER BY doc_id) AS altered
          FROM sh2 GROUP BY shard_id),
ledk AS (SELECT stage, shard_id, state, 'out/' || shard_id || '.bin' AS output_path, sha256(body) AS checksum,
  CAST(k * 100 AS BIGINT) AS token_count, CAST(1700000000 + k * 60 AS DOUBLE) AS updated_at,
  CASE WHEN state = 'failed' THEN 'error in ' || shard_id ELSE '' END AS error, k, n FROM led0 JOIN fbody USING (shard_id)),
led AS (SELECT stage, shard_id, state, output_path, checksum, token_count, updated_at, error FROM ledk),
files AS (SELECT output_path AS path, k, sha256(CASE WHEN k % 19 = 0 THEN altered ELSE body END) AS file_checksum,
  CAST(octet_length(encode(CASE WHEN k % 19 = 0 THEN altered ELSE body END)) AS BIGINT) AS length
  FROM ledk JOIN fbody USING (shard_id) WHERE k % 17 <> 0),
listing AS (SELECT stage, 'data/raw/shards/' || stage || '/' ||
  CASE WHEN k % 7 = 0 THEN 'logs/' WHEN k % 11 = 0 THEN 'tokenizer/' WHEN k % 13 = 0 THEN 'blogs/' ELSE '' END
  || shard_id || '.txt' AS path, length FROM ledk JOIN (SELECT path AS output_path, length FROM files) f USING (output_path))"""

PROT = " OR ".join(f"contains(path, '{p}')" for p in PROTECTED)
PROT_DIR = " OR ".join(f"contains(artifact_dir, '{p.rstrip('/')}')" for p in PROTECTED)


def validate_sql(length: str, exists: str, seq_len: int = 512) -> tuple[str, str]:
    n = f"CAST(floor({length} / 2) AS BIGINT)"
    msg = (f"(CASE WHEN NOT ({exists}) THEN 'missing' WHEN {length} = 0 THEN 'empty' "
           f"WHEN {length} % 2 <> 0 THEN 'odd_size' WHEN {n} < {seq_len + 1} THEN 'too_short' ELSE '' END)")
    return msg, n


_vmsg, _vn = validate_sql("length", "length IS NOT NULL")
ORACLE["ledger_load"] = W(LEDGER, "SELECT * FROM led")
ORACLE["ledger_pending"] = W(LEDGER, "SELECT stage, shard_id, state FROM led WHERE state <> 'done'")
ORACLE["ledger_done"] = W(LEDGER, "SELECT stage, shard_id, state FROM led WHERE state = 'done'")
ORACLE["ledger_verified"] = W(LEDGER, "SELECT stage, shard_id, state FROM led WHERE state IN ('verified', 'done')")
ORACLE["reset_stale"] = W(LEDGER, """
SELECT stage, shard_id, CASE WHEN state = 'processing' AND 1700010000.0 - updated_at > 3600.0 THEN 'pending' ELSE state END AS state,
       CASE WHEN state = 'processing' AND 1700010000.0 - updated_at > 3600.0 THEN 1700010000.0 ELSE updated_at END AS updated_at FROM led""")
ORACLE["resume_pending"] = W(LEDGER, """
SELECT source AS stage, shard_id FROM shards s
WHERE NOT EXISTS (SELECT 1 FROM led WHERE led.stage = s.source AND led.shard_id = s.shard_id AND led.state = 'done')""")
ORACLE["register_shards"] = W(LEDGER, """
SELECT stage, shard_id, state, output_path, checksum, token_count, updated_at, error FROM ledk WHERE k % 3 <> 0
UNION ALL
SELECT source, shard_id, 'pending', '', '', CAST(0 AS BIGINT), 1700010000.0, '' FROM lk WHERE k % 3 = 0""")
ORACLE["ledger_apply"] = W(LEDGER, """,
upd AS (
  SELECT stage, shard_id, 'processing' AS op, 1700010000.0 + k AS ts FROM ledk WHERE state = 'pending'
  UNION ALL SELECT stage, shard_id, 'verified', 1700010000.0 + k FROM ledk WHERE state = 'failed'
  UNION ALL SELECT stage, shard_id, 'done', 1700010000.0 + k + 1 FROM ledk WHERE state = 'failed'
  UNION ALL SELECT stage, shard_id, 'failed', 1700010000.0 + k FROM ledk WHERE state = 'processing'),
per AS (SELECT stage, shard_id, arg_max(op, ts) AS n_state, max(ts) AS n_ts,
  max(CASE WHEN op = 'verified' THEN 'redo/' || shard_id || '.bin' END) AS n_path,
  max(CASE WHEN op = 'verified' THEN sha256('redo/' || shard_id) END) AS n_checksum,
  max(CASE WHEN op = 'verified' THEN CAST(7 AS BIGINT) END) AS n_tokens,
  max(CASE WHEN op = 'failed' THEN 'timeout' END) AS n_error FROM upd GROUP BY 1, 2)
SELECT l.stage, l.shard_id, coalesce(n_state, state) AS state, coalesce(n_path, output_path, '') AS output_path,
  coalesce(n_checksum, checksum, '') AS checksum, CAST(coalesce(n_tokens, token_count, 0) AS BIGINT) AS token_count,
  CAST(coalesce(n_ts, updated_at) AS DOUBLE) AS updated_at, coalesce(n_error, error, '') AS error
FROM led l LEFT JOIN per p ON l.stage = p.stage AND l.shard_id = p.shard_id""")
ORACLE["ledger_summary"] = W(LEDGER, """
SELECT stage, count(*) FILTER (WHERE state = 'pending') AS pending, count(*) FILTER (WHERE state = 'processing') AS processing,
  count(*) FILTER (WHERE state = 'verified') AS verified, count(*) FILTER (WHERE state = 'done') AS done,
  count(*) FILTER (WHERE state = 'failed') AS failed, count(*) AS total FROM led GROUP BY stage""")
ORACLE["stage_complete"] = W(LEDGER, "SELECT stage, count(*) > 0 AND bool_and(state = 'done') AS complete FROM led GROUP BY stage")
ORACLE["ledger_tokens"] = W(LEDGER, """
SELECT stage, CAST(coalesce(sum(token_count) FILTER (WHERE state = 'done'), 0) AS BIGINT) AS total_tokens FROM led GROUP BY stage""")
ORACLE["validate_packed"] = W(LEDGER, f""", lf AS (SELECT l.output_path AS path, f.length FROM led l LEFT JOIN files f ON l.output_path = f.path)
SELECT path, {_vmsg} = '' AS valid, CASE WHEN {_vmsg} = '' THEN {_vn} ELSE CAST(0 AS BIGINT) END AS num_tokens, {_vmsg} AS problem FROM lf""")

_vm2, _ = validate_sql("f.length", "f.length IS NOT NULL")
VERIFY = f""",
ver AS (
  SELECT l.stage, l.shard_id, l.output_path,
    CASE WHEN f.length IS NULL THEN 'missing'
         WHEN l.checksum <> '' AND f.file_checksum <> l.checksum THEN 'checksum_mismatch'
         WHEN ends_with(l.output_path, '.bin') AND {_vm2} <> '' THEN 'bad_bin:' || {_vm2} ELSE 'ok' END AS verdict
  FROM led l LEFT JOIN files f ON l.output_path = f.path WHERE l.state IN ('verified', 'done'))"""
ORACLE["verify_outputs"] = W(LEDGER + VERIFY, "SELECT * FROM ver")
ORACLE["deletable_files"] = W(LEDGER, f"SELECT path, length FROM listing WHERE NOT ({PROT})")
ORACLE["cleanup_bytes"] = W(LEDGER, f"""
SELECT stage, CAST(coalesce(sum(length), 0) AS BIGINT) AS deleted_bytes, count(*) AS deleted_files FROM listing WHERE NOT ({PROT}) GROUP BY stage""")
ORACLE["cleanup_report"] = W(LEDGER + VERIFY, f""",
ad AS (SELECT DISTINCT stage, CASE WHEN stage = 'src4' THEN 'data/manifests/src4/' ELSE 'data/raw/shards/' || stage || '/' END AS artifact_dir FROM led),
summ AS (SELECT stage, count(*) FILTER (WHERE state = 'done') = count(*) AS complete FROM led GROUP BY stage),
fb AS (SELECT stage, arg_min(verdict || ' ' || shard_id, shard_id) AS e2 FROM ver WHERE verdict <> 'ok' GROUP BY stage),
nv AS (SELECT stage, count(*) AS n_verified FROM led WHERE state IN ('verified', 'done') GROUP BY stage),
ps AS (SELECT stage, CAST(sum(length) AS BIGINT) AS bytes, count(*) AS files FROM listing WHERE NOT ({PROT}) GROUP BY stage),
r AS (SELECT ad.stage, ad.artifact_dir,
  CASE WHEN NOT coalesce(complete, false) THEN 'incomplete'
       WHEN coalesce(n_verified, 0) = 0 THEN 'nothing_verified'
       WHEN e2 IS NOT NULL THEN e2
       WHEN {PROT_DIR} THEN 'protected' ELSE '' END AS error, files, bytes
  FROM ad LEFT JOIN summ USING (stage) LEFT JOIN fb USING (stage) LEFT JOIN nv USING (stage) LEFT JOIN ps USING (stage))
SELECT stage, artifact_dir, error <> '' AS skipped, error,
  CAST(CASE WHEN error = '' THEN coalesce(files, 0) ELSE 0 END AS BIGINT) AS deleted_files,
  CAST(CASE WHEN error = '' THEN coalesce(bytes, 0) ELSE 0 END AS BIGINT) AS deleted_bytes, true AS dry_run FROM r""")
ORACLE["stage_plan"] = W(LEDGER, """,
pl AS (SELECT (['download', 'clean', 'train_tokenizer', 'tokenize', 'pack'])[n % 5 + 1] AS stage, state FROM ledk),
comp AS (SELECT stage, count(*) > 0 AND bool_and(state = 'done') AS complete FROM pl GROUP BY stage),
st AS (SELECT * FROM (VALUES (0, 'download'), (1, 'clean'), (2, 'train_tokenizer'), (3, 'tokenize'), (4, 'pack')) t(ord, stage))
SELECT st.stage, CAST(st.ord AS INTEGER) AS ord, coalesce(complete, false) AS complete,
       st.ord >= 1 AND NOT coalesce(complete, false) AS will_run FROM st LEFT JOIN comp USING (stage)""")

# ----------------------------------------------------------------------------- split / pack
TOK = CLEANED + f""",
tok AS (SELECT {split_of('shard_id')} AS split, shard_id, doc_id, line_idx,
  list_concat([1], list_transform(list_filter(string_split(cleaned, ' '), lambda w: w <> ''),
              lambda w: CAST(CAST(('0x' || substr(md5(w), 1, 7)) AS BIGINT) % 32000 AS INTEGER)), [2]) AS tokens FROM dedup),
tokn AS (SELECT *, len(tokens) AS n_tokens FROM tok),
offs AS (SELECT *, CAST(coalesce(sum(n_tokens) OVER (PARTITION BY split ORDER BY shard_id, doc_id, line_idx
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset" FROM tokn)"""
FLAT = TOK + """,
flat AS (SELECT split, "offset" + i - 1 AS pos, tokens[i] AS t FROM (SELECT *, unnest(generate_series(1, n_tokens)) AS i FROM offs) z),
"""
PACK = FLAT + """seqs AS (SELECT split, pos // 64 AS seq_id, list(t ORDER BY pos) AS toks FROM flat GROUP BY 1, 2),
packed AS (SELECT * FROM seqs WHERE len(toks) = 64)"""
ORACLE["shard_tokens"] = W(TOK, """
SELECT split, shard_id, CAST(sum(n_tokens) AS BIGINT) AS tokens,
       CAST(sum(sum(n_tokens)) OVER (PARTITION BY split ORDER BY shard_id) AS BIGINT) AS running_tokens FROM tokn GROUP BY 1, 2""")
ORACLE["token_offsets"] = W(TOK, """
SELECT split, shard_id, doc_id, line_idx, CAST(n_tokens AS INTEGER) AS n_tokens, "offset" FROM offs""")
ORACLE["pack_sequences"] = W(PACK, """
SELECT split, seq_id, CAST(len(toks) AS INTEGER) AS n, md5(array_to_string(toks, ',')) AS digest FROM packed""")
ORACLE["pack_stats"] = W(PACK, """
SELECT split, count(*) AS sequences, CAST(count(*) * 64 AS BIGINT) AS tokens, count(*) * 64 * 2 / 1e9 AS size_gb FROM packed GROUP BY split""")
ORACLE["next_token_pairs"] = W(FLAT + """tot AS (SELECT split, max(pos) + 1 AS total FROM flat GROUP BY split),
ex AS (SELECT f.split, s.seq_id, list(t ORDER BY pos) AS w FROM flat f JOIN tot USING (split),
       LATERAL (SELECT unnest([pos // 64, pos // 64 - 1]) AS seq_id) s
       WHERE s.seq_id >= 0 AND pos - s.seq_id * 64 <= 64 AND s.seq_id < total // 64 - 1 GROUP BY 1, 2)""", """
SELECT split, seq_id, md5(array_to_string(w[1:64], ',')) AS x_digest, md5(array_to_string(w[2:65], ',')) AS y_digest,
       w[2:64] = w[2:64] AS shifted FROM ex WHERE len(w) = 65""")
ORACLE["training_batches"] = W(PACK + """,
o AS (SELECT split, seq_id, CAST(row_number() OVER (PARTITION BY split ORDER BY
        CASE WHEN split = 'train' THEN md5('7:0:' || CAST(seq_id AS VARCHAR)) ELSE '' END, seq_id) - 1 AS BIGINT) AS ordinal FROM packed),
b AS (SELECT *, CAST(ordinal // 8 AS BIGINT) AS batch_id, count(*) OVER (PARTITION BY split) // 8 AS nfull FROM o)""", """
SELECT split, seq_id, ordinal, batch_id FROM b WHERE split <> 'train' OR batch_id < nfull""")

# ----------------------------------------------------------------------------- metrics
EVENTS = """sm AS (SELECT user_id AS run_id, (['download', 'clean', 'train_tokenizer', 'tokenize', 'pack'])[event_id % 5 + 1] AS stage,
  CASE event_type WHEN 'signup' THEN 'start' WHEN 'view' THEN 'progress' WHEN 'click' THEN 'progress'
       WHEN 'purchase' THEN 'end' WHEN 'error' THEN 'error' END AS event, ts, event_id, value FROM events),
tm0 AS (SELECT user_id AS run_id, ts, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS step FROM events),
tm AS (SELECT run_id, step, ts, event_id, CASE WHEN step % 5 = 0 THEN 'eval' ELSE 'train' END AS type,
  CASE WHEN step % 5 <> 0 THEN value END AS loss, CASE WHEN step % 5 = 0 THEN value END AS val_loss FROM tm0)"""
ORACLE["metric_sampling"] = W(EVENTS, """
SELECT run_id, CAST(step AS INTEGER) AS step, step % 10 = 0 AS logged, step % 25 = 0 AND step <> 0 AS evaluated FROM tm
WHERE step % 10 = 0 OR (step % 25 = 0 AND step <> 0)""")
ORACLE["metric_serialise"] = W(EVENTS, """SELECT run_id, event_id, '{"value":"' || CAST(value AS VARCHAR) || '"}' AS metrics_json FROM sm""")
ORACLE["throughput"] = W(EVENTS, """, d AS (SELECT run_id, step,
  (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY run_id ORDER BY ts, step)) / 1e6 AS dt,
  count(*) OVER (PARTITION BY run_id ORDER BY ts, step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c FROM tm WHERE type = 'train')
SELECT run_id, CAST(step AS INTEGER) AS step, CASE WHEN dt IS NOT NULL THEN CAST(floor(16384.0 / greatest(dt, 1e-9)) AS BIGINT) END AS tokens_per_sec,
       CAST(c * 16384 AS BIGINT) AS tokens_seen FROM d""")
BEST = EVENTS + """, best AS (SELECT run_id, step, val_loss,
  min(val_loss) OVER (PARTITION BY run_id ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM tm WHERE type = 'eval')"""
ORACLE["best_checkpoints"] = W(BEST, """
SELECT run_id, CAST(step AS INTEGER) AS step, val_loss, prev IS NULL OR val_loss < prev AS is_best FROM best""")
ORACLE["latest_checkpoint"] = W(BEST, """
SELECT run_id, arg_max(printf('checkpoints/best/best_%d.pt', step), step) AS path, CAST(max(step) AS INTEGER) AS step
FROM best WHERE prev IS NULL OR val_loss < prev GROUP BY run_id""")
ORACLE["stage_elapsed"] = W(EVENTS, """, e AS (SELECT run_id, stage, event, event_id,
  epoch_us(ts) - last(CASE WHEN event = 'start' THEN epoch_us(ts) END IGNORE NULLS) OVER (PARTITION BY run_id, stage ORDER BY ts, event_id
     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS elapsed_us FROM sm)
SELECT run_id, stage, event_id, elapsed_us, elapsed_us / 1e6 AS elapsed_s FROM e WHERE event = 'end'""")
ORACLE["stage_outcomes"] = W(EVENTS, """
SELECT run_id, stage, count(*) FILTER (WHERE event = 'start') AS starts, count(*) FILTER (WHERE event = 'end') AS ends,
  count(*) FILTER (WHERE event = 'progress') AS progress, count(*) FILTER (WHERE event = 'error') AS errors,
  arg_max(CAST(value AS VARCHAR), event_id) FILTER (WHERE event = 'error') AS last_error,
  (max(epoch_us(ts)) FILTER (WHERE event = 'end') - min(epoch_us(ts)) FILTER (WHERE event = 'start')) / 1e6 AS span_s
FROM sm GROUP BY run_id, stage""")
UNI = TOK + """,
trc AS (SELECT t AS id, count(*) AS c FROM (SELECT unnest(tokens) AS t FROM tokn WHERE split = 'train') GROUP BY 1),
trn AS (SELECT sum(c) AS n FROM trc),
model AS (SELECT id, -ln((c + 1) / (n + 32000.0)) AS nll FROM trc, trn),
unseen AS (SELECT -ln(1.0 / (n + 32000.0)) AS u FROM trn)"""
ORACLE["unigram_perplexity"] = W(UNI + """,
vc AS (SELECT t AS id, count(*) AS c FROM (SELECT unnest(tokens) AS t FROM tokn WHERE split = 'validation') GROUP BY 1),
s AS (SELECT sum(c) AS tokens, sum(c * coalesce(nll, u)) AS nll_sum FROM vc LEFT JOIN model USING (id), unseen)""", """
SELECT CAST(tokens AS BIGINT) AS tokens, round(nll_sum, 4) AS nll_sum, round(exp(nll_sum / tokens), 4) AS perplexity FROM s""")
ORACLE["batch_mean_loss"] = W(UNI + """,
flat AS (SELECT split, "offset" + i - 1 AS pos, tokens[i] AS t FROM (SELECT *, unnest(generate_series(1, n_tokens)) AS i FROM offs) z),
tot AS (SELECT split, max(pos) + 1 AS total FROM flat GROUP BY split),
ex AS (SELECT f.split, s.seq_id, list(t ORDER BY pos) AS w FROM flat f JOIN tot USING (split),
       LATERAL (SELECT unnest([pos // 64, pos // 64 - 1]) AS seq_id) s
       WHERE s.seq_id >= 0 AND pos - s.seq_id * 64 <= 64 AND s.seq_id < total // 64 - 1 GROUP BY 1, 2),
y AS (SELECT seq_id // 8 AS batch, unnest(w[2:65]) AS id FROM ex WHERE len(w) = 65 AND split = 'validation'),
b AS (SELECT batch, avg(coalesce(nll, u)) AS loss FROM y LEFT JOIN model USING (id), unseen GROUP BY batch)""", """
SELECT count(*) AS batches, round(avg(loss), 6) AS mean_loss FROM b""")
ORACLE["topk_softmax"] = """WITH sc AS (SELECT vec_id, CAST(unnest(range(len(embedding))) AS BIGINT) AS pos, CAST(unnest(embedding) AS DOUBLE) AS score FROM embeddings),
r AS (SELECT *, rank() OVER (PARTITION BY vec_id ORDER BY score DESC) AS rank FROM sc),
k AS (SELECT *, exp((score - max(score) OVER (PARTITION BY vec_id)) / 0.7) AS z FROM r WHERE rank <= 5)
SELECT vec_id, pos, CAST(rank AS INTEGER) AS rank, round(z / sum(z) OVER (PARTITION BY vec_id), 6) AS prob FROM k"""
ORACLE["stage_event_windows"] = W(EVENTS, """
SELECT strftime(time_bucket(INTERVAL 1 day, ts), '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(time_bucket(INTERVAL 1 day, ts) + INTERVAL 1 day, '%Y-%m-%d %H:%M:%S') AS window_end, stage, event, count(*) AS n
FROM sm GROUP BY 1, 2, 3, 4""")

# ----------------------------------------------------------------------------- tokenizer
# The published byte-level pattern with White_Space for \\s, without its look-ahead
# branch (cleaned text has single spaces only, where that makes no difference).
SPACE = r"\x{9}-\x{D}\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
PRE = ("'s|'t|'re|'ve|'m|'ll|'d" + rf"| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+").replace("'", "''")
CORPUS = CLEANED + f""",
corpus AS (SELECT shard_id, doc_id, line_idx, cleaned AS text FROM dedup),
ptf AS (SELECT unnest(regexp_extract_all(CASE WHEN starts_with(text, ' ') THEN text ELSE ' ' || text END || chr(10), '{PRE}')) AS pretoken FROM corpus),
freq AS (SELECT pretoken, count(*) AS freq FROM ptf GROUP BY pretoken),
fb AS (SELECT pretoken, freq, hex(encode(pretoken)) AS h FROM freq),
bytes AS (SELECT DISTINCT CAST(('0x' || substr(h, 2 * i + 1, 2)) AS INTEGER) AS byte
          FROM (SELECT h, unnest(range(CAST(length(h) / 2 AS BIGINT))) AS i FROM fb)),
alpha AS (SELECT byte, char_code, CAST(row_number() OVER (ORDER BY char_code) - 1 + 4 AS INTEGER) AS id FROM (
  SELECT byte, CASE WHEN (byte BETWEEN 33 AND 126) OR (byte BETWEEN 161 AND 172) OR (byte BETWEEN 174 AND 255) THEN byte
                    WHEN byte <= 32 THEN 256 + byte WHEN byte <= 160 THEN 289 + (byte - 127) ELSE 323 END AS char_code FROM bytes)),
pairs AS (SELECT a.id AS left_id, b.id AS right_id, CAST(sum(freq) AS BIGINT) AS count FROM (
    SELECT freq, CAST(('0x' || substr(h, 2 * i + 1, 2)) AS INTEGER) AS x, CAST(('0x' || substr(h, 2 * i + 3, 2)) AS INTEGER) AS y
    FROM (SELECT h, freq, unnest(range(CAST(length(h) / 2 AS BIGINT) - 1)) AS i FROM fb)) p
  JOIN alpha a ON a.byte = p.x JOIN alpha b ON b.byte = p.y GROUP BY 1, 2 HAVING sum(freq) >= 2)"""
ORACLE["pretokenize"] = W(CORPUS, f""", pl AS (SELECT shard_id, doc_id, line_idx,
  regexp_extract_all(CASE WHEN starts_with(text, ' ') THEN text ELSE ' ' || text END, '{PRE}') AS p FROM corpus)
SELECT shard_id, doc_id, line_idx, CAST(len(p) AS INTEGER) AS n_pretokens, md5(array_to_string(p, chr(1))) AS digest FROM pl""")
ORACLE["pretoken_freq"] = W(CORPUS, "SELECT pretoken, freq FROM freq")
ORACLE["bpe_alphabet"] = W(CORPUS, "SELECT byte, char_code, id FROM alpha")
ORACLE["bpe_pair_counts"] = W(CORPUS, "SELECT left_id, right_id, count FROM pairs")
ORACLE["bpe_top_pairs"] = W(CORPUS, "SELECT left_id, right_id, count FROM pairs ORDER BY count DESC, left_id, right_id LIMIT 20")
ORACLE["eval_sample"] = W(CORPUS, "SELECT shard_id, doc_id, line_idx FROM corpus ORDER BY shard_id, doc_id, line_idx LIMIT 50000")

# ----------------------------------------------------------------------------- files and streams
# Broken bytes come back as one U+FFFD for each longest start of a character.
ORACLE["text_shards"] = W(SHARDS, f""", dl AS (SELECT shard_id, doc_id, string_split_regex(text || CASE WHEN doc_id % 7 = 0 THEN
  chr(10) || 'bad' || chr(10) || chr(65533) || chr(65533) || ' ' || chr(65533) || chr(65533) || ' ' || chr(65533) || chr(10) ELSE '' END, '\\r\\n|\\r|\\n') AS lst FROM sh2),
dl2 AS (SELECT *, coalesce(sum(len(lst)) OVER (PARTITION BY shard_id ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM dl),
x AS (SELECT shard_id, before, unnest(range(len(lst))) AS i, unnest(lst) AS line FROM dl2)
SELECT shard_id, CAST(before + i AS BIGINT) AS line_no, line FROM x WHERE {not_blank('line')}""")
ORACLE["packed_binary"] = W(PACK, "SELECT split, seq_id, md5(array_to_string(toks, ',')) AS digest FROM packed")
ORACLE["packed_headerless"] = ORACLE["packed_binary"]
ORACLE["incremental_clean"] = W(CLEANED, """, ph AS (
  SELECT shard_id, CASE WHEN reject_reason IS NULL THEN sha1(cleaned) END AS sha1, count(*) AS n FROM cleaned GROUP BY 1, 2)
SELECT shard_id, CAST(sum(n) AS BIGINT) AS docs_in, count(sha1) AS docs_out FROM ph GROUP BY shard_id""")
ORACLE["incremental_failures"] = W(CLEANED, """, ph AS (
  SELECT shard_id, CASE WHEN reject_reason IS NULL THEN sha1(cleaned) END AS sha1, count(*) AS n FROM cleaned GROUP BY 1, 2),
y AS (SELECT shard_id, CAST(sum(n) AS BIGINT) AS docs_in, count(sha1) AS docs_out FROM ph GROUP BY shard_id),
bad AS (SELECT DISTINCT shard_id FROM cleaned WHERE length(line) > 1500)
SELECT 1 AS run, y.shard_id, CASE WHEN bad.shard_id IS NULL THEN 'done' ELSE 'failed' END AS state, CASE WHEN bad.shard_id IS NULL THEN docs_in ELSE 0 END AS docs_in,
       CASE WHEN bad.shard_id IS NULL THEN docs_out ELSE 0 END AS docs_out, CASE WHEN bad.shard_id IS NULL THEN '' ELSE 'line over 1500' END AS error
FROM y LEFT JOIN bad ON bad.shard_id = y.shard_id
UNION ALL SELECT 2, y.shard_id, 'done', docs_in, docs_out, '' FROM y JOIN bad ON bad.shard_id = y.shard_id""")
ORACLE["stream_dedup"] = W(CLEANED, """
SELECT shard_id, count(DISTINCT sha1(cleaned)) AS docs_out FROM cleaned WHERE reject_reason IS NULL GROUP BY shard_id""")
ORACLE["stage_event_stream"] = ORACLE["stage_event_windows"]
FILEB = SHARDS + """, fb AS (SELECT shard_id, source, split, CAST(sum(octet_length(encode(text)) + 1) AS BIGINT) AS length,
  sha256(string_agg(text || chr(10), '' ORDER BY doc_id)) AS file_checksum FROM sh2 GROUP BY shard_id, source, split)"""
ORACLE["storage_summary"] = W(FILEB, """
SELECT 'all' AS label, CAST(sum(length) AS BIGINT) AS bytes, count(*) AS files FROM fb
UNION ALL SELECT 'src1', CAST(sum(length) AS BIGINT), count(*) FROM fb WHERE source = 'src1'
UNION ALL SELECT 'train', CAST(sum(length) AS BIGINT), count(*) FROM fb WHERE split = 'train'""")
ORACLE["file_checksums"] = W(FILEB, "SELECT shard_id, length, file_checksum FROM fb")
ORACLE["stage_gate"] = W(LEDGER, """,
pl AS (SELECT (['download', 'clean', 'train_tokenizer', 'tokenize', 'pack'])[n % 5 + 1] AS stage, state FROM ledk),
s AS (SELECT stage AS upstream, count(*) FILTER (WHERE state = 'done') AS d, count(*) AS n FROM pl GROUP BY stage),
g AS (SELECT * FROM (VALUES ('clean', 'download'), ('train_tokenizer', 'clean'), ('tokenize', 'train_tokenizer'), ('pack', 'tokenize')) t(stage, upstream))
SELECT g.stage, g.upstream, coalesce(n > 0 AND d = n, false) AS may_run, coalesce(d, 0) AS up_done, coalesce(n, 0) AS up_total
FROM g LEFT JOIN s USING (upstream)""")
ORACLE["cleanup_audit"] = ORACLE["cleanup_report"].replace(
    "true AS dry_run FROM r", "true AS dry_run, run FROM r, (VALUES (1), (2)) t(run)")
ORACLE["metric_events"] = W(EVENTS, "SELECT stage, event, count(*) AS n, round(sum(value), 4) AS value_sum FROM sm GROUP BY 1, 2")
ORACLE["pack_skip"] = W(PACK, """SELECT DISTINCT split FROM packed
WHERE split <> 'train' OR (SELECT count(*) FROM packed WHERE split = 'train') * 64 < 65""")

# ----------------------------------------------------------------------------- tokenizer round trip
ORACLE["decode_roundtrip"] = W(CORPUS, "SELECT count(*) AS lines, count(*) AS roundtrip_ok FROM corpus")

# The short merge list, as replacements in rank order: a symbol is one letter of a private code range
# (U+E000 + id), so that replacing two neighbours is a merge of non-overlapping pairs from the left.
_SHORT = [("t", "h"), ("i", "n"), ("e", "r"), ("th", "e"), ("o", "n"), ("in", "g"), ("a", "n"), ("er", "e"), ("an", "d")]


def short_symbols(x: str) -> str:
    """Ids of a text under the short merge list, as a list of integers."""
    ids = {chr(c): c + 4 for c in range(128)}
    hexed = f"hex(encode({x}))"
    out = f"array_to_string(list_transform(range(CAST(strlen({hexed}) // 2 AS BIGINT)), lambda i: chr(CAST(57344 + 4 + CAST(('0x' || substr({hexed}, CAST(2 * i + 1 AS BIGINT), 2)) AS INTEGER) AS INTEGER))), '')"
    for n, (a, b) in enumerate(_SHORT):
        ids[a + b] = 260 + n
        out = f"replace({out}, chr({57344 + ids[a]}) || chr({57344 + ids[b]}), chr({57344 + ids[a + b]}))"
    return out


def symbol_list(x: str) -> str:
    return f"list_transform(string_split({x}, ''), lambda c: unicode(c) - 57344)"


ORACLE["bpe_encode_pretokens"] = W(CORPUS, f""", sy AS (SELECT pretoken, {short_symbols('pretoken')} AS s FROM freq),
li AS (SELECT pretoken, {symbol_list('s')} AS ids FROM sy)
SELECT pretoken, CAST(len(ids) AS INTEGER) AS n, md5(array_to_string(ids, ',')) AS digest FROM li""")
# Merges do not cross pre-tokens, so a line's pre-tokens are encoded one by one.
SHORT = CORPUS + f""", lp AS (SELECT shard_id, doc_id, line_idx, text, unnest(p) AS pretoken, unnest(range(len(p))) AS pos FROM (SELECT shard_id, doc_id, line_idx, text,
  regexp_extract_all(CASE WHEN starts_with(text, ' ') THEN text ELSE ' ' || text END, '{PRE}') AS p FROM corpus)),
words AS (SELECT pretoken, {symbol_list('s')} AS ids FROM (SELECT pretoken, {short_symbols('pretoken')} AS s FROM (SELECT DISTINCT pretoken FROM lp))),
lt AS (SELECT shard_id, doc_id, line_idx, text, list_concat([1], list_concat(flatten(list(ids ORDER BY pos)), [2])) AS ids
       FROM lp JOIN words USING (pretoken) GROUP BY shard_id, doc_id, line_idx, text)"""
ORACLE["tokenize_short_merges"] = W(SHORT, """
SELECT shard_id, doc_id, line_idx, CAST(len(ids) AS INTEGER) AS n_tokens, md5(array_to_string(ids, ',')) AS digest FROM lt""")
ORACLE["tokenizer_stats_short_merges"] = W(SHORT, """
SELECT count(*) AS documents, round(avg(len(ids)), 6) AS avg_tokens, CAST(min(len(ids)) AS INTEGER) AS min_tokens, CAST(max(len(ids)) AS INTEGER) AS max_tokens,
  CAST(sum(len(ids)) AS BIGINT) AS total_tokens, CAST(0 AS BIGINT) AS unk_count, CAST(sum(length(text)) AS BIGINT) AS total_chars,
  round(sum(length(text)) / sum(len(ids)), 6) AS chars_per_token FROM lt""")
# A word is a string with one private-use letter (U+E000 + id) per symbol, so that a merge is a replace. One level of the
# recursion is one merge; every level keeps its words, the last columns say which pair was merged to get them.
ORACLE["tokenizer_artifacts"] = W(CORPUS, """, spelling AS (
  SELECT pretoken, freq, i, CAST(('0x' || substr(hex(encode(pretoken)), CAST(2 * i + 1 AS BIGINT), 2)) AS INTEGER) AS byte
  FROM (SELECT pretoken, freq, unnest(range(0, octet_length(encode(pretoken)))) AS i FROM freq)),
spelt AS (SELECT string_agg(chr(57344 + CAST(id AS INTEGER)), '' ORDER BY i) AS w, any_value(freq) AS freq FROM spelling JOIN alpha USING (byte) GROUP BY pretoken),
learn AS (
  SELECT 0 AS step, w, freq, '' AS l, '' AS r FROM spelt WHERE length(w) > 1
  UNION ALL
  SELECT learn.step + 1, replace(learn.w, best.l || best.r, chr(57344 + CAST((SELECT count(*) FROM alpha) + 4 + learn.step AS INTEGER))), learn.freq, best.l, best.r
  FROM learn, (SELECT substr(w, i, 1) AS l, substr(w, i + 1, 1) AS r, sum(freq) AS c
               FROM (SELECT w, freq, unnest(range(1, length(w))) AS i FROM learn)
               GROUP BY 1, 2 HAVING sum(freq) >= 2 ORDER BY c DESC, l, r LIMIT 1) best
  WHERE learn.step < 200 - 4 - (SELECT count(*) FROM alpha)),
merge AS (SELECT DISTINCT step - 1 AS rank, unicode(l) - 57344 AS l, unicode(r) - 57344 AS r, (SELECT count(*) FROM alpha) + 3 + step AS id FROM learn WHERE step > 0),
first AS (SELECT CAST(id AS BIGINT) AS id, printf('%02X', byte) AS hex FROM alpha),
built AS (
  SELECT -1 AS rank, map_from_entries(list((id, hex))) AS m FROM first
  UNION ALL
  SELECT merge.rank, map_concat(m, map_from_entries([(CAST(merge.id AS BIGINT), m[merge.l] || m[merge.r])])) FROM built JOIN merge ON merge.rank = built.rank + 1),
vocab AS (SELECT unnest(map_entries(m)) AS e FROM (SELECT m FROM built ORDER BY rank DESC LIMIT 1))
SELECT 'vocab' AS part, e.key AS n, e.value || ',false' AS value FROM vocab
UNION ALL SELECT 'vocab', * FROM (VALUES (0, '3C7061643E,true'), (1, '3C626F733E,true'), (2, '3C656F733E,true'), (3, '3C756E6B3E,true')) t
UNION ALL SELECT 'merge', rank, l || ',' || r || ',' || id FROM merge
UNION ALL SELECT 'config', 0, '{"vocab_size": ' || (SELECT count(*) + 4 FROM vocab)
  || ', "model": "BPE", "pre_tokenizer": "ByteLevel", "normalizer": "NFKC", "min_frequency": 2, "special_tokens": ["<pad>", "<bos>", "<eos>", "<unk>"]}'""").replace("WITH ", "WITH RECURSIVE ", 1)
ORACLE["nfkc_lines"] = W(CORPUS, "SELECT shard_id, doc_id, line_idx, md5(text) AS digest FROM corpus")

# ----------------------------------------------------------------------------- formats, ledger documents, event sinks
ORACLE["ingest_formats"] = f"""SELECT t.source, doc_id, md5({strip('text')}) AS digest
FROM documents, (VALUES ('j'), ('p'), ('c')) t(source) WHERE {not_blank('text')}"""
ORACLE["ledger_documents"] = W(LEDGER, """SELECT stage, shard_id, state, token_count FROM led
UNION ALL SELECT '(set aside)', '', '', CAST(0 AS BIGINT)""")
ORACLE["ledger_meta"] = W(LEDGER, """, st AS (SELECT DISTINCT stage, n FROM ledk)
SELECT stage, CASE WHEN n % 3 <> 0 THEN CASE WHEN stage = 'src4' THEN 'data/manifests/src4/' ELSE 'data/raw/shards/' || stage || '/' END END AS dir,
  CASE WHEN n % 3 <> 1 THEN '2' ELSE '1' END AS run, CASE WHEN n % 3 <> 1 THEN stage END AS by FROM st""")
ORACLE["train_events"] = W(BEST, """, ev AS (SELECT run_id, type, coalesce(loss, val_loss) AS value FROM tm
  UNION ALL SELECT run_id, 'checkpoint', val_loss FROM best WHERE prev IS NULL OR val_loss < prev)
SELECT run_id, type, count(*) AS n, round(sum(value), 4) AS value_sum FROM ev GROUP BY 1, 2""")
