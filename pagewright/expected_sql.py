"""For each query, SQL that states the same result independently (DuckDB dialect)."""

from __future__ import annotations

# Fixed values, stated here a second time on purpose, in their usual order: an error in the
# library's own lists shows as a difference.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
STOP_WORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself
yourselves he him his himself she she's her hers herself it it's its itself they them
their theirs themselves what which who whom this that that'll these those am is are was
were be been being have has had having do does did doing a an the and but if or because
as until while of at by for with about against between into through during before after
above below to from up down in out on off over under again further then once here there
when where why how all any both each few more most other some such no nor not only own
same so than too very s t can will just don don't should should've now d ll m o re ve y
ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven
haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn
shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split()

PAGE_DATE = "strftime(DATE '2020-01-01' + (page_id % 365)::INT, '%Y-%m-%d')"

URL = r"'^(?:([a-zA-Z][a-zA-Z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?'"
STOP_LIST = ", ".join("'" + w.replace("'", "''") + "'" for w in STOP_WORDS)


def _strip(text: str) -> str:
    return f"trim({text}, '{WHITESPACE}')"


def _spaces(text: str) -> str:
    return _strip(rf"regexp_replace({text}, '[ \t\n\r\f]+', ' ', 'g')")


# Cut the page at block openings, marked by chr(1) and a letter; the first piece is no block.
MARKED = "html"
for _tag, _letter in [
    ("<h1>", "T"), ("<p>", "X"), ("<li>", "L"), ('<div class="ad">', "X"), ("<footer>", "X")
]:
    MARKED = f"replace({MARKED}, '{_tag}', chr(1) || '{_letter}')"

BLOCKS = f"""
blocks AS (
  SELECT page_id, i - 2 AS pos, raw[1] AS t,
         {_strip("regexp_replace(raw[2:], '<[^>]*>', ' ', 'g')")} AS txt
  FROM (SELECT page_id, generate_subscripts(l, 1) AS i, unnest(l) AS raw
        FROM (SELECT page_id, string_split({MARKED}, chr(1)) AS l FROM pages))
  WHERE i > 1)"""

SECTIONS = f"""{BLOCKS},
running AS (
  SELECT *, sum((t = 'T')::INT) OVER (PARTITION BY page_id ORDER BY pos) AS g
  FROM blocks WHERE t IN ('T', 'X') AND txt <> ''),
sectioned AS (
  SELECT page_id, pos, t, txt, g,
         dense_rank() OVER (PARTITION BY page_id ORDER BY g) - 1 AS section_index,
         max(CASE WHEN t = 'T' THEN txt END) OVER (PARTITION BY page_id, g) AS title,
         CASE WHEN g = 0 THEN true END AS continuation
  FROM running),
expanded AS (
  SELECT page_id, section_index, title, continuation,
         row_number() OVER (PARTITION BY page_id, section_index ORDER BY pos) - 1 AS text_index,
         txt AS text
  FROM sectioned WHERE t = 'X')"""

SECTIONS_BY_HEIGHT = f"""{BLOCKS},
heights AS (SELECT *, (pos * 5 + length(txt)) % 7 AS y FROM blocks),
running AS (
  SELECT *, sum((t = 'T')::INT) OVER (PARTITION BY page_id ORDER BY y, pos) AS g
  FROM heights WHERE t IN ('T', 'X') AND txt <> ''),
sectioned AS (
  SELECT *, dense_rank() OVER (PARTITION BY page_id ORDER BY g) - 1 AS section_index,
         max(CASE WHEN t = 'T' THEN txt END) OVER (PARTITION BY page_id, g) AS title,
         CASE WHEN g = 0 THEN true END AS continuation
  FROM running)"""

EXPANDED = f"""WITH {SECTIONS}
SELECT page_id, section_index, title, continuation, text_index, text FROM expanded"""

SECTION_COUNTS = f"""WITH {SECTIONS}
SELECT page_id, section_index, title, count(text) AS n_texts
FROM expanded WHERE title IS NOT NULL GROUP BY ALL"""

DOCUMENT_PAGES = """
document_pages AS (
  SELECT doc_id, i AS page, substr(text, i * 1000 + 1, 1000) AS page_text
  FROM (SELECT doc_id, text,
               unnest(range(0, greatest(ceil(length(text) / 1000.0), 1)::BIGINT)) AS i
        FROM documents WHERE text IS NOT NULL))"""

WORDS = r"words AS (SELECT doc_id, unnest(string_split_regex(text, '[^a-zA-Z\d:]')) AS word FROM documents)"

WORD_COUNTS = f"""
SELECT 'documents' AS who, word, count(word) AS word_count
FROM words
WHERE regexp_matches(word, '[a-zA-Z]+') AND lower(word) NOT IN ({STOP_LIST})
GROUP BY word"""

# Chunk of each line by carrying the running size from line to line.
CHUNKS = """
lines AS (
  SELECT doc_id, line, length(line) AS n,
         row_number() OVER (PARTITION BY doc_id ORDER BY i) AS rn
  FROM (SELECT doc_id, generate_subscripts(l, 1) AS i, unnest(l) AS line
        FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))
  WHERE line <> ''),
carried AS (
  SELECT doc_id, rn, line, n, n AS total, 0 AS chunk_index FROM lines WHERE rn = 1
  UNION ALL
  SELECT l.doc_id, l.rn, l.line, l.n,
         CASE WHEN c.total + l.n >= 400 THEN l.n ELSE c.total + l.n END,
         CASE WHEN c.total + l.n >= 400 THEN c.chunk_index + 1 ELSE c.chunk_index END
  FROM carried c JOIN lines l ON l.doc_id = c.doc_id AND l.rn = c.rn + 1),
chunks AS (
  SELECT doc_id, chunk_index::BIGINT AS chunk_index,
         string_agg(line, chr(10) ORDER BY rn) AS chunk,
         sum(n)::BIGINT AS n_chars, count(*) AS n_lines
  FROM carried GROUP BY ALL)"""

QUERY_PAIRS = rf"""
pieces AS (
  SELECT page_id, generate_subscripts(p, 1) AS i, unnest(p) AS piece
  FROM (SELECT page_id, string_split(regexp_extract(url, {URL}, 4), '&') AS p FROM pages)),
pairs AS (
  SELECT page_id, i,
         url_decode(replace(split_part(piece, '=', 1), '+', ' ')) AS key,
         url_decode(replace(substr(piece, instr(piece, '=') + 1), '+', ' ')) AS value
  FROM pieces WHERE instr(piece, '=') > 0 AND length(piece) > instr(piece, '='))"""

URL_COLUMNS = rf"""lower(regexp_extract(url, {URL}, 1)) AS scheme,
  regexp_extract(url, {URL}, 2) AS site,
  regexp_replace(regexp_extract(url, {URL}, 3), ';[^/]*$', '') AS path"""


def _packed(rows: str, key: str, budget: int) -> str:
    """Chunk of each row of ``rows`` (key, rn from 1, n, and more), by carrying the running size along."""
    return f"""
carried AS (
  SELECT *, n AS total, 0 AS chunk_index FROM {rows} WHERE rn = 1
  UNION ALL
  SELECT r.*, CASE WHEN c.total + r.n >= {budget} THEN r.n ELSE c.total + r.n END,
         CASE WHEN c.total + r.n >= {budget} THEN c.chunk_index + 1 ELSE c.chunk_index END
  FROM carried c JOIN {rows} r ON r.{key} = c.{key} AND r.rn = c.rn + 1)"""


SEGMENTS = """
timed AS (
  SELECT user_id, event_id, epoch_us(ts) AS t,
         epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS gap FROM events),
numbered AS (
  SELECT user_id, t, sum((gap IS NULL OR gap > 21600000000)::INT)
    OVER (PARTITION BY user_id ORDER BY t, event_id) - 1 AS segment_id FROM timed)"""

TURNS = """
placed AS (
  SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY place) AS rn
  FROM (SELECT {key}, {place} AS place, text, length(text) AS n FROM conversations))"""


def _vectors(source: str, keys: str) -> str:
    """Word counts in 64 md5 buckets, scaled to length 1, as (keys, dim, value)."""
    return f"""
bucketed AS (
  SELECT {keys}, (('0x' || md5(token)[1:8])::BIGINT % 64) AS dim, count(*) AS n
  FROM (SELECT {keys}, unnest(regexp_extract_all(lower(text), '[0-9a-z_]+')) AS token FROM {source})
  GROUP BY ALL),
scaled AS (
  SELECT {keys}, dim, n / sqrt(sum(n * n) OVER (PARTITION BY {keys})) AS value FROM bucketed)"""


def expected_sql() -> dict[str, str]:
    return {
        "manifest": f"""SELECT regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, url,
            {PAGE_DATE} AS date,
            nullif(regexp_extract(url, '.*/([^/?]+)', 1), '') AS file_name FROM pages""",
        "whole_text_scan": """SELECT lang, sum(length(text) + 1)::BIGINT AS n_chars
            FROM documents GROUP BY lang""",
        "binary_scan": """WITH lines AS (
              SELECT lang, unnest(string_split(text, chr(10))) AS line FROM documents)
            SELECT l.lang, any_value(b.n_bytes) AS n_bytes, count(*) AS n_lines,
                   sum(('0x' || md5(line)[1:8])::BIGINT)::BIGINT AS line_sum
            FROM lines l JOIN (SELECT lang, sum(strlen(text) + 1)::BIGINT AS n_bytes
                               FROM documents GROUP BY lang) b ON b.lang = l.lang
            GROUP BY l.lang""",
        "speech_reference": f"WITH {WORDS} {WORD_COUNTS}".replace("'documents'", "'speaker'"),
        "sink_overwrite": "SELECT doc_id, text, lang, source, n_chars FROM documents",
        "partitioned_write": rf"""SELECT md5(regexp_extract(url, {URL}, 2))[1:2] AS partition,
            page_id, url, length(html) AS n_chars FROM pages""",
        "ctas_copy": "SELECT conv_id, turn, role, text FROM conversations",
        "describe_table": """SELECT * FROM (VALUES ('page_id', 'bigint'),
            ('section_index', 'int'), ('title', 'string'), ('continuation', 'boolean'),
            ('text_index', 'int'), ('text', 'string')) AS v(col_name, data_type)""",
        "table_detail": """SELECT event_type, count(*) AS num_rows, true AS files_as_listed, true AS bytes_as_listed
            FROM events GROUP BY event_type""",
        "pruned_read": rf"""WITH sited AS (SELECT *, regexp_extract(url, {URL}, 2) AS site,
              regexp_extract(url, {URL}, 4) AS query FROM pages)
            SELECT md5(site)[1:2] AS partition, site, page_id, url, length(html) AS n_chars FROM sited
            WHERE site IN (SELECT site FROM sited WHERE contains(query, 'page=2'))""",
        "repartition_rows": """SELECT count(*) AS n_rows, sum(n_chars)::BIGINT AS n_chars, 16::BIGINT AS n_tasks FROM documents""",
        "local_rows": """SELECT lang, language, count(*) AS n_documents
            FROM documents LEFT JOIN (VALUES ('de', 'German'), ('en', 'English'), ('es', 'Spanish'), ('fr', 'French'))
              AS names(lang, language) USING (lang) GROUP BY ALL""",
        "url_parts": rf"""SELECT page_id, url, {URL_COLUMNS},
            regexp_extract(url, {URL}, 4) AS query_string FROM pages""",
        "url_query_map": f"""WITH {QUERY_PAIRS}
            SELECT page_id, key, row_number() OVER (PARTITION BY page_id, key ORDER BY i) - 1
              AS position, value FROM pairs""",
        "url_file_name": """SELECT page_id,
            nullif(regexp_extract(url, '.*/([^/?]+)', 1), '') AS file_name,
            nullif(regexp_extract(url, '.*/([^/]+)', 1), '') AS file_name_with_query,
            nullif(regexp_extract(url, '.*/([^/?]+)', 1), '') AS derived_name FROM pages""",
        "partition_key": rf"""SELECT page_id, url, md5(regexp_extract(url, {URL}, 2))[1:2]
            AS partition FROM pages""",
        "resolve_content": """SELECT d.doc_id, 'item/' || d.doc_id AS url,
              c.conv_id IS NOT NULL AS found, c.n_bytes
            FROM documents d LEFT JOIN (
              SELECT conv_id, strlen(arg_max(text, turn))::BIGINT AS n_bytes
              FROM conversations GROUP BY conv_id) c ON c.conv_id = d.doc_id""",
        "layout_blocks": f"""WITH {BLOCKS} SELECT page_id, pos AS block_index,
            CASE t WHEN 'T' THEN 'Title' WHEN 'L' THEN 'List' ELSE 'Text' END AS kind, txt AS text
            FROM blocks""",
        "page_titles": f"""WITH {BLOCKS} SELECT page_id,
            row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1 AS title_index_in_page,
            txt AS title FROM blocks WHERE t = 'T' AND txt <> ''""",
        "assemble_sections": f"""WITH {SECTIONS} SELECT page_id, section_index, title, continuation,
            count(*) FILTER (t = 'X') AS n_texts,
            coalesce(string_agg(txt, chr(10) ORDER BY pos) FILTER (t = 'X'), '') AS joined
            FROM sectioned GROUP BY page_id, section_index, title, continuation""",
        "sections_by_height": f"""WITH {SECTIONS_BY_HEIGHT} SELECT page_id, section_index, title, continuation,
            count(*) FILTER (t = 'X') AS n_texts,
            coalesce(string_agg(txt, chr(10) ORDER BY y, pos) FILTER (t = 'X'), '') AS joined
            FROM sectioned GROUP BY page_id, section_index, title, continuation""",
        "expand_sections": EXPANDED,
        "ordered_content": EXPANDED + " ORDER BY page_id, section_index, text_index",
        "sections_json_roundtrip": EXPANDED,
        "section_text_counts": SECTION_COUNTS + " ORDER BY page_id, section_index",
        "flow_sections": SECTION_COUNTS,
        "split_pages": f"WITH {DOCUMENT_PAGES} SELECT doc_id, page, page_text FROM document_pages",
        "page_total": f"WITH {DOCUMENT_PAGES} SELECT count(*) AS n_pages FROM document_pages",
        "pages_per_document": f"""WITH {DOCUMENT_PAGES} SELECT doc_id, count(*) AS n_pages
            FROM document_pages GROUP BY doc_id""",
        "last_page": f"""WITH {DOCUMENT_PAGES} SELECT doc_id, max(page) AS last_page
            FROM document_pages GROUP BY doc_id""",
        "page_lookup": """SELECT conv_id, turn, role, text FROM conversations
            WHERE conv_id = 7 AND turn = 1""",
        "page_lookup_batch": """SELECT doc_id, lang, source, text FROM documents
            WHERE doc_id IN (SELECT doc_id FROM labels)""",
        "path_suffix": "SELECT page_id, url FROM pages WHERE url LIKE '%.html'",
        "sample_rows": """SELECT conv_id, turn, role, text FROM conversations
            ORDER BY conv_id, turn LIMIT 20""",
        "word_tokens": r"""SELECT doc_id, count(word) AS n_tokens,
            sum(length(word))::BIGINT AS n_chars, count(*) FILTER (word = '') AS n_empty,
            min(word) AS first_word, max(word) AS last_word, sum(place * length(word))::BIGINT AS places
            FROM (SELECT doc_id, generate_subscripts(l, 1) AS place, unnest(l) AS word
                  FROM (SELECT doc_id, string_split_regex(text, '[^a-zA-Z\d:]') AS l FROM documents))
            GROUP BY doc_id""",
        "word_counts": f"WITH {WORDS} {WORD_COUNTS}",
        "word_counts_sql": f"WITH {WORDS} {WORD_COUNTS}",
        "top_words": f"WITH {WORDS} {WORD_COUNTS} ORDER BY word_count DESC, word LIMIT 100",
        "wrap_markers": "SELECT doc_id, '[CLS] ' || text || '[SEP]' AS bert_input_text FROM documents",
        "pad_truncate": """SELECT doc_id, array_to_string(list_concat(
            regexp_extract_all(lower(text), '[0-9a-z_]+'),
            list_resize([]::VARCHAR[], 16, '[PAD]'))[1:16], ' ') AS tokens FROM documents""",
        "concat_parts": """SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS converted_texts
            FROM conversations GROUP BY ALL""",
        "gap_segments": f"""WITH {SEGMENTS}
            SELECT user_id, segment_id::BIGINT AS segment_id, count(*) AS n_events,
                   min(t) AS start_micros, max(t) AS end_micros
            FROM numbered GROUP BY user_id, segment_id""",
        "pack_segments": f"""WITH RECURSIVE {CHUNKS}
            SELECT doc_id, chunk_index, chunk, n_chars, n_lines FROM chunks""",
        "pad_batches": """WITH sized AS (
              SELECT doc_id, regexp_extract_all(lower(text), '[0-9a-z_]+')[1:512] AS tokens FROM documents),
            batched AS (SELECT *, (row_number() OVER (ORDER BY len(tokens), doc_id) - 1) // 32 AS batch FROM sized),
            padded AS (SELECT *, max(len(tokens)) OVER (PARTITION BY batch) AS padded_length FROM batched)
            SELECT doc_id, batch, len(tokens) AS n_tokens, padded_length,
              md5(array_to_string(list_resize(tokens, padded_length, '[PAD]'), ' ')) AS tokens_md5 FROM padded""",
        "pack_turns": f"""WITH RECURSIVE {TURNS.format(key="conv_id", place="turn")}, {_packed("placed", "conv_id", 400)}
            SELECT conv_id, chunk_index::BIGINT AS chunk_index, string_agg(text, chr(10) ORDER BY rn) AS chunk,
              sum(n)::BIGINT AS n_chars, count(*) AS n_segments FROM carried GROUP BY conv_id, chunk_index""",
        "pack_long_recording": f"""WITH RECURSIVE {TURNS.format(key="role", place="conv_id * 1000 + turn")},
            {_packed("placed", "role", 4000)}
            SELECT role, chunk_index::BIGINT AS chunk_index, md5(string_agg(text, chr(10) ORDER BY rn)) AS chunk_md5,
              sum(n)::BIGINT AS n_chars, count(*) AS n_segments FROM carried GROUP BY role, chunk_index""",
        "pack_gap_segments": f"""WITH RECURSIVE {SEGMENTS},
            segments AS (SELECT user_id, segment_id + 1 AS rn, max(t) - min(t) AS n, min(t) AS a, max(t) AS z
                         FROM numbered GROUP BY user_id, segment_id),
            {_packed("segments", "user_id", 12 * 3600 * 1_000_000)}
            SELECT user_id, chunk_index::BIGINT AS chunk_index, count(*) AS n_segments, sum(n)::BIGINT AS length,
              min(a) AS start_micros, max(z) AS end_micros FROM carried GROUP BY user_id, chunk_index""",
        "resume_enrich": r"""WITH counted AS (
              SELECT doc_id, len(string_split_regex(text, '[ \t\n\r\f]+')) AS n FROM documents)
            SELECT doc_id, CASE WHEN n % 6 <> 0 THEN n::VARCHAR END AS result,
              CASE WHEN n % 6 = 0 THEN 'ValueError: no answer for ' || n || ' words' END AS error,
              CASE WHEN n % 3 = 0 THEN 2 ELSE 1 END AS attempts FROM counted""",
        "dedup_enrich": r"""SELECT doc_id,
            len(string_split_regex(text, '[ \t\n\r\f]+'))::VARCHAR AS result,
            NULL::VARCHAR AS error FROM documents""",
        "flow_transcript": f"""SELECT conv_id, string_agg({_spaces("text")}, ' ' ORDER BY turn) AS converted_texts
            FROM conversations GROUP BY ALL""",
        "flow_recordings": f"""WITH RECURSIVE {CHUNKS}
            SELECT doc_id, string_agg({_spaces("chunk")}, ' ' ORDER BY chunk_index) AS converted_texts
            FROM chunks GROUP BY ALL""",
        "flow_segments": f"""WITH RECURSIVE {TURNS.format(key="role", place="conv_id * 1000 + turn")},
            {_packed("placed", "role", 4000)},
            chunks AS (SELECT role, chunk_index, string_agg(text, chr(10) ORDER BY rn) AS chunk
                       FROM carried GROUP BY role, chunk_index)
            SELECT role, string_agg({_spaces("chunk")}, ' ' ORDER BY chunk_index) AS converted_texts
            FROM chunks GROUP BY role""",
        "flow_tables": rf"""WITH {SECTIONS}, {QUERY_PAIRS}
            SELECT regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, {URL_COLUMNS},
              nullif(regexp_extract(url, '.*/([^/?]+)', 1), '') AS file_name, url,
              (SELECT count(DISTINCT key) FROM pairs q WHERE q.page_id = p.page_id) AS n_query_keys,
              octet_length(encode(html))::BIGINT AS n_bytes,
              coalesce((SELECT string_agg(text, ' ' ORDER BY section_index, text_index)
                        FROM expanded e WHERE e.page_id = p.page_id), '') AS speech_as_text
            FROM pages p""",
        "flow_transcript_tables": rf"""WITH {SECTIONS}
            SELECT md5(regexp_extract(url, {URL}, 2))[1:2] AS partition, url,
              regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, {PAGE_DATE} AS date,
              coalesce((SELECT string_agg(text, ' ' ORDER BY section_index, text_index)
                        FROM expanded e WHERE e.page_id = p.page_id), '') AS speech_as_text
            FROM pages p""",
        "flow_document_tables": SECTION_COUNTS,
        "embed_text": f"""WITH {_vectors("documents", "doc_id")}
            SELECT d.doc_id, d.dim, round(coalesce(s.value, 0), 6) AS value
            FROM (SELECT doc_id, unnest(range(0, 64)) AS dim FROM documents) d
            LEFT JOIN scaled s ON s.doc_id = d.doc_id AND s.dim = d.dim""",
        "embed_by_batches": f"""WITH {_vectors("documents", "doc_id")}
            SELECT d.doc_id, d.dim, round(coalesce(s.value, 0), 6) AS value
            FROM (SELECT doc_id, unnest(range(0, 64)) AS dim FROM documents) d
            LEFT JOIN scaled s ON s.doc_id = d.doc_id AND s.dim = d.dim""",
        "flow_embeddings": f"""WITH {SECTIONS},
            {_vectors("expanded", "page_id, section_index, text_index")}
            SELECT e.page_id, e.section_index, e.continuation, e.text_index, e.dim,
                   round(coalesce(s.value, 0), 6) AS value
            FROM (SELECT *, unnest(range(0, 64)) AS dim FROM expanded) e LEFT JOIN scaled s
            ON s.page_id = e.page_id AND s.section_index = e.section_index
               AND s.text_index = e.text_index AND s.dim = e.dim""",
        "cosine_one_vs_rest": """SELECT a.vec_id, round(list_cosine_similarity(
              a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS similarity
            FROM embeddings a, (SELECT embedding FROM embeddings WHERE vec_id = 0) b
            WHERE a.vec_id <> 0""",
        "cls_pool": """SELECT vec_id, unnest(range(0, 8)) AS dim,
            unnest(embedding[1:8])::DOUBLE AS value FROM embeddings""",
        "vector_multiply": """SELECT l_orderkey, l_linenumber,
            round(l_quantity * l_extendedprice, 2) AS product FROM lineitem""",
        "price_parts": """SELECT l_orderkey, l_linenumber, kind, round(CASE kind
              WHEN 'gross' THEN l_quantity * l_extendedprice
              WHEN 'discount' THEN l_quantity * l_extendedprice * l_discount
              ELSE l_quantity * l_extendedprice - l_quantity * l_extendedprice * l_discount END, 4) AS value
            FROM lineitem, (VALUES ('gross'), ('discount'), ('net')) AS k(kind)""",
        "vector_multiply_batches": """SELECT l_orderkey, l_linenumber,
            round(l_quantity * l_extendedprice, 2) AS product FROM lineitem""",
    }
