"""For each query, plain SQL over the same tables that must give the same rows."""

from revlens import rules
from revlens import catalog
from revlens.sources import orders_view as V

_B = [rule.prefix for rule in rules.BRANCH_RULES]


def _ends(column, endings):
    return "(" + " OR ".join(f"ends_with(lower({column}), '{e}')" for e in endings) + ")"


def _starts(column, beginnings):
    return "(" + " OR ".join(f"starts_with(lower({column}), '{b}')" for b in beginnings) + ")"


def _week(day):
    return (
        f"CASE WHEN month({day}) = 12 AND {day} + CAST(6 - dayofweek({day}) AS INT) > last_day({day}) THEN 1 "
        f"ELSE CAST((dayofyear({day}) + dayofweek(date_trunc('year', {day})) - 1) // 7 + 1 AS INT) END"
    )


def _week_year(day):
    return (
        f"CAST(year({day}) + CASE WHEN month({day}) = 12 AND {day} + CAST(6 - dayofweek({day}) AS INT) > last_day({day}) "
        "THEN 1 ELSE 0 END AS INT)"
    )


_CHECKS = f"""
  coalesce(kind = 'dir' AND coalesce(copy_path, '') <> '', false) AS is_copied_dir,
  {_ends('path', rules.SKIP_PREFIXES)} AS skip_prefix,
  {_ends('path', rules.SKIP_SUFFIXES)} AS skip_suffix,
  coalesce(kind = 'file' AND type <> 'D', false) AS is_changed_file
"""

_FULL = f"""CASE
  WHEN first_path IS NULL THEN 'other'
  WHEN starts_with(first_path, '{_B[0]}') OR starts_with(first_path, '{_B[1]}')
    THEN string_split(rtrim(first_path, '/'), '/')[4]
  WHEN starts_with(first_path, '{_B[2]}') THEN 'other'
  WHEN starts_with(first_path, '{_B[3]}') THEN split_part(substr(first_path, {len(_B[3]) + 1}), '/', 1)
  WHEN starts_with(first_path, '{_B[4]}') THEN 'other'
  WHEN starts_with(first_path, '{_B[5]}') THEN split_part(substr(first_path, {len(_B[5]) + 1}), '/', 1)
  ELSE 'other' END"""


def _label(values):
    whens = " ".join(f"WHEN starts_with(first_path, '{p}') THEN '{v}'" for p, v in zip(_B, values))
    return f"CASE WHEN first_path IS NULL THEN 'other' {whens} ELSE 'other' END"


_DOTS = "len(string_split(rtrim({0}, '.'), '.')) > 1"
_SHORT = (
    "CASE WHEN " + _DOTS + " THEN string_split(rtrim({0}, '.'), '.')[1] || '.' || string_split(rtrim({0}, '.'), '.')[2] "
    "ELSE {0} END"
)

_PATTERN = rules.ISSUE_PATTERN
_BUG = (
    "length({0}) > 11 OR (length({0}) = 11 AND coalesce(try_cast(substr({0}, 2, 5) AS BIGINT) > 30000, false))"
)
_UTF16 = "(length({0}) + length(regexp_replace({0}, '[^\\x{{10000}}-\\x{{10FFFF}}]', '', 'g')))"


def _clean(column, max_length, max_marks):
    size = _UTF16.format(column)
    return f"""CASE WHEN {column} IS NULL THEN ''
      WHEN {size} >= {max_length} THEN 'this log message was too long: ' || {size}
      WHEN length({column}) - length(replace({column}, '#', '')) >= {max_marks}
        THEN 'this log message contained too many issues: ' || {size}
      ELSE {column} END"""


_LOG = f"""
WITH entries AS ({V.ENTRIES}),
raw_paths AS ({V.PATHS}),
sizes AS ({V.DIFF_SIZES}),
paths AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY revision, path ORDER BY ordinal, type, kind, copy_path NULLS FIRST) AS rn
    FROM raw_paths) WHERE rn = 1),
checks AS (SELECT revision, ordinal, path, {_CHECKS} FROM paths),
firsts AS (
  SELECT revision, path AS first_path FROM (
    SELECT revision, path, row_number() OVER (PARTITION BY revision ORDER BY ordinal, path) AS rn FROM paths) WHERE rn = 1),
facts AS (
  SELECT revision, count(*) AS n, bool_or(is_copied_dir) AS copied,
         bool_or(is_changed_file AND NOT skip_prefix AND NOT skip_suffix) AS diffable
  FROM checks GROUP BY revision),
heads AS (
  SELECT e.*, f.first_path, CAST(coalesce(n, 0) AS INT) AS changed_files_count,
         NOT coalesce(copied, false) AND coalesce(diffable, false) AS needs_diff
  FROM entries e LEFT JOIN firsts f USING (revision) LEFT JOIN facts USING (revision)),
commits AS (
  SELECT revision, CAST(date AS DATE) AS date, author, '' AS team, '' AS role, changed_files_count,
         CAST(-1 AS BIGINT) AS diff_size, {_clean('message', 102400, 1000)} AS message
  FROM heads),
labels AS (
  SELECT revision, {_label([r.product for r in rules.BRANCH_RULES])} AS product,
         {_label([r.type for r in rules.BRANCH_RULES])} AS type,
         {_label([r.branch for r in rules.BRANCH_RULES])} AS branch, {_FULL} AS full_version,
         CASE WHEN starts_with(first_path, '{_B[3]}') OR starts_with(first_path, '{_B[5]}')
              THEN split_part({_FULL}, '_', 1) ELSE {_SHORT.format(_FULL)} END AS product_version
  FROM heads),
version AS (SELECT revision, product, type, branch, product_version, full_version FROM labels),
date_time AS (
  SELECT revision, CAST(date AS DATE) AS date, CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month,
         {_week('CAST(date AS DATE)')} AS week
  FROM entries),
refs AS (
  SELECT DISTINCT revision, CASE WHEN starts_with(m, '#') THEN m ELSE substr(m, 2) END AS reference
  FROM (SELECT revision, unnest(regexp_extract_all(coalesce(message, ''), '{_PATTERN}')) AS m FROM entries)),
issues AS (
  SELECT revision, CASE WHEN {_BUG.format('reference')} THEN 'B' ELSE 'F' END AS type, reference,
         '' AS notes_client_url, '' AS notes_web_url FROM refs),
rules AS ({V.AUTHOR_RULES}),
labelled AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT c.* EXCLUDE (team, role), coalesce(r.team, '') AS team, coalesce(r.role, '') AS role,
           row_number() OVER (PARTITION BY revision ORDER BY r.seq DESC) AS rn
    FROM commits c LEFT JOIN rules r ON r.author = c.author
      AND (r.valid_from IS NULL OR c.date >= r.valid_from) AND (r.valid_to IS NULL OR c.date < r.valid_to))
  WHERE rn = 1),
docs AS ({V.ISSUE_DOCS}),
originals AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY db, reference ORDER BY n_revisions DESC, doc_id) AS rn
                 FROM docs WHERE trim(reference) <> '') WHERE rn = 1),
refreshed AS (
  SELECT c.revision, CASE WHEN c.revision >= 101 THEN CASE WHEN h.needs_diff THEN coalesce(s.length, -1) ELSE -1 END
                          ELSE c.diff_size END AS diff_size,
         CASE WHEN h.needs_diff THEN coalesce(s.length, -1) ELSE -1 END AS full_size
  FROM commits c JOIN heads h USING (revision) LEFT JOIN sizes s USING (revision))
"""

_CALENDAR = f"""
SELECT revision, CAST(date AS DATE) AS date, strftime(date, '%H:%M:%S') AS time, date AS datetime,
       CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month, CAST(day(date) AS INT) AS day,
       {_week('CAST(date AS DATE)')} AS week, CAST(dayofweek(date) + 1 AS INT) AS day_of_week,
       CAST(hour(date) % 12 AS INT) AS hour, CAST(minute(date) AS INT) AS minutes, CAST(second(date) AS INT) AS sec,
       CAST(hour(date) AS INT) AS hour24, {_week_year('CAST(date AS DATE)')} AS week_year
"""



def _contents(team="team", size="full_size", where="true"):
    """Rows of the five tables as text; ``team`` and ``size`` say how commits are labelled and sized."""
    cells = lambda *names: "concat_ws('|', " + ", ".join(f"CAST({name} AS VARCHAR)" for name in names) + ")"
    calendar = [
        "date", "time", "strftime(datetime, '%Y-%m-%d %H:%M:%S')", "year", "month", "day", "week", "day_of_week", "hour", "minutes", "sec"
    ]
    return f"""{_LOG}, whole_calendar AS ({_CALENDAR} FROM entries)
        SELECT * FROM (
        SELECT 'commits' AS table_name, l.revision, {cells('date', 'author', team, 'role', 'changed_files_count', size, 'message')} AS content
          FROM labelled l JOIN refreshed USING (revision)
        UNION ALL SELECT 'files', revision, {cells('type', 'kind', 'path')} FROM paths
        UNION ALL SELECT 'date_time', revision, {cells(*calendar)} FROM whole_calendar
        UNION ALL SELECT 'version', revision, {cells('product', 'type', 'branch', 'product_version', 'full_version')} FROM version
        UNION ALL SELECT 'issues', revision, {cells('type', 'reference', 'notes_client_url', 'notes_web_url')} FROM issues)
        WHERE {where}"""


# Lines of the documents as one build log.
_DOC_LINES = """
lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         unnest(range(1, len(string_split(text, chr(10))) + 1)) AS distance FROM documents),
kept AS (SELECT * FROM lines WHERE regexp_matches(line, '[^\\x00-\\x20]'))
"""
_DOC_HEADER = "replace('***** s:/src/cpp/d', '/', chr(92)) || doc_id || ' *****'"
_TRIMMED = "regexp_replace(line, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"


def _errors(source, key):
    """Failed blocks of numbered, non-blank lines, in ``file`` by ``line_no``."""
    return f"""
    numbered AS (
      SELECT *, sum(CASE WHEN starts_with(upper({_TRIMMED}), '***** ') THEN 1 ELSE 0 END)
                OVER (PARTITION BY file ORDER BY line_no) AS block FROM {source}),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY file, block ORDER BY line_no) AS up,
             row_number() OVER (PARTITION BY file, block ORDER BY line_no DESC) AS down FROM numbered),
    blocks AS (
      SELECT file, block, count(*) AS n, max(CASE WHEN up = 1 THEN line END) AS header,
             max(CASE WHEN down = 1 THEN line END) AS last, max(CASE WHEN down = 2 THEN line END) AS prev
      FROM ranked GROUP BY file, block),
    failed AS (
      SELECT CASE WHEN upper({_TRIMMED.replace('line', 'last')}) = 'STOP.' THEN prev ELSE last END AS error_line,
             substr(header, 18, greatest(length(header) - 23, 0)) AS project, file, CAST(block AS BIGINT) AS block
      FROM blocks WHERE n >= 2 AND NOT starts_with({_TRIMMED.replace('line', 'last')}, 'OK'))"""


def _status(fixed):
    pairs = [f"WHEN starts_with(message, '{s}') THEN '{status}'" for s, status in rules.STATUS_BY_START]
    pairs += [f"WHEN contains(message, '{s}') THEN '{status}'" for s, status in rules.STATUS_BY_CONTENT]
    rest = f"substr(message, {len(rules.STATUS_CHANGE_START) + 1})"
    rest = f"regexp_replace({rest}, '^ ', '')" if fixed else rest
    return f"""CASE {' '.join(pairs)} WHEN starts_with(message, '{rules.STATUS_CHANGE_START}')
      THEN split_part({rest}, ' ', 1) ELSE 'UNKNOWN' END"""


def _plans():
    """``db`` and ``repo`` of each planned load, with the range worked out case by case."""
    events, orders = "(SELECT max(event_id) + 1 FROM events)", "(SELECT max(o_orderkey) + 1 FROM orders)"
    cases = [
        ("updateOrRebuild", events, orders, "NULL"),
        ("update", events, orders, "NULL"),
        ("forceRebuild", events, orders, "NULL"),
        ("updateOrRebuild", orders, events, "NULL"),
        ("updateOrRebuild", orders, orders, "NULL"),
        ("updateOrRebuild", events, orders, "10"),
    ]
    rows = " UNION ALL ".join(
        f"SELECT '{a}' AS action, CAST({db} AS BIGINT) AS db, CAST({repo} AS BIGINT) AS repo, CAST({end} AS BIGINT) AS e"
        for a, db, repo, end in cases
    )
    return f"""
    WITH cases AS ({rows}),
    firsts AS (SELECT *, coalesce(e, repo) AS last, CAST(CASE
        WHEN action = 'forceRebuild' THEN 1 WHEN action = 'update' THEN db + 1
        WHEN db < 1 THEN 1 WHEN db < repo THEN db + 1 END AS BIGINT) AS first FROM cases)
    SELECT action, db, repo,
           CASE WHEN first <= last THEN 'load' WHEN first IS NOT NULL THEN 'empty'
                WHEN db = repo THEN 'up to date' ELSE 'corrupted' END AS status,
           CASE WHEN first <= last THEN first END AS lo, CASE WHEN first <= last THEN last END AS hi
    FROM firsts"""


_PROD = "branch IN ('builds', 'hotfix')"
_JOINED = "version v JOIN date_time d USING (revision) JOIN commits c USING (revision)"
_KEY = "lower(CASE WHEN len(regexp_split_to_array(member, '[=/]')) = 1 THEN member ELSE regexp_split_to_array(member, '[=/]')[2] END)"

SQL = {
    "read_commit_log": _LOG + """
        SELECT revision, strftime(date, '%Y-%m-%d %H:%M:%S') AS date, author, message, path, type, kind, copy_path
        FROM entries LEFT JOIN raw_paths USING (revision)""",
    "revision_range": _LOG + "SELECT revision, author, message FROM entries WHERE revision >= 101",
    "stream_commit_log": _LOG + "SELECT revision, date, author, message FROM commits",
    "read_diff_sizes": "SELECT page_id + 1 AS revision, CAST(octet_length(encode(html)) AS BIGINT) AS length FROM pages",
    "read_issue_docs_by_kind": f"""
        SELECT doc_id, s_name AS reference, CASE length(file) WHEN 14 THEN 'feature' ELSE 'bug' END AS kind FROM (
          SELECT *, s_suppkey AS doc_id FROM ({catalog.SUPPLIER_FILES})
          UNION ALL SELECT *, -s_suppkey FROM ({catalog.SUPPLIER_FILES}) WHERE s_suppkey % 3 <> 0)
        WHERE length(file) IN (14, 15) AND file LIKE '#%'""",
    "issue_doc_rejects": """
        SELECT CAST(12 + length('<document><doc_id>' || s_suppkey || '</doc_id><reference>' || s_name || '</reference></document>') AS BIGINT) AS at_byte,
               '<document><doc_id>x' || s_suppkey || '</doc_id><reference>' || s_name || '</reference></document>' AS text
        FROM supplier WHERE s_suppkey % 3 = 0""",
    "read_author_rules": V.AUTHOR_RULES,
    "read_address_book": f"""
        SELECT doc_id, 'Person' AS type, full_name AS name, NULL AS member FROM ({V.PERSONS})
        UNION ALL SELECT s_suppkey + 1000000000000, 'Group', s_name, unnest(
          CASE WHEN s_nationkey % 2 = 0 THEN [NULL] ELSE [s_name, 'CN=' || s_name || ' Smith/ORG'] END) FROM supplier""",
    "read_issue_docs": f"""
        SELECT doc_id, db, reference, name, uniq_id, n_revisions, feature
        FROM ({V.ISSUE_DOCS})""",
    "issue_file_kind": _LOG + """
        SELECT revision, reference || '.XML' AS file_name,
               CASE length(reference) WHEN 10 THEN 'feature' WHEN 11 THEN 'bug' END AS kind FROM issues""",
    "read_build_log": f"""WITH {_DOC_LINES}
        SELECT {_DOC_HEADER} AS header, CAST(distance AS BIGINT) AS distance, line FROM kept
        UNION ALL SELECT {_DOC_HEADER}, 0, {_DOC_HEADER} FROM documents""",
    "write_table": _LOG + "SELECT * FROM commits",
    "write_tsv": _LOG + """
        SELECT CAST(revision AS VARCHAR) AS revision, coalesce(author, '') AS author, team,
               CAST(changed_files_count AS VARCHAR) AS changed_files_count FROM labelled""",
    "register_tables": _LOG + """
        SELECT revision, full_version, reference, week, path AS file
        FROM version v JOIN date_time USING (revision) JOIN issues i USING (revision) JOIN paths USING (revision)
        WHERE i.type = 'B' AND branch = 'hotfix'""",
    "create_tables": _LOG + f"""
        SELECT revision, i.type, reference, full_version, CAST(year(date) AS INT) AS year,
               CAST(month(date) AS INT) AS month, author, message
        FROM commits JOIN version v USING (revision) JOIN issues i USING (revision)
        WHERE branch IN ('builds', 'hotfix') AND year(date) = {catalog.REPORT_YEAR}""",
    "commits": _LOG + "SELECT * FROM commits",
    "clean_message": f"SELECT doc_id, {_clean('text', 102400, 1000)} AS message, {_clean('text', 5000, 3)} AS tight_message FROM documents",
    "count_issue_marks": "SELECT doc_id, CAST(len(string_split(text, '#')) - 1 AS INT) AS marks FROM documents",
    "files": _LOG + "SELECT revision, type, kind, path AS file FROM paths",
    "date_time": _LOG + _CALENDAR + " FROM entries",
    "date_time_clock": f"WITH clock AS ({V.CLOCK_ENTRIES})" + _CALENDAR + " FROM clock",
    "version": _LOG + "SELECT * FROM version",
    "product_version": f"SELECT p_partkey, full_version, {_SHORT.format('full_version')} AS product_version FROM ({catalog.PART_VERSIONS})",
    "underscore_version": f"""
        SELECT p_partkey, path, split_part(substr(path, 11), '/', 1) AS full_version,
               split_part(split_part(substr(path, 11), '/', 1), '_', 1) AS product_version FROM ({catalog.PART_PATHS})""",
    "extract_issues": _LOG + "SELECT revision, reference FROM refs",
    "classify_issue": f"""
        SELECT o_orderkey, reference, CASE WHEN {_BUG.format('reference')} THEN 'B' ELSE 'F' END AS type
        FROM (SELECT o_orderkey, '#' || (o_orderkey * 37) || ' - AB' AS reference FROM orders)""",
    "issues": _LOG + "SELECT * FROM issues",
    "ingest": _contents(),
    "load_outcome": _LOG + """
        SELECT count(*) AS lines_cnt, min(revision) AS min_rev, max(revision) AS max_rev, max(revision) - min(revision) AS max_min,
               count(*) FILTER (revision > 100) AS n_loaded, CAST(0 AS BIGINT) AS n_rejected,
               min(revision) FILTER (revision > 100) AS first_revision,
               CAST(arg_min(changed_files_count, revision) FILTER (revision > 100) AS BIGINT) AS files_of_first,
               max(revision) AS last_revision, CAST(arg_max(changed_files_count, revision) AS BIGINT) AS files_of_last,
               count(*) FILTER (revision > 100 AND needs_diff) AS diffs_needed,
               count(*) FILTER (revision > 100 AND NOT needs_diff) AS diffs_skipped
        FROM heads WHERE revision <= 1200""",
    "version_warnings": f"""
        WITH heads AS ({catalog.WARNING_HEADS}),
        sized AS (SELECT *, {_UTF16.format('message')} AS size, len(string_split(message, '#')) - 1 AS marks FROM heads)
        SELECT revision, 'message is too long' AS warning, CAST(size AS VARCHAR) AS detail FROM sized WHERE size >= 102400
        UNION ALL SELECT revision, 'message contains too many issues', CAST(marks AS VARCHAR) FROM sized
          WHERE size < 102400 AND marks >= 1000
        UNION ALL SELECT revision, 'full version is too short', string_split(first_path, '/')[4] FROM heads
          WHERE first_path LIKE '/branches/builds/%' AND NOT contains(string_split(first_path, '/')[4], '.')
        UNION ALL SELECT revision, 'path holds no version', first_path FROM heads WHERE first_path = '/branches/hotfixes/'
        UNION ALL SELECT revision, 'reference has a doubled mark', string_agg(DISTINCT m, ', ')
          FROM (SELECT revision, unnest(regexp_extract_all(message, '{_PATTERN}')) AS m FROM heads)
          WHERE regexp_matches(m, '^##\\d{{4}} ') GROUP BY revision""",
    "needs_diff": _LOG + "SELECT revision, needs_diff FROM heads",
    "is_copied_dir": _LOG + "SELECT revision, path, is_copied_dir FROM checks",
    "skip_prefix": f"""
        SELECT page_id, {_ends('path', rules.SKIP_PREFIXES)} AS skipped, {_starts('path', rules.SKIP_PREFIXES)} AS skipped_by_start
        FROM ({catalog.SKIP_PATHS})""",
    "skip_suffix": _LOG + "SELECT revision, path, skip_suffix FROM checks",
    "is_changed_file": _LOG + "SELECT revision, path, is_changed_file FROM checks",
    "diff_worklist": _LOG + "SELECT revision FROM heads WHERE needs_diff AND revision NOT IN (SELECT revision FROM sizes)",
    "obsolete_diffs": _LOG + "SELECT s.* FROM sizes s JOIN heads h USING (revision) WHERE NOT needs_diff",
    "update_diff_sizes": _LOG + """
        SELECT revision, CASE WHEN revision >= 101 THEN coalesce(length, -1) ELSE diff_size END AS diff_size
        FROM commits LEFT JOIN sizes USING (revision)""",
    "diff_progress": _LOG + """
        SELECT count(*) AS expected, count(*) FILTER (needs_diff) AS submitted, count(*) FILTER (NOT needs_diff) AS skipped
        FROM heads""",
    "assign_team_role": _LOG + "SELECT revision, author, team, role FROM labelled",
    "issue_links": _LOG + f"""
        SELECT revision, type, reference, CASE WHEN o.doc_id IS NOT NULL THEN
          '<a href=Notes:///{rules.FEATURES_REPLICA}/{rules.FEATURES_VIEW}/' || coalesce(uniq_id, 'NO-UniqID') || '>'
          || reference || '  ' || coalesce(name, 'NO-NAME') || '</a>' END AS link
        FROM issues LEFT JOIN (SELECT * FROM originals WHERE db = 'features') o USING (reference)""",
    "docs_by_reference": _LOG + """
        SELECT doc_id, reference FROM docs WHERE reference IN (SELECT '#' || (event_id + 1000) || ' - AB' FROM events)""",
    "original_document": _LOG + """,
        counted AS (SELECT *, count(*) OVER (PARTITION BY db, reference) AS n, max(doc_id) OVER (PARTITION BY db, reference) AS last_id
                    FROM docs WHERE trim(reference) <> ''),
        legacy AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY db, reference ORDER BY n_revisions DESC, doc_id) AS rn
                   FROM counted WHERE n = 1 OR doc_id < last_id) WHERE rn = 1)
        SELECT db, reference, o.doc_id, CAST(o.n_revisions AS INT) AS n_revisions, l.doc_id AS legacy_doc_id
        FROM originals o JOIN legacy l USING (db, reference)""",
    "item_or_default": """
        SELECT doc_id, coalesce(list_filter(string_split(text, chr(10)), lambda x: contains(x, '#'))[1], 'NO-LINE') AS item
        FROM documents""",
    "groups_for_users": """
        SELECT n_name AS group_name, lower(c_name) AS user
        FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey AND c_mktsegment <> 'HOUSEHOLD'
        UNION ALL SELECT r_name, NULL FROM region""",
    "member_to_user": f"""
        WITH keyed AS (SELECT id, {_KEY} AS key FROM ({catalog.PEOPLE}))
        SELECT id, CASE WHEN len(string_split(key, ' ')) = 2
          THEN string_split(key, ' ')[1][1] || string_split(key, ' ')[2] ELSE key END AS user FROM keyed""",
    "name_key": f"SELECT id, {_KEY} AS key FROM ({catalog.PEOPLE})",
    "team_roster": """
        SELECT CAST(n_nationkey + 100 AS BIGINT) AS doc_id, n_name AS group_name, 'CN=' || c_name || '/ORG' AS member,
               'user' || c_custkey || '@example.org' AS email,
               c_mktsegment[1] || lower(c_mktsegment[2:]) || 'C' || lower(c_name[2:]) AS first_name, 'VanSmith' AS last_name
        FROM nation JOIN customer ON c_nationkey = n_nationkey""",
    "camel_case": """
        SELECT p_partkey, list_aggregate(list_transform(string_split(p_name || ' ' || p_type || ' ' || p_brand, ' '),
          lambda x: upper(x[1]) || lower(x[2:])), 'string_agg', '') AS name FROM part""",
    "document_items": f"""
        WITH docs AS ({V.PERSONS}), groups AS (SELECT s_suppkey + 1000000000000 AS doc_id, s_name, s_nationkey FROM supplier)
        SELECT doc_id, name, '[' || value || ']' AS value FROM (
          SELECT doc_id, 'type' AS name, type AS value FROM docs UNION ALL SELECT doc_id, 'full_name', full_name FROM docs
          UNION ALL SELECT doc_id, 'first_name', first_name FROM docs UNION ALL SELECT doc_id, 'last_name', last_name FROM docs
          UNION ALL SELECT doc_id, 'internet_address', internet_address FROM docs
          UNION ALL SELECT doc_id, 'type', 'Group' FROM groups UNION ALL SELECT doc_id, 'list_name', s_name FROM groups
          UNION ALL SELECT doc_id, 'members', s_name || ', CN=' || s_name || ' Smith/ORG' FROM groups WHERE s_nationkey % 2 <> 0)
        WHERE value <> ''""",
    "max_revision": "SELECT max(o_orderkey) + 1 AS max_revision FROM orders",
    "plan_load": _plans(),
    "incremental_append": _contents(size="CASE WHEN l.revision > 8000 THEN full_size ELSE -1 END"),
    "incremental_append_stream": """
        SELECT event_id + 1 AS revision, event_type AS author, '4.1' AS full_version,
               '#' || (user_id + 1000) || ' - AB' AS reference, '/branches/builds/4.1/' || event_type AS file FROM events""",
    "rebuild": _contents(where="revision >= 101"),
    "check_unique": _LOG + """
        SELECT revision, path AS file, count(*) AS copies FROM raw_paths GROUP BY revision, path HAVING count(*) > 1""",
    "check_lengths": """
        SELECT doc_id, 'text' AS column_name, CAST(""" + _UTF16.format("text") + """ AS INT) AS n_chars, 2048 AS max_chars
        FROM documents WHERE """ + _UTF16.format("text") + """ > 2048
        UNION ALL SELECT doc_id, 'source', CAST(length(source) AS INT), 4 FROM documents WHERE length(source) > 4""",
    "check_tables": _LOG + """,
        keyed AS (
          SELECT 'commits' AS table_name, CAST(revision AS VARCHAR) AS key,
                 CAST(length(message) > 102400 AS INT) + CAST(coalesce(length(author) > 100, false) AS INT) AS long FROM commits
          UNION ALL SELECT 'files', revision || ' ' || path, CAST(length(path) > 2048 AS INT) FROM paths
          UNION ALL SELECT 'date_time', CAST(revision AS VARCHAR), 0 FROM date_time
          UNION ALL SELECT 'version', CAST(revision AS VARCHAR), CAST(length(full_version) > 100 AS INT) FROM version
          UNION ALL SELECT 'issues', revision || type || reference, CAST(length(reference) > 100 AS INT) FROM issues),
        per_key AS (SELECT table_name, key, count(*) AS copies, sum(long) AS long FROM keyed GROUP BY table_name, key)
        SELECT table_name, count(*) FILTER (copies > 1) AS repeated_keys, CAST(sum(long) AS BIGINT) AS long_values
        FROM per_key GROUP BY table_name""",
    "load_report": """
        SELECT count(*) AS lines_cnt, min(o_orderkey) + 1 AS min_rev, max(o_orderkey) + 1 AS max_rev,
               max(o_orderkey) - min(o_orderkey) AS max_min FROM orders""",
    "boundary_rows": _LOG + "SELECT revision, changed_files_count FROM commits WHERE revision IN (1, 1000)",
    "refresh_diffs": _LOG + "SELECT revision, r.diff_size, message FROM refreshed r JOIN commits USING (revision)",
    "prod_commits_with_issues": _LOG + f"""
        SELECT revision, i.type, reference, full_version, year, month, author, message
        FROM {_JOINED} JOIN issues i USING (revision) WHERE {_PROD} AND year = {catalog.REPORT_YEAR}""",
    "revision_span": "SELECT count(*) AS cnt, min(o_orderkey) + 1 AS minrev, max(o_orderkey) + 1 AS maxrev FROM orders",
    "commits_per_branch_month": _LOG + f"""
        SELECT branch, count(*) AS commits_count, year, month FROM {_JOINED} GROUP BY year, month, branch""",
    "commits_per_version_month": _LOG + f"""
        SELECT full_version, count(*) AS commits_count, year, month FROM {_JOINED} WHERE {_PROD}
        GROUP BY year, month, full_version""",
    "files_per_commit_month": _LOG + f"""
        SELECT branch, count(*) AS cmts, CAST(sum(changed_files_count) AS BIGINT) AS cf,
               CAST(sum(changed_files_count) // count(*) AS BIGINT) AS fpc,
               CAST(sum(changed_files_count) AS DOUBLE) / count(*) AS fpc_exact, year, month
        FROM {_JOINED} GROUP BY year, month, branch""",
    "issues_per_branch_month": _LOG + f"""
        SELECT count(DISTINCT reference) AS issues, i.type, branch, year, month
        FROM {_JOINED} JOIN issues i USING (revision) WHERE {_PROD} GROUP BY branch, i.type, year, month""",
    "issues_authors_per_version_month": _LOG + f"""
        SELECT count(DISTINCT reference) AS issues, i.type, full_version, product_version, year, month,
               count(DISTINCT author) AS authors
        FROM {_JOINED} JOIN issues i USING (revision) WHERE {_PROD}
        GROUP BY full_version, product_version, i.type, year, month""",
    "branches_per_week": _LOG + f"""
        SELECT count(DISTINCT full_version) AS branches, year, week FROM {_JOINED} WHERE {_PROD} GROUP BY year, week""",
    "branches_authors_per_week": _LOG + f"""
        SELECT count(DISTINCT full_version) AS branches, count(DISTINCT author) AS authors, year, week,
               year || '_' || week AS yw FROM {_JOINED} WHERE {_PROD} GROUP BY year, week""",
    "issues_per_author_week": _LOG + f"""
        SELECT author, year, week, count(DISTINCT reference) AS cnt FROM {_JOINED} JOIN issues i USING (revision)
        WHERE author = '{catalog.REPORT_AUTHOR}' GROUP BY author, year, week ORDER BY author, year, week LIMIT 30""",
    "team_activity": _LOG + """
        SELECT team, role, CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month, count(*) AS commits_count
        FROM labelled GROUP BY ALL""",
    "build_errors": f"WITH lines AS ({V.BUILD_LINES}), {_errors('lines', 'file')} SELECT * FROM failed",
    "build_errors_of_files": f"""WITH {_DOC_LINES},
        all_lines AS (SELECT doc_id AS file, distance AS line_no, line FROM kept
                      UNION ALL SELECT doc_id, 0, {_DOC_HEADER} FROM documents), {_errors('all_lines', 'file')}
        SELECT error_line, project FROM failed""",
    "history_messages": f"""
        WITH lines AS (SELECT unnest(string_split(rtrim(text, chr(10)), chr(10))) AS line FROM documents
                       WHERE rtrim(text, chr(10)) <> ''),
        cut AS (SELECT DISTINCT CASE WHEN length(line) < 13 THEN line ELSE substr(line, 14) END AS message FROM lines)
        SELECT message FROM cut WHERE upper({_status(False)}) = 'UNKNOWN'""",
    "status_of_message": f"""
        SELECT event_id, {_status(False)} AS status, {_status(True)} AS fixed_status FROM ({V.HISTORY_MESSAGES})""",
    "bug_to_feature": f"""
        SELECT doc_id, reference, CASE WHEN feature = '' THEN '' ELSE
          split_part(feature, ' ', 1) || ' - ' || split_part(feature, ' ', 3) END AS feature_reference, feature
        FROM ({V.ISSUE_DOCS}) WHERE reference <> ''""",
    "watchlist_needs_diff": _LOG + """
        SELECT revision, needs_diff, p.type, p.kind, p.path FROM heads LEFT JOIN paths p USING (revision)
        WHERE revision IN (SELECT user_id + 1 FROM events)""",
}

# Reports over states must give what they give over the commits.
for _report in ("issues_per_branch_month", "branches_authors_per_week"):
    SQL[f"{_report}_of_states"] = SQL[_report]
