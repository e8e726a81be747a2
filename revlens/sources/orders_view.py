"""A commit log, an address book and tracker documents derived from order tables.

Each order is a commit and each line item a changed path.  The definitions are
plain SQL that any engine evaluates to the same rows; they use every row of
their tables.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens import rules
from revlens.sources.commit_log import CommitLog

_AMBER = rules.BRANCH_RULES[3].prefix
_TRUNK = rules.BRANCH_RULES[4].prefix
_KIOSK = rules.BRANCH_RULES[5].prefix
_AREA = rules.BRANCH_RULES[6].prefix

FEATURE_SQL = "'#' || (1000 + (o_custkey * 37) % 9000) || ' - AB'"

ENTRIES = f"""
SELECT o_orderkey + 1 AS revision,
       o_orderdate AS date,
       CASE WHEN o_custkey % 97 = 0 THEN NULL ELSE 'dev' || (o_custkey % 40) END AS author,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL
            ELSE 'fix ' || {FEATURE_SQL} || ' and #' || (10000 + (o_orderkey * 7919) % 60000) || ' - CD'
       END AS message
FROM orders
"""

PATHS = f"""
SELECT l_orderkey + 1 AS revision,
       l_linenumber AS ordinal,
       CASE l_suppkey % 9
         WHEN 0 THEN '/branches/builds/4.' || (l_partkey % 5) || '.1/src/f' || l_partkey || '.java'
         WHEN 1 THEN '/branches/builds/5.' || (l_partkey % 3) || '.2/f' || l_partkey || '.xml'
         WHEN 2 THEN '/branches/hotfixes/4.' || (l_partkey % 5) || '.7/f' || l_partkey || '.cpp'
         WHEN 3 THEN '/branches/tnt/f' || l_partkey
         WHEN 4 THEN '{_AMBER}9_' || (l_partkey % 4) || '/f'
         WHEN 5 THEN '{_TRUNK}/f' || l_partkey
         WHEN 6 THEN '{_KIOSK}2_1/f'
         WHEN 7 THEN '{_AREA}/misc/f' || l_partkey
         ELSE '/trunk/f' || l_partkey || '.dll'
       END AS path,
       CASE l_returnflag WHEN 'A' THEN 'A' WHEN 'N' THEN 'M' ELSE 'D' END AS type,
       CASE WHEN l_linenumber = 7 THEN 'dir' ELSE 'file' END AS kind,
       CASE WHEN l_linenumber = 7 AND l_partkey % 5 = 0 THEN '/trunk' END AS copy_path
FROM lineitem
"""

# Events have a time of day, which orders lack.
CLOCK_ENTRIES = "SELECT event_id + 1 AS revision, ts AS date FROM events"

# Every event stands for a diff file.
DIFF_SIZES = """
SELECT event_id + 1 AS revision, CAST(length(props) + user_id AS BIGINT) AS length FROM events
"""

# Three overlapping rules per author: always, before a date and from a date.  They
# are numbered from dev1, so dev0 has none.
_AUTHORS = "(SELECT DISTINCT c_custkey % 40 + 1 AS n FROM customer)"
AUTHOR_RULES = f"""
SELECT 'dev' || n AS author, 'dev' AS role, 'team' || (n % 16) AS team,
       CAST(NULL AS DATE) AS valid_from, CAST(NULL AS DATE) AS valid_to, CAST(3 * n AS INT) AS seq FROM {_AUTHORS} a
UNION ALL
SELECT 'dev' || n, 'qa', 'first' || (n % 5), CAST(NULL AS DATE),
       CASE WHEN n % 2 = 0 THEN DATE '1996-07-01' ELSE DATE '1998-09-01' END, CAST(3 * n + 1 AS INT) FROM {_AUTHORS} b
UNION ALL
SELECT 'dev' || n, CASE WHEN n % 3 = 0 THEN 'qa' ELSE 'dev' END, 'later' || (n % 7), DATE '1998-01-01',
       CAST(NULL AS DATE), CAST(3 * n + 2 AS INT) FROM {_AUTHORS} c
"""

# Nations are groups, twice over so that the later document replaces the earlier;
# customers are members, and persons twice over for the same reason.  Regions are
# groups without members.
GROUP_MEMBERS = """
SELECT CAST(n_nationkey AS BIGINT) AS doc_id, n_name AS list_name, CAST(NULL AS STRING) AS member FROM nation
UNION ALL
SELECT CAST(n_nationkey + 100 AS BIGINT), n_name, 'CN=' || c_name || '/ORG'
FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey
UNION ALL
SELECT CAST(r_regionkey + 200 AS BIGINT), r_name, CAST(NULL AS STRING) FROM region
"""
PERSONS = """
SELECT c_custkey + 1000 AS doc_id, 'Person' AS type, 'CN=' || c_name || '/ORG/X' AS full_name,
       c_mktsegment || ' ' || c_name AS first_name, 'van SMITH' AS last_name,
       'User' || c_custkey || '@Example.ORG' AS internet_address
FROM customer
UNION ALL
SELECT -1 - c_custkey, 'Person', 'CN=' || c_name || '/OLD', 'former', CAST(NULL AS STRING), 'Old@Example.ORG'
FROM customer
"""

# Orders are tracker documents; several share a reference.
ISSUE_DOCS = f"""
SELECT o_orderkey AS doc_id, CASE WHEN o_orderkey % 3 = 1 THEN 'bugs' ELSE 'features' END AS db,
       CASE WHEN o_custkey % 89 = 0 THEN ' ' ELSE {FEATURE_SQL} END AS reference,
       CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority END AS name,
       CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE 'U' || o_orderkey END AS uniq_id,
       (o_custkey + o_orderkey) % 7 AS n_revisions,
       CASE WHEN o_orderkey % 3 = 0 THEN ''
            ELSE '#' || (10000 + o_custkey) || ' - CD ' || o_orderpriority END AS feature
FROM orders
"""

# Events as history messages: every rule, a status change and an unknown one.
_STARTS = [*[s for s, _ in rules.STATUS_BY_START], rules.STATUS_CHANGE_START, "Looked at by"]
HISTORY_MESSAGES = f"""
SELECT event_id, CASE event_id % {len(_STARTS) + 1}
{chr(10).join(f"  WHEN {i} THEN '{start}'" for i, start in enumerate(_STARTS))}
  ELSE 'He {rules.STATUS_BY_CONTENT[0][0]}' END
  || CASE WHEN user_id % 2 = 0 THEN ' ' ELSE '' END || event_type || ' u' || user_id AS message
FROM events
"""

# Turns of a conversation are the lines of a build log; a user's turn opens a block.
BUILD_LINES = """
SELECT CAST(conv_id AS STRING) AS file, turn + 1 AS line_no,
       CASE WHEN role = 'user' THEN replace('***** s:/src/cpp/p', '/', chr(92)) || conv_id || '_' || turn || ' *****'
            ELSE replace(text, chr(10), ' ') END AS line
FROM conversations
"""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def view(spark: SparkSession, folder: str, sql: str) -> DataFrame:
    """Evaluate one of the definitions above over the tables of a folder."""
    names = ("orders", "lineitem", "events", "customer", "nation", "region", "conversations")
    tables = {name: table(spark, folder, name) for name in names if name in sql}
    body = sql
    for name in tables:
        body = body.replace(f"FROM {name}", f"FROM {{{name}}}").replace(f"JOIN {name}", f"JOIN {{{name}}}")
    return spark.sql(body, **tables)


def commit_log(spark: SparkSession, folder: str) -> CommitLog:
    """The log over orders; line items are not unique per path."""
    return CommitLog.from_flat(view(spark, folder, ENTRIES), view(spark, folder, PATHS), unique_paths=False)


def issue_docs(spark: SparkSession, folder: str) -> DataFrame:
    docs = view(spark, folder, ISSUE_DOCS)
    revisions = F.array_repeat(F.lit("r"), F.col("n_revisions").cast("int")).alias("revisions")
    return docs.select("doc_id", "db", "reference", "name", "uniq_id", revisions, "feature")
