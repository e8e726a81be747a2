"""One runnable query per operator, over the tables of a folder."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens import schema
from revlens.functions import messages as M
from revlens.functions import names as N
from revlens.functions import paths as P
from revlens.operators import address_book, checks, diffs, tables, teams, tracker
from revlens.plans import jobs, load, reports, states
from revlens.session import scratch_dir
from revlens.sources import commit_log, listing, readers, store
from revlens.sources import orders_view as V
from revlens.streaming.incremental import append_stream

QUERIES = {}

REPORT_YEAR = 1998
REPORT_AUTHOR = "dev7"
FAST_GZIP = {"zlib.compress.level": "BEST_SPEED"}


def query(function):
    QUERIES[function.__name__] = function
    return function


def _events_log(spark, folder) -> DataFrame:
    return V.view(spark, folder, V.CLOCK_ENTRIES)


def _commits(spark, folder) -> DataFrame:
    return tables.commits(V.commit_log(spark, folder).dated)


def _issues(spark, folder) -> DataFrame:
    return tables.issues(V.commit_log(spark, folder).dated)


def _sizes(spark, folder) -> DataFrame:
    return V.view(spark, folder, V.DIFF_SIZES)


def _author_rules(spark, folder) -> DataFrame:
    return V.view(spark, folder, V.AUTHOR_RULES)


def _labelled(spark, folder) -> DataFrame:
    return teams.assign_team_role(_commits(spark, folder), _author_rules(spark, folder))


def _commit_facts(spark, folder) -> DataFrame:
    return reports.commit_facts(V.commit_log(spark, folder))


def _issue_facts(spark, folder) -> DataFrame:
    return reports.issue_facts(V.commit_log(spark, folder))


# --- sources and sinks -------------------------------------------------------


def _export_xml_log(spark: SparkSession, folder: str) -> str:
    """The log over orders as XML, one element per changed path of a commit.

    A commit's paths are spread over elements, so exporting gathers no group.  Elements
    repeat their tags and the commit's text; packed at the least level, they take a small part of the space.
    """
    written = F.date_format(F.col("date").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    entries = V.view(spark, folder, V.ENTRIES).withColumn("date", written)
    rows = entries.join(V.view(spark, folder, V.PATHS).drop("ordinal"), "revision", "left")
    rows = rows.repartition(spark.sparkContext.defaultParallelism)
    element = F.struct(
        F.col("path").alias("_VALUE"),
        F.col("type").alias("_action"),
        F.col("kind").alias("_kind"),
        F.col("copy_path").alias("_copyfrom-path"),
    )
    target = scratch_dir(spark, "log-xml")
    rows.select(
        F.col("revision").alias("_revision"),
        "author",
        "date",
        F.when(F.col("path").isNotNull(), F.struct(F.array(element).alias("path"))).alias("paths"),
        F.col("message").alias("msg"),
    ).write.options(rowTag="logentry", rootTag="log", indent="", compression="gzip", **FAST_GZIP).xml(target)
    return target


@query
def read_commit_log(spark, folder):
    nested = commit_log.read_commit_log(spark, _export_xml_log(spark, folder))
    return nested.select(
        "revision",
        F.date_format("date", "yyyy-MM-dd HH:mm:ss").alias("date"),
        "author",
        "message",
        F.explode_outer("changed_paths").alias("p"),
    ).select("revision", "date", "author", "message", "p.path", "p.type", "p.kind", "p.copy_path")


@query
def revision_range(spark, folder):
    heads = V.commit_log(spark, folder).heads
    return commit_log.revision_range(heads, 101).select("revision", "author", "message")


@query
def stream_commit_log(spark, folder):
    """The exported log as a stream that is stopped and started again."""
    source, target = _export_xml_log(spark, folder), store.CommitStore(spark, scratch_dir(spark, "store"))
    checkpoint = scratch_dir(spark, "checkpoint")
    for _ in range(2):
        stream = commit_log.stream_commit_log(spark, source, max_files=4)
        append_stream(stream, target, checkpoint).trigger(availableNow=True).start().awaitTermination()
    return target.read("commits").select("revision", "date", "author", "message")


@query
def read_diff_sizes(spark, folder):
    target = scratch_dir(spark, "diffs")
    name = F.concat_ws("/", F.col("page_id") % 11, F.col("page_id") % 3, F.concat(F.col("page_id") + 1, F.lit(".diff")))
    listing.write_files(V.table(spark, folder, "pages").select(name.alias("name"), F.col("html").alias("body")), target)
    return readers.read_diff_sizes(spark, target)


@query
def read_author_rules(spark, folder):
    target = scratch_dir(spark, "rules")
    _author_rules(spark, folder).write.option("header", "true").option("dateFormat", "dd.MM.yyyy").csv(target)
    return readers.read_author_rules(spark, target)


def _write_address_book(spark, folder) -> str:
    target = scratch_dir(spark, "address-book")
    V.view(spark, folder, V.PERSONS).write.json(target)
    suppliers = V.table(spark, folder, "supplier")
    members = F.when(F.col("s_nationkey") % 2 == 0, F.array()).otherwise(
        F.array("s_name", F.concat(F.lit("CN="), F.col("s_name"), F.lit(" Smith/ORG")))
    )
    suppliers.select(
        (F.col("s_suppkey") + 10**12).alias("doc_id"),
        F.lit("Group").alias("type"),
        F.col("s_name").alias("list_name"),
        members.cast("array<string>").alias("members"),
    ).write.mode("append").json(target)
    return target


@query
def read_address_book(spark, folder):
    book = readers.read_address_book(spark, _write_address_book(spark, folder))
    people = readers.persons(book).select("doc_id", "type", F.col("full_name").alias("name"), F.lit(None).cast("string").alias("member"))
    members = address_book.group_members(readers.groups(book))
    return people.unionByName(
        members.select("doc_id", F.lit("Group").alias("type"), F.col("list_name").alias("name"), "member")
    )


@query
def read_issue_docs(spark, folder):
    target = scratch_dir(spark, "issue-docs")
    V.issue_docs(spark, folder).write.option("rowTag", "document").option("rootTag", "documents").xml(target)
    docs = readers.read_issue_docs(spark, target)
    return docs.select(
        "doc_id", "db", "reference", "name", "uniq_id",
        F.size("revisions").cast("bigint").alias("n_revisions"),
        F.coalesce("feature", F.lit("")).alias("feature"),
    )


SUPPLIER_FILES = """
SELECT CASE s_nationkey % 3 WHEN 0 THEN '#' || (1000 + s_suppkey % 9000) || ' - AB.xml' WHEN 1 THEN '#' || (10000 + s_suppkey) || ' - CD.XML'
         ELSE 'note-' || s_suppkey || '.xml' END AS file, s_suppkey, s_name FROM supplier
"""


def _export_supplier_docs(spark, folder) -> str:
    """A folder per supplier with a file of two documents; the second one of every third is broken."""
    sql = SUPPLIER_FILES.replace("FROM supplier", "FROM {supplier}")
    files = spark.sql(sql, supplier=V.table(spark, folder, "supplier"))
    key = F.col("s_suppkey").cast("string")
    doc = lambda doc_id: F.concat(
        F.lit("<document><doc_id>"), doc_id, F.lit("</doc_id><reference>"), "s_name", F.lit("</reference></document>\n")
    )
    second = F.when(F.col("s_suppkey") % 3 == 0, doc(F.concat(F.lit("x"), key))).otherwise(doc(F.concat(F.lit("-"), key)))
    body = F.concat(F.lit("<documents>\n"), doc(key), second, F.lit("</documents>\n"))
    target = scratch_dir(spark, "supplier-docs")
    listing.write_files(files.select(F.concat(key, F.lit("/"), "file").alias("name"), body.alias("body")), target)
    return target


@query
def read_issue_docs_by_kind(spark, folder):
    source, rejects = _export_supplier_docs(spark, folder), scratch_dir(spark, "rejects")
    read = [
        readers.read_issue_docs(spark, source, kind, rejects=rejects).select("doc_id", "reference", F.lit(kind).alias("kind"))
        for kind in ("feature", "bug")
    ]
    return reduce(DataFrame.unionByName, read)


@query
def issue_doc_rejects(spark, folder):
    rejects = scratch_dir(spark, "rejects")
    readers.read_issue_docs(spark, _export_supplier_docs(spark, folder), rejects=rejects)
    return spark.read.parquet(rejects).select(F.col("offset").alias("at_byte"), "text")


@query
def issue_file_kind(spark, folder):
    names = _issues(spark, folder).select("revision", F.concat("reference", F.lit(".XML")).alias("file_name"))
    return names.withColumn("kind", readers.issue_file_kind(F.col("file_name")))


def _build_log(spark, folder) -> str:
    """Documents as one long build log: a block header, then the whole text."""
    target = scratch_dir(spark, "build-log")
    header = F.concat(F.lit(r"***** s:\src\cpp\d"), F.col("doc_id").cast("string"), F.lit(" *****\n"))
    V.table(spark, folder, "documents").select(F.concat(header, "text").alias("value")).write.text(target)
    return target


@query
def read_build_log(spark, folder):
    """Lines by their distance from the block header above them."""
    lines = jobs.numbered_blocks(readers.read_build_log(spark, _build_log(spark, folder)))
    starts = (
        lines.filter(jobs.is_block_start(F.col("line")))
        .select("file", "block", F.col("line").alias("header"), F.col("line_no").alias("head_no"))
    )
    return lines.join(starts, ["file", "block"]).select(
        "header", (F.col("line_no") - F.col("head_no")).alias("distance"), "line"
    )


@query
def write_table(spark, folder):
    target = store.CommitStore(spark, scratch_dir(spark, "store"))
    target.append(_commits(spark, folder), "commits")
    return target.read("commits")


@query
def write_tsv(spark, folder):
    target = scratch_dir(spark, "tsv")
    store.write_tsv(_labelled(spark, folder).select("revision", "author", "team", "changed_files_count"), target)
    cells = F.split("value", "\t")
    return spark.read.text(target).select(
        *[cells[i].alias(name) for i, name in enumerate(("revision", "author", "team", "changed_files_count"))]
    )


@query
def register_tables(spark, folder):
    built = tables.build(V.commit_log(spark, folder))
    store.register_tables({name: built[name] for name in schema.TABLES}, prefix="log_")
    return spark.sql(
        """
        SELECT c.revision, v.full_version, i.reference, d.week, f.file
        FROM log_commits c JOIN log_version v ON v.revision = c.revision
        JOIN log_issues i ON i.revision = c.revision
        JOIN log_date_time d ON d.revision = c.revision
        JOIN log_files f ON f.revision = c.revision
        WHERE i.type = 'B' AND v.branch = 'hotfix'
        """
    )


@query
def create_tables(spark, folder):
    """A script that names its four tables in any order, over catalog tables with statistics."""
    built = tables.build(V.commit_log(spark, folder))
    target = scratch_dir(spark, "catalog")
    prefix = f"log_{target[-32:]}_"
    used = ("version", "issues", "date_time", "commits")
    store.create_tables(spark, {name: built[name] for name in used}, buckets=8, prefix=prefix, folder=target)
    return spark.sql(
        f"""
        SELECT v.revision, i.type, i.reference, v.full_version, dt.year, dt.month, c.author, c.message
        FROM {prefix}version v, {prefix}issues i, {prefix}date_time dt, {prefix}commits c
        WHERE v.revision = i.revision AND dt.revision = v.revision AND c.revision = v.revision
          AND (v.branch = 'builds' OR v.branch = 'hotfix') AND dt.year = {REPORT_YEAR}
        """
    )


# --- table builders ----------------------------------------------------------


@query
def commits(spark, folder):
    return _commits(spark, folder)


@query
def clean_message(spark, folder):
    text = F.col("text")
    return V.table(spark, folder, "documents").select(
        "doc_id", M.clean_message(text).alias("message"), M.clean_message(text, 5000, 3).alias("tight_message")
    )


@query
def count_issue_marks(spark, folder):
    return V.table(spark, folder, "documents").select("doc_id", M.count_issue_marks(F.col("text")).alias("marks"))


@query
def files(spark, folder):
    return tables.files(V.commit_log(spark, folder).paths)


@query
def date_time(spark, folder):
    return tables.date_time(V.commit_log(spark, folder).dated, extras=True)


@query
def date_time_clock(spark, folder):
    return tables.date_time(_events_log(spark, folder), extras=True)


@query
def version(spark, folder):
    return tables.version(V.commit_log(spark, folder).dated)


PART_VERSIONS = """
SELECT p_partkey, p_partkey || CASE p_size % 6 WHEN 0 THEN '' WHEN 1 THEN '.' WHEN 2 THEN '.5' WHEN 3 THEN '.5.' || p_size
  WHEN 4 THEN '..' ELSE '..7' END AS full_version FROM part
"""


@query
def product_version(spark, folder):
    versions = spark.sql(PART_VERSIONS.replace("FROM part", "FROM {part}"), part=V.table(spark, folder, "part"))
    return versions.withColumn("product_version", P.product_version(F.col("full_version")))


PART_PATHS = """
SELECT p_partkey, '/lib/lib_v' || CASE p_size % 4 WHEN 0 THEN p_partkey || '_' || p_size || '/f' WHEN 1 THEN '' || p_partkey
  WHEN 2 THEN '_' || p_partkey || '/f/g' ELSE '/f' END AS path FROM part
"""


@query
def underscore_version(spark, folder):
    paths = spark.sql(PART_PATHS.replace("FROM part", "FROM {part}"), part=V.table(spark, folder, "part"))
    full = P.underscore_version(F.col("path"), "/lib/lib_v")
    return paths.select(
        "p_partkey", "path", full.alias("full_version"), P.underscore_product_version(full).alias("product_version")
    )


@query
def extract_issues(spark, folder):
    entries = V.view(spark, folder, V.ENTRIES)
    return entries.select("revision", F.explode(M.issue_references(F.col("message"))).alias("reference"))


@query
def classify_issue(spark, folder):
    reference = F.concat(F.lit("#"), (F.col("o_orderkey") * 37).cast("string"), F.lit(" - AB"))
    return V.table(spark, folder, "orders").select("o_orderkey", reference.alias("reference")).withColumn(
        "type", M.issue_type(F.col("reference"))
    )


@query
def issues(spark, folder):
    return _issues(spark, folder)


def _contents(target: store.CommitStore) -> DataFrame:
    """Every row of the five stored tables as text."""

    def text(field):
        if field.dataType.typeName() == "timestamp":
            return F.date_format(field.name, "yyyy-MM-dd HH:mm:ss")
        return F.col(field.name).cast("string")

    return reduce(
        DataFrame.unionByName,
        [
            df.select(
                F.lit(name).alias("table_name"),
                "revision",
                F.concat_ws("|", *[text(f) for f in df.schema if f.name != "revision"]).alias("content"),
            )
            for name, df in target.tables().items()
        ],
    )


def _former_rules(spark, folder) -> DataFrame:
    return _author_rules(spark, folder).withColumn("team", F.concat(F.lit("former "), "team"))


@query
def ingest(spark, folder):
    """Load everything, with labels and diff sizes, and show all that was stored."""
    target = store.CommitStore(spark, scratch_dir(spark, "store"))
    load.ingest(V.commit_log(spark, folder), target, _author_rules(spark, folder), _sizes(spark, folder))
    return _contents(target)


@query
def load_outcome(spark, folder):
    """What a load of a range says about the store and about the log."""
    target = store.CommitStore(spark, scratch_dir(spark, "store"))
    log = V.commit_log(spark, folder)
    load.ingest(log.between(1, 100), target)
    return load.load(log, target, end=1200).drop("warnings")


WARNING_HEADS = """
SELECT doc_id + 1 AS revision, text || ' ##' || (1000 + doc_id % 9000) || ' - AB' AS message,
       CASE lang WHEN 'en' THEN '/branches/builds/' || source || '/x' WHEN 'de' THEN '/branches/hotfixes/'
         ELSE '/branches/builds/4.1/x' END AS first_path
FROM documents
"""


@query
def version_warnings(spark, folder):
    sql = WARNING_HEADS.replace("FROM documents", "FROM {documents}")
    return tables.warnings(spark.sql(sql, documents=V.table(spark, folder, "documents")))


# --- diff policy -------------------------------------------------------------


@query
def needs_diff(spark, folder):
    return diffs.needs_diff(V.commit_log(spark, folder).heads)


@query
def is_copied_dir(spark, folder):
    return diffs.path_checks(V.commit_log(spark, folder).paths).select("revision", "path", "is_copied_dir")


SKIP_PATHS = """
SELECT page_id, CASE page_id % 5 WHEN 0 THEN url || '/Branches/Tools' WHEN 1 THEN url || '/tags/' WHEN 2 THEN url || '/VENDOR'
  WHEN 3 THEN '/Tags/' || url ELSE url END AS path FROM pages
"""


@query
def skip_prefix(spark, folder):
    paths = spark.sql(SKIP_PATHS.replace("FROM pages", "FROM {pages}"), pages=V.table(spark, folder, "pages"))
    path = F.col("path")
    return paths.select(
        "page_id",
        P.matches_skip_prefix(path).alias("skipped"),
        P.matches_skip_prefix(path, mode="prefix").alias("skipped_by_start"),
    )


@query
def skip_suffix(spark, folder):
    return diffs.path_checks(V.commit_log(spark, folder).paths).select("revision", "path", "skip_suffix")


@query
def is_changed_file(spark, folder):
    return diffs.path_checks(V.commit_log(spark, folder).paths).select("revision", "path", "is_changed_file")


@query
def diff_worklist(spark, folder):
    return diffs.worklist(V.commit_log(spark, folder).heads, _sizes(spark, folder))


@query
def obsolete_diffs(spark, folder):
    return diffs.obsolete(V.commit_log(spark, folder).heads, _sizes(spark, folder))


@query
def update_diff_sizes(spark, folder):
    updated = diffs.update_sizes(_commits(spark, folder), _sizes(spark, folder), 101)
    return updated.select("revision", "diff_size")


@query
def diff_progress(spark, folder):
    return diffs.progress(V.commit_log(spark, folder).heads)


# --- enrichment --------------------------------------------------------------


@query
def assign_team_role(spark, folder):
    return _labelled(spark, folder).select("revision", "author", "team", "role")


@query
def issue_links(spark, folder):
    return tracker.issue_links(_issues(spark, folder), V.issue_docs(spark, folder))


@query
def docs_by_reference(spark, folder):
    wanted = V.view(spark, folder, V.HISTORY_MESSAGES).select(
        F.concat(F.lit("#"), (F.col("event_id") + 1000).cast("string"), F.lit(" - AB")).alias("reference")
    )
    return tracker.docs_by_reference(V.issue_docs(spark, folder), wanted).select("doc_id", "reference")


@query
def original_document(spark, folder):
    docs = V.issue_docs(spark, folder)
    now = tracker.original_document(docs).select("db", "reference", "doc_id", F.size("revisions").alias("n_revisions"))
    before = tracker.original_document(docs, legacy=True).select("db", "reference", F.col("doc_id").alias("legacy_doc_id"))
    return now.join(before, ["db", "reference"])


@query
def item_or_default(spark, folder):
    lines = F.filter(F.split("text", "\n"), lambda line: line.contains("#"))
    return V.table(spark, folder, "documents").select("doc_id", N.item_or_default(lines, "NO-LINE").alias("item"))


def _group_names(spark, folder) -> DataFrame:
    nations = V.table(spark, folder, "nation").select(F.lower("n_name").alias("name"))
    return nations.unionAll(V.table(spark, folder, "region").select(F.lower("r_name").alias("name")))


@query
def groups_for_users(spark, folder):
    users = (
        V.table(spark, folder, "customer")
        .filter(F.col("c_mktsegment") != "HOUSEHOLD")
        .select(F.lower("c_name").alias("user"))
    )
    members = V.view(spark, folder, V.GROUP_MEMBERS)
    return address_book.groups_for_users(members, _group_names(spark, folder), users)


PEOPLE = """
SELECT c_custkey AS id, 'CN=' || c_name || ' Smith/ORG' AS member FROM customer
UNION ALL SELECT -1 - s_suppkey, CASE s_nationkey % 3 WHEN 0 THEN s_name WHEN 1 THEN 'Ann ' || s_name ELSE 'CN=Ann Mid ' || s_name || '/X' END
FROM supplier
"""


def _people(spark, folder) -> DataFrame:
    sql = PEOPLE.replace("FROM customer", "FROM {customer}").replace("FROM supplier", "FROM {supplier}")
    return spark.sql(sql, **{name: V.table(spark, folder, name) for name in ("customer", "supplier")})


@query
def member_to_user(spark, folder):
    return _people(spark, folder).select("id", N.member_to_user(F.col("member")).alias("user"))


@query
def name_key(spark, folder):
    return _people(spark, folder).select("id", N.name_key(F.col("member")).alias("key"))


@query
def team_roster(spark, folder):
    members = V.view(spark, folder, V.GROUP_MEMBERS)
    return address_book.team_roster(members, V.view(spark, folder, V.PERSONS), _group_names(spark, folder))


@query
def camel_case(spark, folder):
    name = F.concat_ws(" ", "p_name", "p_type", "p_brand")
    return V.table(spark, folder, "part").select("p_partkey", N.camel_case(name).alias("name"))


@query
def document_items(spark, folder):
    return address_book.document_items(readers.read_address_book(spark, _write_address_book(spark, folder)))


# --- loads and checks --------------------------------------------------------


@query
def max_revision(spark, folder):
    return load.max_revision(V.view(spark, folder, V.ENTRIES))


@query
def plan_load(spark, folder):
    loaded, available = _events_log(spark, folder), V.view(spark, folder, V.ENTRIES)
    plans = [
        load.plan_load(loaded, available, action)
        for action in (load.UPDATE_OR_REBUILD, load.UPDATE, load.FORCE_REBUILD)
    ]
    plans.append(load.plan_load(available, loaded, load.UPDATE_OR_REBUILD))
    plans.append(load.plan_load(available, available, load.UPDATE_OR_REBUILD))
    plans.append(load.plan_load(loaded, available, load.UPDATE_OR_REBUILD, end=10))
    return reduce(DataFrame.unionByName, plans)


@query
def incremental_append(spark, folder):
    """A first range under other rules, an overlapping rest with diff sizes, then a load that only relabels."""
    target = store.CommitStore(spark, scratch_dir(spark, "store"), span=5000)
    log, rules = V.commit_log(spark, folder), _author_rules(spark, folder)
    load.load(log, target, load.UPDATE_OR_REBUILD, 1, 8000, author_rules=_former_rules(spark, folder))
    load.ingest(log.between(5001), target, rules, _sizes(spark, folder))
    load.load(log, target, load.UPDATE_OR_REBUILD, author_rules=rules)
    return _contents(target)


@query
def incremental_append_stream(spark, folder):
    """The same through a stream of log files that repeat each other's commits."""
    source = scratch_dir(spark, "log-files")
    path = F.struct(
        F.lit(1).alias("ordinal"),
        F.concat(F.lit("/branches/builds/4.1/"), "event_type").alias("path"),
        F.lit("M").alias("type"),
        F.lit("file").alias("kind"),
        F.lit(None).cast("string").alias("copy_path"),
    )
    entries = V.table(spark, folder, "events").select(
        (F.col("event_id") + 1).alias("revision"),
        F.col("ts").cast("timestamp").alias("date"),
        F.col("event_type").alias("author"),
        F.concat(F.lit("fix #"), (F.col("user_id") + 1000).cast("string"), F.lit(" - AB")).alias("message"),
        F.array(path).alias("changed_paths"),
    )
    entries.write.parquet(source)
    entries.write.mode("append").parquet(source)
    stream = spark.readStream.schema(schema.LOG_ENTRY).parquet(source)
    target = store.CommitStore(spark, scratch_dir(spark, "store"))
    writer = append_stream(stream, target, scratch_dir(spark, "checkpoint"))
    writer.trigger(availableNow=True).start().awaitTermination()
    stored = target.tables()
    return stored["commits"].join(stored["version"], "revision").join(stored["issues"], "revision").join(
        stored["files"], "revision"
    ).select("revision", "author", "full_version", "reference", "file")


@query
def rebuild(spark, folder):
    target = store.CommitStore(spark, scratch_dir(spark, "store"))
    log = V.commit_log(spark, folder)
    load.load(log, target, load.UPDATE_OR_REBUILD, 1, 5000, author_rules=_former_rules(spark, folder))
    load.load(log, target, load.FORCE_REBUILD, 101, author_rules=_author_rules(spark, folder), sizes=_sizes(spark, folder))
    return _contents(target)


@query
def check_unique(spark, folder):
    raw = tables.files(V.view(spark, folder, V.PATHS))
    return checks.unique_violations(raw, schema.UNIQUE_KEYS["files"])


@query
def check_lengths(spark, folder):
    docs = V.table(spark, folder, "documents")
    return checks.length_violations(docs, {"text": 2048, "source": 4}, key="doc_id")


@query
def check_tables(spark, folder):
    return checks.table_violations(tables.build(V.commit_log(spark, folder)))


@query
def load_report(spark, folder):
    return reports.load_report(_commits(spark, folder))


@query
def boundary_rows(spark, folder):
    return reports.boundary_rows(_commits(spark, folder), 1, 1000)


@query
def refresh_diffs(spark, folder):
    target = store.CommitStore(spark, scratch_dir(spark, "store"), span=5000)
    log = V.commit_log(spark, folder)
    load.ingest(log, target)
    load.refresh_diffs(log, target, _sizes(spark, folder), 101)
    return target.read("commits").select("revision", "diff_size", "message")


# --- reports -----------------------------------------------------------------


@query
def prod_commits_with_issues(spark, folder):
    return reports.prod_commits_with_issues(_issue_facts(spark, folder), REPORT_YEAR)


@query
def revision_span(spark, folder):
    return reports.revision_span(_commits(spark, folder))


@query
def commits_per_branch_month(spark, folder):
    return reports.commits_per_branch_month(_commit_facts(spark, folder))


@query
def commits_per_version_month(spark, folder):
    return reports.commits_per_version_month(_commit_facts(spark, folder))


@query
def files_per_commit_month(spark, folder):
    return reports.files_per_commit_month(_commit_facts(spark, folder))


@query
def issues_per_branch_month(spark, folder):
    return reports.issues_per_branch_month(_issue_facts(spark, folder))


@query
def issues_authors_per_version_month(spark, folder):
    return reports.issues_authors_per_version_month(_issue_facts(spark, folder))


def _refreshed_store(spark, folder) -> store.CommitStore:
    """A store whose states were derived in two steps, of which the second meets a changed and new ranges."""
    target = store.CommitStore(spark, scratch_dir(spark, "store"), span=5000)
    log = V.commit_log(spark, folder)
    load.ingest(log.between(1, 8000), target)
    states.refresh(target)
    load.ingest(log.between(8001), target)
    states.refresh(target)
    return target


@query
def issues_per_branch_month_of_states(spark, folder):
    return reports.issues_per_branch_month(states.read(_refreshed_store(spark, folder), "issue_state"))


@query
def branches_authors_per_week_of_states(spark, folder):
    return reports.branches_authors_per_week(states.read(_refreshed_store(spark, folder), "commit_state"))


@query
def branches_per_week(spark, folder):
    return reports.branches_per_week(_commit_facts(spark, folder))


@query
def branches_authors_per_week(spark, folder):
    return reports.branches_authors_per_week(_commit_facts(spark, folder))


@query
def issues_per_author_week(spark, folder):
    return reports.issues_per_author_week(_issue_facts(spark, folder), REPORT_AUTHOR)


@query
def team_activity(spark, folder):
    return reports.team_activity(_labelled(spark, folder))


# --- jobs --------------------------------------------------------------------


@query
def build_errors(spark, folder):
    return jobs.build_errors(V.view(spark, folder, V.BUILD_LINES))


@query
def build_errors_of_files(spark, folder):
    """Errors read from text files: each document's last line, under its header."""
    return jobs.build_errors_of_files(spark, _build_log(spark, folder)).select("error_line", "project")


@query
def history_messages(spark, folder):
    docs = V.table(spark, folder, "documents").select("doc_id", F.col("text").alias("history"))
    return jobs.history_messages(docs)


@query
def status_of_message(spark, folder):
    message = F.col("message")
    return V.view(spark, folder, V.HISTORY_MESSAGES).select(
        "event_id",
        jobs.status_of_message(message).alias("status"),
        jobs.status_of_message(message, fixed=True).alias("fixed_status"),
    )


@query
def bug_to_feature(spark, folder):
    return jobs.bug_to_feature(V.issue_docs(spark, folder))


@query
def watchlist_needs_diff(spark, folder):
    log = V.commit_log(spark, folder)
    listed = V.table(spark, folder, "events").select((F.col("user_id") + 1).alias("revision"))
    return diffs.watchlist(log.heads, log.paths, listed)
