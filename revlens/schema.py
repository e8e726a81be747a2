"""Schemas of the input records and of the five stored tables."""

from pyspark.sql import types as T


def _struct(spec):
    return T.StructType([T.StructField(name, kind) for name, kind in spec])


_L, _I, _S = T.LongType(), T.IntegerType(), T.StringType()

CHANGED_PATH = _struct(
    [("ordinal", _I), ("path", _S), ("type", _S), ("kind", _S), ("copy_path", _S)]
)
LOG_ENTRY = _struct(
    [
        ("revision", _L),
        ("date", T.TimestampType()),
        ("author", _S),
        ("message", _S),
        ("changed_paths", T.ArrayType(CHANGED_PATH)),
    ]
)
DIFF_SIZE = _struct([("revision", _L), ("length", _L)])
AUTHOR_RULE = _struct(
    [
        ("author", _S),
        ("role", _S),
        ("team", _S),
        ("valid_from", T.DateType()),
        ("valid_to", T.DateType()),
        ("seq", _I),
    ]
)
ADDRESS_BOOK_DOC = _struct(
    [
        ("doc_id", _L),
        ("type", _S),
        ("list_name", _S),
        ("members", T.ArrayType(_S)),
        ("full_name", _S),
        ("first_name", _S),
        ("last_name", _S),
        ("internet_address", _S),
    ]
)
ISSUE_DOC = _struct(
    [
        ("doc_id", _L),
        ("db", _S),
        ("reference", _S),
        ("name", _S),
        ("uniq_id", _S),
        ("revisions", T.ArrayType(_S)),
        ("history", _S),
        ("feature", _S),
    ]
)
BUILD_LINE = _struct([("file", _S), ("line_no", _L), ("line", _S)])

COMMITS = _struct(
    [
        ("revision", _L),
        ("date", T.DateType()),
        ("author", _S),
        ("team", _S),
        ("role", _S),
        ("changed_files_count", _I),
        ("diff_size", _L),
        ("message", _S),
    ]
)
FILES = _struct([("revision", _L), ("type", _S), ("kind", _S), ("file", _S)])
DATE_TIME = _struct(
    [
        ("revision", _L),
        ("date", T.DateType()),
        ("time", _S),
        ("datetime", T.TimestampType()),
        ("year", _I),
        ("month", _I),
        ("day", _I),
        ("week", _I),
        ("day_of_week", _I),
        ("hour", _I),
        ("minutes", _I),
        ("sec", _I),
    ]
)
VERSION = _struct(
    [
        ("revision", _L),
        ("product", _S),
        ("type", _S),
        ("branch", _S),
        ("product_version", _S),
        ("full_version", _S),
    ]
)
ISSUES = _struct(
    [
        ("revision", _L),
        ("type", _S),
        ("reference", _S),
        ("notes_client_url", _S),
        ("notes_web_url", _S),
    ]
)

TABLES = {
    "commits": COMMITS,
    "files": FILES,
    "date_time": DATE_TIME,
    "version": VERSION,
    "issues": ISSUES,
}

# Columns that identify a row, and the widest text each column may hold.
UNIQUE_KEYS = {
    "commits": ["revision"],
    "files": ["revision", "file"],
    "date_time": ["revision"],
    "version": ["revision"],
    "issues": ["revision", "type", "reference"],
}
TEXT_LIMITS = {
    "commits": {"author": 100, "team": 100, "role": 10, "message": 102400},
    "files": {"type": 10, "kind": 10, "file": 2048},
    "date_time": {},
    "version": {
        "product": 32,
        "type": 10,
        "branch": 1024,
        "product_version": 100,
        "full_version": 100,
    },
    "issues": {
        "type": 10,
        "reference": 100,
        "notes_client_url": 1024,
        "notes_web_url": 1024,
    },
}
