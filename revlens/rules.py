"""Rules kept as data.  A site with another layout passes its own values."""

from typing import NamedTuple


class BranchRule(NamedTuple):
    """Commits whose first path starts with ``prefix`` get these labels.

    ``versioning`` says where the version comes from: ``dots`` reads the third
    path segment (4.1.2 -> 4.1), ``underscores`` the text after the prefix
    (9_2 -> 9), ``none`` leaves both versions at ``other``.
    """

    prefix: str
    product: str
    type: str
    branch: str
    versioning: str


OTHER = "other"

# Results depend on them literally.
BRANCH_RULES = (
    BranchRule("/branches/builds/", "Dalet", "prod", "builds", "dots"),
    BranchRule("/branches/hotfixes/", "Dalet", "prod", "hotfix", "dots"),
    BranchRule("/branches/tnt", "Italy", "prod", "tnt", "none"),
    BranchRule("/amberfin/products/amberfin/branches/amberfin_", "Amberfin", "prod", "branches", "underscores"),
    BranchRule("/amberfin/products/amberfin/trunk", "Amberfin", "other", "trunk", "none"),
    BranchRule("/amberfin/products/amberfin/branches/amberfinkiosk_v", "AmberfinKiosk", "prod", "branches", "underscores"),
    BranchRule("/amberfin", "Amberfin", "prod", "amberfin", "none"),
)
PRODUCTION_BRANCHES = ("builds", "hotfix")

# Paths and extensions that need no diff.
SKIP_PREFIXES = (
    "/amberfin/import-from-amberfin-repository",
    "/branches/tools",
    "/branches/utils",
    "/tags",
    "/vendor",
)
SKIP_SUFFIXES = (
    ".log",
    ".xml",
    ".pdf",
    ".doc",
    ".ini",
    ".jar",
    ".class",
    ".exe",
    ".dll",
    ".ocx",
    ".lib",
)

# Message limits and issue references.
MAX_MESSAGE_LENGTH = 102400
MAX_MESSAGE_MARKS = 1000
ISSUE_PATTERN = r"(?s)(^|[^:])#\d{4,6}\s-\s[A-Z]{2}"
SHORT_BUG_LENGTH = 11
LAST_SHORT_FEATURE = 30000

# Identifiers that appear inside issue links.
FEATURES_REPLICA = "41256D4F0056B2C1"
FEATURES_VIEW = "F792B3C310381FAFC225632B0037986C"

# Lengths of exported tracker file names, by kind.
FEATURE_FILE_NAME_LENGTH = 14
BUG_FILE_NAME_LENGTH = 15

# Groups whose members make up the team roster.
TEAM_GROUPS = (
    "scrum-managers",
    "scrumamberfin",
    "scrumautomation",
    "scrumbrio",
    "scrumbu",
    "scrumcds",
    "scrumcg",
    "scrumcore",
    "scrumddm",
    "scrumlabs",
    "scrumonecut",
    "scrumonthego",
    "scrumplatform",
    "scrumreleasevalidation",
    "scrumsports",
    "scrumux",
    "scrumweb",
    "scrumxchange",
)

# How a history message sets an issue's status, first match wins.
STATUS_BY_START = (
    ("Bug Assigned  to", "NEW"),
    ("Remark by", "NEW"),
    ("by ", "NEW"),
    ("Programmer change", "NEW"),
    ("Work started by", "NEW"),
    ("Tester change", "NEW"),
    ("Refix started by", "NEW"),
    ("Module Name updated", "NEW"),
    ("Retest started by", "NEW"),
    ("Answered by", "NEW"),
    ("Rejection rejected by", "NEW"),
    ("More info requested by", "QUESTION"),
    ("Work endedby", "FIXED"),
    ("Fixedby", "FIXED"),
    ("Rejected by", "FIXED"),
    ("Bug marked as archived", "ARCHIVED"),
    ("Bug sent to ARCHIVE", "ARCHIVED"),
    ("Case closed by", "DONE"),
)
STATUS_BY_CONTENT = (("says the bug is not fixed yet", "NEW"),)
STATUS_CHANGE_START = "Status Changed to"
STATUS_UNKNOWN = "UNKNOWN"
HISTORY_DATE_LENGTH = 13

# Shape of a build-log block header, and its outcomes.
BLOCK_MARK = "***** "
BLOCK_HEAD_LENGTH = 17
BLOCK_TAIL_LENGTH = 6
BUILD_OK = "OK"
BUILD_STOP = "STOP."
