import datetime

import pytest
from pyspark.sql import functions as F

from revlens import rules
from revlens.functions import calendar as C
from revlens.functions import messages as M
from revlens.functions import names as N
from revlens.functions import paths as P


def evaluate(spark, column, values, type_="string"):
    """The column's value for each input, in input order."""
    df = spark.createDataFrame(list(enumerate(values)), f"i int, x {type_}")
    return [r[0] for r in df.select(column(F.col("x")).alias("y"), "i").orderBy("i").select("y").collect()]


def test_messages_are_cleaned_in_order(spark):
    values = [None, "a" * 102399, "a" * 102400, "#" * 999, "#" * 1000, "\U0001f600" * 51200, "#" * 102400]
    cleaned = evaluate(spark, M.clean_message, values)
    assert cleaned == [
        "",
        values[1],
        "this log message was too long: 102400",
        values[3],
        "this log message contained too many issues: 1000",
        "this log message was too long: 102400",
        "this log message was too long: 102400",
    ]


def test_issue_marks_are_counted(spark):
    assert evaluate(spark, M.count_issue_marks, ["", "none", "a#b##"]) == [0, 0, 3]


REFERENCES = {
    "#55345 - AB": ["B #55345 - AB"],
    "#123456 - AB": ["B #123456 - AB"],
    "#19999 - AB": ["F #19999 - AB"],
    "#1234 - AB": ["F #1234 - AB"],
    "#30000 - AB": ["F #30000 - AB"],
    "#30001 - AB": ["B #30001 - AB"],
    "x:#1234 - AB": [],
    "#1234 - AB#5678 - CD": ["F #1234 - AB"],
    "#1234 - AB #1234 - AB": ["F #1234 - AB"],
    "#123456 - ABC": ["B #123456 - AB"],
    "#1234567 - AB": [],
    "#123 - AB": [],
    "#1234 - ab": [],
    "#1234-AB": [],
    "##12345 - AB": ["B ##12345 - AB"],
    "##1234 - AB": ["F ##1234 - AB"],
    "a\n#1234 - AB\n#40000 - CD": ["F #1234 - AB", "B #40000 - CD"],
    "": [],
    None: [],
}


def test_references_are_found_and_classified(spark):
    typed = lambda m: F.transform(M.issue_references(m), lambda r: F.concat(M.issue_type(r), F.lit(" "), r))
    assert dict(zip(REFERENCES, evaluate(spark, typed, list(REFERENCES)))) == REFERENCES


def us_week(day):
    """Sunday weeks; week 1 holds 1 January.  Counted from the Sunday that starts it."""
    sunday = day - datetime.timedelta(days=(day.weekday() + 1) % 7)
    year = (sunday + datetime.timedelta(days=6)).year
    first = datetime.date(year, 1, 1)
    start = first - datetime.timedelta(days=(first.weekday() + 1) % 7)
    return year, (sunday - start).days // 7 + 1


def test_week_numbers_match_a_day_by_day_count(spark):
    days = [datetime.date(2004, 1, 1) + datetime.timedelta(days=i) for i in range(366 * 23)]
    weeks = evaluate(spark, C.week_of_year, days, "date")
    years = evaluate(spark, C.week_year, days, "date")
    assert list(zip(years, weeks)) == [us_week(d) for d in days]
    iso = evaluate(spark, lambda d: C.week_of_year(d, "iso"), days, "date")
    iso_years = evaluate(spark, lambda d: C.week_year(d, "iso"), days, "date")
    assert list(zip(iso_years, iso)) == [tuple(d.isocalendar())[:2] for d in days]


def test_unknown_week_rule_is_refused():
    with pytest.raises(ValueError):
        C.week_of_year(None, "lunar")


BRANCHES = {
    "/branches/builds/4.1.2/a": ("prod", "builds", "4.1.2", "4.1"),
    "/branches/hotfixes/main/a": ("prod", "hotfix", "main", "main"),
    "/branches/tntx/a": ("prod", "tnt", "other", "other"),
    rules.BRANCH_RULES[3].prefix + "9_2/a": ("prod", "branches", "9_2", "9"),
    rules.BRANCH_RULES[4].prefix + "/a": ("other", "trunk", "other", "other"),
    rules.BRANCH_RULES[5].prefix + "2_1/a": ("prod", "branches", "2_1", "2"),
    rules.BRANCH_RULES[6].prefix + "/x": ("prod", rules.BRANCH_RULES[6].branch, "other", "other"),
    rules.BRANCH_RULES[3].prefix.replace("_", "x") + "9": ("prod", rules.BRANCH_RULES[6].branch, "other", "other"),
    "/Branches/Builds/4.1.2/a": ("other", "other", "other", "other"),
    "/branches/builds": ("other", "other", "other", "other"),
    "/branches/builds/": ("prod", "builds", None, None),
    "/branches/builds//x": ("prod", "builds", "", ""),
    rules.BRANCH_RULES[3].prefix: ("prod", "branches", "", ""),
    rules.BRANCH_RULES[3].prefix + "/": ("prod", "branches", None, None),
    rules.BRANCH_RULES[3].prefix + "_/x": ("prod", "branches", "_", None),
    None: ("other", "other", "other", "other"),
}


def test_branch_rules(spark):
    heads = spark.createDataFrame([(p,) for p in BRANCHES], "first_path string")
    found = P.with_branch_labels(heads).collect()
    assert {r.first_path: (r.type, r.branch, r.full_version, r.product_version) for r in found} == BRANCHES


def test_products_follow_the_rules(spark):
    paths = [rule.prefix for rule in rules.BRANCH_RULES]
    found = evaluate(spark, lambda p: P.branch_labels(p)["product"], paths)
    assert found == [rule.product for rule in rules.BRANCH_RULES]


def test_product_version(spark):
    values = ["4.1.2", "main", "4.", "4..", "..", ".", "4..7", ".x", ""]
    assert evaluate(spark, P.product_version, values) == ["4.1", "main", "4.", "4..", "..", ".", "4.", ".x", ""]


def test_skip_rules(spark):
    skipped = ["file.xml", "fIle.OcX", "file.test.jar", "/full/path/tofile.exe"]
    kept = ["file.xml.1", "fIle.OcX2", "file.test.thejar", "/full/path/tofile.exe/"]
    assert evaluate(spark, P.matches_skip_suffix, skipped + kept) == [True] * 4 + [False] * 4
    areas = ["/x/tags", "/tags/y.java", "/Branches/Tools", "/branches/tools/x"]
    assert evaluate(spark, P.matches_skip_prefix, areas) == [True, False, True, False]
    assert evaluate(spark, lambda p: P.matches_skip_prefix(p, mode="prefix"), areas) == [False, True, True, True]


def test_members_and_keys(spark):
    members = ["CN=Ann Example/OU/ORG", "ann", "CN=Ann Mid Example/ORG", "Ann Example", "CN=", "=", "Ann "]
    assert evaluate(spark, N.member_to_user, members) == [
        "aexample", "ann", "ann mid example", "aexample", "cn=", "=", "ann "]
    assert evaluate(spark, N.name_key, members) == [
        "ann example", "ann", "ann mid example", "ann example", "cn=", "=", "ann "]


def test_camel_case(spark):
    values = ["van der BERG", "o'neil-SMITH", None, ""]
    assert evaluate(spark, N.camel_case, values) == ["VanDerBerg", "O'neil-smith", None, ""]


def test_item_or_default(spark):
    first = lambda v: N.item_or_default(v, "none")
    assert evaluate(spark, first, [["a", "b"], [], None, [""], [None, "b"]], "array<string>") == ["a", "none", "none", "", "none"]
