"""Column helpers against plain Python, on random inputs rich in edge cases."""

import random
import re

from pyspark.sql import functions as F

from revlens import rules, schema
from revlens.functions import messages as M
from revlens.functions import names as N
from revlens.functions import paths as P
from revlens.operators import diffs
from revlens.sources.commit_log import CommitLog, flatten_paths


def pieces(dice, parts, most):
    return "".join(dice.choice(parts) for _ in range(dice.randrange(most)))


def parts_of(text, pattern):
    """Split with empty trailing parts dropped; an empty text is one empty part."""
    found = re.split(pattern, text)
    while len(found) > 1 and found[-1] == "":
        found.pop()
    return [] if found == [""] and text else found


def evaluate(spark, values, *columns):
    df = spark.createDataFrame(list(enumerate(values)), "i int, x string")
    picked = [c(F.col("x")).alias(f"y{n}") for n, c in enumerate(columns)]
    return [tuple(r)[1:] for r in df.select("i", *picked).orderBy("i").collect()]


def test_references(spark):
    dice = random.Random(1)
    parts = ["#", "##", ":", "1234", "12345", "30000", "30001", "123456", "9", " - ", "-", "AB", "CD", "a", "\n", " ", "é"]
    messages = ["".join(dice.choice(["#12345 - AB", "#1234 - CD", pieces(dice, parts, 8)]) for _ in range(dice.randrange(5))) for _ in range(3000)]

    def expected(message):
        found = []
        for match in re.finditer(r"(^|[^:])#\d{4,6}\s-\s[A-Z]{2}", message, re.ASCII | re.DOTALL):
            reference = match.group() if match.group().startswith("#") else match.group()[1:]
            digits = reference[1:6]
            bug = len(reference) > 11 or (len(reference) == 11 and digits.isdigit() and int(digits) > 30000)
            if (reference, bug) not in found:
                found.append((reference, bug))
        return found

    typed = lambda m: F.transform(M.issue_references(m), lambda r: F.struct(r, M.is_bug(r)))
    results = [[tuple(pair) for pair in row[0]] for row in evaluate(spark, messages, typed)]
    assert results == [expected(m) for m in messages]
    assert sum(len(r) for r in results) > 500


def test_labels_and_versions(spark):
    dice = random.Random(2)
    starts = [r.prefix for r in rules.BRANCH_RULES] + ["/trunk/", "/branches/", "/", ""]
    paths = [dice.choice(starts) + pieces(dice, ["/", "4", ".", "..", "_", "9", "x", "main"], 9) for _ in range(4000)]

    def at(found, index):
        return found[index] if index < len(found) else None

    def expected(path):
        for rule in rules.BRANCH_RULES:
            if not path.startswith(rule.prefix):
                continue
            if rule.versioning == "none":
                return (rule.branch, "other", "other")
            if rule.versioning == "dots":
                full = at(parts_of(path, "/"), 3)
                tokens = parts_of(full, r"\.") if full is not None else []
                return (rule.branch, full, ".".join(tokens[:2]) if len(tokens) > 1 else full)
            full = at(parts_of(path[len(rule.prefix):], "/"), 0)
            return (rule.branch, full, at(parts_of(full, "_"), 0) if full is not None else None)
        return ("other", "other", "other")

    heads = spark.createDataFrame(list(enumerate(paths)), "i int, first_path string")
    found = P.with_branch_labels(heads).orderBy("i").select("branch", "full_version", "product_version").collect()
    assert [tuple(r) for r in found] == [expected(p) for p in paths]


def test_members(spark):
    dice = random.Random(3)
    members = [pieces(dice, ["CN=", "Ann", " ", "Example", "/", "ORG", "=", "É"], 8) for _ in range(3000)]
    members = [m for m in members if parts_of(m, "[=/]") and parts_of(m, "[=/]") != [""]]

    def key(member):
        tokens = parts_of(member, "[=/]")
        return (member if len(tokens) == 1 else tokens[1]).lower()

    def user(member):
        words = parts_of(key(member), " ")
        return words[0][:1] + words[1] if len(words) == 2 else key(member)

    found = evaluate(spark, members, N.name_key, N.member_to_user)
    assert found == [(key(m), user(m)) for m in members]


def test_diff_need(spark, rows):
    dice = random.Random(4)
    endings = list(rules.SKIP_SUFFIXES) + list(rules.SKIP_PREFIXES) + [".java", ".xmlx", "log", "/", ""]

    def path(ordinal):
        name = "/p" + str(ordinal) + dice.choice(endings)
        return (ordinal, dice.choice([name, name.upper()]), dice.choice("AMDR"), dice.choice(["file", "dir", "unknown", "file"]),
                dice.choice([None, None, None, "", "/trunk"]))

    commits = [[path(i) for i in range(dice.randrange(5))] for _ in range(1500)]

    def expected(paths):
        skip = tuple(e.lower() for e in rules.SKIP_SUFFIXES + rules.SKIP_PREFIXES)
        if any(kind == "dir" and copied for _, _, _, kind, copied in paths):
            return False
        return any(kind == "file" and type_ != "D" and not name.lower().endswith(skip) for _, name, type_, kind, _ in paths)

    nested = spark.createDataFrame([(i, None, None, None, c) for i, c in enumerate(commits)], schema.LOG_ENTRY)
    answers = [(i, expected(c)) for i, c in enumerate(commits)]
    assert rows(diffs.needs_diff(CommitLog.from_nested(nested).heads)) == answers
    flat = CommitLog.from_flat(nested.drop("changed_paths"), flatten_paths(nested))
    assert rows(diffs.needs_diff(flat.heads)) == answers
    assert 100 < sum(answer for _, answer in answers) < 1400
