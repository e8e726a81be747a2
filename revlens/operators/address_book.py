"""Groups, members and persons of an address book.

Members are handled one row each (``doc_id, list_name, member``), never as one
list per group, so a group may hold any share of all members.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens import rules
from revlens.session import group_for_join
from revlens.functions import names as N


def group_members(groups: DataFrame) -> DataFrame:
    """Members of group documents; a group without members keeps one null row."""
    return groups.select("doc_id", "list_name", F.explode_outer("members").alias("member"))


def _wanted_groups(members: DataFrame, names) -> DataFrame:
    key = F.lower("list_name")
    if isinstance(names, DataFrame):
        wanted = names.select(F.col("name").alias("wanted_name"))
        return members.join(wanted, key == F.col("wanted_name"), "left_semi")
    return members.filter(key.isin(*names))


def groups_for_users(members: DataFrame, group_names, users: DataFrame) -> DataFrame:
    """Wanted users in each wanted group: ``group_name, user``.

    ``group_names`` is a sequence of lower-cased names or a table with ``name``;
    ``users`` a table with ``user``.  Of several documents with one name the last
    counts.  A group without wanted users keeps one row with a null user.
    """
    known = users.select("user").withColumn("is_wanted", F.lit(True))
    found = (
        _wanted_groups(members, group_names)
        .withColumn("user", N.member_to_user(F.col("member")))
        .join(known, "user", "left")
        .select("list_name", "doc_id", F.when(F.col("is_wanted"), F.col("user")).alias("user"))
        .distinct()
    )
    # The last document of each name, and whether it has any wanted user at all.
    latest = (
        found.groupBy("list_name")
        .agg(F.max(F.struct("doc_id", F.col("user").isNotNull().alias("has_users"))).alias("latest"))
        .select("list_name", "latest.*")
    )
    return (
        found.join(latest, ["list_name", "doc_id"])
        .filter(F.col("user").isNotNull() | ~F.col("has_users"))
        .select(F.col("list_name").alias("group_name"), "user")
    )


def team_roster(members: DataFrame, persons: DataFrame, group_names=rules.TEAM_GROUPS) -> DataFrame:
    """E-mail and names of the members of wanted groups, members sorted in each group.

    Of several persons under one name the last counts.
    """
    person = F.max_by(F.struct("internet_address", "first_name", "last_name"), F.col("doc_id")).alias("person")
    by_name = group_for_join(persons, N.name_key(F.col("full_name")).alias("key")).agg(person).drop("key_hash")
    return (
        _wanted_groups(members, group_names)
        .withColumn("key", N.name_key(F.col("member")))
        .join(by_name, "key")
        .select(
            "doc_id",
            F.col("list_name").alias("group_name"),
            "member",
            F.lower("person.internet_address").alias("email"),
            N.camel_case(F.col("person.first_name")).alias("first_name"),
            N.camel_case(F.col("person.last_name")).alias("last_name"),
        )
        .orderBy("doc_id", "member")
    )


def document_items(docs: DataFrame, key="doc_id") -> DataFrame:
    """Non-empty fields of each document as ``key, name, value``, by name within a document.

    Values print as lists, a single value as a list of one.
    """

    def item(field):
        column = F.col(field.name)
        if isinstance(field.dataType, T.ArrayType):
            text, present = F.array_join(column.cast("array<string>"), ", "), F.size(column) > 0
        else:
            text = column.cast("string")
            present = column.isNotNull() & (text != "")
        value = F.concat(F.lit("["), text, F.lit("]"))
        return F.when(present, F.struct(F.lit(field.name).alias("name"), value.alias("value")))

    fields = sorted((f for f in docs.schema.fields if f.name != key), key=lambda f: f.name)
    items = F.array_compact(F.array(*[item(f) for f in fields]))
    return docs.select(key, F.explode(items).alias("item")).select(key, "item.*")
