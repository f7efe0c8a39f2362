"""Person reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.text import first_value_of
from tallyloom.operators.groups import argmax, count_if_matrix, distribution, first_by
from tallyloom.operators.joins import Lookup, in_scope, lookup, parent_lookup
from tallyloom.operators.sets import union_layouts
from tallyloom.operators.windows import asof_join, latest_per


def person_profile(persons: DataFrame, accounts: DataFrame, units: DataFrame, parties: DataFrame,
                   degrees: DataFrame, codes: Mapping[str, tuple[DataFrame, str]],
                   scope_persons: DataFrame | None = None,
                   scope_units: DataFrame | None = None) -> DataFrame:
    """One row per person: newest account, unit and parent unit, first party, highest degree, code names.

    persons: person_id, name, unit_code and the code columns; accounts: person_id, account, updated;
    units: unit_id, name, parent_id; parties: person_id, seq, party, joined; degrees: person_id, school,
    degree_code, year_month (the smallest code above `0` is the highest degree).  `codes` maps a
    code column to (code table with code and name, output column).  Ids are compared trimmed.
    """
    trimmed = {"person_id": F.trim("person_id")}
    people = persons.withColumns(trimmed)
    account = latest_per(accounts.withColumns(trimmed), "person_id",
                         [F.desc("updated"), F.desc("account")]).select("person_id", "account")
    party = first_by(parties.withColumns(trimmed), ["person_id"], ["seq"], ["party", "joined"])
    degree = first_by(degrees.withColumns(trimmed).filter(F.substring("degree_code", 1, 1) > "0"),
                      ["person_id"], ["degree_code", "year_month"], ["school", "degree_code"])
    tree = parent_lookup(units, "unit_id", "parent_id", ["name"]).select(
        "unit_id", F.col("name").alias("unit_name"), F.col("parent_id").alias("parent_unit"),
        F.col("parent1_name").alias("parent_unit_name"))
    out = people
    for side in (account, party, degree):
        out = out.join(side, "person_id", "left")
    out = lookup(out, [Lookup(tree, [("unit_code", "unit_id")], {
        "unit_name": "unit_name", "parent_unit": "parent_unit", "parent_unit_name": "parent_unit_name"})])
    out = lookup(out, [Lookup(table, [(column, "code")], {"name": name}, trim=True)
                       for column, (table, name) in codes.items()])
    if scope_persons is not None and scope_units is not None:
        out = in_scope(out, scope_persons, scope_units, "person_id", "unit_code")
    return out


def student_profile(students: DataFrame, codes: Sequence[tuple[str, DataFrame, str]], source: str | None = None,
                    paired: Sequence[tuple[str, DataFrame, str]] = ()) -> DataFrame:
    """Students with code names: (column, code table, output); `paired` tables key on (code, source)."""
    plain = [Lookup(table, [(column, "code")], {"name": name}) for column, table, name in codes]
    both = [Lookup(table, [(column, "code"), (source, "source")], {"name": name})
            for column, table, name in paired]
    return lookup(students, [*plain, *both])


def yearly_presence(people: DataFrame, first_year: int, last_year: int, month: str = "12") -> DataFrame:
    """One row per person and year in service at the given month.

    people: person_id, entered and left as `yyyy.MM` text; left null means still in service.
    """
    enter_year = F.substring("entered", 1, 4).try_cast("int")
    leave_year = F.coalesce(F.substring("left_on", 1, 4).try_cast("int"), F.lit(last_year))
    lo, hi = F.greatest(enter_year, F.lit(first_year)), F.least(leave_year, F.lit(last_year))
    rows = people.filter(lo <= hi).withColumn("year", F.explode(F.sequence(lo, hi)))
    at = F.concat(F.col("year").cast("string"), F.lit("." + month))
    return rows.filter((F.col("entered") <= at) & (F.col("left_on").isNull() | (F.col("left_on") >= at)))


def titles_at_year_end(presence: DataFrame, titles: DataFrame, tie: Sequence[str] = ("seq",)) -> DataFrame:
    """The latest title granted before December of each year (titles: person_id, title_code, granted, seq)."""
    known = titles.filter(first_value_of("title_code", blank_is_null=True).isNotNull()).select(
        "person_id", F.col("granted").alias("since"), "title_code", *tie)
    facts = presence.withColumn("at", F.concat(F.col("year").cast("string"), F.lit(".12")))
    return asof_join(facts, known, "person_id", "at", "since", ["title_code", "since"], tie=list(tie),
                     strict=True).withColumnRenamed("since", "title_granted").drop("at")


def movements(layouts: Mapping[str, DataFrame], unit_names: DataFrame) -> DataFrame:
    """Events of several kinds in one table with unit names (unit_names: code, name).

    Each layout may lack columns; a row's kind is the name of its layout.
    """
    tagged = [frame.withColumn("kind", F.lit(kind)) for kind, frame in layouts.items()]
    stacked = union_layouts(tagged)
    return lookup(stacked, [Lookup(unit_names, [("old_unit", "code")], {"name": "old_unit_name"}),
                            Lookup(unit_names, [("new_unit", "code")], {"name": "new_unit_name"})])


def headcount_bands(people: DataFrame, unit: str, age: Column, tenure: Column,
                    age_band: Column) -> DataFrame:
    """Members per unit and age band, split by length of service."""
    rows = people.withColumns({"_age": age, "_tenure": tenure})
    known = F.col("_tenure").isNotNull()
    measures = {
        "n_all": F.lit(True), "n_under_2": known & (F.col("_tenure") < 2),
        "n_2_to_4": known & F.col("_tenure").between(2, 4),
        "n_5_to_9": known & F.col("_tenure").between(5, 9), "n_10_up": known & (F.col("_tenure") >= 10),
    }
    return distribution(rows, [unit], age_band, measures, "person_id", "age_band")


def supervision_rows(students: DataFrame) -> DataFrame:
    """Students under their first and, where it is another person, second supervisor."""
    base = students.filter(F.coalesce(F.col("left_flag"), F.lit("0")) == "0")
    first = base.filter(F.col("supervisor1").isNotNull()).select(
        "student_id", "level_code", F.col("supervisor1").alias("supervisor"), F.lit(1).alias("place"))
    second = base.filter(F.col("supervisor2").isNotNull() & (F.col("supervisor1") != F.col("supervisor2"))).select(
        "student_id", "level_code", F.col("supervisor2").alias("supervisor"), F.lit(2).alias("place"))
    return union_layouts([first, second])


def supervision(students: DataFrame, levels: Mapping[str, str]) -> DataFrame:
    """Distinct students per supervisor and level; `levels` maps a measure to a level code."""
    measures = {name: F.col("level_code") == code for name, code in levels.items()}
    measures["n_second"] = F.col("place") == 2
    return count_if_matrix(supervision_rows(students), ["supervisor"], measures, "student_id")


def milestones(people: DataFrame, titles: DataFrame, projects: DataFrame, awards: DataFrame,
               hours: DataFrame) -> DataFrame:
    """First title, first project, first award and total teaching hours of each person.

    titles: person_id, title_code, granted; projects: person_id, project_no, started;
    awards: person_id, award, awarded; hours: person_id, hours.
    """
    def first(df: DataFrame, when: str, what: str) -> DataFrame:
        return first_by(df.filter(F.col(when).isNotNull()), ["person_id"], [when], [when, what], "first_")

    out = people
    for side in (first(titles, "granted", "title_code"), first(projects, "started", "project_no"),
                 first(awards, "awarded", "award"),
                 hours.groupBy("person_id").agg(F.sum("hours").alias("total_hours"))):
        out = out.join(side, "person_id", "left")
    return out


def current_title(titles: DataFrame) -> DataFrame:
    """The title of highest sequence number per person."""
    return argmax(titles, ["person_id"], "seq", ["title_code"])
