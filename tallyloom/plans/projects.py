"""Project and income reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.dates import in_period
from tallyloom.functions.numbers import truncate
from tallyloom.functions.text import drop_zero_cents, first_value_of
from tallyloom.operators.joins import Lookup, lookup
from tallyloom.operators.sets import union_layouts
from tallyloom.scale import join_side


def project_ledger(sources: Mapping[str, DataFrame], people: DataFrame) -> DataFrame:
    """Projects of several systems stacked and totalled per person, card and project.

    Each source: person_id, card_no, project_no, name, amount; columns a system lacks are null.
    people: person_id, name, unit.
    """
    tagged = [df.withColumn("system", F.lit(name)) for name, df in sources.items()]
    stacked = union_layouts(tagged, distinct=False)
    totals = stacked.groupBy("person_id", "card_no", "project_no").agg(
        F.sum(F.coalesce("amount", F.lit(0))).alias("amount"), F.count("*").alias("n_rows"),
        F.min("system").alias("first_system"), F.max("name").alias("project_name"))
    return lookup(totals, [Lookup(people, [("person_id", "person_id")],
                                  {"name": "person_name", "unit": "unit"})])


def income_summary(income: DataFrame) -> DataFrame:
    """Income by year, month and class (income: booked as text, class, amount)."""
    return income.groupBy(F.substring("booked", 1, 4).alias("year"), F.substring("booked", 6, 2).alias("month"),
                          "class").agg(F.sum("amount").alias("amount"), F.count("*").alias("n_rows"))


def contract_totals(projects: DataFrame) -> DataFrame:
    """Contract sum per class, each project counted once at its largest contract."""
    per_project = projects.groupBy("class", "project_no").agg(F.max("contract").alias("contract"))
    return per_project.groupBy("class").agg(F.sum("contract").alias("contract"), F.count("*").alias("n_projects"))


def discipline_average(income: DataFrame) -> DataFrame:
    """Income per distinct person of a discipline (income: discipline, person_id, amount)."""
    per_person = income.groupBy("discipline", "person_id").agg(F.sum("amount").alias("amount"))
    return per_person.groupBy("discipline").agg(
        F.sum("amount").alias("amount"), F.count("person_id").alias("n_persons"),
        F.round(F.try_divide(F.sum("amount"), F.count("person_id").cast("decimal(18,0)")), 2).alias("average"))


def assess_income(projects: DataFrame, allocations: DataFrame, lo: str, hi: str) -> DataFrame:
    """Income of each person's projects that fall in the period, for every person at once.

    projects: person_id, project_no, card_no, start, end, total, override, role, kind; allocations:
    person_id, card_no, amount, allocated as text.  `income` is the project total (or its override)
    cut to two places; `share` is what the person was allocated inside the period.
    """
    low, high = lo.replace("-", "."), hi.replace("-", ".")
    when = F.replace("allocated", F.lit("-"), F.lit("."))
    shares = (allocations.filter((when >= low) & (when <= high)).groupBy("person_id", "card_no")
              .agg(F.sum(F.coalesce("amount", F.lit(0))).alias("_share")))
    inside = projects.filter(in_period("start", "end", lo, hi))
    joined = inside.join(join_side(shares), ["person_id", "card_no"], "left")
    return joined.select(
        "person_id", "project_no", "card_no", "start", "end",
        drop_zero_cents(truncate(F.coalesce("override", "total"), 2).cast("decimal(20,2)")).alias("income"),
        drop_zero_cents(truncate("_share", 2).cast("decimal(20,2)")).alias("share"),
        first_value_of("role", "kind", blank_is_null=True).alias("role"))


def roles_in_period(leads: DataFrame, shares: DataFrame, lo: str, hi: str) -> DataFrame:
    """Lead and collaborator of each (person, project) seen in the period, from two kinds of evidence.

    Both frames: person_id, project_no, seen_on as text.
    """
    inside = F.col("seen_on").between(lo, hi)
    first = leads.filter(inside).select("person_id", "project_no", F.lit(True).alias("l"), F.lit(False).alias("m"))
    second = shares.filter(inside).select("person_id", "project_no", F.lit(False).alias("l"), F.lit(True).alias("m"))
    both = union_layouts([first, second])
    flagged = both.groupBy("person_id", "project_no").agg(F.bool_or("l").alias("_l"), F.bool_or("m").alias("_m"))
    role = F.when(F.col("_l"), F.lit("lead")).otherwise(F.lit("collaborator"))
    return flagged.select("person_id", "project_no", role.alias("role"), F.col("_m").alias("has_share"))


def allocation_view(allocations: DataFrame, projects: DataFrame) -> DataFrame:
    """Allocations as users see them: a child row shows its own share and its parent's unit and team.

    allocations: alloc_id, parent_id, person_id, project_no, unit, team, amount, received;
    projects: project_no, name, start.  A root row shows the receipt and what is left of it.
    """
    child = F.coalesce(F.octet_length("parent_id"), F.lit(0)) > 0
    parents = allocations.select(F.col("alloc_id").alias("_pid"), F.col("unit").alias("_p_unit"),
                                 F.col("team").alias("_p_team"))
    joined = allocations.join(parents, F.col("parent_id") == F.col("_pid"), "left").drop("_pid")
    named = lookup(joined, [Lookup(projects, [("project_no", "project_no")],
                                   {"name": "project_name", "start": "project_start"})])
    return named.select(
        "alloc_id", "person_id", "project_no", "project_name", "project_start",
        F.when(~child, F.col("received")).alias("shown_receipt"),
        F.when(child, F.col("amount")).otherwise(F.col("received") - F.col("amount")).alias("shown_share"),
        F.when(child, F.lit("1")).otherwise(F.lit("0")).alias("is_child"),
        F.when(child, F.col("_p_unit")).otherwise(F.col("unit")).alias("lead_unit"),
        F.when(child, F.col("_p_team")).otherwise(F.col("team")).alias("lead_team"))
